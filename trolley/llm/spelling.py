"""Spelling variants: words one edit apart, grouped under their frequent form.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word with the most occurrences (ties: the
smallest in code-point order), if it has at least ``ratio`` times the word's
own; its root is where the chain of forms ends.

Search. The parts that two near words share before and after the edit add up to
all but one of their code points at least, so they share half of a word from
the left or from the right. The vocabulary is therefore sorted twice, as it is
and reversed, and cut into range blocks of bounded size. A word asks the blocks
that hold words with the first half of its own: its own block, and where a
prefix fills several, those whose common beginning is within one edit of it.

A block is scanned in its order. Row d of a word's edit matrix is a band of
three cells around the diagonal for the d code points read so far; cells beyond
one edit are dropped. Rows of the prefix that a word shares with the one before
it, the LCP, are kept and only those behind are computed, for all asking words
at once: those still equal to the prefix, and for those with their edit behind
them the cell, filed under the one letter with which it lives on. A word whose
band is empty thereby skips the whole range with that prefix. A pair that
shares both halves is reported from the left only.

What a word learns travels as a count and its best near word, never as pairs.

Null texts have no words. Repeated rows count as often as they occur. A null
doc_id counts as an empty one. An empty table gives no rows. Further columns are of
no account. Long texts are cut by the JVM's regular expressions, whole.

On the driver: the first and last word of each block, one block for
``BLOCK_WORDS`` words of the vocabulary.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .merkle import lower_ascii
from .text import output

BLOCK_WORDS = 1 << 15
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ODD_ONE = 31  # runs whose CRC-32 this divides lose a code point
MAX_ROUNDS = 16  # a form has RATIO times the occurrences, so chains have under 20 links
FORWARD, BACKWARD = 0, 1


def document_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lower-cased, one in ``ODD_ONE`` of
    them without one code point; those of ``min_length`` code points and
    ``min_count`` occurrences at least."""
    letters = f"[A-Za-zÀ-ÿ]{{{min_length},}}"  # shorter runs only get shorter
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col("text"), F.lit(letters), F.lit(0))).alias("run"),
    ).select("doc", lower_ascii(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % ODD_ONE == 0, rest).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).filter(F.length("word") >= min_length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def half(word: str) -> int:
    """Code points from an end that a near word shares, if not from the other."""
    return len(word) // 2


def scan(words: list[str], askers: list[str]) -> Iterator[tuple[str, list[str]]]:
    """(word, askers) for each of the sorted ``words`` that is one edit away from
    any of ``askers`` and has the first half of these."""
    entering: dict[str, list[str]] = defaultdict(list)
    for asker in askers:
        entering[asker[: half(asker)]].append(asker)
    depths = {len(p) for p in entering}
    first, last = min(depths, default=0), max(depths, default=0)
    longest = max(map(len, words), default=0)
    # row of each depth: askers equal to the prefix so far; after the edit, (asker,
    # code points matched) under the letter that must come next, "" at the asker's end
    equal: list[list[str]] = [entering.get("", []), *([] for _ in range(longest))]
    edited: list[dict[str, list[tuple[str, int]]]] = [{} for _ in range(longest + 1)]
    before, dead = "", longest + 1
    for word in words:
        shared = len(commonprefix((before, word)))
        if shared >= dead:  # no band reaches into this range
            continue
        before, dead = word, longest + 1
        for depth in range(shared, len(word)):
            letter = word[depth]
            same: list[str] = []
            cells: dict[str, list[tuple[str, int]]] = {}
            for asker, done in edited[depth].get(letter, ()):
                done += 1
                cells.setdefault(asker[done : done + 1], []).append((asker, done))
            for asker in equal[depth]:
                if asker[depth : depth + 1] == letter:
                    same.append(asker)
                    continue
                # the edit: a letter more in the word, replaced, or a letter less
                cells.setdefault(asker[depth : depth + 1], []).append((asker, depth))
                if depth < len(asker):
                    cells.setdefault(asker[depth + 1 : depth + 2], []).append((asker, depth + 1))
                    if asker[depth + 1 : depth + 2] == letter:
                        cells.setdefault(asker[depth + 2 : depth + 3], []).append((asker, depth + 2))
            if first <= depth + 1 <= last:
                same += entering.get(word[: depth + 1], ())
            equal[depth + 1], edited[depth + 1] = same, cells
            if depth + 1 >= last and not same and not cells:
                dead = depth + 1
                break
        else:
            near = [asker for asker, _ in edited[len(word)].get("", ())]
            near += [asker for asker in equal[len(word)] if len(asker) == len(word) + 1]
            if near:
                yield word, near


def may_reach(asker: str, prefix: str) -> bool:
    """Whether a word with this prefix, past the first half of ``asker``, can be
    near it."""
    d = len(commonprefix((asker, prefix)))
    if d in (len(asker), len(prefix)):
        return True
    return (
        asker[d + 1 :].startswith(prefix[d + 1 :])
        or asker[d:].startswith(prefix[d + 1 :])
        or asker[d + 1 :].startswith(prefix[d:])
    )


def _route(bounds: dict[int, list[tuple[str, str, int]]]):
    """Sends each word to the blocks that may hold its near words."""
    result = pa.schema([("block", pa.int32()), ("side", pa.int32()), ("key", pa.string())])
    edges = {side: ([x[0] for x in b], [x[1] for x in b], [x[2] for x in b], [commonprefix(x[:2]) for x in b]) for side, b in bounds.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: tuple[list[int], list[int], list[str]] = ([], [], [])
            for side, key in zip(rows["side"].to_pylist(), rows["key"].to_pylist()):
                lows, highs, blocks, prefixes = edges[side]
                start = key[: half(key)]
                i, stop = bisect_left(highs, start), bisect_right(lows, start + "\U0010ffff")
                for at in range(i, stop):
                    if len(prefixes[at]) <= len(start) or may_reach(key, prefixes[at]):
                        for values, value in zip(out, (blocks[at], side, key)):
                            values.append(value)
            yield output(result, block=out[0], side=out[1], key=out[2])

    return route


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("most", pa.int64()), ("best", pa.string())])


def _scan_block(words: pa.Table, askers: pa.Table) -> pa.Table:
    """Number of near words in the block and the best of them, per asker."""
    found: dict[str, list] = {}
    for side in (FORWARD, BACKWARD):
        of = lambda t: t.filter(pc.equal(t["side"], side))  # noqa: B023, E731
        mine = of(words)
        counts = dict(zip(mine["key"].to_pylist(), mine["n"].to_pylist()))
        for key, near in scan(sorted(counts), of(askers)["key"].to_pylist()):
            word = key[::-1] if side else key
            n = counts[key]
            for asker in near:
                h = half(asker)
                if side and key[len(key) - h :] == asker[len(asker) - h :]:
                    continue  # reported from the left
                name = asker[::-1] if side else asker
                best = found.setdefault(name, [0, 0, ""])
                best[0] += 1
                if n > best[1] or n == best[1] and word < best[2]:
                    best[1:] = n, word
    return pa.table(
        {
            "word": pa.array(list(found), pa.string()),
            "n_near": pa.array([b[0] for b in found.values()], pa.int64()),
            "most": pa.array([b[1] for b in found.values()], pa.int64()),
            "best": pa.array([b[2] for b in found.values()], pa.string()),
        },
        schema=_FOUND,
    )


def near_words(words: DataFrame, store: Store, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, most, best) of each word with a near one: their number, the
    best one's occurrences, the best one. ``words`` is a stored (word, n)."""
    spark = words.sparkSession
    sides = [
        words.select(F.lit(FORWARD).alias("side"), F.col("word").alias("key"), "n"),
        words.select(F.lit(BACKWARD).alias("side"), F.reverse("word").alias("key"), "n"),
    ]
    parts = max(-(-2 * words.count() // block_words), spark.sparkContext.defaultParallelism)
    ranged = sides[0].unionByName(sides[1]).repartitionByRange(parts, "side", "key")
    ranged = store.put(ranged.withColumn("block", F.spark_partition_id()), "sorted")
    bounds: dict[int, list[tuple[str, str, int]]] = defaultdict(list)
    for r in ranged.groupBy("side", "block").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect():
        bounds[r["side"]].append((r["low"], r["high"], r["block"]))
    for listed in bounds.values():
        listed.sort()
    askers = ranged.select("side", "key").mapInArrow(_route(dict(bounds)), "block int, side int, key string")
    found = (
        ranged.groupBy("block")
        .cogroup(askers.groupBy("block"))
        .applyInArrow(_scan_block, "word string, n_near long, most long, best string")
    )
    best = F.min(F.struct((-F.col("most")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("most"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame, store: Store) -> DataFrame:
    """(word, root): where the chain of (word, form) ends. Each round a word's
    pointer becomes that of the word it points at."""
    pointers = store.put(forms.select("word", F.col("form").alias("root")), "pointers")
    for _ in range(MAX_ROUNDS):
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pointers.join(ahead, "root", "left")
        pointers = store.put(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "pointers"
        )
        if pointers.filter("moved").isEmpty():
            return pointers.select("word", "root")
    raise RuntimeError(f"forms did not end in {MAX_ROUNDS} rounds")


def variants(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (distinct
    ``word``, ``n``)."""
    store = Store(words.sparkSession)
    words = store.put(words, "words")
    near = near_words(words, store, block_words)
    formed = F.col("most") >= ratio * F.col("n")
    listed = store.put(
        words.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("most")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(listed.filter("form is not null"), store)
    return listed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def report(docs: DataFrame) -> DataFrame:
    """The words of ``documents`` with their forms."""
    return variants(document_words(docs))
