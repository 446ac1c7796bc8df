"""Plain, slow versions of the training-data operators, straight from their
contracts, and the small tables they are tried on."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(rb"[^\x20\x09-\x0D]+")

EDGES = [
    (9001, None, "en", "a", 0),
    (9002, "", "en", "a", 0),
    (9003, " \t\n\v\f\r ", "en", "a", 7),
    (9004, "One", "en", "a", 3),
    (9005, "one TWO", None, None, None),
    (9006, "x'll don't  it's 12 ab\x1cé　漢字!!\n\n", "en", "a", 1),
    (9007, "same words here and here again, " * 30, "en", "a", 1),
    (9008, "same words here and here again, " * 30, "en", "a", 1),
    (9008, "same words here and here again, " * 30, "en", "a", 1),
    (9009, "a b " * 3000, "en", "a", 1),
    (9010, "Released under the MIT License. All rights reserved. CC-BY; cc by cc by", "en", "a", 1),
    (9011, "licensed under the Apache License, Version 2.0. the GNU General Public License", "en", "a", 1),
    (9012, "\x00\x00nul \x00a", "en", "a", 1),
    (9013, "x" * 50_000, "en", "a", 1),
]


def documents(spark, edges=EDGES):
    given = spark.read.parquet(f"{DATA}/documents.parquet")
    return given.unionByName(spark.createDataFrame(edges, SCHEMA))


def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def simhash(docs):
    prints = {}
    for doc, text in docs:
        w = SOLID.findall(lower(text))
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[doc] = sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))
    return prints, components(prints, 2)


def components(prints, distance):
    root = {doc: doc for doc in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc: find(doc) for doc in ids}


def licenses(docs):
    phrases = {"cc-by": b"cc by", "gpl": b"general public license", "reserved": b"all rights reserved"}
    result = []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        places = []
        for label, phrase in phrases.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        result.append((doc, len(w), len(places), min(starts, default=None), max(starts, default=None), labels))
    return result


def topk(vectors, k=10):
    kept = []
    for number, v in vectors:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((number, [math.floor(1024 * x) for x in v]))
    result = []
    for q, qv in kept:
        if q % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in kept if i != q)[:k]
        result += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, start=1)]
    return sorted(result)


def base_scores(docs):
    held = lambda doc: zlib.crc32(str(doc).encode()) % 7 == 2
    end = object()
    tokens = [(doc, [*SOLID.findall(lower(text)), end]) for doc, text in docs]
    counts = Counter(t for doc, ts in tokens if not held(doc) for t in ts)
    n, v = sum(counts.values()), len(counts)
    return [
        (doc, held(doc), len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        for doc, ts in tokens
    ]


def contamination(docs, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        if w:
            for s in range(max(1, len(w) - size + 1)):
                windows[tuple(w[s : s + size])].add(item)
    lengths = {len(w) for w in windows}
    result = []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if found := windows.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    names |= found
        names.discard(None)
        listed = ",".join(sorted(map(str, names))).encode()
        result.append((doc, len(w), len(hit), len(names), sha(listed), bool(hit) and 20 * len(hit) >= len(w)))
    return result


def removed(docs, size=20):
    """``docs`` in any order; of repeated ids the one listed first is earlier."""
    first, gone = {}, defaultdict(set)
    split = [(doc, SOLID.findall(text.encode())) for doc, text in docs]
    for n, (doc, w) in sorted(enumerate(split), key=lambda x: (x[1][0], x[0])):
        for s in range(len(w) - size + 1):
            window = tuple(w[s : s + size])
            if window in first:
                gone[n].update(range(s, s + size))
            else:
                first[window] = n
    result = []
    for n, (doc, w) in enumerate(split):
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone[n])
        result.append((doc, len(w), len(gone[n]), sha(kept)))
    return result


def _hashed(parts):
    return sha("".join(parts).encode())


def _folded(digests, fanout=16):
    """Levels of a tree, from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_hashed(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def merkle(docs):
    """``docs`` are (doc_id, text, lang, source, n_chars)."""

    def leaf(doc, text, lang, source, n):
        fields = [None if f is None else str(f) for f in (doc, source, lang, n, text)]
        return _hashed("-" if f is None else f"{len(f.encode())}:{f}" for f in fields)

    def order(row):
        return row[0] is not None, row[0] or 0, leaf(*row)

    groups = defaultdict(list)
    for row in docs:
        groups[row[3]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=order)
        trees[name] = _folded([leaf(*row) for row in groups[name]])
    top = _folded([trees[name][-1][0] for name in names])
    result = []
    for rank, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            doc, text, *rest = row
            node = leaf(*row)
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
                node = leaf(doc, lower(text).decode(), *rest)
            proof, height = "", 0
            for start, levels in ((at, trees[name]), (rank, top)):
                for level in levels[:-1]:
                    run = level[start // 16 * 16 : start // 16 * 16 + 16]
                    left, right = "".join(run[: start % 16]), "".join(run[start % 16 + 1 :])
                    proof, node, start, height = proof + left + right, _hashed([left, node, right]), start // 16, height + 1
            root = top[-1][0]
            result.append((doc, leaf(*row), trees[name][-1][0], root, sha(proof.encode()), node, height, node == root))
    return sorted(result, key=str)


def words_of(docs):
    """Counts of the runs of letters, one in 31 of them without one code point."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = lower(run).decode()
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def spelling(counts, ratio=10):
    def distance_one(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        rest = b if len(a) < len(b) else None
        for i in range(len(b)):
            if rest is None and a[:i] == b[:i] and a[i + 1 :] == b[i + 1 :]:
                return True
            if rest is not None and a == b[:i] + b[i + 1 :]:
                return True
        return False

    by_length = defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    forms, near_counts = {}, {}
    for w in counts:
        near = [o for size in range(len(w) - 1, len(w) + 2) for o in by_length[size] if distance_one(w, o)]
        near_counts[w] = len(near)
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    result = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.append((w, forms[w], root, n, near_counts[w], counts.get(forms[w])))
    return sorted(result, key=str)


def minhash(docs, percent=80):
    """``docs`` in any order, ids may repeat: rows are judged by their texts."""
    sets = []
    for _, text in docs:
        w = SOLID.findall(lower(text))
        sets.append({tuple(w[i : i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if not a or not b or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    result = []
    for i, (doc, _) in enumerate(docs):
        label = None if doc is None else least[find(i)]
        result.append((doc, len(sets[i]), label, doc is not None and doc == label))
    return sorted(result, key=str)
