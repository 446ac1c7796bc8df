"""Merkle manifest of a dataset with a membership proof for every row.

A row's leaf is the SHA-256 of its fields, each preceded by its length in bytes.
The leaves of one group (a source), in order of their key, form a tree of the
given fan-out, and the roots of the groups, in order of their names, form one
more on top. A lone node is its own root; the last run of a level may be short.

Proofs by pointer jumping. A node holds a pointer to an ancestor and, for every
level up to it, its siblings to the left and to the right. A self-join replaces
the pointer by that of the ancestor and appends the ancestor's siblings, which
doubles the distance; the number of rounds is the logarithm of the height. A
run of leaves shares its parent's path, so the jumps move inner nodes, a
fifteenth of the rows, and the last join takes the leaves, a run at a time,
from their parents to the root.

Hot groups. Positions are numbers within range partitions plus the rows ahead
of each partition, so a group holding any share of the rows is spread over
tasks; the only grouping is by runs of ``fanout`` nodes. A join's hot key, an
ancestor that many nodes point to, meets one row, and the pointers are a stored
table, whose partitions the skew join may split.

A null field counts as ``-``, which no length can be mistaken for. Null groups
are a group of their own, the first; null keys come first in their group. Rows
of one key are ordered by their leaves, and equal rows have equal leaves, each
with its own place and proof. An empty table has no tree and gives no rows.
Further columns are of no account, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import Store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
TOP = ""  # the tree over the groups; other trees are named "0" (null) or "1" and the group
MAX_ROUNDS = 16  # distance 65,536, beyond the height of any tree
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its length in bytes, a colon, its value."""
    texts = [f.cast("string") for f in fields]
    framed = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*[F.coalesce(f, F.lit("-")) for f in framed])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path, (left, right) of each level, lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def _placed(nodes: DataFrame, order_by: Sequence[str], store: Store) -> DataFrame:
    """``nodes`` with ``pos``, from 0 within each ``tree``, and ``n``, the tree's
    size."""
    along = [F.col(c).asc_nulls_first() for c in ("tree", *order_by)]
    along.append(F.col("tie").asc())  # equal rows may part, in any order
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *along)
    ranged = ranged.sortWithinPartitions(*along).drop("tie").withColumn("at", F.monotonically_increasing_id())
    ranged = store.put(ranged, "ranged").withColumn("part", F.shiftright("at", 33))
    # a row per tree and partition
    runs = ranged.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    of_tree = Window.partitionBy("tree")
    ahead = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        "first",
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"),
        F.sum("rows").over(of_tree).alias("n"),
    )
    placed = ranged.join(store.put(runs, "runs"), ["tree", "part"])
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def _runs(level: DataFrame, fanout: int, members: Mapping[str, str]) -> DataFrame:
    """One row per run of a level: ``tree``, ``n`` of the level, ``run`` and the
    ``members`` in order."""
    member = F.struct("pos", *[F.col(c).alias(name) for name, c in members.items()])
    run = F.floor(F.col("pos") / fanout).alias("run")
    return level.groupBy("tree", "n", run).agg(F.array_sort(F.collect_list(member)).alias("members"))


def _levels(leaves: DataFrame, fanout: int, store: Store) -> list[DataFrame]:
    """(tree, n, pos, digest, children) of the inner nodes, one table a level
    from the bottom; ``children`` are the digests below."""
    size = leaves.agg(F.max("n")).first()[0] or 0
    level, levels = leaves.select("tree", "n", "pos", "digest"), []
    while size > 1:
        size = -(-size // fanout)
        runs = _runs(level.filter("n > 1"), fanout, {"digest": "digest"})
        level = store.put(
            runs.select(
                "tree",
                F.ceil(F.col("n") / fanout).alias("n"),
                F.col("run").alias("pos"),
                digest(F.array_join("members.digest", "")).alias("digest"),
                F.col("members.digest").alias("children"),
            ),
            f"level{len(levels) + 1}",
        )
        levels.append(level)
    return levels


def _node(tree: Column, level: int, pos: Column) -> Column:
    return F.struct(tree.alias("tree"), F.lit(level).alias("level"), pos.cast("long").alias("pos"))


def _siblings(children: Column, at: Column) -> Column:
    """(left, right) of the child at 0-based ``at``."""
    others = lambda start, length: F.array_join(F.slice(children, start, length), "")
    return F.struct(
        F.when(at > 0, others(F.lit(1), F.greatest(at, F.lit(1)))).otherwise("").alias("left"),
        others(at + 2, F.size(children)).alias("right"),
    )


def _links(levels: Sequence[DataFrame], bottom: int, fanout: int) -> list[DataFrame]:
    """(id, up, path) from every child at level ``bottom`` and above to its
    parent; the path is one step."""
    parts = []
    for number, level in enumerate(levels):
        if number < bottom:
            continue
        child = level.select("tree", "pos", "children", F.posexplode("children").alias("at", "digest"))
        parts.append(
            child.select(
                _node(F.col("tree"), number, F.col("pos") * fanout + F.col("at")).alias("id"),
                _node(F.col("tree"), number + 1, F.col("pos")).alias("up"),
                F.array(_siblings(F.col("children"), F.col("at"))).alias("path"),
            )
        )
    return parts


def jump(links: DataFrame, store: Store) -> DataFrame:
    """(id, path): the whole way from every node to its root. ``links`` has
    ``id``, ``up`` (null at the root) and the ``path`` between them."""
    pointers = store.put(links, "pointers")
    for _ in range(MAX_ROUNDS):
        open_ends = pointers.filter("up is not null")
        if open_ends.isEmpty():
            return pointers.select("id", "path")
        above = pointers.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("rest"))
        longer = open_ends.join(above, "up").select("id", F.col("next").alias("up"), F.concat("path", "rest").alias("path"))
        pointers = store.put(longer.unionByName(pointers.filter("up is null")), "pointers")
    raise RuntimeError(f"pointers did not reach a root in {MAX_ROUNDS} rounds")


def proofs(leaves: DataFrame, store: Store, fanout: int = FANOUT, carry: Sequence[str] = ()) -> DataFrame:
    """(group, key, leaf, *carry, position, subroot, root, path) of each row of
    ``leaves`` (group, key, leaf, *carry); ``path`` has one (left, right) of
    siblings for each level, from the leaf to the root."""
    tree = F.coalesce(F.concat(F.lit("1"), F.col("group").cast("string")), F.lit("0"))
    placed = _placed(leaves.withColumn("tree", tree), ["key", "leaf"], store).withColumnRenamed("leaf", "digest")
    levels = _levels(placed, fanout, store)
    # roots of the groups: the only node of their last level
    roots = [
        nodes.filter("n = 1").select("tree", "digest", F.lit(number).alias("level"))
        for number, nodes in enumerate([placed, *levels])
    ]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    named = store.put(subroots, "subroots").select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest", "level"
    )
    groups = store.put(_placed(named, ["of"], store), "groups")
    top = _levels(groups, fanout, store)
    last = (top[-1] if top else groups).select("digest").first()
    if last is None:
        last = [None]

    none = F.array().cast("array<struct<left:string,right:string>>")
    down = groups.select(F.col("of").alias("tree"), "level", F.lit(0).cast("long").alias("pos"))
    joins = groups.select(  # a group's root is a leaf of the top
        F.struct(F.col("of").alias("tree"), "level", F.lit(0).cast("long").alias("pos")).alias("id"),
        _node(F.col("tree"), 0, F.col("pos")).alias("up"),
        none.alias("path"),
    )
    end = groups.filter("pos = 0").select(
        _node(F.col("tree"), len(top), F.lit(0)).alias("id"), F.lit(None).cast(down.select(F.struct("tree", "level", "pos")).schema[0].dataType).alias("up"), none.alias("path")
    )
    links = joins.unionByName(end)
    for part in [*_links(levels, 1, fanout), *_links(top, 0, fanout)]:
        links = links.unionByName(part)
    paths = jump(links, store)

    subroot = groups.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"))
    runs = _runs(placed, fanout, {"key": "key", "group": "group", "leaf": "digest", **{c: c for c in carry}})
    # the node whose path the run shares: its parent, or a lone leaf itself
    lone = F.col("n") == 1
    runs = runs.withColumn("id", F.when(lone, _node(F.col("tree"), 0, F.lit(0))).otherwise(_node(F.col("tree"), 1, F.col("run"))))
    rows = runs.join(paths, "id").join(subroot, "tree")
    rows = rows.select("n", "path", "subroot", "members", F.posexplode("members").alias("at", "row"))
    step = _siblings(F.col("members.leaf"), F.col("at"))
    return rows.select(
        "row.group",
        "row.key",
        "row.leaf",
        *[f"row.{c}" for c in carry],
        F.col("row.pos").alias("position"),
        "subroot",
        F.lit(last[0]).alias("root"),
        F.when(lone, F.col("path")).otherwise(F.concat(F.array(step), F.col("path"))).alias("path"),
    )


def manifest(
    docs: DataFrame,
    presented: Column | None = None,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    fanout: int = FANOUT,
) -> DataFrame:
    """(group, key, leaf, presented, position, subroot, root, path) of each row.
    ``presented`` is the leaf that a holder of the data presents, by default
    the row's own; :func:`fold` tells whether it belongs to the root."""
    store = Store(docs.sparkSession)
    leaf = leaf_digest([F.col(f) for f in fields])
    leaves = docs.select(
        F.col(group).alias("group"),
        F.col(key).alias("key"),
        leaf.alias("leaf"),
        (leaf if presented is None else presented).alias("presented"),
    )
    return proofs(store.put(leaves, "leaves"), store, fanout, ["presented"])


def report(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, proofs tried on rows of which a part is
    tampered with: where 5 divides the CRC-32 of doc_id, A-Z of the text are
    presented in lower case."""
    fields = {f: F.col(f) for f in FIELDS}
    tampered = leaf_digest([*(fields | {"text": lower_ascii(F.col("text"))}).values()])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = manifest(docs, F.when(chosen, tampered).otherwise(leaf_digest([*fields.values()])))
    whole = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    found = found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(whole, 256).alias("proof_sha256"),
        fold(F.col("presented"), F.col("path")).alias("folded_root"),
        F.size("path").cast("long").alias("height"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
