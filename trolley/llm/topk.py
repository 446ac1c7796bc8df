"""Exact top-k inner-product search by block-at-a-time pruning.

Components become the integers floor(scale * x). Candidates are dealt by range
of a locality code and their id into document-range blocks; a block is a small
forward index, its vectors, with the largest and smallest value of every
dimension. For a query, the summed maxima bound every score in a block. In each
group of blocks a query visits blocks in falling order of their bounds and
scores them whole, until the next bound lies below its k-th score; ties go to
the smaller id, so a bound equal to the k-th score is still visited. The groups'
best are merged per query.

Every query meets every group, in chunks of queries by groups of blocks; that is
the stated set of queries against all rows. A vector that is null, or holds
a null or non-finite component, takes no part. Shorter vectors count as
padded with zeros. Rows may repeat; a query's own rows are those with its id.
Rows without an id are no candidates. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.store import Store
from .packing import block_numbers, freeze, thaw
from .text import bound_batches, output

BLOCK_ROWS = 256
GROUP_ROWS = 16_384
CHUNK_QUERIES = 1_024
CODE_BITS = 12
NO_ID = np.iinfo(np.int64).max
NO_SCORE = -NO_ID


def quantized(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, code, values array<long>) of the vectors that take part; ``code`` holds
    the signs of fixed projections, alike for near vectors."""
    kept = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("raw")
    ).filter("id is not null and raw is not null")
    kept = kept.filter(F.forall("raw", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    scaled = F.transform("raw", lambda x: F.floor(x * scale).cast("long"))
    result = pa.schema([("id", pa.int64()), ("code", pa.int32()), ("values", pa.list_(pa.int64()))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch["values"])
            planes = np.random.default_rng(7).standard_normal((max(matrix.shape[1], 1), CODE_BITS))[: matrix.shape[1]]
            code = ((matrix @ planes) > 0) @ (1 << np.arange(CODE_BITS))
            yield output(result, id=batch["id"], code=code, values=batch["values"])

    return kept.select("id", scaled.alias("values")).mapInArrow(coded, "id long, code int, values array<long>")


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows padded with zeros to the longest."""
    lengths = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    width = int(lengths.max(initial=0))
    matrix = np.zeros((len(lengths), width), np.int64)
    matrix[np.arange(width)[None, :] < lengths[:, None]] = flat
    return matrix


def _packed(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    top = int(np.abs(matrix).max(initial=0))
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
    return freeze(ids=ids, values=matrix.astype(kind).reshape(-1), rows=len(ids))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = thaw(data)
    return parts["ids"], parts["values"].reshape(parts["rows"], -1).astype(np.int64)


def _chunks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(group, part, data): the rows of each partition as packed matrices of at
    most ``size`` vectors."""
    result = pa.schema([("group", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = next(block_numbers()) >> 32
        held: list[pa.RecordBatch] = []
        count = part = 0

        def close(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(tables).combine_chunks()
            ids = table["id"].to_numpy()
            return output(result, group=[group], part=[part], data=[_packed(ids, _matrix(table["values"].combine_chunks()))])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                taken = min(size - count, batch.num_rows - start)
                held.append(batch.slice(start, taken))
                count, start = count + taken, start + taken
                if count == size:
                    yield close(held)
                    held, count, part = [], 0, part + 1
        if held:
            yield close(held)

    return rows.select("id", "values").mapInArrow(pack, "group long, part int, data binary")


def _product(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    width = min(queries.shape[1], block.shape[1])
    queries, block = queries[:, :width], block[:, :width]
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(width, 1)
    if bound < 1 << 53:  # exact in doubles
        return (queries.astype(np.float64) @ block.T.astype(np.float64)).astype(np.int64)
    if bound >= 1 << 63:
        raise ValueError("an inner product may not fit 64 bits")
    return queries @ block.T


def search_group(query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int):
    """The k best of the blocks for each query: (query number, id, score)."""
    count = len(query_ids)
    bounds = np.empty((count, len(blocks)))
    for b, (_, matrix) in enumerate(blocks):
        width = min(queries.shape[1], matrix.shape[1])
        q = queries[:, :width].astype(np.float64)
        top, low = matrix[:, :width].max(axis=0), matrix[:, :width].min(axis=0)
        bounds[:, b] = np.maximum(q, 0) @ top + np.minimum(q, 0) @ low
    bounds = np.ceil(bounds * (1 + 1e-12) + 1e-6)  # over any rounding
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_score = np.full((count, k), NO_SCORE)
    best_id = np.full((count, k), NO_ID)
    active = np.arange(count)
    for turn in range(len(blocks)):
        target = order[active, turn]
        alive = bounds[active, target] >= best_score[active, k - 1]
        active, target = active[alive], target[alive]
        if not len(active):
            break
        for b in np.unique(target):
            who = active[target == b]
            ids, matrix = blocks[b]
            scores = _product(queries[who], matrix)
            own = ids[None, :] == query_ids[who][:, None]
            all_scores = np.concatenate([best_score[who], np.where(own, NO_SCORE, scores)], axis=1)
            all_ids = np.concatenate(
                [best_id[who], np.where(own, NO_ID, np.broadcast_to(ids, scores.shape))], axis=1
            )
            rank = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best_score[who] = np.take_along_axis(all_scores, rank, axis=1)
            best_id[who] = np.take_along_axis(all_ids, rank, axis=1)
    number, slot = np.nonzero(best_id != NO_ID)
    return number, best_id[number, slot], best_score[number, slot]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of ``vectors``."""
    spark = vectors.sparkSession
    bound_batches(spark)
    store = Store(spark)
    candidates = store.put(quantized(vectors, scale, id_col, vector_col), "quantized")
    groups = max(1, -(-candidates.count() // GROUP_ROWS))
    ranged = candidates.repartitionByRange(groups, "code", "id").sortWithinPartitions("code", "id")
    blocks = store.put(_chunks(ranged, BLOCK_ROWS, "blocks"), "blocks")
    asked = quantized(queries, scale, id_col, vector_col).distinct()
    chunks = store.put(_chunks(asked, CHUNK_QUERIES, "queries"), "queries")
    last = blocks.agg(F.max("group")).first()[0]
    if last is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Each chunk goes to each group, each group to each chunk: both by key.
    calls = chunks.select(
        F.col("group").alias("chunk"), F.col("part").alias("chunk_part"), F.col("data"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(last)).cast("long"))).alias("called"),
    )
    held = store.put(blocks.select("group").distinct(), "groups")
    calls = calls.join(held.select(F.col("group").alias("called")), "called", "left_semi")
    wanted = calls.select(F.col("called").alias("group"), F.col("chunk").alias("c"), F.col("chunk_part").alias("p"))
    sent = blocks.select("group", F.col("part").alias("block_part"), F.col("data").alias("block")).join(wanted, "group")
    schema = "chunk long, chunk_part int, number int, query_id long, vec_id long, score long"
    result = pa.schema(
        [
            ("chunk", pa.int64()),
            ("chunk_part", pa.int32()),
            ("number", pa.int32()),
            ("query_id", pa.int64()),
            ("vec_id", pa.int64()),
            ("score", pa.int64()),
        ]
    )

    def visit(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return result.empty_table()
        ids, matrix = _unpacked(asked["data"][0].as_py())
        number, found, score = search_group(ids, matrix, [_unpacked(x) for x in held["block"].to_pylist()], k)
        n = len(number)
        return pa.table(
            [
                pa.array(np.full(n, asked["chunk"][0].as_py()), pa.int64()),
                pa.array(np.full(n, asked["chunk_part"][0].as_py()), pa.int32()),
                pa.array(number, pa.int32()),
                pa.array(ids[number], pa.int64()),
                pa.array(found, pa.int64()),
                pa.array(score, pa.int64()),
            ],
            schema=result,
        )

    met = calls.groupBy("called", "chunk", "chunk_part").cogroup(sent.groupBy("group", "c", "p")).applyInArrow(visit, schema)
    order = Window.partitionBy("chunk", "chunk_part", "number").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def report(vectors: DataFrame) -> DataFrame:
    return search(vectors, vectors.filter("vec_id % 100 = 0"))
