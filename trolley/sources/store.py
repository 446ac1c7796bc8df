"""Tables written to the shared scratch folder.

Writing a result cuts its lineage, survives a lost executor, keeps column
pruning for its readers, and gives Catalyst its true size: a small stored
table is broadcast because its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, a large one is not. No join in this
library carries a broadcast hint.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1 << 19  # a task sorts and joins whole buckets: about 0.25 GB of memory


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private temporary one
    only for a local session that names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="trolley-"))
    return context.getCheckpointDir().rstrip("/")


class Store:
    """Writes tables under one fresh folder and reads them back. As a context
    manager it removes them at its end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tag = f"trolley_{uuid.uuid4().hex[:12]}"
        self.root = f"{scratch_root(spark)}/{self.tag}"
        self._tables: list[str] = []

    def path(self, name: str) -> str:
        """A path of its own for each call, so that nothing a lazy result still
        reads is overwritten."""
        return f"{self.root}/{uuid.uuid4().hex[:8]}_{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def put_partitioned(
        self, df: DataFrame, name: str, columns: Sequence[str]
    ) -> DataFrame:
        """Write one folder per value of ``columns``, so that a filter on them
        reads only its folders."""
        path = self.path(name)
        df.write.partitionBy(*columns).parquet(path)
        return self.spark.read.parquet(path)

    def put_bucketed(
        self,
        df: DataFrame,
        name: str,
        keys: Sequence[str],
        buckets: int,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write hash-bucketed on ``keys``: later joins and groupings on them
        read co-located buckets instead of shuffling."""
        table = f"{self.tag}_{name}_{uuid.uuid4().hex[:8]}"
        writer = (
            df.repartition(buckets, *[F.col(k) for k in keys])
            .write.format("parquet")
            .option("path", f"{self.root}/{table}")
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def close(self) -> None:
        """Remove the store's tables and its files. Results that still read them
        must have been computed."""
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.root)
        root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)

    def __enter__(self) -> Store:
        return self

    def __exit__(self, *raised: object) -> None:
        self.close()

    def buckets_for(self, rows: int) -> int:
        """One bucket per ``ROWS_PER_BUCKET`` rows, at least one per core, and no
        more than Spark allows."""
        wanted = max(self.spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_BUCKET))
        return min(wanted, int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


class Ledger:
    """Results kept under what they were made from, so that a job that was
    broken off goes on where it ended, also in another session.

    An entry is written to a folder of its own and counts once its mark is
    written behind it; half an entry is never read. The folder is that of
    ``spark.checkpoint.dir`` and has to be cleared by its owner."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{scratch_root(spark)}/trolley_ledger"

    def key(self, *parts: object) -> str:
        return hashlib.sha256(json.dumps(parts, sort_keys=True, default=repr).encode()).hexdigest()[:32]

    def fingerprint(self, df: DataFrame) -> str:
        """Of the rows, whatever their order and layout."""
        columns = sorted(df.columns)
        row = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("h")).agg(
            F.count("*"), F.bit_xor("h"), F.bit_xor(F.xxhash64("h", F.lit(1))), F.sum(F.shiftright("h", 24))
        )
        return self.key(columns, df.select(*[f"`{c}`" for c in columns]).schema.simpleString(), *row.first())

    def model(self, key: str, fit: Callable[[], object]) -> object:
        """The saved model of ``key``, or that of ``fit``, which is saved."""
        from pyspark.ml.util import DefaultParamsReader

        found = self._entry(key)
        if found:
            return DefaultParamsReader.loadParamsInstance(found, self.spark)
        made = fit()
        self._enter(key, lambda path: made.write().save(path))
        return made

    def table(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The saved table of ``key``, or that of ``build``, which is saved."""
        found = self._entry(key) or self._enter(key, lambda path: build().write.parquet(path))
        return self.spark.read.parquet(found)

    def _entry(self, key: str) -> str | None:
        files, folder = self._files(f"{self.root}/{key}")
        if not files.exists(folder):
            return None
        for entry in files.listStatus(folder):
            path = entry.getPath().toString()
            if files.exists(self._path(f"{path}/done")):
                return f"{path}/result"
        return None

    def _enter(self, key: str, write: Callable[[str], None]) -> str:
        entry = f"{self.root}/{key}/{uuid.uuid4().hex[:8]}"
        write(f"{entry}/result")
        files, mark = self._files(f"{entry}/done")
        files.create(mark).close()
        return f"{entry}/result"

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, name: str):
        path = self._path(name)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path


def store_tables(tables: dict[str, DataFrame], store: Store) -> dict[str, DataFrame]:
    """The source tables as stored columnar tables. Orders and lines are
    bucketed on order_id, so joining and grouping on it reads without a
    shuffle."""
    buckets = store.buckets_for(tables["prior"].count())
    by_order = ("orders", "prior", "train")
    return {
        name: store.put_bucketed(frame, name, ["order_id"], buckets)
        if name in by_order
        else store.put(frame, name)
        for name, frame in tables.items()
    }
