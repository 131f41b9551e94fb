"""The stored past of all customers, brought up to date load by load.

Customers are dealt into buckets by id. A fold reads the new partial rows and the buckets that hold their customers, and writes these buckets
anew; all others stay the files that they are. A manifest lists the files that count, and writing it is the last step: a fold that fails
leaves the state as it was, and its transactions are folded by the next one. Files that a fold replaces are deleted by
the fold after it, so whoever is still reading them has that long. One fold runs at a time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens import contract as C
from patronlens.operators.incremental import PARTIALS, STATE, day_partials, folded, per_customer
from patronlens.shared import children, create_once, delete, exists
from patronlens.streaming.jobs import each_new_batch

MANIFEST = "bucket int, path string, as_of date, last_batch bigint, buckets int, usual_methods array<string>"
PENDING = -1  # the place of the pending rows in the list of files
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    """The files of each bucket, of what waits for its day (``PENDING``), and what they hold."""

    version: int = 0
    files: dict[int, str] = field(default_factory=dict)
    as_of: dt.date | None = None
    last_batch: int = -1  # the last load that was folded


@dataclass(frozen=True)
class Fold:
    """What a fold did."""

    version: int
    folded: int  # transactions
    pending: int  # transactions of days after the reporting date
    buckets: list[int]  # written anew
    files_read: list[str]


@dataclass(frozen=True)
class FeatureState:
    """Below ``root``, on shared storage. ``buckets`` and ``usual_methods`` are fixed by the first fold.

    A bucket is rewritten by one task: choose ``buckets`` so that one fits.
    """

    spark: SparkSession
    root: str
    buckets: int = BUCKETS
    usual_methods: tuple[str, ...] = tuple(C.PAYMENT_METHODS)

    def manifest(self, before: int | None = None) -> Manifest:
        """The last complete one, or the last below version ``before``."""
        folder = f"{self.root}/manifest"
        complete = [int(v) for v in children(self.spark, folder) if v.isdigit() and exists(self.spark, f"{folder}/{v}/_SUCCESS")]
        complete = [v for v in complete if before is None or v < before]
        if not complete:
            return Manifest()
        rows = self.spark.read.schema(MANIFEST).parquet(f"{folder}/{max(complete)}").collect()  # one row per bucket
        first = rows[0]
        if first["buckets"] != self.buckets or tuple(first["usual_methods"]) != self.usual_methods:
            raise ValueError("the state was made with other buckets or usual methods")
        files = {row["bucket"]: row["path"] for row in rows if row["path"] is not None}
        return Manifest(max(complete), files, first["as_of"], first["last_batch"])

    def _loads(self, after: int) -> dict[int, str]:
        folder = f"{self.root}/partials"
        found = {int(v): f"{folder}/{v}" for v in children(self.spark, folder) if v.isdigit()}
        return {v: path for v, path in found.items() if v > after and exists(self.spark, f"{path}/_SUCCESS")}

    def load(self, rows: str, schema: T.StructType = C.RAW_TRANSACTIONS) -> None:
        """Combine the transactions that were added to the Parquet folder ``rows`` since the last call, per customer and day."""
        if exists(self.spark, rows):
            each_new_batch(self.spark, rows, schema, self._store, f"{self.root}/progress")

    def _store(self, batch: DataFrame, number: int) -> None:
        # a batch that is repeated after a failure replaces what it left
        day_partials(batch, list(self.usual_methods)).write.mode("overwrite").parquet(f"{self.root}/partials/{number}")

    def read(self) -> DataFrame:
        """One row per customer, as of the last fold."""
        return self._rows([path for bucket, path in self.manifest().files.items() if bucket != PENDING])

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(*paths)

    def _bucket(self):
        return F.coalesce(F.pmod(F.col("user_id"), F.lit(self.buckets)), F.lit(0)).cast("int")

    def fold(self, as_of: dt.date) -> Fold:
        """Add what was loaded, and what waited until ``as_of``; dates never go back."""
        now = self.manifest()
        if now.as_of is not None and as_of < now.as_of:
            raise ValueError(f"the state is of {now.as_of}; {as_of} needs a full computation")
        loads = self._loads(now.last_batch)
        sources = [*loads.values(), *([now.files[PENDING]] if PENDING in now.files else [])]
        arrived = self.spark.read.schema(PARTIALS).parquet(*sources) if sources else self.spark.createDataFrame([], PARTIALS)
        due = arrived.where(F.col("day").isNull() | (F.col("day") <= F.lit(as_of)))
        later = arrived.where(F.col("day") > F.lit(as_of))
        counts = {row["bucket"]: row["n"] for row in due.groupBy(self._bucket().alias("bucket")).agg(F.sum("n").alias("n")).collect()}
        waiting = later.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

        version = now.version + 1
        while not create_once(self.spark, f"{self.root}/versions/{version}"):
            version += 1
        files, touched = dict(now.files), sorted(counts)
        files.pop(PENDING, None)
        state = self._rows([now.files[bucket] for bucket in touched if bucket in now.files])
        if touched:
            path = f"{self.root}/state/{version}"
            rows = folded(state, per_customer(due)).withColumn("bucket", self._bucket())
            rows.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(path)
            files |= {bucket: f"{path}/bucket={bucket}" for bucket in touched}
        if waiting:
            files[PENDING] = f"{self.root}/pending/{version}"
            later.write.parquet(files[PENDING])
        last = max([now.last_batch, *loads])
        lines = [(bucket, path, as_of, last, self.buckets, list(self.usual_methods)) for bucket, path in files.items()]
        lines = lines or [(PENDING, None, as_of, last, self.buckets, list(self.usual_methods))]
        self.spark.createDataFrame(lines, MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest/{version}")
        self._drop_replaced(now, files)
        read = [*sources, *[now.files[bucket] for bucket in touched if bucket in now.files]]
        return Fold(version, sum(counts.values()), waiting, touched, read)

    def _drop_replaced(self, now: Manifest, files: dict[int, str]) -> None:
        """Delete what the fold before this one had replaced, and the loads that it had folded."""
        before = self.manifest(before=now.version) if now.version else Manifest()
        for path in set(before.files.values()) - set(now.files.values()) - set(files.values()):
            delete(self.spark, path)
        for number, path in self._loads(-1).items():
            if number <= before.last_batch:
                delete(self.spark, path)
