"""A plain parquet table of rows with a unique key, merged by rewriting only the buckets that changes touch.

Rows lie in buckets by a hash. A version writes the touched buckets into a folder of its own, and then a manifest: for
each bucket the folder that holds it. Files are never changed, and the manifest is what makes a version visible: a merge
that fails before has no effect, and one that is repeated under the same number starts from the version before it and
gives the same rows. Buckets that a version does not touch stay in the files they were in.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlens.session import prefer_skew_handling

GONE = "gone"  # a change with this flag takes its key out of the table


class KeyedTable:
    """``schema`` holds the ``key`` columns, all of them not NULL; rows are put into buckets by ``by``, some of the key.

    ``buckets`` should make one of them hold about a gigabyte, ``files`` is the number of files it is written in; both
    stay what they were when the table began.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], by: list[str] | None = None, buckets: int = 16, files: int = 1):
        self.spark, self.path, self.schema, self.key, self.by, self.buckets, self.files = spark, path.rstrip("/"), schema, key, by or key, buckets, files
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self._last: tuple[int, dict[int, str]] | None = None  # what this object wrote last
        prefer_skew_handling(spark)

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int"))

    def manifest(self, before: int | None = None) -> dict[int, str]:
        """The folder of each bucket in the latest version (below ``before``); at most ``buckets`` rows."""
        if before is not None and self._last and self._last[0] < before:
            return self._last[1]
        try:
            known = self.spark.read.schema("bucket int, folder string, version long").parquet(f"{self.path}/manifest")
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            self._last = -1, {}
            return {}
        known = known.where(F.lit(True) if before is None else F.col("version") < before)
        held = known.groupBy("version").agg(F.collect_list(F.struct("bucket", "folder")).alias("held")).orderBy(F.desc("version")).limit(1).collect()
        return {r["bucket"]: r["folder"] for row in held for r in row["held"] if r["folder"]}

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the latest version (below ``before``), with ``bucket``; ``buckets``: of these only."""
        held = self.manifest(before)
        paths = [f"{self.path}/data/{folder}/bucket={b}" for b, folder in sorted(held.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], f"{self.schema}, bucket int")
        return self.bucketed(self.spark.read.schema(self.schema).parquet(*paths))

    def rows(self) -> DataFrame:
        return self.read().drop("bucket")

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that hold keys of the changes, at most ``buckets``."""
        return sorted(r[0] for r in self.bucketed(changes.select(*self.by)).select("bucket").distinct().collect())

    def merge(self, changes: DataFrame, version: int) -> list[int]:
        """Put the changes in place of what has their keys; returns the touched buckets.

        Of changes with one key the largest row counts, one that is ``gone`` before all others. The changes are read
        twice, so they should be a written table. Old rows and changes are shuffled once, to the files they end in, and
        meet there.
        """
        if GONE not in changes.columns:
            changes = changes.withColumn(GONE, F.lit(False))
        others = [c for c in self.columns if c not in self.key]
        touched = self.touched(changes)
        if touched:
            old = self.read(version, touched).select(*self.columns, F.lit(False).alias(GONE), F.lit(False).alias("fresh"))
            both = old.unionByName(changes.select(*self.columns, GONE, F.lit(True).alias("fresh")))
            last = self._dealt(both, touched).groupBy("bucket", "file", *self.key).agg(F.max(F.struct("fresh", GONE, *others)).alias("last"))
            self.replace(touched, last.where(~F.col(f"last.{GONE}")).select(*self.key, *[f"last.{c}" for c in others], "bucket"), version, True)
        return touched

    def _dealt(self, rows: DataFrame, buckets: list[int]) -> DataFrame:
        """Rows at the task that writes their file."""
        spread = F.pmod(F.xxhash64(*self.key, F.lit("file")), F.lit(self.files))
        return self.bucketed(rows).withColumn("file", spread).repartition(len(buckets) * self.files, "bucket", "file")

    def replace(self, buckets: list[int], rows: DataFrame, version: int, dealt: bool = False) -> None:
        """Make ``rows`` all that these buckets hold; ``dealt``: they have their ``bucket`` and lie where it is written."""
        if not buckets:
            return
        placed = rows if dealt else self._dealt(rows.select(*self.columns), buckets).drop("file")
        folder = f"{version:012d}-{uuid4().hex[:8]}"
        seen = Observation()
        before = self.manifest(version)
        placed.observe(seen, F.collect_set("bucket").alias("written")).write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        held = {b: f for b, f in before.items() if b not in buckets} | {b: folder for b in seen.get["written"]}
        listed = [(b, f) for b, f in sorted(held.items())] or [(-1, None)]  # an empty table is a version as well
        out = self.spark.createDataFrame(listed, "bucket int, folder string").coalesce(1)
        out.write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        self._last = version, held
