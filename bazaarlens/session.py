"""Session helpers: adaptive skew handling and written intermediates.

A frame that several passes must see unchanged, or whose real size the planner should know, is written as a
parquet table below the shared folder the cluster names in ``spark.checkpoint.dir``. A written table survives the
loss of executors and carries file sizes, so Catalyst decides broadcast or shuffle join from facts.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_databases: dict[str, str] = {}
_borrowed: list[str] = []

# A hot key on the big side of a join is split even where the split costs one more shuffle above the join.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prefer_skew_handling(spark: SparkSession) -> None:
    """Turn on adaptive skew handling where the session leaves it open."""
    for key, value in SKEW_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``, else a folder of the session's warehouse.

    A cluster must name the checkpoint folder; only a local session falls back to its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_database(spark: SparkSession) -> str:
    """The database of this process's intermediates, located in the shared folder."""
    root = scratch_root(spark)
    if root not in _databases:
        name = f"scratch_{uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/{name}'")
        _databases[root] = name
    return _databases[root]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the scratch database's folder; it goes with the database."""
    return f"{scratch_root(spark)}/{scratch_database(spark)}/{label}-{uuid4().hex}"


def passing_database(spark: SparkSession, kind: str) -> str:
    """A new database in scratch that goes when scratch is cleared."""
    name = f"{kind}_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, kind)}'")
    _borrowed.append(name)
    return name


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this process has written to scratch; frames composed on it cannot be read afterwards."""
    for name in (*_borrowed, *_databases.values()):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    _borrowed.clear()
    _databases.clear()


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
