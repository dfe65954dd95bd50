"""Files for Python workers: the package itself, on clusters where it is not installed, and what a query compiles for them.

They are written to the shared folder and fetched from there by each executor; they go with the scratch database.
"""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from bazaarlens.session import scratch_path

_shipped: set[str] = set()


def shared_file(spark: SparkSession, name: str, content: bytes) -> str:
    """The full address of a new file of this name and content in the shared folder; for a few megabytes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'files')}/{name}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(path, False)
    try:
        out.write(content)
    finally:
        out.close()
    return store.makeQualified(path).toString()


def ship(spark: SparkSession) -> None:
    """Give the sources of the package to all Python workers, once for an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(shared_file(spark, "bazaarlens_sources.zip", packed.getvalue()))
    _shipped.add(context.applicationId)
