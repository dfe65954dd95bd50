"""CSV drops: distributed read with declared types, and the overwrite load into raw tables.

Nothing is lost or changed in silence: every file whose name fits a table is read, columns are bound by the names in
each file's own header, and a row that doesn't fit its types is refused with its values, not turned into NULLs. An
amount with more places than its column is rounded to them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.sources.catalog import ensure_namespace, write_table
from bazaarlens.sources.schemas import FILE_ENDINGS, RAW_SCHEMAS

BROKEN, REFUSED = "_broken_record", "_refused"
HEADERS = 16  # headers read at the same time


class Loaded(NamedTuple):
    written: int
    refused: int


def find_csv_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths of all raw files present in ``folder``, by table; absent tables are reported and skipped.

    A file may be a folder of parts. Its name starts at a separator: "order_items_..." must not be taken for "items_...".
    """
    found = {}
    for table, ending in FILE_ENDINGS.items():
        try:
            # only lists; the text is not read here
            paths = spark.read.text(f"{folder.rstrip('/')}/{{{ending},*_{ending}}}").inputFiles()
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            paths = []
        if paths:
            found[table] = sorted(paths)
        else:
            print(f"skip {table}: no file ending in {ending}")
    return found


def _by_header(spark: SparkSession, table: str, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by the order of their columns; a file with other columns is refused as a whole."""
    names = {f.name for f in T.StructType.fromDDL(RAW_SCHEMAS[table])}
    groups: dict[tuple[str, ...], list[str]] = {}

    def header_of(path: str) -> tuple[str, ...]:
        return tuple(c.strip() for c in spark.read.option("header", True).option("escape", '"').csv(path).columns)

    with ThreadPoolExecutor(HEADERS) as pool:  # a header is a job of one short task
        headers = list(pool.map(header_of, paths))
    for path, header in zip(paths, headers, strict=True):
        if header and (set(header) != names or len(header) != len(names)):
            raise ValueError(f"{path} has columns {list(header)}; {table} needs {sorted(names)}")
        if header:
            groups.setdefault(header, []).append(path)
    return groups


def _fits(text: Column, kind: T.DataType) -> Column:
    """Whether a value is one of its type, so that it would not become NULL."""
    if isinstance(kind, T.StringType):
        return text.isNull() | (F.length(text) >= 0)  # always true, and has the column read: else a short row goes unseen
    return text.isNull() | text.try_cast(kind).isNotNull()


def checked_csv_table(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """Rows of all files with their declared types, and what was refused of a row in ``_refused`` (NULL: nothing).

    Quoted commas, doubled quotes and line breaks inside text are kept. ``multiLine`` makes a file the unit of
    parallelism, so it is on only for the table with free text: its drop should come as many files. The others are split
    by block.
    """
    schema = T.StructType.fromDDL(RAW_SCHEMAS[table])
    read = None
    for header, files in _by_header(spark, table, paths).items():
        as_text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, BROKEN)])
        part = (
            spark.read.schema(as_text)
            .option("header", True)
            .option("multiLine", table == "order_reviews")
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", BROKEN)
            .csv(files)
        )
        read = part if read is None else read.unionByName(part)
    if read is None:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField(REFUSED, T.StringType())]))
    misfits = [F.when(~_fits(F.col(f.name), f.dataType), F.concat(F.lit(f"{f.name}="), F.col(f.name))) for f in schema]
    refused = F.coalesce(F.col(BROKEN), F.nullif(F.concat_ws("; ", *misfits), F.lit("")))
    return read.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], refused.alias(REFUSED))


def read_csv_table(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """One raw table; a row that would have to be refused ends the read with an error."""
    checked = checked_csv_table(spark, table, paths)
    fault = F.raise_error(F.concat(F.lit(f"{table}: row does not fit: "), F.col(REFUSED)))
    return checked.where(F.when(F.col(REFUSED).isNull(), True).otherwise(fault.cast("boolean"))).drop(REFUSED)


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: read_csv_table(spark, table, paths) for table, paths in find_csv_files(spark, folder).items()}


def load_raw(spark: SparkSession, folder: str, namespace: str, location: str | None = None) -> dict[str, Loaded]:
    """Replace the raw tables by the files of ``folder``; rows written and refused per table.

    The text is parsed once, straight into the table, and refused rows are counted on the way. They are kept in
    ``<table>_refused`` with the values that don't fit; only if there are any, the text is parsed again for them.
    """
    ensure_namespace(spark, namespace, location)
    loaded = {}
    for table, paths in find_csv_files(spark, folder).items():
        checked = checked_csv_table(spark, table, paths)
        seen = Observation(f"refused of {table}")
        counted = checked.observe(seen, F.count_if(F.col(REFUSED).isNotNull()).alias("refused"))
        written = write_table(counted.where(F.col(REFUSED).isNull()).drop(REFUSED), f"{namespace}.{table}")
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{table}_refused")
        refused = seen.get["refused"]
        if refused:
            write_table(checked.where(F.col(REFUSED).isNotNull()), f"{namespace}.{table}_refused")
        if refused:
            print(f"{table}: {refused} rows refused, kept in {namespace}.{table}_refused")
        loaded[table] = Loaded(written, refused)
    return loaded
