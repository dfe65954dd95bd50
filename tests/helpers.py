from decimal import Decimal


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def table(df, *cols):
    """Rows as sorted tuples, decimals as floats."""
    rows = (df.select(*cols) if cols else df).collect()
    return sorted([tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in rows], key=repr)


def one(df):
    (row,) = df.collect()
    return {k: float(v) if isinstance(v, Decimal) else v for k, v in row.asDict().items()}
