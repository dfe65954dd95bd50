import math
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from bazaarlens.functions import columns as fn
from bazaarlens.plans import settings
from tests.helpers import frame, one, table

c = F.col


def test_cut_matches_pandas_on_every_edge(spark):
    cases = [
        (settings.DISTANCE_EDGES, settings.DISTANCE_LABELS, True),
        (settings.DEADLINE_EDGES, settings.DEADLINE_LABELS, False),
        (settings.SPEED_EDGES, settings.SPEED_LABELS, True),
        (settings.WEIGHT_EDGES, settings.WEIGHT_LABELS, True),
    ]
    for edges, labels, right in cases:
        inner = [e for e in edges if e is not None]
        values = sorted({v for e in inner for v in (e - 1.0, e - 0.5, float(e), e + 0.5)} | {0.0, -3.0, 1e6})
        bounds = [(-math.inf if i == 0 else math.inf) if e is None else e for i, e in enumerate(edges)]
        want = pd.cut(pd.Series(values), bounds, labels=labels, right=right)
        got = dict(
            (r.v, r.b)
            for r in frame(spark, "v double", *[(v,) for v in values]).select("v", fn.cut(c("v"), edges, labels, right).alias("b")).collect()
        )
        assert got == {v: (None if pd.isna(w) else w) for v, w in zip(values, want)}
    assert one(frame(spark, "v double", (None,)).select(fn.cut(c("v"), [None, None], ["all"]).alias("b"))) == {"b": None}


def test_clip_keeps_null(spark):
    df = frame(spark, "v int", (5,), (50,), (-20,), (None,))
    assert table(df.select("v", fn.clip(c("v"), low=-15, high=40).alias("w"))) == [(-20, -15), (5, 5), (50, 40), (None, None)]


def test_days_between_counts_midnights(spark):
    df = frame(
        spark, "a string, b string",
        ("2018-01-01 23:59:00", "2018-01-02 00:01:00"), ("2018-01-01 00:00:00", "2018-01-01 23:00:00"), (None, "2018-01-01"),
    ).select(fn.days_between(fn.safe_timestamp(c("a")), fn.safe_timestamp(c("b"))).alias("d"))
    assert [r.d for r in df.collect()] == [1, 0, None]


def test_rounding_is_decimal(spark):
    df = frame(spark, "v double", (1.005,), (2.345,), (-2.345,), (None,)).select(fn.rounded(c("v"), 2).alias("v"))
    assert [None if r.v is None else float(r.v) for r in df.collect()] == [1.01, 2.35, -2.35, None]


def test_ratio_is_rounded_once(spark):
    """29804886.80 / 573 is 52015.50924956...: cut to 6 places first it would end in 3."""
    df = frame(spark, "a decimal(20,2), b int", (Decimal("29804886.80"), 573), (Decimal("-29804886.80"), 573), (Decimal("0.10"), 16))
    got = [float(r.q) for r in df.select(fn.rounded(fn.ratio(c("a"), c("b")), 4).alias("q")).collect()]
    assert got == [52015.5092, -52015.5092, 0.0063]


def test_ratio_of_zero_is_null(spark):
    df = frame(spark, "a int, b int", (1, 4), (1, 0), (None, 2)).select(fn.percent(c("a"), c("b")).alias("p"))
    assert [None if r.p is None else float(r.p) for r in df.collect()] == [25.0, None, None]


def test_shares_treat_unknown_flags_differently(spark):
    df = frame(spark, "f boolean", (True,), (False,), (None,), (True,))
    got = one(df.agg(fn.share_true(c("f")).alias("all"), fn.share_true_known(c("f")).alias("known")))
    assert got["all"] == 50.0 and abs(got["known"] - 66.666667) < 1e-6


def test_correlation_edge_cases(spark):
    df = frame(
        spark, "g string, x double, y double",
        ("const", 1.0, 1.0), ("const", 1.0, 2.0),
        ("pair", 1.0, 2.0), ("pair", 2.0, 4.0), ("pair", None, 100.0), ("pair", 7.0, None),
        ("one", 1.0, 1.0), ("none", None, 1.0),
    )
    got = {r.g: r.r for r in df.groupBy("g").agg(fn.correlation(c("x"), c("y")).alias("r")).collect()}
    assert got["const"] is None and got["one"] is None and got["none"] is None
    assert abs(got["pair"] - 1.0) < 1e-12


def test_haversine(spark):
    df = frame(
        spark, "a double, b double, c double, d double",
        (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (-23.55, -46.63, -22.91, -43.17), (None, 1.0, 1.0, 1.0),
    ).select(fn.haversine_km(c("a"), c("b"), c("c"), c("d")).alias("km"))
    same, antipode, cities, unknown = [r.km for r in df.collect()]
    assert same == 0 and abs(antipode - math.pi * 6371) < 1e-6 and abs(cities - 361) < 2 and unknown is None


def test_zip_padding_and_safe_casts(spark):
    df = frame(spark, "z string, t string", ("1037", "2017-10-18 00:00:00"), ("01037", ""), ("123456", "garbage"), (None, None))
    got = df.select(
        fn.padded_zip(c("z")).alias("z"), fn.safe_timestamp(c("t")).cast("string").alias("t"), fn.safe_date(c("t")).cast("string").alias("d")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("01037", "2017-10-18 00:00:00", "2017-10-18"), ("01037", None, None), ("123456", None, None), (None, None, None)
    ]
