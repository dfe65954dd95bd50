"""Every query that SQL can express against its twin, and the shape of the others."""

import pandas as pd
import pytest

from bazaarlens.llm.queries import ORACLES, QUERIES


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, duck, sf_dir, name):
    made = QUERIES[name](spark, sf_dir).toPandas()
    pd.testing.assert_frame_equal(ordered(made), ordered(duck.sql(ORACLES[name]).df()), check_dtype=False)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
