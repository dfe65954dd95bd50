import pytest

from bazaarlens import session
from tests.helpers import table


def test_written_frames_live_in_the_shared_folder(spark):
    df = session.write_out(spark.range(3), "numbers")
    assert table(df) == [(0,), (1,), (2,)]
    assert session.scratch_root(spark).removeprefix("file:") in df.inputFiles()[0]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_skew_settings_keep_what_the_session_chose(spark):
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    session.prefer_skew_handling(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    session.prefer_skew_handling(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
