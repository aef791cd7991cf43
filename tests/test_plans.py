"""Plans keep the shape the operators promise."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()

LIGHT = ["risk_scores", "agg_daily_sentiment", "join_master_left", "join_event_window", "join_asof_ffill",
         "join_anti_resume", "join_anti_seen_headline", "roll_corr_pairs", "recovery_days", "lead_lag_ccf",
         "eval_binary", "impute_median", "keep_first_dedupe", "test_ranksum", "score_text_lexicon"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "Window [" in line and "_b#" not in line:  # _b: at most 64 bucket totals
            assert "SinglePartition" not in "".join(lines[i + 1:i + 3]), line


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["join_anti_resume"](spark, SF))
    assert "EqualTo(l_returnflag,R)" in text
    scan = next(line for line in text.split("\n") if "lineitem.parquet" in line)
    assert "l_extendedprice" not in scan


def test_dedupe_combines_before_the_shuffle(spark):
    text = plan(QUERIES["keep_first_dedupe"](spark, SF))
    assert "partial_min" in text and "Window" not in text


class _Session:
    """Just the two settings the scratch folder depends on."""

    def __init__(self, folder, master):
        self.conf = type("C", (), {"get": staticmethod(lambda key, default=None: folder)})
        self.sparkContext = type("S", (), {"master": master})


def test_scratch_follows_the_cluster_setting():
    from riskspark.common import scratch_path
    assert scratch_path(_Session("hdfs://share/ck", "yarn"), "x").startswith("hdfs://share/ck/riskspark/x-")
    assert "riskspark" in scratch_path(_Session(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch_path(_Session(None, "yarn"), "x")
