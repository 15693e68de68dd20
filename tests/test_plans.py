"""Plan properties the scale design relies on (checked on the physical plan)."""

from pyspark.sql import functions as F

from recoengine.operators import dedup, filters
from recoengine.operators.sentiment import score_sentiment
from recoengine.plans import roles as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    p = plan(dedup.dedup_latest(R.interactions(spark, SF), tie_breakers=R.INTERACTION_TIE_BREAKERS))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_reach_the_parquet_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(filters.valid_ratings(li, "l_quantity").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,1.0), LessThanOrEqual(l_quantity,5.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_sentiment_broadcasts_the_lexicon_and_prunes_the_scan(spark):
    df = score_sentiment(R.review_texts(spark, SF), R.fixture_lexicon(spark), **R.fixture_rules())
    p = plan(df.select("id", "sentiment_score"))
    assert "BroadcastHashJoin" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_no_python_udfs_in_registered_queries(spark):
    from recoengine.plans.queries import QUERIES

    # (queries that fit a model or write files when called are left out for their time)
    slow = ("CF_", "SRC_", "SNK_", "SET_")
    for name, query in QUERIES.items():
        if not name.startswith(slow) or name in ("CF_2_split", "CF_8_rerank", "CF_9_boosted_counts"):
            p = plan(query(spark, SF))
            assert "EvalPython" not in p and "Pandas" not in p and "InArrow" not in p, name
