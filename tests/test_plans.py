"""Physical-plan properties the design relies on."""

import pytest

import __spark_entry__ as E
from tonality.plans.broadcast import CONF_KEY

SMOKE = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_pooling_has_one_exchange(spark):
    """Spread scan on doc_id -> tokens -> semi join -> window -> aggregate: one shuffle."""
    plan = _final_plan(E.queries()["pooled_vectors"](spark, SMOKE))
    assert plan.count("ShuffleQueryStage") == 1
    assert "WindowGroupLimit" in plan
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_vocabulary_not_broadcast_above_the_bound(spark):
    spark.conf.set(CONF_KEY, "1")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    try:
        df = E.queries()["known_tokens"](spark, SMOKE)
        initial = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert "SortMergeJoin" in initial and "LeftSemi" in initial
        n_small = df.count()
    finally:
        spark.conf.unset(CONF_KEY)
    assert n_small == E.queries()["known_tokens"](spark, SMOKE).count()


@pytest.mark.parametrize("key", ["word_vectors", "interleave", "pooled_vectors", "email_sentiment",
                                 "score_adhoc", "padded_sequences", "classification_metrics"])
def test_no_nested_loop_or_cartesian_joins(spark, key):
    plan = _final_plan(E.queries()[key](spark, SMOKE))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scoring_reuses_the_document_exchange(spark):
    plan = _final_plan(E.queries()["score_adhoc"](spark, SMOKE))
    assert "ReusedExchange" in plan


def test_hybrid_hot_word_join_gives_the_same_rows(spark):
    """Vocabulary above the broadcast bound: hot words broadcast, the rest shuffled."""
    from tonality.sources.vectors import HOT_CONF_KEY
    keys = ["known_tokens", "pooled_vectors", "token_vector_lookup", "oov_words", "known_token_counts"]
    want = {k: sorted(map(tuple, E.queries()[k](spark, SMOKE).collect()), key=repr) for k in keys}
    spark.conf.set(CONF_KEY, "1")
    spark.conf.set(HOT_CONF_KEY, str(60 * 1024))  # a few dozen hot words
    try:
        for k in keys:
            df = E.queries()[k](spark, SMOKE)
            assert sorted(map(tuple, df.collect()), key=repr) == want[k], k
        plan = _final_plan(E.queries()["pooled_vectors"](spark, SMOKE))
        assert "Union" in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset(CONF_KEY)
        spark.conf.unset(HOT_CONF_KEY)


def test_spread_only_touches_narrow_scans(spark):
    from tonality.plans.partitioning import spread
    from tonality.session import fresh_path
    wide_path, narrow_path = fresh_path(spark, "wide"), fresh_path(spark, "narrow")
    spark.range(0, 4000, numPartitions=16).withColumnRenamed("id", "doc_id").write.parquet(wide_path)
    spark.range(0, 4000, numPartitions=1).withColumnRenamed("id", "doc_id").write.parquet(narrow_path)
    wide = spread(spark.read.parquet(wide_path), "doc_id", wide_path)
    narrow = spread(spark.read.parquet(narrow_path), "doc_id", narrow_path)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in narrow._jdf.queryExecution().executedPlan().toString()
