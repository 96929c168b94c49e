"""Sequences travel as words; their vectors are fetched inside tasks."""

import numpy as np
import pytest

import __spark_entry__ as E
from tonality.operators import lstm_math as L
from tonality.operators import scoring
from tonality.operators import sequence_model as sm
from tonality.operators import tensors as tz
from tonality.operators import tokens as tok
from tonality.operators import vectors as vec
from tonality.operators.lookup import doc_words
from tonality.session import fresh_path
from tonality.sources import fixtures
from tonality.sources.vectors import HOT_CONF_KEY, stage_vectors

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(params=["whole", "part", "none"])
def hot(spark, request):
    """The look-up holds the whole table, two words of it, or none."""
    if request.param != "whole":
        spark.conf.set(HOT_CONF_KEY, str(2 * 60 if request.param == "part" else 0))
    yield request.param
    spark.conf.unset(HOT_CONF_KEY)


def _table(spark, rows):
    df = spark.createDataFrame(rows, "word string, vec_id long, vector array<float>")
    return stage_vectors(spark, df, fresh_path(spark, "lookup-vocab"))


def test_sequences_by_lookup(spark, hot):
    """Order, repeats, words given twice and null vectors, wherever the vectors come from."""
    vt = _table(spark, [("a", 0, [1.0, 2.0]), ("b", 1, [3.0, 4.0]), ("c", 2, [5.0, 6.0]), ("d", 3, None),
                        ("e", 4, [9.0, 9.0]), ("e", 5, [7.0, 8.0])])
    docs = spark.createDataFrame([(1, "c a x b a"), (2, "x"), (3, None), (4, "a d c"), (5, "b e")],
                                 "doc_id long, text string")
    trunc = tok.truncated_tokens(fixtures.tokens_of(docs), vt, spark)
    got = {r.doc_id: (r.n, r.seq) for r in tz.doc_sequences(trunc, vt, spark).collect()}
    assert got == {1: (4, [[5.0, 6.0], [1.0, 2.0], [3.0, 4.0], [1.0, 2.0]]),
                   4: (3, [[1.0, 2.0], None, [5.0, 6.0]]),
                   5: (3, [[3.0, 4.0], [7.0, 8.0], [9.0, 9.0]])}


def test_scores_and_fits_by_words_equal_those_by_vectors(spark, hot):
    rng = np.random.default_rng(0)
    words = "abcdefgh"
    vt = _table(spark, [(w, k, rng.normal(size=3).astype(np.float32).tolist()) for k, w in enumerate(words)])
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choice(list(words + "z"), 1 + i % 9))) for i in range(30)], "doc_id long, text string")
    rv = docs.selectExpr("doc_id", "text", "'train' split", "if(doc_id % 3 = 0, 'negative', 'positive') sentiment",
                         "if(doc_id % 3 = 0, 1, 0) label")
    one, _ = sm.train(spark, tz.corpus_members(rv, vt, spark), vt.dim, hidden=3)
    two, _ = sm.train(spark, tz.word_members(rv, vt, spark), vt.dim, hidden=3, vt=vt)
    assert one.same_as(two)
    trunc = tok.truncated_tokens(fixtures.tokens_of(docs), vt, spark)
    by_vectors = sm.score(tz.doc_sequences(trunc, vt, spark), one).collect()
    by_words = sm.score(doc_words(trunc, vt, spark), one, vt=vt).collect()
    assert sorted(by_vectors) == sorted(by_words) and len(by_words) > 20


@pytest.mark.parametrize("key", ["inference_tensor", "inference_tensor_all", "padded_sequences", "last_step"])
def test_no_vector_is_shuffled(spark, key):
    """The vectors are fetched after the last exchange of the document rows."""
    plan = E.queries()[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    above, below = initial.split("MapInArrow", 1)
    assert "Exchange" not in above and "vector" not in below.split("MapInArrow")[0].replace("vectors", "")


def test_members_are_kept_by_their_words(spark):
    from tonality import registry
    from tonality.sources.vectors import vector_table

    vt = vector_table(spark, SMOKE)
    columns = registry._train_members(spark, SMOKE, vt).columns
    assert "words" in columns and "seq" not in columns


@pytest.mark.parametrize("key", ["label_tensor", "sequence_masks"])
def test_lengths_and_labels_fetch_no_vector(spark, key):
    assert "MapInArrow" not in E.queries()[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()


def test_pooling_by_words_equals_pooling_by_vectors(spark, hot):
    """Bit for bit, with repeats, words given twice, null vectors and texts without a known word."""
    rng = np.random.default_rng(1)
    vt = _table(spark, [*((w, k, rng.normal(size=3).astype(np.float32).tolist()) for k, w in enumerate("abcdef")),
                        ("e", 6, [9.0, 9.5, 1.0]), ("g", 7, None)])
    docs = spark.createDataFrame(
        [*((i, " ".join(rng.choice(list("abcdefgz"), 1 + i % 9))) for i in range(60)), (60, None), (61, ""), (62, "z"),
         (63, "g"), (5, "a b c"), (7, "f a")], "doc_id long, text string")
    rv = docs.selectExpr("doc_id", "text", "'train' split", "'positive' sentiment", "0 label")
    trunc = tok.truncated_tokens(fixtures.tokens_of(docs), vt, spark, 4)
    want = {r.doc_id: (r.n, r.pooled) for r in vec.pooled_vectors(trunc, vt, spark).collect()}
    lp = scoring.pooled_corpus(rv, vt, spark, 4)
    plan = lp._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # no task sorts tokens
    got = {r.doc_id: (r.n, r.pooled) for r in lp.collect()}
    assert {k: v for k, v in got.items() if v[0]} == want and got[60] == got[61] == got[62] == (0, None)
