"""The words of a text are picked where it is read, with the same result as by joined tokens."""

import pytest

import __spark_entry__ as E
from tonality.operators.lookup import text_words, token_words
from tonality.plans.broadcast import CONF_KEY
from tonality.session import fresh_path
from tonality.sources import fixtures
from tonality.sources.vectors import HOT_CONF_KEY, stage_vectors

SMOKE = "/root/testdata/sf0.001"
TEXTS = [(1, "c a x b, A 12 a!"), (2, "x y"), (3, None), (4, ""), (5, " a\t\tb\nété . c "), (6, "a " * 9),
         (7, "a b c"), (7, "a b c"), (8, "c x a"), (8, "b b b b"), (None, "a b"), (None, None), (9, "e e d")]


def _rows(df):
    """Words of equal place under one id come in any order."""
    return {r.doc_id: (r.n_tokens, r.n_known, sorted(r.words or []) if r.doc_id == 8 else list(r.words or []))
            for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize("hot", ["whole", "part", "joined"])
@pytest.mark.parametrize("every", [False, True])
def test_words_of_texts_equal_those_of_tokens(spark, hot, every):
    rows = [(w, k, [float(k), 1.0]) for k, w in enumerate("abcd")] + [("été", 4, [1.0, 1.0]), ("d", 5, [2.0, 2.0])]
    vt = stage_vectors(spark, spark.createDataFrame(rows, "word string, vec_id long, vector array<float>"),
                       fresh_path(spark, "words-vocab"))
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    if hot == "part":
        spark.conf.set(HOT_CONF_KEY, str(2 * 60))
    if hot == "joined":
        spark.conf.set(CONF_KEY, "1")
    try:
        got = _rows(text_words(docs, vt, spark, 5, every=every))
        want = _rows(token_words(fixtures.tokens_of(docs), vt, spark, 5, every=every))
    finally:
        spark.conf.unset(HOT_CONF_KEY)
        spark.conf.unset(CONF_KEY)
    assert {k: v for k, v in got.items() if v[0]} == {k: v for k, v in want.items() if v[0]}
    assert got[6] == (9, 9, ["a"] * 5) and got[7] == (6, 6, ["a", "a", "b", "b", "c"])
    assert got[1] == (6, 5, ["c", "a", "x", "b", "a"] if every else ["c", "a", "b", "a", "a"])
    assert len(got[8][2]) == 5


@pytest.mark.parametrize("key", ["truncated_sequences", "inference_tensor", "score_sequences_padded"])
def test_tokens_are_not_shuffled(spark, key):
    """A row a text reaches the shuffle, not a row a token."""
    plan = E.queries()[key](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
