"""Tokenising, counting and ranking words."""

import __spark_entry__ as E
from tonality.plans.broadcast import CONF_KEY
from tonality.sources import fixtures

SMOKE = "/root/testdata/sf0.001"


def test_text_is_normalised_once_and_pieces_keep_their_number(spark):
    """One call a text, not a call a piece; ``12`` is a piece that leaves no word; a capital
    sigma is lower-cased by what remains around it."""
    df = spark.createDataFrame([(1, "\tAb 12 c.D\n\n e!"), (2, None), (3, " "), (4, "ΟΣ Σ/Α")],
                               "doc_id long, text string")
    toks = fixtures.tokens_of(df)
    got = sorted(tuple(r) for r in toks.collect())
    assert got == [(1, 1, "ab"), (1, 3, "cd"), (1, 4, "e"), (4, 0, "ος"), (4, 1, "σα")]
    plan = toks._jdf.queryExecution().executedPlan().toString()
    assert "translate(" not in plan and "lower(" in plan.split("Generate")[-1]


def test_unknown_words_are_counted_before_the_shuffled_join(spark):
    """Above the broadcast bound the rest of the vocabulary meets a row a word, not a row a token."""
    spark.conf.set(CONF_KEY, "1")
    try:
        plan = E.queries()["oov_words"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(CONF_KEY)
    assert plan.index("LeftAnti") < plan.index("Aggregate")


def test_word_ranks_tokenise_the_texts_once(spark):
    df = fixtures.word_vectors(spark, SMOKE)
    assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
