"""Sequences of texts: a row a text is shuffled, and they equal those of joined tokens."""

from tonality import registry
from tonality.operators import tensors as tz
from tonality.operators import tokens as tok
from tonality.sources import fixtures
from tonality.sources.vectors import vector_table


def test_sequences_of_texts_equal_those_of_tokens(spark, sf):
    vt = vector_table(spark, sf)
    docs = fixtures.documents(spark, sf)
    want = tz.doc_sequences(tok.truncated_tokens(fixtures.tokens(spark, sf), vt, spark), vt, spark)
    got = tz.text_sequences(docs, vt, spark)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_transpose_makes_no_row_a_token(spark, sf):
    plan = registry.QUERIES["sequence_transpose"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "Window" not in plan
