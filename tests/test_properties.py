"""Property checks against brute-force Python versions of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tonality.operators import dataset as ds
from tonality.sources import fixtures

ALPHABET = "ab Z9.,;:!?\"'()[]|/ \t\n\r\fé-É"


def _brute_tokens(text):
    out = []
    for pos, piece in enumerate(re.split(r"[ \t\n\r\f]+", text)):
        w = re.sub(r"[0-9.:,\"'()\[\]|/?!;]+", "", piece).lower()
        if w:
            out.append((pos, w))
    return out


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=40))
def test_tokenizer_matches_rule(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in fixtures.tokens_of(df).collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.word))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == _brute_tokens(t)


def _brute_interleave(n_pos, n_neg):
    """Walk two class lists with one cursor: alternate while both last, then the rest."""
    order, i, j = [], 0, 0
    while i < n_pos or j < n_neg:
        take_pos = (len(order) % 2 == 0 and i < n_pos) or j >= n_neg
        if take_pos:
            order.append((0, i))
            i += 1
        else:
            order.append((1, j))
            j += 1
    return order


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40))
def test_interleave_closed_form_matches_cursor(spark, n_pos, n_neg):
    rows = [(i, "train", "positive", 0) for i in range(n_pos)] + \
           [(1000 + i, "train", "negative", 1) for i in range(n_neg)]
    if not rows:
        return
    rv = spark.createDataFrame(rows, "doc_id long, split string, sentiment string, label int")
    got = [(r.label, r.doc_id - 1000 * r.label) for r in ds.interleave(rv).orderBy("position").collect()]
    assert got == _brute_interleave(n_pos, n_neg)
