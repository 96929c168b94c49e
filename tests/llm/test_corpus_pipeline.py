"""The pipeline against a brute-force version of its stages; each stage on odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from tonality.llm import token_orc, toxicity

from .test_jaccard_join import brute as components
from .test_poisson_mix import py_count
from .test_wu_manber import words

SF = "/root/testdata/sf0.01"


def contaminated(text, windows):
    ws = words(text)
    return any(tuple(ws[k:k + m]) in windows for m in {len(w) for w in windows} for k in range(len(ws) - m + 1))


def windows_of(items):
    out = set()
    for _, text in items:
        ws = words(text)
        m = min(10, len(ws))
        out |= {tuple(ws[k:k + m]) for k in range(len(ws) - m + 1 if m else 0)}
    return out


def test_run_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.fit([(i, t.encode(), labels[i]) for i, t, _ in docs if i in labels])
    score = toxicity.score_texts(model, [t.encode() for _, t, _ in docs])
    kept = [d for d, s in zip(docs, score, strict=True) if s < 0.7]
    assert 0 < len(docs) - len(kept) < len(docs) // 5
    home = {i: c for i, _, c in components([(i, t) for i, t, _ in kept])}
    kept = [d for d in kept if home[d[0]] == d[0]]
    windows = windows_of(items)
    kept = [d for d in kept if not contaminated(d[1], windows)]
    sizes = {}
    for _, _, s in kept:
        sizes[s] = sizes.get(s, 0) + 1
    total = sum(np.sqrt(n) for n in sizes.values())
    rate = {s: np.sqrt(n) * len(kept) / total / n for s, n in sizes.items()}
    tok = Tokenizer.from_file(token_orc.default_tokenizer())
    want, start = [], 0
    for i, t, s in sorted(kept):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        for _ in range(py_count(i, rate[s])):
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert sorted(tuple(r) for r in C.run(spark, SF).collect()) == want


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("odd"))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int, text_key int, score double"
    copy = "one two three four five six seven eight nine ten eleven"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, copy, "en", "a", 9), (4, copy, None, "b", 9),
            (4, copy, None, "b", 9), (None, "alone here", "en", "a", 3), (5, "bench " * 3 + "m a r k s", "x", "b", 1),
            (6, "z " * 30_000, "en", None, 1)]
    spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "a r k s")], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def test_stages_on_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns, got = docs.columns, {}
    for name, stage in C.STAGES[:4]:
        docs = stage(spark, docs, odd)
        assert docs.columns == columns
        got[name] = sorted(-1 if r.doc_id is None else r.doc_id for r in docs.collect())
    assert got["toxicity"] == [-1, 1, 2, 3, 4, 4, 5, 6]
    assert got["jaccard"] == [-1, 1, 2, 3, 5, 6]
    assert got["decontaminate"] == [-1, 1, 2, 3, 6]
    assert C.run(spark, odd).count() == len(got["mix"])


def test_stages_on_empty_tables(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").where(F.lit(False))
    for _, stage in C.STAGES:
        docs = stage(spark, docs, odd)
        assert docs.count() == 0


def test_jaccard_removes_rows_not_ids(spark):
    """Of every group exactly one row stays, whatever ids repeat or are missing."""
    long = ["w%d" % k for k in range(40)]
    near = " ".join([*long[:-1], "other"])
    rows = [(7, "p q r s t u"), (7, "other words here"), (3, "p q r s t u"),  # one linked, one unlinked text of an id
            (8, " ".join(long)), (8, near),                                   # near copies under one id
            (9, "same row"), (9, "same row"), (None, "same row"), (None, "no id"), (None, "no  ID"), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in C.jaccard(spark, docs, "").collect()]
    fixed = [(3, "p q r s t u"), (7, "other words here"), (9, "same row"), (4, None), (4, "")]
    assert [got.count(r) for r in fixed] == [1] * 5
    assert sum(r[0] == 8 for r in got) == 1 and sum(r[0] is None for r in got) == 1 and len(got) == 7
