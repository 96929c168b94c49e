"""Language model: base scores by brute force, a true distribution, held-out gain, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

from tonality.llm import maxent_lm as M
from tonality.llm.common import space_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def base(docs):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    c = Counter(t for (_, x), h in zip(docs, held, strict=True) if not h for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [(i, h, len(tokens(x)), sum(t in c for t in tokens(x)), n,
             sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)))
            for (i, x), h in zip(docs, held, strict=True)]


def same(rows, docs):
    want = sorted(base(docs), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=str)
    key = lambda r: (str(r[0]), *r[2:4], round(r[5], 4))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-7)


def test_query(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = M.op7_maxent_lm(spark, sf).collect()
    same(rows, docs)
    held = [r for r in rows if r.held_out]
    per_token = lambda name: sum(getattr(r, name) for r in held) / sum(r.n_tokens for r in held)
    assert per_token("score") > per_token("base_score") + 0.15
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_cold_words_give_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = M.texts(docs)
    M.prepare(spark)
    train = rows.where(~M.is_held_out())
    out = []
    for hot in (50, 10**6):
        model, counts = M.train_lm(train, hot_words=hot, rounds=0)
        out.append({r.doc_id: r for r in M.score_lm(rows, model, counts).collect()})
    for i, r in out[0].items():
        other = out[1][i]
        assert r.n_known == other.n_known and math.isclose(r.base_score, other.base_score, rel_tol=1e-9)
        assert math.isclose(r.score, other.score, rel_tol=1e-3)


def test_probabilities_sum_to_one(spark):
    text = "the a of the a b c d e the f g a h i j of k l m n o p q r s t u v w x y z aa bb cc dd ee ff gg hh"
    docs = spark.createDataFrame([(k, text) for k in range(20)], "doc_id bigint, text string")
    M.prepare(spark)
    model, counts = M.train_lm(M.texts(docs))
    by = {r.word: r.n for r in counts.collect()}
    reader = M.Reader()
    reader.read([text.encode()])
    keys, atoms = np.asarray(reader.keys), np.asarray(reader.atoms)
    hot, log_count, cls, feature = model.look_up(keys, atoms)
    assert hot.all() and set(by) == set(keys.tolist())
    for one, two in ((feature[3], feature[1]), (M.WORD_ROWS - 1, M.WORD_ROWS - 1)):
        z = M._logits(model, model.w, M.history(np.array([two, one, 0]), np.array([3]))[2:])[0].astype(float)
        p = np.exp(z - z.max())
        p /= p.sum()
        inside = np.where(model.alone[cls], 1.0, 10 ** (log_count - model.log_rest[cls]))
        unseen = sum(p[c] * 0.5 / 10 ** model.log_rest[c] for c in range(M.CLASSES) if not model.alone[c] and c > M.SINGLES)
        assert abs((p[cls] * inside).sum() + unseen - 1) < 1e-4


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "A a\tb"), (3, "A a\tb"), (None, "zz b"), (4, "word " * 60_000), (5, "new words here"), (7, "é")]
    df = spark.createDataFrame([(t, i, 1.0) for i, t in docs], "text string, doc_id bigint, score double")
    same(M.lm_scores(df).collect(), docs)
    assert M.lm_scores(df.where("false")).collect() == []
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    only = spark.createDataFrame([(i, "a b") for i in held], "doc_id bigint, text string")
    same(M.lm_scores(only).collect(), [(i, "a b") for i in held])


def test_reader_numbers_an_arrow_batch_as_words_do():
    odd = [b" a  B\tc\n", b"", None, b"x", b"\x0b\x0c\rz \x1c q\x85\xa0", "É é ...".encode(), b"a.  b!? .", b" \n ",
           b"\xff\xfe b", b"!\" ab) a", b"x" * 300]
    rng = np.random.default_rng(3)
    odd += [bytes(rng.integers(0, 128, int(n)).astype(np.uint8)) for n in rng.integers(0, 200, 60)]
    for column in (pa.array(odd, pa.binary()), pa.array([b"q", *odd, b"r"], pa.binary()).slice(1, len(odd))):
        reader = M.Reader()
        for _ in range(2):  # the second time all words are known
            numbers, lens = reader.read(column)
        words = [space_words(t) for t in odd]
        assert lens.tolist() == [len(ws) + 1 for ws in words]
        flat = [w for ws in words for w in [*ws, None]]
        assert reader.keys[numbers].tolist() == [
            M.END if w is None else int(np.uint64(xxh3_64_intdigest(w)).astype(np.int64)) for w in flat]
        assert reader.atoms[numbers].tolist() == [0 if w is None else M.ending(w) for w in flat]


def test_counts_where_the_memo_runs_full(spark, monkeypatch):
    texts = [f"w{k} w{k} common x{k % 7}" for k in range(40)]
    monkeypatch.setattr(M, "MEMO_WORDS", 5)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = M._count_rows(rows.select("doc_id", rows.text.cast("binary").alias("text"))).where("kind = 0")
    got = {r.key: r.n for r in found.groupBy("key").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    want = Counter(w for t in texts for w in t.encode().split())
    assert got == {int(np.uint64(xxh3_64_intdigest(w)).astype(np.int64)): n for w, n in want.items()} | {M.END: 40}
