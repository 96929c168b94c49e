"""Toxicity network: gradients, windows, held-out accuracy, whole texts, odd rows."""

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tonality.llm import toxicity as T

BAD = [b"vile", b"rotten", b"filthy"]


def corpus(n, seed=0):
    rnd = random.Random(seed)
    syl = [b"ta", b"re", b"mi", b"son", b"ol", b"gra", b"pe"]
    word = lambda: b"".join(rnd.choice(syl) for _ in range(rnd.randrange(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rnd.randrange(1, 120))]
        y = int(i % 4 == 0)
        for _ in range(rnd.randrange(1, 4) if y else 0):
            words[rnd.randrange(len(words))] = rnd.choice(BAD)
        out.append((i, b" ".join(words), y))
    return out


def test_gradients_match_differences():
    words = [b"alpha", b"be", b"gamma", b"d"]
    model, coder = T.BiGru({b"alpha": 1, b"be": 2}, 1), T.Encoder({b"alpha": 1, b"be": 2})
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    numbers = [coder.numbers(words * 5), coder.numbers(words[:3])]
    _, idx, mask = T._stack(numbers, len(coder.new))
    inputs, y, w = coder.inputs(coder.new), np.arange(len(idx)) % 2, np.ones(len(idx))

    def loss():
        s = model.forward(model.project(model.embed(*inputs)), idx, mask).astype(float)
        return float((np.logaddexp(0, s) - y * s).mean())

    grads = model.gradients(inputs, idx, mask, y, w)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        flat = np.flatnonzero(np.abs(g).ravel() > 1e-3)
        for at in rng.choice(flat, min(3, len(flat)), replace=False):
            value = model.p[name].reshape(-1)
            old, eps = value[at], 1e-3
            value[at] = old + eps
            up = loss()
            value[at] = old - eps
            down = loss()
            value[at] = old
            assert abs((up - down) / (2 * eps) - g.reshape(-1)[at]) < 2e-3 + 0.05 * abs(g.reshape(-1)[at])


def test_windows_cover_every_word():
    for n in (0, 1, 15, 16, 17, 28, 29, 100, 1001):
        doc, idx, mask = T._stack([np.arange(n, dtype=np.int32)], 9999)
        assert sorted(set(idx[mask].tolist())) == list(range(n))
        assert len(doc) == len(T.windows_of(n))
        assert [int(r[0]) for r in idx] == T.windows_of(n)


def test_held_out_accuracy_and_long_texts(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t.decode(), "x", 0.5) for i, t, _ in rows],
                                 "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id bigint, toxic int, text int")
    model = T.train_toxicity(docs, labels, F.col("doc_id") < 400)
    got = {r.doc_id: r.score for r in T.score_documents(docs, model).collect()}
    held = [(got[i] >= 0.7) == bool(y) for i, _, y in rows if i >= 400]
    assert np.mean(held) > 0.95
    quiet = b" ".join([b"ta re mi"] * 20_000).decode()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, quiet), (5, quiet + " vile rotten filthy"),
                                 (None, "filthy vile rotten"), (4, quiet)], "doc_id bigint, text string")
    s = sorted(((r.doc_id or 0, r.score) for r in T.score_documents(odd, model).collect()))
    assert [x[0] for x in s] == [0, 1, 2, 3, 4, 4, 5]
    assert s[0][1] >= 0.7 and s[1][1] == s[2][1] == s[3][1] == 0 and s[4][1] == s[5][1] < 0.7 <= s[6][1]


def test_no_labels_of_a_class(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    assert T.train_toxicity(docs, labels) is None
    assert T.score_documents(docs, None).collect()[0].score == 0.0
    assert T.train_toxicity(docs.where("false"), labels.where("false")) is None


def test_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in T.op2_toxicity(spark, sf).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert set(got) == {i for i, _ in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    toxic = [i for i, t in rows if " idiot " in t.lower() or " scum " in t.lower()]
    clean = set(got) - set(toxic)
    assert np.mean([got[i].predicted for i in toxic]) > 0.8
    assert np.mean([got[i].predicted for i in clean]) < 0.06


def test_long_unspaced_texts_count_to_their_end():
    """Long words become pieces that leave no n-gram out, and a toxic end counts."""
    for w in (b"x" * 64, bytes(range(0x61, 0x7B)) * 9, "你好世界ก".encode() * 31, b"\x80" * 99):
        pieces = T.steps_of(w)
        assert {w[k:k + 4] for k in range(len(w) - 3)} == {p[k:k + 4] for p in pieces for k in range(len(p) - 3)}
        assert len(w) <= 64 or max(map(len, pieces)) <= T.PIECE + 3
    rnd = random.Random(1)
    sign = lambda: chr(rnd.randrange(0x4E00, 0x4E80))
    bad = "毒恶臭烂"
    text = lambda y: "".join(sign() for _ in range(rnd.randrange(40, 200))) + (bad * 3 if y else "")
    model = T.fit([(k, text(k % 3 == 0).encode(), int(k % 3 == 0)) for k in range(300)])
    long = "".join(sign() for _ in range(5000))
    quiet, toxic = T.score_texts(model, [long.encode(), (long + bad * 3).encode()])
    assert quiet < T.THRESHOLD <= toxic


def test_every_window_is_scored():
    """A text scores its highest window of those at every word, wherever a passage falls."""
    model, rnd = T.BiGru({b"w%d" % k: k + 1 for k in range(20)}, 3), random.Random(5)
    texts = [b" ".join(b"w%d" % rnd.randrange(40) for _ in range(n)) for n in (1, 5, 15, 16, 17, 40, 300, 5000, 16)]
    want = []
    for t in texts:
        ws = t.split()
        coder = T.Encoder(model.vocabulary)
        ids, n = coder.numbers(ws), max(1, len(ws) - T.LENGTH + 1)
        inside = np.arange(n)[:, None] + np.arange(T.LENGTH)
        mask = inside < len(ws)
        idx = np.where(mask, np.append(ids, [len(coder.new)] * T.LENGTH)[inside], len(coder.new))
        logit = model.forward(model.project(model.embed(*coder.inputs(coder.new))), idx, mask)
        want.append(float(T._sigmoid(logit.max())))
    assert np.allclose(T.score_texts(model, [*texts, b"", None]), [*want, 0, 0], atol=1e-5)
    passage, quiet = b" ".join(b"w%d" % k for k in range(16)), [b"w30"] * 40
    alone = T.score_texts(model, [passage])[0]
    for at in range(24):
        text = b" ".join([*quiet[:at], passage, *quiet[at:]])
        assert T.score_texts(model, [text])[0] >= alone - 1e-5


def test_stems_whose_words_never_repeat():
    """Toxic words that share a stem only, each in one document: n-grams carry them."""
    rnd = random.Random(7)
    syl = ["ta", "re", "mi", "son", "ol", "gra", "pe"]
    word = lambda lo: "".join(rnd.choice(syl) for _ in range(rnd.randrange(lo, lo + 4)))

    def text(y):
        words = [word(1) for _ in range(rnd.randrange(20, 120))]
        for _ in range(3 if y else 0):
            words[rnd.randrange(len(words))] = "vekq" + word(3)
        return " ".join(words).encode()

    rows = [(k, text(k % 4 == 0), int(k % 4 == 0)) for k in range(600)]
    model = T.fit([r for r in rows if r[0] < 400])
    held = [r for r in rows if r[0] >= 400]
    said = T.score_texts(model, [t for _, t, _ in held]) >= T.THRESHOLD
    assert np.mean(said == [bool(y) for *_, y in held]) > 0.95


def test_equal_fit_from_rows_in_any_order():
    rows = corpus(120)
    one, two = T.fit(rows, steps=20), T.fit(rows[::-1], steps=20)
    assert one.vocabulary == two.vocabulary
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p)


def test_equal_fit_whatever_the_threads():
    """A task on a machine with other cores fits the same model, bit for bit."""
    code = ("import hashlib; from tests.llm.test_toxicity import T, corpus; m = T.fit(corpus(200), steps=20); "
            "print(hashlib.md5(b''.join(m.p[k].tobytes() for k in sorted(m.p))).hexdigest())")
    root = str(Path(__file__).resolve().parents[2])
    got = {subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True, text=True,
                          env=os.environ | {"OMP_NUM_THREADS": str(k)}).stdout for k in (1, 4)}
    assert len(got) == 1 and got.pop().strip()
