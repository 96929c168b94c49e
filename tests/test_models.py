"""Scoring with stored models of every kind: dispatch, recurrent scores row by row, CLI."""

import json

import numpy as np
import pytest

import __spark_entry__ as E
from tonality import api
from tonality.operators import classifier as clf
from tonality.operators import lstm_math as L
from tonality.operators import models, scoring
from tonality.operators import sequence_model as sm
from tonality.plans import staging
from tonality.registry import stored_sequence_model
from tonality.session import fresh_path
from tonality.sources import corpus as cp
from tonality.sources import email_csv as ec
from tonality.sources import fixtures
from tonality.sources import vectors as sv
from tonality.sources.vectors import vector_table
from tonality.streaming import scores as st

SMOKE = "/root/testdata/sf0.001"


def forward(model, words, vectors):
    """p(positive) of a word list by a plain loop over steps, or None without a known word."""
    seq = [np.asarray(vectors[w], np.float64) for w in words if w in vectors][:256]
    if not seq:
        return None
    H, P = model.hidden, L.unflatten(model.flat, model.dim, model.hidden)
    h, c = np.zeros(H), np.zeros(H)
    sig = lambda x: 1 / (1 + np.exp(-x))
    for x in seq:
        z = np.concatenate([x, h]) @ P["W"] + P["b"]
        i, f = sig(z[:H] + P["p"][0] * c), sig(z[H:2 * H] + P["p"][1] * c)
        c = f * c + i * np.tanh(z[3 * H:])
        h = sig(z[2 * H:3 * H] + P["p"][2] * c) * np.tanh(c)
    a = h @ P["Wy"] + P["by"]
    e = np.exp(a - a.max())
    return float(e[0] / e.sum())


@pytest.fixture(scope="module")
def rnn(spark):
    vt = vector_table(spark, SMOKE)
    vectors = {r["word"]: r["vector"] for r in vt.frame(spark).collect()}
    return stored_sequence_model(spark, SMOKE, vt), vectors


def words_of(spark, df, key, text):
    toks = fixtures.tokens_of(df.select(key, text), key, text).orderBy(key, "pos").collect()
    out = {}
    for t in toks:
        out.setdefault(t[key], []).append(t["word"])
    return out


def agrees(rows, words, model, vectors, key):
    scored = 0
    for r in rows:
        want = forward(model, words.get(r[key], []), vectors)
        if want is None:
            assert r["score_pos"] is None and r["status"].startswith("Invalid") and r["n_known"] == 0
        else:
            assert abs(r["score_pos"] - want) < 2e-5 and abs(r["score_neg"] - (1 - want)) < 2e-5
            assert r["status"] == "OK"
            if abs(want - 0.5) > 1e-4:
                assert r["sentiment"] == ("Positive" if want > 0.5 else "Negative")
            scored += 1
    return scored


def test_messages_texts_and_stream_agree_with_a_plain_forward_pass(spark, rnn):
    model, vectors = rnn
    q = E.queries()
    mails = q["email_sentiment_rnn"](spark, SMOKE)
    rows = mails.collect()
    assert len(rows) == fixtures.messages(spark, SMOKE).count()
    assert agrees(rows, words_of(spark, mails, "msg_key", "raw_email"), model, vectors, "msg_key") > 0
    texts = words_of(spark, fixtures.documents(spark, SMOKE), "doc_id", "text")
    adhoc = q["score_adhoc_rnn"](spark, SMOKE).collect()
    assert len(adhoc) == 200 and agrees(adhoc, texts, model, vectors, "doc_id") > 0
    stream = q["stream_scores_rnn"](spark, SMOKE).collect()
    assert len(stream) == 200 and agrees(stream, texts, model, vectors, "doc_id") > 0
    assert {(r.doc_id, r.score_pos) for r in stream} == {(r.doc_id, r.score_pos) for r in adhoc}


def test_kind_is_read_from_what_is_stored(spark, vocab, tmp_path):
    vt = vocab([("good", [1.0, 0.2]), ("bad", [-1.0, 0.1])])
    pooled = spark.createDataFrame([([1.0, 0.0], 0), ([-1.0, 0.0], 1)] * 4, "pooled array<double>, label int")
    kinds = {"centroid": scoring.CentroidModel([2.0, 0.0], 0.0, {"kind": "centroid"}),
             "logistic": clf.LogisticModel(clf.fit_logistic(pooled)),
             "lstm": sm.SequenceModel(L.init_params(2, 3, 1), 2, 3)}
    texts = spark.createDataFrame([(1, "good good"), (2, "bad"), (3, "unknown"), (4, None), (5, "")],
                                  "doc_id long, text string")
    for kind, model in kinds.items():
        path = fresh_path(spark, kind)
        model.save(spark, path)
        assert models.stored_kind(spark, path) == kind
        back = models.load_model(spark, path)
        assert type(back) is models.KINDS[kind]
        want, got = ({r.doc_id: tuple(r) for r in api.score_text(spark, texts, vt, m).collect()} for m in (model, back))
        assert got == want and len(got) == 5
        assert [got[k][5] == "OK" for k in range(1, 6)] == [True, True, False, False, False]
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, f"{tmp_path}/nothing")
    odd = fresh_path(spark, "odd")
    spark.createDataFrame([(json.dumps({"kind": "tree"}),)], "config string").write.parquet(odd)
    with pytest.raises(ValueError, match="tree"):
        models.load_model(spark, odd)


@pytest.mark.parametrize("kind", models.KINDS)
def test_command_line_for_each_kind(spark, capsys, kind):
    from tonality.__main__ import main
    root, vec, model, out = (fresh_path(spark, n) for n in ("cli-corpus", "cli-vec", "cli-model", "cli-out"))
    cp.write_corpus(fixtures.reviews(spark, SMOKE), root)
    sv.write_vector_text(vector_table(spark, SMOKE).frame(spark), vec, compression="gzip")
    vec += "/*.gz"
    csv = fresh_path(spark, "cli-csv")
    ec.write_email_csv(fixtures.messages(spark, SMOKE), csv)
    main(["train", "--corpus", root, "--vectors", vec, "--model", model, "--kind", kind, "--hidden", "4"])
    assert models.stored_kind(spark, model) == kind
    main(["score-text", "--vectors", vec, "--model", model, "the the the", ""])
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith(("Sentiment:", "Invalid"))]
    assert len(lines) == 2 and lines[0].startswith("Sentiment: ") and lines[1].startswith("Invalid")
    main(["score-csv", "--csv", csv, "--vectors", vec, "--model", model, "--header", "--out", out])
    assert spark.read.parquet(out).count() == fixtures.messages(spark, SMOKE).count()
    folder = fresh_path(spark, "cli-folder")
    fixtures.documents(spark, SMOKE).select("doc_id", "text").write.parquet(folder)
    main(["score-folder", "--folder", folder, "--vectors", vec, "--model", model, "--out", out + "-stream"])
    assert spark.read.parquet(out + "-stream").count() == 200


# ---------------------------------------------------------------- the sink


def toy(spark, vocab):
    return vocab([("good", [1.0]), ("bad", [-1.0])]), scoring.CentroidModel([2.0], 0.0)


def test_empty_source_gives_an_empty_frame(spark, vocab):
    vt, model = toy(spark, vocab)
    src = fresh_path(spark, "empty-src")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(src)
    got = api.score_folder_stream(spark, src, vt, model)
    assert got.columns == [*st.RESULT_COLUMNS, "batch"] and got.collect() == []
    fs, path = staging._fs(spark, fresh_path(spark, "no-files"))
    fs.mkdirs(path)
    assert api.score_folder_stream(spark, path.toString(), vt, model).collect() == []


def test_readers_see_whole_epochs_and_replays_change_nothing(spark, vocab):
    vt, model = toy(spark, vocab)
    src, sink = fresh_path(spark, "src"), fresh_path(spark, "sink")
    spark.createDataFrame([(1, "good"), (2, "bad")], "doc_id long, text string").write.parquet(src)
    stream = lambda: st.text_stream(spark, src, st.T.StructType(
        [st.T.StructField("doc_id", st.T.LongType()), st.T.StructField("text", st.T.StringType())]))
    st.score_stream(stream(), vt, model, sink, fresh_path(spark, "ck")).awaitTermination()
    first = sorted(map(tuple, st.read_sink(spark, sink).collect()))
    assert [r[0] for r in first] == [1, 2]
    # a half-written epoch (no _SUCCESS) is not seen; a lost checkpoint replays epoch 0
    spark.createDataFrame([(9, "half")], "doc_id long, text string").write.parquet(f"{sink}/batch=7")
    fs, marker = staging._fs(spark, f"{sink}/batch=7/_SUCCESS")
    fs.delete(marker, False)
    st.score_stream(stream(), vt, model, sink, fresh_path(spark, "ck2")).awaitTermination()
    assert sorted(map(tuple, st.read_sink(spark, sink).collect())) == first


# ---------------------------------------------------------------- do-once tables under several writers


def test_two_writers_publish_one_copy(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = fresh_path(spark, "twice")

    def write(k):
        return staging.materialize_once(spark, lambda: spark.createDataFrame([(k,)] * 50, "w int"), path)

    with ThreadPoolExecutor(4) as pool:
        frames = list(pool.map(write, range(4)))
    seen = {tuple(r.w for r in f.collect()) for f in frames}
    assert len(seen) == 1 and len(set(next(iter(seen)))) == 1 and len(next(iter(seen))) == 50
    fs, parent = staging._fs(spark, path.rsplit("/", 1)[0])
    name = path.rsplit("/", 1)[1]
    left = [s.getPath().getName() for s in fs.listStatus(parent) if s.getPath().getName().startswith(name)]
    assert left == [name]


def test_killed_writer_leaves_nothing_that_is_trusted(spark):
    path = fresh_path(spark, "killed")
    half = spark.createDataFrame([(1,)], "w int")
    half.write.parquet(path)
    fs, marker = staging._fs(spark, path + "/_SUCCESS")
    fs.delete(marker, False)
    got = staging.materialize_once(spark, lambda: spark.createDataFrame([(2,), (3,)], "w int"), path)
    assert sorted(r.w for r in got.collect()) == [2, 3]
    with pytest.raises(Exception, match="boom"):
        staging.materialize_once(spark, lambda: spark.range(3).selectExpr("raise_error('boom')"), path + "-x")
    assert not staging.path_exists(spark, path + "-x")
