"""Stream result equals batch result; both read-outs of the recurrent scorer."""

import numpy as np

import __spark_entry__ as E
from tonality.operators import lstm_math as L
from tonality.operators import sequence_model as sm

SMOKE = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    q = E.queries()
    cols = ["doc_id", "n_known", "score_pos", "score_neg", "sentiment", "status"]
    stream = {tuple(r) for r in q["stream_scores"](spark, SMOKE).select(*cols).collect()}
    batch = {tuple(r) for r in q["score_adhoc"](spark, SMOKE).join(
        q["score_status"](spark, SMOKE).select("doc_id", "n_known"), "doc_id").select(*cols).collect()}
    assert stream == batch and len(stream) == 200


def test_padded_read_out_matches_reference_shape(spark):
    D, H = 3, 4
    rng = np.random.default_rng(7)
    model = sm.SequenceModel(L.init_params(D, H, seed=1) + rng.normal(0, 0.3, L.n_params(D, H)), D, H)
    seqs = {1: rng.normal(size=(2, D)), 2: rng.normal(size=(5, D))}
    df = spark.createDataFrame([(k, v.tolist(), len(v)) for k, v in seqs.items()],
                               "doc_id long, seq array<array<float>>, n_known long")
    last = {r.doc_id: r.score_pos for r in sm.score(df, model).collect()}
    padded = {r.doc_id: r.score_pos for r in sm.score(df, model, read_out="padded", max_len=8).collect()}
    for k, v in seqs.items():
        v32 = v.astype(np.float32)
        X, lens = L.pack([v32], D, dtype=np.float32)
        want_last = L.forward(model.flat, X, lens - 1, D, H)[0][0, 0]
        Xp, _ = L.pack([v32], D, length=8, dtype=np.float32)
        want_pad = L.forward(model.flat, Xp, np.array([7]), D, H)[0][0, 0]
        assert abs(last[k] - want_last) < 1e-5 and abs(padded[k] - want_pad) < 1e-5
    assert last != padded


def test_running_stream_picks_up_new_files(spark):
    """A processing-time stream scores files as they arrive in its folder."""
    from tonality.operators.scoring import CentroidModel
    from tonality.session import fresh_path
    from tonality.streaming import scores as st
    from tonality.sources.vectors import stage_vectors

    vt = stage_vectors(spark, spark.createDataFrame([("good", 0, [1.0]), ("bad", 1, [-1.0])],
                                                    "word string, vec_id bigint, vector array<float>"),
                       fresh_path(spark, "stream-vocab"))
    model = CentroidModel([2.0], 0.0)
    src, sink, ckpt = (fresh_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt"))
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "good good")], schema).write.parquet(src + "/a")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
    q = st.score_stream(stream, vt, model, sink, ckpt, processing_time="1 second")
    try:
        q.processAllAvailable()
        spark.createDataFrame([(2, "bad"), (3, "nothing known")], schema).write.parquet(src + "/b")
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.doc_id: (r.sentiment, r.status) for r in spark.read.parquet(sink).collect()}
    assert got[1][0] == "Positive" and got[2][0] == "Negative" and got[3][1].startswith("Invalid")
