"""The user-facing programs over real files: corpus tree, text vectors, CSV."""

import __spark_entry__ as E
from tonality import api
from tonality.operators.scoring import CentroidModel
from tonality.session import fresh_path
from tonality.sources import corpus as cp
from tonality.sources import email_csv as ec
from tonality.sources import fixtures
from tonality.sources import vectors as sv
from tonality.sources.vectors import vector_table

SMOKE = "/root/testdata/sf0.001"


def _files(spark):
    root = fresh_path(spark, "api-corpus")
    cp.write_corpus(fixtures.reviews(spark, SMOKE), root)
    vec = fresh_path(spark, "api-vectors")
    sv.write_vector_text(vector_table(spark, SMOKE).frame(spark), vec, compression="gzip")
    return root, vec + "/*.gz"


def test_train_evaluate_and_score(spark):
    root, vec = _files(spark)
    vt = api.load_vectors(spark, vec)
    corpus = api.labelled_corpus(spark, root)
    model_path = fresh_path(spark, "api-model")
    res = api.train_and_evaluate(spark, corpus, vt, model_path, kind="centroid")
    want = {tuple(r) for r in E.queries()["confusion_matrix"](spark, SMOKE).collect()}
    assert {tuple(r) for r in res.confusion.collect()} == want
    assert res.metrics.count() == 3
    # trained once: a second call reuses the stored model
    again = api.train_and_evaluate(spark, corpus, vt, model_path, kind="centroid")
    assert {tuple(r) for r in again.confusion.collect()} == want

    model = CentroidModel.load(spark, model_path)
    out = api.score_text(spark, ["", "the the the"], vt, model).orderBy("doc_id").collect()
    assert out[0].status.startswith("Invalid") and out[1].status == "OK"

    csv = fresh_path(spark, "api-csv")
    ec.write_email_csv(fixtures.messages(spark, SMOKE), csv)
    scored = api.score_email_csv(spark, csv, vt, model, header=True)
    want_email = {tuple(r) for r in E.queries()["email_sentiment"](spark, SMOKE).collect()}
    assert {tuple(r) for r in scored.collect()} == want_email


def test_logistic_and_lstm_programs(spark):
    root, vec = _files(spark)
    vt = api.load_vectors(spark, vec)
    corpus = api.labelled_corpus(spark, root)
    for kind, extra in (("logistic", {}), ("lstm", {"hidden": 8})):
        res = api.train_and_evaluate(spark, corpus, vt, fresh_path(spark, f"api-{kind}"), kind=kind, **extra)
        assert sum(r.n for r in res.confusion.collect()) > 0


def test_command_line_train_and_score_text(spark, capsys):
    from tonality.__main__ import main
    root, vec = _files(spark)
    model = fresh_path(spark, "cli-model")
    main(["train", "--corpus", root, "--vectors", vec, "--model", model, "--kind", "centroid"])
    out = capsys.readouterr().out
    assert "positive" in out and "macro" in out
    main(["score-text", "--vectors", vec, "--model", model, "the the the", ""])
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith(("Sentiment:", "Invalid"))]
    assert len(lines) == 2 and lines[0].startswith("Sentiment: ") and lines[1].startswith("Invalid")


def test_bucketed_documents_score_without_exchange(spark):
    from tonality.operators.scoring import score_texts, stored_centroid
    vt = vector_table(spark, SMOKE)
    model = stored_centroid(spark, SMOKE, vt)
    docs = fixtures.documents(spark, SMOKE)
    path = fresh_path(spark, "bucketed")
    table = api.bucket_documents(spark, docs, 4, path)
    out = score_texts(table, vt, model, spark)
    rows = sorted(map(tuple, out.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ShuffleQueryStage" not in plan and "Exchange hashpartitioning" not in plan
    assert rows == sorted(map(tuple, score_texts(docs, vt, model, spark).collect()))
    # the staged table is reused: registering it again reads the same folder
    spark.sql("DROP TABLE IF EXISTS tonality_bucketed_" + __import__("hashlib").sha1(path.encode()).hexdigest()[:12])
    again = api.bucket_documents(spark, docs, 4, path)
    assert again.count() == 200
