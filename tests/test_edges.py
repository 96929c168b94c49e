"""Hand-made edge cases (empty and unknown texts, length limits, unequal classes,
ties, nulls, CSV quoting, archives, half-written tables)."""

import gzip
import io
import os
import tarfile


from tonality.functions.text import INVALID_INPUT
from tonality.operators import dataset as ds
from tonality.operators import project as pj
from tonality.operators import tokens as tok
from tonality.operators.scoring import CentroidModel, score_texts
from tonality.operators.tensors import inference_shape
from tonality.plans import staging
from tonality.session import fresh_path, local_path
from tonality.sources import archives as ar
from tonality.sources import email_csv as ec
from tonality.sources import fixtures
from tonality.sources.corpus import scan_corpus


def _texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_unscorable_texts_get_invalid_status(spark, vocab):
    vt = vocab([("good", [1.0, 0.0]), ("bad", [0.0, 1.0])])
    model = CentroidModel([1.0, -1.0], 0.0)
    df = _texts(spark, [(1, ""), (2, "123 ... ,,, !!"), (3, "unknown words only"),
                        (4, None), (5, "Good, GOOD! bad"), (None, "good")])
    got = {r.doc_id: r for r in score_texts(df, vt, model, spark).collect()}
    assert len(got) == 6 and got[None].status == INVALID_INPUT  # a row without a key is kept
    for k in (1, 2, 3, 4):
        assert got[k].status == INVALID_INPUT and got[k].score_pos is None and got[k].n_known == 0
        assert got[k].output.endswith("\n" + INVALID_INPUT)
    assert got[5].status == "OK" and got[5].n_known == 3 and got[5].sentiment == "Positive"


def test_tie_goes_to_positive(spark, vocab):
    vt = vocab([("x", [1.0, 1.0])])
    model = CentroidModel([0.0, 0.0], 0.0)
    r = score_texts(_texts(spark, [(1, "x x")]), vt, model, spark).first()
    assert r.score_pos == r.score_neg == 0.5 and r.sentiment == "Positive"
    assert r.output == "x x\nSentiment: Positive [p(positive)=0.500000 p(negative)=0.500000]"


def test_truncation_at_256_and_257(spark, vocab):
    vt = vocab([("w", [1.0])])
    df = _texts(spark, [(256, " ".join(["w"] * 256)), (257, " ".join(["w"] * 257))])
    toks = fixtures.tokens_of(df)
    trunc = {r.doc_id: r.n for r in tok.sequence_arrays(tok.truncated_tokens(toks, vt, spark)).collect()}
    assert trunc == {256: 256, 257: 256}
    shape = {r.doc_id: (r.out_len, r.filled) for r in
             inference_shape(tok.known_counts(df, toks, vt, spark)).collect()}
    assert shape == {256: (256, 256), 257: (257, 256)}


def _reviews(spark, n_pos, n_neg, split="train"):
    rows = [(i, split, "positive", 0) for i in range(n_pos)] + \
           [(1000 + i, split, "negative", 1) for i in range(n_neg)]
    return spark.createDataFrame(rows, "doc_id long, split string, sentiment string, label int")


def test_interleave_unequal_classes(spark):
    iv = ds.interleave(_reviews(spark, 10, 5)).orderBy("position").collect()
    assert [r.position for r in iv] == list(range(15))
    assert [r.label for r in iv[:10]] == [0, 1] * 5
    assert all(r.label == 0 for r in iv[10:])
    assert [r.doc_id for r in iv if r.label == 0] == list(range(10))


def test_interleave_empty_class_and_batch_of_one(spark):
    iv = ds.interleave(_reviews(spark, 0, 3)).orderBy("position").collect()
    assert [(r.doc_id, r.position) for r in iv] == [(1000, 0), (1001, 1), (1002, 2)]
    mb = ds.minibatches(ds.interleave(_reviews(spark, 1, 0))).collect()
    assert [(r.batch_id, r.row_in_batch) for r in mb] == [(0, 0)]


def test_null_subject_and_out_of_domain_category(spark):
    row = {n: None for n, _ in fixtures.EMAIL_COLUMNS}
    row.update(Id=1.0, SenderPersonId=2.0, ExtractedBodyText="body text",
               ExtractedReleaseInPartOrFull="nonsense")
    df = spark.createDataFrame([tuple(row[n] for n, _ in fixtures.EMAIL_COLUMNS)], fixtures.email_schema())
    code = df.select(pj.category_code("ExtractedReleaseInPartOrFull", fixtures.ROLE_DOMAIN)).first()[0]
    assert code is None
    from tonality.operators.messages import message_texts
    r = message_texts(df).first()
    assert r.raw_email == " body text" and r.msg_key == "1:2"


def _csv_rows():
    return ('Id,DocNumber,MetadataSubject,' + ",".join(n for n, _ in fixtures.EMAIL_COLUMNS[3:]) + "\n",
            '1.5,D1,"Subject, with comma","to",,2012-01-01T00:00:00Z' + "," * 13 +
            '"RELEASE IN FULL","line one\nline ""two""",' + ",,,,,,,\n")


def test_csv_quoted_newline_doubled_quote_header_and_gzip(spark):
    header, line = _csv_rows()
    base = local_path(fresh_path(spark, "csv-edge"))
    os.makedirs(base)
    with open(f"{base}/with_header.csv", "w") as fh:
        fh.write(header + line)
    with open(f"{base}/no_header.csv", "w") as fh:
        fh.write(line)
    with gzip.open(f"{base}/zipped.csv.gz", "wt") as fh:
        fh.write(header + line)
    for name, hdr in (("with_header.csv", True), ("no_header.csv", False), ("zipped.csv.gz", True)):
        rows = ec.read_email_csv(spark, f"{base}/{name}", header=hdr).collect()
        assert len(rows) == 1, name
        r = rows[0]
        assert r.Id == 1.5 and r.MetadataSubject == "Subject, with comma"
        assert r.ExtractedBodyText == 'line one\nline "two"'
        assert r.MetadataDateSent is not None and r.MetadataDateSent.year == 2012


def test_csv_round_trip_keeps_blanks_and_quotes(spark):
    row = {n: None for n, _ in fixtures.EMAIL_COLUMNS}
    row.update(Id=3.0, MetadataSubject="  padded  ", ExtractedBodyText='a "quoted"\r\nbody,')
    df = spark.createDataFrame([tuple(row[n] for n, _ in fixtures.EMAIL_COLUMNS)], fixtures.email_schema())
    path = fresh_path(spark, "csv-rt")
    ec.write_email_csv(df, path)
    back = ec.read_email_csv(spark, path).first()
    assert back.MetadataSubject == "  padded  " and back.ExtractedBodyText == 'a "quoted"\r\nbody,'


def test_tar_with_directory_entry_and_parent_member(spark):
    root = local_path(fresh_path(spark, "tar-edge"))
    os.makedirs(root)
    with tarfile.open(f"{root}/a.tar.gz", "w:gz") as tf:
        d = tarfile.TarInfo("corpus/train/pos")
        d.type = tarfile.DIRTYPE
        tf.addfile(d)
        for name, data in (("corpus/train/pos/1_9.txt", b"fine film"), ("../escape.txt", b"x")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
    rows = {r.member: bytes(r.content) for r in ar.read_archive_members(spark, root).collect()}
    assert rows == {"corpus/train/pos/1_9.txt": b"fine film", "../escape.txt": b"x"}
    assert not os.path.exists(os.path.join(os.path.dirname(root), "escape.txt"))


def test_reference_corpus_layout(spark):
    """File names repeat in all four folders, and the root's own path holds folder names."""
    root = local_path(fresh_path(spark, "corpus-edge")) + "/train/x/pos/root"
    want = set()
    for split in ("train", "test"):
        for cls, name in (("pos", "positive"), ("neg", "negative")):
            os.makedirs(f"{root}/{split}/{cls}", exist_ok=True)
            for k in ("0_9.txt", "1_2.txt", "plain.txt"):
                with open(f"{root}/{split}/{cls}/{k}", "w") as fh:
                    fh.write(f"{split} {cls} {k}\n")
                want.add((split, name, f"{split} {cls} {k}\n"))
    got = scan_corpus(spark, root, strip_newline=False).collect()
    assert len({r.doc_id for r in got}) == len(got) == 12
    assert {(r.split, r.sentiment, r.text) for r in got} == want


def test_messages_without_ids_are_scored_alone(spark, vocab):
    vt = vocab([("good", [1.0]), ("bad", [-1.0])])
    model = CentroidModel([1.0], 0.0)
    df = spark.createDataFrame([("", "good good"), ("", "bad bad bad"), ("", "good good"), (None, "bad"), ("x", None)],
                               "doc_id string, text string")
    got = sorted((r.text or "", r.n_known, r.sentiment, r.status) for r in
                 score_texts(df, vt, model, spark, unique_ids=False).collect())
    assert got == [("", 0, None, INVALID_INPUT), ("bad", 1, "Negative", "OK"), ("bad bad bad", 3, "Negative", "OK"),
                   ("good good", 2, "Positive", "OK"), ("good good", 2, "Positive", "OK")]


def test_verdict_and_loss_are_taken_before_rounding(spark):
    import math

    from tonality.operators.evaluate import cross_entropy

    df = spark.createDataFrame([([-1e-7], 1, "a"), ([20.0], 1, "b")], "pooled array<double>, label int, split string")
    rows = CentroidModel([1.0], 0.0).transform(df)
    first = rows.where("split = 'a'").first()
    assert (first.score_pos, first.score_neg, first.verdict) == (0.5, 0.5, "Negative")
    loss = {r.split: r.loss for r in cross_entropy(rows).collect()}
    assert math.isclose(loss["b"], 20.0, abs_tol=1e-6)


def test_half_written_table_is_rewritten(spark):
    path = fresh_path(spark, "half")
    spark.range(3).write.parquet(path)
    os.remove(os.path.join(local_path(path), "_SUCCESS"))
    assert not staging.is_complete(spark, path)
    out = staging.materialize_once(spark, lambda: spark.range(10), path)
    assert out.count() == 10 and staging.is_complete(spark, path)
    calls = []
    staging.materialize_once(spark, lambda: calls.append(1) or spark.range(1), path)
    assert calls == []


def test_missing_input_raises_with_name(spark):
    import pytest
    with pytest.raises(FileNotFoundError, match="model"):
        staging.require_inputs(spark, {"model": fresh_path(spark, "nothing-here")})


def test_wide_vectors_pool_through_summarizer(spark, vocab):
    import numpy as np

    from tonality.operators.vectors import WIDE_DIM, pooled_vectors
    dim = WIDE_DIM + 2
    rng = np.random.default_rng(3)
    vecs = {w: rng.normal(size=dim) for w in ("a", "b", "c")}
    vt = vocab([(w, v.astype(np.float32).tolist()) for w, v in vecs.items()])
    toks = fixtures.tokens_of(_texts(spark, [(1, "a b b zz c")]))
    got = np.array(pooled_vectors(tok.truncated_tokens(toks, vt, spark), vt, spark).first().pooled)
    want = np.mean([vecs[w].astype(np.float32) for w in ("a", "b", "b", "c")], axis=0)
    assert got.shape == (dim,) and np.allclose(got, want, atol=1e-6)


def test_inference_tensor_lengths_and_fill(spark, vocab):
    """Texts above and below the maximum, and without a known word, in both ways of filling."""
    from tonality.operators import tensors as tz
    from tonality.sources import fixtures

    vt = vocab([("a", [1.0, 2.0]), ("b", [3.0, 4.0])])
    texts = [(1, "a x b"), (2, "a " * 7), (3, "x y"), (4, ""), (5, None), (6, "x x x x x a")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    toks = fixtures.tokens_of(docs)

    def run(fill):
        rows = tz.inference_tensors(docs, toks, vt, spark, max_len=4, fill=fill).collect()
        return {r.doc_id: (r.out_len, r.filled, [v[0] for v in r.tensor]) for r in rows}

    known, every = run("known"), run("all")
    assert known[1] == (4, 2, [1.0, 3.0, 0.0, 0.0]) and every[1] == (4, 3, [1.0, 0.0, 3.0, 0.0])
    assert known[2] == (7, 4, [1.0] * 4 + [0.0] * 3) == every[2]
    assert known[3] == (4, 0, [0.0] * 4) and every[3] == (4, 2, [0.0] * 4)
    assert known[4] == known[5] == (4, 0, [0.0] * 4)
    assert known[6] == (4, 1, [1.0, 0.0, 0.0, 0.0]) and every[6] == (4, 4, [0.0] * 4)
