"""Token ORC: exact round trip against the tokenizers library, offsets, pruning, odd rows."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tonality.llm import token_orc as T
from tonality.session import fresh_path


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(T.default_tokenizer())


def expected(rows, tok):
    out, start = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["", None, " ", "  a  b \n c", "a b", "\ttab  x", "naïve été x  y", "a b c", "x " * 500,
       "line one.\nline two", "don't  stop ' s", "1 2 33 444", "\x1c a \x1f b", "end \n"]


def test_pieces_equal_whole_texts(tok):
    coder = T.PieceEncoder(T.default_tokenizer())
    for _ in range(2):
        values, lens = coder.encode(ODD, 2)
        want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in ODD]
        assert lens.tolist() == [len(w) for w in want]
        assert values.tolist() == [i for w in want for i in w]


def test_round_trip_of_odd_rows(spark, tok):
    rows = list(enumerate(ODD))
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in reversed(rows)],
                               "text string, doc_id bigint, tokens string, file int")
    path = T.write_token_orc(df, fresh_path(spark, "t-orc"), T.default_tokenizer())
    got = sorted(tuple(r) for r in T.stream_digest(T.read_token_orc(spark, path)).collect())
    assert got == expected(rows, tok)
    one = T.read_token_orc(spark, path, doc_ids=[3])
    assert [r.tokens for r in one.collect()] == [tok.encode(ODD[3], add_special_tokens=False).ids + [2]]
    assert "doc_id" in one._jdf.queryExecution().toString().split("PushedFilters")[1][:80]


def test_null_and_repeated_ids(spark, tok):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "n"), (0, None)],
                               "doc_id bigint, text string")
    path = T.write_token_orc(df, fresh_path(spark, "t-orc"), T.default_tokenizer())
    got = T.stream_digest(T.read_token_orc(spark, path)).collect()
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert len(got) == 5 and all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 0, 1, 1, 1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    path = T.write_token_orc(df, fresh_path(spark, "t-orc"), T.default_tokenizer())
    assert T.stream_digest(T.read_token_orc(spark, path)).collect() == []


def test_query_equals_library(spark, sf, tok):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in T.op1_token_orc(spark, sf).collect())
    assert got == expected(docs, tok)


def test_files_follow_by_number_not_by_name(spark):
    """From 100,000 files on part names no longer sort like part numbers."""
    from pyspark.sql import functions as F
    files = spark.range(100_001).select(F.format_string("part-%05d-x.orc", "id").alias("file"), F.lit(2).cast("bigint").alias("n_tokens"))
    base = {r.file: r.base for r in T.with_bases(files).where("file IN ('part-00001-x.orc', 'part-99999-x.orc', 'part-100000-x.orc')").collect()}
    assert base == {"part-00001-x.orc": 2, "part-99999-x.orc": 199_998, "part-100000-x.orc": 200_000}


def test_words_are_learned_without_marks_and_line_feeds(tok):
    coder = T.PieceEncoder(T.default_tokenizer())
    texts = ["a cat, a cat. a cat\ncat", "cat; a cat", "(a). cat's, 3, é, ."]
    values, lens = coder.encode(texts, 2)
    want = [tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert values.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]
    assert {" cat", "cat", " a", "\n", ",", ".", ";"} < set(coder.memo)
    assert not {" cat,", " cat.", " cat\ncat", "cat;"} & set(coder.memo)


def test_a_full_memo_keeps_the_words_met_again(tok, monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 40)
    coder = T.PieceEncoder(T.default_tokenizer())
    for turn in range(6):
        texts = ["the cat and the dog " + " ".join(f"w{turn}x{k}" for k in range(30)), "the dog"]
        values, _ = coder.encode(texts, 2)
        assert values.tolist() == [i for t in texts for i in tok.encode(t, add_special_tokens=False).ids + [2]]
        assert len(coder.memo) <= 80
        if turn > 2:
            assert {" the", " cat", " and", " dog"} <= set(coder.memo) and " w0x1" not in coder.memo


def test_the_encoder_goes_on_from_task_to_task():
    assert T.encoder(T.default_tokenizer()) is T.encoder(T.default_tokenizer())


def test_small_batches_and_memo_give_the_same_files(spark, tok):
    rows = [(k, t) for k, t in enumerate(ODD * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = T.write_token_orc(docs, fresh_path(spark, "t"), T.default_tokenizer(), batch_rows=3, memo_pieces=4)
    got = T.stream_digest(T.read_token_orc(spark, path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows, tok)
    coder = T.PieceEncoder(T.default_tokenizer(), memo_pieces=4)
    for k in range(200):
        coder.encode([f"w{k} w{k + 1}"], 2)
        assert len(coder.memo) <= 4 + 4


def test_a_worker_can_forget_its_encoders():
    path = T.default_tokenizer()
    T.encoder(path, 1000).encode(["some words to learn"], 2)
    assert (path, 1000) in T._ENCODERS
    T.forget_encoders()
    assert not T._ENCODERS
