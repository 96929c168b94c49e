"""Archives and vector files as sources: round trips, splits, memory, damage, half-written files."""

import gzip
import io
import os
import resource
import tarfile

import numpy as np
import pytest

from tonality import api
from tonality.session import fresh_path, local_path
from tonality.sources import archives as ar
from tonality.sources import binary_vectors as bv
from tonality.sources import vectors as sv


def files_below(root):
    root = local_path(root)
    return sorted(os.path.relpath(os.path.join(b, f), root) for b, _, fs in os.walk(root) for f in fs)


def test_archive_round_trip(spark):
    rows = [(k % 3, f"a/{k}.txt", b"x" * k) for k in range(50)] + [(1, "empty", b""), (1, "../up", b"u"), (2, "é ü", None)]
    df = spark.createDataFrame(rows, "bucket int, member string, content binary")
    root = fresh_path(spark, "tar")
    ar.write_archives(df, root, "bucket", 4)
    names = files_below(root)
    assert "_SUCCESS" in names and not any("_writing" in n for n in names) and 1 <= len(names) - 1 <= 3
    got = sorted((r.member, bytes(r.content)) for r in ar.read_archive_members(spark, root).collect())
    assert got == sorted((m, c or b"") for _, m, c in rows)


def test_only_regular_members_make_rows(spark):
    root = local_path(fresh_path(spark, "odd-tar"))
    os.makedirs(root + "/sub")
    with tarfile.open(root + "/sub/a.tar.gz", "w:gz") as tf:
        for name, kind in (("dir", tarfile.DIRTYPE), ("link", tarfile.SYMTYPE), ("hard", tarfile.LNKTYPE),
                           ("pipe", tarfile.FIFOTYPE)):
            info = tarfile.TarInfo(name)
            info.type, info.linkname = kind, "/etc/passwd"
            tf.addfile(info)
        for name in ("/abs", "../../up", "ok"):
            info = tarfile.TarInfo(name)
            info.size = 2
            tf.addfile(info, io.BytesIO(b"hi"))
    open(root + "/_hidden.tar.gz", "wb").write(b"no archive")
    got = ar.read_archive_members(spark, root).collect()
    assert sorted(r.member for r in got) == ["../../up", "/abs", "ok"] and not os.path.exists(root + "/up")
    empty = local_path(fresh_path(spark, "no-tar"))
    os.makedirs(empty)
    assert ar.read_archive_members(spark, empty).collect() == []


def test_archive_larger_than_the_reader_holds(tmp_path):
    """Members of 400 MB in all are streamed: the reader's memory does not follow the archive."""
    path = str(tmp_path / "big.tar.gz")
    with tarfile.open(path, "w:gz", compresslevel=1) as tf:
        data = bytes(4 << 20)
        for k in range(100):
            info = tarfile.TarInfo(f"m{k}")
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    reader = ar.ArchiveReader({"path": path})
    total = sum(len(c) for b in reader.read(reader.partitions()[0]) for c in b.column("content").to_pylist())
    assert total == 400 << 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000  # KB


def test_killed_write_leaves_no_archive(spark):
    root = fresh_path(spark, "killed-tar")
    df = spark.range(40).selectExpr("id % 4 AS bucket", "concat('m', id) AS member",
                                    "CASE WHEN id = 33 THEN raise_error('boom') ELSE encode('x', 'UTF-8') END AS content")
    with pytest.raises(Exception, match="boom"):
        ar.write_archives(df, root, "bucket", 4)
    assert not [n for n in files_below(root) if n.endswith(".tar.gz")] if os.path.exists(local_path(root)) else True


def vectors(spark, n=300, dim=7):
    rng = np.random.default_rng(1)
    rows = [(f"wörd{k}" if k % 5 else "w" * (1 + k), k, [float(np.float32(x)) for x in rng.normal(size=dim)])
            for k in range(n)]
    # components whose bytes are spaces and line breaks
    rows[3] = ("spaces", 3, [float(np.frombuffer(b"    ", "<f4")[0])] * dim)
    rows[4] = ("breaks", 4, [float(np.frombuffer(b"\n\n\n\n", "<f4")[0])] * dim)
    return rows, spark.createDataFrame(rows, "word string, vec_id bigint, vector array<float>")


def test_binary_and_text_round_trips(spark):
    rows, df = vectors(spark)
    for files in (1, 3):
        path = fresh_path(spark, "bin")
        bv.write_vector_binary(df, path, files)
        for split in (1, 500, 1 << 20):
            back = bv.read_vector_binary(spark, path, split)
            assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [(w, i, v) for w, i, v in rows]
        assert bv.read_vector_binary(spark, path, 500).rdd.getNumPartitions() >= 10
    text = fresh_path(spark, "txt")
    sv.write_vector_text(df, text)
    assert {(r.word, tuple(r.vector)) for r in sv.read_vector_text(spark, text).collect()} == {
        (w, tuple(v)) for w, _, v in rows}


def plain_file(rows, breaks):
    out = f"{len(rows)} {len(rows[0][2])}\n".encode()
    for w, _, v in rows:
        out += w.encode() + b" " + np.asarray(v, "<f4").tobytes() + (b"\n" if breaks else b"")
    return out


def test_binary_files_written_elsewhere_and_damaged_ones(spark, tmp_path):
    rows, _ = vectors(spark, 40)
    for name, body in (("a.bin", plain_file(rows, False)), ("b.bin", plain_file(rows, True))):
        (tmp_path / name).write_bytes(body)
        (tmp_path / (name + ".gz")).write_bytes(gzip.compress(body))
        for f in (name, name + ".gz"):
            got = bv.read_vector_binary(spark, str(tmp_path / f), 64).orderBy("vec_id").collect()
            assert [(r.word, r.vec_id, r.vector) for r in got] == rows
    vt = api.load_vectors(spark, str(tmp_path / "a.bin"))
    assert (vt.n_words, vt.dim) == (40, 7)
    body = plain_file(rows, True)
    for name, damaged, told in (("cut.bin", body[:-9], "cut off|ends before"), ("long.bin", body + b"x", "left after"),
                                ("head.bin", b"word 1.0\n", "no header"), ("none.bin", b"", "no header"),
                                ("few.bin", body.replace(b"40 7", b"90 7", 1), "ends before")):
        (tmp_path / name).write_bytes(damaged)
        for split in (64, 1 << 20):
            with pytest.raises(Exception, match=told):
                bv.read_vector_binary(spark, str(tmp_path / name), split).collect()


def test_strict_text_vectors(spark, tmp_path):
    def read(text, dim=None):
        p = tmp_path / f"v{abs(hash((text, dim)))}.txt"
        p.write_text(text)
        return sorted((r.word, list(r.vector)) for r in sv.read_vector_text(spark, str(p), dim).collect())

    assert read("2 3\na 1 2 3\nb 4 5 6 \n\n") == [("a", [1.0, 2.0, 3.0]), ("b", [4.0, 5.0, 6.0])]
    assert read("a 1 2\n7 3 4\n") == [("7", [3.0, 4.0]), ("a", [1.0, 2.0])]
    assert read("a 1\nb 2\n", 1) == [("a", [1.0]), ("b", [2.0])]
    for text, dim in (("a 1 2 3\nb 1 2\nc 1 2 3\n", None), ("a 1 x 3\nb 1 2 3\n", None), ("a 1 2\n", 3),
                      ("1 2\na 1 2 3\nb 2 3 4\n", None)):
        with pytest.raises(Exception, match="not a word and"):
            read(text, dim)
