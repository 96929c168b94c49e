"""Files that our writer left are listed and read by tasks, other trees by Spark's reader."""

import os

from pyspark.sql import functions as F

from tonality.session import fresh_path
from tonality.sources import corpus as cp
from tonality.sources import text_files as tf


def test_written_files_are_not_listed_on_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"text {k} é\n\nend" + "\n" * (k % 3)) for k in range(50)] + [(None, "no id"), (7, "again"), (60, "")],
                                 "doc_id bigint, text string")
    root = fresh_path(spark, "texts")
    cp.write_text_files(docs, root)
    back = cp.scan_text_files(spark, root)
    assert back.inputFiles() == []
    monkeypatch.setattr(tf, "READ_FILES", 3)
    assert sorted(map(tuple, cp.scan_text_files(spark, root).collect())) == sorted(map(tuple, back.collect()))
    # As Spark's own reader has it, paths and all.
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path"), "value")
    ours = tf.read_files(spark, root, tf.task_folders(root))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, raw.collect()))
    assert ours.count() == 52  # rows of one id share a file


def test_other_trees_are_read_as_before(spark, tmp_path):
    for k in range(3):
        os.makedirs(tmp_path / "train" / "pos", exist_ok=True)
        (tmp_path / "train" / "pos" / f"doc_id={k}.txt").write_text(f"words {k}\n")
    assert tf.task_folders(str(tmp_path)) == []
    assert sorted(map(tuple, cp.scan_corpus(spark, str(tmp_path)).collect())) == [
        (k, f"words {k}", "train", "positive") for k in range(3)]
    (tmp_path / "_SUCCESS").write_text("")
    assert tf.task_folders(str(tmp_path)) == []
