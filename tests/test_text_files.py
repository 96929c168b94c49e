"""One text per file without a folder, a checksum file and a rename for each."""

import os

from tonality.session import fresh_path, local_path
from tonality.sources import corpus as cp


def _names(root):
    return [os.path.join(at, f) for at, _, files in os.walk(local_path(root)) for f in files if not f.startswith(("_", "."))]


def test_a_file_a_document_in_a_folder_a_task(spark):
    docs = spark.createDataFrame([(i, f"text {i}\nsecond é line\n") for i in range(300)] + [(-7, ""), (900, None)],
                                 "doc_id long, text string")
    root = fresh_path(spark, "files")
    cp.write_text_files(docs, root)
    got = {r.doc_id: r.text for r in cp.scan_text_files(spark, root).collect()}
    assert got == {r.doc_id: r.text or "" for r in docs.collect()}
    names = _names(root)
    assert len(names) == 302 and len({os.path.dirname(n) for n in names}) < 100
    cp.write_text_files(docs.limit(5), root)  # overwrites
    assert cp.scan_text_files(spark, root).count() == 5


def test_corpus_tree_keeps_split_class_and_id(spark):
    rows = [(i, f"t{i}", "test" if i % 5 == 0 else "train", "positive" if i % 3 else "negative") for i in range(60)]
    rv = spark.createDataFrame(rows, "doc_id long, text string, split string, sentiment string")
    root = fresh_path(spark, "tree")
    cp.write_corpus(rv, root)
    assert sorted(map(tuple, cp.scan_corpus(spark, root).collect())) == rows
    assert all(os.path.basename(n).startswith("doc_id=") for n in _names(root))
