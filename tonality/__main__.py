"""Command line: ``python -m tonality <command> ...``.

  train         --corpus DIR --vectors PATH --model PATH [--kind centroid|logistic|lstm]
                [--hidden N] [--epochs N]   (lstm)
  score-csv     --csv PATH --vectors PATH --model PATH [--header] --out PATH
  score-text    --vectors PATH --model PATH TEXT [TEXT ...]
  score-folder  --folder DIR --vectors PATH --model PATH --out PATH

The scoring commands take a stored model of any kind; ``score-folder`` reads parquet files of
(doc_id, text) as a stream.
The vectors are a parquet table (word, vector) or a text vector file (.gz allowed).
Results are written as parquet (``--out``) or shown (small texts only).
"""

from __future__ import annotations

import argparse

from . import api
from .operators import sequence_model as sm
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tonality")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--corpus", required=True)
    t.add_argument("--vectors", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--kind", default="centroid", choices=api.MODEL_KINDS)
    t.add_argument("--hidden", type=int, default=sm.REFERENCE_HIDDEN)
    t.add_argument("--epochs", type=int, default=1)
    f = sub.add_parser("score-folder")
    f.add_argument("--folder", required=True)
    f.add_argument("--vectors", required=True)
    f.add_argument("--model", required=True)
    f.add_argument("--out", required=True)
    c = sub.add_parser("score-csv")
    c.add_argument("--csv", required=True)
    c.add_argument("--vectors", required=True)
    c.add_argument("--model", required=True)
    c.add_argument("--header", action="store_true")
    c.add_argument("--out", required=True)
    x = sub.add_parser("score-text")
    x.add_argument("--vectors", required=True)
    x.add_argument("--model", required=True)
    x.add_argument("text", nargs="+")
    for s in (t, f, c, x):
        s.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)

    spark = build_session(master=a.master)
    vt = api.load_vectors(spark, a.vectors)
    if a.cmd == "train":
        res = api.train_and_evaluate(spark, api.labelled_corpus(spark, a.corpus), vt, a.model, a.kind,
                                     hidden=a.hidden, epochs=a.epochs)
        res.confusion.show()
        res.metrics.show()
    elif a.cmd == "score-csv":
        model = api.load_model(spark, a.model)
        api.score_email_csv(spark, a.csv, vt, model, a.header).write.mode("overwrite").parquet(a.out)
    elif a.cmd == "score-folder":
        model = api.load_model(spark, a.model)
        api.score_folder_stream(spark, a.folder, vt, model).write.mode("overwrite").parquet(a.out)
    else:
        model = api.load_model(spark, a.model)
        for r in api.score_text(spark, a.text, vt, model).orderBy("doc_id").collect():
            print(r.output)


if __name__ == "__main__":
    main()
