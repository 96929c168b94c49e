"""Weighted sampling: likeness against the exact similarity, the query against plain Python, odd rows."""

import hashlib
import itertools
import re
from collections import Counter

import pyarrow.parquet as pq

from tonality.llm import weighted_sampling as S

SPLIT = re.compile("[ \t\n\x0b\x0c\r]+")


def similarity(a, b):
    """Generalised Jaccard similarity of the word counts."""
    x, y = (Counter(w for w in SPLIT.split(t.lower()) if w) for t in (a, b))
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys) if keys else 1.0


def expected(rows):
    """[(doc_id, text, edited, next text)] in the operator's order (ids unique)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        out.append((i, t, t[:len(t) - half] + after[:half], after))
    return out


def run(spark, rows, path, parts=3):
    schema = "doc_id bigint, text string, n int, word string, bin int, entry int, extra boolean, d int, h int"
    spark.createDataFrame([(*r, 1, "w", 2, 3, True, 4, 5) for r in rows], schema).repartition(parts).write.parquet(
        f"{path}/documents.parquet")
    return S.op13_weighted_sampling(spark, str(path)).collect()


def check(got, rows):
    want = {i: (t, e, a) for i, t, e, a in expected(rows)}
    assert len(got) == len(want) == len(rows)
    prints, off = {}, []
    for r in got:
        text, edited, after = want[r.doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            exact = similarity(text, other)
            off.append(near - exact)
            assert exact not in (0.0, 1.0) or near == exact
            assert abs(near - exact) < 0.45
    assert all(len(p) in (0, 8 * S.SLOTS) for p in prints.values())
    return off


def test_query(spark, sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"], strict=True))
    off = check(S.op13_weighted_sampling(spark, sf).collect(), rows)
    assert abs(sum(off) / len(off)) < 0.02  # no bias
    assert (sum(x * x for x in off) / len(off)) ** 0.5 < 0.08


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    """Weighted pairs of known similarity, with so many slots that chance is small."""
    texts = ["a b c d", "a a a b", "a a b b c c", "a " * 9 + "b " * 3, "x y", "b", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sig = {r.doc_id: r.signature for r in S.fingerprints(df, slots=2000).collect()}
    for i, j in itertools.combinations(range(len(texts)), 2):
        got = sum(x == y for x, y in zip(sig[i], sig[j], strict=True)) / 2000
        assert abs(got - similarity(texts[i], texts[j])) < 0.04, (i, j)


def test_many_ranges_give_the_same(spark, tmp_path, monkeypatch):
    rows = [(i * 3 - 40, " ".join(f"w{(i * k) % 17}" for k in range(i % 23))) for i in range(120)]
    a = run(spark, rows, tmp_path / "a")
    check(a, rows)
    monkeypatch.setattr(S, "RANGE_ROWS", 7)
    assert sorted(map(tuple, run(spark, rows, tmp_path / "b", 5))) == sorted(map(tuple, a))


def test_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "é ü " * 3), (7, "x"),
            (None, "no id"), (8, "word " * 40_000 + "end"), (9, "日本語のテキスト"), (-(2 ** 63), "least id"), (10, "😀😀 a")]
    got = {r.doc_id: r for r in run(spark, rows, tmp_path / "a")}
    check(list(got.values()), rows)
    assert got[1].fingerprint == got[2].fingerprint == got[3].fingerprint == "" and got[1].near_next == 1.0
    assert got[3].near_next == 0.0 and got[4].near_next == 1.0
    assert got[10].edited_sha256 == hashlib.sha256("😀😀no".encode()).hexdigest()  # the last meets the first


def test_one_row_no_row_and_repeated_rows(spark, tmp_path):
    one = run(spark, [(5, "a b c d")], tmp_path / "one")
    assert [(r.doc_id, r.near_next, r.n_chars) for r in one] == [(5, 1.0, 7)]
    assert one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
    assert run(spark, [], tmp_path / "none") == []
    same = run(spark, [(1, "p q")] * 30 + [(2, "r s")] * 20, tmp_path / "same")
    assert len(same) == 50 and sum(r.near_next == 1.0 for r in same) == 48


def test_plan_is_native_and_shuffles_texts_once(spark, sf):
    plan = S.op13_weighted_sampling(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange") == 1
