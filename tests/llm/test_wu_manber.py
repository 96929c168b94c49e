"""Wu-Manber search against a brute-force window search."""

import hashlib
import random
import re

from tonality.llm import wu_manber as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = []
    for item, text in items:
        if item is None:
            continue
        ws = words(text)
        m = min(window, len(ws))
        windows += [(item, tuple(ws[k:k + m])) for k in range(len(ws) - m + 1 if m else 0)]
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for item, w in windows:
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k:k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    found.add(item)
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(ws), len(hit), len(found),
                    hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(t, i, "z") for i, t in docs], "text string, doc_id bigint, items string")
    b = spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id bigint, block int")
    rows = W.report(W.find_benchmark(d, b, **kw)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def random_case(seed):
    rnd = random.Random(seed)
    vocab = ["a", "b", "c", "the", "été", "x1", "Q"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, text(rnd.choice([0, 1, 2, 3, 9, 10, 11, 14]) if k % 3 else 12)) for k in range(12)]
    docs = [(k, text(rnd.randrange(0, 60))) for k in range(30)]
    docs += [(100 + k, text(7) + " " + items[k][1].upper() + ", " + items[k][1] + text(900)) for k in range(6)]
    return docs, items


def test_random_against_brute_force(spark):
    for seed in range(3):
        docs, items = random_case(seed)
        assert run(spark, docs, items) == brute(docs, items)


def test_blocks_merge_to_the_same(spark):
    docs, items = random_case(7)
    docs += [docs[-1], docs[-1], (None, docs[-1][1])]
    assert run(spark, docs, items, block_bytes=40) == brute(docs, items)


def test_only_long_windows(spark):
    long = [(1, " ".join(f"w{k}" for k in range(15))), (2, " ".join(f"w{k}" for k in range(3, 15)))]
    docs = [(1, "q " * 1000 + long[0][1] + " tail"), (2, " ".join(f"w{k}" for k in range(9))), (3, "")]
    got = run(spark, docs, long)
    assert got == brute(docs, long)
    assert [r[2] for r in got] == [15, 0, 0]


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (None, "a b"), (4, "a b"), (4, "a b")]
    items = [(1, "a b"), (2, None), (3, ""), (None, "a"), (1, "a b"), (11, "A, B!"), (2, "b")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in W.op5_wu_manber(spark, sf).collect()), key=str)
    assert len(got) == len(docs)
    index = {}
    for item, text in items:
        ws = words(text)
        for k in range(len(ws) - 9):
            index.setdefault(tuple(ws[k:k + 10]), set()).add(item)
    want = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for k in range(len(ws) - 9):
            if owners := index.get(tuple(ws[k:k + 10])):
                hit.update(range(k, k + 10))
                found |= owners
        names = ",".join(sorted(map(str, found)))
        want.append((doc_id, len(ws), len(hit), len(found),
                     hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=str)
    assert any(r[5] for r in got)
