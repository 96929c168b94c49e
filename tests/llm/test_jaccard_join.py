"""Jaccard join against all pairs by brute force."""

import random
import re
from collections import defaultdict

import numpy as np

from tonality.llm import jaccard_join as J

from .test_components import union_find

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    by = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            by[g].append(k)
    common = defaultdict(int)
    for ks in by.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    root = union_find(links)
    low = {}
    for k, (doc_id, _) in enumerate(docs):
        low[root.get(k, k)] = min(low.get(root.get(k, k), doc_id), doc_id)
    return sorted((doc_id, len(sets[k]), low[root.get(k, k)]) for k, (doc_id, _) in enumerate(docs))


def run(spark, docs):
    df = spark.createDataFrame([(t, i, 5, "q") for i, t in docs], "text string, doc_id bigint, n int, digest string")
    return sorted(tuple(r) for r in J.jaccard_components(df).collect())


def test_near_copies_chains_and_shared_passages(spark):
    rnd = random.Random(2)
    word = lambda: "w%d" % rnd.randrange(4000)
    passage = [word() for _ in range(60)]
    docs = []
    for g in range(25):
        base = [word() for _ in range(rnd.randrange(3, 150))]
        for _ in range(rnd.randrange(1, 8)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 5)):
                copy[rnd.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
            if rnd.random() < 0.3:
                base = copy  # chains drift away from the first
    docs += [" ".join([word() for _ in range(20)] + passage) for _ in range(40)]
    docs += [docs[0]] * 30 + [docs[3].upper()]
    rnd.shuffle(docs)
    rows = [(1000 - k, t) for k, t in enumerate(docs)]
    assert run(spark, rows) == brute(rows)


def test_every_round_counts(spark, monkeypatch):
    """Without star rounds the exhaustive round alone finds the same."""
    rnd = random.Random(4)
    docs = []
    for k in range(60):
        base = docs[rnd.randrange(len(docs))].split() if docs and rnd.random() < 0.8 else ["v%d" % rnd.randrange(900) for _ in range(60)]
        base = list(base)
        base[rnd.randrange(len(base))] = f"x{k}"
        docs.append(" ".join(base))
    rows = list(enumerate(docs))
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(J, "STAR_ROUNDS", 0)
    monkeypatch.setattr(J, "GROUP_SHINGLES", 150)
    assert run(spark, rows) == want


def test_heads_keep_the_prefix_guarantee():
    """Sets that are similar enough share the promised number of head shingles."""
    rng = np.random.default_rng(0)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
    often, checked = draw(50), 0
    for k in range(300):
        n = int(rng.integers(5, 120))
        x = np.unique(np.concatenate([rng.choice(often, n // 3), draw(n)]))
        y = np.unique(np.concatenate([rng.permutation(x)[:len(x) - k % 9], draw(k % 5)]))
        shared = np.zeros(1 << (J.SLOT_BITS - 3), np.uint8)
        for h in (*np.intersect1d(x, y), *often):
            slot = int(h) >> (64 - J.SLOT_BITS)
            shared[slot >> 3] |= 128 >> (slot & 7)
        order = J.Order(often, rng.integers(16, 99, 50), shared)
        if 9 * len(np.intersect1d(x, y)) >= 4 * (len(x) + len(y)):
            checked += 1
            met = len(np.intersect1d(order.head(x), order.head(y)))
            assert met >= J.least_meetings(min(len(x), len(y)))
    assert checked > 100


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(3)
    for k in range(200):
        x = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 900))).astype(np.uint64))
        y = np.unique(np.concatenate([x[k % 7:], rng.integers(0, 1 << 63, k % 40).astype(np.uint64)]))
        apart = sum(bin((a ^ b) & (1 << 64) - 1).count("1")
                    for a, b in zip(J.signature(x), J.signature(y), strict=True))
        assert apart <= len(np.setxor1d(x, y))
        assert (len(np.setxor1d(x, y)) - apart) % 2 == 0


def test_many_sets_of_one_passage(spark, monkeypatch):
    """Texts that share most of their shingles but too few for a link are not verified;
    pivots too many to broadcast are dealt in parts."""
    passage = ["p%d" % k for k in range(60)]
    docs = [" ".join([*passage, *("u%d_%d" % (k, j) for j in range(12))]) for k in range(80)]
    docs += [docs[k] + " more" for k in range(0, 80, 2)]
    rows, asked = list(enumerate(docs)), []
    verify = J._verified
    monkeypatch.setattr(J, "_verified", lambda d, i, p: (asked.append(p.count()), verify(d, i, p))[1])
    want = brute(rows)
    assert run(spark, rows) == want
    assert asked[-1] <= 120
    monkeypatch.setattr(J, "GROUP_SHINGLES", 150)
    monkeypatch.setattr(J, "ID_BROADCAST_BYTES", 0)
    assert run(spark, rows) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a"), (7, "long " * 50_000), (8, "long " * 49_999)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    got = run(spark, [(7, "p q r s t u"), (7, "other words here"), (3, "p q r s t u")])
    assert got == [(3, 2, 3), (7, 1, 7), (7, 2, 3)]
    df = spark.createDataFrame([(None, "a b c"), (9, "a b c"), (None, "z")], "doc_id bigint, text string")
    assert {tuple(r) for r in J.jaccard_components(df).collect()} == {(None, 1, 9), (9, 1, 9), (None, 1, None)}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in J.op6_jaccard_join(spark, sf).collect())
    assert got == brute(docs)
    assert sum(r[0] != r[2] for r in got) > 50


def test_sets_without_an_id_are_nodes(spark):
    """A null-id near copy is linked, and carries the link between two others."""
    a = ["w%d" % k for k in range(60)]
    n = [*a[:-5], *("n%d" % k for k in range(5))]
    b = ["b%d" % k for k in range(5)] + n[5:]
    assert 9 * len(shingles(" ".join(a)) & shingles(" ".join(b))) < 4 * 112  # A and B alone are no pair
    rows = [(5, " ".join(a)), (None, " ".join(n)), (None, " ".join(n)), (9, " ".join(b)), (None, "x y z"), (None, "X y z")]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(5, 56, 5), (None, 56, 5), (None, 56, 5), (9, 56, 5), (None, 1, None), (None, 1, None)], key=str)
