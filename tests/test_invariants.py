"""Invariants from the test strategy, checked on the registered queries (sf0.001)."""

from collections import defaultdict

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def test_positions_gap_free_and_full_batches(spark):
    rows = E.queries()["minibatches"](spark, SMOKE).collect()
    by_split = defaultdict(list)
    for r in rows:
        by_split[r.split].append(r)
    for split, rs in by_split.items():
        assert sorted(r.position for r in rs) == list(range(len(rs))), split
        sizes = defaultdict(int)
        for r in rs:
            sizes[r.batch_id] += 1
            assert r.row_in_batch == r.position % 64
        last = max(sizes)
        assert all(n == 64 for b, n in sizes.items() if b != last)
        assert 1 <= sizes[last] <= 64


def test_mask_sums(spark):
    for r in E.queries()["sequence_masks"](spark, SMOKE).collect():
        assert len(r.feature_mask) == len(r.label_mask) == r.L
        assert sum(r.feature_mask) == r.n <= 256
        assert sum(r.label_mask) == (1 if r.n > 0 else 0)
        if r.n > 0:
            assert r.label_mask[r.n - 1] == 1


def test_padded_length_and_score_pairs(spark):
    for r in E.queries()["padded_sequences"](spark, SMOKE).collect():
        assert len(r.step_sums) == r.L and all(x == 0.0 for x in r.step_sums[r.n:])
    for r in E.queries()["linear_scores"](spark, SMOKE).collect():
        if r.score_pos is not None:
            assert abs(r.score_pos + r.score_neg - 1.0) <= 2e-6
            assert r.predicted == ("Positive" if r.score_pos >= r.score_neg else "Negative")
        else:
            assert r.n == 0
