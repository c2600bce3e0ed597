"""Slices of ratings are packed before they are shuffled, and sums stay exact."""

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from test_pairs import _as_map, _by_hand, _plan

from tidewater.operators import similarity as S
from tidewater.operators import slices


def _rows(n_users=60, n_items=40):
    return [(u, (u * 7919 + i * (i + 3) * 104729) % 20011, 1 + (u * i) % 50) for u in range(n_users) for i in range(n_items)]


def test_a_pair_takes_few_bytes_of_the_shuffle():
    met, pairs = [], 0
    for u in range(60):
        own = sorted({i: r for v, i, r in _rows() if v == u}.items())
        for k, (a, x) in enumerate(own[:-1]):
            met.append({"t": a % 2, "a": a, "x": x, "items": [i for i, _ in own[k + 1 :]], "ys": [r for _, r in own[k + 1 :]]})
            pairs += len(own) - k - 1
    arrays = pa.list_(pa.int64())
    batch = pa.RecordBatch.from_pylist(met, schema=pa.schema([("t", pa.int32()), ("a", pa.int64()), ("x", pa.int64()), ("items", arrays), ("ys", arrays)]))
    rows = [r for b in slices.packer([5, 9], ["items", "ys"], {"items": 16, "ys": 8})(iter([batch])) for r in b.to_pylist()]
    assert [r["a"] for r in rows] == [5, 9] and sum(r["n"] for r in rows) == len(met)
    assert sum(len(p) for r in rows for c in slices.COLUMNS for p in r[c]) < 3 * pairs


@pytest.mark.parametrize("most", [1, 50, 10**6])
def test_sums_of_packed_slices_are_exact(most):
    """Ids far apart, of either sign, and a task that sums in many steps."""
    rows = [(u, i, (-1) ** u * (3 * u + k)) for u in range(9) for k, i in enumerate([-(1 << 62), -7, 0, 5, 70_000, 1 << 40, (1 << 62) + 3][u % 3 :])]
    met = []
    for u in range(9):
        own = sorted((i, r) for v, i, r in rows if v == u)
        met += [{"t": 0, "a": a, "x": x, "items": [i for i, _ in own[k + 1 :]], "ys": [r for _, r in own[k + 1 :]]} for k, (a, x) in enumerate(own[:-1])]
    arrays = pa.list_(pa.int64())
    kind = pa.schema([("t", pa.int32()), ("a", pa.int64()), ("x", pa.int64()), ("items", arrays), ("ys", arrays)])
    batches = [pa.RecordBatch.from_pylist(met[k : k + 4], schema=kind) for k in range(0, len(met), 4)]
    packed = pa.Table.from_batches(slices.packer([0], ["items", "ys"], {}, most)(iter(batches)))
    got = slices.summer(most)(packed)
    assert {(r["item1"], r["item2"]): (r["sum_xy"], r["sum_xx"], r["sum_yy"], r["num_pairs"]) for r in got.to_pylist()} == {k: v[:4] for k, v in _by_hand(rows).items()}


def test_slices_are_packed_for_their_shuffle(spark, monkeypatch):
    monkeypatch.setattr(S, "PAIRS_A_TASK", 200)
    rows = [(u, u + 7 * i, 1 + (u * i) % 50) for u in range(20) for i in range(12)]
    for how in ({}, {"hot_shares": 4}, {"salt_buckets": 3}):
        got = S.item_similarity(spark.createDataFrame(rows, "user long, item long, rating long"), **how)
        plan = _plan(got)
        assert plan.count("Exchange hashpartitioning(a#") == 1 and "MapInArrow" in plan and "FlatMapGroupsInArrow" in plan
        assert _as_map(got) == _by_hand(rows)


def test_null_ratings_and_long_sums_keep_their_rules(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 2, None), (2, 1, 3), (2, 2, 4), (3, 1, None), (3, 3, 5)], "user long, item long, rating long")
    got = {(r.item1, r.item2): tuple(r)[2:] for r in S.item_similarity(df).collect()}
    assert got == {(1, 2): (12, 13, 16, 2, 12 / (13**0.5 * 4)), (1, 3): (None, None, 25, 1, 0.0)}
    large = spark.createDataFrame([(u, i, 1 << 31) for u in range(3) for i in (1, 2)], "user long, item long, rating long")
    with pytest.raises(PySparkException, match="ARITHMETIC_OVERFLOW|overflow"):
        S.item_similarity(large).collect()
