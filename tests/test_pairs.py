"""Pairs are summed where they are formed, so that arrays and not pairs are shuffled."""

import itertools
import math

import pytest

from tidewater.operators import similarity as S
from tidewater.plans import similarity_q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _by_hand(rows):
    users: dict = {}
    for u, i, r in rows:
        if u is not None and i is not None:
            users.setdefault(u, []).append((i, r))
    sums: dict = {}
    for own in users.values():
        for (i, x), (j, y) in itertools.combinations(sorted(own), 2):
            if i < j:
                xy, xx, yy, n = sums.get((i, j), (0, 0, 0, 0))
                sums[i, j] = (xy + x * y, xx + x * x, yy + y * y, n + 1)
    return {k: (*v, v[0] / (math.sqrt(v[1]) * math.sqrt(v[2]))) for k, v in sums.items()}


@pytest.fixture()
def ratings(spark, monkeypatch):
    """Users of 1 to 30 items, one of all, over baskets of four; rows that repeat, ids beyond 16 bits, nulls."""
    monkeypatch.setattr(S, "BASKET", 4)
    rows = [(u, (i * i * 7919 + u) % 60 * 1000 + 1, 1 + (u * i) % 200) for u in range(25) for i in range(1 + u * 29 // 24)]
    rows += [(99, i * 1000 + 1, 1 + i) for i in range(60)] + [(1, 1001, 3), (1, 1001, 3), (None, 1, 1), (None, 2, 1), (2, None, 4)]
    return rows, spark.createDataFrame(rows, "user long, item long, rating long")


def _as_map(df):
    return {(r.item1, r.item2): (r.sum_xy, r.sum_xx, r.sum_yy, r.num_pairs, r.similarity) for r in df.collect()}


@pytest.mark.parametrize("how", [{}, {"salt_buckets": 4}, {"hot_shares": 5}])
def test_pairs_are_summed_where_they_are_formed(spark, ratings, monkeypatch, how):
    rows, df = ratings
    monkeypatch.setattr(S, "PAIRS_A_TASK", 500)
    got = S.item_similarity(df, **how)
    assert _as_map(got) == _by_hand(rows)
    assert got.count() == len(_by_hand(rows))
    plan = _plan(got)
    # arrays go to the task of an item, and no exchange moves pairs
    assert "hashpartitioning(a#" in plan and "hashpartitioning(item1" not in plan and "REPARTITION_BY_NUM" in plan


def test_pairs_keep_types(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 1.50BD), (1, 'b', 2.25BD), (2, 'a', 1.00BD) AS t(user, item, rating)")
    got = S.item_similarity(df)
    assert [tuple(map(str, r[:3])) for r in got.collect()] == [("a", "b", "3.3750")] and got.schema["sum_xy"].dataType.precision == 17


@pytest.mark.parametrize("min_pairs, hot_shares", [(1, 1), (1, 12), (2, 12)])
def test_similar_pairs_are_filtered_where_they_are_formed(spark, ratings, min_pairs, hot_shares):
    rows, _ = ratings
    rows = sorted({(u, i): r for u, i, r in rows if u is not None and i is not None}.items())
    rows = [(u, i, r) for (u, i), r in rows]
    df = spark.createDataFrame(rows, "user long, item long, rating long")
    got = S.similar_pairs(df, 0.6, min_pairs, hot_shares=hot_shares)
    assert _as_map(got) == {k: v for k, v in _by_hand(rows).items() if v[3] > min_pairs and v[4] > 0.6}
    if hot_shares == 1:  # no user is hot: nothing is written between forming and filtering
        plan = _plan(got)
        assert "posexplode" in plan and "hashpartitioning(item1" not in plan


def test_similarity_queries_shuffle_no_pairs(spark):
    for q in (similarity_q.item_similarity, similarity_q.item_similarity_salted, similarity_q.similar_pairs):
        plan = _plan(q(spark, "/root/testdata/sf0.01"))  # no hot user
        assert "hashpartitioning(a#" in plan and "hashpartitioning(item1" not in plan, q.__name__
