"""Similarity queries (C6, C7) on implicit ratings = quantity a customer bought of a part."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import similarity as S
from tidewater.plans.registry import register
from tidewater.session import checkpointed
from tidewater.sources.tables import Tables

# Fixed value from the reference: a partner must score above 0.97.
SCORE_THRESHOLD = 0.97
# Co-occurrence must exceed this.  The reference uses 50 on a dense ratings set; our
# purchase data has at most a handful of common buyers per pair, so it is a parameter.
MIN_PAIRS = 1
TOP_K = 10
# A user with more than one part in so many of the ratings is split, by the number of such parts.
HOT_SHARES = 256

_RATINGS_SQL = """r AS (SELECT o_custkey AS u, l_partkey AS i, CAST(sum(l_quantity) AS BIGINT) AS q
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""


def _ratings(spark, sf):
    t = Tables(spark, sf)
    return S.ratings_from_orders(t.lineitem, t.orders)


@register(
    "item_similarity",
    f"""WITH {_RATINGS_SQL}
SELECT a.i AS item1, b.i AS item2, CAST(sum(a.q * b.q) AS BIGINT) AS sum_xy, CAST(sum(a.q * a.q) AS BIGINT) AS sum_xx,
  CAST(sum(b.q * b.q) AS BIGINT) AS sum_yy, count(*) AS num_pairs,
  CASE WHEN sqrt(sum(a.q * a.q)) * sqrt(sum(b.q * b.q)) <> 0
       THEN CAST(sum(a.q * b.q) AS BIGINT) / (sqrt(CAST(sum(a.q * a.q) AS BIGINT)) * sqrt(CAST(sum(b.q * b.q) AS BIGINT)))
       ELSE 0.0 END AS similarity
FROM r a JOIN r b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i""",
    "C6 J7 A22 F7 F19",
)
def item_similarity(spark, sf):
    """Full co-purchase cosine table.  Users with more than one part in HOT_SHARES of the
    ratings (a third of all rows on a skewed cluster) are split over several reducers."""
    # The ratings feed three consumers (the hot-user sketch, both join sides): checkpoint them
    # once to the shared checkpoint folder, which also cuts lineage before the pair stage.
    ratings = checkpointed(_ratings(spark, sf))
    return S.item_similarity(ratings, hot_shares=HOT_SHARES)


@register("item_similarity_salted", None, "C6 J10 J7 A22")
def item_similarity_salted(spark, sf):
    """C6 with every user treated as hot: each user's pairs are spread
    over 4 ``(user, salt)`` reducers (left rows salted by item hash, right rows
    replicated per salt).  Same result as ``item_similarity``; the SQL oracle is shared."""
    return S.item_similarity(checkpointed(_ratings(spark, sf)), salt_buckets=4)


@register(
    "similar_pairs",
    f"""WITH {_RATINGS_SQL},
p AS (SELECT a.i AS item1, b.i AS item2, CAST(sum(a.q * b.q) AS BIGINT) AS sum_xy, CAST(sum(a.q * a.q) AS BIGINT) AS sum_xx,
  CAST(sum(b.q * b.q) AS BIGINT) AS sum_yy, count(*) AS num_pairs FROM r a JOIN r b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i)
SELECT *, CASE WHEN sqrt(sum_xx) * sqrt(sum_yy) <> 0 THEN sum_xy / (sqrt(sum_xx) * sqrt(sum_yy)) ELSE 0.0 END AS similarity
FROM p WHERE num_pairs > {MIN_PAIRS} AND similarity > {SCORE_THRESHOLD}""",
    "C6 J7 A22 F7",
)
def similar_pairs(spark, sf):
    """C6 with threshold and co-occurrence inside the join: the same rows as the filtered full table, without its pairs."""
    return S.similar_pairs(checkpointed(_ratings(spark, sf)), SCORE_THRESHOLD, MIN_PAIRS)


@register(
    "similar_items",
    f"""WITH {_RATINGS_SQL},
t AS (SELECT i FROM r GROUP BY i ORDER BY count(*) DESC, i LIMIT 1),
tr AS (SELECT r.u, r.q, r.i AS t_item FROM r JOIN t ON r.i = t.i),
p AS (SELECT tr.t_item, r.i AS similar_item, CAST(sum(tr.q * r.q) AS BIGINT) AS sum_xy,
             CAST(sum(tr.q * tr.q) AS BIGINT) AS sum_xx, CAST(sum(r.q * r.q) AS BIGINT) AS sum_yy, count(*) AS strength
      FROM tr JOIN r ON tr.u = r.u AND r.i <> tr.t_item GROUP BY tr.t_item, r.i),
s AS (SELECT *, CASE WHEN sqrt(sum_xx) * sqrt(sum_yy) <> 0 THEN sum_xy / (sqrt(sum_xx) * sqrt(sum_yy)) ELSE 0.0 END AS score FROM p),
top AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, similar_item) AS INTEGER) AS rank FROM s WHERE score > {SCORE_THRESHOLD} AND strength > {MIN_PAIRS} ORDER BY score DESC, similar_item LIMIT {TOP_K})
SELECT top.t_item, top.similar_item, coalesce(pt.p_name, 'Unknown') AS target_name,
       coalesce(ps.p_name, 'Unknown') AS similar_name, top.score, top.strength, top.rank
FROM top LEFT JOIN part pt ON top.t_item = pt.p_partkey LEFT JOIN part ps ON top.similar_item = ps.p_partkey ORDER BY top.rank""",
    "C7 J8 P12 O3",
)
def similar_items(spark, sf):
    """C7 (flagship): top-10 parts most similar to the most-bought part, names attached.

    Linear in the target's buyers' rows — no all-pairs self-join.
    """
    ratings = _ratings(spark, sf)
    target = S.most_rated_item(ratings)
    # The top-k has at most TOP_K rows; it is checkpointed (reliable checkpoint in the
    # shared spark.checkpoint.dir) so the name lookup below reads those rows instead of
    # re-running the similarity pipeline once per reference.
    top = S.similar_items(ratings, target, SCORE_THRESHOLD, MIN_PAIRS, TOP_K).checkpoint(eager=True)
    # Names: broadcast the ≤ 2k keys (proven bound) and semi-join the part table
    # against them — one streaming pass over part, no shuffle of it; the few matching
    # rows are checkpointed so both name columns are read from them.
    part = Tables(spark, sf).part.select("p_partkey", "p_name")
    keys = top.select(F.col("t_item").alias("p_partkey")).union(top.select(F.col("similar_item").alias("p_partkey")))
    names = part.join(F.broadcast(keys), "p_partkey", "left_semi").checkpoint(eager=True)
    pt = names.select(F.col("p_partkey").alias("t_item"), F.col("p_name").alias("target_name"))
    ps = names.select(F.col("p_partkey").alias("similar_item"), F.col("p_name").alias("similar_name"))
    out = top.join(pt, "t_item", "left").join(ps, "similar_item", "left")
    return out.select(
        "t_item",
        "similar_item",
        F.coalesce("target_name", F.lit("Unknown")).alias("target_name"),
        F.coalesce("similar_name", F.lit("Unknown")).alias("similar_name"),
        "score",
        "strength",
        "rank",
    ).orderBy("rank")
