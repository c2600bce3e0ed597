"""Item-item cosine similarity.

``ratings`` has one row per (user, item) with a numeric rating.  Integer ratings
keep every sum exact (BIGINT), so scores are reproducible bit for bit.

* :func:`similar_items` (C7) answers "items most similar to X" **without forming
  all pairs**: only the target's raters are joined to their other ratings, so the
  work is linear in the rows of those users, and a hot user costs one pair per
  rating.  This is the operator to use at scale.
* :func:`item_similarity` (C6) materialises the full pair table, which is by
  definition quadratic in items per user.  Users' ratings are shuffled as arrays to
  the task of one item of their pairs (not a hot one), which forms and sums them, so pair rows
  are never written or shuffled.  Users with a large share of the ratings are
  spread over ``(user, salt)`` reducers (others are untouched).
* :func:`similar_pairs` gives the rows of that table above a score and a number of
  common users, filtered where they are summed: pairs that can have enough common users are
  found without the hot users that rate nearly everything.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from tidewater.operators import slices
from tidewater.operators.joins import hot_keys
from tidewater.operators.windows import top_n_per_group
from tidewater.session import checkpointed, ensure_checkpoint_dir, shuffles_dropped


def cosine(sum_xy: Column, sum_xx: Column, sum_yy: Column) -> Column:
    """``xy / (sqrt(xx) sqrt(yy))``, 0.0 when the denominator is 0 (guarded division)."""
    den = F.sqrt(sum_xx) * F.sqrt(sum_yy)
    return F.when(den != 0, sum_xy / den).otherwise(F.lit(0.0))


def ratings_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Implicit ratings: quantity a customer bought of a part (BIGINT), one row per (user, item)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey")
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.sum("l_quantity").cast("long").alias("rating"))
    )


BASKET = 256  # ratings of a user in one row of arrays; users with more have several
PAIRS_A_TASK = 1_000_000
HOT_ITEMS = 4096
_WHOLE = (("tinyint", 8), ("smallint", 16), ("int", 32))


def _ends(df: DataFrame, *names: str) -> tuple[dict[str, tuple[int, int]], bool]:
    """Smallest and largest value of the whole-number columns, in one pass, and if these are all columns and have no NULL."""
    wide = [c for c in names if isinstance(df.schema[c].dataType, LongType | IntegerType)]
    row = df.agg(F.count(F.lit(1)), *(f(c) for c in wide for f in (F.min, F.max, F.count))).first()
    ends = {c: (row[1 + 3 * i], row[2 + 3 * i]) for i, c in enumerate(wide) if row[3 + 3 * i]}
    return ends, len(ends) == len(names) and all(row[3 + 3 * i] == row[0] for i in range(len(wide)))


def _packed(array: Column, name: str, low: int, ends: tuple[int, int] | None) -> list[Column]:
    """An array of whole numbers as one of their low bits, and one of the rest in the smallest type that holds it;
    such arrays compress far better in a shuffle.  Other arrays stay as they are."""
    if ends is None:
        return [array.alias(name)]
    fits = lambda bits: -(1 << (bits - 1)) <= ends[0] and ends[1] < 1 << (bits - 1)
    kind = dict((v, k) for k, v in _WHOLE)[low]
    if fits(low):
        return [array.cast(f"array<{kind}>").alias(name)]
    rest = next((t for t, bits in _WHOLE if fits(low + bits)), "bigint")
    half = 1 << (low - 1)
    below = F.transform(array, lambda v: (F.pmod(v, F.lit(2 * half).cast("long")) - half).cast(kind))
    return [below.alias(name), F.transform(array, lambda v: F.shiftright(v, low).cast(rest)).alias(f"{name}_up")]


def _unpacked(value, columns: list[str], name: str, low: int) -> Column:
    """The number that ``value`` (how to take one element of a column) gives, of what :func:`_packed` made."""
    if f"{name}_up" not in columns:
        return value(name)
    return F.shiftleft(value(f"{name}_up").cast("long"), low) + value(name).cast("long") + (1 << (low - 1))


def _pair_sums(ratings: DataFrame, salt_buckets: int = 1, hot_shares: int | None = None) -> DataFrame:
    """Sums and counts of all pairs ``item1 < item2`` of the users' ratings, grouped where the pairs are formed.

    A user's ratings are ordered by item, hot items (more than one part in ``HOT_ITEMS`` of the ratings) last and
    by their share, and kept as arrays of at most ``BASKET``.  Each rating goes with the later ones of its user, as
    slices of those arrays, to the task of the rating's own item: those of its own array from where they lie, those of
    the user's other arrays through a join.  All rows of a pair thus meet in one task, a hot item's in those of the
    others: pairs are formed and summed there, and only slices are shuffled.  Slices of whole numbers are packed for
    that (:mod:`tidewater.operators.slices`), unless a rating is NULL or a sum might pass a BIGINT.
    """
    kind = {c: ratings.schema[c].dataType for c in ("item", "rating")}
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    ratings = ratings.select("user", "item", "rating").where(F.col("user").isNotNull() & F.col("item").isNotNull())
    with shuffles_dropped(spark):
        ends, whole = _ends(ratings, "item", "rating")
    common = F.broadcast(checkpointed(hot_keys(ratings, "item", HOT_ITEMS)).withColumnsRenamed({"item": "__hot", "salts": "n"}))
    counted = ratings.join(common, F.col("item") == F.col("__hot"), "left").drop("__hot").fillna(0, ["n"])
    place = F.row_number().over(Window.partitionBy("user").orderBy("n", "item")) - 1
    placed = counted.withColumn("p", place).withColumn("basket", F.floor(F.col("p") / BASKET).cast("int"))
    rows = placed.groupBy("user", "basket").agg(F.array_sort(F.collect_list(F.struct("p", "item", "rating"))).alias("b"))
    arrays = [*_packed(F.col("b.item"), "items", 16, ends.get("item")), *_packed(F.col("b.rating"), "ys", 8, ends.get("rating"))]
    baskets = checkpointed(rows.select("user", "basket", *arrays))
    names = baskets.columns[2:]
    k = F.sum(F.size("items")).cast("double")
    with shuffles_dropped(spark):
        n_pairs = baskets.groupBy("user").agg((k * (k - 1) / 2).alias("n")).agg(F.sum("n")).first()[0] or 0.0
    tasks = max(1, math.ceil(n_pairs / PAIRS_A_TASK))

    def at(column):
        return F.get(F.col(column), F.col("at"))

    item, rating = (lambda v: _unpacked(v, names, "items", 16).cast(kind["item"])), (lambda v: _unpacked(v, names, "ys", 8).cast(kind["rating"]))

    def listed(df):
        df = df.select("user", F.col("basket").alias("own"), *names, F.posexplode("items").alias("at", "first"))
        return df.withColumns({"a": item(lambda c: F.col("first") if c == "items" else at(c)), "x": rating(at)})

    def sliced(df, start):
        return df.where(start <= F.size("items")).select("a", "x", *(F.slice(c, start, F.size("items")).alias(c) for c in names))

    if salt_buckets > 1:  # every user is cut up by several tasks
        one, two = baskets, baskets
        salts = F.lit(salt_buckets).cast("long")
    else:  # only arrays that have later ones, with these
        one, two = baskets.where(F.size("items") == BASKET), baskets.where("basket > 0")
        salts = F.lit(1).cast("long")
    one, two = listed(one).select("user", "own", "at", "a", "x"), two.withColumnRenamed("user", "user_b")
    if hot_shares and salt_buckets == 1:
        hot = F.broadcast(checkpointed(hot_keys(ratings, "user", hot_shares).withColumnRenamed("user", "__hot")))
        one = one.join(hot, F.col("user") == F.col("__hot"), "left").drop("__hot")
        two = two.join(hot, F.col("user_b") == F.col("__hot"), "left").drop("__hot")
        salts = F.coalesce("salts", salts)
    one = one.withColumn("salt", F.pmod(F.xxhash64("a"), salts)).drop("salts")
    two = two.withColumn("salt_b", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    on = (F.col("user") == F.col("user_b")) & (F.col("salt") == F.col("salt_b"))
    if salt_buckets > 1:
        start = F.when(F.col("own") == F.col("basket"), F.col("at") + 2).otherwise(1)
        met = sliced(one.join(two, on & (F.col("own") <= F.col("basket"))), start)
    else:
        met = sliced(listed(baskets), F.col("at") + 2).union(sliced(one.join(two, on & (F.col("own") < F.col("basket"))), F.lit(1)))

    if whole and max(map(abs, ends["rating"])) ** 2 * max(n_pairs, 1) < 1 << 63:
        # a task's key is one that goes to a partition of its own; any other would do, less evenly
        with shuffles_dropped(spark):
            found = spark.range(16 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("t")).agg(F.min("id").alias("id")).collect()
        keys = {r.t: r.id for r in found}
        pack = slices.packer([keys.get(t, t) for t in range(tasks)], names, {"items": 16, "ys": 8})
        to = met.select(F.pmod(F.hash(F.col("a").cast("long")), F.lit(tasks)).alias("t"), F.col("a").cast("long").alias("a"), F.col("x").cast("long").alias("x"), *names)
        packed = to.mapInArrow(pack, slices.PACKED).repartition(tasks, "a")
        sums = packed.groupBy("a").applyInArrow(slices.summer(), slices.SUMS)
        return sums.withColumns({c: F.col(c).cast(kind["item"]) for c in ("item1", "item2")})
    met = met.repartition(tasks, "a").sortWithinPartitions("a")
    pairs = met.select("a", "x", *names[1:], F.posexplode("items").alias("at", "first"))
    pairs = pairs.select("a", "x", item(lambda c: F.col("first") if c == "items" else at(c)).alias("b"), rating(at).alias("y"))
    sums = pairs.where(F.col("a") != F.col("b")).groupBy("a", "b").agg(
        F.sum(F.col("x") * F.col("y")).alias("xy"),
        F.sum(F.col("x") * F.col("x")).alias("aa"),
        F.sum(F.col("y") * F.col("y")).alias("bb"),
        F.count(F.lit(1)).alias("num_pairs"),
    )
    ordered = F.col("a") < F.col("b")
    return sums.select(
        F.least("a", "b").alias("item1"),
        F.greatest("a", "b").alias("item2"),
        F.col("xy").alias("sum_xy"),
        F.when(ordered, F.col("aa")).otherwise(F.col("bb")).alias("sum_xx"),
        F.when(ordered, F.col("bb")).otherwise(F.col("aa")).alias("sum_yy"),
        "num_pairs",
    )


def item_similarity(ratings: DataFrame, salt_buckets: int = 1, hot_shares: int | None = None) -> DataFrame:
    """Every co-rated item pair ``item1 < item2`` with sums, count and cosine score.

    Pairs are summed in the task that forms them (:func:`_pair_sums`).

    Hot users: a user with k ratings yields k slices of up to k ratings, all cut by the task that
    owns the user.  With ``hot_shares``, users that hold more than one part in so many of
    the ratings are found by a sketch and listed with as many salts as they fill such
    parts (at most ``2 * hot_shares`` rows, broadcast): left rows get salt = hash(item), the right
    rows are repeated once a salt, so the user's slices are cut by that many
    reducers.  Other users are not repeated.  ``salt_buckets`` above 1 instead salts every
    user alike.  Every variant yields exactly the same rows.

    ``ratings`` is read several times, so it should be a written table.
    """
    return _scored(_pair_sums(ratings, salt_buckets, hot_shares))


def _scored(sums: DataFrame) -> DataFrame:
    return sums.withColumn("similarity", cosine(F.col("sum_xy"), F.col("sum_xx"), F.col("sum_yy")))


def similar_pairs(ratings: DataFrame, score_threshold: float, min_pairs: int, hot_shares: int = 256) -> DataFrame:
    """C6 with its filters where the pairs are formed: pairs with ``similarity > score_threshold`` and ``num_pairs > min_pairs``.

    Exactly the rows of the full table that pass.  Let t = ``min_pairs`` + 1 common users be needed.
    Items with fewer than t users are left out.  Without hot users (more than one part in ``hot_shares`` of the
    ratings, found by a sketch) pairs are summed and filtered in the task that forms them.

    Of each item's hot users the t - 1 that rate most items are else
    set aside (a group limit before the shuffle, whatever the size of the item).  Two items with t
    common users share one that neither has set aside: the last of t common users, in the one order of users,
    has t - 1 before it in either item.  So pairs are
    formed from the other users only, and users that rate nearly everything, whose pairs are
    most of all, form hardly any.  The users set aside are then added to the sums of
    those pairs alone: a lookup of t - 1 users for either item.

    ``ratings``: one row a (user, item), not NULL; it is read several times, so it should be a written table.
    """
    t = min_pairs + 1
    ensure_checkpoint_dir(ratings.sparkSession)
    ratings = ratings.select("user", "item", "rating")
    large = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= t).select("item")
    ratings = ratings.join(large, "item", "left_semi")
    hot = None if t == 1 else hot_keys(ratings, "user", hot_shares).select("user").checkpoint(eager=True)
    if hot is None or hot.isEmpty():
        sums = _pair_sums(ratings)
    else:
        busy = ratings.join(F.broadcast(hot), "user", "left_semi")
        active = busy.groupBy("user").agg(F.count(F.lit(1)).alias("k"))
        ranked = busy.join(active, "user")
        aside = top_n_per_group(ranked, "item", [F.col("k").desc(), F.col("user")], t - 1).select("user", "item", "rating").checkpoint(eager=True)
        rest = ratings.join(aside, ["user", "item"], "left_anti")
        formed = _pair_sums(rest).checkpoint(eager=True)
        found = formed.select("item1", "item2")
        # users set aside by the first item, whatever they are to the second; then those set aside by the second alone
        one = aside.select("user", F.col("item").alias("item1"), F.col("rating").alias("x"))
        two = ratings.select("user", F.col("item").alias("item2"), F.col("rating").alias("y"))
        more = found.join(one, "item1").join(two, ["user", "item2"]).select("item1", "item2", "x", "y")
        one = rest.select("user", F.col("item").alias("item1"), F.col("rating").alias("x"))
        two = aside.select("user", F.col("item").alias("item2"), F.col("rating").alias("y"))
        more = more.union(found.join(two, "item2").join(one, ["user", "item1"]).select("item1", "item2", "x", "y"))
        added = more.select(
            "item1", "item2", (F.col("x") * F.col("y")).alias("sum_xy"), (F.col("x") * F.col("x")).alias("sum_xx"),
            (F.col("y") * F.col("y")).alias("sum_yy"), F.lit(1).cast("long").alias("num_pairs"),
        )
        sums = formed.unionByName(added).groupBy("item1", "item2").agg(
            *(F.sum(c).alias(c) for c in ("sum_xy", "sum_xx", "sum_yy", "num_pairs"))
        )
    return _scored(sums).where((F.col("similarity") > score_threshold) & (F.col("num_pairs") > min_pairs))


def similar_items(
    ratings: DataFrame,
    target: DataFrame,
    score_threshold: float,
    min_pairs: int,
    k: int = 10,
) -> DataFrame:
    """Top-k items most similar to each target item.

    ``target`` is a DataFrame with one column ``item`` (usually one row: the item asked
    for; building it with Spark keeps the id choice on the executors).  A partner must
    have ``similarity > score_threshold`` and ``num_pairs > min_pairs``; ties on the
    score are broken by the smaller item id; ``rank`` is the place per target.  The same scores as the full pair
    table (C6) are produced for the target's pairs.
    """
    t = F.broadcast(target.select(F.col("item").alias("t_item")))  # one row, proven bound
    tr = ratings.join(t, F.col("item") == F.col("t_item")).select(
        F.col("user").alias("t_user"), F.col("rating").alias("x"), "t_item"
    )
    others = ratings.select("user", F.col("item").alias("similar_item"), F.col("rating").alias("y"))
    pairs = tr.join(others, (F.col("t_user") == F.col("user")) & (F.col("similar_item") != F.col("t_item")))
    sims = pairs.groupBy("t_item", "similar_item").agg(
        F.sum(F.col("x") * F.col("y")).alias("sum_xy"),
        F.sum(F.col("x") * F.col("x")).alias("sum_xx"),
        F.sum(F.col("y") * F.col("y")).alias("sum_yy"),
        F.count(F.lit(1)).alias("strength"),
    )
    sims = sims.withColumn("score", cosine(F.col("sum_xy"), F.col("sum_xx"), F.col("sum_yy")))
    good = sims.filter((F.col("score") > score_threshold) & (F.col("strength") > min_pairs))
    # top-k per target (one target: the classic top-k); a partial group limit keeps
    # each map task's candidates to k per target before the shuffle
    return top_n_per_group(good, "t_item", [F.col("score").desc(), F.col("similar_item")], k, rank_col="rank")


def most_rated_item(ratings: DataFrame) -> DataFrame:
    """One-row DataFrame with the item rated by the most users (smallest id on ties)."""
    return (
        ratings.groupBy("item")
        # count(rating), not count(*): keeps the ratings sub-plan identical to the one
        # used for the pairs, so Spark reuses its shuffle instead of recomputing it.
        .agg(F.count("rating").alias("n"))
        .orderBy(F.col("n").desc(), F.col("item"))
        .limit(1)
        .select("item")
    )
