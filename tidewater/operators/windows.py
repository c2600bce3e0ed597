"""Window operators, written to survive a hot entity.

A plain ``Window.partitionBy(entity)`` puts every row of one entity into one task.
If one user / customer holds a third of all rows, that task sorts and buffers a
third of the data.  The ordered scans here (running total, lag/lead, sessions)
are therefore computed in two levels:

1. rows are cut into *chunks* of the ordering key (e.g. one day of timestamps);
   the window runs per ``(entity, chunk)``, so a hot entity is spread over many
   tasks;
2. a tiny per-chunk summary (one row per ``(entity, chunk)``) carries what a
   chunk needs from its predecessors (running offset, last value, session
   count); it is computed with a window over chunks and joined back.

Both levels are exact: peers of a RANGE frame share an ordering key and hence a
chunk, and the cross-chunk terms are folded in from the summary.
Top-n per group relies on Spark's partial ``WindowGroupLimit`` (map-side top-n
before the shuffle); an optional salted first round is available for plans
without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import as_cols, epoch_seconds
from tidewater.operators.joins import salted_join

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[Column],
    n: int = 1,
    method: str = "row_number",
    salt_buckets: int | None = None,
    rank_col: str = "rnk",
) -> DataFrame:
    """Rows ranked ≤ n inside each group (``row_number`` needs a unique tie-break).

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle (map-side
    top-n per group) and a final one after it, so a group holding a third of all rows
    reaches the shuffle as ≤ n rows per map task (measured in ``SKEW.md``).
    ``salt_buckets`` adds an explicit first round over ``(group, salt)`` (salt = hash of
    the row, deterministic on retry) for plans where the partial limit does not apply
    (e.g. n above ``spark.sql.optimizer.windowGroupLimitThreshold``); it is exact for
    ``row_number``, ``rank`` and ``dense_rank``.
    """
    keys = as_cols(keys)
    ranker = _RANKERS[method]
    src = df
    if salt_buckets and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, salt).orderBy(*order)
        src = df.withColumn("__r1", ranker().over(w1)).filter(F.col("__r1") <= n).drop("__r1")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return src.withColumn(rank_col, ranker().over(w2)).filter(F.col(rank_col) <= n)


def top_ranks(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    n: int,
    dense: bool = False,
    salt_buckets: int = 64,
    rank_col: str = "rnk",
) -> DataFrame:
    """W2 with ties kept: rows whose ``rank`` (or ``dense_rank``) in ascending ``order`` columns is ≤ n.

    A rank needs no row but those with smaller order values: rows are counted per (group,
    order value), pre-aggregated before the shuffle; the counts before each value give
    its rank; only values that reach n are joined back.  A group with very many rows tied
    at the top is one row in the counts, and its rows are split over several tasks in
    the join (:func:`~tidewater.operators.joins.salted_join`).  NULL groups and values are values.
    """
    keys, order = as_cols(keys), as_cols(order)
    by = keys + order
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(*order)
    if dense:
        place = F.row_number().over(w)
    else:
        # only a group's first n values can have a rank of n or less, and Spark cuts to them before the sum
        counts = counts.withColumn("__d", F.row_number().over(w)).where(F.col("__d") <= n).drop("__d")
        place = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    kept = counts.withColumn(rank_col, place.cast("int")).where(F.col(rank_col) <= n).drop("__n")
    kept = kept.select(F.xxhash64(*by).alias("__h"), *[F.col(c).alias(f"__k_{c}") for c in by], rank_col)
    rows = df.withColumn("__h", F.xxhash64(*by))
    joined = salted_join(rows, kept, "__h", salt_buckets)
    for c in by:  # the hash only finds partners
        joined = joined.where(F.col(c).eqNullSafe(F.col(f"__k_{c}")))
    return joined.select(*df.columns, rank_col)


def rank_all(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """``rank`` and ``dense_rank`` (ascending ``order`` columns) for every row.

    Default: rank = 1 + number of rows of the group with a smaller order key;
    dense_rank = position of the key among the group's distinct keys.  Both come from
    a count per ``(group, order key)`` — a map-side pre-aggregated table, one row per
    distinct key — ranked with a small window and joined back (NULL-safe).  A hot group
    costs one row per distinct order value.

    ``chunk``: an order-preserving bucket of the order key (e.g. the day of a
    timestamp).  Then ranks are computed per ``(group, chunk)`` and offset by the row and
    distinct-key counts of earlier chunks — for order keys with many distinct values a
    hot group is spread over its chunks.  Ties share a chunk, so both modes are exact.
    """
    keys = as_cols(keys)
    order = as_cols(order)
    if chunk is not None:
        d = df.withColumn("__c", chunk)
        w_local = Window.partitionBy(*keys, "__c").orderBy(*order)
        d = d.withColumns({"__lr": F.rank().over(w_local), "__ld": F.dense_rank().over(w_local)})
        summary = d.groupBy(*keys, "__c").agg(
            F.count(F.lit(1)).alias("__n"), F.max("__ld").alias("__nd")
        )
        w_chunks = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
        summary = summary.select(
            *[F.col(c).alias(f"__k_{c}") for c in keys],
            F.col("__c").alias("__k___c"),
            F.coalesce(F.sum("__n").over(w_chunks), F.lit(0)).alias("__on"),
            F.coalesce(F.sum("__nd").over(w_chunks), F.lit(0)).alias("__od"),
        )
        cond = F.col("__c").eqNullSafe(F.col("__k___c"))
        for c in keys:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        out = d.join(summary, cond, "inner")
        return out.withColumns(
            {
                "rnk": (F.col("__on") + F.col("__lr")).cast("int"),
                "dense_rnk": (F.col("__od") + F.col("__ld")).cast("int"),
            }
        ).drop("__c", "__lr", "__ld", "__on", "__od", "__k___c", *[f"__k_{c}" for c in keys])
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(*order)
    ranks = counts.select(
        *[F.col(c).alias(f"__k_{c}") for c in keys + order],
        (F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
        .cast("int").alias("rnk"),
        F.row_number().over(w).alias("dense_rnk"),
    )
    cond = None
    for c in keys + order:
        e = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = e if cond is None else cond & e
    return df.join(ranks, cond, "inner").drop(*[f"__k_{c}" for c in keys + order])


def _chunk(ts_seconds: Column, chunk_seconds: int) -> Column:
    return F.floor(ts_seconds / F.lit(chunk_seconds)).cast("long")


def _reads(columns: Sequence[str]) -> Column:
    """Always true, but made from all ``columns``.

    Spark reuses an exchange only where both sides read the same columns.  A summary of chunks needs
    few of them; after a filter by this, it and the rows both read all, so the summary is made from
    the very exchange whose rows it is joined to, and these are scanned and shuffled once.
    """
    return F.xxhash64(*columns).bitwiseAND(F.lit(0)) == 0


def _with_summary(rows: DataFrame, summary: DataFrame, entity: str) -> DataFrame:
    """Join a per-(entity, chunk) summary back; NULL entities and NULL times are groups like any other."""
    s = summary.withColumnsRenamed({entity: "__s_entity", "__chunk": "__s_chunk"})
    same = F.col(entity).eqNullSafe(F.col("__s_entity")) & F.col("__chunk").eqNullSafe(F.col("__s_chunk"))
    return rows.join(s, same, "inner").drop("__s_entity", "__s_chunk")


def running_totals(
    df: DataFrame,
    entity: str,
    order_col: str,
    values: dict[str, Column],
    chunk_seconds: int = 30 * 86400,
) -> DataFrame:
    """W3 for several values at once: ``sum(v) OVER (PARTITION BY entity ORDER BY order_col
    RANGE UNBOUNDED PRECEDING)`` per output name.

    Peers (equal ``order_col``) share a total, exactly as the RANGE frame does.
    ``order_col`` is a timestamp; chunks are ``chunk_seconds`` wide.
    """
    sec = epoch_seconds(order_col)
    tmp = {f"__v{i}": c for i, c in enumerate(values.values())}
    d = df.withColumns({**tmp, "__chunk": _chunk(sec, chunk_seconds)})
    w_local = (
        Window.partitionBy(entity, "__chunk")
        .orderBy(F.col(order_col))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    d = d.withColumns({f"__l{k[3:]}": F.sum(k).over(w_local) for k in tmp}).where(_reads(df.columns))
    # the last row of a chunk holds its totals
    last = F.lead(F.lit(1)).over(Window.partitionBy(entity, "__chunk").orderBy(F.col(order_col))).isNull()
    summary = d.withColumn("__last", last).where("__last").select(entity, "__chunk", *[F.col(f"__l{k[3:]}").alias(f"__t{k[3:]}") for k in tmp])
    w_chunks = Window.partitionBy(entity).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        entity, "__chunk",
        *[F.sum(f"__t{k[3:]}").over(w_chunks).alias(f"__o{k[3:]}") for k in tmp],
    )
    out = _with_summary(d, summary, entity)
    zero = F.lit(0)
    out = out.withColumns(
        {
            name: F.when(
                F.col(f"__o{i}").isNotNull() | F.col(f"__l{i}").isNotNull(),
                F.coalesce(F.col(f"__o{i}"), zero) + F.coalesce(F.col(f"__l{i}"), zero),
            )
            for i, name in enumerate(values)
        }
    )
    return out.drop("__chunk", *[f"__{p}{i}" for i in range(len(values)) for p in "vlo"])


def running_total(
    df: DataFrame,
    entity: str,
    order_col: str,
    value: Column,
    out: str = "running_total",
    chunk_seconds: int = 30 * 86400,
) -> DataFrame:
    """Running sum of one value (see :func:`running_totals`)."""
    return running_totals(df, entity, order_col, {out: value}, chunk_seconds)


def lag_lead(
    df: DataFrame,
    entity: str,
    order_col: str,
    tiebreak: str,
    value: str,
    chunk_seconds: int = 30 * 86400,
) -> DataFrame:
    """Previous value, difference from previous, next value.

    Order is ``(order_col, tiebreak)``.  Inside a chunk ``lag``/``lead`` are local;
    the first (last) row of a chunk takes the last (first) value of the nearest
    non-empty previous (next) chunk from the per-chunk summary.
    """
    sec = epoch_seconds(order_col)
    d = df.withColumn("__chunk", _chunk(sec, chunk_seconds))
    w_local = Window.partitionBy(entity, "__chunk").orderBy(F.col(order_col), F.col(tiebreak))
    d = d.withColumns(
        {
            "__is_first": F.row_number().over(w_local) == 1,
            "__lag": F.lag(value).over(w_local),
            "__lead": F.lead(value).over(w_local),
            "__is_last": F.lead(F.lit(1)).over(w_local).isNull(),
        }
    )
    d = d.where(_reads(df.columns))
    ends = d.where(F.col("__is_first") | F.col("__is_last"))
    summary = ends.groupBy(entity, "__chunk").agg(
        F.max(F.when(F.col("__is_last"), F.col(value))).alias("__last_v"),
        F.max(F.when(F.col("__is_first"), F.col(value))).alias("__first_v"),
    )
    w_chunks = Window.partitionBy(entity).orderBy("__chunk")
    summary = summary.select(
        entity,
        "__chunk",
        F.lag("__last_v").over(w_chunks).alias("__prev_chunk_last"),
        F.lead("__first_v").over(w_chunks).alias("__next_chunk_first"),
    )
    out = _with_summary(d, summary, entity)
    prev = F.when(F.col("__is_first"), F.col("__prev_chunk_last")).otherwise(F.col("__lag"))
    nxt = F.when(F.col("__is_last"), F.col("__next_chunk_first")).otherwise(F.col("__lead"))
    return out.withColumns(
        {"prev_value": prev, "next_value": nxt, "diff_from_prev": F.col(value) - prev}
    ).drop("__chunk", "__is_first", "__is_last", "__lag", "__lead", "__prev_chunk_last", "__next_chunk_first")


def rolling_mean(
    df: DataFrame,
    entity: str,
    ts: str,
    value: Column,
    row_id: str,
    days: int = 7,
    chunk_days: int | None = None,
) -> DataFrame:
    """Sum / count / mean over ``RANGE BETWEEN INTERVAL days DAYS PRECEDING AND CURRENT ROW``.

    The look-back is inclusive (a row exactly ``days`` days older is inside).  Rows are cut
    into chunks of ``chunk_days`` (eight look-backs by default), so a hot entity is spread
    over its chunks; a row of a chunk's last ``days`` days also goes, as look-back only, to the
    next chunk.  One scan, one shuffle and one sort.  The sum is that of all rows of the chunk up to
    the row, less that of the rows before the look-back: two frames that only grow, where a
    sliding one would sum the look-back anew for each row.  The mean is the exact
    (decimal) sum divided by the count, as DOUBLE.  Rows without a time look back to each
    other.  ``row_id`` tells rows apart for the caller; it is not used here.
    """
    width = int(chunk_days or 8 * days)
    if width < days:
        raise ValueError(f"a chunk of {width} days is shorter than the look-back of {days}")
    day = 86_400_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    own = F.floor(F.col("__us") / F.lit(width * day)).cast("long")
    late = F.pmod("__us", F.lit(width * day)) >= (width - days) * day
    d = df.withColumns({"__us": micros, "__v": value})
    d = d.withColumns({"__own": own, "__chunk": F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own)))})
    w = Window.partitionBy(entity, "__chunk").orderBy("__us")
    upto, before = w.rangeBetween(Window.unboundedPreceding, 0), w.rangeBetween(Window.unboundedPreceding, -(days * day + 1))
    has_time = F.col("__us").isNotNull()
    d = d.withColumns(
        {
            "__ps": F.sum("__v").over(upto), "__pn": F.count("__v").over(upto),
            "__qs": F.when(has_time, F.sum("__v").over(before)), "__qn": F.when(has_time, F.count("__v").over(before)),
        }
    )
    d = d.where(F.col("__chunk").eqNullSafe(F.col("__own")))
    n = F.col("__pn") - F.coalesce("__qn", F.lit(0))
    s = F.when(n > 0, F.col("__ps") - F.coalesce("__qs", F.lit(0)))
    return d.withColumns(
        {"rolling_sum": s, "rolling_n": n.cast("long"), "rolling_avg": F.try_divide(s.cast("double"), n)}
    ).select(*df.columns, "rolling_sum", "rolling_n", "rolling_avg")


def sessionize(
    df: DataFrame,
    entity: str,
    ts: str,
    tiebreak: str,
    gap_minutes: float = 30,
    chunk_seconds: int = 86400,
    out: str = "session_id",
) -> DataFrame:
    """Per-entity session number; a new session starts when the gap exceeds ``gap_minutes``.

    The gap is measured as in the reference: each timestamp is floored to whole
    seconds, then ``(t - prev) / 60`` minutes; exactly 30:00 stays in the session.
    ``session_id`` counts session starts up to and including the row in
    ``(ts, tiebreak)`` order, so the first session of every entity is 1.  Rows without a
    time are one session of their entity, the first.
    """
    gap = F.lit(float(gap_minutes))
    d = df.withColumns({"__sec": epoch_seconds(ts)})
    d = d.withColumn("__chunk", _chunk(F.col("__sec"), chunk_seconds))
    w_local = Window.partitionBy(entity, "__chunk").orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("__prev", F.lag("__sec").over(w_local))
    d = d.withColumn(
        "__brk", F.when(F.col("__prev").isNotNull() & (((F.col("__sec") - F.col("__prev")) / 60) > gap), 1).otherwise(0)
    )
    summary = d.groupBy(entity, "__chunk").agg(
        F.min("__sec").alias("__lo"), F.max("__sec").alias("__hi"), F.sum("__brk").alias("__breaks")
    )
    w_chunks = Window.partitionBy(entity).orderBy("__chunk")
    summary = summary.withColumn("__prev_hi", F.lag("__hi").over(w_chunks))
    summary = summary.withColumn(
        "__first_flag",
        F.when(F.col("__prev_hi").isNull() | (((F.col("__lo") - F.col("__prev_hi")) / 60) > gap), 1).otherwise(0),
    )
    summary = summary.withColumn(
        "__offset",
        F.coalesce(
            F.sum(F.col("__first_flag") + F.col("__breaks")).over(
                w_chunks.rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).select(entity, "__chunk", "__first_flag", "__offset")
    j = _with_summary(d, summary, entity)
    flag = F.when(F.row_number().over(w_local) == 1, F.col("__first_flag")).otherwise(F.col("__brk"))
    w_run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("__flag", flag)
    return j.withColumn(out, (F.col("__offset") + F.sum("__flag").over(w_run)).cast("long")).drop(
        "__flag", "__sec", "__chunk", "__prev", "__brk", "__first_flag", "__offset"
    )
