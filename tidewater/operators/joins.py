"""Joins.

No join carries a broadcast hint: Spark's own size estimates and AQE's measured
shuffle sizes decide, against ``spark.sql.autoBroadcastJoinThreshold`` in bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import as_cols
from tidewater.session import ensure_checkpoint_dir


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    value_cols: Sequence[str],
    default: str | None = "Unknown",
) -> DataFrame:
    """J8 (+U1): attach dimension values by key, ``default`` where the key is missing.

    Replaces a driver-side dictionary + Python UDF with a left
    join and ``coalesce``: the work stays in the JVM and in whole-stage codegen.
    """
    from tidewater.operators.aggregate import keep_one_per_key

    keys = as_cols(key)
    # A repeated dimension key keeps the smallest value tuple (deterministic, unlike
    # dropDuplicates), so every fact row matches at most one dimension row.
    d = keep_one_per_key(dim.select(*keys, *value_cols), keys, list(value_cols))
    out = fact.join(d, keys, "left")
    if default is not None:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in value_cols})
    return out


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``left`` with no match in ``right``.

    ``LEFT JOIN … WHERE r.k IS NULL`` is not rewritten to an anti join by Catalyst;
    writing ``left_anti`` directly avoids materialising the joined rows.
    """
    return left.join(right, on, "left_anti")


def hot_keys(df: DataFrame, key: str, shares: int) -> DataFrame:
    """Keys that hold more than one part in ``shares`` of the rows, as (key, salts).

    One pass with a mergeable frequent-items sketch, whose size follows from ``shares`` and not
    from the data; ``salts`` is the number of such parts that the key's rows fill.  The sketch
    may be off by a twentieth of a part, so keys near the limit may or may not be listed; that
    only moves rows.  At most ``2 * shares`` rows come out.  NULL is never hot: it matches nothing.
    """
    tracked = 1 << max(6, (80 * shares - 1).bit_length())
    found = df.where(F.col(key).isNotNull()).agg(F.call_function("approx_top_k", F.col(key), F.lit(2 * shares), F.lit(tracked)).alias("top"), F.count(F.lit(1)).alias("all"))
    rows = found.select(F.explode("top").alias("t"), "all").select(F.col("t.item").alias(key), (F.col("t.count") * shares / F.col("all")).alias("parts"))
    return rows.where("parts > 1").select(key, F.ceil("parts").cast("long").alias("salts"))


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    salt_buckets: int = 16,
    salt_from: Sequence[str] | None = None,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """J10 (join half): spread the hot keys of a join, and only those, over several reducers.

    Keys that hold more than one part in ``salt_buckets`` of ``fact`` are found by
    :func:`hot_keys` (or given as ``hot``).  A fact row of such a key gets one of the key's own salts,
    by a hash of its columns, so retried tasks reproduce it; the dimension's rows of that key are
    repeated once a salt.  Other keys have one salt and are not repeated; all salts of hot keys
    together are at most ``2 * salt_buckets``, whatever the size of the dimension.  Joining on
    ``(key, salt)`` yields exactly the rows of the plain join.  Joins that keep unmatched
    dimension rows (right, full) would keep one for each salt and are rejected.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        raise ValueError(f"salted_join can't keep unmatched rows of the replicated side: how={how!r}")
    cols = list(salt_from) if salt_from else fact.columns
    # at most 2 * salt_buckets rows, read from the shared folder by both sides
    ensure_checkpoint_dir(fact.sparkSession)
    hot = (hot_keys(fact, key, salt_buckets) if hot is None else hot).checkpoint(eager=True)
    hot = F.broadcast(hot.select(F.col(key).alias("__hot"), F.col("salts").alias("__salts")))
    salts = F.coalesce("__salts", F.lit(1).cast("long"))
    f = fact.join(hot, F.col(key) == F.col("__hot"), "left")
    # NULL keys match nothing, but they need not meet in one task
    spread = F.when(F.col(key).isNull(), F.lit(salt_buckets).cast("long")).otherwise(salts)
    f = f.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), spread)).drop("__hot", "__salts")
    d = dim.join(hot, F.col(key) == F.col("__hot"), "left")
    d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("__hot", "__salts")
    return f.join(d, [key, "__salt"], how).drop("__salt")
