"""Draws the documents that look most like a target text collection, with Gumbel noise.

Words and runs of words are hashed into buckets; a bucket's gain is the logarithm of its share among the
target's features over its share among the documents'.  A document's weight is the mean gain of its
features, looked up in one array; noise from a hash of its id makes the largest scores a weighted sample
without repeats.

Bucket arrays are written once; both the counts and the weights read them.  The cutoff among the persisted
scores is found by bisection: each job counts exactly how many scores reach each of some probes, and the
next one looks between two of them; equal scores at the cutoff are cut by doc_id in the same way.  Only the
rows drawn are sorted, in ranges, for their ranks; nothing is gathered but counts.

Rows: a null text has no features, and a text without features weighs 0.  A null doc_id is hashed as an
empty id and comes last among equal scores.  Repeated rows are scored and counted each; where rows of one
id and score lie at the cutoff, as many of them are drawn as are wanted.  An empty table gives an empty
result, and an empty target a gain from the documents alone.  Very long texts are whole arrays of buckets.
Only the id and text columns are read; others, whatever their names, are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, run_dir, written
from tidewater.operators.order import global_rank

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Thresholds that one job counts for.
PROBES = 15

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)


def features(found: Column, max_n: int) -> Column:
    """All runs of 1 to ``max_n`` consecutive words, each joined by one space."""

    def of(n: int) -> Column:
        starts = F.when(F.size(found) >= n, F.sequence(F.lit(1), F.size(found) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(found, i, n), " "))

    runs = [found, *map(of, range(2, max_n + 1))]
    return F.concat(*runs) if len(runs) > 1 else found


def hashed(df: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """doc_id (if there is one), number of words and the bucket of every feature."""
    keys = [F.col("doc_id").cast("long").alias("doc_id")] if "doc_id" in df.columns else []
    bucket = lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(buckets)).cast("int")
    return df.select(*keys, words(F.col("text")).alias("w")).select(*keys, F.size("w").cast("long").alias("n_words"), F.transform(features(F.col("w"), max_n), bucket).alias("buckets"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Each bucket's gain, from the hashed documents and the hashed target."""

    def counts(df):  # a row for each bucket at most
        got = dict(df.select(F.explode("buckets").alias("b")).groupBy("b").count().collect())
        return [got.get(b, 0) for b in range(buckets)]

    s, t = counts(docs), counts(target)
    top, low = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((y + 1.0) * top / ((x + 1.0) * low))) for x, y in zip(s, t)]


def scores(docs: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """Weight and score of every hashed document."""
    table = np.array(gain, np.int64)

    @F.arrow_udf("long")
    def total(found: pa.Array) -> pa.Array:
        flat = found.flatten().to_numpy(zero_copy_only=False)
        sums = np.concatenate(([0], np.cumsum(table[flat]))) if len(flat) else np.zeros(1, np.int64)
        ends = np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))
        return pa.array(np.diff(sums[np.concatenate(([0], ends)).astype(np.int64)]), pa.int64())

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)
    sums = docs.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), total("buckets").alias("sum"))
    mean = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(F.expr("(sum - pmod(sum, n_features)) div n_features")).cast("long")
    return sums.select("doc_id", "n_words", "n_features", mean.alias("weight"), (mean + noise).cast("long").alias("score"))


def bisect(rows: DataFrame, reaches, low: int, high: int, wanted: int) -> int:
    """The first of the whole numbers from ``low`` to ``high`` that ``wanted`` rows reach; ``reaches`` makes the condition.

    Rows that reach a number must reach every later one, and ``high`` must be reached by as many.
    Each job is four halvings at once: exact counts for the probes between.
    """
    while low < high:
        probes = sorted({low + (high - low) * k // (PROBES + 1) for k in range(1, PROBES + 1)} | {low})
        counts = rows.agg(*(F.count(F.when(reaches(p), 1)).alias(f"c{k}") for k, p in enumerate(probes))).first()
        first = next((k for k, n in enumerate(counts) if n >= wanted), len(probes))
        high = probes[first] if first < len(probes) else high
        low = probes[first - 1] + 1 if first else low
    return low


def draw(scored: DataFrame, wanted: int) -> DataFrame:
    """Adds ``rank`` (null where not drawn) to persisted rows: the ``wanted`` largest scores among the eligible, ties to smaller ids."""
    rows = scored.where("eligible")
    drawn = F.col("eligible") & F.lit(wanted > 0)
    if wanted:
        ends = rows.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
        cut = -bisect(rows, lambda p: F.col("score") >= -p, -ends.high, -ends.low, wanted)
        ties = rows.where(F.col("score") == cut)
        at = rows.agg(F.count(F.when(F.col("score") > cut, 1)).alias("above"), F.count(F.when(F.col("score") == cut, 1)).alias("ties"), F.count(F.when(F.col("score") == cut, F.col("doc_id"))).alias("ids")).first()
        need = wanted - at.above
        tied = F.col("score") == cut
        if need < at.ties and need <= at.ids:
            ids = ties.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
            last = bisect(ties, lambda p: F.col("doc_id") <= p, ids.low, ids.high, need)
            tied &= F.col("doc_id") <= last
        drawn &= F.coalesce((F.col("score") > cut) | tied, F.lit(False))
    ranked = global_rank(scored.where(drawn), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.union(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, max_n: int = MAX_N, seed: int = SEED) -> DataFrame:
    """Every document's weight, score and rank among the ``percent`` in a hundred that are drawn."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = run_dir(spark, "importance")
    own = written(hashed(docs, buckets, max_n), folder, "documents")
    gain = gains(own, hashed(target.select("text"), buckets, max_n), buckets)
    scored = written(scores(own, gain, seed).withColumn("eligible", F.col("n_words") >= min_words), folder, "scores")
    return draw(scored, percent * scored.where("eligible").count() // 100)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


def report_sql() -> str:
    """The same in DuckDB's SQL, which has no crc32: its table is built by rule and folded over each distinct feature's bytes."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    entries = "SELECT i, i::BIGINT AS c0 FROM range(256) t(i)"
    for k in range(8):
        entries = f"SELECT i, {step.format(f'c{k}')} AS c{k + 1} FROM ({entries})"
    found = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '{}')".format(_UPPER, _LOWER, WORD)
    return f"""
WITH crc AS (SELECT list(c8 ORDER BY i) AS c FROM ({entries})),
d AS (SELECT row_number() OVER () AS row, doc_id, {found} AS w FROM documents),
o AS (SELECT row, unnest(w) AS f FROM d),
b AS (SELECT unnest({found}) AS f FROM benchmark),
x AS (SELECT DISTINCT f FROM (SELECT f FROM o UNION ALL SELECT f FROM b)),
y AS (SELECT f, list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i::INTEGER + 1, 2))::BIGINT) AS bytes FROM x),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, v: xor(a >> 8, c[(xor(a, v) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM y, crc),
oc AS (SELECT bucket, count(*) AS s FROM o JOIN h USING (f) GROUP BY bucket),
bc AS (SELECT bucket, count(*) AS t FROM b JOIN h USING (f) GROUP BY bucket),
g AS (SELECT k.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM o) + {BUCKETS})::DOUBLE
  / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM (SELECT range AS bucket FROM range({BUCKETS})) k LEFT JOIN oc USING (bucket) LEFT JOIN bc USING (bucket)),
m AS (SELECT row, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS mean FROM o JOIN h USING (f) JOIN g USING (bucket) GROUP BY row),
z AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(mean, 0) AS weight, coalesce(mean, 0) + floor(-1000 * ln(-ln(
  (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN m USING (row)),
r AS (SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS place FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * (SELECT count(place) FROM r) // 100 THEN place END AS rank FROM r"""
