"""Benchmark decontamination by item-sized windows, in DataFrame functions only.

Windows as long as a benchmark item are laid over the documents, wherever a word shingle of the
benchmark stands: a window that holds none cannot reach any similarity to an item, so leaving it out
loses nothing.  A shingle's places in the items give the windows' starts and lengths, not the items.

Windows and items get a 64-bit SimHash of their words, cut into ``BLOCKS`` blocks.  Two fingerprints that
differ in ``BLOCKS * (PROBE + 1) - 1`` bits at most differ in ``PROBE`` bits at most in some block; each item's
block is therefore entered with every value that near to it, and a join on (block, value) finds all
pairs within the radius.  Their distance is then counted, and the exact weighted Jaccard similarity of
their 5-word shingles decides; a shingle that many items share weighs less: its idf among the items,
1 + ln(N / df).

A fingerprint is no bound on that similarity, so an exact net lies beside it: pairs that share one of
the item's heaviest shingles, as many as weigh more than 1 - threshold of the item together, are verified
too.  A window without any of them lacks more of the item than a leak may.  ``distance`` tells how far
apart the fingerprints of a leak are, so that what the radius alone would find can be counted.

Items of fewer than five words are one shingle of all their words.  Null, empty or wordless texts and
items never match.  Equal rows give equal results; rows with equal ids and other texts are kept apart.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import run_dir, written

WORDS = 5
THRESHOLD = 0.8
BITS = 64
BLOCKS, PROBE = 5, 3
RADIUS = BLOCKS * (PROBE + 1) - 1
MAX_BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """Runs of letters, marks and digits in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words, by place."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(F.array().cast("array<bigint>"))


def _placed(words: Column, n: int) -> Column:
    return F.transform(_grams(words, n), lambda h, i: F.struct(i.alias("at"), F.lit(n).alias("k"), h.alias("h")))


def shingles(words: Column) -> Column:
    """Hashes of the 5-word shingles; of all words together where there are fewer."""
    return F.when(F.size(words) >= WORDS, _grams(words, WORDS)).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast what has few enough rows; anything else is left to a shuffled join."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def fingerprints(texts: DataFrame, key: str) -> DataFrame:
    """SimHash of ``words`` for each ``key``: bit b is set where the words with bit b outweigh those without."""
    each = texts.select(key, F.explode("words").alias("word")).select(key, F.xxhash64("word").alias("h"))
    half = BITS // 2
    # two counts in one sum, of bit b below and of bit b + 32 above; no array has 2^32 words
    ones = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(_long(1 | 1 << half))).alias(f"b{b}") for b in range(half)]
    votes = each.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *ones)
    fingerprint = _long(0)
    for b in range(half):
        low = F.col(f"b{b}").bitwiseAND(_long((1 << half) - 1)) * 2 > F.col("n")
        high = F.shiftrightunsigned(f"b{b}", half) * 2 > F.col("n")
        for bit, on in ((b, low), (b + half, high)):
            fingerprint = fingerprint.bitwiseOR(F.when(on, _long(1 << bit)).otherwise(_long(0)))
    return votes.select(key, fingerprint.alias("fingerprint"))


def blocks(fingerprint: Column, probe: int = 0) -> Column:
    """(block, value) of each block of a fingerprint, with every value at most ``probe`` bits away."""
    edges = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    out = []
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned(fingerprint, a).bitwiseAND(_long((1 << b - a) - 1))
        flips = [sum(1 << i for i in some) for n in range(probe + 1) for some in combinations(range(b - a), n)]
        near = F.array(*map(_long, flips))
        out.append(F.transform(near, lambda x: F.struct(F.lit(k).alias("block"), value.bitwiseXOR(x).alias("value"))))  # noqa: B023
    return F.concat(*out)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start, n_words, distance): every leaked item of every document, at its best place."""
    spark = docs.sparkSession
    folder = run_dir(spark, "decontam")
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).dropDuplicates(["item_id", "words"])
    items = items.withColumn("item", F.xxhash64("item_id", F.array_join("words", " ")))
    items = written(items.withColumn("n", F.size("words")).withColumn("s", shingles(F.col("words"))), folder, "items")
    n_items = items.count()
    each = items.select("item", "n", F.posexplode("s").alias("at", "h"))
    df = each.groupBy("h").agg(F.countDistinct("item").alias("df"))
    seeds = written(each.join(df, "h").select("h", "item", "n", "at", "df").distinct(), folder, "seeds")
    n_seeds = seeds.count()
    lengths = sorted(r.k for r in seeds.select(F.least("n", F.lit(WORDS)).alias("k")).distinct().collect())  # 1 to 5 at most

    text = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    text = text.withColumn("text_hash", F.xxhash64("text"))
    worded = text.select("doc_id", "text_hash", words_of(F.col("text")).alias("words"))
    grams = [_placed(F.col("words"), k) for k in lengths]
    empty = F.array().cast("array<struct<at:int,k:int,h:bigint>>")
    placed = worded.select("doc_id", "text_hash", F.inline(F.concat(empty, *grams)).alias("at", "k", "h"))
    starts = seeds.select("h", F.least("n", F.lit(WORDS)).alias("k"), "n", F.col("at").alias("within")).distinct()
    hits = placed.join(small(starts, n_seeds), ["h", "k"])
    hits = hits.select("doc_id", "text_hash", F.greatest(F.lit(0), F.col("at") - F.col("within")).alias("start"), "n")
    by_doc = written(hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "n")).alias("windows")), folder, "windows")

    # the texts of documents that hold some of the benchmark, cut into windows
    found = text.join(by_doc, (text.doc_id.eqNullSafe(by_doc.doc_id)) & (text.text_hash == by_doc.text_hash)).select(text.doc_id, text.text_hash, words_of(text.text).alias("words"), "windows")
    cut = found.select("doc_id", "text_hash", F.inline(F.transform("windows", lambda w: F.struct(w["start"].alias("start"), w["n"].alias("n"), F.slice("words", w["start"] + 1, w["n"]).alias("words")))))
    cut = cut.dropDuplicates(["doc_id", "text_hash", "start", "n"])
    # equal windows of any documents are one: a passage that many documents share is compared once
    cut = written(cut.withColumn("window", F.xxhash64("words", F.lit(1))), folder, "cut")
    windows = written(cut.groupBy("window").agg(F.first("words").alias("words")), folder, "distinct")

    def weighed(df_):  # equal shingles of one text add up
        return df_.groupBy("key", "h").agg(F.count(F.lit(1)).alias("tf"))

    idf = F.lit(1.0) + F.log(F.lit(float(max(n_items, 1))) / F.coalesce("df", F.lit(1)))
    df_small = small(seeds.select("h", "df").distinct(), n_seeds)
    in_windows = weighed(windows.select(F.col("window").alias("key"), F.explode(shingles(F.col("words"))).alias("h"))).join(df_small, "h", "left").select(F.col("key").alias("window"), "h", (F.col("tf") * idf).alias("w"))
    in_items = weighed(each.select(F.col("item").alias("key"), "h")).join(df_small, "h", "left").select(F.col("key").alias("item"), "h", (F.col("tf") * idf).alias("v"))
    size_w = in_windows.groupBy("window").agg(F.sum("w").alias("all_w"))
    size_v = in_items.groupBy("item").agg(F.sum("v").alias("all_v"))
    # the item's heaviest shingles, until they weigh more than a leak may lack
    before = F.sum("v").over(Window.partitionBy("item").orderBy(F.desc("v"), "h").rowsBetween(Window.unboundedPreceding, -1))
    telling = in_items.withColumn("before", F.coalesce(before, F.lit(0.0))).join(small(size_v, n_items), "item")
    telling = telling.where(F.col("before") <= (1 - threshold + 1e-6) * F.col("all_v")).select("item", "h")
    net = in_windows.select("window", "h").join(small(telling, n_seeds), "h").select("window", "item")

    # written, so that no later plan holds their sums
    prints = written(fingerprints(windows, "window"), folder, "prints")
    wanted = written(fingerprints(items, "item").withColumnRenamed("fingerprint", "of"), folder, "wanted")
    entered = wanted.select("item", "of", F.inline(blocks(F.col("of"), PROBE)))
    looked = prints.select("window", "fingerprint", F.inline(blocks(F.col("fingerprint"))))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("of")))
    near = looked.join(small(entered, n_items * BLOCKS * 400), ["block", "value"]).where(distance <= RADIUS).select("window", "item")
    pairs = near.union(net).distinct()
    both = pairs.join(in_windows, "window").join(small(in_items, n_seeds), ["item", "h"]).groupBy("window", "item").agg(F.sum(F.least("w", "v")).alias("common"))
    scored = both.join(size_w, "window").join(small(size_v, n_items), "item")
    scored = scored.withColumn("similarity", F.col("common") / (F.col("all_w") + F.col("all_v") - F.col("common"))).where(F.col("similarity") >= threshold - 1e-9)
    scored = scored.join(small(items.select("item", "item_id"), n_items), "item").join(prints, "window").join(small(wanted, n_items), "item")
    scored = scored.select("window", "item_id", "similarity", distance.alias("distance"))
    out = cut.select("doc_id", "text_hash", "start", "window", F.size("words").alias("n_words")).join(scored, "window")
    best = F.struct("similarity", (-F.col("start")).alias("at"), "n_words", (-F.col("distance")).alias("apart"))
    out = out.groupBy("doc_id", "text_hash", "item_id").agg(F.max(best).alias("best"))
    return out.select("doc_id", "text_hash", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.at")).alias("start"), F.col("best.n_words").alias("n_words"), (-F.col("best.apart")).alias("distance"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that it leaks."""
    return leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.min("start").cast("long").alias("start"), F.max("n_words").cast("long").alias("n_words"), F.min("distance").alias("distance"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item; null texts stay."""
    folder = run_dir(docs.sparkSession, "decontam-out")
    bad = written(leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), folder, "bad").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")) & docs["text"].isNotNull(), "left_anti")
