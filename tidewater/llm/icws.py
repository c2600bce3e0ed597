"""Near-duplicate classes by consistent weighted sampling.

Texts become weighted sets of word 5-shingles (a shorter text is one shingle).  The weight of a shingle
is its TF-IDF: (1 + ln tf) times 1 + ``IDF_SHARE`` * idf, with idf = ln(1 + N / df) / ln(1 + N) between
0 and 1 and df counted over all documents in 2^18 hashed features.  The share is small on purpose:
within a group of thousands of copies the common shingles have a low idf and the few differing ones a
high one, and an undamped idf would pull true copies below any threshold.

Improved consistent weighted sampling draws 36 samples of each set; two sets agree in a sample with
the probability of their weighted Jaccard similarity.  Samples are banded by threes (12 bands): a pair
at similarity 0.8 meets in a band with probability 0.9998.  Every pair that decides a class is
verified by its exact weighted Jaccard similarity.

Texts with the same words are one node from the start, so copies are never compared.  In a band's
bucket all nodes are first compared with two representatives.  Buckets whose nodes are then in one
class are done; in the others, nodes of different classes are compared unless an exact upper bound
rules them out.  So a group of copies is not expanded into its pairs, and no bucket is cut.

Null texts are classes of their own.  Empty texts and texts without a word are copies of one another
only if they are equal.  Equal ids with different texts keep their own rows and classes, and rows without an id are
linked like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, run_dir, written

WORDS = 5
FEATURES = 1 << 18
IDF_SHARE = 0.1
SAMPLES, ROWS = 36, 3
_POOL = 1 << 16
_CHUNK = 256  # nodes of a bucket that one task compares with the rest of it
_CELLS = 64

_u = lambda x: np.uint64(x)
_BASE, _SHINGLE = _u(0x9E3779B97F4A7C15), _u(0xD6E8FEB86659FD93)
_IS_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _u(30))) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u(27))) * _u(0x94D049BB133111EB)
    return x ^ (x >> _u(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (lower case; letters, digits and all that is not ASCII), and how many each text has."""
    raw = [x.lower().encode("utf-8", "surrogatepass") + b" " for x in texts]
    b = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(x) for x in raw])
    inside = np.concatenate([[False], _IS_WORD[b], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    # the words' bytes in groups of equal length: each word is a number in base _BASE, wrapped
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + _u(1)) * _powers(_BASE, len(b)), out=total[1:])
    inverse = _u(pow(int(_BASE), -1, 1 << 64))
    h = mix((total[stop] - total[start]) * _powers(inverse, len(b) + 1)[start] + (stop - start).astype(np.uint64))
    return h, np.bincount(np.searchsorted(ends, start, "right"), minlength=len(texts))


def shingle_sets(texts: list[str]):
    """(hash, tf, first place of each text's set, size of each set, hash of each text's words): distinct shingles by text, sorted."""
    words, n = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(n)])
    node = np.array([xxhash.xxh3_64_intdigest(words[first[i] : first[i + 1]].tobytes()) for i in range(len(texts))], np.uint64)
    text_of = np.repeat(np.arange(len(texts)), n)
    full = len(words) - WORDS + 1
    if full > 0:
        h = np.zeros(full, np.uint64)
        for k in range(WORDS):
            h = h * _SHINGLE + words[k : k + full]
        whole = text_of[:full] == text_of[WORDS - 1 :]
        h, doc = mix(h[whole]), text_of[:full][whole]
    else:
        h, doc = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    h, doc = np.concatenate([h, node[short]]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    size = np.bincount(doc[at], minlength=len(texts))
    return h[at], tf, np.concatenate([[0], np.cumsum(size)])[:-1], size, node, n


def weights(h: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return ((1 + np.log(tf)) * (1 + IDF_SHARE * idf[(h & _u(FEATURES - 1)).astype(np.int64)])).astype(np.float32)


def _document_frequency(batches):
    """How many texts of a task have each hashed feature: at most FEATURES rows a task."""
    df, n = np.zeros(FEATURES, np.int64), 0
    for b in batches:
        texts = [x for x in b.column("text").to_pylist() if x]
        n += b.num_rows
        if texts:
            h, *_ = shingle_sets(texts)
            df += np.bincount((h & _u(FEATURES - 1)).astype(np.int64), minlength=FEATURES)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["feature", "n"])


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf of each hashed feature over all documents: a table of fixed size."""
    got = docs.select("text").mapInArrow(_document_frequency, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = got.column("feature").to_numpy(), got.column("n").to_numpy()
    total = max(1, int(n[feature == -1].sum()))
    df = np.ones(FEATURES)
    df[feature[feature >= 0]] = n[feature >= 0]
    # a feature holds many rare shingles: what an average one holds counts as one
    df = np.maximum(1, df / max(1.0, df.mean()))
    return (np.log1p(total / df) / np.log1p(total)).astype(np.float32)


class Sampler:
    """Draws for (shingle, sample) come from a pool of 2^16 Gamma and uniform variates, picked by hash."""

    def __init__(self, samples: int = SAMPLES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2, 1, _POOL).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, _POOL)).astype(np.float32)
        self.beta = rng.random(_POOL).astype(np.float32)
        self.odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * _u(2) + _u(1)

    def samples(self, h: np.ndarray, w: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A row of 64-bit samples for each set; sets must not be empty."""
        log_w = np.log(w)
        out = np.empty((len(at), len(self.odd)), np.uint64)
        owner = np.repeat(np.arange(len(at)), size)
        for k, odd in enumerate(self.odd):
            pick = ((h * odd) >> _u(48)).astype(np.int64)
            r, beta = self.r[pick], self.beta[pick]
            t = np.floor(log_w / r + beta)
            log_a = self.log_c[pick] - r * (t - beta + 1)
            low = np.flatnonzero(log_a == np.minimum.reduceat(log_a, at)[owner])
            own = owner[low]
            low = low[np.append(True, own[1:] != own[:-1])]  # ties: the smallest hash
            out[:, k] = mix(h[low] ^ (t[low].astype(np.int64).astype(np.uint64) * _BASE))
        return out


def _bands(samples: np.ndarray) -> np.ndarray:
    out = np.empty((len(samples), samples.shape[1] // ROWS), np.uint64)
    for b in range(out.shape[1]):
        h = np.full(len(samples), b + 1, np.uint64)
        for k in range(ROWS):
            h = mix(h * _SHINGLE + samples[:, b * ROWS + k])
        out[:, b] = h
    return out.view(np.int64)


def _raw_node(text: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=1)).astype(np.int64))


def sketch(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, raw, node, bands): the node is the same for texts with the same words; bands are empty without words."""

    def run(batches):
        sampler = Sampler()
        for b in batches:
            texts = b.column("text").to_pylist()
            some = [i for i, x in enumerate(texts) if x is not None]
            node, bands = [None] * len(texts), [[]] * len(texts)
            if some:
                h, tf, at, size, of_words, n = shingle_sets([texts[i] for i in some])
                have = np.flatnonzero(size)
                if len(have):
                    keys = _bands(sampler.samples(h, weights(h, tf, idf.value), at[have], size[have])).tolist()
                    signed = of_words.view(np.int64).tolist()
                    for j, k in zip(have.tolist(), keys):
                        node[some[j]], bands[some[j]] = signed[j], k
                for j in np.flatnonzero(n == 0).tolist():
                    node[some[j]] = _raw_node(texts[some[j]])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("raw"), pa.array(node, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "raw", "node", "bands"])

    return _keyed(docs).mapInArrow(run, "doc_id long, raw long, node long, bands array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    """Id, text and the text's hash: with the id it tells rows with different texts apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("raw"))


def _sets(docs: DataFrame, idf) -> DataFrame:
    """The weighted shingle set of each row's text, where its words are those of ``node``."""

    def run(batches):
        for b in batches:
            texts, want = b.column("text").to_pylist(), b.column("node").to_pylist()
            h, tf, at, size, node, _ = shingle_sets([x or "" for x in texts])
            w, node = weights(h, tf, idf.value), node.view(np.int64).tolist()
            ok = [i for i in range(len(texts)) if node[i] == want[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([want[i] for i in ok], pa.int64()),
                    pa.array([h[at[i] : at[i] + size[i]].tobytes() for i in ok], pa.binary()),
                    pa.array([w[at[i] : at[i] + size[i]].tobytes() for i in ok], pa.binary()),
                    pa.array([float(w[at[i] : at[i] + size[i]].sum(dtype=float)) for i in ok], pa.float64()),
                    pa.array([np.bincount((h[at[i] : at[i] + size[i]] >> _u(58)).astype(np.int64), w[at[i] : at[i] + size[i]], _CELLS) for i in ok], pa.list_(pa.float64())),
                ],
                ["node", "h", "w", "total", "cells"],
            )

    return docs.mapInArrow(run, "node long, h binary, w binary, total double, cells array<double>")


def weighted_jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """Both sets by ascending hash."""
    at = np.minimum(np.searchsorted(h2, h1), max(len(h2) - 1, 0))
    both = np.flatnonzero(h2[at] == h1) if len(h2) else np.empty(0, int)
    common = float(np.minimum(w1[both], w2[at[both]]).sum(dtype=float))
    rest = float(w1.sum(dtype=float)) + float(w2.sum(dtype=float)) - common
    return common / rest if rest else 0.0


def _similarity(h1: pa.Array, w1: pa.Array, h2: pa.Array, w2: pa.Array) -> pa.Array:
    read = lambda x, t: [np.frombuffer(v, t) for v in x.to_pylist()]
    return pa.array([weighted_jaccard(*x) for x in zip(read(h1, np.uint64), read(w1, np.float32), read(h2, np.uint64), read(w2, np.float32))], pa.float64())


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label): the smallest node of each component of ``edges`` (a, b), by repeated least neighbours and jumps."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), folder, f"{name}-edges")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), folder, f"{name}-0")
    k = 0
    while True:
        k += 1
        near = both.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        best = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("further"))
        best = best.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        best = written(best, folder, f"{name}-{k}")
        label = best.select("node", "label")
        if best.where(F.col("old") != F.col("label")).isEmpty():
            return label


def _mixed(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """The members (bucket, node, label, n) of buckets that hold several classes; n: the bucket's size."""
    if label is None:
        now = members.withColumn("label", F.col("node"))
    else:
        now = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("node").alias("n"))
    return now.join(of.where(F.col("low") != F.col("high")).select("bucket", "n"), "bucket")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    similarity = F.arrow_udf(_similarity, "double")
    one = sets.select(F.col("node").alias("a"), F.col("h").alias("h1"), F.col("w").alias("w1"))
    two = sets.select(F.col("node").alias("b"), F.col("h").alias("h2"), F.col("w").alias("w2"))
    scored = pairs.join(two, "b").join(one, "a").select("a", "b", similarity("h1", "w1", "h2", "w2").alias("similarity"))
    return scored.where(F.col("similarity") >= threshold).select("a", "b")


def _cross_pairs(mixed: DataFrame, sets: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    """Each pair of different classes that meets in a bucket, once, unless a bound shows that it is below the threshold.

    The bounds are exact: the ratio of the sets' weights, and the overlap of their weights in 64 cells by
    hash, which is never below the overlap of the sets.  A bucket is cut into chunks of ``_CHUNK`` nodes
    that each meet all of it, so that a large one is dealt to many tasks.
    """
    wide = mixed.join(sets.select("node", "total", "cells"), "node").join(bands, "node")
    chunks = F.ceil(F.col("n") / _CHUNK).cast("int")
    left = wide.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    left = left.select("bucket", "chunk", *[F.col(c).alias(f"{c}1") for c in ("node", "label", "total", "cells", "bands")])
    right = wide.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    right = right.select("bucket", "chunk", *[F.col(c).alias(f"{c}2") for c in ("node", "label", "total", "cells", "bands")])
    t = threshold - 1e-4
    overlap = F.aggregate(F.zip_with("cells1", "cells2", lambda x, y: F.least(x, y)), F.lit(0.0), lambda s, x: s + x)
    near = (
        (F.col("node1") < F.col("node2"))
        & (F.col("label1") != F.col("label2"))
        & (F.least("total1", "total2") >= F.greatest("total1", "total2") * t)
        & (overlap * (1 + t) >= (F.col("total1") + F.col("total2")) * t)
        & (F.col("bucket") == F.array_min(F.array_intersect("bands1", "bands2")))
    )
    return left.join(right, ["bucket", "chunk"]).where(near).select(F.col("node1").alias("a"), F.col("node2").alias("b"))


def link(members: DataFrame, sets: DataFrame, bands: DataFrame, folder: str, threshold: float) -> DataFrame | None:
    """Classes (node, label) of the nodes of ``members`` (bucket, node) by verified links; None where there is nothing to link.

    First every bucket is compared with its least and its greatest node.  Then the nodes of buckets that
    still hold several classes are compared with those of the other classes.
    """
    ends = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    pairs = members.join(ends, "bucket").select("node", F.explode(F.array("low", "high")).alias("rep")).where(F.col("node") != F.col("rep"))
    pairs = pairs.select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")).distinct()
    links = written(_verified(pairs, sets, threshold), folder, "links-1")
    label = components(links, folder, "classes-1")
    mixed = written(_mixed(members, label), folder, "mixed")
    if mixed.isEmpty():
        return label
    more = written(_verified(_cross_pairs(mixed, sets, bands, threshold), sets, threshold), folder, "links-2")
    if more.isEmpty():
        return label
    # the second links join classes: the first classes' labels stand for their nodes
    of = lambda c: more.join(label.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c, "left")
    joined = of("a").join(label.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    joined = joined.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    upper = components(joined, folder, "classes-2")
    known = label.join(upper.select(F.col("node").alias("label"), F.col("label").alias("upper")), "label", "left")
    known = known.select("node", F.coalesce("upper", "label").alias("label"))
    return known.union(upper.join(known, "node", "left_anti"))


def _classified(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, raw, node, class_id, n_texts, head): head is the (doc_id, raw) of the class's first row; null for null texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = run_dir(spark, "icws")
    idf = spark.sparkContext.broadcast(idf_table(docs))  # FEATURES floats
    rows = written(sketch(docs, idf), folder, "sketch")
    # the smallest id first, rows without an id last
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw")
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(first).alias("first"), F.first("bands").alias("bands"))
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("node").alias("n")).where(F.col("n") > 1).select("bucket")
    members = written(banded.join(shared, "bucket"), folder, "members")
    wanted = nodes.select("node", F.col("first.doc_id").alias("id"), F.col("first.raw").alias("of")).join(members.select("node").distinct(), "node", "left_semi")
    texts = _keyed(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("raw") == F.col("of")))
    sets = written(_sets(texts.select("node", "text"), idf).dropDuplicates(["node"]), folder, "sets")
    label = link(members, sets, nodes.select("node", "bands"), folder, threshold)
    if label is None:
        label = nodes.select("node", F.col("node").alias("label"))
    named = nodes.select("node", "first").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(F.min("first").alias("head"), F.count("node").alias("n_texts"))
    of_node = written(named.join(heads, "label").select("node", "head", "n_texts"), folder, "classes")
    return rows.select("doc_id", "raw", "node").join(of_node, "node", "left")


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, n_texts): the class's smallest doc_id and its number of different texts, a row for each row of ``docs``.

    A class none of whose rows has an id has a null class_id.
    """
    alone = F.when(F.col("node").isNull(), F.col("doc_id"))
    return _classified(docs, threshold).select("doc_id", F.coalesce("head.doc_id", alone).alias("class_id"), F.coalesce("n_texts", F.lit(1)).alias("n_texts"))


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of each class, that with the smallest id (rows without an id go last).

    Rows are told apart by id and text, so that texts of other classes stay whatever their id.  Null texts all stay.
    """
    first = _classified(docs, threshold).where(F.col("head").isNotNull()).select(F.col("head.doc_id").alias("__id"), F.col("head.raw").alias("__raw")).distinct()
    keyed = docs.withColumn("__of", F.xxhash64("text"))
    one = keyed.where(F.col("text").isNotNull()).join(first, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__raw")), "left_semi")
    # repeated rows of an id and text are one, any of them
    return one.dropDuplicates(["doc_id", "__of"]).drop("__of").unionByName(docs.where(F.col("text").isNull()))
