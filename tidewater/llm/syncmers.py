"""Document fingerprints of closed syncmers.

A run of ``K`` code points is a closed syncmer if the smallest hash among its inner runs of ``S`` code
points belongs to the first or the last of them.  Whether it is one depends on the run alone, not on
what stands around it, so equal passages give equal anchors wherever they stand, and any passage of
2K - S - 1 code points has one.  A text of fewer than ``SHORT`` code points, of which two thirds may
hold no syncmer, has every run of two code points as an anchor besides.  A fingerprint is the list of the anchors' hashes (32 bits, in
hexadecimal, in text order).

Two fingerprints are matched by place: equal anchors are paired in order (the n-th of a hash with the
n-th), the longest chain of pairs that goes forward in both is kept, and the likeness is twice its
length over the number of anchors of both.

A text of one code point is one anchor of its own; null and empty texts have an empty fingerprint.  Two
empty ones are alike by 1, an empty and another by 0.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

K, S = 12, 4
#: From here on two thirds of a text hold 2K - S - 1 code points.
SHORT = next(n for n in range(3 * K) if n - n // 3 >= 2 * K - S - 1)
_u = lambda x: np.uint64(x)
_BASE = _u(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u(32))) * _u(0xD6E8FEB86659FD93)
    return x ^ (x >> _u(32))


def _runs(x: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` values: by doubling, so in log n passes."""
    h, have, out, done = x * _BASE + _u(1), 1, None, 0
    while True:
        if n & have:
            out = h[: len(x) - n + 1].copy() if out is None else _mix(out * _BASE + h[done : done + len(x) - n + 1])
            done += have
        if have * 2 > n:
            return _mix(out)
        h = _mix(h[:-have] * _BASE + h[have:])
        have *= 2


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` neighbours."""
    have = 1
    while have * 2 <= n:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (n - have)], x[n - have :]) if n > have else x


def anchors(text: str) -> np.ndarray:
    """32-bit hashes of the closed syncmers, in text order; of short texts also of the pairs of code points."""
    if not text:
        return np.empty(0, np.uint32)
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(x) < 2:
        return np.array([xxhash.xxh32_intdigest(x.tobytes())], np.uint32)
    if len(x) < SHORT:
        at, h = _syncmers(x) if len(x) >= K else (np.empty(0, np.int64), np.empty(0, np.uint32))
        pairs = (_runs(x, 2) >> _u(32)).astype(np.uint32)
        return np.insert(pairs, at, h)
    return _syncmers(x)[1]


def _syncmers(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers."""
    inner = _runs(x, S)
    span = K - S + 1
    low = _least(inner, span)
    edge = (inner[: len(low)] == low) | (inner[span - 1 :] == low)
    at = np.flatnonzero(edge)
    return at, (_runs(x, K)[at] >> _u(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    sa, sb = a[oa], b[ob]
    nth = np.arange(len(a)) - np.searchsorted(sa, sa)  # which of its equals each one is
    at = np.searchsorted(sb, sa) + nth
    ok = at < np.searchsorted(sb, sa, "right")
    place = np.full(len(a), -1)
    place[oa[ok]] = ob[at[ok]]
    chain: list[int] = []
    for p in place[place >= 0].tolist():
        k = bisect_left(chain, p)
        chain[k : k + 1] = [p]
    return 2 * len(chain) / (len(a) + len(b))


def to_text(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each text; other columns stay."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([to_text(anchors(x or "")) for x in texts.to_pylist()], pa.string())

    return docs.withColumn(to, run(F.col(text)))


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def report(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint against those of its edited text and of the next document by descending id.

    Rows go to ranges of ids whose bounds are taken from the ids alone; each range also gets the first row
    of the next one, so that texts are shuffled once and no task sees more than its range.  Rows of equal
    ids are ordered by text; rows without an id come last.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = 4 * n  # several to a partition, so that partitions come out alike
    # a bound less than there are ranges, from a bounded summary of the ids
    bounds = sorted({int(x) for x in own.stat.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], max(0.1 / ranges, 1e-4))})

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:  # 0: the largest ids; rows without an id go to the last range
        return pa.array([len(bounds) - bisect_right(bounds, x) if x is not None else len(bounds) for x in ids.to_pylist()], pa.int32())

    own = own.withColumns({"part": range_of(F.col("doc_id")), "h": F.xxhash64("text")})
    # the first row of each range, by the same order as below: a row for each range
    first = F.struct(F.col("doc_id").isNotNull().alias("a"), F.coalesce("doc_id", F.lit(0)).alias("b"), F.bitwise_not("h").alias("c"))
    heads = own.select("part", "doc_id", "h").groupBy("part").agg(F.max_by(F.struct("doc_id", "h"), first).alias("head"))
    heads = [(r.part, r.head.doc_id, r.head.h) for r in sorted(heads.collect(), key=lambda r: r.part)]
    after = [(heads[k - 1][0], heads[k][1], heads[k][2]) for k in range(len(heads))] if heads else []  # the first range's head also closes the last
    table = spark.createDataFrame(after, "to int, head_id long, head_hash long")
    copies = own.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_hash"))).select(F.col("to").alias("part"), "doc_id", "text", "h", F.lit(1).alias("copy")).dropDuplicates(["part"])
    rows = own.select("part", "doc_id", "text", "h", F.lit(0).alias("copy")).union(copies)
    rows = rows.repartition(n, "part").sortWithinPartitions("part", "copy", F.col("doc_id").desc_nulls_last(), "h")

    def run(batches):
        last, size = None, 0
        cols = [[] for _ in range(7)]

        def add(doc_id, text, own_, following, its):
            edited = edited_text(text, following)
            new = anchors(edited)
            row = (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own_), to_text(new), likeness(own_, new), likeness(own_, its))
            for c, v in zip(cols, row):
                c.append(v)
            return len(edited)

        def batch():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in OUT.split(", ")])
            for c in cols:
                c.clear()
            return got

        for b in batches:
            for part, doc_id, text, copy in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "copy"))):
                its = anchors(text)
                if last is not None and last[0] == part:
                    size += add(*last[1:], text, its)
                last = None if copy else (part, doc_id, text, its)
                if size >= 4 << 20:
                    yield batch()
                    size = 0
        yield batch()

    return rows.select("part", "doc_id", "text", "copy").mapInArrow(run, OUT)
