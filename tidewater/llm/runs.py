"""Finds periodic runs of words by block convolution and drops the repeats.

A run is a stretch of consecutive words with smallest period q and at least ``max(6, 4 * q)`` words that
no neighbouring word extends.  For a period q from B to 2B - 1 (B a power of two) an aligned block of B
words inside the run occurs again q words later, within the window that follows it.  At each scale B the
texts of a batch, end to end, are cut into blocks; for every block the squared differences to each place of
its window are summed by a number-theoretic transform modulo 65537 (whole numbers, no rounding).  Words
are coded in so few bits that no sum reaches the modulus, so a sum of zero is exactly a block without
mismatch.  The distances found seed extensions on the words themselves.

What keeps the work in proportion to the text: places inside a run already known, whose period divides the
distance, seed nothing; and a run of four periods holds two whole blocks at least, one after the other and
at one distance, which leaves a block one distance at most.  Blocks beyond 32,768 words are located by
their first 32,768, in windows dealt with piece by piece, so that no scale is left out.

Rows: a null or empty text has no words and no runs.  A null doc_id is a text that stays as it is.
Repeated rows are searched each; ties between runs go to the smaller start, then the smaller period.  A
very long text is searched whole, with memory in proportion to it.  An empty table gives an empty result.
Only the id and text columns are read; others, whatever their names, are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

P = 65537  # 2**16 + 1: 2**16 is -1, so products are reduced by shifts
ROOT = 3  # of order 2**16
LONGEST = 1 << 15
#: Numbers that one transform holds at once.
CHUNK = 1 << 16

MIN_LENGTH, MIN_PERIODS = 6, 4

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _reduce(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same rest: 2**16 counts as -1."""
    return (x & 0xFFFF) - (x >> 16)


_roots: dict[tuple[int, bool], list[np.ndarray]] = {}


def _levels(size: int, back: bool) -> list[np.ndarray]:
    """The powers of the root that each halving needs."""
    if (size, back) not in _roots:
        out, n = [], size
        while n > 1:
            w = pow(ROOT, (P - 1) // n * (P - 2 if back else 1), P)
            powers = np.ones(1, np.int64)
            while len(powers) < n // 2:
                powers = np.concatenate((powers, powers * pow(w, len(powers), P) % P))
            out.append(powers)
            n //= 2
        _roots[size, back] = out
    return _roots[size, back]


def ntt(x: np.ndarray) -> np.ndarray:
    """Transform of each column, in bit-reversed order; rests are not made positive."""
    size, columns = x.shape
    for powers in _levels(size, False):
        v = x.reshape(-1, 2, len(powers), columns)
        out = np.empty_like(v)
        a, b = v[:, 0], v[:, 1]
        out[:, 0] = _reduce(a + b)
        out[:, 1] = _reduce(_reduce((a - b) * powers[:, None]))
        x = out
    return x.reshape(size, columns)


def inverse(x: np.ndarray) -> np.ndarray:
    """The columns whose transforms (in bit-reversed order) are given, from 0 to P - 1."""
    size, columns = x.shape
    for powers in reversed(_levels(size, True)):
        v = x.reshape(-1, 2, len(powers), columns)
        out = np.empty_like(v)
        a, b = v[:, 0], _reduce(_reduce(v[:, 1] * powers[:, None]))
        np.add(a, b, out=out[:, 0])
        np.subtract(a, b, out=out[:, 1])
        x = _reduce(out)
    return x.reshape(size, columns) * pow(size, P - 2, P) % P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences of each block (a column) and each place of its window (a row of the result).

    A window has twice the block's length; the places are those from 0 to the block's length - 1.
    Sums must stay below 65537.
    """
    size, columns = blocks.shape
    turned = np.zeros((2 * size, columns), np.int64)
    turned[:size] = blocks[::-1]
    cross = inverse(_reduce(_reduce(ntt(turned) * ntt(windows))))[size - 1 : 2 * size - 1]
    squares = np.concatenate((np.zeros((1, columns), np.int64), np.cumsum(windows * windows, axis=0)))
    own = (blocks * blocks).sum(axis=0)
    return own + (squares[size : 2 * size] - squares[:size]) - 2 * cross


def coded(words: np.ndarray, size: int) -> np.ndarray:
    """Words in so few bits that no sum of ``size`` squares or products reaches the modulus; other ones at each size."""
    bits = 1
    while size * ((2 << bits) - 1) ** 2 < P:
        bits += 1
    mixed = (words.astype(np.uint64) + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def candidates(words: np.ndarray, scale: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (their starts) and the distances, 2**scale to twice that, at which they occur without mismatch.

    Left out are places inside one known run (``reach`` is the end of the longest one at each word), and
    blocks whose neighbours on both sides do not occur at the same distance.
    """
    size, n = 1 << scale, len(words)
    short = min(size, LONGEST)
    code = np.concatenate((coded(words, short), np.zeros(2 * size + short, np.int64)))
    starts = np.arange(0, max(n - 2 * size + 1, 0), size)
    step = max(1, CHUNK // (2 * short))
    found_b, found_d = [], []
    for at in range(0, len(starts), step):
        some = starts[at : at + step]
        blocks = code[some + np.arange(short)[:, None]]
        for first in range(size, 2 * size, short):
            windows = code[some + first + np.arange(2 * short)[:, None]]
            place, column = np.nonzero(mismatches(blocks, windows) == 0)
            b, d = some[column], first + place
            keep = (b + d + size <= n) & (reach[b] < b + d + size)
            b, d = b[keep], d[keep]
            keep = (words[b] == words[b + d]) & (words[b + size - 1] == words[b + d + size - 1])
            found_b.append(b[keep])
            found_d.append(d[keep])
    b, d = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_b, found_d))
    order = np.lexsort((b, d))
    b, d = b[order], d[order]
    if len(b):
        after = np.zeros(len(b), bool)
        after[:-1] = (d[1:] == d[:-1]) & (b[1:] == b[:-1] + size)
        before = np.zeros(len(b), bool)
        before[1:] = after[:-1]
        b, d = b[after | before], d[after | before]
    return b, d


def _same(words: np.ndarray, at: int, d: int) -> int:
    """How many words from ``at`` on equal those ``d`` later."""
    n, got, step = len(words), 0, 64
    while at + got + d < n:
        end = min(at + got + step, n - d)
        differ = np.flatnonzero(words[at + got : end] != words[at + got + d : end + d])
        if len(differ):
            return got + int(differ[0])
        got, step = end - at, 2 * step
    return got


def _same_back(words: np.ndarray, at: int, d: int) -> int:
    """How many words before ``at`` equal those ``d`` later."""
    end, step = at, 64
    while end:
        begin = max(0, end - step)
        differ = np.flatnonzero(words[begin:end] != words[begin + d : end + d])
        if len(differ):
            return at - begin - 1 - int(differ[-1])
        end, step = begin, 2 * step
    return at


def find_runs(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of texts laid end to end.

    ``words`` holds numbers of words, and one of its own after each text; ``ends`` the place of that one.
    The texts must come longest first, so that larger scales need only the first of them.
    """
    lengths = np.diff(np.concatenate(([-1], ends))) - 1
    reach = np.zeros(len(words), np.int64)
    runs: dict[tuple[int, int], int] = {}
    scale = 0
    while len(lengths) and lengths[0] >= max(MIN_LENGTH, MIN_PERIODS << scale):
        last = int(np.searchsorted(-lengths, -max(MIN_LENGTH, MIN_PERIODS << scale), "right"))
        part = words[: ends[last - 1] + 1]
        new = []
        done_d, done_end = -1, -1
        for b, d in zip(*(x.tolist() for x in candidates(part, scale, reach[: len(part)]))):
            if d == done_d and b < done_end:
                continue
            forward = _same(part, b, d)
            done_d, done_end = d, b + max(forward, 1)
            if not forward:
                continue
            start, end = b - _same_back(part, b, d), b + forward + d
            if end - start >= max(MIN_LENGTH, MIN_PERIODS * d) and (start, end) not in runs:
                runs[start, end] = d
                new.append((start, end))
        for start, end in new:
            np.maximum(reach[start:end], end, out=reach[start:end])
        scale += 1
    return sorted((s, e, q) for (s, e), q in runs.items())


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of word numbers (0 or more), as (start, length, period), by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return out
    flat = np.concatenate([x for k, i in enumerate(order) for x in (texts[i], [-1 - k])]).astype(np.int64)
    ends = np.cumsum([len(texts[i]) + 1 for i in order]) - 1
    for start, end, period in find_runs(flat, ends):
        k = int(np.searchsorted(ends, start))
        begin = int(ends[k]) - len(texts[order[k]])
        out[order[k]].append((start - begin, end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [w for w, d in zip(words, drop.tolist()) if not d] if runs else words


def planted(doc_id: int | None, words: list) -> list:
    """One text in ten repeats words of its own from some place on; the id's checksum says which, where and how."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def search(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Number of words, runs and the text without the repeats, of every document; ``plant`` edits some texts first."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            texts = [(x or "").encode().split() for x in b.column("text").to_pylist()]
            if plant:
                texts = [planted(i, t) for i, t in zip(ids, texts)]
            number = {w: k for k, w in enumerate(set().union(*texts))}
            found = runs_of([np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts])
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
            left = [b" ".join(collapse(t, r)).decode() for t, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, kind), pa.array(left, pa.string())], names
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    """The runs of every document, one text in ten edited first: their number, the greatest, and digests."""
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    text = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    # the greatest exact length / period: fractions are compared by cross products, ties keep the earlier run
    first = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)),
        lambda best, r: F.when(r.length * best.period > best.length * r.period, r).otherwise(best),
    )
    return (
        search(docs, plant=True)
        .withColumn("best", first)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
            F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
            F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
