"""Periodic runs, packing and importance resampling against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from tidewater.llm import importance, packing, queries, runs
from tidewater.llm.common import load

SF = "/root/testdata/sf0.001"
WORDS = P.path(queries.WORDS)


# 11 periodic runs
def all_runs(words):
    """Every stretch that each period in turn keeps, the smallest period first."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                out.setdefault((start, i + q), q)
            i += i == start or i + q < n
    return sorted((s, e - s, q) for (s, e), q in out.items())


def a_text(r):
    if r.random() < 0.5:
        return [r.randrange(r.choice([1, 2, 2, 3])) for _ in range(r.randint(0, 90))]
    t = []
    while len(t) < 60:
        w = [r.randrange(3) for _ in range(r.randint(1, 12))]
        t += (w * r.randint(1, 9))[: r.randint(1, 80)]
    return t


def test_sums_of_squares_are_exact():
    r = random.Random(5)
    for size in (1, 2, 4, 8, 64, 1024, runs.LONGEST):
        code = runs.coded(np.array([r.randrange(9) for _ in range(6 * size)]), size)
        blocks, windows = code[: 2 * size].reshape(2, size), code[2 * size :].reshape(2, 2 * size)
        places = range(0, size, max(1, size // 50))
        want = [[((blocks[i] - windows[i, k : k + size]) ** 2).sum() for k in places] for i in range(2)]
        got = runs.mismatches(blocks.T, windows.T).T
        assert (got[:, list(places)] == np.array(want)).all() and got.min() >= 0 and size * int(code.max()) ** 2 < runs.P


@pytest.mark.parametrize("longest", [runs.LONGEST, 8])
def test_runs_are_those_of_brute_force(monkeypatch, longest):
    monkeypatch.setattr(runs, "LONGEST", longest)
    r = random.Random(longest)
    for _ in range(150):
        texts = [a_text(r) for _ in range(r.randint(1, 30))]
        got = runs.runs_of([np.array(t, np.int64) for t in texts])
        assert [sorted(g) for g in got] == [all_runs(t) for t in texts]
    for _ in range(3):
        t = []
        while len(t) < 2500:
            w = [r.randrange(4) for _ in range(r.choice([1, 3, 17, 100, 300]))]
            t += (w * r.randint(1, 9))[: r.randint(1, 2500)]
        assert runs.runs_of([np.array(t, np.int64)])[0] == all_runs(t)


def test_large_periods_and_one_word():
    r = random.Random(1)
    w = [r.randrange(1000) for _ in range(40_000)]
    assert runs.runs_of([np.array([5000, *w, *w, *w, *w, w[0], 5001], np.int64)])[0] == [(1, 160_001, 40_000)]
    assert runs.runs_of([np.zeros(100_000, np.int64)])[0] == [(0, 100_000, 1)]


def run_rows(rows):
    """The contract's columns, by brute force."""
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = all_runs(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest(lines), digest(kept)))
    return sorted(out, key=str)


def test_run_query_on_whole_table(spark):
    docs = load(spark, SF, "documents").where(F.length("text") < 4000)
    got = runs.report(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == run_rows([(r.doc_id, r.text) for r in docs.collect()]) and sum(r[1] for r in rows) > 0
    assert queries.op11_periodic_runs(spark, SF).count() == load(spark, SF, "documents").count()


def test_runs_odd_rows(spark, odd):
    rows = [r for r in odd.collect() if r.text is None or len(r.text) < 1000]
    got = [tuple(r) for r in runs.report(odd).collect()]
    long = [r for r in got if r[0] == 6]
    assert sorted((r for r in got if r[0] != 6), key=str) == run_rows([(r.doc_id, r.text) for r in rows])
    assert long[0][1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert runs.report(odd.limit(0)).collect() == []
    assert [r.runs for r in runs.search(spark.createDataFrame([(1, "a b " * 5)], "doc_id long, text string")).collect()] == [[(0, 10, 2)]]


# 12 packing
def differenced(sizes, k):
    heap = [(-s, i, [s] + [0] * (k - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        c = sorted((x + y for x, y in zip(sorted(a), sorted(b, reverse=True))), reverse=True)
        n += 1
        heapq.heappush(heap, (c[-1] - c[0], n, c))
    return [x for x in heap[0][2] if x]


def test_differencing():
    r = random.Random(2)
    for _ in range(300):
        sizes, k = [r.randint(1, 50) for _ in range(r.randint(1, 30))], r.randint(1, 12)
        got = packing.difference(sizes, k)
        assert [load for load, _ in got] == differenced(sizes, k)
        assert sorted(p for _, parts in got for p in parts) == list(range(len(sizes)))
        assert all(load == sum(sizes[p] for p in parts) for load, parts in got)
    assert packing.difference([], 3) == [] and packing.fill([], 8) == ([], [])
    # the count rises where the smallest one does not fit
    assert len(packing.windows([5, 5, 5], 8)) == 3
    # nearly equal windows: few parts are cut
    sizes = [min(2047, 1 + int(r.lognormvariate(5, 1))) for _ in range(2600)]
    full, rest = packing.fill(sizes, 2048)
    assert all(sum(n for _, _, n in w) == 2048 for w in full) and sum(n for _, _, n in rest) == sum(sizes) % 2048
    whole = sum(1 for w in full for p, _, n in w if n == sizes[p])
    assert whole > 0.95 * len(sizes)


def check_pieces(docs, rows, width):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    ids = [(d, np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")) for d, x in docs]
    want = Counter((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids)
    by_doc = defaultdict(list)
    for d, x in ids:
        by_doc[d].append(x)
    got, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.doc_tokens, r.ids))
        seqs[r.sequence_id].append((r.offset, r.length))
    for d, texts in by_doc.items():
        pieces = sorted(got.pop(d), key=lambda p: p[0])
        if len(texts) == 1:
            assert b"".join(p[3] for p in pieces) == texts[0].tobytes() and pieces[0][2] == len(texts[0])
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()]
        assert sum(p[1] for p in pieces) == sum(map(len, texts))
    assert not got and sum(want.values()) == len(docs)
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == width or at < width and at & (at - 1) == 0


def test_packing_on_whole_table(spark):
    docs = load(spark, SF, "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for width, block in ((2048, 256), (64, 8)):
        got = packing.pack(docs.repartition(3), WORDS, width=width, block=block).collect()
        check_pieces(texts, got, width)
        assert len(got) < len(texts) + 1.2 * sum(r.length for r in got) / width + 40
    rows = queries.op12_packing(spark, SF).collect()
    assert rows[0].__fields__ == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_packing_odd_rows(spark, odd):
    got = packing.pack(odd, WORDS).collect()
    check_pieces([(r.doc_id, r.text) for r in odd.collect()], got, 2048)
    assert packing.pack(odd.limit(0), WORDS).collect() == []


def test_word_ids_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    t, codec = Tokenizer.from_file(WORDS), packing.Codec(WORDS)
    texts = [r.text or "" for r in load(spark, SF, "documents").collect()]
    texts += ["x.\x01. a\x01 \x01 b. é. 9, q", "H̱ <|ENDOFTEXT|> it's. 'S. DON'T, A.B.C. x", " \x01 ", "á ́b\x1c\x85 <|endoftext|> x", "12³ ǅ İ"]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in codec.ids([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


# 13 importance
def drawn(docs, target, percent=10, least=20, buckets=10_000, max_n=1, seed=2024):
    def features(text):
        w = re.findall(importance.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    own = [(d, *features(x)) for d, x in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    top, low = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * top / ((s[b] + 1) * low)))
    rows = []
    for d, n, f in own:
        weight = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))[: percent * sum(r[4] for r in rows) // 100]
    ranks = defaultdict(list)
    for k, r in enumerate(order):
        ranks[r[:4]].append(k + 1)
    return sorted(((*r[:4], ranks[r[:4]].pop() if ranks[r[:4]] else None) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"max_n": 2, "buckets": 500, "percent": 37, "seed": 7}])
def test_importance_on_whole_table(spark, options):
    docs, target = load(spark, SF, "documents"), load(spark, SF, "benchmark")
    got = importance.resample(docs, target, **options).select("doc_id", "n_features", "weight", "score", "rank")
    want = drawn([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], **options)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and any(r[4] for r in want)


def test_importance_odd_rows_and_ties(spark, odd):
    target = spark.createDataFrame([("the cat sat",), (None,)], "text string")
    for percent in (0, 50, 100):
        got = importance.resample(odd, target, percent=percent, min_words=2).select("doc_id", "n_features", "weight", "score", "rank")
        want = drawn([(r.doc_id, r.text) for r in odd.collect()], ["the cat sat"], percent, 2)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert importance.report(odd.limit(0), target).collect() == []
    assert importance.report(odd, target.limit(0)).count() == 10
    # many rows at the cutoff, some of them with one id or none
    tied = spark.createDataFrame([(i, 30, 30, 0, 5 if i % 3 else 9, True) for i in range(60)] + [(58, 30, 30, 0, 5, True)] * 3 + [(None, 30, 30, 0, 5, True)] * 2, "doc_id long, n_words long, n_features long, weight long, score long, eligible boolean")
    for wanted in (0, 1, 20, 21, 35, 60, 61, 63, 64, 65):
        ranks = sorted((r["rank"], -r.score, r.doc_id is None, r.doc_id or 0) for r in importance.draw(tied, wanted).collect() if r["rank"])
        assert [r[0] for r in ranks] == list(range(1, wanted + 1)) and [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)
        assert importance.draw(tied, wanted).count() == 65
