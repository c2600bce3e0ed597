"""Byte-level BPE in two tiers, and its inverse.

The first tier is a minimal perfect hash over the vocabulary: one displacement for each bucket of
keys sends every entry to its own slot among exactly as many slots as entries, and comparing the
stored entry tells members from others.  A pre-token found there is one id.  The second tier merges
the rest: its bytes form a linked list, and a heap of neighbouring pairs, ordered by rank and then by
place, gives the next merge.

The ranks file and the pattern are parameters; nothing of them is copied here.  Null and empty texts
have no ids and decode to no bytes.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

MEMO = 250_000  # pre-tokens that a worker remembers, in each of two generations
KEPT = 48  # characters of the longest of them
_MIX, _WORD = np.uint64(0x9E3779B97F4A7C15), 0xFFFFFFFFFFFFFFFF


def read_ranks(path: str) -> list[bytes]:
    """Entries of a ``.tiktoken`` file by their rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    out = [b""] * len(ranks)
    for k, v in ranks.items():
        out[v] = k
    return out


def _mixed(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    x = (h ^ (d * _MIX)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """A minimal perfect hash by hash and displace over distinct byte strings."""

    LOAD = 4  # keys to a bucket

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // self.LOAD)
        h = self.hashes(keys)
        bucket = (h >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))
        self.shift = np.zeros(self.buckets, np.int64)
        free = np.ones(n, bool)
        sizes = np.diff(edges)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own, at = h[order[edges[b] : edges[b + 1]]], 1
            while True:
                d = np.arange(at, at + 256, dtype=np.uint64)
                slots = np.sort(_mixed(own[None], d[:, None]) % np.uint64(n), 1)
                ok = free[slots].all(1) & (np.diff(slots, axis=1) > 0).all(1)
                if ok.any():
                    k = int(ok.argmax())
                    self.shift[b] = at + k
                    free[slots[k]] = False
                    break
                at += 256
        for b, slot in zip(np.flatnonzero(sizes == 1), np.flatnonzero(free)):
            self.shift[b] = -1 - slot  # a lone key takes a slot that is left
        self.keys: list = [None] * n
        self.value = np.zeros(n, np.int32)
        for i, s in enumerate(self._slots(h)):
            self.keys[s], self.value[s] = keys[i], i
        self._shift, self._value = self.shift.tolist(), self.value.tolist()

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, h: np.ndarray) -> np.ndarray:
        d = self.shift[(h >> np.uint64(32)) % np.uint64(self.buckets)]
        return np.where(d < 0, -1 - d, (_mixed(h, d.astype(np.uint64)) % np.uint64(max(self.n, 1))).astype(np.int64))

    def find(self, key: bytes) -> int:
        """The value of the key, -1 for strangers."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self._shift[(h >> 32) % self.buckets]
        if d < 0:
            s = -1 - d
        else:
            x = ((h ^ (d * int(_MIX) & _WORD)) * 0xBF58476D1CE4E5B9) & _WORD
            s = (x ^ (x >> 29)) % self.n
        return self._value[s] if self.keys[s] == key else -1


class Merger:
    """The second tier: a heap of neighbouring pairs over linked bytes."""

    def __init__(self, entries: list[bytes]):
        self.ranks = {e: i for i, e in enumerate(entries)}
        self.pairs = [-1] * 65536  # ranks of two bytes
        for e, i in self.ranks.items():
            if len(e) == 2:
                self.pairs[e[0] << 8 | e[1]] = i

    def ids(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the lowest rank first, the leftmost of equals."""
        n = len(piece)
        pairs, ranks, get, pop, push = self.pairs, self.ranks, self.ranks.get, heapq.heappop, heapq.heappush
        end = list(range(1, n + 1))  # of the part that begins here; 0: no part begins here any more
        before = list(range(-1, n - 1))
        # rank, place and end of the joined part, as one number
        heap = [r << 64 | i << 32 | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := pairs[a << 8 | b]) >= 0]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            i, stop = top >> 32 & 0xFFFFFFFF, top & 0xFFFFFFFF
            j = end[i]
            if not j or j == n or end[j] != stop:
                continue  # one of the two parts has been merged since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                after = end[stop]
                r = get(piece[i:after])
                if r is not None:
                    push(heap, r << 64 | i << 32 | after)
            p = before[i]
            if p >= 0:
                r = get(piece[p:stop])
                if r is not None:
                    push(heap, r << 64 | p << 32 | stop)
        out, i = [], 0
        while i < n:
            stop = end[i]
            out.append(ranks[piece[i:stop]])
            i = stop
        return out


def ascii_form(pattern: str):
    """How to find the pattern's matches in texts of ASCII alone, whose letters and digits need no tables; None if unknown."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        for name, range_ in ((r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9")):
            if pattern.startswith(name, at):
                out.append(range_ if inside else f"[{range_}]")
                at += len(name)
                break
        else:
            step = 2 if pattern[at] == "\\" else 1
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            out.append(pattern[at : at + step])
            at += step
    plain = "".join(out)
    if re.search(r"\\[pPNX]", plain):
        return None
    try:
        return re.compile(plain, re.ASCII).findall
    except re.error:
        return None


class Codec(dict):
    """Ids of pre-tokens, as the bytes of 32-bit numbers; those of new ones are looked up or merged, and kept.

    They are kept in two generations, this one and ``old``, which bound the memory and change no result.
    """

    def __init__(self, entries: list[bytes], pattern: str):
        super().__init__()
        # white space is what Unicode calls so, without the four separators U+001C to U+001F
        spaced = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.findall = regex.compile(spaced).findall
        self.findall_ascii = ascii_form(pattern) or self.findall
        self.whole = PerfectHash(entries)
        self.merger = Merger(entries)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            raw = piece.encode("utf-8")
            r = self.whole.find(raw)
            ids = [r] if r >= 0 else self.merger.ids(raw)
            got = struct.pack(f"={len(ids)}i", *ids)
        if len(piece) <= KEPT:
            self[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        findall = self.findall_ascii if text.isascii() else self.findall
        out = b"".join(map(self.__getitem__, findall(text)))
        if len(self) > MEMO:
            self.old = dict(self)
            self.clear()
        return out


class Bytes:
    """The entries' bytes end to end, to look up many ids at once."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(e) for e in entries], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and where those of the first ``ends`` ids end, from 0."""
        size = self.size[ids]
        stop = np.cumsum(size)
        at = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.first[ids] - (stop - size), size)
        return self.data[at], np.concatenate([[0], np.concatenate([[0], stop])[ends]])


_CODECS: dict = {}  # one for each vocabulary in a worker


def _codec(shared, pattern: str) -> Codec:
    key = (shared.id if hasattr(shared, "id") else id(shared), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, pattern)
    return _CODECS[key]


def _vocabulary(df: DataFrame, ranks_path: str):
    # a vocabulary has a fixed size (here about 50,000 short entries), whatever the data
    return df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds the ids of each text as ``to`` (array of int); an existing column of that name is replaced."""
    bounded_batches(docs.sparkSession)
    shared = _vocabulary(docs, ranks_path)

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(shared, pattern)
        ids = [codec.encode(x) if x else b"" for x in texts.to_pylist()]
        offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))

    return docs.withColumn(to, run(F.col(text)))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for as ``to``; null ids give no bytes."""
    bounded_batches(df.sparkSession)
    shared = _vocabulary(df, ranks_path)

    table: list = []

    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        if not table:
            table.append(Bytes(shared.value))
        n = np.diff(rows.offsets.to_numpy())  # a null has no ids
        data, ends = table[0].join(rows.flatten().to_numpy(zero_copy_only=False), np.cumsum(n))
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])

    return df.withColumn(to, run(F.col(ids)))


def report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Number and digest of the ids of each text and digest of the bytes decoded from them."""
    done = decode(encode(docs.select("doc_id", "text"), ranks_path, pattern), ranks_path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
