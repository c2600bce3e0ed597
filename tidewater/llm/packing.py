"""Packs token ids into windows of one width: multiway Karmarkar-Karp differencing.

Each task tokenises its documents and packs them in blocks of ``BLOCK`` windows, so that no token is
shuffled and a task holds one block and one document.  Of a document longer than the width whole windows
are cut off; what is left (shorter than the width) is a part to be placed whole.  Every part begins as a
partial partition with one loaded window.  The two partial partitions of the widest spread (largest minus
smallest window) are merged, the fullest windows of one with the emptiest of the other, until one is left.
Where its fullest window is over the width, the number of windows rises and the differencing starts anew.

The windows are then nearly alike and nearly full.  As cuts are free, the emptiest of them are cut up to
fill the others to the width.  What is left of a block waits for the task's next block; what is left of a
task's last block is cut into windows of falling powers of two, which need no padding either.

Rows: a null text is an empty one, and an empty one has the end id alone.  Null and repeated doc_ids, and
repeated rows, are documents of their own.  A very long text is cut into many windows.  An empty table
gives an empty result.  Only the id and text columns are read; others, whatever their names, are left out.
A retried task makes the same windows, as it reads the same rows in the same order.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from bisect import insort
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

WIDTH = 2048
END = 1
#: Windows differenced at once.
BLOCK = 256
#: Words whose ids a worker keeps, in each of two generations, and the longest word it keeps.
MEMO_WORDS, MEMO_BYTES = 250_000, 48
#: Rows and id bytes after which a worker hands on a batch.
OUT_ROWS, OUT_BYTES = 4096, 8 << 20

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], k: int) -> list[tuple[int, list[int]]]:
    """Karmarkar-Karp: ``k`` windows of nearly equal load, as (load, parts), largest first."""
    # a partial partition lists its loaded windows, smallest first; windows not listed are empty
    heap = [(-s, i, [(s, i, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        met = len(a) + len(b) - k  # windows of both that must share a place
        if met > 0:
            # a's empty windows go with b's largest; then a's smallest with b's largest of the others
            for j in range(met):
                small, large = a[j], b[met - 1 - j]
                x, y = (small[2], large[2]) if len(small[2]) >= len(large[2]) else (large[2], small[2])
                x.extend(y)
                a[j] = (small[0] + large[0], min(small[1], large[1]), x)
            if met > 1:
                a.sort(key=lambda w: w[:2])
            else:
                insort(a, a.pop(0), key=lambda w: w[:2])
            b = b[met:]
        if len(b) == 1:
            insort(a, b[0], key=lambda w: w[:2])
        elif b:
            a = list(heapq.merge(a, b, key=lambda w: w[:2]))
        n += 1
        heapq.heappush(heap, (-(a[-1][0] - (a[0][0] if len(a) == k else 0)), n, a))
    return [(load, parts) for load, _, parts in reversed(heap[0][2])] if heap else []


def windows(sizes: list[int], width: int) -> list[tuple[int, list[int]]]:
    """As few nearly equal windows as differencing fits into the width; each part is at most that wide."""
    k, step = max(1, -(-sum(sizes) // width)), 1
    while (got := difference(sizes, k)) and got[0][0] > width:
        k, step = k + step, 2 * step
    return got


def fill(sizes: list[int], width: int) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Full windows, and what is left (less than a window), as pieces (part, start in it, length)."""
    got = windows(sizes, width)
    full = sum(sizes) // width
    spare = [(p, 0, sizes[p]) for _, parts in got[full:] for p in reversed(parts)]
    out = []
    for load, parts in got[:full]:
        pieces = [(p, 0, sizes[p]) for p in parts]
        while load < width:
            p, at, n = spare.pop()
            take = min(n, width - load)
            pieces.append((p, at, take))
            load += take
            if take < n:
                spare.append((p, at + take, n - take))
        out.append(pieces)
    return out, spare[::-1]


def halves(pieces: list[tuple[int, int, int]], width: int) -> list[list[tuple[int, int, int]]]:
    """Cuts pieces shorter than ``width`` together into windows of falling powers of two."""
    left, out = sum(n for _, _, n in pieces), []
    rest = pieces[::-1]
    while left:
        room = min(width, 1 << (left.bit_length() - 1))
        left -= room
        out.append([])
        while room:
            p, at, n = rest.pop()
            take = min(n, room)
            out[-1].append((p, at, take))
            room -= take
            if take < n:
                rest.append((p, at + take, n - take))
    return out


class Codec(dict):
    """Ids of words, and so of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins ids over it, so a text's ids are those of its words.
    A word of letters between marks is three parts of their own, and case is dropped.  New letters go to the
    tokenizer's model, written as it writes their bytes; any other new word goes through the whole tokenizer.
    Words are kept in two generations, this one and ``old``, which bound the memory.
    """

    #: Marks, letters that no normalisation changes, marks.  An apostrophe before letters may belong to them.
    PARTS = re.compile("([!-&(-/:-@\\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all it may use
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[bytes, bytes] = {}
        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode
        self.tokenize = tokenizer.model.tokenize
        letters = [chr(c) for c in range(0x61, 0x100) if self.PARTS.fullmatch(chr(c)) and chr(c).islower()]
        self.written = {ord(c): tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def __missing__(self, word: bytes) -> bytes:
        got = self.old.get(word)
        if got is None:
            got = self._new(word)
        if len(word) <= MEMO_BYTES:
            self[word] = got
        return got

    def _new(self, raw: bytes) -> bytes:
        if raw.isalpha() and raw.islower():
            return pack_ids([t.id for t in self.tokenize(raw.decode())])
        word = raw.decode("utf-8", "replace")
        parts = self.PARTS.fullmatch(word)
        if not parts or "<|" in word:  # a special token is an id of its own
            return pack_ids(self.encode(word, add_special_tokens=False).ids)
        before, letters, after = parts.groups()
        low = letters.lower()
        if low == word:
            return pack_ids([t.id for t in self.tokenize(low.translate(self.written))])
        marks = lambda m: self._marks(m.encode()) if m else b""
        return marks(before) + self[low.encode()] + marks(after)

    def _marks(self, marks: bytes) -> bytes:
        """Marks alone, kept under a name that no word has."""
        key = b" " + marks
        got = self.get(key) or self.old.get(key) or pack_ids(self.encode(marks.decode(), add_special_tokens=False).ids)
        if len(key) <= MEMO_BYTES:
            self[key] = got
        return got

    def ids(self, texts: list[bytes]) -> list[bytes]:
        get = self.__getitem__
        out = []
        for t in texts:
            out.append(b"".join(map(get, t.split())))
            if len(self) > MEMO_WORDS:
                self.old = dict(self)
                self.clear()
        return out


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """A worker's codec, and the words it keeps, for all of its tasks."""
    return Codec(path)


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END, block: int = BLOCK) -> DataFrame:
    """Pieces of the documents' ids with their places in the sequences."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        codec, mark = codec_of(tokenizer), end.to_bytes(4, "little")
        at = TaskContext.get().partitionId() << 36
        cols = [[] for _ in range(7)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        parts, waiting, held = [], 0, 0  # parts: (doc_id, start, ids, doc_tokens)

        def place(pieces):
            nonlocal at, held
            offset = 0
            for doc_id, start, ids, doc_tokens in pieces:
                n = len(ids) // 4
                for c, v in zip(cols, (doc_id, start, n, ids, doc_tokens, at, offset)):
                    c.append(v)
                offset += n
                held += len(ids)
            at += 1

        def cut(piece):
            p, start, n = piece
            doc_id, first, ids, doc_tokens = parts[p]
            return doc_id, first + start, ids[4 * start : 4 * (start + n)], doc_tokens

        def batch():
            nonlocal held
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in SCHEMA.split(", ")])
            for c in cols:
                c.clear()
            held = 0
            return got

        for b in batches:
            texts = [x or b"" for x in b.column("text").to_pylist()]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), codec.ids(texts)):
                ids += mark
                n = len(ids) // 4
                whole = n - n % width
                for start in range(0, whole, width):
                    place([(doc_id, start, ids[4 * start : 4 * (start + width)], n)])
                    if held >= OUT_BYTES:
                        yield batch()
                if whole < n:
                    parts.append((doc_id, whole, ids[4 * whole :], n))
                    waiting += n - whole
                if waiting >= block * width:
                    full, rest = fill([len(p[2]) // 4 for p in parts], width)
                    for pieces in full:
                        place(map(cut, pieces))
                    parts = [cut(p) for p in rest]
                    waiting = sum(len(p[2]) // 4 for p in parts)
                if held >= OUT_BYTES or len(cols[0]) >= OUT_ROWS:
                    yield batch()
        full, rest = fill([len(p[2]) // 4 for p in parts], width)
        for pieces in full + halves(rest, width):
            place(map(cut, pieces))
        yield batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SCHEMA)


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of all documents, with a checksum of their ids instead of the ids."""
    ids = F.crc32("ids").alias("ids_crc32")
    return pack(docs, tokenizer).select("doc_id", "start", "length", ids, "doc_tokens", "sequence_id", "offset")
