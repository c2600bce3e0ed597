"""Slices of users' ratings on their way to the tasks that sum pairs: packed before the shuffle, summed behind it.

A slice is one rating ``(a, x)`` and the whole-number arrays of the ratings it is paired with.  Slices that go to one
task are kept column by column, ids as steps, and compressed together, so that a pair takes about two bytes of shuffle.
Both functions work inside tasks on Arrow batches and carry all they need to the workers.
"""

from __future__ import annotations

COLUMNS = ("sizes", "firsts", "xs", "steps", "ys")
PACKED = "a long, n int, " + ", ".join(f"{c} array<binary>" for c in COLUMNS)
SUMS = "item1 long, item2 long, sum_xy long, sum_xx long, sum_yy long, num_pairs long"
PAIRS_AT_ONCE = 2_000_000  # in a worker's memory


def packer(keys: list[int], names: list[str], bits: dict[str, int], most: int = PAIRS_AT_ONCE):
    """Batches of (t, a, x, arrays) as rows of :data:`PACKED`, one for the slices of a task at a time; ``keys[t]`` is the
    key of task ``t``.  ``names``: the arrays, whose numbers are in a ``_up`` part too where ``bits`` of them are not enough."""

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def planes(v):
            z = ((v << 1) ^ (v >> 63)).view(np.uint64)
            width = (int(z.max()).bit_length() + 7) // 8 if len(z) else 0
            b = z.view(np.uint8).reshape(-1, 8)
            return [pa.compress(b[:, i].tobytes(), codec="zstd", asbytes=True) for i in range(width)]

        def numbers(table, name):
            low = table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if f"{name}_up" not in names:
                return low
            up = table[f"{name}_up"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            return (up << bits[name]) + low + (1 << (bits[name] - 1))

        def packed(kept):
            table = pa.Table.from_batches(kept)
            order = np.lexsort((table["a"].to_numpy(), table["t"].to_numpy()))
            table = table.take(pa.array(order))
            t, a, x = (table[c].to_numpy().astype(np.int64) for c in ("t", "a", "x"))
            sizes = table["items"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            items, ys = numbers(table, "items"), numbers(table, "ys")
            ends = np.cumsum(sizes)
            steps = np.diff(items, prepend=0)
            steps[ends - sizes] = items[ends - sizes] - a
            cuts = np.flatnonzero(np.diff(t, prepend=-1, append=-1))
            rows = []
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                begin, end = int(ends[low] - sizes[low]), int(ends[high - 1])
                parts = (sizes[low:high], np.diff(a[low:high], prepend=0), x[low:high], steps[begin:end], ys[begin:end])
                rows.append({"a": keys[t[low]], "n": high - low, **{c: planes(v) for c, v in zip(COLUMNS, parts, strict=True)}})
            blobs = pa.list_(pa.binary())
            kind = pa.schema([("a", pa.int64()), ("n", pa.int32()), *((c, blobs) for c in COLUMNS)])
            return pa.RecordBatch.from_pylist(rows, schema=kind)

        kept, pairs = [], 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                pairs += len(batch.column("items").flatten())
            if pairs >= most:
                yield packed(kept)
                kept, pairs = [], 0
        if kept:
            yield packed(kept)

    return pack


def summer(most: int = PAIRS_AT_ONCE):
    """The packed slices of one task as rows of :data:`SUMS`, one for each pair of different items."""

    def total(table):
        import numpy as np
        import pyarrow as pa

        def numbers(blobs, n):
            z = np.zeros((n, 8), np.uint8)
            for i, blob in enumerate(blobs):
                z[:, i] = np.frombuffer(pa.decompress(blob, decompressed_size=n, codec="zstd"), np.uint8)
            z = z.reshape(-1).view(np.uint64)
            return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)

        def grouped(columns):
            a, b, *sums = (np.concatenate(c) for c in columns)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
            return [a[first], b[first], *(np.add.reduceat(s[order], first) if len(a) else s for s in sums)]

        def pairs(row):
            n = row["n"]
            sizes = numbers(row["sizes"], n)
            every = int(sizes.sum())
            a, x = np.cumsum(numbers(row["firsts"], n)), numbers(row["xs"], n)
            steps, y = numbers(row["steps"], every), numbers(row["ys"], every)
            begin = np.cumsum(sizes) - sizes
            sums = np.cumsum(steps)
            b = sums + np.repeat(a - (sums[begin] - steps[begin]), sizes)
            a, x = np.repeat(a, sizes), np.repeat(x, sizes)
            other = a != b
            a, b, x, y = a[other], b[other], x[other], y[other]
            return [a, b, x * y, x * x, y * y, np.ones(len(a), np.int64)]

        parts, held, waiting, raw = [], 0, [], 0
        for batch in table.to_batches(max_chunksize=256):
            for row in batch.to_pylist():
                waiting.append(pairs(row))
                raw += len(waiting[-1][0])
                if raw >= most:
                    parts.append(grouped(list(zip(*waiting, strict=True))))
                    waiting, raw, held = [], 0, held + len(parts[-1][0])
                    if held >= 4 * len(parts[0][0]) and held >= most:
                        parts = [grouped(list(zip(*parts, strict=True)))]
                        held = len(parts[0][0])
        a, b, xy, aa, bb, n = grouped(list(zip(*parts, *waiting, strict=True)))
        low = a < b
        columns = [np.minimum(a, b), np.maximum(a, b), xy, np.where(low, aa, bb), np.where(low, bb, aa), n]
        order = np.lexsort((columns[4], columns[3]))  # equal sums together: rows take less room where they are written
        return pa.table({c: v[order] for c, v in zip(("item1", "item2", "sum_xy", "sum_xx", "sum_yy", "num_pairs"), columns, strict=True)})

    return total
