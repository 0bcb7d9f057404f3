"""Packing by cutting-stock column generation.

Every document becomes whole sequences of ``SIZE`` ids and a tail. The tails' length histogram (at most SIZE - 1 counts,
the only thing the driver gathers) is the demand of a linear program over bins of lengths: a column is a pattern of bins
that share a sequence, its cost the sequence's padded length. Columns are priced by a knapsack dynamic program over the duals.
Leaving a tail of each length out of the patterns is a column too, slightly dearer than its ids; so the program starts
feasible and may stop early. Rounded-down patterns are assigned to the tails of each length by rank; tails left over are
laid end to end and cut at sequence borders, the last of them at powers of two. Ranks come from counts per task and
length, so no task sees all tails of a length.

Defined results: a null text is empty: one end id. Ids of a document that is an exact multiple of SIZE have no tail.
Repeated rows are packed one by one. An empty table gives no pieces. Other columns are ignored; texts are never cut short.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import landed
from .common import keyed_filter, lean, runs
from .tokens import encoder

SIZE = 2048
END_ID = 1
#: Extra cost of a left-over id (it may be cut) and of a sequence.
CUT_COST, SEQUENCE_COST = 0.01, 2.0
MOST_ROUNDS, MOST_PIVOTS = 600, 6000
#: Lengths in a bin of the linear program.
UNIT = 4
#: Sequence ids of whole sequences are below this, those of patterns and left-overs from it on.
SHARED = 1 << 62


def padded(n: int, size: int = SIZE) -> int:
    return n if n & (n - 1) == 0 else size


# ---- the linear program ----


def _price(y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of lengths that add up to c exactly, and its last length, for each c; y[l]: a dual, -inf if absent."""
    f, last = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64)
    f[0] = 0
    for c in range(1, size + 1):
        v = y[1 : c + 1] + f[c - 1 :: -1] if c > 1 else y[1:2] + f[0:1]
        i = c - 1 - int(v[::-1].argmax())  # of equal values the longest last length
        f[c], last[c] = v[i], i + 1
    return f, last


def _pattern(last: np.ndarray, c: int) -> tuple[int, ...]:
    out = []
    while c > 0:
        out.append(int(last[c]))
        c -= out[-1]
    return tuple(sorted(out, reverse=True))


def bin_patterns(demand: dict[int, int], capacity: int, out_cost: dict[int, float], cost: float) -> list[tuple[tuple[int, ...], int]]:
    """(bins, times): patterns of bins (a bin's number is its width in units) that fit ``capacity`` and the demand.

    Minimises ``cost`` a pattern plus ``out_cost`` for each unit of demand left out, by revised simplex with column
    generation, then rounds down, and up again where the demand allows it.
    """
    bins = sorted(b for b, k in demand.items() if k > 0)
    if not bins:
        return []
    at = {b: i for i, b in enumerate(bins)}
    m = len(bins)
    inverse, x = np.eye(m), np.array([demand[b] for b in bins], float)
    basis: list[tuple[int, ...] | None] = [None] * m  # None: a bin left out
    duals = np.array([out_cost[b] for b in bins])
    pivots = 0
    for _ in range(MOST_ROUNDS):
        y = np.full(capacity + 1, -np.inf)
        y[bins] = duals
        f, last = _price(y, capacity)
        c = int(f.argmax())
        found = {_pattern(last, c): f[c]}
        value = y[1:capacity] + f[capacity - 1 : 0 : -1]  # best full sequence with each bin in it
        used: set[int] = set()
        for n in np.lexsort((-np.arange(1, capacity), -value)) + 1:
            if value[n - 1] - cost <= 1e-6:
                break
            p = (int(n), *_pattern(last, capacity - int(n)))
            if used.isdisjoint(p):  # columns without a common bin don't spoil each other's gain
                used.update(p)
                found[tuple(sorted(p, reverse=True))] = value[n - 1]
        before = pivots
        for p in sorted(found, key=lambda p: (-found[p], p)):
            rows, times = np.unique([at[n] for n in p], return_counts=True)
            gain = duals[rows] @ times - cost
            if gain <= 1e-6 or not p:
                continue
            d = inverse[:, rows] @ times
            up = np.flatnonzero(d > 1e-9)
            if not len(up):
                continue
            r = up[int(np.lexsort((up, -d[up], x[up] / d[up]))[0])]
            step, row = x[r] / d[r], inverse[r] / d[r]
            x -= step * d
            x[r] = step
            np.maximum(x, 0, out=x)
            duals -= gain * row
            d[r] = 0
            touched = np.flatnonzero(np.abs(d) > 1e-12)
            inverse[touched] -= d[touched, None] * row
            inverse[r] = row
            basis[r] = p
            pivots += 1
        if pivots == before or pivots >= MOST_PIVOTS:
            break
    left, times_of = dict(demand), {}

    def take(p, k):
        use = {n: p.count(n) for n in p}
        k = min(k, *(left[n] // c for n, c in use.items()))
        if k > 0:
            times_of[p] = times_of.get(p, 0) + k
            for n, c in use.items():
                left[n] -= k * c

    held = sorted(((v, p) for v, p in zip(x, basis, strict=True) if p), key=lambda t: (-(t[0] % 1), t[1]))
    for v, p in held:
        take(p, int(v + 1e-6))
    for _, p in held:
        take(p, 1)
    return sorted(times_of.items())


def patterns(demand: dict[int, int], size: int = SIZE, unit: int = UNIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times): patterns that together use no length more often than ``demand`` has it.

    The program runs on bins of ``unit`` lengths; within a bin, tails ranked by length are dealt to the patterns in turn.
    """
    queues: dict[int, list[list[int]]] = {}
    for n in sorted(n for n, k in demand.items() if 0 < n < size and k > 0):
        queues.setdefault(-(-n // unit), []).append([n, demand[n]])
    total = {b: sum(k for _, k in q) for b, q in queues.items()}
    worth = {b: sum(n * k for n, k in q) / total[b] * (1 + CUT_COST) for b, q in queues.items()}

    def pull(b: int, k: int) -> list[list[int]]:
        out = []
        while k:
            n, there = queues[b][0]
            use = min(k, there)
            out.append([n, use])
            k -= use
            queues[b][0][1] -= use
            if there == use:
                queues[b].pop(0)
        return out

    exact: dict[tuple[int, ...], int] = {}
    for p, times in bin_patterns(total, size // unit, worth, size + SEQUENCE_COST):
        runs = [pull(b, times) for b in p]
        while runs[0]:
            k = min(r[0][1] for r in runs)
            key = tuple(sorted((r[0][0] for r in runs), reverse=True))
            exact[key] = exact.get(key, 0) + k
            for r in runs:
                r[0][1] -= k
                if not r[0][1]:
                    r.pop(0)
    return sorted(exact.items())


class Plan:
    """Where the r-th tail of each length goes."""

    def __init__(self, demand: dict[int, int], size: int = SIZE):
        self.size = size
        slots: dict[int, list[tuple[int, int, int]]] = {n: [] for n in demand}  # length: (times, sequence, offset)
        sequence = 0
        for lengths, times in patterns(demand, size):
            offset = 0
            for n in lengths:
                slots[n].append((times, sequence, offset))
                offset += n
            sequence += times
        self.first_of = np.zeros(size + 1, np.int64)
        bounds, self.rest_from = [], sequence
        position = stream = 0
        for n in sorted(demand):
            self.first_of[n], used = position, 0
            for times, s, offset in slots[n]:
                bounds.append((position + used, s, offset, n))
                used += times
            if used < demand[n]:
                bounds.append((position + used, -1, stream, n))
                stream += n * (demand[n] - used)
            position += demand[n]
        self.bound, self.sequence, self.offset, self.length = np.array(bounds or [(0, -1, 0, 0)], np.int64).T
        self.stream, self.whole = stream, stream // size * size
        ends, rest = [self.whole], stream - self.whole
        for bit in reversed(range(size.bit_length())):
            if rest >> bit & 1:
                ends.append(ends[-1] + (1 << bit))
        self.ends = np.array(ends, np.int64)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset); the sequence is -1 for left-overs, whose offset is a position in their stream."""
        at = self.first_of[length] + rank
        i = np.searchsorted(self.bound, at, "right") - 1
        nth = at - self.bound[i]
        shared = self.sequence[i] >= 0
        return np.where(shared, self.sequence[i] + nth, -1), np.where(shared, self.offset[i], self.offset[i] + nth * self.length[i])

    def cuts(self, start: int, length: int) -> list[tuple[int, int, int, int]]:
        """Of a span of the stream: (ids before it in the span, length, sequence, offset)."""
        out, at, end = [], start, start + length
        while at < end:
            if at < self.whole:
                i, first, stop = at // self.size, at // self.size * self.size, (at // self.size + 1) * self.size
            else:
                k = int(np.searchsorted(self.ends, at, "right")) - 1
                i, first, stop = self.whole // self.size + k, int(self.ends[k]), int(self.ends[k + 1])
            stop = min(stop, end)
            out.append((at - start, stop - at, self.rest_from + i, at - first))
            at = stop
        return out


# ---- over the documents ----


def digests(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str, size: int = SIZE) -> DataFrame:
    """A row for each document: ids, tail, rank of the tail among its task's tails of that length, checksums of chunks."""

    def run(batches):
        from pyspark import TaskContext

        task, ranks, chunks = TaskContext.get().partitionId(), np.zeros(size, np.int64), 0
        for b in batches:
            for i, j, texts in runs(b.column(1)):
                ids, counts = encoder(path).encode(texts)
                ids = np.insert(ids.astype("<u4"), np.cumsum(counts), end_id)
                counts = counts + 1
                data, at, rows = memoryview(ids).cast("B"), 0, []
                for n in counts.tolist():
                    tail = n % size
                    crc = [zlib.crc32(data[4 * c : 4 * min(c + size, at + n)]) for c in range(at, at + n, size)]
                    rows.append((n, tail, int(ranks[tail]), chunks, crc))
                    ranks[tail] += 1
                    chunks += n // size
                    at += n
                n, tail, rank, chunk, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * (j - i), pa.int32()), b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(tail, pa.int32()), pa.array(rank, pa.int64()), pa.array(chunk, pa.int64()), pa.array(crc, pa.list_(pa.int64()))],
                    ["task", "doc_id", "n", "tail", "rank", "chunk", "crc"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run, mapped=False), "task int, doc_id long, n long, tail int, rank long, chunk long, crc array<long>")


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The pieces: which ids of which document stand where in which sequence."""
    digest = landed(digests(docs, path, end_id, id_col, text_col, size), "digests")
    counts = digest.filter("tail > 0").groupBy("task", "tail").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("tail").orderBy("task")
    counts = landed(counts.select("task", "tail", "k", (F.sum("k").over(before) - F.col("k")).alias("before")), "ranks")
    demand = {r["tail"]: r["k"] for r in counts.groupBy("tail").agg(F.sum("k").alias("k")).collect()}  # at most size - 1 rows
    plan = Plan(demand, size)

    def assign(batches):
        for b in batches:
            doc, n, tail, rank, chunk, crc, task, first = (b.column(i).to_pylist() for i in range(8))
            tails = np.array(tail, np.int64)
            sequence, offset = plan.place(tails, np.array([r + (f or 0) for r, f in zip(rank, first, strict=True)], np.int64))
            out = []
            for i, d in enumerate(doc):
                whole = n[i] // size
                for c in range(whole):
                    out.append((d, c * size, size, crc[i][c], n[i], (task[i] << 33) + chunk[i] + c, 0, None))
                if not tail[i]:
                    continue
                if sequence[i] >= 0:
                    out.append((d, whole * size, tail[i], crc[i][-1], n[i], SHARED + int(sequence[i]), int(offset[i]), None))
                    continue
                parts = plan.cuts(int(offset[i]), tail[i])
                for at, length, s, o in parts:
                    known = crc[i][-1] if len(parts) == 1 else None
                    out.append((d, whole * size + at, length, known, n[i], SHARED + s, o, None if known is not None else crc[i][-1]))
            columns = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [*(f.split()[0] for f in PIECE.split(", ")), "tail_crc"])

    placed = digest.join(counts.select("task", "tail", "before"), ["task", "tail"], "left")
    placed = placed.select("doc_id", "n", "tail", "rank", "chunk", "crc", "task", "before")
    pieces = landed(placed.mapInArrow(lean(assign, mapped=False), PIECE + ", tail_crc long"), "pieces")

    # Cut tails: their documents are encoded again, for the checksums of the parts.
    cut = pieces.filter("ids_crc32 is null")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = cut.select(F.struct("doc_id").alias("key")).distinct()  # in a struct, a null id is a key like others
    texts = keyed_filter(texts.withColumn("key", F.struct("doc_id")), ids, ["key"], "left_semi").select("key", "text").dropDuplicates(["key", "text"])

    def again(batches):
        for b in batches:
            rows, out = b.drop_columns(["text"]).to_pylist(), []
            for i, j, texts in runs(b.column("text")):
                ids, counts = encoder(path).encode(texts)
                ends = np.cumsum(counts)
                for k in range(i, j):
                    own = np.append(ids[ends[k - i] - counts[k - i] : ends[k - i]].astype("<u4"), np.uint32(end_id))
                    r = rows[k]
                    if len(own) == r["doc_tokens"] and zlib.crc32(own[len(own) // size * size :].tobytes()) == r["tail_crc"]:
                        crc = zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
                        out.append((r["doc_id"], r["start"], r["length"], crc, r["doc_tokens"], r["sequence_id"], r["offset"]))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in PIECE.split(", ")])

    mended = cut.withColumn("key", F.struct("doc_id")).join(texts, "key").drop("key").mapInArrow(lean(again, mapped=False), PIECE).dropDuplicates(["sequence_id", "offset"])
    return pieces.filter("ids_crc32 is not null").drop("tail_crc").unionByName(mended)
