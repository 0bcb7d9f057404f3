"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A text region within ``k`` edits of an item of length m shares at least m - q + 1 - k*q of its q-grams, in diagonals
that differ by at most k. Three filters follow from that, each lossless: (1) windows of a text with too few q-grams
of any item fall away, by a bitmap over the whole buffer; (2) in the rest, q-grams shared with an item are counted in
overlapping diagonal bands, and bands that miss the item's bound fall away; q-grams that many items have are counted for
some items at a time, in tables of bounded size; (3) the bands left are verified by alignment of the whole item with any
part of the region, many at once, from that end of the item whose q-grams fewer items have.

Texts and items are compared as UTF-8 with A-Z lowered and white space (0x20, 0x09-0x0D) as single spaces. The edit
budget of an item of length m is ``RATE`` of it, but no more than leaves the lemma a bound: (m - q) / q. An item shorter
than ``Q`` bytes has no q-gram; it matches a text that equals it.

Defined results: null and empty texts match nothing, nor do empty items. Repeated documents give repeated rows; repeated
items count once each. Without items nothing matches. Whole texts are searched; other columns are ignored. Ids are long
integers.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, runs
from .tokens import spread

Q, RATE = 8, 0.08
#: Bytes of items that one pass holds; a larger benchmark is searched for in several passes.
PASS_BYTES = 8 << 20
#: Shared q-grams that are counted, and table cells of alignments that are held, at a time (bounds memory, changes no result).
MOST_PAIRS, MOST_CELLS = 4_000_000, 400_000
_BITS = 23
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def grams(buf: bytes) -> np.ndarray:
    """The 8 bytes at each position, as integers."""
    n = len(buf) - Q + 1
    out = np.empty(max(n, 0), np.uint64)
    for i in range(min(8, max(n, 0))):
        part = np.frombuffer(buf, "<u8", (len(buf) - i) // 8, i)
        out[i::8] = part[: len(out[i::8])]
    return out


def slot(g: np.ndarray) -> np.ndarray:
    return (g * _SPREAD >> np.uint64(64 - _BITS)).astype(np.int64)


def budget(m: int) -> int:
    """Edits allowed in an item of m bytes."""
    return min(int(RATE * m), (m - Q) // Q)


def align(letters: np.ndarray, sizes: np.ndarray, k: int, text: bytes, low: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For each item (a column of ``letters``) the least edits between it and a part of ``text`` that starts at its ``low``
    to ``low + high``, and its end.

    More than ``k`` edits are given as k + 1. Row i of a table holds text positions low - k + i to low + high + k + i, a band
    of diagonals; the tables of all items are filled together, and those without a way left are dropped.
    """
    width, longest = high + 2 * k + 1, int(sizes.max())
    kind = np.int16 if longest + width < 30_000 else np.int32
    first = low - k
    begin, end = int(first.min()), int(first.max()) + longest + width
    src = np.full(end - begin, 256, np.int16)  # no letter before and behind the text
    x, y = min(max(begin, 0), len(text)), min(max(end, 0), len(text))
    src[x - begin : y - begin] = np.frombuffer(text, np.uint8, y - x, x)
    steps = np.arange(width)
    at = first - begin
    there = first[:, None] + steps
    row = np.where((there >= 0) & (there <= len(text)), 0, k + 1).astype(kind)  # the item may start anywhere
    views = np.lib.stride_tricks.sliding_window_view(src, width)
    edits, ends = np.full(len(sizes), k + 1), np.zeros(len(sizes), np.int64)
    live, slope = np.arange(len(sizes)), steps.astype(kind)
    for i in range(longest):
        new = row + (views[at + i] != letters[i, live][:, None])  # same diagonal
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + kind(1))  # a byte of the item left out
        new -= slope
        row = np.minimum.accumulate(new, axis=1)  # bytes of the text left out
        row += slope
        least = row.min(axis=1)
        done = sizes[live] == i + 1
        if done.any():
            own = live[done]
            edits[own] = np.minimum(least[done], k + 1)
            ends[own] = first[own] + sizes[own] + row[done].argmin(axis=1)
        go = ~done & (least <= k)
        if not go.all():
            live, row, at = live[go], row[go], at[go]
            if not len(live):
                break
    return edits, ends


def columns_of(items: list[bytes]) -> np.ndarray:
    """Items as columns of their bytes."""
    letters = np.full((max(map(len, items)), len(items)), 257, np.int16)
    for i, item in enumerate(items):
        letters[: len(item), i] = np.frombuffer(item, np.uint8)
    return letters


class Index:
    """The q-grams of normalised items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.whole: dict[bytes, list[int]] = {}
        for i, (_, t) in enumerate(items):
            if 0 < len(t) < Q:
                self.whole.setdefault(t, []).append(i)
        self.all, self.items = items, [x for x in items if len(x[1]) >= Q]
        self.number = [i for i, x in enumerate(items) if len(x[1]) >= Q]
        self.k = np.array([budget(len(t)) for _, t in self.items], np.int64)
        self.m = np.array([len(t) for _, t in self.items], np.int64)
        self.bound = np.maximum(self.m - Q + 1 - self.k * Q, 1)
        parts = [grams(t) for _, t in self.items] or [np.empty(0, np.uint64)]
        of = np.repeat(np.arange(len(self.items)), [len(p) for p in parts][: len(self.items)])
        at = np.concatenate([np.arange(len(p)) for p in parts])
        g = np.concatenate(parts)
        order = np.argsort(g, kind="stable")
        self.gram, self.of, self.at = g[order], of[order], at[order]
        self.key, first = np.unique(self.gram, return_index=True)
        self.first = np.append(first, len(self.gram))
        # whether an item's second half has the rarer q-grams
        often = np.log(np.diff(self.first))[np.searchsorted(self.key, g)] if len(g) else g
        side = 2 * at < self.m[of] - Q if len(g) else of
        halves = [np.bincount(of[x], often[x], len(self.items)) / np.maximum(np.bincount(of[x], minlength=len(self.items)), 1) for x in (side, ~side)] if len(g) else [self.m, self.m]
        self.backward = halves[1] < halves[0]
        self.bitmap = np.zeros(1 << _BITS, np.int8)
        self.bitmap[slot(self.key)] = 1
        # classes of items of like length: (window, least hits in it)
        self.classes = []
        for c in np.unique(np.ceil(np.log2(self.m) * 2)) if len(self.m) else ():
            own = np.ceil(np.log2(self.m) * 2) == c
            self.classes.append((int((self.m + self.k)[own].max()), int(self.bound[own].min())))

    def windows(self, hits: np.ndarray):
        """Runs of positions, each a union of windows with enough hits for some class."""
        total = np.concatenate(([0], np.cumsum(hits, dtype=np.int32)))
        keep = np.zeros(len(hits) + 1, np.int32)
        for width, least in self.classes:
            w = min(width, len(hits))
            good = np.flatnonzero(total[w:] - total[:-w] >= least) if w else ()
            if len(good):
                keep[good] += 1
                keep[good + w] -= 1
        inside = np.cumsum(keep[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        return edges.reshape(-1, 2)

    def bands(self, text: bytes, first: int, last: int):
        """Of a normalised text between q-gram positions: (items, bands, shared q-grams) that reach the items' bounds."""
        g = grams(text[first : last + Q - 1])
        where = np.searchsorted(self.key, g)
        where[where == len(self.key)] = 0
        at = np.flatnonzero(self.key[where] == g)
        lo, n = self.first[where[at]], self.first[where[at] + 1] - self.first[where[at]]
        total = int(n.sum())
        if total < self.bound.min():
            return
        if total <= MOST_PAIRS:
            held = np.bincount(self.of[spread(lo, n)], minlength=len(self.items))
        else:
            uses = np.bincount(where[at], minlength=len(self.key))
            held = np.bincount(self.of, np.repeat(uses, np.diff(self.first)), len(self.items)).astype(np.int64)
        items = np.flatnonzero(held >= self.bound)  # the others can't reach their bounds in any band
        if not len(items):
            return
        step = self.k + 1
        lowest, highest = (first - self.m) // step - 1, last // step
        cells = highest - lowest + 1
        chosen = np.zeros(len(self.items), bool)
        number = np.cumsum(np.maximum(held, cells)[items]) // MOST_PAIRS  # some items at a time
        for items in np.split(items, np.flatnonzero(np.diff(number)) + 1):
            chosen[:] = False
            chosen[items] = True
            base = np.zeros(len(self.items), np.int64)
            base[items] = np.cumsum(cells[items]) - cells[items]
            shared = np.zeros(int(cells[items].sum()), np.int64)
            for i, j in _runs(np.cumsum(n), MOST_PAIRS):
                pair = spread(lo[i:j], n[i:j])
                keep = chosen[self.of[pair]]
                pair, place = pair[keep], np.repeat(at[i:j], n[i:j])[keep]
                item = self.of[pair]
                shared += np.bincount(base[item] + (first + place - self.at[pair]) // step[item] - lowest[item], minlength=len(shared))
            # a run of diagonals that differ by at most k lies in band b or in the overlap of b - 1 and b
            both = shared + np.append(shared[1:], 0)
            item = np.repeat(items, cells[items])
            good = np.flatnonzero((both >= self.bound[item]) & (shared > 0))  # without its first band the next one holds as many
            item = item[good]
            yield item, good - base[item] + lowest[item], both[good]

    def search(self, text: bytes, first: int, last: int) -> dict[int, tuple[int, int, int]]:
        """Items found in a normalised text between q-gram positions: item to (edits, end, shared q-grams)."""
        found: dict[int, tuple[int, int, int]] = {}
        for item, band, shared in self.bands(text, first, last):
            if not len(item):
                continue
            most = {}
            for j, n in zip(item.tolist(), shared.tolist(), strict=True):
                most[j] = max(most.get(j, 0), n)
            for j, n in most.items():
                own = self.items[j][1]
                begin = text.find(own, max(first - len(own), 0), last + Q + len(own))
                if begin >= 0:
                    found[j] = (0, begin + len(own), n)
            left = (self.k[item] > 0) & ~np.isin(item, list(found))
            for j, edits, end, n in self._verified(text, item[left], band[left] * (self.k[item[left]] + 1), shared[left]):
                if j not in found or (edits, -n, end) < (found[j][0], -found[j][2], found[j][1]):
                    found[j] = (edits, end, n)
        return found

    def _verified(self, text: bytes, item: np.ndarray, low: np.ndarray, shared: np.ndarray):
        """(item, edits, end, shared) of the candidates within their budgets; low: a band's first diagonal."""
        if not len(item):
            return
        order = np.lexsort((low, item, self.m[item], self.backward[item], self.k[item]))
        item, low, shared = item[order], low[order], shared[order]
        kind = 2 * self.k[item] + self.backward[item]
        text_back = b""
        for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(item)]):
            k, backward = int(self.k[item[a]]), bool(self.backward[item[a]])
            most = max(1, MOST_CELLS // (4 * k + 2))
            for x in range(a, b, most):
                some = slice(x, min(x + most, b))
                own, column = np.unique(item[some], return_inverse=True)
                m = self.m[item[some]]
                high = 2 * k + 1
                if not backward:
                    edits, ends = align(columns_of([self.items[j][1] for j in own])[:, column], m, k, text, low[some], high)
                else:  # the item ends at low + m to low + high + m, give or take k
                    text_back = text_back or text[::-1]
                    edits, begins = align(columns_of([self.items[j][1][::-1] for j in own])[:, column], m, k, text_back, len(text) - (low[some] + high + m) - k, high + 2 * k)
                for i in np.flatnonzero(edits <= k).tolist():
                    j = int(item[x + i])
                    if backward:  # where it ends follows from an alignment forward
                        e, stop = align(columns_of([self.items[j][1]]), self.m[[j]], k, text, np.array([len(text) - int(begins[i])]), 0)
                        yield j, int(e[0]), int(stop[0]), int(shared[x + i])
                    else:
                        yield j, int(edits[i]), int(ends[i]), int(shared[x + i])

    def hits(self, texts: list[bytes]):
        """For each text, what ``search`` finds in it. Texts are joined by a byte that no normalised item contains."""
        out: list[dict[int, tuple[int, int, int]]] = [{i: (0, len(t), 0) for i in self.whole.get(t, ())} for t in texts]
        if not self.items:
            return out
        joined = b"\n".join(texts) + b"\n" * Q
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        mask = self.bitmap[slot(grams(joined))]
        for a, b in self.windows(mask):
            i, last = np.searchsorted(begins, (a, b - 1), "right") - 1
            for d in range(i, last + 1):
                lo, hi = max(a - begins[d], 0), min(b - begins[d], len(texts[d]) - Q + 1)
                if hi > lo:
                    for j, got in self.search(texts[d], int(lo), int(hi)).items():
                        j = self.number[j]
                        if j not in out[d] or got[0] < out[d][j][0]:
                            out[d][j] = got
        return out


def _runs(ends: np.ndarray, most: int):
    """Runs of rows with about ``most`` in all, by their running total."""
    i, done = 0, 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, done + most, "right")))
        yield i, j
        i, done = j, int(ends[j - 1])


def _passes(benchmark: DataFrame, id_col: str, text_col: str):
    """Items in parts of bounded size."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = -(-size // PASS_BYTES) or 1
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == i) if n > 1 else rows
        yield Index(sorted(((r["id"], normal(r["text"].encode())) for r in part.collect()), key=lambda r: (r[1], r[0] is None, r[0] or 0)))


def _batches(column):
    for a, _, texts in runs(column):
        yield a, [normal(t) for t in texts]


FOUND = "doc_id long, item_id long, edits long, text_end long, shared_grams long, item_bytes long"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, text_end, shared_grams, item_bytes): the best match of each item in each document.

    ``text_end`` is the byte where the match ends in the normalised text.
    """
    out = None
    for index in _passes(benchmark, item_id, item_text):

        def run(batches, index=index):
            for b in batches:
                ids, rows = b.column(0).to_pylist(), []
                for a, texts in _batches(b.column(1)):
                    for d, got in enumerate(index.hits(texts)):
                        rows += [(ids[a + d], index.all[j][0], e, end, n, len(index.all[j][1])) for j, (e, end, n) in got.items()]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in FOUND.split(", ")])

        picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        part = picked.mapInArrow(lean(run, mapped=False), FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found; columns unchanged."""
    at = docs.columns.index(text_col)
    for index in _passes(benchmark, item_id, item_text):

        def run(batches, index=index):
            for b in batches:
                clean = [not got for _, texts in _batches(b.column(at)) for got in index.hits(texts)]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(lean(run, mapped=False), docs.schema)
    return docs
