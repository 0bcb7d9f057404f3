"""LM scoring by prediction by partial matching (PPM) over byte contexts, with a word-unigram base score beside it.

The text model reads a text's A-Z-lowered words, joined by single spaces and closed by an end symbol. Training counts
(context, symbol) pairs of ``ORDER`` bytes of context over all training documents; a shorter context's count of a symbol
is the number of next longer contexts that saw it (update exclusion), so the trie of all orders follows from the
deepest level. A symbol is predicted from its longest seen context with its count less ``DISCOUNT``; an escape, with
what was taken off there, leads to the next shorter context, in which the symbols of the longer one are excluded;
behind order 0 all remaining bytes are equally likely. The trie is
pretrained and fixed, so each pair has one code length, and texts are scored by table look-ups over whole buffers.

All pairs of all orders are kept, whatever the size of the corpus. They lie in shards by the last ``SUFFIX`` bytes of the
context, so a shard holds the subtrees of its suffixes from order ``SUFFIX`` on; the levels above, of at most 256 **
SUFFIX pairs, go to every shard's task. The deepest pairs that make up at least one in COMMON_PAIRS of all symbols (fewer
than COMMON_PAIRS of them) go to all tasks with their code lengths; the other occurrences, seen or not, travel to the shards.

The base score adds log10((c + 0.5) / (N + 0.5 (V + 1))) over words and end. Counts of words are kept in shards by
hash. The words that make up at least one in COMMON of all tokens (fewer than COMMON of them) go to all tasks; the
others' occurrences travel to the shards, so no task or driver holds the vocabulary.

Defined results: null and empty texts have one token, the end. Repeated rows are scored one by one. Without training
documents every byte has probability 1/256 and the base's N and V are 0. An empty table gives an empty result. Other
columns are ignored; whole texts are read.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import landed
from .common import lean, runs, word_hashes
from .jaccard_join import _pack, _unpack

ORDER = 6
#: Bytes of context that decide the shard of a pair.
SUFFIX = 3
COMMON_PAIRS = 1 << 21
#: Taken off every count and given to the escape.
DISCOUNT = 0.3
COMMON = 1 << 17
END = b"\n"
#: Kind of a document's own row; 0 are pairs, 1 words.
DOCUMENT = 2
END_WORD = np.uint64(0)
_PAD = END * 7


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of every text the 8 bytes that end with it (the symbol on top), and the symbols of each text."""
    normal = [b" ".join(t.lower().split()) + END for t in texts]
    joined = _PAD + _PAD.join(normal)
    sizes = np.fromiter(map(len, normal), np.int64, len(normal))
    grams = np.empty(len(joined) - 7, np.uint64)
    for i in range(8):
        grams[i::8] = np.frombuffer(joined, "<u8", (len(joined) - i) // 8, i)[: len(grams[i::8])]
    keep = np.ones(len(grams), bool)
    ends = np.cumsum(sizes + 7) - 7  # where a text's symbols end and the next padding's begin
    gaps = (ends[:-1, None] + np.arange(7)).ravel()
    keep[gaps] = False
    return grams[keep], sizes


def at_order(grams: np.ndarray, order: int) -> np.ndarray:
    """(context, symbol) of ``order`` bytes of context as one integer: the symbol on top of the context."""
    return grams >> np.uint64(8 * (7 - order))


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _shrunk(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences, counts in the smallest integers that hold them."""
    steps = np.diff(keys, prepend=np.uint64(0))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max(initial=0) <= np.iinfo(t).max)
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).ravel(), counts.astype(kind))


def _grown(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes, counts = _unpack(blob)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % shards


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """The last bytes of the contexts of pairs of that order."""
    n = min(SUFFIX, order)
    return keys >> np.uint64(8 * (order - n)) & np.uint64((1 << 8 * n) - 1)


class Table:
    """Values of keys by open addressing."""

    def __init__(self, k: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(k)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots, self.values = np.full(1 << bits, np.uint64(2**64 - 1)), np.zeros(1 << bits, np.float32)
        at, rest = self._slot(k), np.arange(len(k))
        while len(rest):
            free = self.slots[at] == np.uint64(2**64 - 1)
            self.slots[at[free]] = k[rest[free]]  # of several, the last one stays
            won = self.slots[at] == k[rest]
            self.values[at[won]] = values[rest[won]]
            at, rest = (at[~won] + 1) & (len(self.slots) - 1), rest[~won]

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return (k * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key, 0 where there is none, and the places of those."""
        out = np.zeros(len(k))
        at, rest = self._slot(k), np.arange(len(k))
        missed = []
        while len(rest):
            slot = self.slots[at]
            hit = slot == k[rest]
            out[rest[hit]] = self.values[at[hit]]
            gone = slot == np.uint64(2**64 - 1)
            missed.append(rest[gone])
            go = ~(hit | gone)
            at, rest = (at[go] + 1) & (len(self.slots) - 1), rest[go]
        return out, np.concatenate([np.empty(0, np.int64), *missed])


_tables: dict[str, Table] = {}


def _table_of(name: str, keys: np.ndarray, values: np.ndarray) -> Table:
    """The table of common pairs, built once in each worker process."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = Table(keys, values)
    return _tables[name]


def _tops(keys: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of pairs in their own context, from all pairs of the contexts."""
    n = counts - DISCOUNT
    own, which = np.unique(keys & np.uint64((1 << 8 * order) - 1), return_inverse=True)
    return np.log10(n) - np.log10(np.bincount(which, n, len(own)) + DISCOUNT * np.bincount(which, minlength=len(own)))[which]


class Model:
    """A pretrained trie as sorted arrays: pairs and contexts of each order.

    Of a shard's pairs, with ``above``: the pairs and counts of the whole corpus at the level above the suffix.
    """

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray, above: tuple[np.ndarray, np.ndarray] | None = None):
        self.order = order
        self.pairs: list = [None] * (order + 1)  # (key, log10 n, log10 probability at the top)
        self.contexts: list = [None] * (order + 1)  # (context, log10 escape at the top, log10 of the parent's mass, log10 escape there)
        level = {order: (keys, counts.astype(np.float64))}
        for j in range(order - 1, -1, -1):
            up, _ = level[j + 1]
            level[j] = _sum_by_key(up >> np.uint64(8), np.ones(len(up)))
            if above is not None and j == min(SUFFIX, order) - 1:
                level[j] = above[0], above[1].astype(np.float64)
        stats = {}
        level = {j: (k, n - DISCOUNT) for j, (k, n) in level.items()}
        for j in range(order + 1):
            k, n = level[j]
            context = k & np.uint64((1 << 8 * j) - 1)
            own, which = np.unique(context, return_inverse=True)
            total, distinct = np.bincount(which, n, len(own)), DISCOUNT * np.bincount(which, minlength=len(own))
            stats[j] = (own, total, distinct)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.pairs[j] = (k, np.log10(n), np.log10(n) - np.log10(total + distinct)[which])
                top = np.log10(distinct / (total + distinct))
                mass, escape = np.zeros(len(own)), np.zeros(len(own))
                if j:
                    parents, ptotal, pdistinct = stats[j - 1]
                    lower, ln = level[j - 1]
                    place = np.searchsorted(parents, own >> np.uint64(8))
                    seen = ln[np.searchsorted(lower, k >> np.uint64(8))]
                    left = pdistinct[place] - distinct
                    a = ptotal[place] - np.bincount(which, seen, len(own)) + left
                    mass, escape = np.log10(a), np.where(left > 0, np.log10(left) - np.log10(a), 0.0)
                self.contexts[j] = (own, top, mass, escape)
        self.alphabet = len(self.pairs[0][0])
        k, _, p = self.pairs[order]
        self.deepest, self.pairs[order] = Table(k, p), None

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol."""
        out, rest = self.deepest.find(at_order(grams, self.order))
        if len(rest):
            out[rest] = self._escaped(grams[rest])
        return out

    def _escaped(self, grams: np.ndarray) -> np.ndarray:
        """Of symbols that their full context hasn't seen."""
        out = np.zeros(len(grams))
        rest = np.arange(len(grams))
        mass, escape, excluded = np.zeros(len(grams)), np.zeros(len(grams)), np.zeros(len(grams), bool)
        for j in range(self.order, -1, -1):
            k = at_order(grams[rest], j)
            if j < self.order:
                keys, n, top = self.pairs[j]
                i = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
                hit = keys[i] == k if len(keys) else np.zeros(len(k), bool)
                out[rest[hit]] += np.where(excluded[hit], n[i[hit]] - mass[hit], top[i[hit]])
                rest, k, mass, escape, excluded = rest[~hit], k[~hit], mass[~hit], escape[~hit], excluded[~hit]
            own, top, m, e = self.contexts[j]
            if not len(own):
                continue
            c = k & np.uint64((1 << 8 * j) - 1)
            i = np.minimum(np.searchsorted(own, c), len(own) - 1)
            seen = own[i] == c
            out[rest[seen]] += np.where(excluded[seen], escape[seen], top[i[seen]])
            mass[seen], escape[seen], excluded[seen] = m[i[seen]], e[i[seen]], True
        out[rest] -= math.log10(256 - self.alphabet)
        return out


# ---- counting ----


def _counted(docs: DataFrame, shards: int, order: int) -> DataFrame:
    """(kind, shard, blob): counts of contexts (kind 0) and words (kind 1) of ``docs(text)``, a blob for each task and shard."""

    def emit(held):
        for kind, parts in enumerate(held):
            keys, n = _sum_by_key(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
            shard = _shard(keys if kind else _suffix(keys, order), shards)
            place = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[place], np.arange(shards + 1))
            blobs = [(s, _shrunk(keys[place[a:b]], n[place[a:b]])) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
            if blobs:
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(blobs), pa.int32()), pa.array([s for s, _ in blobs], pa.int32()), pa.array([b for _, b in blobs], pa.binary())], ["kind", "shard", "blob"])

    def run(batches):
        held: tuple[list, list] = ([], [])
        for b in batches:
            for _, _, texts in runs(b.column(0)):
                found = (at_order(symbols(texts)[0], order), word_hashes(texts)[0])
                for parts, keys in zip(held, found, strict=True):
                    parts.append(np.unique(keys, return_counts=True))
                    if len(parts) > 4:
                        parts[:] = [_sum_by_key(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                if any(len(parts[0][0]) > 1_500_000 for parts in held):  # when both hold this run
                    yield from emit(held)
                    held = ([], [])
        yield from emit(held)

    return docs.mapInArrow(lean(run), "kind int, shard int, blob binary")


def _merge(table):
    parts = [_grown(b) for b in table["blob"].to_pylist()]
    keys, n = _sum_by_key(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
    return pa.table({"kind": table["kind"][:1], "shard": table["shard"][:1], "blob": pa.array([_shrunk(keys, n)], pa.binary()), "pairs": pa.array([len(keys)], pa.int64()), "n": pa.array([int(n.sum())], pa.int64())})


MERGED = "kind int, shard int, blob binary, pairs long, n long"


def _above(pairs: DataFrame, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of the level above the suffix, from merged counts of pairs."""
    n = min(SUFFIX, order)

    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                keys = np.unique(_grown(blob)[0] >> np.uint64(8 * (order - n)))  # each in one shard only
                keys, c = np.unique(keys >> np.uint64(8), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(c.astype(np.int64))], ["key", "c"])

    got = pairs.select("blob").mapInArrow(lean(run), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).toArrow()  # at most 256 ** SUFFIX
    key, c = got["key"].to_numpy().view(np.uint64), got["c"].to_numpy()
    at = np.argsort(key)
    return key[at], c[at]


def _common(pairs: DataFrame, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The common pairs and their log10 probabilities."""
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = COMMON_PAIRS

    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                keys, c = _grown(blob)
                big = c * share >= total
                yield pa.RecordBatch.from_arrays([pa.array(keys[big].view(np.int64)), pa.array(_tops(keys, c, order)[big].astype(np.float32))], ["key", "value"])

    got = pairs.select("blob").mapInArrow(lean(run), "key long, value float").toArrow()  # at most COMMON_PAIRS, 12 bytes each
    return got["key"].to_numpy().view(np.uint64), got["value"].to_numpy()


# ---- scoring ----


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each document.

    ``most``, if a caller asks for a smaller model: the order is lowered until the deepest level has at most so many pairs.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    shards = 1 << max(5, (docs.count() // 20_000).bit_length())
    train = rows.filter(~F.col("held_out"))
    order = ORDER
    while True:
        merged = landed(_counted(train.select("text"), shards, order).groupBy("kind", "shard").applyInArrow(lean(_merge), MERGED), "counts")
        pairs = merged.filter("kind = 0")
        if most is None or order == 1 or (pairs.agg(F.sum("pairs")).first()[0] or 0) <= most:
            break
        order -= 1
    name = uuid.uuid4().hex
    common_pairs = spark.sparkContext.broadcast(_common(pairs, order))
    above = spark.sparkContext.broadcast(_above(pairs, order))
    words = merged.filter("kind = 1")
    ends = train.count()
    n, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))).first()
    n, distinct = n + ends, distinct + (ends > 0)  # the end is a token like others
    norm = math.log10(n + 0.5 * (distinct + 1))

    def frequent(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                keys, c = _grown(blob)
                big = c * COMMON >= n
                yield pa.RecordBatch.from_arrays([pa.array(keys[big].view(np.int64)), pa.array(c[big])], ["key", "c"])

    common = words.select("blob").mapInArrow(lean(frequent), "key long, c long").toArrow()  # at most COMMON words
    key, c = common["key"].to_numpy().view(np.uint64), common["c"].to_numpy()
    at = np.argsort(key)
    known_words = spark.sparkContext.broadcast((key[at], np.log10(c[at] + 0.5) - norm))  # word by word, as long sums of the two parts cancel
    end_value = math.log10(ends + 0.5) - norm

    def run(batches):
        from pyspark import TaskContext

        ref = TaskContext.get().partitionId() << 33
        keys, values = known_words.value
        table = _table_of(name, *common_pairs.value)

        def blobs_of(kind, rare, owner):
            """(kind, shard, distinct keys, their counts, owners of all) of what travels."""
            place = np.argsort(rare, kind="stable")
            rare, owner = rare[place], owner[place].astype(np.uint32)
            shard = _shard(rare if kind else _suffix(rare, order), shards)
            place = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[place], np.arange(shards + 1))
            for s, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if y > x:
                    part = rare[place[x:y]]
                    own = np.ascontiguousarray(owner[place[x:y]].view(np.uint8).reshape(-1, 4).T).ravel()
                    yield kind, s, _pack(*_unpack(_shrunk(*_sum_by_key(part, np.ones(y - x, np.int64)))), own, np.array([ref], np.int64))

        for b in batches:
            for i, j, texts in runs(b.column(2)):
                k = j - i
                grams, sizes = symbols(texts)
                points, missed = table.find(at_order(grams, order))
                total = np.add.reduceat(points, np.cumsum(sizes) - sizes)
                missed = np.sort(missed)
                blobs = list(blobs_of(0, at_order(grams[missed], order), np.searchsorted(np.cumsum(sizes), missed, "right")))
                h, counts = word_hashes(texts)
                of = np.repeat(np.arange(j - i), counts)
                where = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[where] == h if len(keys) else np.zeros(len(h), bool)
                base = np.bincount(of[hit], values[where[hit]], j - i)
                known = np.bincount(of[hit], minlength=j - i)
                blobs += blobs_of(1, h[~hit], of[~hit])
                m = len(blobs)
                none = lambda kind: pa.nulls(m, kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([DOCUMENT] * k + [x for x, _, _ in blobs], pa.int32()),
                        pa.array([*range(k)] + [x for _, x, _ in blobs], pa.int32()),
                        pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array([x for _, _, x in blobs], pa.binary())]),
                        pa.concat_arrays([pa.array(ref + np.arange(k), pa.int64()), none(pa.int64())]),
                        pa.concat_arrays([b.column(0).slice(i, k), none(pa.int64())]),
                        pa.concat_arrays([b.column(1).slice(i, k), none(pa.bool_())]),
                        pa.concat_arrays([pa.array(counts + 1, pa.int64()), none(pa.int64())]),
                        pa.concat_arrays([pa.array(known.astype(np.int64)), none(pa.int64())]),
                        pa.concat_arrays([pa.array(base.astype(np.float64)), none(pa.float64())]),
                        pa.concat_arrays([pa.array(total.astype(np.float64)), none(pa.float64())]),
                    ],
                    ["kind", "shard", "blob", "ref", "doc_id", "held_out", "n_tokens", "known", "base", "score"],
                )
                ref += k

    fields = "ref long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"
    scored = rows.mapInArrow(lean(run), f"kind int, shard int, blob binary, {fields}").withColumn("shard", F.pmod("shard", F.lit(shards)))

    def look_up(left, right):
        if left.num_rows and left["kind"][0].as_py() == DOCUMENT:
            return left.drop_columns(["kind", "shard", "blob"])
        keys, c = _grown(right["blob"][0].as_py()) if right.num_rows else (np.empty(0, np.uint64), np.empty(0, np.int64))
        kind = left["kind"][0].as_py() if left.num_rows else None
        model = Model(order, keys, c, above.value) if kind == 0 else None
        parts = []
        for blob in left["blob"].to_pylist():
            planes, counts, owner, first = _unpack(blob)
            owner = np.ascontiguousarray(owner.reshape(4, -1).T).view(np.uint32).ravel()
            h = np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)
            if model is not None:
                value, hit = model.log10(h << np.uint64(8 * (7 - order))), np.zeros(len(h), bool)
            else:
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                value = (np.where(hit, np.log10(c[at] + 0.5), math.log10(0.5)) if len(keys) else np.full(len(h), math.log10(0.5))) - norm
            n = int(owner.max()) + 1
            value, hit = (np.bincount(owner, np.repeat(x, counts), n) for x in (value, hit))
            own = np.flatnonzero(np.bincount(owner, minlength=n))
            none = np.zeros(len(own))
            parts.append((first[0] + own, none if kind == 0 else value[own], hit[own].astype(np.int64), value[own] if kind == 0 else none))
        ref, more, known, points = (np.concatenate([np.empty(0, t), *(p[i] for p in parts)]) for i, t in enumerate((np.int64, np.float64, np.int64, np.float64)))
        none = lambda kind: pa.nulls(len(ref), kind)
        return pa.table({"ref": ref, "doc_id": none(pa.int64()), "held_out": none(pa.bool_()), "n_tokens": none(pa.int64()), "known": known, "base": more, "score": points})

    # documents and what travels for them pass one exchange; a document's row and its parts meet by ref
    met = scored.groupBy("kind", "shard").cogroup(merged.select("kind", "shard", "blob").groupBy("kind", "shard")).applyInArrow(lean(look_up), fields)
    out = met.groupBy("ref").agg(*(F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens")), *(F.sum(x).alias(x) for x in ("known", "base", "score")))
    return out.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end_value)).alias("base_score"),
        "score",
    )
