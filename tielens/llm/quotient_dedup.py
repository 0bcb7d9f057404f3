"""Exact dedup: counting quotient filters find repeated fingerprints, byte comparison decides.

Each task folds the 64-bit fingerprints of its normalised texts into counting quotient filters, one for each shard (the
highest bits; there are shards in proportion to the rows). A fingerprint's next bits, its quotient, name a slot; the other
bits, its remainder, stand in the first free slot from there on, the runs of quotients in order. Three bits a slot give
the quotients back, so no bit is lost and filters merge by merging sorted remainders. Only texts whose fingerprint has a merged count above one are compared byte by
byte. Texts are equal when identical after deleting the characters of ``[\\x20\\x09-\\x0D]``.

Defined results: a null text is empty; all empty texts are equal. Of equal texts the one with most code points in its
original stays, then the smallest id (a null id counts as the smallest); of rows that agree in both, exactly one
stays. Ids are long integers; other ids must be mapped to such first. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import landed
from .common import grouped_join, keyed_filter, lean, unused

SPACES = " \t\n\x0b\x0c\r"
#: Fingerprints in a shard, on average, and in a task's filters before they are passed on.
SHARD_ROWS, TASK_ROWS = 1 << 18, 1 << 22
LOAD = 0.75


class QuotientFilter:
    """Counting quotient filter over the 64-bit fingerprints of a shard: those with ``prefix`` as their first bits.

    Per slot: a remainder, a counter (0: free, 255: see ``large``) and three bits. ``occupied``: some fingerprint has this
    slot's quotient; ``continuation``: the remainder belongs to the run of the slot before; ``shifted``: it isn't in the
    slot of its quotient.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, prefix_bits: int):
        """Of ascending distinct fingerprints."""
        n = len(fingerprints)
        self.prefix_bits, self.bits = prefix_bits, max(1, int(np.ceil(np.log2(max(n, 1) / LOAD))))
        self.prefix = int(fingerprints[0] >> np.uint64(64 - prefix_bits)) if n and prefix_bits else 0
        width = 64 - prefix_bits - self.bits  # of remainders
        quotient = (fingerprints >> np.uint64(width) & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        order = np.arange(n)
        slot = order + np.maximum.accumulate(quotient - order) if n else order
        size = max(1 << self.bits, int(slot[-1]) + 1 if n else 0)
        self.occupied, self.continuation, self.shifted = (np.zeros(size, bool) for _ in range(3))
        self.remainder, self.counter = np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        self.occupied[quotient] = True
        self.continuation[slot[1:]] = quotient[1:] == quotient[:-1]
        self.shifted[slot] = slot != quotient
        self.remainder[slot] = fingerprints & np.uint64((1 << width) - 1)
        self.counter[slot] = np.minimum(counts, 255)
        self.large = counts[counts >= 255].astype(np.int64)

    @classmethod
    def of(cls, fingerprints: np.ndarray, prefix_bits: int) -> QuotientFilter:
        return cls(*np.unique(fingerprints, return_counts=True), prefix_bits)

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """Their sum; a stable sort of concatenated sorted runs is a merge."""
        parts = [f.items() for f in filters]
        fp, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.argsort(fp, kind="stable")
        fp, n = fp[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
        return cls(fp[first], np.add.reduceat(n, first), filters[0].prefix_bits)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints, ascending, and counts."""
        slot = np.flatnonzero(self.counter)
        run = np.cumsum(~self.continuation[slot]) - 1  # the k-th run is that of the k-th occupied quotient
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        width = 64 - self.prefix_bits - self.bits
        high = np.uint64((self.prefix << self.bits) & (2**64 - 1)) | quotient
        counts = self.counter[slot].astype(np.int64)
        counts[counts == 255] = self.large
        return high << np.uint64(width) | self.remainder[slot], counts

    def to_bytes(self) -> bytes:
        slot = np.flatnonzero(self.counter)
        wide = -(-(64 - self.prefix_bits - self.bits) // 8)  # bytes of a remainder
        head = struct.pack("<iiQqqq", self.prefix_bits, self.bits, self.prefix, len(self.counter), len(slot), len(self.large))
        planes = np.packbits(np.stack([self.occupied, self.continuation, self.shifted, self.counter > 0]), axis=1)
        rest = np.ascontiguousarray(self.remainder[slot].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide])
        return b"".join([head, planes.tobytes(), rest.tobytes(), self.counter[slot].tobytes(), self.large.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, blob: bytes) -> QuotientFilter:
        self = cls.__new__(cls)
        self.prefix_bits, self.bits, self.prefix, size, n, large = struct.unpack_from("<iiQqqq", blob)
        at, row = struct.calcsize("<iiQqqq"), -(-size // 8)
        planes = np.unpackbits(np.frombuffer(blob, np.uint8, 4 * row, at).reshape(4, row), axis=1, count=size).astype(bool)
        self.occupied, self.continuation, self.shifted, used = planes
        at, wide, slot = at + 4 * row, -(-(64 - self.prefix_bits - self.bits) // 8), np.flatnonzero(used)
        rest = np.zeros((n, 8), np.uint8)
        rest[:, :wide] = np.frombuffer(blob, np.uint8, n * wide, at).reshape(n, wide)
        self.remainder, self.counter = np.zeros(size, np.uint64), np.zeros(size, np.uint8)
        self.remainder[slot] = rest.view("<u8").ravel()
        self.counter[slot] = np.frombuffer(blob, np.uint8, n, at + n * wide)
        self.large = np.frombuffer(blob, "<i8", large, at + n * wide + n)
        return self


def shard_bits_of(rows: int) -> int:
    """Bits of the fingerprint that name its shard: shards grow with the table."""
    return max(5, (rows // SHARD_ROWS).bit_length())


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """Of ``prints(fp long)``, about ``rows`` of them: (fp, n) for each that occurs more than once."""
    shard_bits = shard_bits_of(rows)

    def passed_on(held):
        fp = np.concatenate(held)
        shard = fp >> np.uint64(64 - shard_bits)
        order = np.argsort(shard, kind="stable")
        fp, edges = fp[order], np.flatnonzero(np.diff(shard[order], prepend=np.uint64(2**64 - 1), append=np.uint64(2**64 - 1)))
        made = [(int(shard[order[a]]), QuotientFilter.of(fp[a:b], shard_bits).to_bytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.binary())], ["shard", "filter"])

    def build(batches):
        held, size = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            size += b.num_rows
            if size >= TASK_ROWS:
                yield passed_on(held)
                held, size = [], 0
        if size:
            yield passed_on(held)

    def merge(table):
        fp, n = QuotientFilter.merge([QuotientFilter.from_bytes(x) for x in table["filter"].to_pylist()]).items()
        return pa.table({"fp": fp[n > 1].view(np.int64), "n": n[n > 1]})

    return prints.select("fp").mapInArrow(lean(build), "shard int, filter binary").groupBy("shard").applyInArrow(lean(merge), "fp long, n long")


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``fingerprint`` maps the normalised text to a long; a weak one costs time, never a right answer.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, SPACES, "")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).alias("chars"), norm.alias("norm"))
    base = base.withColumn("fp", fingerprint("norm").cast("long"))
    digest = landed(base.select("doc_id", "chars", "fp", F.sha2("norm", 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "prints")
    total = digest.count()
    again = landed(repeated_fingerprints(digest, total).select("fp"), "repeated")

    # Byte verification: equal texts meet in one hash aggregation, which folds copies within each task first.
    routed = keyed_filter(base, again, ["fp"], "left_semi")
    same = routed.groupBy("fp", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("chars").alias("most"))
    same = same.select("fp", F.sha2("norm", 256).alias("sha"), "group_size", "most")
    classes = landed(same.groupBy("fp", "sha").agg(F.max("group_size").alias("group_size"), F.max("most").alias("most"), F.count(F.lit(1)).alias("texts")), "classes")
    classes = classes.filter(F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a fingerprint and a SHA-256"))).otherwise(F.lit(True)))
    classes = classes.select("fp", "sha", "group_size", "most").filter("group_size > 1")

    longest = grouped_join(digest, classes, ["fp", "sha"], "group_size", total).filter(F.col("chars") == F.col("most"))
    picks = longest.groupBy("fp", "sha", "doc_id").agg(F.min("row").alias("row"), F.max("group_size").alias("group_size"))
    picks = picks.groupBy("fp", "sha").agg(F.min(F.struct("doc_id", "row")).alias("pick"), F.max("group_size").alias("group_size"))
    picks = landed(picks.select("fp", "sha", "group_size", F.lit(True).alias("grouped"), F.col("pick.doc_id").alias("pick_id"), F.col("pick.row").alias("pick_row")), "picks")
    joined = grouped_join(digest, picks, ["fp", "sha"], "group_size", total)
    alone = F.col("grouped").isNull()
    return joined.select(
        F.col("doc_id").alias(id_col),
        F.when(alone, F.col("doc_id")).otherwise(F.col("pick_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("pick_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are copies; columns unchanged."""
    key, sha, chars = (unused(docs, x) for x in ("key", "sha", "chars"))
    found = landed(find_copies(docs, id_col, text_col).select(F.col(id_col).alias(key), F.col("text_sha256").alias(sha), "kept"), "found")
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumns({key: F.col(id_col).cast("long"), sha: F.sha2(F.translate(text, SPACES, ""), 256)})
    groups = found.groupBy(key, sha).agg(F.count_if("kept").alias("stay"), F.count(F.lit(1)).alias("n"))
    dropped = landed(groups.filter(F.col(key).isNotNull() & (F.col("stay") == 0)).select(key, sha), "dropped")
    twins = groups.filter((F.col("n") > 1) & (F.col("stay") > 0) | F.col(key).isNull() & (F.col("n") > F.col("stay")))
    out = keyed_filter(marked, dropped, [key, sha], "left_anti")
    if not twins.isEmpty():  # the same id with the same text several times, or no id: the longest original of each stays
        out = out.withColumn(chars, F.length(text))

        def longest(rows: DataFrame, on: list[str]) -> DataFrame:
            most = rows.groupBy(*on).agg(F.max(chars).alias(chars))
            return rows.join(most, [*on, chars], "left_semi").dropDuplicates(on)

        gone = groups.filter(F.col(key).isNull() & (F.col("stay") == 0)).select(sha)
        spare = longest(out.filter(F.col(key).isNull()), [sha]).join(gone, [sha], "left_anti")
        out = longest(out.filter(F.col(key).isNotNull()), [key, sha]).unionByName(spare)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
