"""What the operators of this package share: tables in the shared folder, size-checked joins, word hashing."""

from __future__ import annotations

import functools
import hashlib
import inspect

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids that may be broadcast (8 MB of keys); beyond that the join is shuffled.
BROADCAST_ROWS = 1_000_000


def keyed_filter(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` semi- or anti-joined with landed ``keys``: broadcast after counting them, a shuffled hash join beyond."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), on, how)
    return rows.join(keys.hint("SHUFFLE_HASH"), on, how)


#: A key with more than 1/HEAVY of all rows is heavy; there are fewer than HEAVY such keys.
HEAVY = 4096


def grouped_join(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per key in ``groups`` (``size``: its row count).

    Fewer than HEAVY keys can each hold more than total/HEAVY rows; these are broadcast, so that no task
    gets all rows of a hot key. The others meet in a shuffled join.
    """
    heavy = groups.filter(F.col(size) * HEAVY > F.lit(total))
    light = groups.filter(F.col(size) * HEAVY <= F.lit(total))
    hot = rows.join(F.broadcast(heavy), on, "inner")
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on, "left")
    return hot.unionByName(rest)


def unused(rows: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``rows`` has."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---- Python workers ----


def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None  # another C library


@functools.cache
def _thrifty() -> None:
    """Once in each worker process: large blocks are mapped, so that they go back when freed; few arenas."""
    import pyarrow as pa

    pa.set_memory_pool(pa.system_memory_pool())
    if libc := _libc():
        for option, value in ((-3, 2 << 20), (-1, 16 << 20), (-8, 2)):  # M_MMAP_THRESHOLD, M_TRIM_THRESHOLD, M_ARENA_MAX
            libc.mallopt(option, value)


def _trim() -> None:
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def lean(run, mapped: bool = True):
    """A function of batches, of a table or of two, after which a worker's free memory goes back: workers live on.

    ``mapped``: large blocks are mapped, which holds the peak down for some more CPU time.
    """

    def of_batches(batches):
        if mapped:
            _thrifty()
        try:
            yield from run(batches)
        finally:
            _trim()

    def of_table(table):
        if mapped:
            _thrifty()
        try:
            return run(table)
        finally:
            _trim()

    def of_tables(left, right):
        if mapped:
            _thrifty()
        try:
            return run(left, right)
        finally:
            _trim()

    if inspect.isgeneratorfunction(run):
        return of_batches
    return of_table if len(inspect.signature(run).parameters) == 1 else of_tables


# ---- words and their hashes, over whole Arrow buffers ----

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes of the longest word that the polynomial hashes; from some hundreds on, patterns such as Thue-Morse's collide modulo 2**64.
_LONG = 128
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the A-Z-lowered words of all texts, in order, and the number of words of each text.

    Words are runs of bytes outside 0x20 and 0x09-0x0D.
    """
    buf = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends_of = np.cumsum(lens)
    space = _SPACE[buf]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    up, down = _power(len(buf))
    total = np.cumsum(_BYTE[buf] * up)
    head = np.where(starts > 0, total[starts - 1], np.uint64(0))
    h = (total[ends - 1] - head) * down[starts]
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], ends_of))))
    h = mix(h ^ (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > _LONG):
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return h, counts


def runs(column, most: int = 1 << 20):
    """Of an Arrow string column: (first, last, texts as UTF-8) for runs of whole texts of about ``most`` bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    first = size = 0
    for i, n in enumerate([*sizes, most]):
        if i > first and (size + n > most or i == len(sizes)):
            yield first, i, as_bytes(column.slice(first, i - first))
            first = i
            size = 0
        size += n + 1


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null is empty."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
