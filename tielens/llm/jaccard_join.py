"""N-gram Jaccard join with token-combination prefixes.

A document's tokens are its distinct shingles of five words; documents link when their sets' Jaccard similarity is at
least NUM/DEN. Equal sets are one class, and classes stand for their documents. Tokens are in one global order: first
those of a fixed half of the hash space by (document frequency, hash), then the rest by hash. In that order two linked
sets share a token of their prefixes. Tokens that one class has alone can't be shared, so a class whose prefix is full
of them is done. For the others, each rare token of the prefix is a signature. For frequent tokens the prefix is extended
by g tokens, of which linked sets share g + 1; the tokens fall into g groups by hash, so two of the shared ones fall into
one, and the pairs within groups are the signatures. g follows from a set's size class, so a set has a few signatures for
each token of its prefix, whatever its size; sets near the border of a class take part in both.

Classes that signatures tie together are a cluster; its sets meet in blocks of bounded size and are compared there whole
(intersections of 64-bit shingle hashes), so no pairs are emitted but the links found. Clusters of one block are done
then. In a larger one its smallest class visits all blocks; only if that doesn't make it one component, the rest of it is
compared: a class whose tokens that nobody else in the cluster has leave too little to share with sets of its own size
or larger can't link with another such class, so only the others meet all, by cluster or by signature, whichever is less
work. Frequencies come from sorted postings of tasks; a token that a task sees in many classes is declared frequent
there, so no task gathers all postings of a hot token.

Defined results: null and empty texts, and texts without words, have no set, link with nothing and are their own
component. Fewer than five words make one shingle. Repeated rows are equal sets. A component's id is the smallest
document id in it (null ids don't count unless there is no other). Ids are long integers; other ids must be mapped to
such first. An empty table gives an empty result. Other columns are ignored, whatever their names; whole texts are read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import forget, landed
from .common import grouped_join, keyed_filter, lean, mix, runs, unused, word_hashes

WORDS, NUM, DEN = 5, 75, 100
#: Document frequency up to which a token is rare; sizes of a set for each group of frequent tokens.
RARE, PER_GROUP = 64, 16
#: Tokens that a task sorts at a time, about.
FLUSH = 1_000_000
#: Classes of a task from which it declares a token frequent.
LOCALLY_FREQUENT = 256
FREQUENT, BEHIND = 65535, 65536
#: Sets, and tokens of sets, that are compared with each other in one go.
BLOCK, BLOCK_TOKENS = 256, 400_000
#: Blocks of tight classes up to which all of a cluster meets them.
FEW_BLOCKS = 16
_TIMES = np.random.default_rng(5).integers(1, 2**63, WORDS + 1, dtype=np.uint64) | np.uint64(1)
_HALF = np.uint64(1 << 63)
_CUT = np.uint64(16)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    h, counts = word_hashes(texts)
    n = len(h) - WORDS + 1
    full = mix(sum((h[j : j + n] * _TIMES[j] for j in range(1, WORDS)), h[:n] * _TIMES[0])) if n > 0 else h[:0]
    at = 0
    for c in counts.tolist():
        if c >= WORDS:
            out.append(np.unique(full[at : at + c - WORDS + 1]))
        elif c:
            out.append(mix(np.sum(h[at : at + c] * _TIMES[:c], keepdims=True) + _TIMES[WORDS] * np.array([c], np.uint64)))
        else:
            out.append(h[:0])
        at += c
    return out


def sets_of(column):
    """The sets of an Arrow column's texts, a run of texts at a time."""
    for _, _, texts in runs(column):
        yield from shingle_sets(texts)


def class_of(tokens: np.ndarray) -> int:
    """A set's identity: 64 bits of its tokens in any order."""
    return int(mix(np.array([mix(tokens ^ _TIMES[0]).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def prefix_size(n: int) -> int:
    """Tokens of a set of n of which a linked set must have one."""
    return n - -(-NUM * n // DEN) + 1


def groups_of(n: int) -> int:
    """Groups of frequent tokens, by which the prefix is extended, of the size class of n."""
    return max(1, (1 << n.bit_length() - 1) // PER_GROUP)


def group_numbers(n: int) -> set[int]:
    """Those of the classes in which a set of n meets linked sets; the larger set's class counts."""
    return {groups_of(n), groups_of(n * DEN // NUM)}


def cut_size(tokens: np.ndarray) -> int:
    """Distinct tokens as postings hold them, of sorted ones."""
    cut = tokens >> _CUT
    return int((cut[1:] != cut[:-1]).sum()) + (len(cut) > 0)


def _digest(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, n, low, cls) of ``docs(doc_id, hash, text)``; low: tokens in the first half, as postings hold them."""

    def run(batches):
        for b in batches:
            found = [(len(s), cut_size(s[: np.searchsorted(s, _HALF)]), class_of(s) if len(s) else None) for s in sets_of(b.column(2))]
            n, low, cls = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(cls, pa.int64())], ["doc_id", "hash", "n", "low", "cls"])

    return docs.mapInArrow(lean(run), "doc_id long, hash long, n long, low long, cls long")


# ---- postings ----


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = struct.pack("<i", len(arrays)) + b"".join(struct.pack("<4sq", a.dtype.str.encode()[:4].ljust(4), a.nbytes) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = struct.unpack_from("<i", data)[0], 4, []
    heads = [struct.unpack_from("<4sq", data, at + 12 * i) for i in range(n)]
    at += 12 * n
    for kind, size in heads:
        kind = np.dtype(kind.strip(b" \0").decode())
        out.append(np.frombuffer(data, kind, size // kind.itemsize, at))
        at += size
    return out


def _by_class(cls: np.ndarray, token: np.ndarray, df: np.ndarray, groups: int):
    """Rows (group, blob) of postings, for the stage that reads them by class."""
    group = (cls % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((cls, group))
    cls, token, df, group = cls[order], token[order], df[order], group[order]
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own, first = np.unique(cls[a:b], return_index=True)
        yield int(group[a]), _pack(own, np.diff(np.append(first, b - a)).astype(np.uint32), (token[a:b] >> np.uint64(16)).astype(np.uint32), token[a:b].astype(np.uint16), df[a:b].astype(np.uint16))


def _postings(docs: DataFrame, buckets: int, groups: int) -> DataFrame:
    """(bucket, blob): tokens and their classes by token; bucket -1 - g: of declared frequent tokens, by class."""
    bits = np.uint64(63 - (buckets.bit_length() - 1))

    def flush(tokens, owners, classes):
        token, owner, cls = np.concatenate(tokens), np.concatenate(owners), np.array(classes, np.int64).view(np.uint64)
        order = np.argsort(token, kind="stable")
        token, owner = token[order] >> _CUT, owner[order]
        new = np.concatenate(([True], token[1:] != token[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(token)))
        hot = np.repeat(size >= LOCALLY_FREQUENT, size)
        rows = [(-1 - g, blob) for g, blob in _by_class(cls[owner[hot]], token[hot], np.full(int(hot.sum()), FREQUENT), groups)]
        marker = len(cls)  # stands for "declared frequent"
        keep = ~hot | new
        owner = np.where(hot, marker, owner)[keep]
        token = token[keep]
        bucket = ((token << _CUT) >> bits).astype(np.int64) & (buckets - 1)
        order = np.argsort(bucket, kind="stable")
        token, owner, bucket = token[order], owner[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        table = np.append(cls, np.uint64(0))
        for k in range(buckets):
            a, b = edges[k], edges[k + 1]
            if b > a:
                step = np.diff(token[a:b], prepend=np.uint64(0))  # sorted but for the two halves of the hash space
                small = step[1:].max(initial=0) < 2**32
                used, index = np.unique(owner[a:b], return_inverse=True)
                body = step[1:].astype(np.uint32) if small else step[1:]
                rows.append((k, _pack(step[:1], body, table[used], (used == marker), index.astype(np.uint16 if len(used) < 65536 else np.uint32))))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "blob"])

    def run(batches):
        tokens, owners, classes, seen, size = [], [], [], set(), 0
        for b in batches:
            for s in sets_of(b.column(1)):
                n = len(s)
                if n < 2 or (c := class_of(s)) in seen:  # a set of one token has no partner but itself
                    continue
                seen.add(c)
                low = int((s < _HALF).sum())
                s = s[: max(low, min(n, prefix_size(n) + max(group_numbers(n))))]
                tokens.append(s)
                owners.append(np.full(len(s), len(classes), np.int32))
                classes.append(c)
                size += len(s)
                if size > FLUSH:
                    yield flush(tokens, owners, classes)
                    tokens, owners, classes, seen, size = [], [], [], set(), 0
        if size:
            yield flush(tokens, owners, classes)

    return docs.mapInArrow(lean(run), "bucket int, blob binary")


def _frequencies(postings: DataFrame, groups: int) -> DataFrame:
    """(group, blob) by class, of all tokens that two classes have."""

    def run(table):
        blobs = table["blob"].to_pylist()
        bucket = table["bucket"][0].as_py()
        if bucket < 0:
            return pa.table({"g": pa.array([-1 - bucket] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary())})
        tokens, classes, marks = [], [], []
        for blob in blobs:
            first, body, cls, marked, index = _unpack(blob)
            tokens.append(np.cumsum(np.concatenate((first, body)), dtype=np.uint64))
            classes.append(cls[index])
            marks.append(marked[index])
        token, cls, mark = np.concatenate(tokens), np.concatenate(classes), np.concatenate(marks)
        order = np.lexsort((cls, token))
        token, cls, mark = token[order], cls[order], mark[order]
        keep = np.concatenate(([True], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]) | (mark[1:] != mark[:-1])))
        token, cls, mark = token[keep], cls[keep], mark[keep]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(first, len(token)))
        df = np.minimum(size, FREQUENT - 1)
        df[np.logical_or.reduceat(mark, first)] = FREQUENT
        df = np.repeat(df, size)
        shared = (df > 1) & ~mark
        rows = list(_by_class(cls[shared], token[shared], df[shared], groups))
        return pa.table({"g": pa.array([r[0] for r in rows], pa.int32()), "blob": pa.array([r[1] for r in rows], pa.binary())})

    return postings.groupBy("bucket").applyInArrow(lean(run), "g int, blob binary")


def _pairs_within(token: np.ndarray, groups: int) -> np.ndarray:
    """Signatures of the pairs of tokens that fall into one of the groups."""
    token = np.sort(token)
    group = (mix(token) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    token, group = token[order], group[order]
    out = [token[:0]]
    for d in range(1, len(token)):
        both = np.flatnonzero(group[d:] == group[:-d])
        if not len(both):
            break
        out.append(mix(token[both] * _TIMES[3] + token[both + d] * _TIMES[4] + np.uint64(groups)))
    return np.concatenate(out)


def signatures_of(n: int, low: int, token: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Signatures of a set of n tokens, ``low`` of them in the first half of the hash space.

    ``token``, ``df``: its tokens that other classes have too, in the global order (df BEHIND: in the second half).
    """
    front = df < BEHIND
    alone = low - int(front.sum())  # come first in the order
    need = prefix_size(n) - alone
    if need <= 0 or not len(token):
        return np.empty(0, np.uint64)
    rare = int((df <= RARE).sum())
    behind = token[~front]
    out = [mix(token[: min(need, rare)] * _TIMES[1])]
    if need > rare:
        for g in sorted(group_numbers(n)):
            k = need + g
            out.append(_pairs_within(np.concatenate((token[rare : min(k, len(token) - len(behind))], behind if low < alone + k else behind[:0])), g))
    return np.concatenate(out)


def _signatures(frequencies: DataFrame, classes: DataFrame, groups: int) -> DataFrame:
    """(sig, cls, n)."""

    def run(left, right):
        head = {c: (n, low) for c, n, low in zip(*(right[x].to_pylist() for x in ("cls", "n", "low")), strict=True)}
        parts = [_unpack(b) for b in left["blob"].to_pylist()]
        sig, own, sizes = [np.empty(0, np.uint64)], [], []
        if parts:
            cls = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
            token = np.concatenate([(p[2].astype(np.uint64) << np.uint64(16)) | p[3] for p in parts])
            df = np.concatenate([p[4] for p in parts]).astype(np.int64)
            df[token >= np.uint64(1 << 47)] = BEHIND
            order = np.lexsort((token, df, cls))
            cls, token, df = cls[order], token[order], df[order]
            keep = np.concatenate(([True], (cls[1:] != cls[:-1]) | (token[1:] != token[:-1])))  # declared frequent by several tasks
            cls, token, df = cls[keep], token[keep], df[keep]
            edges = np.append(np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1]))), len(cls))
            names = cls.view(np.int64)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                c = int(names[a])
                n, low = head[c]
                s = signatures_of(n, low, token[a:b], df[a:b])
                if len(s):
                    sig.append(s)
                    own.append(np.full(len(s), c, np.int64))
                    sizes.append(np.full(len(s), n, np.int64))
        own, sizes = (np.concatenate([np.empty(0, np.int64), *x]) for x in (own, sizes))
        return pa.table({"sig": np.concatenate(sig).view(np.int64), "cls": own, "n": sizes})

    group = F.pmod(F.col("cls").bitwiseAND(F.lit((1 << 62) - 1)), F.lit(groups)).cast("int")
    right = classes.select(group.alias("g"), "cls", "n", "low")
    return frequencies.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(lean(run), "sig long, cls long, n long")


# ---- links and components ----


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node u of ``edges(u, v)`` but a component's smallest, with that smallest v. Stars in turn."""
    edges = landed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("k")).withColumn("m", F.least("u", "m"))
        large = grouped_join(both.filter("v > u"), least, ["u"], "k", max(2 * edges.count(), 1)).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        before, edges = edges, landed(hung.filter("u <> v").distinct(), "edges")
        forget(before)
    return edges


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    loose = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.max("down").alias("downs")).agg(F.max(F.expr("ups > 1 or ups > 0 and downs > 0")).alias("loose"))
    return not loose.first()["loose"]


def linked(sets: list[np.ndarray], sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links among ``sets`` (with ``sides``: across the two sides only), as a spanning forest of their components."""
    n = np.array([len(s) for s in sets], np.float64)
    token, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n.astype(np.int64))
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    often = np.bincount(where) > 1
    keep = often[where]
    where, owner = (np.cumsum(often) - 1)[where[keep]], owner[keep]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (4 << 20) // len(sets))
    for low in range(0, int(often.sum()), width):
        i, j = np.searchsorted(where, (low, low + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[i:j], where[i:j] - low] = 1
        both += part @ part.T
    link = DEN * both >= NUM * (n[:, None] + n[None, :] - both)
    if sides is not None:
        link &= sides[:, None] != sides[None, :]
    np.fill_diagonal(link, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(link, label[None, :], len(sets)).min(1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return [(i, int(r)) for i, r in enumerate(label) if r != i]
        label = new


def _links(rows: DataFrame) -> DataFrame:
    """(u, v): links within each (sc, i, j) of ``rows(task, sc, i, j, cls, b, tokens)``; across blocks where i < j."""

    def run(table):
        keys = list(zip(*(table[c].to_pylist() for c in ("sc", "i", "j")), strict=True))
        cls, block, tokens = table["cls"].to_pylist(), table["b"].to_pylist(), table["tokens"].combine_chunks()
        offsets, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
        of: dict[tuple, dict[int, int]] = {}
        for r, k in enumerate(keys):
            of.setdefault(k, {})[cls[r]] = r  # a class once
        out = []
        for (_, i, j), members in of.items():
            at = list(members.values())
            sides = np.array([block[r] for r in at]) if i != j else None
            out += [(cls[at[x]], cls[at[y]]) for x, y in linked([flat[offsets[r] : offsets[r + 1]] for r in at], sides)]
        u, v = zip(*out, strict=True) if out else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("task").applyInArrow(lean(run), "u long, v long")


def _units(members: DataFrame, tasks_by: int) -> DataFrame:
    """Rows (task, sc, i, j, cls, b) that bring together what may link in each ``sc`` of ``members(sc, cls, n, tight)``.

    Blocks of tight classes come first and meet all blocks; blocks of others meet those.
    """
    sizes = members.groupBy("sc").agg(*(F.ceil(F.greatest(F.count_if(c) / BLOCK, F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) / BLOCK_TOKENS)).cast("int").alias(k) for k, c in (("t", F.col("tight")), ("l", ~F.col("tight")))), F.count(F.lit(1)).alias("m"))
    sized = grouped_join(members, sizes, ["sc"], "m", max(members.count(), 1))
    sized = sized.withColumn("b", F.when(F.col("tight"), F.pmod(F.xxhash64("cls"), F.col("t"))).otherwise(F.col("t") + F.pmod(F.xxhash64("cls"), F.col("l"))).cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("tight"), F.col("t") + F.col("l")).otherwise(F.col("t")) - 1)
    met = sized.filter("t > 0").withColumn("o", F.explode(others)).withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")})
    task = F.when(F.col("t") + F.col("l") == 1, F.pmod(F.xxhash64("sc"), F.lit(tasks_by))).otherwise(F.xxhash64("sc", "i", "j"))
    return met.withColumn("task", task).select("task", "sc", "i", "j", "cls", "b")


def _wide(members: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """Units of clusters that aren't one component yet; ``members(sc, cls, n, root)``.

    m tokens of a class are shared with another class of the cluster; it can link with sets of up to ``most`` tokens. A
    class is tight if that is its own size at least; of two linked classes one is. Where a cluster has few blocks of tight
    classes all of it meets these; where it has many, each signature's classes meet its tight ones.
    """
    owned = members.select("sc", "cls").join(sets, "cls").select("sc", "cls", F.explode("tokens").alias("token"))
    own = owned.groupBy("sc", "token").agg(F.min("cls").alias("cls"), F.max("cls").alias("last")).filter("cls = last").groupBy("cls").agg(F.count(F.lit(1)).alias("own"))
    members = members.join(own, "cls", "left").withColumn("most", F.floor((F.col("n") - F.coalesce("own", F.lit(0))) * (NUM + DEN) / NUM) - F.col("n"))
    members = landed(members.withColumn("tight", F.col("most") >= F.col("n")).select("sc", "cls", "n", "root", "most", "tight"), "wide")
    large = landed(members.groupBy("sc").agg(F.count_if("tight").alias("t")).filter(F.col("t") > FEW_BLOCKS * BLOCK).select("sc"), "large")
    rows = keyed_filter(members, large, ["sc"], "left_anti").select("sc", "cls", "n", "tight")
    if not large.isEmpty():
        rows = rows.unionByName(_by_signature(keyed_filter(members, large, ["sc"], "left_semi"), sigs))
    rows = landed(rows, "meet")
    return _units(rows, 1 + (rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // BLOCK_TOKENS)


def _by_signature(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """(sc, cls, n, tight) with a signature for ``sc``: of those with several roots and a tight class; classes that fit
    none of its tight ones stay out, and signatures of the same classes count once."""
    signed = sigs.join(members, "cls")
    stats = [F.count(F.lit(1)).alias("k"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.when(F.col("tight"), F.col("n"))).alias("small"), F.max(F.when(F.col("tight"), F.col("most"))).alias("large")]
    groups = signed.groupBy("sig").agg(*stats).filter("lo <> hi and small is not null")
    fit = grouped_join(signed, groups, ["sig"], "k", max(sigs.count(), 1)).filter("k is not null and (tight or small <= most and n <= large)")
    fit = landed(fit.select("sig", "sc", "cls", "n", "tight"), "fit")
    same = fit.groupBy("sig", "sc").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
    once = same.filter("k > 1").groupBy("sc", "k", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "k")
    return grouped_join(fit, once, ["sig"], "k", max(fit.count(), 1)).filter("k is not null").select(F.col("sig").alias("sc"), "cls", "n", "tight")


def _joined(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, n, component_id, root) for each row of ``docs(doc_id, hash, text)``; root: of the component's class."""
    digest = landed(_digest(docs), "shingles")
    total, tokens = digest.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = digest.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("low").alias("low"), F.count(F.lit(1)).alias("size"))
    classes = landed(classes, "classes")
    buckets = 1 << max(5, (tokens // FLUSH).bit_length())
    groups = 1 << max(5, (total // 12_000).bit_length())
    shared = _frequencies(_postings(docs.select("doc_id", "text"), buckets, groups), groups)
    first = landed(_signatures(shared, classes.filter("n > 1"), groups), "signatures")
    counts = first.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    sigs = landed(grouped_join(first, counts, ["sig"], "k", max(first.count(), 1)).filter("k > 1").select("sig", "cls").distinct(), "signed")
    forget(first)

    reps = sigs.select("cls").distinct().join(classes, "cls").select(F.col("rep").alias("doc_id")).filter("doc_id is not null").distinct()
    unnamed = classes.filter("rep is null").select("cls")

    def tokenise(batches):
        seen: set[int] = set()
        for b in batches:
            rows = []
            for s in sets_of(b.column(0)):
                c = class_of(s) if len(s) > 1 else None
                if c is not None and c not in seen:
                    seen.add(c)
                    rows.append((c, s.view(np.int64)))
            flat = np.concatenate([np.empty(0, np.int64), *(r[1] for r in rows)])
            offsets = np.concatenate(([0], np.cumsum([len(r[1]) for r in rows]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["cls", "tokens"])

    chosen = keyed_filter(docs.select("doc_id", "text"), landed(reps, "reps"), ["doc_id"], "left_semi").select("text")
    if not unnamed.isEmpty():
        chosen = chosen.unionByName(docs.filter("doc_id is null").select("text"))
    sets = landed(chosen.mapInArrow(lean(tokenise), "cls long, tokens array<long>"), "sets")

    # Candidates: classes reach each other through common signatures, each tied to the smallest class of the signature.
    heads = sigs.groupBy("sig").agg(F.min("cls").alias("v"), F.count(F.lit(1)).alias("many"))
    ties = grouped_join(sigs.select("sig", F.col("cls").alias("u")), heads, ["sig"], "many", max(sigs.count(), 1)).select("u", "v").distinct()
    clusters = components(ties)
    clusters = clusters.unionByName(clusters.select(F.col("v").alias("u"), "v").distinct()).select(F.col("u").alias("cls"), F.col("v").alias("sc"))
    clusters = landed(clusters.join(classes.select("cls", "n"), "cls"), "clusters")
    count, held = clusters.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    sizes = clusters.groupBy("sc").agg(F.count(F.lit(1)).alias("m"), F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    members = grouped_join(clusters, sizes, ["sc"], "m", max(count, 1))
    members = landed(members.withColumn("b", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")), "members")
    tasks = 1 + max(count // 1000, held // BLOCK_TOKENS)
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("sc"), F.lit(tasks))).otherwise(F.xxhash64("sc", "i", "j"))
    shown = ["task", "sc", "i", "j", "cls", "b", "tokens"]

    # Within blocks first; a cluster's smallest class visits all its blocks, so that a tight cluster is one component then.
    own = members.withColumns({"i": F.col("b"), "j": F.col("b")})
    visit = members.filter("cls = sc and blocks > 1").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("i <> b").withColumn("j", F.col("i"))
    links = landed(_links(own.unionByName(visit).withColumn("task", task).join(sets, "cls").select(*shown)), "links")

    # Then across blocks, where a cluster isn't one component.
    stars = components(links)
    wide = members.filter("blocks > 1")
    if not wide.isEmpty():
        wide = wide.join(stars.select(F.col("u").alias("cls"), F.col("v").alias("root")), "cls", "left").withColumn("root", F.coalesce("root", "cls")).select("sc", "cls", "n", "root")
        loose = landed(wide.groupBy("sc").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("sc"), "loose")
        if not loose.isEmpty():
            units = _wide(keyed_filter(wide, loose, ["sc"], "left_semi"), sigs, sets)
            more = landed(_links(units.join(sets, "cls").select(*shown)), "links")
            if not more.isEmpty():
                stars = components(stars.unionByName(more))

    rooted = classes.join(stars.select(F.col("u").alias("cls"), F.col("v").alias("root")), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("many"))
    named = landed(grouped_join(rooted, least, ["root"], "many", total).select("cls", "size", "component_id", "root"), "named")
    met = grouped_join(digest.filter("n > 0"), named, ["cls"], "size", total)
    alone = digest.filter("n = 0").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")})
    columns = ["doc_id", "hash", "n", "component_id", "root"]
    return met.select(*columns).unionByName(alone.select(*columns))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each document."""
    return _joined(_named(docs, id_col, text_col)).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (a null id comes last); columns unchanged.

    Rows are told apart by id and text: of rows that agree in both, any one stays.
    """
    found = landed(_joined(_named(docs, id_col, text_col)).filter("root is not null").select("root", "doc_id", "hash"), "joined")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    picks = found.groupBy("root").agg(F.min(order).alias("pick"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    grouped = grouped_join(found, picks, ["root"], "many", max(found.count(), 1)).filter("pick is not null")
    kept = (F.col("doc_id").eqNullSafe(F.col("pick.doc_id"))) & (F.col("hash") == F.col("pick.hash"))
    fate = grouped.groupBy(F.struct("doc_id", "hash").alias("key")).agg(F.max(kept).alias("kept"), F.count(F.lit(1)).alias("times"))  # in a struct, a null id is a key like others
    fate = landed(fate, "fate")
    name = unused(docs, "key")
    text = F.col(text_col).cast("string")
    keyed = docs.withColumn(name, F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash")))
    gone = fate.filter("not kept").select(F.col("key").alias(name))
    twins = fate.filter("kept and times > 1").select(F.col("key").alias(name))
    out = keyed_filter(keyed, landed(gone, "gone"), [name], "left_anti")
    if not twins.isEmpty():
        twins = landed(twins, "twins")
        out = keyed_filter(out, twins, [name], "left_anti").unionByName(keyed_filter(out, twins, [name], "left_semi").dropDuplicates([name]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
