"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text (byte classes, word and line shapes, repetition) feed trees of a fixed depth, grown on
binned features by the logistic loss. The fitted trees are flattened into arrays, and numpy walks all documents of a
batch down all levels of a tree at once. The model is fitted on at most ``MOST_LABELLED`` labelled rows, those with the
smallest hash of their id; scoring covers every row and every whole text.

Defined results: null and empty texts get the score of their (zero) statistics. Repeated rows get equal scores.
Without labels, or with labels of one class only, every score is the (smoothed) share of label 1. An empty table gives
an empty result. Other columns are no inputs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, runs

MOST_LABELLED = 20_000
THRESHOLD = 0.7
BINS, TREES, DEPTH, RATE, LEAST, L2 = 48, 80, 4, 0.12, 20, 1.0
_CLASSES = [bytes([c]) for c in b"*$%&#!|@{}<>=/:?.,;\"'()-_"]
_GROUPS = np.zeros((256, 6), np.float64)
for _i, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), range(128, 256), (10,))):
    _GROUPS[list(_set), _i] = 1
_CHOSEN = [c[0] for c in _CLASSES]
_RUN = re.compile(rb"[^\sA-Za-z0-9\x80-\xff]{2,}")
NAMES = ["chars", "words", *("upper", "lower", "digit", "space", "high", "newline"), *(f"c{c.decode()}" for c in _CLASSES), "symbols", "symbol_runs", "word_mean", "word_sd", "word_long", "distinct", "top_word", "line_mean", "repeated_lines", "repeated_triples", "upper_words"]


def statistics(text: bytes) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(NAMES)
    h = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    groups = h @ _GROUPS
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    w = len(words) or 1
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    triples = len(words) - 2
    again = 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if triples > 0 else 0.0
    symbols = n - groups[:5].sum()
    return [
        np.log1p(n), np.log1p(len(words)), *(groups / n), *(h[_CHOSEN] / n), symbols / n, len(_RUN.findall(text)) / w,
        sizes.mean(), sizes.std(), (sizes > 18).mean(), len(counts) / w, max(counts.values(), default=0) / w,
        np.log1p(n / max(len(lines), 1)), 1 - len(set(lines)) / len(lines) if lines else 0.0, again, sum(map(bytes.isupper, words)) / w,
    ]


@dataclass
class Trees:
    """Complete trees of one depth: node i of a level has children 2i+1 and 2i+2."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # go right if the feature is above
    value: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, row = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < len(feature):
                at = 2 * at + 1 + (x[row, feature[at]] > cut[at])
            raw += value[at - len(feature)]
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    inner, leaves = 2**depth - 1, 2**depth
    p = (y.sum() + 1) / (len(y) + 2)
    model = Trees(float(np.log(p / (1 - p))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    features = x.shape[1]
    flat = bins + np.arange(features) * BINS
    raw = np.full(len(y), model.start)
    parts = []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        g, hs = q - y, q * (1 - q)
        at = np.zeros(len(y), np.int64)
        feature, cut, gap = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            place = ((at - first)[:, None] * features * BINS + flat).ravel()
            size = n * features * BINS
            hist = [np.bincount(place, np.repeat(v, features), size).reshape(n, features, BINS).cumsum(2) for v in (g, hs, np.ones(len(y)))]
            G, H, N = hist
            all_g, all_h, all_n = (v[:, :, -1:] for v in hist)
            gain = G**2 / (H + L2) + (all_g - G) ** 2 / (all_h - H + L2) - all_g**2 / (all_h + L2)
            gain[(N < LEAST) | (all_n - N < LEAST)] = 0
            best = gain.reshape(n, -1).argmax(1)
            for i in range(n):
                f, b = divmod(int(best[i]), BINS)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + i], cut[first + i], gap[first + i] = f, edges[f][b], b
            at = 2 * at + 1 + (bins[np.arange(len(y)), feature[at]] > gap[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, hs, leaves) + L2)
        raw += value[leaf]
        parts.append((feature, cut, value))
    model.feature, model.cut, model.value = (np.stack(v) for v in zip(*parts, strict=True))
    return model


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> Trees:
    """Fitted on at most ``most`` labelled rows outside the held-out fold."""
    rows = labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("double").alias("label")).filter(~held_out("key") & F.col("key").isNotNull() & F.col("label").isNotNull())
    rows = rows.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(most)  # at most 20,000 keys: bounded, so broadcast
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(rows), "key").select("label", "text")

    def run(batches):
        for b in batches:
            made = np.array([statistics(t) for _, _, texts in runs(b.column(1)) for t in texts], np.float32).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in made], pa.binary())], ["label", "x"])

    got = texts.mapInArrow(lean(run), "label double, x binary").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, len(NAMES)).astype(np.float64)
    y = (got["label"].to_numpy() > 0.5).astype(np.float64)
    order = np.lexsort((*x.T, y))  # tasks end in any order; the fit doesn't depend on it
    return fit(x[order], y[order])


def _scores(column, model: Trees) -> np.ndarray:
    x = np.array([statistics(t) for _, _, texts in runs(column) for t in texts], np.float32).reshape(-1, len(NAMES))
    return model.score(x.astype(np.float64))


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_scores(b.column(2), model))], ["id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lean(run), f"id {kind}, held_out boolean, score double").withColumnRenamed("id", id_col)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, in one pass; columns unchanged."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(b.column(at), model) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)
