"""Token counts by unigram segmentation, with the forward scores of a trie's nodes computed once.

The distinct pre-tokens of a task form a trie. The best score of a node (a prefix) depends on its ancestors only: the
maximum over vocabulary pieces that end there of the ancestor's score plus the piece's. Pre-tokens that share a prefix
share its nodes' scores; a terminal stores score and token count, and a document adds up its terminals. The trie is
walked in lexicographic order, so only one root-to-leaf path of scores is held.

A pre-token is a run of bytes outside 0x20 and 0x09-0x0D with one space before it. The vocabulary is that of a byte-level
tokenizer file, the score of id i is -ln(i + 2); equal scores take fewer tokens. Single bytes are in the vocabulary, so
every text has a segmentation.

Defined results: null and empty texts have no tokens and score 0. Repeated rows are counted one by one. An empty table
gives an empty result. Other columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, runs

#: Terminals that a task keeps before it starts anew (bounds memory, changes no result).
MOST_TERMINALS = 600_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level tokenizer files, to bytes: printable bytes stand for themselves, others follow 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in own}
    for n, b in enumerate(b for b in range(256) if b not in set(own)):
        table[chr(256 + n)] = b
    return table


def vocabulary(path: str) -> dict[bytes, float]:
    """Piece to score."""
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    table = byte_alphabet()
    return {bytes(table[c] for c in token): -math.log(i + 2) for token, i in ids.items() if all(c in table for c in token)}


class Counter:
    """Token counts and scores of pre-tokens."""

    def __init__(self, pieces: dict[bytes, float]):
        self.ends: dict = {}  # pieces by their reversed bytes: nested tables, score under -1
        for piece, score in pieces.items():
            at = self.ends
            for b in reversed(piece):
                at = at.setdefault(b, {})
            at[-1] = score
        self.count: dict[bytes, int] = {}
        self.score: dict[bytes, float] = {}

    def learn(self, words: list[bytes]) -> None:
        """Terminals for ``words`` (ascending, distinct)."""
        ends, last = self.ends, b""
        best, used = [0.0], [0]  # along the path from the root
        for word in words:
            w = b" " + word
            depth, most = 0, min(len(w), len(last))
            while depth < most and w[depth] == last[depth]:
                depth += 1
            del best[depth + 1 :], used[depth + 1 :]
            for d in range(depth + 1, len(w) + 1):
                at, k, top, n = ends, d, -math.inf, 0
                while k:
                    k -= 1
                    at = at.get(w[k])
                    if at is None:
                        break
                    s = at.get(-1)
                    if s is not None:
                        s += best[k]
                        if s > top or s == top and used[k] + 1 < n:
                            top, n = s, used[k] + 1
                best.append(top)
                used.append(n)
            last = w
            self.count[word], self.score[word] = used[-1], best[-1]

    def totals(self, texts: list[bytes]) -> list[tuple[int, int, float]]:
        """(pre-tokens, tokens, score) of each text."""
        split = [t.split() for t in texts]
        if len(self.count) > MOST_TERMINALS:
            self.count, self.score = {}, {}
        new = set().union(*split).difference(self.count) if split else ()
        if new:
            self.learn(sorted(new))
        count, score = self.count.__getitem__, self.score.__getitem__
        return [(len(s), sum(map(count, s)), math.fsum(map(score, s))) for s in split]


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pretokens, n_tokens, score) for each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if path not in _counters:
            _counters[path] = Counter(vocabulary(path))
        for b in batches:
            got = [t for _, _, texts in runs(b.column(1)) for t in _counters[path].totals(texts)]
            columns = list(zip(*got, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["id", "n_pretokens", "n_tokens", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(lean(run), f"id {kind}, n_pretokens long, n_tokens long, score double").withColumnRenamed("id", id_col)
