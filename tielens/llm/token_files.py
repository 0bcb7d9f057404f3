"""Token-id files: ORC with run-length-encoded ids, row indexes and a Bloom filter on document ids.

Documents are encoded, closed with an end id and written in ascending id order (ties by text), one row per document.
ORC gives integer run-length encoding within stripes, row-index statistics and Bloom filters on ``doc_id``, so that
stripes are read in parallel and a lookup by id skips stripes and row groups. Each row keeps its file's number and the
ids before it in that file; the files' totals turn these into positions in the whole stream.

Defined results: a null text is empty and gives the end id alone. Null ids come first. Repeated rows are all written.
Texts of any length are encoded whole. An empty table gives no rows. Other columns aren't written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import fresh_path
from .common import lean, runs
from .tokens import encoder

END_ID = 0
STRIPE_BYTES = 64 << 20
ROW_GROUP = 1000


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, doc_id, before, n_tokens, ids) in ascending order; ``before`` counts the ids before it in its part."""

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            for i, j, texts in runs(b.column(1)):
                ids, counts = encoder(path).encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids.astype(np.int32), ends, end_id)
                counts = counts + 1
                ends = np.cumsum(counts)
                offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                start = pa.array(before + ends - counts, pa.int64())
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, part, np.int32)), b.column(0).slice(i, j - i), start, pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids))],
                    ["part", "doc_id", "before", "n_tokens", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    return ordered.mapInArrow(lean(run, mapped=False), "part int, doc_id long, before long, n_tokens long, ids array<int>")


def write_ids(docs: DataFrame, out: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> str:
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(ROW_GROUP), "compression": "zstd"}
    encoded(docs, path, end_id, id_col, text_col).write.options(**options).orc(out)
    return out


FILE_SCHEMA = "part int, doc_id long, before long, n_tokens long, ids array<int>"


def read_ids(spark: SparkSession, out: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files' rows; with ``doc_ids`` the predicate is pushed to stripe statistics, row indexes and Bloom filters."""
    rows = spark.read.schema(FILE_SCHEMA).orc(out)
    return rows.filter(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else rows


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""

    def run(batches):
        for b in batches:
            lists = b.column(3)
            offsets = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
            crc = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())], ["part", "doc_id", "before", "n_tokens", "ids_crc32"])

    rows = read_ids(spark, out)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    starts = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("first"))  # a row for each file
    digests = rows.select("part", "doc_id", "before", "ids").mapInArrow(lean(run, mapped=False), "part int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return digests.join(F.broadcast(starts), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def through_files(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    out = write_ids(docs, fresh_path(docs.sparkSession, "ids"), path, end_id)
    return read_digests(docs.sparkSession, out)
