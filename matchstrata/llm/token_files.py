"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters.

Columns of a file: ``doc_id``, ``part`` (its file's number), ``part_start`` (ids
of the documents before it in that file), ``n_tokens``, ``ids`` (array of int).
ORC encodes the ids by run-length version 2 (delta and bit-packed runs), keeps
minimum and maximum of ``doc_id`` for each stripe and row group, and a Bloom
filter on it, so a look-up of a few documents reads few row groups and a full
read takes one task for each range of stripes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchstrata.llm.tokens import slices, trim, worker_encoder
from matchstrata.session import stage

END_ID = 0
STRIPE_BYTES = 16 * 1024 * 1024
ROWS_PER_INDEX = 1_000
BLOOM_FALSE_POSITIVES = 0.01

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def encoded(docs: DataFrame, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Documents in ascending ``doc_id`` order over range partitions, with their ids.

    A null text is empty: its document holds the end id alone. A null ``doc_id``
    comes first. Documents with one id keep the order of their texts' hashes;
    equal rows are all kept. Other columns of ``docs`` are not looked at.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        encoder = worker_encoder(vocabulary)
        part, start = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 1):
            flat, n = encoder.encode(batch.column(1), end_id)
            ends = np.cumsum(n)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat.view("<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(n), part, np.int32)),
                    pa.array(start + ends - n),
                    pa.array(n),
                    ids,
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            start += int(ends[-1])
        trim()

    return ranged.mapInArrow(run, FILE_SCHEMA)


def write_tokens(
    docs: DataFrame, path: str, end_id: int = END_ID, vocabulary: str | None = None
) -> None:
    """Write the ids of all documents as ORC files under ``path``."""
    (
        encoded(docs, end_id, vocabulary)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The stored documents; ``doc_ids`` is pushed to the stripes' statistics and Bloom filters.

    Adds ``start``, the ids of all documents before, from the sizes of the files.
    """
    stored = spark.read.schema(FILE_SCHEMA).orc(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # reads two columns
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    starts = stage(starts, "token-file-starts").df  # a row per file; stored, so that Catalyst knows its size
    if doc_ids is not None:
        stored = stored.where(F.col("doc_id").isin(list(doc_ids)))
    return (
        stored.join(starts, "part")
        .withColumn("start", F.col("file_start") + F.col("part_start"))
        .drop("file_start")
    )


def with_crc(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of stored documents."""

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = np.asarray(ids.flatten()).astype("<i4", copy=False)
            edges = np.asarray(ids.offsets) - ids.offsets[0].as_py()
            view = memoryview(np.ascontiguousarray(flat)).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
