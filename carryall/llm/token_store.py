"""Token ids of documents in Parquet files that can be read selectively.

A row is a document: its id, the number of its tokens, and the ids as a list column
with dictionary encoding, which packs ids to the bits that a file's vocabulary needs;
the numbers are delta-encoded. Rows lie in ascending doc_id order within and across
files. Small row groups and pages with a page index let a reader skip to documents,
and reading lengths alone never touches the lists.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from carryall.llm.subwords import BYTE_BPE, encoder, tokenizer_path
from carryall.sources.tables import fresh_path

END = 0
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 1_000


def encoded(docs: DataFrame, tokenizer: str = BYTE_BPE, end: int = END) -> DataFrame:
    """(doc_id, n_tokens, tokens) of every row: the ids of its text and then `end`."""
    path = tokenizer_path(tokenizer)

    def of(batches):
        enc, stop = encoder(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                bodies = [b + stop for b in enc.encode([t or "" for t in part.column(1).to_pylist()])]
                sizes = np.fromiter((len(b) // 4 for b in bodies), np.int64, len(bodies))
                values = pa.array(np.frombuffer(b"".join(bodies), "<u4").astype(np.int32))
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "n_tokens", "tokens"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, n_tokens long, tokens array<int>")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = BYTE_BPE,
    end: int = END,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the ids of all documents, in ascending doc_id order, as Parquet files.

    The texts are dealt by ranges of doc_id and encoded there, so that the longer
    lists of ids are never moved. Rows without doc_id come first. Rows of one doc_id, or
    without any, are told apart by their place in the input and may fill many ranges.
    """
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))
    rows = numbered.repartitionByRange("doc_id", "__row").sortWithinPartitions("doc_id", "__row").drop("__row")
    (
        encoded(rows, tokenizer, end)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("compression", "zstd")
        # Ids packed to bits hardly compress further.
        .option("parquet.compression.codec.zstd.level", 1)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens and tokens as written, with the place of each document.

    start: ids of all documents before it, from the lengths of its file and the totals
    of the files before; only the column of lengths is read for it.
    """
    schema = "doc_id long, n_tokens long, tokens array<int>"
    rows = spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    # By the number of the part, which has more than five digits from 100,000 files on.
    part = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy(part, "file").collect()
    before, total = [], 0
    for r in totals:
        before.append((r["file"], total))
        total += r["n"]
    offsets = spark.createDataFrame(before, "file string, before long")
    return rows.join(F.broadcast(offsets), "file")


_KEPT = ["file", "place", "before", "doc_id"]


def _digests(batches):
    for batch in batches:
        lists = batch.column("tokens")
        ids = lists.flatten().to_numpy().astype("<u4")
        bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).tolist()
        crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
        lengths = np.diff(bounds).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _KEPT), pa.array(lengths), pa.array(crcs, pa.int64())], [*_KEPT, "n_tokens", "ids_crc32"]
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files at `path`.

    The numbers are taken from the lists themselves. Rows with one doc_id lie one
    after the other. Of an empty table there are no rows.
    """
    found = read_tokens(spark, path).select(*_KEPT, "tokens").mapInArrow(
        _digests, "file string, place long, before long, doc_id long, n_tokens long, ids_crc32 long"
    )
    earlier = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    return found.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def stored_tokens(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """Writes the documents' ids to the shared folder and gives their index, read back from there.

    A null or empty text is its end id alone. Rows without doc_id are stored first;
    repeated rows are stored each.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return token_index(spark, path)
