"""Values with a common beginning, and rows that are repeated or have no doc_id."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from carryall.llm import hilbert, packing, token_store
from carryall.sources.tables import fresh_path

_DOCS = "doc_id long, text string, source string"


def test_cells_tell_long_common_beginnings_apart(spark):
    rows = [(k, "x", f"https://example.com/a/long/common/path/{k % 8}") for k in range(80)] + [(99, "x", None)]
    df = spark.createDataFrame(rows, _DOCS)
    cells = {r["value"]: r["cell"] for r in hilbert.value_cells(df, "source", 3).collect()}
    assert [cells[v] for v in sorted(cells)] == list(range(8))
    placed = hilbert.placed(df, ("source",), 3).collect()
    assert Counter(r["cells"][0] for r in placed) == Counter([k % 8 for k in range(80)] + [0])


def test_cells_weigh_values_by_their_rows(spark):
    values = ["a"] * 60 + ["b"] * 20 + ["c"] * 20
    df = spark.createDataFrame([(k, "x", v) for k, v in enumerate(values)], _DOCS)
    cells = {r["value"]: r["cell"] for r in hilbert.value_cells(df, "source", 2).collect()}
    assert cells == {"a": 2, "b": 3, "c": 3}
    none = df.limit(0)
    assert hilbert.value_cells(none, "source", 2).count() == 0


def _hot(spark, n):
    """A third of the rows is one row without doc_id, a third one doc_id."""
    none = F.lit(None).cast("long")
    doc = F.when(F.col("id") % 3 == 0, none).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    return spark.range(n).select(doc.alias("doc_id"), F.lit("one text").alias("text"), F.lit("s").alias("source"))


def test_repeated_rows_fill_many_token_files(spark):
    n = 3000
    path = fresh_path(spark, "tokens")
    # So few rows would be put into one file again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write_tokens(_hot(spark, n), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    assert sum(r["count"] for r in files) == n
    assert max(r["count"] for r in files) < 0.6 * n
    index = token_store.token_index(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in index]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in index] == [sum(x["n_tokens"] for x in index[:k]) for k in range(len(index))]


def test_repeated_rows_are_packed_in_many_groups(spark):
    n = 3000
    out = packing.pack(_hot(spark, n), group=100).collect()
    assert len(out) == n
    groups = Counter(r["sequence_id"] >> 20 for r in out)
    assert len(groups) >= 25 and max(groups.values()) < 250
    spans = {}
    for r in out:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in spans.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_repeated_rows_have_a_slot_each(spark):
    out = hilbert.shards(_hot(spark, 900), n_shards=4).collect()
    assert Counter(r["shard"] for r in out) == {k: 225 for k in range(4)}
    assert sorted((r["shard"], r["slot"]) for r in out) == [(s, k) for s in range(4) for k in range(225)]
