"""Long words that a polynomial modulo a power of two cannot tell apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from carryall.llm import decontaminate, substring, token_store, words


def thue_morse(n):
    return "".join("ab"[k.bit_count() % 2] for k in range(n))


def pair(n):
    word = thue_morse(n)
    return word, word.translate(str.maketrans("ab", "ba"))


def test_their_numbers_differ():
    for n in (64, 128, 256, 257, 512, 1024, 2048, 4096):
        one, other = pair(n)
        numbers = words.split(pa.array([one, other, f"x {one} y", one[:-1]])).hashes
        assert len(np.unique(numbers)) == 5 and numbers[0] == numbers[3]


def test_repeats_and_benchmarks_tell_them_apart(spark):
    one, other = pair(1024)
    rest = " ".join(f"word{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{other} {rest}")], "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in substring.repeats_with_paths(docs).collect()}
    assert removed == {1: 0, 2: 0}
    bench = spark.createDataFrame([(1, f"{one} {rest}")], "item_id long, text string")
    hits = {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, bench).collect()}
    assert hits == {1: 13, 2: 0}


def test_files_stand_in_order_of_their_numbers(spark, tmp_path):
    """From 100,000 parts on, names no longer sort as their numbers do."""
    rows = spark.createDataFrame([(1, 2, [5, 0])], "doc_id long, n_tokens long, tokens array<int>")
    for number, n in ((99_999, 1), (100_000, 2)):
        rows.coalesce(1).withColumn("doc_id", rows.doc_id + n).write.parquet(str(tmp_path / str(n)))
        made = next((tmp_path / str(n)).glob("part-00000-*.parquet"))
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / made.name.replace("part-00000", f"part-{number}")).write_bytes(made.read_bytes())
    found = token_store.token_index(spark, str(tmp_path / "all")).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in found] == [(2, 0), (3, 2)]
