"""Benchmark passages in training documents, by suffix arrays of the documents.

Each batch of documents is a shard: the word sequences of its documents, and an array
of their suffixes in order. Every suffix of every benchmark item is looked up in each
shard by binary search; its neighbours there hold its longest verbatim match, and the
suffixes that begin with a whole window give all its places. Windows that follow each
other both in the document and in the item make one match, however long. Only suffixes
that begin like some benchmark suffix are sorted, as no other can match.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from carryall.llm.words import NOT_ALNUM, Words, by_bytes, runs_of_true, split
from carryall.sources.tables import pin

WIDTH = 13
# Bytes of benchmark text that are searched for at a time.
QUERY_BYTES = 8 << 20


class Queries:
    """All suffixes of a block of benchmark items, as numbers of its own vocabulary.

    keys: a row per suffix, its first `width` words (0: behind the item's end);
    lengths: words of each suffix up to `width`; window: whether the suffix is one of
    the item's windows; items: its item; of: the item's place in the block; starts: the
    suffix's first word in the item. Repeated suffixes of one item stay apart.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], width: int) -> None:
        words = split(pa.array([t for _, t in items], pa.string()), NOT_ALNUM, lower=True)
        self.vocabulary = np.unique(words.hashes)
        ids = np.searchsorted(self.vocabulary, words.hashes).astype(np.uint32) + 1
        self.width = width
        n = len(ids)
        keys = np.zeros((n, width), np.uint32)
        of = words.text_of()
        left = words.bounds[1:][of] - np.arange(n)
        padded = np.concatenate((ids, np.zeros(width, np.uint32)))
        for j in range(width):
            keys[:, j] = np.where(left > j, padded[j : j + n], 0)
        self.keys = keys
        self.lengths = np.minimum(left, width)
        first = np.arange(n) == words.bounds[of]
        self.of = of
        self.starts = np.arange(n) - words.bounds[of]
        self.window = (left >= width) | first & (left == words.counts[of])
        self.items = np.array([-1 if i is None else i for i, _ in items], np.int64)[of]
        self.named = np.array([i is not None for i, _ in items], bool)[of]
        self.shortest = int(self.lengths[self.window].min()) if n else 0
        # Pairs of words that begin a window of two words or more.
        self.pairs = np.unique(_pair(keys[:, 0], keys[:, 1])[self.lengths > 1]) if width > 1 else np.zeros(0, np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | b


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings in the same order."""
    width = keys.shape[1]
    return np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * width}").reshape(-1)


class Shard:
    """The suffix array of a column of texts, as far as suffixes begin like `queries`.

    With `all_words` every suffix that begins with a word of the queries is in it, else
    those only that can hold a window.
    """

    def __init__(self, texts, queries: Queries, all_words: bool = False) -> None:
        self.words: Words = split(texts, NOT_ALNUM, lower=True)
        hashes, width = self.words.hashes, queries.width
        vocabulary = queries.vocabulary
        self.of = self.words.text_of()
        if not len(vocabulary) or not len(hashes):
            self.at = np.zeros(0, np.int64)
            self.keys = np.zeros((0, width), np.uint32)
            self.sorted = _ordered(self.keys)
            return
        near = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        ids = np.where(vocabulary[near] == hashes, near + 1, 0).astype(np.uint32)
        n = len(ids)
        ends = self.words.bounds[1:][self.of]
        after = np.concatenate((ids[1:], [0])).astype(np.uint32)
        after[np.arange(n) + 1 >= ends] = 0
        begins = ids > 0
        if queries.shortest > 1 and not all_words:
            pair = _pair(ids, after)
            near = np.minimum(np.searchsorted(queries.pairs, pair), max(0, len(queries.pairs) - 1))
            begins &= queries.pairs[near] == pair
            # At least as many words of the vocabulary must follow as the shortest window has.
            known = runs_of_true(ids > 0, self.words.bounds)
            begins &= known >= queries.shortest
        at = np.flatnonzero(begins)
        keys = np.zeros((len(at), width), np.uint32)
        padded = np.concatenate((ids, np.zeros(width, np.uint32)))
        open_ = np.ones(len(at), bool)
        for j in range(width):
            # A suffix goes on to its text's end; what is no word of the vocabulary matches nothing.
            open_ &= at + j < ends[at]
            column = padded[at + j]
            keys[:, j] = np.where(open_, column, 0)
            open_ &= column > 0
        packed = _ordered(keys)
        order = np.argsort(packed, kind="stable")
        self.at = at[order]
        self.keys = keys[order]
        self.sorted = packed[order]

    def matches(self, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query suffix: the suffixes that begin with it, and its longest match in words."""
        low = _ordered(queries.keys)
        behind = queries.keys == 0
        high = _ordered(np.where(behind, np.uint32(0xFFFFFFFF), queries.keys))
        a, b = np.searchsorted(self.sorted, low, "left"), np.searchsorted(self.sorted, high, "right")
        longest = np.zeros(len(a), np.int64)
        for near in (a - 1, a):
            ok = np.flatnonzero((near >= 0) & (near < len(self.at)))
            same = (self.keys[near[ok]] == queries.keys[ok]) & ~behind[ok]
            longest[ok] = np.maximum(longest[ok], np.cumprod(same, axis=1).sum(1))
        return a, b, longest

    def hits(self, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
        """(query suffix, suffix's first word in the shard) of every window found."""
        a, b, _ = self.matches(queries)
        q = np.flatnonzero(queries.window & (b > a))
        n = (b - a)[q]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) - np.repeat(ends - n, n) + np.repeat(a[q], n)
        return np.repeat(q, n), self.at[at]

    def longest(self, queries: Queries, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query suffix, first word in the shard, words) of the matches that `hits` lie on, each as long as it goes."""
        order = np.lexsort((q, at - q))
        q, at = q[order], at[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1] + 1) | (at[1:] != at[:-1] + 1) | (queries.of[q[1:]] != queries.of[q[:-1]]) | (self.of[at[1:]] != self.of[at[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(q)) - 1 if len(q) else first
        return q[first], at[first], last - first + queries.lengths[q[last]]


_FOUND = ["best_words", "best_start", "best_item", "best_item_start"]


def _find(batches, queries: Queries, all_rows: bool):
    """Per document: its words, where windows occur (first word, words), their items, and its longest match."""
    for batch in batches:
        for part in by_bytes(batch, "text"):
            shard = Shard(part.column("text"), queries)
            places: list[set] = [set() for _ in range(part.num_rows)]
            items: list[set] = [set() for _ in range(part.num_rows)]
            best: list[tuple] = [(0, None, None, None)] * part.num_rows
            q, at = shard.hits(queries)
            of, width, item, named = shard.of[at], queries.lengths[q], queries.items[q], queries.named[q]
            for i, f, w, k, z in zip(of.tolist(), (at - shard.words.bounds[of]).tolist(), width.tolist(), item.tolist(), named.tolist()):
                places[i].add((f, w))
                if z:
                    items[i].add(k)
            q, at, size = shard.longest(queries, q, at)
            of = shard.of[at]
            start = at - shard.words.bounds[of]
            # Of equally long ones the first in the document, then in the items with the least id.
            order = np.lexsort((queries.starts[q], queries.items[q], ~queries.named[q], start, -size, of))
            for r in order[np.flatnonzero(np.diff(of[order], prepend=-1))].tolist():
                name = int(queries.items[q[r]]) if queries.named[q[r]] else None
                best[of[r]] = (int(size[r]), int(start[r]), name, int(queries.starts[q[r]]))
            keep = [i for i in range(part.num_rows) if all_rows or places[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(keep, pa.int64())),
                    part.column("text_key").take(pa.array(keep, pa.int64())),
                    pa.array(shard.words.counts[keep].astype(np.int64)),
                    pa.array([[f for f, _ in sorted(places[i])] for i in keep], pa.list_(pa.int32())),
                    pa.array([[w for _, w in sorted(places[i])] for i in keep], pa.list_(pa.int32())),
                    pa.array([sorted(items[i]) for i in keep], pa.list_(pa.int64())),
                    *[pa.array([best[i][c] for i in keep], pa.int64()) for c in range(4)],
                ],
                ["doc_id", "text_key", "n_words", "firsts", "widths", "items", *_FOUND],
            )


def _verdicts(batches):
    for batch in batches:
        key = batch.column("text_key")
        batch = batch.drop_columns(["text_key"])
        out = []
        for row in batch.to_pylist():
            n, covered, end = row["n_words"], 0, -1
            for f, w in sorted(zip(row["firsts"], row["widths"])):
                covered += max(0, f + w - max(f, end))
                end = max(end, f + w)
            names = sorted({str(i) for i in row["items"]})
            digest = hashlib.sha256(",".join(names).encode()).hexdigest()
            out.append((row["doc_id"], n, covered, len(names), digest, covered > 0 and 20 * covered >= n))
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        match = ["longest_match", "match_start", "match_item", "match_item_start"]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, k) for c, k in zip(columns, kinds)], *[batch.column(c) for c in _FOUND], key], [*names, *match, "text_key"]
        )


def _item_matches(batches, queries: Queries):
    """Per batch of documents and item: its longest match there."""
    for batch in batches:
        for part in by_bytes(batch, "text"):
            shard = Shard(part.column("text"), queries, all_words=True)
            ids = part.column("doc_id").to_pylist()
            found: dict[int, tuple] = {}

            def offer(k: int, at: int, q: int, size: int) -> None:
                doc = ids[shard.of[at]]
                new = (-size, doc is None, doc or 0, int(at - shard.words.bounds[shard.of[at]]), int(queries.starts[q]))
                found[k] = min(found.get(k, new), new)

            for q, at, size in zip(*(x.tolist() for x in shard.longest(queries, *shard.hits(queries)))):
                offer(int(queries.items[q]), at, q, size)
            # Items without a window here: the suffix that goes on longest, at all its places.
            _, _, longest = shard.matches(queries)
            rest = [k for k in np.flatnonzero((longest > 0) & queries.named) if int(queries.items[k]) not in found]
            most: dict[int, int] = {}
            for k in rest:
                most[int(queries.items[k])] = max(most.get(int(queries.items[k]), 0), int(longest[k]))
            for k in rest:
                size = int(longest[k])
                if size < most[int(queries.items[k])]:
                    continue
                low, high = queries.keys[k : k + 1].copy(), queries.keys[k : k + 1].copy()
                low[:, size:], high[:, size:] = 0, 0xFFFFFFFF
                a, b = np.searchsorted(shard.sorted, _ordered(low)[0], "left"), np.searchsorted(shard.sorted, _ordered(high)[0], "right")
                for at in shard.at[a:b].tolist():
                    offer(int(queries.items[k]), at, k, size)
            named = {int(k) for k in queries.items[queries.named]}
            rows = [(k, -v[0], None if v[1] else v[2], v[3], v[4]) for k, v in found.items() if k in named]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "words", "doc_id", "start", "item_start"])


def _query_blocks(benchmark: DataFrame, width: int, limit: int):
    """Blocks of at most `limit` bytes of benchmark text, taken one after the other."""
    block: list[tuple[int | None, str | None]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    for item_id, text in rows.toLocalIterator():
        length = len((text or "").encode())
        if block and size + length > limit:
            yield Queries(block, width)
            block, size = [], 0
        block.append((item_id, text))
        size += length
    yield Queries(block, width)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """How much of each document is benchmark text.

    Words are runs of [0-9a-z] and of all that is not ASCII, lower-cased in A-Z. A
    window is `width` words of an item, or all of a shorter item that has any. Gives
    doc_id, n_words, n_hit (words in occurrences of windows), n_items, items_sha256
    (of the sorted item ids), contaminated (a twentieth of the words or more is hit)
    and the longest verbatim match that holds a window: longest_match (words; 0 where
    there is none), match_start (first word in the document), match_item, and
    match_item_start (first word in the item). Of equally long ones the first in the
    document counts, then the one of the least item_id.

    A null or empty text has no words and no hits. Items without item_id hit, but are
    not counted. Repeated items count once, repeated documents each. Empty tables give
    no rows, or no hits. Benchmarks of any size are searched for in blocks of
    `query_bytes`, which are all that is ever broadcast.
    """
    return _judged(docs, benchmark, width, query_bytes, F.xxhash64("text")).drop("text_key")


def _judged(docs: DataFrame, benchmark: DataFrame, width: int, query_bytes: int, text_key: Column) -> DataFrame:
    """The columns of `contamination`, and text_key: what tells the texts of repeated doc_ids apart, not null."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        text_key.alias("text_key"),
    )
    kind = rows.schema["text_key"].dataType.simpleString().replace("bigint", "long")
    schema = f"doc_id long, text_key {kind}, n_words long, firsts array<int>, widths array<int>, items array<long>"
    schema += "".join(f", {c} long" for c in _FOUND)
    sc = docs.sparkSession.sparkContext
    found = None
    for k, block in enumerate(_query_blocks(benchmark, width, query_bytes)):
        shared = sc.broadcast(block)
        more = rows.mapInArrow(lambda b, s=shared, first=k == 0: _find(b, s.value, first), schema)
        found = more if found is None else pin(found.unionByName(more), "hits")
    if k:
        flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
        order = F.struct(-F.col("best_words"), F.col("best_start"), F.col("best_item").isNull(), F.col("best_item"), F.col("best_item_start"))
        best = F.min_by(F.struct(*_FOUND), F.when(F.col("best_words") > 0, order)).alias("best")
        once = rows.groupBy("doc_id", "text_key").agg(F.count("*").cast("int").alias("copies"))
        found = (
            found.groupBy("doc_id", "text_key")
            .agg(F.max("n_words").alias("n_words"), flat("firsts"), flat("widths"), flat("items"), best)
            .withColumn("best_words", F.coalesce("best.best_words", F.lit(0).cast("long")))
            .select("*", *[F.col("best")[c].alias(c) for c in _FOUND[1:]])
            .join(once.withColumnsRenamed({"doc_id": "d", "text_key": "t"}), F.expr("doc_id <=> d AND text_key = t"))
            .select(F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), "*")
            .select("doc_id", "text_key", "n_words", "firsts", "widths", "items", *_FOUND)
        )
    kinds = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long"
    kinds += ", match_start long, match_item long, match_item_start long"
    kinds += f", text_key {kind}"
    return found.mapInArrow(_verdicts, kinds)


def longest_matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, words, doc_id, start, item_start): each item's longest verbatim match in all documents.

    Matches of any length count, down to one word; start and item_start are the first
    word in the document and in the item. Of equally long ones the least doc_id counts
    (a missing one last), then the first place. Items without item_id, without words or
    without a match give no row; several items of one item_id give one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    found = None
    for block in _query_blocks(benchmark, width, query_bytes):
        shared = sc.broadcast(block)
        more = rows.mapInArrow(lambda b, s=shared: _item_matches(b, s.value), "item_id long, words long, doc_id long, start long, item_start long")
        found = more if found is None else found.unionByName(more)
    order = F.struct(-F.col("words"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("start"), F.col("item_start"))
    best = found.groupBy("item_id").agg(F.min_by(F.struct("words", "doc_id", "start", "item_start"), order).alias("best"))
    return best.select("item_id", "best.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The documents that are not contaminated, each row judged by its own text.

    A row without doc_id is judged as well, and so is each of the rows of a repeated
    doc_id: clean ones stay. Texts are told apart by their SHA-256.
    """
    # A null text and an empty one have the same verdict.
    key = lambda text: F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)
    bad = _judged(docs, benchmark, width, query_bytes, key(F.col("text"))).where("contaminated").select("doc_id", "text_key").distinct()
    same = (key(F.col("docs.text")) == F.col("bad.text_key")) & F.col("docs.doc_id").cast("long").eqNullSafe(F.col("bad.doc_id"))
    return docs.alias("docs").join(bad.alias("bad"), same, "left_anti")
