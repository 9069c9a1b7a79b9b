"""Long passages that repeat across documents, by de Bruijn graphs of words.

Every run of 13 consecutive words is an edge between the 12 words it begins and ends
with. Edges of one document only are left out by a sketch that is exchanged first.
The others get their source: the first place, by doc_id, where the edge starts.
Within a document, edges whose sources follow each other compact to spans; over all
documents, spans whose ends meet in a node with one way in and one way out compact to
paths, through joins. The coordinates of a span say where its source can be read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carryall.llm.blocks import BLOCK_BYTES, count_blocks, in_blocks, parts, runs
from carryall.llm.components import connected_components
from carryall.llm.words import Words, inner, split, windows
from carryall.sources.tables import pin

WIDTH = 13
# Multipliers of the numbers of edges: one for order and bucket, one to tell apart.
_ONE = 0xD6E8FEB86659FD93
_TWO = 0xA0761D6478BD642F
_LOW = np.uint64(0xFFFFFFFF)

_BODY = "block int, bucket int, body binary"
_ASKED = "block int, bucket int, ones binary, twos binary, docs binary, places binary"
_TOLD = "block int, bucket int, body binary, docs binary, places binary"
_SPANS = "array<struct<start:int,length:int,source:long,source_start:int,first_node:long,last_node:long>>"
_OUT = f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, spans {_SPANS}"


def _sorted_docs(table: pa.Table) -> pa.Table:
    """Rows of a block in order of doc_id, then text; nulls last."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


class _Edges:
    """All edges of a block's documents, in the order of their starts."""

    def __init__(self, table: pa.Table, width: int) -> None:
        self.words: Words = split(table["text"])
        known = table["doc_id"].is_valid().to_numpy()
        self.doc_ids = table["doc_id"].fill_null(0).to_numpy()
        ok = inner(self.words, width)
        of = self.words.text_of()
        self.at = np.flatnonzero(ok)
        self.at = self.at[known[of[self.at]]]
        self.row = of[self.at]
        self.place = self.at - self.words.bounds[self.row]
        self.one = windows(self.words.hashes, width, _ONE)[self.at]

    def sketch(self, n_buckets: int) -> np.ndarray:
        """bucket << 32 | the lower half of each edge's number."""
        return (((self.one >> np.uint64(32)) % np.uint64(n_buckets)) << np.uint64(32)) | (self.one & _LOW)


def _send_sketch(table: pa.Table, n_buckets: int, width: int) -> pa.Table:
    keys = np.unique(_Edges(table, width).sketch(n_buckets))
    starts, ends = runs(keys >> np.uint64(32))
    low = keys.astype(np.uint32)
    return pa.table(
        {
            "block": pa.array(np.full(len(starts), table["block"][0].as_py(), np.int32)),
            "bucket": pa.array((keys[starts] >> np.uint64(32)).astype(np.int32)),
            "body": pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        }
    )


def _shared_sketch(table: pa.Table) -> pa.Table:
    """Per block, the values of a bucket that other blocks have as well."""
    values, of = parts(table["body"].to_pylist(), np.uint32)
    order = np.argsort(values, kind="stable")
    starts, ends = runs(values[order])
    many = np.repeat(ends - starts > 1, ends - starts)
    shared = np.zeros(len(values), bool)
    shared[order] = many
    values, of = values[shared], of[shared]
    a, b = runs(of)
    return pa.table(
        {
            "block": table["block"].take(pa.array(of[a])),
            "bucket": table["bucket"].take(pa.array(of[a])),
            "body": pa.array([values[i:j].tobytes() for i, j in zip(a, b)], pa.binary()),
        }
    ).cast(pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())]))


def _candidates(edges: _Edges, shared: pa.Table, n_buckets: int):
    """Edges that may start in several documents, and of those with one number the first.

    Gives (edges, the group of each, the first edge of each group); groups are in the
    order of bucket and number, the same whenever they are made.
    """
    low, of = parts(shared["body"].to_pylist(), np.uint32)
    told = np.sort((shared["bucket"].to_numpy()[of].astype(np.uint64) << np.uint64(32)) | low)
    key = edges.sketch(n_buckets)
    order = np.argsort(key, kind="stable")
    starts, ends = runs(key[order])
    hit = np.zeros(len(key), bool)
    hit[order] = np.repeat(ends - starts > 1, ends - starts)
    if len(told):
        near = np.minimum(np.searchsorted(told, key), len(told) - 1)
        hit |= told[near] == key
    found = np.flatnonzero(hit)
    bucket = key[found] >> np.uint64(32)
    order = np.lexsort((edges.one[found], bucket))
    found = found[order]
    bounds = np.concatenate(([True], edges.one[found][1:] != edges.one[found][:-1])) if len(found) else np.zeros(0, bool)
    return found, np.cumsum(bounds) - 1, found[bounds]


def _ask(docs: pa.Table, shared: pa.Table, n_buckets: int, width: int) -> pa.Table:
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in ("ones", "twos", "docs", "places")])
    if not docs.num_rows:
        return schema.empty_table()
    edges = _Edges(_sorted_docs(docs), width)
    _, _, first = _candidates(edges, shared, n_buckets)
    two = windows(edges.words.hashes, width, _TWO)[edges.at[first]].astype(np.uint32)
    bucket = edges.sketch(n_buckets)[first] >> np.uint64(32)
    starts, ends = runs(bucket)
    cuts = [slice(a, b) for a, b in zip(starts, ends)]
    body = lambda values: pa.array([values[c].tobytes() for c in cuts], pa.binary())
    return pa.table(
        [
            pa.array(np.full(len(cuts), docs["block"][0].as_py(), np.int32)),
            pa.array(bucket[starts].astype(np.int32)),
            body(edges.one[first]),
            body(two),
            body(edges.doc_ids[edges.row[first]]),
            body(edges.place[first].astype(np.uint32)),
        ],
        schema=schema,
    )


def _tell(table: pa.Table) -> pa.Table:
    """Per block and asked edge, the first place over all blocks, where it is another block's."""
    one, of = parts(table["ones"].to_pylist(), np.uint64)
    two, _ = parts(table["twos"].to_pylist(), np.uint32)
    doc, _ = parts(table["docs"].to_pylist(), np.int64)
    place, _ = parts(table["places"].to_pylist(), np.uint32)
    order = np.lexsort((place, doc, two, one))
    new = np.ones(len(one), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    first = np.empty(len(one), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))]
    index = np.arange(len(one)) - np.searchsorted(of, of)
    told = np.flatnonzero(of[first] != of)
    a, b = runs(of[told])
    cuts = [told[i:j] for i, j in zip(a, b)]
    body = lambda values: pa.array([x.tobytes() for x in values], pa.binary())
    at = pa.array(of[told][a])
    return pa.table(
        {
            "block": table["block"].take(at),
            "bucket": table["bucket"].take(at),
            "body": body(index[c].astype(np.uint32) for c in cuts),
            "docs": body(doc[first[c]] for c in cuts),
            "places": body(place[first[c]] for c in cuts),
        }
    ).cast(pa.schema([("block", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in ("body", "docs", "places")]))


def _spans(edges: _Edges, row: np.ndarray, place: np.ndarray, source: np.ndarray, source_place: np.ndarray, width: int):
    """Runs of edges that follow each other both in a document and in its source."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (source[1:] != source[:-1]) | (source_place[1:] != source_place[:-1] + 1)
    a, b = runs(np.cumsum(new))
    node = windows(edges.words.hashes, width - 1, _ONE).view(np.int64)
    at = edges.words.bounds[row] + place
    return {
        "row": row[a],
        "start": place[a],
        "length": b - a + width - 1,
        "source": source[a],
        "source_start": source_place[a],
        "first_node": node[at[a]],
        "last_node": node[at[b - 1] + 1] if len(a) else np.zeros(0, np.int64),
    }


def _remove(docs: pa.Table, got: pa.Table, n_buckets: int, width: int, names: list[str]) -> pa.Table:
    kind = got["told"].to_numpy(zero_copy_only=False).astype(bool) if got.num_rows else np.zeros(0, bool)
    shared, told = got.filter(pa.array(~kind)), got.filter(pa.array(kind))
    docs = _sorted_docs(docs)
    edges = _Edges(docs, width)
    words = edges.words
    found, group, first = _candidates(edges, shared, n_buckets)
    source = edges.doc_ids[edges.row[first]].copy()
    source_place = edges.place[first].copy()
    if told.num_rows:
        starts, _ = runs(edges.sketch(n_buckets)[first] >> np.uint64(32))
        begin = dict(zip((edges.sketch(n_buckets)[first[starts]] >> np.uint64(32)).tolist(), starts.tolist()))
        asked, of = parts(told["body"].to_pylist(), np.uint32)
        at = np.array([begin[b] for b in told["bucket"].to_pylist()], np.int64)[of] + asked
        source[at], _ = parts(told["docs"].to_pylist(), np.int64)
        source_place[at], _ = parts(told["places"].to_pylist(), np.uint32)
    mine = edges.doc_ids[edges.row[found]]
    again = source[group] < mine
    order = np.argsort(found[again])
    found, group = found[again][order], group[again][order]
    at = edges.at[found]
    change = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    gone = np.cumsum(change[:-1]) > 0
    span = _spans(edges, edges.row[found], edges.place[found], source[group], source_place[group], width)
    begins = np.searchsorted(span["row"], np.arange(docs.num_rows + 1))
    struct = pa.StructArray.from_arrays(
        [pa.array(span[c].astype(t)) for c, t in (("start", np.int32), ("length", np.int32), ("source", np.int64), ("source_start", np.int32), ("first_node", np.int64), ("last_node", np.int64))],
        names=["start", "length", "source", "source_start", "first_node", "last_node"],
    )
    removed = np.concatenate(([0], np.cumsum(gone)))
    n_removed = removed[words.bounds[1:]] - removed[words.bounds[:-1]]
    digests, texts = [], []
    data = words.buffer.tobytes()
    for i, text in enumerate(docs["text"]):
        part = slice(words.bounds[i], words.bounds[i + 1])
        stay = ~gone[part]
        kept = b" ".join([data[a:b] for a, b in zip(words.starts[part][stay].tolist(), words.ends[part][stay].tolist())])
        digests.append(hashlib.sha256(kept).hexdigest())
        texts.append(kept.decode() if n_removed[i] else None)
    out = pa.table(
        {
            "doc_id": docs["doc_id"],
            "n_words": words.counts.astype(np.int64),
            "n_removed": n_removed.astype(np.int64),
            "kept_sha256": pa.array(digests, pa.string()),
            "kept_text": pa.array(texts, pa.string()),
            "spans": pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), struct),
        }
    )
    for name in names[out.num_columns :]:
        out = out.append_column(name, docs[name])
    return out


def repeated_words(docs: DataFrame, width: int = WIDTH, carry: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of each document repeat a document with a smaller doc_id.

    A word is removed if it lies in a run of `width` words that also starts in a
    document with a smaller doc_id; all runs are judged on the input. Gives doc_id,
    n_words, n_removed, kept_sha256 (of the kept words, joined by one space),
    kept_text (the same words; null where nothing is removed) and the spans: start
    and length in words, the source document and its first word, the numbers of the
    nodes at both ends. With `carry`, `rest` holds all columns of the row.

    A null or empty text has no words. A row without doc_id neither removes words nor
    loses any. Rows with one doc_id do not remove each other's words. Edges are told
    apart by 64 bits inside a block and by 96 between blocks. An empty table gives none.
    """
    n = count_blocks(docs, block_bytes)
    blocked = in_blocks(docs, n, carry)
    by_block = lambda df: df.groupBy("block")
    sketch = by_block(blocked).applyInArrow(lambda t: _send_sketch(t, n, width), _BODY)
    shared = sketch.groupBy("bucket").applyInArrow(_shared_sketch, _BODY)
    asked = by_block(blocked).cogroup(by_block(shared)).applyInArrow(lambda d, s: _ask(d, s, n, width), _ASKED)
    told = asked.groupBy("bucket").applyInArrow(_tell, _TOLD)
    none = F.lit(None).cast("binary")
    got = shared.select("block", "bucket", "body", none.alias("docs"), none.alias("places"), F.lit(False).alias("told")).unionByName(
        told.withColumn("told", F.lit(True))
    )
    out = T.StructType.fromDDL(_OUT)
    if carry:
        out = out.add("rest", blocked.schema["rest"].dataType)
    names = out.names
    return by_block(blocked).cogroup(by_block(got)).applyInArrow(lambda d, g: _remove(d, g, n, width, names), out)


def compacted_paths(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repeated paths, and their occurrences, from the spans of `repeated_words`.

    First the occurrences: doc_id, start, length, path. Then the paths: path, n_spans
    (distinct spans of sources it is made of), n_words. Spans that meet in a node
    where just one distinct span ends and just one begins lie on one path.
    """
    flat = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    spot = ["source", "source_start", "length", "first_node", "last_node"]
    flat = flat.withColumn("span", F.xxhash64(*spot))
    spans = pin(flat.groupBy("span", "length", "first_node", "last_node").agg(F.count("*").alias("copies")), "spans")
    end = spans.groupBy(F.col("last_node").alias("node")).agg(F.count("*").alias("n_in"), F.min("span").alias("a"))
    begin = spans.groupBy(F.col("first_node").alias("node")).agg(F.count("*").alias("n_out"), F.min("span").alias("b"))
    links = end.join(begin, "node").where("n_in = 1 AND n_out = 1").select("a", "b")
    found_paths = connected_components(links)
    named = spans.join(found_paths, spans["span"] == found_paths["node"], "left").select(
        "span", "length", F.coalesce("component", "span").alias("path")
    )
    named = pin(named, "paths")
    occurrences = flat.join(named.select("span", "path"), "span").select("doc_id", "start", "length", "path")
    return occurrences, named.groupBy("path").agg(F.count("*").alias("n_spans"), F.sum("length").cast("long").alias("n_words"))


def repeats_with_paths(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`repeated_words` (without text), with the paths of each document.

    n_paths: distinct repeated paths that it lies on; longest_span: words of its
    longest span that follows one source.
    """
    found = pin(repeated_words(docs, width).drop("kept_text"), "repeats")
    occurrences, _ = compacted_paths(found)
    on = occurrences.groupBy("doc_id").agg(
        F.count_distinct("path").alias("n_paths"), F.max("length").cast("long").alias("longest_span")
    )
    return found.drop("spans").join(on, "doc_id", "left").fillna(0, ["n_paths", "longest_span"])


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without words that repeat an earlier document.

    A text that loses words keeps the others, joined by one space; one that loses all
    of them goes. `n_chars`, if there is such a column, follows the text.
    """
    found = repeated_words(docs, width, carry=True)
    text = F.coalesce("kept_text", "rest.text").alias("text")
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text)
        elif c == "n_chars":
            size = F.when(F.col("kept_text").isNotNull(), F.char_length("kept_text")).otherwise(F.col("rest")[c])
            columns.append(size.cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("rest")[c].alias(c))
    return found.where("n_removed = 0 OR n_removed < n_words").select(*columns)
