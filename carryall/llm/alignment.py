"""Tokens of two tokenizers aligned over the same bytes, by lockstep merging.

The token ends of all documents of a block lie in two arrays, one a tokenizer. A state
vector holds, for every document, its place in either; a step compares all pending ends
at once and moves the pointer that is behind, or both where they meet. Each step gives
the links between the pending tokens and the cuts where both end; documents that are
through leave the vector. Long documents run in several lanes, whose start in the other
array is looked up.

How many documents hold a pair of ids is counted over the corpus. Blocks send their
distinct pairs by bucket, and meet there the counts of that bucket; what comes back are
sums a document. Counts are copied to as many tasks as the blocks need, never to all.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from carryall.llm.subwords import BYTE_BPE, _byte_letters, tokenizer_path
from carryall.llm.words import by_bytes
from carryall.sources.tables import pin

PIECE_BPE = "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
# Documents of a block; their numbers there take two bytes.
BLOCK_ROWS = 60_000
# Tokens of the first tokenizer in a lane.
LANE = 512
# Parts of the space of id pairs; blocks that meet one copy of a part's counts.
BUCKETS = 8
BLOCKS_A_COPY = 16
# Groups with more pairs than this are counted by distinct ids.
_LARGE = 4096


class Vocabularies:
    """Both tokenizers, and the bytes and lengths of all their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["id"] for t in file["added_tokens"]}
        back = {chr(letter): byte for byte, letter in _byte_letters().items()}
        vocabulary = {t: i for t, i in file["model"]["vocab"].items() if i not in special}
        # The ids of a byte-level vocabulary are the ranks of its merges.
        ranks = {bytes(back[c] for c in t): i for t, i in vocabulary.items()}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        # Each id as text with what may follow it: in A "," or "|", in B "," or ";".
        self.written = [f"{i}{mark}" for mark in ",|" for i in range(n_a)]
        self.written += [f"{i}{mark}" for mark in ",;" for i in range(self.n_b)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers; None where a text has none, or they do not spell it."""
        if not text:
            return None
        spaced = " " + text
        raw = spaced.encode()
        a = self.a.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        b = np.array(self.b.encode(text, num_threads=1), np.int64)
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(table.__getitem__, ids.tolist())) != raw:
                return None
        return a, b


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    key = (a_path, b_path)
    if key not in _LOADED:
        _LOADED[key] = Vocabularies(*key)
    return _LOADED[key]


def lockstep(a_ends, b_ends, a_bounds, b_bounds, lane: int = LANE):
    """Links (i, j) between overlapping tokens, and which tokens of A and B end a group.

    Ends are byte offsets that rise over all documents; document k has the tokens
    bounds[k] to bounds[k + 1], and either tokenizer ends it at the same byte.
    """
    lanes = -(-np.diff(a_bounds) // lane)
    first = np.cumsum(lanes) - lanes
    nth = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
    i = np.repeat(a_bounds[:-1], lanes) + nth * lane
    stop = np.minimum(i + lane, np.repeat(a_bounds[1:], lanes))
    j = np.repeat(b_bounds[:-1], lanes)
    inside = nth > 0
    j[inside] = np.searchsorted(b_ends, a_ends[i[inside] - 1], "right")
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    links = []
    while len(i):
        links.append((i, j))
        end_a, end_b = a_ends[i], b_ends[j]
        met = end_a == end_b
        a_cut[i[met]] = True
        b_cut[j[met]] = True
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return links, a_cut, b_cut


@dataclass
class Aligned:
    """A block of texts: ids of both tokenizers in one array each, and the groups.

    Text k has the tokens a_bounds[k] to a_bounds[k + 1] of `a`, and so in `b`, and the
    groups bounds[k] to bounds[k + 1]; a group ends before a_stops and b_stops.
    """

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_stops: np.ndarray
    b_stops: np.ndarray
    bounds: np.ndarray
    links: list[tuple[np.ndarray, np.ndarray]]

    def __post_init__(self) -> None:
        self.a_sizes = np.diff(self.a_stops, prepend=0)
        self.b_sizes = np.diff(self.b_stops, prepend=0)

    def texts_of(self, groups: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, groups, "right") - 1


def aligned(texts: list[str | None], vocab: Vocabularies, lane: int = LANE) -> Aligned:
    """Texts that are null, empty or not spelled by both tokenizers have no tokens."""
    none = np.zeros(0, np.int64)
    pairs = [vocab.tokens(t) or (none, none) for t in texts]
    a = np.concatenate([none, *[p[0] for p in pairs]])
    b = np.concatenate([none, *[p[1] for p in pairs]])
    a_bounds = np.concatenate(([0], np.cumsum([len(p[0]) for p in pairs], dtype=np.int64)))
    b_bounds = np.concatenate(([0], np.cumsum([len(p[1]) for p in pairs], dtype=np.int64)))
    links, a_cut, b_cut = lockstep(np.cumsum(vocab.a_sizes[a]), np.cumsum(vocab.b_sizes[b]), a_bounds, b_bounds, lane)
    a_stops, b_stops = np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1
    return Aligned(a, b, a_bounds, b_bounds, a_stops, b_stops, np.searchsorted(a_stops, a_bounds, "right"), links)


def linked_pairs(block: Aligned, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, id pair, number of links), each text and pair once, sorted by pair and text.

    A pair is the number id_a * n_b + id_b. Where a group has one token on a side, its
    links are those of the steps; else every token of A goes with every token of B.
    """
    wide = (block.a_sizes > 1) & (block.b_sizes > 1)
    products = block.a_sizes * block.b_sizes
    small = np.flatnonzero(wide & (products <= _LARGE))
    texts, pairs, numbers = [], [], []

    def add(i, j, group, times=None):
        texts.append(block.texts_of(group))
        pairs.append(block.a[i] * n_b + block.b[j])
        numbers.append(np.ones(len(i), np.int64) if times is None else times)

    if block.links:
        i = np.concatenate([x for x, _ in block.links])
        j = np.concatenate([y for _, y in block.links])
        group = np.searchsorted(block.a_stops, i, "right")
        simple = ~wide[group]
        add(i[simple], j[simple], group[simple])
    if len(small):
        n = products[small]
        group = np.repeat(small, n)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        i = block.a_stops[group] - block.a_sizes[group] + nth // block.b_sizes[group]
        j = block.b_stops[group] - block.b_sizes[group] + nth % block.b_sizes[group]
        add(i, j, group)
    for g in np.flatnonzero(wide & (products > _LARGE)):
        ids_a, times_a = np.unique(block.a[block.a_stops[g] - block.a_sizes[g] : block.a_stops[g]], return_counts=True)
        ids_b, times_b = np.unique(block.b[block.b_stops[g] - block.b_sizes[g] : block.b_stops[g]], return_counts=True)
        times = np.outer(times_a, times_b).ravel()
        texts.append(np.full(len(times), block.texts_of(np.array([g]))[0]))
        pairs.append((ids_a[:, None] * n_b + ids_b).ravel())
        numbers.append(times)
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none
    text, pair, number = np.concatenate(texts), np.concatenate(pairs), np.concatenate(numbers)
    key = pair << 16 | text
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[starts] & 0xFFFF, key[starts] >> 16, np.add.reduceat(number[order], starts)


def written_groups(block: Aligned, vocab: Vocabularies) -> list[str]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`."""
    n_a = len(vocab.a_bytes)
    a_ends, b_ends = np.zeros(len(block.a), np.int64), np.zeros(len(block.b), np.int64)
    a_ends[block.a_stops - 1] = n_a
    b_ends[block.b_stops - 1] = vocab.n_b
    # A group's tokens of A stand before its tokens of B, all groups one after the other.
    before_b = np.repeat(block.b_stops - block.b_sizes, block.a_sizes)
    before_a = np.repeat(block.a_stops, block.b_sizes)
    codes = np.zeros(len(block.a) + len(block.b), np.int64)
    codes[np.arange(len(block.a)) + before_b] = block.a + a_ends
    codes[np.arange(len(block.b)) + before_a] = 2 * n_a + block.b + b_ends
    codes = codes.tolist()
    word = vocab.written.__getitem__
    bounds = (block.a_bounds + block.b_bounds).tolist()
    # The mark after the last group goes.
    return ["".join(map(word, codes[x:y]))[:-1] for x, y in zip(bounds, bounds[1:])]


def _blocks(batches):
    for batch in batches:
        for part in by_bytes(batch, "text", BLOCK_BYTES):
            for at in range(0, part.num_rows, BLOCK_ROWS):
                yield part.slice(at, BLOCK_ROWS)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignments(docs: DataFrame, a_tokenizer: str = BYTE_BPE, b_tokenizer: str = PIECE_BPE) -> DataFrame:
    """doc_id, a_ids, b_ids, a_stops, b_stops: the tokens of each text and where groups stop.

    Group g has the tokens of A before a_stops[g] that follow a_stops[g - 1], and so in
    B. A text that is null, empty, or not spelled by either tokenizer's tokens has empty
    arrays. Texts of any length are aligned whole; a text longer than a block is a block.
    Repeated rows and rows without doc_id are aligned each. Other columns are not read.
    """
    a_path, b_path = tokenizer_path(a_tokenizer), tokenizer_path(b_tokenizer)

    def of(batches):
        vocab = vocabularies(a_path, b_path)
        for part in _blocks(batches):
            block = aligned(part.column(1).to_pylist(), vocab)
            groups, n = block.bounds, part.num_rows
            a_from = np.repeat(block.a_bounds[:-1], np.diff(groups))
            b_from = np.repeat(block.b_bounds[:-1], np.diff(groups))

            def lists(values, bounds):
                return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))

            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    lists(block.a, block.a_bounds),
                    lists(block.b, block.b_bounds),
                    lists(block.a_stops - a_from, groups),
                    lists(block.b_stops - b_from, groups),
                ],
                ["doc_id", "a_ids", "b_ids", "a_stops", "b_stops"],
            )

    return _rows(docs).mapInArrow(
        of, "doc_id long, a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>"
    )


_FOUND = (
    "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "bucket int, pairs array<long>, held array<int>, docs binary, times binary, many binary"
)


def _found(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each document, and one for each block and bucket with its pairs.

    A pair of a block has the number of documents that hold it (held), and for each of
    those its number in the block (docs) and how often it is linked there (times; from
    255 on, place and number are in `many`).
    """

    def of(batches):
        vocab = vocabularies(a_path, b_path)
        serial = TaskContext.get().partitionId() << 32
        for part in _blocks(batches):
            block = aligned(part.column(1).to_pylist(), vocab)
            n = part.num_rows
            sums = np.concatenate(([0], np.cumsum(block.a_sizes * block.b_sizes)))
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in written_groups(block, vocab)]
            counts = [np.diff(x) for x in (block.a_bounds, block.b_bounds, block.bounds, sums[block.bounds])]
            yield _batch(
                block=np.full(n, serial), place=np.arange(n), doc_id=part.column(0),
                n_a=counts[0], n_b=counts[1], n_groups=counts[2], n_links=counts[3], groups_sha256=digests,
            )
            text, pair, times = linked_pairs(block, vocab.n_b)
            bucket = _bucket(pair, vocab.n_b)
            messages = []
            for k in range(BUCKETS):
                mine = bucket == k
                if mine.any():
                    messages.append((k, *_message(text[mine], pair[mine], times[mine])))
            if messages:
                number, pairs, held, docs_, times_, many = zip(*messages)
                yield _batch(
                    block=np.full(len(messages), serial), bucket=number, pairs=pairs, held=held,
                    docs=docs_, times=times_, many=many,
                )
            serial += 1

    return _rows(docs).mapInArrow(of, _FOUND)


_KINDS = {
    "block": pa.int64(), "place": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "bucket": pa.int32(),
    "pairs": pa.list_(pa.int64()), "held": pa.list_(pa.int32()), "docs": pa.binary(), "times": pa.binary(), "many": pa.binary(),
}


def _batch(**columns) -> pa.RecordBatch:
    n = len(columns["block"])
    made = [
        pa.nulls(n, kind) if name not in columns
        else columns[name] if isinstance(columns[name], pa.Array)
        else pa.array(columns[name], kind)
        for name, kind in _KINDS.items()
    ]
    return pa.RecordBatch.from_arrays(made, list(_KINDS))


def _bucket(pair: np.ndarray, n_b: int) -> np.ndarray:
    """All pairs of one id of A are in one bucket."""
    return (pair // n_b * 2_654_435_761 & 0xFFFFFFFF) * BUCKETS >> 32


def _message(text: np.ndarray, pair: np.ndarray, times: np.ndarray):
    starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    held = np.diff(np.append(starts, len(pair)))
    over = np.flatnonzero(times >= 255)
    many = np.concatenate((over, times[over])).astype("<i8").tobytes()
    return pair[starts], held, text.astype("<u2").tobytes(), np.minimum(times, 255).astype("u1").tobytes(), many


def _answers(key, asked: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document whose pairs lie in one bucket."""
    order = np.argsort(counts["pair"].to_numpy())
    known, n, best = (counts[c].to_numpy()[order] for c in ("pair", "n", "best"))
    out = []
    for row in asked.select(["block", "pairs", "held", "docs", "times", "many"]).to_batches(max_chunksize=1):
        block, pairs, held, docs, times, many = (c[0] for c in row.columns)
        at = np.searchsorted(known, pairs.values.to_numpy())
        held = held.values.to_numpy()
        docs = np.frombuffer(docs.as_py(), "<u2").astype(np.int64)
        times = np.frombuffer(times.as_py(), "u1").astype(np.int64)
        where, number = np.split(np.frombuffer(many.as_py(), "<i8"), 2)
        times[where] = number
        sums = np.zeros((2, int(docs.max()) + 1), np.int64)
        np.add.at(sums[0], docs, times * np.repeat(n[at], held))
        np.add.at(sums[1], docs, times * np.repeat(best[at], held))
        place = np.unique(docs)
        out.append((np.full(len(place), block.as_py()), place, sums[0][place], sums[1][place]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pa.table(
        [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
        ["block", "place", "count_sum", "n_best"],
    )


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """pair, bucket, n (documents that hold it linked), best (1: no pair of its A id has more)."""
    each = found.where("bucket is not null").select("bucket", F.inline(F.arrays_zip("pairs", "held")))
    counts = each.groupBy("bucket", F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    counts = pin(counts, "pairs")
    first = F.floor(F.col("pair") / n_b)
    top = counts.groupBy(first.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", first).join(top, "a").select(
        "bucket", "pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")
    )


def link_counts(docs: DataFrame, a_tokenizer: str = BYTE_BPE, b_tokenizer: str = PIECE_BPE) -> DataFrame:
    """Per document its tokens, groups and links, and how common these are in the corpus.

    Gives doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A text
    that is null, empty, or not spelled by both tokenizers' tokens gives zeros and ''. A
    document of many links of one pair counts once for it; repeated rows and rows without
    doc_id count each. Of pairs that are equally common, all are the best of their id. An
    empty table gives no rows. Other columns are not read.
    """
    a_path, b_path = tokenizer_path(a_tokenizer), tokenizer_path(b_tokenizer)
    n_b = vocabularies(a_path, b_path).n_b
    found = pin(_found(docs, a_path, b_path), "links")
    asked = found.where("bucket is not null")
    copies = max(1, asked.select("block").distinct().count() // BLOCKS_A_COPY)
    copy = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int")
    counts = pair_counts(found, n_b).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    sums = (
        asked.withColumn("copy", copy)
        .groupBy("bucket", "copy")
        .cogroup(counts.groupBy("bucket", "copy"))
        .applyInArrow(_answers, "block long, place int, count_sum long, n_best long")
        .groupBy("block", "place")
        .agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    )
    none = F.lit(0).cast("long")
    return found.where("bucket is null").join(sums, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
