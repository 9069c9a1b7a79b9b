"""Language of texts by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, found by a forward pass
over its bytes; a text's is the product over its words. The piece probabilities are
trained by expectation maximisation, in which every segmentation counts by its share.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from carryall.llm.quality import remainder
from carryall.llm.subwords import tokenizer_path
from carryall.llm.words import BLANK, by_bytes, mix, split

VOCABULARY = "piece_bpe_32k.model"
# Training documents of a language, at most about.
TRAINED = 1_000
ROUNDS = 3
# Bytes of equally long words that are taken together.
_CELLS = 1 << 19
UNKNOWN = "und"
# Distinct words whose probabilities a worker remembers.
_REMEMBERED = 300_000
_LETTER = re.compile(r"[^\W\d_]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_pieces(path: str) -> list[bytes]:
    """All pieces as bytes, lower-cased, word beginnings marked by a space; and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for k in range(model.get_piece_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
            piece = model.id_to_piece(k).replace("▁", " ").lower().encode()
            # Words hold no blank but the one that marks their beginning.
            if piece and b" " not in piece[1:]:
                found.add(piece)
    return sorted(found)


class Pieces:
    """Looks up runs of bytes among the pieces, a column at a time."""

    def __init__(self, pieces: list[bytes]) -> None:
        keys = np.array([self._key(np.frombuffer(p, np.uint8)[None, :]) for p in pieces], np.uint64).reshape(-1)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.some = np.zeros(1 << 22, bool)
        self.some[self._slot(keys)] = True
        #: Where runs that some longer piece begins with may be.
        self.more = np.zeros(1 << 22, bool)
        for begun in {p[:k] for p in pieces for k in range(1, len(p))}:
            self.more[self._slot(self._key(np.frombuffer(begun, np.uint8)[None, :]))] = True
        self.longest = max(map(len, pieces))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(42)).astype(np.int64)

    @staticmethod
    def _key(runs: np.ndarray) -> np.ndarray:
        h = np.zeros(len(runs), np.uint64)
        for k in range(runs.shape[1]):
            h = (h + runs[:, k]) * _FACTOR
            h ^= h >> np.uint64(29)
        return mix(h)

    def edges(self, words: np.ndarray, sizes: np.ndarray):
        """(start, [(end, rows, pieces)]) for each start: the rows that have a piece there.

        A row of `words` is a word of sizes[row] bytes; rows ascend by size.
        """
        for start in range(words.shape[1]):
            rows = np.arange(np.searchsorted(sizes, start, "right"), len(words))
            h = np.zeros(len(rows), np.uint64)
            found = []
            for end in range(start + 1, min(words.shape[1], start + self.longest) + 1):
                inside = np.searchsorted(sizes[rows], end)
                rows, h = rows[inside:], h[inside:]
                h = (h + words[rows, end - 1]) * _FACTOR
                h ^= h >> np.uint64(29)
                key = mix(h)
                slot = self._slot(key)
                some = np.flatnonzero(self.some[slot])
                if len(some):
                    at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
                    ok = self.keys[at] == key[some]
                    if ok.any():
                        found.append((end, rows[some[ok]], self.order[at[ok]]))
                go = self.more[slot]
                rows, h = rows[go], h[go]
                if not len(rows):
                    break
            yield start, found


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    #: Probabilities: a row per piece, a column per language.
    p: np.ndarray

    def words(self, words: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """Log probability of words (rows of bytes, ascending by size) in each language.

        Forward values are kept as logarithms, and only for as many places as the
        longest piece has bytes; so words of any length are summed over whole.
        """
        n, length = words.shape
        sizes = np.full(n, length) if sizes is None else sizes
        places = self.pieces.longest + 1
        logs = np.log(self.p)
        alpha = np.full((min(places, length + 1), n, self.p.shape[1]), -np.inf)
        places = len(alpha)
        alpha[0] = 0
        out = np.zeros((n, self.p.shape[1]))
        # All pieces that end at a start begin before it, so it is complete by then.
        for start, found in self.pieces.edges(words, sizes):
            here = alpha[start % places].copy()
            alpha[start % places] = -np.inf
            for end, rows, ids in found:
                alpha[end % places, rows] = np.logaddexp(alpha[end % places, rows], here[rows] + logs[ids])
            ended = slice(*np.searchsorted(sizes, [start + 1, start + 2]))
            out[ended] = alpha[(start + 1) % places, ended]
        return out


def by_size(words: list[bytes]):
    """(indices, rows of bytes, sizes) of words of about one length, ascending by size; rows are padded."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    ascending = sizes[order]
    a = 0
    while a < len(order):
        limit = ascending[a] + ascending[a] // 4
        b = min(int(np.searchsorted(ascending, limit, "right")), a + max(1, _CELLS // int(limit)))
        some = order[a:b]
        rows = np.zeros((len(some), ascending[b - 1]), np.uint8)
        rows[np.arange(rows.shape[1]) < ascending[a:b, None]] = np.frombuffer(b"".join([words[k] for k in some]), np.uint8)
        yield some, rows, ascending[a:b]
        a = b


def train_pieces(pieces: Pieces, n_pieces: int, words: list[bytes], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from words and their counts."""
    groups = []
    for at, rows, sizes in by_size([b" " + w for w in words]):
        groups.append((counts[at].astype(np.float64), list(pieces.edges(rows, sizes)), sizes))
    p = np.full(n_pieces, 1.0)
    for k in range(rounds + 1):
        expected = np.zeros(n_pieces)
        logs = np.log(p)
        for w, edges, sizes in groups:
            if k == 0:
                for _, found in edges:
                    for _, rows, ids in found:
                        np.add.at(expected, ids, w[rows])
                continue
            each = np.arange(len(w))
            alpha, beta = np.full((sizes[-1] + 1, len(w)), -np.inf), np.full((sizes[-1] + 1, len(w)), -np.inf)
            alpha[0], beta[sizes, each] = 0, 0
            for start, found in edges:
                for end, rows, ids in found:
                    alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + logs[ids])
            for start, found in reversed(edges):
                for end, rows, ids in found:
                    beta[start, rows] = np.logaddexp(beta[start, rows], beta[end, rows] + logs[ids])
            total = alpha[sizes, each]
            for start, found in edges:
                for end, rows, ids in found:
                    share = np.exp(alpha[start, rows] + logs[ids] + beta[end, rows] - total[rows])
                    np.add.at(expected, ids, share * w[rows])
        p = (expected + 0.01) / (expected.sum() + 0.01 * n_pieces)
    return p


def train(docs: DataFrame, vocabulary: str = VOCABULARY, bound: int = TRAINED) -> Model:
    """A model from texts whose lang is known and whose id's crc32 modulo 4 is not 2.

    At most about `bound` documents of each language, drawn by a hash of their ids.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    known = known.where(remainder(F.col("doc_id"), 4) != 2)
    sizes = {r["lang"]: r["n"] for r in known.drop("text").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    limits = docs.sparkSession.createDataFrame([(k, int(min(1.0, bound / n) * (1 << 30))) for k, n in sizes.items()], "lang string, most long")
    # A row a language, as many as the model has: texts stay where they are.
    drawn = known.join(F.broadcast(limits), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("most")).select("lang", "text")

    def count(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                langs = part.column("lang").to_pylist()
                words = split(pc.utf8_lower(part.column("text")), BLANK)
                of = words.text_of()
                names = sorted(set(langs))
                code = np.array([names.index(x) for x in langs], np.uint64)[of]
                _, at, n = np.unique(words.hashes ^ mix(code), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[c] for c in code[at]], pa.string()), pa.array([words.raw(k) for k in at], pa.binary()), pa.array(n.astype(np.int64))],
                    ["lang", "word", "n"],
                )

    counted = drawn.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = counted.toArrow().sort_by([("lang", "ascending"), ("word", "ascending")])
    pieces = vocabulary_pieces(tokenizer_path(vocabulary))
    found = Pieces(pieces)
    languages = sorted(set(table["lang"].to_pylist()))
    columns = []
    for name in languages:
        part = table.filter(pc.equal(table["lang"], name))
        columns.append(train_pieces(found, len(pieces), part["word"].to_pylist(), part["n"].to_numpy()))
    return Model(languages, found, np.stack(columns, axis=1) if columns else np.zeros((len(pieces), 0)))


class _Memory:
    """Log probabilities of the words that a worker has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.keys = np.zeros(0, np.uint64)
        self.logs = np.zeros((0, len(model.languages)), np.float32)

    def of(self, words, keys: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Rows for distinct `keys`; firsts: a place of each in `words`."""
        at = np.searchsorted(self.keys, keys)
        at = np.minimum(at, max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.zeros((len(keys), len(self.model.languages)))
        out[known] = self.logs[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            spelled = [b" " + words.raw(k) for k in firsts[new]]
            for some, rows, sizes in by_size(spelled):
                out[new[some]] = self.model.words(rows, sizes)
            if len(self.keys) + len(new) > _REMEMBERED:
                self.keys, self.logs = self.keys[:0], self.logs[:0]
            keys_, logs_ = np.concatenate((self.keys, keys[new])), np.concatenate((self.logs, out[new].astype(np.float32)))
            order = np.argsort(keys_)
            self.keys, self.logs = keys_[order], logs_[order]
        return out


def predict(texts, memory: _Memory) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability, languages equally likely beforehand."""
    model = memory.model
    n = len(texts)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    words = split(pc.utf8_lower(texts.fill_null("")), BLANK)
    keys, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
    logs = memory.of(words, keys, first).astype(np.float32).astype(np.float64)
    of = words.text_of()
    total = np.stack([np.bincount(of, logs[back, k], n) for k in range(logs.shape[1])], axis=1)
    best = total.argmax(1)
    posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    spelled = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, spelled)], np.where(spelled, posterior, 0.0)


def languages(docs: DataFrame, vocabulary: str = VOCABULARY, bound: int = TRAINED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    lang, source and doc_id are no inputs of a prediction. A text that is null or has
    no letter is 'und' with score 0, and so are all texts if none can be learned from.
    Ties go to the first language by name. A row without doc_id is predicted and not
    held out; repeated rows are predicted each. An empty table gives no rows. Words of
    any length are summed over whole, with all pieces of the vocabulary. Other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, vocabulary, bound))

    def of(batches):
        memory = _Memory(shared.value)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                names, score = predict(part.column("text"), memory)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(of, "doc_id long, lang_pred string, score double")
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")
