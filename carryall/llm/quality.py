"""Quality of texts by a factorisation machine.

Inputs are hashed words, statistics of a text's structure, and metadata. Every pair of
inputs interacts through the product of their factors; the sum over all pairs comes
from squares of sums and sums of squares, in time linear in the inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from carryall.llm.subwords import forget
from carryall.llm.words import BLANK, by_bytes, joined, mix, split

BUCKETS = 1 << 15
FACTORS = 6
# Labelled documents that the machine is trained on, at most about.
TRAINED = 6_000
THRESHOLD = 0.7
# Bytes of text that a task makes inputs of at a time.
SLICE = 1 << 20
METADATA = ("n_chars",)

_BYTES = np.arange(256)
_GROUPS = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "mark": ((_BYTES >= 33) & (_BYTES <= 47)) | ((_BYTES >= 58) & (_BYTES <= 64)) | ((_BYTES >= 91) & (_BYTES <= 96)) | ((_BYTES >= 123) & (_BYTES <= 126)),
    "stop": np.isin(_BYTES, [33, 46, 63]),
    "loud": _BYTES == 33,
    "comma": _BYTES == 44,
    "line": _BYTES == 10,
    "blank": BLANK,
    "wide": _BYTES >= 128,
    "control": (_BYTES < 32) & ~BLANK,
}
#: Shares of bytes; then words, distinct words, the commonest word, word length, its spread, repeated lines.
STATISTICS = [*_GROUPS, "words", "distinct", "commonest", "length", "spread", "again"]


def _lines_again(text: bytes) -> float:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


@dataclass
class Inputs:
    """Inputs of a column of texts: sparse words (row, bucket, value) and dense statistics."""

    rows: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    dense: np.ndarray


def inputs(texts, metadata: list[np.ndarray]) -> Inputs:
    words = split(texts, BLANK)
    buffer, offsets = joined(texts)
    n = len(offsets) - 1
    low = split(texts, BLANK, lower=True)
    of = low.text_of()
    bucket = (mix(low.hashes) % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(of * BUCKETS + bucket, return_counts=True)
    rows, buckets = key // BUCKETS, key % BUCKETS
    # Damped counts of unit length.
    values = np.log1p(count)
    norm = np.sqrt(np.bincount(rows, values**2, n))
    values = values / norm[rows]
    size = np.maximum(1, np.diff(offsets))
    dense = np.zeros((n, len(STATISTICS) + len(metadata)))
    for k, group in enumerate(_GROUPS.values()):
        sums = np.concatenate(([0], np.cumsum(group[buffer], dtype=np.int64))) if len(buffer) else np.zeros(1, np.int64)
        dense[:, k] = np.sqrt((sums[offsets[1:]] - sums[offsets[:-1]]) / size)
    k = len(_GROUPS)
    total = np.maximum(1, words.counts)
    dense[:, k] = np.log1p(words.counts)
    _, at, times = np.unique(low.hashes ^ mix(of.astype(np.uint64)), return_index=True, return_counts=True)
    row = of[at]
    dense[:, k + 1] = np.bincount(row, minlength=n) / total
    most = np.zeros(n)
    np.maximum.at(most, row, times)
    dense[:, k + 2] = most / total
    length = (words.ends - words.starts).astype(np.float64)
    mean = np.bincount(of, length, n) / total
    dense[:, k + 3] = np.log1p(mean)
    dense[:, k + 4] = np.log1p(np.sqrt(np.maximum(0, np.bincount(of, length**2, n) / total - mean**2)))
    data = buffer.tobytes()
    dense[:, k + 5] = [_lines_again(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    for j, m in enumerate(metadata):
        dense[:, len(STATISTICS) + j] = np.sign(m) * np.log1p(np.abs(m))
    return Inputs(rows, buckets, values, dense)


class FactorisationMachine:
    """Weights and factors of hashed words and of dense inputs, trained by AdaGrad."""

    def __init__(self, n_dense: int, factors: int = FACTORS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        n = BUCKETS + n_dense
        self.bias = 0.0
        self.w = np.zeros(n)
        self.v = rng.normal(scale=0.05, size=(n, factors))
        self.mean, self.scale = np.zeros(n_dense), np.ones(n_dense)

    def _all(self, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, d = x.dense.shape
        dense = np.clip((x.dense - self.mean) / self.scale, -6, 6)
        rows = np.concatenate((x.rows, np.repeat(np.arange(n), d)))
        columns = np.concatenate((x.buckets, np.tile(BUCKETS + np.arange(d), n)))
        return rows, columns, np.concatenate((x.values, dense.reshape(-1)))

    @staticmethod
    def _sums(rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(rows, terms[:, k], n) for k in range(terms.shape[1])], axis=1)

    def raw(self, x: Inputs) -> np.ndarray:
        """The machine's value, before the logistic function."""
        n = len(x.dense)
        rows, columns, values = self._all(x)
        terms = self.v[columns] * values[:, None]
        sums, squares = self._sums(rows, terms, n), self._sums(rows, terms**2, n)
        return self.bias + np.bincount(rows, self.w[columns] * values, n) + 0.5 * (sums**2 - squares).sum(1)

    def score(self, x: Inputs) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -35, 35)))

    def fit(self, x: Inputs, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.08, decay: float = 1e-4, seed: int = 5) -> None:
        n = len(y)
        if n == 0:
            return
        self.mean, self.scale = x.dense.mean(0), x.dense.std(0) + 1e-6
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        rows, columns, values = self._all(x)
        order = np.argsort(rows, kind="stable")
        rows, columns, values = rows[order], columns[order], values[order]
        bounds = np.searchsorted(rows, np.arange(n + 1))
        gw, gv, gb = np.full(len(self.w), 1e-8), np.full(self.v.shape, 1e-8), 1e-8
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for chosen in np.array_split(rng.permutation(n), max(1, n // batch)):
                size = bounds[chosen + 1] - bounds[chosen]
                r = np.repeat(np.arange(len(chosen)), size)
                at = np.repeat(bounds[chosen] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                c, v = columns[at], values[at]
                terms = self.v[c] * v[:, None]
                sums = self._sums(r, terms, len(chosen))
                raw = self.bias + np.bincount(r, self.w[c] * v, len(chosen)) + 0.5 * (sums**2 - self._sums(r, terms**2, len(chosen))).sum(1)
                slope = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - y[chosen]) / len(chosen)
                gb += slope.sum() ** 2
                self.bias -= rate * slope.sum() / np.sqrt(gb)
                used, c = np.unique(c, return_inverse=True)
                g = np.bincount(c, slope[r] * v, len(used)) + decay * self.w[used]
                gw[used] += g**2
                self.w[used] -= rate * g / np.sqrt(gw[used])
                g = self._sums(c, slope[r, None] * v[:, None] * (sums[r] - terms), len(used)) + decay * self.v[used]
                gv[used] += g**2
                self.v[used] -= 0.5 * rate * g / np.sqrt(gv[used])


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def _metadata(df: DataFrame, names) -> list[Column]:
    return [F.coalesce(F.col(f"`{m}`").cast("double"), F.lit(0.0)).alias(f"m{k}") for k, m in enumerate(names)]


def _numbers(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [np.nan_to_num(batch.column(f"m{k}").to_numpy(zero_copy_only=False)) for k in range(n)]


def _slices(batches):
    """Slices of a task's batches, in a worker that first drops what it remembers for other operators."""
    forget()
    for batch in batches:
        yield from by_bytes(batch, "text", SLICE)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAINED, metadata=METADATA) -> FactorisationMachine:
    """A machine trained on labelled documents whose id's crc32 modulo 4 is not 2.

    At most about `bound` of them, drawn by a hash of their ids. Labels are `quality`
    0 or 1; null ones are skipped, and of several for one id the lowest counts. Of
    several rows with one id one is learned from.
    Without any labelled document the machine gives one half for all.
    """
    names = [m for m in metadata if m in docs.columns]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where(
        "doc_id IS NOT NULL AND y IS NOT NULL"
    )
    known = known.where(remainder(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.min("y").alias("y"))
    total = known.count()
    share = min(1.0, bound / max(1, total))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *_metadata(docs, names))
    n = len(names)

    def of(batches):
        for part in _slices(batches):
            x = inputs(part.column("text"), _numbers(part, n))
            cut = np.searchsorted(x.rows, np.arange(part.num_rows + 1))
            each = [slice(a, b) for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("y"),
                    pa.array([x.buckets[s].astype(np.uint16).tobytes() for s in each], pa.binary()),
                    pa.array([x.values[s].astype(np.float32).tobytes() for s in each], pa.binary()),
                    pa.array([d.tobytes() for d in x.dense], pa.binary()),
                ],
                ["doc_id", "y", "buckets", "numbers", "dense"],
            )

    # About `bound` ids at most are broadcast. Of repeated ids the least row by its hash
    # is taken, so that no more rows are collected, once they are numbers.
    each = rows.join(F.broadcast(drawn), "doc_id")
    rest = [c for c in each.columns if c != "doc_id"]
    once = each.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("row")).select("doc_id", "row.*")
    found = once.mapInArrow(of, "doc_id long, y double, buckets binary, numbers binary, dense binary")
    table = found.toArrow().sort_by("doc_id")
    machine = FactorisationMachine(len(STATISTICS) + n)
    if table.num_rows:
        buckets = [np.frombuffer(b, np.uint16) for b in table["buckets"].to_pylist()]
        x = Inputs(
            np.repeat(np.arange(len(buckets)), [len(b) for b in buckets]),
            np.concatenate(buckets).astype(np.int64),
            np.concatenate([np.frombuffer(b, np.float32) for b in table["numbers"].to_pylist()]).astype(np.float64),
            np.stack([np.frombuffer(b, np.float64) for b in table["dense"].to_pylist()]),
        )
        machine.fit(x, (table["y"].to_numpy() >= 0.5).astype(np.float64))
    return machine


def _scored(docs: DataFrame, machine: FactorisationMachine, metadata) -> DataFrame:
    """All columns of `docs` as `rest`, and the score."""
    names = [m for m in metadata if m in docs.columns]
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest")
    rows = docs.select(F.col("text").cast("string").alias("text"), *_metadata(docs, names), rest)
    n = len(names)

    def of(batches):
        for part in _slices(batches):
            score = shared.value.score(inputs(part.column("text"), _numbers(part, n)))
            yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(score)], ["rest", "score"])

    return rows.mapInArrow(of, T.StructType([rows.schema["rest"], T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, bound: int = TRAINED, metadata=METADATA, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A null text counts as empty; empty texts get the score of their statistics.
    Without doc_id a row is scored, and not held out. Repeated rows are scored each.
    Labels, lang, source and doc_id are no inputs. An empty table gives no rows.
    """
    machine = train(docs, labels, bound, metadata)
    keep = [c for c in ("doc_id", "text", *metadata) if c in docs.columns]
    slim = docs.select(*keep)
    found = _scored(slim, machine, metadata)
    held = F.coalesce(remainder(F.col("rest.doc_id").cast("long"), 4) == 2, F.lit(False))
    return found.select(
        F.col("rest.doc_id").cast("long").alias("doc_id"),
        held.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def of_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, as they are."""
    found = _scored(docs, train(docs, labels), METADATA).where(F.col("score") >= threshold)
    return found.select(*[F.col("rest")[c].alias(c) for c in docs.columns])
