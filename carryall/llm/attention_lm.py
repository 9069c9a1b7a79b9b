"""Texts scored by a small causal self-attention model on subword ids.

An id is predicted in steps: its class from the ids before it, and the id from its
class. The commonest ids are classes of their own, the others share classes by rank;
a class is predicted as a group of classes and a member of it, which spares most of a
full softmax. One layer of masked self-attention over a window predicts both, added to
what the last class alone says (its followers counted in training). Windows overlap,
and every id is scored once, in the window where it has the longest context.

Ids and followers are counted over all training texts, and every round trains on the
windows of all of them: tasks train on their own windows from common weights, which
are then averaged.

Training and scoring are carried out in the JVM by AttentionSteps.java, over all texts of
a task. The same steps stand here in NumPy, which takes over where there is no compiler.

Beside the model stands a base of word counts over all training texts, exchanged
between blocks of documents and buckets of words. Texts are read once: their ids and the
numbers of their words are written, and all that follows starts from these.
"""

from __future__ import annotations

import copy
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from carryall.llm import jvm
from carryall.llm.blocks import BLOCK_BYTES, count_blocks, parts, runs
from carryall.llm.subwords import WORD_BPE, encoder, forgotten, tokenizer_path
from carryall.llm.words import BLANK, by_bytes, mix, split
from carryall.sources.tables import pin

GROUPS = 16
MEMBERS = 32
CLASSES = GROUPS * MEMBERS
# Of them, classes of ids that are rarer.
SHARED = 32
DIMENSION = 16
WINDOW = 16
# Of a window that begins inside a text: what only gives context to the rest.
OVERLAP = 8
ROUNDS = 3
_BATCH = 48
# Ids that are counted, or cut into windows and trained on, at a time.
_IDS = 1 << 20
# Bytes of texts that the encoder does not cut at blanks.
_UNCUT = np.arange(0x1C, 0x20, dtype=np.uint8)
# The number that stands for a text's end among the words.
_END = np.uint64(0x5851F42D4C957F2D)


def _held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _trains(doc_id: int | None) -> bool:
    return doc_id is not None and not _held_out(doc_id)


@dataclass
class Vocabulary:
    """The class of every id, and the log10 share of the id in it. The last id is a text's end."""

    classes: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        n = len(counts)
        order = np.argsort(-counts, kind="stable")
        classes = np.empty(n, np.int32)
        single = min(CLASSES - SHARED, n)
        classes[order[:single]] = np.arange(single)
        rest = order[single:]
        # Shared classes of about equal weight, along the ranks.
        weight = np.cumsum(counts[rest] + 0.5)
        if len(rest):
            classes[rest] = single + np.minimum(SHARED - 1, (weight - 0.25) * SHARED // weight[-1]).astype(np.int32)
        total = np.bincount(classes, counts + 0.5, CLASSES)
        return cls(classes, np.log10((counts + 0.5) / total[classes]).astype(np.float32))


class AttentionModel:
    """Weights of the class model. Class CLASSES stands for what precedes a text."""

    SHAPES = {
        "embed": (CLASSES + 1, DIMENSION),
        "place": (WINDOW, DIMENSION),
        "q": (DIMENSION, DIMENSION),
        "k": (DIMENSION, DIMENSION),
        "v": (DIMENSION, DIMENSION),
        "o": (DIMENSION, DIMENSION),
        "group": (DIMENSION, GROUPS),
        "group_bias": (GROUPS,),
        "member": (GROUPS, DIMENSION, MEMBERS),
        "member_bias": (GROUPS, MEMBERS),
    }
    SCALE = np.float32(DIMENSION**-0.5)
    #: Attention scores are held within this, so that exponentials need no shift.
    REACH = np.float32(30)

    def __init__(self, counts: np.ndarray, seed: int = 3) -> None:
        """counts: how often each class follows each (a row per class before)."""
        rng = np.random.default_rng(seed)
        alone = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * CLASSES)
        follow = (counts + 8 * alone) / (counts.sum(1, keepdims=True) + 8)
        follow = follow.reshape(CLASSES + 1, GROUPS, MEMBERS)
        self.follow_group = np.log(follow.sum(2)).astype(np.float32)
        self.follow_member = np.log(follow / follow.sum(2, keepdims=True)).astype(np.float32)
        self.w = {}
        for k, shape in self.SHAPES.items():
            scale = 0.0 if "bias" in k else 0.2 if k in ("embed", "place") else 0.02 if k in ("group", "member") else DIMENSION**-0.5
            self.w[k] = (rng.normal(size=shape) * scale).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].reshape(-1) for k in self.SHAPES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            self.w[k] = flat[at : at + n].reshape(shape).astype(np.float32)
            at += n
        self.__dict__.pop("tables", None)

    def _tables(self) -> dict[str, np.ndarray]:
        """What the layers make of each class and each place; embedding and projections are linear."""
        w = self.w
        if "tables" not in self.__dict__:
            qkv = np.concatenate((w["q"] * self.SCALE, w["k"], w["v"]), axis=1)
            self.tables = {
                "qkv": w["embed"] @ qkv,
                "qkv_place": w["place"] @ qkv,
                "group": w["embed"] @ w["group"] + w["group_bias"] + self.follow_group,
                "group_place": w["place"] @ w["group"],
                "group_rest": w["o"] @ w["group"],
                "member": np.einsum("cd,gdm->gcm", w["embed"], w["member"]) + w["member_bias"][:, None] + self.follow_member.transpose(1, 0, 2),
                "member_place": np.einsum("td,gdm->gtm", w["place"], w["member"]),
                "member_rest": np.einsum("ed,gdm->gem", w["o"], w["member"]),
            }
        return self.tables

    @staticmethod
    def _by_group(target: np.ndarray) -> tuple[np.ndarray, list[slice], np.ndarray, np.ndarray]:
        """The order of classes by group, the slice of each group in it, and the groups and members in this order."""
        order = np.argsort((target // MEMBERS).astype(np.int16), kind="stable")
        group, member = np.divmod(target[order], MEMBERS)
        bounds = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        return order, [slice(a, b) for a, b in zip(bounds, bounds[1:])], group, member

    def log_probabilities(self, x: np.ndarray, y: np.ndarray, on: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of the classes y after x, at the places that are on; else 0."""
        t = self._tables()
        qkv = np.take(t["qkv"], x, axis=0)
        qkv += t["qkv_place"]
        d = DIMENSION
        s = qkv[..., :d] @ qkv[..., d : 2 * d].transpose(0, 2, 1)
        np.clip(s, -self.REACH, self.REACH, out=s)
        np.exp(s, out=s)
        s *= np.tri(WINDOW, dtype=np.float32)
        # A column of ones behind the values gives the sums to divide by.
        v = np.ones((*x.shape, d + 1), np.float32)
        v[..., :d] = qkv[..., 2 * d :]
        z = s @ v
        at = np.flatnonzero(on)
        z = z.reshape(-1, d + 1)[at]
        z = z[:, :d] / z[:, d:]
        order, cuts, group, member = self._by_group(y.reshape(-1)[at])
        at, z = at[order], z[order]
        before, place, row = x.reshape(-1)[at], at % WINDOW, np.arange(len(at))
        logits = z @ t["group_rest"]
        logits += t["group"][before]
        logits += t["group_place"][place]
        picked = logits[row, group]
        found = picked - np.log(np.exp(logits, out=logits).sum(1))
        logits = t["member"][group, before]
        logits += t["member_place"][group, place]
        for g, part in enumerate(cuts):
            logits[part] += z[part] @ t["member_rest"][g]
        picked = logits[row, member]
        found += picked - np.log(np.exp(logits, out=logits).sum(1))
        out = np.zeros(x.size, np.float32)
        out[at] = found
        return out.reshape(x.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray, on: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over the places that are on."""
        w, d = self.w, DIMENSION
        flat = lambda a: a.reshape(-1, a.shape[-1])
        e = np.take(w["embed"], x, axis=0)
        e += w["place"]
        joint = np.concatenate((w["q"] * self.SCALE, w["k"], w["v"]), axis=1)
        qkv = (flat(e) @ joint).reshape(*x.shape, 3 * d)
        q, k, v = qkv[..., :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
        raw = q @ k.transpose(0, 2, 1)
        held = np.abs(raw) < self.REACH
        s = np.clip(raw, -self.REACH, self.REACH, out=raw)
        np.exp(s, out=s)
        s *= np.tri(WINDOW, dtype=np.float32)
        s /= s.sum(-1, keepdims=True)
        a = flat(s @ v)
        h = a @ w["o"]
        h += flat(e)
        at = np.flatnonzero(on)
        order, cuts, group, member = self._by_group(y.reshape(-1)[at])
        at = at[order]
        before, row = x.reshape(-1)[at], np.arange(len(at))
        part = np.float32(1 / max(1, len(at)))

        def slope(logits, wanted):
            # Within this, exponentials and their sums need no shift.
            if max(logits.max(initial=0), -logits.min(initial=0)) > 60:
                logits -= logits.max(1, keepdims=True)
            p = np.exp(logits, out=logits)
            p *= part / p.sum(1, keepdims=True)
            p[row, wanted] -= part
            return p

        # A column of ones behind the inputs goes with the biases.
        on_h = np.ones((len(at), d + 1), np.float32)
        on_h[:, :d] = h[at]
        member_w = np.concatenate((w["member"], w["member_bias"][:, None]), axis=1)
        logits = on_h[:, :d] @ w["group"]
        logits += w["group_bias"]
        logits += self.follow_group[before]
        p = slope(logits, group)
        g = {"group": on_h[:, :d].T @ p, "group_bias": p.sum(0)}
        back = p @ w["group"].T
        logits = self.follow_member[before, group]
        for j, of in enumerate(cuts):
            logits[of] += on_h[of] @ member_w[j]
        p = slope(logits, member)
        member_g = np.zeros_like(member_w)
        for j, of in enumerate(cuts):
            member_g[j] = on_h[of].T @ p[of]
            back[of] += p[of] @ w["member"][j].T
        g["member"], g["member_bias"] = member_g[:, :d], member_g[:, d]
        de = np.zeros_like(h)
        de[at] = back
        g["o"] = a.T @ de
        da = (de @ w["o"].T).reshape(e.shape)
        ds = da @ v.transpose(0, 2, 1)
        ds -= (ds * s).sum(-1, keepdims=True)
        ds *= s
        ds *= held
        back = np.empty_like(qkv)
        back[..., :d], back[..., d : 2 * d], back[..., 2 * d :] = ds @ k, ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ da
        back = flat(back)
        all_three = flat(e).T @ back
        g["q"], g["k"], g["v"] = all_three[:, :d] * self.SCALE, all_three[:, d : 2 * d], all_three[:, 2 * d :]
        de += back @ joint.T
        g["place"] = de.reshape(e.shape).sum(0)
        at = (x.reshape(-1, 1) * d + np.arange(d)).reshape(-1)
        g["embed"] = np.bincount(at, de.reshape(-1), w["embed"].size).astype(np.float32).reshape(w["embed"].shape)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, on: np.ndarray, rate: float, seed: int) -> None:
        """One pass of Adam over windows."""
        # The weights are parts of one array, so that a step goes over all of them at once.
        flat, at = self.flat(), 0
        for k, shape in self.SHAPES.items():
            self.w[k] = flat[at : at + int(np.prod(shape))].reshape(shape)
            at += self.w[k].size
        one, two = np.zeros_like(flat), np.zeros_like(flat)
        order = np.random.default_rng(seed).permutation(len(x))
        for step, i in enumerate(range(0, len(x), _BATCH), 1):
            at = order[i : i + _BATCH]
            g = self.gradients(x[at], y[at], on[at])
            g = np.concatenate([g[k].reshape(-1) for k in self.SHAPES])
            one += 0.1 * (g - one)
            g *= g
            two += 0.01 * (g - two)
            change = np.sqrt(two / (1 - 0.99**step))
            change += np.float32(1e-6)
            flat -= np.float32(rate) * (one / (1 - 0.9**step)) / change


_ROWS = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("trains", pa.bool_()),
        ("words", pa.binary()),
        ("ids", pa.binary()),
        ("bucket", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def _prepared(docs: DataFrame, path: str, n_buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of all texts, in their order, and behind those of each block what it asks the buckets.

    A block is what a task reads of about `block_bytes` together. Of a text: block, doc_id,
    trains, words (of each word its place among the block's keys) and ids (-1 before the
    first, all its ids and its end). Of a block and a bucket: keys, by number, and how often
    the block's training texts have each. A block's keys are those of its buckets in turn.
    """

    def of(batches):
        enc = encoder(path)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in by_bytes(batch, "text", block_bytes):
                doc_ids = part.column(0).to_pylist()
                trains = [_trains(i) for i in doc_ids]
                ids, words, asked = _block_words(part.column(1), trains, n_buckets, enc)
                given = {"block": [block] * len(ids), "doc_id": doc_ids, "trains": trains, "words": words, "ids": ids}
                yield _batch(given, len(ids))
                yield _batch({"block": [block] * len(asked["keys"]), **asked}, len(asked["keys"]))
                block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "block long, doc_id long, trains boolean, words binary, ids binary, bucket int, keys binary, counts binary")


def _batch(given: dict[str, list], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _ROWS], schema=_ROWS)


def _ids_to_learn(rows: DataFrame) -> DataFrame:
    return rows.where("trains").select("ids")


def _training_ids(docs: DataFrame, path: str) -> DataFrame:
    """(ids): of each training text, -1 before its first id, all its ids and its end."""
    return _ids_to_learn(_prepared(docs, path, 1))


def _read_ids(batches):
    """Lists of id sequences, of about _IDS ids together; a longer text is a list of its own."""
    found, size = [], 0
    for batch in batches:
        for body in batch.column(0):
            ids = np.frombuffer(body.as_buffer(), np.int32)
            if found and size + len(ids) > _IDS:
                yield found
                found, size = [], 0
            found.append(ids)
            size += len(ids)
    if found:
        yield found


def _steps(spark):
    """What loads AttentionSteps.java, if it was made for the sizes here and for this machine's vectors."""
    return jvm.steps(spark, f"{DIMENSION} {WINDOW} {OVERLAP} {GROUPS} {MEMBERS} {_BATCH} {_IDS} true")


def _body(numbers: np.ndarray, kind: str) -> bytearray:
    return bytearray(np.ascontiguousarray(numbers, kind).tobytes())


def _counted(ids: DataFrame, size: int, classes=None) -> np.ndarray:
    """How often each id, below `size`, comes up over all texts; with classes (broadcast), each pair of classes."""

    def keys_of(found):
        if classes is None:
            return (x := np.concatenate(found))[x >= 0]
        found = [_classed(x, classes.value) for x in found]
        return np.concatenate([c[:-1] * np.int64(CLASSES) + c[1:] for c in found])

    def of(batches):
        total = np.zeros(size, np.int64)
        for found in _read_ids(batches):
            total += np.bincount(keys_of(found), minlength=size)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(total[k])], ["k", "n"])

    if loader := _steps(ids.sparkSession):
        body = _body(np.zeros(0) if classes is None else classes.value, "<i4")
        counted = jvm.mapped(ids, loader, "Count", "k long, n long", size, body)
    else:
        counted = ids.mapInArrow(of, "k long, n long")
    table = counted.groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[table["k"].to_numpy()] = table["n"].to_numpy()
    return out


def _in_windows(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and which places count, of class sequences that include what precedes them."""
    sizes = np.fromiter((len(c) - 1 for c in classes), np.int64, len(classes))
    on = np.arange(WINDOW) < sizes[:, None]
    x, y = np.zeros(on.shape, np.int32), np.zeros(on.shape, np.int32)
    x[on] = np.concatenate([c[:-1] for c in classes])
    y[on] = np.concatenate([c[1:] for c in classes])
    return x, y, on


def _classed(ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(ids < 0, CLASSES, classes[ids])


def _cut(classes: list[np.ndarray]):
    """Windows of whole texts, each id a target once, in lists of about _IDS ids."""
    windows = [c[a : a + WINDOW + 1] for c in classes for a in range(0, len(c) - 1, WINDOW)]
    for a in range(0, len(windows), _IDS // WINDOW):
        yield windows[a : a + _IDS // WINDOW]


def _fitted(ids: DataFrame, classes, start, r: int) -> DataFrame:
    """(k, value, weight): weights after a round, as each task has them, and its windows; classes, start: broadcast."""
    schema, rate = "k int, value double, weight double", 0.01 / (1 + r)
    if loader := _steps(ids.sparkSession):
        m, bits = start.value, np.random.PCG64(r).state["state"]
        # Four longs with a sign: the upper and the lower half of both.
        bits = np.frombuffer(b"".join(bits[k].to_bytes(16, "big") for k in ("state", "inc")), ">i8").tolist()
        weights = (_body(x, "<f4") for x in (m.flat(), m.follow_group, m.follow_member))
        return jvm.mapped(ids, loader, "Fit", schema, _body(classes.value, "<i4"), *weights, *bits, rate)

    def fit(batches):
        # A worker keeps the broadcast model for its next task, which starts from the same weights.
        mine = copy.deepcopy(start.value)
        n = 0
        for found in _read_ids(batches):
            for windows in _cut([_classed(x, classes.value) for x in found]):
                mine.train(*_in_windows(windows), rate=rate, seed=r)
                n += len(windows)
        if n:
            flat = mine.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat), pa.array(np.full(len(flat), float(n)))], ["k", "value", "weight"])

    return ids.mapInArrow(fit, schema)


def train(docs: DataFrame, tokenizer: str = WORD_BPE, rounds: int = ROUNDS) -> tuple[Vocabulary, AttentionModel]:
    path = tokenizer_path(tokenizer)
    return _trained(pin(_training_ids(docs, path), "ids"), path, rounds)


def _trained(ids: DataFrame, path: str, rounds: int) -> tuple[Vocabulary, AttentionModel]:
    sc = ids.sparkSession.sparkContext
    vocabulary = Vocabulary.of(_counted(ids, encoder(path).tokenizer.get_vocab_size() + 1))
    shared = sc.broadcast(vocabulary.classes)
    counts = _counted(ids, (CLASSES + 1) * CLASSES, shared).reshape(CLASSES + 1, CLASSES)
    model = AttentionModel(counts)
    mean = (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value")
    for r in range(rounds):
        got = _fitted(ids, shared, sc.broadcast(model), r).groupBy("k").agg(mean).toArrow().sort_by("k")
        if got.num_rows:
            model.load(got["value"].to_numpy())
    return vocabulary, model


def score_texts(texts: list[str], enc, vocabulary: Vocabulary, model: AttentionModel) -> np.ndarray:
    """log10 probability of each text: its ids and its end."""
    end = len(vocabulary.classes) - 1
    return _score_ids([np.append(np.frombuffer(b, "<u4").astype(np.int64), end) for b in enc.encode(texts)], vocabulary, model)


def _score_ids(ids: list[np.ndarray], vocabulary: Vocabulary, model: AttentionModel) -> np.ndarray:
    out = np.zeros(len(ids))
    step = WINDOW - OVERLAP
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    for i, x in enumerate(ids):
        out[i] = vocabulary.share[x].sum(dtype=np.float64)
    # All texts one after the other, each behind the class that precedes a text.
    line = np.concatenate([np.concatenate(([CLASSES], vocabulary.classes[x])) for x in ids] + [np.zeros(WINDOW + 1, np.int32)]).astype(np.int32)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    number = np.maximum(1, -(-(sizes - OVERLAP) // step))
    of = np.repeat(np.arange(len(ids)), number)
    a = (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)) * step
    places = np.arange(WINDOW)
    for k in range(0, len(of), 256):
        o, first = of[k : k + 256], a[k : k + 256, None]
        at = begins[o][:, None] + first + places
        # Scored once: behind the overlap, but in a text's first window from its first id on.
        on = (first + places < sizes[o][:, None]) & ((places >= OVERLAP) | (first == 0))
        logs = model.log_probabilities(line[np.minimum(at, len(line) - 1)], line[np.minimum(at + 1, len(line) - 1)] % CLASSES, on)
        out += np.bincount(o, logs.sum(1, dtype=np.float64), len(ids)) / np.log(10)
    return out


def _scored(rows: DataFrame, vocabulary: Vocabulary, model: AttentionModel) -> DataFrame:
    """(block, doc_id, words, score) of rows with the ids of a text."""
    schema = "block long, doc_id long, words binary, score double"
    rows = rows.select("block", "doc_id", "words", "ids")
    if loader := _steps(rows.sparkSession):
        t = model._tables()
        tables = [_body(t[k], "<f4") for k in ("qkv", "qkv_place", "group", "group_place", "group_rest", "member", "member_place", "member_rest")]
        return jvm.mapped(rows, loader, "Score", schema, _body(vocabulary.classes, "<i4"), _body(vocabulary.share, "<f4"), tables)
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, model))

    def of(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                scores = _score_ids([np.frombuffer(x.as_buffer(), np.int32)[1:] for x in part.column(3)], *shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(scores)], ["block", "doc_id", "words", "score"])

    return rows.mapInArrow(of, schema)


# Word counts of the base.


def _block_words(texts: pa.Array, trains: list[bool], n_buckets: int, enc) -> tuple[list[bytes], list[bytes], dict[str, list]]:
    """Of each text of a block, its ids between -1 and its end, and the places of its words among the block's keys; and what the block asks the buckets."""
    words = split(texts, BLANK, lower=True)
    # Each text's end is one more word of it.
    bounds = words.bounds + np.arange(len(words.bounds))
    keys, back = np.unique(np.insert(words.hashes, words.bounds[1:], _END), return_inverse=True)
    counts = np.bincount(back, np.repeat(trains, np.diff(bounds)), len(keys)).astype(np.uint32)
    bucket, order, cuts = _in_buckets(keys, n_buckets)
    places = np.empty(len(keys), np.int32)
    places[order] = np.arange(len(keys), dtype=np.int32)
    places = places[back]
    asked = {
        "bucket": [int(bucket[order[c.start]]) for c in cuts],
        "keys": [keys[order[c]].tobytes() for c in cuts],
        "counts": [counts[order[c]].tobytes() for c in cuts],
    }
    end = np.array([enc.tokenizer.get_vocab_size(), -1], np.int32)
    if enc.lowers and not np.isin(words.buffer, _UNCUT).any():
        ids = _ids_by_word(words, bounds, len(keys), back, enc, end)
    else:
        ids = [np.concatenate((end[1:], np.frombuffer(x, "<i4"), end[:1])).tobytes() for x in enc.encode([t or "" for t in texts.to_pylist()])]
    return ids, [places[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], asked


def _ids_by_word(words, bounds: np.ndarray, n_keys: int, back: np.ndarray, enc, end: np.ndarray) -> list[bytes]:
    """The ids of each text between -1 and its end, from those of the block's distinct words."""
    is_end = np.zeros(len(back), bool)
    is_end[bounds[1:] - 1] = True
    at = np.full(n_keys, -1)
    at[back[~is_end]] = np.arange(len(words.hashes))
    known, body = np.flatnonzero(at >= 0), words.buffer.tobytes()
    starts, ends = words.starts[at[known]].tolist(), words.ends[at[known]].tolist()
    found = enc.words.of([body[a:b] for a, b in zip(starts, ends)])
    # The ids of all words one after the other; a text's end is followed by what precedes the next text.
    line = np.concatenate((np.frombuffer(b"".join(found), "<i4"), end))
    sizes = np.full(n_keys, len(end))
    sizes[known] = np.fromiter(map(len, found), np.int64, len(found)) // 4
    begins = np.full(n_keys, len(line) - len(end))
    begins[known] = np.cumsum(sizes[known]) - sizes[known]
    size, begin = sizes[back], begins[back]
    # In case that a word has the number of a text's end.
    size[is_end], begin[is_end] = len(end), len(line) - len(end)
    upto = np.cumsum(size)
    out = np.concatenate((end[1:], line[np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - (upto - size), size)]))
    cuts = np.concatenate(([0], upto))[bounds].tolist()
    return [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def _in_buckets(keys: np.ndarray, n_buckets: int):
    bucket = (mix(keys) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    starts, ends = runs(bucket[order])
    return bucket, order, [slice(a, b) for a, b in zip(starts, ends)]


def _tell(table: pa.Table) -> pa.Table:
    # All texts are encoded, and training wants the memory.
    forgotten()
    keys, of = parts(table["keys"].to_pylist(), np.uint64)
    counts, _ = parts(table["counts"].to_pylist(), np.uint32)
    distinct, back = np.unique(keys, return_inverse=True)
    total = np.bincount(back, counts, len(distinct))
    answers = total[back].astype(np.int64)
    starts, ends = runs(of)
    first = np.zeros(len(starts), np.int64)
    first[:1] = 1
    return pa.table(
        {
            "block": table["block"],
            "bucket": table["bucket"],
            "counts": pa.array([answers[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "known": pa.array(first * int((total > 0).sum())),
            "tokens": pa.array(first * int(total.sum())),
        }
    )


def _with_base(docs: pa.Table, told: pa.Table, tokens: int, known: int) -> pa.Table:
    counts, _ = parts(told.sort_by("bucket")["counts"].to_pylist(), np.int64)
    logs = np.log10((counts + 0.5) / (tokens + 0.5 * (known + 1)))
    words, of = parts(docs["words"].to_pylist(), np.int32)
    return pa.table(
        {
            "doc_id": docs["doc_id"],
            "held_out": pa.array([_held_out(i) for i in docs["doc_id"].to_pylist()], pa.bool_()),
            "n_tokens": np.bincount(of, minlength=docs.num_rows).astype(np.int64),
            "n_known": np.bincount(of, counts[words] > 0, docs.num_rows).astype(np.int64),
            "train_tokens": np.full(docs.num_rows, tokens, np.int64),
            "base_score": np.bincount(of, logs[words], docs.num_rows),
            "score": docs["score"],
        }
    )


def language_model_scores(docs: DataFrame, tokenizer: str = WORD_BPE, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from documents whose id's crc32 modulo 5 is not 1. `score` is the attention
    model's log10 probability of the whole text, `base_score` that of its words and
    its end by their counts. A null text is empty: its end alone. A row without doc_id
    is scored, not learned from and not held out. Repeated rows are scored each, and
    learned from each. An empty table gives no rows.
    """
    path = tokenizer_path(tokenizer)
    rows = pin(_prepared(docs, path, count_blocks(docs, block_bytes), block_bytes), "texts")
    asked = rows.where("keys is not null").select("block", "bucket", "keys", "counts")
    told = pin(asked.groupBy("bucket").applyInArrow(_tell, "block long, bucket int, counts binary, known long, tokens long"), "counts")
    size = told.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    tokens, known = int(size[0]), int(size[1])
    model = _trained(_ids_to_learn(rows), path, rounds)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = _scored(rows.where("ids is not null"), *model).groupBy("block")
    answers = told.select("block", "bucket", "counts").groupBy("block")
    return scored.cogroup(answers).applyInArrow(lambda d, t: _with_base(d, t, tokens, known), schema)
