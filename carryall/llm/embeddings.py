"""Near-duplicate vectors by a forest of random projection trees.

Every tree splits the vectors again and again at the median of a random projection;
those near a split go to both sides. The first splits are fitted on a bounded sample,
and all vectors are sent down all trees; a leaf that holds too many is split again at
the medians of its own vectors, round by round. Vectors are compared exactly within leaves, and
a pair that shares several leaves counts in the first of them only. Of the links of a
leaf, the number per vector and a spanning forest leave it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carryall.llm.components import connected_components, roots, unite
from carryall.sources.tables import pin

THRESHOLD = 0.98
TREES = 8
# Vectors of a leaf, as far as they can be split.
LEAF = 512
# Vectors within this distance of a split go to both sides.
SPILL = 0.0125
# Distinct vectors that the splits are fitted on, at most about.
SAMPLE = 20_000
# A leaf of more vectors is split again on all of them.
FULL = 4096
# Vectors of a leaf that are compared in one task: of a larger one, which could not be
# split, as its vectors are too near each other, all pairs of parts are.
PART = 4096
# A split that leaves a larger share of a leaf on one side is none.
_MOST = 0.8
_BLOCK = 1024
_WHERE = ["label", "size", "leaf"]
_NONE = np.iinfo(np.int64).max


@dataclass
class Forest:
    """Splits of all trees. Node k: its direction, its threshold, its children; a leaf has no children."""

    spill: float
    directions: list[np.ndarray] = field(default_factory=list)
    cuts: list[float] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    tops: list[int] = field(default_factory=list)

    def _node(self) -> int:
        self.directions.append(np.zeros(0))
        self.cuts.append(0.0)
        self.below.append(-1)
        self.above.append(-1)
        return len(self.cuts) - 1

    def grow(self, unit: np.ndarray, leaf: int, rng: np.random.Generator) -> None:
        """Adds a tree with leaves of about `leaf` rows of `unit`."""
        todo = [(self._node(), np.arange(len(unit)))]
        self.tops.append(todo[0][0])
        while todo:
            k, rows = todo.pop()
            if len(rows) <= leaf:
                continue
            way = rng.normal(size=unit.shape[1])
            way /= np.linalg.norm(way)
            at = unit[rows] @ way
            cut = float(np.median(at))
            low, high = rows[at <= cut + self.spill], rows[at > cut - self.spill]
            # Vectors so near each other that most go both ways are one leaf.
            if max(len(low), len(high)) > _MOST * len(rows):
                continue
            self.directions[k], self.cuts[k] = way, cut
            self.below[k], self.above[k] = self._node(), self._node()
            todo += [(self.below[k], low), (self.above[k], high)]

    def leaves(self, unit: np.ndarray) -> list[list[int]]:
        """The leaves of each vector, in ascending order."""
        out: list[list[int]] = [[] for _ in range(len(unit))]
        todo = [(top, np.arange(len(unit))) for top in self.tops]
        while todo:
            k, rows = todo.pop()
            if not len(rows):
                continue
            if self.below[k] < 0:
                for r in rows.tolist():
                    out[r].append(k)
                continue
            at = unit[rows] @ self.directions[k]
            todo.append((self.below[k], rows[at <= self.cuts[k] + self.spill]))
            todo.append((self.above[k], rows[at > self.cuts[k] - self.spill]))
        return [sorted(x) for x in out]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_forest(vectors: np.ndarray, total: int, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = 11) -> Forest:
    """A forest from a sample of `total` vectors."""
    forest, rng = Forest(spill), np.random.default_rng(seed)
    unit = unit_rows(vectors)
    for _ in range(trees):
        forest.grow(unit, max(16, leaf * len(vectors) // max(1, total)), rng)
    return forest


def _usable(vector) -> "F.Column":
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return good & F.exists(vector, lambda x: x != 0)


def _route(batches, forests: dict[int, Forest]):
    for batch in batches:
        sizes = batch.column("embedding").value_lengths().to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            vectors = part.column("embedding").flatten().to_numpy().astype(np.float64).reshape(-1, size)
            # Of a length that the sample has none of, all are one leaf.
            found = forests[size].leaves(unit_rows(vectors)) if size in forests else [[0]] * len(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("label"),
                    pa.array(np.full(len(found), size, np.int32)),
                    part.column("rep"),
                    part.column("copies"),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["label", "size", "rep", "copies", "vector", "leaves"],
            )


def _project(batches):
    """Adds `at`: each vector's place along the random direction of its leaf."""
    for batch in batches:
        leaf, size = batch.column("leaf").to_numpy(), batch.column("size").to_numpy()
        data = batch.column("vector").to_pylist()
        at = np.zeros(batch.num_rows)
        for k, n in {*zip(leaf.tolist(), size.tolist())}:
            rows = np.flatnonzero((leaf == k) & (size == n))
            way = np.random.default_rng([k & 0xFFFFFFFFFFFFFFFF, n]).normal(size=n)
            unit = unit_rows(np.frombuffer(b"".join([data[r] for r in rows]), np.float64).reshape(-1, n))
            at[rows] = unit @ (way / np.linalg.norm(way))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "at"])


def _larger(rows: DataFrame, most: int) -> DataFrame:
    return pin(rows.groupBy(*_WHERE).agg(F.count("*").alias("n")).where(F.col("n") > most), "large")


def _split_again(rows: DataFrame, large: DataFrame, spill: float, full: int) -> DataFrame:
    """(rep, leaves) of every vector, after the `large` leaves have been split as far as they can be.

    A round sends each vector of an over-full leaf along the leaf's own random
    direction, cuts at the median there, and gives both sides, which overlap by the
    spill, leaves of their own. A leaf that would leave most of its vectors on one
    side stays as it is. Sides shrink by a fifth or more, so rounds grow with the
    logarithm of the largest leaf; only vectors of over-full leaves are written.
    """
    done = rows.join(large, _WHERE, "left_anti").select("rep", "leaf")
    todo = rows.join(large, _WHERE, "left_semi").select(*_WHERE, "rep", "vector")
    while True:
        schema = T.StructType([*todo.schema, T.StructField("at", T.DoubleType())])
        placed = pin(todo.mapInArrow(_project, schema), "placed")
        cuts = placed.groupBy(*_WHERE).agg(F.percentile_approx("at", 0.5, 1000).alias("cut"))
        below, above = F.col("at") <= F.col("cut") + spill, F.col("at") > F.col("cut") - spill
        sides = placed.select(*_WHERE, "at").join(cuts, _WHERE).groupBy(*_WHERE, "cut")
        sides = sides.agg(F.count("*").alias("n"), F.count_if(below).alias("below"), F.count_if(above).alias("above"))
        plan = pin(sides.withColumn("splits", F.greatest("below", "above") <= _MOST * F.col("n")), "splits")
        both = placed.join(plan.where("splits"), _WHERE)
        side = F.explode(F.array_compact(F.array(F.when(below, F.lit(0)), F.when(above, F.lit(1)))))
        both = both.withColumn("side", side).withColumn("open", F.when(F.col("side") == 0, F.col("below")).otherwise(F.col("above")) > full)
        both = both.withColumn("leaf", F.xxhash64("leaf", "side"))
        done = done.unionByName(placed.join(plan.where("NOT splits"), _WHERE).select("rep", "leaf"))
        done = done.unionByName(both.where("NOT open").select("rep", "leaf"))
        if plan.where(F.col("splits") & (F.greatest("below", "above") > full)).isEmpty():
            break
        todo = both.where("open").select(*_WHERE, "rep", "vector")
    # As many leaves a vector as trees, and those of the spill.
    return done.groupBy("rep").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that rows a[k] and b[k] have in common; both ascend and are padded with _NONE."""
    first = np.full(len(a), _NONE, np.int64)
    for k in range(a.shape[1]):
        has = (b == a[:, k, None]).any(1)
        first = np.where(has, np.minimum(first, a[:, k]), first)
    return first


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    vectors = unit_rows(np.frombuffer(b"".join(table["vector"].to_pylist()), np.float64).reshape(table.num_rows, -1))
    lists = table["leaves"].to_pylist()
    leaves = np.full((len(lists), max(map(len, lists))), _NONE, np.int64)
    for k, x in enumerate(lists):
        leaves[k, : len(x)] = x
    leaf = table["leaf"][0].as_py()
    rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
    part = table["part"].to_numpy()
    p, q = table["one"][0].as_py(), table["two"][0].as_py()
    left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
    count = np.zeros(len(rep), np.int64)
    parent = np.arange(len(rep))
    for i in range(0, len(left), _BLOCK):
        a = left[i : i + _BLOCK]
        for j in range(i if p == q else 0, len(right), _BLOCK):
            b = right[j : j + _BLOCK]
            near = vectors[a] @ vectors[b].T >= threshold
            if p == q and i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            for k in range(0, len(x), 1 << 16):
                x_, y_ = a[x[k : k + (1 << 16)]], b[y[k : k + (1 << 16)]]
                mine = _first_common(leaves[x_], leaves[y_]) == leaf
                x_, y_ = x_[mine], y_[mine]
                np.add.at(count, x_, copies[y_])
                np.add.at(count, y_, copies[x_])
                unite(parent, x_, y_)
    some = np.flatnonzero(count)
    return pa.table({"a": rep[some], "b": rep[roots(parent, some)], "n": count[some]})


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    sample: int = SAMPLE,
    full: int = FULL,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors with equal labels link where their cosine, in double precision, is at
    least `threshold`. A vector with a null label or id, or that is null, empty, zero
    or has null or non-finite components, links with nothing; nor do vectors of
    different lengths. n_links counts other vectors, copies included; component_id is
    the least id reachable, kept whether it is the vector's own. Copies are compared
    once. A table without vectors gives no rows. Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(_usable(F.col("embedding")), F.lit(False))
    ids = rows.where(good)
    reps = pin(ids.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    total = reps.count()
    share = min(1.0, sample / max(1, total))
    drawn = reps.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(share * (1 << 30))).select("embedding").toArrow()["embedding"].to_pylist()
    by_size: dict[int, list] = {}
    for v in drawn:
        by_size.setdefault(len(v), []).append(v)
    forests = {n: fit_forest(np.array(v), int(total * len(v) / len(drawn)), trees, leaf, spill) for n, v in by_size.items()}
    shared = reps.sparkSession.sparkContext.broadcast(forests)
    kind = reps.schema["label"].dataType.simpleString()
    routed = reps.mapInArrow(
        lambda b: _route(b, shared.value),
        f"label {kind}, size int, rep long, copies long, vector binary, leaves array<long>",
    )
    spread = routed.withColumn("leaf", F.explode("leaves"))
    large = _larger(spread.select(*_WHERE), min(full, PART))
    over = large.where(F.col("n") > full)
    if not over.isEmpty():
        routed = routed.drop("leaves").join(pin(_split_again(spread, over, spill, full), "leaves"), "rep")
        spread = routed.withColumn("leaf", F.explode("leaves"))
        large = _larger(spread.select(*_WHERE), PART)
    cut = F.coalesce(F.ceil(F.col("n") / PART), F.lit(1)).cast("int")
    # Each vector of a large leaf goes to all pairs of parts that its own part is in.
    dealt = (
        spread.join(large, _WHERE, "left")
        .withColumn("parts", cut)
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("one", F.least("part", "other"))
        .withColumn("two", F.greatest("part", "other"))
        .select(*_WHERE, "rep", "copies", "vector", "leaves", "part", "one", "two")
    )
    links = pin(dealt.groupBy(*_WHERE, "one", "two").applyInArrow(lambda t: _compare(t, threshold), "a long, b long, n long"), "links")
    found = connected_components(links.select("a", "b"))
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    named = (
        reps.join(counts, "rep", "left")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = ids.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
