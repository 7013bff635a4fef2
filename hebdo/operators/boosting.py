"""Regularised histogram boosting (T1), many fits in one pass (T2, J5), exact attributions.

Rows carry the index of the first split that trains on them (``train_from``; later
splits train on them too) and of the one split that tests them (``test_at``), so
every (draw, split) fit reads one and the same table. As long as the table is at
most ``ROWS_PER_TASK`` rows, the fits are dealt over the tasks, each with its own
copy, and run there from the first round to the last. A larger table stays spread out: each
level of a tree is one Spark job that adds up its histograms, the driver sees those
alone, and several fits run at a time.

A fit is squared-error boosting on binned features: a leaf is worth
``-soft(G, alpha) / (H + lambda)``, a split must gain ``gamma`` and leave
``min_child`` rows on both sides. Rows are sampled by a hash of the row and the round, so the
trees do not depend on how the rows are dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.session import checkpoint_dir

#: most rows of which every task gets a copy (38 features: about 80 MB)
ROWS_PER_TASK = 250_000
_NODE = "draw int, split int, round int, node int, feature int, cut double, gain double, cover double, value double"


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    max_bin: int = 256
    seed: int = 42

    @classmethod
    def of(cls, params: dict) -> BoostParams:
        known = {f.name: type(f.default) for f in fields(cls)}
        return cls(**{k: known[k](v) for k, v in params.items()})


@dataclass
class Forest:
    """Node arrays (rounds, nodes) in heap order; a feature of -1 marks a leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return (self.feature.shape[1] + 1).bit_length() - 2

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        trees = np.arange(len(self.feature))[None, :]
        for lo in range(0, len(x), 1024):
            part = x[lo:lo + 1024]
            node = np.zeros((len(part), len(self.feature)), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[trees, node]
                right = ~(np.take_along_axis(part, np.maximum(f, 0), axis=1) < self.cut[trees, node])
                node = np.where(f < 0, node, 2 * node + 1 + right)
            out[lo:lo + 1024] = self.base + self.value[trees, node].sum(axis=1)
        return out

    def rows(self) -> dict[str, np.ndarray]:
        """The nodes that hold something, as columns; round -1 is the base."""
        used = (self.cover > 0) | (self.feature >= 0)
        used[:, 0] = True
        r, node = np.nonzero(used)
        col = {"round": r, "node": node} | {k: getattr(self, k)[used] for k in ("feature", "cut", "gain", "cover", "value")}
        first = {"round": -1, "node": 0, "feature": -1, "cut": 0.0, "gain": 0.0, "cover": 0.0, "value": self.base}
        return {k: np.concatenate([[first[k]], v]) for k, v in col.items()}

    @classmethod
    def of_rows(cls, col: dict[str, np.ndarray]) -> Forest:
        r, node = np.asarray(col["round"], dtype=np.int64), np.asarray(col["node"], dtype=np.int64)
        body = r >= 0
        nodes = int(node[body].max(initial=0)) + 1
        shape = (int(r.max(initial=-1)) + 1, (1 << nodes.bit_length()) - 1)
        arrays = {}
        for k in ("feature", "cut", "gain", "cover", "value"):
            a = np.full(shape, -1) if k == "feature" else np.zeros(shape)
            a[r[body], node[body]] = np.asarray(col[k])[body]
            arrays[k] = a
        return cls(base=float(np.asarray(col["value"])[~body][0]), **arrays)

    def attributions(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """(expected value, Shapley values): row sums are prediction minus expected value.

        Absent features follow both branches by cover. A leaf's path names few distinct
        features, so its Shapley values come from the coefficients of the product
        of (absent share + present t) over the path's other features."""
        expected, out = self.base, np.zeros(x.shape)
        for r in range(len(self.feature)):
            for reach, path, value in self._paths(r):
                expected += reach * value
                if not path or not value:
                    continue
                names = list(path)
                k = len(names)
                on = np.stack([(x[:, f] >= lo) & (x[:, f] < hi) if hi < np.inf
                               else ~(x[:, f] < lo) for f, (lo, hi, _) in path.items()], axis=1)
                off = np.array([path[f][2] for f in names])
                for j in range(k):
                    poly = np.ones((len(x), 1))
                    for i in range(k):
                        if i != j:
                            poly = (np.pad(poly, ((0, 0), (0, 1))) * off[i]
                                    + np.pad(poly, ((0, 0), (1, 0))) * on[:, i:i + 1])
                    weight = np.array([1 / (k * math.comb(k - 1, m)) for m in range(k)])
                    out[:, names[j]] += value * (on[:, j] - off[j]) * (poly @ weight)
        return float(expected), out

    def _paths(self, r: int) -> Iterator[tuple[float, dict[int, tuple[float, float, float]], float]]:
        """Leaves of a tree: (share of rows, feature -> (from, below, share of rows), value)."""
        stack: list[tuple[int, float, dict]] = [(0, 1.0, {})]
        while stack:
            node, reach, path = stack.pop()
            f = int(self.feature[r, node])
            if f < 0:
                yield reach, path, float(self.value[r, node])
                continue
            lo, hi, share = path.get(f, (-np.inf, np.inf, 1.0))
            cut = float(self.cut[r, node])
            for child, low, high in ((2 * node + 1, lo, min(hi, cut)), (2 * node + 2, max(lo, cut), hi)):
                part = float(self.cover[r, child] / self.cover[r, node])
                stack.append((child, reach * part, {**path, f: (low, high, share * part)}))


# ------------------------------------------------------------------ one fit

def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_draws(row: np.ndarray, r: int, seed: int) -> np.ndarray:
    """A number from 0 to 1 for each row, the same wherever the row is."""
    salt = np.uint64((r * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) % 2**64)
    return (_mix(_mix(row.view(np.uint64)) ^ _mix(np.array([salt], dtype=np.uint64))) >> np.uint64(11)) * 2.0**-53


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Ascending cuts of each feature, at most ``bins`` - 1: all values but the least where
    they are few, else values at even ranks. NaN lies above every cut."""
    out = []
    for j in range(x.shape[1]):
        v, n = np.unique(x[~np.isnan(x[:, j]), j], return_counts=True)
        if len(v) > bins:
            up = np.cumsum(n)
            pick = np.unique(np.searchsorted(up, np.arange(1, bins) / bins * up[-1], side="right"))
            out.append(v[pick[pick > 0]])
        else:
            out.append(v[1:])
    return out


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """How many cuts of its feature lie at or below each value."""
    return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], axis=1)


@dataclass
class Tree:
    """A tree while it grows: feature (-1: leaf), last bin on the left and value of each node."""

    feature: np.ndarray
    last: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, nodes: int) -> Tree:
        return cls(np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros(nodes))

    def walk(self, b: np.ndarray) -> np.ndarray:
        """The node that each row of bins is in so far."""
        node = np.zeros(len(b), dtype=np.int64)
        rows = np.arange(len(b))
        for _ in range(len(self.feature).bit_length() - 1):
            f = self.feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (b[rows, f] > self.last[node]))
        return node


def histograms(g: np.ndarray, place: np.ndarray, local: np.ndarray, nodes: int, columns: int, width: int) -> np.ndarray:
    """Sums of gradients, and counts, of rows by (node, column, bin)."""
    at = (place + (local * columns * width)[:, None]).ravel()
    cells = nodes * columns * width
    return np.stack([np.bincount(at, weights=np.repeat(g, columns), minlength=cells),
                     np.bincount(at, minlength=cells)]).reshape(2, nodes, columns, width)


class LocalRows:
    """Rows in this process, and where they are in the tree that grows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, row: np.ndarray, p: BoostParams):
        self.p, self.y, self.row = p, y, row
        self.cuts = cut_points(x, p.max_bin)
        self.base = float(y.sum() / len(y)) if len(y) else 0.0
        self.bins = binned(x, self.cuts)
        self.predicted = np.full(len(y), self.base)

    def begin(self, r: int, columns: np.ndarray, width: int) -> None:
        self.columns, self.width = columns, width
        self.own = np.flatnonzero(row_draws(self.row, r, self.p.seed) < self.p.subsample)
        self.g = self.predicted[self.own] - self.y[self.own]
        self.place = self.bins[np.ix_(self.own, columns)] + np.arange(len(columns)) * width
        self.node = np.zeros(len(self.y), dtype=np.int64)

    def sums(self, level: int, tree: Tree) -> np.ndarray:
        if level:
            for i in range(2 ** (level - 1) - 1, 2 ** level - 1):
                if tree.feature[i] >= 0:
                    rows = np.flatnonzero(self.node == i)
                    self.node[rows] = 2 * i + 1 + (self.bins[rows, tree.feature[i]] > tree.last[i])
        local = self.node[self.own] - (2 ** level - 1)
        live = local >= 0
        return histograms(self.g[live], self.place[live], local[live], 2 ** level, len(self.columns), self.width)

    def finish(self, tree: Tree) -> None:
        self.predicted += tree.value[tree.walk(self.bins)]


def grow(rows, n_features: int, p: BoostParams) -> Forest:
    """Boost over rows that sum their own histograms (``LocalRows`` or ``SparkRows``)."""
    width = max([1, *(len(c) + 1 for c in rows.cuts)])
    n_cuts = np.array([len(c) for c in rows.cuts])
    nodes = 2 ** (p.max_depth + 1) - 1
    forest = Forest(rows.base, np.full((p.n_estimators, nodes), -1),
                    *(np.zeros((p.n_estimators, nodes)) for _ in range(4)))
    rng = np.random.default_rng(p.seed)
    n_columns = max(1, int(p.colsample_bytree * n_features))

    def soft(g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0)

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return soft(g) ** 2 / np.maximum(h + p.reg_lambda, 1e-12)

    def leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -p.learning_rate * soft(g) / np.maximum(h + p.reg_lambda, 1e-12)

    for r in range(p.n_estimators):
        columns = np.sort(rng.choice(n_features, n_columns, replace=False))
        tree = Tree.of(nodes)
        rows.begin(r, columns, width)
        for level in range(p.max_depth):
            k, first = 2 ** level, 2 ** level - 1
            gl, hl = np.cumsum(rows.sums(level, tree), axis=3)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            hr = ht - hl
            gain = score(gl, hl) + score(gt - gl, hr) - score(gt, ht)
            gain[(np.minimum(hl, hr) < max(1, p.min_child_weight))
                 | (np.arange(width) >= n_cuts[columns][:, None])[None]] = -np.inf
            flat = gain.reshape(k, -1)
            at = np.arange(k)
            # splits that part the rows alike gain alike but for rounding: the first one counts,
            # however the rows are dealt
            top = flat.max(axis=1)
            best = (flat >= (top - 1e-10 * np.abs(top))[:, None]).argmax(axis=1)
            split = np.flatnonzero((top > 1e-6) & (top >= p.gamma))
            c, b = best // width, best % width
            here = first + at
            if not level:
                forest.cover[r, 0] = ht[0, 0, 0]
                tree.value[0] = leaf(gt[0, 0, 0], ht[0, 0, 0])
            for i in split:
                f, left, right = int(columns[c[i]]), 2 * here[i] + 1, 2 * here[i] + 2
                tree.feature[here[i]], tree.last[here[i]], tree.value[here[i]] = f, b[i], 0.0
                forest.cut[r, here[i]], forest.gain[r, here[i]] = rows.cuts[f][b[i]], top[i]
                g, h = gl[i, c[i], b[i]], hl[i, c[i], b[i]]
                forest.cover[r, [left, right]] = h, ht[i, 0, 0] - h
                tree.value[left], tree.value[right] = leaf(g, h), leaf(gt[i, 0, 0] - g, ht[i, 0, 0] - h)
            if not len(split):
                break
        forest.feature[r], forest.value[r] = tree.feature, tree.value
        rows.finish(tree)
    return forest


def boost(x: np.ndarray, y: np.ndarray, row: np.ndarray, p: BoostParams) -> Forest:
    """Fit a forest to rows (x, y), each with a 64-bit ``row`` hash."""
    return grow(LocalRows(x, y, row, p), x.shape[1], p)


# ------------------------------------------------------------------ fits on Spark

_BINNED = "_y double, _row long, _b binary, _p double"


@dataclass
class SparkRows:
    """Rows (_y, _row, _x) that stay spread over the cluster, as bins. Predictions are written
    down every ``keep`` rounds; in between, tasks follow the trees since then."""

    table: DataFrame
    n_features: int
    p: BoostParams
    keep: int = 25
    trees: list[Tree] = field(default_factory=list)

    def __post_init__(self):
        p, n = self.p, self.n_features
        if p.max_bin > 256:
            raise ValueError("bins are stored as bytes: max_bin is at most 256")
        value = [F.nullif(F.get("_x", F.lit(j)), F.lit(float("nan"))) for j in range(n)]
        ranks = F.array(*[F.lit(i / p.max_bin) for i in range(p.max_bin)])
        row = self.table.agg(F.avg("_y").alias("base"), *[
            F.percentile_approx(v, ranks, F.lit(100 * p.max_bin)).alias(f"q{j}") for j, v in enumerate(value)]).first()
        self.base = float(row.base or 0.0)
        self.cuts = cuts = [np.unique(np.array(row[f"q{j}"] or [0.0]))[1:] for j in range(n)]
        base = self.base

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                b = binned(_matrix(rb.column("_x"), n), cuts).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [rb.column("_y"), rb.column("_row"), pa.array([r.tobytes() for r in b], pa.binary()),
                     pa.array(np.full(len(b), base))], names=["_y", "_row", "_b", "_p"])

        checkpoint_dir(self.table.sparkSession)
        self.table = self.table.mapInArrow(run, _BINNED).checkpoint()

    def _bins(self, rb: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(rb.column("_b").to_pylist()), dtype=np.uint8).reshape(rb.num_rows, self.n_features)

    def begin(self, r: int, columns: np.ndarray, width: int) -> None:
        self.r, self.columns, self.width = r, columns, width

    def sums(self, level: int, tree: Tree) -> np.ndarray:
        """One job: histograms of each partition, added up column by column."""
        r, columns, width, trees, p, bins = self.r, self.columns, self.width, list(self.trees), self.p, self._bins
        k, shape = 2 ** level, (2, 2 ** level, len(columns), width)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for rb in batches:
                seen = row_draws(rb.column("_row").to_numpy(), r, p.seed) < p.subsample
                rb = rb.filter(pa.array(seen))
                if rb.num_rows:
                    b = bins(rb)
                    g = rb.column("_p").to_numpy() - rb.column("_y").to_numpy()
                    for t in trees:
                        g += t.value[t.walk(b)]
                    local = tree.walk(b) - (k - 1)
                    live = local >= 0
                    place = b[np.ix_(live, columns)] + np.arange(len(columns)) * width
                    total += histograms(g[live], place, local[live], k, len(columns), width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(columns)), pa.int32()),
                 pa.array([total[:, :, c].tobytes() for c in range(len(columns))], pa.binary())], names=["c", "sums"])

        def add(tab: pa.Table) -> pa.Table:
            parts = (np.frombuffer(v.as_buffer()) for chunk in tab.column("sums").chunks for v in chunk)
            return pa.table({"c": tab.column("c")[:1], "sums": pa.array([reduce(np.add, parts).tobytes()], pa.binary())})

        kind = "c int, sums binary"
        rows = self.table.mapInArrow(part, kind).groupBy("c").applyInArrow(add, kind).collect()
        out = np.zeros(shape)
        for c, sums in rows:
            out[:, :, c] = np.frombuffer(sums).reshape(2, k, width)
        return out

    def finish(self, tree: Tree) -> None:
        self.trees.append(tree)
        if len(self.trees) < self.keep or self.r + 1 == self.p.n_estimators:
            return
        trees, bins = list(self.trees), self._bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                predicted, b = rb.column("_p").to_numpy().copy(), bins(rb)
                for t in trees:
                    predicted += t.value[t.walk(b)]
                yield pa.RecordBatch.from_arrays([rb.column("_y"), rb.column("_row"), rb.column("_b"), pa.array(predicted)],
                                                 names=["_y", "_row", "_b", "_p"])

        self.table, self.trees = self.table.mapInArrow(run, _BINNED).checkpoint(), []

    def __getstate__(self):  # tasks get the helpers, not the table
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "trees")}


@dataclass(frozen=True)
class Fit:
    draw: int
    split: int
    params: BoostParams


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten() if len(column) else pa.array([], pa.float64())
    return x.to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _node_batch(fit: Fit, forest: Forest) -> pa.RecordBatch:
    col = forest.rows()
    size = len(col["node"])
    return pa.RecordBatch.from_arrays(
        [pa.array([v] * size, pa.int32()) for v in (fit.draw, fit.split)]
        + [pa.array(col[k], pa.int32()) for k in ("round", "node", "feature")]
        + [pa.array(col[k], pa.float64()) for k in ("cut", "gain", "cover", "value")], names=["draw", "split", *col])


def _dealt(df: DataFrame, lots: int) -> DataFrame:
    """A copy of the rows for each lot (column ``_lot``), each lot in a partition of its own. The
    number of partitions is asked for, so that small ones are not put together, and a lot
    goes by a number whose hash is that of its partition."""
    place = F.pmod(F.hash("id"), F.lit(lots))
    found = df.sparkSession.range(100 * lots).groupBy(place.alias("p")).agg(F.min("id").alias("id")).collect()
    mark = {r.p: r.id for r in found}
    marks = F.array(*[F.lit(mark.get(i, i)).cast("long") for i in range(lots)])
    return df.select("*", F.posexplode(marks).alias("_lot", "_mark")).repartition(lots, "_mark").drop("_mark")


def run_fits(rows: DataFrame, fits: list[Fit], features: list[str], label: str, keep: list[str],
             models: bool = False, rows_per_task: int = ROWS_PER_TASK, at_once: int = 4) -> DataFrame:
    """Rows with ``train_from`` and ``test_at`` -> (draw, split, *keep, actual, predicted) of the
    tested rows of every fit, or with ``models`` the node rows of its forest.

    A null feature counts as greater than every cut, a row without a label trains no
    fit, a fit without training rows gives no rows."""
    spark = rows.sparkSession
    # a row is known by what identifies it, or, without such columns, by its values
    told = rows.select(
        "train_from", "test_at", F.col(label).cast("double").alias("_y"),
        F.xxhash64(*(keep or [label, *features])).alias("_row"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("_x"), *keep)
    kept = T.StructType([told.schema[c] for c in keep])
    schema = _NODE if models else T.StructType(
        [T.StructField("draw", T.IntegerType()), T.StructField("split", T.IntegerType()), *kept.fields,
         T.StructField("actual", T.DoubleType()), T.StructField("predicted", T.DoubleType())])
    width = len(features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        every = pa.Table.from_batches(got)
        lot = every.column("_lot").to_numpy()
        for mine in np.unique(lot):              # one, unless Spark put small partitions together
            yield from fitted(every.filter(pa.array(lot == mine)), fits[mine::lots])

    def fitted(tab: pa.Table, own_fits: list[Fit]) -> Iterator[pa.RecordBatch]:
        tab = tab.take(pa.array(np.argsort(tab.column("_row").to_numpy(), kind="stable")))
        x = _matrix(tab.column("_x").combine_chunks(), width)
        y, row = (tab.column(c).to_numpy() for c in ("_y", "_row"))
        trains, tests = (np.where(np.isnan(v := tab.column(c).to_numpy().astype(float)), none, v)
                         for c, none in (("train_from", np.inf), ("test_at", -1)))
        for fit in own_fits:
            own = (trains <= fit.split) & ~np.isnan(y)
            hit = np.flatnonzero(tests == fit.split)
            if not own.any() or not (models or len(hit)):
                continue
            forest = boost(x[own], y[own], row[own], fit.params)
            if models:
                yield _node_batch(fit, forest)
            else:
                out = tab.take(pa.array(hit))
                yield from pa.table(
                    [pa.array([v] * len(hit), pa.int32()) for v in (fit.draw, fit.split)]
                    + [out.column(c) for c in keep] + [pa.array(y[hit]), pa.array(forest.predict(x[hit]))],
                    names=["draw", "split", *keep, "actual", "predicted"]).combine_chunks().to_batches()

    slots = spark.sparkContext.defaultParallelism
    lots = max(1, min(len(fits), slots))
    if rows.count() <= rows_per_task:
        return _dealt(told, lots).mapInArrow(work, schema)

    def spread(fit: Fit) -> DataFrame | None:
        own = told.where((F.col("train_from") <= fit.split) & F.col("_y").isNotNull()).select("_y", "_row", "_x")
        if own.isEmpty():
            return None
        forest = grow(SparkRows(own, width, fit.params), width, fit.params)
        if models:
            return spark.createDataFrame(pa.Table.from_batches([_node_batch(fit, forest)]))
        scored = BoostedTrees(forest, features).transform(told.where(F.col("test_at") == fit.split), F.col("_x"))
        return scored.select(F.lit(fit.draw).alias("draw"), F.lit(fit.split).alias("split"), *keep,
                             F.col("_y").alias("actual"), "predicted")

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        found = [df for df in pool.map(spread, fits) if df is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


class BoostedTrees:
    """A fitted forest and the features it reads."""

    def __init__(self, forest: Forest, features: list[str]):
        self.forest, self.features = forest, list(features)

    def transform(self, df: DataFrame, values: Column | None = None) -> DataFrame:
        """Add ``predicted``; ``values`` is the array of features if they are no columns."""
        forest, width = self.forest, len(self.features)
        values = F.array(*[F.col(c).cast("double") for c in self.features]) if values is None else values
        # a mapping, not a column function: the features are worked out once, and a chain of
        # forecast steps stays a chain instead of one nested expression
        schema = T.StructType([*df.drop("predicted").schema.fields, T.StructField("predicted", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                made = forest.predict(_matrix(rb.column("_features"), width))
                yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(made, pa.float64())],
                                                 names=[*rb.schema.names[:-1], "predicted"])

        return df.drop("predicted").withColumn("_features", values).mapInArrow(run, schema)

    def attributions(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """(*keep, feature, attribution, base): exact Shapley values of each prediction."""
        forest, names = self.forest, self.features

        @F.pandas_udf("array<double>")
        def explain(rows):
            import pandas as pd

            if not len(rows):
                return pd.Series([], dtype=object)
            base, parts = forest.attributions(np.stack(rows.to_numpy()).astype(np.float64))
            return pd.Series([[base, *p] for p in parts])

        told = df.select(*keep, explain(F.array(*[F.col(c).cast("double") for c in names])).alias("_a"))
        label = F.array(*[F.lit(n) for n in names])
        return told.select(*keep, F.col("_a")[0].alias("base"),
                           F.posexplode(F.slice("_a", 2, len(names))).alias("_i", "attribution")).select(
            *keep, F.element_at(label, F.col("_i") + 1).alias("feature"), "attribution", "base")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The model as a table (round, node, feature name or null, cut, gain, cover, value)."""
        col = self.forest.rows()
        kinds = _NODE.split(", ")[2:]
        rows = zip(*(col[k.split()[0]].tolist() for k in kinds))
        named = F.element_at(F.array(*[F.lit(n) for n in self.features]), F.col("feature") + 1)
        return spark.createDataFrame(list(rows), ", ".join(kinds)).withColumn(
            "feature", F.when(F.col("feature") >= 0, named))

    def save(self, spark: SparkSession, path: str) -> None:
        names = spark.createDataFrame([(-2, i, n) for i, n in enumerate(self.features)],
                                      "round int, node int, feature string")
        names = names.select("round", "node", "feature", *[F.lit(0.0).alias(c) for c in ("cut", "gain", "cover", "value")])
        self.nodes(spark).unionByName(names).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(path).collect()      # rounds x nodes, whatever the data
        names = [r.feature for r in sorted((r for r in rows if r["round"] == -2), key=lambda r: r.node)]
        place = {n: i for i, n in enumerate(names)}
        body = [r for r in rows if r["round"] >= -1]
        col = {k: np.array([r[k] for r in body]) for k in ("round", "node", "cut", "gain", "cover", "value")}
        col["feature"] = np.array([place.get(r.feature, -1) for r in body])
        return cls(Forest.of_rows(col), names)


def fit_one(train: DataFrame, params: dict, features: list[str], label: str, keep: list[str],
            rows_per_task: int = ROWS_PER_TASK) -> BoostedTrees:
    """One forest of all rows."""
    rows = train.withColumns({"train_from": F.lit(0), "test_at": F.lit(None).cast("int")})
    found = run_fits(rows, [Fit(0, 0, BoostParams.of(params))], features, label, keep, True, rows_per_task).collect()
    if not found:
        raise ValueError("no training rows")
    names = ("round", "node", "feature", "cut", "gain", "cover", "value")
    return BoostedTrees(Forest.of_rows({k: np.array([r[k] for r in found]) for k in names}), features)
