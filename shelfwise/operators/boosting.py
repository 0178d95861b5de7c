"""Boosted regression trees with an L2 penalty, grown from histograms; many models in the same passes.

Rows are binned once and stored as one byte a feature, some thousands of rows a block.  A pass over them grows one level of one tree of
every model at hand: tasks add up gradients and counts (the Hessian of a squared error) by node, feature and
bin, a shuffle adds the tasks' sums by model, and the best splits, not the sums, come back.  A search over
parameter sets and folds so costs the passes of its deepest model.
A table of at most ``COPIED_ROWS`` rows (some 60 MB) needs no shuffle between levels: it is copied for each core, models
are dealt over the copies, and a pass grows all trees that are asked for.  There features are counted several at a
time, and of two siblings only the smaller is counted.  The models are the same either way.

Gradients are whole multiples of a power of two, so their sums are exact: neither the number of tasks nor
their order changes a model.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.session import settings, stage

#: Bins of a feature, and how many tasks' sums one step adds up.
BINS, FAN_IN = 64, 64
#: Rows up to which a table is copied for each core, as a broadcast table would be.
COPIED_ROWS = 1 << 21
#: Bins that features counted together may have, for ever fewer rows, and rows that are worked on at a time.
JOINT_BINS, CHUNK = (1 << 14, 1 << 12, 1 << 8, 1), 1 << 15
BLOCK = "row binary, fold binary, y binary, x binary, margins binary"
SUMS = "model int, part long, sums binary, error double, held long"
SPLIT = "model int, node int, feature int, cut int, total_g double, total_h double, left_g double, left_h double, error double, held long"


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    max_depth: int = 5
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    reg_lambda: float = 1.0


@dataclass
class Tree:
    """Nodes as in a heap: those below ``i`` are ``2i + 1`` (value up to the cut) and ``2i + 2``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = (2 << depth) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size), np.zeros(size))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range((len(self.feature) + 1).bit_length() - 2):
            if not (self.feature[node] >= 0).any():
                break
            node = self.below(x, node, rows)
        return node

    def below(self, x: np.ndarray, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where each row goes from its node; it stays where there is no split."""
        feature = self.feature[node]
        return np.where(feature >= 0, 2 * node + 1 + (x[rows, feature] > self.cut[node]), node)


@dataclass
class BoostedModel:
    """A fitted model; scores any table that has its features."""

    features: list[str]
    base: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        found = np.full(len(x), self.base)
        for tree in self.trees:
            found += tree.value[tree.leaves(x)]
        return found

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with the prediction; features without a value count as 0."""
        scored = F.pandas_udf(lambda *columns: pd.Series(self.predict(np.column_stack([c.to_numpy(np.float64) for c in columns]))), "double")
        return df.withColumn(output, scored(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(t, n, int(f), float(c), float(v)) for t, tree in enumerate(self.trees) for n, (f, c, v) in enumerate(zip(tree.feature, tree.cut, tree.value))]
        nodes = spark.createDataFrame(rows, "tree int, node int, feature int, cut double, value double")
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = spark.createDataFrame([(self.features, self.base)], "features array<string>, base double")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        about = spark.read.parquet(f"{path}/about").first()
        trees: dict[int, list] = {}
        for row in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            trees.setdefault(row.tree, []).append(row)
        made = [Tree(np.array([r.feature for r in t], np.int32), np.array([r.cut for r in t]), np.array([r.value for r in t])) for t in trees.values()]
        return cls(list(about.features), about.base, made)


@dataclass(eq=False)
class Fit:
    """A model in the making: all rows but those of ``fold`` train it, and that fold tells its error."""

    params: BoostParams
    fold: int | None = None
    seed: int = 0
    columns: tuple[int, ...] | None = None  # features it may use
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    stored: int = 0  # trees whose sum the table holds
    errors: list[float] = field(default_factory=list)  # root mean squared error of the fold, by the number of trees

    def offered(self, width: int, tree: int) -> np.ndarray:
        """Which features a tree may split on."""
        columns = list(self.columns or range(width))
        few = max(1, int(self.params.colsample * len(columns)))
        mask = np.zeros(width, bool)
        mask[random.Random(f"{self.seed} {tree}").sample(columns, few)] = True
        return mask


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Cuts between bins of about equal size; a bin holds the values up to its cut."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, F.lit(10_000)).alias(c) for c in features]).first()
    return [np.unique(np.array(found[c], np.float64)) for c in features]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def drawn(row: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Rows that a tree sees: a share of them by a hash of row, model and tree."""
    if share >= 1:
        return np.ones(len(row), bool)
    salt, least, found = mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64)), np.uint64(int(share * 2**63) * 2), np.empty(len(row), bool)
    for at in range(0, len(row), CHUNK):
        found[at : at + CHUNK] = mixed(row[at : at + CHUNK].view(np.uint64) ^ salt) < least
    return found


@dataclass
class Growing:
    """What a pass needs of a model: its trees that the table has not, the tree being grown and its level."""

    model: int
    place: int | None  # of its sum in the table
    fold: int | None
    seed: int
    number: int
    share: float
    base: float
    done: list[Tree]
    tree: Tree
    level: int


def margin_of(x: np.ndarray, margins: np.ndarray, grow: Growing) -> np.ndarray:
    """What the finished trees predict."""
    margin = np.full(len(x), grow.base) if grow.place is None else margins[:, grow.place]
    for tree in grow.done:
        margin = margin + tree.value[tree.leaves(x)]
    return margin


def fold_error(margin: np.ndarray, y: np.ndarray, fold: np.ndarray, held: int | None) -> tuple[float, int]:
    """The squared error over the model's fold, and the fold's rows."""
    if held is None:
        return 0.0, 0
    out = fold == held
    return float(((margin - y)[out] ** 2).sum()), int(out.sum())


def trains(row: np.ndarray, fold: np.ndarray, grow: Growing) -> np.ndarray:
    """Rows that the tree sees."""
    seen = drawn(row, grow.seed, grow.number, grow.share)
    return seen if grow.fold is None else seen & (fold != grow.fold)


def histograms(x: np.ndarray, at: np.ndarray, node: np.ndarray, gradient: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """Gradients and counts by node, feature and bin of the rows ``at``; a feature at a time, so nothing is as wide as the table."""
    sums, first = np.zeros((2, nodes, x.shape[1], bins)), node * bins
    for f in range(x.shape[1]):
        place = first + x[:, f][at]
        sums[0, :, f] = np.bincount(place, gradient, nodes * bins).reshape(nodes, bins)
        sums[1, :, f] = np.bincount(place, minlength=nodes * bins).reshape(nodes, bins)
    return sums


def level_sums(x: np.ndarray, y: np.ndarray, fold: np.ndarray, row: np.ndarray, margins: np.ndarray, grow: Growing, scale: float, bins: int) -> tuple[np.ndarray, float, int]:
    """Gradients and counts by node of the level, feature and bin; and the squared error over the model's fold."""
    margin = margin_of(x, margins, grow)
    error, held = fold_error(margin, y, fold, grow.fold) if grow.level == 0 else (0.0, 0)
    node = grow.tree.leaves(x) - ((1 << grow.level) - 1)
    seen = np.flatnonzero((node >= 0) & trains(row, fold, grow))
    return histograms(x, seen, node[seen], np.rint((margin - y)[seen] * scale), 1 << grow.level, bins), error, held


def packed_sums(sums: np.ndarray) -> bytes:
    """Places, gradients and counts of what isn't zero."""
    at = np.flatnonzero(sums[1].ravel()).astype(np.int32)
    return at.tobytes() + sums[1].ravel()[at].astype(np.int32).tobytes() + sums[0].ravel()[at].tobytes()


def add_packed(total: np.ndarray, data: bytes) -> None:
    n = len(data) // 16
    at, counts = np.frombuffer(data, np.int32, n), np.frombuffer(data, np.int32, n, 4 * n)
    total[0].ravel()[at] += np.frombuffer(data, np.float64, n, 8 * n)
    total[1].ravel()[at] += counts


def best_splits(sums: np.ndarray, offered: np.ndarray, penalty: float, scale: float) -> list[tuple[int, int, float, float, float, float]]:
    """For each node its best feature and cut (-1: none), its sums and those of the values up to the cut."""
    g, h = sums[0] / scale, sums[1]
    total_g, total_h = g[:, :1, :].sum(axis=2), h[:, :1, :].sum(axis=2)
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    right_g, right_h = total_g[:, :, None] - left_g, total_h[:, :, None] - left_h
    gain = left_g**2 / (left_h + penalty + 1e-300) + right_g**2 / (right_h + penalty + 1e-300) - (total_g**2 / (total_h + penalty + 1e-300))[:, :, None]
    gain[(left_h < 1) | (right_h < 1)] = -np.inf
    gain[:, ~offered, :] = -np.inf
    found, bins = [], gain.shape[2]
    for n, best in enumerate(gain.reshape(len(gain), -1).argmax(axis=1)):
        feature, cut = divmod(int(best), bins)
        good = gain[n, feature, cut] > 1e-9 * max(1.0, float(total_g[n, 0] ** 2))
        left = (float(left_g[n, feature, cut]), float(left_h[n, feature, cut])) if good else (0.0, 0.0)
        found.append((feature if good else -1, cut, float(total_g[n, 0]), float(total_h[n, 0]), *left))
    return found


def place_splits(tree: Tree, waiting: set[int], level: int, found: Sequence[tuple], params: BoostParams) -> None:
    """Splits and values of a level's nodes; ``waiting`` are the nodes that may still be split."""
    rate, penalty = params.learning_rate, params.reg_lambda
    for at, (feature, cut, total_g, total_h, left_g, left_h) in found:
        node = (1 << level) - 1 + at
        if node not in waiting:
            continue
        waiting.discard(node)
        sides = [(node, total_g, total_h)]
        if feature >= 0:
            tree.feature[node], tree.cut[node] = feature, cut
            sides = [(2 * node + 1, left_g, left_h), (2 * node + 2, total_g - left_g, total_h - left_h)]
            if level + 1 < params.max_depth:
                waiting |= {n for n, _, _ in sides}
        for n, g, h in sides:
            tree.value[n] = -rate * g / (h + penalty) if h + penalty else 0.0


def joint_groups(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Features that are counted together: those of a group have at most ``most`` bins between them, if more than one."""
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        at = next((g for g in groups if math.prod(sizes[o] for o in g) * sizes[f] <= most), None)
        groups.append([f]) if at is None else at.append(f)
    return groups


class Counted:
    """Rows of a copied table by their bins, those of several features as one number; and room for what a tree needs."""

    def __init__(self, x: np.ndarray, bins: int):
        self.x, self.bins, self.width = x, bins, x.shape[1]
        sizes = [int(x[:, f].max()) + 1 if len(x) else 1 for f in range(self.width)]
        self.ways: list[list[tuple]] = []  # groups of features with their bins and codes
        for most in JOINT_BINS:
            groups = joint_groups(sizes, most)
            if not self.ways or groups != [g for g, _, _ in self.ways[-1]]:
                self.ways.append([(g, [sizes[f] for f in g], self.code(g, sizes)) for g in groups])

    def code(self, group: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
        code = np.zeros(len(self.x), np.uint16)
        for f in group:
            code = code * np.uint16(sizes[f]) + self.x[:, f]
        return code

    def sums(self, nodes: Sequence[int], node: np.ndarray, seen: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """Gradients and counts by node of ``nodes``, feature and bin, of the rows ``seen`` that are at such a node."""
        listed, place_of = np.zeros(max(nodes) + 2, bool), np.zeros(max(nodes) + 2, np.int64)
        listed[list(nodes)], place_of[list(nodes)] = True, range(len(nodes))
        at = [i + np.flatnonzero(listed.take(node[i : i + CHUNK], mode="clip") & seen[i : i + CHUNK]) for i in range(0, len(node), CHUNK)]
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        most = len(at) // len(nodes) // 2
        way = next((w for w in self.ways if sum(math.prod(shape) for _, shape, _ in w) <= most), self.ways[-1])
        found = np.zeros((2, len(nodes), self.width, self.bins))
        joint = [np.zeros((2, len(nodes) * math.prod(shape))) for _, shape, _ in way]
        for rows in (at[i : i + 4 * CHUNK] for i in range(0, len(at), 4 * CHUNK)):
            given, first = gradient.take(rows, mode="clip"), place_of.take(node.take(rows, mode="clip"), mode="clip")
            for (_, shape, code), of in zip(way, joint):
                place = first * math.prod(shape)
                place += code.take(rows, mode="clip")
                of[0] += np.bincount(place, given, of.shape[1])
                of[1] += np.bincount(place, minlength=of.shape[1])
        for (group, shape, _), of in zip(way, joint):
            of = of.reshape(2, len(nodes), *shape)
            for i, f in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != i)
                found[:, :, f, : shape[i]] = of.sum(axis=others) if others else of
        return found

    def tree(self, params: BoostParams, offered: np.ndarray, gradient: np.ndarray, seen: np.ndarray, scale: float) -> tuple[Tree, np.ndarray]:
        """A tree grown from the rows ``seen``, and the node in which each row ends."""
        tree, waiting, sums, rows = Tree.empty(params.max_depth), {0}, {}, {}
        node = np.zeros(len(self.x), np.min_scalar_type(2 << params.max_depth))
        for level in range(params.max_depth):
            nodes, first = sorted(waiting), (1 << level) - 1
            if not nodes:
                break
            # Of two siblings the one with fewer rows is counted, the other one is what their parent has besides.
            few = [n for n in nodes if not level or (rows[n], n) < (rows[other(n)], other(n))]
            made = self.sums(few, node, seen, gradient)
            own = {n: made[:, i] for i, n in enumerate(few)}
            sums = own if not level else own | {other(n): sums[(n - 1) // 2] - own[n] for n in few}
            found = best_splits(np.stack([sums[n] for n in nodes], axis=1), offered, params.reg_lambda, scale)
            place_splits(tree, waiting, level, [(n - first, f) for n, f in zip(nodes, found)], params)
            for n, (_, _, _, total_h, _, left_h) in zip(nodes, found):
                rows[2 * n + 1], rows[2 * n + 2] = left_h, total_h - left_h
            self.route(node, tree, [n for n in nodes if tree.feature[n] >= 0])
        return tree, node

    def route(self, node: np.ndarray, tree: Tree, nodes: Sequence[int]) -> None:
        """Moves the rows at ``nodes``, all of one level, to the nodes below, by comparing bytes in a row."""
        splits = [(node.dtype.type(n), node.dtype.type(n + 1), self.x[:, tree.feature[n]], np.uint8(tree.cut[n])) for n in nodes]
        for i in range(0, len(node), CHUNK):
            at = node[i : i + CHUNK]
            for n, more, column, cut in splits:
                here = at == n
                above = column[i : i + CHUNK] > cut
                above &= here
                at += here * more
                at += above


def other(node: int) -> int:
    """The node's sibling."""
    return node + 1 if node % 2 else node - 1


def rounded_gradient(margin: np.ndarray, y: np.ndarray, scale: float) -> np.ndarray:
    found = np.empty(len(y))
    for at in range(0, len(y), CHUNK):
        part = slice(at, at + CHUNK)
        np.subtract(margin[part], y[part], out=found[part])
        found[part] *= scale
        np.rint(found[part], out=found[part])
    return found


def dealt(costs: Sequence[float], copies: int) -> list[list[int]]:
    """Models by copy: the dearest first, each to the copy with the least so far."""
    found, loads = [[] for _ in range(copies)], [0.0] * copies
    for model in sorted(range(len(costs)), key=lambda m: (-costs[m], m)):
        copy = loads.index(min(loads))
        loads[copy] += costs[model]
        found[copy].append(model)
    return found


def block(row: np.ndarray, fold: np.ndarray, y: np.ndarray, x: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    """Rows as one row of bytes; features stand one after another, sums row by row."""
    made = (row.astype(np.int64), fold.astype(np.int32), y.astype(np.float64), x.T.astype(np.uint8), margins.astype(np.float64))
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in made], [c.split()[0] for c in BLOCK.split(", ")])


def arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Features, target, fold, row and sums of each block."""
    for i in range(batch.num_rows):
        row, fold, y, x, margins = (
            np.frombuffer(batch.column(c)[i].as_buffer(), kind)
            for c, kind in (("row", np.int64), ("fold", np.int32), ("y", np.float64), ("x", np.uint8), ("margins", np.float64))
        )
        yield x.reshape(-1, len(row)).T, y, fold, row, margins.reshape(len(row), -1)


class Booster:
    """Grows models over one binned table, all of them in the same passes."""

    def __init__(self, rows: DataFrame, features: Sequence[str], key: str = "Product_ID", bins: int = BINS):
        self.spark, self.features, self.bins = rows.sparkSession, list(features), bins
        self.edges = bin_edges(rows, self.features, bins)
        edges = self.edges

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [np.searchsorted(e, batch.column(str(i)).to_numpy(zero_copy_only=False)) for i, e in enumerate(edges)]
                x = np.column_stack(columns).astype(np.uint8) if columns else np.zeros((batch.num_rows, 0), np.uint8)
                if batch.num_rows:
                    row, fold, y = (c.to_numpy(zero_copy_only=False) for c in (batch.column("row"), batch.column("fold").fill_null(-1), batch.column("y")))
                    yield block(row, fold, y, x, np.zeros((batch.num_rows, 0)))

        fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(0)
        values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(str(i)) for i, c in enumerate(self.features)]
        asked = rows.select(F.xxhash64(key).alias("row"), fold.alias("fold"), F.col("target").cast("double").alias("y"), *values)
        self.stored = stage(asked.mapInArrow(binned, BLOCK), "binned", even=True)
        about = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("most")).first()
        self.rows, self.table, self.copies = about.n, self.stored, 0
        self.deal()
        # The largest power of two at which no sum of gradients, even of twice the largest target, passes 2^52.
        self.scale = 2.0 ** min(40, 51 - math.ceil(math.log2(max(1e-9, about.most or 0.0) * 4 * max(1, about.n))))
        whole = F.sum(F.rint(F.col("y") * self.scale).cast("decimal(38,0)"))
        sums = asked.groupBy("fold").agg(whole.alias("y"), F.count(F.lit(1)).alias("n")).collect()
        self.folds = {r.fold: (int(r.y) / self.scale, r.n) for r in sums}
        self.held: list[Fit] = []

    def deal(self) -> None:
        """The stored table as passes read it: as it is, or a small one once for each core, kept in memory."""
        self.close()
        self.parts = self.stored.rdd.getNumPartitions()
        self.table, self.copies = self.stored, 0
        if self.rows <= COPIED_ROWS:
            self.copies = self.spark.sparkContext.defaultParallelism
            copied = self.stored.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(self.copies - 1))))
            with settings(self.spark, {"spark.sql.adaptive.enabled": "false"}):  # as passes have it, which look the kept table up
                self.table = copied.repartitionByRange(self.copies, "copy").persist()

    def close(self) -> None:
        if self.copies:
            self.table.unpersist()

    def start(self, fits: Sequence[Fit]) -> list[Fit]:
        for fit in fits:
            seen = [v for f, v in self.folds.items() if f != fit.fold]
            fit.base = sum(y for y, _ in seen) / max(1, sum(n for _, n in seen))
        return list(fits)

    def grow(self, fits: Sequence[Fit], trees: int, every: int = 12) -> None:
        """Up to ``trees`` more trees for each model (none beyond its number); sums are stored anew every few trees."""
        with settings(self.spark, {"spark.sql.adaptive.enabled": "false"}):
            if self.copies:
                self.grow_copies(fits, trees)
                return
            for _ in range(trees):
                growing = [f for f in fits if len(f.trees) < f.params.n_estimators]
                if not growing:
                    break
                if max(len(f.trees) - f.stored for f in growing) >= every:
                    self.store(growing)
                self.tree(growing)

    def grow_copies(self, fits: Sequence[Fit], trees: int) -> None:
        """The same where each task has all rows: a pass for all of the trees."""
        scale, bins, width = self.scale, self.bins, len(self.features)
        ends = [min(len(f.trees) + trees, f.params.n_estimators) for f in fits]
        models = dealt([(end - len(f.trees) + 1) * (f.params.max_depth + 2) for f, end in zip(fits, ends)], self.copies)

        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held_blocks: dict[int, list] = {}
            for batch in batches:
                for copy, given in zip(batch.column("copy").to_pylist(), arrays(batch)):
                    held_blocks.setdefault(copy, []).append(given[:4])
            for copy in sorted(held_blocks):
                x, y, fold, row = (np.concatenate(c) for c in zip(*held_blocks.pop(copy)))
                counted = Counted(np.asfortranarray(x), bins)
                for model in models[copy]:
                    yield from grown_model(model, counted, y, fold, row)

        def grown_model(model: int, counted: Counted, y: np.ndarray, fold: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
            fit, out = fits[model], [[], [], [], [], []]
            margin = np.full(len(y), fit.base)
            for tree in fit.trees:
                margin = margin + tree.value[tree.leaves(counted.x)]
            train, held = fold != fit.fold, np.flatnonzero(fold == fit.fold)
            if fit.fold is None:
                train, held = np.ones(len(y), bool), held[:0]
            target = y[held]
            for number in range(len(fit.trees), ends[model] + 1):
                error = math.sqrt(float(((margin.take(held) - target) ** 2).sum()) / len(held)) if len(held) else 0.0
                packed = b""
                if number < ends[model]:  # else only the error after the last tree
                    seen = drawn(row, fit.seed, number, fit.params.subsample)
                    seen &= train
                    tree, node = counted.tree(fit.params, fit.offered(width, number), rounded_gradient(margin, y, scale), seen, scale)
                    for i in range(0, len(y), CHUNK):
                        margin[i : i + CHUNK] += tree.value.take(node[i : i + CHUNK])
                    packed = tree.feature.astype(np.int16).tobytes() + tree.cut.astype(np.uint8).tobytes() + tree.value.tobytes()
                for column, value in zip(out, (model, number, packed, error, fit.fold is not None)):
                    column.append(value)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["model", "number", "tree", "error", "judged"])

        found = self.table.mapInArrow(grown, "model int, number int, tree binary, error double, judged boolean").collect()
        for row in sorted(found, key=lambda r: (r.model, r.number)):
            fit = fits[row.model]
            if row.judged and row.number == len(fit.errors):
                fit.errors.append(row.error)
            if row.number < ends[row.model]:
                size = len(row.tree) // 11
                feature, cut = np.frombuffer(row.tree, np.int16, size), np.frombuffer(row.tree, np.uint8, size, 2 * size)
                fit.trees.append(Tree(feature.astype(np.int32), cut.astype(np.float64), np.frombuffer(row.tree, np.float64, size, 3 * size).copy()))

    def tree(self, fits: Sequence[Fit]) -> None:
        """One more tree for each model, a level of all a pass."""
        made = [Tree.empty(f.params.max_depth) for f in fits]
        offered = [f.offered(len(self.features), len(f.trees)) for f in fits]
        waiting = {i: {0} for i in range(len(fits))}  # nodes that may still be split
        for level in range(max(f.params.max_depth for f in fits)):
            live = [i for i, f in enumerate(fits) if waiting[i] and level < f.params.max_depth]
            if not live:
                break
            found: dict[int, list] = {}
            for row in self.splits([self.growing(fits[i], i, made[i], level) for i in live], [offered[i] for i in live], [fits[i].params.reg_lambda for i in live]):
                fit = fits[row.model]
                if level == 0 and fit.fold is not None and len(fit.errors) == len(fit.trees):
                    fit.errors.append(math.sqrt(row.error / row.held) if row.held else 0.0)
                found.setdefault(row.model, []).append((row.node, tuple(row[2:8])))
            for i, splits in found.items():
                place_splits(made[i], waiting[i], level, splits, fits[i].params)
        for fit, tree in zip(fits, made):
            fit.trees.append(tree)

    def growing(self, fit: Fit, model: int, tree: Tree, level: int) -> Growing:
        place = next((i for i, f in enumerate(self.held) if f is fit), None)
        done = fit.trees[0 if place is None else fit.stored :]
        return Growing(model, place, fit.fold, fit.seed, len(fit.trees), fit.params.subsample, fit.base, done, tree, level)

    def errors(self, fits: Sequence[Fit]) -> None:
        """The error after the last tree, which no further pass has told."""
        late = [f for f in fits if len(f.errors) == len(f.trees)]
        if late:
            for row in self.splits([self.growing(f, i, Tree.empty(1), 0) for i, f in enumerate(late)], [np.ones(len(self.features), bool)] * len(late), [1.0] * len(late)):
                late[row.model].errors.append(math.sqrt(row.error / row.held) if row.held else 0.0)

    def splits(self, growing: list[Growing], offered: list[np.ndarray], penalties: list[float]) -> list:
        """The pass: sums by task, added up by model, best splits of every node."""
        scale, bins, width = self.scale, self.bins, len(self.features)
        chosen = {g.model: (o, p, g.level) for g, o, p in zip(growing, offered, penalties)}
        names = lambda schema: [c.split()[0] for c in schema.split(", ")]

        def split(total: dict[int, list]) -> pa.Table:
            rows = []
            for model, (sums, error, held) in total.items():
                offer, penalty, _ = chosen[model]
                rows += [(model, node, *best, error, held) for node, best in enumerate(best_splits(sums, offer, penalty, scale))]
            kinds = [pa.int32()] * 4 + [pa.float64()] * 5 + [pa.int64()]
            return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names(SPLIT))

        def sent(total: dict[int, list], part: int) -> pa.Table:
            rows = [(model, part, packed_sums(sums), error, held) for model, (sums, error, held) in total.items()]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.float64(), pa.int64())
            return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names(SUMS))

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            part = 0
            for batch in batches:
                for given in arrays(batch):
                    part = int(given[3][0] & 0x7FFFFFFF)
                    for g in growing:
                        sums, error, held = level_sums(*given, g, scale, bins)
                        if g.model in total:
                            sums, error, held = total[g.model][0] + sums, total[g.model][1] + error, total[g.model][2] + held
                        total[g.model] = [sums, error, held]
            yield from sent(total, part).to_batches()

        def by_model(table: pa.Table) -> dict[int, list]:
            total: dict[int, list] = {}
            for row in sorted(table.to_pylist(), key=lambda r: (r["model"], r["part"])):
                of = total.setdefault(row["model"], [np.zeros((2, 1 << chosen[row["model"]][2], width, bins)), 0.0, 0])
                add_packed(of[0], row["sums"])
                of[1:] = of[1] + row["error"], of[2] + row["held"]
            return total

        sums, parts = self.stored.mapInArrow(of_task, SUMS), self.parts
        while parts > FAN_IN:  # tasks' sums in steps, so that no group grows with the table
            parts = -(-parts // FAN_IN)
            to = F.pmod(F.xxhash64("part"), F.lit(parts)).alias("to")
            sums = sums.groupBy("model", to).applyInArrow(lambda key, table: sent(by_model(table), table.column("part")[0].as_py()), SUMS)
        packs = min(len(growing), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return sums.groupBy((F.col("model") % packs).alias("pack")).applyInArrow(lambda key, table: split(by_model(table)), SPLIT).collect()

    def store(self, fits: Sequence[Fit]) -> None:
        """The table with the models' sums so far, in place of all earlier ones."""
        held = [self.growing(f, i, Tree.empty(1), 0) for i, f in enumerate(fits)]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x, y, fold, row, margins in arrays(batch):
                    yield block(row, fold, y, x, np.column_stack([margin_of(x, margins, g) for g in held]))

        self.stored = stage(self.stored.mapInArrow(summed, BLOCK), "margins")
        self.deal()
        for fit in fits:
            fit.stored = len(fit.trees)
        self.held = list(fits)

    def model(self, fit: Fit, trees: int | None = None) -> BoostedModel:
        """The model with real values for cuts, of its first ``trees`` trees or all."""
        made = []
        for tree in fit.trees[:trees]:
            cut = [float(self.edges[f][c]) if f >= 0 and c < len(self.edges[f]) else 0.0 for f, c in zip(tree.feature.tolist(), tree.cut.astype(int).tolist())]
            made.append(Tree(tree.feature, np.array(cut), tree.value))
        return BoostedModel(self.features, fit.base, made)


def fit_boosted(rows: DataFrame, features: Sequence[str], params: Sequence[BoostParams] = (BoostParams(),), key: str = "Product_ID") -> list[BoostedModel]:
    """A model of all rows (``target`` and the features) for each parameter set."""
    booster = Booster(rows, features, key)
    fits = booster.start([Fit(p, seed=i) for i, p in enumerate(params)])
    booster.grow(fits, max(p.n_estimators for p in params))
    booster.close()
    return [booster.model(f) for f in fits]


@dataclass
class Trial:
    """A parameter set with a model for each fold."""

    number: int
    params: BoostParams
    fits: list[Fit]

    def scores(self) -> list[float]:
        """Mean error over the folds after each number of trees, from the first."""
        known = min(len(f.errors) for f in self.fits)
        return [sum(f.errors[t] for f in self.fits) / len(self.fits) for t in range(1, known)]

    def best(self) -> tuple[float, int]:
        return min((s, t) for t, s in enumerate(self.scores(), 1)) if self.scores() else (math.inf, 0)


def search_boosted(
    rows: DataFrame, features: Sequence[str], drawn_params: Sequence[BoostParams], key: str = "Product_ID",
    first: int | None = None, keep: float = 1 / 4, finalists: int = 2, patience: int | None = None,
) -> tuple[list[Trial], Trial]:
    """Every parameter set grown to its full number of trees in every fold, and the one with the least mean fold error.

    A set is judged at the number of trees where its error was least.

    Only if ``first`` is given, the search halves instead and so is not exact: all sets get ``first`` trees a fold; the best
    ``keep`` of them go on to three times as many, and so on down to ``finalists``, which grow to their full number.  With
    ``patience``, a set whose error has not fallen for so many trees stops growing wherever it is.
    """
    booster = Booster(rows, features, key)
    trials = [Trial(i, p, [Fit(p, fold, i) for fold in sorted(booster.folds)]) for i, p in enumerate(drawn_params)]
    booster.start([f for t in trials for f in t.fits])
    most_of = lambda t: t.params.n_estimators
    live, size = trials, max(map(most_of, trials), default=0) if first is None else first
    while live:
        whole = first is None or len(live) <= finalists
        most = max(map(most_of, live)) if whole else size
        stopped = lambda t: patience is not None and t.scores() and len(t.scores()) - t.best()[1] >= patience
        while True:
            going = [t for t in live if len(t.fits[0].trees) < min(most, most_of(t)) and not stopped(t)]
            if not going:
                break
            step = most if whole else min(min(most, most_of(t)) - len(t.fits[0].trees) for t in going)
            booster.grow([f for t in going for f in t.fits], step if patience is None else min(step, max(1, patience // 2)))
        booster.errors([f for t in live for f in t.fits])
        if whole:
            break
        live = sorted(live, key=lambda t: (t.best(), t.number))[: max(finalists, math.ceil(keep * len(live)))]
        size *= 3
    booster.close()
    return trials, min(live, key=lambda t: (t.best(), t.number))
