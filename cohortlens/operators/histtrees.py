"""Trees from histograms of a binned table, many models in the same passes
(the core of M10/M11, and the shared-work searches of M01/M12/M14).

The rows are binned once (cuts from about `SAMPLE_ROWS` distinct rows at most,
chosen by a hash of all their columns, that count as often as they stand in
the table; below that number all rows) and packed into blocks of
bytes, one byte for each row and feature. A pass over the blocks adds up, for
every open node of every tree that is being grown, the sums of a few channels
for each bin; the blocks' sums are merged on the executors, where the splits are
picked too (`picked`): the driver sees a node's sums and split only. All classes' trees
of a boosting stage, and all models that are asked for together (folds,
training sizes, balancing variants, grid candidates), share each pass.

Trees without a short depth limit end in many nodes of few rows. A node of at
most `LOCAL_ROWS` rows is grown whole by the task that gets its rows
(`_finished`), so passes are made for the few large nodes only.

Channels are whole numbers (fixed point, 2^20 steps), so that the sums, and
with them the trees, don't depend on how the rows are dealt. Where all rows fit
one block, its sums need no merging: the task that holds it grows the trees on
by itself, with the same functions and the same result, and the models are
dealt to several tasks. A model's trees are all the state there is: raw scores
are computed from the trees, and kept with the blocks from stage to stage,
so a lost executor costs only its blocks' recomputation.

Draws (row samples) come from a hash of the row's key, never from its place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from cohortlens.operators.leafscores import Nodes
from cohortlens.session import materialize, ship_package

SAMPLE_ROWS = 20_000
BLOCK_ROWS = 32_768
MAX_BINS = 64
SCALE = float(1 << 20)
#: raw scores follow from the last stage's, and after so many stages from all trees (the lineage stays short)
KEEP_STAGES = 25
#: the sums of so many blocks go to the driver directly
FEW_BLOCKS = 16
#: bytes of sums that a pass asks of a block
PASS_BYTES = 48 << 20
#: nodes of so many rows at most are finished by the task that gets their rows
LOCAL_ROWS = 1 << 17
#: bytes of rows that a core sends for that at once
LOCAL_BYTES = 96 << 20
#: nodes of a judged forest's trees that the driver holds at once (some 200 bytes each)
DRIVER_NODES = 1 << 20


# ---------------------------------------------------------------- binned rows
@dataclass
class Cuts:
    """Cut points of each column: a value belongs to the first bin whose cut
    is not below it; the last bin has no cut (missing values stand there).
    A column is a feature, or (`source`) one of several ways to cut it;
    `again` names the columns whose raw values the blocks keep, to be cut anew."""

    points: list[np.ndarray]
    source: np.ndarray | None = None
    again: Sequence[int] = ()
    #: of each fold, the column of each feature (see `fold_cuts`)
    by_fold: Sequence[np.ndarray] = ()

    def __post_init__(self):
        self.source = np.arange(len(self.points)) if self.source is None else self.source
        self.sizes = np.array([len(p) + 1 for p in self.points])
        self.at = np.concatenate(([0], np.cumsum(self.sizes)))
        self.last = np.zeros(self.at[-1], bool)
        self.last[self.at[1:] - 1] = True
        self.feature = np.repeat(np.arange(len(self.points)), self.sizes)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bytes (feature x row)."""
        out = np.empty((len(self.points), len(x)), np.uint8)
        for f, p in enumerate(self.points):
            out[f] = np.searchsorted(p, x[:, self.source[f]], side="left")
        return out


def cuts_of(values: np.ndarray, max_bins: int = MAX_BINS, count: np.ndarray | None = None) -> Cuts:
    """The cuts of all features; a row of `values` counts as one, or as `count` says."""
    points = []
    for f in range(values.shape[1]):
        present = ~np.isnan(values[:, f])
        v, at = np.unique(values[present, f], return_inverse=True)
        n = np.bincount(at, weights=None if count is None else count[present], minlength=len(v)).astype(np.int64)
        if len(v) > max_bins:
            share = np.cumsum(n) * max_bins // (n.sum() + 1)  # the bin that the last of equal values falls into
            ends = np.flatnonzero(share[1:] > share[:-1])
        else:
            ends = np.arange(len(v) - 1)
        points.append((v[ends] + v[ends + 1]) / 2 if len(ends) else np.zeros(0))
    return Cuts(points)


def weighted_cuts(values: np.ndarray, weights: np.ndarray, max_bins: int, rows: int | None = None) -> np.ndarray:
    """Cut points of one feature by the rule of Spark ML's trees: between all
    neighbouring values, or, where these are too many, between those nearest
    to equal shares of the weight. The values stand for so many `rows` (None:
    one each)."""
    present = ~np.isnan(values)
    v, at = np.unique(values[present], return_inverse=True)
    most = min(max_bins, len(values) if rows is None else rows) - 1
    if len(v) - 1 <= most:
        return v[:-1] / 2 + v[1:] / 2
    run = np.cumsum(np.bincount(at, weights=weights[present], minlength=len(v)))
    both = run[:-1] + run[1:]  # above twice a share where the value before is nearer to it
    stride, ends, at = run[-1] / (most + 1), [], 0
    while (at := at + int(np.searchsorted(both[at:], 2 * (len(ends) + 1) * stride, side="right"))) < len(both):
        ends.append(at)
        at += 1
    ends = np.array(ends, int)
    return (v[ends] + v[ends + 1]) / 2


@dataclass
class Sample:
    """The rows that cuts are made from."""

    values: np.ndarray  # row x feature
    label: np.ndarray
    weight: np.ndarray  # of all rows that a row here stands for
    fold: np.ndarray
    count: np.ndarray  # of rows that a row here stands for

    @property
    def rows(self) -> int:
        return int(self.count.sum())


def fold_cuts(sample: Sample, folds: int, max_bins: int) -> Cuts:
    """Each fold's cuts come from the rows outside it, so that a fold's trees
    know nothing of its rows; a feature has a column for each way to cut it."""
    points, source, by_fold = [], [], [[] for _ in range(folds)]
    for f in range(sample.values.shape[1]):
        ways: dict = {}
        for fold, columns in enumerate(by_fold):
            out = sample.fold != fold
            cut = weighted_cuts(sample.values[out, f], sample.count[out], max_bins, int(sample.count[out].sum()))
            if cut.tobytes() not in ways:
                ways[cut.tobytes()] = len(points)
                points.append(cut)
                source.append(f)
            columns.append(ways[cut.tobytes()])
    return Cuts(points, np.array(source, int), by_fold=[np.array(c, int) for c in by_fold])


def _vector(df: DataFrame, features: str) -> Column:
    return vector_to_array(F.col(features)) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features).cast("array<double>")


def _plain(df: DataFrame, features: str) -> list[Column]:
    """The other columns that can be hashed: with them equal vectors are told apart."""
    return [F.col(f"`{c.name}`") for c in df.schema.fields if c.name != features and isinstance(c.dataType, AtomicType) and not isinstance(c.dataType, VariantType)]


@dataclass
class Block:
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    step: np.ndarray
    #: of each bundle its features and a code for each row: 0, or the place (from 1) of the one feature in its second bin
    bundles: list[tuple[np.ndarray, np.ndarray]]
    #: the values of the columns that are cut again (column x row)
    raw: np.ndarray | None = None


def bundled(bins: np.ndarray, cuts: Cuts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two-bin features that no row of these has in the second bin together
    (the slots of a category), so that one count gives the sums of them all."""
    out: list[tuple[list[int], np.ndarray]] = []
    for f in np.setdiff1d(np.flatnonzero(cuts.sizes == 2), cuts.again):
        on = bins[f] > 0
        for members, code in out:
            if len(members) < 255 and not code[on].any():
                members.append(int(f))
                code[on] = len(members)
                break
        else:
            out.append(([int(f)], on.astype(np.uint8)))
    return [(np.array(members), code) for members, code in out]


class Table:
    """The packed blocks of a training table (`rdd`), their cuts and counts.

    `key` names an id column for the draws (else the row's content is hashed:
    equal rows then draw alike), `weight` a weight column, `fold` a fold
    number, `step` a number from which on a model that names a step takes the
    row. Rows without features or label take no part. With `numeric` the label
    is any number instead of a class (`span`: its least and largest value; NaN
    and infinite labels take no part). `rule` makes the cuts from a `Sample`."""

    def __init__(self, df: DataFrame, features: str = "features", label: str = "label", weight: str | None = None, key: str | None = None,
                 fold: str | None = None, step: str | None = None, max_bins: int = MAX_BINS, block_rows: int = BLOCK_ROWS, numeric: bool = False,
                 rule: Callable[[Sample], Cuts] | None = None):
        spark = df.sparkSession
        ship_package(spark)
        x = _vector(df, features)
        name = lambda c, other: F.col(c) if c else F.lit(other)
        draw = F.xxhash64(F.col(key)) if key else F.xxhash64(x, F.col(label))
        rows = df.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
            x.alias("x"), F.col(label).cast("double").alias("y"), name(weight, 1.0).cast("double").alias("w"), draw.alias("key"),
            name(fold, -1).cast("int").alias("fold"), name(step, 0).cast("int").alias("step"), F.xxhash64(x, *_plain(df, features)).alias("row"))
        self.span = (0.0, 0.0)
        #: no positive weight is below it
        self.least = 1.0 if weight is None else rows.agg(F.min(F.when(F.col("w") > 0, F.col("w")))).first()[0] or 1.0
        if numeric:
            rows = rows.where(F.abs("y") < float("inf"))
            whole = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("row").alias("d"), F.min("y").alias("lo"), F.max("y").alias("hi")).first()
            self.rows, self.classes, distinct = whole["n"], 0, whole["d"]
            if whole["n"]:
                self.span = whole["lo"], whole["hi"]
        else:
            self.rows, self.classes, distinct = self._counted(rows)
        if not self.rows:
            raise ValueError("no rows with features and a label to learn from")
        own = ["x", *(("y", "w", "fold") if rule else ())]
        if self.rows <= SAMPLE_ROWS:
            picked = rows.select(*own, F.lit(1).cast("long").alias("count"))
        else:  # few distinct rows are all taken: a hash of them could leave all out
            share = min(1.0, SAMPLE_ROWS / max(1, distinct))
            picked = rows.where(F.pmod("row", F.lit(1 << 40)) < int(share * (1 << 40))).groupBy(*own).count()
        found = picked.toArrow()
        sample = found.column(0).combine_chunks()
        width = len(sample[0]) if len(sample) else 0
        values, count = sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), width), found.column("count").to_numpy()
        if rule:
            y, w, of = (found.column(c).to_numpy() for c in ("y", "w", "fold"))
            self.cuts = rule(Sample(values, y, w * count, of, count))
        else:
            self.cuts = cuts_of(values, max_bins, count)
        cores = spark.sparkContext.defaultParallelism
        self.blocks = 1 if self.rows <= block_rows else max(cores, -(-self.rows // block_rows))
        cuts, label_type = self.cuts, np.float64 if numeric else np.int16

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: list[list[np.ndarray]] = []
            for b in batches:
                if len(b):
                    x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
                    parts.append([cuts.bins(x), x[:, cuts.source[list(cuts.again)]].T, *(b.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6))])
            if parts:
                bins, raw, *others = zip(*parts, strict=True)
                whole = [np.concatenate(bins, axis=1), np.concatenate(raw, axis=1), *(np.concatenate(c) for c in others)]
                types = [np.uint8, np.float64, label_type, np.float64, np.uint64, np.int16, np.int16]
                yield pa.RecordBatch.from_arrays([pa.array([c.astype(t).tobytes()], pa.binary()) for c, t in zip(whole, types, strict=True)], names=["bins", "raw", "y", "w", "key", "fold", "step"])

        packed = rows.drop("row").repartition(self.blocks).mapInArrow(pack, "bins binary, raw binary, y binary, w binary, key binary, fold binary, step binary")
        features_ = len(self.cuts.points)

        def unpack(r) -> Block:
            y = np.frombuffer(r["y"], label_type)
            bins = np.frombuffer(r["bins"], np.uint8).reshape(features_, len(y))
            return Block(bins, y, np.frombuffer(r["w"]), np.frombuffer(r["key"], np.uint64), np.frombuffer(r["fold"], np.int16), np.frombuffer(r["step"], np.int16), bundled(bins, cuts),
                         np.frombuffer(r["raw"]).reshape(-1, len(y)) if len(cuts.again) else None)

        self.rdd = materialize(packed).rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
        self.cores = cores

    @staticmethod
    def _counted(rows: DataFrame) -> tuple[int, int, int]:
        """Rows, classes, and about how many distinct rows."""
        found = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("row").alias("d")).limit(10_001).collect()
        counts = {int(r["y"]): r["n"] for r in found}
        if len(counts) > 10_000:
            raise ValueError("more than 10,000 distinct labels: not a class column")
        return sum(counts.values()), max(counts, default=-1) + 1, sum(r["d"] for r in found)

    def dealt(self, groups: int):
        """One block: a copy for each group of models, in tasks of their own."""
        return self.rdd.flatMap(lambda b: [(g, b) for g in range(groups)]).partitionBy(groups, int)

    def release(self) -> None:
        self.rdd.unpersist()


# ---------------------------------------------------------------- trees
class Tree:
    """Nodes in the order of their making; `stats` are a node's channel sums."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.depth = ([x] for x in (-1, -1, 0, 0, 0))
        self.stats: list[np.ndarray | None] = [None]
        self.open = [0]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.cut, self.left, self.right))

    def advance(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows in nodes that were split step to the children."""
        feature, cut, left, right = self.arrays()
        f = feature[at]
        go = np.flatnonzero(f >= 0)
        node = at[go]
        at = at.copy()
        at[go] = np.where(bins[f[go], go] <= cut[node], left[node], right[node])
        return at

    def extend(self, found: Sequence[tuple]) -> None:
        """Splits the open nodes as found: (stats, None) or (stats, (feature,
        cut, left stats, right stats)); children are the open nodes then."""
        children = []
        for node, (stats, split) in zip(self.open, found, strict=True):
            self.stats[node] = stats
            if split is None:
                continue
            self.feature[node], self.cut[node] = split[0], split[1]
            for side, own in ((self.left, split[2]), (self.right, split[3])):
                side[node] = len(self.feature)
                children.append(len(self.feature))
                for values, value in ((self.feature, -1), (self.cut, -1), (self.left, 0), (self.right, 0)):
                    values.append(value)
                self.depth.append(self.depth[node] + 1)
                self.stats.append(own)
        self.open = children

    def light(self) -> Tree:
        """What tasks need of a tree that is being grown."""
        out = object.__new__(Tree)
        out.feature, out.cut, out.left, out.right = self.arrays()
        out.depth, out.open = max(self.depth), self.open
        return out

    @staticmethod
    def several(depth: Sequence[int], stats: Sequence) -> Tree:
        """The subtrees of several open nodes, which are the first ones here."""
        out, count = Tree(), len(depth)
        out.feature, out.cut, out.left, out.right, out.depth = [-1] * count, [-1] * count, [0] * count, [0] * count, list(depth)
        out.stats, out.open = list(stats), list(range(count))
        return out

    def grafted(self, parts: Sequence[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Puts subtrees in the place of their first nodes; each part has the
        node, and features, cuts and stats of its own nodes level by level.
        All nodes are numbered level by level then."""
        feature, cut, left, right = self.arrays()
        columns = [[feature], [cut], [left], [right], [np.array([x if x is not None else np.zeros_like(parts[0][3][0]) for x in self.stats])]]
        size = len(feature)
        for node, f, c, stats in parts:
            low, high = np.zeros((2, len(f)), int)
            inner = np.flatnonzero(f >= 0)
            low[inner] = size + 2 * np.arange(len(inner))  # the first node stands in the tree already
            high[inner] = low[inner] + 1
            feature[node], cut[node], left[node], right[node], columns[4][0][node] = f[0], c[0], low[0], high[0], stats[0]
            for column, own in zip(columns, (f, c, low, high, stats), strict=True):
                column.append(own[1:])
            size += len(f) - 1
        feature, cut, left, right, stats = (np.concatenate(c) for c in columns)
        levels = [np.zeros(1, int)]
        while len(inner := levels[-1][feature[levels[-1]] >= 0]):
            levels.append(np.stack((left[inner], right[inner]), axis=1).ravel())
        order = np.concatenate(levels)
        place = np.zeros(size, int)
        place[order] = np.arange(len(order))
        inner = feature[order] >= 0
        self.feature, self.cut, self.stats = feature[order].tolist(), cut[order].tolist(), stats[order]
        self.left, self.right = (np.where(inner, place[side[order]], 0).tolist() for side in (left, right))
        self.depth = np.repeat(np.arange(len(levels)), [len(x) for x in levels]).tolist()
        self.open = []

    def grown(self, value) -> Grown:
        feature, cut, left, right = self.arrays()
        return Grown(feature.astype(np.int16), cut.astype(np.int16), left.astype(np.int32), right.astype(np.int32), max(self.depth),
                     np.array([value(x) if f < 0 else 0.0 for x, f in zip(self.stats, self.feature, strict=True)]),
                     np.array(self.stats)[:, -1].astype(np.float64) / SCALE)


#: trees of so many nodes step by whole columns
FEW_NODES = 128


def _stepped_columns(nodes: list[list[int]], bins: np.ndarray, steps: int) -> np.ndarray:
    """As `stepped`, from the leaves up: a comparison of a column for each split."""
    feature, cut, left, right = nodes

    def ends(node: int, steps: int):
        if feature[node] < 0 or not steps:
            return np.int16(node)
        return np.where(bins[feature[node]] <= cut[node], ends(left[node], steps - 1), ends(right[node], steps - 1))

    at = ends(0, steps)
    return at if isinstance(at, np.ndarray) else np.full(bins.shape[1], at)


def stepped(tree, bins: np.ndarray, steps: int | None = None) -> np.ndarray:
    """The node of each row, after so many steps at most."""
    most = tree.depth if isinstance(tree.depth, int) else max(tree.depth)
    feature, cut, left, right = (np.asarray(x) for x in (tree.feature, tree.cut, tree.left, tree.right))
    if len(feature) <= FEW_NODES:
        return _stepped_columns([x.tolist() for x in (feature, cut, left, right)], bins, most if steps is None else min(most, steps))
    at = np.zeros(bins.shape[1], np.int64)
    for _ in range(most if steps is None else min(most, steps)):
        f = feature[at]
        go = np.flatnonzero(f >= 0)
        node = at[go]
        at[go] = np.where(bins[f[go], go] <= cut[node], left[node], right[node])
    return at


@dataclass
class Grown:
    """A finished tree: arrays by node, with the leaves' values and the sum of
    training weights of each node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: int
    value: np.ndarray
    cover: np.ndarray

    def nodes(self, cuts: Cuts) -> Nodes:
        """The node arrays on raw values that `leaf_scores` reads."""
        out = object.__new__(Nodes)
        out.feature, out.left, out.right = np.where(self.feature < 0, -1, cuts.source[self.feature]), self.left.astype(int), self.right.astype(int)
        out.threshold = np.array([cuts.points[f][c] if f >= 0 else 0.0 for f, c in zip(self.feature, self.cut, strict=True)])
        out.cats, out.cover = {}, self.cover
        leaf = out.feature < 0
        out.leaf = np.where(leaf, np.cumsum(leaf) - 1, -1)
        out.predictions = self.value[leaf]
        return out


#: a weight of 1 beside a whole number, in one channel
BESIDE = 1 << 34


def _paired(channels: Sequence[np.ndarray]) -> np.ndarray | None:
    """Two channels in one, where the second one's sums stay whole numbers of
    weights and both together exact."""
    h, w = channels
    if len(h) and (h.min() < 0 or h.sum() >= BESIDE or w.min() < 0 or w.sum() >= SCALE * (1 << 18) or (w % SCALE).any()):
        return None
    return h + w * (BESIDE / SCALE)


def sums(b: Block, cuts: Cuts, at: np.ndarray, rows: np.ndarray, channels: Sequence[np.ndarray], nodes: Sequence[int], features: np.ndarray, mask: np.ndarray | None = None, classes: int = 0) -> np.ndarray:
    """Whole-number sums (node, channel, bin) of the rows in these nodes; with
    `mask` (node, feature) only those of the features that a node may split at
    need to be whole. With `classes` the channels are the labels and the
    weights: the sums are the weights of each class, and of all."""
    slot = np.full(int(at.max(initial=0)) + 1, -1)
    known = [n for n in nodes if n < len(slot)]
    slot[known] = np.arange(len(nodes))[: len(known)]
    s = slot[at[rows]]
    if len(s) and s.min() < 0:
        rows, s = rows[s >= 0], s[s >= 0]
    whole = len(rows) == b.bins.shape[1] and bool((rows == np.arange(len(rows))).all())
    values = list(channels) if whole else [c[rows] for c in channels]
    both = _paired(values[1:]) if not classes and len(values) == 3 else None
    count, out = len(nodes), np.zeros((len(nodes), classes + 1 if classes else len(channels), cuts.at[-1]), np.int64)

    def added(place: np.ndarray, cells: int, times: int = 1) -> np.ndarray:
        """Sums (node, channel, cell); a row has so many places."""
        each = (lambda v: np.repeat(v, times)) if times > 1 else (lambda v: v)
        if classes:
            by = np.bincount(place * classes + each(values[0]), weights=each(values[1]), minlength=count * cells * classes).astype(np.int64).reshape(count, cells, classes)
            return np.concatenate((by, by.sum(2, keepdims=True)), axis=2).transpose(0, 2, 1)
        found = [np.bincount(place, weights=each(v), minlength=count * cells).astype(np.int64) for v in (values if both is None else [values[0], both])]
        if both is not None:
            found[1:] = [found[1] % BESIDE, found[1] // BESIDE * int(SCALE)]
        return np.stack([x.reshape(count, cells) for x in found], axis=1)

    if mask is not None:  # as many features for each node: a row counts for those of its node only
        own = np.nonzero(mask)[1].reshape(count, -1)[s]
        place = (s[:, None] * cuts.at[-1] + cuts.at[own] + b.bins[own, rows[:, None]]).ravel()
        return np.ascontiguousarray(added(place, int(cuts.at[-1]), own.shape[1]))
    asked = np.zeros(len(cuts.sizes), bool)
    asked[features] = True
    for members, code in b.bundles:
        mine = np.flatnonzero(asked[members])
        if len(mine):
            cells = len(members) + 1
            found = added(s * cells + (code if whole else code[rows]), cells)
            low = cuts.at[members[mine]]
            out[:, :, low + 1] = found[:, :, mine + 1]
            out[:, :, low] = found.sum(2, keepdims=True) - found[:, :, mine + 1]
    for f in features[cuts.sizes[features] != 2]:
        first, n = cuts.at[f], int(cuts.sizes[f])
        out[:, :, first : first + n] = added(s * n + (b.bins[f] if whole else b.bins[f][rows]), n)
    return out


def best_splits(found: np.ndarray, cuts: Cuts, features: np.ndarray, gain, mask: np.ndarray | None = None, whole_of: Sequence | None = None) -> list[tuple]:
    """For each node (its stats, the best split or None); `gain(left, right,
    whole)` gives float gains of channel sums (channel, ...), -inf where a
    split is not allowed. `mask` (node, feature) names the features of each
    node, `whole_of` the nodes' own sums where they are known."""
    if mask is not None:
        return _masked_splits(found, cuts, gain, mask, whole_of)
    out = []
    places = np.flatnonzero(~cuts.last & np.isin(cuts.feature, features))
    start = cuts.at[cuts.feature[places]]
    own = slice(cuts.at[features[0]], cuts.at[features[0] + 1])
    for a in range(0, len(found), 64):
        one = found[a : a + 64].transpose(1, 0, 2)  # channel, node, bin
        whole = one[..., own].sum(-1)
        if whole_of is not None:
            whole = np.stack([w if w is not None else whole[:, i] for i, w in enumerate(whole_of[a : a + 64])], axis=1)
        run = np.concatenate((np.zeros((*whole.shape, 1), np.int64), np.cumsum(one, axis=-1)), axis=-1)
        left = run[..., places + 1] - run[..., start]
        right = whole[..., None] - left
        if not len(places):
            out += [(w, None) for w in whole.T.copy()]
            continue
        gains = gain(left, right, whole[..., None])
        best = gains.argmax(-1)
        for i, j in enumerate(best.tolist()):
            split = None
            if gains[i, j] > 0:
                f = int(cuts.feature[places[j]])
                split = (f, int(places[j] - cuts.at[f]), left[:, i, j].copy(), right[:, i, j].copy())
            out.append((whole[:, i].copy(), split))
    return out


def _masked_splits(found: np.ndarray, cuts: Cuts, gain, mask: np.ndarray, whole_of: Sequence | None) -> list[tuple]:
    """`best_splits` of nodes with features of their own: a feature at a time,
    for the nodes that may split at it."""
    count = len(found)
    known = [None] * count if whole_of is None else whole_of
    # a node's sums from a feature that it may split at: the others' may be parts
    whole = np.stack([found[i, :, cuts.at[f] : cuts.at[f + 1]].sum(-1) if w is None else w for i, (w, f) in enumerate(zip(known, mask.argmax(1), strict=True))], axis=1)
    best = np.full(count, -np.inf)
    feature, cut, left = np.zeros(count, int), np.zeros(count, int), np.zeros_like(whole)
    for f in np.flatnonzero(cuts.sizes > 1):
        mine = np.flatnonzero(mask[:, f])
        if not len(mine):
            continue
        low = np.cumsum(found[mine, :, cuts.at[f] : cuts.at[f + 1] - 1].transpose(1, 0, 2), axis=-1)
        own = whole[:, mine][..., None]
        gains = gain(low, own - low, own)
        at = gains.argmax(-1)
        most = gains[np.arange(len(mine)), at]
        better = most > best[mine]  # ties stay with the first feature
        won, at = mine[better], at[better]
        best[won], feature[won], cut[won] = most[better], f, at
        left[:, won] = low[:, better, at]
    return [(whole[:, i].copy(), (int(feature[i]), int(cut[i]), left[:, i].copy(), whole[:, i] - left[:, i]) if best[i] > 0 else None) for i in range(count)]


def uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) from row keys and salts."""
    z = key.copy()
    for s in salt:
        z = (z ^ np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(32)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


# ---------------------------------------------------------------- models
@dataclass
class Rows:
    """Which rows a model trains on, and how they count: without the fold,
    with steps up to `step`, classes weighted, of all others none."""

    fold: int | None = None
    step: int | None = None
    class_weights: tuple[float, ...] | None = None

    def weights(self, b: Block) -> np.ndarray:
        w = b.weight if self.class_weights is None else b.weight * np.array(self.class_weights)[b.label]
        keep = np.ones(len(w), bool) if self.fold is None else b.fold != self.fold
        return np.where(keep if self.step is None else keep & (b.step <= self.step), w, 0.0)

    def held_out(self, b: Block) -> np.ndarray:
        return np.zeros(len(b.label), bool) if self.fold is None else b.fold == self.fold


@dataclass
class Boosting:
    """Softmax boosting with variance splits and Newton leaf values. With
    `second_order` (M11) splits and leaves go by gradient and curvature with
    an L2 term."""

    rows: Rows = field(default_factory=Rows)
    stages: int = 100
    rate: float = 0.1
    depth: int = 3
    subsample: float = 1.0
    colsample: float = 1.0
    l2: float = 0.0
    min_split: float = 2
    min_leaf: float = 1
    second_order: bool = False
    seed: int = 42
    start: list[float] = field(default_factory=list)
    trees: list[list[Grown]] = field(default_factory=list)  # of each stage, a tree a class
    growing: list[Tree] = field(default_factory=list)

    @property
    def classes(self) -> int:
        return len(self.start)

    def begin(self, totals: np.ndarray) -> None:
        n = totals.sum()
        self.start = [math.log(t / n) if t > 0 else -1e9 for t in totals.tolist()]

    def value(self, stats: np.ndarray) -> float:
        g, h, _ = (float(x) / SCALE for x in stats)
        if self.second_order:
            return g / (2 * h + self.l2) if 2 * h + self.l2 > 1e-150 else 0.0
        return (self.classes - 1) / self.classes * g / (h + self.l2) if abs(h + self.l2) > 1e-150 else 0.0

    def gain(self, left: np.ndarray, right: np.ndarray, whole: np.ndarray) -> np.ndarray:
        sides = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for g, h, w in (left, right, whole):
                below = 2 * h / SCALE + self.l2 if self.second_order else w / SCALE
                sides.append((g / SCALE) ** 2 / below)
            gains = sides[0] + sides[1] - sides[2]
            bad = (left[2] < self.min_leaf * SCALE) | (right[2] < self.min_leaf * SCALE) | (whole[2] < self.min_split * SCALE)
            if self.second_order:
                bad |= (2 * left[1] < SCALE) | (2 * right[1] < SCALE)
            return np.where(bad | ~(gains > 1e-9 * np.abs(sides[2]) + 1e-12), -np.inf, gains)

    def features(self, stage: int, k: int, count: int) -> np.ndarray:
        if self.colsample >= 1.0:
            return np.arange(count)
        rng = np.random.default_rng([self.seed, stage, k])
        return np.sort(rng.choice(count, max(1, int(self.colsample * count)), replace=False))

    def add(self, scores: np.ndarray, b: Block, stages: Sequence[list[Grown]]) -> np.ndarray:
        for trees in stages:
            for k, tree in enumerate(trees):
                scores[:, k] += (self.rate * tree.value)[stepped(tree, b.bins)]
        return scores

    def scores(self, b: Block, stages: int | None = None) -> np.ndarray:
        return self.add(np.tile(np.array(self.start), (len(b.label), 1)), b, self.trees[:stages])

    def targets(self, b: Block, scores: np.ndarray, stage: int) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """The rows of this stage, and of each class the channels: gradient,
        curvature, weight (whole numbers)."""
        w = self.rows.weights(b)
        keep = w > 0
        if self.subsample < 1.0:
            keep &= uniform(b.key, self.seed, stage) < self.subsample
        e = np.exp(scores - scores.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        weight = np.rint(w * SCALE)
        return np.flatnonzero(keep), [[np.rint(((b.label == k) - p[:, k]) * w * SCALE), np.rint(p[:, k] * (1 - p[:, k]) * w * SCALE), weight] for k in range(self.classes)]

    def finish(self) -> None:
        self.trees.append([t.grown(self.value) for t in self.growing])
        self.growing = []


def _hists(model: Boosting, b: Block, cuts: Cuts, rows: np.ndarray, channels, at: Sequence[np.ndarray], stage: int, k: int) -> np.ndarray:
    return sums(b, cuts, at[k], rows, channels[k], model.growing[k].open, model.features(stage, k, len(cuts.points)))


def _grow(model: Boosting, found: dict[int, np.ndarray], cuts: Cuts, stage: int) -> None:
    _extend(model, {k: best_splits(one, cuts, model.features(stage, k, len(cuts.points)), model.gain) for k, one in found.items()})


def _extend(model: Boosting, splits: dict[int, list[tuple]]) -> None:
    for k, tree in enumerate(model.growing):
        if tree.open:
            tree.extend(splits[k])
            if tree.open and tree.depth[tree.open[0]] >= model.depth:
                tree.open = []


def _boost_here(model: Boosting, b: Block, cuts: Cuts) -> Boosting:
    """All rows are in this block: its sums are the whole sums."""
    scores = model.scores(b)
    for stage in range(len(model.trees), model.stages):
        rows, channels = model.targets(b, scores, stage)
        model.growing = [Tree() for _ in range(model.classes)]
        at = [np.zeros(len(b.label), np.int64) for _ in range(model.classes)]
        while any(t.open for t in model.growing):
            opened = [bool(t.open) for t in model.growing]
            _grow(model, {k: _hists(model, b, cuts, rows, channels, at, stage, k) for k, o in enumerate(opened) if o}, cuts, stage)
            at = [t.advance(b.bins, a) if o else a for t, a, o in zip(model.growing, at, opened, strict=True)]
        model.finish()
        model.add(scores, b, model.trees[-1:])
    return model


def _merged(a: dict, b: dict) -> dict:
    for key, value in b.items():
        a[key] = a[key] + value if key in a else value
    return a


def merged(sums_):
    """The sums of all blocks: of few ones at the driver, of many on the executors first."""
    return sums_.reduce(_merged) if sums_.getNumPartitions() <= FEW_BLOCKS else sums_.treeReduce(_merged)


#: nodes of a record of sums
NODES_A_RECORD = 64


def picked(table: Table, rdd, level, pick) -> dict:
    """The splits of each key's nodes: `level(blocks)` gives (key, sums of its
    nodes), and `pick(key, first, sums)` the splits of the nodes from `first`
    on. A partition adds up its blocks, a shuffle the partitions, and the
    splits are picked where the sums are: the driver sees a node's own sums
    and split only, and as many partial sums as cores are sent at any size."""

    def own(blocks):
        out: dict = {}
        for key, one in level(blocks):
            out[key] = np.add(out[key], one, out=out[key]) if key in out else one
        for key, one in out.items():
            for c in range(0, len(one), NODES_A_RECORD):
                yield (key, c), one[c : c + NODES_A_RECORD]

    whole = rdd.coalesce(table.cores).mapPartitions(own).reduceByKey(lambda a, b: a + b, table.cores)
    out: dict = {}
    for (key, _), found in sorted(whole.map(lambda x: (x[0], pick(x[0][0], x[0][1], x[1]))).collect(), key=lambda x: x[0]):
        out.setdefault(key, []).extend(found)
    return out


def fit_boosted(table: Table, models: list[Boosting]) -> list[Boosting]:
    """Grows all models together, stage by stage and level by level."""
    classes, cuts = table.classes, table.cuts
    asked = [m.rows for m in models]

    def totals(blocks):
        for b in blocks:
            yield {i: np.bincount(b.label, weights=np.rint(r.weights(b) * SCALE), minlength=classes) for i, r in enumerate(asked)}

    for i, t in merged(table.rdd.mapPartitions(totals)).items():
        models[i].begin(t / SCALE)
    if table.blocks == 1:
        groups = min(len(models), 4 * table.cores)
        mine = table.dealt(groups)
        done = mine.flatMap(lambda gb: [(i, _boost_here(models[i], gb[1], cuts)) for i in range(gb[0], len(models), groups)]).collect()
        return [m for _, m in sorted(done, key=lambda x: x[0])]
    each = classes * 3 * int(cuts.at[-1]) * 8  # bytes of sums of a node of all classes
    kept = None
    for stage in range(max(m.stages for m in models)):
        last = kept
        if stage % KEEP_STAGES == 0:
            whole = [(replace(m, trees=[], growing=[]), m.trees[:stage]) for m in models]
            kept = table.rdd.map(lambda b, w=whole: (b, [m.add(np.tile(np.array(m.start), (len(b.label), 1)), b, t) for m, t in w])).persist(StorageLevel.MEMORY_AND_DISK)
        else:
            grown = [(replace(m, trees=[], growing=[]), m.trees[stage - 1 : stage]) for m in models]
            kept = last.map(lambda x, w=grown: (x[0], [m.add(scores, x[0], t) for scores, (m, t) in zip(x[1], w, strict=True)])).persist(StorageLevel.MEMORY_AND_DISK)
        active = [i for i, m in enumerate(models) if stage < m.stages]
        for i in active:
            models[i].growing = [Tree() for _ in range(classes)]
        while turn := [i for i in active if any(t.open for t in models[i].growing)]:
            wave: list[int] = []
            waves = [wave]
            load = 0
            for i in turn:
                cost = each * max(len(t.open) for t in models[i].growing)
                if wave and load + cost > PASS_BYTES:
                    wave, load = [], 0
                    waves.append(wave)
                wave.append(i)
                load += cost
            for wave in waves:
                sent = [(i, replace(models[i], trees=[], growing=[t.light() for t in models[i].growing])) for i in wave]

                def level(parts, sent=sent, stage=stage):
                    for b, scores in parts:
                        for i, m in sent:
                            rows, channels = m.targets(b, scores[i], stage)
                            at = [stepped(t, b.bins) for t in m.growing]
                            for k, t in enumerate(m.growing):
                                if t.open:
                                    yield (i, k), _hists(m, b, cuts, rows, channels, at, stage, k)

                def pick(key, first, one, by=dict(sent), stage=stage):
                    m = by[key[0]]
                    return best_splits(one, cuts, m.features(stage, key[1], len(cuts.points)), m.gain)

                found = picked(table, kept, level, pick)
                for i in wave:
                    _extend(models[i], {k: found[i, k] for k in range(classes) if (i, k) in found})
        if last is not None:  # the passes of this stage have read it
            last.unpersist()
        for i in active:
            models[i].finish()
    if kept is not None:
        kept.unpersist()
    return models


@dataclass
class ClassTree:
    """A classification tree by Gini impurity or entropy. Growth is the
    same whatever the depth limit, so a shallower tree is a part of it."""

    rows: Rows = field(default_factory=Rows)
    depth: int | None = None
    min_split: float = 2
    min_leaf: float = 1
    criterion: str = "gini"
    draw: int | None = None  # rows count as often as a Poisson draw of this seed says
    subset: int | None = None  # features that a node draws to split at
    seed: int = 42
    tree: Tree = field(default_factory=Tree)
    rate: float = 1.0  # mean of the Poisson draw
    columns: tuple[int, ...] | None = None  # the only features of this tree
    alone: bool = True  # its nodes of few rows are finished by one task each

    def features(self, count: int) -> np.ndarray:
        return np.arange(count) if self.columns is None else np.array(self.columns)

    def mask(self, nodes: Sequence[int], features: int) -> np.ndarray | None:
        """The features of each node: those with the smallest hashes."""
        if self.subset is None or self.subset >= features:
            return None
        u = uniform(np.array(nodes, np.uint64)[:, None] * np.uint64(features) + np.arange(features, dtype=np.uint64)[None, :], self.seed)
        out = np.zeros(u.shape, bool)
        np.put_along_axis(out, np.argpartition(u, self.subset - 1, axis=1)[:, : self.subset], True, axis=1)
        return out

    def impurity(self, parts: np.ndarray) -> np.ndarray:
        """Weight times impurity of class sums (class, ...)."""
        n = parts.sum(0)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = parts / n
            each = share * share if self.criterion == "gini" else np.where(parts > 0, share * np.log2(share), 0.0)
        return np.where(n > 0, n - n * each.sum(0) if self.criterion == "gini" else -n * each.sum(0), 0.0)

    def gain(self, left: np.ndarray, right: np.ndarray, whole: np.ndarray) -> np.ndarray:
        left, right, whole = left[:-1] / SCALE, right[:-1] / SCALE, whole[:-1] / SCALE
        parent = self.impurity(whole)
        gains = parent - self.impurity(left) - self.impurity(right)
        nl, nr = left.sum(0), right.sum(0)
        bad = (nl < self.min_leaf) | (nr < self.min_leaf) | (nl + nr < self.min_split) | (nl <= 0) | (nr <= 0)
        # a pure node stays; a split that gains nothing may still prepare one that does, as in the exact algorithm
        return np.where(bad | (parent <= 1e-9 * (nl + nr)), -np.inf, np.maximum(gains, 0.0) + 1e-12)

    def channels(self, b: Block) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rows that count, and what `sums` adds up of them."""
        w = self.weights(b)
        return np.flatnonzero(w > 0), [b.label.astype(np.int64), np.rint(w * SCALE)]

    def weights(self, b: Block) -> np.ndarray:
        w = self.rows.weights(b)
        return w if self.draw is None else w * np.searchsorted(poisson(self.rate), uniform(b.key, self.draw), side="right")

    def most_rows(self, node: int, table: Table) -> float:
        """The rows that a node may have, by its weight."""
        if self.tree.stats[node] is None:
            return table.rows
        least = table.least * min([1.0] if self.rows.class_weights is None else [w for w in self.rows.class_weights if w > 0] or [1.0])
        return float(self.tree.stats[node][-1]) / SCALE / least if least * SCALE >= 1 else math.inf

    def close(self) -> None:
        """Nodes that can't be split any more are not open."""
        if self.depth is not None:
            self.tree.open = [n for n in self.tree.open if self.tree.depth[n] < self.depth]
        stats = self.tree.stats
        self.tree.open = [n for n in self.tree.open if stats[n] is None or ((stats[n][:-1] > 0).sum() > 1 and stats[n][-1] >= self.min_split * SCALE)]

    def predicted(self, b: Block, depth: int | None = None) -> np.ndarray:
        best = np.array([0 if s is None else int(s[:-1].argmax()) for s in self.tree.stats])
        return best[stepped(self.tree, b.bins, depth)]


@dataclass
class GainTree(ClassTree):
    """M01 by the rule of Spark ML's trees: impurities of a node's shares, and
    only splits that gain. Its depth is limited, so every level is a pass."""

    alone: bool = False

    def impurity(self, parts: np.ndarray) -> np.ndarray:
        out = np.float64(self.criterion == "gini")
        with np.errstate(divide="ignore", invalid="ignore"):
            for share in parts / parts.sum(0):
                out = out - (share * share if self.criterion == "gini" else np.where(share > 0, share * (np.log(share) / np.log(2)), 0.0))
        return out

    def gain(self, left: np.ndarray, right: np.ndarray, whole: np.ndarray) -> np.ndarray:
        left, right, whole = left[:-1] / SCALE, right[:-1] / SCALE, whole[:-1] / SCALE
        nl, nr = left.sum(0), right.sum(0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = self.impurity(whole) - nl / (nl + nr) * self.impurity(left) - nr / (nl + nr) * self.impurity(right)
            bad = (nl < self.min_leaf) | (nr < self.min_leaf) | (nl <= 0) | (nr <= 0) | ~(gains > 0)
        return np.where(bad, -np.inf, gains)


@dataclass
class ValueTree(ClassTree):
    """A regression tree by variance. Labels enter as whole numbers on a scale
    from -1 to 1 over the table's `span`, exact to half a millionth of it."""

    span: tuple[float, float] = (0.0, 0.0)

    @property
    def middle(self) -> tuple[float, float]:
        lo, hi = self.span
        return lo / 2 + hi / 2, max(hi / 2 - lo / 2, 1e-300)

    def channels(self, b: Block) -> tuple[np.ndarray, list[np.ndarray]]:
        at, half = self.middle
        rows, [_, weight] = super().channels(b)
        y = (b.label - at) / half
        return rows, [np.rint(weight * y), np.rint(weight * y * y), weight]

    def gain(self, left: np.ndarray, right: np.ndarray, whole: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            explained = [(s / SCALE) ** 2 / (w / SCALE) for s, _, w in (left, right, whole)]
        spread = whole[1] / SCALE - explained[2]  # weight times variance of the node
        nl, nr = left[2] / SCALE, right[2] / SCALE
        bad = (nl < self.min_leaf) | (nr < self.min_leaf) | (nl + nr < self.min_split) | (nl <= 0) | (nr <= 0)
        return np.where(bad | ~(spread > 1e-6 * (nl + nr)), -np.inf, np.maximum(explained[0] + explained[1] - explained[2], 0.0) + 1e-12)

    def close(self) -> None:
        if self.depth is not None:
            self.tree.open = [n for n in self.tree.open if self.tree.depth[n] < self.depth]
        self.tree.open = [n for n in self.tree.open if self.tree.stats[n] is None or self.tree.stats[n][-1] >= self.min_split * SCALE]

    def value(self, stats: np.ndarray) -> float:
        at, half = self.middle
        return at + half * float(stats[0]) / float(stats[-1]) if stats[-1] else at


def poisson(rate: float) -> np.ndarray:
    """Shares of the draws up to 0, 1, 2, ..."""
    if not 0 < rate <= 100:
        raise ValueError("a sample draws each row more than 0 and at most 100 times on average")
    return np.cumsum(math.exp(-rate) * np.cumprod([1.0, *(rate / i for i in range(1, 16 + int(8 * rate)))]))


#: open nodes of a tree whose sums are taken at once
NODES_AT_ONCE = 256


def _tree_here(model: ClassTree, b: Block, cuts: Cuts, classes: int, at: np.ndarray | None = None, first: Sequence[int] = (0,)) -> tuple[ClassTree, np.ndarray]:
    """Grows the open nodes of a tree whose rows are all in this block: `at`
    is the node of each row. Returns the tree and the number of the first node
    (see `several`) that each node is below. Nodes draw features by their
    number below that one, and its number `first` in the whole tree."""
    tree = model.tree
    rows, channels = model.channels(b)
    at, features = np.zeros(len(b.label), np.int64) if at is None else at, model.features(len(cuts.points))
    top, count = list(range(len(first))), [1] * len(first)
    numbers = [n << 32 for n in first]
    model.close()
    while tree.open:
        found, opened = [], tree.open
        slot = np.full(len(tree.feature), -1)
        slot[opened] = np.arange(len(opened))
        rows = rows[slot[at[rows]] >= 0]
        if len(opened) > NODES_AT_ONCE:  # rows in the order of their nodes
            rows = rows[np.argsort(slot[at[rows]], kind="stable")]
        ends = np.searchsorted(slot[at[rows]], np.arange(0, len(opened) + NODES_AT_ONCE, NODES_AT_ONCE)) if len(opened) > NODES_AT_ONCE else [0, len(rows)]
        for i, a in enumerate(range(0, len(opened), NODES_AT_ONCE)):
            nodes = opened[a : a + NODES_AT_ONCE]
            mask = model.mask([numbers[n] for n in nodes], len(cuts.points))
            found += best_splits(sums(b, cuts, at, rows[ends[i] : ends[i + 1]], channels, nodes, features, mask, classes), cuts, features, model.gain, mask, [tree.stats[n] for n in nodes])
        tree.extend(found)
        for n in opened:
            if tree.feature[n] >= 0:
                for _ in range(2):
                    top.append(top[n])
                    numbers.append((first[top[n]] << 32) + count[top[n]])
                    count[top[n]] += 1
        at = tree.advance(b.bins, at)
        model.close()
    return model, np.array(top)


def _judged_at(model: ClassTree, b: Block, at: np.ndarray, ways: Sequence, lines: Sequence[Sequence[int]], held: np.ndarray, train: np.ndarray, classes: int) -> dict:
    """Counts (see `confusions`) of rows that start at the first nodes `at`;
    `lines` has for each of these the classes that its ancestors say, by depth."""
    feature, cut, left, right = model.tree.arrays()
    depth = np.array(model.tree.depth)
    best = np.array(model.tree.stats)[:, :-1].argmax(1)
    start, out = at, {}
    for way in sorted(ways, key=lambda v: math.inf if v is None else v):
        limit = math.inf if way is None else way
        while len(go := np.flatnonzero((feature[at] >= 0) & (depth[at] < limit))):
            at = at.copy() if at is start else at
            node = at[go]
            at[go] = np.where(b.bins[feature[node], go] <= cut[node], left[node], right[node])
        above = np.array([x[way] if way is not None and way < len(x) else -1 for x in lines])
        predicted = np.where(above[start] >= 0, above[start], best[at])
        for part, own in (("train", train), ("valid", held)):
            out[way, part] = np.bincount(b.label[own].astype(np.int64) * classes + predicted[own], minlength=classes * classes).reshape(classes, classes)
    return out


def _finished(table: Table, models: list[ClassTree], pending: list[list[int]], ways: Sequence | None) -> dict:
    """Grows what is below the pending nodes, each in the task that gets its
    rows, in groups of `LOCAL_ROWS` rows at most, and puts it into the trees.
    With `ways` the held-out rows go there too, and instead of putting the
    nodes into the trees their counts (model, way, part) are returned."""
    classes, cuts = table.classes, table.cuts
    asked: list[tuple[int, list[int]]] = []  # model, nodes of a group
    for i, nodes in enumerate(pending):
        load = math.inf
        for n in nodes:
            load += models[i].most_rows(n, table)
            if load > LOCAL_ROWS:
                asked.append((i, []))
                load = models[i].most_rows(n, table)
            asked[-1][1].append(n)
    counts: dict = {}
    each = len(cuts.points) + 30  # bytes of a row
    while asked:
        load, wave = 0.0, []
        while asked and (not wave or load < LOCAL_BYTES * table.cores):
            i, nodes = asked.pop(0)
            wave.append((i, nodes))
            load += each * (table.rows if ways is not None and len(nodes) == 1 and nodes[0] == 0 else sum(models[i].most_rows(n, table) for n in nodes) * (1.3 if ways is not None else 1.0))
        groups = []
        for i, nodes in wave:
            tree = models[i].tree
            up = {int(c): p for p in range(len(tree.feature)) if tree.feature[p] >= 0 for c in (tree.left[p], tree.right[p])} if ways is not None else {}

            def line(n: int, tree=tree, up=up) -> list[int]:
                out: list[int] = []
                while n in up:
                    n = up[n]
                    out.insert(0, int(tree.stats[n][:-1].argmax()))
                return out

            groups.append((i, nodes, [tree.depth[n] for n in nodes], [tree.stats[n] for n in nodes], [line(n) for n in nodes] if ways is not None else None))
        light = {i: replace(models[i], tree=models[i].tree.light()) for i in dict(wave)}

        def send(blocks, wave=wave, light=light):
            for b in blocks:
                for i, m in light.items():
                    at, w, held = stepped(m.tree, b.bins), m.weights(b), m.rows.held_out(b)
                    train = m.rows.weights(b) > 0
                    own = (w > 0) if ways is None else (w > 0) | held | train
                    slot, group = np.full((2, len(m.tree.feature)), -1)
                    for g, (j, nodes) in enumerate(wave):
                        if i == j:
                            slot[nodes], group[nodes] = np.arange(len(nodes)), g
                    rows = np.flatnonzero(own & (slot[at] >= 0))
                    to = group[at[rows]]
                    rows, to = rows[order := np.argsort(to, kind="stable")], to[order]
                    for part in np.split(rows, np.flatnonzero(np.diff(to)) + 1) if len(rows) else ():
                        yield int(group[at[part[0]]]), (np.ascontiguousarray(b.bins[:, part]), b.label[part], w[part], held[part], train[part], slot[at[part]].astype(np.int32))

        def finish(key_parts, groups=groups, light=light):
            key, parts = key_parts
            i, nodes, depth, stats, lines = groups[key]
            bins, *others = zip(*parts, strict=True)
            bins = np.concatenate(bins, axis=1)
            label, w, held, train, at = (np.concatenate(c) for c in others)
            zero, at = np.zeros(len(label), np.int16), at.astype(np.int64)
            drawn = light[i].subset is not None and light[i].subset < len(cuts.points)  # these don't count by bundles
            b = Block(bins, label, w, zero.astype(np.uint64), zero, zero, [] if drawn else bundled(bins, cuts))
            m = replace(light[i], rows=Rows(), draw=None, tree=Tree.several(depth, stats))
            m, top = _tree_here(m, b, cuts, classes, at, nodes)
            tree = m.tree
            if any(x is None for x in tree.stats):  # a root without rows
                tree.stats = [np.zeros(classes + 1 if classes else 3, np.int64) if x is None else x for x in tree.stats]
            if ways is not None:
                return i, _judged_at(m, b, at, ways, lines, held, train, classes)
            feature, cut, all_ = np.array(tree.feature), np.array(tree.cut), np.array(tree.stats)
            return i, [(n, feature[own], cut[own], all_[own]) for j, n in enumerate(nodes) for own in [np.flatnonzero(top == j)]]

        tasks = min(len(groups), 16 * table.cores)
        done = table.rdd.coalesce(table.cores).mapPartitions(send).groupByKey(tasks, int).map(finish)
        for i, found in table.rdd.context.runJob(done, list):
            if ways is not None:
                _merged(counts, {(i, *k): c for k, c in found.items()})
            else:
                counts.setdefault(i, []).extend(found)
    if ways is None:
        for i, parts in counts.items():
            models[i].tree.grafted(sorted(parts, key=lambda x: x[0]))
        return {}
    return counts


def fit_trees(table: Table, models: list[ClassTree]) -> list[ClassTree]:
    """Grows all trees together: level by level, and the nodes of few rows each in one task."""
    classes, cuts = table.classes, table.cuts
    if table.blocks == 1:
        groups = min(len(models), 4 * table.cores)
        done = table.dealt(groups).flatMap(lambda gb: [(i, _tree_here(models[i], gb[1], cuts, classes)[0]) for i in range(gb[0], len(models), groups)]).collect()
        return [m for _, m in sorted(done, key=lambda x: x[0])]
    _finished(table, models, _large_nodes(table, models), None)
    return models


def judged_trees(table: Table, models: list[ClassTree], ways: Sequence) -> dict:
    """The counts (see `confusions`) of trees that nobody needs: of many
    blocks the nodes of few rows never leave the tasks that grow them."""
    if table.blocks == 1:
        return confusions(table, fit_trees(table, models), ways)
    pending = _large_nodes(table, models)
    for m, nodes in zip(models, pending, strict=True):
        for n in nodes:
            m.tree.feature[n] = -2  # its rows are counted where it is grown
    out = confusions(table, models, ways)
    for m, nodes in zip(models, pending, strict=True):
        for n in nodes:
            m.tree.feature[n] = -1
    return _merged(out, _finished(table, models, pending, ways))


def _large_nodes(table: Table, models: list[ClassTree]) -> list[list[int]]:
    """Grows the nodes of many rows, a pass a level; returns each tree's open nodes of few rows."""
    classes, cuts = table.classes, table.cuts
    count = len(cuts.points)
    # the bins of a tree's own columns are all that is sent
    own = {m.columns: np.flatnonzero(np.isin(cuts.feature, m.columns)) for m in models if m.columns is not None}
    each = (max(classes, 2) + 1) * max(len(own[m.columns]) if m.columns is not None else int(cuts.at[-1]) for m in models) * 8
    most = max(1, PASS_BYTES // max(1, each))
    pending: list[list[int]] = [[] for _ in models]

    def close() -> None:
        for m, nodes in zip(models, pending, strict=True):
            m.close()
            nodes += (few := [n for n in m.tree.open if m.alone and m.most_rows(n, table) <= LOCAL_ROWS])
            m.tree.open = [n for n in m.tree.open if n not in set(few)]

    close()
    while any(m.tree.open for m in models):
        asked = [(i, a) for i, m in enumerate(models) for a in range(0, len(m.tree.open), most)]
        found: dict = {}
        wave: list[tuple[int, int]] = []
        load = 0
        for j, (i, a) in enumerate(asked):
            wave.append((i, a))
            load += min(most, len(models[i].tree.open) - a)
            if load < most and j < len(asked) - 1:
                continue
            sent = [(i, a, replace(models[i], tree=models[i].tree.light())) for i, a in wave]

            known = {(i, a): [models[i].tree.stats[n] for n in models[i].tree.open[a : a + most]] for i, a in wave}

            def level(blocks, sent=sent):
                for b in blocks:
                    for i, a, m in sent:
                        rows, channels = m.channels(b)
                        found = sums(b, cuts, stepped(m.tree, b.bins), rows, channels, m.tree.open[a : a + most], m.features(count), m.mask(m.tree.open[a : a + most], count), classes)
                        yield (i, a), found if m.columns is None else found[:, :, own[m.columns]]

            def pick(key, first, one, by={(i, a): m for i, a, m in sent}, known=known):
                m, at = by[key], key[1] + first
                if m.columns is not None:
                    sent, one = one, np.zeros((*one.shape[:2], cuts.at[-1]), np.int64)
                    one[:, :, own[m.columns]] = sent
                return best_splits(one, cuts, m.features(count), m.gain, m.mask(m.tree.open[at : at + len(one)], count), known[key][first : first + len(one)])

            found |= picked(table, table.rdd, level, pick)
            wave, load = [], 0
        for i, m in enumerate(models):
            if m.tree.open:
                m.tree.extend([x for a in range(0, len(m.tree.open), most) for x in found[i, a]])
        close()
    return pending


#: steps of the mean weight in SAMME's sums
FINE = float(1 << 30)


@dataclass
class WeightTree(GainTree):
    """A round's tree of `Samme`, from blocks that hold the round's weights (of mean 1)."""

    min_split: float = 0
    min_leaf: float = 0

    def channels(self, b: Block) -> tuple[np.ndarray, list[np.ndarray]]:
        return np.flatnonzero(b.weight > 0), [b.label.astype(np.int64), np.rint(b.weight * FINE)]


@dataclass
class Vote:
    """A finished round: its tree with the class of each leaf, and what a
    row's weight is multiplied by, missed or not."""

    tree: Grown
    nodes: Nodes
    alpha: float
    missed: float
    met: float

    def said(self, b: Block, again: Sequence[int]) -> np.ndarray:
        """The class that the tree says of each row: columns that are cut again go by their values."""
        out, raw = np.empty(b.bins.shape[1], np.int16), {f: i for i, f in enumerate(again)}
        todo = [(0, np.arange(len(out)))]
        while todo:
            node, rows = todo.pop()
            f = int(self.tree.feature[node])
            if f < 0:
                out[rows] = int(self.tree.value[node])
                continue
            low = b.raw[raw[f]][rows] <= self.nodes.threshold[node] if f in raw else b.bins[f][rows] <= self.tree.cut[node]
            todo += [(int(self.tree.left[node]), rows[low]), (int(self.tree.right[node]), rows[~low])]
        return out


@dataclass
class Samme:
    """M09. Features of many values are cut anew for each round, by the
    round's weights of the sample (as Spark ML cuts them for a weighted
    tree); a round's error follows from the leaves' sums."""

    stages: int = 50
    rate: float = 1.0
    depth: int = 3
    every: int = KEEP_STAGES  # weights are computed from all trees after so many rounds
    max_bins: int = 32
    classes: int = 0
    rows: int = 0
    unit: float = 1.0  # makes the mean weight 1
    cuts: Cuts | None = None
    sample: Sample | None = None
    votes: list[Vote] = field(default_factory=list)

    def rule(self, sample: Sample) -> Cuts:
        self.sample = sample
        points = [weighted_cuts(x, sample.weight, self.max_bins, sample.rows) for x in sample.values.T]
        many = [f for f, x in enumerate(sample.values.T) if len(np.unique(x[~np.isnan(x)])) > min(self.max_bins, sample.rows)]
        self.cuts = Cuts(points, again=many)
        return self.cuts

    def begin(self, table: Table, weighted: bool) -> None:
        self.classes, self.rows = table.classes, table.rows
        if weighted:
            total = table.rdd.map(lambda b: float(b.weight.sum())).sum()
            if total <= 0:
                raise ValueError("no row has a positive weight")
            self.unit = self.rows / total

    def recut(self) -> Cuts:
        points = list(self.cuts.points)
        for f in self.cuts.again:
            points[f] = weighted_cuts(self.sample.values[:, f], self.sample.weight, self.max_bins, self.sample.rows)
        return Cuts(points, again=self.cuts.again)

    def light(self) -> Samme:
        """Without the sample, for tasks that get the cuts."""
        return replace(self, sample=None, votes=[])

    def weighed(self, b: Block, votes: Sequence[Vote], cuts: Cuts, first: bool) -> Block:
        """The block with the weights after these votes and its columns cut anew."""
        w = b.weight * self.unit if first else b.weight
        for vote in votes:
            w = w * np.where(vote.said(b, cuts.again) != b.label, vote.missed, vote.met)
        bins, bundles = b.bins.copy(), [x for x in b.bundles if x[0][0] not in cuts.again]
        for i, f in enumerate(cuts.again):
            bins[f] = np.searchsorted(cuts.points[f], b.raw[i], side="left")
            if cuts.sizes[f] == 2:
                bundles.append((np.array([f]), bins[f].copy()))
        return replace(b, bins=bins, weight=w, bundles=bundles)

    def sums(self, b: Block, tree: Tree, nodes: Sequence[int], cuts: Cuts) -> np.ndarray:
        rows, channels = WeightTree().channels(b)
        return sums(b, cuts, stepped(tree, b.bins), rows, channels, nodes, np.arange(len(cuts.points)), None, self.classes)

    def grow(self, found: Callable[[Tree, Sequence[int]], list[tuple]]) -> Tree:
        """A round's tree; `found` gives the splits of open nodes."""
        model = WeightTree(depth=self.depth)
        while model.tree.open:
            splits = found(model.tree, model.tree.open)
            model.tree.extend(splits if self.depth else [(stats, None) for stats, _ in splits])
            model.close()
        return model.tree

    def take(self, tree: Tree, cuts: Cuts) -> bool:
        """Adds the round's tree; False where the rounds end."""
        stats = np.array(tree.stats)
        leaves = stats[np.array(tree.feature) < 0]
        total, error = float(stats[0][-1]) / FINE, float((leaves[:, -1] - leaves[:, :-1].max(1)).sum()) / FINE
        err = error / total
        if err >= 1.0 - 1.0 / self.classes and err > 0:
            if not self.votes:
                raise ValueError("first weak learner is no better than chance")
            return False
        alpha = self.rate * (math.log((1 - err) / err) + math.log(self.classes - 1)) if err > 0 else 1.0
        met = self.rows / (total - error + error * math.exp(alpha))
        grown = tree.grown(lambda s: float(s[:-1].argmax()))
        nodes = grown.nodes(cuts)
        nodes.cover = nodes.cover * SCALE / FINE
        self.votes.append(Vote(grown, nodes, alpha, met * math.exp(alpha), met))
        said = nodes.predictions[nodes.leaves(self.sample.values)]
        self.sample = replace(self.sample, weight=self.sample.weight * np.where(said != self.sample.label, met * math.exp(alpha), met))
        return err > 0 and len(self.votes) < self.stages


def _samme_here(model: Samme, b: Block) -> Samme:
    """All rows are in this block: its sums are the whole sums."""
    going, first = True, True
    gain = WeightTree().gain
    while going:
        cuts = model.recut()
        b, first = model.weighed(b, model.votes[-1:], cuts, first), False
        going = model.take(model.grow(lambda tree, nodes: best_splits(model.sums(b, tree, nodes, cuts), cuts, np.arange(len(cuts.points)), gain)), cuts)  # noqa: B023
    return model


def fit_samme(table: Table, model: Samme) -> Samme:
    """The rounds of SAMME: a pass a level over blocks that keep their weights from round to round."""
    if table.blocks == 1:
        [done] = table.rdd.map(lambda b: replace(_samme_here(model, b), sample=None)).collect()
        return done
    kept, going, light, gain = None, True, model.light(), WeightTree().gain
    while going:
        cuts, last, first = model.recut(), kept, len(model.votes) % model.every == 0
        votes = list(model.votes) if first else model.votes[-1:]
        kept = (table.rdd if first else last).map(lambda b, v=votes, c=cuts, first=first: light.weighed(b, v, c, first)).persist(StorageLevel.MEMORY_AND_DISK)
        most = max(1, PASS_BYTES // ((table.classes + 1) * int(cuts.at[-1]) * 8))

        def found(tree: Tree, nodes: Sequence[int], kept=kept, cuts=cuts, most=most) -> list[tuple]:
            out: list[tuple] = []
            for a in range(0, len(nodes), most):
                own, sent = nodes[a : a + most], tree.light()
                level = lambda blocks, own=own, sent=sent: ((0, light.sums(b, sent, own, cuts)) for b in blocks)
                out += picked(table, kept, level, lambda key, at, one: best_splits(one, cuts, np.arange(len(cuts.points)), gain))[0]
            return out

        tree = model.grow(found)
        if last is not None:  # this round's passes have read it
            last.unpersist()
        going = model.take(tree, cuts)
    kept.unpersist()
    return model


@dataclass
class Forest:
    """Trees on Poisson samples of the rows, each node with a draw of
    `subset` features (None: all; "sqrt" and "log2" of their number); the
    shares of the leaves are averaged."""

    rows: Rows = field(default_factory=Rows)
    count: int = 100
    depth: int | None = None
    min_split: float = 2
    min_leaf: float = 1
    criterion: str = "gini"
    subset: str | int | None = "sqrt"
    seed: int = 42
    trees: list[Grown] = field(default_factory=list)  # with a row of shares for each node

    def members(self, features: int) -> list[ClassTree]:
        size = {"sqrt": max(1, int(math.sqrt(features))), "log2": max(1, int(math.log2(features)))}.get(self.subset, self.subset)
        return [ClassTree(self.rows, self.depth, self.min_split, self.min_leaf, self.criterion, self.seed * 100_003 + i, size, self.seed * 7919 + i) for i in range(self.count)]

    @staticmethod
    def shares(member: ClassTree) -> Grown:
        feature, cut, left, right = member.tree.arrays()
        stats = np.array(member.tree.stats).astype(np.float64)
        return Grown(feature.astype(np.int16), cut.astype(np.int16), left.astype(np.int32), right.astype(np.int32), max(member.tree.depth),
                     stats[:, :-1] / np.maximum(stats[:, :-1].sum(1, keepdims=True), 1e-300), stats[:, -1] / SCALE)

    def scores(self, b: Block, classes: int) -> np.ndarray:
        return self.add(np.zeros((len(b.label), classes)), b, self.trees)

    @staticmethod
    def add(scores: np.ndarray, b: Block, trees: Sequence[Grown]) -> np.ndarray:
        for t in trees:
            scores += t.value[stepped(t, b.bins)]
        return scores


def fit_forests(table: Table, forests: list[Forest], judged: bool = False):
    """Grows all forests; with `judged` only the count tables of their
    predictions (see `confusions`) are returned, not the trees."""
    classes, cuts, features = table.classes, table.cuts, len(table.cuts.points)
    if table.blocks == 1:
        # a task for each part of a forest's trees would split its votes: one for each forest
        groups = min(len(forests), 4 * table.cores)

        def here(gb):
            for i in range(gb[0], len(forests), groups):
                f = replace(forests[i], trees=[])
                for m in f.members(features):
                    f.trees.append(f.shares(_tree_here(m, gb[1], cuts, classes)[0]))
                yield i, _counts(f, gb[1], classes) if judged else f

        done = dict(table.dealt(groups).flatMap(here).collect())
        return {(i, None, part): c for i, one in done.items() for part, c in one.items()} if judged else [done[i] for i in range(len(forests))]
    if not judged:
        for f in forests:
            f.trees = [f.shares(m) for m in fit_trees(table, f.members(features))]
        return forests
    out: dict = {}
    size = 2 * table.rows  # a tree has no more nodes; the largest one so far says better
    for i, f in enumerate(forests):
        found, largest = _judged_forest(table, f, size if not i else largest)
        out |= {(i, None, part): c for part, c in found.items()}
    return out


def _judged_forest(table: Table, forest: Forest, size: int) -> tuple[dict, int]:
    """The counts of a forest that nobody needs, and the nodes of its largest
    tree: a few trees at a time are grown and added to the rows' scores, which
    stay with the blocks, so that the driver never holds the whole forest.
    `size` is the nodes that a tree is thought to have."""
    classes, members = table.classes, forest.members(len(table.cuts.points))
    kept, largest, last = None, 0, None
    while members:
        many = max(1, DRIVER_NODES // max(1, size))
        grown = fit_trees(table, members[:many])
        members = members[many:]
        trees = [forest.shares(grown.pop(0)) for _ in range(len(grown))]
        size = largest = max(largest, *(len(t.feature) for t in trees))
        if kept is None:
            kept = table.rdd.map(lambda b, t=trees: (b, _added(forest, b, np.zeros((len(b.label), classes)), t)))
        else:
            kept = last.map(lambda x, t=trees: (x[0], _added(forest, x[0], x[1], t)))
        kept.persist(StorageLevel.MEMORY_AND_DISK).count()
        if last is not None:
            last.unpersist()
        last = RDD(kept._jrdd, kept.ctx, kept._jrdd_deserializer)  # without the trees that the steps before hold here
    out = merged(last.map(lambda x: _counted_parts(forest, x[0], x[1].argmax(1), classes)))
    last.unpersist()
    return out, largest


def _added(model: Forest, b: Block, scores: np.ndarray, trees: Sequence[Grown]) -> np.ndarray:
    """The scores with these trees' shares; only rows that are judged have any."""
    asked = np.flatnonzero((model.rows.weights(b) > 0) | model.rows.held_out(b))
    own = replace(b, bins=np.ascontiguousarray(b.bins[:, asked]), label=b.label[asked])
    scores = scores.copy()
    scores[asked] = model.add(scores[asked], own, trees)
    return scores


def _counted_parts(model: Forest, b: Block, predicted: np.ndarray, classes: int) -> dict:
    out = {}
    for part, mask in {"train": model.rows.weights(b) > 0, "valid": model.rows.held_out(b)}.items():
        out[part] = np.bincount(b.label[mask].astype(np.int64) * classes + predicted[mask], minlength=classes * classes).reshape(classes, classes)
    return out


def _counts(model: Forest, b: Block, classes: int) -> dict:
    return _counted_parts(model, b, _added(model, b, np.zeros((len(b.label), classes)), model.trees).argmax(1), classes)


# ---------------------------------------------------------------- scores of many models
def confusions(table: Table, models: list, ways: Sequence) -> dict:
    """Counts (label, predicted) of each (model number, way, part), part being
    'train' (the model's own rows, unweighted) or 'valid' (its held-out fold),
    from one pass. A way is a depth (trees) or a number of stages."""
    classes, groups = table.classes, min(len(models), 4 * table.cores) if table.blocks == 1 else 1

    def count(parts):
        for g, b in parts:
            out = {}
            for i in range(g, len(models), groups):
                m = models[i]
                masks = {"train": m.rows.weights(b) > 0, "valid": m.rows.held_out(b)}
                if isinstance(m, ClassTree) and -2 in m.tree.feature:  # rows in these nodes are counted elsewhere
                    here = np.array(m.tree.feature)[stepped(m.tree, b.bins)] != -2
                    masks = {part: mask & here for part, mask in masks.items()}
                scores, done = None, 0
                for way in sorted(ways, key=lambda v: math.inf if v is None else v):
                    if isinstance(m, ClassTree):
                        predicted = m.predicted(b, way)
                    else:
                        upto = len(m.trees) if way is None else min(way, len(m.trees))
                        scores = m.add(np.tile(np.array(m.start), (len(b.label), 1)) if scores is None else scores, b, m.trees[done:upto])
                        done, predicted = upto, scores.argmax(1)
                    for part, mask in masks.items():
                        place = b.label[mask].astype(np.int64) * classes + predicted[mask]
                        out[i, way, part] = np.bincount(place, minlength=classes * classes).reshape(classes, classes)
            yield out

    parts = table.dealt(groups) if table.blocks == 1 else table.rdd.map(lambda b: (0, b))
    return merged(parts.mapPartitions(count))


def weighted_f1(counts: np.ndarray) -> float:
    """Weighted F1 of a count table (label, predicted); 0 for classes without
    a hit, as in the metrics operators."""
    hit, truth, said = np.diag(counts).astype(float), counts.sum(1), counts.sum(0)
    f1 = np.divide(2 * hit, truth + said, out=np.zeros(len(hit)), where=truth + said > 0)
    return float((f1 * truth).sum() / truth.sum()) if truth.sum() else 0.0
