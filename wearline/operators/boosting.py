"""Boosted regression trees from binned blocks: the trees of Spark ML's ``GBTRegressor``, level by level.

Spark ML keeps every row as objects of about 200 bytes and looks at them one by one, once a tree level. Here a row is
a byte or so a feature (the number of its bin) and its residual. Rows lie in blocks of numpy arrays, a few MB each, in a
persisted RDD; a level is one pass over them, in which each task adds up counts and sums of residuals by node, feature and bin,
and the driver adds the tasks' sums (bounded by nodes, features and bins) and chooses the splits. Of two nodes below a split
only the smaller is added up: the other is what their parent has more.

Same method and parameters as Spark ML, so the same trees but for ties that differ in the last bits of a sum: candidate
thresholds from the same seeded sample of its size, squared loss, variance gain, the first best split in order of features,
``minInstancesPerNode`` and ``minInfoGain``, the first tree with weight 1 and the others with ``stepSize``, equal leaves
joined. The result is Spark ML's own model class, saved and loaded by its calls. An empty input, or a label
that is null or not finite, is an error, as there. No subsampling of rows or features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import not_finite
from ..session import ship_package

BLOCK_ROWS = 65_536
FOLD_TREES = 2    # trees after which the residuals of the blocks are brought up to date
TASKS_A_CORE = 2  # of a pass
SAMPLE_ROWS = 10_000  # Spark ML's number of rows for thresholds, or the square of maxBins
EPSILON = 2.0 ** -52


def fit_boosted(est: GBTRegressor, rows: DataFrame, cols: Sequence[str]) -> GBTRegressionModel:
    """The model that ``est`` would fit to ``rows``, whose features are ``cols``. ``rows`` is read three times."""
    if est.getSubsamplingRate() != 1.0 or est.getFeatureSubsetStrategy() not in ("all", "auto") or est.getLossType() != "squared":
        raise ValueError("only squared loss over all rows and features")
    spark, label = rows.sparkSession, est.getLabelCol()
    ship_package(spark)
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in [*cols, label]])
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if(not_finite(F.col(label)))).first()
    if not n or bad:
        raise ValueError(f"{bad} labels are null or not finite" if n else "no row to fit to")
    cuts = thresholds(rows.select(*cols), n, min(est.getMaxBins(), n), est.getSeed())
    trees = _grow(spark.sparkContext, _blocks(rows, cuts), cuts, est)
    return _model(est, trees, cuts, len(cols))


def thresholds(features: DataFrame, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 thresholds a feature, from about ``SAMPLE_ROWS`` of the ``n`` rows (all, if there are no more)."""
    spark, most = features.sparkSession, max(bins * bins, SAMPLE_ROWS)
    share = most / n if n > most else 1.0
    if share < 1:
        jvm = spark.sparkContext._jvm
        seed = jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = features._jdf.javaRDD().sample(False, share, seed)
        features = DataFrame(spark._jsparkSession.createDataFrame(sampled, features._jdf.schema()), spark)
    values = features.toPandas().to_numpy(dtype=np.float64, copy=False).reshape(-1, len(features.columns))
    return [_cuts(values[:, i], share * n, bins - 1) for i in range(values.shape[1])]


def _cuts(values: np.ndarray, weight: float, most: int) -> np.ndarray:
    """Thresholds half-way between values, ``weight`` / (``most`` + 1) rows apart; zeros are what lacks to ``weight``."""
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    if not len(found):
        return np.empty(0)
    zeros = weight - counts.sum()
    pairs = list(zip(found.tolist(), counts.astype(float).tolist(), strict=True))
    if zeros > EPSILON * counts.sum() * 100:
        pairs = sorted([*pairs, (0.0, zeros)])
    if len(pairs) - 1 <= most:
        return np.array([(a + b) / 2.0 for (a, _), (b, _) in zip(pairs, pairs[1:])])
    stride, out = weight / (most + 1), []
    reached, target = pairs[0][1], stride
    for (a, _), (b, count) in zip(pairs, pairs[1:]):
        before, reached = reached, reached + count
        if abs(before - target) < abs(reached - target):
            out.append((a + b) / 2.0)
            target += stride
    return np.array(out)


class _Layout:
    """Two features share a code of 16 bits, ``side`` times the bin of the first and the bin of the second, so one count serves both."""

    def __init__(self, cuts: Sequence[np.ndarray]):
        self.live = [i for i, c in enumerate(cuts) if len(c)]  # a feature without a threshold is never split
        self.side = max([len(cuts[i]) + 1 for i in self.live], default=1)
        if self.side > 256:
            raise ValueError("at most 256 bins")
        self.pairs = (len(self.live) + 1) // 2

    def right(self, codes: np.ndarray, k: int, cut: int) -> np.ndarray:
        """Rows whose bin of the k-th live feature is above ``cut``."""
        row = codes[k // 2]
        return row - row // self.side * self.side > cut if k % 2 else row >= (cut + 1) * self.side


def _blocks(rows: DataFrame, cuts: Sequence[np.ndarray]) -> RDD:
    """(codes, labels) of up to ``BLOCK_ROWS`` rows each."""
    at, width = _Layout(cuts), len(rows.columns) - 1

    def run(batches):
        import pyarrow as pa

        def block(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            codes, labels = np.concatenate([c for c, _ in parts], axis=1), np.concatenate([y for _, y in parts])
            return pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())], ["codes", "labels"])

        parts, held = [], 0
        for b in batches:
            codes = np.zeros((at.pairs, b.num_rows), np.uint16)
            for k, i in enumerate(at.live):
                bins = np.searchsorted(cuts[i], b.column(i).to_numpy(zero_copy_only=False)).astype(np.uint16)
                codes[k // 2] += bins if k % 2 else bins * at.side
            parts.append((codes, b.column(width).to_numpy(zero_copy_only=False)))
            held += b.num_rows
            if held >= BLOCK_ROWS:
                yield block(parts)
                parts, held = [], 0
        if held:
            yield block(parts)

    def opened(row):
        labels = np.frombuffer(row["labels"], np.float64)
        codes = np.frombuffer(row["codes"], np.uint16) if at.pairs else np.empty(0, np.uint16)
        return codes.reshape(at.pairs, len(labels)), labels

    return rows.mapInArrow(run, "codes binary, labels binary").rdd.map(opened)


class _Tree:
    """Splits by level, {position: (live feature, cut)}; a row at position p goes to 2 p or 2 p + 1, in a leaf on to 2 p."""

    def __init__(self, depth: int, weight: float):
        self.depth, self.weight = depth, weight
        self.levels: list[dict[int, tuple[int, int]]] = []
        self.gains: dict[tuple[int, int], float] = {}
        self.stats: dict[tuple[int, int], list[float]] = {}  # (level, position): rows, sum and sum of squares of what is fitted

    def positions(self, at: _Layout, codes: np.ndarray) -> np.ndarray:
        here = np.zeros(codes.shape[1], np.uint8 if self.depth < 8 else np.uint32)
        for level in self.levels:
            below = here << 1
            for p, (k, cut) in level.items():
                below |= (here == p) & at.right(codes, k, cut)
            here = below
        return here

    def picked(self) -> list[int]:
        """Positions of the open level whose rows are added up: the smaller node below each split."""
        level = len(self.levels)
        return [2 * p + (self.stats[level, 2 * p + 1][0] < self.stats[level, 2 * p][0]) for p in sorted(self.levels[-1])] if level else [0]

    def close(self, squares: np.ndarray) -> None:
        """The leaves' sums of squares, by position below the last level; their rows and sums are known from the splits."""
        for (level, p), held in self.stats.items():
            if level == len(self.levels):
                held[2] = float(squares[p])

    def values(self) -> np.ndarray:
        """The forecast by position below the last level, where leaves of upper levels have gone on to the left."""
        out = np.zeros(1 << len(self.levels))
        for (level, p), (n, total, _) in sorted(self.stats.items()):
            if n and level <= len(self.levels):
                width = len(self.levels) - level
                out[p << width:(p + 1) << width] = total / n
        return out


def _residuals(at: _Layout, codes: np.ndarray, left: np.ndarray, trees: Sequence[tuple[_Tree, np.ndarray]]) -> np.ndarray:
    for tree, values in trees:
        left = left - (tree.weight * values)[tree.positions(at, codes)]
    return left


def _sums(at: _Layout, since: Sequence[tuple[_Tree, np.ndarray]], tree: _Tree, blocks: Iterator) -> Iterator[tuple]:
    """A task's sums for the open level of ``tree``: (rows, sum, sum of squares) by position, and rows and sums by
    live feature, picked position and bin; of residuals after the trees ``since``. Last, at the first level, the squares by leaf
    position of what the last of those trees was fitted to."""
    nodes, side, picked = 1 << len(tree.levels), at.side, tree.picked() if len(tree.levels) < tree.depth else []
    slot = np.full(nodes, -1, np.int64)
    slot[picked] = np.arange(len(picked))
    totals, cells = np.zeros((3, nodes)), np.zeros((at.pairs, 2, len(picked) * side * side))
    last, squares = since[-1:] if not tree.levels else [], 0.0
    for codes, left in blocks:
        left = _residuals(at, codes, left, since[:-1] if last else since)
        for done, values in last:
            here = done.positions(at, codes)
            squares = squares + np.bincount(here, left * left, len(values))
            left = left - (done.weight * values)[here]
        here = tree.positions(at, codes)
        for i, w in enumerate((None, left, left * left)):
            totals[i] += np.bincount(here, w, nodes)
        if picked:
            base = slot[here]
            rows = np.flatnonzero(base >= 0)
            base, left = base[rows] * (side * side), left[rows]
            for j in range(at.pairs):
                cell = base + codes[j][rows]
                cells[j, 0] += np.bincount(cell, None, cells.shape[2])
                cells[j, 1] += np.bincount(cell, left, cells.shape[2])
    cells = cells.reshape(at.pairs, 2, len(picked), side, side)
    yield totals, np.stack([cells.sum(axis=4), cells.sum(axis=3)], axis=1).reshape(2 * at.pairs, 2, len(picked), side), squares


def _grow(sc, blocks: RDD, cuts: Sequence[np.ndarray], est: GBTRegressor) -> list[_Tree]:
    at, kept, trees, since = _Layout(cuts), [blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER)], [], []
    try:
        blocks.count()  # cut by its own tasks; passes take several partitions a task
        tasks = min(blocks.getNumPartitions(), TASKS_A_CORE * sc.defaultParallelism)

        def measured(tree: _Tree) -> tuple[np.ndarray, np.ndarray]:
            passed = kept[-1].coalesce(tasks).mapPartitions(lambda it, since=since: _sums(at, since, tree, it)).collect()
            while len(kept) > 1:
                kept.pop(0).unpersist()
            totals, cells, squares = (sum(p[i] for p in passed) for i in range(3))
            scale = 2.0 if trees else 1.0  # the loss's gradient is twice the residual
            if since and not tree.levels:
                since[-1][0].close(squares * (scale * scale if len(trees) > 1 else 1.0))
            return totals * [[1.0], [scale], [scale * scale]], cells * [[[1.0]], [[scale]]]

        for m in range(est.getMaxIter()):
            tree = _Tree(est.getMaxDepth(), est.getStepSize() if m else 1.0)
            above: dict[int, np.ndarray] = {}
            while len(tree.levels) < tree.depth:
                picked, (totals, cells) = tree.picked(), measured(tree)
                here = {p: cells[:, :, i] for i, p in enumerate(picked)}
                for p in picked if above else []:
                    here[p ^ 1] = above[p // 2] - here[p]
                    here[p ^ 1][:, 1][here[p ^ 1][:, 0] == 0] = 0.0  # no rows, no sum
                _split(tree, totals, here, at, cuts, est)
                above = here
                if not tree.levels[-1]:
                    tree.levels.pop()
                    break
            trees.append(tree)
            since = [*since, (tree, tree.values())]
            if len(since) > FOLD_TREES:
                kept.append(kept[-1].map(lambda b, done=since[:-1]: (b[0], _residuals(at, *b, done))).persist(StorageLevel.MEMORY_AND_DISK_DESER))
                since = since[-1:]
        measured(_Tree(0, 0.0))  # for the last tree's leaves
        return trees
    finally:
        for rdd in kept:
            rdd.unpersist()


def _impurity(n: float, total: float, squares: float) -> float:
    return (squares - total * total / n) / n if n else 0.0


def _split(tree: _Tree, totals: np.ndarray, cells: dict[int, np.ndarray], at: _Layout, cuts: Sequence[np.ndarray], est: GBTRegressor) -> None:
    """Adds the splits of the open level, from the rows and sums by position, and the rows and sums of the nodes below."""
    level, found = len(tree.levels), {}
    bins = np.arange(at.side)
    allowed = np.array([len(cuts[i]) for i in at.live])[:, None] > bins if at.live else np.zeros((0, len(bins)), bool)
    for p in sorted(cells):
        n, total, squares = totals[:, p]
        tree.stats[level, p] = [n, total, squares]
        if level and abs(_impurity(n, total, squares)) < EPSILON:
            continue
        rows, sums = np.cumsum(cells[p][:len(at.live)], axis=2).transpose(1, 0, 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (sums * sums / rows + (total - sums) ** 2 / (n - rows) - total * total / n) / n
        least = est.getMinInstancesPerNode()
        gain = np.where(allowed & (rows >= least) & (n - rows >= least), gain, -np.inf)
        if not gain.size or not (best := gain.max()) > 0 or best < est.getMinInfoGain():
            continue
        k, cut = map(int, np.unravel_index(np.argmax(gain), gain.shape))
        found[p] = k, cut
        tree.gains[level, p] = float(best)
        tree.stats[level + 1, 2 * p] = [rows[k, cut], sums[k, cut], 0.0]
        tree.stats[level + 1, 2 * p + 1] = [n - rows[k, cut], total - sums[k, cut], 0.0]
    tree.levels.append(found)


def _model(est: GBTRegressor, trees: Sequence[_Tree], cuts: Sequence[np.ndarray], features: int) -> GBTRegressionModel:
    """Spark ML's model of the trees, with the parameters of ``est``."""
    from pyspark import SparkContext

    gateway, at = SparkContext._active_spark_context._gateway, _Layout(cuts)
    ml, impurity = gateway.jvm.org.apache.spark.ml, gateway.jvm.org.apache.spark.mllib.tree.impurity

    def node(tree: _Tree, level: int, p: int):
        """(the node, its forecast if it is a leaf)"""
        n, total, squares = map(float, tree.stats[level, p])
        held, forecast = gateway.new_array(gateway.jvm.double, 3), total / n if n else 0.0
        held[0], held[1], held[2] = n, total, squares
        stats, spread = impurity.VarianceCalculator(held, int(n)), _impurity(n, total, squares)
        if level == len(tree.levels) or p not in tree.levels[level]:
            return ml.tree.LeafNode(forecast, spread, stats), forecast
        (left, a), (right, b) = node(tree, level + 1, 2 * p), node(tree, level + 1, 2 * p + 1)
        if a is not None and a == b:
            return ml.tree.LeafNode(a, spread, stats), a
        k, cut = tree.levels[level][p]
        split = ml.tree.ContinuousSplit(at.live[k], float(cuts[at.live[k]][cut]))
        return ml.tree.InternalNode(forecast, spread, tree.gains[level, p], left, right, split, stats), None

    grown = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        grown[i] = ml.regression.DecisionTreeRegressionModel(node(tree, 0, 0)[0], features)
        weights[i] = tree.weight
    est._transfer_params_to_java()
    java = ml.regression.GBTRegressionModel(est.uid, grown, weights, features)
    return est._copyValues(GBTRegressionModel(java.copy(est._java_obj.extractParamMap())))
