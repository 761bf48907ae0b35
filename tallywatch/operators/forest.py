"""Isolation Forest (Liu, Ting, Zhou 2008) fitted and applied on Spark.

Fit: every row draws its trees by hash, so each tree gets at most ``sample_size`` rows and
one grouped-map call builds it. Splits are drawn by hashes of tree and node, not by a random
generator, so any engine with md5 grows the same trees. The fitted forest has a fixed size
(trees x 2 x sample size), independent of the data, so it is collected and broadcast. Score: a
vectorised pandas UDF walks all trees for an Arrow batch, or every tree is one compiled SQL
expression that needs no Python worker; both are stateless, work on streams and agree to the
last bit.

Model inputs are rounded, because user means differ in their last bits with the order of the
rows and must not move a row across a split. Path lengths are rounded to parts that doubles add
without error, so the order of the trees does not matter either.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.hashing import hash52, hash_text
from tallywatch.schema import FEATURES
from tallywatch.session import spread

N_TREES = 100
SAMPLE_SIZE = 256
# Rows drawn per tree before the exact cut, relative to the sample size.
OVERSAMPLE = 1.5
HASH_RANGE = 2**52
# Decimals of model inputs, and parts of 1 to which path lengths are rounded.
INPUT_DIGITS = 6
PATH_STEPS = 2.0**30
# Rounded inputs stand beside the feature columns under names of their own.
MODEL_PREFIX = "_model_"

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, "
    "left int, right int, n_samples long, depth int"
)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points, in whole parts of PATH_STEPS."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    full = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, np.round(full * PATH_STEPS) / PATH_STEPS, np.where(n == 2, 1.0, 0.0))


def max_depth(sample_size: int) -> int:
    return max(1, math.ceil(math.log2(max(sample_size, 2))))


def model_inputs(df: DataFrame, columns: list[str]) -> list[Column]:
    """The columns as rounded doubles; whole numbers need no rounding."""
    rounded = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return [
        (F.round(F.col(c).cast("double"), INPUT_DIGITS) if c in rounded
         else F.col(c).cast("double")).alias(c)
        for c in columns
    ]


def draw_samples(
    rows: DataFrame, n_rows: int, row_id: str, n_trees: int, sample_size: int, seed: int
) -> DataFrame:
    """``tree_id`` and the sampled rows: ``min(sample_size, n_rows)`` per tree.

    The draw depends on row id and seed only. A row is a candidate of every tree with the
    same probability, independently of the others, whatever the table size. One hash decides
    which tree is the row's first, if any: that index has a geometric distribution. The
    trees after it have a hash each, so only rows with a first tree cost more than one.
    """
    wanted = OVERSAMPLE * sample_size / max(n_rows, 1)
    limit = int(HASH_RANGE * min(1.0, wanted))
    if limit == HASH_RANGE:
        first = F.lit(0)
    else:
        u = (hash52(seed, F.col(row_id)) + 1) / F.lit(HASH_RANGE)
        first = F.floor(F.log(u) / F.lit(math.log1p(-limit / HASH_RANGE)))
    others = F.filter(
        F.sequence(F.lit(0), F.lit(n_trees - 1)),
        lambda tree: (tree == F.col("_first")) | ((tree > F.col("_first")) & (
            hash52(seed, tree, F.col(row_id)) < limit)),
    )
    drawn = (
        rows.withColumn("_first", first).filter(F.col("_first") < n_trees)
        .withColumn("tree_id", F.explode(others)).drop("_first")
    )
    drawn = spread(drawn, "tree_id", at_most=n_trees)
    order = hash_text(seed + 2, F.col("tree_id"), F.col(row_id))
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy(order, row_id))
    return drawn.withColumn("_place", place).filter(F.col("_place") <= sample_size).drop("_place")


def split_draws(seed: int, tree: int) -> Callable[[int], tuple[int, float]]:
    """For each node of a tree: a number that picks the feature, and one in [0, 1) for the cut."""
    def draw(node: int) -> tuple[int, float]:
        pick, share = (
            int(hashlib.md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:8], 16)
            for what in ("feature", "cut")
        )
        return pick, share / 2**32

    return draw


def grow_tree(
    points: np.ndarray, draw: Callable[[int], tuple[int, float]], depth_limit: int
) -> list[tuple]:
    """Nodes of one tree in heap numbering: the children of i are 2i+1 and 2i+2.

    Leaves have feature -1.
    """
    nodes = []
    todo = [(0, 0, points)]
    while todo:
        node, depth, part = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= depth_limit or len(part) <= 1 or len(splittable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(part), depth))
            continue
        pick, share = draw(node)
        feature = int(splittable[pick % len(splittable)])
        bottom, top = float(low[feature]), float(high[feature])
        threshold = bottom + (top - bottom) * share
        if threshold >= top:  # rounded up: the largest value must stay on the right
            threshold = bottom
        goes_left = part[:, feature] <= threshold
        nodes.append((node, feature, threshold, 2 * node + 1, 2 * node + 2, len(part), depth))
        todo.append((2 * node + 1, depth + 1, part[goes_left]))
        todo.append((2 * node + 2, depth + 1, part[~goes_left]))
    return nodes


def fit_nodes(
    features: DataFrame,
    n_rows: int,
    row_id: str,
    columns: list[str] = FEATURES,
    n_trees: int = N_TREES,
    sample_size: int = SAMPLE_SIZE,
    seed: int = 42,
) -> DataFrame:
    """Node table of the fitted forest."""
    size = min(sample_size, n_rows)
    limit = max_depth(size)
    samples = draw_samples(
        features.select(row_id, *model_inputs(features, columns)),
        n_rows, row_id, n_trees, size, seed,
    )

    def build(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree_id"].iloc[0])
        points = sample.sort_values(row_id)[columns].to_numpy(dtype=float)
        nodes = grow_tree(points, split_draws(seed, tree), limit)
        table = pd.DataFrame(nodes, columns=[
            "node_id", "feature", "threshold", "left", "right", "n_samples", "depth"
        ])
        table.insert(0, "tree_id", tree)
        return table

    return samples.groupBy("tree_id").applyInPandas(build, NODE_SCHEMA)


@dataclass
class Forest:
    """Fitted forest: the (small) node rows, the sample size and the score offset."""

    nodes: pd.DataFrame
    sample_size: int
    columns: list[str]
    offset: float = 0.0
    _shared: dict = field(default_factory=dict, repr=False, compare=False)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per tree: split features and thresholds of a complete binary tree, and the path
        length at each of its deepest positions. Below a leaf every row keeps left."""
        depth = max_depth(self.sample_size)
        tree_ids = np.sort(self.nodes["tree_id"].unique())
        inner, deepest = 2**depth - 1, 2**depth
        features = np.zeros((len(tree_ids), inner), dtype=np.int32)
        thresholds = np.full((len(tree_ids), inner), np.inf)
        lengths = np.zeros((len(tree_ids), deepest))
        place = {tree: i for i, tree in enumerate(tree_ids)}
        paths = self.nodes["depth"].to_numpy() + average_path(self.nodes["n_samples"].to_numpy())
        for row, path in zip(self.nodes.itertuples(index=False), paths):
            tree = place[row.tree_id]
            if row.feature >= 0:
                features[tree, row.node_id] = row.feature
                thresholds[tree, row.node_id] = row.threshold
            else:
                below = depth - row.depth
                lengths[tree, ((row.node_id + 1) << below) - 1 - inner] = path
        return features, thresholds, lengths

    def raw_score(self, points: np.ndarray) -> np.ndarray:
        """``-2 ** (-mean path / expected path)`` for a matrix of feature rows."""
        return score_matrix(points, self.arrays(), self.sample_size)

    def raw_score_column(self, df: DataFrame) -> Column:
        """Raw score of the feature columns of ``df``, by Arrow batches."""
        return self.score_of_paths(self.path_column(df))

    def path_column(self, df: DataFrame) -> Column:
        return self._udf(df)(F.struct(*model_inputs(df, self.columns)))

    def score_of_paths(self, total: Column) -> Column:
        n_trees = max(self.nodes["tree_id"].nunique(), 1)
        expected = max(float(average_path(self.sample_size)), 1e-12)
        return -F.pow(F.lit(2.0), -(total / F.lit(float(n_trees))) / F.lit(expected))

    def compiled_paths(self) -> Column:
        """Sum of the path lengths over all trees, each tree one nested conditional in SQL.

        A row takes one comparison per level and tree. Planning takes some seconds, as the plan
        holds every split: for long scans, or where no Python may run. Reads the rounded inputs
        under their prefixed names.
        """
        paths = [F.expr(text) for text in self.tree_texts()]
        return F.aggregate(F.array(*paths), F.lit(0.0), lambda total, path: total + path)

    def tree_texts(self) -> list[str]:
        """Each tree as SQL over columns named after the features, with a prefix."""
        paths = self.nodes["depth"].to_numpy() + average_path(self.nodes["n_samples"].to_numpy())
        trees: dict[int, dict[int, tuple]] = {}
        for row, path in zip(self.nodes.itertuples(index=False), paths):
            trees.setdefault(row.tree_id, {})[row.node_id] = (row, float(path))

        def text(nodes: dict[int, tuple], node: int) -> str:
            row, path = nodes[node]
            if row.feature < 0:
                return f"{path!r}D"
            return (f"if(`{MODEL_PREFIX}{self.columns[row.feature]}` <= {row.threshold!r}D, "
                    f"{text(nodes, row.left)}, {text(nodes, row.right)})")

        return [text(trees[tree], 0) for tree in sorted(trees)]

    def _udf(self, df: DataFrame):
        context = df.sparkSession.sparkContext
        shared = self._shared.get(context.applicationId)
        if shared is None:
            shared = context.broadcast((self.arrays(), self.sample_size))
            self._shared[context.applicationId] = shared

        @F.pandas_udf("double")
        def isolation_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            arrays, size = shared.value
            for batch in batches:
                yield pd.Series(path_sums(batch.to_numpy(dtype=float), arrays, size))

        # Scoring costs more than any filter saves: declared nondeterministic, it is never
        # copied into a filter and so runs once per row.
        return isolation_paths.asNondeterministic()

    def score(
        self, df: DataFrame, compiled: bool = False, paths: str | None = None
    ) -> DataFrame:
        """Adds ``ml_anomaly_score`` (lower is stranger) and ``is_ml_anomaly``, and the sum of
        path lengths under the name ``paths``. ``compiled``: by the JVM alone."""
        total = paths or f"{MODEL_PREFIX}paths"
        if compiled:
            inputs = dict(zip(self.columns, model_inputs(df, self.columns)))
            rows = df.withColumns({f"{MODEL_PREFIX}{c}": v for c, v in inputs.items()})
            walked = rows.withColumn(total, self.compiled_paths())
        else:
            walked = df.withColumn(total, self.path_column(df))
        scored = walked.withColumn(
            "ml_anomaly_score", self.score_of_paths(F.col(total)) - F.lit(self.offset)
        ).withColumn("is_ml_anomaly", F.col("ml_anomaly_score") < 0)
        helpers = [f"{MODEL_PREFIX}{c}" for c in self.columns] if compiled else []
        return scored.drop(*helpers, *([] if paths else [total]))


def path_sums(
    points: np.ndarray, arrays: tuple[np.ndarray, np.ndarray, np.ndarray], sample_size: int
) -> np.ndarray:
    """Sum of the path lengths over all trees for every row."""
    features, thresholds, lengths = arrays
    n, width = points.shape
    flat = np.ascontiguousarray(points).ravel()
    row_start = np.arange(n, dtype=np.int64) * width
    depth, inner = max_depth(sample_size), thresholds.shape[1]
    total = np.zeros(n)
    for split, cut, length in zip(features, thresholds, lengths):
        at = np.zeros(n, dtype=np.int64)
        for _ in range(depth):
            value = flat[row_start + split[at]]
            at = 2 * at + 1 + (value > cut[at])
        total += length[at - inner]
    return total


def score_matrix(
    points: np.ndarray, arrays: tuple[np.ndarray, np.ndarray, np.ndarray], sample_size: int
) -> np.ndarray:
    mean_path = path_sums(points, arrays, sample_size) / max(len(arrays[0]), 1)
    return -np.exp2(-mean_path / max(float(average_path(sample_size)), 1e-12))
