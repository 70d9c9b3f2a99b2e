"""Isolation forest: split, fit, score, label, check.

Fitting looks at a few hundred rows per tree whatever the size of the table; scoring is one map over all rows with the
trees (a bounded table) sent along. All that is random comes from MD5 digests of seed, key, tree and place in the tree,
so a forest can be grown again by anything that has MD5 and 64-bit integers.
"""
from __future__ import annotations

import hashlib
import math
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

N_TREES = 100
SUBSAMPLE = 256
SEED = 42

# ---- Fixed values: the labels of the result. ----------------------------------------------------------------------
INLIER_LABEL, OUTLIER_LABEL = "Inliers", "Outlier"

# the largest prime below 2**48: draws are taken modulo it
DRAWS = 281_474_976_710_597

TREES_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, left int, right int, n bigint, depth int, "
                "psi int")


# ---- rows ---------------------------------------------------------------------------------------------------------

def handle_nulls(features: DataFrame, columns: list[str], nulls: str = "error") -> DataFrame:
    """What to do about missing features: ``error`` names the columns, ``drop`` drops rows, ``median`` fills in."""
    if nulls == "drop":
        return features.na.drop(subset=columns)
    if nulls == "median":
        row = features.agg(*[F.median(F.col(c)).alias(c) for c in columns]).first()
        return features.na.fill({c: row[c] for c in columns if row[c] is not None}, columns)
    if nulls != "error":
        raise ValueError("nulls must be 'error', 'drop' or 'median'")
    row = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = [c for c in columns if row[c]]
    if bad:
        raise ValueError(f"missing values in {', '.join(bad)}")
    return features


def split_rows(rows: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Add ``split``: train for three quarters of the keys, test for the rest, by a hash of the key. A row's side never
    depends on partitioning or on other rows."""
    byte = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 2)
    return rows.withColumn("split", F.when(byte < "c0", "train").otherwise("test"))


# ---- fit ----------------------------------------------------------------------------------------------------------

def _hex_number(text: Column, start: int, digits: int) -> Column:
    """Digits of a text's MD5 as a number; 13 digits are 52 bits, which a double holds exactly."""
    return F.conv(F.substring(F.md5(text), start, digits), 16, 10).cast("bigint")


def tree_samples(rows: DataFrame, key: str, columns: list[str], n_trees: int = N_TREES, subsample: int = SUBSAMPLE,
                 seed: int = SEED) -> tuple[DataFrame, int]:
    """``subsample`` rows per tree, drawn without replacement by hash order; returns the sample and its size per tree.

    One digest of (seed, key) gives two numbers a and b, and a row's draw for a tree is (a + tree b) modulo a prime: for
    any two trees the draws are independent. Only rows whose draw lies under a threshold just large enough are expanded,
    so the table is never multiplied by the number of trees. Should a tree get too few that way, the threshold is raised
    and the pass repeated: the result is exactly the lowest draws of each tree.
    """
    n = rows.count()
    psi = min(subsample, n)
    if psi < 2:
        raise ValueError("a forest needs at least two rows")
    share = min(1.0, 4.0 * psi / n + 64.0 / n)
    key_text = F.col(key).cast("string")
    name = F.concat(F.lit(f"{seed}|"), key_text)
    numbered = rows.select(key_text.alias("_key"), *columns, _hex_number(name, 1, 12).alias("_a"),
                           _hex_number(name, 13, 12).alias("_b"))
    while True:
        limit = F.lit(int(share * DRAWS)).cast("bigint")
        draws = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
                t.alias("tree_id"), ((F.col("_a") + t * F.col("_b")) % DRAWS).alias("draw"))),
            lambda d: d["draw"] <= limit)
        drawn = numbered.select("_key", *columns, F.inline(draws))
        rank = F.row_number().over(W.partitionBy("tree_id").orderBy("draw", "_key"))
        sample = drawn.withColumn("_rn", rank).where(F.col("_rn") <= psi).drop("_rn", "draw")
        if share >= 1.0:
            return sample, psi
        full = drawn.groupBy("tree_id").count().where(F.col("count") >= psi).count()
        if full == n_trees:
            return sample, psi
        share = min(1.0, share * 4)


def grow_tree(x: np.ndarray, tree_id: int, seed: int, max_depth: int) -> list[tuple]:
    """Nodes of one isolation tree, level by level: split a random feature at a uniform point of its range until a node
    has one row, no spread, or the depth cap.

    Feature and threshold come from the MD5 of (seed, tree, node), nodes being numbered as in a heap (root 1, children
    2k and 2k + 1), so they depend on the place in the tree and on the rows only. The ids that come out count the nodes
    in the order they are made.
    """
    nodes: list[tuple] = []
    todo = deque([(1, 0, np.arange(len(x)))])
    made = 1
    while todo:
        place, depth, rows = todo.popleft()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(usable):
            nodes.append((len(nodes), -1, np.nan, -1, -1, len(rows), depth))
            continue
        digest = hashlib.md5(f"{seed}|{tree_id}|{place}".encode()).hexdigest()
        feature = int(usable[int(digest[:12], 16) % len(usable)])
        lo, hi = float(low[feature]), float(high[feature])
        # 13 digits are 52 bits, which a double holds; a draw that rounds to the upper end would leave the right side empty
        drawn = lo + int(digest[12:25], 16) / 2.0 ** 52 * (hi - lo)
        threshold = drawn if drawn < hi else lo
        right = part[:, feature] > threshold
        nodes.append((len(nodes), feature, threshold, made, made + 1, len(rows), depth))
        made += 2
        todo += [(2 * place, depth + 1, rows[~right]), (2 * place + 1, depth + 1, rows[right])]
    return nodes


def fit(rows: DataFrame, key: str, columns: list[str], n_trees: int = N_TREES, subsample: int = SUBSAMPLE,
        seed: int = SEED) -> DataFrame:
    """The forest as a table of nodes. Each tree is grown from its own few hundred rows in its own group."""
    sample, psi = tree_samples(rows, key, columns, n_trees, subsample, seed)
    max_depth = max(1, math.ceil(math.log2(psi)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree_id"].iloc[0])
        nodes = grow_tree(pdf[columns].to_numpy(dtype=float), tree_id, seed, max_depth)
        out = pd.DataFrame(nodes, columns=["node_id", "feature", "threshold", "left", "right", "n", "depth"])
        out.insert(0, "tree_id", tree_id)
        out["psi"] = len(pdf)
        return out

    return sample.groupBy("tree_id").applyInPandas(build, TREES_SCHEMA)


# ---- score --------------------------------------------------------------------------------------------------------

def expected_depth(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    value = 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


class Forest:
    """The node table as arrays, to be sent to executors. At most ``n_trees × (2 × subsample − 1)`` nodes."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree_id", "node_id"])
        self.trees = [t.set_index("node_id") for _, t in nodes.groupby("tree_id")]
        self.psi = int(nodes["psi"].max())
        self.arrays = []
        for t in self.trees:
            leaf_value = t["depth"].to_numpy() + expected_depth(t["n"].to_numpy())
            self.arrays.append((t["feature"].to_numpy(np.int64), t["threshold"].to_numpy(float),
                                t["left"].to_numpy(np.int64), t["right"].to_numpy(np.int64), leaf_value,
                                int(t["depth"].max())))
        del self.trees

    @classmethod
    def collect(cls, trees: DataFrame) -> "Forest":
        return cls(trees.toPandas())

    def path_length(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of every row over the trees."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, right, value, depth in self.arrays:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes_left = x[rows, np.where(inner, f, 0)] <= threshold[at]
                at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            total += value[at]
        return total / len(self.arrays)


def path_length(forest: Forest, columns: list[str]) -> Column:
    """Mean path length of a row, evaluated on Arrow batches.

    Declared non-deterministic only so that a filter on the score is not pushed below it, which would run it twice.
    """
    @F.pandas_udf("double")
    def evaluate(x: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.path_length(x.to_numpy(dtype=float)))

    return evaluate.asNondeterministic()(F.struct(*[F.col(c).cast("double").alias(c) for c in columns]))


def score(rows: DataFrame, forest: Forest, columns: list[str]) -> DataFrame:
    """Add ``path_length``, ``score`` in (0, 1], ``prediction`` (1 inlier, −1 outlier) and the two masks."""
    norm = float(expected_depth(forest.psi)) or 1.0
    scored = rows.withColumn("path_length", path_length(forest, columns))
    return add_masks(scored.withColumn("score", F.pow(F.lit(2.0), -F.col("path_length") / norm)))


def add_masks(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    outlier = F.col("score") > threshold
    return scored.withColumns({"prediction": F.when(outlier, -1).otherwise(1), "is_inlier": ~outlier,
                               "is_outlier": outlier})


def inliers(scored: DataFrame, split: str | None = None) -> DataFrame:
    rows = scored.where("is_inlier")
    return rows.where(F.col("split") == split) if split else rows


def outliers(scored: DataFrame, split: str | None = None) -> DataFrame:
    rows = scored.where("is_outlier")
    return rows.where(F.col("split") == split) if split else rows


def label(scored: DataFrame) -> DataFrame:
    return scored.withColumn("labels", F.when(F.col("is_inlier"), INLIER_LABEL).otherwise(OUTLIER_LABEL))


def label_by_list(rows: DataFrame, inlier_keys: DataFrame, key: str) -> DataFrame:
    """Labels from a given list of inlier keys."""
    marks = inlier_keys.select(key).distinct().withColumn("_in", F.lit(True))
    return (rows.join(marks, key, "left")
            .withColumn("labels", F.when(F.col("_in"), INLIER_LABEL).otherwise(OUTLIER_LABEL)).drop("_in"))


def outlier_share(scored: DataFrame) -> DataFrame:
    """Share of outliers among all, train and test rows, in one aggregate."""
    return (scored.rollup("split").agg(F.avg(F.col("is_outlier").cast("double")).alias("prop_outliers"),
                                       F.count(F.lit(1)).alias("n_rows"))
            .withColumn("split", F.coalesce("split", F.lit("all"))))


def share_check(scored: DataFrame, atol: float = 0.01, rtol: float = 1e-5, strict: bool = False) -> DataFrame:
    """Are the outlier shares of test and train close? ``strict`` raises when they are not."""
    def share(split: str) -> Column:
        return F.avg(F.when(F.col("split") == split, F.col("is_outlier").cast("double")))

    test, train = F.col("test"), F.col("train")
    passed = F.abs(test - train) <= atol + rtol * F.abs(train)
    if strict:
        passed = F.when(passed, True).otherwise(F.raise_error(F.lit("outlier shares of test and train differ")))
    return (scored.agg(share("test").alias("test"), share("train").alias("train"))
            .select(F.lit("outlier_share").alias("check"), "test", "train", passed.alias("passed")))
