"""Why a row is unusual: Shapley attribution of the forest's path length, importance, standard scores, projection.

For one leaf, a row and a background row matter only through which of the leaf's conditions (one interval per feature
on its path) each satisfies. So the background is summarised once, exactly and without a cap, as counts of condition
patterns per leaf: a distributed aggregate whose size depends on the forest and not on the data. Attribution then is a
map over rows with table lookups.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.operators.iforest import Forest
from cohortqc.operators.reports import wide


class Leaf:
    """One leaf as a box: for each feature on its path an interval (low, high]."""

    __slots__ = ("features", "low", "high", "value")

    def __init__(self, conditions: dict[int, tuple[float, float]], value: float):
        self.features = np.array(sorted(conditions), dtype=np.int64)
        self.low = np.array([conditions[f][0] for f in self.features])
        self.high = np.array([conditions[f][1] for f in self.features])
        self.value = value

    def pattern(self, x: np.ndarray) -> np.ndarray:
        """Bit i is set when the row satisfies the interval of the leaf's i-th feature."""
        v = x[:, self.features]
        return ((v > self.low) & (v <= self.high)) @ (1 << np.arange(len(self.features), dtype=np.int64))


def leaves(forest: Forest) -> list[list[Leaf]]:
    """Leaves per tree; values are divided by the number of trees, so sums over leaves are means over trees."""
    out = []
    for feature, threshold, left, right, value, _ in forest.arrays:
        found: list[Leaf] = []
        stack = [(0, {})]
        while stack:
            at, box = stack.pop()
            f = int(feature[at])
            if f < 0:
                found.append(Leaf(box, value[at] / len(forest.arrays)))
                continue
            lo, hi = box.get(f, (-np.inf, np.inf))
            t = threshold[at]
            stack.append((int(right[at]), {**box, f: (max(lo, t), hi)}))
            stack.append((int(left[at]), {**box, f: (lo, min(hi, t))}))
        out.append(found)
    return out


@cache
def _weights(u: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapley weights [a, b] when a of the features come from the row and b from the background row."""
    gain, loss = np.zeros((u + 1, u + 1)), np.zeros((u + 1, u + 1))
    f = math.factorial
    for a in range(u + 1):
        for b in range(u + 1 - a):
            if a:
                gain[a, b] = f(a - 1) * f(b) / f(a + b)
            if b:
                loss[a, b] = -f(a) * f(b - 1) / f(a + b)
    return gain, loss


def _leaf_table(leaf: Leaf, own: np.ndarray, patterns: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """phi[i, feature] of one leaf for the row patterns ``own``, averaged over the background.

    A leaf is reachable by a mix of row and background row only if each of its conditions holds for one of them; then
    the features the background fails come from the row, and those the row fails from the background.
    """
    u = len(leaf.features)
    bits = np.arange(u)
    x_fails = (own[:, None] >> bits & 1) == 0
    z_fails = (patterns[:, None] >> bits & 1) == 0
    reachable = (own[:, None] | patterns[None, :]) == (1 << u) - 1
    gain, loss = _weights(u)
    a, b = z_fails.sum(axis=1)[None, :], x_fails.sum(axis=1)[:, None]
    w = np.where(reachable, shares[None, :], 0.0)
    from_row = (w * gain[a, b]) @ z_fails
    from_background = (w * loss[a, b]).sum(axis=1)[:, None] * x_fails
    return (from_row + from_background) * leaf.value


def background_patterns(background: DataFrame, forest: Forest, columns: list[str]) -> DataFrame:
    """``(tree, leaf, pattern, n)`` over all background rows. A task sends one row per leaf, its counts of all patterns
    packed into one value (at most 256 numbers); the packed counts of a leaf are added up."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        boxes = leaves(forest)
        tables = [[np.zeros(1 << len(leaf.features), dtype=np.int64) for leaf in tree] for tree in boxes]
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            for tree, counts in zip(boxes, tables):
                for leaf, c in zip(tree, counts):
                    c += np.bincount(leaf.pattern(x), minlength=len(c))
        for i, counts in enumerate(tables):
            rows = [(i, j, c.tobytes()) for j, c in enumerate(counts) if c.any()]
            yield pd.DataFrame(rows, columns=["tree", "leaf", "packed"])

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(packed, np.int64) for packed in pdf["packed"])
        found = np.flatnonzero(total)
        return pd.DataFrame({"tree": key[0], "leaf": key[1], "pattern": found, "n": total[found]})

    numbers = background.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return (numbers.mapInPandas(count, "tree int, leaf int, packed binary").groupBy("tree", "leaf")
            .applyInPandas(add, "tree int, leaf int, pattern int, n bigint"))


class Explainer:
    """Forest plus summarised background; its size is bounded by the forest."""

    def __init__(self, forest: Forest, patterns: pd.DataFrame):
        self.forest = forest
        self.patterns = {key: (g["pattern"].to_numpy(np.int64), g["n"].to_numpy(float))
                         for key, g in patterns.sort_values("pattern").groupby(["tree", "leaf"])}

    @classmethod
    def build(cls, forest: Forest, background: DataFrame, columns: list[str]) -> "Explainer":
        return cls(forest, background_patterns(background, forest, columns).toPandas())

    def __getstate__(self):
        return {"forest": self.forest, "patterns": self.patterns}  # leaves are rebuilt where they are needed

    @cached_property
    def leaves(self) -> list[tuple[Leaf, np.ndarray, np.ndarray]]:
        """Every leaf with its background patterns and their shares."""
        return [(leaf, self.patterns[(i, j)][0], self.patterns[(i, j)][1] / self.patterns[(i, j)][1].sum())
                for i, tree in enumerate(leaves(self.forest)) for j, leaf in enumerate(tree)]

    def expected_value(self) -> float:
        """Mean path length over the background."""
        return float(sum(leaf.value * shares[patterns == (1 << len(leaf.features)) - 1].sum()
                         for leaf, patterns, shares in self.leaves))

    def phi(self, x: np.ndarray) -> np.ndarray:
        """Attribution of every row; each pattern that occurs at a leaf is worked out once."""
        out = np.zeros(x.shape)
        for leaf, patterns, shares in self.leaves:
            own, which = np.unique(leaf.pattern(x), return_inverse=True)
            out[:, leaf.features] += _leaf_table(leaf, own, patterns, shares)[which]
        return out


def shap_long(rows: DataFrame, key: str, explainer: Explainer, columns: list[str], carry: tuple = ()) -> DataFrame:
    """``(key, feature, phi)`` for every row and feature; ``carry`` columns (split, is_inlier…) come along.

    For each row the phi add up to its path length minus the background's mean.
    """
    @F.pandas_udf("array<double>")
    def evaluate(x: pd.DataFrame) -> pd.Series:
        return pd.Series(list(explainer.phi(x.to_numpy(dtype=float))))

    phi = evaluate(F.struct(*[F.col(c).cast("double").alias(c) for c in columns]))
    names = F.array(*[F.lit(c) for c in columns])
    return (rows.select(key, *carry, F.posexplode(phi).alias("_i", "phi"))
            .select(key, *carry, F.get(names, F.col("_i")).alias("feature"), "phi"))


def shap_wide(long: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return wide(long, [key], "feature", "phi", columns)


def mean_abs_shap(long: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature; rank 1 is the most important. One row per feature remains, so the
    ranking is over a handful of rows."""
    means = long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
    return means.withColumn("rank", F.rank().over(W.orderBy(F.desc("mean_abs_shap"), "feature")))


def importance(long: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Importance of the features for the outliers, with display labels."""
    labels = F.create_map(*[F.lit(v) for pair in (names or schemas.FEATURE_LABELS).items() for v in pair])
    return (mean_abs_shap(long.where("is_outlier"))
            .withColumn("label", F.try_element_at(labels, F.col("feature"))))


# ---- standard scores and projection -------------------------------------------------------------------------------

def standard_scores(features: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / population deviation per column; a column without spread is only centred.

    Means and deviations are one row from one aggregate, used as a scalar subquery.
    """
    stats = features.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                                    for c in columns]).alias("v")).scalar()
    def scaled(c: str):
        s = stats[c]["s"]
        return ((F.col(c) - stats[c]["m"]) / F.when(s == 0, 1.0).otherwise(s)).alias(c)

    return features.select(*[scaled(c) if c in columns else F.col(c) for c in features.columns])


def project(scaled: DataFrame, columns: list[str], k: int = 2) -> DataFrame:
    """First principal components of standard scores as columns PC1, PC2, …; other columns, labels among them, stay.

    A component has no sign of its own: the first of its largest loadings is taken as positive.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    assembled = VectorAssembler(inputCols=columns, outputCol="_x").transform(scaled)
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(assembled)
    pcs = vector_to_array(F.col("_pc"))
    loadings = model.pc.toArray().T
    signs = [next(1.0 if v > 0 else -1.0 for v in row if abs(v) >= abs(row).max() * (1 - 1e-6)) for row in loadings]
    return model.transform(assembled).select(
        *[c for c in scaled.columns if c not in columns], *[(pcs[i] * signs[i]).alias(f"PC{i + 1}") for i in range(k)])
