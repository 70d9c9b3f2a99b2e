"""Forest invariants and attribution against brute force."""
import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.operators import explain as E
from cohortqc.operators import iforest as M
from cohortqc.plans import jobs

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(800, 4))
    x[:5] += 12
    pdf = pd.DataFrame(x, columns=COLUMNS)
    pdf.insert(0, "key", [f"k{i}" for i in range(len(pdf))])
    return spark.createDataFrame(pdf).repartition(7)


@pytest.fixture(scope="module")
def trees(cloud):
    return M.fit(cloud, "key", COLUMNS, n_trees=40).toPandas()


def test_tree_shape(trees):
    assert trees.tree_id.nunique() == 40
    assert (trees[trees.node_id == 0].n == 256).all() and trees.depth.max() <= 8
    inner = trees[trees.feature >= 0]
    by_node = trees.set_index(["tree_id", "node_id"])
    for row in inner.itertuples():
        left, right = by_node.loc[(row.tree_id, row.left)], by_node.loc[(row.tree_id, row.right)]
        assert left.n + right.n == row.n and left.n > 0 and right.n > 0 and left.depth == row.depth + 1


def test_fit_does_not_depend_on_partitions(cloud, trees):
    again = M.fit(cloud.repartition(2), "key", COLUMNS, n_trees=40).toPandas()
    key = ["tree_id", "node_id"]
    pd.testing.assert_frame_equal(trees.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True))
    other = M.fit(cloud, "key", COLUMNS, n_trees=40, seed=1).toPandas()
    assert not other.threshold.equals(trees.threshold)


def test_sample_is_the_lowest_draws(cloud):
    sample, psi = M.tree_samples(cloud, "key", COLUMNS, n_trees=5, subsample=50)
    got = {(r.tree_id, r._key) for r in sample.select("tree_id", "_key").collect()}
    draws = []
    for (k,) in cloud.select("key").collect():
        digest = hashlib.md5(f"{M.SEED}|{k}".encode()).hexdigest()
        a, b = int(digest[:12], 16), int(digest[12:24], 16)
        draws += [(t, k, (a + t * b) % M.DRAWS) for t in range(5)]
    want = {(t, k) for i in range(5) for t, k, _ in sorted((d for d in draws if d[0] == i), key=lambda d: d[2])[:50]}
    assert psi == 50 and got == want


def test_planted_outliers_rank_first(cloud, trees):
    scored = M.score(cloud, M.Forest(trees), COLUMNS)
    rows = scored.orderBy(F.desc("score")).collect()
    assert {r.key for r in rows[:5]} == {f"k{i}" for i in range(5)}
    assert all(0 < r.score <= 1 and r.is_outlier == (r.score > 0.5) and r.prediction == (-1 if r.is_outlier else 1)
               for r in rows)


def shapley(f, x, background):
    """Exact interventional Shapley values by subsets."""
    n = len(x)
    phi = np.zeros(n)
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for size in range(n):
            for s in itertools.combinations(rest, size):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                without = background.copy()
                without[:, list(s)] = x[list(s)]
                with_i = without.copy()
                with_i[:, i] = x[i]
                phi[i] += weight * (f(with_i).mean() - f(without).mean())
    return phi


def test_attribution_equals_brute_force(cloud, trees):
    forest = M.Forest(trees)
    background = cloud.where("b > 0.5")
    explainer = E.Explainer.build(forest, background, COLUMNS)
    z = background.select(*COLUMNS).toPandas().to_numpy()
    assert explainer.expected_value() == pytest.approx(forest.path_length(z).mean())
    rows = cloud.where("key IN ('k0', 'k3', 'k77', 'k500')")
    long = E.shap_long(rows, "key", explainer, COLUMNS).toPandas()
    for key, *x in rows.select("key", *COLUMNS).collect():
        got = long[long.key == key].set_index("feature").phi.loc[COLUMNS].to_numpy()
        x = np.array(x)
        np.testing.assert_allclose(got, shapley(forest.path_length, x, z), atol=1e-9)
        assert got.sum() + explainer.expected_value() == pytest.approx(forest.path_length(x[None])[0])


def test_constant_columns_make_one_leaf(spark):
    rows = spark.createDataFrame([(str(i), 1.0) for i in range(20)], "key string, a double")
    trees = M.fit(rows, "key", ["a"], n_trees=3)
    assert trees.count() == 3 and trees.where("feature >= 0").count() == 0


def test_nulls(spark):
    rows = spark.createDataFrame([("x", 1.0, None), ("y", 2.0, 4.0)], "key string, a double, b double")
    with pytest.raises(ValueError, match="b"):
        M.handle_nulls(rows, ["a", "b"])
    assert M.handle_nulls(rows, ["a", "b"], "drop").count() == 1
    assert M.handle_nulls(rows, ["a", "b"], "median").where("key = 'x'").first().b == 4.0
    with pytest.raises(ValueError):
        M.handle_nulls(rows, ["a"], "other")


def test_share_check(spark):
    rows = spark.createDataFrame([("test", i < 5) for i in range(100)] + [("train", i < 6) for i in range(100)],
                                 "split string, is_outlier boolean")
    assert M.share_check(rows).first().passed
    worse = rows.union(spark.createDataFrame([("test", True)] * 3, rows.schema))
    assert not M.share_check(worse).first().passed
    with pytest.raises(Exception, match="differ"):
        M.share_check(worse, strict=True).collect()


def test_standard_scores_without_spread(spark):
    rows = spark.createDataFrame([("x", 1.0, 5.0), ("y", 3.0, 5.0)], "key string, a double, b double")
    assert [tuple(r) for r in E.standard_scores(rows, ["a", "b"]).orderBy("key").collect()] == [
        ("x", -1.0, 0.0), ("y", 1.0, 0.0)]


def test_detect(spark, tmp_path):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(300, 21)), columns=schemas.FEATURES)
    pdf.insert(0, "srx", [f"e{i}" for i in range(300)])
    # one row far off on each side of the split
    tested = next(k for k in pdf["srx"] if hashlib.md5(f"{k}{M.SEED}".encode()).hexdigest()[:2] >= "c0")
    pdf.loc[pdf["srx"].isin(["e0", tested]), schemas.FEATURES] += 30
    found = jobs.detect(spark.createDataFrame(pdf), "srx", str(tmp_path), n_trees=25)
    labels = {r.srx: r.labels for r in found.result.collect()}
    assert labels["e0"] == labels[tested] == "Outlier" and set(labels.values()) <= {"Inliers", "Outlier"} and len(labels) == 300
    csv = spark.read.option("header", True).csv(str(tmp_path / "result.csv"))
    assert csv.columns == ["srx", *schemas.FEATURES, "labels"] and csv.count() == 300
    sums = {r.srx: r.total for r in found.shap.groupBy("srx").agg(F.sum("phi").alias("total")).collect()}
    for r in found.scored.where("split = 'test'").collect():
        assert sums[r.srx] + found.expected_value == pytest.approx(r.path_length)
    ranked = found.importance.orderBy("rank").collect()
    assert len(ranked) == 21 and ranked[0].label in schemas.FEATURE_LABELS.values()
    assert [r.mean_abs_shap for r in ranked] == sorted((r.mean_abs_shap for r in ranked), reverse=True)
    again = jobs.detect(spark.createDataFrame(pdf).repartition(5), "srx", n_trees=25)
    assert {r.srx: r.labels for r in again.result.collect()} == labels
