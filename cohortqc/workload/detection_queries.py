"""Isolation forest, attribution, standard scores and projection."""
from __future__ import annotations

import math
from functools import cache

import pandas as pd
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.operators import explain as E
from cohortqc.operators import iforest as M
from cohortqc.plans import jobs
from cohortqc.session import shared_folder
from cohortqc.workload import cohort_queries as Q
from cohortqc.workload.cohort_queries import _feature_sql
from cohortqc.workload.registry import query, rounded
from cohortqc.workload.views import ctes, load

# ---- a forest of three small trees over two columns, for scores that SQL can follow -----------------------------------
# (tree, node, feature, threshold, left, right, rows, depth); feature 0 is the balance, 1 the nation; −1 is a leaf
_NODES = [
    (0, 0, 0, -500.0, 1, 2, 256, 0), (0, 1, -1, math.nan, -1, -1, 6, 1), (0, 2, 0, 9000.0, 3, 4, 250, 1),
    (0, 3, 1, 1.5, 5, 6, 220, 2), (0, 4, -1, math.nan, -1, -1, 30, 2), (0, 5, -1, math.nan, -1, -1, 20, 3),
    (0, 6, -1, math.nan, -1, -1, 200, 3),
    (1, 0, 1, 22.5, 1, 2, 256, 0), (1, 1, 0, 0.0, 3, 4, 240, 1), (1, 2, -1, math.nan, -1, -1, 16, 1),
    (1, 3, -1, math.nan, -1, -1, 2, 2), (1, 4, -1, math.nan, -1, -1, 238, 2),
    (2, 0, 1, 0.5, 1, 2, 256, 0), (2, 1, -1, math.nan, -1, -1, 1, 1), (2, 2, -1, math.nan, -1, -1, 255, 1),
]
_COLUMNS = ["balance", "nation"]


def _forest() -> M.Forest:
    nodes = pd.DataFrame(_NODES, columns=["tree_id", "node_id", "feature", "threshold", "left", "right", "n", "depth"])
    return M.Forest(nodes.assign(psi=256))


def _customers(spark, sf):
    return load(spark, sf, "balances_v")


def _c(n: int) -> str:
    if n <= 1:
        return "0"
    if n == 2:
        return "1"
    return f"(2 * (ln({n - 1}) + 0.57721566490153286) - 2 * {n - 1}.0 / {n})"


def _path(b: str, n: str) -> str:
    """Mean path length of the three trees as CASE expressions."""
    return f"""((CASE WHEN {b} <= -500 THEN 1 + {_c(6)} WHEN {b} > 9000 THEN 2 + {_c(30)}
        WHEN {n} <= 1.5 THEN 3 + {_c(20)} ELSE 3 + {_c(200)} END)
      + (CASE WHEN {n} > 22.5 THEN 1 + {_c(16)} WHEN {b} <= 0 THEN 2 + {_c(2)} ELSE 2 + {_c(238)} END)
      + (CASE WHEN {n} <= 0.5 THEN 1 + {_c(1)} ELSE 1 + {_c(255)} END)) / 3"""


_SCORED = f"""WITH {ctes('balances_v')}, scored AS (
    SELECT *, {_path('balance', 'nation')} AS path_length,
      CASE WHEN substr(md5(srr || '42'), 1, 2) < 'c0' THEN 'train' ELSE 'test' END AS split FROM balances_v),
    marked AS (SELECT *, pow(2, -path_length / {_c(256)}) AS score, pow(2, -path_length / {_c(256)}) > 0.5 AS is_outlier
               FROM scored)"""


def _scored(spark, sf):
    return M.score(M.split_rows(_customers(spark, sf), "srr"), _forest(), _COLUMNS)


@query("split_rows", f"{_SCORED} SELECT srr, split FROM scored")
def split_rows(spark, sf):
    return M.split_rows(_customers(spark, sf), "srr").select("srr", "split")


@query("forest_score_fixed", f"""{_SCORED} SELECT srr, round(path_length, 6) AS path_length, round(score, 6) AS score,
    CASE WHEN is_outlier THEN -1 ELSE 1 END AS prediction, NOT is_outlier AS is_inlier, is_outlier FROM marked""")
def forest_score_fixed(spark, sf):
    return rounded(_scored(spark, sf).select("srr", "path_length", "score", "prediction", "is_inlier", "is_outlier"))


@query("forest_inliers", f"{_SCORED} SELECT srr, split FROM marked WHERE NOT is_outlier AND split = 'test'")
def forest_inliers(spark, sf):
    return M.inliers(_scored(spark, sf), "test").select("srr", "split")


@query("forest_outliers", f"{_SCORED} SELECT srr, split FROM marked WHERE is_outlier")
def forest_outliers(spark, sf):
    return M.outliers(_scored(spark, sf)).select("srr", "split")


@query("forest_label_fixed", f"""{_SCORED} SELECT srr, CASE WHEN is_outlier THEN 'Outlier' ELSE 'Inliers' END AS labels
    FROM marked""")
def forest_label_fixed(spark, sf):
    return M.label(_scored(spark, sf)).select("srr", "labels")


@query("label_by_list", f"""WITH {ctes('manifest_v', 'done_v')} SELECT srr, CASE WHEN srr IN (SELECT srr FROM done_v)
    THEN 'Inliers' ELSE 'Outlier' END AS labels FROM manifest_v""")
def label_by_list(spark, sf):
    return M.label_by_list(load(spark, sf, "manifest_v"), load(spark, sf, "done_v"), "srr").select("srr", "labels")


@query("label_filter", f"{_SCORED} SELECT srr FROM marked WHERE is_outlier")
def label_filter(spark, sf):
    return M.label(_scored(spark, sf)).where(F.col("labels") == M.OUTLIER_LABEL).select("srr")


@query("outlier_share", f"""{_SCORED} SELECT coalesce(split, 'all') AS split, round(avg(is_outlier::INT), 6) AS prop_outliers,
    count(*) AS n_rows FROM marked GROUP BY ROLLUP (split)""")
def outlier_share(spark, sf):
    return rounded(M.outlier_share(_scored(spark, sf)))


@query("forest_check", f"""{_SCORED}, s AS (SELECT avg(is_outlier::INT) FILTER (split = 'test') AS test,
    avg(is_outlier::INT) FILTER (split = 'train') AS train FROM marked)
    SELECT 'outlier_share' AS "check", round(test, 6) AS test, round(train, 6) AS train,
      abs(test - train) <= 0.01 + 0.00001 * abs(train) AS passed FROM s""")
def forest_check(spark, sf):
    return rounded(M.share_check(_scored(spark, sf)))


_SHAP = f"""{_SCORED}, rows AS (SELECT * FROM marked WHERE split = 'test'),
    bg AS (SELECT balance AS zb, nation AS zn FROM rows WHERE NOT is_outlier),
    pairs AS (SELECT srr, is_outlier, {_path('balance', 'nation')} AS xx, {_path('zb', 'nation')} AS zx,
                {_path('balance', 'zn')} AS xz, {_path('zb', 'zn')} AS zz FROM rows CROSS JOIN bg),
    phis AS (SELECT srr, is_outlier, avg((xx - zx + xz - zz) / 2) AS balance, avg((xx - xz + zx - zz) / 2) AS nation,
               avg(xx - zz) AS total FROM pairs GROUP BY srr, is_outlier),
    long AS (SELECT srr, is_outlier, 'balance' AS feature, balance AS phi FROM phis
             UNION ALL SELECT srr, is_outlier, 'nation', nation FROM phis)"""


def _shap(spark, sf):
    test = _scored(spark, sf).where("split = 'test'")
    forest = _forest()
    explainer = E.Explainer.build(forest, M.inliers(test), _COLUMNS)
    return E.shap_long(test, "srr", explainer, _COLUMNS, carry=("is_inlier", "is_outlier")), explainer


@query("shap_fixed", f"{_SHAP} SELECT srr, feature, round(phi, 6) + 0.0 AS phi FROM long")
def shap_fixed(spark, sf):
    return rounded(_shap(spark, sf)[0].select("srr", "feature", "phi"))


@query("shap_wide", f"""{_SHAP} SELECT srr, round(balance, 6) + 0.0 AS balance, round(nation, 6) + 0.0 AS nation
    FROM phis""")
def shap_wide(spark, sf):
    return rounded(E.shap_wide(_shap(spark, sf)[0], "srr", _COLUMNS))


@query("shap_of_outliers", f"""{_SHAP} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_shap,
    rank() OVER (ORDER BY avg(abs(phi)) DESC, feature)::INTEGER AS rank FROM long WHERE is_outlier GROUP BY feature""")
def shap_of_outliers(spark, sf):
    return rounded(E.mean_abs_shap(_shap(spark, sf)[0].where("is_outlier")))


@query("shap_of_inliers", f"""{_SHAP} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_shap,
    rank() OVER (ORDER BY avg(abs(phi)) DESC, feature)::INTEGER AS rank FROM long WHERE NOT is_outlier GROUP BY feature""")
def shap_of_inliers(spark, sf):
    return rounded(E.mean_abs_shap(_shap(spark, sf)[0].where("is_inlier")))


_LABELS = {"balance": "Balance of the account", "nation": "Nation"}


@query("importance_fixed", f"""{_SHAP} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_shap,
    rank() OVER (ORDER BY avg(abs(phi)) DESC, feature)::INTEGER AS rank,
    CASE feature WHEN 'balance' THEN '{_LABELS["balance"]}' ELSE '{_LABELS["nation"]}' END AS label
    FROM long WHERE is_outlier GROUP BY feature""")
def importance_fixed(spark, sf):
    return rounded(E.importance(_shap(spark, sf)[0], _LABELS))


@query("expected_value", f"""{_SHAP} SELECT round(avg(xx), 6) AS expected_value FROM (
    SELECT {_path('zb', 'zn')} AS xx FROM bg) t""")
def expected_value(spark, sf):
    test = _scored(spark, sf).where("split = 'test'")
    return rounded(M.inliers(test).agg(F.avg("path_length").alias("expected_value")))


@query("standard_scores", f"""WITH {ctes('balances_v')}, s AS (SELECT avg(balance) AS mb, stddev_pop(balance) AS sb,
    avg(nation) AS mn, stddev_pop(nation) AS sn FROM balances_v)
    SELECT srr, round((balance - mb) / sb, 6) + 0.0 AS balance, round((nation - mn) / sn, 6) + 0.0 AS nation
    FROM balances_v, s""")
def standard_scores(spark, sf):
    return rounded(E.standard_scores(_customers(spark, sf), _COLUMNS))


# of two standard scores the components are their sum and difference over the root of two, the larger variance first
@query("projection_fixed", f"""{_SCORED}, s AS (SELECT avg(balance) AS mb, stddev_pop(balance) AS sb, avg(nation) AS mn,
      stddev_pop(nation) AS sn, corr(balance, nation) AS r FROM marked),
    z AS (SELECT srr, is_outlier, r, (balance - mb) / sb AS x, (nation - mn) / sn AS y FROM marked, s)
    SELECT srr, CASE WHEN is_outlier THEN 'Outlier' ELSE 'Inliers' END AS labels,
      round((x + sign(r) * y) / sqrt(2), 6) + 0.0 AS "PC1", round((x - sign(r) * y) / sqrt(2), 6) + 0.0 AS "PC2" FROM z""")
def projection_fixed(spark, sf):
    labelled = M.label(_scored(spark, sf)).select("srr", *_COLUMNS, "labels")
    return rounded(E.project(E.standard_scores(labelled, _COLUMNS), _COLUMNS))


# ---- the whole chain on the feature matrix --------------------------------------------------------------------------
# SQL grows the same forest level by level from the same digests: a sample per tree, then per level the spread of every
# node, its split, and the rows of the next level. Nodes are numbered as in a heap.

_FEATURES = schemas.FEATURES
_DEPTH = round(math.log2(M.SUBSAMPLE))


def _hex(text: str, start: int, digits: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {start}, {digits}) AS BIGINT)"


def _C(n: str) -> str:
    """Mean depth of an unsuccessful search among n rows."""
    return (f"(CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln(greatest({n}, 2) - 1) + 0.57721566490153286) "
            f"- 2 * ({n} - 1) / CAST({n} AS DOUBLE) END)")


@cache
def _forest_sql(nulls: str) -> str:
    """CTEs: ``f`` the matrix, ``nodes`` the forest, ``marked`` the rows with path length, score, split and mask. Medians
    are filled into the matrix with gaps."""
    filled = [f"coalesce({c}, (SELECT median({c}) FROM matrix)) AS {c}" if nulls == "median" else c for c in _FEATURES]
    whole = "" if nulls == "median" else " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _FEATURES)
    place = f"'{M.SEED}|' || tree || '|' || node"
    out = [f"""matrix AS MATERIALIZED ({_feature_sql(group=False, gaps=nulls == 'median')}),
    f AS MATERIALIZED (SELECT *, [{', '.join(_FEATURES)}] AS x,
        CASE WHEN substr(md5(srr || '{M.SEED}'), 1, 2) < 'c0' THEN 'train' ELSE 'test' END AS split
      FROM (SELECT srr, {', '.join(filled)} FROM matrix{whole}) m),
    size AS (SELECT least({M.SUBSAMPLE}, count(*)) AS psi FROM f WHERE split = 'train'),
    drawn AS (SELECT srr, tree, row_number() OVER (PARTITION BY tree ORDER BY (a + tree * b) % {M.DRAWS}, srr) AS rn
      FROM (SELECT srr, {_hex(f"'{M.SEED}|' || srr", 1, 12)} AS a, {_hex(f"'{M.SEED}|' || srr", 13, 12)} AS b
            FROM f WHERE split = 'train') d CROSS JOIN (SELECT unnest(range({M.N_TREES})) AS tree) t),
    long AS MATERIALIZED (SELECT srr, unnest(x) AS v, unnest(range({len(_FEATURES)})) AS j FROM f),
    rows0 AS MATERIALIZED (SELECT srr, tree, CAST(1 AS BIGINT) AS node FROM drawn, size WHERE rn <= psi)"""]
    for d in range(_DEPTH + 1):
        splits = f"n > 1 AND len(us) > 0 AND {d} < ceil(log2(psi))"
        out.append(f"""
    nodes{d} AS MATERIALIZED (
      SELECT tree, node, n, depth, feature, CASE WHEN drawn < hi THEN drawn ELSE lo END AS threshold FROM (
        SELECT *, lo + CAST({_hex(place, 13, 13)} AS DOUBLE) / {2 ** 52}.0::DOUBLE * (hi - lo) AS drawn FROM (
          SELECT *, lows[feature + 1] AS lo, highs[feature + 1] AS hi FROM (
            SELECT *, CASE WHEN {splits} THEN us[{_hex(place, 1, 12)} % greatest(len(us), 1) + 1] ELSE -1 END AS feature
            FROM (SELECT tree, node, max(n) AS n, {d} AS depth, list(lo ORDER BY j) AS lows, list(hi ORDER BY j) AS highs,
                    coalesce(list(j ORDER BY j) FILTER (hi > lo), []) AS us
                  FROM (SELECT tree, node, j, min(v) AS lo, max(v) AS hi, count(*) AS n
                        FROM rows{d} JOIN long USING (srr) GROUP BY tree, node, j) s GROUP BY tree, node) g, size) c) e) h),
    rows{d + 1} AS MATERIALIZED (
      SELECT r.srr, r.tree, r.node * 2 + CAST(f.x[n.feature + 1] > n.threshold AS BIGINT) AS node
      FROM rows{d} r JOIN nodes{d} n ON r.tree = n.tree AND r.node = n.node JOIN f ON f.srr = r.srr WHERE n.feature >= 0)""")
    out.append(f"""
    nodes AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM nodes{d}' for d in range(_DEPTH + 1))}),
    walk AS (SELECT srr, tree, CAST(1 AS BIGINT) AS node FROM f CROSS JOIN (SELECT unnest(range({M.N_TREES})) AS tree) t
      UNION ALL SELECT w.srr, w.tree, w.node * 2 + CAST(f.x[n.feature + 1] > n.threshold AS BIGINT)
      FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node JOIN f ON f.srr = w.srr WHERE n.feature >= 0),
    leafs AS MATERIALIZED (SELECT *, depth + {_C('n')} AS value FROM nodes WHERE feature < 0),
    marked AS MATERIALIZED (SELECT f.*, path_length, pow(2, -path_length / {_C('psi')}) > 0.5 AS is_outlier
      FROM f, size, (SELECT srr, sum(value) / {M.N_TREES} AS path_length
                     FROM walk JOIN leafs USING (tree, node) GROUP BY srr) p WHERE p.srr = f.srr)""")
    return "WITH RECURSIVE " + ",".join(out)


def _shap_sql() -> str:
    """Exact attribution of the test rows. A leaf is a box of one interval per feature on its path; which of them a row
    meets is a bit mask, and only pairs of masks that occur at a leaf are worked out."""
    full = "(1 << u) - 1"
    return _forest_sql("drop") + f""",
    steps AS (SELECT l.tree, l.node, a.feature, a.threshold, (l.node >> (i - 1)) & 1 = 1 AS goes_right
      FROM (SELECT *, unnest(range(1, {_DEPTH + 1})) AS i FROM leafs) l JOIN nodes a ON a.tree = l.tree AND a.node = l.node >> i),
    boxes AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY feature) - 1 AS bit,
        count(*) OVER (PARTITION BY tree, node) AS u
      FROM (SELECT tree, node, feature, coalesce(max(threshold) FILTER (goes_right), '-inf'::DOUBLE) AS lo,
              coalesce(min(threshold) FILTER (NOT goes_right), 'inf'::DOUBLE) AS hi FROM steps GROUP BY tree, node, feature) b),
    masks AS MATERIALIZED (SELECT srr, is_outlier, tree, node, max(u) AS u,
        CAST(sum(CASE WHEN x[feature + 1] > lo AND x[feature + 1] <= hi THEN 1 << bit ELSE 0 END) AS BIGINT) AS mask
      FROM marked CROSS JOIN boxes WHERE split = 'test' GROUP BY srr, is_outlier, tree, node),
    ground AS (SELECT tree, node, mask AS zm, count(*) / (SELECT count(*) FROM marked WHERE split = 'test' AND NOT is_outlier)
        AS share FROM masks WHERE NOT is_outlier GROUP BY tree, node, mask),
    pairs AS (SELECT o.tree, o.node, o.mask, zm, share, bit_count(({full}) - zm) AS a, bit_count(({full}) - mask) AS b
      FROM (SELECT DISTINCT tree, node, mask, u FROM masks) o JOIN ground g ON g.tree = o.tree AND g.node = o.node
      WHERE mask | zm = {full}),
    gains AS MATERIALIZED (SELECT tree, node, mask, feature, sum(share * CASE
        WHEN (zm >> bit) & 1 = 0 THEN factorial(a - 1) * factorial(b) / factorial(a + b)::DOUBLE
        WHEN (mask >> bit) & 1 = 0 THEN -factorial(a) * factorial(b - 1) / factorial(a + b)::DOUBLE ELSE 0 END) AS gain
      FROM pairs JOIN boxes USING (tree, node) WHERE ((zm & mask) >> bit) & 1 = 0 GROUP BY tree, node, mask, feature),
    found AS (SELECT srr, gains.feature, sum(gain * value) / {M.N_TREES} AS phi
      FROM masks JOIN gains USING (tree, node, mask) JOIN leafs USING (tree, node) GROUP BY srr, gains.feature),
    phis AS MATERIALIZED (SELECT m.srr, m.is_outlier, j, [{', '.join(f"'{c}'" for c in _FEATURES)}][j + 1] AS name,
        coalesce(phi, 0) AS phi
      FROM (SELECT *, unnest(range({len(_FEATURES)})) AS j FROM marked WHERE split = 'test') m
      LEFT JOIN found p ON p.srr = m.srr AND p.feature = j)"""


def _projection_sql() -> str:
    """The two first components: the covariance of the standard scores squared again and again leaves the first one; with
    that taken out, the second."""
    out = [_forest_sql("drop") + f""",
    z AS MATERIALIZED (SELECT srr, j, (v - avg(v) OVER w) / CASE WHEN stddev_pop(v) OVER w = 0 THEN 1 ELSE stddev_pop(v) OVER w END AS z
      FROM long WINDOW w AS (PARTITION BY j)),
    a0 AS MATERIALIZED (SELECT a.j AS i, b.j AS j, avg(a.z * b.z) AS v FROM z a JOIN z b USING (srr) GROUP BY a.j, b.j)"""]
    for k in (1, 2):
        start = f"a{k - 1}"
        for step in range(1, 15):
            last = start if step == 1 else f"s{k}_{step - 1}"
            out.append(f"""
    s{k}_{step} AS MATERIALIZED (SELECT i, j, v / max(abs(v)) OVER () AS v FROM (
      SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j) p)""")
        out.append(f"""
    c{k} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS v FROM s{k}_14
      WHERE j = (SELECT i FROM s{k}_14 WHERE i = j ORDER BY v DESC, i LIMIT 1)),
    w{k} AS MATERIALIZED (SELECT i, v * (SELECT sign(c.v) FROM c{k} c WHERE abs(c.v) >= (SELECT max(abs(v)) FROM c{k}) * (1 - 1e-6)
      ORDER BY c.i LIMIT 1) AS v FROM c{k}),
    e{k} AS MATERIALIZED (SELECT sum(a.v * x.v * y.v) AS e FROM a{k - 1} a JOIN w{k} x ON x.i = a.i JOIN w{k} y ON y.i = a.j),
    a{k} AS MATERIALIZED (SELECT a.i, a.j, a.v - e * x.v * y.v AS v FROM a{k - 1} a JOIN w{k} x ON x.i = a.i JOIN w{k} y ON y.i = a.j, e{k})""")
    return ",".join(out)


def _matrix(spark, sf, gaps: bool = False):
    """Run features to six digits, so that two engines grow the forest on the same numbers; written once: fitting and
    scoring read them several times."""
    path = shared_folder(spark, "features")
    rounded(Q.X.run_features(Q.workflow(spark, sf, gaps))).write.parquet(path)
    return spark.read.parquet(path)


@query("forest_labels", f"""{_forest_sql('median')} SELECT srr, {', '.join(f'round({c}, 6) AS {c}' for c in _FEATURES)},
    CASE WHEN is_outlier THEN '{M.OUTLIER_LABEL}' ELSE '{M.INLIER_LABEL}' END AS labels FROM marked""")
def forest_labels(spark, sf):
    return rounded(jobs.detect(_matrix(spark, sf, gaps=True), "srr", nulls="median").result)


@query("forest_nodes", f"""{_forest_sql('median')} SELECT CAST(tree AS INTEGER) AS tree_id,
    CAST(row_number() OVER w - 1 AS INTEGER) AS node_id, CAST(feature AS INTEGER) AS feature, round(threshold, 6) AS threshold,
    CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * sum((feature >= 0)::INT) OVER w - 1 END AS INTEGER) AS "left",
    CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * sum((feature >= 0)::INT) OVER w END AS INTEGER) AS "right", n, depth,
    CAST((SELECT psi FROM size) AS INTEGER) AS psi FROM nodes WINDOW w AS (PARTITION BY tree ORDER BY node)""")
def forest_nodes(spark, sf):
    """The fitted forest itself."""
    columns = list(_FEATURES)
    rows = M.split_rows(M.handle_nulls(_matrix(spark, sf, gaps=True), columns, "median"), "srr")
    return rounded(M.fit(rows.where("split = 'train'"), "srr", columns))


_LABEL_CASES = " ".join("WHEN '{}' THEN '{}'".format(c, label.replace("'", "''")) for c, label in schemas.FEATURE_LABELS.items())


@query("importance", f"""{_shap_sql()} SELECT name AS feature, round(avg(abs(phi)), 6) AS mean_abs_shap,
    CAST(rank() OVER (ORDER BY avg(abs(phi)) DESC, name) AS INTEGER) AS rank,
    CASE name {_LABEL_CASES} END AS label
    FROM phis WHERE is_outlier GROUP BY name""")
def importance(spark, sf):
    return rounded(jobs.detect(_matrix(spark, sf), "srr", nulls="drop").importance)


@query("shap_long", f"{_shap_sql()} SELECT srr, NOT is_outlier AS is_inlier, is_outlier, name AS feature, round(phi, 6) + 0.0 AS phi FROM phis")
def shap_long(spark, sf):
    return rounded(jobs.detect(_matrix(spark, sf), "srr", nulls="drop").shap)


@query("forest_expected_value", f"""{_forest_sql('drop')} SELECT round(avg(path_length), 6) AS expected_value FROM marked
    WHERE split = 'test' AND NOT is_outlier""")
def forest_expected_value(spark, sf):
    """The explainer's own mean over its summarised background."""
    value = jobs.detect(_matrix(spark, sf), "srr", nulls="drop").expected_value
    return rounded(spark.range(1).select(F.lit(value).alias("expected_value")))


@query("pca_projection", f"""{_projection_sql()} SELECT m.srr,
    CASE WHEN is_outlier THEN '{M.OUTLIER_LABEL}' ELSE '{M.INLIER_LABEL}' END AS labels,
    round(sum(z * w1.v), 6) + 0.0 AS "PC1", round(sum(z * w2.v), 6) + 0.0 AS "PC2"
    FROM z JOIN marked m ON m.srr = z.srr JOIN w1 ON w1.i = z.j JOIN w2 ON w2.i = z.j GROUP BY m.srr, is_outlier""")
def pca_projection(spark, sf):
    labelled = jobs.detect(_matrix(spark, sf), "srr", nulls="drop").result
    return rounded(E.project(E.standard_scores(labelled, schemas.FEATURES), schemas.FEATURES))
