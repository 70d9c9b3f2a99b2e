"""Quality rules: minimum-covariance-determinant outliers per language and source, with DataFrame functions only.

Each text gives a vector of four transformed statistics. Per group (language and source; the language alone where that
has too few rows) the three quarters of the rows whose covariance has the least determinant are sought: from the medians
and from ``STARTS`` small subsets drawn by hash, ``SCREEN_STEPS`` concentration steps each; the start of the least
determinant then goes on until no step lowers it. A row is rejected where its squared Mahalanobis distance exceeds a fixed
quantile.

Every step is one aggregate over a written table of features, for all groups and starts at once. Order statistics come
from histograms on a fixed grid, rows of the bin on the border count by the share that is still wanted, so a group may hold
any share of all rows: it reaches a reducer as one row per bin and task. Drawn rows are those below a hash threshold, about
``DRAWN`` a group.

Defined results: a null text counts as no words and fails the base rule. Null languages and sources are groups of
their own. Groups without ``MIN_ROWS`` rows in source and language have no estimate: the base rule alone decides.
Repeated rows count once each and get the same verdict. An empty table gives an empty result.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortqc.llm.common import SPACE_RUN, SPACES, whole, written
from cohortqc.session import BROADCAST_ROWS

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

FEATURES = ["word_length", "symbols", "dup_lines", "repeats"]
# No feature counts as less spread than this: most clean texts have no symbol, copied line or repeated window at all.
FLOORS = {"word_length": 0.05, "symbols": 0.05, "dup_lines": 0.25, "repeats": 0.25}
MIN_ROWS = 50
CORE = 0.75
STARTS, START_ROWS, SCREEN_STEPS, DRAWN = 8, 6, 2, 400
# a step that lowers the log determinant by no more than this has settled
SETTLED = 1e-4
# Fixed values of the chi-square law with four degrees of freedom: CORE / P(chi2_6 <= its 0.75 quantile 5.385), and
# the quantile of 1 - 1e-5.
CONSISTENCY, CUTOFF = 1.486, 28.47
# Grids of the order statistics: features, and log distances.
FEATURE_GRID, DISTANCE_GRID = 0.005, 0.01


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row; a lambda would compute an expression for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice.

    Each window becomes one long: its hash above, its place below, with just as many low bits as places need. Sorted,
    equal windows are neighbours. (At 600 words 54 bits of hash remain.) Neighbours of one hash count once their words agree.
    """
    def covered(w):
        bits = F.length(F.bin(F.size(w))).cast("int")

        def keyed(b):
            return F.transform(
                F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                lambda x, i: F.call_function("shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), b)
                .bitwiseOR(i.cast("bigint")))

        def count(b):
            hashed = lambda x: F.call_function("shiftright", x, b)
            mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), b) - 1

            def same(x, y):
                word = lambda v, k: F.get(w, v.bitwiseAND(mask).cast("int") + k)
                return ((hashed(x) == hashed(y)) & (word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1))
                        & (word(x, 2) == word(y, 2)))

            found = _let(F.sort_array(keyed(b)), lambda s: F.filter(
                s, lambda x, i: ((i > 0) & same(x, F.get(s, i - 1))) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))))
            places = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask)))
            start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("last"))
            return F.aggregate(places, start, lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(3).cast("bigint"), x - a["last"])).alias("n"), x.alias("last")))["n"]

        return _let(bits, count)
    return _let(words, covered)


def counts(text: Column) -> dict[str, Column]:
    """The base counts of one text."""
    text = whole(text)
    words = F.filter(F.split(text, SPACE_RUN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": _repeat_words(words),
        "n_lines": _let(lines, F.size).cast("bigint"),
    }


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _features() -> dict[str, Column]:
    """Transformed statistics; shares take the arc sine of their root, which evens out their spread."""
    share = lambda part, of: F.asin(F.sqrt(F.least(
        F.col(part) / F.greatest(F.col(of), F.lit(1)), F.lit(1.0))))
    return {
        "word_length": F.log(F.greatest(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(1.0))),
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def _measured(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """Counts, base verdict, features and group keys of every row."""
    found = docs.select(*keep, F.coalesce("lang", F.lit("")).alias("q_lang"),
                        F.coalesce("source", F.lit("")).alias("q_source"),
                        F.col("lang").isNull().alias("q_lang_null"), F.col("source").isNull().alias("q_source_null"),
                        *[c.alias(n) for n, c in counts(F.col("text")).items()])
    return found.select("*", _base_failed().alias("base_failed"),
                        *[c.alias(f"x_{n}") for n, c in _features().items()])


KEYS = ["q_lang", "q_lang_null", "q_source", "q_source_null"]


def _groups(rows: DataFrame) -> DataFrame:
    """Per language and source the group whose estimate applies: its own, its language's, or none."""
    own = rows.groupBy(*KEYS).agg(F.count("*").alias("n_own"))
    by_lang = own.groupBy(*KEYS[:2]).agg(F.sum("n_own").alias("n_lang"))
    return own.join(by_lang, KEYS[:2]).select(
        *KEYS, F.when(F.col("n_own") >= MIN_ROWS, F.concat_ws("\x01", F.lit("s"), *KEYS))
        .when(F.col("n_lang") >= MIN_ROWS, F.concat_ws("\x01", F.lit("l"), *KEYS[:2])).alias("grp"))


def _fitted_rows(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows each group's estimate comes from; a language's estimate takes all its rows."""
    wanted = (groups.where("grp IS NOT NULL").select("grp", *KEYS[:2]).distinct()
              .select(*[F.col(k).alias(f"g_{k}") for k in KEYS[:2]], "grp",
                      F.col("grp").startswith("l").alias("g_lang_only")))
    by_source = rows.join(groups.where(F.col("grp").startswith("s")).select(*KEYS, "grp"), KEYS)
    by_lang = rows.join(wanted.where("g_lang_only"), (F.col("q_lang") == F.col("g_q_lang"))
                        & (F.col("q_lang_null") == F.col("g_q_lang_null")))
    xs = [f"x_{f}" for f in FEATURES]
    draw = F.xxhash64("doc_id", *xs).bitwiseAND(F.lit((1 << 63) - 1)).alias("draw")
    return by_source.select("grp", *xs, draw).unionByName(by_lang.select("grp", *xs, draw))


def _start(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Start 0: median and quartile range of every feature."""
    long = rows.select("grp", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.floor(F.col(f"x_{f}") / FEATURE_GRID).alias("bin"))
        for f in FEATURES])).alias("o")).select("grp", "o.feature", "o.bin")
    long = written(spark, long.groupBy("grp", "feature", "bin").agg(F.count("*").alias("rows")), "quality-bins")
    keys = Window.partitionBy("grp", "feature")
    run = long.select("grp", "feature", "bin", F.sum("rows").over(keys.orderBy("bin")).alias("upto"),
                      F.sum("rows").over(keys).alias("n"))
    low = lambda q: F.min(F.when(F.col("upto") >= q * F.col("n"), F.col("bin")))
    each = run.groupBy("grp", "feature").agg(*[
        ((low(q) + 0.5) * FEATURE_GRID).alias(name) for q, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))])
    picked = lambda f, c: F.max(F.when(F.col("feature") == f, c))
    cov = []
    for i, f in enumerate(FEATURES):
        spread = picked(f, (F.col("q3") - F.col("q1")) / 1.349)
        cov += [(F.pow(spread, F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for j in range(i + 1)]
    return each.groupBy("grp", F.lit(0).alias("start")).agg(*[picked(f, F.col("q2")).alias(f"m_{i}") for i, f in enumerate(FEATURES)], *cov)


def _drawn_starts(rows: DataFrame) -> DataFrame:
    """Starts from 1 on: location and covariance of a few rows each, those of the least hashes, dealt in turn."""
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n"))
    few = rows.join(sizes, "grp").where(F.col("draw") / float(1 << 63) <= DRAWN / F.col("n"))
    xs = [f"x_{f}" for f in FEATURES]
    once = few.groupBy("grp", "draw").agg(*[F.min(x).alias(x) for x in xs])  # rows that agree in id and features are one
    place = F.row_number().over(Window.partitionBy("grp").orderBy("draw")) - 1
    start = (F.floor(place / START_ROWS) + 1).cast("int")
    pairs = [(i, j) for i in range(len(xs)) for j in range(i + 1)]
    return once.withColumn("start", start).where(F.col("start") <= STARTS).groupBy("grp", "start").agg(
        *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(xs)],
        *[F.covar_pop(xs[i], xs[j]).alias(f"c_{i}_{j}") for i, j in pairs])


def _factored(estimate: DataFrame, scale: float) -> DataFrame:
    """Location, the Cholesky factor of the covariance, with the floors on its diagonal, and its log determinant."""
    p = len(FEATURES)
    a = {(i, j): F.col(f"c_{i}_{j}") * scale for i in range(p) for j in range(i + 1)}
    out = estimate
    for i, f in enumerate(FEATURES):
        a[i, i] = F.greatest(a[i, i], F.lit(FLOORS[f] ** 2))
    for i in range(p):
        for j in range(i + 1):
            done = reduce(lambda x, y: x + y, [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)], F.lit(0.0))
            value = a[i, j] - done
            # raising the diagonal keeps the matrix positive definite; the small bound guards rounding alone
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j
                                 else value / F.col(f"l_{j}_{j}"))
    logdet = reduce(lambda x, y: x + y, [2 * F.log(f"l_{i}_{i}") for i in range(p)])
    return out.select("grp", "start", logdet.alias("logdet"), *[f"m_{i}" for i in range(p)],
                      *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i, f in enumerate(FEATURES):
        rest = reduce(lambda x, y: x + y, [F.col(f"l_{i}_{k}") * solved[k] for k in range(i)], F.lit(0.0))
        solved.append((F.col(f"x_{f}") - F.col(f"m_{i}") - rest) / F.col(f"l_{i}_{i}"))
    return reduce(lambda x, y: x + y, [s * s for s in solved])


def _concentrate(spark: SparkSession, rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Factors of the CORE share of rows that lie closest under the given ones, by group and start."""
    keys, p = ["grp", "start"], len(FEATURES)
    far = [(F.col(f"x_{f}") - F.col(f"m_{i}")).alias(f"d_{i}") for i, f in enumerate(FEATURES)]
    at = rows.join(factors, "grp").select(
        *keys, *[f"m_{i}" for i in range(p)], *far,
        F.floor(F.log(_distance() + F.lit(1e-9)) / DISTANCE_GRID).alias("bin"))
    bins = at.groupBy(*keys, "bin").agg(F.count("*").alias("rows"))
    whole_ = Window.partitionBy(*keys)
    run = bins.select(*keys, "bin", "rows", F.sum("rows").over(whole_.orderBy("bin")).alias("upto"),
                      F.ceil(CORE * F.sum("rows").over(whole_)).alias("wanted"))
    border = run.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("rows") < F.col("wanted")))
    core = written(spark, border.select(*keys, F.col("bin").alias("core_bin"), (
        (F.col("wanted") - F.col("upto") + F.col("rows")) / F.col("rows")).alias("part")), "quality-core")
    weight = F.when(F.col("bin") < F.col("core_bin"), 1.0).otherwise(F.col("part"))
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = at.join(core, keys).where("bin <= core_bin").withColumn("w", weight).groupBy(*keys).agg(
        F.sum("w").alias("w"), *[F.max(f"m_{i}").alias(f"m_{i}") for i in range(p)],
        *[F.sum(F.col("w") * F.col(f"d_{i}")).alias(f"s_{i}") for i in range(p)],
        *[F.sum(F.col("w") * F.col(f"d_{i}") * F.col(f"d_{j}")).alias(f"s_{i}_{j}") for i, j in pairs])
    mean = [F.col(f"s_{i}") / F.col("w") for i in range(p)]
    estimate = sums.select(*keys, *[(F.col(f"m_{i}") + mean[i]).alias(f"m_{i}") for i in range(p)],
                           *[(F.col(f"s_{i}_{j}") / F.col("w") - mean[i] * mean[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    return written(spark, _factored(estimate, CONSISTENCY), "quality-factors")


def _settled(spark: SparkSession, rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Concentrates every group until a step no longer lowers its determinant. Each round lowers at least one by more
    than ``SETTLED``, and the floors bound them from below, so the rounds end."""
    best = written(spark, factors.withColumn("active", F.lit(True)), "quality-best")
    columns = [c for c in best.columns if c not in ("grp", "active")]
    while best.where("active").count():
        after = _concentrate(spark, rows, best.where("active").drop("active"))
        both = best.join(after.select("grp", F.struct(*columns).alias("after")), "grp", "left")
        lower = F.coalesce(F.col("after.logdet") < F.col("logdet") - SETTLED, F.lit(False))
        best = written(spark, both.select("grp", lower.alias("active"), *[
            F.when(lower, F.col(f"after.{c}")).otherwise(F.col(c)).alias(c) for c in columns]), "quality-best")
    return best.drop("active")


def fit(spark: SparkSession, measured: DataFrame) -> DataFrame:
    """Per language and source the factors of its group's estimate; a table of as many rows as such pairs."""
    rows = measured.where(~F.col("base_failed"))
    groups = written(spark, _groups(rows), "quality-groups")
    rows = written(spark, _fitted_rows(rows, groups), "quality-rows")
    factors = written(spark, _factored(_start(spark, rows).unionByName(_drawn_starts(rows)), 1.0), "quality-factors")
    for _ in range(SCREEN_STEPS):
        factors = _concentrate(spark, rows, factors)
    columns = [c for c in factors.columns if c != "grp"]
    least = factors.groupBy("grp").agg(F.min_by(F.struct(*columns), F.struct("logdet", "start")).alias("f"))
    best = _settled(spark, rows, least.select("grp", "f.*"))
    return groups.join(best.drop("logdet", "start"), "grp").drop("grp")


def judged(measured: DataFrame, factors: DataFrame) -> DataFrame:
    """Adds ``distance`` (null where no estimate applies) and ``kept``."""
    joined = measured.join(factors, KEYS, "left")
    return (joined.withColumn("distance", _distance())
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))))


def quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, distance: one row for each row of ``docs``."""
    measured = written(spark, _measured(docs, [F.col("doc_id")]), "quality-counts")
    return judged(measured, fit(spark, measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance")


def _row_tag(text: Column, lang: Column, source: Column) -> Column:
    """A number for what a verdict depends on."""
    return F.xxhash64(text, text.isNull(), lang, lang.isNull(), source, source.isNull())


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged. The counts are computed and written once; verdicts
    go back to the texts by id and a hash of text, language and source, so rows that agree in these share one."""
    tag = _row_tag(F.col("text"), F.col("lang"), F.col("source")).alias("q_tag")
    measured = written(spark, _measured(docs, [F.col("doc_id"), tag]), "quality-counts")
    verdicts = judged(measured, fit(spark, measured)).where(~F.col("kept"))
    bad = written(spark, verdicts.select(F.col("doc_id").alias("b_id"), F.col("q_tag").alias("b_tag")).distinct(), "quality-bad")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("q_doc")).withColumn(
        "q_tag", _row_tag(F.col("q_doc.text"), F.col("q_doc.lang"), F.col("q_doc.source")))
    return rows.join(F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad,
                     (F.col("q_tag") == F.col("b_tag")) & F.col("q_doc.doc_id").eqNullSafe(F.col("b_id")), "left_anti").select("q_doc.*")
