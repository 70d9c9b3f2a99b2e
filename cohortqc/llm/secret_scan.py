"""Secret scan with corpus-wide ownership frequency, with DataFrame functions only.

Base spans come from three fixed patterns. The method adds candidates of a looser form (long runs of key characters
with letters and several digits, outside base spans) and weighs every candidate by who has it: its value is hashed,
and over the whole corpus the distinct repositories and distinct owners of each hash are counted. A value that
many owners have is a copied example; a value of one owner alone looks like a live credential. Loose candidates
become spans (kind ``owner``) only if they belong to one owner and are not widely repeated; base spans always stay
and are counted by class.

``owner`` and ``repository`` are columns: here a source owns its documents, and a document is a repository.

Frequencies are built from distinct (hash, owner, repository) rows by two combining aggregates, so a value that a third
of all rows hold is one row per task. Candidates are written once with row numbers; texts are read once and never move.

Defined results: a null text has no spans. Null owners and repositories are values of their own. Repeated rows are
rows of the same repository and get the same result. The digest of no spans is that of the empty string. An empty table
gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import whole, written

# Fixed values of the contract: kind, pattern, group whose length counts, least length; kinds in order.
BASE = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]+)", 1, 16),
]
LOOSE, LOOSE_CHARS = r"([A-Za-z0-9+/_=-]{20,})", 20
WIDE_OWNERS = 3
MAX_REPOSITORIES = 20


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches with their place: what lies between matches, and the matches, have lengths
    whose running sums are the places. Matches whose group is too short are dropped after that."""
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    item = "struct<kind:int,start:bigint,end:bigint,value:string>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{item}>").alias("found"))

    def step(state, x):
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.array(F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value")))
        long_enough = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        return F.struct(end.cast("bigint").alias("at"),
                        F.when(long_enough, F.concat(state["found"], one.cast(f"array<{item}>")))
                        .otherwise(state["found"]).alias("found"))

    none = F.array().cast(f"array<{item}>")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(pairs, start, step)["found"]).otherwise(none)


def _scanned(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """row, doc_id, owner, repository, base, loose: spans of every row, the base ones in order."""
    text = whole("text")
    # long patterns need not start on texts whose few fixed letters are missing; counts of repeats are least lengths
    hints = {"assign": "(?i)(password|passwd|secret|token|api_?key)", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}"}
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,value:string>>")
    base = [F.when(F.regexp_like(text, F.lit(hints[name])), _spans(text, k, pattern, group, least)).otherwise(none)
            for k, (name, pattern, group, least) in enumerate(BASE)]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.array_sort(F.concat(*base), lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1)
                     .otherwise(1)).otherwise(a["kind"] - b["kind"])).alias("base"),
        F.when(F.regexp_like(text, F.lit(LOOSE)), _spans(text, len(BASE), LOOSE, 1, LOOSE_CHARS)).otherwise(none).alias("loose"))
    keep = lambda s: (
        F.regexp_like(s["value"], F.lit("[A-Za-z]")) & F.regexp_like(s["value"], F.lit("[0-9][^0-9]*[0-9][^0-9]*[0-9]"))
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn("loose", F.filter("loose", keep))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_repositories, n_owners: of every candidate value, over the whole corpus."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    each = candidates.select("hash", name("owner").alias("owner"), name("repository").alias("repository")).distinct()
    owners = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("hash").agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))


def secret_scan(spark: SparkSession, docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_added: one row for each row of
    ``docs``."""
    rows = written(spark, _scanned(docs, owner, repository), "secret-spans")
    found = rows.where("size(base) > 0 OR size(loose) > 0").select(
        "row", "owner", "repository", F.explode(F.concat("base", "loose")).alias("s"))
    found = found.select("row", "owner", "repository", F.xxhash64("s.value").alias("hash"), F.col("s.kind").alias("kind"),
                         F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    # a hex run within an assignment is the same candidate: equal values share a hash whatever the pattern
    known = found.join(ownership(found), "hash").select(
        "row", "kind", "start", "end", (F.col("n_owners") >= WIDE_OWNERS).alias("copied"),
        ((F.col("n_owners") == 1) & (F.col("n_repositories") <= MAX_REPOSITORIES)).alias("live"))
    verdicts = known.groupBy("row").agg(
        F.count_if((F.col("kind") < len(BASE)) & F.col("live")).alias("n_live"),
        F.count_if((F.col("kind") < len(BASE)) & F.col("copied")).alias("n_copied"),
        F.sort_array(F.collect_list(F.when((F.col("kind") == len(BASE)) & F.col("live"),
                                           F.struct("start", "kind", "end")))).alias("added"))
    kinds = F.array(*[F.lit(name) for name, *_ in BASE], F.lit("owner"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    slim = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    out = rows.join(verdicts, "row", "left").withColumn("added", F.coalesce("added", none))
    return out.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.sort_array(F.concat(slim(F.col("base")), "added"))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("bigint").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied"), F.size("added").cast("bigint").alias("n_added"))
