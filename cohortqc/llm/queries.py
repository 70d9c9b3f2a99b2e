"""Queries of the dealt operators, with production parameters over whole tables."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm import (
    exact_dedup, language_id, line_dedup, lm_scoring, mixing, packing, quality_rules, secret_scan, simhash_dedup, spelling,
    token_counts, toxicity, whitening,
)
from cohortqc.llm.common import documents, kept_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)"""


@query("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, documents(spark, sf_dir)).drop("n_cp")


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_groups(spark, documents(spark, sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = kept_folder(spark, "token-count-cache")
    return token_counts.token_counts(spark, documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), cache)


def _op4_sql() -> str:
    """Places of matches are running sums of the lengths between and of them; the rest is grouping."""
    kinds = [*secret_scan.BASE, ("owner", secret_scan.LOOSE, 1, secret_scan.LOOSE_CHARS)]
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    found = " UNION ALL ".join(f"""
  SELECT row, source, doc_id, {k} AS kind, '{name}' AS name, {least} AS least, string_split_regex(t, {quoted(pattern)}) AS gaps,
    regexp_extract_all(t, {quoted(pattern)}, 0) AS hits, regexp_extract_all(t, {quoted(pattern)}, {group}) AS vals
  FROM d WHERE regexp_matches(t, {quoted(pattern)})""" for k, (name, pattern, group, least) in enumerate(kinds))
    loose = len(secret_scan.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({found}),
i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
p AS (
  SELECT row, source, doc_id, kind, name, vals[i] AS value, least, len(hits[i]) AS n,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
  FROM i),
a AS (SELECT *, (s + n)::BIGINT AS e FROM p WHERE length(value) >= least),
b AS (SELECT * FROM a WHERE kind < {loose}),
l AS (
  SELECT * FROM a WHERE kind = {loose} AND regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9][^0-9]*[0-9][^0-9]*[0-9]')
    AND NOT EXISTS (SELECT 1 FROM b WHERE b.row = a.row AND b.s < a.e AND a.s < b.e)),
c AS (SELECT * FROM b UNION ALL SELECT * FROM l),
o AS (
  SELECT value, count(DISTINCT o) AS owners, count(DISTINCT (o, r)) AS repositories
  FROM (SELECT value, coalesce('=' || source, '-') AS o, coalesce('=' || doc_id, '-') AS r FROM c) t GROUP BY value),
v AS (
  SELECT row, kind, name, s, e, owners >= {secret_scan.WIDE_OWNERS} AS copied,
    owners = 1 AND repositories <= {secret_scan.MAX_REPOSITORIES} AS live
  FROM c JOIN o USING (value)),
g AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || s::BIGINT || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < {loose}) AS base,
    string_agg(name || ':' || s::BIGINT || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < {loose} OR live) AS spans,
    count(*) FILTER (kind < {loose} AND live) AS n_live, count(*) FILTER (kind < {loose} AND copied) AS n_copied,
    count(*) FILTER (kind = {loose} AND live) AS n_added
  FROM v GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN g USING (row)"""


@query("op4_secret_scan", _op4_sql())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(spark, documents(spark, sf_dir))


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(spark, documents(spark, sf_dir), lm_scoring.contract_fold())


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, documents(spark, sf_dir), language_id.contract_fold())


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(spark, documents(spark, sf_dir))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.toxicity(spark, documents(spark, sf_dir), labels, toxicity.contract_fold())


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


# One cycle is scheduled slot by slot: of the sources whose next block is released, the one with the earliest deadline.
OP10_SQL = f"""
WITH RECURSIVE k AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS s, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT s, count(*) AS n, sqrt(count(*)) AS w FROM k GROUP BY s),
q AS (SELECT s, n, greatest(1, round(w / (SELECT sum(w) FROM t) * {mixing.RESOLUTION}))::BIGINT AS q FROM t),
c AS (SELECT list(s ORDER BY s) AS ss, list(q ORDER BY s) AS qs, sum(q)::BIGINT AS cycle FROM q),
step AS (
  SELECT 0::BIGINT AS t, 0::BIGINT AS pick, list_transform(qs, lambda x: 0::BIGINT) AS done FROM c WHERE cycle IS NOT NULL
  UNION ALL
  SELECT t + 1, p, list_transform(done, lambda n, i: n + CASE WHEN i = p THEN 1 ELSE 0 END) FROM (
    SELECT t, done, cycle, list_min(list_filter(list_transform(done, lambda n, i:
      CASE WHEN n < qs[i] AND n * cycle // qs[i] <= t THEN [((n + 1) * cycle + qs[i] - 1) // qs[i], i] END),
      lambda x: x IS NOT NULL))[2] AS p
    FROM step, c WHERE t < cycle) x),
slots AS (
  SELECT ss[pick] AS s, t - 1 AS turn_slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
  FROM step, c WHERE t > 0),
r AS (
  SELECT doc_id, source, s, n, q, cycle, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) - 1 AS source_rank
  FROM k JOIN q USING (s), c),
b AS (SELECT *, source_rank // {mixing.BLOCK_DOCS} AS block FROM r),
p AS (SELECT b.*, (block // q) * cycle + turn_slot AS slot FROM b JOIN slots ON b.s = slots.s AND block % q = turn)
SELECT doc_id, source, source_rank, block, block * cycle // q AS release, ((block + 1) * cycle + q - 1) // q AS deadline,
  slot, source_rank % {mixing.BLOCK_DOCS} AS place,
  slot <= (SELECT min(m) FROM (SELECT max(slot) AS m FROM p GROUP BY s)) AS on_target
FROM p"""


@query("op10_pfair_mixing", OP10_SQL)
def op10_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixing.mixed(spark, docs, mixing.root_targets(docs))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT row, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key
  HAVING count(DISTINCT row) >= {line_dedup.MIN_DOCS}),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key)),
t AS (
  SELECT row, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM m GROUP BY row)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM d JOIN t USING (row)"""


@query("op11_line_dedup", OP11_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(spark, documents(spark, sf_dir)).drop("words")


# crc32 byte by byte; near words by deletion: one is the other without a letter, or both without the same one are equal
SLIP_ONE_IN = 31
OP12_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), b)) AS crc),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
t AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM r
  WHERE length(run) >= {spelling.MIN_CHARS}),
g AS (SELECT doc_id, run, count(*) AS n, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS x FROM t GROUP BY doc_id, run),
h AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
    lambda c, b: xor(crc[xor(c & 255, b) + 1], c >> 8), 4294967295), 4294967295) AS h FROM g, tab),
w AS (
  SELECT CASE WHEN h % {SLIP_ONE_IN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    n FROM h),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {spelling.MIN_CHARS} GROUP BY word
  HAVING sum(n) >= {spelling.MIN_COUNT}),
x AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v) s),
o AS (
  SELECT a.word AS word, v.word AS near FROM x a JOIN v ON a.rest = v.word
  UNION SELECT a.word, b.word FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
b AS (SELECT word, near FROM o UNION SELECT near, word FROM o),
s AS (
  SELECT b.word, count(*) AS n_near, first(b.near ORDER BY v.n DESC, b.near) AS form, max(v.n) AS form_n
  FROM b JOIN v ON v.word = b.near GROUP BY b.word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {spelling.FORM_RATIO} * v.n THEN form END AS form,
    CASE WHEN form_n >= {spelling.FORM_RATIO} * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN s USING (word)),
c AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, c.root FROM c JOIN f ON f.form = c.word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM f JOIN c USING (word)"""


@query("op12_spelling_variants", OP12_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, documents(spark, sf_dir), slip_one_in=SLIP_ONE_IN)


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
                       "explained", "identity_error")
