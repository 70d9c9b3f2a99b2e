"""Sequencing-shaped inputs as views over the driver's tables.

Each view is one SELECT over whole tables, in SQL that Spark and DuckDB both read; the few places where the dialects
differ are the placeholders in ``SPARK`` and ``DUCKDB``. Views only shape input data. Operators are written in Spark
and checked against separate SQL.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.session import written

# Views that stand for tables a pipeline has on disk: raw reads, alignments and stage stores. They are written once per
# session to the shared folder, so queries scan, prune and filter a table as they would in production.
STORED = {"reads_v", "mates_v", "alignments_v", "paired_v", "layout_v", "fastq_screen_v", "atropos_v", "hisat2_v",
          "aln_stats_v", "rnaseqmetrics_v", "markduplicates_v", "count_summary_v", "coverage_v"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

SPARK = {
    "document_lines": ("(SELECT doc_id, source, line_no, line FROM documents "
                       "LATERAL VIEW posexplode(split(text, chr(10))) t AS line_no, line)"),
    "coverage_array": ("transform(sequence(0, 100), i -> CASE WHEN (c_custkey + i) % 13 = 0 THEN NULL "
                       "ELSE CAST((c_custkey * (i + 1)) % 97 AS DOUBLE) / 10 END)"),
    "one_start": "array(s)", "one_end": "array(e)",
    "three_starts": "array(s, s + size * 8, s + size * 15)", "three_ends": "array(s + size * 5, s + size * 12, e)",
}
DUCKDB = {
    "document_lines": ("(SELECT doc_id, source, unnest(range(0, len(string_split(text, chr(10))))) AS line_no, "
                       "unnest(string_split(text, chr(10))) AS line FROM documents)"),
    "coverage_array": ("list_transform(range(0, 101), lambda i: CASE WHEN (c_custkey + i) % 13 = 0 THEN NULL "
                       "ELSE CAST((c_custkey * (i + 1)) % 97 AS DOUBLE) / 10 END)"),
    "one_start": "[s]", "one_end": "[e]",
    "three_starts": "[s, s + size * 8, s + size * 15]", "three_ends": "[s + size * 5, s + size * 12, e]",
}

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_TO_BASES = "ACGTNACGTACGTACGTACGTACGTA"
_TO_QUALITY = "!#%+-/258;>ADGIJ4679BCEFHK"

_RUN = "'SRR' || CAST(o_custkey AS STRING)"

# which runs of a stage are there in its view with gaps
_GAPS = {
    "atropos": "min(o_orderpriority) = '1-URGENT'", "hisat2": "max(o_totalprice) > 300000",
    "aln_stats": "min(o_totalprice) < 100000", "rnaseqmetrics": "max(o_orderpriority) = '5-LOW'",
    "markduplicates": "max(o_totalprice) > 200000", "count_summary": "min(o_totalprice) < 200000",
}

VIEWS: dict[str, str] = {
    # ---- cohort: a customer is a run, a nation and market segment an experiment ----
    "manifest_v": """
        SELECT CASE WHEN c_acctbal < 0 THEN NULL
                    ELSE 'SRX' || CAST(c_nationkey AS STRING) || '_' || c_mktsegment END AS srx,
               'SRR' || CAST(c_custkey AS STRING) AS srr
        FROM customer""",
    "done_v": f"SELECT DISTINCT {_RUN} AS srr FROM orders WHERE o_orderstatus = 'F'",
    "orders_v": f"SELECT {_RUN} AS srr, o_orderstatus, o_orderpriority, o_totalprice FROM orders",
    "balances_v": """
        SELECT 'SRR' || CAST(c_custkey AS STRING) AS srr, c_acctbal AS balance, CAST(c_nationkey AS DOUBLE) AS nation
        FROM customer""",
    "numbers_v": """
        SELECT srr, count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS nf,
               count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS no, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS np
        FROM orders_v GROUP BY srr""",
    # ---- stage tables: aggregates of a run's orders ----
    "layout_v": """
        SELECT srr, CASE WHEN sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) * 2 > count(*) THEN 'SE' ELSE 'PE'
               END AS layout, count(*) * 100000 AS libsize, CAST(100 AS DOUBLE) AS avgLen_R1,
               CAST(100 AS DOUBLE) AS avgLen_R2
        FROM orders_v GROUP BY srr""",
    "fastq_screen_v": """
        SELECT srr, CASE o_orderstatus WHEN 'F' THEN 'rRNA' WHEN 'O' THEN 'dm6' ELSE 'ecoli' END AS reference,
               CAST(count(*) AS DOUBLE) * 2.5 AS pct_reads_mapped
        FROM orders_v GROUP BY srr, o_orderstatus""",
    "atropos_v": """
        SELECT srr, count(*) * 1100 AS total_processed, count(*) * 1000 AS total_written,
               CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 7 ELSE 1 END) AS BIGINT) AS too_short
        FROM orders_v GROUP BY srr""",
    "hisat2_v": """
        SELECT srr, CAST(count(*) * 1000 AS DOUBLE) AS num_reads,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END) AS DOUBLE) AS num_multimappers,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) / count(*) AS per_alignment
        FROM orders_v GROUP BY srr""",
    "aln_stats_v": """
        SELECT srr, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END) AS BIGINT) AS reads_MQ0,
               CAST(20 AS DOUBLE) + CAST(count(*) AS DOUBLE) / 2 AS average_quality,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) / count(*)
                   AS percent_reverse
        FROM orders_v GROUP BY srr""",
    "rnaseqmetrics_v": """
        SELECT srr,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) / count(*)
                   AS percent_utr_bases,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) / count(*)
                   AS percent_intronic_bases,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) / count(*)
                   AS percent_intergenic_bases,
               CAST(100 AS DOUBLE) * sum(CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END) / count(*)
                   AS percent_mrna_bases,
               max(o_totalprice) / min(o_totalprice) AS median_cv_coverage
        FROM orders_v GROUP BY srr""",
    "markduplicates_v": """
        SELECT srr, CAST(100 AS DOUBLE) * (count(*) - count(DISTINCT o_orderpriority)) / count(*) AS percent_duplication
        FROM orders_v GROUP BY srr""",
    "count_summary_v": """
        SELECT srr, CAST(sum(floor(o_totalprice)) AS BIGINT) AS number_genic_reads,
               CAST(count(DISTINCT o_orderpriority) AS DOUBLE) * 20 AS percent_genes_on,
               CAST(sum(floor(o_totalprice / 10)) AS BIGINT) AS number_junction_reads,
               count(*) * 3 AS number_junctions_on
        FROM orders_v GROUP BY srr""",
    "coverage_v": """
        SELECT 'SRR' || CAST(c_custkey AS STRING) AS srr, {coverage_array} AS coverage FROM customer""",
    # ---- the same with gaps, for the queries that bring stages together: a stage lacks runs of some kind ----
    **{f"{stage}_gaps_v": f"""
        SELECT s.* FROM {stage}_v s JOIN (SELECT srr FROM orders_v GROUP BY srr HAVING {having}) k ON s.srr = k.srr"""
       for stage, having in _GAPS.items()},
    "coverage_gaps_v": """
        SELECT s.* FROM coverage_v s JOIN customer c ON s.srr = 'SRR' || CAST(c_custkey AS STRING)
        WHERE c_mktsegment <> 'MACHINERY'""",
    # ---- reads: every line of every document is a read, a source is a run ----
    "reads_v": f"""
        SELECT 'SRR_' || source AS srr, 1 AS mate, doc_id * 100000 + line_no AS read_no,
               '@R.' || CAST(doc_id AS STRING) || '.' || CAST(line_no AS STRING) || ' length='
                   || CAST(length(line) AS STRING) || CASE WHEN line_no % 7 = 4 THEN chr(9) || 'x' ELSE '' END AS h1,
               translate(lower(line), '{_LETTERS} .,-()', '{_TO_BASES}') AS seq, '+' AS h2,
               CASE WHEN line_no > 0 AND right(line, 1) <> '.' THEN NULL
                    WHEN (doc_id + line_no) % 11 = 3 THEN translate(lower(substr(line, 3)), '{_LETTERS} .,', '{_TO_QUALITY}')
                    ELSE translate(lower(line), '{_LETTERS} .,', '{_TO_QUALITY}') END AS qual
        FROM {{document_lines}} lines""",
    # ---- mate pairs: a conversation is a run, what the assistant says is mate 2, the rest mate 1 ----
    "mates_v": f"""
        SELECT srr, mate, read_no, n_chars,
               '@' || srr || '.' || CAST(read_no AS STRING) || '/' || CAST(mate AS STRING)
                   || CASE WHEN n_chars > 1200 THEN ' long' ELSE ' norm' END
                   || ' length=' || CAST(n_chars AS STRING) AS h1,
               CASE WHEN srr LIKE '%7' AND read_no = 0 THEN 'T0120.31' || CAST(n_chars AS STRING)
                    ELSE translate(lower(text), '{_LETTERS} .,-()' || chr(10), '{_TO_BASES}') END AS seq, '+' AS h2,
               CASE WHEN right(text, 1) <> '.' THEN NULL
                    ELSE translate(lower(text), '{_LETTERS} .,' || chr(10), '{_TO_QUALITY}') END AS qual
        FROM (SELECT 'SRR' || CAST(conv_id AS STRING) AS srr, CASE WHEN role = 'assistant' THEN 2 ELSE 1 END AS mate,
                     CAST(row_number() OVER (PARTITION BY conv_id, role = 'assistant' ORDER BY turn) - 1 AS BIGINT) AS read_no,
                     CAST(length(text) AS BIGINT) AS n_chars, text
              FROM conversations) turns""",
    "mate_files_v": """
        SELECT srr, max(mate) = 2 AS paired, sum(CASE WHEN mate = 1 THEN n_chars END) AS size1,
               sum(CASE WHEN mate = 2 THEN n_chars END) AS size2
        FROM mates_v GROUP BY srr""",
    # ---- single-end alignments: a line item is a read near the gene of its part ----
    "alignments_v": """
        SELECT 'SRR' || CAST(l_suppkey % 20 AS STRING) AS srr,
               CAST(l_orderkey AS STRING) || '.' || CAST(l_linenumber AS STRING) || '.' || CAST(l_partkey AS STRING)
                   || '.' || CAST(l_suppkey AS STRING) AS qname,
               CASE WHEN l_tax = 0 AND l_discount = 0 THEN 4 WHEN l_returnflag = 'R' THEN 16 ELSE 0 END AS flag,
               'chr' || CAST(l_partkey % 5 AS STRING) AS ref,
               CAST(l_partkey * 80 + floor(l_quantity / 10) * 60 + 10 AS BIGINT) AS pos,
               CASE WHEN l_discount > 0.09 THEN 1 ELSE CAST(floor(l_quantity) AS INT) + 9 END AS mapq,
               CASE l_linenumber WHEN 3 THEN '20M300N30M' WHEN 5 THEN '5S45M' WHEN 6 THEN '25M2I10M3D13M'
                                 WHEN 7 THEN '10M120N20M200N20M' ELSE '50M' END AS cigar,
               '*' AS rnext, CAST(0 AS BIGINT) AS pnext, CAST(0 AS BIGINT) AS tlen, '*' AS seq,
               repeat(chr(CAST(43 + floor(l_discount * 100) AS INT)), 25)
                   || repeat(chr(CAST(53 + floor(l_tax * 100) AS INT)), 25) AS qual,
               CAST(NULL AS INT) AS nh
        FROM lineitem""",
    # ---- paired alignments: an order is a template with two ends ----
    "templates_v": """
        SELECT 'SRR' || CAST(o_custkey % 20 AS STRING) AS srr, CAST(o_orderkey AS STRING) AS qname,
               'chr' || CAST(o_custkey % 5 AS STRING) AS ref, o_custkey * 80 + 20 AS pos,
               CAST(40 + floor(o_totalprice / 600) AS BIGINT) AS size, o_orderpriority AS kind,
               o_orderstatus AS orient, CAST(floor(o_totalprice / 10000) AS INT) AS mapq
        FROM orders""",
    "paired_v": """
        SELECT srr, qname,
               CASE WHEN kind = '4-NOT SPECIFIED' THEN 73 WHEN orient = 'F' AND kind <> '5-LOW' THEN 99
                    WHEN orient = 'F' THEN 97 WHEN orient = 'O' THEN 81
                    ELSE 65 END AS flag,
               ref, pos, mapq, '50M' AS cigar,
               CASE WHEN kind = '5-LOW' THEN 'chrX' ELSE '=' END AS rnext,
               pos + size - 50 AS pnext, CASE WHEN kind = '5-LOW' OR kind = '4-NOT SPECIFIED' THEN 0 ELSE size END AS tlen,
               '*' AS seq, repeat('F', 25) || repeat('5', 25) AS qual, CAST(NULL AS INT) AS nh
        FROM templates_v
        UNION ALL
        SELECT srr, qname,
               CASE WHEN kind = '4-NOT SPECIFIED' THEN 133 WHEN orient = 'F' AND kind <> '5-LOW' THEN 147
                    WHEN orient = 'F' THEN 145 WHEN orient = 'O' THEN 161
                    ELSE 129 END AS flag,
               CASE WHEN kind = '5-LOW' THEN 'chrX' ELSE ref END AS ref, pos + size - 50 AS pos, mapq, '50M' AS cigar,
               CASE WHEN kind = '5-LOW' THEN ref ELSE '=' END AS rnext,
               pos AS pnext, CASE WHEN kind = '5-LOW' OR kind = '4-NOT SPECIFIED' THEN 0 ELSE -size END AS tlen,
               '*' AS seq, repeat('F', 50) AS qual, CAST(NULL AS INT) AS nh
        FROM templates_v""",
    # ---- annotation: a part is a gene; longer ones have three exons ----
    "genes_v": """
        SELECT CAST(p_partkey AS STRING) AS gene_id, 'T' || CAST(p_partkey AS STRING) AS tx_id,
               'chr' || CAST(p_partkey % 5 AS STRING) AS ref, p_partkey * 80 AS s, p_partkey * 80 + p_size * 20 - 1 AS e,
               CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_size AS size, p_type AS kind
        FROM part""",
    "exons_v": """
        SELECT gene_id, tx_id, ref, s AS start, e AS "end", strand FROM genes_v WHERE size < 15
        UNION ALL
        SELECT gene_id, tx_id, ref, s AS start, s + size * 5 AS "end", strand FROM genes_v WHERE size >= 15
        UNION ALL
        SELECT gene_id, tx_id, ref, s + size * 8 AS start, s + size * 12 AS "end", strand FROM genes_v WHERE size >= 15
        UNION ALL
        SELECT gene_id, tx_id, ref, s + size * 15 AS start, e AS "end", strand FROM genes_v WHERE size >= 15""",
    "transcripts_v": """
        SELECT gene_id AS gene, tx_id AS tx, ref, strand, s AS tx_start, e AS tx_end,
               CASE WHEN kind = 'SMALL' THEN e + 1 ELSE s + size * 2 END AS cds_start,
               CASE WHEN kind = 'SMALL' THEN e ELSE e - size * 2 END AS cds_end,
               CASE WHEN size < 15 THEN {one_start} ELSE {three_starts} END AS exon_starts,
               CASE WHEN size < 15 THEN {one_end} ELSE {three_ends} END AS exon_ends
        FROM genes_v""",
}

_QUOTED_END = 'AS "end"'


# The stage views where Spark builds them: the same rows from two aggregates of the orders, one for all stages that only
# sum and one for those that tell kinds apart, instead of an aggregate a stage.
_SUMS = {
    "n": "count(*)", "pending": "sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)",
    "open": "sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)",
    "multi": "sum(CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END)",
    "unfinished": "sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END)",
    "mq0": "sum(CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 0 END)",
    "short": "sum(CASE WHEN o_orderpriority = '5-LOW' THEN 7 ELSE 1 END)",
    "urgent": "sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)",
    "high": "sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END)",
    "medium": "sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END)",
    "above": "sum(CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END)",
    "most": "max(o_totalprice)", "least": "min(o_totalprice)",
}
_KINDS = {"n": "count(*)", "kinds": "count(DISTINCT o_orderpriority)", "genic": "sum(floor(o_totalprice))",
          "junction": "sum(floor(o_totalprice / 10))"}


def _by_run(measures: dict[str, str]) -> str:
    return f"SELECT srr, {', '.join(f'{how} AS {name}' for name, how in measures.items())} FROM orders_v GROUP BY srr"


_FROM_RUNS = {
    "run_sums_v": _by_run(_SUMS),
    "run_kinds_v": _by_run(_KINDS),
    "layout_v": """
        SELECT srr, CASE WHEN pending * 2 > n THEN 'SE' ELSE 'PE' END AS layout, n * 100000 AS libsize,
               CAST(100 AS DOUBLE) AS avgLen_R1, CAST(100 AS DOUBLE) AS avgLen_R2
        FROM run_sums_v""",
    "atropos_v": """
        SELECT srr, n * 1100 AS total_processed, n * 1000 AS total_written, CAST(short AS BIGINT) AS too_short
        FROM run_sums_v""",
    "hisat2_v": """
        SELECT srr, CAST(n * 1000 AS DOUBLE) AS num_reads, CAST(multi AS DOUBLE) AS num_multimappers,
               CAST(100 AS DOUBLE) * unfinished / n AS per_alignment
        FROM run_sums_v""",
    "aln_stats_v": """
        SELECT srr, CAST(mq0 AS BIGINT) AS reads_MQ0, CAST(20 AS DOUBLE) + CAST(n AS DOUBLE) / 2 AS average_quality,
               CAST(100 AS DOUBLE) * open / n AS percent_reverse
        FROM run_sums_v""",
    "rnaseqmetrics_v": """
        SELECT srr, CAST(100 AS DOUBLE) * urgent / n AS percent_utr_bases,
               CAST(100 AS DOUBLE) * high / n AS percent_intronic_bases,
               CAST(100 AS DOUBLE) * medium / n AS percent_intergenic_bases,
               CAST(100 AS DOUBLE) * above / n AS percent_mrna_bases, most / least AS median_cv_coverage
        FROM run_sums_v""",
    "markduplicates_v": """
        SELECT srr, CAST(100 AS DOUBLE) * (n - kinds) / n AS percent_duplication FROM run_kinds_v""",
    "count_summary_v": """
        SELECT srr, CAST(genic AS BIGINT) AS number_genic_reads, CAST(kinds AS DOUBLE) * 20 AS percent_genes_on,
               CAST(junction AS BIGINT) AS number_junction_reads, n * 3 AS number_junctions_on
        FROM run_kinds_v""",
}
STORED |= {"run_sums_v", "run_kinds_v"}
# in an order in which each can be defined: the aggregates right below the orders
SPARK_VIEWS = {new: _FROM_RUNS.get(new, VIEWS.get(new)) for name in VIEWS for new in (
    (name, "run_sums_v", "run_kinds_v") if name == "orders_v" else (name,))}


def sql(name: str, dialect: dict[str, str]) -> str:
    """Text of one view in a dialect."""
    text = (SPARK_VIEWS if dialect is SPARK else VIEWS)[name]
    for placeholder, value in dialect.items():
        text = text.replace("{" + placeholder + "}", value)
    return text.replace(_QUOTED_END, "AS `end`") if dialect is SPARK else text


def needed(names: tuple[str, ...], views: dict[str, str] = VIEWS) -> list[str]:
    """The named views and those they read, in an order in which each can be defined."""
    wanted = set(names)  # a view reads only views above it
    changed = True
    while changed:
        changed = False
        for name in list(wanted):
            for other in views:
                if other != name and other in views[name] and other not in wanted:
                    wanted.add(other)
                    changed = True
    return [name for name in views if name in wanted]


_PLANS: dict[tuple, DataFrame] = {}


def _written(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """The view as a table of as many files as the session has partitions, whatever its size. Rows are dealt by a hash
    of all their columns: dealt in turn, Spark would sort them first, and spill."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartition(n, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), name)


def _view(spark: SparkSession, name: str) -> DataFrame:
    df = spark.sql(sql(name, SPARK))
    return _written(spark, name, df) if name in STORED else df


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, id(spark), sf_dir, name


def stored(spark: SparkSession, sf_dir: str, name: str, make, dealt: bool = True) -> DataFrame:
    """A derived table that is written once per session, like the views in ``STORED``. Without ``dealt`` the rows stay
    where they are: those of a stored view lie evenly."""
    key = _key(spark, sf_dir, name)
    if key not in _PLANS:
        _PLANS[key] = _written(spark, name, make()) if dealt else written(make(), name)
    return _PLANS[key]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view as a DataFrame over the tables in ``sf_dir``."""
    def key(what: str) -> tuple:
        return _key(spark, sf_dir, what)

    if key(name) not in _PLANS:
        views = needed((name,), SPARK_VIEWS)
        words = set(re.findall(r"\w+", " ".join(sql(v, SPARK) for v in views)))
        for what in [t for t in TABLES if t in words] + views:
            if key(what) not in _PLANS:
                _PLANS[key(what)] = spark.read.parquet(f"{sf_dir}/{what}.parquet") if what in TABLES else _view(spark, what)
            _PLANS[key(what)].createOrReplaceTempView(what)
    return _PLANS[key(name)]


def ctes(*names: str) -> str:
    """The named views as the start of a DuckDB WITH clause (no trailing comma)."""
    return ", ".join(f"{name} AS ({sql(name, DUCKDB)})" for name in needed(names))
