"""Manifest, count tables, alignments, annotation, stage folders and stores."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.session import empty, path_exists

STEM = r"([^/]+?)(?:\.[^./]*)?$"


def file_stem(column=None):
    """File name without folder and last extension."""
    return F.regexp_extract(column if column is not None else F.col("_metadata.file_name"), STEM, 1)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated manifest with header and ``#`` comments: one column is srr, two are srx and srr, by position."""
    raw = spark.read.csv(path, sep="\t", header=True, comment="#", inferSchema=False)
    if len(raw.columns) == 1:
        return raw.toDF("srr").select(F.lit(None).cast("string").alias("srx"), "srr")
    if len(raw.columns) == 2:
        return raw.toDF("srx", "srr")
    raise ValueError(f"manifest must have 1 or 2 columns, found {len(raw.columns)}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Last column of count tables (``#`` comments, one header line, tab-separated), with the run from the file name.

    The header is the first line of a file that is no comment, whatever it holds; a count that is no whole number is an
    error.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = (spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), place.alias("place"), "value")
             .where(~F.col("value").startswith("#") & (F.col("value") != "")))
    header = lines.groupBy("path").agg(F.min("place").alias("header"))
    last = F.element_at(F.split("value", "\t"), -1)
    count = last.try_cast("bigint")
    return lines.join(header, "path").where("place <> header").select(
        F.regexp_extract("path", r"([^./]+)[^/]*$", 1).alias("srr"),
        F.coalesce(count, F.raise_error(F.concat(F.lit("no count in "), "path", F.lit(": "), "value")).cast("bigint"))
        .alias("count"))


def read_sam(spark: SparkSession, path: str, pattern: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """SAM text to the alignments schema; header lines are dropped. The run is what ``pattern`` finds in the path, by
    default the file name up to the first dot."""
    f = F.split("value", "\t")
    nh = F.regexp_extract("value", r"\tNH:i:(\d+)", 1)
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return (lines.where(~F.col("value").startswith("@"))
            .select(
                F.regexp_extract("_metadata.file_path", pattern, 1).alias("srr"),
                f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("ref"), f[3].cast("bigint").alias("pos"),
                f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[6].alias("rnext"),
                f[7].cast("bigint").alias("pnext"), f[8].cast("bigint").alias("tlen"), f[9].alias("seq"),
                f[10].alias("qual"), F.nullif(nh, F.lit("")).cast("int").alias("nh")))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Exon lines of a GTF."""
    cols = ("ref", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
    raw = spark.read.csv(path, sep="\t", comment="#", quote="", schema=", ".join(f"`{c}` string" for c in cols))

    def attribute(name: str):
        return F.nullif(F.regexp_extract("attributes", rf'{name} "?([^";]+)"?', 1), F.lit(""))

    return raw.where("feature = 'exon'").select(
        attribute("gene_id").alias("gene_id"), attribute("transcript_id").alias("tx_id"), "ref",
        F.col("start").cast("bigint"), F.col("end").cast("bigint"), "strand")


def read_refflat(spark: SparkSession, path: str) -> DataFrame:
    """refFlat to transcripts. Starts are 0-based in the file and 1-based inclusive here."""
    cols = ("gene", "tx", "ref", "strand", "tx_start", "tx_end", "cds_start", "cds_end", "n_exons", "starts", "ends")
    raw = spark.read.csv(path, sep="\t", comment="#", quote="", schema=", ".join(f"{c} string" for c in cols))

    def positions(c: str, shift: int):
        parts = F.filter(F.split(c, ","), lambda x: x != "")
        return F.transform(parts, lambda x: x.cast("bigint") + shift)

    one_based = {c: (F.col(c).cast("bigint") + shift).alias(c)
                 for c, shift in (("tx_start", 1), ("tx_end", 0), ("cds_start", 1), ("cds_end", 0))}
    return raw.select("gene", "tx", "ref", "strand", *one_based.values(),
                      positions("starts", 1).alias("exon_starts"), positions("ends", 0).alias("exon_ends"))


def read_stage_folder(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """One parquet file per run; the run is the file stem. A missing folder reads as an empty table."""
    schema = schemas.STAGES[stage]
    if not path_exists(spark, path):
        return empty(spark, schema)
    raw = spark.read.schema(schema).parquet(path)
    return raw.withColumn("srr", F.coalesce("srr", file_stem()))


def read_store(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """A stage store, or an empty typed table when there is none yet. Which batch a row came with is not shown."""
    schema = schemas.STAGES[stage]
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{name}`") for name in schema.names])


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """The done table as it is; what reads it treats runs as a set."""
    if not path_exists(spark, path):
        return empty(spark, schemas.DONE)
    return spark.read.schema(schemas.DONE).parquet(path).select(*schemas.DONE.names)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The status table, or an empty one."""
    return spark.read.schema(schemas.STATUS).parquet(path) if path_exists(spark, path) else empty(spark, schemas.STATUS)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_reports(spark: SparkSession, path: str, stage: str, pattern: str = r"([^/._]+)[^/]*$") -> DataFrame:
    """Whole-text reports, one row per file; the run is what ``pattern`` finds in the path, by default the file name up
    to the first dot or ``_screen``.

    One report is one small text file; a report never spans files, and every file is read whole.
    """
    name = F.regexp_extract("_metadata.file_path", pattern, 1)
    return (spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
            .select(name.alias("srr"), F.lit(stage).alias("stage"), F.col("value").alias("body")))
