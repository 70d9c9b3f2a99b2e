"""What the operators share: reading, written intermediate tables, word and letter rules."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.session import shared_folder

# the six characters of [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the folder all executors share: computed once, and still there when an executor
    is lost. Row ids made before it are fixed by it."""
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished queries. Its cleaner acts once the driver's JVM has collected what
    refers to them, and a driver that only plans may put that off until they fill the disk."""
    spark.sparkContext._jvm.System.gc()


def kept_folder(spark: SparkSession, name: str) -> str:
    """A folder of the shared place that stays the same from run to run."""
    return f"{shared_folder(spark, name).rsplit('/', 1)[0]}/{name}"


def doc_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, unsigned; a null id counts as empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def parts(spark: SparkSession, rows: int, per_part: int) -> int:
    """As many parts as rows need at ``per_part`` each, and at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))
