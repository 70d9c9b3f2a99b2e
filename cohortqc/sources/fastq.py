"""FASTQ input: a batch data source for compressed files and a splittable reader for plain ones.

Folders are read by Spark's text source, so any file system Spark knows will do. A compressed file is one split, and its
lines are put together to reads where they are read. Plain text is cut by Spark's own splits, so one huge file is read by
many tasks: a first pass counts the lines of every split and keeps the few at its borders, and the second puts the reads
together inside each split, knowing the number of its first line. Only the lines of reads that straddle a border are
exchanged. Small plain files, of which a cohort has very many, come whole from Spark's binary source: opening one as text
costs more than reading it. A folder is listed once. ``format("fastq")`` reads single files and literal text.
"""
from __future__ import annotations

import codecs
import gzip
import re
from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition
from pyspark.sql.types import StructType

from cohortqc import schemas
from cohortqc.functions.reads import BLANKS, decode
from cohortqc.session import BROADCAST_ROWS, written

# ---- Fixed values: accepted names, <run>.fastq.gz for single files, <run>_1 and <run>_2 for mates. ----------------
FILE_NAME = r"(?:^|/)([^/_]+)(?:_([12]))?\.f(?:ast)?q(?:\.gz)?$"
ANY_FASTQ = r"\.f(?:ast)?q(?:\.gz)?$"
BATCH_READS = 16_384
# plain files up to this size (bytes) are read whole
SMALL_FILE = 1 << 20
# tasks for each core that list folders; Spark would take one for each folder
LISTING_TASKS = 8
# small files of a task, and their bytes: Spark alone would give a task 32 files
TASK_FILES, TASK_BYTES = 1_000, 32 << 20


class FastqFile(InputPartition):
    def __init__(self, path: str | None, srr: str, mate: int, text: str | None = None):
        self.path, self.srr, self.mate, self.text = path, srr, mate, text


class FastqReader(DataSourceReader):
    """Four lines are one read. A trailing group that lacks both sequence and quality is no read."""

    def __init__(self, options: dict):
        self.options = options
        self.first_only = False

    def pushFilters(self, filters):
        """Accept ``read_no = 0``: the probe for a file's first read then stops after four lines."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("read_no",) and f.value == 0:
                self.first_only = True
            else:
                yield f

    def partitions(self):
        if "text" in self.options:
            return [FastqFile(None, self.options.get("srr", "text"), int(self.options.get("mate", 1)),
                              self.options["text"])]
        pattern = self.options.get("pattern", FILE_NAME)
        return [FastqFile(path, m.group(1), int(m.group(2) or 1))
                for path in self.options["path"].split(",") if (m := re.search(pattern, path))]

    def _lines(self, part: FastqFile):
        if part.text is not None:
            yield from part.text.encode("utf-8").splitlines(keepends=True)
            return
        path = re.sub(r"^file:/+", "/", part.path)
        if re.match(r"^[a-z0-9]+:/", path):  # any other file system goes through Arrow's
            from pyarrow import fs
            system, inner = fs.FileSystem.from_uri(path)
            raw = system.open_input_stream(inner, compression=None)
        else:
            raw = open(path, "rb")
        with raw, (gzip.open(raw, "rb") if path.endswith(".gz") else raw) as lines:
            yield from lines

    def read(self, partition: FastqFile):
        def clean(value):
            return None if value is None else value.decode("ascii", errors="ignore").strip()

        def batch(start, rows):
            h1, seq, h2, qual = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays([
                pa.array([partition.srr] * n, pa.string()), pa.array([partition.mate] * n, pa.int32()),
                pa.array(range(start, start + n), pa.int64()),
                *(pa.array([clean(v) for v in col], pa.string()) for col in (h1, seq, h2, qual))],
                names=schemas.READS.names)

        lines = iter(self._lines(partition))
        rows, start = [], 0
        for record in zip_longest(*[lines] * 4):
            if record[1] is None and record[3] is None:
                continue
            rows.append(record)
            if self.first_only:
                break
            if len(rows) == BATCH_READS:
                yield batch(start, rows)
                start, rows = start + len(rows), []
        if rows:
            yield batch(start, rows)


class FastqDataSource(DataSource):
    """Options: ``path`` (comma-separated files) and ``pattern`` (run and mate in a file name), or literal ``text`` with
    ``srr`` and ``mate``."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self) -> StructType:
        return schemas.READS

    def reader(self, schema):
        return FastqReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``format("fastq")`` known to a session. Spark refuses sources that accept filters unless they are enabled."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FastqDataSource)


def _run_and_mate(pattern: str):
    mate = F.nullif(F.regexp_extract("path", pattern, 2), F.lit("")).cast("int")
    return F.regexp_extract("path", pattern, 1).alias("srr"), mate


@dataclass
class Folder:
    """The files of a folder, listed once: ``names`` (path, size) as a written table, ``content`` as Spark's binary source
    gives it."""

    path: str
    content: DataFrame
    names: DataFrame


def folder_of(spark: SparkSession, folder: str | Folder) -> Folder:
    if isinstance(folder, Folder):
        return folder
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tasks = spark.conf.get(setting), LISTING_TASKS * spark.sparkContext.defaultParallelism
    spark.conf.set(setting, str(tasks))
    try:
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    finally:
        spark.conf.set(setting, before)
    names = content.select("path", F.col("length").alias("size")).coalesce(tasks)
    return Folder(folder, content, written(names, "fastq-names"))


def list_files(spark: SparkSession, folder: str | Folder, pattern: str = FILE_NAME) -> DataFrame:
    """Names and sizes of the FASTQ files of a folder; the content is not read."""
    srr, mate = _run_and_mate(pattern)
    return (folder_of(spark, folder).names.where(F.col("path").rlike(pattern))
            .select("path", "size", srr, mate.alias("mate")))


def unfit_files(spark: SparkSession, folder: str | Folder, pattern: str = FILE_NAME) -> DataFrame:
    """FASTQ files of a folder whose names tell no run; they are read by nothing."""
    return folder_of(spark, folder).names.where(F.col("path").rlike(ANY_FASTQ) & ~F.col("path").rlike(pattern))


def file_roles(files: DataFrame) -> DataFrame:
    """Per run: paired or single, and the sizes of each mate's files together. Names match the run exactly, never by
    prefix."""
    return files.groupBy("srr").agg(
        F.bool_or(F.col("mate").isNotNull()).alias("paired"),
        F.sum(F.when(F.coalesce("mate", F.lit(1)) == 1, F.col("size"))).alias("size1"),
        F.sum(F.when(F.col("mate") == 2, F.col("size"))).alias("size2"))


def missing_runs(manifest: DataFrame, roles: DataFrame) -> DataFrame:
    """Runs of the manifest without any file."""
    return manifest.join(roles, "srr", "left_anti").select("srr").distinct()


RECORDS = "path string, read_no long, h1 string, seq string, h2 string, qual string"


def _assemble(batches):
    """Lines of whole files, in order, to records of four; a file's last record may lack lines."""
    path, lines, read_no = None, [], 0

    def records(final: bool):
        nonlocal lines, read_no
        n = -(-len(lines) // 4) if final else len(lines) // 4
        taken = lines[:4 * n] + [None] * (4 * n - len(lines))
        lines = lines[4 * n:]
        columns = [taken[i::4] for i in range(4)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array([path] * n, pa.string()), pa.array(range(read_no, read_no + n), pa.int64()),
             *[pa.array(c, pa.string()) for c in columns]], names=["path", "read_no", "h1", "seq", "h2", "qual"])
        read_no += n
        return batch

    for batch in batches:
        paths = batch.column("path").dictionary_encode()
        values = batch.column("value").to_pylist()
        names, codes = paths.dictionary.to_pylist(), paths.indices.to_numpy()
        at = 0
        while at < len(values):
            end = at + 1
            while end < len(values) and codes[end] == codes[at]:
                end += 1
            if names[codes[at]] != path:
                if lines:
                    yield records(final=True)
                path, lines, read_no = names[codes[at]], [], 0
            lines += values[at:end]
            at = end
        if lines:
            yield records(final=False)
    if lines:
        yield records(final=True)


def _named(records: DataFrame, pattern: str) -> DataFrame:
    srr, mate = _run_and_mate(pattern)
    return (records.where("seq IS NOT NULL OR qual IS NOT NULL")
            .select("path", srr, F.coalesce(mate, F.lit(1)).alias("mate"), "read_no", "h1", "seq", "h2", "qual"))


# glob patterns for names that end in .gz, and for all others
ZIPPED, PLAIN = "*.gz", "{*[!z],*[!g]z,*[!.]gz}"
# lines of a read that a split border can leave on either side
BORDER_LINES = 3


def _text_lines(spark: SparkSession, paths, glob: str, pattern: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(paths)
            .where(F.col("_metadata.file_path").rlike(pattern)))


def _zipped_records(spark: SparkSession, paths, pattern: str) -> DataFrame:
    lines = _text_lines(spark, paths, ZIPPED, pattern).select(
        F.col("_metadata.file_path").alias("path"), decode(F.col("value")).alias("value"))
    return _named(lines.mapInArrow(_assemble, RECORDS), pattern)


NOT_ASCII, BLANK_BYTES = bytes(range(128, 256)), BLANKS.encode()


def _lines_of(content: bytes) -> list[bytes]:
    """Lines as Spark's text source cuts them, as ``decode`` leaves them."""
    text = content.removeprefix(codecs.BOM_UTF8).translate(None, NOT_ASCII)
    return [line.strip(BLANK_BYTES) for line in text.splitlines()]


def _whole_files(batches):
    """Small files to records of four lines; a file's last record may lack lines."""
    columns = [[] for _ in range(6)]

    def taken():
        types = [pa.string(), pa.int64(), *[pa.string()] * 4]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                           names=["path", "read_no", "h1", "seq", "h2", "qual"])
        for c in columns:
            c.clear()
        return batch

    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            lines = _lines_of(content.as_py())
            n = -(-len(lines) // 4)
            lines += [None] * (4 * n - len(lines))
            for c, values in zip(columns, ([path.as_py()] * n, range(n), *[lines[i::4] for i in range(4)])):
                c.extend(values)
            if len(columns[0]) >= BATCH_READS:
                yield taken()
    if columns[0]:
        yield taken()


def _count_files(batches):
    """The number of reads of small files: a last group of one line has neither sequence nor quality and is no read."""
    for batch in batches:
        lines = [len(content.as_py().splitlines()) for content in batch.column("content")]
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([(n + 2) // 4 for n in lines], pa.int64())], names=["path", "n"])


def _whole_records(files: Folder, pattern: str, n_tasks: int) -> tuple[DataFrame, DataFrame]:
    """Records of small plain files, and the number of reads of every file (path, n). Names and sizes are seen before a
    file is opened."""
    name = F.col("_metadata.file_path")
    small = files.content.where((F.col("length") <= SMALL_FILE) & ~name.endswith(".gz") & name.rlike(pattern)).select(
        name.alias("path"), "content").coalesce(n_tasks)
    return _named(small.mapInArrow(_whole_files, RECORDS), pattern), small.mapInArrow(_count_files, "path string, n long")


SPLIT = ("path", "block", "size")


def _split_lines(spark: SparkSession, paths, pattern: str, above: int = -1) -> DataFrame:
    """Lines of files larger than ``above`` with the split they come from; a task reads the lines of a split in order."""
    return _text_lines(spark, paths, PLAIN, pattern).where(F.col("_metadata.file_size") > above).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("size"), "value")


def _by_split(batches, columns=()):
    """Runs of rows of one split: its key, further columns of its first row, and the values."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column("path").dictionary_encode().indices.to_numpy()
        block = batch.column("block").to_numpy()
        values = batch.column("value").to_pylist()
        starts = [0, *(np.flatnonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1])) + 1).tolist()]
        for at, end in zip(starts, [*starts[1:], len(values)]):
            yield tuple(batch.column(c)[at].as_py() for c in (*SPLIT, *columns)), values[at:end]


BORDERS = "path string, block long, size long, n long, head array<string>, tail array<string>"


def _count_split(batches):
    """One row per split: how many lines, the first three and the last three."""
    def row(key, n, head, tail):
        return pa.RecordBatch.from_pylist([dict(zip(SPLIT, key), n=n, head=head, tail=tail)], schema=pa.schema([
            ("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("n", pa.int64()),
            ("head", pa.list_(pa.string())), ("tail", pa.list_(pa.string()))]))

    now, n, head, tail = None, 0, [], []
    for key, values in _by_split(batches):
        if key != now:
            if now is not None:
                yield row(now, n, head, tail)
            now, n, head, tail = key, 0, [], []
        n += len(values)
        head = (head + values[:BORDER_LINES])[:BORDER_LINES]
        tail = (tail + values[-BORDER_LINES:])[-BORDER_LINES:]
    if now is not None:
        yield row(now, n, head, tail)


def _inside_split(batches):
    """Reads that lie in one split whole. ``before`` tells how many lines of the file come before the split; the lines
    in front of its first read and behind its last belong to the borders."""
    now, skip, line_no, lines = None, 0, 0, []
    for (path, block, size, before), values in _by_split(batches, ("before",)):
        if (path, block, size) != now:
            now, skip, lines = (path, block, size), -before % 4, []
            line_no = before + skip
        lines += values[skip:]
        skip = max(0, skip - len(values))
        n = len(lines) // 4
        if n:
            taken, lines = lines[:4 * n], lines[4 * n:]
            first = line_no // 4
            line_no += 4 * n
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                 *[pa.array(taken[i::4], pa.string()) for i in range(4)]],
                names=["path", "read_no", "h1", "seq", "h2", "qual"])


def _border_lines(borders: DataFrame) -> DataFrame:
    """path, line_no, value: the lines of reads that no split holds whole, the last of a file among them if it lacks
    lines. ``borders`` has ``before``, the number of lines in front of the split."""
    before, n = F.col("before"), F.col("n")
    begun = F.least(F.pmod(-before, F.lit(4)), n)
    left = F.least(F.pmod(before + n, F.lit(4)), n - begun)
    lines = F.concat(
        F.transform(F.slice("head", F.lit(1), begun.cast("int")), lambda v, i: F.struct((before + i).alias("line_no"), v.alias("value"))),
        F.transform(F.slice("tail", F.size("tail") - left.cast("int") + 1, left.cast("int")),
                    lambda v, i: F.struct((before + n - left + i).alias("line_no"), v.alias("value"))))
    return borders.select("path", F.inline(lines))


def _records(lines: DataFrame) -> DataFrame:
    """Numbered lines to records of four."""
    slot = F.col("line_no") % 4
    return lines.groupBy("path", F.expr("line_no div 4").alias("read_no")).agg(
        *[F.max(F.when(slot == i, decode(F.col("value")))).alias(c) for i, c in enumerate(("h1", "seq", "h2", "qual"))])


def _plain_records(spark: SparkSession, paths, pattern: str, max_rows: int = BROADCAST_ROWS,
                   above: int = -1) -> tuple[DataFrame, DataFrame]:
    """Records of plain files, and the number of reads of every file (path, n).

    The first pass leaves one row per split; a running sum of their counts gives every split the number of its first
    line, so no guess about where a read starts is needed. These rows go to the lines of the second pass if they are few
    enough (a million splits are 128 TB); else every line is numbered and reads are put together by a shuffle.
    """
    lines = _split_lines(spark, paths, pattern, above)
    counted = written(lines.mapInArrow(_count_split, BORDERS), "fastq-splits")
    ahead = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    borders = counted.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    # a last group of one line has neither sequence nor quality and is no read
    total = F.sum("n")
    reads = counted.groupBy("path").agg((F.floor(total / 4) + (total % 4 >= 2).cast("bigint")).alias("n"))
    offsets = borders.select(*SPLIT, "before")
    if counted.count() > max_rows:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        first = numbered.groupBy(*SPLIT).agg(F.min("at").alias("first_at")).join(offsets, list(SPLIT))
        numbered = numbered.join(first, list(SPLIT)).withColumn("line_no", F.col("before") + F.col("at") - F.col("first_at"))
        return _named(_records(numbered), pattern), reads
    # splits that the first pass did not see would be lost without a word
    known = F.coalesce("before", F.raise_error(F.lit("the splits changed between two passes over the files")).cast("bigint"))
    whole = lines.join(F.broadcast(offsets), list(SPLIT), "left").select(
        *SPLIT, known.alias("before"), decode(F.col("value")).alias("value")).mapInArrow(_inside_split, RECORDS)
    return _named(whole.unionByName(_records(_border_lines(borders))), pattern), reads


def _numbered(records: DataFrame, counts: DataFrame, pattern: str) -> DataFrame:
    """Read numbers over all part files of a run and mate, in the order of their names. ``counts`` has a row per file,
    which goes to the records if the files are few enough."""
    srr, mate = _run_and_mate(pattern)
    files = written(counts.select("path", srr, F.coalesce(mate, F.lit(1)).alias("mate"), "n"), "fastq-files")
    before = W.partitionBy("srr", "mate").orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    offsets = files.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    small = files.count() <= BROADCAST_ROWS
    return records.join(F.broadcast(offsets) if small else offsets, "path").select(
        "srr", "mate", (F.col("read_no") + F.col("before")).alias("read_no"), "h1", "seq", "h2", "qual")


def _file_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def read_plain(spark: SparkSession, paths, pattern: str = FILE_NAME, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Plain-text FASTQ, split inside files. More splits than ``max_rows`` are put together by a shuffle."""
    return _numbered(*_plain_records(spark, paths, pattern, max_rows), pattern)


def read_fastq(spark: SparkSession, folder: str | Folder, pattern: str = FILE_NAME) -> DataFrame:
    """Reads of all FASTQ files of a folder, compressed or plain; files whose names do not fit are left out
    (``unfit_files`` names them). Spark lists the files."""
    files = folder_of(spark, folder)
    kind = F.when(F.col("path").endswith(".gz"), "zipped").when(F.col("size") <= SMALL_FILE, "whole").otherwise("split")
    found = list_files(spark, files, pattern).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    kinds = {row.kind: row for row in found.collect()}  # three rows at most
    if not kinds:
        raise ValueError(f"no FASTQ files under {files.path}")
    parts = []
    if "zipped" in kinds:
        zipped = _zipped_records(spark, files.path, pattern)
        parts.append((zipped, _file_counts(zipped)))
    if "whole" in kinds:
        small = kinds["whole"]
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts.append(_whole_records(files, pattern, max(least, small["n"] // TASK_FILES, small["size"] // TASK_BYTES)))
    if "split" in kinds:
        parts.append(_plain_records(spark, files.path, pattern, above=SMALL_FILE))
    records, counts = (reduce(DataFrame.unionByName, kind) for kind in zip(*parts))
    return _numbered(records, counts, pattern)
