"""Read predicates, pairs, layout, trimming, subset, FASTQ input."""
import gzip
import re
import random

import pytest
from pyspark.sql import functions as F

from cohortqc import schemas
from cohortqc.functions import reads as R
from cohortqc.functions.quality import quality_cut, quality_sum
from cohortqc.operators import reads as O
from cohortqc.sinks import write_clean_fastq
from cohortqc.plans import jobs
from cohortqc.sources import fastq


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, clean", [("  ACé\t", "AC"), ("\x1cA \x0b", "A"), ("A\x00", "A\x00"), (None, None)])
def test_decode(spark, raw, clean):
    assert one(spark, raw, R.decode) == clean


def test_strip_control(spark):
    assert one(spark, "A C\x07G\n", R.strip_control) == "ACG"


@pytest.mark.parametrize("seq, bad", [("ACGTN", False), ("acgtn", False), ("", False), ("ACG.", True), ("ACGT\n", True)])
def test_invalid_seq(spark, seq, bad):
    assert one(spark, seq, R.is_invalid_seq) is bad


@pytest.mark.parametrize("qual, bad", [("!~", False), (" !", True), ("\x7f", True), ("", False)])
def test_invalid_qual(spark, qual, bad):
    assert one(spark, qual, R.is_invalid_qual) is bad


@pytest.mark.parametrize("a, b, different", [
    ("@r.1/1 length=50", "@r.1/2 length=49", False), ("@r.1/1", "@r.2/2", True), ("@r.1", "@r.10", True),
    ("@r.1", "@r.1", False)])
def test_different_header(spark, a, b, different):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(R.is_different_header(F.col("a"), F.col("b")))
    assert row.first()[0] is different


def test_abi(spark):
    assert one(spark, "T120202210232000020002.00301000012.100...00........", R.is_abi) is True
    assert one(spark, "TACGT", R.is_abi) is False


def test_headers_pass_unless_strict(spark):
    rows = spark.createDataFrame([("@é", "ACGT", "IIII")], "h1 string, seq string, qual string")
    loose = rows.select(R.reject_reason(F.col("h1"), F.col("seq"), F.col("qual"))).first()[0]
    strict = rows.select(R.reject_reason(F.col("h1"), F.col("seq"), F.col("qual"), True)).first()[0]
    assert loose is None and strict == R.BAD_ENCODING


def trim_by_hand(qual, cutoff=20):
    total, best, cut = 0, 0, len(qual)
    for i in range(len(qual) - 1, -1, -1):
        total += cutoff - (ord(qual[i]) - 33)
        if total < 0:
            break
        if total > best:
            best, cut = total, i
    return cut


def test_quality_functions_by_hand(spark):
    rng = random.Random(1)
    quals = ["".join(chr(33 + rng.randint(0, 41)) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    quals += ["", "!", "IIII", "!!!!", None]
    df = spark.createDataFrame(list(enumerate(quals)), "i int, q string").repartition(3)
    got = {r.i: r for r in df.select("i", "q", quality_cut(F.col("q")).alias("n"), quality_sum(F.col("q")).alias("s"),
                                     quality_sum(F.col("q"), 15).alias("s15")).collect()}
    for i, q in enumerate(quals):
        if q is None:
            assert got[i].n is None and got[i].s is None
            continue
        scores = [ord(c) - 33 for c in q]
        assert (got[i].n, got[i].s, got[i].s15) == (trim_by_hand(q), sum(scores), sum(s for s in scores if s >= 15))


def read(srr, mate, no, header=None, seq="ACGT", qual="IIII"):
    return srr, mate, no, header or f"@{srr}.{no}/{mate}", seq, "+", qual


@pytest.fixture(scope="module")
def libraries(spark):
    rows = []
    rows += [read("pe", m, i) for m in (1, 2) for i in range(4)]
    rows += [read("short2", 1, i) for i in range(4)] + [read("short2", 2, i) for i in range(3)]
    rows += [read("short1", 1, i) for i in range(3)] + [read("short1", 2, i) for i in range(4)]
    rows += [read("mixed", 1, i) for i in range(4)] + [read("mixed", 2, i, header=f"@other.{i}") for i in range(3)]
    rows += [read("se", 1, i) for i in range(3)] + [read("se", 1, 3, qual=None), read("se", 1, 4, seq="AC.T"),
                                                     read("se", 1, 5, qual="III")]
    rows += [read("abi", 1, 0, seq="T012.3", qual="IIIIII"), read("abi", 1, 1)]
    reads = spark.createDataFrame(rows, schemas.READS)
    files = spark.createDataFrame(
        [("pe", True, 5000, 5000), ("short2", True, 5000, 5000), ("short1", True, 5000, 5000),
         ("mixed", True, 5000, 6000), ("se", False, 5000, None), ("abi", False, 5000, None),
         ("empty", False, 1000, None)], "srr string, paired boolean, size1 bigint, size2 bigint")
    return reads, files


def test_library_stats(libraries):
    reads, files = libraries
    got = {r.srr: r for r in O.library_stats(reads, files, min_library=3).collect()}
    assert {k: r.layout for k, r in got.items()} == {
        "pe": "PE", "short2": "keep_R1", "short1": "keep_R2", "mixed": "keep_R2", "se": "SE", "abi": "SE", "empty": "SE"}
    assert {k: r.status for k, r in got.items() if r.status != "ok"} == {"abi": "abi_solid", "empty": "download_bad"}
    se = got["se"]
    assert (se.libsize, se.n_incomplete, se.n_bad_encoding, se.n_unequal_length) == (3, 1, 1, 1)
    assert (se.avgLen_R1, se.avgLen_R2) == (4.0, 0.0) and got["pe"].avgLen_R2 == 4.0
    assert got["empty"].avgLen_R1 is None


@pytest.mark.parametrize("least, status", [(4, "ok"), (5, "too_few_reads")])
def test_library_gate(libraries, least, status):
    reads, files = libraries
    assert O.library_stats(reads, files, min_library=least).where("srr = 'pe'").first().status == status


def test_clean_reads_of_kept_mates(libraries):
    reads, files = libraries
    clean = O.clean_reads(reads, O.library_stats(reads, files, min_library=3))
    counts = {(r.srr, r.mate): r["count"] for r in clean.groupBy("srr", "mate").count().collect()}
    assert counts == {("pe", 1): 4, ("pe", 2): 4, ("short2", 1): 4, ("short1", 2): 4, ("mixed", 2): 3, ("se", 1): 3}


def test_trim_gate_boundary(spark):
    rows = spark.createDataFrame([("a", 999), ("b", 1000)], "srr string, total_written bigint")
    assert {r.srr: r.status for r in O.trim_gate(rows).collect()} == {"a": "too_few_reads", "b": "ok"}


def test_paired_trim_counts_templates_once(spark):
    rows = [read("p", 1, 0, seq="A" * 30, qual="I" * 30), read("p", 2, 0, seq="A" * 30, qual="I" * 10 + "!" * 20),
            read("p", 1, 1, seq="A" * 30, qual="I" * 30), read("p", 2, 1, seq="A" * 30, qual="I" * 30)]
    got = O.trim_counts(spark.createDataFrame(rows, schemas.READS), paired=True).first()
    assert (got.total_processed, got.total_written, got.too_short) == (2, 1, 1)


@pytest.mark.parametrize("n", [1, 10, 97, 5000])
def test_subset_is_exact(spark, n):
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("srr"),
                                    F.col("id").alias("read_no"))
    got = {(r.srr, r.read_no) for r in O.subset_reads(rows, n, buckets=16).collect()}
    import hashlib
    want = set()
    for srr, ids in (("hot", range(2900)), ("cold", range(2900, 3000))):
        ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{srr}:{i}".encode()).hexdigest(), i))
        want |= {(srr, i) for i in ranked[:n]}
    assert got == want


def fastq_text(n, tag):
    return "".join(f"@{tag}.{i}\nACGT{'A' * (i % 7)}\n+\nIIII{'I' * (i % 7)}\n" for i in range(n))


def test_fastq_folder(spark, tmp_path):
    with gzip.open(tmp_path / "SRR1_1.fastq.gz", "wt") as f:
        f.write(fastq_text(20_000, "SRR1"))
    with gzip.open(tmp_path / "SRR1_2.fastq.gz", "wt") as f:
        f.write(fastq_text(3, "SRR1") + "@cut\nAC\n")
    (tmp_path / "SRR10.fq").write_text(fastq_text(5, "SRR10") + "@lost\n")
    roles = {r.srr: r for r in fastq.file_roles(fastq.list_files(spark, str(tmp_path))).collect()}
    assert set(roles) == {"SRR1", "SRR10"} and roles["SRR1"].paired and not roles["SRR10"].paired
    reads = fastq.read_fastq(spark, str(tmp_path))
    counts = {(r.srr, r.mate): r["count"] for r in reads.groupBy("srr", "mate").count().collect()}
    assert counts == {("SRR1", 1): 20_000, ("SRR1", 2): 4, ("SRR10", 1): 5}
    assert reads.where("mate = 1 AND h1 <> concat('@', srr, '.', read_no)").count() == 0
    assert reads.where("qual IS NULL").first().h1 == "@cut"
    assert sorted(r.srr for r in reads.where("read_no = 0").collect()) == ["SRR1", "SRR1", "SRR10"]


def test_plain_fastq_is_split_exactly(spark, tmp_path):
    (tmp_path / "SRR2.fastq").write_text(fastq_text(5_000, "SRR2"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9973")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        reads = fastq.read_plain(spark, str(tmp_path / "SRR2.fastq"))
        assert reads.count() == 5_000
        assert reads.where("h1 <> concat('@SRR2.', read_no) OR length(seq) <> length(qual) OR h2 <> '+'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [23, 61, 350, 100_000])
@pytest.mark.parametrize("max_rows", [10 ** 6, 0])
def test_reads_across_split_borders(spark, tmp_path, size, max_rows):
    """Splits shorter than a line and longer than a file; part files of one run, the last one cut off inside a read."""
    texts = {"SRR7_1": fastq_text(9, "SRR7"), "SRR8": fastq_text(3, "SRR8") + "@SRR8.3\nACGT", "SRR9": fastq_text(2, "SRR9") + "\n",
             "SRR10": "@only\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.fastq").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = fastq.read_plain(spark, str(tmp_path), max_rows=max_rows).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = []
    for name, text in texts.items():
        lines = text.splitlines()
        for i in range(0, len(lines), 4):
            record = [*lines[i:i + 4], None, None, None][:4]
            if record[1] is not None or record[3] is not None:
                want.append((name.split("_")[0], 1, i // 4, *record))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_whole_reads_of_plain_files_are_not_shuffled(spark, tmp_path):
    (tmp_path / "SRR2.fastq").write_text(fastq_text(50, "SRR2"))
    (tmp_path / "SRR3.fastq.gz").write_bytes(b"no gzip at all")  # other files are not opened
    reads = fastq.read_plain(spark, str(tmp_path))
    assert reads.count() == 50
    plan = reads._jdf.queryExecution().sparkPlan().toString().splitlines()
    depth = lambda line: len(re.match(r"[ :+\-*]*", line).group())
    at = next(i for i, line in enumerate(plan) if "MapInArrow" in line)
    above, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert not any("Aggregate" in line or "SortMerge" in line or "Exchange" in line for line in above)
    assert any("BroadcastHashJoin" in line for line in above)


def test_literal_text_source(spark):
    fastq.register(spark)
    rows = spark.read.format("fastq").option("text", fastq_text(2, "x")).option("srr", "x").load().collect()
    assert [(r.srr, r.read_no, r.seq) for r in rows] == [("x", 0, "ACGT"), ("x", 1, "ACGTA")]


def test_missing_runs(spark):
    manifest = spark.createDataFrame([("e", "a"), ("e", "b")], "srx string, srr string")
    roles = spark.createDataFrame([("a",)], "srr string")
    assert [r.srr for r in fastq.missing_runs(manifest, roles).collect()] == ["b"]


def test_sink_layout(spark, tmp_path):
    reads = spark.createDataFrame([read("s", 1, i) for i in range(3)], schemas.READS)
    write_clean_fastq(reads, str(tmp_path / "out"))
    [part] = list((tmp_path / "out" / "srr=s" / "mate=1").glob("*.gz"))
    with gzip.open(part, "rt") as f:
        assert f.read() == "".join(f"@s.{i}/1\nACGT\n+\nIIII\n" for i in range(3))


def test_pairs_survive_several_files_per_run(spark, tmp_path):
    n = 6_000
    rows = spark.range(n).selectExpr("'SRRb' AS srr", "explode(array(1, 2)) AS mate", "id AS read_no",
                                     "concat('@r', id) AS h1", "'ACGT' AS seq", "'+' AS h2", "'IIII' AS qual")
    path, pattern = str(tmp_path / "many"), r"srr=([^/]+)/mate=([12])/part-[^/]*\.txt(?:\.gz)?$"
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the writer's partitions, as for a large run
    try:
        write_clean_fastq(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    files = fastq.list_files(spark, path, pattern)
    assert files.where("mate = 1").count() > 1
    role = fastq.file_roles(files).first()
    assert role.size1 == sum(r["size"] for r in files.where("mate = 1").collect())
    back = fastq.read_fastq(spark, path, pattern)
    one, two = (back.where(f"mate = {m}").select("read_no", F.col("h1").alias(f"h{m}")) for m in (1, 2))
    assert one.join(two, "read_no").where("h1 = h2 AND h1 = concat('@r', read_no)").count() == n == one.count()


def test_only_fitting_names_are_read(spark, tmp_path):
    for name in ("SRR1.fastq", "SRR1_R1.fastq", "SRR2_3.fq", "S_A_1.fq"):
        (tmp_path / name).write_text(fastq_text(2, "x"))
    assert {r.srr for r in fastq.read_fastq(spark, str(tmp_path)).collect()} == {"SRR1"}
    unfit = {r.path.rsplit("/", 1)[1] for r in fastq.unfit_files(spark, str(tmp_path)).collect()}
    assert unfit == {"SRR1_R1.fastq", "SRR2_3.fq", "S_A_1.fq"}


def test_a_read_number_held_twice_is_an_error(spark):
    rows = [read("p", 1, 0), read("p", 1, 0), read("p", 2, 0)]
    with pytest.raises(Exception, match="held twice in run p"):
        O.pair_verdicts(spark.createDataFrame(rows, schemas.READS)).collect()


def test_small_files_are_read_whole(spark, tmp_path):
    """Lines end and odd bytes go as in Spark's text source, which reads larger files; a folder of small ones opens none as text."""
    bodies = {"A_1": b"@1\nACGT\n+\nIIII\n@2\n AC\tGT \n+\nII\x0bII", "A_2": b"@1\r\nACGT\r\n+\r\nIIII\r\n@2\r\nAC\r\n",
              "B": b"@1\rACGT\r+\rIIII\r@2", "C": b"\xef\xbb\xbf@1\nA\xc3\xbcC\n+\n\xe2\x82\xacII\n\n\n\n\n", "D": b"", "E": b"@1\nACGT\n+\n"}
    for name, body in bodies.items():
        (tmp_path / f"{name}.fastq").write_bytes(body)
    found = fastq.read_fastq(spark, str(tmp_path))
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted(map(tuple, fastq.read_plain(spark, str(tmp_path)).collect()), key=str) and len(rows) == 8
    assert "FileScan text" not in found._jdf.queryExecution().toString()


def test_small_and_large_files_of_a_run_go_on_counting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fastq, "SMALL_FILE", 100)
    for part, n in (("a", 3), ("b", 40), ("c", 2)):
        folder = tmp_path / f"srr=R/mate=1"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{part}.txt").write_text("".join(f"@{part}{i}\nAC\n+\nII\n" for i in range(n)))
    rows = fastq.read_fastq(spark, str(tmp_path), r"srr=([^/]+)/mate=([12])/part-[^/]*\.txt$").orderBy("read_no").collect()
    assert [(r.read_no, r.h1) for r in rows] == list(enumerate([f"@{p}{i}" for p, n in (("a", 3), ("b", 40), ("c", 2)) for i in range(n)]))


def test_a_folder_is_listed_once(spark, tmp_path, monkeypatch):
    listed = []
    monkeypatch.setattr(fastq, "folder_of", lambda s, f, real=fastq.folder_of: (listed.append(f) if isinstance(f, str) else None, real(s, f))[1])
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "R1.fastq").write_text("@1\nACGT\n+\nIIII\n")
    manifest = spark.createDataFrame([("X", "R1")], "srx string, srr string")
    jobs.qc_reads(spark, str(tmp_path / "in"), manifest, str(tmp_path / "out"), 1, 0)
    assert listed == [str(tmp_path / "in")] and spark.conf.get(setting) == before
