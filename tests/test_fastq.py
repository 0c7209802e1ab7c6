import bz2
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from seqloom.sources import fastq as Q
from seqloom.sources import io as S

FASTQ = "@r1 1:N:0\nACGT\n+\nIIII\n@r2\nGG\n+\n##\n@r3 x y\n\n+\n\n@cut\nAC\n"
WANT = [(0, "r1", "1:N:0", "ACGT", "IIII"), (1, "r2", "", "GG", "##"), (2, "r3", "x y", "", "")]


def rows(df, name=""):
    return sorted((r["ord"], r["read_id"], r["comment"], r["seq"], r["qual"]) for r in df.collect() if r["file"].endswith(name))


def test_plain_and_packed_files(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(FASTQ)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(FASTQ[:30].encode()) + gzip.compress(FASTQ[30:].encode()))
    (tmp_path / "c.fastq.bz2").write_bytes(bz2.compress(FASTQ.encode()))
    (tmp_path / "d.fastq").write_text(FASTQ.replace("\n", "\r\n"))
    (tmp_path / "e.fastq").write_text(FASTQ[: FASTQ.index("@cut")].rstrip("\n"))
    (tmp_path / "empty.fastq").write_text("")
    (tmp_path / "_hidden.fastq").write_text(FASTQ)
    df = Q.read_fastq(spark, str(tmp_path))
    assert {os.path.basename(r["file"]) for r in df.select("file").distinct().collect()} == {"a.fastq", "b.fastq.gz", "c.fastq.bz2", "d.fastq", "e.fastq"}
    for name in ("a.fastq", "b.fastq.gz", "c.fastq.bz2", "d.fastq"):
        assert rows(df, name) == WANT
    assert rows(df, "e.fastq") == WANT[:2]  # the third's empty last line is not there
    assert rows(Q.read_fastq(spark, f"file://{tmp_path}/a*.fastq", f"file:{tmp_path}/c.fastq.bz2")) == sorted(WANT * 2)


def tricky(n, seed):
    """Reads whose qualities are full of @ and +, of many lengths, some empty."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        size = r.choice([0, 1, 2, 5, 30])
        qual = "".join(r.choice("@@+I") for _ in range(size))
        out.append((f"r{k}", r.choice(["", "@x +", "+"]), "".join(r.choice("ACGTN") for _ in range(size)), qual))
    return out


@pytest.mark.parametrize("size", [1, 7, 37, 200, 5000])
def test_ranges_find_their_first_record(spark, tmp_path, size):
    reads = tricky(150 if size == 1 else 400, size)
    text = "".join(f"@{i}{' ' * bool(c)}{c}\n{s}\n+{i if len(s) % 2 else ''}\n{q}\n" for i, c, s, q in reads)
    (tmp_path / "a.fastq").write_text(text + "@cut\nAC\n")
    splits = Q.FastqReader({"path0": str(tmp_path / "a.fastq"), "splitbytes": str(size)}).partitions()
    assert len(splits) == -(-(len(text) + 8) // size) and splits[0].start == 0 and all(a.end == b.start for a, b in zip(splits, splits[1:], strict=False))
    got = [tuple(r.values()) for s in splits for b in Q.split_records(s) for r in b.to_pylist()]
    assert [x[2:] for x in got] == reads
    assert [x[1] for x in got] == sorted({x[1] for x in got})
    if size > 30:
        df = Q.read_fastq(spark, str(tmp_path / "a.fastq"), split_bytes=size)
        assert [x[1:] for x in rows(df)] == reads
        assert rows(Q.number_reads(df)) == [(k, *x) for k, x in enumerate(reads)]
        assert not any("mapIn" in x for x in df._jdf.queryExecution().executedPlan().toString().splitlines())


@pytest.mark.parametrize("size", [1, 37, 200])
def test_short_ranges_are_read_in_one_go(tmp_path, size):
    reads = tricky(300, size)
    (tmp_path / "a.fastq").write_text("".join(f"@{i}{' ' * bool(c)}{c}\n{s}\n+\n{q}\n" for i, c, s, q in reads)[:-1])
    options = {"path0": str(tmp_path / "a.fastq"), "splitbytes": str(size)}
    alone = Q.FastqReader(options).partitions()
    for tasks in (1, 5, 10**9):
        splits = Q.FastqReader(options | {"tasks": str(tasks)}).partitions()
        assert len(splits) <= 2 * tasks and sum(s.ranges for s in splits) == len(alone)
        assert [r for s in splits for b in Q.split_records(s) for r in b.to_pylist()] == [r for s in alone for b in Q.split_records(s) for r in b.to_pylist()]


def test_a_short_range_reads_few_bytes(tmp_path, monkeypatch):
    (tmp_path / "a.fastq").write_text("@r\nACGT\n+\nIIII\n" * 100_000)
    read, opened = [], Q.opened

    def counted(path):
        stream = opened(path)
        plain = stream.read

        class Counted:
            seek = staticmethod(stream.seek)

            def __enter__(self):
                return self

            def __exit__(self, *_):
                stream.close()

            def read(self, n):
                read.append(n)
                return plain(n)

        return Counted()

    monkeypatch.setattr(Q, "opened", counted)
    for split in Q.FastqReader({"path": str(tmp_path / "a.fastq"), "splitbytes": "16384"}).partitions()[:20]:
        assert list(Q.split_records(split))
    assert sum(read) < 20 * 4 * 16384


def test_blocks_smaller_than_records(tmp_path, monkeypatch):
    reads = tricky(60, 3)
    (tmp_path / "a.fastq").write_text("".join(f"@{i}{' ' * bool(c)}{c}\n{s}\n+\n{q}\n" for i, c, s, q in reads))
    for block in (1, 3, 64):
        monkeypatch.setattr(Q, "BLOCK", block)
        for size in (13, 101):
            splits = Q.FastqReader({"path": str(tmp_path / "a.fastq"), "splitbytes": str(size)}).partitions()
            assert [tuple(r.values())[2:] for s in splits for b in Q.split_records(s) for r in b.to_pylist()] == reads


def test_files_that_are_not_there_or_not_fastq(spark, tmp_path):
    with pytest.raises(Exception, match="nothing.fastq"):
        Q.read_fastq(spark, str(tmp_path / "nothing.fastq")).collect()
    (tmp_path / "x.fastq").write_text("no reads in here\n" * 50)
    with pytest.raises(Exception, match="no FASTQ record"):
        Q.read_fastq(spark, str(tmp_path / "x.fastq"), split_bytes=100).collect()


def test_pairs_need_numbers_without_gaps(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"l_R{k}.fastq").write_text("".join(f"@r{i} {k}\n{'ACGT' * k}\n+\n{'IIII' * k}\n" for i in range(200)))
    ones, twos = (Q.read_fastq(spark, str(tmp_path / f"l_R{k}.fastq"), split_bytes=900).withColumn("file_prefix", F.lit("l")) for k in (1, 2))
    with pytest.raises(Exception, match="number_reads"):
        S.pair_reads(ones, twos).collect()
    pairs = S.pair_reads(Q.number_reads(ones), Q.number_reads(twos)).collect()
    assert sorted((p["r1_name"], p["r2_name"]) for p in pairs) == sorted((f"r{i} 1", f"r{i} 2") for i in range(200))


def demuxed(spark, n=300):
    rows = [(f"lane{i % 2}", [None, "L1", "no_match", "a/b"][i % 4], i, f"r{i} 1", "AC" * (i % 3), "I#" * (i % 3), f"r{i} 2", "G", "J") for i in range(n)]
    return spark.createDataFrame(rows, "file_prefix string, barcode string, ord long, r1_name string, r1_seq string, r1_qual string, r2_name string, r2_seq string, r2_qual string")


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_round_trip_of_pairs(spark, tmp_path, compression):
    path = str(tmp_path / "out")
    Q.write_demux(demuxed(spark), path, files=3, compression=compression)
    names = sorted(os.listdir(path))
    assert "_SUCCESS" in names and "_temporary" not in names
    files = [x for x in names if x[0] != "_"]
    assert {x.split(".")[0] for x in files} == {f"lane0_{b}_R{k}" for b in ("none", "no_match") for k in (1, 2)} | {f"lane1_{b}_R{k}" for b in ("L1", "a_b") for k in (1, 2)}
    for x in files:  # the mates of a file are in the same order
        if "_R1." in x:
            one, two = ([r["read_id"] for r in Q.read_fastq(spark, f"{path}/{y}").orderBy("ord").collect()] for y in (x, x.replace("_R1.", "_R2.")))
            assert one == two and one == sorted(one, key=lambda i: int(i[1:]))
    back = Q.read_fastq(spark, path).filter("comment = '1'")
    assert sorted((r["read_id"], r["seq"], r["qual"]) for r in back.collect()) == sorted((f"r{i}", "AC" * (i % 3), "I#" * (i % 3)) for i in range(300))


def test_single_reads_and_none(spark, tmp_path):
    one = demuxed(spark).select("file_prefix", "barcode", "ord", F.col("r1_name").alias("name"), F.col("r1_seq").alias("seq"), F.col("r1_qual").alias("qual"))
    Q.write_demux(one, str(tmp_path / "one"))
    assert Q.read_fastq(spark, str(tmp_path / "one")).count() == 300
    Q.write_demux(one.filter("ord < 0"), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == ["_SUCCESS"]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    path = tmp_path / "out"
    bad = demuxed(spark).withColumn("r2_seq", F.when(F.col("ord") == 299, F.raise_error(F.lit("broken read"))).otherwise(F.col("r2_seq")))
    with pytest.raises(Exception, match="broken read"):
        Q.write_demux(bad, str(path))
    assert [f for _, _, names in os.walk(path) for f in names] == []


def test_a_writer_that_fails_removes_its_own_files(tmp_path):
    import pyarrow as pa

    def batches():
        yield pa.RecordBatch.from_pydict({"file_prefix": ["p"], "barcode": ["b"], "mate": [1], "name": ["x"], "seq": ["A"], "qual": ["I"]})
        assert any(names for _, _, names in os.walk(tmp_path))
        raise RuntimeError("lost")

    class Context:
        partitionId = taskAttemptId = staticmethod(lambda: 3)

    writer, old = Q.FastqWriter({"path": str(tmp_path / "out")}), Q.TaskContext.get
    try:
        Q.TaskContext.get = staticmethod(Context)
        with pytest.raises(RuntimeError):
            writer.write(batches())
    finally:
        Q.TaskContext.get = old
    assert not [f for _, _, names in os.walk(tmp_path) for f in names]


def test_writing_over_a_folder_is_refused(spark, tmp_path):
    (tmp_path / "out").mkdir()
    with pytest.raises(Exception, match="out"):
        Q.write_demux(demuxed(spark), str(tmp_path / "out"))


def test_packed_files_take_the_quick_level(spark, tmp_path):
    reads = spark.createDataFrame([("l", "AC", 0, "r0", "ACGT" * 9, "I" * 36)], "file_prefix string, barcode string, ord long, name string, seq string, qual string")
    Q.write_demux(reads, str(tmp_path / "out"), compression="gzip")
    (file,) = (tmp_path / "out").glob("*.gz")
    packed = file.read_bytes()
    assert packed[8] == 4  # made for speed, says the header
    assert gzip.decompress(packed).decode() == f"@r0\n{'ACGT' * 9}\n+\n{'I' * 36}\n"


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_pairs_of_files_are_read_in_step(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(Q, "BLOCK", block)
    one = [(f"r{i} 1", "AC" * (i % 4), "I#" * (i % 4)) for i in range(50)] + [("café 1", "GG", "@+")]
    two = [(f"r{i} 2", "G", "J" * (i % 3)) for i in range(50)] + [("", "T", "I")]
    (tmp_path / "l_R1.0.fastq").write_bytes("".join(f"@{n}\r\n{s}\r\n+{n}\r\n{q}\r\n" for n, s, q in one)[:-2].encode())  # the last line has no end
    (tmp_path / "l_R2.0.fastq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in two) + "@cut\nAC\n")
    got = [r for b in Q.split_pairs(*(str(tmp_path / f"l_R{k}.0.fastq") for k in (1, 2))) for r in b.to_pylist()]
    assert [(r["r1_name"], r["r1_seq"], r["r1_qual"]) for r in got] == one and [(r["r2_name"], r["r2_seq"], r["r2_qual"]) for r in got] == two
    assert [r["ord"] for r in got] == list(range(51))


def test_bytes_that_are_no_text_are_read_in_pairs(tmp_path):
    for k in (1, 2):
        (tmp_path / f"x_R{k}.fastq").write_bytes(b"@n\xff\nAC\n+\n\xe9I\n")
    (batch,) = Q.split_pairs(str(tmp_path / "x_R1.fastq"), str(tmp_path / "x_R2.fastq"))
    assert batch.to_pylist()[0] | {"file": ""} == {"file": "", "ord": 0} | {f"r{k}_{c}": x for k in (1, 2) for c, x in (("name", "n�"), ("seq", "AC"), ("qual", "�I"))}


def test_files_that_are_no_pairs_are_refused(spark, tmp_path):
    (tmp_path / "a_R1_x.fastq").write_text("@r\nA\n+\nI\n" * 3)
    with pytest.raises(Exception, match="a_R"):
        Q.read_fastq_pairs(spark, str(tmp_path)).collect()
    (tmp_path / "a_R2_x.fastq").write_text("@r\nA\n+\nI\n" * 2)
    with pytest.raises(Exception, match="different numbers of reads"):
        Q.read_fastq_pairs(spark, str(tmp_path)).collect()
    (tmp_path / "other.fastq").write_text("")
    with pytest.raises(Exception, match="other"):
        Q.read_fastq_pairs(spark, str(tmp_path)).collect()
    assert Q.mate_of("/x/p_R1_R1.0.fastq") == "/x/p_R1_R2.0.fastq" and Q.mate_of("/x/p_R1_R2.0.fastq") is None and Q.mate_of("/x_R1/p.fastq") is None


@pytest.mark.parametrize("dealt", [True, False])
def test_buckets_of_one_file_name_are_kept(spark, tmp_path, dealt):
    barcodes = [None, "none", "", "a/b", "a_b", "a0"]
    rows = [("l", barcodes[i % 6], i, f"r{i} 1", "AC", "I#", f"r{i} 2", "G", "J") for i in range(120)]
    reads = spark.createDataFrame(rows, "file_prefix string, barcode string, ord long, r1_name string, r1_seq string, r1_qual string, r2_name string, r2_seq string, r2_qual string")
    Q.write_demux(reads.coalesce(2), str(tmp_path / "out"), files=1, compression="gzip", dealt=dealt)
    back = Q.read_fastq_pairs(spark, str(tmp_path / "out")).collect()
    assert sorted((r["r1_name"], r["r2_name"]) for r in back) == sorted((f"r{i} 1", f"r{i} 2") for i in range(120))
    assert {r["file"].split("/")[-1].split("_R1")[0] for r in back} == {"l_none", "l_a_b", "l_a0"}
    for own in {r["file"] for r in back}:  # in order
        numbers = [int(r["r1_name"][1:-2]) for r in sorted((r for r in back if r["file"] == own), key=lambda r: r["ord"])]
        assert numbers == sorted(numbers)


def test_a_writer_of_many_buckets_has_few_files_open(tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(Q, "OPEN", 2)
    monkeypatch.setattr(Q.TaskContext, "get", staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 0, "taskAttemptId": lambda self: 0})()))
    reads = [{"file_prefix": "p", "barcode": f"b{i % 3}", "mate": 1, "name": f"r{i}", "seq": "A", "qual": None} for i in range(30)]
    writer = Q.FastqWriter({"path": str(tmp_path / "out")})
    writer.commit([writer.write(pa.RecordBatch.from_pylist(reads[k : k + 5]) for k in range(0, 30, 5))])
    texts = {f.name: f.read_text() for f in (tmp_path / "out").glob("*.fastq")}
    assert len(texts) > 3 and "".join(texts.values()).count("@") == 30
    assert {x for name, text in texts.items() for x in text.split("\n") if x[:1] == "@" and int(x[2:]) % 3 != int(name[3])} == set()


def test_mates_meet_without_a_shuffle(spark):
    from seqloom.plans import registry

    registry.load()
    plan = registry.QUERIES["s9_write_demux"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
