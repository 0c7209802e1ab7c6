"""FASTQ as a Spark data source: byte ranges in, one file per bucket and task out.

The files are opened by workers through pyarrow's file systems (local or mounted folders, HDFS, S3,
GCS), so no line is parsed on the JVM and no list of splits travels with the tasks.
"""

from __future__ import annotations

import bz2
import fnmatch
import gzip
import posixpath
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "file string, ord long, read_id string, comment string, seq string, qual string"
READS = pa.schema([("file", pa.string()), ("ord", pa.int64()), *[(c, pa.string()) for c in ("read_id", "comment", "seq", "qual")]])
#: Places of a split's reads in ``ord``, whose upper bits are the number of the split.
PLACE_BITS = 33
#: Bytes of a file that are read at a time, and of a split.
BLOCK = 4 << 20
SPLIT = 128 << 20
#: Least bytes that are read at a time.
TAIL = 1 << 14
#: Buckets of a task whose files are open at a time.
OPEN = 256


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    local = re.match(r"(?:file:)?/{1,3}(?!/)(.*)", path)
    return (pafs.LocalFileSystem(), "/" + local[1]) if local else pafs.FileSystem.from_uri(path)


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files of a folder, or of those that a pattern in the last part of the path names; in order.

    Hidden files and those whose names start with ``_`` are passed over.
    """
    fs, inner = file_system(path)
    folder, name = posixpath.split(inner.rstrip("/"))
    if any(c in name for c in "*?["):
        found = [f for f in fs.get_file_info(pafs.FileSelector(folder)) if fnmatch.fnmatch(f.base_name, name)]
    else:
        (found,) = [fs.get_file_info([inner.rstrip("/")])]
        if found[0].type == pafs.FileType.Directory:
            found = fs.get_file_info(pafs.FileSelector(found[0].path))
    files = [f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
    if not files:
        raise FileNotFoundError(path)
    head = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted((head + f.path, f.size) for f in files)


@dataclass
class Split(InputPartition):
    """Reads that start in the bytes start..end of a file; a packed file is one split.

    The bytes are ``ranges`` ranges of ``step`` bytes, counted from ``number``, which are read in one go.
    """

    path: str
    number: int
    start: int
    end: int
    step: int = 1 << 62
    ranges: int = 1

    def __post_init__(self) -> None:
        self.value = self.number


def packed(path: str) -> bool:
    return path.endswith((".gz", ".bz2"))


def opened(path: str) -> BinaryIO:
    fs, inner = file_system(path)
    if not packed(path):
        return fs.open_input_file(inner)
    stream = fs.open_input_stream(inner, compression=None)
    return gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else bz2.BZ2File(stream)


def line_blocks(stream: BinaryIO, start: int, end: int = 1 << 62) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, lines) of the lines that start at ``start`` or later, in blocks; each line with its end, a last one without.

    Blocks get shorter at ``end``, past which a reader needs no more than a record.
    """
    at = max(0, start - 1)
    if at:
        stream.seek(at)
    skip, rest = start > 0, b""
    while block := stream.read(min(BLOCK, max(TAIL, end - at - len(rest)))):
        data = rest + block
        if skip:  # the line that holds byte start - 1 belongs to the split before
            cut = data.find(b"\n")
            if cut < 0:
                at, rest = at + len(data), b""
                continue
            at, data, skip = at + cut + 1, data[cut + 1 :], False
        cut = data.rfind(b"\n") + 1
        if cut:
            yield at, data[:cut].splitlines(keepends=True) if b"\r" not in data else [x + b"\n" for x in data[:cut].split(b"\n")[:-1]]
        at, rest = at + cut, data[cut:]
    if rest and not skip:
        yield at, [rest]


def record_start(lines: list[bytes]) -> int | None:
    """The first line that begins a record: it starts with ``@``, and the line but one after it with ``+``.

    A quality line may start with ``@`` too, but the line but one after that one is bases. None if the
    lines do not tell.
    """
    for k in range(min(4, len(lines) - 2)):
        if lines[k].startswith(b"@") and lines[k + 2].startswith(b"+"):
            return k
    return None


def split_records(split: Split) -> Iterator[pa.RecordBatch]:
    """The reads of a split, in order; a record that the file ends within is left out."""
    last, nth = -1, 0  # the range of the last read, and how many reads of it have passed

    def placed(starts: np.ndarray, lines: list[bytes]) -> pa.RecordBatch:
        nonlocal last, nth
        number = split.number + np.minimum((starts - split.start) // split.step, split.ranges - 1)
        place = np.arange(len(starts)) - np.searchsorted(number, number) + np.where(number == last, nth, 0)
        last, nth = int(number[-1]), int(place[-1]) + 1
        return records(split, (number << PLACE_BITS) + place, lines)

    with opened(split.path) as stream:
        held: list[bytes] = []
        at, known = split.start, split.start == 0
        for offset, lines in line_blocks(stream, split.start, split.end):
            if not held:
                at = offset
            held += lines
            if not known:
                if (first := record_start(held)) is None:
                    if len(held) > 6:
                        raise ValueError(f"{split.path}: no FASTQ record at byte {at}")
                    continue
                at += sum(map(len, held[:first]))
                held, known = held[first:], True
            whole = len(held) // 4 * 4
            ends = at + np.cumsum(np.fromiter(map(len, held[:whole]), np.int64, whole))[3::4]
            starts = np.concatenate([[at], ends])
            own = int(np.searchsorted(starts[:-1], split.end))
            if own:
                yield placed(starts[:own], held[: 4 * own])
            at, held = int(starts[own]), held[whole:]
            if at >= split.end:
                return
        if known and len(held) == 4 and at < split.end:  # the last line has no end
            yield placed(np.array([at]), held)


def _texts(lines: list[bytes]) -> pa.Array:
    try:
        return pa.array(lines, pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())


def records(split: Split, ords: np.ndarray, lines: list[bytes]) -> pa.RecordBatch:
    head, seq, qual = ([x.rstrip(b"\r\n") for x in lines[k::4]] for k in (0, 1, 3))
    names = [x[1:].partition(b" ") for x in head]
    columns = [pa.repeat(split.path, len(names)), pa.array(ords, pa.int64()), *map(_texts, ([x[0] for x in names], [x[2] for x in names], seq, qual))]
    return pa.RecordBatch.from_arrays(columns, schema=READS)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [options[k] for k in sorted((k for k in options if re.fullmatch(r"path\d+", k)), key=lambda k: int(k[4:]))] or [options["path"]]
        self.size = int(options.get("splitbytes", SPLIT))
        self.tasks = int(options.get("tasks", 0))

    def partitions(self) -> list[Split]:
        files = [f for path in self.paths for f in listed(path)]
        # ranges that a task reads in one go: as many as give each of the wanted tasks its part, up to the usual bytes of a split
        part = min(SPLIT, sum(size for _, size in files) // self.tasks) if self.tasks else 0
        ranges = max(1, part // self.size)
        out = []
        for name, size in files:
            if packed(name):
                out.append(Split(name, 0, 0, 1 << 62))
                continue
            count = max(1, -(-size // self.size))
            for k in range(0, count, ranges):
                n = min(ranges, count - k)
                out.append(Split(name, k, k * self.size, (k + n) * self.size if k + n < count else 1 << 62, self.size, n))
        return out

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return split_records(partition)


# --- pairs of files ---------------------------------------------------------------------------------

PAIRS_SCHEMA = "file string, ord long, " + ", ".join(f"r{k}_{c} string" for k in (1, 2) for c in ("name", "seq", "qual"))
PAIRS = pa.schema([("file", pa.string()), ("ord", pa.int64()), *[(f"r{k}_{c}", pa.string()) for k in (1, 2) for c in ("name", "seq", "qual")]])


def mate_of(path: str) -> str | None:
    """The path of the second mates of a file of first ones, whose name holds ``_R1`` before a dot, ``_`` or its end; else None."""
    folder, name = posixpath.split(path)
    at = [m.start() for m in re.finditer(r"_R[12](?=[._]|$)", name)]
    return f"{folder}/{name[: at[-1]]}_R2{name[at[-1] + 3 :]}" if at and name[at[-1] + 2] == "1" else None


def _cut_lines(data: bytes) -> tuple[list[pa.Array], bytes]:
    """Name, seq and qual of the whole records at the start of ``data``, which ends with a line, and the lines that are left.

    Columns are gathered by Arrow from places that numpy finds, without a Python object a line.
    """
    if not data.isascii():
        data = data.decode("utf-8", "replace").encode()
    text = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(text == 10)
    ends = ends[: len(ends) // 4 * 4]
    if not len(ends):
        return [pa.array([], pa.string())] * 3, data
    after = int(ends[-1]) + 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    while (returns := (ends > starts) & (text[ends - 1] == 13)).any():
        ends = ends - returns
    starts[::4] = np.minimum(starts[::4] + 1, ends[::4])  # without the @
    cuts = np.stack([starts.reshape(-1, 4), ends.reshape(-1, 4)], axis=2)[:, [0, 1, 3]].astype(np.int32).ravel()
    pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
    return [pieces.take(pa.array(np.arange(k, len(cuts), 6))) for k in (0, 2, 4)], data[after:]


def whole_records(path: str) -> Iterator[pa.RecordBatch]:
    """(name, seq, qual) of the reads of a file, in order; a record that the file ends within is left out."""
    with opened(path) as stream:
        rest = b""
        while block := stream.read(BLOCK):
            data = rest + block
            whole = data.rfind(b"\n") + 1  # a character may go on in the next block, no line that has ended does
            columns, lines = _cut_lines(data[:whole])
            rest = lines + data[whole:]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, ["name", "seq", "qual"])
        columns, _ = _cut_lines(rest + b"\n") if rest and not rest.endswith(b"\n") else _cut_lines(b"")
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays(columns, ["name", "seq", "qual"])


def split_pairs(one: str, two: str) -> Iterator[pa.RecordBatch]:
    """The reads of two files, read in step and put side by side."""
    sides, held, nth = [whole_records(one), whole_records(two)], [None, None], 0
    while True:
        held = [b if b is not None and b.num_rows else next(side, None) for b, side in zip(held, sides, strict=True)]
        if None in held:
            if held != [None, None]:
                raise ValueError(f"{one} and {two} hold different numbers of reads")
            return
        n = min(b.num_rows for b in held)
        columns = [c for b in held for c in b.slice(0, n).columns]
        yield pa.RecordBatch.from_arrays([pa.repeat(one, n), pa.array(np.arange(nth, nth + n)), *columns], schema=PAIRS)
        held, nth = [b.slice(n) for b in held], nth + n


@dataclass
class PairSplit(InputPartition):
    """Pairs of files that a task reads after one another."""

    pairs: list[tuple[str, str]]

    def __post_init__(self) -> None:
        self.value = self.pairs[0][0]


class FastqPairsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.tasks = options["path"], int(options.get("tasks", 1))

    def partitions(self) -> list[PairSplit]:
        sizes = dict(listed(self.path))
        twos = {name: two for name in sizes if (two := mate_of(name))}
        if lost := sorted(set(sizes) ^ (set(twos) | set(twos.values()))):
            raise FileNotFoundError(f"{lost[0]}: not one of a pair of files _R1 and _R2, or one of the two is missing")
        part, out, held = min(SPLIT, sum(sizes.values()) // self.tasks), [], 0
        for one, two in twos.items():
            if not out or held >= part:
                out.append(PairSplit([(one, two)]))
                held = 0
            else:
                out[-1].pairs.append((one, two))
            held += sizes[one] + sizes[two]
        return out

    def read(self, partition: PairSplit) -> Iterator[pa.RecordBatch]:
        for one, two in partition.pairs:
            yield from split_pairs(one, two)


class FastqPairsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return PAIRS_SCHEMA

    def reader(self, schema) -> FastqPairsReader:
        return FastqPairsReader(self.options)


# --- writing ----------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: names under the temporary folder and final names."""

    files: list[tuple[str, str]] = field(default_factory=list)


def _named(part: str | None) -> str:
    """A part of a file name: what could leave the folder or part the name becomes ``_``."""
    return re.sub(r"[^\w+=,-]", "_", part) if part else "none"


class _Packed(gzip.GzipFile):
    """A gzip stream that closes the file below it; at level 1, as bases and qualities leave little to longer searches."""

    def __init__(self, below: pa.NativeFile):
        super().__init__(fileobj=below, mode="wb", compresslevel=1, mtime=0)
        self.below = below

    def close(self) -> None:
        try:
            super().close()
        finally:
            self.below.close()


def _written(fs: pafs.FileSystem, path: str, pack: bool) -> BinaryIO:
    stream = fs.open_output_stream(path, compression=None)
    return _Packed(stream) if pack else stream


def _record_text(batch: pa.RecordBatch, tag: str) -> pa.Array:
    """The FASTQ text of each row of a batch."""
    name, seq, qual = (pc.fill_null(batch.column(tag + c).cast(pa.large_binary()), b"") for c in ("name", "seq", "qual"))
    at, end, plus, none = (pa.scalar(x, pa.large_binary()) for x in (b"@", b"\n", b"\n+\n", b""))
    return pc.binary_join_element_wise(at, name, end, seq, plus, qual, end, none)


class FastqWriter(DataSourceArrowWriter):
    """Rows (file_prefix, barcode, mate, name, seq, qual), or (file_prefix, barcode, r1_name ... r2_qual) for pairs, to a file
    for each bucket and mate; the mates of pairs go to two files in the same order.

    Rows of a bucket keep their order and need not follow one another. Up to ``OPEN`` buckets have their files open; where a task has more, the one that
    was written longest ago is closed and goes on in a further file. A task writes to a folder of its own attempt under ``_temporary``. The job's commit moves the
    files of the committed attempts to their places; its abort, or commit, removes the rest.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.packed, self.job = options["path"].rstrip("/"), options.get("compression") == "gzip", uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        task, attempt = context.partitionId(), context.taskAttemptId()
        fs, root = file_system(self.path)
        here = f"{root}/_temporary/{self.job}/{task}-{attempt}"
        out, streams, parts = Written(), {}, Counter()

        def close(bucket: tuple) -> None:
            for stream in streams.pop(bucket):
                stream.close()

        def streams_of(bucket: tuple, mates: list[int]) -> list[BinaryIO]:
            if bucket in streams:
                streams[bucket] = streams.pop(bucket)  # the latest
                return streams[bucket]
            if len(streams) >= OPEN:
                close(next(iter(streams)))
            fs.create_dir(here, recursive=True)
            streams[bucket], part = [], f"-{parts[bucket]}" if parts[bucket] else ""
            parts[bucket] += 1
            for mate in mates:
                final = f"{bucket[0]}_{bucket[1]}_R{mate}.{task:05d}{part}.fastq{'.gz' if self.packed else ''}"
                out.files.append((f"{here}/{final}", f"{root}/{final}"))
                streams[bucket].append(_written(fs, f"{here}/{final}", self.packed))
            return streams[bucket]

        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                tags = [t for t in ("r1_", "r2_") if f"{t}seq" in batch.schema.names] or [""]
                keys, codes = [], np.zeros(batch.num_rows, np.int64)
                for c in (c for c in ("file_prefix", "barcode", "mate") if c in batch.schema.names):
                    own = batch.column(c).dictionary_encode(null_encoding="encode")
                    called = [x if c == "mate" else _named(x) for x in own.dictionary.to_pylist()]
                    nth = {x: k for k, x in enumerate(dict.fromkeys(called))}
                    at = np.array([nth[x] for x in called])[own.indices.to_numpy()]
                    keys.append((list(nth), at))
                    codes = codes * len(nth) + at
                order = np.argsort(codes, kind="stable")
                ends = np.append(np.flatnonzero(np.diff(codes[order])) + 1, len(order))
                texts = [_record_text(batch, t).take(pa.array(order)) for t in tags]
                places = [np.frombuffer(x.buffers()[1], np.int64) for x in texts]
                begin = 0
                for end in ends:
                    bucket = tuple(called[at[order[begin]]] for called, at in keys)
                    for stream, text, at in zip(streams_of(bucket, [*bucket[2:]] or [*range(1, len(tags) + 1)]), texts, places, strict=True):
                        stream.write(memoryview(text.buffers()[2])[at[begin] : at[end]])
                    begin = end
            for bucket in list(streams):
                close(bucket)
        except BaseException:
            for bucket in list(streams):
                close(bucket)
            if fs.get_file_info(here).type == pafs.FileType.Directory:
                fs.delete_dir(here)
            raise
        return out

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        for message in messages:
            for temporary, final in message.files if message else ():
                fs.move(temporary, final)
        self._clear(fs, root)
        with fs.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        for folder in (f"{root}/_temporary/{self.job}", f"{root}/_temporary"):
            info = fs.get_file_info(folder)
            if info.type == pafs.FileType.Directory and (folder.endswith(self.job) or not fs.get_file_info(pafs.FileSelector(folder))):
                fs.delete_dir(folder)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_reads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        fs, root = file_system(self.options["path"])
        if not overwrite and fs.get_file_info(root).type != pafs.FileType.NotFound:
            raise FileExistsError(root)
        return FastqWriter(self.options)


def read_fastq(spark: SparkSession, *paths: str, split_bytes: int = SPLIT) -> DataFrame:
    """(file, ord, read_id, comment, seq, qual) of plain, gzip or bzip2 files, folders and patterns.

    A packed file streams through one task; a plain one is read in byte ranges, of which a task takes several after one
    another if they are short; each task finds its first record by itself, so all files are read once. ord is unique in a file and in the order of its reads:
    0, 1, 2... in a file of one range; further ranges begin at multiples of 2**33 (``number_reads``
    closes the gaps). An incomplete last record is left out.
    """
    spark.dataSource.register(FastqSource)
    return spark.read.format(FastqSource.name()).options(**{f"path{k}": p for k, p in enumerate(paths)}, splitbytes=split_bytes, tasks=4 * spark.sparkContext.defaultParallelism).load()


def number_reads(reads: DataFrame) -> DataFrame:
    """``reads`` (file, ord, ...) with ord counting from 0 in each file without gaps, as pairing by place needs it.

    Reads the input twice: the reads of each range are counted first, and the counts of a file, one
    for each of its ranges, added up.
    """
    from pyspark.sql import Window

    split = F.shiftright("ord", PLACE_BITS)
    counts = reads.select("file", split.alias("_split")).groupBy("file", "_split").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("file", "_split", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = reads.withColumn("_split", split).join(starts, ["file", "_split"])
    return numbered.withColumn("ord", F.col("ord").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.col("_before")).select(*reads.columns)


def read_fastq_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, r1_name, r1_seq, r1_qual, r2_name, r2_seq, r2_qual) of the pairs of files ``..._R1...`` and ``..._R2...``
    of a folder or pattern, whose mates are in the same order.

    A task reads both files of a pair in step, so mates meet without a shuffle, and further pairs if they are short; files are not read in ranges. ord counts the pairs of a
    file from 0. A file without its mate is an error, as are two files of different numbers of reads.
    """
    spark.dataSource.register(FastqPairsSource)
    return spark.read.format(FastqPairsSource.name()).option("tasks", 4 * spark.sparkContext.defaultParallelism).load(path)


def _clean(part: str) -> Column:
    """``_named`` as a column, so that buckets of one file name are one bucket."""
    return F.when(F.coalesce(F.col(part), F.lit("")) == "", "none").otherwise(F.regexp_replace(part, r"(?U)[^\w+=,-]", "_"))


def write_demux(reads: DataFrame, path: str, files: int = 8, compression: str | None = None, dealt: bool = True) -> None:
    """FASTQ files ``<prefix>_<barcode>_R<mate>.<task>.fastq`` of a new folder.

    ``reads`` has file_prefix, barcode, ord, and name, seq and qual for single reads or r1_name ... r2_qual
    for pairs, whose files hold the mates in the same order. A bucket is spread over up to
    ``files`` tasks by a hash of ord, so that unmatched reads do not gather, and is sorted by ord within each.
    If not ``dealt``, reads are neither shuffled nor sorted: each task writes its own, in the order in which they come, which is that of ord where they come from
    ``read_fastq``; there are then as many files as tasks and buckets, so this is for few buckets or large tasks. Nulls
    are written as empty, a null prefix or barcode as ``none``. All files appear when the job has
    succeeded; a failed one leaves none.
    """
    spark = reads.sparkSession
    spark.dataSource.register(FastqSource)
    tags = [t for t in ("r1_", "r2_") if f"{t}seq" in reads.columns] or [""]
    place, fields = ("file_prefix", "barcode"), [f"{t}{c}" for t in tags for c in ("name", "seq", "qual")]
    if dealt:  # pairs as one row; buckets of one file name as one bucket
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = reads.select(*[_clean(c).alias(c) for c in place], "ord", *fields)
        reads = rows.repartition(n, *place, F.pmod(F.xxhash64("ord"), F.lit(files))).sortWithinPartitions(*place, "ord")
    write = reads.select(*place, *fields).write.format(FastqSource.name()).mode("append").option("path", path)
    (write.option("compression", compression) if compression else write).save()
