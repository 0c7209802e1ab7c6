"""Removal of byte strings of ``LENGTH`` that start at more than one place of the corpus.

Anchors: of the ``GRAM``-byte strings that begin inside each run of ``LENGTH`` bytes, the one of the
least hash is its anchor (the leftmost of equals), so both copies of a repeated string have the same
anchor at the same place. An anchor's context is all that strings with this anchor may cover: the
``LENGTH - GRAM`` bytes before it and the ``LENGTH`` bytes from it on, as far as the text goes.

* Anchors that the corpus has once go first, by a count of hashes alone.
* Contexts that occur more than once (128 bits of hash and the anchor's 64) are repeated in whole.
* Anchors with different contexts are settled in bounded batches of whole groups: the contexts of a
  batch are one text, of which the Burrows-Wheeler transform is made in numpy. Intervals of its rows
  are extended backward, breadth first, through a wavelet matrix; round v finds all neighbours
  whose common prefix is v symbols, and the search stops at ``LENGTH``. Rows whose common prefix was
  not found by then share a string of ``LENGTH`` or more.
* An anchor with over ``GROUP`` different contexts (a passage that a third of all documents hold)
  is halved by where strings may start, and again, each half grouped by the bytes that all its
  strings hold; contexts cut to the half collapse where they are equal. Groups so become small
  enough, or one context.

Rules: texts are judged as UTF-8 bytes; null texts are empty; texts shorter than ``LENGTH`` lose
nothing; rows that repeat a doc_id, or have none, are documents of their own, and repeated texts of
``LENGTH`` bytes or more are removed wholly; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import table, text_batches, written

LENGTH = 200
GRAM = 64
#: Most different contexts of an anchor that are settled together, and bytes of a batch of groups, about.
GROUP = 1024
BATCH = 1 << 19
#: Bytes that are hashed at a time.
PIECE = 1 << 17

_PLACE = (1 << 20) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hashes of all strings of ``gram`` bytes, by doubling."""
    out, width, base, at = None, 1, _BASE, 0
    step = _OF_BYTE[data]
    # the bits of gram say which doubled widths are joined, from the left
    while True:
        if gram & width:
            rest = step[at:]
            out = rest if out is None else out[: len(rest)] * np.uint64(base) + rest[: len(out)]
            at += width
        if 2 * width > gram:
            return _mixed(out[: max(0, len(data) - gram + 1)])
        step = step[:-width] * np.uint64(base) + step[width:]
        base, width = base * base % (1 << 64), 2 * width


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width``."""
    done = 1
    while done < width:
        shift = min(done, width - done)
        x = np.minimum(x[:-shift], x[shift:])
        done += shift
    return x


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first, last) of the anchors of texts that lie at ``starts``..``ends`` of ``data`` (at most 2**20 bytes).

    The strings of ``length`` bytes that start at first..last are those with this anchor.
    """
    room = ends - starts - length + 1
    starts, room = starts[room > 0], room[room > 0]
    if not len(starts):
        return (*[np.zeros(0, np.int64)] * 2, *[np.zeros(0, np.int64)] * 2)
    hashes = gram_hashes(data, gram)
    ranked = (hashes & ~np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    least = _least(ranked, length - gram + 1)
    edge = np.zeros(len(least) + 1, np.int8)
    edge[starts] += 1
    edge[starts + room] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    fresh = np.empty(len(least), bool)
    fresh[0] = True
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[starts] = True
    first = np.flatnonzero(fresh & inside)
    place = (least[first] & np.uint64(_PLACE)).astype(np.int64)
    last = np.append(first[1:], len(least)) - 1
    text_end = (starts + room - 1)[np.searchsorted(starts, first, "right") - 1]
    return place, hashes[place].view(np.int64), first, np.minimum(last, text_end)


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """The texts as buffers of about ``PIECE`` bytes, each with (text, from, start, end): the text's bytes from ``from`` on
    lie at start..end. Pieces of one text overlap, so that no run of ``length`` bytes is missed."""
    held: list[bytes] = []
    at: list[tuple[int, int, int, int]] = []
    size = 0
    for k, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[begin : begin + PIECE + length - 1] if len(text) > PIECE else text
            if size and size + len(part) > PIECE:
                yield np.frombuffer(b"".join(held), np.uint8), at
                held, at, size = [], [], 0
            held.append(part)
            at.append((k, begin, size, size + len(part)))
            size += len(part)
    if size:
        yield np.frombuffer(b"".join(held), np.uint8), at


def text_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, hash, place, first, last) of all anchors in order, by buffer; each place where a string may start is in one
    range first..last. An anchor's range may be cut where buffers meet."""
    for data, at in pieces(texts, length):
        k, begin, start, end = (np.array(x, np.int64) for x in zip(*at, strict=True))
        place, hashes, first, last = anchors(data, start, end, length, gram)
        if len(place):
            part = np.searchsorted(start, first, "right") - 1
            shift = begin[part] - start[part]
            yield k[part], hashes, place + shift, first + shift, last + shift


# --- the Burrows-Wheeler transform and its intervals ---------------------------------------------


def sorted_rotations(symbols: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Starts of all rotations in the order of their first ``depth`` symbols (of so many bits) or more.

    As many symbols as a word holds are looked at first; then the ranks of three rotations in a row make
    one word, which triples the symbols looked at (two, where three do not fit). A rotation's rank is the place
    of the first one that is equal as far as looked; only equal ones are sorted on.
    """
    n, width = len(symbols), min(63 // bits, depth)
    times = 3 if n < 1 << 21 else 2
    key = np.zeros(n, np.int64)
    for k in range(width):
        key = key << bits | np.roll(symbols, -k)
    order, rank, tied = np.arange(n), np.empty(n, np.int64), np.arange(n)
    while True:
        by = np.argsort(key)
        order[tied] = own = order[tied][by]
        key = key[by]
        new = np.append(True, key[1:] != key[:-1])
        rank[own] = np.maximum.accumulate(np.where(new, tied, 0))
        alone = new & np.append(new[1:], True)
        tied, own = tied[~alone], own[~alone]
        if width >= depth or not len(tied):
            return order
        key = rank[own]
        for k in range(1, times):
            key = key * n + rank[(own + k * width) % n]
        width *= times


class Wavelet:
    """Symbols by bits, highest first; each level has its zeros before its ones and counts the ones before each place."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            one = (symbols >> bit & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def symbols_of(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, low, high) for every symbol inside every range low..high, the ranges as they lie on the last level."""
        symbol = np.zeros(len(low), np.int32)
        for ones, zeros in self.levels:
            low1, high1 = ones[low], ones[high]
            low0, high0 = low - low1, high - high1
            a, b = low0 < high0, low1 < high1
            symbol = np.concatenate([2 * symbol[a], 2 * symbol[b] + 1])
            low, high = np.concatenate([low0[a], zeros + low1[b]]), np.concatenate([high0[a], zeros + high1[b]])
        return symbol, low, high


def common_prefix_reached(last: np.ndarray, bits: int, length: int) -> np.ndarray:
    """Of n sorted rotations with the last symbols ``last``: n + 1 marks, false at i if rotations i - 1 and i share ``length`` symbols.

    Round v extends the intervals of all strings of v symbols that ended at a new boundary by one symbol
    to the left; a boundary that is met for the first time parts rotations that share v symbols.
    """
    n = len(last)
    wavelet = Wavelet(last, bits)
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    symbol, base, _ = wavelet.symbols_of(low, high)
    shift = np.zeros(1 << bits, np.int32)
    shift[symbol] = -base
    counts = np.bincount(last, minlength=1 << bits)
    shift += (np.cumsum(counts) - counts).astype(np.int32)
    before = np.empty(n, np.int32)  # of each rotation, the place of the one that starts a symbol earlier
    before[np.argsort(last.astype(np.uint16), kind="stable")] = np.arange(n, dtype=np.int32)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    single = np.zeros(0, np.int32)  # intervals of one rotation extend to that one
    for _ in range(length):
        symbol, low, high = wavelet.symbols_of(low, high)
        low, high = low + shift[symbol], high + shift[symbol]
        new = ~known[high]
        low, high = low[new], high[new]
        single = before[single]
        single = single[~known[single + 1]]
        if not len(high) and not len(single):
            break
        known[high] = True
        known[single + 1] = True
        one = high - low == 1
        low, high, single = low[~one], high[~one], np.concatenate([single, low[one]])
    return known


def repeated_starts(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, context, offset) of all strings of ``length`` bytes that occur more than once in the contexts, by class."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    text = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int32) + 1
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text[begins + sizes] = 0  # no symbol of a text
    there = np.flatnonzero(np.bincount(text))
    dense = np.zeros(257, np.int32)
    dense[there] = np.arange(len(there))
    text = dense[text]
    bits = max(1, int(len(there) - 1).bit_length())
    order = sorted_rotations(text, bits, length)
    known = common_prefix_reached(text[order - 1], bits, length)[:-1]
    alone = known & np.append(known[1:], True)
    group, order = np.cumsum(known)[~alone], order[~alone]
    context = np.searchsorted(begins, order, "right") - 1
    offset = order - begins[context]
    whole = offset + length <= sizes[context]
    return group[whole], context[whole], offset[whole]


def repeated_ranges(row: np.ndarray, first: np.ndarray, n: np.ndarray, contexts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(row, first start, last start) of the repeated strings of contexts that occur once.

    A context lies at ``first`` of document ``row`` (and at others, if n > 1). Contexts of one document may
    overlap: a string at one place of it is no repeat of itself.
    """
    group, context, offset = repeated_starts(contexts, length)
    if not len(group):
        return []
    new = np.diff(group, prepend=-1) != 0
    heads = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    at, whose = first[context] + offset, row[context]
    differs = (at != at[heads][of]) | (whose != whose[heads][of]) | (n[context] > 1)
    found = np.logical_or.reduceat(differs, heads)[of] & (n[context] == 1)
    context, at = context[found], at[found]
    if not len(at):
        return []
    by = np.lexsort((at, context))
    context, at = context[by], at[by]
    cut = np.flatnonzero((np.diff(context) != 0) | (np.diff(at) != 1))
    begin, end = np.append(0, cut + 1), np.append(cut, len(at) - 1)
    return list(zip(row[context[begin]].tolist(), at[begin].tolist(), at[end].tolist(), strict=True))


def _settle(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, row, first, n, bytes), of which groups of one key follow each other, to (row, low, high)."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        row, first, n, contexts = zip(*held, strict=True)
        out = repeated_ranges(np.array(row, np.int64), np.array(first, np.int64), np.array(n, np.int64), list(contexts), length)
        columns = np.array(out, np.int64).reshape(-1, 3).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "low", "high"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, None
        for batch in batches:
            for k, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key and size >= BATCH:
                    yield solve(held)
                    held, size = [], 0
                key = k
                held.append(rest)
                size += len(rest[-1])
        if held:
            yield solve(held)

    return work


# --- the jobs --------------------------------------------------------------------------------------


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_bytes, body), the body compressed."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [x.as_py() or b"" for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array([packer.compress(t) for t in texts], pa.binary())], ["doc_id", "n_bytes", "body"])


def _bodies(column: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(x.as_buffer()) for x in column]


def _groups(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose unpacked texts come to about four megabytes, or one row."""
    size = begin = 0
    for k, n in enumerate(batch.column(column).to_pylist()):
        if size and size + n > 4 << 20:
            yield batch.slice(begin, k - begin)
            size, begin = 0, k
        size += n
    yield batch.slice(begin)


def _anchor_hashes(length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(n_bytes, body) to (anchor) of every place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch, "n_bytes"):
                for _, hashes, *_ in text_anchors(_bodies(part.column("body")), length, gram):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes)], ["anchor"])

    return work


def _places(length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, n_bytes, body) to (anchor, c1, c2, row, spot): c1 and c2 are a digest of the context, spot is where it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part in _groups(batch, "n_bytes"):
                rows, texts = part.column("row").to_numpy(), _bodies(part.column("body"))
                for k, hashes, place, first, last in text_anchors(texts, length, gram):
                    found = b"".join([digest(texts[i][a:b]) for i, a, b in zip(k.tolist(), first.tolist(), (last + length).tolist(), strict=True)])
                    c = np.frombuffer(found, np.int64).reshape(-1, 2)
                    spot = first << 32 | (place - first) << 16 | last - first
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(rows[k]), pa.array(spot)], ["anchor", "c1", "c2", "row", "spot"])

    return work


# what a spot says: where the context's first string starts, and its last one
FIRST, LAST = "shiftright(spot, 32)", "shiftright(spot, 32) + (spot & 65535)"


def _contexts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, n_bytes, body, wanted) to (key, kinds, row, at, low, n, bytes): the contexts at the wanted spots.

    A context lies at ``at + low`` of its text; ``at`` is its anchor's place.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "kinds", "row", "at", "low", "n", "bytes"]
        for batch in batches:
            for part in _groups(batch, "n_bytes"):
                for row, text, wanted in zip(part.column("row").to_pylist(), _bodies(part.column("body")), part.column("wanted"), strict=True):
                    each = wanted.values
                    for begin in range(0, len(each), 4096):
                        own = each.slice(begin, 4096)
                        spot = own.field("spot").to_numpy()
                        first, left, count = spot >> 32, spot >> 16 & 65535, spot & 65535
                        found = [text[a:b] for a, b in zip(first.tolist(), (first + count + length).tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([own.field("anchor"), own.field("kinds"), pa.array(np.full(len(own), row)), pa.array(first + left), pa.array(-left), own.field("n"), pa.array(found, pa.binary())], names)

    return work


def _marked(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, n_bytes, body, lows, highs) to what is removed and kept of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            doc_id, n_bytes, body, lows, highs = batch.columns
            out = []
            for n, packed, low, high in zip(n_bytes.to_pylist(), body, lows, highs, strict=True):
                text, kept, digest, removed, spans, at = unpacker.decompress(packed.as_buffer()), 0, hashlib.sha256(), 0, 0, 0
                for begin, end in removed_spans(low.values.to_numpy(), high.values.to_numpy(), n, length) if low.is_valid else ():
                    digest.update(text[at:begin])
                    removed, spans, at = removed + end - begin, spans + 1, end
                digest.update(text[at:])
                out.append((n, removed, spans, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([doc_id, *map(pa.array, zip(*out, strict=True))] if out else [doc_id, *[pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return work


def removed_spans(low: np.ndarray, high: np.ndarray, n: int, length: int) -> list[tuple[int, int]]:
    """The maximal runs that strings starting in the ranges low..high cover, of a text of n bytes."""
    low, high = np.maximum(low, 0), np.minimum(high, n - length)
    there = low <= high
    low, end = low[there], high[there] + length
    by = np.argsort(low, kind="stable")
    low, end = low[by], np.maximum.accumulate(end[by])
    if not len(low):
        return []
    new = np.append(True, low[1:] > end[:-1])
    return list(zip(low[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)].tolist(), strict=True))


def settled(groups: DataFrame, length: int) -> DataFrame:
    """(row, low, high): repeated starts of the contexts (key, row, at, low, n, bytes) of small groups."""
    rows = groups.select("key", "row", (F.col("at") + F.col("low")).alias("first"), "n", "bytes")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_settle(length), "row long, low long, high long")


def halved(todo: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The next contexts of groups that are too large, and (row, low, high) of those that are equal once cut.

    ``todo`` has (key, row, at, low, n, bytes, a, b): strings of a group start a..b from their anchors.
    The contexts of each half a..b, cut to what its strings may cover, are grouped by the bytes b..a + length, which
    all of the strings hold, and counted by what they are.
    """
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("long")
    sides = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b").alias("b")))
    each = todo.withColumn("side", F.explode(sides)).withColumn("a", F.col("side.a")).withColumn("b", F.col("side.b"))
    begin = F.greatest("a", "low")
    last = F.least(F.col("b"), F.col("low") + F.octet_length("bytes") - length)
    each = each.filter(begin <= last)
    # substring counts from 1, in bytes for binary values
    core = F.substring("bytes", F.col("b") - F.col("low") + 1, F.col("a") + length - F.col("b"))
    cut = F.substring("bytes", begin - F.col("low") + 1, last + length - begin)
    parts = written(each.select(F.xxhash64("key", "a", core).alias("key"), "row", "at", begin.alias("low"), "n", cut.alias("bytes"), "a", "b", (F.col("at") + begin).alias("first"), (F.col("at") + last).alias("last")))
    same = ["key", "low", "bytes"]
    kinds = written(parts.groupBy(*same).agg(F.sum("n").alias("n"), F.min("row").alias("row"), F.min_by("at", "row").alias("at"), F.first("a").alias("a"), F.first("b").alias("b")))
    equal = parts.filter("n = 1").join(kinds.filter("n > 1").select(*same), same, "left_semi")
    sizes = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    return kinds.join(sizes, "key"), equal.select("row", F.col("first").alias("low"), F.col("last").alias("high"))


def repeats(base: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(row, low, high): ranges of places where a string of ``length`` bytes starts that starts elsewhere too.

    ``base`` (row, n_bytes, body) is a written table. Ranges do not overlap, but may touch.
    """
    able = base.filter(F.col("n_bytes") >= length)
    hashes = able.select("n_bytes", "body").mapInArrow(_anchor_hashes(length, gram), "anchor long")
    shared = hashes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    found = able.select("row", "n_bytes", "body").mapInArrow(_places(length, gram), "anchor long, c1 long, c2 long, row long, spot long")
    places = written(found.join(shared, "anchor", "left_semi"))
    what = ["anchor", "c1", "c2"]
    counts = written(places.groupBy(*what).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"), F.min_by("spot", "row").alias("spot")))
    kinds = counts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = counts.join(kinds, "anchor").groupBy("row").agg(F.collect_list(F.struct("anchor", "kinds", "spot", "n")).alias("wanted"))
    contexts = written(able.select("row", "n_bytes", "body").join(wanted, "row").mapInArrow(_contexts(length), "key long, kinds long, row long, at long, low long, n long, bytes binary"))
    whole = places.join(counts.filter("n > 1").select(*what), what, "left_semi")
    out = whole.select("row", F.expr(FIRST).alias("low"), F.expr(LAST).alias("high"))
    small = F.col("kinds") <= group
    fields = ["key", "row", "at", "low", "n", "bytes"]
    groups = contexts.filter(small).select(*fields)
    todo = contexts.filter(~small).withColumn("a", F.lit(gram - length).cast("long")).withColumn("b", F.lit(0).cast("long"))
    while todo.limit(1).count():
        todo, equal = halved(todo, length)
        out, groups = out.unionByName(equal), groups.unionByName(todo.filter(small).select(*fields))
        todo = todo.filter(~small & (F.col("a") < F.col("b")))
    return out.unionByName(settled(groups, length))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    text_batches(spark)
    stored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(_stored, "doc_id long, n_bytes long, body binary")
    base = written(stored.withColumn("row", F.monotonically_increasing_id()))
    spans = repeats(base, length, gram, group).groupBy("row").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    met = base.join(spans, "row", "left").select("doc_id", "n_bytes", "body", "lows", "highs")
    return met.mapInArrow(_marked(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op11_suffix_repeats(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
