"""Best-fit packing of tokenised documents, polished by a swap-based local search.

Documents become token ids plus an end id; longer ones are cut into pieces of ``SEQ`` tokens.
Pieces are dealt by hash into groups of about ``GROUP_ROWS`` rows. Each group is packed best fit
decreasing, then a local search works on its underfull bins: it moves a piece, exchanges one for
one or two for one between the emptiest bin and another, always increasing the sum of squared
fills, until no change is left or the room of all bins together is less than one. Pieces of one size
are alike, and a bin holds at most 63 different sizes, so all pairs of a bin are looked at by size. Bins that stay clearly underfull are pooled from
all groups and packed once more, in fewer groups of the same size, so that waste stays at about one
bin for each ``GROUP_ROWS`` pooled pieces. No group depends on a key of the data, so hot sources or
copies do not gather, and a group's memory does not grow with the input.

Rules: null text is the empty text, which is the end id alone; repeated rows are packed each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import durable, table, text_batches

SEQ = 2048
END = 0
GROUP_ROWS = 4096
#: Bins filled less than this are pooled for the second round.
POOL_BELOW = 2000
#: Words whose ids a Python worker remembers, at most.
CACHE_WORDS = 300_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_known: dict[str, tuple] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: printable ones stand
    for themselves, the rest take the code points from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


def encoder(path: str):
    """text -> its ids as little-endian 32-bit bytes, by the tokenizer file at ``path``.

    That tokenizer normalises, lower-cases and splits at white space, so words are looked up one by
    one: the ids of a text are those of its words, in order. Words of letters up to U+00FF alone are
    one piece that normalisation leaves as it is, and go straight to the merges.
    """
    if path not in _known:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _known[path] = (tokenizer, tokenizer.model, {})
    tokenizer, merges, cache = _known[path]
    combining = re.compile("[\u0300-\U0010ffff]")

    def encode(text: str) -> bytes:
        raw = text.encode("utf-8", "surrogatepass")
        # marks that combine with letters may do so in one case only, so such texts keep their case here
        words = (raw.lower() if combining.search(text) is None else raw).split()
        found = list(map(cache.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = word_ids(words[i])
        return b"".join(found)

    def word_ids(word: bytes) -> bytes:
        ids = cache.get(word)
        if ids is None:
            w = word.decode("utf-8", "surrogatepass")
            if w.isalpha() and max(w) <= "\xff":
                w = w.lower()
                got = merges.tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS))
                ids = array("I", [t.id for t in got]).tobytes()
            elif w[-1] in ".," and w[-2:-1].isalpha():  # a mark after a letter is a piece of its own
                ids = word_ids(word[:-1]) + word_ids(word[-1:])
            else:
                ids = array("I", tokenizer.encode(w, add_special_tokens=False).ids).tobytes()
            if len(cache) < CACHE_WORDS:
                cache[word] = ids
        return ids

    return encode


def pieces(docs: DataFrame, vocabulary: str | None = None, seq: int = SEQ) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document of ``docs`` (doc_id, text)."""
    path = vocabulary or default_vocabulary()
    text_batches(docs.sparkSession)
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * seq)):
                    own = ids[at : at + 4 * seq]
                    out.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECES)


def best_fit(lengths: list[int], seq: int = SEQ) -> list[list[int]]:
    """Bins of indexes, best fit decreasing: each piece goes where it leaves least room."""
    bins: list[list[int]] = []
    open_by_room: list[list[int]] = [[] for _ in range(seq + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = rooms >> lengths[i]
        if fits and lengths[i] < seq:
            room = lengths[i] + (fits & -fits).bit_length() - 1
            at = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = seq, len(bins)
            bins.append([i])
        left = room - lengths[i]
        if left:
            open_by_room[left].append(at)
            rooms |= 1 << left
    return bins


def _given_back(items: list[int], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes that a bin may give back, ascending, and the one or two pieces (j is -1) of each; pieces of one size are alike."""
    of_size: dict[int, list[int]] = {}
    for i in items:
        of_size.setdefault(lengths[i], []).append(i)
    found: dict[int, tuple[int, int]] = {n: (own[0], -1) for n, own in of_size.items()}
    sizes = sorted(of_size)
    for k, m in enumerate(sizes):
        if len(of_size[m]) > 1:
            found.setdefault(2 * m, (of_size[m][0], of_size[m][1]))
        for n in sizes[k + 1 :]:
            found.setdefault(m + n, (of_size[m][0], of_size[n][0]))
    order = sorted(found)
    return np.array(order, np.int64), np.array([found[n] for n in order], np.int64).reshape(-1, 2)


def local_search(bins: list[list[int]], lengths: list[int], seq: int = SEQ) -> list[list[int]]:
    """Empty underfull bins by moves, one-for-one and two-for-one exchanges.

    Each step takes the emptiest bin that is not given up yet and makes the change that carries
    most tokens over to a fuller bin, so the sum of squared fills grows with each. It ends when no
    change is left, or when all the room together is less than a bin, so that none can empty any more.
    """
    bins = [list(b) for b in bins]
    fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
    if len(bins) <= -(-int(fill.sum()) // seq):
        return bins
    backs = [_given_back(b, lengths) for b in bins]
    size, pieces_of = np.concatenate([b[0] for b in backs]), np.concatenate([b[1] for b in backs])
    owner = np.repeat(np.arange(len(bins)), [len(b[0]) for b in backs])
    given_up = np.zeros(len(bins), bool)
    while True:
        open_bins = (fill > 0) & (fill < seq)
        candidates = np.nonzero(open_bins & ~given_up)[0]
        if not candidates.size or (seq - fill)[open_bins].sum() < seq:
            return [b for b in bins if b]
        source = int(candidates[np.argmin(fill[candidates])])
        room = np.where(open_bins & (fill >= fill[source]), seq - fill, 0)
        room[source] = 0
        carried, moved, to, back = 0, -1, -1, (-1, -1)
        limits = room[owner]
        tried = set()
        for i in sorted(bins[source], key=lambda i: -lengths[i]):
            x = lengths[i]
            if x <= carried:
                break
            if x in tried:
                continue
            tried.add(x)
            fits = np.nonzero(room >= x)[0]
            if fits.size:  # a move carries all of x
                carried, moved, to, back = x, i, int(fits[np.argmin(room[fits])]), (-1, -1)
                break
            gain = x - size
            gain[gain > limits] = 0
            k = int(np.argmax(gain))
            if gain[k] > carried:
                carried, moved, to, back = int(gain[k]), i, int(owner[k]), tuple(pieces_of[k].tolist())
        if not carried:
            given_up[source] = True
            continue
        bins[source].remove(moved)
        bins[to].append(moved)
        for j in back:
            if j >= 0:
                bins[to].remove(j)
                bins[source].append(j)
        fill[source] -= carried
        fill[to] += carried
        given_up[:] = False
        keep = (owner != source) & (owner != to)
        new = [(b, *_given_back(bins[b], lengths)) for b in (source, to)]
        size = np.concatenate([size[keep], *[n for _, n, _ in new]])
        pieces_of = np.concatenate([pieces_of[keep], *[p for _, _, p in new]])
        owner = np.concatenate([owner[keep], *[np.full(len(n), b) for b, n, _ in new]])


def _packer(seq: int, round_no: int):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "piece", "at"], kind="stable", ignore_index=True)
        lengths = part["length"].tolist()
        bins = best_fit(lengths, seq)
        closed = [b for b in bins if sum(lengths[i] for i in b) >= seq]
        bins = closed + local_search([b for b in bins if sum(lengths[i] for i in b) < seq], lengths, seq)
        sequence, offset, full = (np.zeros(len(part), np.int64) for _ in range(3))
        base = (round_no << 56) + (int(part["grp"].iloc[0]) << 24)
        for k, members in enumerate(bins):
            own = np.array(members)
            size = part["length"].to_numpy()[own]
            sequence[own], offset[own], full[own] = base + k, np.cumsum(size) - size, size.sum()
        return part.assign(sequence_id=sequence, offset=offset, fill=full)

    return pack


def pack(cut: DataFrame, seq: int = SEQ, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``cut`` (pieces, durable) with sequence_id and offset."""
    schema = f"{_PIECES}, at long, grp long, sequence_id long, offset long, fill long"

    def packed(rows: DataFrame, round_no: int) -> DataFrame:
        groups = max(1, round(rows.count() / group_rows))
        dealt = rows.withColumn("at", F.monotonically_increasing_id())
        dealt = dealt.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "at"), F.lit(groups)).cast("long"))
        return durable(dealt.groupBy("grp").applyInPandas(_packer(seq, round_no), schema))

    first = packed(cut, 0)
    columns = [c.split()[0] for c in _PIECES.split(", ")]
    pooled = F.col("fill") < POOL_BELOW * seq // SEQ
    second = packed(first.filter(pooled).select(columns), 1)
    return first.filter(~pooled).unionByName(second).select(*columns, "sequence_id", "offset")


def packed_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack(durable(pieces(docs, vocabulary)))


def op8_swap_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
