"""Media columns in baseline JPEG: lossless payloads, and a decoder for DC-only thumbnails.

Writing: a payload is padded with zero bytes to blocks of 64, and each block is stored as the 64
quantised coefficients of one 8 x 8 luminance block, so the entropy-coded scan gives every byte
back. Bytes map to the non-zero coefficients -128..-1 and 1..128. The Huffman tables are chosen so
that code and magnitude bits of a coefficient are 10 bits together for DC and 9 for AC. Each block
is a restart interval. A comment segment holds the payload's length.

Reading: ``parse`` walks the markers, ``decode_scan`` Huffman-decodes the scan of any baseline
image (several components, sampling factors, zero runs, restart intervals). Restart intervals are
decoded side by side in numpy, one symbol of each at a time. Thumbnails take the DC coefficients
alone: one luminance pixel for each block.

Rules: null text is the empty text, which has one block of zeros; equal texts give equal bytes and
features; repeated rows are stored each; an empty table gives no rows; other columns are not read.
Very long texts are written and read back in pieces of about ``CHUNK`` bytes.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seqloom.llm.common import table, text_batches

CHUNK = 1 << 20
BLOCK = 64
#: Blocks along a side of the image that the format allows.
SIDE_BLOCKS = 8191

# code lengths by magnitude category, as a DHT segment lists them: counts of 1- to 16-bit codes, symbols
_DC_LENGTHS = {s: 10 - s for s in range(10)}
_AC_LENGTHS = {s: 9 - s for s in range(1, 9)}


def _table_segment(lengths: dict[int, int]) -> bytes:
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    return bytes(sum(n == k for n in lengths.values()) for k in range(1, 17)) + bytes(symbols)


def canonical(segment: bytes) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) of a DHT segment's counts and symbols."""
    out, code, at = {}, 0, 16
    for length in range(1, 17):
        for _ in range(segment[length - 1]):
            out[segment[at]] = (code, length)
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _coefficient(byte: int) -> int:
    return byte - 128 if byte < 128 else byte - 127


def _codes(lengths: dict[int, int]) -> np.ndarray:
    """Bits of each payload byte: Huffman code, then magnitude bits."""
    codes, out = canonical(_table_segment(lengths)), []
    for byte in range(256):
        v = _coefficient(byte)
        size = abs(v).bit_length()
        out.append(codes[size][0] << size | (v if v > 0 else v + (1 << size) - 1))
    return np.array(out, np.uint16)


_DC_CODES, _AC_CODES = _codes(_DC_LENGTHS), _codes(_AC_LENGTHS)
_TAIL = -(10 + 63 * 9) % 8  # one-bits that fill a block's last byte
_BLOCK_BYTES = (10 + 63 * 9 + _TAIL) // 8


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def shape(payload_bytes: int) -> tuple[int, int]:
    """Blocks across and down: nearly square, with less than one row of filling."""
    blocks = payload_bytes // BLOCK
    wide = math.isqrt(blocks - 1) + 1
    if wide > SIDE_BLOCKS:
        raise ValueError(f"a text of over {SIDE_BLOCKS**2 * BLOCK} bytes is too large for one image")
    return wide, -(-blocks // wide)


def header(payload_bytes: int) -> bytes:
    wide, high = shape(payload_bytes)
    return (
        b"\xff\xd8"
        + _segment(0xFE, struct.pack(">Q", payload_bytes))
        + _segment(0xDB, b"\0" + b"\1" * 64)
        + _segment(0xC0, struct.pack(">BHHB", 8, high * 8, wide * 8, 1) + b"\1\x11\0")
        + _segment(0xC4, b"\0" + _table_segment(_DC_LENGTHS))
        + _segment(0xC4, b"\x10" + _table_segment(_AC_LENGTHS))
        + _segment(0xDD, struct.pack(">H", 1))
        + _segment(0xDA, b"\1\1\0\0\x3f\0")
    )


def _scan(blocks: np.ndarray, number: np.ndarray, last: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Scan bytes of ``blocks`` (n, 64) with their closing markers, and where each block ends.

    number: a block's place in its image; last: whether it closes its image.
    """
    n = len(blocks)
    bits = np.ones((n, 8 * _BLOCK_BYTES), np.uint8)
    dc = _DC_CODES[blocks[:, 0]]
    for k in range(10):
        bits[:, k] = dc >> (9 - k) & 1
    ac = _AC_CODES[blocks[:, 1:]]
    for k in range(9):
        bits[:, 10 + k : 10 + 63 * 9 : 9] = ac >> (8 - k) & 1
    body = np.packbits(bits, axis=1)
    out = np.empty((n, _BLOCK_BYTES + 2), np.uint8)
    out[:, :-2] = body
    out[:, -2] = 0xFF
    out[:, -1] = np.where(last, 0xD9, 0xD0 + number % 8)
    times = np.ones(out.shape, np.int64)
    times[:, :-2] += body == 0xFF  # a zero follows each 0xFF of the data
    ends = np.cumsum(times.ravel())
    flat = np.zeros(int(ends[-1]), np.uint8)
    flat[ends - times.ravel()] = out.ravel()
    return flat.tobytes(), ends[_BLOCK_BYTES + 1 :: _BLOCK_BYTES + 2]


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Unpadded length, and the UTF-8 bytes padded with zeros to a positive multiple of 64."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def encode(payloads: list[bytes]) -> list[bytes]:
    """One baseline JPEG for each payload (lengths are positive multiples of 64)."""
    counts = [math.prod(shape(len(p))) for p in payloads]
    filled = b"".join(p + bytes(c * BLOCK - len(p)) for p, c in zip(payloads, counts, strict=True))
    blocks = np.frombuffer(filled, np.uint8).reshape(-1, BLOCK)
    ends = np.cumsum(counts)
    number = np.arange(len(blocks)) - np.repeat(ends - counts, counts)
    last = np.zeros(len(blocks), bool)
    last[ends - 1] = True
    parts, at, cuts = [], 0, [0]
    for a in range(0, len(blocks), CHUNK // BLOCK):
        b = a + CHUNK // BLOCK
        scan, stops = _scan(blocks[a:b], number[a:b], last[a:b])
        cuts += (stops[last[a:b]] + at).tolist()
        at += len(scan)
        parts.append(scan)
    whole = b"".join(parts)
    return [header(len(p)) + whole[a:b] for p, a, b in zip(payloads, cuts[:-1], cuts[1:], strict=True)]


# --- reading ----------------------------------------------------------------------------------


@dataclass
class Image:
    """What the markers of a baseline JPEG say."""

    width: int = 0
    height: int = 0
    interval: int = 0
    comment: bytes = b""
    quants: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[tuple[int, int], bytes] = field(default_factory=dict)
    frame: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantisation table
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # id, DC table, AC table
    start: int = 0

    def units(self) -> list[tuple[int, int, int]]:
        """(component, DC table, AC table) of each block of one MCU."""
        place = {c[0]: k for k, c in enumerate(self.frame)}
        out = []
        for cid, dc, ac in self.scan:
            k = place[cid]
            out += [(k, dc, ac)] * (1 if len(self.scan) == 1 else self.frame[k][1] * self.frame[k][2])
        return out

    def mcus(self) -> tuple[int, int]:
        h = 1 if len(self.scan) == 1 else max(c[1] for c in self.frame)
        v = 1 if len(self.scan) == 1 else max(c[2] for c in self.frame)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(data: bytes) -> Image:
    """The segments up to the scan; raises ValueError for what is not a baseline JPEG."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no SOI marker")
    image, at = Image(), 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at byte {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            image.comment = body
        elif marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                n = 128 if wide else 64
                image.quants[body[k] & 15] = np.frombuffer(body[k + 1 : k + 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                k += 1 + n
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                n = 16 + sum(body[k + 1 : k + 17])
                image.huffman[body[k] >> 4, body[k] & 15] = body[k + 1 : k + 1 + n]
                k += 1 + n
        elif marker in (0xC0, 0xC1):
            _, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            image.frame = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("not a baseline image")
        elif marker == 0xDD:
            image.interval = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            image.scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            image.start = at
            return image
    raise ValueError("no scan")


_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
_lookups: dict[bytes, np.ndarray] = {}


def _lookup(segment: bytes) -> np.ndarray:
    """For each 16 bits ahead: code length << 8 | symbol; 0 where no code matches."""
    if segment not in _lookups:
        out = np.zeros(1 << 16, np.int32)
        for symbol, (code, length) in canonical(segment).items():
            out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
        _lookups[segment] = out
    return _lookups[segment]


def _lanes(scan: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data bytes without stuffing, where each restart interval starts, and each image's first lane.

    ``scan`` holds the scans of one or more images end to end, each closed by EOI.
    """
    marks = np.nonzero(scan[:-1] == 0xFF)[0]
    nxt = scan[marks + 1]
    gone = np.zeros(len(scan), bool)
    gone[marks[nxt == 0] + 1] = True
    cut = (nxt >= 0xD0) & (nxt <= 0xD7) | (nxt == 0xD9)
    closing = marks[cut]
    gone[closing] = gone[closing + 1] = True
    kept = np.cumsum(~gone)
    stops = kept[closing]  # data bytes up to each interval's end
    starts = np.concatenate([[0], stops[:-1]])
    images = np.concatenate([[0], np.nonzero(nxt[cut] == 0xD9)[0] + 1])
    return scan[~gone], starts, images


def pieces_of(image: Image, scan: memoryview) -> Iterator[memoryview]:
    """``scan`` cut at restart markers into pieces of about ``CHUNK`` bytes; whole if there are none."""
    at = 0
    while at < len(scan):
        found = _RESTART.search(scan, at + CHUNK) if image.interval else None
        end = found.end() if found else len(scan)
        yield scan[at:end]
        at = end


def decode_scan(image: Image, scan: bytes, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (blocks, 64) in scan order, and the component of each block.

    ``scan`` may hold several scans end to end that share ``image``'s tables and interval; their
    blocks then follow each other. Without restart intervals an image is one lane. A scan may come in
    pieces that end with a restart interval, ``before`` of which went before.
    """
    units = image.units()
    data, starts, images = _lanes(np.frombuffer(scan, np.uint8))
    lanes = len(starts)
    wide, high = image.mcus()
    if image.interval:
        per_lane = np.full(lanes, image.interval * len(units))
        if len(images) == 2:
            per_lane[-1] = (wide * high - image.interval * (before + lanes - 1)) * len(units)
    else:
        per_lane = np.full(lanes, wide * high * len(units))
    d = np.concatenate([data, np.full(8, 255, np.uint8)]).astype(np.uint64)
    ahead = d[:-4] << np.uint64(32) | d[1:-3] << np.uint64(24) | d[2:-2] << np.uint64(16) | d[3:-1] << np.uint64(8) | d[4:]
    ahead = ahead.astype(np.int64)  # the 40 bits from each byte on
    top = len(ahead) - 1
    bit = starts.astype(np.int64) * 8
    offset = np.concatenate([[0], np.cumsum(per_lane)])
    out = np.zeros((int(offset[-1]), BLOCK), np.int16)
    component = np.empty(len(out), np.int16)
    before = {k: np.zeros(lanes, np.int64) for k, _, _ in units}

    def symbol(at: np.ndarray, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols and values at bit positions ``at``, and the positions after them."""
        word = ahead[np.minimum(at >> 3, top)]
        room = 40 - (at & 7)
        found = lut[word >> (room - 16) & 0xFFFF]
        length, sym = found >> 8, found & 255
        if not length.all():
            raise ValueError("a code that is in no table")
        size = sym & 15
        room = room - length - size
        raw = word >> room & (1 << size) - 1
        return sym, np.where(raw < (1 << size >> 1), raw - (1 << size) + 1, raw), at + length + size

    for block in range(int(per_lane.max(initial=0))):
        k, dc, ac = units[block % len(units)]
        live = np.nonzero(per_lane > block)[0]
        rows = offset[live] + block
        _, value, at = symbol(bit[live], _lookup(image.huffman[0, dc]))
        before[k][live] += value
        out[rows, 0] = before[k][live]
        component[rows] = k
        lut, place = _lookup(image.huffman[1, ac]), np.zeros(len(live), np.int64)
        going = np.arange(len(live))
        while going.size:
            sym, value, after = symbol(at if going.size == len(at) else at[going], lut)
            if going.size == len(at):
                at = after
            else:
                at[going] = after
            plain = (sym >> 4 == 0) & (sym & 15 > 0)
            if plain.all():
                place[going] += 1
            else:
                place[going] += np.where(sym == 0, BLOCK, (sym >> 4) + 1)
            in_block = place[going] < BLOCK
            out[rows[going[in_block]], place[going[in_block]]] = value[in_block]
            more = place[going] < BLOCK - 1
            if not more.all():
                going = going[more]
        bit[live] = at
    return out, component


def thumbnail(image: Image, dc: np.ndarray) -> np.ndarray:
    """One luminance pixel for each 8 x 8 block, from the first component's DC coefficients alone."""
    wide, high = image.mcus()
    _, h, v, q = image.frame[0]
    if len(image.scan) == 1:
        h = v = 1
    dc = dc.astype(np.int64) * int(image.quants[q][0])
    grid = dc.reshape(high, wide, v, h).transpose(0, 2, 1, 3).reshape(high * v, wide * h)
    return np.clip((grid + 4) // 8 + 128, 0, 255).astype(np.uint8)


def thumbnail_hash(pixels: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 x 8 reduction is above the mean of all."""
    rows = (np.arange(8) * pixels.shape[0]) // 8
    cols = (np.arange(8) * pixels.shape[1]) // 8
    total = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1), np.int64)
    total[1:, 1:] = pixels.astype(np.int64).cumsum(0).cumsum(1)
    r2 = np.maximum(((np.arange(8) + 1) * pixels.shape[0]) // 8, rows + 1)
    c2 = np.maximum(((np.arange(8) + 1) * pixels.shape[1]) // 8, cols + 1)
    cells = total[np.ix_(r2, c2)] - total[np.ix_(rows, c2)] - total[np.ix_(r2, cols)] + total[np.ix_(rows, cols)]
    area = (r2 - rows)[:, None] * (c2 - cols)[None, :]
    return np.packbits(cells * pixels.size > total[-1, -1] * area).tobytes().hex()


def _bytes_of(coefficients: np.ndarray) -> bytes:
    return np.where(coefficients < 0, coefficients + 128, coefficients + 127).astype(np.uint8).tobytes()


def _result(image: Image, payload: bytes, dc: np.ndarray) -> tuple[bytes, str]:
    size = struct.unpack(">Q", image.comment)[0]
    return payload[:size], f"{image.width}x{image.height}:{thumbnail_hash(thumbnail(image, dc))}"


def _read_long(image: Image, media: bytes) -> tuple[bytes, str]:
    """One image, with the coefficients of one piece of its scan in memory at once."""
    lanes, payload, dc = 0, bytearray(), []
    for piece in pieces_of(image, memoryview(media)[image.start :]):
        c, component = decode_scan(image, piece, lanes)
        lanes += -(-len(c) // max(1, image.interval * len(image.units())))
        payload += _bytes_of(c)
        dc.append(c[component == 0, 0].copy())
    return _result(image, payload, np.concatenate(dc))


def read_back(media: list[bytes]) -> list[tuple[bytes, str]]:
    """(payload, feature) of each stored image, from its bytes alone."""
    images = [parse(m) for m in media]
    groups: dict[tuple, list[int]] = {}
    out: list = [None] * len(media)
    for k, im in enumerate(images):  # images of like tables are decoded side by side, long ones each by itself
        if len(media[k]) > CHUNK:
            out[k] = _read_long(im, media[k])
            continue
        groups.setdefault((im.interval, im.interval == 1 or (im.width, im.height), tuple(sorted(im.huffman.items())), tuple(im.frame), tuple(im.scan)), []).append(k)
    for members in groups.values():
        coefficients, component = decode_scan(images[members[0]], b"".join(media[k][images[k].start :] for k in members))
        at = 0
        for k in members:
            im = images[k]
            wide, high = im.mcus()
            own = slice(at, at + wide * high * len(im.units()))
            at = own.stop
            c = coefficients[own]
            out[k] = _result(im, _bytes_of(c), c[component[own] == 0, 0])
    return out


_COLUMNS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_columns(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """The media columns of ``docs`` (doc_id, text); with ``keep_media`` also the images themselves."""
    text_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            waiting: list[tuple] = []
            held = 0

            def flush() -> None:
                stored = encode([p for _, _, p in waiting])
                for (doc, n, _), m, (p, feature) in zip(waiting, stored, read_back(stored), strict=True):
                    row = (doc, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature)
                    out.append(row + (m,) * keep_media)

            for doc, text in zip(ids, batch.column(1), strict=True):
                n, payload = payload_of(text.as_py())
                waiting.append((doc, n, payload))
                held += len(payload)
                if held >= CHUNK:
                    flush()
                    waiting.clear()
                    held = 0
            if waiting:
                flush()
                waiting.clear()
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.binary()] * keep_media]
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            names = [c.split()[0] for c in _COLUMNS.split(", ")] + ["media"] * keep_media
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(work, _COLUMNS + ", media binary" * keep_media)


def op10_jpeg_media(spark, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))
