import hashlib
import struct
import subprocess
import sys
import zlib

import numpy as np
import pytest

from seqloom.llm import jpeg_media as J
from tests.llm.conftest import EDGE_ROWS, prose


@pytest.mark.parametrize("n", [1, 2, 5, 65, 300])
def test_round_trip(n):
    payload = np.random.default_rng(n).integers(0, 256, n * 64, np.uint8).tobytes()
    (media,) = J.encode([payload])
    image = J.parse(media)
    assert media[:2] == b"\xff\xd8" and media[-2:] == b"\xff\xd9"
    assert (image.width // 8, image.height // 8) == J.shape(len(payload))
    ((back, feature),) = J.read_back([media])
    assert back == payload and feature.startswith(f"{image.width}x{image.height}:")
    assert all(b != 0xFF or media[i + 1] in (0, *range(0xD0, 0xDA)) for i, b in enumerate(media[image.start : -1], image.start))


def test_images_together_equal_images_alone():
    payloads = [bytes([k]) * 64 * (k % 7 + 1) for k in range(40)] + [b"\xff" * 640]
    together = J.encode(payloads)
    assert together == [J.encode([p])[0] for p in payloads]
    assert [p for p, _ in J.read_back(together)] == payloads


def pack_bits(bits):
    bits += "1" * (-len(bits) % 8)
    raw = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))
    return raw.replace(b"\xff", b"\xff\x00")


def magnitude(v):
    size = abs(v).bit_length()
    return size, format(v if v > 0 else v + (1 << size) - 1, f"0{size}b") if size else ""


def foreign_image(mcus, interval, sampling):
    """A baseline image as other writers make it: zero runs, end-of-block codes, several components."""
    dc = {s: n for s, n in zip(range(12), [2, 3, 3, 3, 3, 3, 4, 5, 6, 7, 8, 9], strict=True)}
    ac = {0x00: 4, 0xF0: 8, 0x01: 2, 0x02: 3, 0x03: 4, 0x21: 5, 0x32: 7, 0x05: 6, 0x07: 8}
    codes = [J.canonical(J._table_segment(t)) for t in (dc, ac)]
    scan, bits, before = b"", "", [0] * len(sampling)
    n = 0
    for m, blocks in enumerate(mcus):
        if interval and m and m % interval == 0:
            scan += pack_bits(bits) + bytes([0xFF, 0xD0 + n % 8])
            bits, before, n = "", [0] * len(sampling), n + 1
        for comp, block in blocks:
            size, raw = magnitude(block[0] - before[comp])
            before[comp] = block[0]
            code, length = codes[0][size]
            bits += format(code, f"0{length}b") + raw
            run = 0
            last = max((k for k in range(1, 64) if block[k]), default=0)
            for k in range(1, last + 1):
                if not block[k]:
                    run += 1
                    continue
                while run > 15:
                    code, length = codes[1][0xF0]
                    bits += format(code, f"0{length}b")
                    run -= 16
                size, raw = magnitude(block[k])
                code, length = codes[1][run << 4 | size]
                bits += format(code, f"0{length}b") + raw
                run = 0
            if last < 63:
                code, length = codes[1][0x00]
                bits += format(code, f"0{length}b")
    scan += pack_bits(bits) + b"\xff\xd9"
    wide = len(mcus) * 8 * max(h for h, _ in sampling)
    head = b"\xff\xd8" + J._segment(0xDB, b"\0" + bytes([2] * 64))
    head += J._segment(0xC0, struct.pack(">BHHB", 8, 8 * max(v for _, v in sampling), wide, len(sampling)) + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(sampling)))
    head += J._segment(0xC4, b"\0" + J._table_segment(dc)) + J._segment(0xC4, b"\x10" + J._table_segment(ac))
    if interval:
        head += J._segment(0xDD, struct.pack(">H", interval))
    head += J._segment(0xDA, bytes([len(sampling)]) + b"".join(bytes([c + 1, 0]) for c in range(len(sampling))) + b"\0\x3f\0")
    return head + scan


@pytest.mark.parametrize("interval", [0, 2])
@pytest.mark.parametrize("sampling", [[(1, 1)], [(2, 1), (1, 1), (1, 1)]])
def test_foreign_images_decode(interval, sampling):
    r = np.random.default_rng(7)

    def block():
        out = [0] * 64
        out[0] = int(r.integers(-200, 200))
        at = 1
        while at < 64 and r.random() < 0.8:
            run, v = [(0, 1), (0, -1), (0, 3), (2, 1), (3, 2), (0, 6), (18, 2), (0, 100)][r.integers(0, 8)]
            at += run
            if run == 18:  # a run over 15 needs its own code, then (2, 1)
                v = 1
            if at < 64:
                out[at] = v
            at += 1
        return out

    order = [c for c, (h, v) in enumerate(sampling) for _ in range(h * v)]
    mcus = [[(c, block()) for c in order] for _ in range(5)]
    media = foreign_image(mcus, interval, sampling)
    image = J.parse(media)
    got, component = J.decode_scan(image, media[image.start :])
    assert got.tolist() == [b for m in mcus for _, b in m]
    assert component.tolist() == [c for m in mcus for c, _ in m]
    pixels = J.thumbnail(image, got[component == 0, 0])
    luma = [b[0] for m in mcus for c, b in m if c == 0]
    assert pixels.ravel().tolist() == [min(255, max(0, (2 * d + 4) // 8 + 128)) for d in luma]


def test_other_formats_are_refused():
    for bad in (b"", b"PNG", b"\xff\xd8\xff\xc2\x00\x0b" + b"\x08\x00\x08\x00\x08\x01\x01\x11\x00"):
        with pytest.raises(ValueError):
            J.parse(bad)


def test_media_columns_of_edge_rows(edge_docs, no_docs):
    rows = J.media_columns(edge_docs, keep_media=True).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r, (doc, text, _, _) in zip(rows, EDGE_ROWS, strict=True):
        raw = (text or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r["doc_id"], r["n_bytes"], r["payload_bytes"]) == (doc, len(raw), len(padded))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["tail_crc32"] == zlib.crc32(padded[-64:])
        assert r["media_bytes"] == len(r["media"]) and r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest()
        assert J.read_back([bytes(r["media"])])[0] == (padded, r["feature"])
    assert J.media_columns(no_docs).count() == 0


def test_pieces_of_a_scan_change_nothing(monkeypatch):
    texts = ["", "x" * 10, prose(1, 400), "\u00ff\u4e2d" * 300]
    media = J.encode([J.payload_of(t)[1] for t in texts])
    want = J.read_back(media)
    monkeypatch.setattr(J, "CHUNK", 128)
    assert J.read_back(media) == want and [p for p, _ in want] == [J.payload_of(t)[1] for t in texts]


PEAK = """
import resource, sys
from seqloom.llm import jpeg_media as J
text = "the quick brown fox jumps over it " * (int(sys.argv[1]) * 31000)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
payload = J.payload_of(text)[1]
[(back, feature)] = J.read_back(J.encode([payload]))
assert back == payload
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


@pytest.mark.parametrize("mb, most", [(16, 200), (64, 600)])
def test_peak_memory_of_long_texts(mb, most):
    said = subprocess.run([sys.executable, "-c", PEAK, str(mb)], capture_output=True, text=True, check=True)
    assert int(said.stdout) < most, said.stdout
