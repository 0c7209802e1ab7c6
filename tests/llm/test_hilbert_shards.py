import itertools
import zlib

import numpy as np
import xxhash

from seqloom.llm import hilbert_shards as H
from tests.llm.conftest import EDGE_ROWS, make_docs, prose


def test_curve_visits_every_cell_in_steps_of_one():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = H.hilbert_index(points, bits)
        assert sorted(index.tolist()) == list(range(len(points)))
        path = points[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, got, count=8):
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert set(by) <= set(range(count))
    last = -1
    for shard in sorted(by):  # shards are runs of the curve
        curves = [r["curve"] for r in by[shard]]
        assert min(curves) >= last
        last = max(curves)
    return by


def test_edge_rows(edge_docs, no_docs):
    got = H.shards(edge_docs).collect()
    check(EDGE_ROWS, got)
    want = sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in EDGE_ROWS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    assert H.shards(no_docs).count() == 0


def test_bytes_are_even_and_copies_stay_together(spark):
    rows = [(i, prose(i % 900, 20 + i % 60), "en de fr".split()[i % 3], f"s{i % 11}") for i in range(1800)]
    rows += [(5000 + i, "the same text again " * 3, "en", f"s{i % 11}") for i in range(600)]
    got = H.shards(make_docs(spark, rows)).collect()
    by = check(rows, got)
    size = [sum(r["size"] for r in own) for own in by.values()]
    assert len(size) == 8 and max(size) < 1.03 * min(size)
    text = {d: t for d, t, _, _ in rows}
    shards_of = {}
    for r in got:
        shards_of.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    # the crowd of copies exceeds what is kept whole; all other groups are in one shard
    assert sum(len(s) > 1 for t, s in shards_of.items() if not t.startswith("the same")) == 0


def test_files_are_written_by_shard(spark, tmp_path):
    docs = make_docs(spark, [(i, prose(i), "en", f"s{i % 3}") for i in range(200)])
    H.write_shards(docs, str(tmp_path / "out"), 4, 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 4


def test_rows_without_and_with_the_same_doc_id_are_written_once_each(spark, edge_docs, tmp_path):
    H.write_shards(edge_docs, str(tmp_path / "out"), 3, 2)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((str(r["doc_id"]), str(r["text"]), str(r["source"])) for r in back) == sorted((str(d), str(t), str(s)) for d, t, _, s in EDGE_ROWS)


def slow_shards(rows, count):
    """(doc_id, shard, slot) by the rules, one row after the other."""
    n, side = len(rows), 1 << H.BITS

    def name_levels(values):
        ordered = sorted(values, key=lambda v: (v is not None, (v or "").encode()))
        return {v: ordered.index(v) * side // n for v in set(values)}

    lang, source = name_levels([r[2] for r in rows]), name_levels([r[3] for r in rows])
    sizes = sorted(len((r[1] or "").encode()) + 1 for r in rows)
    edges = sorted({sizes[max(0, -(-k * n // side) - 1)] for k in range(1, side)})
    least = {}
    for _, t, a, b in rows:
        least[t or ""] = min(least.get(t or "", (side, side)), (lang[a], source[b]))
    placed = []
    for d, t, _, _ in rows:
        size = len((t or "").encode()) + 1
        levels = [*least[t or ""], sum(size > e for e in edges)]
        key = xxhash.xxh64_intdigest((t or "").encode(), 42)
        placed.append((int(H.hilbert_index(np.array([levels]))[0]), key - (1 << 64) if key >> 63 else key, d, size, t or ""))
    placed.sort()
    total, at, starts = sum(sizes), 0, []
    for row in placed:
        starts.append(at)
        at += row[3]
    cuts = [0]
    for k in range(1, count):
        w = total * k // count
        i = next(j for j, row in enumerate(placed) if starts[j] <= w < starts[j] + row[3])
        group = [j for j, row in enumerate(placed) if row[4] == placed[i][4]]
        ends = [(starts[group[0]], group[0]), (starts[group[-1]] + placed[i][3], group[-1] + 1)]
        near = min(ends, key=lambda e: abs(e[0] - w))
        own = min([(starts[i], i), (starts[i] + placed[i][3], i + 1)], key=lambda e: abs(e[0] - w))
        cuts.append((near if abs(near[0] - w) <= H.BALANCE * total / count else own)[1])
    cuts.sort()
    return sorted((row[2], sum(j >= c for c in cuts) - 1, j - max(c for c in cuts if c <= j)) for j, row in enumerate(placed))


def test_shards_by_brute_force(spark):
    names = ["common-crawl-a", "common-crawl-b", "common-crawl-c", None, "zz"]
    rows = [(i, prose(i % 150, 5 + i % 40), [None, "en", "de"][i % 3], names[i % 5]) for i in range(400)]
    rows += [(1000 + i, "copy of a text", "fr", names[i % 5]) for i in range(150)] + [(2000 + i, None, "en", "s") for i in range(5)]
    got = H.shards(make_docs(spark, rows), 5).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == slow_shards(rows, 5)
