"""Importance resampling of documents towards a target corpus.

Features are the words of a text (and longer runs of words, if asked for), hashed to ``BUCKETS``
buckets. What the documents and the target hold of each bucket gives an array of gains, and a
document's weight is the mean gain of its features, looked up in that array in numpy. Gumbel noise
from a hash of doc_id turns the highest scores into a draw without replacement in proportion to
the exponential weights.

The cutoff of the draw is found without sorting the documents: a quantile sketch gives a bracket
of scores, exact counts above and within it show whether the cutoff lies inside, the bracket is
widened until it does, and only its rows are sorted. The drawn rows, and they alone, are then
sorted by ranges for their ranks.

Rules: null and empty texts have no features and weight 0; a null doc_id counts as the empty text
in the hash and comes last among ties; rows that repeat a doc_id are drawn each for itself;
columns other than ``doc_id`` and ``text`` are left alone; with no documents the result is empty.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import in_order, table, text_batches, written

BUCKETS = 10_000
SEED = 2024
#: Documents of fewer words are scored but not drawn.
LEAST_WORDS = 20
PERCENT = 10
#: The sketch's rank error is one part in this many.
SKETCH = 10_000
#: Bytes of a text that are cut into words at a time, and words a worker remembers the buckets of.
SLICE = 1 << 20
REMEMBERED = 500_000

# ASCII digits and letters, lower-cased, and all bytes of other characters stay; the rest parts words
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class _Buckets(dict):
    """The bucket of a feature's bytes, remembered."""

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % BUCKETS
        return found


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a slice at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        while end < len(text) and _WORD_BYTES[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_WORD_BYTES).split()
        at = end


def feature_buckets(text: bytes, longest: int, known: _Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features) of each slice of a text; runs of words go on across slices."""
    before: list[bytes] = []
    for words in word_slices(text):
        features, joined = words, before + words
        for n in range(2, longest + 1):
            first = max(0, len(before) - n + 1)
            features = features + [b" ".join(joined[k : k + n]) for k in range(first, len(joined) - n + 1)]
        before = joined[max(0, len(joined) - longest + 1) :] if longest > 1 else []
        yield len(words), np.fromiter(map(known.__getitem__, features), np.int64, len(features))


def _counted(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = _Buckets(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py() or b"", longest, known):
                    totals += np.bincount(found, minlength=BUCKETS)
        there = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": there, "n": totals[there]})

    return work


def bucket_counts(texts: DataFrame, longest: int = 1) -> np.ndarray:
    """How many features of all ``texts`` (text) fall into each bucket; the driver sees one row for each bucket."""
    text_batches(texts.sparkSession)
    found = texts.select(F.col("text").cast("binary")).mapInArrow(_counted(longest), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(BUCKETS, np.int64)
    for r in found.collect():
        totals[r["bucket"]] = r["n"]
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((b + 1.0) * (s + BUCKETS)) / ((a + 1.0) * (t + BUCKETS)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(seed: int, doc_id: int | None) -> int:
    """Thousandths of standard Gumbel noise, rounded down, from a hash of doc_id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, longest: int = 1, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_features, weight, score. ``target`` has text."""
    gains = bucket_gains(bucket_counts(docs, longest), bucket_counts(target, longest))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets()
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                words = features = gained = 0
                for n, found in feature_buckets(text.as_py() or b"", longest, known):
                    words, features, gained = words + n, features + len(found), gained + int(gains[found].sum())
                weight = gained // features if features else 0
                rows.append((words, features, weight, weight + gumbel(seed, doc_id)))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight", "score"])

    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(work, "doc_id long, n_words long, n_features long, weight long, score long")


def by_score(rows: DataFrame) -> DataFrame:
    """``rows`` with their place by descending score, then doc_id, then row."""
    return in_order(rows, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))


def cutoff(rows: DataFrame, draw: int, total: int, sketch: int = SKETCH) -> tuple[int, int | None, int]:
    """(score, doc_id, row) of the last of the ``draw`` first of ``rows``, of which there are ``total``; 0 < draw <= total."""
    margin = 2.0 / sketch
    while True:
        share = 1 - draw / total
        bounds = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = rows.agg(F.percentile_approx("score", bounds, sketch).alias("q")).first()["q"]
        if margin >= 1:  # the sketch has had every chance: all rows
            low, high = rows.agg(F.min("score").alias("a"), F.max("score").alias("b")).first()
        inside = F.col("score").between(low, high)
        n = rows.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(inside).alias("inside")).first()
        if n["above"] < draw <= n["above"] + n["inside"]:
            return tuple(by_score(rows.filter(inside)).filter(F.col("place") == draw - n["above"]).select("score", "doc_id", "row").first())
        margin *= 4


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = 1, seed: int = SEED, sketch: int = SKETCH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words or more the floor(percent * N / 100) highest
    scores are drawn, ties to smaller doc_id; rank is null for all others.
    """
    rows = written(scored(docs, target, longest, seed).withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    eligible = rows.filter(able)
    total = eligible.count()
    draw = percent * total // 100
    kept = ["doc_id", "n_features", "weight", "score"]
    if not draw:
        return rows.select(*kept, F.lit(None).cast("long").alias("rank"))
    score, doc_id, row = cutoff(eligible, draw, total, sketch)
    tie = F.col("score") == score
    if doc_id is None:
        first = F.col("doc_id").isNotNull() | (F.col("row") <= row)
    else:
        first = F.coalesce((F.col("doc_id") < doc_id) | (F.col("doc_id") == doc_id) & (F.col("row") <= row), F.lit(False))
    drawn = able & ((F.col("score") > score) | tie & first)
    ranked = by_score(rows.filter(drawn)).select(*kept, F.col("place").alias("rank"))
    return ranked.unionByName(rows.filter(~drawn).select(*kept, F.lit(None).cast("long").alias("rank")))


def op13_target_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 byte by byte over a table that the polynomial gives, for each different word.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b AS byte, b::BIGINT AS v, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
words AS (SELECT side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM texts),
counted AS (SELECT side, doc_id, w, count(*) AS n FROM words GROUP BY ALL),
vocabulary AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM counted)),
hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(x) // 2), lambda i: (16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM vocabulary, crc),
sums AS (SELECT b.bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM (SELECT unnest(range(10000)) AS bucket) AS b LEFT JOIN (SELECT * FROM counted JOIN hashed USING (w)) AS c USING (bucket) GROUP BY ALL),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM sums, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums)),
weighed AS (SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM counted JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY ALL),
filled AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, substr(sha256(concat('2024:', d.doc_id)), 1, 8) AS h FROM documents AS d LEFT JOIN weighed AS w ON d.doc_id = w.doc_id),
scored AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((list_reduce(list_concat([0::BIGINT], list_transform(range(8), lambda i: (instr('0123456789abcdef', h[i + 1]) - 1)::BIGINT)), lambda a, b: 16 * a + b) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM filled),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, r.rank FROM scored AS s LEFT JOIN ranked AS r ON s.doc_id = r.doc_id AND r.rank <= 10 * r.total // 100
"""
