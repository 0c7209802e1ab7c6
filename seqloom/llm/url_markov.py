"""URL verdicts by rules and, where none fits, by a character language-model ratio.

Two variable-order Markov models of URL bytes are counted, one over URLs that a rule allows and
one over those that a rule blocks. Orders 0 to ``ORDER`` are mixed by Witten-Bell smoothing: a
context is trusted by how often it was seen against how many different bytes followed it, and the
rest of the mass goes to the shorter context. A URL's score is the difference of its two log
likelihoods per byte. The threshold is calibrated on ruled URLs that the models were not counted
on, where it makes the mean of the two error rates least.

Counts cover all ruled URLs, whole, with query and fragment; host and path are for the rules only.
Counts are kept by the true context (order, bytes before, next byte), so the tables that the driver
collects and the executors get grow with the different contexts (16 bytes each); each batch is counted
in numpy and only its sums are shuffled, so no host or repeated URL gathers in a task.

Rules: null URLs and those without ``://`` have empty host and path and fit no rule; a null URL is
scored as the empty string, zero. Without ruled URLs of both kinds
the threshold is zero and everything unruled is allowed. Repeated rows are judged each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from seqloom.llm.common import table

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
SYMBOLS = 256
#: One ruled URL in so many is kept from the models for calibration, by hash.
ASIDE = 5
#: Score steps of the calibration histogram.
STEP, STEPS = 0.005, 4000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path, like ``net/``) and its verdict; nulls if none does."""
    name = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def _bytes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts end to end, each after ``ORDER`` pad symbols, and the texts' lengths."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    pad = b"\x00" * ORDER
    flat = np.frombuffer(b"".join(pad + r for r in raw), np.uint8)
    return flat.astype(np.int64), np.array([len(r) for r in raw], np.int64)


def _contexts(symbols: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The context of each order 0..ORDER at the positions ``at``: the order and the bytes before, as one number."""
    out, h = [np.zeros(len(at), np.int64)], np.zeros(len(at), np.int64)
    for k in range(1, ORDER + 1):
        h = h | symbols[at - k] << 8 * (k - 1)
        out.append(k << 8 * ORDER | h)
    return out


def _positions(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every byte in the padded symbols, and the text that it belongs to."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.arange(len(owner)) + ORDER * (owner + 1), owner


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for kind, own in batch.groupby("kind"):
            symbols, lengths = _bytes(own["url"].tolist())
            at, _ = _positions(lengths)
            found = []
            for context in _contexts(symbols, at):
                keys, n = np.unique(context * SYMBOLS + symbols[at], return_counts=True)
                found.append(pd.DataFrame({"kind": np.int32(kind), "key": keys, "n": n}))
            yield pd.concat(found)


def _at(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The values of the ``asked`` keys among the sorted ``known`` ones, zero for others."""
    if not len(known):
        return np.zeros((len(asked), *values.shape[1:]))
    place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[place] == asked
    return values[place] * hit.reshape(-1, *[1] * (values.ndim - 1))


class Models:
    """Byte counts of both kinds of URLs: sorted keys with counts, contexts with totals and different bytes."""

    def __init__(self, rows: pd.DataFrame):
        self.of = []
        for kind in (0, 1):
            own = rows[rows["kind"] == kind].sort_values("key")
            keys, n = own["key"].to_numpy(np.int64), own["n"].to_numpy(np.float64)
            contexts, first, kinds = np.unique(keys // SYMBOLS, return_index=True, return_counts=True)
            total = np.add.reduceat(n, first) if len(n) else n
            self.of.append((keys, n, contexts, np.column_stack([total, kinds]).astype(np.float64)))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Per text the log likelihood under allowed minus that under blocked URLs, per byte."""
        symbols, lengths = _bytes(texts)
        at, owner = _positions(lengths)
        here, diff = symbols[at], np.zeros(len(at))
        contexts = _contexts(symbols, at)
        for kind, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(at), 1.0 / SYMBOLS)
            keys, n, known, seen = self.of[kind]
            for context in contexts:
                total, kinds = _at(known, seen, context).T
                p = np.where(total > 0, (_at(keys, n, context * SYMBOLS + here) + kinds * p) / np.maximum(total + kinds, 1), p)
            diff += sign * np.log(p)
        return np.bincount(owner, diff, len(texts)) / np.maximum(lengths, 1)


def threshold(rows: list, default: float = 0.0) -> float:
    """The score from which on URLs are allowed: least mean error on the calibration histogram."""
    n = np.zeros((2, STEPS), np.int64)
    for r in rows:
        n[r["kind"], r["bin"]] = r["n"]
    if not n.sum(axis=1).all():
        return default
    refused = np.concatenate([[0], np.cumsum(n[1])]) / n[1].sum()  # allowed ones below each edge
    passed = 1 - np.concatenate([[0], np.cumsum(n[0])]) / n[0].sum()
    error = refused + passed
    best = np.nonzero(error <= error.min() + 1e-12)[0]
    return float((best[len(best) // 2] - STEPS // 2) * STEP)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    seen = parts.withColumn("rule", rule).withColumn("ruled", ruled).withColumn("text", F.coalesce("url", F.lit("")))
    known = seen.filter("ruled is not null").select(F.when(F.col("ruled") == "allow", 1).otherwise(0).alias("kind"), F.col("text").alias("url"), (F.pmod(F.xxhash64("text"), F.lit(ASIDE)) == 0).alias("aside"))
    counts = known.filter("not aside").select("kind", "url").mapInPandas(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    rows = counts.toArrow().to_pandas()  # a row for each different context and next byte
    shared = spark.sparkContext.broadcast(Models(rows))

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()), dtype="float64")

    place = F.greatest(F.lit(0), F.least(F.lit(STEPS - 1), F.floor(F.col("score") / STEP) + STEPS // 2)).cast("int")
    held = known.filter("aside").select("kind", score("url").alias("score")).groupBy("kind", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edge = threshold(held.collect())
    judged = seen.withColumn("score", score(F.col("text")))
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("score") >= edge, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op2_url_markov(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
