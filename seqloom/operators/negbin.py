"""Negative-binomial fits of two groups of samples, with dispersions drawn towards their trend.

Counts of a gene have mean s q (s the sample's size factor, q the group's level) and variance
mean + dispersion * mean^2. Genes are fitted in numpy, a batch of genes at a time; what genes have in
common (the trend of dispersions over means, and how far genes scatter about it) is summed up by
Spark between the fits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.norm import adjusted, size_factors, two_sided
from seqloom.sources.scratch import Table

LEAST = 1e-8
#: Estimates below this say nothing about the trend.
TELLING = 100 * LEAST
#: Times that levels and dispersions are fitted in turn.
TURNS = 4
GRID = 40
GOLDEN = (math.sqrt(5) - 1) / 2


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, carried back by the recurrence; for x > 0."""
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total += 1 / (x * x)
        x += 1
    z = 1 / (x * x)
    return total + 1 / x + z / 2 + z / x * (1 / 6 - z * (1 / 30 - z / 42))


def levels(k: np.ndarray, s: np.ndarray, side: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Maximum-likelihood levels (genes x 2) of both groups at given dispersions, by Fisher scoring."""
    out = np.zeros((len(k), 2))
    for g in (0, 1):
        own, size = k[:, side == g], s[side == g]
        q = (own / size).mean(axis=1)
        for _ in range(25):
            mu = size * q[:, None]
            w = 1 / (1 + alpha[:, None] * mu)
            q = np.maximum(q + ((own - mu) * w).sum(axis=1) / (size * w).sum(axis=1), 0.0)
        out[:, g] = q
    return out


def adjusted_likelihood(k: np.ndarray, mu: np.ndarray, side: np.ndarray, log_alpha: np.ndarray) -> np.ndarray:
    """Log likelihood of each gene's dispersion, less half the log determinant of the levels' information (Cox and Reid)."""
    r = np.exp(-log_alpha)[:, None]
    total = (log_gamma(k + r) - log_gamma(np.broadcast_to(r, k.shape)) - (k + r) * np.log1p(mu / r) + k * np.log(np.maximum(mu, 1e-300) / r)).sum(axis=1)
    w = mu / (1 + mu / r)
    return total - 0.5 * sum(np.log(np.maximum(w[:, side == g].sum(axis=1), 1e-300)) for g in (0, 1))


def best_dispersion(k: np.ndarray, mu: np.ndarray, side: np.ndarray, centre: np.ndarray | None = None, spread: float = 0.0) -> np.ndarray:
    """The dispersions that maximise the adjusted likelihood, with a normal prior on the log scale if ``centre`` is given.

    A grid finds each gene's best neighbourhood, golden sections narrow it.
    """

    def value(x: np.ndarray) -> np.ndarray:
        out = adjusted_likelihood(k, mu, side, x)
        return out if centre is None else out - (x - np.log(centre)) ** 2 / (2 * spread)

    grid = np.linspace(math.log(LEAST), math.log(max(10.0, k.shape[1])), GRID)
    at = np.argmax([value(np.full(len(k), x)) for x in grid], axis=0)
    low, high = grid[np.maximum(at - 1, 0)], grid[np.minimum(at + 1, GRID - 1)]
    for _ in range(30):
        a, b = high - GOLDEN * (high - low), low + GOLDEN * (high - low)
        left = value(a) > value(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return np.exp((low + high) / 2)


def gene_dispersion(k: np.ndarray, s: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Each gene's own dispersion: levels and dispersion in turn, from the moment estimate on."""
    x = k / s
    mean, var = x.mean(axis=1), x.var(axis=1, ddof=1)
    alpha = np.clip((var - mean) / np.maximum(mean, 1e-12) ** 2, 0.01, 10)
    for _ in range(TURNS):
        alpha = best_dispersion(k, levels(k, s, side, alpha)[:, side] * s, side)
    return alpha


def _fits(samples: list[str], s: np.ndarray, fit: Callable[[np.ndarray, dict[str, np.ndarray]], dict[str, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches (gene, at, n, ...) with the columns that ``fit`` makes of the genes' counts (genes x samples) and other columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.zeros((batch.num_rows, len(samples)))
            at, n = batch.column("at"), batch.column("n")
            k[np.repeat(np.arange(batch.num_rows), at.value_lengths().to_numpy()), at.flatten().to_numpy()] = n.flatten().to_numpy()
            rest = {c: batch.column(c) for c in batch.schema.names if c not in ("at", "n")}
            made = fit(k, {c: x.to_numpy() for c, x in rest.items() if c != "gene"}) if batch.num_rows else {}
            if made:
                yield pa.RecordBatch.from_pydict({"gene": rest["gene"], "at": at, "n": n} | made)

    return work


def trend(genes: DataFrame) -> tuple[float, float]:
    """(a, b) of the trend a + b / mean of dispersions: a gamma fit, reweighted until it stands.

    Genes far off the last fit do not count. The driver sees five sums a round.
    """
    rows = genes.filter(F.col("dispersion_gene") > TELLING)
    a, b = 0.1, 1.0
    for _ in range(20):
        m, d = F.col("base_mean"), F.col("dispersion_gene")
        fitted = a + b / m
        near = rows.filter((d / fitted > 1e-4) & (d / fitted < 15))
        w = 1 / (fitted * fitted)
        t = near.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(x) for x, c in (("w", w), ("wx", w / m), ("wxx", w / (m * m)), ("wy", w * d), ("wxy", w * d / m))], F.avg(d).alias("mean")).first()
        if not t["n"]:
            return 0.01, 0.0
        det = t["w"] * t["wxx"] - t["wx"] ** 2
        before = a, b
        a, b = ((t["wxx"] * t["wy"] - t["wx"] * t["wxy"]) / det, (t["w"] * t["wxy"] - t["wx"] * t["wy"]) / det) if det > 1e-12 * t["w"] * t["wxx"] else (t["mean"], 0.0)
        if a <= 0 or b < 0:  # no such curve: one dispersion for all
            return t["mean"], 0.0
        if abs(math.log(a / before[0])) + abs(b - before[1]) / (b + 1e-12) < 1e-6:
            break
    return a, b


def dispersions(counts: DataFrame, group_a: list[str], group_b: list[str], shrink: bool = True) -> tuple[DataFrame, list[str], np.ndarray]:
    """(gene, at, n, base_mean, dispersion_gene, dispersion_trend, dispersion), the samples in order, their size factors.

    A gene's row lists the counts of the contrast's samples (at: place in the list). Genes without
    counts are left out. A gene whose own dispersion lies more than two standard deviations above the
    trend keeps it.
    """
    samples = [*group_a, *group_b]
    if len(samples) <= 2:
        raise ValueError("dispersions need more samples than groups")
    own = counts.filter(F.col("sample_id").isin(samples))
    found = {r["sample_id"]: r["factor"] for r in size_factors(own).collect()}  # the listed samples
    if missing := [x for x in samples if x not in found]:
        raise ValueError(f"no gene has counts in all samples; without size factor: {missing}")
    s, side = np.array([found[x] for x in samples]), np.array([0] * len(group_a) + [1] * len(group_b))
    place = F.element_at(F.create_map(*[F.lit(v) for k, x in enumerate(samples) for v in (x, k)]), F.col("sample_id"))
    listed = own.groupBy("gene", place.alias("at")).agg(F.sum("n").cast("double").alias("n")).filter("n > 0")
    lists = listed.groupBy("gene").agg(F.collect_list(F.struct("at", "n")).alias("own")).select("gene", F.col("own.at").alias("at"), F.col("own.n").alias("n"))
    kinds = "gene string, at array<int>, n array<double>, base_mean double, dispersion_gene double"
    genes = Table(lists.mapInArrow(_fits(samples, s, lambda k, _: {"base_mean": (k / s).mean(axis=1), "dispersion_gene": gene_dispersion(k, s, side)}), kinds)).df
    a, b = trend(genes)
    genes = genes.withColumn("dispersion_trend", F.greatest(F.lit(LEAST), a + b / F.col("base_mean")))
    off = F.log("dispersion_gene") - F.log("dispersion_trend")
    telling = genes.filter(F.col("dispersion_gene") > TELLING)
    middle = telling.agg(F.percentile(off, 0.5)).first()[0] or 0.0
    scatter = (1.4826 * (telling.agg(F.percentile(F.abs(off - middle), 0.5)).first()[0] or 0.0)) ** 2
    prior = max(scatter - trigamma((len(samples) - 2) / 2), 0.25)
    if not shrink:
        return genes.withColumn("dispersion", F.col("dispersion_gene")), samples, s

    def shrunken(k: np.ndarray, of: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        centre = of["dispersion_trend"]
        best = best_dispersion(k, levels(k, s, side, of["dispersion_gene"])[:, side] * s, side, centre, prior)
        far = np.log(of["dispersion_gene"]) > np.log(centre) + 2 * math.sqrt(scatter)
        return {c: of[c] for c in ("base_mean", "dispersion_gene", "dispersion_trend")} | {"dispersion": np.where(far, of["dispersion_gene"], best)}

    return genes.mapInArrow(_fits(samples, s, shrunken), kinds + ", dispersion_trend double, dispersion double"), samples, s


def negative_binomial_contrast(counts: DataFrame, group_a: list[str], group_b: list[str], shrink: bool = True) -> DataFrame:
    """(gene, base_mean, mean_a, mean_b, lfc, dispersion_gene, dispersion_trend, dispersion, p, padj), ordered by padj.

    lfc is log2 of the levels A / B, p of a Wald test at the final dispersion, padj Benjamini-Hochberg's.
    A group without any counts stands for half a count in all its samples together. Genes without
    counts have no p and no dispersion. ``shrink=False`` tests at each gene's own dispersion.
    """
    fitted, samples, s = dispersions(counts, group_a, group_b, shrink)
    side = np.array([0] * len(group_a) + [1] * len(group_b))
    least = np.array([0.5 / s[side == g].sum() for g in (0, 1)])

    def wald(k: np.ndarray, of: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        q = levels(k, s, side, of["dispersion"])
        seen = np.maximum(q, least)
        mu = seen[:, side] * s
        w = mu / (1 + of["dispersion"][:, None] * mu)
        error = np.sqrt(sum(1 / w[:, side == g].sum(axis=1) for g in (0, 1)))
        change = np.log(seen[:, 0] / seen[:, 1])
        return {c: of[c] for c in ("base_mean", "dispersion_gene", "dispersion_trend", "dispersion")} | {"mean_a": q[:, 0], "mean_b": q[:, 1], "lfc": change / math.log(2), "z": change / error}

    kinds = "gene string, at array<int>, n array<double>, " + ", ".join(f"{c} double" for c in ("base_mean", "dispersion_gene", "dispersion_trend", "dispersion", "mean_a", "mean_b", "lfc", "z"))
    columns = ["gene", "base_mean", "mean_a", "mean_b", "lfc", "dispersion_gene", "dispersion_trend", "dispersion"]
    tested = fitted.mapInArrow(_fits(samples, s, wald), kinds).select(*columns, two_sided(F.col("z")).alias("p"))
    totals = counts.filter(F.col("sample_id").isin(samples)).groupBy("gene").agg(F.sum("n").alias("n"))
    none = [F.lit(None).cast("double").alias(c) for c in [*columns[5:], "p"]]
    silent = totals.filter("n = 0").select("gene", *[F.lit(0.0).alias(c) for c in columns[1:5]], *none)
    return adjusted(Table(tested.unionByName(silent)).df).orderBy(F.asc_nulls_last("padj"), F.asc_nulls_last("p"), "gene")
