import math

import numpy as np
import pytest

from seqloom.operators import negbin as B
from seqloom.operators import norm as N

A3, B3 = ["a0", "a1", "a2"], ["b0", "b1", "b2"]


def drawn(rng, mu, alpha):
    return rng.poisson(mu if alpha == 0 else rng.gamma(1 / alpha, alpha * mu))


def counts_of(spark, k, samples, names=None):
    rows = [(names[g] if names else f"g{g:04d}", x, int(n)) for g, row in enumerate(k) for x, n in zip(samples, row, strict=True)]
    return spark.createDataFrame(rows, "gene string, sample_id string, n long")


def slow_likelihood(k, mu, side, alpha):
    r = 1 / alpha
    total = sum(math.lgamma(n + r) - math.lgamma(r) - r * math.log1p(alpha * m) + (n * math.log(alpha * m / (1 + alpha * m)) if n else 0) for n, m in zip(k, mu, strict=True))
    return total - sum(0.5 * math.log(sum(m / (1 + alpha * m) for m, g in zip(mu, side, strict=True) if g == h)) for h in (0, 1))


def test_log_gamma_and_trigamma():
    x = np.concatenate([np.linspace(1e-3, 30, 400), 10.0 ** np.arange(2, 9)])
    assert np.allclose(B.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)
    assert B.trigamma(1.0) == pytest.approx(math.pi**2 / 6, rel=1e-9) and B.trigamma(0.5) == pytest.approx(math.pi**2 / 2, rel=1e-9)


def test_fit_as_a_slow_search_gene_by_gene():
    rng = np.random.default_rng(4)
    s, side = np.array([0.7, 1.0, 1.4, 1.2, 0.9, 0.8]), np.array([0, 0, 0, 1, 1, 1])
    k = np.array([[drawn(rng, 80 * x * (1 + g % 3), [0.02, 0.2, 1.0][g % 3]) for x in s] for g in range(12)], float)
    alpha = np.full(12, 0.3)
    q = B.levels(k, s, side, alpha)
    for g in range(12):
        for h in (0, 1):
            score = sum((n - x * q[g, h]) / (1 + 0.3 * x * q[g, h]) for n, x, y in zip(k[g], s, side, strict=True) if y == h)
            assert abs(score) < 1e-6
    mu = q[:, side] * s
    got = B.best_dispersion(k, mu, side)
    prior = B.best_dispersion(k, mu, side, np.full(12, 0.1), 0.5)
    fine = np.exp(np.linspace(math.log(1e-8), math.log(10), 3000))
    for g in range(12):
        values = [slow_likelihood(k[g], mu[g], side, x) for x in fine]
        assert abs(math.log(got[g]) - math.log(fine[int(np.argmax(values))])) < 0.02 or max(values) - slow_likelihood(k[g], mu[g], side, got[g]) < 1e-6
        pulled = [v - (math.log(x) - math.log(0.1)) ** 2 for v, x in zip(values, fine, strict=True)]
        assert abs(math.log(prior[g]) - math.log(fine[int(np.argmax(pulled))])) < 0.02


def simulated(seed, genes=400, changed=40):
    rng = np.random.default_rng(seed)
    mean = np.exp(rng.uniform(math.log(20), math.log(2000), genes))
    true = (0.05 + 2 / mean) * np.exp(0.4 * rng.standard_normal(genes))
    s = np.array([0.8, 1.0, 1.3, 0.9, 1.1, 1.2])
    fold = np.where(np.arange(genes) < changed, np.where(np.arange(genes) % 2, 6.0, 1 / 6.0), 1.0)
    k = np.array([[drawn(rng, m * x * (f if j < 3 else 1), a) for j, x in enumerate(s)] for m, a, f in zip(mean, true, fold, strict=True)])
    return k, true, s


@pytest.fixture(scope="module")
def fitted(spark):
    k, true, s = simulated(1)
    out = B.negative_binomial_contrast(counts_of(spark, k, A3 + B3), A3, B3)
    return {r["gene"]: r for r in out.collect()}, true, s, k


def test_shrinkage_lowers_the_error_of_dispersions(fitted):
    rows, true, _, _ = fitted
    error = {c: np.mean([(math.log(max(rows[f"g{g:04d}"][c], 1e-4)) - math.log(t)) ** 2 for g, t in enumerate(true)]) for c in ("dispersion_gene", "dispersion_trend", "dispersion")}
    assert error["dispersion"] < 0.5 * error["dispersion_gene"]
    assert error["dispersion"] < 0.35


def test_trend_and_tests_of_simulated_genes(fitted):
    rows, true, s, _ = fitted
    m = np.array([rows[f"g{g:04d}"]["base_mean"] for g in range(len(true))])
    t = np.array([rows[f"g{g:04d}"]["dispersion_trend"] for g in range(len(true))])
    assert np.median(np.abs(np.log(t / (0.05 + 2 / m)))) < 0.4
    sure = {g for g, r in rows.items() if r["padj"] <= 0.05}
    planted = {f"g{g:04d}" for g in range(40)}
    assert len(sure & planted) >= 36 and len(sure - planted) <= 6
    null = [r["p"] for g, r in rows.items() if g not in planted]
    assert 0.02 < np.mean(np.array(null) < 0.05) < 0.10
    assert all(math.copysign(1, rows[f"g{g:04d}"]["lfc"]) == (1 if g % 2 else -1) for g in range(40))


def test_order_of_rows_and_batches_does_not_matter(spark, fitted):
    rows, _, _, k = fitted
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        again = {r["gene"]: r for r in B.negative_binomial_contrast(counts_of(spark, k, A3 + B3).orderBy("sample_id", "n"), A3, B3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g, r in rows.items():
        for c in ("lfc", "dispersion", "p", "padj"):
            assert again[g][c] == pytest.approx(r[c], rel=1e-5)


def test_genes_without_counts_and_one_sided_ones(spark):
    k, _, _ = simulated(2, genes=60, changed=0)
    k[0], k[1, :3], k[2, 3:] = 0, 0, 0
    out = {r["gene"]: r for r in N.contrast(counts_of(spark, k, A3 + B3), A3, B3, dispersion="shrunken").collect()}
    assert len(out) == 60 and out["g0000"]["p"] is None and out["g0000"]["padj"] is None
    assert out["g0001"]["mean_a"] == 0 and out["g0001"]["lfc"] < -2 and out["g0002"]["lfc"] > 2
    assert all(math.isfinite(r["lfc"]) for r in out.values())
    own = B.negative_binomial_contrast(counts_of(spark, k, A3 + B3), A3, B3, shrink=False).collect()
    assert all(r["dispersion"] == r["dispersion_gene"] for r in own)


def test_samples_that_are_missing_or_too_few(spark):
    k, _, _ = simulated(3, genes=20, changed=0)
    with pytest.raises(ValueError, match="more samples"):
        B.negative_binomial_contrast(counts_of(spark, k, A3 + B3), ["a0"], ["b0"])
    with pytest.raises(ValueError, match="without size factor"):
        B.negative_binomial_contrast(counts_of(spark, k, A3 + B3), A3, ["b0", "other"])
