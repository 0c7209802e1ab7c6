"""Deterministic sampling: hashes instead of random numbers, so that runs agree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.intervals import feature_shares

BLOCK = 1_000_000
#: Upper bits of a hash whose buckets are counted.
HASH_BITS = 10


def hashed(key: Column, seed: int) -> Column:
    """A number in [0, 2^32) from a key and a seed, the same on any engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")


def sample_exact(reads: DataFrame, counts: DataFrame, seed: int, block: int = BLOCK, bits: int = HASH_BITS) -> DataFrame:
    """M1: exactly k reads of each sample (all, if it has fewer), spread evenly over blocks of reads.

    reads (sample_id, ord, read_id), counts (sample_id, k). Block b of a sample with n reads gets
    floor(k * end / n) - floor(k * start / n) of them, those of the least hashes. The upper ``bits`` of the hashes
    are counted by block; the counts say in which bucket the last taken read lies. Reads of lower buckets are
    taken as they pass, and only those of that bucket are ranked, a block's reads divided by 2**bits.
    """
    blocked = reads.withColumns({"block": F.floor(F.col("ord") / block), "_hash": hashed(F.col("read_id"), seed)}).withColumn("_bucket", F.shiftright("_hash", 32 - bits).cast("int"))
    sized = blocked.groupBy("sample_id", "block", "_bucket").agg(F.count(F.lit(1)).alias("c"))
    rows = sized.groupBy("sample_id", "block").agg(F.sum("c").alias("m"), F.array_sort(F.collect_list(F.struct("_bucket", "c"))).alias("buckets"))
    sample = Window.partitionBy("sample_id")
    before = F.coalesce(F.sum("m").over(sample.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = rows.select("sample_id", "block", "m", before.alias("before"), F.sum("m").over(sample).alias("n")).join(counts, "sample_id").withColumn("k", F.least("k", "n"))
    quota = F.floor(F.col("k") * (F.col("before") + F.col("m")) / F.col("n")) - F.floor(F.col("k") * F.col("before") / F.col("n"))
    quotas = shares.select("sample_id", "block", quota.cast("long").alias("quota")).filter("quota > 0")
    # the bucket in which a block's quota is reached, and how many it still takes of it
    start = F.struct(F.lit(None).cast("int").alias("cut"), F.col("quota").alias("left"))

    def step(state: Column, x: Column) -> Column:
        ended = state["cut"].isNotNull() | (state["left"] <= x["c"])
        return F.struct(F.when(state["cut"].isNotNull(), state["cut"]).when(ended, x["_bucket"]).alias("cut"), F.when(ended, state["left"]).otherwise(state["left"] - x["c"]).alias("left"))

    at = rows.join(quotas, ["sample_id", "block"]).select("sample_id", "block", F.aggregate("buckets", start, step).alias("at"))
    cuts = at.select("sample_id", "block", F.col("at.cut").alias("_cut"), F.col("at.left").alias("_left"))
    met = blocked.join(cuts, ["sample_id", "block"]).filter("_bucket <= _cut")
    order = Window.partitionBy("sample_id", "block").orderBy("_hash", "read_id")
    last = met.filter("_bucket = _cut").withColumn("_r", F.row_number().over(order)).filter("_r <= _left")
    return met.filter("_bucket < _cut").select(*reads.columns).unionByName(last.select(*reads.columns))


def sample_fraction(aln: DataFrame, pct: float, seed: int, block: int = BLOCK) -> DataFrame:
    """M2: floor(pct * pairs / 100) pairs of each block of each sample, mates together.

    A pair's block comes from a hash of its name, so that no order of files is needed.
    """
    names = aln.select("sample_id", "qname").distinct()
    sizes = names.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block))
    placed = names.join(sizes, "sample_id").withColumn("block", F.pmod(hashed(F.col("qname"), seed + 1), blocks))
    order = Window.partitionBy("sample_id", "block").orderBy(hashed(F.col("qname"), seed), "qname")
    whole = Window.partitionBy("sample_id", "block")
    chosen = placed.withColumns({"r": F.row_number().over(order), "m": F.count(F.lit(1)).over(whole)}).filter(F.col("r") <= F.floor(F.col("m") * pct / 100))
    return aln.join(chosen.select("sample_id", "qname"), ["sample_id", "qname"])


def depth_ladder(start_pct: float, end_pct: float, steps: int, repeats: int) -> list[tuple[int, int, float]]:
    """M3: (step, repeat, pct), geometric from start to end; a rung of 100 % comes once."""
    low, high = math.log2(start_pct), math.log2(end_pct)
    out = []
    for j in range(steps):
        pct = start_pct if steps == 1 else end_pct if j == steps - 1 else 2 ** (low + j * (high - low) / (steps - 1))
        out += [(j, r, float(pct)) for r in range(1 if pct >= 100 - 1e-9 else repeats)]
    return out


def ladder_frame(spark, rungs: list[tuple[int, int, float]]) -> DataFrame:
    return spark.createDataFrame(rungs, "step int, repeat int, pct double")


def ladder_reads(sizes: DataFrame, rungs: list[tuple[int, int, float]]) -> DataFrame:
    """M3: (sample_id, step, repeat, pct, reads): the reads of each sample of ``sizes`` (sample_id, n) at each rung."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.lit(r).alias("repeat"), F.lit(p).alias("pct")) for s, r, p in rungs]))
    out = sizes.select("sample_id", "n", each.alias("rung")).select("sample_id", "n", "rung.step", "rung.repeat", "rung.pct")
    return out.select("sample_id", "step", "repeat", "pct", F.floor(F.col("n") * F.col("pct") / 100).cast("long").alias("reads"))


def _first_rungs(frags: DataFrame, ladder: list, seed: int) -> tuple[DataFrame, list[tuple[int, int, Column]]]:
    """Fragments that any rung takes, once, with the lowest rung that takes them in each repeat, and (step, repeat, taken) of all rungs.

    A repeat's rungs are nested: a fragment is in each whose threshold is above its hash. Thresholds are compared as hex digits, and each hash is worked out once.
    """
    cuts: dict[int, list[tuple[float, int]]] = {}
    for r in ladder:
        cuts.setdefault(r["repeat"], []).append((r["pct"] / 100 * float(1 << 32), r["step"]))
    draws, firsts, rungs = [], [], []
    for k, (repeat, own) in enumerate(cuts.items()):
        draws.append(F.substring(F.md5(F.concat("name", F.lit(f":{seed}:{repeat}"))), 1, 8).alias(f"_d{k}"))
        draw, first = F.col(f"_drawn._d{k}"), F.lit(None).cast("tinyint")
        for nth, (edge, step) in reversed(list(enumerate(sorted(own)))):
            above = math.ceil(edge)
            first = F.when(draw < f"{max(above, 0):08x}" if above < 1 << 32 else draw.isNotNull(), F.lit(nth).cast("tinyint")).otherwise(first)
            rungs.append((step, repeat, F.col(f"_r{k}") <= nth))
        firsts.append(first.alias(f"_r{k}"))
    drawn = frags.select("sample_id", "acc", "start_pos", "end_pos", F.explode(F.array(F.struct(*draws))).alias("_drawn"))
    taken = drawn.select("sample_id", "acc", "start_pos", "end_pos", *firsts)
    return taken.filter(F.coalesce(*[f"_r{k}" for k in range(len(firsts))]).isNotNull()), rungs


def saturation_counts(frags: DataFrame, ladder: DataFrame, features: DataFrame, seed: int = 1) -> DataFrame:
    """M4: (sample_id, step, repeat, acc, name, n): fragments of each gene at each rung of the ladder.

    Each fragment meets its genes once, and its shares are added up side by side for all rungs; each repeat has a
    seed of its own.
    """
    taken, rungs = _first_rungs(frags, ladder.collect(), seed)
    sums = feature_shares(taken, features).groupBy("sample_id", "acc", "name").agg(*[F.sum(F.when(t, F.col("share"))).alias(f"_n{k}") for k, (_, _, t) in enumerate(rungs)])
    rows = F.array(*[F.struct(F.lit(step).alias("step"), F.lit(repeat).alias("repeat"), F.col(f"_n{k}").alias("n")) for k, (step, repeat, _) in enumerate(rungs)])
    return sums.select("sample_id", "acc", "name", F.inline(rows)).filter("n is not null").select("sample_id", "step", "repeat", "acc", "name", "n")


def saturation_curve(frags: DataFrame, ladder: DataFrame, features: DataFrame, seed: int = 1, min_count: float = 0.5) -> DataFrame:
    """M4: (sample_id, step, repeat, frags, genes): fragments taken at each rung of the ladder and the genes that they show."""
    taken, rungs = _first_rungs(frags, ladder.collect(), seed)
    shares = feature_shares(taken, features, whole=True)
    sums = shares.groupBy("sample_id", "acc", "name", "whole").agg(*[F.sum(F.when(t, F.col("share"))).alias(f"_n{k}") for k, (_, _, t) in enumerate(rungs)])
    each = [f"_n{k}" for k in range(len(rungs))]
    frags_of = [F.sum(F.when(F.col("whole"), F.col(n))).cast("long").alias(f"_f{n}") for n in each]
    genes_of = [F.count_if(~F.col("whole") & (F.round(n, 9) >= min_count)).alias(f"_g{n}") for n in each]
    sizes = sums.groupBy("sample_id").agg(*frags_of, *genes_of)
    rows = F.array(*[F.struct(F.lit(step).alias("step"), F.lit(repeat).alias("repeat"), F.col(f"_f{n}").alias("frags"), F.col(f"_g{n}").alias("genes")) for n, (step, repeat, _) in zip(each, rungs, strict=True)])
    return sizes.select("sample_id", F.inline(rows)).filter("frags is not null")
