"""Mix sources to target weights: whole copies plus one hash-seeded Bernoulli copy.

Each source gets a share of the mix by weight, at most ``max_epochs`` times its own size; what is
above goes to the others by weight until none is above. That fixed point is min(cap, level *
weight), and the level follows from one pass over the sources in the order of cap / weight.
A document of a source with rate r = target / source size is taken floor(r) times, and once more
if a number in [0, 1) drawn from a hash of its doc_id and the seed is below r - floor(r).

Only DataFrame functions are used. Nothing is grouped but one number per source, so a source with
a third of all rows is summed in every task first; the table of sources holds one row for each.

Rules: null text has size 0; null is a source of its own, ordered last; rows that repeat a doc_id
draw alike, and rows without doc_id draw from the empty string; a source of size 0 has target 0
and is not taken; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import WORD, durable, sized_broadcast, table

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the document and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, source_size), one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    capped = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(whole) * budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    stepped = capped.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    # the first source, by ratio, that the rest's level does not fill; from there on, all take that level
    settled = stepped.withColumn("final", F.min_by(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")), F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("place"))).over(whole))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap").cast("double")))
    return settled.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of ``docs`` (doc_id, text, source)."""
    base = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    per_source = durable(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), **shares))
    plan = sized_broadcast(per_source.withColumnRenamed("source", "of_source"))
    joined = base.join(plan, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    return joined.withColumn("copies", copies(F.col("doc_id"), F.col("target"), F.col("source_size"), seed))


def copies(doc_id: Column, target: Column, source_size: Column, seed: str = SEED) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)


def emit(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it."""
    sizes = docs.select(F.col("source").alias("source"), word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = sized_broadcast(durable(targets(sizes, **shares)).select(F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_size"), F.col("target").alias("_mix_target")))
    taken = docs.join(plan, docs["source"].eqNullSafe(F.col("_mix_source")))
    times = copies(docs["doc_id"], F.col("_mix_target"), F.col("_mix_size"), seed).cast("int")
    return taken.select(*[docs[c] for c in docs.columns], times.alias("_mix_copies")).filter("_mix_copies > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


SQL = rf"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sized AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM base GROUP BY source),
stepped AS (
  SELECT *, source_size * 2 AS cap,
         row_number() OVER r AS place,
         (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(source_size * 2) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM sized WINDOW r AS (ORDER BY source_size * 2 / CAST(weight AS DOUBLE), encode(source) NULLS LAST)),
final AS (SELECT arg_min(level, place) AS level FROM stepped WHERE level * weight <= cap),
plan AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(final.level * weight, cap)) AS target FROM stepped, final),
drawn AS (
  SELECT b.doc_id, b.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(coalesce(b.doc_id::VARCHAR, '') || ':{SEED}'), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE) AS draw
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""
