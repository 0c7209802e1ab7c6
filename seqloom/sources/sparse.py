"""Count matrices of many samples or cells, as index tables and coordinates.

A folder holds three Parquet tables: ``rows`` (row, gene), ``columns`` (column, sample_id) and
``entries`` (row, column, n) of all counts that are not zero. Entries lie in blocks of the matrix,
sorted by block and place, so that a range of rows or columns reads few row groups. The
number of samples is not bounded, and no row or task holds a whole row or column of the matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.ordering import numbered

#: Rows and columns of a block.
BLOCK_ROWS = 4096
BLOCK_COLUMNS = 4096


def write_sparse_matrix(counts: DataFrame, path: str, order: DataFrame | None = None, block_rows: int = BLOCK_ROWS, block_columns: int = BLOCK_COLUMNS) -> None:
    """``counts`` (gene, sample_id, n) to a new folder; counts of one gene and sample are added up.

    Genes are numbered in the order of ``order`` (gene, line_no), those that it does not list last by name; samples by
    name. Genes and samples without any count keep their numbers.
    """
    genes = counts.select("gene").distinct()
    if order is None:
        rows = numbered(genes, "row", F.asc_nulls_first("gene"))
    else:
        listed = genes.join(order.groupBy("gene").agg(F.min("line_no").alias("line_no")), "gene", "left")
        rows = numbered(listed, "row", F.asc_nulls_last("line_no"), F.asc_nulls_first("gene"))
    columns = numbered(counts.select("sample_id").distinct(), "column", F.asc_nulls_first("sample_id"))
    rows.select("row", "gene").write.parquet(f"{path}/rows")
    columns.select("column", "sample_id").write.parquet(f"{path}/columns")
    spark = counts.sparkSession
    rows, columns = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/columns")
    summed = counts.groupBy("gene", "sample_id").agg(F.sum("n").alias("n")).filter("n <> 0")
    entries = summed.join(rows, summed["gene"].eqNullSafe(rows["gene"])).select("row", "sample_id", "n")
    entries = entries.join(columns, entries["sample_id"].eqNullSafe(columns["sample_id"])).select("row", "column", "n")
    block = [F.floor(F.col("row") / block_rows), F.floor(F.col("column") / block_columns)]
    entries.repartitionByRange(*block, "row", "column").sortWithinPartitions(*block, "row", "column").write.parquet(f"{path}/entries")


def read_sparse_matrix(spark: SparkSession, path: str, zeros: bool = False) -> DataFrame:
    """(gene, sample_id, n) as written; ``zeros`` gives every gene of every sample instead."""
    rows, columns, entries = (spark.read.parquet(f"{path}/{t}") for t in ("rows", "columns", "entries"))
    if zeros:
        every = rows.join(columns, F.lit(True))
        return every.join(entries, ["row", "column"], "left").select("gene", "sample_id", F.coalesce("n", F.lit(0)).alias("n"))
    return entries.join(rows, "row").join(columns, "column").select("gene", "sample_id", "n")


def matrix_columns(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """(gene, one column for each of ``samples``): the chosen columns of a matrix, zeros included.

    The samples' numbers reach the scan of the entries as a filter.
    """
    rows, columns, entries = (spark.read.parquet(f"{path}/{t}") for t in ("rows", "columns", "entries"))
    known = {r["sample_id"]: r["column"] for r in columns.filter(F.col("sample_id").isin(samples)).collect()}  # the samples asked for
    if missing := [x for x in samples if x not in known]:
        raise KeyError(missing)
    chosen = entries.filter(F.col("column").isin(list(known.values())))
    wide = chosen.groupBy("row").agg(*[F.sum(F.when(F.col("column") == known[x], F.col("n"))).alias(x) for x in samples])
    return rows.join(wide, "row", "left").select("gene", *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).cast("long").alias(x) for x in samples])


def uneven_genes(counts: DataFrame) -> DataFrame:
    """(gene, samples, rows): genes that are not in every sample exactly once, as one matrix of all samples needs them.

    The number of samples is a sub-query; nothing is collected.
    """
    every = counts.select(F.count_distinct("sample_id")).scalar()
    listed = counts.groupBy("gene").agg(F.count_distinct("sample_id").alias("samples"), F.count(F.lit(1)).alias("rows"))
    return listed.filter((F.col("samples") != every) | (F.col("rows") != every))
