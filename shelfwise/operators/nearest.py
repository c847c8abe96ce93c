"""Exact top-k over vectors: largest dot product, or largest cosine."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.operators.cells import BestK, Grid, best_pairs, plan_grid
from shelfwise.operators.products import LEFT, Rule, offer_products, side
from shelfwise.session import parallelism

# Vectors per packed row.
TILE = 1024


def topk_dot(
    users: DataFrame, items: DataFrame, k: int = 100, vector: str = "features",
    single_precision: bool = False, digits: int | None = None, grid: Grid | None = None,
) -> DataFrame:
    """For each user the k items with the largest positive dot product: ``id, pid, r``.

    ``single_precision`` scores as floats, as a factor model predicts. ``digits`` ranks by the
    score rounded to so many decimals.
    """
    return _topk(users, items, k, vector, grid, Rule(None, single_precision, digits), unit=False)


def topk_cosine(
    items: DataFrame, k: int = 100, vector: str = "features",
    digits: int | None = None, grid: Grid | None = None,
) -> DataFrame:
    """For each item the k other items with the largest positive cosine: ``id, pid, r``."""
    return _topk(items, items, k, vector, grid, Rule(LEFT, digits=digits), unit=True)


def _topk(left, right, k, vector, grid, rule, unit):
    """``id`` has to be a key on both sides."""
    spark = left.sparkSession
    n_left = left.count()
    n_right = n_left if rule.same else right.count()
    grid = grid or plan_grid(n_left, n_right, 256, 256, k, parallelism(spark))

    blocks = (
        _tiles(left, vector, n_left, grid.blocks)
        .withColumn("block", F.col("tile") % grid.blocks)
        .withColumn("strip", _each(grid.strips))
    )
    strips = (
        _tiles(right, vector, n_right, grid.strips)
        .withColumn("block", _each(grid.blocks))
        .withColumn("strip", F.col("tile") % grid.strips)
    )
    cell = (F.col("block") * grid.strips + F.col("strip")).cast("int").alias("cell")
    blocks = blocks.select(cell, "tile", "ids", "values")
    strips = strips.select(cell, "tile", "ids", "values")

    def open_cell(table: pa.Table):
        ids, block = _matrix(table, unit)
        block = side(ids, block, True)
        rows = np.flatnonzero(~(block.lengths == 0))
        floor = np.full(ids.size, -np.inf)

        def offer(best: BestK, tiles: pa.Table):
            for at in range(tiles.num_rows):
                partners, vectors = _matrix(tiles.slice(at, 1), unit)
                if partners.size:
                    offer_products(best, 0, block, rows, side(partners, vectors, False), rule, floor)

        return ids, offer

    found = best_pairs(blocks, strips, grid, k, open_cell, ["tile"])
    id_type, pid_type = left.schema["id"].dataType, right.schema["id"].dataType
    return found.select(F.col("id").cast(id_type), F.col("pid").cast(pid_type), "r")


def _each(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _tiles(df: DataFrame, vector: str, n: int, multiple: int) -> DataFrame:
    """Vectors packed into rows of about ``TILE``; ids are keys, so their hash spreads evenly."""
    n_tiles = -(-max(n, 1) // (TILE * multiple)) * multiple
    member = F.struct(F.col("id").cast("long").alias("id"), F.col(vector).alias("v"))
    members = F.sort_array(F.collect_list(member))
    return (
        df.where(F.col("id").isNotNull() & F.col(vector).isNotNull())
        .groupBy(F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(n_tiles)).alias("tile"))
        .agg(members.alias("m"))
        .select("tile", F.col("m.id").alias("ids"), F.flatten("m.v").alias("values"))
    )


def _matrix(table: pa.Table, unit: bool):
    """Ids and a double matrix from packed rows; unit rows if asked, zero vectors stay zero."""
    ids = table.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    values = table.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if values.size % max(ids.size, 1):
        raise ValueError("vectors differ in length")
    matrix = values.astype(np.float64).reshape(ids.size, -1)
    if unit:
        norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
        matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    return ids, matrix
