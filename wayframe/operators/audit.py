"""Integrity of the stored catalog: seven checks as anti joins and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayframe.operators.catalog import Catalog
from wayframe.schemas import TYPE_TABLES


def integrity_failures(c: Catalog, compat: bool = False) -> DataFrame:
    """(check, problem_id, detail). compat looks only at a matrix's first row, and lets empty ones pass."""
    hub = c["problems"]
    rows = c.type_rows("dimension", "edge_weight_type", "coords")
    weight = F.when(F.col("storage").isin("ATSP", "SOP"), "EXPLICIT").otherwise(F.col("edge_weight_type"))
    explicit = rows.where(weight == "EXPLICIT")
    matrices = c.matrix_sizes()
    out = [hub.join(rows, F.col("id") == F.col("problem_id"), "left_anti").select(F.lit("hub_without_type_row").alias("check"), F.col("id").alias("problem_id"), F.col("name").alias("detail"))]
    for name in TYPE_TABLES.values():
        out.append(c[name].join(hub, F.col("problem_id") == F.col("id"), "left_anti").select(F.lit("type_row_without_hub").alias("check"), "problem_id", F.lit(name).alias("detail")))
    out.append(explicit.join(matrices, "problem_id", "left_anti").select(F.lit("explicit_without_matrix").alias("check"), "problem_id", F.col("storage").alias("detail")))
    size = F.col("size")
    ragged = (F.col("first" if compat else "least") != size) | (F.col("first" if compat else "most") != size) | (F.lit(not compat) & (size == 0))
    out.append(matrices.where(ragged).select(F.lit("matrix_not_square").alias("check"), "problem_id", size.cast("string").alias("detail")))
    sized = explicit.where(F.col("storage").isin("TSP", "ATSP")).select("problem_id", "dimension").join(matrices, "problem_id").where(size != F.col("dimension"))
    out.append(sized.select(F.lit("matrix_dimension").alias("check"), "problem_id", F.concat_ws("/", size.cast("string"), F.col("dimension").cast("string")).alias("detail")))
    n, first = F.size("coords"), F.size(F.get("coords", F.lit(0)))
    off = rows.where(F.col("storage").isin("TSP", "CVRP") & F.col("coords").isNotNull() & ((n != F.col("dimension")) | ~F.coalesce(first, F.lit(-1)).isin(2, 3)))
    out.append(off.select(F.lit("coordinate_dimension").alias("check"), "problem_id", F.concat_ws("/", n.cast("string"), F.col("dimension").cast("string")).alias("detail")))
    lost = c["solutions"].where("problem_id is not null").join(hub.select(F.col("id").alias("_h")), F.col("problem_id") == F.col("_h"), "left_anti")
    out.append(lost.select(F.lit("solution_without_problem").alias("check"), "problem_id", F.col("source_file").alias("detail")))
    found = out[0]
    for df in out[1:]:
        found = found.unionByName(df)
    return found
