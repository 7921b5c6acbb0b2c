"""The read surface over a catalog, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayframe.operators.catalog import Catalog, edges_view, nodes_view, problems_view
from wayframe.schemas import TYPE_TABLES, NotFoundError, hub_type, storage_type


def problem_stats(c: Catalog) -> DataFrame:
    """type, count, avg_dimension (two digits, 0 without), max_dimension."""
    rows = c["problems"].join(c.type_rows("dimension"), F.col("id") == F.col("problem_id"), "left")
    out = rows.groupBy("type").agg(F.count("*").alias("count"), F.coalesce(F.round(F.avg("dimension"), 2), F.lit(0.0)).alias("avg_dimension"), F.coalesce(F.max("dimension"), F.lit(0)).alias("max_dimension"))
    return out.orderBy("type")


def query_problems(c: Catalog, problem_type: str | None = None, min_dimension: int | None = None, max_dimension: int | None = None, limit: int | None = 100) -> DataFrame:
    """Filtered listing by name; capacity only of the CVRP family, weight columns of TSP and CVRP."""
    rows = c["problems"].select("id", "name", "type")
    if problem_type is not None:
        rows = rows.where(F.col("type") == hub_type(problem_type))
    parts = c.type_rows("comment", "dimension", "capacity", "edge_weight_type", "edge_weight_format").drop("storage")
    if min_dimension is not None:
        parts = parts.where(F.col("dimension") >= min_dimension)
    if max_dimension is not None:
        parts = parts.where(F.col("dimension") <= max_dimension)
    out = rows.join(parts, F.col("id") == F.col("problem_id")).drop("problem_id").orderBy("name", "type")
    return out if limit is None else out.limit(limit)


def load_problem(c: Catalog, name: str, problem_type: str) -> dict:
    """All columns of one problem; NotFoundError without one."""
    table = TYPE_TABLES[storage_type(problem_type)]
    hub = c["problems"].where((F.col("name") == name) & (F.col("type") == hub_type(problem_type)))
    found = hub.join(c[table], F.col("id") == F.col("problem_id")).limit(1).collect()
    if not found:
        raise NotFoundError(f"no problem {name!r} of type {problem_type}")
    return found[0].asDict(recursive=True)


def load_matrix(c: Catalog, name: str, problem_type: str) -> list[list[int]] | None:
    hub = c["problems"].where((F.col("name") == name) & (F.col("type") == hub_type(problem_type)))
    found = c["edge_weight_matrices"].join(hub.select("id"), F.col("problem_id") == F.col("id")).select("matrix").limit(1).collect()
    return found[0].matrix if found else None


def export_problem(c: Catalog, problem_id: int) -> dict:
    row = c["problems"].where(F.col("id") == problem_id).limit(1).collect()
    if not row:
        raise NotFoundError(f"no problem {problem_id}")
    return load_problem(c, row[0].name, row[0].type)


def effective_weight_type(kind: Column, weight: Column, compat: bool = True) -> Column:
    """The stored weight type; EXPLICIT for ATSP (and, unless compat, SOP), which have matrices alone."""
    return F.coalesce(weight, F.when(kind.isin("ATSP") if compat else kind.isin("ATSP", "SOP"), "EXPLICIT"))


def list_problem_metadata(c: Catalog, problem_type: str) -> DataFrame:
    """Problems of a type by dimension, then name."""
    df = c[TYPE_TABLES[storage_type(problem_type)]]
    weight = F.col("edge_weight_type") if "edge_weight_type" in df.columns else F.lit(None).cast("string")
    hub = c["problems"].where(F.col("type") == hub_type(problem_type)).select("id", "name", "type", "has_solution")
    rows = hub.join(df, F.col("id") == F.col("problem_id"))
    return rows.select("id", "name", "type", "has_solution", "dimension", "comment", effective_weight_type(F.col("type"), weight).alias("edge_type")).orderBy("dimension", "name")


def problem_metadata(c: Catalog) -> DataFrame:
    """Every hub row with its type row and its tracked file of the smallest path, where there are."""
    first = c["file_tracking"].where("problem_id is not null").groupBy("problem_id").agg(F.min(F.struct("file_path", "checksum")).alias("f"))
    first = first.select(F.col("problem_id").alias("_p"), F.col("f.file_path").alias("source_file"), F.col("f.checksum").alias("file_checksum"))
    rows = c.type_rows("dimension", "comment", "edge_weight_type", "capacity").drop("storage")
    out = c["problems"].join(rows, F.col("id") == F.col("problem_id"), "left").join(first, F.col("id") == F.col("_p"), "left")
    return out.select("id", "name", "type", "has_solution", "dimension", "comment", "capacity", effective_weight_type(F.col("type"), F.col("edge_weight_type")).alias("edge_type"), "source_file", "file_checksum")


def load_problem_metadata(c: Catalog, problem_id: int) -> dict:
    found = problem_metadata(c).where(F.col("id") == problem_id).collect()
    if not found:
        raise NotFoundError(f"no problem {problem_id}")
    return found[0].asDict()


def file_info(c: Catalog, path: str) -> dict | None:
    """What is tracked of a file; None where it isn't."""
    found = c["file_tracking"].where(F.col("file_path") == path).limit(1).collect()
    return found[0].asDict() if found else None


def failure_counts(failures: DataFrame) -> DataFrame:
    """Failures by stage and kind of error, with how many files they are in."""
    return failures.groupBy("stage", "error_type").agg(F.count("*").alias("errors"), F.countDistinct("path").alias("files"))


def load_matrix_metadata(c: Catalog, problem_id: int) -> dict | None:
    found = c["edge_weight_matrices"].where(F.col("problem_id") == problem_id).select("matrix_format", "is_symmetric", F.size("matrix").alias("size")).collect()
    return found[0].asDict() if found else None


def load_solution(c: Catalog, problem_id: int) -> dict | None:
    """The problem's solution of the smallest id."""
    found = c["solutions"].where(F.col("problem_id") == problem_id).orderBy("id").limit(1).collect()
    return found[0].asDict(recursive=True) if found else None


# --- the documented catalogue of queries ---


def bucket(column: str, limits: list[tuple[int, str]], last: str) -> Column:
    out = F.lit(last)
    for top, name in reversed(limits):
        out = F.when(F.col(column) < top, name).otherwise(out)
    return out


SIZES = [(50, "small"), (100, "medium"), (500, "large")]


def size_buckets(c: Catalog) -> DataFrame:
    return problems_view(c).groupBy(bucket("dimension", SIZES, "huge").alias("size_class")).agg(F.count("*").alias("problems"))


def weight_categories(c: Catalog) -> DataFrame:
    w = F.col("edge_weight_type")
    category = F.when(w.isin("EUC_2D", "CEIL_2D", "EUC_3D"), "euclidean").when(w.isin("GEO"), "geographic").when(w.isNull() | (w == "EXPLICIT"), "explicit").otherwise("other")
    return problems_view(c).groupBy(category.alias("category")).agg(F.count("*").alias("problems"), F.max("dimension").alias("max_dimension"))


def with_capacity(c: Catalog) -> DataFrame:
    return problems_view(c).where("capacity is not null").select("name", "type", "capacity", "dimension")


def between(c: Catalog, low: int, high: int) -> DataFrame:
    return problems_view(c).where(F.col("dimension").between(low, high)).select("name", "type", "dimension").orderBy("dimension", "name")


def nodes_of(c: Catalog, name: str) -> DataFrame:
    hub = c["problems"].where(F.col("name") == name).select("id", "name")
    return hub.join(nodes_view(c), F.col("id") == F.col("problem_id")).select("name", "node_id", "x", "y", "demand").orderBy("node_id")


def node_counts(c: Catalog) -> DataFrame:
    """Every problem with its number of nodes; counted from the arrays, without exploding them."""
    sizes = c.type_rows("coords").select("problem_id", F.size("coords").alias("n"))
    rows = c["problems"].join(sizes, F.col("id") == F.col("problem_id"), "left")
    return rows.select("name", "type", F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)).alias("nodes"))


def matrix_listing(c: Catalog) -> DataFrame:
    rows = c.matrix_sizes(cell_0_5=(0, 5)).withColumnRenamed("size", "matrix_size")
    return c["problems"].join(rows, F.col("id") == F.col("problem_id")).select("name", "type", "matrix_size", "is_symmetric", "cell_0_5")


def type_summary(c: Catalog) -> DataFrame:
    p = problems_view(c)
    out = p.groupBy("type").agg(F.count("*").alias("problems"), F.min("dimension").alias("min_dimension"), F.max("dimension").alias("max_dimension"), F.sum("dimension").alias("total_nodes"), F.countDistinct(F.when(F.col("comment").isNotNull(), F.col("name"))).alias("commented"))
    return out


def storage_summary(c: Catalog) -> DataFrame:
    m = c["edge_weight_matrices"].select("problem_id", F.lit(True).alias("has_matrix"))
    p = problems_view(c).join(m, F.col("id") == F.col("problem_id"), "left")
    n = c.type_rows("coords").select(F.col("problem_id").alias("_n"), F.col("coords").isNotNull().alias("has_nodes"))
    p = p.join(n, F.col("id") == F.col("_n"), "left")
    method = F.when(F.col("has_matrix"), "matrix").when(F.col("has_nodes"), "coordinates").otherwise("none")
    return p.groupBy("type", method.alias("storage_method")).agg(F.countDistinct("id").alias("problems"))


def matrix_dimension_audit(c: Catalog) -> DataFrame:
    m = c.matrix_sizes().select("problem_id", F.col("size").alias("matrix_size"))
    p = problems_view(c).join(m, F.col("id") == F.col("problem_id")).withColumn("difference", F.abs(F.col("dimension") - F.col("matrix_size")))
    return p.where("difference > 0").select("name", "type", "dimension", "matrix_size", "difference").orderBy(F.col("difference").desc(), "name")


def coverage(c: Catalog) -> DataFrame:
    n = c.type_rows("coords").where("coords is not null").select(F.col("problem_id").alias("_n"))
    m = c["edge_weight_matrices"].select(F.col("problem_id").alias("_m"))
    p = c["problems"].join(n, F.col("id") == F.col("_n"), "left").join(m, F.col("id") == F.col("_m"), "left")
    return p.agg(F.countDistinct("id").alias("problems"), F.countDistinct("_n").alias("with_nodes"), F.countDistinct("_m").alias("with_matrix"))


def largest_nodes(c: Catalog, limit: int = 10) -> DataFrame:
    """Nodes of the problem with the most of them, by a scalar subquery's plan: a semi join."""
    top = problems_view(c).where("storage in ('TSP', 'CVRP')").orderBy(F.col("dimension").desc(), "name").limit(1).select("id")
    return nodes_view(c).join(top, F.col("problem_id") == F.col("id"), "left_semi").select("problem_id", "node_id", "x", "y").orderBy("node_id").limit(limit)


def edge_stats(c: Catalog) -> DataFrame:
    """Edge weights by problem, for those with edges; n^2 rows exist within generated code alone, none of them moves."""
    w = F.col("weight")
    return edges_view(c).groupBy("problem_id").agg(F.count("*").alias("edges"), F.sum(w.cast("long")).alias("total_weight"), F.min(w).alias("min_weight"), F.max(w).alias("max_weight"))


def weight_histogram(c: Catalog, width: int = 20) -> DataFrame:
    return edges_view(c).groupBy(F.floor(F.col("weight") / width).cast("int").alias("bucket")).agg(F.count("*").alias("edges"))


def depot_counts(c: Catalog) -> DataFrame:
    rows = c["cvrp_problems"].select("problem_id", F.size("depots").alias("depots"), F.aggregate("demands", F.lit(0).cast("long"), lambda s, x: s + x).alias("total_demand"))
    return c["problems"].join(rows, F.col("id") == F.col("problem_id")).select("name", "depots", "total_demand")
