"""Validation of parsed instances: rules as columns, errors as data."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayframe.functions.matrix import is_symmetric
from wayframe.schemas import ALL_TYPES, DISPLAY_TYPES, EDGE_DATA_FORMATS, MATRIX_FORMATS, NEEDS_WEIGHTS, NODE_COORD_TYPES, THREED_WEIGHTS, TWOD_WEIGHTS, WEIGHT_SOURCES, WEIGHT_TYPES


def rules(types: Collection[str] = ()) -> dict[str, Column]:
    """Message to the condition under which it holds; a null condition is none. types are allowed beside the known ones."""
    p = F.col("problem_data")
    n, kind, weight = p["dimension"], p["type"], F.upper(p["edge_weight_type"])
    size = F.size
    coords, depots, demands, edges, fixed, tours = (F.col(c) for c in ("coords", "depots", "demands", "edges", "fixed_edges", "tours"))
    dims = F.array_distinct(F.transform(coords, lambda c: size(c)))
    dim = F.get(dims, F.lit(0))
    outside = lambda x: (x < 0) | (x >= n)
    bad_pair = lambda e: (size(e) != 2) | F.exists(e, outside)
    bijective = lambda ids: (size(ids) > 0) & ((F.array_min(ids) != 1) | (F.array_max(ids) != n) | (size(ids) != n))
    word = lambda c, allowed: c.isNotNull() & ~F.upper(c).isin(*sorted(allowed))
    explicit, fmt = weight == "EXPLICIT", F.upper(p["edge_weight_format"])
    coord_type, display_type = F.upper(p["node_coord_type"]), F.upper(p["display_data_type"])
    functional = F.coalesce(fmt == "FUNCTION", F.lit(False))
    numbers = F.coalesce(F.col("edge_weights")["count"], F.lit(0))
    cvrp = kind == "CVRP"
    return {
        "NAME is missing": p["name"].isNull() | (F.trim(p["name"]) == ""),
        "TYPE is missing": kind.isNull(),
        "TYPE is unknown": word(kind, {*ALL_TYPES, *types}),
        "DIMENSION must be a positive number": n.isNull() | (n <= 0),
        "EDGE_WEIGHT_TYPE is unknown": word(weight, WEIGHT_TYPES),
        "EDGE_WEIGHT_TYPE is missing": kind.isin(*NEEDS_WEIGHTS) & weight.isNull(),
        "NODE_COORD_TYPE is unknown": word(p["node_coord_type"], NODE_COORD_TYPES),
        "DISPLAY_DATA_TYPE is unknown": word(p["display_data_type"], DISPLAY_TYPES),
        "EDGE_DATA_FORMAT is unknown": word(p["edge_data_format"], EDGE_DATA_FORMATS),
        "EXPLICIT needs EDGE_WEIGHT_FORMAT": explicit & fmt.isNull(),
        "EDGE_WEIGHT_FORMAT is unknown": word(fmt, {*MATRIX_FORMATS, "FUNCTION"}),
        "EXPLICIT needs EDGE_WEIGHT_SECTION": explicit & ~functional & (numbers == 0),
        "EDGE_WEIGHT_SECTION doesn't fit its format": explicit & ~functional & (numbers > 0) & ~F.coalesce(F.col("edge_weights")["fits"], F.lit(False)),
        "NO_COORDS with coordinates": (coord_type == "NO_COORDS") & (size(coords) > 0),
        "NO_DISPLAY with display data": (display_type == "NO_DISPLAY") & (size("display_coords") > 0),
        "TWOD_DISPLAY needs DISPLAY_DATA_SECTION": (display_type == "TWOD_DISPLAY") & (size("display_coords") == 0),
        "coordinates of nodes 1 to DIMENSION are needed": bijective(F.col("coord_ids")),
        "coordinates have mixed dimensions": size(dims) > 1,
        "coordinates don't have NODE_COORD_TYPE's dimension": ((coord_type == "TWOD_COORDS") & (dim != 2)) | ((coord_type == "THREED_COORDS") & (dim != 3)),
        "coordinates don't have EDGE_WEIGHT_TYPE's dimension": (weight.isin(*TWOD_WEIGHTS) & (dim != 2)) | (weight.isin(*THREED_WEIGHTS) & (dim != 3)),
        "demands of nodes 1 to DIMENSION are needed": bijective(F.col("demand_ids")),
        "demands must not be negative": F.exists(demands, lambda x: x < 0),
        "CAPACITY must be positive": p["capacity"] <= 0,
        "DEMAND_SECTION is missing": cvrp & (size(demands) == 0),
        "depots are out of range": F.exists(depots, outside),
        "depots must have no demand": (size(demands) > 0) & F.exists(depots, lambda d: F.coalesce(F.get(demands, d) != 0, F.lit(False))),
        "EDGE_DATA_SECTION is missing": (kind == "HCP") & (size(edges) == 0),
        "edges are out of range": F.exists(edges, bad_pair),
        "fixed edges are out of range": F.exists(fixed, bad_pair),
        "TOUR_SECTION is missing": (kind == "TOUR") & (size(tours) == 0),
        "tours must visit each node once": F.exists(tours, lambda t: (size(t["nodes"]) != n) | (size(F.array_distinct(t["nodes"])) != n) | F.exists(t["nodes"], outside)),
        "display data must have DIMENSION rows": (size("display_coords") > 0) & (size("display_coords") != n),
        **_metadata_rules(),
    }


def _metadata_rules() -> dict[str, Column]:
    """The metadata against the payload it describes: flags, the source of weights, and symmetry computed anew."""
    m, p, matrix = F.col("metadata"), F.col("problem_data"), F.col("matrix")
    weight, source = F.upper(p["edge_weight_type"]), m["weight_source"]
    flags = {"has_coordinates": "coords", "has_display_coords": "display_coords", "has_demands": "demands", "has_depots": "depots", "has_edges": "edges", "has_fixed_edges": "fixed_edges", "has_tours": "tours"}
    wrong = [m[f] != (F.size(c) > 0) for f, c in flags.items()]
    return {
        "a flag doesn't fit its payload": F.greatest(*(w.cast("int") for w in wrong)) == 1,
        "weight_source is unknown": ~F.coalesce(source.isin(*WEIGHT_SOURCES), F.lit(False)),
        "weight_source doesn't fit EDGE_WEIGHT_TYPE": ((source == "coordinate_based") & ~F.coalesce(weight.isin(*TWOD_WEIGHTS, *THREED_WEIGHTS), F.lit(False))) | ((source == "explicit_matrix") & ~F.coalesce(weight == "EXPLICIT", F.lit(False))),
        "is_symmetric doesn't fit the matrix": matrix.isNotNull() & m["is_symmetric"] & ~is_symmetric(matrix),
    }


def validate(parsed: DataFrame, types: Collection[str] = ()) -> DataFrame:
    """Adds the messages of broken rules to errors, sorted; types are those of a dialect."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(f"ValidationError: {m}")) for m, c in rules(types).items())))
    return parsed.withColumn("errors", F.array_sort(F.concat("errors", found)))


def split_valid(checked: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and one row (key, stage, error_type, error) for each error of the others."""
    good = checked.where(F.size("errors") == 0)
    bad = checked.where(F.size("errors") > 0).select(key, F.explode("errors").alias("_e"))
    kind = F.regexp_extract("_e", r"^(\w+): ", 1)
    return good, bad.select(key, F.when(kind == "ParseError", "parse").otherwise("validate").alias("stage"), kind.alias("error_type"), F.regexp_replace("_e", r"^\w+: ", "").alias("error"))


def summary(checked: DataFrame) -> DataFrame:
    """total, successful, failed, success_rate (percent)."""
    ok = F.count_if(F.size("errors") == 0)
    total = F.count("*")
    return checked.agg(total.alias("total"), ok.alias("successful"), (total - ok).alias("failed"), F.round(F.when(total > 0, ok * 100.0 / total).otherwise(0.0), 2).alias("success_rate"))


def coordinates_valid(coords: Column) -> Column:
    """All rows of two or three numbers."""
    return F.forall(coords, lambda c: F.size(c).isin(2, 3) & F.forall(c, lambda x: x.isNotNull()))
