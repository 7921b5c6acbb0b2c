"""Vocabularies, storage routing and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the file format: type names, weight types, formats and keywords.
CORE_TYPES = ("TSP", "ATSP", "SOP", "HCP", "CVRP", "TOUR")
ALIASES = {"VRP": "CVRP"}
ATSP_FAMILY = ("ATSP",)
HCP_FAMILY = ("HCP", "HPP")
SOP_FAMILY = ("SOP",)
CVRP_FAMILY = tuple(
    "CVRP VRP ACVRP ADCVRP CCVRP CLUVRP CVRPTW DCVRP MDVRP MDVRPTW OVRP PDPTW RCTVRP RCTVRPTW SOFTCLUVRP VRPB VRPBTW VRPMPD VRPMPDTW VRPSPD VRPSPDTW".split()
)
TSP_FAMILY = tuple(
    "TSP 1-PDTSP BMTSP BWTSP CATSPP K-TSP M-PDTSP M1-PDTSP MDMTSP MLP MTRP MTRPD MTSP O-K-TSP OP PC-TSP PDTSP PDTSPF PDTSPL PTP PTSP STTSP TOP TRP TSPDL TSPPD TSPTW TSP_MD".split()
)
STORAGE = {t: s for s, family in (("TSP", TSP_FAMILY), ("ATSP", ATSP_FAMILY), ("CVRP", CVRP_FAMILY), ("HCP", HCP_FAMILY), ("SOP", SOP_FAMILY)) for t in family}
STORABLE_TYPES = frozenset(STORAGE)
ALL_TYPES = STORABLE_TYPES | {"TOUR"}
TYPE_TABLES = {s: f"{s.lower()}_problems" for s in ("TSP", "ATSP", "CVRP", "HCP", "SOP")}
TABLES = ("problems", *TYPE_TABLES.values(), "edge_weight_matrices", "file_tracking", "solutions")
EXTENSION_HINTS = {".tsp": "TSP", ".atsp": "ATSP", ".sop": "SOP", ".hcp": "HCP", ".vrp": "VRP", ".tour": "TOUR"}
TWOD_WEIGHTS = ("EUC_2D", "MAX_2D", "MAN_2D", "CEIL_2D", "GEO", "ATT")
THREED_WEIGHTS = ("EUC_3D", "MAX_3D", "MAN_3D", "XRAY1", "XRAY2")
WEIGHT_TYPES = ("EXPLICIT", *TWOD_WEIGHTS, *THREED_WEIGHTS, "SPECIAL")
NODE_COORD_TYPES = ("TWOD_COORDS", "THREED_COORDS", "NO_COORDS")
DISPLAY_TYPES = ("COORD_DISPLAY", "TWOD_DISPLAY", "NO_DISPLAY")
EDGE_DATA_FORMATS = ("EDGE_LIST", "ADJ_LIST")
MATRIX_FORMATS = ("FULL_MATRIX", "UPPER_ROW", "LOWER_ROW", "UPPER_DIAG_ROW", "LOWER_DIAG_ROW", "UPPER_COL", "LOWER_COL", "UPPER_DIAG_COL", "LOWER_DIAG_COL")
NO_DIAGONAL = {"LOWER_DIAG_ROW": "LOWER_ROW", "UPPER_DIAG_ROW": "UPPER_ROW", "LOWER_DIAG_COL": "LOWER_COL", "UPPER_DIAG_COL": "UPPER_COL"}
WEIGHT_SOURCES = ("explicit_matrix", "explicit_function", "coordinate_based", "special_function", "unweighted")
NEEDS_WEIGHTS = ("TSP", "ATSP", "SOP", "CVRP")
STRING_HEADERS = ("NAME", "COMMENT", "TYPE", "NODE_COORD_TYPE", "EDGE_WEIGHT_TYPE", "DISPLAY_DATA_TYPE", "EDGE_WEIGHT_FORMAT", "EDGE_DATA_FORMAT")
INT_HEADERS = ("DIMENSION", "CAPACITY", "VEHICLES", "PERIODS", "CAPACITY_VOL", "CAPACITY_WEIGHT", "SALESMEN", "EXTERNAL_SALESMEN", "SCALE", "RISK_THRESHOLD", "K")
NUMBER_HEADERS = ("DISTANCE", "SERVICE_TIME", "GRID_SIZE", "PROBABILITY")
CORE_SECTIONS = ("NODE_COORD_SECTION", "EDGE_DATA_SECTION", "EDGE_WEIGHT_SECTION", "DISPLAY_DATA_SECTION", "FIXED_EDGES_SECTION", "DEPOT_SECTION", "DEMAND_SECTION", "TOUR_SECTION")
EXTENDED_SECTIONS = ("TIME_WINDOW_SECTION", "SERVICE_TIME_SECTION", "BACKHAUL_SECTION", "PICKUP_AND_DELIVERY_SECTION", "DEPOT_CAPACITY_SECTION", "DEPOT_DURATION_SECTION", "REQUIRED_NODES_SECTION")
STRIPPED_SECTIONS = ("TIME_WINDOW_SECTION", "PICKUP_AND_DELIVERY_SECTION", "PICKUP_SECTION", "SERVICE_TIME_SECTION", "BACKHAUL_SECTION", "DELIVERY_SECTION", "PICKUP_DELIVERY_SECTION", "STANDTIME_SECTION", "READY_TIME_SECTION", "DUE_DATE_SECTION")
COMPRESSIONS = ("snappy", "gzip", "zstd", "uncompressed")

_INTS, _PAIRS, _COORDS = T.ArrayType(T.IntegerType()), T.ArrayType(T.ArrayType(T.IntegerType())), T.ArrayType(T.ArrayType(T.DoubleType()))


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


_I, _S, _B, _TS = T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampType()
_HEAD = (("problem_id", _I, False), ("dimension", _I, False))
_TAIL = (("comment", _S, True), ("tsplib_name", _S, True))
SCHEMAS = {
    "problems": _table(("id", _I, False), ("name", _S, False), ("type", _S, False), ("has_solution", _B, False), ("created_at", _TS, True), ("updated_at", _TS, True)),
    "tsp_problems": _table(*_HEAD, ("comment", _S, True), ("edge_weight_type", _S, False), ("edge_weight_format", _S, True), ("tsplib_name", _S, True), ("coords", _COORDS, True), ("display_coords", _COORDS, True)),
    "atsp_problems": _table(*_HEAD, *_TAIL),
    # capacity is null where depots differ in theirs
    "cvrp_problems": _table(*_HEAD, ("capacity", _I, True), ("comment", _S, True), ("edge_weight_type", _S, False), ("edge_weight_format", _S, True), ("tsplib_name", _S, True), ("coords", _COORDS, True), ("demands", _INTS, False), ("depots", _INTS, False)),
    "hcp_problems": _table(*_HEAD, ("adjacency", _PAIRS, False), *_TAIL),
    "sop_problems": _table(*_HEAD, ("fixed_edges", _PAIRS, True), *_TAIL),
    "edge_weight_matrices": _table(("problem_id", _I, False), ("matrix_format", _S, False), ("is_symmetric", _B, False), ("matrix", _PAIRS, False)),
    "file_tracking": _table(("id", _I, False), ("file_path", _S, False), ("problem_id", _I, True), ("checksum", _S, True), ("last_processed", _TS, True), ("file_size", T.LongType(), True)),
    "solutions": _table(("id", _I, False), ("problem_id", _I, True), ("kind", _S, False), ("quality", _S, False), ("source_file", _S, False), ("checksum", _S, True), ("cost", T.DoubleType(), True), ("routes", _PAIRS, False), ("created_at", _TS, True)),
}


class RoutingError(Exception):
    """Base of the errors that driver-side calls raise; data errors are rows instead."""


class FormatError(RoutingError):
    pass


class ParseError(FormatError, ValueError):
    pass


class ValidationError(FormatError):
    pass


class UnsupportedFeatureError(FormatError):
    pass


class CordeauParseError(ParseError):
    pass


class SolutionParseError(ParseError):
    pass


class TransformError(RoutingError):
    pass


class OutputError(RoutingError):
    pass


class DatabaseError(RoutingError):
    pass


class NotFoundError(DatabaseError):
    pass


ERRORS = {e.__name__: e for e in (FormatError, ParseError, ValidationError, UnsupportedFeatureError, CordeauParseError, SolutionParseError, TransformError, OutputError, DatabaseError, NotFoundError)}


def raise_first(errors: list[str]) -> None:
    """The first of a row's errors (`error_type: message`) as an exception; nothing where there is none."""
    if errors:
        kind, _, message = errors[0].partition(": ")
        raise ERRORS.get(kind, FormatError)(message)


def canonical_type(raw: str | None) -> str | None:
    """TSP (some author) -> TSP, VRP -> CVRP; an unknown name is given back stripped."""
    if not isinstance(raw, str) or not raw.strip():
        return None
    head = raw.split("(")[0].split()
    token = head[0].upper() if head else ""
    token = ALIASES.get(token, token)
    return token if token in ALL_TYPES else raw.strip()


def hub_type(raw: str | None) -> str:
    found = canonical_type(raw)
    if found not in STORABLE_TYPES:
        raise DatabaseError(f"type {raw!r} can't be stored")
    return found


def storage_type(raw: str | None) -> str:
    return STORAGE[hub_type(raw)]
