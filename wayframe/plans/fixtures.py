"""Queries over small instance texts, one set a nation: layouts, broken files, tours, routes, multi-depot files, a second upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.functions import distance
from wayframe.operators import catalog as cat
from wayframe.operators import queries, sinks, validate
from wayframe.plans import derived
from wayframe.plans.registry import QUERIES, register
from wayframe.schemas import MATRIX_FORMATS
from wayframe.sources import cordeau, instances, solutions

TSP = "NAME : @\nTYPE : TSP\nDIMENSION : 3\nEDGE_WEIGHT_TYPE : EUC_2D\nNODE_COORD_SECTION\n1 0 0\n2 3 4\n3 0 8\nEOF\n"
CVRP = "NAME : @\nTYPE : CVRP\nDIMENSION : 3\nCAPACITY : 10\nEDGE_WEIGHT_TYPE : euc_2d\nNODE_COORD_SECTION\n1 0 0\n2 1 1\n3 2 2\nDEMAND_SECTION\n1 0\n2 4\n3 5\nDEPOT_SECTION\n1\n-1\nEOF\n"
ATSP = "NAME : @\nTYPE : ATSP\nDIMENSION : 2\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : FULL_MATRIX\nEDGE_WEIGHT_SECTION\n0 1\n2 0\nEOF\n"
HCP = "NAME : @\nTYPE : HCP\nDIMENSION : 3\nEDGE_DATA_FORMAT : ADJ_LIST\nEDGE_DATA_SECTION\n1 2 3 -1\n2 3 -1\n-1\nEOF\n"
TOUR = "NAME : @\nTYPE : TOUR\nDIMENSION : 3\nTOUR_SECTION\n3 1 2 -1\nEOF\n"
TIMES = CVRP.replace("TYPE : CVRP", "TYPE : CVRPTW").replace("EOF", "TIME_WINDOW_SECTION\n1 0 10\n2 2 5.5\n3 1 9\nEOF")

#: (text, its errors as type: message), each alone.
FAULTS: list[tuple[str, list[str]]] = [
    (TSP.replace("NAME : @\n", ""), ["ValidationError: NAME is missing"]),
    (HCP.replace("TYPE : HCP\n", ""), ["ValidationError: TYPE is missing"]),
    (TSP.replace(": TSP", ": ODD"), ["ValidationError: TYPE is unknown"]),
    (TSP.replace("EUC_2D", "EUCLID"), ["ValidationError: EDGE_WEIGHT_TYPE is unknown"]),
    (TSP.replace("EDGE_WEIGHT_TYPE : EUC_2D\n", ""), ["ValidationError: EDGE_WEIGHT_TYPE is missing"]),
    (TSP.replace("NODE_COORD_SECTION", "NODE_COORD_TYPE : FLAT\nNODE_COORD_SECTION"), ["ValidationError: NODE_COORD_TYPE is unknown"]),
    (TSP.replace("NODE_COORD_SECTION", "DISPLAY_DATA_TYPE : FLAT\nNODE_COORD_SECTION"), ["ValidationError: DISPLAY_DATA_TYPE is unknown"]),
    (HCP.replace(": ADJ_LIST", ": LIST").replace("1 2 3 -1\n2 3 -1\n", "1 2\n2 3\n"), ["ValidationError: EDGE_DATA_FORMAT is unknown"]),
    (ATSP.replace("EDGE_WEIGHT_FORMAT : FULL_MATRIX\n", ""), ["ValidationError: EDGE_WEIGHT_SECTION doesn't fit its format", "ValidationError: EXPLICIT needs EDGE_WEIGHT_FORMAT"]),
    (ATSP.replace("FULL_MATRIX", "SQUARE"), ["ValidationError: EDGE_WEIGHT_FORMAT is unknown", "ValidationError: EDGE_WEIGHT_SECTION doesn't fit its format"]),
    (ATSP.replace("EDGE_WEIGHT_SECTION\n0 1\n2 0\n", ""), ["ValidationError: EXPLICIT needs EDGE_WEIGHT_SECTION"]),
    (ATSP.replace("2 0\n", "2\n"), ["ValidationError: EDGE_WEIGHT_SECTION doesn't fit its format"]),
    (ATSP.replace("2 0\n", "2 z\n"), ["ParseError: EDGE_WEIGHT_SECTION can't be read", "ValidationError: EDGE_WEIGHT_SECTION doesn't fit its format"]),
    (TSP.replace("NODE_COORD_SECTION", "NODE_COORD_TYPE : NO_COORDS\nNODE_COORD_SECTION"), ["ValidationError: NO_COORDS with coordinates"]),
    (TSP.replace("EOF", "DISPLAY_DATA_TYPE : NO_DISPLAY\nDISPLAY_DATA_SECTION\n1 0 0\n2 0 0\n3 0 0\nEOF"), ["ValidationError: NO_DISPLAY with display data"]),
    (TSP.replace("NODE_COORD_SECTION", "DISPLAY_DATA_TYPE : TWOD_DISPLAY\nNODE_COORD_SECTION"), ["ValidationError: TWOD_DISPLAY needs DISPLAY_DATA_SECTION"]),
    (TSP.replace("EOF", "DISPLAY_DATA_SECTION\n1 0 0\nEOF"), ["ValidationError: display data must have DIMENSION rows"]),
    (TSP.replace("3 0 8\n", ""), ["ValidationError: coordinates of nodes 1 to DIMENSION are needed"]),
    (TSP.replace("3 0 8", "4 0 8"), ["ValidationError: coordinates of nodes 1 to DIMENSION are needed"]),
    (TSP.replace("3 0 8", "3 0 8 1"), ["ValidationError: coordinates have mixed dimensions"]),
    (TSP.replace("NODE_COORD_SECTION", "NODE_COORD_TYPE : THREED_COORDS\nNODE_COORD_SECTION"), ["ValidationError: coordinates don't have NODE_COORD_TYPE's dimension"]),
    (TSP.replace("EUC_2D", "XRAY1"), ["ValidationError: coordinates don't have EDGE_WEIGHT_TYPE's dimension"]),
    (TSP.replace("3 0 8", "3 0 x"), ["ParseError: NODE_COORD_SECTION can't be read", "ValidationError: coordinates of nodes 1 to DIMENSION are needed"]),
    (TSP.replace("3 0 8", "3 0 1e999"), ["ParseError: NODE_COORD_SECTION can't be read", "ValidationError: coordinates of nodes 1 to DIMENSION are needed"]),
    (TSP.replace("EOF", "ODD_SECTION\n1\nEOF"), ["ParseError: unknown section ODD_SECTION"]),
    (HCP.replace("DIMENSION : 3", "DIMENSION : x"), ["ParseError: DIMENSION is no number", "ValidationError: DIMENSION must be a positive number"]),
    (CVRP.replace("3 5\n", ""), ["ValidationError: demands of nodes 1 to DIMENSION are needed"]),
    (CVRP.replace("3 5\n", "3 -5\n"), ["ValidationError: demands must not be negative"]),
    (CVRP.replace("CAPACITY : 10", "CAPACITY : 0"), ["ValidationError: CAPACITY must be positive"]),
    (CVRP.replace("DEMAND_SECTION\n1 0\n2 4\n3 5\n", ""), ["ValidationError: DEMAND_SECTION is missing"]),
    (CVRP.replace("DEPOT_SECTION\n1\n", "DEPOT_SECTION\n7\n"), ["ValidationError: depots are out of range"]),
    (CVRP.replace("DEPOT_SECTION\n1\n", "DEPOT_SECTION\n2\n"), ["ValidationError: depots must have no demand"]),
    (CVRP.replace("\n-1\n", "\n"), ["ParseError: DEPOT_SECTION can't be read"]),
    (HCP.replace("EDGE_DATA_SECTION\n1 2 3 -1\n2 3 -1\n-1\n", ""), ["ValidationError: EDGE_DATA_SECTION is missing"]),
    (HCP.replace("2 3 -1\n-1", "2 9 -1\n-1"), ["ValidationError: edges are out of range"]),
    (HCP.replace("EOF", "FIXED_EDGES_SECTION\n1 9\n-1\nEOF"), ["ValidationError: fixed edges are out of range"]),
    (TOUR.replace("TOUR_SECTION\n3 1 2 -1\n", ""), ["ValidationError: TOUR_SECTION is missing"]),
    (TOUR.replace("3 1 2", "3 1 1"), ["ValidationError: tours must visit each node once"]),
    (TIMES.replace("3 1 9\n", ""), ["ValidationError: TIME_WINDOW_SECTION needs nodes 1 to DIMENSION"]),
]
GOOD = (TSP, CVRP, ATSP, HCP, TOUR, TIMES, CVRP.replace("CAPACITY : 10\n", ""))


def per_nation(spark: SparkSession, sf_dir: str, texts: list[tuple[str, str]]) -> DataFrame:
    """(path, text, k): each text for each nation; @ stands for the nation's name, #k for its key."""
    rows = derived._read(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("k"), F.inline(F.array(*(F.struct(F.lit(p).alias("path"), F.lit(t).alias("text")) for p, t in texts))))
    fill = lambda c: F.replace(F.replace(F.col(c), F.lit("@"), F.col("n_name")), F.lit("#k"), F.col("k").cast("string"))
    return rows.select(fill("path").alias("path"), fill("text").alias("text"), "k")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _told() -> str:
    rows = [(i, *e.split(": ", 1)) for i, (_, errors) in enumerate(FAULTS) for e in errors]
    return ", ".join(f"({i}, {_quoted('parse' if kind == 'ParseError' else 'validate')}, {_quoted(kind)}, {_quoted(message)})" for i, kind, message in rows)


_FAULTS_SQL = f"SELECT '/' || i || '/' || n_name AS path, stage, error_type, error FROM nation, (VALUES {_told()}) f(i, stage, error_type, error)"


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [(f"/{i}/@", t) for i, (t, _) in enumerate(FAULTS)] + [(f"/good{i}/@", t) for i, t in enumerate(GOOD)]
    return validate.validate(instances.parse(per_nation(spark, sf_dir, texts).drop("k")))


@register("broken_instances", _FAULTS_SQL, prelude=False)
def broken_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every validation rule broken once, and the errors that follow; valid files give none."""
    return validate.split_valid(_broken(spark, sf_dir))[1]


@register("failure_counts", f"SELECT stage, error_type, count(*) AS errors, count(DISTINCT path) AS files FROM ({_FAULTS_SQL}) GROUP BY 1, 2", prelude=False)
def failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.failure_counts(validate.split_valid(_broken(spark, sf_dir))[1])


@register("broken_summary", f"SELECT CAST({len(FAULTS) + len(GOOD)} * count(*) AS BIGINT) AS total, CAST({len(GOOD)} * count(*) AS BIGINT) AS successful, CAST({len(FAULTS)} * count(*) AS BIGINT) AS failed, CAST({round(100 * len(GOOD) / (len(FAULTS) + len(GOOD)), 2)} AS DOUBLE) AS success_rate FROM nation", prelude=False)
def broken_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.summary(_broken(spark, sf_dir)).withColumn("success_rate", F.col("success_rate").cast("double"))


SIDE = 5


def _layout_text(layout: str) -> F.Column:
    lower = layout in ("LOWER_ROW", "UPPER_COL", "LOWER_DIAG_ROW", "UPPER_DIAG_COL")
    own = 0 if "DIAG" in layout else 1
    at = [(i, j) for i in range(SIDE) for j in range(SIDE) if layout == "FULL_MATRIX" or (i - j >= own if lower else j - i >= own)]
    cells = [F.lit("0") if i == j else ((F.lit(7 * min(i, j) + 3 * max(i, j)) + F.col("k")) % 50 + 1).cast("string") for i, j in at]
    head = f"NAME : {layout}\nTYPE : TSP\nDIMENSION : {SIDE}\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : {layout}\nEDGE_WEIGHT_SECTION\n"
    return F.concat(F.lit(head), F.concat_ws(" ", *cells), F.lit("\nEOF"))


@register(
    "layout_cells",
    f"""SELECT l AS layout, CAST(n_nationkey AS BIGINT) AS k, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(CASE WHEN i = j THEN 0 ELSE (7 * least(i, j) + 3 * greatest(i, j) + n_nationkey) % 50 + 1 END AS INTEGER) AS w, true AS is_symmetric
    FROM nation, (VALUES {", ".join(f"('{x}')" for x in MATRIX_FORMATS)}) m(l), range({SIDE}) a(i), range({SIDE}) b(j)""",
    prelude=False,
)
def layout_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One matrix in all nine layouts, read back cell by cell."""
    rows = derived._read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k")).select("k", F.explode(F.array(*map(_layout_text, MATRIX_FORMATS))).alias("text"))
    parsed = validate.validate(instances.parse(rows)).where("size(errors) = 0").select("problem_data.name", "k", "metadata.is_symmetric", F.posexplode("matrix").alias("i", "r"))
    return parsed.select(F.col("name").alias("layout"), "k", "i", F.posexplode("r").alias("j", "w"), "is_symmetric").select("layout", "k", "i", "j", "w", "is_symmetric")


@register(
    "distances_3d",
    """, d AS (SELECT a.problem_id, a.node_id, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy, abs((a.x * 3 + a.y * 7) % 1000 - (b.x * 3 + b.y * 7) % 1000) AS dz
        FROM nodes a JOIN nodes b ON a.problem_id = b.problem_id AND b.node_id = a.node_id + 1), t AS (SELECT *, least(dx, abs(dx - 360)) AS turn FROM d)
    SELECT problem_id, node_id, CAST(trunc(sqrt(dx * dx + dy * dy + dz * dz) + 0.5) AS INTEGER) AS euc_3d, CAST(trunc(dx + dy + dz + 0.5) AS INTEGER) AS man_3d,
        CAST(greatest(trunc(dx + 0.5), trunc(dy + 0.5), trunc(dz + 0.5)) AS INTEGER) AS max_3d, CAST(trunc(100.0::DOUBLE * greatest(turn, dy, dz) + 0.5) AS INTEGER) AS xray1,
        CAST(trunc(100.0::DOUBLE * greatest(turn / 1.25::DOUBLE, dy / 1.5::DOUBLE, dz / 1.15::DOUBLE) + 0.5) AS INTEGER) AS xray2 FROM t""",
)
def distances_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = lambda c: F.array(F.get(c, F.lit(0)), F.get(c, F.lit(1)), (F.get(c, F.lit(0)) * 3 + F.get(c, F.lit(1)) * 7) % 1000)
    rows = derived.nations(spark, sf_dir).select("problem_id", F.transform("coords", point).alias("coords"))
    rows = rows.select("problem_id", "coords", F.posexplode("coords").alias("node_id", "a")).withColumn("b", F.get("coords", F.col("node_id") + 1)).where("b is not null")
    return rows.select("problem_id", "node_id", *(distance.DISTANCES[n](F.col("a"), F.col("b")).alias(n.lower()) for n in ("EUC_3D", "MAN_3D", "MAX_3D", "XRAY1", "XRAY2")))


SOLUTIONS = [
    ("/tour/@.opt.tour", "NAME : @\nCOMMENT : Optimum (#k)\nTYPE : TOUR\nDIMENSION : 3\nTOUR_SECTION\n3 1\n2 -1\nEOF\n"),
    ("/sol/@.sol", "Route #1: 2 1\nRoute #2: 3\n 4\nCost #k.5\nCost 9\nnotes 5 6\n"),
    ("/sol/lone-@.sol", "Route #1: 1\nCost 1\n"),
    ("/bad/@.sol", "Route #2: 2 x\nRoute #1: 2\n"),
    ("/bad/@.tour", "TOUR_SECTION\n1 1 -1\n"),
]


@register(
    "solution_files",
    """, s(folder, dot, kind, quality, routes, errors) AS (VALUES ('/tour/', '.opt.tour', 'OPT_TOUR', 'proven_optimal', '[[2,0,1]]', 0), ('/sol/', '.sol', 'SOL', 'best_known', '[[2,1],[3,4]]', 0),
        ('/sol/lone-', '.sol', 'SOL', 'best_known', '[[1]]', 0), ('/bad/', '.sol', 'SOL', 'best_known', '[[2],[2]]', 3), ('/bad/', '.tour', 'OPT_TOUR', 'proven_optimal', '[[0,0]]', 1))
    SELECT folder || name || dot AS path, kind, quality, CASE WHEN folder = '/bad/' THEN NULL WHEN kind = 'OPT_TOUR' THEN CAST(id - 1 AS DOUBLE) WHEN folder = '/sol/' THEN id - 0.5::DOUBLE ELSE 1.0 END AS cost, routes, CAST(errors AS INTEGER) AS errors,
        CASE WHEN folder = '/sol/lone-' THEN 'unlinked' ELSE 'linked' END AS status, CASE WHEN folder <> '/sol/lone-' THEN CAST(id AS INTEGER) END AS problem_id, CASE WHEN folder = '/sol/lone-' THEN 'no_instance' END AS reason FROM p, s""",
)
def solution_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tours and routes of both grammars, valid and not, linked to problems by their stems."""
    parsed = solutions.parse_solutions(per_nation(spark, sf_dir, SOLUTIONS).drop("k"))
    linked = solutions.link(parsed, derived.catalog(spark, sf_dir)["problems"])
    return linked.select("path", "kind", "quality", "cost", F.to_json("routes").alias("routes"), F.size("errors").alias("errors"), "link.status", F.col("link.problem_id").cast("int").alias("problem_id"), "link.reason")


CORDEAU = "6 1 2 2\n100 #k\n90 7\n1 #k 2 5 3 1 1 1 0 10\n2 5 6 5 4 1 1 1 2 20\n3 0 0 0 0 0 0 0 99\n4 9 9 0 0 0 0 0 50\n"
BAD_CORDEAU = [("6 1 2 2 2\n", "the header needs four integers"), ("9 1 1 1\n5 5\n1 0 0 0 1 1 1 1\n2 0 0 0 0 0 0\n", "unknown type"), ("0 1 0 1\n", "vehicles, customers and depots must be positive"), ("0 1 1 1\n5\n1 0 0 0 1 1 1 1\n2 0 0 0 0 0 0\n", "depot constraint 1 needs a duration and a load"), ("0 1 1 1\n5 5\n1 0 0 0 3000000000 1 1 1\n2 0 0 0 0 0 0\n", "node line 1 can't be read"), ("0 1 1 1\n5 5\n1 0 0 0 3\n2 1e999 0 0 0 0 0\n", "node line 1 can't be read")]


@register(
    "cordeau_nodes",
    """SELECT n_name AS name, CAST(i AS INTEGER) AS node, CASE i WHEN 0 THEN CAST(n_nationkey AS DOUBLE) WHEN 1 THEN 5.0 WHEN 2 THEN 0.0 ELSE 9.0 END AS x, CAST([3, 4, 0, 0][i + 1] AS INTEGER) AS demand, i >= 2 AS is_depot,
        CAST([10, 20, 99, 50][i + 1] AS DOUBLE) AS latest, 'MDVRPTW' AS type, CAST(CASE WHEN n_nationkey = 7 THEN 7 END AS INTEGER) AS capacity FROM nation, range(4) r(i)""",
    prelude=False,
)
def cordeau_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-depot files read as instances: customers first, depots last, with windows and loads that differ."""
    files = per_nation(spark, sf_dir, [("@", CORDEAU)])
    rows = cordeau.parse_as_instances(files, "multi").where("size(errors) = 0")
    rows = rows.select(F.col("path").alias("name"), F.posexplode("coords").alias("node", "c"), "demands", "depots", "problem_data")
    at = lambda c: F.get(c, F.col("node"))
    return rows.select("name", "node", F.get("c", F.lit(0)).alias("x"), at("demands").alias("demand"), F.array_contains("depots", F.col("node")).alias("is_depot"), F.get(at("problem_data.time_windows"), F.lit(1)).alias("latest"), "problem_data.type", "problem_data.capacity")


@register("cordeau_errors", f"SELECT n_name || i AS path, e AS error FROM nation, (VALUES {', '.join(f'({i}, {_quoted(e)})' for i, (_, e) in enumerate(BAD_CORDEAU))}, (5, 'node line 2 can''t be read')) f(i, e)", prelude=False)
def cordeau_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = per_nation(spark, sf_dir, [(f"@{i}", t) for i, (t, _) in enumerate(BAD_CORDEAU)]).drop("k")
    return cordeau.parse(files).select("path", F.explode("errors").alias("error"))


@register("extended_windows", "SELECT n_name AS name, CAST(i AS INTEGER) AS node, [0.0, 2.0, 1.0][i + 1]::DOUBLE AS earliest, [10.0, 5.5, 9.0][i + 1]::DOUBLE AS latest FROM nation, range(3) r(i)", prelude=False)
def extended_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.validate(instances.parse(per_nation(spark, sf_dir, [("@", TIMES)]))).where("size(errors) = 0")
    return rows.select("problem_data.name", F.posexplode("problem_data.time_windows").alias("node", "w")).select("name", "node", F.get("w", F.lit(0)).alias("earliest"), F.get("w", F.lit(1)).alias("latest"))


@register("json_documents", "SELECT 'tsp' AS type_dir, n_name || '.tsp.json' AS file_name, n_name AS name, '3' AS dimension, '[[0.0,0.0],[3.0,4.0],[0.0,8.0]]' AS coords FROM nation", prelude=False)
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sinks.json_documents(instances.parse(per_nation(spark, sf_dir, [("@", TSP)])))
    field = lambda p: F.get_json_object("value", p)
    return docs.select("type_dir", "file_name", field("$.problem.name").alias("name"), field("$.problem.dimension").alias("dimension"), field("$.coords").alias("coords"))


@register(
    "second_upsert",
    """SELECT CAST(CASE WHEN n_nationkey % 2 = 0 THEN row_number() OVER (PARTITION BY n_nationkey % 2 ORDER BY n_name) ELSE (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 0) + row_number() OVER (PARTITION BY n_nationkey % 2 ORDER BY n_name) END AS INTEGER) AS id,
        n_name AS name, 'TSP' AS type, CAST(3 AS INTEGER) AS dimension, '/' || n_name || '.tsp' AS source_file FROM nation""",
    prelude=False,
)
def second_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other file is stored first, then all: stored problems keep their ids, and files their tracking rows."""
    files = per_nation(spark, sf_dir, [("/@.tsp", TSP)])
    checked = validate.validate(instances.parse(files)).withColumn("checksum", F.lit("c")).withColumn("file_size", F.lit(1).cast("long")).persist()
    once, _ = cat.ingest(cat.Catalog(spark), checked.where("k % 2 = 0"))
    once = cat.Catalog(spark, {n: t.persist() for n, t in once.tables.items()})
    both, _ = cat.ingest(once, checked)
    return queries.problem_metadata(both).select("id", "name", "type", "dimension", "source_file")


@register("doubles_refused", "SELECT '/b/' || n_name || '.tsp' AS path, 'store' AS stage, 'DatabaseError' AS error_type, 'another file has the name and type ' || n_name || ' TSP' AS error FROM nation UNION ALL SELECT '/c/' || n_name || '.tsp', 'store', 'DatabaseError', 'TOUR can''t be stored' FROM nation UNION ALL SELECT '/d/' || n_name || '.tsp', 'store', 'DatabaseError', 'EDGE_WEIGHT_TYPE is missing' FROM nation", prelude=False)
def doubles_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid files that can't be stored are reported, none vanishes."""
    weightless = "NAME : @x\nTYPE : OP\nDIMENSION : 1\nNODE_COORD_SECTION\n1 0 0\nEOF"
    files = per_nation(spark, sf_dir, [("/a/@.tsp", TSP), ("/b/@.tsp", TSP), ("/c/@.tsp", TOUR), ("/d/@.tsp", weightless)]).drop("k")
    return cat.refused(validate.split_valid(validate.validate(instances.parse(files)))[0])


@register("views_sql", "SELECT type, count(*) AS problems, CAST(sum(nodes) AS BIGINT) AS nodes FROM (SELECT v.id, v.type, count(n.node_id) AS nodes FROM v LEFT JOIN n ON v.id = n.problem_id GROUP BY 1, 2) GROUP BY 1")
def views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's views, asked in SQL."""
    derived.catalog(spark, sf_dir).views("routing_")
    return spark.sql("SELECT type, count(*) AS problems, sum(nodes) AS nodes FROM (SELECT v.id, v.type, count(n.node_id) AS nodes FROM routing_problems_v v LEFT JOIN routing_nodes n ON v.id = n.problem_id GROUP BY 1, 2) GROUP BY 1")


@register(
    "short_routes",
    "SELECT CAST(n_nationkey AS BIGINT) AS k, 0.0::DOUBLE AS empty, 0.0::DOUBLE AS lone, 10.0::DOUBLE AS closed, 10.0::DOUBLE AS open_ends, CAST(NULL AS DOUBLE) AS no_matrix FROM nation",
    prelude=False,
)
def short_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes below two nodes cost nothing, closed ones aren't closed again, explicit weights without a matrix have no cost."""
    rows = derived._read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))).alias("coords"))
    cost = lambda *route, kind="euc_2d": distance.routes_cost(F.array(F.array(*map(F.lit, route)).cast("array<int>")), F.col("coords"), None, kind)
    return rows.select("k", cost().alias("empty"), cost(1).alias("lone"), cost(0, 1, 0).alias("closed"), cost(0, 1).alias("open_ends"), cost(0, 1, kind="EXPLICIT").alias("no_matrix"))


__all__ = ["QUERIES"]
