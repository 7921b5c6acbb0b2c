import pytest
from pyspark.sql import functions as F

from wayframe.functions import distance, matrix
from wayframe.operators import validate
from wayframe.sources import files, instances

TSP = "NAME: a5\nTYPE : TSP (someone)\nCOMMENT : five: nodes\nDIMENSION:4\nEDGE_WEIGHT_TYPE : EUC_2D\n# remark\nNODE_COORD_SECTION\n1 0 0\n\n2\t3 4\n 4 6.5 8e1\n3 1 1\nEOF\n"
MATRIX = "NAME : m\nTYPE : ATSP\nDIMENSION : 3\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : FULL_MATRIX\nEDGE_WEIGHT_SECTION\n0 1 2\n3 0 4 5\n6 0\nEOF"
CVRP = "NAME : v\nTYPE : VRP\nDIMENSION : 3\nCAPACITY : 10\nEDGE_WEIGHT_TYPE : EUC_2D\nNODE_COORD_SECTION\n1 0 0\n2 1 1\n3 2 2\nDEMAND_SECTION\n1 0\n2 4\n3 5\nDEPOT_SECTION\n1\n-1\nEOF"
HCP = "NAME : h\nTYPE : HCP\nDIMENSION : 4\nEDGE_DATA_FORMAT : ADJ_LIST\nEDGE_DATA_SECTION\n1: 2 3 -1\n2 4 -1\n-1\nFIXED_EDGES : 1 2 3 4 -1\nEOF"
TOUR = "NAME : t\nTYPE : TOUR\nDIMENSION : 3\nTOUR_SECTION\n1 3\n2\n-1\nEOF"
TIMES = "NAME : w\nTYPE : CVRPTW\nDIMENSION : 2\nCAPACITY : 5\nVEHICLES : 2\nEDGE_WEIGHT_TYPE : EUC_2D\nNODE_COORD_SECTION\n1 0 0\n2 1 1\nDEMAND_SECTION\n1 0\n2 1\nDEPOT_SECTION\n1\n-1\nTIME_WINDOW_SECTION\n1 0 10\n2 2 5.5\nEOF"


def parsed(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    return {int(r.path): r for r in validate.validate(instances.parse(df)).collect()}


def test_valid_documents(spark):
    r = parsed(spark, TSP, MATRIX, CVRP, HCP, TOUR, TIMES, TSP.replace("\n", "\r\n"))
    assert [list(x.errors) for x in r.values()] == [[]] * 7
    assert r[0].problem_data.type == "TSP" and r[0].problem_data.comment == "five: nodes" and r[0].problem_data.dimension == 4
    assert r[0].coords == [[0.0, 0.0], [3.0, 4.0], [1.0, 1.0], [6.5, 80.0]] and r[0].metadata.weight_source == "coordinate_based"
    assert r[1].matrix == [[0, 1, 2], [3, 0, 4], [5, 6, 0]] and r[1].metadata.is_symmetric is False
    assert (r[2].problem_data.type, r[2].demands, r[2].depots) == ("CVRP", [0, 4, 5], [0])
    assert r[3].edges == [[0, 1], [0, 2], [1, 3]] and r[3].fixed_edges == [[0, 1], [2, 3]] and r[3].metadata.is_symmetric is None
    assert r[4].tours[0].nodes == [0, 2, 1]
    assert r[5].problem_data.time_windows == [[0.0, 10.0], [2.0, 5.5]] and r[5].problem_data.vehicles == 2
    assert r[6].coords == r[0].coords
    assert parsed(spark, CVRP.replace("CAPACITY : 10\n", ""))[0].errors == []


POISONED = [
    (TSP.replace("1 1\nEOF", "1 x\nEOF"), "ParseError: NODE_COORD"),
    (TSP.replace("3 1 1", "2 1 1"), "ParseError: NODE_COORD"),
    (TSP.replace("DIMENSION:4\n", ""), "DIMENSION must"),
    (TSP.replace("DIMENSION:4", "DIMENSION: four"), "ParseError: DIMENSION"),
    (TSP.replace("3 1 1\n", ""), "coordinates of nodes"),
    (TSP.replace("EOF", "ODD_SECTION\n1\nEOF"), "unknown section"),
    (TSP.replace("EUC_2D", "EUC_3D"), "EDGE_WEIGHT_TYPE's dimension"),
    (TSP.replace("NAME: a5\n", ""), "NAME"),
    (TSP.replace("TSP (", "NONSENSE ("), "TYPE is unknown"),
    (MATRIX.replace("6 0\nEOF", "6\nEOF"), "doesn't fit"),
    (MATRIX.replace("3 0 4", "3 z 4"), "ParseError: EDGE_WEIGHT"),
    (MATRIX[: MATRIX.index("EDGE_WEIGHT_SECTION")], "needs EDGE_WEIGHT_SECTION"),
    (CVRP.replace("2 4\n", "2 4.5\n"), "ParseError: DEMAND"),
    (CVRP.replace("1 0\n2 4", "1 3\n2 4"), "no demand"),
    (CVRP.replace("\n-1\n", "\n"), "ParseError: DEPOT"),
    (HCP.replace("2 4 -1", "2 9 -1"), "edges are out"),
    (TOUR.replace("1 3\n2", "1 3\n3"), "each node once"),
    ("", "NAME"),
]


def test_poisoned_documents(spark):
    found = parsed(spark, *(t for t, _ in POISONED))
    for i, (_, message) in enumerate(POISONED):
        assert any(message in e for e in found[i].errors), (message, found[i].errors)


def test_faults_name_their_items(spark):
    texts = [TSP.replace("3 1 1\nEOF", "3 1 x\nEOF"), TSP.replace("3 1 1", "2 1 1"), CVRP.replace("2 1 1", "2 1 1 1 1"), MATRIX.replace("3 0 4", "3 z 4"), CVRP.replace("\n-1\n", "\n"), TSP]
    found = {i: [tuple(f) for f in r.faults] for i, r in parsed(spark, *texts).items()}
    n, w, d = "NODE_COORD_SECTION", "EDGE_WEIGHT_SECTION", "DEPOT_SECTION"
    assert found == {0: [(n, 4, "no number")], 1: [(n, 4, "node 2 again")], 2: [(n, 2, "wrong number of values")], 3: [(w, 5, "no number")], 4: [(d, 2, "no -1 at the end")], 5: []}


def test_dialect(spark):
    dialect = instances.Dialect(
        types=frozenset({"DRONE"}),
        sections={"RANGE_SECTION": ("array<double>", lambda lines: [float(x.split()[1]) for x in lines])},
        headers={"BATTERY": ("int", int)},
    )
    mine = TIMES.replace("CVRPTW", "Drone (mine)").replace("EOF", "RANGE_SECTION\n1 2.5\n2 7\nEOF").replace("VEHICLES : 2", "BATTERY : 9")
    texts = [mine, mine.replace("2.5", "far"), mine.replace(": 9", ": 3000000000"), TSP]
    files_ = spark.createDataFrame(list(enumerate(texts)), "path int, text string")
    rows = {r.path: r for r in validate.validate(instances.parse(files_, dialect=dialect), dialect.types).collect()}
    assert rows[0].errors == [] and rows[0].problem_data.type == "DRONE" and rows[0].problem_data.time_windows == [[0.0, 10.0], [2.0, 5.5]]
    assert (rows[0].range_section, rows[0].battery) == ([2.5, 7.0], 9)
    assert [e.split(":")[0] for e in rows[1].errors] == ["ParseError"] and "RANGE_SECTION" in rows[1].errors[0] and rows[1].range_section is None
    assert "BATTERY" in rows[2].errors[0] and rows[2].battery is None
    assert (rows[3].errors, rows[3].range_section, rows[3].battery) == ([], None, None)
    plain = validate.validate(instances.parse(files_)).where("path = 0").first().errors
    assert any("unknown section RANGE" in e for e in plain) and any("TYPE is unknown" in e for e in plain)
    for bad in ({"sections": {"TOUR_SECTION": ("int", len)}}, {"headers": {"CAPACITY": ("int", int)}}, {"sections": {"RANGE": ("int", len)}}, {"headers": {"MATRIX": ("int", int)}}):
        with pytest.raises(ValueError):
            instances.Dialect(**bad)
    with pytest.raises(ValueError, match="path"):
        instances.parse(files_, dialect=instances.Dialect(headers={"PATH": ("string", str)}))


def test_null_text_and_split(spark):
    df = spark.createDataFrame([("a", None), ("b", TSP)], "path string, text string")
    good, bad = validate.split_valid(validate.validate(instances.parse(df)))
    assert [r.path for r in good.collect()] == ["b"] and {r.path for r in bad.collect()} == {"a"}


def test_latin1_and_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.tsp").write_bytes("NAME : é".encode("latin-1"))
    (tmp_path / "b.vrp").write_text("NAME : é")
    (tmp_path / "c.txt").write_text("no")
    found = files.scan_files(spark, str(tmp_path))
    assert sorted(r.text for r in files.texts(found).collect()) == ["NAME : é"] * 2
    assert sorted((r.name, r.problem_type) for r in files.file_info(found).collect()) == [("a.tsp", "TSP"), ("b.vrp", "VRP")]
    assert files.scan_files(spark, str(tmp_path / "none")).count() == 0
    assert files.file_count(spark, str(tmp_path)) == 2


def test_distances(spark):
    pairs = [([0.0, 0.0, 0.0], [3.0, 4.0, 0.0]), ([10.0, 2.0, 1.0], [350.0, 2.0, 1.0]), ([-1.2, 0.0, 2.0], [5.5, 7.25, 9.0])]
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    rows = df.select(*(f(F.col("a"), F.col("b")).alias(n) for n, f in distance.DISTANCES.items())).collect()
    assert (rows[0].EUC_2D, rows[0].MAN_2D, rows[0].MAX_2D, rows[0].CEIL_2D, rows[0].ATT) == (5, 7, 4, 5, 2)
    assert (rows[1].XRAY1, rows[1].XRAY2) == (2000, 1600)
    one = df.limit(1).select(distance.nint_trunc(F.lit(-1.2)).alias("t"), distance.nint_floor(F.lit(-1.2)).alias("f"), distance.geo()(F.array(F.lit(38.24), F.lit(20.42)), F.array(F.lit(39.57), F.lit(26.15))).alias("g")).first()
    assert (one.t, one.f, one.g) == (0, -1, 509)


def test_matrix_layouts(spark):
    n = 4
    full = [[10 * min(i, j) + max(i, j) if i != j else 0 for j in range(n)] for i in range(n)]
    ranges = {
        "FULL_MATRIX": [(i, j) for i in range(n) for j in range(n)],
        "UPPER_ROW": [(i, j) for i in range(n) for j in range(i + 1, n)],
        "LOWER_ROW": [(i, j) for i in range(n) for j in range(i)],
        "UPPER_DIAG_ROW": [(i, j) for i in range(n) for j in range(i, n)],
        "LOWER_DIAG_ROW": [(i, j) for i in range(n) for j in range(i + 1)],
        "UPPER_COL": [(i, j) for j in range(n) for i in range(j)],
        "LOWER_COL": [(i, j) for j in range(n) for i in range(j + 1, n)],
        "UPPER_DIAG_COL": [(i, j) for j in range(n) for i in range(j + 1)],
        "LOWER_DIAG_COL": [(i, j) for j in range(n) for i in range(j, n)],
    }
    rows = [(k, [float(full[i][j]) for i, j in v]) for k, v in ranges.items()]
    rows += [(k, [4.0, *v]) for k, v in rows[:1]] + [("LOWER_DIAG_ROW", rows[2][1]), ("UPPER_ROW", [1.0])]
    got = [r.m for r in spark.createDataFrame(rows, "f string, v array<double>").coalesce(1).select(matrix.densify(F.col("v"), F.col("f"), F.lit(n)).alias("m")).collect()]
    assert got[:-1] == [full] * 11 and got[-1] is None


def test_route_costs(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [3.0, 4.0], [3.0, 0.0]], [[0, 1, 2], [1]], [[0, 7, 1], [2, 0, 3], [4, 5, 0]])], "c array<array<double>>, r array<array<int>>, m array<array<int>>")
    c, r, m = F.col("c"), F.col("r"), F.col("m")
    row = df.select(
        distance.routes_cost(r, c, None, "EUC_2D").alias("plain"),
        distance.routes_cost(r, c, None, "EUC_2D", depot=0).alias("depot"),
        distance.routes_cost(r, c, m, "EUC_2D").alias("matrix"),
        distance.routes_cost(r, c, None, "SPECIAL", special=lambda a, b: F.lit(1)).alias("special"),
        distance.routes_cost(r, None, None, None).alias("none"),
    ).first()
    assert (row.plain, row.depot, row.matrix, row.special, row.none) == (12.0, 22.0, 14.0, 3.0, None)
    with pytest.raises(Exception, match="SPECIAL"):
        distance.distance_for("SPECIAL")
