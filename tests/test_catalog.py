import pytest
from pyspark.sql import functions as F
from test_instances import CVRP, HCP, MATRIX, TOUR, TSP

from wayframe import cli
from wayframe.operators import audit, incremental, queries, sinks
from wayframe.operators import catalog as cat
from wayframe.operators.validate import validate
from wayframe.schemas import DatabaseError, NotFoundError, canonical_type, storage_type
from wayframe.sources import cordeau, files, instances, solutions
from wayframe.streaming.ingest import ingest_stream

FILES = {"a5.tsp": TSP, "m.atsp": MATRIX, "v.vrp": CVRP, "h.hcp": HCP, "t.tour": TOUR, "twin.tsp": TSP.replace("4 6.5", "4 7"), "bad.tsp": "NAME : bad\nTYPE : TSP\n"}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus") / "problems"
    root.mkdir()
    for name, text in FILES.items():
        (root / name).write_text(text)
    return root


@pytest.fixture(scope="module")
def stored(spark, corpus, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("store"))
    counts = cli.process(spark, str(corpus), store)
    assert (counts["new"], counts["processed"], counts["failed"], counts["successful"]) == (7, 7, 2, 5)
    return store, cat.load(spark, store)


def test_types():
    assert canonical_type("VRP") == "CVRP" and canonical_type("tsp (M.~H)") == "TSP" and canonical_type(" odd thing ") == "odd thing" and canonical_type("") is None
    assert storage_type("MDVRPTW") == "CVRP" and storage_type("OP") == "TSP" and storage_type("HPP") == "HCP"
    with pytest.raises(DatabaseError):
        storage_type("TOUR")


def test_reads(spark, stored):
    _, c = stored
    assert sorted((r.name, r.type) for r in c["problems"].collect()) == [("a5", "TSP"), ("h", "HCP"), ("m", "ATSP"), ("twin", "TSP"), ("v", "CVRP")]
    assert queries.load_problem(c, "twin", "TSP")["tsplib_name"] == "a5"
    assert queries.load_problem(c, "v", "VRP")["demands"] == [0, 4, 5]
    assert queries.load_matrix(c, "m", "ATSP") == [[0, 1, 2], [3, 0, 4], [5, 6, 0]] and queries.load_matrix(c, "a5", "TSP") is None
    with pytest.raises(NotFoundError):
        queries.load_problem(c, "none", "TSP")
    ids = {r.name: r.id for r in c["problems"].collect()}
    assert queries.load_matrix_metadata(c, ids["m"]) == {"matrix_format": "FULL_MATRIX", "is_symmetric": False, "size": 3}
    assert queries.load_problem_metadata(c, ids["a5"])["source_file"].endswith("a5.tsp")
    assert [r.asDict() for r in queries.problem_stats(c).where("type = 'TSP'").collect()] == [{"type": "TSP", "count": 2, "avg_dimension": 4.0, "max_dimension": 4}]
    assert audit.integrity_failures(c).count() == 0
    assert cat.nodes_view(c).where("is_depot").count() == 1


def test_second_run_keeps_ids_and_skips(spark, stored, corpus, tmp_path):
    store, c = stored
    before = {r.name: r.id for r in c["problems"].collect()}
    # files that failed aren't tracked, so they are new again
    assert cli.process(spark, str(corpus), store)["processed"] == 2
    cli.process(spark, str(corpus), store, force=True)
    after = cat.load(spark, store)
    assert {r.name: r.id for r in after["problems"].collect()} == before
    assert after["file_tracking"].count() == 5
    assert cli.main(["validate", store]) == 0


def test_exports(spark, stored, tmp_path):
    _, c = stored
    out = sinks.export_parquet(c, str(tmp_path), ["problems", "tsp_problems"], "zstd", files=1)
    info = sinks.parquet_info(spark, out["problems"])
    assert (info["rows"], info["compression"]) == (5, "zstd")
    with pytest.raises(ValueError, match="unknown"):
        sinks.export_parquet(c, str(tmp_path), ["passwords"])
    parsed = instances.parse(spark.createDataFrame([("x", TSP)], "path string, text string"))
    assert [r.status for r in sinks.write_json_files(parsed, f"file://{tmp_path}/json").collect()] == ["written"]
    assert [r.status for r in sinks.write_json_files(parsed, f"file://{tmp_path}/json").collect()] == ["unchanged"]
    assert (tmp_path / "json" / "tsp" / "a5.tsp.json").exists()
    assert sinks.backup(c, c["problems"].first().id, str(tmp_path / "b"))


def test_changes(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("e", None)], "path string, checksum string")
    old = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4"), ("e", "5")], "file_path string, checksum string")
    changes = incremental.detect_changes(now, old)
    assert {r.path: r.status for r in changes.collect()} == {"a": "unchanged", "b": "modified", "c": "new", "d": "missing", "e": "unknown"}
    assert incremental.to_process(changes).count() == 3 and incremental.to_process(changes, True).count() == 4


def test_stream(spark, corpus, tmp_path):
    ingest_stream(spark, str(corpus), f"{tmp_path}/store", f"{tmp_path}/ck").awaitTermination()
    assert cat.load(spark, f"{tmp_path}/store")["problems"].count() == 5


SOL = "Route #1: 1 3\n 4\nRoute #2: 2\nCost 12.5e1\n"


def test_solutions(spark, stored):
    _, c = stored
    rows = [
        ("/x/v.sol", SOL.replace(" 4\n", "\n"), "1"),
        ("/x/a5.opt.tour", "COMMENT : best (Length 629)\nDIMENSION : 3\nTOUR_SECTION\n1 3\n2\n-1\nEOF", "2"),
        ("/x/none.sol", SOL, "3"),
        ("/x/h.sol", "Route #2: 1\nRoute #1: 1 x\n", "4"),
        ("/x/z.txt", "", "5"),
        ("/x/q.tour", None, "6"),
    ]
    df = spark.createDataFrame(rows, "path string, text string, checksum string")
    linked = solutions.link(solutions.parse_solutions(df), c["problems"])
    got = {r.path: r for r in linked.collect()}
    assert got["/x/v.sol"].routes == [[1, 3], [2]] and got["/x/v.sol"].cost == 125.0 and got["/x/v.sol"].link.status == "linked" and not got["/x/v.sol"].errors
    assert got["/x/a5.opt.tour"].routes == [[0, 2, 1]] and got["/x/a5.opt.tour"].cost == 629.0
    assert got["/x/none.sol"].link.reason == "no_instance" and got["/x/none.sol"].routes == [[1, 3, 4], [2]]
    assert len(got["/x/h.sol"].errors) >= 3 - 1 and got["/x/z.txt"].errors and got["/x/q.tour"].errors
    after = solutions.store(c, linked)
    assert after["solutions"].count() == 3
    assert {r.name for r in after["problems"].where("has_solution").collect()} == {"a5", "v"}
    solved = next(r.id for r in after["problems"].collect() if r.name == "v")
    assert queries.load_solution(after, solved)["kind"] == "SOL"


def test_solution_discovery(spark, tmp_path):
    for p in ("tsp/a.tsp", "tsp/a.sol", "tour/a.opt.tour", "vrp/b.vrp", "tour/b.opt.tour", "vrp/b.sol"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("x")  # Spark skips empty files
    found = files.candidate_solutions(files.scan_files(spark, str(tmp_path), patterns=("*",)))
    short = sorted(r.solution_path.split("/")[-2] + "/" + r.solution_path.split("/")[-1] for r in found.collect())
    assert short == ["tour/a.opt.tour", "tsp/a.sol", "vrp/b.sol"]


def test_cordeau(spark):
    text = "2 3 2 2\n0 80\n0 80\n1 37 52 0 7 1 2 1 2\n2 49 49 10 30 1 2 1 2\n3 20 20 0 0 0 0\n4 30.5 40 0 0 0 0\n"
    two = text.replace("0 80\n0 80", "100 80\n120 60")
    r = {x.path: x for x in cordeau.parse_as_instances(spark.createDataFrame([("a", text), ("b", two), ("c", "1 2"), ("d", text + "9")], "path string, text string"), "p01").collect()}
    assert not r["a"].errors and r["a"].problem_data.capacity == 80 and r["a"].depots == [2, 3] and r["a"].demands == [7, 30, 0, 0] and r["a"].coords[3] == [30.5, 40.0]
    assert r["b"].problem_data.capacity is None and r["b"].problem_data.depot_capacities == [80, 60]
    assert r["c"].errors and r["d"].errors
    assert cordeau.parse(spark.createDataFrame([("a", text)], "path string, text string")).first().nodes[0].visits == [1, 2]


def test_config(tmp_path):
    path = str(tmp_path / "c.yaml")
    assert cli.main(["init", path]) == 0 and cli.load_config(path) == cli.Config()


def test_zero_rows(spark):
    c = cat.Catalog(spark)
    assert queries.problem_stats(c).count() == 0 and audit.integrity_failures(c).count() == 0
    empty = validate(instances.parse(spark.createDataFrame([], "path string, text string, checksum string, file_size long")))
    after, failed = cat.ingest(c, empty)
    assert after["problems"].count() == 0 and failed.select(F.count("*")).first()[0] == 0
