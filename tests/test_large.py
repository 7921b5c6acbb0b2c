"""Plans and results of what must hold for large matrices: none in one value, none broadcast."""

import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_instances import MATRIX, TSP

from wayframe.functions import distance
from wayframe.operators import audit, queries, validate
from wayframe.operators import catalog as cat
from wayframe.plans import derived, registry
from wayframe.schemas import MATRIX_FORMATS
from wayframe.sources import instances

SF = "/root/testdata/sf0.001"
TABLES = pytest.mark.skipif(not Path(SF).exists(), reason="the test tables aren't here")
LOWER = "NAME : l\nTYPE : TSP\nDIMENSION : 3\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : LOWER_DIAG_ROW\nEDGE_WEIGHT_SECTION\n0\n1 0\n2.6 x 3 0\nEOF"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def corpus(spark):
    texts = [MATRIX, TSP, LOWER, LOWER.replace("x ", ""), MATRIX.replace("6 0", "6"), MATRIX.replace("5", "5000000000"), MATRIX.replace("5", "1e999")]
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")


def test_matrix_rows(spark):
    rows = sorted(instances.matrix_rows(corpus(spark)).collect())
    whole = sorted((r.path, r.problem_data.name, i, row) for r in instances.parse(corpus(spark)).collect() for i, row in enumerate(r.matrix or ()))
    assert [tuple(r) for r in rows] == whole and len(rows) == 9


@TABLES
@pytest.mark.parametrize("name", ["text_round_trip_matrix", "text_summary", "text_round_trip_edges", "text_round_trip_nodes"])
def test_no_matrix_is_joined(spark, name):
    """A matrix beside a file was broadcast, as its size was estimated by that of the nations."""
    assert plan(registry.QUERIES[name](spark, SF)).count("Join") == 1


@TABLES
def test_matrix_leaves_the_decoder_by_rows(spark):
    assert "matrix#" not in plan(registry.QUERIES["text_round_trip_matrix"](spark, SF))


def test_texts_are_decoded_in_groups(spark, monkeypatch):
    """However many rows a batch has, those of one group of texts are held decoded."""
    monkeypatch.setattr(instances, "GROUP_BYTES", 1)
    rows = {r.path: list(r.errors) for r in instances.parse(corpus(spark).unionByName(spark.createDataFrame([("n", None), ("e", "")], "path string, text string")).coalesce(1)).collect()}
    assert len(rows) == 9 and rows["0"] == [] and rows["5"][0].startswith("ParseError")


def test_checked_without_matrices(spark):
    """Matrices that nobody reads don't leave the decoder; errors, faults and metadata are the same."""
    both = [{r.path: r for r in validate.validate(instances.parse(corpus(spark), matrices=m)).collect()} for m in (True, False)]
    assert [[(list(r.errors), list(r.faults), r.metadata) for _, r in sorted(x.items())] for x in both][0] == [(list(r.errors), list(r.faults), r.metadata) for _, r in sorted(both[1].items())]
    assert not any(r.matrix for r in both[1].values()) and both[1]["2"].edge_weights["count"] == 6


@TABLES
def test_a_tour_asks_for_its_cells(spark):
    """The matrices were joined with the tours, and broadcast."""
    assert "AS matrix#" not in plan(registry.QUERIES["tour_costs"](spark, SF))
    rows = spark.createDataFrame([([[0, 2, 1], [1, 0]], [[0, 1, 2], [3, 0, 4], [5, 6, 0]], None), ([[0, 1]], None, [[0.0, 0.0], [3.0, 4.0]])], "r array<array<int>>, matrix array<array<int>>, coords array<array<double>>")
    r, m, xy = F.col("r"), F.col("matrix"), F.col("coords")
    costs = [distance.routes_cost(r, xy, how, F.lit("EUC_2D")) for how in (m, lambda i, j: F.get(F.get(m, i), j))]
    assert [tuple(x) for x in rows.select(*costs).collect()] == [(15.0, 15.0), (10.0, 10.0)]


@TABLES
def test_stored_without_moving_matrices(spark):
    """Kept rows have no matrices; the stored table has them all the same."""
    c = registry.stored_texts(spark, SF)
    assert {r.matrix_format for r in c["edge_weight_matrices"].collect()} == {"FULL_MATRIX"}
    names = {r.id: r.name for r in c["problems"].collect()}
    stored = {names[r.problem_id]: r.matrix for r in c["edge_weight_matrices"].collect()}
    base = derived.catalog(spark, SF)
    known = base["edge_weight_matrices"].join(base["problems"], F.col("problem_id") == F.col("id")).select("name", "matrix")
    assert stored == {r.name: r.matrix for r in known.collect()} and len(stored) == 10


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


LARGE = {
    "edge_stats": queries.edge_stats,
    "integrity_clean": audit.integrity_failures,
    "integrity_seeded": audit.integrity_failures,
    "matrix_dimension_audit": queries.matrix_dimension_audit,
    "matrix_listing": queries.matrix_listing,
    "weight_histogram": queries.weight_histogram,
    "matrix_symmetry": lambda c: c.symmetry(),
}


@TABLES
@pytest.mark.parametrize("name", LARGE)
def test_no_matrix_in_one_value(spark, name):
    """Computed matrices are read by rows and cells, with the results of whole ones."""
    assert "AS matrix#" not in plan(registry.QUERIES[name](spark, SF))
    c = derived.catalog(spark, SF)
    c = registry.seeded(c) if name in ("integrity_seeded", "matrix_dimension_audit") else c
    assert rows_of(LARGE[name](c)) == rows_of(LARGE[name](cat.Catalog(spark, c.tables)))


def test_computed_symmetry_and_ragged_rows(spark):
    """A symmetric function, one that differs in a single cell, and rows of different lengths."""
    rows = spark.createDataFrame([(1, False, i, 4) for i in range(4)] + [(2, False, 0, 3), (2, False, 1, 1)], "problem_id int, is_symmetric boolean, i int, length int")
    for odd, known in ((99, True), (3, False)):
        c = cat.ComputedCatalog(spark, {}, rows.where("problem_id = 1"), lambda i, j: i * j + F.when((i == odd) & (j == 2), 1).otherwise(0))
        assert [tuple(r) for r in c.symmetry().collect()] == [(1, known)]
    sizes = cat.ComputedCatalog(spark, {}, rows, lambda i, j: i * 10 + j).matrix_sizes(a=(1, 0), b=(1, 2))
    assert sorted(tuple(r) for r in sizes.select("problem_id", "size", "first", "least", "most", "a", "b").collect()) == [(1, 4, 4, 4, 4, 10, 12), (2, 2, 3, 1, 3, 10, None)]


def test_a_matrix_is_checked_in_the_room_of_its_numbers():
    """Checked alone, a matrix took three times the room of its numbers, and its lines besides."""
    n = 600
    text = f"NAME : f\nTYPE : ATSP\nDIMENSION : {n}\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : FULL_MATRIX\nEDGE_WEIGHT_SECTION\n" + "\n".join(" ".join(str((i + j) % 10) for j in range(n)) for i in range(n)) + "\nEOF"
    tracemalloc.start()
    row = instances.parse_text(text, matrices=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row["errors"] == [] and row["symmetric"] and row["edge_weights"]["count"] == n * n and row["edge_weights"]["fits"]
    assert peak < 14 * n * n


@pytest.mark.parametrize("layout", MATRIX_FORMATS)
def test_matrix_in_place(layout, monkeypatch):
    """The same matrix in the room of the numbers, a few cells at a time."""
    monkeypatch.setattr(instances, "ROW_CELLS", 3)
    for extra in ([], [7]):
        count = {"FULL_MATRIX": 49}.get(layout, 28 if "DIAG" in layout else 21)
        for odd in (0.4, 5e9, -2147483648.0):
            numbers = np.array([*extra, odd, *(1.7 * k - 9 for k in range(count - 1))])
            kept = numbers.copy()
            whole = instances.dense(numbers, layout, 7)
            assert (numbers == kept).all()
            place = instances.dense(numbers, layout, 7, spare=True)
            assert whole.dtype == place.dtype and (whole == place).all()


@TABLES
def test_a_file_is_put_together_once(spark):
    """The sections were joined of their lines, and then again to the file."""
    assert plan(derived.instance_texts(spark, SF)).count("array_join(") == 1


def in_pieces(text, size=2):
    lines = text.split("\n")
    return ["\n".join(lines[i : i + size]) for i in range(0, len(lines), size)]


PACKED = [LOWER.replace("x ", ""), MATRIX, MATRIX.replace("DIMENSION", "COMMENT : c\nDIMENSION"), MATRIX.replace("ATSP", "SOP").replace("5", "x 5"), MATRIX.replace("6 0", "6"), MATRIX.replace("5", "5000000000"), MATRIX.replace("EDGE_WEIGHT_SECTION\n", "EDGE_WEIGHT_SECTION\n3\n"), MATRIX.replace("EDGE_WEIGHT_SECTION", "EDGE_WEIGHT_SECTION\n1 2\nEDGE_WEIGHT_SECTION"), TSP, LOWER]


@pytest.mark.parametrize("cells", [3, 1 << 20])
def test_a_matrix_is_checked_as_it_comes(cells, monkeypatch):
    """a file in pieces is checked as a whole one is, whether its numbers are held or let go."""
    monkeypatch.setattr(instances, "ROW_CELLS", cells)

    def told(text):
        try:
            row = instances.parse_text(text, matrices=False)
        except Exception as e:
            return type(e), str(e)
        return {k: v for k, v in row.items() if k != "symmetric" or row["problem_data"]["type"] not in instances.ONE_WAY}

    for text in PACKED:
        assert told(iter(in_pieces(text))) == told(text)
    late = MATRIX.replace("EOF", "TYPE : TSP\nEOF")
    if cells == 3:
        with pytest.raises(ValueError, match="TYPE is given again"):
            instances.parse_text(iter(in_pieces(late)), matrices=False)
    else:
        assert told(iter(in_pieces(late))) == told(late)


def test_a_large_matrix_is_not_held(monkeypatch):
    """the text and the numbers of a matrix took an executor's memory."""
    monkeypatch.setattr(instances, "ROW_CELLS", 1 << 12)
    n = 500
    head = f"NAME : f\nTYPE : SOP\nDIMENSION : {n}\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : FULL_MATRIX\nEDGE_WEIGHT_SECTION"
    pieces = (x for part in ((head,), (" ".join(str((i + j) % 10) for j in range(n)) for i in range(n)), ("EOF",)) for x in part)
    tracemalloc.start()
    row = instances.parse_text(pieces, matrices=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row["errors"] == [] and row["edge_weights"]["count"] == n * n and row["edge_weights"]["fits"]
    assert peak < n * n


def test_pieces_in_spark(spark):
    """parse() of pieces, the columns beside them and the bad files too; pieces out of order end the job."""
    rows = [(r.path, i, x) for r in corpus(spark).collect() for i, x in enumerate(in_pieces(r.text))] + [("n", 0, None)]
    pieces = spark.createDataFrame(rows, "path string, piece int, text string").coalesce(1)
    both = [{r.path: r for r in validate.validate(df).collect()} for df in (instances.parse(corpus(spark).unionByName(spark.createDataFrame([("n", None)], "path string, text string")), matrices=False), instances.parse(pieces, matrices=False, piece="piece"))]
    assert both[0] == both[1] and len(both[1]) == 8
    for wrong in (pieces.where("path <> '1' or piece <> 1"), pieces.where("path <> '1' or piece > 0")):
        for read in (instances.parse(wrong, matrices=False, piece="piece"), instances.matrix_rows(wrong, piece="piece")):
            with pytest.raises(Exception, match="of a text where"):
                read.collect()


def test_numbers_of_a_line():
    """the quick way of a line of counts gives what number() gives."""
    for line in ("", " ", "1", "0 007\t12  3 ", "9007199254740993 1", "99999999999999999999 2", "-1 2", "+1", "1-2", "0x1F", "1 x 2", "\u0663 1", "1\x0b2", "1.5 2e3", "1e999 4"):
        known = [np.nan if (x := instances.number(w)) is None else x for w in line.split()]
        assert np.array_equal(instances.numbers_of(line), np.array(known, np.float64), equal_nan=True), line


@TABLES
def test_files_are_written_in_pieces(spark):
    """a file of 36,000 nodes is more than a string can hold; its pieces are the same file."""
    whole = {r.path: r.text for r in derived.instance_texts(spark, SF).collect()}
    parts: dict[str, list] = {}
    for r in derived.instance_pieces(spark, SF).orderBy("path", "piece").collect():
        parts.setdefault(r.path, []).append(r.text)
    assert {k: "\n".join(v) for k, v in parts.items()} == whole and max(map(len, parts.values())) > 2
    n = 300
    rows = spark.range(n).select(F.col("id").cast("int").alias("i")).select(derived.row_text(F.col("i"), F.lit(n)).alias("a"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: derived.weight(F.col("i"), j).cast("string")), " ").alias("b"))
    assert rows.where("a <> b").count() == 0
    assert "piece#" in plan(registry._parsed(spark, SF))


@TABLES
@pytest.mark.parametrize("name", ["text_round_trip_nodes", "text_round_trip_edges", "text_summary", "text_round_trip_matrix"])
def test_text_queries_read_pieces(spark, name):
    """No file is put together: its matrix comes to the decoder a row at a time."""
    found = plan(registry.QUERIES[name](spark, SF))
    assert "piece#" in found and "array_join(transform(sequence(0, (dimension#" not in found


@pytest.mark.parametrize("layout", MATRIX_FORMATS)
@pytest.mark.parametrize("cells", [3, 30])
def test_matrix_put_aside(layout, cells, monkeypatch):
    """the rows of a matrix that was put aside as it came, with a DIMENSION before it too, are those of the whole one."""
    monkeypatch.setattr(instances, "ROW_CELLS", cells)
    n = 7
    for extra in ([], [n]):
        count = {"FULL_MATRIX": 49}.get(layout, 28 if "DIAG" in layout else 21)
        numbers = [*extra, *(1.7 * k - 9 for k in range(count))]
        pack = instances.Spooled({})
        for i in range(0, len(numbers), 5):
            pack.append(" ".join(map(repr, numbers[i : i + 5])))
        parts = list(pack.matrix(layout, n))
        assert (np.concatenate(parts) == instances.dense(numbers, layout, n)).all()
        assert len(parts) > 1 and all(p.dtype == np.int32 for p in parts)


def test_matrix_rows_of_pieces(spark):
    """the rows of files in pieces are those of whole files; of a file that doesn't fit there are none."""
    rows = [(r.path, i, x) for r in corpus(spark).collect() for i, x in enumerate(in_pieces(r.text))]
    pieces = spark.createDataFrame([*rows, ("one", 0, "NAME : o\nDIMENSION : 1\nEDGE_WEIGHT_TYPE : EXPLICIT\nEDGE_WEIGHT_FORMAT : LOWER_ROW")], "path string, piece int, text string").coalesce(1)
    found = sorted(map(tuple, instances.matrix_rows(pieces, piece="piece").collect()))
    assert found == [*sorted(map(tuple, instances.matrix_rows(corpus(spark)).collect())), ("one", "o", 0, [0])]
