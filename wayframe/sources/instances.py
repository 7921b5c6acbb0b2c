"""Instance text to typed columns, one row a file, without a shuffle.

Text with sections is order-dependent state, so a file is decoded by a plain
function in Arrow batches: as one expression tree the same took Catalyst about
half a minute to analyse and compile for each query, and left code generation.
So do packed matrices, whose nine layouts are one line of numpy each.
Everything after it (validation, catalog) is DataFrame code. Errors
are collected in a column; no file makes the job fail.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from wayframe.functions.matrix import ROWS_OF
from wayframe.schemas import ALL_TYPES, CORE_SECTIONS, CORE_TYPES, EXTENDED_SECTIONS, INT_HEADERS, MATRIX_FORMATS, NO_DIAGONAL, NUMBER_HEADERS, STRING_HEADERS, STRIPPED_SECTIONS, THREED_WEIGHTS, TWOD_WEIGHTS, canonical_type
from wayframe.session import ship

NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", re.ASCII)
INTEGER = re.compile(r"[+-]?\d+", re.ASCII)
HEADER = re.compile(r"[A-Z][A-Z0-9_]*\s*:")
BREAK = re.compile(r"\r\n|\n|\r")
#: Words of these letters alone are numbers just where float() takes them.
PLAIN = re.compile(r"[0-9+\-.eE \t]*")
#: The bytes of words that are plain counts.
COUNTS = b"0123456789 \t"
#: Types whose matrices are never given as symmetric.
ONE_WAY = ("ATSP", "SOP")
#: Bytes of text that are decoded before their rows are given on; a longer text is alone.
GROUP_BYTES = 1 << 22
#: Cells of a matrix that matrix_rows() gives on at a time, and that are held of a file's pieces before they are let go or put aside.
ROW_CELLS = 1 << 20

_DATA = (
    "name string, type string, comment string, dimension int, capacity int, node_coord_type string, edge_weight_type string, display_data_type string, edge_weight_format string, edge_data_format string, "
    "vehicles int, periods int, capacity_vol int, capacity_weight int, salesmen int, external_salesmen int, scale int, risk_threshold int, k int, max_distance double, service_time double, grid_size double, probability double, "
    "time_windows array<array<double>>, service_times array<array<double>>, pickup_and_delivery array<array<double>>, backhauls array<int>, depot_capacities array<int>, depot_durations array<struct<id:int,duration:double>>, required_nodes array<int>, "
    "has_time_windows boolean, has_service_times boolean, has_pickup_delivery boolean, has_backhauls boolean, stripped_sections array<string>, volume_demands array<struct<id:int,volume:int>>"
)
PARSED = (
    f"problem_data struct<{_DATA.replace(' string', ':string').replace(' int', ':int').replace(' double', ':double').replace(' array', ':array').replace(' boolean', ':boolean')}>, "
    "coords array<array<double>>, display_coords array<array<double>>, demands array<int>, depots array<int>, edges array<array<int>>, fixed_edges array<array<int>>, "
    "tours array<struct<tour_id:int,nodes:array<int>>>, edge_weights struct<format:string,size:int,numbers:array<double>,count:int,fits:boolean>, coord_ids array<int>, demand_ids array<int>, matrix array<array<int>>, symmetric boolean, faults array<struct<section:string,item:int,reason:string>>, errors array<string>"
)

_COLUMNS = {"metadata", "errors", *re.findall(r"(?:^|, )(\w+) (?=array|struct|boolean)", PARSED)}


def integer(word: str) -> int | None:
    value = int(word) if INTEGER.fullmatch(word) and len(word) < 12 else None
    return value if value is not None and -(1 << 31) <= value < 1 << 31 else None


def number(word: str) -> float | None:
    value = float(word) if NUMBER.fullmatch(word) else None
    return value if value is not None and abs(value) != float("inf") else None


def numbers_of(line: str) -> np.ndarray:
    """number() of each word, nan where it is none."""
    if line.isascii() and not line.isspace() and not (raw := line.encode()).translate(None, COUNTS) and raw:
        counts = np.fromstring(raw, np.int64, sep=" ")
        if counts.max() < 1 << 53:
            return counts.astype(np.float64)
    words = line.split()
    if PLAIN.fullmatch(line):
        try:
            values = np.fromiter(map(float, words), np.float64, len(words))
            if np.isfinite(values).all():
                return values
        except ValueError:
            pass
    return np.array([np.nan if (x := number(w)) is None else x for w in words], np.float64)


def lines_of(text: str | Iterable[str | None]) -> Iterable[str]:
    """The lines of a text, or of its pieces, which are whole lines."""
    if isinstance(text, str):
        return BREAK.split(text)
    return (line for piece in text if piece for line in ((piece,) if "\n" not in piece and "\r" not in piece else BREAK.split(piece)))


def tokenize(text: str | Iterable[str | None], packed: Callable[[dict[str, str]], Counted] | None = None) -> tuple[list[tuple[str, str]], list[tuple[str, list[str]]]]:
    """(key, value) of headers and (name, lines) of sections, in file order.

    packed makes of the headers so far what takes the lines of a matrix.

    Blank lines and # comments are skipped. A section begins at a line that ends
    in _SECTION, and ends at the next one, at EOF, or at a line with an
    upper-case keyword and a colon. Outside of sections any line with a colon
    is a header. FIXED_EDGES may hold its pairs inline. Blanks around colons
    don't matter.
    """
    headers: list[tuple[str, str]] = []
    sections: list[tuple[str, list[str]]] = []
    body: list[str] | None = None
    for line in map(str.strip, lines_of(text)):
        if not line or line[0] == "#":
            continue
        if line == "EOF":
            body = None
        elif line.endswith("_SECTION"):
            body = packed(dict(headers)) if packed and line == "EDGE_WEIGHT_SECTION" else []
            sections.append((line, body))
        elif ":" in line and (body is None or HEADER.match(line)):
            key, value = (x.strip() for x in line.split(":", 1))
            body = None
            if key != "FIXED_EDGES":
                headers.append((key, value))
                continue
            sections.append(("FIXED_EDGES_SECTION", own := [value] if value else []))
            body = None if value.split()[-1:] == ["-1"] else own
        elif body is not None:
            body.append(line)
    return headers, sections


@dataclass(frozen=True)
class Dialect:
    """What a caller's files have beyond the format: types, and sections and headers with their decoders.

    types are upper-case TYPE names; like a known type outside the core they have
    the extended sections. A decoder is named by its keyword and given as (DDL
    type, function): that of a section gets its lines, that of a header its value.
    Their results go to one column each, named like the keyword in lower case;
    a keyword a file doesn't have gives null, and a decoder that fails an error
    of that file alone. Decoders are plain functions and run where the text is
    decoded.
    """

    types: frozenset[str] = frozenset()
    sections: dict[str, tuple[str, Callable[[list[str]], object]]] = field(default_factory=dict)
    headers: dict[str, tuple[str, Callable[[str], object]]] = field(default_factory=dict)

    def __post_init__(self):
        known = {*CORE_SECTIONS, *EXTENDED_SECTIONS, *STRIPPED_SECTIONS, *STRING_HEADERS, *INT_HEADERS, *NUMBER_HEADERS}
        names = [*self.sections, *self.headers]
        if taken := sorted({n for n in names if n in known} | {n for n in self.columns() if n in _COLUMNS}):
            raise ValueError(f"{', '.join(taken)} can't be given a decoder")
        if len({n.lower() for n in names}) < len(names) or any(not n.endswith("_SECTION") for n in self.sections):
            raise ValueError("keywords must differ, and those of sections end in _SECTION")

    def columns(self) -> dict[str, str]:
        return {name.lower(): kind for name, (kind, _) in (*self.sections.items(), *self.headers.items())}

    def arrow(self) -> dict[str, pa.DataType]:
        return {name: to_arrow_type(_parse_datatype_string(kind)) for name, kind in self.columns().items()}

    def decode(self, head: dict[str, str], sections: dict[str, list[str]], errors: list[str], arrow: dict[str, pa.DataType]) -> dict:
        out = {}
        for found, decoders in ((sections, self.sections), (head, self.headers)):
            for name, (_, function) in decoders.items():
                out[name.lower()] = None
                try:
                    if name in found:
                        value = function(found[name])
                        pa.array([value], arrow[name.lower()])
                        out[name.lower()] = value
                except Exception as e:  # noqa: BLE001 a caller's decoder may raise anything
                    errors.append(f"ParseError: {name} can't be read: {type(e).__name__}: {e}")
        return out


class Counted:
    """The numbers of a matrix as its lines come, whose text isn't held.

    They are held themselves, unless there are more than ROW_CELLS and the
    headers so far give a type of ONE_WAY: no one asks then for more than their
    count, the first of them and whether all fit a cell.
    """

    def __init__(self, headers: dict[str, str]):
        self.aside = self.lossy = canonical_type(headers.get("TYPE")) in ONE_WAY
        self.words = self.count = 0
        self.first = self.wide = None
        self.faults: list[dict] = []
        self.blocks: list[np.ndarray] | None = []

    def append(self, line: str) -> None:
        own = numbers_of(line)
        bad = np.isnan(own)
        words, self.words = self.words, self.words + len(own)
        if bad.any():
            self.faults += [{"section": "EDGE_WEIGHT_SECTION", "item": words + int(i) + 1, "reason": "no number"} for i in np.flatnonzero(bad)]
            own = own[~bad]
        if len(own) == 0:
            return
        self.first = float(own[0]) if self.first is None else self.first
        self.count += len(own)
        cells = np.floor(own + 0.5)
        if self.wide is None and (cells.min() < -(1 << 31) or cells.max() >= 1 << 31):
            self.wide = cells[(cells < -(1 << 31)) | (cells >= 1 << 31)][:1]
        self.take(own, cells)

    def take(self, own: np.ndarray, cells: np.ndarray) -> None:
        if self.blocks is not None:
            self.blocks.append(own)
            if self.aside and self.count > ROW_CELLS:
                self.blocks = None

    def held(self) -> np.ndarray | None:
        """The numbers, each in one place at a time; None if they were let go."""
        if self.blocks is None:
            return None
        found, count = np.empty(self.count), 0
        self.blocks.reverse()
        while self.blocks:
            own = self.blocks.pop()
            found[count : count + len(own)] = own
            count += len(own)
        return found


class Spooled(Counted):
    """The cells of a matrix as its lines come, put aside packed: in memory up to a bound, then in a file without a name."""

    def __init__(self, headers: dict[str, str]):
        super().__init__(headers)
        self.lossy = False
        self.file = tempfile.SpooledTemporaryFile(max_size=1 << 25)
        self.sizes: list[tuple[int, int]] = []
        self.waiting = 0

    def take(self, own: np.ndarray, cells: np.ndarray) -> None:
        if self.wide is None:
            self.blocks.append(cells.astype(np.int32))
            self.waiting += len(cells)
            if self.waiting >= ROW_CELLS:
                self.store()

    def store(self) -> None:
        if self.blocks:
            cells = np.concatenate(self.blocks)
            data = pa.compress(pa.py_buffer(cells), "lz4_raw", asbytes=True)
            self.file.write(data)
            self.sizes.append((len(data), cells.nbytes))
            self.blocks, self.waiting = [], 0

    def held(self) -> None:
        return None

    def cells(self) -> Iterator[np.ndarray]:
        self.store()
        self.file.seek(0)
        for size, whole in self.sizes:
            yield np.frombuffer(pa.decompress(self.file.read(size), whole, "lz4_raw"), np.int32)

    def matrix(self, layout: str, n: int) -> Iterator[np.ndarray]:
        """The rows of the matrix that fits, some at a time; only triangles are put together whole."""
        kind, extra = fitting(self.count, self.first, layout, n)
        step = max(1, ROW_CELLS // n)
        if kind != "FULL":
            whole = dense(np.concatenate([np.empty(0, np.int32), *self.cells()]), layout, n)
            yield from (whole[i : i + step] for i in range(0, n, step))
            return
        rest = np.empty(0, np.int32)
        for cells in self.cells():
            rest = np.concatenate([rest, cells[extra:]])
            extra = 0
            while len(rest) >= step * n:
                yield rest[: step * n].reshape(step, n)
                rest = rest[step * n :]
        if len(rest):
            yield rest.reshape(-1, n)


class _Decoder:
    """Decodes sections; one that can't be read adds one error and gives what could be, and faults say at which items."""

    def __init__(self, sections: dict[str, list[str]], errors: list[str]):
        self.sections, self.errors = sections, errors
        self.faults: list[dict] = []

    def words(self, name: str) -> list[str]:
        return [w for line in self.sections.get(name, ()) for w in line.split()]

    def numbers(self, name: str) -> np.ndarray | None:
        """The numbers of a section; read a line at a time, as its words take ten times their room, and its lines let go. None if they aren't held."""
        lines = self.sections.get(name, [])
        if isinstance(lines, Counted):
            self.check(not lines.faults, name)
            self.faults += lines.faults
            return lines.held()
        found, count = np.empty(sum((len(x) + 1) // 2 for x in lines)), 0
        lines.reverse()
        while lines:
            own = numbers_of(lines.pop())
            found[count : count + len(own)] = own
            count += len(own)
        found = found[:count]
        bad = np.isnan(found)
        self.check(not bad.any(), name)
        self.faults += [{"section": name, "item": int(i) + 1, "reason": "no number"} for i in np.flatnonzero(bad)]
        return found[~bad] if bad.any() else found

    def check(self, ok: bool, name: str) -> None:
        if not ok:
            self.errors.append(f"ParseError: {name} can't be read")

    def fault(self, name: str, items: list, reason: str) -> None:
        """An item (counted from 1) for each that is None."""
        self.faults += [{"section": name, "item": i, "reason": reason} for i, x in enumerate(items, 1) if x is None]

    def indexed(self, name: str, decode: Callable, least: int, most: int) -> list[tuple[int, list]]:
        rows = []
        for line in self.sections.get(name, ()):
            first, *rest = line.split()
            rows.append((integer(first), [decode(w) for w in rest]))
        fine = [r for r in rows if r[0] is not None and None not in r[1] and least <= len(r[1]) <= most]
        known = {r[0] for r in rows}
        if not len(fine) == len(rows) == len(known):
            self.check(False, name)
            self.fault(name, [r[0] if None not in r[1] else None for r in rows], "no number")
            self.fault(name, [r if least <= len(r[1]) <= most else None for r in rows], "wrong number of values")
            unseen = known - {None}
            for i, (node, _) in enumerate(rows, 1):
                if node is not None and node not in unseen:
                    self.faults.append({"section": name, "item": i, "reason": f"node {node} again"})
                unseen.discard(node)
        return sorted(fine, key=lambda r: r[0])

    def ended(self, name: str) -> list[int]:
        """Integers up to the -1 that must come last."""
        words = self.words(name)
        if not words:
            return []
        values = [integer(w) for w in words[:-1] if words[-1] == "-1"]
        self.check(words[-1] == "-1" and None not in values, name)
        self.fault(name, values, "no number")
        if words[-1] != "-1":
            self.fault(name, [*words, None], "no -1 at the end")
        return [v for v in values if v is not None]

    def pairs(self, name: str) -> list[list[int]]:
        values = self.ended(name)
        self.check(len(values) % 2 == 0, name)
        return [[a - 1, b - 1] for a, b in zip(values[::2], values[1::2], strict=False)]

    def edges(self, layout: str | None) -> list[list[int]]:
        name = "EDGE_DATA_SECTION"
        lines = [x for x in self.sections.get(name, ()) if x.split() != ["-1"]]
        listed = any(":" in x or len(x.split()) >= 3 and x.split()[-1] == "-1" for x in lines)
        out, fine = [], True
        if layout == "ADJ_LIST" or layout is None and listed:
            for line in lines:
                first, *rest = (integer(w) for w in line.replace(":", " ").split())
                fine &= first is not None and None not in rest
                out += [[first - 1, x - 1] for x in rest if first is not None and x is not None and x != -1]
        else:
            for line in lines:
                ends = [integer(w) for w in line.split() if w != "-1"]
                fine &= len(ends) % 2 == 0 and None not in ends
                out += [[a - 1, b - 1] for a, b in zip(ends[::2], ends[1::2], strict=False) if a is not None and b is not None]
        self.check(fine, name)
        return out

    def tours(self) -> list[dict]:
        out, now, fine = [], [], True
        for w in [*self.words("TOUR_SECTION"), "-1"]:
            if w != "-1":
                now.append(integer(w))
            elif now:
                fine &= None not in now
                out.append({"tour_id": len(out), "nodes": [x - 1 for x in now if x is not None]})
                now = []
        self.check(fine, "TOUR_SECTION")
        return out


def fitting(count: int, first: float | None, layout: str, n: int | None) -> tuple[str, int] | None:
    """What so many numbers are of an n by n matrix (FULL, DIAG, BARE), and how many of them stand before it; None if they fit no layout."""
    if layout not in MATRIX_FORMATS or not n or n < 0:
        return None
    counts = {"FULL": n * n, "DIAG": n * (n + 1) // 2, "BARE": n * (n - 1) // 2}
    kind = "FULL" if layout == "FULL_MATRIX" else "DIAG" if layout in NO_DIAGONAL else "BARE"
    if count == counts[kind] + 1 and first == n:
        return kind, 1
    if kind == "DIAG" and count == counts["BARE"]:
        kind = "BARE"
    return (kind, 0) if count == counts[kind] else None


def dense(numbers: list[float] | np.ndarray, layout: str, n: int | None, spare: bool = False) -> np.ndarray | None:
    """The full integer matrix of a layout; None if the count of numbers fits none. spare: the numbers' room is taken for it.

    Two deviations are read as meant: a leading DIMENSION, and a diagonal layout
    whose zero diagonal is left out.
    """
    a = np.asarray(numbers, np.float64)
    found = fitting(len(a), a[0] if len(a) else None, layout, n)
    if found is None:
        return None
    kind, extra = found
    a = a[extra:]
    a = np.add(a, 0.5, out=a if spare else None)
    np.floor(a, out=a)
    whole = np.int32 if len(a) == 0 or -(1 << 31) <= a.min() and a.max() < 1 << 31 else np.int64
    if spare:
        made = a.view(whole)[: len(a)]
        for i in range(0, len(a), ROW_CELLS):
            made[i : i + ROW_CELLS] = a[i : i + ROW_CELLS].astype(whole)
        a = made
    else:
        a = a.astype(whole)
    if kind == "FULL":
        return a.reshape(n, n)
    out = np.zeros((n, n), a.dtype)
    lower = ROWS_OF.get(layout, layout).startswith("LOWER")
    apart = int(kind == "BARE")
    at = np.tril_indices(n, -apart) if lower else np.triu_indices(n, apart)
    out[at] = out.T[at] = a
    return out


def parse_text(text: str | Iterable[str | None] | None, dialect: Dialect | None = None, arrow: dict[str, pa.DataType] | None = None, matrices: bool = True, packed: type[Counted] = Counted) -> dict:
    """The parse contract of one document, with ids from 0 (backhauls and required_nodes keep the file's), and the dialect's columns (of Dialect.arrow()). matrices: see parse().

    Of a text in pieces, packed takes the matrix unless it is asked for.
    """
    dialect = dialect or Dialect()
    headers, found = tokenize(text or "", None if matrices or text is None or isinstance(text, str) else packed)
    head, sections, errors = dict(headers), dict(found), []
    kind = canonical_type(head.get("TYPE"))
    if kind is not None and kind not in ALL_TYPES and (own := kind.split("(")[0].strip().upper()) in dialect.types:
        kind = own
    extended = kind is not None and kind not in CORE_TYPES
    data: dict = {n.lower(): head.get(n) for n in STRING_HEADERS}
    data["type"] = kind
    for name in INT_HEADERS + NUMBER_HEADERS:
        key = "max_distance" if name == "DISTANCE" else name.lower()
        raw = head.get(name)
        data[key] = None if raw is None else (integer if name in INT_HEADERS else number)(raw)
        if raw is not None and data[key] is None:
            errors.append(f"ParseError: {name} is no number")
    unknown = sections.keys() - {*CORE_SECTIONS, *EXTENDED_SECTIONS, *STRIPPED_SECTIONS, *dialect.sections}
    errors += [f"ParseError: unknown section {n}" for n in sorted(unknown)]
    d = _Decoder(sections, errors)
    xy = d.indexed("NODE_COORD_SECTION", number, 2, 3)
    show = d.indexed("DISPLAY_DATA_SECTION", number, 2, 2)
    need = d.indexed("DEMAND_SECTION", integer, 1, 2)
    values = d.numbers("EDGE_WEIGHT_SECTION")
    gone = sections["EDGE_WEIGHT_SECTION"] if values is None else None
    data["volume_demands"] = [{"id": i, "volume": v[1]} for i, v in need if len(v) > 1] or None
    data |= {
        "has_time_windows": "TIME_WINDOW_SECTION" in sections,
        "has_service_times": "SERVICE_TIME_SECTION" in sections,
        "has_pickup_delivery": bool({"PICKUP_AND_DELIVERY_SECTION", "PICKUP_SECTION"} & sections.keys()),
        "has_backhauls": "BACKHAUL_SECTION" in sections,
        "stripped_sections": [] if extended else [n for n in STRIPPED_SECTIONS if n in sections],
    }
    if extended:
        values = lambda rows: [v for _, v in rows] or None
        data["time_windows"] = values(d.indexed("TIME_WINDOW_SECTION", number, 2, 2))
        data["service_times"] = values(d.indexed("SERVICE_TIME_SECTION", number, 1, 1))
        data["pickup_and_delivery"] = values(d.indexed("PICKUP_AND_DELIVERY_SECTION", number, 3, 6))
        data["backhauls"] = d.ended("BACKHAUL_SECTION") or None
        data["required_nodes"] = d.ended("REQUIRED_NODES_SECTION") or None
        data["depot_capacities"] = [v[0] for _, v in d.indexed("DEPOT_CAPACITY_SECTION", integer, 1, 1)] or None
        data["depot_durations"] = [{"id": i, "duration": v[0]} for i, v in d.indexed("DEPOT_DURATION_SECTION", number, 1, 1)] or None
        if data["dimension"]:
            for name in ("TIME_WINDOW_SECTION", "SERVICE_TIME_SECTION", "PICKUP_AND_DELIVERY_SECTION"):
                ids = [integer(x.split()[0]) for x in sections.get(name, ())]
                if ids and (len(ids) != data["dimension"] or set(ids) != set(range(1, data["dimension"] + 1))):
                    errors.append(f"ValidationError: {name} needs nodes 1 to DIMENSION")
    weight, layout = ((data[k] or "").upper() for k in ("edge_weight_type", "edge_weight_format"))
    explicit = weight == "EXPLICIT" and layout != "FUNCTION"
    matrix = dense(values, layout, data["dimension"], spare=not matrices) if explicit and gone is None else None
    fits = matrix is not None
    if explicit and gone is not None and fitting(gone.count, gone.first, layout, data["dimension"]):
        if gone.wide is not None:
            pa.array([gone.wide.astype(np.int64)], pa.list_(pa.int32()))  # fails as the column would
        if gone.lossy and kind not in ONE_WAY:
            raise ValueError("TYPE is given again after a large EDGE_WEIGHT_SECTION")
        fits = True
    if not matrices and matrix is not None and matrix.dtype != np.int32:
        pa.array(list(matrix), pa.list_(pa.int32()))  # fails as the column would
    return {
        "problem_data": data,
        "matrix": list(matrix) if matrices and matrix is not None else None,
        "symmetric": None if matrix is None else bool((matrix == matrix.T).all()),
        "coords": [v for _, v in xy],
        "display_coords": [v for _, v in show],
        "demands": [v[0] for _, v in need],
        "depots": sorted(x - 1 for x in d.ended("DEPOT_SECTION")),
        "edges": d.edges(data["edge_data_format"]),
        "fixed_edges": d.pairs("FIXED_EDGES_SECTION"),
        "tours": d.tours(),
        "edge_weights": {"format": layout or None, "size": data["dimension"], "numbers": values if matrices else None, "count": len(values) if gone is None else gone.count, "fits": fits} if explicit else None,
        "coord_ids": [i for i, _ in xy],
        "demand_ids": [i for i, _ in need],
        **dialect.decode(head, sections, errors, arrow or {}),
        "faults": d.faults,
        "errors": errors,
    }


def documents(batches: Iterator[pa.RecordBatch], keep: int, piece: bool) -> Iterator[tuple[pa.RecordBatch, Iterator[str | None]]]:
    """A row of the first columns for each document, and its text, or its pieces as they come.

    Columns: keep ones, the text and, if piece, the piece's number. It fails
    where the pieces of a document don't follow one another, numbered from 0.
    """

    failed: list[BaseException] = []

    def rows() -> Iterator[tuple[int, pa.RecordBatch, str | None]]:
        of, due, name = -1, 0, None
        try:
            for batch in batches:
                numbers = batch.column(keep + 1).to_pylist() if piece else [0] * batch.num_rows
                for at, k in enumerate(numbers):
                    if k == 0:
                        of, name = of + 1, batch.select(range(keep)).take(pa.array([at]))
                    elif k != due or not name.equals(batch.select(range(keep)).slice(at, 1)):
                        raise ValueError(f"piece {k} of a text where {due} is due")
                    due = k + 1
                    yield of, name, batch.column(keep)[at].as_py()
        except Exception as e:
            failed.append(e)
            raise

    for _, own in groupby(rows(), lambda r: r[0]):
        first = next(own)
        yield first[1], (t for part in ((first,), own) for _, _, t in part)
        if failed:  # a decoder may have taken it for its document's
            raise failed[0]


def decode(files: DataFrame, function: Callable[[str | None], dict], schema: str, text: str = "text", piece: str | None = None) -> DataFrame:
    """files without its text, with the columns that function makes of each text.

    A text for which function fails, or whose values fit no column, has empty
    columns and the error: it doesn't end the job. Rows are given on in groups of
    bounded text, so that a batch of large files isn't held decoded. piece: see parse().
    """
    ship(files.sparkSession)
    keep = [f for f in files.schema.fields if f.name not in (text, piece)]
    made = _parse_datatype_string(schema)
    arrow = [to_arrow_type(f.dataType) for f in made.fields]
    names = [f.name for f in made.fields]
    blank = {f.name: [] if f.dataType.typeName() == "array" else None for f in made.fields}

    def whole(rows: list[dict]) -> list[pa.Array]:
        return [pa.array([r[n] for r in rows], t) for n, t in zip(names, arrow, strict=True)]

    def one(text: str | None) -> dict:
        try:
            row = function(text)
            whole([row])
            return row
        except Exception as e:  # noqa: BLE001 a bad file refuses only itself
            return blank | {"errors": [f"ParseError: {type(e).__name__}: {e}"]}

    def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, texts in documents(batches, len(keep), True):
            yield pa.RecordBatch.from_arrays([*first.columns, *whole([one(texts)])], names=[*(f.name for f in keep), *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in grouped(batch):
                texts = part.column(len(keep)).to_pylist()
                try:
                    new = whole([function(t) for t in texts])
                except Exception:  # noqa: BLE001 each again by itself
                    new = whole([one(t) for t in texts])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *new], names=[*(f.name for f in keep), *names])

    def grouped(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        begin = held = 0
        for i, size in enumerate(pc.binary_length(batch.column(len(keep))).to_pylist()):
            if i > begin and held + (size or 0) > GROUP_BYTES:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size or 0
        yield batch.slice(begin)

    return files.select(*(f.name for f in keep), text, *([piece] if piece else [])).mapInArrow(in_pieces if piece else run, StructType([*keep, *made.fields]))


def parse(files: DataFrame, text: str = "text", dialect: Dialect | None = None, matrices: bool = True, piece: str | None = None) -> DataFrame:
    """files with the parse contract, the dense matrix, metadata, errors (`error_type: message`), faults (the items, from 1, of sections that can't be read) and the dialect's columns.

    Unless matrices, they are decoded and checked, but neither they nor their
    packed numbers are given: edge_weights tells how many numbers there are and
    whether they fit. matrix_rows() gives matrices that are too large for one value.

    piece names a column that numbers the pieces of a text from 0, for files that
    are too large for one value: a row a piece, of whole lines, those of a file
    one after the other in one task. Without matrices, a large one of an ATSP or
    SOP isn't held at all; a file that gives another TYPE after it is refused.
    """
    if dialect and (taken := dialect.columns().keys() & {c.lower() for c in files.columns}):
        raise ValueError(f"the files have columns named {', '.join(sorted(taken))}")
    dialect = dialect or Dialect()
    own = "".join(f", {name} {kind}" for name, kind in dialect.columns().items())
    df = decode(files, partial(parse_text, dialect=dialect, arrow=dialect.arrow(), matrices=matrices), PARSED + own, text, piece)
    p = F.col("problem_data")
    weight = F.upper(p["edge_weight_type"])
    source = (
        F.when((weight == "EXPLICIT") & (F.upper(p["edge_weight_format"]) == "FUNCTION"), "explicit_function")
        .when(weight == "EXPLICIT", "explicit_matrix")
        .when(weight == "SPECIAL", "special_function")
        .when(weight.isin(*TWOD_WEIGHTS, *THREED_WEIGHTS), "coordinate_based")
        .otherwise("unweighted")
    )
    symmetric = F.when(p["type"].isin("ATSP", "SOP"), False).when(F.col("symmetric").isNotNull(), F.col("symmetric")).when(source == "unweighted", None).otherwise(True)
    flags = {"has_coordinates": "coords", "has_display_coords": "display_coords", "has_demands": "demands", "has_depots": "depots", "has_edges": "edges", "has_fixed_edges": "fixed_edges", "has_tours": "tours"}
    return df.withColumn("metadata", F.struct(*((F.size(c) > 0).alias(n) for n, c in flags.items()), symmetric.alias("is_symmetric"), source.alias("weight_source"))).drop("symmetric")


def matrix_rows(files: DataFrame, text: str = "text", piece: str | None = None) -> DataFrame:
    """files without the text, with name, i and row: the dense matrices a row at a time, so that none has to fit one value. piece: see parse()."""
    ship(files.sparkSession)
    keep = [f for f in files.schema.fields if f.name not in (text, piece)]
    made = _parse_datatype_string("name string, i int, row array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, texts in documents(batches, len(keep), piece is not None):
            packs: list[Spooled] = []
            try:
                found = parse_text(texts, matrices=False, packed=lambda headers, packs=packs: packs.append(Spooled(headers)) or packs[-1])
            except Exception:  # noqa: BLE001 parse() has the error
                continue
            weights, name = found["edge_weights"], found["problem_data"]["name"]
            found.clear()
            begin = 0
            for rows in (packs or [Spooled({})])[-1].matrix(weights["format"], weights["size"]) if weights and weights["fits"] else ():
                count, n = rows.shape
                own = [pa.repeat(c[0], count) for c in first.columns]
                row = pa.ListArray.from_arrays(pa.array(range(0, count * n + 1, n), pa.int32()), pa.array(rows.reshape(-1), pa.int32()))
                yield pa.RecordBatch.from_arrays([*own, pa.array([name] * count, pa.string()), pa.array(range(begin, begin + count), pa.int32()), row], names=[*(f.name for f in keep), *made.names])
                begin += count

    return files.select(*(f.name for f in keep), text, *([piece] if piece else [])).mapInArrow(run, StructType([*keep, *made.fields]))
