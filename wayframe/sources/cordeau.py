"""Multi-depot files with positional lines, and their conversion to instance text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wayframe.sources.instances import BREAK, PARSED, decode, integer, number, parse_text

#: The first number of the header; types whose nodes have time windows are 4, 5, 6 and 7 with windows at the end of a line.
TYPES = {0: "VRP", 1: "PVRP", 2: "MDVRP", 3: "SDVRP", 4: "VRPTW", 5: "PVRPTW", 6: "MDVRPTW", 7: "SDVRPTW"}
CORDEAU = (
    "type int, vehicles int, customers int, depots int, depot_constraints array<struct<max_duration:double,max_load:int>>, "
    "nodes array<struct<id:int,x:double,y:double,service:double,demand:int,frequency:int,visits:array<int>,window:array<double>>>, errors array<string>"
)


def parse_cordeau(text: str | None) -> dict:
    """Header `type m n t`, t lines `duration load`, n customers, t depots; exactly as many lines.

    A customer line has id, x, y, service, demand, frequency, the number of
    visit combinations and these, and in types from 4 on a window at the end; a
    depot line has seven numbers at least and no demand. Every fault is an
    error, none is raised.
    """
    lines = [x.split() for x in BREAK.split(text or "") if x.strip()]
    out = {"type": None, "vehicles": None, "customers": None, "depots": None, "depot_constraints": [], "nodes": [], "errors": []}
    head = [integer(w) for w in lines[0]] if lines else []
    if len(head) != 4 or None in head:
        out["errors"].append("the header needs four integers")
        return out
    kind, m, n, t = head
    out |= {"type": kind, "vehicles": m, "customers": n, "depots": t}
    if kind not in TYPES:
        out["errors"].append("unknown type")
    if min(m, n, t) <= 0:
        out["errors"].append("vehicles, customers and depots must be positive")
    elif len(lines) != 1 + t + n + t:
        out["errors"].append("the number of lines doesn't fit the header")
    if out["errors"]:
        return out
    for i, words in enumerate(lines[1 : 1 + t], 1):
        duration, load = (number(words[0]), integer(words[1])) if len(words) == 2 else (None, None)
        if duration is None or load is None:
            out["errors"].append(f"depot constraint {i} needs a duration and a load")
            continue
        out["depot_constraints"].append({"max_duration": duration, "max_load": load})
    windowed = kind >= 4
    for k, words in enumerate(lines[1 + t :], 1):
        depot = k > n
        least = 7 if depot else 10 if windowed else 8
        place, whole = [number(w) for w in words[1:4]], [integer(w) for w in (words[:1] if depot else [words[0], *words[4:7]])]
        if len(words) < least or None in place or None in whole:
            out["errors"].append(f"node line {k} can't be read")
            continue
        node = {"id": whole[0], "x": place[0], "y": place[1], "service": place[2], "demand": 0, "frequency": 0, "visits": [], "window": None}
        if not depot:
            last = len(words) - 2 if windowed else len(words)
            visits = [integer(w) for w in words[7 : min(7 + whole[3], last)]]
            node |= {"demand": whole[1], "frequency": whole[2], "visits": visits[: visits.index(None)] if None in visits else visits}
        if windowed:
            node["window"] = [number(w) for w in words[-2:]]
            if None in node["window"]:
                out["errors"].append(f"node line {k} needs a time window")
                continue
        out["nodes"].append(node)
    return out


def to_tsplib(record: dict, name: str) -> str:
    """Instance text of a parsed file: customers first, depots last; loads and durations that differ have sections."""
    nodes, limits, t = record["nodes"], record["depot_constraints"], record["depots"]
    windowed = any(x["window"] for x in nodes)
    loads, durations = {c["max_load"] for c in limits}, {c["max_duration"] for c in limits}
    f = lambda x: f"{x:g}" if x == int(x) else repr(x)
    first = len(nodes) - t + 1
    out = [f"NAME : {name}", f"TYPE : {'MDVRPTW' if windowed else 'MDVRP'}", f"DIMENSION : {len(nodes)}", f"VEHICLES : {record['vehicles']}"]
    if len(loads) == 1 and min(loads) > 0:
        out.append(f"CAPACITY : {min(loads)}")
    if len(durations) == 1 and min(durations) > 0:
        out.append(f"DISTANCE : {f(min(durations))}")
    out += ["EDGE_WEIGHT_TYPE : EUC_2D", "NODE_COORD_SECTION", *(f"{i} {f(x['x'])} {f(x['y'])}" for i, x in enumerate(nodes, 1))]
    out += ["DEMAND_SECTION", *(f"{i} {x['demand']}" for i, x in enumerate(nodes, 1)), "DEPOT_SECTION", *map(str, range(first, len(nodes) + 1)), "-1"]
    out += ["SERVICE_TIME_SECTION", *(f"{i} {f(x['service'])}" for i, x in enumerate(nodes, 1))]
    if windowed:
        out += ["TIME_WINDOW_SECTION", *(f"{i} {f(x['window'][0])} {f(x['window'][1])}" for i, x in enumerate(nodes, 1) if x["window"])]
    if len(loads) > 1:
        out += ["DEPOT_CAPACITY_SECTION", *(f"{i} {c['max_load']}" for i, c in enumerate(limits, first))]
    if len(durations) > 1:
        out += ["DEPOT_DURATION_SECTION", *(f"{i} {f(c['max_duration'])}" for i, c in enumerate(limits, first))]
    return "\n".join([*out, "EOF", ""])


def parse(files: DataFrame, text: str = "text") -> DataFrame:
    return decode(files, parse_cordeau, CORDEAU, text)


def parse_as_instances(files: DataFrame, name: str, text: str = "text") -> DataFrame:
    """The parse contract of positional files, by way of their instance text."""

    def convert(t: str | None) -> dict:
        record = parse_cordeau(t)
        if record["errors"]:
            empty = parse_text("")
            return empty | {"errors": [f"CordeauParseError: {e}" for e in record["errors"]]}
        return parse_text(to_tsplib(record, name))

    return decode(files, convert, PARSED, text).drop("symmetric")
