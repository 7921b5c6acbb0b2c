"""Outputs: Parquet exports, JSON documents, reports and backups."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.operators import queries
from wayframe.operators.catalog import Catalog
from wayframe.schemas import COMPRESSIONS, TABLES
from wayframe.sources.files import safe_name


def allowed_tables(tables: list[str] | None) -> list[str]:
    unknown = sorted(set(tables or ()) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    return list(tables or TABLES)


def export_parquet(c: Catalog, folder: str, tables: list[str] | None = None, compression: str = "snappy", files: int | None = None, prefix: str = "") -> dict[str, str]:
    """Each table to folder/prefix+table; files limits how many files a table has (None: as it is partitioned)."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"unknown compression {compression!r}")
    out = {}
    for name in allowed_tables(tables):
        df = c[name] if files is None else c[name].coalesce(files)
        out[name] = f"{folder}/{prefix}{name}"
        df.write.mode("overwrite").option("compression", compression).parquet(out[name])
    return out


def parquet_info(spark: SparkSession, path: str) -> dict:
    """rows, columns, and the codec and size that the local files' footers tell."""
    df = spark.read.parquet(path)
    files = [Path(path)] if Path(path).is_file() else sorted(Path(path).glob("*.parquet"))
    codecs = {m.row_group(0).column(0).compression for f in files if (m := pq.read_metadata(f)).num_row_groups}
    return {"rows": df.count(), "columns": [(f.name, f.dataType.simpleString()) for f in df.schema], "compression": ",".join(sorted(codecs)).lower(), "bytes": sum(f.stat().st_size for f in files)}


JSON_ARRAYS = ("coords", "display_coords", "demands", "depots", "edges", "fixed_edges", "tours")


def json_documents(parsed: DataFrame) -> DataFrame:
    """(type_dir, file_name, value): one JSON document a problem; nulls stay, empty arrays go."""
    p = F.col("problem_data")
    safe = F.regexp_replace(F.regexp_replace(F.element_at(F.split(F.coalesce(p["name"], F.lit("problem")), r"[/\\]"), -1), "[^A-Za-z0-9._-]+", "_"), r"^[._-]+|[._-]+$", "")
    kind = F.lower(F.coalesce(p["type"], F.lit("unknown")))
    parts = [p.alias("problem"), *(F.when(F.size(c) > 0, F.col(c)).alias(c) for c in JSON_ARRAYS), F.col("matrix").alias("edge_weight_matrix"), F.col("metadata")]
    return parsed.select(kind.alias("type_dir"), F.concat(F.when(safe == "", "problem").otherwise(safe), F.lit("."), kind, F.lit(".json")).alias("file_name"), F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("value"))


def write_json(parsed: DataFrame, folder: str) -> None:
    """Documents as text, one a line, below folder/type_dir=.../."""
    json_documents(parsed).select("type_dir", "value").write.mode("overwrite").partitionBy("type_dir").text(folder)


def write_json_files(parsed: DataFrame, folder: str) -> DataFrame:
    """One file a document, folder/type/name.type.json; unchanged ones are left alone. Returns (path, status).

    Written by the executors through a file system address, so folder must be
    one they share.
    """

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(f"{folder}/{r['type_dir']}/{r['file_name']}")
                data = json.dumps(json.loads(r["value"]), indent=2).encode()
                old = None
                if system.get_file_info(path).is_file:
                    with system.open_input_stream(path) as f:
                        old = f.read()
                if old != data:
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    with system.open_output_stream(path) as f:
                        f.write(data)
                rows.append((path, "unchanged" if old == data else "written"))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["path", "status"])

    return json_documents(parsed).mapInArrow(run, "path string, status string")


def export_csv(rows: DataFrame, folder: str, files: int | None = None) -> str:
    """A query's rows as CSV with a header; columns that CSV can't hold are written as JSON."""
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in rows.schema.fields]
    out = rows.select(*flat)
    (out if files is None else out.coalesce(files)).write.mode("overwrite").option("header", "true").csv(folder)
    return folder


def export_table(c: Catalog, name: str, path: str, compression: str = "snappy", basename: str | None = None) -> str:
    """One table as a folder named basename (its own name by default) below path."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"unknown compression {compression!r}")
    (name,) = allowed_tables([name])
    out = f"{path}/{basename or name}"
    c[name].write.mode("overwrite").option("compression", compression).parquet(out)
    return out


def output_path(folder: str, name: str | None, kind: str | None) -> str:
    """Where write_json_files() puts a problem."""
    kind = (kind or "unknown").lower()
    return f"{folder}/{kind}/{safe_name(name or 'problem')}.{kind}.json"


def backup(c: Catalog, problem_id: int, folder: str) -> str:
    """A problem as a JSON file named by the time."""
    row = queries.export_problem(c, problem_id)
    out = Path(folder) / f"{safe_name(row['name'])}_{dt.datetime.now():%Y%m%d_%H%M%S}.json"
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(json.dumps(row, indent=2, default=str))
    return str(out)
