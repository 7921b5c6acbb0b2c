"""Command line: process, validate, analyze, init, export-parquet, inspect."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, dataclass, fields
from pathlib import Path

from pyspark.sql import functions as F

from wayframe.operators import audit, incremental, queries, sinks
from wayframe.operators import catalog as cat
from wayframe.operators.validate import validate
from wayframe.schemas import COMPRESSIONS, STORABLE_TYPES, TABLES
from wayframe.session import local_session
from wayframe.sources import files, instances


@dataclass
class Config:
    input_path: str = "datasets"
    output_path: str = "out"
    store: str = "out/catalog"
    compression: str = "snappy"
    cores: str = "*"


def load_config(path: str) -> Config:
    import yaml

    known = {f.name for f in fields(Config)}
    found = yaml.safe_load(Path(path).read_text()) or {}
    return Config(**{k: v for k, v in found.items() if k in known})


def save_config(config: Config, path: str) -> None:
    import yaml

    Path(path).write_text(yaml.safe_dump(asdict(config), sort_keys=False))


def process(spark, root: str, store: str, types: list[str] | None = None, force: bool = False, json_folder: str | None = None) -> dict:
    """Read what changed below root, upsert it, and return the counts."""
    current = cat.load(spark, store)
    raw = files.texts(files.corpus_files(spark, root, types))
    # Contents are read twice: once for their checksums, and those that changed once more to be parsed.
    changes = incremental.detect_changes(raw.select("path", "checksum"), current["file_tracking"]).persist()
    todo = raw.join(incremental.to_process(changes, force).select("path"), "path", "left_semi")
    checked = validate(instances.parse(todo)).persist()
    try:
        counts = {r.status: r.files for r in incremental.change_counts(changes).collect()}
        total = checked.count()
        if total:
            after, failed = cat.ingest(current, checked)
            bad = failed.select("path").distinct().count()
            cat.save(after, store)
            failed.write.mode("append").parquet(f"{store}/failures")
            if json_folder:
                sinks.write_json(checked.where("size(errors) = 0"), json_folder)
        else:
            bad = 0
    finally:
        checked.unpersist()
        changes.unpersist()
    return {**counts, "processed": total, "failed": bad, "successful": total - bad}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wayframe")
    p.add_argument("--cores", default="*")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("process")
    a.add_argument("root")
    a.add_argument("store")
    a.add_argument("--types", nargs="*")
    a.add_argument("--force", action="store_true")
    a.add_argument("--json")
    a = sub.add_parser("validate")
    a.add_argument("store")
    a = sub.add_parser("analyze")
    a.add_argument("store")
    a.add_argument("--type", choices=sorted(STORABLE_TYPES))
    a.add_argument("--limit", type=int, default=100)
    a.add_argument("--json", action="store_true")
    a = sub.add_parser("init")
    a.add_argument("path")
    a = sub.add_parser("export-parquet")
    a.add_argument("store")
    a.add_argument("folder")
    a.add_argument("--tables", nargs="*")
    a.add_argument("--compression", choices=COMPRESSIONS, default="snappy")
    a = sub.add_parser("inspect")
    a.add_argument("store")
    a.add_argument("--table", choices=TABLES)
    args = p.parse_args(argv)
    if args.command == "init":
        save_config(Config(), args.path)
        return 0
    spark = local_session(args.cores)
    if args.command == "process":
        print(json.dumps(process(spark, args.root, args.store, args.types, args.force, args.json)))
        return 0
    c = cat.load(spark, args.store)
    if args.command == "validate":
        found = False
        for r in audit.integrity_failures(c).toLocalIterator():  # a partition at a time
            found = True
            print(f"{r.check}\t{r.problem_id}\t{r.detail}")
        return int(found)
    if args.command == "analyze":
        df = queries.query_problems(c, args.type, limit=args.limit)
        print("\n".join(df.toJSON().collect())) if args.json else df.show(args.limit, truncate=False)
        if not args.json:
            queries.problem_stats(c).show(truncate=False)
    elif args.command == "export-parquet":
        print(json.dumps(sinks.export_parquet(c, args.folder, args.tables, args.compression)))
    else:
        for name in sorted([args.table] if args.table else TABLES):
            print(f"{name}: {c[name].count()} rows")
            if args.table:
                c[name].printSchema()
                c[name].select(*(F.col(x) for x in c[name].columns)).show(5)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
