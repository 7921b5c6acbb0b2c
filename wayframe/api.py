"""The short way in: one file or one folder, without a catalog of one's own."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession

from wayframe.operators import catalog as cat
from wayframe.operators import queries, sinks
from wayframe.operators.validate import validate
from wayframe.schemas import NotFoundError, OutputError, raise_first
from wayframe.session import local_session
from wayframe.sources import files, instances


def _checked(spark: SparkSession, path: str):
    where = Path(path)
    if not where.is_file():
        raise NotFoundError(f"no file {path}")
    raw = files.scan_files(spark, str(where.parent), patterns=(where.name,), recursive=False)
    return validate(instances.parse(files.texts(raw)))


def parse_file(path: str, spark: SparkSession | None = None) -> dict:
    """A file's parsed instance as plain values; its first error is raised."""
    row = _checked(spark or local_session(), path).first().asDict(recursive=True)
    raise_first(row.pop("errors"))
    return row


def to_json(path: str, output: str | None = None, spark: SparkSession | None = None) -> str:
    """A file's JSON document, written to output where that is named."""
    checked = _checked(spark or local_session(), path)
    raise_first(checked.first().errors)
    text = json.dumps(json.loads(sinks.json_documents(checked).first().value), indent=2)
    if output:
        try:
            Path(output).parent.mkdir(parents=True, exist_ok=True)
            Path(output).write_text(text)
        except OSError as e:
            raise OutputError(str(e)) from e
    return text


def to_database(path: str, store: str, spark: SparkSession | None = None) -> int:
    """Store one file in the catalog below store; its problem's id."""
    spark = spark or local_session()
    checked = _checked(spark, path).persist()
    raise_first(checked.first().errors)
    after, failed = cat.ingest(cat.load(spark, store), checked)
    raise_first([f"{r.error_type}: {r.error}" for r in failed.limit(1).collect()])
    cat.save(after, store)
    return queries.file_info(cat.load(spark, store), checked.first().path)["problem_id"]


def process_directory(root: str, store: str, spark: SparkSession | None = None, **options) -> dict:
    """cli.process() below root: the counts of files and what became of them."""
    from wayframe.cli import process

    return process(spark or local_session(), root, store, **options)
