"""File listings and raw text."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.schemas import EXTENSION_HINTS

PATTERNS = ("*.tsp", "*.vrp", "*.atsp", "*.hcp", "*.sop", "*.tour")
EXCLUDED = ("/mdvrp/", "/mdvrp-converted/")


def scan_files(spark: SparkSession, *roots: str, patterns: tuple[str, ...] = PATTERNS, recursive: bool = True, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(path, modificationTime, length, content) of matching files, each once; roots that don't exist give none."""
    there = sorted({r.rstrip("/") for r in roots if "://" in r or Path(r).exists()})
    if recursive:  # a root below another one is read with it
        there = [r for r in there if not any(r.startswith(f"{o}/") for o in there)]
    glob = patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}"
    if not there:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(there)
    for part in exclude:
        found = found.where(~F.col("path").contains(part))
    return found


def corpus_files(spark: SparkSession, root: str, types: list[str] | None = None) -> DataFrame:
    """A root and its sibling cvrplib, without multi-depot folders; types narrows the extensions."""
    patterns = tuple(f"*.{t.lower()}" for t in types) if types else PATTERNS
    return scan_files(spark, root, str(Path(root).parent / "cvrplib"), patterns=patterns, exclude=EXCLUDED)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def file_info(files: DataFrame) -> DataFrame:
    """path, name, extension, size, problem_type (by extension, UNKNOWN otherwise), directory."""
    hint = F.lit("UNKNOWN")
    for ext, kind in EXTENSION_HINTS.items():
        hint = F.when(extension(F.col("path")) == ext, kind).otherwise(hint)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        extension(F.col("path")).alias("extension"),
        F.col("length").alias("size"),
        hint.alias("problem_type"),
        F.element_at(F.split("path", "/"), -2).alias("directory"),
    )


def file_count(spark: SparkSession, root: str, patterns: tuple[str, ...] = PATTERNS) -> int:
    return scan_files(spark, root, patterns=patterns).select("path").count()


def decoded(content: Column) -> Column:
    """UTF-8 if the bytes are, else Latin-1."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def texts(files: DataFrame) -> DataFrame:
    """(path, text, checksum, file_size)."""
    return files.select("path", decoded(F.col("content")).alias("text"), F.sha2("content", 256).alias("checksum"), F.col("length").alias("file_size"))


def stem(path: Column) -> Column:
    """The file name without .opt.tour or its last extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(F.regexp_replace(name, r"\.opt\.tour$", ""), r"(?<=.)\.[^.]*$", "")


def candidate_solutions(files: DataFrame) -> DataFrame:
    """(problem_path, solution_path): the .sol beside an instance; for .tsp and .hcp also ../tour/<stem>.opt.tour.

    Both are equi-joins on derived paths of the listing with itself.
    """
    at = files.select("path", F.regexp_replace("path", r"/[^/]*$", "").alias("dir"), stem(F.col("path")).alias("stem"), extension(F.col("path")).alias("ext"))
    problems = at.where(F.col("ext").isin(".tsp", ".atsp", ".sop", ".hcp", ".vrp"))
    beside = problems.select(F.col("path").alias("problem_path"), F.concat_ws("/", "dir", F.concat("stem", F.lit(".sol"))).alias("path"))
    above = F.concat(F.regexp_replace("dir", r"/[^/]*$", ""), F.lit("/tour/"), F.col("stem"), F.lit(".opt.tour"))
    tours = problems.where(F.col("ext").isin(".tsp", ".hcp")).select(F.col("path").alias("problem_path"), above.alias("path"))
    return beside.union(tours).join(files.select("path"), "path").select("problem_path", F.col("path").alias("solution_path"))


def safe_name(name: str, fallback: str = "problem") -> str:
    """A file name of letters, digits, dot, underscore and dash."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", re.split(r"[/\\]", name)[-1]).strip("._-") or fallback
