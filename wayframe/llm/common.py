"""What the operators share: tables in the shared folder, text chunks, graph components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.session import ship

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key with more rows than this, or than a 50,000th of all rows, isn't left to one task in spread_join().
HEAVY, MOST_HEAVY = 128, 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own where that is unset, in local mode alone."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if sc.applicationId not in _OWN:
        made = tempfile.TemporaryDirectory(prefix="wayframe-shared-")
        atexit.register(made.cleanup)
        _OWN[sc.applicationId] = f"file://{made.name}"
    return _OWN[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wayframe/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut the lineage: write a table in the shared folder and read it again. The shuffles that made it are removed."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, by: str, total: int | None = None) -> DataFrame:
    """rows joined with groups, which has one row a key and, in count, how many rows have it (count goes).

    A key with many rows is split by the hash of the column `by`: its row of
    groups is repeated, once for every HEAVY rows. Only the heavy keys and their
    numbers of parts are broadcast: at most MOST_HEAVY, as each has more than a
    MOST_HEAVY-th of all rows (total, where it is known). groups is read more than
    once and should be a table or cheap; keys that are null find nothing.
    """
    total = (groups.agg(F.sum(count)).first()[0] or 0) if total is None else total
    least = max(HEAVY, total // MOST_HEAVY)
    parts = F.ceil(F.col(count) / least).cast("int")
    heavy = groups.where(F.col(count) > least).select(*keys, parts.alias("_parts"))
    salted = rows.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(by), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    each = F.sequence(F.lit(0), F.when(F.col(count) > least, parts - 1).otherwise(0))
    return salted.join(groups.withColumn("_salt", F.explode(each)).drop(count), [*keys, "_salt"]).drop("_salt")


def drop_path(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def text_rows(batch: pa.RecordBatch, text: str, limit: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null: empty), each of about limit characters."""
    start = 0
    col = batch.column(batch.schema.get_field_index(text))
    sizes = [0 if n is None else n for n in pa.compute.binary_length(col).to_pylist()]
    while start < len(sizes):
        end, size = start, 0
        while end < len(sizes) and (end == start or size + sizes[end] <= limit):
            size += sizes[end] + 64
            end += 1
        part = batch.slice(start, end - start)
        yield part, [t or "" for t in part.column(batch.schema.get_field_index(text)).to_pylist()]
        start = end


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links between longs: (node, component = smallest id reachable).

    Alternating large-star and small-star steps until nothing changes, each one
    aggregation and one join in which a hub with any number of neighbours isn't
    one task's. Every step is written to the shared folder. Nodes without links
    aren't returned; null ends and self links are ignored.
    """
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
    edges, old = materialize(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "links"
    )
    drop = lambda *paths: drop_path(links.sparkSession, *paths)
    state = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    now, before = state(), None
    while now != before and now[0]:
        # Large star: every larger neighbour of u goes to the smallest of u and its neighbours.
        low = both(edges).groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")).where("n > 0")
        larger = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        large = spread_join(larger, low, ["u"], "n", "v", now[0]).select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()
        large, large_path = materialize(large, "large")
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = (
            spread_join(large, low, ["a"], "n", "b", now[0])
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges, path = materialize(small, "small")
        drop(old, large_path)
        old, before, now = path, now, state()
    out = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return out.select(F.col("a").alias("node"), "component").union(roots)
