"""Continuous ingestion: new instance files upserted by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayframe.operators import catalog as cat
from wayframe.operators.validate import validate
from wayframe.sources import files, instances

RAW = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, root: str, pattern: str = "*.{tsp,vrp,atsp,hcp,sop}") -> DataFrame:
    return spark.readStream.schema(RAW).format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)


def ingest_stream(spark: SparkSession, root: str, store: str, checkpoint: str) -> StreamingQuery:
    """Each batch of new files becomes a new snapshot of the catalog in store.

    The checkpoint remembers which files were read. A batch that runs again
    upserts the same rows under the same ids, so the state is as after one run.
    Failures of a batch are one folder of store/failures, written whole each time.
    """

    def step(batch: DataFrame, number: int) -> None:
        checked = validate(instances.parse(files.texts(batch)))
        after, failed = cat.ingest(cat.load(spark, store), checked)
        cat.save(after, store)
        failed.write.mode("overwrite").parquet(f"{store}/failures/batch={number}")

    return stream_files(spark, root).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
