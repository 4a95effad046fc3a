"""Batch folders as a file stream: each new folder is one operating day and one load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumbung.fixed_values import TRANSACTION_FILE
from lumbung.plans.load import load_batch, refresh_cube
from lumbung.sources.warehouse import Warehouse

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def load_available(spark: SparkSession, landing: str, root: str, checkpoint: str) -> StreamingQuery:
    """Load every batch folder under ``landing`` that has not been loaded yet, then stop.

    The stream only lists transaction files (their content is not read by it);
    a micro-batch names the folders that are new, and each is loaded as a batch
    of its own, in name order, so that each sees the mark its predecessor left.
    The cube is brought up to date afterwards.
    Folder names are the batch ids: a micro-batch that is replayed after a
    failure loads the same batches again and changes nothing.
    """

    def load(arrived: DataFrame, _epoch: int) -> None:
        # One name per operating day.
        names = arrived.select(
            F.regexp_extract("path", rf"/([^/]+)/{TRANSACTION_FILE}(/[^/]*)?$", 1).alias("batch")
        )
        for row in names.distinct().orderBy("batch").collect():
            load_batch(arrived.sparkSession, f"{landing}/{row.batch}", root, row.batch)
        refresh_cube(Warehouse(arrived.sparkSession, root))

    arrivals = (
        spark.readStream.format("binaryFile").schema(_FILE).load(f"{landing}/*/{TRANSACTION_FILE}").select("path")
    )
    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
