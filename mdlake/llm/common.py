"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, the only ones that the operators treat as space.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that go to Python in one batch.
BATCH_ROWS = 1000
#: Rows up to which a written table is broadcast; the tables that use it have at most some 100 bytes a row.
BROADCAST_ROWS = 1 << 17


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one is set only on one machine and where none is named."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="mdlake-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def park(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within_bound(parked: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to be sent to every executor."""
    return parked.count() <= rows


def bounded(parked: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, to be broadcast if it has at most `rows` rows; joins shuffle to it otherwise."""
    return F.broadcast(parked) if within_bound(parked, rows) else parked


def text_batches(df: DataFrame) -> DataFrame:
    """df; whole texts go to Python BATCH_ROWS at a time, unless the session says otherwise."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def strip_space(column: Column) -> Column:
    """Delete every ASCII white-space character."""
    return F.translate(column, SPACES, "")
