"""Capture as Structured Streaming: one query for each family appends to a staging area, a batch job seals it.

Every micro-batch is a commit of its own, in folders named by the query's id (which its checkpoint keeps) and the batch,
so that several captures of a family, and one that starts again from a new checkpoint, never meet in a folder. Rows that
can't be placed, or whose values don't fit the family's columns, go to a dead-letter table with the reason and don't
stop the stream. Errors of the storage are the stream's: it stops and tries the batch again when it is started.
Late and unordered rows are never dropped: they are sealed by arrival.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mdlake.operators.asof import gate_on_definition
from mdlake.operators.sealing import due_date, exists, folder_of, remove, seal, stage
from mdlake.operators.sink import forward_prices, quarantined, with_seal_date
from mdlake.sources.catalog import SCHEMAS

#: What the gate reads of definitions.
_DEFINED = "instrument_id string, ts_init_ns bigint"

#: Java classes that stand for the storage or the cluster, not for a row.
_TRANSIENT = ("java.io.", "java.net.", "org.apache.hadoop.", "java.util.concurrent.", "FetchFailed", "ExecutorLost")


def _transient(error: Exception) -> bool:
    """Whether an error says nothing about rows: trying the same batch again may do."""
    if isinstance(error, (OSError, Py4JNetworkError)):
        return True
    cause, found = getattr(error, "java_exception", None), ""
    while cause is not None:
        found, cause = f"{found} {cause.getClass().getName()}", cause.getCause()
    return any(name in found for name in _TRANSIENT) and "SparkArithmeticException" not in found


def fitted(batch: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows as the schema's columns, and as text those of which a value doesn't fit its column, with the reason.

    Columns that the batch lacks are null; columns that the schema lacks are left out.
    """
    wanted = [f for f in batch.sparkSession.createDataFrame([], schema).schema.fields if f.name in batch.columns]
    tried = batch.select("*", F.struct(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted]).alias("__as"))
    wrong = F.array_compact(F.array(*[F.when(F.col(f.name).isNotNull() & F.col(f"__as.{f.name}").isNull(), F.lit(f.name)) for f in wanted]))
    tried = tried.withColumn("__wrong", wrong)
    good = tried.filter(F.size("__wrong") == 0).select("__as.*")
    bad = tried.filter(F.size("__wrong") > 0).select(F.to_json(F.struct(*batch.columns)).alias("row"), F.concat(F.lit("does not fit: "), F.array_join("__wrong", ", ")).alias("error"))
    return good, bad


def _refuse(rows: DataFrame, path: str, error: str) -> None:
    rows.select(F.to_json(F.struct("*")).alias("row"), F.lit(error[:1000]).alias("error")).write.mode("append").parquet(path)


def _stage_some(rows: DataFrame, staging: str, refused: str, batch_id: int, query: str) -> None:
    """Stage rows; where that fails for a reason of theirs, halves of them are tried, until the row is found and refused.

    The rows are written first and numbered, so that halves are the same rows each time. What was found good is staged
    as one batch.
    """
    try:
        stage(rows, staging, batch_id, query)
        return
    except Exception as error:  # noqa: BLE001
        if _transient(error):
            raise
        cause = str(error)
    spark = rows.sparkSession
    scratch = f"{refused}-tried"
    remove(spark, refused)
    rows.withColumn("__at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{scratch}/rows")
    held = spark.read.parquet(f"{scratch}/rows")
    ids = lambda low, high: held.filter((F.col("__at") >= low) & (F.col("__at") < high))
    first, last, n = held.agg(F.min("__at"), F.max("__at"), F.count(F.lit(1))).first()
    bad, open_ = [], [(first, last + 1, n, cause)] if n else []
    while open_:
        low, high, n, cause = open_.pop()
        if n == 1:
            _refuse(ids(low, high).drop("__at"), refused, cause)
            bad.append((low, high))
            continue
        middle = (low + high) // 2
        for a, b in ((low, middle), (middle, high)):
            if not (count := ids(a, b).count()):
                continue
            try:
                stage(ids(a, b).drop("__at"), f"{scratch}/probe", batch_id, query)
            except Exception as error:  # noqa: BLE001
                if _transient(error):
                    raise
                open_.append((a, b, count, str(error)))
    good = held
    for low, high in bad:
        good = good.filter((F.col("__at") < low) | (F.col("__at") >= high))
    remove(spark, folder_of(staging, batch_id, query))
    if len(bad) < held.count():
        stage(good.drop("__at"), staging, batch_id, query)
    remove(spark, scratch)


def _stage_batch(batch: DataFrame, root: str, family: str, batch_id: int, query: str, schema: str | None = None) -> None:
    """Good rows to the staging area, others to quarantine, in folders named by query and batch.

    A batch that is tried again replaces its own files. Rows that fit no column, or that the writer refuses, go to
    `_refused` as text with the error; rows without an id or time to `_quarantine`.
    """
    place = f"{family}/query={query}/batch={batch_id}"
    refused = f"{root}/_refused/{place}"
    remove(batch.sparkSession, refused)
    if schema:
        batch, unfit = fitted(batch, schema)
        if unfit.take(1):
            unfit.write.mode("overwrite").parquet(f"{refused}/unfit")
    good, bad = quarantined(batch)
    _stage_some(with_seal_date(good).drop("seal_end_ns"), f"{root}/_staging/{family}", f"{refused}/refused", batch_id, query)
    bad.write.mode("overwrite").parquet(f"{root}/_quarantine/{place}")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that a checkpoint belongs to; it is there before the first batch."""
    return json.loads("".join(r[0] for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]


def start_capture(stream: DataFrame, root: str, family: str, checkpoint: str, seconds: float | None = None, schema: str | None = None, definitions: str | None = None) -> StreamingQuery:
    """Append a stream to the family's staging area; without `seconds` it takes what is there and ends.

    schema: columns that values are held to; definitions: a path of instrument definitions, read anew at each batch, whose
    instruments alone are captured, from the time on at which their first definition had arrived.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known[:] = known or [query_id(spark, checkpoint)]
        if definitions:
            batch = gate_on_definition(batch, spark.read.schema(_DEFINED).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(definitions))
        _stage_batch(batch, root, family, batch_id, known[0], schema)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def drain(spark: SparkSession, root: str, family: str, now_ns: int | None = None, schema: str | None = None) -> int:
    """Seal the windows that have ended by now; all that was captured without a time."""
    until = due_date(now_ns) if now_ns is not None else None
    return seal(spark, root, family, schema or SCHEMAS[family], f"{root}/_staging/{family}", until)


def seal_due(manifest: DataFrame, now_ns: int) -> DataFrame:
    """Partitions whose window has ended by now. manifest: instrument_id, seal_end_ns."""
    return manifest.filter(F.col("seal_end_ns") <= now_ns).select("instrument_id", "seal_end_ns").distinct()


def gate_stream(stream: DataFrame, definitions: DataFrame) -> DataFrame:
    """Events after their instrument's first definition had arrived, by a join with the static definitions."""
    ready = definitions.groupBy("instrument_id").agg(F.min("ts_init_ns").alias("__ready"))
    return stream.join(ready, "instrument_id").filter("ts_init_ns >= __ready").drop("__ready")


def forward_price_stream(greeks: DataFrame) -> DataFrame:
    """A forward price for each greek that has one; no state."""
    return forward_prices(greeks)


def frozen_schema(spark: SparkSession, root: str, type_name: str) -> str | None:
    """The columns that a custom type's first batch had, as it left them beside the data."""
    path = f"{root}/_schemas/custom/{type_name}"
    return spark.read.text(path).first()[0] if exists(spark, path) else None


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def write_custom_stream(stream: DataFrame, root: str, type_name: str, schema: str | None, checkpoint: str) -> StreamingQuery:
    """Stage custom rows, to be sealed by drain(). The first batch with rows freezes the type's columns.

    Later batches and streams are held to them: rows of other columns are kept as text in `_refused`. A schema that is
    given must be the stream's. Batches are replaced when they are tried again, rows without an id or time go to quarantine.
    """
    given = stream.sparkSession.createDataFrame([], schema).schema if schema else None
    named = lambda fields: {(f.name, f.dataType.simpleString()) for f in fields}
    if given is not None and named(given) != named(stream.schema):
        raise ValueError(f"{type_name} has another schema than its first batch")
    family, known = f"custom/{type_name}", []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known[:] = known or [query_id(spark, checkpoint)]
        frozen = frozen_schema(spark, root, type_name)
        if frozen is None and batch.take(1):
            frozen = _columns(batch.schema)
            spark.createDataFrame([(frozen,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/_schemas/custom/{type_name}")
        if frozen and named(spark.createDataFrame([], frozen).schema) != named(batch.schema):
            refused = f"{root}/_refused/{family}/query={known[0]}/batch={batch_id}"
            remove(spark, refused)
            _refuse(batch, f"{refused}/refused", f"{type_name} has other columns: {_columns(batch.schema)}")
            return
        _stage_batch(batch, root, family, batch_id, known[0])

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_forward_prices(greeks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the forward price of each greek that has one to a log of JSON lines, once each."""
    return forward_price_stream(greeks).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
