"""Catalog readers: one partitioned Parquet directory for each family."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


_EVENT = "ts_event_ns bigint, ts_init_ns bigint, seq bigint, instrument_id string, seal_date date"

#: Column lists by family; payload columns that only this library names are those of trades, deltas, bars and states.
SCHEMAS = {
    "quotes": "bid_price decimal(28,10), ask_price decimal(28,10), bid_size decimal(28,10), ask_size decimal(28,10), " + _EVENT,
    "trades": "price decimal(28,10), size decimal(28,10), side string, " + _EVENT,
    "order_book_deltas": "action string, side string, price decimal(28,10), size decimal(28,10), " + _EVENT,
    "bars": "bar_type string, open decimal(28,10), high decimal(28,10), low decimal(28,10), close decimal(28,10), volume decimal(28,10), " + _EVENT,
    "mark_prices": "value decimal(28,10), " + _EVENT,
    "index_prices": "value decimal(28,10), " + _EVENT,
    "funding_rate_update": "rate decimal(28,10), " + _EVENT,
    "option_greeks": "convention string, delta double, gamma double, vega double, theta double, rho double, mark_iv double, bid_iv double, ask_iv double, underlying_price double, open_interest double, " + _EVENT,
    "instrument_status": "state string, " + _EVENT,
    "instrument_closes": "state string, " + _EVENT,
    "instruments": "class string, underlying string, settlement_currency string, strike decimal(28,10), kind string, activation_ns bigint, expiration_ns bigint, " + _EVENT,
}
# Directory names that stand for one family, preferred one first.
ALIASES = {"bars": ("bars", "bar"), "order_book_deltas": ("order_book_deltas", "book_deltas"), "funding_rate_update": ("funding_rate_update", "funding_rates")}

#: Registered custom types and their columns, without the event columns.
CUSTOM_SCHEMAS = {
    "HyperliquidOpenInterest": "open_interest double",
    "DeribitVolatilityIndex": "value double, index_name string",
    "DeribitBookSummary": "currency string, kind string, mark_iv double, open_interest double, underlying_price double",
}


def family_dirs(family: str) -> tuple[str, ...]:
    return ALIASES.get(family, (family,))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def resolve_family_dir(spark: SparkSession, root: str, family: str) -> str | None:
    """The first existing directory among a family's names, even if another has more rows."""
    return next((f"{root}/{d}" for d in family_dirs(family) if _exists(spark, f"{root}/{d}")), None)


def _read(spark: SparkSession, path: str | None, schema: str, ids: list[str] | None, start_ns: int | None, end_ns: int | None) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    if ids is not None:
        df = df.filter(F.col("instrument_id").isin(ids))
    if start_ns is not None:
        df = df.filter(F.col("ts_init_ns") >= start_ns)
    if end_ns is not None:
        df = df.filter(F.col("ts_init_ns") <= end_ns)
    return df


def read_family(spark: SparkSession, root: str, family: str, ids: list[str] | None = None, start_ns: int | None = None, end_ns: int | None = None, schema: str | None = None) -> DataFrame:
    """Sealed rows of a family; ids prune partitions, times reach the Parquet statistics. Open parts are not read."""
    return _read(spark, resolve_family_dir(spark, root, family), schema or SCHEMAS[family], ids, start_ns, end_ns)


def read_custom(spark: SparkSession, root: str, type_name: str, ids: list[str] | None = None) -> DataFrame:
    """Rows of a custom type; without ids those of the whole market."""
    path = f"{root}/custom/{type_name}"
    return _read(spark, path if _exists(spark, path) else None, f"{CUSTOM_SCHEMAS[type_name]}, {_EVENT}", ids, None, None)


def latest_definitions(instruments: DataFrame) -> DataFrame:
    """The last definition of each instrument."""
    row = F.struct(*instruments.columns)
    return instruments.groupBy("instrument_id").agg(F.max_by(row, F.struct("ts_init_ns", "seq")).alias("r")).select("r.*")


def read_instruments(spark: SparkSession, root: str, ids: list[str] | None = None) -> DataFrame:
    return latest_definitions(read_family(spark, root, "instruments", ids))


def read_forward_prices(spark: SparkSession, path: str) -> DataFrame:
    schema = "instrument_id string, forward_price string, underlying_index string, ts_event_ns bigint, ts_init_ns bigint, source string"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listing documents, one a file: snapshot_id (the path), payload."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("snapshot_id"), F.col("value").alias("payload"))


@contextmanager
def _aggregating(spark: SparkSession) -> Iterator[None]:
    """Parquet frames made inside are of the second data source version, which answers aggregates from footers (see SETTINGS)."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, "")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_PLACED = "ts_init_ns bigint, instrument_id string, seal_date date"


def read_footers(spark: SparkSession, root: str, family: str) -> DataFrame:
    """(family, instrument_id, seal_date, rows, min_ts_ns, max_ts_ns) of a family's sealed files, from their footers alone.

    Footers are read by the place of a column, so a family's files must have their columns in one order, as the writers
    of this library give them; the schema is that of a file.
    """
    path = resolve_family_dir(spark, root, family)
    if path is None:
        return spark.createDataFrame([], "family string, instrument_id string, seal_date date, rows bigint, min_ts_ns bigint, max_ts_ns bigint")
    with _aggregating(spark):
        files = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    files = files.withColumns({"instrument_id": F.col("instrument_id").cast("string"), "seal_date": F.col("seal_date").cast("date")})
    found = files.groupBy("instrument_id", "seal_date").agg(F.count(F.lit(1)).alias("rows"), F.min("ts_init_ns").alias("min_ts_ns"), F.max("ts_init_ns").alias("max_ts_ns"))
    return found.select(F.lit(family).alias("family"), "*")


def file_sizes(spark: SparkSession, root: str, family: str) -> DataFrame:
    """(family, instrument_id, seal_date, path, bytes, rows) of each sealed file; no column is read."""
    path = resolve_family_dir(spark, root, family)
    if path is None:
        return spark.createDataFrame([], "family string, instrument_id string, seal_date date, path string, bytes bigint, rows bigint")
    files = spark.read.schema(_PLACED).option("pathGlobFilter", "*.parquet").parquet(path)
    by_file = files.groupBy("instrument_id", "seal_date", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
    return by_file.select(F.lit(family).alias("family"), "instrument_id", "seal_date", "path", "bytes", "rows")


def partition_manifest(spark: SparkSession, root: str, families: list[str]) -> DataFrame:
    """(family, instrument_id, seal_date, files, bytes, rows, min_ts_ns, max_ts_ns) of every sealed partition, without its columns."""
    keys = ["family", "instrument_id", "seal_date"]
    sizes = reduce(DataFrame.union, [file_sizes(spark, root, f) for f in families]).groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return sizes.join(reduce(DataFrame.union, [read_footers(spark, root, f) for f in families]), keys)


def count_rows(spark: SparkSession, root: str, families: list[str]) -> DataFrame:
    """(family, instrument_id, rows) of every sealed file, by footers; the first existing name of a family is taken."""
    found = reduce(DataFrame.union, [read_footers(spark, root, f) for f in families])
    return found.groupBy("family", "instrument_id").agg(F.sum("rows").alias("rows"))


def list_families(spark: SparkSession, root: str) -> DataFrame:
    """(family, instrument_id) present in the catalog, by the names of its partitions."""
    there = [(f, p) for f in SCHEMAS if (p := resolve_family_dir(spark, root, f))]
    parts = [spark.read.schema("instrument_id string, seal_date date").option("pathGlobFilter", "*.parquet").parquet(p).select(F.lit(f).alias("family"), "instrument_id").distinct() for f, p in there]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], "family string, instrument_id string")


def _without(spark: SparkSession, schema: str, *names: str) -> StructType:
    return StructType([f for f in spark.createDataFrame([], schema).schema if f.name not in names])


def stream_family(spark: SparkSession, path: str, family: str, files_per_trigger: int = 100) -> DataFrame:
    """A family's landed files as a stream."""
    return spark.readStream.schema(_without(spark, SCHEMAS[family], "seal_date")).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_snapshots(spark: SparkSession, path: str, type_name: str) -> DataFrame:
    """Landed poll responses (JSON documents with an array `rows`) of a custom type as a stream of rows."""
    rows = _without(spark, f"{CUSTOM_SCHEMAS[type_name]}, {_EVENT}", "seal_date")
    schema = StructType([StructField("identifier", StringType()), StructField("rows", ArrayType(rows))])
    return spark.readStream.schema(schema).json(path).select("identifier", F.inline("rows"))


def uint64(column: str | Column) -> Column:
    """Parquet's unsigned longs arrive as decimal(20,0)."""
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")
