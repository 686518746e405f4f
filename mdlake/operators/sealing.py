"""Sealing of staged rows into daily partitions, and recovery of what a crash left.

A staging area holds folders query=<id>/batch=<id>/seal_date=<date>. The query is the stream's own id, which lives in
its checkpoint, so captures that number their batches alike, or a stream that starts again from nothing, stay apart.
Sealing moves the folders whose window has ended; later windows are not read and sealed partitions that get no row are
not touched. It goes in steps that can each be repeated:

1. One pass over the due folders gives rows and a checksum of each. Folders that the ledger holds with the same rows and
   checksum are replays and are dropped; a known batch with other rows is sealed like a new one. The rest is the plan.
2. Partitions that are sealed already and get late rows are written beside the plan, old and new rows together.
3. Rows overwrite just their partitions, as sorted, complete files: late partitions from the plan, others straight
   from staging. Ranges of (instrument, date, time) keep tasks at TARGET_ROWS rows, so a busy day is several files.
4. The ledger, a table by date, gets the folders; a mark ends the plan; folders and plan are removed.

A run that was cut short leaves a plan, which the next one carries out first: up to the mark from step 3 on, after it
only the removal. Equal rows are different events and all stay.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = ("instrument_id", "seal_date")
#: What names a staged folder.
FOLDER = ("query", "batch", "seal_date")
_LEDGER = "query string, batch string, seal_date string, rows bigint, checksum decimal(38,0), run string"
#: Rows that a task sorts and writes, and partitions that it writes to, about.
TARGET_ROWS, TARGET_PARTITIONS = 2_000_000, 64
_MARK = b"PAR1"
#: Parts up to this length are looked into when they give no rows; a larger one without rows has no footer.
_SMALL = 1 << 20


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = file_system(spark, path)
    fs.delete(hadoop, True)


def folder_of(staging: str, batch: int | str, query: str = "batch") -> str:
    return f"{staging}/query={query}/batch={batch}"


def stage(df: DataFrame, staging: str, batch: int | str, query: str = "batch") -> None:
    """Write dated rows as one batch of a query; a batch that is written again before it is sealed replaces itself."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("seal_date").parquet(folder_of(staging, batch, query))


def _staged(spark: SparkSession, staging: str, schema: str = "") -> DataFrame:
    """Staged rows with the names of their folders as text."""
    columns = [f for f in spark.createDataFrame([], schema).schema.fields if f.name not in FOLDER] if schema else []
    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), *(f"{c} string" for c in FOLDER)])
    if not exists(spark, staging):
        return spark.createDataFrame([], types)
    return spark.read.schema(types).option("pathGlobFilter", "*.parquet").parquet(staging)


def staged_windows(spark: SparkSession, staging: str) -> list[tuple[str, str]]:
    """(batch, date) of all staged folders that hold rows; no column is read."""
    return sorted(tuple(r) for r in _staged(spark, staging).select("batch", "seal_date").distinct().collect())


def ledger(spark: SparkSession, root: str, family: str) -> DataFrame:
    """The sealed folders of a family: query, batch, seal_date (which prunes files), rows, checksum, run."""
    path = f"{root}/_sealed/{family}"
    return spark.read.schema(_LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], _LEDGER)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seal(spark: SparkSession, root: str, family: str, schema: str, staging: str, until: str | None = None) -> int:
    """Seal the staged windows up to the date `until`, all without it; the number of folders that were sealed."""
    plan = f"{root}/_sealing/{family}"
    done = _finish(spark, root, family, schema, staging)
    rows = _staged(spark, staging, schema)
    if until is not None:
        rows = rows.filter(F.col("seal_date") <= until)
    checksum = F.sum(F.xxhash64(*[c for c in rows.columns if c not in FOLDER]).cast("decimal(28,0)")).cast("decimal(38,0)").alias("checksum")
    instruments = F.hll_sketch_agg("instrument_id").alias("instruments")
    found = _written(rows.groupBy(*FOLDER).agg(F.count(F.lit(1)).alias("rows"), checksum, instruments), f"{plan}/found")
    dates = [r[0] for r in found.select("seal_date").distinct().collect()]
    if not dates:
        remove(spark, plan)
        return done
    same = [*FOLDER, "rows", "checksum"]
    known = ledger(spark, root, family).filter(F.col("seal_date").isin(dates)).select(*same).distinct()
    _drop_folders(spark, staging, found.join(known, same, "left_semi").select(*FOLDER).collect())
    fresh = _written(found.join(known, same, "left_anti"), f"{plan}/folders")
    if not fresh.take(1):
        remove(spark, plan)
        return done
    target = f"{root}/{family}"
    names = spark.createDataFrame([], schema).columns
    late = spark.createDataFrame([], schema)
    if exists(spark, target):
        there = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(target).filter(F.col("seal_date").cast("string").isin(dates))
        new = _typed(rows.join(fresh.select(*FOLDER), list(FOLDER), "left_semi"), schema)
        both = _written(new.select(*PARTITION).distinct().join(there.select(*PARTITION).distinct(), list(PARTITION), "left_semi"), f"{plan}/partitions")
        if both.take(1):
            late = there.join(both, list(PARTITION), "left_semi").unionByName(new.join(both, list(PARTITION), "left_semi"))
    _written(late.select(*names), f"{plan}/late")
    _written(spark.createDataFrame([(uuid.uuid4().hex,)], "run string").coalesce(1), f"{plan}/ready")
    return done + _finish(spark, root, family, schema, staging)


def _drop_folders(spark: SparkSession, staging: str, folders: list) -> None:
    """Remove sealed folders, several at a time; other dates of their batches stay."""
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda r: remove(spark, f"{folder_of(staging, r['batch'], r['query'])}/seal_date={r['seal_date']}"), folders))


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    wanted = rows.sparkSession.createDataFrame([], schema).schema
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def _finish(spark: SparkSession, root: str, family: str, schema: str, staging: str) -> int:
    """Carry out a plan that is ready; one that isn't is dropped by the next."""
    plan, target = f"{root}/_sealing/{family}", f"{root}/{family}"
    if not exists(spark, f"{plan}/ready/_SUCCESS"):
        return 0
    folders = spark.read.parquet(f"{plan}/folders")
    if not exists(spark, f"{plan}/done/_SUCCESS"):
        run = spark.read.parquet(f"{plan}/ready").first()[0]
        late = spark.read.schema(schema).parquet(f"{plan}/late")
        rows = _typed(_staged(spark, staging, schema).join(folders.select(*FOLDER), list(FOLDER), "left_semi"), schema)
        more = late.count()
        if more:
            rows = rows.join(late.select(*PARTITION).distinct(), list(PARTITION), "left_anti").unionByName(late)
        by_date = folders.groupBy("seal_date").agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("instruments")).alias("partitions"))
        size = by_date.agg(F.sum("rows"), F.sum("partitions")).first()
        tasks = max(math.ceil((size[0] + more) / TARGET_ROWS), math.ceil(size[1] / TARGET_PARTITIONS))
        order = [*PARTITION, *(c for c in ("ts_init_ns", "seq") if c in rows.columns)]
        # Partitions are replaced one by one when the job commits; repeating it gives the same files' rows.
        placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(target)
        entries = folders.select("query", "batch", "rows", "checksum", "seal_date", F.lit(run).alias("run"))
        entries.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seal_date", "run").parquet(f"{root}/_sealed/{family}")
        _written(spark.range(1).coalesce(1), f"{plan}/done")
    found = folders.select(*FOLDER).collect()
    _drop_folders(spark, staging, found)
    remove(spark, plan)
    return len(found)


def due_date(now_ns: int, hour: int = 6, minute: int = 0) -> str:
    """The date of the last seal boundary (UTC) that has passed."""
    return datetime.fromtimestamp(now_ns // 1_000_000_000 - hour * 3600 - minute * 60, UTC).strftime("%Y-%m-%d")


def _clock(ns: int) -> str:
    return datetime.fromtimestamp(ns // 1_000_000_000, UTC).strftime("%Y-%m-%dT%H-%M-%S-") + f"{ns % 1_000_000_000:09d}Z"


def open_parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the open parts under a folder, those of no bytes too; there is one for each open partition."""
    fs, hadoop = file_system(spark, folder)
    found, files = [], fs.listFiles(hadoop, True) if fs.exists(hadoop) else None
    while files is not None and files.hasNext():
        status = files.next()
        if status.getPath().getName().endswith(".part"):
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def recover(spark: SparkSession, folder: str, schema: str, active: set[str] | None = None) -> DataFrame:
    """Seal the open parts that a crash left; (path, bytes, rows, state, sealed) of each.

    A readable part becomes a complete file named by its times, in its own folder; where that name is taken a number is
    added. Parts of no bytes or rows are removed, corrupt ones stay where they are, as do those that can't be renamed
    (state "failed"; the others go on). Parts in `active` still have a writer and are passed over.
    """
    parts = {p: n for p, n in open_parts(spark, folder) if p not in (active or set())}
    held = {}
    if any(parts.values()):
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*[p for p, n in parts.items() if n])
        by_file = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.min("ts_init_ns").alias("low"), F.max("ts_init_ns").alias("high"))
        held = {_plain(r["path"]): r for r in by_file.collect()}
    unclear = [p for p, n in parts.items() if 0 < n <= _SMALL and _plain(p) not in held]
    whole = set()
    if unclear:
        tails = spark.read.format("binaryFile").load(unclear).select("path", F.substring("content", -4, 4).alias("tail"))
        whole = {_plain(r["path"]) for r in tails.collect() if bytes(r["tail"]) == _MARK}
    report = []
    for path, size in parts.items():
        r, sealed = held.get(_plain(path)), None
        if r is not None:
            sealed = _renamed(spark, path, f"{path.rsplit('/', 1)[0]}/{_clock(r['low'])}_{_clock(r['high'])}")
            state = "sealed" if sealed else "failed"
        elif size == 0 or _plain(path) in whole:
            remove(spark, path)
            state = "empty"
        else:
            state = "corrupt"
        report.append((path, size, r["n"] if r else 0, state, sealed))
    return spark.createDataFrame(report, "path string, bytes long, rows long, state string, sealed string")


def _renamed(spark: SparkSession, path: str, stem: str) -> str | None:
    """The first free name of a stem that the file took."""
    fs, source = file_system(spark, path)
    for k in range(10_000):
        sealed = f"{stem}{f'_{k}' if k else ''}.parquet"
        target = file_system(spark, sealed)[1]
        if not fs.exists(target):
            return sealed if fs.rename(source, target) else None
    return None


def _plain(path: str) -> str:
    """A path without its scheme, which listings and readers write differently."""
    return "/" + path.split(":", 1)[-1].lstrip("/")
