import duckdb
import pytest

from mdlake.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("part", "orders", "lineitem", "events")


def plain(rows):
    fixed = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(fixed(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", ["snapshot_polls", "forward_price_log", "listing_snapshots", "bad_log_lines", "open_parts", "id_forms", "delta_batches", "validate_outcome_capture"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert len(want) > 0 and plain(got.collect()) == plain(want)


@pytest.mark.parametrize("name", ["capture_stream", "snapshot_polls", "forward_price_log", "listing_snapshots", "bad_log_lines", "smoothing_stream"])
def test_empty_tables(spark, tmp_path, name):
    for table in TABLES:
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, f"file://{tmp_path}").count() == 0


def test_resolution_log_with_longer_strikes(spark, tmp_path):
    """Ids of strikes of three and four digits: the log has them in the order of their text."""
    wide = "/root/testdata/sf0.1"
    spark.read.parquet(f"{wide}/part.parquet").filter("p_partkey < 36 OR p_partkey BETWEEN 3240 AND 3275").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    for table in TABLES[1:]:
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = QUERIES["resolution_log"](spark, f"file://{tmp_path}")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['resolution_log']})").fetchall()
    assert len(want) > 0 and plain(got.collect()) == plain(want)
    assert any("-1000-" in row[-1] for row in want)
