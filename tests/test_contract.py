import pytest

from millrace.plans.contract import ORACLES, QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    compare(QUERIES[name](spark, SF), ORACLES[name], SF)


@pytest.mark.parametrize("name", ["epoch_to_timestamp_date", "json_typed_fields"])
def test_years_of_any_length_like_the_oracle(spark, tmp_path, name):
    """Sixty times sf0.1 reaches the year 18,396; dates beyond 9999 can't be Python's, so DuckDB compares the files."""
    ids = [None, 0, 1, 2932930, 2932931, 5999999, 106_700_000, -1, -700_000, -719_170, -719_536, -719_540, -800_000, -5_999_999]
    sf, out = f"{tmp_path}/sf", f"{tmp_path}/out"
    spark.createDataFrame([(i, 1.5, '{"k": 3}') for i in ids], "event_id bigint, value double, props string").write.parquet(f"{sf}/events.parquet")
    QUERIES[name](spark, sf).write.parquet(out)
    con = duck(sf)
    want, got = con.execute(ORACLES[name]), duck(sf).execute(f"SELECT * FROM read_parquet('{out}/*.parquet')")
    assert [d[0] for d in want.description] == [d[0] for d in got.description]
    assert sorted(map(str, got.fetchall())) == sorted(map(str, want.fetchall()))
