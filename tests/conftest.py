import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    s = build_session("local[4]", 8, extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from quarry.sources.tables import TABLE_NAMES
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
