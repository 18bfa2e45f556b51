"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from spanloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "documents conversations pages".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _sorted(rows):
    plain = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    return sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_its_sql(spark, sql, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    got = sql.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in got.fetchall()]
    assert _sorted(rows) == _sorted(want)


def test_flagship_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(registry.QUERIES) <= set(entry.queries())
