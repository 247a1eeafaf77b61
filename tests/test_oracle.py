"""Every registered query of the core agrees with its DuckDB SQL at sf0.001.

At this size a query is mostly planning and scheduling, so all of them run
side by side in one session first, and the tests then compare."""

from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import __spark_entry__ as entry
from notelab.plans.catalog import ORACLES, QUERIES
from notelab.plans.testbed import BASE_TABLES

from conftest import SMOKE

import tools.oracle_check as oc  # noqa: E402


@pytest.fixture(scope="module")
def results(spark):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE}/{t}.parquet')")

    def ours(name):
        df = QUERIES[name](spark, SMOKE)
        return df.columns, [tuple(r) for r in df.collect()]

    def theirs(name):
        cur = con.cursor().execute(ORACLES[name])
        return [d[0] for d in cur.description], cur.fetchall()

    with ThreadPoolExecutor(6) as pool:
        found = {n: pool.submit(ours, n) for n in sorted(QUERIES)}
        expected = {n: pool.submit(theirs, n) for n in sorted(ORACLES)}
        # wait for all, so that a failure shows in its own test
        for f in [*found.values(), *expected.values()]:
            f.exception()
    return found, expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(results, name):
    found, expected = results
    columns, rows = found[name].result()
    if name not in ORACLES:
        assert columns
        return
    other_columns, other_rows = expected[name].result()
    assert sorted(columns) == sorted(other_columns)
    assert oc.digest(rows, columns)[0] == oc.digest(other_rows, other_columns)[0]


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["A11_merge_intervals", "X05_crop_spans", "D02_remove_inner_labels", "D18_resolve_overlaps"])
def test_sql_gives_the_same_rows_with_any_number_of_threads(name):
    found = []
    for threads in (1, 4):
        con = duckdb.connect(config={"threads": threads})
        for t in BASE_TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{SMOKE}/{t}.parquet')")
        cur = con.execute(ORACLES[name])
        found.append(oc.digest(cur.fetchall(), [d[0] for d in cur.description])[0])
    assert found[0] == found[1]
