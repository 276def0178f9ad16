"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
import compare
from tidewright.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_sql_has_no_stray_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = compare.connect(SF_DIR)
    assert compare.difference(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", ["rolled_dead_letters", "stream_dead_letters"])
def test_a_dead_letter_table_that_fails_never_shortens_the_result(spark, monkeypatch, name):
    write, calls = ingest.write_dead_letters, []

    def failing(*args):
        calls.append(args)
        if len(calls) <= failures:
            raise OSError("storage is gone")
        write(*args)

    monkeypatch.setattr(ingest, "write_dead_letters", failing)
    failures = 1
    assert compare.difference(spark, compare.connect(SF_DIR), name, QUERIES[name], SQL[name], SF_DIR) is None
    failures = 1000
    with pytest.raises(OSError):
        QUERIES[name](spark, SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
