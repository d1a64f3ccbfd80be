"""Every registered query against its SQL, on the smallest tables."""

import pytest

import check_queries
from matchstrata.plans import oracle, workload

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(workload.queries()))
def test_query_equals_its_sql(spark, name):
    verdict = check_queries.compare(spark, SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(workload.queries()) == set(oracle.oracle_sql())


def test_flagship_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:3] == ["league", "team_id", "team"] and not df.isEmpty()


def test_landed_text_is_compressed(spark):
    from pathlib import Path

    path = workload._land_teams(workload.teams_raw(spark, SF_DIR))
    files = [f for f in Path(path.removeprefix("file:")).rglob("part-*")]
    assert files and all(f.suffix == ".lz4" for f in files)
