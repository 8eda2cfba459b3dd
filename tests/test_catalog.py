"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert oracle.compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


GRIDS = ["tune_grid_stratified", "workflow_grid_search"]


@pytest.mark.parametrize("name", GRIDS)
def test_grid_sql_draws_from_all_copies(name, duck):
    """Each fold's training minority is repeated, every copy is numbered, and as many as the majority has are kept."""
    ctes = ORACLES[name].split(", ev AS (")[0]
    majority, minority = (duck.execute(f"{ctes} SELECT count(*) // 3 FROM folded WHERE y = {y}").fetchone()[0] for y in (-1, 1))
    numbered = duck.execute(f"{ctes} SELECT count(*) FROM kept GROUP BY i").fetchall()
    assert numbered == [(2 * minority * -(-majority // minority),)] * 3


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark, sf):
    rows = entry_points.entry(spark).collect()
    assert {r["feature"] for r in rows} >= {"bias", "p_size"}
