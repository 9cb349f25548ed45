"""Every named query runs; those with SQL give the same rows."""

import oracle_check
import pytest

from wearcurve.plans import registry

SF = "/root/testdata/sf0.001"
# fits of many trees or rounds, half a minute and more; tests/oracle_check.py runs them, test_learning.py tests their parts
LONG = {"I6_centroid_clusters", "I11_hyper_parameter_search", "I17_gradient_boosting", "M4_time_predictions", "M6_run_all_phases"}
NAMES = [n for n in registry.load_all() if n not in LONG]


@pytest.fixture(scope="module")
def con():
    return oracle_check.database(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    q = registry.load_all()[name]
    df = registry.runnable(q)(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if q.sql is None:
        return
    result = con.execute(q.sql)
    problem = oracle_check.compare(rows, df.columns, result.fetchall(), [d[0] for d in result.description])
    assert problem is None, problem


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1


def test_weighted_bootstrap_returns_drawn_rows(spark, con):
    """Each drawn row with its draws, not a sum for each unit."""
    q = registry.load_all()["L8_weighted_bootstrap"]
    df = registry.runnable(q)(spark, SF)
    assert df.columns == ["unit_number", "time_cycles", "draws"]
    rows, series = df.collect(), con.execute("SELECT count(*), count(DISTINCT user_id) FROM events").fetchone()
    assert len(rows) == len({(r["unit_number"], r["time_cycles"]) for r in rows}) > series[1]
    assert all(r["draws"] > 0 for r in rows) and abs(sum(r["draws"] for r in rows) - series[0]) < 5 * series[0] ** 0.5
