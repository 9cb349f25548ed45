"""Named queries with, where SQL can say it, an independent statement of the same result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.plans.staged import Tables

DIGITS = 6

SERIES_SQL = """u AS (
  SELECT CAST(user_id AS INT) AS unit_number,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS time_cycles,
    CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2
         WHEN 'purchase' THEN 3 ELSE 4 END AS DOUBLE) AS setting_1,
    value AS sensor_1,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_2
  FROM events)"""

LINES_SQL = """l AS (
  SELECT CAST(l_suppkey AS INT) AS unit_number,
    CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
                            l_partkey, l_extendedprice) AS INT) AS time_cycles,
    l_quantity AS sensor_1, l_extendedprice AS sensor_2, l_discount AS sensor_3, l_tax AS sensor_4
  FROM lineitem)"""

LABELLED_SQL = (
    SERIES_SQL
    + """,
r AS (SELECT *, max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles AS RUL FROM u),
st AS (
  SELECT r.* , CAST(CASE WHEN hi > lo
      THEN 5 - greatest(least(ceil((RUL - lo) * 5 / (hi - lo)), 5), 1) ELSE 4 END AS INT) AS true_stage,
    CAST(floor(sensor_1) AS INT) % 5 AS predicted_stage,
    (time_cycles * 7 + CAST(sensor_2 AS INT)) % 5 AS cluster,
    'FD00' || CAST(1 + unit_number % 4 AS VARCHAR) AS dataset_id
  FROM r JOIN (SELECT unit_number, min(RUL) AS lo, max(RUL) AS hi FROM r GROUP BY 1) USING (unit_number)),
p AS (
  SELECT *, sensor_2 AS predicted_time_to_next_stage,
    time_to_next_stage + sensor_2 / 100 AS pred_a, time_to_next_stage * CAST(0.9 AS DOUBLE) AS pred_b
  FROM (SELECT a.*, CAST(greatest(coalesce(
      (SELECT min(f.time_cycles) FROM st f WHERE f.unit_number = a.unit_number
        AND f.predicted_stage = a.predicted_stage + 1 AND f.time_cycles > a.time_cycles) - a.time_cycles,
      RUL), 0) AS DOUBLE) AS time_to_next_stage FROM st a))"""
)

SCORED_SQL = (
    LABELLED_SQL
    + """,
s0 AS (
  SELECT *, CASE WHEN predicted_stage >= 4 THEN 1.0::DOUBLE ELSE
      least(1.0::DOUBLE, pow(predicted_stage / 4, 2) + 0.1::DOUBLE * predicted_stage) END AS failure_probability,
    CASE WHEN predicted_stage >= 4 THEN 0.0::DOUBLE WHEN predicted_stage = 3
      THEN greatest(0, predicted_time_to_next_stage)
      ELSE greatest(0, predicted_time_to_next_stage) * (1 + 0.8::DOUBLE * (3 - predicted_stage)) END AS time_to_failure
  FROM p),
s1 AS (
  SELECT *, failure_probability * (100.0::DOUBLE / greatest(time_to_failure, 1)) AS raw_risk_score,
    failure_probability / (greatest(time_to_failure, 1) + 1e-6::DOUBLE) AS urgency_score FROM s0),
s AS (
  SELECT *, CASE WHEN (SELECT max(urgency_score) > min(urgency_score) FROM s1)
    THEN (urgency_score - (SELECT min(urgency_score) FROM s1))
       / ((SELECT max(urgency_score) FROM s1) - (SELECT min(urgency_score) FROM s1)) ELSE 0.5 END AS normalized_urgency
  FROM s1)"""
)

ASSESSED_SQL = (
    SCORED_SQL
    + """,
q AS (SELECT quantile_cont(normalized_urgency, 0.85) AS h, quantile_cont(normalized_urgency, 0.6) AS m,
        quantile_cont(normalized_urgency, 0.3) AS lo FROM s),
th AS (SELECT CASE WHEN h > m AND m > lo THEN h ELSE 0.6 END AS high,
        CASE WHEN h > m AND m > lo THEN m ELSE 0.3 END AS medium,
        CASE WHEN h > m AND m > lo THEN lo ELSE 0.1 END AS low FROM q),
v AS (
  SELECT *, risk_level = 'HIGH' AS maintenance_alert FROM (
    SELECT s.*, CASE WHEN normalized_urgency >= high THEN 'HIGH' WHEN normalized_urgency >= medium THEN 'MEDIUM'
      WHEN normalized_urgency >= low THEN 'LOW' ELSE 'NEGLIGIBLE' END AS risk_level FROM s, th))"""
)

BASES = {
    "u": SERIES_SQL,
    "l": LINES_SQL,
    "p": LABELLED_SQL,
    "s": SCORED_SQL,
    "v": ASSESSED_SQL,
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _nudge(digits: int) -> float:
    """Added before rounding, so that decimal ties round alike in engines that sum in another order."""
    return 3.1 * 10.0 ** -(digits + 2)


def _rounded_sql(column: str, digits: int) -> str:
    return f'round(CAST("{column}" AS DOUBLE) + {_nudge(digits):.3e}::DOUBLE, {digits}) + 0.0::DOUBLE AS "{column}"'


def query(
    name: str,
    keys: Sequence[str] = (),
    doubles: Sequence[str] = (),
    sql: str | None = None,
    base: str | None = None,
    digits: int = DIGITS,
):
    """Register a query that returns ``keys`` as they are and ``doubles`` rounded.

    ``sql`` is a SELECT giving the same columns; ``base`` names the common tables it starts from.
    """
    full = None
    if sql is not None:
        with_part = f"WITH {BASES[base]}, out_ AS (" if base else "WITH out_ AS ("
        columns = ", ".join([*[f'"{k}"' for k in keys], *[_rounded_sql(c, digits) for c in doubles]])
        full = f"{with_part}{sql}) SELECT {columns} FROM out_"

    def register(fn: Callable[[Tables], DataFrame]):
        def build(t: Tables) -> DataFrame:
            rounded = [F.round(F.col(c).cast("double") + F.lit(_nudge(digits)), digits).alias(c) for c in doubles]
            return fn(t).select(*keys, *rounded)

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, full)
        return fn

    return register


def load_all() -> dict[str, Query]:
    from wearcurve.plans import catalogue_models, catalogue_risk, catalogue_series  # noqa: F401

    return QUERIES


def runnable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: q.build(Tables(spark, sf_dir))
