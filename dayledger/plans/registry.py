"""Registry of named queries over the star tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the independent formulation for the correctness check."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return add


def half_up(num: str, den: str, digits: int) -> str:
    """SQL for num / den of integers rounded half away from zero, as an exact decimal."""
    scale = 10 ** digits
    n, dn = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    whole = f"sign({n}) * ((2 * {scale} * abs({n}) + {dn}) // (2 * {dn}))"
    return f"CAST(CAST({whole} AS DOUBLE) / {scale} AS DECIMAL(18,{digits}))"


def cents(amount: str) -> str:
    """Exact integer cents of a DECIMAL(.., 2) SQL expression."""
    return f"CAST({amount} * 100 AS HUGEINT)"


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


# Shared SQL fragments: the star tables in their analytic roles.
ENRICHED = """enr AS (
  SELECT CAST(o.o_orderdate AS DATE) AS jour, l.l_returnflag AS act, o.o_orderstatus AS invoice_type,
         o.o_orderpriority AS scheme, l.l_linestatus AS centre_type, CAST(l.l_suppkey AS VARCHAR) AS centre,
         CAST(l.l_partkey AS VARCHAR) AS practitioner, CAST(o.o_custkey AS VARCHAR) AS person,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS billed,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS insurer_paid,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS patient_paid
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate IS NOT NULL)"""

ANSWERS = """ans AS (
  SELECT l_orderkey AS request, l_returnflag AS status_code, l_shipdate + INTERVAL 90 MINUTE AS answer_time,
         CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_suppkey % 20 AS VARCHAR) END AS agent_code
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                     ORDER BY l_shipdate DESC, l_returnflag DESC, l_suppkey DESC) AS rn
        FROM lineitem WHERE l_linenumber = 1) WHERE rn = 1)"""

REQUESTS = ANSWERS + """, amt AS (
  SELECT l_orderkey AS request, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
  FROM lineitem GROUP BY 1), req AS (
  SELECT o.o_orderkey AS request, CAST(o.o_orderdate AS DATE) AS jour, o.o_orderpriority AS request_type,
         COALESCE(a.status_code, 'sans_reponse') AS status_code, a.agent_code,
         date_sub('hour', o.o_orderdate, a.answer_time) AS delay_hours, COALESCE(m.amount, 0) AS amount
  FROM orders o LEFT JOIN ans a ON a.request = o.o_orderkey LEFT JOIN amt m ON m.request = o.o_orderkey
  WHERE o.o_orderdate IS NOT NULL)"""

REQUESTS_DAY = REQUESTS + f""", rday AS (
  SELECT jour, status_code, request_type, count(*) AS n_requests,
         {half_up('sum(delay_hours)', 'count(delay_hours)', 2)} AS mean_delay_hours,
         CAST(sum(amount) AS DECIMAL(18,2)) AS engaged_amount
  FROM req GROUP BY ALL)"""

DETAIL = ANSWERS + """, det AS (
  SELECT o.o_orderkey AS request, o.o_orderpriority AS request_type, COALESCE(a.status_code, 'sans_reponse') AS status_code,
         COALESCE(i.n_items, 0) AS n_items, COALESCE(i.n_distinct_items, 0) AS n_distinct_items,
         COALESCE(p.n_pathologies, 0) AS n_pathologies
  FROM orders o LEFT JOIN ans a ON a.request = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_items, count(DISTINCT l_partkey) AS n_distinct_items
             FROM lineitem GROUP BY 1) i ON i.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_pathologies FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) p
         ON p.l_orderkey = o.o_orderkey)"""
