"""Every registered query against its SQL, on whole tables."""

import pytest

import oracle
from conftest import SF
from pyspark.sql import functions as F

from dayledger.functions import scalars as S
from dayledger.plans import quality_queries
from dayledger.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], ORACLES[name], SF) == []


@pytest.mark.parametrize("name", ["quarantine_board_newest", "quarantine_board_by_day"])
def test_board_takes_days_without_json(spark, name):
    assert "json" not in QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_day_beside_the_raw_row_is_the_one_in_it(spark):
    rows = quality_queries._all_raw(spark, SF, "jour")
    read = F.coalesce(S.json_text("donnee_brute", "jour_soins"), F.substring(S.json_text("donnee_brute", "date_debut"), 1, 10))
    seen = rows.select("domaine", F.col("jour").isNotNull().alias("dated"), F.equal_null("jour", read.cast("date")).alias("same")).distinct()
    assert {(r.domaine, r.dated) for r in seen.collect()} == {
        ("prestation", True), ("prestation", False), ("facture", True), ("facture", False), ("assure", False), ("agent", False), ("entente_prealable", True)}
    assert seen.where("not same").count() == 0
