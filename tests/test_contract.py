"""Registered queries against their SQL twins, and fixed numbers of the flagship."""

import math

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from countypanel.plans import catalog, oracle

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
NAMES = list(oracle.statements())


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def sorted_rows(rows):
    return sorted(tuple(plain(v) for v in row) for row in rows)


def test_every_query_has_its_twin():
    assert set(catalog.registered()) == set(oracle.statements())
    assert set(catalog.registered()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, database, name):
    df = entry_points.queries()[name](spark, SF_SMALL)
    twin = database.sql(entry_points.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(twin.columns)
    mine = df.select(*[f"`{c}`" for c in columns]).collect()
    theirs = twin.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert len(mine) >= 1
    assert sorted_rows(mine) == sorted_rows(theirs)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_flagship_numbers(spark):
    """Counted by hand over orders, customers and nations."""
    two = ["current_smoking_frequency", "ever_told_high_bp"]
    df = entry_points.queries()["share_long"](spark, SF_SMALL).where(F.col("variable").isin(two)).cache()
    totals = df.agg(F.count("*"), F.sum("unweighted_count"), F.sum("weighted_count"),
                    F.sum("unweighted_percent")).first()
    assert totals[0] == 1176 and totals[1] == 25237
    assert totals[2] == pytest.approx(6127117120.24) and totals[3] == pytest.approx(33600, abs=1e-2)
    county = df.where("fips = '02007' and survey_year = 1999 "
                      "and variable = 'current_smoking_frequency'").orderBy("category").collect()
    weights = [8388747.12, 13416249.46, 8082125.05]
    assert [(r.county_name, r.category, r.unweighted_count) for r in county] == [
        ("NATION_1 County, New ASIA", c, n) for c, n in (("1.0", 32), ("2.0", 55), ("3.0", 35))]
    assert [r.weighted_percent for r in county] == pytest.approx([100 * w / sum(weights) for w in weights], abs=1e-6)


def test_labour_numbers(spark):
    months = entry_points.queries()["labor_wide"](spark, SF_SMALL)
    assert months.count() == 2245
    assert months.where("month = 13").count() == 175
    brackets = entry_points.queries()["income_tertiles"](spark, SF_SMALL).groupBy("income_bracket").count()
    assert {r[0]: r[1] for r in brackets.collect()} == {"Low": 70, "Middle": 35, "High": 70}
