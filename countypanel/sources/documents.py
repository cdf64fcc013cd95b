"""JSON replies: a matrix whose first row is the header, and feature collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import to_number, zero_pad
from ..functions.names import name_key

INCOME_SCHEMA = (
    "county_fips string, county_name_full string, county_key string, median_income double"
)

# Properties that may hold the name of a feature, best first.
NAME_PROPERTIES = ["name", "Name", "NAME", "Label", "label"]


def matrix_rows(df: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """Rows of a JSON matrix as text columns, addressed by the names in its first row.

    `fields` are the header names wanted; one missing from the header gives NULL. Each
    document carries its own header, so column order may differ between documents. An
    empty or missing document has no rows.
    """
    keep = [c for c in df.columns if c != column]
    matrix = F.from_json(F.col(column), "array<array<string>>")
    parsed = df.select(*keep, matrix.alias("matrix")).where(F.size("matrix") > 1)
    rows = parsed.select(
        *keep,
        F.element_at("matrix", 1).alias("header"),
        F.explode(F.slice("matrix", F.lit(2), F.size("matrix") - 1)).alias("cells"),
    )
    cell = [
        F.try_element_at("cells", F.nullif(F.array_position("header", F.lit(f)), F.lit(0)).cast("int"))
        for f in fields
    ]
    return rows.select(*keep, *[c.alias(f) for c, f in zip(cell, fields)])


def income_table(
    df: DataFrame, column: str, state: str | Column, abbreviation: str | Column,
    measure: str = "SAEMHI_PT",
) -> DataFrame:
    """County incomes out of matrix replies: fips, full name, matching key, income."""
    keep = [c for c in df.columns if c != column]
    rows = matrix_rows(df, column, ["NAME", measure, "state", "county"])
    return rows.select(
        *keep,
        F.concat(zero_pad(F.col("state"), 2), zero_pad(F.col("county"), 3)).alias("county_fips"),
        F.col("NAME").alias("county_name_full"),
        name_key(F.col("NAME"), state, abbreviation).alias("county_key"),
        to_number(F.col(measure)).alias("median_income"),
    )


def empty_income(spark: SparkSession) -> DataFrame:
    """The table of a reply without content: no rows, the usual columns."""
    return spark.createDataFrame([], INCOME_SCHEMA)


def feature_names(df: DataFrame, column: str) -> DataFrame:
    """One row per feature of each collection, with its properties and its name.

    The name is the first of the known name properties that the feature has; a feature
    with none of them stops the job. Other columns of `df` are kept.
    """
    keep = [c for c in df.columns if c != column]
    schema = "struct<features: array<struct<properties: map<string,string>>>>"
    parsed = F.from_json(F.col(column), schema)
    features = df.select(*keep, F.explode(parsed["features"]).alias("feature"))
    props = F.col("feature.properties")
    known = F.coalesce(*[F.try_element_at(props, F.lit(p)) for p in NAME_PROPERTIES])
    problem = F.raise_error(
        F.lit("no name property among " + ", ".join(NAME_PROPERTIES))
    ).cast("string")
    return features.select(
        *keep, props.alias("properties"), F.coalesce(known, problem).alias("feature_name")
    )
