"""Small constant tables inside the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Text rows written into the plan itself.

    Spark then knows that the table is small, which it cannot for rows sent from Python,
    and no Python worker is started for them.
    """
    values = ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
