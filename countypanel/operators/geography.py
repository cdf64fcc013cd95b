"""County crosswalk from hierarchical geocodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import PLACEHOLDER_COUNTY

STATE_LEVEL = "040"
COUNTY_LEVEL = "050"


def county_crosswalk(geocodes: DataFrame) -> DataFrame:
    """fips, state_name, county_name of every county; state name NULL if unlisted.

    A window over the rows of a state instead of a join: Spark takes the size of a join
    for the product of its sides, and would shuffle respondents for the sake of three
    thousand counties. A state listed twice gives the first of its names.
    """
    listed = geocodes.where(F.col("level").isin(STATE_LEVEL, COUNTY_LEVEL))
    state = F.min(F.when(F.col("level") == STATE_LEVEL, F.col("area_name"))).over(Window.partitionBy("state_fips"))
    return listed.withColumn("state_name", state).where(F.col("level") == COUNTY_LEVEL).select(
        F.concat("state_fips", "county_fips").alias("fips"), "state_name", F.col("area_name").alias("county_name")
    )


def without_placeholder_names(crosswalk: DataFrame) -> DataFrame:
    """The crosswalk with the names of placeholder counties taken away.

    A filter on the code would do the same, but Spark infers it for the other side of a
    join on that code as well.
    """
    real = F.substring("fips", 3, 3) != PLACEHOLDER_COUNTY
    return crosswalk.withColumn("county_name", F.when(real, F.col("county_name")))
