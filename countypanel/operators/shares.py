"""Answer shares per county and year, weighted and unweighted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import answer_label
from ..functions.missing import percent
from .codebook import share_columns, with_labels
from .geography import without_placeholder_names
from .survey import county_codes, with_county_names, with_display_key

KEYS = ("fips", "state_name", "county_name", "survey_year")
ANSWERED = "answered_any"
MEASURES = ["unweighted_count", "unweighted_percent", "weighted_count", "weighted_percent"]


def with_answered(df: DataFrame, variables: list[str], present: list[str]) -> DataFrame:
    """Adds a variable with answer 1 on rows that answer any of `present`.

    A county-year belongs to a panel when any question of the survey was answered there.
    Where a job needs the shares of few questions, this one extra variable stands in for
    the presence of all others, instead of counting the answers of each.
    """
    answered = F.coalesce(*[F.col(v).cast("string") for v in present]).isNotNull()
    kind = df.schema[variables[0]].dataType
    return df.withColumn(ANSWERED, F.when(answered, F.lit(1).cast(kind)))


def answer_counts(
    df: DataFrame, variables: list[str], keys=KEYS, weight: str = "final_weight"
) -> DataFrame:
    """Rows and weight per (keys, variable, answer), answers as they are in the data.

    All variables in one pass: the unpivot is pipelined into the map-side aggregate, so
    what is shuffled is at most one row per task and group, and a group that holds a
    third of all rows costs no more than any other.
    """
    types = {df.schema[v].dataType.simpleString() for v in variables}
    if len(types) > 1:
        df = df.withColumns({v: F.col(v).cast("string") for v in variables})
    long = df.select(*keys, weight, *variables).unpivot(
        [*keys, weight], variables, "variable", "answer"
    )
    return (
        long.where(F.col("answer").isNotNull())
        .groupBy(*keys, "variable", "answer")
        .agg(
            F.count("*").alias("unweighted_count"),
            F.coalesce(F.sum(F.col(weight).cast("double")), F.lit(0.0)).alias("weighted_count"),
        )
    )


def shares_of_counts(counts: DataFrame, keys=KEYS) -> DataFrame:
    """Percent of each answer among all answers of its variable in (keys).

    Merges counts whose labels or county names coincide. The explicit repartition by
    `keys` serves the merge, the window and a pivot to the wide table alike; what is moved
    are counts, of which a county-year has as many as there are answers.
    """
    scope = [*keys, "variable"]
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    merged = (
        counts.where(known)
        .withColumn("category", answer_label(F.col("answer")))
        .repartition(*keys)
        .groupBy(*scope, "category")
        .agg(
            F.sum("unweighted_count").alias("unweighted_count"),
            F.sum("weighted_count").alias("weighted_count"),
        )
    )
    whole = Window.partitionBy(*scope)
    for kind in ("unweighted", "weighted"):
        count = F.col(f"{kind}_count")
        merged = merged.withColumn(f"{kind}_percent", percent(count, F.sum(count).over(whole)))
    return merged.select(*scope, "category", *MEASURES)


def share_long(df: DataFrame, variables: list[str], keys=KEYS, weight="final_weight") -> DataFrame:
    """Shares from rows that already carry their county name. Missing answers leave the base."""
    return shares_of_counts(answer_counts(df, variables, keys, weight), keys)


def county_shares(
    raw: DataFrame, crosswalk: DataFrame, variables: list[str], weight="final_weight",
    style: str = "usps", present: list[str] | None = None, keys=KEYS,
) -> DataFrame:
    """Shares from rows with raw county codes.

    Counts first by the codes as written, then cleans codes, looks names up and merges:
    the text work and the join run on counts, not on respondents. Adding counts is exact
    whichever comes first. The placeholder county leaves for want of a name, because a
    filter on the cleaned codes would be moved below the counting and run per
    respondent. `present` are questions that only make a county-year appear, see
    `with_answered`.
    """
    if present:
        raw = with_answered(raw, variables, present)
        variables = [*variables, ANSWERED]
    counts = answer_counts(raw, variables, ("_state", "ctycode", "survey_year"), weight)
    return shares_of_codes(counts, crosswalk, style, keys)


def shares_of_codes(counts: DataFrame, crosswalk: DataFrame, style: str = "usps", keys=KEYS) -> DataFrame:
    """Shares from counts by raw county codes; counts of several batches are added."""
    named = with_county_names(county_codes(counts), without_placeholder_names(crosswalk))
    return shares_of_counts(with_display_key(named, style).where(F.col("county_name").isNotNull()), keys)


def share_long_two_sided(
    df: DataFrame, variables: list[str], keys=KEYS, weight: str = "final_weight"
) -> DataFrame:
    """The same table as a full outer join of an unweighted and a weighted table.

    Both sides have the same groups, so `share_long` gives the same result in one
    aggregate; this form aggregates twice and is there to compare with.
    """
    on = [*keys, "variable", "category"]
    counts = answer_counts(df, variables, keys, weight)
    one = shares_of_counts(counts.withColumn("weighted_count", F.lit(0.0)), keys)
    other = shares_of_counts(counts.withColumn("unweighted_count", F.lit(0)), keys)
    unweighted = one.select(*on, "unweighted_count", "unweighted_percent")
    weighted = other.select(*on, "weighted_count", "weighted_percent")
    return unweighted.join(weighted, on, "full").select(*on, *MEASURES)


def answer_columns(shares: DataFrame, variables=None) -> list[str]:
    """Names of the wide table's columns: the codebook's, and every further answer in the shares.

    One aggregate; what reaches the driver are distinct answers, a few thousand at most. `shares`
    should be a written table, as it is read here and again for the wide table.
    """
    listed = share_columns(variables)
    found = with_labels(shares).where(F.col("variable") != ANSWERED).select(F.concat_ws("_", "variable", "label")).distinct()
    return [*listed, *sorted({r[0] for r in found.collect()} - set(listed))]


def share_wide(shares: DataFrame, variables=None, columns=None, keys=KEYS) -> DataFrame:
    """One row per (keys), one column per answer: "<variable>_<label>_uw" and "..._w".

    Columns are those of the codebook, for all or some variables, or the list given;
    `answer_columns` lists every answer there is, so that none is left out. An answer nobody
    gave is 0, also where the variable was not asked that year.
    """
    names = columns or share_columns(variables)
    both = F.array(
        F.struct(F.lit("_uw").alias("suffix"), F.col("unweighted_percent").alias("percent")),
        F.struct(F.lit("_w").alias("suffix"), F.col("weighted_percent").alias("percent")),
    )
    cells = with_labels(shares).select(
        *keys, F.concat_ws("_", "variable", "label").alias("name"), F.explode(both).alias("cell")
    )
    wanted = [name + suffix for suffix in ("_uw", "_w") for name in names]
    pivoted = (
        cells.select(*keys, F.concat("name", "cell.suffix").alias("name"), "cell.percent")
        .groupBy(*keys)
        .pivot("name", wanted)
        .agg(F.avg("percent"))
    )
    # Names of unlabelled codes hold a dot ("..._8.0_w"), hence the quoting.
    filled = [F.coalesce(F.col(f"`{name}`"), F.lit(0.0)).alias(name) for name in wanted]
    return pivoted.select(*keys, *filled)
