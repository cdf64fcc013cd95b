"""The registered queries: each runs one operator over whole tables.

Doubles are rounded to six places at the very end, because sums of doubles depend on
the order of their parts in the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import clean_missing
from ..functions.names import name_key
from ..operators import alignment, classify, labor, linear, panel, phases, quality, quantiles, regression, shares, survey
from ..operators.codebook import share_columns, with_labels
from ..operators.geography import county_crosswalk
from ..sources import documents, drifting, manifest, sinks, yearly
from ..sources.delimited import DATA_COLUMNS, geocode_rows, read_without_header
from ..sources.scratch import scratch_folder, written
from ..streaming import counts as landed_counts
from ..streaming import restated
from . import jobs
from .standins import FIRST_YEAR, LAST_YEAR, YEARS, Tables

CODES = ("_state", "ctycode")
VARIABLES = [
    "general_health_status", "current_smoking_frequency", "ever_told_high_bp",
    "any_alcohol_past_month", "eats_fruit", "ever_told_asthma",
]
HEALTH_W = [c + "_w" for c in share_columns(["general_health_status"])[:5]]
HEALTH_UW = [c + "_uw" for c in share_columns(["general_health_status"])[:5]]
ALCOHOL_UW = [c + "_uw" for c in share_columns(["any_alcohol_past_month"])]
X, Y = panel.UNEMPLOYMENT, panel.EXCELLENT
POOLED = ("survey_year",)

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__.removesuffix("_query")] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{name}`"), places).alias(name) if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: rounded(fn(Tables(spark, folder)))

    return {name: bind(fn) for name, fn in REGISTRY.items()}


# --- inputs shared by the queries below ---


def crosswalk(t: Tables) -> DataFrame:
    return county_crosswalk(geocode_rows(t.geocode_lines()))


def respondents(t: Tables) -> DataFrame:
    """Survey rows with readable answer names and raw county codes."""
    return survey.rename_columns(t.survey_raw(), keep=CODES)


def named_rows(t: Tables) -> DataFrame:
    """Survey rows with county and state names, before the display key."""
    return survey.prepare(t.survey_raw(), crosswalk(t))


def long_shares(t: Tables, variables=VARIABLES, present=None) -> DataFrame:
    return shares.county_shares(respondents(t), crosswalk(t), variables, present=present)


def star(t: Tables) -> DataFrame:
    counties = labor.county_areas(t.area())
    return labor.labor_star(t.la_data(), labor.series_of(t.series(), counties), counties)


def months(t: Tables, annual_period: str = "keep") -> DataFrame:
    counties = labor.county_areas(t.area())
    series = labor.series_of(t.series(), counties)
    return labor.labor_wide(t.la_data(), series, counties, annual_period)


def yearly_labor(t: Tables) -> DataFrame:
    return labor.labor_yearly(months(t))


def merged(t: Tables, variables=None) -> DataFrame:
    """The county-year panel, with the codebook's answers of some variables, or every answer of all."""
    long = long_shares(t, variables or VARIABLES, present=VARIABLES if variables else None)
    wide = shares.share_wide(long, variables) if variables else all_answers(long)
    return panel.merge_panel(wide, yearly_labor(t))


def all_answers(long: DataFrame) -> DataFrame:
    """Shares of every answer, from a written table, as it is read for its columns and again for the rows."""
    long = written(long, scratch_folder(long.sparkSession, "shares"))
    return shares.share_wide(long, columns=shares.answer_columns(long, VARIABLES))


def health_panel(t: Tables) -> DataFrame:
    return merged(t, ["general_health_status"])


# --- keys and geography ---


@query
def fips_from_codes(t):
    df = survey.normalise(t.survey_raw().select("respondent_id", "_state", "_cnty"))
    return df.select("respondent_id", "state_fips", "county_fips3", "fips")


@query
def fips_from_text(t):
    df = survey.county_codes(t.survey_raw().select("respondent_id", "_state", "ctycode"))
    return df.select("respondent_id", "_state", "ctycode", "fips")


@query
def valid_county_rows(t):
    df = survey.county_codes(t.survey_raw().select("respondent_id", "_state", "ctycode", "year"))
    return survey.known_counties(df)


@query
def geocode_levels(t):
    return geocode_rows(t.geocode_lines())


@query
def county_crosswalk_query(t):
    return crosswalk(t)


@query
def survey_geo_left(t):
    return named_rows(t).select("respondent_id", "fips", "state_name", "county_name")


@query
def county_display_key(t):
    return survey.with_display_key(named_rows(t)).select("respondent_id", "county_name")


@query
def county_display_key_prefix(t):
    """The form of some existing panels, by the state's first two letters."""
    return survey.with_display_key(named_rows(t), "prefix2").select("respondent_id", "county_name")


@query
def normalized_name(t):
    name = F.col("area_text")
    region = t.counties().select("state_fips", "r_name").distinct()
    df = t.area().withColumn("state_fips", F.substring("area_code", 3, 2)).join(region, "state_fips")
    key = name_key(name, F.col("r_name"), F.substring("r_name", 1, 2))
    return df.select("area_code", "area_text", key.alias("name_key"))


# --- shares ---


@query
def share_long(t):
    return long_shares(t)


@query
def share_outer_form(t):
    rows = survey.with_display_key(survey.with_county_names(
        survey.known_counties(survey.county_codes(respondents(t))), crosswalk(t)))
    return shares.share_long_two_sided(rows, VARIABLES)


@query
def share_labeled(t):
    return with_labels(long_shares(t)).select(
        *shares.KEYS, "variable", "category", "label", *shares.MEASURES
    )


@query
def share_wide(t):
    return all_answers(long_shares(t))


# --- labour ---


@query
def county_areas(t):
    return labor.county_areas(t.area())


@query
def series_of_counties(t):
    return labor.series_of(t.series(), labor.county_areas(t.area()))


@query
def labor_star(t):
    return star(t)


@query
def labor_long_typed(t):
    return labor.typed(star(t))


@query
def labor_wide(t):
    return months(t)


@query
def labor_yearly(t):
    return yearly_labor(t)


@query
def labor_yearly_no_annual(t):
    return labor.labor_yearly(months(t, "drop"))


# --- panel ---


@query
def county_year_panel(t):
    return merged(t)


@query
def county_year_panel_fips(t):
    keys = ("fips", "survey_year")
    wide = shares.share_wide(long_shares(t), VARIABLES)
    counties = labor.county_areas(t.area())
    by_month = labor.labor_wide(
        t.la_data(), labor.series_of(t.series(), counties), counties,
        keys=("fips", "year", "month"))
    return panel.merge_panel(wide, labor.labor_yearly(by_month, keys), keys)


@query
def statewide_trend_uw(t):
    return panel.mean_by_year(health_panel(t), [X, *HEALTH_UW])


@query
def statewide_trend_w(t):
    return panel.mean_by_year(health_panel(t), [X, *HEALTH_W])


@query
def alcohol_trend(t):
    return panel.mean_by_year(merged(t, ["any_alcohol_past_month"]), [X, *ALCOHOL_UW])


@query
def collapsed_health(t):
    return panel.collapsed_health(health_panel(t))


@query
def smoking_trend(t):
    return panel.smoking_trend(merged(t, ["current_smoking_frequency"]))


@query
def frequency_rate(t):
    return panel.frequency_shares(long_shares(t, ["eats_fruit"])).select(
        *shares.KEYS, "category", "weighted_percent", "daily_rate"
    )


@query
def expected_rate(t):
    return panel.expected_rate(long_shares(t, ["eats_fruit"], VARIABLES), yearly_labor(t))


@query
def county_order(t):
    return panel.county_order(health_panel(t))


@query
def county_year_matrix_x(t):
    return panel.county_year_matrix(health_panel(t), X, YEARS)


@query
def county_year_matrix_y(t):
    return panel.county_year_matrix(health_panel(t), Y, YEARS)


@query
def bubble_table(t):
    return panel.bubble_table(health_panel(t))


@query
def extreme_counties(t):
    one_year = health_panel(t).where(F.col("survey_year") == 2000)
    return panel.extreme_counties(one_year, by=POOLED)


@query
def extreme_counties_by_year(t):
    return panel.extreme_counties(health_panel(t), by=POOLED)


@query
def distinct_years(t):
    return panel.distinct_years(health_panel(t))


# --- regression ---


@query
def ols_health(t):
    fits = regression.fit_lines(health_panel(t))
    return fits.select("state_name", "outcome", "n", "slope", "intercept", "r2")


@query
def ols_summary(t):
    return regression.fit_summary(regression.fit_lines(health_panel(t)))


@query
def ols_by_year(t):
    fits = regression.fit_lines(health_panel(t), [Y], by=POOLED)
    return fits.select("survey_year", "outcome", "n", "slope", "intercept", "r2")


@query
def ols_pvalues(t):
    fits = regression.p_values(regression.fit_lines(health_panel(t)))
    return fits.select("state_name", "outcome", "n", "t_slope", "p_slope", "t_intercept",
                       "p_intercept")


# --- classes ---


@query
def yearly_cutoffs(t):
    return classify.cutoffs(health_panel(t))


@query
def quadrants(t):
    return classify.quadrants(health_panel(t))


@query
def income_tertiles(t):
    return classify.income_tertiles(t.income())


@query
def income_tertiles_fallback(t):
    return classify.income_tertiles(t.income_few())


@query
def tertile_edge_ties(t):
    return classify.coinciding_edges(t.income_few()).select("state_name", "survey_year", "values")


@query
def statewide_median(t):
    return classify.area_median(t.income())


@query
def common_years(t):
    return classify.common_years(respondents(t), t.income(), 1997, 2000)


@query
def dedup_by_name_key(t):
    region = t.counties().select("state_fips", "r_name").distinct()
    areas = t.area().withColumn("state_fips", F.substring("area_code", 3, 2)).join(
        region, "state_fips")
    bare = F.regexp_replace("area_text", r"[0-9]+", "")
    keyed = areas.select(
        name_key(bare, F.col("r_name"), F.substring("r_name", 1, 2)).alias("county_key"),
        "area_text", "area_code",
    )
    return classify.first_by_key(keyed, ["county_key"], ["area_text", "area_code"])


def matched_classes(t: Tables) -> DataFrame:
    state = F.col("state_name")
    return classify.matching_classes(
        classify.quadrants(health_panel(t)), classify.income_tertiles(t.income()),
        state, F.substring(state, 1, 2),
    )


@query
def income_alignment(t):
    return classify.agreement_by_year(matched_classes(t))


@query
def alignment_wide(t):
    return classify.agreement_wide(classify.agreement_by_year(matched_classes(t)))


def map_features(t: Tables) -> DataFrame:
    return documents.feature_names(t.feature_documents(), "document").select(
        "state_name", "feature_name").distinct()


@query
def quadrant_map_table(t):
    suffix = F.concat(F.lit(" County, "), F.col("state_name"))
    classes = classify.quadrants(health_panel(t))
    return classify.quadrant_map(map_features(t), classes, YEARS, suffix)


def income_map(t: Tables) -> DataFrame:
    brackets = classify.income_tertiles(t.income())
    return classify.tertile_map(map_features(t), brackets, YEARS, F.col("state_name"), F.substring("state_name", 1, 2))


@query
def tertile_map_table(t):
    return income_map(t)


@query
def tertile_match_count(t):
    return quality.map_match_rate(income_map(t))


# --- sources ---


@query
def null_tokens(t):
    return clean_missing(t.event_texts())


@query
def union_years_by_name(t):
    rows = respondents(t).select(
        "respondent_id", "survey_year", "general_health_status", "any_alcohol_past_month")
    early = rows.where("survey_year < 1998").select(
        "general_health_status", "survey_year", "respondent_id")
    return yearly.stack_by_name([early, rows.where("survey_year >= 1998")]).select(*rows.columns)


@query
def json_matrix_decode(t):
    replies = t.income_replies()
    return documents.income_table(replies, "reply", F.col("state_name"), F.substring("state_name", 1, 2))


@query
def feature_explode(t):
    return documents.feature_names(t.feature_documents(), "document").drop("properties")


@query
def year_resolution(t):
    return yearly.resolve_years(t.requested_years(), yearly.with_file_year(t.files()))


@query
def pending_years(t):
    return yearly.pending_years(t.order_years(), t.done_years())


@query
def manifest_duplicates(t):
    return manifest.duplicate_years(t.manifest())


@query
def manifest_latest(t):
    return manifest.latest_entries(t.manifest())


@query
def year_range(t):
    return survey.in_years(respondents(t).select("respondent_id", "survey_year"), 1996, 1999)


@query
def state_filter_name(t):
    named = named_rows(t).select("respondent_id", "state_name", "county_name")
    return survey.in_state(named, "asia", 2)


@query
def state_filter_code(t):
    return survey.in_state(t.survey_raw().select("respondent_id", "_state"), "asia", 2)


@query
def codebook_rename(t):
    return survey.rename_columns(t.survey_raw())


@query
def safe_select(t):
    raw = t.survey_raw()
    return raw.select(*survey.present(raw, ["respondent_id", "genhlth", "hlthplan", "_bmi", "fruit"]))


@query
def survey_socio_core(t):
    return survey.survey_table(named_rows(t), "socioeconomics_core")


@query
def survey_health_core(t):
    return survey.survey_table(named_rows(t), "health_core")


@query
def survey_socio_expanded(t):
    return survey.survey_table(named_rows(t), "socioeconomics_expanded")


@query
def survey_health_expanded(t):
    return survey.survey_table(named_rows(t), "health_expanded")


# --- quality ---


@query
def match_rate(t):
    return quality.match_rate(respondents(t), crosswalk(t))


@query
def first_fips(t):
    return quality.first_values(survey.county_codes(t.survey_raw()), "fips")


@query
def key_profile(t):
    return quality.key_profile(respondents(t))


@query
def empty_partitions(t):
    survey_rows = (
        survey.with_county_names(quality.code_counts(respondents(t)), crosswalk(t))
        .where(F.col("state_name").isNotNull())
        .groupBy("state_name", "survey_year").agg(F.sum("rows").alias("rows"))
    )
    states = crosswalk(t).select("state_name", F.substring("fips", 1, 2).alias("state_fips"))
    counties = labor.county_areas(t.area())
    per_series = t.la_data().groupBy("series_id", "year").agg(F.count("*").alias("rows"))
    labor_rows = (
        per_series.join(
            labor.series_places(labor.series_of(t.series(), counties), counties), "series_id")
        .groupBy("state_fips", F.col("year").try_cast("int").alias("survey_year"))
        .agg(F.sum("rows").alias("rows")).join(states.distinct(), "state_fips")
    )
    return quality.empty_partitions(states, survey_rows, labor_rows, FIRST_YEAR - 1, LAST_YEAR + 1)


@query
def run_summary(t):
    raw = t.survey_raw()
    years = raw.groupBy(F.col("year").alias("survey_year")).agg(F.count("*").alias("rows"))
    early = len(raw.columns) - 1  # as if the files before 1999 lacked a column
    cols = F.when(F.col("survey_year") < 1999, early).otherwise(len(raw.columns))
    return quality.run_summary(t.requested_years(), years.withColumn("cols", cols), t.done_years())


@query
def coverage_gaps(t):
    counties = survey.with_display_key(crosswalk(t))
    return quality.coverage_gaps(counties, health_panel(t), FIRST_YEAR, LAST_YEAR)


@query
def bad_values(t):
    survey_codes = quality.bad_values(t.survey_raw(), ["_state", "_cnty", "ctycode"])
    return survey_codes.union(quality.bad_values(t.la_data(), ["year", "value"]))


# --- announced analyses ---


@query
def describe_panel(t):
    return panel.describe_panel(health_panel(t), [X, *HEALTH_W])


@query
def corr_matrix(t):
    return panel.correlations(health_panel(t), [X, *HEALTH_W])


@query
def yearly_change(t):
    return panel.yearly_change(health_panel(t), X).select("state_name", "county_name", "survey_year", X, "change")


PLANE = [X, "labor_force_mean", "survey_year"]


@query
def lagged_correlation(t):
    return alignment.lagged_correlation(health_panel(t), HEALTH_W)


@query
def best_lag(t):
    return alignment.best_lag(alignment.lagged_correlation(health_panel(t), HEALTH_W)).select("state_name", "outcome", "lag", "n", "r")


@query
def difference_map_table(t):
    """From the year before the first to the year after the last, which no county has, so that near years stand in."""
    changes = alignment.changes_between(health_panel(t), Y, FIRST_YEAR - 1, LAST_YEAR + 1)
    return alignment.difference_map(map_features(t), changes, F.concat(F.lit(" County, "), F.col("state_name")))


@query
def ols_multi(t):
    return linear.fit_planes(health_panel(t), HEALTH_W, PLANE, by=()).drop("p")


@query
def ols_fixed_effects(t):
    fits = linear.fit_with_effects(health_panel(t), Y, PLANE[:2])
    return fits.drop("p")


@query
def downturn_phases(t):
    counties = months(t)
    names = crosswalk(t).select(F.substring("fips", 1, 2).alias("state_fips"), "state_name").distinct()
    rates = phases.county_rates(counties).unionByName(phases.state_rates(counties, names))
    return phases.downturn_phases(rates)


@query
def respondent_quantiles(t):
    """Of the respondents themselves; each group is half of them."""
    return quantiles.exact_quantiles(respondents(t), "final_weight", [0.05, 0.25, 0.5, 0.75, 0.95], ("respondent_sex",))


# --- round trips through written files ---


def one_file_per_year(t: Tables, folder: str) -> None:
    """The number of orders of each year as survey_<year>.csv, beside files that are none."""
    counts = t.read("orders").groupBy(F.year("o_orderdate").alias("survey_year")).agg(F.count("*").alias("rows"))
    parts = f"{folder}/parts"
    counts.select("survey_year", F.col("survey_year").alias("year"), "rows").repartition("survey_year").write.partitionBy(
        "survey_year").option("header", True).csv(parts)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    store.mkdirs(path(f"{folder}/files"))
    for year in store.listStatus(path(parts)):
        name = year.getPath().getName()
        if name.startswith("survey_year="):
            for file in store.listStatus(year.getPath()):
                if file.getPath().getName().endswith(".csv"):
                    store.rename(file.getPath(), path(f"{folder}/files/survey_{name[-4:]}.csv"))
    store.create(path(f"{folder}/files/notes_99.csv")).close()


@query
def discovered_files(t):
    folder = scratch_folder(t.spark, "yearly")
    one_file_per_year(t, folder)
    files = yearly.discover_files(t.spark, f"{folder}/files")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "survey_year")


@query
def yearly_files_read(t):
    folder = scratch_folder(t.spark, "yearly")
    one_file_per_year(t, folder)
    files = yearly.discover_files(t.spark, f"{folder}/files").collect()
    return yearly.read_years(t.spark, {r.survey_year: r.path for r in files})


@query
def years_at_once(t):
    """Orders in files by year whose columns stand in another order, and partly are others, in every second year."""
    folder = scratch_folder(t.spark, "drifting")
    orders = t.read("orders").withColumn("survey_year", F.year("o_orderdate"))
    kinds = {0: ["o_orderkey", "o_orderstatus", "o_custkey"], 1: ["o_orderpriority", "o_custkey", "o_orderkey"]}
    for kind, columns in kinds.items():
        rows = orders.where(F.col("survey_year") % 2 == kind).select("survey_year", *columns)
        rows.write.partitionBy("survey_year").option("header", True).csv(f"{folder}/{kind}")
    read = drifting.read_years_at_once(t.spark, folder, pattern=r"survey_year=(\d{4})/")
    return read.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "survey_year")


@query
def restated_figures(t):
    """Labour figures of which the first half of each year is issued again; the new issue lands first, and twice."""
    folder = scratch_folder(t.spark, "restated")
    first = t.la_data().withColumn("footnote_codes", F.lit(""))
    second = first.where("period <= 'M06'").withColumn("value", F.concat(F.lit("2"), "value"))
    for name, rows in (("a/issue=2", second), ("b/issue=1", first), ("c/issue=2", second)):
        out = rows.select(*DATA_COLUMNS).write.option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option("emptyValue", "")
        out.csv(f"{folder}/files/{name}")
    stream = restated.issued_figures(t.spark, f"{folder}/files", files_per_batch=8)
    restated.keep_latest(stream, f"{folder}/figures", f"{folder}/progress").awaitTermination()
    return restated.latest_figures(t.spark, f"{folder}/figures")


@query
def headerless_read(t):
    folder = scratch_folder(t.spark, "labour")
    lines = t.la_data().select("series_id", "year", "period", "value", F.lit("").alias("footnote_codes"))
    lines.write.option("sep", "\t").option("ignoreLeadingWhiteSpace", False).option("emptyValue", "").csv(folder)
    return read_without_header(t.spark, folder, DATA_COLUMNS)


@query
def written_years(t):
    folder = scratch_folder(t.spark, "years")
    rows = respondents(t).select("respondent_id", "survey_year", "general_health_status")
    sinks.write_partitioned(rows, folder, "survey_year")
    sinks.write_partitioned(rows.where("survey_year >= 1999"), folder, "survey_year")
    return yearly.read_landed(t.spark, folder)


def landed_survey(t: Tables, folder: str) -> str:
    raw = t.survey_raw().withColumn("survey_year", F.col("year"))
    sinks.write_partitioned(survey.normalise(raw).drop("year"), f"{folder}/landed", "survey_year")
    return f"{folder}/landed"


@query
def written_survey_table(t):
    folder = scratch_folder(t.spark, "survey")
    jobs.survey_tables(t.spark, landed_survey(t, folder), crosswalk(t), f"{folder}/tables")
    return t.spark.read.parquet(f"{folder}/tables/health_core")


@query
def months_by_state_folder(t):
    folder = scratch_folder(t.spark, "months")
    sinks.write_partitioned(months(t), folder, "state_fips")
    return t.spark.read.schema(jobs.months_schema()).parquet(folder)


@query
def written_panel(t):
    folder = scratch_folder(t.spark, "panel")
    long = long_shares(t, ["ever_told_high_bp", "ever_told_asthma"], VARIABLES)
    sinks.write_partitioned(long, f"{folder}/shares", "survey_year")
    written(yearly_labor(t), f"{folder}/yearly")
    out = jobs.panel_table(t.spark, f"{folder}/shares", f"{folder}/yearly", f"{folder}/panel")
    return out.select("fips", "state_name", "county_name", "survey_year", X, *[
        f"`{c}`" for c in out.columns if c.startswith(("ever_told_high_bp", "ever_told_asthma"))])


@query
def clustered_panel(t):
    folder = scratch_folder(t.spark, "clustered")
    long = long_shares(t, ["ever_told_high_bp", "ever_told_asthma"], VARIABLES)
    sinks.write_partitioned(long, f"{folder}/shares", "survey_year")
    written(yearly_labor(t), f"{folder}/yearly")
    name = "clustered_" + folder[-32:]
    out = jobs.clustered_panel(t.spark, f"{folder}/shares", f"{folder}/yearly", f"{folder}/tables", name, buckets=8)
    return out.select("fips", "state_name", "county_name", "survey_year", X, *[
        f"`{c}`" for c in out.columns if c.startswith(("ever_told_high_bp", "ever_told_asthma"))])


@query
def shares_after_landing(t):
    """Shares from counts of batches of files, as they would land year by year."""
    folder = scratch_folder(t.spark, "landing")
    rows = respondents(t).select("_state", "ctycode", "survey_year", "final_weight", *VARIABLES)
    rows.repartition("survey_year").write.parquet(f"{folder}/files")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/files")
    landed_counts.count_landed(stream, f"{folder}/counts", VARIABLES, f"{folder}/progress").awaitTermination()
    return shares.shares_of_codes(landed_counts.counted(t.spark, f"{folder}/counts"), crosswalk(t))


@query
def run_log_entries(t):
    folder = scratch_folder(t.spark, "log")
    sinks.append_run_log(run_summary(t), folder)
    sinks.append_run_log(run_summary(t).where("status = 'ok'"), folder)
    return sinks.read_run_log(t.spark, folder)


@query
def lower_column_names(t):
    raw = t.survey_raw().select("respondent_id", "_state", "genhlth", "year")
    return survey.lower_names(raw.toDF(*[f" {c.upper()} " for c in raw.columns]))


@query
def dropped_columns(t):
    raw = survey.normalise(t.survey_raw().select("respondent_id", "_state", "_cnty", "year", "age"))
    return raw.drop("year", "_state", "_cnty", "not_there")


@query
def state_of_file_name(t):
    name = F.concat(F.lit("x.data."), F.col("n_nationkey").cast("string"), F.lit("."), "r_name")
    return t.counties().select("n_nationkey", sinks.state_of_file(name).alias("state"))
