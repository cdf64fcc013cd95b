"""Names of survey columns and meanings of their answer codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.literal import literal_rows

# Raw survey column -> readable name, in output order, for the columns the
# four survey tables hold.
KEY_COLUMNS = {
    "fips": "fips",
    "county_name": "county_name",
    "state_name": "state_name",
    "year": "survey_year",
    "_finalwt": "final_weight",
}
SOCIO_CORE = {
    "age": "respondent_age",
    "sex": "respondent_sex",
    "race": "self_reported_race",
    "hispanic": "hispanic_ethnicity",
    "marital": "marital_status",
    "educa": "education_level",
    "employ": "employment_status",
    "income2": "household_income_category",
    "numadult": "num_adults_in_household",
    "nummen": "num_men_in_household",
    "numwomen": "num_women_in_household",
    "renthome": "housing_tenure_rent_vs_own",
    "enghfood": "food_security",
    "hlthplan": "has_any_health_plan",
    "medicar2": "covered_by_medicare",
    "medcost": "could_not_see_doctor_due_to_cost",
}
SOCIO_FURTHER = {
    "ctycode": "county_code",
    "numhhold": "num_households",
    "numphons": "num_phones",
    "famplan": "ever_used_family_planning",
    "mcrelngt": "length_time_on_medicare",
    "typcovr1": "coverage_type_primary",
    "typcovr2": "coverage_type_secondary",
    "nocov12": "no_health_coverage_12mo",
    "pastplan": "had_previous_plan",
    "rsnwocov": "reason_without_coverage",
    "_ageg": "age_category",
    "_ageg5yr": "age_group_5yr",
    "_age65yr": "age65plus_flag",
}
HEALTH_CORE = {
    "genhlth": "general_health_status",
    "physhlth": "days_physical_health_not_good",
    "menthlth": "days_mental_health_not_good",
    "poorhlth": "days_poor_health_limited_activities",
    "bphigh": "ever_told_high_bp",
    "diabetes": "ever_told_diabetes",
    "smoke100": "smoked_100_cigarettes",
    "smokeday": "current_smoking_frequency",
    "drinkany": "any_alcohol_past_month",
    "alcohol": "avg_drinks_per_week",
    "_bmi": "body_mass_index",
    "weight": "respondent_weight_pounds",
    "height": "respondent_height_inches",
    "fruit": "eats_fruit",
    "vegetabl": "eats_other_vegetables",
    "exerany": "any_physical_activity",
}
HEALTH_FURTHER = {
    "cholchk": "cholesterol_checked_5yr",
    "toldhi": "ever_told_high_cholesterol",
    "asthma": "ever_told_asthma",
    "asthnow": "currently_has_asthma",
    "cvdinfar": "ever_told_heart_attack",
    "cvdcorhd": "ever_told_coronary_heart_disease",
    "cvdstrok": "ever_told_stroke",
    "havarth": "ever_told_arthritis",
    "flushot": "flu_shot_past_year",
    "hadsigm": "ever_had_sigmoidoscopy_colonoscopy",
    "hadmam": "ever_had_mammogram",
    "hadpap": "ever_had_pap_smear",
    "denclean": "teeth_cleaned_by_dentist",
    "lastden2": "last_dentist_visit",
    "_rfhype2": "high_blood_pressure_flag",
    "_rfobese": "obesity_flag",
    "_rfwhbmi": "overweight_or_obese_flag",
    "_smoker2": "smoking_status_recode",
    "_rftobac": "tobacco_use_flag",
}

# Answers that are amounts, not categories.
AMOUNTS = [
    "days_physical_health_not_good", "days_mental_health_not_good",
    "days_poor_health_limited_activities", "avg_drinks_per_week", "body_mass_index",
    "respondent_weight_pounds", "respondent_height_inches",
]

# Meaning of answer codes by variable.
YES_NO = {"1.0": "Yes", "2.0": "No", "7.0": "Dont know", "9.0": "Refused"}
CODEBOOK = {
    "general_health_status": {
        "1.0": "Excellent", "2.0": "Very good", "3.0": "Good", "4.0": "Fair", "5.0": "Poor",
        "7.0": "Dont know", "9.0": "Refused",
    },
    "ever_told_high_bp": YES_NO,
    "ever_told_diabetes": {
        "1.0": "Yes", "2.0": "No", "3.0": "Pregnancy", "4.0": "Prediabetes",
        "7.0": "Dont know", "9.0": "Refused",
    },
    "smoked_100_cigarettes": YES_NO,
    "current_smoking_frequency": {
        "1.0": "Every day", "2.0": "Some days", "3.0": "Not at all",
        "7.0": "Dont know", "9.0": "Refused",
    },
    "any_alcohol_past_month": YES_NO,
    "eats_fruit": YES_NO,
    "eats_other_vegetables": YES_NO,
    "any_physical_activity": YES_NO,
}

# The four survey tables, each the key columns plus these.
SURVEY_TABLES = {
    "socioeconomics_core": SOCIO_CORE,
    "health_core": HEALTH_CORE,
    "socioeconomics_expanded": SOCIO_CORE | SOCIO_FURTHER,
    "health_expanded": HEALTH_CORE | HEALTH_FURTHER,
}

CATEGORICAL = [n for n in (HEALTH_CORE | HEALTH_FURTHER).values() if n not in AMOUNTS]


def merge_name_maps(*maps: dict[str, str | None]) -> dict[str, str]:
    """Maps joined in order, the later entry wins; entries without a target are dropped."""
    merged: dict[str, str | None] = {}
    for names in maps:
        merged |= names
    return {raw: name for raw, name in merged.items() if name is not None}


def readable_names(further: dict[str, str | None] | None = None) -> dict[str, str]:
    """Raw -> readable for every column of the survey tables, and any further ones given.

    Columns outside the survey tables never reach a result; a caller who keeps more of
    the raw survey passes the names wanted for them, usually from `read_name_map`.
    """
    return merge_name_maps(
        KEY_COLUMNS, SOCIO_CORE, SOCIO_FURTHER, HEALTH_CORE, HEALTH_FURTHER, further or {}
    )


def read_name_map(spark: SparkSession, path: str) -> dict[str, str]:
    """Names from a two-column CSV (raw, name) with one line per survey column."""
    rows = spark.read.schema("raw string, name string").option("header", True).csv(path)
    return {r["raw"]: r["name"] for r in rows.where(F.col("name").isNotNull()).toLocalIterator()}


def codebook_table(spark: SparkSession) -> DataFrame:
    """(variable, category, label): one row per code of the codebook above."""
    rows = [(v, code, label) for v, codes in CODEBOOK.items() for code, label in codes.items()]
    return literal_rows(spark, ["variable", "category", "label"], rows)


def with_labels(shares: DataFrame) -> DataFrame:
    """Adds `label`, the meaning of (variable, category); an unlisted code is its own label.

    The codebook is a constant of this module, so it is broadcast.
    """
    book = codebook_table(shares.sparkSession)
    return (
        shares.join(F.broadcast(book), ["variable", "category"], "left")
        .withColumn("label", F.coalesce("label", "category"))
    )


def share_columns(variables=None) -> list[str]:
    """Names "<variable>_<label>" of the wide table, for all or some codebook variables."""
    return [
        f"{variable}_{label}"
        for variable, codes in CODEBOOK.items()
        if variables is None or variable in variables
        for label in codes.values()
    ]
