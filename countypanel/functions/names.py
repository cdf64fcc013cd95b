"""County names: display keys and keys for matching differently written names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import BLANKS

# Postal abbreviations of the states and DC.
POSTAL = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL",
    "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI",
    "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO", "Montana": "MT",
    "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND",
    "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN",
    "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def _strip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def state_abbreviation(state: Column, style: str = "usps") -> Column:
    """Short form of a state name.

    "usps" is the postal form; a name that is no state stays whole. "prefix2" is the first
    two letters, which some existing panels use. It is no key: several states share it.
    """
    state = _strip(state)
    if style == "prefix2":
        return F.upper(F.substring(state, 1, 2))
    if style == "usps":
        pairs = [F.lit(text) for pair in POSTAL.items() for text in pair]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), state), state)
    raise ValueError(f"unknown style {style!r}")


def display_key(county: Column, state: Column, style: str = "usps") -> Column:
    """"County name, ST"; NULL when either part is missing."""
    return F.concat(_strip(county), F.lit(", "), state_abbreviation(state, style))


def strip_suffix_text(col: Column, suffix: str | Column) -> Column:
    """The text without a literal piece such as " County, CA"."""
    return F.replace(col, F.lit(suffix) if isinstance(suffix, str) else suffix, F.lit(""))


def _quoted(value: str | Column) -> Column:
    if isinstance(value, str):
        return F.lit(re.escape(value.lower()))
    return F.concat(F.lit("\\Q"), F.lower(value), F.lit("\\E"))


def name_key(col: Column, state: str | Column, abbreviation: str | Column) -> Column:
    """Key under which two spellings of a county name meet.

    `state` and `abbreviation` may be columns, so one pass serves many states. The
    words "county" and "city and county of" and a trailing state go, "St." becomes
    "saint", every other sign becomes a blank; a missing name gives the empty key.
    """
    trailing_state = F.concat(
        F.lit(r"(?:,\s*"), _quoted(abbreviation), F.lit(r")?(?:,\s*"), _quoted(state), F.lit(r")?$")
    )
    key = F.replace(F.lower(col), F.lit("&"), F.lit(" and "))
    key = F.regexp_replace(key, trailing_state, F.lit(""))
    key = F.regexp_replace(key, r"\b(?:city and county of|county)\b", "")
    key = F.regexp_replace(key, r"\bst\.?\b", "saint")
    key = F.regexp_replace(key, r"[^a-z0-9]+", " ")
    return F.coalesce(F.trim(key), F.lit(""))
