"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the definition of each query and sharing no code with the operators, apart
from the fixed answer codes. Common table expressions stand for the derived inputs.
"""

from __future__ import annotations

from ..operators.codebook import CODEBOOK
from .standins import FIRST_YEAR, LAST_YEAR, YEARS

STANDIN_VARIABLES = [
    "general_health_status", "current_smoking_frequency", "ever_told_high_bp",
    "any_alcohol_past_month", "eats_fruit", "ever_told_asthma",
]


def pad(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


def r6(expression: str, name: str) -> str:
    return f'round({expression}, 6) AS "{name}"'


def name_key(text: str, state: str, abbreviation: str) -> str:
    """The words of a name without its state, one by one."""
    key = f"replace(lower({text}), '&', ' and ')"
    for name in (state, abbreviation):
        tail = f"', ' || lower({name})"
        key = f"(CASE WHEN suffix({key}, {tail}) THEN left({key}, length({key}) - length({tail})) ELSE {key} END)"
    words = f"list_filter(regexp_split_to_array({key}, '[^a-z0-9]+'), lambda x: x <> '')"
    plain = f"replace(' ' || array_to_string({words}, ' ') || ' ', ' city and county of ', ' ')"
    kept = f"list_filter(string_split({plain}, ' '), lambda x: x <> '' AND x <> 'county')"
    spelled = f"list_transform({kept}, lambda x: CASE WHEN x = 'st' THEN 'saint' ELSE x END)"
    return f"coalesce(array_to_string({spelled}, ' '), '')"


CTES = {}

CTES["counties"] = f"""
SELECT n_nationkey, n_regionkey, 'NATION_' || (n_nationkey // 5)::VARCHAR AS n_name, 'New ' || r_name AS r_name,
  {pad("n_regionkey::VARCHAR", 2)} AS state_fips, {pad("n_nationkey::VARCHAR", 3)} AS county_fips
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["geocodes"] = f"""
SELECT '010' AS level, '00' AS state_fips, '000' AS county_fips, 'United States' AS area_name
UNION ALL SELECT '040', {pad("r_regionkey::VARCHAR", 2)}, '000', 'New ' || r_name FROM region
UNION ALL SELECT '050', state_fips, county_fips, n_name || ' County' FROM counties
UNION ALL SELECT '162', state_fips, '000', s_name
  FROM supplier JOIN counties ON s_nationkey = n_nationkey"""

CTES["crosswalk"] = """
SELECT c.state_fips || c.county_fips AS fips, s.area_name AS state_name, c.area_name AS county_name
FROM geocodes c LEFT JOIN (SELECT * FROM geocodes WHERE level = '040') s
  ON c.state_fips = s.state_fips
WHERE c.level = '050'"""

CTES["survey_raw"] = """
SELECT o_orderkey AS respondent_id, n_regionkey::VARCHAR || '.0' AS _state,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN '777'
       ELSE n_nationkey::VARCHAR || '.0' END AS ctycode,
  CASE WHEN o_orderkey % 61 = 0 THEN 'x' WHEN o_orderkey % 67 = 0 THEN '6.5'
       ELSE n_nationkey::VARCHAR || '.0' END AS _cnty,
  year(o_orderdate)::INTEGER AS survey_year,
  CASE WHEN o_orderkey % 31 <> 0 THEN o_totalprice END AS final_weight,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 8.0::DOUBLE
    ELSE left(o_orderpriority, 1)::DOUBLE END AS general_health_status,
  CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 2.0::DOUBLE WHEN 'P' THEN 3.0::DOUBLE END
    AS current_smoking_frequency,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1.0::DOUBLE WHEN 'BUILDING' THEN 2.0::DOUBLE
    WHEN 'FURNITURE' THEN 7.0::DOUBLE WHEN 'HOUSEHOLD' THEN 9.0::DOUBLE END AS ever_told_high_bp,
  CASE WHEN year(o_orderdate) >= 1998 THEN (o_orderkey % 2 + 1)::DOUBLE END AS any_alcohol_past_month,
  CASE WHEN o_orderkey % 13 = 0 THEN 555.0::DOUBLE
    ELSE (100 + o_custkey % 3 * 100 + o_orderkey % 40)::DOUBLE END AS eats_fruit,
  (o_custkey % 70 + 18)::INTEGER AS respondent_age, (o_custkey % 2 + 1)::INTEGER AS respondent_sex,
  floor(c_acctbal / 1000)::INTEGER AS household_income_category,
  (o_custkey % 5 + 1)::INTEGER AS num_adults_in_household,
  (o_custkey % 6 + 1)::INTEGER AS age_category, (o_orderkey % 3 + 1)::DOUBLE AS ever_told_asthma,
  CASE WHEN o_totalprice > 200000 THEN 2 ELSE 1 END AS obesity_flag
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_STATE_DIGITS = r"coalesce(regexp_extract(_state, '(\d+)', 1), '')"
_COUNTY_DIGITS = r"coalesce(regexp_extract(ctycode, '(\d+)', 1), '')"
CTES["coded"] = f"""
SELECT * REPLACE ({pad(_STATE_DIGITS, 2)} AS _state, {pad(_COUNTY_DIGITS, 3)} AS ctycode),
  ({pad(_STATE_DIGITS, 2)}) || ({pad(_COUNTY_DIGITS, 3)}) AS fips
FROM survey_raw"""

CTES["named"] = """
SELECT c.*, w.state_name, w.county_name,
  w.county_name || ', ' || w.state_name AS display_name
FROM coded c LEFT JOIN crosswalk w ON c.fips = w.fips
WHERE ctycode <> '000'"""

CTES["answers"] = "\nUNION ALL\n".join(
    f"SELECT fips, state_name, display_name AS county_name, survey_year, '{v}' AS variable, "
    f"{v}::VARCHAR AS category, final_weight FROM named "
    f"WHERE {v} IS NOT NULL AND display_name IS NOT NULL"
    for v in STANDIN_VARIABLES
)

CTES["counted"] = """
SELECT fips, state_name, county_name, survey_year, variable, category, count(*)::BIGINT AS unweighted_count,
  coalesce(sum(final_weight), 0) AS weighted_count
FROM answers GROUP BY ALL"""

CTES["shares"] = """
SELECT *,
  100.0 * unweighted_count / nullif(sum(unweighted_count) OVER g, 0) AS unweighted_percent,
  100.0 * weighted_count / nullif(sum(weighted_count) OVER g, 0) AS weighted_percent
FROM counted WINDOW g AS (PARTITION BY fips, survey_year, variable)"""

CTES["codebook"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{v}', '{code}', '{label}')" for v, codes in CODEBOOK.items() for code, label in codes.items()
) + ") AS t(variable, category, label)"

CTES["labeled"] = """
SELECT s.*, coalesce(b.label, s.category) AS label
FROM shares s LEFT JOIN codebook b ON s.variable = b.variable AND s.category = b.category"""

LISTED = [f"{v}_{label}" for v in CODEBOOK if v in STANDIN_VARIABLES for label in CODEBOOK[v].values()]
FRUIT = [100 + 100 * period + count for period in range(3) for count in range(40)] + [555]
WIDE = LISTED + [f"eats_fruit_{code}.0" for code in FRUIT] + ["general_health_status_8.0"] + [
    f"ever_told_asthma_{code}.0" for code in (1, 2, 3)]


def _cell(name: str, kind: str) -> str:
    percent = "unweighted_percent" if kind == "uw" else "weighted_percent"
    return (f"coalesce(avg(CASE WHEN variable || '_' || label = '{name}' THEN {percent} END), 0) "
            f'AS "{name}_{kind}"')


CTES["wide"] = (
    "SELECT fips, state_name, county_name, survey_year, "
    + ", ".join(_cell(name, kind) for kind in ("uw", "w") for name in WIDE)
    + " FROM labeled GROUP BY fips, state_name, county_name, survey_year"
)

CTES["area"] = f"""
SELECT 'A' AS area_type_code, 'ST' || ({pad("r_regionkey::VARCHAR", 2)}) || '00000000000' AS area_code,
  'New ' || r_name AS area_text FROM region
UNION ALL SELECT 'F', 'CN' || state_fips || county_fips || '0000000',
  n_name || ' County, ' || upper(left(r_name, 2)) FROM counties
UNION ALL SELECT 'G', 'CT' || state_fips || ({pad("s_suppkey::VARCHAR", 11)}), s_name
  FROM supplier JOIN counties ON s_nationkey = n_nationkey"""

CTES["county_area"] = """
SELECT area_code, area_text, substr(area_code, 3, 2) AS state_fips FROM area
WHERE area_type_code = 'F' AND area_code LIKE 'CN%'"""

CTES["series"] = """
SELECT 'LAU' || area_code || m AS series_id, area_type_code, area_code, m AS measure_code, 'U' AS seasonal
FROM area, (VALUES ('03'), ('04'), ('05'), ('06')) v(m)
UNION ALL SELECT 'series_id', 'area_type_code', 'area_code', 'measure_code', 'seasonal'"""

CTES["la_data"] = f"""
SELECT 'LAUCN' || state_fips || county_fips || '0000000' || ({pad("(3 + l_linenumber % 4)::VARCHAR", 2)})
    AS series_id,
  year(l_shipdate)::VARCHAR AS year,
  'M' || CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '13'
    ELSE {pad("month(l_shipdate)::VARCHAR", 2)} END AS period,
  CASE WHEN l_orderkey % 10 = 0
      OR (n_nationkey = 3 AND year(l_shipdate) = 1996 AND month(l_shipdate) = 2) THEN '-'
    ELSE ' ' || l_quantity::VARCHAR END AS value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN counties ON s_nationkey = n_nationkey"""

CTES["star"] = """
SELECT a.area_code, d.series_id, d.year, d.period, d.value, s.measure_code, a.area_text, a.state_fips
FROM la_data d JOIN series s ON d.series_id = s.series_id JOIN county_area a ON s.area_code = a.area_code"""

CTES["typed"] = """
SELECT substr(area_code, 3, 5) AS fips, state_fips, area_code, area_text AS county, measure_code, year::INTEGER AS year,
  substr(period, 2)::INTEGER AS month, try_cast(trim(value) AS DOUBLE) AS value FROM star"""

MEASURE_NAMES = {
    "employment": "05", "unemployment": "06", "labor_force": "04", "unemployment_rate": "03",
}


def _months(source: str) -> str:
    cells = ", ".join(
        f"avg(value) FILTER (WHERE measure_code = '{code}') AS {name}"
        for name, code in MEASURE_NAMES.items()
    )
    return (f"SELECT fips, state_fips, county, year, month, {cells} FROM {source} "
            "GROUP BY fips, state_fips, county, year, month HAVING count(value) > 0")


def _yearly(source: str) -> str:
    cells = ", ".join(
        f"{fn}({name}) AS {name}_{label}"
        for name in MEASURE_NAMES
        for label, fn in (("mean", "avg"), ("min", "min"), ("max", "max"))
    )
    return f"SELECT fips, county AS county_name, year AS survey_year, {cells} FROM {source} GROUP BY 1, 2, 3"


CTES["months"] = _months("typed")
CTES["yearly"] = _yearly("months")
CTES["months_only"] = _months("(SELECT * FROM typed WHERE month <> 13)")
CTES["yearly_months_only"] = _yearly("months_only")

CTES["panel"] = """
SELECT w.*, y.* EXCLUDE (fips, county_name, survey_year)
FROM wide w JOIN yearly y ON w.fips = y.fips AND w.survey_year = y.survey_year"""

X = "unemployment_rate_mean"
Y = '"general_health_status_Excellent_w"'

CTES["income"] = f"""
SELECT r_name AS state_name, survey_year, state_fips || county_fips AS county_fips,
  n_name || ' County, ' || r_name AS county_name_full,
  lower(replace(n_name, '_', ' ')) AS county_key, median_income
FROM (SELECT c_nationkey, year(o_orderdate)::INTEGER AS survey_year, round(avg(o_totalprice)) AS median_income
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
JOIN counties ON c_nationkey = n_nationkey"""

CTES["income_few"] = """
SELECT * REPLACE (CASE WHEN survey_year = 1996 AND suffix(county_key, '1') THEN 1000.0::DOUBLE
  WHEN survey_year = 1996 THEN 2000.0::DOUBLE WHEN survey_year = 1997 THEN 3000.0::DOUBLE
  WHEN survey_year = 1998 AND suffix(county_key, '0') THEN 1000.0::DOUBLE
  WHEN survey_year = 1998 AND suffix(county_key, '4') THEN 3000.0::DOUBLE
  WHEN survey_year = 1998 THEN 2000.0::DOUBLE
  ELSE median_income END AS median_income) FROM income"""


def _tertiles(source: str) -> str:
    return f"""
SELECT i.*, CASE WHEN n_values >= 3 THEN
    CASE WHEN median_income <= q1 THEN 'Low' WHEN median_income <= q2 THEN 'Middle' ELSE 'High' END
  WHEN lo = hi THEN 'Middle' WHEN median_income = lo THEN 'Low' ELSE 'High' END AS income_bracket
FROM {source} i JOIN (
  SELECT state_name, survey_year, count(DISTINCT median_income) AS n_values, min(median_income) AS lo,
    max(median_income) AS hi, quantile_cont(median_income, 1.0::DOUBLE / 3.0::DOUBLE) AS q1,
    quantile_cont(median_income, 2.0::DOUBLE / 3.0::DOUBLE) AS q2
  FROM {source} GROUP BY state_name, survey_year) e USING (state_name, survey_year)"""


TERTILE_COLUMNS = ("state_name, survey_year, county_fips, county_name_full, county_key, median_income, "
                   "income_bracket")
CTES["tertiles"] = f"SELECT {TERTILE_COLUMNS} FROM ({_tertiles('income')})"

CTES["cuts"] = f"""SELECT state_name, survey_year, median({X}) AS x_cut, median({Y}) AS y_cut
FROM panel GROUP BY 1, 2"""

CTES["quads"] = f"""
SELECT state_name, survey_year, county_name, {X}, {Y}, u_bin, h_bin,
  CASE WHEN u_bin = 0 THEN 'Low' ELSE 'High' END || ' unemployment + ' ||
  CASE WHEN h_bin = 0 THEN 'High' ELSE 'Low' END || ' % Excellent Health' AS quadrant,
  CASE WHEN h_bin = 0 AND u_bin = 0 THEN '#2ca25f' WHEN h_bin = 0 THEN '#1f9fb5'
    WHEN u_bin = 0 THEN '#fdae61' ELSE '#d73027' END AS color
FROM (SELECT p.*, coalesce((round({X}, 9) > round(x_cut, 9))::INTEGER, 0) AS u_bin,
        coalesce((round({Y}, 9) <= round(y_cut, 9))::INTEGER, 0) AS h_bin
      FROM panel p JOIN cuts USING (state_name, survey_year))"""

CTES["matched"] = """
SELECT q.state_name, q.survey_year, q.quadrant, t.income_bracket,
  CASE WHEN income_bracket = 'High' AND quadrant LIKE 'Low%High%' THEN 'Green ↔ Green'
    WHEN income_bracket = 'Low' AND quadrant LIKE 'High%Low%' THEN 'Red ↔ Red'
    WHEN income_bracket = 'Middle' AND quadrant LIKE 'High%+ High%' THEN 'Middle ↔ Teal'
    WHEN income_bracket = 'Middle' AND quadrant LIKE 'Low%+ Low%' THEN 'Middle ↔ Yellow'
    ELSE 'Mismatch' END AS alignment
FROM quads q JOIN tertiles t ON q.state_name = t.state_name AND q.survey_year = t.survey_year
  AND lower(replace(split_part(q.county_name, ' County', 1), '_', ' ')) = t.county_key"""

CTES["agreement"] = """
SELECT state_name, survey_year, alignment, count(*)::BIGINT AS count,
  round_even(round(count(*) / sum(count(*)) OVER (PARTITION BY state_name, survey_year) * 100, 9), 1) AS percent
FROM matched GROUP BY state_name, survey_year, alignment"""

CTES["order_years"] = "SELECT DISTINCT year(o_orderdate)::INTEGER AS survey_year FROM orders"
CTES["requested"] = "SELECT survey_year FROM order_years UNION SELECT survey_year + 1 FROM order_years"

CTES["features"] = """
SELECT r_name AS state_name, n_name AS feature_name FROM customer JOIN counties ON c_nationkey = n_nationkey
UNION SELECT r_name, r_name FROM customer JOIN counties ON c_nationkey = n_nationkey"""

_YEAR_ROWS = "(VALUES " + ", ".join(f"({y})" for y in YEARS) + ") y(survey_year)"

CTES["income_map"] = f"""
SELECT f.state_name, y.survey_year::INTEGER AS survey_year, feature_name,
  lower(replace(feature_name, '_', ' ')) AS county_key, median_income::BIGINT AS mhi,
  coalesce('$' || format('{{:,}}', median_income::BIGINT), 'No data') AS mhi_fmt,
  coalesce(income_bracket, 'No data') AS mhi_bracket,
  CASE income_bracket WHEN 'Low' THEN '#d73027' WHEN 'Middle' THEN '#fee08b'
    WHEN 'High' THEN '#1a9850' ELSE '#000000' END AS fill_col
FROM features f CROSS JOIN {_YEAR_ROWS}
LEFT JOIN tertiles t ON t.state_name = f.state_name AND t.survey_year = y.survey_year
  AND t.county_key = lower(replace(feature_name, '_', ' '))"""

ORDER = list(CTES)


def with_inputs(body: str) -> str:
    """The body after the table expressions; DuckDB evaluates only the ones it uses."""
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ORDER) + "\n" + body


def _share_columns(extra: str = "") -> str:
    return (f"fips, state_name, county_name, survey_year, variable, category, {extra} unweighted_count, "
            + ", ".join([r6("unweighted_percent", "unweighted_percent"),
                         r6("weighted_count", "weighted_count"),
                         r6("weighted_percent", "weighted_percent")]))


def _rounded(names) -> str:
    return ", ".join(r6(f'"{n}"', n) for n in names)


WIDE_NAMES = [f"{n}_{k}" for k in ("uw", "w") for n in WIDE]
YEARLY_NAMES = [f"{m}_{f}" for m in MEASURE_NAMES for f in ("mean", "min", "max")]
HEALTH_LABELS = ["Excellent", "Very good", "Good", "Fair", "Poor"]
HEALTH_W = [f"general_health_status_{h}_w" for h in HEALTH_LABELS]
HEALTH_UW = [f"general_health_status_{h}_uw" for h in HEALTH_LABELS]
ALCOHOL = [f"any_alcohol_past_month_{a}_uw" for a in ("Yes", "No", "Dont know", "Refused")]


def _trend(names) -> str:
    return ("SELECT state_name, survey_year, " + ", ".join(r6(f'avg("{n}")', n) for n in names)
            + " FROM panel GROUP BY state_name, survey_year")


def _matrix(column: str) -> str:
    cells = ", ".join(
        r6(f"avg({column}) FILTER (WHERE survey_year = {y})", f"y{y}") for y in YEARS)
    return f"""SELECT state_name, row_number() OVER (PARTITION BY state_name
  ORDER BY round(avg({X}), 9) DESC NULLS LAST, county_name)::INTEGER AS position, county_name, {cells}
FROM panel GROUP BY state_name, county_name"""


def _extremes(where: str) -> str:
    x, y = f"round({X}, 9)", f"round({Y}, 9)"
    marks = {"top_x": f"{x} DESC", "low_x": f"{x} ASC", "top_y": f"{y} DESC", "low_y": f"{y} ASC"}
    ranks = ", ".join(
        f"row_number() OVER (PARTITION BY survey_year ORDER BY {order} NULLS LAST, county_name) <= 3 AS {m}"
        for m, order in marks.items())
    return f"""SELECT survey_year, county_name, {r6(X, X)}, {r6(Y, Y.strip('"'))}, {", ".join(marks)}
FROM (SELECT *, {ranks} FROM panel WHERE {where}) WHERE {" OR ".join(marks)}"""


OUTCOMES = ["general_health_status_Excellent_w", "general_health_status_Excellent_uw",
            "general_health_status_Poor_w", "general_health_status_Poor_uw"]


def _fits(by: str, outcomes) -> str:
    """Sums of squares by plain formulas, so that a group without spread gives NULL."""
    rows = " UNION ALL ".join(
        f"""SELECT {by}, '{o}' AS outcome, {X} AS x, "{o}" AS y FROM panel
        WHERE {X} IS NOT NULL AND "{o}" IS NOT NULL""" for o in outcomes)
    return f"""SELECT {by}, outcome, count(*)::BIGINT AS n, avg(x) AS mx, avg(y) AS my,
  regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy FROM ({rows}) GROUP BY {by}, outcome"""


def _fit_columns() -> str:
    return f"""{r6("sxy / nullif(sxx, 0)", "slope")}, {r6("my - sxy / nullif(sxx, 0) * mx", "intercept")},
  {r6("CASE WHEN sxx = 0 THEN NULL WHEN syy = 0 THEN 1.0 ELSE sxy * sxy / (sxx * syy) END", "r2")}"""


OLS_SUMMARY = f"""
SELECT state_name, outcome, n, {_fit_columns()},
  {r6("1 - (1 - sxy * sxy / (sxx * syy)) * (n - 1) / (n - 2)", "adj_r2")},
  {r6("sqrt(mse / sxx)", "se_slope")}, {r6("sqrt(mse * (1.0 / n + mx * mx / sxx))", "se_intercept")},
  {r6("sxy / sxx / sqrt(mse / sxx)", "t_slope")},
  {r6("(my - sxy / sxx * mx) / sqrt(mse * (1.0 / n + mx * mx / sxx))", "t_intercept")},
  {r6("sxy * sxy / sxx / mse", "f_value")}, {r6("ll", "loglik")}, {r6("4 - 2 * ll", "aic")},
  {r6("2 * ln(n) - 2 * ll", "bic")}
FROM (SELECT *, -n / 2.0 * (ln(2 * pi()) + ln(mse * (n - 2) / n) + 1) AS ll
      FROM (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS mse FROM ({_fits("state_name", OUTCOMES)})))"""



def _tail(t: str, name: str) -> str:
    """Two-sided p-value by Simpson's rule over Student's density from 0 to |t|."""
    free, steps = "(n - 2)", 4000
    density = f"pow(1 + pow(abs({t}) * i / {steps}, 2) / {free}, -({free} + 1) / 2.0)"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * {density})) * abs({t}) / {3 * steps}"
    constant = f"exp(lgamma(({free} + 1) / 2.0) - lgamma({free} / 2.0)) / sqrt({free} * pi())"
    return r6(f"1 - 2 * {constant} * {area}", name)


def _lagged() -> str:
    """Every pair of years `lag` apart by a join for each, as the definition says."""
    pairs = " UNION ALL ".join(
        f"""SELECT a.state_name, '{h}' AS outcome, l.lag, a.{X} AS x, b."{h}" AS y FROM panel a
        CROSS JOIN (VALUES (-3), (-2), (-1), (0), (1), (2), (3)) l(lag)
        LEFT JOIN panel b ON b.fips = a.fips AND b.survey_year = a.survey_year + l.lag""" for h in HEALTH_W)
    return f"""SELECT *, CASE WHEN n > 2 AND round(1 - r * r, 9) > 0 THEN r * sqrt((n - 2) / (1 - r * r)) END AS t FROM (
      SELECT state_name, outcome, lag, regr_count(y, x)::BIGINT AS n,
        CASE WHEN regr_count(y, x) > 1 AND regr_sxx(y, x) > 0 AND regr_syy(y, x) > 0
          THEN regr_sxy(y, x) / sqrt(regr_sxx(y, x) * regr_syy(y, x)) END AS r
      FROM ({pairs}) GROUP BY state_name, outcome, lag)"""


def _difference_map() -> str:
    hits = f"""SELECT fips, w.target, survey_year, {Y} AS v FROM panel
      JOIN (VALUES ({FIRST_YEAR - 1}), ({LAST_YEAR + 1})) w(target) ON abs(survey_year - w.target) <= 1 AND {Y} IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY fips, w.target ORDER BY abs(survey_year - w.target), survey_year) = 1"""
    return f"""SELECT f.state_name, f.feature_name, from_year, to_year, {_rounded(["from_value", "to_value", "change"])},
      {r6("change / (to_year - from_year)", "yearly")}, {r6("100 * change / nullif(abs(from_value), 0)", "percent")},
      CASE WHEN change IS NULL THEN 'No data' WHEN round(change, 9) > 0 THEN 'increase'
        WHEN round(change, 9) < 0 THEN 'decrease' ELSE 'no change' END AS class,
      CASE WHEN change IS NULL THEN '#000000' WHEN round(change, 9) > 0 THEN '#b2182b'
        WHEN round(change, 9) < 0 THEN '#2166ac' ELSE '#f7f7f7' END AS color
      FROM features f LEFT JOIN (
        SELECT *, CASE WHEN to_year > from_year THEN to_value - from_value END AS change FROM (
          SELECT p.state_name, split_part(p.county_name, ' County', 1) AS feature_name,
            a.survey_year AS from_year, b.survey_year AS to_year, a.v AS from_value, b.v AS to_value
          FROM (SELECT DISTINCT fips, state_name, county_name FROM panel) p
          LEFT JOIN (SELECT * FROM ({hits}) WHERE target < {FIRST_YEAR}) a ON a.fips = p.fips
          LEFT JOIN (SELECT * FROM ({hits}) WHERE target > {LAST_YEAR}) b ON b.fips = p.fips)) c
      ON c.state_name = f.state_name AND c.feature_name = f.feature_name"""


def _planes() -> str:
    """Three regressors yb Cramer's rule."""
    names = [X, "labor_force_mean", "survey_year"]
    x = dict(zip("abc", names))
    sums = ", ".join(f"covar_pop({u}, {v}) * count(*) AS {u}{v}" for u, v in ("aa", "ab", "ac", "bb", "bc", "cc", "ya", "yb", "yc", "yy"))
    rows = " UNION ALL ".join(
        f"""SELECT '{h}' AS outcome, {", ".join(f"{c}::DOUBLE AS {k}" for k, c in x.items())}, "{h}" AS y FROM panel
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in names)} AND "{h}" IS NOT NULL""" for h in HEALTH_W)
    inverse = {
        "ia": "(bb * cc - bc * bc) / d", "ib": "(aa * cc - ac * ac) / d", "ic": "(aa * bb - ab * ab) / d",
        "iab": "(ac * bc - ab * cc) / d", "iac": "(ab * bc - ac * bb) / d", "ibc": "(ab * ac - aa * bc) / d"}
    terms = [("'intercept'", "my - ea * ma - eb * mb - ec * mc",
              "1.0 / n + ia * ma * ma + ib * mb * mb + ic * mc * mc + 2 * (iab * ma * mb + iac * ma * mc + ibc * mb * mc)")]
    terms += [(f"'{c}'", f"e{k}", f"i{k}") for k, c in x.items()]
    out = " UNION ALL ".join(
        f"""SELECT outcome, {name} AS term, n, {coef} AS coef, sqrt(mse * ({part})) AS se, r2, adj_r2, f FROM fit""" for name, coef, part in terms)
    return f"""SELECT outcome, term, n, {_rounded(["coef", "se"])}, {r6("coef / se", "t")}, {_rounded(["r2", "adj_r2", "f"])} FROM (
      WITH m AS (SELECT outcome, count(*)::BIGINT AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, {sums} FROM ({rows}) GROUP BY outcome),
      det AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS d FROM m),
      inv AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in inverse.items())} FROM det),
      sol AS (SELECT *, ia * ya + iab * yb + iac * yc AS ea, iab * ya + ib * yb + ibc * yc AS eb, iac * ya + ibc * yb + ic * yc AS ec FROM inv),
      fit AS (SELECT *, (yy - ex) / (n - 4) AS mse, ex / yy AS r2, 1 - (1 - ex / yy) * (n - 1) / (n - 4) AS adj_r2,
          ex / 3 / ((yy - ex) / (n - 4)) AS f FROM (SELECT *, ea * ya + eb * yb + ec * yc AS ex FROM sol))
      {out})"""


def _with_effects() -> str:
    """Means yb county and year taken out in turn, a hundred times, then two regressors yb Cramer's rule."""
    out = ", ".join(f"{c} - avg({c}) OVER (PARTITION BY {{0}}) AS {c}" for c in "yab")
    return f"""SELECT 'general_health_status_Excellent_w' AS outcome, term, n, places, years, {_rounded(["coef", "se"])},
      {r6("coef / se", "t")}, {r6("within_r2", "within_r2")} FROM (
      WITH RECURSIVE it(step, fips, survey_year, y, a, b) AS (
        SELECT 0, fips, survey_year, {Y}::DOUBLE, {X}::DOUBLE, labor_force_mean::DOUBLE FROM panel
          WHERE {Y} IS NOT NULL AND {X} IS NOT NULL AND labor_force_mean IS NOT NULL
        UNION ALL SELECT step + 1, fips, survey_year, {out.format("survey_year")}
          FROM (SELECT step, fips, survey_year, {out.format("fips")} FROM it WHERE step < 100)),
      w AS (SELECT * FROM it WHERE step = 100),
      s AS (SELECT count(*)::BIGINT AS n, count(DISTINCT fips)::BIGINT AS places, count(DISTINCT survey_year)::BIGINT AS years,
          sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ya, sum(b * y) AS yb, sum(y * y) AS yy FROM w),
      e AS (SELECT *, (bb * ya - ab * yb) / (aa * bb - ab * ab) AS ea, (aa * yb - ab * ya) / (aa * bb - ab * ab) AS eb FROM s),
      c AS (SELECT sum(a * (y - a * ea - b * eb)) AS sa, sum(b * (y - a * ea - b * eb)) AS sb FROM w, e GROUP BY fips),
      g AS (SELECT *, places * (n - 1) / ((places - 1) * (n - 1 - places - years)::DOUBLE) / ((aa * bb - ab * ab) * (aa * bb - ab * ab)) AS q
        FROM e, (SELECT sum(sa * sa) AS maa, sum(sa * sb) AS mab, sum(sb * sb) AS mbb FROM c))
      SELECT '{X}' AS term, n, places, years, ea AS coef, sqrt(q * (bb * bb * maa - 2 * bb * ab * mab + ab * ab * mbb)) AS se,
        (ea * ya + eb * yb) / yy AS within_r2 FROM g
      UNION ALL SELECT 'labor_force_mean', n, places, years, eb, sqrt(q * (ab * ab * maa - 2 * ab * aa * mab + aa * aa * mbb)),
        (ea * ya + eb * yb) / yy FROM g)"""


def _phases() -> str:
    """The same search over rows: of all that end alike at a month, the best goes on."""
    best = "score DESC, len(turns), turns DESC"
    return f"""SELECT level, place, phase::INTEGER AS phase, direction, turning_point, from_month, to_month, months::INTEGER AS months,
      {_rounded(["from_rate", "to_rate", "change"])} FROM (
      WITH RECURSIVE r AS (
        SELECT 'county' AS level, fips AS place, year * 100 + month AS ym, unemployment_rate AS rate FROM months WHERE month <= 12
        UNION ALL SELECT 'state', state_name, ym, rate FROM (
          SELECT state_fips, year * 100 + month AS ym, 100.0 * sum(unemployment) / nullif(sum(labor_force), 0) AS rate FROM months
          WHERE month <= 12 AND unemployment IS NOT NULL AND labor_force IS NOT NULL GROUP BY 1, 2)
          JOIN (SELECT DISTINCT left(fips, 2) AS state_fips, state_name FROM crosswalk) USING (state_fips)),
      p AS (SELECT level, place, ym::INTEGER AS ym, round(rate * 1000000)::BIGINT AS v,
          row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY level, place) AS n,
          round(rate * 1000000)::BIGINT - lag(round(rate * 1000000)::BIGINT) OVER o AS d
        FROM r WHERE rate IS NOT NULL WINDOW o AS (PARTITION BY level, place ORDER BY ym)),
      dp(level, place, i, dir, steps, score, turns) AS (
        SELECT level, place, i, k.dir, 1, k.dir * d, []::BIGINT[] FROM p, (VALUES (1), (-1)) k(dir) WHERE i = 1
        UNION ALL SELECT * FROM (
          SELECT p.level, p.place, p.i, CASE WHEN turn THEN -dir ELSE dir END AS dir, CASE WHEN turn THEN 1 ELSE least(steps + 1, 6) END AS steps,
            score + CASE WHEN turn THEN -dir ELSE dir END * d AS score, CASE WHEN turn THEN list_append(turns, dp.i) ELSE turns END AS turns
          FROM dp JOIN p ON p.level = dp.level AND p.place = dp.place AND p.i = dp.i + 1, (VALUES (true), (false)) k(turn)
          WHERE NOT turn OR steps = 6)
        QUALIFY row_number() OVER (PARTITION BY level, place, i, dir, steps ORDER BY {best}) = 1),
      f AS (SELECT dp.* FROM dp JOIN (SELECT DISTINCT level, place, n FROM p) z
          ON z.level = dp.level AND z.place = dp.place AND dp.i = z.n - 1
        QUALIFY row_number() OVER (PARTITION BY dp.level, dp.place ORDER BY steps = 6 DESC, {best}, dir DESC) = 1),
      s AS (SELECT level, place, dir, len(turns) AS t, unnest(range(0, len(turns) + 1)) AS k, list_prepend(0, turns) AS a,
          list_append(turns, i) AS b FROM f),
      y AS (SELECT *, (t - k) % 2 = 0 AND dir = 1 OR (t - k) % 2 = 1 AND dir = -1 AS up FROM s)
      SELECT y.level, y.place, k + 1 AS phase, CASE WHEN up THEN 'rise' ELSE 'fall' END AS direction,
        CASE WHEN k < t THEN CASE WHEN up THEN 'peak' ELSE 'trough' END END AS turning_point, g.ym AS from_month, h.ym AS to_month,
        h.i - g.i AS months, g.v / 1000000.0 AS from_rate, h.v / 1000000.0 AS to_rate, (h.v - g.v) / 1000000.0 AS change
      FROM y JOIN p g ON g.level = y.level AND g.place = y.place AND g.i = a[k + 1]
        JOIN p h ON h.level = y.level AND h.place = y.place AND h.i = b[k + 1])"""


RATE = """CASE WHEN category::DOUBLE BETWEEN 101 AND 199 THEN category::DOUBLE - 100
  WHEN category::DOUBLE BETWEEN 201 AND 299 THEN (category::DOUBLE - 200) / 7
  WHEN category::DOUBLE BETWEEN 301 AND 399 THEN (category::DOUBLE - 300) / 30 END"""

EXPECTED = f"""
SELECT p.state_name, p.survey_year, {r6(
    "nullif(e.rate / CASE WHEN max(e.peak) OVER (PARTITION BY p.state_name) > 1 THEN 100 ELSE 1 END, 0)",
    "expected_per_day")}
FROM (SELECT state_name, survey_year, count(*) AS n FROM panel GROUP BY 1, 2) p
LEFT JOIN (
  SELECT state_name, survey_year, sum(mean * rate) AS rate, max(mean) AS peak FROM (
    SELECT s.state_name, s.survey_year, {RATE} AS rate, s.category,
      sum(s.weighted_percent) / any_value(k.n) AS mean
    FROM shares s
    JOIN (SELECT fips, survey_year, count(*) OVER (PARTITION BY state_name, survey_year) AS n
          FROM panel) k ON s.fips = k.fips AND s.survey_year = k.survey_year
    WHERE s.variable = 'eats_fruit' AND {RATE} IS NOT NULL GROUP BY 1, 2, 3, 4)
  GROUP BY 1, 2) e ON p.state_name = e.state_name AND p.survey_year = e.survey_year"""


def _matched_text(matched: str, total: str) -> str:
    return (f"{matched}::VARCHAR || '/' || {total}::VARCHAR || ' (' || "
            f"printf('%.1f', round_even(round(100.0 * {matched} / nullif({total}, 0), 9), 1)) || '%)' AS match_text")


SOCIO = ("fips, county_name, state_name, survey_year, round(final_weight, 6) AS final_weight, respondent_age, "
         "respondent_sex, household_income_category, num_adults_in_household")
HEALTH = ("fips, county_name, state_name, survey_year, round(final_weight, 6) AS final_weight, "
          "general_health_status, ever_told_high_bp, current_smoking_frequency, "
          "any_alcohol_past_month, eats_fruit")
_STRICT = "CASE WHEN try_cast({0} AS DOUBLE) = floor(try_cast({0} AS DOUBLE)) THEN {1} END"
_STRICT_STATE = _STRICT.format("_state", pad("try_cast(_state AS DOUBLE)::BIGINT::VARCHAR", 2))
_STRICT_COUNTY = _STRICT.format("_cnty", pad("try_cast(_cnty AS DOUBLE)::BIGINT::VARCHAR", 3))


def _bodies() -> dict[str, str]:
    q = {}
    q["fips_from_codes"] = f"""SELECT respondent_id, {_STRICT_STATE} AS state_fips,
      {_STRICT_COUNTY} AS county_fips3,
      coalesce({_STRICT_STATE}, '') || coalesce({_STRICT_COUNTY}, '') AS fips FROM survey_raw"""
    q["fips_from_text"] = "SELECT respondent_id, _state, ctycode, fips FROM coded"
    q["valid_county_rows"] = """SELECT respondent_id, _state, ctycode, survey_year AS year, fips
      FROM coded WHERE ctycode <> '000'"""
    q["geocode_levels"] = "SELECT * FROM geocodes"
    q["county_crosswalk"] = "SELECT * FROM crosswalk"
    q["survey_geo_left"] = "SELECT respondent_id, fips, state_name, county_name FROM named"
    q["county_display_key"] = "SELECT respondent_id, display_name AS county_name FROM named"
    q["county_display_key_prefix"] = """SELECT respondent_id,
      county_name || ', ' || upper(left(state_name, 2)) AS county_name FROM named"""
    key = name_key("area_text", "r_name", "left(r_name, 2)")
    q["normalized_name"] = f"""SELECT area_code, area_text, {key} AS name_key
      FROM area JOIN (SELECT DISTINCT state_fips, r_name FROM counties)
        ON substr(area_code, 3, 2) = state_fips"""

    q["share_long"] = f"SELECT {_share_columns()} FROM shares"
    unweighted = """SELECT fips, state_name, county_name, survey_year, variable, category, n AS unweighted_count,
      100.0 * n / sum(n) OVER (PARTITION BY fips, survey_year, variable) AS unweighted_percent
      FROM (SELECT fips, state_name, county_name, survey_year, variable, category, count(*)::BIGINT AS n
            FROM answers GROUP BY ALL)"""
    weighted = """SELECT fips, state_name, county_name, survey_year, variable, category, w AS weighted_count,
      100.0 * w / nullif(sum(w) OVER (PARTITION BY fips, survey_year, variable), 0) AS weighted_percent
      FROM (SELECT fips, state_name, county_name, survey_year, variable, category,
            coalesce(sum(final_weight), 0) AS w FROM answers GROUP BY ALL)"""
    q["share_outer_form"] = f"""SELECT {_share_columns()} FROM ({unweighted}) u
      FULL JOIN ({weighted}) w USING (fips, state_name, county_name, survey_year, variable, category)"""
    q["share_labeled"] = f"SELECT {_share_columns('label,')} FROM labeled"
    q["share_wide"] = f"SELECT fips, state_name, county_name, survey_year, {_rounded(WIDE_NAMES)} FROM wide"

    q["county_areas"] = "SELECT * FROM county_area"
    q["series_of_counties"] = """SELECT * FROM series
      WHERE area_code IN (SELECT area_code FROM county_area)"""
    q["labor_star"] = "SELECT * FROM star"
    q["labor_long_typed"] = "SELECT * EXCLUDE (fips) FROM typed"
    q["labor_wide"] = f"SELECT fips, state_fips, county, year, month, {_rounded(MEASURE_NAMES)} FROM months"
    q["labor_yearly"] = f"SELECT fips, county_name, survey_year, {_rounded(YEARLY_NAMES)} FROM yearly"
    q["labor_yearly_no_annual"] = (
        f"SELECT fips, county_name, survey_year, {_rounded(YEARLY_NAMES)} FROM yearly_months_only")

    q["county_year_panel"] = (
        f"SELECT fips, state_name, county_name, survey_year, {_rounded(WIDE_NAMES + YEARLY_NAMES)} FROM panel")
    q["county_year_panel_fips"] = f"""SELECT fips, state_name, county_name, survey_year,
      {_rounded([f"{n}_{k}" for k in ("uw", "w") for n in LISTED] + YEARLY_NAMES)} FROM panel"""
    q["statewide_trend_uw"] = _trend([X, *HEALTH_UW])
    q["statewide_trend_w"] = _trend([X, *HEALTH_W])
    q["alcohol_trend"] = _trend([X, *ALCOHOL])
    e, v, g, f, p = (f'"{n}"' for n in HEALTH_W)
    q["collapsed_health"] = f"""SELECT state_name, survey_year, {r6(f"avg({e} + {v})", "above_good")},
      {r6(f"avg({g})", "good")}, {r6(f"avg({f} + {p})", "below_good")}
      FROM panel GROUP BY state_name, survey_year"""
    smoke = [f'"current_smoking_frequency_{s}_uw"' for s in ("Every day", "Some days", "Not at all")]
    q["smoking_trend"] = f"""SELECT state_name, survey_year,
      {r6(f"avg({smoke[0]} + {smoke[1]})", "current_smoker")}, {r6(f"avg({smoke[2]})", "never_smoker")},
      {r6(f"avg({X})", X)} FROM panel GROUP BY state_name, survey_year"""
    q["frequency_rate"] = f"""SELECT fips, state_name, county_name, survey_year, category,
      {r6("weighted_percent", "weighted_percent")}, {r6(RATE, "daily_rate")}
      FROM shares WHERE variable = 'eats_fruit'"""
    q["expected_rate"] = EXPECTED
    q["county_order"] = f"""SELECT state_name, county_name, {r6(f"avg({X})", "mean")},
      row_number() OVER (PARTITION BY state_name ORDER BY round(avg({X}), 9) DESC NULLS LAST, county_name)::INTEGER
        AS position FROM panel GROUP BY state_name, county_name"""
    q["county_year_matrix_x"] = _matrix(X)
    q["county_year_matrix_y"] = _matrix(Y)
    q["bubble_table"] = f"""SELECT state_name, county_name, survey_year, {r6(X, X)},
      {r6(Y, Y.strip('"'))}, {r6("labor_force_mean", "pop_weight")},
      {r6("labor_force_mean / 500", "bubble_size")} FROM panel"""
    q["extreme_counties"] = _extremes("survey_year = 2000")
    q["extreme_counties_by_year"] = _extremes("true")
    q["distinct_years"] = "SELECT DISTINCT survey_year FROM panel"

    q["ols_health"] = f"""SELECT state_name, outcome, n, {_fit_columns()}
      FROM ({_fits("state_name", OUTCOMES)})"""
    q["ols_summary"] = OLS_SUMMARY
    q["ols_by_year"] = f"""SELECT survey_year, outcome, n, {_fit_columns()}
      FROM ({_fits("survey_year", OUTCOMES[:1])})"""

    q["yearly_cutoffs"] = f"SELECT state_name, survey_year, {_rounded(['x_cut', 'y_cut'])} FROM cuts"
    q["quadrants"] = f"""SELECT state_name, survey_year, county_name, {r6(X, X)},
      {r6(Y, Y.strip('"'))}, u_bin, h_bin, quadrant, color FROM quads"""
    q["income_tertiles"] = "SELECT * FROM tertiles"
    q["income_tertiles_fallback"] = f"SELECT {TERTILE_COLUMNS} FROM ({_tertiles('income_few')})"
    q["tertile_edge_ties"] = """SELECT state_name, survey_year, count(DISTINCT median_income)::BIGINT AS values
      FROM income_few GROUP BY state_name, survey_year HAVING count(DISTINCT median_income) >= 3
        AND quantile_cont(median_income, 1.0::DOUBLE / 3.0::DOUBLE)
          = quantile_cont(median_income, 2.0::DOUBLE / 3.0::DOUBLE)"""
    q["statewide_median"] = f"""SELECT state_name, survey_year, {r6("median(median_income)", "median")},
      '$' || format('{{:,}}', round_even(median(median_income), 0)::BIGINT) AS median_text
      FROM income GROUP BY state_name, survey_year"""
    q["common_years"] = """SELECT survey_year FROM survey_raw WHERE survey_year BETWEEN 1997 AND 2000
      INTERSECT SELECT survey_year FROM income"""
    bare = name_key("regexp_replace(area_text, '[0-9]+', '', 'g')", "r_name", "left(r_name, 2)")
    q["dedup_by_name_key"] = f"""SELECT county_key, area_text, area_code FROM (
      SELECT *, row_number() OVER (PARTITION BY county_key ORDER BY area_text, area_code) AS place FROM (
        SELECT {bare} AS county_key, area_text, area_code
        FROM area JOIN (SELECT DISTINCT state_fips, r_name FROM counties)
          ON substr(area_code, 3, 2) = state_fips)) WHERE place = 1"""
    q["income_alignment"] = "SELECT * FROM agreement"
    kinds = ["Green ↔ Green", "Middle ↔ Teal", "Middle ↔ Yellow", "Red ↔ Red", "Mismatch"]
    q["alignment_wide"] = "SELECT state_name, survey_year, " + ", ".join(
        f"""coalesce(max(percent) FILTER (WHERE alignment = '{k}'), 0) AS "{k}\"""" for k in kinds
    ) + " FROM agreement GROUP BY state_name, survey_year"
    q["quadrant_map_table"] = f"""SELECT f.state_name, y.survey_year::INTEGER AS survey_year, feature_name,
      coalesce(color, '#000000') AS color, coalesce(quadrant, 'No data') AS quadrant,
      round_even(round({X}, 9), 1) AS unemp_pct, round_even(round({Y}, 9), 1) AS excellent_pct
      FROM features f CROSS JOIN {_YEAR_ROWS}
      LEFT JOIN quads q ON q.state_name = f.state_name AND q.survey_year = y.survey_year
        AND split_part(q.county_name, ' County', 1) = feature_name"""
    q["tertile_map_table"] = "SELECT * FROM income_map"
    q["tertile_match_count"] = f"""SELECT survey_year, count(mhi)::BIGINT AS matched, count(*)::BIGINT AS total,
      {_matched_text("count(mhi)", "count(*)")} FROM income_map GROUP BY survey_year"""

    q["null_tokens"] = """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL
      ELSE json_extract_string(props, '$.k') END AS k FROM events"""
    q["union_years_by_name"] = """SELECT respondent_id, survey_year, general_health_status,
      CASE WHEN survey_year >= 1998 THEN any_alcohol_past_month END AS any_alcohol_past_month
      FROM survey_raw"""
    q["json_matrix_decode"] = "SELECT * FROM income"
    q["feature_explode"] = """SELECT c_custkey, r_name AS state_name, unnest([n_name, r_name]) AS feature_name
      FROM customer JOIN counties ON c_nationkey = n_nationkey"""
    q["year_resolution"] = """SELECT r.survey_year, CASE WHEN o.survey_year IS NOT NULL
        THEN 'landed/survey_' || r.survey_year || '.csv' END AS path,
      CASE WHEN o.survey_year IS NULL THEN 'not_found' ELSE 'found' END AS status
      FROM requested r LEFT JOIN order_years o ON r.survey_year = o.survey_year"""
    q["pending_years"] = "SELECT survey_year FROM order_years WHERE survey_year > 1997"
    q["manifest_duplicates"] = """SELECT survey_year AS year, 2::BIGINT AS entries FROM order_years
      WHERE survey_year >= 1999"""
    q["manifest_latest"] = """SELECT survey_year AS year, load_order::INTEGER AS load_order,
      'archive/survey_' || survey_year || '_v' || load_order || '.zip' AS url
      FROM (SELECT survey_year, CASE WHEN survey_year >= 1999 THEN 2 ELSE 1 END AS load_order
            FROM order_years)"""
    q["year_range"] = """SELECT respondent_id, survey_year FROM survey_raw
      WHERE survey_year >= 1996 AND survey_year <= 1999"""
    q["state_filter_name"] = """SELECT respondent_id, state_name, county_name FROM named
      WHERE coalesce(state_name ILIKE '%asia%', false)"""
    q["state_filter_code"] = "SELECT respondent_id, _state FROM survey_raw WHERE _state::DOUBLE = 2"
    q["codebook_rename"] = """SELECT * EXCLUDE (ctycode, final_weight), ctycode AS county_code,
      round(final_weight, 6) AS final_weight FROM survey_raw"""
    q["safe_select"] = """SELECT respondent_id, general_health_status AS genhlth, eats_fruit AS fruit
      FROM survey_raw"""
    q["survey_socio_core"] = f"SELECT {SOCIO} FROM named"
    q["survey_health_core"] = f"SELECT {HEALTH} FROM named"
    q["survey_socio_expanded"] = f"SELECT {SOCIO}, ctycode AS county_code, age_category FROM named"
    q["survey_health_expanded"] = f"SELECT {HEALTH}, ever_told_asthma, obesity_flag FROM named"

    q["match_rate"] = f"""SELECT survey_year, count(county_name)::BIGINT AS matched, count(*)::BIGINT AS total,
      {r6("count(county_name) / count(*)", "match_rate")},
      {_matched_text("count(county_name)", "count(*)")} FROM named GROUP BY survey_year"""
    q["first_fips"] = "SELECT DISTINCT fips FROM coded ORDER BY fips LIMIT 10"
    q["key_profile"] = """SELECT _state AS state_fips, count(*)::BIGINT AS rows,
      count(DISTINCT ctycode)::BIGINT AS county_codes,
      count(*) FILTER (WHERE ctycode = '000')::BIGINT AS placeholder_rows,
      min(survey_year) AS first_year, max(survey_year) AS last_year FROM coded GROUP BY _state"""
    grid = f"range({FIRST_YEAR - 1}, {LAST_YEAR + 2})"
    q["empty_partitions"] = f"""SELECT g.state_name, g.survey_year, coalesce(s.n, 0)::BIGINT AS survey_rows,
      coalesce(l.n, 0)::BIGINT AS labor_rows,
      CASE WHEN coalesce(s.n, 0) = 0 AND coalesce(l.n, 0) = 0 THEN 'empty'
        WHEN coalesce(s.n, 0) = 0 THEN 'no survey rows'
        WHEN coalesce(l.n, 0) = 0 THEN 'no labor rows' ELSE 'ok' END AS status
      FROM (SELECT 'New ' || r_name AS state_name, unnest({grid})::INTEGER AS survey_year FROM region) g
      LEFT JOIN (SELECT w.state_name, survey_year, count(*) AS n FROM coded c
                 JOIN crosswalk w ON c.fips = w.fips GROUP BY 1, 2) s
        ON g.state_name = s.state_name AND g.survey_year = s.survey_year
      LEFT JOIN (SELECT r_name AS state_name, year, count(*) AS n FROM typed t
                 JOIN (SELECT DISTINCT state_fips, r_name FROM counties) c ON t.state_fips = c.state_fips
                 GROUP BY 1, 2) l
        ON g.state_name = l.state_name AND g.survey_year = l.year"""
    q["run_summary"] = """SELECT r.survey_year,
      CASE WHEN a.n IS NULL THEN 'not_found' WHEN r.survey_year <= 1997 THEN 'skipped_existing'
        ELSE 'ok' END AS status,
      CASE WHEN r.survey_year > 1997 THEN a.n END AS rows,
      CASE WHEN a.n IS NOT NULL AND r.survey_year > 1997
        THEN CASE WHEN r.survey_year < 1999 THEN 17 ELSE 18 END END AS cols
      FROM requested r LEFT JOIN (SELECT survey_year, count(*)::BIGINT AS n FROM survey_raw GROUP BY 1) a
        ON r.survey_year = a.survey_year"""
    q["coverage_gaps"] = f"""SELECT fips, state_name, county_name || ', ' || state_name AS county_name,
      survey_year FROM (SELECT *, unnest(range({FIRST_YEAR}, {LAST_YEAR + 1}))::INTEGER AS survey_year
                        FROM crosswalk) g
      WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.survey_year = g.survey_year AND p.fips = g.fips)"""
    q["bad_values"] = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c})::BIGINT AS present,
        count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast(trim({c}) AS DOUBLE) IS NULL)::BIGINT AS bad
        FROM {t}""" for c, t in (("_state", "survey_raw"), ("_cnty", "survey_raw"),
                                 ("ctycode", "survey_raw"), ("year", "la_data"), ("value", "la_data")))

    q["ols_pvalues"] = f"""SELECT state_name, outcome, n, {r6("ts", "t_slope")}, {_tail("ts", "p_slope")},
      {r6("ti", "t_intercept")}, {_tail("ti", "p_intercept")}
      FROM (SELECT *, sxy / sxx / sqrt(mse / sxx) AS ts,
              (my - sxy / sxx * mx) / sqrt(mse * (1.0 / n + mx * mx / sxx)) AS ti
            FROM (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS mse FROM ({_fits("state_name", OUTCOMES)})))"""
    q["discovered_files"] = "SELECT 'survey_' || survey_year || '.csv' AS name, survey_year FROM order_years"
    q["yearly_files_read"] = """SELECT year(o_orderdate)::VARCHAR AS year, count(*)::VARCHAR AS rows,
      year(o_orderdate)::INTEGER AS survey_year FROM orders GROUP BY year(o_orderdate)"""
    q["years_at_once"] = """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
      CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
      CASE WHEN year(o_orderdate) % 2 = 1 THEN o_orderpriority END AS o_orderpriority,
      year(o_orderdate)::INTEGER AS survey_year FROM orders"""
    q["restated_figures"] = """SELECT series_id, year, period, max(CASE WHEN period <= 'M06' THEN '2' || value ELSE value END) AS value,
      NULL::VARCHAR AS footnote_codes, CASE WHEN period <= 'M06' THEN 2 ELSE 1 END::BIGINT AS issue
      FROM la_data GROUP BY series_id, year, period"""
    q["headerless_read"] = "SELECT *, NULL::VARCHAR AS footnote_codes FROM la_data"
    q["written_years"] = "SELECT respondent_id, survey_year, general_health_status FROM survey_raw"
    q["written_survey_table"] = f"SELECT {HEALTH} FROM named"
    q["months_by_state_folder"] = q["labor_wide"]
    some = [n for n in WIDE_NAMES if n.startswith(("ever_told_high_bp", "ever_told_asthma"))]
    q["written_panel"] = f"""SELECT fips, state_name, county_name, survey_year, {r6(X, X)}, {_rounded(some)}
      FROM panel"""
    q["clustered_panel"] = q["written_panel"]
    q["run_log_entries"] = f"""SELECT * FROM ({q["run_summary"]}) UNION ALL
      SELECT * FROM ({q["run_summary"]}) WHERE status = 'ok'"""
    q["lower_column_names"] = """SELECT respondent_id, _state, general_health_status AS genhlth, survey_year AS year
      FROM survey_raw"""
    q["dropped_columns"] = f"""SELECT respondent_id, respondent_age AS age, {_STRICT_STATE} AS state_fips,
      {_STRICT_COUNTY} AS county_fips3,
      coalesce({_STRICT_STATE}, '') || coalesce({_STRICT_COUNTY}, '') AS fips FROM survey_raw"""
    q["state_of_file_name"] = "SELECT n_nationkey, r_name AS state FROM counties"

    measures = [X, *HEALTH_W]
    q["describe_panel"] = " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count("{m}")::BIGINT AS n, {r6(f'avg("{m}")', "mean")},
        {r6(f'stddev_samp("{m}")', "stddev")}, {r6(f'min("{m}")', "min")}, {r6(f'max("{m}")', "max")}
        FROM panel""" for m in measures)
    q["corr_matrix"] = " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr("{a}", "{b}")', "r")} FROM panel"""
        for i, a in enumerate(measures) for b in measures[i + 1:])
    q["yearly_change"] = f"""SELECT a.state_name, a.county_name, a.survey_year, {r6(f"a.{X}", X)}, {r6(f"a.{X} - b.{X}", "change")}
      FROM panel a LEFT JOIN panel b ON b.fips = a.fips AND b.survey_year = a.survey_year - 1"""
    q["lagged_correlation"] = f"""SELECT state_name, outcome, lag, n, {r6("r", "r")}, {r6("t", "t")}, {_tail("t", "p")}
      FROM ({_lagged()})"""
    q["best_lag"] = f"""SELECT state_name, outcome, lag, n, {r6("r", "r")} FROM ({_lagged()})
      WHERE n >= 3 AND r IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY state_name, outcome ORDER BY round(abs(r), 9) DESC, abs(lag), lag DESC) = 1"""
    q["difference_map_table"] = _difference_map()
    q["ols_multi"] = _planes()
    q["ols_fixed_effects"] = _with_effects()
    q["downturn_phases"] = _phases()
    q["shares_after_landing"] = q["share_long"]
    q["respondent_quantiles"] = " UNION ALL ".join(
        f"""SELECT respondent_sex, {p}::DOUBLE AS p, count(final_weight)::BIGINT AS n, {r6(f"quantile_cont(final_weight, {p}::DOUBLE)", "value")}
        FROM survey_raw GROUP BY respondent_sex""" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
    return q


def statements() -> dict[str, str]:
    return {name: with_inputs(body) for name, body in _bodies().items()}
