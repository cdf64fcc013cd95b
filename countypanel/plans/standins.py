"""Survey, labour, income and geography tables derived from the given tables.

The given tables have no counties or surveys, so each input of the operators is a view
on them: an order is a respondent, a nation a county, a region a state, a line item a
labour observation. All rows of the given tables take part. Nulls, odd codes and
unreadable texts are put in by row expressions, because the given tables have none.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import zero_pad
from ..functions.names import name_key
from ..sources.delimited import GEOCODE_COLUMNS
from ..sources.literal import literal_rows

FIRST_YEAR, LAST_YEAR = 1995, 2001
YEARS = list(range(FIRST_YEAR, LAST_YEAR + 1))

# Segment of a customer -> the property its feature document names things by.
SEGMENT_PROPERTY = {
    "AUTOMOBILE": "name", "BUILDING": "Name", "FURNITURE": "NAME",
    "HOUSEHOLD": "Label", "MACHINERY": "label",
}


# Schema by path of the given tables opened so far.
SCHEMAS: dict[str, T.StructType] = {}


def choose(col: Column, cases: dict) -> Column:
    return reduce(lambda c, kv: c.when(col == kv[0], kv[1]), cases.items(), F).otherwise(None)


def pick(texts, index: Column) -> Column:
    """The text at a position counted from 0."""
    return F.array(*[F.lit(t) for t in texts])[index]


def state_name(region: Column) -> Column:
    return F.concat(F.lit("New "), region)


class Tables:
    """The given tables of one folder and the views on them.

    The large table of a view joins its lookups one by one, not a join of them: Spark
    takes the size of a join for the product of its sides, so the large table would
    pass for the smaller side and be broadcast.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Views that several others build on, made once.
        self.counties = cache(self.counties)
        self.area = cache(self.area)

    def read(self, name: str) -> DataFrame:
        """A given table; its footer is looked at once however many views use it."""
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    def counties(self) -> DataFrame:
        """Nations with their region: codes, names and the region's name.

        As in the real tables, counties of different states share a name, and states
        share their first two letters: nation 7 of region 2 is county "NATION_1" of "New ASIA".
        """
        nation, region = self.read("nation"), self.read("region")
        name = F.concat(F.lit("NATION_"), F.floor(F.col("n_nationkey") / 5).cast("string"))
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "n_regionkey", name.alias("n_name"), state_name(F.col("r_name")).alias("r_name"),
            zero_pad(F.col("n_regionkey").cast("string"), 2).alias("state_fips"),
            zero_pad(F.col("n_nationkey").cast("string"), 3).alias("county_fips"),
        )

    def geocode_lines(self) -> DataFrame:
        """A geocode export with preamble and header: country, states, counties, places."""
        top = literal_rows(
            self.spark,
            GEOCODE_COLUMNS,
            [
                ("Geography file", None, None, None),
                ("Vintage 2017", None, None, None),
                ("Source: derived", None, None, None),
                (None, None, None, None),
                ("Summary Level", "State Code", "County Code", "Area Name"),
                ("010", "00", "000", "United States"),
            ],
        )
        nation, region, supplier = self.read("nation"), self.read("region"), self.read("supplier")
        states = region.select(
            F.lit("040"), zero_pad(F.col("r_regionkey").cast("string"), 2), F.lit("000"),
            state_name(F.col("r_name")),
        )
        state_of = zero_pad(F.col("n_regionkey").cast("string"), 2)
        counties = nation.select(
            F.lit("050"), state_of, zero_pad(F.col("n_nationkey").cast("string"), 3),
            F.concat(F.lit("NATION_"), F.floor(F.col("n_nationkey") / 5).cast("string"), F.lit(" County")),
        )
        places = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.lit("162"), state_of, F.lit("000"), "s_name"
        )
        return top.union(states).union(counties).union(places)

    def survey_raw(self) -> DataFrame:
        """One respondent per order, under raw survey column names."""
        orders, customer = self.read("orders"), self.read("customer")
        place = self.read("nation").select(
            "n_nationkey",
            F.concat(F.col("n_regionkey").cast("string"), F.lit(".0")).alias("_state"),
            F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")).alias("county"),
        )
        rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
            place, F.col("c_nationkey") == F.col("n_nationkey")
        )
        key, county = F.col("o_orderkey"), F.col("county")
        year = F.year("o_orderdate")
        return rows.select(
            key.alias("respondent_id"),
            "_state",
            F.when(key % 50 == 0, None).when(key % 97 == 0, "777").otherwise(county)
            .alias("ctycode"),
            F.when(key % 61 == 0, "x").when(key % 67 == 0, "6.5").otherwise(county)
            .alias("_cnty"),
            year.alias("year"),
            F.when(key % 31 != 0, F.col("o_totalprice")).alias("_finalwt"),
            F.when(key % 11 == 0, None).when(key % 17 == 0, 8.0)
            .otherwise(F.substring("o_orderpriority", 1, 1).cast("double")).alias("genhlth"),
            choose(F.col("o_orderstatus"), {"F": 1.0, "O": 2.0, "P": 3.0}).alias("smokeday"),
            choose(
                F.col("c_mktsegment"),
                {"AUTOMOBILE": 1.0, "BUILDING": 2.0, "FURNITURE": 7.0, "HOUSEHOLD": 9.0},
            ).alias("bphigh"),
            F.when(year >= 1998, (key % 2 + 1).cast("double")).alias("drinkany"),
            F.when(key % 13 == 0, 555.0)
            .otherwise((F.lit(100) + F.col("o_custkey") % 3 * 100 + key % 40).cast("double"))
            .alias("fruit"),
            (F.col("o_custkey") % 70 + 18).cast("int").alias("age"),
            (F.col("o_custkey") % 2 + 1).cast("int").alias("sex"),
            F.floor(F.col("c_acctbal") / 1000).cast("int").alias("income2"),
            (F.col("o_custkey") % 5 + 1).cast("int").alias("numadult"),
            (F.col("o_custkey") % 6 + 1).cast("int").alias("_ageg"),
            (key % 3 + 1).cast("double").alias("asthma"),
            F.when(F.col("o_totalprice") > 200000, 2).otherwise(1).alias("_rfobese"),
        )

    def area(self) -> DataFrame:
        """Labour areas: states, counties, and a city per supplier."""
        counties, nation = self.counties(), self.read("nation")
        state = F.concat(F.lit("ST"), zero_pad(F.col("r_regionkey").cast("string"), 2),
                         F.lit("00000000000"))
        states = self.read("region").select(
            F.lit("A").alias("area_type_code"), state.alias("area_code"),
            state_name(F.col("r_name")).alias("area_text"),
        )
        county_rows = counties.select(
            F.lit("F"),
            F.concat(F.lit("CN"), "state_fips", "county_fips", F.lit("0000000")),
            F.concat("n_name", F.lit(" County, "), F.upper(F.substring("r_name", 1, 2))),
        )
        supplier = self.read("supplier")
        cities = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.lit("G"),
            F.concat(F.lit("CT"), zero_pad(F.col("n_regionkey").cast("string"), 2),
                     zero_pad(F.col("s_suppkey").cast("string"), 11)),
            "s_name",
        )
        return states.union(county_rows).union(cities)

    def series(self) -> DataFrame:
        """Four measures of every area, and a header line read as data."""
        codes = F.explode(F.array(*[F.lit(c) for c in ("03", "04", "05", "06")]))
        rows = self.area().select("area_type_code", "area_code", codes.alias("measure_code"))
        listed = rows.select(
            F.concat(F.lit("LAU"), "area_code", "measure_code").alias("series_id"),
            "area_type_code", "area_code", "measure_code", F.lit("U").alias("seasonal"),
        )
        header = literal_rows(self.spark, listed.columns, [tuple(listed.columns)])
        return listed.union(header)

    def la_data(self) -> DataFrame:
        """One labour observation per line item."""
        line, supplier = self.read("lineitem"), self.read("supplier")
        fips = F.concat(
            zero_pad(F.col("n_regionkey").cast("string"), 2),
            zero_pad(F.col("n_nationkey").cast("string"), 3),
        )
        place = self.read("nation").select(
            "n_nationkey", F.concat(F.lit("LAUCN"), fips, F.lit("0000000")).alias("area_series")
        )
        rows = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(
            place, F.col("s_nationkey") == F.col("n_nationkey")
        )
        measure = pick(("03", "04", "05", "06"), F.col("l_linenumber") % 4)
        year, month = F.year("l_shipdate"), F.month("l_shipdate")
        monthly = pick([f"M{m:02d}" for m in range(1, 13)], month - 1)
        annual = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
        missing = (F.col("l_orderkey") % 10 == 0) | (
            (F.col("n_nationkey") == 3) & (year == 1996) & (month == 2)
        )
        return rows.select(
            F.concat("area_series", measure).alias("series_id"),
            year.cast("string").alias("year"),
            F.when(annual, "M13").otherwise(monthly).alias("period"),
            F.when(missing, "-").otherwise(
                F.concat(F.lit(" "), F.col("l_quantity").cast("string"))).alias("value"),
        )

    def income_cells(self) -> DataFrame:
        """Yearly income of each county: the rounded mean order total of its customers."""
        orders, customer = self.read("orders"), self.read("customer")
        by_nation = (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .groupBy("c_nationkey", F.year("o_orderdate").alias("survey_year"))
            .agg(F.round(F.avg("o_totalprice")).alias("median_income"))
        )
        counties = self.counties()
        return by_nation.join(counties, by_nation.c_nationkey == counties.n_nationkey)

    def income(self) -> DataFrame:
        full_name = F.concat("n_name", F.lit(" County, "), "r_name")
        return self.income_cells().select(
            F.col("r_name").alias("state_name"), "survey_year",
            F.concat("state_fips", "county_fips").alias("county_fips"),
            full_name.alias("county_name_full"),
            name_key(full_name, F.col("r_name"), F.substring("r_name", 1, 2)).alias("county_key"),
            "median_income",
        )

    def income_few(self) -> DataFrame:
        """Incomes where one year keeps two different values, one only one, and one three whose edges coincide."""
        few = (
            F.when((F.col("survey_year") == 1996) & F.col("county_key").endswith("1"), 1000.0)
            .when(F.col("survey_year") == 1996, 2000.0)
            .when(F.col("survey_year") == 1997, 3000.0)
            .when((F.col("survey_year") == 1998) & F.col("county_key").endswith("0"), 1000.0)
            .when((F.col("survey_year") == 1998) & F.col("county_key").endswith("4"), 3000.0)
            .when(F.col("survey_year") == 1998, 2000.0)
            .otherwise(F.col("median_income"))
        )
        return self.income().withColumn("median_income", few)

    def income_replies(self) -> DataFrame:
        """One JSON matrix per state and year. A state lists its counties, which are few."""
        row = F.array(
            F.concat("n_name", F.lit(" County, "), "r_name"),
            F.col("median_income").cast("long").cast("string"),
            F.col("survey_year").cast("string"),
            F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string"),
        )
        header = F.array(*[F.lit(c) for c in ("NAME", "SAEMHI_PT", "time", "state", "county")])
        return (
            self.income_cells()
            .groupBy("r_name", "survey_year")
            .agg(F.collect_list(row).alias("rows"))
            .select(
                F.col("r_name").alias("state_name"), "survey_year",
                F.to_json(F.concat(F.array(header), "rows")).alias("reply"),
            )
        )

    def feature_documents(self) -> DataFrame:
        """One feature collection per customer: its nation and its region."""
        customer, counties = self.read("customer"), self.counties()
        prop = choose(F.col("c_mktsegment"), SEGMENT_PROPERTY)
        feature = [
            F.concat(F.lit('{"type":"Feature","properties":{"'), prop, F.lit('":"'), name,
                     F.lit('"}}'))
            for name in (F.col("n_name"), F.col("r_name"))
        ]
        document = F.concat(
            F.lit('{"type":"FeatureCollection","features":['), feature[0], F.lit(","), feature[1],
            F.lit("]}"),
        )
        return customer.join(counties, customer.c_nationkey == counties.n_nationkey).select(
            "c_custkey", F.col("r_name").alias("state_name"), document.alias("document")
        )

    def event_texts(self) -> DataFrame:
        """A property of every event as text, some spelled as missing."""
        key = F.col("event_id")
        value = F.get_json_object("props", "$.k")
        odd = F.when(key % 7 == 0, "N/A").when(key % 11 == 0, "").otherwise(value)
        return self.read("events").select("event_id", odd.alias("k"))

    def order_years(self) -> DataFrame:
        return self.read("orders").select(F.year("o_orderdate").alias("survey_year")).distinct()

    def requested_years(self) -> DataFrame:
        """Every order year and the one after it."""
        years = F.explode(F.array("survey_year", F.col("survey_year") + 1))
        return self.order_years().select(years.alias("survey_year")).distinct()

    def done_years(self) -> DataFrame:
        return self.order_years().where("survey_year <= 1997")

    def files(self) -> DataFrame:
        """Yearly files of the order years among files that only look like them."""
        year = F.col("survey_year").cast("string")
        names = F.array(
            F.concat(F.lit("landed/survey_"), year, F.lit(".csv")),
            F.concat(F.lit("landed/survey_"), year, F.lit("_notes.csv")),
            F.concat(F.lit("landed/survey_"), F.substring(year, 3, 2), F.lit(".csv")),
        )
        return self.order_years().select(F.explode(names).alias("path"))

    def manifest(self) -> DataFrame:
        """Archives in two load blocks, the second listing years from 1999 again."""
        year = F.col("survey_year")
        blocks = F.when(year >= 1999, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        listed = self.order_years().select(year.alias("year"), F.explode(blocks).alias("load_order"))
        url = F.concat(F.lit("archive/survey_"), F.col("year").cast("string"), F.lit("_v"),
                       F.col("load_order").cast("string"), F.lit(".zip"))
        return listed.withColumn("url", url)
