"""The race-result feed derived from the star-schema test tables.

One result row per line item: the order gives the event date, the part gives
the event (brand + length, or a product name for some), the customer is the
athlete, and the price and keys shape the performance text. The rows carry
every kind of dirt the cleaning rules handle (wrong-unit pairs, upper-case
``H``, day-prefixed times, date ranges, blank clubs, mixed-case and unknown
country codes, implausible birth years and speeds, multi-length events).

The plan is lineitem ⋈ (orders ⋈ customer) ⋈ part on their keys, all inner
equi-joins; a side is broadcast by AQE only when its measured size is under
the broadcast threshold, otherwise it is sort-merge joined (with AQE
splitting skewed key partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacelake.schema import BRONZE_COLUMNS
from pacelake.sources.tables import read_table

FEED_TABLES = ["lineitem", "orders", "part", "customer"]

# --- fixed values: codes written for nations 0..24, three letters each --------
NATION_CODES = "ALGARGBRACANEGYETHFRAGERINDINAIRIIRQJPNJORKENMARMOZPERCHNROUKSAVIERUSGBRUSA"
# ------------------------------------------------------------------------------


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("int").cast("string"), 2, "0")


def _txt(c: Column) -> Column:
    return c.cast("int").cast("string")


def race_feed(spark: SparkSession, base_dir: str) -> DataFrame:
    """Raw result rows (the 13 source columns, snake_case) derived from the
    lineitem, orders, part and customer tables under ``base_dir``."""
    c = F.col
    li = read_table(spark, base_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    orders = read_table(spark, base_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, base_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    cust = read_table(spark, base_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")

    # orders ⋈ customer first: both are far smaller than lineitem, so when
    # nothing can be broadcast the lineitem-sized rows are shuffled twice
    # (by order key, then by part key) instead of three times.
    buyers = orders.join(cust, c("o_custkey") == c("c_custkey"))
    b = li.join(buyers, c("l_orderkey") == c("o_orderkey")).join(part, c("l_partkey") == c("p_partkey"))

    pk8 = c("l_partkey") % 8
    length = (
        F.when(pk8 == 0, "50km")
        .when(pk8 == 1, "100km")
        .when(pk8 == 2, F.when(c("l_partkey") % 16 == 10, "200km").otherwise("100mi"))
        .when(pk8 == 3, "24h")
        .when(pk8 == 4, "6d")
        .when(pk8 == 5, "50km/3Etappen")
        .when(pk8 == 6, "50KM")
        .otherwise("12h")
    )
    b = b.select(
        "*",
        length.alias("_len"),
        F.floor(c("l_extendedprice")).cast("int").alias("_price"),
    ).withColumns(
        {
            "_sec": F.lit(18000) + c("_price") % 90000,
            "_dd": _pad2(F.dayofmonth("o_orderdate")),
            "_mmyyyy": F.concat(
                _pad2(F.month("o_orderdate")), F.lit("."), _txt(F.year("o_orderdate"))
            ),
        }
    )

    sec = c("_sec")
    ok10 = c("l_orderkey") % 10
    event_dates = (
        F.when(ok10 == 3, F.concat(c("_dd"), F.lit(".-"), c("_dd"), F.lit("."), c("_mmyyyy")))
        .when(
            ok10 == 4,
            F.concat(c("_dd"), F.lit("."), c("_mmyyyy"), F.lit("-"), c("_dd"), F.lit("."), c("_mmyyyy")),
        )
        .otherwise(F.concat(c("_dd"), F.lit("."), c("_mmyyyy")))
    )
    event_name = F.when(
        pk8.isin(1, 3) & (c("l_partkey") % 3 == 0), c("p_name")
    ).otherwise(F.concat(c("p_brand"), F.lit(" "), c("_len")))

    km_text = F.concat(
        _txt(c("_price") % 250),
        F.lit("."),
        F.lpad(_txt(c("l_partkey") % 1000), 3, "0"),
        F.lit(" km"),
    )
    day_text = F.concat(
        _txt(F.floor(sec / 86400)),
        F.lit(" "),
        _pad2(F.floor((sec % 86400) / 3600)),
        F.lit(":"),
        _pad2(F.floor((sec % 3600) / 60)),
        F.lit(":"),
        _pad2(sec % 60),
        F.lit(" h"),
    )
    hms_text = F.concat(
        _txt(F.floor(sec / 3600)),
        F.lit(":"),
        _pad2(F.floor((sec % 3600) / 60)),
        F.lit(":"),
        _pad2(sec % 60),
        F.when(c("l_orderkey") % 17 == 0, F.lit(" H")).otherwise(F.lit(" h")),
    )
    performance = (
        F.when(pk8.isin(3, 7) != (c("l_orderkey") % 11 == 0), km_text)
        .when((c("l_orderkey") % 13 == 0) & (sec >= 86400), day_text)
        .otherwise(hms_text)
    )
    code = F.substring(F.lit(NATION_CODES), c("c_nationkey") * 3 + 1, F.lit(3))
    country = (
        F.when(c("c_custkey") % 29 == 0, F.lit(""))
        .when(c("c_custkey") % 31 == 0, F.lit("ZZZ"))
        .when(c("c_custkey") % 2 == 1, F.lower(code))
        .otherwise(code)
    )
    ck5 = c("c_custkey") % 5
    gender = F.when(ck5 == 1, "w ").when(ck5 == 2, "F").when(ck5 == 4, "X").otherwise("M")

    return b.select(
        F.year("o_orderdate").cast("int").alias("year_of_event"),
        event_dates.alias("event_dates"),
        event_name.alias("event_name"),
        c("_len").alias("event_distance_length"),
        c("p_size").cast("int").alias("event_number_of_finishers"),
        performance.alias("athlete_performance"),
        F.when(c("c_custkey") % 3 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), c("c_mktsegment")))
        .alias("athlete_club"),
        country.alias("athlete_country"),
        (F.lit(1840) + c("c_custkey") % 200).cast("double").alias("athlete_year_of_birth"),
        gender.alias("athlete_gender"),
        F.lit("").alias("athlete_age_category"),
        (c("l_quantity") * 1.2).alias("athlete_average_speed"),
        c("c_custkey").cast("long").alias("athlete_source_id"),
    ).select(*BRONZE_COLUMNS)
