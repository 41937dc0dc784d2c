"""Schemas of the bronze, silver and gold tables."""

from pyspark.sql import types as T

# --- fixed values: the source files' header, columns and types, the tables' columns ---
# Header of the raw result files, in file order. Columns are matched by
# position, so the order below is the contract with the files.
SOURCE_HEADERS = [
    "Year of event",
    "Event dates",
    "Event name",
    "Event distance/length",
    "Event number of finishers",
    "Athlete performance",
    "Athlete club",
    "Athlete country",
    "Athlete year of birth",
    "Athlete gender",
    "Athlete age category",
    "Athlete average speed",
    "Athlete ID",
]

# snake_case names used from bronze onwards (same order as SOURCE_HEADERS).
BRONZE_COLUMNS = [
    "year_of_event",
    "event_dates",
    "event_name",
    "event_distance_length",
    "event_number_of_finishers",
    "athlete_performance",
    "athlete_club",
    "athlete_country",
    "athlete_year_of_birth",
    "athlete_gender",
    "athlete_age_category",
    "athlete_average_speed",
    "athlete_source_id",
]

_SOURCE_TYPES = [
    T.IntegerType(),
    T.StringType(),
    T.StringType(),
    T.StringType(),
    T.IntegerType(),
    T.StringType(),
    T.StringType(),
    T.StringType(),
    T.DoubleType(),
    T.StringType(),
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
]

RENAME = dict(zip(SOURCE_HEADERS, BRONZE_COLUMNS))

SOURCE_SCHEMA = T.StructType(
    [T.StructField(h, t, True) for h, t in zip(SOURCE_HEADERS, _SOURCE_TYPES)]
)

# Same fields under their snake_case names (what a bronze row looks like
# before lineage columns are added).
FEED_SCHEMA = T.StructType(
    [T.StructField(c, t, True) for c, t in zip(BRONZE_COLUMNS, _SOURCE_TYPES)]
)

LINEAGE_COLUMNS = ["source_file", "ingest_ts"]

SILVER_COLUMNS = [
    "result_id",
    "event_id",
    "athlete_id",
    "year_of_event",
    "event_start_date",
    "event_name",
    "event_distance_length",
    "event_type",
    "event_distance_km",
    "event_duration_hours",
    "event_number_of_finishers",
    "athlete_source_id",
    "athlete_country",
    "athlete_club",
    "athlete_gender",
    "athlete_year_of_birth",
    "athlete_age",
    "athlete_age_category",
    "athlete_average_speed",
    "performance_time_seconds",
    "performance_distance_km",
]

FACT_COLUMNS = [
    "result_id",
    "event_id",
    "athlete_id",
    "date_id",
    "performance_time_seconds",
    "performance_distance_km",
    "athlete_average_speed",
    "athlete_age",
    "athlete_age_category",
]

DIM_EVENT_COLUMNS = [
    "event_id",
    "event_name",
    "event_type",
    "event_distance_length",
    "event_distance_km",
    "event_duration_hours",
    "event_number_of_finishers",
]

DIM_ATHLETE_COLUMNS = [
    "athlete_id",
    "athlete_source_id",
    "athlete_country",
    "athlete_club",
    "athlete_gender",
    "athlete_year_of_birth",
]

DIM_DATE_COLUMNS = [
    "date_id",
    "full_date",
    "year",
    "quarter",
    "month",
    "month_name",
    "day",
    "day_of_week",
    "day_name",
    "is_weekend",
]

DIM_COUNTRY_SCHEMA = T.StructType(
    [
        T.StructField("country_code", T.StringType(), False),
        T.StructField("country_name", T.StringType(), True),
        T.StructField("iso_alpha_2", T.StringType(), True),
        T.StructField("iso_alpha_3", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("subregion", T.StringType(), True),
    ]
)

ENRICHED_COLUMNS = [
    "result_id",
    "event_name",
    "event_type",
    "event_distance_length",
    "event_distance_km",
    "event_duration_hours",
    "athlete_country",
    "athlete_gender",
    "event_date",
    "event_year",
    "athlete_age",
    "athlete_age_category",
    "athlete_average_speed",
    "performance_time_seconds",
    "performance_distance_km",
]
# --------------------------------------------------------------------------------------
