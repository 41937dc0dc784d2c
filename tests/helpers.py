from pacelake.schema import FEED_SCHEMA

DEFAULT = dict(
    year_of_event=2018,
    event_dates="06.01.2018",
    event_name="Ridge Loop (BEL)",
    event_distance_length="50km",
    event_number_of_finishers=22,
    athlete_performance="4:51:39 h",
    athlete_club="Club",
    athlete_country="BEL",
    athlete_year_of_birth=1978.0,
    athlete_gender="M",
    athlete_age_category="M35",
    athlete_average_speed=10.0,
    athlete_source_id=7,
)


def bronze(spark, rows):
    """rows: list of dicts overriding DEFAULT (keys in snake_case)."""
    data = [tuple({**DEFAULT, **r}[f.name] for f in FEED_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, FEED_SCHEMA)
