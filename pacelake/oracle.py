"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is assembled from CTE blocks that restate each layer – feed, silver
cleaning, fact, dimensions, enriched view – in plain ANSI/DuckDB SQL, written
separately from the Spark code so the two implementations check each other.
Engine differences handled here:

* DuckDB rounds when casting double -> int; Spark truncates -> ``trunc``.
* DuckDB ``round(double)`` is not HALF_UP on the decimal text -> round as DECIMAL.
* ``percentile_approx`` (high accuracy) == the value at rank ceil(n*p).
* Spark sorts NULL first ascending; DuckDB needs ``NULLS FIRST``.
"""

from __future__ import annotations

from pacelake.schema import SOURCE_HEADERS

AS_OF_YEAR = 2026

FEED = """
b AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, cast(floor(l_extendedprice) AS int) AS price, o_orderdate AS d,
        p_name, p_brand, p_size, c_custkey, c_mktsegment, c_nationkey,
        CASE l_partkey % 8 WHEN 0 THEN '50km' WHEN 1 THEN '100km' WHEN 2 THEN CASE WHEN l_partkey % 16 = 10 THEN '200km' ELSE '100mi' END WHEN 3 THEN '24h' WHEN 4 THEN '6d'
                           WHEN 5 THEN '50km/3Etappen' WHEN 6 THEN '50KM' ELSE '12h' END AS len,
        18000 + cast(floor(l_extendedprice) AS int) % 90000 AS sec,
        lpad(cast(day(o_orderdate) AS string),2,'0') AS dd,
        concat(lpad(cast(month(o_orderdate) AS string),2,'0'),'.',cast(year(o_orderdate) AS string)) AS mmyyyy
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
feed AS (
SELECT cast(year(d) AS int) AS year_of_event,
       CASE l_orderkey % 10 WHEN 3 THEN concat(dd,'.-',dd,'.',mmyyyy) WHEN 4 THEN concat(dd,'.',mmyyyy,'-',dd,'.',mmyyyy) ELSE concat(dd,'.',mmyyyy) END AS event_dates,
       CASE WHEN l_partkey % 8 IN (1, 3) AND l_partkey % 3 = 0 THEN p_name ELSE concat(p_brand,' ',len) END AS event_name,
       len AS event_distance_length, p_size AS event_number_of_finishers,
       CASE WHEN (l_partkey % 8 IN (3,7)) <> (l_orderkey % 11 = 0)
            THEN concat(cast(price % 250 AS string),'.',lpad(cast(l_partkey % 1000 AS string),3,'0'),' km')
            WHEN l_orderkey % 13 = 0 AND sec >= 86400
            THEN concat(cast(cast(floor(sec/86400) AS int) AS string),' ',lpad(cast(cast(floor((sec%86400)/3600) AS int) AS string),2,'0'),':',lpad(cast(cast(floor((sec%3600)/60) AS int) AS string),2,'0'),':',lpad(cast(sec%60 AS string),2,'0'),' h')
            ELSE concat(cast(cast(floor(sec/3600) AS int) AS string),':',lpad(cast(cast(floor((sec%3600)/60) AS int) AS string),2,'0'),':',lpad(cast(sec%60 AS string),2,'0'),CASE WHEN l_orderkey % 17 = 0 THEN ' H' ELSE ' h' END) END AS athlete_performance,
       CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE concat(' ',c_mktsegment) END AS athlete_club,
       CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN 'ZZZ' WHEN c_custkey % 2 = 1
            THEN lower(substr('ALGARGBRACANEGYETHFRAGERINDINAIRIIRQJPNJORKENMARMOZPERCHNROUKSAVIERUSGBRUSA', c_nationkey*3+1, 3))
            ELSE substr('ALGARGBRACANEGYETHFRAGERINDINAIRIIRQJPNJORKENMARMOZPERCHNROUKSAVIERUSGBRUSA', c_nationkey*3+1, 3) END AS athlete_country,
       cast(1840 + c_custkey % 200 AS double) AS athlete_year_of_birth,
       CASE c_custkey % 5 WHEN 1 THEN 'w ' WHEN 2 THEN 'F' WHEN 4 THEN 'X' ELSE 'M' END AS athlete_gender,
       '' AS athlete_age_category, l_quantity * 1.2 AS athlete_average_speed, cast(c_custkey AS bigint) AS athlete_source_id
FROM b)"""

# Silver cleaning restated in DuckDB SQL (RE2 regexes; same patterns).
SILVER = f"""
s0 AS (
  SELECT *,
    trim(athlete_performance) AS perf,
    try_cast(regexp_extract(event_distance_length, '([0-9]*\\.?[0-9]+)', 1) AS double) AS dist_value,
    lower(regexp_extract(event_distance_length, '([a-zA-Z]+)$', 1)) AS event_unit
  FROM feed),
s1 AS (
  SELECT *,
    CASE WHEN regexp_matches(perf, '(?i)\\s*h\\s*$') THEN 'h'
         WHEN regexp_matches(perf, '(?i)km\\s*$') THEN 'km' END AS perf_unit
  FROM s0),
s2 AS (
  SELECT *,
    CASE WHEN perf_unit = 'km' THEN try_cast(regexp_extract(perf, '([0-9]*\\.?[0-9]+)', 1) AS double) END AS perf_km,
    CASE WHEN perf_unit = 'h' THEN regexp_extract(perf, '^(\\d+)\\s+\\d+:\\d+:\\d+', 1) END AS days_txt,
    CASE WHEN perf_unit = 'h' THEN regexp_extract(perf, '(\\d+:\\d+:\\d+)\\s*h', 1) END AS hms_txt
  FROM s1),
s3 AS (
  SELECT *,
    CASE WHEN perf_unit = 'h' AND hms_txt <> '' THEN
      coalesce(try_cast(days_txt AS double), 0.0) * 86400
      + try_cast(split_part(hms_txt, ':', 1) AS double) * 3600
      + try_cast(split_part(hms_txt, ':', 2) AS double) * 60
      + try_cast(split_part(hms_txt, ':', 3) AS double) END AS perf_secs
  FROM s2),
s4 AS (
  SELECT *,
    CASE WHEN athlete_year_of_birth BETWEEN 1850 AND {AS_OF_YEAR} - 5 THEN athlete_year_of_birth END AS yob
  FROM s3
  WHERE (event_unit IN ('km', 'mi') AND perf_unit = 'h' AND perf_secs IS NOT NULL)
     OR (event_unit = 'h' AND perf_unit = 'km' AND perf_km IS NOT NULL)),
silver AS (
  SELECT
    sha256(concat_ws('|', coalesce(event_name, ''), coalesce(cast(year_of_event AS varchar), ''),
                          coalesce(cast(athlete_source_id AS varchar), ''), coalesce(athlete_performance, ''))) AS result_id,
    sha256(coalesce(event_name, '')) AS event_id,
    sha256(coalesce(cast(athlete_source_id AS varchar), '')) AS athlete_id,
    year_of_event,
    cast(try_strptime(nullif(regexp_extract(event_dates, '^(\\d{{2}}\\.\\d{{2}}\\.\\d{{4}})', 1), ''), '%d.%m.%Y') AS date) AS event_start_date,
    event_name,
    event_distance_length,
    CASE WHEN event_unit IN ('km', 'mi') THEN 'distance' WHEN event_unit = 'h' THEN 'time' END AS event_type,
    CASE WHEN event_unit = 'km' THEN dist_value WHEN event_unit = 'mi' THEN dist_value * 1.609344 END AS event_distance_km,
    CASE WHEN event_unit = 'h' THEN dist_value END AS event_duration_hours,
    event_number_of_finishers,
    athlete_source_id,
    nullif(upper(trim(athlete_country)), '') AS athlete_country,
    nullif(trim(athlete_club), '') AS athlete_club,
    CASE upper(trim(athlete_gender)) WHEN 'M' THEN 'M' WHEN 'W' THEN 'W' WHEN 'F' THEN 'W' END AS athlete_gender,
    yob AS athlete_year_of_birth,
    CASE WHEN cast(trunc(year_of_event - yob) AS int) BETWEEN 10 AND 100
         THEN cast(trunc(year_of_event - yob) AS int) END AS athlete_age,
    nullif(trim(athlete_age_category), '') AS athlete_age_category,
    CASE WHEN athlete_average_speed > 0 AND athlete_average_speed <= 50 THEN athlete_average_speed END AS athlete_average_speed,
    CASE WHEN perf_unit = 'h' THEN perf_secs END AS performance_time_seconds,
    perf_km AS performance_distance_km
  FROM s4)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n" + body


def R(expr: str, digits: int) -> str:
    """Spark-style HALF_UP rounding of a double, as DuckDB SQL."""
    return f"cast(round(cast(({expr}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _country_values() -> str:
    from pacelake.plans.countries import COUNTRIES

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    return ",\n".join("(" + ", ".join(q(v) for v in row) + ")" for row in COUNTRIES)


GOLD = """
fct AS (
  SELECT result_id, event_id, athlete_id, cast(strftime(event_start_date, '%Y%m%d') AS int) AS date_id,
         performance_time_seconds, performance_distance_km, athlete_average_speed, athlete_age, athlete_age_category
  FROM silver),
dim_event AS (
  SELECT event_id, event_name, max(event_type) AS event_type, max(event_distance_length) AS event_distance_length,
         max(event_distance_km) AS event_distance_km, max(event_duration_hours) AS event_duration_hours,
         max(event_number_of_finishers) AS event_number_of_finishers
  FROM silver GROUP BY event_id, event_name),
ath_ranked AS (
  SELECT athlete_id, athlete_source_id, athlete_country, athlete_club, athlete_gender, athlete_year_of_birth,
         row_number() OVER (PARTITION BY athlete_id, athlete_source_id
                            ORDER BY year_of_event DESC, event_start_date DESC NULLS LAST, result_id DESC) AS rn
  FROM silver WHERE year_of_event IS NOT NULL),
dim_athlete AS (
  SELECT k.athlete_id, k.athlete_source_id, r.athlete_country, r.athlete_club, r.athlete_gender, r.athlete_year_of_birth
  FROM (SELECT DISTINCT athlete_id, athlete_source_id FROM silver) k
  LEFT JOIN ath_ranked r ON r.rn = 1 AND r.athlete_id = k.athlete_id
                        AND r.athlete_source_id IS NOT DISTINCT FROM k.athlete_source_id),
dim_date AS (
  SELECT DISTINCT cast(strftime(event_start_date, '%Y%m%d') AS int) AS date_id, event_start_date AS full_date,
         cast(year(event_start_date) AS int) AS year, cast(quarter(event_start_date) AS int) AS quarter,
         cast(month(event_start_date) AS int) AS month, strftime(event_start_date, '%B') AS month_name,
         cast(day(event_start_date) AS int) AS day, cast(dayofweek(event_start_date) + 1 AS int) AS day_of_week,
         strftime(event_start_date, '%A') AS day_name, dayofweek(event_start_date) IN (0, 6) AS is_weekend
  FROM silver WHERE event_start_date IS NOT NULL),
enriched AS (
  SELECT f.result_id, e.event_name, e.event_type, e.event_distance_length, e.event_distance_km, e.event_duration_hours,
         a.athlete_country, a.athlete_gender, d.full_date AS event_date, d.year AS event_year, f.athlete_age,
         f.athlete_age_category, f.athlete_average_speed, f.performance_time_seconds, f.performance_distance_km
  FROM fct f JOIN dim_event e USING (event_id) JOIN dim_athlete a USING (athlete_id) LEFT JOIN dim_date d USING (date_id))"""


def country_cte() -> str:
    return (
        "dim_country AS (SELECT * FROM (VALUES\n"
        + _country_values()
        + "\n) AS t(country_code, country_name, iso_alpha_2, iso_alpha_3, region, subregion))"
    )


def race(body: str, *extra: str) -> str:
    """Query over the race star schema derived from the base tables."""
    return with_ctes(FEED, SILVER, GOLD, country_cte(), *extra, body=body)


def pct_disc(src: str, value: str, p: float, groups: list[str] | None = None, name: str = "q") -> str:
    """Discrete percentile = the value at 1-based rank ceil(n * p) (what
    Spark's percentile_approx returns when its sketch is exact)."""
    g = ", ".join(groups or [])
    part = f"PARTITION BY {g}" if g else ""
    sel = f"{g}, " if g else ""
    gb = f" GROUP BY {g}" if g else ""
    return (
        f"SELECT {sel}max(v) FILTER (WHERE rn = greatest(cast(ceil(n * cast({p} AS double)) AS bigint), 1)) AS {name} "
        f"FROM (SELECT {sel}{value} AS v, row_number() OVER ({part} ORDER BY {value}) AS rn, "
        f"count(*) OVER ({part}) AS n FROM {src} WHERE {value} IS NOT NULL){gb}"
    )


KM100 = "event_distance_km BETWEEN 99 AND 101 AND performance_time_seconds IS NOT NULL"
W = "CASE WHEN athlete_gender = 'W' THEN 1 ELSE 0 END"
M = "CASE WHEN athlete_gender = 'M' THEN 1 ELSE 0 END"
BAND_E1 = """CASE WHEN event_distance_km < 60 THEN '50-59 km' WHEN event_distance_km < 110 THEN '60-109 km'
     WHEN event_distance_km < 170 THEN '110-169 km (100mi range)' WHEN event_distance_km IS NOT NULL THEN '170+ km' END"""
ORDER_E1 = """CASE WHEN event_distance_km < 60 THEN 1 WHEN event_distance_km < 110 THEN 2
     WHEN event_distance_km < 170 THEN 3 WHEN event_distance_km IS NOT NULL THEN 4 ELSE 99 END"""
BAND_E2 = """CASE WHEN event_distance_km < 60 THEN '50-59 km' WHEN event_distance_km < 110 THEN '60-109 km'
     WHEN event_distance_km < 170 THEN '110-169 km' ELSE '170+ km' END"""
COUNTRY_JOIN = "enriched r LEFT JOIN dim_country c ON r.athlete_country = c.country_code"
YEARLY = "SELECT event_year, count(*) AS n_finishes FROM enriched GROUP BY event_year"


def _race_audit_body() -> str:
    pk = [("fct_results", "fct", "result_id"), ("dim_event", "dim_event", "event_id"),
          ("dim_athlete", "dim_athlete", "athlete_id"), ("dim_date", "dim_date", "date_id"),
          ("dim_country", "dim_country", "country_code")]
    fk = [("fct_results", "fct", "event_id", "dim_event", "event_id"),
          ("fct_results", "fct", "athlete_id", "dim_athlete", "athlete_id"),
          ("fct_results", "fct", "date_id", "dim_date", "date_id"),
          ("dim_athlete", "dim_athlete", "athlete_country", "dim_country", "country_code")]
    nn = [("fct_results", "fct", "event_id"), ("fct_results", "fct", "athlete_id"),
          ("fct_results", "fct", "date_id"), ("dim_event", "dim_event", "event_name"), ("dim_date", "dim_date", "full_date")]
    parts = [
        f"SELECT 'primary_key' AS check_name, '{name}' AS table_name, '{k}' AS column_name,"
        f" cast(count(*) - count(DISTINCT {k}) AS bigint) AS n_violations FROM {cte}"
        for name, cte, k in pk
    ]
    parts += [
        f"SELECT 'foreign_key', '{name}', '{col}->{pname}.{pk_}', cast(count(*) AS bigint) FROM {cte} t"
        f" WHERE t.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pname} p WHERE p.{pk_} = t.{col})"
        for name, cte, col, pname, pk_ in fk
    ]
    parts += [
        f"SELECT 'not_null', '{name}', '{col}', cast(count(*) FILTER (WHERE {col} IS NULL) AS bigint) FROM {cte}"
        for name, cte, col in nn
    ]
    return " UNION ALL ".join(parts)


def race_queries() -> dict[str, str]:
    S = "performance_time_seconds"
    K = "performance_distance_km"
    V = "athlete_average_speed"
    q = {
        # --- layers and serving views
        "silver_races_obt": race("SELECT * FROM silver"),
        "gold_fct_results": race("SELECT * FROM fct"),
        "gold_dim_event": race("SELECT * FROM dim_event"),
        "gold_dim_athlete": race("SELECT * FROM dim_athlete"),
        "gold_dim_date": race("SELECT * FROM dim_date"),
        "vw_results_enriched": race("SELECT * FROM enriched"),
        "vw_distance_top_events": race(
            f"SELECT e.event_name, e.event_distance_length, e.event_distance_km, count(*) AS n_finishers_total,"
            f" avg(f.{S}) / 3600.0 AS avg_finish_hours, min(f.{S}) / 3600.0 AS fastest_finish_hours"
            " FROM fct f JOIN dim_event e USING (event_id) WHERE e.event_type = 'distance'"
            " GROUP BY e.event_name, e.event_distance_length, e.event_distance_km"
        ),
        "vw_distance_gender_split": race(
            f"SELECT e.event_distance_length, e.event_distance_km, a.athlete_gender, count(*) AS n_finishes,"
            f" {R(f'avg(f.{V})', 3)} AS avg_speed_kmh, {R(f'avg(f.{S}) / 3600.0', 2)} AS avg_finish_hours,"
            f" {R(f'min(f.{S}) / 3600.0', 2)} AS fastest_finish_hours"
            " FROM fct f JOIN dim_event e USING (event_id) JOIN dim_athlete a USING (athlete_id)"
            " WHERE e.event_type = 'distance' AND a.athlete_gender IN ('M', 'W')"
            " GROUP BY e.event_distance_length, e.event_distance_km, a.athlete_gender"
        ),
        "vw_distance_country_leaderboard": race(
            f"SELECT a.athlete_country, e.event_distance_length, count(*) AS n_finishes,"
            f" avg(f.{V}) AS avg_speed_kmh, min(f.{S}) / 3600.0 AS fastest_finish_hours"
            " FROM fct f JOIN dim_event e USING (event_id) JOIN dim_athlete a USING (athlete_id)"
            " WHERE e.event_type = 'distance' GROUP BY a.athlete_country, e.event_distance_length"
        ),
        "vw_time_top_events": race(
            f"SELECT e.event_name, e.event_duration_hours, count(*) AS n_finishers_total,"
            f" avg(f.{K}) AS avg_distance_km, max(f.{K}) AS max_distance_km"
            " FROM fct f JOIN dim_event e USING (event_id) WHERE e.event_type = 'time'"
            " GROUP BY e.event_name, e.event_duration_hours"
        ),
        "vw_time_country_leaderboard": race(
            f"SELECT a.athlete_country, e.event_duration_hours, count(*) AS n_finishes,"
            f" avg(f.{K}) AS avg_distance_km, max(f.{K}) AS max_distance_km"
            " FROM fct f JOIN dim_event e USING (event_id) JOIN dim_athlete a USING (athlete_id)"
            " WHERE e.event_type = 'time' GROUP BY a.athlete_country, e.event_duration_hours"
        ),
        "vw_time_yearly_progression": race(
            f"SELECT d.year AS event_year, e.event_duration_hours, count(*) AS n_finishes,"
            f" {R(f'avg(f.{K})', 2)} AS avg_distance_km, {R(f'max(f.{K})', 2)} AS max_distance_km"
            " FROM fct f JOIN dim_event e USING (event_id) JOIN dim_date d USING (date_id)"
            " WHERE e.event_type = 'time' GROUP BY d.year, e.event_duration_hours"
        ),
        # --- dashboard A-F
        "a1_total_finishes": race("SELECT count(*) AS total_finishes FROM fct"),
        "a2_distinct_athletes": race("SELECT count(*) AS distinct_athletes FROM dim_athlete"),
        "a3_distinct_events": race("SELECT count(*) AS distinct_events FROM dim_event"),
        "a4_countries_represented": race(
            "SELECT count(DISTINCT athlete_country) AS countries_represented FROM dim_athlete"
            " WHERE athlete_country IS NOT NULL"
        ),
        "a5_median_100k_hours": race(
            f"SELECT {R('q / 3600.0', 2)} AS median_100k_finish_hours FROM ("
            + pct_disc("x", S, 0.5)
            + ")",
            f"x AS (SELECT {S} FROM enriched WHERE event_type = 'distance' AND {KM100})",
        ),
        "a6_female_participation": race(
            f"SELECT {R(f'100.0 * sum({W}) / nullif(count(*), 0)', 1)} AS female_participation_pct"
            " FROM enriched WHERE athlete_gender IN ('M', 'W')"
        ),
        "b1_finishes_per_year": race(YEARLY),
        "b2_yoy_growth": race(
            "SELECT event_year, n_finishes, lag(n_finishes) OVER w AS prev_year_finishes,"
            f" {R('100.0 * (n_finishes - lag(n_finishes) OVER w) / nullif(lag(n_finishes) OVER w, 0)', 1)}"
            " AS yoy_growth_pct FROM yearly WINDOW w AS (ORDER BY event_year NULLS FIRST)",
            f"yearly AS ({YEARLY})",
        ),
        "b3_debut_cohorts": race(
            "SELECT first_year AS event_year, count(*) AS new_athletes,"
            " cast(sum(count(*)) OVER (ORDER BY first_year) AS bigint) AS cumulative_athletes"
            " FROM debut WHERE first_year IS NOT NULL GROUP BY first_year",
            "debut AS (SELECT f.athlete_id, min(d.year) AS first_year FROM fct f JOIN dim_date d USING (date_id)"
            " GROUP BY f.athlete_id)",
        ),
        "b4_top_events": race(
            f"SELECT event_name, event_distance_length, count(*) AS n_finishes, {R(f'avg({V})', 2)} AS avg_speed_kmh"
            " FROM enriched GROUP BY event_name, event_distance_length"
            " ORDER BY n_finishes DESC, event_name NULLS FIRST, event_distance_length NULLS FIRST LIMIT 15"
        ),
        "c1_top_countries": race(
            "SELECT coalesce(c.country_name, r.athlete_country) AS country, r.athlete_country AS ioc_code,"
            f" count(*) AS n_finishes, {R(f'avg(r.{V})', 2)} AS avg_speed_kmh FROM {COUNTRY_JOIN}"
            " WHERE r.athlete_country IS NOT NULL GROUP BY 1, 2 ORDER BY n_finishes DESC, ioc_code LIMIT 25"
        ),
        "c2_country_diversity": race(
            "SELECT event_year, count(DISTINCT athlete_country) AS countries_represented FROM enriched"
            " WHERE athlete_country IS NOT NULL GROUP BY event_year"
        ),
        "c3_fastest_100k_nations": race(
            "SELECT coalesce(c.country_name, r.athlete_country) AS country, count(*) AS n_100k_finishes,"
            f" {R(f'avg(r.{S}) / 3600.0', 2)} AS avg_finish_hours, {R(f'min(r.{S}) / 3600.0', 2)} AS fastest_finish_hours"
            f" FROM {COUNTRY_JOIN} WHERE r.event_distance_km BETWEEN 99 AND 101 AND r.{S} IS NOT NULL"
            " AND r.athlete_country IS NOT NULL GROUP BY 1 HAVING count(*) >= 50"
            " ORDER BY avg_finish_hours, country LIMIT 25"
        ),
        "d1_age_histogram": race(
            "SELECT cast(floor(athlete_age / 5) * 5 AS bigint) AS age_bucket, count(*) AS n_finishes"
            " FROM enriched WHERE athlete_age BETWEEN 18 AND 80 GROUP BY 1"
        ),
        "d2_gender_by_decade": race(
            f"SELECT cast(floor(event_year / 10) * 10 AS bigint) AS decade, cast(sum({M}) AS bigint) AS men,"
            f" cast(sum({W}) AS bigint) AS women, {R(f'100.0 * sum({W}) / nullif(count(*), 0)', 1)} AS pct_women"
            " FROM enriched WHERE athlete_gender IN ('M', 'W') AND event_year IS NOT NULL GROUP BY 1"
        ),
        "d3_mean_age_per_year": race(
            f"SELECT event_year, {R('avg(athlete_age)', 1)} AS avg_finisher_age FROM enriched"
            " WHERE athlete_age BETWEEN 18 AND 80 GROUP BY event_year"
        ),
        "e1_distance_band_mix": race(
            f"SELECT {BAND_E1} AS distance_band, {ORDER_E1} AS band_order, count(*) AS n_finishes FROM enriched"
            " WHERE event_type = 'distance' AND event_distance_km IS NOT NULL GROUP BY 1, 2"
        ),
        "e2_speed_by_band": race(
            f"SELECT b.distance_band, b.n_finishes, b.avg_speed_kmh, {R('m.q', 2)} AS median_speed_kmh"
            " FROM (SELECT distance_band, count(*) AS n_finishes,"
            f" {R(f'avg({V})', 2)} AS avg_speed_kmh, min(event_distance_km) AS o FROM x GROUP BY distance_band) b"
            f" LEFT JOIN ({pct_disc('x', V, 0.5, ['distance_band'])}) m USING (distance_band)",
            f"x AS (SELECT {BAND_E2} AS distance_band, event_distance_km, {V} FROM enriched"
            f" WHERE event_type = 'distance' AND event_distance_km IS NOT NULL AND {V} IS NOT NULL)",
        ),
        "e3_speed_per_year": race(
            f"SELECT event_year, {R(f'avg({V})', 3)} AS avg_speed_kmh FROM enriched"
            f" WHERE event_type = 'distance' AND {V} IS NOT NULL GROUP BY event_year"
        ),
        "e4_24h_distance_per_year": race(
            f"SELECT event_year, {R(f'avg({K})', 2)} AS avg_distance_km, {R(f'max({K})', 2)} AS max_distance_km"
            f" FROM enriched WHERE event_distance_length = '24h' AND {K} IS NOT NULL GROUP BY event_year"
        ),
        "f1_fastest_100k": race(
            "SELECT r.event_name, r.event_year, coalesce(c.country_name, r.athlete_country) AS country,"
            f" r.athlete_gender, r.athlete_age, {R(f'r.{S} / 3600.0', 2)} AS finish_hours FROM {COUNTRY_JOIN}"
            f" WHERE r.event_distance_km BETWEEN 99 AND 101 AND r.{S} IS NOT NULL"
            f" ORDER BY r.{S}, r.result_id LIMIT 10"
        ),
        "f2_longest_24h": race(
            "SELECT r.event_name, r.event_year, coalesce(c.country_name, r.athlete_country) AS country,"
            f" r.athlete_gender, r.athlete_age, {R(f'r.{K}', 2)} AS distance_km FROM {COUNTRY_JOIN}"
            f" WHERE r.event_distance_length = '24h' AND r.{K} IS NOT NULL"
            f" ORDER BY r.{K} DESC, r.result_id LIMIT 10"
        ),
        "f3_record_progression": race(
            f"SELECT event_year, {R('ybh', 2)} AS year_best_hours,"
            f" {R('min(ybh) OVER (ORDER BY event_year NULLS FIRST)', 2)} AS world_record_to_date FROM yb",
            f"yb AS (SELECT event_year, min({S}) / 3600.0 AS ybh FROM enriched WHERE {KM100} GROUP BY event_year)",
        ),
        "f4_gender_speed_gap": race(
            "SELECT cast(floor(event_year / 10) * 10 AS bigint) AS decade, athlete_gender, count(*) AS n_finishes,"
            f" {R(f'avg({V})', 3)} AS avg_speed_kmh FROM enriched WHERE event_type = 'distance'"
            f" AND athlete_gender IN ('M', 'W') AND {V} IS NOT NULL AND event_year IS NOT NULL GROUP BY 1, 2"
        ),
        # --- validation questions
        "q1_finishes_per_year": race(YEARLY),
        "q2_top_events_by_name": race(
            "SELECT event_name, count(*) AS n_finishes FROM enriched GROUP BY event_name"
            " ORDER BY n_finishes DESC, event_name NULLS FIRST LIMIT 10"
        ),
        "q3_fastest_100km_literal": race(
            f"SELECT event_name, event_date, athlete_country, athlete_gender, athlete_age, {S} / 3600.0 AS finish_hours"
            f" FROM enriched WHERE event_distance_length = '100km' AND {S} IS NOT NULL"
            f" ORDER BY {S}, result_id LIMIT 10"
        ),
        "q4_distance_averages": race(
            f"SELECT event_distance_length, count(*) AS n_finishes, avg({S}) / 3600.0 AS avg_finish_hours,"
            f" avg({V}) AS avg_speed_kmh FROM enriched WHERE event_type = 'distance'"
            " GROUP BY event_distance_length ORDER BY n_finishes DESC, event_distance_length NULLS FIRST LIMIT 20"
        ),
        "q5_top_countries_raw": race(
            f"SELECT athlete_country, count(*) AS n_finishes, avg({V}) AS avg_speed_kmh FROM enriched"
            " GROUP BY athlete_country ORDER BY n_finishes DESC, athlete_country NULLS FIRST LIMIT 15"
        ),
        "q6_gender_per_year": race(
            "SELECT event_year, athlete_gender, count(*) AS n_finishes FROM enriched"
            " WHERE athlete_gender IS NOT NULL GROUP BY event_year, athlete_gender"
        ),
        "q7_age_histogram_10_100": race(
            "SELECT cast(floor(athlete_age / 5) * 5 AS bigint) AS age_bucket_start, count(*) AS n_finishes"
            " FROM enriched WHERE athlete_age BETWEEN 10 AND 100 GROUP BY 1"
        ),
        "race_star_audit": race(_race_audit_body()),
        "stream_silver_races_obt": race("SELECT * FROM silver"),
        "stream_results_enriched": race("SELECT * FROM enriched"),
        "q8_24h_per_year": race(
            f"SELECT event_year, avg({K}) AS avg_distance_km, max({K}) AS max_distance_km, count(*) AS n_finishes"
            " FROM enriched WHERE event_distance_length = '24h' GROUP BY event_year"
        ),
    }
    return q




# --- EDA over the raw feed ---------------------------------------------------------

EDA_NUMERIC = ["year_of_event", "event_number_of_finishers", "athlete_year_of_birth",
               "athlete_average_speed", "athlete_source_id"]
FEED_COLUMNS = ["year_of_event", "event_dates", "event_name", "event_distance_length",
                "event_number_of_finishers", "athlete_performance", "athlete_club", "athlete_country",
                "athlete_year_of_birth", "athlete_gender", "athlete_age_category", "athlete_average_speed",
                "athlete_source_id"]
AGE = "year_of_event - cast(trunc(athlete_year_of_birth) AS int)"


def feed_query(body: str, *extra: str) -> str:
    return with_ctes(FEED, *extra, body=body)


def _summary_sql() -> str:
    ctes, parts = [], []
    for i, col in enumerate(EDA_NUMERIC):
        ctes.append(f"v{i} AS (SELECT cast({col} AS double) AS v FROM feed)")
        parts.append(
            f"SELECT '{col}' AS column_name, a.count, a.mean, a.stddev, a.min, q1.q AS p25, q2.q AS p50,"
            f" q3.q AS p75, a.max FROM (SELECT count(v) AS count, avg(v) AS mean, stddev_samp(v) AS stddev,"
            f" min(v) AS min, max(v) AS max FROM v{i}) a, ({pct_disc(f'v{i}', 'v', 0.25)}) q1,"
            f" ({pct_disc(f'v{i}', 'v', 0.5)}) q2, ({pct_disc(f'v{i}', 'v', 0.75)}) q3"
        )
    return feed_query(" UNION ALL ".join(parts), *ctes)


def eda_queries() -> dict[str, str]:
    ages = f"ages AS (SELECT {AGE} AS age FROM feed WHERE ({AGE}) BETWEEN 10 AND 100)"
    pcts = ", ".join(
        f"({pct_disc('ages', 'age', p)}) AS {n}"
        for p, n in [(0.05, "p05"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95")]
    )
    return {
        "x1_shape": feed_query(f"SELECT count(*) AS n_rows, {len(FEED_COLUMNS)} AS n_columns FROM feed"),
        "x2_numeric_summary": _summary_sql(),
        "x3_null_counts": feed_query(
            "SELECT "
            + ", ".join(f"cast(sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS bigint) AS {x}" for x in FEED_COLUMNS)
            + " FROM feed"
        ),
        "x4_unique_events": feed_query("SELECT count(*) AS n_events FROM (SELECT DISTINCT event_name FROM feed)"),
        "x4_top_events": feed_query(
            "SELECT event_name, count(*) AS n_results FROM feed GROUP BY event_name"
            " ORDER BY n_results DESC, event_name NULLS FIRST LIMIT 20"
        ),
        "x5_age_percentiles": feed_query(f"SELECT {pcts}", ages),
        "x6_age_buckets": feed_query(
            "SELECT cast(trunc(age / 5) AS int) * 5 AS age_bucket, count(*) AS n_results FROM ages GROUP BY 1", ages
        ),
        "x8_hash_sample": feed_query(
            "SELECT athlete_source_id, event_distance_length, athlete_performance FROM feed WHERE"
            " cast(('0x' || substr(md5(concat_ws('|', cast(athlete_source_id AS varchar), event_name, athlete_performance)), 1, 7)) AS bigint)"
            " % 10000 < 100"
        ),
        "x7_top_countries_raw": feed_query(
            "SELECT athlete_country, count(*) AS n_results FROM feed GROUP BY athlete_country"
            " ORDER BY n_results DESC, athlete_country NULLS FIRST LIMIT 25"
        ),
    }


# --- generic operators on the base tables ------------------------------------------------

SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
OYEAR = "cast(year(o_orderdate) AS int)"
LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]
_NUMERIC_TYPES = {"bigint", "int", "double", "smallint", "tinyint", "float"}


def _date_dim_select(d: str) -> str:
    return (
        f"SELECT DISTINCT cast(strftime({d}, '%Y%m%d') AS int) AS date_id, {d} AS full_date,"
        f" cast(year({d}) AS int) AS year, cast(quarter({d}) AS int) AS quarter, cast(month({d}) AS int) AS month,"
        f" strftime({d}, '%B') AS month_name, cast(day({d}) AS int) AS day,"
        f" cast(dayofweek({d}) + 1 AS int) AS day_of_week, strftime({d}, '%A') AS day_name,"
        f" dayofweek({d}) IN (0, 6) AS is_weekend"
    )


def _audit_sql() -> str:
    pk = [("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "r_regionkey"),
          ("part", "p_partkey"), ("supplier", "s_suppkey"), ("lineitem", "l_orderkey,l_linenumber")]
    fk = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
          ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
          ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
          ("nation", "n_regionkey", "region", "r_regionkey")]
    nn = [("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_shipdate"),
          ("orders", "o_custkey"), ("orders", "o_orderdate")]
    parts = [
        f"SELECT 'primary_key' AS check_name, '{t}' AS table_name, '{k}' AS column_name,"
        f" cast(count(*) - count(DISTINCT ({k})) FILTER (WHERE {' AND '.join(x + ' IS NOT NULL' for x in k.split(','))}) AS bigint) AS n_violations FROM {t}"
        for t, k in pk
    ]
    parts += [
        f"SELECT 'foreign_key', '{t}', '{col}->{p}.{k}', cast(count(*) AS bigint) FROM {t}"
        f" WHERE {col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{k} = {t}.{col})"
        for t, col, p, k in fk
    ]
    parts += [
        f"SELECT 'not_null', '{t}', '{col}', cast(count(*) FILTER (WHERE {col} IS NULL) AS bigint) FROM {t}"
        for t, col in nn
    ]
    return " UNION ALL ".join(parts)


def _profile_sql() -> str:
    ctes, parts = [], []
    null = "cast(NULL AS {}) AS {}".format
    for i, (col, typ) in enumerate(LINEITEM_TYPES):
        num, floating = typ in _NUMERIC_TYPES, typ in ("double", "float")
        value = f"strftime({col}, '%Y-%m-%d %H:%M:%S')" if typ.startswith("timestamp") else col
        ctes.append(f"v{i} AS (SELECT {value} AS v FROM lineitem)")
        ctes.append(f"t{i} AS (SELECT v, count(*) AS n FROM v{i} WHERE v IS NOT NULL GROUP BY v)")
        top = f"(SELECT v FROM t{i} ORDER BY n DESC, v LIMIT 1)"
        if num:
            stats = (
                f"cast(min(v) AS double) AS min, cast(max(v) AS double) AS max, {R('avg(v)', 6)} AS mean, {R('stddev_samp(v)', 6)} AS stddev, "
                + ", ".join(f"cast(({pct_disc(f'v{i}', 'v', q)}) AS double) AS {n}" for n, q in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)])
            )
        else:
            stats = ", ".join(null("double", x) for x in ("min", "max", "mean", "stddev", "p25", "p50", "p75"))
        if floating:
            stats += f", {null('varchar', 'min_text')}, {null('varchar', 'max_text')}, {top} AS top_number, {null('varchar', 'top_text')}"
        else:
            stats += f", cast(min(v) AS varchar) AS min_text, cast(max(v) AS varchar) AS max_text, {null('double', 'top_number')}, cast({top} AS varchar) AS top_text"
        parts.append(
            f"SELECT '{col}' AS column_name, '{typ}' AS data_type, count(*) AS n_rows,"
            f" cast(count(*) FILTER (WHERE v IS NULL) AS bigint) AS n_nulls, count(DISTINCT v) AS n_distinct, {stats},"
            f" (SELECT max(n) FROM t{i}) AS top_count FROM v{i}"
        )
    return with_ctes(*ctes, body=" UNION ALL ".join(parts))


def _compare_sql() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    cl = ", ".join(cols)
    on = " AND ".join(f"l.{x} IS NOT DISTINCT FROM r.{x}" for x in cols)
    diff = "coalesce(l.nl, 0) - coalesce(r.nr, 0)"
    return (
        f"WITH l AS (SELECT {cl}, count(*) AS nl FROM orders WHERE o_orderstatus <> 'P' GROUP BY {cl}),"
        f" r AS (SELECT {cl}, count(*) AS nr FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY {cl})"
        f" SELECT CASE WHEN {diff} > 0 THEN 'not_pending' ELSE 'not_low_priority' END AS side, "
        + ", ".join(f"coalesce(l.{x}, r.{x}) AS {x}" for x in cols)
        + f", cast(abs({diff}) AS bigint) AS n FROM l FULL OUTER JOIN r ON {on} WHERE abs({diff}) > 0"
    )


def _events_sql() -> str:
    return (
        "WITH p AS (SELECT event_id, regexp_extract(props, '(?s)\\{.*\\}', 0) AS obj FROM events),"
        " j AS (SELECT event_id, obj, CASE WHEN obj <> '' AND json_valid(obj) THEN json_keys(obj) END AS keys,"
        " CASE WHEN obj <> '' AND json_valid(obj) THEN try_cast(trim(json_extract_string(obj, '$.k')) AS double) END AS d"
        " FROM p),"
        " v AS (SELECT *, d IS NOT NULL AND NOT isnan(d) AS ok FROM j)"
        " SELECT event_id, CASE WHEN ok THEN cast(trunc(d) AS bigint) END AS k,"
        " CASE WHEN obj = '' THEN 'no JSON object' WHEN keys IS NULL THEN 'invalid JSON'"
        " WHEN NOT list_contains(keys, 'k') THEN 'missing keys' WHEN NOT ok THEN 'non-numeric k'"
        " WHEN NOT (cast(trunc(d) AS bigint) BETWEEN 10 AND 90) THEN 'k out of range' END AS reject_reason FROM v"
    )


def _event_specs_sql() -> str:
    good = (
        """'{"event_name": "' || upper(c_mktsegment) || ' Trail, ' || c_custkey || '", "country": " n' || substr(n_name, 2, 2)"""
        """ || '", "distance_km": ' || (c_custkey % 300) || ', "n_finishers": "' || (c_custkey % 400) || '.9"}'"""
    )
    last = "json_extract_string(doc, '$.*')[len(json_keys(doc)) + 1 - list_position(list_reverse(json_keys(doc)), '{}')]".format
    number = r"'\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'"
    return f"""WITH g AS (SELECT c_custkey, {good} AS good FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT c_custkey, CASE c_custkey % 14 WHEN 0 THEN good WHEN 1 THEN 'Here it is: ' || good || ' Enjoy'
  WHEN 2 THEN replace(good, '"country"', '"land"') WHEN 3 THEN regexp_replace(good, '"country": "[^"]*"', '"country": null')
  WHEN 4 THEN regexp_replace(good, '"distance_km": [0-9]+', '"distance_km": "100d"') WHEN 5 THEN good || ' trailing }}'
  WHEN 6 THEN good || ' {{"a": 1}}' WHEN 7 THEN replace(good, '"', chr(39)) WHEN 8 THEN 'no object here'
  WHEN 9 THEN regexp_replace(good, '"event_name": "[^"]*"', '"event_name": null')
  WHEN 10 THEN regexp_replace(good, '"distance_km": [0-9]+', '"distance_km": 1e12')
  WHEN 12 THEN left(good, length(good) - 1) || ', "n_finishers": 9}}' WHEN 13 THEN '{{"distance_km": "far", ' || substr(good, 2) END AS txt FROM g),
o AS (SELECT c_custkey, coalesce(regexp_extract(txt, '(?s)\\{{.*\\}}', 0), '') AS obj FROM t),
j AS (SELECT c_custkey, obj, CASE WHEN obj <> '' AND json_valid(obj) THEN obj END AS doc FROM o),
f AS (SELECT c_custkey, obj, doc, json_keys(doc) AS keys,
  trim(regexp_replace(replace(coalesce({last('event_name')}, 'None'), ',', ' '), ' +', ' ', 'g')) AS name,
  upper(trim({last('country')})) AS code, {last('distance_km')} AS km_text, {last('n_finishers')} AS n_text FROM j),
n AS (SELECT *, CASE WHEN regexp_full_match(km_text, {number}) THEN trunc(cast(trim(km_text) AS double)) END AS km,
  CASE WHEN regexp_full_match(n_text, {number}) THEN trunc(cast(trim(n_text) AS double)) END AS fin FROM f),
r AS (SELECT *, CASE WHEN obj = '' THEN 'no JSON object' WHEN doc IS NULL THEN 'invalid JSON'
  WHEN NOT list_has_all(keys, ['event_name', 'country', 'distance_km', 'n_finishers']) THEN 'missing keys'
  WHEN name = '' THEN 'empty event_name' WHEN code IS NULL OR NOT regexp_full_match(code, '[A-Z]{{3}}') THEN 'bad country code'
  WHEN km IS NULL THEN 'non-numeric distance_km' WHEN km NOT BETWEEN 50 AND 250 THEN 'distance_km out of range'
  WHEN fin IS NULL THEN 'non-numeric n_finishers' WHEN fin NOT BETWEEN 30 AND 300 THEN 'n_finishers out of range' END AS reason FROM n)
SELECT c_custkey, CASE WHEN reason IS NULL THEN name || ' (' || code || ')' END AS event_name,
  CASE WHEN reason IS NULL THEN code END AS country, CASE WHEN reason IS NULL THEN cast(km AS bigint) END AS distance_km,
  CASE WHEN reason IS NULL THEN cast(fin AS bigint) END AS n_finishers, reason AS reject_reason FROM r"""


def ingest_queries() -> dict[str, str]:
    folder = "CASE WHEN year_of_event <= 1996 THEN 'historical' ELSE 'simulated' END"
    span = "cast(floor(event_year / 3) AS int) * 3"
    who = "athlete_source_id"
    outcome = (
        f"CASE WHEN {who} % 41 = 7 THEN 'bad year_of_event' WHEN {who} % 43 = 5 THEN 'bad event_number_of_finishers'"
        f" WHEN {who} % 47 = 3 THEN 'bad athlete_year_of_birth' WHEN {who} % 53 = 2 THEN 'bad athlete_average_speed' ELSE 'kept' END"
    )
    athletes = "SELECT {} AS {}, count(DISTINCT f.athlete_id) AS n_athletes FROM (SELECT fct.athlete_id, dim_date.year AS event_year FROM fct LEFT JOIN dim_date USING (date_id)) f GROUP BY 1"
    kept = race_queries()
    means = {"vw_distance_top_events": "avg_finish_hours", "vw_distance_country_leaderboard": "avg_speed_kmh",
             "vw_time_top_events": "avg_distance_km", "vw_time_country_leaderboard": "avg_distance_km"}
    tables = {"dim_event": "gold_dim_event", "dim_athlete": "gold_dim_athlete", "dim_date": "gold_dim_date"}
    views = ["vw_results_enriched", "vw_distance_top_events", "vw_distance_gender_split", "vw_distance_country_leaderboard",
             "vw_time_top_events", "vw_time_country_leaderboard", "vw_time_yearly_progression"]
    return {
        **{f"incremental_{x}": kept[tables.get(x, x)] for x in (*tables, *views)},
        **{f"incremental_{x}": f"SELECT * REPLACE ({R(mean, 6)} AS {mean}) FROM ({kept[x]})" for x, mean in means.items()},
        "landed_batch_profile": feed_query(
            f"SELECT {folder} AS landing_folder, count(*) AS n_rows, cast(sum(event_number_of_finishers) AS bigint) AS n_finishers,"
            " count(athlete_year_of_birth) AS n_births, max(athlete_average_speed) AS max_speed FROM feed GROUP BY 1"
        ),
        "single_file_drop": feed_query(
            f"SELECT cast(1 AS bigint) AS n_files, '{','.join(SOURCE_HEADERS)}' AS header, count(*) AS n_rows, count(DISTINCT athlete_source_id) AS n_athletes"
            " FROM feed WHERE event_name = (SELECT min(event_name) FROM feed)"
        ),
        "births_as_of_today": with_ctes(
            FEED,
            SILVER.replace(f"AND {AS_OF_YEAR} - 5", "AND year(current_date) - 5"),
            body="SELECT athlete_year_of_birth, count(*) AS n_results FROM silver GROUP BY 1",
        ),
        "quarantined_rows": feed_query(
            f"SELECT {folder} AS landing_folder, {outcome} AS outcome, count(*) AS n_rows FROM feed GROUP BY 1, 2"
            f" UNION ALL SELECT DISTINCT {folder}, 'missing', cast(0 AS bigint) FROM feed"
        ),
        "bitmap_country_diversity": race(
            "SELECT event_year, count(DISTINCT athlete_country) AS n_countries FROM enriched WHERE athlete_country IS NOT NULL GROUP BY 1"
        ),
        "bitmap_athletes_per_year": race(athletes.format("event_year", "event_year")),
        "bitmap_athletes_per_span": race(athletes.format(span, "first_year")),
        "stream_batch_compare": race("SELECT '' AS side, *, cast(0 AS bigint) AS n FROM silver WHERE false"),
        "stream_bronze_lineage": feed_query(
            f"SELECT {folder} AS landing_folder, year_of_event, count(*) AS n_rows FROM feed GROUP BY 1, 2"
        ),
        "landed_text_profile": feed_query(
            f"SELECT {folder} AS landing_folder, count(*) AS n_rows, {len(FEED_COLUMNS)} AS n_columns,"
            " count(DISTINCT nullif(upper(trim(athlete_country)), '')) AS n_countries FROM feed GROUP BY 1"
        ),
    }


def base_queries() -> dict[str, str]:
    return {
        "orders_yoy_growth": (
            f"WITH y AS (SELECT {OYEAR} AS o_year, count(*) AS n_orders FROM orders GROUP BY 1)"
            " SELECT o_year, n_orders, lag(n_orders) OVER w AS prev_n_orders,"
            f" {R('100.0 * (n_orders - lag(n_orders) OVER w) / nullif(lag(n_orders) OVER w, 0)', 1)} AS growth_pct"
            " FROM y WINDOW w AS (ORDER BY o_year NULLS FIRST)"
        ),
        "customer_debut_cohorts": (
            f"WITH f AS (SELECT o_custkey, min({OYEAR}) AS o_year FROM orders WHERE o_orderdate IS NOT NULL"
            " GROUP BY o_custkey) SELECT o_year, count(*) AS new_customers,"
            " cast(sum(count(*)) OVER (ORDER BY o_year) AS bigint) AS cumulative_customers FROM f GROUP BY o_year"
        ),
        "orders_record_low_price": (
            f"WITH y AS (SELECT {OYEAR} AS o_year, min(o_totalprice) AS year_min_price FROM orders GROUP BY 1)"
            " SELECT o_year, year_min_price, min(year_min_price) OVER (ORDER BY o_year NULLS FIRST) AS record_to_date FROM y"
        ),
        "customer_latest_order": (
            "SELECT o_custkey, o_orderpriority, o_orderstatus FROM (SELECT o_custkey, o_orderpriority, o_orderstatus,"
            " row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders"
            " WHERE o_orderkey IS NOT NULL) WHERE rn = 1"
        ),
        "orders_date_dim": _date_dim_select("d")
        + " FROM (SELECT cast(o_orderdate AS date) AS d FROM orders) WHERE d IS NOT NULL",
        "nation_customer_top": (
            "SELECT coalesce(n.n_name, cast(c.c_nationkey AS varchar)) AS nation, c.c_nationkey, count(*) AS n_customers,"
            f" {R('avg(c.c_acctbal)', 2)} AS avg_acctbal FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
            " GROUP BY 1, 2 ORDER BY n_customers DESC, c_nationkey NULLS FIRST LIMIT 10"
        ),
        "nations_per_year": (
            f"SELECT {OYEAR} AS o_year, count(DISTINCT c_nationkey) AS n_nations FROM orders"
            " JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IS NOT NULL GROUP BY 1"
        ),
        "returnflag_share": (
            "WITH g AS (SELECT cast(year(l_shipdate) AS int) AS ship_year, l_returnflag, count(*) AS n FROM lineitem"
            " GROUP BY 1, 2) SELECT ship_year, l_returnflag, n,"
            f" {R('100.0 * n / sum(n) OVER (PARTITION BY ship_year)', 1)} AS share_pct FROM g"
        ),
        "part_size_buckets": (
            "SELECT cast(floor(p_size / 5) * 5 AS bigint) AS size_bucket, count(*) AS n_parts FROM part GROUP BY 1"
        ),
        "quantity_band_price": with_ctes(
            "x AS (SELECT CASE WHEN l_quantity IS NULL THEN NULL WHEN l_quantity < 10 THEN '1-9' WHEN l_quantity < 25 THEN '10-24'"
            " WHEN l_quantity < 40 THEN '25-39' ELSE '40+' END AS quantity_band, l_quantity, l_extendedprice FROM lineitem)",
            body=(
                f"SELECT b.quantity_band, b.n_lines, b.avg_price, {R('m.q', 2)} AS median_price FROM"
                f" (SELECT quantity_band, count(*) AS n_lines, {R('avg(l_extendedprice)', 2)} AS avg_price"
                " FROM x GROUP BY quantity_band) b LEFT JOIN"
                f" ({pct_disc('x', 'l_extendedprice', 0.5, ['quantity_band'])}) m USING (quantity_band)"
            ),
        ),
        "orders_hash_keys": (
            "SELECT o_orderkey, sha256(concat_ws('|', coalesce(cast(o_orderkey AS varchar), ''),"
            " coalesce(cast(o_custkey AS varchar), ''), coalesce(o_orderstatus, ''), coalesce(o_orderpriority, '')))"
            " AS order_hash, sha256(coalesce(cast(o_custkey AS varchar), '')) AS customer_hash FROM orders"
        ),
        "events_props_validated": _events_sql(),
        "event_specs_validated": _event_specs_sql(),
        "segment_debut_cohorts": (
            f"WITH f AS (SELECT c_mktsegment, o_custkey, min({OYEAR}) AS o_year FROM orders JOIN customer ON o_custkey = c_custkey"
            " WHERE o_orderdate IS NOT NULL GROUP BY 1, 2) SELECT c_mktsegment, o_year, count(*) AS new_customers,"
            " cast(sum(count(*)) OVER (PARTITION BY c_mktsegment ORDER BY o_year) AS bigint) AS cumulative_customers FROM f GROUP BY 1, 2"
        ),
        "tpch_star_audit": _audit_sql(),
        "orders_compare": _compare_sql(),
        "lineitem_profile": _profile_sql(),
        "events_record_value": (
            f"WITH s AS (SELECT {SECOND} AS second, max(value) AS second_max FROM events GROUP BY 1)"
            " SELECT second, second_max, max(second_max) OVER (ORDER BY second NULLS FIRST) AS max_to_date FROM s"
        ),
        "events_growth": (
            f"WITH s AS (SELECT {SECOND} AS second, count(*) AS n_events FROM events GROUP BY 1)"
            " SELECT second, n_events, lag(n_events) OVER w AS prev_n_events,"
            f" {R('100.0 * (n_events - lag(n_events) OVER w) / nullif(lag(n_events) OVER w, 0)', 1)} AS growth_pct"
            " FROM s WINDOW w AS (ORDER BY second NULLS FIRST)"
        ),
        "events_user_debuts": (
            f"WITH f AS (SELECT event_type, user_id, min({SECOND}) AS second FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)"
            " SELECT event_type, second, count(*) AS new_users,"
            " cast(sum(count(*)) OVER (PARTITION BY event_type ORDER BY second) AS bigint) AS cumulative_users FROM f GROUP BY 1, 2"
        ),
        "events_sample": (
            "WITH d AS (SELECT event_type, event_id, value,"
            " (cast(cast('0x' || substr(md5(cast(event_id AS varchar)), 1, 12) AS bigint) AS double) + 1) / 281474976710656.0 AS draw FROM events),"
            " r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY draw, event_id) AS nth FROM d)"
            " SELECT event_type, event_id, value, 1.0 / coalesce((SELECT e.draw FROM r e WHERE e.nth = 26 AND e.event_type IS NOT DISTINCT FROM r.event_type), 1.0)"
            " AS weight FROM r WHERE nth <= 25"
        ),
        "lineitem_frequent_parts": (
            "SELECT l_partkey, count(*) AS n_lines FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY n_lines DESC, l_partkey LIMIT 20"
        ),
    }


def all_oracles() -> dict[str, str]:
    return {**race_queries(), **ingest_queries(), **eda_queries(), **base_queries()}
