"""Every registered query, each with the SQL that must give the same rows.

The inputs are the star-schema tables seen as flights, airlines and airports (``star_tables``). The SQL
states the same view once more, on its own, in the common table expressions below.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally import schemas
from skytally.functions import scalars
from skytally.operators import aggregates, filters, joins, ranking
from skytally.plans import batch, bronze, indicators, silver
from skytally.session import configure, settings
from skytally.sources import files, star_tables as star, zones
from skytally.sources.workspace import new_folder, written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_CTES = {
    "airports": """
        SELECT n_nationkey AS iata, n_name AS name, r_name AS continent
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "airlines": """
        SELECT s_name AS name, s_suppkey AS icao, n_name AS country
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "flights": """
        SELECT l_partkey AS registration, l_suppkey AS airline_icao, s_name AS airline_name,
               s_nationkey AS origin_airport, c_nationkey AS destination_airport,
               p_name AS aircraft_model_text, o_orderdate AS real_departure,
               o_orderdate AS scheduled_departure, l_shipdate AS scheduled_arrival,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS flying
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN part ON l_partkey = p_partkey""",
    "raw_airports": """
        SELECT c_name AS name, c_custkey AS iata, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "countries": """
        SELECT n_name AS country, r_name AS continent
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""",
    # Landed listing and details, side by side: one row per line item.
    "landed": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(l_quantity AS BIGINT)) AS flight_id,
               l_returnflag <> 'R' AS has_id,
               s_acctbal >= 0 AS has_airline,
               s_acctbal >= 0 AND l_tax <> 0 AS has_code,
               l_discount <> 0 AS has_aircraft,
               o_orderstatus <> 'P' AS has_real,
               l_linestatus = 'O' AS in_air,
               CAST(s_nationkey AS VARCHAR) AS origin_airport,
               CAST(c_nationkey AS VARCHAR) AS destination_airport,
               CAST(l_suppkey AS VARCHAR) AS icao, s_name, p_name, p_type,
               CAST(l_partkey AS VARCHAR) AS registration, CAST(s_nationkey AS VARCHAR) AS airline_iata,
               p_size, p_partkey, p_brand, l_linenumber, l_quantity,
               CAST(epoch(o_orderdate) AS BIGINT) AS departure,
               CAST(epoch(l_shipdate) AS BIGINT) AS arrival,
               o_orderdate, l_shipdate
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN part ON l_partkey = p_partkey""",
}


def _register(name: str, sql: str, *tables: str) -> Callable[[Query], Query]:
    """Enter a query; ``tables`` are the common table expressions its SQL reads, in order."""

    def enter(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return _wall_clock(query(spark, sf_dir))

        QUERIES[name] = run
        head = ",".join(f"\n    {t} AS ({_CTES[t]})" for t in tables)
        SQL[name] = f"WITH{head}\n{sql.strip()}" if tables else sql.strip()
        return query

    return enter


def _wall_clock(df: DataFrame) -> DataFrame:
    """Points in time as UTC wall-clock times, the type the tables were given in."""
    times = {c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(times) if times else df


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` filled from the tables of ``sf_dir``, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = _fresh(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _fresh(spark: SparkSession, name: str) -> str:
    """A path in the work folder where nothing is yet."""
    return f"{new_folder(spark, name)}/data"


# --- Indicators -----------------------------------------------------------------------------------


@_register(
    "q1_top_airline",
    """
    SELECT airline_name, count(*) AS flight_count FROM flights WHERE flying = 1
    GROUP BY airline_name ORDER BY flight_count DESC, airline_name LIMIT 1""",
    "flights",
)
def q1_top_airline(spark, sf_dir):
    return indicators.top_airline(star.flights(spark, sf_dir, "airline_name", "flying"))


_REGIONAL = """
    , counts AS (
        SELECT o.continent AS origin_continent, f.airline_name, count(*) AS flight_count
        FROM flights f
        JOIN airlines a ON f.airline_icao = a.icao
        JOIN airports o ON f.origin_airport = o.iata
        JOIN airports d ON f.destination_airport = d.iata
        WHERE o.continent = d.continent {extra}
        GROUP BY o.continent, f.airline_name),
    ranked AS (
        SELECT *, dense_rank() OVER (PARTITION BY origin_continent ORDER BY flight_count DESC) AS position
        FROM counts)
    SELECT origin_continent, airline_name, flight_count FROM ranked WHERE position = 1"""
_ROUTES = ("airline_icao", "airline_name", "origin_airport", "destination_airport")


@_register("q2_regional_all", _REGIONAL.format(extra=""), "airports", "airlines", "flights")
def q2_regional_all(spark, sf_dir):
    flights = star.flights(spark, sf_dir, *_ROUTES)
    return indicators.regional_leaders(
        flights, star.airlines(spark, sf_dir), star.airports(spark, sf_dir), active_only=False
    )


@_register(
    "q2_regional_active", _REGIONAL.format(extra="AND f.flying = 1"), "airports", "airlines", "flights"
)
def q2_regional_active(spark, sf_dir):
    flights = star.flights(spark, sf_dir, *_ROUTES, "flying")
    return indicators.regional_leaders(
        flights, star.airlines(spark, sf_dir), star.airports(spark, sf_dir), active_only=True
    )


@_register(
    "q3_longest_flight",
    """
    , lengths AS (
        SELECT registration, origin_airport, destination_airport, scheduled_arrival, real_departure,
               round((epoch(scheduled_arrival) - epoch(real_departure)) / 3600, 2) AS duration_hours
        FROM flights WHERE flying = 1)
    SELECT DISTINCT * FROM lengths
    WHERE duration_hours = (SELECT max(duration_hours) FROM lengths)""",
    "flights",
)
def q3_longest_flight(spark, sf_dir):
    return indicators.longest_flights(star.flights(spark, sf_dir))


@_register(
    "q4_avg_duration",
    """
    SELECT o.continent,
           round(avg((epoch(scheduled_arrival) - epoch(scheduled_departure)) / 3600), 6) AS avg_duration
    FROM flights f
    JOIN airports o ON f.origin_airport = o.iata
    JOIN airports d ON f.destination_airport = d.iata
    WHERE f.flying = 1 GROUP BY o.continent""",
    "airports",
    "flights",
)
def q4_avg_duration(spark, sf_dir):
    flights = star.flights(
        spark, sf_dir, "flying", "origin_airport", "destination_airport", "scheduled_departure",
        "scheduled_arrival",
    )
    means = indicators.mean_duration(flights, star.airports(spark, sf_dir))
    return means.withColumn("avg_duration", F.round("avg_duration", 6))


@_register(
    "q5_top_maker",
    """
    SELECT split_part(aircraft_model_text, ' ', 1) AS construction_company, count(*) AS flight_count
    FROM flights WHERE flying = 1
    GROUP BY construction_company ORDER BY flight_count DESC, construction_company LIMIT 1""",
    "flights",
)
def q5_top_maker(spark, sf_dir):
    return indicators.top_maker(star.flights(spark, sf_dir, "aircraft_model_text", "flying"))


@_register(
    "q6_top_models",
    """
    , counts AS (
        SELECT country, aircraft_model_text, count(*) AS flight_count
        FROM flights JOIN airlines ON airline_icao = icao GROUP BY country, aircraft_model_text),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY country ORDER BY flight_count DESC, aircraft_model_text) AS "rank"
        FROM counts)
    SELECT country, aircraft_model_text, flight_count, "rank" FROM ranked WHERE "rank" <= 3""",
    "airlines",
    "flights",
)
def q6_top_models(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "airline_icao", "aircraft_model_text")
    top = indicators.top_models(flights, star.airlines(spark, sf_dir))
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@_register(
    "q7_airport_imbalance",
    """
    , ends AS (
        SELECT origin_airport AS airport, 1 AS departing, 0 AS arriving FROM flights
        UNION ALL SELECT destination_airport, 0, 1 FROM flights)
    SELECT airport, CAST(sum(departing) AS BIGINT) AS departures, CAST(sum(arriving) AS BIGINT) AS arrivals,
           CAST(abs(sum(departing) - sum(arriving)) AS BIGINT) AS difference
    FROM ends WHERE airport IS NOT NULL
    GROUP BY airport ORDER BY difference DESC, airport LIMIT 1""",
    "flights",
)
def q7_airport_imbalance(spark, sf_dir):
    return indicators.airport_imbalance(
        star.flights(spark, sf_dir, "origin_airport", "destination_airport")
    )


# --- Filters, projections, generators -------------------------------------------------------------


@_register(
    "active_flights",
    "SELECT registration, airline_icao, scheduled_arrival, flying FROM flights WHERE flying = 1",
    "flights",
)
def active_flights(spark, sf_dir):
    return filters.active(
        star.flights(spark, sf_dir, "registration", "airline_icao", "scheduled_arrival", "flying")
    )


@_register(
    "regional_flights",
    """
    SELECT registration, origin_airport, destination_airport, o.continent AS origin_continent,
           d.continent AS destination_continent
    FROM flights
    JOIN airports o ON origin_airport = o.iata
    JOIN airports d ON destination_airport = d.iata
    WHERE o.continent = d.continent""",
    "airports",
    "flights",
)
def regional_flights(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "origin_airport", "destination_airport")
    return filters.regional(joins.with_airports(flights, star.airports(spark, sf_dir)))


@_register(
    "required_fields",
    """
    SELECT l_orderkey, l_linenumber, first_text, second_text FROM (
        SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS first_text,
               CASE WHEN l_linestatus = 'O' THEN l_linestatus ELSE '' END AS second_text
        FROM lineitem)
    WHERE first_text IS NOT NULL AND first_text <> '' AND second_text IS NOT NULL AND second_text <> ''""",
)
def required_fields(spark, sf_dir):
    gaps = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("R")).alias("first_text"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).otherwise("").alias("second_text"),
    )
    return filters.with_required(gaps, "first_text", "second_text")


@_register(
    "computed_column",
    """
    SELECT registration, scheduled_arrival, real_departure,
           CAST(epoch(scheduled_arrival) - epoch(real_departure) AS BIGINT) AS duration_seconds
    FROM flights""",
    "flights",
)
def computed_column(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "scheduled_arrival", "real_departure")
    return flights.withColumn(
        "duration_seconds", scalars.seconds_between("real_departure", "scheduled_arrival")
    )


_AIRLINE_CHUNK = 1000  # airlines per wrapped document


def _wrapped_airlines(spark, sf_dir) -> DataFrame:
    """Documents that each wrap the airlines of one range of keys, so that none grows with the table."""
    record = F.struct("name", F.col("icao").cast("string").alias("icao"), "country")
    chunk = F.floor(F.col("icao") / _AIRLINE_CHUNK)
    return (
        star.airlines(spark, sf_dir)
        .groupBy(chunk.alias("chunk"))
        .agg(F.collect_list(record).alias("airlines"))
        .select("airlines")
    )


_AIRLINE_RECORDS = "SELECT name, CAST(icao AS VARCHAR) AS icao, country FROM airlines"


@_register("explode_structs", _AIRLINE_RECORDS, "airlines")
def explode_structs(spark, sf_dir):
    return files.unwrap(_wrapped_airlines(spark, sf_dir), "airlines")


@_register(
    "nested_fields",
    """
    SELECT flight_id AS id, CASE WHEN has_aircraft THEN p_name END AS model_text,
           CASE WHEN has_code THEN icao END AS airline_icao,
           CASE WHEN has_real THEN departure END AS real_departure
    FROM landed""",
    "landed",
)
def nested_fields(spark, sf_dir):
    return star.details(spark, sf_dir).select(
        "id",
        F.col("aircraft.model.text").alias("model_text"),
        F.col("airline.code.icao").alias("airline_icao"),
        F.col("time.real.departure").alias("real_departure"),
    )


def _sound_flights(spark, sf_dir) -> DataFrame:
    """Bronze flights of all listed line items, refused ones left out."""
    lines = _joined_lines(spark, sf_dir)
    # Ids are counted by their hash, before details are laid out by id.
    ids = star.with_id(lines).select("id")
    shaped = bronze.shape_flights(star.as_listing(lines), _landed_details(lines), ids)
    return shaped.filter(F.col("outcome") == "good")


def _joined_lines(spark, sf_dir) -> DataFrame:
    """Line items joined and written once, for the listing and each reading of the details.

    A key that a side holds twice only repeats entries, of which bronze keeps one per id.
    """
    lines = star.with_sides(spark, sf_dir, star.line_items(spark, sf_dir), routes=True)
    path = _once(spark, sf_dir, "lines", lambda path: files.write_parquet(lines, path, codec="zstd"))
    return files.read_parquet(spark, path, lines.schema)


def _landed_details(lines: DataFrame) -> DataFrame:
    """Details of joined line items; each reading lays these out by id while narrow."""
    return star.as_details(star.with_id(lines).repartition("id"))


# The silver view of the landed flights.
_SILVER = """
    , silver AS (
        SELECT CASE WHEN has_aircraft THEN CAST(p_size AS VARCHAR) END AS aircraft_age,
               CASE WHEN has_aircraft THEN CAST(p_size + 1000 AS BIGINT) END AS aircraft_countryId,
               CASE WHEN has_aircraft THEN hex(p_partkey) END AS aircraft_hex,
               CASE WHEN has_aircraft THEN p_type END AS aircraft_model_code,
               CASE WHEN has_aircraft THEN p_name END AS aircraft_model_text,
               CASE WHEN has_aircraft THEN p_brand END AS aircraft_msn,
               CASE WHEN has_aircraft THEN registration END AS registration,
               airline_iata, icao AS airline_icao, s_name AS airline_name, reverse(s_name) AS airline_short,
               lower(s_name) AS airline_url, origin_airport, destination_airport,
               CASE WHEN in_air THEN 1 ELSE 0 END AS flying,
               CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS VARCHAR) END AS historical_delay,
               CASE WHEN l_linenumber > 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END
                   AS historical_flighttime,
               arrival + 7 AS other_eta, departure + 3 AS other_updated,
               l_shipdate + INTERVAL 120 SECOND AS estimated_arrival,
               o_orderdate + INTERVAL 60 SECOND AS estimated_departure,
               CASE WHEN NOT in_air THEN l_shipdate END AS real_arrival, o_orderdate AS real_departure,
               l_shipdate AS scheduled_arrival, o_orderdate AS scheduled_departure
        FROM landed WHERE has_id AND has_code AND has_real)"""


@_register("flatten_flights", _SILVER + "\n    SELECT * FROM silver", "landed")
def flatten_flights(spark, sf_dir):
    return silver.flatten(_sound_flights(spark, sf_dir))


@_register("dedup_flights", _SILVER + "\n    SELECT DISTINCT * FROM silver", "landed")
def dedup_flights(spark, sf_dir):
    """Every flight that has an aircraft arrives twice."""
    sound = written(_sound_flights(spark, sf_dir), "sound-flights", "zstd")
    times = F.when(F.col("aircraft").isNotNull(), 2).otherwise(1)
    return silver.flights(sound.withColumn("arrived", F.explode(F.sequence(F.lit(1), times))).drop("arrived"))


# --- Joins ----------------------------------------------------------------------------------------


@_register(
    "join_airline",
    """
    SELECT registration, airline_icao, airline_name, country
    FROM flights JOIN airlines ON airline_icao = icao""",
    "airlines",
    "flights",
)
def join_airline(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "airline_icao", "airline_name")
    return joins.with_airline(flights, star.airlines(spark, sf_dir))


@_register(
    "join_origin_destination",
    """
    SELECT registration, origin_airport, destination_airport, o.continent AS origin_continent,
           d.continent AS destination_continent
    FROM flights
    JOIN airports o ON origin_airport = o.iata
    JOIN airports d ON destination_airport = d.iata""",
    "airports",
    "flights",
)
def join_origin_destination(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "origin_airport", "destination_airport")
    return joins.with_airports(flights, star.airports(spark, sf_dir))


@_register(
    "join_star",
    """
    SELECT registration, airline_icao, origin_airport, destination_airport, country,
           o.continent AS origin_continent, d.continent AS destination_continent
    FROM flights
    JOIN airlines ON airline_icao = icao
    JOIN airports o ON origin_airport = o.iata
    JOIN airports d ON destination_airport = d.iata""",
    "airports",
    "airlines",
    "flights",
)
def join_star(spark, sf_dir):
    flights = star.flights(
        spark, sf_dir, "registration", "airline_icao", "origin_airport", "destination_airport"
    )
    return joins.star(flights, star.airlines(spark, sf_dir), star.airports(spark, sf_dir))


@_register(
    "join_airline_exists",
    """
    SELECT registration, airline_icao FROM flights
    WHERE airline_icao IN (SELECT icao FROM airlines WHERE country < 'NATION_2')""",
    "airlines",
    "flights",
)
def join_airline_exists(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "airline_icao")
    # Some airlines are unknown, and the known ones are listed twice.
    known = star.airlines(spark, sf_dir).filter(F.col("country") < "NATION_2")
    return joins.of_known_airline(flights, known.unionAll(known))


# --- Aggregations ---------------------------------------------------------------------------------


@_register(
    "count_by_key",
    "SELECT airline_name, count(*) AS flight_count FROM flights GROUP BY airline_name",
    "flights",
)
def count_by_key(spark, sf_dir):
    return aggregates.count_by(star.flights(spark, sf_dir, "airline_name"), "airline_name")


@_register(
    "count_by_two_keys",
    """
    SELECT origin_airport, aircraft_model_text, count(*) AS flight_count
    FROM flights GROUP BY origin_airport, aircraft_model_text""",
    "flights",
)
def count_by_two_keys(spark, sf_dir):
    keys = ("origin_airport", "aircraft_model_text")
    return aggregates.count_by(star.flights(spark, sf_dir, *keys), *keys)


@_register(
    "avg_by_key",
    """
    SELECT origin_airport,
           round(avg(CASE WHEN flying = 1
               THEN (epoch(scheduled_arrival) - epoch(scheduled_departure)) / 3600 END), 6) AS mean_hours
    FROM flights GROUP BY origin_airport""",
    "flights",
)
def avg_by_key(spark, sf_dir):
    flights = star.flights(
        spark, sf_dir, "origin_airport", "flying", "scheduled_departure", "scheduled_arrival"
    )
    hours = F.when(F.col("flying") == 1, scalars.hours_between("scheduled_departure", "scheduled_arrival"))
    means = aggregates.mean_by(flights.withColumn("hours", hours), "origin_airport", "hours", "mean_hours")
    return means.withColumn("mean_hours", F.round("mean_hours", 6))


@_register(
    "rows_at_global_max",
    """
    SELECT registration, airline_icao, scheduled_arrival FROM flights
    WHERE scheduled_arrival = (SELECT max(scheduled_arrival) FROM flights)""",
    "flights",
)
def rows_at_global_max(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "airline_icao", "scheduled_arrival")
    return aggregates.rows_at_maximum(flights, "scheduled_arrival")


@_register("dedup_all", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_all(spark, sf_dir):
    return star.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@_register(
    "distinct_rows",
    "SELECT DISTINCT registration, origin_airport, destination_airport FROM flights",
    "flights",
)
def distinct_rows(spark, sf_dir):
    return star.flights(spark, sf_dir, "registration", "origin_airport", "destination_airport").distinct()


# --- Ranking --------------------------------------------------------------------------------------


@_register(
    "rank_top1_ties",
    """
    , counts AS (
        SELECT origin_airport, registration, count(*) AS flight_count
        FROM flights GROUP BY origin_airport, registration)
    SELECT origin_airport, registration, flight_count FROM (
        SELECT *, dense_rank() OVER (PARTITION BY origin_airport ORDER BY flight_count DESC) AS position
        FROM counts)
    WHERE position = 1""",
    "flights",
)
def rank_top1_ties(spark, sf_dir):
    keys = ("origin_airport", "registration")
    counts = aggregates.count_by(star.flights(spark, sf_dir, *keys), *keys)
    return ranking.leaders_by(counts, "origin_airport", "flight_count")


@_register(
    "rank_top3",
    """
    , counts AS (
        SELECT origin_airport, registration, count(*) AS flight_count
        FROM flights GROUP BY origin_airport, registration)
    SELECT origin_airport, registration, flight_count, position FROM (
        SELECT *, row_number() OVER (
            PARTITION BY origin_airport ORDER BY flight_count DESC, registration) AS position
        FROM counts)
    WHERE position <= 3""",
    "flights",
)
def rank_top3(spark, sf_dir):
    keys = ("origin_airport", "registration")
    counts = aggregates.count_by(star.flights(spark, sf_dir, *keys), *keys)
    top = ranking.top_n_by(counts, "origin_airport", "flight_count", "registration", 3, rank="position")
    return top.withColumn("position", F.col("position").cast("bigint"))


@_register(
    "top1",
    """
    SELECT destination_airport, count(*) AS flight_count FROM flights
    GROUP BY destination_airport ORDER BY flight_count DESC, destination_airport LIMIT 1""",
    "flights",
)
def top1(spark, sf_dir):
    counts = aggregates.count_by(star.flights(spark, sf_dir, "destination_airport"), "destination_airport")
    return ranking.top_one(counts, "flight_count", "destination_airport")


# --- Scalar functions -----------------------------------------------------------------------------


@_register(
    "cast_bool_int",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS flying
    FROM lineitem""",
)
def cast_bool_int(spark, sf_dir):
    lines = star.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", scalars.flag(F.col("l_linestatus") == "O").alias("flying"))


@_register(
    "epoch_to_timestamp",
    """
    SELECT flight_id AS id, CASE WHEN has_real THEN o_orderdate END AS real_departure,
           CASE WHEN has_real THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS departure_text,
           l_shipdate AS scheduled_arrival,
           CASE WHEN arrival // 86400 % 4 = 0 THEN l_shipdate END AS arrival_if_sound
    FROM landed""",
    "landed",
)
def epoch_to_timestamp(spark, sf_dir):
    arrival = F.col("time.scheduled.arrival")
    return star.details(spark, sf_dir).select(
        "id",
        scalars.moment("time.real.departure").alias("real_departure"),
        F.from_unixtime("time.real.departure").alias("departure_text"),
        scalars.moment("time.scheduled.arrival").alias("scheduled_arrival"),
        scalars.moment(_spoilt_epoch(arrival, F.floor(arrival / 86400) % 4)).alias("arrival_if_sound"),
    )


def _spoilt_epoch(epoch, kind):
    """Epoch seconds; for kinds 1 to 3, a number that no calendar has."""
    return (
        F.when(kind == 1, F.lit(10**13)).when(kind == 2, F.lit(17 * 10**17)).when(kind == 3, F.lit(-(10**18))).otherwise(epoch)
    )


@_register(
    "timestamp_to_epoch",
    """
    SELECT registration, CAST(epoch(scheduled_arrival) AS BIGINT) AS arrival_epoch,
           CAST(epoch(real_departure) AS BIGINT) AS departure_epoch
    FROM flights""",
    "flights",
)
def timestamp_to_epoch(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "scheduled_arrival", "real_departure")
    return flights.select(
        "registration",
        scalars.epoch("scheduled_arrival").alias("arrival_epoch"),
        scalars.epoch("real_departure").alias("departure_epoch"),
    )


@_register(
    "duration_hours",
    """
    SELECT event_id, ((seconds * 100 + 1800) // 3600) / 100 AS hours  -- halves round up
    FROM (SELECT event_id, epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01') // 1000000 AS seconds
          FROM events)""",
)
def duration_hours(spark, sf_dir):
    opening = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return star.events(spark, sf_dir).select(
        "event_id", scalars.hours_between(opening, "ts", digits=2).alias("hours")
    )


@_register(
    "first_token",
    "SELECT registration, split_part(aircraft_model_text, ' ', 1) AS maker FROM flights",
    "flights",
)
def first_token(spark, sf_dir):
    flights = star.flights(spark, sf_dir, "registration", "aircraft_model_text")
    return flights.select("registration", scalars.first_word("aircraft_model_text").alias("maker"))


# --- Bronze shaping -------------------------------------------------------------------------------


@_register(
    "bronze_id_filter",
    """
    SELECT flight_id AS id, origin_airport AS origin_airport_iata,
           destination_airport AS destination_airport_iata
    FROM landed WHERE has_id""",
    "landed",
)
def bronze_id_filter(spark, sf_dir):
    return bronze.with_id(star.listing(spark, sf_dir))


@_register(
    "bronze_detail_join",
    """
    SELECT l.flight_id AS id, l.origin_airport, l.destination_airport,
           CASE WHEN d.has_airline THEN d.s_name END AS airline_name,
           CASE WHEN d.has_aircraft THEN d.registration END AS registration, d.arrival AS scheduled_arrival
    FROM landed l JOIN landed d ON l.flight_id = d.flight_id WHERE l.has_id""",
    "landed",
)
def bronze_detail_join(spark, sf_dir):
    listed = bronze.with_id(star.listing(spark, sf_dir))
    return bronze.with_details(listed, star.details(spark, sf_dir)).select(
        "id",
        "origin_airport",
        "destination_airport",
        F.col("airline.name").alias("airline_name"),
        F.col("aircraft.registration").alias("registration"),
        F.col("time.scheduled.arrival").alias("scheduled_arrival"),
    )


@_register(
    "bronze_drop_nested",
    """
    SELECT flight_id AS id, CASE WHEN has_aircraft THEN p_name END AS model_text,
           CASE WHEN has_aircraft THEN 'age,countryId,hex,msn,registration,model' END AS aircraft_fields
    FROM landed""",
    "landed",
)
def bronze_drop_nested(spark, sf_dir):
    pruned = bronze.without_images(star.details(spark, sf_dir))
    return pruned.select(
        "id",
        F.col("aircraft.model.text").alias("model_text"),
        F.array_join(F.json_object_keys(F.to_json("aircraft")), ",").alias("aircraft_fields"),
    )


@_register(
    "bronze_require_airline",
    "SELECT flight_id AS id, s_name AS airline_name, icao AS airline_icao FROM landed WHERE has_code",
    "landed",
)
def bronze_require_airline(spark, sf_dir):
    return star.details(spark, sf_dir).filter(bronze.has_airline_code()).select(
        "id", F.col("airline.name").alias("airline_name"), F.col("airline.code.icao").alias("airline_icao")
    )


@_register(
    "bronze_time_guard",
    """
    SELECT flight_id AS id, departure AS real_departure, CASE WHEN NOT in_air THEN arrival END AS real_arrival
    FROM landed WHERE has_real""",
    "landed",
)
def bronze_time_guard(spark, sf_dir):
    return star.details(spark, sf_dir).filter(bronze.has_real_times()).select(
        "id",
        F.col("time.real.departure").alias("real_departure"),
        F.col("time.real.arrival").alias("real_arrival"),
    )


@_register(
    "bronze_flying", "SELECT flight_id AS id, in_air AS flying FROM landed WHERE has_real", "landed"
)
def bronze_flying(spark, sf_dir):
    timed = star.details(spark, sf_dir).filter(bronze.has_real_times())
    return bronze.with_flying(timed).select("id", "flying")


@_register(
    "bronze_promote_key",
    "SELECT flight_id AS id, CASE WHEN has_code THEN icao END AS icao FROM landed",
    "landed",
)
def bronze_promote_key(spark, sf_dir):
    return bronze.with_icao(star.details(spark, sf_dir)).select("id", "icao")


@_register(
    "airport_continent",
    "SELECT name, iata, continent FROM raw_airports JOIN countries USING (country)",
    "raw_airports",
    "countries",
)
def airport_continent(spark, sf_dir):
    return bronze.with_continent(star.raw_airports(spark, sf_dir), _known_countries(spark, sf_dir))


@_register(
    "airport_continent_rejects",
    "SELECT name, iata, country FROM raw_airports WHERE country NOT IN (SELECT country FROM countries)",
    "raw_airports",
    "countries",
)
def airport_continent_rejects(spark, sf_dir):
    return bronze.without_continent(star.raw_airports(spark, sf_dir), _known_countries(spark, sf_dir))


def _known_countries(spark, sf_dir) -> DataFrame:
    """Countries of all continents but one, so that some airports don't match."""
    return star.countries(spark, sf_dir).filter(F.col("continent") != "ASIA")


@_register("airlines_projection", "SELECT name, icao, country FROM airlines", "airlines")
def airlines_projection(spark, sf_dir):
    return bronze.airline_records(star.airlines(spark, sf_dir))


@_register(
    "reject_split",
    """
    SELECT flight_id AS id, CASE WHEN reason IS NULL THEN 'good' ELSE 'reject' END AS outcome, reason,
           CASE WHEN NOT broken AND has_airline THEN s_name END AS airline_name
    FROM (
        SELECT *, NOT has_id AS broken,
               CASE WHEN NOT has_id OR (has_aircraft AND p_type = 'ECONOMY') THEN 'corrupt'
                    WHEN has_airline IS NOT TRUE OR has_code IS NOT TRUE THEN 'no_airline_code'
                    WHEN has_real IS NOT TRUE THEN 'no_real_times'
                    WHEN has_aircraft AND p_partkey % 4 <> 0 THEN 'bad_epoch' END AS reason
        FROM landed)""",
    "landed",
)
def reject_split(spark, sf_dir):
    spoilt = _spoilt_details(spark, sf_dir)
    path = _once(spark, sf_dir, "spoilt", lambda path: files.compressed_lines(spoilt.write).text(path))
    marked = bronze.verdict(files.read_json_lines(spark, path, schemas.DETAILS))
    # What did not parse can still be traced by the id in its text.
    traced = F.coalesce("id", F.regexp_extract(schemas.CORRUPT, '"id":"([^"]*)"', 1))
    return marked.select(
        traced.alias("id"), "outcome", "reason", F.col("airline.name").alias("airline_name")
    )


def _spoilt_details(spark, sf_dir) -> DataFrame:
    """Detail records as lines of JSON: some cut off, some with a text where a number belongs or an absurd time."""
    listed = star.listing(spark, sf_dir).filter(F.col("id").isNotNull()).select("id", F.lit(True).alias("listed"))
    # Listed ids meet the line items while these are narrow.
    items = star.with_id(star.line_items(spark, sf_dir)).join(listed, "id", "left").drop("id")
    lines = star.with_id(star.with_sides(spark, sf_dir, items))
    details = bronze.without_images(star.as_details(lines, "listed"))
    kind = F.coalesce(F.col("aircraft.registration").cast("long") % 4, F.lit(0))
    departure = _spoilt_epoch(F.col("time.scheduled.departure"), kind)
    time = F.col("time").withField("scheduled.departure", departure)
    text = F.to_json(F.struct("id", "airline", "aircraft", time.alias("time")))
    misfit = F.regexp_replace(text, '"countryId":[0-9]+', '"countryId":"N/A"')
    return details.select(
        F.when(F.col("listed").isNull(), F.substr(text, F.lit(1), F.length(text) - 1))
        .when(F.col("aircraft.model.code") == "ECONOMY", misfit)
        .otherwise(text)
        .alias("value")
    )


# --- Sources and sinks ----------------------------------------------------------------------------


@_register("src_json_wrapped", _AIRLINE_RECORDS, "airlines")
def src_json_wrapped(spark, sf_dir):
    path = _once(
        spark, sf_dir, "wrapped", lambda path: files.write_json(_wrapped_airlines(spark, sf_dir), path)
    )
    return files.read_json_wrapped(spark, path, schemas.BRONZE_AIRLINES)


_BRONZE_COLUMNS = """
    SELECT icao, s_name AS airline_name, CASE WHEN has_aircraft THEN registration END AS registration,
           departure AS real_departure, CASE WHEN NOT in_air THEN arrival END AS real_arrival,
           origin_airport, destination_airport, in_air AS flying
    FROM landed WHERE has_id AND has_code AND has_real"""


def _bronze_files(spark, sf_dir) -> str:
    return _once(
        spark, sf_dir, "bronze", lambda path: files.write_json(_sound_flights(spark, sf_dir), path, compressed=True)
    )


def _bronze_columns(flights: DataFrame) -> DataFrame:
    return flights.select(
        "icao",
        F.col("airline.name").alias("airline_name"),
        F.col("aircraft.registration").alias("registration"),
        F.col("time.real.departure").alias("real_departure"),
        F.col("time.real.arrival").alias("real_arrival"),
        "origin_airport",
        "destination_airport",
        "flying",
    )


@_register("src_json_records", _BRONZE_COLUMNS, "landed")
def src_json_records(spark, sf_dir):
    sound, _ = files.split_corrupt(
        files.read_json_lines(spark, _bronze_files(spark, sf_dir), schemas.BRONZE_FLIGHT), "flights"
    )
    return _bronze_columns(sound)


@_register("sink_json", _BRONZE_COLUMNS, "landed")
def sink_json(spark, sf_dir):
    path = _fresh(spark, "sink")
    files.write_json(_sound_flights(spark, sf_dir), path, compressed=True)
    return _bronze_columns(spark.read.schema(schemas.BRONZE_FLIGHT).json(path))


_STORED = ("registration", "airline_icao", "origin_airport", "real_departure", "scheduled_arrival", "flying")


_ROWS_PER_FILE = 5_000_000


@_register("src_parquet", f"SELECT {', '.join(_STORED)} FROM flights WHERE flying = 1", "flights")
def src_parquet(spark, sf_dir):
    flights = star.flights(spark, sf_dir, *_STORED)
    path = _once(spark, sf_dir, "flights", lambda path: files.write_parquet(flights, path, _ROWS_PER_FILE))
    return filters.active(files.read_parquet(spark, path, flights.schema))


@_register("sink_parquet", f"SELECT {', '.join(_STORED)} FROM flights", "flights")
def sink_parquet(spark, sf_dir):
    path = _fresh(spark, "sink")
    files.write_parquet(star.flights(spark, sf_dir, *_STORED), path, _ROWS_PER_FILE)
    return spark.read.parquet(path)


_DATED = """
    SELECT event_id, user_id, event_type, value, ts, strftime(ts, '%Y') AS tech_year,
           strftime(ts, '%Y-%m') AS tech_month, strftime(ts, '%Y-%m-%d') AS tech_day,
           strftime(ts, '%H') AS tech_hour
    FROM events"""
_EVENT = schemas.struct(
    event_id=T.LongType(), user_id=T.LongType(), event_type=T.StringType(), value=T.DoubleType(),
    ts=T.TimestampType(),
)


def _write_events(spark, sf_dir, path: str) -> None:
    zones.write_by_time(star.events(spark, sf_dir).select(*_EVENT.fieldNames()), path, "ts")


def _dated_events(spark, sf_dir) -> str:
    return _once(spark, sf_dir, "events", lambda path: _write_events(spark, sf_dir, path))


@_register("zone_partition_write", _DATED)
def zone_partition_write(spark, sf_dir):
    path = _fresh(spark, "events")
    _write_events(spark, sf_dir, path)
    return zones.read_table(spark, path, _EVENT)


@_register("zone_partition_read", f"{_DATED} WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def zone_partition_read(spark, sf_dir):
    return zones.read_batch(spark, _dated_events(spark, sf_dir), _EVENT, datetime(2024, 1, 15), levels=3)


@_register(
    "zone_latest_batch", f"{_DATED} WHERE date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM events)"
)
def zone_latest_batch(spark, sf_dir):
    return zones.read_latest(spark, _dated_events(spark, sf_dir), _EVENT)


@_register("zone_date_hour_lookup", f"{_DATED} WHERE date_trunc('hour', ts) = TIMESTAMP '2024-01-15 06:00:00'")
def zone_date_hour_lookup(spark, sf_dir):
    return zones.read_batch(spark, _dated_events(spark, sf_dir), _EVENT, datetime(2024, 1, 15, 6))


# --- Runs -----------------------------------------------------------------------------------------

_RUN_TS = datetime(2024, 1, 15, 6)

# Indicator -> columns that name a result row, and its measure.
_REPORT = {
    "top_airline": (("airline_name",), "flight_count"),
    "regional_all": (("origin_continent", "airline_name"), "flight_count"),
    "regional_active": (("origin_continent", "airline_name"), "flight_count"),
    "longest_flight": (
        ("registration", "origin_airport", "destination_airport", "scheduled_arrival", "real_departure"),
        "duration_hours",
    ),
    "avg_duration": (("continent",), "avg_duration"),
    "top_maker": (("construction_company",), "flight_count"),
    "top_models": (("country", "aircraft_model_text", "rank"), "flight_count"),
    "airport_imbalance": (("airport",), "difference"),
}


def _report(results: dict[str, DataFrame]) -> DataFrame:
    """The rows of all indicators in one shape: indicator, label, measure."""
    parts = []
    for name, (labels, measure) in _REPORT.items():
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in labels]
        parts.append(
            results[name].select(
                F.lit(name).alias("indicator"),
                F.concat_ws("|", *texts).alias("label"),
                F.round(F.col(measure).cast("double"), 6).alias("measure"),
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _report_sql(flights: str, airlines: str, airports: str) -> str:
    """The same report from three tables in silver shape."""
    clock = "strftime({}, '%Y-%m-%d %H:%M:%S')"
    regional = """
        SELECT o.continent AS origin_continent, f.airline_name, count(*) AS n,
               dense_rank() OVER (PARTITION BY o.continent ORDER BY count(*) DESC) AS position
        FROM {flights} f
        JOIN {airlines} a ON f.airline_icao = a.icao
        JOIN {airports} o ON f.origin_airport = o.iata
        JOIN {airports} d ON f.destination_airport = d.iata
        WHERE o.continent = d.continent {extra} GROUP BY o.continent, f.airline_name"""
    names = {"flights": flights, "airlines": airlines, "airports": airports}
    return f"""
    , regional_all AS ({regional.format(extra='', **names)}),
    regional_active AS ({regional.format(extra='AND f.flying = 1', **names)}),
    lengths AS (
        SELECT *, round((epoch(scheduled_arrival) - epoch(real_departure)) / 3600, 2) AS hours
        FROM {flights} WHERE flying = 1),
    models AS (
        SELECT country, aircraft_model_text, count(*) AS n,
               row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, aircraft_model_text) AS position
        FROM {flights} JOIN {airlines} ON airline_icao = icao GROUP BY country, aircraft_model_text),
    ends AS (
        SELECT origin_airport AS airport, 1 AS d FROM {flights}
        UNION ALL SELECT destination_airport, -1 FROM {flights}),
    report AS (
        (SELECT 'top_airline' AS indicator, coalesce(airline_name, '-') AS label, count(*) AS measure
         FROM {flights} WHERE flying = 1 GROUP BY airline_name ORDER BY count(*) DESC, airline_name LIMIT 1)
        UNION ALL
        SELECT 'regional_all', origin_continent || '|' || airline_name, n FROM regional_all WHERE position = 1
        UNION ALL
        SELECT 'regional_active', origin_continent || '|' || airline_name, n
        FROM regional_active WHERE position = 1
        UNION ALL
        SELECT DISTINCT 'longest_flight', concat_ws('|', coalesce(CAST(registration AS VARCHAR), '-'),
            origin_airport, destination_airport, {clock.format('scheduled_arrival')},
            {clock.format('real_departure')}), hours
        FROM lengths WHERE hours = (SELECT max(hours) FROM lengths)
        UNION ALL
        SELECT 'avg_duration', o.continent,
               avg((epoch(scheduled_arrival) - epoch(scheduled_departure)) / 3600)
        FROM {flights} f
        JOIN {airports} o ON f.origin_airport = o.iata
        JOIN {airports} d ON f.destination_airport = d.iata
        WHERE f.flying = 1 GROUP BY o.continent
        UNION ALL
        (SELECT 'top_maker', coalesce(split_part(aircraft_model_text, ' ', 1), '-') AS maker, count(*)
         FROM {flights} WHERE flying = 1 GROUP BY maker ORDER BY count(*) DESC, maker LIMIT 1)
        UNION ALL
        SELECT 'top_models', concat_ws('|', country, coalesce(aircraft_model_text, '-'), position), n
        FROM models WHERE position <= 3
        UNION ALL
        (SELECT 'airport_imbalance', CAST(airport AS VARCHAR), abs(sum(d))
         FROM ends GROUP BY airport ORDER BY abs(sum(d)) DESC, airport LIMIT 1))"""


_SHOW_REPORT = "\n    SELECT indicator, label, round(CAST(measure AS DOUBLE), 6) AS measure FROM report"


def _complete(run: batch.Run) -> batch.Run:
    if run.failed:
        raise RuntimeError(f"failed steps: {run.failed}")
    return run


def _published(run: batch.Run) -> dict[str, DataFrame]:
    return {name: run.spark.read.parquet(run.path(zones.GOLD, name)) for name in _REPORT}


@_register(
    "gold_publish",
    _report_sql("flights", "airlines", "airports") + _SHOW_REPORT,
    "airports",
    "airlines",
    "flights",
)
def gold_publish(spark, sf_dir):
    run = batch.Run(spark, _fresh(spark, "gold"), _RUN_TS)
    flights = star.flights(spark, sf_dir)
    path = _once(spark, sf_dir, "silver-flights", lambda path: files.write_parquet(flights, path))
    written = files.read_parquet(spark, path, flights.schema)
    batch.publish(run, written, star.airlines(spark, sf_dir), star.airports(spark, sf_dir))
    return _report(_published(_complete(run)))


@_register(
    "missing_input_is_empty",
    f"""
    , none AS (SELECT * FROM airlines WHERE false)
    {_report_sql("flights", "none", "airports")}{_SHOW_REPORT}""",
    "airports",
    "airlines",
    "flights",
)
def missing_input_is_empty(spark, sf_dir):
    """All indicators over a batch whose airlines never arrived."""
    absent = files.read_parquet(spark, _fresh(spark, "absent"), schemas.SILVER_AIRLINES)
    flights = star.flights(spark, sf_dir)
    return _report(batch.indicator_plans(flights, absent, star.airports(spark, sf_dir)))


def _land(spark, sf_dir, path: str) -> None:
    """The tables as the snapshot files a run starts from."""
    airports = star.airports(spark, sf_dir).select(
        "name", F.col("iata").cast("string").alias("iata"), F.col("name").alias("country")
    )
    airlines = star.airlines(spark, sf_dir)
    landed = {
        "raw_airports": airports,
        "raw_airlines": airlines.withColumn("icao", F.col("icao").cast("string")),
        "countries": star.countries(spark, sf_dir),
    }
    with settings(spark, batch.FREE_SHUFFLES):
        if (both := star.landed(spark, sf_dir)) is not None:
            files.write_json_columns(both, path)
        else:
            landed |= {"listing": star.listing(spark, sf_dir), "details": star.details(spark, sf_dir)}
        for name, df in landed.items():
            files.write_json(df, f"{path}/{name}", compressed=True)


@_register(
    "landed_to_gold",
    f"""{_SILVER}
    , copies AS (SELECT DISTINCT * FROM silver)
    , places AS (SELECT CAST(iata AS VARCHAR) AS iata, name, continent FROM airports)
    , carriers AS (SELECT name, CAST(icao AS VARCHAR) AS icao, country FROM airlines)
    {_report_sql("copies", "carriers", "places")}{_SHOW_REPORT}""",
    "airports",
    "airlines",
    "landed",
)
def landed_to_gold(spark, sf_dir):
    """A whole run, from landed JSON to published indicators."""
    landing = _once(spark, sf_dir, "landing", lambda path: _land(spark, sf_dir, path))
    return _report(_published(_complete(batch.run(spark, landing, _fresh(spark, "run"), _RUN_TS))))


@_register(
    "run_metrics",
    f"""{_SILVER}
    , copies AS (SELECT DISTINCT * FROM silver)
    , kinds AS (
        SELECT CASE WHEN has_id IS NOT TRUE THEN 'no_id' WHEN has_airline IS NOT TRUE OR has_code IS NOT TRUE
                    THEN 'no_airline_code' WHEN has_real IS NOT TRUE THEN 'no_real_times' END AS reason
        FROM landed)
    , facts AS (
        SELECT count(*) AS flights,
               count(*) FILTER (scheduled_arrival < scheduled_departure) AS negative_durations,
               0 AS missing_durations,
               count(*) FILTER (scheduled_arrival > scheduled_departure + INTERVAL 24 HOUR) AS unlikely_durations,
               count(*) FILTER (airline_icao NOT IN (SELECT CAST(icao AS VARCHAR) FROM airlines))
                   AS unmatched_airline_icao,
               count(*) FILTER (origin_airport NOT IN (SELECT CAST(iata AS VARCHAR) FROM airports))
                   AS unmatched_origin_airport,
               count(*) FILTER (destination_airport NOT IN (SELECT CAST(iata AS VARCHAR) FROM airports))
                   AS unmatched_destination_airport,
               (SELECT count(*) FROM airlines) AS airlines, (SELECT count(*) FROM airports) AS airports,
               (SELECT count(*) FROM silver) AS bronze_flights,
               (SELECT count(*) FROM silver) - (SELECT count(*) FROM copies) AS duplicate_flights,
               0 AS incomplete_airports, 0 AS duplicate_airports, 0 AS incomplete_airlines,
               0 AS duplicate_airlines
        FROM copies)
    , arrived AS (
        SELECT count(*) FILTER (has_id) - count(DISTINCT flight_id) FILTER (has_id) AS listing_copies,
               count(*) - count(DISTINCT flight_id) AS details_versions,
               count(DISTINCT flight_id) FILTER (NOT has_id) AS unlisted_details, 0 AS details_without_id
        FROM landed)
    SELECT 'transform' AS step, metric, value, CAST(NULL AS VARCHAR) AS detail
    FROM (UNPIVOT facts ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL
    SELECT 'extract', metric, value, NULL FROM (UNPIVOT arrived ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL
    SELECT 'extract', 'rejects', count(*), 'flights/' || reason FROM kinds WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL
    SELECT 'extract', 'landed_rows', n, name FROM (VALUES
        ('listing', (SELECT count(*) FROM lineitem)), ('details', (SELECT count(*) FROM lineitem)),
        ('raw_airports', (SELECT count(*) FROM airports)), ('raw_airlines', (SELECT count(*) FROM airlines)),
        ('countries', (SELECT count(*) FROM nation))) AS landed_tables(name, n)""",
    "airports",
    "airlines",
    "landed",
)
def run_metrics(spark, sf_dir):
    """What a whole run counts, but for its times."""
    landing = _once(spark, sf_dir, "landing", lambda path: _land(spark, sf_dir, path))
    run = _complete(batch.run(spark, landing, _fresh(spark, "run"), _RUN_TS))
    log = run.read(zones.GOLD, "run_metrics", schemas.RUN_METRICS)
    return log.filter(F.col("metric") != "milliseconds")
