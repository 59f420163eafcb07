"""One run over one snapshot: landed files to bronze, silver and gold.

``run_ts`` names the batch in every zone; no result depends on the clock. Each step hands over through
written tables only, so a step can be repeated alone, and repeating it replaces its own hour. A step commits its
tables together, at its end: until then, and where it fails, the hour's earlier state is what everyone reads.
What fails is entered in the run log: an indicator does not stop the others, a step stops the next ones,
which would work on an older state. A missing input, and one without rows, is entered too: without flights the step
fails and commits nothing, without a dimension the run goes on. Rows that are not accounted for fail the step.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally import schemas
from skytally.operators.aggregates import one_per_key
from skytally.plans import bronze, indicators, quality, silver
from skytally.session import settings
from skytally.sources import buckets, files, zones


#: Rows of a run are written once and read a few times; zstd takes about two thirds of the space of snappy.
CODEC = "zstd"


@dataclass
class Run:
    spark: SparkSession
    root: str
    run_ts: datetime
    id: str = field(default_factory=zones.new_run)
    log: list[tuple] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)

    def table(self, zone: str, table: str) -> str:
        return zones.table_path(self.root, zone, table)

    def place(self, zone: str, table: str) -> str:
        """Where this run writes a table."""
        return zones.run_path(self.table(zone, table), self.run_ts, self.id)

    def save(self, df: DataFrame, zone: str, table: str) -> None:
        """Write a table of the hour; it counts once the step commits it."""
        zones.write_run(df, self.table(zone, table), self.run_ts, self.id, codec=CODEC)

    def written(self, zone: str, table: str, schema) -> DataFrame:
        """What this run wrote, committed or not."""
        return self.spark.read.schema(schema).parquet(self.place(zone, table))

    def commit(
        self, zone: str, tables: Iterable[str], rows: dict[str, int] | None = None,
        laid_out: dict[str, int] | None = None,
    ) -> None:
        folder = f"{self.root.rstrip('/')}/{zone}"
        zones.commit(self.spark, folder, self.run_ts, dict.fromkeys(tables, self.id), rows, laid_out)

    def _state(self, zone: str) -> dict:
        return zones.committed(self.spark, f"{self.root.rstrip('/')}/{zone}", self.run_ts)

    def committed(self, zone: str) -> dict[str, str]:
        return self._state(zone)["tables"]

    def path(self, zone: str, table: str) -> str | None:
        """Where the committed state of the hour is."""
        run = self.committed(zone).get(table)
        return run and zones.run_path(self.table(zone, table), self.run_ts, run)

    def read(self, zone: str, table: str, schema) -> DataFrame:
        """The committed state of the hour; no rows of the known schema where there is none."""
        path = self.path(zone, table)
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def read_by_id(self, zone: str, table: str, schema) -> DataFrame:
        """The committed state of the hour, laid out by id if it was written so."""
        n = self._state(zone).get("buckets", {}).get(table)
        return buckets.read(self.spark, self.path(zone, table), schema, "id", n) if n else self.read(zone, table, schema)

    def enter_missing(self, step: str, absent: Iterable[str], needed: Collection[str]) -> None:
        """Enter inputs that aren't there, or have no rows, in the run log; raise if a needed one is among them."""
        absent = [name for name in absent if name not in self.missing]
        self.missing += absent
        self.log += [(step, "missing_input", 1, name) for name in absent]
        if lost := [name for name in absent if name in needed]:
            raise FileNotFoundError(f"no rows for {step}: {', '.join(lost)}")

    def balance(self, step: str, what: str, came: int, accounted: int) -> None:
        """Raise unless as many rows are accounted for as came in."""
        if came != accounted:
            raise ArithmeticError(f"{step}: {came} {what} came in, {accounted} are accounted for")

    def attempt(self, step: str, work: Callable[[], None]) -> bool:
        """Do a step and say whether it worked. Its time, or its failure, goes to the run log."""
        start = time.perf_counter()
        try:
            work()
        except Exception as error:
            self.failed.append(step)
            self.log.append((step, "failed", 1, f"{type(error).__name__}: {error}"))
            return False
        self.log.append((step, "milliseconds", round(1000 * (time.perf_counter() - start)), None))
        return True

    def together(self, *jobs: Callable) -> list:
        """Run independent writes side by side, so that small ones do not wait for each other.

        All of them get their turn; the first failure is then raised.
        """
        with ThreadPoolExecutor(max_workers=8) as pool:
            done = [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs]
        return [one.result() for one in done]


def _staged(run: Run, landing: str, n: int, name: str, schema) -> tuple[DataFrame, DataFrame]:
    """Parse a landed table once, into Parquet; give its sound records and its rejects from there."""
    parsed = files.read_json_lines(run.spark, _landed(landing, name), schema)
    if name in BY_ID:
        buckets.write(parsed, run.place(zones.BRONZE, name), "id", n, CODEC)
    else:
        run.save(parsed, zones.BRONZE, name)
    return files.split_corrupt(run.written(zones.BRONZE, name, parsed.schema), name)


def _sound_by_id(run: Run, name: str, n: int) -> DataFrame:
    """The sound records of a staged table, laid out by id."""
    schema = schemas.with_corrupt(LANDED[name])
    return files.split_corrupt(buckets.read(run.spark, run.place(zones.BRONZE, name), schema, "id", n), name)[0]


LANDED = {
    "listing": schemas.LISTING,
    "details": schemas.DETAILS,
    "raw_airports": schemas.RAW_AIRPORTS,
    "raw_airlines": schemas.RAW_AIRLINES,
    "countries": schemas.COUNTRIES,
}
#: Staged tables that are laid out by id, as they meet by it, with the bytes of landed text for a bucket: a task holds the
#: entries of a bucket in memory, and reads its details.
BY_ID = {"listing": 160_000_000, "details": 1_280_000_000}


def _landed(landing: str, name: str) -> str:
    return f"{landing.rstrip('/')}/{name}"


def extract(run: Run, landing: str) -> None:
    """Landed JSON Lines to bronze. Flights are shaped once and written split by outcome."""
    needed = ("listing", "details")
    absent = [name for name in LANDED if files.is_missing(run.spark, _landed(landing, name))]
    run.enter_missing("extract", absent, needed)
    n = buckets.number(run.spark, {_landed(landing, name): most for name, most in BY_ID.items()})
    staged = run.together(*[partial(_staged, run, landing, n, *table) for table in LANDED.items()])
    sound, broken = zip(*staged, strict=True)
    rows = dict(zip(LANDED, run.together(*[df.count for df in sound]), strict=True))
    run.enter_missing("extract", [name for name, n in rows.items() if not n], needed)
    listing, details, raw_airports, raw_airlines, countries = sound
    countries = one_per_key(countries, "country")

    by_id = [_sound_by_id(run, name, n) for name in BY_ID]
    good, refused = _write_bronze(
        run,
        bronze.shape_flights(listing, details, None, bronze.LaidOut(*by_id, n)),
        bronze.with_continent(raw_airports, countries),
        bronze.airline_records(raw_airlines),
        [*broken, bronze.airport_rejects(raw_airports, countries)],
    )
    run.balance("extract", "listing rows", rows["listing"], good + refused + quality.listing_copies(by_id[0]))
    run.commit(zones.BRONZE, [*LANDED, *BRONZE], rows, dict.fromkeys(BY_ID, n))


def adopt(run: Run, flights: str, airports: str, airlines: str) -> None:
    """Existing files to bronze: arrays of shaped flight records, and wrapped airports and airlines."""
    inputs = {"flights": flights, "airports": airports, "airlines": airlines}
    absent = [name for name, path in inputs.items() if files.is_missing(run.spark, path)]
    run.enter_missing("extract", absent, ("flights",))
    spark = run.spark
    records, bad_flights = files.split_corrupt(
        files.read_json_array(spark, flights, schemas.BRONZE_FLIGHT), "flights"
    )
    wrapped_airports, bad_airports = files.split_corrupt(
        files.read_json_whole(spark, airports, schemas.BRONZE_AIRPORTS), "airports"
    )
    wrapped_airlines, bad_airlines = files.split_corrupt(
        files.read_json_whole(spark, airlines, schemas.BRONZE_AIRLINES), "airlines"
    )
    good, refused = _write_bronze(
        run,
        bronze.verdict(records),
        files.unwrap(wrapped_airports, "airports"),
        files.unwrap(wrapped_airlines, "airlines"),
        [bad_flights, bad_airports, bad_airlines],
    )
    run.commit(zones.BRONZE, BRONZE, {"flights": good + refused})


#: The tables of bronze besides the parsed snapshots.
BRONZE = ("flights", "airports", "airlines", "rejects")
SILVER = {
    "flights": schemas.SILVER_FLIGHTS, "airports": schemas.SILVER_AIRPORTS, "airlines": schemas.SILVER_AIRLINES
}


def _write_bronze(
    run: Run, flights: DataFrame, airports: DataFrame, airlines: DataFrame, rejects: list[DataFrame]
) -> tuple[int, int]:
    """Write the tables; give the number of good and of refused flights. Without good flights the step fails."""
    path = run.place(zones.BRONZE, "flights")
    for dimension, key, name in ((airports, "iata", "airports"), (airlines, "icao", "airlines")):
        rejects = [*rejects, silver.conflicts(dimension, key, name)]
    run.together(
        partial(flights.write.mode("overwrite").partitionBy("outcome").parquet, path, compression=CODEC),
        partial(run.save, airports, zones.BRONZE, "airports"),
        partial(run.save, airlines, zones.BRONZE, "airlines"),
        partial(run.save, reduce(DataFrame.unionByName, rejects), zones.BRONZE, "rejects"),
    )
    counts = run.written(zones.BRONZE, "flights", schemas.JUDGED_FLIGHT).groupBy("outcome").count().collect()
    number = {row["outcome"]: row["count"] for row in counts}
    run.enter_missing("extract", [] if number.get("good") else ["good_flights"], ("good_flights",))
    empty = [
        name
        for name in ("airports", "airlines")
        if run.written(zones.BRONZE, name, SILVER[name]).isEmpty() and f"raw_{name}" not in run.missing
    ]
    run.enter_missing("extract", empty, ())
    return number.get("good", 0), number.get("reject", 0)


def _bronze_flights(run: Run, outcome: str) -> DataFrame:
    """The records of one outcome; only that outcome's files are opened."""
    read = run.read(zones.BRONZE, "flights", schemas.JUDGED_FLIGHT)
    return read.filter(F.col("outcome") == outcome).drop("outcome")


def transform(run: Run) -> None:
    """Bronze to silver."""
    there = run.committed(zones.BRONZE)
    run.enter_missing("transform", [f"bronze_{n}" for n in SILVER if n not in there], ("bronze_flights",))
    good = _bronze_flights(run, "good").drop("reason")
    flights, repeated = silver.flights_once(good)
    tables = {
        "flights": flights,
        "airports": silver.airports(run.read(zones.BRONZE, "airports", schemas.SILVER_AIRPORTS)),
        "airlines": silver.airlines(run.read(zones.BRONZE, "airlines", schemas.SILVER_AIRLINES)),
    }
    run.together(*[partial(run.save, df, zones.SILVER, name) for name, df in tables.items()])
    came, kept = good.count(), run.written(zones.SILVER, "flights", schemas.SILVER_FLIGHTS).count()
    run.enter_missing("transform", [] if kept else ["good_flights"], ("good_flights",))
    run.balance("transform", "good flights", came, kept + repeated)
    run.commit(zones.SILVER, tables, {"bronze_flights": came})


def indicator_plans(
    flights: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    routes: DataFrame | None = None,
    models: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All indicators by name. With tallies, the flights are read only for the longest one."""
    by_route = flights if routes is None else routes
    by_model = flights if models is None else models
    return {
        "top_airline": indicators.top_airline(by_route),
        "regional_all": indicators.regional_leaders(by_route, airlines, airports, active_only=False),
        "regional_active": indicators.regional_leaders(by_route, airlines, airports, active_only=True),
        "longest_flight": indicators.longest_flights(flights, routes),
        "avg_duration": indicators.mean_duration(by_route, airports),
        "top_maker": indicators.top_maker(by_model),
        "top_models": indicators.top_models(by_model, airlines),
        "airport_imbalance": indicators.airport_imbalance(by_route),
    }


def publish(
    run: Run, flights: DataFrame, airlines: DataFrame, airports: DataFrame, rows: dict[str, int] | None = None
) -> None:
    """Write two tallies of the batch, then each indicator from them, each to a path of its own; commit them together.

    The flights are read three times in all: for each tally, and for the longest flight. An indicator that fails
    keeps its earlier state.
    """
    tallies = {
        "route_tally": indicators.route_tally(flights), "model_tally": indicators.model_tally(flights)
    }
    run.together(*[partial(run.save, df, zones.GOLD, name) for name, df in tallies.items()])
    routes, models = (run.written(zones.GOLD, name, df.schema) for name, df in tallies.items())
    plans = indicator_plans(flights, airlines, airports, routes, models)
    sound = run.together(
        *[partial(run.attempt, name, partial(run.save, df, zones.GOLD, name)) for name, df in plans.items()]
    )
    run.commit(zones.GOLD, [*tallies, *[name for name, done in zip(plans, sound, strict=True) if done]], rows)


def analyse(run: Run) -> None:
    """Silver to gold."""
    there = run.committed(zones.SILVER)
    run.enter_missing("analyse", [f"silver_{n}" for n in SILVER if n not in there], ("silver_flights",))
    flights = run.read(zones.SILVER, "flights", schemas.SILVER_FLIGHTS)
    number = flights.count()
    run.enter_missing("analyse", [] if number else ["silver_flights"], ("silver_flights",))
    publish(
        run,
        flights,
        run.read(zones.SILVER, "airlines", schemas.SILVER_AIRLINES),
        run.read(zones.SILVER, "airports", schemas.SILVER_AIRPORTS),
        {"silver_flights": number},
    )


def measure(run: Run) -> None:
    """Count what came in, what went out and what became of the rest, and write the run log."""
    flights = run.read(zones.SILVER, "flights", schemas.SILVER_FLIGHTS)
    airlines = run.read(zones.SILVER, "airlines", schemas.SILVER_AIRLINES)
    airports = run.read(zones.SILVER, "airports", schemas.SILVER_AIRPORTS)
    there = run.committed(zones.BRONZE)
    facts = []
    if "flights" in there:
        facts += [
            quality.dedup_counts(
                _bronze_flights(run, "good"), flights, "transform", "bronze_flights", "duplicate_flights"
            ),
            quality.reject_counts(_bronze_flights(run, "reject").withColumn("source", F.lit("flights")), "extract"),
        ]
    facts += [
        quality.reject_counts(run.read(zones.BRONZE, "rejects", schemas.REJECTS), "extract"),
        quality.row_count(airlines, "transform", "airlines"),
        quality.row_count(airports, "transform", "airports"),
        quality.flight_counts(flights, airlines, airports, "transform"),
    ]
    for table, schema, key in (
        ("airports", schemas.SILVER_AIRPORTS, "iata"), ("airlines", schemas.SILVER_AIRLINES, "icao"),
    ):
        before = run.read(zones.BRONZE, table, schema)
        facts.append(quality.dimension_counts(before, schema.fieldNames(), key, table))
    # What landed, where this run or an earlier one of the hour began with landed files.
    staged = {
        name: run.read_by_id(zones.BRONZE, name, schemas.with_corrupt(schema))
        for name, schema in LANDED.items()
        if name in there
    }
    facts += [quality.landed_rows(df, name) for name, df in staged.items()]
    if {"listing", "details"} <= set(staged):
        listing, details = (files.split_corrupt(staged[name], name)[0] for name in ("listing", "details"))
        facts.append(quality.listing_counts(listing, details))
    log = run.spark.createDataFrame(run.log, schemas.RUN_METRICS)
    run.save(reduce(DataFrame.unionByName, [*facts, log]), zones.GOLD, "run_metrics")
    run.commit(zones.GOLD, ["run_metrics"])


STEPS = ("extract", "transform", "analyse", "measure")
#: Each job's shuffle files go when it has ended, instead of when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: A task reads few landed files, so that the rows it parts by bucket fit into its memory.
SETTINGS = FREE_SHUFFLES | {"spark.sql.files.maxPartitionBytes": "64m"}


def run(
    spark: SparkSession,
    landing: str | None,
    root: str,
    run_ts: datetime,
    steps: Sequence[str] = STEPS,
    existing: tuple[str, str, str] | None = None,
) -> Run:
    """The whole batch, or some of its steps.

    ``existing`` names files of flights, airports and airlines that are shaped already, and stands in for
    the landed snapshot. A failed step ends the run, but the run log is still written. The caller
    decides what ``failed`` means for the exit status.
    """
    batch = Run(spark, root, run_ts)
    work = {
        "extract": lambda: adopt(batch, *existing) if existing else extract(batch, str(landing)),
        "transform": lambda: transform(batch),
        "analyse": lambda: analyse(batch),
        "measure": lambda: measure(batch),
    }
    sound = True
    for step, do in work.items():
        if step in steps and (sound or step == "measure"):
            with settings(spark, SETTINGS):
                sound = batch.attempt(step, do) and sound
    return batch


def open_hours(spark: SparkSession, landing: str, root: str) -> list[tuple[datetime, Sequence[str]]]:
    """Landed hours that gold lacks, in order, and the steps that each still needs.

    ``landing`` holds a folder for each hour, laid out like a table. An hour is done when gold has all its indicators
    and its run log; one whose bronze or silver is committed goes on from there.
    """
    zone = lambda name: f"{root.rstrip('/')}/{name}"
    work = []
    for moment in zones.dated_hours(spark, landing):
        there = {name: set(zones.committed(spark, zone(name), moment)["tables"]) for name in (zones.BRONZE, zones.SILVER, zones.GOLD)}
        if {*schemas.GOLD, "run_metrics"} <= there[zones.GOLD]:
            continue
        done = set(SILVER) <= there[zones.SILVER], set(BRONZE) <= there[zones.BRONZE]
        work.append((moment, STEPS[2:] if all(done) else STEPS[1:] if done[1] else STEPS))
    return work


def catch_up(spark: SparkSession, landing: str, root: str) -> list[Run]:
    """Bring every open hour to gold, the oldest first; an hour that fails does not stop the others."""
    return [
        run(spark, zones.batch_path(landing.rstrip("/"), moment), root, moment, steps)
        for moment, steps in open_hours(spark, landing, root)
    ]
