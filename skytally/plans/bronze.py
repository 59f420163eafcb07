"""Landed snapshots to bronze: shaped flight records, airports with continents, rejects."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.scalars import in_calendar
from skytally.operators.aggregates import newest_by, one_per_key
from skytally.operators.joins import unmatched
from skytally.schemas import BRONZE_FLIGHT, CORRUPT
from skytally.sources import buckets
from skytally.sources.workspace import new_folder, written


def with_id(listing: DataFrame) -> DataFrame:
    """Listed flights that can be looked up."""
    return listing.filter(F.col("id").isNotNull())


def with_details(listing: DataFrame, details: DataFrame, how: str = "inner") -> DataFrame:
    """Listed flights with their details, matched on the flight id."""
    ends = listing.select(
        "id",
        F.col("origin_airport_iata").alias("origin_airport"),
        F.col("destination_airport_iata").alias("destination_airport"),
    )
    return ends.join(details, "id", how)


def without_images(flights: DataFrame) -> DataFrame:
    """Drop the picture links from ``aircraft``; nothing happens where there are none."""
    return flights.withColumn("aircraft", F.col("aircraft").dropFields("images"))


def has_airline_code() -> Column:
    return F.col("airline.code").isNotNull()


def has_real_times() -> Column:
    """The object is there, even if it is empty: an absent arrival means the same as a null one."""
    return F.col("time.real").isNotNull()


def with_flying(flights: DataFrame) -> DataFrame:
    """A flight counts as flying until it has actually arrived, also before it departs."""
    return flights.withColumn("flying", F.col("time.real.arrival").isNull())


def with_icao(flights: DataFrame) -> DataFrame:
    """The airline's ICAO code as a column of its own."""
    return flights.withColumn("icao", F.col("airline.code.icao"))


# The record's points in time, in epoch seconds.
TIMES = [f"time.{kind}.{end}" for kind in ("estimated", "real", "scheduled") for end in ("arrival", "departure")]


def has_sound_times() -> Column:
    """No time of the record lies outside the years 1 to 9999."""
    return reduce(and_, [F.coalesce(in_calendar(time), F.lit(True)) for time in TIMES])


def _reason() -> Column:
    return (
        F.when(~has_airline_code(), "no_airline_code")
        .when(~has_real_times(), "no_real_times")
        .when(~has_sound_times(), "bad_epoch")
    )


def verdict(flights: DataFrame, reason: Column | None = None) -> DataFrame:
    """Mark flight records: ``outcome`` good or reject, with the reason of a reject.

    A ``reason`` that is known already comes before those found in the record.
    """
    found = _reason() if reason is None else F.coalesce(reason, _reason())
    if CORRUPT in flights.columns:
        found = F.when(F.col(CORRUPT).isNotNull(), "corrupt").otherwise(found)
    outcome = F.when(F.col("reason").isNull(), "good").otherwise("reject")
    return flights.withColumn("reason", found).withColumn("outcome", outcome)


def one_route_each(listing: DataFrame) -> DataFrame:
    """One listing entry per id. Of several routes of an id the first by code counts.

    Entries of an id combine inside the map tasks, so an id listed many times reaches the shuffle as a few rows.
    """
    return one_per_key(listing.select("id", "origin_airport_iata", "destination_airport_iata"), "id")


#: So many ids with several versions are set apart by a join; where there are more, all records are grouped.
MOST_REPEATED = 1_000_000


def newest_details(details: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One record per flight id, the newest version.

    Hashes of ids are counted first, eight bytes each that combine inside the map tasks. Only records whose hash comes
    again are grouped whole by id, again combining inside the map tasks, and the newest of them are written; the others
    stay where they are, so that filters and unused fields go on to their source. Two ids of one hash are grouped too,
    each on its own. ``ids`` holds the ids of all records, where they can be had for less than by reading ``details``.
    """
    known = details.filter(F.col("id").isNotNull())
    counted = known if ids is None else ids.filter(F.col("id").isNotNull())
    counts = counted.groupBy(F.xxhash64("id").alias("key")).agg(F.count(F.lit(1)).alias("versions"))
    repeated = written(counts.filter(F.col("versions") > 1).select("key"), "repeated-ids")
    ids = repeated.count()
    if not ids:
        return known
    if ids > MOST_REPEATED:
        return _newest(known)
    hashed = F.xxhash64("id") == F.col("key")
    newest = written(_newest(known.join(repeated, hashed, "left_semi")), "newest-details")
    return known.join(repeated, hashed, "left_anti").unionByName(newest)


def _newest(details: DataFrame) -> DataFrame:
    versions = details.withColumn("updated", F.col("time.other.updated"))
    return newest_by(versions, "id", "updated").select(*details.columns)


#: Ids with more entries or versions than this are brought together from all tasks instead of in their bucket.
HOT = 100_000


@dataclass
class LaidOut:
    """Listing and details that are laid out by id, in so many buckets."""

    listing: DataFrame
    details: DataFrame
    buckets: int

    def repeated(self) -> DataFrame | None:
        """Ids that come again on either side, and whether they are hot, laid out like these; None if there are none.

        Takes no shuffle: ids are counted in their buckets.
        """
        sides = self.listing, self.details
        counts = [
            with_id(side).groupBy("id").agg(F.count(F.lit(1)).alias(name))
            for side, name in zip(sides, ("entries", "versions"), strict=True)
        ]
        most = F.greatest("entries", "versions")  # passes over nulls
        again = counts[0].join(counts[1], "id", "full").filter(most > 1).select("id", (most > HOT).alias("hot"))
        path = f"{new_folder(again.sparkSession, 'repeated-ids')}/data"
        buckets.write(again, path, "id", self.buckets)
        found = buckets.read(again.sparkSession, path, again.schema, "id", self.buckets)
        return None if found.isEmpty() else found


def _met_in_place(listing: DataFrame, details: DataFrame, by_id: LaidOut) -> DataFrame:
    """Listed flights, one row per id, with their newest details: ids that come once on both sides meet where they are.

    Records of the others are grouped whole by id, in their bucket too; those of a hot id combine inside the tasks that
    read the plain tables. Narrow entries are what is hashed, so that details are not sorted.
    """

    def routes(entries: DataFrame) -> DataFrame:
        return entries.select("id", "origin_airport_iata", "destination_airport_iata")

    def again(ids: DataFrame, *sides: DataFrame) -> DataFrame:
        entries, known = (with_id(side).join(ids, "id", "left_semi") for side in sides)
        return _met(one_route_each(entries), _newest(known))

    entries, known = with_id(by_id.listing), with_id(by_id.details)
    repeated = by_id.repeated()
    if repeated is None:
        return _met(routes(entries).hint("shuffle_hash"), known)
    entries, known = (side.join(repeated, "id", "left_anti") for side in (entries, known))
    met = _met(routes(entries).hint("shuffle_hash"), known)
    met = met.unionByName(again(repeated.filter(~F.col("hot")), by_id.listing, by_id.details))
    # Written apart, as the few ids they are.
    hot = written(repeated.filter("hot").select("id"), "hot-ids")
    return met if hot.isEmpty() else met.unionByName(again(hot, listing, details))


def _met(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed flights with their details, or without; one row per id on both sides."""
    return with_details(listed, known.withColumn("has_details", F.lit(True)), "left")


def shape_flights(
    listing: DataFrame, details: DataFrame, ids: DataFrame | None = None, by_id: LaidOut | None = None
) -> DataFrame:
    """Bronze flight records, each marked with its outcome and, where refused, the reason.

    Every listing entry leaves a row, but for further entries of the same id: entries without id (``no_id``)
    and without details (``no_details``) are rejects that hold the two airports. Both sides are one row per id when
    they meet, so no flight id is hot in the join. ``ids`` are those of ``newest_details``; ``by_id`` holds the same
    tables laid out by id, where they are.
    """
    if by_id is None:
        met = _met(one_route_each(with_id(listing)), newest_details(details, ids))
    else:
        met = _met_in_place(listing, details, by_id)
    nameless = listing.filter(F.col("id").isNull()).select(
        F.col("origin_airport_iata").alias("origin_airport"),
        F.col("destination_airport_iata").alias("destination_airport"),
        F.lit("no_id").alias("known_reason"),
    )
    every = met.withColumn("known_reason", F.when(F.col("has_details").isNull(), "no_details")).unionByName(
        nameless, allowMissingColumns=True
    )
    marked = verdict(every, F.col("known_reason"))
    return with_flying(with_icao(marked)).select(*[f.name for f in BRONZE_FLIGHT.fields], "reason", "outcome")


def with_continent(raw_airports: DataFrame, countries: DataFrame) -> DataFrame:
    """Airports with the continent of their country; others drop out."""
    return raw_airports.join(countries, "country").select("name", "iata", "continent")


def without_continent(raw_airports: DataFrame, countries: DataFrame) -> DataFrame:
    """Airports whose country is not known."""
    return unmatched(raw_airports, "country", countries, "country").select("name", "iata", "country")


def airport_rejects(raw_airports: DataFrame, countries: DataFrame) -> DataFrame:
    return without_continent(raw_airports, countries).select(
        F.lit("airports").alias("source"),
        F.lit("no_continent").alias("reason"),
        F.to_json(F.struct("name", "iata", "country")).alias("record"),
    )


def airline_records(raw_airlines: DataFrame) -> DataFrame:
    return raw_airlines.select("name", "icao", "country")
