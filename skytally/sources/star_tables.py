"""The pipeline's inputs, derived from a star schema of orders, suppliers, customers and parts.

A line item plays a flight, its supplier the airline, the supplier's nation the origin airport and the
customer's nation the destination. Dimension keys are unique, so an outer join neither adds nor drops
a flight, and only the tables behind the requested columns are joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.scalars import epoch


_known_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its wall-clock times become points in time (the session runs in UTC).

    The schema is taken from the file once per application; asking again would cost a job each time.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _known_schemas:
        _known_schemas[key] = spark.read.parquet(path).schema
    schema = _known_schemas[key]
    df = spark.read.schema(schema).parquet(path)
    clocks = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in clocks}) if clocks else df


# Table -> (table it hangs on, key there, own key).
_JOINS = {
    "orders": ("lineitem", "l_orderkey", "o_orderkey"),
    "customer": ("orders", "o_custkey", "c_custkey"),
    "supplier": ("lineitem", "l_suppkey", "s_suppkey"),
    "part": ("lineitem", "l_partkey", "p_partkey"),
}


def _flying() -> Column:
    return F.when(F.col("l_linestatus") == "O", 1).otherwise(0)


# Flight column -> (table it comes from, expression).
_FLIGHT: dict[str, tuple[str | None, Callable[[], Column]]] = {
    "registration": (None, lambda: F.col("l_partkey")),
    "airline_icao": (None, lambda: F.col("l_suppkey")),
    "airline_name": ("supplier", lambda: F.col("s_name")),
    "origin_airport": ("supplier", lambda: F.col("s_nationkey")),
    "destination_airport": ("customer", lambda: F.col("c_nationkey")),
    "aircraft_model_text": ("part", lambda: F.col("p_name")),
    "real_departure": ("orders", lambda: F.col("o_orderdate")),
    "scheduled_departure": ("orders", lambda: F.col("o_orderdate")),
    "scheduled_arrival": (None, lambda: F.col("l_shipdate")),
    "flying": (None, _flying),
}


def _joined(spark: SparkSession, sf_dir: str, needed: set[str], root: str = "lineitem") -> DataFrame:
    """A table with the needed ones that hang on it.

    Customers join the orders, a quarter of the rows, before these join the line items.
    """
    if "customer" in needed:
        needed = needed | {"orders"}
    df = table(spark, sf_dir, root)
    for name, (parent, foreign, key) in _JOINS.items():
        if parent == root and name in needed:
            side = _joined(spark, sf_dir, needed, name)
            df = df.join(side, F.col(foreign) == F.col(key), "left")
    return df


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Flights with the requested columns, by default all."""
    wanted = columns or tuple(_FLIGHT)
    needed = {_FLIGHT[c][0] for c in wanted} - {None}
    return _joined(spark, sf_dir, needed).select(*[_FLIGHT[c][1]().alias(c) for c in wanted])


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("iata"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("continent"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("icao"), F.col("n_name").alias("country")
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports before their continent is known: customers with their country."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("iata"), F.col("n_name").alias("country")
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries with their continent."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("continent")
    )


def _flight_id() -> Column:
    # A line number repeats within an order, so the other keys and the quantity join in.
    quantity = F.col("l_quantity").cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed flight listing; returned items (``l_returnflag`` R) play the entries without an id."""
    lines = _joined(spark, sf_dir, {"supplier", "customer"})
    return as_listing(lines.withColumn("returned", F.col("l_returnflag") == "R"))


def as_listing(lines: DataFrame) -> DataFrame:
    """Landed flight listing of line items that are joined already."""
    return lines.select(
        F.when(~F.col("returned"), _flight_id()).alias("id"),
        F.col("s_nationkey").cast("string").alias("origin_airport_iata"),
        F.col("c_nationkey").cast("string").alias("destination_airport_iata"),
    )


#: What listing and details need of the line items and of the tables around them; conditions become flags before anything is joined.
_LINE: dict[str, Callable[[], list[Column]]] = {
    "lineitem": lambda: [
        *map(F.col, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")),
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
        (F.col("l_tax") != 0).alias("taxed"),
        (F.col("l_discount") != 0).alias("discounted"),
        (F.col("l_linestatus") == "O").alias("in_air"),
        (F.col("l_returnflag") == "R").alias("returned"),
    ],
    "orders": lambda: [F.col("o_orderkey"), F.col("o_orderdate"), (F.col("o_orderstatus") != "P").alias("settled")],
    "supplier": lambda: [*map(F.col, ("s_suppkey", "s_name", "s_nationkey")), (F.col("s_acctbal") >= 0).alias("solvent")],
    "part": lambda: [*map(F.col, ("p_partkey", "p_name", "p_brand", "p_type", "p_size"))],
}


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with what listing and details need of them."""
    return table(spark, sf_dir, "lineitem").select(*_LINE["lineitem"]())


def with_sides(spark: SparkSession, sf_dir: str, items: DataFrame, routes: bool = False) -> DataFrame:
    """Line items with their order, part and supplier, still in the columns of these tables.

    Suppliers, the fewest, come last: most often they take no shuffle, and their columns none either. ``routes`` adds
    the customer's nation, which the listing needs; customers join the orders before these join the line items.
    """
    for name in ("orders", "part", "supplier"):
        _, foreign, key = _JOINS[name]
        columns = _LINE[name]()
        side = table(spark, sf_dir, name)
        if routes and name == "orders":
            side = _joined(spark, sf_dir, {"customer"}, name)
            columns.append(F.col("c_nationkey"))
        items = items.join(side.select(*columns), F.col(foreign) == F.col(key), "left")
    return items


def with_id(lines: DataFrame) -> DataFrame:
    """The flight id as a column; it is long, so lines get it after the joins."""
    return lines.withColumn("id", _flight_id())


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_details(with_id(with_sides(spark, sf_dir, line_items(spark, sf_dir))))


def as_details(lines: DataFrame, *kept: str) -> DataFrame:
    """Landed flight details with the gaps real ones have; ``kept`` names further columns of the lines.

    No airline where the supplier's balance is negative, no airline code where the tax is zero, no
    aircraft where the discount is zero, no actual times where the order is pending, no actual
    arrival while the flight is in the air.
    """
    departure, arrival = epoch("o_orderdate"), epoch("l_shipdate")
    code = F.struct(F.col("s_nationkey").cast("string").alias("iata"), F.col("l_suppkey").cast("string").alias("icao"))
    airline = F.struct(
        F.col("s_name").alias("name"),
        F.reverse("s_name").alias("short"),
        F.lower("s_name").alias("url"),
        F.when(F.col("taxed"), code).alias("code"),
    )
    aircraft = F.struct(
        F.col("p_size").cast("string").alias("age"),
        (F.col("p_size") + 1000).cast("bigint").alias("countryId"),
        F.hex("p_partkey").alias("hex"),
        F.col("p_brand").alias("msn"),
        F.col("p_partkey").cast("string").alias("registration"),
        F.struct(F.col("p_type").alias("code"), F.col("p_name").alias("text")).alias("model"),
        F.array(F.struct(F.col("p_type").alias("src"))).alias("images"),
    )
    scheduled = F.struct(departure.alias("departure"), arrival.alias("arrival"))
    real = F.struct(departure.alias("departure"), F.when(~F.col("in_air"), arrival).alias("arrival"))
    estimated = F.struct((departure + 60).alias("departure"), (arrival + 120).alias("arrival"))
    past = F.struct(
        F.col("l_linenumber").cast("string").alias("delay"),
        F.col("l_quantity").cast("string").alias("flighttime"),
    )
    time = F.struct(
        F.when(F.col("settled"), real).alias("real"),
        scheduled.alias("scheduled"),
        estimated.alias("estimated"),
        F.when(F.col("l_linenumber") > 1, past).alias("historical"),
        F.struct((arrival + 7).alias("eta"), (departure + 3).alias("updated")).alias("other"),
    )
    return lines.select(
        "id",
        F.when(F.col("solvent"), airline).alias("airline"),
        F.when(F.col("discounted"), aircraft).alias("aircraft"),
        time.alias("time"),
        *kept,
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Landed listing and details as a column each, from line items that are joined once.

    None where a part or a customer comes twice: that repeats the records of one side, not those of the other.
    """
    for name, key in (("part", "p_partkey"), ("customer", "c_custkey")):
        rows = table(spark, sf_dir, name).filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        if not rows.filter(F.col("n") > 1).isEmpty():
            return None
    lines = with_id(with_sides(spark, sf_dir, line_items(spark, sf_dir), routes=True))
    both = as_details(lines, "returned", "s_nationkey", "c_nationkey")
    entry = F.struct(
        F.when(~F.col("returned"), F.col("id")).alias("id"),
        F.col("s_nationkey").cast("string").alias("origin_airport_iata"),
        F.col("c_nationkey").cast("string").alias("destination_airport_iata"),
    )
    return both.select(entry.alias("listing"), F.struct("id", "airline", "aircraft", "time").alias("details"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
