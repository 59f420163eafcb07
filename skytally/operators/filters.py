"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.scalars import present


def with_required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named text columns are all filled."""
    return df.filter(reduce(and_, [present(c) for c in columns]))


def active(flights: DataFrame) -> DataFrame:
    """Flights in the air; an unknown state does not count."""
    return flights.filter(F.col("flying") == 1)


def regional(routes: DataFrame) -> DataFrame:
    """Flights that stay on one continent."""
    return routes.filter(F.col("origin_continent") == F.col("destination_continent"))
