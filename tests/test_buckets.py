"""Staged tables laid out by id: what meets by id takes no shuffle, and gives the same rows."""

import json

import pytest
from pyspark.sql import functions as F

from skytally import catalog, schemas
from skytally.plans import batch, bronze, quality
from skytally.session import settings
from skytally.sources import buckets, files, star_tables as star, zones

from tests.test_batch import DETAILS, SIX, flight, snapshot

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def parts(path):
    return sorted(p.name for p in path.glob("part-*"))


@pytest.mark.parametrize("most", [64_000, 1])
def test_rows_come_back_in_buckets(spark, rows, tmp_path, monkeypatch, most):
    """Parted by the writing tasks, or by a shuffle where that would make too many files."""
    monkeypatch.setattr(buckets, "MOST_FILES", most)
    df = spark.range(0, 300, 1, 6).selectExpr("if(id % 5 = 0, null, cast(id as string)) AS id", "id AS n", "struct(id AS `a b`) AS s")
    path = tmp_path / "it's"
    buckets.write(df, str(path), "id", 7)
    found = buckets.read(spark, str(path), df.schema, "id", 7)
    assert rows(found) == rows(df)
    counts = found.groupBy("id").count()
    assert "Exchange" not in plan(counts)
    assert rows(counts) == rows(df.groupBy("id").count())
    assert all(name.endswith(".zstd.parquet") for name in parts(path))
    assert len(parts(path)) <= 42 if most > 1 else len(parts(path)) <= 14
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("skytally")]


def test_number_of_buckets(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_bytes(b"x" * 1000)
    (tmp_path / "a" / "y.json.gz").write_bytes(b"x" * 100)
    n = lambda bound: buckets.number(spark, {f"{tmp_path}/a": bound, f"{tmp_path}/none": 1})
    assert n(20) == 101 and n(10**9) == spark.sparkContext.defaultParallelism


LISTED = [("a", "1", "2"), ("b", "9", "3"), ("b", "4", "5"), ("c", "6", None), ("c", "6", None), ("e", "7", "8"), ("f", None, "1"), (None, "1", "1"), (None, "1", "1")]
FOUND = [("a", "x", 1), ("a", "y", 2), ("a", "y", 2), ("b", "z", None), ("d", "t", 5), ("f", "u", 1), (None, "w", 9)]


@pytest.fixture
def sides(spark):
    listing = spark.createDataFrame(LISTED, schemas.LISTING)
    names = spark.createDataFrame(FOUND, "id string, name string, updated long")
    texts = F.to_json(F.struct("id", F.struct("name").alias("airline"), F.struct(F.struct("updated").alias("other")).alias("time")))
    return listing, names.select(F.from_json(texts, schemas.DETAILS).alias("d")).select("d.*")


def laid_out(spark, tmp_path, n, *tables):
    for name, df in zip(("listing", "details"), tables, strict=True):
        buckets.write(df, f"{tmp_path}/{name}", "id", n)
    read = [buckets.read(spark, f"{tmp_path}/{name}", df.schema, "id", n) for name, df in zip(("listing", "details"), tables, strict=True)]
    return bronze.LaidOut(*read, n)


@pytest.mark.parametrize("n", [1, 5, 40])
@pytest.mark.parametrize("hot", [1, 2, 100_000])
def test_flights_shaped_in_place_are_the_same(spark, sides, rows, tmp_path, monkeypatch, hot, n):
    """Whether ids that come again are all hot, some or none of them."""
    expected = rows(bronze.shape_flights(*sides))
    by_id = laid_out(spark, tmp_path, n, *sides)
    monkeypatch.setattr(bronze, "HOT", hot)
    shaped = bronze.shape_flights(*sides, by_id=by_id)
    assert rows(shaped) == expected and len(expected) == 7
    assert rows(by_id.repeated()) == [("a", hot < 3), ("b", hot < 2), ("c", hot < 2)]
    copies = [quality.listing_copies(df) for df in (sides[0], by_id.listing)]
    assert copies == [2, 2]


def test_ids_that_come_once_are_not_shuffled(spark, sides, rows, tmp_path):
    """Neither the wide details nor the entries; details are not sorted either."""
    listing, details = (df.filter("id in ('e', 'f')") for df in sides)
    by_id = laid_out(spark, tmp_path, 5, listing, details)
    assert by_id.repeated() is None
    text = plan(bronze._met_in_place(listing, details, by_id))
    assert "ShuffledHashJoin" in text and "Exchange" not in text and "Sort " not in text
    counts = plan(quality.listing_counts(by_id.listing, by_id.details))
    assert "hashpartitioning(id" not in counts


def test_ids_that_come_again_are_grouped_in_place(spark, sides, rows, tmp_path):
    """Also where they are too many for a broadcast."""
    by_id = laid_out(spark, tmp_path, 5, *sides)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shaped = bronze._met_in_place(*sides, by_id)
        text = plan(shaped)
        assert shaped.count() == 5
    assert "Exchange" not in text and text.count("LeftAnti") == text.count("LeftSemi") == 2


def test_run_metrics_are_counted_in_place(spark, tmp_path, monkeypatch):
    """Copies, versions and details that are not listed are counted without a shuffle by id."""
    plans = []
    counts = quality.listing_counts
    monkeypatch.setattr(quality, "listing_counts", lambda *sides: plans.append(plan(counts(*sides))) or counts(*sides))
    landing, root = snapshot(tmp_path / "in", DETAILS), str(tmp_path / "out")
    run = batch.run(spark, landing, root, SIX)
    assert not run.failed and len(plans) == 1 and "hashpartitioning(id" not in plans[0]
    log = run.read(zones.GOLD, "run_metrics", schemas.RUN_METRICS).filter("step = 'extract' AND detail IS NULL").collect()
    found = {r["metric"]: r["value"] for r in log if r["metric"] != "milliseconds"}
    assert found == {"listing_copies": 1, "details_versions": 1, "unlisted_details": 0, "details_without_id": 0}


def test_a_run_lays_out_what_it_stages(spark, tmp_path, rows):
    """Extract writes listing and details by id, compressed; later steps know it from the commit record."""
    landing, root = snapshot(tmp_path / "in", DETAILS), str(tmp_path / "out")
    run = batch.run(spark, landing, root, SIX)
    assert not run.failed
    n = spark.sparkContext.defaultParallelism
    assert zones.committed(spark, f"{root}/{zones.BRONZE}", SIX)["buckets"] == {"listing": n, "details": n}
    for name in ("listing", "details"):
        schema = schemas.with_corrupt(batch.LANDED[name])
        read = run.read_by_id(zones.BRONZE, name, schema)
        assert "Exchange" not in plan(read.filter("id is not null").groupBy("id").count())
        assert rows(read) == rows(run.read(zones.BRONZE, name, schema))
    written = [p.name for p in (tmp_path / "out").rglob("part-*")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)
    # A run that takes over shaped files lays nothing out, and what is written anew plainly has no buckets.
    zones.commit(spark, f"{root}/{zones.BRONZE}", SIX, {"listing": run.id})
    assert zones.committed(spark, f"{root}/{zones.BRONZE}", SIX)["buckets"] == {"details": n}


def test_shuffle_files_go_with_their_job(spark, tmp_path, monkeypatch):
    """While a step runs, and only then."""
    seen = []
    extract = batch.extract
    monkeypatch.setattr(batch, "extract", lambda *a: seen.append(spark.conf.get(FREE)) or extract(*a))
    before = spark.conf.get(FREE, None), spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    assert not batch.run(spark, snapshot(tmp_path / "in", [flight("1")]), str(tmp_path / "out"), SIX).failed
    assert seen == ["true"]
    assert (spark.conf.get(FREE, None), spark.conf.get("spark.sql.files.maxPartitionBytes", None)) == before


def test_settings_are_put_back_after_a_failure(spark):
    with pytest.raises(ValueError), settings(spark, {"skytally.some": "1", "spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("skytally.some") == "1"
        raise ValueError
    assert spark.conf.get("skytally.some", None) is None and spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_columns_land_like_tables(spark, tmp_path):
    """The same lines as one table after the other; nulls are written."""
    texts = ['{"a": {"x": 1, "y": null}, "b": {"z": "Orly – é"}}', '{"a": {"x": null, "y": "q"}, "b": {"z": null}}', '{"a": {"x": 3, "y": "r"}, "b": {"z": "2"}}']
    both = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.from_json("t", "a struct<x: int, y: string>, b struct<z: string>").alias("r")
    ).select("r.*")
    files.write_json_columns(both, f"{tmp_path}/one")
    for name in both.columns:
        files.write_json(both.select(f"{name}.*"), f"{tmp_path}/two/{name}", compressed=True)
        one, two = (sorted(r[0] for r in spark.read.text(f"{tmp_path}/{k}/{name}").collect()) for k in ("one", "two"))
        assert one == two and len(one) == 3
        assert all(p.endswith(".gz") for p in parts(tmp_path / "one" / name))
    # No rows give empty tables, as before.
    files.write_json_columns(both.filter("false"), f"{tmp_path}/none")
    assert spark.read.text(f"{tmp_path}/none/a").count() == 0


def test_landed_sides_come_from_one_join(spark, sf_dir, rows):
    both = star.landed(spark, sf_dir)
    assert plan(both).count("l_shipdate") and both.count() == star.listing(spark, sf_dir).count()
    for name, side in (("listing", star.listing), ("details", star.details)):
        assert rows(both.select(F.to_json(f"{name}"))) == rows(side(spark, sf_dir).select(F.to_json(F.struct("*"))))


@pytest.mark.parametrize("name, key", [("part", "p_partkey"), ("customer", "c_custkey")])
def test_keys_that_come_twice_are_joined_apart(spark, sf_dir, tmp_path, monkeypatch, name, key):
    """A customer that comes twice repeats listed entries, a part repeats details; neither repeats the other side."""
    table = star.table
    first = table(spark, sf_dir, name).agg(F.min(key)).first()[0]

    def twice(spark, sf_dir, of):
        df = table(spark, sf_dir, of)
        return df.unionAll(df.filter(F.col(key) == first)) if of == name else df

    monkeypatch.setattr(star, "table", twice)
    assert star.landed(spark, sf_dir) is None
    catalog._land(spark, sf_dir, f"{tmp_path}/landing")
    for side, of in (("listing", star.listing), ("details", star.details)):
        landed = sorted(r[0] for r in spark.read.text(f"{tmp_path}/landing/{side}").collect())
        assert len(landed) == of(spark, sf_dir).count()
        assert all(json.loads(line).keys() for line in landed[:3])
