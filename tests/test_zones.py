"""Files and dated zones."""

import json
import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skytally import schemas
from skytally.sources import files, workspace, zones

SIX, EIGHT = datetime(2024, 3, 5, 6), datetime(2024, 3, 5, 8)


@pytest.fixture
def countries(spark):
    def make(*pairs):
        return spark.createDataFrame(list(pairs), schemas.COUNTRIES)

    return make


def test_path_names_year_month_day_and_hour():
    path = zones.batch_path(zones.table_path("s3a://bucket/", zones.GOLD, "top"), SIX)
    assert path == (
        "s3a://bucket/goldzone/top/tech_year=2024/tech_month=2024-03/tech_day=2024-03-05/tech_hour=06"
    )


def test_batches_of_one_day_are_apart(spark, countries, tmp_path, rows):
    table = str(tmp_path / "t")
    zones.write_batch(countries(("a", "x"), ("b", "x")), table, SIX)
    zones.write_batch(countries(("c", "x")), table, EIGHT)
    read = lambda *moment: rows(zones.read_batch(spark, table, schemas.COUNTRIES, *moment), "country", "tech_hour")
    assert read(SIX) == [("a", "06"), ("b", "06")]
    assert read(SIX, 3) == [("a", "06"), ("b", "06"), ("c", "08")]
    zones.write_batch(countries(("d", "x")), table, SIX)
    assert (read(SIX), read(EIGHT)) == ([("d", "06")], [("c", "08")])
    zones.write_batch(countries(), table, SIX)  # an empty result replaces the earlier rows too
    assert (read(SIX), read(EIGHT)) == ([], [("c", "08")])
    assert read(datetime(2024, 3, 6)) == []


def test_only_the_batch_is_listed(spark, countries, tmp_path):
    table = str(tmp_path / "t")
    for moment in (SIX, EIGHT):
        zones.write_batch(countries(("a", "x")), table, moment)
    assert all("tech_hour=06" in f for f in zones.read_batch(spark, table, schemas.COUNTRIES, SIX).inputFiles())


def test_latest_batch_ignores_unfinished_ones(spark, countries, tmp_path, rows):
    table = str(tmp_path / "t")
    assert zones.latest_batch(spark, table) is None
    assert zones.read_latest(spark, table, schemas.COUNTRIES).count() == 0
    zones.write_batch(countries(("b", "x")), table, EIGHT)
    zones.write_batch(countries(("a", "x")), table, SIX)  # written later, but older
    # Not committed: written by a run that never came to its end.
    zones.write_run(countries(("x", "x")), table, datetime(2025, 1, 1), zones.new_run())
    assert zones.latest_batch(spark, table) == EIGHT
    assert rows(zones.read_latest(spark, table, schemas.COUNTRIES), "country") == [("b",)]


def test_records_make_many_tables_valid_at_once(spark, countries, tmp_path, rows):
    zone = str(tmp_path / "zone")
    first, second = zones.new_run(), zones.new_run()
    read = lambda name: rows(zones.read_hour(spark, f"{zone}/{name}", schemas.COUNTRIES, SIX), "country")
    for run, value in ((first, "a"), (second, "b")):
        for name in ("s", "t"):
            zones.write_run(countries((value, "x")), f"{zone}/{name}", SIX, run)
        assert read("s") == read("t") == ([] if run == first else [("a",)])
        zones.commit(spark, zone, SIX, {"s": run, "t": run}, {"in": 1})
        assert read("s") == read("t") == [(value,)]
    assert zones.committed(spark, zone, SIX) == {"tables": {"s": second, "t": second}, "rows": {"in": 1}}
    zones.commit(spark, zone, SIX, {"u": first})  # the others stay valid
    assert zones.committed(spark, zone, SIX)["tables"] == {"s": second, "t": second, "u": first}


def test_a_cut_record_is_passed_over(spark, countries, tmp_path, rows):
    table = str(tmp_path / "t")
    zones.write_batch(countries(("a", "x")), table, SIX)
    (tmp_path / "_commits/2024-03-05T06/000002.json").write_text('{"tables": {"t": "r1')
    assert rows(zones.read_hour(spark, table, schemas.COUNTRIES, SIX), "country") == [("a",)]
    zones.write_batch(countries(("b", "x")), table, SIX)
    assert rows(zones.read_hour(spark, table, schemas.COUNTRIES, SIX), "country") == [("b",)]
    assert (tmp_path / "_commits/2024-03-05T06/000003.json").exists()


def test_the_state_before_the_last_stays_for_readers(spark, countries, tmp_path, rows):
    table = str(tmp_path / "t")
    zones.write_batch(countries(("a", "x")), table, SIX)
    begun = zones.read_hour(spark, table, schemas.COUNTRIES, SIX)
    zones.write_batch(countries(("b", "x")), table, SIX)
    assert rows(begun, "country") == [("a",)]
    zones.write_batch(countries(("c", "x")), table, SIX)
    runs = list((tmp_path / zones.batch_path("t", SIX)).glob("run=*"))
    assert len(runs) == 2


def test_rewriting_hours_by_time_leaves_others(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    schema = schemas.struct(n=schemas.SILVER_FLIGHTS["other_eta"].dataType, ts=schemas.SILVER_FLIGHTS["real_arrival"].dataType)
    make = lambda *pairs: spark.createDataFrame([(n, t) for n, t in pairs], schema)
    zones.write_by_time(make((1, SIX), (2, EIGHT), (3, EIGHT)), table, "ts")
    zones.write_by_time(make((4, EIGHT)), table, "ts")
    assert rows(zones.read_table(spark, table, schema), "n", "tech_hour") == [(1, "06"), (4, "08")]


def test_partition_filter_prunes_directories(spark, countries, tmp_path):
    table = str(tmp_path / "t")
    for moment in (SIX, EIGHT):
        zones.write_batch(countries(("a", "x")), table, moment)
    df = zones.read_table(spark, table, schemas.COUNTRIES).filter("tech_hour = '06'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tech_hour" in plan
    assert df.count() == 1


def test_missing_path_is_empty_but_other_errors_are_raised(spark, tmp_path):
    absent = str(tmp_path / "absent")
    assert files.read_parquet(spark, absent, schemas.COUNTRIES).schema == schemas.COUNTRIES
    assert files.read_json_lines(spark, absent, schemas.COUNTRIES).columns[-1] == schemas.CORRUPT
    assert files.read_json_array(spark, absent, schemas.COUNTRIES).count() == 0
    assert zones.read_table(spark, absent, schemas.COUNTRIES).count() == 0
    with pytest.raises(AnalysisException):
        files.or_empty(spark, schemas.COUNTRIES, lambda: spark.sql("SELECT nothing_here"))


def test_empty_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "array.json").write_text("[]")
    assert files.read_json_lines(spark, str(tmp_path / "empty.json"), schemas.DETAILS).count() == 0
    for name in ("empty.json", "array.json"):
        assert files.read_json_array(spark, str(tmp_path / name), schemas.DETAILS).count() == 0


def test_array_and_wrapped_layouts(spark, tmp_path, rows):
    places = [{"name": "Zürich", "iata": "ZRH", "continent": "Europe"}, {"name": "B", "iata": None}]
    (tmp_path / "array.json").write_text(json.dumps(places, indent=4, ensure_ascii=False))
    expected = [("B", None, None), ("Zürich", "ZRH", "Europe")]
    records = schemas.BRONZE_AIRPORTS["airports"].dataType.elementType
    array = files.read_json_array(spark, str(tmp_path / "array.json"), records)
    assert rows(array.filter("_corrupt is null").drop("_corrupt")) == expected
    wrapped = {"airports": places}
    (tmp_path / "pretty.json").write_text(json.dumps(wrapped, indent=4))
    (tmp_path / "line.json").write_text(json.dumps(wrapped))
    read = files.read_json_wrapped
    assert rows(read(spark, str(tmp_path / "pretty.json"), schemas.BRONZE_AIRPORTS, multi_line=True)) == expected
    assert rows(read(spark, str(tmp_path / "line.json"), schemas.BRONZE_AIRPORTS)) == expected


def test_json_sink_keeps_text_and_nulls(spark, countries, tmp_path):
    path = str(tmp_path / "out")
    files.write_json(countries(("Côte d'Ivoire", None)), path)
    texts = [f.read_text(encoding="utf-8").strip() for f in (tmp_path / "out").glob("*.json")]
    assert "".join(texts) == '{"country":"Côte d\'Ivoire","continent":null}'


def test_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_parquet(spark.range(100).coalesce(1), path, rows_per_file=30)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4


class Settings:
    """A session as far as the work folder looks at it."""

    def __init__(self, **settings):
        short = {"spark.checkpoint.dir": settings.get("dir")} | settings
        self.conf = SimpleNamespace(get=lambda key, default=None: short.get(key, default))
        self.sparkContext = SimpleNamespace(applicationId=str(settings))


def test_work_folder_is_the_one_the_cluster_names():
    assert workspace.shared_folder(Settings(dir="hdfs://shared/work", master="yarn")) == "hdfs://shared/work"
    assert workspace.shared_folder(Settings(dir="/shared", master="local[4]")) == "/shared"


def test_without_one_the_warehouse_serves():
    assert workspace.shared_folder(Settings(**{"spark.sql.warehouse.dir": "hdfs://house"})) == "hdfs://house"


@pytest.mark.parametrize("house", ["file:/house", "file:///house", "/house", "hdfs-house"])
def test_a_folder_of_one_machine_serves_no_cluster(house):
    settings = {"spark.sql.warehouse.dir": house}
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workspace.shared_folder(Settings(**settings, **{"spark.master": master}))
    for master in ("local", "local[4]", "local[*]"):
        assert workspace.shared_folder(Settings(**settings, **{"spark.master": master})) == house


def test_work_folders_are_fresh(spark):
    first, second = workspace.new_folder(spark, "x"), workspace.new_folder(spark, "x")
    assert first != second and os.path.isdir(first.removeprefix("file:"))


def test_a_hot_hour_is_written_by_several_tasks(spark, tmp_path):
    table = tmp_path / "t"
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hour = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 24)
        ts = F.timestamp_seconds(F.lit(1709596800) + hour * 3600)
        events = spark.range(0, 40000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), ts.alias("ts"))
        zones.write_by_time(events, str(table), "ts")
        files_of = lambda hour: len(list(table.glob(f"*/*/*/tech_hour={hour}/run=*/*.parquet")))
        assert files_of("00") > 3
        assert spark.read.parquet(str(table)).count() == 40000
    finally:
        for key in settings:
            spark.conf.unset(key)
