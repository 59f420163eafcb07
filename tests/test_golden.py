"""Known results of the indicators over the smallest tables."""

from skytally.catalog import QUERIES


def test_top_rows(spark, sf_dir):
    def one(name):
        (row,) = QUERIES[name](spark, sf_dir).collect()
        return tuple(row)

    assert one("q1_top_airline") == ("Supplier#000000005", 321)
    assert one("q5_top_maker") == ("cold", 485)
    assert one("q7_airport_imbalance") == (11, 0, 482, 482)
    longest = one("q3_longest_flight")
    assert (longest[0], longest[1], longest[2], longest[5]) == (4, 20, 21, 59208.0)


def test_leaders_keep_ties(spark, sf_dir):
    leaders = QUERIES["q2_regional_all"](spark, sf_dir).collect()
    assert len(leaders) == 6
    africa = {(r.airline_name, r.flight_count) for r in leaders if r.origin_continent == "AFRICA"}
    assert africa == {("Supplier#000000000", 110), ("Supplier#000000004", 110)}
    assert len(QUERIES["q2_regional_active"](spark, sf_dir).collect()) == 5


def test_means(spark, sf_dir):
    means = {r.continent: r.avg_duration for r in QUERIES["q4_avg_duration"](spark, sf_dir).collect()}
    assert means == {
        "AFRICA": 3265.050505,
        "AMERICA": 2555.805825,
        "ASIA": 826.394904,
        "EUROPE": 2056.263291,
        "MIDDLE EAST": 1244.44898,
    }


def test_models(spark, sf_dir):
    models = QUERIES["q6_top_models"](spark, sf_dir).collect()
    assert (len(models), sum(r.flight_count for r in models)) == (30, 717)
