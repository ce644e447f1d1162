"""Consolidation: the sample history, its edge cases, and random histories
against a plain Python computation."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronicle.operators import history, records
from chronicle.operators.versions import number_versions
from chronicle.plans import registry
from chronicle.plans.daily import consolidate_cities
from chronicle.schemas import HISTORY
from chronicle.sources.tables import history_from_rows, rows

# The history whose consolidation must come out as published.
SAMPLE = [
    (1, "John Doe", "TX", "Houston", "2020-01-01", "2022-07-25"),
    (1, "John Doe", "TX", "Dallas", "2022-07-25", "2023-08-19"),
    (1, "John Doe", "TX", None, "2023-08-19", None),
    (2, "Richard Smith", "CA", "San", "2022-04-12", None),
    (3, "Max Mustermann", "CA", None, "2000-07-22", None),
]
FIELDS = ("person_id", "name", "state", "city", "valid_from", "valid_to")


@pytest.fixture(scope="module")
def sample(spark):
    return history_from_rows(spark, [dict(zip(FIELDS, r)) for r in SAMPLE])


@pytest.fixture(scope="module")
def result(sample):
    return {r.person_id: r for r in consolidate_cities(sample).collect()}


def versions(spark, triples):
    return history_from_rows(
        spark, [{"person_id": p, "city": c, "valid_from": d} for p, c, d in triples]
    )


def test_distinct_cities(result):
    assert result[1].distinct_cities == 2


def test_first_city(result):
    assert result[1].first_city == "Houston"


def test_last_city_is_null(result):
    assert result[1].last_city is None


def test_last_non_null_city(result):
    assert result[1].last_non_null_city == "Dallas"


def test_person_without_any_city(result):
    assert tuple(result[3]) == (3, 0, None, None, None)


def test_single_version(result):
    assert result[2].distinct_cities == 1
    assert result[2].last_non_null_city == "San"


def test_one_row_per_person(result):
    assert len(result) == 3


def test_same_result_twice(sample):
    assert consolidate_cities(sample, sort=True).collect() == consolidate_cities(sample, sort=True).collect()


def test_golden_table(sample):
    assert list(rows(consolidate_cities(sample, sort=True))) == [
        {"person_id": 1, "distinct_cities": 2, "first_city": "Houston", "last_city": None, "last_non_null_city": "Dallas"},
        {"person_id": 2, "distinct_cities": 1, "first_city": "San", "last_city": "San", "last_non_null_city": "San"},
        {"person_id": 3, "distinct_cities": 0, "first_city": None, "last_city": None, "last_non_null_city": None},
    ]


@pytest.mark.parametrize(
    "triples, expected",
    [
        ([(1, "X", None), (1, "Y", "2020-01-01"), (1, "Z", "2021-01-01")], (1, 3, "Y", "Z", "Z")),
        ([(2, "", "2020-01-01"), (2, "K", "2021-01-01")], (2, 2, "", "K", "K")),
        ([(3, "M", None)], (3, 1, "M", "M", "M")),
        ([(None, "P", "2020-01-01"), (None, "Q", "2021-01-01")], (None, 2, "P", None, None)),
    ],
)
def test_edges(spark, triples, expected):
    assert [tuple(r) for r in consolidate_cities(versions(spark, triples)).collect()] == [expected]


def test_no_rows(spark):
    assert consolidate_cities(spark.createDataFrame([], HISTORY)).collect() == []


def test_equal_times_are_decided_by_the_tie_column(spark):
    df = spark.createDataFrame([(1, "b", 5, 2), (1, "a", 5, 1), (1, "c", 5, 3)], "k long, v string, t long, i long")
    (row,) = history.consolidate(df, "k", "v", "t", "i").collect()
    assert tuple(row) == (1, 3, "a", "c", "c")


@pytest.mark.parametrize("bad", ["", "Spring 1940"])
def test_bad_dates(spark, bad):
    raw = spark.createDataFrame([(1, None, None, "X", bad, None)], "person_id long, name string, state string, city string, valid_from string, valid_to string")
    with pytest.raises(PySparkException, match="not a date"):
        records.typed_history(raw).collect()
    assert records.typed_history(raw, strict=False).first().valid_from is None
    assert records.history_rejects(raw).count() == 1


def random_history(rng, n):
    cities = ["A", "B", "", None, "C"]
    out = []
    for i in range(n):
        key = rng.choice([None, 1, 1, 1, 2, 3, 4, 5])
        day = rng.choice([None] + [datetime.date(2020, 1, d) for d in range(1, 29)])
        out.append((key, rng.choice(cities), day, i))
    rng.shuffle(out)
    return out


def consolidated_in_python(rows):
    out = set()
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        up = sorted(own, key=lambda r: (r[2] is None, r[2] or datetime.date.min, r[3]))
        down = sorted(own, key=lambda r: (r[2] is not None, r[2] or datetime.date.min, r[3]), reverse=True)
        known = [r[1] for r in down if r[1] is not None]
        out.add(
            (
                key,
                len({r[1] for r in own if r[1] is not None}),
                up[0][1],
                down[0][1] if key is not None else None,
                known[0] if known and key is not None else None,
            )
        )
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_histories(spark, seed):
    data = random_history(random.Random(seed), 300)
    df = spark.createDataFrame(data, "k long, v string, t date, i long").repartition(5)
    expected = consolidated_in_python(data)
    assert {tuple(r) for r in history.consolidate(df, "k", "v", "t", "i").collect()} == expected
    assert {tuple(r) for r in history.consolidate_joined(df, "k", "v", "t", "i").collect()} == expected

    # The window form: version numbers first, then the rows numbered one.
    numbered = number_versions(df, "k", "t", "i")
    windowed = numbered.groupBy("k").agg(
        F.max(F.when(F.col("rn_asc") == 1, F.col("v"))), F.max(F.when(F.col("rn_desc") == 1, F.col("v")))
    )
    known = {r[0]: r for r in expected}
    for k, first, last in windowed.collect():
        assert first == known[k][2]
        assert k is None or last == known[k][3]


@pytest.mark.parametrize("split_above", [0, 20, 10**9])
def test_version_numbers_do_not_depend_on_splitting(spark, split_above):
    data = random_history(random.Random(11), 400)
    df = spark.createDataFrame(data, "k long, v string, t date, i long").repartition(5)
    got = number_versions(df, "k", "t", "i", split_above=split_above)
    expected = set()
    for key in {r[0] for r in data}:
        own = [r for r in data if r[0] == key]
        up = sorted(own, key=lambda r: (r[2] is None, r[2] or datetime.date.min, r[3]))
        down = sorted(own, key=lambda r: (r[2] is not None, r[2] or datetime.date.min, r[3]), reverse=True)
        expected |= {(r[3], up.index(r) + 1, down.index(r) + 1) for r in own}
    assert {tuple(r) for r in got.select("i", "rn_asc", "rn_desc").collect()} == expected


KINDS = {
    "date": lambda n: None if n is None else datetime.date(2020, 1, 1) + datetime.timedelta(n * 400),
    "timestamp": lambda n: None if n is None else datetime.datetime(2026, 3, 8, 1, 59) + datetime.timedelta(minutes=n * 20),
    "timestamp_ntz": lambda n: None if n is None else datetime.datetime(2026, 3, 8, 1, 59) + datetime.timedelta(minutes=n * 20),
    "int": lambda n: None if n is None else n - 5,
    "boolean": lambda n: None if n is None else n > 4,
    "decimal(10,3)": lambda n: None if n is None else Decimal(n - 5) / 8,
    "long": lambda n: None if n is None else (n - 5) * 2**59,
    "string": lambda n: None if n is None else f"2026-{n:02}",
    "double": lambda n: None if n is None else (n - 5) / 3,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", KINDS)
def test_places_of_every_type(spark, kind, zone):
    """Many ties and unknown places; times without a zone also where the session's clocks are put forward."""
    rng = random.Random(kind)
    make, before = KINDS[kind], spark.conf.get("spark.sql.session.timeZone")
    data = [(rng.choice([None, 1, 2]), rng.choice(["A", None, "B", "C"]), rng.choice([None, *range(10)]), i - 100) for i in range(200)]
    if kind == "boolean":
        rank = {None: None, **{n: n > 4 for n in range(10)}}
    else:
        rank = {n: n for n in [None, *range(10)]}
    expected = consolidated_in_python([(k, v, None if n is None else datetime.date(2020, 1, 1) + datetime.timedelta(int(rank[n])), i) for k, v, n, i in data])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k, v, make(n), i) for k, v, n, i in data], f"k long, v string, t {kind}, i long").repartition(4)
        assert {tuple(r) for r in history.consolidate(df, "k", "v", "t", "i").collect()} == expected
        alone = history.consolidate(df.withColumn("i", F.lit(None).cast("long")), "k", "v", "t", "i").collect()
        assert {tuple(r) for r in history.consolidate(df, "k", "v", "t").collect()} == {tuple(r) for r in alone}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_far_times_keep_their_order(spark):
    far = ["0001-01-01", "9999-12-31 23:59:59.999999", "1969-12-31 23:59:59.999999"]
    for kind in ("timestamp", "timestamp_ntz"):
        rows = spark.createDataFrame([(1, t, t) for t in far], "k long, v string, t string").withColumn("t", F.col("t").cast(kind))
        for i in (-(2**63), 2**63 - 1, None):
            got = history.consolidate(rows.withColumn("i", F.lit(i).cast("long")), "k", "v", "t", "i").first()
            assert (got.first_value, got.last_value) == (far[0], far[1])


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if n.startswith(("scd_", "person", "stored_history", "consolidated")) and "row_numbers" not in n))
def test_raw_histories_are_combined_without_sorting(spark, name):
    """Below the first exchange every aggregate of a registered history is a hash table."""
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    raw = [line for line in plan.splitlines() if "partial_min(" in line or "partial_max(" in line]
    assert raw or name in ("scd_distinct_values", "scd_approximate_values", "consolidated_count")
    assert all("HashAggregate" in line and "ObjectHash" not in line for line in raw)


def test_sketches_stay_within_their_error(spark):
    """Three times the standard error, for keys of very different sizes and after merging."""
    sizes = {1: 3, 2: 900, 3: 40_000, 4: 150_000}
    rows = spark.range(sum(sizes.values())).selectExpr("id AS v")
    bounds, start = F.lit(0), 0
    for key, n in sizes.items():
        bounds, start = F.when(F.col("v") >= start, key).otherwise(bounds), start + n
    rows = rows.withColumn("k", bounds)
    rows = rows.unionByName(rows.sample(0.3, seed=1)).unionByName(spark.createDataFrame([(None, 1)], "v long, k int"))
    parts = [history.value_sketches(rows.where(F.pmod(F.xxhash64("v"), F.lit(3)) == i), "k", "v") for i in range(3)]
    merged = history.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), "k")
    found = {r.k: r.n for r in history.sketched_values(merged, "k", "n").collect()}
    error = 1.04 / 2 ** (history.SKETCH_BITS / 2)
    assert all(abs(found[k] - n) <= 3 * error * n for k, n in sizes.items()) and found[1] == 3


def test_consolidation_sends_no_raw_rows_through_a_window(spark, sample):
    plan = consolidate_cities(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    assert plan.index("partial_min") > 0
