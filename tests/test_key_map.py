"""The persistent map from natural keys to dense keys."""

from martforge.operators.keys import assign_keys, with_keys
from tests.conftest import rows

KEYS = "country string, city string, k long"


def test_keys_stay_and_new_ones_follow(spark):
    first = spark.createDataFrame([("US", "B"), ("US", None), ("DE", "A"), ("US", "B")], "country string, city string")
    one = assign_keys(spark.createDataFrame([], KEYS), first, ["country", "city"], out="k")
    held = spark.createDataFrame(one.collect(), KEYS)
    assert sorted(r["k"] for r in held.collect()) == [1, 2, 3]

    second = spark.createDataFrame([("AA", "Z"), ("US", None), (None, None), ("US", "B")], "country string, city string")
    two = spark.createDataFrame(assign_keys(held, second, ["country", "city"], out="k").collect(), KEYS)
    assert set(map(tuple, held.collect())) <= set(map(tuple, two.collect()))       # nothing given before changes
    assert sorted(r["k"] for r in two.collect()) == [1, 2, 3, 4, 5]

    again = assign_keys(two, second, ["country", "city"], out="k")
    assert rows(again) == rows(two)

    found = with_keys(second.unionByName(spark.createDataFrame([("XX", "Y")], second.schema)), two, ["country", "city"], out="k")
    by = {(r["country"], r["city"]): r["k"] for r in found.collect()}
    assert by[("XX", "Y")] is None and by[(None, None)] in (4, 5) and by[("US", None)] <= 3
