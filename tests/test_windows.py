import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from askloom.operators.windows import GROUP, group_width, neighbor, running_number, running_sum


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    rows = [("hot", t, rng.randint(0, 3)) for t in sorted(rng.sample(range(900), 300))]
    rows += [(f"k{i}", t, rng.randint(0, 3)) for i in range(40) for t in range(rng.randint(1, 9))]
    return spark.createDataFrame(rows, "key string, turn int, v int").cache()


@pytest.mark.parametrize("width", [1, 8, 4096, None])
def test_running_sum(events, width):
    plain = events.withColumn("s", F.sum("v").over(Window.partitionBy("key").orderBy("turn")))
    got = running_sum(events, ["key"], "turn", F.col("v"), "s", width)
    assert got.exceptAll(plain).isEmpty() and got.count() == plain.count()


@pytest.mark.parametrize("width", [1, 8, 4096, None])
@pytest.mark.parametrize("step", [1, -1])
def test_neighbor(events, width, step):
    shift = F.lead if step > 0 else F.lag
    value = F.struct("turn", "v")
    plain = events.withColumn("n", shift(value).over(Window.partitionBy("key").orderBy("turn")))
    got = neighbor(events, ["key"], "turn", value, "n", step, width)
    assert got.exceptAll(plain).isEmpty() and got.count() == plain.count()


def test_running_number(events):
    numbered = running_number(events.repartition(7), F.desc("v"), "key", "turn").collect()
    ordered = sorted(numbered, key=lambda r: (-r.v, r.key, r.turn))
    assert [r.row_no for r in ordered] == list(range(1, len(numbered) + 1))


def test_plain_window_only_when_no_key_can_be_large(events):
    assert group_width(events, "turn") is None
    for extra in (GROUP, -1):
        assert group_width(events.withColumn("turn", F.when(F.col("key") == "hot", extra).otherwise(F.col("turn"))), "turn") == GROUP
