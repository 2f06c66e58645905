import random

from pyspark.sql import functions as F

from dossierlake.operators import parts
from dossierlake.operators.lookup import slice_by_ranges
from dossierlake.operators.numbering import in_ranges, numbered, runs


def rows(spark):
    r = random.Random(2)
    data = [("hot", r.randrange(1000), "x") for _ in range(3000)]
    data += [(f"k{i % 50}", r.randrange(5), "y") for i in range(2000)] + [(None, None, "z"), (None, 1, None)]
    return spark.createDataFrame(data, "k string, v int, pay string").repartition(5)


def test_positions_are_those_of_a_sort(spark):
    data = rows(spark)
    got = numbered(data, ["k"], ["v"]).collect()
    seen = {}
    for row in got:
        seen.setdefault(row.k, []).append((row.position, -1 if row.v is None else row.v))
    assert len(got) == data.count()
    for places in seen.values():
        places.sort()
        assert [p for p, _ in places] == list(range(1, len(places) + 1))
        assert [v for _, v in places] == sorted(v for _, v in places)


def test_a_busy_key_lies_in_many_ranges(spark):
    placed = in_ranges(rows(spark), ["k", "v"])
    share = runs(placed, ["k"]).where("k = 'hot'")
    assert share.count() >= 2
    assert placed.groupBy("slot").count().agg(F.max("count")).first()[0] < 3000


def test_equal_rows_are_spread(spark):
    same = spark.range(4000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    assert in_ranges(same, ["k", "v"]).select("slot").distinct().count() > 1
    assert sorted(r.position for r in numbered(same, ["k"], ["v"]).collect()) == list(range(1, 4001))


def test_no_key_numbers_the_whole_table(spark):
    table = spark.range(100).withColumnRenamed("id", "v").repartition(3)
    assert all(r.position == r.v + 1 for r in numbered(table, [], ["v"]).collect())
    assert numbered(table.where("v < 0"), ["v"], ["v"]).collect() == []


def test_far_slices_read_the_ranges_they_meet(spark):
    table = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    for offset, length in ((1, 10), (4321, 300), (4990, 50), (0, 3), (6000, 5)):
        got = [r.v for r in slice_by_ranges(table, ["v"], offset, length).collect()]
        begin = max(offset, 1) - 1
        assert got == list(range(5000))[begin : begin + length]


def test_only_busy_keys_are_ranked_in_ranges(spark, monkeypatch):
    rows = [("a", i) for i in range(7)] + [("b", i) for i in range(3)] + [(None, i) for i in range(5)]
    frame = spark.createDataFrame(rows, "k string, v int")
    want = sorted(((k, v, v // 2) for k, v in rows), key=repr)
    seen = []
    ranged = parts.numbered
    monkeypatch.setattr(parts, "numbered", lambda rows, *a: seen.append(rows.count()) or ranged(rows, *a))
    assert sorted(map(tuple, parts.with_page(frame, ["k"], ["v"], length=2).collect()), key=repr) == want
    assert seen == []
    monkeypatch.setattr(parts, "BUSY_ITEMS", 4)
    assert sorted(map(tuple, parts.with_page(frame, ["k"], ["v"], length=2).collect()), key=repr) == want
    assert seen == [12]
