"""The fold is order free: any split into batches gives the same profiles."""

import random

import pytest
from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary, split_codes
from dossierlake.operators import fold, merge
from dossierlake.operators.attributes import (
    collect_props,
    explode_props,
    last_single_props,
    unpivot_attributes,
)
from dossierlake.plans.profiles import day_tables, fold_attributes, merge_tables, profiles_of

DICTIONARY = AttrDictionary(single=["S1"], multi=["M1"])
WIDE = (
    "entity_type string, oid string, data_source string, protocol string, action string, "
    "capture_time bigint, seq bigint, S1 string, M1 string"
)


def observations(seed, n=120):
    rng = random.Random(seed)
    return [
        (
            "t", f"o{rng.randrange(4)}", rng.choice("ab"), "p", rng.choice(["x", None]),
            rng.choice([1_400_000_000, 1_400_086_400, 1_400_100_000]) + rng.randrange(3), seq,
            f"s{rng.randrange(3)}", ",".join(rng.choice("klm") for _ in range(rng.randrange(3))),
        )
        for seq in range(n)
    ]


def brute_force(rows):
    """Record-at-a-time fold in plain Python."""
    base, info, single, multi = {}, {}, {}, {}
    for t, oid, ds, proto, action, ts, seq, s1, m1 in rows:
        pairs = {("S1", s1)} | {("M1", v) for v in m1.split(",") if v.strip()}
        for pair in pairs:
            cnt, lo, hi = base.get((t, oid, ds, proto, action or "", *pair), (0, ts, ts))
            base[t, oid, ds, proto, action or "", *pair] = (cnt + 1, min(lo, ts), max(hi, ts))
        cnt, lo, hi = info.get((t, oid), (0, ts, ts))
        info[t, oid] = (cnt + 1, min(lo, ts), max(hi, ts))
        if (oid, "S1") not in single or ts > single[oid, "S1"][1]:
            single[oid, "S1"] = (s1, ts)
        for code, value in pairs:
            if code == "M1":
                last, _ = multi.get((oid, value), (ts, ts))
                multi[oid, value] = (max(last, ts), ts)
    return base, info, single, multi


def collected(profiles):
    base = {
        tuple(r[c] for c in fold.ATTR_KEY): (r["cnt"], r["first_time"], r["last_time"])
        for r in profiles.base.collect()
    }
    info = {
        (r["entity_type"], r["oid"]): (r["cnt"], r["first_time"], r["last_time"])
        for r in profiles.info.collect()
    }
    attrs = profiles.info_attr.collect()
    single = {(r["oid"], r["code"]): (r["value"], r["last_time"]) for r in attrs if r["kind"] == "single"}
    multi = {
        (r["oid"], r["value"]): (r["last_time"], r["last_arrival_time"])
        for r in attrs if r["kind"] == "multi"
    }
    return base, info, single, multi


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_equals_record_at_a_time(spark, seed):
    rows = observations(seed)
    rng = random.Random(seed + 100)
    batches = [[], [], []]
    for row in rows:
        rng.choice(batches).append(row)
    sides = [day_tables(spark.createDataFrame(b, WIDE), DICTIONARY) for b in batches]
    merged = profiles_of(merge_tables(*sides), DICTIONARY)
    assert collected(merged) == brute_force(rows)


def test_merge_with_nothing_is_unchanged(spark):
    stored = day_tables(spark.createDataFrame(observations(3), WIDE), DICTIONARY)
    nothing = day_tables(spark.createDataFrame([], WIDE), DICTIONARY)
    status = merge.classify(stored["attr_day"], nothing["attr_day"])
    assert [r["status"] for r in status.select("status").distinct().collect()] == ["UNCHANGED"]
    merged = merge_tables(stored, nothing)
    assert merged["attr_day"].exceptAll(stored["attr_day"].select(*merged["attr_day"].columns)).isEmpty()


def test_repeats_count_once_or_every_time(spark):
    row = ("t", "o", "d", "p", "x", 1_400_000_000, 0, "s", "k,m,k, ")
    wide = spark.createDataFrame([row], WIDE)
    for distinct, expected in ((True, 1), (False, 2)):
        for rows in (
            unpivot_attributes(wide, DICTIONARY, distinct),
            explode_props(collect_props(wide, DICTIONARY), distinct),
        ):
            counts = {r["value"]: r["cnt"] for r in fold.base_counters(rows).collect()}
            assert counts == {"s": 1, "k": expected, "m": 1}


def test_single_code_tie_prefers_first_arrival_then_last_position(spark):
    obs = spark.createDataFrame(
        [
            ("t", "o", "d", "p", "x", 100_000, 7, [("S1", "late"), ("S1", "later")]),
            ("t", "o", "d", "p", "x", 100_000, 3, [("S1", "one"), ("S1", "two")]),
        ],
        "entity_type string, oid string, data_source string, protocol string, action string, "
        "capture_time bigint, seq bigint, props array<struct<code:string,value:string>>",
    )
    days = fold.fold_attr_day(explode_props(obs))
    assert fold.info_attributes(days, DICTIONARY).first()["value"] == "two"
    assert fold.latest_by_window(explode_props(obs)).first()["value"] == "two"
    kept = obs.select(last_single_props(F.col("props"), DICTIONARY).alias("p")).collect()
    assert sorted(p["value"] for r in kept for p in r["p"]) == ["later", "two"]


def test_packed_ranks_hold_extreme_numbers(spark):
    top = 2**63 - 1
    rows = [
        ("t", "o", "d", "p", "x", 99_999_999_999, seq, "S1", 0, v)
        for seq, v in ((top, "last"), (0, "first"))
    ]
    attrs = spark.createDataFrame(
        rows,
        "entity_type string, oid string, data_source string, protocol string, action string, "
        "capture_time bigint, seq bigint, code string, pos int, value string",
    )
    days = attrs.select(
        "value", fold.latest_rank().alias("latest"), fold.arrival_rank().alias("arrival")
    )
    best = days.agg(F.max_by("value", "latest"), F.max_by("value", "arrival")).first()
    assert tuple(best) == ("first", "last")
    assert days.select(fold.arrival_time(F.col("arrival"))).distinct().collect()[0][0] == 99_999_999_999


def test_times_before_1970_and_values_without_room(spark):
    kinds = "capture_time bigint, seq bigint, pos int"
    rank = fold.arrival_time(fold.arrival_rank())
    assert spark.createDataFrame([(-5, 3, 0)], kinds).select(rank).first()[0] == -5
    for row in ((5 * 10**12, 0, 0), (0, -1, 0), (0, 0, 10**6)):
        with pytest.raises(Exception, match="out of range"):
            spark.createDataFrame([row], kinds).select(fold.latest_rank()).collect()


def test_dictionary_text_is_trimmed_and_a_set():
    assert split_codes("a,b,b, c\n\t\t,,") == ["a", "b", "c"]
    d = AttrDictionary.from_text("a,b\n", "c")
    assert d.codes("single") == ["a", "b"] and d.codes("multi") == ["c"]


def test_dictionary_descriptor_and_join(spark, tmp_path):
    path = tmp_path / "set.json"
    path.write_text(
        '{"columns": [{"code": "A", "store": ""}, {"code": "N", "store": "single"},'
        ' {"code": "L", "store": "multi", "separator": ","}]}'
    )
    d = AttrDictionary.from_descriptor(str(path))
    rows = spark.createDataFrame([("N",), ("L",), ("A",)], "code string")
    kinds = {r["code"]: r["kind"] for r in d.join_kind(rows).collect()}
    assert kinds == {"N": "single", "L": "multi", "A": None}
    big = AttrDictionary([f"c{i}" for i in range(300)], ["L"])
    kinds = {r["code"]: r["kind"] for r in big.join_kind(rows).collect()}
    assert kinds == {"N": None, "L": "multi", "A": None}


def moves(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_an_observation_moves_once_and_a_merged_day_once(spark):
    obs = spark.createDataFrame(observations(5), WIDE).withColumn("entity_type", F.lit("t"))
    days = fold_attributes(obs, DICTIONARY)
    assert len(moves(days)) == 1 and "code" not in moves(days)[0]
    assert "REPARTITION_BY_NUM" in moves(days)[0]
    plain = fold.fold_attr_day(unpivot_attributes(obs, DICTIONARY)).select(days.columns)
    assert days.exceptAll(plain).isEmpty() and plain.exceptAll(days).isEmpty()
    merged = fold.merge_attr_day(days, days, by=fold.ATTR_KEY)
    base = fold.base_profile(merged, placed=True)
    assert len(moves(base)) == 3
    twice = fold.base_profile(fold.merge_attr_day(plain, plain))
    assert sorted(base.collect(), key=str) == sorted(twice.select(base.columns).collect(), key=str)


def test_day_rows_of_info_attributes_are_hashed(spark):
    """Day rows are aggregated in numbers; only the few rows of values are sorted."""
    days = spark.createDataFrame([], "entity_type string, oid string, data_source string, protocol string, "
                                 "action string, code string, value string, day int, n bigint, first_time bigint, "
                                 "last_time bigint, latest decimal(38,0), arrival decimal(38,0)")
    plan = fold.info_attributes(days, DICTIONARY)._jdf.queryExecution().sparkPlan().toString()
    lines = [line for line in plan.splitlines() if "Aggregate" in line]
    assert "HashAggregate" in lines[-1], plan


def test_rank_time_orders_like_the_time(spark):
    rows = [(t, s, p) for t in (-5, 0, 7) for s in (0, 3, 10**18) for p in (0, 999_999)]
    frame = spark.createDataFrame(rows, "capture_time bigint, seq bigint, pos int")
    got = frame.select("capture_time", fold.rank_time(fold.latest_rank()).alias("t")).collect()
    assert [r["t"] for r in got] == [r["capture_time"] for r in got]
