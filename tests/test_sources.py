"""Tagged files, glob inputs, generated data, delimited lines, throughput."""

import logging

import pytest
from pyspark.sql import functions as F

from dossierlake.functions import keys, values
from dossierlake.operators import accumulate, assemble, lookup
from dossierlake.sources import generator, paths, tagged_tsv
from tests import sample


def test_bad_lines_go_to_quarantine(spark, tmp_path):
    rows = [
        ("t", "1", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1", ""),
        ("t", "1", "2014-10-01 12:05:20", "116", "", "x", "@Ada", "1", "a, ,b,"),
        ("t", "", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1", ""),
        ("", "1", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1", ""),
        ("t", "1", "", "116", "p", "x", "Ada", "1", ""),
        ("t", "1", "yesterday", "116", "p", "x", "Ada", "1", ""),
        ("t", "1", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1"),
        ("t", "1", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1", "a", "", ""),
        ("t", "1", "2014-10-01 12:05:20", "116", "p", "x", "Ada", "1", "a", "more"),
    ]
    path = sample.write_file(tmp_path / "f", rows)
    scan = tagged_tsv.scan_tagged(spark, path, sample.DICTIONARY)
    reasons = sorted(r["reason"] for r in scan.quarantine.collect())
    assert reasons == sorted([
        "no entity id", "no entity type", "no time", "bad time", "too few columns",
        "too many columns",
    ])
    assert tagged_tsv.count_records(scan) == 3
    props = [[tuple(p) for p in r["props"]] for r in scan.observations.orderBy("seq").collect()]
    assert props[1] == [("B010001", "@Ada"), ("B010011", "1"), ("B010007", "a"), ("B010007", "b")]
    assert scan.observations.orderBy("seq").collect()[1]["protocol"] == ""
    padded = tagged_tsv.scan_tagged(spark, path, sample.DICTIONARY, pad_short=True)
    assert tagged_tsv.count_records(padded) == 4


def test_headers_are_checked(spark, tmp_path):
    (tmp_path / "a").write_text("t\t1\n")
    with pytest.raises(ValueError, match="no column header"):
        tagged_tsv.read_layout(spark, str(tmp_path / "a"))
    (tmp_path / "b").write_text("@A\tB\n1\t2\n")
    (tmp_path / "c").write_text("@A\tC\n")
    assert tagged_tsv.read_layout(spark, str(tmp_path / "b")) == ["A", "B"]
    with pytest.raises(ValueError, match="differ"):
        tagged_tsv.read_layout(spark, [str(tmp_path / "b"), str(tmp_path / "c")])


def test_globs_without_a_match_are_skipped(spark, out, caplog):
    spark.range(3).write.parquet(out("new"))
    with caplog.at_level(logging.WARNING):
        both = paths.read_merge_inputs(spark, f"{out('new')},{out('none')}*", out("store*"))
    assert both.groupBy("src").count().collect() == [("new", 3)]
    assert len(caplog.messages) == 2
    with pytest.raises(FileNotFoundError):
        paths.read_merge_inputs(spark, out("none*"))


def test_generated_rows_keep_their_bounds(spark):
    config = generator.GeneratorConfig(day_start=1_388_534_400, id_num=5)
    rows = generator.generate_range(spark, 4, 500, config).cache()
    again = generator.generate(spark.range(2000).repartition(7), config)
    assert rows.exceptAll(again).isEmpty()
    assert rows.where(F.size("props") != 10).isEmpty()
    low, high = rows.agg(F.min("capture_time"), F.max("capture_time")).first()
    assert config.day_start <= low and high < config.day_start + 86_400
    per_code = (
        rows.select("entity_type", "oid", F.explode("props").alias("p"))
        .groupBy("entity_type", "oid", "p.code")
        .agg(F.count_distinct("p.value").alias("n"))
        .collect()
    )
    for r in per_code:
        assert r["n"] <= (10 if r["code"] in config.multi_codes else 5)
    assert rows.select("entity_type").distinct().count() == 5
    other = generator.GeneratorConfig(day_start=1_388_534_400, id_num=5, seed="1")
    assert not rows.exceptAll(generator.generate_range(spark, 4, 500, other)).isEmpty()


def test_generation_job_refuses_existing_output(spark, out):
    config = generator.GeneratorConfig(day_start=0)
    rows = generator.generate_range(spark, 3, 40, config)
    summary = generator.write_generated(rows, out("g"), "gzip").first()
    assert (summary["tasks"], summary["total_records"]) == (3, 120)
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        generator.write_generated(rows, out("g"))


def test_throughput(spark):
    tasks = spark.createDataFrame(
        [(10, 1_000_000, 100), (30, 9_000_000, 300)], "records bigint, bytes bigint, millis bigint"
    )
    s = accumulate.throughput(tasks, 500).first()
    assert s["rec_rate_mean"] == pytest.approx(100.0)
    assert s["rec_rate_std"] == pytest.approx(0.0, abs=1e-6)
    assert s["mb_throughput"] == pytest.approx(10_000_000 * 1000 / (400 * accumulate.MEGA))
    assert s["rec_cluster_rate"] == pytest.approx(80.0)


def test_delimited_lines(spark):
    rows = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert assemble.delimited(rows).first()[0] == "1,null,x"
    assert assemble.delimited(rows, ["c", "a"], "|").first()[0] == "x|1"


def test_byte_functions(spark):
    one = spark.range(1)
    text = F.lit("0,255,-1,7")
    data = values.parse_byte_list(text)
    row = one.select(
        values.to_hex(data),
        values.format_byte_list(data),
        values.parse_byte_list(F.lit("")),
        values.format_byte_list(F.unhex(F.lit(""))),
        values.unsigned_value(F.unhex(F.lit("ff" * 8))),
        values.unsigned_value(F.unhex(F.lit("ff" * 15))),
        values.unsigned_value(F.unhex(F.lit(""))),
    ).first()
    assert tuple(row) == ("00ffff07", "0,255,255,7", None, "", 2**64 - 1, 2**120 - 1, None)
    with pytest.raises(Exception, match="more than fifteen bytes"):
        one.select(values.unsigned_value(F.unhex(F.lit("ff" * 16)))).collect()


def test_random_text(spark):
    rows = spark.range(200).select(values.random_text(F.col("id"), 11, values.UPPER).alias("t"))
    texts = {r["t"] for r in rows.collect()}
    assert len(texts) == 200
    assert all(len(t) == 11 and set(t) <= set(values.UPPER) for t in texts)


def test_split_points_match_buckets(spark):
    for n in (4, 7, 16):
        starts = [0] + [int(p.split(",")[0]) * 256 + int(p.split(",")[1]) for p in keys.split_points(n)]
        assert len(starts) == n
        assert [s * n // 65536 for s in starts] == list(range(n))
        assert all((s - 1) * n // 65536 == i for i, s in enumerate(starts[1:]))


def test_slice_and_search(spark):
    rows = spark.range(30).withColumnRenamed("id", "seq").repartition(5)
    assert [r[0] for r in lookup.slice_rows(rows, ["seq"]).collect()] == list(range(10))
    assert [r[0] for r in lookup.slice_rows(rows, ["seq"], 5, 3).collect()] == [4, 5, 6]
    attrs = spark.createDataFrame(
        [("t", "1", "p", "x", "N", "a"), ("t", "1", "q", "x", "M", "b"), ("t", "2", "p", "x", "N", "a")],
        "entity_type string, oid string, protocol string, action string, code string, value string",
    )
    both = [lookup.has("N", "a", "p"), lookup.has("M", "b", "q", "x")]
    assert [r["oid"] for r in lookup.search(attrs, both).collect()] == ["1"]
    assert sorted(r["oid"] for r in lookup.search(attrs, both, "or").collect()) == ["1", "2"]
    assert lookup.search(attrs, [lookup.has("N", "a", "q")]).isEmpty()
