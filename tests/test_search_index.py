"""The bitmap index against the search that reads the attribute rows."""

import pytest
from pyspark.sql import functions as F

from dossierlake.operators import lookup
from dossierlake.plans.search_index import SearchIndex, Term

ROWS = "entity_type string, oid string, code string, value string, protocol string, action string"


def attrs(spark, n, start=0):
    """A third of all entities hold one value."""
    i = F.col("id")
    rows = spark.range(start, start + n).select(
        F.lit("user").alias("entity_type"), i.cast("string").alias("oid"), F.explode(F.array(
            F.struct(F.lit("A").alias("code"), F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), i % 500)).alias("value"), F.lit("p1").alias("protocol"), F.lit("a").alias("action")),
            F.struct(F.lit("B").alias("code"), F.concat(F.lit("w"), i % 7).alias("value"), F.lit("p2").alias("protocol"), F.when(i % 2 == 0, "a").otherwise("b").alias("action")),
        )).alias("x"),
    )
    return rows.select("entity_type", "oid", "x.*")


def condition(term):
    return lookup.has(term.code, term.value, term.protocol, term.action)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    index = SearchIndex(spark, str(tmp_path_factory.mktemp("index")))
    # More entities than one bitmap has bits, in two batches that overlap.
    first, second = attrs(spark, 40_000), attrs(spark, 5_000, 38_000)
    assert index.add(first, "one") and index.add(second, "two")
    return index, first.unionByName(second)


@pytest.mark.parametrize("mode, terms", [
    ("and", [Term("A", "hot"), Term("B", "w3")]),
    ("and", [Term("A", "hot", "p1", "a"), Term("B", "w3", action="b")]),
    ("and", [Term("B", "w1"), Term("B", "w1", "p2")]),
    ("and", [Term("B", "w1"), Term("B", "w2")]),
    ("and", [Term("A", "hot"), Term("A", "none")]),
    ("or", [Term("A", "v7"), Term("B", "w6", action="a")]),
    ("or", [Term("A", "none")]),
])
def test_same_as_reading_the_rows(built, mode, terms):
    index, rows = built
    want = lookup.search(rows, [condition(t) for t in terms], mode)
    got = index.search(terms, mode)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert index.count(terms, mode).first()[0] == want.count()


def test_numbers_are_dense_and_kept(built):
    index, _ = built
    stored = index.entities()
    assert stored.count() == 43_000
    low, high, distinct = stored.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert (low, high, distinct) == (1, 43_000, 43_000)


def test_a_batch_counts_once_and_a_cut_off_one_is_added_again(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "i"))
    assert index.count([Term("A", "hot")]).first()[0] == 0
    rows = attrs(spark, 30)
    # A batch that numbered its entities and went no further.
    rows.limit(4).select("entity_type", "oid", F.lit(1).cast("long").alias("number"), F.lit(1).cast("long").alias("chunk")).write.parquet(
        f"{index.root}/entities/batch=x"
    )
    assert index.add(rows, "x")
    assert not index.add(rows, "x")
    assert index.entities().count() == 30 and index.count([Term("A", "hot")]).first()[0] == 10


def test_the_search_reads_the_index_alone(built):
    plan = built[0].search([Term("A", "hot"), Term("B", "w3")])._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("/postings" in line or "/entities" in line for line in scans)
    assert any("PushedFilters" in line and "code" in line for line in scans)


def test_unknown_mode(built):
    with pytest.raises(ValueError):
        built[0].search([Term("A", "hot")], "xor")
