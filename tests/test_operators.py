import random

import pytest
from pyspark.sql import functions as F

from registrylake.functions.text import name_number, name_prefix
from registrylake.operators.joins import enrich_with_max, full_outer_using, keep_known_keys
from registrylake.operators.keys import distinct_keys, distinct_values, first_per_key, row_count
from registrylake.operators.rows import blank_to_null, drop_columns, exclude_codes, in_or_null


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", 0, " ", "x")], "a string, n int, `b c` string, d string")
    got = blank_to_null(df)
    assert got.columns == df.columns
    assert rows(got) == [(None, 0, " ", "x")]


def test_in_or_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert rows(df.where(in_or_null("n", [2]))) == [(2,), (None,)]


def test_exclude_codes_drops_null_codes_and_ignores_null_in_the_list(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, code int")
    codes = spark.createDataFrame([(20,), (20,), (None,)], "c int")
    got = exclude_codes(df, codes, "code")
    assert got.columns == ["id", "code"]
    assert rows(got) == [(1, 10)]


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert drop_columns(df, ["b", "absent"]).columns == ["a", "c"]


def test_name_parts(spark):
    names = [("empresas0",), ("Empresas01",), ("socios",), ("123",), ("",), ("a1b22",)]
    df = spark.createDataFrame(names, "n string")
    got = [tuple(r) for r in df.select(name_prefix(F.col("n")), name_number(F.col("n"))).collect()]
    assert got == [
        ("empresas", "0"), ("empresas", "01"), ("socios", None), ("", "123"), ("", None),
        ("a1b", "22"),
    ]


def test_first_per_key(spark):
    data = [(1, "b", 1), (1, "a", 2), (1, "a", None), (None, "z", 1), (None, "y", 1), (2, None, 1),
            (2, "q", 9)]
    df = spark.createDataFrame(data, "k int, s string, n int")
    assert rows(first_per_key(df, "k")) == [(1, "a", 2), (2, "q", 9), (None, "y", 1)]


def test_first_per_key_limits_each_group_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(first_per_key(df, "k"))
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_distinct_and_count(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(distinct_keys([a, b], "k")) == [(1,), (2,), (None,)]
    assert rows(distinct_values(a, "k")) == [(1,)]
    assert rows(row_count(a)) == [(3,)] and rows(row_count(a.where("false"))) == [(0,)]


def brute_full_outer(left, right):
    out = []
    for k, *l in left:
        found = [r for rk, *r in right if k is not None and rk == k]
        out += [(k, *l, *r) for r in found] or [(k, *l, None, None)]
    known = {k for k, *_ in left if k is not None}
    return out + [(k, None, *r) for k, *r in right if k is None or k not in known]


@pytest.mark.parametrize("seed", range(3))
def test_full_outer_using_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, "", *"abcdefgh"])
    left = [(key(), f"l{i}") for i in range(rng.randrange(15))]
    right = [(key(), rng.choice(["", "x", None]), i) for i in range(rng.randrange(30))]
    unique = spark.createDataFrame(left, "k string, l string")
    facts = spark.createDataFrame(right, "k string, r string, n int")
    got = full_outer_using(unique, facts, "k")
    assert got.columns == ["k", "l", "r", "n"]
    assert rows(got) == sorted(brute_full_outer(left, right), key=str)


def test_a_filter_above_the_full_join_does_not_revive_companies(spark):
    companies = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "k string, name string")
    facts = spark.createDataFrame([("1", 2), ("2", 8), ("4", 2), ("5", None)], "k string, st int")
    got = full_outer_using(companies, facts, "k").where(in_or_null("st", [2]))
    assert rows(got) == [("1", "A", 2), ("3", "C", None), ("4", None, 2), ("5", None, None)]


def test_filter_reaches_the_joined_facts_and_not_the_scan_of_all_keys(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "id % 4 AS st").write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    companies = spark.range(50).selectExpr("id AS k", "'x' AS name")
    plan = plan_of(full_outer_using(companies, facts, "k").where(in_or_null("st", [2])))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # Facts with a key, facts without one, and all keys.
    filtered = ["Or(EqualTo(st,2),IsNull(st))" in scan for scan in scans]
    assert sorted(filtered) == [False, True, True]
    assert sum("IsNotNull(k)" in scan and f for scan, f in zip(scans, filtered)) == 1
    assert sum("IsNull(k)" in scan and f for scan, f in zip(scans, filtered)) == 1
    assert any("ReadSchema: struct<k:bigint>" in scan for scan in scans)


def test_keep_known_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    got = keep_known_keys(df, keys, "k")
    assert got.columns == ["k", "v"]
    assert rows(got) == [(1, "a"), (1, "b")]


def test_enrich_with_max(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, name string")
    facts = spark.createDataFrame(
        [(1, "RJ"), (1, "SP"), (1, None), (2, None), (None, "MG")], "k int, uf string"
    )
    got = enrich_with_max(dim, facts, "k", "uf")
    assert rows(got) == [(1, "x", "SP"), (2, "y", None), (None, "z", None)]


def test_enrich_with_max_hashes_before_it_sorts(spark):
    facts = spark.range(100).selectExpr("id % 5 AS k", "concat('v', id % 3) AS uf")
    plan = plan_of(enrich_with_max(spark.range(5).toDF("k"), facts, "k", "uf"))
    lowest_shuffle = plan.rindex("Exchange hashpartitioning")
    below, above = plan[lowest_shuffle:], plan[:lowest_shuffle]
    assert "partial_count(1)" in below and "Sort" not in below
    assert "partial_max" in above  # each task sends one row per key


def test_companies_and_key_lists_are_not_broadcast(spark):
    companies = first_per_key(spark.range(30).selectExpr("id AS k", "id AS name"), "k")
    facts = spark.range(20, 60).selectExpr("id AS k", "id AS number")
    known = distinct_values(spark.range(25).toDF("k"), "k")
    for df, count in ((full_outer_using(companies, facts, "k"), 60), (keep_known_keys(facts, known, "k"), 5)):
        assert len(df.collect()) == count
        assert "Broadcast" not in plan_of(df) and "SortMergeJoin" in plan_of(df)


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few thousand rows already count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_facts(spark):
    """A third of the rows share key 7, another third have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, 60_000, 1, 8).select(key.alias("k"), text.alias("text"))


def test_hot_key_is_split_in_the_full_outer_join(spark, small_partitions):
    companies = first_per_key(spark.range(30_000).selectExpr("id AS k", "id AS name"), "k")
    joined = full_outer_using(companies, hot_facts(spark), "k")
    assert joined.count() == 60_000 + 30_000 - 10_000
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_hot_key_is_split_in_the_semi_join(spark, small_partitions):
    keys = distinct_values(spark.range(30_000).selectExpr("id % 15000 AS k"), "k")
    kept = keep_known_keys(hot_facts(spark), keys, "k")
    assert len(kept.collect()) == 20_000 + 5_000
    assert "SortMergeJoin(skew=true)" in plan_of(kept)


def test_hot_code_is_split_in_the_exclusion(spark, small_partitions):
    codes = spark.range(20_000, 40_000).selectExpr("id AS c")
    kept = exclude_codes(hot_facts(spark), codes, "k")
    assert len(kept.collect()) == 20_000 + sum(i < 20_000 or i >= 40_000 for i in range(1, 60_000, 3))
    assert "SortMergeJoin(skew=true)" in plan_of(kept)
