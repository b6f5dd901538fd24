"""Generic operators on hand-made rows: NULL rules, ties, empty inputs, bands."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from roadlens.functions import any_like, measure_then_key, not_in_values, to_number
from roadlens.operators import (
    count_by,
    count_entities,
    count_rows,
    distinct_matching,
    distinct_not_matching,
    drop_matching,
    drop_not_in,
    except_rows,
    first_per_key,
    having_count,
    keep_matching,
    limit_offset,
    rank_band,
    sum_having,
    top_1_per_group,
    top_k_by_count,
    top_k_by_measure,
    top_n_filter,
)

KEY = T.StructType([T.StructField("k", T.StringType())])


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], KEY)


def test_anti_join_keeps_null_left_key(spark):
    persons = spark.createDataFrame([(None, "MALE"), ("1", "FEMALE"), ("2", "MALE")], "crash_id string, g string")
    females = persons.filter(F.col("g") == "FEMALE")
    assert rows(drop_matching(persons, females, ["crash_id"])) == [("2", "MALE"), (None, "MALE")]
    kept = distinct_not_matching(persons, ["crash_id", "g"], females, ["crash_id"])
    assert rows(kept) == [("2", "MALE"), (None, "MALE")]


def test_not_in_with_null_on_the_right_is_empty(spark):
    left = keys(spark, ["c1", "c2", "c3", "c4", "c5"])
    right = keys(spark, ["c1", None])
    assert drop_not_in(left, "k", right).count() == 0
    assert drop_matching(left, right, ["k"]).count() == 4


def test_not_in_empty_list_keeps_everything_also_null(spark):
    left = keys(spark, ["c1", None])
    assert drop_not_in(left, "k", keys(spark, [])).count() == 2


def test_not_in_drops_null_left_key_when_list_has_no_null(spark):
    left = keys(spark, ["c1", "c2", None])
    assert rows(drop_not_in(left, "k", keys(spark, ["c1"]))) == [("c2",)]


def test_not_in_agrees_with_spark_sql(spark):
    left = keys(spark, ["a", "b", None, "c"])
    for right_vals in ([], ["a"], ["a", None], [None], ["z"]):
        right = keys(spark, right_vals)
        left.createOrReplaceTempView("l_not_in")
        right.createOrReplaceTempView("r_not_in")
        want = rows(spark.sql("select k from l_not_in where k not in (select k from r_not_in)"))
        assert rows(drop_not_in(left, "k", right)) == want, right_vals


def test_semi_join_never_matches_null(spark):
    left = keys(spark, ["a", None])
    right = keys(spark, ["a", None])
    assert rows(keep_matching(left, right, ["k"])) == [("a",)]
    assert rows(distinct_matching(left, ["k"], right, ["k"])) == [("a",)]


def test_semi_plus_anti_is_everything(spark, tables_small):
    p = tables_small.primary_person
    females = p.filter(F.col("prsn_gndr_id") == "FEMALE")
    n = p.count()
    assert keep_matching(p, females, ["crash_id"]).count() + drop_matching(p, females, ["crash_id"]).count() == n


def test_count_col_against_count_star_on_null_group(spark):
    makes = keys(spark, ["A", "A", None, "B", "NA"])
    by_col = {r[0]: r[1] for r in count_by(makes, "k", "n", counted="k").collect()}
    by_star = {r[0]: r[1] for r in count_by(makes, "k", "n").collect()}
    assert by_col[None] == 0 and by_star[None] == 1


def test_not_in_values_drops_null(spark):
    makes = keys(spark, ["A", "A", None, "B", "NA"])
    assert makes.filter(not_in_values("k", ["NA"])).count() == 3


def test_null_addend_and_bad_number(spark):
    units = spark.createDataFrame(
        [("1", "A", "2", "1"), ("2", "A", "3", "0"), ("3", "B", None, "1"), ("4", "C", "x", "1")],
        "crash_id string, make string, inj string, dead string",
    )
    summed = units.groupBy("make").agg(F.sum(to_number("inj") + to_number("dead")).alias("s"))
    got = [tuple(r) for r in summed.orderBy(*measure_then_key("s", "make")).collect()]
    assert got == [("A", 6), ("B", None), ("C", None)]


def test_numbers_are_not_lost(spark):
    df = spark.createDataFrame([("6.0",), ("1e2",), ("2147483647",), ("x",), ("",), (None,)], "n string")
    assert [r[0] and int(r[0]) for r in df.select(to_number("n")).collect()] == [6, 100, 2147483647, None, None, None]
    assert int(df.agg(F.sum(to_number("n") + F.lit(1))).first()[0]) == 7 + 101 + 2147483648


def test_tie_at_the_cut_is_broken_by_name(spark):
    df = keys(spark, ["F", "E", "D", "C", "B", "A"])
    got = [r[0] for r in top_k_by_count(df, [], "k", 5).collect()]
    assert got == ["A", "B", "C", "D", "E"]


def test_null_key_sorts_last_on_ties(spark):
    df = keys(spark, [None, "B", "A"])
    got = [r[0] for r in top_k_by_count(df, [], "k", 3).collect()]
    assert got == ["A", "B", None]


def test_band_with_fewer_groups(spark):
    df = spark.createDataFrame([("A", 4), ("B", 3), ("C", 2), ("D", 1)], "make string, s long")
    got = [r[0] for r in rank_band(df, measure_then_key("s", "make"), 3, 5).collect()]
    assert got == ["C", "D"]


def test_limit_offset_is_sql_semantics(spark):
    df = spark.createDataFrame([(chr(65 + i), 10 - i) for i in range(9)], "make string, s long")
    got = [r[0] for r in limit_offset(df, measure_then_key("s", "make"), 5, 2).collect()]
    assert got == ["C", "D", "E", "F", "G"]


def test_empty_input_counts_are_one_zero_row(spark):
    empty = keys(spark, [])
    assert [tuple(r) for r in count_rows(empty, "n").collect()] == [(0,)]
    assert [tuple(r) for r in count_entities(empty, ["k"], "n").collect()] == [(0,)]
    assert having_count(empty, ["k"], 0, "n").count() == 0


def test_count_entities_counts_null_tuple(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, None)], "a string, b string")
    assert count_entities(df, ["a", "b"], "n").first()[0] == 3


def test_having_count_strict_and_inclusive(spark):
    df = keys(spark, ["a", "a", "a", "b", "b", "c"])
    assert rows(having_count(df, ["k"], 2, "n")) == [("a", 3)]
    assert rows(having_count(df, ["k"], 2, "n", inclusive=True)) == [("a", 3), ("b", 2)]


def test_sum_having_over_distinct_rows(spark):
    df = spark.createDataFrame(
        [("1", "u1", 2), ("1", "u1", 2), ("1", "u2", 1), ("2", "u1", 5), ("3", "u1", None)],
        "crash_id string, unit string, d int",
    )
    assert rows(sum_having(df, ["crash_id", "unit", "d"], "crash_id", F.col("d"), 2, "t")) == [("1", 3), ("2", 5)]


def test_top_1_per_group_ties(spark):
    df = spark.createDataFrame(
        [("SEDAN", "E2", 5), ("SEDAN", "E1", 5), ("VAN", "E3", 1), ("VAN", "E4", 2)],
        "body string, eth string, cnt long",
    )
    got = rows(top_1_per_group(df, "body", "eth", "cnt").select("body", "eth"))
    assert got == [("SEDAN", "E1"), ("VAN", "E4")]


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [("c1", "z1", "2"), ("c1", "z1", "10"), ("c1", "z2", "3"), ("c2", None, "1")],
        "crash_id string, zip string, unit string",
    )
    got = rows(first_per_key(df, ["crash_id", "zip"], [F.col("unit").asc()]))
    assert got == [("c1", "z1", "10"), ("c1", "z2", "3"), ("c2", None, "1")]


def test_top_n_filter_keeps_only_top_values(spark):
    src = keys(spark, ["a"] * 3 + ["b"] * 2 + ["c"])
    target = keys(spark, ["a", "b", "c", None])
    assert rows(top_n_filter(target, "k", src, 2)) == [("a",), ("b",)]


def test_top_k_by_measure_ascending(spark):
    df = spark.createDataFrame([("A", 3), ("B", 1), ("C", 1)], "m string, n long")
    assert [r[0] for r in top_k_by_measure(df, "n", "m", 2, ascending=True).collect()] == ["B", "C"]


def test_except_rows_is_distinct_and_null_safe(spark):
    a = keys(spark, ["a", "a", "b", None, "c"])
    b = keys(spark, ["b", None])
    assert rows(except_rows(a, b)) == [("a",), ("c",)]
    assert rows(except_rows(a, b.withColumnRenamed("k", "other"))) == [("a",), ("c",)]


def test_except_rows_is_one_exchange(spark):
    plan = except_rows(spark.range(10), spark.range(5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_any_like(spark):
    df = spark.createDataFrame([("x ALCOHOL", None), (None, None), ("NONE", "ALCOHOL")], "f1 string, f2 string")
    assert df.filter(any_like(["f1", "f2"], "%ALCOHOL%")).count() == 2
