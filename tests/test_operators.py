"""Grouping, lookups, fill: null rules, fan-out, and equal rewrites."""

from __future__ import annotations

import random
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from closebook.functions import dates, money
from closebook.operators import calendar, dictionary, fill, grouping, lookups
from closebook.params import CloseParams

PARTS = "k string, c string, x double, y double"


def test_group_sum_drops_null_keys_and_fills_null_groups(frame, rows):
    df = frame(
        [("a", "u", 1.0, None), ("a", "u", 2.0, None), (None, "u", 5.0, 1.0), ("b", "u", None, 3.0)],
        PARTS,
    )
    assert rows(grouping.group_sum(df, ["k"], ["x", "y"])) == [("a", 3.0, 0.0), ("b", 0.0, 3.0)]
    lost = grouping.dropped_by_null_key(df, ["k"], ["x"]).first()
    assert (lost.rows_dropped, lost.x) == (1, 5.0)


def test_group_sum_required_column_counts_per_row(frame, rows):
    df = frame([("a", "u", 1.0, 0.0), ("a", None, 2.0, 0.0), ("b", None, 3.0, 0.0)], PARTS)
    assert rows(grouping.group_sum(df, ["k"], ["x"], required=["c"])) == [("a", 1.0)]


def test_null_key_rule_stays_above_the_aggregate(frame):
    df = frame([("a_b", "u", 1.0, 0.0)], PARTS).withColumn("d", F.split("k", "_")[0])
    plan = grouping.group_sum(df, ["d"], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Aggregate")
    assert "Filter" not in plan[plan.index("Aggregate"):]


def _random_book(frame, seed, size=300):
    rng = random.Random(seed)
    return frame(
        [
            (rng.choice("abcdefgh"), rng.choice("uvw"), rng.randrange(-999, 999) / 4, rng.choice([None, 1.5, -2.25]))
            for _ in range(size)
        ],
        PARTS,
    )


def test_difference_by_union_equals_full_join(frame, rows):
    a = _random_book(frame, 1).filter("k < 'f'")
    b = _random_book(frame, 2).filter("k > 'c'")
    keys = ["k", "c"]
    fast = grouping.combine_runs(a, b, keys, {"x": ("x", "x"), "z": ("y", "x")}, sign=-1)
    left = grouping.group_sum(a, keys, ["x", "y"])
    right = grouping.group_sum(b, keys, ["x"]).withColumnRenamed("x", "x2")
    slow = left.join(right, keys, "full").na.fill(0.0).select(
        *keys, (F.col("x") - F.col("x2")).alias("x"), (F.col("y") - F.col("x2")).alias("z")
    )
    assert rows(fast) == rows(slow)


def test_alignment_equals_chained_outer_joins(frame, rows):
    keys = ["k", "c"]
    a = grouping.group_sum(_random_book(frame, 3).filter("k < 'e'"), keys, ["x"])
    b = grouping.group_sum(_random_book(frame, 4).filter("k > 'b'"), keys, ["y"])
    c = grouping.group_sum(_random_book(frame, 5).filter("c = 'u'"), keys, ["x"]).withColumnRenamed("x", "w")
    fast = grouping.align([a, b, c], keys, ["x", "y", "w"])
    slow = a.join(b, keys, "full").join(c, keys, "full").na.fill(0.0)
    assert rows(fast) == rows(slow.select(*keys, "x", "y", "w"))
    before = sum(p.agg(F.sum(m)).first()[0] for p, m in ((a, "x"), (b, "y"), (c, "w")))
    after = grouping.with_total(fast, ["x", "y", "w"]).agg(F.sum("total_balance")).first()[0]
    assert before == after


def test_fill_and_union(frame, rows):
    df = frame([(None, None, None, 2.0)], PARTS)
    assert rows(grouping.fill_missing(df, ["x"], ["k"])) == [("0", None, 0.0, 2.0)]
    short = frame([("a",)], "k string")
    assert rows(grouping.union_books([df.select("k", "x"), short])) == [("a", None), (None, None)]
    assert grouping.distinct_pairs(_random_book(frame, 1), ["k", "c"]).count() == 24


def test_reconcile_keeps_both_sides(frame, rows):
    a = frame([("1", "u", 2.0, 0.0), ("1", "u", 3.0, 0.0), ("2", "u", 1.0, 0.0)], PARTS)
    b = frame([("1", "u", 5.0, 0.0), ("3", "u", 7.0, 0.0)], PARTS)
    assert rows(grouping.reconcile(a, b, ["k"], "x")) == [("1", 5.0, 5.0), ("2", 1.0, None), ("3", None, 7.0)]


def test_lookup_fans_out_and_keeps_unmatched(frame, rows):
    df = frame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = frame([("a", "X"), ("a", "Y"), (None, "N")], "k string, account string")
    assert rows(lookups.left_lookup(df, dim, ["k"])) == [
        ("a", 1, "X"), ("a", 1, "Y"), ("b", 2, None), (None, 3, None),
    ]


def test_checked_lookup_stops_at_a_second_row(spark, frame, rows):
    df = frame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = frame([("a", 7, "X"), (None, 1, "N"), (None, 2, "M"), ("c", None, None)], "k string, n int, account string")
    lazy = lookups.checked(dim, ["k"])
    assert rows(lookups.left_lookup(df, lazy, ["k"])) == [("a", 1, 7, "X"), ("b", 2, None, None), (None, 3, None, None)]
    twice = dim.union(frame([("a", 8, "Y")], "k string, n int, account string"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "checked")
    joined = lookups.left_lookup(df, lookups.checked(twice, ["k"]), ["k"])
    assert list(tracker.getJobIdsForGroup("checked")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="two rows for the lookup key a"):
        joined.collect()


def test_membership(frame, rows):
    df = frame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    members = frame([("a",), ("a",), (None,)], "k string")
    tagged = lookups.tag_members(df, members, "k")
    assert rows(tagged) == [("a", 1, "old"), ("b", 2, "new"), (None, 3, "new")]
    mapped = lookups.map_values(df, "k", {"a": "Q1"})
    assert rows(mapped) == [("Q1", 1), ("b", 2), (None, 3)]


def test_large_dimension_joins_the_same_without_broadcast(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
        dim = spark.range(500).selectExpr("id AS k", "id * 2 AS d")
        joined = lookups.left_lookup(df, dim, ["k"])
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
        assert joined.filter("k < 500 AND d <> 2 * k OR k >= 500 AND d IS NOT NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _python_fill(data, part):
    last, out = {}, {}
    for key, group, value in sorted(data, key=lambda r: r[0]):
        slot = group if part else 0
        last[slot] = value if value is not None else last.get(slot)
        out[key] = last[slot]
    return out


@pytest.mark.parametrize("part", [False, True])
@pytest.mark.parametrize("slices", [1, 7, 50])
def test_forward_fill(frame, part, slices):
    rng = random.Random(slices)
    data = [
        (i * 3, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, None, None, "x", "y", "z"]))
        for i in range(400)
    ]
    shuffled = list(data)
    rng.shuffle(shuffled)
    df = frame(shuffled, "o long, g string, v string")
    filled = fill.forward_fill(df, "o", ["v"], ["g"] if part else [], slices=slices)
    assert {r.o: r.v for r in filled.collect()} == _python_fill(data, part)
    assert filled.columns == df.columns


def test_forward_fill_over_dates_and_empty(frame):
    df = frame([], "o date, v string")
    assert fill.forward_fill(df, "o", ["v"]).count() == 0
    df = frame([("2022-01-01", "a"), ("2022-01-03", None)], "t string, v string")
    df = df.select(F.to_date("t").alias("o"), "v")
    assert [r.v for r in fill.forward_fill(df, "o", ["v"]).orderBy("o").collect()] == ["a", "a"]


def test_forward_fill_over_more_than_a_thousand_slices(frame):
    data = [(i, "b" if i % 2 else None, "x" if i % 700 == 3 else None) for i in range(2600)]
    df = frame(data, "o long, g string, v string")
    sliced = fill.with_slices(df, "o", slices=1300)
    assert sliced.select("_slice").distinct().count() > 1000
    both = fill.fill_slices(fill.fill_slices(sliced, "o", ["v"]), "o", ["g"])
    assert {r.o: r.v for r in both.collect()} == _python_fill(data, False)


def test_slices_follow_the_row_count(frame, monkeypatch):
    monkeypatch.setattr(fill, "SLICE_ROWS", 10)
    sliced = fill.with_slices(frame([(i,) for i in range(95)], "o long"), "o")
    assert sliced.select("_slice").distinct().count() == 10


# Id dictionary


def _marked(df):
    return df.withColumn("parsed", F.concat(F.lit("p"), F.col("k")))


def test_ids_are_reduced_before_they_are_parsed(frame, rows):
    df = frame([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0), ("a", 3.0)], "k string, x double")
    assert rows(dictionary.once(df, ["k"], ["x"])) == [("a", 3, 6.0), ("b", 1, None), (None, 1, 4.0)]
    assert rows(dictionary.id_dictionary(df, "k", _marked)) == [("a", "pa"), ("b", "pb")]
    joined = dictionary.with_parsed(df, "k", _marked)
    assert rows(joined) == [("a", 1.0, "pa"), ("a", 2.0, "pa"), ("a", 3.0, "pa"), ("b", None, "pb"), (None, 4.0, None)]
    assert dictionary.id_dictionary(df.filter("false"), "k", _marked).count() == 0


def test_conditions_on_parsed_ids_stay_above_the_sum(frame):
    df = frame([("a_b", 1.0)], "k string, x double")
    listed = dictionary.once(df, ["k"]).withColumn("part", F.substring_index("k", "_", 1)).filter("part = 'a'")
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Aggregate") and plan.count("substring_index") == 2
    assert "substring_index" not in plan[plan.index("Aggregate"):]


# Exact sums and grouping sets


def test_exact_sums_do_not_depend_on_the_partitioning(spark, frame):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 13) for _ in range(3000)]
    values += [1e15, 0.1, -1e15, 0.2, -0.0, 123456789.015625, -7.0]
    df = frame([(i % 5, v) for i, v in enumerate(values)] + [(9, None)], "k int, x double")
    seen = set()
    for parts in (1, 3, 40):
        dealt = df.repartition(parts, F.xxhash64("x", F.lit(parts)))
        found = dealt.groupBy("k").agg(money.exact_sum(F.col("x")).alias("x")).collect()
        total = grouping.control_total(dealt, ["x"]).first()["x"]
        seen.add((tuple(sorted((r["k"], None if r["x"] is None else r["x"].hex()) for r in found)), total.hex()))
    assert len(seen) == 1
    (groups, total), = seen
    assert dict(groups)[9] is None
    exact = sum(map(Fraction, values))
    assert abs(Fraction(float.fromhex(total)) - exact) <= Fraction(len(values), 2**52) + abs(exact) * Fraction(1, 2**52)


def test_exact_sums_of_large_amounts_are_the_nearest_double(frame):
    values = [1e15, 0.5, -1e15, 0.25, 2.0**52 + 1, 3.0]
    df = frame([(v,) for v in values], "x double")
    assert df.agg(money.exact_sum(F.col("x"))).first()[0] == 2.0**52 + 4.75
    assert frame([], "x double").agg(money.exact_sum(F.col("x"))).first()[0] is None


def test_grouping_sets_equal_separate_sums(frame, rows):
    book = _random_book(frame, 6).unionByName(frame([(None, "u", 1.0, 1.0), ("a", None, 2.0, 2.0)], PARTS))
    found = grouping.group_sum_sets(book, {"by_k": ["k"], "both": ["k", "c"], "by_c": ["c"]}, ["x", "y"])
    assert found.columns == ["grain", "k", "c", "x", "y"]
    for grain, keys in (("by_k", ["k"]), ("both", ["k", "c"]), ("by_c", ["c"])):
        own = found.filter(F.col("grain") == grain).select(*keys, "x", "y")
        assert rows(own) == rows(grouping.group_sum(book, keys, ["x", "y"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# Calendar


def test_calendar_equals_the_date_rules(spark):
    params = CloseParams(calendar_years=(2019, 2024))
    table = calendar.calendar(spark, params)
    days = table.withColumn("day", dates.from_int(F.col("ymd")))
    wrong = days.filter(
        (F.col("month_end") != dates.align_month_end(F.col("day")))
        | (F.col("year") != F.year("month_end"))
        | (F.col("by_window") != dates.bucket_by_window(F.col("ymd"), params))
        | (F.col("by_year") != dates.bucket_by_year(F.col("ymd"), params))
    )
    assert wrong.count() == 0 and table.count() == 6 * 365 + 2 + 1
    last = table.filter("ymd = 99991231").first()
    assert (last["year"], last["by_window"]) == (9999, params.future_label)


def test_days_outside_the_calendar_are_errors(frame, rows):
    params = CloseParams(calendar_years=(2021, 2022))
    df = frame([(20220215, 1), (None, 2), (99991231, 3)], "d int, v int")
    found = calendar.look_up(df, "d", {"end": calendar.MONTH_END, "label": calendar.BY_WINDOW}, params)
    assert [(r["v"], str(r["end"]), r["label"]) for r in found.orderBy("v").collect()] == [
        (1, "2022-01-31", "Q1"), (2, "None", None), (3, "9999-12-31", params.future_label),
    ]
    for day in (20230101, 20220230, 0):
        odd = calendar.look_up(frame([(day,)], "d int"), "d", {"end": calendar.MONTH_END}, params)
        with pytest.raises(Exception, match="d is no day of the calendar"):
            odd.collect()


# Forward fill with ties


@pytest.mark.parametrize("seed", range(4))
def test_fill_over_a_composite_order_equals_pandas(frame, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), i, rng.choice("ab"), rng.choice([None, None, float(i)]), rng.choice([None, f"v{i}"]))
        for i in range(150)
    ]
    rng.shuffle(rows)
    df = frame(rows, "day int, n int, grp string, x double, label string")
    table = pd.DataFrame(rows, columns=["day", "n", "grp", "x", "label"]).sort_values(["day", "n"], na_position="first")
    whole = table.assign(label=table["label"].ffill(), x=table["x"].ffill())
    within = table.assign(**{c: table.groupby("grp")[c].ffill() for c in ("x", "label")})
    for want, groups in ((whole, ()), (within, ("grp",))):
        want = {r.n: (None if pd.isna(r.x) else r.x, None if pd.isna(r.label) else r.label) for r in want.itertuples()}
        for slices in (None, 1, 7):
            got = fill.forward_fill(df, ["day", "n"], ["x", "label"], groups, slices)
            assert got.columns == df.columns
            assert {r["n"]: (r["x"], r["label"]) for r in got.collect()} == want


def test_a_fill_works_its_input_out_once(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def noted(n):
        seen.add(1)
        return n

    df = spark.range(300).withColumn("x", F.udf(noted, "int")(F.col("id").cast("int")))
    assert fill.forward_fill(df, "id", ["x"]).count() == 300 and seen.value == 300
