"""Generic operators on small fixtures, against plain windows and joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenureframe import operators as op
from tenureframe.operators import intervals
from tenureframe.operators.skew import range_of, split_rows, with_range

D = dt.date
STAYS = "emp_no long, dept_no string, from_date date, to_date date, rec_id long"
ORDER = ["from_date", "rec_id"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def stays(spark):
    """Ties on a day, NULL values, a NULL date, and one key with most of the rows."""
    data = [
        (1, f"d{i % 3}" if i % 7 else None, D(2000, 1, 1) + dt.timedelta(days=i // 4), None, i)
        for i in range(200)
    ]
    data += [
        (2, "d1", D(2000, 1, 1), D(2000, 2, 1), 900),
        (2, "d1", D(2000, 2, 1), D(2000, 3, 1), 901),
        (2, "d2", D(2000, 3, 1), D(9999, 1, 1), 902),
        (3, "d1", None, None, 903),
        (3, "d2", D(2000, 1, 5), None, 904),
    ]
    return spark.createDataFrame(data, STAYS).withColumn(
        "to_date", F.coalesce("to_date", F.date_add("from_date", 1))
    )


def plain_neighbour(df, take, direction="previous"):
    step = {"previous": F.lag, "next": F.lead}[direction]
    window = Window.partitionBy("emp_no").orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])
    return df.withColumns({out: step(src).over(window) for out, src in take.items()})


@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour_equals_plain_window(stays, direction):
    take = {"other": "dept_no", "other_day": "from_date"}
    found = op.with_neighbour(stays, ["emp_no"], ORDER, take, direction)
    expected = plain_neighbour(stays, take, direction)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_neighbour_orders_by_text_and_by_one_column(spark):
    data = [(1, D(2000, 1, d), f"v{d}") for d in range(1, 20)]
    df = spark.createDataFrame(data, "emp_no long, from_date date, value string")
    for order in (["from_date", "value"], ["from_date"]):
        found = op.with_neighbour(df, ["emp_no"], order, {"p": "value"}).collect()
        assert {r["value"]: r["p"] for r in found} == {
            f"v{d}": f"v{d - 1}" if d > 1 else None for d in range(1, 20)
        }


@pytest.fixture
def many_tasks(spark):
    """As on a cluster: 32 tasks to a shuffle, and none of them merged."""
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def tasks_of(df, wanted):
    """Rows of each task among the wanted ones; the neighbour is used, or no scan is made."""
    counts = df.withColumn("task", F.spark_partition_id()).filter(wanted).groupBy("task")
    return [r["n"] for r in counts.agg(F.count("*").alias("n"), F.max("p")).collect()]


@pytest.mark.parametrize("direction", ["previous", "next"])
def test_a_hot_day_is_split_where_record_numbers_rise_with_time(spark, many_tasks, direction):
    """One employee with most rows, 2,000 a day, and record numbers in order of the days."""
    df = spark.range(60_000).select(
        F.lit(1).cast("long").alias("emp_no"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("id") / 2000).cast("int")).alias("from_date"),
        F.col("id").alias("rec_id"),
    )
    linked = op.with_neighbour(df, ["emp_no"], ORDER, {"p": "rec_id"}, direction)
    step = -1 if direction == "previous" else 1
    assert linked.filter(f"p = rec_id + {step}").count() == 59_999
    tasks = tasks_of(linked, F.col("from_date") == "2000-01-07")
    assert len(tasks) >= 8 and max(tasks) < 1000
    assert max(tasks_of(linked, F.lit(True))) < 8_000


def test_a_hot_day_is_split_by_a_text_tie_break(spark, many_tasks):
    """A third of all rows are of one employee and day; texts and times tell them apart."""
    hot = F.col("id") % 3 == 0
    df = spark.range(30_000).select(
        F.when(hot, 1).otherwise(F.col("id")).alias("emp_no"),
        F.lit("2000-01-01").cast("date").alias("from_date"),
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("mark"),
    )
    linked = op.with_neighbour(df, ["emp_no"], ["from_date", "mark"], {"p": "mark"})
    tasks = tasks_of(linked, F.col("emp_no") == 1)
    assert len(tasks) >= 8 and sum(tasks) > 9_999 and max(tasks) < 4_000
    found = linked.filter("emp_no = 1 AND p IS NOT NULL").selectExpr("int(substr(mark, 2)) - int(substr(p, 2)) AS d")
    # Numbers rise by three; 1 itself is one of the employees that have one row.
    assert {tuple(r) for r in found.groupBy("d").count().collect()} <= {(3, 9998), (1, 1), (2, 1), (3, 9999)}


def test_few_and_no_rows_have_neighbours(spark):
    df = spark.createDataFrame([(1, D(2000, 1, 1), 5), (1, D(2000, 1, 2), 6)], "emp_no long, from_date date, rec_id long")
    found = op.with_neighbour(df, ["emp_no"], ORDER, {"p": "rec_id", "q": "from_date"})
    assert rows(found) == [(1, D(2000, 1, 1), 5, None, None), (1, D(2000, 1, 2), 6, 5, D(2000, 1, 1))]
    assert op.with_neighbour(df.filter("false"), ["emp_no"], ORDER, {"p": "rec_id"}).count() == 0


def test_neighbours_are_found_in_one_shuffle_of_the_rows(stays):
    plan = op.with_neighbour(stays, ["emp_no"], ORDER, {"p": "dept_no"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_ranges_are_searched_by_compiled_steps(stays):
    plan = op.with_neighbour(stays, ["emp_no"], ORDER, {"p": "dept_no"})._jdf.queryExecution().executedPlan().toString()
    assert " aggregate(" not in plan and "(aggregate(" not in plan


@pytest.mark.parametrize("with_split", [True, False])
@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_ranges_of_rows_by_both_searches(stays, with_split, ranges):
    cuts = split_rows(stays, ["emp_no", *ORDER], ["emp_no"], ranges)
    cut = stays.withColumn("_splits", cuts)
    found = with_range(cut, "r", "_splits", ["emp_no", *ORDER], with_split, ranges)
    expected = cut.withColumn("r", range_of("_splits", ["emp_no", *ORDER], with_split, ranges))
    assert rows(found.select("rec_id", "r")) == rows(expected.select("rec_id", "r"))
    assert found.select("r").distinct().count() >= min(ranges, 2) / (1 if with_split else 2)


def test_planning_runs_no_job(spark, stays):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may run here")
    facts = stays.select("emp_no", F.col("from_date").alias("day"))
    op.with_neighbour(stays, ["emp_no"], ORDER, {"p": "dept_no"})
    op.detect_changes(stays, ["emp_no"], "dept_no", ORDER, D(2000, 1, 1), D(2000, 2, 1))
    op.join_as_of_interval(facts, stays, "emp_no", "day")
    assert tracker.getJobIdsForGroup("planning") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("only_different", [True, False])
def test_detect_changes_sees_last_row_before_period(stays, only_different):
    start, end = D(2000, 1, 20), D(2000, 2, 10)
    whole = plain_neighbour(stays, {"prev_dept_no": "dept_no"})
    wanted = whole.filter(
        F.col("from_date").between(start, end) & F.col("prev_dept_no").isNotNull()
    )
    if only_different:
        wanted = wanted.filter("dept_no <> prev_dept_no")
    found = op.detect_changes(stays, ["emp_no"], "dept_no", ORDER, start, end, only_different)
    assert rows(found) == rows(wanted)
    assert found.count() > 0


def test_detect_changes_period_look_back_is_a_subset(stays):
    span = (D(2000, 1, 20), D(2000, 2, 10))
    full = op.detect_changes(stays, ["emp_no"], "dept_no", ORDER, *span, only_different=False)
    inside = op.detect_changes(
        stays, ["emp_no"], "dept_no", ORDER, *span, only_different=False, look_back="period"
    )
    assert set(rows(inside)) < set(rows(full))


def test_detect_changes_arguments(stays):
    with pytest.raises(ValueError):
        op.detect_changes(stays, ["emp_no"], "dept_no", ORDER, start=D(2000, 1, 1))
    with pytest.raises(ValueError):
        op.detect_changes(stays, ["emp_no"], "dept_no", ORDER, look_back="none")


def plain_interval_join(facts, history, closed):
    before = F.col("day") <= F.col("to_date") if closed == "both" else F.col("day") < F.col("to_date")
    joined = facts.alias("l").join(
        history.alias("r"),
        (F.col("l.emp_no") == F.col("r.emp_no")) & (F.col("day") >= F.col("from_date")) & before,
    )
    return joined.select("l.*", *[f"r.{c}" for c in history.columns if c != "emp_no"])


@pytest.mark.parametrize("closed", ["both", "left"])
def test_interval_join_equals_plain_join(stays, closed):
    facts = stays.select("emp_no", F.col("from_date").alias("day"), F.col("rec_id").alias("fact"))
    found = op.join_as_of_interval(facts, stays, "emp_no", "day", closed)
    expected = plain_interval_join(facts, stays, closed)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)
    assert found.count() > 0


@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize("crowded", [0, 2, 3, 10_000])
def test_interval_join_of_keys_in_nodes_and_whole_ones(stays, closed, crowded):
    """Keys with 200, 3 and 2 intervals, some of them cut into nodes."""
    facts = stays.select("emp_no", F.col("from_date").alias("day"), F.col("rec_id").alias("fact"))
    facts = facts.unionByName(facts.withColumn("emp_no", F.lit(None).cast("long")).limit(3))
    found = op.join_as_of_interval(
        facts, stays, "emp_no", "day", closed, sizes_from=stays.select("emp_no"), crowded=crowded
    )
    assert rows(found) == rows(plain_interval_join(facts, stays, closed))


def test_facts_of_keys_with_few_intervals_are_not_multiplied(monkeypatch, stays):
    """Without nodes for facts, only the key with 200 intervals loses its pairs."""
    facts = stays.select("emp_no", F.col("from_date").alias("day"), F.col("rec_id").alias("fact"))
    none = F.array(F.struct(F.lit(-1).alias("_days"), F.lit(-1).cast("long").alias("_node")))
    monkeypatch.setattr(intervals, "_of_fact", lambda day: none)
    found = op.join_as_of_interval(facts, stays, "emp_no", "day")
    expected = plain_interval_join(facts, stays, "both")
    assert rows(found) == rows(expected.filter("emp_no <> 1")) and found.count() > 0


@pytest.mark.parametrize("crowded", [0, 1])
@pytest.mark.parametrize("kinds", [("int", "double"), ("double", "double"), ("decimal(9,2)", "long"), ("float", "float")])
def test_equal_keys_of_other_types_are_cut_alike(spark, kinds, crowded):
    held = spark.sql(
        "SELECT * FROM VALUES (-0D, 'a'), (0D, 'b'), (7D, 'c') AS v(emp_no, title)"
    ).selectExpr(f"CAST(emp_no AS {kinds[1]}) AS emp_no", "title", "DATE'1990-01-01' AS from_date", "DATE'1999-01-01' AS to_date")
    seen = spark.sql("SELECT * FROM VALUES (0D, 1), (-0D, 2), (7D, 3) AS v(emp_no, f)").selectExpr(
        f"CAST(emp_no AS {kinds[0]}) AS emp_no", "f", "DATE'1995-01-01' AS day"
    )
    found = op.join_as_of_interval(seen, held, "emp_no", "day", crowded=crowded)
    assert rows(found.select("f", "title")) == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "c")]


def test_interval_boundary_matches_both_or_one(spark):
    titles = spark.createDataFrame(
        [
            (1, "A", D(1990, 1, 1), D(1995, 1, 1)),
            (1, "B", D(1995, 1, 1), D(9999, 1, 1)),
        ],
        "emp_no long, title string, from_date date, to_date date",
    )
    pay = spark.createDataFrame([(1, D(1995, 1, 1))], "emp_no long, day date")

    def held(closed):
        joined = op.join_as_of_interval(pay, titles, "emp_no", "day", closed)
        return sorted(r["title"] for r in joined.collect())

    assert held("both") == ["A", "B"]
    assert held("left") == ["B"]
    with pytest.raises(ValueError):
        op.join_as_of_interval(pay, titles, "emp_no", "day", closed="right")
    with pytest.raises(TypeError):
        text_key = pay.withColumn("emp_no", F.col("emp_no").cast("string"))
        op.join_as_of_interval(text_key, titles, "emp_no", "day")
    with pytest.raises(TypeError):
        op.join_as_of_interval(pay.withColumn("day", F.lit("1995-01-01")), titles, "emp_no", "day")


# Three histories per employee cover every fact, so each fact has three matches.
def _three_each(spark, employees, last="1999-12-31"):
    return spark.range(employees * 3).select(
        (F.col("id") % employees).alias("emp_no"),
        F.concat(F.lit("t"), F.floor(F.col("id") / employees)).alias("title"),
        F.lit("1990-01-01").cast("date").alias("from_date"),
        F.lit(last).cast("date").alias("to_date"),
    )


@pytest.mark.parametrize("facts", [4000, 6000])
@pytest.mark.parametrize("kind", ["int", "long"])
def test_interval_join_over_key_types_and_sizes(spark, facts, kind):
    pay = spark.range(facts).select(
        (F.col("id") % 10).cast(kind).alias("emp_no"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("day"),
    )
    assert op.join_as_of_interval(pay, _three_each(spark, 10), "emp_no", "day").count() == 3 * facts


@pytest.mark.parametrize("facts", [4000, 6000])
def test_interval_join_over_times_of_day(spark, facts):
    hours = F.make_interval(hours=(F.col("id") % 5 * 4).cast("int"))
    pay = spark.range(facts).select(
        (F.col("id") % 10).alias("emp_no"),
        (F.lit("1995-01-01").cast("timestamp") + hours).alias("day"),
    )
    assert op.join_as_of_interval(pay, _three_each(spark, 10), "emp_no", "day").count() == 3 * facts


def test_no_days_in_the_plan_of_an_interval_join(stays):
    facts = stays.select("emp_no", F.col("from_date").alias("day"))
    plan = op.join_as_of_interval(facts, stays, "emp_no", "day")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "explode" in plan.lower()


@pytest.mark.parametrize("closed", ["both", "left"])
def test_interval_join_with_times_of_day_equals_plain_join(spark, closed):
    """Ends within a day, intervals of no length and reversed ones, long and open ones."""
    rng = random.Random(8)
    base = dt.datetime(1990, 1, 1)

    def moment():
        return base + dt.timedelta(hours=rng.randrange(24 * 900) if rng.random() < 0.9 else rng.randrange(24 * 4))

    history = [(rng.randrange(3), i, *sorted((moment(), moment()), reverse=rng.random() < 0.1)) for i in range(150)]
    history += [(0, 900, base, base), (1, 901, None, base), (1, 902, base, None), (2, 903, base, dt.datetime(9999, 1, 1))]
    facts = [(rng.choice([0, 1, 2, None]), i, moment() if i % 20 else None) for i in range(300)]
    held = spark.createDataFrame(history, "emp_no long, h long, from_date timestamp, to_date timestamp")
    seen = spark.createDataFrame(facts, "emp_no long, f long, day timestamp")
    found = op.join_as_of_interval(seen, held, "emp_no", "day", closed)
    expected = plain_interval_join(seen, held, closed)
    assert rows(found.select("f", "h")) == rows(expected.select("f", "h")) and found.count() > 1000


def test_open_intervals_without_facts_or_with_a_late_one(spark):
    history = _three_each(spark, 2000, last="9999-01-01")
    pay = spark.createDataFrame(
        [(1, D(1995, 1, 1)), (1, D(9999, 1, 1))], "emp_no long, day date"
    )
    assert op.join_as_of_interval(pay, history, "emp_no", "day").count() == 6
    none = op.join_as_of_interval(pay.filter("emp_no = 7"), history, "emp_no", "day")
    assert none.count() == 0


def test_join_distinct_counts_pairs(stays):
    facts = stays.select("emp_no", F.col("from_date").alias("day"))
    history = stays.select("emp_no", F.lit("x").alias("title"), "from_date", "to_date")
    pairs = op.join_as_of_interval(facts, history, "emp_no", "day")
    counted = op.join_distinct(facts, history, "emp_no", "day")
    expected = pairs.groupBy(*pairs.columns).agg(F.count("*").alias("n"))
    assert rows(counted.select(*expected.columns)) == rows(expected)
    assert counted.count() < pairs.count()


def test_collapse_keeps_sums(stays):
    by = ["emp_no", "from_date"]
    collapsed = op.collapse(stays, by, ["rec_id"])
    assert collapsed.count() < stays.count()
    assert collapsed.agg(F.sum("rec_id"), F.sum("n")).first() == stays.agg(
        F.sum("rec_id"), F.count("emp_no")
    ).first()


def test_latest_and_ties(spark):
    df = spark.createDataFrame(
        [
            (1, D(2000, 1, 1), 1),
            (1, D(2000, 2, 1), 2),
            (1, D(2000, 2, 1), 3),
            (2, None, 4),
            (2, D(1999, 1, 1), 5),
        ],
        "emp_no long, from_date date, rec_id long",
    )
    latest = op.latest_per_key(df, ["emp_no"], ORDER)
    assert {(r.emp_no, r.rec_id) for r in latest.collect()} == {(1, 3), (2, 5)}
    two = op.latest_per_key(df, ["emp_no"], ORDER, n=2)
    assert {r.rec_id for r in two.collect()} == {2, 3, 4, 5}
    tied = op.max_date_rows(df, ["emp_no"])
    assert {r.rec_id for r in tied.collect()} == {2, 3, 5}


def test_dedupe_does_not_depend_on_row_order(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "a", "x"), (1, "b", "y"), (None, "a", "z"), (None, "a", "y")],
        "k long, v string, w string",
    )
    for parts in (1, 3, 7):
        single = op.dedupe_by_key(df.repartition(parts), ["k"])
        assert rows(single) == [(1, "b", "y"), (None, "a", "z")]


def test_active_at_includes_both_ends(stays):
    assert op.active_at(stays.filter("emp_no = 2"), D(2000, 2, 1)).count() == 2
    assert op.active_at(stays.filter("emp_no = 2"), D(2050, 1, 1)).count() == 1


def test_shares_sum_to_hundred(stays):
    shares = op.share_within_group(stays, "emp_no", "dept_no")
    for row in shares.groupBy("emp_no").agg(F.sum("share").alias("total")).collect():
        assert row["total"] == pytest.approx(100)


def test_pivot_leaves_missing_value_null(stays):
    shares = op.share_within_group(stays, "emp_no", "dept_no")
    wide = op.pivot_values(shares, "emp_no", "dept_no", "rows", {"d1": "one", "d9": "nine"})
    assert {(r.emp_no, r.nine) for r in wide.collect()} == {(1, None), (2, None), (3, None)}


def test_first_last_in_period(stays):
    found = op.first_last_in_period(
        stays.filter("emp_no = 2"), ["emp_no"], "dept_no", ORDER, D(2000, 1, 1), D(2000, 3, 1)
    )
    assert [tuple(r) for r in found.collect()] == [(2, "d1", "d2", D(2000, 1, 1))]
