from __future__ import annotations

import random
from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import linking, measures, quality, reconcile
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.quality import Rule
from tidemark.operators.skew import dealt, heat, hot_keys, link, pieces_of

START = datetime(2026, 8, 1)


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


# --- hot keys -------------------------------------------------------------------------


def uneven(seed: int, n: int = 600) -> list[tuple]:
    """A third of the rows share one key, half of those are identical."""
    rng = random.Random(seed)
    facts = [(rng.randrange(40), rng.randrange(1000)) for _ in range(2 * n // 3)]
    facts += [(7, 1) if i % 2 else (7, i) for i in range(n // 3)]
    rng.shuffle(facts)
    return facts


def test_hot_keys_are_found_and_bounded(frame):
    df = frame("k int, v int", *uneven(1))
    assert hot_keys(df, ["k"], hot_rows=10_000) == []
    hot = hot_keys(df, ["k"], hot_rows=100, hot_share=8)
    assert hot == [df.select(F.xxhash64(F.lit(7))).first()[0]]
    assert hot_keys(df.limit(0), ["k"], hot_rows=0) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("repeated_parent", [False, True])
def test_hot_links_equal_plain_joins(frame, how, repeated_parent):
    facts = frame("k int, v int", *uneven(2)).repartition(5)
    known = [(k, f"p{k}") for k in range(0, 30)] + ([(7, "again")] if repeated_parent else [])
    parents = frame("k int, name string", *known)
    hot = hot_keys(facts, ["k"], hot_rows=5)
    assert len(hot) > 1
    got, plain = link(facts, parents, "k", how, hot), facts.join(parents, "k", how)
    assert got.columns == plain.columns
    assert rows(got, *plain.columns) == rows(plain, *plain.columns)


def test_hot_rows_are_dealt_over_many_tasks(spark, frame):
    facts = spark.range(0, 80_000, 1, 16).selectExpr("int(if(id >= 0, 7, id)) AS k", "id")
    parents = frame("k int, name string", (7, "seven"), (8, "eight"))
    hot = hot_keys(facts, ["k"], hot_rows=10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = link(facts, parents.hint("merge"), "k", "inner", hot)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) > 1 and sum(row["count"] for row in per_task) == 80_000


# --- sequences ------------------------------------------------------------------------


def stays(seed: int, n: int = 500) -> list[tuple]:
    rng = random.Random(seed)
    made = []
    for i in range(n):
        patient = "busy" if i % 3 == 0 else f"p{rng.randrange(60)}"
        made.append((f"s{i:04d}", patient, START + timedelta(minutes=rng.randrange(0, 6000))))
    return made


def brute_next(made):
    expected = {}
    for patient in {p for _, p, _ in made}:
        own = sorted((at, stay) for stay, p, at in made if p == patient)
        for (_, stay), following in zip(own, [*own[1:], (None, None)], strict=True):
            expected[stay] = following[0]
    return expected


@pytest.mark.parametrize("seed", [3, 4])
def test_next_event_with_and_without_hot_keys(frame, seed):
    made = stays(seed)
    df = frame("stay string, patient string, at timestamp", *made)
    expected = brute_next(made)
    for hot in ([], hot_keys(df, ["patient"], hot_rows=5), hot_keys(df, ["patient"], hot_rows=100)):
        ahead = measures.next_event(df, "patient", "at", "stay", "following", hot)
        assert {row.stay: row.following for row in ahead.collect()} == expected


def test_return_window_is_inclusive(frame):
    end = datetime(2026, 8, 1, 15)
    following = [end - timedelta(hours=10), end + timedelta(days=30), end + timedelta(days=31), None]
    df = frame("e timestamp, f timestamp", *[(end, f) for f in following])
    within = measures.followed_within(F.col("e"), F.col("f"), 30)
    assert [row[0] for row in df.select(within).collect()] == [True, True, False, False]


# --- groups ---------------------------------------------------------------------------


def test_small_cohorts_are_masked(frame):
    df = frame(
        "code string, patient string",
        *[("four", f"p{i}") for i in range(4)],
        *[("five", f"p{i}") for i in range(5)],
        *[("repeated", "p1") for _ in range(5)],
    )
    kept = measures.k_anonymous(df, ["code"], "patient", "n", 5)
    assert rows(kept, "code", "n") == [("five", 5)]


def test_shares_add_up(frame):
    df = frame("g string, n bigint", ("a", 1), ("b", 2), ("c", 5))
    shares = measures.share_of_total(df, "n", "pct")
    assert rows(shares, "g", "pct") == [("a", 12.5), ("b", 25.0), ("c", 62.5)]


def test_latest_known_value_of_each_column(frame):
    df = frame(
        "k string, v date, seq int, year int, region string",
        ("a", START.date(), 1, 1990, "33"),
        ("a", START.date() + timedelta(days=1), 1, 1991, "75"),
        ("a", START.date() + timedelta(days=2), 1, None, "13"),
        ("b", START.date(), 1, None, "1"),
        ("b", START.date(), 2, None, "2"),
    )
    newest = latest_per_key(df, "k", ["v", "seq"], ["year", "region"])
    assert rows(newest, "k", "year", "region") == [("a", 1991, "13"), ("b", None, "2")]


def test_top_rows(frame):
    df = frame("k int, n int", (1, 5), (2, 9), (3, 5), (4, 1))
    assert [row.k for row in measures.top(df, 3, F.desc("n"), "k").collect()] == [2, 1, 3]


# --- references -----------------------------------------------------------------------


def test_gaps_are_kept_and_flagged(frame):
    listed = frame("code string, label string", ("A", "a"), ("N", "n"))
    described = frame("code string, kind string, beds int", ("A", "med", 30), ("Z", "none", 1))
    full = linking.enrich_with_gaps(listed, described, "code", ["kind"], ["beds"], "is_described", "?")
    assert rows(full, "code", "label", "kind", "beds", "is_described") == [
        ("A", "a", "med", 30, 1),
        ("N", "n", "?", None, 0),
    ]


def test_unknown_keys_despite_nulls_in_the_reference(frame):
    facts = frame("code string", ("A",), ("B",), (None,))
    reference = frame("code string", ("A",), (None,))
    assert rows(linking.only_known(facts, reference, "code"), "code") == [("A",)]
    assert rows(linking.only_unknown(facts, reference, "code"), "code") == [("B",), (None,)]


def test_marking_never_multiplies_rows(frame):
    facts = frame("code string, n int", ("A", 1), ("A", 2), ("B", 3))
    reference = frame("code string", ("A",), ("A",))
    marked = linking.mark_known(facts, reference, "code", "known")
    assert rows(marked, "n", "known") == [(1, True), (2, True), (3, False)]


def test_observed_codes(frame):
    reference = frame("code string, label string", ("A", "a"), ("B", "b"))
    facts = frame("code string", ("A",), ("A",), ("C",))
    assert rows(linking.observed_codes(reference, facts, "code"), "code", "label") == [("A", "a")]


# --- rules and checks -----------------------------------------------------------------


def test_overlapping_rules_in_one_pass(frame):
    df = frame("id string, a int, b int", ("ok", 1, 1), ("both", -1, -1), ("traced", 1, -1), ("nulls", None, None))
    rules = [
        Rule("a_negative", F.col("a") < 0, F.col("a").cast("string")),
        Rule("b_negative", F.col("b") < 0, F.lit(None).cast("string"), drops=False),
    ]
    assert rows(quality.kept(df, rules), "id") == [("nulls",), ("ok",), ("traced",)]
    entries = quality.rejects(df, rules, "src", F.col("id"), START)
    assert entries.columns == list(quality.JOURNAL)
    assert rows(entries, "natural_key", "rule", "detail") == [
        ("both", "a_negative", "-1"),
        ("both", "b_negative", ""),
        ("traced", "b_negative", ""),
    ]
    counted = quality.summary(quality.journal([entries, entries]))
    assert [(r.rule, r.n) for r in counted.collect()] == [("b_negative", 4), ("a_negative", 2)]


def test_scalar_mismatch(frame):
    three, two = frame("a bigint", (3,)), frame("b bigint", (2,))
    assert rows(reconcile.scalar_mismatch(three, two), "a", "b") == [(3, 2)]
    assert reconcile.scalar_mismatch(three, frame("b bigint", (3,))).count() == 0


def test_a_missing_expected_value_is_a_violation(frame):
    expected = frame("key string, wanted double, tol double", ("a", 1.0, 0.1), ("b", 1.0, 0.1), ("c", 1.0, 0.1))
    actual = frame("key string, value double", ("a", 1.05), ("b", 1.5))
    off = reconcile.expected_mismatch(expected, actual, "key", "tol", "value", "wanted")
    assert rows(off, "key", "value") == [("b", 1.5), ("c", None)]


def test_verify_raises_with_samples(frame):
    good, bad = frame("x int").limit(0), frame("x int", (41,), (42,))
    assert Counter(r.n_violations for r in reconcile.verify({"good": good}).collect()) == {0: 1}
    with pytest.raises(reconcile.VerificationError, match="bad.*41"):
        reconcile.verify({"good": good, "bad": bad})


# --- skew -----------------------------------------------------------------------------


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def rows_per_task(df):
    return sorted(row["count"] for row in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.mark.parametrize("setting", ["spark__sql__adaptive__enabled", "spark__sql__adaptive__coalescePartitions__enabled"])
def test_heat_with_empty_partitions(spark, setting):
    df = spark.range(40_000, numPartitions=5).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    with settings(spark, **{setting: "false", "spark__sql__shuffle__partitions": "72"}):
        found = heat(df, ["k"], hot_rows=1000)
        assert list(found.values()) == [64] and heat(df.limit(0), ["k"], hot_rows=0) == {}
        assert heat(df, ["k"], hot_rows=10_000) == {next(iter(found)): 8}


@pytest.mark.parametrize("identical", [False, True])
def test_hot_rows_that_lie_together_are_dealt_evenly(spark, identical):
    """After a shuffle on the join key all rows of a hot key are in one input partition."""
    plain = {f"spark__sql__adaptive__{name}__enabled": "false" for name in ("skewJoin", "coalescePartitions")}
    number = "CAST(0 AS bigint)" if identical else "id"
    with settings(spark, **plain, spark__sql__shuffle__partitions="16", spark__sql__autoBroadcastJoinThreshold="-1"):
        facts = spark.range(400_000).selectExpr("if(id % 5 > 0, 7, id) AS k", f"{number} AS n").repartition(16, "k")
        parents = spark.range(400_000).withColumnRenamed("id", "k")
        joined = link(facts, parents, "k", "inner", heat(facts, ["k"], hot_rows=1000))
        sizes = rows_per_task(joined)
    assert sum(sizes) == 400_000 and len(sizes) == 16 and sizes[-1] < 60_000


def test_rows_are_dealt_alike_whatever_their_order(spark):
    rows = [(7, n % 50) for n in range(1000)] + [(n, n) for n in range(100, 200)]

    def pieces(order):
        df = spark.createDataFrame(order, "k int, v int").coalesce(1)
        return sorted(map(tuple, dealt(df, pieces_of(["k"], {key: 8}), "piece").collect()))

    key = spark.sql("SELECT xxhash64(7) AS h").first().h
    assert pieces(rows) == pieces(random.Random(1).sample(rows, len(rows)))


def test_marks_can_be_split(spark):
    split = {"skewedPartitionThresholdInBytes": "1k", "skewedPartitionFactor": "1.2"}
    values = {f"spark__sql__adaptive__skewJoin__{name}": value for name, value in split.items()}
    values |= {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold": "0"}
    with settings(spark, **values, spark__sql__adaptive__advisoryPartitionSizeInBytes="4k", spark__sql__shuffle__partitions="8"):
        facts = spark.range(0, 60_000, 1, 6).selectExpr("if(id % 5 > 0, 7, id) AS k", "id AS n")
        reference = spark.range(0, 60_000, 10, 2).selectExpr("id AS k").union(spark.range(5).selectExpr("id AS k"))
        marked = linking.mark_known(facts, reference, "k", "known")
        assert marked.groupBy("known").count().collect()
        marked.write.format("noop").mode("overwrite").save()
        marked.collect()
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("identical", [False, True])
def test_pieces_of_one_key_are_even_and_in_order(spark, identical):
    """Rows that agree in everything, all in one input partition, still become many tasks."""
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="16"):
        number = "0" if identical else "id % 1000"
        rows = spark.range(200_000).selectExpr("'p' AS patient", f"timestamp_seconds({number}) AS at", f"{number} AS stay")
        pieces = measures.ordered_pieces(rows.repartition(16, "patient"), ["patient", "at", "stay"])
        sizes = [(row.n, row.low, row.high) for row in pieces.groupBy("_piece").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("_piece").collect()]
        assert len(sizes) == 16 and max(n for n, _, _ in sizes) < 20_000
        assert all(one[2] <= other[1] for one, other in zip(sizes, sizes[1:], strict=False))
        key = spark.sql("SELECT xxhash64('p') AS h").first().h
        ahead = measures.next_event(rows, "patient", "at", "stay", "following", [key])
        plain = measures.next_event(rows, "patient", "at", "stay", "following", [])
        counted = [sorted(map(tuple, df.groupBy("at", "following").count().collect()), key=repr) for df in (ahead, plain)]
    assert counted[0] == counted[1]
