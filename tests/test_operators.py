"""Operators against brute force in plain Python, hot keys and nulls included."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mapflow.operators import joins, windows
from mapflow.operators.aggregates import last_valid_value, pivot_values
from mapflow.operators.hierarchy import roll_up
from mapflow.operators.links import propagate_over_links


def hot_rows(n=600, seed=1):
    """Rows of which a third share one key and an eighth have none."""
    pick = random.Random(seed)
    made = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 8 == 0 else f"k{pick.randrange(40)}"
        made.append((i, key, pick.randrange(20)))
    return made


def by_key(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[1]].append(row)
    return groups


def test_number_rows(spark, frame):
    data = hot_rows()
    df = frame(data, "id int, k string, v int").repartition(5)
    got = windows.number_rows(df, ["k"], [F.desc("v"), F.asc("id")], "rank")
    expected = []
    for group in by_key(data).values():
        ordered = sorted(group, key=lambda r: (-r[2], r[0]))
        expected += [(*r, i) for i, r in enumerate(ordered, 1)]
    assert sorted(map(str, rows(got))) == sorted(map(str, expected))
    assert got.columns == ["id", "k", "v", "rank"]


def test_number_rows_of_one_key_across_partitions(spark):
    """One key over many range partitions still counts from 1 without gaps."""
    df = spark.range(0, 5000, 1, 7).select(F.lit(1).alias("k"), F.col("id"))
    got = windows.number_rows(df, ["k"], [F.desc("id")], "rank")
    wrong = got.where(F.col("rank") != 5000 - F.col("id")).count()
    assert (got.count(), wrong) == (5000, 0)


@pytest.mark.parametrize("parts", [1, 9])
def test_ties_are_numbered_alike_in_any_partitioning(spark, frame, parts):
    df = frame([(i, "k", i % 2) for i in range(40)], "id int, k string, v int")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["id"]: r["rank"] for r in windows.number_rows(df.repartition(parts), ["k"], [F.asc("v")], "rank").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    hashed = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id", "k", "v").alias("h")).collect()}
    ordered = sorted(hashed, key=lambda i: (i % 2, hashed[i]))
    assert got == {i: place for place, i in enumerate(ordered, 1)}


def test_exact_median(frame):
    pick = random.Random(8)
    data = [(pick.choice(["a", "a", "b", None]), pick.choice([None, *range(200)])) for _ in range(300)]
    data += [("one", 5), ("two", 4), ("two", 9), ("none", None), ("same", 3), ("same", 3)]
    expected = {}
    for key in {k for k, _ in data}:
        values = [v for k, v in data if k == key and v is not None]
        expected[key] = statistics.median(values) if values else None
    got = windows.exact_median(frame(data, "k string, v int").repartition(5), ["k"], "v", "middle").collect()
    assert {r["k"]: r["middle"] for r in got} == expected and len(got) == len(expected)


def test_median_of_one_group_with_many_values(spark):
    df = spark.range(0, 30_001, 1, 5).select(F.lit("k").alias("k"), ((F.col("id") * 7919) % 30_001).alias("v"))
    assert [tuple(r) for r in windows.exact_median(df, ["k"], "v", "m").collect()] == [("k", 15_000.0)]
    assert [tuple(r) for r in windows.exact_median(df, [], "v", "m").collect()] == [(15_000.0,)]


def test_attach_totals_counts_null_keys_as_one_group(frame):
    data = hot_rows()
    df = frame(data, "id int, k string, v int")
    got = windows.attach_totals(df, ["k"], {"top": F.max("v"), "n": F.count(F.lit(1))})
    groups = by_key(data)
    expected = [(*r, max(x[2] for x in groups[r[1]]), len(groups[r[1]])) for r in data]
    assert rows(got) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


def test_attach_distinct_count(frame):
    data = hot_rows()
    got = windows.attach_distinct_count(frame(data, "id int, k string, v int"), ["k"], F.col("v"), "n")
    groups = by_key(data)
    assert {r["id"]: r["n"] for r in got.collect()} == {r[0]: len({x[2] for x in groups[r[1]]}) for r in data}


@pytest.mark.parametrize("n", [1, 3])
def test_keep_first(frame, n):
    data = hot_rows()
    df = frame(data, "id int, k string, v int").repartition(5)
    got = windows.keep_first(df, ["k"], [F.desc("v"), F.asc("id")], n)
    expected = set()
    for group in by_key(data).values():
        expected |= {r[0] for r in sorted(group, key=lambda r: (-r[2], r[0]))[:n]}
    # The rank limit is applied before the shuffle as well as after it.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index(", Final") < plan.index("Exchange hashpartitioning") < plan.index(", Partial")
    assert {r["id"] for r in got.collect()} == expected


@pytest.mark.parametrize("largest", [True, False])
def test_keep_extreme_keeps_ties(frame, largest):
    data = hot_rows()
    got = windows.keep_extreme(frame(data, "id int, k string, v int"), ["k"], "v", largest=largest)
    best = {k: (max if largest else min)(x[2] for x in g) for k, g in by_key(data).items()}
    assert {r["id"] for r in got.collect()} == {r[0] for r in data if r[2] == best[r[1]]}


def test_discovered_pivot_is_bounded(spark):
    spark.conf.set("spark.sql.pivotMaxValues", 5)
    try:
        with pytest.raises(ValueError, match="more than 5"):
            pivot_values(spark.range(6).selectExpr("id", "id AS v", "1 AS g"), ["g"], "v", "id")
        assert len(pivot_values(spark.range(5).selectExpr("id", "id AS v", "1 AS g"), ["g"], "v", "id").columns) == 6
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_join_contains(frame):
    pick = random.Random(5)
    word = lambda n: "".join(pick.choice("ab") for _ in range(n))
    texts = [(i, word(pick.randrange(0, 9))) for i in range(60)] + [(60, None), (61, "ab"), (62, "ab")]
    parts = [(i, word(pick.randrange(0, 5))) for i in range(25)] + [(25, None), (26, "")]
    got = joins.join_contains(frame(texts, "t int, text string"), "text", frame(parts, "p int, part string"), "part")
    expected = [
        (t, x, p, y, "EXACT" if x == y else "CONTAINS")
        for t, x in texts for p, y in parts if x is not None and y is not None and y in x
    ]
    assert sorted(map(str, rows(got))) == sorted(map(str, expected))


def test_substring_index_emits_a_row_per_character_at_most(frame):
    texts = frame([(1, "abcabcabcabc"), (2, "xyz" * 30)], "t int, text string")
    parts = frame([(1, "cabca"), (2, "zzz"), (3, "abc"), (4, "yzxyzxyzx")], "p int, part string")
    grams = joins.grams_of(texts.select(F.col("text").alias("_text")), "_text", 3)
    assert {r["_text"]: r["n"] for r in grams.groupBy("_text").agg(F.count("_gram").alias("n")).collect()} == {"abcabcabcabc": 3, "xyz" * 30: 3}
    got = joins.join_contains(texts, "text", parts, "part")
    assert sorted((r["t"], r["p"]) for r in got.collect()) == [(1, 1), (1, 3), (2, 4)]


def test_short_parts_meet_the_texts_that_contain_them_only(frame):
    texts = frame([(i, str(i)) for i in range(1, 400)], "t int, text string")
    parts = frame([(i, str(i)) for i in range(1, 40)], "p int, part string")
    got = joins.join_contains(texts, "text", parts, "part")
    expected = {(t, p) for t in range(1, 400) for p in range(1, 40) if str(p) in str(t)}
    assert {(r["t"], r["p"]) for r in got.collect()} == expected and got.count() == len(expected)
    # No text is tested against a part, as pairs by a common digit would have to be.
    assert "Contains(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_parts_of_many_lengths_meet_by_their_rarest_stretch(frame):
    pick = random.Random(8)
    word = lambda n: "".join(pick.choice("ab") for _ in range(n))
    texts = [(i, word(pick.randrange(10, 40))) for i in range(80)]
    parts = [(i, x[a : a + n]) for i, (n, (_, x)) in enumerate(zip([*range(1, 14)] * 4, texts, strict=False)) for a in [pick.randrange(0, 10)]]
    got = joins.join_contains(frame(texts, "t int, text string"), "text", frame(parts, "p int, part string"), "part")
    assert len({len(y) for _, y in parts}) > joins.WHOLE_LENGTHS
    assert sorted((r["t"], r["p"]) for r in got.collect()) == sorted((t, p) for t, x in texts for p, y in parts if y in x)


def test_links_do_not_form_pairs(frame):
    pick = random.Random(7)
    parties = [(i, pick.choice([None, None, 1, 2, 3]), pick.randrange(5)) for i in range(30)]
    links = list({(pick.randrange(30), pick.choice([0, 0, 1, 2, 3, 4])) for _ in range(90)})
    got = propagate_over_links(
        frame(parties, "id int, rating int, year int"), frame(links, "id int, item int"),
        "id", "item", "rating", F.col("rating").isNotNull(), ["year", "id"], "filled",
    )
    info = {p[0]: p for p in parties}
    expected = {}
    for pid, rating, _ in parties:
        found = []
        for item in {i for q, i in links if q == pid}:
            rated = [info[q] for q, i in links if i == item and q != pid and info[q][1] is not None]
            if rated:
                found.append(max(rated, key=lambda p: (p[2], p[0]))[1])
        expected[pid] = rating if rating is not None else max(found, default=None)
    assert {r["id"]: r["filled"] for r in got.collect()} == expected


def test_roll_up(frame):
    items = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, 99), (7, 6), (8, 7), (9, 8)]
    got = roll_up(frame(items, "item int, parent int"), "item", "parent")
    assert {r["item"]: (r["highest_existing"], r["level_text"], r["is_sub_item"]) for r in got.collect()} == {
        1: (1, "level 0 parent found", 0),
        2: (1, "level 1 parent found", 1),
        3: (1, "level 2 parent found", 1),
        4: (1, "level 3 parent found", 1),
        5: (2, "level 3 parent found", 1),
        6: (6, "level 1 parent not found", 0),
        7: (6, "level 2 parent not found", 1),
        8: (6, "level 3 parent not found", 1),
        9: (6, "level 3 parent found", 1),
    }


def test_last_valid_value(frame):
    """Performing rows keep their model; others look back; ties go to the highest id."""
    data = [
        (1, "a", "2024-01-01", "m1", True),
        (2, "a", "2024-03-01", "m2", True),
        (3, "a", "2024-03-01", "m3", True),
        (4, "a", "2024-05-01", "m4", False),
        (6, "b", "2024-01-01", "m6", False),
        (5, "b", "2024-02-01", "m5", False),
        (7, "c", "2024-01-01", None, True),
        (8, "c", "2024-02-01", "m8", False),
    ]
    df = frame(data, "id int, k string, day string, model string, ok boolean")
    got = last_valid_value(df, ["k"], "model", F.col("ok"), ["day", "id"], "id", "last")
    assert {r["id"]: r["last"] for r in got.collect()} == {
        1: "m1", 2: "m2", 3: "m3", 4: "m3", 6: "m5", 5: "m5", 7: None, 8: None,
    }


def test_key_presence_and_anti_plus_semi(frame):
    left = frame([(1,), (1,), (2,), (None,)], "k int")
    right = frame([(2,), (3,), (3,)], "k int")
    assert rows(joins.key_presence(left, right, ["k"])) == [(None, "LEFT_ONLY"), (1, "LEFT_ONLY"), (2, "BOTH"), (3, "RIGHT_ONLY")]
    halves = [left.join(right, "k", how).count() for how in ("left_semi", "left_anti")]
    assert sum(halves) == left.count()


def test_exists_and_scalar_lookups(frame):
    left = frame([(1,), (2,)], "k int")
    other = frame([(1, 5), (1, 9)], "o int, v int")
    assert rows(joins.with_flag(left, other, F.col("k"), "o", "has")) == [(1, 1), (2, 0)]
    assert rows(joins.with_lookup_max(left, other, F.col("k"), "o", {"m": F.max("v")})) == [(1, 9), (2, None)]


def test_pivot_with_quoted_values(frame):
    df = frame([(1, "it's", 3), (1, "x", 4)], "k int, p string, v int")
    assert rows(pivot_values(df, ["k"], "p", "v", {"it's": "sum", "x": "max"})) == [(1, 3, 4)]
