import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators.binding import bind
from opinara.operators.dedupe import first_n
from opinara.operators.gather import grouped_text, term_counts
from opinara.operators.keys import add_dense_key, highest_keys, insert_or_ignore
from opinara.operators.lineage import checkpoint_folder, stored
from opinara.operators.places import add_places, ordered_text
from opinara.operators.lookup import hot_keys, lookup, which_are_small
from opinara.operators.statistics import exact_percentiles


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_paths_agree_on_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                    .otherwise(F.col("id").cast("string")).alias("k"))
    table = rows.select("k").distinct().filter("k is null or k not in ('5', '11')").withColumn("v", F.length(F.coalesce("k", F.lit(""))))
    small = lookup(rows, table, {"k": "k"}, ["id"])
    salted = lookup(rows, table, {"k": "k"}, ["id"], max_rows=10)
    assert "BroadcastHashJoin" in plan(small)
    assert small.columns == salted.columns == ["id", "k", "v"]
    assert sorted(small.collect(), key=lambda r: r.id) == sorted(salted.collect(), key=lambda r: r.id)
    assert small.count() == 3000 and small.filter("v is null").count() == 2
    assert which_are_small({"a": table, "b": table.limit(0)}, 10) == {"a": False, "b": True}
    split = lookup(rows, table, {"k": "k"}, ["id"], max_rows=10, hot_rows=400, salts=8)
    assert sorted(small.collect(), key=lambda r: r.id) == sorted(split.collect(), key=lambda r: r.id)


def test_only_hot_keys_are_repeated(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in hot_keys(rows, ["k"], 900).collect()] == [-1]
    table = rows.select("k").distinct()
    joined = lookup(rows, table, {"k": "k"}, ["id"], max_rows=10, hot_rows=900, salts=8)
    joined.collect()
    shown = [line for line in plan(joined).splitlines() if "Exchange hashpartitioning" in line and "_salt_of_key" in line]
    assert shown and joined.count() == 4000
    assert table.join(hot_keys(rows, ["k"], 900), "k", "left_anti").count() == table.count() - 1


def test_size_check_sees_arrays(spark):
    wide = spark.range(9).select("id", F.expr("array_repeat('x' || id, 2000000)").alias("words"))
    assert which_are_small({"wide": wide, "narrow": wide.select("id")}) == {"wide": False, "narrow": True}


def test_first_n_trims_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id").repartition(4)
    top = first_n(df, ["g"], ["id"], 5)
    assert plan(top).count("WindowGroupLimit") == 2
    assert sorted(r.id for r in top.collect()) == list(range(15))


def test_dense_keys(spark):
    df = spark.createDataFrame([(f"n{i % 50}", None if i % 5 == 0 else i % 7) for i in range(400)], "a string, b int").distinct()
    keyed = add_dense_key(df, ["a", "b"], "k")
    again = add_dense_key(df.repartition(3), ["a", "b"], "k")
    rows = {(r.a, r.b): r.k for r in keyed.collect()}
    assert sorted(rows.values()) == list(range(1, len(rows) + 1))
    assert rows == {(r.a, r.b): r.k for r in again.collect()}


def test_insert_or_ignore(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    new = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    once = insert_or_ignore(old, new, ["name"])
    assert sorted((str(r.id), str(r.name)) for r in insert_or_ignore(once, new, ["name"]).collect()) == [
        ("1", "a"), ("2", "None"), ("None", "b"),
    ]


def test_insert_or_ignore_with_repeats_in_a_batch(spark):
    old = spark.createDataFrame([(1, "a", 0)], "id long, name string, n int")
    new = spark.createDataFrame([("b", 5), ("b", 3), ("a", 1), (None, 2), (None, 1), ("c", 4)], "name string, n int")
    first = {r.name: r.n for r in insert_or_ignore(old, new, ["name"]).collect()}
    assert first == {"a": 0, "b": 3, "c": 4, None: 1}
    last = insert_or_ignore(old, new.withColumn("turn", -F.col("n")), ["name"], order=["turn"]).collect()
    assert {r.name: r.n for r in last} == {"a": 0, "b": 5, "c": 4, None: 2} and len(last) == 4


def test_keys_continue(spark):
    """Members keep their keys through three batches; a key that was given once is not given again."""
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    none = spark.createDataFrame([], "id long, name string")
    first = {r.name: r.id for r in insert_or_ignore(none, frame(["a", "b", None, "b"]), ["name"], key="id").collect()}
    assert sorted(first.values()) == [1, 2, 3] and set(first) == {"a", "b", None}
    table = spark.createDataFrame([(i, n) for n, i in first.items()], "id long, name string")
    names = ["b", "c", None, "d", "c", "e"]
    second = insert_or_ignore(table, frame(names).repartition(3), ["name"], key="id")
    rows = {r.name: r.id for r in second.collect()}
    assert {n: rows[n] for n in first} == first and sorted(rows[n] for n in "cde") == [4, 5, 6]
    assert rows == {r.name: r.id for r in insert_or_ignore(table, frame(names[::-1]), ["name"], key="id").collect()}
    # the member with the largest key goes, and another one comes
    highest = highest_keys({"t": (second, "id")})
    left = second.filter("id < 5 or id is null")
    again = insert_or_ignore(left, frame(["f"]), ["name"], key="id", highest=highest.head().highest)
    assert {r.name: r.id for r in again.collect()}["f"] == 7
    assert highest_keys({"t": (left, "id"), "u": (none, "id")}, highest).orderBy("table_name").collect() == [("t", 6), ("u", 0)]
    # columns that the new rows don't have are null, a key they bring is not used
    wide = spark.createDataFrame([(9, "z", "kept")], "id long, name string, note string")
    more = insert_or_ignore(wide, spark.createDataFrame([(1, "y")], "id long, name string"), ["name"], key="id")
    assert sorted(tuple(r) for r in more.collect()) == [(9, "z", "kept"), (10, "y", None)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_grouped_text_is_whole_and_ordered(spark, partitions):
    rows = [(i, "x" if i % 3 else None, f"t{i}") for i in range(100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "seq long, g string, t string").repartition(partitions)
    pieces = grouped_text(df, ["g"], "t", "seq", 7)
    for g in ("x", None):
        texts = [r.combined_text for r in pieces.filter(F.col("g").eqNullSafe(g)).orderBy("piece").collect()]
        assert " ".join(texts) == " ".join(t for s, k, t in sorted(rows) if k == g)
    assert max(len(r.combined_text.split()) for r in pieces.collect()) <= 7
    counts = {(r.g, r.term): r.term_count for r in term_counts(df.withColumn("t", F.lit("A a b")), ["g"], "t").collect()}
    assert counts[("x", "a")] == 2 * 66 and counts[(None, "b")] == 34


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(3)
    data = {"a": np.round(rng.uniform(-1, 1, 501), 3), "b": np.zeros(40), "c": np.array([5.0, -7.0, 0.1]), None: np.array([0.2])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    points = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    for r in exact_percentiles(df, "g", "v", points).collect():
        assert r.value == pytest.approx(np.quantile(data[r.g], r.point))
    assert exact_percentiles(df, "g", "v", points).count() == 4 * len(points)


def test_bound_columns_are_not_copied_into_filters(spark):
    df = spark.range(10).withColumn("x", F.sha2(F.col("id").cast("string"), 256))
    free = df.filter(F.length("x") > 3).select("x")
    bound = bind(df, "x").filter(F.length("x") > 3).select("x")
    assert plan(free).count("sha2(") == 2 and plan(bound).count("sha2(") == 1
    assert sorted(free.collect()) == sorted(bound.collect())


@pytest.mark.parametrize("partitions", [1, 7])
def test_places(spark, partitions):
    rng = random.Random(6)
    rows = [(i, None if i % 9 == 0 else rng.randint(0, 20)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, n int").repartition(partitions)
    found = add_places(df, [F.col("n").desc_nulls_last(), F.col("id")])
    assert found.columns == ["id", "n", "place"]
    wanted = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r.id, r.n) for r in sorted(found.collect(), key=lambda r: r.place)] == wanted
    assert sorted(r.place for r in found.collect()) == list(range(1, 501))
    assert add_places(df.limit(0), [F.col("id")]).collect() == []


@pytest.mark.parametrize("rows_per_piece, bytes_per_piece", [(7, 1 << 20), (1000, 60), (5, 40)])
def test_ordered_text(spark, rows_per_piece, bytes_per_piece):
    """Text ordered by text, with a group of most rows, a long text and a missing one."""
    rows = [(f"r-{i:03d}", "x" if i % 5 else None, "é" * 100 if i == 33 else None if i == 34 else f"t{i}") for i in range(200)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "review_id string, g string, t string").repartition(4)
    found = ordered_text(df, ["g"], "t", ["review_id"], rows_per_piece, bytes_per_piece).collect()
    for g in ("x", None):
        mine = sorted((r for r in found if r.g == g), key=lambda r: r.piece)
        assert " ".join(r.combined_text for r in mine) == " ".join(t for _, k, t in sorted(rows, key=lambda r: r[0]) if k == g and t)
        assert sum(r.n_texts for r in mine) == sum(k == g and t is not None for _, k, t in rows)
    assert max(r.n_texts for r in found) <= rows_per_piece
    assert all(len(r.combined_text.encode()) <= bytes_per_piece + 201 for r in found)


def _kept_bytes(spark) -> int:
    return sum(f.stat().st_size for f in Path(checkpoint_folder(spark).removeprefix("file:")).rglob("*") if f.is_file())


def test_places_are_kept_in_few_bytes(spark):
    text = F.concat(F.lit("a text that many rows share "), F.col("id") % 7)
    df = spark.range(20_000).select("id", text.alias("text"), F.lit(None).cast("string").alias("nothing"))
    before = _kept_bytes(spark)
    found = add_places(df, [F.col("id").desc()])
    assert found.filter("place <> 20000 - id").isEmpty() and found.count() == 20_000
    assert _kept_bytes(spark) - before < 20_000 * 20
    untyped = stored(spark.range(3).withColumn("nothing", F.lit(None)))
    assert sorted(tuple(r) for r in untyped.collect()) == [(0, None), (1, None), (2, None)]
