"""Numbering, looking back and counting on the way, over several tasks."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from repotide.functions.columns import own_key
from repotide.operators import blocks, delivery, history
from repotide.operators.counters import Counters
from repotide.plans import crawl
from repotide.sources.slices import SLICE_KEYS, SliceStore


def test_numbers_have_no_gaps_whatever_the_positions(spark, rows):
    ids = random.Random(1).sample(range(10**9), 500)
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], "at long, name string").repartition(7)
    found = rows(blocks.numbered(df, ["at"]), "at", "name", "number")
    assert sorted(found) == [(i, f"n{i}", n) for n, i in enumerate(sorted(ids))]
    assert blocks.numbered(df.limit(0), ["at"]).count() == 0


def test_sparse_positions_fill_envelopes(spark):
    df = spark.createDataFrame([(i * 1000, f"n{i}") for i in range(25)], "repo_id long, name string")
    packed = delivery.pack_envelopes(df, "repo_id", 10).orderBy("envelope").collect()
    assert [r["value"].count('"name"') for r in packed] == [10, 10, 5]


def test_the_row_before_is_found_across_blocks(spark, rows):
    rng = random.Random(2)
    data = [(q, f"{n:05d}", rng.choice("ab")) for q in ("x", "y", None) for n in range(rng.randrange(40, 90))] + [("z", "0", "a")]
    df = spark.createDataFrame(data, "question string, snapshot string, names string").repartition(5)
    expected = df.withColumn("before", F.lag("names").over(Window.partitionBy("question").orderBy("snapshot")))
    assert rows(blocks.lagged(df, ["question"], "snapshot", "names", "before")) == rows(expected)


def test_stability_is_that_of_one_pass(spark, rows):
    rng = random.Random(3)
    data, names = [], ["a", "b", "c"]
    for n in range(120):
        if rng.random() < 0.1:
            rng.shuffle(names)
        data += [("q", f"{n:04d}", rk + 1, name, 1) for rk, name in enumerate(names)]
    frame = spark.createDataFrame(data, "question string, snapshot string, rk long, name string, count long")
    orders = ["".join(r[3] for r in data[i : i + 3]) for i in range(0, len(data), 3)]
    changed = [i for i in range(120) if not i or orders[i] != orders[i - 1]]
    assert rows(history.convergence(frame)) == [("q", f"{changed[-1]:04d}", len(changed), 120)]


def test_counters_are_told_by_the_run(spark, tmp_path):
    data = [("created", "d1", 1, 5), ("created", "d1", 1, 4), ("created", "d2", 1, 3), ("pushed", "d1", 2, 9), ("pushed", "d1", 2, 8), ("pushed", "d1", 1, 7)]
    frame = spark.createDataFrame(data, "date_field string, crawl_day string, repo_id long, stars long").withColumn("query_key", F.lit("k"))
    store = SliceStore(spark, str(tmp_path / "s"), "repo_id long, stars long")
    wanted = frame.select(*SLICE_KEYS).distinct()
    kept = frame.filter("date_field = 'created'")
    store.write(kept, kept.select(*SLICE_KEYS).distinct(), [F.desc("stars")])
    counters = Counters()
    order = [F.desc("crawl_day"), F.asc("date_field"), F.desc("stars")]
    crawl.crawl_window(store, wanted, frame, [F.desc("stars")], order, counters=counters).collect()
    assert counters.totals() == {
        "slices_from_api": 1, "slices_from_cache": 2, "fetched": 3, "loaded_from_cache": 2, "written_to_cache": 2,
        "duplicate_in_slice": 1, "duplicate_global": 2, "emitted": 2,
    }
    # Everything is stored now.
    again = Counters()
    crawl.crawl_window(store, wanted, frame, [F.desc("stars")], order, limit=1, counters=again).collect()
    totals = again.totals()
    assert (totals["slices_from_api"], totals["loaded_from_cache"], totals["duplicate_global"], totals["emitted"]) == (0, 4, 2, 1)


def test_records_without_id_and_name_are_told_apart(spark):
    df = spark.createDataFrame([(None, "", 1), (None, "", 2), (None, "A", 3), (None, "a", 4), (7, "", 5)], "repo_id long, full_name string, stars long")
    assert df.select(own_key(df.columns).alias("k")).distinct().count() == 4
