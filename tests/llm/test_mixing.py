import re

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing
from starloom.llm.common import table
from starloom.llm.mixing import mix, mix_report, op10_mixing, quality_weight

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_targets(sizes):
    """sizes: source -> words. Reshare the excess by weight until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        given = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, words in given.items():
            target[s] += words
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def brute_taken(rows, target, source_size):
    """rows: (key, tie, size) of a source; copies of each row."""
    epochs = int(target // source_size) if source_size else 0
    budget = target - epochs * source_size
    units, through = {}, 0
    for key, tie, size in rows:
        units[key, tie] = units.get((key, tie), 0) + size
    taken = set()
    if budget > 0:
        for unit in sorted(units):
            before, through = through, through + units[unit]
            nearer = before < budget and through - budget < budget - before
            if through <= budget or nearer:
                taken.add(unit)
    return {unit: epochs + (unit in taken) for unit in units}


def keyed(docs):
    columns = mixing._sized(docs, "doc_id", "text", "source", quality_weight("text"), mixing.SEED)
    return docs.select("doc_id", *columns).collect()


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query_equals_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    rows = keyed(docs)
    sizes = {}
    for r in rows:
        sizes[r["__source"]] = sizes.get(r["__source"], 0) + r["__size"]
    targets = brute_targets(sizes)
    times = {
        s: brute_taken(
            [(r["__key"], r["__tie"], r["__size"]) for r in rows if r["__source"] == s], targets[s], sizes[s]
        )
        for s in sizes
    }
    keys = {r.doc_id: r for r in rows}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ours = op10_mixing(spark, folder).collect()
    assert len(ours) == len(rows)
    for r in ours:
        mine = keys[r.doc_id]
        source = mine["__source"]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source])
        assert r.taken == r.size * times[source][mine["__key"], mine["__tie"]]
        assert r.taken <= 2 * r.size
    for source in sizes:
        longest = max(r["__size"] for r in rows if r["__source"] == source)
        taken = sum(r.taken for r in ours if keys[r.doc_id]["__source"] == source)
        assert abs(taken - targets[source]) <= longest / 2 + 1


def test_reruns_and_partitions_agree(spark):
    docs = table(spark, SMALL, "documents")
    first = sorted(tuple(r) for r in mix_report(docs).collect())
    again = sorted(tuple(r) for r in mix_report(docs.repartition(7)).collect())
    assert first == again


def test_mix_repeats_rows_as_reported(spark):
    docs = table(spark, SMALL, "documents")
    expected = {r.doc_id: r.taken // r.size for r in mix_report(docs).collect() if r.size}
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {i: n for i, n in expected.items() if n} == {i: n for i, n in counts.items() if i in expected}


def test_better_rows_are_sampled_more_often(spark):
    # a stops at twice its words, so b is to give 8000 of its 6000: a third of it again
    rows = [(i, "word", "b" if i % 4 else "a", i // 4 % 2 == 0) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, good boolean")
    weight = F.when(F.col("good"), 1.0).otherwise(0.25)
    report = {r.doc_id: r for r in mix_report(docs, weight=weight).collect()}
    assert {r.target for r in report.values()} == {4000.0, 8000.0}
    taken = {side: [report[i].taken for i, _, s, g in rows if s == "b" and g is side] for side in (True, False)}
    assert sum(taken[True]) + sum(taken[False]) == 8000
    assert sum(taken[True]) > sum(taken[False]) + 600


def test_one_source_holds_most_rows(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") % 9).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
    )
    rows = mix_report(docs).groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target * round(r.taken / r.target)) <= 40 * 5 for r in rows if r.target)


def test_nulls_ties_repeats_other_columns_and_empty(spark):
    schema = "doc_id long, text string, source string, size string, target int, row string, budget int"
    rows = [
        (None, None, None, "x", 1, "", 1),
        (1, "a b", "s", "x", 1, "", 1),
        (1, "a b", "s", "x", 1, "", 1),
        (2, "", "empty", None, 1, "", None),
        (3, "w " * 50_000, "t", None, 1, "", None),
        (4, "c", None, None, 1, "", None),
    ]
    docs = spark.createDataFrame(rows, schema)
    report = mix_report(docs).collect()
    assert sorted((r.size, r.source_size) for r in report) == [
        (0, 0), (0, 1), (1, 1), (2, 4), (2, 4), (50_000, 50_000)
    ]
    assert all(r.target == 0 for r in report if r.source_size == 0)
    same = [r.taken for r in report if r.doc_id == 1]
    assert same[0] == same[1]
    assert mix(docs).columns == docs.columns
    empty = spark.createDataFrame([], schema)
    assert mix_report(empty).count() == mix(empty).count() == 0
