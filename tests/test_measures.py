import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators.correlation import correlation
from starloom.operators.totals import Weighted, exact_totals


MOST = Fraction(1.7976931348623157e308)


def nearest(exact):
    try:
        return float(exact)
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


def summed(frame):
    return exact_totals(frame, [], {"s": "x"}).first()[0]


def total(spark, values):
    return summed(spark.createDataFrame([(value,) for value in values], "x double"))


def test_sum_is_exact_whatever_the_order(spark):
    chance = random.Random(1)
    cents = [chance.randint(-10**9, 10**9) for _ in range(20_000)]
    expected = sum(cents) / 100
    for partitions in (1, 7, 32):
        chance.shuffle(cents)
        frame = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(partitions)
        assert summed(frame) == expected


def weighted(spark, pairs):
    frame = spark.createDataFrame(pairs, "x double, n long")
    return exact_totals(frame, [], {"s": Weighted("x", "n")}).first()[0]


def test_weighted_sum_is_the_sum_of_the_repeats(spark):
    chance = random.Random(3)
    pairs = [(chance.randint(-10**7, 10**7), chance.randint(0, 10**6)) for _ in range(5000)]
    expected = sum(c * n for c, n in pairs) / 100
    assert weighted(spark, [(c / 100, n) for c, n in pairs]) == expected
    # the product of these doubles is 3150.2999999999997
    assert weighted(spark, [(1050.1, 3)]) == 3150.3
    assert weighted(spark, [(1050.1, 10**15)]) == 1.0501e18


def test_weighted_sum_of_other_values(spark):
    assert weighted(spark, [(1e-9, 2), (0.5, 4)]) == 2.000000002
    assert weighted(spark, [(1e-9, 2), (2e12, 3)]) == 6e12
    assert weighted(spark, [(None, 2), (1.5, None), (2.5, 2)]) == 5.0
    assert weighted(spark, [(None, 2)]) is None
    assert math.isnan(weighted(spark, [(float("nan"), 1), (1.0, 1)]))
    assert weighted(spark, [(float("inf"), 1), (1.0, 1)]) == math.inf


def test_sum_keeps_six_decimals(spark):
    assert total(spark, [0.000001] * 10 + [1.5, -0.25]) == 1.25001


def test_sum_keeps_what_lies_below_a_millionth(spark):
    assert summed(spark.range(1_000_000).select(F.lit(4e-7).alias("x"))) == 0.4
    assert total(spark, [1e-7, 2e-7, 3.0000004]) == 3.0000007
    assert total(spark, [1.2345678901234567e-9] * 3) == pytest.approx(3.70370367037037e-9, rel=1e-15)
    assert total(spark, [1e-20, 2e-20]) == 3e-20


@pytest.mark.parametrize(
    "rows, amount, expected",
    [
        # totals beyond 1e18 of decimals below 1e12, and beyond 1e20
        (1_200_000, 9e11, 1.08e18),
        (1_200_000, -9e11, -1.08e18),
        (2_000_000, 123456789012.34567, 246913578024691340.0),
        # beyond 1e4 of amounts with more than twenty decimals
        (12_000_000, 0.0009123456789012345, 10948.148146814814),
        # beyond 1e30 of amounts below 1e27
        (2_000, 9e26, 1.8e30),
        (200_000, 9e26, 1.8e32),
    ],
)
def test_sum_of_many_amounts_of_a_form(spark, rows, amount, expected):
    found = summed(spark.range(rows).select(F.lit(amount).alias("x")))
    assert found == pytest.approx(expected, rel=1e-15)


def test_sum_of_many_amounts_with_money_and_fractions(spark):
    frame = spark.range(1_200_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 3 == 1, 9.9e11).otherwise(1e-7).alias("x")
    )
    assert summed(frame) == pytest.approx(3.96e17 + 200_000.04, rel=1e-15)


def test_weighted_sum_beyond_its_type(spark):
    assert weighted(spark, [(1e9, 10**17)] * 3) == pytest.approx(3e26, rel=1e-15)
    assert weighted(spark, [(1e9, 10**17), (1e-9, 1)]) == pytest.approx(1e26, rel=1e-15)


def test_sum_of_mixed_sizes_is_the_same_in_any_order(spark):
    chance = random.Random(2)
    values = [chance.uniform(-1, 1) * 10 ** chance.randint(-16, 24) for _ in range(5000)]
    values += [2.0**53, 2.0**60 + 1024, 1e16 / 3, 0.1, 1e-9 / 3]
    sums = set()
    for partitions in (1, 7, 32):
        chance.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
        sums.add(summed(frame))
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(math.fsum(values), rel=1e-12)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([], None),
        ([0.1] * 10, 1.0),
        ([1e12, 0.5, -1e12], 0.5),
        ([1e-9, 1e12], 1000000000000.0),
        ([None, None], None),
        ([1.1, None, 2.2], 3.3),
        ([1.0, math.inf], math.inf),
        ([-math.inf, 5.0], -math.inf),
        ([1e300, 1e300], 2e300),
        ([1e19, 1.0], 1e19),
        ([9e15] * 4, 3.6e16),
    ],
)
def test_sum_of_special_values(spark, values, expected):
    assert total(spark, values) == expected


def test_sum_of_nan(spark):
    assert math.isnan(total(spark, [1.0, math.nan]))
    assert math.isnan(total(spark, [math.inf, -math.inf]))


def test_sums_by_group_with_counts(spark):
    data = [("a", 0.1, 1), ("a", 0.2, None), (None, 0.7, 2), (None, 0.1, 2), ("b", None, 5), ("c", 1e20, None)]
    frame = spark.createDataFrame(data, "k string, x double, n int")
    rows = exact_totals(frame, ["k"], {"s": "x"}, {"whole": "n", "rows": "1"}).collect()
    assert sorted(tuple(row) for row in rows if row.k) == [
        ("a", 0.3, 1, 2),
        ("b", None, 5, 1),
        ("c", 1e20, None, 1),
    ]
    assert [tuple(row) for row in rows if row.k is None] == [(None, 0.8, 4, 2)]


def test_several_sums_at_once(spark):
    data = [(1, 0.1, 2.5, 3), (1, 1e-30, None, 4), (2, None, 1e25, 2), (2, 7.0, 0.25, 10**12), (3, None, None, 1)]
    frame = spark.createDataFrame(data, "k int, x double, y double, n long")
    sums = {"sx": "x", "sy": "y", "sxn": Weighted("x", "n"), "twice": "x * 2"}
    rows = exact_totals(frame, ["k"], sums, {"rows": "1", "n": "n"}).collect()
    assert sorted(tuple(row) for row in rows) == [
        (1, 0.1, 2.5, 0.3, 0.2, 2, 7),
        (2, 7.0, 1e25, 7e12, 14.0, 2, 10**12 + 2),
        (3, None, None, None, None, 1, 1),
    ]
    single = exact_totals(frame.where("k = 9"), [], sums, {"rows": "1"}).collect()
    assert [tuple(row) for row in single] == [(None, None, None, None, None)]


finite = st.floats(allow_nan=False, allow_infinity=False, allow_subnormal=False)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), finite), max_size=200), st.integers(-(10**12), 10**12))
def test_sums_are_exact(spark, rows, weight):
    """Against fractions of the shortest decimals, where a group spans 38 digits at most."""
    frame = spark.createDataFrame([(k, x, weight) for k, x in rows], "k int, x double, w long")
    found = exact_totals(frame.repartition(3), ["k"], {"s": "x", "w": Weighted("x", "w")}).collect()
    assert len(found) == len({k for k, _ in rows})
    for row in found:
        amounts = [Fraction(repr(x)) for k, x in rows if k == row.k]
        for got, exact in ((row.s, sum(amounts)), (row.w, weight * sum(amounts))):
            scale = sum(map(abs, amounts)) * (1 if got is row.s else abs(weight))
            assert got == pytest.approx(nearest(exact), rel=1e-15, abs=float(min(scale * Fraction(1, 10**15), MOST)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(10**17), 10**17), min_size=1, max_size=60), st.integers(0, 12))
def test_sums_of_near_sizes_are_rounded_once(spark, numbers, decimals):
    values = [n / 10**decimals for n in numbers]
    exact = sum(Fraction(repr(value)) for value in values)
    assert total(spark, values) == float(exact)


def test_small_and_large_amounts_are_kept(spark):
    assert total(spark, [1e-40] * 3) == 3e-40
    assert total(spark, [1e300, 1e-40, -1e300]) == 1e-40
    assert total(spark, [1e27] * 3) == 3e27


def test_three_aggregates_a_sum(spark):
    frame = spark.createDataFrame([(1, 0.5)], "k int, x double")
    plan = exact_totals(frame, ["k"], {"s": "x"})._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("partial_sum(") == 3 and len(plan) < 20_000


def correlated_frame(frame):
    return correlation(frame, "a", "b", "c").first().c


def correlated(spark, pairs):
    frame = spark.createDataFrame(pairs, "a double, b long")
    return correlated_frame(frame)


def test_correlation_is_null_where_undefined(spark):
    assert correlated(spark, []) is None
    assert correlated(spark, [(1.0, 2)]) is None
    assert correlated(spark, [(1.0, 2), (1.0, 3), (1.0, 9)]) is None
    assert correlated(spark, [(1.0, 2), (2.0, None), (None, 4)]) is None


def test_correlation_uses_complete_pairs_only(spark):
    pairs = [(1.0, 5), (2.0, 3), (4.0, 4), (7.0, 1)]
    gaps = [(100.0, None), (None, 100)]
    frame = spark.createDataFrame(pairs, "a double, b long")
    expected = frame.agg(F.corr("a", "b")).first()[0]
    assert correlated(spark, pairs + gaps) == pytest.approx(expected, abs=1e-12)


def exact_correlation(pairs):
    xs, ys = ([Fraction(p[side]) for p in pairs] for side in (0, 1))
    mean_x, mean_y = sum(xs) / len(xs), sum(ys) / len(ys)
    xx, yy = sum((x - mean_x) ** 2 for x in xs), sum((y - mean_y) ** 2 for y in ys)
    xy = sum((x - mean_x) * (y - mean_y) for x, y in zip(xs, ys, strict=True))
    return math.sqrt(xy * xy / (xx * yy)) * (1 if xy > 0 else -1)


@pytest.mark.parametrize("kind", ["plain", "far from zero", "one far away", "huge", "tiny"])
def test_correlation_of_any_size_has_the_same_bits_in_any_order(spark, kind):
    draw = random.Random(kind)
    pairs = []
    for _ in range(500):
        x = draw.gauss(0, 1)
        y = x + draw.gauss(0, 2)
        if kind == "far from zero":
            x, y = x + 1e9, y - 1e7
        elif kind == "huge":
            x, y = x * 4e307, y * 1e300
        elif kind == "tiny":
            x, y = x * 1e-300, y * 1e-200
        pairs.append((x, y))
    if kind == "one far away":
        pairs.append((1e12, 3.0))
    found = set()
    for partitions in (1, 7, 32):
        draw.shuffle(pairs)
        frame = spark.createDataFrame(pairs, "a double, b double").repartition(partitions)
        found.add(correlated_frame(frame))
    assert len(found) == 1
    assert found.pop() == pytest.approx(exact_correlation(pairs), abs=1e-9)


def test_correlation_of_odd_values(spark):
    odd = [(float("nan"), 1.0), (math.inf, 1.0), (1.0, -math.inf)]
    for pair in odd:
        frame = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), pair], "a double, b double")
        assert math.isnan(correlated_frame(frame))
    # a constant whose mean is rounded, and differences of one last bit
    frame = spark.createDataFrame([(0.1, float(k)) for k in range(7)], "a double, b double")
    assert correlated_frame(frame) is None
    bit = math.ulp(1.0)
    frame = spark.createDataFrame([(1 + k * bit, float(k)) for k in range(7)], "a double, b double")
    assert correlated_frame(frame) == pytest.approx(1.0)
    frame = spark.createDataFrame([(0.0, 0.0), (0.0, -0.0)], "a double, b double")
    assert correlated_frame(frame) is None
