"""Hours that come in late, in any order, against one run over all of them."""

import random
from datetime import datetime, timedelta

import pytest

from stationflow.operators.series import feature_table, split_train_test, split_train_test_by_chunk
from stationflow.plans import late
from stationflow.schemas import HOURLY_RIDES

START = datetime(2024, 1, 30)


def hours(spark, rows):
    return spark.createDataFrame([(s, START + timedelta(hours=h), n) for s, h, n in rows], HOURLY_RIDES)


def same(got, expected):
    got = got.select(expected.columns)
    return got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_any_order_gives_one_run(spark, tmp_path, seed):
    """Counts of an hour are spread over batches; series have gaps, and some are short."""
    rng = random.Random(seed)
    rows = [(s, h, rng.randint(1, 9)) for s, n in (("a", 90), ("b/é", 60), ("short", 10), ("29", 29)) for h in sorted(rng.sample(range(120), n))]
    parts = [(s, h, n - 1) for s, h, n in rows if n > 1] + [(s, h, 1) for s, h, _ in rows]
    rng.shuffle(parts)
    table = late.series_table(spark, str(tmp_path), buckets=3, chunk="day")
    cuts = sorted(rng.sample(range(len(parts)), 3))
    for a, b in zip([0, *cuts], [*cuts, len(parts)]):
        late.add_hours(table, hours(spark, parts[a:b]))
    assert same(late.features(table), feature_table(hours(spark, rows)))
    assert not late.add_hours(table, hours(spark, []))


def test_a_late_hour_touches_its_own_parts(spark, tmp_path):
    table = late.series_table(spark, str(tmp_path))
    rows = [(f"s{i}", h, 1) for i in range(40) for h in range(0, 2_000)]
    late.add_hours(table, hours(spark, rows))
    assert table.snapshot().files > 60
    # The hour lies two days into February; the rows after it lie in the same month.
    late.add_hours(table, hours(spark, [("s7", 60, 5)]))
    assert (table.snapshot().added, table.snapshot().removed) == (1, 1)
    # Ten hours before March: the next 28 rows reach into it.
    late.add_hours(table, hours(spark, [("s7", 24 * 31 - 10, 5)]))
    assert (table.snapshot().added, table.snapshot().removed) == (2, 2)
    changed = [(s, h, 6 if s == "s7" and h in (60, 24 * 31 - 10) else n) for s, h, n in rows]
    assert same(late.features(table), feature_table(hours(spark, changed)))


def test_a_batch_is_added_once(spark, tmp_path):
    table = late.series_table(spark, str(tmp_path), buckets=2)
    for n in (0, 1, 1, 0):
        late.add_hours(table, hours(spark, [("a", h, 1) for h in range(40 * n, 40 * n + 40)]), batch=("trips", n))
    assert same(late.features(table), feature_table(hours(spark, [("a", h, 1) for h in range(80)])))


@pytest.mark.parametrize("unit", ["day", "month"])
def test_split_by_chunk(spark, unit):
    rng = random.Random(3)
    rows = [(s, h, 1) for s, n in (("a", 400), ("b", 7), ("c", 1), ("d", 120)) for h in rng.sample(range(2_000), n)]
    frame = hours(spark, rows)
    assert same(split_train_test_by_chunk(frame, unit), split_train_test(frame))
