import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators.blocks import over_last_rows, trailing_avg, with_previous

BLOCK = 100


@pytest.fixture(scope="module")
def series(spark):
    """A dense series with most of the rows, a sparse one, and one with long holes."""
    rng = random.Random(7)
    rows = [("hot", t, Decimal(rng.randrange(1, 900)) / 100) for t in range(0, 2000, 3)]
    rows += [("sparse", t, Decimal(t % 7)) for t in range(5, 4000, 170)]
    holes = sorted(rng.sample(range(0, 250), 40) + rng.sample(range(3000, 3250), 40))
    rows += [("holes", t, Decimal(1)) for t in holes]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t long, v decimal(18,2)")


def _by_key(rows):
    out = {}
    for k, t, v in sorted(rows):
        out.setdefault(k, []).append((t, v))
    return out


@pytest.mark.parametrize("block", [BLOCK, 7, 10_000, None])
@pytest.mark.parametrize("depth", [1, 5, 40])
def test_last_rows_equal_an_uncut_frame(series, depth, block):
    rows, df = series
    got = over_last_rows(df, ["k"], "t", depth, block, {"f": F.collect_list("t")}).collect()
    want = {
        (k, t): [x for x, _ in seq[max(0, i - depth): i + 1]]
        for k, seq in _by_key(rows).items() for i, (t, _) in enumerate(seq)
    }
    assert {(r.k, r.t): r.f for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("block", [BLOCK, None])
def test_previous_row_crosses_blocks_and_holes(series, block):
    rows, df = series
    got = with_previous(df, ["k"], "t", block, {"before": "t"}).collect()
    want = {
        (k, t): (seq[i - 1][0] if i else None)
        for k, seq in _by_key(rows).items() for i, (t, _) in enumerate(seq)
    }
    assert {(r.k, r.t): r.before for r in got} == want


@pytest.mark.parametrize("block", [BLOCK, 13, None])
@pytest.mark.parametrize("span", [0, 50, 333, 5000])
def test_trailing_mean_equals_brute_force(series, span, block):
    rows, df = series
    got = trailing_avg(df, ["k"], "t", F.col("v"), span, block).collect()
    want = {}
    for k, seq in _by_key(rows).items():
        for t, _ in seq:
            inside = [v for x, v in seq if t - span <= x <= t]
            want[k, t] = float(sum(inside)) / len(inside)
    assert len(got) == len(rows)
    for r in got:
        assert r.baseline == pytest.approx(want[r.k, r.t], rel=1e-12)


def test_no_task_sorts_a_whole_series(series):
    _, df = series
    plan = over_last_rows(df, ["k"], "t", 5, BLOCK, {"f": F.count("*")})._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
