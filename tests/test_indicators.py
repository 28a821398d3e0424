import random
import statistics

import pytest

from tickloom.operators import indicators as ind

N = 70


def _rsi(c):
    if len(c) < 15:
        return None
    d = [b - a for a, b in zip(c, c[1:])]
    gain = sum(max(x, 0) for x in d[:14]) / 14
    loss = sum(max(-x, 0) for x in d[:14]) / 14
    for x in d[14:]:
        gain, loss = (gain * 13 + max(x, 0)) / 14, (loss * 13 + max(-x, 0)) / 14
    return 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)


def _ema(c, p):
    e = sum(c[:p]) / p
    for x in c[p:]:
        e += (x - e) * 2 / (p + 1)
    return e


def _macd(c):
    if len(c) < 34:
        return None, None
    line = [_ema(c[-34:][:k], 12) - _ema(c[-34:][:k], 26) for k in range(26, 35)]
    return line[-1], sum(line) / 9


def _atr(f):
    if len(f) < 15:
        return None
    tr = [max(h - l, abs(h - p[2]), abs(l - p[2])) for p, (h, l, _, _) in zip(f, f[1:])]
    a = sum(tr[:14]) / 14
    for x in tr[14:]:
        a = (a * 13 + x) / 14
    return a


def _obv(f):
    return sum(v * ((c > p[2]) - (c < p[2])) for p, (_, _, c, v) in zip(f, f[1:]))


@pytest.fixture(scope="module")
def candles(spark):
    rng = random.Random(3)
    rows = {}
    for s in ("A", "B"):
        price = 100.0
        for i in range(N):
            price = round(price + rng.choice([-1, 0, 1]) * rng.random() * 3, 2)
            t = i * 60 + (100_000 if i > 40 and s == "B" else 0)  # a long hole in B
            rows.setdefault(s, []).append(
                (t, price + rng.random(), price - rng.random(), price, float(rng.randrange(50)))
            )
    flat = [(s, *r) for s, seq in rows.items() for r in seq]
    flat += [("flat", i * 60, 5.0, 5.0, 5.0, 1.0) for i in range(40)]
    flat += [("down", i * 60, 100.0 - i, 100.0 - i, 100.0 - i, 2.0) for i in range(40)]
    flat += [("zero", i * 60, 0.0, 0.0, 0.0, 1.0) for i in range(20)]
    df = spark.createDataFrame(
        flat, "symbol string, open_time long, high double, low double, close double, volume double"
    )
    return rows, df.repartition(5)


def _run(candles, f, *columns, **kw):
    out = f(candles[1], ["symbol"], block_ms=1000, **kw).select("symbol", "open_time", *columns)
    got = {}
    for r in out.orderBy("symbol", "open_time").collect():
        got.setdefault(r.symbol, []).append(tuple(r)[2:])
    return got


def _frames(candles, n):
    for s, seq in candles[0].items():
        for i in range(len(seq)):
            yield s, i, [x[1:] for x in seq[max(0, i - n + 1): i + 1]]


def test_rsi(candles):
    got = _run(candles, ind.rsi, "rsi_14")
    for s, i, f in _frames(candles, 27):
        want = _rsi([x[2] for x in f])
        assert got[s][i][0] == (pytest.approx(want, abs=1e-4) if want is not None else None)
    assert [x[0] for x in got["flat"]] == [None] * 14 + [100.0] * 26
    assert [x[0] for x in got["down"]] == [None] * 14 + [0.0] * 26


def test_macd_needs_34_candles(candles):
    got = _run(candles, ind.macd, "macd", "macd_signal", "macd_hist")
    for s, i, f in _frames(candles, 34):
        line, signal = _macd([x[2] for x in f])
        if line is None:
            assert got[s][i] == (None, None, None)
        else:
            assert got[s][i] == pytest.approx((line, signal, line - signal), abs=3e-8)
    assert got["flat"][33] == (0.0, 0.0, 0.0) and got["flat"][32][0] is None


def test_bollinger(candles):
    got = _run(candles, ind.bollinger, "bb_upper", "bb_middle", "bb_lower", "bb_width")
    for s, i, f in _frames(candles, 20):
        c = [x[2] for x in f]
        if len(c) < 20:
            assert got[s][i] == (None,) * 4
            continue
        mid, dev = sum(c) / 20, statistics.stdev(c)
        want = (mid + 2 * dev, mid, mid - 2 * dev, 4 * dev / mid * 100)
        assert got[s][i] == pytest.approx(want, abs=1e-6)
    assert got["flat"][19] == (5.0, 5.0, 5.0, 0.0)
    assert got["zero"][19] == (0.0, 0.0, 0.0, None) and got["zero"][18][0] is None


def test_atr_and_obv(candles):
    atr, obv = _run(candles, ind.atr, "atr_14"), _run(candles, ind.obv, "obv")
    for s, i, f in _frames(candles, 27):
        want = _atr(f)
        assert atr[s][i][0] == (pytest.approx(want, abs=1e-7) if want is not None else None)
        assert obv[s][i][0] == pytest.approx(_obv(f), abs=1e-7)
    assert obv["flat"][0] == (0.0,) and obv["flat"][-1] == (0.0,)
    assert obv["down"][-1] == (-52.0,)  # only the last 26 moves count


def test_ema_of_whole_array(spark):
    from pyspark.sql import functions as F

    c = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(c,)], "c array<double>")
    assert df.select(ind.ema(F.col("c"), 3)).first()[0] == pytest.approx(_ema(c, 3))
