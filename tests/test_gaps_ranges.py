"""Missing polls, price limits and quotes across venues against plain versions."""

import random

import pytest

from ticklake.operators import across, gaps, ranges

from .conftest import rows

DAY = 86_400_000


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_gaps_do_not_depend_on_blocks(spark, block):
    rng = random.Random(block)
    at = {v: sorted({rng.randrange(-40, 90) for _ in range(40)}) for v in ("a", "b")} | {"c": [5]}
    pairs = [(v, t * 60 + rng.randrange(60)) for v, ts in at.items() for t in ts for _ in range(2)] + [("a", None), (None, 3)]
    got = gaps.missing_polls(spark.createDataFrame(pairs, "exchange_id string, extraction_timestamp long"), 60, 60 * block)
    want = [(v, (x + 1) * 60, (y - 1) * 60, y - x - 1) for v, ts in at.items() for x, y in zip(ts[:-1], ts[1:], strict=True) if y - x > 1]
    assert rows(got) == sorted(want, key=lambda r: [(True, str(c)) for c in r])
    assert gaps.missing_polls(spark.createDataFrame([], "exchange_id string, extraction_timestamp long"), 60).count() == 0


def values(spark, n, seed=1):
    rng = random.Random(seed)
    data = [("x", "A", d * DAY + i, rng.gauss(100, 10)) for d in range(4) for i in range(n)]
    data += [("x", "A", 5, None), ("x", "A", 6, float("nan")), ("y", "B", 7, 3.0)]
    return data, spark.createDataFrame(data, "exchange_id string, symbol string, extraction_timestamp long, last double")


def test_small_histories_are_exact(spark):
    data, df = values(spark, 25)
    known = {(r.exchange_id, r.symbol): r for r in ranges.limits(ranges.day_sketches(df), 0.1, 0.9, 0.0).collect()}
    usable = sorted(v for e, _, _, v in data if e == "x" and v is not None and v == v)
    # The quantile at q is the smallest value that at least a share q of all values doesn't exceed.
    want = [next(v for i, v in enumerate(usable, 1) if i >= q * len(usable) - 1e-9) for q in (0.1, 0.9)]
    assert [known["x", "A"].least, known["x", "A"].most] == want and known["x", "A"]["values"] == 100
    assert (known["y", "B"].least, known["y", "B"].most) == (3.0, 3.0)


def test_long_histories_stay_within_the_rank_error(spark):
    data, df = values(spark, 5000)
    known = ranges.limits(ranges.day_sketches(df), 0.05, 0.95, 0.0).filter("symbol = 'A'").first()
    usable = sorted(v for e, _, _, v in data if e == "x" and v is not None and v == v)
    for value, q in ((known.least, 0.05), (known.most, 0.95)):
        assert abs(sum(v <= value for v in usable) / len(usable) - q) < 0.02


def test_judged_rows(spark):
    _, df = values(spark, 10)
    known = spark.createDataFrame([("x", "A", 95.0, 105.0, 1)], "exchange_id string, symbol string, least double, most double, values long")
    got = ranges.judged(df, known)
    assert got.count() == df.count()
    for r in got.collect():
        assert r.out_of_range == (r.symbol == "A" and r.last is not None and (r.last < 95 or r.last > 105 or r.last != r.last))


@pytest.mark.parametrize("block", [1, 5, 1000])
def test_best_quotes_do_not_depend_on_blocks(spark, block):
    rng = random.Random(block)
    quotes = {(v, s, t): (rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 4.0, 5.0])) for v in "abc" for s in "XY" for t in rng.sample(range(40), 12)}
    given = [(v, s, t, *q) for (v, s, t), q in quotes.items()] + [(None, "X", 1, 9.0, 0.1), ("a", None, 1, 9.0, 0.1), ("a", "X", None, 9.0, 0.1)]
    want = []
    for s, t in sorted({(s, t) for _, s, t in quotes}):
        last = {v: quotes[v, s, max(x for a, b, x in quotes if (a, b) == (v, s) and x <= t)] for v in "abc" if any((a, b) == (v, s) and x <= t for a, b, x in quotes)}
        bids = sorted((-b, v) for v, (b, _) in last.items() if b is not None)
        asks = sorted((a, v) for v, (_, a) in last.items() if a is not None)
        want.append((s, t, *((-bids[0][0], bids[0][1]) if bids else (None, None)), *(asks[0] if asks else (None, None)), len(last)))
    df = spark.createDataFrame(given, "exchange_id string, symbol string, extraction_timestamp long, bid double, ask double")
    assert sorted(map(tuple, across.best(df, block).collect())) == want
    assert across.best(df.limit(0), block).count() == 0
