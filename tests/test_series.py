"""Growth against the newest reading that is old enough, by a plain search."""

from __future__ import annotations

import datetime as dt
import random

from dealweave.operators import series


def test_growth_against_a_plain_search(spark):
    rng, start = random.Random(8), dt.date(2023, 1, 1)
    rows = []
    for key, n, gap in (("hot", 400, 1), ("sparse", 30, 45), ("mixed", 60, 12), ("one", 1, 1)):
        day = start
        for _ in range(n):
            rows.append((key, day, rng.randrange(1000), rng.choice([None, 5, 9])))
            day += dt.timedelta(days=rng.randint(1, 2 * gap))
    df = spark.createDataFrame(rows, "org string, day date, stars long, releases long")
    got = sorted(map(tuple, series.growth(df, "org", "day", ["stars", "releases"], 30).collect()))
    want = []
    for k, d, s, r in rows:
        old = max((x for x in rows if x[0] == k and x[1] <= d - dt.timedelta(days=30)), key=lambda x: x[1], default=None)
        want.append((k, d, s, r, s - old[2] if old else None, r - old[3] if old and None not in (r, old[3]) else None))
    assert got == sorted(want)
    assert series.growth(df.limit(0), "org", "day", ["stars"]).count() == 0
