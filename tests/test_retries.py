"""Requests that are put off and tried again, against a plain simulation."""

import random

import pytest
from pyspark.sql import functions as F

from eddy.operators import retries


def plain(times, duration, tick):
    """Every tick and request in turn; ``(start, put_off)`` of each request."""
    start, off, waiting, busy = {}, {}, [], -10**9
    horizon = (max(times) // tick + 2 + len(times) * (1 + duration // tick)) * tick
    events = sorted([(x, 1, i) for i, x in enumerate(times)] + [(x, 0, -1) for x in range(0, horizon, tick)])
    for x, kind, i in events:
        if kind:
            off[i] = 0
            if x >= busy:
                start[i], busy = x, x + duration
            else:
                off[i] = 1
                waiting.append(i)
        else:
            again = []
            for j in waiting:
                if x >= busy:
                    start[j], busy = x, x + duration
                else:
                    off[j] += 1
                    again.append(j)
            waiting = again
    assert not waiting
    return [(start[i], off[i]) for i in range(len(times))]


def cases(seed):
    r = random.Random(seed)
    for key, (n, gap) in {"sparse": (60, 40), "busy": (90, 4), "tied": (40, 0), "waves": (120, 9), None: (80, 6)}.items():
        t, times = 0, []
        for i in range(n):
            t += r.randrange(gap + 1) + (400 if key == "waves" and i % 25 == 0 else 0)
            times.append(t)
        yield key, times


@pytest.mark.parametrize("duration, tick", [(3, 10), (25, 10)])
@pytest.mark.parametrize("direct", [True, False])
def test_against_simulation(spark, duration, tick, direct):
    rows, want, n = [], {}, 0
    for key, times in cases(duration):
        for x, (start, off) in zip(times, plain(times, duration, tick)):
            rows.append((n, key, x, "kept"))
            want[n] = (key, start, off, "kept")
            n += 1
    df = spark.createDataFrame(rows, "id long, key string, t long, start_text string")
    df = df.withColumn("t", F.timestamp_micros("t"))
    kw = {} if direct else {"direct_rows": 30, "chunk_rows": 11}
    got = retries.retry_put_off(df, "key", "id", "t", duration, tick, **kw)
    assert got.columns == ["id", "key", "t", "start_text", "start", "put_off"]
    got = {r.id: (r.key, r.s, r.put_off, r.start_text) for r in got.withColumn("s", F.unix_micros("start")).collect()}
    assert got == want


def test_burst_is_rounds(spark):
    """A burst, ticks apart further than a request runs: one of a key at each tick."""
    keys = [1, 1, 2, 3, 3, 3, 3, 4, 2, 1, 1]
    df = spark.createDataFrame([(i, k, 5) for i, k in enumerate(keys)], "id long, key long, t long")
    out = retries.retry_put_off(df.withColumn("t", F.timestamp_micros("t")), "key", "id", "t", 100, 1000)
    rows = out.select("id", F.unix_micros("start").alias("s"), "put_off").orderBy("id").collect()
    assert [r.put_off for r in rows] == [0, 1, 0, 0, 1, 2, 3, 0, 1, 2, 3]
    assert all(r.s == (5 if r.put_off == 0 else 1000 * r.put_off) for r in rows)


def test_odd_rows(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", 7), (2, "a", None), (3, "a", 3)], "id long, key string, t long")
    df = df.withColumn("t", F.timestamp_micros("t"))
    rows = retries.retry_put_off(df, "key", "id", "t", 5, 10).select("id", F.unix_micros("start").alias("s"), "put_off").orderBy("id")
    assert [tuple(r) for r in rows.collect()] == [(0, None, 0), (1, 7, 0), (2, 20, 2), (3, 30, 3)]
    assert retries.retry_put_off(df.limit(0), "key", "id", "t", 5, 10).count() == 0
    with pytest.raises(ValueError):
        retries.retry_put_off(df, "key", "id", "t", 0, 10)
