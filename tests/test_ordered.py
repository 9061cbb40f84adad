"""Order-dependent operators against plain Python; firm 0 holds most rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import ordered, quantiles
from panelwatch.operators.quantiles import column_quantile, group_quantiles

START = date(2000, 1, 1)


def make_panel(seed, firms=6, hot=300):
    """(gvkey, iid, date, price, ret): firm 0 has most rows, several share classes per date."""
    rnd = random.Random(seed)
    out = []
    for gvkey in range(firms):
        n = hot if gvkey == 0 else rnd.randint(1, 30)
        cells = {(rnd.randint(0, 60) * 30, rnd.randint(1, 8)) for _ in range(n)}
        for days, iid in cells:
            price = rnd.choice([None, 0.0, -1.5, 2.0, rnd.random() * 50])
            ret = rnd.choice([None, -1.0 if rnd.random() < 0.02 else 0.1, rnd.random() - 0.5])
            out.append((gvkey, iid, START + timedelta(days=days), price, ret))
    rnd.shuffle(out)
    return out


SCHEMA = "gvkey long, iid int, date date, price double, ret double"


def by_firm(data):
    firms = {}
    for r in sorted(data, key=lambda r: (r[0], r[2], r[1])):
        firms.setdefault(r[0], []).append(r)
    return firms


@pytest.mark.parametrize("seed", [1, 2])
def test_previous_row(spark, seed):
    data = make_panel(seed)
    got = ordered.with_previous(
        spark.createDataFrame(data, SCHEMA).repartition(5), ["price", "date"]
    ).select("gvkey", "iid", "date", F.col("prev.price"), F.col("prev.date").alias("d"), F.col("prev").isNull().alias("first"))
    want = []
    for firm in by_firm(data).values():
        for before, r in zip([None, *firm], firm):
            want.append((r[0], r[1], r[2], before and before[3], before and before[2], before is None))
    assert rows(got) == sorted(want, key=str)


def test_running_product(spark):
    data = [r for r in make_panel(3) if r[1] == 1 or r[0] != 0] + [
        (0, 1, START + timedelta(days=5000 + i), 1.0, 0.01 * (i % 7 - 3)) for i in range(80)
    ]
    data = list({(r[0], r[2]): r for r in data}.values())
    got = ordered.with_running_product(
        spark.createDataFrame(data, SCHEMA), 1 + F.col("ret"), "index", "gvkey", ("date",)
    )
    want = {}
    for firm in by_firm(data).values():
        level = 1.0
        for r in firm:
            if r[4] is not None:
                level *= 1 + r[4]
            want[r[0], r[2]] = level if r[4] is not None else None
    found = {(r.gvkey, r.date): r["index"] for r in got.collect()}
    assert found.keys() == want.keys()
    for k, v in want.items():
        assert found[k] == (pytest.approx(v, rel=1e-9) if v is not None else None)


def test_last_rows_limits_before_the_shuffle(spark):
    data = make_panel(4)
    tail = ordered.last_rows(spark.createDataFrame(data, SCHEMA), 5)
    want = [(r[0], r[1], r[2]) for firm in by_firm(data).values() for r in firm[-5:]]
    assert rows(tail.select("gvkey", "iid", "date")) == sorted(want, key=str)
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_date_cells(spark):
    data = make_panel(5)
    got = ordered.date_cells(spark.createDataFrame(data, SCHEMA))
    want = []
    for firm in by_firm(data).values():
        dates = sorted({r[2] for r in firm})
        for before, d, after in zip([None, *dates], dates, [*dates[1:], None]):
            n = sum(r[2] == d for r in firm)
            prev_n = sum(r[2] == before for r in firm) if before else None
            want.append((firm[0][0], d, n, before, prev_n, after, (d - before).days if before else None))
    assert rows(got.select("gvkey", "date", "n_rows", "prev_date", "prev_rows", "next_date", "gap_days")) == sorted(
        want, key=str
    )


@pytest.mark.parametrize("reach", [151, 1000, 10**15])
def test_prior_sum(spark, reach):
    rnd = random.Random(6)
    seqs = rnd.sample(range(reach), 150)
    data = [(s, rnd.randint(0, 9), s % 3) for s in seqs]
    df = spark.createDataFrame(data, "seq long, cost long, batch long")
    got = {r.seq: r.before for r in ordered.with_prior_sums(df, {"before": F.col("cost")}).collect()}
    assert got == {s: sum(c for t, c, _ in data if t < s) for s in seqs}
    got = {r.seq: r.before for r in ordered.with_prior_sums(df, {"before": F.col("cost")}, keys=("batch",)).collect()}
    assert got == {s: sum(c for t, c, b in data if t < s and b == s % 3) for s in seqs}


@pytest.mark.parametrize("n", [0, 1, 10, 150, 500])
def test_after_first(spark, n):
    seqs = random.Random(7).sample(range(1000), 150)
    got = ordered.after_first(spark.createDataFrame([(s,) for s in seqs], "seq long"), n)
    assert rows(got, "seq") == [(s,) for s in sorted(seqs)[n:]]


def interpolated(values, p):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    position = (len(values) - 1) * p
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.85, 1.0])
@pytest.mark.parametrize("kind", ["spread", "few values", "one value", "heavy tail"])
def test_large_quantiles_are_exact(spark, p, kind):
    rnd = random.Random(8)
    draw = {
        "spread": rnd.random,
        "few values": lambda: float(rnd.randint(0, 3)),
        "one value": lambda: 4.25,
        "heavy tail": lambda: rnd.random() ** -3 * rnd.choice([-1, 1]),
    }[kind]
    data = [(k, draw() if rnd.random() > 0.05 else None) for k in ("a", "b") for _ in range(4000)]
    df = spark.createDataFrame(data, "k string, value double").repartition(6)
    got = {k: v for k, v in rows(group_quantiles(df, "k", ["value"], p))}
    for k in ("a", "b"):
        assert got[k] == pytest.approx(interpolated([v for j, v in data if j == k], p), rel=1e-12)
    everything = column_quantile(df, "value", p).collect()[0][0]
    assert everything == pytest.approx(interpolated([v for _, v in data], p), rel=1e-12)


def test_quantiles_where_one_group_holds_most_rows(spark):
    data = make_panel(9) + [(99, 1, START + timedelta(days=i), float(i * i % 7919), None) for i in range(5000)]
    df = spark.createDataFrame(data, SCHEMA)
    small = rows(group_quantiles(df, "gvkey", ["price", "ret"], 0.5))
    want = [(k, interpolated([r[3] for r in f], 0.5), interpolated([r[4] for r in f], 0.5)) for k, f in by_firm(data).items()]
    for got, expected in zip(small, sorted(want, key=str)):
        assert got[0] == expected[0]
        assert got[1:] == pytest.approx(expected[1:], nan_ok=True) or None in expected


def test_short_and_long_keys_have_the_same_quantiles(spark, monkeypatch):
    """Keys above and below the bound, a null key, keys without values, and the whole table by ranges."""
    rng = random.Random(3)
    data = [(k, rng.choice([None, 1.0, 2.5, float("inf"), rng.random()]), rng.random() * 9) for k in [None, *range(6)] for _ in range(40 * (k or 1))]
    data += [(77, None, None)] * 9 + [(78, None, 1.5)]
    df = spark.createDataFrame(data, "k int, a double, b double")
    got = {}
    for bound in (4096, 100, 0):
        monkeypatch.setattr(quantiles, "WHOLE", bound)
        got[bound] = rows(quantiles.group_quantiles(df, "k", ["a", "b"], [0.25, 0.9]))
    assert len(got[0]) == 8
    near = lambda found: [tuple(x if x is None else round(x, 12) for x in r) for r in found]
    assert near(got[4096]) == near(got[0]) and near(got[100]) == near(got[0])
