"""Labels against a plain loop over events, the way the definition reads."""

import random
from datetime import date, timedelta

import pytest

from conftest import rows
from panelwatch.operators import label
from panelwatch.plans import workflows

START = date(2000, 1, 1)


def make(seed, firms=5):
    rnd = random.Random(seed)
    panel = [
        (g, iid, START + timedelta(days=30 * m))
        for g in range(firms)
        for m in range(40)
        for iid in range(1, rnd.choice([1, 1, 2, 3]) + 1)
        if rnd.random() > 0.2
    ]
    day = lambda: START + timedelta(days=rnd.choice([30 * rnd.randint(-3, 43), rnd.randint(-90, 1300)]))
    kinds = ["bankruptcy", "merger", "acquisition", "halt", "ipo", "stock_split", None]
    events = [(s, rnd.randint(0, firms + 1), rnd.choice(kinds), day()) for s in rnd.sample(range(500), 60)]
    return panel, events


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows(spark, seed):
    panel, events = make(seed)
    rnd = random.Random(seed)
    table = [
        (s, g, kind, day, day + timedelta(days=rnd.randint(-5, 200)) if rnd.random() < 0.7 else None,
         rnd.choice(["high", None]), rnd.choice([f"note {s}", None]))
        for s, g, kind, day in events
    ]
    got = label.label_windows(
        spark.createDataFrame(panel, "gvkey long, iid int, date date"),
        spark.createDataFrame(
            table,
            "seq long, gvkey long, actual_event_type string, event_date date, halt_end_date date, "
            "llm_confidence string, details string",
        ),
    ).select("gvkey", "iid", "date", "event_label", "event_date", "event_confidence", "event_details")
    want = {row: ("none", None, None, "") for row in panel}
    for _, g, kind, day, end, confidence, details in sorted(table):
        lo, hi = day, day
        if kind in ("bankruptcy", "merger", "acquisition"):
            lo = day - timedelta(days=60)
        elif kind == "halt":
            hi = end or day
        for row in panel:
            if row[0] == g and lo <= row[2] <= hi:
                want[row] = (kind or "none", day, confidence or "medium", details or "")
    assert rows(got) == sorted(((*k, *v) for k, v in want.items()), key=str)


def test_long_windows_make_few_rows(spark):
    """A halt over decades, one without end and events far outside the panel; firm 0 has most rows and 400 events."""
    rnd = random.Random(7)
    panel = [(g, i, START + timedelta(days=7 * d)) for g in range(3) for d in range(1000) for i in range(3 if g == 0 else 1)]
    far = [(1, 1, START - timedelta(days=40_000), START + timedelta(days=2_000_000)), (2, 2, date(1600, 1, 1), date(1700, 1, 1)), (3, 2, START, START + timedelta(days=7000))]
    many = []
    for seq in range(10, 410):
        lo = START + timedelta(days=rnd.randint(0, 7000))
        many.append((seq, 0, lo, lo + timedelta(days=rnd.choice([0, 1, 127, 128, 129, 900]))))
    events = far + many
    table = [(s, g, "halt", lo, hi, "high", "d") for s, g, lo, hi in events]
    schema = "seq long, gvkey long, actual_event_type string, event_date date, halt_end_date date, llm_confidence string, details string"
    got = label.label_windows(spark.createDataFrame(panel, "gvkey long, iid int, date date"), spark.createDataFrame(table, schema))
    want = []
    for g, iid, day in panel:
        last = max(((s, lo) for s, f, lo, hi in events if f == g and lo <= day <= hi), default=None)
        want.append((g, iid, day, last and last[1]))
    assert rows(got.select("gvkey", "iid", "date", "event_date")) == sorted(want, key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Cartesian" not in plan
    bins = label._bin("lo"), label._bin("hi")
    halt = spark.createDataFrame([(START, START + timedelta(days=7305))], "lo date, hi date")
    assert 50 < halt.select(bins[1] - bins[0]).collect()[0][0] < 70  # 20 years


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_acquisitions(spark, seed):
    panel, events = make(seed)
    seen = set()
    table = []
    for s, g, _, day in sorted(events):
        if (g, day) not in seen:
            seen.add((g, day))
            table.append((s, g, day, "acquisition", f"A{s}", float(s)))
    panel_df = spark.createDataFrame(panel, "gvkey long, iid int, date date")
    events_df = spark.createDataFrame(
        table, "seq long, gvkey long, actual_date date, actual_event_type string, acquirer string, acquisition_price double"
    )
    got = label.label_acquisitions(panel_df, events_df).select(
        "gvkey", "iid", "date", "is_acquired", "acquisition_date", "days_to_acquisition", "acquirer",
        "acquisition_price", "event_type_verified",
    )
    want = {row: [0, None, None, None, None, None] for row in panel}
    matched = 0
    for s, g, day, kind, acquirer, price in sorted(table):
        before = sorted((row for row in panel if row[0] == g and row[2] < day), key=lambda r: (r[2], r[1]))
        for row in before:
            want[row][1:] = [day, (day - row[2]).days, acquirer, price, kind]
        if before:
            matched += 1
            closest = next(row for row in before if row[2] == before[-1][2])
            want[closest][0] = 1
    assert rows(got) == sorted(((*k, *v) for k, v in want.items()), key=str)
    assert rows(label.match_counts(panel_df, events_df)) == [(matched, len(table) - matched)]

    summary = label.label_summary(label.label_acquisitions(panel_df, events_df)).collect()[0]
    positives = [row for row, v in want.items() if v[0]]
    assert (summary.total_rows, summary.total_acquired) == (len(panel), len(positives))
    assert summary.years_covered == sorted({row[2].year for row in positives})
    several = label.multi_label_firms(label.label_acquisitions(panel_df, events_df)).collect()
    for r in several:
        assert r.n == sum(row[0] == r.gvkey for row in positives) > 1


def test_an_event_on_a_panel_date_labels_only_earlier_rows(spark):
    panel = spark.createDataFrame([(1, 1, START), (1, 1, START + timedelta(days=30))], "gvkey long, iid int, date date")
    events = spark.createDataFrame(
        [(1, 1, START + timedelta(days=30), "acquisition", "A", 1.0), (2, 1, START, "acquisition", "B", 2.0)],
        "seq long, gvkey long, actual_date date, actual_event_type string, acquirer string, acquisition_price double",
    )
    got = rows(label.label_acquisitions(panel, events).select("date", "is_acquired", "acquirer"))
    assert got == [(START, 1, "A"), (START + timedelta(days=30), 0, None)]


def test_cleaning_of_verdicts(spark):
    table = [
        (1, 7, "Acquisition", "True", "1999-03-01"),
        (2, 7, "acquisition", "TRUE", "1999-03-01"),
        (3, 7, "acquisition", "False", "1999-04-01"),
        (4, 7, "merger", "True", "1999-05-01"),
        (5, 7, "acquisition", "True", "2014-12-31"),
        (6, 7, "acquisition", "True", "2014-11-30"),
        (7, 7, "acquisition", "True", "soon"),
        (8, 7, "acquisition", None, "1999-06-01"),
        (9, 7, "acquisition", "true", None),
    ]
    verdicts = spark.createDataFrame(
        [(*r, "X", 1.0) for r in table],
        "seq long, gvkey long, actual_event_type string, verified string, actual_date_raw string, acquirer string, acquisition_price double",
    )
    assert [r[0] for r in rows(workflows.clean_acquisitions(verdicts), "seq")] == [1, 6]


def test_a_halt_without_end_makes_no_days_outside_the_panel(spark):
    panel = spark.createDataFrame([(1, 1, date(2000, m, 1)) for m in range(1, 7)], "gvkey long, iid int, date date")
    events = spark.createDataFrame(
        [(1, 1, "halt", date(2000, 3, 1), date(9999, 1, 1), "high", "d")],
        "seq long, gvkey long, actual_event_type string, event_date date, halt_end_date date, llm_confidence string, details string",
    )
    got = label.label_windows(panel, events)
    assert [r.event_label for r in got.orderBy("date").collect()] == ["none", "none", "halt", "halt", "halt", "halt"]
