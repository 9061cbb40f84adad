"""Detectors on small hand-made firms: limits, short histories, ties, missing columns."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import events as ev
from panelwatch.operators import names, normalize, profile
from panelwatch.plans import detectors

END = date(2005, 12, 31)


def firm(gvkey, n=30, days_before_end=0, step=30, price=lambda i: 10.0, **columns):
    """n rows, the last one ``days_before_end`` days before END; column functions get the row from the end."""
    last = END - timedelta(days=days_before_end)
    return [
        {
            "gvkey": gvkey, "iid": 1, "date": last - timedelta(days=step * i), "price": price(i),
            **{c: f(i) if callable(f) else f for c, f in columns.items()},
        }
        for i in range(n)
    ]


def panel_of(spark, *firms):
    """Panel with a firm 0 that trades until END and has no signal at all."""
    table = [r for f in (firm(0), *firms) for r in f]
    columns = dict.fromkeys(c for r in table for c in r)
    types = {"gvkey": "long", "iid": "int", "date": "date"}
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in columns)
    random.Random(0).shuffle(table)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in table], schema).repartition(3)


def no_names(spark):
    return spark.createDataFrame([], "gvkey long, company_name string")


def scores(df, column="detection_score"):
    return {r.gvkey: r[column] for r in df.collect()}


def test_bankruptcy_limits(spark):
    table = panel_of(
        spark,
        firm(1, z_score=1.8), firm(2, z_score=1.79), firm(3, z_score=3.0), firm(4, z_score=float("nan")),
        firm(5, o_score=0.5), firm(6, o_score=0.51), firm(7, o_score=0.3),
        firm(8, days_before_end=180), firm(9, days_before_end=181), firm(10, days_before_end=120),
        firm(11, days_before_end=121), firm(12, n=23, z_score=0.0), firm(13, n=24, z_score=0.0),
        firm(14, ni_be=-0.05), firm(15, f_score=3.0), firm(16, zero_trades_252d=61.0),
        firm(17, z_score=lambda i: None if i == 0 else 0.0),
    )
    table = normalize.nan_as_null(table)
    got = scores(detectors.detect_bankruptcy(table, no_names(spark), threshold=0))
    assert got == {
        0: 0, 1: 8, 2: 15, 3: 0, 4: 0, 5: 8, 6: 15, 7: 0, 8: 10, 9: 20, 10: 0, 11: 10, 13: 15, 14: 3, 15: 5, 16: 5, 17: 0,
    }


def test_price_change_is_taken_over_24_rows_and_survives_zero(spark):
    table = panel_of(
        spark,
        firm(1, price=lambda i: 1.0 if i == 0 else 10.0),
        firm(2, n=40, price=lambda i: 1.0 if i >= 24 else 10.0),
        firm(3, price=lambda i: -1.0 if i == 0 else 0.0),
        firm(4, price=lambda i: 1.0 if i == 0 else 0.0),
        firm(5, price=lambda i: 0.0),
        firm(6, price=lambda i: -10.0 if i == 23 else -1.0),
        firm(7, price=lambda i: None if i == 0 else 1.0),
    )
    got = {r.gvkey: r for r in detectors.detect_bankruptcy(table, no_names(spark), threshold=0).collect()}
    assert {k: r.detection_score for k, r in got.items()} == {0: 0, 1: 15, 2: 0, 3: 15, 4: 0, 5: 0, 6: 15, 7: 0}
    assert got[1].reasons == "Price dropped -90.0%"
    assert got[3].reasons == "Price dropped -inf%"
    assert got[5].price_change_60d is None


def test_merger_gate_and_rejection(spark):
    table = panel_of(
        spark,
        firm(1, days_before_end=119), firm(2, days_before_end=120), firm(3, days_before_end=121),
        firm(4, days_before_end=200, z_score=1.0, ni_be=-0.2),
        firm(5, days_before_end=200, z_score=1.0, price=lambda i: 1.0 if i == 0 else 10.0),
        firm(6, days_before_end=200, eqnpo_me=lambda i: 0.1 if i < 5 else 0.09),
        firm(7, days_before_end=200, eqnpo_me=lambda i: 0.08),
    )
    got = {r.gvkey: r for r in detectors.detect_merger(table, no_names(spark), threshold=0).collect()}
    assert {k: r.detection_score for k, r in got.items()} == {2: 20, 3: 35, 4: 35, 6: 40, 7: 35}
    assert got[6].confidence == "medium" and got[6].reasons.endswith("; Payout increased; Trading stopped 200 days before dataset end")


def test_single_pass_has_a_dead_zone_and_one_event_per_firm(spark):
    stable = dict(ni_be=0.1)
    table = panel_of(
        spark,
        firm(1, days_before_end=366, z_score=1.0, o_score=0.6, ni_be=-0.3),
        firm(2, days_before_end=366, z_score=1.0, o_score=0.6),
        firm(3, days_before_end=240, z_score=2.0, **stable),
        firm(4, days_before_end=239, z_score=2.0, **stable),
        firm(5, days_before_end=365, z_score=1.0, **stable),
        firm(6, n=9, days_before_end=366, z_score=1.0),
    )
    got = rows(detectors.detect_single_pass(table, no_names(spark), 55, 48).select("gvkey", "event_type", "detection_score"))
    assert got == [(1, "bankruptcy", 60), (3, "merger", 48)]


def test_rule_sets_adapt_to_missing_columns(spark):
    table = panel_of(spark, firm(1, days_before_end=181))
    assert scores(detectors.detect_bankruptcy(table, no_names(spark), threshold=0)) == {0: 0, 1: 20}
    assert detectors.detect_ipo(table, no_names(spark)).count() == 0


def test_partitioning_changes_nothing(spark):
    rnd = random.Random(3)
    wide = dict.fromkeys(
        ["ami_126d", "turnover_126d", "dolvol_126d", "bidaskhl_21d", "z_score", "ni_be", "eqnpo_me", "volume"],
        lambda i: rnd.choice([None, rnd.random(), rnd.random() * 5]),
    )
    firms = [
        firm(g, n=rnd.randint(20, 80), days_before_end=rnd.choice([0, 150, 400]), price=lambda i: rnd.choice([1.0, 2.0, 9.0]), **wide)
        for g in range(1, 8)
    ]
    table = panel_of(spark, *firms)
    for detect in (detectors.detect_all, detectors.detect_stock_split, detectors.detect_data_errors):
        plain = rows(detect(table, no_names(spark)))
        assert plain == rows(detect(table.repartition(7), no_names(spark)))


def test_two_share_classes_are_ordered_by_class(spark):
    one = [dict(r, iid=1, price=10.0) for r in firm(1, n=12)]
    two = [dict(r, iid=2, price=5.0) for r in firm(1, n=12)]
    got = detectors.detect_stock_split(panel_of(spark, one, two), no_names(spark))
    assert sorted({r.split_type for r in got.collect()}) == ["2:1 split"]
    assert got.count() == 12


@pytest.mark.parametrize("drop, kind", [(0.5, "2:1 split"), (0.481, "2:1 split"), (0.479, None), (0.67, "3:1 split"), (0.76, "4:1 split")])
def test_split_ratios(spark, drop, kind):
    table = panel_of(spark, firm(1, n=2, price=lambda i: 100.0 * (1 - drop) if i == 0 else 100.0, volume=lambda i: 16.0 if i == 0 else 10.0))
    got = detectors.detect_stock_split(table, no_names(spark)).collect()
    assert [(r.split_type, r.detection_score) for r in got] == ([(kind, 25)] if kind else [])


@pytest.mark.parametrize(
    "before, after, flagged",
    [(20.0, 120.1, True), (20.0, 120.0, False), (5.0, 56.0, True), (5.0, 54.0, False), (1.0, 22.0, True),
     (0.10, 5.3, True), (0.10, 5.0, False), (0.09, 9.2, True), (0.0, 100.0, False), (-1.0, 100.0, False)],
)
def test_jump_limits_by_price_level(spark, before, after, flagged):
    table = panel_of(spark, firm(1, n=2, price=lambda i: after if i == 0 else before))
    got = detectors.detect_data_errors(table, no_names(spark)).where(F.col("reasons").contains("jump"))
    assert (got.count() == 1) == flagged


def loop_islands(dates, min_days=120):
    """Runs of gap rows over a firm's rows in order, the way the definition reads."""
    runs, run = [], None
    for before, d in zip(dates, dates[1:]):
        if (d - before).days >= min_days:
            run = run or [before, d, 0, 0, False]
            run[1:4] = [d, run[2] + (d - before).days, run[3] + 1]
        elif run:
            runs.append((*run[:4], True))
            run = None
    return runs + ([(*run[:4], False)] if run else [])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gap_islands_against_a_loop(spark, seed):
    rnd = random.Random(seed)
    table, want = [], []
    for g in range(30):
        d, dates = date(2000, 1, 1), []
        for _ in range(rnd.randint(8, 20)):
            dates += [d] * rnd.choice([1, 1, 1, 2])
            d += timedelta(days=rnd.choice([30, 30, 119, 120, 179, 180, 364, 365]))
        table += [(g, i, x) for i, x in enumerate(dates)]
        if len(dates) >= 10:
            want += [(g, *r) for r in loop_islands(dates)]
    got = detectors.halt_islands(spark.createDataFrame(table, "gvkey long, iid int, date date").repartition(4))
    assert rows(got.select("gvkey", "start_date", "end_date", "total_gap_days", "consecutive_gaps", "resumed")) == sorted(want, key=str)


def test_halt_points(spark):
    def dated(g, *gaps):
        d, out = date(2000, 1, 1), []
        for days in (*[30] * 8, *gaps):
            out.append((g, 1, d))
            d += timedelta(days=days)
        return [*out, (g, 1, d)]

    table = dated(1, 150, 30) + dated(2, 150) + dated(3, 150, 150, 30) + dated(4, 400, 30) + dated(5, 200, 30)
    df = spark.createDataFrame(table, "gvkey long, iid int, date date").withColumn("ticker", F.col("gvkey").cast("string"))
    got = {r.gvkey: (r.detection_score, r.reasons) for r in detectors.detect_halt(df, no_names(spark), threshold=0).collect()}
    assert got == {
        1: (35, "150-day gap; Trading resumed; Short halt (likely temporary)"),
        2: (20, "150-day gap; Short halt (likely temporary)"),
        3: (35, "300-day halt period (2 consecutive gaps); Trading resumed; Medium halt; Multiple consecutive gaps (2)"),
        4: (25, "400-day gap; Trading resumed"),
        5: (30, "200-day gap; Trading resumed; Medium halt"),
    }
    best = {r.gvkey: r.score for r in detectors.score_single_halts(df).collect()}
    assert best == {1: 35, 3: 35, 4: 25, 5: 25}
    assert detectors.detect_halt_simple(df).where("ticker = '3'").count() == 2


def test_ipo_by_age_and_months(spark):
    table = panel_of(
        spark,
        firm(1, n=3, age=1.0), firm(2, n=3, age=2.5), firm(3, n=3, age=3.0), firm(4, n=3, age=None), firm(5, n=29, age=1.0),
    )
    assert sorted(scores(detectors.detect_ipo(table, no_names(spark)))) == [1, 2]
    simple = detectors.detect_ipo_simple(normalize.simple_dialect(table))
    got = {r.ticker: (r.event_type, r.confidence) for r in simple.collect()}
    assert got == {"1_1": ("ipo", "high"), "2_1": ("uncertain_ipo", "medium"), "3_1": ("uncertain_ipo", "medium"), "4_1": ("ipo", "medium")}


def test_names_keep_a_listed_firm_even_without_a_name(spark):
    primary = spark.createDataFrame(
        [(1, 1, date(2000, 1, 1), "Old"), (1, 2, date(2001, 1, 1), None), (2, 3, date(2000, 1, 1), None),
         (3, 4, None, "Undated"), (3, 5, date(2010, 1, 1), "Dated"), (None, 6, date(2000, 1, 1), "Nobody")],
        "gvkey long, seq long, datadate date, conm string",
    )
    secondary = spark.createDataFrame(
        [(2, 1, "Second"), (4, 2, "  "), (5, 3, "First"), (5, 4, "Last")], "gvkey long, seq long, conm string"
    )
    known = names.company_names(primary, secondary)
    assert rows(known) == [(1, "Old"), (2, None), (3, "Undated"), (5, "Last")]
    found = spark.createDataFrame([(g,) for g in range(1, 7)], "gvkey long")
    assert rows(names.attach_names(found, known)) == [
        (1, "Old"), (2, None), (3, "Undated"), (4, "Unknown"), (5, "Last"), (6, "Unknown"),
    ]


def test_best_event_prefers_priority_then_score(spark):
    options = spark.createDataFrame(
        [(1, 2, 90, "m"), (1, 1, 50, "b"), (1, 1, 60, "c"), (2, 2, 10, "d")],
        "gvkey long, priority int, detection_score int, reasons string",
    ).withColumn("event_date", F.lit(END))
    assert rows(ev.best_events(options).select("gvkey", "reasons")) == [(1, "c"), (2, "d")]


def test_missing_patterns_status(spark):
    as_of = date(2006, 1, 1)
    table = [(str(g), as_of - timedelta(days=back + 30 * i)) for g, back in ((1, 366), (2, 365), (3, 91), (4, 90)) for i in range(3)]
    table += [("5", as_of - timedelta(days=40 * i)) for i in range(8)] + [("6", as_of)]
    got = profile.missing_patterns(spark.createDataFrame(table, "ticker string, date date"), as_of)
    assert {r.ticker: (r.n_gaps, r.max_gap_days, r.status) for r in got.collect()} == {
        "1": (0, 30, "likely_delisted"), "2": (0, 30, "possibly_delisted"), "3": (0, 30, "possibly_delisted"),
        "4": (0, 30, "active"), "5": (7, 40, "many_gaps"), "6": (0, 0, "active"),
    }
