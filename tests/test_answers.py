"""Reading verifier answers, costs, budgets and stops."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.functions import answers
from panelwatch.operators import verify
from panelwatch.plans import workflows

GOOD = '{"verified": true, "actual_event_type": "merger", "actual_date": "2015-03-04", "llm_confidence": "high", "details": "d", "acquirer": "A {x}", "acquisition_price": 12.5}'

CASES = {
    "bare": (GOOD, GOOD),
    "padded": (f"\n\t {GOOD} \n", GOOD),
    "json fence": (f"Here:\n```json\n{GOOD}\n``` done", GOOD),
    "plain fence": (f"```\n{GOOD}\n```", GOOD),
    "prose around": (f"I found {GOOD} as asked {{really}}.", GOOD),
    "nested": ('x {"a": {"b": 1}} y', '{"a": {"b": 1}}'),
    "no object": ("  nothing found. ", "nothing found."),
    "truncated": ('{"verified": true, "details": ', ""),
    "stray close": ('} then {"a": 1}', '{"a": 1}'),
    "astral": ('\U0001f600 {"details": "\U0001f600"} x', '{"details": "\U0001f600"}'),
    "no text": (None, None),
}


def test_balanced_extraction(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "k string, t string")
    got = dict(rows(df.select("k", answers.balanced_json(F.col("t")))))
    assert got == {k: v[1] for k, v in CASES.items()}


def test_balanced_extraction_on_random_text(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab{}{}\n ") for _ in range(rnd.randint(0, 40))) for _ in range(300)]

    def expected(text):
        if "{" not in text:
            return text.strip(" \n")
        depth, start = 0, text.index("{")
        for i, c in enumerate(text[start:], start):
            depth += (c == "{") - (c == "}")
            if depth == 0:
                return text[start : i + 1]
        return ""

    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = dict(rows(df.select("k", answers.balanced_json(F.col("t")))))
    assert got == {i: expected(t) for i, t in enumerate(texts)}


def test_fenced_extraction_keeps_prose(spark):
    df = spark.createDataFrame([("a", f"I found {GOOD}."), ("b", f"```json\n{GOOD}\n```")], "k string, t string")
    got = dict(rows(df.select("k", answers.fenced_json(F.col("t")))))
    assert got == {"a": f"I found {GOOD}.", "b": GOOD}


@pytest.mark.parametrize(
    "text, ok",
    [
        (GOOD, True),
        (GOOD + " junk", False),
        (GOOD + GOOD, False),
        (GOOD[:-1], False),
        ("[1]", False),
        ("12", False),
        ("{'verified': true}", False),
        ("{}", True),
        ('{"details": "a } brace and a \\" quote"}', True),
        ("", False),
    ],
)
def test_only_one_whole_object_counts(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(answers.parse_verdict(F.col("t")).alias("v")).collect()[0].v
    assert (got is not None) == ok
    if ok:
        wanted = json.loads(text)
        assert got.details == wanted.get("details")
        assert got.verified == wanted.get("verified")


def test_price_given_as_text(spark):
    df = spark.createDataFrame([('{"acquisition_price": "12.5"}',), ('{"acquisition_price": "about 12"}',)], "t string")
    assert [r.v.acquisition_price for r in df.select(answers.parse_verdict(F.col("t")).alias("v")).collect()] == [12.5, None]


def test_of_a_repeated_key_the_last_counts(spark):
    df = spark.createDataFrame([('{"verified": true, "details": "a", "verified": false}',)], "t string")
    got = df.select(answers.parse_verdict(F.col("t")).alias("v")).collect()[0].v
    assert got.verified is False and got.details == "a"


def test_errors_and_stops(spark):
    table = [
        (1, GOOD, None),
        (2, "no", None),
        (3, GOOD, "Error 429: RATE_LIMIT"),
        (4, GOOD, "connection reset"),
        (5, '{"actual_date": "N/A"}', None),
    ]
    df = spark.createDataFrame(table, "seq long, response_text string, error_text string")
    got = {r.seq: r for r in verify.verdicts_from_answers(df).collect()}
    assert [got[i].stop for i in range(1, 6)] == [False, False, True, False, False]
    assert [got[i].failed for i in range(1, 6)] == [False, True, True, True, False]
    assert got[1].verified and got[1].actual_date == "2015-03-04"
    assert got[2].details.startswith("Error: ") and got[3].details == "API error: Error 429: RATE_LIMIT"
    assert got[5].verified is False and got[5].actual_date is None
    assert rows(verify.before_stop(verify.verdicts_from_answers(df)).select("seq")) == [(1,), (2,)]


def test_budget_met_exactly_ends_the_run(spark):
    df = spark.createDataFrame([(i, 0.25) for i in range(6)], "seq long, c double").select(
        "seq", F.col("c").cast("decimal(20,12)").alias("cost")
    )
    got = rows(verify.admit_within_budget(df, "0.75").select("seq", "admitted", "percent_used"), "seq")
    assert [r[1] for r in got] == [True, True, True, False, False, False]
    assert got[2][2] == pytest.approx(200 / 3)
    assert all(r[0] for r in verify.admit_within_budget(df, None).select("admitted").collect())


def test_cost_uses_quarter_length_tokens(spark):
    df = spark.createDataFrame([("x" * 4003, "y" * 399)], "p string, a string")
    known = df.select(answers.request_cost(F.col("p"), F.col("a"))).collect()[0][0]
    assert float(known) == pytest.approx(1000 / 1e6 * 0.25 + 99 / 1e6 * 1.25)
    other = df.select(answers.request_cost(F.col("p"), F.col("a"), "other")).collect()[0][0]
    assert float(other) == pytest.approx(0.0003)


def test_prices_of_many_models_from_a_table(spark):
    listed = [("small", "0.25", "1.25", None), ("small", "0.20", "1.25", None), ("flat", None, None, "0.003"), ("half", "1", None, None), (None, "9", "9", None)]
    prices = spark.createDataFrame(listed, "model string, per_input string, per_output string, per_call string")
    calls = [(1, "small", None), (2, "flat", None), (3, "half", None), (4, "unlisted", None), (5, None, None), (6, "small", "timeout")]
    df = spark.createDataFrame([(s, m, "x" * 4003, "y" * 399, e) for s, m, e in calls], "seq long, model string, prompt string, response_text string, error_text string")
    by_tokens = 1000 / 1e6 * 0.25 + 99 / 1e6 * 1.25
    got = verify.with_cost(df, "small", prices)
    assert got.columns == [*df.columns, "cost"] and got.schema["cost"].dataType.simpleString() == "decimal(20,12)"
    want = {1: by_tokens, 2: 0.003, 3: 0.0003, 4: 0.0003, 5: by_tokens, 6: 0}
    assert {r.seq: float(r.cost) for r in got.collect()} == pytest.approx(want)
    assert rows(got.where("model = 'small'").select("cost")) == rows(verify.with_cost(df).where("model = 'small'").select("cost"))
    one = verify.with_cost(df.drop("model"), "flat", prices)  # no model in the rows: one for all
    assert {float(r.cost) for r in one.where("seq < 6").collect()} == {0.003}
    none = verify.with_cost(df, "small", prices.limit(0))
    assert {float(r.cost) for r in none.where("seq < 6").collect()} == {0.0003}


def test_reverify_year_against_a_loop(spark):
    rnd = random.Random(2)
    events, responses = [], []
    for seq in range(1, 400):
        day = rnd.choice(["2015-02-03", "2014-01-01", "bad", None])
        events.append((seq, seq % 20, rnd.choice(["Firm", "Unknown", "", None]), "merger", day, None if seq % 3 else "old"))
        error = rnd.choice(["quota exceeded"] + ["timeout"] * 3 + [None] * 40) if seq > 200 else None
        answer = rnd.choice([GOOD, "nothing", '{"verified": false, "actual_date": "null"}'])
        responses.append((seq, "p" * 4000, answer + " " * rnd.randint(0, 3000), error))
    budget = 0.05
    want = {e[0]: (None, None, e[5]) for e in events}
    spent, position = 0.0, 0
    for (seq, _, name, _, day, _), (_, prompt, answer, error) in zip(events, responses):
        if day != "2015-02-03" or name in ("Unknown", "", None):
            continue
        position += 1
        if position <= 13:
            continue
        if spent >= budget:
            break
        if error and "quota" in error:
            break
        if error is None:
            spent += len(prompt) // 4 * 0.25e-6 + len(answer) // 4 * 1.25e-6
        try:
            verdict = json.loads(answer) if error is None else None
        except ValueError:
            verdict = None
        if verdict is None:
            want[seq] = (False, "error", None)
        else:
            found = verdict.get("actual_date")
            want[seq] = (verdict["verified"], verdict.get("actual_event_type"), None if found == "null" else found)
    got = workflows.reverify_year(
        spark.createDataFrame(
            events, "seq long, gvkey long, company_name string, event_type string, event_date string, actual_date string"
        ),
        spark.createDataFrame(responses, "seq long, prompt string, response_text string, error_text string"),
        2015,
        13,
        str(budget),
    )
    found = {r.seq: (r.verified, r.actual_event_type, r.actual_date) for r in got.collect()}
    assert found == want
    assert sum(v[0] is not None for v in want.values()) > 10


@pytest.mark.parametrize("filler", ["x" * 100_000, '\\"' * 50_000, "\\\\" * 50_000, "{" * 100_000])
def test_long_texts_are_read_whole(spark, filler):
    text = json.dumps({**json.loads(GOOD), "details": "S"}).replace('"S"', f'"{filler}"')
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(answers.parse_verdict(answers.balanced_json(F.col("t"))).alias("v")).select("v.*").collect()[0]
    # Braces inside a text count for finding the object's end, as they do for its model.
    assert got.details == json.loads(f'"{filler}"') if filler[0] != "{" else got.details is None


def test_queued_events_without_an_answer_get_an_error_verdict(spark):
    events = spark.createDataFrame(
        [(i, i, "Firm" if i else None, "merger", 50, "high", "r") for i in range(4)],
        "seq long, gvkey long, company_name string, event_type string, detection_score int, confidence string, reasons string",
    ).withColumn("event_date", F.lit("2000-01-01").cast("date"))
    given = spark.createDataFrame([(1, GOOD, None), (3, "none", None), (9, GOOD, None)], "seq long, response_text string, error_text string")
    for size in (None, 100):
        got = {r.gvkey: r for r in workflows.verify_queue(events, given, size).collect()}
        assert len(got) == 4 and got[0].skip_reason == "no_company_name" and got[1].verified
        assert got[2].actual_event_type == "error" and got[2].details == "Error during verification: no answer"
        assert got[3].details == "Error during verification: answer is not a JSON object"


def test_requests_name_types_and_allowed_values(spark):
    df = spark.createDataFrame([(1, "F", "merger", 50, "high", "r")], "gvkey long, company_name string, event_type string, detection_score int, confidence string, reasons string")
    df = df.withColumn("event_date", F.lit("2000-01-01").cast("date"))
    for text, kinds in ((verify.request_text(), answers.EVENT_TYPES), (verify.request_text_for_year(2015), answers.YEAR_EVENT_TYPES)):
        shown = df.select(text).collect()[0][0]
        assert all(f"\n{field}: " in shown for field in answers.VERDICT_FIELDS) and ", ".join(kinds) in shown
        assert "high, medium, low" in shown and "YYYY-MM-DD" in shown and "set verified to false" in shown
