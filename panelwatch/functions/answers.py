"""Reading a verifier's free-text answer: find the JSON object, type it, price it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\u000b"
FENCE = "```"

# Texts that stand for "no date", and words in an error that stop the run.
NO_DATE = ("null", "None", "", "N/A", "n/a")
STOP_WORDS = ("rate_limit", "quota", "billing")

# Price per million tokens, (input, output); price of a call to any other model.
PRICES = {"claude-3-5-haiku-20241022": ("0.25", "1.25")}
DEFAULT_PRICE = "0.0003"
PRICED_MODEL = "claude-3-5-haiku-20241022"

VERDICT_FIELDS = (
    "verified",
    "actual_event_type",
    "actual_date",
    "llm_confidence",
    "details",
    "acquirer",
    "acquisition_price",
)


# The event types a verdict may name, for any event and for one year's events.
EVENT_TYPES = (
    "bankruptcy", "merger", "acquisition", "halt", "ipo", "stock_split", "ticker_change", "data_error", "none", "unknown",
)
YEAR_EVENT_TYPES = ("acquisition", "merger", "bankruptcy", "none", "unknown")


def field_guide(kinds: tuple[str, ...]) -> str:
    """One line per field of a verdict: its type and allowed values."""
    values = {
        "verified": "true or false",
        "actual_event_type": "one of " + ", ".join(kinds),
        "actual_date": "text YYYY-MM-DD, or null",
        "llm_confidence": "one of high, medium, low",
        "details": "short text",
        "acquirer": "company name, or null",
        "acquisition_price": "number per share, or null",
    }
    return "\n".join(f"{name}: {values[name]}" for name in VERDICT_FIELDS)


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def _between_fences(text: Column, opening: str) -> Column:
    after = F.get(F.split(text, opening), F.lit(1))
    return _strip(F.get(F.split(after, FENCE), F.lit(0)))


def fenced_json(text: Column) -> Column:
    """Text inside the first json fence, else inside the first fence, else all of it."""
    return (
        F.when(F.contains(text, F.lit(FENCE + "json")), _between_fences(text, FENCE + "json"))
        .when(F.contains(text, F.lit(FENCE)), _between_fences(text, FENCE))
        .otherwise(_strip(text))
    )


def first_braces(text: Column) -> Column:
    """From the first ``{`` to the brace that balances it; empty when none does.

    Walks over braces and the runs between them, so the work is per brace, not per character.
    """
    tail = F.substr(text, F.locate("{", text))
    tokens = F.regexp_extract_all(tail, F.lit(r"([{}]|[^{}]+)"), F.lit(1))
    start = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("depth"), F.lit(0).alias("stop"))

    def step(seen: Column, token: Column) -> Column:
        pos = seen["pos"] + F.length(token)
        depth = seen["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        closes = (seen["stop"] == 0) & (token == "}") & (depth == 0)
        return F.struct(
            pos.alias("pos"), depth.alias("depth"), F.when(closes, pos).otherwise(seen["stop"]).alias("stop")
        )

    stop = F.aggregate(tokens, start, step, lambda seen: seen["stop"])
    return F.substr(tail, F.lit(1), stop)


def balanced_json(text: Column) -> Column:
    """Like :func:`fenced_json`; without a fence, the first balanced object in the prose."""
    return (
        F.when(F.contains(text, F.lit(FENCE)), fenced_json(text))
        .when(F.contains(text, F.lit("{")), first_braces(text))
        .otherwise(_strip(text))
    )


def is_one_object(json: Column) -> Column:
    """True when the text is one object with nothing after it (``from_json`` accepts trailing text)."""
    # Possessive, so that a long text takes neither stack nor second looks.
    bare = F.regexp_replace(json, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'), F.lit(""))
    return json.startswith("{") & (first_braces(bare) == bare)


def parse_verdict(json: Column) -> Column:
    """Struct of the seven verdict fields, NULL when the text is not one well-formed object.

    Scalars are read as text and then cast, so a price given as text still counts.  The lambdas
    bind the text and the parsed object, so that each is worked out once per row.
    """
    fields = ", ".join(f"{name} STRING" for name in VERDICT_FIELDS)
    options = {"columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false"}

    def parsed(text: Column) -> Column:
        return F.when(is_one_object(text), F.from_json(text, f"{fields}, broken STRING", options))

    def typed(raw: Column) -> Column:
        columns = [raw[name].alias(name) for name in VERDICT_FIELDS]
        columns[0] = (F.lower(raw["verified"]) == "true").alias("verified")
        columns[-1] = raw["acquisition_price"].try_cast("double").alias("acquisition_price")
        return F.when(raw.isNotNull() & raw["broken"].isNull(), F.struct(*columns))

    return F.get(F.transform(F.transform(F.array(json), parsed), typed), F.lit(0))


def null_if_no_date(text: Column) -> Column:
    return F.when(~text.isin(*NO_DATE), text)


def is_stop(error_text: Column) -> Column:
    return F.coalesce(F.lower(error_text).rlike("|".join(STOP_WORDS)), F.lit(False))


def tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("long")


def call_cost(prompt: Column, answer: Column, per_input: Column, per_output: Column, per_call: Column) -> Column:
    """Exact decimal dollars, so budgets add up the same in any order.

    Prices are per million tokens; a model without both of them costs ``per_call``, or the default price.
    """
    price = lambda c: c.cast("decimal(8,4)")
    million = F.lit("0.000001").cast("decimal(8,6)")
    dollars = (tokens(prompt).cast("decimal(12,0)") * price(per_input) + tokens(answer).cast("decimal(12,0)") * price(per_output)) * million
    other = F.coalesce(per_call.cast("decimal(20,12)"), F.lit(DEFAULT_PRICE).cast("decimal(20,12)"))
    return F.when(per_input.isNull() | per_output.isNull(), other).otherwise(dollars.cast("decimal(20,12)"))


def request_cost(prompt: Column, answer: Column, model: str = PRICED_MODEL) -> Column:
    """Cost of a call to a model at the built-in prices."""
    per_input, per_output = PRICES.get(model, (None, None))
    return call_cost(prompt, answer, F.lit(per_input), F.lit(per_output), F.lit(None))
