"""The rule tables.  Points, limits and reason texts are fixed values."""

from __future__ import annotations

from ..functions.points import Rule, Tier
from ..functions.scalars import number_text
from ..operators.features import Features


def text(*parts: str) -> str:
    """SQL concatenation; a part in quotes is literal, any other is an expression."""
    return f"concat({', '.join(parts)})"


def percent(value: str, places: int = 1) -> str:
    return number_text(f"({value} * 100)", places)


def level(column: str, *tiers: tuple[str, int, str]) -> Rule:
    """Rule on the last value of one column; each tier is (test, points, reason SQL)."""
    value = f"{column}_last"
    return Rule((value,), tuple(Tier(f"{value} {test}", points, reason) for test, points, reason in tiers))


def recent_to_median(column: str, k: int) -> str:
    """Mean of the last k rows over the median of all rows, missing unless the median is positive."""
    return f"(CASE WHEN {column}_med > 0 THEN {column}_m{k} / {column}_med END)"


def price_fall(*tiers: tuple[str, int]) -> Rule:
    reason = text("'Price dropped '", percent("price_change"), "'%'")
    return Rule(("price_change",), tuple(Tier(f"price_change < {limit}", points, reason) for limit, points in tiers))


def stopped(*tiers: tuple[int, int, str, str]) -> Rule:
    """Rule on ``days_since``; each tier is (days, points, text before, text after)."""
    return Rule(
        ("days_since",),
        tuple(
            Tier(f"days_since > {days}", points, text(f"'{before}'", "days_since", f"'{after}'"))
            for days, points, before, after in tiers
        ),
    )


def _two(column: str) -> str:
    return number_text(f"{column}_last", 2)


def _whole(column: str) -> str:
    return number_text(f"{column}_last", 0)


def _z_tiers(column: str, label: str) -> Rule:
    return level(
        column,
        ("< 1.8", 15, text(f"'{label} '", _two(column), "' (bankruptcy zone)'")),
        ("< 3.0", 8, text(f"'{label} '", _two(column), "' (gray zone)'")),
    )


def _roe(column: str) -> str:
    return text("'ROE '", percent(f"{column}_last"), "'%'")


_AMI = recent_to_median("ami_126d", 12)
_TURNOVER_FALL = f"(1 - {recent_to_median('turnover_126d', 12)})"
_VOLUME_FALL = f"(1 - {recent_to_median('dolvol_126d', 12)})"
_VOLUME_RISE = recent_to_median("dolvol_126d", 6)
_VOLUME_FELL = text("'Volume collapsed '", percent(_VOLUME_FALL, 0), "'%'")
_SPREAD_CHANGE = "(CASE WHEN bidaskhl_21d_med > 0 THEN (bidaskhl_21d_m6 - bidaskhl_21d_med) / bidaskhl_21d_med END)"
_DOLVOL = ("dolvol_126d_m12", "dolvol_126d_med")
_DOLVOL_6 = ("dolvol_126d_m6", "dolvol_126d_med")

BANKRUPTCY_FEATURES = Features(
    last=(
        "z_score", "o_score", "kz_index", "ni_be", "ocf_at", "ebitda_mev", "zero_trades_252d",
        "bidaskhl_21d", "at_be", "debt_me", "f_score", "ni_ar1",
    ),
    recent={"ami_126d": (12,), "turnover_126d": (12,), "dolvol_126d": (12,)},
    medians=("ami_126d", "turnover_126d", "dolvol_126d"),
)

BANKRUPTCY = [
    _z_tiers("z_score", "Altman Z-score"),
    level(
        "o_score",
        ("> 0.5", 15, text("'Ohlson O-score '", _two("o_score"), "' (high risk)'")),
        ("> 0.3", 8, text("'Ohlson O-score '", _two("o_score"), "' (elevated risk)'")),
    ),
    level("kz_index", ("< -3.0", 10, text("'KZ index '", _two("kz_index"), "' (constrained)'"))),
    level("ni_be", ("< -0.20", 10, _roe("ni_be")), ("< -0.10", 5, _roe("ni_be")), ("< 0", 3, "'ROE negative'")),
    level(
        "ocf_at",
        ("< -0.05", 10, text("'Operating CF '", percent("ocf_at_last"), "'%'")),
        ("< 0", 5, "'Operating CF negative'"),
    ),
    level("ebitda_mev", ("< 0", 8, "'Negative EBITDA/EV'")),
    level(
        "zero_trades_252d",
        ("> 90", 10, text(_whole("zero_trades_252d"), "' zero-trade days (>3m)'")),
        ("> 60", 5, text(_whole("zero_trades_252d"), "' zero-trade days (>2m)'")),
        ("> 30", 3, text(_whole("zero_trades_252d"), "' zero-trade days (>1m)'")),
    ),
    Rule(
        ("ami_126d_m12", "ami_126d_med"),
        (Tier(f"{_AMI} > 5", 8, text("'Illiquidity spike '", number_text(_AMI, 1), "'x'")),),
    ),
    Rule(
        ("bidaskhl_21d_last", "spread_p85"),
        (Tier("bidaskhl_21d_last > spread_p85", 5, "'Wide bid-ask spread (>85th pct)'"),),
    ),
    Rule(
        ("turnover_126d_m12", "turnover_126d_med"),
        (Tier(f"{_TURNOVER_FALL} > 0.60", 5, text("'Turnover declined '", percent(_TURNOVER_FALL, 0), "'%'")),),
    ),
    level("at_be", ("> 0.7", 8, text("'High leverage '", _two("at_be")))),
    level("debt_me", ("> 1.5", 5, text("'Debt-to-market '", _two("debt_me")))),
    level(
        "f_score",
        ("< 3", 10, text("'Pitroski F-score '", _whole("f_score"))),
        ("< 4", 5, text("'Pitroski F-score '", _whole("f_score"))),
    ),
    level("ni_ar1", ("< 0", 5, "'Negative earnings persistence'")),
    stopped((180, 20, "Stopped trading ", " days before dataset end"), (120, 10, "Stopped trading ", " days before dataset end")),
    price_fall(("-0.80", 15), ("-0.60", 8), ("-0.40", 4)),
    Rule(_DOLVOL, (Tier(f"{_VOLUME_FALL} > 0.80", 8, _VOLUME_FELL), Tier(f"{_VOLUME_FALL} > 0.70", 4, _VOLUME_FELL))),
]

MERGER_FEATURES = Features(
    last=("z_score", "ni_be", "ocf_at", "zero_trades_21d"),
    recent={"dolvol_126d": (6,), "bidaskhl_21d": (6,)},
    medians=("dolvol_126d", "bidaskhl_21d"),
    before_last={"eqnpo_me": 5},
)

_STABLE = "price_change > -0.15 AND price_change < 0.50"
_STABLE_TEXT = text("'Price stable ('", percent("price_change"), "'%)'")
_SPIKE = Tier(f"{_VOLUME_RISE} > 2.0", 15, text("'Volume spike '", number_text(_VOLUME_RISE, 1), "'x'"))
_ELEVATED = Tier(f"{_VOLUME_RISE} > 1.5", 8, text("'Volume elevated '", number_text(_VOLUME_RISE, 1), "'x'"))
_HEALTHY_Z = level("z_score", ("> 1.8", 5, text("'Healthy Z-score '", _two("z_score"))))

MERGER = [
    Rule(
        ("price_change",),
        (
            Tier(_STABLE, 20, _STABLE_TEXT),
            Tier(
                "price_change > -0.25 AND price_change < 1.00",
                10,
                text("'Price moderately stable ('", percent("price_change"), "'%)'"),
            ),
        ),
    ),
    Rule(_DOLVOL_6, (_SPIKE, _ELEVATED)),
    Rule(("bidaskhl_21d_m6", "bidaskhl_21d_med"), (Tier(f"{_SPREAD_CHANGE} < -0.20", 10, "'Bid-ask spread tightened'"),)),
    level("zero_trades_21d", ("< 5", 8, "'Active trading (low zero-trade days)'")),
    level("ni_be", ("> 0", 8, "'Positive ROE'")),
    level("ocf_at", ("> 0", 8, "'Positive operating CF'")),
    _HEALTHY_Z,
    Rule(("eqnpo_me_rises",), (Tier("eqnpo_me_rises", 5, "'Payout increased'"),)),
    stopped((120, 15, "Trading stopped ", " days before dataset end")),
]

# Points against a merger: signs that the firm failed instead.
NOT_MERGER = [
    level("z_score", ("< 1.8", 15, "NULL")),
    Rule(("price_change",), (Tier("price_change < -0.50", 15),)),
    level("ni_be", ("< -0.10", 10, "NULL")),
]

SINGLE_FEATURES = Features(
    last=("z_score", "o_score", "ni_be", "zero_trades_252d"),
    recent={"dolvol_126d": (6, 12)},
    medians=("dolvol_126d",),
)

SINGLE_BANKRUPTCY = [
    _z_tiers("z_score", "Z-score"),
    level("o_score", ("> 0.5", 15, text("'O-score '", _two("o_score"), "' (high risk)'"))),
    level("ni_be", ("< -0.20", 10, _roe("ni_be")), ("< 0", 5, "'Negative ROE'")),
    level("zero_trades_252d", ("> 90", 10, text(_whole("zero_trades_252d"), "' zero-trade days'"))),
    Rule(_DOLVOL, (Tier(f"{_VOLUME_FALL} > 0.80", 8, _VOLUME_FELL),)),
    stopped((365, 20, "Stopped trading ", " days early")),
    price_fall(("-0.80", 15)),
]

SINGLE_MERGER = [
    Rule(("price_change",), (Tier(_STABLE, 20, _STABLE_TEXT),)),
    Rule(_DOLVOL_6, (_SPIKE,)),
    level("ni_be", ("> 0", 8, "'Positive ROE'")),
    _HEALTHY_Z,
    stopped((120, 15, "Trading stopped ", " days early")),
]

_SIMPLE_RISE = recent_to_median("dollar_volume", 6)

SIMPLE_BANKRUPTCY_FEATURES = Features(last=("altman_z_score", "ohlson_o_score", "return_on_equity", "zero_trades_12m"))

SIMPLE_BANKRUPTCY = [
    _z_tiers("altman_z_score", "Altman Z-score"),
    level(
        "ohlson_o_score",
        ("> 0.5", 15, text("'Ohlson O-score '", _two("ohlson_o_score"), "' (high risk)'")),
        ("> 0.3", 8, text("'Ohlson O-score '", _two("ohlson_o_score"), "' (elevated risk)'")),
    ),
    level(
        "return_on_equity",
        ("< -0.20", 10, _roe("return_on_equity")),
        ("< -0.10", 5, _roe("return_on_equity")),
        ("< 0", 3, "'ROE negative'"),
    ),
    level(
        "zero_trades_12m",
        ("> 90", 10, text(_whole("zero_trades_12m"), "' zero-trade days (3+ months)'")),
        ("> 60", 5, text(_whole("zero_trades_12m"), "' zero-trade days (2+ months)'")),
    ),
    price_fall(("-0.80", 15), ("-0.60", 8)),
    stopped((180, 20, "No trading for ", " days (6+ months)"), (90, 10, "No trading for ", " days (3+ months)")),
]

SIMPLE_MERGER_FEATURES = Features(
    last=("altman_z_score", "return_on_equity"),
    recent={"dollar_volume": (6,)},
    medians=("dollar_volume",),
)

SIMPLE_MERGER = [
    Rule(("price_change",), (Tier(_STABLE, 20, _STABLE_TEXT),)),
    Rule(
        ("dollar_volume_m6", "dollar_volume_med"),
        (
            Tier(f"{_SIMPLE_RISE} > 2.0", 15, text("'Volume spike '", number_text(_SIMPLE_RISE, 1), "'x'")),
            Tier(f"{_SIMPLE_RISE} > 1.5", 8, text("'Volume elevated '", number_text(_SIMPLE_RISE, 1), "'x'")),
        ),
    ),
    level("return_on_equity", ("> 0", 8, "'Positive ROE'")),
    stopped((90, 15, "Trading stopped ", " days ago (3+ months)")),
]

SIMPLE_NOT_MERGER = [
    level("altman_z_score", ("< 1.8", 15, "NULL")),
    Rule(("price_change",), (Tier("price_change < -0.50", 15),)),
]

_GAP = "'-day gap'"
_RESUMED = Rule(("resumed",), (Tier("resumed", 15, "'Trading resumed'"),))

HALT = [
    Rule(
        ("total_gap_days", "consecutive_gaps"),
        (
            Tier(
                "total_gap_days >= 120 AND consecutive_gaps > 1",
                10,
                text("total_gap_days", "'-day halt period ('", "consecutive_gaps", "' consecutive gaps)'"),
            ),
            Tier("total_gap_days >= 120", 10, text("total_gap_days", _GAP)),
        ),
    ),
    _RESUMED,
    Rule(
        ("total_gap_days",),
        (
            Tier("total_gap_days < 180", 10, "'Short halt (likely temporary)'"),
            Tier("total_gap_days < 365", 5, "'Medium halt'"),
        ),
    ),
    Rule(
        ("consecutive_gaps",),
        (Tier("consecutive_gaps > 1", 5, text("'Multiple consecutive gaps ('", "consecutive_gaps", "')'")),),
    ),
]

# A single-pass halt only counts if trading resumed, so the base points name both reasons.
SINGLE_HALT = [
    Rule(("gap_days",), (Tier("gap_days >= 120", 25, text("gap_days", _GAP)),)),
    Rule(("next_date",), (Tier("next_date IS NOT NULL", 0, "'Trading resumed'"),)),
    Rule(("gap_days",), (Tier("gap_days < 180", 10, "'Short halt'"),)),
]

SIMPLE_HALT = [
    Rule(("gap_days",), (Tier("gap_days >= 90", 10, text("gap_days", "'-day gap (3+ months)'")),)),
    _RESUMED,
    Rule(
        ("gap_days",),
        (Tier("gap_days < 180", 10, "'Short gap (likely halt)'"), Tier("gap_days < 365", 5, "'Medium gap'")),
    ),
]

# Price changes that mean a split, and how near a change must be.
SPLIT_RATIOS = {-0.50: "2:1 split", -0.67: "3:1 split", -0.75: "4:1 split"}
SPLIT_TOLERANCE = 0.02

SPLIT = [
    Rule(
        ("change", "split_type"),
        (Tier("true", 15, text("'Price drop '", percent("change"), "'% (matches '", "split_type", "')'")),),
    ),
    Rule(("prev_volume",), (Tier("prev_volume > 0 AND volume > prev_volume * 1.5", 10, "'Volume spike'"),)),
]

_NEGATIVE = Rule(("price",), (Tier("price < 0", 20, "'Negative price'"),))
_JUMP_TEXT = text("'Extreme jump '", percent("jump", 0), "'%'")

# The cheaper the share was, the larger a jump must be to look wrong.
_JUMP_LIMIT = (
    "CASE WHEN prev_price >= 20 THEN 5.0D WHEN prev_price >= 5 THEN 10.0D WHEN prev_price >= 1 THEN 20.0D "
    "WHEN prev_price >= 0.10 THEN 50.0D ELSE 100.0D END"
)

DATA_ERROR = [
    _NEGATIVE,
    Rule(("jump",), (Tier(f"abs(jump) > {_JUMP_LIMIT}", 15, _JUMP_TEXT),)),
    Rule(
        ("volume",),
        (
            Tier("volume = 0 AND price >= 5.0", 8, "'Zero volume (unusual for higher-priced stock)'"),
            Tier("volume = 0 AND price >= 1.0", 3, "'Zero volume (somewhat unusual)'"),
        ),
    ),
]

SIMPLE_DATA_ERROR = [
    _NEGATIVE,
    Rule(("jump",), (Tier("abs(jump) > 10", 15, _JUMP_TEXT),)),
    Rule(("volume",), (Tier("volume = 0", 5, "'Zero volume'"),)),
]
