"""Scalar column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 4294967296
HASH_KEY_RANGE = 2147483648
HASH_MIX = 73244475


def rounded(value: Column, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0, so that equal results also hash equally."""
    return F.round(value, digits) + F.lit(0.0)


def is_missing(name: str, dtype: str) -> Column:
    """Null, or NaN for floating point columns."""
    c = F.col(name)
    return c.isNull() | F.isnan(c) if dtype in ("double", "float") else c.isNull()


def unit_hash(key: Column, seed: int = 42, portable: bool = False) -> Column:
    """A repeatable number in [0, 1) per key, whatever the partitioning.

    ``portable`` mixes an integer key with plain 64-bit arithmetic, which other
    SQL engines can repeat; the default accepts any type. Different seeds give
    unrelated numbers.
    """
    if portable:
        folded = F.pmod(key.cast("bigint"), F.lit(HASH_KEY_RANGE))  # keeps every product within 64 bits
        mixed = (folded * F.lit(HASH_MULTIPLIER) + F.lit(seed)) % F.lit(HASH_MODULUS)
        mixed = mixed.bitwiseXOR(F.shiftright(mixed, 16)) * F.lit(HASH_MIX) % F.lit(HASH_MODULUS)
        mixed = mixed.bitwiseXOR(F.shiftright(mixed, 16)) * F.lit(HASH_MIX) % F.lit(HASH_MODULUS)
        return mixed.cast("double") / F.lit(float(HASH_MODULUS))
    mixed = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52))
    return mixed.cast("double") / F.lit(float(1 << 52))


def parse_day(text: Column, pattern: str = "dd-MM-yyyy", strict: bool = True) -> Column:
    """Date from text; ``strict`` fails on bad text, otherwise it becomes null."""
    return F.to_date(text, pattern) if strict else F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def day_parts(day: Column) -> dict[str, Column]:
    """Year, month, day of month and day of week with Monday = 0."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.weekday(day),
    }


def interaction(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def cut_right(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (-inf, b1], (b1, b2], ..., (bk, inf)."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("cut_right needs one more label than bounds")
    out = F.when(value.isNull() | F.isnan(value), F.lit(None))
    for bound, label in zip(bounds, labels):
        out = out.when(value <= F.lit(float(bound)), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def clip(value: Column, low: Column | float, high: Column | float) -> Column:
    """Limit to [low, high]; null stays null."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(value.isNull(), None).otherwise(F.least(F.greatest(value, low), high))


def prediction_interval(prediction: Column, share: float = 0.1, z: float = 1.96) -> tuple[Column, Column]:
    """Normal interval with a standard error of ``share`` times the prediction, floored at 0."""
    spread = F.lit(z) * (prediction * F.lit(share))
    return F.greatest(F.lit(0.0), prediction - spread), prediction + spread


# Defaults and weights of the closed-form demand scorer.
SCORER_DEFAULTS: Mapping[str, float] = {"temp": 0.5, "humidity": 0.6, "windspeed": 0.2, "season": 2, "weather": 1}
SCORER_BASE = 2000
SCORER_TEMP = 1500
SCORER_WEATHER = 200
SCORER_SEASON = 100


def closed_form_demand(temp: Column, weather: Column, season: Column) -> Column:
    """Truncated linear demand, never negative; missing fields take the request defaults."""
    temp = F.coalesce(temp, F.lit(SCORER_DEFAULTS["temp"]))
    weather = F.coalesce(weather, F.lit(SCORER_DEFAULTS["weather"]))
    season = F.coalesce(season, F.lit(SCORER_DEFAULTS["season"]))
    raw = F.lit(float(SCORER_BASE)) + temp * SCORER_TEMP - (weather - 1) * SCORER_WEATHER + season * SCORER_SEASON
    return F.greatest(F.lit(0), raw.cast("int"))


def demand_confidence(demand: Column) -> Column:
    return F.when((demand > 1000) & (demand < 5000), "High").otherwise("Medium")


def format_metric(value: Column, precision: int = 4) -> Column:
    return F.format_string(f"%.{precision}f", value.cast("double"))


def long_rows(values: Mapping[str, Column], name: str = "metric", value: str = "value") -> Column:
    """Array of (name, value) structs for ``inline``: turns one wide row into a long table."""
    return F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in values.items()])
