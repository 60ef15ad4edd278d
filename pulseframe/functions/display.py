"""Flags and texts shown next to a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Normal ranges on the monitoring page.
NORMAL_RANGES = {
    "heart_rate": (60.0, 100.0),
    "temperature": (36.5, 37.5),
    "respiratory_rate": (12.0, 20.0),
    "blood_pressure_systolic": (90.0, 140.0),
}
SPO2_NORMAL, SPO2_LOW = 95.0, 90.0

# Danger limits of the alert box.
DANGER_LIMITS = {
    "heart_rate": (50.0, 120.0),
    "spo2": (90.0, None),
    "temperature": (36.0, 38.0),
    "blood_pressure_systolic": (90.0, 180.0),
}


def status_flag(name: str, value: Column) -> Column:
    """green, yellow or red; a missing value is red, SpO2 between its limits yellow."""
    if name == "spo2":
        return (
            F.when(value >= SPO2_NORMAL, "green").when(value < SPO2_LOW, "red")
            .otherwise("yellow")
        )
    low, high = NORMAL_RANGES[name]
    return F.when(value.between(F.lit(low), F.lit(high)), "green").otherwise("red")


def danger_flag(name: str, value: Column) -> Column:
    """True past a danger limit; NULL where the vital is missing or 0 and thus not shown."""
    low, high = DANGER_LIMITS[name]
    test = value < low if high is None else (value < low) | (value > high)
    return F.when(value != 0, test)


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the binary value.

    The scaled fraction of a vital (magnitude 8 or more, at most two digits) is
    exact in a double, so this agrees with correctly rounded printing.
    """
    if digits == 0:
        return F.rint(value)
    whole, scale = F.floor(value), F.lit(float(10**digits))
    return whole + F.rint((value - whole) * scale) / scale


def rounded_text(value: Column, digits: int = 0, unit: str = "", missing: str = "--") -> Column:
    """Numbers from 1 to a thousand million are put together from whole numbers, several times faster than by a format."""
    scale, whole = 10**digits, F.floor(value)
    scaled = whole * scale + F.rint((value - whole) * scale).cast("bigint") if digits else F.rint(value).cast("bigint")
    if digits:
        parts = [F.floor(scaled / scale).cast("string"), F.lit("."), F.lpad((scaled % scale).cast("string"), digits, "0")]
    else:
        parts = [scaled.cast("string")]
    formatted = F.format_string(f"%.{digits}f{unit.replace('%', '%%')}", half_even(value, digits))
    text = F.when((value >= 1) & (value < 1e9), F.concat(*parts, F.lit(unit))).otherwise(formatted)
    return F.when(value.isNull(), F.lit(missing)).otherwise(text)


def pressure_text(systolic: Column, diastolic: Column, missing: str = "--") -> Column:
    pair = F.concat(rounded_text(systolic), F.lit("/"), rounded_text(diastolic, missing=missing))
    return F.when(systolic.isNull(), F.lit(missing)).otherwise(pair)
