"""Decoding a JSON reading: flatten vitals, split blood pressure, parse time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.numbers import general_float, plain_decimal
from pulseframe.schemas import VITAL_ALIASES, VITALS

UNKNOWN_PATIENT = "Unknown"
PRESSURE = "blood_pressure"
_VITAL_MAP = "map<string,double>"


def parse_time(text: Column) -> Column:
    """ISO-8601 text, with or without zone or ``Z``, as TIMESTAMP; NULL if unreadable."""
    return F.try_to_timestamp(text)


def patient_or_unknown(patient_id: Column) -> Column:
    return F.coalesce(patient_id, F.lit(UNKNOWN_PATIENT))


def _unquoted(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _loose_number(text: Column) -> Column:
    """A number or boolean taken out of an object, or general float text."""
    return F.when(text == "true", 1.0).when(text == "false", 0.0).otherwise(general_float(text))


def _entry_number(text: Column, text_rule: Callable[[Column], Column]) -> Column:
    """One vital as double: text by ``text_rule``, boolean as 1/0, an object's ``value``, else a number."""
    return (
        F.when(text.startswith('"'), text_rule(_unquoted(text)))
        .when(text == "true", 1.0)
        .when(text == "false", 0.0)
        .when(text.startswith("{"), _loose_number(F.get_json_object(text, "$.value")))
        .otherwise(text.try_cast("double"))
    )


_SIDES = ("systolic", "diastolic")


def _pressure_texts(text: Column) -> list[Column]:
    """Both numbers of a pressure's JSON text, as text."""
    parts = F.split(_unquoted(text), "/")
    return [
        F.when(text.startswith('"'), F.when(F.size(parts) == 2, F.get(parts, i)))
        .when(text.startswith("{"), F.get_json_object(text, f"$.{name}"))
        for i, name in enumerate(_SIDES)
    ]


def _pressure_number(text: Column, side: Column) -> Column:
    """A boolean is a number inside an object only."""
    return F.when(text.startswith("{"), _loose_number(side)).otherwise(general_float(side))


def split_pressure(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with systolic and diastolic from JSON text: ``"120/80"`` or an object with both."""
    both = df.withColumn("_text", text)
    both = both.withColumns(dict(zip(("_s", "_d"), _pressure_texts(F.col("_text")))))
    sides = zip(("_s", "_d"), _SIDES)
    return both.select(*df.columns, *(_pressure_number(F.col("_text"), F.col(c)).alias(n) for c, n in sides))


def with_vitals(df: DataFrame, vitals: Column, for_cleaning: bool = False, name: str = "vitals") -> DataFrame:
    """``df`` with MAP<STRING, DOUBLE> of the vitals in a VARIANT object.

    Nested blood pressure becomes its two canonical fields, short aliases are
    renamed, entries without a number are dropped. On a clash the canonical entry
    wins over the alias and both over the nested one. ``for_cleaning`` reads text
    by the cleaner's wider rule.

    Every known vital is taken out by its path, in steps, so that it is generated code and
    nothing is computed twice. Only readings that hold other names go through a map of
    variants. That map's function keeps the step with the numbers out of the one large
    method of a whole stage, which the JVM would not compile.
    """
    text_rule = general_float if for_cleaning else plain_decimal
    short_of = {canonical: short for short, canonical in VITAL_ALIASES.items()}
    known = (*VITALS, *VITAL_ALIASES, PRESSURE)
    empty = F.create_map().cast(_VITAL_MAP)
    text = {n: F.col(f"_text_{i}") for i, n in enumerate(known)}
    number = {n: F.col(f"_number_{i}") for i, n in enumerate(VITALS)}
    # JSON text keeps the kind of a value visible; JSON null is the text null.
    texts = df.withColumn("_vitals", vitals).withColumns(
        {f"_text_{i}": F.to_json(F.try_variant_get("_vitals", f"$.{n}", "variant")) for i, n in enumerate(known)}
        | {"_entries": F.try_variant_get("_vitals", "$", "map<string,variant>")})
    texts = texts.withColumns({f"_{n}": side for n, side in zip(_SIDES, _pressure_texts(text[PRESSURE]))})

    def value_of(vital: str) -> Column:
        found = [_entry_number(text[vital], text_rule)]
        if vital in short_of:
            side = F.col("_" + vital.removeprefix(f"{PRESSURE}_"))
            found += [_entry_number(text[short_of[vital]], text_rule), _pressure_number(text[PRESSURE], side)]
        return F.coalesce(*found)

    present = sum((t.isNotNull().cast("int") for t in text.values()), F.lit(0))
    rest = F.map_filter("_entries", lambda k, _: ~k.isin(*known))
    others = F.map_filter(
        F.transform_values(F.transform_values(rest, lambda _, v: F.to_json(v)), lambda _, t: _entry_number(t, text_rule)),
        lambda _, v: v.isNotNull())
    numbers = texts.withColumns(
        {f"_number_{i}": value_of(n) for i, n in enumerate(VITALS)}
        | {"_others": F.when(F.size("_entries") > present, others).otherwise(empty)})
    single = lambda n: F.when(number[n].isNotNull(), F.create_map(F.lit(n), number[n])).otherwise(empty)
    return numbers.select(*df.columns, F.map_concat(*(single(n) for n in VITALS), "_others").alias(name))
