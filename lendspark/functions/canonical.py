"""Canonical JSON: keys sorted, no blanks, NULLs kept, UTF-8. Equal rows give equal text and hash.

Numbers are written as Python's `json` writes them, so that hashes can be checked outside Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _with_value(value: Column, build: Callable[[Column], Column]) -> Column:
    """`build(value)`, with `value` worked out once; as a plain expression it would be written out wherever `build` names it."""
    return F.element_at(F.transform(F.array(value), build), 1)


def _digits_text(size: Column) -> Column:
    """A positive number that is not whole, or beyond 10^15, as Python prints it."""
    shortest = F.format_string("%.16e", size)
    for digits in (15, 14):  # fifteen digits always survive a round trip, most numbers need no more
        text = F.format_string(f"%.{digits}e", size)
        shortest = F.when(text.cast("double") == size, text).otherwise(shortest)

    def parts(text: Column) -> Column:
        digits = F.regexp_replace(F.translate(F.substring_index(text, "e", 1), ".", ""), "0+$", "")
        return F.struct(digits.alias("digits"), F.substring_index(text, "e", -1).cast("int").alias("exponent"))

    def written(number: Column) -> Column:
        digits, exponent = number["digits"], number["exponent"]
        count = F.length(digits)
        whole = F.when(count <= exponent + 1, F.concat(F.rpad(digits, exponent + 1, F.lit("0")), F.lit(".0"))).otherwise(
            F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, count))
        )
        below_one = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
        mantissa = F.concat(F.substring(digits, 1, 1), F.when(count > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), count))).otherwise(""))
        power = F.concat(F.when(exponent < 0, "e-").otherwise("e+"), F.when(F.abs(exponent) < 10, "0").otherwise(""), F.abs(exponent).cast("string"))
        return F.when(exponent.between(0, 15), whole).when(exponent.between(-4, -1), below_one).otherwise(F.concat(mantissa, power))

    return _with_value(_with_value(shortest, parts), written)


def number_text(c: Column) -> Column:
    """A double as Python prints it: the fewest digits that give the same number again, `1e-05` below 0.0001 and
    `1e+16` from 10^16 on. The digits come from the JVM, whose 17-digit texts are the nearest ones from Java 19 on."""
    size = F.abs(c)
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")
    # Whole numbers, most of all: no digits have to be searched for.
    is_whole = (size > 0) & (size < 1e15) & (c == F.floor(c).cast("double"))
    return (
        F.when(c.isNull(), F.lit("null"))
        .when(is_whole, F.concat(c.cast("bigint").cast("string"), F.lit(".0")))
        .when(F.isnan(c), F.lit("NaN"))
        .when(size == float("inf"), F.concat(sign, F.lit("Infinity")))
        .when(size == 0, F.concat(sign, F.lit("0.0")))
        .otherwise(F.concat(sign, _digits_text(size)))
    )


def canonical_json(fields: Mapping[str, Column], doubles: Collection[str] = ()) -> Column:
    """One object of the given fields; `doubles` names those that are floating-point numbers."""
    floating = [fields[key] for key in sorted(fields) if key in doubles]
    whole = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), _KEEP_NULLS) if fields else F.lit("{}")
    if not floating:
        return whole
    # Whole numbers below 10^7 look the same in Spark's JSON, which then needs no putting together.
    alike = reduce(lambda a, b: a & b, [c.isNull() | ((F.abs(c) < 1e7) & (c == F.floor(c).cast("double"))) for c in floating])
    return F.when(alike, whole).otherwise(_pieced_json(fields, doubles))


def _pieced_json(fields: Mapping[str, Column], doubles: Collection[str]) -> Column:
    """The object put together from runs of other fields and numbers between them."""
    parts: list[Column] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = F.to_json(F.struct(*[fields[k].alias(k) for k in run]), _KEEP_NULLS)
            parts.append(F.substring(text, F.lit(2), F.length(text) - 2))
            run.clear()

    for key in sorted(fields):
        if key in doubles:
            flush()
            parts.append(F.concat(F.lit(f'"{key}":'), number_text(fields[key])))
        else:
            run.append(key)
    flush()
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def list_to_json(c: Column) -> Column:
    """Array column as JSON text, for stores without array types; NULL is the empty list."""
    return F.to_json(F.coalesce(c, F.array().cast("array<string>")))


def list_from_json(c: Column) -> Column:
    """Array column back from such text; NULL or empty text is the empty list."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.from_json(F.nullif(c, F.lit("")), "array<string>"), empty)
