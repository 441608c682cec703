"""Payload decoding: bytes to text, JSON or CSV text to typed transaction columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    is_literal_true,
    split_csv_line,
    strict_double,
    to_bool,
    to_float,
    to_int,
)
from ..functions.time import to_instant
from ..schema import (
    EVENT_TIME,
    FIELD_NAMES,
    KEY,
    TRANSACTION,
    VELOCITY,
    all_string_ddl,
    ddl,
    fields_of_type,
)

STRICT_NUMBERS = ("amount", "distance_from_home")

_CASTS = {"float": to_float, "int": to_int, "boolean": to_bool}


def _expand(df: DataFrame, record: Column, *keep: str) -> DataFrame:
    """Turn a struct column into the frame's columns, next to those in ``keep``.

    ``inline`` over a one-element array, rather than ``select("record.*")``: a
    filter on a field is pushed down through a projection and would decode the
    payload a second time to evaluate it. A null struct gives a row of nulls.
    """
    return df.select(*keep, F.inline(F.array(record)))


def payload_to_string(df: DataFrame, column: str = "value") -> DataFrame:
    """Read a binary payload column as UTF-8 text."""
    return df.withColumn(column, F.col(column).cast("string"))


def parse_json(
    df: DataFrame, column: str = "value", strict: bool = False, velocity: bool = False
) -> DataFrame:
    """Decode a JSON payload column into transaction columns, replacing the frame's own.

    By default numbers and booleans are read as text and cast, so ``12.0`` and
    ``"3"`` fill integer fields. ``strict`` decodes straight into the declared
    types instead: a field whose token has another type is null, the rest of the
    row is kept. A value that is not JSON gives a row of nulls either way.
    ``velocity`` adds the velocity map, which the target table does not store;
    left out, its text is skipped rather than decoded.
    """
    wanted = [(name, kind) for name, kind in TRANSACTION if velocity or name != VELOCITY]
    as_text = {EVENT_TIME} if strict else {*_CASTS, VELOCITY, EVENT_TIME}
    tokens = [
        (name, "string" if name in as_text or kind in as_text else kind) for name, kind in wanted
    ]
    fields = _expand(df, F.from_json(F.col(column), ddl(tokens)))
    # a bare time of day would be read as today's
    fields = fields.withColumn(EVENT_TIME, to_instant(F.col(EVENT_TIME)))
    if strict:
        return fields
    if velocity:
        fields = fields.withColumn(VELOCITY, F.from_json(VELOCITY, "map<string,string>"))
    return cast_fields(fields)


def parse_csv_line(df: DataFrame, column: str = "value", unquote: bool = False) -> DataFrame:
    """Cut a CSV line into its 24 fields, all text.

    Quotes stay part of the field. ``unquote`` removes them and halves doubled
    ones. Fields past the end of a short line are null; an empty field is empty
    text, or null with ``unquote``.
    """
    if unquote:
        return _expand(df, F.from_csv(F.col(column), all_string_ddl(), {"escape": '"'}))
    fields = df.select(split_csv_line(F.col(column)).alias("fields"))
    record = F.struct(
        *(F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(FIELD_NAMES))
    )
    return _expand(fields, record)


def cast_fields(df: DataFrame) -> DataFrame:
    """Cast the text columns among the numeric and boolean fields; bad text gives null.

    The timestamp is left as it is: how its text is read is a calendar question.
    """
    text_columns = {name for name, kind in df.dtypes if kind == "string"}
    casts = {
        name: _CASTS[kind](F.col(name))
        for name, kind in TRANSACTION
        if kind in _CASTS and name in text_columns
    }
    return df.withColumns(casts) if casts else df


def coerce_strict(df: DataFrame) -> DataFrame:
    """Publisher-side typing: two numbers that must parse, four words that mean true.

    A bad or missing number fails the job. A boolean field is true only for the
    word ``true``; every other word is false.
    """
    numbers = {name: strict_double(F.col(name), name) for name in STRICT_NUMBERS}
    flags = {name: is_literal_true(F.col(name)) for name in fields_of_type("boolean")}
    return df.withColumns({**numbers, **flags})


def json_type_faults(df: DataFrame, column: str = "value") -> DataFrame:
    """field, found, n: how often a field's token would be null if read as its declared type.

    ``found`` is the type of the token itself. A missing field or a JSON null is no fault.
    Payloads that are not objects are counted as field ``-``. One pass, and at most a few
    rows for each field are shuffled.
    """
    text = F.col(column).cast("string")
    rows = df.select(
        F.try_parse_json(text).alias("token"), F.from_json(text, ddl(TRANSACTION)).alias("typed")
    )
    whole = F.try_variant_get("token", "$", "map<string,variant>").isNull()

    def fault(name: str) -> Column:
        token = F.try_variant_get("token", f"$.{name}", "variant")
        found = F.when(token.isNotNull() & ~F.is_variant_null(token), F.schema_of_variant(token))
        return F.when(
            found.isNotNull() & F.col("typed")[name].isNull(),
            F.struct(F.lit(name).alias("field"), found.alias("found")),
        )

    junk = F.struct(F.lit("-").alias("field"), F.lit("no object").alias("found"))
    faults = F.when(whole, F.array(junk)).otherwise(
        F.array_compact(F.array(*(fault(name) for name in FIELD_NAMES)))
    )
    each = rows.select(F.explode(faults).alias("fault")).select("fault.*")
    # widths of numbers and members of objects are not the point
    kind = F.regexp_extract("found", "^[A-Z]+|no object", 0)
    return each.groupBy("field", kind.alias("found")).agg(F.count("*").alias("n"))


def has_id(key: Column) -> Column:
    """Whether an id is there and not blank; never null."""
    return F.coalesce(key.rlike(r"\S"), F.lit(False))


def rejected_json(df: DataFrame, column: str = "value") -> DataFrame:
    """JSON payloads that yield no transaction id, with their original text.

    Run it beside an enrichment to keep what a table with a non-null key refuses.
    """
    text = F.col(column).cast("string")
    found = F.from_json(text, ddl(TRANSACTION[:1]))[KEY]
    return df.where(~has_id(found)).select(text.alias(column))


def rejected_csv(df: DataFrame, column: str = "value", unquote: bool = False) -> DataFrame:
    """CSV lines that yield no transaction id, null and blank lines too, with their text."""
    text = F.col(column).cast("string")
    if unquote:
        found = F.from_csv(text, all_string_ddl(), {"escape": '"'})[KEY]
    else:
        found = F.get(split_csv_line(text), F.lit(FIELD_NAMES.index(KEY)))
    return df.where(~has_id(found)).select(text.alias(column))


# What a publisher writes per field: numbers only where it converted them.
WIRE = tuple(
    (
        name,
        "double" if name in STRICT_NUMBERS else "boolean" if kind == "boolean" else "string",
    )
    for name, kind in TRANSACTION
)


def parse_wire_json(
    df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Decode a JSON payload keeping each field's token type, timestamp as text.

    ``keep`` names columns of the frame to carry along, such as a message key.
    """
    return _expand(df, F.from_json(F.col(column), ddl(WIRE)), *keep)
