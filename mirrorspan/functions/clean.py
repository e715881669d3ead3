"""Text cleaning and durations, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Texts that mean "no value"; matched exactly, untrimmed.
NULL_TOKENS = ("nan", "None", "null", "NULL", "")

DAY_SECONDS = 86_400


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\0"), F.lit(""))


def drop_invalid_utf8(text: Column) -> Column:
    """Remove bytes that are not UTF-8; valid text is returned untouched.

    Repairing puts U+FFFD for broken bytes. One that stands in the text by itself is
    written in another way meanwhile, so that it stays: NUL becomes NUL n, U+FFFD NUL r.
    """
    nul, mark = F.lit("\0"), F.lit("\ufffd")
    escaped = F.replace(F.replace(text, nul, F.lit("\0n")), mark, F.lit("\0r"))
    repaired = F.replace(F.make_valid_utf8(escaped), mark, F.lit(""))
    repaired = F.replace(F.replace(repaired, F.lit("\0r"), mark), F.lit("\0n"), nul)
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def clean_text(text: Column) -> Column:
    """NULs out first, then broken bytes, then the null tokens."""
    return null_tokens_to_null(drop_invalid_utf8(strip_nul(text)))


def clean_text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Clean the text columns of ``df``; every other type is left as it is."""
    wanted = None if columns is None else {c.lower() for c in columns}
    return df.select(
        *[
            clean_text(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) and (wanted is None or f.name.lower() in wanted)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def null_token_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per column that cleaning turns into NULL, and rows it changes."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts, rows = [], []
    for i, name in enumerate(names):
        raw = F.col(f"`{name}`")
        cleaned = clean_text(raw)
        counts += [
            F.count_if(raw.isNull()).alias(f"n{i}"),
            F.count_if(raw.isNotNull() & cleaned.isNull()).alias(f"t{i}"),
            F.count_if(cleaned.isNotNull() & (cleaned != raw)).alias(f"c{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"n{i}").alias("already_null"),
                F.col(f"t{i}").alias("became_null"),
                F.col(f"c{i}").alias("text_changed"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def seconds_to_time(seconds: Column) -> Column:
    """Whole seconds as the time of day ``HH:mm:ss``; full days are dropped."""
    left = F.pmod(seconds.cast("bigint"), F.lit(DAY_SECONDS))
    parts = [F.floor(left / 3600), F.floor(left / 60) % 60, left % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def interval_micros(interval: Column) -> Column:
    """Length of a day-time interval in microseconds."""
    seconds = interval.cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def duration_to_time(interval: Column) -> Column:
    """Time-of-day text of a duration; the fraction appears only when present."""
    length = interval_micros(interval)
    micros = F.pmod(length, F.lit(1_000_000))
    fraction = F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    text = seconds_to_time(F.floor(length / 1_000_000))
    return F.when(micros == 0, text).otherwise(F.concat(text, fraction))


def out_of_day(interval: Column) -> Column:
    """True where dropping whole days changed the value."""
    length = interval_micros(interval)
    return (length < 0) | (length >= DAY_SECONDS * 1_000_000)
