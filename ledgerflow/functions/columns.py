"""Scalar helpers: column expressions that never fail on dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_TS, EU_TS = "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss"
_STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


def native_format(fmt: str) -> str:
    """A strftime format as a Spark pattern."""
    for theirs, ours in _STRFTIME.items():
        fmt = fmt.replace(theirs, ours)
    return fmt


def parse_ts(col: Column, *formats: str) -> Column:
    """Timestamp without zone by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(native_format(f))) for f in formats or (ISO_TS,)]).cast("timestamp_ntz")


def parse_date(col: Column, *formats: str) -> Column:
    return F.coalesce(*[F.try_to_date(col, native_format(f)) for f in formats or ("yyyy-MM-dd",)])


def parse_decimal(col: Column, kind: str = "decimal(18,2)") -> Column:
    """Decimal of trimmed text; a comma is a decimal point; null if it isn't a number."""
    return F.replace(F.trim(col), F.lit(","), F.lit(".")).try_cast(kind)


def code(col: Column) -> Column:
    return F.upper(F.trim(col))


def text_or_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def full_match(col: Column, pattern: str) -> Column:
    """Whether the whole text matches; rlike alone looks for a part that does."""
    return col.rlike(f"^(?:{pattern})$")


def surrogate_key(*cols: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("_null_")) for c in cols]))


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone; sessions run in UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def mask_email(col: Column) -> Column:
    """First character and domain of an address."""
    return F.regexp_replace(col, r"^(.).*(@.*)$", r"$1***$2")


def mask_iban(col: Column) -> Column:
    """First and last four characters; stars between, none if there is nothing between."""
    return F.concat(F.left(col, F.lit(4)), F.repeat(F.lit("*"), F.greatest(F.length(col) - 8, F.lit(0))), F.right(col, F.lit(4)))


def masked_view(df, privileged: bool, emails: tuple[str, ...] = ("email",), ibans: tuple[str, ...] = ("iban", "counterparty_iban")):
    """df as a reader sees it: personal columns are masked unless the reader is privileged."""
    if privileged:
        return df
    masks = {c: mask_email(F.col(c)) for c in emails} | {c: mask_iban(F.col(c)) for c in ibans}
    return df.withColumns({c: m for c, m in masks.items() if c in df.columns})
