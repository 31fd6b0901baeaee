"""Cleansing expressions for raw text, codes, keys and dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from bankspark.config import UNKNOWN

# Fixed value: what the surrogate key hashes in place of a null key part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Fixed value: the characters besides white space after which a display name starts a new word.
WORD_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def norm_code(c: Column) -> Column:
    """Ids and enums: trimmed, upper case."""
    return F.upper(F.trim(c))


def norm_name(c: Column, delimiters: str | None = WORD_DELIMITERS) -> Column:
    """Display names: trimmed, each word capitalised.

    `delimiters=None` starts words at white space only.
    """
    text = F.lower(F.trim(c))
    if delimiters is None:
        return F.initcap(text)
    charset = "".join("\\" + ch for ch in delimiters)
    words = F.split(text, f"(?<=[\\s{charset}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))),
        "",
    )


def default_unknown(c: Column) -> Column:
    return F.coalesce(norm_code(c), F.lit(UNKNOWN))


def canonical(c: Column, allowed: Iterable[str], default: str = UNKNOWN) -> Column:
    """The normalised code if it is an allowed one, else the default."""
    code = norm_code(c)
    return F.when(code.isin(*allowed), code).otherwise(F.lit(default))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def surrogate_key(*cols: Column) -> Column:
    """MD5 over the key parts joined by '-', a null part by its stand-in."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def md5_key(c: Column) -> Column:
    """MD5 of the raw, un-normalised value."""
    return F.md5(c.cast("string"))


def parse_date_or_serial(c: Column) -> Column:
    """ISO dates, and the five-digit day numbers that spreadsheets export."""
    text = F.trim(c)
    serial = F.date_add(F.lit("1899-12-30").cast("date"), F.expr("0") + text.try_cast("int"))
    return F.when(text.rlike("^[0-9]{5}$"), serial).otherwise(F.try_to_date(text, "yyyy-MM-dd"))
