"""Role-dependent masks. A role sees the value, a reduced form, or a fixed mask."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Role names and the mask text.
ADMIN, TRANSFORMER, ACCOUNT_ADMIN, READER = (
    "FIN_ADMIN", "DBT_TRANSFORMER", "ACCOUNTADMIN", "BI_READER",
)
PRIVILEGED = frozenset({ADMIN, TRANSFORMER, ACCOUNT_ADMIN})
MASKED = "***MASKED***"


def mask_name(c: Column, role: str) -> Column:
    """Readers see the initials of the first and the last word."""
    if role in PRIVILEGED:
        return c
    if role != READER:
        return F.lit(MASKED)

    def initial(part: int) -> Column:
        return F.left(F.split_part(c, F.lit(" "), F.lit(part)), F.lit(1))

    return F.coalesce(F.concat(initial(1), F.lit(". "), initial(-1), F.lit(".")), F.lit("***"))


def mask_email(c: Column, role: str) -> Column:
    if role in PRIVILEGED:
        return c
    if role != READER:
        return F.lit(MASKED)
    user = F.split_part(c, F.lit("@"), F.lit(1))
    return F.concat(F.left(user, F.lit(1)), F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))


def mask_phone(c: Column, role: str) -> Column:
    if role in PRIVILEGED:
        return c
    if role != READER:
        return F.lit(MASKED)
    return F.concat(F.lit("XXX-XXX-"), F.right(F.regexp_replace(c, "[^0-9]", ""), F.lit(4)))


def mask_govt_id(c: Column, role: str) -> Column:
    """Raw for admins only; transformer and reader see a stable short hash."""
    if role in (ADMIN, ACCOUNT_ADMIN):
        return c
    if role in (TRANSFORMER, READER):
        return F.concat(F.lit("HASH_"), F.left(F.sha2(c, 256), F.lit(12)))
    return F.lit(MASKED)


def mask_amount(c: Column, role: str) -> Column:
    """Readers see the amount to the nearest thousand, others nothing."""
    if role in PRIVILEGED:
        return c
    if role != READER:
        return F.lit(None).cast("decimal(18,2)")
    return (F.round(c / 1000, 0) * 1000).cast("decimal(18,2)")
