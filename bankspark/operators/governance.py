"""Column classification, masks chosen by it, and row access by region."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from bankspark.functions.dates import lit_date
from bankspark.functions.masks import (
    PRIVILEGED, READER, mask_amount, mask_email, mask_govt_id, mask_name, mask_phone,
)

# The governance vocabulary.
DATA_CLASSES = ("PUBLIC", "INTERNAL", "PII_LOW", "PII_HIGH", "FINANCIAL_SENSITIVE")
PII_FIELDS = ("NAME", "EMAIL", "PHONE", "GOVT_ID", "ADDRESS")

MASK_BY_FIELD = {
    "NAME": mask_name,
    "EMAIL": mask_email,
    "PHONE": mask_phone,
    "GOVT_ID": mask_govt_id,
}
PROTECTED_CLASSES = frozenset({"PII_LOW", "PII_HIGH", "FINANCIAL_SENSITIVE"})
OPEN = "open_on_purpose"


def tag(df: DataFrame, column: str, data_class: str, pii_field: str | None = None) -> DataFrame:
    """Classify a column; the tags travel in its metadata, also through renames."""
    if data_class not in DATA_CLASSES:
        raise ValueError(f"unknown data class {data_class}")
    if pii_field is not None and pii_field not in PII_FIELDS:
        raise ValueError(f"unknown PII field {pii_field}")
    tags = {**df.schema[column].metadata, "data_class": data_class}
    if pii_field:
        tags["pii_field"] = pii_field
    return df.withMetadata(column, tags)


def masked_out(column: Column, role: str) -> Column:
    """For what no finer mask fits: the value for privileged roles, nothing for others."""
    return column if role in PRIVILEGED else F.lit(None)


def tag_open(df: DataFrame, column: str) -> DataFrame:
    """Leave a protected column in clear on purpose, as join keys are."""
    return df.withMetadata(column, {**df.schema[column].metadata, OPEN: True})


def mask_for(field: T.StructField) -> Callable[[Column, str], Column] | None:
    """The mask that a column's tags ask for.

    By field; a money column by its class; any other protected column is masked out. None for a
    column that is not protected, or is left open on purpose (`tag_open`).
    """
    if field.metadata.get(OPEN):
        return None
    by_field = MASK_BY_FIELD.get(field.metadata.get("pii_field"))
    if by_field is not None and field.dataType.typeName() == "string":
        return by_field
    if field.metadata.get("data_class") not in PROTECTED_CLASSES and "pii_field" not in field.metadata:
        return None
    if field.metadata.get("data_class") == "FINANCIAL_SENSITIVE" and field.dataType.typeName() == "decimal":
        return mask_amount
    return masked_out


def apply_masks(df: DataFrame, role: str) -> DataFrame:
    """Every tagged column as `role` may see it; types stay."""

    def shown(f: T.StructField) -> Column:
        mask = mask_for(f)
        column = F.col(f"`{f.name}`")
        if mask is None:
            return column
        return mask(column, role).cast(f.dataType).alias(f.name, metadata=f.metadata)

    return df.select(*[shown(f) for f in df.schema.fields])


def row_access(df: DataFrame, role: str, user_region: str | None, region: str = "region") -> DataFrame:
    """All rows for privileged roles, the own region for readers, none for others."""
    if role in PRIVILEGED:
        return df
    if role == READER and user_region is not None:
        return df.filter(F.col(region) == user_region)
    return df.filter(F.lit(False))


def _schema_rows(tables: dict[str, DataFrame], columns: list[str], rows: list[tuple]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def tag_references(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, tag_name, tag_value) for every tag, read from the schemas."""
    return _schema_rows(tables, ["table_name", "column_name", "tag_name", "tag_value"], [
        (name, f.name, key.upper(), str(f.metadata[key]))
        for name, df in sorted(tables.items())
        for f in df.schema.fields
        for key in ("data_class", "pii_field")
        if key in f.metadata
    ])


def mask_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_class, coverage) of the protected columns: FIELD or AMOUNT
    for a mask that keeps part of the value, OUT for one that keeps nothing, OPEN without."""

    def coverage(f: T.StructField) -> str:
        mask = mask_for(f)
        return "OPEN" if mask is None else "OUT" if mask is masked_out else "AMOUNT" if mask is mask_amount else "FIELD"

    return _schema_rows(tables, ["table_name", "column_name", "data_class", "coverage"], [
        (name, f.name, f.metadata["data_class"], coverage(f))
        for name, df in sorted(tables.items())
        for f in df.schema.fields
        if f.metadata.get("data_class") in PROTECTED_CLASSES
    ])


def unmasked_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """The protected columns that are left open."""
    return mask_coverage(tables).filter("coverage = 'OPEN'").drop("coverage")


# The statement types the access audit lists.
AUDITED_TYPES = ("SELECT", "CREATE_TABLE_AS_SELECT", "MERGE", "UPDATE", "DELETE")


def access_audit(query_log: DataFrame, database: str, as_of: date, days: int = 30) -> DataFrame:
    """Who ran what on `database` in the last `days`."""
    return query_log.filter(
        (F.col("start_time") >= lit_date(as_of - timedelta(days=days)))
        & (F.col("database_name") == database)
        & F.col("query_type").isin(*AUDITED_TYPES)
    ).select(
        "user_name", "role_name", "query_text", "database_name", "schema_name", "start_time",
        "execution_status", "total_elapsed_time",
    )
