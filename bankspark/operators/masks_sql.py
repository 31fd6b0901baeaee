"""The masks as SQL functions, so that views and plain SQL mask as DataFrames do."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from bankspark.functions.masks import ACCOUNT_ADMIN, ADMIN, MASKED, PRIVILEGED, READER, TRANSFORMER
from bankspark.operators.governance import MASK_BY_FIELD, OPEN, PROTECTED_CLASSES

ROLE = "masking_role"
NOBODY = "NOBODY"
# What a reader sees of a value `c`, per mask.
_READER = {
    "mask_name": "coalesce(concat(left(split_part(c, ' ', 1), 1), '. ', left(split_part(c, ' ', -1), 1), '.'), '***')",
    "mask_email": "concat(left(split_part(c, '@', 1), 1), '***@', split_part(c, '@', 2))",
    "mask_phone": "concat('XXX-XXX-', right(regexp_replace(c, '[^0-9]', ''), 4))",
    "mask_govt_id": "concat('HASH_', left(sha2(c, 256), 12))",
}


def _roles(names) -> str:
    return ", ".join(f"'{n}'" for n in sorted(names))


def register_masks(spark: SparkSession) -> None:
    """Make mask_name, mask_email, mask_phone, mask_govt_id, mask_amount and mask_out functions of this
    session, and a session variable for the role they ask; nobody's to begin with."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT '{NOBODY}'")
    for name, reader in _READER.items():
        raw = {ADMIN, ACCOUNT_ADMIN} if name == "mask_govt_id" else PRIVILEGED
        seen = {TRANSFORMER, READER} if name == "mask_govt_id" else {READER}
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING, role STRING) RETURNS STRING
            RETURN CASE WHEN role IN ({_roles(raw)}) THEN c WHEN role IN ({_roles(seen)}) THEN {reader} ELSE '{MASKED}' END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION mask_amount(c DECIMAL(18, 2), role STRING) RETURNS DECIMAL(18, 2)
        RETURN CASE WHEN role IN ({_roles(PRIVILEGED)}) THEN c WHEN role = '{READER}' THEN CAST(round(c / 1000, 0) * 1000 AS DECIMAL(18, 2)) END""")


def set_role(spark: SparkSession, role: str) -> None:
    """The role that masked views of this session are read as from now on."""
    spark.sql(f"SET VAR {ROLE} = :role", args={"role": role})


def _shown(name: str, kind: str, tags: Mapping) -> str:
    column = f"`{name}`"
    if tags.get(OPEN):
        return column
    field = MASK_BY_FIELD.get(tags.get("pii_field"))
    if field is not None and kind == "string":
        return f"{field.__name__}({column}, {ROLE}) AS {column}"
    if tags.get("data_class") not in PROTECTED_CLASSES and "pii_field" not in tags:
        return column
    if tags.get("data_class") == "FINANCIAL_SENSITIVE" and kind.startswith("decimal"):
        return f"CAST(mask_amount({column}, {ROLE}) AS {kind}) AS {column}"
    return f"CASE WHEN {ROLE} IN ({_roles(PRIVILEGED)}) THEN {column} END AS {column}"


def masked_view(spark: SparkSession, df: DataFrame, name: str) -> None:
    """A temporary view of tagged rows, each column masked by its tags (as `apply_masks`) for whatever role
    the session has when the view is read. The rows themselves are the view `<name>_unmasked`."""
    df.createOrReplaceTempView(f"{name}_unmasked")
    columns = ", ".join(_shown(f.name, f.dataType.simpleString(), f.metadata) for f in df.schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {name}_unmasked")
