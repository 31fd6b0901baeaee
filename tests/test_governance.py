from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.functions import masks as M
from bankspark.operators import governance as G
from tests.util import bag, frame


def contacts(spark):
    return frame(
        spark, "id int, name string, email string, phone string, gid string, amount decimal(18,2)",
        (1, "Priya Patel", "priya@bank.com", "+91 (22) 555-0134", "X123", Decimal("1499.99")),
        (2, "Cher", "c@x.org", "12", "Y", Decimal("-1500.00")), (3, None, None, None, None, None),
    )


def col(spark, mask, column, role):
    return [r[0] for r in contacts(spark).orderBy("id").select(mask(F.col(column), role)).collect()]


def test_reader_sees_reduced_values(spark):
    assert col(spark, M.mask_name, "name", M.READER) == ["P. P.", "C. C.", "***"]
    assert col(spark, M.mask_email, "email", M.READER) == ["p***@bank.com", "c***@x.org", None]
    assert col(spark, M.mask_phone, "phone", M.READER) == ["XXX-XXX-0134", "XXX-XXX-12", None]
    assert [v and v[:5] for v in col(spark, M.mask_govt_id, "gid", M.READER)] == ["HASH_", "HASH_", None]
    assert col(spark, M.mask_amount, "amount", M.READER) == [Decimal("1000.00"), Decimal("-2000.00"), None]


def test_other_roles(spark):
    assert col(spark, M.mask_name, "name", M.TRANSFORMER)[0] == "Priya Patel"
    assert col(spark, M.mask_govt_id, "gid", M.TRANSFORMER)[0].startswith("HASH_")
    assert col(spark, M.mask_govt_id, "gid", M.ADMIN)[0] == "X123"
    for mask, c in ((M.mask_name, "name"), (M.mask_email, "email"), (M.mask_phone, "phone"), (M.mask_govt_id, "gid")):
        assert set(col(spark, mask, c, "INTERN")) == {M.MASKED}
    assert set(col(spark, M.mask_amount, "amount", "INTERN")) == {None}


def tagged(spark):
    df = contacts(spark)
    for c, cls, f in (("name", "PII_LOW", "NAME"), ("email", "PII_HIGH", "EMAIL"), ("phone", "PII_HIGH", "PHONE"), ("gid", "PII_HIGH", "GOVT_ID"), ("amount", "FINANCIAL_SENSITIVE", None)):
        df = G.tag(df, c, cls, f)
    return df


def test_tags_survive_renames_and_no_raw_value_leaks(spark):
    renamed = tagged(spark).select(F.col("name").alias("display"), "email", "phone", "gid", "amount")
    masked = G.apply_masks(renamed, M.READER)
    assert masked.schema["display"].metadata["pii_field"] == "NAME"
    raw = {v for r in renamed.drop("amount").collect() for v in r if v}
    shown = {v for r in masked.drop("amount").collect() for v in r if v}
    assert not raw & shown


def test_inventory_and_coverage(spark):
    df = G.tag_open(G.tag(tagged(spark), "id", "PII_HIGH"), "id")
    refs = bag(G.tag_references({"contacts": df}))
    assert ("contacts", "name", "PII_FIELD", "NAME") in refs and ("contacts", "amount", "DATA_CLASS", "FINANCIAL_SENSITIVE") in refs
    assert bag(G.unmasked_columns({"contacts": df})) == [("contacts", "id", "PII_HIGH")]
    coverage = {c: x for _, c, _, x in bag(G.mask_coverage({"contacts": df}))}
    assert coverage == {"id": "OPEN", "name": "FIELD", "email": "FIELD", "phone": "FIELD", "gid": "FIELD", "amount": "AMOUNT"}
    assert G.unmasked_columns({"contacts": contacts(spark)}).count() == 0


def test_protected_columns_without_a_mask_of_their_own_are_masked_out(spark):
    df = frame(spark, "home string, secret string, wealth double, code int", ("Street 1", "s", 12.5, 7))
    for c, cls, f in (("home", "PII_HIGH", "ADDRESS"), ("secret", "PII_HIGH", None), ("wealth", "FINANCIAL_SENSITIVE", None), ("code", "PII_LOW", "NAME")):
        df = G.tag(df, c, cls, f)
    for role in (M.READER, "INTERN"):
        shown = G.apply_masks(df, role)
        assert bag(shown) == [(None, None, None, None)] and shown.dtypes == df.dtypes
    assert bag(G.apply_masks(df, M.ADMIN)) == bag(df)
    assert bag(G.apply_masks(G.tag_open(df, "secret"), "INTERN"), "secret") == [("s",)]


def test_row_access(spark):
    df = frame(spark, "region string", ("N",), ("S",), (None,))
    assert G.row_access(df, M.ADMIN, None).count() == 3
    assert bag(G.row_access(df, M.READER, "N")) == [("N",)]
    assert G.row_access(df, M.READER, None).count() == 0
    assert G.row_access(df, "INTERN", "N").count() == 0


def test_sql_masks_equal_the_frames_masks(spark):
    from bankspark.operators import masks_sql

    df = tagged(spark)
    df = G.tag_open(G.tag(df, "id", "PII_LOW"), "id").withColumn("note", F.lit("n"))
    df = G.tag(df, "note", "PII_HIGH", "ADDRESS")
    masks_sql.register_masks(spark)
    masks_sql.masked_view(spark, df, "shown")
    assert bag(spark.sql("SELECT * FROM shown")) == bag(G.apply_masks(df, "NOBODY"))
    for role in (M.ADMIN, M.TRANSFORMER, M.ACCOUNT_ADMIN, M.READER, "INTERN", "x' OR 'a' = 'a"):
        masks_sql.set_role(spark, role)
        got = spark.sql("SELECT * FROM shown")
        assert bag(got) == bag(G.apply_masks(df, role)) and got.dtypes == df.dtypes
    # The functions serve any SQL.
    assert spark.sql("SELECT mask_name('Ada Lovelace', 'BI_READER')").first()[0] == "A. L."
