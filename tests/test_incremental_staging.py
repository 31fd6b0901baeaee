from datetime import datetime

from pyspark.sql import functions as F

from bankspark.plans.staging import refresh_staged_transactions, stg_transactions
from bankspark.sources import sinks, standin
from tests.util import bag, plan


def both(spark, path, raw):
    got = refresh_staged_transactions(spark, path, raw)
    want = stg_transactions(raw)
    assert bag(got.select(*want.columns)) == bag(want)
    return got


def test_increments_equal_staging_everything(spark, sf_dir, tmp_path):
    """Rows arrive in waves, get newer versions, move to another day, and are deleted in place."""
    path = str(tmp_path / "stg")
    raw = standin.raw_transactions(spark, sf_dir)
    n = F.substr(F.trim("transaction_id"), F.lit(2)).cast("bigint")
    day = lambda *d: F.lit(datetime(*d)).cast("timestamp_ntz")
    one = raw.filter(F.col("_synced") < day(2000, 1, 1))
    both(spark, path, one)
    two = raw.filter(F.col("_synced") < day(2001, 1, 1))
    both(spark, path, two)
    changed = two.filter(n % 40 == 3).withColumns({
        "_synced": day(2001, 1, 2), "transaction_status": F.lit("REVERSED"),
        "transaction_timestamp": F.when(n % 80 == 3, F.expr("transaction_timestamp + interval 45 days")).otherwise(F.col("transaction_timestamp")),
    })
    three = two.unionByName(changed)
    both(spark, path, three)
    # Deleted in place; of some ids an older version is still there and stands again.
    late = F.col("_synced") >= day(2001, 1, 2)
    four = three.withColumns({
        "_deleted": F.col("_deleted") | (late & (n % 3 == 0)) | (n % 40 == 7),
        "_synced": F.when((late & (n % 3 == 0)) | (n % 40 == 7), day(2001, 1, 3)).otherwise(F.col("_synced")),
    })
    both(spark, path, four)
    assert both(spark, path, four).count() < stg_transactions(three).count()


def test_a_slice_reads_only_its_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "stg")
    refresh_staged_transactions(spark, path, standin.raw_transactions(spark, sf_dir))
    text = plan(sinks.read_since(spark, path, datetime(2001, 6, 1)))
    assert "PartitionFilters: [isnotnull(date_part" in text and "m2001-06" in text
    got = sinks.read_since(spark, path, datetime(2001, 6, 1))
    assert 0 < got.count() < stg_transactions(standin.raw_transactions(spark, sf_dir)).count() / 10
    assert got.filter("transaction_timestamp < '2001-06-01'").count() == 0
