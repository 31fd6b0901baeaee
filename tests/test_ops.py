from datetime import date, datetime
from decimal import Decimal

import pytest

from bankspark import session
from bankspark.operators import governance, ops, rows
from tests.util import bag, frame, ts


def test_run_log_and_tag(spark):
    tag = ops.set_run_tag(spark, "bank", "dev", "i1", "me")
    assert '"invocation_id": "i1"' in tag and "bank:dev:i1:me" in spark.getTags()
    spark.clearTags()
    row = ops.run_row("i1", datetime(2024, 1, 1), "fct", "model", "success", 1.23456)
    got = ops.log_run(spark, [row]).first()
    assert (got["node_name"], got["execution_time_s"], got["target_name"]) == ("fct", Decimal("1.2346"), "local")
    assert got["inserted_at"] is not None


def test_run_log_takes_a_frame_without_collecting_it(spark):
    row = ops.run_row("i1", datetime(2024, 1, 1), "fct", "model", "error", 1.5, "one\ntwo")
    listed = ops.log_run(spark, [row])
    frames = ops.log_run(spark, listed.drop("inserted_at").select(*reversed(listed.columns[:-1])))
    assert frames.dtypes == listed.dtypes
    assert frames.drop("inserted_at").collect() == listed.drop("inserted_at").collect()


def test_run_log_names_every_event(spark, tmp_path):
    from bankspark.checks.all import QUERIES

    rows_ = [(i, ts("2024-01-0%d 10:00:00" % (1 + i % 2)), "view") for i in (10, 9, 50, 51, 100, 9, 7)]
    frame(spark, "event_id bigint, ts timestamp_ntz, event_type string", *rows_).write.parquet(str(tmp_path / "events.parquet"))
    got = {r["node_name"]: r["message"].split("\n") for r in QUERIES["run_log"](spark, str(tmp_path)).collect()}
    assert got == {
        "view.2024-01-01": ["events: 3", "first: 10", "last: 100", "10", "50", "100"],
        "view.2024-01-02": ["events: 4", "first: 7", "last: 51", "7", "9", "9", "51"]}


def test_costs(spark):
    log = frame(
        spark, "query_tag string, query_type string, query_text string, execution_time bigint, credits_used decimal(18,4), credits_used_cloud_services decimal(18,4)",
        ("project=bank;1", "CREATE_TABLE_AS_SELECT", "insert\n into  mart.a select", 1500, Decimal("1"), Decimal("0.5")),
        ("project=bank;1", "CREATE_TABLE_AS_SELECT", "INSERT INTO mart.a", 500, Decimal("1"), Decimal("0")),
        ("other", "SELECT", "insert into mart.b", 500, Decimal("9"), Decimal("9")),
        ("other", "CREATE_TABLE_AS_SELECT", "no target", 100, Decimal("9"), Decimal("9")),
    )
    assert bag(ops.cost_by_tag(log, "project=bank")) == [("project=bank;1", Decimal("2.5000"))]
    assert bag(ops.cost_by_target(log)) == sorted([("mart.a", 2.0), (None, 0.1)], key=repr)


def test_access_audit(spark):
    log = frame(
        spark, "user_name string, role_name string, query_text string, database_name string, schema_name string, start_time timestamp_ntz, execution_status string, total_elapsed_time bigint, query_type string",
        ("u", "r", "q", "BANK", "s", ts("2024-01-31"), "OK", 1, "SELECT"), ("u", "r", "q", "BANK", "s", ts("2023-01-31"), "OK", 1, "SELECT"),
        ("u", "r", "q", "OTHER", "s", ts("2024-01-31"), "OK", 1, "SELECT"), ("u", "r", "q", "BANK", "s", ts("2024-01-31"), "OK", 1, "GRANT"),
    )
    got = governance.access_audit(log, "BANK", date(2024, 2, 10))
    assert got.count() == 1 and "query_type" not in got.columns


def test_sample(spark):
    assert rows.sample_rows(spark.range(100), 7).count() == 7


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf(**{k.replace("__", "."): v for k, v in values.items()})


def test_shared_folder_is_the_clusters():
    assert session.shared_dir(_Session(spark__checkpoint__dir="hdfs://x/ckpt/")) == "hdfs://x/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session(spark__master="spark://host:7077"))
