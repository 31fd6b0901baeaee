import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bankspark.llm.queries import ORACLE, QUERIES
from check_queries import TABLES, bag
from tests.llm.util import brute_components, brute_repeats, docs_frame, odd_rows, similar_docs
from tests.llm.test_decontam import brute as brute_hits


def test_registry_names_every_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(cols, cur.fetchall())


def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_near_dup_query_on_the_whole_table(spark, sf_dir):
    got = sorted((tuple(r) for r in QUERIES["op9_near_dup"](spark, sf_dir).collect()), key=repr)
    assert got == brute_components(documents(spark, sf_dir))


def test_suffix_query_on_the_whole_table(spark, sf_dir):
    import hashlib

    got = sorted(tuple(r) for r in QUERIES["op1_suffix_dedup"](spark, sf_dir).collect())
    assert got == sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_repeats(documents(spark, sf_dir), 200, "none"))


def test_packing_query_on_the_whole_table(spark, sf_dir):
    from tests.llm.test_packing import check

    check(documents(spark, sf_dir), QUERIES["op10_packing"](spark, sf_dir).collect())


def test_language_and_quality_queries_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    told = QUERIES["op7_language_id"](spark, sf_dir).join(docs, "doc_id").filter("held_out")
    assert told.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    assert QUERIES["op3_quality"](spark, sf_dir).filter("score between 0 and 1").count() == docs.count()


def test_stages_one_after_the_other(spark, sf_dir):
    """Each stage against its brute-force twin, on what the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        out = stage(spark, docs, sf_dir)
        if name == "packing":
            from tests.llm.test_packing import check

            check(before, out.collect())
            break
        assert out.columns == docs.columns
        rows = out.collect()
        after = sorted((r.doc_id, r.text) for r in rows)
        if name == "language_id":
            assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
        if name == "near_dedup":
            assert [i for i, _ in after] == [r[0] for r in sorted(brute_components(before)) if r[3]]
        if name == "suffix_dedup":
            want = {r[0]: r[4].decode("utf-8", "ignore") for r in brute_repeats(before, 200, "first")}
            had = dict(before)
            assert dict(after) == {i: t for i, t in want.items() if t.strip() or t == had[i]}
            assert all(r.n_chars == len(r.text) for r in rows if r.text != had[r.doc_id])
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            assert [i for i, _ in after] == [r[0] for r in sorted(brute_hits(before, items)) if not r[4]]
        docs = spark.createDataFrame(rows, docs.schema)


def test_stages_take_odd_rows_and_empty_tables(spark, sf_dir):
    for docs in (docs_frame(spark, odd_rows() + similar_docs(20)), docs_frame(spark, [(1, "a")]).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            n = out.count()
            if name != "packing":
                assert out.columns == docs.columns and n <= docs.count()


def test_run_goes_through_all_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
