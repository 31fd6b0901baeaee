"""Small helpers for hand-written rows."""

from datetime import datetime


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def bag(df, *cols):
    """Rows as a sorted list of tuples."""
    rows = (df.select(*cols) if cols else df).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def final_plan(df) -> str:
    """The physical plan after the query ran with adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
