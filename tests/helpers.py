from pyspark.sql import DataFrame


def column(spark, values, dtype, expr):
    """``expr`` of one column ``a`` for each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, a {dtype}")
    return [r[1] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
