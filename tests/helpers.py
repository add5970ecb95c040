"""What several test modules share; its own module, as each folder of tests has a conftest."""

SMALL = "/root/testdata/sf0.001"


def column_values(df, name):
    """Values of a column in the order of the `row` column."""
    return [r[name] for r in df.orderBy("row").collect()]


def texts(spark, values, name="x"):
    return spark.createDataFrame(list(enumerate(values)), f"row int, `{name}` string")


def write_out(df):
    """Evaluates every column, which `count()` would not."""
    df.write.format("noop").mode("overwrite").save()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
