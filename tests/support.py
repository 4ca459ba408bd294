"""Shared by the tests; a module of its own, as every folder of tests has a
``conftest`` and only one of them can be imported by that name."""

SF_SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, columns):
    """All-string DataFrame, as bronze tables are."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame(rows, schema)
