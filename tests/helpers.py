"""Helpers that several test modules import."""


def rows(df, *cols):
    """Sorted list of tuples for stable comparisons."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def plan_text(df) -> str:
    """Formatted physical plan with full scan metadata (PushedFilters,
    ReadSchema are otherwise cut at 100 characters)."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
