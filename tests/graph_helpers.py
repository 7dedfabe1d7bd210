"""Helpers of the graph tests; not in conftest, whose name other folders use as well."""


def edges_df(spark, pairs, schema="src bigint, dst bigint"):
    return spark.createDataFrame([tuple(p) for p in pairs], schema)


def as_dict(df, key="id"):
    return {r[key]: r.asDict() for r in df.collect()}
