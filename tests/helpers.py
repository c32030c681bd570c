"""Small tables for tests."""

import pyarrow as pa


def frame(spark, rows, schema):
    """A DataFrame from tuples, without Python workers in its plan."""
    fields = [part.strip().split(" ")[0] for part in schema.split(",")]
    data = {name: [row[i] for row in rows] for i, name in enumerate(fields)}
    table = pa.table({name: pa.array(values) for name, values in data.items()})
    typed = spark.createDataFrame(table)
    kinds = {part.strip().split(" ")[0]: part.strip().split(" ", 1)[1] for part in schema.split(",")}
    return typed.selectExpr(*[f"cast(`{name}` as {kind}) as `{name}`" for name, kind in kinds.items()])


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
