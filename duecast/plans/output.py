"""Result columns in types that compare exactly between engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Money as doubles with two digits, other reals rounded, counts as longs.

    Sample deviations keep four digits: they are summed in floating point.
    """
    shown = []
    for field in df.schema:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType):
            value = f"round(CAST({name} AS DOUBLE), 2)"
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = f"round(CAST({name} AS DOUBLE), {4 if field.name.startswith('std_') else digits})"
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            value = f"CAST({name} AS BIGINT)"
        elif isinstance(field.dataType, T.BooleanType):
            value = f"CAST(CAST({name} AS INT) AS BIGINT)"
        else:
            value = name
        shown.append(f"{value} AS {name}")
    return df.selectExpr(*shown)


def sql_columns(spec: str) -> str:
    """The same for SQL: ``name:kind`` items, kind one of m r s i t x.

    m money, r real, s deviation, i integer, t timestamp, x as it is.
    """
    forms = {
        "m": "round(CAST({0} AS DOUBLE), 2)",
        "r": "round(CAST({0} AS DOUBLE), 6)",
        "s": "round(CAST({0} AS DOUBLE), 4)",
        "i": "CAST({0} AS BIGINT)",
        "t": "CAST({0} AS TIMESTAMP)",
        "x": "{0}",
    }
    items = (item.rsplit(":", 1) for item in spec.split())
    return ", ".join(f"{forms[kind].format(name)} AS {name}" for name, kind in items)
