"""Rows that break a declared rule are set apart, so that they fail their tenant and no other.

Values are brought to their declared types with ``try_cast``; what has no such value, an amount too
large to be calculated with, and a null where none may be are rejected with tenant, key, rule and value. A
tenant with a rejected row takes no part in the run; the rows of the others do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..schemas import CLEAN_REQUIRED, KEY, MONEY, SOURCES
from .clean import KEPT, SCANNED

LARGEST = "1000000000000000"
"""Amounts from here on leave no room for the sums and differences of a settlement."""

REJECTS = "ad_client_id long, entity string, row_key string, rule string, column_name string, value string"


TOLERATED = {"c_payment": ["datetrx"]}
"""Required columns whose nulls settlement has a rule for: an undated payment settles nothing."""

LIST = "array<struct<rule:string,column_name:string,value:string>>"


def conformed(entity: str, rows: DataFrame, also: str | None = None) -> DataFrame:
    """The declared columns in their types, and ``_rejects``: (rule, column, value) of every broken rule.

    The column ``also`` is kept as it is, where there is one.
    """
    present = {f.name: f.dataType for f in rows.schema}
    typed, broken = [], []
    for field in SOURCES[entity]:
        name, kind = field.name, field.dataType.simpleString()
        value = f"try_cast(`{name}` AS {kind})"
        same = present[name] == field.dataType
        typed.append(f"`{name}`" if same else f"{value} AS `{name}`")
        if not same:
            broken.append((f"`{name}` IS NOT NULL AND {value} IS NULL", "type", name))
        if field.dataType == MONEY:
            broken.append((f"abs({value}) >= {LARGEST}", "amount", name))
    if also in present and also not in SOURCES[entity].fieldNames():
        typed.append(f"`{also}`")
    checks = [
        f"IF({condition}, struct('{rule}' AS rule, '{name}' AS column_name, CAST(`{name}` AS STRING) AS value), NULL)"
        for condition, rule, name in broken
    ]
    scanned = rows.where(SCANNED[entity]).selectExpr(*typed, f"CAST(array({', '.join(checks)}) AS {LIST}) AS _types")
    wanted = [c for c in CLEAN_REQUIRED[entity] if c not in TOLERATED.get(entity, [])]
    empty = " ".join(f"WHEN '{c}' THEN `{c}` IS NULL" for c in wanted)
    required = ", ".join(f"'{c}'" for c in wanted)
    # A row that cleaning leaves out may lack values.
    nulls = (
        f"IF(coalesce({KEPT[entity]}, false), transform(filter(array({required}), c -> CASE c {empty} END), "
        f"c -> struct('not_null' AS rule, c AS column_name, CAST(NULL AS STRING) AS value)), CAST(array() AS {LIST}))"
    )
    return scanned.withColumn("_rejects", F.expr(f"concat(filter(_types, x -> x IS NOT NULL), {nulls})")).drop("_types")


def rejects(entity: str, rows: DataFrame) -> DataFrame:
    """One row per broken rule of ``conformed`` rows."""
    key = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in KEY[entity])
    return rows.where("size(_rejects) > 0").selectExpr(
        "ad_client_id", f"'{entity}' AS entity", f"concat_ws(',', {key}) AS row_key", "inline(_rejects)"
    )


def split(batches: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The batches as conformed rows without their marks, and the rejects of all of them."""
    found = reduce(DataFrame.unionByName, [rejects(entity, rows) for entity, rows in batches.items()])
    return {entity: rows.drop("_rejects") for entity, rows in batches.items()}, found
