"""Backups as lines of text with their schema, restored into the same schema or a changed one."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORRUPT
from ..sinks.exports import write_ndjson


def write_backup(df: DataFrame, path: str) -> None:
    """All rows of ``df`` as JSON lines, and its schema beside them."""
    write_ndjson(df, f"{path}/rows")
    kept = df.sparkSession.range(1).select(F.lit(df.schema.json()).alias("value"))
    kept.coalesce(1).write.mode("overwrite").text(f"{path}/schema")


def read_backup(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they were, and a line that no longer parses as such in ``_corrupt_record``."""
    schema = T.StructType.fromJson(_json(spark, path))
    audited = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(audited).option("columnNameOfCorruptRecord", CORRUPT).json(f"{path}/rows")


def _json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/schema").first()[0])


def _fitted(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """``value`` in the new type; null if it does not fit.

    A number that would lose digits does not fit, nor does a text that is no such value.
    """
    if old == new:
        return value
    cast = value.try_cast(new)
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return F.when(cast.try_cast(old) == value, cast)
    return cast


def _mapped(rows: DataFrame, schema: T.StructType, renamed: Mapping[str, str]) -> dict[str, tuple[Column, Column]]:
    """The old and the new value of each column of ``schema``; a column the backup has not is null."""
    old = {f.name: f.dataType for f in rows.schema.fields}
    out = {}
    for field in schema.fields:
        source = renamed.get(field.name, field.name)
        none = F.lit(None)
        if source not in old:
            out[field.name] = (none, none.cast(field.dataType))
        else:
            value = F.col(source)
            out[field.name] = (value, _fitted(value, old[source], field.dataType))
    return out


def restore(spark: SparkSession, path: str, schema: T.StructType, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """A backup's rows in the columns and types of ``schema``.

    Columns are matched by name; ``renamed`` has the old names of those that were renamed.
    Columns that the backup lacks are null, those that ``schema`` lacks are left out, and a value
    that does not fit its new type is null (``restore_report`` counts them). Lines that no
    longer parse are left out.
    """
    rows = read_backup(spark, path)
    values = _mapped(rows, schema, renamed or {})
    whole = rows.filter(F.col(CORRUPT).isNull())
    return whole.select(*(new.alias(name) for name, (_, new) in values.items()))


def restore_report(
    spark: SparkSession, path: str, schema: T.StructType, renamed: Mapping[str, str] | None = None
) -> DataFrame:
    """What ``restore`` can't take over, as (what, name, rows): values of each column that do not
    fit, columns that are added or dropped (with the values they had), and torn lines."""
    renamed = renamed or {}
    rows = read_backup(spark, path)
    values = _mapped(rows, schema, renamed)
    old = [f.name for f in rows.schema.fields if f.name != CORRUPT]
    used = {renamed.get(f.name, f.name) for f in schema.fields}
    whole = F.col(CORRUPT).isNull()
    counts = [("torn", "", ~whole)]
    counts += [("unfit", name, whole & before.isNotNull() & after.isNull()) for name, (before, after) in values.items() if renamed.get(name, name) in old]
    counts += [("added", name, whole) for name in values if renamed.get(name, name) not in old]
    counts += [("dropped", name, whole & F.col(name).isNotNull()) for name in old if name not in used]
    totals = rows.agg(*(F.count_if(condition).alias(f"n{i}") for i, (_, _, condition) in enumerate(counts)))
    lines = [
        F.struct(F.lit(what).alias("what"), F.lit(name).alias("name"), F.col(f"n{i}").alias("rows"))
        for i, (what, name, _) in enumerate(counts)
    ]
    return totals.select(F.explode(F.array(*lines)).alias("line")).select("line.*").filter((F.col("what") != "unfit") | (F.col("rows") > 0))
