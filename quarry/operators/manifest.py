"""A saved model's manifest: what its tables must hold, checked when it is loaded.

The manifest is one JSON line beside the tables. It has the model's kind, names and parameters, and for each
table its columns with types, its number of rows and a checksum: the sum of a 64-bit hash of
every row, which does not depend on their order. One aggregation a table makes and checks it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 1


class ModelError(ValueError):
    """A saved model that is not what was saved, or not what was asked for."""


def describe(table: DataFrame) -> dict:
    """Columns with their types, number of rows and checksum of a table."""
    names = sorted(table.columns)
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*names).cast("decimal(38,0)")).alias("s")).first()
    return {"columns": {f.name: f.dataType.simpleString() for f in table.schema.fields}, "rows": row["n"], "checksum": str(row["s"] or 0)}


def write(spark: SparkSession, path: str, kind: str, content: dict, tables: list[str]) -> None:
    """Write the manifest of the ``tables`` that were saved below ``path``: the last thing written, so a broken save has none."""
    found = {name: describe(spark.read.parquet(f"{path}/{name}")) for name in tables}
    text = json.dumps({"version": VERSION, "kind": kind, **content, "tables": found}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def read(spark: SparkSession, path: str, kind: str) -> dict:
    """The manifest of a model of ``kind``, after its tables were checked against it."""
    try:
        rows = spark.read.text(f"{path}/manifest").collect()    # one line
    except Exception as error:
        raise ModelError(f"{path} holds no finished model: its manifest cannot be read") from error
    found = json.loads(rows[0]["value"]) if len(rows) == 1 else {}
    if found.get("kind") != kind or found.get("version") != VERSION:
        raise ModelError(f"{path} holds a model of kind {found.get('kind')!r}, version {found.get('version')!r}, not {kind!r}, version {VERSION}")
    for name, want in found["tables"].items():
        table = spark.read.parquet(f"{path}/{name}")
        have = {f.name: f.dataType.simpleString() for f in table.schema.fields}
        for column in sorted({*want["columns"], *have}):
            if want["columns"].get(column) != have.get(column):
                raise ModelError(f"column {column!r} of the model table {name!r} in {path} is {have.get(column, 'missing')}, saved was {want['columns'].get(column, 'none')}")
        if describe(table) != want:
            raise ModelError(f"the rows of the model table {name!r} in {path} are not those that were saved")
    return found
