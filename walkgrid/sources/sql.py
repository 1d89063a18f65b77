"""Composable SQL on Spark: fragments that carry values, other fragments and DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from string import Template

from pyspark.sql import DataFrame, SparkSession

from walkgrid.sources.files import read_data


class SQL:
    """A SQL text with ``$name`` placeholders and what they stand for.

    A string, number, boolean or None becomes a bound parameter (never text in the statement); a DataFrame or another
    fragment becomes a relation. Spark plans the whole composition as one query. ``$names`` without a binding stay as
    they are.
    """

    def __init__(self, text: str, **bindings) -> None:
        for name, value in bindings.items():
            if value is not None and not isinstance(value, (bool, int, float, str, SQL, DataFrame)):
                raise ValueError(f"invalid type for {name}: {type(value).__name__}")
        self.text = text
        self.bindings = bindings

    def frame(self, spark: SparkSession) -> DataFrame:
        relations, values = {}, {}
        for name, value in self.bindings.items():
            if isinstance(value, SQL):
                relations[name] = value.frame(spark)
            elif isinstance(value, DataFrame):
                relations[name] = value
            else:
                values[name] = value
        text = self.text
        if relations:
            text = text.replace("{", "{{").replace("}", "}}")  # only relations may look like replacement fields
        marks = {**{n: f":{n}" for n in values}, **{n: "{" + n + "}" for n in relations}}
        return spark.sql(Template(text).safe_substitute(marks), args=values or None, **relations)


def query(spark: SparkSession, fragment: SQL | str) -> DataFrame:
    """Run a fragment; the result is lazy like any DataFrame."""
    return (fragment if isinstance(fragment, SQL) else SQL(fragment)).frame(spark)


def data(spark: SparkSession, path: str, format: str | None = None) -> SQL:
    """A fragment that reads a table from a path."""
    return SQL("select * from $source", source=read_data(spark, path, format))


def configure(
    spark: SparkSession,
    options: Iterable[str] = (),
    s3_region: str | None = None,
    s3_access_key: str | None = None,
    s3_secret_key: str | None = None,
) -> None:
    """Session options: statements such as ``SET key = value``, and credentials of the S3A file system."""
    settings = {
        "fs.s3a.endpoint.region": s3_region,
        "fs.s3a.access.key": s3_access_key if s3_secret_key else None,
        "fs.s3a.secret.key": s3_secret_key if s3_access_key else None,
    }
    for key, value in settings.items():
        if value:
            spark.conf.set(key, value)
    for statement in options:
        spark.sql(statement)
