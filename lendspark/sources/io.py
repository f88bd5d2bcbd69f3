"""Readers and writers (IO1-IO8).

Columnar Parquet between stages; CSV only at the edges. A raw CSV is read in
byte ranges (a gzip file is one), cleaned of NA tokens, typed, given a
``row_id`` and landed as Parquet once, so the id is frozen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.nulls import INTEGER_TEXT, NUMERIC_TEXT, na_tokens_to_null, normalise_nan
from .csv_ranges import read_csv_text

ROW_ID = "row_id"


def text_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type of every text column that is not text, by one
    aggregate: ``boolean`` or ``bigint`` where every value is one, ``double``
    where every known value is a number."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        v = F.col(f"`{c}`")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.count(F.when(v.rlike(NUMERIC_TEXT), 1)).alias(f"d{i}"),
            F.count(F.when(v.rlike(INTEGER_TEXT) & F.trim(v).try_cast("bigint").isNotNull(), 1)).alias(f"i{i}"),
            F.count(F.when(F.lower(v).isin("true", "false"), 1)).alias(f"b{i}"),
        ]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(names):
        n = row[f"n{i}"]
        if n and n == row["rows"] == row[f"b{i}"]:
            out[c] = "boolean"
        elif n and n == row["rows"] == row[f"i{i}"]:
            out[c] = "bigint"
        elif n and n == row[f"d{i}"]:
            out[c] = "double"
    return out


def typed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns (but those in ``keep``) in their narrowest type."""
    types = {c: t for c, t in text_types(df).items() if c not in keep}
    return df.select(*[F.trim(F.col(f"`{c}`")).cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    key: str | None = None,
    partitions: int | None = None,
    infer_types: bool = True,
) -> DataFrame:
    """IO1: header CSV (gzip by extension) -> DataFrame with NA tokens as
    NULL and a ``row_id`` (the ``key`` column when given, else a generated
    id that a repeated task gives again).

    Uncompressed files are read in byte ranges, quoted line breaks included
    (:mod:`.csv_ranges`). Without a ``schema`` (DDL text) every column is text;
    ``infer_types`` then gives each its narrowest type by one aggregate over
    all rows. The records are staged on the way."""
    df = read_csv_text(spark, path, schema)
    if ROW_ID in df.columns or (key and key in df.columns):
        df = df.drop("_row")
    else:
        df = df.withColumnRenamed("_row", ROW_ID)
    if partitions:
        df = df.repartition(partitions)
    df = na_tokens_to_null(df)
    if schema is None and infer_types:
        df = typed(df, keep=[c for c in (ROW_ID, key) if c])
    if key and key in df.columns:
        df = df.withColumn(ROW_ID, F.col(f"`{key}`").cast("long"))
        return df.select(ROW_ID, *[F.col(f"`{c}`") for c in df.columns if c != ROW_ID])
    return df.withColumn(ROW_ID, F.col(ROW_ID).cast("long"))


def land(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """IO5: write a stage output as Parquet (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """IO2 / IO3: a stage table (Parquet, or CSV with a header). A first CSV
    column without a name is a written row index: it becomes ``row_id``
    unless there is one already. NaN is read as missing."""
    if path.endswith(".csv") or path.endswith(".csv.gz"):
        df = typed(na_tokens_to_null(read_csv_text(spark, path).drop("_row")))
        if df.columns and df.columns[0] in ("_c0", "Unnamed: 0"):
            df = df.drop(df.columns[0]) if ROW_ID in df.columns else df.withColumnRenamed(df.columns[0], ROW_ID)
        return normalise_nan(df)
    return normalise_nan(spark.read.parquet(path))


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """IO4: an input that does not exist -> ``None`` (dependent outputs
    skip). Any other failure is raised."""
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise

