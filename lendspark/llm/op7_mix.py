"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id. Sizes are summed by (source,
leading hash bits); the budget of a source becomes a hash threshold, found
level by level: each level looks only at the one bucket in which the budget
ends and splits it by the next 12 bits. The mix is then the filter
``hash < threshold``, so nothing is sorted and a larger budget always keeps
what a smaller one kept.

Only DataFrame functions are used. Partial sums are made before every
shuffle, so a hot source costs at most one row per task and bucket.

Defined cases: a null source is a source of its own (last in order); a null
text has size 0; a null id hashes like the empty text; rows with equal ids
share a hash and are taken or left together; an empty table gives an empty
result; sources without words have target 0. Extra columns pass through
``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stage, table

HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the id's md5, as a non-negative long."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    The shared total is ``share`` times all sizes. A target never exceeds
    ``max_epochs`` times its source; the excess goes to the others by
    weight. With sources in ascending order of cap / weight, the level is
    the first at which the rest fits under its own caps. The windows run
    over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    t = (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("pos", F.row_number().over(by_cap))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_weight"))
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("pos", "level"))
    return t.withColumn("level", F.coalesce(F.min(fits).over(every)["level"], F.max("ratio").over(every))).select(
        "source", "source_size", "weight", F.least("cap", F.col("level") * F.col("weight")).alias("target")
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole passes, and the hash below which one more is taken.

    ``sized`` has (source, size, h). The state per source is the hash prefix
    of the boundary bucket and the words below it.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = targets.withColumn("whole", whole).select(
        "source", "source_size", "target", "whole",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"),
        F.lit(True).alias("found"), F.lit(0).cast("long").alias("unit"),
    )
    state = stage(state, "mix-state")
    in_order = Window.partitionBy("source").orderBy("bucket")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        edge = state.filter("found").select(F.col("source").alias("s"), "prefix", "below", "rest")
        inside = sized.join(
            edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        )
        buckets = (
            inside.groupBy("source", F.shiftright("h", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.max("below").alias("below"), F.max("rest").alias("rest"))
            .withColumn("upto", F.col("below") + F.sum("words").over(in_order))
        )
        # The first bucket that passes the budget holds the boundary.
        bound = (
            buckets.filter("upto > rest")
            .groupBy(F.col("source").alias("s"))
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"), "words")).alias("b"))
        )
        state = state.join(bound, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "whole", "rest",
            F.coalesce("b.bucket", "prefix").alias("prefix"),
            F.coalesce("b.below", "below").alias("below"),
            F.col("b").isNotNull().alias("found"),
            F.coalesce("b.words", "unit").alias("unit"),
        )
        state = stage(state, "mix-state")
    # A single hash value is left. It is taken if that comes nearer.
    near = F.col("below") + F.col("unit") - F.col("rest") < F.col("rest") - F.col("below")
    limit = F.when(F.col("found"), F.col("prefix") + near.cast("long")).otherwise(F.lit(1 << HASH_BITS))
    return state.select("source", "source_size", "target", "whole", F.when(F.col("rest") > 0, limit).otherwise(F.lit(0)).cast("long").alias("limit"))


def plan_mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
    weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
) -> tuple[DataFrame, DataFrame]:
    """(documents as (doc_id, source, size, h), thresholds by source)."""
    sized = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"), id_hash(F.col(doc_id)).alias("h"),
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sized, thresholds(sized, source_targets(sizes, weights, share, max_epochs))


def copies(h: Column) -> Column:
    """How often the mix takes a document whose source's thresholds are joined."""
    return F.col("whole") + (h < F.col("limit")).cast("long")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixed documents: each row repeated as often as the mix takes it,
    with the columns of ``docs``."""
    _, limits = plan_mix(docs, text, doc_id, source, **options)
    cut = limits.select(F.col("source").alias("__mix_source"), F.col("whole").alias("__mix_whole"), F.col("limit").alias("__mix_limit"))
    times = F.col("__mix_whole") + (id_hash(F.col(doc_id)) < F.col("__mix_limit")).cast("long")
    rows = docs.join(cut, F.col(source).eqNullSafe(F.col("__mix_source")), "left").withColumn("__mix_n", times.cast("int"))
    return rows.filter("__mix_n > 0").withColumn("__mix_n", F.explode(F.expr("sequence(1, __mix_n)"))).select(*docs.columns)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document of ``documents``: size, its source's size and target, and
    the words the mix takes of it."""
    sized, limits = plan_mix(table(spark, sf_dir, "documents"))
    t = limits.withColumnRenamed("source", "s")
    return sized.join(t, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("h"))).alias("taken")
    )


def mix_sql(documents: str = "documents") -> str:
    """The same by sorting: running sums over each source in hash order."""
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM {documents}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
caps AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CAST(2 * source_size AS DOUBLE) / weight AS ratio FROM sources),
levels AS (
  SELECT a.ratio, (1.5::DOUBLE * CAST((SELECT sum(source_size) FROM sources) AS DOUBLE)
                   - coalesce(sum(b.cap) FILTER (b.ratio < a.ratio), 0::DOUBLE))
                  / sum(b.weight) FILTER (b.ratio >= a.ratio) AS level
  FROM caps a, caps b GROUP BY a.source, a.ratio),
fit AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level <= ratio),
goals AS (SELECT source, source_size, least(cap, level * weight) AS target FROM caps, fit),
parts AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS whole,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto,
         CAST(sum(size) OVER (PARTITION BY d.source, h) AS BIGINT) AS unit
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN target - whole * source_size <= 0 THEN 0
                            WHEN upto <= target - whole * source_size THEN 1
                            WHEN upto - unit > target - whole * source_size THEN 0
                            WHEN upto - (target - whole * source_size)
                                 < (target - whole * source_size) - (upto - unit) THEN 1
                            ELSE 0 END) AS taken
FROM parts"""


QUERIES = {"op7_mix": op7_mix}
SQL = {"op7_mix": mix_sql()}
