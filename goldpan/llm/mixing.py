"""Mixing sources to target weights by capped water-filling and seeded repetitions.

Only DataFrame functions; the driver sees one number per round of the filling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest
from goldpan.llm.shared import stored

SALTS = 32
BUCKET_DIGITS = 4  # leading hex digits of a row's digest; a source is cut at one of 16**4 buckets, then inside that bucket


def word_count(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_level(sources: DataFrame, cap: int) -> float:
    """Level L at which the targets ``min(cap * source_size, weight * L)`` share the sum of all sizes.

    Every round clamps the sources above their cap and shares what they leave among the others; levels only rise, so a clamped
    source stays clamped and the loop ends after at most one round per source.
    """
    full = F.col("source_size") * cap
    level = 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) >= full
        row = sources.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(clamped, full).otherwise(0)).alias("fixed"),
            F.sum(F.when(~clamped, F.col("weight")).otherwise(0)).alias("free"),
        ).first()
        if not row["free"]:
            return level
        following = (row["total"] - row["fixed"]) / row["free"]
        if following <= level:
            return level
        level = following


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: source, source_size, weight, target.  Sources go by code point, null last; weights repeat."""
    # one row per source meets in the window
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long"))
    per_source = stored(per_source, "sources")
    level = water_level(per_source, cap)
    return per_source.withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), F.col("weight") * F.lit(level)))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: int = 11, id_column: str = "doc_id",
                source_column: str = "source", text_column: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """How often each row is taken so that every source meets its target.

    Whole repetitions go to every row of a source; the fraction goes to rows in the order of their digest, so the source ends within half
    a row of its target.  Rows without words have size 0 and take nothing; a null source is a source; null ids and repeated rows are
    rows like any other.  Columns of the result: id, ``size``, ``source_size``, ``target``, ``taken``, ``repeats`` and those in
    ``carry`` that have no such name; other columns are not read.
    """
    out = (id_column, "size", "source_size", "target", "taken", "repeats")
    carried = [c for c in carry if c not in out]
    sized = docs.select(
        F.col(id_column), F.col(source_column).alias("_source"), word_count(F.col(text_column)).alias("size"), *carried)
    narrow = stored(sized.select(F.col(id_column), F.col("_source").alias("source"), "size"), "sizes")
    if carried:
        rows = sized
    else:
        rows = narrow.withColumnRenamed("source", "_source")
    mark = digest(seed, [id_column])
    bucket = F.substring(mark, 1, BUCKET_DIGITS)

    targets = source_targets(narrow, weights, cap)
    plan = targets.select(
        F.col("source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))

    # the bucket in which a source's fraction ends, from sums per source and bucket
    sums = narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("s"))
    running = F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sums = sums.withColumn("upto", running).join(plan.select(F.col("source").alias("ps"), "need"), F.col("source").eqNullSafe(F.col("ps")))
    cut = (
        sums.where(F.col("upto") > F.col("need")).groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("need") - F.col("upto") + F.col("s")).alias("left"))).alias("cut"))
        .select(F.col("source").alias("cs"), "cut.bucket", "cut.left")
    )
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("cs")), "left").drop("cs").withColumnRenamed("bucket", "cut_bucket")

    # the plan has one row per source; its copies let a source with very many rows be joined in several tasks
    plan = plan.withColumnRenamed("source", "_plan_source").withColumn("_plan_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_mark", mark).withColumn("_salt", F.pmod(F.xxhash64(id_column, "size"), F.lit(SALTS)).cast("int"))
    joined = salted.join(plan, F.col("_source").eqNullSafe(F.col("_plan_source")) & (F.col("_salt") == F.col("_plan_salt")))
    own = F.substring("_mark", 1, BUCKET_DIGITS)
    at_cut = F.coalesce(own == F.col("cut_bucket"), F.lit(False))
    outside = joined.where(~at_cut).withColumn("extra", F.coalesce((own < F.col("cut_bucket")).cast("long"), F.lit(1)))
    before = F.sum("size").over(
        Window.partitionBy("_source").orderBy("_mark", id_column, "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    inside = joined.where(at_cut).withColumn("extra", (before + F.col("size") / 2 <= F.col("left")).cast("long"))
    both = outside.unionByName(inside).withColumn("repeats", F.col("whole") + F.col("extra"))
    return both.select(id_column, "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats", *carried)


def mix_sql(seed: int = 11, documents: str = "documents") -> str:
    """The same for ``documents`` in DuckDB, with weights 1, 2, 3 and a cap of 3."""
    return rf"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('{seed}' || coalesce('|' || doc_id::VARCHAR, '')) AS mark FROM {documents}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sizes GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total, row_number() OVER w AS n,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS fixed,
         sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS free
  FROM per_source WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
level AS (
  SELECT (total - fixed)::DOUBLE / free AS level FROM ordered
  WHERE (total - fixed)::DOUBLE / free <= 3.0::DOUBLE * source_size / weight ORDER BY n LIMIT 1),
plan AS (
  SELECT source, source_size, least(source_size * 3.0::DOUBLE, weight * coalesce((SELECT level FROM level), 0.0::DOUBLE)) AS target FROM per_source),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM plan),
places AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS need, substr(d.mark, 1, {BUCKET_DIGITS}) AS bucket,
         d.source, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mark, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS ahead
  FROM sizes d JOIN needs p ON d.source IS NOT DISTINCT FROM p.source),
buckets AS (
  SELECT source, bucket, max(ahead + size) AS upto, any_value(need) AS need FROM places GROUP BY source, bucket),
cuts AS (SELECT source, min(bucket) AS cut FROM buckets WHERE upto > need GROUP BY source),
decided AS (
  SELECT p.*, CASE WHEN c.cut IS NULL OR p.bucket < c.cut THEN 1 WHEN p.bucket > c.cut THEN 0
                   WHEN ahead + size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END AS extra
  FROM places p LEFT JOIN cuts c ON p.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, size * (whole + extra) AS taken, whole + extra AS repeats FROM decided
"""
