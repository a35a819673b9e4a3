"""Mixing sources to target weights, by nested hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, small, table

#: A document's place is a hash of 48 bits, refined 12 bits at a time.
LEVEL_BITS, LEVELS = 12, 4


def place(key: Column, text: Column) -> Column:
    """48 bits of md5 of the id as text, a colon and the text; nulls count as empty. DuckDB can compute the same."""
    whole = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeat: float) -> DataFrame:
    """(source, source_size) -> plus target.

    Sources in code-point order, null last, take the weights in turn. share * total size is dealt by weight; a source
    that would get more than max_repeat times its size stops there and the excess goes to the others by weight, until
    none is above. That ends at target = least(cap, weight * level), where the level follows from running sums over
    the sources by cap / weight. One row per source, so the windows below are small.
    """
    n = len(weights)
    everything = Window.partitionBy()
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("nth") % n + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "nth")
    level = (F.col("total") - (F.sum("cap").over(by_ratio) - F.col("cap"))) / (F.sum("w").over(everything) - (F.sum("w").over(by_ratio) - F.col("w")))
    return (
        sizes.withColumn("nth", order)
        .withColumn("w", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything) * F.lit(float(share)))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything))
        .select("source", "source_size", F.least("cap", F.coalesce(F.col("w") * F.col("level"), F.col("cap"))).alias("target"))
    )


def _boundary(rows: DataFrame, budgets: DataFrame, n_sources: int, level: int) -> DataFrame:
    """(source, prefix, budget): the bucket at this level in which the budget runs out, and what is left for it.

    rows: (source, place, size) of the bucket that the level before left open.
    """
    bucket = F.shiftright("place", LEVEL_BITS * (LEVELS - level))
    sums = rows.groupBy("source", bucket.alias("prefix")).agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("prefix"))
    return (
        sums.withColumn("upto", running)
        .join(small(budgets.select(F.col("source").alias("of"), "budget"), n_sources), F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("words") <= F.col("budget")))
        .select("source", "prefix", (F.col("budget") - (F.col("upto") - F.col("words"))).alias("budget"))
    )


def _extra_of_ties(ties: DataFrame) -> DataFrame:
    """ties (source, row, size, budget and further columns) plus extra: 1 for the rows that the budget still takes, else 0.

    The rows of one place are as good as always copies of one document, in any number. They are numbered within their
    partition of the stored table, and running sums of the partitions' words give each its share of the budget, so
    that no task holds all rows of a place.
    """
    part = F.shiftright("row", 33)
    ties = ties.withColumn("part", part)
    parts = ties.groupBy("source", "part").agg(F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("part")) - F.col("words"))
    parts = parts.select(F.col("source").alias("of"), F.col("part").alias("of_part"), "before")
    within = Window.partitionBy("source", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum("size").over(within)
    joined = ties.join(parts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).withColumn("upto", upto)
    start = F.col("upto") - F.col("size")
    taken = (F.col("upto") <= F.col("budget")) | ((start <= F.col("budget")) & (F.col("upto") - F.col("budget") < F.col("budget") - start))
    return joined.withColumn("extra", taken.cast("long")).drop("part", "of", "of_part", "before", "upto")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_repeat: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """How often the mix takes each row: id, source, size, source_size, target, copies, taken, and a struct `row` of the columns to carry.

    A source whose target is r times its size takes every document floor(r) times, and once more those whose hash, of
    id and text, lies under a threshold. The threshold comes from summed sizes by source and hash bucket; only the
    bucket in which the budget runs out is looked at again, so nothing is sorted and only sums are shuffled. Rows at the
    threshold itself, which are copies of one row, are taken one by one until the budget is nearest.

    Null text counts as size 0; null sources form a source of their own, last in order; null ids and repeated ids are
    rows like others; an empty table gives no rows; columns of docs that are neither named nor carried are ignored.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    measures = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.alias("size"), place(F.col(id_col), F.col(text_col)).alias("place"), F.monotonically_increasing_id().alias("row")]
    sized = materialize(docs.select(*measures), "sizes")
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    n_sources = totals.count()
    targets = source_targets(totals, weights, share, max_repeat)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = materialize(targets.withColumn("whole", whole), "targets")
    cut = targets.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")).where("budget > 0")
    rows = sized
    for level in range(1, LEVELS + 1):
        cut = materialize(_boundary(rows, cut, n_sources, level), f"cut{level}")
        prefix = F.shiftright("place", LEVEL_BITS * (LEVELS - level))
        open_bucket = small(cut.select(F.col("source").alias("of"), F.col("prefix").alias("open")), n_sources)
        rows = sized.join(open_bucket, F.col("source").eqNullSafe(F.col("of")) & (prefix == F.col("open"))).select("source", "place", "size")
    cut = cut.select(F.col("source").alias("cut_source"), F.col("prefix").alias("limit"), "budget")
    limits = targets.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(F.col("source").alias("of"), "source_size", "target", "whole", F.coalesce("limit", F.lit(0)).alias("limit"), "budget")
    whole_rows = docs.select(*measures, F.struct(*carry).alias("row_columns")) if carry else sized  # measured again, so that no text is written twice
    placed = whole_rows.join(small(limits, n_sources), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    at_limit = (F.col("place") == F.col("limit")) & F.col("budget").isNotNull()
    others = placed.where(~at_limit).withColumn("extra", (F.col("place") < F.col("limit")).cast("long"))
    out = others.unionByName(_extra_of_ties(materialize(placed.where(at_limit), "ties")))
    copies = F.col("whole") + F.col("extra")
    columns = ["source", "size", "source_size", "target"]
    return out.select(F.col("id").alias(id_col), *columns, copies.alias("copies"), (copies * F.col("size")).alias("taken"), *(["row_columns"] if carry else [])).withColumnsRenamed({"row_columns": "row"})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS BIGINT) AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(nth % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS cap, sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE AS total FROM s),
l AS (SELECT *, cap / w AS ratio, (total - (sum(cap) OVER a - cap)) / (sum(w) OVER () - (sum(w) OVER a - w)) AS level FROM w WINDOW a AS (ORDER BY cap / w, nth)),
t AS (SELECT source, source_size, least(cap, coalesce(w * max(CASE WHEN ratio >= level THEN level END) OVER (), cap)) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS UNBOUNDED PRECEDING) AS upto FROM d),
x AS (SELECT c.*, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size AS budget FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN upto <= budget OR (upto - size <= budget AND upto - budget < budget - (upto - size)) THEN 1 ELSE 0 END) * size AS taken FROM x
"""
