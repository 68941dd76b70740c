"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

Each document draws an exponential key divided by its quality weight; the smallest keys are a weighted sample without
replacement. A source whose target is T words of S takes floor(T / S) complete epochs, then documents in the order of
their keys until the rest of T is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bedwatch.llm.common import whole_text

WORD = r"[^\x20\x09-\x0D]+"


def quality_weight(text: Column) -> Column:
    """0.25 to 1: the share of letters (anything outside ASCII counts as one) in a text; 0.25 for an empty one."""
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    return F.when(F.length(text) > 0, F.lit(0.25) + F.lit(0.75) * letters / F.length(text)).otherwise(F.lit(0.25))


def sampling_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, u in (0, 1) from an MD5 of seed and id: reruns agree, in Spark as in any SQL."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13),
                    16, 10).cast("double")
    return -F.log((number + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """Adds target to (source, source_size): shares by weight 1, 2, 3 repeating in code point order, null last.

    Targets stop at ``most`` times the source's size and the excess is dealt again by weight. In closed form: sorted by
    limit per weight, a source is full exactly if, with all before it full, its share of what is left reaches its limit.
    One row per source: this table has as many rows as there are sources, not documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    ranked = ranked.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranked = ranked.withColumns({
        "left_size": F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "left_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    full = F.col("left_size") * F.col("weight") >= F.col("limit") * F.col("left_weight")
    ranked = ranked.withColumn("full", full)
    spread = (F.sum("source_size").over(everything)
              - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0.0)))
    weights = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return ranked.select("source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(
        F.col("weight") * (spread / weights)).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", buckets: int = 4096, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """(doc_id, source, text_hash, key, size, source_size, target, taken), one row per row of ``docs``.

    ``taken`` is the document's words times the number of times the mix takes it. The last document of the fractional
    part is taken if at least half of it fits. Null or empty texts have size 0 and are never taken; a null source is
    a source; repeated rows share a key and are drawn one after the other, each on what those before it left. Documents
    with equal keys go by doc_id, then size, then text.

    No source is gathered: keys are dealt into ``buckets`` ranges, sizes are summed per source and range (combined
    before the shuffle), and only the rows of one range are ordered at a time, however large the source is.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        sampling_key(F.col(id_col).cast("long"), quality_weight(text), seed).alias("key"))
    # 1 - exp(-key * w) is uniform for weight w; any monotonous function of the key would do
    rows = rows.withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key") * 0.8)) * buckets).cast("int"))

    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    of_source = Window.partitionBy("source")
    sums = sums.withColumns({
        "source_size": F.sum("bucket_size").over(of_source),
        "before": F.coalesce(F.sum("bucket_size").over(
            of_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    per_source = sums.groupBy("source").agg(F.max("source_size").alias("source_size"))
    goals = targets(per_source).withColumnRenamed("source", "__source").drop("source_size")
    plan = sums.join(goals, F.col("source").eqNullSafe(F.col("__source"))).select(
        F.col("source").alias("__source"), F.col("bucket").alias("__bucket"), "source_size", "before", "target")
    drawn = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))

    # by rows: the default frame would put equal rows behind all of each other
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    start = F.col("before") + F.sum("size").over(within) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    drawn = drawn.withColumns({"start": start, "epochs": epochs.cast("long")})
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    again = (F.col("start") + F.col("size") / F.lit(2.0) <= rest) & (rest > 0)
    taken = F.col("size") * (F.col("epochs") + again.cast("long"))
    return drawn.select("doc_id", "source", "text_hash", "key", "size", "source_size", "target", taken.alias("taken"))


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` (same columns) with each document as often as ``mixed`` takes it: not at all, or up to 3 times.

    Rows are told apart by doc_id, source and text. Rows equal in these three come as often as ``mixed`` takes them
    together, all as copies of one of them, whose other columns they have.
    """
    times = mixed.filter("taken > 0").groupBy("doc_id", "source", "text_hash").agg(
        F.sum((F.col("taken") / F.col("size")).cast("long")).alias("__times")).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__hash"), "__times")
    one = docs.withColumn("__text", F.xxhash64(whole_text()))
    joined = one.join(times, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                      & F.col("source").cast("string").eqNullSafe(F.col("__source"))
                      & (F.col("__text") == F.col("__hash")))
    first = joined.dropDuplicates(["doc_id", "source", "__text"])
    return first.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(docs.columns)


ORACLE = r"""
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
             / 4503599627370496.0)
         / (CASE WHEN length(coalesce(text, '')) > 0
            THEN 0.25 + 0.75 * length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g')) / length(text)
            ELSE 0.25 END) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM r GROUP BY source),
w AS (SELECT *, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3.0 * source_size AS lim FROM s),
f AS (SELECT *,
        sum(source_size) OVER () - coalesce(sum(lim) OVER p, 0) AS left_size,
        sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS left_weight
      FROM w WINDOW p AS (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, left_size * weight >= lim * left_weight AS is_full FROM f),
t AS (SELECT source, source_size,
        CASE WHEN is_full THEN lim ELSE weight * (
          (sum(source_size) OVER () - coalesce(sum(CASE WHEN is_full THEN lim END) OVER (), 0))
          / sum(CASE WHEN NOT is_full THEN weight END) OVER ()) END AS target FROM g),
o AS (SELECT r.doc_id, r.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
        sum(r.size) OVER (PARTITION BY r.source ORDER BY key, doc_id, r.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - r.size AS start
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN start + size / 2.0 <= target - epochs * source_size
                                   AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
