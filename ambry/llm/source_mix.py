"""Mixing sources to target weights.

Every document gets a hash-random key; within each source the documents are
ordered by it, prefix sums of their sizes are computed bucket by bucket, and the
source is cut at its exact budget.  A budget above the source's size repeats it
epoch by epoch in the same order; the document at the cut is taken in part.

Shares: sources in code-point order, null last, weigh ``WEIGHTS`` in turn and
share all sizes; a target stops at ``MAX_EPOCHS`` times its source's size and
the excess is shared again by weight until none is above.

Defined cases: a null source is a source of its own and the last; a text that is
null or has no word has size 0 and is taken 0 times over; equal keys are ordered
by doc_id, size and text; rows equal in all of these share evenly what the cut leaves them; an empty
table gives an empty result; columns that the operator adds replace any of the
same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import brought_back, n_words, set_aside, written

#: Weights of the sources, in turn.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often.
MAX_EPOCHS = 3
#: Documents of a source are ordered in key ranges of about so many rows.
BUCKET_ROWS = 20_000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """``target`` for each row of ``sources`` (source, source_size); one row per source.

    Sources reach their cap in the order of cap / weight; those before the first that isn't
    reached are full, and the others share what is left by weight.  This closed form equals
    sharing the excess again and again.  The number of sources is taken to fit one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    w = sources.withColumn("_w", weight).withColumn("_cap", (F.col("source_size") * cap).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = (w.withColumn("_total", F.sum("source_size").over(whole).cast("double"))
         .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         .withColumn("_weights", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("_rate", F.col("_left") / F.col("_weights")))
    # the first source, in this order, whose share stays within its cap, sets the rate for itself and the rest
    w = w.withColumn("_final", F.first(
        F.when(F.col("_rate") * F.col("_w") <= F.col("_cap"), F.col("_rate")), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return w.withColumn("target", F.least("_cap", F.coalesce(F.col("_final"), F.lit(float("inf"))) * F.col("_w"))) \
            .select("source", "source_size", "target")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with size, hash-random key and what orders equal keys."""
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return (docs.withColumn("size", n_words(F.col("text"))).withColumn("_key", key)
            .withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 62)))).withColumn("_tie", F.xxhash64("text")))


def cuts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS,
         bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source: its size, target, whole epochs, and the document at its cut with the
    words that the rest of the budget leaves to it (``_part``, shared evenly by equal rows).

    The rows of a source never meet in one task: they are ordered in key ranges whose number
    follows the source's row count, and only the ranges' sums are summed along the source.
    """
    order = ["_key", "_id", "size", "_tie"]
    rows = written(_keyed(docs).groupBy("source", *order).agg(F.count("*").alias("_n")), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"), F.count("*").alias("_rows"))
    goal = targets(sources.select("source", "source_size"), weights, cap)
    # the first 7 hex digits of a key name one of 2^28 places; a source's ranges cut that evenly
    place = F.conv(F.substring("_key", 1, 7), 16, 10).cast("long")
    ranges = sources.select(F.col("source").alias("_s1"), (F.floor(F.col("_rows") / bucket_rows) + 1).alias("_ranges"))
    dealt = (rows.join(ranges, F.col("source").eqNullSafe(F.col("_s1"))).drop("_s1")
             .withColumn("_range", F.floor(place * F.col("_ranges") / (1 << 28))))
    sums = dealt.groupBy("source", "_range").agg(F.sum(F.col("size") * F.col("_n")).alias("_sum"))
    along = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    goal = (goal.withColumn("_epochs", F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))))
            .withColumn("_budget", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")))
    # a rest that rounds up to the whole source is one more epoch
    full = F.col("_budget") >= F.greatest(F.col("source_size"), F.lit(1))
    goal = goal.withColumns({"_epochs": F.when(full, F.col("_epochs") + 1).otherwise(F.col("_epochs")),
                             "_budget": F.when(full, 0).otherwise(F.col("_budget"))})
    # the one range of each source that holds the end of its budget
    hit = (sums.withColumn("_start", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
           .join(goal.select(F.col("source").alias("_s2"), "_budget"), F.col("source").eqNullSafe(F.col("_s2")))
           .where((F.col("_start") <= F.col("_budget")) & (F.col("_budget") < F.col("_start") + F.col("_sum")))
           .select("_s2", F.col("_range").alias("_r2"), "_start", "_budget"))
    inside = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = (dealt.join(hit, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_range") == F.col("_r2")))
             .withColumn("_at", F.col("_start") + F.coalesce(F.sum(F.col("size") * F.col("_n")).over(inside), F.lit(0)))
             .where((F.col("_at") <= F.col("_budget")) & (F.col("_budget") < F.col("_at") + F.col("size") * F.col("_n")))
             .select(F.col("source").alias("_s3"), F.struct(*order).alias("_cut"),
                     F.floor((F.col("_budget") - F.col("_at")) / F.col("_n")).alias("_part")))
    return (goal.join(found, F.col("source").eqNullSafe(F.col("_s3")), "left")
            .select(F.col("source").alias("_source"), "source_size", "target", "_epochs", "_cut", "_part"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with size, source_size, target, taken (words the mix takes, repeats counted).

    The cut table is written first and has one row per source; texts stay where they are when
    Spark finds it small enough to broadcast.
    """
    cut = written(cuts(docs.select("doc_id", "source", "text"), weights, cap, bucket_rows), "mix-cuts")
    own = F.struct("_key", "_id", "size", "_tie")
    # without a document at the cut the rest of the budget is 0
    rest = (F.when(F.col("_cut").isNull(), 0).when(own < F.col("_cut"), F.col("size"))
            .when(own == F.col("_cut"), F.col("_part")).otherwise(0))
    return (_keyed(docs.drop("size", "source_size", "target", "taken"))
            .join(cut, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("taken", (F.col("_epochs") * F.col("size") + rest).cast("long"))
            .drop("_key", "_id", "_tie", "_source", "_epochs", "_cut", "_part"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken.  The last copy of the document at
    a source's cut ends with the last word that the budget holds."""
    own = ["doc_id", "source", "text"]
    m = mix(set_aside(docs, own), **how)
    copies = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    m = m.where(F.col("taken") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("_copy") - 1) * F.col("size")).cast("int")
    pieces = F.split(F.col("text"), "(?<=[^ \\x09-\\x0D])(?=[ \\x09-\\x0D])")  # each ends with a word
    text = F.when(words < F.col("size"), F.array_join(F.slice(pieces, 1, words), "")).otherwise(F.col("text"))
    return brought_back(m.withColumn("text", text), docs.columns, own)


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


#: The same rows in DuckDB's SQL; the shares by sharing the excess again until none is left.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n,
             [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
r AS (  -- each round: the sources above their cap stop there, the others share the rest, until none is above
  SELECT *, bool_or(t > 3 * n) OVER () AS more FROM (
    SELECT 0 AS i, source, n, w, false AS full_, w * sum(n) OVER () / sum(w) OVER () AS t FROM s)
  UNION ALL
  SELECT *, bool_or(NOT full_ AND t > 3 * n) OVER () AS more FROM (
    SELECT i + 1 AS i, source, n, w, full_ OR t > 3 * n AS full_,
           CASE WHEN full_ OR t > 3 * n THEN 3 * n
                ELSE w * (sum(n) OVER () - sum(CASE WHEN full_ OR t > 3 * n THEN 3 * n ELSE 0 END) OVER ())
                     / sum(CASE WHEN full_ OR t > 3 * n THEN 0 ELSE w END) OVER () END AS t
    FROM r WHERE more)),
g AS (SELECT source, n, t FROM r WHERE NOT more),
p AS (SELECT d.*, g.n, g.t, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, n::BIGINT AS source_size, t AS target,
       (floor(t / greatest(n, 1)) * size
        + greatest(0, least(size, round(t - floor(t / greatest(n, 1)) * n) - before_)))::BIGINT AS taken
FROM p
"""
