"""Global row index and fixed-size message batches.

The reference walks a cursor in id order and sends every N rows as one JSON
array message.  A global ``row_number()`` over the whole table would run in
one task, so the index is built the way ``zipWithIndex`` does it, in
DataFrame form:

1. range-partition by id and sort within partitions; tag each row with
   ``monotonically_increasing_id`` (partition number in the high bits,
   position in the low bits);
2. write that once to the shared checkpoint folder, so every reader sees
   the same tags (and executor loss cannot re-tag rows differently);
3. count rows per partition — one row per partition, a size bounded by the
   partition count, never by the data — and turn counts into offsets;
4. broadcast the offsets (bounded as above) and add them to the local
   position: a dense 0-based index in id order;
5. ``batch = index div N`` and one grouped aggregate per batch; a group
   never holds more than N rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambry.operators.materialize import materialize

#: Rows of a range, about.
RANGE_ROWS = 500_000
_LOW = 33  # monotonically_increasing_id keeps the position in the low 33 bits


def global_index(df: DataFrame, order_col: str, num_ranges: int | None = None,
                 index_col: str = "row_index") -> DataFrame:
    spark = df.sparkSession
    # ranges follow the rows to index, not the cluster: few changed rows need no shuffle over all of it
    n = num_ranges or min(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // RANGE_ROWS + 1)
    tagged = (df.repartitionByRange(n, F.col(order_col)).sortWithinPartitions(order_col)
              .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "row-index")
    part = F.shiftright(F.col("__mid"), _LOW)
    counts = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__part"), _LOW)
    return (tagged.withColumn("__part", part)
            .join(F.broadcast(offsets), "__part")
            .withColumn(index_col, F.col("__off") + local)
            .drop("__part", "__off", "__mid"))


def _iso(c: F.Column, with_offset: bool) -> F.Column:
    """ISO-8601 text like Python's ``isoformat()``: fraction only when non-zero."""
    base = "yyyy-MM-dd'T'HH:mm:ss"
    off = "xxx" if with_offset else ""
    return (F.when(F.date_format(c, "SSSSSS") != "000000", F.date_format(c, base + ".SSSSSS" + off))
            .otherwise(F.date_format(c, base + off)))


def _encode(rows: DataFrame) -> list[F.Column]:
    """Message value encoding (H15): decimals as JSON numbers, timestamps as
    ISO text (zone-aware ones with their offset), dates as ``yyyy-MM-dd``."""
    out = []
    for c, t in rows.dtypes:
        col = F.col(c)
        if t.startswith("decimal"):
            col = col.cast("double")
        elif t == "timestamp_ntz":
            col = _iso(col, with_offset=False)
        elif t == "timestamp":
            col = _iso(col, with_offset=True)
        out.append(col.alias(c))
    return out


def message_batches(rows: DataFrame, id_col: str, batch_size: int,
                    num_ranges: int | None = None) -> DataFrame:
    """One row per message: ``batch_no, n_rows, first_id, last_id, value``.

    ``value`` is the JSON array of the batch's rows in id order; decimals are
    sent as JSON numbers (the reference converts them to float) and
    timestamps as ISO text.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    payload_cols = rows.columns
    indexed = global_index(rows.select(*_encode(rows)), id_col, num_ranges)
    grouped = (indexed.withColumn("batch_no", F.floor(F.col("row_index") / batch_size).cast("long"))
               .groupBy("batch_no")
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    F.min(id_col).alias("first_id"),
                    F.max(id_col).alias("last_id"),
                    F.array_sort(F.collect_list(F.struct("row_index", F.struct(*[F.col(c) for c in payload_cols]).alias("row"))))
                    .alias("__rows")))
    return grouped.select("batch_no", "n_rows", "first_id", "last_id",
                          F.to_json("__rows.row").alias("value"))


def write_messages(messages: DataFrame, path: str | None = None,
                   kafka_options: dict | None = None) -> None:
    """Sink: Kafka when options are given (needs the Kafka connector on the
    classpath; untested here), else JSON lines at ``path``."""
    if kafka_options:
        (messages.select(F.col("value").cast("string"))
         .write.format("kafka").options(**kafka_options).save())
    elif path:
        messages.write.mode("overwrite").json(path)
    else:
        raise ValueError("give a path or kafka options")
