"""Deep pages through a page index (F1, F2).

``ORDER BY .. OFFSET k LIMIT n`` sorts and skips k rows for every page.  A page index
sorts once: the rows are written in folders, one after the other in the total order, with their
place in the folder, and one row per folder holds its count and how many rows lie before it.  A
page then looks up the folders that it meets and reads only these, and in them only the places
that it holds (a filter that the files' statistics answer), whatever the offset is.

Folders hold about ``range_rows`` rows, but more where there would be more than ``FOLDERS`` of them:
a folder costs a task, a file and a sample for its bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

PART, POS = "__part", "__pos"
#: Rows of a range, about.
RANGE_ROWS = 100_000
#: So many folders, or as many as hold so many rows each, are the most.
FOLDERS, FOLDER_ROWS = 256, 1_000_000


class PageIndex:
    """Pages of the rows below ``root`` in the order they were indexed by."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, order: list[str]):
        self.spark, self.root, self.schema, self.order = spark, root.rstrip("/"), schema, order

    @classmethod
    def build(cls, df: DataFrame, order: list[str], root: str, range_rows: int = RANGE_ROWS) -> "PageIndex":
        """Write ``df`` in the order of ``order``, which must be a total order, and the folders' counts.

        NULLs come first.  The prefix sums are over one row per folder.
        """
        spark, n = df.sparkSession, df.count()
        folders = min(n // range_rows + 1, max(FOLDERS, n // FOLDER_ROWS + 1))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))   # the row's number in its partition
        (df.repartitionByRange(folders, *order).withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *order).withColumn(POS, place)
         .write.mode("overwrite").partitionBy(PART).parquet(f"{root}/rows"))
        index = cls(spark, root, df.schema, order)
        counts = index._rows().groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
        (counts.withColumn("start", F.coalesce(before, F.lit(0))).withColumn("range_rows", F.lit(range_rows).cast("long"))
         .coalesce(1).write.mode("overwrite").parquet(f"{root}/folders"))
        return index

    def _rows(self) -> DataFrame:
        # the whole set of folders is discovered from their names
        return self.spark.read.schema(StructType([*self.schema.fields]).add(POS, LongType()).add(PART, IntegerType())).parquet(f"{self.root}/rows")

    def _folders(self) -> DataFrame:
        return self.spark.read.schema(f"{PART} int, n long, start long, range_rows long").parquet(f"{self.root}/folders")

    def ranges(self) -> DataFrame:
        """The ranges of at most ``range_rows`` rows that follow each other in the folders."""
        first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.col("range_rows"))).alias("first")
        return (self._folders().select("*", first)
                .select(PART, F.least("range_rows", F.col("n") - F.col("first")).alias("n"), (F.col("start") + F.col("first")).alias("start")))

    def page(self, offset: int, limit: int) -> DataFrame:
        """``limit`` rows after the first ``offset``.  The first and last folder that the page meets are read and become
        a filter on folders, its places in them one on rows."""
        met = (self._folders().where((F.col("start") < offset + limit) & (F.col("start") + F.col("n") > offset))
               .agg(F.min(PART).alias("first"), F.min("start").alias("first_start"), F.max(PART).alias("last"), F.max("start").alias("last_start")).first())
        rows, part, pos = self._rows(), F.col(PART), F.col(POS)
        if met["first"] is None:
            return rows.where(F.lit(False)).drop(PART, POS)
        since, until = pos >= offset - met.first_start, pos < offset + limit - met.last_start
        if met["first"] == met["last"]:
            own = (part == met["first"]) & since & until
        else:
            own = part.between(met["first"], met["last"]) & ((part > met["first"]) | since) & ((part < met["last"]) | until)
        return rows.where(own).orderBy(PART, POS).drop(PART, POS)
