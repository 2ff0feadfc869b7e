"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

Every row descends the tree by weighted hash draws: at each level each child of
the node reached draws ``-ln(u) / weight`` with ``u`` hashed from the row's key
and the child's name, and the smallest draw wins.  A child wins with a chance in
proportion to its weight, and a changed weight moves rows only between the
changed child and its siblings, level by level: subtrees whose weights stay
keep their rows.  A new shard in a region of its own takes rows only into itself.

Only DataFrame functions: no Python code runs on the rows.

Defined cases: a null key is a key of its own; null text has no bytes (size 1,
crc32 0); repeated rows get the same shard and slots of their own; an empty
table gives an empty result; other columns pass through ``assign_shards`` as
they are, but the columns it adds replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shards of the query.
SHARDS = 8
#: Racks in a region and shards in a rack of the regular layout.
RACKS, RACK_SHARDS = 2, 2
#: Slots are numbered in buckets of about so many distinct rows.
BUCKET_ROWS = 20_000
#: Equal rows that one task gives their slots.
RUN_ROWS = 100_000

#: (region, rack, shard id, weight)
Leaf = tuple[str, str, int, float]


def layout(shards: int, base: int = SHARDS) -> list[Leaf]:
    """Shards below ``base`` fill regions of ``RACKS`` racks with ``RACK_SHARDS`` shards each; each
    later one gets a region of its own, so that growth takes rows only into the new shard."""
    leaves = []
    for s in range(shards):
        if s < base:
            region, rest = divmod(s, RACKS * RACK_SHARDS)
            leaves.append((f"region{region}", f"region{region}/rack{rest // RACK_SHARDS}", s, 1.0))
        else:
            leaves.append((f"grown{s}", f"grown{s}/rack0", s, 1.0))
    return leaves


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.concat_ws("\x1f", F.lit(name), key)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def _choose(key: Column, options: Sequence[tuple[str, float, Column]]) -> Column:
    """The value of the option with the smallest draw (by name where draws tie)."""
    options = [o for o in options if o[1] > 0]
    if len(options) == 1:
        return options[0][2]
    return F.array_min(F.array(*[
        F.struct(_draw(key, name, weight).alias("draw"), F.lit(name).alias("name"), value.alias("value"))
        for name, weight, value in options]))["value"]


def shard_of(key: Column, leaves: Sequence[Leaf]) -> Column:
    """The shard that ``key`` descends to; leaves without weight get nothing."""
    if not any(w > 0 for *_, w in leaves):
        raise ValueError("no shard has any weight")

    def descend(some: Sequence[Leaf], level: int) -> Column:
        if level == 2:
            return _choose(key, [(f"shard{s}", w, F.lit(s)) for _, _, s, w in some])
        groups: dict[str, list[Leaf]] = {}
        for leaf in some:
            groups.setdefault(leaf[level], []).append(leaf)
        names = [(n, sum(x[3] for x in g)) for n, g in groups.items()]
        chosen = _choose(key, [(n, w, F.lit(n)) for n, w in names])
        out = None
        for n, w in names:
            if w > 0:  # only the branch of the chosen child is evaluated
                below = descend(groups[n], level + 1)
                out = F.when(chosen == n, below) if out is None else out.when(chosen == n, below)
        return out if len([n for n, w in names if w > 0]) > 1 else descend(groups[next(n for n, w in names if w > 0)], level + 1)

    return descend(list(leaves), 0).cast("int")


def assign_shards(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with size, text_crc32, law, shard and grown_shard, in one pass without a shuffle."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))
    whole = F.coalesce(F.col(text), F.lit(""))
    return (df.withColumn("size", (F.octet_length(whole) + 1).cast("long"))
            .withColumn("text_crc32", F.crc32(whole.cast("binary")))
            .withColumn("law", F.lit("key"))
            .withColumn("shard", shard_of(k, layout(shards)))
            .withColumn("grown_shard", shard_of(k, layout(shards + 1))))


def slots(assigned: DataFrame, key: str = "doc_id", bucket_rows: int = BUCKET_ROWS, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per row of ``assigned`` with its slot, gapless from 0 in each shard.

    Equal rows are counted first, so that a hot key is one row from then on; slots are prefix
    sums of these counts, over hash buckets within a shard and then over a shard's buckets.
    """
    cols = [key, "size", "text_crc32", "law", "shard", "grown_shard"]
    order = F.xxhash64(F.lit("slot"), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in (key, "size", "text_crc32")])
    counted = assigned.groupBy(*cols).agg(F.count("*").alias("_n")).withColumn("_h", order)
    rows = counted.agg(F.count("*").alias("_all"))
    # buckets follow the size of the table: one count, read as a scalar subquery
    buckets = (F.floor(rows.scalar() / F.lit(bucket_rows * SHARDS)) + 1).cast("long")
    counted = counted.withColumn("_b", F.pmod(F.col("_h"), buckets))
    inner = Window.partitionBy("shard", "_b").orderBy("_h", F.col(key).asc_nulls_first(), "size", "text_crc32")
    starts = (counted.groupBy("shard", "_b").agg(F.sum("_n").alias("_sum"))
              .withColumn("_start", F.coalesce(F.sum("_sum").over(
                  Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("shard", "_b", "_start"))
    first = F.coalesce(F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_start")
    placed = counted.join(starts, ["shard", "_b"]).withColumn("_first", first).select(*cols, "_first", "_n")
    few = placed.where(F.col("_n") <= run_rows)
    # many equal rows are first cut into runs, which are dealt to tasks of their own
    runs = (placed.where(F.col("_n") > run_rows)
            .withColumn("_r", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / run_rows)))).repartition(F.col("_r"), *cols)
            .withColumn("_end", F.col("_first") + F.col("_n")).withColumn("_first", F.col("_first") + F.col("_r") * run_rows)
            .withColumn("_n", F.least(F.lit(run_rows).cast("long"), F.col("_end") - F.col("_first"))).select(*cols, "_first", "_n"))
    return few.union(runs).select(*cols, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return slots(assign_shards(docs.select("doc_id", "text"), shards)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
