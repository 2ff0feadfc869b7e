"""Maintained aggregates from signed deltas.

A change of a source row is its image before (sign -1) and after (sign +1); an
insert has only the second, a vanished row only the first.  A sum or a count per key
follows from the stored one by adding the signed rows' own sums and counts:

    delta   = sum(sign * measure), sum(sign) by key     of the changes alone
    result  = stored keys without a delta  ∪  stored + delta, where rows are left

so rows that move between keys, whose key becomes NULL or that vanish need no second
look at the source, whose unchanged rows are never scanned.  Counts of distinct values
are kept exact by a reference count per (key, value): a value enters or leaves a key
when its count leaves or reaches zero.

The changed keys are written once and, within a bound on their bytes, broadcast, so that the
stored fact streams past them.  Aggregates combine in the map tasks, so a hot key is no load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambry.operators.materialize import broadcast_if_small, materialize

SIGN = "__sign"
_KEY = "__key"


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign))


def net(rows: DataFrame) -> DataFrame:
    """Signed rows with equal ones added up; what cancels out is gone."""
    cols = [c for c in rows.columns if c != SIGN]
    return rows.groupBy(*cols).agg(F.sum(SIGN).cast("int").alias(SIGN)).where(F.col(SIGN) != 0)


def version_changes(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """How ``new`` differs from ``old`` in ``columns``, as a difference of multisets: no key is
    needed, repeated and NULL ones are no matter, unchanged rows cancel out map-side where both
    versions deal their rows alike, else in one shuffle."""
    return net(signed(new.select(*columns), 1).unionByName(signed(old.select(*columns), -1)))


@dataclass(frozen=True)
class Fact:
    """``rows``: signed source rows to signed rows with ``keys`` and what ``measures`` need.
    ``count`` names the measure that counts rows; ``distinct`` maps a measure to the column whose
    distinct values it counts (NULLs don't count); ``derived`` columns follow from the measures."""
    source: str
    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    measures: dict[str, tuple[Callable[[], Column], str]]
    count: str
    count_of: Callable[[], Column] = field(default=lambda: F.lit(1))
    distinct: dict[str, str] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)
    hidden: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return [*self.keys, self.count, *self.measures, *self.distinct]

    def whole(self, fact: DataFrame) -> DataFrame:
        """The fact with its derived columns."""
        return fact.withColumns({c: F.expr(e) for c, e in self.derived.items()})

    def public(self, stored: DataFrame) -> DataFrame:
        """The fact as its readers see it."""
        return self.whole(stored).drop(*self.hidden)

    def delta(self, changes: DataFrame) -> DataFrame:
        """keys, count and sums of signed source rows."""
        s = F.col(SIGN)
        return self.rows(changes).groupBy(*self.keys).agg(
            F.sum(self.count_of() * s).cast("bigint").alias(self.count),
            *[F.sum(m() * s).cast(t).alias(name) for name, (m, t) in self.measures.items()])


def split_by_keys(stored: DataFrame, touched: DataFrame, keys: tuple[str, ...], name: str) -> tuple[DataFrame, DataFrame]:
    """``stored`` without and with the keys of ``touched``; the stored rows stream past the keys when these are small."""
    key = F.struct(*[F.col(k) for k in keys])  # never NULL: a NULL part matches a NULL part
    some, _ = broadcast_if_small(touched.select(key.alias(_KEY)).distinct(), f"touched-{name}")
    marked = stored.withColumn(_KEY, key)
    return marked.join(some, _KEY, "left_anti").drop(_KEY), marked.join(some, _KEY, "left_semi").drop(_KEY)


def _merge(stored: DataFrame | None, delta: DataFrame, keys: tuple[str, ...], count: str, name: str) -> DataFrame:
    """``stored`` with ``delta`` added key by key; keys without rows are gone."""
    sums = [c for c in delta.columns if c not in keys]
    left = F.col(count)
    below = F.raise_error(F.lit(f"{name}: more rows taken off than were counted"))
    alive = F.when(left < 0, below).otherwise(left > 0)
    if stored is None:
        return delta.where(alive)
    delta = materialize(delta.where(" OR ".join(f"`{c}` <> 0" for c in sums)), f"delta-{name}")
    kept, hit = split_by_keys(stored.select(*delta.columns), delta, keys, name)
    hit = hit.unionByName(delta)
    added = hit.groupBy(*keys).agg(*[F.sum(c).cast(dict(delta.dtypes)[c]).alias(c) for c in sums]).where(alive)
    return kept.unionByName(added)


def maintain(fact: Fact, name: str, stored: dict[str, DataFrame], changes: DataFrame) -> dict[str, DataFrame]:
    """The fact's tables after ``changes``: the fact itself under ``name``, and one table of reference
    counts for each distinct measure (``<name>.<measure>``).  ``stored`` holds them as the last run
    left them; without any, ``changes`` are all rows."""
    delta = fact.delta(changes)
    out: dict[str, DataFrame] = {}
    for measure, value in fact.distinct.items():
        refs_name, keys = f"{name}.{measure}", (*fact.keys, value)
        rows = fact.rows(changes).where(F.col(value).isNotNull())
        moved = materialize(rows.groupBy(*keys).agg(F.sum(SIGN).cast("bigint").alias("n")).where("n <> 0"), f"refs-{refs_name}")
        before = stored.get(refs_name)
        out[refs_name] = _merge(before, moved, keys, "n", refs_name)
        # a value enters a key when its count leaves zero, and leaves it when it reaches zero
        if before is None:
            turned = moved.select(*fact.keys, F.lit(1).cast("bigint").alias(measure))
        else:
            had = split_by_keys(before, moved, keys, refs_name)[1].withColumn("_had", F.col("n"))
            pairs = had.unionByName(moved.withColumn("_had", F.lit(0).cast("bigint")))
            n = pairs.groupBy(*keys).agg(F.sum("_had").alias("_had"), F.sum("n").alias("n"))
            turned = n.select(*fact.keys, ((F.col("n") > 0).cast("bigint") - (F.col("_had") > 0).cast("bigint")).alias(measure))
        counted = turned.groupBy(*fact.keys).agg(F.sum(measure).cast("bigint").alias(measure))
        zeros = {c: F.lit(0).cast(t) for c, t in delta.dtypes if c not in fact.keys}
        delta = (delta.withColumn(measure, F.lit(0).cast("bigint")).unionByName(counted.withColumns(zeros))
                 .groupBy(*fact.keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in [*delta.dtypes, (measure, "bigint")] if c not in fact.keys]))
    out[name] = _merge(stored.get(name), delta, fact.keys, fact.count, name).select(*fact.columns())
    return out
