"""Touched-key incremental refresh of aggregate facts.

A fact keyed by K is brought up to date after new rows arrived by
recomputing only the keys that received a row newer than the watermark, and
replacing those keys in the previous result:

    touched   = keys of rows with ts > wm, and the keys that these rows
                had in the previous version of the source       (small)
    refreshed = aggregate(rows whose key is touched)            (semi join)
    result    = previous minus touched keys  ∪  refreshed       (anti join)

Both joins have the touched-key set on one side.  It is written once and
measured; up to ``BROADCAST_MAX_BYTES`` it is broadcast, so neither the
full source nor the previous result is shuffled.  Beyond that the semi join
is shuffled and salted for hot keys (``skew.skew_safe_join``); the aggregate
keeps partial aggregation, so a key with a third of all rows never lands in
one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.functions import ts_lit
from ambry.operators.materialize import broadcast_if_small
from ambry.operators.skew import skew_safe_join


_KEY = "__key"


def _key(keys: list[str]):
    """The keys as one struct, which is never NULL: a NULL part matches a NULL part."""
    return F.struct(*[F.col(k) for k in keys]).alias(_KEY)


def touched_keys(keyed: DataFrame, keys: list[str], ts_col: str, wm: _dt.datetime,
                 old: DataFrame | None = None, ids: list[str] | None = None) -> DataFrame:
    """Keys (one struct column) of the changed rows, and of their previous versions in ``old``
    (the source as it was at the watermark, keyed alike), found by the row ids ``ids``."""
    changed = keyed.where(F.col(ts_col) > ts_lit(wm))
    touched = changed.select(_key(keys))
    if old is not None:
        touched = touched.union(old.join(changed.select(*ids).distinct(), ids, "left_semi").select(_key(keys)))
    return touched.distinct()


def refresh_touched(previous: DataFrame, keyed: DataFrame, keys: list[str], ts_col: str,
                    wm: _dt.datetime, aggregate: Callable[[DataFrame], DataFrame],
                    old: DataFrame | None = None, ids: list[str] | None = None) -> DataFrame:
    """``keyed`` is the source with its key columns already computed.

    Rows may move between keys when the source overwrites them: give ``old``,
    the previous version of the source, and the row ids, so that the keys that
    lost a row are refreshed, too.  An insert-only source needs neither.
    """
    touched, small = broadcast_if_small(touched_keys(keyed, keys, ts_col, wm, old, ids), "touched-keys")
    marked = keyed.withColumn(_KEY, _key(keys))
    if small:
        # the source streams past the broadcast key set: no shuffle, no skew
        rows = marked.join(touched, _KEY, "left_semi")
    else:
        # a hot key (one day holding a third of the rows) must not make the
        # shuffled semi join a single task; ``touched`` is unique per key
        rows = skew_safe_join(marked, touched, [_KEY], "left_semi", key_source=marked.select(_KEY))
    refreshed = aggregate(rows.drop(_KEY))
    kept = previous.withColumn(_KEY, _key(keys)).join(touched, _KEY, "left_anti").drop(_KEY)
    return kept.unionByName(refreshed.select(*previous.columns))


def as_of_watermark(keyed: DataFrame, ts_col: str, wm: _dt.datetime,
                    aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The result a run at ``wm`` produced: the aggregate over rows <= wm."""
    return aggregate(keyed.where(F.col(ts_col) <= ts_lit(wm)))
