"""Star join onto role-playing dimensions.

One dimension table can serve several foreign keys of the fact (business as
sender and receiver, hub as pickup and delivery, ...).  Each role is joined
with its own projection of the dimension, carrying only the key (renamed to
the fact's key column) and the attributes asked for, renamed with the role
prefix.  Nullable links are LEFT joins; the others are INNER.

Each dimension, projected to the key and the attributes the roles need, is
written once and measured; within ``BROADCAST_MAX_BYTES`` it is broadcast
and the fact streams through the role join unshuffled.  Left to AQE the
fact would be shuffle-written for every role before the join turned into a
broadcast.  Larger dimensions take a shuffled join that is salted for hot
foreign keys (one business with a third of all orders): the role keys of
those joins are counted in ONE sampled pass over the fact
(``hot_role_keys``), and hot keys meet replicas of their dimension row.
Dimensions the caller marks as bounded reference tables are broadcast
without counting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry import params
from ambry.operators.materialize import broadcast_if_small
from ambry.operators.skew import BUCKETS, fetch_hot, hot_role_keys, skew_safe_join


@dataclass(frozen=True)
class Role:
    fact_key: str              # foreign key column of the fact
    dim: str                   # name of the dimension in ``dims``
    dim_key: str               # key column of the dimension
    attrs: dict[str, str]      # dimension column -> output column
    nullable: bool = False     # LEFT join when the link may be NULL


def star_join(fact: DataFrame, dims: dict[str, DataFrame], roles: list[Role],
              bounded: frozenset[str] = frozenset(), min_rows: int | None = None) -> DataFrame:
    # Each dimension, projected to its key and every attribute any role
    # needs, is written once and measured: within BROADCAST_MAX_BYTES it is
    # broadcast, so the fact streams through that role join unshuffled (and
    # no skew can arise).  Larger dimensions take a salted shuffled join.
    needed: dict[str, set[str]] = {}
    for r in roles:
        needed.setdefault(r.dim, set()).update(r.attrs)
    proj = {name: dims[name].select(next(r.dim_key for r in roles if r.dim == name), *sorted(attrs))
            for name, attrs in needed.items()}
    small = {n: True for n in bounded}
    for n in proj:
        if n not in bounded:
            proj[n], small[n] = broadcast_if_small(proj[n], f"dim-{n}")

    shuffled = [r.fact_key for r in roles if not small[r.dim]]
    hot = None
    if shuffled:
        # fetched once (small and bounded), so the role joins carry no copy
        # of the fact's lineage; no hot key at all means plain joins
        hot = fetch_hot(hot_role_keys(fact.select(*shuffled), shuffled,
                                      min_rows or params.HOT_KEY_ROWS))
    out = fact
    for r in roles:
        kt = fact.schema[r.fact_key].dataType
        d = proj[r.dim].select(F.col(r.dim_key).cast(kt).alias(r.fact_key),
                               *[F.col(c).alias(o) for c, o in r.attrs.items()])
        how = "left" if r.nullable else "inner"
        if small[r.dim]:
            out = out.join(F.broadcast(d), r.fact_key, how)
        elif hot is None:
            out = out.join(d, r.fact_key, how)
        else:
            role_hot = (hot.where(F.col("role") == r.fact_key)
                        .select(F.col("key").cast(kt).alias(r.fact_key), BUCKETS))
            out = skew_safe_join(out, d, [r.fact_key], how, hot=role_hot)
    return out
