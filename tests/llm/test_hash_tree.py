import math
import zlib
from collections import Counter

import pytest
import xxhash

from ambry.llm.hash_tree import assign_shards, layout, shard_documents


def by_hand(key, leaves):
    """The tree's descent in plain Python."""
    def choose(options):
        if len(options) == 1:
            return options[0][0]
        return min((-math.log(((xxhash.xxh64(f"{n}\x1f{key}".encode(), seed=42).intdigest() >> 11) + 0.5) / 2**53) / w, n) for n, w in options)[1]
    for level in (0, 1):
        weights = {}
        for leaf in leaves:
            weights[leaf[level]] = weights.get(leaf[level], 0) + leaf[3]
        chosen = choose(list(weights.items()))
        leaves = [x for x in leaves if x[level] == chosen]
    return int(choose([(f"shard{s}", w) for _, _, s, w in leaves])[5:])


def test_against_plain_python(docs):
    texts = {i: f"text {i % 50} é" for i in range(700)}
    got = {r.doc_id: r for r in shard_documents(docs(texts)).collect()}
    assert len(got) == 700
    for i, r in got.items():
        assert r.shard == by_hand(str(i), layout(8)) and r.grown_shard == by_hand(str(i), layout(9))
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
        assert r.size == len(texts[i].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[i].encode())
    slots = {}
    for r in got.values():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert sum(r.grown_shard == 8 for r in got.values()) > 30


def test_weights_confine_movement(spark, docs):
    from pyspark.sql import functions as F

    from ambry.llm.hash_tree import shard_of
    old = layout(8)
    new = [(r, k, s, 3.0 if s == 0 else w) for r, k, s, w in old]
    rows = docs([""] * 3000).select(shard_of(F.col("doc_id").cast("string"), old).alias("a"), shard_of(F.col("doc_id").cast("string"), new).alias("b")).collect()
    moved = Counter((r.a, r.b) for r in rows if r.a != r.b)
    assert moved and not [m for m in moved if m[0] // 4 == 1 and m[1] // 4 == 1], "the other region's weights are as they were"
    assert not [m for m in moved if {m[0], m[1]} == {2, 3}], "so are the other rack's"
    assert not [m for m in moved if m[0] < 4 <= m[1]], "nothing leaves the region that grew"
    share = Counter(r.b for r in rows)
    assert 0.24 < share[0] / 3000 < 0.36  # 3 of 10


def test_edges(spark, docs, frame, tmp_path):
    assert shard_documents(docs([])).collect() == []
    rows = frame([(None, None, "x")] * 3 + [(1, "", "y"), (1, "a" * 100_000, "z")] + [(7, "same", "q")] * 500,
                 "doc_id long, text string, shard string", tmp_path)
    got = shard_documents(rows.drop("shard")).collect()
    assert len(got) == 505 and {r.size for r in got if r.doc_id is None} == {1}
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    for s in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    assert assign_shards(rows).columns.count("shard") == 1
    with pytest.raises(ValueError):
        from pyspark.sql import functions as F

        from ambry.llm.hash_tree import shard_of
        shard_of(F.lit("x"), [("r", "k", 0, 0.0)])


def test_many_buckets(spark, docs):
    from ambry.llm.hash_tree import slots
    got = slots(assign_shards(docs(["x"] * 900)), bucket_rows=5).collect()
    for s in range(8):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_runs_of_many_equal_rows(frame, tmp_path):
    from ambry.llm.hash_tree import slots
    rows = [(None, "")] * 950 + [(1, "a")] * 7 + [(i, f"t{i}") for i in range(2, 60)]
    assigned = assign_shards(frame(rows, "doc_id long, text string", tmp_path))
    plain, cut = (sorted(map(tuple, slots(assigned, run_rows=n).collect()), key=str) for n in (100_000, 100))
    assert plain == cut and len(cut) == len(rows)
    for s in {r[4] for r in cut}:
        own = sorted(r[-1] for r in cut if r[4] == s)
        assert own == list(range(len(own)))
