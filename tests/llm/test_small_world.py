import numpy as np
import pytest

from ambry.llm import small_world as s

NAN, INF = float("nan"), float("inf")


def brute(rows, queries, k):
    """{query id: [(id, distance)]} of distinct rows, the query's own left out."""
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    out = {}
    for qi, q in dict.fromkeys((i, tuple(v)) for i, v in queries):
        d = [(float(np.sqrt(((np.array(q) - np.array(v)) ** 2).sum())), i) for i, v in rows if (i, v) != (qi, q)]
        out[qi] = [(i, x) for x, i in sorted(d)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(mine, true):
    return sum(len({i for i, _ in mine.get(q, [])} & {i for i, _ in t}) for q, t in true.items()) / sum(map(len, true.values()))


@pytest.mark.parametrize("kind", ["random", "clustered"])
def test_recall_over_several_shards(spark, frame, tmp_path, monkeypatch, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24))
    if kind == "clustered":
        x = rng.standard_normal((12, 24))[rng.integers(0, 12, 3000)] * 4 + 0.05 * x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(s, "SHARD_SCALE", 300)  # four shards
    df = frame(rows, "vec_id long, embedding array<double>", tmp_path)
    mine = found(s.neighbour_report(df))
    true = brute(rows, rows[::100], 10)
    assert set(mine) == set(true) and all(len(v) == 10 for v in mine.values())
    assert recall(mine, true) >= 0.95
    by_id = dict(rows)
    for q, hits in mine.items():  # scores are the exact distances
        for i, d in hits:
            assert d == pytest.approx(np.linalg.norm(np.array(by_id[q]) - np.array(by_id[i])), rel=1e-12)


def test_copies_ties_and_unusable_rows(frame, tmp_path):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (200, [-0.0, 3.0]), (7, [0.0, 3.0]), (300, None), (301, [0.0, 0.0]),
            (302, [NAN, 1.0]), (303, [INF, 1.0]), (304, [None, 1.0]), (305, []), (None, [1.0, 0.5]), (400, [2.0]), (0, [1.0, 0.0])]
    rows += [(1000 + i, [5.0, 5.0]) for i in range(1, 60)]  # a vector that most rows share
    mine = found(s.neighbour_report(frame([(i, v, "x", i) for i, v in rows], "vec_id long, embedding array<double>, id string, a long", tmp_path)))
    assert set(mine) == {0, 100, 200, 400}
    usable = [(i if i is not None else s.NULL_ID, v) for i, v in rows if i not in (300, 301, 302, 303, 304, 305)]
    true = brute([(i, (v + [0.0, 0.0])[:2]) for i, v in usable], [(i, (v + [0.0])[:2]) for i, v in usable if i in (0, 100, 200, 400)], 10)
    for q in true:
        assert [(i if i is not None else s.NULL_ID, pytest.approx(d)) for i, d in mine[q]] == true[q]


def test_few_rows_and_empty_table(frame, tmp_path):
    one = frame([(100, [1.0])], "vec_id long, embedding array<float>", tmp_path)
    assert s.neighbour_report(one).count() == 0
    two = frame([(100, [1.0]), (5, [4.0])], "vec_id long, embedding array<float>", tmp_path)
    assert [tuple(r) for r in s.neighbour_report(two).collect()] == [(100, 1, 5, 3.0)]
    empty = frame([], "vec_id long, embedding array<float>", tmp_path)
    assert s.neighbour_report(empty).collect() == []


def test_graph_is_linked_and_bounded():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((900, 8))
    g = s.Graph(x, [900, 60, 4])
    for level, links in enumerate(g.links):
        size = g.sizes[level]
        assert links.shape == (size, 2 * s.M if level == 0 else s.M)
        assert links.max() < size and all(i not in row for i, row in enumerate(links))
        for row in links:
            real = row[row >= 0]
            assert len(set(real)) == len(real)
        seen, todo = {0}, [0]  # every member is reached from the first
        while todo:
            new = set(links[todo].ravel().tolist()) - seen - {-1}
            seen |= new
            todo = list(new)
        assert len(seen) >= 0.99 * size
