import numpy as np
import pytest

from ambry.llm import threshold_join as t


def brute(rows, every=100):
    """The contract's rows by all pairs; ``rows`` are (vec_id, label, vector)."""
    e = []
    for i, label, v in dict.fromkeys((i, lab, None if v is None else tuple(v)) for i, lab, v in rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        e.append((i, label, tuple(int(np.floor(256 * x)) for x in v)))
    e = list(dict.fromkeys(e))
    last = lambda i: float("inf") if i is None else i
    out = []
    for a in e:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], b[2])), b) for b in e if (b[0], b[1], b[2]) != a), key=lambda s: (-s[0], last(s[1][0])))
        # rows that share the anchor's id and vector are the anchor's own
        for p, b in [s for s in scored if s[1][1] == a[1]][:5]:
            window = [(n, c) for n, c in scored if c[1] != a[1] and 80 * p <= 100 * n <= 100 * p][:5]
            out += [(a[0], b[0], r + 1, c[0], p, n) for r, (n, c) in enumerate(window)]
    return sorted(out, key=str)


def mined(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, t.hard_negative_report(df).select(*cols).collect()), key=str)


@pytest.mark.parametrize("kind", ["random", "clustered", "sparse", "negative"])
def test_equals_all_pairs(frame, tmp_path, monkeypatch, kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 20)) * 0.2
    if kind == "clustered":
        x = rng.standard_normal((9, 20))[rng.integers(0, 9, 900)] + 0.2 * x
    if kind == "sparse":
        x *= rng.random(x.shape) < 0.15
    if kind == "negative":  # few scores are positive
        x[::100] = -np.abs(x[::100])
        x[1::2] = np.abs(x[1::2])
    rows = [(i, int(lab), v.tolist()) for i, (lab, v) in enumerate(zip(rng.integers(0, 4, 900), x))]
    monkeypatch.setattr(t, "SHARD_ROWS", 250)
    monkeypatch.setattr(t, "GUESS_ROWS", 10)
    got = mined(frame(rows, "vec_id long, label int, embedding array<double>", tmp_path))
    assert got == brute(rows) and got


def test_copies_ties_nulls_and_clashing_columns(frame, tmp_path):
    rng = np.random.default_rng(4)
    hot = [1.0, 0.5, -0.25]
    rows = [(100 + i, i % 3, hot) for i in range(1, 120)]  # equal vectors of several labels
    rows += [(0, 1, hot), (100, 2, [1.0, 0.5, -0.2]), (200, 0, [0.0, 0.0, 0.0]), (300, 1, [0.9]), (400, 2, []), (None, 1, [0.9, 0.4, -0.1]),
             (500, None, hot), (600, 1, None), (700, 1, [None, 1.0, 1.0]), (800, 1, [float("nan"), 1.0, 1.0]), (900, 0, [float("inf"), 1.0, 1.0])]
    rows += [(2000 + i, int(rng.integers(0, 3)), rng.random(3).tolist()) for i in range(1, 90)]
    rows += rows[5:20]
    df = frame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, a long, ids string", tmp_path)
    padded = [(i, lab, None if v is None else v + [0.0] * (3 - len(v))) for i, lab, v in rows]
    assert mined(df) == brute(padded)


def test_empty_tables_and_long_vectors(frame, tmp_path):
    schema = "vec_id long, label int, embedding array<double>"
    assert mined(frame([], schema, tmp_path)) == []
    assert mined(frame([(100, 1, [1.0])], schema, tmp_path)) == []
    with pytest.raises(Exception, match="2\\*\\*53"):
        mined(frame([(100, 1, [1e9]), (101, 1, [1e9])], schema, tmp_path))


def test_index_prunes():
    rng = np.random.default_rng(7)
    x = np.floor(rng.standard_normal((2000, 32)) * 60)
    lists = t.Lists(x)
    for i in range(0, 2000, 400):
        score = x @ x[i]
        for level in (0.2, 0.5, 0.9):
            cut = level * score[i]
            rows, found = lists.reaching(x[i], cut)
            assert sorted(rows) == np.flatnonzero(score >= cut).tolist()
            assert (found == score[rows]).all()
