import hashlib
import random
import re

import duckdb
import pytest

from ambry.llm.source_mix import SQL, mix, mix_digest, mixed_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        t = {s: cap * sizes[s] if s in full else left * w[s] / rest for s in names}
        over = {s for s in names if t[s] > cap * sizes[s] + 1e-9}
        if not over:
            return t
        full |= over


def by_hand(rows):
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    target, out = shared(sizes), []
    for s in sizes:
        own = sorted(((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i, len(WORD.findall(t or ""))) for i, x, t in rows if x == s))
        epochs = int(target[s] // max(sizes[s], 1))
        budget = round(target[s] - epochs * sizes[s])
        for _, i, n in own:
            part = min(n, budget)
            budget -= part
            out.append((i, n, sizes[s], round(target[s], 6), epochs * n + part))
    return sorted(out)


def made(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "ä", "z9", None, "B", "tiny"]
    return [(i, "tiny" if i < 3 else rng.choice(sources[:6]) if i % 3 else "a",
             rng.choice([None, "", " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(60)))])) for i in range(n)]


def test_against_plain_python(frame, tmp_path):
    for seed in (1, 2):
        rows = made(seed)
        df = frame(rows, "doc_id long, source string, text string", tmp_path)
        for how in ({}, {"bucket_rows": 7}):
            got = sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mix(df, **how).collect())
            assert got == by_hand(rows)


def test_documents_follow_taken(frame, tmp_path):
    rows = made(3)
    df = frame([(*r, "k") for r in rows], "doc_id long, source string, text string, size string", tmp_path)
    taken = {r.doc_id: r.taken for r in mix(df).collect()}
    out = {}
    for r in mixed_documents(df).collect():
        out.setdefault(r.doc_id, []).append(r.text)
        assert r.size == "k"
    for i, _, t in rows:
        got = out.get(i, [])
        assert sum(len(WORD.findall(x)) for x in got) == taken[i]
        assert all(t.startswith(x) for x in got) and sum(x != t for x in got) <= 1


def test_edges(frame, tmp_path):
    schema = "doc_id long, source string, text string"
    assert mix(frame([], schema, tmp_path / "a")).collect() == []
    none = mix(frame([(1, "a", None), (2, None, " ")], schema, tmp_path / "b")).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in none} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    # a third of all rows are one document; ids may be null
    same = [(5, "hot", "a b c")] * 60 + [(i, "cold", "x y") for i in range(100, 160)] + [(None, "cold", "q r s t")] * 3
    got = mix(frame(same, schema, tmp_path / "c")).collect()
    assert len(got) == 123
    for s in ("hot", "cold"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 60 and all(r.taken <= 3 * r.size for r in own)


@pytest.mark.parametrize("sizes", [{"a": [3, 4], "b": [6, 7]}, {"a": [5], "b": [2, 7]}, {"a": [1, 1], "b": [3]}, {"a": [9, 0], "b": [4], "c": [5, 1]}])
def test_rest_that_rounds_up_to_the_source(frame, tmp_path, sizes):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate((s, n) for s, own in sizes.items() for n in own)]
    df = frame(rows, "doc_id long, source string, text string", tmp_path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/rows/*.parquet'")
        want = sorted((i, size, n, round(t, 6), taken) for i, size, n, t, taken in db.execute(SQL).fetchall())
    assert sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mix_digest(df).collect()) == want
    words = sum(len(WORD.findall(r.text)) for r in mixed_documents(df).collect())
    assert words == sum(x[4] for x in want) and abs(words - sum(map(sum, sizes.values()))) <= len(sizes)


def test_sql_with_many_capped_sources(frame, tmp_path):
    rng = random.Random(6)
    rows = [(i, f"s{i % 150:03}", "w " * (1 + (i % 150) ** 2 // 40 * rng.randrange(2))) for i in range(300)] + [(1000, "t", "w " * 60_000)]
    frame(rows, "doc_id long, source string, text string", tmp_path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/rows/*.parquet'")
        got = sorted((i, size, n, round(t, 6), taken) for i, size, n, t, taken in db.execute(SQL).fetchall())
    assert [r[:4] for r in got] == [r[:4] for r in by_hand(rows)]
