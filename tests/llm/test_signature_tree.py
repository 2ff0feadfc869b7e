import random
import re

import numpy as np

from ambry.llm.signature_tree import SignatureTree, _forest, bitmap, block_links, components, near_duplicates, needed, one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def by_hand(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows = []
    for i in range(n):
        k = rng.random()
        if rows and k < 0.45:  # a copy, exact or with words changed, cut or added
            w = rng.choice(rows[-60:])[1].split(" ")
            for _ in range(rng.randrange(4)):
                j = rng.randrange(len(w))
                w[j:j + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(2)
            text = " ".join(w).swapcase() if k < 0.1 else "  ".join(w)
        elif k < 0.55:
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(7)))
        else:
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 160))) + (" " + passage if k > 0.8 else "")
        rows.append((i, text))
    return rows


def result(df, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, **how).collect()}


def test_against_all_pairs(docs):
    rows = corpus(1)
    df, want = docs(rows), by_hand(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 30
    assert result(df) == want
    # many buckets, groups in several blocks
    assert result(df, bucket_entries=200, block_docs=3, block_shingles=300) == want


def test_edges(docs, frame, tmp_path):
    assert near_duplicates(docs([])).collect() == []
    rows = docs([(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "x " * 30_000), (8, "x " * 40_000), (None, "a b"), (None, "a b"), (9, "a b"), (9, "a b")])
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(rows).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 7), (0, 1, None), (0, 1, None), (9, 1, 4), (9, 1, 4)], key=str)
    kept = one_of_each(rows).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 2, 3, 4, 6, 7]


def test_one_row_stays_and_columns_too(frame, tmp_path):
    rows = [(i % 3, "same text of more than five words here", "n", i) for i in range(30)] + [(50, "quite another text of more than five words", "m", 1)]
    out = one_of_each(frame(rows, "doc_id long, text string, n string, rep int", tmp_path)).collect()
    assert sorted((r.doc_id, r.n) for r in out) == [(0, "n"), (50, "m")]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = dict(map(tuple, _forest(np.array(edges)).tolist()))
    assert got == want and got[500] == 400
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_large_block_is_pruned():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 56, 200, dtype=np.uint64)) for _ in range(40)]
    sets = [np.unique(np.concatenate((b[rng.random(len(b)) > 0.05], rng.integers(0, 1 << 56, 5, dtype=np.uint64)))) for b in base for _ in range(8)]
    n, bits = np.array([len(x) for x in sets]), [bitmap(x, 512 << i % 2) for i, x in enumerate(sets)]
    for exact in (sets, None):  # bitmaps of twice the sets' sizes let nothing else through here
        links = block_links(np.arange(len(sets)), np.zeros(len(sets), int), bits, n, exact)
        label = {i: i for i in range(len(sets))} | dict(map(tuple, links.tolist()))
        assert all(label[i] == i // 8 * 8 for i in label)
    tree = SignatureTree(n, np.stack([bitmap(x, 1024) for x in sets]))
    assert len(tree.levels) > 2 and tree.root["to"] == len(sets)
    assert needed(100, 100) == 89 and needed(4, 5) == 4


def test_entries_dealt_in_rounds(docs, monkeypatch):
    """The same components whether buckets are dealt at once or by several rounds of runs."""
    import random

    from ambry.llm import signature_tree as s
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(rng.randrange(4, 90))) for _ in range(60)]
    texts += [t + " end" for t in texts[:40]] + texts[:20]
    df = docs(texts)
    plain = sorted(map(tuple, s.near_duplicates(df).collect()))
    monkeypatch.setattr(s, "DEAL_FAN", 3)
    assert sorted(map(tuple, s.near_duplicates(df, bucket_entries=150).collect())) == plain
    assert len({c for _, _, c in plain}) < len(texts) - 30
