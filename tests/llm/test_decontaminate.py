import random
import re
from collections import Counter

import numpy as np

from ambry.llm.decontaminate import RADIUS, MultiIndex, contaminated, decontaminate, matches

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def by_hand(docs, items):
    out = {}
    for d, t in docs:
        for i, x in items:
            own, s = shingles(x), shingles(t)
            words = WORD.findall((t or "").lower())
            if own and len(own[0]) < 5:  # short items: windows of their size
                s = [tuple(words[a:a + len(own[0])]) for a in range(len(words) - len(own[0]) + 1)]
            if not s or not own or len(s[0]) != len(own[0]):
                continue
            size, c = min(len(own), len(s)), Counter(own)
            for a in range(len(s) - size + 1):
                w = Counter(s[a:a + size])
                both, union = (w & c).total(), (w | c).total()
                if 100 * both >= 80 * union:
                    out[d, i] = max(out.get((d, i), 0), both / union)
    return out


def made(seed):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(200)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([20, 30, 31, 60])))) for i in range(25)] + [(90, "one two three"), (91, "a a a a a a a a a a a")]
    docs = []
    for d in range(90):
        body = words(rng.randrange(0, 150))
        if d % 2:
            w = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = rng.choice(voc)
            at = rng.randrange(len(body) + 1)
            body[at:at] = [x.upper() for x in w]
        docs.append((d, " ".join(body)))
    return docs + [(200, "One two  three"), (201, "one two three four")], items


def test_index_finds_all_within_radius():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2**64, 60, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 30), replace=False)) for _ in range(600)], np.uint64)
    prints = items[rng.integers(0, 60, 600)] ^ flips
    who, item, distance = MultiIndex(items).near(prints)
    d = np.bitwise_count(prints[:, None] ^ items[None])
    assert set(zip(who.tolist(), item.tolist())) == set(zip(*map(list, map(lambda x: x.tolist(), np.nonzero(d <= RADIUS)))))
    assert (d[who, item] == distance).all()


def test_against_all_windows(docs, frame, tmp_path):
    rows, items = made(1)
    want = by_hand(rows, items)
    assert len(want) > 20
    bench = frame(items, "item_id int, text string", tmp_path / "b")
    for how in ({}, {"item_bytes": 500, "index_items": 4}):
        got = {(r.doc_id, r.item_id): r.similarity for r in matches(docs(rows), bench, **how).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    bad = {r.doc_id: r.n_items for r in contaminated(docs(rows), bench).collect()}
    assert bad == Counter(d for d, _ in want)
    left = decontaminate(docs(rows), bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - set(bad)


def test_edges(docs, frame, tmp_path):
    item = " ".join(f"t{i}" for i in range(20))
    bench = frame([(3, item), (2, item), (5, None), (6, ""), (None, "q " * 20)], "item_id int, text string", tmp_path / "b")
    none = frame([], "item_id int, text string", tmp_path / "c")
    rows = docs([(1, item), (1, item), (2, None), (3, ""), (None, "x " + item), (7, "q " * 60_000 + item)])
    assert contaminated(rows, none).collect() == [] and contaminated(docs([]), bench).collect() == []
    rows = docs([(1, item), (1, item), (2, None), (3, ""), (None, "x " + item), (7, "q " * 60_000 + item)])
    got = {r.doc_id: (r.n_items, r.item_id, r.similarity, r.word_start) for r in contaminated(rows, bench).collect()}
    assert got == {1: (2, 2, 1.0, 0), None: (2, 2, 1.0, 1), 7: (3, 2, 1.0, 60_000)}  # 7 holds the item without an id, too
    extra = frame([(1, item, "b"), (4, "clean", "c")], "doc_id long, text string, _bad string", tmp_path / "d")
    assert [tuple(r) for r in decontaminate(extra, bench).collect()] == [(4, "clean", "c")]


def test_short_items_and_items_without_id(docs, frame, tmp_path):
    bench = frame([(4, "one two three"), (None, "the hidden passage has no id of its own but many words"), (8, "Zwei"), (9, "one two three")],
                  "item_id int, text string", tmp_path / "b")
    rows = [(1, "we count ONE two\nthree here"), (2, "one two four three"), (3, "x the hidden passage has no id of its own but many words y"),
            (4, "zwei"), (5, "eins zwei"), (6, "one two"), (7, None)]
    got = {r.doc_id: (r.n_items, r.item_id, r.similarity, r.word_start) for r in contaminated(docs(rows), bench).collect()}
    assert got == {1: (2, 4, 1.0, 2), 3: (1, None, 1.0, 1), 4: (1, 8, 1.0, 0), 5: (1, 8, 1.0, 1)}
    assert {r.doc_id for r in decontaminate(docs(rows), bench).collect()} == {2, 6, 7}


def test_recall_of_the_radius():
    """Windows of 80 to 85 % similarity whose fingerprints the radius holds: the share is in the README."""
    from ambry.llm.decontaminate import fingerprints, signs
    from ambry.llm.common import mixed
    rng = np.random.default_rng(3)
    near = total = 0
    for _ in range(4000):
        n = int(rng.integers(16, 120))
        item = mixed(rng.integers(0, 2**63, n).astype(np.uint64))
        changed = int(rng.integers(np.ceil(n * 0.081), np.floor(n * 0.111) + 1)) if np.floor(n * 0.111) >= np.ceil(n * 0.081) else 0
        window = item.copy()
        window[:changed] = mixed(rng.integers(0, 2**63, changed).astype(np.uint64))
        if not 0.8 <= (n - changed) / (n + changed) <= 0.85:
            continue
        a, b = (fingerprints(signs(x).sum(0, keepdims=True))[0] for x in (item, window))
        total += 1
        near += int(np.bitwise_count(a ^ b)) <= RADIUS
    assert total > 1000 and near / total > 0.99, near / total
