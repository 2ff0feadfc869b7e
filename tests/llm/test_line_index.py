import hashlib
import random

import numpy as np

from ambry.llm.line_index import build, dedup_lines, find, line_digest, ranks

ENDS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(ENDS))


def by_hand(rows):
    held = {}
    for i, t in rows:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key_of(x), ())) < 5 or max(held[key_of(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 65, 20_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        words, sizes, rest = build(keys)
        assert sorted(find(keys, words, sizes, ranks(words), rest)) == list(range(len(keys)))
        other = rng.integers(2**63, 2**64, 100, dtype=np.uint64)
        assert (find(other, words, sizes, ranks(words), rest) < max(1, len(keys))).all()


def test_against_plain_python(docs):
    rng = random.Random(2)
    lines = ["L%d " % i + "é" * 20 + "abc DEF " * rng.randrange(1, 6) for i in range(30)] + ["", "short", "x" * 40, "y" * 39]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", " \r"])
                          for x in rng.choices(lines, k=rng.randrange(9)))) for i in range(120)] + [(500, None), (501, "")]
    df = docs(rows)
    want = by_hand([(i, t) for i, t in rows])
    assert sum(w[1] for w in want.values()) > 50
    for r in line_digest(df).collect():
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == want[r.doc_id]
    small = {r.doc_id: r.kept_text for r in dedup_lines(df, shard_lines=4, cache_bytes=1).collect()}
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in small.items()} == {i: w[2] for i, w in want.items()}


def test_edges(docs, frame, tmp_path):
    assert line_digest(docs([])).collect() == []
    line = "a line of well over forty characters, it is"
    rows = frame([(i, line, 7, "k") for i in range(6)] + [(9, line, 8, "k")] * 2 + [(None, line, 9, "k")] + [(20, "z" * 200_000 + "\n" + line[:10], 1, "k")],
                 "doc_id long, text string, n_lines int, kept_text string", tmp_path)
    got = dedup_lines(rows).collect()
    assert {(r.doc_id, r.n_dropped) for r in got} == {(i, 1) for i in range(6)} | {(9, 0), (None, 1), (20, 0)}
    assert [r.kept_text for r in got if r.doc_id == 0] == [""]


def test_rows_of_one_document_count_once(docs):
    line = "a line of more than forty characters, held by few documents"
    few = [(1, line), (1, line), (1, line + "\n" + line), (1, line), (2, line)]
    out = line_digest(docs(few)).collect()
    assert all(r.n_dropped == 0 for r in out)
    more = few + [(i, line) for i in (3, 4, 5)]
    out = line_digest(docs(more)).collect()
    assert {(r.doc_id, r.n_lines - r.n_dropped) for r in out} == {(1, 0), (2, 0), (3, 0), (4, 0), (5, 1)}
