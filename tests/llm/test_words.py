import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ambry.llm.common import distinct_per_text, n_words, shingle_hashes, string_hashes, text_chunks, word_codes

TEXTS = ["", None, "one", " a  b\tc\n", "\x0b\x0c", "ÄB äb AB ab", "x" * 5000, "a b c d e f a b c d e", "\u0085  x", " "]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s or "")


@pytest.mark.parametrize("lower", [False, True])
def test_word_codes(lower):
    words, codes, starts = word_codes(pa.array([t or "" for t in TEXTS]), lower)
    got = [[words[int(c)].as_py() for c in codes[a:b]] for a, b in zip(starts[:-1], starts[1:])]
    assert got == [WORD.findall(lowered(t) if lower else t or "") for t in TEXTS]


def test_shingles_match_tuples():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(14))) for _ in range(200)]
    words, codes, starts = word_codes(pa.array(texts), True)
    h, at = shingle_hashes(string_hashes(words)[codes], starts)
    names = {}
    for t, a, b in zip(texts, at[:-1], at[1:]):
        w = t.split()
        want = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        assert len(want) == b - a
        for s, x in zip(want, h[a:b]):
            assert names.setdefault(s, x) == x
    assert len(set(names.values())) == len(names)
    u, at2 = distinct_per_text(h, at)
    for a, b, c, d in zip(at[:-1], at[1:], at2[:-1], at2[1:]):
        assert (np.unique(h[a:b]) == u[c:d]).all()


def test_chunks_keep_all_rows_in_order():
    t = pa.table({"doc_id": range(500), "text": [None if i % 7 == 0 else "x" * (i % 90) for i in range(500)]})
    for size in (1, 50, 1 << 20):
        got = pa.concat_tables(text_chunks(iter(t.to_batches(max_chunksize=64)), size=size))
        assert got.column("doc_id").to_pylist() == list(range(500))
        assert got.column("text").to_pylist() == [x or "" for x in t.column("text").to_pylist()]


def test_word_counts(docs):
    rows = docs(TEXTS).select("text", n_words("text").alias("n")).collect()
    assert sorted((r.text or "", r.n) for r in rows) == sorted((t or "", len(WORD.findall(t or ""))) for t in TEXTS)
