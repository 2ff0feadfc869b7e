import random
import zlib

import numpy as np
import pyarrow as pa

from ambry.llm.string_kernel import fit_ridge, identify, kernel, landmark_grams, language_digest, lookups, prepared, presence, train, vocabulary_of

SYLLABLES = {"aa": "the tion ing er an st ou wh".split(), "bb": "sch ung der ein ü ß keit zu".split(), "cc": "ción de la os ñ que í as".split()}


def text(lang, rng, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n=400):
    rng = random.Random(3)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, text(lang, rng, rng.randrange(8, 80)), lang if i % 5 else None, lang))
    return out


def test_kernel_is_the_cosine_of_gram_sets():
    marks, texts = pa.array(["Der ein, zu", "the 42 ing", "é"]), pa.array(["the er ein", "", "zz9 É", "x" * 70_000])
    vocabulary = vocabulary_of(marks)
    known = {(n, int(g)) for n, v in enumerate(vocabulary, 1) for g in v}

    def grams(t):
        b = prepared(pa.array([t]))[0].as_py().encode()
        return {(n, int.from_bytes(b[i:i + n], "big")) for n in (1, 2, 3) for i in range(len(b) - n + 1)} & known
    tables, size = lookups(vocabulary), sum(map(len, vocabulary))
    k = kernel(prepared(texts), tables, presence(prepared(marks), tables, size))
    for i, t in enumerate(texts.to_pylist()):
        for j, m in enumerate(marks.to_pylist()):
            a, b = grams(t), grams(m)
            assert abs(k[i, j] - len(a & b) / (max(len(a), 1) * len(b)) ** 0.5) < 1e-12


def test_ridge_on_the_full_map_is_kernel_ridge():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 6))
    k, labels = x @ x.T + np.eye(30), np.arange(30) % 3  # every text a landmark: Nyström is exact
    f = k @ fit_ridge(k, k, labels, 3)
    y = np.where(labels[:, None] == np.arange(3), 1.0, -1.0)
    want = k @ np.linalg.solve(k + 1e-3 * 10 * np.eye(30), y)
    assert np.allclose(f, want, atol=1e-3)


def test_held_out_accuracy(frame, tmp_path):
    rows = corpus()
    df = frame([r[:3] for r in rows], "doc_id long, text string, lang string", tmp_path)
    got = {r.doc_id: r for r in language_digest(df).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    held = [r for r in rows if got[r[0]].held_out]
    assert len(held) > 50 and np.mean([got[r[0]].lang_pred == r[3] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    # the labels of held-out rows aren't read, nor are doc_ids at prediction
    other = frame([(i, t, "zz" if got[i].held_out else lang) for i, t, lang, _ in rows], "doc_id long, text string, lang string", tmp_path / "o")
    assert {(r.doc_id, r.lang_pred, r.score) for r in language_digest(other).collect()} == {(r.doc_id, r.lang_pred, r.score) for r in got.values()}


def test_edges(frame, tmp_path):
    schema = "doc_id long, text string, lang string, score string"
    assert language_digest(frame([], schema, tmp_path / "a")).collect() == []
    rows = [(i, text("aa" if i % 2 else "bb", random.Random(i)), "aa" if i % 2 else "bb", "s") for i in range(40)]
    rows += [(100, None, "aa", "s"), (101, "12 34 !", None, "s"), (102, "", "bb", "s"), (103, "語語", None, "s"), (None, rows[1][1], "aa", "s"), (5, rows[5][1], "aa", "s"), (6, "the " * 90_000, None, "s")]
    df = frame(rows, schema, tmp_path / "b")
    got = identify(df, train(df)).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got if r.doc_id in (100, 101, 102)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id == 103} <= {"aa", "bb"} and [r.lang_pred for r in got if len(r.text or "") > 1000] == ["aa"]
    none = identify(frame([(1, "some text", None, "s")], schema, tmp_path / "c")).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]


def test_languages_of_long_texts_only(frame, tmp_path):
    rng = random.Random(6)
    own = [(i, text("cc", rng, 16000), "cc") for i in range(12)]
    assert all(len(t.encode()) > 1 << 16 for _, t, _ in own)
    short = [(100 + i, text(x, rng, 40), x) for i, x in enumerate(["aa", "bb"] * 60)]
    asked = [(1000 + i, text(x, rng, 30), None) for i, x in enumerate(list(SYLLABLES) * 10)]
    schema = "doc_id long, text string, lang string"
    got = {r.doc_id: r for r in identify(frame(own + short + asked, schema, tmp_path / "a")).collect()}
    assert all(got[i].lang_pred == x and got[i].resembles for i, _, x in own + short)
    assert all(got[1000 + i].lang_pred == x and got[1000 + i].resembles for i, x in enumerate(list(SYLLABLES) * 10))
    alone = identify(frame(own, schema, tmp_path / "b")).collect()
    assert {(r.lang_pred, r.resembles) for r in alone} == {("cc", True)}


def test_landmarks_have_a_bounded_set_of_grams():
    rng = np.random.default_rng(5)
    big, small = "".join(map(chr, rng.integers(0x800, 0xD7FF, 120_000))), "der ein"
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "lang": ["x", "y"], "text": [big, small]})
    out = pa.Table.from_batches(landmark_grams([batch])).to_pydict()
    for n in (1, 2, 3):
        want = [v.tolist() for v in (vocabulary_of(pa.array([t]))[n - 1] for t in (big, small))]
        assert out[f"g{n}"][1] == want[1] and set(out[f"g{n}"][0]) <= set(want[0])
        assert len(out[f"g{n}"][0]) == min(len(want[0]), 1 << 16) and out[f"g{n}"][0] == sorted(out[f"g{n}"][0])
    assert len(vocabulary_of(pa.array([big]))[2]) > 1 << 16
