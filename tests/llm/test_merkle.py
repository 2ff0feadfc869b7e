import hashlib
import zlib

import pytest

from ambry.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    doc_id, text, lang, source, n = r
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def path(tree, i):
    for level in tree[:-1]:
        yield i & 1, level[i ^ 1] if i ^ 1 < len(level) else None
        i >>= 1


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    of = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: levels([leaf(r) for r in of[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for g in langs:
        for i, r in enumerate(of[g]):
            steps = [*path(trees[g], i), *path(top, langs.index(g))]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4] + 1)) if hit else leaf(r)
            for right, other in steps:
                node = H(node) if other is None else H(other, node) if right else H(node, other)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, H(*[o for _, o in steps if o is not None]), node, node == root))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, merkle.manifest_digest(df).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def rows_of(n, langs=("en", "de", None, "", "ü", "zz")):
    return [(i * 3, f"text {i}\n" * (i % 4), langs[i * i % len(langs)], None if i % 5 == 0 else f"s{i % 3}", None if i % 11 == 0 else i) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 3, 150])
def test_equals_whole_trees(frame, tmp_path, monkeypatch, n):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)  # several trees of blocks above each other
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 4)
    rows = rows_of(n)
    assert digest(frame(rows, SCHEMA, tmp_path)) == brute(rows)


def test_block_size_of_the_query(frame, tmp_path):
    rows = rows_of(2600, ("en",))
    assert digest(frame(rows, SCHEMA, tmp_path)) == brute(rows)


def test_nulls_repeats_long_texts_and_clashing_columns(frame, tmp_path):
    rows = [(None, None, None, None, None), (None, "x", "en", "", 1), (None, "x", "en", "", 1), (5, "", "en", "a", 0), (5, "ä" * 300_000, "en", "a", 2),
            (7, "t", "en", "a", 2**63 - 1)] + [(9, "same", "en", "b", 4)] * 40
    df = frame([(*r, "x", 1, b"w") for r in rows], SCHEMA + ", g string, pos int, witness binary", tmp_path)
    assert digest(df) == brute(rows)


@pytest.mark.parametrize("cut", [0, 16, 21])
def test_append_equals_one_manifest(spark, frame, tmp_path, monkeypatch, cut):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 4)
    docs = frame(rows_of(90), SCHEMA, tmp_path)
    leaves = merkle.document_leaves(docs)
    order = ["doc_id", "node"]
    m = merkle.manifest(leaves.where(f"doc_id < {cut * 3}"), order).append(leaves.where(f"doc_id >= {cut * 3}"), order)
    whole = merkle.manifest(leaves, order)
    assert sorted(map(tuple, m.witnessed().collect()), key=str) == sorted(map(tuple, whole.witnessed().select(*m.witnessed().columns).collect()), key=str)


def test_append_keeps_closed_blocks(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 4)
    seen = []
    real = merkle._blocks
    monkeypatch.setattr(merkle, "_blocks", lambda nodes, name: (seen.append((name, nodes.count())), real(nodes, name))[1])
    leaves = merkle.document_leaves(frame(rows_of(50, ("en",)), SCHEMA, tmp_path))
    m = merkle.manifest(leaves.where("doc_id < 120"), ["doc_id", "node"])  # 40 rows: ten closed blocks
    seen.clear()
    m.append(leaves.where("doc_id >= 120"), ["doc_id", "node"])
    assert ("manifest", 10) in seen and ("manifest", 50) not in seen


def test_witness_extends_as_siblings_complete():
    leaves = [bytes([i]) * 32 for i in range(11)]
    root, witnesses = merkle.append(leaves, None)
    for i, w in enumerate(witnesses):
        assert merkle.fold(leaves[i], b"".join(w), i, 11) == (root, 32 * len(w))
        assert merkle.fold(leaves[i][::-1] + b"", b"".join(w), (i + 1) % 11, 11)[0] != root
