import random
import zlib

import numpy as np
import pytest

from ambry.llm.huffman_ids import END, canonical, code_lengths, decode, decode_table, packed, read_files, round_trip, segments, token_rows, write_files

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def shortest(counts):
    """Total bits of an unlimited Huffman code."""
    import heapq
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for n in (2, 3, 10, 500):
        counts = rng.integers(1, 1000, n)
        assert (code_lengths(counts, 18) * counts).sum() == shortest(counts.tolist())
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    for limit in range(4, 10):
        lengths = code_lengths(fib, limit)
        assert lengths.max() <= limit and (2.0 ** -lengths).sum() == 1
    # the best code of at most 4 bits, by trying all sets of lengths
    import itertools
    best = min(sum(a * b for a, b in zip(sorted(fib[:6], reverse=True), sorted(ls))) for ls in itertools.product(range(1, 5), repeat=6) if sum(2.0 ** -x for x in ls) <= 1)
    assert (code_lengths(fib[:6], 4) * fib[:6]).sum() == best
    assert code_lengths(np.array([7]), 18).tolist() == [1] and len(code_lengths(np.array([]), 18)) == 0
    with pytest.raises(ValueError):
        code_lengths(np.ones(9), 3)


def test_codes_are_prefix_free_and_decode():
    rng = np.random.default_rng(2)
    for n_ids in (1, 2, 300):
        ids = np.sort(rng.choice(60_000, n_ids, replace=False))
        counts = rng.integers(1, 10**6, n_ids)
        lengths = code_lengths(counts)
        codes = canonical(lengths)
        words = [format(int(c), f"0{n}b") for c, n in zip(codes, lengths)]
        assert not any(a != b and b.startswith(a) for a in words for b in words)
        pick = rng.integers(0, n_ids, 1000)
        at = np.cumsum(lengths[pick]) - lengths[pick]
        bits = packed(codes[pick], lengths[pick], at).tobytes()
        assert "".join(f"{b:08b}" for b in bits).startswith("".join(words[i] for i in pick))
        n = np.array([1000])
        assert (decode(bits, at[::128], segments(n), decode_table(ids, lengths)) == ids[pick]).all()


@pytest.mark.parametrize("special", [False, True])  # with a special token's string, texts are encoded whole
def test_round_trip(spark, docs, special):
    from tokenizers import Tokenizer
    rng = random.Random(5)
    texts = ["İstanbul İx ﬀ ǅ K Å, A.B. x... ?!no (yes), don't! I'M 'S we'RE 1st. ٣٤ e\u0301te\u0301. 한글 ß. ΑΣ ΣΑΣ, ", "", "  ", "Hello  WORLD, it's 2024!\n", "é é Ünï x ́y", "日本語 text<|endoftext|> x" if special else "日本語 text x", "a" * 3000, "word " * 20_000,
             *[" ".join(rng.choice(["the", "Zebra", "x1y2", "naïve", "—", "foo_bar", "don't"]) for _ in range(rng.randrange(300))) for _ in range(60)]]
    rows = [(3 * i, t) for i, t in enumerate(texts)] + [(1, None)]
    rng.shuffle(rows)
    t = Tokenizer.from_file(PATH)
    want, start = {}, 0
    for i, x in sorted(rows, key=lambda r: r[0]):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for how in ({}, {"block_tokens": 500, "part_tokens": 9000}):
        assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in round_trip(docs(rows), PATH, **how).collect()} == want


def test_other_tokenizers(docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, texts = Tokenizer.from_file(path), ["Two  spaces, CASE counts.", None, " x\n"]
    want = [zlib.crc32(np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for x in texts]
    assert [r.ids_crc32 for r in round_trip(docs(texts), path).orderBy("doc_id").collect()] == want


def test_files(spark, docs, tmp_path):
    write_files(token_rows(docs([(i, "some words " * (i % 40)) for i in range(200)]), PATH), str(tmp_path / "f"), block_tokens=300, part_tokens=2000)
    blocks = spark.read.parquet(str(tmp_path / "f" / "blocks")).orderBy("part", "block").collect()
    assert len(blocks) > 5 and len({b.part for b in blocks}) > 1
    assert [d for b in blocks for d in b.doc_ids] == list(range(200))
    assert sum(len(b.bits) for b in blocks) * 8 < 4 * sum(sum(b.n_tokens) for b in blocks)
    starts = [(r.doc_id, r.start, r.n_tokens) for r in read_files(spark, str(tmp_path / "f")).orderBy("start").collect()]
    assert all(a[1] + a[2] == b[1] for a, b in zip(starts, starts[1:])) and starts[0][1] == 0


def test_edges(docs):
    assert round_trip(docs([]), PATH).collect() == []
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens) for r in round_trip(docs([(None, "")] + [(4, "same here")] * 3), PATH).collect())
    n = got[1][2]
    assert got == [(-1, 0, 1), (4, 1, n), (4, 1 + n, n), (4, 1 + 2 * n, n)]


def test_words_that_change_when_normalised():
    """Letters whose lower case or composed form has a mark, before every mark; random strings of such."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from ambry.llm.huffman_ids import END, Encoder, encoded
    with open(PATH) as f:
        encoder = Encoder(f.read())
    whole = Tokenizer.from_file(PATH)
    rng = random.Random(11)
    letters = "aIiİıßŞÇΣσςÅéẞǅﬁ\u0958\u09dc\ufb1dЙ中あ한\u0130\u0307"
    texts = [f"{stem}{mark}{mark}" for stem in ("TARİHİ", "DERGİSİ", "İ", "aİb", "\u0958\u0959", "x\u09dc") for mark in ".,;:!?"] + ["TARİHİ.", "DERGİSİ, 5", "İ'S don't"]
    texts += ["".join(rng.choice(letters + ".,;:!?'’-0 \n") for _ in range(rng.randrange(1, 40))) for _ in range(6000)]
    ids, at = encoded(pa.array(texts), encoder, END)
    for t, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == [*whole.encode(t, add_special_tokens=False).ids, END], repr(t)


def test_blocks_of_changing_letters_are_complete():
    import re
    import sys
    import unicodedata

    from ambry.llm.huffman_ids import CHANGING
    block = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), CHANGING) + "]")
    for c in map(chr, range(sys.maxunicode + 1)):
        if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha():
            assert block.match(c), hex(ord(c))


def test_words_are_encoded_once_in_a_worker(monkeypatch):
    """Tasks of one call share an encoder; a full memory keeps the last words; marks don't make a word a piece of its own."""
    import pyarrow as pa

    from ambry.llm import huffman_ids as h
    with open(PATH) as f:
        definition = f.read()
    encoder = h.encoder_of(definition, "a")
    assert h.encoder_of(definition, "a") is encoder and h.encoder_of(definition, "b") is not encoder
    asked, each = [], encoder.each
    monkeypatch.setattr(encoder, "each", lambda texts: asked.extend(texts) or each(texts))
    monkeypatch.setattr(h, "KNOWN_WORDS", 3)
    first = h.encoded(pa.array(['some words" (no']), encoder, END)[0].tolist()
    assert first == [*each(['some words" (no'])[0], END] and sorted(asked) == ["", '"', "(no", "some words"]
    h.encoded(pa.array(["some more words"]), encoder, END)
    assert asked[-1] == "more"
    h.encoded(pa.array(["other, words]"]), encoder, END)  # the fourth word: those of this call stay
    assert asked[-1] == "other" and sorted(encoder.known.to_pylist()) == ["other", "words"]
    assert h.encoded(pa.array(["Words} other"]), encoder, END)[0].tolist() == [*each(["words} other"])[0], END] and "other" not in asked[-2:]
    monkeypatch.setattr(h, "KNOWN_WORDS", 1000)
    h.encoded(pa.array(["short " + "long" * 100]), encoder, END)
    assert len(encoder.known) == 4
    monkeypatch.setattr(h, "KNOWN_BYTES", 300)
    h.encoded(pa.array(["short end"]), encoder, END)
    assert sorted(encoder.known.to_pylist()) == ["end", "short"]


def test_counts_of_ids(spark):
    from ambry.llm.huffman_ids import count_ids
    for kind in (np.uint16, np.uint32):
        rows = [np.array(x, kind) for x in ([7, 7, 50_000], [], [2], [7, 2])]
        df = spark.createDataFrame([(x.tobytes(),) for x in rows], "ids binary").coalesce(1)
        ids, n = count_ids(df.withMetadata("ids", {"bytes": kind().itemsize}))
        assert ids.tolist() == [2, 7, 50_000] and n.tolist() == [2, 3, 1]
