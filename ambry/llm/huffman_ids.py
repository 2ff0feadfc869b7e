"""Token ids in a canonical, length-limited Huffman code.

Texts are encoded by a public tokenizer; where its definition says that white
space always parts tokens and case doesn't count, each distinct word of a batch
is encoded once.  Global counts
of the ids (at most one for each id of the vocabulary) give optimal code lengths
under a limit by package-merge, and these the canonical code.

File format, as Parquet tables below one folder:

* ``codebook``: id int, length int; codes are canonical in order of (length, id);
* ``blocks/part=P``: documents in ascending doc_id order over all parts and
  blocks.  A block holds whole documents up to ``BLOCK_TOKENS`` ids and is
  decoded alone: block long, doc_ids list<long>, n_tokens list<long>, bits
  binary (most significant bit first, every document at a byte boundary),
  checkpoints list<long> (the bit offset of each document's ids 0, ``CHECK``,
  2 * ``CHECK``, ...).

Decoding is driven by a table of all bit patterns of the longest code's length
and runs from all checkpoints at once.

Defined cases: null text is empty; every document, empty ones too, ends with the
end id; rows of equal doc_id stay separate documents next to each other; a null
doc_id comes first; an empty table gives empty files and an empty result; other
columns are left out.
"""

from __future__ import annotations

import os
import string
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ambry.llm.common import give_back, text_bytes, text_chunks, written
from ambry.session import scratch_path

#: Longest code, ids of a block, ids between checkpoints, ids of a part.
LONGEST, BLOCK_TOKENS, CHECK, PART_TOKENS = 18, 1 << 18, 128, 8_000_000
#: Stands for a null doc_id.
NO_ID = -(1 << 62)
#: The id that ends every document.
END = 2
#: Blocks of letters some of which get a mark when normalised (composed forms that Unicode takes apart, and the dotted capital I).
CHANGING = r"\x{0130}\x{0900}-\x{0FFF}\x{FB00}-\x{FB4F}\x{10000}-\x{10FFFF}"
#: Words whose ids an encoder remembers, and their bytes with those of the ids.
KNOWN_WORDS, KNOWN_BYTES = 600_000, 32 << 20
#: Bytes of text that are encoded at once: distinct pieces repeat more in larger chunks.
ENCODE_BYTES = 10 << 20
BLOCK_FIELDS = "block long, doc_ids array<long>, n_tokens array<long>, bits binary, checkpoints array<long>"


# ---- ids -----------------------------------------------------------------------------------

class Encoder:
    """A tokenizer from its definition.  Where the definition drops white space between tokens, ignores
    case and marks the token that ends a word, distinct words are encoded, many in a call."""

    #: Marks that may follow a word (ASCII's, but the apostrophe); next to letters they are tokens of their own.
    MARKS = string.punctuation.replace("'", "")

    def __init__(self, definition: str):
        import json

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        d = json.loads(definition)
        # words of earlier calls with their ids, one run of ``known_ids`` each
        self.known = pa.array([], pa.string())
        self.known_ids = pa.array([], pa.list_(pa.uint32()))
        suffix = d["model"].get("end_of_word_suffix")
        kinds = [x["type"] for x in (d.get("normalizer") or {}).get("normalizers", [])]
        splits = [x for x in (d.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        self.by_word = bool(suffix and "Lowercase" in kinds and splits and splits[0].get("behavior") == "Removed" and splits[0].get("invert"))
        if self.by_word:
            vocab = self.tokenizer.get_vocab()
            self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
            self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of distinct words of letters only; those of earlier calls are known until they
        are too many, and then the words of this call."""
        place = pc.index_in(words, value_set=self.known)
        unknown = words.filter(pc.is_null(place))
        flat, n = self._encoded_words(unknown.to_pylist())
        fresh = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(flat, pa.uint32()))
        at = place.to_numpy(zero_copy_only=False)
        new = np.isnan(at) if at.dtype.kind == "f" else np.zeros(len(at), bool)
        at = np.where(new, len(self.known) + np.cumsum(new) - 1, at).astype(np.int64)
        ids = pa.concat_arrays([self.known_ids, fresh])
        own = ids.take(pa.array(at))
        if len(ids) <= KNOWN_WORDS and self.known.nbytes + ids.nbytes <= KNOWN_BYTES:
            self.known, self.known_ids = pa.concat_arrays([self.known, unknown]), ids
        else:
            self.known, self.known_ids = words, own
        return own.flatten().to_numpy(zero_copy_only=False), own.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

    def _encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words joined by spaces, and their ids parted where a token ends a word."""
        flat, counts = [], []
        for at in range(0, len(words), 2000):
            own = words[at:at + 2000]
            ids = np.array(self.each([" ".join(own)])[0], np.int64)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):  # letters that lower case turns into others
                alone = self.each(own)
                ids, n = np.array([i for x in alone for i in x], np.int64), np.array([len(x) for x in alone], np.int64)
            else:
                n = np.diff(ends, prepend=0)
            flat.append(ids)
            counts.append(n)
        return np.concatenate([np.zeros(0, np.int64), *flat]), np.concatenate([np.zeros(0, np.int64), *counts])

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (texts without white space) in a row, and the number of each one's."""
        stems = pc.ascii_rtrim(pieces, characters=self.MARKS)
        plain = pc.match_substring_regex(stems, r"^\p{L}+$").to_numpy(zero_copy_only=False).copy()
        # letters that lose a mark when normalised ("İ" becomes an i and a dot above): the mark would join those behind the word
        foreign = np.flatnonzero(plain & pc.match_substring_regex(stems, f"[{CHANGING}]").to_numpy(zero_copy_only=False))
        plain[foreign] = [unicodedata.normalize("NFC", w).lower().isalpha() for w in stems.take(pa.array(foreign)).to_pylist()]
        some = pa.array(np.flatnonzero(plain))
        stem = stems.take(some).dictionary_encode()
        own = pieces.take(some)
        longer = pc.greater(pc.binary_length(own), pc.binary_length(stems.take(some)))
        tail = pc.replace_with_mask(pa.array(np.full(len(own), ""), pa.string()), longer,
                                    pc.replace_substring_regex(own.filter(longer), r"^\p{L}+", "")).dictionary_encode()
        rest = self.each(pieces.take(pa.array(np.flatnonzero(~plain))).to_pylist())
        tails = self.each(tail.dictionary.to_pylist())
        flat, n = self.words(stem.dictionary)
        others = tails + rest
        n = np.concatenate((n, np.array([len(x) for x in others], np.int64)))
        flat = np.concatenate((flat, np.array([i for x in others for i in x], np.int64)))
        # a piece is its stem's and its tail's ids, or its own
        first = np.full(len(pieces), -1, np.int64)
        second = np.full(len(pieces), -1, np.int64)
        first[plain] = stem.indices.to_numpy(zero_copy_only=False)
        second[plain] = len(stem.dictionary) + tail.indices.to_numpy(zero_copy_only=False)
        first[~plain] = len(stem.dictionary) + len(tails) + np.arange(len(rest))
        both = np.stack((first, second), 1)
        used = both >= 0
        size = np.where(used, n[both], 0).sum(1)
        return gathered(flat, n, both[used])[0], size


def gathered(flat: np.ndarray, n: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``pick`` of ``flat`` (run ``i`` has ``n[i]`` values) in a row, and where each ends."""
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(flat, pa.uint32()))
    return runs.take(pa.array(pick)).flatten().to_numpy(), np.cumsum(n[pick])


def encoded(texts: pa.Array, encoder: Encoder, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids, each text's ended by ``end``, and where each text's start."""
    if not encoder.by_word or pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens count case
        own = encoder.each(texts.to_pylist())
        n = np.array([len(x) + 1 for x in own], np.int64)
        return np.array([i for x in own for i in (*x, end)], np.int64), np.concatenate(([0], np.cumsum(n)))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    flat, n = encoder.pieces(coded.dictionary)
    at = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), at[1:], len(n))  # after each text, the end id
    ids, ends = gathered(np.append(flat, end), np.append(n, 1), codes)
    return ids, np.concatenate(([0], ends))[at + np.arange(len(at))]


@lru_cache(maxsize=1)
def encoder_of(definition: str, call: str) -> Encoder:
    """The encoder that a Python worker's tasks of one ``call`` share, with the words it has learned in them."""
    return Encoder(definition)


def token_rows(docs: DataFrame, tokenizer_path: str, end: int = END) -> DataFrame:
    """doc_id, salt (tells rows of equal doc_id apart), and the ids of every whole text (4 bytes each, 2 where
    the vocabulary allows)."""
    from tokenizers import Tokenizer
    kind = np.uint16 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end + 1) <= 1 << 16 else np.uint32
    with open(tokenizer_path) as f:
        definition = f.read()  # executors need no copy of the file
    call = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        encoder = encoder_of(definition, call)
        for t in text_chunks(batches, size=ENCODE_BYTES):
            ids, at = encoded(t.column("text").combine_chunks(), encoder, end)
            ids = ids.astype(kind)
            yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), t.column("salt").combine_chunks(),
                                              pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])])], ["doc_id", "salt", "ids"])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("salt"), "text").mapInArrow(run, "doc_id long, salt long, ids binary")
    return written(rows.withMetadata("ids", {"bytes": kind().itemsize}), "token-ids")


# ---- code ----------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits for these counts, by package-merge."""
    if len(counts) < 2:
        return np.ones(len(counts), np.int64)
    if len(counts) > 1 << longest:
        raise ValueError(f"{len(counts)} ids have no code of at most {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    level, levels = leaves, []
    for _ in range(longest):
        levels.append(level)
        packages = level[0:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        level, is_leaf = both[place], place < len(leaves)
        levels[-1] = (levels[-1], is_leaf)
    lengths, take = np.zeros(len(counts), np.int64), 2 * len(counts) - 2
    # from the last level down: what is taken are the first leaves, and packages of two of the level below
    for k in range(longest - 1, -1, -1):
        is_leaf = levels[k - 1][1] if k else np.ones(len(leaves), bool)
        own = int(is_leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (min(take, len(is_leaf)) - own)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes of symbols that are in ascending order, by (length, symbol)."""
    codes, code, before = np.zeros(len(lengths), np.uint64), 0, 0
    for i in np.argsort(lengths, kind="stable"):
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def packed(codes: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes in which each code stands at its bit offset; codes don't overlap."""
    if not len(codes):
        return np.zeros(0, np.uint8)
    size = int(at[-1] + lengths[-1])
    word, shift = at >> 5, (at & 31).astype(np.uint64)
    spread = codes << (np.uint64(64) - shift - lengths.astype(np.uint64))
    n = size // 32 + 2
    total = np.bincount(word, (spread >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (spread & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    return total.astype(np.uint64).astype(">u4").view(np.uint8)[:-(-size // 8)]


def decode_table(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each pattern of as many bits as the longest code has: the id it begins with, and that
    code's length."""
    longest = int(lengths.max())
    order = np.lexsort((ids, lengths))
    spans = np.left_shift(1, longest - lengths[order])
    table, size = np.repeat(ids[order], spans), np.repeat(lengths[order], spans)
    rest = (1 << longest) - len(table)  # a single id leaves patterns that no code begins
    return np.pad(table, (0, rest)).astype(np.uint32), np.pad(size, (0, rest), constant_values=1).astype(np.int64), longest


def decode(bits: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """``counts`` ids from each bit offset in ``starts``, one after the other."""
    symbols, sizes, longest = table
    words = np.frombuffer(bits + bytes(-len(bits) % 4 + 8), ">u4").astype(np.uint64)
    at, most, drop = starts.astype(np.int64), int(counts.max(initial=0)), np.uint64(64 - longest)
    out = np.zeros((most, len(starts)), np.uint32)
    order = np.argsort(-counts, kind="stable")  # the lanes that go on are always the first ones
    at, alive = at[order], np.searchsorted(-counts[order], -np.arange(most), "left")
    for step in range(most):
        lanes = at[:alive[step]]
        word = lanes >> 5
        window = (words[word] << np.uint64(32)) | words[word + 1]
        pattern = ((window << (lanes & 31).astype(np.uint64)) >> drop).astype(np.int64)
        out[step, :alive[step]] = symbols[pattern]
        lanes += sizes[pattern]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out.T[back][np.arange(most)[None] < counts[:, None]]


def segments(n_tokens: np.ndarray) -> np.ndarray:
    """Number of ids from each checkpoint of documents of these sizes to the next."""
    n = -(-n_tokens // CHECK)
    out = np.full(int(n.sum()), CHECK, np.int64)
    out[np.cumsum(n) - 1] = n_tokens - (n - 1) * CHECK
    return out


# ---- files ---------------------------------------------------------------------------------

def count_ids(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and how often: a row for each id of the vocabulary at most."""
    kind = _kind(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()  # no texts are left to encode
        give_back()
        total = np.zeros(0, np.int64)
        for b in batches:
            own = np.bincount(text_bytes(b.column("ids"))[0].view(kind))
            if len(own) > len(total):
                own, total = total, own.astype(np.int64)
            total[:len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toArrow()
    return found.column("id").to_numpy(), found.column("n").to_numpy()


def _kind(rows: DataFrame) -> type:
    return np.uint16 if rows.schema["ids"].metadata.get("bytes") == 2 else np.uint32


def write_files(rows: DataFrame, path: str, longest: int = LONGEST, block_tokens: int = BLOCK_TOKENS, part_tokens: int = PART_TOKENS) -> None:
    """Write the codebook and blocks of ``rows`` (of token_rows) below ``path``."""
    spark, kind = rows.sparkSession, _kind(rows)
    ids, counts = count_ids(rows)
    lengths = code_lengths(counts, longest)
    spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int32()), "length": pa.array(lengths, pa.int32())})).coalesce(1).write.parquet(f"{path}/codebook")
    code_of, length_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint64), np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    code_of[ids], length_of[ids] = canonical(lengths), lengths

    # parts of about equal numbers of documents, in doc_id order; an id that fills several shares them
    parts = int(counts.sum()) // part_tokens + 1
    bounds = np.array(rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).approxQuantile(
        "id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else [], np.float64).astype(np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = pc.fill_null(b.column("doc_id"), NO_ID).to_numpy()
            below = np.searchsorted(bounds, doc, "left")
            part = below + b.column("salt").to_numpy() % (np.searchsorted(bounds, doc, "right") - below + 1)
            own = [np.frombuffer(x.as_buffer(), kind) for x in b.column("ids")]
            if not own:
                continue
            n = np.array([len(x) for x in own])
            token = np.concatenate(own)
            size, first = length_of[token], np.cumsum(n) - n
            at = np.concatenate(([0], np.cumsum(size)))
            bits = at[first + n] - at[first]
            byte = np.cumsum(-(-bits // 8)) - -(-bits // 8)  # every document starts at a byte
            at = at[:-1] + np.repeat(byte * 8 - at[first], n)
            data = packed(code_of[token], size, at).tobytes()
            marks = [(at[f:f + k:CHECK] - at[f]).astype(np.uint64) for f, k in zip(first, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), b.column("doc_id"), b.column("salt"), pa.array(n, pa.int64()), pa.array([data[a:a + -(-k // 8)] for a, k in zip(byte, bits)]),
                 pa.array([(m.astype(np.uint32) if m[-1] < 1 << 32 else m).tobytes() for m in marks])], ["part", "doc_id", "salt", "n", "bits", "marks"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, have = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            doc, n, bits, marks = zip(*held)
            base = np.cumsum([0, *map(len, bits)])[:-1] * 8
            check = [np.frombuffer(m, np.uint32 if len(m) // 4 == -(-k // CHECK) else np.uint64).astype(np.int64) + s for m, k, s in zip(marks, n, base)]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([doc], pa.list_(pa.int64())),
                                               pa.array([n], pa.list_(pa.int64())), pa.array([b"".join(bits)]), pa.array([np.concatenate(check)], pa.list_(pa.int64()))],
                                              ["part", "block", "doc_ids", "n_tokens", "bits", "checkpoints"])

        for b in batches:
            for own, *row in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "n", "bits", "marks"))):
                if own != part and held:
                    yield flush()
                    held.clear()
                if own != part:
                    part, block, have = own, 0, 0
                held.append(row)
                have += row[1]
                if have >= block_tokens:
                    yield flush()
                    block, have = block + 1, 0
                    held.clear()
        if held:
            yield flush()

    (rows.mapInArrow(encode, "part int, doc_id long, salt long, n long, bits binary, marks binary")
     .repartition(parts, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "salt")
     .mapInArrow(assemble, "part int, " + BLOCK_FIELDS).write.partitionBy("part").option("compression", "zstd").parquet(f"{path}/blocks"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    book = spark.read.parquet(f"{path}/codebook").toArrow()
    if not book.num_rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    ids, lengths = book.column("id").to_numpy().astype(np.int64), book.column("length").to_numpy().astype(np.int64)
    blocks = spark.read.schema(StructType.fromDDL("part int, " + BLOCK_FIELDS)).parquet(f"{path}/blocks")
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    # where blocks start: along the blocks of a part, and along the parts (one row each)
    sums = blocks.select("part", "block", total.alias("t"))
    parts = sums.groupBy("part").agg(F.sum("t").alias("t"))
    before = lambda w: F.coalesce(F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before(Window.orderBy("part")).alias("p"))
    starts = sums.withColumn("b", before(Window.partitionBy("part").orderBy("block"))).join(parts, "part").select("part", "block", (F.col("p") + F.col("b")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(ids, lengths)
        for b in batches:
            for i in range(b.num_rows):
                first, doc, n, bits, marks = (b.column(c)[i].as_py() if c in ("first", "bits") else b.column(c)[i].values
                                              for c in ("first", "doc_ids", "n_tokens", "bits", "checkpoints"))
                n = n.to_numpy()
                tokens = decode(bits, marks.to_numpy(), segments(n), table).astype("<u4")
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([doc, pa.array(first + ends - n), pa.array(n), pa.array([tokens[e - k:e].tobytes() for e, k in zip(ends, n)])],
                                                 ["doc_id", "start", "n_tokens", "ids"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # a row here is a block
    return blocks.join(starts, ["part", "block"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end: int = END, **how) -> DataFrame:
    """Write the ids of every whole text of ``docs`` in the file format, and the contract's columns
    as read back from the files."""
    path = scratch_path(docs.sparkSession, "llm-huffman")
    write_files(token_rows(docs.select("doc_id", "text"), tokenizer_path, end), path, **how)
    return read_files(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
