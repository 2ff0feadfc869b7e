"""Line dedup by a sharded minimal perfect hash over line hashes.

Lines that enough documents hold are counted by hash; hash shards of them are
built into minimal perfect hashes (cascading bit arrays with ranks) over compact
arrays of fingerprints, document counts and largest document ids, one Parquet
file a shard in the shared folder.  Documents then probe the arrays of the
shards that their lines fall into: no line is joined or shuffled with its text.

A line's identity is its 96-bit hash: 64 bits place it, 32 are its fingerprint.

Defined cases: null or empty text is one empty line; rows that share a doc_id are
one document (those without one, too), and if it is the largest of a line they all keep it; a null
doc_id is below every other; a document that loses all lines keeps an empty
text; an empty table gives an empty result; columns that the operator adds
replace any of the same name.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.llm.common import mixed, pieces, string_hashes, text_chunks, written
from ambry.session import scratch_path

#: Keys of at least so many code points in at least so many documents are deduplicated.
MIN_CHARS, MIN_DOCS = 40, 5
#: Line hashes in a shard, and bytes of shards that a Python worker holds at once.
SHARD_LINES, CACHE_BYTES = 200_000, 256 << 20
#: Bits for each key that is left at a level of the cascade, and levels at most.
GAMMA, LEVELS = 2, 48
#: White space of a line's ends.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Stands for a null doc_id.
NO_ID = -(1 << 63)


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    return lists.flatten(), starts


def line_hashes(lines: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the lines whose key is long enough, their 64-bit hashes and 32-bit fingerprints."""
    keys = pc.ascii_lower(pc.ascii_trim(lines, characters=SPACES))
    long_ones = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    keys = keys.take(pa.array(long_ones))
    return (long_ones, string_hashes(keys, "ambry-llm-lines0"),
            (string_hashes(keys, "ambry-llm-lines1") >> np.uint64(32)).astype(np.uint32))


# ---- minimal perfect hash ------------------------------------------------------------------

def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mixed(keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))) % np.uint64(size)


def build(keys: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Bit arrays of all levels as 64-bit words, the levels' sizes in bits, and the keys that no
    level could part (none but by 64-bit collisions)."""
    words, sizes = [], []
    for level in range(LEVELS):
        if not len(keys):
            break
        size = -(-max(64, GAMMA * len(keys)) // 64) * 64
        at = _places(keys, level, size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        keys = keys[~alone[at.astype(np.int64)]]
    return np.concatenate([np.zeros(0, np.uint64), *words]), sizes, np.sort(keys)


def ranks(words: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))


def find(keys: np.ndarray, words: np.ndarray, sizes: list[int], base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The slot of each key: 0 to n - 1, one each, for the keys that were built; for another key
    some slot or -1."""
    out = np.full(len(keys), -1, np.int64)
    left, first = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            return out
        bit = _places(keys[left], level, size) + np.uint64(first)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        own = words[word]
        hit = (own >> shift) & np.uint64(1) == 1
        below = np.bitwise_count(own & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
        out[left[hit]] = (base[word] + below)[hit]
        left, first = left[~hit], first + size
    if len(rest) and len(left):
        at = np.searchsorted(rest, keys[left])
        hit = (at < len(rest)) & (rest[np.minimum(at, len(rest) - 1)] == keys[left])
        out[left[hit]] = base[-1] + at[hit]
    return out


def placed_by(hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
    return hashes ^ mixed(prints.astype(np.uint64) + np.uint64(1))


# ---- index -----------------------------------------------------------------------------------

def frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Hash, fingerprint, number of documents (distinct doc_ids) and largest doc_id of the lines in
    ``min_docs`` documents or more; equal ids are dropped where (line, id) meet and the rest is combined
    in the map tasks, so a common line is no hot key."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_chunks(batches):
            lines, starts = split_lines(t.column("text").combine_chunks())
            at, h, f = line_hashes(lines, min_chars)
            row = np.searchsorted(starts, at, "right") - 1
            order = np.lexsort((f, h, row))
            row, h, f = row[order], h[order], f[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1]) | (f[1:] != f[:-1])
            ids = pc.fill_null(t.column("doc_id"), NO_ID).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(f[new].astype(np.int64)),
                                              pa.array(ids[row[new]])], ["h", "f", "doc_id"])

    found = docs.select("doc_id", "text").mapInArrow(keys, "h long, f long, doc_id long")
    return found.groupBy("h", "f").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs)


def write_index(lines: DataFrame, shard_lines: int = SHARD_LINES) -> tuple[str, int]:
    """Build the shards of the index; gives their folder and number."""
    spark = lines.sparkSession
    lines = written(lines, "lines")
    shards = lines.count() // shard_lines + 1

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches]
        if not tables:
            return
        t = pa.concat_tables(tables)
        names = t.column("shard").to_numpy()
        for s in np.unique(names):
            own = np.flatnonzero(names == s)
            h, f = t.column("h").to_numpy()[own].view(np.uint64), t.column("f").to_numpy()[own].astype(np.uint32)
            n, last = t.column("n").to_numpy()[own], t.column("last").to_numpy()[own]
            keys = placed_by(h, f)
            words, sizes, rest = build(keys)
            slot = find(keys, words, sizes, ranks(words), rest)
            arrays = [np.zeros(len(own), kind) for kind in (np.uint32, np.uint32, np.int64)]
            for a, v in zip(arrays, (f, np.minimum(n, 2**32 - 1), last)):
                a[slot] = v
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(s)], pa.int32()), pa.array([words.tobytes()]), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([rest.tobytes()])] + [pa.array([a.tobytes()]) for a in arrays],
                ["shard", "words", "sizes", "rest", "prints", "counts", "last"])

    path = scratch_path(spark, "llm-line-index")
    (lines.withColumn("shard", F.pmod(F.col("h"), F.lit(shards)).cast("int")).repartition(min(shards, 4096), "shard")
     .mapInArrow(shard, "shard int, words binary, sizes array<long>, rest binary, prints binary, counts binary, last binary")
     .write.partitionBy("shard").parquet(path))
    return path, shards


class Shards:
    """The shards of an index, read when they are first probed; the least recently probed go
    once ``limit`` bytes are held."""

    def __init__(self, path: str, limit: int):
        # the shared folder's URI; a plain path is a local or mounted one
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
        self.held: OrderedDict[int, tuple] = OrderedDict()
        self.limit = limit

    def get(self, shard: int) -> tuple | None:
        if shard in self.held:
            self.held.move_to_end(shard)
            return self.held[shard]
        folder = f"{self.path}/shard={shard}"
        files = [f for f in self.fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet")]
        out = None
        for f in files:
            with self.fs.open_input_file(f.path) as source:
                r = pyarrow.parquet.read_table(source).to_pylist()[0]
            words = np.frombuffer(r["words"], np.uint64)
            out = (words, r["sizes"], ranks(words), np.frombuffer(r["rest"], np.uint64), np.frombuffer(r["prints"], np.uint32),
                   np.frombuffer(r["counts"], np.uint32), np.frombuffer(r["last"], np.int64))
        self.held[shard] = out
        while len(self.held) > 1 and sum(a.nbytes for x in self.held.values() if x for a in x if isinstance(a, np.ndarray)) > self.limit:
            self.held.popitem(last=False)
        return out


def probe(shards: Shards, n_shards: int, h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line: the number of its documents (0 where it isn't indexed) and their largest id."""
    counts, last = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    home = h.view(np.int64) % n_shards  # numpy's sign rule is pmod's
    for s in np.unique(home):
        own = np.flatnonzero(home == s)
        if arrays := shards.get(int(s)):
            *mph, prints, n, ids = arrays
            slot = find(placed_by(h[own], f[own]), *mph)
            hit = slot >= 0
            hit[hit] = prints[slot[hit]] == f[own][hit]
            counts[own[hit]], last[own[hit]] = n[slot[hit]], ids[slot[hit]]
    return counts, last


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                shard_lines: int = SHARD_LINES, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text."""
    path, n_shards = write_index(frequent_lines(docs, min_chars, min_docs), shard_lines)

    def one(ids: np.ndarray, texts: pa.Array, shards: Shards) -> list[np.ndarray]:
        lines, starts = split_lines(texts)
        at, h, f = line_hashes(lines, min_chars)
        row = np.searchsorted(starts, at, "right") - 1
        count, last = probe(shards, n_shards, h, f)
        drop = np.zeros(len(lines), bool)
        drop[at] = (count >= min_docs) & (last != ids[row])
        n_dropped = np.add.reduceat(np.append(drop, False).astype(np.int64), starts[:-1]) if len(ids) else np.zeros(0, np.int64)
        kept = texts.to_numpy(zero_copy_only=False).astype(object)
        for d in np.flatnonzero(n_dropped):
            stays = np.flatnonzero(~drop[starts[d]:starts[d + 1]]) + starts[d]
            kept[d] = "\n".join(lines.take(pa.array(stays)).to_pylist())
        return [np.diff(starts), n_dropped, kept]

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shards = Shards(path, cache_bytes)
        for ids, texts in batches:
            ids, at, parts = pc.fill_null(ids, NO_ID).to_numpy(), 0, []
            for p in pieces(texts):
                parts.append(one(ids[at:at + len(p)], p, shards))
                at += len(p)
            cols = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)]
            yield pa.StructArray.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                             ["n_lines", "n_dropped", "kept_text"])

    udf = F.arrow_udf(run, "n_lines long, n_dropped long, kept_text string")
    return (docs.drop("n_lines", "n_dropped", "kept_text", "_l").withColumn("_l", udf(F.col("doc_id"), F.col("text")))
            .select("*", "_l.*").drop("_l"))


def line_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: The same rows in DuckDB's SQL, by a join of the lines.
SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last_ FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, f.key IS NOT NULL AND k.doc_id <> f.last_ AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
