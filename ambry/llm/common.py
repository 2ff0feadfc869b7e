"""What the operators share: tables, written intermediate results, Arrow chunks, words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry.session import scratch_path

#: Bytes of text that a Python task works on at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Rows in an Arrow batch; texts may be long, so far fewer than Spark's 10,000.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, with small Arrow batches for the Python steps behind it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: lineage ends there, and a lost
    executor costs no more than its running tasks."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_share(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """The rows whose keys hash into about ``rows`` of all, so that choosing the lowest hashes among
    them stays as small as that on any number of tasks; small tables stay whole."""
    share = min(1.0, rows / max(1, df.count()))
    return df if share == 1 else df.where(F.pmod(F.xxhash64(F.lit("share"), *key), F.lit(1 << 30)) < int(share * (1 << 30)))


def set_aside(df: DataFrame, keep: list[str]) -> DataFrame:
    """``df`` with all columns but ``keep`` in one struct, out of the way of columns that are added."""
    others = [c for c in df.columns if c not in keep]
    return df.select(*keep, *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others")] if others else []))


def brought_back(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """The columns as they were before ``set_aside``, in their order."""
    return df.select(*[F.col(c) if c in keep else F.col(f"_others.`{c}`").alias(c) for c in columns])


def array_of(batch: pa.RecordBatch | pa.Table, column: str) -> pa.Array:
    a = batch.column(column)
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, next to the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                size: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The rows of all batches, regrouped into tables of about ``size`` bytes of ``column``
    (null texts become empty)."""
    held, have = [], 0

    def flush() -> pa.Table:
        t = pa.Table.from_batches(held).combine_chunks()
        i = t.schema.get_field_index(column)
        return t.set_column(i, column, pc.fill_null(array_of(t, column), ""))

    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + size - have, "right")))
            held.append(b.slice(at, upto - at))
            have += int(ends[upto - 1] - before)
            at = upto
            if have >= size or at < b.num_rows:
                yield flush()
                held, have = [], 0
                give_back()
    if held:
        yield flush()
    give_back()


def pieces(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """``texts`` with null as empty, in runs of about ``size`` bytes."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts (one more entry ends the last)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or ends[0] == ends[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def per_text(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` over each text's positions."""
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]


def _word_counts(texts: pa.Array) -> pa.Array:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` in each text, from its bytes; 0 for null."""
    texts = pc.fill_null(texts, "")
    raw, starts = text_bytes(texts)
    inside = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = starts[:-1][starts[:-1] < len(raw)]
    opens[first] = inside[first]  # a text's first byte may open a word whatever lies before it
    return pa.array(per_text(opens, starts))


def n_words(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text, 0 for null."""
    return F.arrow_udf(_word_counts, "long")(text)


def word_codes(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (A-Z lower-cased if asked): the distinct words,
    each word's place among them, and where each text's words start (one more entry ends the last)."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    coded = flat.dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # a text that starts or ends with white space, or has no word
        real = codes != empty
        ends = np.concatenate(([0], np.cumsum(real, dtype=np.int64)))[ends]
        codes = codes[real]
    return words, codes, ends


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every bit depends on all bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def string_hashes(words: pa.Array, key: str = "ambry-llm-words0") -> np.ndarray:
    """64-bit keyed hash of each string."""
    from pandas.util import hash_array
    if not len(words):
        return np.zeros(0, np.uint64)
    return hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False, hash_key=key)


def shingle_hashes(word_hash: np.ndarray, starts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's k-word shingles in order, and where each text's shingles start.
    A text of fewer words has the whole sequence as its one shingle; without words it has none."""
    n_words = np.diff(starts)
    n_shingles = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    out_starts = np.concatenate(([0], np.cumsum(n_shingles)))
    salt = [mixed(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1) for i in range(k)]
    at = np.repeat(starts[:-1] - out_starts[:-1], n_shingles) + np.arange(out_starts[-1])
    rolled = np.zeros(len(word_hash), np.uint64)
    total = len(word_hash)
    for i in range(k):
        if i < total:
            rolled[:total - i] += word_hash[i:] * salt[i]
    out = rolled[at] if len(at) else np.zeros(0, np.uint64)
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        own = word_hash[starts[d]:starts[d + 1]]
        out[out_starts[d]] = (own * np.array(salt[:len(own)], np.uint64)).sum(dtype=np.uint64) + np.uint64(len(own))
    return mixed(out), out_starts


def distinct_per_text(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and where they start."""
    n = len(starts) - 1
    v = values.copy()
    for s, e in zip(starts[:-1], starts[1:]):
        v[s:e].sort()
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    new[starts[:-1][np.diff(starts) > 0]] = True
    owner = np.repeat(np.arange(n), np.diff(starts))
    return v[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=n))))
