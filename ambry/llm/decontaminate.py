"""Benchmark decontamination by SimHash windows.

Windows of as many words as a benchmark item slide over every document.  Each
window and each item has a 64-bit SimHash of its 5-word shingles; a multi-index
over four 16-bit blocks, probed within ``RADIUS // 4`` bits of each block, finds
every item whose fingerprint is within ``RADIUS`` bits of a window's.  What it
finds is verified by exact similarity of the shingles weighted by how often they
occur: 100 * sum of minima >= 80 * sum of maxima.

A window without any shingle of an item of its size has similarity 0 to these
items, so only windows with one get a fingerprint; that loses nothing.  At
similarity 0.8 a fingerprint differs in about 10 of 64 bits, with a standard
deviation of 3: the radius of 19 covers that by three of these.

Items are taken in blocks of bounded size, all documents against each block.

Defined cases: a document shorter than an item is one window; an item of fewer
than 5 words has its whole sequence as its one shingle, and so has each of the
windows of its size, which match where they are the same words (fingerprints of
equal shingles are equal); items or documents without words match nothing; equal
items all match, the smallest item_id is named; items without an item_id count as one and are named last; rows of equal doc_id give one result;
a null doc_id gives a result of its own; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.llm.common import shingle_hashes, string_hashes, text_chunks, word_codes, written

WORDS, PERCENT = 5, 80
#: Bits in which fingerprints may differ, and bits of a block of the index.
RADIUS, BLOCK_BITS = 19, 16
#: Bytes of items that are looked for in one pass over the documents, and items in one index.
ITEM_BYTES, INDEX_ITEMS = 16 << 20, 1000
#: Bits of the filter before the exact lookup of a shingle.
FILTER_BITS = 22


def shingles(texts: pa.Array, short: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Shingle hashes of all texts, where each text's start, and the number of its words; for each size in
    ``short`` (below ``WORDS``) the hashes of all windows of so many words, each the same as a text of these
    words would have, and where each text's start."""
    words, codes, starts = word_codes(texts, lower=True)
    own = string_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    h, at = shingle_hashes(own, starts, WORDS)
    return h, at, np.diff(starts), {w: _short_windows(own, starts, w) for w in short}


def _short_windows(word_hash: np.ndarray, starts: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.maximum(np.diff(starts) - w + 1, 0)
    out = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(starts[:-1] - out[:-1], n) + np.arange(out[-1])
    # each window as a text of its own
    return shingle_hashes(word_hash[(first[:, None] + np.arange(w)).ravel()], np.arange(len(first) + 1) * w, WORDS)[0], out


def signs(h: np.ndarray) -> np.ndarray:
    """Shingles x 64, 1 or -1 by the bits of each hash."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


@dataclass
class Items:
    ids: list[int | None]
    words: np.ndarray            # words of each item
    hashes: list[np.ndarray]     # its distinct shingles in ascending order
    counts: list[np.ndarray]     # and how often each occurs

    def total(self, i: int) -> int:
        return int(self.counts[i].sum())


def items_of(rows: list) -> Items:
    """Items (item_id, text) with words, those of smaller ids first and those without one last."""
    rows = sorted((r for r in rows if r["text"]), key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
    h, at, n, _ = shingles(pa.array([r["text"] for r in rows], pa.string()))
    keep = [i for i in range(len(rows)) if n[i]]
    pairs = [np.unique(h[at[i]:at[i + 1]], return_counts=True) for i in keep]
    return Items([rows[i]["item_id"] for i in keep], n[keep], [p[0] for p in pairs], [p[1] for p in pairs])


class MultiIndex:
    """Items by the blocks of their fingerprints, with every block value within ``RADIUS // blocks`` bits:
    two fingerprints within the radius agree to that extent in one block at least."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = 64 // BLOCK_BITS
        near = RADIUS // self.blocks
        masks = np.flatnonzero(np.bitwise_count(np.arange(1 << BLOCK_BITS, dtype=np.uint32)) <= near).astype(np.uint32)
        self.tables = []
        for b in range(self.blocks):
            value = (prints >> np.uint64(b * BLOCK_BITS)).astype(np.uint32) & np.uint32((1 << BLOCK_BITS) - 1)
            reach = (value[:, None] ^ masks[None]).ravel()
            item = np.repeat(np.arange(len(prints), dtype=np.int32), len(masks))
            order = np.argsort(reach, kind="stable")
            self.tables.append((np.searchsorted(reach[order], np.arange((1 << BLOCK_BITS) + 1)), item[order]))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (place in ``prints``, item, distance) within the radius."""
        found = []
        for b, (starts, item) in enumerate(self.tables):
            value = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            n = starts[value + 1] - starts[value]
            who = np.repeat(np.arange(len(prints)), n)
            at = np.repeat(starts[value] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append(who * len(self.prints) + item[at])
        pair = np.unique(np.concatenate(found)) if len(self.prints) else np.zeros(0, np.int64)
        who, item = pair // max(1, len(self.prints)), pair % max(1, len(self.prints))
        distance = np.bitwise_count(prints[who] ^ self.prints[item]) if len(pair) else np.zeros(0, np.int64)
        close = distance <= RADIUS
        return who[close], item[close], distance[close].astype(np.int64)


def windows(n_shingles: int, n_words: int, item_words: int, hits: np.ndarray) -> tuple[np.ndarray, int]:
    """Starts, in shingles, of the item-sized windows that hold one of ``hits`` (ascending shingle
    places), and the number of their shingles."""
    size = n_shingles if n_words <= item_words else max(1, item_words - WORDS + 1)
    starts = np.zeros(n_shingles - size + 2, np.int64)
    np.add.at(starts, np.maximum(hits - size + 1, 0), 1)
    np.add.at(starts, np.minimum(hits, n_shingles - size) + 1, -1)
    return np.flatnonzero(np.cumsum(starts[:-1]) > 0), size


def overlap_of(window: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> int:
    """Sum of the minima of both sides' weights."""
    at = np.searchsorted(hashes, window)
    hit = at < len(hashes)
    hit[hit] = hashes[at[hit]] == window[hit]
    return int(np.minimum(np.bincount(at[hit], minlength=len(hashes)), counts).sum())


class Finder:
    """Matches of one index's items in documents."""

    def __init__(self, items: Items):
        self.items = items
        prints = np.array([fingerprints((signs(h) * c[:, None]).sum(0, keepdims=True))[0] for h, c in zip(items.hashes, items.counts)], np.uint64)
        self.short: dict[int, dict[int, list[int]]] = {}  # items below ``WORDS`` words by their one shingle
        for i in np.flatnonzero(items.words < WORDS):
            self.short.setdefault(int(items.words[i]), {}).setdefault(int(items.hashes[i][0]), []).append(int(i))
        self.indexes = {}
        for w in np.unique(items.words[items.words >= WORDS]):
            own = np.flatnonzero(items.words == w)
            self.indexes[w] = (own, MultiIndex(prints[own]), np.unique(np.concatenate([items.hashes[i] for i in own])))

    def matches(self, h: np.ndarray, n_words: int, short: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, overlap, union, first word, distance) of the best window for each matching item."""
        for w, known in self.short.items():
            for one, first in zip(*np.unique(short[w][np.isin(short[w], np.array(list(known), np.uint64))], return_index=True)):
                for i in known[int(one)]:
                    yield i, 1, 1, int(np.flatnonzero(short[w] == one)[0]), 0
        sums = None
        for w, (own, index, known) in self.indexes.items():
            if n_words < WORDS:
                break
            at = np.searchsorted(known, h)
            hits = np.flatnonzero((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == h))
            if not len(hits):
                continue
            starts, size = windows(len(h), n_words, int(w), hits)
            if sums is None:
                sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(signs(h), 0, dtype=np.int32)))
            best: dict[int, tuple] = {}
            for k, item, distance in zip(*index.near(fingerprints(sums[starts + size] - sums[starts]))):
                s, i = int(starts[k]), int(own[item])
                both = overlap_of(h[s:s + size], self.items.hashes[i], self.items.counts[i])
                union = size + self.items.total(i) - both
                if 100 * both >= PERCENT * union and (i not in best or both * best[i][1] > best[i][0] * union):
                    best[i] = (both, union, s, int(distance))
            for i, (both, union, s, distance) in best.items():
                yield i, both, union, s, distance


def matches(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES, index_items: int = INDEX_ITEMS) -> DataFrame:
    """doc_id, item_id, similarity, word_start, distance: each document's best window for each item
    that it holds."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, out = size // item_bytes + 1, None
    kind = "doc_id long, item_id long, similarity double, word_start long, distance int"
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    for b in range(blocks):  # each block of the stated items against all documents
        items = items_of(named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect())
        if items.ids:
            found = written(docs.select("doc_id", "text").mapInArrow(_with_a_shingle(items, index_items), "doc_id long, text string, part int"), "decontaminate-some")
            part = found.sortWithinPartitions("part").mapInArrow(_matches_in(items, index_items), kind)
            out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], kind)


def _with_a_shingle(items: Items, index_items: int):
    """Gives the documents with any shingle of any item, once for each part of ``index_items`` items that has one."""
    sizes = sorted({int(w) for w in items.words if w < WORDS})
    pairs = [np.unique(np.concatenate(items.hashes[a:a + index_items])) for a in range(0, len(items.ids), index_items)]
    known, part = np.concatenate(pairs), np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
    order = np.argsort(known, kind="stable")
    known, part = known[order], part[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << FILTER_BITS) - 1)
        filtered = np.zeros(1 << FILTER_BITS, bool)
        filtered[(known & mask).astype(np.int64)] = True
        for t in text_chunks(batches):
            h, at, _, short = shingles(t.column("text").combine_chunks(), sizes)
            found = [np.zeros(0, np.int64)]
            for values, starts in [(h, at), *short.values()]:
                maybe = np.flatnonzero(filtered[(values & mask).astype(np.int64)])
                left, right = (np.searchsorted(known, values[maybe], side) for side in ("left", "right"))
                n = right - left
                row = np.repeat(np.searchsorted(starts, maybe, "right") - 1, n)
                place = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                found.append(row * len(pairs) + part[place])
            some = np.unique(np.concatenate(found))
            out = t.select(["doc_id", "text"]).take(pa.array(some // len(pairs)))
            yield from out.append_column("part", pa.array(some % len(pairs), pa.int32())).combine_chunks().to_batches()
    return run


def _matches_in(items: Items, index_items: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = sorted({int(w) for w in items.words if w < WORDS})
        held, finder = -1, None
        for t in text_chunks(batches):  # rows ascend by part, so that one part's index is held, and built once
            parts = t.column("part").to_numpy()
            h, at, n, short = shingles(t.column("text").combine_chunks(), sizes)
            rows = []
            for d, doc in enumerate(t.column("doc_id").to_pylist()):
                a, b = int(parts[d]) * index_items, (int(parts[d]) + 1) * index_items
                if parts[d] != held:
                    held, finder = parts[d], Finder(Items(items.ids[a:b], items.words[a:b], items.hashes[a:b], items.counts[a:b]))
                few = {w: own[ends[d]:ends[d + 1]] for w, (own, ends) in short.items()}
                rows += [(doc, items.ids[a + i], both / union, s, distance) for i, both, union, s, distance in finder.matches(h[at[d]:at[d + 1]], int(n[d]), few)]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int32()))],
                                             ["doc_id", "item_id", "similarity", "word_start", "distance"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per contaminated document: the number of items it holds and the best match."""
    best = F.struct(F.col("similarity"), (-F.col("item_id")).alias("i"), (-F.col("word_start")).alias("w"), (-F.col("distance")).alias("d"))
    return (matches(docs, benchmark, **how).groupBy("doc_id")
            .agg((F.count_distinct("item_id") + F.max(F.col("item_id").isNull().cast("long"))).alias("n_items"), F.max(best).alias("b"))
            .select("doc_id", "n_items", (-F.col("b.i")).alias("item_id"), F.col("b.similarity").alias("similarity"),
                    (-F.col("b.w")).alias("word_start"), (-F.col("b.d")).alias("distance")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("_bad"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
