"""Near-duplicate components by an n-gram Jaccard join over signature trees.

Two documents link when ``100 * intersection >= 80 * union`` of their distinct
5-word shingles.  No link between different texts is lost:

1. Sets that link differ in at most a ninth of their sizes' sum.  Every set is cut
   by hash into more parts than that, in a number of parts common to a band of
   sizes, so that sets that link have some part in common, element for element;
   documents with equal shingle sets are one class from then on.
2. Classes with an equal part form groups, each group of the same classes once.
   A group is a block, or blocks by size band and hash when it is large.  A block's
   documents hang in a signature tree whose nodes hold the OR of the token bitmaps
   below and the range of set sizes.  A dual traversal descends pairs of nodes and
   prunes those whose largest possible overlap is too small or that are linked
   already.  What is left links candidates (components by alternating stars).
3. The texts of these few candidates are read again and traversed in the same
   trees, by candidate component, now with exact comparison of what isn't pruned.

Only links that connect are looked for, so a group of copies costs its size, not
its square.  Identity of a shingle is 56 bits of its hash.

Defined cases: text without words (or null) has an empty set, links to nothing
and is its own component; with fewer than 5 words the whole sequence is the one
shingle; every row links by its own text and is named by its doc_id; a null
doc_id links to nothing and has a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import brought_back, distinct_per_text, mixed, set_aside, shingle_hashes, string_hashes, text_chunks, word_codes, written

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 80
#: Ratio of the sizes of a band's largest and smallest set; sets below ``SMALL`` use single shingles as parts.
BAND, SMALL = 1.3, 16
#: Entries of a bucket of parts, and entries that a task deals at once.
BUCKET_ENTRIES, DEAL_ENTRIES = 500_000, 500_000
#: Runs of buckets that entries are dealt to at once, and partitions that they are shuffled to.
DEAL_FAN, DEAL_PARTITIONS = 256, 20_000
#: Documents and shingles of a block.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 2_000_000
#: Most ids of group members (8 bytes each) that are broadcast to keep other texts from being shuffled.
BROADCAST_IDS = 2_000_000
#: Documents of a leaf, and children of an inner node.
LEAF, FAN = 32, 8
#: Bits of a token bitmap, at least and at most.
BITMAP = (64, 16384)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hashes of every text's shingles in order of the text, and where each text's start."""
    words, codes, starts = word_codes(texts, lower=True)
    h, at = shingle_hashes(string_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64), starts, WORDS)
    return h >> np.uint64(8), at


# ---- 1: sets and their parts ----------------------------------------------------------------

def set_rows(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: size of its shingle set, two hashes of the set, and its token bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_chunks(batches):
            tokens, at = distinct_per_text(*shingle_sets(t.column("text").combine_chunks()))
            bits = [np.packbits(bitmap(tokens[a:b], width_of(b - a))).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(np.diff(at)), *map(pa.array, _set_hashes(tokens, at)), pa.array(bits)],
                                             ["doc_id", "n", "s1", "s2", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, s1 long, s2 long, bits binary")


def width_of(n: int) -> int:
    """Bits of the bitmap of a set of ``n``: the next power of 2, within bounds."""
    return min(max(1 << int(n).bit_length(), BITMAP[0]), BITMAP[1])


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(width, bool)
    out[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return out


def _set_hashes(tokens: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    out = []
    for key in (0, 0xA5A5A5A5A5A5A5A5):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ np.uint64(key)), dtype=np.uint64)))
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out


def band_of(n: np.ndarray) -> np.ndarray:
    """The band of each size: band ``i`` begins at ``SMALL * BAND ** i``; smaller sizes have -1."""
    return np.where(n >= SMALL, np.floor(np.log(np.maximum(n, 1) / SMALL) / np.log(BAND) + 1e-9), -1).astype(np.int64)


def differing(n: np.ndarray, largest: int) -> np.ndarray:
    """Most elements in which a set of ``n`` differs from one that it links with and that has ``largest`` at most."""
    return (n + np.minimum(largest, n * 100 // PERCENT)) * (100 - PERCENT) // (100 + PERCENT)


def parts_of(band: int) -> tuple[int, int, int]:
    """Largest size of a band, its number of parts, and the shingles that a part with a key holds at
    least: 2 if that will do, so that one shared shingle makes no pair, else 1.  There are so many
    parts that nearly every set that has keys in the band has more keys than it can differ in
    from what it links with."""
    largest = int(np.ceil(SMALL * BAND ** (band + 1)))
    n = np.arange(int(SMALL * BAND ** band * PERCENT / 100), largest + 1)
    most = differing(n, largest)
    for least in (2, 1):
        parts = int(most[-1]) + 1
        while parts < (largest if least == 2 else 50 * largest):
            none = np.exp(-n / parts)
            few, spread = (none * (1 + n / parts), none * (1 + n / parts)) if least == 2 else (none, none - (1 + n / parts) * none**2)
            if (parts * (1 - few) - 4.5 * np.sqrt(parts * np.maximum(spread, 0)) > most).all():
                return largest, parts, least
            parts += 1 + parts // 200
    raise ValueError(f"no number of parts for band {band}")


def part_keys(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of each set (ascending shingles), and which set each is of.  A set has keys in
    its own band, and in the next if it is large enough to link there."""
    n = np.diff(at)
    keys, owners = [], []
    # small sets: each of the first n - ceil(0.8 n) + 1 shingles, for those that may link with a small one
    small = np.flatnonzero((n > 0) & (n * PERCENT < SMALL * 100))
    count = n[small] - -(-n[small] * PERCENT // 100) + 1
    owners.append(np.repeat(small, count))
    keys.append(mixed(tokens[np.repeat(at[small] - (np.cumsum(count) - count), count) + np.arange(count.sum())] + np.uint64(7)))
    band = band_of(n)
    top = int(band.max(initial=-1)) + 2
    sizes = [parts_of(i) for i in range(top)]
    begins = SMALL * BAND ** np.arange(top + 1)
    for shift in (0, 1):
        own = np.flatnonzero((band >= 0) & ((shift == 0) | (100 * n >= PERCENT * begins[band + 1])))
        if not len(own):
            continue
        b = band[own] + shift
        largest, k, least = (np.array([sizes[i][j] for i in b], np.int64) for j in range(3))
        where = np.repeat(at[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())
        h, who = tokens[where], np.repeat(np.arange(len(own)), n[own])
        part = ((h >> np.uint64(24)) * k.astype(np.uint64)[who]) >> np.uint64(32)  # ascends with the hash
        first = np.ones(len(h), bool)
        first[1:] = (who[1:] != who[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(first)
        content = np.add.reduceat(mixed(h), first)
        name = lambda i, p: mixed((b[i].astype(np.uint64) << np.uint64(40)) + p + np.uint64(1 << 60))
        held = np.diff(np.append(first, len(h)))
        who, part = who[first], part[first]
        enough = held >= least[who]
        # one of two linked sets with more such parts than it can differ in shares one with the other; two
        # sets without that have keys of all their parts, the empty ones too
        weak = np.bincount(who[enough], minlength=len(own)) <= differing(n[own], largest)
        enough |= weak[who]
        keys.append(mixed(content ^ name(who, part))[enough])
        owners.append(own[who[enough]])
        for i in np.flatnonzero(weak):
            none = np.setdiff1d(np.arange(k[i], dtype=np.uint64), part[who == i])
            keys.append(mixed(name(np.full(len(none), i), none) + np.uint64(3)))
            owners.append(np.full(len(none), own[i]))
    return np.concatenate(keys), np.concatenate(owners)


# ---- 2: candidate groups -------------------------------------------------------------------

def _forest(edges: np.ndarray) -> np.ndarray:
    """For each node of ``edges`` that isn't the smallest of its component, the node and that smallest."""
    if not len(edges):
        return np.zeros((0, 2), np.int64)
    nodes, flat = np.unique(edges, return_inverse=True)
    a, b = flat.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (jumped := new[new] != new).any():
            new[jumped] = new[new[jumped]]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    low = label != np.arange(len(nodes))
    return np.stack([nodes[low], nodes[label[low]]], 1)


def _edges_batch(edges: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, 0])), pa.array(np.ascontiguousarray(edges[:, 1]))], ["a", "b"])


def same_parts(docs: DataFrame, entries: int, bucket_entries: int = BUCKET_ENTRIES, deal_entries: int = DEAL_ENTRIES) -> DataFrame:
    """(component, s1) of the classes, named by the hash of their set, that share a part with another;
    one component for each set of classes.  Entries travel as arrays; a task deals each class once.

    A task deals what it holds to ``DEAL_FAN`` runs of buckets at most, and runs are dealt again until they are
    single buckets, so that the arrays' number follows the entries', not the product of tasks and buckets."""
    buckets = entries // bucket_entries + 1
    steps = [1]  # buckets of a run at each round, the last first
    while buckets > steps[-1] * DEAL_FAN:
        steps.append(steps[-1] * DEAL_FAN)

    def dealt(key: np.ndarray, name: np.ndarray, step: int) -> Iterator[pa.RecordBatch]:
        run = (mixed(key) % np.uint64(buckets)).astype(np.int64) // step
        order = np.argsort(run, kind="stable")
        runs, first = np.unique(run[order], return_index=True)
        for i, own in zip(runs, np.split(order, first[1:])):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([key[own].tobytes()]), pa.array([name[own].tobytes()])], ["bucket", "key", "s1"])

    def again(step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, held = None, []

            def flush() -> Iterator[pa.RecordBatch]:
                if held:
                    yield from dealt(*(np.concatenate(x) for x in zip(*held)), step)
                held.clear()

            for b in batches:  # rows of a run of buckets lie together
                for i, key, name in zip(b.column("bucket").to_pylist(), b.column("key"), b.column("s1")):
                    if i != bucket or sum(len(k) for k, _ in held) >= deal_entries:
                        yield from flush()
                        bucket = i
                    held.append((np.frombuffer(key.as_buffer(), np.uint64), np.frombuffer(name.as_buffer(), np.int64)))
            yield from flush()
        return run

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = set(), []

        def flush() -> Iterator[pa.RecordBatch]:
            yield from dealt(*(np.concatenate(x) for x in zip(*held)), steps[-1])
            held.clear()

        for t in text_chunks(batches):
            tokens, at = distinct_per_text(*shingle_sets(t.column("text").combine_chunks()))
            name = _set_hashes(tokens, at)[0]
            copy = np.array([k in seen or seen.add(k) is not None for k in name.tolist()], bool)
            key, owner = part_keys(tokens, at)
            new = ~copy[owner]  # a copy within the task has the keys of the first
            held.append((key[new], name[owner[new]]))
            if sum(len(k) for k, _ in held) >= deal_entries:
                yield from flush()
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for b in batches:
            for i, key, name in zip(b.column("bucket").to_pylist(), b.column("key"), b.column("s1")):
                if i != bucket and held:
                    yield from of_bucket(held)
                    held = []
                bucket = i
                held.append((np.frombuffer(key.as_buffer(), np.uint64), np.frombuffer(name.as_buffer(), np.int64)))
        if held:
            yield from of_bucket(held)

    def of_bucket(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, own = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        new = np.ones(len(key), bool)  # one entry for each class, whatever the number of tasks that dealt it
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own = key[new], own[new]
        shared = np.zeros(len(key), bool)
        same = key[1:] == key[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        key, own = key[shared], own[shared]
        if not len(key):
            return
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        name = np.add.reduceat(mixed(own.view(np.uint64) + np.uint64(1)), first) ^ mixed(size.astype(np.uint64))
        _, once = np.unique(name, return_index=True)  # most groups of copies share many parts
        at = np.repeat(first[once] - (np.cumsum(size[once]) - size[once]), size[once]) + np.arange(size[once].sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name[once], size[once]).view(np.int64)), pa.array(own[at])], ["component", "s1"])

    schema = "bucket long, key binary, s1 binary"
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(deal, schema)
    for one, step in zip(steps[:0:-1], steps[-2::-1]):
        rows = (rows.repartition(min(-(-buckets // one), DEAL_PARTITIONS), "bucket").sortWithinPartitions("bucket").mapInArrow(again(step), schema))
    return rows.repartition(min(buckets, DEAL_PARTITIONS), "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "component long, s1 long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that isn't the smallest of its component, by alternating large
    and small stars; each round is written to the shared folder."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _edges_batch(_forest(np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()], 1)))

    e = edges.mapInArrow(local, "a long, b long").distinct()
    while True:
        e = written(e, "stars")
        counts = e.agg(F.count("*").alias("n"), F.count_distinct("a").alias("a")).first()
        if counts["n"] == counts["a"] and e.join(e.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
             .where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


# ---- 3: signature trees --------------------------------------------------------------------

def needed(m: np.ndarray | int, n: np.ndarray | int):
    """Smallest overlap with which sets of these sizes link."""
    return -(-PERCENT * (m + n) // (100 + PERCENT))


class SignatureTree:
    """Documents in order of size, in leaves of ``LEAF`` under nodes of ``FAN`` children.  A node is a
    run of documents with the OR of their bitmaps, their range of sizes, and the most elements
    that a document there has beyond one for each of its bits."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, sets: list[np.ndarray] | None = None):
        """``n``: sizes; ``bits``: documents x width; ``sets``: the sets themselves, where they are at hand."""
        self.n, self.bits, self.sets = n, bits, sets
        self.excess = self.n - self.bits.sum(1)
        edges = list(range(0, len(n), LEAF)) + [len(n)]
        self.levels = [[self._node(a, b, None) for a, b in zip(edges[:-1], edges[1:])]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._node(g[0]["from"], g[-1]["to"], g) for g in (below[i:i + FAN] for i in range(0, len(below), FAN))])
        self.root = self.levels[-1][0] if len(n) else None

    def _node(self, a: int, b: int, children: list | None) -> dict:
        bits = np.logical_or.reduce([c["bits"] for c in children]) if children else self.bits[a:b].any(0)
        return {"from": a, "to": b, "bits": bits, "sizes": (int(self.n[a:b].min()), int(self.n[a:b].max())),
                "excess": int(self.excess[a:b].max()), "children": children}


def _may_link(x: dict, y: dict) -> bool:
    (lo, hi), (lo2, hi2) = x["sizes"], y["sizes"]
    if 100 * hi < PERCENT * lo2 or 100 * hi2 < PERCENT * lo:
        return False
    most = min(hi, hi2, int((x["bits"] & y["bits"]).sum()) + min(x["excess"], y["excess"]))
    return most >= needed(lo, lo2)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


class Links:
    """Which documents are linked already."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[max(i, j)] = min(i, j)


def dual_traversal(one: SignatureTree, other: SignatureTree, links: Links, first: int, second: int) -> None:
    """Join in ``links`` the documents of both trees that link, or that may link where the trees have
    bitmaps only; ``first`` and ``second`` are the
    numbers there of the trees' first documents.  For a tree with itself, give it twice."""
    def all_one(a: int, b: int, c: int, d: int) -> bool:
        root = links.find(a)
        return all(links.find(i) == root for i in range(a, b)) and all(links.find(i) == root for i in range(c, d))

    stack = [(one.root, other.root)] if one.root and other.root else []
    while stack:
        x, y = stack.pop()
        a, b, c, d = x["from"] + first, x["to"] + first, y["from"] + second, y["to"] + second
        if not (x is y or _may_link(x, y)) or all_one(a, b, c, d):
            continue
        if x["children"] or y["children"]:
            xs, ys = x["children"] or [x], y["children"] or [y]
            # a node's pair with itself is popped first, so that pairs of linked children fall away
            stack += [(p, q) for i, p in enumerate(xs) for j, q in enumerate(ys) if x is not y or i < j]
            stack += [(p, p) for p in xs] if x is y else []
            continue
        n, m = one.n[x["from"]:x["to"], None], other.n[None, y["from"]:y["to"]]
        shared = one.bits[x["from"]:x["to"]].astype(np.float32) @ other.bits[y["from"]:y["to"]].astype(np.float32).T
        most = shared + np.minimum(one.excess[x["from"]:x["to"], None], other.excess[None, y["from"]:y["to"]])
        may = np.minimum(most, np.minimum(n, m)) >= needed(n, m)
        if x is y:
            may &= np.tri(*may.shape, -1, dtype=bool).T
        for i, j in zip(*np.nonzero(may)):
            p, q = links.find(a + int(i)), links.find(c + int(j))
            if p != q and (one.sets is None or overlap(one.sets[x["from"] + i], other.sets[y["from"] + j]) >= needed(int(n[i, 0]), int(m[0, j]))):
                links.join(p, q)


def block_links(ids: np.ndarray, sides: np.ndarray, bits: list[np.ndarray], n: np.ndarray, sets: list[np.ndarray] | None = None) -> np.ndarray:
    """Links (a forest) within the documents of one block, or between the two sides of a pair of blocks."""
    order = np.lexsort((ids, n, sides))
    width = min(map(len, bits))  # a wider bitmap is folded: it is the narrower one of the same set then
    folded = np.stack([b if len(b) == width else b.reshape(-1, width).any(0) for b in (bits[i] for i in order)])
    ids, sides, n = ids[order], sides[order], n[order]
    sets = [sets[i] for i in order] if sets is not None else None
    links, cut = Links(len(ids)), int((sides == 0).sum())
    left = SignatureTree(n[:cut], folded[:cut], sets and sets[:cut])
    if cut == len(ids):
        dual_traversal(left, left, links, 0, 0)
    else:
        dual_traversal(left, SignatureTree(n[cut:], folded[cut:], sets and sets[cut:]), links, 0, cut)
    roots = np.array([links.find(i) for i in range(len(ids))])
    own = np.flatnonzero(roots != np.arange(len(ids)))
    return _forest(np.stack([ids[own], ids[roots[own]]], 1)) if len(own) else np.zeros((0, 2), np.int64)


def in_blocks(members: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """``members`` (rep, n, component) with the blocks or pairs of blocks in which each is compared
    (key, side).  A group that fits a block is one; a larger one falls into blocks by band of size
    and hash, and a block meets those of its own and the next band."""
    groups = members.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")).where("docs > 1")
    whole = (F.col("docs") <= block_docs) & (F.col("shingles") <= block_shingles)
    own = members.join(groups, "component")
    small = own.where(whole).select("rep", F.struct("component", *[F.lit(0).alias(c) for c in ("b1", "p1", "b2", "p2")]).alias("key"), F.lit(0).alias("side"), F.lit(True).alias("alone"))
    # sizes that link differ by 0.8 at most: the same band or the next
    banded = own.where(~whole).withColumn("band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / PERCENT)) + 1e-9))
    bands = banded.groupBy("component", "band").agg(F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("parts"))
    b = (banded.join(bands, ["component", "band"])
         .join(bands.select("component", (F.col("band") + 1).alias("band"), F.col("parts").alias("below")), ["component", "band"], "left")
         .join(bands.select("component", (F.col("band") - 1).alias("band"), F.col("parts").alias("above")), ["component", "band"], "left")
         .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")))
    # pairs: itself; with each other part of its band (the lower part is side 0); with each part of the next bands
    pair = lambda b1, p1, b2, p2, side: F.struct(F.struct("component", b1.cast("int").alias("b1"), p1.cast("int").alias("p1"), b2.cast("int").alias("b2"), p2.cast("int").alias("p2")).alias("key"), side.alias("side"))
    band, part, none = F.col("band"), F.col("part"), F.array().cast("array<int>")
    seq = lambda n: F.when(n.isNull(), none).otherwise(F.sequence(F.lit(0), n - 1))
    keys = F.concat(
        F.transform(seq(F.col("parts")), lambda p: pair(band, F.least(part, p), band, F.greatest(part, p), F.when(part > p, 1).otherwise(0))),
        F.transform(seq(F.col("above")), lambda p: pair(band, part, band + 1, p, F.lit(0))),
        F.transform(seq(F.col("below")), lambda p: pair(band - 1, p, band, part, F.lit(1))))
    large = b.withColumn("k", F.explode(keys)).select("rep", "k.key", "k.side", F.lit(False).alias("alone"))
    return small.union(large).withColumn("key", F.xxhash64("key.component", "key.b1", "key.p1", "key.b2", "key.p2"))


def _by_block(read):
    """Links (a, b, alone) of every block: rows come sorted by key, and ``read`` gives a chunk of them
    as lists of bitmaps, sizes and, where they are at hand, sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, [], []

        def close() -> None:
            if len(held) > 1:
                ids, sides, alone, bits, n, sets = zip(*held)
                edges = block_links(np.array(ids, np.int64), np.array(sides), list(bits), np.array(n, np.int64), None if sets[0] is None else list(sets))
                found.extend((a, b, alone[0]) for a, b in edges.tolist())
            held.clear()

        for t, bits, n, sets in read(batches):
            for k, rep, side, alone, *row in zip(*(t.column(c).to_pylist() for c in ("key", "rep", "side", "alone")), bits, n, sets):
                if k != key:
                    close()
                    key = k
                held.append((rep, side, alone, *row))
            if len(found) > 1000:
                yield _links_batch(found)
                found.clear()
        close()
        yield _links_batch(found)
    return run


def _links_batch(rows: list) -> pa.RecordBatch:
    a, b, alone = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(alone, pa.bool_())], ["a", "b", "alone"])


def bitmap_links(bitmaps: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links (a, b) of what may link in each block, by bitmaps (rep, n, bits)."""
    def read(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            bits = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8)).view(bool) for x in b.column("bits")]
            yield b, bits, b.column("n").to_pylist(), [None] * b.num_rows

    return (bitmaps.join(blocks, "rep").repartition("key").sortWithinPartitions("key", "side", "n", "rep")
            .mapInArrow(_by_block(read), "a long, b long, alone boolean").select("a", "b"))


def verified_links(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links (a, b, alone) found in each block by exact comparison; ``alone`` where the block is the whole group."""
    def read(batches: Iterator[pa.RecordBatch]):
        for t in text_chunks(batches):
            h, at = distinct_per_text(*shingle_sets(t.column("text").combine_chunks()))
            sets = [h[a:b].copy() for a, b in zip(at[:-1], at[1:])]
            yield t, [bitmap(s, width_of(len(s))) for s in sets], [len(s) for s in sets], sets

    # texts are shuffled for members of groups only, as long as these are few enough to be broadcast
    ids = blocks.select(F.col("rep").alias("doc_id")).distinct()
    if blocks.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    return (docs.select(F.col("doc_id").alias("rep"), "text").join(blocks, "rep").repartition("key").sortWithinPartitions("key", "side", "rep")
            .mapInArrow(_by_block(read), "a long, b long, alone boolean"))


# ---- all of it -----------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES, block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    rows = written(set_rows(docs), "sets")
    real, own = rows.where("n > 0 AND doc_id IS NOT NULL"), ["n", "s1", "s2"]
    # written: the join then has two plain shuffles, of which Spark splits the one with a hot class (many copies of a text)
    classes = written(real.groupBy(*own).agg(F.min("doc_id").alias("rep")), "class-reps")
    of_class = written(real.select("doc_id", *own).join(classes, own).select("doc_id", "n", "s1", "rep"), "classes")
    entries = (real.agg(F.sum("n")).first()[0] or 0) // 2  # about half a part for each shingle
    reps = of_class.where("doc_id = rep").select("rep", "n", "s1").distinct()
    met = same_parts(docs, int(entries), bucket_entries).join(reps, "s1").select("component", "rep", "n").distinct()
    near = written(in_blocks(written(met, "groups"), block_docs, block_shingles), "group-blocks")
    bitmaps = real.join(reps.select("rep").distinct(), F.col("doc_id") == F.col("rep")).select("rep", "n", "bits")
    groups = components(bitmap_links(bitmaps, near))
    groups = groups.union(groups.select("component", "component").distinct()).toDF("rep", "component")
    members = reps.select("rep", "n").join(groups, "rep")
    blocks = written(in_blocks(written(members, "members"), block_docs, block_shingles), "blocks")
    links = written(verified_links(docs, blocks), "links")
    # a group that was one block is done; links of others run through several blocks
    final = links.where("alone").select(F.col("a").alias("rep"), F.col("b").alias("component_id"))
    if not (rest := links.where("NOT alone")).isEmpty():
        final = final.union(components(rest.select("a", "b")))
    linked = (of_class.join(final, "rep", "left")
              .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "rep").alias("component_id")))
    return linked.union(rows.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", "doc_id"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest doc_id.  Rows
    without words or doc_id all stay."""
    keep = ["doc_id", "text"]
    kept = near_duplicates(docs, **how).where("doc_id = component_id").groupBy("doc_id").agg(F.max(F.col("n_shingles") > 0).alias("_words"))
    stay = set_aside(docs, keep).join(kept, "doc_id")
    # rows of equal doc_id are one document; the window's filter limits every task before rows meet
    first = (stay.where("_words").withColumn("_i", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")))
             .where("_i = 1").drop("_i"))
    return brought_back(first.union(stay.where("NOT _words")), docs.columns, keep).union(docs.where("doc_id IS NULL"))
