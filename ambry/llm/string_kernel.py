"""Language identification by string kernels.

The kernel of two texts is the cosine of their sets of byte n-grams of 1 to 3
bytes (blended spectrum, presence instead of counts) of the lower-cased text
with every run of other ASCII than letters as one space.  Landmarks give a
Nyström map, on which one-versus-rest kernel ridge regression is solved; texts
are scored by batched matrix products of their presence rows with the landmarks'.

Bounds of what is fitted: at most ``TRAINING`` training texts a language, those whose
ids hash lowest among the rows that may be learned from, and of these at most
``LANDMARKS`` landmarks, those of at most ``LANDMARK_BYTES`` bytes first.  A longer
landmark has, of each length, at most as many n-grams, those that hash lowest.  n-grams
that occur in no landmark are outside the feature space.

A text resembles a language when the share of its n-grams (of ``LONGEST`` bytes, or of
all its bytes if it has fewer) that occur in the language's landmarks is above the
language's cut: the lowest that parts, with the fewest errors, the language's training texts
from the same texts with their characters shuffled.  A landmark's own share counts what other
landmarks have.  Neither share nor cut depends on the number of languages.  ``resembles`` asks
this of the predicted language and, as single words may be common to several, then of the others.

Defined cases: text that is null or has no letter is ``und`` with score 0, as is
every text when there is nothing to learn from, and resembles nothing; where nothing
parts the two (as with a single landmark) any known n-gram will do; rows without lang are predicted
but not learned from; repeated rows are predicted alike; an empty table gives an
empty result; other columns pass through, and those that the operator adds
replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import give_back, mixed, pieces, text_bytes, written

#: Landmarks and training texts for each language; landmarks have at most so many n-grams of a length.
LANDMARKS, TRAINING, LANDMARK_BYTES = 48, 400, 1 << 16
#: Most ids of training texts (8 bytes each) that are broadcast.
BROADCAST_IDS = 1_000_000
#: Slices in which a language's training texts are chosen first.
SLICES = 64
#: Longest n-gram, in bytes.
LONGEST = 3
#: Texts scored in one matrix product.
ROWS = 64
#: Ridge of the regression, and of the landmarks' kernel matrix.
RIDGE, JITTER = 1e-3, 1e-8
#: How sharply decision values become a score.
SHARPNESS = 4.0
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    vocabulary: list[np.ndarray]   # for each n, the n-grams in ascending order
    landmarks: np.ndarray          # landmarks x features, 0 or 1
    weights: np.ndarray            # landmarks x languages; holds the Nyström map
    known: np.ndarray              # languages x features and one more: n-grams of the language's landmarks
    cuts: np.ndarray               # for each language, the share of known n-grams that a text must exceed


def prepared(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[\x00-\x60\x7b-\x7f]+", " ")


def grams(raw: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that starts at each byte, as a number; the last n - 1 bytes start none."""
    out = np.zeros(max(0, len(raw) - n + 1), np.int32)
    for i in range(n):
        out = (out << 8) | raw[i:len(raw) - n + 1 + i]
    return out


def vocabulary_of(texts: pa.Array) -> list[np.ndarray]:
    raw, starts = text_bytes(prepared(texts))
    return [np.unique(np.concatenate([np.zeros(0, np.int32)] + [grams(raw[s:e], n) for s, e in zip(starts[:-1], starts[1:])]))
            for n in range(1, LONGEST + 1)]


def landmark_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each n, every text's n-grams, or those that hash lowest."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            sets = vocabulary_of(row.column("text"))
            few = [v if len(v) <= LANDMARK_BYTES else np.sort(v[np.argsort(mixed(v))[:LANDMARK_BYTES]]) for v in sets]
            yield pa.RecordBatch.from_arrays([row.column("doc_id"), row.column("lang"), *[pa.array([v], pa.list_(pa.int32())) for v in few]],
                                             ["doc_id", "lang", *[f"g{n}" for n in range(1, LONGEST + 1)]])
            give_back()


def lookups(vocabulary: list[np.ndarray]) -> list[np.ndarray]:
    """For each n, the feature of every possible n-gram; the last feature stands for unknown ones."""
    size = sum(map(len, vocabulary))
    out, at = [], 0
    for n, v in enumerate(vocabulary, 1):
        table = np.full(1 << (8 * n), size, np.uint16 if size < 1 << 16 else np.int32)
        table[v] = at + np.arange(len(v))
        out.append(table)
        at += len(v)
    return out


def presence(texts: pa.Array, tables: list[np.ndarray], size: int) -> np.ndarray:
    """Texts x features, 1 where the text has the n-gram."""
    raw, starts = text_bytes(texts)
    out = np.zeros((len(texts), size + 1), np.uint8)
    for d, (s, e) in enumerate(zip(starts[:-1], starts[1:])):
        row, own = out[d], raw[s:e]
        for n, table in enumerate(tables, 1):
            row[table[grams(own, n)]] = 1
    return out[:, :size]


def kernel(texts: pa.Array, tables: list[np.ndarray], landmarks: np.ndarray) -> np.ndarray:
    """Texts x landmarks: cosine of the n-gram sets; 0 for a text without known n-grams."""
    f = presence(texts, tables, landmarks.shape[1]).astype(np.float32)
    shared = (f @ landmarks.T.astype(np.float32)).astype(np.float64)  # counts: exact
    norm = np.sqrt(np.maximum(f.sum(1, dtype=np.float64), 1)[:, None] * np.maximum(landmarks.sum(1, dtype=np.float64), 1)[None])
    return shared / norm


def known_share(raw: np.ndarray, tables: list[np.ndarray], known: np.ndarray) -> float:
    """Share of the text's longest n-grams whose feature is known; 0 for an empty text."""
    n = min(len(raw), LONGEST)
    return float(known[tables[n - 1][grams(raw, n)]].mean()) if n else 0.0


def shuffled(texts: pa.Array) -> pa.Array:
    """The texts with their characters in a random order that depends on the text's length only."""
    out = []
    for t in texts.to_pylist():
        chars = np.frombuffer(t.encode("utf-32-le"), "<u4")
        out.append(np.random.default_rng(len(chars)).permutation(chars).tobytes().decode("utf-32-le"))
    return pa.array(out, pa.string())


def holders(landmarks: np.ndarray, labels: np.ndarray, n_labels: int) -> np.ndarray:
    """Languages x features and one more (of unknown n-grams): how many landmarks of the language have it."""
    out = np.zeros((n_labels, landmarks.shape[1] + 1), np.int32)
    for i in range(n_labels):
        out[i, :-1] = landmarks[labels == i].sum(0, dtype=np.int32)
    return out


def cut_of(own: np.ndarray, other: np.ndarray) -> float:
    """The lowest cut with the fewest texts at or below it and shuffled ones above it."""
    at = np.unique(np.append(other, 0.0))
    wrong = np.searchsorted(np.sort(own), at, "right") + len(other) - np.searchsorted(np.sort(other), at, "right")
    return float(at[wrong.argmin()])


def fit_ridge(k_mm: np.ndarray, k_nm: np.ndarray, labels: np.ndarray, n_labels: int) -> np.ndarray:
    """One-versus-rest ridge regression on the Nyström map of the landmarks' kernel matrix."""
    values, vectors = np.linalg.eigh(k_mm + JITTER * np.eye(len(k_mm)))
    keep = values > 1e-6 * values.max()
    to_map = vectors[:, keep] / np.sqrt(values[keep])
    phi = k_nm @ to_map
    y = np.where(labels[:, None] == np.arange(n_labels), 1.0, -1.0)
    # languages count alike, whatever their number of training texts
    share = (1.0 / np.bincount(labels, minlength=n_labels))[labels][:, None]
    w = np.linalg.solve(phi.T @ (phi * share) + RIDGE * np.eye(phi.shape[1]), phi.T @ (y * share))
    return to_map @ w


def may_learn(df: DataFrame) -> Column:
    """Rows whose labels may be learned from."""
    return F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))


def held_out(doc_id: Column) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4) == 2


def train(docs: DataFrame) -> Model | None:
    """Fit on a bounded sample of the labelled rows; None where there is none."""
    order = F.xxhash64(F.lit("language"), F.col("doc_id"))
    long = F.col("size") > LANDMARK_BYTES
    own = docs.where(may_learn(docs)).select("doc_id", "lang", F.octet_length("text").alias("size")).where("size > 0")
    lowest = lambda d, n, *by, first=(): d.withColumn("rank", F.row_number().over(  # noqa: E731  (its filter limits every map task)
        Window.partitionBy(*by).orderBy(*first, order, "doc_id", "size"))).where(F.col("rank") <= n).drop("rank")
    # first in slices of a language, so that what all tasks bring of a large one meets in several
    ranked = lambda d, n, **how: lowest(lowest(d.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))), n, "lang", "slice", **how), n, "lang", **how).drop("slice")
    sample = written(ranked(own, TRAINING).select("doc_id").distinct(), "language-ids")
    if sample.count() <= BROADCAST_IDS:  # then no other text is shuffled
        sample = F.broadcast(sample)
    texts = written(docs.where(may_learn(docs)).select("doc_id", "lang", "text").where(F.octet_length("text") > 0)
                    .join(sample, "doc_id").dropDuplicates(["doc_id", "lang"]), "language-sample")
    few = ranked(texts.withColumn("size", F.octet_length("text")), LANDMARKS, first=[long])
    chosen = few.select("doc_id", "lang", "text").mapInArrow(landmark_grams, "doc_id long, lang string, " + ", ".join(
        f"g{n} array<int>" for n in range(1, LONGEST + 1))).orderBy("lang", "doc_id").toArrow()
    if not chosen.num_rows:
        return None
    languages = sorted(set(chosen.column("lang").to_pylist()), key=lambda x: x.encode())
    sets = [chosen.column(f"g{n}").combine_chunks() for n in range(1, LONGEST + 1)]
    vocabulary = [np.unique(x.flatten().to_numpy()) for x in sets]
    size, at = sum(map(len, vocabulary)), 0
    m = np.zeros((chosen.num_rows, size), np.uint8)
    for x, v in zip(sets, vocabulary):
        m[np.repeat(np.arange(len(x)), pc.list_value_length(x).to_numpy()), at + np.searchsorted(v, x.flatten().to_numpy())] = 1
        at += len(v)
    counts = m.astype(np.float32) @ m.T.astype(np.float32)
    norm = np.sqrt(np.maximum(m.sum(1, dtype=np.float64), 1))
    of = np.array([languages.index(x) for x in chosen.column("lang").to_pylist()])
    held = holders(m, of, len(languages))
    marked = set(zip(chosen.column("doc_id").to_pylist(), chosen.column("lang").to_pylist()))
    rows = texts.where(F.col("lang").isin(languages)).select("doc_id", "lang", "text").mapInArrow(
        _kernel_rows(vocabulary, m, languages, held, marked),
        "doc_id long, lang string, k array<double>, own double, other double").orderBy("doc_id", "lang").toArrow()
    k = np.stack(rows.column("k").to_numpy())
    labels = np.array([languages.index(x) for x in rows.column("lang").to_pylist()])
    own, other = (rows.column(c).to_numpy() for c in ("own", "other"))
    cuts = np.array([cut_of(own[labels == i], other[labels == i]) for i in range(len(languages))])
    return Model(languages, vocabulary, m, fit_ridge(counts / (norm[:, None] * norm[None]), k, labels, len(languages)), held > 0, cuts)


def _kernel_rows(vocabulary: list[np.ndarray], landmarks: np.ndarray, languages: list[str], held: np.ndarray, marked: set):
    """Each training text's kernel with the landmarks, and its known share as it is and shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookups(vocabulary)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                clean = prepared(part.column("text"))
                k = kernel(clean, tables, landmarks)
                shares = [[], []]
                langs = part.column("lang").to_pylist()
                least = [1 + (row in marked) for row in zip(part.column("doc_id").to_pylist(), langs)]  # but its own
                for out, texts in zip(shares, (clean, prepared(shuffled(clean)))):
                    raw, starts = text_bytes(texts)
                    for lang, n, s, e in zip(langs, least, starts[:-1], starts[1:]):
                        out.append(known_share(raw[s:e], tables, held[languages.index(lang)] >= n))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), pa.array(list(k)), *[pa.array(x, pa.float64()) for x in shares]],
                    ["doc_id", "lang", "k", "own", "other"])
    return run


def predictor(model: Model | None):
    """A column function from text to a struct of lang_pred, score and resembles."""
    def scored(texts: pa.Array, tables: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        if model is None:
            return np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
        clean = prepared(texts)
        f = np.concatenate([kernel(clean.slice(at, ROWS), tables, model.landmarks) @ model.weights
                            for at in range(0, len(texts), ROWS)])
        e = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
        lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        names = np.array(model.languages, object)[f.argmax(1)]
        raw, starts = text_bytes(clean)
        alike = [any(known_share(raw[start:end], tables, model.known[i]) > model.cuts[i] for i in order)
                 for order, start, end in zip(np.argsort(-f, 1), starts[:-1], starts[1:])]
        return (np.where(lettered, names, UNKNOWN), np.where(lettered, np.round((e / e.sum(1, keepdims=True)).max(1), 6), 0.0),
                lettered & np.array(alike, bool))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = lookups(model.vocabulary) if model else []
        for texts in batches:
            parts = [scored(p, tables) for p in pieces(texts)]
            names, scores, alike = (np.concatenate([np.zeros(0, kind), *[p[i] for p in parts]])
                                    for i, kind in enumerate((object, float, bool)))
            give_back()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores), pa.array(alike)],
                                             ["lang_pred", "score", "resembles"])

    return F.arrow_udf(run, "lang_pred string, score double, resembles boolean")


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and resembles; without a model one is trained on ``docs``."""
    model = model or train(docs)
    names = ["lang_pred", "score", "resembles"]
    return (docs.drop(*names, "_p").withColumn("_p", predictor(model)(F.col("text")))
            .withColumns({n: F.col(f"_p.{n}") for n in names}).drop("_p"))


def language_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return identify(docs.select("doc_id", "text", "lang")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
