"""Quality rules: gradient-boosted trees over document statistics.

Statistics come from each whole text, vectorised over a batch of texts.  Trees
are grown on histograms of a bounded sample of labelled rows, with monotonic
constraints: more repetition, symbols, capitals or repeated lines never raise a
score.  The ensemble is flattened into numpy node arrays, which score a batch
level by level.

Bound of what is fitted: at most ``TRAINING`` labelled rows, those whose ids
hash lowest.  The verdict's threshold is the cut through all rows' held-out scores of
the least weighted error: the share of good rows below it, ``GOOD_WEIGHT`` times
over, and the share of bad rows above it; so a few wrong labels don't move it.

Defined cases: null text has no words, lines or symbols and fails the base rule;
without labels of both classes every text that passes the base rule is kept;
several labels of a document count as its lowest; null labels are left out; an
empty table gives an empty result; other columns pass through, and those that
the operator adds replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.llm.common import hash_share, mixed, per_text, pieces, text_bytes, word_codes, written

#: Labelled rows to learn from.
TRAINING = 10_000
#: Trees, their depth, step, bins of a feature and rows of a leaf.
TREES, DEPTH, STEP, BINS, LEAF = 60, 3, 0.2, 32, 20
#: What a lost share of good rows weighs against a kept share of bad ones, the highest threshold, and the folds.
GOOD_WEIGHT, HIGHEST, FOLDS = 20, 0.5, 4
#: Base rule.
MIN_WORDS = 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Model features, with the sign that their effect must have (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "capital_share": -1, "distinct_share": 0, "end_share": 0, "bar_share": -1, "digit_share": 0}

_LUT = {name: np.isin(np.arange(256), list(chars.encode())) for name, chars in
        {"symbols": "#*$%&|<>", "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "letters": "abcdefghijklmnopqrstuvwxyz",
         "ends": ".!?", "bars": "|", "digits": "0123456789"}.items()}


def _duplicates(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether (owner, value) occurs more than once; owners ascend."""
    key = mixed(value.astype(np.uint64)) ^ mixed(owner.astype(np.uint64) + np.uint64(1 << 40))
    order = np.argsort(key, kind="stable")
    k, o, v = key[order], owner[order], value[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base statistics and model features of each text (null as empty)."""
    texts = pc.fill_null(texts, "")
    raw, at = text_bytes(texts)
    words, codes, starts = word_codes(texts, lower=False)
    n = np.diff(starts)
    owner = np.repeat(np.arange(len(n)), n)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    word_chars = per_text(size[codes] if len(codes) else np.zeros(0, np.int64), starts)
    # words of 3-word windows that occur twice or more in their text
    covered = np.zeros(len(codes), bool)
    if len(codes) > 2:
        c = codes.astype(np.uint64)
        window = mixed(mixed(mixed(c[:-2]) + c[1:-1]) + c[2:])
        whole = owner[:-2] == owner[2:]
        again = np.zeros(len(window), bool)
        again[whole] = _duplicates(owner[:-2][whole], window[whole])
        for i in range(3):
            covered[i:len(codes) - 2 + i] |= again
    # lines with a word that equal an earlier one
    lists = pc.split_pattern(texts, "\n")
    line_ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    coded = lists.flatten().dictionary_encode()
    wordy = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line, line_owner = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), np.diff(line_ends))
    real = wordy[line] if len(line) else np.zeros(0, bool)
    pair = np.unique(line_owner[real].astype(np.int64) * max(1, len(wordy)) + line[real])
    n_lines = per_text(real, line_ends)
    n_dup = n_lines - np.bincount(pair // max(1, len(wordy)), minlength=len(n))[:len(n)]
    seen = np.unique(owner.astype(np.int64) * max(1, len(words)) + codes)
    distinct = np.bincount(seen // max(1, len(words)), minlength=len(n))[:len(n)]
    count = {k: per_text(lut[raw], at) for k, lut in _LUT.items()}
    repeat = per_text(covered, starts)
    over = lambda a, b: a / np.maximum(b, 1)
    return {"n_words": n, "word_chars": word_chars, "n_symbols": count["symbols"], "n_dup_lines": n_dup, "n_repeat_words": repeat,
            "log_words": np.log1p(n), "word_length": over(word_chars, n), "symbol_share": over(count["symbols"], word_chars),
            "dup_line_share": over(n_dup, n_lines), "repeat_share": over(repeat, n),
            "capital_share": over(count["capitals"], count["capitals"] + count["letters"]), "distinct_share": over(distinct, n),
            "end_share": over(count["ends"], n), "bar_share": over(count["bars"], n), "digit_share": over(count["digits"], word_chars)}


# ---- trees ---------------------------------------------------------------------------------

@dataclass
class Trees:
    """All trees' nodes side by side: node ``i`` of tree ``t`` sends a row to ``2i + 1`` where its
    feature is at most the threshold, else to ``2i + 2``; a leaf above the last level sends every
    row left, down to its value."""
    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray      # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Trees:
    """Boosted trees for the log odds of ``y`` (0 or 1), each split the best on histograms that
    keeps the features' signs."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    share = np.clip(y.mean(), 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    inner, feature, threshold, value = 2**DEPTH - 1, [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        f, t, v = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**DEPTH)
        node = np.zeros(len(y), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for i in range(inner):
            rows, (lo, hi) = np.flatnonzero(node == i), bounds[i]
            best = (1e-6, None)
            for j in range(x.shape[1]):
                if len(rows) < 2 * LEAF or not len(edges[j]):
                    continue
                b = binned[rows, j]
                k = len(edges[j]) + 1
                cg, ch, cn = (np.cumsum(np.bincount(b, w, k))[:-1] for w in (g[rows], h[rows], None))
                tg, th = g[rows].sum(), h[rows].sum()
                left, right = np.clip(cg / (ch + 1), lo, hi), np.clip((tg - cg) / (th - ch + 1), lo, hi)
                gain = 2 * (left * cg + right * (tg - cg)) - left**2 * (ch + 1) - right**2 * (th - ch + 1)
                whole = np.clip(tg / (th + 1), lo, hi)
                gain = gain - (2 * whole * tg - whole**2 * (th + 1))
                fits = (cn >= LEAF) & (len(rows) - cn >= LEAF) & (signs[j] * (right - left) >= 0)
                gain = np.where(fits, gain, -np.inf)
                s = int(gain.argmax())
                if gain[s] > best[0]:
                    best = (gain[s], (j, s, left[s], right[s]))
            if best[1]:
                j, s, left, right = best[1]
                f[i], t[i] = j, edges[j][s]
                middle = (left + right) / 2
                bounds[2 * i + 1] = (lo, min(hi, middle)) if signs[j] > 0 else (max(lo, middle), hi) if signs[j] < 0 else (lo, hi)
                bounds[2 * i + 2] = (max(lo, middle), hi) if signs[j] > 0 else (lo, min(hi, middle)) if signs[j] < 0 else (lo, hi)
            else:
                bounds[2 * i + 1] = bounds[2 * i + 2] = (lo, hi)
            node[rows] = 2 * i + 1 + (x[rows, f[i]] > t[i])
        for leaf in range(2**DEPTH):
            rows = np.flatnonzero(node == inner + leaf)
            v[leaf] = STEP * np.clip(g[rows].sum() / (h[rows].sum() + 1), *bounds[inner + leaf])
        margin += v[node - inner]
        feature.append(f), threshold.append(t), value.append(v)
    return Trees(np.array(feature), np.array(threshold), np.array(value), start)


@dataclass
class Model:
    trees: Trees
    threshold: float


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on a bounded sample; None without rows of both classes."""
    own = (hash_share(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL"), 4 * TRAINING, "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"))
           .orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(TRAINING))
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(own, "doc_id").dropDuplicates(["doc_id"])
    texts = texts.withColumn("x", features_udf()(F.col("text"))).drop("text")
    rows = written(texts, "quality-sample").orderBy("doc_id").toArrow()
    y = rows.column("quality").to_numpy().astype(float) if rows.num_rows else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return None
    x = np.stack(rows.column("x").to_numpy())
    signs = list(FEATURES.values())
    fold, held_out = np.arange(len(y)) % FOLDS, np.full(len(y), np.nan)
    for k in range(FOLDS):
        train_on, test = fold != k, fold == k
        if test.any() and 0 < y[train_on].sum() < train_on.sum():
            held_out[test] = grow(x[train_on], y[train_on], signs).score(x[test])
    scored = ~np.isnan(held_out)
    return Model(grow(x, y, signs), min(HIGHEST, best_cut(held_out[scored], y[scored])))


def best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The cut of least weighted error; in the middle of its gap."""
    if not 0 < y.sum() < len(y):
        return HIGHEST
    order = np.argsort(score, kind="stable")
    s, good = score[order], y[order] == 1
    # the error of a cut below the i-th lowest score
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()
    kept = 1 - np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    error = GOOD_WEIGHT * lost + kept
    between = np.concatenate(([True], s[1:] > s[:-1], [True]))  # equal scores can't be parted
    i = int(np.where(between, error, np.inf).argmin())
    return float(s[0] / 2 if i == 0 else (s[-1] + 1) / 2 if i == len(s) else (s[i - 1] + s[i]) / 2)


def matrix(s: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([s[k].astype(np.float64) for k in FEATURES], 1)


def features_udf():
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [matrix(statistics(p)) for p in pieces(texts)]
            yield pa.array([r for m in rows for r in m], pa.list_(pa.float64()))
    return F.arrow_udf(run, "array<double>")


def judge(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with the base statistics, base_failed, quality_score (the ensemble's score) and kept."""
    model = model or train(docs, labels)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [statistics(p) for p in pieces(texts)] or [statistics(texts)]
            s = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
            score = model.trees.score(matrix(s)) if model else np.ones(len(failed))
            kept = ~failed & (score >= (model.threshold if model else 0))
            yield pa.StructArray.from_arrays([*[pa.array(s[k], pa.int64()) for k in BASE], pa.array(failed), pa.array(score), pa.array(kept)],
                                             [*BASE, "base_failed", "quality_score", "kept"])

    kind = ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, quality_score double, kept boolean"
    return (docs.drop(*BASE, "base_failed", "quality_score", "kept", "_q").withColumn("_q", F.arrow_udf(run, kind)(F.col("text")))
            .select("*", "_q.*").drop("_q"))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``, and the score."""
    return judge(docs.select("doc_id", "text"), labels).drop("text")
