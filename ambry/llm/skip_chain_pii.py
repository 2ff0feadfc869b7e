"""Personal data by base patterns and a skip-chain conditional random field.

Base patterns find e-mail addresses, IP addresses, card and phone numbers in
each whole text.  A conditional random field then labels the document's
candidate tokens (those with a digit, an "@" or a written-out one): neighbours
are joined by chain edges, and tokens that repeat or resemble an earlier one,
however far away, by skip edges with potentials of their own.  Loopy sum-product
message passing over all edges makes labels agree across the document.  Tokens
that are labelled with confidence where no base match lies become further spans.

The field is trained on the base matches of a bounded sample of texts: at most
``TRAINING`` passages of the whole table: texts of up to ``TRAINING_CHARS`` code
points, and from each longer one a window of that size around its first match of each kind, or around its
first candidate token.  Half of them are for passages with a base match, in equal parts for each
kind, the others for candidates of any sort; each part takes the passages whose ids
hash lowest.  In them matches are also rewritten into forms that the patterns miss (no "+", other
separators, "(at)", "[.]") and numbers of other kinds are mixed in; weights maximise the pseudo-likelihood.

Offsets are code points, ends exclusive.  Defined cases: null or empty text has
no spans; without base matches to learn from only base spans are given; repeated
rows give equal results; an empty table gives an empty result; other columns
pass through, and those that the operator adds replace any of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.llm.common import hash_share, pieces, written

KINDS = ("email", "ip", "card", "phone")
#: Passages to learn from, and their size; they are chosen among so many times as many rows.
TRAINING, TRAINING_CHARS, TRAINING_SHARE = 1500, 1 << 14, 50
#: Rounds of message passing and their damping; least marginal of a span's tokens.
ROUNDS, DAMPING, SURE = 15, 0.3, 0.9
#: Steps and size of a step of training, and its ridge.
STEPS, RATE, RIDGE = 200, 0.5, 1e-4
#: Digits that a span of the field must have.
DIGITS = {"card": (13, 19), "phone": (7, 15)}
#: What makes a token a candidate.
CANDIDATE = r"[0-9@]|[(\[]at[)\]]"

Span = tuple[str, int, int]


# ---- base patterns ---------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each "@" outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def addresses(text: str) -> Iterator[Span]:
    """Every four numbers in a row that single dots join, with parts up to 255."""
    for m in _NUMBERS.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i:i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i:i + 4]):
                yield "ip", at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """Base matches by kind as listed, then start."""
    out = list(emails(text)) if "@" in text else []
    out += addresses(text)
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


# ---- the field -------------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_HINT = re.compile(CANDIDATE)
_NO_DIGIT = re.compile(r"[^0-9]+")
_AT = re.compile(r"[(\[]at[)\]]")
_DOT = re.compile(r"[(\[]\.[)\]]")
#: Edges: neighbours side by side, few words apart, farther; the same again; alike.
EDGES = 5
#: Numbers of digits at which a new bucket starts, and of separators.
DIGIT_STEPS, DOT_STEPS = (1, 2, 3, 4, 5, 7, 8, 11, 12, 13, 16, 17, 20), (1, 2, 3, 4)
N_FEATURES = 1 + len(DIGIT_STEPS) + 1 + len(DOT_STEPS) + 1 + 14


def features(token: str, before: bool, after: bool) -> list[int]:
    """Numbers of the features that hold for a token; ``before`` and ``after``: another candidate lies beside it."""
    core = token.strip(".,;:!?\"'")
    digits = _NO_DIGIT.sub("", core)
    out, at = [0], 1
    out.append(at + sum(len(digits) >= s for s in DIGIT_STEPS))
    at += len(DIGIT_STEPS) + 1
    out.append(at + sum(core.count(".") >= s for s in DOT_STEPS))
    at += len(DOT_STEPS) + 1
    letters = sum(c.isalpha() for c in core)
    parts = core.replace("[.]", ".").replace("(.)", ".").split(".")
    flags = ("@" in core, bool(_AT.search(core)), bool(_DOT.search(core)), letters > 0, letters > len(digits), core[:1] == "+",
             "(" in core and ")" in core and letters == 0, "-" in core and letters == 0,
             13 <= len(digits) <= 19 and luhn(digits), len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
             any(c in core for c in "=:/_\"'"), before, after, any(c in core for c in "/_") and letters == 0)
    return out + [at + i for i, f in enumerate(flags) if f]


def alike(token: str) -> tuple[str, str]:
    """What equal tokens share, and what similar ones do; empty where a token is too short to say."""
    core = _DOT.sub(".", _AT.sub("@", token.strip(".,;:!?\"'").lower()))
    digits = _NO_DIGIT.sub("", core)
    if "@" in core:
        return core, ""
    return (digits, digits[-7:]) if len(digits) >= 7 else ("", "")


@dataclass
class Graph:
    """Candidate tokens of some documents and their edges."""
    document: list[int]
    spans: list[tuple[int, int]]
    tokens: list[str]
    features: np.ndarray  # tokens x N_FEATURES
    edges: np.ndarray     # edges x 3: earlier token, later token, kind of edge


def graph_of(texts: list[str]) -> Graph:
    """Edges grow with the tokens: each is joined to its neighbour and to the last token equal or alike."""
    document, spans, tokens, rows, edges = [], [], [], [], []
    for d, text in enumerate(texts):
        own, word = [], -1
        for word, m in enumerate(_TOKEN.finditer(text)):
            if _HINT.search(m.group()):
                own.append((word, m.start(), m.end(), m.group()))
        first, same, like = len(tokens), {}, {}
        for i, (word, start, end, token) in enumerate(own):
            before, after = i > 0 and own[i - 1][0] == word - 1, i + 1 < len(own) and own[i + 1][0] == word + 1
            rows.append(features(token, before, after))
            document.append(d), spans.append((start, end)), tokens.append(token)
            if i:
                edges.append((first + i - 1, first + i, 0 if before else 1 if word - own[i - 1][0] <= 4 else 2))
            key, near = alike(token)
            if key and key in same:
                edges.append((same[key], first + i, 3))
            elif near and near in like:
                edges.append((like[near], first + i, 4))
            if key:
                same[key] = first + i
            if near:
                like[near] = first + i
    x = np.zeros((len(tokens), N_FEATURES))
    for row, f in zip(x, rows):
        row[f] = 1
    return Graph(document, spans, tokens, x, np.array(edges, np.int64).reshape(-1, 3))


@dataclass
class Field:
    unary: np.ndarray  # N_FEATURES x labels
    pair: np.ndarray   # EDGES x labels x labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(field: Field, graph: Graph) -> np.ndarray:
    """Tokens x labels, by loopy sum-product message passing over chain and skip edges at once."""
    u = graph.features @ field.unary
    a, b, kind = graph.edges.T
    src, dst = np.concatenate((a, b)), np.concatenate((b, a))
    potential = np.concatenate((field.pair[kind], field.pair[kind].transpose(0, 2, 1)))  # sender x receiver
    back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
    message = np.zeros((len(src), u.shape[1]))
    for _ in range(ROUNDS if len(src) else 0):
        belief = u.copy()
        np.add.at(belief, dst, message)
        new = _log_sum((belief[src] - message[back])[:, :, None] + potential, 1)
        new -= _log_sum(new, 1)[:, None]
        message = DAMPING * message + (1 - DAMPING) * new
    belief = u.copy()
    np.add.at(belief, dst, message)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def fit(graph: Graph, labels: np.ndarray) -> Field:
    """Weights of the largest pseudo-likelihood: every label given its neighbours' labels."""
    n = len(KINDS) + 1
    truth = np.eye(n)[labels]
    field = Field(np.zeros((N_FEATURES, n)), np.zeros((EDGES, n, n)))
    a, b, kind = graph.edges.T
    step_u, step_p = np.zeros_like(field.unary), np.zeros_like(field.pair)
    # rare labels count more, up to the others' weight
    weight = np.minimum(np.bincount(labels, minlength=n).max() / np.maximum(np.bincount(labels, minlength=n), 1), 20)[labels][:, None]
    for _ in range(STEPS):
        score = graph.features @ field.unary
        np.add.at(score, a, field.pair[kind, :, labels[b]])
        np.add.at(score, b, field.pair[kind, labels[a], :])
        gap = (truth - np.exp(score - _log_sum(score, 1)[:, None])) * weight / weight.sum()
        g_u = graph.features.T @ gap - RIDGE * field.unary
        g_p = -RIDGE * field.pair
        np.add.at(g_p, (kind, slice(None), labels[b]), gap[a])
        np.add.at(g_p, (kind, labels[a], slice(None)), gap[b])
        step_u, step_p = step_u + g_u**2, step_p + g_p**2  # step sizes by each weight's past gradients
        field.unary += RATE * g_u / np.sqrt(step_u + 1e-10)
        field.pair += RATE * g_p / np.sqrt(step_p + 1e-10)
    return field


def rewritten(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """``text`` with some of its spans in forms that the base patterns miss and with numbers that are
    no personal data, and where the spans are then."""
    out, moved, done = [], [], 0

    def put(s: str) -> int:
        out.append(s)
        return sum(map(len, out))

    chosen: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not chosen or s[1] >= chosen[-1][2]:
            chosen.append(s)
    for kind, start, end in chosen:
        put(text[done:start])
        if rng.random() < 0.3:
            decoy = rng.choice(["2024-05-17", "10:30", "1,234,567", "1999", "3.14", "20240517", "v2.0.1", "7", "12/31", "978-3-16", "#4521", "42%", "555", "1234567"])
            put(f"{decoy} " if not out or out[-1][-1:].isspace() or not out[-1] else "")
        s = text[start:end]
        if rng.random() < 0.5:
            digits = _NO_DIGIT.sub("", s)
            s = {"email": lambda: s.replace("@", rng.choice(["(at)", "[at]"])), "ip": lambda: s.replace(".", "[.]"),
                 "card": lambda: rng.choice([".", "/", "_"]).join(digits[i:i + 4] for i in range(0, len(digits), 4)),
                 "phone": lambda: s.lstrip("+") if rng.random() < 0.5 else s.partition(" ")[2] or s.lstrip("+")}[kind]()
        at = sum(map(len, out))
        moved.append((kind, at, put(s)))
        done = end
    put(text[done:])
    return "".join(out), moved


def label_tokens(graph: Graph, spans: list[list[Span]]) -> np.ndarray:
    """The label of each token: 0, or the kind (from 1) of a span that it overlaps."""
    labels = np.zeros(len(graph.tokens), np.int64)
    for i, (d, (start, end)) in enumerate(zip(graph.document, graph.spans)):
        for kind, a, b in reversed(spans[d]):
            if a < end and start < b:
                labels[i] = KINDS.index(kind) + 1
    return labels


def _bits(spans: list[Span]) -> int:
    return sum({1 << KINDS.index(kind) for kind, _, _ in spans})


def passages(text: str, size: int = TRAINING_CHARS) -> list[tuple[int, int]]:
    """Where the passages of a text to learn from start, and bits of the kinds that they have a base match of."""
    spans = base_spans(text)
    if len(text) <= size:
        return [(0, _bits(spans))]
    first = {kind: start for kind, start, _ in reversed(spans)}
    hint = _HINT.search(text)
    starts = sorted({max(0, at - size // 2) for at in first.values()} or {max(0, hint.start() - size // 2) if hint else 0})
    return [(s, _bits([x for x in spans if s <= x[1] and x[2] <= s + size])) for s in starts]


def _passages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kinds", pa.int32())]))
    for texts in batches:
        yield pa.array([[{"start": s, "kinds": k} for s, k in passages(t)] for t in texts.to_pylist()], kind)


def training_texts(docs: DataFrame) -> list[str]:
    """The bounded sample, drawn for each kind from all passages with a match."""
    own = docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE)).withColumn("tie", F.xxhash64("text"))
    some = F.explode(F.arrow_udf(_passages, "array<struct<start: long, kinds: int>>")(F.col("text")))
    found = written(own.select("doc_id", "tie", some.alias("p")).select("doc_id", "tie", "p.*"), "pii-kinds").distinct()
    key = ["doc_id", "tie", "start"]
    order = [F.xxhash64(F.lit("pii"), "doc_id"), *key]
    each = TRAINING // (2 * len(KINDS))
    parts = [(found.where(F.col("kinds").bitwiseAND(1 << i) != 0), each) for i in range(len(KINDS))]
    parts.append((found, TRAINING - each * len(KINDS)))
    chosen = None
    for rows, n in parts:
        part = hash_share(rows, TRAINING_SHARE * n, *key).orderBy(*order).limit(n).select(*key)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(written(chosen.distinct(), "pii-chosen").select(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), "start"))
    sample = (own.join(chosen, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")))
              .select(*key, F.substring("text", (F.col("start") + 1).cast("int"), F.lit(TRAINING_CHARS)).alias("text"))
              .dropDuplicates(key).orderBy(*order))
    return sample.toArrow().column("text").to_pylist()


def train(docs: DataFrame) -> Field | None:
    """Fit on a bounded sample; None where the table has no base match."""
    texts = training_texts(docs)
    spans = [base_spans(t) for t in texts]
    if not any(spans):
        return None
    rng = np.random.default_rng(7)
    for t, s in [(t, s) for t, s in zip(texts, spans) if s]:
        new, moved = rewritten(t, s, rng)
        texts, spans = texts + [new], spans + [moved]
    graph = graph_of(texts)
    return fit(graph, label_tokens(graph, spans))


def further_spans(field: Field, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans of the field that overlap no base span; neighbouring tokens of a number are one span."""
    graph, out = graph_of(texts), [[] for _ in texts]
    if not graph.tokens:
        return out
    p = marginals(field, graph)
    label = np.where(p.max(1) >= SURE, p.argmax(1), 0)
    run: list[int] = []

    def close() -> None:
        if not run:
            return
        d, kind = graph.document[run[0]], KINDS[label[run[0]] - 1]
        text, start, end = texts[d], graph.spans[run[0]][0], graph.spans[run[-1]][1]
        while end > start and text[end - 1] in ".,;:!?\"'":
            end -= 1
        while start < end and text[start] in "\"'":
            start += 1
        n = sum(c in "0123456789" for c in text[start:end])
        low, high = DIGITS.get(kind, (0, 1 << 30))
        if low <= n <= high and start < end and not any(a < end and start < b for _, a, b in base[d]):
            out[d].append((kind, start, end))
        run.clear()

    for i in np.flatnonzero(label):
        d, kind = graph.document[i], label[i]
        joined = run and graph.document[run[-1]] == d and label[run[-1]] == kind and run[-1] == i - 1 and KINDS[kind - 1] in DIGITS \
            and texts[d][graph.spans[i - 1][1]:graph.spans[i][0]] in (" ", "-")
        if not joined:
            close()
        run.append(int(i))
    close()
    return out


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base matches), base_spans and spans (all)."""
    field = field or train(docs)
    names = [f"n_{k}" for k in KINDS] + ["base_spans", "spans"]

    def one(texts: pa.Array) -> list[np.ndarray]:
        some = np.flatnonzero(pc.match_substring_regex(texts, CANDIDATE).to_numpy(zero_copy_only=False))
        out = [np.zeros(len(texts), np.int64) for _ in KINDS] + [np.full(len(texts), "", object) for _ in range(2)]
        own = texts.take(pa.array(some)).to_pylist()
        base = [base_spans(t) for t in own]
        more = further_spans(field, own, base) if field else [[] for _ in own]
        for i, b, m in zip(some, base, more):
            for k, _, _ in b:
                out[KINDS.index(k)][i] += 1
            out[-2][i], out[-1][i] = written_out(b), written_out(b + m)
        return out

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [one(p) for p in pieces(texts)] or [one(texts)]
            cols = [np.concatenate(c) for c in zip(*parts)]
            yield pa.StructArray.from_arrays([*map(pa.array, cols[:-2]), *[pa.array(x, pa.string()) for x in cols[-2:]]], names)

    kind = ", ".join(f"{n} long" for n in names[:-2]) + ", base_spans string, spans string"
    return (docs.drop(*names, "_p").withColumn("_p", F.arrow_udf(run, kind)(F.col("text"))).select("*", "_p.*").drop("_p"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    found = find_personal_data(docs.select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
