"""Personal data: base patterns plus a linear-chain conditional random field over word shapes.

The base patterns give spans of four kinds (``base_spans``). A CRF with one label per white-space
token (outside, or one of the kinds) adds spans the patterns do not match, such as local phone
numbers, card-like digit groups or addresses with a spelled-out at sign; added spans that touch a base
span are left out, so base spans stay as they are. Features are shapes of the token and of both its
neighbours, never the words. The model is fitted on the small labelled table of ``pii_examples`` by
gradient steps on the regularised likelihood (forward and backward sums); a batch of texts is decoded
by Viterbi in numpy, all lines of the batch one token at a time, every line whole.

Defined results: null text is empty (no spans, digest of nothing); repeated rows each give a row; an
empty table gives an empty result; extra columns are ignored; very long runs of digits, letters or
signs take time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import Recent, id_text, worker_cache
from roomledger.llm.pii_examples import LABELS, labelled

KINDS = LABELS[1:]
CACHE_ENTRIES = 300_000
BATCH_TOKENS = 1_000_000
STEPS, RATE, RIDGE = 300, 0.1, 0.003

# Fixed patterns of the contract. A digit run's inside cannot begin an ip match, which the lookbehind
# says at once; local parts are found from the at sign backwards (``emails``), which is the same match.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile("[0-9]")
TOKEN = re.compile(r"\S+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail matches, by walking left from each at sign."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def is_card(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(match: str) -> bool:
    return 9 <= sum(c.isdigit() for c in match) <= 15


def is_ip(match: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern, holds in (("ip", IP, is_ip), ("card", CARD, is_card), ("phone", PHONE, is_phone)):
            if kind != "phone" or "+" in text:
                spans += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m.group())]
    return spans


def shape(token: str) -> tuple[str, ...]:
    """Features of one token, none of which is the word itself."""
    if token.isalpha():
        case = "upper" if token.isupper() else "title" if token[:1].isupper() else "lower"
        return ("word", case)
    core = token.rstrip(".,;:!?")
    runs, digits = [], 0
    for c in core[:200]:  # the run shape of a very long token is cut; its digits are counted below
        kind = "d" if "0" <= c <= "9" else "x" if c.isalpha() else c if c in "@.+-():/[]" else "*"
        if not runs or runs[-1][0] != kind:
            runs.append([kind, 0])
        runs[-1][1] += 1
    digits = sum("0" <= c <= "9" for c in core)
    return (
        "mixed",
        "runs " + "".join(k for k, _ in runs[:12]),
        "sized " + "".join(f"{k}{min(n, 5)}" if k == "d" else k for k, n in runs[:6]),
        f"digits {min(digits, 20)}",
        f"letters {min(2, sum(c.isalpha() for c in core))}",
        *(f"has {c}" for c in "@.+-():/[]" if c in core),
        *(("only digits",) if core and digits == len(core) else ()),
    )


@dataclass
class Crf:
    """Weights of (place, feature) by label, and of label pairs; plain data, sent to the workers."""

    features: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def table(self, features: tuple[str, ...]) -> np.ndarray:
        """The three emission rows (as itself, seen from the next token, seen from the token before)."""
        at = [self.features[f] for f in features if f in self.features]
        return np.stack((self.own[at].sum(axis=0), self.before[at].sum(axis=0), self.after[at].sum(axis=0)))


def sums(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(scores - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(rows: list[list[tuple[str, str]]]) -> Crf:
    """Maximum likelihood with a ridge, by Adam steps over the whole table (padded to one length)."""
    shapes = [[shape(token) for token, _ in row] for row in rows]
    names = sorted({f for row in shapes for s in row for f in s})
    index = {name: i for i, name in enumerate(names)}
    n, width, labels, size = len(rows), max(map(len, rows)), len(LABELS), len(names)
    present = np.zeros((n, width + 2, size))
    gold, real = np.zeros((n, width), dtype=np.int64), np.zeros((n, width), dtype=bool)
    for i, row in enumerate(rows):
        for t, (_, label) in enumerate(row):
            present[i, t + 1, [index[f] for f in shapes[i][t]]] = 1.0
            gold[i, t], real[i, t] = LABELS.index(label), True
    own, left, right = present[:, 1:-1], present[:, :-2], present[:, 2:]
    stacked = np.concatenate((own, left, right), axis=2).reshape(n * width, 3 * size)
    params = [np.zeros((3 * size, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    truth = np.eye(labels)[gold] * real[:, :, None]
    truth_pairs = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    for step in range(1, STEPS + 1):
        weights, pairs, first = params
        emit = (stacked @ weights).reshape(n, width, labels)
        forward, backward = np.zeros((n, width, labels)), np.zeros((n, width, labels))
        forward[:, 0] = emit[:, 0] + first
        for t in range(1, width):
            moved = sums(forward[:, t - 1, :, None] + pairs, 1) + emit[:, t]
            forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            moved = sums(pairs + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], moved, backward[:, t + 1])
        total = sums(forward[:, -1], 1)
        state = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        joint = forward[:, :-1, :, None] + pairs + (emit[:, 1:] + backward[:, 1:])[:, :, None, :]
        joint = np.exp(np.where(real[:, 1:, None, None], joint - total[:, None, None, None], -np.inf))
        gradients = [
            stacked.T @ (state - truth).reshape(n * width, labels) / n + RIDGE * weights,
            (joint.sum(axis=(0, 1)) - truth_pairs) / n + RIDGE * pairs,
            (state[:, 0] - truth[:, 0]).sum(axis=0) / n + RIDGE * first,
        ]
        for p, g, (m, v) in zip(params, gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, pairs, first = params
    parts = weights.reshape(3, size, labels)
    return Crf(index, parts[0], parts[1], parts[2], pairs, first)


@cache
def model() -> Crf:
    """The tagger fitted on the labelled table, once per process."""
    return fit(labelled())


class Tagger:
    """Emission rows per token shape, with a bounded cache from tokens to their shape's number."""

    def __init__(self, crf: Crf):
        self.crf, self.tokens = crf, Recent(CACHE_ENTRIES)
        self.numbers: dict[tuple[str, ...], int] = {}
        self.rows: list[np.ndarray] = []

    def number(self, token: str) -> int:
        features = shape(token)
        known = tuple(f for f in features if f in self.crf.features)  # bounds the number of shapes
        if known not in self.numbers:
            self.numbers[known] = len(self.rows)
            self.rows.append(self.crf.table(known))
        return self.numbers[known]

    def encode(self, lines: list[list[str]]) -> list[np.ndarray]:
        cache = self.tokens.fresh()
        for token in self.tokens.missing({token for line in lines for token in line}):
            cache[token] = self.number(token)
        return [np.fromiter(map(cache.__getitem__, line), dtype=np.int32, count=len(line)) for line in lines]

    def decode(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best label sequence of each line, all lines of the batch in step."""
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        sizes = np.array([len(lines[i]) for i in order])
        if not len(sizes) or not sizes[0]:
            return [np.zeros(0, dtype=np.int8) for _ in lines]
        flat = np.concatenate([lines[i] for i in order])
        starts = np.cumsum(sizes) - sizes
        table = np.stack(self.rows).astype(np.float32)  # shape number, place, label
        emit = table[flat, 0]
        inner = np.ones(len(flat), dtype=bool)
        inner[starts[sizes > 0]] = False  # every token but a line's first has one before it
        has_before = np.flatnonzero(inner)
        emit[has_before] += table[flat[has_before - 1], 1]
        emit[has_before - 1] += table[flat[has_before], 2]
        pairs = self.crf.pairs.astype(np.float32)
        emit[starts[sizes > 0]] += self.crf.first.astype(np.float32)
        back = np.zeros(emit.shape, dtype=np.int8)
        best, final = emit[starts[sizes > 0]].copy(), np.zeros((len(sizes), emit.shape[1]), dtype=np.float32)
        active = int((sizes > 0).sum())
        for t in range(1, int(sizes[0]) + 1):
            longer = int(np.searchsorted(-sizes, -t, side="left"))  # lines with more than t tokens
            final[longer:active] = best[longer:active]
            active, best = longer, best[:longer]
            if not longer:
                break
            at = starts[:longer] + t
            moved = best[:, :, None] + pairs
            back[at] = moved.argmax(axis=1)
            best = moved.max(axis=1) + emit[at]
        labels = np.zeros(len(flat), dtype=np.int8)
        current = final.argmax(axis=1)
        for t in range(int(sizes[0]) - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -t, side="left"))
            at = starts[:n] + t
            labels[at] = current[:n]
            current[:n] = back[at, current[:n]]
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(lines)
        for place, i in enumerate(order):
            out[i] = labels[starts[place] : starts[place] + sizes[place]]
        return out

    def added(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """The tagger's spans of each text: runs of tokens of one kind, without closing punctuation."""
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        queue: list[tuple[int, int, str]] = []
        encoded: list[np.ndarray] = []
        tokens = 0

        def flush() -> None:
            for (i, offset, line), labels in zip(queue, self.decode(encoded), strict=True):
                if labels.any():
                    found[i] += spans_of(line, offset, labels)
            queue.clear()
            encoded.clear()

        for i, text in enumerate(texts):
            offset, lines, places = 0, [], []
            for line in text.split("\n"):
                words = line.split()
                if words:
                    lines.append(words)
                    places.append((i, offset, line))
                offset += len(line) + 1
            encoded += self.encode(lines)
            queue += places
            tokens += sum(map(len, lines))
            if tokens >= BATCH_TOKENS:
                flush()
                tokens = 0
        flush()
        return found


def spans_of(line: str, offset: int, labels: np.ndarray) -> list[tuple[str, int, int]]:
    spans: list[list] = []
    before = 0
    for match, label in zip(TOKEN.finditer(line), labels.tolist(), strict=True):
        if label:
            token = match.group()
            start = offset + match.start() + len(token) - len(token.lstrip("\"'<"))
            end = offset + match.end() - (len(token) - len(token.rstrip(".,;:!?\"'>")))
            if label == before:
                spans[-1][2] = max(spans[-1][2], end)
            else:
                spans.append([LABELS[label], start, end])
        before = label
    return [(kind, a, b) for kind, a, b in spans if b > a]


def all_spans(base: list[tuple[str, int, int]], added: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and those added spans that touch none of them, by kind, then start."""
    if added:
        taken = sorted((a, b) for _, a, b in base)
        starts = np.array([a for a, _ in taken])
        reach = np.maximum.accumulate(np.array([b for _, b in taken])) if taken else starts

        def free(a: int, b: int) -> bool:
            before = int(np.searchsorted(starts, b, side="left"))  # base spans that begin before b
            return before == 0 or reach[before - 1] <= a

        base = base + [(k, a, b) for k, a, b in added if free(a, b)]
    return sorted(base, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


def tagger(crf: Crf) -> Tagger:
    return worker_cache(("pii", hashlib.sha256(crf.own.tobytes()).digest()), lambda: Tagger(crf))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans as text."""
    crf = model()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = tagger(crf)
        for frame in frames:
            texts = frame["text"].tolist()
            rows = []
            for doc_id, null, text, added in zip(frame["doc_id"], frame["doc_id"].isna(), texts, own.added(texts), strict=True):
                base = base_spans(text)
                counts = [sum(kind == k for k, _, _ in base) for kind in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((None if null else int(doc_id), *counts, digest, joined(all_spans(base, added))))
            names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return id_text(docs).mapInPandas(run, schema)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans are replaced as one."""
    out, free = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= free:
            out += [text[free:a], f"[{kind.upper()}]"]
        free = max(free, b)
    return "".join([*out, text[free:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced in ``text``; ``n_chars`` is set anew where it is there."""
    crf = model()

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = tagger(crf)
        for batch in batches:
            whole = batch.fillna("")
            texts = [
                redact_text(t, all_spans(base_spans(t), added)) for t, added in zip(whole, own.added(whole.tolist()), strict=True)
            ]
            yield pd.Series(texts, index=batch.index).where(batch.notna(), None)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", size)
    return out.select(*docs.columns)
