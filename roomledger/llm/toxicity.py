"""Toxicity by compression distance.

Two zstandard dictionaries are trained from labelled texts. Both end in the same content, chosen by
zstandard's own trainer from ordinary windows; the toxic one begins with the word beginnings that
toxic texts use far more than ordinary ones, by a likelihood ratio of the texts that have them at all and
of the texts that have them often (windows with one of them stay out of the shared content). A window
of ordinary words then compresses to the same length with either, and each toxic expression saves
bytes with one of them only. A whole text is cut into windows of ``WINDOW`` words; statistics of the
windows' differences in compressed length (mean, maximum, mean of the three largest, shares of windows
that save at least so many bytes, also weighted by the number of windows) are calibrated to a probability
by logistic regression on the same labelled texts. Near copies count once in the fit. The rows of a class
weigh as much as all its labels, so the sample's share of toxic rows does not move the scores.

Fitting uses a bounded sample, chosen by a hash of the id: at most about ``SAMPLE[c]`` texts of class c, none
over ``LONGEST`` characters; the shared content is trained on ``SHARED_WINDOWS`` of their windows. Every text is scored, whole. Labels of held-out rows (crc32 of the id as
text, modulo ``FOLDS``, equal to ``HELD_OUT``) are never read, and only the text enters a score.

Defined results: null and empty texts get the score of a text without windows of their own; a null
doc_id is not held out; labels other than 0 and 1 are ignored, an id labelled twice counts as toxic if
any row says so; without labels of both classes the score is the share of toxic labels (0 without
any); repeated rows each give a row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import id_text

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SAMPLE = {0: 6000, 1: 2000}
LONGEST = 50_000
WINDOW = 8
SAVED = (2, 4, 6)  # bytes
SHARED_BYTES = 12_000
SHARED_WINDOWS = 60_000  # of the sampled ordinary texts, chosen by hash, that the shared content is trained on
SKETCH = 16  # hashes that stand for a text when near copies are left out of the fit
SPECIFIC = 48  # word beginnings in the toxic dictionary's own part
PREFIXES = (4, 5, 6, 7, 8)
LEAST_RATE = 0.005  # a text uses a word beginning if at least this share of its words has it
LEAST_LOG_ODDS = 2.0
LEAST_G = 24.0  # likelihood-ratio statistic; rare word beginnings of one class are mostly chance below it
SEARCH = {"window_log": 17, "hash_log": 16, "chain_log": 16, "search_log": 7, "min_match": 5, "target_length": 32}


def windows(text: str) -> list[bytes]:
    """The text's words, lower-cased, in consecutive windows; every word is in one of them."""
    words = text.lower().encode("utf-8", "replace").split()
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)] or [b"  "]


def beginnings(text: str) -> tuple[set[bytes], set[bytes]]:
    """The text's word beginnings, each with the space before the word: all of them, and the frequent ones.

    Long texts hold nearly every beginning by chance; those in ``LEAST_RATE`` of the words are no chance.
    """
    words = text.lower().encode("utf-8", "replace").split()
    seen = Counter()
    for word, times in Counter(words).items():
        for n in PREFIXES:
            if len(word) >= n:
                seen[b" " + word[:n]] += times
    return set(seen), {part for part, times in seen.items() if times >= LEAST_RATE * len(words)}


def over_represented(toxic: Counter, ordinary: Counter, n_toxic: int, n_ordinary: int) -> dict[bytes, float]:
    """Beginnings in far more of the toxic texts than of the ordinary ones -> likelihood ratio."""
    share, found = n_toxic / (n_toxic + n_ordinary), {}
    for part, n in toxic.items():
        other = ordinary[part]
        odds = math.log((n + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_ordinary + 1))
        if odds >= LEAST_LOG_ODDS:
            surprise = n * math.log(n / ((n + other) * share))
            surprise += other * math.log(other / ((n + other) * (1 - share))) if other else 0.0
            if 2 * surprise >= LEAST_G:
                found[part] = surprise
    return found


def typical(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Word beginnings over-represented in toxic texts, the strongest last (nearest to the shared part)."""
    counts = [[Counter(), Counter()], [Counter(), Counter()]]
    for label, texts in enumerate((toxic, ordinary)):
        for text in texts:
            for kind, parts in enumerate(beginnings(text)):
                counts[kind][label].update(parts)
    ranked: dict[bytes, float] = {}
    for in_toxic, in_ordinary in counts:
        for part, surprise in over_represented(in_toxic, in_ordinary, len(toxic), len(ordinary)).items():
            ranked[part] = max(surprise, ranked.get(part, 0.0))
    # A beginning that nearly always goes on the same way is left to its longer form.
    in_toxic, longer = counts[0][0], Counter()
    for part in ranked:
        for size in range(5, len(part)):
            longer[part[:size]] = max(longer[part[:size]], in_toxic[part])
    whole = {p for p in ranked if longer[p] < 0.8 * in_toxic[p]}
    # A longer form that says no more than a shorter one only takes room.
    kept = [p for p in whole if not any(p[:n] in whole and ranked[p[:n]] >= ranked[p] for n in range(5, len(p)))]
    return sorted(kept, key=lambda p: (ranked[p], p))[-SPECIFIC:]


def chosen_windows(found: Iterator[bytes]) -> list[bytes]:
    """At most ``SHARED_WINDOWS`` of the windows, from all over the texts, in their order."""
    numbered = ((zlib.crc32(w, n), n, w) for n, w in enumerate(found))
    return [w for _, _, w in sorted(heapq.nsmallest(SHARED_WINDOWS, numbered), key=lambda x: x[1])]


def shared_content(ordinary: list[str], toxic_parts: list[bytes]) -> bytes:
    """Dictionary content that zstandard's trainer chooses from ordinary windows without toxic beginnings."""
    import zstandard

    unlike = re.compile(b"|".join((re.escape(p.strip()) for p in toxic_parts)) or b"(?!)")
    samples = chosen_windows(w for text in ordinary for w in windows(text) if not unlike.search(w))
    try:
        return zstandard.train_dictionary(SHARED_BYTES + 4096, samples, k=64, d=6).as_bytes()[-SHARED_BYTES:]
    except zstandard.ZstdError:  # the trainer refuses very small samples; their own text is then the content
        return b"".join(samples)[-SHARED_BYTES:]


def without_near_copies(texts: list[str]) -> list[str]:
    """The texts, one of each group of near copies: a hundred copies of a text say no more than one.

    A text's sketch is the ``SKETCH`` smallest hashes of its three-word shingles; one that shares a quarter of
    them or more with a text kept before is left out.
    """
    kept, owner = [], {}
    for text in texts:
        words = text.lower().encode("utf-8", "replace").split()
        shingles = {zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))}
        sketch = heapq.nsmallest(SKETCH, shingles)
        alike = Counter(other for h in sketch for other in owner.get(h, ()))
        if not alike or max(alike.values()) < len(sketch) / 4:
            for h in sketch:
                owner.setdefault(h, []).append(len(kept))
            kept.append(text)
    return kept


@dataclass
class Model:
    """Both dictionaries and the calibration; plain data, sent to the workers."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    constant: float | None = None  # the score where one class has no labels


class Compressors:
    def __init__(self, model: Model):
        import zstandard

        def make(content: bytes):
            content = content if len(content) >= 8 else content.ljust(8)
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            search = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_LAZY2, write_checksum=0, write_content_size=0, write_dict_id=0, **SEARCH
            )
            held.precompute_compress(compression_params=search)
            return zstandard.ZstdCompressor(dict_data=held, compression_params=search).compress

        self.toxic, self.ordinary = make(model.toxic), make(model.ordinary)

    def features(self, text: str) -> tuple[float, ...]:
        toxic, ordinary = self.toxic, self.ordinary
        saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float64)
        saved.sort()
        shares = [(saved >= least).mean() for least in SAVED]
        evidence = [share * math.sqrt(len(saved)) for share in shares]  # a share in many windows is less likely chance
        return saved.mean(), saved[-1], saved[-3:].mean(), *shares, *evidence, math.log(len(saved))


def logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``x`` is the constant, ``rows`` the rows' weights."""
    weights, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (rows * (p - y)) + penalty @ weights
        change = np.linalg.solve((x * (rows * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        weights -= change
        if np.abs(change).max() < 1e-8:
            break
    return weights


def fit(texts: list[str], labels: list[int], sizes: dict[int, int]) -> Model:
    """The model of a sample of labelled texts; ``sizes`` has the number of labels of each class it was drawn from."""
    pairs = sorted(set(zip(texts, labels, strict=True)))
    toxic = without_near_copies([t for t, y in pairs if y])
    ordinary = without_near_copies([t for t, y in pairs if not y])
    nothing = np.zeros(0)
    if not toxic or not ordinary:
        share = len(toxic) / max(1, len(toxic) + len(ordinary))
        return Model(b"", b"", nothing, nothing, nothing, share)
    # The calibration sees differences made with dictionaries from the other half of the texts.
    x, y = [], []
    for half in (0, 1):
        compressors = Compressors(dictionaries(toxic[half::2] or toxic, ordinary[half::2] or ordinary))
        for label, group in ((1, toxic), (0, ordinary)):
            for text in group[1 - half :: 2] or group:
                x.append(compressors.features(text))
                y.append(float(label))
    x, model = np.array(x), dictionaries(toxic, ordinary)
    model.mean, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    y = np.array(y)
    rows = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    rows *= len(y) / rows.sum()
    model.weights = logistic(np.column_stack(((x - model.mean) / model.scale, np.ones(len(x)))), y, rows)
    return model


def dictionaries(toxic: list[str], ordinary: list[str]) -> Model:
    """A model with both dictionaries, not calibrated yet."""
    parts = typical(toxic, ordinary)
    shared, nothing = shared_content(ordinary, parts), np.zeros(0)
    return Model(b"".join(parts) + shared, shared, nothing, nothing, nothing)


def probabilities(model: Model, compressors: Compressors | None, texts: list[str]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    x = np.array([compressors.features(t) for t in texts]).reshape(len(texts), -1)
    z = ((x - model.mean) / model.scale) @ model.weights[:-1] + model.weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold.

    An id counts once, with the text of the smallest hash where rows repeat it, so the sample is bounded by
    ``SAMPLE`` ids of at most ``LONGEST`` characters, however many rows carry one id.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(0.0)
    for label, most in SAMPLE.items():
        share = F.when(F.col("toxic") == label, min(1.0, most / max(1, sizes.get(label, 0)))).otherwise(share)
    chosen = known.filter(place < share).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sum(SAMPLE.values()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.filter(F.length("text") <= LONGEST).join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic"))
    sample = once.select("text", "toxic").dropDuplicates(["text"]).collect()  # bounded by SAMPLE and LONGEST
    return fit([row.text for row in sample], [row.toxic for row in sample], sizes)


def scorer(model: Model):
    """A column function text -> probability; each task makes the two compressors once."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = Compressors(model) if model.constant is None else None
        for texts in batches:
            yield pd.Series(probabilities(model, compressors, texts.tolist()))

    return of


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = id_text(docs).select("doc_id", scorer(model)("text").alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not call toxic, with all their columns."""
    return docs.filter(scorer(model)(F.coalesce("text", F.lit(""))) < threshold)
