"""Benchmark decontamination by latent semantic retrieval.

1. Texts become sequences of term numbers (16-bit hashes of lower-cased words without surrounding
   punctuation), written once to the shared folder.
2. Document frequencies over all documents and benchmark items give the TF-IDF weights; terms in more
   than ``MOST_COMMON`` of the documents, or in one text only, have weight zero, except the rarer half of
   each item's terms, so that every item can be found.
3. Passages are windows of ``WINDOW`` words, one every half window, over whole texts. A randomised SVD of
   the passage-term matrix A (rows scaled to length one) gives the latent space: each task adds up its
   part of A'AW for a fixed random W, the parts are summed by term in one aggregation, and the driver
   orthonormalises the terms x rank matrix (its size does not depend on the corpus) and takes the
   singular values from the one-pass formula.
4. Every passage that has enough words of an item is projected and compared by cosine with every segment of
   every benchmark item, in blocks. Pairs above ``COSINE`` lead to the passages from which the item's words may
   be in reach: a bound that verification implies (``fewest``, ``least_of_passage``, and the longest common
   subsequence of the term numbers), so it leaves out no pair that would pass.
5. Candidates are verified on the words themselves: the longest common subsequence of the item and the
   stretch of text around the passage must cover ``COVERED`` of the item, or ``PARAPHRASED`` of it if the
   item's answer (its last ``ANSWER`` words, or share of them) is there as well.

Whether a text leaks does not depend on its row, so candidates are merged and verified once per distinct text
(128 bits of hash) and the verdicts are joined to the rows: thousands of copies cost a join, not thousands of
verifications. A benchmark of more than ``MOST_ITEMS`` distinct texts is compared in several rounds.

Items shorter than ``least_words`` words (a parameter, ``LEAST_WORDS`` by default) would be found in any text as
common phrases. They match exactly: texts whose words, as normalised, are the item's words and no others.

Defined results: null and empty texts and items match nothing; repeated rows each match; where an item's text
repeats, each of its item_ids is answered, a null one as null; a null doc_id is kept; a match of a short item has
start 0 and cosine, covered and answered 1; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.byte_bpe import batches_of
from roomledger.llm.common import frame as rows_frame
from roomledger.llm.common import id_text, worker_cache
from roomledger.session import stage

TERMS = 1 << 16  # term 0 stands for tokens without letters or digits and has no weight
RANK = 48
WINDOW = 16
HALF = WINDOW // 2
MOST_COMMON = 0.02
COSINE = 0.4
COVERED, PARAPHRASED = 0.8, 0.65
ANSWER, ANSWER_COVERED = 0.25, 0.75
LEAST_WORDS = 8
SEED = 42
SLICE = 8_000_000  # characters of texts tokenised at once
BLOCK = 1_000_000  # cosines computed at once
MOST_KEYS = 2_000_000  # of 16 bytes, broadcast at most
MOST_ITEMS = 50_000  # benchmark texts that are sent to every task at once
CHUNK = 8_000  # words projected at once; their rows fit into a processor's cache
MASK_WORDS = 64  # item words in one number's bits
MASKS = 2_000_000  # such numbers in one table
STRIP = ".,;:!?\"'()[]{}<>*_#|"


def normal(token: str) -> str:
    return token.lower().strip(STRIP)


def term(token: str) -> int:
    word = normal(token)
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % (TERMS - 1) + 1 if word else 0


def terms_of(text: str) -> np.ndarray:
    tokens = text.split()
    return np.fromiter(map(term, tokens), dtype=np.uint16, count=len(tokens))


def terms_of_texts(texts: pd.Series) -> list[np.ndarray]:
    """``terms_of`` each text; the distinct tokens of all of them are worked out once."""
    split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))  # at the white space of str.split
    coded = pc.dictionary_encode(split.flatten())
    tokens, place = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
    words = [word.strip(STRIP) for word in " ".join(tokens).lower().split(" ")]
    digest = xxhash.xxh64_intdigest
    known = np.array([digest(word.encode()) % (TERMS - 1) + 1 if word else 0 for word in words], dtype=np.uint16)
    real = (tokens != "")[place]  # white space at an end leaves an empty token
    bounds = np.concatenate(([0], np.cumsum(real)))[split.offsets.to_numpy()].tolist()
    flat = known[place[real]]
    return [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def text_keys() -> dict:
    """128 bits of a row's text."""
    return {"key1": F.xxhash64("text"), "key2": F.xxhash64(F.lit(1), "text")}


def tokenised(docs: DataFrame, least_words: int) -> DataFrame:
    """key1, key2, the text's terms, and its words if there are fewer than ``least_words``; staged, one row per row."""
    rows = id_text(docs).withColumns(text_keys()).select("key1", "key2", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache(("decontaminate",), dict)  # nothing is kept, but another operator's caches go
        for whole in frames:
            for part in batches_of(whole["text"], SLICE):
                frame = whole.iloc[part]
                terms = terms_of_texts(frame["text"])
                few = [short(t, least_words) if np.count_nonzero(n) < least_words else None for t, n in zip(frame["text"], terms, strict=True)]
                data = [n.tobytes() for n in terms]
                yield pd.DataFrame({"key1": frame["key1"].to_numpy(), "key2": frame["key2"].to_numpy(), "terms": data, "words": few})

    return stage(rows.mapInPandas(run, "key1 long, key2 long, terms binary, words string"), "terms")


def short(text: str, least_words: int) -> str | None:
    """The words of a text that has some, but fewer than ``least_words``."""
    words = []
    for token in text.split():
        if word := normal(token):
            words.append(word)
            if len(words) >= least_words:
                return None
    return " ".join(words) or None


def frequencies(tokens: DataFrame) -> np.ndarray:
    """Number of documents that have each term; position 0 holds the number of documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, documents = np.zeros(TERMS, dtype=np.int64), 0
        for frame in batches(frames):
            texts = [np.frombuffer(t, dtype=np.uint16) for t in frame["terms"]]
            flat = np.concatenate(texts)
            owner = np.repeat(np.arange(len(texts), dtype=np.uint32 if len(texts) <= 1 << 16 else np.uint64), [len(t) for t in texts])
            pairs = np.sort(owner * owner.dtype.type(TERMS) + flat)  # (text, term)
            once = np.concatenate(([True], pairs[1:] != pairs[:-1]))[: len(pairs)]
            counts += np.bincount((pairs[once] % TERMS).astype(np.int64), minlength=TERMS)
            documents += len(frame)
        counts[0] = documents
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"term": some.astype(np.int32), "n": counts[some]})

    rows = tokens.select("terms").mapInPandas(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(TERMS, dtype=np.int64)
    for row in rows.collect():  # at most one row per term number
        out[row.term] = row.n
    return out


class Passages:
    """The passages of a batch of texts, as sums over half-window blocks of their words."""

    def __init__(self, texts: list[np.ndarray], weights: np.ndarray):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.flat = np.concatenate([*texts, np.zeros(1, dtype=np.uint16)])  # and a word without weight at the end
        self.weights = weights
        starts = np.cumsum(sizes) - sizes
        blocks = -(-sizes // HALF)
        self.text = np.repeat(np.arange(len(texts)), blocks)
        self.number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        self.start = starts[self.text] + self.number * HALF  # a block's first word, and that of the passage it begins
        self.first, self.end = starts[self.text], (starts + sizes)[self.text]  # the text's first word, and that after its last
        self.goes_on = self.start + HALF < self.end  # there is a next block of the same text
        self.at = self.start[:, None] + np.arange(HALF)
        self.at[self.at >= self.end[:, None]] = len(self.flat) - 1
        terms = self.flat[self.at]
        self.terms = np.where(weights[terms] > 0, terms, 0)  # term 0 stands for all without a weight

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Per passage: the sum of its words' rows, which have their weights in them."""
        out = np.zeros((len(self.start), rows.shape[1]), dtype=np.float32)
        for a in range(0, len(out), CHUNK // HALF):
            out[a : a + CHUNK // HALF] = added(rows, self.terms[a : a + CHUNK // HALF])
        return self.paired(out)

    def paired(self, blocks: np.ndarray) -> np.ndarray:
        """Each block plus the next one of its text."""
        out = blocks.copy()
        out[:-1] += blocks[1:] * self.goes_on[:-1].reshape(-1, *[1] * (blocks.ndim - 1))
        return out

    def lengths(self) -> np.ndarray:
        return np.sqrt(self.paired((self.weights[self.terms].astype(np.float64) ** 2).sum(axis=1)))

    def add_back(self, values: np.ndarray, out: np.ndarray) -> None:
        """out += A' values, for one value row per passage, without the words' weights."""
        own = values.copy()  # a block's words are in the passage it begins and in the one before
        own[1:] += values[:-1] * self.goes_on[:-1, None]
        terms = self.terms.ravel()
        order = np.argsort(terms, kind="stable")
        order = order[np.searchsorted(terms, 1, sorter=order) :]
        for a in range(0, len(order), CHUNK):
            at = order[a : a + CHUNK]
            found = terms[at]
            first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            out[found[first]] += np.add.reduceat(np.take(own, at // HALF, axis=0), first, axis=0)


def added(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The sum of the rows at each line of ``places``."""
    out = np.take(rows, places[:, 0], axis=0)
    for place in range(1, places.shape[1]):
        out += np.take(rows, places[:, place], axis=0)
    return out


def batches(frames: Iterator[pd.DataFrame], words: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Slices of a million words, or one text."""
    for frame in frames:
        ends = frame["terms"].str.len().to_numpy().cumsum() // 2
        start = 0
        while start < len(frame):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + words, side="right")))
            yield frame.iloc[start:stop]
            start = stop


@dataclass
class Space:
    """The latent space: weights per term, orthonormal term vectors, singular values."""

    weights: np.ndarray
    vectors: np.ndarray
    singular: np.ndarray


def latent_space(tokens: DataFrame, items: list[np.ndarray]) -> Space:
    counts = frequencies(tokens)
    documents = int(counts[0]) + len(items)
    for item in items:
        counts[np.unique(item)] += 1
    known = (counts >= 2) & (counts <= max(2.0, MOST_COMMON * documents))
    for item in items:  # an item of common words only keeps the rarer half of them
        own = np.unique(item)
        known[own[np.argsort(counts[own], kind="stable")][: max(8, len(own) // 2)]] = True
    known[0] = False
    weights = np.where(known, np.log((documents + 1) / (counts + 1)), 0).astype(np.float32)
    generator, random = np.random.default_rng(SEED), np.empty((TERMS, RANK), dtype=np.float32)
    for a in range(0, TERMS, CHUNK):  # the driver holds the terms x rank matrices once; what it works out goes in parts
        random[a : a + CHUNK] = generator.normal(size=random[a : a + CHUNK].shape)

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros((TERMS, RANK), dtype=np.float32), random * weights[:, None]
        for frame in batches(frames):
            found = Passages([np.frombuffer(t, dtype=np.uint16) for t in frame["terms"]], weights)
            if found.terms.any():
                scale = np.maximum(found.lengths(), 1e-6)[:, None] ** 2  # rows of A have length one on both sides
                found.add_back((found.sums(rows) / scale).astype(np.float32), total)
        total *= weights[:, None]
        some = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[some], columns=names).assign(term=some.astype(np.int32))

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:  # the driver gets a row's numbers as bytes, not as objects
            yield pd.DataFrame({"term": frame["term"], "data": [r.tobytes() for r in frame[names].to_numpy(dtype=np.float64)]})

    names = [f"c{i}" for i in range(RANK)]
    schema = ", ".join([*(f"{c} float" for c in names), "term int"])
    summed = tokens.select("terms").mapInPandas(sketch, schema).groupBy("term").agg(*(F.sum(c).alias(c) for c in names))
    product = np.zeros((TERMS, RANK))
    for term, data in summed.mapInPandas(packed, "term int, data binary").collect():  # at most TERMS rows
        product[term] = np.frombuffer(data)
    basis = orthonormal(product)
    # One-pass eigenvalues of A'A on the basis: basis' (A'A) basis (basis' W) = basis' product.
    sketched, seen = np.zeros((RANK, RANK)), np.zeros((RANK, RANK))
    for a in range(0, TERMS, CHUNK):
        sketched += basis[a : a + CHUNK].T @ random[a : a + CHUNK]
        seen += basis[a : a + CHUNK].T @ product[a : a + CHUNK]
    inner = np.linalg.lstsq(sketched.T, seen.T, rcond=None)[0].T
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    vectors = np.empty((TERMS, RANK), dtype=np.float32)
    for a in range(0, TERMS, CHUNK):
        vectors[a : a + CHUNK] = basis[a : a + CHUNK] @ turn[:, ::-1]
    return Space(weights, vectors, np.sqrt(np.maximum(values[::-1], 0)))


def orthonormal(matrix: np.ndarray) -> np.ndarray:
    """The matrix's Q of QR, in parts of its rows: only their triangles are put together."""
    out, triangles = np.empty_like(matrix), []
    for a in range(0, len(matrix), CHUNK):
        q, r = np.linalg.qr(matrix[a : a + CHUNK])
        out[a : a + CHUNK, : q.shape[1]] = q
        triangles.append(r)
    turn, _ = np.linalg.qr(np.concatenate(triangles))
    first = 0
    for n, a in enumerate(range(0, len(matrix), CHUNK)):
        rows = len(triangles[n])
        out[a : a + CHUNK] = out[a : a + CHUNK, :rows] @ turn[first : first + rows]
        first += rows
    return out


@dataclass
class Items:
    """Distinct benchmark texts: their words, terms, and the unit vectors of the segments with their items."""

    words: list[list[str]]
    terms: list[np.ndarray]

    def segments(self, space: Space) -> tuple[np.ndarray, np.ndarray]:
        owner, vectors = [], []
        for i, terms in enumerate(self.terms):
            starts = {*range(0, max(1, len(terms) - HALF), HALF), max(0, len(terms) - WINDOW)}
            for a in sorted(starts):
                part = terms[a : a + WINDOW]
                vector = (space.vectors[part] * space.weights[part, None]).sum(axis=0)
                if np.linalg.norm(vector) > 1e-6:
                    owner.append(i)
                    vectors.append(vector / np.linalg.norm(vector))
        return np.array(owner, dtype=np.int64), np.array(vectors, dtype=np.float32).reshape(-1, RANK)


def load_items(texts: list[str]) -> Items:
    """Distinct texts of the stated benchmark (it is the query set, sent to every task)."""
    split = [[w for w in map(normal, text.split()) if w] for text in texts]
    return Items(split, [terms_of(" ".join(w)) for w in split])


def fewest(length: int) -> int:
    """The least common subsequence with which ``verify`` accepts an item of ``length`` words."""
    return math.ceil(min(COVERED, PARAPHRASED) * length - 1e-9)


def reach(length: int) -> int:
    """Half windows on each side of a passage that hold the stretch it is verified on."""
    return -(-length // HALF)


def least_of_passage(length: int) -> int:
    """Item words in the richest of the ``reach + 1`` whole windows that a verified stretch is made of."""
    return -(-fewest(length) // (reach(length) + 1))


class Reach:
    """Upper bounds of the common subsequences of items and stretches of a batch, on numbers of the items' terms.

    An item's words are the bits of numbers, ``MASK_WORDS`` in each; what the parts of a longer item have in common
    with a stretch adds up to a bound of the whole.
    """

    def __init__(self, items: list[np.ndarray], known: int):
        self.items, self.known = items, known
        self.parts = np.array([-(-len(terms) // MASK_WORDS) for terms in items], dtype=np.int64)
        self.at_once = max(1, MASKS // ((known + 1) * int(self.parts.max(initial=1))))  # items in one table

    def table(self, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the items of a group: where each one's parts begin, the parts' lengths, and their masks by word number."""
        own = self.items[group * self.at_once : (group + 1) * self.at_once]
        parts = [terms[a : a + MASK_WORDS] for terms in own for a in range(0, len(terms), MASK_WORDS)]
        masks = np.zeros((len(parts), self.known + 1), dtype=np.uint64)
        for part, terms in enumerate(parts):
            for bit, word in enumerate(terms.tolist()):
                masks[part, word] |= np.uint64(1 << bit)
        masks[:, 0] = 0
        first = np.cumsum([0, *(-(-len(terms) // MASK_WORDS) for terms in own)])
        return first, np.array([len(p) for p in parts], dtype=np.int64), masks.ravel()

    def most(self, words: np.ndarray, item: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """For each item number and stretch of ``words``: a bound of the words in common. The last word is in no item."""
        out = np.zeros(len(item), dtype=np.int64)
        order = np.lexsort((stop - start, item // self.at_once))
        for at in np.split(order, np.flatnonzero(np.diff(item[order] // self.at_once)) + 1):
            if len(at):
                group = int(item[at[0]]) // self.at_once
                first, sizes, masks = self.table(group)
                local = item[at] - group * self.at_once
                parts = self.parts[item[at]]
                row = np.repeat(np.arange(len(at)), parts)
                part = first[local][row] + np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                for a in range(0, len(row), CHUNK):
                    own, of = at[row[a : a + CHUNK]], part[a : a + CHUNK]
                    kept = self.uncovered(words, masks, of * (self.known + 1), start[own], stop[own])
                    bits = np.uint64(MASK_WORDS) - sizes[of].astype(np.uint64)  # an item's last bits are the number's lowest
                    np.add.at(out, own, sizes[of] - np.bitwise_count(kept << bits).astype(np.int64))
        return out

    @staticmethod
    def uncovered(words: np.ndarray, masks: np.ndarray, of: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """``common_subsequence`` for many pairs at once: the bits left after all words of the stretches."""
        left = np.full(len(of), ~np.uint64(0))
        for step in range(int((stop - start).max(initial=0))):
            at = start + step
            match = left & masks[of + words[np.where(at < stop, at, len(words) - 1)]]
            left = (left + match) | (left - match)
        return left


def first_of(keys: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """The place of each key's first entry in the order of ``by``."""
    order = np.lexsort((*by[::-1], keys))
    return order[np.concatenate(([True], np.diff(keys[order]) != 0))[: len(order)]]


def candidates(tokens: DataFrame, space: Space, items: Items) -> DataFrame:
    """key1, key2, item (its place in ``items``), start (first word of the passage), cosine."""
    owner, vectors = items.segments(space)
    known = np.unique(np.concatenate([terms[terms > 0] for terms in items.terms]))
    number = np.zeros(TERMS, dtype=np.uint16)  # 0: in no item
    number[known] = np.arange(1, len(known) + 1)
    numbered = [number[terms] for terms in items.terms]
    holds = np.zeros((len(known) + 1, len(items.words)), dtype=np.uint8)
    for i, terms in enumerate(numbered):
        holds[terms[terms > 0], i] = 1
    sizes = np.array([len(terms) for terms in items.terms], dtype=np.int64)
    least = np.array([least_of_passage(n) for n in sizes])
    least_there, steps = np.array([fewest(n) for n in sizes]), np.array([reach(n) for n in sizes])
    least_there -= np.array([int((terms == 0).sum()) for terms in items.terms])
    block = max(1, BLOCK // max(1, len(owner)))

    def near_pairs(found: Passages, words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, cosine) of the passages near a segment of an item and with enough words of it."""
        out = [(np.zeros(0, dtype=np.int64), owner[:0], vectors[:0, 0])]
        there = words[found.at]
        # A passage with too few words of all items together has too few of each.
        likely = found.paired((there > 0).sum(axis=1)) >= least.min()
        for a in range(0, len(there), block):
            stop = min(a + block, len(there))
            own = np.flatnonzero(likely[a:stop]) + a
            if not len(own):
                continue
            after = np.minimum(own + 1, len(there) - 1)
            goes_on = found.goes_on[own]
            held = added(holds, there[own])
            held += added(holds, there[after]) * goes_on[:, None]
            enough = held >= least
            some = enough.any(axis=1)
            own, after, goes_on, enough = own[some], after[some], goes_on[some], enough[some]
            latent = added(rows, found.terms[own])
            latent += added(rows, found.terms[after]) * goes_on[:, None]
            size = np.sqrt((latent * latent).sum(axis=1))
            some = size > 1e-6
            near = ((latent[some] / size[some, None]) @ vectors.T).ravel()
            hit = np.flatnonzero(near >= COSINE)
            row, segment = np.divmod(hit, max(1, len(owner)))
            both = enough[some][row, owner[segment]]
            out.append((own[some][row[both]], owner[segment[both]], near[hit[both]]))
        passage, item, cosine = (np.concatenate(x) for x in zip(*out, strict=True))
        best = first_of(item * len(there) + passage, -cosine)
        return passage[best], item[best], cosine[best]

    def in_reach(bounds: Reach, found: Passages, words: np.ndarray, passage: np.ndarray, item: np.ndarray, cosine: np.ndarray):
        """(passage, item, cosine) of the passages around these whose stretch may hold enough of the item."""

        def enough(passage: np.ndarray, item: np.ndarray, around: np.ndarray) -> np.ndarray:
            start = np.maximum(found.start[passage] - around, found.first[passage])
            stop = np.minimum(found.start[passage] + WINDOW + around, found.end[passage])
            return bounds.most(words, item, start, stop) >= least_there[item]

        some = enough(passage, item, steps[item] * HALF + sizes[item])  # all stretches together
        passage, item, cosine = passage[some], item[some], cosine[some]
        shifts = 2 * steps[item] + 1
        row = np.repeat(np.arange(len(item)), shifts)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(shifts) - shifts, shifts) - steps[item][row]
        at = passage[row] + shift
        some = (at >= 0) & (at < len(found.text))
        some[some] = found.text[at[some]] == found.text[passage[row[some]]]
        row, shift, at = row[some], shift[some], at[some]
        best = first_of(item[row] * len(found.text) + at, np.abs(shift), -cosine[row])  # the nearest passage that led there
        row, at = row[best], at[best]
        some = enough(at, item[row], sizes[item[row]])
        return at[some], item[row[some]], cosine[row[some]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds, rows = Reach(numbered, len(known)), space.vectors * space.weights[:, None]
        for frame in batches(frames):
            found = Passages([np.frombuffer(t, dtype=np.uint16) for t in frame["terms"]], space.weights)
            words = number[found.flat]
            pairs = near_pairs(found, words, rows)
            at, item, cosine = in_reach(bounds, found, words, *pairs)
            if len(at):
                own = frame.iloc[found.text[at]]
                yield pd.DataFrame(
                    {
                        "key1": own["key1"].to_numpy(),
                        "key2": own["key2"].to_numpy(),
                        "item": item.astype(np.int32),
                        "start": (found.number[at] * HALF).astype(np.int32),
                        "cosine": cosine.astype(np.float64),
                    }
                )

    return tokens.mapInPandas(run, "key1 long, key2 long, item int, start int, cosine double")


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one number."""
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        match = row & places.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def verify(item: list[str], stretch: list[str]) -> tuple[float, float, bool]:
    """(share of the item covered, share of its answer covered, whether that is a leak)."""
    covered = common_subsequence(item, stretch) / len(item)
    answer = item[-max(3, math.ceil(ANSWER * len(item))) :]
    answered = common_subsequence(answer, stretch) / len(answer)
    return covered, answered, covered >= COVERED or (covered >= PARAPHRASED and answered >= ANSWER_COVERED)


def leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, item_id, start (word), cosine, covered, answered: the benchmark items found in each document."""
    found = text_leaks(docs, benchmark, least_words)
    rows = id_text(docs, spread=False).withColumns(text_keys()).select("key1", "key2", "doc_id")
    # As many leaking texts as there are, not rows: the copies of one are joined where they lie.
    found = F.broadcast(found) if found.count() <= MOST_KEYS else found
    return rows.join(found, ["key1", "key2"]).drop("key1", "key2").select("doc_id", *[c for c in found.columns if c not in ("key1", "key2")])


def text_leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The leaks of every distinct text, under its 128-bit key; staged."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    texts = distinct_texts(items, least_words)
    tokens = tokenised(docs, least_words)
    verdicts = same_words(tokens, texts)
    long_texts = texts.where(~F.col("few"))
    rounds = -(-long_texts.count() // MOST_ITEMS)
    for n in range(rounds):
        part = long_texts.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == n)
        # At most about MOST_ITEMS texts: the query set of this round.
        verdicts = verdicts.unionByName(found_in(docs, tokens, sorted(r.item for r in part.select("item").collect())))
    ids = items.select(F.col("text").alias("item"), "item_id").distinct()
    answered = stage(verdicts, "verdicts").join(ids, "item")
    return stage(answered.select("key1", "key2", "item_id", "start", "cosine", "covered", "answered"), "leaks")


def distinct_texts(items: DataFrame, least_words: int) -> DataFrame:
    """(item, words, few): each distinct benchmark text with words; staged."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [[w for w in map(normal, text.split()) if w] for text in frame["text"]]
            out = pd.DataFrame({"item": frame["text"], "words": [" ".join(w) for w in words], "few": [len(w) < least_words for w in words]})
            yield out[[bool(w) for w in words]]

    return stage(items.select("text").distinct().mapInPandas(run, "item string, words string, few boolean"), "benchmark-texts")


def same_words(tokens: DataFrame, texts: DataFrame) -> DataFrame:
    """Short items: the texts whose words are the item's."""
    few = texts.where("few").select("item", "words")
    there = tokens.where(F.col("words").isNotNull()).select("key1", "key2", "words").distinct().join(few, "words")
    one = F.lit(1.0)
    return there.select("key1", "key2", "item", F.lit(0).cast("long").alias("start"), one.alias("cosine"), one.alias("covered"), one.alias("answered"))


def found_in(docs: DataFrame, tokens: DataFrame, texts: list[str]) -> DataFrame:
    """Long items: candidates by latent retrieval, verified once for each distinct text."""
    items = load_items(texts)
    space = latent_space(tokens, items.terms)
    once = candidates(tokens.select("key1", "key2", "terms"), space, items).groupBy("key1", "key2", "item", "start").agg(F.max("cosine").alias("cosine"))
    places = F.collect_list(F.struct("item", "start", "cosine")).alias("found")
    by_text = stage(once.groupBy("key1", "key2").agg(places), "candidates")
    rows = id_text(docs, spread=False).withColumns(text_keys()).select("key1", "key2", "text")
    keys = by_text.select("key1", "key2")
    if keys.count() <= MOST_KEYS:  # else all texts are shuffled by their keys
        rows = rows.join(F.broadcast(keys), ["key1", "key2"], "left_semi")
    picked = rows.dropDuplicates(["key1", "key2"]).join(by_text, ["key1", "key2"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key1, key2, text, found in zip(frame["key1"].tolist(), frame["key2"].tolist(), frame["text"], frame["found"], strict=True):
                words = text.split()
                best: dict[int, tuple] = {}
                for place in found:
                    item = items.words[place["item"]]
                    first = max(0, place["start"] - len(item))
                    stretch = words[first : place["start"] + WINDOW + len(item)]
                    covered, answered, leak = verify(item, [w for w in map(normal, stretch) if w])
                    if leak:
                        row = (covered, place["cosine"], -place["start"], answered)
                        best[place["item"]] = max(best.get(place["item"], row), row)
                for i, (covered, cosine, start, answered) in sorted(best.items()):
                    out.append((key1, key2, texts[i], -start, cosine, covered, answered))
            yield rows_frame(out, VERDICTS)

    return picked.mapInPandas(run, VERDICTS)


VERDICTS = "key1 long, key2 long, item string, start long, cosine double, covered double, answered double"


def keep_clean(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    found = text_leaks(docs, benchmark, least_words).select(F.col("key1").alias("_key1"), F.col("key2").alias("_key2")).distinct()
    found = F.broadcast(found) if found.count() <= MOST_KEYS else found
    text = F.coalesce(docs["text"], F.lit(""))
    same = (F.xxhash64(text) == found["_key1"]) & (F.xxhash64(F.lit(1), text) == found["_key2"])
    return docs.join(found, same, "left_anti")
