"""Packing, conversation repair and tokenizer alignment on hard tables, against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from roomledger.llm import alignment, catalog, decontaminate, packing, repair, simhash, token_records, toxicity
from roomledger.llm.vocabularies import ByteLevel, WordEnds, byte_symbols
from roomledger.session import staging_path

PATTERN = public_tokenizers.PATTERN
RNG = random.Random(3)
WORDS = [f"{a}{b}" for a in ("river", "miller", "grain", "rain", "field") for b in ("", "s", "7", "é", "-x")]
HARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "same words here"), (4, "same words here"), (5, "same words here"), (6, "a" * 3000),
    (7, "日本語 é̂ 'll \x00\x01 mail"), (None, "no id at all"), (None, "no id at all"), (2**60 + 1, "a wide id"), (8, "<|endoftext|> in a text<|endoftext|>"),
    (9, " ".join(RNG.choice(WORDS) for _ in range(9000))), (10, "the mark ▁ itself"), (11, "<s>x</s><unk><0x41>"), (12, "two  spaces \r\n end "),
] + [(20 + n, " ".join(RNG.choice(WORDS) for _ in range(RNG.randint(1, 900)))) for n in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, wide ids, and extra columns whose names the operators use."""
    rows = [(i, t, 7, "x", 1, True) for i, t in HARD]
    columns = "doc_id long, text string, share long, ids string, task int, no_id boolean"
    return spark.createDataFrame(rows, columns).repartition(3)


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.BYTE_BPE_JSON)


def test_vocabulary_equals_the_library():
    """Every code point in several surroundings, and texts of every kind."""
    own, other = ByteLevel(catalog.BYTE_BPE_JSON, PATTERN), library()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c}{c} 1{c}1\n{c}\n ,{c}'{c}" for c in points[at : at + 500]) for at in range(0, len(points), 500)]
    texts += [t or "" for _, t in HARD] + [" " * 5000, "\n \t" * 900, "é" * 4000]
    for text, want in zip(texts, other.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text, special=True).tolist() == want.ids
    assert b"".join(own.bytes_of[i] for i in own.encode("naïve 日\x00", special=False)) == "naïve 日\x00".encode()


def test_word_end_vocabulary_equals_the_library():
    """Every code point that is not left to the library in several surroundings, and texts of every kind."""
    from tokenizers import Tokenizer

    own, other = WordEnds(catalog.WORD_BPE), Tokenizer.from_file(catalog.WORD_BPE)
    points = [c for c in map(chr, range(0x10000)) if not "\ud800" <= c <= "\udfff" and not own.odd(c)]
    assert len(points) > 55_000
    texts = ["".join(f"a{c}b {c}{c} 1{c}1\n{c}\n ,{c}'{c} e{c}\u0308 " for c in points[at : at + 50]) for at in range(0, len(points), 50)]
    rng = random.Random(6)
    mixed = [*map(chr, range(32, 127))] * 3 + [*map(chr, range(0xA0, 0x250)), *"ΣςİẞÅ日本가\u1100\u1161\u200b\u3000\x1c\x85\u2028😀𞤀"]
    texts += ["".join(rng.choice(mixed) for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    texts += [t or "" for _, t in HARD] + ["<|startoftext|>A<|ENDOFTEXT|> <|endoftext|>", "don't DON'T 'll x's", "ΟΔΥΣΣΕΥΣ Σ", " " * 3000, "ab" * 4000]
    for text, want in zip(texts, other.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text).tolist() == want.ids, text[:80]


def test_records_of_special_strings_wide_ids_and_many_files(spark, docs, monkeypatch):
    """The library without any switch; as many files as the bytes ask for; records found again by the index."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(catalog.WORD_BPE)
    monkeypatch.setattr(token_records, "FILE_BYTES", 3000)
    path = staging_path(spark, "records")
    assert token_records.file_count(docs) > 20
    token_records.write_records(docs, path, catalog.WORD_BPE)
    index = token_records.build_index(spark, path)
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in HARD)
    assert any(49407 in ids for (i, ids) in want if i == 8)
    assert Counter((r.doc_id, tuple(r.ids)) for r in token_records.read_records(spark, index, path).collect()) == want
    rows = index.orderBy("start").collect()
    assert [r.start for r in rows] == list(itertools.accumulate([0] + [r.n_tokens for r in rows[:-1]]))
    assert [r.doc_id or -1 for r in rows] == sorted(r.doc_id or -1 for r in rows)
    few = index.where("doc_id = 4")
    assert {r.doc_id for r in token_records.read_records(spark, few, path).collect()} == {4}


# --- decontamination ----------------------------------------------------------------------------------------


def test_copies_of_a_leak_are_verified_once(spark, monkeypatch):
    """Thousands of rows with one leaking text, whatever their ids; repeated, null and short items."""
    rng = random.Random(8)
    words = [f"{a}{n}" for a in ("oak", "tide", "lamp", "veil", "moss") for n in range(40)]
    item = " ".join(rng.sample(words, 24))
    leak = " ".join(rng.sample(words, 30)) + " " + item + " " + " ".join(rng.sample(words, 30))
    clean = [" ".join(rng.choice(words) + "q" for _ in range(60)) for _ in range(50)]
    rows = [(None, leak)] * 3000 + [(n, clean[n]) for n in range(50)] + [(90, "Blue  moon, rising!"), (91, "a blue moon rising"), (92, None), (93, "")]
    rows += [(94, leak + " end"), (95, "W" * 4000 + " x")]
    benchmark = [(1, item), (2, item), (None, item), (5, "blue moon rising"), (6, None), (7, ""), (8, "w" * 4000 + " X")]
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], "doc_id long, text string, cosine double, item int").repartition(4)
    items = spark.createDataFrame([(i, t, "x") for i, t in benchmark], "item_id long, text string, words string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect())
    want = Counter({(None, i): 3000 for i in (1, 2, None)}) + Counter({(94, i): 1 for i in (1, 2, None)} | {(90, 5): 1, (95, 8): 1})
    assert got == want
    kept = Counter((r.doc_id, r.text) for r in decontaminate.keep_clean(docs, items).collect())
    assert kept == Counter(row for row in rows if row[1] != leak and row[0] not in (90, 94, 95))
    monkeypatch.setattr(decontaminate, "MOST_KEYS", 0)
    monkeypatch.setattr(decontaminate, "MOST_ITEMS", 1)
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()) == want


def test_odd_distances_are_refused_and_even_ones_lose_no_link(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 1, 3)
    rng = np.random.default_rng(2)
    for distance in (0, 2, 4):
        base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
        fps = np.unique([b ^ np.uint64(sum(1 << int(i) for i in rng.choice(12, rng.integers(0, 5), replace=False))) for b in base for _ in range(12)])
        frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
        while not (np.linalg.matrix_power(near.astype(int), 2) > 0).tolist() == near.tolist():
            near = np.linalg.matrix_power(near.astype(int), 2) > 0
        want = {int(f): int(fps.view(np.int64)[near[n]].min()) for n, f in enumerate(fps.view(np.int64))}
        found = simhash.components(simhash.links(frame, len(fps), distance)).collect()
        roots = {int(f): int(f) for f in fps.view(np.int64)} | {r.node: r.root for r in found}
        assert roots == want


def test_a_repeated_labelled_id_counts_once_in_the_fit(spark, monkeypatch):
    """A third of all rows under one labelled id do not come to the driver."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, sizes: seen.append((texts, labels)))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"other {n}") for n in range(3000)] + [(None, "unnamed")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1)], "doc_id long, toxic int")
    for frame in (docs, docs.orderBy(F.rand(3)).repartition(7)):
        toxicity.train(frame, labels)
    (first, _), (second, _) = seen
    assert len(first) == len(ids) and sorted(first) == sorted(second)


# --- packing ------------------------------------------------------------------------------------------------


def check_packed(rows, texts, capacity=2048):
    other = library()
    want = Counter()
    for doc_id, text in texts:
        want[doc_id, tuple(other.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
    for (doc_id, ids), copies in want.items():
        data = np.array(ids, dtype="<u4")
        own = Counter((r.start, r.length, r.ids_crc32) for r in pieces[doc_id, len(ids)])
        assert set(own.values()) == {copies} or copies == 1
        at = 0
        for start, length, crc in sorted(own):
            assert start == at and crc == zlib.crc32(data[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
        total, padding = total + at, padding + (0 if at & (at - 1) == 0 else capacity - at)
    return padding / total if total else 0


def test_packing(docs):
    rows = packing.pack(docs, catalog.BYTE_BPE_JSON, PATTERN).collect()
    assert check_packed(rows, HARD) < 0.1  # one short sequence at the end among twenty
    assert packing.pack(docs.where("false"), catalog.BYTE_BPE_JSON, PATTERN).count() == 0


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_packing_with_other_capacities(docs, capacity):
    rows = packing.pack(docs.where("length(text) < 2000 or text is null"), catalog.BYTE_BPE_JSON, PATTERN, capacity=capacity).collect()
    check_packed(rows, [(i, t) for i, t in HARD if len(t or "") < 2000], capacity)


def test_sequences_hold_the_tokens(docs):
    pieces = packing.pack(docs, catalog.BYTE_BPE_JSON, PATTERN, with_ids=True)
    held = Counter(i for r in pieces.collect() for i in r.ids)
    made = packing.sequences(pieces, pad_id=-1).collect()
    assert Counter(i for r in made for i in r.ids if i != -1) == held
    assert all(len(r.ids) == 2048 or r.n_tokens & (r.n_tokens - 1) == 0 for r in made)


def test_cuts():
    for capacity in (1, 2, 64, 2048):
        for n in range(capacity):
            parts = packing.cuts(n, capacity)
            assert sum(length for length, _ in parts) == n
            assert all(length <= share and share - length <= max(packing.SLACK * share, 0) for length, share in parts)
            assert all(capacity // share * length <= capacity for length, share in parts)


# --- repair -------------------------------------------------------------------------------------------------


def plain_repair(turns):
    """The cheapest and then least of all edit strings, tried one by one."""
    seen, kinds, illegal = set(), [], 0
    for n, (role, text) in enumerate(turns):
        stripped = text.strip(" \t\n\v\f\r")
        kinds.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
        illegal += n > 0 and turns[n - 1][0][:1] + role[:1] not in ("su", "ua", "au")

    def ways(n, cost, edits, out):
        for inserts in range(3):
            for roles in itertools.product(("user", "assistant"), repeat=inserts):
                own = out + [(role, "") for role in roles]
                letters = "".join(role[:1] or "?" for role, _ in own)
                if not re.fullmatch("s?(ua)*u?", letters):
                    continue
                now, so_far = cost + 5 * inserts, edits + "I" * inserts
                if n == len(turns):
                    if re.fullmatch("(s?(ua)+)?", letters):
                        yield now, so_far, own
                    continue
                role, text = turns[n]
                yield from ways(n + 1, now + 2, so_far + "D", own)
                if kinds[n] not in ("blank", "duplicate"):
                    stays = now + (5 if kinds[n] == "truncated" else 0)
                    yield from ways(n + 1, stays, so_far + "K", own + [(role, text)])
                    for other in ("user", "assistant"):
                        yield from ways(n + 1, stays + 1, so_far + "R", own + [(other, text)])

    cost, edits, out = min(ways(0, 0, "", []), key=lambda way: way[:2])
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
    return (*(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, edits, digest)


def conversations(count: int, seed: int):
    rng = random.Random(seed)
    roles = ("user", "assistant", "system", "user", "assistant", " ", "tool", "")
    return {n: [(rng.choice(roles), rng.choice(("a.", "b?", "c", "a.", " ", "d!\n", "e. ,"))) for _ in range(rng.randint(1, 4))] for n in range(count)}


def test_repair_takes_the_cheapest_and_least_edits(spark):
    data = conversations(150, 5)
    rows = [(n, place, role, text, 1, "x") for n, turns in data.items() for place, (role, text) in enumerate(turns)]
    RNG.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, lost_rows int, repeated string").repartition(4)
    got = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in repair.audit(frame).collect()}
    assert got == {n: plain_repair(turns) for n, turns in data.items()}
    # The repaired turns are those that the digest is of.
    turns = defaultdict(list)
    for r in repair.repair(frame).orderBy("conv_id", "place").collect():
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(turns[n]).encode()).hexdigest() == digest[-1] for n, digest in got.items())


def test_repair_of_odd_rows(spark):
    rows = [
        (1, None, "user", "b."), (1, 5, "user", "a."), (1, 9, "assistant", None), (None, 2, None, None), (None, 2, "user", "q?"),
        (None, 3, "assistant", "w."), (2**60 + 1, 4, "system", "s."), (2, 1, "user", "x."), (2, 1, "user", "x."), (2, 2, "assistant", "y."),
    ]
    frame = spark.createDataFrame([(*r, False) for r in rows] + [(3, 1, "user", "gone", True)], "conv_id long, turn long, role string, text string, lost boolean")
    got = {r.conv_id: r for r in repair.audit(frame).collect()}
    assert set(got) == {1, 2, 3, None, 2**60 + 1}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[3])[1:9] == (0, 0, 0, 0, 0, 0, "", empty)
    assert (got[1].gaps, got[1].blank) == (3, 1)  # turns 5 and 9; the null turn counts for nothing
    assert (got[2].duplicate, got[2].audit, got[2].gaps) == (1, "KDK", 0)
    assert (got[None].blank, got[None].audit) == (1, "DKK")
    assert (got[2**60 + 1].cost, got[2**60 + 1].audit, got[2**60 + 1].repaired_sha256) == (2, "D", empty)
    assert repair.audit(frame.where("false")).count() == repair.repair(frame.where("false")).count() == 0


def test_long_conversations_go_through_files():
    """A state that does not grow, blocks of backpointers, and texts beyond the memory bound."""
    rng = random.Random(1)
    turns = [(rng.choice(("user", "assistant", "user", "assistant", "system")), f"t{n}{rng.choice('.x!')}") for n in range(150_000)]
    programme, audits = repair.Programme(), []
    for spool in (1000, 1 << 30):
        held = repair.Conversation(1, programme, spool)
        for n, (role, text) in enumerate(turns):
            held.add(n, role, text, False)
        audits.append(held.audit())
        held.close()
    assert audits[0] == audits[1] and len(programme.steps) < 1000
    cost, costs = audits[0][6], {"D": 2, "I": 5, "R": 1, "K": 0}
    place = kept_cut = 0
    for edit in audits[0][7]:
        if edit != "I":
            kept_cut += edit != "D" and turns[place][1][-1] == "x"
            place += 1
    assert cost == sum(costs[edit] for edit in audits[0][7]) + 5 * kept_cut and place == len(turns)


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "system" if t == 0 else "assistant", f"Hm. {c}? {t}!") for c in range(40) for t in range(6)] + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = Counter()
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fault <= 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want[c, t, "user" if fault == 4 else role, text, fault == 0] += 2 if fault == 3 else 1
    assert Counter(tuple(r) for r in repair.damage(frame).collect()) == want


# --- alignment ----------------------------------------------------------------------------------------------


def plain_alignment(texts):
    import sentencepiece

    a_side, b_side, symbols = library(), sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_BPE), byte_symbols()
    a_side.encode_special_tokens = True
    docs, counts = [], Counter()
    for doc_id, text in texts:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_side.encode(text or "")
        a_bytes = [bytes(symbols[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(b_side.id_to_piece(i)[3:-1], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b
        ]
        if not text or {b"".join(a_bytes), b"".join(b_bytes)} != {(" " + text).encode()}:
            docs.append((doc_id, None))
            continue
        a_end, b_end = (list(itertools.accumulate(map(len, side))) for side in (a_bytes, b_bytes))
        b_at = {e: n for n, e in enumerate(b_end)}
        links = [(a[n], b[b_at[e]]) for n, e in enumerate(a_end) if e in b_at]
        groups, low_a, low_b = [], 0, 0
        for n, e in enumerate(a_end):
            if e in b_at:
                groups.append(",".join(map(str, a[low_a : n + 1])) + "|" + ",".join(map(str, b[low_b : b_at[e] + 1])))
                low_a, low_b = n + 1, b_at[e] + 1
        counts.update(links)
        docs.append((doc_id, (len(a), len(b), links, ";".join(groups))))
    highest = defaultdict(int)
    for (_, y), count in counts.items():
        highest[y] = max(highest[y], count)
    rows = Counter()
    for doc_id, found in docs:
        if found is None:
            rows[doc_id, 0, 0, 0, 0, 0, 0, "", ""] += 1
            continue
        n_a, n_b, links, groups = found
        best = sum(counts[link] == highest[link[1]] for link in links)
        total = sum(counts[link] for link in links)
        rows[doc_id, n_a, n_b, len(links), len(links), best, total, hashlib.sha256(groups.encode()).hexdigest(), groups] += 1
    return rows, counts, highest


def aligned(docs, **kwargs):
    found = alignment.align(docs, catalog.BYTE_BPE_JSON, PATTERN, catalog.PIECE_BPE, with_groups=True, **kwargs)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
    return Counter(tuple(r[c] for c in columns) for r in found.collect())


def test_alignment(docs):
    want, counts, highest = plain_alignment(HARD)
    assert aligned(docs) == want
    assert any(row[0] == 10 and row[7] == "" for row in want)  # the mark for a space cannot be told from a space
    encoded = alignment.encode_runs(docs, catalog.BYTE_BPE_JSON, PATTERN, catalog.PIECE_BPE, 5)
    pairs = alignment.pair_counts(encoded, catalog.BYTE_BPE_JSON, PATTERN, catalog.PIECE_BPE, 5).collect()
    assert {(r.a_id, r.b_id): r.links for r in pairs} == dict(counts) and len(pairs) == len(counts)
    assert all(r.is_best == (r.links == highest[r.b_id]) for r in pairs)
    assert aligned(docs.where("false")) == Counter()
    assert sum(aligned(docs.where("text is null or text = ''")).values()) == 2


def test_alignment_over_many_runs_levels_and_chunks(docs, monkeypatch):
    for name, value in (("FLUSH", 300), ("TOGETHER", 800), ("FAN_IN", 2), ("BLOCK", 7), ("CHUNK", 50), ("SPOOL", 100)):
        monkeypatch.setattr(alignment, name, value)
    assert aligned(docs, radixes=3) == plain_alignment(HARD)[0]


def test_merging_runs():
    rng = np.random.default_rng(4)
    runs = [np.sort(rng.integers(0, 400, rng.integers(1, 300))).astype(np.uint64) for _ in range(40)]
    want = Counter(int(x) for run in runs for x in run)
    blocks = []
    for run in runs:
        pairs, counts = np.unique(run, return_counts=True)
        blocks.append(alignment.framed(list(alignment.pair_blocks(pairs, counts))))
    got = list(alignment.with_maxima(alignment.merge_all(iter(blocks)), a_size=10))
    flat = [(int(p), int(c), bool(b)) for pairs, counts, best in got for p, c, b in zip(pairs, counts, best, strict=True)]
    assert [p for p, _, _ in flat] == sorted(want) and {p: c for p, c, _ in flat} == dict(want)
    assert all(b == (c == max(want[q] for q in want if q // 10 == p // 10)) for p, c, b in flat)
