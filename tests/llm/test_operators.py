"""The training-data operators on small hard tables and against plain brute-force versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from roomledger.llm import ann, byte_bpe, catalog, chat, decontaminate, licences, pii, sharding, simhash, token_records, toxicity
from roomledger.session import staging_path

SF = "/root/testdata/sf0.001"
WORDS = "on the river bank an old miller kept his grain while rain fell over seven quiet fields of barley and rye".split()


def sentence(seed: int, n: int = 40) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


HARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "same words here again and again"), (5, "same words here again and again"),
    (6, "a" * 3000), (7, "=-" * 400 + " x  y \n\n z　q"), (8, "日本語 é̂ 'll \x00\x01 mail a.b@c.example.com, +1 (243) 555-5526"),
    (None, "no id at all"), (9, sentence(9, 6000)), (4, "same words here again and again"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names the operators use."""
    rows = [(i, t, None, i, "s", 1.0, 0) for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, shard string, score double, fp int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def text_of(value):
    return value or ""


def by_text(rows):
    return sorted(rows, key=str)


def test_byte_bpe_equals_the_library_and_decodes(docs, none):
    import tiktoken

    ranks = byte_bpe.load_ranks(catalog.BYTE_BPE)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = byte_bpe.round_trip(docs, catalog.BYTE_BPE, public_tokenizers.PATTERN, with_ids=True).collect()
    want = [(i, library.encode_ordinary(text_of(t)), hashlib.sha256(text_of(t).encode()).hexdigest()) for i, t in HARD]
    assert by_text((r.doc_id, list(r.ids), r.decoded_sha256) for r in rows) == by_text(want)
    assert byte_bpe.round_trip(none, catalog.BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_long_pieces_resume(spark):
    codec = byte_bpe.Codec(catalog.BYTE_BPE, public_tokenizers.PATTERN)
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeghiorstu") for _ in range(1500)), "!" * 777, "ab" * 999]
    assert [i.tolist() for i in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_token_records_files_index_and_damage(spark, docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(catalog.WORD_BPE)
    path = staging_path(spark, "records")
    token_records.write_records(docs, path, catalog.WORD_BPE, files=3)
    index = token_records.build_index(spark, path)
    rows = index.orderBy("start").collect()
    ids = [library.encode(text_of(t), add_special_tokens=False).ids + [2] for _, t in HARD]
    assert by_text((r.doc_id, r.n_tokens) for r in rows) == by_text((i, len(x)) for (i, _), x in zip(HARD, ids, strict=True))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:n]) for n in range(len(rows))]
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    read = token_records.read_records(spark, index, path, seed=3).collect()
    assert by_text((r.doc_id, list(r.ids)) for r in read) == by_text((i, x) for (i, _), x in zip(HARD, ids, strict=True))
    record = bytearray(token_records.frame(7, np.array([1, 2, 3]), False))
    assert token_records.unframe(memoryview(record), 0)[1].tolist() == [1, 2, 3]
    record[25] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(memoryview(record), 0)
    assert token_records.token_records(none, catalog.WORD_BPE).count() == 0


def test_sharding_laws(docs, none):
    rows = sharding.assign_shards(docs, shards=5).collect()
    assert by_text((r.doc_id, r["size"], r.text_crc32) for r in rows) == by_text(
        (i, len(text_of(t).encode()) + 8, zlib.crc32(text_of(t).encode())) for i, t in HARD
    )
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    counts = np.bincount(sharding.jump(keys, 24), minlength=24)
    assert counts.min() > 0.85 * 20_000 / 24
    assert sharding.assign_shards(none).count() == 0


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "a<b|c\\d [INST]"), (1, 1, "user", None), (1, 2, "assistant", "<|user|>x</s><+>\\l"), (1, 3, "assistant", ""),
        (2, None, None, "odd"), (2, 5, "assistant", "é日"), (2, 5, "assistant", "é日"), (None, 1, "assistant", "w"),
    ] + [(3, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(600)]
    frame = spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, blocks int")
    formatted = chat.format_conversations(frame)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (1, 2, 3, None):
        own = [(t, r or "", x or "") for c, t, r, x in turns if c == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        lines, loss = "".join(f"{r}\n{x}\n" for _, r, x in own), "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():
        spans = "".join(r.formatted[s.start : s.end] for s in r.loss_spans)
        for plain, escaped in reversed(chat.ESCAPES):
            spans = spans.replace(escaped, plain)
        assert hashlib.sha256(spans.encode()).hexdigest() == got[r.conv_id].loss_sha256
    assert chat.read_back(chat.format_conversations(frame.filter("false"))).count() == 0


def test_simhash_equals_brute_force(spark, docs, none):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    fps = np.array([simhash.fingerprint(text_of(texts[i]), 4) for i in ids], dtype=np.uint64)
    label = np.arange(len(ids))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    while (new := np.array([label[row].min() for row in near])).tolist() != label.tolist():
        label = new
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(frame).collect()}
    assert rows == {i: (int(f), ids[n]) for i, f, n in zip(ids, fps, label, strict=True)}
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (1, 2, 3, 4, 5)) == [1, 4]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_keep_one_keeps_a_row_of_every_repeated_text(spark):
    a, b, c, d = (sentence(seed) for seed in (901, 902, 903, 904))
    rows = [(None, a), (None, a), (None, b), (None, b), (1, c), (1, c), (1, d), (1, d), (2, c), (None, None), (None, "")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    got = by_text((r.doc_id, text_of(r.text)) for r in kept.collect())
    assert kept.columns == ["doc_id", "text"]
    assert got == by_text([(None, a), (None, b), (1, c), (1, d), (None, "")])


@pytest.mark.parametrize("bits", [6, 12])
def test_every_link_within_the_distance_meets(bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    near = base.copy()
    for n in range(40):
        for bit in rng.choice(64, n % 5, replace=False):
            near[n] ^= np.uint64(1) << np.uint64(bit)
    fps = np.unique(np.concatenate((base, near)))
    found = [simhash.meet(fps, bucket, bits, 2, 4) for bucket in range(1 << bits)]
    a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    roots = dict(zip(*reversed(simhash.forest(a, b)), strict=True))
    for x, y in zip(base, near, strict=True):
        assert roots.get(x, x) == roots.get(y, y)


def test_pii_base_spans_and_tagger(docs, none):
    import re

    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    address = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("a1.@-+ 2é") for _ in range(rng.randint(0, 18)))
        assert pii.emails(text) == [m.span() for m in email.finditer(text)]
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in address.finditer(text)]
    rows = {r.doc_id: r for r in pii.find(docs).collect() if r.doc_id}
    assert (rows[8].n_email, rows[8].n_phone, rows[1].spans) == (1, 1, "")
    tagger = pii.Tagger(pii.model())
    held = [row for row in pii.labelled() if len(row) > 3]
    got = tagger.decode(tagger.encode([[w for w, _ in row] for row in held]))
    right = sum(pii.LABELS[x] == y for row, labels in zip(held, got, strict=True) for (_, y), x in zip(row, labels, strict=True))
    assert right / sum(map(len, held)) > 0.99
    assert [s[0] for s in tagger.added(["call (243) 555-5526 today"])[0]] == ["phone"]
    assert pii.redact_text("mail a@b.cd now", pii.base_spans("mail a@b.cd now")) == "mail [EMAIL] now"
    redacted = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert redacted[1].text is None and "[EMAIL]" in redacted[8].text and redacted[8].n_chars == len(redacted[8].text)
    assert pii.find(none).count() == 0 and pii.redact(none).count() == 0


def test_near_copies_count_once_in_the_toxicity_fit():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choice(words, 120).tolist()
    copies = [" ".join(base[:i] + ["other"] + base[i + 1 :]) for i in range(0, 120, 4)]
    others = [" ".join(rng.choice(words, 120)) for _ in range(20)]
    kept = toxicity.without_near_copies([*copies, *others, "", "one", ""])
    assert [t for t in kept if t in copies] == copies[:1]
    assert [t for t in kept if t in others] == others
    assert kept[-2:] == ["", "one"]


def test_toxicity_scores_do_not_follow_the_sampling_share(spark, monkeypatch):
    rng = random.Random(8)
    base, marks = [], []
    for i in range(700):
        words, toxic = sentence(20_000 + i, 24).split(), i % 8 == 0
        if rng.random() < (0.7 if toxic else 0.05):  # the classes overlap
            words[rng.randrange(24)] = "blockhead"
        base.append(" ".join(words))
        marks.append(int(toxic))
    monkeypatch.setattr(toxicity, "SAMPLE", {0: 700, 1: 1000})
    means = []
    for times in (1, 10):  # the second has too many ordinary labels for the sample
        rows = [(700 * n + i, base[i], marks[i]) for n in range(times) for i in range(700)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
        means.append(toxicity.probabilities(model, toxicity.Compressors(model), base).mean())
    assert abs(means[0] - 1 / 8) < 0.03 and abs(means[1] - means[0]) < 0.03


def test_shared_windows_come_from_all_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "SHARED_WINDOWS", 100)
    found = [f"w{n}".encode() for n in range(1000)]
    chosen = [int(w[1:]) for w in toxicity.chosen_windows(iter(found))]
    assert len(chosen) == 100 and chosen == sorted(chosen)
    assert min(np.histogram(chosen, bins=5, range=(0, 1000))[0]) > 8
    assert toxicity.chosen_windows(iter(found[:50])) == found[:50]


def test_toxicity_on_held_out_rows(spark, docs, none):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = sentence(i, 60).split()
        toxic = i % 4 == 0
        for _ in range(4 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(("blockhead", "nitwitted", "scoundrel")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(frame, marks)
    scored = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    held = [scored[i] for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r in held)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(none, model).count() == 0
    unlabelled = toxicity.train(frame, marks.filter("false"))
    assert {r.score for r in toxicity.score(docs, unlabelled).collect()} == {0.0}


def test_licences_families_and_unknown(spark, none):
    rows = [
        (1, "Intro line.\nReleased under the MIT License.\nEnd."), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, ""),
        (5, "The driver renewed a driving license in April."), (6, sentence(6)), (7, "Licensed under the Apache License, Version 2.0."),
        (7, "Licensed under the Apache License, Version 2.0."),
    ]
    rows += [(100 + i, sentence(i)) for i in range(60)]
    got = licences.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: r.licence for r in got}
    assert (found[1], found[2], found[7]) == ("mit", "cc-by-nc-4.0", "apache-2.0")
    assert found[3] == found[4] == found[6] == "none" and found[5] in ("none", "unknown")
    assert len(got) == len(rows)
    assert licences.scan_documents(none.select("doc_id", "text")).count() == 0


def test_decontamination_finds_copies_and_paraphrases(spark, none, monkeypatch):
    bench = [(i, sentence(5000 + i, 30)) for i in range(5)] + [(9, None), (10, ""), (11, "too short")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = [(i, sentence(i, 120)) for i in range(150)]
    rows[3] = (3, sentence(3, 50) + " " + bench[1][1].upper() + ". " + sentence(33, 40))
    words = bench[2][1].split()
    words[4], words[15], words[22] = "other", "words", "here"
    rows[7] = (7, sentence(7, 30) + " " + " ".join(words) + " " + sentence(77, 30))
    rows += [(200, None), (201, ""), (None, bench[3][1]), (3, rows[3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, items).collect()}
    assert got == {(3, 1), (7, 2), (None, 3)}
    monkeypatch.setattr(decontaminate, "MOST_KEYS", 0)  # the way without a broadcast
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, items).collect()} == got
    assert decontaminate.leaks(none.select("doc_id", "text"), items).count() == 0
    assert decontaminate.leaks(frame, items.filter("false")).count() == 0
    a, b = "x a y b c z d".split(), "a q b c d d".split()
    assert decontaminate.common_subsequence(a, b) == 4


def plain_leaks(rows, bench):
    """(doc_id, item_id, covered): every item against the stretch around every passage, words only."""
    out = {}
    for doc_id, text in rows:
        words = text.split()
        for item_id, item_text in bench:
            item = [w for w in map(decontaminate.normal, item_text.split()) if w]
            for start in range(0, len(words), decontaminate.HALF):
                stretch = words[max(0, start - len(item)) : start + decontaminate.WINDOW + len(item)]
                covered, _, leak = decontaminate.verify(item, [w for w in map(decontaminate.normal, stretch) if w])
                if leak:
                    out[doc_id, item_id] = max(covered, out.get((doc_id, item_id), 0))
    return {(*pair, covered) for pair, covered in out.items()}


def test_decontamination_equals_every_item_against_every_stretch(spark):
    bench = [(n, sentence(7000 + n, n)) for n in (8, 9, 10, 12, 16, 24, 40)]
    rows = [(i, sentence(i, 90)) for i in range(60)]
    for n, text in bench:
        words = text.split()
        fifth = [w if i % 5 != 2 else f"swapped{i}" for i, w in enumerate(words)]
        thinned = [w if i % 3 != 1 or i >= 0.7 * n else f"swapped{i}" for i, w in enumerate(words)]
        dilated = [x for i, w in enumerate(words) for x in ((w, f"put{i}") if i % 2 else (w,))]
        for kind, parts in enumerate((words, fifth, thinned, dilated)):
            for offset in range(8):
                before, after = sentence(n * 100 + offset, 40 + offset), sentence(n * 200 + offset, 50)
                rows.append((1000 * n + 10 * kind + offset, f"{before} {' '.join(parts)} {after}"))
    want = plain_leaks(rows, bench)
    assert len(want) > 170
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.covered) for r in decontaminate.leaks(frame, items).collect()}
    assert got - want == set()
    assert want - got == set()


def test_only_the_leaking_rows_of_an_id_go(spark):
    item = sentence(5000, 30)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    leak = f"{sentence(1, 40)} {item} {sentence(2, 40)}"
    clean = [(None, sentence(i, 100)) for i in range(30)] + [(7, sentence(i, 100)) for i in range(30, 60)] + [(None, None), (7, "")]
    rows = [*clean, (None, leak), (7, leak), (7, leak), (8, leak)]
    kept = decontaminate.keep_clean(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert kept.columns == ["doc_id", "text"]
    assert by_text((r.doc_id, r.text) for r in kept.collect()) == by_text(clean)


def test_nearest_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(700, 16)).round(3)
    vectors[300:420] = vectors[300]  # a large group of copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] * 16), (1300, [None] * 16), (1400, [1.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.query_id for r in got} == {0, 100, 200, 300, 400, 500, 600}
    hits = 0
    for q in range(0, 700, 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        want = np.lexsort((np.arange(700), far))[:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert np.allclose([s for _, _, s in own], far[[v for _, v, _ in own]])
        hits += len({v for _, v, _ in own} & set(want.tolist()))
    assert hits / 70 >= 0.9
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_every_list_entry_meets_and_recall_holds_beyond_the_start_blocks(spark):
    assert ann.MEET >= ann.NEIGHBOURS  # else fresh entries that did not meet would count as old
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    hits = 0
    for q in range(0, 4000, 100):
        far = ((vectors - vectors[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(set(np.argsort(far)[:10].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits / 400 >= 0.98


def test_pipeline_stages_keep_columns_and_order(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES][1] == "simhash_near_dedup"
    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, source, SF)
    parts = simhash.near_duplicates(source).select("component_id").distinct()
    assert kept.columns == source.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in parts.collect())


def plain_pipeline(docs: list[tuple], model, items: list[str]) -> list[tuple]:
    """The five stages in turn over (doc_id, text) rows, one document after the other, without Spark."""
    import tiktoken

    compressors = toxicity.Compressors(model)
    docs = [(i, t or "") for i, t in docs if toxicity.probabilities(model, compressors, [t or ""])[0] < toxicity.THRESHOLD]
    marks = [simhash.fingerprint(t, 4) for _, t in docs]
    group = list(range(len(docs)))

    def first(n: int) -> int:
        while group[n] != n:
            n = group[n]
        return n

    for n in range(len(docs)):
        for m in range(n):
            if (marks[n] ^ marks[m]).bit_count() <= 4:
                low, high = sorted((first(n), first(m)))
                group[high] = low
    least = {}
    for n, (doc_id, text) in enumerate(docs):
        least[first(n)] = min(least.get(first(n), (doc_id, text)), (doc_id, text))
    docs = sorted(least.values())
    words_of = [[w for w in map(decontaminate.normal, item.split()) if w] for item in items]

    def leaks(text: str) -> bool:
        words = text.split()
        for item in words_of:
            for start in range(0, len(words), decontaminate.HALF):
                stretch = words[max(0, start - len(item)) : start + decontaminate.WINDOW + len(item)]
                if len(set(item) & set(map(decontaminate.normal, stretch))) >= 0.65 * len(set(item)) and decontaminate.verify(
                    item, [w for w in map(decontaminate.normal, stretch) if w]
                )[2]:
                    return True
        return False

    docs = [(i, t) for i, t in docs if not leaks(t)]
    tagger = pii.tagger(pii.model())
    docs = [(i, pii.redact_text(t, pii.all_spans(pii.base_spans(t), tagger.added([t])[0]))) for i, t in docs]
    ranks = byte_bpe.load_ranks(catalog.BYTE_BPE)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [(i, tuple(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs]


def test_pipeline_equals_a_plain_version(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = corpus_pipeline.run(spark, SF).collect()
    want = plain_pipeline(rows, model, items)
    assert 50 < len(want) < len(rows)
    assert sorted((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in got) == sorted(want)
