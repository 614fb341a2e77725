"""The corpus operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return {r[0]: r[1] for r in duckdb.sql(f"select doc_id, coalesce(text, '') from '{DIR}/documents.parquet'").fetchall()}


@pytest.fixture(scope="module")
def queries():
    from postloom.llm.queries import QUERIES

    return QUERIES


def test_packing_gives_back_every_token(spark, queries, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = queries["op6_packing"](spark, DIR).collect()
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in got:
        pieces[r.doc_id][r.piece] = r
        places[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in docs.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        own = [pieces[doc_id][k] for k in range(len(pieces[doc_id]))]
        assert [p.start for p in own] == np.concatenate([[0], np.cumsum([p.length for p in own])[:-1]]).tolist()
        assert sum(p.length for p in own) == len(ids) and all(p.length == 2048 for p in own[1:])
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in own)
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    least = -(-sum(r.length for r in got) // 2048)
    assert len(places) <= least * 1.02 + 1


def test_packing_leaves_one_part_filled_sequence(spark):
    from postloom.llm import packing

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, block=100).collect()
    assert sum(r.length < 2048 for r in got) > 900
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_of_added_tokens_and_long_runs(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from postloom.llm import packing

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one <|endoftext|> two", "<|endoftext|><|endoftext|>", "a  <|endoftext|>\n b <|endoftext", "x" + " " * 1_000_000 + "y", "a" + "\n \u00a0" * 20_000 + "b", "plain text"]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [505, 220, 50256, 734]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), with_ids=True).collect()
    for i, text in enumerate(texts):
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)])
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_genetic_packing_is_no_worse_than_best_fit():
    from postloom.llm import packing

    rng = random.Random(5)
    lengths = [rng.randint(50, 1400) for _ in range(400)]
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    plain = packing.best_fit(order, lengths, 2048)
    best = packing.evolve(lengths, 2048, [], 12, 6, 1)
    assert sorted(i for items, _ in best for i in items) == list(range(400))
    assert all(sum(lengths[i] for i in items) + room == 2048 for items, room in best)
    assert packing.fitness(best, 2048) >= packing.fitness(plain, 2048)
    one, other = plain, packing.best_fit(rng.sample(range(400), 400), lengths, 2048)
    child = packing.crossover(one, other, lengths, 2048, rng)
    assert sorted(i for items, _ in child for i in items) == list(range(400))
    assert packing._from_bytes(packing._to_bytes(child, 400), lengths, 2048) is not None


def test_genetic_packing_saves_sequences(spark):
    """On lengths where best fit stays above the bound, with the parameters of production."""
    from postloom.llm import packing

    rng = random.Random(7)
    lengths = [rng.randint(500, 1100) for _ in range(1500)]
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    plain = len(packing.best_fit(order, lengths, packing.LENGTH))
    elites = [packing.evolve(lengths, packing.LENGTH, [], packing.GENERATIONS, packing.POPULATION, seed) for seed in range(packing.ISLANDS)]
    best = min(len(p) for p in elites)
    for epoch in range(1, packing.EPOCHS):
        elites = [packing.evolve(lengths, packing.LENGTH, [elites[i], elites[i - 1]], packing.GENERATIONS, packing.POPULATION, 100 * epoch + i) for i in range(packing.ISLANDS)]
    migrated = min(len(p) for p in elites)
    assert -(-sum(lengths) // packing.LENGTH) <= migrated <= best < plain


def test_near_dedup_equals_comparing_all(spark):
    """Groups around pivots, in more than one block, against all pairs."""
    from postloom.llm import near_dedup

    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for g in range(12):
        base = rng.choices(vocabulary, k=120)
        for _ in range(rng.choice([1, 2, 30])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8, 20])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [" ".join(passage + rng.choices(vocabulary, k=60)) for _ in range(40)] + ["a b", "a b", "A B", "a", "", "x y z", "x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for words, percent, block in ((3, 85, 512), (3, 85, 8), (5, 80, 8), (3, 60, 16)):
        sets = []
        for t in texts:
            w = t.lower().split()
            sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
        label = list(range(len(texts)))
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                    a, b = sorted((label[i], label[j]))
                    label = [a if x == b else x for x in label]
        near_dedup.BLOCK, was = block, near_dedup.BLOCK
        try:
            got = {r.doc_id: r for r in near_dedup.near_dedup(docs, words, percent).collect()}
        finally:
            near_dedup.BLOCK = was
        assert [got[i].component_id for i in range(len(texts))] == label
        assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_components_of_long_paths(spark):
    from postloom.llm.common import Scratch
    from postloom.llm.near_dedup import components

    ids = random.Random(1).sample(range(1000), 300)
    edges = spark.createDataFrame(list(zip(ids[:200], ids[1:201])) + list(zip(ids[210:299], ids[211:300])), "a long, b long")
    got = dict(components(edges, Scratch(spark, "test")).collect())
    assert set(got) == set(ids[:201]) | set(ids[210:300])
    assert {got[i] for i in ids[:201]} == {min(ids[:201])} and {got[i] for i in ids[210:300]} == {min(ids[210:300])}


def test_colliding_hashes_are_told_apart(spark):
    from postloom.llm.exact_dedup import Directory, exact_dedup

    texts = [f"text {i % 60}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits, size in ((2, 500), (64, 500), (64, None)):
        got = {r.doc_id: r for r in exact_dedup(docs, size, bits, combine_bytes=2000).collect()}
        assert all((got[i].keep_id, got[i].group_size, got[i].kept) == (240 + i % 60, 5, i >= 240) for i in range(300))
        assert all(got[i].text_sha256 == hashlib.sha256(texts[i].encode()).hexdigest() for i in range(300))
    d = Directory(10)
    assert d.grow({i: 4 for i in range(16)}, 4) == [] and d.depth == 3 and len(d.buckets()) == 8
    d = Directory(10)
    assert d.grow({3: 50, 4: 1}, 4) == [3] and d.depth == 4


def test_splitters_meet_their_shares(spark):
    from postloom.llm.sharding import splitters

    rng = random.Random(3)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.randint(1, 100)) for _ in range(3000)] + [(7, 1)] * 50 + [(-(1 << 63), 5), ((1 << 63) - 1, 5)]
    keyed = spark.createDataFrame(rows, "k long, w long")
    bounds = splitters(keyed, "k", "w", 8)
    sizes = [sum(w for k, w in rows if (i == 0 or k >= bounds[i - 1]) and (i == 7 or k < bounds[i])) for i in range(8)]
    total = sum(w for _, w in rows)
    assert sum(sizes) == total and max(abs(s - total / 8) for s in sizes) <= 2 * 100
    assert splitters(keyed.where("false"), "k", "w", 4) == [0, 0, 0]
    one = spark.createDataFrame([(5, 10)] * 9, "k long, w long")
    assert len(splitters(one, "k", "w", 4)) == 3


def test_shards_are_near_equal(spark, queries, docs):
    got = queries["op4_sharding"](spark, DIR).collect()
    sizes, groups = Counter(), Counter()
    for r in got:
        sizes[r.shard] += r.size
        groups[docs[r.doc_id]] += r.size
        assert r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
    assert max(sizes.values()) - sum(sizes.values()) / 24 <= max(groups.values())


def test_mix_meets_targets(spark, queries):
    from postloom.llm.mixing import shard_quota, targets

    assert targets([100, 100, 100], [1, 1, 1]) == [100, 100, 100]
    found = targets([10, 1000, 1000], [5, 2, 1])
    assert found[0] == 30 and abs(sum(found) - 2010) < 1e-6 and abs(found[1] - 2 * found[2]) < 1e-6
    source = dict(duckdb.sql(f"select doc_id, source from '{DIR}/documents.parquet'").fetchall())
    got = queries["op8_mixing"](spark, DIR).collect()
    taken, goal, largest = Counter(), {}, Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        goal[source[r.doc_id]] = r.target
    assert abs(sum(goal.values()) - sum(r.size for r in got)) < 1e-3
    assert all(abs(taken[s] - goal[s]) <= 0.05 * goal[s] + 50 for s in goal)
    again = {r.doc_id: r.taken for r in queries["op8_mixing"](spark, DIR).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    # shards: every source's blocks are dealt out whole, each shard as many takings as any other but one
    takes = Counter()
    for r in got:
        turns = [x.split(":") for x in r.shards.split(",") if x]
        assert r.taken == len(turns) * r.size and len({t for t, _ in turns}) == len(turns) and all(0 <= int(s) < 16 for _, s in turns)
        takes.update(int(s) for _, s in turns)
    assert len(takes) == 16
    quota = np.array([40, 7, 100])
    runs = [shard_quota(k, 6, quota, 1) for k in range(6)]
    assert (sum(n for _, n in runs) == quota).all() and all(abs(int(n.sum()) - 147 / 6) <= 1 for _, n in runs)
    assert all((runs[k][0] + runs[k][1] == runs[k + 1][0]).all() for k in range(5))


def test_filling_by_cells_comes_near(spark):
    """A source whose last block has far more rows than a task picks from."""
    from postloom.llm import mixing

    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([1, 3, 9, 50]), "a" if i % 3 else "b") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    was = mixing.FILL, mixing.BLOCKS_EACH
    mixing.FILL, mixing.BLOCKS_EACH = 32, 3
    try:
        got = mixing.Mix(docs).documents.collect()
    finally:
        mixing.FILL, mixing.BLOCKS_EACH = was
    source, taken, goal = {i: s for i, _, s in rows}, Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        goal[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - goal[s]) <= 2 for s in goal)


def test_languages_of_held_out_documents(spark, queries):
    lang = dict(duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    got = queries["op9_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_unlearned_languages_and_junk_are_rejected(spark):
    import base64

    from pyspark.sql import functions as F

    from postloom.llm import language_id

    rng = random.Random(8)
    parts = {"en": ["the", "and", "ing", "th", "of", "er", "wh"], "fr": ["eux", "ré", "ê", "la", "ou", "que", "oi"]}
    text = lambda own: " ".join("".join(rng.choices(own, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 60)))
    rows = [(i, text(parts[lang]), lang) for i, lang in enumerate(["en", "fr"] * 1000)]
    junk = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan"]
    junk += [base64.b64encode(rng.randbytes(150)).decode() for _ in range(18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    every = docs.union(spark.createDataFrame([(5000 + i, t, None) for i, t in enumerate(junk)], docs.schema))
    model, langs = language_id.learn(docs, F.lit(True))
    kept = {r.doc_id for r in language_id.keep_identified(every, model, langs).collect()}
    assert sum(i < 5000 for i in kept) >= 0.97 * len(rows)
    assert sum(i >= 5000 for i in kept) <= 0.1 * len(junk)


def slow_scores(model, text: bytes) -> np.ndarray:
    """The mean probabilities of a text's bytes, by one step of one direction after the other."""
    total = np.zeros(len(model.bias))
    for at in range(0, len(text), 64):
        segment = text[at : at + 64]
        sides = []
        for side, read in ((0, segment + bytes(64 - len(segment))), (1, (segment + bytes(64 - len(segment)))[::-1])):
            h, states = np.zeros(model.h), []
            for byte in read:
                a, u = model.inp[side][:, byte].astype(float), model.rec[side].astype(float) @ h
                z = np.clip(0.25 * (a[: model.h] + u[: model.h]) + 0.5, 0, 1)
                r = np.clip(0.25 * (a[model.h : 2 * model.h] + u[model.h : 2 * model.h]) + 0.5, 0, 1)
                m = np.clip(a[2 * model.h :] + r * u[2 * model.h :], -1, 1)
                h = z * h + (1 - z) * m
                states.append(h)
            sides.append(states if side == 0 else states[::-1])
        for t in range(len(segment)):
            e = model.out.astype(float) @ np.concatenate([sides[0][t], sides[1][t]]) + model.bias[:, 0]
            p = np.exp(e - e.max())
            total += p / p.sum()
    return total / max(1, len(text))


def test_scores_of_many_segments():
    import pyarrow as pa

    from postloom.llm import language_id

    rng = random.Random(3)
    model = language_id.ByteGRU(4, seed=7)
    texts = [bytes(rng.choices(range(256), k=n)) for n in (0, 1, 63, 64, 65, 700, 64 * 40)]
    got = language_id.pooled(model, pa.array(texts, pa.binary()))
    for text, p in zip(texts, got):
        assert np.allclose(p, slow_scores(model, text), atol=1e-4)


def test_every_language_is_a_class_or_an_error(spark):
    from pyspark.sql import functions as F

    from postloom.llm import language_id

    rows = [(i, f"text of the language number {i}", f"l{i}") for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language_id.learn(docs.where("doc_id < 12"), F.lit(True))[1]) == 12
    with pytest.raises(ValueError):
        language_id.learn(docs, F.lit(True))


def test_gradients_of_the_network():
    from postloom.llm.language_id import ByteGRU

    rng = np.random.default_rng(0)
    model = ByteGRU(3, hidden=3)
    for p in model.parameters():
        p[...] = rng.normal(0, 0.3, p.shape)
    x, y = rng.integers(0, 256, (6, 5)), np.array([0, 1, 2, 0, 1])
    mask = np.ones((6, 5), np.float32)
    _, grads = model.gradients(x, mask, y)
    for p, g in zip(model.parameters(), grads):
        at = tuple(np.unravel_index(np.abs(g).argmax(), g.shape))
        was, step = p[at].copy(), 1e-2
        p[at] = was + step
        up, _ = model.gradients(x, mask, y)
        p[at] = was - step
        down, _ = model.gradients(x, mask, y)
        p[at] = was
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_toxic_words_are_found():
    from postloom.llm import toxicity

    rng = random.Random(4)
    syllables = ["the", "and", "ing", "ther", "est", "ion", "er", "ly", "on", "of"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    def text(bad: bool) -> bytes:
        words = [word() for _ in range(rng.randint(60, 300))]
        for i in range(3, len(words), 35):
            words[i] = rng.choice(["grubnix", "flimwit", "zorkhead", "snarpel"]) if bad else words[i]
        return " ".join(words).encode()

    model = toxicity.fit([text(True) for _ in range(150)], [text(False) for _ in range(300)])
    new = [(text(b), b) for b in (True, False) for _ in range(60)]
    score = model.score(toxicity.figures(model.distances(), [t for t, _ in new]))
    assert np.mean((score >= 0.5) == np.array([b for _, b in new])) > 0.9
    data, start, size, owner = toxicity.windows([b"", b"one two", b"x" * 100, b"a b " * 50], 32)
    assert owner.tolist() == sorted(owner.tolist()) and set(owner.tolist()) == {1, 2, 3}


def test_rare_toxic_words_are_found():
    """Each of 42 words is in under a tenth of the toxic documents; a phrase is toxic though its words are not."""
    from postloom.llm import toxicity

    rng = random.Random(6)
    plain = ["".join(rng.choices(["ba", "ne", "to", "li", "su", "mor", "ten"], k=rng.randint(1, 4))) for _ in range(400)]
    bad = [a + b for a in ("gruk", "flim", "zorp", "snar", "vex", "wib") for b in ("hok", "jad", "quif", "drem", "pyg", "kuz", "goff")] + ["waste of space"]

    def text(toxic: bool) -> bytes:
        words = rng.choices([*plain, "waste", "of", "space"], k=rng.randint(60, 120))
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        return " ".join(words).encode()

    toxic = [text(True) for _ in range(350)]
    assert max(sum(b" " + w.encode() + b" " in t for t in toxic) for w in bad[:-1]) < 0.12 * 350
    model = toxicity.fit(toxic, [text(False) for _ in range(700)])
    new = [(text(b), b) for b in (True, False) for _ in range(100)]
    score = model.score(toxicity.figures(model.distances(), [t for t, _ in new]))
    assert np.mean((score >= 0.5) == np.array([b for _, b in new])) > 0.8


def test_toxicity_of_held_out_labels(spark, queries):
    """The query on documents and labels of the shipped tables, on labels that it may not learn from."""
    path = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{path}/labels.parquet'").fetchall())
    got = queries["op10_toxicity"](spark, path).collect()
    assert len(got) == duckdb.sql(f"select count(*) from '{path}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    clean = [s for s, y in held if y == 0]
    toxic = [s for s, y in held if y == 1]
    assert sum(s >= 0.5 for s in clean) <= 0.06 * len(clean)
    assert sum(s >= 0.5 for s in toxic) >= 0.45 * len(toxic)  # only 350 toxic documents to learn from


def test_license_verdicts():
    from postloom.llm import license_scan

    classes, weights, intercepts, least = license_scan.trained()
    table = dict(weights)

    def verdict(text: str) -> str:
        z = np.array(intercepts) + sum((np.array(table[g]) for g in license_scan.grams(license_scan.tokens(text)) if g in table), np.zeros(len(classes)))
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p[:-1].argmax())
        return classes[k] if p[k] >= least else license_scan.UNKNOWN

    assert verdict("Released under the MIT License.") == "mit"
    assert verdict("This file is released under the terms of the MIT license") == "mit"
    assert verdict("Licensed under CC BY-NC 4.0.") == "cc-by-nc" and verdict("Licensed under CC BY 4.0.") == "cc-by"
    assert verdict("This work is licensed under the GNU General Public License, version 3.") == "gpl"
    assert verdict("he lost his driver's license and the copyright of his songs") == license_scan.UNKNOWN
    for said, family in (("GPL-3.0-or-later", "gpl"), ("Distributed under GNU GPL v3", "gpl"), ("This file is under the MIT terms", "mit"), ("Released under Apache-2.0", "apache"), ("Distributed under MPL-2.0", "mpl")):
        assert verdict(said) == family, said


#: Notices and ordinary paragraphs that no rule of the operator wrote.
LABELLED = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("gpl", "this program is free software: you can redistribute it and/or modify it under\nthe terms of the GNU General Public License as published by the Free Software\nFoundation, either version 3 of the License, or any later version."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use\nthis file except in compliance with the License."),
    ("cc-by-sa", "The text of this page is available under the CC BY-SA 4.0 license"),
    ("", "The council will discuss the new rules for public gardens on Monday"),
    ("", "Please renew your fishing license before the season opens in April"),
    ("", "we use the software at work and the file was sent to all members of the general staff"),
    ("", "She asked the museum for permission to copy the painting"),
]


def test_license_scan_of_labelled_paragraphs(spark):
    from postloom.llm.license_scan import license_scan

    rows = [(i, f"A first line of text.\n{t}\n\nAnd a last one.") for i, (_, t) in enumerate(LABELLED)]
    got = {r.doc_id: r.families for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(LABELLED))] == [f for f, _ in LABELLED]


def test_sql_gives_the_same_rows(spark, queries):
    from postloom.llm.queries import sql

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"create view {t} as from '{DIR}/{t}.parquet'")
    for name, text in sql().items():
        want = con.sql(text)
        got = queries[name](spark, DIR)
        assert sorted(got.columns) == sorted(want.columns), name
        got = got.select(*want.columns).collect()
        key = lambda r: tuple(str(v) for v in r)
        assert sorted(map(key, got)) == sorted(map(key, want.fetchall())), name
