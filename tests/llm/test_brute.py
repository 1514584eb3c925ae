"""Operators against plain versions of themselves."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkmill.llm import audio, decontaminate, jaccard_join, licenses, packing, quality, secret_scan, sharding, token_counts, toxicity
from linkmill.llm._words import split_words

from .conftest import SCHEMA, rows

ALPHABET = ["a", "The", "thing", " ", "  ", "\n", "\t", "'re", "'s", "'", "é", "ß", "你", "🙂", "!!", "12", "²", "ſ", "\xa0", "<|endoftext|>", "ing", "\x1c", "'ll", "　", "İ", "Σ", "×"]
TEXTS = st.lists(st.sampled_from(ALPHABET), max_size=9).map("".join)


@given(TEXTS, st.integers(0, 6))
@settings(max_examples=300, deadline=None)
def test_token_counts_of_every_prefix(text, limit):
    c = token_counts.counter(token_counts.default_path())
    want = [len(c.library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    counts = c.table(text)
    assert c.count(text) == want[-1]
    assert counts.tolist() == want
    assert token_counts.cut(counts, limit) == max(i for i, n in enumerate(want) if n <= limit)


class Encodes:
    """The library without its encoder."""

    def __init__(self, library):
        self.pre_tokenizer = library.pre_tokenizer


@pytest.mark.parametrize("kind", ["cjk", "special", "base64", "arabic"])
def test_token_counts_of_long_texts_without_the_encoder(kind):
    rng, c = random.Random(9), token_counts.PrefixCounter(token_counts.default_path())
    text = {
        "cjk": lambda: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(60_000)), "special": lambda: "some words " * 4000 + "<|endoftext|> more " + "of them " * 4000,
        "base64": lambda: "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(60_000)), "arabic": lambda: "".join(rng.choice("ابتثجحخد ") for _ in range(60_000)),
    }[kind]()
    want = len(c.library.encode(text, add_special_tokens=False).ids)
    some = [0, 1, 2, 1000, 20_001, len(text) - 1]
    ends = [len(c.library.encode(text[:i], add_special_tokens=False).ids) for i in some]
    c.library = Encodes(c.library)
    table = c.table(text)
    assert len(table) == len(text) + 1 and table[-1] == c.count(text) == want and [table[i] for i in some] == ends
    assert max(map(len, [*c.counts, *c.words, ""])) <= token_counts.SHORT


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_packing_ids(text):
    e = packing.encoder(packing.default_path())
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.library.encode(text, add_special_tokens=False).ids


def test_packing_remembers_short_pieces_only():
    e = packing.Encoder(packing.default_path())
    text = "short " + "x" * 500 + " " + "y" * 49 + " words"
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.library.encode(text, add_special_tokens=False).ids
    assert set(e.young) == {"short", "words"}


def test_packing_round_trip(spark, nasty):
    library = packing.encoder(packing.default_path()).library
    got = packing.pack(nasty, capacity=64).collect()
    texts = {r[0]: r[1] for r in rows()}
    whole = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items() if i is not None}
    for r in got:
        ids = whole.get(r.doc_id)
        if ids:
            part = ids[64 * r.piece : 64 * r.piece + 64]
            assert (r.start, r.length, r.ids_crc32) == (64 * r.piece, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 101, 40))
    counts = rng.integers(1, 60, len(lengths))
    made = packing.plan(lengths, counts, 100)
    used = Counter()
    for config, n in made:
        assert sum(config) <= 100
        used.update({x: n * k for x, k in Counter(config).items()})
    assert used == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    first_fit = []
    for x in np.repeat(lengths, counts)[::-1]:
        k = next((k for k, room in enumerate(first_fit) if room >= x), None)
        if k is None:
            first_fit.append(100 - x)
        else:
            first_fit[k] -= x
    assert sum(n for _, n in made) <= len(first_fit)


def test_packing_of_many_lengths_follows_the_program():
    rng = np.random.default_rng(5)
    lengths = np.unique(rng.integers(1, 513, 300))
    counts = rng.integers(1, 80, len(lengths))
    solution = packing.solve(lengths, counts, 512)
    covered, chosen = np.zeros(len(lengths)), Counter()
    for config, n in solution:
        assert sum(int(lengths[i]) * k for i, k in config) <= 512
        for i, k in config:
            covered[i] += k * n
        chosen[tuple(sorted((int(lengths[i]) for i, k in config for _ in range(k)), reverse=True))] += n
    assert (covered >= counts - 1e-6).all()  # every length of the histogram, more than 64 of them
    made = packing.plan(lengths, counts, 512)
    used = Counter()
    for config, n in made:
        used.update({x: n * k for x, k in Counter(config).items()})
    assert used == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    total = sum(n for _, n in made)
    assert sum(n for config, n in made if config in chosen) >= 0.6 * total
    assert total <= 1.01 * sum(n for _, n in solution)


@pytest.mark.parametrize("middle", [5.5, 6.2])
def test_packing_of_a_real_histogram_against_best_fit(middle):
    """Over 1,000 lengths, as texts have them: not more sequences than best-fit needs, and next to the bound."""
    from bisect import bisect_left, insort

    sizes = np.clip(np.exp(np.random.default_rng(3).normal(middle, 0.9, 10_000)).astype(int), 1, 2048)
    lengths, counts = np.unique(sizes, return_counts=True)
    assert len(lengths) > 1000
    made = packing.plan(lengths, counts)
    used = Counter()
    for config, n in made:
        assert sum(config) <= 2048
        used.update({x: n * k for x, k in Counter(config).items()})
    assert used == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    rooms, best_fit = [], 0
    for x in sorted(sizes.tolist(), reverse=True):
        i = bisect_left(rooms, x)
        best_fit += i == len(rooms)
        insort(rooms, (rooms.pop(i) if i < len(rooms) else 2048) - x)
    total = sum(n for _, n in made)
    assert total <= best_fit and total <= -(-int(sizes.sum()) // 2048) + 1


def test_knapsack_pricing_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 15, 4))
        prices = rng.random(len(lengths))
        copies = packing.best_configuration(prices, lengths, 20)
        best = max((sum(p * x for p, x in zip(prices, c, strict=True)) for c in np.ndindex(*(21 // n + 1 for n in lengths)) if np.dot(c, lengths) <= 20))
        assert np.dot(copies, lengths) <= 20 and abs(np.dot(copies, prices) - best) < 1e-9


@given(st.lists(st.lists(st.sampled_from("abcÉz"), max_size=40).map(" ".join), max_size=5), st.lists(st.lists(st.sampled_from("abcÉ"), max_size=14).map(" ".join), max_size=4))
@settings(max_examples=200, deadline=None)
def test_fm_index_finds_every_window(texts, items):
    named = [(str(i), t) for i, t in enumerate(items)]
    words = [split_words(t) for t in texts]
    found = decontaminate.Windows(named).find(words)
    got = [(len(w), sum(b - a for a, b in s), len(i), hashlib.sha256(",".join(sorted(i)).encode()).hexdigest(), bool(s)) for w, (s, i) in zip(words, found, strict=True)]
    assert got == decontaminate.brute_force(texts, named)


def test_decontamination_in_blocks(nasty, benchmark):
    one = decontaminate.contamination(nasty, benchmark).collect()
    several = decontaminate.contamination(nasty, benchmark, block_chars=40).collect()
    assert sorted(map(str, one)) == sorted(map(str, several))
    assert {r.doc_id for r in one if r.spans} >= {5, 6, 7, 4, 3}


@given(st.lists(st.sampled_from("gnu general public license apache cc by mit under the version work terms of".split()), max_size=40))
@settings(max_examples=300, deadline=None)
def test_license_base_phrases(words):
    want = sorted((i, k) for k, (p, _) in enumerate(licenses.BASE) for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    assert licenses.Automaton().scan(" ".join(words))["base"] == want


def test_license_labels_are_exact():
    a = licenses.Automaton()
    for label, text, _ in licenses.TEMPLATES:
        found = a.scan("some words before " + text.upper() + " and after")
        base = {n for p, n in licenses.BASE if f" {p} " in " " + " ".join(w.decode() for w in split_words(text)) + " "}
        assert found["labels"] == sorted(base | {label}) and found["score"] == 1.0
    broken = a.scan("Permission is hereby granted, free of charge, to any EVIL person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and sell copies of the Software")
    assert broken["labels"] == ["mit"] and 0.5 < broken["score"] < 1
    affero = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    for text, labels in (
        ("Released under the BSD license.", []), ("The book was released under the name Foo.", []), ("licensed under CC BY-ND 4.0", ["cc-by"]), ("licensed under cc by nd", ["cc-by"]),
        (affero, ["agpl"]), (affero.replace("Affero ", ""), ["gpl"]), ("Permission is hereby granted, free of charge", []), ("This is free and unencumbered software", []),
        ("version 3. This work is licensed under the GNU General Public License", ["gpl"]),
    ):
        assert a.scan(text)["labels"] == labels, text
    twice = a.scan("Released under the MIT License. Released under the MIT License.")
    assert [(s[1], s[2]) for s in twice["spans"]] == [(0, 5), (5, 10)]


@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), min_size=1, max_size=3), st.lists(st.sampled_from("abcd"), max_size=25))
@settings(max_examples=300, deadline=None)
def test_license_matching_statistics(templates, text):
    a = licenses.Automaton([(str(i), " ".join(t), "") for i, t in enumerate(templates)], ())
    got = []
    a._chains = lambda matches: got.extend((t, x, y, sorted(a.places[s][t])) for t, x, y, s in matches) or []
    a.scan(" ".join(text))
    want = []
    for t, words in enumerate(templates):
        ends = lambda p, words=words: [i + len(p) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        size = [max(n for n in range(i + 1) if n == 0 or ends(text[i - n : i])) for i in range(len(text) + 1)] + [0]
        want += [(t, i - n, i, ends(text[i - n : i])) for i, n in enumerate(size[:-1]) if n >= licenses.MIN_MATCH and size[i + 1] <= n]
    assert sorted(got) == sorted(want)


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 5), st.integers(0, 12)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_license_best_chain(pieces):
    from itertools import combinations

    pieces = sorted({(a, a + n, p, p + n) for a, n, p in pieces}, key=lambda p: (p[1], p[0], p[2]))
    best = 0
    for k in range(1, len(pieces) + 1):
        for chain in combinations(pieces, k):
            gains = [licenses.gain(p, q) for p, q in zip(chain, chain[1:], strict=False)]
            if all(gains):
                best = max(best, chain[0][1] - chain[0][0] + sum(gains))
    found = licenses.best_chains(pieces, lambda p: True)
    assert max((c for _, _, c in found), default=0) == best
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_against_plain_patterns(spark):
    random.seed(3)
    parts = ["password", "PassWord", "token", "api_key", "apikey", "secret", "=", ":", " ", "'", '"', "abc", "abcdef1", "x9", "AKIA", "ABCDEFGHIJKLMNOP12", "0123456789abcdef", "deadbeef", "é", "🙂", "\n", "-", "AKIAAKIA"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 25))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(texts)], SCHEMA)
    for r in secret_scan.secret_scan(docs).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == plain_secrets(texts[r.doc_id])
        for s in r.live:
            assert s.value_start < s.end and s in r.base


def test_secrets_ownership_and_redaction(spark):
    shared, own = "abcd1234efgh5678", "zyxw9876vuts5432"
    data = [(i, f"see password={shared} here", "en", f"s{i}", 40) for i in range(4)] + [(9, f"my token: {own} 🙂 end", "en", "s1", 40), (10, None, "en", None, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    live = {r.doc_id: [(s.value_start, s.end) for s in r.live] for r in secret_scan.secret_scan(docs).collect()}
    assert live[9] == [(10, 26)] and not any(live[i] for i in range(4))
    text = {r.doc_id: (r.text, r.n_chars) for r in secret_scan.redacted(docs, ["doc_id", "text", "lang", "source", "n_chars"]).collect()}
    assert text[0] == ("see [EXAMPLE] here", 18) and text[9] == ("my [SECRET] 🙂 end", 17) and text[10] == (None, None)


def test_secrets_held_by_one_owner_in_many_repositories(spark):
    data = [(i, "example token=abcd1234efgh5678", "en", "hot", 30) for i in range(120)] + [(500 + i, "own token=zyxw9876vuts5432", "en", "hot", 30) for i in range(20)]
    docs = spark.createDataFrame(data, SCHEMA)
    live = {r.doc_id: len(r.live) for r in secret_scan.secret_scan(docs).collect()}
    assert all(live[i] == (i >= 500) for i, *_ in data)


def plain_components(data, width=4, percent=85):
    sets = []
    for _, t in data:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(data):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(data))


@pytest.mark.parametrize("block,width,percent", [(4, 4, 85), (1024, 4, 85), (1024, 5, 80), (4, 2, 50)])
def test_jaccard_components_are_exact(spark, monkeypatch, block, width, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(random.choice(words) for _ in range(25))
    data = []
    for g in range(25):
        text = [random.choice(words) for _ in range(random.choice([3, 8, 40, 90]))] + (passage.split() if g % 3 == 0 else [])
        for _ in range(random.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                copy[random.randrange(len(copy))] = random.choice(words)
            data.append((len(data) * 3 + 1, " ".join(copy)))
    data += [(2, ""), (5, None), (8, "solo"), (11, "SOLO"), (14, "solo solo")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in data], SCHEMA)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, width, percent).collect())
    assert got == plain_components(data, width, percent)


@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-4, 4)), max_size=40), st.lists(st.integers(0, 40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_block_stream_in_any_batches(rows_, cuts):
    data = sorted((t, s, s + 10) for t, s in rows_)
    edges = sorted({0, len(data), *(min(c, len(data)) for c in cuts)})
    stream, got = jaccard_join.BlockStream(), []
    for a, b in zip(edges, edges[1:], strict=False):
        columns = [np.array([r[k] for r in data[a:b]], np.int64) for k in range(3)]
        got += zip(*(x.tolist() for x in stream.take(*columns)), strict=True)
    want = []
    for token in {t for t, _, _ in data}:
        sigs = sorted({s for t, s, _ in data if t == token})
        want += [(token, s, s + 10, sigs[0], sigs[0] + 10) for s in sigs if len(sigs) > 1]
    assert sorted(got) == sorted(want)


def test_signature_trees_lose_no_pair():
    random.seed(5)
    sets = [np.unique(np.array([random.randrange(1 << 62) for _ in range(n)], np.uint64)) for n in [20, 30, 33, 60] * 20]
    sets += [np.unique(np.append(s[: len(s) - 1], np.uint64(random.randrange(1 << 62)))) for s in sets]
    maps = [jaccard_join.bitmap(s) for s in sets]
    n = len(sets)
    got = {tuple(sorted(p)) for p in jaccard_join.block_pairs(np.arange(n), np.array(list(map(len, sets))), maps, np.arange(n), np.zeros(n, int), 0, 0)}
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert want and want <= got and len(got) <= 2 * len(want)


def test_sharding_counts_by_interval(spark):
    rng = random.Random(3)
    rows_ = [(rng.choice([-5, 0, 7, rng.randrange(-(2**63), 2**63)]), rng.randrange(-(2**63), 2**63), rng.randrange(1, 99)) for _ in range(700)]
    bounds = sorted({0, *(sharding.pack(h, d) for h, d, _ in rng.sample(rows_, 12))})
    got = {r["at"]: (r.c, r.n, tuple(r.least), tuple(r.most)) for r in sharding._counted(spark.createDataFrame(rows_, "h long, d long, size long").repartition(3), bounds)}
    want = {}
    for h, d, size in rows_:
        want.setdefault(sum(b <= sharding.pack(h, d) for b in bounds), []).append((h, d, size))
    assert got == {i: (len(x), sum(r[2] for r in x), min(r[:2] for r in x), max(r[:2] for r in x)) for i, x in want.items()}


def test_sharding_laws(spark):
    random.seed(2)
    texts = ["hot copy " * 20] * 300 + [f"text {i} " * random.randint(1, 40) for i in range(600)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = sharding.histogram_shards(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    total = sum(len(t) + 1 for t in texts)
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 0.05 * total / 8
    for r in got:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id].encode()))
    cut = {t for t in set(texts) if len({r.shard for r in got if texts[r.doc_id] == t}) > 1}
    assert cut <= {texts[0]}  # only the group that is larger than a shard


@given(st.binary(max_size=3000))
@settings(max_examples=50, deadline=None)
def test_audio_round_trip(data):
    text = data.decode("latin-1")
    p = audio.payload(text)
    assert len(p) % audio.UNIT == 0 and p.startswith(text.encode()) and set(p[len(text.encode()) :]) <= {255}
    assert audio.read_back(audio.store(p)) == p
    f = audio.features(p)
    tensor, pool_ms, spans = audio.unpack_tensor(audio.pack_tensor(f["tensor"], f["pool_ms"], f["segments"]))
    assert np.array_equal(tensor, f["tensor"]) and tensor.shape == (audio.POOLS, audio.MELS) and len(pool_ms) == audio.POOLS + 1
    assert audio.digest(f) == audio.digest(audio.features(p))


@pytest.mark.parametrize("units", [1, 2, 3, 5, 400])
def test_audio_frames_hold_the_last_samples(units):
    n = units * audio.UNIT
    quiet = np.full(n, 128, np.uint8)
    loud = quiet.copy()
    loud[-100:] = 128 + 100 * np.sin(np.arange(100))
    a, b = audio.log_mel(quiet.tobytes()), audio.log_mel(loud.tobytes())
    assert (len(a) - 1) * audio.HOP + audio.FRAME >= n * audio.UP / audio.DOWN
    assert not np.array_equal(a, b)
    assert audio.digest(audio.features(quiet.tobytes())) != audio.digest(audio.features(loud.tobytes())) or units == 400  # tenths of a long mean


@given(st.binary(max_size=30000))
@settings(max_examples=50, deadline=None)
def test_audio_feature_is_that_of_the_stored_tensor(data):
    row, stored, stream = audio.described(data.decode("latin-1"))
    f = audio.features(audio.read_back(stored))
    assert audio.read_features(stream)["frames"] == f["frames"] and row[-1] == audio.digest(audio.read_features(stream)) == audio.digest(f)


def test_audio_makes_the_tensor_of_every_row(monkeypatch):
    made, pack = [], audio.pack_tensor
    monkeypatch.setattr(audio, "pack_tensor", lambda t, *a: made.append(1) or pack(t + np.float32(1), *a))
    moved = audio.described("some text")[0][-1].split(";")[-1].split(",")
    monkeypatch.undo()
    plain = audio.described("some text")[0][-1].split(";")[-1].split(",")
    assert made == [1] and all(int(a) - int(b) in (9, 10, 11) for a, b in zip(moved, plain, strict=True))  # read from the stream


def test_audio_features_follow_the_sound():
    n = 24_000
    quiet, tone = np.full(n, 128), 128 + 100 * np.sin(2 * np.pi * 1000 * np.arange(n) / audio.RATE)
    samples = np.concatenate((quiet, tone, quiet)).astype(np.uint8).tobytes()
    f = audio.features(samples)
    assert len(f["segments"]) == 1
    start, end = f["segments"][0]
    assert abs(start - 1000) < 40 and abs(end - 2000) < 40
    mel = audio.log_mel(np.tile(tone, 1).astype(np.uint8).tobytes())
    peak = int(mel.mean(0).argmax())
    centre = audio.BANK[:, peak].argmax() * audio.RESAMPLED / audio.FFT
    assert abs(centre - 1000) < 200
    y = audio.resample(np.sin(2 * np.pi * 1000 * np.arange(3000) / audio.RATE))
    want = np.sin(2 * np.pi * 1000 * np.arange(2000) / audio.RESAMPLED)
    assert np.corrcoef(y[100:1900], want[100:1900])[0, 1] > 0.99


def plain_ngrams(text):
    """Buckets of a text, one n-gram after another."""
    codes, out = [ord(c) for c in (text or "").lower()], set()
    for n in toxicity.ORDERS:
        for i in range(len(codes) - n + 1):
            h = codes[i]
            for c in codes[i + 1 : i + n]:
                h = (h * 0x01000193 + c) % 2**32
            out.add(((h ^ n) * 2654435769 % 2**32) >> (32 - toxicity.BITS))
    return out


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_toxicity_ngrams(text):
    assert set(toxicity.present(text, np.zeros(1 << toxicity.BITS, bool)).tolist()) == plain_ngrams(text)


def test_toxicity_ngrams_across_slices(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefé🙂 ") for _ in range(500))
    monkeypatch.setattr(toxicity, "SLICE", 64)
    assert set(toxicity.present(text, np.zeros(1 << toxicity.BITS, bool)).tolist()) == plain_ngrams(text)


def test_toxicity_counts_ratios_and_scores(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["good", "fine", "day", "vile" if i % 3 == 0 else "nice"]) for _ in range(12)) for i in range(90)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in enumerate(texts)], SCHEMA)
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    used = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 4 != 2]
    from pyspark.sql import functions as F

    sample = docs.where(F.col("doc_id").isin(used)).select("text", (F.col("doc_id") % 3 == 0).cast("int").alias("y"), (F.col("doc_id") % 2).cast("int").alias("fold")).repartition(3)
    count, total = toxicity.counts(sample)
    want = Counter((i % 2, int(i % 3 == 0), b) for i in used for b in plain_ngrams(texts[i]))
    assert {tuple(map(int, k)): int(count[tuple(k)]) for k in np.argwhere(count)} == want
    assert total.tolist() == [[sum(i % 2 == f and int(i % 3 == 0) == y for i in used) for y in (0, 1)] for f in (0, 1)]
    ratio, _ = toxicity.ratios(count.sum(0), total.sum(0))
    for b in list({k[2] for k in want})[:50]:
        p = [(sum(want[f, y, b] for f in (0, 1)) + 1) / (total.sum(0)[y] + 2) for y in (0, 1)]
        assert abs(ratio[b] - np.log(p[1] / p[0])) < 1e-9
    weights, bias = toxicity.train(docs, labels)
    chosen = np.flatnonzero(weights)
    assert len(chosen) and set(chosen.tolist()) <= {k[2] for k in want}
    for r in toxicity.toxicity_scores(docs, (weights, bias)).collect():
        margin = bias + sum(float(weights[b]) for b in plain_ngrams(texts[r.doc_id]))
        assert abs(r.score - 1 / (1 + np.exp(-margin))) < 1e-6 and r.predicted == int(r.score >= 0.3)
    clear = [r for r in toxicity.toxicity_scores(docs, (weights, bias)).collect() if any(w in (texts[r.doc_id] or "") for w in ("vile", "nice"))]
    assert len(clear) > 70 and all((r.score >= 0.5) == ("vile" in texts[r.doc_id]) for r in clear)


def plain_tree(g, h):
    """Best of all ways to cut bins once, and each side once more, greedily by gain, value by value."""
    gain = lambda a, b: sum(g[a:b]) ** 2 / (sum(h[a:b]) + 1.0)
    out = [0.0] * len(g)

    def cut(a, b, depth):
        best = max(((gain(a, k) + gain(k, b), -k) for k in range(a + 1, b)), default=(-1, 0))
        if depth and best[0] > gain(a, b) + 1e-9:
            cut(a, -best[1], depth - 1), cut(-best[1], b, depth - 1)  # noqa: B018
        else:
            out[a:b] = [sum(g[a:b]) / (sum(h[a:b]) + 1.0)] * (b - a)

    cut(0, len(g), 2)
    return out


def test_quality_trees_and_quadrants():
    rng = np.random.default_rng(2)
    for _ in range(30):
        g, h = rng.normal(size=9), rng.random(9)
        assert np.allclose(quality._tree(g, h), plain_tree(g, h))
        g, h = rng.normal(size=(4, 5)), rng.random((4, 5))
        own, table = quality._quadrants(g, h)
        score = lambda a: a[0] ** 2 / (a[1] + 1.0)
        best = -1.0
        for i in range(1, 4):
            for j in range(1, 5):
                quads = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, 5)), (slice(i, 4), slice(0, j)), (slice(i, 4), slice(j, 5))]
                best = max(best, sum(score((g[q].sum(), h[q].sum())) for q in quads))
        assert abs(own - (best - score((g.sum(), h.sum())))) < 1e-9 and len(np.unique(table.round(12))) <= 4


def test_quality_features_and_sum_of_tables():
    text = "The cat | the cat. HELLO!! 42 $5 é\nthe cat\nthe cat"
    f = dict(zip(quality.FEATURES, quality.features(text), strict=True))
    words = text.split()
    assert f["log_chars"] == np.log1p(len(text)) and f["digit"] == 3 / len(text) and f["bar"] == 1 / len(text) and f["bang"] == 2 / len(text)
    assert f["distinct_words"] == len(set(words)) / len(words) and f["top_word"] == max(Counter(words).values()) / len(words)
    assert f["distinct_lines"] == 2 / 3 and f["line_words"] == len(words) / 3 and f["longest_word"] == 7
    assert f["upper"] == sum(c.isupper() for c in text) / sum(c.isalpha() for c in text)
    assert f["distinct_pairs"] == len(set(zip(words, words[1:], strict=False))) / (len(words) - 1)
    rng = np.random.default_rng(0)
    x = rng.random((300, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y, rounds=10, pair_rounds=30)
    for row, got in zip(x[:40], m.score(x[:40]), strict=True):
        bins = [sum(c <= v for c in m.cuts[i]) for i, v in enumerate(row)]
        margin = m.bias + sum(m.single[i][b] for i, b in enumerate(bins)) + sum(t[m.coarse[i][bins[i]]][m.coarse[j][bins[j]]] for i, j, t in m.pairs)
        assert abs(got - 1 / (1 + np.exp(-margin))) < 1e-9
    assert (0, 1) in [(i, j) for i, j, _ in m.pairs] and np.mean((m.score(x) > 0.5) == y) > 0.9  # only the pair tells
