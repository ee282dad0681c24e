import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from halyard.llm import chat_format, decontaminate, licences, license_scan, line_templates, media, quality, simhash, suffix_dedup, token_counts, trie_bpe
from halyard.llm.components import connected_components
from tests.llm.helpers import CASES, cases, empty

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aaabcde  the\n\tà你😀<s>01 =▁'\x85"


def by_case(df, columns):
    return sorted((repr(r["doc_id"]), *(repr(r[c]) for c in columns)) for r in df.collect())


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 120))) for _ in range(n)] + [t or "" for _, t in CASES]


# 9 token counts


def test_token_counts_equal_the_library():
    import sentencepiece

    own = random_texts(400, 1) + ["a" * 3000, " " * 700]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.counter(PIECES)(own) == [len(x) for x in model.encode(own)]


@pytest.mark.parametrize("letters", ["a", "ab", "the", "abcdefghijklmnopqrstuvwxyz", "你好是的一a😀é\x85"])
def test_long_pre_tokens_are_counted_as_the_library_does(letters, monkeypatch):
    import sentencepiece

    rng, model = random.Random(41), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = ["".join(rng.choice(letters) for _ in range(n)) for n in (2001, 2500, 9000)]
    assert token_counts.counter(PIECES)(own) == [len(x) for x in model.encode(own)]
    monkeypatch.setattr(token_counts, "LONG_WORD", 1)
    short = ["".join(rng.choice(letters) for _ in range(n)) for n in range(2, 90)]
    assert [token_counts.piece_table(PIECES).count_long("▁" + x) for x in short] == [len(x) for x in model.encode(short)]


def test_token_counts_of_every_case(spark):
    got = token_counts.count_tokens(cases(spark), PIECES, limit=20).collect()
    assert len(got) == len(CASES)
    for r in got:
        assert r["over_limit"] == (r["n_tokens"] > 20)
    assert sum(r["n_tokens"] == 0 for r in got) == 3
    assert token_counts.count_tokens(empty(spark), PIECES).count() == 0


# 10 encoding


def test_encoding_and_decoding_equal_the_library():
    from tokenizers import Tokenizer

    own, t, c = random_texts(400, 2), Tokenizer.from_file(WORDS), trie_bpe.codec(WORDS)
    ids = [x.ids for x in t.encode_batch(own, add_special_tokens=False)]
    assert c.encode(own) == ids
    assert c.decode(ids) == t.decode_batch(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["abcdefghijklmnopqrstuvwxyz", "ab", "e"])
def test_words_of_any_length_take_memory_in_proportion(word):
    import tracemalloc

    from tokenizers import Tokenizer

    rng, t, c = random.Random(4), Tokenizer.from_file(WORDS), trie_bpe.codec(WORDS)
    long = "".join(rng.choice(word) for _ in range(100_000))
    tracemalloc.start()
    got = c.encode([long, long[:50_000] + "q"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [x.ids for x in t.encode_batch([long, long[:50_000] + "q"], add_special_tokens=False)]
    assert peak < 300e6


def test_words_forgotten_between_batches_are_encoded_again(monkeypatch):
    from tokenizers import Tokenizer

    from halyard.llm.common import Remembered

    t, c = Tokenizer.from_file(WORDS), trie_bpe.Codec(WORDS)
    c.known = Remembered(2000)
    for seed in range(6):
        own = random_texts(40, seed % 3)
        assert c.encode(own) == [x.ids for x in t.encode_batch(own, add_special_tokens=False)]


def test_encoding_of_every_case(spark):
    got = trie_bpe.encode_decode(cases(spark), WORDS).collect()
    assert len(got) == len(CASES) and sum(len(r["ids"]) == 0 for r in got) == 4
    assert trie_bpe.encode_decode(empty(spark), WORDS).count() == 0


# 8 licences


def test_licence_places_equal_brute_force():
    a = license_scan.automaton(tuple(license_scan.PHRASES.items()), tuple(license_scan.NOTICES.items()), 3, 8, 0.6)
    rng = random.Random(3)
    vocab = sorted(a.vocab) + ["zz"] * 20 + ["cc", "by", "all", "rights", "reserved", "general", "public", "license"] * 9
    for _ in range(300):
        words = [rng.choice(vocab) for _ in range(60)]
        want = sorted((k, i) for k, p in enumerate(license_scan.PHRASES) for i in range(60) if words[i : i + len(p.split())] == p.split())
        assert sorted(a.scan(words)[0]) == want


def test_one_word_phrases_are_found():
    a = license_scan.automaton((("spdx", "spdx"), ("all rights", "reserved")), (), 3, 8, 0.6)
    assert sorted(a.scan("foo spdx bar all rights spdx".split())[0]) == [(0, 1), (0, 5), (1, 3)]


def brute_runs(words, template, least):
    """Maximal runs of words that stand consecutively in the template, of least words or more: (first, last) in words."""
    subs = {tuple(template[i:j]) for i in range(len(template)) for j in range(i + 1, len(template) + 1)}
    ends = [max((n for n in range(i + 2) if n == 0 or tuple(words[i + 1 - n : i + 1]) in subs), default=0) for i in range(len(words))]
    return [(i - n + 1, i) for i, n in enumerate(ends) if n >= least and (i + 1 == len(words) or ends[i + 1] <= n)]


@pytest.mark.parametrize("least", [2, 3])
def test_licence_spans_equal_brute_force_matching_statistics(least):
    """Spans begin and end with maximal runs, cover what the runs cover, and are all there where one run covers enough."""
    rng = random.Random(21)
    vocab = "a b c d e f".split()
    for _ in range(300):
        template = [rng.choice(vocab) for _ in range(rng.randint(4, 12))]
        words = [rng.choice([*vocab, "zz"]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.7:
            at, cut = rng.randint(0, len(words)), rng.randint(least, len(template))
            words[at:at] = template[:cut]
        a = license_scan.Automaton([("t", " ".join(template), False)], least, 4, 0.6)
        runs = brute_runs(words, template, least)
        spans = a.scan(words)[1]
        for _, first, last, share in spans:
            assert first in {x for x, _ in runs} and last in {y for _, y in runs}
            inside = [words[x : y + 1] for x, y in runs if first <= x and y <= last]
            reach = set()
            for run in inside:
                for at in range(len(template) - len(run) + 1):
                    if template[at : at + len(run)] == run:
                        reach |= set(range(at, at + len(run)))
            assert 0.6 <= share <= len(reach) / len(template) + 1e-9
        whole = [(x, y) for x, y in runs if (y - x + 1) / len(template) >= 0.6]
        for x, y in whole:
            assert any(first <= y and x <= last for _, first, last, _ in spans)


def test_licence_scores_and_labels_of_known_texts(spark):
    notice = license_scan.NOTICES["bsd"].split()
    texts = [" ".join(notice), " ".join(notice[: len(notice) // 2 - 3]), " ".join(notice[:6]) + " all rights reserved", "", " ".join(notice[:9] + ["zz"] * 3 + notice[9:])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(rows).collect()}
    assert (got[0]["labels"], got[0]["score"], got[0]["spans"][0]["first_word"], got[0]["spans"][0]["last_word"]) == ("bsd", 1.0, 0, len(notice) - 1)
    assert (got[1]["labels"], got[1]["score"]) == ("", 0.0)
    assert (got[2]["labels"], got[2]["score"]) == ("reserved", 1.0)
    assert (got[4]["labels"], got[4]["score"], got[4]["spans"][0]["last_word"]) == ("bsd", 1.0, len(notice) + 2)


def test_licence_templates_come_from_a_table(spark):
    table = spark.createDataFrame([("own", "these words make up a licence of our own making"), ("own", None), (None, "x y z")], "label string, text string")
    rows = spark.createDataFrame([(1, "See: these words make up a licence of our own making."), (2, license_scan.NOTICES["mit"])], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(rows, notices=license_scan.notice_table(table)).collect()}
    assert got == {1: "own", 2: ""}


def test_licence_notices_label_themselves_with_gaps():
    a = license_scan.automaton(tuple(license_scan.PHRASES.items()), tuple(license_scan.NOTICES.items()), 3, 8, 0.6)
    for label, notice in license_scan.NOTICES.items():
        words = license_scan.words_of("Before it. " + notice.upper() + " and after")
        assert label in {a.labels[t] for t, *_ in a.scan(words)[1]}
    words = license_scan.words_of("Redistribution and use in source and binary zz zz forms, with or without modification, are permitted")
    assert {a.labels[t] for t, *_ in a.scan(words)[1]} == {"bsd"}


def test_whole_licences_are_found_and_held_apart(spark):
    """Each whole licence, filled in, in lines and within other words, has its label and its span; a foreign text has none."""
    notices = license_scan.notice_table(license_scan.template_table(spark))
    assert set(notices) == {*license_scan.NOTICES, *licences.LICENCES}
    names = list(licences.LICENCES)
    bodies = ["Copyright (c) 2020 Some One\n\n" + licences.LICENCES[n].replace(". ", ".\n\n * ").lower() + "\nint main(void) { return 0; }" for n in names]
    rows = [*enumerate(bodies), (100, "the use of the software and the rights to copy it without warranty are for any person and for any purpose")]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices=notices).collect()}
    for i, name in enumerate(names):
        size = len(license_scan.words_of(licences.LICENCES[name]))
        span = max((s for s in got[i]["spans"] if s["label"] == name), key=lambda s: s["covered"])
        assert name in got[i]["labels"].split(",") and got[i]["score"] == 1.0
        assert span["covered"] == 1.0 and (span["first_word"], span["last_word"]) == (5, 4 + size)
    assert "bsd-3-clause" in got[names.index("bsd-2-clause")]["labels"]  # lacks a tenth of it
    assert {"mit", "as-is"} <= set(got[names.index("mit-license")]["labels"].split(","))  # its own words hide no notice
    assert "bsl-1.0" not in got[names.index("mit-license")]["labels"] and "isc-license" not in got[names.index("zlib-license")]["labels"]
    assert (got[100]["labels"], got[100]["score"]) == ("", 0.0)


def test_templates_hide_nothing_of_each_other():
    """Each template's spans are those of an automaton that holds it alone."""
    rng = random.Random(41)
    vocab = "a b c d e f".split()
    for _ in range(200):
        templates = [(f"t{k}", " ".join(rng.choice(vocab) for _ in range(rng.randint(4, 12))), False) for k in range(4)]
        templates.append(("t4", templates[0][1] + " a b " + templates[1][1], False))
        words = [rng.choice([*vocab, "zz"]) for _ in range(20)] + templates[4][1].split()[: rng.randint(3, 20)] + templates[2][1].split()
        both = license_scan.Automaton(templates, 2, 4, 0.6).scan(words)[1]
        for k, one in enumerate(templates):
            alone = license_scan.Automaton([one], 2, 4, 0.6).scan(words)[1]
            assert [s[1:] for s in both if s[0] == k] == [s[1:] for s in alone]


def test_whole_licence_spans_equal_brute_force_runs():
    """The query's templates: what spans cover is what brute-force maximal runs of a damaged licence cover."""
    rng = random.Random(31)
    for name in ("mit-license", "zlib-license", "apache-2.0-header"):
        template = license_scan.words_of(licences.LICENCES[name])
        a = license_scan.Automaton([(name, licences.LICENCES[name], False)], 3, 8, 0.6)
        for share in (0.0, 0.02, 0.05):
            words = ["before", *(w if rng.random() >= share else "zz" for w in template), "zz"]
            runs = brute_runs(words, template, 3)
            ((_, first, last, covered),) = a.scan(words)[1]
            inside = [(x, y) for x, y in runs if first <= x and y <= last]
            assert (first, last) == (min(x for x, _ in inside), max(y for _, y in inside))
            assert covered <= len({k for x, y in inside for k in range(x, y + 1)}) / len(template) + 1e-9 and (share or covered == 1.0)


def test_licences_of_every_case(spark):
    rows = cases(spark).unionByName(spark.createDataFrame([(9, "CC BY and All Rights Reserved. ALL RIGHTS RESERVED")], "doc_id long, text string"), allowMissingColumns=True)
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(rows).collect()}
    assert (got[9]["n_base"], got[9]["first_word"], got[9]["last_word"], got[9]["base_labels"]) == (3, 0, 6, "cc-by,reserved")
    assert (got[2]["n_words"], got[2]["labels"], got[2]["first_word"], got[2]["score"]) == (0, "", None, 0.0)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


# 7 media


def test_media_round_trip_of_every_case(spark):
    got = media.media_columns(cases(spark)).collect()
    assert len(got) == len(CASES)
    want = []
    for i, t in CASES:
        data = (t or "").encode()
        p = data + b" " * (max(1, math.ceil(len(data) / 192)) * 192 - len(data))
        want.append((repr(i), len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    assert sorted((repr(r["doc_id"]), r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == sorted(want)
    same = [r for r in got if r["doc_id"] in (1, 6)]
    assert len({(r["media_sha256"], r["shard"], r["offset"]) for r in same}) == 1
    assert media.media_columns(empty(spark)).count() == 0


def test_stored_pictures_and_features_equal_independent_ones(spark, tmp_path):
    root = f"file://{tmp_path}"
    got = media.media_columns(cases(spark), root=root).collect()
    for r, data in ((r, open(f"{tmp_path}/{r['shard']}", "rb").read()) for r in got):
        stored = data[r["offset"] : r["offset"] + r["length"]]
        assert hashlib.sha256(stored).hexdigest() == r["media_sha256"] and len(stored) == r["media_bytes"]
        at, packed = 8, b""
        while at < len(stored):
            n, kind = int.from_bytes(stored[at : at + 4], "big"), stored[at + 4 : at + 8]
            assert zlib.crc32(stored[at + 4 : at + 8 + n]) == int.from_bytes(stored[at + 8 + n : at + 12 + n], "big")
            packed += stored[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
            at += n + 12
        lines = zlib.decompress(packed)
        payload = b"".join(lines[i + 1 : i + 193] for i in range(0, len(lines), 193))
        assert hashlib.sha256(payload).hexdigest() == r["payload_sha256"]
        mean = sum(payload) / len(payload)
        spread = math.sqrt(sum((b - mean) ** 2 for b in payload) / len(payload))
        part = len(payload) // 64
        bits = "".join(str(int(sum(payload[k * part : (k + 1) * part]) / part > mean)) for k in range(64))
        assert r["feature"] == f"{len(payload) // 192}x192 mean={mean:.4f} std={spread:.4f} bright={int(bits, 2):016x}"


def test_headers_alone_give_metadata(spark, tmp_path):
    root = f"file://{tmp_path}"
    places = media.store_texts(cases(spark), root).select("digest", "shard", "offset", "length").distinct()
    got = media.read_media(places, root, headers_only=True).collect()
    assert got and all(r["width"] == media.ROW and r["media_bytes"] == r["length"] and r["payload_sha256"] is None for r in got)


# 5 SimHash


def brute_fingerprint(text, size=3):
    words = simhash.WORD.findall((text or "").encode().lower())
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((repr(d), f"{fps[i]:016x}", repr(least.get(root(i)))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("crowd", [32, 1])
def test_simhash_groups_equal_brute_force(spark, crowd):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))) for i in range(150)] + CASES
    base = " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(400))
    rows += [(1000 + i, base.replace("one", "ONE", i) + f" t{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_groups(df, crowd=crowd).collect()
    assert sorted((repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in got) == brute_groups(rows)


def test_links_equal_all_pairs_of_close_fingerprints(spark):
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = {s ^ (1 << rng.randrange(64)) * rng.randint(0, 1) ^ (1 << rng.randrange(64)) * rng.randint(0, 1) for s in seeds for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {frozenset((r["a"], r["b"])) for r in simhash.near_links(df, crowd=10**9).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want


def test_simhash_of_every_case_and_one_of_each_group(spark):
    docs = cases(spark)
    assert simhash.near_groups(docs).count() == len(CASES)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    # 1 and 6 are copies; 2, 3, 4 and a row without an id have no words; the other row without an id is alone
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(map(repr, [1, 2, 5, 8, None]))[:4] + ["None"]
    assert simhash.near_groups(empty(spark)).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(500, 500 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert got == want


# 2 suffix arrays


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((bytes(b for b, g in zip(t, gone, strict=True) if not g), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))))
    return out


@pytest.mark.parametrize(("kinds", "windows"), [(4096, 1_000_000), (3, 2000), (1, 2000)])
def test_repeats_equal_brute_force(spark, monkeypatch, kinds, windows):
    monkeypatch.setattr(suffix_dedup, "KINDS", kinds)
    monkeypatch.setattr(suffix_dedup, "TASK_WINDOWS", windows)
    rng = random.Random(8)
    base = [" ".join(rng.choice(["alpha", "beta", "delé", "x", "yy"]) for _ in range(120)) for _ in range(3)]
    rows = [(1, None), (None, base[0][:250]), (3, "ab" * 150), (4, base[0]), (4, base[0])]
    for i in range(60):
        b, p = rng.choice(base), rng.randrange(300)
        rows.append((10 + i, rng.choice([b[:p] + str(i) + b[p:], f"{i} " * 9 + b[p : p + 230] + " end"])))
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 200).collect()
    want = brute_repeats([(t or "").encode() for _, t in rows], 200)
    assert sorted((repr(r["doc_id"]), bytes(r["kept"]), len(r["spans"])) for r in got) == sorted((repr(i), k, n) for (i, _), (k, n) in zip(rows, want, strict=True))


@pytest.mark.parametrize("kinds", [512, 8])
def test_a_passage_in_many_contexts_equals_brute_force(spark, monkeypatch, kinds):
    """One anchor in very many different segments: passages shorter and longer than a window, each in a context of its own."""
    monkeypatch.setattr(suffix_dedup, "KINDS", kinds)
    rng = random.Random(18)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [some(n) for n in (60, 150, 199, 200, 203, 420)]
    rows = [(i, some(rng.randrange(40, 260)) + passages[i % 6] + some(rng.randrange(40, 260))) for i in range(150)]
    rows += [(1000 + i, rows[i][1]) for i in range(6)] + [(2000 + i, rows[6 * i][1][30:] + "!") for i in range(10)]
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 200).collect()
    want = brute_repeats([t.encode() for _, t in rows], 200)
    assert sorted((r["doc_id"], bytes(r["kept"]), len(r["spans"])) for r in got) == sorted((i, k, n) for (i, _), (k, n) in zip(rows, want, strict=True))


def test_pieces_are_few_rows_however_many_windows(spark):
    rng = random.Random(19)
    data = "".join(rng.choice("abcdefgh ") for _ in range(360)).encode()
    own, at, n, times, anchor, kind = suffix_dedup.block_segments(data, np.array([0, 360]), 200)
    rows = [(int(a), int(k[0]), int(k[1]), int(c), data[p : p + c + 199], 0, 168, None) for p, c, a, k in zip(at, n, anchor, kind, strict=True)]
    schema = suffix_dedup.SLICE + ", least int, most int, off int"
    df = spark.createDataFrame([(a, k, m, c, bytearray(d), x, y, z) for a, k, m, c, d, x, y, z in rows], schema)
    got = suffix_dedup.cut_again(df, 200).collect()
    assert len(got) <= 2 * len(rows) and sum(r["n"] for r in got) == 161
    for r in got:
        assert r["least"] <= r["off"] - r["n"] + 1 and r["off"] <= r["most"] and len(r["data"]) == r["n"] + 199


def test_blocks_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    texts = [bytes([65 + i]) * n for i, n in enumerate((0, 10, 64, 65, 300, 1))]
    seen = Counter()
    for who, at, data, bounds in suffix_dedup.blocks(texts, 20):
        for w, a, lo, hi in zip(who, at, bounds, bounds[1:], strict=False):
            piece = data[lo:hi]
            assert texts[w][a : a + len(piece)] == piece
            seen.update((w, a + i) for i in range(len(piece) - 19))
    assert seen == Counter((w, i) for w, t in enumerate(texts) for i in range(len(t) - 19))


def test_levels_grow_geometrically():
    family = suffix_dedup.IndexFamily(8)
    rng = np.random.default_rng(0)
    for _ in range(40):
        family.add([rng.integers(0, 256, 107, dtype=np.uint8).tobytes()], np.array([100]))
    sizes = [len(x) for x in family.levels]
    assert sum(sizes) == 4000 and len(sizes) <= 7 and all(2 * b <= a for a, b in zip(sizes, sizes[1:], strict=False))


@pytest.mark.parametrize("letters", [1, 2, 5, 256])
def test_suffix_order_equals_sorted_suffixes(letters):
    rng = np.random.default_rng(letters)
    for n, depth in ((1, 8), (7, 20), (300, 8), (900, 33), (900, 200), (2000, 50)):
        data = rng.integers(0, letters, n, dtype=np.uint8)
        data[n // 2 : n // 2 + n // 4] = data[: n // 4]
        order, rank = suffix_dedup.suffix_order(data, depth)
        assert sorted(order.tolist()) == list(range(n))
        order = [i for i in order.tolist() if i + depth <= n]
        key = {i: data[i : i + depth].tobytes() for i in order}
        assert [key[i] for i in order] == sorted(key.values())
        assert all((rank[i] == rank[j]) == (key[i] == key[j]) for i, j in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_levels_are_suffix_arrays_and_marks_equal_brute_force(letters):
    rng = np.random.default_rng(letters)
    family = suffix_dedup.IndexFamily(35)
    old = rng.integers(0, letters, 90, dtype=np.uint8).tobytes()
    parts, places = [], []
    for _ in range(12):
        some = []
        for _ in range(6):
            a, b = sorted(rng.integers(0, 91, 2).tolist())
            part = old[a:b] + rng.integers(0, letters, 60, dtype=np.uint8).tobytes()
            some.append(part)
        places += family.add(some, np.array([len(x) - 34 for x in some])).tolist()
        parts += some
    seen = Counter(x[i : i + 35] for x in parts for i in range(len(x) - 34))
    for x, p in zip(parts, places, strict=True):
        assert [seen[x[i : i + 35]] > 1 for i in range(len(x) - 34)] == family.again[p : p + len(x) - 34].tolist()
    held = []
    for level in family.levels:
        got = [family.data[w : w + 35].tobytes() for w in level.where]
        assert got == sorted(set(got)) and [x[:8] for x in got] == [int(h).to_bytes(8, "big") for h in level.head]
        held += got
    assert sorted(held) == sorted(seen)


def test_runs_of_few_bytes_are_few_rows(spark):
    """A megabyte of one byte, and of two: all goes, of a text with one window of it as well; no row for each window."""
    lone = "a lone text of which nothing stands anywhere else in the table, " + hashlib.sha256(b"lone").hexdigest() * 3
    rows = [(1, "-" * 1_500_000), (2, "ab" * 500_000 + "!"), (3, "x" + "-" * 200 + "y"), (4, "w" + "-" * 199), (5, lone), (6, "q" * 200), (7, "z" * 201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert suffix_dedup.segment_rows(docs.select(docs["doc_id"].alias("id"), "text"), 200).count() < 1000
    got = {r["doc_id"]: (bytes(r["kept"]), len(r["spans"])) for r in suffix_dedup.repeated_spans(docs, 200).collect()}
    assert got == {1: (b"", 1), 2: (b"!", 1), 3: (b"xy", 1), 4: (b"w" + b"-" * 199, 0), 5: (lone.encode(), 0), 6: (b"q" * 200, 0), 7: (b"", 1)}


def test_repeats_of_every_case(spark):
    got = suffix_dedup.repeated_spans(cases(spark), 40).collect()
    want = brute_repeats([(t or "").encode() for _, t in CASES], 40)
    assert sorted((bytes(r["kept"]), len(r["spans"])) for r in got) == sorted(want)
    assert suffix_dedup.repeated_spans(empty(spark)).count() == 0


def test_texts_without_ids_are_told_by_all_of_their_hash(spark):
    """Two texts without id whose hashes agree in 31 bits: the one has repeats, the other none."""
    seen, pair = {}, None
    for i in range(400_000):
        t = f"{i} " + "lone words that stand once, " * 2 + hashlib.sha256(str(i).encode()).hexdigest() * 4
        short = xxhash.xxh3_64_intdigest(t.encode()) & 0x7FFFFFFF
        if short in seen:
            pair = (seen[short], t)
            break
        seen[short] = t
    assert pair
    rows = [(None, pair[0]), (None, pair[1]), (7, pair[0][:280])] + [(None, f"{i} {hashlib.sha256(str(-i).encode()).hexdigest() * 4}") for i in range(300)]
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 200).collect()
    want = brute_repeats([t.encode() for _, t in rows], 200)
    assert sorted((repr(r["doc_id"]), bytes(r["kept"]), len(r["spans"])) for r in got) == sorted((repr(i), k, n) for (i, _), (k, n) in zip(rows, want, strict=True))


# 3 quality


def plain_shape(word):
    out = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not (out and out[-1] == k and k in "Aa0") and out[-3:] != [k] * 3:
            out.append(k)
    return "".join(out)


def test_words_are_shaped_whole():
    rng = random.Random(5)
    words = ["".join(rng.choice("aB3-.é你À٣😀") for _ in range(rng.choice((1, 5, 40, 80, 300)))) for _ in range(300)] + ["a" * 70 + "B", "a-" * 40 + "7", "." * 90 + "x", "A" * 64 + "-" * 9]
    assert [quality.shape(w) for w in words] == [plain_shape(w) for w in words]
    find = quality.Indicators()
    long = ["a" * 100 + "9", "a" * 100 + "-", "b" * 64 + "." * 4]
    assert len({tuple(find(w)) for w in long}) == 3 and not find.words and not find.shapes
    assert find(" ".join(long * 2)).tolist() == quality.Indicators()(" ".join(long * 2)).tolist()


def test_a_rare_class_is_in_the_sample(spark):
    """One row in a thousand, and a sample of forty: without its own share the class would all but surely be missed."""
    rng = random.Random(2)
    text = lambda good: " ".join("".join(rng.choice("aeiourst") for _ in range(5)) + ("" if good else "$$$") for _ in range(20))
    rare = {11, 502, 1777}
    docs = spark.createDataFrame([(i, text(i not in rare)) for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i not in rare)) for i in range(3000)], "doc_id long, quality int")
    assert all(zlib.crc32(str(i).encode()) % 5 for i in rare)
    model = quality.train(docs, labels, fit_rows=40)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert model.weight.any() and max(scores[i] for i in rare) < min(s for i, s in scores.items() if i not in rare)
    assert abs(model.b - quality.train(docs, labels, fit_rows=1 << 40).b) < 12  # a sample's odds are turned into those of all



def test_hinge_fit_reaches_the_optimum():
    rng = np.random.default_rng(1)
    y = rng.choice([-1.0, 1.0], 80)
    dense = rng.normal(size=(80, 5)) + 0.8 * y[:, None]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    w, b = quality.fit_hinge([(np.arange(5), r) for r in dense], y, np.full(80, 1.0), 5, passes=400)
    loss = lambda w, b: (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (dense @ w + b)).sum()
    best = loss(w, b)
    assert all(best <= loss(w + d[:5], b + d[5]) + 1e-2 for d in rng.normal(scale=0.05, size=(200, 6)))


def quality_tables(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("aeiourst") for _ in range(5)) for _ in range(rng.randint(3, 60))]
        docs.append((i, " ".join(words if good else [w + "$$$" for w in words])))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: q for i, q, _ in labels}


def test_the_filter_of_labels_loses_none(spark):
    assert [quality.filter_bits(n) for n in (0, 1000, 1 << 20, 1 << 40)] == [1 << 22, 1 << 22, 1 << 24, 1 << 27]
    rows = spark.range(0, 900).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    labelled = rows.where("doc_id % 3 = 0")
    kept = {r["doc_id"] for r in quality.indicator_rows(rows, quality.key_filter(labelled, "doc_id", 1 << 22)).collect()}
    assert {r["doc_id"] for r in labelled.collect()} <= kept and len(kept) < 320


def test_class_ratios_equal_a_direct_count(spark):
    docs, labels, truth = quality_tables(spark)
    model = quality.train(docs, labels)
    find, n, total = quality.Indicators(), {0: Counter(), 1: Counter()}, Counter()
    for r in docs.collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 5:
            n[truth[r["doc_id"]]].update(find(r["text"]))
            total[truth[r["doc_id"]]] += 1
    for b in range(quality.BUCKETS):
        seen = n[0][b] + n[1][b]
        want = math.log((n[1][b] + 1) / (total[1] + 2)) - math.log((n[0][b] + 1) / (total[0] + 2)) if seen > 1 else 0.0
        if seen or model.scale[b]:
            assert abs(model.scale[b] - want) < 1e-9


def test_scores_equal_a_slow_fit_end_to_end(spark):
    """The whole way again with plain loops: counts, scaled indicators, hinge loss by subgradients, sigmoid, scores."""
    docs, labels, truth = quality_tables(spark)
    model, find = quality.train(docs, labels), quality.Indicators()
    rows = sorted((r["doc_id"], find(r["text"])) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5)
    used = np.array(sorted({b for _, f in rows for b in f.tolist() if model.scale[b]}))
    x = np.zeros((len(rows), len(used) + 1))
    for i, (_, f) in enumerate(rows):
        x[i, :-1] = np.where(np.isin(used, f), model.scale[used], 0)
        x[i] /= max(1e-12, np.linalg.norm(x[i]))
    x[:, -1] = 1
    y = np.array([2.0 * truth[d] - 1 for d, _ in rows])
    w, mean, best = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.inf
    for t in range(1, 4001):
        g = w - (y[y * (x @ w) < 1, None] * x[y * (x @ w) < 1]).sum(axis=0)
        w = w - g / (t + 10)
        loss = w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()
        if loss < best:
            best, mean = loss, w.copy()
    own = np.r_[model.weight[used], model.bias]
    reached = own @ own / 2 + np.maximum(0, 1 - y * (x @ own)).sum()
    assert reached <= best * 1.02
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i, (d, _) in enumerate(rows):
        assert abs(got[d] - 1 / (1 + math.exp(-(model.a * (x[i] @ own) + model.b)))) < 1e-4
    assert np.corrcoef(x @ mean, x @ own)[0, 1] > 0.99


def test_quality_on_rows_held_out(spark):
    docs, labels, truth = quality_tables(spark)
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).withColumn("out", quality.held_out()).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r["out"]]
    assert len(out) > 40 and sum(r["predicted"] == truth[r["doc_id"]] for r in out) / len(out) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_never_sees_held_out_labels(spark):
    docs, labels, _ = quality_tables(spark)
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(a.weight, b.weight) and (a.a, a.b, a.bias) == (b.a, b.b, b.bias)


def test_quality_of_every_case(spark):
    docs, labels, _ = quality_tables(spark)
    model = quality.train(docs.unionByName(cases(spark), allowMissingColumns=True), labels.union(labels.limit(3)))
    assert quality.score(cases(spark), model).count() == len(CASES)
    kept = quality.keep_accepted(cases(spark), model)
    assert kept.columns == cases(spark).columns
    flat = quality.train(empty(spark), labels.limit(0))
    assert {r["score"] for r in quality.score(cases(spark), flat).collect()} == {0.5}
    assert quality.score(empty(spark), flat).count() == 0


# 4 chat


def test_chat_round_trip_with_attachments(spark):
    texts = ["a <turn:user> b", "\\l \\\\b > </turn>\n", "", None, "\\i0; é\n😀", "x" * 50_000]
    rows = [(1, n, "assistant" if n % 2 else "user", t) for n, t in enumerate(texts)] + [(1, 1, "assistant", texts[1])] + [(None, 0, None, "no id"), (2, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit("clash"))
    parts = F.flatten(F.array(
        chat_format.text_part(F.col("text")),
        F.when((F.col("conv_id") == 1) & (F.col("turn") < 2), F.from_json(F.lit('[{"kind":"image","ref":"u1","width":28,"height":15},{"kind":"audio","ref":"u2","seconds":1.0},{"kind":"other"},{"kind":"document","ref":"u3","pages":3}]'), f"array<{chat_format.PART_TYPE}>")).otherwise(F.array().cast(f"array<{chat_format.PART_TYPE}>")),
    ))
    out = chat_format.format_chats(df.withColumn("parts", parts)).withColumn("back", chat_format.read_back(F.col("formatted"))).withColumn("spans", chat_format.loss_spans(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("spans")))
    got = {r["conv_id"]: r for r in out.collect()}
    want = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1], r[2], r[3] or ""))
    one = got[1]
    assert [(t["role"], t["text"]) for t in one["back"]] == [(r[2], r[3] or "") for r in want]
    assert [(a["kind"], a["ref"], a["turn"], a["tokens"]) for a in one["attachments"]][:3] == [("image", "u1", 0, 4), ("audio", "u2", 0, 25), ("document", "u3", 0, 1536)]
    assert len(one["attachments"]) == 9 and one["expanded_tokens"] == 3 * (4 + 25 + 1536)
    assert one["formatted"].index("\\i0;") < one["formatted"].index("\\a1;") < one["formatted"].index("\\d2;") < one["formatted"].index("\\i3;")
    assert one["loss"] == "".join(r[3] or "" for r in want if r[2] == "assistant")
    marked = [one["formatted"][s["first"] : s["first"] + s["length"]] for s in one["spans"]]
    assert len(marked) == 4 and marked[-1] == "x" * 50_000
    assert [(t["role"], t["text"]) for t in got[None]["back"]] == [("", "no id")]
    assert chat_format.format_chats(df.limit(0).withColumn("parts", parts)).count() == 0


def test_masks_of_many_turns_lie_where_they_should(spark):
    rows = [(1, n, "assistant" if n % 3 else "user", f"<{n}>" * (n % 5)) for n in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text"))))
    r = out.withColumn("spans", chat_format.loss_spans(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("spans"))).first()
    want = [t.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g") for _, _, role, t in rows if role == "assistant"]
    assert [r["formatted"][s["first"] : s["first"] + s["length"]] for s in r["spans"]] == want
    assert r["loss"] == "".join(t for _, _, role, t in rows if role == "assistant")


# 6 decontamination


@pytest.mark.parametrize("chars", [decontaminate.BROADCAST_CHARS, 0])
def test_contained_items_equal_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", chars)
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 8, 20, 60])))) for i in range(25)] + [(90, None), (91, ""), (92, "?!")]
    docs = list(CASES)
    for n in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 90))]
        own = (rng.choice(items[:25])[1]).split()
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = "zz"
        docs.append((100 + n, " ".join(words[:40] + own + words[40:]).upper()))

    def runs(text, size):
        w = license_scan.words_of(text or "")
        return {" ".join(w[i : i + size]) for i in range(len(w) - size + 1)}

    want = set()
    for i, t in items:
        width = min(5, len(license_scan.words_of(t or "")))
        own = runs(t, width) if width else set()
        for d, text in docs:
            shared = len(own & runs(text, width)) if own else 0
            if own and shared >= math.ceil(0.8 * len(own) - 1e-9):
                want.add((d, i, len(own), shared))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)), spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit(2))
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in decontaminate.contained_items(df, bench).collect()}
    assert got == want and len(want) > 50
    bad = {d for d, *_ in want}
    kept = decontaminate.drop_contaminated(cases(spark).unionByName(df.where("doc_id >= 100"), allowMissingColumns=True), bench)
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(d) for d, _ in docs if d not in bad)
    assert decontaminate.contained_items(empty(spark), bench).count() == 0
    assert decontaminate.contained_items(df, bench.limit(0)).count() == 0


# 1 line templates


def brute_lines(rows, least_docs=3, leading=3, least_words=3, share=0.1):
    import re

    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = {}
    for d, (_, t) in enumerate(docs):
        for at, raw in enumerate(t.split("\n")):
            w = re.split(r"[ \t\r\f]+", re.sub(r"[^ \t\r\f]*[0-9][^ \t\r\f]*", "<*>", raw.strip(" ")))
            if len(w) >= least_words:
                lines[d, at] = (len(w), *w[:leading]), tuple(w)
    kinds = {}
    for (d, _), k in lines.items():
        kinds.setdefault(k, set()).add(d)
    leaf_docs, words = Counter(), Counter()
    for (leaf, w), ds in kinds.items():
        leaf_docs[leaf] += len(ds)
        for p, x in enumerate(w):
            words[leaf, p, x] += len(ds)
    told = {}
    for k, (leaf, w) in lines.items():
        if leaf_docs[leaf] < least_docs:
            continue
        common = tuple((p, x) for p, x in enumerate(w) if x != "<*>" and words[leaf, p, x] >= least_docs)
        wide = tuple((p, x) for p, x in common if words[leaf, p, x] >= share * leaf_docs[leaf])
        several = sum(1 for lf, _ in kinds if lf == leaf) > 1
        said = lambda t: sum(p >= leading for p, _ in t)
        enough = [t for t in (wide, common) if several and said(t) and said(t) >= 0.5 * (len(w) - leading)]
        told[k] = (leaf, enough[0] if enough else w)
    docs_of = {}
    for (d, at), t in told.items():
        docs_of.setdefault(t, set()).add(d)
    gone = {}
    for t, ds in docs_of.items():
        if len(ds) >= least_docs:
            for k in sorted(k for k, x in told.items() if x == t)[1:]:
                gone.setdefault(k[0], set()).add(k[1])
    text_of = {r: "\n".join(x for at, x in enumerate(r[1].split("\n")) if at not in gone.get(d, ())) for d, r in enumerate(docs)}
    return sorted((repr(i), repr(text_of.get((i, t), t))) for i, t in rows)


def test_templates_equal_brute_force(spark):
    rng = random.Random(12)
    rows = list(CASES[:4]) + [(6, CASES[5][1])] * 2
    for i in range(60):
        lines = [f"user {rng.choice(['ann', 'bob', 'cy'])} logged in from host{rng.randrange(9)} at port {rng.randrange(99)}", "All  rights reserved by us", " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))]
        rows.append((100 + i, "\n".join(rng.sample(lines, rng.randint(1, 3)))))
    for i in range(90):  # fields whose values come to three documents each; starts in common with nothing after them
        rows.append((500 + i, f"this page was edited by {chr(97 + i % 15)}x {chr(97 + i // 15)}y at once\nso it was {chr(97 + i % 20)}{chr(97 + i % 9)}{chr(97 + i % 7)}"))
    got = line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=3).collect()
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in got) == brute_lines(rows)
    assert sum(r["_dropped"] for r in got) > 60


def test_templates_of_every_case(spark):
    docs = cases(spark).withColumn("_dropped", F.lit("old"))
    out = line_templates.drop_templates(docs, min_docs=2)
    assert out.count() == len(CASES) and set(out.columns) == {*docs.columns, "_lines"}
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"]}
    assert (got[1]["_dropped"], got[6]["_dropped"], got[6]["text"], got[2]["text"]) == (0, 2, "", None)
    assert line_templates.drop_templates(empty(spark)).count() == 0


def test_all_of_a_template_goes_if_asked(spark):
    docs = spark.createDataFrame([(i, f"the same old line {i}\nown{i} words are here") for i in range(5)], "doc_id long, text string")
    left = {r["text"].count("\n") for r in line_templates.drop_templates(docs, keep_first=False).collect()}
    assert left == {0}
