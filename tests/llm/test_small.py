"""Every operator on a small hostile table: nulls in any column, empty, blank
and very long texts, repeated rows, ties, clashing column names; and on an
empty one."""

import collections
import re
import tempfile
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from voxtab.llm import bpe, exact_dedup, lang_id, license_scan, mixing, pii, quality_rules, simhash_dedup, toxicity, url_filter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, quality string, ids string, score string, "
    "license string, mix string, entities string, lang_pred string, evidence string, filter string, fp string, `a.b` string, _text string"
)
EXTRA = ("x",) * 12
GOOD = "The quick brown fox jumps over the lazy dog near the old river bank. It was a fine day for all of us there."


def _rows():
    rng = np.random.default_rng(7)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    word = lambda: "".join(rng.choice(letters, rng.integers(2, 9)))
    long = ".\n".join(" ".join(word() for _ in range(12)) for _ in range(4000)) + "."
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, "a", 4), (4, GOOD, "en", None, 5),
        (5, GOOD, "en", "a", 5), (5, GOOD, "en", "a", 5), (None, GOOD, "en", "a", 5), (None, "solo " + GOOD, "en", "a", None),
        (None, "solo " + GOOD, "en", "a", None), (8, GOOD.replace(" ", " \t"), "en", "b", 5), (9, long, "en", "b", len(long)),
        (10, "word " * 500, "de", "b", 2500), (11, "ÄÖÜ ß Straße größer\n" * 3, "de", "b", 60), (12, "١٢٣ ???", "de", "b", 7),
        (13, "call +1 (555) 123-4567 or mail a.b@x.example.org", "en", "c", 47), (14, GOOD + " extra", "en", "c", 9),
    ]
    rows += [(100 + i, " ".join(word() for _ in range(int(rng.integers(1, 60)))) + ".", "en", "c", 1) for i in range(40)]
    return [r + EXTRA for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality(docs, empty):
    got = quality_rules.judge(docs).select("doc_id", "text", "_quality.*").collect()
    assert len(got) == docs.count()
    for r in got:
        w = WORD.findall(r.text or "")
        windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        exp = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(cover))
        assert exp == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert r.kept is False or not r.base_failed
    kept = {r.doc_id for r in got if r.kept}
    assert {4, 5, 8, 9, 14} <= kept and not {1, 2, 3, 10, 12} & kept
    cleaned = quality_rules.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == sum(r.kept for r in got)
    assert quality_rules.clean(empty).collect() == []


def test_quality_lines(spark):
    bad = ["Home | News | About | Contact", "BUY NOW AND SAVE MONEY TODAY FRIENDS OF OURS", "win## big** cash$$ now&&", "Accept all cookies.",
           "go go go go go go go go go go.", "Menu"]
    other = "Some rivers run south while others wander about, slowly filling every lake that they find on their way to an open sea."
    text = "\n".join([GOOD, *bad[:3], "", other, *bad[3:]])
    df = spark.createDataFrame([(1, text), (2, "\n".join(bad * 2 + [GOOD]))], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.judge(df).select("doc_id", "quality.*").collect()}
    assert got[1].kept and got[1].cleaned == "\n".join([GOOD, "", other])
    assert not got[2].kept and got[2].loss > 0.5 and got[2].cleaned == GOOD


def test_exact(docs, empty):
    rows = exact_dedup.dedup_table(docs).collect()
    assert len(rows) == docs.count() and sum(r.kept for r in rows) == len({bytes(r.digest) for r in rows})
    for digest in {bytes(r.digest) for r in rows}:
        group = [r for r in rows if bytes(r.digest) == digest]
        ids = [r.doc_id for r in group if r.doc_id is not None]
        keep = min(ids) if ids else None
        assert all(r.group_size == len(group) and r.keep_id == keep for r in group)
        assert [r.doc_id for r in group if r.kept] == [keep]
    stay = exact_dedup.drop_repeats(docs)
    assert stay.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in stay.collect()))) == sorted(map(str, (r.doc_id for r in rows if r.kept)))
    assert exact_dedup.dedup_table(empty).collect() == [] and exact_dedup.drop_repeats(empty).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 3000):
        choice, base = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64)
        table, slots = exact_dedup.displacements(choice, base)
        assert sorted(slots) == list(range(n))
        at = exact_dedup._place(base, table[(choice % np.uint64(len(table))).astype(np.int64)], n)
        assert (at == slots).all()


def test_history_and_batch(spark):
    old = spark.createDataFrame([(5, "x"), (7, "y"), (3, "x")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "x"), (9, "z"), (8, "z"), (2, None)], "doc_id long, text string")
    rows = exact_dedup.dedup(exact_dedup.digests(old), exact_dedup.digests(new).withColumn("row", F.col("row") + (1 << 50)))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.seen_before) for r in rows.collect()}
    assert got[1] == (3, 3, False, True)  # history wins, whatever the id
    assert got[5] == (3, 3, False, False) and got[3] == (3, 3, True, False) and got[7] == (7, 1, True, False)
    assert got[9] == (8, 2, False, False) and got[8] == (8, 2, True, False) and got[2] == (2, 1, True, False)


def _fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _components(values, limit):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= limit:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def test_simhash(docs, empty):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = simhash_dedup.components(docs).collect()
    fps = [_fingerprint(t) for _, t in texts]
    assert sorted((str(d), f & (2**64 - 1)) for d, f in zip((r.doc_id for r in got), (r.fp for r in got))) == sorted(
        (str(d), f) for (d, _), f in zip(texts, fps)
    )
    roots = _components(fps, 4)
    least = {}
    for (d, _), r in zip(texts, roots):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    exp = collections.Counter((d, least[r]) for (d, _), r in zip(texts, roots))
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == exp
    stay = simhash_dedup.drop_near_copies(docs)
    ids = [r.doc_id for r in stay.collect()]
    assert stay.columns == docs.columns and sorted(x for x in ids if x is not None) == sorted({v for v in least.values() if v is not None})
    assert ids.count(None) == len({f for (d, _), f, r in zip(texts, fps, roots) if least[r] is None})
    assert simhash_dedup.components(empty).collect() == [] and simhash_dedup.drop_near_copies(empty).collect() == []


@pytest.mark.parametrize(("bands", "shard"), [(3, 16), (1, 64), (5, 8), (3, 4096)])
def test_links_equal_brute_force(spark, bands, shard):
    rng = np.random.default_rng(bands)
    base = rng.integers(0, 2**63, 250, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 250, dtype=np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 7)), replace=False)) for x in base for _ in range(2)]
    dense = [int(base[0]) ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]  # a crowd inside one shard
    values = sorted({*map(int, base), *near, *dense})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, bands, shard).collect()
    at = {v: i for i, v in enumerate(signed)}
    for e in edges:
        assert e.src in at and e.dst in at
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        a, b = sorted((root(at[e.src]), root(at[e.dst])))
        parent[b] = a
    assert [root(i) for i in range(len(values))] == _components(values, 4)


def test_bpe(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), bpe.Vocabulary.load(path)
    library.no_truncation()
    library.no_padding()
    import unicodedata

    rng = np.random.default_rng(5)
    known = [c for c in range(1, 0x1FFFF) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    odd = ["", " ", "It's 12 o'clock, we'LL go<|endoftext|>on", "<|startoftext|><|endoftext|>", "<|endoftext", "a\x1cb\x85c d", "ΑΣ ΣΑΣ İ ﬁ é", "x" * 5000]
    odd += ["".join(chr(known[i]) if rng.random() < 0.7 else rng.choice([" ", "'s", "the", "<|endoftext|>"]) for i in rng.integers(0, len(known), 30)) for _ in range(300)]
    df = docs.select("text", "ids").union(spark.createDataFrame([(t, "x") for t in odd], "text string, ids string"))
    got = bpe.decode(bpe.encode(df, mine), mine).collect()
    assert len(got) == df.count()
    assert sorted(map(str, bpe.round_trip(df, mine).collect())) == sorted(map(str, got))
    for r in got:
        exp = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == exp and r.decoded == library.decode(exp, skip_special_tokens=False), r.text
    assert bpe.encode(empty, mine).collect() == []


def test_a_piece_is_merged_once(monkeypatch):
    """Also where it stands in different words; and the tables hold short keys only, at most twice their bound."""
    mine = bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    made = []
    monkeypatch.setattr(mine, "piece", lambda p: made.append(p) or bpe.Vocabulary.piece(mine, p))
    encode = bpe.encoder(mine)
    encode("Zorblax zorblax, zorblax. (zorblax) zorblax*** 'zorblax ***")
    assert collections.Counter(made)["zorblax"] == 1 and len(made) == len(set(made))
    table = bpe.Recent(str.encode, 5)
    for i in range(40):
        for key in (f"a{i}", "b", "c" * 5000):
            assert table(key) == key.encode()
    assert len(table.known) <= 5 and len(table.older) <= 5 and max(map(len, [*table.known, *table.older])) < 100 and "b" in table.known


def test_ids_do_not_depend_on_the_tables(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), bpe.Vocabulary.load(path)
    library.no_truncation()
    library.no_padding()
    rng = np.random.default_rng(35)
    marks = ["", ",", ".", "***", "'s", "2024", "<|endoftext|>", "é", "x" * 90]
    texts = [" ".join("".join(rng.choice(list("aeinrst"), 6)) + marks[i] for i in rng.integers(0, len(marks), 60)) for _ in range(30)]
    exp = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for words, pieces, kept in ((75_000, 200_000, 64), (3, 2, 64), (50, 1, 3), (1, 50, 0)):
        for name, value in (("CACHE_WORDS", words), ("CACHE_PIECES", pieces), ("KEPT_CHARS", kept)):
            monkeypatch.setattr(bpe, name, value)
        encode = bpe.encoder(mine)
        assert [np.frombuffer(encode(t), np.int32).tolist() for t in texts * 2] == exp * 2


def test_merge_equals_greedy_loop():
    mine = bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(9)
    for _ in range(200):
        raw = bytes(rng.choice(list(b"aeinorst"), int(rng.integers(1, 25))).tolist())
        symbols = [mine.inner[b] for b in raw[:-1]] + [mine.last[raw[-1]]]
        slow = list(symbols)
        while True:
            ranked = [(mine.ranks[p], i) for i, p in enumerate(zip(slow, slow[1:])) if p in mine.ranks]
            if not ranked:
                break
            r, i = min(ranked)
            slow[i : i + 2] = [mine.made[r]]
        assert mine.merge(symbols) == slow


def test_licenses(docs, empty):
    scanner = license_scan.Scanner(license_scan.rules())
    got = license_scan.scan(docs).select("doc_id", "text", "license.*").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    texts = ["cc by cc by, CC-BY", "All rights reserved. all  RIGHTS-reserved", "the GNU General Public License v3", "cc\nby general public license", "ccby", "é cc by"]
    for t in texts:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        at = sorted((i, x) for p, x in license_scan.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        r = license_scan.scan_text(t, scanner)
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert license_scan.scan(empty).collect() == []


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("released under the MIT License", {"mit"}),
        ("under the GNU Lesser General Public License, version 2.1", {"lgpl-2.1", "gpl"}),
        ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
        ("dedicated to the public domain", {"public-domain"}),
        ("nothing here", set()),
    ],
)
def test_license_rules(text, labels):
    got = license_scan.scan_text(text, license_scan.Scanner(license_scan.rules()))
    assert set(filter(None, got["labels"].split(","))) == labels


def _example(parsed, rng):
    """A text that a parsed expression fits, gaps and options by chance."""
    out = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out.append(chr(arg))
        elif op == "ANY":
            out.append("z")
        elif op == "IN":
            some = [chr(v) if str(o) == "LITERAL" else {"CATEGORY_SPACE": "\n", "CATEGORY_DIGIT": "7"}.get(str(v), "z") if str(o) == "CATEGORY" else chr(v[0]) for o, v in arg]
            out.append(some[int(rng.integers(len(some)))])
        elif op == "BRANCH":
            out.append(_example(arg[1][int(rng.integers(len(arg[1])))], rng))
        elif op == "SUBPATTERN":
            out.append(_example(arg[-1], rng))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += [_example(arg[2], rng) for _ in range(int(rng.integers(arg[0], min(int(arg[1]), arg[0] + 3) + 1)))]
        else:
            assert op in ("AT", "ASSERT_NOT"), op
    return "".join(out)


def test_keywords_never_lose_a_match():
    rng = np.random.default_rng(10)
    rules = license_scan.rules()
    scanner = license_scan.Scanner(rules)
    compiled = [(re.compile(r.expression, re.S), r) for r in rules]
    for pattern, rule in compiled:
        for _ in range(30 if rule.priority < 100 else 3):
            text = f" {_example(re._parser.parse(rule.expression, re.S), rng)} "
            if pattern.search(text):
                assert scanner.keywords(text) >= set(rule.keyword.split()), (rule, text)
    wrapped = ["apache\n * license, version 2.0", "released under the mit\nlicense", "gnu general\n * public  license\n# version 3", "dual-licenced under", "2-clause license"]
    for text in [*wrapped, "permission is\n// hereby granted, free of charge, to any person obtaining a copy"]:
        every = license_scan.resolve([(m.start(), m.end(), r) for p, r in compiled for m in p.finditer(text)])
        assert scanner.detections(text) == every and every, text


def test_containment_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        hits = []
        for i in range(12):
            a = int(rng.integers(0, 30))
            hits.append((a, a + int(rng.integers(1, 10)), license_scan.Rule(f"l{i}", int(rng.integers(0, 3)), 0.5, "", "")))
        ranked, kept = sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label)), []
        for h in ranked:
            if not any(k[0] <= h[0] and h[1] <= k[1] for k in kept):
                kept.append(h)
        assert license_scan.resolve(hits) == sorted(kept, key=lambda h: (h[0], h[1], h[2].label))


def test_language(spark, docs, empty):
    en = "the quick brown fox and the lazy dog were there with thing nothing everything".split()
    de = "der schnelle braune fuchs und die faulen hunde waren schlicht einfach nicht dort".split()
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(en if i % 2 else de, 20)), "en" if i % 2 else "de") for i in range(200)]
    train = spark.createDataFrame(rows + [(None, None, "en"), (1000, "x", None)], "doc_id long, text string, lang string")
    model = lang_id.fit(train)
    asked = ["the fox", "der hund und einfacher", "nothings", None, "", "12 !?", "٣٣", "漢字", "dorthin schlichte"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(asked)], "doc_id long, text string, score string")
    got = [r.lang_pred for r in lang_id.predict(df, model).orderBy("doc_id").collect()]
    assert got == ["en", "de", "en", "und", "und", "und", "und", "de", "de"]  # unseen script: most rows, then the smaller name
    out = lang_id.predict(docs, lang_id.fit(docs)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert lang_id.predict(empty, lang_id.fit(empty)).collect() == []
    assert {r.lang_pred for r in lang_id.predict(docs, lang_id.fit(empty)).collect()} == {"und"}


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(6)
    n, terms, k = 700, 40, 15
    dense = np.where(rng.random((n, terms)) < 0.08, rng.random((n, terms)), 0.0)
    norm = np.sqrt((dense**2).sum(1, keepdims=True))
    dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
    who, term = np.nonzero(dense)
    index = toxicity.Index.build(np.arange(n), np.zeros(n), term, who, dense[who, term], terms)
    for q in range(0, n, 7):
        at = np.flatnonzero(dense[q])
        near, sims = index.nearest(at, dense[q, at], k, without=[q])
        s = dense @ dense[q]
        s[q] = 0
        order = np.lexsort((np.arange(n), -np.round(s, 9)))
        exp = [i for i in order[:k] if s[i] > 0]
        assert near.tolist() == exp and np.allclose(sims, s[exp])


def test_nearest_with_rare_and_frequent_terms():
    rng = np.random.default_rng(16)
    n, terms, k = 900, 400, 15
    dense = np.where(rng.random((n, terms)) < 0.6 / np.arange(1, terms + 1) ** 0.7, rng.random((n, terms)), 0.0)
    dense[:, -1] = dense[:, -2] = 0
    dense[5:40] = dense[3]  # a crowd of equal examples
    dense /= np.maximum(np.sqrt((dense**2).sum(1, keepdims=True)), 1e-12)
    who, term = np.nonzero(dense)
    index = toxicity.Index.build(np.arange(n), np.zeros(n), term, who, dense[who, term], terms)
    assert 0 < len(index.dense[1]) < terms - 100
    for q in range(0, n, 9):
        at = np.flatnonzero(dense[q])
        near, sims = index.nearest(at, dense[q, at], k, without=[q])
        s = np.round(dense @ dense[q], 9)
        s[q] = 0
        exp = [i for i in np.lexsort((np.arange(n), -s))[:k] if s[i] > 0]
        assert near.tolist() == exp and np.allclose(sims, s[exp])


def test_nearest_of_unlike_groups():
    """Groups with words of their own: each is multiplied with little more than its own rows, and no neighbour is missed."""
    rng = np.random.default_rng(23)
    n, terms, k = 2400, 900, 15
    own = np.arange(n) % 4  # 200 words of its own for each group, 100 for all, of any frequency
    share = np.where(np.arange(terms)[None, :] // 200 == own[:, None], 0.9, 0.0) * rng.random(terms)[None, :]
    share[:, 800:] = 0.3 * rng.random(100) ** 3
    dense = np.where(rng.random((n, terms)) < share * rng.choice([0.5, 1.0], (n, 1)), rng.random((n, terms)), 0.0)
    dense[40:80] = dense[36]  # a crowd of equal examples
    dense[90] = 0
    dense /= np.maximum(np.sqrt((dense**2).sum(1, keepdims=True)), 1e-12)
    who, term = np.nonzero(dense)
    index = toxicity.Index.build(np.arange(n), np.zeros(n), term, who, dense[who, term], terms)
    tiles = index.tiles
    assert sorted(tiles.order) == list(range(n)) and tiles.slot[tiles.order].tolist() == list(range(n))
    assert 0 < sum(rows.size for *_, rows in tiles.blocks) < 0.6 * index.dense[1].size
    assert sum((rows > 0).sum() for *_, rows in tiles.blocks) + len(tiles.at) == len(who)  # every posting, once
    asked = rng.choice(n, 300, replace=False)
    starts = np.r_[0, np.cumsum((dense[asked] > 0).sum(1))]
    at = np.concatenate([np.flatnonzero(dense[q]) for q in asked])
    got = index.nearest_all(starts, at, np.concatenate([dense[q][dense[q] > 0] for q in asked]), k, [[q] for q in asked])
    for q, (near, sims) in zip(asked, got, strict=True):
        s = np.round(dense @ dense[q], 9)
        s[q] = 0
        exp = [i for i in np.lexsort((np.arange(n), -s))[:k] if s[i] > 0]
        assert near.tolist() == exp and np.allclose(sims, s[exp])


def test_scores_do_not_depend_on_the_cell(monkeypatch):
    rng = np.random.default_rng(29)
    times = np.where(rng.random((700, 80)) < 0.2, rng.integers(1, 4, (700, 80)), 0)
    times[9] = 0
    term, example = np.nonzero(times.T)
    starts = np.searchsorted(term, np.arange(81))
    model = toxicity.Model(None, np.linspace(0.5, 3, 80), np.arange(700), np.arange(700) % 2, starts, example, times[example, term], 0.25, np.array([0.0, 1.0]), np.array([0.0, 1.0]), {b"5": [5]})
    who, at = np.nonzero(times)
    ends = np.searchsorted(who, np.arange(701))
    found = []
    for cell in (256, 40):
        monkeypatch.setattr(toxicity, "CELL", cell)
        found.append([(s, ids.tolist(), sims.tolist()) for s, ids, sims in model.score(ends, at, times[who, at], [str(i).encode() for i in range(700)])])
    assert found[0] == found[1] and len(found[0]) == 700
    assert found[0][9] == (0.25, [], []) and 5 not in found[0][5][1] and found[0][6][1][0] == 6


def _posted_model(n: int, terms: int, held: float) -> toxicity.Model:
    rng = np.random.default_rng(31)
    lists = [np.sort(rng.choice(n, 1 + rng.binomial(n - 1, held * (8 if t % 50 == 0 else 1)), replace=False)) for t in range(terms)]
    example = np.concatenate(lists).astype(np.uint16)
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    times = rng.integers(1, 9, len(example)).astype(np.uint16)
    return toxicity.Model(None, np.linspace(0.5, 3, terms), np.arange(n), np.arange(n) % 2, starts, example, times, 0.25, np.array([0.0, 1.0]), np.array([0.0, 1.0]), {})


def test_an_index_keeps_its_tiles_only():
    """Beside the tiles no array of all postings is kept, not even by a view, and making them takes no more than a few bytes a posting."""
    model = _posted_model(2000, 30_000, 0.05)
    n = len(model.example)
    tracemalloc.start()
    try:
        tiles = model.index.tiles
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    arrays = [tiles.order, tiles.slot, tiles.frequent, tiles.centre, tiles.starts, tiles.at, tiles.weight]
    held = sum(x.nbytes for x in arrays) + sum(row.nbytes + rows.nbytes for _, _, row, rows in tiles.blocks)
    assert n > 3_000_000 and kept - held < n and peak - held < 16 * n


def test_tiles_do_not_depend_on_the_run(monkeypatch):
    model = _posted_model(800, 300, 0.05)
    made = []
    for run in (1 << 18, 700, 1):
        monkeypatch.setattr(toxicity, "RUN", run)
        model.__dict__.pop("index", None)
        made.append(model.index.tiles)
    for tiles in made[1:]:
        for name in ("order", "slot", "frequent", "starts", "at"):
            assert np.array_equal(getattr(tiles, name), getattr(made[0], name)), name
        assert np.allclose(tiles.weight, made[0].weight, rtol=1e-12)
        for (*a, rows), (*b, others) in zip(tiles.blocks, made[0].blocks, strict=True):
            assert a[:2] == b[:2] and np.array_equal(a[2], b[2]) and np.allclose(rows, others, rtol=1e-12)


def test_terms_are_counted_as_a_plain_loop_does(monkeypatch):
    texts = [None, "", " 12_3 ", "Straße STRASSE straßen²_x ½tasse", "ΟΔΟΣ ὀδός ΟΔΟΣ.", "İstanbul ıslak “quoted” words’ ends", "a\u2028b\xa0c\x85d\x1ce", "𝐀𝐁𝐂𝐃𝐄𝐅 名前名前名前 mañana-mañana", "one two one " * 40, "ÀÉÎ àéîõü ÀÉÎÕÜß"]
    words = [[w for w in toxicity.WORD.findall(t.lower())] if t else [] for t in texts]
    found = [collections.Counter(x for w in ws for x in [w, *(w[:k] + "*" for k in toxicity.STEMS if len(w) > k)]) for ws in words]
    known = sorted(set().union(*found))[::2]
    assert [toxicity.terms(t) for t in texts] == [set(f) for f in found]
    for piece in (toxicity.PIECE, 20):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        for names in (known, []):
            starts, at, n = toxicity.count(pa.array(texts), pa.array(names, pa.large_string()))
            got = [list(zip(at[s:e].tolist(), n[s:e].tolist(), strict=True)) for s, e in zip(starts, starts[1:], strict=False)]
            assert got == [[(i, f[x]) for i, x in enumerate(names) if x in f] for f in found]
    assert len(toxicity.count(pa.array([], pa.string()), pa.array(known, pa.large_string()))[0]) == 1


def test_dense_shards_are_cut_on_both_sides(spark):
    """All fingerprints alike in one band: no cell far above a usual one, and every pair meets once."""
    rng = np.random.default_rng(34)
    fps = np.unique(rng.integers(0, 1 << 42, 700, dtype=np.int64) << 21)
    rows = [(int(f), 5, i % 3 > 0) for i, f in enumerate(fps.tolist())] + [(int(f), 6, True) for f in fps[:40].tolist()] + [(1, 6, False)]
    routed = spark.createDataFrame(rows, "fp long, shard long, visit boolean")
    dealt = simhash_dedup.deal(routed, 16).collect()
    cells = collections.defaultdict(lambda: ([], []))
    for r in dealt:
        cells[r.shard, r.first, r.second][r.visit].append(r.fp)
    assert max(len(h) for h, _ in cells.values()) <= 2 * 16 and max(len(v) for _, v in cells.values()) <= 2 * 8 * 16
    met = collections.Counter()
    for (shard, first, second), (home, visit) in cells.items():
        met.update((shard, *sorted((a, b))) for a in home for b in visit)
        if first == second:
            met.update((shard, *sorted((a, b))) for i, a in enumerate(home) for b in home[:i])
    exp = collections.Counter()
    for shard in (5, 6):
        home, visit = ([f for f, s, v in rows if s == shard and v == w] for w in (False, True))
        exp.update((shard, *sorted((a, b))) for a in home for b in visit)
        exp.update((shard, *sorted((a, b))) for i, a in enumerate(home) for b in home[:i])
    assert met == exp and set(met.values()) == {1}


def test_isotonic():
    x, y = np.array([0.1, 0.1, 0.4, 0.5, 0.9]), np.array([0.0, 1.0, 0.0, 1.0, 1.0])
    knots, values = toxicity.isotonic(x, y, np.ones(5))
    assert (np.diff(values) >= 0).all() and np.allclose(np.interp([0.1, 0.4, 0.5, 0.9], knots, values), [1 / 3, 1 / 3, 1, 1])


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(8)
    words = [f"w{c}{d}" for c in "abcdefgh" for d in "ijklmnop"]
    rows = [(i, " ".join([*rng.choice(words, 30), *(["vileword"] * 2 if i % 5 == 0 else [])])) for i in range(300)]
    df = spark.createDataFrame(rows + [(None, None), (999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)] + [(None, 1), (3, None), (7, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all((got[i].score >= 0.7) == (i % 5 == 0) for i in range(300))
    assert got[999].evidence == [] and got[None].score < 0.5 and all(e.toxic for e in got[205].evidence)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []
    assert len(toxicity.score(docs, toxicity.fit(docs, labels)).collect()) == docs.count()


def test_toxicity_uses_all_words(spark):
    """Cosines over every word of the other examples, also where most labels are toxic and a word tells nothing of them."""
    rng = np.random.default_rng(18)
    words = [f"{a}{b}x" for a in "abcdef" for b in "ghijklmn"]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    assert set(model.number) == {w for _, t in rows[:80] for w in t.split()}
    tf = np.array([[t.split().count(w) for w in words] for _, t in rows], float)
    df_ = (tf > 0).sum(0)
    v = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * np.log(1.01 * (len(rows) + 1) / (df_ + 1 + 0.01 * len(rows)))
    v /= np.sqrt((v**2).sum(1, keepdims=True))
    for r in toxicity.score(df, model).collect():
        best = np.sort(v[[i for i in range(80) if i != r.doc_id]] @ v[r.doc_id])[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose([e.similarity for e in r.evidence], best)


def test_toxicity_never_by_the_own_label(spark):
    """Turning a text's label, in every copy of it, leaves its neighbours as they are, and never among them itself."""
    rng = np.random.default_rng(28)
    words = [f"{a}{b}y" for a in "abcdef" for b in "ghijklmn"]
    rows = [(i, " ".join(rng.choice(words, 12))) for i in range(60)]
    rows += [(100, rows[7][1]), (101, " ".join(reversed(rows[7][1].split()))), (102, rows[8][1] + " " + words[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for flag in (0, 1):
        labels = spark.createDataFrame([(i, flag if i in (7, 100, 101) else i % 2) for i, _ in rows], "doc_id long, toxic int")
        got = {r.doc_id: r.evidence for r in toxicity.score(df, toxicity.fit(df, labels)).collect()}
        found.append([got[i] for i in (7, 100, 101)])
        assert {e.doc_id for e in got[8]} >= {102} and all(d not in {e.doc_id for e in got[d]} for d, _ in rows)
    assert found[0] == found[1] and len({tuple(e) for e in map(tuple, found[0])}) == 1
    assert not {7, 100, 101} & {e.doc_id for e in found[0][0]}


def _listed(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "nohost", "http://", "http://A.Example.ORG/es/1", "https://example.org/en/17", "https://example.org/en/2", "ftp://x.com/fr/",
    "https://notexample.org", "https://example.org", "http://y.com/de/x?q=1#f", "http://É.com/de/", "http://a.com://b.org/", "http://u\nv.com/fr/",
    "https://spam.net/buy/1?ref=9", "http://com/fr/", "x" * 20000 + "://deep.org/" + "a/" * 3000,
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[4], "x", "y"), (None, None, None, None)], "page_id long, url string, host string, filter string")
    train = [(f"https://spam.net/buy/{i}?ref={i}", "block") for i in range(30)] + [(f"https://good.net/read/{i}", "allow") for i in range(30)]
    labelled = spark.createDataFrame(train, "url string, verdict string")
    got = url_filter.judge(pages, labelled).select("page_id", "url", "_filter.*").collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = _listed(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or (r.mined.verdict if r.mined else "allow"))
    assert next(r for r in got if r.url and "spam" in r.url).verdict == "block"
    none = url_filter.judge(pages.limit(0), labelled.limit(0))
    assert none.collect() == []
    assert {r.verdict for r in url_filter.judge(pages.where("url LIKE '%spam%'"), labelled.limit(0)).select("_filter.*").collect()} == {"allow"}


def test_rules_equal_counting(spark):
    rng = np.random.default_rng(4)
    rows = [([f"t{j}" for j in np.flatnonzero(rng.random(6) < 0.5)], "block" if rng.random() < 0.4 else "allow") for _ in range(300)]
    found = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.5, 1.0, 2).collect()
    base = collections.Counter(v for _, v in rows)
    from itertools import combinations

    exp = {}
    for size in (1, 2):
        for items in combinations([f"t{j}" for j in range(6)], size):
            hit = [v for t, v in rows if set(items) <= set(t)]
            for v in ("allow", "block"):
                n = hit.count(v)
                if n >= 15 and n / len(hit) >= 0.5 and n / len(hit) * 300 >= base[v]:
                    exp[items, v] = n / len(hit)
    pruned = {(i, v): c for (i, v), c in exp.items() if not (len(i) == 2 and any(exp.get(((x,), v), -1) >= c for x in i))}
    assert {(tuple(r["items"]), r.verdict): pytest.approx(r.confidence) for r in found} == pruned
    assert all(r.rarest in r["items"] for r in found)


def test_rules_of_any_length_and_share(spark):
    """Sure only by four tokens together; and nearly all labels block."""
    from itertools import combinations

    rng = np.random.default_rng(13)
    rows = [[f"t{j}" for j in np.flatnonzero(rng.random(5) < 0.75)] for _ in range(600)]
    rows = [(t, "block" if {"t0", "t1", "t2", "t3"} <= set(t) or rng.random() < 0.45 else "allow") for t in rows]
    found = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.02).collect()
    exp = {}
    for size in range(1, 6):
        for items in combinations([f"t{j}" for j in range(5)], size):
            hit = [v for t, v in rows if set(items) <= set(t)]
            for v in ("allow", "block"):
                if hit.count(v) >= 12 and hit.count(v) / len(hit) >= 0.6:
                    exp[items, v] = hit.count(v) / len(hit)
    covered = lambda i, v, c: any(exp.get((p, v), -1) >= c for n in range(1, len(i)) for p in combinations(i, n))
    pruned = {(i, v): c for (i, v), c in exp.items() if not covered(i, v, c)}
    assert {(tuple(r["items"]), r.verdict): pytest.approx(r.confidence) for r in found} == pruned
    assert pruned[("t0", "t1", "t2", "t3"), "block"] == 1.0
    train = spark.createDataFrame([(f"https://a{i}.net/x", "allow" if i < 4 else "block") for i in range(100)], "url string, verdict string")
    got = url_filter.judge(spark.createDataFrame([("https://new.net/x",)], "url string"), train).first()
    assert got["filter"].verdict == "block"


def test_template_tokens_are_one(spark):
    """Thirty tokens of one template would make 2^30 sets; verdicts equal those of single tokens."""
    keys = [f"k{a}{b}=v" for a in "abcdef" for b in "ghijk"]
    urls = [(f"https://shop{i}.net/list/{'x' if i % 3 else 'y'}?{'&'.join(keys)}", "block" if i % 3 else "allow") for i in range(30)]
    train = spark.createDataFrame(urls + [(f"https://blog{i}.net/p", "allow") for i in range(20)], "url string, verdict string")
    asked = ["https://new.net/list/x", "https://new.net/z/x?kbh=v", "https://new.net/z?kfk=v&kah=v", "https://new.net/p"]
    got = {r.url: r["filter"] for r in url_filter.judge(spark.createDataFrame([(u,) for u in asked], "url string"), train).collect()}
    assert [got[u].verdict for u in asked] == ["block", "block", "block", "allow"]
    assert got[asked[2]].mined["items"] == ["query=kah=v"]
    assert all(set(got[u].mined["items"]) <= set(t) for u, t in _tokens(spark, asked))


def _tokens(spark, urls):
    found = url_filter.parsed(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    return [(r.url, r.tokens) for r in found]


def test_merged_rules_equal_all_rules(spark):
    """Matching by classes finds what matching every token set does."""
    rng = np.random.default_rng(24)
    rows = []
    for i in range(150):
        parts = [f"a{j}&b{j}&c{j}" if j < 2 else f"a{j}" for j in np.flatnonzero(rng.random(5) < 0.5)]
        rows.append((f"http://h{i}.net/?" + "&".join(parts), "block" if rng.random() < 0.45 else "allow"))
    train = spark.createDataFrame(rows, "url string, verdict string")
    asked = [f"http://z{i}.net/?" + "&".join(x for x in [f"{c}{j}" for j in range(5) for c in "abc"] if rng.random() < 0.3) for i in range(60)]
    pages = spark.createDataFrame([(u,) for u in asked], "url string")
    got = {r.url: r["filter"].mined for r in url_filter.judge(pages, train, min_support=0.05).collect()}
    known = train.join(url_filter.parsed(train.select("url")).select("url", "tokens"), "url")
    rules = [(set(r["items"]), r) for r in url_filter.mine(known, 0.05).collect()]
    for url, tokens in _tokens(spark, asked):
        fits = [(-r.confidence, -r.support, r.n_items, r["items"], r.verdict) for items, r in rules if items <= set(tokens)]
        assert (got[url] is None) == (not fits)
        if fits:
            best = min(fits)
            m = got[url]
            assert (-m.confidence, -m.support, len(m["items"]), m["items"], m.verdict) == best


def test_mixing(docs, empty):
    got = mixing.mix(docs, budget=0.5).select("doc_id", "_mix.*").collect()
    assert len(got) == docs.count() and all(0 <= r.probability <= 1 and r.sampled == (r.draw < r.probability) for r in got)
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert all(r.n_tokens == words[r.doc_id] for r in got if r.doc_id is not None)
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.mix(empty).collect() == [] and mixing.sample(empty).collect() == []


def test_raking_equals_numpy(spark):
    rng = np.random.default_rng(3)
    t = rng.integers(1, 100, (3, 2, 4))
    cells = [(f"s{i}", f"l{j}" if j else None, f"t{k}", int(t[i, j, k])) for i in range(3) for j in range(2) for k in range(4)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": {"s0": 0.5, "s1": 0.2}, "lang": 0.5, "topic": 0.25}
    got = {(r.source, r.lang, r.topic): r for r in mixing.probabilities(mixing.rake(df, targets), 0.4).collect()}
    lang, topic = t.sum((0, 2)) ** 0.5, t.sum((0, 1)) ** 0.25
    goals = [np.array([0.5, 0.2, 0.3]), lang / lang.sum(), topic / topic.sum()]
    w = t.astype(float)
    for _ in range(200):
        for axis, goal in enumerate(goals):
            others = tuple(a for a in range(3) if a != axis)
            w *= np.expand_dims(goal / w.sum(others), others)
    exp = {c[:3]: w[int(c[0][1]), int(c[1] is not None), int(c[2][1])] for c in cells}
    assert all(abs(got[k].weight - v) < 1e-3 for k, v in exp.items())
    assert abs(sum(r.probability * r.tokens for r in got.values()) - 0.4 * t.sum()) < 1e-6 * t.sum()


def test_drawn_tokens_meet_targets(spark):
    rng = np.random.default_rng(21)
    pick = lambda names, p: rng.choice(names, 6000, p=p).tolist()
    kinds = {"prose": "plain words only", "markup": "### head words", "contact": "call +1 ( words"}
    topic = pick(list(kinds), [0.94, 0.04, 0.02])
    rows = [(i, f"{kinds[k]} " + "word " * int(rng.integers(5, 25)), a, b)
            for i, (k, a, b) in enumerate(zip(topic, pick(["s0", "s1", "s2"], [0.9, 0.07, 0.03]), pick(["en", "de"], [0.8, 0.2])))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"s0": 0.5, "s1": 0.3, "s2": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"prose": 0.6, "markup": 0.25, "contact": 0.15}}
    got = mixing.mix(df, targets=targets, budget=0.8).select("source", "lang", "mix.*").toPandas()
    assert (got["expected"] > 1).any() and (got["sampled"] == (got["copies"] > 0)).all()
    got["drawn"] = got["copies"] * got["n_tokens"]
    assert abs(got["drawn"].sum() / got["n_tokens"].sum() - 0.8) < 0.02
    for d, shares in targets.items():
        have = got.groupby(d)["drawn"].sum() / got["drawn"].sum()
        assert all(abs(have[k] - v) < 0.02 for k, v in shares.items()), (d, have.to_dict())
    assert mixing.sample(df, targets=targets, budget=0.8).count() == got["copies"].sum()


def test_pii(docs, empty):
    got = pii.pseudonymise(docs)
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, (r.doc_id for r in docs.collect())))
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1].text is None and by_id[4].text == GOOD
    assert "123-4567" not in by_id[13].text and "a.b@x" not in by_id[13].text and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or mail \w\.\w@\w\.\w{7}\.org", by_id[13].text)
    assert pii.pseudonymise(empty).collect() == []


def test_surrogates(spark):
    names = ["Mr John Smith", "Mrs. Jane Smith", "Herr Smith", "Госпожа Анна Петрова", "Κυρία Μαρία Νικολάου"]
    numbers = [f"10.0.{i // 250}.{i % 250}" for i in range(400)]
    texts = [f"{n} wrote to x{i}@corp.example.com" for i, n in enumerate(names)] + [f"from {n}." for n in numbers]
    texts += ["card 4111 1111 1111 1111 or 4111111111111111", 'token = "' + "AB12" * 10 + '"', "call +1 (555) 010-9999", "call 1-555-010-9999? +1 (555) 010-9999!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(df).collect()}
    smith = {got[i].split(" wrote")[0].split()[-1] for i in range(3)}
    assert len(smith) == 1 and "Smith" not in smith  # one surname, one surrogate
    assert got[0].startswith("Mr ") and got[1].startswith("Mrs. ") and got[0].split()[1] in pii.FIRST["latin"]["m"] and got[1].split()[1] in pii.FIRST["latin"]["f"]
    assert re.match(r"Госпожа [а-яА-Я]+ [а-яА-Я]+ wrote", got[3]) and got[3].split()[1].startswith(tuple(pii.FIRST["cyrillic"]["f"].split()))
    assert len({re.search(r"@(\S+)", got[i])[1] for i in range(5)}) == 1  # one domain
    ips = [got[5 + i][5:-1] for i in range(400)]
    assert len(set(ips)) == 400 and not set(ips) & set(numbers)
    a, b = re.findall(r"\d[\d ]{14,18}\d", got[405])
    digits = [int(c) for c in a.replace(" ", "")]
    luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    assert a.replace(" ", "") == b and a != "4111 1111 1111 1111" and luhn % 10 == 0
    assert re.fullmatch(r'token = "[0-9A-F]{40}"', got[406]) and "AB12AB12" not in got[406]
    assert got[407][5:] in got[408]  # the same number, written alike
    again = {r.doc_id: r.text for r in pii.pseudonymise(df.repartition(5)).collect()}
    assert again == got


def test_pipeline(spark):
    folder = tempfile.mkdtemp(prefix="voxtab-test-", dir="/tmp")
    rows = [(i, f"{GOOD} Number {w} came along with {w}{w} today. " + " ".join(f"{w}{c}" for c in "abcdefghijklm") + ".", "en", f"s{i % 3}", 9)
            for i, w in enumerate("anna bob carl dora emil fritz gustav hans ida jutta".split())]
    rows += [(50, rows[0][1], "en", "s0", 9), (51, None, "en", "s0", 0), (52, "short", "en", "s0", 5), (None, rows[1][1], None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] == {*range(10), 50, None} and kept[1] == set(range(10)) and kept[2] <= kept[1] and kept[3] <= kept[2] and kept[4] == kept[3]
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == kept[4]
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").collect() == []


def test_texts_share_the_table_of_the_vocabulary(monkeypatch):
    """A table of all terms is made once for many texts, wherever they are counted, and the counts are those of single texts."""
    calls, plain = [], toxicity.pc.index_in
    monkeypatch.setattr(toxicity.pc, "index_in", lambda *a, **k: calls.append(1) or plain(*a, **k))
    texts = pa.array([f"word{'abc'[i % 3]} other{'xy'[i % 2]}" for i in range(2000)])
    vocabulary = pa.array(["othe*", "otherx", "worda", "wordb"], pa.large_string())
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    found = list(toxicity._count_known("text", vocabulary)(iter([batch])))
    assert {r["term"]: r["n"] for b in found for r in b.to_pylist()} == {0: 2000, 1: 1000, 2: 667, 3: 667}
    assert len(calls) == 1
