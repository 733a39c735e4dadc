"""SuperMinHash near-dedup, ranked search and spelling variants against plain
versions, on hostile tables and on crowded buckets, shards and blocks."""

import binascii
import collections
import math
import re

import numpy as np
import pytest

from voxtab.llm import lang_id, license_scan, minhash_dedup, mixing, pii, ranked_search, spelling

from .test_small import EXTRA, SCHEMA, _rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- SuperMinHash ---


def _one_by_one(elements, slots):
    """The published sequential form with its histogram and early stop."""
    h, q, p, b, a = [None] * slots, [-1] * slots, list(range(slots)), [0] * slots, slots - 1
    b[-1] = slots
    for i, d in enumerate(elements):
        j = 0
        while j <= a:
            z = int(minhash_dedup.draw(np.array([d], np.uint64), j)[0])
            k = j + (((z & 0xFFFFFFFF) * (slots - j)) >> 32)
            for x in (j, k):
                if q[x] != i:
                    q[x], p[x] = i, x
            p[j], p[k] = p[k], p[j]
            v, old = (j << 32) | (z >> 32), h[p[j]]
            if old is None or v < old:
                was = slots - 1 if old is None else min(old >> 32, slots - 1)
                h[p[j]] = v
                if j < was:
                    b[was] -= 1
                    b[j] += 1
                    while b[a] == 0:
                        a -= 1
            j += 1
    return h


@pytest.mark.parametrize("n", [1, 2, 7, 60, 500])
def test_signatures_equal_the_sequential_form(n):
    rng = np.random.default_rng(n)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(3)]
    got = minhash_dedup.signatures(np.concatenate(sets), np.repeat(np.arange(3), n), 3)
    assert [[int(x) for x in row] for row in got] == [_one_by_one(s, minhash_dedup.SLOTS) for s in sets]


def test_equal_slots_estimate_the_similarity_with_less_variance():
    rng, errors, ranks = np.random.default_rng(3), [], 128
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 90).astype(np.uint64)
        a, b = pool[:60], pool[30:]
        s = minhash_dedup.signatures(np.concatenate([a, b]), np.repeat([0, 1], 60), 2)
        errors.append((s[0] == s[1]).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < (1 / 3) * (2 / 3) / ranks * 0.85  # independent hashes: p(1-p)/slots


def _sets(rows, k):
    out = []
    for r in rows:
        w = WORD.findall(_lower(r.text))
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def _plain_components(rows, k, near=80):
    sets, root = _sets(rows, k), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= near * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(find(i), []).append(r.doc_id)
    name = {g: min((d for d in ids if d is not None), default=None) for g, ids in least.items()}
    return [(r.doc_id, len(sets[i]), name[find(i)]) for i, r in enumerate(rows)]


def _key(row):
    return tuple((x is None, x or 0) for x in row)


def test_minhash_on_a_hostile_table(docs, empty):
    got = minhash_dedup.components(docs, shingle=4)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert sorted((tuple(r)[:3] for r in rows), key=_key) == sorted(_plain_components(docs.collect(), 4), key=_key)
    assert minhash_dedup.components(empty).count() == 0


def test_minhash_loses_no_link_in_crowded_buckets(spark, monkeypatch):
    """Chains of edits (a bucket's leader is not near all members), and texts
    that share most of a common passage without being near."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    monkeypatch.setattr(minhash_dedup, "PACK", 4000)
    monkeypatch.setattr(minhash_dedup, "CELLS", 1000)
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows, base = [], [word() for _ in range(200)]
    for _ in range(60):  # a walk: neighbours are near, its ends are not
        rows.append(list(base))
        base[int(rng.integers(0, 200))] = word()
        base[int(rng.integers(0, 200))] = word()
    passage = [word() for _ in range(80)]
    rows += [passage + [word() for _ in range(60)] for _ in range(60)]
    rows += [[word() for _ in range(int(rng.integers(1, 30)))] for _ in range(40)]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(4)
    got = sorted(tuple(r)[:3] for r in minhash_dedup.components(table).collect())
    assert got == sorted(_plain_components(table.collect(), 5))
    assert len({c for *_, c in got}) < len(rows)


# --- ranked search ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _plain_search(rows, queries, k=10):
    held = [(r.doc_id, collections.Counter(TERM.findall(_lower(r.text)))) for r in rows]
    full = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(full), sum(n for *_, n in full)
    df = collections.Counter(t for _, c, _ in full for t in c)
    out = []
    for item, text in queries:
        asked, scored = collections.Counter(TERM.findall(_lower(text))), []
        for d, c, n in full:
            m = 25 + (75 * n * n_docs) // total
            s = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += times * w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else d, -s))
    return sorted(out, key=_key)


QUERIES = [
    (1, "The quick brown fox"), (2, None), (3, "!!"), (4, "Straße GRÖSSER größer ß"), (1, "The quick brown fox"),
    (5, "lazy dog lazy DOG extra solo word word"), (None, "river bank 555 4567"),
]


def test_search_on_a_hostile_table(spark, docs, empty):
    queries = spark.createDataFrame([(i, t, "x") for i, t in QUERIES], "item_id long, text string, score string").coalesce(1)
    got = sorted((tuple(r) for r in ranked_search.search(docs, queries).collect()), key=_key)
    assert got == _plain_search(docs.collect(), QUERIES)
    assert ranked_search.search(empty, queries).count() == 0
    assert ranked_search.search(docs, queries.limit(0)).count() == 0
    assert ranked_search.search(empty, queries).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("rows,vocabulary", [(16, 8192), (64, 40), (1024, 8192)])
def test_search_equals_brute_force_over_shards_and_batches(spark, monkeypatch, rows, vocabulary):
    monkeypatch.setattr(ranked_search, "ROWS", rows)
    monkeypatch.setattr(ranked_search, "VOCABULARY", vocabulary)
    rng = np.random.default_rng(11)
    vocab = ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(300)]
    p = 1 / np.arange(1, 301)
    p /= p.sum()
    texts = [" ".join(rng.choice(vocab, int(rng.integers(3, 80)), p=p)) for _ in range(500)]
    texts += texts[:20] * 8  # copies tie
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    asked = [(i, " ".join(rng.choice(vocab, 12, p=p))) for i in range(15)]
    queries = spark.createDataFrame(asked, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked_search.search(table, queries).collect()), key=_key)
    assert got == _plain_search(table.collect(), asked)


def test_search_skips_blocks_by_exact_bounds():
    rng = np.random.default_rng(2)
    centres = (rng.random((20, 60)) < 0.2) * rng.integers(1000, 100000, (20, 60))
    impacts = np.repeat(centres, 30, axis=0).astype(np.int32)
    impacts[rng.random(impacts.shape) < 0.05] = 0
    weight = rng.integers(100, 9000, 60)
    shard = ranked_search.Shard(list(range(600)), impacts, weight)
    for lo, hi, docs in zip(shard.starts, shard.ends, shard.most, strict=True):
        held = shard.docs[lo:hi]
        assert (docs == shard.impacts[held].max(axis=0)).all()
    best, asked = ranked_search.Best(10), np.flatnonzero(centres[3])
    shard.search(asked, weight[asked], best)
    scores = impacts[:, asked].astype(np.int64) @ weight[asked]
    assert best.rows == sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:10]
    assert 0 < shard.visited < len(shard.starts) / 4


# --- spelling variants ---


def _plain_words(rows):
    n = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = _lower(run)
            h = binascii.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def _one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain_variants(n):
    near = {w: [v for v in n if _one_apart(w, v)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def _words_table(spark):
    rng, rows = np.random.default_rng(9), []
    base = ["".join(rng.choice(list("abcdefghistéü"), int(rng.integers(7, 12)))) for _ in range(60)]
    for i in range(400):
        some = list(rng.choice(base, 40))
        for j in range(0, 40, 5):  # own misspellings of each kind
            w, at = some[j], int(rng.integers(0, len(some[j])))
            some[j] = (w[:at] + "x" + w[at:], w[:at] + w[at + 1 :], w[:at] + "x" + w[at + 1 :])[int(rng.integers(0, 3))]
        rows.append((i, " ".join(x.upper() if rng.random() < 0.2 else x for x in some)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_spelling_on_a_hostile_table(docs, empty):
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == _plain_variants(_plain_words(docs.collect()))
    assert spelling.variants(empty).count() == 0


@pytest.mark.parametrize("homes,block", [(1 << 15, 1 << 16), (200, 1 << 16), (40, 16), (3, 7)])
def test_spelling_equals_brute_force_at_any_shard_size(spark, monkeypatch, homes, block):
    monkeypatch.setattr(spelling.near, "__defaults__", (homes, block, 2 * block))
    monkeypatch.setattr(spelling, "LEAF", 1 if homes < 100 else 128)
    table = _words_table(spark)
    want = _plain_variants(_plain_words(table.collect()))
    assert any(w[1] for w in want)
    assert sorted(tuple(r) for r in spelling.variants(table).collect()) == want


@pytest.mark.parametrize("a,b,near", [("abc", "abc", 0), ("abc", "ab", 1), ("abc", "xabc", 1), ("abc", "axc", 1), ("abc", "acb", 0),
                                      ("aab", "ab", 1), ("", "a", 1), ("ab", "ba", 0), ("abcd", "ab", 0)])
def test_one_apart(a, b, near):
    assert spelling.one_apart(a, b) == spelling.one_apart(b, a) == bool(near)


def test_extra_columns_do_not_matter(docs):
    assert EXTRA and len(docs.columns) > 2
    assert spelling.variants(docs.select("text", "doc_id", "n_chars")).count() == spelling.variants(docs).count()


# --- earlier operators, mended ---


def test_surrogates_end_and_stay_distinct_where_every_shape_is_taken(spark):
    mails = [f"{d}@{c}.com" for d in "0123456789" for c in "abcdefghijklmnopqrstuvwxyz"]
    firsts = ["".join(c) for c in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "aeiouaeiouaeiouaeiouaeioua", "lmnrlmnrlmnrlmnrlmnrlmnrlm", strict=True)][:24]
    texts = [f"write to {m}" for m in mails] + [f"{'Mr' if i % 2 else 'Dr'} {f} Reed" for i, f in enumerate(firsts)]
    texts += ["Mr Alex Reed", "Dr Alex Reed", "Ms Kim Reed", "Dr Kim Reed"]
    texts += ["+33 6 12 34 56 78", "06 12 34 56 78", "555 123 4567", "3782 822463 10005", "2001:db8:0:1:1:1:1:1", "fe80:0::1a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in sorted(pii.pseudonymise(df).collect())]
    new = [g.split()[-1] for g in got[:260]]
    assert len(set(new)) == 260 and not set(new) & set(mails)
    domains = {(m.split("@")[1], n.split("@")[1]) for m, n in zip(mails, new, strict=True)}
    assert len(domains) == len({a for a, _ in domains}) == len({b for _, b in domains}) == 26
    assert not {a for a, _ in domains} & {b for _, b in domains}
    assert len({g.split()[1] for g in got[260:284]}) == 24
    assert got[284].split()[1:] == got[285].split()[1:] and got[286].split()[1:] == got[287].split()[1:]
    assert got[286].split()[1].startswith(tuple(pii.FIRST["latin"]["f"].split()))
    shape = lambda t: re.sub("[0-9a-f]", "x", t)
    assert all(a != b and shape(a) == shape(b) for a, b in zip(got[288:], texts[288:], strict=True))


def test_license_gaps_expressions_and_short_forms():
    scanner = license_scan.Scanner(license_scan.rules())
    found = lambda t: [(t[a:b], r.label) for a, b, r in scanner.detections(t)]
    wide = "see apache\n" + " " * 400 + "* license, version 2.0 here"
    assert found(wide) == [(wide[4:-5], "apache-2.0")]
    assert found("spdx-license-identifier: mit or (apache-2.0 and isc)") == [("mit", "mit"), ("apache-2.0", "apache-2.0"), ("isc", "isc")]
    for text in ("licensed under gpl v3", "gpl3 license", "the gpl, see gpl version    3"):
        assert "gpl-3.0" in dict(map(reversed, found(text)))
    assert [x for x, _ in found("mit license" + " " * 60 + "-" * 60 + "bsd license")] == ["mit license", "bsd license"]


def test_raking_goes_on_until_the_targets_are_met(spark):
    n = 6
    rows = [(f"s{i}", f"l{j}", "t", 1000 if i == j else 1) for i in range(n) for j in range(n)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    goal = np.arange(1, n + 1) / np.arange(1, n + 1).sum()
    targets = {"source": {f"s{i}": float(goal[i]) for i in range(n)}, "lang": {f"l{j}": float(goal[(j + 1) % n]) for j in range(n)}, "topic": 1.0}
    out = mixing.rake(cells, targets, tolerance=1e-3).collect()
    for dim, shift in (("source", 0), ("lang", 1)):
        for i in range(n):
            have = sum(r.weight for r in out if r[dim] == f"{dim[0]}{i}")
            assert abs(have - goal[(i + shift) % n]) <= 2e-3
    # contradicting targets end, and say how far they are
    one = spark.createDataFrame([("a", "x", "t", 5), ("b", "y", "t", 5)], "source string, lang string, topic string, tokens long")
    miss = mixing.rake(one, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}).first()["miss"]
    assert miss > 0.5


def _plain_language(train, asked):
    """Word-first backoff over plain counters."""
    letters, langs = re.compile(r"[^\W\d_]+"), collections.Counter(c for _, c in train)
    order = sorted(langs, key=lambda c: (-langs[c], c))
    words = {c: collections.Counter(w for t, k in set(train) if k == c for w in letters.findall(t.lower())) for c in order}
    grams = {c: {k: collections.Counter() for k in lang_id.GRAMS} for c in order}
    for c in order:
        for w, n in words[c].items():
            for k in lang_id.GRAMS:
                line = f"<{w}>" if k > 1 else w
                for i in range(len(line) - k + 1):
                    grams[c][k][line[i : i + k]] += n
    log = lambda table, x: np.array([math.log(table[c][x] + 0.5) - math.log(sum(table[c].values()) + 0.5) for c in order])
    out = []
    for text in asked:
        total, found = np.zeros(len(order)), letters.findall((text or "").lower())
        for w in found:
            if any(words[c][w] for c in order):
                total += log(words, w)
                continue
            for k in lang_id.GRAMS:
                line, by = (f"<{w}>" if k > 1 else w), {c: grams[c][k] for c in order}
                hits = [g for i in range(len(line) - k + 1) if any(by[c][g := line[i : i + k]] for c in order)]
                if hits:
                    total += np.mean([log(by, g) for g in hits], axis=0)
                    break
        best = int(np.argmax(total))
        out.append(("und", 0.0) if not found else (order[best], 1 / np.exp(total - total[best]).sum()) if total.any() else (order[0], langs[order[0]] / len(train)))
    return out


def test_language_equals_plain_backoff(spark):
    rng = np.random.default_rng(6)
    lists = {c: ["".join(rng.choice(list(a), int(rng.integers(2, 8)))) for _ in range(40)] for c, a in {"aa": "abcdeo", "bb": "cdefgu", "cc": "éfghia"}.items()}
    train = [(" ".join(rng.choice(lists[c], 12)), c) for c in ("aa", "bb", "cc") for _ in range(40)]
    asked = [" ".join("".join(rng.choice(list("abcdefghiéou"), int(rng.integers(1, 9)))) if rng.random() < 0.6 else str(rng.choice(lists["bb"])) for _ in range(6)) for _ in range(150)]
    asked += [None, "", "12", "ж漢"]
    model = lang_id.fit(spark.createDataFrame(train, "text string, lang string").repartition(3))
    rows = lang_id.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    for r, (lang, score) in zip(rows, _plain_language(train, asked), strict=True):
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9


def test_language_sample_is_bounded_whatever_repeats(spark):
    rows = [(("same text" if i % 2 else f"text {i}"), "en") for i in range(6000)] + [(f"autre {i}", "fr") for i in range(50)]
    df = spark.createDataFrame(rows, "text string, lang string")
    picked = lang_id.sample(df, "lang", "text", {"en": 6000, "fr": 50}, 300).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in picked} == {"en": 300, "fr": 50}


def test_minhash_later_links_look_up_labels_once(spark, monkeypatch):
    """Later links join components; what names their ends is worked out once, from their own rows, not again for each use."""
    texts = [" ".join(f"w{c}{i}" for i in range(30)) for c in "abcd"] + ["none at all of these words", ""]
    table = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    digests = {r.doc_id: bytes(r.digest) for r in minhash_dedup.sketch(table, 4).collect() if r.digest}
    seen, plain = [], minhash_dedup._labels
    links = [(digests[0], digests[1]), (digests[3], digests[1])]
    monkeypatch.setattr(minhash_dedup, "across", lambda members, sets, near: spark.createDataFrame(links, "a binary, b binary"))
    monkeypatch.setattr(minhash_dedup, "_labels", lambda pairs: seen.append(pairs) or plain(pairs))
    got = {r.doc_id: r.component_id for r in minhash_dedup.components(table, shingle=4).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 0, 4: 4, 5: 5, 6: 0, 7: 0, 8: 2, 9: 0, 10: 4, 11: 11}
    assert len(seen) == 2 and seen[1].count() == 2
    assert "Join" not in seen[1]._jdf.queryExecution().optimizedPlan().toString()
