"""Operators of the llm package: brute force on small fixtures, edge cases, round trips and held-out accuracy."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tielens.llm import common, decontaminate, html_text, jaccard_join, packing, ppm, quality, quotient_dedup, token_counts, token_files, tokens, url_filter
from tielens.llm import queries as q

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n", "en", "s", 3), (4, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "s", 11), (5, "A  B c\nd e F ", "xx", None, 9), (None, "no id here at all today", None, None, None), (6, "word " * 30000, "en", "s", 150000), (7, "one", "en", "s", 3), (7, "o n e ", "en", "s", 3), (8, "\u00e9\u00a0x\u3000 y <|endoftext|> z", "en", "s", 5)]


@pytest.fixture(scope="module")
def edges(spark):
    rows = spark.createDataFrame(EDGES, SCHEMA)
    clash = {c: F.lit(7) for c in ("key", "chars", "hash", "sha_", "__id", "__sha", "__n", "root", "cls", "fp", "sha", "row", "task", "b", "ref", "n", "kept", "score", "held_out")}
    return rows.withColumns(clash)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


# ---- 1 URL filters ----


def test_url_rules(spark):
    rows = [(1, "http://A.Example.ORG/es/1"), (2, "https://example.org/en/1?x"), (3, "http://sub.com/fr/2#a"), (4, "http://sub.com/de/2"), (5, None), (6, "no scheme"), (7, "http://x.net/a.html"), (8, "http://x.net/a/"), (9, "http://y.net/b"), (9, "http://y.net/b"), (10, "http://notorg/"), (11, "http://z.org"), (12, "a://b://c.org/x")]
    pages = spark.createDataFrame(rows, "page_id int, url string").withColumn("listed", F.lit(1))
    listed = spark.createDataFrame([("x.net/a",), (None,)], "canonical string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/1", "example.org/en/1", "block")
    assert got[3][2:] == ("com/fr/", "allow") and got[4][2:] == ("com/de/", "block")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7][3] == got[8][3] == "block" and got[9][3] == "allow" and got[10][2] is None and got[11] == ("z.org", "", None, "allow")
    assert got[12][:2] == ("b:", "//c.org/x")
    assert url_filter.judge(pages, listed).count() == len(rows)
    assert url_filter.judge(pages.limit(0), listed.limit(0)).count() == 0


def test_bloom_loses_nothing(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("canonical"))
    found = url_filter.possible(keys, "canonical", url_filter.bloom_blocks(keys.filter("canonical like '%7'"), "canonical", 128), 128)
    got = found.groupBy((F.col("canonical").like("%7")).alias("listed")).agg(F.avg(F.col("possible").cast("int")).alias("p")).collect()
    rate = {r.listed: r.p for r in got}
    assert rate[True] == 1.0 and rate[False] < 0.1


# ---- 2 quality ----


def test_quality(spark, edges, empty):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    rows = {r.doc_id: r for r in quality.score(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[d]) for d, r in rows.items() if r.held_out and d in truth]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    assert np.mean([p == t for p, t in held]) > 0.9
    got = quality.score(edges, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty, model).count() == 0
    kept = quality.keep_good(edges, model)
    assert kept.columns == edges.columns
    blank = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(edges, blank).collect()} == {0.5}


def test_trees_match_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    model = quality.fit(x, y, trees=10, depth=3)
    for row, got in zip(x[:50], model.score(x[:50]), strict=True):
        raw = model.start
        for f, c, v in zip(model.feature, model.cut, model.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(row[f[at]] > c[at])
            raw += v[at - len(f)]
        assert got == pytest.approx(1 / (1 + np.exp(-raw)))
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.9


# ---- 3 packing ----


def reference_ids(text, end):
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "t"):
        reference_ids.t = Tokenizer.from_file(tokens.default_path())
    return [*reference_ids.t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def check_packing(rows, documents, size=2048):
    own = collections.Counter((d, tuple(reference_ids(t, 1))) for d, t in documents)
    by_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for doc, pieces in by_doc.items():
        all_ids = [ids for (d, ids), n in own.items() if d == doc for _ in range(n)]
        assert sum(p.length for p in pieces) == sum(map(len, all_ids))
        for p in pieces:
            assert any(len(i) == p.doc_tokens and crc(i[p.start : p.start + p.length]) == p.ids_crc32 for i in all_ids)
        if len(all_ids) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padding += packing.padded(at, size) - at
        total += at
    assert {d for d, _ in documents} == set(by_doc)
    return padding / max(total, 1)


def test_packing(spark, docs, edges, empty):
    assert check_packing(packing.pack(docs, tokens.default_path()).collect(), texts(docs)) < 0.01
    check_packing(packing.pack(edges, tokens.default_path()).collect(), texts(edges))
    assert packing.pack(empty, tokens.default_path()).count() == 0


def test_patterns_respect_demand():
    rng = random.Random(3)
    for n in (1, 40, 3000):
        demand = collections.Counter(min(2047, int(rng.lognormvariate(6, 1)) + 1) for _ in range(n))
        used = collections.Counter()
        for lengths, times in packing.patterns(demand):
            assert sum(lengths) <= 2048 and times > 0
            for x in lengths:
                used[x] += times
        assert all(used[x] <= demand[x] for x in used)


# ---- 4 decontamination ----


def test_leaks(spark, docs, edges, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: decontaminate.normal(r.text.encode()) for r in bench.collect()}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    want = {(d, i) for d, t in texts(docs) for i, x in items.items() if x in decontaminate.normal((t or "").encode())}
    assert want <= got and want
    clean = decontaminate.drop_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in texts(docs)} - {d for d, _ in got}
    assert decontaminate.leaks(edges, bench).count() == 0
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "a b c d e f")], "item_id long, text string")
    assert {r.item_id for r in decontaminate.leaks(edges, odd).collect()} == {4}


def edits(a, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edited_items_are_found():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 50))).encode()) for i in range(30)]
    index = decontaminate.Index(items)
    for _ in range(60):
        j = rng.randrange(len(items))
        own = bytearray(items[j][1])
        for _ in range(rng.randint(0, int(index.k[j]))):
            p, kind = rng.randrange(len(own)), rng.random()
            if kind < 0.4:
                own[p] = rng.randrange(97, 105)
            elif kind < 0.7:
                del own[p]
            else:
                own.insert(p, rng.randrange(97, 105))
        text = (" ".join(word() for _ in range(60)) + " ").encode() + bytes(own) + (" " + " ".join(word() for _ in range(40))).encode()
        found = index.hits([b"other", text])[1]
        assert j in found
        assert found[j][0] == edits(items[j][1], text)


@pytest.mark.parametrize("limits", [(4_000_000, 400_000), (300, 100)])
def test_items_with_a_common_sentence(monkeypatch, limits):
    """Items that share half of their text, at either end or in the middle; tables of any size give the same."""
    for name, value in zip(("MOST_PAIRS", "MOST_CELLS"), limits, strict=True):
        monkeypatch.setattr(decontaminate, name, value)
    rng = random.Random(6)
    word = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    common = word(12)
    items = [(i, x.encode()) for i in range(60) for x in [(common + " " + word(12), word(12) + " " + common, word(6) + " " + common + " " + word(6), word(rng.randint(1, 6)))[i % 4]]]
    index = decontaminate.Index(items)
    chosen = [items[i][1].decode() for i in (0, 1, 2, 3, 7)]
    damaged = [t[: len(t) // 3] + "#" + t[len(t) // 3 + 1 : -4] + "zz" + t[-4:] for t in chosen]
    text = " ".join([common, word(5), *chosen[:2], common + " " + common, word(9), *damaged[2:], word(3)]).encode()
    got = index.hits([text, common.encode()])
    assert {j: found[0] for j, found in got[0].items()} == {j: e for j, (_, t) in enumerate(items) if (e := edits(t, text)) <= decontaminate.budget(len(t))}
    assert {0, 1} <= set(got[0])
    for found in got:
        for j, (e, end, _) in found.items():
            assert edits(items[j][1], text[max(end - len(items[j][1]) - e, 0) : end] if found is got[0] else common.encode()) == e


def test_items_without_grams():
    index = decontaminate.Index([(5, b"yes"), (6, b"no"), (7, b"yes"), (8, b"")])
    assert [sorted(index.all[j][0] for j in x) for x in index.hits([b"yes", b"yes yes", b"", b"no"])] == [[5, 7], [], [], [6]]
    assert all(decontaminate.budget(m) * decontaminate.Q < m - decontaminate.Q + 1 for m in range(decontaminate.Q, 3000))


# ---- 5 token files ----


def test_token_files(spark, docs, edges, empty, tmp_path):
    for frame in (docs, edges):
        out = token_files.write_ids(frame, f"file://{tmp_path}/{id(frame)}", tokens.default_path())
        rows = token_files.read_digests(spark, out).collect()
        got = collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)
        assert got == collections.Counter((d, len(i), crc(i)) for d, t in texts(frame) for i in [reference_ids(t, 0)])
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
        assert ids == sorted(ids, key=lambda d: (d is not None, d))
        one = token_files.read_ids(spark, out, [4]).collect()
        assert {tuple(r.ids) for r in one} == {tuple(reference_ids(t, 0)) for d, t in texts(frame) if d == 4}
        assert "PushedFilters: [In(doc_id" in token_files.read_ids(spark, out, [4, 5])._jdf.queryExecution().toString()
    assert token_files.through_files(empty, tokens.default_path()).count() == 0


def test_encoder_equals_library():
    enc = tokens.Encoder(tokens.default_path())
    cases = ["", " ", "a", " a", "a ", "a  b", "x\ny", "it's <|endoftext|> ok", "<|endoftext|>", "\u00e9 b", "a\u00a0b c", "a \u3000", "\x1c a b", "I'm 's 12 3,4 ...", "z"]
    for n in (1, 3, len(cases)):
        for i in range(0, len(cases), n):
            part = cases[i : i + n]
            ids, counts = enc.encode([c.encode() for c in part])
            want = [enc.tokenizer.encode(c, add_special_tokens=False).ids for c in part]
            assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


# ---- 6 LM scoring ----


def test_model_is_a_distribution():
    keys, n = np.unique(ppm.at_order(ppm.symbols([b"abracadabra abra cad", b"the cat sat on the mat"])[0], 3), return_counts=True)
    model = ppm.Model(3, keys, n)
    for context in (b"abr", b"xyz", b"the", b" ca", b"\n\n\n", b"zab"):
        grams = np.array([int.from_bytes(b"\0\0\0\0" + context + bytes([s]), "little") for s in range(256)], np.uint64)
        assert (10 ** model.log10(grams)).sum() == pytest.approx(1, abs=1e-5)


def test_lm_score(spark, docs, edges, empty):
    for frame in (docs, edges):
        rows = [r for r in ppm.score(frame).collect()]
        words = {}
        c, ends = collections.Counter(), 0
        for d, t in texts(frame):
            words.setdefault(d, []).append((t or "").encode().lower().split())
            if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
                c.update(words[d][-1])
                ends += 1
        n, v = sum(c.values()) + ends, len(c) + 1
        point = lambda k: np.log10((k + 0.5) / (n + 0.5 * (v + 1)))
        want = sorted((str(d), len(w) + 1, sum(x in c for x in w) + 1, round(sum(point(c[x]) for x in w) + point(ends), 5)) for d, ws in words.items() for w in ws)
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows) == want
        assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    assert ppm.score(empty).count() == 0


def test_smaller_trie_is_shallower(spark, docs):
    a = {r.doc_id: r.score for r in ppm.score(docs).collect()}
    b = {r.doc_id: r.score for r in ppm.score(docs, most=2000).collect()}
    assert sum(b.values()) < sum(a.values())


@pytest.mark.parametrize("common", [1 << 21, 50])
def test_scores_are_of_the_whole_trie(spark, docs, monkeypatch, common):
    """Of more than two million pairs, and of pairs that nearly all lie in shards."""
    monkeypatch.setattr(ppm, "COMMON_PAIRS", common)
    rng = np.random.default_rng(8)
    many = [(i, bytes(rng.integers(97, 123, 9000, np.uint8)).decode()) for i in range(330)] if common > 50 else []
    frame = spark.createDataFrame(many + [(1000 + d, t) for d, t in texts(docs)], "doc_id long, text string").repartition(4)
    rows = texts(frame)
    grams = ppm.symbols([(t or "").encode() for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1])[0]
    keys, n = np.unique(ppm.at_order(grams, 6), return_counts=True)
    model = ppm.Model(6, keys, n)
    assert len(keys) > 2_000_000 or not many
    got = {r.doc_id: r.score for r in ppm.score(frame).collect()}
    assert got == {d: pytest.approx(model.log10(ppm.symbols([(t or "").encode()])[0]).sum(), rel=1e-6) for d, t in rows}


def test_words_of_all_runs_count(spark):
    """A task that lets go of its counts again and again loses no run's words."""
    rng = np.random.default_rng(9)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz    ", np.uint8)
    rows = [(i, rng.choice(letters, 360_000).tobytes().decode() * 3) for i in range(7) if zlib.crc32(str(i).encode()) % 5 != 1] + [(100, "the end")]
    c = collections.Counter(w for _, t in rows for w in t.split())
    n, v = sum(c.values()) + len(rows), len(c) + 1
    point = lambda k: np.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    got = {r.doc_id: r for r in ppm.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert {r.train_tokens for r in got.values()} == {n}
    for d, t in rows:
        assert got[d].n_known == got[d].n_tokens == len(t.split()) + 1
        assert got[d].base_score == pytest.approx(sum(point(c[w]) for w in t.split()) + point(len(rows)), rel=1e-9)


def test_long_words_are_told_apart(spark):
    """Thue-Morse words, which collide in any polynomial hash modulo 2**64."""
    a = "a"
    while len(a) < 2048:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    for n in (1024, 2048):
        (h, _), (g, _) = common.word_hashes([f"{a[:n]} x {b[:n]}".encode()]), common.word_hashes([a[:n].upper().encode()])
        assert len(set(h.tolist())) == 3 and g[0] == h[0]
    got = {r.doc_id: r for r in ppm.score(spark.createDataFrame([(0, a), (3, b)], "doc_id long, text string")).collect()}
    assert (got[3].held_out, got[3].n_known, got[3].train_tokens) == (True, 1, 2)


def test_base_score_of_one_frequent_word(spark):
    """The sum of many small terms, as exact as they are."""
    times = 400_000
    got = ppm.score(spark.createDataFrame([(0, "the " * times)], "doc_id long, text string")).first()
    norm = math.log10(times + 1 + 0.5 * 3)
    want = math.fsum([math.log10(times + 0.5) - norm] * times + [math.log10(1.5) - norm])
    assert got.base_score == pytest.approx(want, rel=1e-11)


# ---- 7 exact dedup ----


def brute_copies(documents):
    groups = collections.defaultdict(list)
    for d, t in documents:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is not None, d or 0, d))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("weak", [False, True])
def test_copies(spark, docs, edges, empty, weak):
    fingerprint = (lambda c: F.pmod(F.xxhash64(c), F.lit(5))) if weak else F.xxhash64
    for frame in (docs, edges):
        want, rows = brute_copies(texts(frame)), quotient_dedup.find_copies(frame, fingerprint=fingerprint).collect()
        by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
        assert len(rows) == len(texts(frame))
        assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in rows)
        assert collections.Counter(r.text_sha256 for r in rows if r.kept) == collections.Counter(list(by_sha))
        left = quotient_dedup.drop_copies(frame)
        assert left.columns == frame.columns and left.count() == len(by_sha)
        longest = collections.Counter(len(max((t or "" for _, t in texts(frame) if re.sub(r"[\x20\x09-\x0D]", "", t or "") == k), key=len)) for k in want)
        assert collections.Counter(len(r.text or "") for r in left.select("text").collect()) == longest
    assert quotient_dedup.find_copies(empty).count() == 0 and quotient_dedup.drop_copies(empty).count() == 0


def test_quotient_filters_merge():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 50, 40).astype(np.uint64) << np.uint64(40) for _ in range(4)]
    merged = quotient_dedup.QuotientFilter.merge([quotient_dedup.QuotientFilter.from_bytes(quotient_dedup.QuotientFilter.of(p, 12).to_bytes()) for p in parts])
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    got = merged.items()
    assert (got[0] == keys).all() and (got[1] == n).all()


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quotient_filter_slots(n):
    """Ascending slots, every quotient's run in one piece and not before its own slot, counters beyond a byte."""
    rng = np.random.default_rng(n)
    fp = np.unique((np.uint64(5) << np.uint64(59)) | (rng.integers(0, 2**62, n, dtype=np.uint64) >> np.uint64(3 if n < 9 else 9)))
    counts = rng.choice([1, 1, 2, 254, 255, 256, 70_000], len(fp))
    made = quotient_dedup.QuotientFilter(fp, counts, 5)
    for f in (made, quotient_dedup.QuotientFilter.from_bytes(made.to_bytes())):
        slots = np.flatnonzero(f.counter)
        width = 64 - 5 - f.bits
        quotient = (fp >> np.uint64(width) & np.uint64((1 << f.bits) - 1)).astype(np.int64)
        assert len(slots) == len(fp) and (slots >= quotient).all() and (f.shifted[slots] == (slots != quotient)).all()
        assert (np.flatnonzero(f.occupied) == np.unique(quotient)).all()
        got = f.items()
        assert (got[0] == fp).all() and (got[1] == counts).all()
    both = quotient_dedup.QuotientFilter.merge([made, made]).items()
    assert (both[0] == fp).all() and (both[1] == 2 * counts).all()


def test_copies_keep_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a b", 77, 1, 2), (2, "ab", 78, 1, 2), (2, "ab", 78, 1, 2), (None, "a  b", 79, 1, 2), (3, "c", 80, 1, 2)], "doc_id long, text string, key long, sha int, chars int")
    assert sorted((r.key, r.sha, r.chars) for r in quotient_dedup.drop_copies(rows).collect()) == [(79, 1, 2), (80, 1, 2)]


def test_shards_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(quotient_dedup, "SHARD_ROWS", 4)
    frame = spark.createDataFrame([(i, f"t{i % 300}") for i in range(700)], "doc_id long, text string").repartition(3)
    assert quotient_dedup.shard_bits_of(700) == 8
    assert collections.Counter(r.group_size for r in quotient_dedup.find_copies(frame).collect()) == {2: 400, 3: 300}


# ---- 8 Jaccard join ----


def brute_components(documents):
    sets = []
    for d, t in documents:
        w = (t or "").encode().lower().split()
        sets.append((d, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(sets):
        least[find(i)].append(d)
    return sorted((str(d), len(s), str(min((x for x in least[find(i)] if x is not None), default=None))) for i, (d, s) in enumerate(sets))


def near_copies(n, length, rng):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, max(1, length // 18))):
            own[rng.randrange(length)] = word()
        out.append(" ".join(own))
    return out


def test_components(spark, docs, edges, empty):
    rng = random.Random(11)
    planted = [t for n, length in ((70, 12), (90, 40), (60, 70), (30, 300)) for t in near_copies(n, length, rng)]
    passage = " ".join(f"common{i}" for i in range(60))
    planted += [passage + " " + t for t in near_copies(40, 80, random.Random(2))] + [" ".join(rng.choice("xyz") for _ in range(rng.randint(1, 9))) for _ in range(80)]
    many = spark.createDataFrame([(i * 3 + 1, t) for i, t in enumerate(planted)], "doc_id long, text string").repartition(5)
    for frame in (docs, edges, many):
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(frame).collect())
        assert got == brute_components(texts(frame))
    left = jaccard_join.keep_one(many)
    assert left.count() == len({c for *_, c in brute_components(texts(many))})
    assert jaccard_join.join(empty).count() == 0


def test_one_of_each_group_stays_by_id_and_text(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(5, one), (5, two), (3, one + " more"), (None, two + " more"), (None, two + " more"), (None, None), (3, one + " more"), (9, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "hash": F.lit(2)})
    left = jaccard_join.keep_one(frame)
    assert left.columns == frame.columns
    assert sorted((str(r.doc_id), str(r.text), r.key, r.hash) for r in left.collect()) == sorted((str(d), str(t), 1, 2) for d, t in [(3, one + " more"), (5, two), (None, None), (9, "x")])


@pytest.mark.parametrize(("own", "few"), [(8, 16), (12, 1), (30, 1)])
def test_template_clusters(spark, monkeypatch, own, few):
    """Texts of a common template and words of their own: beside the border on either side, in clusters of many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "FEW_BLOCKS", few)
    rng = random.Random(own)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    template = [word() for _ in range(64)]
    planted = [" ".join([*template, *(word() for _ in range(own))]) for _ in range(120)]
    planted += [" ".join([*template[: rng.randint(40, 64)], *(word() for _ in range(rng.randint(0, 14)))]) for _ in range(60)]
    planted += [" ".join(t.split()[: rng.randint(55, 70)]) for t in rng.sample(planted, 40)]
    frame = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string").repartition(4)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(frame).collect())
    assert got == brute_components(texts(frame))


def test_grouped_pairs_lose_no_link():
    """Of random linked sets, whatever the frequencies of their tokens, signatures meet."""
    rng = np.random.default_rng(12)
    for _ in range(400):
        n = int(rng.integers(2, 260))
        space = np.sort(rng.choice(1 << 48, 2 * n + 60, replace=False).astype(np.uint64))
        df = {int(t): int(d) for t, d in zip(space, rng.choice([2, 40, 65, 70, 5000], len(space)), strict=True)}
        one = np.sort(rng.choice(space, n, replace=False))
        keep = rng.permutation(n)[: n - int(rng.integers(0, n // 4 + 1))]
        other = np.setdiff1d(space, one)
        two = np.sort(np.concatenate([one[keep], rng.choice(other, int(rng.integers(0, n // 4 + 1)), replace=False)]))
        both = len(np.intersect1d(one, two))
        if 100 * both < 75 * (len(one) + len(two) - both) or n < 2 or len(two) < 2:
            continue
        found = []
        for s in (one, two):
            low = int((s < 1 << 47).sum())
            sent = s[: max(low, min(len(s), jaccard_join.prefix_size(len(s)) + max(jaccard_join.group_numbers(len(s)))))]
            d = np.array([df[int(t)] if t < 1 << 47 else jaccard_join.BEHIND for t in sent])
            at = np.lexsort((sent, d))
            found.append(set(jaccard_join.signatures_of(len(s), low, sent[at], d[at]).tolist()))
        assert found[0] & found[1]


def test_components_with_small_limits(spark, monkeypatch):
    """Blocks, declared frequent tokens and pairs of tokens at a small size."""
    for name, value in (("BLOCK", 16), ("LOCALLY_FREQUENT", 6), ("RARE", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(t for n, k in ((60, 10), (60, 25), (80, 60)) for t in near_copies(n, k, rng))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(frame).collect())
    assert got == brute_components(rows)


# ---- 9 token counts ----


def test_token_counts(spark, docs, edges, empty):
    pieces = token_counts.vocabulary(tokens.default_path())

    def best(word):
        w = b" " + word
        f = [(0.0, 0)] + [(-np.inf, 0)] * len(w)
        for d in range(1, len(w) + 1):
            f[d] = max(((f[k][0] + pieces[w[k:d]], f[k][1] - 1) for k in range(d) if w[k:d] in pieces), default=(-np.inf, 0))
        return -f[-1][1], f[-1][0]

    for frame in (docs.filter("doc_id % 4 = 0"), edges):
        want = []
        for d, t in texts(frame):
            got = [best(w) for w in (t or "").encode().split()]
            want.append((str(d), len(got), sum(g[0] for g in got), round(sum(g[1] for g in got), 4)))
        rows = token_counts.count_tokens(frame, tokens.default_path()).collect()
        assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens, round(r.score, 4)) for r in rows) == sorted(want)
    assert token_counts.count_tokens(empty, tokens.default_path()).count() == 0


# ---- 10 HTML extraction ----


def test_html(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    import html as h

    for r in html_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain  text", "plain text"), ("<html><body><p>One &lt;two&gt; &amp am<p>Three<script>x<y</script></body>", "One <two> & am\nThree"),
        ("<body><nav><a href=x>menu</a></nav><main><h2>T</h2><p>A long enough paragraph of text, with words.</p><div class='comments'><p>nice post nice post nice post</p></div></main><aside>side</aside><form>f</form></body>", "T\nA long enough paragraph of text, with words."),
        ("<body><div class=\"cookie-notice\">accept</div><article><p>x<br>y</p><ul><li>a<li>b</ul></article><footer>f</footer>", "x y\na\nb"),
    ],
)
def test_html_cases(page, want):
    assert html_text.main_text(page) == want


def _sentence(n, size=300):
    return (f"Passage {n} has words of its own and goes on. " * 20)[:size].strip()


_PARAGRAPHS = ["".join(f"<p>{_sentence(10 * k + i)}</p>" for i in range(5)) for k in range(2)]


@pytest.mark.parametrize(
    "inner",
    [
        f"<h1>Head</h1><section>{_PARAGRAPHS[0]}</section><section>{_PARAGRAPHS[1]}</section>",
        f"<h1>Head</h1><section>{_PARAGRAPHS[0]}</section>",
        "<h1>Head</h1>" + "".join(f"<p>{_sentence(i)}</p>" for i in range(3)) + "<ul>" + "".join(f"<li>{_sentence(i, 80)}</li>" for i in range(20)) + "</ul>",
        f"<h1>Head</h1><p>{_sentence(1)}</p><table>" + "".join(f"<tr><td>{_sentence(i, 60)}</td><td>{_sentence(i, 70)}</td></tr>" for i in range(12)) + f"</table><p>{_sentence(2)}</p>",
        f"<h1>Head</h1><p>{_sentence(1)}</p><blockquote>{_PARAGRAPHS[0]}</blockquote><p>Yes.</p><p>{_sentence(2)}</p>",
    ],
)
@pytest.mark.parametrize("outer", ["<article>{}</article>", "{}"])
def test_html_keeps_inner_structure(inner, outer):
    links = "<div>" + "".join(f"<a href=/{i}>Link number {i}</a> " for i in range(30)) + "</div>"
    page = f"<html><body>{links}{outer.format(inner)}{links}</body></html>"
    want = [re.sub(r"\s+", " ", x).strip() for x in re.split(r"<[^>]*>", inner)]
    assert html_text.main_text(page) == "\n".join(x for x in want if x)


def _paragraphs(n, kind):
    return "".join(f"<p>Paragraph {kind}{i} with a number of plain words in it, and some more of them to be long enough.</p>" for i in range(n))


@pytest.mark.parametrize(
    ("body", "blocks"),
    [
        (f"<div>{_paragraphs(6, 1)}</div><div>{_paragraphs(4, 2)}</div>", 10),
        (f"<div><div>{_paragraphs(6, 1)}</div><div>{_paragraphs(4, 2)}</div></div>", 10),
        (f"<article><h1>T</h1><section>{_paragraphs(6, 1)}</section><section>{_paragraphs(6, 2)}</section></article>", 13),
        (f"<article><div>{_paragraphs(2, 1)}</div><div>{_paragraphs(6, 2)}</div></article>", 8),
        (f"<article><h1>T</h1>{_paragraphs(3, 1)}<ul>" + "".join(f"<li>Item {i} with some more text in it, rather long, to be one of many items</li>" for i in range(20)) + "</ul></article>", 24),
        ("<p title=don't>Some text here</p>", 1),
        (f"<article><p title='the hidden valley'>One two three.</p>{_paragraphs(3, 1)}</article>", 4),
        (f"<div id='foot'>{_paragraphs(3, 1)}</div>", 3),
        (f"<div class='related-work'>{_paragraphs(3, 1)}</div>", 3),
        (f"<div class='copyright-law'>{_paragraphs(3, 1)}</div>", 3),
        (f"<form><article>{_paragraphs(5, 1)}</article><input><button>Send</button></form>", 5),
        (f"<div class='cookie-banner'>{_paragraphs(1, 1)}</div><article>{_paragraphs(5, 2)}</article><div class='comments-list'>{_paragraphs(6, 3)}</div><div id=site-footer>{_paragraphs(1, 4)}</div><div hidden>{_paragraphs(9, 5)}</div>", 5),
        ("<p title=\"a>b\">x</p><p a='>'>y</p><p class=>z</p>", 3),
        ("<p title=\"abc>x</p><p>y", 2),
    ],
)
def test_html_layouts(body, blocks):
    links = "<ul>" + "".join(f"<li><a href='/x{i}'>Menu link {i}</a></li>" for i in range(8)) + "</ul>"
    got = html_text.main_text(f"<html><body><nav>{links}</nav>{body}<footer>foot</footer></body></html>")
    assert got.count("\n") + 1 == blocks


def _tree_sums(page):
    """Of each visible node, by plain recursion: (tag, chars, tags, density, sum of the block children's densities)."""
    import math

    def text(n):
        return sum(len(re.sub(r"\s+", " ", p).strip()) if isinstance(p, str) else text(p) for p in n.parts if isinstance(p, str) or not p.hidden)

    def below(n):
        return [x for p in n.parts if not isinstance(p, str) and not p.hidden for x in [p, *below(p)]]

    def linked(n):
        return text(n) if n.tag == "a" else sum(linked(p) for p in n.parts if not isinstance(p, str) and not p.hidden)

    root = html_text.parse(page)

    def density(n):
        c, t, lc, lt = text(n), max(len(below(n)), 1), linked(n), sum(x.tag == "a" for x in below(n))
        base = math.log(c / max(c - lc, 1) * lc + linked(root) / max(text(root), 1) * c + math.e)
        return c / t * math.log(max(c * t / (max(lc, 1) * max(lt, 1)), 1)) / base if c else 0.0

    return {id(n): (n.tag, text(n), len(below(n)), density(n), sum(density(p) for p in n.parts if not isinstance(p, str) and not p.hidden and p.tag in html_text.BLOCK)) for n in [root, *below(root)]}, root


def test_html_densities_by_recursion(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(20).collect()]
    pages.append("<body><div><a href=x>one</a> two <b>three</b></div><div>four <a href=y>five <i>six</i></a><p>seven</div><a href=z>eight</a></body>")
    for page in pages:
        html_text.measure(root := html_text.parse(page))
        want, _ = _tree_sums(page)
        got = [(n.tag, n.chars, n.tags, round(n.density, 6), round(n.total, 6)) for n in html_text._ordered(root)]
        assert sorted(got) == sorted((a, b, c, round(d, 6), round(e, 6)) for a, b, c, d, e in want.values())


def test_html_table_edges(spark):
    rows = spark.createDataFrame([(1, None, None), (1, "u", "<p>a"), (None, "u", "<p>" + "a " * 50000)], "page_id int, url string, html string").withColumn("text", F.lit(1))
    assert sorted(r.n_chars for r in html_text.extract(rows).collect()) == [0, 1, 99999]
    assert html_text.extract(rows.limit(0)).count() == 0


# ---- pipeline ----


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == docs.columns
        frame = spark.createDataFrame(out.collect(), docs.schema)
        if name == "exact dedup":
            assert frame.count() == len(brute_copies(texts(frame)))
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    check_packing(packed, texts(frame))
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()} == {d for d, _ in texts(frame)}


def test_pipeline_edges(spark, edges, empty):
    import corpus_pipeline

    for frame in (edges, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns and out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() >= frame.count()


def test_queries_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in q.QUERIES} == {str(i) for i in range(1, 11)}
