"""Operators with an exact brute force: rules, mixing, near duplicates, decontamination, licences, URLs."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from dialstat.llm import (decontaminate, license_scan, mixing, near_dedup, quality_rules, queries, textsets, url_filter)
from dialstat.llm.components import components

SF = "/root/testdata/sf0.001"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return SPACES.findall(t or "")


def vocabulary(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split())
                     + str(rng.randrange(40)) for _ in range(rng.randrange(3, 90))) for _ in range(n)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle_on_small_tables(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(str, got.select(*want.columns).collect()))
    assert len(rows) == len(want.fetchall())
    have = sorted(str(tuple(r)) for r in got.select(*want.columns).collect())
    assert have == sorted(str(tuple(r)) for r in want.fetchall())


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "a b c d a b c d"), (6, "a b c d a b c d"),
         (7, "Same line\n\nSame line\nother"), (8, "x " * 30000), (9, "#" * 400), (None, "no id here at all")]


def test_rules_edge_cases(docs_of):
    rows = quality_rules.judge(docs_of(EDGES)).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_words, by[2].n_words, by[3].n_words, by[5].n_words) == (0, 0, 0, 2)
    assert by[1].base_failed and not by[1].kept
    assert by[6].n_repeat_words == 8 and by[8].n_repeat_words == 30000 and by[7].n_dup_lines == 1
    assert by[9].n_symbols == 400 and by[9].word_chars == 400


def test_rules_of_empty_table(docs_of):
    assert quality_rules.judge(docs_of([(1, "x")]).limit(0)).count() == 0


def test_repeat_words_brute_force(docs_of):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.features(docs_of(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        assert got[i] == len({j + k for j, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def test_host_rates_shrink_and_forgive(docs_of):
    clean = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"word{i}" for i in range(60)) + " # $ %" * 4
    rows = [(i, clean, "en", "good") for i in range(120)] + [(500, noisy, "en", "good")]
    rows += [(1000 + i, noisy if i % 2 else clean, "en", "mixed") for i in range(120)]
    rows += [(2000 + i, "short", "en", "bad") for i in range(120)] + [(3000, clean, "en", "bad")]
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(rows)).collect()}
    assert got[0].kept and got[500].kept and got[500].host_verdict == "trusted"
    assert not got[1001].kept and got[1000].kept
    assert got[3000].host_verdict == "condemned" and not got[3000].kept
    assert quality_rules.beta_prior(0.1, 0.0, 0.01)[0] == pytest.approx(100)


def test_mixing_brute_force(docs_of):
    rng = random.Random(3)
    sources = ["b", "a", None, "Z", "ä", "empty", "tiny"]
    rows = [(i, None if i % 50 == 0 else " ".join(["w"] * rng.randrange(1, 200)), "en", sources[i % 5]) for i in range(400)]
    rows += [(900, "", "en", "empty"), (901, "one two", "en", "tiny"), (901, "one two", "en", "tiny")]
    got = mixing.plan(docs_of(rows)).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(size.values())
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= 3 * size[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    source_of = {i: s for i, _, _, s in rows}
    for r in got:
        assert r.target == pytest.approx(target[source_of[r.doc_id]]) and r.taken <= 3 * r.size
        assert r.source_size == size[source_of[r.doc_id]]
    for s in ("a", "b", "Z", "ä", None):
        assert sum(r.taken for r in got if source_of[r.doc_id] == s) == pytest.approx(target[s], rel=0.15)
    assert sorted(map(str, mixing.plan(docs_of(rows)).collect())) == sorted(map(str, got))
    emitted = mixing.mix(docs_of(rows)).groupBy("doc_id").count().collect()
    copies = {}
    for r in got:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r["copies"]
    assert {r.doc_id: r["count"] for r in emitted} == {k: v for k, v in copies.items() if v}
    assert mixing.plan(docs_of(rows).limit(0)).count() == 0


def brute_groups(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = sets.get(i, set()) | ({tuple(w[j:j + size]) for j in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("tile", [2000, 4])
def test_near_duplicates_brute_force(docs_of, tile):
    rng = random.Random(9)
    texts = vocabulary(1, 25)
    for t in list(texts):  # a chain of copies, each a little different from the last
        for _ in range(8):
            w = t.split()
            w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
            t = " ".join(w)
            texts.append(t)
    rows = list(enumerate(texts)) + [(500, texts[3]), (501, texts[3].upper()), (502, "one two"), (503, "ONE  two"), (504, None),
                                     (505, ""), (506, " \n"), (507, "x " * 20000), (508, "y")]
    want = brute_groups(rows, 3, 85)
    got = near_dedup.groups(docs_of(rows), shingle=3, percent=85, tile=tile).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_dedup.dedup(docs_of(rows), shingle=3, percent=85)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) and "score_" in kept.columns


def test_near_duplicates_edges(docs_of):
    got = near_dedup.groups(docs_of([(None, "a b c"), (1, "a b c"), (1, "a b c")])).collect()
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert all(r.component_id == 1 for r in got if r.doc_id == 1) and len(got) == 3
    assert near_dedup.groups(docs_of([(1, "a")]).limit(0)).count() == 0


def test_sketch_is_mergeable_and_estimates():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2600])
    sa, sb, both = near_dedup.sketches([a, b, np.union1d(a, b)], 168)
    assert (np.maximum(sa, sb) == both).all()
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(near_dedup.estimate(sa, len(a), sb[None, :], np.array([len(b)]))[0] - j) < 0.12


@pytest.mark.parametrize("threshold, bands", [(0.85, 28), (0.8, 43)])
def test_bands_follow_the_threshold(threshold, bands):
    assert near_dedup.bands_for(threshold) == bands
    assert all(1 <= near_dedup.bands_for(x) < near_dedup.bands_for(x - 0.05) for x in (0.95, 0.9, 0.7, 0.5))
    rng = np.random.default_rng(5)
    n = 2000
    small = rng.integers(0, 2**63, int(n * threshold)).astype(np.uint64)
    large = np.concatenate([small, rng.integers(0, 2**63, n - len(small)).astype(np.uint64)])
    one, two = near_dedup.sketches([np.unique(small), np.unique(large)], 20_000)
    base = near_dedup.BASE
    assert abs((one == two).mean() - (1 + np.log1p(-(1 - threshold) * (base - 1) / base) / np.log(base))) < 0.015


def test_word_hashes_match_words():
    texts = [b"the the cat", None, b"", b" cat\tthe \n", "ö ö".encode(), b"x" * 5000 + b" " + b"x" * 5000]
    h, n = textsets.word_hashes(texts)
    flat = [w for t in texts for w in (t or b"").split()]
    assert n.tolist() == [len((t or b"").split()) for t in texts]
    assert len({(w, int(x)) for w, x in zip(flat, h)}) == len(set(flat)) == len(set(h.tolist()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert set(got[i] for i in range(61)) == {0} and got[101] == got[102] == 100
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["plain", "all different", "one letter", "one text"])
def test_a_full_block_of_the_benchmark_has_bounded_tables(kind):
    import tracemalloc

    rng = random.Random(9)
    vocabulary_ = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9))) for _ in range(20_000)]
    made = {"plain": lambda i: " ".join(rng.choice(vocabulary_) for _ in range(80)),
            "all different": lambda i: " ".join(f"{i * 80 + k:07}" for k in range(80)),
            "one letter": lambda i: " ".join(rng.choice("abcdefghijkl") for _ in range(80)),
            "one text": lambda i: "the same passage of twelve words stands in each of these many items"}[kind]
    items, size = [], 0
    while size < decontaminate.BLOCK_BYTES:
        items.append((f"i{len(items)}", made(len(items)).encode()))
        size += len(items[-1][1])
    tracemalloc.start()
    block = decontaminate.Block(items, decontaminate.WINDOW)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(block.scanners) == 1 and held < 220 << 20 and peak < 750 << 20, (held >> 20, peak >> 20)
    (n, spans, found), (_, none, _) = block.hits([b"before " + items[-1][1] + b" after", None])
    assert not none
    assert spans == [(1, n - 1)] and items[-1][0] in found and (len(found) == len(items)) == (kind == "one text")


def test_scanner_finds_what_plain_search_finds():
    rng = random.Random(31)
    for _ in range(60):
        letters = "abcdefgh"[:rng.randrange(1, 9)]
        text = lambda n: " ".join(rng.choice(letters) for _ in range(rng.randrange(0, n)))  # noqa: E731,B023
        window = rng.choice([1, 2, 3, 5, 10])
        items = [(rng.choice(["x", "y", "z", None]), text(14).encode()) for _ in range(rng.randrange(0, 9))]
        block = decontaminate.Block(items, window)
        texts = [text(40) for _ in range(12)]
        for w, (n, spans, got) in zip(map(str.split, texts), block.hits([t.encode() for t in texts])):
            hit, found = set(), set()
            for item, x in items:
                x = x.decode().split()
                size = min(window, len(x))
                for j in range(len(x) - size + 1 if size else 0):
                    for k in range(len(w) - size + 1):
                        if w[k:k + size] == x[j:j + size]:
                            hit |= set(range(k, k + size))
                            found.add(item)
            assert (n, {i for a, b in spans for i in range(a, b)}, got) == (len(w), hit, found)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 120])
def test_decontamination_brute_force(spark, docs_of, block_bytes):
    rng = random.Random(4)
    word = lambda: rng.choice("ab cd ef gh Ij kl".split())
    items = [(f"{i}", " ".join(word() for _ in range(rng.choice([1, 3, 10, 12, 15])))) for i in range(14)]
    items += [("14", None), ("15", "?!"), ("16", items[0][1])]
    docs = []
    for i in range(60):
        pick = rng.choice(items[:14])[1]
        docs.append((i, None if i % 11 == 0 else " ".join(word() for _ in range(rng.randrange(0, 40))) + f" -{pick.upper()}-"))
    docs.append((1, docs[1][1]))
    bench = spark.createDataFrame(items, "item_id string, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    got = decontaminate.scan(docs_of(docs), bench, "found", block_bytes=block_bytes, keep=["doc_id"]).select("doc_id", "found.*").collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for item, x in items:
            x = split(x)
            size = min(10, len(x))
            for j in range(len(x) - size + 1 if size else 0):
                for k in range(len(w) - size + 1):
                    if w[k:k + size] == x[j:j + size]:
                        hit |= set(range(k, k + size))
                        found.add(item)
        r = by[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    clean = decontaminate.decontaminate(docs_of(docs), bench)
    assert clean.columns == docs_of(docs).columns
    assert decontaminate.scan(docs_of(docs), bench.limit(0), "found").where("found.n_hit > 0").count() == 0


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 40])
def test_decontamination_by_items_without_id(spark, docs_of, block_bytes):
    item = "one two three four five six seven eight nine ten eleven"
    docs = docs_of([(1, f"start {item} end"), (2, "plain text"), (3, f"{item} and other words of an item that has an id here at last")])
    bench = spark.createDataFrame([(None, item), (None, item.replace("one", "1")), ("a", "other words of an item that has an id here at last"),
                                   ("b", None)], "item_id string, text string")
    got = {r.doc_id: r.f for r in decontaminate.scan(docs, bench, "f", block_bytes=block_bytes).select("doc_id", "f").collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(11, 1, True), (0, 0, False), (23, 2, True)]
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest() and got[3].items_sha256 == hashlib.sha256(b"a").hexdigest()


def test_license_rules(docs_of):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction.\nThe above copyright notice "
           "and this permission notice shall be included in all copies or substantial portions of the Software.")
    rows = [(1, mit), (2, "Text. Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."), (3, None), (4, ""),
            (5, "licensed under nothing known"), (6, "Released under the MIT License.\n" + "x " * 20000 + "\nAll rights reserved.")]
    got = {r.doc_id: r for r in license_scan.scan(docs_of(rows)).collect()}
    assert (got[1].rules, got[1].licenses, got[1].sentence_ids) == ("mit-text-short", "MIT", "<3><4>")
    assert (got[2].n_sentences, got[2].licenses) == (2, "CC-BY-NC-4.0")
    assert [got[i].rules for i in (3, 4, 5)] == ["", "", ""] and got[6].licenses == "MIT,Proprietary"
    for s in license_scan.SENTENCES.values():
        assert any(a in s for a in license_scan.ANCHORS)
    assert {i for r in license_scan.RULES.values() for i in r} == set(license_scan.SENTENCES)


@pytest.mark.parametrize("width,lead", [(10**6, ""), (76, ""), (72, " * "), (60, "# ")])
def test_published_licenses(docs_of, width, lead):
    import textwrap
    rows, want = [], {}
    for i, (rule, (name, text)) in enumerate(license_scan.PUBLISHED.items()):
        flat = " ".join(text.split())
        body = "\n".join(lead + x for x in textwrap.wrap(flat, width, break_on_hyphens=False))
        rows.append((i, f"{lead}Some program\n{lead}Copyright (c) 2020 Somebody\n{body}\n{lead}\n{lead}More words"))
        want[i] = (rule, name)
    got = {r.doc_id: (r.rules, r.licenses) for r in license_scan.scan(docs_of(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("line", ["\n", " *\n", "\n#\n", "-- \r\n"])
def test_licenses_between_a_million_blank_lines(docs_of, line):
    text = "see the license" + "\n" + line * 1_000_000 + "Released under the MIT License.\n" + line * 1_000_000
    assert [(r.rules, r.licenses) for r in license_scan.scan(docs_of([(1, text)])).collect()] == [("mit-released", "MIT")]


def test_license_sql_knows_published_texts(spark, tmp_path):
    import textwrap
    rows = [(i, "\n".join(textwrap.wrap(" ".join(text.split()), width, break_on_hyphens=False)), "en", "s", 0)
            for i, (width, (_, text)) in enumerate(itertools.product((60, 76, 10**6), license_scan.PUBLISHED.values()))]
    rows += [(1000 + i, f"Intro.\n\n * Copyright (c) 2020 X\n *\n * {a}\n *\n * {b}.\nEnd", "en", "s", 0)
             for i, (a, b) in enumerate(itertools.product(license_scan.SENTENCES.values(), repeat=2))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(license_scan.ORACLE)
    got = license_scan.query(spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.fetchall()) and sum(r.rules != "" for r in got) > 400


@pytest.mark.parametrize("shard_bytes", [url_filter.SHARD_BYTES, 8])
def test_urls_brute_force(spark, shard_bytes):
    rng = random.Random(8)
    names = ["spam-farm", "good", "adult-x", "blog", "m", "news", "casino", "alphabets", "oil-spills"]
    urls = [f"http{'s' * (i % 2)}://{'.'.join(rng.choice(names) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 3)))}"
            f".example.{rng.choice(['com', 'org', 'net'])}{rng.choice(['', '/de/x', '/fr/', '/en/12?a#b', '/es/1', '?q', '#t'])}"
            for i in range(500)]
    urls += [None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/en/1x", "x://com/de/", "http://..a./p", "http://org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as host", "1 as bad")
    got = {r.page_id: r for r in url_filter.judge(pages, shard_bytes=shard_bytes).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group().lower()
        path = re.match(r"[^?#]*", rest[len(host):]).group() if rest else ""
        fits = [(v, h, p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        listed = any(re.search(f"(^|[^a-z])({'|'.join(url_filter.BLOCKED_WORDS)})([^a-z]|$)", label) for label in host.split("."))
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1] + rule[2])
        assert r.verdict == (rule[0] if rule else "block" if listed else "allow"), u
    assert url_filter.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("shard_bytes", [url_filter.SHARD_BYTES, 8])
def test_urls_by_a_table_of_domains(spark, shard_bytes):
    hosts = [f"h{i % 40}.d{i % 13}.example.net" for i in range(300)] + ["casino.example.net", "", "d3.example.net", "D5.Example.NET"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    listed = [".d3.example.net", "D5.example.net", "h7.d7.example.net", "elsewhere.org", "", None, "h7.d7.example.net"]
    table = spark.createDataFrame([(x, 1) for x in listed], "name string, domain long")
    bad = {"d3.example.net", "d5.example.net", "h7.d7.example.net"}
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, shard_bytes=shard_bytes, domains=table, domain="name").collect()}
    for i, h in enumerate(hosts):
        h = h.lower()
        assert got[i] == ("block" if any(h == b or h.endswith("." + b) for b in bad) else "allow"), h
    none = url_filter.judge(pages, domains=table.limit(0), domain="name").collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(hosts)
