"""Repeated passages, filter audits and periodic runs against brute force."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from dialstat.llm import filter_audit, periodic_runs, suffix_dedup

SF = "/root/testdata/sf0.001"
LAST = 1 << 62


def passages(seed, n=300):
    """Texts with shared passages, copies, periodic parts and texts of nothing, by id."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdefgh ijé") for _ in range(rng.randrange(30, 400))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rng.randrange(1, 6)):
            k = rng.random()
            if k < 0.4:
                p = rng.choice(shared)
                a = rng.randrange(len(p))
                t += p[a:a + rng.randrange(1, len(p) + 1)]
            elif k < 0.5:
                t += rng.choice(["x", "ab", "abc "]) * rng.randrange(1, 120)
            elif k < 0.6 and rows:
                t += rng.choice(rows)[1]
            else:
                t += "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(200)))
        rows.append((i, t[:3000]))
    rows += [(600 + i, f"{i * 7919 % 100000:05d}" * 3 + shared[3][:110] + f"{i * 104729 % 100000:05d}" * 4) for i in range(60)]
    return rows + [(700, None), (701, ""), (702, "q" * 99), (703, "q" * 100), (703, "q" * 100), (None, "q" * 150), (None, shared[0])]


def without_repeats(rows, window=100):
    first, out = set(), {}
    for d, t in sorted({(LAST if d is None else d, (t or "").encode()) for d, t in rows}):
        gone = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if t[s:s + window] in first:
                gone[s:s + window] = b"\1" * window
            first.add(t[s:s + window])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d, t] = len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()
    return out


@pytest.mark.parametrize("group, batch", [(20_000, 10_000), (3, 7)])  # groups sorted at once; cut by longer digits first
def test_passages_brute_force(spark, docs_of, group, batch):
    rows = passages(3)
    want = without_repeats(rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = suffix_dedup.cut(docs_of(rows, clash=("d", "t", "key", "place", "z_", "row_", "cut_x")).repartition(5),
                               keep=["doc_id", "text", "d"], digest=True, group=group).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(rows) and sum(r.cut_.n_removed for r in got) > 10_000
    for r in got:
        assert tuple(r.cut_) == want[LAST if r.doc_id is None else r.doc_id, (r.text or "").encode()], r.doc_id


def test_passages_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = without_repeats(rows)
    by_id = {d: v for (d, _), v in want.items()}
    got = suffix_dedup.query(spark, SF).collect()
    assert len(got) == len(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == by_id[r.doc_id] for r in got)


def test_cut_returns_the_bytes_left(docs_of):
    text = "".join(random.Random(1).choices("abcdefghij", k=150))
    got = {r.doc_id: r.cut_.kept for r in suffix_dedup.cut(docs_of([(1, text), (2, "start " + text + " end")])).collect()}
    assert bytes(got[1]).decode() == text and bytes(got[2]) == b"start  end"


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(12, 2 * q) and not any(w[i:i + n - p] == w[i + p:i + n] for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out)


def repeat(s, n):
    return (s * (n // len(s) + 1))[:n]


def periodic_words(seed, n):
    rng = random.Random(seed)
    some = lambda k, n: [rng.randrange(k) for _ in range(n)]
    for i in range(n):
        kind, size = i % 6, rng.randrange(1, 140)
        if kind < 2:
            yield some(2 + kind, size)
        elif kind == 2:
            yield [x for _ in range(rng.randrange(1, 6)) for x in repeat(some(2, rng.randrange(1, 6)), rng.randrange(1, 50))]
        elif kind == 3:
            root = [x for _ in range(rng.randrange(1, 4)) for x in repeat(some(2, rng.randrange(1, 4)), rng.randrange(1, 30))]
            yield repeat(root, rng.randrange(len(root), 4 * len(root) + 1)) + some(2, rng.randrange(5))
        elif kind == 4:
            a, b = [0], [0, 1]
            while len(b) < size + 20:
                a, b = b, b + a
            yield b[rng.randrange(10):][:size + 10]
        else:
            u = some(2, rng.randrange(1, 4))
            s = repeat(u, rng.randrange(10, 60)) + repeat(u, rng.randrange(10, 60)) + repeat(u[::-1], rng.randrange(1, 60))
            yield s + s[:rng.randrange(len(s) + 1)]


def test_runs_brute_force():
    several = list(periodic_words(1, 1500))
    w = np.array([x for s in several for x in s], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    got = periodic_runs.find_runs(w, np.repeat(np.arange(len(several)), [len(s) for s in several]))
    want = [brute_runs(s) for s in several]
    assert [got.get(i, []) for i in range(len(several))] == want and sum(map(len, want)) > 5000


@pytest.mark.parametrize("words, n", [(["x"] * 300_000, 1), ([f"w{i % 1000}" for i in range(300_000)], 1),
                                      ((["a", "b"] * 8 + ["c"]) * 10_000, 10_001)])
def test_long_repetitions_stay_linear(words, n):
    number = {x: i for i, x in enumerate(sorted(set(words)))}
    w = np.array([number[x] + 1 for x in words], np.uint64)
    assert len(periodic_runs.find_runs(w, np.zeros(len(w), np.int64))[0]) == n


def run_row(doc_id, text):
    words = (text or "").split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    named = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(named.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_runs_query_on_the_small_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
            if len((r.text or "").split()) < 400}
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.query(spark, SF).collect()}
    assert sum(got[d][0] for d in docs) > 10
    assert all(got[d] == run_row(d, t) for d, t in docs.items())


def test_runs_edge_cases(docs_of):
    rows = [(1, None), (2, ""), (3, "a " * 11), (4, "aé\n" * 12), (4, "aé\n" * 12), (None, "x y " * 6), (5, "x y " * 5 + "x")]
    got = {r.doc_id: r for r in periodic_runs.detect(docs_of(rows, clash=("packed_", "runs_", "start", "length")), "found").collect()}
    assert [got[i].found.n_runs for i in (1, 2, 3, 4, None, 5)] == [0, 0, 0, 1, 1, 0]
    assert got[4].found.collapsed == "aé" and got[None].found.collapsed == "x y" and got[4].start == "x"
    out = periodic_runs.collapse(docs_of(rows)).collect()
    assert {r.doc_id: r.text for r in out}[None] == "x y" and len(out) == len(rows) and {r.doc_id: r.text for r in out}[3] == "a " * 11


def test_trie_against_a_dictionary():
    rng = random.Random(2)
    trie, want = filter_audit.Trie(), {}
    for _ in range(5000):
        t = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) + b"z" * rng.choice([0, 0, 40])
        i = rng.choice([None, rng.randrange(1000)])
        trie.add(t, t, i, 1)
        old = want.setdefault(t, [t, None, 0])
        old[1] = i if old[1] is None else old[1] if i is None else min(old[1], i)
        old[2] += 1
    assert sorted(trie.terminals()) == sorted(want.values())


def test_audit_brute_force(spark, docs_of):
    rng = random.Random(4)
    texts = ["", "a # b", "A" * 30, "w " * 300, " ".join(f"v{i}" for i in range(250)), " ".join(f"V{i}" for i in range(250)) + " $", None]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", None]), "s") for _ in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(2, 1, 1), (None, 1, 1)]
    got = filter_audit.audit(docs_of(rows, clash=("key", "part", "mask", "n", "m", "least")),
                             spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    masked = []
    for d, t, lang, _ in rows:
        same = [e for e, u, _, _ in rows if (u or "") == (t or "") and e is not None]
        late = bool(same) and (d is None or min(same) < d)
        fails = filter_audit.text_mask((t or "").encode()) | late << 4
        masked.append((lang or "", fails, any(i == d and q == 1 for i, q, _ in labels if i is not None),
                       any(i == d and x == 1 for i, _, x in labels if i is not None)))
    want, shapley = {}, {}
    for part, order in itertools.product(["en", "de", ""], map("".join, itertools.permutations("ABCDE"))):
        left = [m for m in masked if m[0] == part]
        for step, letter in enumerate(order, 1):
            bit = 1 << "ABCDE".index(letter)
            out = [m for m in left if m[1] & bit]
            every = [m for m in masked if m[0] == part and m[1] & bit]
            left = [m for m in left if not m[1] & bit]
            want[part, order, step] = (len(left), len(out), len(every) - len(out), sum(m[1] == bit for m in every),
                                       sum(m[2] for m in out), sum(m[3] for m in out))
            shapley[part, letter] = shapley.get((part, letter), 0) + len(out)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[4:10] == want[r.part, r.filter_order, r.step], r
        assert r.shapley == shapley[r.part, r.letter] and r.letter == r.filter_order[r.step - 1]


def test_audit_hands_small_batches_to_python(spark, docs_of, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = [(i, f"word{i % 40} " * 300, "en", "s") for i in range(200)]
    docs, labels = docs_of(rows), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    before, limits, stage = spark.conf.get(name), {}, filter_audit.stage

    def noted(df, at):
        limits[at] = spark.conf.get(name)
        return stage(df, at)

    monkeypatch.setattr(filter_audit, "stage", noted)
    got = []
    for size in (4 << 20, 1 << 10):
        monkeypatch.setattr(filter_audit, "BATCH_BYTES", size, raising=False)
        got.append(sorted(map(tuple, filter_audit.audit(docs, labels).collect())))
        assert limits["audit-masks"] == limits["audit-repeated"] == str(size) and spark.conf.get(name) == before
    assert got[0] == got[1] and len(got[0]) == 600
