"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model counts word trigrams. Words are runs of letters, digits and bytes above 0x7F, runs of marks are
words too; words seen less than twice are one unknown word, spelled by a second Kneser-Ney model over 48
classes of bytes (order 4, at most 48^4 entries, added up by tasks and a Spark shuffle).

Counting and scoring: everything that one word needs except its own count as a word hangs on the word before
it, so the trigrams of all documents, trusted or not, are shuffled once by that word, packed by blocks of
``BLOCK_BYTES`` of text. A shard (about ``SHARD_WORDS`` trusted words) adds up its trusted trigrams,
contexts and bigrams; the discounts and the words' continuation counts are added up over all shards. Then each
shard makes its part of the model again from the same shuffle and sums the log probabilities of its words per
block and document; the sums of the shards are added up per block, and joined with the rows by a 64-bit hash of
the text. Every step runs in the workers of ``mapInArrow``, one for each core, which give back their freed memory. All other shuffles are deleted as soon as their table is written or collected. No task and no driver holds the n-grams, only the vocabulary (words seen twice in trusted text).

A document has two scores, of its words and of its characters (the model that spells unknown words, over all of
its bytes): mean log10 probability a byte, shrunk to its language's mean as by ``SHRINK`` bytes of that language.
It goes if one of the two perplexities is above its limit, the language's quantile ``QUANTILE`` over all trusted
documents that the model has not seen (every fourth), times ``SLACK`` + 1 / sqrt(number of those documents):
few of them give a wide margin.

Trusted text: documents labelled quality 1. Every fourth of them by a hash of the id sets limits and means, all
others are learnt, whole (a caller of ``judge`` may ask for fewer; the query and the pipeline do not).

Defined cases: null and empty texts have 0 bytes, and an empty score equal to the language's mean
(kept); a language without ``MIN_TRUSTED`` trusted documents has the limit of all languages; without
any trusted document every document is kept and perplexity is null; rows repeated each get their
verdict; a document labelled several times is trusted if one label says so.
"""

from __future__ import annotations

from contextlib import AbstractContextManager
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm import common
from dialstat.llm.common import annotate, fresh, read_table, shuffled_once, slices, stage, struct_of, tidy

ORDER, UNITS = 4, 48
MIN_TRUSTED = 30
QUANTILE, SLACK, SHRINK = 0.995, 1.05, 100
SHARD_BYTES, TEXT_BYTES = 32 << 20, 512 << 10
#: Trusted words, and bytes of all texts, of a shard of the trigrams; bytes of text whose trigrams travel together.
SHARD_WORDS, SHARD_TEXT, BLOCK_BYTES = 1 << 20, 24 << 20, 8 << 20
#: Bytes of rows that Spark hands to Python at a time while it scores (a longer row is handed over alone).
BATCH_BYTES = 4 << 20
#: Shards give sums of log10 probabilities as whole numbers of its reciprocal, so their order changes nothing.
UNIT_OF_LOG = float(1 << 32)
BOS, UNKNOWN, FIRST = 0, 1, 2  # numbers of the start of a text, of unknown words, of the first known word


def _classes() -> np.ndarray:
    """Byte -> unit: a-z 0-25, capitals 26-27 and 30-31, space 29, line ends 28, and groups of others."""
    unit = np.full(256, 41, np.uint8)
    for c in range(26):
        unit[97 + c] = c
        unit[65 + c] = (26, 27, 30, 31)[c % 4]
    unit[[0x20, 0x09]] = 29
    unit[[0x0A, 0x0B, 0x0C, 0x0D]] = 28
    unit[48:58] = 32
    for u, marks in ((33, b"."), (34, b","), (35, b"'\""), (36, b"-"), (37, b"!?"), (38, b"#*$%&"), (39, b"|<>"), (40, b":;()")):
        unit[list(marks)] = u
    unit[0x80:0xC0] = 42 + np.arange(64) % 4
    unit[0xC0:] = 46
    unit[0xC3] = 47
    return unit


UNIT = _classes()


def _grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram number that ends at each byte of all texts, and the texts' lengths."""
    lead = b"\n" * (ORDER - 1)
    lengths = np.array([len(t or b"") for t in texts], np.int64)
    units = UNIT[np.frombuffer(b"".join(lead + (t or b"") for t in texts), np.uint8)].astype(np.int32)
    grams = np.zeros(len(units), np.int32)
    for back in range(ORDER):
        grams[back:] += units[:len(units) - back] * UNITS**back
    inside = np.ones(len(units), bool)
    starts = np.cumsum(lengths + ORDER - 1) - lengths - (ORDER - 1)
    for i in range(ORDER - 1):
        inside[starts + i] = False
    return grams[inside], lengths


def gram_counts(texts: DataFrame, text: str) -> DataFrame:
    """(g, c): counts of n-grams over all texts, added up in each task first."""
    def run(batches):
        total, held = np.zeros(UNITS**ORDER, np.int32), 0

        def rows():
            seen = np.flatnonzero(total)
            for i in range(0, len(seen), 50_000):
                part = seen[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())],
                                                 names=["g", "c"])

        for b in batches:
            for at in range(0, b.num_rows, 2048):
                docs = b.column(0).slice(at, 2048).cast(pa.binary()).to_pylist()
                for lo, hi in slices(docs, TEXT_BYTES):
                    grams, _ = _grams(docs[lo:hi])
                    if held + len(grams) >= 1 << 31:
                        yield from rows()
                        total[:], held = 0, 0
                    held += len(grams)
                    found, times = np.unique(grams, return_counts=True)
                    total[found] += times.astype(np.int32)
        yield from rows()

    return texts.select(f"`{text}`").mapInArrow(tidy(run), "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(k, g, p, gamma) of every seen n-gram of order k = 1..ORDER.

    p is the discounted part of its probability, gamma the weight that its context (all but its last
    unit) gives to the lower order.
    """
    table, out = stage(counts, "kn-counts"), None
    for k in range(ORDER, 0, -1):
        of = table.groupBy().agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
        n1, n2, n3, n4 = (max(of[f"n{i}"], 1) for i in range(1, 5))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(i - (i + 1) * y * b / a, 0.1), i - 0.1) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = table.withColumn("context", F.floor(F.col("g") / UNITS)).withColumn("off", off)
        totals = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("off").alias("kept"))
        part = rows.join(totals, "context").select(
            F.lit(k).alias("k"), "g", ((F.col("c") - F.col("off")) / F.col("total")).alias("p"),
            (F.col("kept") / F.col("total")).alias("gamma"))
        out = part if out is None else out.unionAll(part)
        # continuation counts: in how many different units' company the shorter n-gram was seen
        table = table.groupBy((F.col("g") % F.lit(UNITS**(k - 1))).alias("g")).agg(F.count(F.lit(1)).alias("c"))
    return out


def dense(rows) -> np.ndarray:
    """log10 probability of every n-gram from the rows of ``kneser_ney`` (arrays k, g, p, gamma).

    Each order is filled in place, one leading unit at a time, so no second table is held.
    """
    k, g, p, gamma = rows
    low = np.full((1, UNITS), 1 / UNITS, np.float32)
    for order in range(1, ORDER + 1):
        here = k == order
        weight = np.ones(UNITS**(order - 1), np.float32)
        weight[g[here] // UNITS] = gamma[here]
        table = np.empty((UNITS**(order - 1), UNITS), np.float32)
        for at in range(0, len(table), len(low)):
            np.multiply(weight[at:at + len(low), None], low, out=table[at:at + len(low)])
        flat = table.reshape(-1)
        flat[g[here]] += p[here].astype(np.float32)
        low = table
    return np.log10(flat, out=flat)


#: Byte -> 0 white space and controls, 1 part of a word, 2 mark; and byte -> its part of a word's hash.
_KIND = np.where(np.arange(256) <= 0x20, 0, 2)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND = _KIND.astype(np.uint8)
_PART = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * (_KIND > 0)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_spans(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of all texts: where it begins in the joined texts, the number of its text, a 64-bit hash."""
    lengths = np.array([len(t or b"") for t in texts], np.int64)
    buf = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[buf]
    begins = kind != 0
    begins[1:] &= kind[1:] != kind[:-1]
    ends = np.cumsum(lengths)
    first = (ends - lengths)[lengths > 0]
    begins[first] = kind[first] != 0
    at = np.flatnonzero(begins)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_PART[buf] * _powers(_BASE, len(buf)), dtype=np.uint64)])
    hashes = (sums[np.append(at[1:], len(buf))] - sums[at]) * _powers(_INVERSE, len(buf))[at]
    return at, np.searchsorted(ends, at, "right"), hashes.view(np.int64)


def _numbers(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers of words; ``words`` are the known words' hashes, sorted."""
    if not len(words):
        return np.full(len(hashes), UNKNOWN, np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at + FIRST, UNKNOWN)


def _before(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The second last and the last word before each word of its text."""
    one, two = np.full(len(ids), BOS, np.int64), np.full(len(ids), BOS, np.int64)
    one[1:] = np.where(doc[1:] == doc[:-1], ids[:-1], BOS)
    two[2:] = np.where(doc[2:] == doc[:-2], ids[:-2], BOS)
    return two, one


def _added(texts: DataFrame, text: str, names: list[str], keys) -> DataFrame:
    """(*names, c): counts of the keys that ``keys`` finds in lists of texts, added up in each task first."""
    def run(batches):
        held, size = [], 0

        def rows():
            cols = [np.concatenate(c) for c in zip(*held)]
            order = np.lexsort(cols[::-1])
            cols = [c[order] for c in cols]
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(order)))
            for i in range(0, len(at), 50_000):
                yield pa.RecordBatch.from_arrays([*[pa.array(c[at[i:i + 50_000]]) for c in cols], pa.array(counts[i:i + 50_000])],
                                                 names=[*names, "c"])

        for b in batches:
            for first in range(0, b.num_rows, 2048):
                docs = b.column(0).slice(first, 2048).cast(pa.binary()).to_pylist()
                for lo, hi in slices(docs, TEXT_BYTES):
                    found = keys(docs[lo:hi])
                    if len(found[0]):
                        held.append(found)
                        size += len(found[0])
                    if size > 500_000:
                        yield from rows()
                        held, size = [], 0
        if held:
            yield from rows()

    added = texts.select(f"`{text}`").mapInArrow(tidy(run), ", ".join(f"{n} long" for n in [*names, "c"]))
    return added.groupBy(*names).agg(F.sum("c").alias("c"))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    of = table.groupBy().agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (max(of[f"n{i}"], 1) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(i - (i + 1) * y * b / a, 0.1), i - 0.1) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def _totals(table: DataFrame, by: str, d) -> DataFrame:
    """(by, total, kept): a context's count, and the part of it that its discounts give to the lower order."""
    off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
    return table.groupBy(by).agg(F.sum("c").alias("total"), F.sum(off).alias("kept"))


def _packed(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as steps, in the least type that holds them."""
    steps = np.diff(keys, prepend=0)
    return steps.astype(np.min_scalar_type(int(steps.max(initial=0))))


class Words:
    """Interpolated modified Kneser-Ney model over word trigrams, its n-grams in broadcast shards.

    For models that fit the driver; ``judge`` gets the same probabilities from ``word_scores``, by a shuffle.
    """

    def __init__(self, texts: DataFrame, text: str, shard_bytes: int = SHARD_BYTES):
        spark = texts.sparkSession
        seen = _added(texts, text, ["h"], lambda ts: (word_spans(ts)[2],)).where("c > 1").select("h")
        words = np.sort(seen.toArrow()["h"].to_numpy())
        self.size = size = len(words) + FIRST
        known = spark.sparkContext.broadcast(words)

        def trigrams(ts):
            _, doc, hashes = word_spans(ts)
            ids = _numbers(hashes, known.value)
            two, one = _before(ids, doc)
            return two * size + one, ids

        tri = stage(_added(texts, text, ["uv", "w"], trigrams), "word-trigrams")
        bi = stage(tri.groupBy((F.col("uv") % size).alias("v"), "w").agg(F.count(F.lit(1)).alias("c")), "word-bigrams")
        d3, d2 = _discounts(tri), _discounts(bi)
        contexts = stage(_totals(tri, "uv", d3), "word-contexts")
        uni = bi.groupBy("w").agg(F.count(F.lit(1)).alias("c"))
        d1 = _discounts(uni)
        counts = np.zeros(size, np.int64)
        got = uni.toArrow()
        counts[got["w"].to_numpy()] = got["c"].to_numpy()
        total, self.kept = np.zeros(size), np.zeros(size)
        got = _totals(bi, "v", d2).toArrow()
        total[got["v"].to_numpy()], self.kept[got["v"].to_numpy()] = got["total"].to_numpy(), got["kept"].to_numpy()
        self.total, self.d2, self.d3, self.words = total, np.array([0.0, *d2]), np.array([0.0, *d3]), words
        off, all_ = np.array([0.0, *d1])[np.minimum(counts, 3)], max(counts.sum(), 1)
        left = off.sum() / all_ if counts.sum() else 1.0
        self.one = (counts - off) / all_ + left / (size - 1) * (np.arange(size) != BOS)
        n_rows = tri.count() + bi.count() + contexts.count()
        self.n_shards = max(1, -(-n_rows * 16 // shard_bytes))
        self.shards = [spark.sparkContext.broadcast(self._shard(tri, bi, contexts, k)) for k in range(self.n_shards)]
        known.destroy()

    def _shard(self, tri, bi, contexts, k):
        here = lambda c: F.pmod(c, F.lit(self.n_shards)) == k
        got = contexts.where(here(F.col("uv") % self.size)).toArrow()
        uv = got["uv"].to_numpy()
        order = np.argsort(uv)
        uv = uv[order]
        least = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
        out = [_packed(uv), least(got["total"].to_numpy()[order]), got["kept"].to_numpy()[order].astype(np.float32)]
        for rows, key in ((tri.where(here(F.col("uv") % self.size)), lambda r: np.searchsorted(uv, r["uv"].to_numpy()) * self.size),
                          (bi.where(here(F.col("v"))), lambda r: r["v"].to_numpy() * self.size)):
            got = rows.toArrow()
            keys = key(got) + got["w"].to_numpy()
            order = np.argsort(keys)
            out += [_packed(keys[order]), least(got["c"].to_numpy()[order])]
        return out

    def model(self):
        """What tasks need, without the shards."""
        return self.size, self.words, self.one, self.total, self.kept, self.d2, self.d3


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted keys in sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _mixed(p: np.ndarray, found, at, counts, total, kept, d) -> np.ndarray:
    """The order's discounted share plus the weight of its context times the lower order ``p``; unseen contexts give ``p``."""
    c = np.where(found, counts[at] if len(counts) else 0, 0)
    seen = total > 0
    of = np.where(seen, total, 1)
    return np.where(seen, (c - d[np.minimum(c, 3)]) / of + kept / of * p, p)


def _interpolated(u, v, w, low, size, keys, of, bi_of, d) -> np.ndarray:
    """p(w | u v) from the tables of contexts, trigrams and bigrams, over the lowest order's ``low``."""
    (uv, tri, bi), (uv_total, uv_kept, tri_c, bi_c), (total, kept) = keys, of, bi_of
    at, found = _find(bi, v * size + w)
    p = _mixed(low, found, at, bi_c, total[v], kept[v], d[0])
    if not len(uv):
        return p
    context, seen = _find(uv, u * size + v)
    at, found = _find(tri, context * size + w)
    return _mixed(p, found & seen, at, tri_c, np.where(seen, uv_total[context], 0), uv_kept[context], d[1])


def probabilities(u: np.ndarray, v: np.ndarray, w: np.ndarray, model, shards) -> np.ndarray:
    """p(w | u v) for arrays of word numbers; holds one of the shards (broadcasts) at a time."""
    size, _, one, total, kept, d2, d3 = model
    out = one[w]
    for k, shard in enumerate(shards):
        here = np.flatnonzero(v % len(shards) == k)
        if not len(here):
            continue
        uv, uv_total, uv_kept, tri, tri_c, bi, bi_c = shard.value
        if len(shards) > 1:
            shard.__dict__.pop("_value", None)  # only this name holds it
        keys = [np.cumsum(k, dtype=np.int64) for k in (uv, tri, bi)]
        p = _interpolated(u[here], v[here], w[here], out[here], size, keys, (uv_total, uv_kept, tri_c, bi_c), (total, kept), (d2, d3))
        out[here] = p
    return out


def _local(table, words, ids, texts):
    """(lengths, sums of log10 probabilities by characters, by white space and spelled unknown words) of texts."""
    grams, lengths = _grams(texts)
    sums = np.concatenate([[0.0], np.cumsum(table[grams], dtype=np.float64)])
    ends = np.cumsum(lengths)
    at, doc, hashes = word_spans(texts)
    w = _numbers(hashes, words) if ids is None else _ranked(hashes, words, ids)
    last = np.minimum(np.append(at[1:], len(grams)), ends[doc])
    spelled = np.where(w == UNKNOWN, sums[last] - sums[at], 0)
    begin = ends.copy()  # white space before the first word
    np.minimum.at(begin, doc, at)
    return lengths, sums[ends] - sums[ends - lengths], sums[begin] - sums[ends - lengths], spelled, w, doc


def scorer(rows, model, shards):
    """Turns a list of texts into (number of bytes, sum of log10 probabilities by words, by characters)."""
    table = dense(rows)

    def score(texts):
        out, ids, docs, spelled, plain, chars, first = [], [], [], [], [], [], 0
        for lo, hi in slices(texts, TEXT_BYTES):
            lengths, by_chars, blank, unknown, w, doc = _local(table, model[1], None, texts[lo:hi])
            ids.append(w)
            docs.append(doc + first)
            spelled.append(unknown)
            plain.append(blank)
            chars += by_chars.tolist()
            out += lengths.tolist()
            first += hi - lo
        if not out:
            return []
        w, doc = np.concatenate(ids), np.concatenate(docs)
        two, one = _before(w, doc)
        logs = np.log10(probabilities(two, one, w, model, shards)) + np.concatenate(spelled)
        logs = np.concatenate(plain) + np.bincount(doc, logs, len(out))
        return list(zip(out, logs.tolist(), chars))

    return score


def local_scorer(rows, words, ids):
    """Turns a list of texts into what needs no n-grams of words: (bytes, sum by characters, sum of blanks and spelled words)."""
    table = dense(rows)

    def score(texts):
        out = []
        for lo, hi in slices(texts, TEXT_BYTES):
            lengths, by_chars, blank, unknown, _, doc = _local(table, words, ids, texts[lo:hi])
            out += zip(lengths.tolist(), by_chars.tolist(), (blank + np.bincount(doc, unknown, hi - lo)).tolist())
        return out

    return score


def _ranked(hashes: np.ndarray, words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Numbers of words by ``ids``, those of the known words' sorted hashes: frequent words have small ones, which pack well."""
    at = _numbers(hashes, words)
    return np.where(at == UNKNOWN, UNKNOWN, ids[np.maximum(at - FIRST, 0)] if len(ids) else UNKNOWN).astype(np.int64)


_CODEC = "zstd"


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of non-negative numbers, each byte of them compressed on its own."""
    out = [np.array([len(columns), len(columns[0])], np.int64).tobytes()]
    codec = pa.Codec(_CODEC, 3)
    for c in columns:
        width = max(1, (int(c.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
        parts = [codec.compress(p.tobytes(), asbytes=True) for p in planes] if len(c) else []
        out += [np.array([len(parts), *map(len, parts)], np.int32).tobytes(), *parts]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    codec = pa.Codec(_CODEC)
    n_columns, n = np.frombuffer(data, np.int64, 2)
    at, out = 16, []
    for _ in range(n_columns):
        width = int(np.frombuffer(data, np.int32, 1, at)[0])
        sizes = np.frombuffer(data, np.int32, width, at + 4)
        at += 4 + 4 * width
        planes = np.zeros((n, 8), np.uint8)
        for i, size in enumerate(sizes.tolist()):
            planes[:, i] = np.frombuffer(codec.decompress(data[at:at + size], int(n), asbytes=True), np.uint8)
            at += size
        out.append(planes.reshape(-1).view("<i8"))
    return out


def _steps(c: np.ndarray, fresh_at: np.ndarray) -> np.ndarray:
    """Differences to the number before; whole numbers where a run begins."""
    return np.where(fresh_at, c, np.diff(c, prepend=0))


def _sums(steps: np.ndarray, fresh_at: np.ndarray) -> np.ndarray:
    total, at = np.cumsum(steps), np.flatnonzero(fresh_at)
    return total - np.repeat(total[at] - steps[at], np.diff(np.append(at, len(steps))))


def _pack_trigrams(u, v, w, doc) -> bytes:
    """Trigrams sorted by v, u, w, with the number of their document."""
    new = np.zeros(len(v), bool)
    new[:1] = True
    dv = _steps(v, new)
    new |= dv > 0
    du = _steps(u, new)
    return _pack(dv, du, _steps(w, new | (du > 0)), doc)


def _unpack_trigrams(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dv, du, dw, doc = _unpack(data)
    new = np.zeros(len(dv), bool)
    new[:1] = True
    new |= dv > 0
    return _sums(du, new), np.cumsum(dv), _sums(dw, new | (du > 0)), doc


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; they go."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


_TRIGRAMS, _KEYS = 0, 1  # kinds of packed rows
_PACKED = "shard long, kind int, block long, learnt long, payload binary"


def packed_trigrams(docs: DataFrame, known, size: int, n_shards: int, block_bytes: int) -> DataFrame:
    """Rows ``_PACKED`` of all texts of ``docs`` (t, key, learn), by block and shard of the word before.

    Documents of a block are numbered, the ``learnt`` ones first; a row ``_KEYS`` has their keys. v is given
    as its number inside the shard.
    """
    def run(batches):
        words, ids = known.value
        task, number, held, keys, learn, n_bytes = TaskContext.get().partitionId(), 0, ([], [], [], []), [], [], 0

        def rows():
            flags = np.array(learn, bool)
            place = np.empty(len(flags), np.int64)
            place[np.argsort(~flags, kind="stable")] = np.arange(len(flags))
            u, v, w, doc = map(_joined, held)
            learnt, block = int(flags.sum()), task << 32 | number
            shards = v % n_shards
            order = np.argsort(shards, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(shards, minlength=n_shards))])
            for shard in np.flatnonzero(np.diff(cuts)).tolist():  # sorted shard by shard: no key of the whole block
                here = order[cuts[shard]:cuts[shard + 1]]
                here = here[np.lexsort((w[here], u[here], v[here]))]
                of = [c.astype(np.int64) for c in (u[here], v[here] // n_shards, w[here])]
                yield row(shard, _TRIGRAMS, block, learnt, _pack_trigrams(*of, place[doc[here]]))
            by_place = np.empty(len(flags), np.int64)
            by_place[place] = np.array(keys, np.int64)
            yield row(block % n_shards, _KEYS, block, learnt, by_place.tobytes())

        def row(*values):  # a batch of its own: neither side holds a whole block's rows
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds)],
                                              names=["shard", "kind", "block", "learnt", "payload"])

        for b in batches:
            texts = b.column(0).cast(pa.binary()).to_pylist()
            for lo, hi in slices(texts, TEXT_BYTES):
                _, doc, hashes = word_spans(texts[lo:hi])
                w = _ranked(hashes, words, ids)
                for parts, c in zip(held, (*_before(w, doc), w, doc + len(keys))):
                    parts.append(c.astype(np.int32))
                keys += b.column(1).slice(lo, hi - lo).to_pylist()
                learn += b.column(2).slice(lo, hi - lo).to_pylist()
                n_bytes += sum(len(t or b"") for t in texts[lo:hi])
                if n_bytes >= block_bytes:
                    yield from rows()
                    number, keys, learn, n_bytes = number + 1, [], [], 0
        if keys:
            yield from rows()

    return docs.select("t", "key", "learn").mapInArrow(tidy(run), _PACKED)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


class _Shard:
    """Trigrams, contexts and bigrams of the trusted words of one shard, counted: first in each block, then all."""

    def __init__(self, size: int):
        self.size, self.parts = size, ([np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)])

    def add(self, learnt: int, payload: bytes) -> None:
        if not learnt:
            return
        u, v, w, doc = _unpack_trigrams(payload)
        of = doc < learnt
        u, v, w = u[of], v[of], w[of]
        at = _runs(v, u, w)  # the trigrams of a block are sorted
        for parts, c in zip(self.parts, (u[at] * self.size + v[at], w[at].astype(np.int32), np.diff(np.append(at, len(w))).astype(np.int32))):
            parts.append(c)

    def count(self) -> _Shard:
        uv, w, c = map(_joined, self.parts)
        order = np.lexsort((w, uv))
        uv, w = uv[order], w[order]
        at = _runs(uv, w)
        self.c3 = np.add.reduceat(c[order], at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
        uv, w = uv[at], w[at]
        self.context_at = _runs(uv)
        self.uv = uv[self.context_at]
        self.tri = np.repeat(np.arange(len(self.uv)), np.diff(np.append(self.context_at, len(uv)))) * self.size + w
        self.bi, self.c2 = np.unique(uv % self.size * self.size + w, return_counts=True)
        return self

    def tables(self, d2, d3):
        """The arguments of ``_interpolated`` after the size."""
        add = lambda x, at: np.add.reduceat(x, at) if len(at) else np.zeros(0)
        sums = (add(self.c3, self.context_at), add(d3[np.minimum(self.c3, 3)], self.context_at).astype(np.float32), self.c3, self.c2)
        v = self.bi // self.size
        n = int(v.max(initial=-1)) + 1
        return [self.uv, self.tri, self.bi], sums, (np.bincount(v, self.c2, n), np.bincount(v, d2[np.minimum(self.c2, 3)], n)), (d2, d3)


def _by_shard(batches, size: int, held: list | None = None) -> dict[int, _Shard]:
    """The counted shards of a task's batches ``_PACKED``; ``held`` gets their rows (shard, kind, block, payload), still packed."""
    out = {}
    for b in batches:
        for shard, kind, block, learnt, payload in zip(*(c.to_pylist() for c in b.columns)):
            of = out.setdefault(shard, _Shard(size))
            if kind == _TRIGRAMS:
                of.add(learnt, payload)
            if held is not None:
                held.append((shard, kind, block, payload))
    return out


def _counted(batches, size: int):
    """(w, c) of the shards: the continuation counts of words; -(10 k + i): n-grams of order k that were counted i times."""
    for shard in _by_shard(batches, size).values():
        shard.count()
        words, counts = np.unique(shard.bi % size, return_counts=True)
        orders = [(-(10 * k + i), int((c == i).sum())) for k, c in ((3, shard.c3), (2, shard.c2)) for i in range(1, 5)]
        words, counts = (np.concatenate(c) for c in zip((words, counts), zip(*orders)))
        for i in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 50_000], pa.int64()) for c in (words, counts)], names=["w", "c"])


def _shard_sums(batches, size: int, one, d2, d3):
    """(block, kind, payload): the keys of blocks, and sums of log10 probabilities by document and shard."""
    rows = []
    shards = _by_shard(batches, size, rows)
    rows.sort(key=lambda row: row[0])
    for number, packed in groupby(rows, key=lambda row: row[0]):
        tables = shards.pop(number).count().tables(d2, d3)
        n = len(tables[2][0])
        for _, kind, block, payload in packed:
            if kind == _TRIGRAMS:
                u, v, w, doc = _unpack_trigrams(payload)
                p, known = one[w], v < n  # a word that trusted text has not before another gives the lowest order
                p[known] = _interpolated(u[known], v[known], w[known], p[known], size, *tables)
                docs, at = np.unique(doc, return_inverse=True)
                sums = np.rint(np.bincount(at, -np.log10(p), len(docs)) * UNIT_OF_LOG)
                payload = _pack(np.diff(docs, prepend=0), np.maximum(sums, 0).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())],
                                             names=["block", "kind", "payload"])


def _block_sums(table: pa.Table) -> pa.Table:
    """(key, s) of one block's rows (block, kind, payload)."""
    rows = list(zip(table["kind"].to_pylist(), table["payload"].to_pylist()))
    keys = next(np.frombuffer(p, np.int64) for kind, p in rows if kind == _KEYS)
    total = np.zeros(len(keys), np.int64)
    for payload in (p for kind, p in rows if kind == _TRIGRAMS):
        steps, sums = _unpack(payload)
        total[np.cumsum(steps)] += sums
    return pa.table({"key": pa.array(keys), "s": pa.array(total / -UNIT_OF_LOG)})


def _cut(n) -> tuple[float, float, float]:
    """Discounts of modified Kneser-Ney from the numbers of n-grams counted once to four times."""
    n1, n2, n3, n4 = (max(int(x), 1) for x in n)
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(i - (i + 1) * y * b / a, 0.1), i - 0.1) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def vocabulary(texts: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the words seen twice, their numbers by frequency, and the number of all words."""
    seen = stage(_added(texts, text, ["h"], lambda ts: (word_spans(ts)[2],)), "words")
    n = seen.agg(F.sum("c")).first()[0] or 0
    got = seen.where("c > 1").toArrow()
    words, counts = got["h"].to_numpy(), got["c"].to_numpy()
    order = np.argsort(words)
    words, counts = words[order], counts[order]
    ids = np.empty(len(words), np.int32)
    ids[np.argsort(-counts, kind="stable")] = np.arange(FIRST, FIRST + len(words))
    return words, ids, n


def word_scores(docs: DataFrame, known, n_shards: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, s): sum of the log10 probabilities of the words of each text of ``docs`` (t, key, learn).

    The model is that of all texts with ``learn``; ``known`` is a broadcast of the words' sorted hashes and numbers.
    """
    spark, size = docs.sparkSession, len(known.value[0]) + FIRST
    packed = packed_trigrams(docs, known, size, n_shards, block_bytes)
    shuffled = shuffled_once(packed.repartitionById(n_shards, F.col("shard").cast("int")))
    counted = shuffled.mapInArrow(tidy(lambda batches: _counted(batches, size)), "w long, c long")
    got = counted.groupBy("w").agg(F.sum("c").alias("c")).toArrow()
    w, c = got["w"].to_numpy(), got["c"].to_numpy()
    counts = np.zeros(size, np.int64)
    counts[w[w >= 0]] = c[w >= 0]
    times = dict(zip(w[w < 0].tolist(), c[w < 0].tolist()))
    d3, d2 = (np.array([0.0, *_cut([times.get(-(10 * k + i), 0) for i in range(1, 5)])]) for k in (3, 2))
    d1 = np.array([0.0, *_cut([(counts == i).sum() for i in range(1, 5)])])
    off, every = d1[np.minimum(counts, 3)], max(counts.sum(), 1)
    left = off.sum() / every if counts.sum() else 1.0
    one = spark.sparkContext.broadcast((counts - off) / every + left / (size - 1) * (np.arange(size) != BOS))
    sums = shuffled.mapInArrow(tidy(lambda batches: _shard_sums(batches, size, one.value, d2, d3)), "block long, kind int, payload binary")
    by_key = sums.groupBy("block").applyInArrow(_block_sums, "key long, s double").groupBy("key").agg(F.avg("s").alias("s"))
    out = stage(by_key, "word-scores")
    one.destroy()
    return out


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Work that runs inside gets its Arrow batches of ``BATCH_BYTES`` at most; the setting is put back."""
    return common.small_batches(spark, BATCH_BYTES)


_SCORE = struct_of(n_bytes=T.LongType(), log_c=T.DoubleType(), local=T.DoubleType())
_SCORES = ("log_p", "log_c")


def _training_share(docs: DataFrame, good: DataFrame, labels: DataFrame, doc_id: str, text: str, max_labels: int | None,
                    max_bytes: int | None) -> float:
    """The share of labels whose documents the n-grams are counted over: all, unless the caller sets a limit."""
    share = 1.0 if max_labels is None else min(1.0, max_labels / max(labels.count(), 1))
    if max_bytes is None:
        return share
    of = docs.select(F.col(f"`{doc_id}`").cast("long").alias("trusted_id"), F.octet_length(F.col(f"`{text}`")).alias("n"))
    size = of.join(good, "trusted_id", "left_semi").agg(F.sum("n")).first()[0] or 0
    return min(share, max_bytes / max(size, 1))


def judge(docs: DataFrame, labels: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", keep: list[str] | None = None, max_labels: int | None = None, max_bytes: int | None = None,
          shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``name``: n_bytes, log_p, perplexity, limit (by words), char_perplexity, char_limit, kept."""
    spark, keep = docs.sparkSession, docs.columns if keep is None else keep
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    share = _training_share(docs, good, labels, doc_id, text, max_labels, max_bytes)
    part = lambda c, seed, n: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(n))
    learnt = (part("trusted_id", "trust", 1 << 20) < int(share * (1 << 20))) & (part("trusted_id", "fold", 4) != 0)
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"),
                      F.xxhash64(F.col(f"`{text}`")).alias("key"))
    own = own.join(F.broadcast(good.where(learnt)), F.col("id") == F.col("trusted_id"), "left").select(
        "t", "key", F.col("trusted_id").isNotNull().alias("learn"))
    col, key = fresh(docs, "score_"), fresh(docs, "key_")
    with small_batches(spark), common.released_shuffles(spark):
        texts = own.where("learn").select("t")
        rows = kneser_ney(gram_counts(texts, "t")).toPandas()
        words, ids, n_words = vocabulary(texts, "t")
        n_bytes = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        n_shards = max(1, -(-n_words // shard_words), -(-n_bytes // SHARD_TEXT))
        known = spark.sparkContext.broadcast((words, ids))
        sums = word_scores(own, known, n_shards, block_bytes).toDF(key, f"{key}s")
        least = {"k": np.int8, "g": np.int32, "p": np.float32, "gamma": np.float32}  # as precise as the table made of them
        chars = spark.sparkContext.broadcast(tuple(rows[c].to_numpy().astype(t) for c, t in least.items()))
        held = list(dict.fromkeys([*keep, doc_id, lang]))
        local = annotate(docs.withColumn(key, F.xxhash64(F.col(f"`{text}`"))), text, _SCORE, f"{col}l",
                         lambda: local_scorer(chars.value, *known.value), keep=[*held, key], limit=TEXT_BYTES)
        found = F.struct(F.col(f"{col}l.n_bytes").alias("n_bytes"),
                         (F.col(f"{col}l.local") + F.coalesce(F.col(f"{key}s"), F.lit(0.0))).alias("log_p"),
                         F.col(f"{col}l.log_c").alias("log_c"))
        out = stage(local.join(sums, key, "left").select(*[F.col(f"`{c}`") for c in held], found.alias(col)), "scores")
    for held in (known, chars):  # the scores are written: executors need not keep the model
        held.destroy()
    scored = out.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{lang}`").alias("l"), f"{col}.*")
    scored = stage(scored.join(good.where(~learnt), F.col("id") == F.col("trusted_id"), "left_semi"), "trusted-scores")
    mean = [(F.sum(c) / F.sum("n_bytes")).alias(f"mean_{c}") for c in _SCORES]
    every = scored.agg(*mean).first()
    means = scored.groupBy("l").agg(*mean).withColumnRenamed("l", "l2")
    shrunk = lambda c, m: -(F.col(c) + SHRINK * m) / (F.col("n_bytes") + SHRINK)
    mids = scored.join(means, F.col("l").eqNullSafe(F.col("l2"))).withColumns(
        {f"x_{c}": shrunk(c, F.col(f"mean_{c}")) for c in _SCORES})
    count = F.count(F.lit(1)).alias("n")
    limits = [F.percentile_approx(f"x_{c}", QUANTILE, 10_000).alias(f"limit_{c}") for c in _SCORES]
    firsts = [F.first(f"mean_{c}").alias(f"mean_{c}") for c in _SCORES]
    by_lang = mids.groupBy("l").agg(*limits, *firsts, count).where(f"n >= {MIN_TRUSTED}")
    by_lang = stage(by_lang.select(*[F.col(c).alias(f"{col}{c}") for c in by_lang.columns]), "limits")
    overall = mids.agg(*limits, count).first()
    out = out.join(by_lang, F.col(f"`{lang}`").eqNullSafe(F.col(f"{col}l")), "left")
    number = lambda x: F.lit(x).cast("double")
    n = F.col(f"{col}.n_bytes")
    margin = F.lit(SLACK) + 1 / F.sqrt(F.coalesce(F.col(f"{col}n"), F.lit(overall["n"])))
    score = {c: -(F.col(f"{col}.{c}") + SHRINK * F.coalesce(F.col(f"{col}mean_{c}"), number(every[f"mean_{c}"]))) / (n + SHRINK)
             for c in _SCORES}
    bound = {c: F.coalesce(F.col(f"{col}limit_{c}"), number(overall[f"limit_{c}"])) + F.log10(margin) for c in _SCORES}
    kept = [F.coalesce(score[c] <= bound[c], F.lit(True)) for c in _SCORES]
    power = lambda x: F.pow(F.lit(10.0), x)
    found = F.struct(n.alias("n_bytes"), F.col(f"{col}.log_p").alias("log_p"), power(score["log_p"]).alias("perplexity"),
                     power(bound["log_p"]).alias("limit"), power(score["log_c"]).alias("char_perplexity"),
                     power(bound["log_c"]).alias("char_limit"), (kept[0] & kept[1]).alias("kept"))
    return out.select(*[F.col(f"`{c}`") for c in keep], found.alias(name))


def accept(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the classifier keeps, with their own columns. Texts are not written: a verdict hangs on text and language."""
    name, key = fresh(docs, "verdict_"), fresh(docs, "key_")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    judged = judge(keyed, labels, name, doc_id, text, lang, keep=[key, lang]).where(f"not `{name}`.kept")
    gone = judged.select(F.col(key).alias(f"{key}gone"), F.col(f"`{lang}`").alias(f"{key}lang")).distinct()
    return keyed.join(gone, (F.col(key) == F.col(f"{key}gone")) & F.col(f"`{lang}`").eqNullSafe(F.col(f"{key}lang")), "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return judge(docs, labels, "v", keep=["doc_id", "lang"]).select("doc_id", "lang", "v.*")
