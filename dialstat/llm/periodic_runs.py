"""Periodic runs of words by seeds and diagonals, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are equal) and length of at least
``max(MIN_LENGTH, 2 q)`` that no neighbouring word extends. The words q apart overlap in at least
``max(q, MIN_LENGTH - q)`` places, so a seed of that many words lies on the diagonal of lag q:

* lags 1 to 2 * SEED - 1 are sought with seeds of SEED = 6 words (the least overlap), lags in
  [k, 2k) with seeds of k words, k = 12, 24, 48, ...; only places whose shorter seed repeats in the
  same document go on to the longer one, so plain text ends after the first level;
* two places of one document with the same seed and a lag of the level are a pair. A seed without a
  period of at most k / 2 has at most three partners in that reach. A seed with one lies inside a run
  found at a level before; of these seeds only those of the run's last period are paired, and only
  with places outside the run: a longer period across two runs must show there. So pairs grow with
  the words times the levels, never with the square of a word's count;
* a pair is extended both ways to its whole diagonal; a table holds, per lag, how far the diagonals
  are covered, so later seeds on a covered stretch are skipped.

Words are compared by 64-bit fingerprints, seeds are only proposals: each run is verified word by word.
A document is worked on inside one task, a few MB of text at a time (a longer text alone).

Defined cases: null and empty texts have no words; a null id plants no repetition; rows repeated each
get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import annotate, fresh, read_table, struct_of
from dialstat.llm.textsets import mix, word_hashes

MIN_LENGTH = 12
SEED = MIN_LENGTH // 2


def _agreeing(w: np.ndarray, at: int, lag: int, limit: int, forward: bool) -> int:
    """How many words from ``at`` on (or before it) equal the word ``lag`` later, at most up to ``limit``."""
    n, step = 0, 64
    while True:
        if forward:
            lo, hi = at + n, min(at + n + step, limit)
            same = w[lo:hi] == w[lo + lag:hi + lag]
        else:
            lo, hi = max(at - n - step, limit), at - n
            same = (w[lo:hi] == w[lo + lag:hi + lag])[::-1]
        if not same.all():
            return n + int(np.argmin(same))
        n += hi - lo
        if not len(same) or len(same) < step:
            return n
        step = min(step * 4, 1 << 16)


def _divisors(q: int) -> list[int]:
    """q divided by each of its prime factors."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1 and q > 1:
        out.append(q // rest)
    return out


class _Diagonals:
    """Runs of one document found by extending seeds; per lag the end of the covered stretch."""

    def __init__(self, w: np.ndarray):
        self.w, self.covered, self.runs = w, {}, {}

    def extend(self, at: int, lag: int) -> None:
        if at < self.covered.get(lag, 0):
            return
        w, end = self.w, len(self.w) - lag
        hi = at + _agreeing(w, at, lag, end, True)
        lo = at - _agreeing(w, at, lag, self.covered.get(lag, 0), False)
        self.covered[lag] = max(hi, at + 1)
        same, length = hi - lo, hi - lo + lag
        if same < lag or length < MIN_LENGTH:
            return
        if any(np.array_equal(w[lo:hi + lag - d], w[lo + d:hi + lag]) for d in _divisors(lag)):
            return  # the smallest period is a divisor
        self.runs[(lo, length, lag)] = None


def _pairs(ids: np.ndarray, at: np.ndarray, k: int, deep: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places with equal seeds and a lag in [k, 2k), of seeds without a period of at most k / 2."""
    out = []
    for step in (1, 2, 3):
        same = (ids[step:] == ids[:-step]) & ~deep[:-step]
        lag = at[step:] - at[:-step]
        hit = np.flatnonzero(same & (lag >= k) & (lag < 2 * k))
        if len(hit):
            out.append((at[hit], lag[hit]))
    return out


def find_runs(w: np.ndarray, of: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document that has any.

    ``w`` are the words' fingerprints of several documents one after the other, ``of`` the document of
    each word (increasing numbers).
    """
    out: dict[int, list] = {}
    if len(w) < MIN_LENGTH:
        return out
    ends = np.flatnonzero(np.append(of[1:] != of[:-1], True)) + 1
    begins = np.append(0, ends[:-1])
    # seeds of SEED words; only places whose seed occurs again in the document go on
    n = len(w) - SEED + 1
    seed = np.zeros(n, np.uint64)
    for i in range(SEED):
        seed = mix(seed * np.uint64(31) + w[i:i + n])
    seed = seed ^ mix(of[:n].astype(np.uint64))
    at = np.flatnonzero(of[:n] == of[SEED - 1:])
    at, ids = _repeating(at, seed[at])
    if not len(at):
        return out
    by = np.argsort(of[at], kind="stable")  # each document's seeds stay by seed and place
    at, ids, doc = at[by], ids[by], of[at][by]
    cuts = np.flatnonzero(doc[1:] != doc[:-1]) + 1
    for d, here, key in zip(doc[np.append(0, cuts)], np.split(at, cuts), np.split(ids, cuts)):
        j = np.searchsorted(of[begins], d)
        runs = _document(w[begins[j]:ends[j]], here - begins[j], key)
        if runs:
            out[int(d)] = sorted(runs)
    return out


def _repeating(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, by key and place, with their keys' numbers."""
    order = np.lexsort((at, key))
    at, key = at[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    ids = np.cumsum(new)
    often = np.bincount(ids)[ids] > 1
    return at[often], ids[often]


def _document(w: np.ndarray, at: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of one document; ``at`` and ``ids`` are its repeating seeds of SEED words, by seed and place."""
    found, n, k = _Diagonals(w), len(w), SEED
    # short lags: equal seeds at each lag, by one comparison a lag
    table = np.zeros(n, np.int64)
    table[at] = ids
    for lag in range(1, 2 * SEED):
        hit = np.flatnonzero((table[lag:] == table[:-lag]) & (table[:-lag] > 0)) if lag < n else ()
        if len(hit):
            first = hit[np.append(True, np.diff(hit) != 1)]
            for i in first.tolist():
                found.extend(i, lag)
    while len(at) and 4 * k <= n:
        # a seed of 2k words is two of k words; both must repeat
        second = at + k
        ok = second + k <= n
        ok[ok] = table[second[ok]] > 0
        at = at[ok]
        key = table[at] * np.int64(n + 1) + table[at + k]
        at, ids = _repeating(at, key)
        k *= 2
        table = np.zeros(n, np.int64)
        table[at] = ids
        if not len(at):
            break
        # places inside a run with a period of at most k / 2
        inside = [r for r in found.runs if r[2] * 2 <= k and r[1] >= k]
        deep = np.zeros(n, bool)
        for start, length, _ in inside:
            deep[start:start + length - k + 1] = True
        pairs, key = _pairs(ids, at, k, deep[at]), ids * np.int64(n + 1) + at
        for start, length, period in inside:
            last = start + length - k
            for i in range(max(start, last - period + 1), last + 1):
                if table[i]:
                    lo, hi = np.searchsorted(key, table[i] * (n + 1) + np.array([i + k, min(i + 2 * k, n)]))
                    partner = at[lo:hi]
                    partner = partner[partner > last]
                    pairs.append((np.full(len(partner), i), partner - i))
        if pairs:
            place, lag = (np.concatenate(c) for c in zip(*pairs))
            order = np.lexsort((place, lag))
            for i, q in zip(place[order].tolist(), lag[order].tolist()):
                found.extend(i, q)
    return list(found.runs)


def planted(words: list, doc_id: int | None) -> list:
    """The words, for one id in ten with a repetition planted behind its place (fixed rule of the query)."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_RUNS = struct_of(n_runs=T.LongType(), start=T.LongType(), length=T.LongType(), period=T.LongType(),
                  exponent_milli=T.LongType(), runs_sha256=T.StringType(), collapsed=T.StringType())


def _digest(words: list[bytes], runs: list[tuple[int, int, int]], digest: bool) -> tuple:
    named = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = words
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            gone[s + q] += 1
            gone[s + n] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        kept = [w for w, k in zip(words, keep.tolist()) if k]
    text = b" ".join(kept)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(named.encode()).hexdigest(),
            hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))


def detect(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
           plant: bool = False, digest: bool = False) -> DataFrame:
    """``docs`` with a struct column ``name``: n_runs, the longest run, the digest of all runs, and the text
    without the repetitions (or its digest); ``plant`` puts the query's fixed repetitions in first."""
    # the id travels behind the text, so that one column holds what a row needs
    packed = fresh(docs, "packed_")
    given = docs
    if plant:
        head = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit("\n"))
        given = docs.withColumn(packed, F.concat(head, F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    keep = docs.columns if keep is None else keep

    def work(texts):
        rows = []
        for t in texts:
            doc, body = None, t or b""
            if plant:
                doc, body = body.split(b"\n", 1)
            words = body.split()  # bytes split at exactly the six white-space characters
            if plant and doc:
                new = planted(words, int(doc))
                body, words = (body, words) if new is words else (b" ".join(new), new)
            rows.append((body, words))
        hashes, counts = word_hashes([b for b, _ in rows])
        runs = find_runs(hashes, np.repeat(np.arange(len(rows)), counts))
        return [_digest(words, runs.get(i, []), digest) for i, (_, words) in enumerate(rows)]

    return annotate(given, packed if plant else text, _RUNS, name, lambda: work, keep)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every run cut to its first period (their words joined by one space)."""
    name = fresh(docs, "runs_")
    out = detect(docs, name, text=text)
    return out.select(*[F.when(F.col(f"{name}.n_runs") > 0, F.col(f"{name}.collapsed")).otherwise(F.col(f"`{c}`")).alias(c)
                        if c == text else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    out = detect(read_table(spark, sf_dir, "documents"), "runs_", keep=["doc_id"], plant=True, digest=True)
    return out.select("doc_id", "runs_.*").withColumnRenamed("collapsed", "collapsed_sha256")
