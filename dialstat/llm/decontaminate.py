"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of ten consecutive words of a benchmark item (a shorter item is one window) is a
pattern. Patterns of one length share a scanner: a table of blocks (two words) tells how far the
search may move on; only where the shift is zero are the patterns with that last block and the same
first block looked up and compared word by word, so a hit is never a hash collision.

The words of the benchmark are numbered; shifts, patterns and their items are arrays of numbers. Equal windows
are one pattern with several items. The shift table is addressed by a hash of the block: blocks that share
an entry have the least of their shifts, which never skips an occurrence.

Benchmark windows go to the executors in blocks of ``block_bytes`` of item text, one scan of the
documents a block, written before the next block is read: what is broadcast has a fixed bound, and no
item is left out. Items repeated with their text are read once.

Defined cases: a null or empty text has no words and no hit; an item without words has no window; items
without an id hit and count as one item, which the digest of the items does not name;
equal items each count; rows repeated in ``docs`` each get their result; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import annotate, fresh, read_table, stage, struct_of
from dialstat.llm.textsets import mix

WINDOW = 10
#: Benchmark text held by one broadcast, in the driver and in each Python worker; its tables take 5 to 15 times that
#: in memory (measured).
BLOCK_BYTES = 8 << 20
#: Patterns compared with a text at a time.
COMPARED = 1 << 20
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_TABLE).split() if text else []


def _hash(numbers: np.ndarray, at: np.ndarray, places: Iterable[int]) -> np.ndarray:
    """64-bit hashes of the word numbers at the given places after each of ``at``."""
    h = np.zeros(len(at), np.uint64)
    for j in places:
        h = mix(h * np.uint64(31) + numbers[at + j].astype(np.uint64))
    return h


def _spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... lo + n - 1 of every range, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


class Scanner:
    """Shift table, suffix buckets and comparison for patterns of one length.

    ``numbers`` are the word numbers (from 1) of all items, a pattern begins at each of ``starts`` and belongs to the
    item of the same place in ``items``.
    """

    def __init__(self, length: int, numbers: np.ndarray, starts: np.ndarray, items: np.ndarray):
        self.length, self.block, self.numbers = length, min(2, length), numbers
        far = length - self.block + 1
        whole = _hash(numbers, starts, range(length))
        order = np.lexsort((items, whole))
        starts, items, whole = starts[order], items[order], whole[order]
        same = whole[1:] == whole[:-1]
        for j in range(length):
            same &= numbers[starts[1:] + j] == numbers[starts[:-1] + j]
        new = np.append(True, ~same)
        owned = new.copy()
        owned[1:] |= items[1:] != items[:-1]
        first = np.flatnonzero(new)
        of = (np.cumsum(owned) - 1)[first]
        self.items = items[owned]
        self.owned = np.append(of, len(self.items)).astype(np.int32)  # a pattern's items: from its entry to the next
        at = starts[first]
        key = _hash(numbers, at, self._ends())
        order = np.argsort(key)
        self.key, self.at, self.pattern = key[order], at[order].astype(np.int32), order.astype(np.int32)
        self.down = np.uint64(64 - max(8, int(4 * len(at)).bit_length()))
        self.shift = np.full(1 << (64 - int(self.down)), far, np.min_scalar_type(far))
        for end in range(self.block, length + 1):  # later ends have lesser shifts
            self.shift[self._blocks(numbers, at + end - self.block)] = length - end

    def _ends(self) -> list[int]:
        """Places of a pattern's last and first block."""
        return [*range(self.length - self.block, self.length), *range(self.block)]

    def _blocks(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (_hash(numbers, at, range(self.block)) >> self.down).astype(np.int64)

    def find(self, w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts, in ascending order, and patterns of all occurrences in word numbers (0: a word of no item)."""
        i, n, block = self.length, len(w), self.block
        if n < i:
            return
        move = self.shift[self._blocks(w, np.arange(n - block + 1))].tolist()
        zero = []
        while i <= n:
            step = move[i - block]
            if step:
                i += step
            else:
                zero.append(i - self.length)
                i += 1
        at = np.array(zero, np.int64)
        key = _hash(w, at, self._ends())
        lo = np.searchsorted(self.key, key, "left")
        many = np.searchsorted(self.key, key, "right") - lo
        at, lo, many = at[many > 0], lo[many > 0], many[many > 0]
        parts = np.flatnonzero(np.diff(np.cumsum(many) // COMPARED, prepend=0)) + 1
        for at, lo, many in zip(*(np.split(x, parts) for x in (at, lo, many))):
            place, p = np.repeat(at, many), _spread(lo, many)
            for j in range(self.length):
                same = self.numbers[self.at[p] + j] == w[place + j]
                place, p = place[same], p[same]
            yield place, self.pattern[p]

    def items_of(self, patterns: np.ndarray) -> np.ndarray:
        lo = self.owned[patterns]
        return np.unique(self.items[_spread(lo, self.owned[patterns + 1] - lo)])


class Block:
    """What one scan knows of the benchmark: word numbers, item ids and a scanner for each length of pattern."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], window: int):
        self.known: dict[bytes, int] = {}
        ids: dict[str | None, int] = {}
        numbers, starts, owners = array("i"), {}, {}
        for item, text in items:
            w = words(text)
            size = min(window, len(w))
            if size:
                own = ids.setdefault(item, len(ids))
                for k in range(len(w) - size + 1):
                    starts.setdefault(size, array("i")).append(len(numbers) + k)
                    owners.setdefault(size, array("i")).append(own)
                numbers.extend(self.known.setdefault(x, len(self.known) + 1) for x in w)
        self.ids = list(ids)
        flat = np.array(numbers, np.int32)
        self.scanners = [Scanner(size, flat, np.array(starts[size], np.int32), np.array(owners[size], np.int32))
                         for size in sorted(starts)]

    def hits(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set]]:
        """Of each text: number of words, the stretches of words that are hit, the ids of the items that hit."""
        split = [words(t) for t in texts]
        lengths = np.array([len(w) for w in split], np.int64)
        ends = np.cumsum(lengths + 1)  # a word of no item stands behind each text, so no occurrence crosses it
        flat = chain.from_iterable(chain(w, (b"",)) for w in split)
        numbers = np.fromiter(map(self.known.get, flat, repeat(0)), np.int32, int(lengths.sum()) + len(split))
        spans, items = [[] for _ in split], [set() for _ in split]
        for s in self.scanners if numbers.any() else ():
            for place, patterns in s.find(numbers):
                text = np.searchsorted(ends, place, "right")  # places ascend
                parts = np.flatnonzero(np.diff(text)) + 1
                for at, own, found in zip(*(np.split(x, parts) for x in (place, text, patterns))) if len(place) else ():
                    k = int(own[0])
                    first = np.unique(at - (ends[k] - lengths[k] - 1)).tolist()
                    spans[k] += [(x, x + s.length) for x in first]
                    items[k].update(s.items_of(np.unique(found)).tolist())
        return [(len(w), _merge(x), {self.ids[i] for i in y}) for w, x, y in zip(split, spans, items)]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _digest(n_words: int, spans: list[tuple[int, int]], items: set) -> tuple:
    named = ",".join(sorted(i for i in items if i is not None))
    n_hit = sum(b - a for a, b in _merge(spans))
    return n_words, n_hit, len(items), hashlib.sha256(named.encode()).hexdigest(), n_hit > 0


DIGEST = struct_of(n_words=T.LongType(), n_hit=T.LongType(), n_items=T.LongType(),
                   items_sha256=T.StringType(), contaminated=T.BooleanType())
_HITS = struct_of(n_words=T.LongType(), lo=T.ArrayType(T.LongType()), hi=T.ArrayType(T.LongType()),
                  items=T.ArrayType(T.StringType()), key=T.StringType())


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark cut by a hash of item and text into parts of about ``block_bytes``."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    items = items.where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    if n > 1:
        items = stage(items, "benchmark")
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def scan(docs: DataFrame, benchmark: DataFrame, name: str, window: int = WINDOW, text: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
         keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    parts = _blocks(benchmark, item_id, item_text, block_bytes)

    def known_of(part):
        return spark.sparkContext.broadcast(Block(((r.item, r.text.encode()) for r in part.toLocalIterator()), window))

    if len(parts) == 1:
        known = known_of(parts[0])
        return annotate(docs, text, DIGEST, name, lambda: lambda ts: [_digest(*x) for x in known.value.hits(ts)], keep)

    def hits(known):
        def rows(ts):
            out = []
            for t, (n, spans, items) in zip(ts, known.value.hits(ts)):
                out.append((n, [a for a, _ in spans], [b for _, b in spans], sorted(items, key=lambda i: (i is not None, i)),
                            hashlib.sha256(t or b"").hexdigest()))
            return out
        return lambda: rows

    col = fresh(docs, "hits_")
    table = None
    for p in parts:
        known = known_of(p)
        rows = annotate(docs, text, _HITS, col, hits(known), keep=[]).select(f"{col}.*").where("size(items) > 0")
        rows = stage(rows, "decontaminate")
        table = rows if table is None else table.unionByName(rows)
        known.destroy()
    table = table.distinct()
    merged = table.groupBy("key").agg(
        F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"),
        F.flatten(F.collect_list("items")).alias("items"), F.max("n_words").alias("n"))

    def close(batches):
        import pyarrow as pa
        for b in batches:
            rows = [(r["key"], *_digest(r["n"], list(zip(r["lo"], r["hi"])), set(r["items"]))) for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(["key", *DIGEST.names], r)) for r in rows],
                                             schema=pa.schema([("key", pa.string()), ("n_words", pa.int64()),
                                                               ("n_hit", pa.int64()), ("n_items", pa.int64()),
                                                               ("items_sha256", pa.string()),
                                                               ("contaminated", pa.bool_())]))

    digests = merged.mapInArrow(close, T.StructType([T.StructField("key", T.StringType()), *DIGEST.fields]))
    digests = digests.select("key", F.struct(*DIGEST.names).alias("found"))
    none = annotate(docs, text, struct_of(n_words=T.LongType(), key=T.StringType()), col,
                    lambda: lambda ts: [(len(words(t)), hashlib.sha256(t or b"").hexdigest()) for t in ts], keep)
    joined = none.join(digests, none[f"{col}.key"] == digests["key"], "left")
    empty = F.struct(F.col(f"{col}.n_words").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                     F.lit(0).cast("long").alias("n_items"),
                     F.lit(hashlib.sha256(b"").hexdigest()).alias("items_sha256"), F.lit(False).alias("contaminated"))
    return joined.select(*[none[f"`{c}`"] for c in none.columns if c != col],
                         F.coalesce(digests["found"], empty).alias(name))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents without a benchmark window, with their own columns."""
    name = fresh(docs, "scan_")
    return scan(docs, benchmark, name, window, text).where(~F.col(f"{name}.contaminated")).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs, bench = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return scan(docs, bench, "scan_", keep=["doc_id"]).select("doc_id", "scan_.*")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(ws)) k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') g
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM win),
dg AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) i FROM w, lens WHERE len(ws) >= k)),
hit AS (SELECT dg.doc_id, dg.i, dg.k, win.item FROM dg JOIN win ON dg.g = win.g AND dg.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) named
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) n_items, sha256(coalesce(named, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
