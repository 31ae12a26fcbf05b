"""How five document filters act together, in every order in which they can be applied.

Filters: A few words, B few different words, C many capitals, D any of the marks ``#$%&*|``, E a text that
a smaller id has too. A to D hang on the text alone; E is found by radix tries:

1. Each task drops the texts that it has seen before, keeping their least id (a text with a third of
   all rows leaves a row a task), and deals the rest by ranges of adaptive text prefixes: the range
   bounds are drawn from the texts' first ``PREFIX`` bytes where texts are dense, and where more of
   them than a range holds begin alike, a hash of the whole text divides them further. Equal texts share a range.
2. A range's texts are put into a compressed trie, whose terminals hold the least id and the number of
   rows seen; traversal gives the texts that occur twice or more, by a 128-bit hash.
3. Documents meet those by that hash; the few texts with more than ``1 / HOT`` of all rows (so at most
   ``HOT``) are broadcast, the others joined.

A document's failures are a mask of five bits. Masks are counted per part (language), and the 120
orders need only those counts, at most 32 a part: what fails an earlier filter is gone before a later one.

Defined cases: null and empty texts are the empty text (equal to each other); a null id is larger than all others; null
languages are the part ""; a document labelled several times is good (toxic) if one label says so; rows
repeated each count; an empty table has no parts and gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import ROWS_AT_ONCE, annotate, read_table, small_batches, stage, struct_of

LETTERS = "ABCDE"
MIN_WORDS = 200
PREFIX, RANGE_BYTES, HELD_BYTES, HOT = 64, 16 << 20, 32 << 20, 1000
#: Bytes of rows that Spark hands to Python at a time (a longer row is handed over alone).
BATCH_BYTES = 4 << 20
_CAPITALS, _INNER, _MARKS = bytes(range(65, 91)), bytes(range(0x80, 0xC0)), b"#$%&*|"


def text_mask(text: bytes | None) -> int:
    """The failures of A to D, one bit each."""
    t = text or b""
    words = t.split()  # at exactly the six white-space characters
    n = len(words)
    capitals, chars = len(t) - len(t.translate(None, _CAPITALS)), len(t.translate(None, _INNER))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < 50 * n) << 1 | (100 * capitals > 3 * chars) << 2
            | (len(t.translate(None, _MARKS)) < len(t)) << 3)


class Trie:
    """Compressed trie of byte strings. A node is [label, children by first byte, terminal]; a terminal
    is [key, least id or None, rows]."""

    def __init__(self):
        self.root = [b"", {}, None]

    @staticmethod
    def _common(a: bytes, b: bytes) -> int:
        """Length of the common beginning of two strings."""
        lo, hi = 0, min(len(a), len(b))
        if a[:hi] == b[:hi]:
            return hi
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
        return lo

    def add(self, text: bytes, key: bytes, least: int | None, rows: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = child = [text[at:], {}, None]
                node, at = child, len(text)
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            n = self._common(label, text[at:at + len(label)])
            upper = [label[:n], {label[n]: child}, None]
            child[0] = label[n:]
            node[1][text[at]] = upper
            node, at = upper, at + n
        end = node[2]
        if end is None:
            node[2] = [key, least, rows]
        else:
            end[1] = least if end[1] is None else end[1] if least is None else min(end[1], least)
            end[2] += rows

    def terminals(self):
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2]:
                yield node[2]
            stack.extend(node[1].values())


_TEXT = "text binary, key binary, least long, n long"


def _distinct(texts: DataFrame) -> DataFrame:
    """(text, key, least, n) of (text, key, doc id): equal texts of a task once, with their least id."""
    def rows(seen):
        items = list(seen.items())
        for lo in range(0, len(items), 256):
            part = items[lo:lo + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[1][0] for x in part], pa.binary()), pa.array([x[0] for x in part], pa.binary()),
                 pa.array([x[1][1] for x in part], pa.int64()), pa.array([x[1][2] for x in part], pa.int64())],
                names=["text", "key", "least", "n"])

    def run(batches):
        seen, held = {}, 0
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(first, ROWS_AT_ONCE)
                for text, key, doc in zip(*[b.column(i).to_pylist() for i in range(3)]):
                    old = seen.get(key)
                    if old is None:
                        seen[key] = [text, doc, 1]
                        held += len(text) + 200
                    else:
                        old[1] = doc if old[1] is None else old[1] if doc is None else min(old[1], doc)
                        old[2] += 1
                    if held > HELD_BYTES:
                        yield from rows(seen)
                        seen, held = {}, 0
        yield from rows(seen)

    return texts.mapInArrow(run, _TEXT)


def _repeated(texts: DataFrame) -> DataFrame:
    """(key, least, n) of the texts that occur twice or more, from the tries of one range each."""
    def run(batches):
        trie = Trie()
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(first, ROWS_AT_ONCE)
                for row in zip(*[b.column(i).to_pylist() for i in range(4)]):
                    trie.add(*row)
        held = []
        for end in trie.terminals():
            if end[2] > 1:
                held.append(end)
            if len(held) == 10_000:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.binary()), pa.array([h[1] for h in held], pa.int64()),
                                           pa.array([h[2] for h in held], pa.int64())], names=["key", "least", "n"])

    return texts.mapInArrow(run, "key binary, least long, n long")


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc, part, mask) of every row: bit i is the failure of filter LETTERS[i]."""
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    key = F.unhex(F.md5(body))
    doc = F.col(f"`{doc_id}`").cast("long")
    given = docs.select(doc.alias("doc"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("part"),
                        key.alias("key"), body.alias("text"))
    found = annotate(given, "text", struct_of(m=T.IntegerType(), size=T.LongType()), "found",
                     lambda: lambda ts: [(text_mask(t), len(t)) for t in ts], keep=["doc", "part", "key"])
    with small_batches(docs.sparkSession, BATCH_BYTES):
        rows = stage(found.select("doc", "part", "key", "found.m", "found.size"), "audit-masks")
    of = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(of["size"] or 0) // RANGE_BYTES))
    dealt = _distinct(given.select("text", "key", "doc")).repartitionByRange(ranges, F.substring("text", 1, PREFIX), "key")
    with small_batches(docs.sparkSession, BATCH_BYTES):
        twice = stage(_repeated(dealt), "audit-repeated")
    hot = F.col("n") > of["n"] / HOT  # so at most HOT texts
    late = (F.col("n") > 1) & F.coalesce(F.col("doc") > F.col("least"), F.col("doc").isNull() & F.col("least").isNotNull())
    mask = (F.col("m") + F.when(F.coalesce(late, F.lit(False)), 1 << LETTERS.index("E")).otherwise(0)).alias("mask")
    often = F.broadcast(twice.where(hot))
    return rows.join(often, "key").select("doc", "part", mask).unionAll(
        rows.join(often, "key", "left_anti").join(twice.where(~hot), "key", "left").select("doc", "part", mask))


def counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic)."""
    yes = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(yes("quality"), yes("toxic"))
    rows = masked.where("doc is not null").join(known, F.col("doc") == F.col("of"), "left").select("part", "mask", "quality", "toxic")
    rows = rows.unionAll(masked.where("doc is null").select("part", "mask", F.lit(0), F.lit(0)))  # never meet in one task
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


def report(counted: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts per part and mask."""
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))  # at most 32
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    bit = lambda letter: F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(LETTERS) for x in (c, 1 << i)]), letter)
    rows = parts.select("part", "m", F.explode(orders).alias("filter_order"))
    rows = rows.select("part", "m", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(len(LETTERS))), F.lit(0), lambda a, i: a + F.when(
        i < F.col("step"), bit(F.substring(F.col("filter_order"), i, F.lit(1)))).otherwise(0))
    rows = rows.withColumns({"bit": bit(letter), "done": done})
    fails = lambda x, bits: x["mask"].bitwiseAND(bits) != 0
    add = lambda test, value: F.aggregate(F.filter("m", test), F.lit(0).cast("long"), lambda a, x: a + value(x))
    here = lambda x: fails(x, F.col("bit")) & ~fails(x, F.col("done"))
    shares = F.create_map(*[F.lit(x) for n in range(1, len(LETTERS) + 1) for x in (n, factorial(len(LETTERS)) // n)])
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), letter.alias("letter"),
        add(lambda x: ~fails(x, F.col("done") + F.col("bit")), lambda x: x["n"]).alias("kept"),
        add(here, lambda x: x["n"]).alias("removed"),
        add(lambda x: fails(x, F.col("bit")) & fails(x, F.col("done")), lambda x: x["n"]).alias("redundant"),
        add(lambda x: x["mask"] == F.col("bit"), lambda x: x["n"]).alias("unique_fails"),
        add(here, lambda x: x["good"]).alias("good_lost"), add(here, lambda x: x["toxic"]).alias("toxic_lost"),
        # a filter removes a document in the orders that have it first among those that the document fails
        add(lambda x: fails(x, F.col("bit")), lambda x: x["n"] * F.element_at(shares, F.bit_count(x["mask"]))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    return report(stage(counts(masks(docs, doc_id, text, lang), labels), "audit-counts"))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') part, coalesce(text, '') t,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) least FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws FROM d),
f AS (
  SELECT doc_id, part, len(ws) < 200 a, 100 * len(list_distinct(ws)) < 50 * len(ws) b,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) c, regexp_matches(t, '[#$%&*|]') d,
    coalesce(doc_id > least, least IS NOT NULL) e FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) good, bool_or(coalesce(toxic, 0) = 1) toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, [a, b, c, d, e] fails, a, b, c, d, e, count(*) n, count(*) FILTER (good) good, count(*) FILTER (toxic) toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) i),
o AS (
  SELECT [p.i, q.i, r.i, s.i, t.i] o FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
g AS (
  SELECT part, o, i step, n, good, toxic, fails[o[i]] hit, list_bool_or([fails[o[k]] FOR k IN range(1, i)]) earlier,
    (a::INT + b::INT + c::INT + d::INT + e::INT) failed
  FROM m, o, x),
s AS (
  SELECT part, array_to_string([chr(64 + k) FOR k IN o], '') filter_order, step, chr(64 + o[step]) letter,
    sum(CASE WHEN NOT hit AND NOT coalesce(earlier, false) THEN n ELSE 0 END) kept,
    sum(CASE WHEN hit AND NOT coalesce(earlier, false) THEN n ELSE 0 END) removed,
    sum(CASE WHEN hit AND coalesce(earlier, false) THEN n ELSE 0 END) redundant,
    sum(CASE WHEN hit AND failed = 1 THEN n ELSE 0 END) unique_fails,
    sum(CASE WHEN hit AND NOT coalesce(earlier, false) THEN good ELSE 0 END) good_lost,
    sum(CASE WHEN hit AND NOT coalesce(earlier, false) THEN toxic ELSE 0 END) toxic_lost
  FROM g GROUP BY part, o, step)
SELECT part, filter_order, step::INT step, letter, kept::BIGINT kept, removed::BIGINT removed, redundant::BIGINT redundant,
  unique_fails::BIGINT unique_fails, good_lost::BIGINT good_lost, toxic_lost::BIGINT toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT shapley
FROM s
"""
