"""Near-duplicate groups by SetSketch registers, banding, likelihood and exact confirmation.

1. One pass over the texts gives each document its shingle set's size, a 128-bit fingerprint of the
   set and a SetSketch: for each of its registers the least of exponentially distributed
   numbers, truncated to a power of ``BASE`` and kept in a byte. Registers of a union are the
   maxima of the parts' registers, and equal registers are as likely as the sets are similar.
   Points beyond the largest minimum that can matter are never made, so a set costs about
   n + m ln m steps instead of n * m.
2. Documents with the same fingerprint are one node (exact copies never meet each other again).
3. Bands of ``ROWS`` registers are hashed, as many as the threshold needs; nodes that share a band are candidates. Within a
   band's group the joint likelihood of (higher, lower, equal) registers estimates the similarity;
   pairs clearly below the threshold are no candidates. Each group gives stars that span its components,
   never all pairs.
4. Candidates' components are formed, and inside each the full shingle sets are compared; links with
   similarity of at least the threshold again give such stars, and their components are the
   result. So every link between documents that share a component of candidates is confirmed or
   refuted on whole sets.

Groups are cut by hash into tiles of ``TILE`` members; a task holds two tiles at most. Tile 0 meets
every tile and each tile itself; members that are still apart then meet in the remaining pairs of
tiles, so groups of any size are exact with bounded memory.

Missed links: a pair at exactly the threshold shares no band with a probability below ``MISSED`` (``bands_for``:
28 bands of 6 for 0.85, 43 for 0.8), and is put aside by the estimate (five standard deviations) with 3e-7.

Defined cases: null, empty and blank texts have the empty set and are linked with nothing; a text
with fewer words than a shingle has its whole sequence as its one shingle; rows under one id are one
document, linked if any of its texts is; rows without an id are linked with nothing (component null,
kept); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import annotate, fresh, read_table, stage, struct_of, tidy
from dialstat.llm.components import components
from dialstat.llm.textsets import mix, shingle_sets

ROWS, BASE, MISSED = 6, 1.1, 1e-6
TILE = 2000
#: Set members in a tile of full sets.
TILE_SHINGLES = 2_000_000
_TOP = 255


# ---- sketches -------------------------------------------------------------------------------

def bands_for(threshold: float) -> int:
    """Bands of ``ROWS`` registers that a pair at the threshold shares one of, but for ``MISSED``.

    Registers agree least often when one set holds the other.
    """
    equal = 1 + np.log1p(-(1 - threshold) * (BASE - 1) / BASE) / np.log(BASE)
    return max(1, int(np.ceil(np.log(MISSED) / np.log1p(-min(equal ** ROWS, 1 - MISSED)))))


def sketches(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """One row of ``registers`` bytes per non-empty set."""
    n = np.array([len(s) for s in sets])
    low = np.full((len(sets), registers), np.inf)
    left, slack = np.flatnonzero(n > 0), 3.0
    while len(left):
        limit = (np.log(registers) + slack) / n[left]
        of = np.repeat(left, n[left])
        bound = np.repeat(limit, n[left])
        h = np.concatenate([sets[i] for i in left])
        x, step = np.zeros(len(h)), 0
        while len(h):
            step += 1
            r = mix(h + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
            x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / registers
            stay = x <= bound
            x, h, of, bound, r = x[stay], h[stay], of[stay], bound[stay], r[stay]
            place = (mix(r) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
            np.minimum.at(low.reshape(-1), of * registers + place.astype(np.int64), x)
        left = left[np.isinf(low[left]).any(axis=1)]
        slack *= 2
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0) + 60, 0, _TOP).astype(np.uint8)


def estimate(one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray) -> np.ndarray:
    """Similarity of a set to others with the greatest joint likelihood of their register relations."""
    above = (one > many).sum(axis=1)
    below = (one < many).sum(axis=1)
    equal = len(one) - above - below
    u = (n_one / (n_one + n_many))[:, None]
    v = 1 - u
    j = _GRID[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    higher, lower = p(u - v * j), p(v - u * j)
    fit = above[:, None] * np.log(higher) + below[:, None] * np.log(lower) + (
        equal[:, None] * np.log(np.maximum(1 - higher - lower, 1e-12)))
    return j[np.arange(len(many)), fit.argmax(axis=1)]


_GRID = np.linspace(0, 1, 101)


def _likely(threshold: float, registers: int):
    margin = 5 * np.sqrt(threshold * (1 - threshold) / registers) + 0.01

    def linked(center, others):
        n = np.array([o[0] for o in others])
        fits = np.minimum(n, center[0]) >= threshold * np.maximum(n, center[0])
        out = np.zeros(len(others), bool)
        if fits.any():
            at = np.flatnonzero(fits)
            out[at] = estimate(center[1], center[0], np.stack([others[i][1] for i in at]), n[at]) >= threshold - margin
        return out

    return linked


def _exact(percent: int):
    def linked(center, others):
        n = np.array([len(o) for o in others])
        flat = np.concatenate(others)
        spot = np.searchsorted(center, flat)
        spot[spot == len(center)] = 0
        ends = np.cumsum(n)
        hits = np.concatenate([[0], np.cumsum(center[spot] == flat)])
        both = hits[ends] - hits[ends - n]
        return 100 * both >= percent * (n + len(center) - both)

    return linked


# ---- links inside groups ---------------------------------------------------------------------

def _stars(ids: list[int], items: list, linked, tiles: list[int]):
    """Edges (least node, node) of the components of ``linked`` pairs; across tiles if there are two.

    A component grows from its least node; only members not yet reached are compared. Stars from
    the least node make different groups of one family give mostly the same edges.
    """
    waiting = sorted(range(len(ids)), key=ids.__getitem__)
    cross = len(set(tiles)) > 1
    while waiting:
        root = waiting.pop(0)
        queue = [root]
        while queue and waiting:
            c = queue.pop()
            look = [i for i in waiting if not cross or tiles[i] != tiles[c] or ids[i] == ids[c]]
            if not look:
                continue
            near = linked(items[c], [items[i] for i in look])
            found = {i for i, hit in zip(look, near) if hit or ids[i] == ids[c]}
            for i in found:
                if ids[i] != ids[root]:
                    yield ids[root], ids[i]
            queue.extend(found)
            waiting = [i for i in waiting if i not in found]


def _paired(members: DataFrame, hub_only: bool) -> DataFrame:
    """Members (g, node, tiles, ...) with the tile pairs (ta, tb) in which they take part."""
    rows = members.withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    every = F.sequence(F.lit(0), F.col("tiles").cast("int") - 1)
    if hub_only:
        other = F.when(F.col("t") == 0, every).otherwise(F.array(F.lit(0), F.col("t")))
    else:
        other = F.filter(every, lambda s: (s > 0) & (s != F.col("t")) & (F.col("t") > 0))
    rows = rows.withColumn("s", F.explode(other))
    return rows.withColumn("ta", F.least("t", "s")).withColumn("tb", F.greatest("t", "s"))


def _edges(rows: DataFrame, payload: list[str], read, linked) -> DataFrame:
    """Edges (a, b) that span the links of each group (g, ta, tb) of ``rows``; ``read`` turns payload into an item."""
    cols = ["g", "ta", "tb", "t", "node", *payload]
    dealt = rows.select(*cols).repartition(F.col("g"), F.col("ta"), F.col("tb")).sortWithinPartitions("g", "ta", "tb")

    def run(batches):
        held, key = [], None

        def close():
            if len(held) < 2:
                return []
            return list(_stars([h[0] for h in held], read([h[2:] for h in held]), linked, [h[1] for h in held]))

        for batch in batches:
            data, edges = batch.to_pydict(), []
            for g, ta, tb, *rest in zip(*(data[c] for c in cols)):
                if (g, ta, tb) != key:
                    edges += close()
                    held, key = [], (g, ta, tb)
                held.append((rest[1], rest[0], *rest[2:]))
            if edges:
                yield _batch(edges)
        if edges := close():
            yield _batch(edges)

    return dealt.mapInArrow(tidy(run), "a long, b long")


def _batch(edges) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                       pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])


def _connect(members: DataFrame, payload: list[str], read, linked, name: str) -> DataFrame:
    """Edges that span the links over all pairs inside groups of ``members`` (g, tiles, node, payload columns).

    Groups of one or two tiles are done in the first round. In larger ones the first round links
    every tile with tile 0 and in itself; nodes that then are in different components meet again.
    """
    first = stage(_edges(_paired(members, True), payload, read, linked).distinct(), name)
    large = members.where("tiles > 2")
    if not large.take(1):
        return first
    found = components(first)
    apart = large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = apart.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    again = _paired(apart.join(mixed.select("g"), "g", "left_semi").drop("component"), False)
    return first.unionAll(stage(_edges(again, payload, read, linked).distinct(), name))


# ---- operator --------------------------------------------------------------------------------

_SKETCH = struct_of(n=T.LongType(), f1=T.LongType(), f2=T.LongType(), sketch=T.BinaryType())


def _sketch_rows(size: int, registers: int):
    def rows(texts):
        sets = shingle_sets(texts, size)
        regs = sketches(sets, registers)
        signed = lambda x: int(np.uint64(x).astype(np.int64))
        out = []
        for s, r in zip(sets, regs):
            f1 = mix(s).sum(dtype=np.uint64) if len(s) else 0
            f2 = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) if len(s) else 0
            out.append((len(s), signed(f1), signed(f2), r.tobytes()))
        return out
    return lambda: rows


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
           tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; similarity of ``percent`` / 100 or more links."""
    threshold = percent / 100
    n_bands = bands_for(threshold)
    registers = n_bands * ROWS
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = annotate(given, "text", _SKETCH, "s", _sketch_rows(shingle, registers), keep=["doc_id"])
    rows = stage(rows.select("doc_id", "s.*"), "sketches")
    sets = rows.where("n > 0 and doc_id is not null")
    classes = stage(sets.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node")), "classes")
    nodes = sets.join(classes.withColumnRenamed("node", "doc_id"), ["n", "f1", "f2", "doc_id"], "left_semi")
    nodes = stage(nodes.dropDuplicates(["doc_id", "n", "f1", "f2"]).withColumnRenamed("doc_id", "node"), "nodes")

    band = F.explode(F.array(*[F.xxhash64(F.lit(k), F.substring("sketch", k * ROWS + 1, ROWS)) for k in range(n_bands)]))
    bands = nodes.select("node", band.alias("g"))
    shared = bands.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    members = bands.join(shared, "g").withColumn("tiles", F.ceil(F.col("k") / tile)).distinct()
    members = stage(members.join(nodes.select("node", "n", "sketch"), "node"), "bands")

    def read_sketch(items):
        return [(n, np.frombuffer(s, np.uint8)) for n, s in items]

    likely = components(_connect(members, ["n", "sketch"], read_sketch, _likely(threshold, registers), "likely"))
    size = F.coalesce(F.sum("n"), F.lit(0))
    likely = likely.withColumnRenamed("component", "g")
    of_group = likely.join(nodes.groupBy("node").agg(F.sum("n").alias("n")), "node").groupBy("g").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(size / TILE_SHINGLES)).alias("tiles"))
    asked = likely.join(of_group, "g")
    # each node's texts: one per class that it stands for
    texts = given.join(asked.withColumnRenamed("node", "doc_id"), "doc_id")
    texts = texts.withColumnRenamed("doc_id", "node")

    def read_text(items):
        return shingle_sets([t.encode() if t else t for (t,) in items], shingle)

    exact = components(_connect(stage(texts, "candidates"), ["text"], read_text, _nonempty(_exact(percent)), "links"))
    exact = exact.withColumnRenamed("component", "to")
    joined = rows.join(classes, ["n", "f1", "f2"], "left").join(exact, "node", "left")
    # rows under one id are one document: its least label counts
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("to", "node", "doc_id"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), part.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _nonempty(linked):
    def safe(center, others):
        return linked(center, others) if len(center) else np.zeros(len(others), bool)
    return safe


def dedup(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of ``docs`` that stand for their group (the least id), with their own columns."""
    own = fresh(docs, "kept_id")
    kept = groups(docs, shingle, percent, doc_id, text).where("kept and doc_id is not null").select(
        F.col("doc_id").alias(own)).distinct()
    key = F.col(f"`{doc_id}`")
    marked = docs.join(kept, key.cast("long") == F.col(own), "left_semi")
    return marked.unionByName(docs.where(key.isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    return groups(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN ws ELSE ws[i:i + 2] END g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
walk(s, d) AS (SELECT doc_id, doc_id FROM documents UNION SELECT walk.s, link.b FROM walk JOIN link ON walk.d = link.a),
c AS (SELECT s doc_id, min(d) component_id FROM walk GROUP BY s)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, c.component_id, w.doc_id = c.component_id kept
FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
