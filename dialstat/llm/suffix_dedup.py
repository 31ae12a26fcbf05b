"""Repeated passages of ``WINDOW`` bytes, found by a radix sort of the suffixes no deeper than that.

A byte goes if it lies in a string of ``WINDOW`` bytes that also starts earlier. Suffixes are ordered by
most-significant-digit passes; a group of one is done, a group still together after ``WINDOW`` bytes is a
repeated window, and all its members but the first are removed. No suffix is moved that a digit can spare:

1. Leading digit. Not the first bytes of a window but its anchor: of the window's ``ANCHOR``-byte strings
   the one with the least hash (the leftmost of equals), which equal windows share at the same place.
   Neighbouring windows share it, so they travel as one run, about one row for 34 bytes of text.
2. Runs of equal bytes in one task, then all runs of one anchor, are brought together: of runs of equal
   bytes all but the first are removed whole, without looking at single windows. An anchor with one
   sort of run only is done.
3. What is left, the edges of repeated passages, fetches its bytes. Groups of at most ``GROUP`` runs are sorted in
   one task by digits of 8 bytes. Larger groups are spread by a longer digit first: each run is cut
   into parts, whose common bytes are the next digit, and step 2 is done again.

Anchors and runs are compared by 64-bit hashes each (runs only within their anchor's group), windows in
step 3 byte by byte. Texts travel compressed; a text's removed stretches are joined with it at the end.

Order of texts: by id (null last), rows with one id by a hash of their text. Defined cases: null and empty texts
have no bytes; texts under ``WINDOW`` bytes lose nothing; a row repeated with its id and text is one
document, each row gets its result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import ROWS_AT_ONCE, fresh, read_table, slices, stage
from dialstat.llm.textsets import mix

WINDOW, ANCHOR = 100, 32
GROUP = 20_000
#: Runs that a task holds before it drops equal ones, and windows that it sorts at a time.
HELD, SORTED = 1_000_000, 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_LAST = (1 << 63) - 1  # stands for a null id
#: A run's place in one number: 24 bits of the text's hash, 32 of its start, 7 of its windows less one.
_T, _S, _N = 39, 7, 127


class Rolling:
    """Hashes of any stretch of a buffer, from sums over its bytes."""

    def __init__(self, buf: np.ndarray):
        up, self.down = (np.full(len(buf) + 1, b, np.uint64) for b in (_BASE, _INVERSE))
        up[0] = self.down[0] = 1
        up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(self.down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * up[:-1], dtype=np.uint64)])

    def of(self, lo, hi) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """text number, start, windows less one, anchor's hash, hash of the run's bytes: of every run."""
    ends = np.cumsum([len(t) for t in texts])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buf) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    rolling = Rolling(buf)
    at = np.arange(len(buf) - ANCHOR + 1)
    hashes = rolling.of(at, at + ANCHOR)
    best = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    size, reach = 1, WINDOW - ANCHOR + 1
    while size < reach:  # least of the next ``reach`` places
        step = min(size, reach - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(n)
    doc = np.searchsorted(ends, start, "right")
    inside = start + WINDOW <= ends[doc]
    start, anchor, doc = start[inside], anchor[inside], doc[inside]
    if not len(start):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    lo, hi = start[first], start[last]
    whole = rolling.of(lo, hi + WINDOW) ^ mix((anchor[first] - lo).astype(np.uint64) * np.uint64(131) + (hi - lo).astype(np.uint64))
    return doc[first], lo - (ends - [len(t) for t in texts])[doc[first]], hi - lo, hashes[anchor[first]], whole


_RUN = "key long, whole long, d long, place long, bytes binary"
_OUT = "kind int, key long, d long, place long, bytes binary"


def _run_batches(key, whole, d, place, data=None):
    for i in range(0, len(key), 50_000):
        part = slice(i, i + 50_000)
        n = len(key[part])
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(x[part].view(np.int64)) for x in (key, whole, d, place)],
             pa.nulls(n, pa.binary()) if data is None else pa.array(data[part], pa.binary())],
            names=["key", "whole", "d", "place", "bytes"])


def _first_only(held: list, data=None):
    """Runs without those that a task has seen before, and the others' places (a null key marks them removed)."""
    key, whole, d, place = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((place, d, whole, key))
    key, whole, d, place = key[order], whole[order], d[order], place[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
    of = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = (d != d[of]) | (place != place[of])
    keep = order[new]
    yield from _run_batches(key[new], whole[new], d[new], place[new], None if data is None else [data[i] for i in keep])
    if gone.any():
        d, place = _joined(d[gone], place[gone])
        for i in range(0, len(d), 50_000):
            n = len(d[i:i + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(d[i:i + 50_000]), pa.array(place[i:i + 50_000]),
                 pa.nulls(n, pa.binary())], names=["key", "whole", "d", "place", "bytes"])


def _joined(d: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Removed runs by text and place; equal ones once."""
    order = np.lexsort((place, d))
    d, place = d[order], place[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (place[1:] != place[:-1])
    return d[new], place[new]


def _anchored(texts: DataFrame) -> DataFrame:
    """The runs of all texts (d, t, text), equal ones of a task once; removed ones have a null key."""
    def run(batches):
        held, size = [], 0
        for whole_batch in batches:
            for first in range(0, whole_batch.num_rows, ROWS_AT_ONCE):
                b = whole_batch.slice(first, ROWS_AT_ONCE)
                d, t = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
                docs = [x or b"" for x in b.column(2).cast(pa.binary()).to_pylist()]
                for lo, hi in slices(docs):
                    doc, start, more, key, whole = runs_of(docs[lo:hi])
                    if len(doc):
                        held.append((key.view(np.int64), whole.view(np.int64), d[lo:hi][doc],
                                     t[lo:hi][doc] << _T | start << _S | more))
                        size += len(doc)
                    if size > HELD:
                        yield from _first_only(held)
                        held, size = [], 0
        if held:
            yield from _first_only(held)

    return texts.mapInArrow(run, _RUN)


def _sorted_out(runs: DataFrame) -> DataFrame:
    """Brings the runs of a key together. kind 0: a removed run; 1: the first of its sort, of a key with several sorts."""
    def run(batches):
        before = None  # key, sort and first place of the last row seen
        pending = None  # the first run of the last key, while it has one sort only
        for b in batches:
            if not b.num_rows:
                continue
            key, whole, d, place = (b.column(i).to_numpy() for i in range(4))
            data = b.column(4)
            new_key, new = np.ones(len(key), bool), np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            if before is not None:
                new_key[0] = key[0] != before[0]
                new[0] = new_key[0] or whole[0] != before[1]
            new[1:] = new_key[1:] | (whole[1:] != whole[:-1])
            at = np.flatnonzero(new)
            of = np.cumsum(new) - 1  # -1: still the sort of the batch before
            fd = np.append(d[at], before[2] if before else 0)[of]
            fp = np.append(place[at], before[3] if before else 0)[of]
            gone = ~new & ((d != fd) | (place != fp))
            second = new & ~new_key
            group = np.cumsum(new_key)
            mixed = np.bincount(group, second, minlength=int(group[-1]) + 1) > 0
            first = new & (second | mixed[group])
            rows = []
            if pending is not None:
                if mixed[0]:
                    rows.append(pending)
                if mixed[0] or new_key[0] or group[-1] > 0:
                    pending = None
            if not mixed[group[-1]] and (group[-1] > 0):
                i = int(np.flatnonzero(new_key)[-1])
                pending = (int(key[i]), int(d[i]), int(place[i]), data[i].as_py())
            before = (key[-1], whole[-1], fd[-1], fp[-1])
            kinds = [*[1] * len(rows), *np.where(gone[gone | first], 0, 1).tolist()]
            hit = np.flatnonzero(gone | first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()),
                 pa.array([r[0] for r in rows] + key[hit].tolist(), pa.int64()),
                 pa.array([r[1] for r in rows] + d[hit].tolist(), pa.int64()),
                 pa.array([r[2] for r in rows] + place[hit].tolist(), pa.int64()),
                 pa.array([r[3] for r in rows] + [None if gone[i] else data[i].as_py() for i in hit.tolist()], pa.binary())],
                names=["kind", "key", "d", "place", "bytes"])

    dealt = runs.where("key is not null").repartition("key").sortWithinPartitions("key", "whole", "d", "place")
    return dealt.mapInArrow(run, _OUT)


def _radix(key: np.ndarray, d: np.ndarray, place: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Sorts the windows of runs by digits of 8 bytes, groups of one left out; (run, offset) of all but first members."""
    sizes = np.array([len(x) for x in data])
    starts = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(data) + b"\0" * 8, np.uint8)
    digit = np.zeros(len(buf) - 7, np.uint64)
    for i in range(8):
        digit = digit << np.uint64(8) | buf[i:len(digit) + i].astype(np.uint64)
    windows = sizes - WINDOW + 1
    run = np.repeat(np.arange(len(data)), windows)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    group = np.unique(key, return_inverse=True)[1][run]
    depths = [*range(0, WINDOW - 7, 8)]
    if depths[-1] + 8 < WINDOW:
        depths.append(WINDOW - 8)  # the last digit overlaps the one before
    for depth in depths:
        if not len(run):
            break
        x = digit[starts[run] + offset + depth]
        order = np.lexsort((x, group))
        run, offset, group, x = run[order], offset[order], group[order], x[order]
        new = np.ones(len(run), bool)
        new[1:] = (group[1:] != group[:-1]) | (x[1:] != x[:-1])
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        run, offset, group = run[many], offset[many], group[many]
    where = place[run] + (offset << _S)
    order = np.lexsort((where, d[run], group))
    run, offset, group = run[order], offset[order], group[order]
    later = np.zeros(len(run), bool)
    later[1:] = group[1:] == group[:-1]
    return np.stack([run[later], offset[later]])


def _resolved(mixed: DataFrame) -> DataFrame:
    """Removed windows (d, place) of runs whose key's group is small, sorted in one task each bunch."""
    def removed(held):
        key, d, place, data = (list(c) for c in zip(*held))
        key, d, place = (np.array(c, np.int64) for c in (key, d, place))
        run, offset = _radix(key, d, place, data)
        at_d, at = _joined(d[run], (place[run] & ~_N) + (offset << _S))
        for i in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at_d[i:i + 50_000]), pa.array(at[i:i + 50_000])], names=["d", "place"])

    def run(batches):
        held, size, cut = [], 0, 0
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if held and row[0] != held[-1][0]:
                    cut = len(held)
                    if size > SORTED:
                        yield from removed(held)
                        held, size, cut = [], 0, 0
                held.append(row)
                size += len(row[3]) - WINDOW + 1
        if held:
            yield from removed(held)

    return mixed.select("key", "d", "place", "bytes").repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "d long, place long")


def _cut(mixed: DataFrame, size: int) -> DataFrame:
    """The runs cut where the place of the anchor in the window passes a multiple of ``size``; the key is the hash of
    the bytes that all windows of such a part share, wherever their run begins: a longer digit than before."""
    def run(batches):
        for b in batches:
            held, data = [], []
            for key, d, place, text in zip(*[b.column(i).to_pylist() for i in range(4)]):
                rolling, at = Rolling(np.frombuffer(text, np.uint8)), np.arange(WINDOW - ANCHOR + 1)
                anchor = int(np.argmin(rolling.of(at, at + ANCHOR) >> np.uint64(32)))  # in the first window
                lo, more = 0, len(text) - WINDOW
                while lo <= more:
                    low = (anchor - lo) // size * size  # the windows' anchors lie at low .. low + size - 1
                    hi = min(more, anchor - low)
                    shared = (max(anchor - low, 0), anchor - low - size + 1 + WINDOW)
                    share, whole = rolling.of(np.array([shared[0], lo]), np.array([shared[1], hi + WINDOW])).tolist()
                    held.append(((key * 31 + share + low) % 2**64, (whole + (hi - lo)) % 2**64, d,
                                 (place & ~_N) + (lo << _S) + (hi - lo)))
                    data.append(text[lo:hi + WINDOW])
                    lo = hi + 1
            if held:
                cols = [np.array([h[i] for h in held], np.uint64 if i < 2 else np.int64).view(np.int64) for i in range(4)]
                yield from _first_only([cols], data)

    return mixed.select("key", "d", "place", "bytes").mapInArrow(run, _RUN)


def _packed(docs: DataFrame, doc_id: str, text: str, names: list[str]) -> DataFrame:
    """d, t, the id and the compressed text of every row, with the columns ``names``."""
    given = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("d_"),
                        F.shiftrightunsigned(F.xxhash64(F.col(f"`{text}`")), 40).alias("t_"),
                        F.col(f"`{text}`").cast("binary").alias("z_"), *[F.col(f"`{c}`") for c in names])

    def run(batches):
        tool = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(first, ROWS_AT_ONCE)
                z = [None if x is None else tool.compress(x) for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(z, pa.binary()), *b.columns[3:]], names=b.schema.names)

    return given.mapInArrow(run, given.schema)


def _fetched(mixed: DataFrame, packed: DataFrame) -> DataFrame:
    """The runs (key, d, place) with their bytes."""
    of = mixed.select("d", F.shiftrightunsigned("place", _T).alias("t"), F.struct("key", "place").alias("r"))
    wanted = of.groupBy("d", "t").agg(F.collect_list("r").alias("r"))  # of one text
    rows = packed.select("d_", "t_", "z_").join(wanted, (F.col("d") == F.col("d_")) & (F.col("t") == F.col("t_"))).select("d", "z_", "r")

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                b = whole.slice(first, 256)
                out = []
                for d, z, wanted in zip(*[b.column(i).to_pylist() for i in range(3)]):
                    text = tool.decompress(z)
                    for r in wanted:
                        lo = r["place"] >> _S & 0xFFFFFFFF
                        out.append((r["key"], d, r["place"], text[lo:lo + (r["place"] & _N) + WINDOW]))
                for i in range(0, len(out), 20_000):
                    part = out[i:i + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[j] for r in part], k) for j, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["key", "d", "place", "bytes"])

    # a row repeated with its id and text is one document
    return rows.mapInArrow(run, "key long, d long, place long, bytes binary")


def removed(docs: DataFrame, packed: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """(d, place) of all removed runs and windows."""
    texts = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("d"),
                        F.shiftrightunsigned(F.xxhash64(F.col(f"`{text}`")), 40).alias("t"), F.col(f"`{text}`").alias("text"))
    runs = stage(_anchored(texts.where(F.octet_length("text") >= WINDOW)), "suffix-runs")
    gone = runs.where("key is null").select("d", "place")
    found = stage(_sorted_out(runs), "suffix-groups")
    gone = gone.unionAll(found.where("kind = 0").select("d", "place"))
    mixed = stage(_fetched(found.where("kind = 1"), packed).dropDuplicates(["key", "d", "place"]), "suffix-mixed")
    for size in (32, 16, 8, 4, 2, 1):
        bound = max(group, mixed.count() // 1000)  # so at most 1,000 keys are large
        large = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).select("key").collect()
        if not large:
            break
        keys = docs.sparkSession.createDataFrame(large, "key long")
        gone = gone.unionAll(_resolved(mixed.join(F.broadcast(keys), "key", "left_anti")))
        parts = stage(_cut(mixed.join(F.broadcast(keys), "key", "left_semi"), size), "suffix-parts")
        found = stage(_sorted_out(parts), "suffix-groups")
        gone = gone.unionAll(parts.where("key is null").select("d", "place")).unionAll(found.where("kind = 0").select("d", "place"))
        mixed = found.where("kind = 1").select("key", "d", "place", "bytes")  # none when the parts are single windows
    return gone.unionAll(_resolved(mixed))


def _stretches(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, name: str = "cut_",
        digest: bool = False, group: int = GROUP) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a struct ``name``: n_bytes, n_removed, n_spans, kept (the bytes left, or
    their lowercase hex sha256 with ``digest``)."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    packed = _packed(docs, doc_id, text, [])
    gone = removed(docs, packed, doc_id, text, group)
    of = gone.groupBy("d", F.shiftrightunsigned("place", _T).alias("t")).agg(
        F.collect_list(F.col("place").bitwiseAND((1 << _T) - 1)).alias("places"))  # of one text
    own = fresh(docs, "row_")
    rows = _packed(docs.withColumn(own, F.struct(*[F.col(f"`{c}`") for c in keep])), doc_id, text, [own])
    rows = rows.join(of, (F.col("d") == F.col("d_")) & (F.col("t") == F.col("t_")), "left").select(own, "z_", "places")

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                b = whole.slice(first, 256)
                out = []
                for z, places in zip(b.column(1).to_pylist(), b.column(2)):
                    t = b"" if z is None else tool.decompress(z)
                    p = np.asarray(places.values, np.int64) if places.is_valid else np.zeros(0, np.int64)
                    starts = p >> _S
                    spans = _stretches(starts.tolist(), (starts + (p & _N) + WINDOW).tolist())
                    parts, at = [], 0
                    for lo, hi in spans:
                        parts.append(t[at:lo])
                        at = hi
                    left = b"".join(parts) + t[at:]
                    out.append((len(t), sum(hi - lo for lo, hi in spans), len(spans),
                                hashlib.sha256(left).hexdigest() if digest else left))
                made = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
                made.append(pa.array([r[3] for r in out], pa.string() if digest else pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.StructArray.from_arrays(made, names=["n_bytes", "n_removed", "n_spans", "kept"])], names=[own, name])

    kind = "string" if digest else "binary"
    schema = rows.select(own).schema.add(name, T.StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, kept {kind}"))
    return rows.mapInArrow(run, schema).select(f"{own}.*", name)


def query(spark, sf_dir: str) -> DataFrame:
    out = cut(read_table(spark, sf_dir, "documents"), keep=["doc_id"], digest=True)
    return out.select("doc_id", "cut_.n_bytes", "cut_.n_removed", "cut_.n_spans", F.col("cut_.kept").alias("kept_sha256"))
