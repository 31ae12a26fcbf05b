"""Document scores of a hidden Markov language model.

Tokens are the words of a text (A-Z lower-cased) and one end. The model's symbols are the most
frequent words, the end, and classes of the other words by their last bytes; latent states emit
symbols, and a class emits its words by their corpus counts:

    P(text) = P(symbols) * product over class words of (c + 0.1) / (N_class + 0.1 (V_class + 1))

Training: word counts, start values (k-means of the documents) and every Baum-Welch round read all
training documents. Texts become symbols once, written as numbers that all passes read. Each task
adds up counts per symbol and state, Spark sums them over the tasks, and the driver gets
one row per symbol, a fixed number. Training sequences are pieces of ``PIECE`` tokens. Scores come
from the scaled forward recursion over the whole text: the exact likelihood.

Counts of the frequent words (``HEAD``, a fixed number) are broadcast; all other words of a document
are joined with the count table by word, so the vocabulary may grow without bound.

Defined cases: null and empty texts have one token, the end; a null id counts as the empty text for
the fold (held out); without any training document the model gives every symbol the same chance;
rows repeated each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.common import annotate, read_table, stage, struct_of

STATES = 8
#: Words with a symbol of their own, classes of the others, and words whose counts are broadcast.
FREQUENT, CLASSES, HEAD = 8192, 512, 1 << 16
PIECE = 512
#: Text whose words are counted, and are coded, at a time; steps of the forward recursion between two scalings.
COUNT_BYTES, CODE_BYTES, SCALED = 16 << 20, 8 << 20, 8
#: Rounds of k-means and of Baum-Welch, each over all training documents; most frequent symbols that k-means looks at.
GROUPINGS, ROUNDS, COMMON = 12, 8, 400
SUFFIX = 3
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def _lowered(column: pa.Array) -> pa.Array:
    """The column's bytes, A-Z lower-cased, as unchecked strings from offset 0 without nulls, as Arrow's ASCII functions need them."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = memoryview(data or b"")[at[0]:at[-1]].tobytes().lower()
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(at - at[0]), pa.py_buffer(data)])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and their number in each text: ``tokens`` without the ends."""
    lists = pc.ascii_split_whitespace(_lowered(texts))
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    if empty.any():  # beside white space at a text's ends
        n -= np.bincount(np.repeat(np.arange(len(n)), n)[empty], minlength=len(n))
        words = words.filter(pa.array(~empty))
    return words, n


def _parts(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes at most (a longer text stands alone)."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield lo, hi
        lo = hi


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def word_classes(words: pa.Array) -> np.ndarray:
    """The class of each word, from the CRC-32 of its last ``SUFFIX`` bytes, as ``_class_col`` gives it."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for back in range(SUFFIX, 0, -1):
        here = np.flatnonzero(np.diff(at) >= back)
        crc[here] = _CRC[(crc[here] ^ data[at[1:][here] - back]) & 0xFF] ^ (crc[here] >> 8)
    return (~crc % CLASSES).astype(np.int64)


def _class_col(token: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.substring(token, -SUFFIX, SUFFIX)), F.lit(CLASSES)).cast("int")


# ---- corpus counts ---------------------------------------------------------------------------

def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(token: binary, c) over all texts; tasks add up before the shuffle, ``COUNT_BYTES`` of text at a time."""
    def run(batches):
        for b in batches:
            column = b.column(0)
            for lo, hi in _parts(column, COUNT_BYTES):
                found = pc.value_counts(split_words(column.slice(lo, hi - lo))[0])
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([found.field(0).cast(pa.large_binary()), pa.array([END], pa.large_binary())]).cast(pa.binary()),
                    pa.concat_arrays([found.field(1), pa.array([hi - lo], pa.int64())])], names=["token", "n"])

    parts = texts.select(f"`{text}`").mapInArrow(run, "token binary, n long")
    return parts.groupBy("token").agg(F.sum("n").alias("c"))


# ---- the model -------------------------------------------------------------------------------

class Coder:
    """Numbers of tokens: the end is 0, frequent words and then the other broadcast words follow.

    ``symbol`` maps these numbers to the model's symbols: the end and each frequent word have their
    own, all other words one of the classes.
    """

    def __init__(self, head: list[bytes], frequent: int):
        self.head = pa.array(head, pa.large_binary())
        self.first_class = min(len(head), frequent) + 1
        self.size = self.first_class + CLASSES
        self.symbol = np.arange(len(head) + 1, dtype=np.int32)
        self.symbol[self.first_class:] = self.first_class + word_classes(self.head.slice(self.first_class - 1))

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The words' numbers, -1 for words that are not broadcast."""
        at = pc.index_in(words.cast(pa.large_binary()), value_set=self.head).fill_null(-2)
        return at.to_numpy(zero_copy_only=False) + 1

    def symbols(self, words: pa.Array, numbers: np.ndarray) -> np.ndarray:
        out = self.symbol[numbers]
        other = np.flatnonzero(numbers < 0)
        out[other] = self.first_class + word_classes(words.take(pa.array(other)))
        return out

    @property
    def kind(self) -> np.dtype:
        """The least type that holds all symbols."""
        return np.min_scalar_type(self.size)


def _by_step(ids: np.ndarray, lengths: np.ndarray):
    """The sequences' tokens step by step, longest sequence first: order, bounds of steps, tokens."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
    bounds = np.concatenate([[0], np.cumsum(active)])
    dealt = np.empty(len(ids), np.int32)
    for t, n in enumerate(active):
        dealt[bounds[t]:bounds[t + 1]] = ids[starts[:n] + t]
    return order, bounds, dealt


def forward_scores(ids: np.ndarray, lengths: np.ndarray, start, move, emit) -> np.ndarray:
    """log10 likelihood of each sequence by the scaled forward recursion; ``emit``: symbol x state."""
    order, bounds, dealt = _by_step(ids, lengths)
    score, a, ones = np.zeros(len(lengths)), None, np.ones((len(start), len(start)))
    for t in range(len(bounds) - 1):
        n = bounds[t + 1] - bounds[t]
        e = emit[dealt[bounds[t]:bounds[t + 1]]]
        if t == 0:
            a = start * e
        elif t % SCALED:
            if n < len(a):  # the others end here
                score[n:len(a)] += np.log10(a[n:].sum(axis=1))
            a = a[:n] @ move
            a *= e
        else:
            scale = a @ ones  # a row's sum, in each of its columns
            score[:len(a)] += np.log10(scale[:, 0])
            a = (a[:n] / scale[:n]) @ move
            a *= e
    if a is not None:
        score[:len(a)] += np.log10(a.sum(axis=1))
    out = np.zeros(len(lengths))
    out[order] = score
    return out


def expected_counts(ids: np.ndarray, lengths: np.ndarray, start, move, emit):
    """Baum-Welch counts of starts, moves and (symbol, state) over the sequences."""
    _, bounds, dealt = _by_step(ids, lengths)
    k, real = len(start), np.float32
    start, move, ones = start.astype(real), move.astype(real), np.ones((k, k), real)
    seen = emit.astype(real)[dealt]
    alpha = np.empty_like(seen)
    for t in range(len(bounds) - 1):
        lo, hi = bounds[t], bounds[t + 1]
        a = alpha[lo:hi]
        if t:
            np.matmul(alpha[bounds[t - 1]:bounds[t - 1] + hi - lo], move, out=a)
            a *= seen[lo:hi]
        else:
            np.multiply(start, seen[lo:hi], out=a)
        scale = a @ ones  # a row's sum, in each of its columns
        a /= scale
        seen[lo:hi] /= scale
    moves, beta, back = np.zeros((k, k)), np.ones((bounds[1] if len(ids) else 0, k), real), np.ascontiguousarray(move.T)
    for t in range(len(bounds) - 3, -1, -1):
        lo, hi, end = bounds[t:t + 3]
        n = end - hi
        onto = seen[hi:end]
        onto *= beta[:n]
        moves += alpha[lo:lo + n].T @ onto
        np.matmul(onto, back, out=beta[:n])
        alpha[lo:lo + n] *= beta[:n]
    symbols, dealt = np.zeros((k, len(emit))), dealt.astype(np.intp)
    for lo in range(0, len(dealt), 1 << 14):  # transposed in pieces that stay in the cache
        for i, a in enumerate(alpha[lo:lo + (1 << 14)].T.astype(float, order="C")):
            symbols[i] += np.bincount(dealt[lo:lo + (1 << 14)], a, len(emit))
    symbols = symbols.T
    return alpha[:bounds[1]].sum(axis=0, dtype=float) if len(ids) else np.zeros(k), moves * move, symbols


def _pieces(lengths: np.ndarray) -> np.ndarray:
    """Lengths of the pieces that sequences of these lengths are cut into."""
    lengths = lengths[lengths > 0]
    pieces = -(-lengths // PIECE)
    out = np.full(pieces.sum(), PIECE, np.int64)
    out[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * PIECE
    return out


def _maximise(starts, moves, symbols, unigram):
    """Probabilities from expected counts; emissions lean a little on the unigram of symbols."""
    start = (starts + 1) / (starts + 1).sum()
    move = (moves + 1) / (moves + 1).sum(axis=1, keepdims=True)
    emit = symbols + 20 * unigram[:, None]
    return start, move, emit / emit.sum(axis=0)


def _coded(batches, kind: np.dtype, limit: int = 300_000):
    """(symbols, lengths) of some documents at a time, about ``limit`` tokens (a longer document stands alone)."""
    for b in batches:
        col = b.column(0).cast(pa.large_binary())
        if not len(col):
            continue
        _, offsets, data = col.buffers()
        at = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
        ids = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind)
        at = (at - at[0]) // kind.itemsize
        lo = 0
        while lo < len(col):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            yield ids[at[lo]:at[hi]], np.diff(at[lo:hi + 1])
            lo = hi


def _added(coded: DataFrame, k: int, count) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all documents of what ``count`` finds in a task's batches, (keys, one row of k values each)."""
    def run(batches):
        keys, values = count(batches)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[pa.array(values[:, i], pa.float64()) for i in range(k)]],
                                         names=["symbol", *[f"s{i}" for i in range(k)]])

    schema = "symbol long, " + ", ".join(f"s{i} double" for i in range(k))
    sums = coded.select("symbols").mapInArrow(run, schema).groupBy("symbol").agg(
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]).toPandas().sort_values("symbol")
    return sums["symbol"].to_numpy(np.int64), sums.drop(columns="symbol").to_numpy(float)


def baum_welch_round(coded: DataFrame, size: int, kind: np.dtype, model):
    """One round over ``coded``: expected counts summed over tasks by symbol."""
    k = len(model[0])

    def count(batches):
        total = [np.zeros(k), np.zeros((k, k)), np.zeros((size, k))]
        for ids, lengths in _coded(batches, kind):
            for into, part in zip(total, expected_counts(ids, _pieces(lengths), *model)):
                into += part
        # symbol -1: starts, -2 - i: moves from state i
        seen = np.flatnonzero(total[2].any(axis=1))
        return np.concatenate([[-1], -2 - np.arange(k), seen]), np.vstack([total[0][None, :], total[1], total[2][seen]])

    keys, values = _added(coded, k, count)
    symbols = np.zeros((size, k))
    symbols[keys[keys >= 0]] = values[keys >= 0]
    return values[keys == -1][0], values[keys <= -2][::-1], symbols


def _bags(ids: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Of each document the roots of its shares of the ``width`` most frequent symbols."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    common = ids < width
    bags = np.bincount(doc[common] * width + ids[common], minlength=len(lengths) * width).reshape(len(lengths), width)
    return np.sqrt((bags / np.maximum(bags.sum(axis=1, keepdims=True), 1)).astype(np.float32))


def _first_model(coded: DataFrame, size: int, kind: np.dtype, width: int, states: int, unigram: np.ndarray):
    """Start values: all documents of ``coded`` in ``states`` groups by k-means over frequent words.

    The first centres are the documents of least hash, different ones as long as there are.
    """
    least = coded.orderBy("draw", "symbols").limit(8 * states).select("symbols").collect()
    drawn = list(dict.fromkeys(bytes(r.symbols) for r in least))
    first = [np.frombuffer(drawn[i % len(drawn)], kind) for i in range(states)]
    centres = np.vstack([_bags(ids, np.array([len(ids)]), width) for ids in first])

    def nearest(batches):
        for ids, lengths in _coded(batches, kind):
            bags = _bags(ids, lengths, width)
            yield ids, lengths, bags, (bags @ centres.T).argmax(axis=1)

    def grouped(batches):
        total = np.zeros((width, states))
        for _, _, bags, near in nearest(batches):
            total += bags.T @ (near[:, None] == np.arange(states)).astype(np.float32)
        return np.arange(width), total

    def by_symbol(batches):
        total = np.zeros(size * states, np.int64)
        for ids, lengths, _, near in nearest(batches):
            total += np.bincount(ids.astype(np.int64) * states + np.repeat(near, lengths), minlength=size * states)
        return np.arange(size), total.reshape(size, states)

    for _ in range(GROUPINGS - 1):
        sums = _added(coded, states, grouped)[1].T
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-9), centres).astype(np.float32)
    return _maximise(np.ones(states), np.eye(states) * 100 + 1, _added(coded, states, by_symbol)[1], unigram * 10)


def _head(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words and their counts, at most ``most``, by falling count, then by word.

    A histogram over logarithmic steps of the count gives the bound, so only those rows are sent.
    """
    words = counts.where(F.col("token") != F.lit(END))
    step = F.floor(F.log2("c") * 64)
    left, least = most, None
    for r in words.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect():
        left -= r["count"]
        if left < 0:
            break
        least = r.step
    if least is None:
        return []
    rows = words.where(step >= least).toPandas()
    return sorted(((bytes(w), int(c)) for w, c in zip(rows["token"], rows["c"])), key=lambda x: (-x[1], x[0]))


# ---- operator --------------------------------------------------------------------------------

_ROW = struct_of(n_tokens=T.LongType(), known=T.LongType(), base=T.DoubleType(), inside=T.DoubleType(),
                 symbols=T.BinaryType(), tail=T.ArrayType(T.BinaryType()), times=T.ArrayType(T.LongType()))


def _coded_texts(texts: pa.Array, coder: Coder, numbered: np.ndarray, base: np.ndarray, inside: np.ndarray) -> list[pa.Array]:
    """The columns ``_ROW`` of some texts: what the broadcast words give, the symbols, and the other words with their counts."""
    words, n = split_words(texts)
    doc = np.repeat(np.arange(len(n)), n)
    numbers = coder.numbers(words)
    symbols = np.zeros(len(words) + len(n), coder.kind)  # a text's end is symbol 0
    symbols[np.arange(len(words)) + doc] = coder.symbols(words, numbers)
    ends = np.concatenate([[0], np.cumsum((n + 1) * coder.kind.itemsize)]).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(symbols)])
    own = numbers >= 0
    add = lambda x: np.bincount(doc[own], x[numbers[own]], len(n)) + x[0]
    rest = words.filter(pa.array(~own)).dictionary_encode()
    size = max(len(rest.dictionary), 1)
    keys, times = np.unique(doc[~own] * size + rest.indices.to_numpy(zero_copy_only=False), return_counts=True)
    cuts = pa.array(np.searchsorted(keys // size, np.arange(len(n) + 1)), pa.int32())
    tail = rest.dictionary.take(pa.array(keys % size)).cast(pa.large_binary()).cast(pa.binary())
    return [pa.array(n + 1), pa.array(add((numbered > 0).astype(float)).astype(np.int64)), pa.array(add(base)), pa.array(add(inside)),
            coded, pa.ListArray.from_arrays(cuts, tail), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))]


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", states: int = STATES,
           head: int = HEAD, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), F.lit(10))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       (fold == 0).alias("held_out"), F.xxhash64(F.lit("start"), F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("draw"))
    train = rows.where("not held_out")
    counts = stage(word_counts(train), "markov-counts")
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = n or 0, v or 0
    top = _head(counts, head)
    end = counts.where(F.col("token") == F.lit(END)).first()
    coder = Coder([w for w, _ in top], frequent)
    kind = coder.kind
    numbered = np.array([end.c if end else 0, *(c for _, c in top)], np.int64)
    own = numbered[:coder.first_class]

    # totals of the classes: counts of all words without a symbol of their own
    classed = counts.where(F.col("token") != F.lit(END))
    if len(top) >= frequent:
        word, c = top[frequent - 1]
        classed = classed.where((F.col("c") < c) | ((F.col("c") == c) & (F.col("token") > F.lit(word))))
    elif top:
        word, c = top[-1]
        classed = classed.where((F.col("c") < c) | ((F.col("c") == c) & (F.col("token") > F.lit(word))))
    per_class = classed.groupBy(_class_col(F.col("token")).alias("k")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    bottom = np.full(CLASSES, 0.1)
    unigram = np.full(coder.size, 0.1)
    unigram[:coder.first_class] += own
    for r in per_class:
        bottom[r.k] = r.n + 0.1 * (r.v + 1)
        unigram[coder.first_class + r.k] += r.n
    unigram /= unigram.sum()

    known = spark.sparkContext.broadcast(coder)
    floor = n + 0.1 * (v + 1)
    base = np.log10((numbered + 0.1) / floor)
    inside = np.zeros(len(numbered))
    for i in range(coder.first_class, len(numbered)):
        inside[i] = np.log10((numbered[i] + 0.1) / bottom[coder.symbol[i] - coder.first_class])

    def code(batches):
        for b in batches:
            for lo, hi in _parts(b.column(0), CODE_BYTES):
                part = b.slice(lo, hi - lo)
                made = _coded_texts(part.column(0), known.value, numbered, base, inside)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], schema=pa.schema(
                    [*list(part.schema)[1:], *zip(_ROW.names, [x.type for x in made])]))

    kept = rows.select("doc_id", "held_out", "draw")
    made = rows.select("text", *kept.columns).mapInArrow(code, T.StructType([*kept.schema.fields, *_ROW.fields]))
    made = stage(made.select(F.monotonically_increasing_id().alias("row"), "*"), "markov-rows")
    if n:
        train = made.where("not held_out")
        model = _first_model(train, coder.size, kind, min(coder.first_class, COMMON), states, unigram)
        for _ in range(ROUNDS):
            model = _maximise(*baum_welch_round(train, coder.size, kind, model), unigram)
    else:
        model = _maximise(np.ones(states), np.ones((states, states)), np.ones((coder.size, states)), unigram)

    def score():
        def work(coded):
            ids = np.frombuffer(b"".join(coded), kind)
            lengths = np.array([len(c) // kind.itemsize for c in coded])
            return [(float(s),) for s in forward_scores(ids, lengths, *model)]

        return work

    tail = made.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select(
        "row", F.col("x.tail").alias("token"), F.col("x.times").alias("times"))
    totals = F.element_at(F.array(*[F.lit(float(x)) for x in bottom]), _class_col(F.col("token")) + 1)
    found = tail.join(counts, "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("t_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + 0.1) / F.lit(floor))).alias("t_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + 0.1) / totals)).alias("t_model"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    scored = annotate(made, "symbols", struct_of(model=T.DoubleType()), "m", score, limit=4 << 20, at_once=10_000,
                      keep=["row", "doc_id", "held_out", "n_tokens", "known", "base", "inside"])
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("t_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + zero("t_base")).alias("base_score"),
        (F.col("m.model") + F.col("inside") + zero("t_model")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return scores(read_table(spark, sf_dir, "documents"))
