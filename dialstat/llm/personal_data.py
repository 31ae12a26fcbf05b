"""Personal data: generators propose spans, boosted trees choose, redaction replaces them.

Kinds: email, ip, card, phone. The strict patterns (``base_spans``) always count. High-recall
generators then propose further, also overlapping spans: masked addresses ("name (at) host dot
com"), dotted numbers with brackets, digit groups with other separators or without a plus sign. Each
is described by its format and its surroundings; boosted trees, trained on the strict spans and
their masked variants against other candidates of a bounded sample of documents, score them. Per
kind the threshold is the least score at which the held-out half has ``PRECISION``; chosen spans that
touch no other span, best score first, are added.

The sample has about ``SAMPLE_DOCS`` documents by hash; every text is searched whole.

Defined cases: null and empty texts have no spans; without strict spans or without other candidates in
the sample there is no model and the strict spans stand alone; repeated rows each get their result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialstat.llm.boosting import Boosted
from dialstat.llm.common import annotate, fresh, read_table, struct_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, PRECISION = 20_000, 0.99

# fixed patterns of the strict spans
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

# generators of further candidates; every repetition is bounded
_AT = r"(?:\x20?[(\[{<]\x20?(?:at|AT|@)\x20?[)\]}>]\x20?|\x20(?:at|AT|@)\x20)"
_DOT = r"(?:\x20?[(\[{<]\x20?(?:dot|DOT|\.)\x20?[)\]}>]\x20?|\x20(?:dot|DOT)\x20|\.)"
_MASKED_EMAIL = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}")
_MASKED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\.)\x20?[0-9]{1,3}){3}(?![0-9.])")
_NUMBERS = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,6}(?:[\x20()./-]{1,3}[0-9]{1,6}){1,8}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{7,19}(?![0-9A-Za-z])")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    end, p = 0, text.find("@")
    while p >= 0:
        start = p
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, p + 1) if start < p else None
        if host:
            end = host.end()
            yield start, end
        p = text.find("@", max(p + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [x.lstrip("0") for x in m.group().split(".")]
            if all(len(x) < 4 and int(x or 0) <= 255 for x in parts):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all that may be personal data, strict spans included; spans overlap."""
    out = set(base_spans(text))
    if "at" in text or "AT" in text or "@" in text:
        if re.search(r"[(\[{<\x20](?:at|AT|@)[)\]}>\x20]", text) and re.search(r"dot|DOT|\.[A-Za-z]", text):
            out.update((0, m.start(), m.end()) for m in _MASKED_EMAIL.finditer(text))
    if _DIGIT.search(text):
        out.update((1, m.start(), m.end()) for m in _MASKED_IP.finditer(text))
        for m in _NUMBERS.finditer(text):
            n = len(_NOT_DIGIT.sub("", m.group()))
            if 7 <= n <= 15:
                out.add((3, m.start(), m.end()))
            if 13 <= n <= 19:
                out.add((2, m.start(), m.end()))
    return sorted(out)


#: Bins of the scores' histogram.
_BINS = 1000
_HINTS = tuple(re.compile(p, re.I) for p in (
    r"mail|contact|write|kontakt|correo|courriel", r"\bip\b|host|server|address|adresse", r"card|visa|master|amex|karte|tarjeta|carte",
    r"phone|tel|call|mobile|fax|anruf|llam|appel", r"version|order|isbn|id\b|page|date|nr\.|no\."))


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and surroundings of a candidate."""
    s = text[start:end]
    plain = re.sub(r"[\[\](){}<>]", "", s)
    if kind == 0:
        plain = re.sub(r"\x20?\b(?:at|AT)\b\x20?", "@", plain)
        plain = re.sub(r"\x20?\b(?:dot|DOT)\b\x20?", ".", plain)
    digits = _NOT_DIGIT.sub("", s)
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    before, after = text[max(0, start - 30):start], text[end:end + 12]
    last = re.split(r"[.@]", plain)[-1]
    numbers = [int(g) for g in re.findall(r"[0-9]{1,9}", plain)] if kind == 1 else []
    return [float(v) for v in (
        kind, len(s), len(digits), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0,
        groups[-1] if groups else 0, kind == 2 and _luhn(digits), kind == 1 and max(numbers, default=999) <= 255,
        s.startswith("+"), "(" in s, s.count(" "), s.count("-"), s.count("."), sum(c.isalpha() for c in s),
        plain.count("@"), len(last) if kind == 0 else 0, kind == 0 and last.isalpha(),
        digits[:1] in "3456" and kind == 2, before[-1:].isspace() or not before, after[:1].isspace() or not after,
        after[:1] in ".,;:)", *(bool(h.search(before)) for h in _HINTS), len(set(digits)) / max(len(digits), 1))]


def _variants(text: str, kind: int, start: int, end: int):
    """The span with its usual form masked, in its place: also personal data."""
    s = text[start:end]
    forms = {0: (s.replace("@", " at ").replace(".", " dot "), s.replace("@", " (at) "), s.replace("@", "[at]").replace(".", "[dot]")),
             1: (s.replace(".", "[.]"),), 3: (s.lstrip("+"), s.replace("+", "00", 1)),
             2: (" ".join(re.findall(".{1,4}", s)), "-".join(re.findall(".{1,4}", s)), ".".join(re.findall(".{1,4}", s)))}[kind]
    for f in forms:
        yield text[max(0, start - 40):start] + f + text[end:end + 20], min(start, 40), min(start, 40) + len(f)


_DATE = re.compile(r"(?:19|20)[0-9]{2}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2(?:19|20)[0-9]{2}|(?:19|20)[0-9]{6}")


def never(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a candidate cannot be personal data of its kind: a wrong check digit, octets over 255, dates, versions."""
    s = text[start:end]
    if kind == 2:
        return not _luhn(_NOT_DIGIT.sub("", s))
    if kind == 1:
        return any(int(g) > 255 for g in re.findall("[0-9]{1,9}", s))
    return kind == 3 and bool(_DATE.fullmatch(s.strip()) or _HINTS[-1].search(text[max(0, start - 30):start]))


def _wrong(text: str, kind: int, start: int, end: int):
    """The span and its masked forms turned into what cannot be personal data, so that every kind has wrong cases."""
    s = text[start:end]
    if kind == 2:
        s = s[:-1] + str((int(s[-1]) + 1) % 10) if s[-1:].isdigit() else ""
        forms = [s, *(x.join(re.findall(".{1,4}", _NOT_DIGIT.sub("", s))) for x in " -.")]
    elif kind == 1:
        s = re.sub("^[0-9]+", lambda m: str(256 + int(m.group()) % 700), s)
        forms = [s, s.replace(".", "[.]")]
    else:
        forms = ["2020-01-02", "02.01.2020", "order no. " + s.lstrip("+")] if kind == 3 else []
    for f in forms:
        t, at = text[max(0, start - 40):start] + f + text[end:end + 20], min(start, 40)
        skip = len("order no. ") if f.startswith("order") else 0
        if f and never(t, kind, at + skip, at + len(f)):
            yield t, at + skip, at + len(f)


def training_rows(text: str) -> list[tuple[list[float], int]]:
    """Strict spans and masked variants of them are right; candidates that cannot be, and strict spans turned into
    such, are wrong; others, perhaps masked personal data, are not learnt from."""
    strict = set(base_spans(text))
    rows = []
    for kind, a, b in candidates(text):
        if (kind, a, b) in strict:
            rows.append((features(text, kind, a, b), 1))
            rows += [(features(t, kind, x, y), 1) for t, x, y in _variants(text, kind, a, b)]
            rows += [(features(t, kind, x, y), 0) for t, x, y in _wrong(text, kind, a, b)]
        elif never(text, kind, a, b):
            rows.append((features(text, kind, a, b), 0))
    return rows


def train(docs: DataFrame, doc_id: str, text: str):
    """(trees, threshold per kind), or None: trees from half of the sample, thresholds from all other documents."""
    n = docs.count()
    share = int(min(1.0, SAMPLE_DOCS / max(n, 1)) * (1 << 20))
    part = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), F.lit(n))
    fit = (part("pii", 1 << 20) < share) & (part("pii-fold", 2) == 0)

    def run(batches):
        for b in batches:
            rows = [r for t in b.column(0).to_pylist() if t for r in training_rows(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.float64())),
                                                  pa.array([r[1] for r in rows], pa.int32())], names=["x", "y"])

    rows = docs.where(fit).select(f"`{text}`").mapInArrow(run, "x array<double>, y int").toPandas()
    if rows.empty or rows["y"].nunique() < 2:
        return None
    x, y = np.stack(rows["x"]), rows["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the same table whatever the partitions
    model = Boosted().fit(x[order], y[order])

    def histogram(batches):
        counts = np.zeros((len(KINDS), _BINS + 1, 2), np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                found = [r for t in b.column(0).slice(lo, 500).to_pylist() if t for r in training_rows(t)]
                if found:
                    z = np.array([r[0] for r in found])
                    np.add.at(counts, (z[:, 0].astype(int), (model.score(z) * _BINS).astype(int), [r[1] for r in found]), 1)
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (*at, counts[at])], names=["kind", "bin", "y", "n"])

    scores = docs.where(~fit).select(f"`{text}`").mapInArrow(histogram, "kind long, bin long, y long, n long")
    counts = np.zeros((len(KINDS), _BINS + 1, 2))
    for r in scores.groupBy("kind", "bin", "y").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"], r["bin"], r["y"]] = r["n"]
    limits = []
    for of in counts:
        right, every = np.cumsum(of[::-1, 1])[::-1], np.cumsum(of[::-1].sum(axis=1))[::-1]
        good = np.flatnonzero((every > 0) & (right >= PRECISION * every) & (of.sum(axis=1) > 0))
        limits.append(max(0.9, float(good[0]) / _BINS) if len(good) else 2.0)
    return model, limits


class Covered:
    """Stretches of a text that are taken; ``free`` looks one up by bisection."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)  # stretches from i on begin behind the span
        return i == 0 or self.ends[i - 1] <= a

    def take(self, a: int, b: int) -> None:
        i = bisect_left(self.starts, b)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def all_spans(text: str, model) -> list[tuple[int, int, int]]:
    """Strict spans and those the model adds, by kind and start."""
    spans = base_spans(text)
    if model is None:
        return spans
    taken = Covered((a, b) for _, a, b in spans)
    more = [c for c in candidates(text) if taken.free(c[1], c[2])]
    if more:
        score = model[0].score(np.array([features(text, *c) for c in more]))
        for s, c in sorted(zip(score, more), key=lambda x: (-x[0], x[1])):
            if s >= model[1][c[0]] and taken.free(c[1], c[2]):
                taken.take(c[1], c[2])
                spans.append(c)
    return sorted(spans)


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_FOUND = struct_of(n_email=T.LongType(), n_ip=T.LongType(), n_card=T.LongType(), n_phone=T.LongType(),
                   base_sha256=T.StringType(), spans=T.StringType())


def find(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column ``name``: counts and digest of the strict spans, and all spans."""
    model = train(docs, doc_id, text)

    def work(texts):
        out = []
        for t in texts:
            s = t.decode("utf-8", "replace") if t else ""
            strict, spans = base_spans(s), all_spans(s, model)
            counts = [sum(k == i for k, _, _ in strict) for i in range(len(KINDS))]
            out.append((*counts, hashlib.sha256(_named(strict).encode()).hexdigest(), _named(spans)))
        return out

    return annotate(docs, text, _FOUND, name, lambda: work, keep)


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``length`` follows if there."""
    model, new = train(docs, doc_id, text), fresh(docs, "redacted_")

    def one(t):
        if t is None:
            return (None,)
        s, out, at = t.decode("utf-8", "replace"), [], 0
        for k, a, b in sorted(all_spans(s, model), key=lambda x: (x[1], -x[2])):
            if a >= at:
                out += [s[at:a], f"[{KINDS[k].upper()}]"]
            at = max(at, b)
        return ("".join(out) + s[at:],)

    made = annotate(docs, text, struct_of(text=T.StringType()), new, lambda: lambda ts: [one(t) for t in ts])
    clean = F.col(f"{new}.text")
    number = dict(docs.dtypes).get(length)
    return made.select(*[clean.alias(c) if c == text else F.coalesce(F.length(clean).cast(number), F.col(f"`{c}`")).alias(c)
                         if c == length and number in ("bigint", "int") else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return find(read_table(spark, sf_dir, "documents"), "found", keep=["doc_id"]).select("doc_id", "found.*")
