"""URL verdicts: rules by host and path, and a listed-domain filter held in a Bloom filter cascade.

Rules name a host and a path start; the longest that fits a URL's host (or a parent domain) and path
decides. All other URLs are decided by the list of blocked domains, given as a table or as words: a host
is blocked if it or a parent domain is listed.

The list is held without joins in a cascade. Level 1 is a Bloom filter of the listed domains of the
corpus; level 2 holds the unlisted domains that level 1 wrongly accepts, level 3 the listed ones that
level 2 wrongly accepts, and so on until none is left. All domains of the corpus (every host and its
parents) are the universe, so the cascade answers exactly for each of them. Tasks set the bits of
their keys, Spark joins them by word of 64 bits. A domain is known by two 64-bit hashes.

A filter larger than ``SHARD_BYTES`` is cut by a hash of the domain into shards, each its own cascade
that answers for its own domains. With several shards, the pages' narrow rows pass them one after the
other, written in between, and a shard is released before the next is made: whatever the list's size,
the driver and an executor hold one.

Defined cases: a null URL or one without "://" has empty host and path, and no domain: it is allowed;
an empty list blocks nothing; listed domains are compared without case and without
a dot in front, null and blank ones are no domains, repeated ones count once; equal URLs get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.common import ascii_lower, read_table, stage
from dialstat.llm.textsets import mix

#: (verdict, host, path start): fixed by the task.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Without a list as a table: a domain is listed if its first label has one of these words, bordered by no letter
#: (chosen for the kinds of sites that the given pages hold; a real list is a table, see ``judge``).
BLOCKED_WORDS = ("adult", "bets", "casino", "pills", "spam", "xxx")
BITS_PER_KEY, PROBES = 10, 5
SHARD_BYTES = 16 << 20


def split_url(url) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url_, instr(url_, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return ascii_lower(host), path


def parents(host) -> F.Column:
    """The host and its parent domains, longest first; none for an empty host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    every = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.filter(every, lambda d: d != ""))


def rule_of(host, path, rules=RULES) -> F.Column:
    """The longest rule that fits, as host and path start; null if none does."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p)).otherwise(out)
    return out


def _hashes(key) -> list[F.Column]:
    """Two independent 64-bit hashes of a domain: all that the filters see of it."""
    return [F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)]


def _places(h1: np.ndarray, h2: np.ndarray, bits: int, salt: int) -> np.ndarray:
    """Probe positions, one row per key, one column per probe."""
    one = mix(h1.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64))
    two = mix(h2.astype(np.uint64) ^ one) | np.uint64(1)
    return (one[:, None] + np.arange(PROBES, dtype=np.uint64) * two[:, None]) % np.uint64(bits)


def _holds(h1, h2, level) -> np.ndarray:
    bits, salt, words = level
    at = _places(h1, h2, bits, salt)
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def bloom(keys: DataFrame, n: int, salt: int) -> tuple[int, int, np.ndarray]:
    """Filter of the keys (h1, h2): bits are joined inside tasks, then by word of 64 bits."""
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)

    def run(batches):
        for b in batches:
            at = _places(b.column(0).to_numpy(), b.column(1).to_numpy(), bits, salt).reshape(-1)
            word, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            held = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(held, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(held.view(np.int64))],
                                             names=["word", "held"])

    rows = keys.select("h1", "h2").mapInArrow(run, "word long, held long").groupBy("word").agg(
        F.bit_or("held").alias("held")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["held"].to_numpy(np.int64).view(np.uint64)
    return bits, salt, words


def cascade(listed: DataFrame, unlisted: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """Levels from keys (h1, h2): the first, third, ... hold listed keys, the others unlisted keys."""
    levels, these, others = [], listed, unlisted
    while (n := these.count()) > 0:
        level = bloom(these, n, len(levels) + 1)
        levels.append(level)

        def wrong(batches, level=level):
            for b in batches:
                yield b.filter(pa.array(_holds(b.column(0).to_numpy(), b.column(1).to_numpy(), level)))

        wrongly = stage(others.select("h1", "h2").mapInArrow(wrong, "h1 long, h2 long"), "cascade")
        these, others = wrongly, these
    return levels


def member(h1: np.ndarray, h2: np.ndarray, levels) -> np.ndarray:
    """Exact membership of universe keys: the first level that rejects a key decides."""
    out, left = np.full(len(h1), len(levels) % 2 == 1), np.arange(len(h1))
    for i, level in enumerate(levels):
        held = _holds(h1[left], h2[left], level)
        out[left[~held]] = i % 2 == 1
        left = left[held]
    return out


def any_member(levels, shard: int, shards: int):
    """A column function: whether one of a row's domains (arrays of h1 and h2) is listed in this shard."""
    @F.pandas_udf("boolean")
    def test(one: pd.Series, two: pd.Series) -> pd.Series:
        sizes = one.map(len).to_numpy()
        out = np.zeros(len(one), bool)
        if sizes.sum():
            h1, h2 = np.concatenate(one.to_numpy()).astype(np.int64), np.concatenate(two.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(one)), sizes)
            here = np.flatnonzero(h1 % shards == shard)
            out[row[here[member(h1[here], h2[here], levels.value)]]] = True
        return pd.Series(out)

    return test


def is_listed(blocked=BLOCKED_WORDS) -> F.Column:
    """Whether a domain is on the list of words: its first label has one, with no letter beside it."""
    return F.substring_index("key", ".", 1).rlike(f"(^|[^a-z])({'|'.join(blocked)})([^a-z]|$)") if blocked else F.lit(False)


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, blocked=BLOCKED_WORDS,
          shard_bytes: int = SHARD_BYTES, domains: DataFrame | None = None, domain: str = "domain") -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``domains`` is a table of blocked domains (column ``domain``) of any size; only those that are hosts of the corpus or
    their parents enter the cascade. It stands for the words ``blocked``.
    """
    host, path = split_url(F.col("url_"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url_"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    every = F.explode(parents(F.col("host"))).alias("key")
    universe = stage(rows.select("host").distinct().select(every).distinct().withColumns(
        dict(zip(("h1", "h2"), _hashes(F.col("key"))))), "domains")
    if domains is None:
        listed, unlisted = universe.where(is_listed(blocked)), universe.where(~is_listed(blocked))
    else:
        named = ascii_lower(F.regexp_replace(F.btrim(F.col(f"`{domain}`").cast("string")), r"^\.+", ""))
        wanted = stage(domains.select(named.alias("key")).where("key <> ''").distinct(), "listed-domains")
        # written once: the two sides of the cascade must not differ
        listed = stage(universe.join(wanted, "key", "left_semi"), "listed")
        unlisted = universe.join(wanted, "key", "left_anti")
    shards = max(1, -(-listed.count() * BITS_PER_KEY // (8 * shard_bytes)))
    here = lambda k: F.pmod("h1", F.lit(shards)) == k
    up = parents(F.col("host"))
    rows = rows.withColumn("one", F.transform(up, lambda d: _hashes(d)[0])).withColumn(
        "two", F.transform(up, lambda d: _hashes(d)[1]))
    rows = rows.withColumn("bad", F.lit(False))
    for k in range(shards):
        levels = cascade(listed.where(here(k)), unlisted.where(here(k)))
        if levels:
            known = pages.sparkSession.sparkContext.broadcast(levels)
            rows = rows.withColumn("bad", F.col("bad") | any_member(known, k, shards)(F.col("one"), F.col("two")))
            if shards > 1:
                rows = stage(rows, "url-shard")
                known.destroy()
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdicts = F.lit(None).cast("string")
    for v, h, p in rules:
        verdicts = F.when(F.col("rule") == h + p, v).otherwise(verdicts)
    marked = rows.withColumn("rule", rule)
    by_list = F.when(F.col("bad"), "block").otherwise("allow")
    return marked.select("page_id", "host", "path", "rule", F.coalesce(verdicts, by_list).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(coalesce(r, ''), '^[^/?#]*(/[^?#]*)', 1) path FROM u),
g AS (SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/es/') THEN 'example.org/es/'
    WHEN suffix(host, '.com') AND prefix(path, '/de/') OR host = 'com' AND prefix(path, '/de/') THEN 'com/de/'
    WHEN suffix(host, '.com') AND prefix(path, '/fr/') OR host = 'com' AND prefix(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/') THEN 'org/' END rule FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN len(list_filter(string_split(host, '.'), lambda d: regexp_matches(d, '(^|[^a-z])(adult|bets|casino|pills|spam|xxx)([^a-z]|$)'))) > 0
    THEN 'block' ELSE 'allow' END verdict FROM g
"""
