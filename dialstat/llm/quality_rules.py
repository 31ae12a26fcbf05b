"""Quality rules judged by document and by host (source), in DataFrame functions only.

Each document fails or passes a few rules. Failures are added up per host; a host's failure rate
is shrunk towards all hosts' by a beta prior whose two parameters are fitted to the hosts' rates
(method of moments): a host with few documents stays near the prior mean, a large one near its own
rate. The verdicts of the hosts are joined back to their documents:

* a host whose shrunk rate of a rule is below ``forgive`` is trusted on that rule: a lone failure
  there is taken as chance, unless it is gross;
* else a document that fails the rule goes;
* a host whose shrunk rate of "fails any rule" is ``condemn`` or more loses all its documents.

``base_failed`` documents (under 50 words, or over half of the words repeated) always go.

Shape: the texts are read once; a narrow table (id, host, counts) goes to the shared folder. Hosts
are aggregated map-side first, so a host with a third of all rows is no hot task; the join back is
on the narrow table (Spark broadcasts the hosts if small, else splits skewed hosts).

Defined cases: a null or empty text has no words and fails the base; null hosts form one host; an
empty table gives an empty result; equal rows get equal verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.common import read_table, stage, words_col

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: rule -> (numerator, denominator, limit, gross limit): fails above limit, grossly above the other.
RATIO_RULES = {
    "symbols": ("n_symbols", "n_words", 0.1, 0.5),
    "dup_lines": ("n_dup_lines", "n_lines", 0.3, 0.6),
    "long_words": ("word_chars", "n_words", 12.0, 20.0),
    "capitals": ("n_capitals", "word_chars", 0.3, 0.5),
}
FORGIVE = 0.02
CONDEMN = 0.9
_NOT_SPACE = r"[^\x20\x09-\x0D]"


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One narrow row per document with the counts the rules use."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host"),
                       body.alias("body"), words_col(body).alias("words"),
                       F.filter(F.split(body, "\n", -1), lambda s: s.rlike(_NOT_SPACE)).alias("lines"))
    n = F.size("words")
    blanks = F.length("body") - F.length(F.translate("body", " \t\n\x0b\x0c\r", ""))
    rows = rows.select(
        "doc_id", "host", n.cast("long").alias("n_words"),
        (F.length("body") - blanks).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("body") - F.length(F.translate("body", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long")
        .alias("n_capitals"),
        F.when(n >= 3, F.zip_with(
            F.zip_with(F.col("words"), F.slice("words", 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            F.slice("words", 3, n), lambda p, c: F.when(c.isNotNull(), F.xxhash64(p["a"], p["b"], c))))
        .alias("windows"))
    # zip_with fills the two places behind the last window with null
    rows = rows.withColumn("windows", F.filter("windows", lambda h: h.isNotNull()))
    twice = F.size("windows") > F.size(F.array_distinct("windows"))
    # (hash, place) sorted; a window repeats where a neighbour has the same hash
    rows = rows.withColumn("pairs", F.when(twice, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    size = F.size("pairs")
    rows = rows.withColumn("places", F.when(F.col("pairs").isNotNull(), F.sort_array(F.filter(F.zip_with(
        F.zip_with("pairs", F.slice("pairs", 2, size), lambda a, b: F.struct(
            a["i"].alias("i"), a["h"].alias("h"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("next"))),
        F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice("pairs", 1, size - 1)),
        lambda x, p: F.when(x["next"] | F.coalesce(x["h"] == p["h"], F.lit(False)), x["i"])),
        lambda i: i.isNotNull()))))
    covered = F.aggregate(F.zip_with("places", F.slice("places", 2, F.size("places")),
                                     lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
                          F.lit(0), lambda s, x: s + x)
    return rows.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines", "n_capitals")


def _base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _fails(rule: str, gross: bool = False) -> F.Column:
    above, below, limit, hard = RATIO_RULES[rule]
    return F.col(above) > F.col(below) * F.lit(hard if gross else limit)


def host_rates(rows: DataFrame) -> DataFrame:
    """(host, n, and for each rule and for "any" the shrunk failure rate)."""
    rules = {**{r: _fails(r) for r in RATIO_RULES}, "any": F.col("base_failed")}
    for r in RATIO_RULES:
        rules["any"] = rules["any"] | _fails(r)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                     *[F.count(F.when(c, 1)).alias(f"k_{r}") for r, c in rules.items()])
    hosts = stage(hosts, "quality-hosts")
    # moments of the hosts' rates: exact whole numbers per host, one row over all hosts
    moments = hosts.agg(F.count(F.lit(1)).alias("m"), F.avg(1 / F.col("n")).alias("inv"), *[e for r in rules for e in (
        (F.sum(f"k_{r}") / F.sum("n")).alias(f"mean_{r}"),
        F.var_pop(F.col(f"k_{r}") / F.col("n")).alias(f"var_{r}"))])
    row, out = moments.first(), hosts
    for r in rules:
        a, b = beta_prior(row[f"mean_{r}"], row[f"var_{r}"], row["inv"])
        out = out.withColumn(f"p_{r}", (F.col(f"k_{r}") + F.lit(a)) / (F.col("n") + F.lit(a + b)))
    return out.select("host", "n", *[f"p_{r}" for r in rules])


def beta_prior(mean: float | None, variance: float | None, inverse: float | None) -> tuple[float, float]:
    """Beta parameters with the hosts' mean rate; strength from the variance beyond chance.

    Without hosts or spread (all rates alike) the prior is strong, as many as 1,000 documents; with
    wide spread it is weak, at least one document.
    """
    mean = min(max(mean or 0.0, 1e-6), 1 - 1e-6)
    between = (variance or 0.0) - mean * (1 - mean) * (inverse or 0.0)
    strength = mean * (1 - mean) / between - 1 if between > 0 else 1000.0
    strength = min(max(strength, 1.0), 1000.0)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          forgive: float = FORGIVE, condemn: float = CONDEMN) -> DataFrame:
    """Per document: the counts, base_failed, kept, host_verdict (trusted, mixed or condemned)."""
    rows = stage(features(docs, doc_id, text, host), "quality-features").withColumn("base_failed", _base_failed())
    rates = host_rates(rows).withColumnRenamed("host", "of")
    both = rows.join(rates, rows["host"].eqNullSafe(rates["of"]))
    condemned = F.col("p_any") >= condemn
    bad = F.lit(False)
    for r in RATIO_RULES:
        bad = bad | (_fails(r) & ((F.col(f"p_{r}") >= forgive) | _fails(r, gross=True)))
    verdict = F.when(condemned, "condemned").when(F.col("p_any") < forgive, "trusted").otherwise("mixed")
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & ~bad & ~condemned).alias("kept"), verdict.alias("host_verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') body FROM documents),
f AS (
  SELECT doc_id, source, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') ws,
    list_filter(string_split(body, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) ls FROM t),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 2]) c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) i FROM f)),
rep AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest(range(i, i + 3)) p FROM win WHERE c > 1)
        GROUP BY doc_id),
g AS (
  SELECT f.doc_id, source, CAST(len(ws) AS BIGINT) n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) word_chars,
    CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) n_dup_lines, len(ls) n_lines,
    length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) n_capitals,
    CAST(coalesce(rep.n, 0) AS BIGINT) n_repeat_words
  FROM f LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed,
    n_symbols > 0.1 * n_words f1, n_symbols > 0.5 * n_words g1, n_dup_lines > 0.3 * n_lines f2,
    n_dup_lines > 0.6 * n_lines g2, word_chars > 12.0 * n_words f3, word_chars > 20.0 * n_words g3,
    n_capitals > 0.3 * word_chars f4, n_capitals > 0.5 * word_chars g4 FROM g),
h AS (
  SELECT source, count(*) n, u.rule, sum(u.k) k FROM (
    SELECT source, unnest([{'rule': 1, 'k': f1::INT}, {'rule': 2, 'k': f2::INT}, {'rule': 3, 'k': f3::INT},
      {'rule': 4, 'k': f4::INT}, {'rule': 0, 'k': (base_failed OR f1 OR f2 OR f3 OR f4)::INT}]) u FROM r)
  GROUP BY source, u.rule),
m AS (SELECT rule, least(greatest(sum(k) / sum(n), 1e-6), 1 - 1e-6) mu, var_pop(k / n) v, avg(1 / n) inv FROM h GROUP BY rule),
pr AS (
  SELECT rule, mu, least(greatest(CASE WHEN v - mu * (1 - mu) * inv > 0 THEN mu * (1 - mu) / (v - mu * (1 - mu) * inv) - 1
    ELSE 1000.0 END, 1.0), 1000.0) s FROM m),
p AS (SELECT source, rule, (k + mu * s) / (n + s) p FROM h JOIN pr USING (rule)),
hp AS (SELECT source, max(p) FILTER (rule = 0) p0, max(p) FILTER (rule = 1) p1, max(p) FILTER (rule = 2) p2,
         max(p) FILTER (rule = 3) p3, max(p) FILTER (rule = 4) p4 FROM p GROUP BY source)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND p0 < 0.9 AND NOT (f1 AND (p1 >= 0.02 OR g1)) AND NOT (f2 AND (p2 >= 0.02 OR g2))
    AND NOT (f3 AND (p3 >= 0.02 OR g3)) AND NOT (f4 AND (p4 >= 0.02 OR g4)) kept,
  CASE WHEN p0 >= 0.9 THEN 'condemned' WHEN p0 < 0.02 THEN 'trusted' ELSE 'mixed' END host_verdict
FROM r JOIN hp ON r.source IS NOT DISTINCT FROM hp.source
"""
