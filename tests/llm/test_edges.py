"""Every query and every pipeline stage over awkward tables: nulls in every column, empty and long
texts, repeated rows, ties, extra columns that have the operators' own names, and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dialstat.llm import queries
from dialstat.llm.common import fresh

#: Names that the operators use inside.
CLASHING = """score_ score_l score_limit score_mean score_n kept_id kept node n f1 f2 sketch component component_id to g tiles k
key hits_ scan_ lo hi items found n_words contaminated redacted_ mix_of mix_rate copy_ size source_size target coin part
place weight host of hashes hash path rule verdict bad one two row token c p s t l id trusted_id n_bytes log_p perplexity
d_ t_ z_ d r row_ whole places cut_ packed_ runs_ least mask m doc filter_order step letter""".split()
PLAIN = " ".join(f"word{(7 + j * j) % 50}" for j in range(60))
TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "a b c d a b c d"), (6, "a b c d a b c d"),
         (7, "Same line\n\nSame line\nother"), (8, "x " * 30000), (9, "#" * 400), (None, "no id here at all"), (None, None),
         (10, "mail bob@example.com or +49 30 1234567 or bob (at) example dot com"), (11, "é\U0001F600 \x00 q"),
         (12, "w1 w2 w3 " + "z" * 200000), *[(100 + k, f"{PLAIN} n{k // 4}") for k in range(40)]]
ROWS = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long",
                  [(i, t, [None, "en", "de"][k % 3], [None, "s1", "s2"][k % 3], None if k % 2 else len(t or ""))
                   for k, (i, t) in enumerate(TEXTS)]),
    "pages": ("page_id long, url string, html string",
              [(1, None, None), (2, "no url", ""), (None, "http://a.com/de/x", "<p>hi"), (4, "http://casino.net", "z" * 300000),
               *[(3, "HTTP://A.ORG/es/?q", "<article>x<p>y</article>")] * 2, (5, "://", "<" * 5000),
               (6, "http://?x#y", "&amp;&#0;&#xD800;")]),
    "benchmark": ("item_id string, text string",
                  [("a", None), ("b", ""), (None, "one two"), ("c", "one"), ("c", "one"), ("d", PLAIN)]),
    "labels": ("doc_id long, quality int, toxic int", [(None, None, None), (100, 1, 0), (100, 0, 0), (101, 1, None), (999, 1, 1)]),
}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """A folder of awkward tables, one without benchmark and labels, one of empty tables."""
    base = tmp_path_factory.mktemp("awkward")
    for name, (schema, rows) in ROWS.items():
        df = spark.createDataFrame(rows, schema)
        df = df.select("*", *[F.lit("x" if i % 2 else None).cast("string").alias(c) for i, c in enumerate(CLASHING)])
        lists = name in ("benchmark", "labels")
        for case, table in (("all", df), ("no_lists", df.limit(0) if lists else df), ("empty", df.limit(0))):
            table.write.parquet(f"{base}/{case}/{name}.parquet")
    return base


@pytest.mark.parametrize("case", ["all", "no_lists", "empty"])
def test_queries_return_a_row_for_each_row(spark, folders, case):
    for name, query in queries.QUERIES.items():
        table = "pages" if name.startswith(("op3_", "op9_")) else "documents"
        key = "page_id" if table == "pages" else "doc_id"
        ids = [None if case == "empty" else r[0] for r in ROWS[table][1]]
        if name.startswith("op12_"):  # counts by part, order and step
            assert query(spark, f"{folders}/{case}").count() == (0 if case == "empty" else 3 * 120 * 5)
            continue
        got = [r[key] for r in query(spark, f"{folders}/{case}").collect()]
        assert sorted(got, key=str) == ([] if case == "empty" else sorted(ids, key=str)), name


@pytest.mark.parametrize("case", ["all", "no_lists", "empty"])
def test_stages_keep_the_columns_and_their_decisions(spark, folders, case):
    docs = spark.read.parquet(f"{folders}/{case}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"{folders}/{case}")
        assert out.columns[:len(docs.columns)] == docs.columns and out.columns[len(docs.columns):] == (["copy"] if name == "mix" else [])
        kept[name] = out.collect()
    if case == "empty":
        assert not any(kept.values())
        return
    n = docs.count()
    assert len(kept["personal_data"]) == n and len(kept["quality"]) <= n
    # the least of the forty texts alike (they differ in one of 61 words), and all others
    ids = {r.doc_id for r in kept["near_dedup"]}
    assert ids == {*range(1, 13), 100, None}
    clean = {r.doc_id for r in kept["decontaminate"]}
    assert (100 not in clean and 4 not in clean) if case == "all" else len(kept["decontaminate"]) == n
    redacted = [r.text for r in kept["personal_data"] if r.doc_id == 10][0]
    assert "bob@example.com" not in redacted and "[EMAIL]" in redacted and "[PHONE]" in redacted


def test_helper_names_begin_no_column(spark):
    df = spark.range(1).selectExpr("id", "id AS Score_limit", "id AS score__n")
    assert fresh(df, "score_") == "score___" and fresh(df, "mix_of") == "mix_of"
