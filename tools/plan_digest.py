"""Print a digest of the executed physical plans of key queries (exchanges, joins,
windows, aggregates, scans with pushed filters). Usage: python tools/plan_digest.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dialstat.operators import mart as M  # noqa: E402
from dialstat.operators import quality as Q  # noqa: E402
from dialstat.operators.clean import contacts_clean  # noqa: E402
from dialstat.operators.metrics import base_metrics, enriched_metrics  # noqa: E402
from dialstat.plans.catalog import QUERIES  # noqa: E402
from dialstat.session import build_session, fresh_work_dir  # noqa: E402
from dialstat.sources import sinks as S  # noqa: E402
from dialstat.sources.bridge import contacts_raw  # noqa: E402
from dialstat.sources.ingest import read_raw  # noqa: E402

KEEP = ("Exchange", "Join", "Window", "Aggregate", "Scan", "TakeOrderedAndProject", "Sort ")


def digest(df, width=150):
    df.write.format("noop").mode("overwrite").save()  # run it, so AQE's final plan is shown
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            out.append(line[:width])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    raw_path = fresh_work_dir(spark, "digest_raw")
    contacts_raw(spark, sf).write.parquet(raw_path)
    raw = read_raw(spark, raw_path)
    clean = contacts_clean(raw)
    sections = {
        "bridge: driver tables -> contacts_raw": contacts_raw(spark, sf),
        "clean stage over a stored raw table": clean,
        "15-key group metrics (before materialisation)": M.with_group_key(enriched_metrics(base_metrics(clean))),
    }
    e = M.kpi_groups(clean)
    sections["ranks over the materialised groups"] = M.add_ranks(e)
    sections["mart final: ranks + segment summary join"] = M.campaign_kpis(clean)
    sections["27 checks, one summary"] = Q.summarize({"contacts_raw": raw, "contacts_clean": clean,
                                                      "campaign_kpis": M.campaign_kpis(clean)}, Q.published_checks())
    mart_path = fresh_work_dir(spark, "digest_mart")
    S.write_range_partitioned(M.campaign_kpis(clean), mart_path)
    mart, months_path = spark.read.parquet(mart_path), fresh_work_dir(spark, "digest_months")
    clean.select("contact_month_num", "contact_quarter").distinct().write.parquet(months_path)
    months = spark.read.parquet(months_path).where("contact_quarter = 'Q2'").selectExpr("contact_month_num - 1 AS bucket")
    sections["stored mart joined with the months of a quarter (folders pruned while it runs)"] = mart.join(
        months, mart[S.PARTITION_COL] == months["bucket"]).select("kpi_row_id", "contact_month", "total_contacts")
    sections["J1 from bucketed tables"] = QUERIES["kpi_with_segment_bucketed"](spark, sf)
    sections["row count from the footers"] = QUERIES["footer_row_count"](spark, sf)
    sections["medians by sketches"] = QUERIES["median_sketch"](spark, sf)
    for title, df in sections.items():
        print(f"### {title}\n\n```\n{digest(df)}\n```\n")


if __name__ == "__main__":
    main()
