import os
import re
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


def operators(df):
    """The operators of the physical plan with their arguments and columns, one text each."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [re.sub(r"^\(\d+\) ", "", part) for part in re.split(r"\n\s*\n", text) if re.match(r"\(\d+\) ", part)]


@contextmanager
def no_broadcasts(spark):
    """The shape of plans at scale, where no side is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@pytest.fixture(scope="session")
def spark():
    from dialstat.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app="dialstat-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_small(spark):
    from dialstat.sources.bridge import contacts_raw

    return contacts_raw(spark, SF_SMALL)


@pytest.fixture(scope="session")
def clean_small(spark, raw_small):
    from dialstat.operators.clean import contacts_clean

    return contacts_clean(raw_small)


@pytest.fixture(scope="session")
def kpis_small(spark, clean_small):
    from dialstat.operators.mart import campaign_kpis

    return campaign_kpis(clean_small).persist()
