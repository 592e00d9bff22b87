import os

import pytest

from tests.compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
if not os.path.isdir(FOLDER):
    pytest.skip("the given tables are not here", allow_module_level=True)

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(entry.queries()[name], entry.oracle_sql()[name], spark, FOLDER, connection) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_every_query_has_sql():
    from postlume.plans.oracle import ORACLE
    from postlume.plans.queries import QUERIES
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


def test_rules_stay_in_the_jvm_and_in_place(spark, plan):
    from postlume.operators.modules import enrich, switched_on
    from postlume.plans import inputs as I
    from postlume.sources.posts import normalize
    posts = normalize(I.documents(spark, FOLDER), I.PROVIDERS["documents"])
    text = plan(enrich(posts, switched_on()[0], I.AS_OF))
    for node in ("Exchange", "Join", "EvalPython", "MapInPandas", "Generate"):
        assert node not in text
    # Once as a column; the guards for # and @ keep their own patterns.
    assert text.count("regexp_extract_all(lower") == 1
