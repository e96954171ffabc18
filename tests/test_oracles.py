"""Every registered plan with an oracle equals its SQL statement (DuckDB)
on the smallest scale factor; plans without one run and return rows."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from helpers import canon

ORACLES = E.oracle_sql()
ALL = E.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_matches_oracle(spark, duck, name):
    got = ALL[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert canon(got) == canon(want)


def test_every_oracle_has_a_plan():
    assert set(ORACLES) <= set(ALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["n_purchases", "n_users", "revenue", "top_product", "top_product_count"]


@pytest.mark.parametrize("name", ["als_factors", "kmeans_fit", "pca_components", "svd_spectrum",
                                  "word2vec_synonyms", "hashing_tfidf_nb"])
def test_rows_only_plans_run(spark, name):
    assert ALL[name](spark, SF_SMALL).count() > 0
