"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# The smallest tables have no complete feature row, so fits need the next larger ones.
FITTED_DIR = "/root/testdata/sf0.01"
FITTED = {
    "batch_score_meters", "early_stopping", "feature_importance_topk", "fit_point", "fit_quantile", "model_save_load",
    "score_long", "score_one_meter",
}
# Thirty fits: check_oracle.py runs it, test_model.py tests the search itself.
LONG = {"tune_random_search"}


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - LONG))
def test_matches_oracle(spark, name):
    folder = FITTED_DIR if name in FITTED else SF_DIR
    got = queries()[name](spark, folder).toPandas()
    assert compare(got, connect(folder).sql(oracle_sql()[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert {r.method for r in entry(spark).collect()} == {
        "point",
        "daily_naive",
        "weekly_naive",
        "rolling_avg_7d",
    }
