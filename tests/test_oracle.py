"""Every registered query with SQL runs in Spark and DuckDB and agrees."""

import os
import sys

import pytest

from tests.conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from reelspark.plans import registry  # noqa: E402
from oracle_check import compare  # noqa: E402

SLOW = {"als_grid_search"}  # property-tested in test_factor with a small grid


def test_every_query_registered_has_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    surveyed = {"movie_tags", "history_hot", "recent_hot", "average_score", "genre_topn",
                "genre_topn_token", "als_user_recs", "als_user_recs_cross", "item_similarity",
                "als_item_similarity", "als_grid_search", "rmse_item_mean", "content_similarity",
                "log_to_ratings", "realtime_recs", "pack_recs", "unpack_recs", "als_holdout_rmse",
                "factor_topk", "factor_predict", "als_recs_check", "als_user_optimality"}
    assert surveyed <= set(registry.all_queries()) <= set(q)


@pytest.mark.parametrize("name", sorted(registry.all_oracles()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name][0] == "MATCH", res[name]


@pytest.mark.parametrize("name", sorted(set(registry.all_queries()) - set(registry.all_oracles()) - SLOW))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["genres", "rank", "mid", "score"]
    assert df.count() > 0
