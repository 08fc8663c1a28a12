import pytest

import bindings as B
from helpers import plan_of, rows, ts
from newsboard.plans.views import STORED, build_views, load_stored, refresh, register_views

SF = "/root/testdata/sf0.001"
AS_OF = ts("1998-06-15")

# Every view name a user of the source database can query.
NAMES = {
    "vw_feedly_entry_details", "articles", "vw_article_common_topics", "vw_article_common_common_topic_list",
    "vw_article_entities", "vw_article_entity_list", "vw_article_keywords", "vw_article_keyword_list",
    "vw_article_summary_sentences", "vw_article_priorities", "vw_xr_article_rankings", "vw_article_nlp_topics",
    "vw_article_nlp_entities", "vw_article_nlp_companies", "vw_article_nlp_text", "vw_article_nlp_categories",
    "vw_nlp_entities_without_concepts", "vw_xr_nlp_topics", "vw_xr_topics", "xr_company_articles_with_sectors",
    "vw_xr_channel_articles", "vw_xr_channel_article_details",
    "vw_xr_channel_articles_unsent_by_channel_and_target", "vw_latest_articles", "vw_top_articles_last_24_hours",
    "vw_article_entities_by_topics", "vw_article_entities_by_keywords", "vw_organization_categories",
    "vw_organization_category_groups", "vw_categories_with_category_groups", "vw_category_list",
    "vw_category_groups_list",
    *(f"vw_article_{s}_by_{g}" for s in ("topics", "keywords", "entities") for g in ("day", "week", "month")),
    *(
        f"vw_xr_ranked_{s}_by_{g}"
        for s in ("companies", "categories", "category_groups", "companies_by_categories", "topics")
        for g in ("day", "week", "month")
    ),
}


@pytest.fixture(scope="module")
def tables(spark):
    return B.order_tables(spark, SF)


@pytest.fixture(scope="module")
def views(tables):
    return build_views(tables, AS_OF, week=ts("1998-06-15"))


def test_every_view_is_there(views):
    assert set(views) == NAMES


def test_plans_have_no_python_and_no_cartesian_product(views):
    for name in NAMES:
        plan = plan_of(views[name])
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_only_the_ranking_of_a_few_rates_uses_one_window(views):
    for name in NAMES - {"vw_xr_article_rankings"}:
        physical = views[name]._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in physical, name


def test_registered_views_answer_sql_without_helper_columns(spark, views):
    register_views({n: views[n] for n in ("articles", "vw_article_nlp_companies", "vw_xr_ranked_companies_by_month")})
    assert "common_topics" not in spark.table("articles").columns
    assert "categories" not in spark.table("vw_article_nlp_companies").columns
    top = spark.sql("SELECT name, freq FROM vw_xr_ranked_companies_by_month WHERE rank = 1 AND max_freq <> freq")
    assert top.count() == 0


def test_refresh_stores_views_in_order(spark, tables, views, shared):
    fresh = refresh(tables, shared, AS_OF)
    assert set(load_stored(spark, shared)) == set(STORED)
    for name in ("articles", "vw_article_nlp_companies", "vw_xr_channel_article_details"):
        assert rows(fresh[name], "feedly_id") == rows(views[name], "feedly_id")
    board = "vw_xr_ranked_companies_by_month"
    assert rows(fresh[board]) == rows(views[board])
    assert "from_json" not in plan_of(fresh[board])

    # Only the named view gets a new version; the others stay as they are.
    none = {**tables, "feedly_entry_text_analyses": tables["feedly_entry_text_analyses"].where("false")}
    partly = refresh(none, shared, AS_OF, names=["vw_article_nlp_topics"])
    assert partly["vw_article_nlp_topics"].count() == 0
    assert partly["vw_article_nlp_companies"].count() == fresh["vw_article_nlp_companies"].count() > 0
    with pytest.raises(ValueError):
        refresh(tables, shared, AS_OF, names=["vw_latest_articles"])
