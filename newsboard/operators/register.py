"""Category views of the company register."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsboard.operators.analysis import list_column
from newsboard.operators.unnest import distinct_values, unnest


def org_categories(organizations: DataFrame) -> DataFrame:
    items = list_column(organizations, "category_list")
    return unnest(organizations, items, "category", ["uuid", "name"])


def org_category_groups(organizations: DataFrame) -> DataFrame:
    items = list_column(organizations, "category_groups_list")
    return unnest(organizations, items, "category_group", ["uuid", "name"])


def category_map(category_groups: DataFrame) -> DataFrame:
    items = list_column(category_groups, "category_groups_list")
    return unnest(
        category_groups, items, "category_group",
        ["id", F.col("name").alias("category"), "permalink"],
    )


def category_list(category_groups: DataFrame) -> DataFrame:
    return category_groups.select("id", F.col("name").alias("category"), "permalink").distinct()


def group_list(category_groups: DataFrame) -> DataFrame:
    return distinct_values(category_map(category_groups), "category_group")
