"""Owners and tags from free-form ``meta`` objects (N-8).

``meta`` is a JSON object as VARIANT, whose values are strings, lists or anything else.
What its keys mean is said by rule tables, joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.functions.scalars import is_email

def meta_entries(nodes: DataFrame, id_col: str, meta_col: str) -> DataFrame:
    """(id, key, value variant), a row per key of each node's meta."""
    entries = F.try_variant_get(F.col(meta_col), "$", "map<string,variant>")
    return nodes.select(F.col(id_col).alias("id"), F.explode(entries).alias("key", "value"))


def _strings(value: Column) -> Column:
    """A string as a list of one, a list's strings, else nothing."""
    is_text = lambda v: F.schema_of_variant(v) == "STRING"
    items = F.filter(F.try_variant_get(value, "$", "array<variant>"), is_text)
    return F.when(is_text(value), F.array(F.try_variant_get(value, "$", "string"))).otherwise(
        F.transform(items, lambda v: F.try_variant_get(v, "$", "string")))


def meta_owners(nodes: DataFrame, rules: DataFrame, id_col: str = "id", meta_col: str = "meta") -> DataFrame:
    """(id, target, designation, email, person): ``rules`` have meta_key, designation,
    email_domain (null: names are left as they are) and target (dbt_model,
    materialized_table or both). Names without a domain get the rule's; what is no
    address then is dropped."""
    said = meta_entries(nodes, id_col, meta_col).select("id", "key", F.explode(_strings(F.col("value"))).alias("name"))
    met = said.join(rules, F.col("key") == F.col("meta_key"))
    email = F.when(F.col("name").contains("@") | F.col("email_domain").isNull(), F.col("name")).otherwise(F.concat("name", F.lit("@"), "email_domain"))
    targets = F.when(F.col("target") == "both", F.array(F.lit("dbt_model"), F.lit("materialized_table"))).otherwise(F.array("target"))
    valid = met.withColumn("email", email).filter(is_email(F.col("email")))
    return valid.select("id", F.explode(targets).alias("target"), "designation", "email", names.person_id(F.col("email")).alias("person"))


def meta_tags(nodes: DataFrame, rules: DataFrame, id_col: str = "id", meta_col: str = "meta") -> DataFrame:
    """(id, tag): ``rules`` have meta_key, matcher (a regex that must match the whole
    value, a plain value in JSON's spelling) and tag."""
    said = meta_entries(nodes, id_col, meta_col).select("id", "key", F.try_variant_get("value", "$", "string").alias("text"))
    fits = (F.col("key") == F.col("meta_key")) & F.regexp(F.col("text"), F.concat(F.lit("^(?:"), F.col("matcher"), F.lit(r")\z")))
    return said.join(rules, fits).select("id", "tag")


def listed_tags(nodes: DataFrame, key: str, id_col: str = "id", meta_col: str = "meta") -> DataFrame:
    """(id, tag) of the tags that meta lists under ``key``: a string or a list."""
    return meta_entries(nodes, id_col, meta_col).filter(F.col("key") == key).select("id", F.explode(_strings(F.col("value"))).alias("tag"))
