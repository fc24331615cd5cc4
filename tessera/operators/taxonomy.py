"""Topic taxonomy as long tables: category(cat_ord, name, description), subcategory(category, cat_ord, sub_ord, name,
description), query(category, cat_ord, subcategory, sub_ord, q_ord, query)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.annotate import annotated

_NAMED = "array<struct<name string, description string>>"


def categories(spark: SparkSession, country: str, annotator, **options) -> DataFrame:
    """(cat_ord, name, description); a blank country is an error, a failed call gives no rows."""
    if not country or not country.strip():
        raise ValueError("country is required")
    one = spark.range(1).select(F.lit("categories").alias("item_id"), F.lit(f"Country or culture: {country}").alias("message"))
    found = annotated(one, annotator, "List CATEGORIES of knowledge as JSON: {categories: [{name, description}]}.", **options)
    items = F.from_json("data", f"struct<categories {_NAMED}>")
    return found.where("success").select(F.posexplode(items["categories"]).alias("cat_ord", "c")).select("cat_ord", "c.name", "c.description")


def subcategories(category: DataFrame, country: str, annotator, **options) -> DataFrame:
    """(category, cat_ord, sub_ord, name, description); a failed category keeps one row with null sub_ord and name."""
    ask = category.select(F.col("name").alias("item_id"), F.concat_ws("\n", F.lit(f"Country or culture: {country}"), F.coalesce("description", F.lit("")), F.col("name")).alias("message"))
    found = annotated(ask, annotator, "List SUBCATEGORIES as JSON: {subcategories: [{name, description}]}.", **options)
    items = F.when(F.col("success"), F.from_json("data", f"struct<subcategories {_NAMED}>")["subcategories"])
    rows = found.select(F.col("id").alias("category"), F.posexplode_outer(items).alias("sub_ord", "s"))
    return rows.join(category.select(F.col("name").alias("category"), "cat_ord"), "category").select("category", "cat_ord", "sub_ord", "s.name", "s.description")


def queries(subcategory: DataFrame, country: str, annotator, **options) -> DataFrame:
    """(category, cat_ord, subcategory, sub_ord, q_ord, query) of the (category, subcategory) pairs, the last of equal
    pairs winning; failed pairs and categories without subcategories have no rows."""
    pairs = subcategory.where("name is not null").groupBy("category", "name").agg(F.max_by(F.struct("cat_ord", "sub_ord", "description"), F.struct("cat_ord", "sub_ord")).alias("s"))
    ident = F.concat_ws("||", "category", "name")
    ask = pairs.select(ident.alias("item_id"), F.concat_ws("\n", F.lit(f"Country or culture: {country}"), "category", F.coalesce("s.description", F.lit("")), "name").alias("message"))
    found = annotated(ask, annotator, "List search QUERIES as JSON: {search_queries: [text]}.", **options)
    listed = found.where("success").select(F.col("id"), F.posexplode(query_list(F.col("data"))).alias("q_ord", "query"))
    return pairs.withColumn("id", ident).join(listed, "id").select("category", "s.cat_ord", F.col("name").alias("subcategory"), "s.sub_ord", "q_ord", "query")


def query_list(payload: Column) -> Column:
    """Queries of a JSON payload: `search_queries`, else `keywords`; of objects their `query`, else `keyword`; only
    non-empty text stays."""
    v = F.try_parse_json(payload)
    lists = [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ("search_queries", "keywords")]
    items = F.when(F.size(F.coalesce(lists[0], F.array().cast("array<variant>"))) > 0, lists[0]).otherwise(lists[1])
    items = F.coalesce(items, F.array().cast("array<variant>"))
    kind = lambda x: F.schema_of_variant(x)
    plain = lambda x: F.when(kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
    part = lambda x, k: F.nullif(F.when(F.schema_of_variant(F.try_variant_get(x, f"$.{k}", "variant")) == "STRING", F.try_variant_get(x, f"$.{k}", "string")), F.lit(""))
    objects = F.transform(items, lambda x: F.coalesce(part(x, "query"), part(x, "keyword")))
    texts = F.when(F.coalesce(kind(F.get(items, F.lit(0))).startswith("OBJECT"), F.lit(False)), objects).otherwise(F.transform(items, plain))
    return F.filter(texts, lambda x: x.isNotNull() & (x != ""))


def flattened(query: DataFrame, max_queries: int | None = None) -> DataFrame:
    """The queries in taxonomy order, repeats kept; the first `max_queries` of them where that is not null or 0."""
    rows = query.select("cat_ord", "sub_ord", "q_ord", "query")
    return rows.orderBy("cat_ord", "sub_ord", "q_ord").limit(max_queries) if max_queries else rows


def required(query: DataFrame) -> DataFrame:
    if query.isEmpty():
        raise RuntimeError("the taxonomy has no queries")
    return query


def counts(query: DataFrame, by: str = "category", sub: str = "subcategory") -> DataFrame:
    """Subcategories and queries of each category, and of all (null category), in one pass."""
    pairs = query.groupBy(by, sub).agg(F.count("*").alias("n"))
    return pairs.rollup(by).agg(F.count("*").alias("n_subcategories"), F.sum("n").alias("n_queries"))


def trimmed(category: DataFrame, subcategory: DataFrame, query: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first n categories and what belongs to them."""
    keep = category.where(F.col("cat_ord") < n)
    names = keep.select(F.col("name").alias("category"))
    return keep, subcategory.join(names, "category", "left_semi"), query.join(names, "category", "left_semi")
