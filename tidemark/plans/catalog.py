"""Product catalogue: prompts, generated texts, review digests, embeddings, assembled rows.

Products: key, brand, name, subhead, description, ingredients. Reviews: key, brand, author,
date, stars, title, helpful_yes, helpful_no, text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import NO_DESCRIPTION, NO_REVIEWS, alt_text_prompt, description_prompt, review_prompt
from tidemark.functions.scalars import (
    PRODUCT_BRAND_NAMES, code_label, day_label, null_if_text, object_link, suffix_if_present,
)
from tidemark.operators.enrich import EmbeddingProvider, GenerateOptions, TextProvider, embed, generate
from tidemark.operators.grouping import text_digest
from tidemark.operators.joins import left_lookup, outer_by_key
from tidemark.session import materialize

# Reviews of one digest part, and summaries that are summed up at once.
REVIEWS_PER_PART, SUMMARIES_PER_PART = 1_000, 100


def with_links(
    products: DataFrame, web_root: str, store_root: str, folder: str, brands: Mapping[str, str] = PRODUCT_BRAND_NAMES
) -> DataFrame:
    """Brand name, display name and the links of the product picture."""
    return products.withColumns(
        {
            "brand_name": code_label("brand", brands),
            "image_link": object_link(web_root, folder, "key", "png"),
            "image_uri": object_link(store_root, folder, "key", "png"),
        }
    ).withColumn("brand_and_product_name", F.concat("brand_name", F.lit(" "), "name"))


def with_short_descriptions(products: DataFrame, provider: Callable[[], TextProvider]) -> DataFrame:
    prompt = description_prompt("name", "subhead", "description")
    return materialize(
        generate(products, prompt, provider, "short_description", GenerateOptions(max_output_tokens=60)),
        "short-descriptions",
    )


def image_alt_texts(images: DataFrame, provider: Callable[[], TextProvider]) -> DataFrame:
    """Alt text per file; the file reference travels beside the prompt."""
    out = generate(images, alt_text_prompt(), provider, "alt_text", GenerateOptions(max_output_tokens=60), F.array("uri"))
    return materialize(out, "alt-texts")


def review_text() -> Column:
    """One review as text; NULL, and so left out of the digest, when any part is missing."""
    return F.concat(
        F.lit('"'), "title", F.lit('"\nStars: '), F.col("stars").cast("string"), F.lit("\nAuthor: "), "author",
        F.lit("\nDate: "), day_label("date"), F.lit("\n\n"), "text",
    )


def review_stats(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("key").agg(
        F.avg("stars").alias("avg_rating"),
        F.count_if(F.col("stars").isNotNull()).alias("num_ratings"),
        F.min("date").alias("first_review_date"),
        F.max("date").alias("last_review_date"),
    )


def review_digests(reviews: DataFrame, per_part: int = REVIEWS_PER_PART) -> DataFrame:
    """All reviews of a product as one text, most helpful and then newest first.

    Helpfulness and day are packed into one number (days take five digits) to order by.
    """
    day = F.unix_date("date")
    helpful = F.col("helpful_yes") - F.col("helpful_no")
    ordered = reviews.withColumn("_rank", helpful * 100_000 + day)
    return text_digest(
        ordered, ["key"], review_text(), "_rank", per_part, "all_reviews_concat", "\n\n\n", True,
        [("author", False), ("text", False)],
    )


def with_review_summaries(digests: DataFrame, provider: Callable[[], TextProvider]) -> DataFrame:
    """One row per product: parts of a long digest are summarised, then their summaries, until one is left.

    Such a product's ``all_reviews_concat`` is the text its last summary was made of, and num_texts all its reviews.
    """
    prompt, options = review_prompt("all_reviews_concat"), GenerateOptions(max_output_tokens=150)
    out = materialize(generate(digests, prompt, provider, "review_summary", options), "review-summaries")
    while out.where("part > 0").take(1):
        long = out.where("part > 0").select("key").distinct()
        parts = out.join(long, "key", "left_semi").withColumn("_part", F.col("part")).drop("part")
        counts = parts.groupBy("key").agg(F.sum("num_texts").alias("num_texts"))
        text = F.coalesce("review_summary_result", F.lit(""))
        merged = text_digest(parts, ["key"], text, "_part", SUMMARIES_PER_PART, "all_reviews_concat", "\n\n").drop("num_texts")
        firsts = counts.withColumn("part", F.lit(0).cast("long"))
        merged = merged.join(firsts, ["key", "part"], "left").withColumn("num_texts", F.coalesce("num_texts", F.lit(0)))
        final = generate(merged, prompt, provider, "review_summary", options)
        out = materialize(out.join(long, "key", "left_anti").unionByName(final.select(*out.columns)), "review-summaries")
    return out.drop("part")


def assemble(products: DataFrame, alt_texts: DataFrame, stats: DataFrame, summaries: DataFrame) -> DataFrame:
    """Products with picture texts and reviews, and all that was provided as one text.

    One row per product.
    """
    images = alt_texts.select(F.col("uri").alias("image_uri"), "alt_text_status", "alt_text_result")
    reviews = stats.join(summaries.drop("review_summary_json"), "key", "left")
    joined = left_lookup(left_lookup(products, images, ["image_uri"]), reviews, ["key"])
    digest = F.concat(
        F.lit("\n\nAll "), F.col("num_ratings").cast("string"), F.lit(" Reviews:\n\n"), "all_reviews_concat"
    )
    provided = F.concat(
        "brand_and_product_name",
        suffix_if_present("\n", "subhead"),
        suffix_if_present("\n\n", "description"),
        suffix_if_present("\n\nIngredients: ", "ingredients"),
        F.when(F.col("all_reviews_concat").isNull(), "").otherwise(digest),
    )
    return joined.drop("short_description_json").withColumn("product_all_provided_info", provided)


def text_embeddings(rows: DataFrame, text: str, sentinel: str, prefix: str, provider: Callable[[], EmbeddingProvider]) -> DataFrame:
    """Embedding of a generated text; a placeholder answer counts as no text."""
    content = rows.select("key", "brand_and_product_name", null_if_text(text, sentinel).alias(prefix))
    return materialize(embed(content, F.col(prefix), provider, prefix), f"{prefix}-embeddings")


def product_embeddings(descriptions: DataFrame, summaries: DataFrame, provider: Callable[[], EmbeddingProvider]) -> DataFrame:
    """Both embeddings per key, for keys present on either side."""
    first = text_embeddings(descriptions, "short_description_result", NO_DESCRIPTION, "short_description", provider)
    second = text_embeddings(summaries, "review_summary_result", NO_REVIEWS, "review_summary", provider)
    return outer_by_key(first, second, "key", ["brand_and_product_name"])
