"""Product summaries: group, name, prompt, external summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens import fixed_values as fixed
from revlens.functions.text import WHITESPACE, fill
from revlens.operators.memory import Memory, call_each_once
from revlens.operators.positions import with_position
from revlens.operators.providers import Provider, call_each
from revlens.params import Params
from revlens.sources.tables import keep


def with_product(reviews: DataFrame) -> DataFrame:
    """Reviews that can be put down to a product."""
    return reviews.where(F.col("product_id").isNotNull() & (F.col("product_id") != ""))


def product_groups(reviews: DataFrame) -> DataFrame:
    """Review count and name per product, by product. The first review names the
    product, and the id stands in for a missing name."""
    return (
        with_product(reviews)
        .groupBy("product_id")
        .agg(
            F.count("*").alias("review_count"),
            F.min_by("product_name", "seq").alias("_name"),
        )
        .select("product_id", _name(F.col("_name")).alias("product_name"), "review_count")
        .orderBy("product_id")
    )


def prompt_lines(reviews: DataFrame) -> DataFrame:
    """One numbered prompt line per review, with the product's name and size."""
    line = fill(
        fixed.SUMMARY_PROMPT_LINE,
        position=F.col("position"),
        rating=F.coalesce(F.col("rating").cast("string"), F.lit(fixed.MISSING_RATING)),
        title=F.coalesce("title", F.lit("")),
        body=F.coalesce("body", F.lit("")),
    )
    narrow = with_product(reviews).select(
        "product_id", "product_name", "seq", "rating", "title", "body"
    )
    return with_position(narrow, "product_id", ["seq"], first=["product_name"]).select(
        "product_id",
        _name(F.col("first_product_name")).alias("product_name"),
        F.col("group_rows").alias("review_count"),
        "position",
        F.rtrim(line, F.lit(WHITESPACE)).alias("line"),
    )


def prompts(reviews: DataFrame, params: Params) -> DataFrame:
    """Prompts of at most ``prompt_reviews`` reviews each, by product and part.

    A product that fits has the one part 0, its whole prompt. A larger product
    has all its reviews too, in numbered parts under the same head, so no row
    holds an unbounded group. With ``prompt_chars`` no prompt has more characters than
    that; a review that is too long for its share is continued in further lines.
    """
    lines = prompt_lines(reviews)
    if params.prompt_chars:
        return _prompts_packed(lines.withColumn("failed", F.lit(False)), params.prompt_chars)
    return _prompts(
        lines.withColumn("parts", F.col("review_count")).withColumn("failed", F.lit(False)),
        params.prompt_reviews,
    )


def summarize(
    reviews: DataFrame, params: Params, summarizer: Provider, memory: Memory | None = None
) -> DataFrame:
    """One summary per product, by product; a failed call leaves it empty.

    Every product is one call on one prompt with all its reviews, however many they
    are, so a prompt is as long as its product is large. ``summarize_tree`` bounds it.
    """
    lines = prompt_lines(reviews).withColumn("parts", F.lit(1).cast("long"))
    whole = _prompts(lines.withColumn("failed", F.lit(False)), None)
    return _by_product(_ask(whole, params, summarizer, memory))


def summarize_tree(
    reviews: DataFrame, params: Params, summarizer: Provider, memory: Memory | None = None
) -> DataFrame:
    """As ``summarize``, with at most ``prompt_reviews`` lines in a prompt.

    The reviews of every product are summarized in parts side by side, then the
    summaries of the parts are the lines of the next round, until one is left; a failed
    part fails it all. The caller chooses between the two, never a review count. With a
    ``memory`` a prompt that was answered in an earlier run is not sent again.
    """
    if params.prompt_chars:
        return _by_product(_tree_by_length(reviews, params, summarizer, memory))
    width = params.prompt_reviews
    answers = keep(_ask(prompts(reviews, params), params, summarizer, memory))
    parts = (answers.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        merged = _ask(_prompts(_summary_lines(answers), width), params, summarizer, memory)
        # Each round reads the one before twice.
        answers = keep(answers.where(F.col("parts") == 1).unionByName(merged))
        parts = -(-parts // width)
    return _by_product(answers)


def _tree_by_length(
    reviews: DataFrame, params: Params, summarizer: Provider, memory: Memory | None
) -> DataFrame:
    """Rounds until every product is one prompt; each has to need fewer prompts."""
    answers, before = keep(_ask(prompts(reviews, params), params, summarizer, memory)), None
    while left := answers.where(F.col("parts") > 1).count():
        if before is not None and left >= before:
            raise ValueError("summaries are too long to be summarized in prompts of prompt_chars")
        before = left
        asked = _prompts_packed(_summary_lines(answers), params.prompt_chars)
        merged = _ask(asked, params, summarizer, memory)
        answers = keep(answers.where(F.col("parts") == 1).unionByName(merged))
    return answers


def _summary_lines(answers: DataFrame) -> DataFrame:
    """The summaries of parts as the lines of the next round."""
    position = F.col("part") + 1
    return answers.where(F.col("parts") > 1).select(
        "product_id",
        "product_name",
        "review_count",
        "parts",
        position.alias("position"),
        fill("{n}. {summary}", n=position, summary=F.coalesce("summary", F.lit(""))).alias("line"),
        "failed",
    )


def _by_product(answers: DataFrame) -> DataFrame:
    """Sorted only once they are a table: a sort reads its input twice, and calls are paid."""
    summary = F.when(F.col("failed"), F.lit(fixed.FAILED_SUMMARY)).otherwise(F.col("summary"))
    kept = keep(
        answers.select("product_id", "product_name", "review_count", summary.alias("summary"))
    )
    return kept.orderBy("product_id")


def with_length(summaries: DataFrame) -> DataFrame:
    return summaries.withColumn("summary_length", F.length("summary"))


def _name(first_name: Column) -> Column:
    return F.coalesce(F.nullif(first_name, F.lit("")), F.col("product_id"))


#: Characters that the number of a continued line and what follows it may take.
_CONTINUED_CHARS = 34


def _prompts_packed(lines: DataFrame, chars: int) -> DataFrame:
    """Prompts of at most ``chars`` characters, as even as their lines allow.

    A line is cut into pieces of at most an eighth of a prompt. The pieces of a product
    follow each other on a scale of characters, whose offsets come from sums over blocks,
    and those that begin in the same stretch share a prompt. A stretch is shorter than the
    room under the head by one piece, so the last one always fits, and longer than a piece,
    so none is empty. ``parts`` is 1 if the product's pieces are all in one, else 2.
    """
    piece = chars // 8
    step = piece - _CONTINUED_CHARS
    head = fill(
        fixed.SUMMARY_PROMPT_HEAD,
        # Names have no limit of their own.
        product_name=F.substring("product_name", 1, chars // 4),
        review_count=F.col("review_count"),
    )
    last = F.greatest(F.lit(0), F.expr(f"(length(line) - 1) div {step}").cast("int"))
    continued = F.when(
        F.col("piece") > 0, fill(fixed.SUMMARY_PROMPT_CONTINUED, position=F.col("line_no"))
    ).otherwise("")
    pieces = (
        lines.select(
            "product_id", "product_name", "review_count", "failed", "line",
            F.col("position").alias("line_no"), F.explode(F.sequence(F.lit(0), last)).alias("piece"),
        )
        .withColumn("text", F.concat(continued, F.substr("line", F.col("piece") * step + 1, F.lit(step))))
        .drop("line")
        .withColumn("weight", F.length("text") + 1)
    )
    placed = with_position(pieces, "product_id", ["line_no", "piece"], weight="weight")
    room = F.lit(chars - piece) - F.length(head)
    part = F.floor(F.col("offset") / room).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "piece", "text")))
    return (
        placed.groupBy("product_id", "product_name", "review_count", part.alias("part"))
        .agg(
            ordered.alias("lines"),
            F.bool_or("failed").alias("failed"),
            F.sum("weight").alias("_own"),
            F.max("group_weight").alias("_all"),
        )
        .select(
            "product_id",
            "product_name",
            "review_count",
            F.when(F.col("_own") == F.col("_all"), 1).otherwise(2).cast("long").alias("parts"),
            "part",
            "failed",
            F.concat(head, F.lit("\n"), F.array_join(F.transform("lines", lambda x: x["text"]), "\n")).alias("prompt"),
        )
    )


def _prompts(lines: DataFrame, width: int | None) -> DataFrame:
    """Joins up to ``width`` lines, or all, under the head; ``parts`` becomes the number of
    prompts of the product in this round."""
    part, parts = F.lit(0).cast("long"), F.lit(1).cast("long")
    if width:
        part, parts = F.expr(f"(position - 1) div {width}"), F.expr(f"(parts + {width - 1}) div {width}")
    ordered = F.array_sort(F.collect_list(F.struct("position", "line")))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return (
        lines.groupBy("product_id", "product_name", "review_count", "parts", part.alias("part"))
        .agg(ordered.alias("lines"), F.bool_or("failed").alias("failed"))
        .select(
            "product_id",
            "product_name",
            "review_count",
            parts.alias("parts"),
            "part",
            "failed",
            F.concat(
                fill(
                    fixed.SUMMARY_PROMPT_HEAD,
                    product_name=F.col("product_name"),
                    review_count=F.col("review_count"),
                ),
                F.lit("\n"),
                text,
            ).alias("prompt"),
        )
    )


def _ask(
    asked: DataFrame, params: Params, summarizer: Provider, memory: Memory | None = None
) -> DataFrame:
    model = params.summary_model
    call = F.struct(
        F.col("prompt"),
        F.lit(model.model_id).alias("model_id"),
        F.lit(model.max_tokens).alias("max_tokens"),
        F.lit(model.temperature).cast("double").alias("temperature"),
    )
    args = ["prompt", "model_id", "max_tokens", "temperature"]
    calls = F.when(~F.col("failed"), F.array(call))
    if memory is None:
        answered = call_each(asked, summarizer, calls, args, "_results", "string")
    else:
        key = ["product_id", "part"]
        answered = call_each_once(asked, summarizer, calls, args, "_results", "string", key, memory)
    result = F.get("_results", F.lit(0))
    return answered.withColumn("summary", result["value"]).withColumn(
        "failed", F.col("failed") | F.coalesce(result["error"].isNotNull(), F.lit(True))
    ).drop("_results", "prompt")
