"""Keyword sentiment and label handling."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.fixed_values import (
    LABEL_SPELLINGS, NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, SENTIMENTS)


def keyword_hits(text: Column, keywords, whole_words: bool = False) -> Column:
    """How many of the keywords occur in the text; each counts once.

    By default a keyword matches inside longer words too. `whole_words` asks for word borders.
    """
    def found(keyword: str) -> Column:
        if whole_words:
            return text.rlike(rf"(?<![\p{{L}}\p{{N}}_]){keyword}(?![\p{{L}}\p{{N}}_])")
        return F.contains(text, F.lit(keyword))

    return reduce(add, [F.when(found(k), 1).otherwise(0) for k in keywords], F.lit(0))


def sentiment_hits(text: Column, whole_words: bool = False) -> tuple[Column, Column]:
    """(positive, negative) hit counts of a lower-case text."""
    return (keyword_hits(text, POSITIVE_KEYWORDS, whole_words),
            keyword_hits(text, NEGATIVE_KEYWORDS, whole_words))


def _percent(part: Column, whole: Column) -> Column:
    # bround, because a half has to go to the even neighbour: 12.5 -> 12
    return F.when(whole == 0, 0).otherwise(F.bround(part / whole * 100).cast("int"))


def prediction_from_hits(positive: Column, negative: Column) -> Column:
    """Struct (positive_score, negative_score, sentiment) from two hit counts."""
    total = positive + negative
    label = (F.when(positive > negative, "positive")
             .when(negative > positive, "negative").otherwise("neutral"))
    return F.struct(
        _percent(positive, total).alias("positive_score"),
        _percent(negative, total).alias("negative_score"),
        label.alias("sentiment"))


def confidence_from_hits(positive: Column, negative: Column) -> Column:
    """Share of the winning side among all hits; 0 without a hit."""
    total = positive + negative
    return F.when(total == 0, F.lit(0.0)).otherwise(F.greatest(positive, negative) / total)


def normalize_label(label: Column) -> Column:
    """Map classifier label spellings to positive / neutral / negative; fail on anything else."""
    spelling = F.lower(F.trim(label))
    stars = F.split(spelling, r"\s+")[0].try_cast("int")
    failure = F.raise_error(F.concat(
        F.lit("Unsupported sentiment label: "), F.coalesce(label, F.lit("null"))))
    by_stars = (F.when(stars <= 2, "negative").when(stars == 3, "neutral")
                .when(stars > 3, "positive").otherwise(failure))
    mapped = None
    for sentiment, spellings in LABEL_SPELLINGS.items():
        test = spelling.isin(*spellings)
        mapped = F.when(test, sentiment) if mapped is None else mapped.when(test, sentiment)
    return mapped.when(F.contains(spelling, F.lit("star")), by_stars).otherwise(failure)


def strongest(positive: Column, neutral: Column, negative: Column) -> Column:
    """Label of the largest score; on a tie the first of positive, neutral, negative."""
    best = F.greatest(positive, neutral, negative)
    first, second, third = SENTIMENTS
    return F.when(positive == best, first).when(neutral == best, second).otherwise(third)


def prediction_from_scores(positive: Column, neutral: Column, negative: Column) -> Column:
    """Struct (positive_score, negative_score, sentiment) from class scores between 0 and 1."""
    def percent(score: Column) -> Column:
        return F.bround(score * 100).cast("int")

    return F.struct(percent(positive).alias("positive_score"),
                    percent(negative).alias("negative_score"),
                    strongest(positive, neutral, negative).alias("sentiment"))
