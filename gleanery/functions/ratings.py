"""Rating bands, sentiment labels and their agreement."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOW_STAR = 2.0
HIGH_STAR = 4.0
POSITIVE_CUTOFF = 0.05
NEGATIVE_CUTOFF = -0.05


def rating_band(overall: Column) -> Column:
    """negative up to 2 stars, positive from 4, neutral between; null when not a number."""
    stars = overall.try_cast("double")
    # Spark orders NaN above every number, so it is named first.
    return (
        F.when(F.isnan(stars), "neutral")
        .when(stars <= LOW_STAR, "negative")
        .when(stars >= HIGH_STAR, "positive")
        .when(stars.isNotNull(), "neutral")
    )


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_CUTOFF, "positive")
        .when(compound <= NEGATIVE_CUTOFF, "negative")
        .otherwise("neutral")
    )


def agreement(overall: Column, label: Column) -> Column:
    return rating_band(overall) == label


def politeness_label(profane: Column) -> Column:
    return F.when(profane, "impolite").otherwise("clean")


def stored_rating(overall: Column) -> Column:
    return overall.try_cast("decimal(3,1)")
