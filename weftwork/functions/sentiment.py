"""Sentiment of texts from a word list: sentences scored 0 to 4, their mean put into a band."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    positive: Sequence[str]
    negative: Sequence[str]


# A short general English list.
ENGLISH = Lexicon(
    positive=(
        "amazing", "awesome", "beautiful", "best", "better", "brilliant", "enjoy", "excellent", "fantastic",
        "fine", "fun", "glad", "good", "great", "happy", "impressive", "like", "love", "lovely", "nice",
        "perfect", "pleasant", "recommend", "superb", "thanks", "win", "wonderful",
    ),
    negative=(
        "angry", "annoying", "awful", "bad", "boring", "broken", "disappointing", "fail", "hate", "horrible",
        "lose", "mediocre", "nasty", "pain", "poor", "sad", "slow", "terrible", "ugly", "unhappy", "upset",
        "useless", "waste", "worse", "worst", "wrong",
    ),
)

# The band names and their upper bounds. Outside of them a text is not understood.
BANDS = ((1, "VERY_NEGATIVE"), (2, "NEGATIVE"), (3, "NEUTRAL"), (4, "POSITIVE"), (5, "VERY_POSITIVE"))
NOT_UNDERSTOOD = "NOT_UNDERSTOOD"


def text_score(text: str | Column, lexicon: Lexicon = ENGLISH) -> Column:
    """Mean sentence score; -1 for a text without sentences.

    A sentence starts neutral at 2 and moves by one per listed word, within 0 and 4. The whole text
    is scored inside its row, so nothing is shuffled.
    """
    sentences = F.filter(F.split(F.lower(text), "[.!?\\n]+"), lambda s: F.trim(s) != "")
    words = F.transform(sentences, lambda s: F.split(s, "[^\\p{L}\\p{N}]+"))

    def move(word: Column) -> Column:
        return F.when(word.isin(list(lexicon.positive)), 1).when(word.isin(list(lexicon.negative)), -1).otherwise(0)

    def add_sentence(total: Column, sentence: Column) -> Column:
        moved = F.aggregate(sentence, F.lit(2), lambda score, word: score + move(word))
        return total + F.greatest(F.lit(0), F.least(F.lit(4), moved))

    scored = F.aggregate(
        words, F.struct(F.lit(0).alias("total"), F.lit(0).alias("n")),
        lambda a, s: F.struct(add_sentence(a["total"], s).alias("total"), (a["n"] + 1).alias("n")),
        lambda a: F.when(a["n"] > 0, a["total"] / a["n"]).otherwise(F.lit(-1.0)),
    )
    return scored


def band(score: Column) -> Column:
    named = F.when(score < 0, NOT_UNDERSTOOD)
    for upper, name in BANDS:
        named = named.when(score < upper, name)
    return named.otherwise(NOT_UNDERSTOOD)
