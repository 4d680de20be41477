"""Relevance, topics, polarity, evidence and cost, as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import fold, folded


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def relevance(title: Column | str, summary: Column | str, required: list[str], penalised: list[str]) -> Column:
    """0 without a required term; else 1, less 0.30 for each penalised entry found, plus 0.15 for one in the title; within 0 to 1.

    Terms are compared folded; each entry of ``penalised`` counts, so spellings
    that fold alike count twice. The title bonus looks for the term as written.
    """
    title, summary = _c(title), F.coalesce(_c(summary), F.lit(""))
    text = fold(F.concat(title, F.lit(" "), summary))
    has = lambda t: text.contains(folded(t))
    score = F.lit(1.0)
    for t in penalised:
        score = score - F.when(has(t), F.lit(0.30)).otherwise(F.lit(0.0))
    anywhere, in_title = F.lit(False), F.lit(False)
    for t in required:
        anywhere = anywhere | has(t)
        in_title = in_title | (F.lower(title).contains(t) & has(t))
    score = score + F.when(in_title, F.lit(0.15)).otherwise(F.lit(0.0))
    return F.when(anywhere, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).otherwise(F.lit(0.0))


def once(value: Column, use) -> Column:
    """use(value), the value being computed once however often it is used, also in branches."""
    return F.transform(F.array(value), use)[0]


def word_pattern(word: str) -> str:
    """A word and up to three more letters, at word boundaries."""
    return rf"(?U)\b{re.escape(folded(word))}\w{{0,3}}\b"


def topic_weights(title: Column | str, summary: Column | str, vocabulary: dict[str, list[str]]) -> Column:
    """array<struct<topic, weight, position>> of topics with weight 0.9 or more, heaviest first.

    A word counts 1.0 in the title, else 0.5 in the summary; ties keep the
    vocabulary's order. The body is not read: it carries menus and teasers.
    """

    def of(folded_texts: Column) -> Column:
        t, s = folded_texts["t"], folded_texts["s"]
        found = []
        for place, (topic, words) in enumerate(vocabulary.items()):
            weight = F.lit(0.0)
            for w in words:
                weight = weight + F.when(t.rlike(word_pattern(w)), F.lit(1.0)).when(s.rlike(word_pattern(w)), F.lit(0.5)).otherwise(F.lit(0.0))
            found.append(F.struct((-weight).alias("order"), F.lit(place).alias("place"), F.lit(topic).alias("topic"), weight.alias("weight")))
        return F.array(*found)

    texts = F.struct(fold(F.coalesce(_c(title), F.lit(""))).alias("t"), fold(F.coalesce(_c(summary), F.lit(""))).alias("s"))
    kept = F.array_sort(F.filter(once(texts, of), lambda x: x["weight"] >= 0.9))
    return F.transform(kept, lambda x, i: F.struct(x["topic"].alias("topic"), x["weight"].alias("weight"), i.alias("position")))


def topics(title: Column | str, summary: Column | str, vocabulary: dict[str, list[str]]) -> Column:
    return F.transform(topic_weights(title, summary, vocabulary), lambda x: x["topic"])


def topic_confidence(position: Column | str) -> Column:
    """1.0 for the first topic and 0.2 less for each later one, 0.2 at least."""
    return F.round(F.greatest(F.lit(0.2), F.lit(1.0) - F.lit(0.2) * _c(position)), 2)


def polarity(score: Column | str) -> Column:
    s = _c(score)
    return F.when(s >= 7, "positive").when(s >= 5, "neutral").when(s.isNotNull(), "negative")


def band(score: Column | str) -> Column:
    s = _c(score)
    return F.when(s >= 9, "very positive").when(s >= 7, "positive").when(s >= 5, "neutral").when(s >= 3, "negative").when(s.isNotNull(), "critical")


def short_band(score: Column | str) -> Column:
    s = _c(score)
    return F.when(s >= 7, "pos").when(s >= 5, "neu").when(s >= 3, "neg").when(s.isNotNull(), "crit")


def clamp_score(score: Column | str) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(10), _c(score).cast("int")))


def check_evidence(quotes: Column | str, text: Column | str, confidence: Column | str) -> Column:
    """struct(valid array, confidence): quotes whose first 70 characters are in the text, in lower case.

    No quote, or one that is missing or empty, makes the confidence low; else the given one, or medium.
    """
    quotes, text = F.coalesce(_c(quotes), F.array().cast("array<string>")), F.lower(F.coalesce(_c(text), F.lit("")))
    valid = F.filter(quotes, lambda q: q.isNotNull() & (q != "") & text.contains(F.substring(F.lower(q), 1, 70)))
    level = F.when((F.size(quotes) == 0) | (F.size(valid) < F.size(quotes)), "low").otherwise(F.coalesce(_c(confidence), F.lit("medium")))
    return F.struct(valid.alias("valid"), level.alias("confidence"))


def token_cost(tokens_in: Column | str, tokens_out: Column | str, price_in: float = 1.0, price_out: float = 5.0) -> Column:
    """Cost of a scorer call, prices per million tokens, 6 decimal places."""
    return F.bround(_c(tokens_in) / 1e6 * price_in + _c(tokens_out) / 1e6 * price_out, 6)
