"""Column functions over titles and URLs. No UDFs."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track where a reader came from.
TRACKING_KEYS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id",
    "fbclid", "gclid", "gbraid", "wbraid", "msclkid", "igshid", "mc_cid", "mc_eid",
    "ref", "referrer", "amp", "outputType", "_ga", "s_cid", "xtor",
]

# Words that a title comparison leaves out.
STOP_WORDS = [
    "a", "o", "as", "os", "de", "da", "do", "das", "dos", "e", "em", "no", "na", "nos", "nas",
    "um", "uma", "para", "por", "com", "que", "ao", "aos", "se", "the", "of", "to", "in", "on", "at",
]

# Words of a URL path that say nothing about its article.
GENERIC_PATH_WORDS = ["materia", "noticia", "noticias", "html", "index", "cidades", "geral", "www"]


@lru_cache
def _accent_table() -> tuple[str, str]:
    """Lower-case letters that decompose to one base letter and marks, and those letters."""
    pairs = []
    for code in [*range(0xC0, 0x530), *range(0x1E00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(code))
        base = [c for c in parts if unicodedata.category(c) != "Mn"]
        if len(parts) > 1 and len(base) == 1:
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: Column | str) -> Column:
    """Lower case without accents, precomposed or combining."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(F.lower(c), *_accent_table()), "\\p{Mn}+", "")


def folded(text: str) -> str:
    """fold of a literal."""
    return "".join(x for x in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(x) != "Mn")


def title_tokens(title: Column | str) -> Column:
    """Folded words of two characters or more, stop words left out; null title: none."""
    title = F.col(title) if isinstance(title, str) else title
    words = F.regexp_extract_all(fold(F.coalesce(title, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(STOP_WORDS))


def _part(url: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(url, pattern, group)


# scheme, authority, path, query, fragment
_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def host_of(url: Column | str) -> Column:
    """Lower-case authority without a leading www. (port and user info stay)."""
    url = F.col(url) if isinstance(url, str) else url
    return F.regexp_replace(F.lower(_part(F.trim(url), _URL, 2)), "^www\\.", "")


def canonical_url(url: Column | str) -> Column:
    """A comparable URL.

    https; host in lower case without www. and port; an /amp or /amp.html end
    and trailing slashes go; tracking keys and blank values go, other pairs are
    sorted and encoded anew; no fragment. A slash after /amp keeps the /amp,
    and the key outputType stays, being looked up in lower case.
    """
    url = F.trim(F.col(url) if isinstance(url, str) else url)
    host = F.split(host_of(url), ":")[0]
    path = F.regexp_replace(F.regexp_replace(_part(url, _URL, 3), "/(amp|amp\\.html)$", ""), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    pairs = F.filter(F.split(_part(url, _URL, 4), "&"), lambda p: p.contains("=") & (F.regexp_extract(p, "=(.*)$", 1) != ""))

    def decoded(x: Column) -> Column:
        return F.coalesce(F.call_function("try_url_decode", x), x)

    split = F.transform(pairs, lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), decoded(F.regexp_extract(p, "=(.*)$", 1)).alias("v")))
    kept = F.array_sort(F.filter(split, lambda s: ~F.lower(s["k"]).isin([k for k in TRACKING_KEYS if k == k.lower()])))

    def encoded(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    query = F.array_join(F.transform(kept, lambda s: F.concat(encoded(s["k"]), F.lit("="), encoded(s["v"]))), "&")
    return F.concat(F.lit("https://"), host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def plausible_url(title: Column | str, url: Column | str) -> Column:
    """Whether a resolved URL may belong to a title: of three informative path words or more, one is in it."""
    url = F.col(url) if isinstance(url, str) else url
    words = F.array_distinct(F.split(F.lower(_part(url, _URL, 3)), "[^a-z0-9]+"))
    words = F.filter(words, lambda w: (F.length(w) > 3) & ~w.rlike("^[0-9]+$") & ~w.isin(GENERIC_PATH_WORDS))
    return (F.size(words) < 3) | F.arrays_overlap(words, title_tokens(title))


def last_segment(url: Column | str) -> Column:
    """What follows the last slash, without the query."""
    return F.substring_index(F.regexp_extract(url, "([^/]*)$", 1), "?", 1)


def without_suffix(title: Column | str, outlet: Column | str) -> Column:
    """A feed title without its closing " - Outlet"."""
    title, outlet = (F.col(x) if isinstance(x, str) else x for x in (title, outlet))
    end = F.concat(F.lit(" - "), outlet)
    cut = F.trim(F.substring(title, F.lit(1), F.length(title) - F.length(end)))
    return F.when(F.endswith(title, end), cut).otherwise(title)


def jaccard(a: Column, b: Column, least: int = 3) -> Column:
    """Shared share of two word arrays as sets; 0 below ``least`` common words."""
    common = F.size(F.array_intersect(a, b))
    return F.when(common < least, F.lit(0.0)).otherwise(common / F.size(F.array_union(a, b)))


def weighted_jaccard(a: Column, b: Column, weights: Column, least: int = 3) -> Column:
    """As jaccard, words weighing as the map ``weights`` has it, others 1."""

    def weigh(words: Column) -> Column:
        return F.aggregate(words, F.lit(0.0), lambda total, w: total + F.coalesce(F.try_element_at(weights, w), F.lit(1.0)))

    return F.when(F.size(F.array_intersect(a, b)) < least, F.lit(0.0)).otherwise(weigh(F.array_intersect(a, b)) / weigh(F.array_union(a, b)))
