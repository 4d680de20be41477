"""Article fields from HTML."""

from __future__ import annotations

import html as references
import json
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import MapType, StringType

# Types and tags that carry an article's fields, and elements that are not part of its text.
ARTICLE_TYPES = ("Article", "NewsArticle", "BlogPosting", "Report")
META_KEYS = {
    "published": ("article:published_time", "publishdate", "date"),
    "modified": ("article:modified_time",),
    "title": ("og:title", "twitter:title"),
    "summary": ("og:description", "twitter:description", "description"),
    "cover": ("og:image", "og:image:secure_url", "twitter:image"),
    "author": ("article:author", "author"),
}
LEFT_OUT = ("script", "style", "nav", "footer", "aside")


@pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """All named and numbered character references; Spark has no such function."""
    return text.map(lambda t: None if t is None else references.unescape(t))


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in double or single quotes or without; null if it has none."""
    found = lambda value: F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*{value}", 1)
    has = lambda value: tag.rlike(rf"(?is)[\s\"'/]{name}\s*=\s*{value}")
    double, single, bare = '"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)"
    return F.when(has(double), found(double)).when(has(single), found(single)).when(has(bare), found(bare))


def meta_tags(page: Column | str) -> Column:
    """array<struct<key, said>> of a page's meta tags that name a property: in order, keys in lower case, blank ones left out."""
    tags = F.regexp_extract_all(page, F.lit(r"(?i)<meta\s[^>]*>"), F.lit(0))
    parsed = F.transform(tags, lambda t: F.struct(F.lower(F.coalesce(attribute(t, "property"), attribute(t, "name"))).alias("key"), F.trim(attribute(t, "content")).alias("said")))
    return F.filter(parsed, lambda x: x["key"].isNotNull() & (x["said"] != ""))


def first_said(tags: Column, *keys: str) -> Column:
    """What the first of the keys that is there says."""

    def of(key: str) -> Column:
        return F.get(F.filter(tags, lambda x: x["key"] == key.lower()), 0)["said"]

    return F.coalesce(*map(of, keys))


def meta(page: Column | str, *keys: str) -> Column:
    """The content of the first key that some meta tag states, attributes in any order; references decoded."""
    return F.trim(unescape(first_said(meta_tags(page), *keys)))


def _structured(page: str) -> Iterator[dict]:
    """JSON-LD objects of a page, in order; lists and graphs are opened, broken blocks passed over."""
    for part in re.split(r"<script(?=\s)", page, flags=re.I)[1:]:
        head, _, rest = part.partition(">")
        kind = re.search(r"\btype\s*=\s*[\"']?\s*([^\"'\s>]+)", head, re.I)
        if not kind or kind[1].lower() != "application/ld+json":
            continue
        end = re.search(r"</script", rest, re.I)
        said = "".join(c for c in rest[: end.start() if end else 0] if c >= " " or c in "\t\n\r")
        try:
            waiting = deque([json.loads(said)])
        except ValueError:
            continue
        while waiting:
            node = waiting.popleft()
            if isinstance(node, list):
                waiting.extendleft(reversed(node))
            elif isinstance(node, dict) and "@graph" in node:
                waiting.appendleft(node["@graph"])
            elif isinstance(node, dict):
                yield node


def _is_article(node: dict) -> bool:
    kinds = node.get("@type")
    return any(str(k).endswith(ARTICLE_TYPES) for k in (kinds if isinstance(kinds, list) else [kinds]))


def _named(value, key: str):
    """A value given as itself, as an object with a key, or as a list of either."""
    while isinstance(value, list) and value:
        value = value[0]
    return value.get(key) if isinstance(value, dict) else value


def stated_fields(page: str | None) -> dict[str, str | None]:
    """Fields of the first article node: what it leaves out is stated as null, but for cover and author."""
    node = next(filter(_is_article, _structured(page or "")), None)
    if node is None:
        return {}
    out = {"published": node.get("datePublished") or node.get("dateCreated"), "modified": node.get("dateModified"), "title": node.get("headline"), "summary": node.get("description")}
    out |= {k: v for k, v in (("cover", _named(node.get("image"), "url")), ("author", _named(node.get("author"), "name"))) if v}
    return {k: None if v is None else str(v) for k, v in out.items()}


@pandas_udf(MapType(StringType(), StringType()))
def json_ld(page: pd.Series) -> pd.Series:
    return page.map(stated_fields)


def visible_text(page: str | None, most: int) -> str | None:
    """The first ``most`` characters of a page's article (of all, if it has none), one space between words.

    One pass over the tags. Elements of LEFT_OUT are skipped to their own
    closing tag, tags are spaces, references are decoded last.
    """
    if page is None:
        return None
    lower, at, out, inside = page.lower(), 0, [], None
    if len(lower) != len(page):  # letters whose lower case is longer
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)
    while (tag := lower.find("<", at)) >= 0:
        end = lower.find(">", tag + 1)
        if end < 0 or end == tag + 1:
            out.append(page[at : tag + 1])
            at = tag + 1
            continue
        out.append(page[at:tag])
        name = next((x for x in LEFT_OUT if lower.startswith(x, tag + 1)), None)
        closing = lower.find(f"</{name}>", end) if name else -1
        if closing >= 0:
            end = closing + len(name) + 2
        elif lower.startswith("article", tag + 1) and inside is None and lower.find("</article>", end) >= 0:
            inside, out = True, []
        elif lower.startswith("/article>", tag + 1) and inside:
            at = len(page)
            break
        out.append(" ")
        at = end + 1
    out.append(page[at:])
    return " ".join(references.unescape("".join(out)).split())[:most]


def body_text(page: Column | str, most: int = 12_000) -> Column:
    """The article's text. The limit is the field's own: it holds what evidence is checked against."""

    @pandas_udf(StringType())
    def cut(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: visible_text(p, most))

    return cut(page)


def absolute(base: Column | str, link: Column | str) -> Column:
    """link against base: absolute, scheme-relative, root-relative and relative ones."""
    base, link = (F.col(x) if isinstance(x, str) else x for x in (base, link))
    site = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^?#]*/)", 1)
    folder = F.when(F.length(folder) > F.length(site), folder).otherwise(F.concat(site, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][\w+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][\w+.-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(folder, link))
    )


def article_fields(page: Column | str, url: Column | str) -> Column:
    """struct of published, modified, title, summary, cover, author and body.

    JSON-LD first, then meta tags. A date, title or summary that the JSON-LD
    node has as null, or leaves out, blocks its meta tag; image and author fall
    back. A quotation mark of the other kind does not end an attribute.
    """
    ld, tags = json_ld(page), meta_tags(page)
    said = {k: F.when(F.map_contains_key(ld, k), F.try_element_at(ld, F.lit(k))).otherwise(F.trim(unescape(first_said(tags, *keys)))) for k, keys in META_KEYS.items()}
    value = {k: F.nullif(v, F.lit("")) for k, v in said.items()}
    value["cover"] = absolute(url, value["cover"])
    return F.struct(*(v.alias(k) for k, v in value.items()), F.nullif(body_text(page), F.lit("")).alias("body"))
