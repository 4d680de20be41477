"""Feed documents to normalised rows, with built-in functions alone.

Feeds are cut at tags, not parsed as XML, so that a broken item costs itself
alone and never its feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_date
from newsloom.functions.html import attribute, unescape
from newsloom.functions.text import host_of, last_segment, without_suffix


def _elements(xml: Column | str, tag: str) -> Column:
    """The insides of all elements of a tag: what stands before each closing tag and after the opening one nearest to it."""
    before = F.split(xml, rf"</{tag}\s*>")
    before = F.slice(before, 1, F.greatest(F.size(before) - 1, F.lit(0)))
    opened = F.filter(before, lambda b: b.rlike(rf"<{tag}[\s>]"))
    return F.transform(opened, lambda b: F.element_at(F.split(b, rf"<{tag}(?:\s[^>]*)?>"), -1))


def _said(block: Column, tag: str) -> Column:
    """The text of a block's first element of a tag, CDATA marks taken off and references decoded; blank: null."""
    inside = F.get(_elements(block, tag), 0)
    bare = F.replace(F.replace(inside, F.lit("<![CDATA[")), F.lit("]]>"))
    return F.nullif(F.trim(unescape(bare)), F.lit(""))


def _tags(block: Column, tag: str) -> Column:
    return F.regexp_extract_all(block, F.lit(rf"<{tag}\s[^>]*>"), F.lit(0))


def search_feed(feeds: DataFrame, xml: str = "xml", expression: str = "expression") -> DataFrame:
    """One row per <item> with title and link of a search feed.

    The outlet's name is cut from the title's end; gid is the link's last path
    part; dates are of the index and so approximate.
    """
    items = feeds.select(expression, F.explode(_elements(xml, "item")).alias("_b"))
    b = F.col("_b")
    named = items.select(
        expression,
        _said(b, "title").alias("_t"),
        _said(b, "link").alias("feed_url"),
        parse_date(_said(b, "pubDate"))["at"].alias("published"),
        F.nullif(host_of(attribute(F.get(_tags(b, "source"), 0), "url")), F.lit("")).alias("outlet_domain"),
        _said(b, "source").alias("outlet_name"),
    ).where("_t IS NOT NULL AND feed_url IS NOT NULL")
    title = F.coalesce(without_suffix("_t", "outlet_name"), F.col("_t"))
    return named.select(title.alias("title"), last_segment("feed_url").alias("gid"), "feed_url", "published", F.lit("approximate").alias("published_precision"), "outlet_domain", "outlet_name", F.lit("search").alias("collector"), expression)


def native_feed(feeds: DataFrame, xml: str = "xml", url: str = "feed_url") -> DataFrame:
    """One row per RSS <item>, or Atom <entry> where there is none, of an outlet's own feed.

    The link is a <link> element that holds an address, else the first <link>
    whose href does.
    """
    blocks, entries = _elements(xml, "item"), _elements(xml, "entry")
    items = feeds.select(url, F.explode(F.when(F.size(blocks) > 0, blocks).otherwise(entries)).alias("_b"))
    b = F.col("_b")
    address = lambda x: F.when(x.rlike("^https?://"), x)
    held = F.filter(F.transform(_tags(b, "link"), lambda t: address(attribute(t, "href"))), lambda x: x.isNotNull())
    link = F.coalesce(address(_said(b, "link")), F.trim(unescape(F.get(held, 0))))
    at = parse_date(F.coalesce(_said(b, "pubDate"), _said(b, "published"), _said(b, "updated")))
    named = items.select(_said(b, "title").alias("title"), link.alias("url"), at["at"].alias("published"), at["precision"].alias("published_precision"), host_of(url).alias("outlet_domain"), F.lit("native").alias("collector"), F.col(url).alias("expression"))
    return named.where("title IS NOT NULL AND url IS NOT NULL").withColumn("gid", F.col("url"))


def resolver_reply(replies: DataFrame, text: str = "reply") -> DataFrame:
    """(batch, index, url) of a batch reply, whose envelopes come in any order and carry their 1-based index.

    An envelope is a JSON array after its mark: a name, a JSON text whose
    second value is the address, nulls, and the index as text. Each is read by
    itself, so that a broken one costs no other.
    """
    parts = F.split(text, r'\["wrb\.fr",')
    envelopes = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.from_json(F.concat(F.lit("["), p), "array<string>"))
    rows = replies.select("batch", F.explode(envelopes).alias("e"))
    url = F.get(F.from_json(F.get("e", 1), "array<string>"), 1)
    return rows.select("batch", F.get("e", 5).try_cast("int").alias("index"), url.alias("url")).where(F.col("url").startswith("http") & (F.col("index") >= 1))


def attach_resolved(requests: DataFrame, resolved: DataFrame) -> DataFrame:
    """Requests (batch, index, gid, title) with their URL, matched by index; implausible ones go to suspect_url."""
    from newsloom.functions.text import plausible_url

    joined = requests.join(resolved, ["batch", "index"], "left")
    good = plausible_url("title", "url")
    return joined.withColumn("suspect_url", F.when(F.col("url").isNotNull() & ~good, F.col("url"))).withColumn("url", F.when(good, F.col("url")))
