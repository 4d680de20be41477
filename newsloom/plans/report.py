"""Reports over scored mentions: counts, means, series, summaries, notes and the payload.

``items``: id, title, outlet, published, published_precision, score (null:
not scored) and, where named, replicas and topics. ``as_of`` is a date; no
query reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean2(score: Column | str) -> Column:
    return F.bround(F.avg(score), 2)


def favourable(score: Column | str) -> Column:
    """Whole percent of scores of 5 or more among scored ones; null without any."""
    s = F.col(score) if isinstance(score, str) else score
    return F.bround(100 * F.count_if(s >= 5) / F.nullif(F.count(s), F.lit(0)), 0).cast("bigint")


def status_counts(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("mentions"), F.count("cover_hash").alias("with_cover"), F.count_if(F.col("published_precision") == "exact").alias("exact_date"), F.count("score").alias("scored"))


def kpis(items: DataFrame) -> DataFrame:
    s = F.col("score")
    return items.agg(F.count("*").alias("mentions"), mean2("score").alias("mean_score"), favourable("score").alias("favourable_pct"), F.count_if(s <= 4).alias("critical"), F.count(s).alias("scored"), F.count_if(s.isNull()).alias("pending"))


def outlet_ranking(items: DataFrame, outlets: DataFrame, top: int = 8) -> DataFrame:
    """The outlets with most mentions: count, mean score to one place, type."""
    by = items.groupBy("outlet").agg(F.count("*").alias("n"), F.round(F.avg("score"), 1).alias("mean_score"))
    joined = by.join(outlets, by.outlet == outlets.domain).select("outlet", "type", "n", "mean_score")
    return joined.orderBy(F.desc("n"), "outlet").limit(top)


def period(items: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """(first, last) day of the series: last is the latest day or as_of, first at most ``days`` before."""
    day = F.to_date("published")
    bounds = items.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    last = F.coalesce(F.greatest("high", as_of), as_of)
    return bounds.select(F.greatest(F.coalesce("low", F.date_sub(as_of, 29)), F.date_sub(last, days - 1)).alias("first"), last.alias("last"))


def daily_series(items: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """One row per day without gaps: mentions and mean score, null where nothing is scored."""
    spine = period(items, as_of, days).select(F.explode(F.sequence("first", "last")).alias("day"))
    by = items.where("published IS NOT NULL").groupBy(F.to_date("published").alias("day")).agg(F.count("*").alias("n"), mean2("score").alias("mean_score"))
    return spine.join(by, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"), "mean_score")


def within(items: DataFrame, first: Column, last: Column) -> DataFrame:
    return items.where(F.to_date("published").between(first, last))


def summary(items: DataFrame, last: Column, days: int) -> DataFrame:
    """Count, mean, favourable percent, the four most republished ids and the worst critical one of a period."""
    own = within(items, F.date_sub(last, days - 1), last)
    totals = own.agg(F.count("*").alias("mentions"), mean2("score").alias("mean_score"), favourable("score").alias("favourable_pct"), F.min_by(F.when(F.col("score") <= 4, F.col("id")), F.when(F.col("score") <= 4, F.struct("score", -F.unix_micros("published"), "id"))).alias("attention"))
    best = highlights(own).agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("h")).select(F.transform("h", lambda x: x["id"]).alias("highlights"))
    return totals.crossJoin(F.broadcast(best))  # one row each


def highlights(items: DataFrame, top: int = 4) -> DataFrame:
    """(place, id) of the most republished mentions, earliest first among equals."""
    found = items.orderBy(F.desc(F.coalesce(F.nullif("replicas", F.lit(0)), F.lit(1))), "published", "id").limit(top)
    from pyspark.sql import Window

    w = Window.orderBy(F.desc(F.coalesce(F.nullif("replicas", F.lit(0)), F.lit(1))), "published", "id")  # ``top`` rows
    return found.select(F.row_number().over(w).alias("place"), "id")


def official_share(items: DataFrame, outlets: DataFrame) -> DataFrame:
    joined = items.join(outlets, items.outlet == outlets.domain, "left")
    n = F.count_if(F.col("type") == "official")
    return joined.agg(n.alias("official"), F.count("*").alias("mentions"), F.bround(100 * n / F.nullif(F.count("*"), F.lit(0)), 0).cast("bigint").alias("pct"))


def discards(items: DataFrame) -> DataFrame:
    """Discarded rows by kind of reason."""
    gone = items.where("state = 'discarded'")
    return gone.agg(F.count_if(F.col("discard_reason").startswith("relev")).alias("noise"), F.count_if(F.col("discard_reason") == "off topic").alias("off_topic"), F.count("*").alias("discarded"))


def top_stories(rolled: DataFrame, top: int = 5) -> DataFrame:
    """The stories with most re-publications, more than one each."""
    return rolled.where("n_mentions > 1").orderBy(F.desc("n_mentions"), "story_id").limit(top).select("story_id", "canonical_title", "n_mentions")


def origin_counts(assessments: DataFrame) -> DataFrame:
    """Assessments given by hand, and all."""
    return assessments.agg(F.count_if(F.col("origin") == "human").alias("human"), F.count("*").alias("assessments"))


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that failed or came back in part."""
    return runs.agg(F.count_if(F.col("status").isin("failed", "partial")).alias("failed_runs"))


def state_report(items: DataFrame, outlets: DataFrame, rolled: DataFrame) -> dict[str, DataFrame]:
    """The engine's state: counts of the wall, all rows by state, the largest outlets and stories."""
    wall = items.where("state <> 'discarded'")
    return {
        "counts": status_counts(wall).crossJoin(items.agg(F.count("*").alias("scanned"))).crossJoin(rolled.agg(F.count("*").alias("stories"))),
        "states": items.groupBy("state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "state"),
        "outlets": outlet_ranking(wall, outlets),
        "stories": top_stories(rolled),
    }


def wall_view(mentions: DataFrame, membership: DataFrame, assessments: DataFrame, covers: DataFrame) -> DataFrame:
    """Mentions of the wall with their story's size, current assessment and cover's preview, newest first.

    membership: id, story_id; assessments: id, score, reason, polarity, by the
    mention's pointer; covers: hash, preview. All three may lack a row.
    """
    sizes = membership.groupBy("story_id").agg(F.count("*").alias("replicas"))
    story = membership.join(sizes, "story_id")
    a = assessments.select(F.col("id").alias("assessment_id"), "score", "reason", "polarity")
    c = covers.select(F.col("hash").alias("cover_hash"), "preview")
    joined = mentions.where("state <> 'discarded'").join(story, "id", "left").join(a, "assessment_id", "left").join(c, "cover_hash", "left")
    return joined.orderBy(F.desc("published"), "id")


def goal(items: DataFrame, least: int = 75) -> DataFrame:
    """The favourable percent and whether it meets the goal; null without scores."""
    return kpis(items).select("favourable_pct", (F.col("favourable_pct") >= least).alias("met"))


def story_facts(membership: DataFrame, topics: DataFrame, reach: DataFrame) -> DataFrame:
    """Of each story, the topic with most confidence over its mentions and the reach of their outlets. An extension.

    topics: id, topic, confidence; reach: id, reach (null: not known). Ties
    go to the first topic by name; a story without topics has a null one.
    """
    sums = membership.join(topics, "id").groupBy("story_id", "topic").agg(F.sum("confidence").alias("c"))
    main = sums.groupBy("story_id").agg(F.min_by("topic", F.struct(-F.col("c"), "topic")).alias("main_topic"))
    total = membership.join(reach, "id", "left").groupBy("story_id").agg(F.sum("reach").alias("summed_reach"))
    return total.join(main, "story_id", "left").select("story_id", "main_topic", "summed_reach")


def latest_rubric(rubrics: DataFrame) -> DataFrame:
    """The rubric of the greatest id."""
    return rubrics.agg(F.max_by(F.struct("version", "title", "model"), "id").alias("r")).where("r IS NOT NULL").select("r.*")


def active_topics(topics: DataFrame) -> DataFrame:
    """Active topics in their configured order."""
    return topics.where("active").orderBy("position", "slug")


def failed_hosts(runs: DataFrame) -> DataFrame:
    """Sorted hosts of failed feeds, from the runs' JSON parameters, as one text."""
    host = F.regexp_extract(F.get_json_object("params", "$.feed"), r"^(?:[^/]*//)?([^/]+)", 1)
    return runs.where("status = 'failed'").agg(F.array_join(F.sort_array(F.collect_set(F.nullif(host, F.lit("")))), ", ").alias("hosts"))


def collectors_line(runs: DataFrame) -> DataFrame:
    """Run counts by collector as "name (n); name (n)", most first."""
    by = runs.groupBy("collector").agg(F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "collector", "n")))
    return by.agg(F.array_join(F.transform(parts, lambda x: F.concat(x["collector"], F.lit(" ("), x["n"].cast("string"), F.lit(")"))), "; ").alias("collectors"))


def method_notes(facts: DataFrame) -> DataFrame:
    """Sentences that the numbers call for, as one array.

    facts: one row of noise, off_topic, failed_runs, approximate, mentions,
    scored, official (counts).
    """
    c = F.col
    pct = F.bround(100 * c("official") / F.nullif(c("mentions"), F.lit(0)), 0).cast("bigint")
    notes = F.array(
        F.format_string("%d scanned items were left out as noise.", c("noise")),
        F.format_string("%d items are relevant but off topic.", c("off_topic")),
        F.when(c("failed_runs") > 0, F.format_string("%d collection runs failed or were partial.", c("failed_runs"))),
        F.when(c("approximate") > 0, F.format_string("%d mentions have an approximate date.", c("approximate"))),
        F.when(c("scored") == 0, F.lit("No mention is scored yet.")).when(c("mentions") > c("scored"), F.format_string("%d of %d mentions have no score; means cover the %d scored ones.", c("mentions") - c("scored"), c("mentions"), c("scored"))),
        F.when((c("official") > 0) & (c("mentions") > 0), F.format_string("%d of %d mentions (%d%%) are the client's own publications.", c("official"), c("mentions"), pct)),
    )
    return facts.select(F.filter(notes, lambda x: x.isNotNull()).alias("notes"))


def short_items(items: DataFrame) -> DataFrame:
    """Items under the payload's short keys: id, t, v, d, p, n, r, e."""
    return items.select("id", F.col("title").alias("t"), F.col("outlet").alias("v"), F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("d"), F.col("published_precision").alias("p"), F.col("score").alias("n"), F.coalesce(F.nullif("replicas", F.lit(0)), F.lit(1)).alias("r"), F.col("topics").alias("e"))


def payload_head(items: DataFrame, outlets: DataFrame, as_of: Column) -> DataFrame:
    """The published document without its items: one row of kpi, days, outlets, week and month, each a few rows large."""
    series = daily_series(items, as_of).agg(F.array_sort(F.collect_list(F.struct("day", "n", "mean_score"))).alias("days"))
    used = outlets.join(items.select(F.col("outlet").alias("domain")).distinct(), "domain", "left_semi").agg(F.array_sort(F.collect_list(F.struct("domain", "type"))).alias("outlets"))
    whole = kpis(items).select(F.struct("*").alias("kpi"))
    last = period(items, as_of).first()["last"]
    week, month = (summary(items, F.lit(last), n).select(F.struct("*").alias(name)) for n, name in ((7, "week"), (30, "month")))
    for part in (series, used, week, month):
        whole = whole.crossJoin(F.broadcast(part))  # one row each
    return whole


def payload(items: DataFrame, outlets: DataFrame, as_of: Column) -> DataFrame:
    """The published document with all items in it: one row with one JSON text.

    A reader loads it whole, so it is for walls of a browser's size; ``publish``
    writes items of any number beside a small document.
    """
    short = short_items(items).select(F.struct("*").alias("x"))
    held = short.agg(F.reverse(F.array_sort(F.collect_list(F.struct("x.d", "x.id", "x")))).alias("l")).select(F.transform("l", lambda r: r["x"]).alias("items"))
    return payload_head(items, outlets, as_of).crossJoin(F.broadcast(held)).select(F.to_json(F.struct("kpi", "days", "outlets", "week", "month", "items")).alias("payload"))


def publish(items: DataFrame, outlets: DataFrame, as_of: Column, path: str) -> None:
    """The document's head as one JSON file below ``path``/head, its items as JSON lines, newest first, below ``path``/items."""
    payload_head(items, outlets, as_of).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/head")
    short_items(items).orderBy(F.desc("d"), "id").write.mode("overwrite").json(f"{path}/items")


# Declared by the data model, computed nowhere before: extensions.


def calibration(pairs: DataFrame) -> DataFrame:
    """Mean absolute error, polarity accuracy and Cohen's kappa of (gold, model) scores."""
    from newsloom.functions.scoring import polarity

    p = pairs.select("gold", "model", polarity("gold").alias("g"), polarity("model").alias("m"))
    base = p.agg(F.count("*").alias("n"), F.avg(F.abs(F.col("gold") - F.col("model"))).alias("mae"), F.avg((F.col("g") == F.col("m")).cast("double")).alias("accuracy"), *(F.avg((F.col(s) == k).cast("double")).alias(f"{s}_{k}") for s in "gm" for k in ("positive", "neutral", "negative")))
    chance = sum((F.col(f"g_{k}") * F.col(f"m_{k}") for k in ("positive", "neutral", "negative")), F.lit(0.0))
    return base.select("n", F.round("mae", 6).alias("mae"), F.round("accuracy", 6).alias("accuracy"), F.round((F.col("accuracy") - chance) / F.nullif(1 - chance, F.lit(0.0)), 6).alias("kappa"), ((F.col("mae") <= 1.0) & (F.col("accuracy") >= 0.8)).alias("accepted"))


def conflicting_numbers(numbers: DataFrame) -> DataFrame:
    """Indicators quoted with different values."""
    return numbers.groupBy("indicator").agg(F.count_distinct("value").alias("values"), F.min("value").alias("low"), F.max("value").alias("high")).where(F.col("values") > 1)


def metric_as_of(metrics: DataFrame, key: str, at: str, value: str, cutoff: Column) -> DataFrame:
    """Each key's last value at or before the cutoff."""
    return metrics.where(F.col(at) <= cutoff).groupBy(key).agg(F.max_by(value, at).alias(value), F.max(at).alias(at))


def term_occurrences(items: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, term, occurrences) of tracked terms as whole words in title and summary."""
    text = F.lower(F.concat_ws(" ", "title", "summary"))
    n = F.size(F.filter(F.split(F.regexp_replace("_text", "[^\\p{L}\\p{N}]+", " "), " "), lambda w: w == F.lower(F.col("term"))))
    found = items.select("id", text.alias("_text")).crossJoin(F.broadcast(terms.select("term")))  # a short configured list
    return found.select("id", "term", n.alias("occurrences")).where("occurrences > 0")


def edition(items: DataFrame, width: int = 1000) -> DataFrame:
    """(n, hash) of a frozen edition: a tree of sha256 over its rows in id order.

    A row's hash is of id and score; the hashes of each run of ``width`` ids
    are hashed together, then those of each run of as many runs, and so on
    until one is left. So no task holds more than ``width`` hashes at a time.
    Ids are unique; an empty edition hashes the empty text.
    """
    level = items.select("id", F.sha2(F.concat_ws("|", "id", F.coalesce(F.col("score").cast("string"), F.lit("-"))), 256).alias("h"))
    n = level.agg(F.count("*").alias("n"))
    for _ in range(6):  # width^6 covers all ids of any use
        level = level.groupBy(F.expr(f"id div {width}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("id", "h"))).alias("l"))
        level = level.select(F.col("run").alias("id"), F.sha2(F.array_join(F.transform("l", lambda x: x["h"]), ""), 256).alias("h"))
    top = level.agg(F.array_sort(F.collect_list(F.struct("id", "h"))).alias("l"))  # ids beyond width^6, and a negative run
    return n.crossJoin(F.broadcast(top.select(F.sha2(F.array_join(F.transform("l", lambda x: x["h"]), ""), 256).alias("hash"))))


def alerts(items: DataFrame, topics: DataFrame, topic: str, most: int = 5) -> DataFrame:
    """Mentions of a sensitive topic scored ``most`` or less."""
    hit = topics.where(F.col("topic") == topic).select("id").distinct()
    return items.where(F.col("score") <= most).join(hit, "id", "left_semi").select("id", "score", F.lit("critical").alias("level"))


def valid_terms(terms: DataFrame, first: Column, last: Column) -> DataFrame:
    """Terms whose validity overlaps the period; an open end is valid on."""
    return terms.where((F.col("valid_from") <= last) & (F.col("valid_to").isNull() | (F.col("valid_to") >= first)))
