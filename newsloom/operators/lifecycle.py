"""State changes of mentions and dimensions: each a function from old rows to new ones.

Parquet tables take no UPDATE or MERGE, so a change is a join and a new
version of the table, written to another path than the one it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import scoring
from newsloom.operators.dedupe import hard_dedupe, new_only, with_dedupe_hash
from newsloom.operators.stories import latest_per

OFF_TOPIC, NOISE = "off topic", "relevance below cut"
NO_URL, SUSPECT_URL = "url not resolved", "url does not fit the title"


def upsert(old: DataFrame, new: DataFrame, key: str, update: list[str]) -> DataFrame:
    """Rows of both; of common keys the listed columns come from new where it has them, the others stay."""
    o, n = old.alias("o"), new.alias("n")
    there = F.col(f"n.{key}").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c in update:
            return F.when(there, F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))).otherwise(F.col(f"o.{c}"))
        return F.when(F.col(f"o.{key}").isNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(*(value(c).alias(c) for c in old.columns))


def insert_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those rows of new whose keys it lacks."""
    return old.unionByName(new_only(new.dropDuplicates(keys), old, keys), allowMissingColumns=True)


def stable_id(*columns: str) -> Column:
    """A surrogate key that is the same whenever the natural key is."""
    return F.xxhash64(*columns)


def with_outlets(outlets: DataFrame, items: DataFrame, domain: str = "outlet_domain") -> DataFrame:
    """The outlet dimension with domains that it lacks, as portals of weight 0.5."""
    found = items.where(F.col(domain).isNotNull()).select(F.col(domain).alias("domain")).distinct()
    fresh = found.select(stable_id("domain").alias("id"), "domain", F.col("domain").alias("name"), F.lit("portal").alias("type"), F.lit(0.5).alias("weight"))
    return insert_new(outlets, fresh, ["domain"])


def ingest(raw: DataFrame, stored: DataFrame, required: list[str], penalised: list[str], cut: float = 0.35, channel: str = "press") -> DataFrame:
    """Rows of a collection, each with an outcome: new, repeated, noise or no-url.

    The cheap relevance cut comes before anything that costs; rows under it,
    and rows whose address is not known or does not fit (suspect_url), are kept
    as discarded, with the reason. raw: gid, title, url, ...; stored: channel,
    dedupe_hash. Discards are identified by their gid. Of rows with one hash
    the first counts, by _order, gid and place (those that are there).
    """
    text = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    scored = raw.withColumn("channel", F.lit(channel)).withColumn("relevance", scoring.relevance("title", text("summary"), required, penalised))
    hashed = with_dedupe_hash(scored)
    noise, missing = F.col("relevance") < cut, F.col("url").isNull()
    reason = F.when(noise, NOISE).when(missing, F.when(text("suspect_url").isNotNull(), SUSPECT_URL).otherwise(NO_URL))
    hashed = hashed.withColumns({"discard_reason": reason, "state": F.when(reason.isNotNull(), "discarded").otherwise("raw"), "dedupe_hash": F.when(reason.isNotNull(), F.sha1(F.concat(F.lit("search:"), F.col("gid")).cast("binary"))).otherwise(F.col("dedupe_hash"))})
    first = hard_dedupe(hashed, ["channel", "dedupe_hash"], [c for c in ("_order", "gid", "place") if c in raw.columns])
    known = stored.select("channel", "dedupe_hash").distinct().withColumn("_known", F.lit(True))
    told = first.join(known, ["channel", "dedupe_hash"], "left")
    outcome = F.when(F.col("_known"), "repeated").when(F.col("discard_reason") == NOISE, "noise").when(F.col("discard_reason").isNotNull(), "no-url").otherwise("new")
    return told.withColumn("outcome", outcome).drop("_known")


def outcomes(ingested: DataFrame) -> DataFrame:
    """Counters of a collection."""
    return ingested.groupBy("outcome").agg(F.count("*").alias("n"))


def enrich(items: DataFrame, pages: DataFrame, vocabulary: dict[str, list[str]], drop_off_topic: bool = True) -> DataFrame:
    """Items with what their pages say.

    pages: id, error, title, summary, author, cover, published, body. Summary,
    author, cover and date fill what is missing or newer, the body is
    replaced, the precision only rises to exact. Topics come from the item's
    title and the page's own summary, none if it has none; blocked pages are
    tagged by the feed's summary. Without a topic a row is discarded but keeps
    what was extracted.
    """
    p = pages.select(F.col("id").alias("_id"), *(F.col(c).alias(f"_{c}") for c in pages.columns if c != "id"))
    joined = items.join(p, items.id == p._id, "left")
    read = F.col("_id").isNotNull() & F.col("_error").isNull()
    summary = F.coalesce(F.when(read, F.col("_summary")), F.col("summary"))
    tagged = joined.withColumn("_topics", scoring.topics("title", F.when(read, F.col("_summary")).otherwise(F.col("summary")), vocabulary))
    off = F.lit(drop_off_topic) & (F.size("_topics") == 0)
    new = {
        "summary": summary,
        "author": F.coalesce(F.when(read, F.col("_author")), F.col("author")),
        "cover_url": F.coalesce(F.when(read, F.col("_cover")), F.col("cover_url")),
        "published": F.coalesce(F.when(read, F.col("_published")), F.col("published")),
        "published_precision": F.when(read & F.col("_published").isNotNull(), "exact").otherwise(F.col("published_precision")),
        "body": F.when(read, F.col("_body")).otherwise(F.col("body")),
        "state": F.when(F.col("_id").isNull(), F.col("state")).when(off, "discarded").otherwise("enriched"),
        "discard_reason": F.when(F.col("_id").isNull(), F.col("discard_reason")).when(off, OFF_TOPIC),
        "topics": F.when(F.col("_id").isNotNull(), F.col("_topics")),
    }
    kept = [c for c in items.columns if c not in new]
    return tagged.select(*kept, *(v.alias(k) for k, v in new.items()))


def blocked_warnings(items: DataFrame, pages: DataFrame, as_of: Column) -> DataFrame:
    """A log row of each page that could not be read."""
    found = pages.where("error IS NOT NULL").select("id", "error").join(items.select("id", "url"), "id")
    said = F.concat(F.lit("item "), F.col("id").cast("string"), F.lit(" blocked: "), F.col("error"), F.lit(" - "), F.coalesce(F.left("url", F.lit(120)), F.lit("")))
    return found.select(as_of.alias("at"), F.lit("warning").alias("level"), F.lit("enrich").alias("origin"), said.alias("message"))


def retag(items: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """Topics of all rows anew; off-topic discards come back if they have one now, others go."""
    tagged = items.withColumn("topics", scoring.topics("title", "summary", vocabulary))
    topical = (F.col("state") != "discarded") | F.col("discard_reason").eqNullSafe(F.lit(OFF_TOPIC))
    none = F.size("topics") == 0
    state = F.when(topical & none, "discarded").when(topical & (F.col("state") == "discarded"), "enriched").otherwise(F.col("state"))
    reason = F.when(topical & none, OFF_TOPIC).when(topical, F.lit(None)).otherwise(F.col("discard_reason"))
    return tagged.withColumns({"state": state, "discard_reason": reason})


def reset(items: DataFrame) -> DataFrame:
    """Rows back to raw, without what enrichment and scoring gave; off-topic discards come back."""
    back = (F.col("state") != "discarded") | F.col("discard_reason").eqNullSafe(F.lit(OFF_TOPIC))
    clear = [c for c in ("summary", "body", "author", "cover_url", "assessment_id") if c in items.columns]
    out = items.withColumns({c: F.when(back, F.lit(None)).otherwise(F.col(c)).cast(items.schema[c].dataType) for c in clear})
    return out.withColumns({"state": F.when(back, "raw").otherwise(F.col("state")), "discard_reason": F.when(back, F.lit(None).cast("string")).otherwise(F.col("discard_reason"))})


def assess(items: DataFrame, scores: DataFrame, rubric_id: int, as_of: Column, origin: str = "human", clamp: bool = False) -> DataFrame:
    """Assessment rows to append: scores of known items, evidence checked in their text.

    scores: mention_id, score, reason, evidence, confidence. Unknown ids are
    skipped. clamp: bring scores into 0 to 10 (the automatic path); else a
    score outside fails the table's check. A row's id tells item, rubric,
    score, origin and time, so that the same score given again is another row.
    """
    text = F.concat_ws(" ", "title", "summary", "body")
    joined = scores.join(items.select(F.col("id").alias("mention_id"), text.alias("_text")), "mention_id")
    score = scoring.clamp_score("score") if clamp else F.col("score").cast("int")
    checked = joined.withColumn("_e", scoring.check_evidence("evidence", "_text", "confidence")).withColumn("score", score)
    return checked.select(
        F.xxhash64("mention_id", F.lit(rubric_id).cast("bigint"), "score", F.lit(origin), as_of).alias("id"), "mention_id", F.lit(rubric_id).cast("bigint").alias("rubric_id"), "score", scoring.band("score").alias("band"), scoring.polarity("score").alias("polarity"),
        F.substring("reason", 1, 400).alias("reason"), F.col("_e.valid").alias("evidence"), F.col("_e.confidence").alias("confidence"), F.lit(origin).alias("origin"), as_of.alias("created"),
    )


def point_at(items: DataFrame, assessments: DataFrame) -> DataFrame:
    """Items pointing at their latest assessment, in state assessed."""
    last = latest_per(assessments.select("mention_id", "id", "created"), "mention_id", ["created", "id"]).select("mention_id", F.col("id").alias("_new"))
    joined = items.join(last, items.id == last.mention_id, "left")
    has = F.col("_new").isNotNull() & (F.col("state") != "discarded")
    new = {"assessment_id": F.when(has, F.col("_new")).otherwise(F.col("assessment_id")), "state": F.when(has, "assessed").otherwise(F.col("state"))}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in items.columns))


def auto_assess(items: DataFrame, scorer: Callable, rubric_id: int, as_of: Column, limit: int | None = 120) -> tuple[DataFrame, DataFrame]:
    """(assessments to append, counters): a scorer run over the newest unscored items.

    scorer: an iterator of pandas frames (id, title, summary, body) to frames
    (mention_id, score, reason, evidence, confidence, tokens_in, tokens_out,
    error); ``prompt`` makes the texts it may send. The limit is the feature: a run's budget. Counters: ok, failed, cost.
    """
    work = items.where("assessment_id IS NULL AND state IN ('enriched', 'assessed')").orderBy(F.desc("published"), "id")
    work = (work.limit(limit) if limit else work).select("id", "title", "summary", "body")
    told = work.mapInPandas(scorer, "mention_id bigint, score int, reason string, evidence array<string>, confidence string, tokens_in bigint, tokens_out bigint, error string")
    good = told.where("error IS NULL")
    rows = assess(items, good, rubric_id, as_of, origin="auto", clamp=True)
    costs = good.select("mention_id", "tokens_in", "tokens_out", scoring.token_cost("tokens_in", "tokens_out").alias("cost"))
    counters = told.agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum(F.when(F.col("error").isNull(), scoring.token_cost("tokens_in", "tokens_out"))), F.lit(0.0)).alias("cost"))
    return rows.join(costs, "mention_id"), counters


def run_failed(ok: int, failed: int) -> bool:
    """Whether a scoring run counts as failed: nothing succeeded, or most failed."""
    return failed > 0 and (ok == 0 or failed > ok)


def compact(items: DataFrame, as_of: Column, body_days: int = 21) -> DataFrame:
    """Bodies older than ``body_days`` are cleared; undated rows keep theirs."""
    old = F.coalesce(F.col("published") < as_of - F.make_dt_interval(F.lit(body_days)), F.lit(False))
    return items.withColumn("body", F.when(old, F.lit(None).cast("string")).otherwise(F.col("body")))


def orphan_covers(items: DataFrame, as_of: Column, window_days: int = 120) -> DataFrame:
    """Cover hashes that only items older than the window hold."""
    since = as_of - F.make_dt_interval(F.lit(window_days))
    held = items.where("cover_hash IS NOT NULL")
    live = held.where((F.col("published") >= since) | F.col("published").isNull()).select("cover_hash").distinct()
    return held.where(F.col("published") < since).select("cover_hash").distinct().join(live, "cover_hash", "left_anti")


def rubric_versions(old: DataFrame, text: str, prompt: str, model: str, bands: str, as_of: Column) -> DataFrame:
    """Rubrics with one more version if the content is new; its hash covers text, prompt, model and bands."""
    spark = old.sparkSession
    row = spark.range(1).select(F.sha2(F.concat(*(F.lit(x) for x in (text, prompt, model, bands))), 256).alias("hash"), F.lit(text).alias("text"), F.lit(prompt).alias("prompt"), F.lit(model).alias("model"), F.lit(bands).alias("bands"), F.to_date(as_of).alias("valid_from"))
    fresh = new_only(row, old, ["hash"]).crossJoin(old.agg(F.count("*").alias("_n")))
    fresh = fresh.withColumn("version", F.concat(F.lit("v1."), F.col("_n").cast("string"))).drop("_n")
    return old.unionByName(fresh, allowMissingColumns=True)


def update_covers(items: DataFrame, results: DataFrame) -> DataFrame:
    """Items with the outcome of a cover run: results (id, hash, error)."""
    r = results.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("error").alias("_error"))
    joined = items.join(r, items.id == r._id, "left")
    new = {"cover_hash": F.coalesce("_hash", "cover_hash"), "cover_status": F.when(F.col("_hash").isNotNull(), "ok").when(F.col("_id").isNotNull(), "failed").otherwise(F.col("cover_status"))}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in items.columns))


def work_list(items: DataFrame, task: str, limit: int | None = None, retry: bool = False) -> DataFrame:
    """Items that wait for a task, newest first: enrich, cover or assess. The limit is a run's size."""
    state = F.col("state")
    ready = {
        "enrich": (state == "raw") | (F.lit(retry) & (state == "enriched") & F.col("body").isNull()),
        "cover": F.col("cover_url").isNotNull() & (F.col("cover_status") == "pending") & (state != "discarded") if "cover_url" in items.columns else F.lit(False),
        "assess": F.col("assessment_id").isNull() & state.isin("enriched", "assessed") if "assessment_id" in items.columns else F.lit(False),
    }[task]
    found = items.where(ready).orderBy(F.desc("published"), "id")
    return found.limit(limit) if limit else found


def follow_up(mentions: DataFrame, task: str, priority: int) -> DataFrame:
    """Queue rows for mentions (mention_id): a task once for each."""
    rows = mentions.select("mention_id").distinct()
    return rows.select(F.xxhash64(F.lit(task), "mention_id").alias("id"), F.lit(task).alias("task"), "mention_id", F.lit(priority).alias("priority"), F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("next_at"), F.lit(None).cast("string").alias("error"))


def cover_tasks(enriched: DataFrame, pages: DataFrame) -> DataFrame:
    """Queue rows for covers that enrichment has found on items that stay."""
    there = pages.where("error IS NULL AND cover IS NOT NULL").select("id")
    return follow_up(enriched.where("state = 'enriched'").join(there, "id", "left_semi").select(F.col("id").alias("mention_id")), "cover", 4)


def due_tasks(queue: DataFrame, as_of: Column, most_attempts: int = 6) -> DataFrame:
    """Tasks to do now, most urgent first; those tried too often stay behind. An extension: the queue's columns declare it."""
    ready = queue.where(F.col("next_at").isNull() | (F.col("next_at") <= as_of)).where(F.col("attempts") < most_attempts)
    return ready.orderBy("priority", F.col("next_at").asc_nulls_first(), "id")


def put_off(queue: DataFrame, failures: DataFrame, as_of: Column, minutes: int = 5) -> DataFrame:
    """The queue after failures (id, error): one more attempt each, the wait doubling every time. An extension."""
    f = failures.select(F.col("id").alias("_id"), F.col("error").alias("_error"))
    joined = queue.join(f, queue.id == f._id, "left")
    failed = F.col("_id").isNotNull()
    wait = F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(minutes) * F.pow(F.lit(2), F.col("attempts"))).cast("int"))
    new = {"attempts": F.when(failed, F.col("attempts") + 1).otherwise(F.col("attempts")), "next_at": F.when(failed, as_of + wait).otherwise(F.col("next_at")), "error": F.when(failed, F.col("_error")).otherwise(F.col("error"))}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in queue.columns))


def prompt(items: DataFrame, template: str, rubric: str, client: str, most: int = 6000) -> DataFrame:
    """(id, prompt): the template with {client}, {rubric}, {title}, {outlet} and {text} filled in.

    The text is the summary and, after an empty line, the first ``most``
    characters of the body: a call's budget. Marks inside values stay as they are.
    """
    parts = F.split(F.lit(template), r"(?=\{(?:client|rubric|title|outlet|text)\})|(?<=\{(?:client|rubric|title|outlet|text)\})")
    said = {"client": F.lit(client), "rubric": F.lit(rubric), "title": F.coalesce("title", F.lit("")), "outlet": F.coalesce("outlet", F.lit("unknown")), "text": F.concat(F.coalesce("summary", F.lit("")), F.lit("\n\n"), F.coalesce(F.left("body", F.lit(most)), F.lit("")))}

    def fill(part: Column) -> Column:
        out = part
        for name, value in said.items():
            out = F.when(part == f"{{{name}}}", value).otherwise(out)
        return out

    return items.select("id", F.array_join(F.transform(parts, fill), "").alias("prompt"))


def run_log(runs: DataFrame) -> DataFrame:
    """One row per collection run of raw events (run_id, collector, outcome, at): found, new, status."""
    return runs.groupBy("run_id", "collector").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.count("*").alias("found"), F.count_if(F.col("outcome") == "new").alias("new")).withColumn("status", F.when(F.col("found") == 0, "failed").otherwise("ok"))
