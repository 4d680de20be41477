"""Pages over the network, by a caller's own connection.

The engine opens none itself: ``opener`` does, and everything around it is
here: turns by host, the total deadline, the size cap, compressed bodies, and
errors as rows.
"""

from __future__ import annotations

import gzip
import time
import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import host_of

# Seconds between two requests to a host, seconds for one request, bytes of one body.
SPACING, DEADLINE, MOST_BYTES = 1.2, 40.0, 6 * 1024 * 1024
#: How a search article's page carries its time and signature.
SIGNATURE = r",(\d{10}),&quot;(A[\w-]{20,})&quot;"
#: What a batch request asks for each article, around its gid, time and signature.
REQUEST_BEFORE = '["garturlreq",[["X","X",["X","X"],null,null,1,1,"US:en",null,1,null,null,null,null,null,0,1],"X","X",1,[1,1,1],1,1,null,0,0,null,0],'
REQUEST_NAME = "Fbv4je"

#: url -> (status, headers, body in pieces)
Opener = Callable[[str], tuple[int, dict[str, str], Iterable[bytes]]]


def whole_body(pieces: Iterable[bytes], compressed: bool, deadline: float, most: int = MOST_BYTES, clock: Callable[[], float] = time.monotonic) -> bytes | None:
    """A body read to its end or just past ``most`` bytes; None if the clock passes the deadline first.

    A compressed body that is cut short gives what can be made out of it.
    """
    got, size = [], 0
    for piece in pieces:
        if clock() > deadline:
            return None
        got.append(piece)
        size += len(piece)
        if size > most:
            break
    body = b"".join(got)
    if not compressed:
        return body
    try:
        return gzip.decompress(body)
    except (OSError, EOFError, zlib.error):
        try:
            return zlib.decompressobj(16 + zlib.MAX_WBITS).decompress(body)
        except zlib.error:
            return b""


def fetched(requests: DataFrame, opener: Opener, spacing: float = SPACING, special: dict[str, float] | None = None, deadline: float = DEADLINE, most: int = MOST_BYTES, tasks: int | None = None) -> DataFrame:
    """(id, url, status, content) of requests (id, url).

    A host's requests run in one task, one after another and ``spacing``
    seconds apart (``special``: by host), so no lock is shared. Status 0: the
    request failed or was too slow. Other statuses than 200 have no content.
    Null addresses have status 0.
    """
    dealt = requests.select("id", "url").withColumn("_host", host_of("url"))
    dealt = dealt.repartition(tasks, "_host") if tasks else dealt.repartition("_host")

    def run(frames):
        import pandas as pd

        turn: dict[str, float] = {}
        for frame in frames:
            out = []
            for i, url, host in zip(frame["id"], frame["url"], frame["_host"], strict=True):
                status, body = 0, b""
                if url is not None:
                    time.sleep(max(0.0, turn.get(host, 0.0) - time.monotonic()))
                    turn[host] = time.monotonic() + (special or {}).get(host, spacing)
                    try:
                        status, headers, pieces = opener(url)
                        if status == 200:
                            body = whole_body(pieces, headers.get("Content-Encoding") == "gzip", time.monotonic() + deadline, most)
                    except Exception:  # noqa: BLE001  a failed request is a row like any other
                        status, body = 0, b""
                out.append((i, url, 0 if body is None else status, body or b""))
            yield pd.DataFrame(out, columns=["id", "url", "status", "content"])

    return dealt.mapInPandas(run, "id bigint, url string, status int, content binary")


def page_text(content: Column | str) -> Column:
    """Bytes as UTF-8, broken ones replaced."""
    return F.decode(F.col(content) if isinstance(content, str) else content, "UTF-8")


def signature(page: Column | str) -> Column:
    """struct(at, signature) that lets an article's address be asked for; null if the page has none."""
    page = F.col(page) if isinstance(page, str) else page
    return F.when(page.rlike(SIGNATURE), F.struct(F.regexp_extract(page, SIGNATURE, 1).cast("bigint").alias("at"), F.regexp_extract(page, SIGNATURE, 2).alias("signature")))


def in_batches(requests: DataFrame, size: int = 15, parts: int = 64) -> DataFrame:
    """Requests (gid, at, signature, ...) with batch and index (from 1): ``size`` to a batch but for the last of each part."""
    part = F.pmod(F.xxhash64("gid"), F.lit(parts))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("gid")) - 1
    placed = requests.withColumn("_part", part).withColumn("_place", place)
    return placed.select(*requests.columns, (F.col("_part") + F.floor(F.col("_place") / size) * parts).alias("batch"), (F.col("_place") % size + 1).cast("int").alias("index"))


def batch_request(batched: DataFrame) -> DataFrame:
    """(batch, body): the form text that asks for a batch's addresses at once."""
    one = F.concat(F.lit(REQUEST_BEFORE), F.to_json(F.array("gid")).substr(F.lit(2), F.length(F.to_json(F.array("gid"))) - 2), F.lit(","), F.col("at").cast("string"), F.lit(',"'), F.col("signature"), F.lit('"]'))
    quoted = F.to_json(F.array(one))  # a JSON text within JSON
    envelope = F.concat(F.lit(f'["{REQUEST_NAME}",'), F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(',null,"'), F.col("index").cast("string"), F.lit('"]'))
    held = batched.select("batch", "index", envelope.alias("e")).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("index", "e"))).alias("l"))  # one batch's few requests
    return held.select("batch", F.concat(F.lit("f.req="), F.url_encode(F.concat(F.lit("[["), F.array_join(F.transform("l", lambda x: x["e"]), ","), F.lit("]]")))).alias("body"))


def resolve(items: DataFrame, signatures: DataFrame, send: Callable[[str], str], size: int = 15) -> DataFrame:
    """Items (gid, title, ...) with url or suspect_url.

    signatures: gid, at, signature; items without one stay unresolved. send: a
    batch's form text -> the reply's text ("" if it failed). Replies come in
    any order and are matched by index.
    """
    from newsloom.sources.feeds import attach_resolved, resolver_reply

    asked = in_batches(items.join(signatures.where("signature IS NOT NULL"), "gid").select("gid", "at", "signature").distinct(), size)

    def run(frames):
        for frame in frames:
            yield frame.assign(reply=[send(b) for b in frame["body"]])[["batch", "reply"]]

    resolved = resolver_reply(batch_request(asked).mapInPandas(run, "batch bigint, reply string"))
    placed = items.drop("url", "suspect_url").join(asked.select("gid", "batch", "index"), "gid", "left")
    return attach_resolved(placed, resolved).drop("batch", "index")
