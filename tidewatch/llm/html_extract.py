"""Extract main texts by the paths on which a host's pages agree.

First pass: each page's containers are scored by their text outside links, and the
best path and the one above it get votes (a path is tags and classes from the root, figures
made alike, as a hash of one size). Votes are added per host and path, before the shuffle as far as
possible, and a host's paths with at least ``MIN_SHARE`` of its leading path's
votes are its consensus, best first. Second pass: each page is read again and
gives the text under the first consensus path that it has. A page with none of
them gives its own best container.

Null and empty pages have the empty text. Pages without a URL are one host.
Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import html_text
from tidewatch.llm.common import rest, text_udf

#: A path gets a vote if its score is this; the best one of a page has 1, the one above it half.
VOTING_SHARE = 0.5
#: Of the leading path's votes; bounds a host's consensus to a handful of paths.
MIN_SHARE = 0.05
VOTES_TYPE = "array<struct<path:string,depth:int,vote:double>>"


def host_of(url: Column) -> Column:
    """Lower case, without user, port and ``www.``; empty if there is none."""
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(F.coalesce(host, F.lit("")), r"^www\.", "")


def _votes(pages: pa.Array) -> pa.Array:
    rows = []
    for raw in pages.to_pylist():
        page = html_text.read(raw)
        found = html_text.scores(page)
        depth_of = {path: depth for (path, _), depth in zip(page.containers, html_text.depths(page), strict=True)}
        rows.append(
            [
                {"path": path, "depth": depth_of[path], "vote": vote}
                for path, vote in found.items()
                if vote >= VOTING_SHARE
            ]
        )
    item = pa.struct([("path", pa.string()), ("depth", pa.int32()), ("vote", pa.float64())])
    return pa.array(rows, pa.list_(item))


def consensus(pages: DataFrame) -> DataFrame:
    """Rows host, paths: the paths a host's pages agree on, best first."""
    votes = pages.select(host_of(F.col("url")).alias("host"), text_udf(_votes, VOTES_TYPE)(F.col("html")).alias("v"))
    each = votes.select("host", F.explode("v").alias("v")).select("host", "v.*")
    added = each.groupBy("host", "path", "depth").agg(F.sum("vote").alias("votes"))
    lead = added.groupBy("host").agg(F.max("votes").alias("lead"))
    lead = lead.withColumnRenamed("host", "lead_host")
    kept = added.join(lead, F.col("host") == F.col("lead_host")).where(
        F.col("votes") >= MIN_SHARE * F.col("lead")
    )
    # Rounded, so that the order of addition cannot change the order of paths; of equals, the outer one.
    ranked = F.struct((-F.round("votes", 6)).alias("o"), "depth", "path")
    ordered = F.sort_array(F.collect_list(ranked))
    return kept.groupBy("host").agg(F.transform(ordered, lambda r: r["path"]).alias("paths"))


def _extract(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, paths in columns:
        texts = []
        for raw, known in zip(pages, paths, strict=True):
            page = html_text.read(raw.as_py() or "")
            own = {path for path, _ in page.containers}
            path = next((p for p in known.as_py() or () if p in own), None)
            # A page may have the path and nothing in it.
            text = html_text.text_at(page, path)
            texts.append(text if text or path is None else html_text.text_at(page, None))
        yield pa.array(texts, pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, each page's main text."""
    paths = rest(consensus(pages), "html_paths").select(F.col("host").alias("_host"), F.col("paths").alias("_paths"))
    # Broadcast or shuffled by the table's true size; Spark splits a host that fills a partition.
    joined = pages.join(paths, host_of(pages["url"]) == paths["_host"], "left")
    text = F.arrow_udf(_extract, "string").asNondeterministic()(pages["html"], F.col("_paths"))
    return joined.select(*[pages[c] for c in pages.columns if c != "text"], text.alias("text"))
