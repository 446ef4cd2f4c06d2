"""Main text of pages by consensus of each host.

1. Every page scores the containers of its own text and votes for its best three by their share, each
   with its reach: the widest ancestor that adds more text than links, so headlines and leads beside it.
2. Votes are added up per host and generalised tag-class path; each host keeps its five leaders, and of
   each the widest reach with a tenth of its votes.
3. Pages are read again and give the text around the first of their host's leaders that they hold, as
   wide as the page itself shows where it agrees on the place, else up to the host's reach; a page that
   holds none of them falls back on its own best container.

A vote is at most three short rows a page, combined before the shuffle, so a host with a third of
all pages costs its paths, not its pages. The leaders are stored and measured: while they are small they
are broadcast and pages stay where they are, beyond that Spark joins by host and splits a skewed one.

Defined results: a null, empty or textless page gives an empty text; a page without a host in its
url votes with all such pages; repeated pages repeat their result; a page of any length is read
whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from faremill.llm.common import small_side, stored, text_of
from faremill.llm.html_blocks import best_first, blocks_of, container_scores, text_under, widened

VOTES = 3
LEADERS = 5


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _ballots(html: str) -> list[dict]:
    blocks = blocks_of(html)
    scores = container_scores(blocks)
    total = sum(scores.values())
    best = best_first(scores)[:VOTES]
    return [{"path": p, "votes": round(1000 * scores[p] / total), "reach": widened(blocks, p)[0]} for p in best]


BALLOTS = T.ArrayType(
    T.StructType([T.StructField("path", T.StringType()), T.StructField("votes", T.LongType()), T.StructField("reach", T.StringType())])
)


@F.pandas_udf(BALLOTS)
def page_votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(_ballots)


@F.pandas_udf(T.StringType())
def main_text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, leaders, reaches in batches:
        listed = ((h, [], []) if p is None else (h, list(p), list(r)) for h, p, r in zip(pages, leaders, reaches))
        yield pd.Series([text_under(blocks_of(h), p, r) for h, p, r in listed], dtype=object)


def host_leaders(pages: DataFrame, url: str = "url", html: str = "html", leaders: int = LEADERS) -> DataFrame:
    """(host, paths, reaches): each host's paths with most votes, best first, and how far they may be widened."""
    cast = pages.select(host_of(F.col(url)).alias("host"), F.explode(page_votes(text_of(html))).alias("vote"))
    by_reach = cast.groupBy("host", "vote.path", "vote.reach").agg(F.sum("vote.votes").alias("votes"))
    # a path has as many reaches as ancestors at most
    seen = F.collect_list(F.struct(F.length("reach").alias("n"), "reach", "votes"))
    counted = by_reach.groupBy("host", "path").agg(F.sum("votes").alias("votes"), seen.alias("seen"))
    widest = F.array_min(F.filter("seen", lambda r: r["votes"] * 10 >= F.col("votes")))
    counted = counted.select("host", "path", "votes", F.coalesce(widest["reach"], "path").alias("reach"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= leaders)
    ranked = F.array_sort(F.collect_list(F.struct("rank", "path", "reach")))
    kept = top.groupBy("host").agg(ranked.alias("kept"))
    return kept.select("host", F.col("kept.path").alias("paths"), F.col("kept.reach").alias("reaches"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Page id, url, main text and its length in code points."""
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    winners = small_side(stored(host_leaders(source), "host-leaders"))
    joined = source.withColumn("host", host_of(F.col("url"))).join(winners, "host", "left")
    read = joined.select("page_id", "url", main_text(text_of("html"), F.col("paths"), F.col("reaches")).alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("long"))
