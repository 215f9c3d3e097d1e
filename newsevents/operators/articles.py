"""Article text from fetched pages, and its join to events.

The reference fetched every event URL and ran an extractor per row. Here the
pages are a table (``page_id, url, html``): each page is extracted once - a page
that marks its ``<article>`` with JVM regex and array functions, one that does not
by a scorer over its block tags (an Arrow UDF) - with no shuffle, then joined to the
events that cite it (a URL shared by many events is still extracted once).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsevents.functions.body import scored_paragraphs
from newsevents.functions.html import ARTICLE_OPEN, BODY, TITLE, articles, paragraph_chunks, strip_noise, tidy_text, tidy_texts
from newsevents.operators.dataflow import spread
from newsevents.session import ship_package

PARAGRAPH_SEP = "\n\n"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _scored(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else scored_paragraphs(h))


def article_paragraphs(html: Column) -> Column:
    """Array of paragraph texts of a page without noise (``strip_noise``).

    The ``<article>`` elements' non-blank paragraphs. A page without such an element gives null:
    its paragraphs are found by scores.
    """
    paras = F.filter(tidy_texts(paragraph_chunks(articles(html))), lambda p: p != F.lit(""))
    return F.when(html.rlike(ARTICLE_OPEN), paras)


def body_paragraphs(html: Column) -> Column:
    """Array of paragraph texts of the best-scored block of the ``<body>`` (see ``functions/body.py``)."""
    raw = _scored(F.coalesce(F.nullif(F.regexp_extract(html, BODY, 1), F.lit("")), html))
    return F.filter(tidy_texts(raw), lambda p: p != F.lit(""))


def extract_articles(pages: DataFrame, html: str = "html", parallel: int | None = None) -> DataFrame:
    """``pages`` + ``fetched``, ``title``, ``paragraphs`` and ``content``.

    A null page (failed fetch) gives ``fetched = false``, null title and
    content, and no paragraphs. Filter on ``fetched``, not on ``content``: a filter on the
    computed text would be pushed below the repartition and evaluated a
    second time. ``parallel`` spreads a small, unsplittable input (D1).
    """
    ship_package(pages.sparkSession)
    src = spread(pages, parallel).withColumn("fetched", F.col(html).isNotNull()).withColumn("_clean", strip_noise(F.col(html)))
    # Pages with an <article> stay in the JVM; only the others go to the scorer.
    marked = src.withColumn("_marked", article_paragraphs(F.col("_clean")))
    body = body_paragraphs(F.when(F.col("_marked").isNull(), F.col("_clean")))
    title = tidy_text(F.regexp_extract("_clean", TITLE, 1))
    out = marked.withColumn("paragraphs", F.coalesce("_marked", body, F.array().cast("array<string>"))).withColumn("title", F.when(F.col("fetched"), title))
    return out.drop("_clean", "_marked").withColumn("content", F.when(F.col("fetched"), F.array_join("paragraphs", PARAGRAPH_SEP)))


def attach_content(events: DataFrame, extracted: DataFrame, url: str = "source_url",
                   key: str = "cameo", version: str = "page_id") -> DataFrame:
    """``(cameo, title, content)`` for events whose page was extracted (inner join).

    Failed fetches (null content) are dropped; empty content is kept. A URL
    fetched several times counts once: the page with the highest ``version``
    (``page_id``; without that column the greatest title and content). The join is an equi-join on the URL: Spark broadcasts the articles only when
    their measured size is under the broadcast threshold, and AQE splits a
    URL cited by a large share of events (skew join).
    """
    ev = events.where(F.col(url).isNotNull()).select(key, F.col(url).alias("_url"))
    ok = F.col("fetched") if "fetched" in extracted.columns else F.col("content").isNotNull()
    page = F.struct(*([version] if version in extracted.columns else []), "title", "content")
    arts = (extracted.where(ok).groupBy(F.col("url").alias("_url")).agg(F.max(page).alias("_page"))
            .select("_url", "_page.title", "_page.content"))
    return ev.join(arts, "_url", "inner").select(key, "title", "content")
