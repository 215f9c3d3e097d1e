"""HTML-to-text column expressions (JVM regex and array functions).

Character references are decoded by pattern: numeric ones by their code, named
ones by the public HTML table that Python's standard library carries.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
# A tag has no < within: a run of opening signs without a closing one is read once, not once from each of them.
# Elements whose text is never article text; one that is not closed runs to the end.
NOISE = (r"(?is)<script\b[^<>]*+>.*?(?:</script\s*>|\z)|<style\b[^<>]*+>.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)")
TITLE = r"(?is)<title[^<>]*+>((?:[^<]++|<(?!/?title\b))*+)</title>"
ARTICLE_TAG = r"(?i)</?article(?:\s[^<>]*+)?>"
ARTICLE_OPEN = r"(?i)<article(?:\s[^<>]*+)?>"
BODY = r"(?is)<body[^<>]*+>(.*?)(?:</body>|\z)"
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
PARAGRAPH_OPEN = r"(?i)<p(?:\s[^<>]*+)?>"
PARAGRAPH_END = r"(?is)</p>.*$"
TAG = r"<[^<>]*+>"
SPACE = r"\s+"


def _named() -> Column:
    """``&name;`` -> text, as one constant map."""
    return F.from_json(F.lit(json.dumps({f"&{k}": v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")


def _decoded(ref: Column) -> Column:
    """The text of one reference; an unknown name stays, a number that is no character is U+FFFD."""
    hexed = ref.rlike("^&#[xX]")
    code = F.when(hexed, F.conv(F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+);$", 1), 16, 10).cast("int")).otherwise(
        F.regexp_extract(ref, "^&#([0-9]+);$", 1).try_cast("int"))
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code).cast("long")), 8, "0")), "UTF-32")
    text = F.when(ref.startswith("&#"), char).otherwise(F.coalesce(F.element_at(_named(), ref), ref))
    return F.replace(text, F.lit("\u00a0"), F.lit(" "))


def decode_entities(c: Column) -> Column:
    """Every character reference decoded once: ``&amp;lt;`` becomes ``&lt;``."""
    refs = F.regexp_extract_all(c, F.lit(REFERENCE), 0)
    rest = F.split(c, REFERENCE, -1)
    filled = F.zip_with(rest, F.transform(refs, _decoded), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(c.contains("&"), F.array_join(filled, "")).otherwise(c)


def articles(html: Column) -> Column:
    """The text inside ``<article>`` elements: several, nested, or not closed; empty without one.

    The depth after each tag says which of the pieces between tags are inside.
    """
    tags = F.regexp_extract_all(html, F.lit(ARTICLE_TAG), 0)
    pieces = F.split(html, ARTICLE_TAG, -1)
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("depth"))

    def step(acc: Column, x: Column) -> Column:
        depth = F.greatest(acc["depth"] + F.when(x["tag"].startswith("</"), -1).otherwise(1), F.lit(0))
        return F.struct(F.when(depth > 0, F.concat(acc["text"], F.lit("\n</p>\n"), x["piece"])).otherwise(acc["text"]).alias("text"),
                        depth.alias("depth"))

    after = F.zip_with(tags, F.slice(pieces, 2, F.size(pieces)), lambda t, p: F.struct(t.alias("tag"), p.alias("piece")))
    return F.aggregate(after, start, step, lambda acc: acc["text"])


def tidy_text(c: Column) -> Column:
    """Tags removed, entities decoded, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(c, TAG, " ")), SPACE, " "))


def tidy_texts(fragments: Column) -> Column:
    """``tidy_text`` of each item of an array, a pass for each step: within one lambda every use of a step's text would make it anew."""
    bare = F.transform(fragments, lambda x: F.regexp_replace(x, TAG, " "))
    return F.transform(F.transform(bare, decode_entities), lambda x: F.trim(F.regexp_replace(x, SPACE, " ")))


def strip_noise(html: Column) -> Column:
    return F.regexp_replace(html, NOISE, " ")


def paragraph_chunks(fragment: Column) -> Column:
    """Raw HTML of each ``<p>``: text after an opening tag up to ``</p>``.

    Works with unclosed ``<p>`` (the next one ends it). Text before the first
    ``<p>`` (headline, bylines) is not a paragraph.
    """
    parts = F.split(fragment, PARAGRAPH_OPEN, -1)
    return F.transform(F.filter(parts, lambda x, i: i > 0),
                       lambda x: F.regexp_replace(x, PARAGRAPH_END, ""))
