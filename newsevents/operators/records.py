"""Feed records -> typed, nested DataFrames.

One core per feed works on *tokens*, whatever produced them: the CSV scan of a
feed file (columns ``_c0.._c57``) or ``split`` of in-memory lines. Structs are
built plain, so a filter on ``actor1_geo.country_code`` still reaches the scan
(``PushedFilters``); turning an all-null struct into null is a separate, last
step (``null_empty_structs``) because that wrapping blocks pushdown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsevents import schema as S
from newsevents.functions.parsing import (convert, non_blank_items, split_all, to_date,
                                           to_double, to_int, to_long)

Tok = Callable[[int], Column]


def _event_columns(tok: Tok, blanks_are_null: bool) -> list[Column]:
    def conv(c: Column, kind: str) -> Column:
        # A scan that already maps empty fields to null keeps string leaves as
        # bare columns, so filters on them reach the scan (PushedFilters).
        return c if (blanks_are_null and kind == "string") else convert(c, kind)

    cols = [conv(tok(i), t).alias(n) for i, n, t in S.EVENT_HEAD]
    for start, name in ((S.ACTOR1_START, "actor1"), (S.ACTOR2_START, "actor2")):
        cols.append(F.struct(*[conv(tok(start + j), "string").alias(f)
                               for j, f in enumerate(S.ACTOR_FIELDS)]).alias(name))
    cols += [conv(tok(i), t).alias(n) for i, n, t in S.EVENT_MIDDLE]
    for start, name in ((S.ACTOR1_GEO_START, "actor1_geo"), (S.ACTOR2_GEO_START, "actor2_geo"),
                        (S.EVENT_GEO_START, "event_geo")):
        cols.append(F.struct(*[conv(tok(start + j), t).alias(f)
                               for j, (f, t) in enumerate(S.GEO_FIELDS)]).alias(name))
    cols += [conv(tok(i), t).alias(n) for i, n, t in S.EVENT_TAIL]
    return cols


# Column expressions are unresolved trees: built once per SparkContext and
# token source, they serve every DataFrame (hundreds of Py4J calls saved per
# query build; a new context gets new ones).
def _memo(kind: str, build) -> list[Column]:
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    if sc is None:
        return build()
    # Kept on the context itself, so the columns live and die with its JVM.
    memo = sc.__dict__.setdefault("_newsevents_columns", {})
    if kind not in memo:
        memo[kind] = build()
    return memo[kind]


#: A line with anything but blanks and control characters; the CSV source drops all others too.
NOT_BLANK = r"[^\x00-\x20]"


def events_from_tokens(df: DataFrame, tok: Tok, keep: list[str] | None = None,
                       blanks_are_null: bool = False, memo_key: str | None = None) -> DataFrame:
    """Typed event rows from any token source (``tok(i)`` = column ``i`` as string).

    ``blanks_are_null``: the source already turned empty fields into null
    (the CSV scan does), so string fields need no conversion. ``memo_key``
    names a fixed token source whose column list may be reused.
    """
    def build() -> list[Column]:
        return _event_columns(tok, blanks_are_null)
    cols = _memo(f"events:{memo_key}:{blanks_are_null}", build) if memo_key else build()
    return df.select(*(keep or []), *cols)


def parse_events(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """In-memory event lines (one string column) -> typed event rows.

    Blank lines (white space only) are dropped, as the CSV scan does; short lines give nulls for the missing columns;
    columns past the 58th are ignored.
    """
    toks = (lines.where(F.col(value).rlike(NOT_BLANK))
            .select(*(keep or []), split_all(F.col(value), "\t").alias("_tok")))
    return events_from_tokens(toks, lambda i: F.get(F.col("_tok"), i), keep, memo_key="split")


def parse_event_csv_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed event rows from the 58 string columns of a CSV scan."""
    return events_from_tokens(df, lambda i: F.col(f"_c{i}"), keep, blanks_are_null=True, memo_key="csv")


def _struct_or_null(c: Column, fields: list[str]) -> Column:
    any_set = None
    for f in fields:
        cond = c.getField(f).isNotNull()
        any_set = cond if any_set is None else (any_set | cond)
    return F.when(any_set, c)


def null_empty_structs(df: DataFrame) -> DataFrame:
    """A struct whose leaves are all null becomes null (run last: blocks pushdown)."""
    out = []
    for field in df.schema.fields:
        dtype = field.dataType
        if dtype.typeName() == "struct":
            out.append(_struct_or_null(F.col(field.name), dtype.fieldNames()).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


# --- knowledge graph ------------------------------------------------------------

def _graph_columns(tok: Tok) -> list[Column]:
    def items(i: int, sep: str = S.LIST_SEP) -> Column:
        return non_blank_items(tok(i), sep)

    def location(x: Column) -> Column:
        parts = split_all(x, S.LOCATION_SEP)
        return F.struct(*[convert(F.get(parts, j), t).alias(f)
                          for j, (f, t) in enumerate(S.LOCATION_FIELDS)])

    tone_parts = split_all(F.coalesce(tok(7), F.lit("")), S.TONE_SEP)
    cameos = F.filter(F.transform(items(8, S.CAMEO_SEP), lambda x: to_long(x)),
                      lambda x: x.isNotNull())
    return [
        to_date(tok(0)).alias("date"),
        to_int(tok(1)).alias("num"),
        items(2).alias("counts"),
        items(3).alias("themes"),
        F.transform(items(4), location).alias("locations"),
        items(5).alias("persons"),
        items(6).alias("organizations"),
        F.struct(*[to_double(F.get(tone_parts, j)).alias(f)
                   for j, f in enumerate(S.TONE_FIELDS)]).alias("tones"),
        cameos.alias("cameos"),
        items(9).alias("sources"),
        items(10, S.URL_SEP).alias("urls"),
    ]


def graph_from_tokens(df: DataFrame, tok: Tok, keep: list[str] | None = None,
                      memo_key: str | None = None) -> DataFrame:
    cols = _memo(f"graph:{memo_key}", lambda: _graph_columns(tok)) if memo_key else _graph_columns(tok)
    return df.select(*(keep or []), *cols)


def parse_graph(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Knowledge-graph lines -> rows with arrays and structs.

    A header line (first token ``DATE``) and blank lines are dropped; blank
    list items are dropped; extra inner tokens are ignored; bad numbers are null.
    """
    toks = (lines.where(F.col(value).rlike(NOT_BLANK))
            .select(*(keep or []), split_all(F.col(value), "\t").alias("_tok"))
            .where(F.coalesce(F.get(F.col("_tok"), 0), F.lit("")) != F.lit(S.GRAPH_HEADER_FIRST)))
    return graph_from_tokens(toks, lambda i: F.get(F.col("_tok"), i), keep, memo_key="split")


def with_row_key(df: DataFrame, source: Column | str, value: str = "value",
                 name: str = "row_id") -> DataFrame:
    """Content hash of a row: md5 of ``source-line``.

    ``source`` is the file path (``_metadata.file_path`` for a file scan) or
    any literal naming an in-memory feed. Unlike a split/offset key it does not
    change when the input is split differently. It names a line's content, not
    its place: identical lines of one file share it.
    """
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumn(name, F.md5(F.concat_ws("-", src, F.col(value))))


#: Copies of one line that one task numbers; more are dealt to tasks in runs of this length.
RUN = 10_000


def with_unique_row_key(df: DataFrame, source: Column | str, value: str = "value", name: str = "row_id") -> DataFrame:
    """A key for each row: ``with_row_key`` for the first of a source's identical lines, a key with its number for each further one.

    Which of several identical lines is the first does not matter, so the keys of a file are the same
    however it is split. Equal rows are counted by a partial aggregate and made again from their number: each distinct row is
    shuffled once a task, whatever its copies, and a line that makes up a third of a feed is dealt to tasks in runs of ``RUN``.
    If ``df`` has columns beside ``value``, the distinct rows of one line are numbered one after the other.
    """
    src = F.lit(source) if isinstance(source, str) else source
    others = [c for c in df.columns if c != value]
    counted = df.withColumn("_src", src).groupBy("_src", *df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_first", F.lit(0).cast("long"))
    if others:
        before = Window.partitionBy("_src", value).orderBy(*others).rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))

    def placed(rows: DataFrame, start: Column, copies: Column) -> DataFrame:
        place = F.explode(F.sequence(start, start + copies - 1)).alias("_place")
        return rows.select("_src", *df.columns, place)

    few = placed(counted.where(F.col("_n") <= RUN), F.col("_first"), F.col("_n"))
    runs = counted.where(F.col("_n") > RUN).withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(RUN)))).repartition(value, "_from")
    many = placed(runs, F.col("_first") + F.col("_from"), F.least(F.lit(RUN), F.col("_n") - F.col("_from")))
    content = F.md5(F.concat_ws("-", F.col("_src"), F.col(value)))
    key = F.when(F.col("_place") == 0, content).otherwise(F.md5(F.concat_ws("-", content, F.col("_place").cast("string"))))
    return few.unionByName(many).select(*df.columns, key.alias(name))
