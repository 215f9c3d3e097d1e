"""Record layouts of the two feeds and of the derived tables.

Fixed values: the column order of the event feed and the knowledge-graph
feed, and the inner field lists, must equal the feed format for right
results. They are stated here once, in feed order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: event feed, 58 tab-separated columns -----------------------
# Actor block (10 strings), used twice (columns 5-14 and 15-24).
ACTOR_FIELDS = [
    "code", "name", "country_code", "known_group_code", "ethnic_code",
    "religion1_code", "religion2_code", "type1_code", "type2_code", "type3_code",
]
# Geo block (7 fields), used three times (columns 35-41, 42-48, 49-55).
GEO_FIELDS = [
    ("type", "int"), ("name", "string"), ("country_code", "string"),
    ("adm1_code", "string"), ("lat", "double"), ("long", "double"),
    ("feature_id", "string"),
]
# Flat fields and their 0-based column in the feed.
EVENT_HEAD = [(0, "cameo", "bigint"), (1, "day", "date"), (2, "month", "int"),
              (3, "year", "int"), (4, "frac_date", "double")]
ACTOR1_START, ACTOR2_START = 5, 15
EVENT_MIDDLE = [(25, "is_root", "boolean"), (26, "event_code", "string"),
                (27, "event_base_code", "string"), (28, "event_root_code", "string"),
                (29, "quad_class", "int"), (30, "goldstein", "double"),
                (31, "num_mentions", "int"), (32, "num_sources", "int"),
                (33, "num_articles", "int"), (34, "avg_tone", "double")]
ACTOR1_GEO_START, ACTOR2_GEO_START, EVENT_GEO_START = 35, 42, 49
EVENT_TAIL = [(56, "date_added", "int"), (57, "source_url", "string")]
EVENT_WIDTH = 58

# --- fixed values: knowledge-graph feed, 11 tab-separated columns -------------
GRAPH_COLUMNS = ["date", "num", "counts", "themes", "locations", "persons",
                 "organizations", "tones", "cameos", "sources", "urls"]
GRAPH_WIDTH = 11
GRAPH_HEADER_FIRST = "DATE"          # a header line starts with this token
LIST_SEP = ";"                       # counts, themes, locations, persons, organizations, sources
LOCATION_SEP = "#"                   # fields of one location
TONE_SEP = ","                       # fields of the tones record
CAMEO_SEP = ","                      # event ids
URL_SEP = "<UDIV>"                   # source urls
LOCATION_FIELDS = [("type", "int"), ("name", "string"), ("country", "string"),
                   ("adm", "string"), ("latitude", "double"), ("longitude", "double"),
                   ("feature", "string")]
TONE_FIELDS = ["average_tone", "positive_score", "negative_score", "polarity",
               "activity_density", "group_density"]
DATE_FORMAT = "yyyyMMdd"

# Entity kinds produced by the ranking job, with the graph column they come from.
ENTITY_KINDS = [("theme", "themes"), ("person", "persons"), ("organization", "organizations")]


def raw_event_schema() -> T.StructType:
    """All-string scan schema: typing happens in ``select`` so pushdown survives."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(EVENT_WIDTH)])


def _spark_type(name: str) -> T.DataType:
    return {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
            "string": T.StringType(), "date": T.DateType(), "boolean": T.BooleanType()}[name]


def actor_type() -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in ACTOR_FIELDS])


def geo_type() -> T.StructType:
    return T.StructType([T.StructField(f, _spark_type(t), True) for f, t in GEO_FIELDS])


def location_type() -> T.StructType:
    return T.StructType([T.StructField(f, _spark_type(t), True) for f, t in LOCATION_FIELDS])


def tone_type() -> T.StructType:
    return T.StructType([T.StructField(f, T.DoubleType(), True) for f in TONE_FIELDS])


ARTICLE_SCHEMA = T.StructType([
    T.StructField("cameo", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
])

SERIES_SCHEMA = "day string, value string"
