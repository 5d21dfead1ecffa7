"""Schemas of the files that are read with a fixed schema."""

from pyspark.sql import types as T

SOURCE = T.StructType([T.StructField("uri", T.StringType()), T.StructField("title", T.StringType())])

# Downloaded articles as CSV; the source struct is printed as text there.
ARTICLES_CSV = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("dateTime", T.TimestampNTZType()),
        T.StructField("dateTimePub", T.TimestampNTZType()),
        T.StructField("userHasPermissions", T.StringType()),
    ]
)

# Archived articles as JSON lines.
ARTICLES_JSON = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("source", SOURCE),
        T.StructField("isDuplicate", T.BooleanType()),
    ]
)

KEYWORD_VARIANTS = "entity_id STRING, category STRING, lang STRING, variant STRING"
LOCATION_VARIANTS = "entity_id STRING, level INT, country STRING, lang STRING, variant STRING"
EXPORT_LINE = "source STRING, website STRING, document_count STRING"
