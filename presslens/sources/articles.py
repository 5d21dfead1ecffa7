"""Article files: CSV downloads, JSON archives, what their names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.names import python_literal_to_json
from presslens.schemas import ARTICLES_CSV, ARTICLES_JSON, SOURCE
from presslens.sources.csv_ranges import csv_files, csv_table


def file_name() -> Column:
    return F.col("_metadata.file_name")


def read_articles_csv(spark: SparkSession, paths, schema: T.StructType = ARTICLES_CSV) -> DataFrame:
    """Downloaded articles with their file name; bodies may span lines, and large files are read in ranges.

    Columns are matched by header, so files may lack some or order them differently.
    """
    return typed(read_csv_by_header(spark, paths), schema).drop("userHasPermissions")


def read_csv_by_header(spark: SparkSession, paths, listing: dict | None = None) -> DataFrame:
    """CSV files with their name in `file`, columns matched by header whatever order a file has them in.

    Columns that a file lacks are null. `listing` has options that choose files.
    """
    return csv_table(csv_files(spark, paths, listing))


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that the schema names; others, and those the file lacks, are left alone.

    A value that cannot be cast becomes null; `cast_rejects` counts them.
    """
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def cast_rejects(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """How many values of each column of the schema `typed` cannot cast: one row, one column each."""
    known = [f for f in schema.fields if f.name in raw.columns]
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in known]
    return raw.agg(*lost)


def read_articles_json(spark: SparkSession, paths, schema: T.StructType = ARTICLES_JSON) -> DataFrame:
    """Archived articles, one object per line, gzip or plain; `json_rejects` has the broken lines.

    A gzip file is read by one task, so an archive should come in many files.
    """
    return _json_lines(spark, paths, schema).where("_parsed._corrupt_record IS NULL").select("_parsed.*").drop("_corrupt_record")


def json_rejects(spark: SparkSession, paths, schema: T.StructType = ARTICLES_JSON) -> DataFrame:
    """Lines (file, line) that are no object of the schema."""
    return _json_lines(spark, paths, schema).where("_parsed._corrupt_record IS NOT NULL").select("file", "line")


def _json_lines(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(paths).select(file_name().alias("file"), F.col("value").alias("line")).where("trim(line) <> ''")
    return lines.withColumn("_parsed", F.from_json("line", whole, {"columnNameOfCorruptRecord": "_corrupt_record"}))


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs to columns named by their path; arrays are kept as they are."""

    def leaves(schema, path):
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema, []))


def with_year(df: DataFrame, first: int, last: int, date: str = "date") -> DataFrame:
    """Rows of the wanted years, with a `year` column; rows without a valid date are dropped."""
    dated = df.withColumn("year", F.year(F.try_to_timestamp(F.col(date).cast("string"), F.lit("yyyy-MM-dd"))))
    return dated.where(F.col("year").between(first, last))


def write_by_year(df: DataFrame, path: str, first: int = 2014, last: int = 2024) -> None:
    """One Parquet folder per year in a single pass."""
    with_year(df, first, last).write.partitionBy("year").mode("errorifexists").parquet(path)


def language_of_file(name: Column) -> Column:
    """English when the name contains `eng`, else Arabic when it contains `ara`, else null."""
    return F.when(name.contains("eng"), "English").when(name.contains("ara"), "Arabic")


def with_file_language(df: DataFrame, name: str = "file") -> DataFrame:
    """Add the language of the file; rows of files without one are skipped."""
    return df.withColumn("language", language_of_file(F.col(name))).where("language IS NOT NULL")


def file_region(name: Column) -> Column:
    """Region at the start of `<region>_<from>_<to>_<lang>_<n>_…`."""
    return F.regexp_extract(name, r"^([a-z_]+)_\d{8}_\d{8}_", 1)


def file_details(name: Column) -> Column:
    """Struct of what a result file name says: region, from, to, language, number of results."""
    pattern = r"^([a-z_]+)_(\d{8})_(\d{8})_([a-z]+)_(\d+)_"
    day = [F.to_date(F.nullif(F.regexp_extract(name, pattern, i), F.lit("")), "MMddyyyy") for i in (2, 3)]
    return F.struct(
        F.regexp_extract(name, pattern, 1).alias("region"),
        day[0].alias("from_date"),
        day[1].alias("to_date"),
        F.regexp_extract(name, pattern, 4).alias("lang"),
        F.nullif(F.regexp_extract(name, pattern, 5), F.lit("")).cast("long").alias("results"),
    )


def parse_source(printed: Column) -> Column:
    """The source struct from its printed Python form."""
    return F.from_json(
        python_literal_to_json(printed), SOURCE, {"allowSingleQuotes": "true"}
    )
