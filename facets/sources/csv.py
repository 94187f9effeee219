"""Headed CSV source.

The reference lets Spark infer the schema, which costs a full extra pass over
the file and turns ``MM/dd/yyyy`` dates into text. Here the schema is
declared, but applied **by header name**, not by position: every column is
read as text (Spark only reads the header line for the names), the declared
columns are picked by name - so a file with more columns, or in another
order, loads correctly - and each is converted with ``try_cast`` (a bad
value becomes NULL, as Spark's PERMISSIVE CSV mode does, instead of failing
an ANSI job; with ``flag_failed`` a further column lists the columns whose
text was lost that way, so that bad values can be told from missing ones). ``date_columns`` are parsed with the listed layouts, tried in
order. ``infer=True`` keeps the reference behaviour available.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facets.functions.compare import number_of

#: Column that ``load_checked_csv`` adds: the record as it stands in the file, if it has too many or too few fields.
BAD_RECORD = "_bad_record"
#: Column that ``flag_failed`` adds: names of the row's columns with text that failed its cast.
FAILED_CASTS = "_failed_casts"


def as_struct(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    date_columns: tuple[str, ...] = (),
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",),
    infer: bool = False,
    flag_failed: bool = False,
    **options,
) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if schema is None:
        raise ValueError("declare a schema, or pass infer=True")
    return typed_from_text(reader.csv(path), as_struct(spark, schema), date_columns, date_formats, flag_failed)


def load_checked_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    date_columns: tuple[str, ...] = (),
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",),
    multi_line: bool = True,
    **options,
) -> DataFrame:
    """A headed CSV of which every record is accounted for: ``load_csv`` with
    two more columns. ``_bad_record`` holds the text of a record with too many
    or too few fields (null for a good one; its fields are as far as they came),
    ``_failed_casts`` the columns whose text is no value of their type. Rows in
    the file = rows without either + rows with one of them.

    Quoted fields may hold line breaks. For that a file has to be read in one
    piece; files without such fields are better read with ``multi_line=False``,
    which splits them. All files must have the columns of the first one, in its
    order; another header is an error, not a shift of the columns.
    """
    reader = spark.read.option("header", True).option("escape", '"').options(**options)
    names = reader.csv(path).columns
    if BAD_RECORD in names:
        raise ValueError(f"the file has a column named {BAD_RECORD}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_RECORD]])
    rows = (reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
            .option("multiLine", multi_line).option("enforceSchema", False).option("columnPruning", False).csv(path))
    # Spark refuses a query that asks for the record column alone: a field of no length is put to it
    rows = rows.withColumn(BAD_RECORD, F.concat(BAD_RECORD, F.left(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), F.lit(0))))
    return typed_from_text(rows, as_struct(spark, schema), date_columns, date_formats, flag_failed=True, keep=(BAD_RECORD,))


def record_faults(checked: DataFrame) -> DataFrame:
    """(fault, n) of a frame from ``load_checked_csv``: good records, records
    with a wrong number of fields, and records with failed casts by column
    names, in one aggregate."""
    fault = F.when(F.col(BAD_RECORD).isNotNull(), "fields").when(F.size(FAILED_CASTS) > 0, F.concat(F.lit("cast:"), F.array_join(FAILED_CASTS, ",")))
    return checked.select(F.coalesce(fault, F.lit("none")).alias("fault")).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


def typed_from_text(text: DataFrame, schema: T.StructType, date_columns: tuple[str, ...] = (),
                    date_formats: tuple[str, ...] = ("yyyy-MM-dd",), flag_failed: bool = False,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Pick the declared columns of an all-text frame by name and type them;
    the columns in ``keep`` stay as they are."""
    missing = [f.name for f in schema.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"columns not in the file header: {missing}")
    cols, failed = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in date_columns:
            c = parse_date(c, date_formats)
        elif isinstance(f.dataType, T.NumericType):
            c = number_of(c, f.dataType.simpleString())
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
        if f.name in date_columns or not isinstance(f.dataType, T.StringType):
            lost = c.isNull() & (F.trim(F.col(f"`{f.name}`")) != "")
            failed.append(F.when(lost, F.lit(f.name)))
    if flag_failed:
        found = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
        cols.append(found.alias(FAILED_CASTS))
    return text.select(*cols, *[F.col(f"`{k}`") for k in keep])


def parse_date(c: Column, formats: tuple[str, ...]) -> Column:
    """First layout in ``formats`` that parses ``c``; NULL if none does."""
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])
