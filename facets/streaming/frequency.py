"""Running citation counts over a folder that receives new CSV files.

The batch plan, unchanged, on a file stream: every cleaning step is
stateless (filters, renames, the bound clock parser), so
``clean_citations`` applies as is; ``frequency`` becomes a streaming
aggregate whose state holds one row per key (codes, precincts: small and
bounded by the key domain, not by the data). Each micro-batch's full count
table is handed to ``foreachBatch``, which ranks it with the batch
``top_k`` and writes a Parquet result - so a restarted query recovers
from its checkpoint in the shared ``spark.checkpoint.dir`` and re-derives the
same ranking. A micro-batch writes into a folder of its own, and a pointer
file is then switched to it by one rename, so that a reader always finds a
whole answer (``published``).

Not supported on a stream: ``replace_with_mode`` (a scalar subquery), so
``state_fill`` must be a constant here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from facets.operators import frequency, top_k
from facets.plans.citations import CITATIONS_SCHEMA, STATE_FILL, clean_citations
from facets.sources import shared_dir
from facets.sources.csv import typed_from_text


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One supplied Parquet table as a file stream (schema from its footer).

    A file stream's path is a directory or a glob; the glob matches this
    table's file alone."""
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(os.path.join(sf_dir, f"{name}.parque[t]"))


def citation_stream(spark: SparkSession, source_dir: str, header: list[str] | None = None,
                    max_files_per_trigger: int | None = None, date_formats=("yyyy-MM-dd",)) -> DataFrame:
    """Citation files arriving in ``source_dir``, typed like ``load_citations``.

    A file stream needs its full column list up front; ``header`` gives it,
    or it is read from the header line of a file already in the folder. All
    columns stream as text and the citation columns are picked by name, so
    files with extra columns load correctly."""
    if header is None:
        header = spark.read.option("header", True).csv(source_dir).columns
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    reader = spark.readStream.schema(text_schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_from_text(reader.csv(source_dir), CITATIONS_SCHEMA, ("Issue Date",), date_formats)


def running_counts(stream: DataFrame, keys, state_fill: str = STATE_FILL, **clean_kw) -> DataFrame:
    """Cleaned, counted stream (complete-mode aggregate)."""
    if state_fill is None:
        raise ValueError("a stream needs a constant state_fill")
    return frequency(clean_citations(stream, state_fill=state_fill, **clean_kw), keys)


POINTER = "_CURRENT"


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = fs.Path(path)
    return fs, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, out_dir: str, batch_id: int, answers: dict[str, DataFrame], keep: int = 2) -> None:
    """Write the answers of a micro-batch, point readers to them, and remove
    folders older than the last ``keep`` batches."""
    for name, df in answers.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}/{name}")
    fs, new, files = _hadoop(spark, f"{out_dir}/{POINTER}.{batch_id}")
    out = files.create(new, True)
    out.write(str(batch_id).encode())
    out.close()
    context = fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.valueOf("OVERWRITE")
    context.rename(new, fs.Path(f"{out_dir}/{POINTER}"), how)
    files.delete(fs.Path(f"{out_dir}/batch={batch_id - keep}"), True)


def published(spark: SparkSession, out_dir: str, answer: str) -> DataFrame:
    """The answer that the pointer names."""
    _, pointer, files = _hadoop(spark, f"{out_dir}/{POINTER}")
    stream = files.open(pointer)
    batch_id = bytes(stream.readAllBytes()).decode()
    stream.close()
    return spark.read.parquet(f"{out_dir}/batch={batch_id}/{answer}")


def start_top_k(counts: DataFrame, key: str, k: int, out_path: str, checkpoint: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Keep the answer ``top`` under ``out_path``: the current top ``k`` of a running count."""
    spark = counts.sparkSession
    checkpoint = checkpoint or os.path.join(shared_dir(spark), "facets-stream-" + os.path.basename(out_path))

    def publish(batch: DataFrame, batch_id: int) -> None:
        _publish(spark, out_path, batch_id, {"top": top_k(batch, key, k, by="n")})

    writer = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(publish))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def running_cube(stream: DataFrame, bins=None, state_fill: str = STATE_FILL, **clean_kw) -> DataFrame:
    """Running (Time_Bins, Violation_Code) counts of a citation stream.

    The streaming state is the count cube itself: one row per (bin, code),
    bounded by bins x codes whatever the volume. Rows without a valid bin are
    dropped as the batch report does (``dropna``)."""
    from facets.functions import REFERENCE_BINS
    from facets.plans.citations import time_bins

    if state_fill is None:
        raise ValueError("a stream needs a constant state_fill")
    clean = clean_citations(stream, state_fill=state_fill, **clean_kw)
    return frequency(time_bins(clean, bins or REFERENCE_BINS), ["Time_Bins", "Violation_Code"])


def cube_answers(cube: DataFrame, k: int = 3) -> dict[str, DataFrame]:
    """The bin questions of the report, answered from a (bin, code) cube."""
    from facets.operators import top_k_per_group

    return {
        "bin_counts": frequency(cube, "Time_Bins", count="Violation_Code", by="n"),
        "per_bin_top_codes": top_k_per_group(cube, "Time_Bins", "Violation_Code", k, by="n"),
        "top_codes_binned": top_k(frequency(cube, "Violation_Code", by="n"), "Violation_Code", k, by="n"),
    }


def start_publishing(cube: DataFrame, out_dir: str, answers=cube_answers, checkpoint: str | None = None,
                     available_now: bool = True) -> StreamingQuery:
    """Keep every answer of the running cube published under ``out_dir``.

    Each micro-batch's complete cube (a few rows) is turned into the answers
    by the batch operators and written by the executors; a restart resumes
    from the checkpoint in the shared folder. A micro-batch replayed after a
    failure writes its own folder again (idempotent sink)."""
    spark = cube.sparkSession
    checkpoint = checkpoint or os.path.join(shared_dir(spark), "facets-stream-" + os.path.basename(out_dir))

    def publish(batch: DataFrame, batch_id: int) -> None:
        _publish(spark, out_dir, batch_id, answers(batch))

    writer = (cube.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(publish))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
