"""Lenient JSON Lines, whole-file documents, chat and raw sinks, append with resume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.functions.text import strip

EXAMPLE = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CHAT = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), *EXAMPLE.fields, *[T.StructField(c, T.StringType()) for c in ("category", "difficulty", "source")]])
TELEMETRY = "step int, epoch double, loss double, val_loss double, learning_rate double, gpu_vram string, gpu_util string, elapsed_seconds double"


def read_lines(spark: SparkSession, path: str, recursive: bool = False, glob: str = "*.jsonl") -> DataFrame:
    """file, line: non-blank lines of JSON Lines files, trimmed, a byte-order mark left out."""
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), strip(F.regexp_replace("value", "^\ufeff", "")).alias("line"))
    return lines.where("line != ''")


def parsed(lines: DataFrame, schema: T.StructType = CHAT) -> DataFrame:
    """lines with record (null where a line is not JSON) and bad. Unknown keys are ignored; numbers come as text."""
    is_json = F.json_object_keys("line").isNotNull()
    return lines.withColumn("bad", ~F.coalesce(is_json, F.lit(False))).withColumn("record", F.when(~F.col("bad"), F.from_json("line", schema, {"allowBackslashEscapingAnyCharacter": "true"})))


def read_records(spark: SparkSession, path: str, schema: T.StructType = CHAT, recursive: bool = False) -> DataFrame:
    """Records of good lines, with file and line; bad lines are dropped silently."""
    rows = parsed(read_lines(spark, path, recursive), schema).where("NOT bad")
    return rows.select("file", "line", "record.*")


def read_sources(spark: SparkSession, paths: list[str], schema: T.StructType = CHAT, recursive: bool = False) -> DataFrame:
    """Records of several files or folders, those that are missing left out, with source_rank (their place in the list) and source_file (the file's name)."""
    there = []
    for rank, path in enumerate(paths):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            there.append(read_records(spark, path, schema, recursive).withColumn("source_rank", F.lit(rank)))
    if not there:
        there = [parsed(spark.createDataFrame([], "file string, line string"), schema).select("file", "line", "record.*", F.lit(0).alias("source_rank"))]
    return reduce(DataFrame.unionByName, there).withColumn("source_file", F.regexp_extract("file", r"([^/]*)$", 1))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_number (from 1) and line of every line, blank ones too. Files are read whole."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r?\n").alias("lines"))
    return whole.select("file", F.posexplode("lines").alias("place", "line")).select("file", (F.col("place") + 1).alias("line_number"), "line")


def renamed(spark: SparkSession, path: str) -> str:
    """The files below path as *.jsonl: Spark's text writer names them .txt."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().endswith(".txt"):
            fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), at.getName()[:-4] + ".jsonl"))
    return path


def file_stem(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]+?)(\.[^./]*)?$", 1)


def parent_folder(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]+)/[^/]+$", 1)


def read_category_folders(spark: SparkSession, root: str, schema: T.StructType = CHAT) -> DataFrame:
    """Records one folder below root that have all three fields; _category is the folder's name."""
    rows = parsed(read_lines(spark, f"{root}/*/*.jsonl"), schema).where("NOT bad")
    keys = F.json_object_keys("line")
    complete = rows.where(F.size(F.array_except(F.array(*[F.lit(c) for c in EXAMPLE.names]), keys)) == 0)
    return complete.select("file", "line", "record.*", parent_folder(F.col("file")).alias("_category"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """stem, content, folder (the name of the file's): one row per text file."""
    file = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(file_stem(file).alias("stem"), F.col("value").alias("content"), parent_folder(file).alias("folder"))


def read_json_objects(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true").option("allowBackslashEscapingAnyCharacter", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def write_chat(rows: DataFrame, path: str) -> None:
    """messages, category, difficulty as JSON Lines."""
    rows.select([c for c in ("messages", "category", "difficulty") if c in rows.columns]).write.mode("overwrite").json(path)


def write_raw(rows: DataFrame, path: str) -> None:
    """Columns but those that open with an underscore."""
    rows.select([c for c in rows.columns if not c.startswith("_")]).write.mode("overwrite").json(path)


def write_telemetry(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, nullValue="None")


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=TELEMETRY, nullValue="None")


def response_examples(text: Column) -> Column:
    """array<struct<instruction, input, output>> of a model's answer: its lines that are JSON objects with all three keys, code fences taken off."""
    bare = lambda line: strip(F.replace(F.replace(line, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), bare), lambda line: line.startswith("{") & line.endswith("}"))
    wanted = F.array(*[F.lit(c) for c in EXAMPLE.names])
    whole = F.filter(lines, lambda line: F.size(F.array_except(wanted, F.coalesce(F.json_object_keys(line), F.array().cast("array<string>")))) == 0)
    return F.transform(whole, lambda line: F.from_json(line, EXAMPLE, {"allowBackslashEscapingAnyCharacter": "true"}))


def append_unseen(rows: DataFrame, path: str, key: Column, limit: int | None = None, group: str | None = None) -> int:
    """Append rows whose key the Parquet table at path lacks, one row a key; returns how many.

    limit: rows in the table, or of each value of the column ``group`` if that is named; those of the least keys come first.
    """
    spark = rows.sparkSession
    fresh = rows.withColumn("__key", key).dropDuplicates(["__key"])
    there = held = None
    try:
        seen = spark.read.parquet(path)
        there = seen.count()
        fresh = fresh.join(seen.select("__key").distinct(), "__key", "left_anti")
        held = seen.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__held")) if group else None
    except Exception as error:  # the table is not there yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
    if limit is not None and group:
        nth = F.row_number().over(Window.partitionBy(group).orderBy("__key"))
        fresh = fresh.withColumn("__nth", nth).where(F.col("__nth") <= limit)  # at most limit rows a group go on
        if held is not None:
            fresh = fresh.join(held, F.col(group).eqNullSafe(F.col("__group")), "left").where(F.col("__nth") <= limit - F.coalesce("__held", F.lit(0)))
        fresh = fresh.select(*rows.columns, "__key")
    elif limit is not None:
        fresh = fresh.orderBy("__key").limit(max(0, limit - (there or 0)))
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - (there or 0)
