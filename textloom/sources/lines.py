"""Line numbers of text files that are read in many splits, and validation reports by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions.text import or_empty, strip

FIELDS = ("instruction", "input", "output")
FENCE = "```"
BLOCK = ["file", "block"]
#: Counts of splits are broadcast up to this many splits, 200 bytes or so each; beyond, Spark joins by a shuffle of the lines.
BROADCAST_SPLITS = 100_000


def _blocks_of(lines: DataFrame) -> DataFrame:
    """The lines with file, block (byte where their split starts) and at, which ascends within a split."""
    return lines.withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "at": F.monotonically_increasing_id()})


def numbered_lines(spark: SparkSession, path: str, across: bool = False, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """file, line_number (from 1) and line of every line, blank ones too; across: numbers go on from file to file, by name.

    Files are cut into splits as Spark likes and read twice: first the lines of each split are counted,
    then a line's number is its place in its split after all lines of earlier splits. Up to
    BROADCAST_SPLITS splits nothing but a row a split is shuffled, and no row holds a file. Lines end with \\n, \\r\\n or \\r; compressed files are one
    split. Should both reads be cut differently, or a file change between them, the query fails rather
    than giving wrong numbers.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    lines = _blocks_of((reader.option("pathGlobFilter", glob) if glob else reader).text(path))
    counts = lines.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).checkpoint()
    order = Window.orderBy("file", "block") if across else Window.partitionBy("file").orderBy("block")  # a row a split
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("file").alias("__file"), F.col("block").alias("__block"), "n", "first", before.alias("before"))
    few = counts.count() <= BROADCAST_SPLITS
    joined = lines.join(F.broadcast(starts) if few else starts, (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")), "left")
    place = F.col("at") - F.col("first")
    checked = F.when(place.between(0, F.col("n") - 1), F.col("before") + place + 1).otherwise(F.raise_error(F.lit("the files were cut into other splits when they were read again")).cast("long"))
    return joined.select("file", checked.alias("line_number"), F.col("value").alias("line"))


def checked_lines(lines: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """file, line_number, valid, hash, errors, fenced of lines that are not blank, written once: a small row a line goes on.

    valid: the line is a JSON object; hash: MD5 of the fields' values as text, null ones empty, and null if
    not valid; errors: one alone if not valid, else for each field in turn missing, empty (null or blank) or no
    text; fenced: a field holds a code fence. Each line is parsed once, into a variant, which tells an absent
    field, a null and a value that is no text apart.
    """
    bare = lines.withColumn("line", strip(or_empty(F.col("line")))).where("line <> ''")
    parsed = bare.withColumn("record", F.try_parse_json("line"))
    parsed = parsed.withColumn("valid", F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False)))
    parsed = parsed.withColumns({f"value_{k}": F.when(F.col("valid"), F.variant_get("record", f"$.{f}", "variant")) for k, f in enumerate(fields)}).drop("line", "record")
    parsed = parsed.withColumns({f"text_{k}": F.try_variant_get(f"value_{k}", "$", "string") for k in range(len(fields))})
    checks = [F.when(~F.col("valid"), F.lit("Invalid JSON"))]
    for k, field in enumerate(fields):
        value, text = F.col(f"value_{k}"), F.col(f"text_{k}")
        is_text = F.schema_of_variant(value) == "STRING"
        empty = F.is_variant_null(value) | (is_text & (strip(or_empty(text)) == ""))
        checks.append(F.when(F.col("valid"), F.when(value.isNull(), f"Missing field '{field}'").when(empty, f"Empty field '{field}'").when(~is_text, f"Field '{field}' is no text")))
    texts = [or_empty(F.col(f"text_{k}")) for k in range(len(fields))]
    fenced = F.exists(F.array(*texts), lambda t: F.contains(t, F.lit(FENCE)))
    return parsed.select("file", "line_number", "valid", F.when(F.col("valid"), F.md5(F.concat(*texts))).alias("hash"), F.array_compact(F.array(*checks)).alias("errors"), fenced.alias("fenced")).checkpoint()


def with_repeats(checked: DataFrame, by: tuple[str, ...] = ("file",)) -> DataFrame:
    """checked lines with repeats: whether an earlier line of the same ``by`` has the same hash. Only those, number and hash are shuffled for it."""
    names = [*by, "hash"]
    first = checked.where("hash IS NOT NULL").groupBy(*[F.col(c).alias(f"__{c}") for c in names]).agg(F.min("line_number").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    found = checked.join(first, [F.col(c) == F.col(f"__{c}") for c in names], "left")
    return found.withColumn("repeats", F.coalesce(F.col("line_number") > F.col("__first"), F.lit(False))).drop("__first", "__n", *[f"__{c}" for c in names])


def errors_of(checked: DataFrame) -> DataFrame:
    """file, line_number, errors of lines with_repeats, in the order of the checks; repeated content and code fences come last. Lines without errors have none."""
    repeated = F.when(F.col("repeats"), F.concat(F.lit("Duplicate content (hash: "), F.substring("hash", 1, 8), F.lit(")")))
    more = F.array_compact(F.array(repeated, F.when(F.col("fenced"), "Contains markdown code fences")))
    return checked.select("file", "line_number", F.concat("errors", more).alias("errors"))


def folder_summary(checked: DataFrame, folder: Column) -> DataFrame:
    """folder, files, lines, valid, duplicates of lines with_repeats."""
    return checked.groupBy(folder.alias("folder")).agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("lines"), F.count_if("valid").alias("valid"), F.count_if("repeats").alias("duplicates"))
