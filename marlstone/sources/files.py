"""Files as tables: JSON lines, whole texts, layouts and candidates. Reading is Spark's, so any path it knows will
do. Every row carries the name of its file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import strip, text_of
from ..functions.text import first_filled, subject_of
from ..operators.rows import core_then_selective, take_lowest

_BAD = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines and those that are not JSON objects of the schema are skipped."""
    full = T._parse_datatype_string(schema).add(_BAD, "string")
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).json(path)
    return rows.where(F.col(_BAD).isNull()).drop(_BAD)


def read_jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; the first bad one raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file, line_number (from 1), row (null if it cannot be parsed), error (the line then)."""
    lines = read_texts(spark, path).select("file", F.posexplode(F.split("text", "\r?\n")).alias("n", "line")).where(strip(F.col("line")) != "")
    row = F.from_json("line", schema, {"mode": "PERMISSIVE"})
    good = F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT")
    return lines.select("file", (F.col("n") + 1).alias("line_number"), F.when(good, row).alias("row"), F.when(~F.coalesce(good, F.lit(False)), F.col("line")).alias("error"))


def read_texts(spark: SparkSession, path: str, errors: str = "replace") -> DataFrame:
    """file, name (without folder and suffix), text: one row per file. errors: replace or ignore bad UTF-8."""
    rows = spark.read.format("binaryFile").load(path)
    good = F.make_valid_utf8(F.col("content").cast("string"))
    text = F.replace(good, F.lit("�"), F.lit("")) if errors == "ignore" else good
    # A replacement character that a file holds itself is kept where nothing else was bad.
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(text)
    return rows.select(F.col("path").alias("file"), file_stem(F.col("path")).alias("name"), text.alias("text"))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), "(?<=.)\\.[^.]*$", "")


def pick_files(texts: DataFrame, match: str | None = None, limit: int | None = None) -> DataFrame:
    """Files whose names hold match, in any case; the first by name."""
    out = texts if not match else texts.where(F.contains(F.lower("name"), F.lit(match.lower())))
    return out.orderBy("name").limit(limit) if limit else out


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of files that are JSON arrays; other files give nothing. Columns: file, and the schema's."""
    arrays = F.from_json("text", f"array<struct<{schema}>>", {"mode": "PERMISSIVE"})
    is_array = F.schema_of_variant(F.try_parse_json("text")).startswith("ARRAY")
    return read_texts(spark, path).where(is_array).select("file", F.explode(arrays).alias("r")).select("file", "r.*")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_first(spark: SparkSession, *candidates: str) -> DataFrame:
    """The first Parquet path that exists."""
    for path in candidates:
        if exists(spark, path):
            return spark.read.parquet(path)
    raise FileNotFoundError(f"none of {', '.join(candidates)}")


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """name, text, group, subject of a folder of texts: those in the folder itself; else the core texts, cleaned
    where there is a cleaned copy, and the selective ones that are not core; else all below it."""
    texts = lambda p: read_texts(spark, p).select("name", "text")
    if exists(spark, f"{path}/*.txt"):
        out = texts(f"{path}/*.txt").withColumn("group", F.lit("mixed"))
    else:
        none = spark.createDataFrame([], "name string, text string")
        part = lambda d: texts(f"{path}/{d}/*.txt") if exists(spark, f"{path}/{d}/*.txt") else none
        core, selective = part("core_cpt_text"), part("selective_cpt_text")
        if exists(spark, f"{path}/core_cpt_text/*.txt") or exists(spark, f"{path}/selective_cpt_text/*.txt"):
            out = core_then_selective(core, part("core_cpt_text_cleaned"), selective)
        else:
            rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").option("wholetext", "true").text(path)
            out = rows.select(file_stem(F.col("_metadata.file_path")).alias("name"), F.col("value").alias("text"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("group"))
    return out.withColumn("subject", subject_of(F.concat("name", F.lit(".txt"))))


def read_records(spark: SparkSession, path: str, group: str, text_field: str = "text", source_field: str = "source") -> DataFrame:
    """text, source, group, subject of JSON lines with text: a missing source is the file's stem and the line's
    number among all lines; missing group and subject are defaulted."""
    fields = dict.fromkeys([text_field, source_field, "id", "group", "subject"])
    rows = read_jsonl_numbered(spark, path, ", ".join(f"`{f}` string" for f in fields))
    number = F.format_string("%s_%08d", file_stem(F.col("file")), F.col("line_number") - 1)
    get = lambda f: F.nullif(F.col("row")[f], F.lit(""))
    source = F.coalesce(get(source_field), get("id"), number)
    rows = rows.where(strip(text_of(F.col("row")[text_field])) != "")
    return rows.select(F.col("row")[text_field].alias("text"), source.alias("source"), F.coalesce(get("group"), F.lit(group)).alias("group"), F.coalesce(get("subject"), subject_of(source)).alias("subject"))


def image_records(images: DataFrame, path_col: str = "path") -> DataFrame:
    """book, image, image_index, image_count: images below a book's folder in natural order."""
    from pyspark.sql import Window

    from ..functions.text import natural_key

    rows = images.select(F.element_at(F.split(path_col, "/"), -2).alias("book"), F.substring_index(path_col, "/", -1).alias("image"))
    w = Window.partitionBy("book")
    return rows.select("book", "image", F.row_number().over(w.orderBy(natural_key(F.col("image")))).alias("image_index"), F.count("*").over(w).alias("image_count"))


def carve(df: DataFrame, key: str, share: float = 0.01, least: int = 100, seed: str = "42") -> DataFrame:
    """df with split: max(least, int(n * share)) rows at random are val."""
    from ..operators.rows import draw

    total = df.count()
    out = take_lowest(df, draw(seed, F.col(key)), min(total, max(least, int(total * share))), total)
    return out.withColumn("split", F.when(F.col("taken"), "val").otherwise("train")).drop("taken")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "first_filled")]
