"""Readers and writers of line-oriented corpus files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.unicode import unxz_udf, xz_udf
from textmill.sources.sink import open_folder, write_files

TOKEN_LINES = "file string, line_idx long, value string"


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_idx (from 0) and value of each line of text or .xz files; a file is a unit, malformed UTF-8 is replaced."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")
    text = F.when(F.col("file").endswith(".xz"), unxz_udf()(F.when(F.col("file").endswith(".xz"), F.col("content")))).otherwise(F.make_valid_utf8(F.decode("content", "utf-8")))
    lines = F.split(F.regexp_replace(text, "\n$", ""), "\n")
    return raw.select("file", F.posexplode(lines).alias("line_idx", "value")).withColumn("line_idx", F.col("line_idx").cast("long"))


def read_texts(spark: SparkSession, path: str, suffix: str = "*.txt") -> DataFrame:
    """path, stem and text of whole text files."""
    t = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).text(path, wholetext=True)
    return t.select(F.col("_metadata.file_path").alias("path"), _stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("text"))


def list_files(spark: SparkSession, path: str, suffix: str = "*.pdf") -> DataFrame:
    """path, stem and length of files; contents are not read."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).load(path)
    return t.select("path", _stem(F.col("path")).alias("stem"), "length")


def read_tagged_splits(spark: SparkSession, path: str) -> DataFrame:
    """tag and body of each document of tagged texts: the scan itself splits at </doc>, so files of any size work."""
    t = spark.read.option("lineSep", "</doc>").text(path).select(F.regexp_replace("value", r"^\s+", "").alias("v")).filter("v <> ''")
    return t.select(F.substring_index("v", "\n", 1).alias("tag"), F.expr("rtrim('\n', substring(v, length(substring_index(v, '\n', 1)) + 2))").alias("body"))


def read_sentence_languages(spark: SparkSession, path: str, first_row_lost: bool = False, files: bool = False) -> DataFrame:
    """line_idx and lang of a side file without a header (files: the file before them). first_row_lost: as if its first row were one."""
    return spark.read.csv(path, sep="\t", header=first_row_lost, schema=("file string, " if files else "") + "line_idx long, lang string")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="lemma string, tag string, gender_lemma string")


def read_vertical(spark: SparkSession, path: str) -> DataFrame:
    """file, line_idx, word, tag and lempos of the token lines."""
    t = read_lines(spark, path).filter(~F.trim("value").startswith("<") & (F.trim("value") != ""))
    cells = F.split("value", r"\s+")
    return t.select("file", "line_idx", *(F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(("word", "tag", "lempos"))))


def count_log_lines(spark: SparkSession, path: str, message: str) -> int:
    return spark.read.text(path).filter(F.col("value").contains(message)).count()


def read_config(path: str) -> dict:
    """A JSON or YAML file as a dictionary."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        import yaml

        return yaml.safe_load(f)


def write_batches(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """body lines of each batch to a folder batch=N."""
    df.select("batch", "body").write.mode("overwrite" if overwrite else "errorifexists").partitionBy("batch").text(path)


def write_named_batches(df: DataFrame, folder: str, stem: str, order: tuple[str, ...] = ("id", "file_id"), existing: str = "error", suffix: str = ".txt", threads: int = 1) -> list[str]:
    """body of each batch, in order, as the lines of one file <stem>.<batch><suffix>; returns the files' names. A suffix that ends
    in .xz compresses. The rules of `write_files` hold."""
    name = F.concat(F.lit(f"{stem}."), F.col("batch").cast("string"), F.lit(suffix))
    write_files(df, folder, name, "body", list(order), existing, threads)
    return [r.n for r in df.select("batch", name.alias("n")).distinct().orderBy("batch").collect()]  # a row for each file


def write_lines(lines: DataFrame, path: str, overwrite: bool = False, compression: str = "none", order: tuple[str, ...] = ("file", "line_idx")) -> None:
    """value in the order of the columns; a file's lines stay together."""
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("value").write.mode("overwrite" if overwrite else "errorifexists").option("compression", compression).text(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "append").csv(path, sep="\t", header=header)


def write_text(text: str, address: str) -> None:
    """A small file that the driver writes."""
    system, path = open_folder(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(text.encode())


def compress(df: DataFrame, text: str = "text") -> DataFrame:
    """A column of xz bytes beside the text."""
    return df.withColumn("xz", xz_udf()(F.col(text)))
