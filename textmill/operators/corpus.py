"""Tables of a corpus: upsert, attributes, export, attachments, frequency lists, subcorpora."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import nested as N
from textmill.functions import text as T
from textmill.plans.scratch import Scratch


def free_name(columns: list[str], name: str) -> str:
    """name, with as many marks after it as keep it apart from the columns."""
    while name.lower() in map(str.lower, columns):
        name += "_"
    return name


def upsert(old: DataFrame, new: DataFrame, *unique: list[str], order: str | None = None) -> DataFrame:
    """old with new's rows instead of those that share a unique key; later rows (by `order`) win within either.

    Each unique key is applied in turn, so a table can have several. A null in a key conflicts with nothing.
    """
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    for keys in unique:
        late = [F.col("_new").desc(), *([F.col(order).desc()] if order else [])]
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*late)))
        rows = ranked.filter((F.col("_rank") == 1) | ~whole).drop("_rank")
    return rows.drop("_new")


def update_column(table: DataFrame, key: str, values: DataFrame, column: str) -> DataFrame:
    """table with column taken from values (key, column) where there is a row for the key."""
    fresh = values.select(key, F.struct(column).alias("_v"))
    return table.join(fresh, key, "left").withColumn(column, F.when(F.col("_v").isNotNull(), F.col("_v")[column]).otherwise(F.col(column))).drop("_v")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: one aggregation, no sort of the groups."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*").select(*df.columns)


def explode_files(records: DataFrame, key: str = "id", files: str = "file") -> DataFrame:
    """One row for each attachment of each record; an attachment's id becomes file_id."""
    kind = records.schema[files].dataType.elementType
    each = records.filter(F.col(files).isNotNull()).select(F.col(key), F.explode(files).alias("f"))
    return each.select(key, F.col("f.id").alias("file_id"), *(F.col(f"f.{f.name}") for f in kind.fields if f.name != "id"))


def download_plan(attachments: DataFrame, present: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Attachments without a file of the right length in present(path_id, length); optionally a range of them by file_id."""
    todo = attachments.join(present.select("file_id", "length"), "file_id", "left").filter("length IS NULL OR length <> filesize").drop("length")
    if start is None and end is None:
        return todo
    ranked = global_positions(attachments.select("file_id"), ["file_id"], "_n")  # ids only
    return todo.join(ranked.filter(F.col("_n").between(start or 0, (end or 1 << 60) - 1)).select("file_id"), "file_id", "left_semi")


def to_extract(files: DataFrame, texts: DataFrame, overwrite: bool = False) -> DataFrame:
    """Files without an extracted text of the same stem."""
    return files if overwrite else files.join(texts.select("stem"), "stem", "left_anti")


def attributes(records: DataFrame, key: str = "id", multi: tuple[str, ...] = (), drop: tuple[str, ...] = (), known: tuple[str, ...] | None = None, normalize: Callable[[Column], Column] = T.remove_control) -> tuple[DataFrame, list[str]]:
    """(key, doc_tag) of flattened records, and the names that the catalogue doesn't know (left out).

    Lists are joined with | (multi) or nothing; null-like values go; white space collapses; date columns get years.
    """
    flat = N.flatten_records(records)
    unknown = [c for c in flat.columns if known is not None and c != key and c not in known]
    flat = N.year_columns(flat.drop(*drop, *unknown))
    values = {}
    for f in flat.schema.fields:
        if f.name == key:
            continue
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "array":
            c = N.list_join(c) if f.name in multi or len(multi) == 0 else N.list_join_plain(c)
        values[f.name] = F.trim(T.collapse_spaces(normalize(T.null_like(c.cast("string")))))
    pairs = [x for n, v in {key: F.col(key).cast("string"), "file_id": F.lit("FILE_ID"), **values}.items() for x in (F.lit(n), v)]
    return flat.select(key, T.start_tag(F.create_map(*pairs)).alias("doc_tag")), unknown


def export(texts: DataFrame, attrs: DataFrame, records: DataFrame, lang: str, least: float, start: str, end: str, per_file: int = 10_000) -> DataFrame:
    """Tagged texts in order of id and file_id, with the number of the output file.

    texts: id, file_id, lid, text; attrs: id, doc_tag; records: id, date. Kept: share of lang at least `least`, date within
    [start, end], text not blank. Only the keys are numbered, in a table that is written once.
    """
    texts = texts.withColumn("text", T.blank_to_null("text"))
    dated = records.filter(N.in_dates("date", start, end)).select("id")
    keys = texts.filter(F.coalesce(F.col("lid")[lang] >= least, F.lit(False)) & F.col("text").isNotNull()).select("id", "file_id")
    keys = batch_numbers(keys.join(dated, "id", "left_semi"), ["id", "file_id"], per_file)
    rows = texts.select("id", "file_id", "text").join(keys, ["id", "file_id"]).join(attrs, "id")
    return rows.select("id", "file_id", T.wrap_doc(T.fill_file_id("doc_tag", "file_id"), "text").alias("body"), "batch")


def observed(seen: Observation, name: str) -> int:
    """A count that was observed by an action that is over; 0 if its part of the plan had no rows and was left out while it ran."""
    try:
        return seen.get[name]
    except Py4JJavaError as e:
        if "assertion failed" not in str(e.java_exception):
            raise
        return 0


def with_counts(texts: DataFrame, seen: Observation, text: str = "text", tool: str | None = None) -> DataFrame:
    """texts with blank ones as null, and without rows that no tool has worked on (tool: its column). seen: observes, while the rows pass,
    how many there are (rows), blank (blank) and null before (missing), and how many have no tool (no_tool)."""
    c, tools = F.col(f"`{text}`"), F.lit(0) if tool is None else F.count_if(F.col(f"`{tool}`").isNull())
    counted = texts.observe(seen, F.count("*").alias("rows"), F.count_if(c.isNull()).alias("missing"), F.count_if(c.isNotNull() & T.blank_to_null(text).isNull()).alias("blank"), tools.alias("no_tool"))
    counted = counted.withColumn(text, T.blank_to_null(text))
    return counted if tool is None else counted.filter(F.col(f"`{tool}`").isNotNull())


def with_file_texts(docs: DataFrame, files: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """docs(id, file_id, …) with path and text: a text of its own where file_id is 0 (path null), else that of folder/id/file_id.txt in
    files(path, text), null where there is none. A path may begin with file: or not."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    other = F.coalesce(F.col("file_id") != 0, F.lit(False))
    found = files.select(plain(F.col("path")).alias("_path"), F.col("text").alias("_text"))
    met = docs.withColumn("path", F.when(other, T.text_path(folder, "id", "file_id"))).join(found, plain(F.col("path")) == F.col("_path"), "left")
    return met.withColumn(text, F.when(other, F.col("_text")).otherwise(F.col(f"`{text}`"))).drop("_path", "_text")


def global_positions(df: DataFrame, order: list[str], name: str = "pos", scratch: Scratch | None = None) -> DataFrame:
    """Each row's place (from 0) in a global order. Rows are spread by range, sorted and written once with their place in their
    partition; the counts of partitions, which alone meet in one place, are read from the same table, so no row can be
    counted in one partition and numbered in another.

    Rows that are equal in the order are told apart by a hash of their columns, so that they do not all meet in one task; equal rows
    come in any order. Nulls go first. Columns keep their names and types; an empty table gives no rows. scratch: where the table
    goes; by default one that lasts as long as the application.
    """
    row = free_name([*df.columns, name], "_row")
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    by = [F.col(f"`{c}`") for c in order] + [F.xxhash64(*hashed)]
    spread = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(row, F.monotonically_increasing_id())
    rows = (scratch or Scratch(df.sparkSession)).table(spread, f"rows{uuid.uuid4().hex}", "zstd")
    # the number has the partition above 33 bits of place
    part, number, before = F.shiftright(F.col(row), 33), free_name([*df.columns, name], "_part"), free_name([*df.columns, name], "_before")
    counts = rows.groupBy(part.alias(number)).agg(F.count("*").alias("_n"))
    offsets = counts.select(number, F.coalesce(F.sum("_n").over(W.orderBy(number).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(before))
    found = rows.join(F.broadcast(offsets), part == F.col(number), "left")  # a row for each partition
    place = F.col(before) + F.col(row).bitwiseAND((1 << 33) - 1)
    return found.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce(place, F.raise_error(F.lit("a row of a partition without a count"))).cast("long").alias(name))


def batch_numbers(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """batch (from 1): consecutive runs of `size` rows in the order."""
    pos = free_name(df.columns, "_pos")
    return global_positions(df, order, pos).withColumn("batch", (F.floor(F.col(pos) / size) + 1).cast("long")).drop(pos)


def equal_groups(df: DataFrame, keys: list[str], order: list[str], n: Column | int) -> DataFrame:
    """group (from 0) within keys: n groups of nearly equal size, the first ones larger."""
    w = W.partitionBy(*keys)
    pos, rows = F.row_number().over(w.orderBy(*order)) - 1, F.count("*").over(w)
    n = F.lit(n) if isinstance(n, int) else n
    small, extra = F.floor(rows / n), rows % n
    group = F.when(pos < extra * (small + 1), F.floor(pos / (small + 1))).otherwise(extra + F.floor((pos - extra * (small + 1)) / F.greatest(small, F.lit(1))))
    return df.withColumn("group", group.cast("long"))


def unique_attribute_names(tags: DataFrame, tag: str) -> DataFrame:
    return tags.select(F.explode(T.attribute_names(tag)).alias("name")).distinct()


def frequency(df: DataFrame, *columns: Column, name: str = "item") -> DataFrame:
    """How often each value of a column, and of each further attribute, occurs."""
    return df.groupBy(*(c.alias(name if k == 0 else f"{name}{k}") for k, c in enumerate(columns))).agg(F.count("*").alias("freq"))


def multivalue_counts(df: DataFrame, column: str, by: list[str], sep: str = "|") -> DataFrame:
    """Rows for each value of a multi-valued attribute and each further attribute."""
    return df.select(*by, F.explode(F.split(column, F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))).alias(column)).groupBy(*by, column).agg(F.count("*").alias("freq"))


def subcorpora(lang: str = "en", others: tuple[str, ...] = ("es", "fr")) -> dict[str, Column]:
    """Named predicates over documents and sentences. A sentence without a language belongs to the corpus's own."""
    source, file_id, found = F.coalesce(F.col("source__name"), F.lit("")), F.col("file_id").cast("string"), F.coalesce(F.col("lang"), F.lit(""))
    return {
        "doc_html": file_id == "0",
        "doc_pdf": file_id != "0",
        "source_multi": source.contains("|"),
        "source_single": ~source.contains("|"),
        f"lang_{lang}": ~found.isin(*others),
        **{f"lang_{x}": found == x for x in others},
    }


def missing_rates(df: DataFrame) -> DataFrame:
    """attribute, missing (share of nulls) and example for each column, in one pass."""
    cells = F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(f"`{c}`").cast("string").alias("v")) for c in df.columns))
    return df.select(F.explode(cells).alias("c")).groupBy("c.attribute").agg(F.avg(F.col("c.v").isNull().cast("double")).alias("missing"), F.min("c.v").alias("example"))


def corpus_size(tokens: DataFrame, doc: str) -> DataFrame:
    return tokens.agg(F.count("*").alias("tokens"), F.countDistinct(doc).alias("docs"))


def concat_texts(df: DataFrame, order: list[str], raw: str, min_len: int = 10) -> DataFrame:
    """Each text with its raw and its cleaned lines, as two elements of an XML line stream."""
    clean = F.array_join(F.filter(F.transform(F.split(raw, "\n"), lambda x: T.clean_line(x)), lambda x: F.char_length(x) >= min_len), "\n")
    body = F.concat(F.lit("<raw>\n"), F.col(raw), F.lit("\n</raw>\n<clean>\n"), clean, F.lit("\n</clean>"))
    return df.select(*order, body.alias("body")).orderBy(*order)
