"""Commands over files: python -m textmill COMMAND ...

normalize   text lines from stdin or a folder, cleaned
export      texts of a language and a range of dates to named files
annotate    text files with markup to vertical files, by a plug-in
update      export and annotate the texts of languages and of a range of dates
to-conll    tagged text files to CoNLL-U
to-vert     CoNLL-U to vertical
verify      documents in files of several formats
langid      sentence languages of vertical files, as a side table
enrich      references, sentence languages and file wrappers in vertical files
compare     taggings of vertical files against the first: tables and a report
"""

from __future__ import annotations

import argparse
import datetime
import importlib
import sys
from collections.abc import Callable
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions import unicode as U
from textmill.operators import align as A
from textmill.operators import annotate as N
from textmill.operators import compare as C
from textmill.operators import corpus as O
from textmill.operators import langid as L
from textmill.operators import tokens as K
from textmill.plans.scratch import Scratch
from textmill.sources import files


def to_conll(spark: SparkSession, source: str, wrap: bool = False, normalize: bool = False, annotator: Callable[[], N.Annotator] | None = None) -> DataFrame:
    """CoNLL-U lines (file: a document's key, line_idx, value) of tagged texts, in the order of id and file_id; every document is
    one of its own. wrap: join hyphenated line ends; normalize: clean each line first; annotator: makes a plug-in, which sees no
    markup; by default rules in built-in expressions, which take markup for text."""
    docs = files.read_tagged_splits(spark, source)
    body = U.normalize_udf()("body") if normalize else F.col("body")
    attrs = T.tag_attributes("tag")
    part = lambda n: F.lpad(F.coalesce(attrs[n], F.lit("")), 20, " ")
    docs = docs.select(F.concat(part("id"), part("file_id"), F.xxhash64("tag", "body").cast("string")).alias("doc_id"), (T.join_hyphenated(body) if wrap else body).alias("text"))
    tokens = K.annotate(docs) if annotator is None else N.tokens_of(N.annotate(docs, annotator))
    lines = K.render_conllu(tokens, "doc_id").withColumnRenamed("doc_id", "file")
    names = (F.trim(F.substring("file", 1, 20)), F.trim(F.substring("file", 21, 20)))
    head = F.concat(F.lit("# newdoc id="), names[0], F.when(names[1] != "", F.concat(F.lit(" file_id="), names[1])).otherwise(""))
    return lines.withColumn("value", F.when(F.col("line_idx") == 0, head).otherwise(F.col("value")))


def plug_in(name: str | None) -> Callable[[], N.Annotator] | None:
    """What module:name names."""
    if not name:
        return None
    module, _, what = name.partition(":")
    return getattr(importlib.import_module(module), what)


def to_vertical(lines: DataFrame) -> DataFrame:
    """Vertical lines (file, line_idx, value) of CoNLL-U lines: structures in tags, multi-word tokens spliced.

    Each token and each start of a document carries the tags around it, and a running count numbers the lines; no document is held as
    a whole. A document without sentences is closed; tokens before the first document go.
    """
    tokens = K.splice_multiword(K.parse_conllu(lines), ["file", "doc_seq", "sent_seq"]).filter("doc_seq >= 0")
    items = tokens.select("file", "line_idx", F.struct("doc_seq", "sent_seq").alias("sent"), F.concat_ws("\t", *K.CONLLU).alias("value"))
    starts = lines.filter(F.col("value").startswith("# newdoc"))
    attrs = F.regexp_replace(F.regexp_replace("value", r"^# newdoc\s*", ""), r"(\w+)\s*=\s*([^\"'\s]+)", '$1="$2"')
    items = items.unionByName(starts.select("file", F.col("line_idx").cast("long"), F.lit(None).cast(items.schema["sent"].dataType).alias("sent"), F.concat(F.lit("<doc "), attrs, F.lit(" >")).alias("value")))
    w = W.partitionBy("file").orderBy("line_idx")
    items = items.select("*", F.lag("sent").over(w).alias("old"), F.lead("sent").over(w).alias("new"))
    is_token, opens = F.col("sent").isNotNull(), F.concat(F.lit('<s id="'), F.col("sent.sent_seq").cast("string"), F.lit('">'))
    parts = F.array(F.when(is_token & ~F.col("old").eqNullSafe(F.col("sent")), opens), F.col("value"), F.when(is_token & ~F.col("new").eqNullSafe(F.col("sent")), "</s>"), F.when(F.col("new").isNull(), "</doc>"))
    items = items.select("file", "line_idx", F.filter(parts, lambda x: x.isNotNull()).alias("parts"))
    before = F.sum(F.size("parts")).over(w.rowsBetween(W.unboundedPreceding, 0)) - F.size("parts")
    items = items.withColumn("before", before).select("file", "before", F.posexplode("parts").alias("k", "value"))
    return items.select("file", (F.col("before") + F.col("k")).cast("long").alias("line_idx"), "value")


def vertical_tokens(lines: DataFrame) -> DataFrame:
    """file, start (line of the sentence's tag), pos, word and tag of the tokens of vertical lines."""
    starts = F.when(F.col("value").rlike(r"^<s[ >]"), F.col("line_idx"))
    t = lines.withColumn("start", F.last(starts, ignorenulls=True).over(W.partitionBy("file").orderBy("line_idx")))
    cells = F.split("value", "\t")
    return t.filter(~F.col("value").startswith("<") & F.col("start").isNotNull()).select("file", "start", F.col("line_idx").alias("pos"), F.get(cells, F.lit(1)).alias("word"), F.get(cells, F.lit(3)).alias("tag"))


def sentence_languages(lines: DataFrame, short: int = 4, long: int = 500) -> DataFrame:
    return L.sentence_languages(vertical_tokens(lines), ["file", "start"], short=short, long=long).withColumnRenamed("start", "line_idx")


def enrich(lines: DataFrame, languages: DataFrame | None = None, doc_n: int = 1, docx_n: int = 1, random: bool = False) -> DataFrame:
    """Vertical lines with document references, sentence languages, and a wrapper for each file."""
    if languages is not None:
        lines = K.add_sentence_language(lines, languages)
    starts = K.number_documents(lines.filter(F.col("value").startswith("<doc ")).select("file", "line_idx"), ["file", "line_idx"], doc_n, random)
    lines = lines.join(starts, ["file", "line_idx"], "left")
    lines = lines.withColumn("value", F.when(F.col("ref").isNotNull(), K.update_tag(F.col("value"), {"ref": F.col("ref")})).otherwise(F.col("value"))).drop("ref")
    names = K.number_documents(lines.select("file").distinct(), ["file"], docx_n, random)
    return K.wrap_files(lines, names.withColumn("name", F.regexp_extract("file", r"([^/]+)$", 1)))


def check_date(text: str) -> str:
    """A date written YYYY-MM-DD."""
    try:
        if datetime.date.fromisoformat(text).isoformat() == text:
            return text
    except ValueError:
        pass
    raise argparse.ArgumentTypeError(f"{text} is no date of the form YYYY-MM-DD")


def export_files(spark: SparkSession, tables: str, out: str, lang: str, stem: str = "corpus", least: float = 0.8, start: str = "1900-01-01", end: str = "2100-12-31", per_file: int = 10_000, texts_dir: str | None = None, existing: str = "error", suffix: str = ".txt", threads: int = 1) -> list[str]:
    """Tagged texts of a language in files <stem>_<lang>_<start>_<end>.<n><suffix> of `per_file` texts, in order of id and file_id.

    tables: a folder with Parquet tables texts (id, file_id, lid, text), attrs (id, doc_tag) and records (id, date). texts_dir: where
    texts of attachments are, as id/file_id.txt.
    """
    texts, attrs, records = (spark.read.parquet(f"{tables}/{t}") for t in ("texts", "attrs", "records"))
    if texts_dir:
        texts = O.with_file_texts(texts, files.read_texts(spark, texts_dir), texts_dir).drop("path")
    rows = O.export(texts, attrs, records, lang, least, start, end, per_file)
    return files.write_named_batches(rows, out, f"{stem}_{lang}_{start}_{end}", ("id", "file_id"), existing, suffix, threads)


def write_each(lines: DataFrame, out: str, suffix: str, force: bool = False, compress: bool = False, keep: bool = False, threads: int = 1) -> None:
    """Lines (file, line_idx, value) of each file as a file of its own: the stem of its name and the suffix; with .xz if compress is on,
    and also plain if keep is on too."""
    stem = F.regexp_extract("file", r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)
    for end in ([".xz"] if compress else []) + ([""] if keep or not compress else []):
        files.write_files(lines, out, F.concat(stem, F.lit(suffix + end)), "value", ["file", "line_idx"], "replace" if force else "error", threads)


def annotate_files(spark: SparkSession, source: str, out: str, annotator: Callable[[], N.Annotator] | None = None, sentences: bool = True, existing: str = "error", suffix: str = ".vert", threads: int = 1) -> None:
    """Each text file of a folder as a vertical file <stem><suffix>: tokens of an annotator (by default rules), with the markup of the text
    between them. sentences: put <s> and </s> around sentences."""
    texts = files.read_texts(spark, source)
    lines = N.vertical_lines(N.annotate(texts, annotator or N.Rules, "path"), "path")
    if not sentences:
        lines = lines.filter(~F.col("value").isin("<s>", "</s>"))
    stem = F.regexp_extract("path", r"([^/]+?)\.txt(?:\.xz)?$", 1)
    files.write_files(lines, out, F.concat(stem, F.lit(suffix)), "value", ["seq", "part"], existing, threads)


def update(spark: SparkSession, tables: str, out: str, languages: list[str], start: str, end: str, stem: str = "corpus", annotator: Callable[[], N.Annotator] | None = None, existing: str = "error", threads: int = 1, **options) -> dict[str, list[str]]:
    """For each language: what `export_files` exports of a range of dates, below out/<lang>/text, and its annotation below out/<lang>/vertical, as .vert.xz.
    Returns the text files; a language without texts has none, and no annotation."""
    done = {}
    for lang in languages:
        done[lang] = export_files(spark, tables, f"{out}/{lang}/text", lang, stem, start=start, end=end, existing=existing, **options)
        if done[lang]:
            annotate_files(spark, f"{out}/{lang}/text", f"{out}/{lang}/vertical", annotator, existing="replace" if existing == "append" else existing, suffix=".vert.xz", threads=threads)
    return done


def document_tokens(lines: DataFrame) -> DataFrame:
    """doc (id and file_id of the document's tag), pos, word and tag of the tokens of vertical lines, which have word, tag in the
    columns 2 and 4; or in 1 and 2 if there are fewer. The files of a folder are one corpus."""
    tags = T.tag_attributes("value")
    start = F.when(F.col("value").rlike(r"^<doc[ >]"), F.concat_ws("/", tags["id"], tags["file_id"]))
    t = lines.withColumn("doc", F.last(start, ignorenulls=True).over(W.partitionBy("file").orderBy("line_idx")))
    cells = F.split("value", "\t")
    wide, cell = F.size(cells) >= 4, lambda k: F.get(cells, F.lit(k))
    t = t.filter(~F.trim("value").startswith("<") & (F.trim("value") != ""))
    return t.select("doc", "file", F.col("line_idx").alias("pos"), F.when(wide, cell(1)).otherwise(cell(0)).alias("word"), F.when(wide, cell(3)).otherwise(cell(1)).alias("tag"))


def compare(spark: SparkSession, sources: list[str], out: str | None = None, mapping: str | None = None, tagsets: list[str] | None = None) -> str:
    """Every tagging against the first one, by document: tables tags, and differences, pairs, ignored and errors of each, as TSV below out,
    and the report, which is returned.

    mapping: a file that has for each tagset a table from tags to what they are compared as (a name, or upos: a name).
    """
    names = [f"{k}-{PurePath(s).name}" for k, s in enumerate(sources)]
    frames = {n: document_tokens(files.read_lines(spark, s)) for n, s in zip(names, sources, strict=True)}
    if mapping:
        known = files.read_config(mapping)
        rows = [(s, t, v.get("upos") if isinstance(v, dict) else v) for s, table in known.items() for t, v in table.items()]
        table = spark.createDataFrame([r for r in rows if r[2]], "tagset string, tag string, upos string")
        frames = {n: C.map_tags(f, table, s).drop("tag").withColumnRenamed("upos", "tag") for (n, f), s in zip(frames.items(), tagsets or list(known), strict=True)}
    first, *rest = names
    tags = C.tag_counts(frames)
    with Scratch(spark) as scratch:
        aligned = {n: scratch.table(A.align(frames[first], frames[n], "doc", ("file", "pos")), f"aligned{k}") for k, n in enumerate(rest)}
        text = A.report(aligned, tags, "doc")
        if out:
            files.write_tsv(tags, f"{out}/tags", True, True)
            for n, a in aligned.items():
                d = A.differences(a)
                for name, df in (("differences", d), ("pairs", A.difference_pairs(d)), ("ignored", A.ignored(a)), ("errors", A.error_rows(a, "doc"))):
                    files.write_tsv(df, f"{out}/{n}-{name}", True, True)
            files.write_text(text, f"{out}/report.md")
    return text


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="textmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    for name, paths in (("normalize", "?"), ("export", None), ("annotate", None), ("update", None), ("to-conll", None), ("to-vert", None), ("verify", "+"), ("langid", None), ("enrich", None), ("compare", "+")):
        c = sub.add_parser(name)
        c.add_argument("source", nargs=paths) if paths else c.add_argument("source")
        if name not in ("normalize", "verify", "compare"):
            c.add_argument("out")
            c.add_argument("--force", action="store_true", help="overwrite")
            c.add_argument("--compression", default="none")
            c.add_argument("--each", action="store_true", help="to-vert, enrich: a file for each file that is read")
            c.add_argument("--compress", action="store_true", help="with --each, or of an export: xz")
            c.add_argument("--keep", action="store_true", help="with --compress: plain files too")
            c.add_argument("-T", "--threads", type=int, default=1, help="threads that compress a file")
        if name == "normalize":
            c.add_argument("--out", help="a folder for a file of each file of a folder")
            c.add_argument("-f", "--normal-form", default="NFKC", choices=("NFKC", "NFC", "NFKD", "NFD"))
            c.add_argument("-t", "--tab", default="space", choices=("space", "tab", "none"))
            c.add_argument("-c", "--keep-chars", nargs="*", default=["200D"], help="controls to keep, in hexadecimal")
            c.add_argument("-n", "--new-line", default="unix", choices=("unix", "dos"))
            c.add_argument("-q", "--keep-quotes", action="store_true")
            c.add_argument("-a", "--keep-dashes", action="store_true")
            c.add_argument("-s", "--dont-strip", action="store_true")
            c.add_argument("-z", "--keep-empty", action="store_true")
            c.add_argument("-e", "--encoding", default="utf_8")
            c.add_argument("-d", "--decoding-errors", default="replace", choices=("replace", "ignore", "strict"))
        if name == "annotate":
            c.add_argument("-s", "--no-sentences", action="store_true", help="no sentence tags")
        if name in ("export", "update"):
            c.add_argument(*(("--lang",) if name == "export" else ("--langs",)), required=True, nargs=None if name == "export" else "+")
            c.add_argument("--stem", default="corpus")
            c.add_argument("--least", type=float, default=0.8)
            c.add_argument("--start", type=check_date, default="1900-01-01")
            c.add_argument("--end", type=check_date, default="2100-12-31")
            c.add_argument("--per-file", type=int, default=10_000)
            c.add_argument("--texts", help="a folder with texts of attachments")
            c.add_argument("--existing", default="error", choices=("error", "replace", "append"))
        if name == "to-conll":
            c.add_argument("--wrap", action="store_true")
            c.add_argument("--uninorm", action="store_true")
        if name in ("to-conll", "annotate", "update"):
            c.add_argument("--annotator", help="module:name of what makes an annotator")
        if name == "compare":
            c.add_argument("--out", help="a folder for tables and the report")
            c.add_argument("--mapping", help="a file with what the tags of each tagset are compared as")
            c.add_argument("--tagset", nargs="+", help="the tagset of each source")
        if name == "langid":
            c.add_argument("--short", type=int, default=4)
            c.add_argument("--long", type=int, default=500)
        if name == "enrich":
            c.add_argument("--langid")
            c.add_argument("--doc-n", type=int, default=1)
            c.add_argument("--docx-n", type=int, default=1)
            c.add_argument("--uuid", action="store_true")
    a = p.parse_args(args)
    if a.command == "normalize":
        chars = "".join(chr(int(x, 16)) for x in a.keep_chars)
        options = {"form": a.normal_form, "tab": {"space": " ", "tab": "\t", "none": ""}[a.tab], "keep": chars, "new_line": "\r\n" if a.new_line == "dos" else "\n", "keep_quotes": a.keep_quotes, "keep_dashes": a.keep_dashes, "strip": not a.dont_strip, "keep_empty": a.keep_empty}
        if not a.source:
            for line in sys.stdin.buffer:
                sys.stdout.write(U.normalize_text(line.decode(a.encoding, a.decoding_errors).rstrip("\n"), **options))
            return 0
    from textmill.plans.session import session, ship

    spark = SparkSession.getActiveSession() or session()
    ship(spark)
    lines = lambda x: files.read_lines(spark, x)
    if a.command == "normalize":
        rows = lines(a.source).withColumn("v", U.normalize_udf(**options)("value"))
        if a.out:
            rows = rows.filter("v <> ''").withColumn("value", F.regexp_replace("v", "\\n$", ""))
            write_each(rows, a.out, ".txt")
        else:
            for r in rows.orderBy("file", "line_idx").select("v").toLocalIterator():
                sys.stdout.write(r.v)
    elif a.command == "export":
        existing = "replace" if a.force else a.existing
        for suffix in ([".txt.xz"] if a.compress else []) + ([".txt"] if a.keep or not a.compress else []):
            print(*export_files(spark, a.source, a.out, a.lang, a.stem, a.least, a.start, a.end, a.per_file, a.texts, existing, suffix, a.threads), sep="\n")
    elif a.command == "annotate":
        annotate_files(spark, a.source, a.out, plug_in(a.annotator), not a.no_sentences, "replace" if a.force else "error", ".vert.xz" if a.compress else ".vert", a.threads)
    elif a.command == "update":
        done = update(spark, a.source, a.out, a.langs, a.start, a.end, a.stem, plug_in(a.annotator), "replace" if a.force else a.existing, a.threads, least=a.least, per_file=a.per_file, texts_dir=a.texts)
        print(*(f"{lang}\t{len(names)}" for lang, names in done.items()), sep="\n")
    elif a.command == "to-conll":
        found = to_conll(spark, a.source, a.wrap, a.uninorm, plug_in(a.annotator))
        files.write_lines(found, a.out, a.force, a.compression)
    elif a.command == "to-vert":
        found = to_vertical(lines(a.source))
        if a.each:
            write_each(found, a.out, ".vert", a.force, a.compress, a.keep, a.threads)
        else:
            files.write_lines(found, a.out, a.force, a.compression)
    elif a.command == "langid":
        files.write_tsv(sentence_languages(lines(a.source), a.short, a.long).select("file", "line_idx", "lang"), a.out, overwrite=a.force)
    elif a.command == "enrich":
        names = lines(a.source)
        langs = files.read_sentence_languages(spark, a.langid, files=True) if a.langid else None
        found = enrich(names, langs, a.doc_n, a.docx_n, a.uuid)
        if a.each:
            write_each(found, a.out, ".vert", a.force, a.compress, a.keep, a.threads)
        else:
            files.write_lines(found, a.out, a.force, a.compression)
    elif a.command == "verify":
        counts = [lines(x).filter(F.col("value").rlike(r"^(<doc |# newdoc)")).count() for x in a.source]
        print(dict(zip(a.source, counts, strict=True)))
        return int(len(set(counts)) > 1)
    else:
        sys.stdout.write(compare(spark, a.source, a.out, a.mapping, a.tagset))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
