"""Spelling variants: a symmetric-delete join of the words of a corpus, and the roots that their forms lead to.

Every word emits itself and its distinct single deletions. A deletion that equals a word joins the two (one letter inserted
or deleted); deletions that keep the place of the gap join words that differ in that letter only (one letter replaced). Both
joins are equi-joins on the key, and their pairs are verified. Only the deletions make pairs, at most one for each letter of
a word. Words that share a gap are not paired with each other: each meets a summary of the gap (how many words share it
and its two most frequent ones), of which there are at most as many as the alphabet has letters. So all rows grow with
the vocabulary, which the corpus is reduced to by one pre-aggregated count.

A word's form is its most frequent near word if that is `ratio` times as frequent. Frequencies rise along forms, so they end
in a root: pointers are doubled by joins until none moves, after as many rounds as the logarithm of the longest chain has.

Defined results: null and empty texts have no words; a null key counts as an empty string; equal rows, and rows with equal keys,
each count; ties between forms go to the smallest word in code-point order; an empty table gives no rows; other columns are
ignored. A text is one value of a row: its words are an array while the row is read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, merge_join

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST, RATIO = 6, 5, 5
#: What stands for the place of a deletion; no letter.
GAP = "_"


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case. Only words with other capitals need more than the lower case of all letters."""
    return F.when(word.rlike("[À-Þ]"), F.translate(word, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(word))


def without(word: Column, place: Column) -> Column:
    """word without its code point at place (from 0)."""
    return F.concat(word.substr(F.lit(1), place), word.substr(place + 2, F.char_length(word)))


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """word and n of the words that have `shortest` letters or more and occur at least `least` times.

    change: what becomes of a run of letters, given its row's key and the run; it may not lengthen it.
    """
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    words = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    words = words.select("key", lower_ascii(F.col("run")).alias("run"))
    words = words.select((change(F.col("key"), F.col("run")) if change else F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def deletions(words: DataFrame) -> DataFrame:
    """word, n and key: the distinct words that a single deletion leaves."""
    places = F.sequence(F.lit(0), F.char_length("word") - 1)
    return words.select("word", "n", F.explode(F.array_distinct(F.transform(places, lambda p: without(F.col("word"), p)))).alias("key"))


def gaps(words: DataFrame) -> DataFrame:
    """word, n and gap: each single deletion, with its place marked."""
    places = F.sequence(F.lit(0), F.char_length("word") - 1)
    each = F.transform(places, lambda p: F.concat(F.col("word").substr(F.lit(1), p), F.lit(GAP), F.col("word").substr(p + 2, F.char_length("word"))))
    return words.select("word", "n", F.explode(each).alias("gap"))


def _near(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and best (minus its n, and the word): how many words are near a word, and the most frequent of them.

    words: word, n; each word once. Words that have no near word are left out.
    """
    rank = lambda n, w: F.struct((-F.col(n)).alias("m"), F.col(w).alias("w"))  # noqa: E731  the least is the best
    other = words.select(F.col("word").alias("key"), F.col("n").alias("key_n"))
    pairs = merge_join(deletions(words), other, "key").filter(_near("word", "key"))
    both = F.explode(F.array(F.struct(F.col("word"), rank("key_n", "key").alias("best")), F.struct(F.col("key").alias("word"), rank("n", "word").alias("best"))))
    by_deletion = pairs.select(both.alias("r")).select("r.word", F.lit(1).cast("long").alias("others"), "r.best")

    members = gaps(words)
    two = F.slice(F.array_sort(F.collect_list(rank("n", "word"))), 1, 2)
    summary = members.groupBy("gap").agg(F.count("*").alias("size"), two.alias("two")).filter("size > 1")
    met = merge_join(members, summary, "gap").withColumn("best", F.when(F.col("two")[0]["w"] == F.col("word"), F.col("two")[1]).otherwise(F.col("two")[0]))
    by_gap = met.filter(_near("word", "best.w")).select("word", (F.col("size") - 1).alias("others"), "best")
    return by_deletion.unionByName(by_gap).groupBy("word").agg(F.sum("others").alias("n_near"), F.min("best").alias("best"))


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word and root of forms(word, form), followed to the end; forms may not run in circles."""
    steps, turn = scratch.table(forms.select("word", F.col("form").alias("root")), "steps0"), 0
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        turn += 1
        moved = scratch.table(merge_join(steps, ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), f"steps{turn}")
        if not moved.filter("moved").limit(1).count():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


def group_spellings(words: DataFrame, scratch: Scratch, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of words(word, n). form: the most frequent near word if its n is `ratio` times
    the word's or more; root: where forms lead, the word itself if it has none."""
    words = scratch.table(words.select("word", "n"), "words")
    found = merge_join(words, near_words(words), "word", "left")
    enough = -F.col("best.m") >= ratio * F.col("n")
    found = scratch.table(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("best.w")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "forms")
    roots = follow(found.filter("form IS NOT NULL").select("word", "form"), scratch)
    return merge_join(found, roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of all texts; runs whose checksum 199 divides lose a letter first."""

    def thin(key: Column, run: Column) -> Column:
        h = F.crc32(F.concat(key, F.lit(":"), run))
        return F.when(h % 199 == 0, without(run, (h % F.char_length(run)).cast("int"))).otherwise(run)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return group_spellings(count_words(docs, change=thin), Scratch(spark))


ORACLE_SQL = {
    "op11_spelling_variants": f"""
WITH RECURSIVE
poly AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS k, w, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]{{6,}}')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS w FROM documents) GROUP BY ALL),
hashed AS (SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(k)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM runs, poly),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS p FROM words),
less AS (SELECT DISTINCT word, n, substr(word, 1, p) || substr(word, p + 2) AS k FROM places),
gap AS (SELECT word, n, substr(word, 1, p) || '_' || substr(word, p + 2) AS k FROM places),
pairs AS (
    SELECT l.word AS a, w.word AS b, w.n AS m FROM less l JOIN words w ON w.word = l.k
    UNION ALL SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.k
    UNION ALL SELECT x.word, y.word, y.n FROM gap x JOIN gap y ON x.k = y.k AND x.word <> y.word),
near AS (SELECT a, count(*) AS n_near, min({{'m': -m, 'w': b}}) AS best FROM pairs GROUP BY a),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * n THEN best.w END AS form, CASE WHEN -best.m >= 5 * n THEN -best.m END AS form_n
    FROM words LEFT JOIN near ON a = word),
chain AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN ends e ON e.word = f.word
"""
}
