"""Text functions on columns, all of built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that are folded, and those that language identification drops.
SINGLE_QUOTES = "\u0027\u0060\u00b4\u02bc\u055a\u07f4\u07f5\uff07\u2018\u2019\u201a\u201b\u2039\u203a\u275b\u275c\u02b9\u2032\u2035"
DOUBLE_QUOTES = "\u0022\u276e\u276f\uff02\u201c\u201d\u201e\u201f\u301d\u301e\u301f\u275d\u275e\u2033\u2036\u02ba\u02ee"
GUILLEMETS = "\u00ab\u00bb"
HYPHENS = "\u002d\u058a\u05be\u1400\u1806\u2010\u2011\u2e17\u2e1a\u30a0\ufe63\uff0d"
DASHES = "\u2012\u2013\u2014\u2015\u2e3a\u2e3b\u2e40\u301c\u3030\ufe31\ufe32\ufe58"
DROP_SYMBOLS = "\u2022\ufffd\u2026\u25ba\u25bc\u2010\u25a0\u300b\u2217\u2714\u21e4\u2013\u25cf\u25aa\u2794\u00ad\u037e\u00ab\u00bb\u25ca\u203a\u27a2\u201c\u00a9\u25a1"
DROP_DIGITS = "0123456789"
DROP_PUNCTUATION = "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~"
DROP_SPACES = "\t\n\r\x0b\x0c"
INVALID_XML = "\x0b\x0c\x1c\x1d\x1e"
SPACES = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_spaces(c: Column | str) -> Column:
    """Every space separator becomes an ASCII space."""
    return F.regexp_replace(_col(c), r"\p{Zs}", " ")


def fold_quotes(c: Column | str, guillemets: bool = False) -> Column:
    """Typographic quotes become ' and "."""
    double = DOUBLE_QUOTES + (GUILLEMETS if guillemets else "")
    return F.translate(_col(c), SINGLE_QUOTES + double, "'" * len(SINGLE_QUOTES) + '"' * len(double))


def fold_dashes(c: Column | str) -> Column:
    """Hyphens become -, dashes an en dash."""
    return F.translate(_col(c), HYPHENS + DASHES, "-" * len(HYPHENS) + "\u2013" * len(DASHES))


def remove_control(c: Column | str) -> Column:
    """Drop control, format and unassigned characters, except the zero-width joiner."""
    return F.regexp_replace(_col(c), r"(?!‍)\p{C}", "")


def collapse_spaces(c: Column | str) -> Column:
    """Each run of Unicode white space becomes one space."""
    return F.regexp_replace(_col(c), r"(?U)\s+", " ")


def lines(c: Column | str) -> Column:
    return F.split(_col(c), "\n")


def char_class(chars: str) -> str:
    """A class of the characters. Others are asked for only where a character is not ASCII: a class of many characters is looked through one
    by one for each character of a text."""
    code = lambda part: "".join(f"\\u{ord(c):04x}" for c in part)
    near, far = [c for c in chars if c < "\x80"], [c for c in chars if c >= "\x80"]
    return "[" + code(near) + (f"[[^\\x00-\\x7f]&&[{code(far)}]]" if far else "") + "]"


def fold_marks(c: Column | str) -> Column:
    """Quotes and dashes folded, in texts that have some other than ' " and -."""
    c = _col(c)
    other = "".join(x for x in SINGLE_QUOTES + DOUBLE_QUOTES + HYPHENS + DASHES if x not in "'\"-")
    return F.when(c.rlike(char_class(other)), fold_dashes(fold_quotes(c))).otherwise(c)


def lower_if_shouting(c: Column | str) -> Column:
    """Lower case for a string that has upper-case but no lower-case letters."""
    shouts = lambda x: ~x.rlike(r"[\p{Ll}\p{Lt}]") & x.rlike(r"\p{Lu}")
    return F.element_at(F.transform(F.array(_col(c)), lambda x: F.when(shouts(x), F.lower(x)).otherwise(x)), 1)  # computes c once


def clean_line(c: Column | str, drops: str = DROP_DIGITS + DROP_PUNCTUATION + DROP_SYMBOLS + DROP_SPACES) -> Column:
    """A line for language identification: dropped characters become spaces, spaces collapse, shouting is lowered."""
    blank = char_class("".join(sorted({*drops, *SPACES})))
    other = char_class("".join(sorted({*drops, *SPACES} - {" "})))
    return lower_if_shouting(F.trim(F.regexp_replace(_col(c), f"{blank}{{2,}}|{other}", " ")))


def blank_line(c: Column | str, drops: str = DROP_DIGITS + DROP_PUNCTUATION + DROP_SYMBOLS + DROP_SPACES) -> Column:
    """Whether clean_line leaves nothing of a line; it looks no further than the first character that stays."""
    return ~_col(c).rlike("[^" + char_class("".join(sorted({*drops, *SPACES})))[1:])


def clean_extracted(c: Column | str) -> Column:
    """Tidy extracted page text: tabs and replacement characters, spaces at line ends, runs of spaces and of newlines."""
    c = F.translate(_col(c), "\ufffd\t", "  ")
    c = F.regexp_replace(c, " *\n *", "\n")
    c = F.regexp_replace(c, " {2,}", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    return F.btrim(c, F.lit(" \n"))


def join_hyphenated(c: Column | str) -> Column:
    """A word that a hyphen splits at a line end is joined; the line breaks after it."""
    return F.regexp_replace(_col(c), r"(?U)( \w+)-\n(\w+ *)", "$1$2\n")


def xml_quote(c: Column | str) -> Column:
    """A quoted, escaped attribute value; empty and null values pass."""
    c = _col(c)
    escaped = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    double, single = escaped.contains('"'), escaped.contains("'")
    quoted = F.when(~double, F.concat(F.lit('"'), escaped, F.lit('"'))).when(~single, F.concat(F.lit("'"), escaped, F.lit("'")))
    return F.when(c == "", c).otherwise(quoted.otherwise(F.concat(F.lit('"'), F.replace(escaped, F.lit('"'), F.lit("&quot;")), F.lit('"'))))


def xml_unquote(c: Column | str) -> Column:
    """The value of a quoted attribute."""
    c = _col(c)
    c = F.substring(c, F.lit(2), F.greatest(F.length(c) - 2, F.lit(0)))
    for a, b in (("&quot;", '"'), ("&#9;", "\t"), ("&#13;", "\r"), ("&#10;", "\n"), ("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def drop_invalid_xml(c: Column | str, tokens: str = INVALID_XML) -> Column:
    """Remove control characters that XML does not allow."""
    return F.translate(_col(c), tokens, "")


def start_tag(attributes: Column, name: str = "doc", first: tuple[str, ...] = ("id", "file_id")) -> Column:
    """A start tag of a map from name to value: `first` keys, then the rest in order; null and empty values are left out."""
    filled = F.map_filter(attributes, lambda k, v: v.isNotNull() & (v != ""))
    rank = lambda k: F.coalesce(F.array_position(F.array(*map(F.lit, first)), k), F.lit(0))
    entries = F.transform(F.map_entries(filled), lambda e: F.struct(F.when(rank(e["key"]) == 0, len(first) + 1).otherwise(rank(e["key"])).alias("r"), e["key"].alias("k"), e["value"].alias("v")))
    parts = F.transform(F.array_sort(entries), lambda e: F.concat(e["k"], F.lit("="), xml_quote(e["v"]), F.lit(" ")))
    return F.concat(F.lit(f"<{name} "), F.array_join(parts, ""), F.lit(">"))


_ATTRIBUTE = r"""([\w.:-]+)=("[^"]*"|'[^']*')"""


def tag_attributes(c: Column | str) -> Column:
    """The attributes of a start tag as a map; the first of equal names counts."""
    c = _col(c)
    names = F.regexp_extract_all(c, F.lit(_ATTRIBUTE), F.lit(1))
    values = F.transform(F.regexp_extract_all(c, F.lit(_ATTRIBUTE), F.lit(2)), xml_unquote)
    pairs = F.arrays_zip(names.alias("key"), values.alias("value"))
    once = F.filter(pairs, lambda p, i: F.array_position(names, p["key"]) == i + 1)
    return F.map_from_entries(once)


def attribute_names(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(_ATTRIBUTE), F.lit(1))


def wrap_doc(tag: Column | str, body: Column | str) -> Column:
    """A tagged text: start tag, body, end tag, a line each."""
    return F.concat_ws("\n", _col(tag), _col(body), F.lit("</doc>"))


def fill_file_id(tag: Column | str, file_id: Column | str) -> Column:
    """Put a file id where a rendered tag has the placeholder FILE_ID."""
    return F.replace(_col(tag), F.lit("FILE_ID"), _col(file_id).cast("string"))


def lempos(lemma: Column | str, pos: Column | str) -> Column:
    return F.concat(_col(lemma), F.lit("-"), _col(pos))


def lempos_parts(c: Column | str) -> tuple[Column, Column]:
    """Lemma before the first hyphen, part of speech after the last."""
    return F.substring_index(_col(c), "-", 1), F.substring_index(_col(c), "-", -1)


def comment_attribute(c: Column | str) -> Column:
    """` k="v"` of a comment line `# k = v`."""
    c = _col(c)
    found = r"^#\s*([^=]*?)\s*=\s*(.*)$"
    return F.when(c.rlike(found), F.concat(F.lit(" "), F.regexp_extract(c, found, 1), F.lit("="), xml_quote(F.regexp_extract(c, found, 2))))


def text_path(folder: str, id_: Column | str, file_id: Column | str) -> Column:
    """folder/id/file_id.txt"""
    return F.concat(F.lit(folder.rstrip("/") + "/"), _col(id_).cast("string"), F.lit("/"), _col(file_id).cast("string"), F.lit(".txt"))


def byte_length(c: Column | str) -> Column:
    return F.octet_length(_col(c))


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.btrim(c, F.lit(SPACES)) == "", None).otherwise(c)


def null_like(c: Column | str, words: tuple[str, ...] = ("", "none", "null", "nan"), strip: bool = True) -> Column:
    """Null for strings that mean it."""
    c = _col(c)
    seen = F.lower(F.trim(c) if strip else c)
    return F.when(seen.isin(*words), None).otherwise(c)
