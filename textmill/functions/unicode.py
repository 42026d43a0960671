"""The few text functions that Spark has no expression for, as Arrow-batched Python."""

from __future__ import annotations

import ast
import functools
import hashlib
import html
import json
import lzma
import re
import unicodedata
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
_AMPERSAND = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")
_TAG = re.compile(r"<!--.*?-->|</?[\w:.-]+(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*\s*/?>", re.S)
# Characters that must stay escaped in markup.
_ESCAPED = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"}


def decode_entities(text: str, keep_markup: bool = True) -> str:
    """Decode character references that end in ;. With keep_markup, those for & < > " ' stay escaped."""

    def one(m: re.Match[str]) -> str:
        got = html.unescape(m[0])
        return _ESCAPED.get(got, got) if keep_markup else got

    return _ENTITY.sub(one, text)


def normalize_line(text: str, form: str = "NFKC", guillemets: bool = False, keep_empty: bool = False, full_decode: bool = False, keep_quotes: bool = False, keep_dashes: bool = False, tab: str = " ", keep: str = "\u200d", strip: bool = True, new_line: str = "\n") -> str:
    """One line: references, spaces, normal form (without compatibility folding inside tags), quotes, dashes, controls.

    Newlines, line and paragraph separators split it; each part is stripped unless strip is off, and empty ones go unless keep_empty.
    What is left ends in new_line. tab: what a tab becomes (a tab is a control, so it stays only if keep has it).
    """
    from textmill.functions import text as T

    text = decode_entities(text, not full_decode)
    if not text.isprintable():  # else no space but the common one
        text = "".join(" " if unicodedata.category(c) == "Zs" else c for c in text)
    out, at = [], 0
    for m in [*_TAG.finditer(text), None]:
        plain = unicodedata.normalize(form, text[at : m.start() if m else len(text)])
        double = T.DOUBLE_QUOTES + (T.GUILLEMETS if guillemets else "")
        folds = {} if keep_quotes else dict.fromkeys(map(ord, T.SINGLE_QUOTES), "'") | dict.fromkeys(map(ord, double), '"')
        folds |= {} if keep_dashes else dict.fromkeys(map(ord, T.HYPHENS), "-") | dict.fromkeys(map(ord, T.DASHES), "–")
        out.append(plain.translate(folds))
        if m:
            out.append(unicodedata.normalize(form.replace("K", ""), m[0]))
            at = m.end()
    text = "".join(out).replace("\t", tab)
    if not text.isprintable():  # else no character of a category C
        text = "".join(c for c in text if c in keep or unicodedata.category(c)[0] != "C")
    parts = [p.strip() if strip else p for p in re.split("[\u2028\u2029]", text)]
    return "".join(p + new_line for p in parts if p or keep_empty)


#: First and last code points of the blocks that most text is made of; what lies outside is looked at in Python.
_COMMON = ((0x20, 0x7E), (0xA0, 0x17F), (0x386, 0x52F), (0x2010, 0x203A), (0x20A0, 0x20BF), (0x3041, 0x30FF), (0x4E00, 0x9FFF))


@functools.cache
def unstable_pattern() -> str:
    """A pattern that finds what line normalisation may change other than by folding quotes and dashes: references, markup, and
    any character but those of common blocks that every normal form keeps, that combine with no other, and that are neither
    spaces nor controls. Tabs are spaces."""
    seconds = {d[1] for c in range(0xA0, 0x10000) if len(d := unicodedata.normalize("NFD", chr(c))) == 2}

    def stable(c: str) -> bool:
        return unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) and c not in seconds and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc", "Cf", "Cn", "Co", "Cs")

    kept = [0x09, 0x20, *(c for first, last in _COMMON for c in range(first, last + 1) if chr(c) not in "&<" and stable(chr(c)))]

    def class_of(kept: list[int]) -> str:
        ranges, k = [], 0
        while k < len(kept):
            end = k
            while end + 1 < len(kept) and kept[end + 1] == kept[end] + 1:
                end += 1
            ranges.append(f"\\u{kept[k]:04x}" + (f"-\\u{kept[end]:04x}" if end > k else ""))
            k = end + 1
        return f"[^{''.join(ranges)}]"

    # the ranges of a class are looked through one by one, so those of most characters go first and end the search
    return f"[{class_of([c for c in kept if c < 0x100])}&&{class_of([c for c in kept if c >= 0x100])}]"


def normalize_text(text: str, **options) -> str:
    """normalize_line for each line of a text."""
    return "".join(normalize_line(x, **options) for x in text.split("\n"))


class _Data(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = ()
        self.inside = 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag in self.skip

    def handle_endtag(self, tag):
        self.inside -= tag in self.skip and self.inside > 0

    def handle_data(self, data):
        if not self.inside:
            self.parts.append(data)


def html_text(text: str, separator: str = "", skip: tuple[str, ...] = (), open_references: bool = True) -> str:
    """All character data of a page, scripts and styles included unless named in skip; stripped. References without their ; are
    decoded as browsers do (&amp before a tag is &), or left as they stand without open_references."""
    parser = _Data()
    parser.skip = skip
    if open_references:
        parser.feed(text)
        parser.close()
        return separator.join(parser.parts).strip()
    mark = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in text)  # stands for the & of what is no closed reference
    closed = lambda name: name and (name[0] == "#" or name in html5)
    parser.feed(_AMPERSAND.sub(lambda m: m[0] if closed(m[1]) else mark + (m[1] or ""), text))
    parser.close()
    return separator.join(parser.parts).replace(mark, "&").strip()


def str_to_obj(text: str):
    """JSON, else a Python literal, else the string itself."""
    for read in (json.loads, ast.literal_eval):
        try:
            return read(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
    return text


#: Characters of results that are held as Python strings at once.
CHUNK = 1 << 20


def _each(f, kind: str = "string"):
    """f of each value that is not null. Of a batch one value at a time is a Python string, and results become Arrow arrays in chunks."""

    def run(values: pa.Array) -> pa.Array:
        done, now, size, arrow = [], [], 0, pa.binary() if kind == "binary" else pa.string()
        for x in values:
            y = None if not x.is_valid else f(x.as_py())
            now.append(y)
            size += len(y or "")
            if size > CHUNK:
                done.append(pa.array(now, arrow))
                now, size = [], 0
        return pa.concat_arrays([*done, pa.array(now, arrow)])

    return F.arrow_udf(run, kind)


def html_text_udf(separator: str = "", skip: tuple[str, ...] = (), open_references: bool = True):
    return _each(lambda x: html_text(x, separator, skip, open_references))


def normalize_udf(**options):
    return _each(lambda x: normalize_text(x, **options))


def entities_udf(keep_markup: bool = True):
    return _each(lambda x: decode_entities(x, keep_markup))


def literal_json_udf():
    """JSON text of a JSON or Python literal."""
    return _each(lambda x: json.dumps(str_to_obj(x), ensure_ascii=False))


def params_hash_udf():
    """BLAKE2b (16 bytes, hex) of a JSON object with sorted keys."""
    return _each(lambda x: hashlib.blake2b(json.dumps(json.loads(x), sort_keys=True).encode(), digest_size=16).hexdigest())


def unxz_udf():
    """Text of xz-compressed bytes; malformed UTF-8 is replaced."""
    return _each(lambda x: lzma.decompress(bytes(x)).decode("utf-8", "replace"))


def xz_bytes(text: str) -> bytes:
    """xz-compressed UTF-8. The dictionary is no larger than the text, since a coder fills its tables before it begins."""
    data = text.encode()
    size = min(max(len(data), 4096), 8 << 20)  # 8 MB is what the preset has
    return lzma.compress(data, filters=[{"id": lzma.FILTER_LZMA2, "preset": lzma.PRESET_DEFAULT, "dict_size": size}])


def xz_udf():
    return _each(xz_bytes, "binary")
