"""The corpus queries in SQL, by the same rules and from the same fixed values."""

from __future__ import annotations

from textmill.functions import text as T
from textmill.operators import langid as L
from textmill.operators import tokens as K
from textmill.plans.noise import MARRED, NOISE


def literal(s: str) -> str:
    """A SQL expression for a string with control characters."""
    out, parts = "", []
    for ch in s:
        if ch < " " or ch == "\x7f":
            parts += [f"'{out}'"] if out else []
            parts.append(f"chr({ord(ch)})")
            out = ""
        else:
            out += "''" if ch == "'" else ch
    parts += [f"'{out}'"] if out or not parts else []
    return "(" + " || ".join(parts) + ")"


def noisy(c: str) -> str:
    for a, b in NOISE:
        c = f"replace({c}, {literal(a)}, {literal(b)})"
    return c


def marred(c: str, pick: int) -> str:
    """c with MARRED text in it (pick 1), or with what normalisation makes of it (pick 2)."""
    for marks in MARRED:
        c = f"replace({c}, {literal(marks[0])}, {literal(marks[pick])})"
    return c


def folded_line(c: str) -> str:
    """Quotes and dashes folded, as normalisation leaves them."""
    return translate(c, T.SINGLE_QUOTES + T.DOUBLE_QUOTES + T.HYPHENS + T.DASHES, "'" * len(T.SINGLE_QUOTES) + '"' * len(T.DOUBLE_QUOTES) + "-" * len(T.HYPHENS) + "\u2013" * len(T.DASHES))


def translate(c: str, chars: str, to: str) -> str:
    return f"translate({c}, {literal(chars)}, {literal(to)})"


_DROPS = T.DROP_DIGITS + T.DROP_PUNCTUATION + T.DROP_SYMBOLS + T.DROP_SPACES
_SPACE = r"[\s\x0b\x{85}\p{Z}]"


def clean_line(c: str) -> str:
    spaced = f"trim(regexp_replace({translate(c, _DROPS, ' ' * len(_DROPS))}, '\\s+', ' ', 'g'))"
    return f"(CASE WHEN regexp_matches({spaced}, '\\p{{Lu}}') AND NOT regexp_matches({spaced}, '[\\p{{Ll}}\\p{{Lt}}]') THEN lower({spaced}) ELSE {spaced} END)"


LINES = "SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS line_idx, unnest(string_split(text, chr(10))) AS line FROM documents"
CLEANED = f"SELECT doc_id, line_idx, {clean_line('line')} AS line FROM ({LINES})"


def best_count(c: str) -> str:
    """How many function words of the best language there are."""
    words = f"string_split(lower({c}), ' ')"
    return "greatest(" + ", ".join(f"len(list_filter({words}, lambda w: w IN ({', '.join(repr(w) for w in p)})))" for p in L.PROFILES.values()) + ")"


def model(c: str) -> str:
    words = f"string_split(lower({c}), ' ')"
    score = {k: f"len(list_filter({words}, lambda w: w IN ({', '.join(repr(w) for w in p)})))" for k, p in sorted(L.PROFILES.items())}
    best = f"greatest({', '.join(score.values())})"
    return f"CASE WHEN {best} = 0 THEN 'unknown' " + " ".join(f"WHEN {s} = {best} THEN '{k}'" for k, s in score.items()) + " END"


LID = f"SELECT doc_id, line_idx, CASE WHEN length(line) < 10 THEN 'short' ELSE {model('line')} END AS lang, octet_length(encode(line))::BIGINT AS bytes FROM ({CLEANED}) WHERE line <> ''"
SHARES = f"""SELECT doc_id, lang, share FROM (
    SELECT doc_id, lang, round_even(b::DOUBLE / sum(b) OVER (PARTITION BY doc_id), 2) AS share, count(*) OVER (PARTITION BY doc_id) AS n
    FROM (SELECT doc_id, lang, sum(bytes)::BIGINT AS b FROM ({LID}) GROUP BY ALL))
    WHERE share >= 1.0::DOUBLE / (least(n, 4) + 1)"""
L1 = f"SELECT doc_id, first(lang ORDER BY share DESC, lang) AS l1, max(share) AS l1_size FROM ({SHARES}) GROUP BY doc_id"


def quote(c: str) -> str:
    e = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        e = f"replace({e}, {literal(a)}, {literal(b)})"
    return f"""(CASE WHEN {c} = '' THEN {c} WHEN NOT contains({e}, '"') THEN '"' || {e} || '"' WHEN NOT contains({e}, '''') THEN '''' || {e} || '''' ELSE '"' || replace({e}, '"', '&quot;') || '"' END)"""


_TITLE = "replace(split_part(text, chr(10), 1), 'e', '\"')"


def tag(file_id: str = "'FILE_ID'") -> str:
    return f"""'<doc id=' || {quote('doc_id::VARCHAR')} || ' file_id=' || {quote(file_id)} || ' ' || CASE WHEN lang IS NULL OR lang = '' THEN '' ELSE 'lang=' || {quote('lang')} || ' ' END
        || CASE WHEN source IS NULL OR source = '' THEN '' ELSE 'source=' || {quote('source')} || ' ' END || CASE WHEN {_TITLE} = '' THEN '' ELSE 'title=' || {quote(_TITLE)} || ' ' END || '>'"""


SENT = rf"""SELECT doc_id, s::INT AS sent, sentence FROM (
    SELECT doc_id, unnest(range(len(p))) AS s, unnest(p) AS sentence FROM (
        SELECT doc_id, flatten(list_transform(list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([{K.ENDERS}]+)\s+', '\1' || chr(10), 'g'), '\s+([{K.STARTERS}])', chr(10) || '\1', 'g'), chr(10)),
            lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''),
            lambda x: list_transform(range(0, len(string_split(x, ' ')), {K.LONGEST}), lambda i: array_to_string(list_slice(string_split(x, ' '), i + 1, i + {K.LONGEST}), ' ')))) AS p FROM documents))"""
TOKENS = rf"""SELECT doc_id, sent, pos, word, lower(word) AS lemma,
    CASE WHEN regexp_matches(word, '^\p{{N}}') THEN 'NUM' WHEN regexp_matches(word, '^[^\p{{L}}\p{{M}}\p{{N}}]') THEN 'PUNCT' WHEN regexp_matches(word, '^\p{{Lu}}') THEN 'PROPN' WHEN length(word) <= 3 THEN 'ADP' ELSE 'NOUN' END AS upos
    FROM (SELECT doc_id, sent, unnest(range(1, len(w) + 1))::INT AS pos, unnest(w) AS word FROM (
        SELECT doc_id, sent, regexp_extract_all(sentence, '[\p{{L}}\p{{M}}]+(?:[''’-][\p{{L}}\p{{M}}]+)*|\p{{N}}+(?:[.,]\p{{N}}+)*|[^\s\p{{L}}\p{{M}}\p{{N}}]') AS w FROM ({SENT})))"""
# Fixed value: class letters of a noun phrase.
PHRASE = "(?:D|S|P|DD|SD|DP|SP|DDD|SDD|DDP|SDP)?[ANVO]{0,9}[ANV]"
TAGS = f"SELECT doc_id, sent, pos, word, upos AS tag_a, CASE WHEN length(word) % 4 = 0 THEN 'VERB' ELSE upos END AS tag_b FROM ({TOKENS})"
TAGGED = f"""SELECT doc_id, sent, pos, word, substring('DNAXSNVXA', ((pos + sent) % 9 + 1)::INT, 1) AS cls, substring('CM0FC0', ((pos * 5 + sent) % 6 + 1)::INT, 1) AS gender,
    substring('N0SPN', ((pos * 3 + sent) % 5 + 1)::INT, 1) AS number FROM ({TOKENS})"""
DIFFS = f"""SELECT word, tag_a, tag_b, count(*)::BIGINT AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM ({TAGS}) WHERE tag_a <> tag_b), 6) AS diff_pct,
    round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM ({TAGS})), 6) AS total_pct FROM ({TAGS}) WHERE tag_a <> tag_b GROUP BY ALL"""
VERTICAL = """SELECT source AS file, doc_id * 10 AS line_idx, '<s id="' || doc_id || '">' AS value FROM documents
    UNION ALL SELECT source, doc_id * 10 - 1, '</docx>' FROM documents WHERE doc_id % 50 = 0"""


UNLIKE = f"""t AS (SELECT doc_id, sent, pos, word || '#' || sent || '.' || pos AS word, upos, CASE WHEN pos % 7 = 3 THEN 'D' WHEN pos % 11 = 1 THEN 'X' WHEN pos % 5 = 0 THEN 'C' ELSE 'S' END AS change FROM ({TOKENS})),
    g AS (SELECT *, sum((change = 'S')::INT) OVER (PARTITION BY doc_id ORDER BY sent, pos) AS run FROM t),
    u AS (SELECT *, sum((change IN ('D', 'X'))::INT) OVER (PARTITION BY doc_id, run ORDER BY sent, pos) AS ahead, sum((change IN ('D', 'X'))::INT) OVER (PARTITION BY doc_id, run ORDER BY sent DESC, pos DESC) AS behind FROM g WHERE change <> 'S')"""


def entities(c: str) -> str:
    for a, b in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


def data_of(c: str) -> str:
    return entities(f"regexp_replace({c}, '<!--.*?-->|<[^>]*>', '', 'gs')")


def fill(name: str, mark: str, stands: str, values: str) -> str:
    definite = f"CASE WHEN {name} IN ({values}) THEN {name} END"
    value = f"""CASE WHEN phrase IS NOT NULL THEN coalesce(last_value({definite} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value({definite} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '{mark}') ELSE {name} END"""
    return f"replace({value}, '{mark}', '{stands}')"


def oracle_sql() -> dict[str, str]:
    one_line = lambda c: f"regexp_replace({c}, {_SPACE!r}, ' ', 'g')"
    folded = translate("t", T.SINGLE_QUOTES + T.DOUBLE_QUOTES + T.GUILLEMETS + T.HYPHENS + T.DASHES, "'" * len(T.SINGLE_QUOTES) + '"' * len(T.DOUBLE_QUOTES + T.GUILLEMETS) + "-" * len(T.HYPHENS) + "\u2013" * len(T.DASHES))
    spliced = lambda c: f"CASE WHEN count(*) = 1 THEN max({c}) WHEN count(DISTINCT {c}) FILTER (NOT head) = 1 THEN max({c}) FILTER (NOT head) ELSE string_agg({c}, ',' ORDER BY line_idx) FILTER (NOT head) END"
    return {
        "xz_round_trip": "SELECT doc_id, text FROM documents",
        "literals": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
        "bundle_rows": "SELECT conv_id, turn, role FROM conversations",
        "attribute_tags": f"""SELECT doc_id AS id, '<doc id=' || {quote('doc_id::VARCHAR')} || ' file_id="FILE_ID" date__original="2021-0' || (doc_id % 9 + 1) || '-01T00:00:00Z" date__original__year="2021" lang='
            || {quote('lang')} || ' source__name=' || {quote("source || '|a%7Cb'")} || ' >' AS doc_tag FROM documents""",
        "concat_texts": f"""SELECT d.doc_id, '<raw>' || chr(10) || d.text || chr(10) || '</raw>' || chr(10) || '<clean>' || chr(10) || coalesce(c.t, '') || chr(10) || '</clean>' AS body
            FROM documents d LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_idx) AS t FROM ({CLEANED}) WHERE length(line) >= 10 GROUP BY doc_id) c USING (doc_id)""",
        "change_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS records FROM events GROUP BY 1",
        "lines": LINES,
        "lines_clean": f"SELECT doc_id, line_idx, {clean_line('line')} AS line FROM (SELECT doc_id, line_idx, {folded_line(marred('line', 2))} AS line FROM ({LINES}))",
        "lid_profile_lines": LID,
        "lid_shares": SHARES,
        "lid_l1": L1,
        "lid_multiling": f"SELECT doc_id, count(*) FILTER (lang NOT IN ('unknown', 'short')) > 1 AS multi FROM ({SHARES}) GROUP BY doc_id",
        "lid_filters": f"SELECT doc_id, l1_size FROM ({L1}) WHERE l1 = 'en' AND l1_size BETWEEN 0.5 AND 0.95",
        "lid_unsure": f"SELECT CASE WHEN {best_count('line')}::DOUBLE / len(string_split(lower(line), ' ')) > 0.25 THEN {model('line')} ELSE 'unknown' END AS lang, count(*)::BIGINT AS n FROM ({CLEANED}) WHERE line <> '' GROUP BY 1",
        "line_sample": f"""WITH c AS (SELECT doc_id, line, count(*) AS copies FROM ({CLEANED}) WHERE line <> '' GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5('0:' || line), line) AS rank, sum(copies) OVER (PARTITION BY doc_id) AS lines FROM c)
            SELECT doc_id, line FROM r WHERE lines >= 3 AND rank <= 3 UNION ALL SELECT doc_id, line FROM (SELECT doc_id, line, unnest(range(copies)) FROM r WHERE lines < 3)""",
        "file_stats": """WITH l AS (SELECT doc_id, length(text)::BIGINT AS chars, list_sort(list_transform(string_split(text, chr(10)), lambda x: length(x))) AS l FROM documents)
            SELECT doc_id, chars, len(l)::BIGINT AS lines, l[1]::BIGINT AS min, l[(round_even(0.25 * (len(l) - 1), 0) + 1)::INT]::BIGINT AS q1, l[(round_even(0.5 * (len(l) - 1), 0) + 1)::INT]::BIGINT AS q2,
            l[(round_even(0.75 * (len(l) - 1), 0) + 1)::INT]::BIGINT AS q3, l[len(l)]::BIGINT AS max FROM l""",
        "pdf_clean": f"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(translate({noisy('text')}, chr(65533) || chr(9), '  '), ' *' || chr(10) || ' *', chr(10), 'g'), ' {{2,}}', ' ', 'g'),
            chr(10) || '{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text FROM documents""",
        "dewrap": rf"SELECT doc_id, regexp_replace({noisy('text')}, '( [\p{{L}}\p{{M}}\p{{N}}_]+)-' || chr(10) || '([\p{{L}}\p{{M}}\p{{N}}_]+ *)', '\1\2' || chr(10), 'g') AS text FROM documents",
        "quotes_dashes": rf"SELECT doc_id, {folded} AS text FROM (SELECT doc_id, regexp_replace({noisy('text')} || ' « x » ‘a’ b‐c ', '\p{{Zs}}', ' ', 'g') AS t FROM documents)",
        "control_chars": f"SELECT doc_id, replace(regexp_replace(replace({literal('a' + chr(1) + 'b­c‍d﻿')} || {noisy('text')}, chr(8205), chr(57344) || 'zwj'), '[\\x00-\\x1f\\x7f-\\x{{9f}}\\p{{Cf}}]', '', 'g'), chr(57344) || 'zwj', chr(8205)) AS text FROM documents",
        "collapse": f"SELECT doc_id, regexp_replace({noisy('text')}, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+', ' ', 'g') AS text FROM documents",
        "html_text": f"""WITH p AS (SELECT page_id, string_split(html, '<script>') AS a FROM pages), q AS (SELECT page_id, a[1] AS before, string_split(a[2], '</script>') AS b FROM p)
            SELECT page_id, trim({data_of('before')} || b[1] || {data_of('coalesce(b[2], chr(32))')}, ' ' || chr(10) || chr(9) || chr(13)) AS text FROM q""",
        "normalize_unicode": """SELECT doc_id, coalesce(string_agg(trim(line) || chr(10), '' ORDER BY i), '') AS text FROM (
            SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (
                SELECT doc_id, replace(replace(text, 'of ', 'fi1&amp;éw '), chr(10), chr(10) || chr(10)) AS t FROM documents)) WHERE trim(line) <> '' GROUP BY doc_id
            UNION ALL SELECT doc_id, '' FROM documents WHERE trim(replace(text, chr(10), '')) = ''""",
        "xml_quote": f"SELECT page_id, {quote('html')} AS quoted FROM pages",
        "doc_tag": f"SELECT doc_id, {tag(chr(39) + '0' + chr(39))} AS doc_tag FROM documents",
        "parse_tag": f"SELECT doc_id, doc_id::VARCHAR AS id, {_TITLE} AS title, source, 5::BIGINT AS n FROM documents",
        "unique_attrs": "SELECT unnest(['id', 'file_id', 'lang', 'source', 'title']) AS name",
        "xml_tokens": f"SELECT doc_id, 'abc' || {translate('text', T.INVALID_XML, '')} || 'abc' AS text FROM documents",
        "comment_attrs": f"SELECT doc_id, ' source=' || {quote('source')} AS attr FROM documents",
        "lempos": "SELECT doc_id, lang || '-' || source || '-n' AS lempos, lang AS lemma, 'n' AS pos FROM documents",
        "semi_join_lang": "SELECT doc_id, lang, source FROM documents WHERE (lang = 'en' OR doc_id % 3 = 0) AND doc_id % 4 <> 0",
        "left_join_attr": "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
        "export_docs": f"""WITH k AS (SELECT d.doc_id AS id, 0 AS file_id, {tag(chr(39) + '0' + chr(39))} || chr(10) || text || chr(10) || '</doc>' AS body FROM documents d
            JOIN (SELECT doc_id FROM ({SHARES}) WHERE lang = 'en' AND share >= 0.8) USING (doc_id)
            WHERE trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AND DATE '2020-01-01' + (d.doc_id % 1000)::INT BETWEEN DATE '2020-02-01' AND DATE '2021-12-31')
            SELECT id, file_id, body, ((row_number() OVER (ORDER BY id, file_id) - 1) // 100 + 1)::BIGINT AS batch FROM k""",
        "batching": "SELECT *, ((row_number() OVER (ORDER BY doc_id) - 1) // 64 + 1)::BIGINT AS batch FROM documents",
        "range_slice": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents QUALIFY pos BETWEEN 100 AND 149",
        "ntile_split": 'SELECT source, doc_id, ntile(4) OVER (PARTITION BY source ORDER BY doc_id) - 1 AS "group" FROM documents',
        "flatten_events": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, CASE WHEN lower(trim(event_type)) IN ('', 'none', 'null', 'nan') THEN NULL ELSE event_type END AS event_type FROM events",
        "list_join": "SELECT event_id, event_type || '-1|' || event_type || '%7C2|' || event_type || '-3' AS joined, event_type || 'x' AS plain FROM events",
        "nested_records": """SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, '|' ORDER BY l_linenumber, l_quantity) AS line__id, string_agg(l_quantity::INT::VARCHAR, '|' ORDER BY l_linenumber, l_quantity) AS line__location__lon,
            min(l_partkey) AS first__id FROM lineitem GROUP BY l_orderkey""",
        "field_names": "SELECT DISTINCT unnest(json_keys(props)) AS name FROM events",
        "year_attr": "SELECT event_id, strftime(ts, '%Y') AS date__original__year FROM events",
        "date_range": "SELECT o_orderkey, year(o_orderdate)::BIGINT AS year FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'",
        "high_watermark": "SELECT max(ts)::VARCHAR AS changed FROM events",
        "upsert_latest": "SELECT user_id, event_id, event_type, ts::VARCHAR AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1",
        "upsert_two_keys": """WITH a AS (SELECT event_id, user_id, event_id % 997 AS url, event_id % 2 AS late FROM events), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY late DESC, event_id DESC) = 1)
            SELECT event_id, user_id, url FROM b QUALIFY row_number() OVER (PARTITION BY url ORDER BY late DESC, event_id DESC) = 1""",
        "column_update": "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'q' || l.quality END AS source FROM documents d LEFT JOIN labels l USING (doc_id)",
        "explode_files": "SELECT conv_id AS id, turn AS file_id, role, length(text)::BIGINT AS filesize FROM conversations",
        "download_todo": """SELECT file_id, filesize FROM (SELECT doc_id AS file_id, n_chars AS filesize, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)
            WHERE n BETWEEN 50 AND 499 AND (file_id % 3 = 0 OR file_id % 5 = 0)""",
        "missing_rates": """WITH j AS (SELECT lang, source, quality FROM documents LEFT JOIN labels USING (doc_id))
            SELECT 'lang' AS attribute, avg((lang IS NULL)::INT)::DOUBLE AS missing, min(lang) AS example FROM j UNION ALL SELECT 'source', avg((source IS NULL)::INT), min(source) FROM j
            UNION ALL SELECT 'quality', avg((quality IS NULL)::INT), min(quality::VARCHAR) FROM j""",
        "tokens": TOKENS,
        "freq_word": f"SELECT word AS item, count(*)::BIGINT AS freq FROM ({TOKENS}) GROUP BY 1",
        "freq_lc": f"SELECT lower(word) AS item, count(*)::BIGINT AS freq FROM ({TOKENS}) GROUP BY 1",
        "freq_lemma_pos": f"SELECT lemma AS item, upos AS item1, count(*)::BIGINT AS freq FROM ({TOKENS}) GROUP BY 1, 2",
        "corpus_size": f"SELECT count(*)::BIGINT AS tokens, count(DISTINCT doc_id)::BIGINT AS docs FROM ({TOKENS})",
        "conllu_roundtrip": TOKENS,
        "conllu_counts": f"SELECT doc_id, 1::BIGINT AS doc, count(DISTINCT sent)::BIGINT AS sent, count(*)::BIGINT AS token, count(DISTINCT sent)::BIGINT AS blank FROM ({TOKENS}) GROUP BY doc_id",
        "mwt_splice": f"""WITH t AS (SELECT *, pos - (CASE WHEN pos % 3 = 2 THEN 1 ELSE 0 END) AS head_pos FROM ({TOKENS})),
            e AS (SELECT doc_id, sent, head_pos, pos % 3 <> 0 AS ranged, pos * 2 AS line_idx, false AS head, pos::VARCHAR AS id, word AS form, lemma, upos, 'x' AS xpos, (pos - 1)::VARCHAR AS hd, 't' AS misc FROM t
                  UNION ALL SELECT doc_id, sent, pos, true, pos * 2 - 1, true, pos || '-' || (pos + 1), word || '+', '_', '_', '_', '_', 'm' FROM t WHERE pos % 3 = 1)
            SELECT doc_id, sent, min(line_idx)::BIGINT AS line_idx, {spliced('id')} AS id, CASE WHEN bool_or(head) THEN max(form) FILTER (head) ELSE max(form) END AS form, {spliced('lemma')} AS lemma, {spliced('upos')} AS upos,
            {spliced('xpos')} AS xpos, {spliced('hd')} AS head, CASE WHEN bool_or(head) THEN 'm' ELSE 't' END AS misc FROM e GROUP BY doc_id, sent, head_pos""",
        "doc_refs": "SELECT *, row_number() OVER (ORDER BY source, doc_id) AS ref FROM documents",
        "tag_update": f"""SELECT doc_id, replace(replace({tag()}, ' lang="' || lang || '"', ' lang="xx"'), ' file_id="FILE_ID"', ' file_id="FILE_ID" ref="' || (doc_id + 1) || '"') AS tag FROM documents""",
        "docx_wrap": f"""SELECT file, line_idx, value FROM ({VERTICAL}) WHERE value <> '</docx>' UNION ALL
            SELECT DISTINCT source, -1, '<docx ref="' || substring(source, 4)::INT || '" name="' || source || '.vert" >' FROM documents UNION ALL SELECT DISTINCT source, 4611686018427387904, '</docx>' FROM documents""",
        "sent_lang_join": f"""SELECT v.file, v.line_idx, CASE WHEN d.lang IS NOT NULL AND value LIKE '<s %' THEN '<s id="' || d.doc_id || '" lang="' || d.lang || '" >' ELSE value END AS value
            FROM ({VERTICAL}) v LEFT JOIN (SELECT * FROM documents WHERE doc_id % 2 = 0) d ON d.source = v.file AND d.doc_id * 10 = v.line_idx""",
        "verify_counts": "SELECT source AS file, count(*) FILTER (doc_id % 400 <> 7) AS least, count(*) AS most, count(*) = count(*) FILTER (doc_id % 400 <> 7) AS ok FROM documents GROUP BY source",
        "read_tagged": f"SELECT source AS file, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS doc_seq, {tag()} AS tag, text AS body FROM documents",
        "sentence_routing": f"SELECT doc_id, sent, CASE WHEN n < 4 THEN 'none' WHEN n < 500 THEN 'batch' ELSE 'chunk' END AS route FROM (SELECT *, len(string_split(sentence, ' ')) AS n FROM ({SENT}))",
        "size_routing": f"""WITH d AS (SELECT doc_id, octet_length(encode(text)) AS b, greatest(coalesce(units, 1), 1) AS units FROM documents LEFT JOIN (SELECT doc_id, count(*) AS units FROM ({SENT}) GROUP BY 1) USING (doc_id))
            SELECT doc_id, CASE WHEN b < 2000 THEN 'whole' WHEN b::DOUBLE / least(ceil(b / 300.0), units) <= 2400 THEN 'bulk' ELSE 'units' END AS route, CASE WHEN b < 2000 THEN 1 ELSE least(ceil(b / 300.0)::BIGINT, units) END::BIGINT AS groups FROM d""",
        "sentence_lid_vote": f"""WITH s AS (SELECT doc_id, sent, {clean_line("string_agg(word, ' ' ORDER BY pos)")} AS c FROM ({TOKENS}) GROUP BY ALL),
            w AS (SELECT doc_id, sent, string_split(c, ' ') AS w FROM s WHERE c <> '' AND len(string_split(c, ' ')) >= 4),
            k AS (SELECT doc_id, sent, unnest(range((len(w) - 1) // 20 + 1)) AS chunk, w FROM w),
            l AS (SELECT doc_id, sent, chunk, {model("array_to_string(list_slice(w, chunk * 20 + 1, chunk * 20 + 20), ' ')")} AS lang FROM k),
            v AS (SELECT doc_id, sent, lang, count(*) AS n, min(chunk) AS f FROM l GROUP BY ALL)
            SELECT doc_id, sent, first(lang ORDER BY n DESC, f) AS lang FROM v GROUP BY ALL""",
        "subcorpora": """SELECT count(*) FILTER (doc_id % 3 = 0) AS doc_html, count(*) FILTER (doc_id % 3 <> 0) AS doc_pdf, count(*) FILTER (doc_id % 4 = 0 OR contains(source, '|')) AS source_multi,
            count(*) FILTER (doc_id % 4 <> 0 AND NOT contains(source, '|')) AS source_single, count(*) FILTER (doc_id % 5 = 0 OR lang IS NULL OR lang NOT IN ('es', 'fr')) AS lang_en,
            count(*) FILTER (doc_id % 5 > 0 AND lang = 'es') AS lang_es, count(*) FILTER (doc_id % 5 > 0 AND lang = 'fr') AS lang_fr FROM documents""",
        "year_groups": "SELECT year, attr, count(*)::BIGINT AS freq FROM (SELECT year(o_orderdate)::VARCHAR AS year, unnest([o_orderstatus, o_orderpriority]) AS attr FROM orders) GROUP BY ALL",
        "tag_counts_outer": f"SELECT tag, count(*) FILTER (f = 'a')::BIGINT AS a, count(*) FILTER (f = 'b')::BIGINT AS b FROM (SELECT tag_a AS tag, 'a' AS f FROM ({TAGS}) UNION ALL SELECT tag_b, 'b' FROM ({TAGS})) GROUP BY tag",
        "tag_mapping": f"SELECT CASE tag_b WHEN 'NOUN' THEN 'N' WHEN 'VERB' THEN 'V' ELSE tag_b END AS upos, count(*)::BIGINT AS n FROM ({TAGS}) GROUP BY 1",
        "tag_diff_pct": DIFFS,
        "tag_diff_pairs": f"SELECT tag_a, tag_b, sum(n)::BIGINT AS n FROM ({DIFFS}) GROUP BY ALL",
        "tag_diff_top": f"SELECT word, tag_a, tag_b, n FROM ({DIFFS}) ORDER BY n DESC, word, tag_a, tag_b LIMIT 25",
        "tag_diff_sample": f"SELECT word, tag_a, tag_b FROM ({DIFFS}) ORDER BY md5('0:' || word || '|' || tag_a || '|' || tag_b), word, tag_a, tag_b LIMIT 25",
        "compare_summary": f"""SELECT count(*)::BIGINT AS total, count(*) FILTER (p)::BIGINT AS compared, count(*) FILTER (p AND tag_a = tag_b)::BIGINT AS same, count(*) FILTER (p AND tag_a <> tag_b)::BIGINT AS diff,
            count(*) FILTER (NOT p)::BIGINT AS ignored, round(100.0::DOUBLE * count(*) FILTER (p AND tag_a = tag_b) / count(*) FILTER (p), 6) AS same_pct, round(100.0::DOUBLE * count(*) FILTER (p AND tag_a <> tag_b) / count(*) FILTER (p), 6) AS diff_pct
            FROM (SELECT *, tag_a <> 'PUNCT' AS p FROM ({TAGS}))""",
        "diff_islands": f"""WITH s AS (SELECT doc_id, sent, pos, (tag_a = tag_b)::INT AS same FROM ({TAGS})), g AS (SELECT *, coalesce((same <> lag(same) OVER (PARTITION BY doc_id, sent ORDER BY pos))::INT, 0) AS c FROM s),
            i AS (SELECT *, sum(c) OVER (PARTITION BY doc_id, sent ORDER BY pos)::BIGINT AS island FROM g) SELECT doc_id, sent, island, count(*)::BIGINT AS n, max(same) AS same FROM i GROUP BY doc_id, sent, island""",
        "diff_errors": f"SELECT doc_id, sent, len(regexp_extract_all(string_agg(CASE WHEN tag_a = tag_b THEN '0' WHEN pos % 3 = 0 THEN '2' ELSE '1' END, '' ORDER BY pos), '010|020'))::BIGINT AS errors FROM ({TAGS}) GROUP BY ALL",
        "align_pairs": f"""WITH {UNLIKE}, c AS (SELECT upos FROM u WHERE change = 'C' AND (ahead = 0 OR behind = 0))
            SELECT upos AS left_tag, upos || '~' AS right_tag, count(*)::BIGINT AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM c), 6) AS diff_pct,
                round(100.0::DOUBLE * count(*) / ((SELECT count(*) FROM c) + (SELECT count(*) FROM g WHERE change = 'S')), 6) AS total_pct FROM c GROUP BY upos""",
        "align_ignored": f"""WITH {UNLIKE}, m AS (SELECT doc_id, run, string_agg(word || ' ' || upos, ' ' ORDER BY sent, pos) AS l,
                string_agg(CASE change WHEN 'C' THEN word || ' ' || upos || '~' WHEN 'X' THEN word || 'a ' || upos || ' ' || word || 'b ' || upos END, ' ' ORDER BY sent, pos) AS r FROM u WHERE ahead > 0 AND behind > 0 GROUP BY ALL)
            SELECT l AS "left", r AS "right", count(*)::BIGINT AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM m WHERE r IS NOT NULL), 6) AS ignored_pct FROM m WHERE r IS NOT NULL GROUP BY ALL""",
        "sentence_batches": f"SELECT doc_id, (sent // 3)::BIGINT AS batch, (count(*) + count(DISTINCT sent))::BIGINT AS lines FROM ({TOKENS}) GROUP BY ALL",
        "appended_files": "SELECT source, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) || ',' || string_agg('x' || doc_id, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY source",
        "tsv_round_trip": "SELECT doc_id, source, lang FROM documents",
        "attribute_lists": f"""SELECT doc_id AS id, '<doc id=' || {quote('doc_id::VARCHAR')} || ' file_id="FILE_ID" source__name=' || {quote("source || '|a%7Cb'")} || ' theme__name=' || {quote('lang')} || ' >' AS doc_tag FROM documents""",
        "text_bytes": "SELECT doc_id, octet_length(encode(text))::BIGINT AS bytes FROM documents",
        "empty_lists": "SELECT event_id, event_id % 3 = 0 AS empty FROM events",
        "capped_groups": f"""WITH s AS (SELECT doc_id, sent, count(*) + 1 AS n FROM ({TOKENS}) GROUP BY ALL),
            o AS (SELECT *, (n + 4) // 5 AS k, coalesce(sum((n + 4) // 5) OVER (PARTITION BY doc_id ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
            g AS (SELECT doc_id, n, before, unnest(range(k)) AS i FROM o)
            SELECT doc_id, (before + i)::BIGINT AS "group", least(5, n - 5 * i)::BIGINT AS lines FROM g""",
        "name_joins": f"""WITH t AS (SELECT doc_id, sent, pos, CASE WHEN regexp_matches(word, '^\\p{{Lu}}') AND NOT (pos = 1 AND length(word) % 2 = 0) THEN 'C' WHEN lower(word) IN ('de', 'la', 'of', 'the', 'und') THEN 'F' ELSE 'X' END AS c FROM ({TOKENS})),
            s AS (SELECT doc_id, string_agg(c, '' ORDER BY pos) AS c FROM t GROUP BY doc_id, sent),
            n AS (SELECT doc_id, length(c) AS size, list_filter(list_transform(regexp_extract_all(c, 'C(?:F*C)*'), lambda x: length(x)), lambda x: x > 1) AS l FROM s)
            SELECT doc_id, sum(len(l))::BIGINT AS names, sum(size - coalesce(list_sum(l), 0) + len(l))::BIGINT AS tokens, max(coalesce(list_max(l), 1))::BIGINT AS longest FROM n GROUP BY doc_id""",
        "name_tags": f"""WITH t AS (SELECT word, lower(word) AS lemma, ['NN', 'VB', 'NNS', 'JJ', 'ZZ'][pos % 5 + 1] AS tag, pos = 1 AS first, pos % 3 = 0 AS guessed, length(word) % 2 = 0 AS known, regexp_matches(word, '^\\p{{Lu}}') AS up FROM ({TOKENS})),
            r AS (SELECT *, CASE WHEN NOT up THEN NULL WHEN first THEN CASE WHEN guessed THEN CASE WHEN tag[1] = 'N' THEN 'NP' || tag[3:] ELSE 'NP00000' END END WHEN tag[1] = 'N' THEN 'NP' || tag[3:] WHEN NOT known THEN 'NP00000' END AS new FROM t)
            SELECT coalesce(new, tag) AS tag, (new IS NOT NULL OR lower(lemma) = word) AS form, count(*)::BIGINT AS n FROM r GROUP BY ALL""",
        "lempos_table": f"SELECT lemma || '-' || CASE pos % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'v' WHEN 2 THEN 'n' ELSE 'x' END AS lempos, count(*)::BIGINT AS n FROM ({TOKENS}) GROUP BY ALL",
        "markup": "SELECT doc_id, (length(text) - length(replace(text, chr(10), '')))::BIGINT AS breaks, ((length(text) - length(replace(text, ', ', ''))) // 2)::BIGINT AS tags FROM documents WHERE trim(text, ' ' || chr(9)) <> ''",
        "lid_incremental": f"SELECT doc_id, l1, l1_size, 'profile' AS tool FROM documents LEFT JOIN ({L1}) USING (doc_id)",
        "lengths_in_time": "SELECT doc_id, length(text)::BIGINT AS n, NULL::VARCHAR AS error FROM documents",
        "named_files": """WITH b AS (SELECT text, doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 + 1 AS batch FROM documents), f AS (SELECT batch, string_agg(text, chr(10) ORDER BY doc_id) AS t FROM b GROUP BY batch),
            l AS (SELECT batch, string_split(t, chr(10)) AS l FROM f) SELECT batch::BIGINT AS batch, len(l)::BIGINT AS lines, list_sum(list_transform(l, lambda x: length(x)))::BIGINT AS chars FROM l""",
        "text_counts": "SELECT doc_id, CASE WHEN doc_id % 9 = 0 OR trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN NULL ELSE text END AS text, 'profile' AS tool FROM documents WHERE doc_id % 11 <> 0",
        "align_tokens": f"""SELECT doc_id, count(*) FILTER (pos % 7 <> 3 AND pos % 5 <> 0)::BIGINT AS same, count(*)::BIGINT AS n_left, count(*) FILTER (pos % 7 <> 3)::BIGINT AS n_right FROM ({TOKENS}) GROUP BY doc_id""",
        "align_codes": f"""WITH t AS (SELECT doc_id, sent, pos, CASE WHEN pos % 7 = 3 THEN 'D' WHEN pos % 11 = 1 THEN 'X' WHEN pos % 5 = 0 THEN 'C' ELSE 'S' END AS change FROM ({TOKENS})),
            g AS (SELECT *, sum((change = 'S')::INT) OVER (PARTITION BY doc_id ORDER BY sent, pos) AS run FROM t),
            r AS (SELECT doc_id, run, coalesce(string_agg(change, '' ORDER BY sent, pos) FILTER (change <> 'S'), '') AS c, bool_or(change = 'S') AS s FROM g GROUP BY ALL),
            k AS (SELECT *, trim(c, 'C') AS mid, CASE WHEN s THEN '0' ELSE '' END || repeat('1', length(c)) || repeat('2', length(replace(replace(c, 'D', ''), 'X', 'XX'))) AS codes FROM r)
            SELECT doc_id, (count(*) FILTER (s) + sum(length(c) - length(mid)))::BIGINT AS compared, count(*) FILTER (s)::BIGINT AS same, sum(length(c) - length(mid))::BIGINT AS different,
                count(*) FILTER (contains(mid, 'X'))::BIGINT AS ignored, count(*) FILTER (mid <> '' AND NOT contains(mid, 'X'))::BIGINT AS alone,
                len(regexp_extract_all(string_agg(codes, '' ORDER BY run), '010|020'))::BIGINT AS errors FROM k GROUP BY doc_id""",
        "np_phrases": f"""WITH s AS (SELECT doc_id, sent, string_agg(cls, '' ORDER BY pos) AS c, count(*) AS n FROM ({TAGGED}) GROUP BY ALL)
            SELECT doc_id, sum(coalesce(list_sum(list_transform(list_filter(regexp_extract_all(c, '{PHRASE}'), lambda x: length(x) >= 2), lambda x: length(x))), 0))::BIGINT AS inside, sum(n)::BIGINT AS tokens FROM s GROUP BY doc_id""",
        "np_fill": f"""WITH s AS (SELECT doc_id, sent, regexp_extract_all(regexp_replace(string_agg(cls, '' ORDER BY pos), '({PHRASE})', '<\\1>', 'g'), '.') AS c FROM ({TAGGED}) GROUP BY ALL),
            m AS (SELECT doc_id, sent, unnest(c) AS ch, unnest(range(len(c))) AS place FROM s),
            o AS (SELECT *, sum((ch = '<')::INT) OVER (PARTITION BY doc_id, sent ORDER BY place) AS opened, sum((ch = '>')::INT) OVER (PARTITION BY doc_id, sent ORDER BY place) AS closed FROM m),
            p AS (SELECT doc_id, sent, row_number() OVER (PARTITION BY doc_id, sent ORDER BY place) AS pos, CASE WHEN opened > closed THEN opened END AS ph FROM o WHERE ch NOT IN ('<', '>')),
            q AS (SELECT doc_id, sent, pos, CASE WHEN count(ph) OVER (PARTITION BY doc_id, sent, ph) >= 2 THEN ph END AS phrase FROM p)
            SELECT doc_id, sent, pos, {fill('gender', 'C', 'M,F', "'M', 'F'")} AS gender_filled, {fill('number', 'N', 'S,P', "'S', 'P'")} AS number_filled
            FROM ({TAGGED}) t JOIN q USING (doc_id, sent, pos) WINDOW w AS (PARTITION BY doc_id, sent, phrase ORDER BY pos)""",
        "tag_classes": """SELECT c[1] AS cls, c[2] AS gender, c[3] AS number, count(*)::BIGINT AS n FROM (
            SELECT [['N', 'M', 'S'], ['A', 'C', 'P'], ['D', 'F', 'S'], ['V', 'M', 'S'], ['S', '0', '0'], ['X', '0', '0']][(event_id % 6 + 1)::INT] AS c FROM events) GROUP BY ALL""",
        "noun_phrases": f"""WITH s AS (SELECT doc_id, sent, string_agg(substring('SDNXDPNASDDNPOAXDDDVSPNDPXOOD', ((pos * 7 + sent) % 29 + 1)::INT, 1), '' ORDER BY pos) AS c FROM ({TOKENS}) GROUP BY ALL)
            SELECT doc_id, sent, array_to_string(list_filter(regexp_extract_all(c, '{PHRASE}'), lambda x: length(x) >= 2), ' ') AS spans FROM s""",
        "token_classes": """WITH t AS (SELECT ['NCMS000', 'AQ0CP0', 'DA0FS0', 'VMP00SM', 'SPS00', 'Fc', 'PD0MS000', 'PI0FP000', 'PR0MS000', 'PT0FP000', 'RN', 'NP00000'][(event_id % 12 + 1)::INT] AS tag,
                ['no', 'Cuyo', 'CUÁNTAS', 'que', 'No'][(event_id % 5 + 1)::INT] AS word FROM events),
            c AS (SELECT tag, word, CASE
                WHEN tag = 'DA0FS0' THEN 'DFS' WHEN tag = 'SPS00' THEN 'S00' WHEN tag = 'PD0MS000' THEN 'PMS' WHEN tag = 'PI0FP000' THEN 'PFP'
                WHEN tag = 'PR0MS000' AND lower(word) IN ('cuyo', 'cuya', 'cuyos', 'cuyas') THEN 'PMS' WHEN tag = 'PT0FP000' AND lower(word) IN ('cuántos', 'cuántas') THEN 'PFP'
                WHEN tag = 'AQ0CP0' THEN 'ACP' WHEN tag = 'NCMS000' THEN 'NMS' WHEN tag = 'NP00000' THEN 'N00' WHEN tag = 'VMP00SM' THEN 'VMS' WHEN lower(word) = 'no' THEN 'O00' ELSE 'X00' END AS k FROM t)
            SELECT tag, word, substring(k, 1, 1) AS cls, substring(k, 2, 1) AS gender, substring(k, 3, 1) AS number, count(*)::BIGINT AS n FROM c GROUP BY ALL""",
        "gender_lemma_rules": """WITH t AS (SELECT ['gato', 'alto', 'dicho', 'uno', 'de+el', 'a+el', 'gato'][(event_id % 7 + 1)::INT] AS lemma, ['NCFP000', 'AQ0FP0', 'VMP00PF', 'DI0FP0', 'SPCMS', 'SPCMS', 'VMIP3P0'][(event_id % 7 + 1)::INT] AS tag FROM events)
            SELECT lemma, tag, CASE lemma WHEN 'de+el' THEN 'del' WHEN 'a+el' THEN 'al' WHEN 'alto' THEN 'alta' WHEN 'dicho' THEN 'dicha' WHEN 'uno' THEN 'una' ELSE CASE WHEN tag = 'NCFP000' THEN 'gata' ELSE lemma END END AS gender_lemma,
                   count(*)::BIGINT AS n FROM t GROUP BY ALL""",
        "gender_lemmas": """SELECT lemma, tag, CASE WHEN lemma = 'view' AND tag = 'NCMP0' THEN 'la view' WHEN lemma = 'click' AND tag = 'NCFP0' THEN 'la click' ELSE lemma END AS gender_lemma, count(*)::BIGINT AS n
            FROM (SELECT event_type AS lemma, CASE WHEN event_id % 2 = 0 THEN 'NCMP0' ELSE 'NCFP0' END AS tag FROM events) GROUP BY ALL""",
        "glue": f"SELECT doc_id, count(*) FILTER (pos > 1 AND upos = 'PUNCT')::BIGINT AS glued FROM ({TOKENS}) GROUP BY doc_id",
        "proper_nouns": f"SELECT doc_id, count(*) FILTER (regexp_matches(word, '^\\p{{Lu}}') AND (pos > 1 OR upos = 'PROPN'))::BIGINT AS names FROM ({TOKENS}) GROUP BY doc_id",
    }
