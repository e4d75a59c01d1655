"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Each response gives two records that refer to it by id and carry its target, date, digests and
HTTP headers: ``metadata`` (title, source headers and outgoing links as warc-fields) and
``conversion`` (the page as plain text). A record follows from its response's own row, so there is
no shuffle. Pages are read by one Arrow function in time linear in their length, unclosed tags
included; identifiers, digests and records are SQL expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Record layout, elements whose content is no text, elements that end a line,
# and the characters of named entities (the ampersand is decoded last).
VERSION = "WARC/1.1"
CRLF = "\r\n"
HIDDEN = ("script", "style", "noscript", "template")
LINES = (
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr li main nav ol option p pre section table tbody td tfoot th thead title tr ul"
).split()
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "middot": "·", "copy": "©", "reg": "®",
    "trade": "™", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“",
    "rdquo": "”", "laquo": "«", "raquo": "»", "bull": "•", "euro": "€", "sect": "§", "deg": "°", "amp": "&",
}
DECIMAL, HEXADECIMAL = "&#([0-9]{1,7});", "&#[xX]([0-9a-fA-F]{1,6});"
COMMENT = "(?s)<!--.*?-->"
LINE_TAG = rf"(?i)</?(?:{'|'.join(LINES)})(?:[ \t\r\n/][^>]*)?>"
TITLE = "(?is)<title[^>]*>(.*?)</title"
OUTLINK = r"""(?i)<a[ \t\r\n][^>]*?href[ \t\r\n]*=[ \t\r\n]*["']([^"'>]*)["']"""
# What the SQL of op1 leaves out: all other names of the HTML table, and values that are not
# quoted or hold the other quote. The value is taken with its quotes.
NAMED = "&([A-Za-z][A-Za-z0-9]*);"
HREF = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*("[^">]*"|'[^'>]*'|[^ \t\r\n"'>]+)"""
CHARACTERS = ENTITIES | {n[:-1]: c for n, c in html5.items() if n.endswith(";") and n[:-1] not in ENTITIES}


def _compiled(pattern: str) -> re.Pattern:
    """Case is ignored for ASCII letters only, as SQL does."""
    return re.compile(pattern, re.ASCII)


_BREAKS, _BLANKS, _LINE_ENDS = re.compile("[\r\n]+"), re.compile("[ \t\r\f\xa0]+"), re.compile(" ?\n[ \n]*")
_LINE_TAG, _TAG = _compiled(LINE_TAG), re.compile("<[^>]*>")
_TITLE_OPEN, _TITLE_CLOSE = _compiled("(?i)<title"), _compiled("(?i)</title")
_LINK_OPEN, _HREF = _compiled(r"(?i)<a[ \t\r\n]"), _compiled(HREF)
_HIDDEN = [(_compiled(f"(?i)<{tag}(?=[ \\t\\r\\n>])"), _compiled(f"(?i)</{tag}")) for tag in HIDDEN]
_DECIMAL, _HEXADECIMAL, _NAMED = _compiled(DECIMAL), _compiled(HEXADECIMAL), _compiled(NAMED)


def hidden(tag: str) -> str:
    return f"(?is)<{tag}(?:[ \\t\\r\\n][^>]*)?>.*?</{tag}[^>]*>"


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _record_id(*parts: Column) -> Column:
    """A name-based UUID: the same response always gives the same ids."""
    name = F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    pieces = (F.substr(name, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12)))
    a, b, c, d, e = pieces
    return F.concat(F.lit("urn:uuid:"), a, F.lit("-"), b, F.lit("-8"), c, F.lit("-a"), d, F.lit("-"), e)


def _one_line(value: Column) -> Column:
    """Header values must not hold line breaks."""
    return F.regexp_replace(value, "[\r\n]+", " ")


def _character(code: int) -> str:
    """A character by number; U+FFFD if there is none."""
    return chr(code) if 1 <= code <= 0xD7FF or 0xE000 <= code <= 0x10FFFF else "\ufffd"


def decoded(text: str) -> str:
    """Numeric references, then named ones of the HTML table, each once; unknown names stay."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _DECIMAL.sub(lambda m: _character(int(m[1])), text)
        text = _HEXADECIMAL.sub(lambda m: _character(int(m[1], 16)), text)
    return _NAMED.sub(lambda m: CHARACTERS.get(m[1], m[0]), text)


def tidy(text: str) -> str:
    """Runs of blanks become one space, blank lines go, and both ends are trimmed."""
    text = _LINE_ENDS.sub("\n", _BLANKS.sub(" ", text))
    return text.removeprefix("\n").removesuffix("\n").strip(" ")


def _without_comments(html: str) -> str:
    """Without what lies between an opening and the next closing mark; an unclosed one stays."""
    kept, at = [], 0
    while (start := html.find("<!--", at)) >= 0 and (end := html.find("-->", start + 4)) >= 0:
        kept.append(html[at:start])
        at = end + 3
    return html if not at else "".join([*kept, html[at:]])


def _without_element(html: str, opening: re.Pattern, closing: re.Pattern) -> str:
    """Without an element and its content; an opening tag that nothing closes stays.

    If one opening tag has no end or no closing tag behind it, no later one has either.
    """
    kept, at = [], 0
    while start := opening.search(html, at):
        body = html.find(">", start.end())
        close = closing.search(html, body + 1) if body >= 0 else None
        end = html.find(">", close.end()) if close else -1
        if end < 0:
            break
        kept.append(html[at : start.start()])
        at = end + 1
    return html if not at else "".join([*kept, html[at:]])


def page_text(html: str) -> str:
    """Visible text with a line per block element; source line breaks are blanks."""
    html = _without_comments(_BREAKS.sub(" ", html))
    for opening, closing in _HIDDEN:
        html = _without_element(html, opening, closing)
    # Every tag that begins in the first part has an end there; the rest holds no whole tag.
    for pattern, replacement in ((_LINE_TAG, "\n"), (_TAG, "")):
        end = html.rfind(">") + 1
        html = pattern.sub(replacement, html[:end]) + html[end:]
    return tidy(decoded(html))


def page_title(html: str) -> str:
    start = _TITLE_OPEN.search(html)
    body = html.find(">", start.end()) + 1 if start else 0
    end = _TITLE_CLOSE.search(html, body) if body else None
    return _BREAKS.sub(" ", tidy(decoded(html[body : end.start()]))) if end else ""


def page_links(html: str) -> list[str]:
    """Values of the first href of each link, on one line each."""
    found, at = [], 0
    while start := _LINK_OPEN.search(html, at):
        end = html.find(">", start.end())
        end = len(html) if end < 0 else end
        if value := _HREF.search(html, start.end(), end):
            link = value[1]
            found.append(_BREAKS.sub(" ", link[1:-1] if link[0] in "\"'" else link))
        at = value.end() if value else end
    return found


@F.arrow_udf(T.StringType())
def decode_entities(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else decoded(t) for t in text.to_pylist()], pa.string())


_PARTS = T.StructType().add("title", "string").add("links", T.ArrayType(T.StringType())).add("text", "string")
_PARTS_TYPE = pa.struct([("title", pa.string()), ("links", pa.list_(pa.string())), ("text", pa.string())])


@F.arrow_udf(_PARTS)
def page_parts(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Title (empty if there is none), links and plain text of each page."""
    for batch in html:
        rows = [{"title": page_title(h), "links": page_links(h), "text": page_text(h)} for h in batch.to_pylist()]
        yield pa.array(rows, _PARTS_TYPE)


def page_responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records (record_id, target_uri, date, http_headers, payload, source) of fetched
    pages. A null page is an empty payload; ``source`` is the page_id."""
    html = F.coalesce("html", F.lit(""))
    return pages.select(
        _record_id(F.lit("response"), F.col("page_id"), F.col("url"), html).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                 F.octet_length(html), F.lit(CRLF)).alias("http_headers"),
        html.alias("payload"), F.col("page_id").alias("source"),
    )


def _fields(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value has no line."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), v, F.lit(CRLF))).otherwise("") for name, v in pairs]
    return F.concat(*lines)


def derive_records(responses: DataFrame) -> DataFrame:
    """Two records per response: (source, warc_type, record_id, refers_to, target_uri, date,
    content_type, payload_digest, block_digest, n_bytes, block, record).

    ``payload_digest`` is the source's; ``record`` is the whole WARC record without the two
    line breaks that end it. An empty payload gives an empty conversion. A null target has no
    header line. Equal responses give equal records with equal ids. Other columns are ignored.
    """
    parts = responses.select(
        "source", "record_id", F.coalesce("payload", F.lit("")).alias("payload"),
        F.coalesce("http_headers", F.lit("")).alias("http_headers"),
        _one_line(F.col("target_uri")).alias("target_uri"), "date",
    ).withColumns({
        "source_payload": _digest(F.col("payload")),
        "source_block": _digest(F.concat("http_headers", F.lit(CRLF), "payload")),
    })
    parts = parts.withColumn("parts", page_parts("payload"))
    title = F.nullif(F.col("parts.title"), F.lit(""))
    outlinks = F.array_join(F.transform("parts.links", lambda u: F.concat(F.lit("outlink: "), u, F.lit(CRLF))), "")
    source_headers = F.regexp_replace(F.regexp_replace("http_headers", "^", "http: "), "\r\n(.)", "\r\nhttp: $1")
    metadata = F.concat(
        _fields([("title", title), ("sourcePayloadDigest", F.col("source_payload")),
                 ("sourceBlockDigest", F.col("source_block"))]),
        F.when(F.col("http_headers") != "", source_headers).otherwise(""), outlinks,
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                 metadata.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("parts.text").alias("block")),
    )
    rows = parts.select(
        "source", F.col("record_id").alias("refers_to"), "target_uri", "date",
        F.col("source_payload").alias("payload_digest"), "source_block", F.explode(kinds).alias("k"),
    ).select("*", "k.*").drop("k").withColumns({
        "record_id": _record_id(F.col("warc_type"), F.col("refers_to")),
        "block_digest": _digest(F.col("block")), "n_bytes": F.octet_length("block").cast("long"),
    })
    head = _fields([
        ("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        ("WARC-Date", F.col("date")), ("WARC-Refers-To", F.concat(F.lit("<"), "refers_to", F.lit(">"))),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To-Date", F.col("date")), ("WARC-Source-Payload-Digest", F.col("payload_digest")),
        ("WARC-Source-Block-Digest", F.col("source_block")), ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")), ("Content-Length", F.col("n_bytes").cast("string")),
    ])
    return rows.select(
        "source", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "payload_digest",
        "block_digest", "n_bytes", "block",
        F.concat(F.lit(VERSION + CRLF), head, F.lit(CRLF), "block").alias("record"),
    )


def write_records(records: DataFrame, path: str) -> None:
    """WARC files below a folder; each record ends with two line breaks."""
    records.select("record").write.option("lineSep", CRLF * 2).text(path)


DATE = "2024-01-01T00:00:00Z"


def op1_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    """Both derived records of every page, with digests of their content."""
    records = derive_records(page_responses(spark.read.parquet(f"{sf_dir}/pages.parquet"), DATE))
    return records.select(
        F.col("source").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "payload_digest",
        "block_digest", "n_bytes", F.sha2("record", 256).alias("record_sha256"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_tidy(text: str) -> str:
    text = f"regexp_replace({text}, '[ \\t\\r\\f ]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', '\\n', 'g')".replace("'\\n'", "chr(10)")
    return f"trim(regexp_replace({text}, '^\\n|\\n$', '', 'g'), ' ')"


def _sql_entities(text: str) -> str:
    for pattern, code in ((DECIMAL, "c::INTEGER"), (HEXADECIMAL, "('0x' || c)::INTEGER")):
        codes = f"regexp_extract_all(x, {_quoted(pattern)}, 1)"
        valid = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}) ELSE chr(65533) END"
        pieces = f"string_split_regex(x, {_quoted(pattern.replace('(', '(?:'))})"
        joined = (
            f"list_aggregate(list_transform(list_zip({pieces}, list_transform({codes}, lambda c: {valid})), "
            "lambda p: concat(p[1], coalesce(p[2], ''))), 'string_agg', '')"
        )
        text = f"(SELECT CASE WHEN contains(x, '&#') THEN {joined} ELSE x END FROM (SELECT {text} AS x))"
    for name, character in ENTITIES.items():
        text = f"replace({text}, '&{name};', {_quoted(character)})"
    return text


def op1_sql() -> str:
    """The same rows in DuckDB."""
    text = "regexp_replace(payload, '[\\r\\n]+', ' ', 'g')"
    for pattern in (COMMENT, *map(hidden, HIDDEN)):
        text = f"regexp_replace({text}, {_quoted(pattern)}, '', 'g')"
    text = f"regexp_replace({text}, {_quoted(LINE_TAG)}, chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    crlf = "chr(13) || chr(10)"

    def uuid(*parts: str) -> str:
        name = "sha256(concat_ws('|', " + ", ".join(f"coalesce({p}::VARCHAR, '')" for p in parts) + "))"
        return (
            f"'urn:uuid:' || {name}[1:8] || '-' || {name}[9:12] || '-8' || {name}[14:16] || '-a' || {name}[18:20] "
            f"|| '-' || {name}[21:32]"
        )

    def line(name: str, value: str) -> str:
        return f"coalesce('{name}: ' || {value} || {crlf}, '')"

    head = " || ".join([
        line("WARC-Type", "warc_type"), line("WARC-Record-ID", "'<' || record_id || '>'"), line("WARC-Date", _quoted(DATE)),
        line("WARC-Refers-To", "'<' || refers_to || '>'"), line("WARC-Target-URI", "target_uri"),
        line("WARC-Refers-To-Target-URI", "target_uri"), line("WARC-Refers-To-Date", _quoted(DATE)),
        line("WARC-Source-Payload-Digest", "payload_digest"), line("WARC-Source-Block-Digest", "source_block"),
        line("WARC-Block-Digest", "block_digest"), line("Content-Type", "content_type"),
        line("Content-Length", "n_bytes::VARCHAR"),
    ])
    title = _sql_tidy(_sql_entities(f"regexp_extract(payload, {_quoted(TITLE)}, 1)"))
    return f"""
WITH fetched AS (
  SELECT page_id, {uuid("'response'", 'page_id', 'url', "coalesce(html, '')")} AS refers_to,
    regexp_replace(url, '[\\r\\n]+', ' ', 'g') AS target_uri, coalesce(html, '') AS payload,
    'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: '
      || strlen(coalesce(html, '')) || {crlf} AS http_headers
  FROM pages
), digested AS (
  SELECT *, 'sha256:' || sha256(payload) AS payload_digest,
    'sha256:' || sha256(http_headers || {crlf} || payload) AS source_block,
    nullif(regexp_replace({title}, '[\\r\\n]+', ' ', 'g'), '') AS title,
    {_sql_tidy(_sql_entities(text))} AS plain,
    coalesce(list_aggregate(list_transform(regexp_extract_all(payload, {_quoted(OUTLINK)}, 1),
      lambda u: 'outlink: ' || regexp_replace(u, '[\\r\\n]+', ' ', 'g') || {crlf}), 'string_agg', ''), '') AS outlinks
  FROM fetched
), both_kinds AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    {line('title', 'title')} || {line('sourcePayloadDigest', 'payload_digest')} || {line('sourceBlockDigest', 'source_block')}
      || 'http: HTTP/1.1 200 OK' || {crlf} || 'http: Content-Type: text/html; charset=utf-8' || {crlf}
      || 'http: Content-Length: ' || strlen(payload) || {crlf} || outlinks AS block
  FROM digested
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', plain FROM digested
), numbered AS (
  SELECT *, {uuid('warc_type', 'refers_to')} AS record_id, 'sha256:' || sha256(block) AS block_digest,
    strlen(block) AS n_bytes
  FROM both_kinds
)
SELECT page_id, warc_type, record_id, refers_to, target_uri, payload_digest, block_digest, n_bytes,
  sha256('WARC/1.1' || {crlf} || {head} || {crlf} || block) AS record_sha256
FROM numbered
"""
