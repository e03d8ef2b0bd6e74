"""WARC derivatives: metadata and plain-text conversion records of response records.

All of it is column expressions, without a shuffle.  A derived record names its source
in WARC-Refers-To and repeats its target and date; the metadata record also carries
the source's HTTP headers and payload digest as fields, with title, language and
outlinks.  Digests are `sha1:` in base 32, record ids are name-based and so the same
on every run.

Edge cases: a null payload or header block is empty; a null target or date is left out of the
header; a null record id refers to nothing (the line is left out).  Rows are independent, so repeated rows give
equal records.  Entities are decoded from the list below, any other stays as written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# Entities and what they stand for; the ampersand is last.
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"),
    ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"),
    ("&amp;", "&"),
)
# What holds no text, and tags that end a line.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
    r"|<style\b.*?(?:</style\s*>|\z)|<head\b.*?(?:</head\s*>|\z)"
)
LINE_TAGS = (
    r"(?i)</?(?:p|div|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|td|th|thead|tbody|section|article"
    r"|header|footer|nav|aside|main|form|pre|blockquote|figure|figcaption|title|body|html)\b[^>]*(?:>|\z)"
)
TAGS = r"<[A-Za-z/!?][^>]*(?:>|\z)"


def base32(sha1_hex: Column) -> Column:
    """Five hex digits at a time become four of base 32."""
    group = lambda i: F.lpad(F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 32), 4, "0")
    digits = F.concat(*[group(i) for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), base32(F.sha1(F.encode(block, "UTF-8"))))


def record_id(*names: Column) -> Column:
    """A name-based id: the MD5 of the names in the form of a UUID of version 3."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(n.cast("string"), F.lit("")) for n in names]))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def with_plain_text(pages: DataFrame, html: str, name: str) -> DataFrame:
    """Adds the text of a page: no scripts, styles, comments, head or tags; one line for each block.

    Entities are looked for only where there is an ampersand, and white space is
    rewritten only where it is more than one blank or one line break.
    """
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, LINE_TAGS, "\n"), TAGS, "")
    pages = pages.withColumn(name, text)
    text = F.col(name)
    decoded = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    pages = pages.withColumn(name, F.when(F.contains(text, F.lit("&")), decoded).otherwise(text))
    text = F.regexp_replace(F.regexp_replace(name, r"[ \t\r\f]{2,}|[\t\r\f]", " "), r" \n[ \n]*|\n[ \n]+", "\n")
    return pages.withColumn(name, F.btrim(text, F.lit(" \n")))


def responses(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages: (source, record_id, target_uri, date, http_header, payload)."""
    payload = F.coalesce(F.col(html), F.lit(""))
    header = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
    )
    return pages.select(
        F.col(id).alias("source"),
        record_id(F.lit("response"), F.col(id), F.col(url)).alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(date).alias("date"),
        header.alias("http_header"),
        payload.alias("payload"),
    )


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response record, as its columns followed by header and block.

    (source, warc_type, record_id, refers_to, target_uri, source_digest, block_digest,
    content_length, header, block)
    """
    payload = F.coalesce("payload", F.lit(""))
    r = records.select("source", "record_id", "target_uri", "date", "http_header", payload.alias("payload"), digest(payload).alias("source_digest"))
    line = lambda c: F.regexp_replace(c, r"[\r\n]+", " ")
    title = line(F.regexp_extract("payload", r"(?is)<title\b[^>]*>(.*?)</title", 1))
    lang = F.regexp_extract("payload", r"(?is)<html\b[^>]*?\slang=[\"']?([A-Za-z0-9-]+)", 1)
    links = F.regexp_extract_all("payload", F.lit(r"(?is)<a\b[^>]*?\shref=[\"']([^\"'\r\n]*)[\"']"), F.lit(1))
    # evaluated once, although the fields name them twice
    r = with_plain_text(r.withColumns({"title": title, "lang": lang}), "payload", "plain")
    title, lang = F.col("title"), F.col("lang")
    fields = F.concat_ws(
        CRLF,
        F.when(F.coalesce("http_header", F.lit("")) != "", F.regexp_replace("http_header", r"(?m)^", "source-http: ")),
        _field("source-payload-digest", F.col("source_digest")),
        _field("source-payload-length", F.octet_length("payload").cast("string")),
        F.when(title != "", _field("title", title)),
        F.when(lang != "", _field("language", lang)),
        F.transform(links, lambda x: _field("outlink", x)),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("type"), F.col("plain").alias("block")),
    )
    two = r.select("source", F.col("record_id").alias("refers_to"), "target_uri", "date", "source_digest", F.explode(kinds).alias("d")).select("*", "d.*")
    two = two.withColumn("record_id", record_id(F.col("warc_type"), F.col("refers_to"), F.col("source_digest")))
    two = two.withColumn("block_digest", digest(F.col("block"))).withColumn("content_length", F.octet_length("block").cast("long"))
    header = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        _field("WARC-Type", F.col("warc_type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Block-Digest", F.col("block_digest")),
        _field("Content-Type", F.col("type")),
        _field("Content-Length", F.col("content_length").cast("string")),
    )
    return two.select("source", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "content_length", header.alias("header"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """Writes derived records as WARC files, one for each task; records end in two line breaks."""
    record = F.concat("header", F.lit(CRLF + CRLF), "block")
    records.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
