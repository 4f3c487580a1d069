"""WARC derivatives (operator 7): response records to linked metadata and plain-text conversion records.

Each response gives two records.  The ``metadata`` record lists what the response says of
itself and of its page (title, language, links, the source's headers and digests); the
``conversion`` record is the page's plain text.  Both name the response in
``WARC-Refers-To`` and keep its target URI and date; the metadata names the conversion as
``Derived-Conversion``.  Identifiers are name-based, so a rerun makes the same records.

The derivatives are Spark SQL expressions over one narrow pass.  ``read_responses`` reads the
response records of WARC files, ``responses`` makes them of a table of pages, and
``write_warc`` writes records as gzipped members.

Defined results: a null URL or body counts as empty; an empty page gives empty text and no
links; a null id is kept; repeated responses give records with equal identifiers; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import giving_back, ship_package

DATE = "2024-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: The named entities of HTML that plain text decodes, ampersand last (numeric ones come right before it).
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
#: Elements that end a line of text.
_BLOCKS = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|blockquote|pre)\b[^>]*>"
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>"


def digest(c: Column) -> Column:
    """``sha1:`` and the base-32 form of a string's SHA-1, as WARC writes it."""

    def letter(h: Column, i: Column) -> Column:
        """The i-th of 32 letters: five of the twenty bits that five hex digits hold."""
        bits = F.conv(F.substring(h, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        place = F.call_function("shiftright", bits, F.lit(15) - 5 * (i % 4)).bitwiseAND(F.lit(31)) + 1
        return F.substring(F.lit(_BASE32), place, F.lit(1))

    # the hash enters through a one-element array, so that it is computed once and not for each letter
    letters = F.transform(F.array(F.sha1(c.cast("binary"))), lambda h: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: letter(h, i)), ""))
    return F.concat(F.lit("sha1:"), F.get(letters, 0))


def record_id(*parts: Column) -> Column:
    """A name-based URN (128 bits of MD5 over the parts)."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, id_col: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Response records of crawled pages: (id, uri, date, record_id, http_headers, body, payload_digest, block_digest)."""
    b, u = F.coalesce(F.col(body), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(b).cast("string"), F.lit("\r\n"))
    df = pages.select(F.col(f"`{id_col}`").alias("id"), u.alias("uri"), F.lit(DATE).alias("date"), head.alias("http_headers"), b.alias("body"))
    df = df.withColumn("payload_digest", digest(F.col("body"))).withColumn("block_digest", digest(F.concat("http_headers", F.lit("\r\n"), "body")))
    return df.withColumn("record_id", record_id(F.lit("response"), F.col("uri"), F.col("date"), F.col("payload_digest")))


def _numeric(text: Column) -> Column:
    """``&#8217;`` and ``&#x2019;`` as their characters; a number that is no character stays as it is."""

    def decoded(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        hexadecimal = F.lower(F.left(digits, F.lit(1))) == "x"
        code = F.when(hexadecimal, F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).try_cast("int")
        real = (digits != "") & code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(real, F.concat(char, F.regexp_replace(part, r"^[0-9a-zA-Z]+;", ""))).otherwise(F.concat(F.lit("&#"), part))

    def whole(t: Column) -> Column:
        parts = F.transform(F.split(t, "&#"), lambda p, i: F.when(i == 0, p).otherwise(decoded(p)))
        return F.when(F.contains(t, F.lit("&#")), F.array_join(parts, "")).otherwise(t)

    # the text enters through a one-element array, so that it is computed once
    return F.get(F.transform(F.array(text), whole), 0)


def plain_text(html: Column) -> Column:
    """Visible text: hidden elements and tags go, block elements end lines, entities are decoded, blanks are folded."""
    t = F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), _BLOCKS, "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for entity, char in ENTITIES[:-1]:
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.replace(_numeric(t), F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def _first(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def _headers(kind: str, rid: Column, of: Column, mime: str, block: Column, block_digest: Column, extra: list[tuple[str, Column]]) -> Column:
    lines = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}"),
        F.concat(F.lit("WARC-Target-URI: "), "uri"),
        F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Record-ID: "), rid),
        F.concat(F.lit("WARC-Refers-To: "), of),
        *[F.concat(F.lit(f"{k}: "), v) for k, v in extra],
        F.lit(f"Content-Type: {mime}"),
        F.concat(F.lit("WARC-Block-Digest: "), block_digest),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n"))


def derive(source: DataFrame) -> DataFrame:
    """(id, record_type, record_id, refers_to, uri, block_digest, source_digest, headers, block): two rows per response."""
    html = F.col("body")
    links = F.transform(F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"']"), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))
    df = source.select(
        "*", plain_text(html).alias("_text"), plain_text(_first(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>")).alias("_title"), _first(html, r"(?i)<html\b[^>]*?\blang=[\"']?([A-Za-z-]+)").alias("_lang"), links.alias("_links")
    )
    df = df.withColumn("_cid", record_id(F.lit("conversion"), F.col("record_id"))).withColumn("_mid", record_id(F.lit("metadata"), F.col("record_id")))
    field = lambda k, v: F.concat(F.lit(f"{k}: "), v)
    fields = F.concat(
        F.concat_ws(
            "\r\n",
            field("title", F.replace("_title", F.lit("\n"), F.lit(" "))), field("languages-html", F.col("_lang")), field("text-length", F.length("_text").cast("string")), field("source-payload-digest", F.col("payload_digest")),
            field("source-block-digest", F.col("block_digest")), F.array_join(F.concat(F.array(F.concat(F.lit("outlinks: "), F.size("_links").cast("string"))), F.transform("_links", lambda x: F.concat(F.lit("outlink: "), x))), "\r\n"),
            F.array_join(F.transform(F.split(F.regexp_replace("http_headers", r"\r\n$", ""), "\r\n"), lambda h: F.concat(F.lit("source-http: "), h)), "\r\n"),
        ),
        F.lit("\r\n"),
    )
    df = df.withColumn("_fields", fields).withColumns({"_fields_digest": digest(F.col("_fields")), "_text_digest": digest(F.col("_text"))})
    rid = F.col("record_id")

    def record(kind: str, own: Column, mime: str, block: Column, found: Column, extra: list[tuple[str, Column]]) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"), own.alias("record_id"), rid.alias("refers_to"), found.alias("block_digest"), _headers(kind, own, rid, mime, block, found, extra).alias("headers"), block.alias("block")
        )

    source_digest = ("WARC-Source-Payload-Digest", F.col("payload_digest"))
    both = F.array(
        record("metadata", F.col("_mid"), "application/warc-fields", F.col("_fields"), F.col("_fields_digest"), [source_digest, ("Derived-Conversion", F.col("_cid"))]),
        record("conversion", F.col("_cid"), "text/plain; charset=utf-8", F.col("_text"), F.col("_text_digest"), [source_digest]),
    )
    out = df.select("id", "uri", F.col("payload_digest").alias("source_digest"), F.explode(both).alias("r"))
    return out.select("id", "r.record_type", "r.record_id", "r.refers_to", "uri", "r.block_digest", "source_digest", "r.headers", "r.block")


_MAGIC = b"\x1f\x8b\x08"
_CHUNK, _LINE = 1 << 20, 1 << 16
LONGEST = 256 << 20  # bytes of a record that a task holds
RESPONSE = "id string, uri string, date string, http_headers string, body string, payload_digest string, block_digest string, record_id string"


class _Damaged(Exception):
    """A gzip member that cannot be read on."""


class _Bytes:
    """The plain bytes of a WARC file, member by member where it is packed; what lies between members is passed over."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed, self.member = raw, packed, None
        self.held, self.ahead = bytearray(), b""

    def _more(self) -> bool:
        """Hold more bytes; false at the end of the file."""
        if not self.packed:
            chunk = self.raw.read(_CHUNK)
            self.held += chunk
            return bool(chunk)
        while True:
            if not self.ahead:
                self.ahead = self.raw.read(_CHUNK)
                if not self.ahead:
                    if self.member is not None:
                        self.member = None
                        raise EOFError
                    return False
            if self.member is None:
                at = self.ahead.find(_MAGIC)
                if at < 0:  # the first bytes of a member may be the last of this chunk
                    chunk = self.raw.read(_CHUNK)
                    self.ahead = self.ahead[-2:] + chunk if chunk else b""
                    continue
                self.ahead, self.member = self.ahead[at:], zlib.decompressobj(31)
            try:
                out = self.member.decompress(self.ahead, _CHUNK)
            except zlib.error as e:
                self.member, self.ahead = None, self.ahead[1:]
                raise _Damaged from e
            if self.member.eof:
                self.ahead, self.member = self.member.unused_data, None
            else:
                self.ahead = self.member.unconsumed_tail
            if out:
                self.held += out
                return True

    def line(self) -> bytes:
        """The next line, or as much of it as a header line may have."""
        at = 0
        while (end := self.held.find(b"\n", at)) < 0 and len(self.held) < _LINE:
            at = len(self.held)
            if not self._more():
                break
        return self.take(end + 1 if end >= 0 else min(len(self.held), _LINE))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, n: int) -> None:
        while n > 0 and (self.held or self._more()):
            k = min(n, len(self.held))
            del self.held[:k]
            n -= k


def _records(stream: _Bytes, longest: int) -> Iterator[tuple[dict[str, str], bytes] | str]:
    """(headers, block) of each record, or the reason why one is skipped; then the next that begins like a record is looked for."""
    lost = False
    while True:
        try:
            line = stream.line()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                if line.strip() and not lost:
                    lost = True
                    yield "bytes that are no record"
                continue
            lost, head, lines = False, {}, 0
            while (line := stream.line()).strip() and lines < 1000:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                head[name.strip().lower()] = value.strip()
                lines += 1
            length = head.get("content-length", "0")
            if not re.fullmatch(r"[0-9]{1,18}", length):
                lost = True
                yield "a length that is no number"
            elif int(length) > longest:
                stream.skip(int(length))
                yield "a record over the bound"
            else:
                block = stream.take(int(length))
                if len(block) < int(length):
                    yield "a record that is cut off"
                    return
                yield head, block
        except _Damaged:
            stream.held.clear()
            yield "a damaged member"
        except EOFError:
            yield "a record that is cut off"
            return


def _sha1(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _response(head: dict[str, str], block: bytes) -> tuple:
    """A row of ``RESPONSE``: identifiers, date and digests as the record states them, digests computed where it states none."""
    http, gap, body = block.partition(b"\r\n\r\n")
    kind = re.search(rb"(?im)^content-type:[^\r\n]*charset=[\"']?([\w-]+)", http)
    try:
        text = body.decode(kind[1].decode() if kind else "utf-8", "replace")
    except LookupError:  # a charset that does not exist
        text = body.decode("utf-8", "replace")
    rid = head.get("warc-record-id", "")
    return (
        rid, head.get("warc-target-uri", "").strip("<>"), head.get("warc-date", ""), http.decode("latin-1") + "\r\n" * bool(gap), text,
        head.get("warc-payload-digest") or _sha1(body), head.get("warc-block-digest") or _sha1(block), rid,
    )


def _read(spark: SparkSession, path: str, glob: str, longest: int, schema: str, batch_bytes: int, take) -> DataFrame:
    """Rows that ``take`` makes of the records of files, each file streamed by one task."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for b in batches for x in b.column(0).to_pylist()):
            store, file = fs.FileSystem.from_uri(name)
            with store.open_input_file(file) as raw:
                packed = raw.read(2) == _MAGIC[:2]
                raw.seek(0)
                held, size = [], 0
                for record in _records(_Bytes(raw, packed), longest):
                    if row := take(name, record):
                        held.append(row)
                        size += len(record[1])
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names)

    return files.repartition("path").mapInArrow(giving_back(run), schema)


def read_responses(spark: SparkSession, path: str, glob: str = "*.warc*", batch_bytes: int = 8 << 20, longest: int = LONGEST) -> DataFrame:
    """The response records of WARC files (plain or gzip), in the form that ``derive`` takes; ``id`` is the record's own.

    Each file is streamed by one task, a record at a time; a crawl has many files of bounded
    size.  Other record types are left out.  What cannot be read is skipped up to the next record or
    gzip member and costs no other record: lengths that are no number, damaged members, bytes
    between members, cut-off ends, records of over ``longest`` bytes.  ``read_skipped`` lists them.
    """
    return _read(spark, path, glob, longest, RESPONSE, batch_bytes, lambda _, r: _response(*r) if not isinstance(r, str) and r[0].get("warc-type") == "response" else None)


def read_skipped(spark: SparkSession, path: str, glob: str = "*.warc*", longest: int = LONGEST) -> DataFrame:
    """(file, reason, n): what ``read_responses`` skips."""
    rows = _read(spark, path, glob, longest, "file string, reason string", 1 << 20, lambda name, r: (name, r) if isinstance(r, str) else None)
    return rows.groupBy("file", "reason").agg(F.count("*").alias("n"))


def response_records(source: DataFrame) -> DataFrame:
    """(headers, block) of response records, for ``write_warc``."""
    block = F.concat("http_headers", F.lit("\r\n"), "body")
    lines = [
        F.lit("WARC/1.1\r\nWARC-Type: response"), F.concat(F.lit("WARC-Target-URI: "), "uri"), F.concat(F.lit("WARC-Date: "), "date"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Payload-Digest: "), "payload_digest"), F.concat(F.lit("WARC-Block-Digest: "), "block_digest"),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return source.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n")).alias("headers"), block.alias("block"))


def write_warc(records: DataFrame, path: str) -> DataFrame:
    """Write records as gzip members, one file for each task; (file, n_records, n_bytes) of the files."""
    ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        name, draft, n, size = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz", f"{folder}/.{uuid.uuid4().hex}", 0, 0
        with store.open_output_stream(draft, compression=None) as out:
            for b in batches:
                for head, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    raw = gzip.compress(f"{head}\r\n{block}\r\n\r\n".encode(), mtime=0)
                    out.write(raw)
                    n, size = n + 1, size + len(raw)
        if not n or store.get_file_info(name).type == fs.FileType.File:
            store.delete_file(draft)
        else:
            store.move(draft, name)
        yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n], "n_bytes": [size]})

    return records.select("headers", "block").mapInArrow(run, "file string, n_records long, n_bytes long")


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return derive(responses(pages)).select(F.col("id").alias("page_id"), "record_type", "record_id", "refers_to", "uri", "block_digest", "source_digest", "headers", "block")


def _sql_text(x: str) -> str:
    t = f"regexp_replace(regexp_replace({x}, '<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>|<template\\b.*?</template\\s*>', ' ', 'gsi'), '</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|blockquote|pre)\\b[^>]*>', chr(10), 'gi')"
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    for entity, char in ENTITIES[:-1]:
        t = f"replace({t}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    digits = "regexp_extract(x, '^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});', 1)"
    code = f"CASE WHEN lower({digits}[1]) = 'x' THEN CAST('0x' || {digits}[2:] AS INT) ELSE CAST({digits} AS INT) END"
    char = f"CASE WHEN {digits} <> '' AND ({code}) BETWEEN 1 AND 1114111 AND NOT ({code}) BETWEEN 55296 AND 57343 THEN chr({code}) || regexp_replace(x, '^[0-9a-zA-Z]+;', '') ELSE '&#' || x END"
    t = f"list_transform([{t}], lambda t: string_split(t, '&#')[1] || array_to_string(list_transform(string_split(t, '&#')[2:], lambda x: {char}), ''))[1]"
    t = f"replace({t}, '{ENTITIES[-1][0]}', '{ENTITIES[-1][1]}')"
    return f"regexp_replace(regexp_replace(regexp_replace({t}, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


def _sql_digest(x: str) -> str:
    v = "CAST('0x' || substr(sha1({0}), 1 + i * 5, 5) AS BIGINT)".format(x)
    letters = " || ".join(f"substr('{_BASE32}', CAST((({v}) >> {15 - 5 * k}) & 31 AS BIGINT) + 1, 1)" for k in range(4))
    return f"('sha1:' || array_to_string(list_transform(range(0, 8), lambda i: {letters}), ''))"


def _sql_urn(*parts: str) -> str:
    h = f"md5(concat_ws(chr(10), {', '.join(parts)}))"
    return f"('<urn:uuid:' || concat_ws('-', {', '.join(f'substr({h}, {a}, {n})' for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))}) || '>')"


_CRLF = "chr(13) || chr(10)"


def _sql_head(kind: str, rid: str, mime: str, block: str, dig: str, extra: str) -> str:
    return (
        f"concat_ws({_CRLF}, 'WARC/1.1', 'WARC-Type: {kind}', 'WARC-Target-URI: ' || uri, 'WARC-Date: {DATE}', 'WARC-Record-ID: ' || {rid}, 'WARC-Refers-To: ' || record_id, "
        f"'WARC-Source-Payload-Digest: ' || payload_digest{extra}, 'Content-Type: {mime}', 'WARC-Block-Digest: ' || {dig}, 'Content-Length: ' || strlen({block})) || {_CRLF}"
    )


OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS body FROM pages),
r0 AS (SELECT *, 'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: ' || strlen(body) || {_CRLF} AS hh FROM p),
r1 AS (SELECT *, {_sql_digest("body")} AS payload_digest, {_sql_digest(f"hh || {_CRLF} || body")} AS block_digest0 FROM r0),
r2 AS (SELECT *, {_sql_urn("'response'", "uri", f"'{DATE}'", "payload_digest")} AS record_id FROM r1),
r3 AS (SELECT *, {_sql_urn("'conversion'", "record_id")} AS cid, {_sql_urn("'metadata'", "record_id")} AS mid, {_sql_text("body")} AS txt,
  {_sql_text("regexp_extract(body, '<title\\b[^>]*>(.*?)</title\\s*>', 1, 'si')")} AS title, regexp_extract(body, '<html\\b[^>]*?\\blang=["'']?([A-Za-z-]+)', 1, 'i') AS lang,
  list_transform(regexp_extract_all(body, '<a\\b[^>]*?\\bhref=["'']([^"'']*)["'']', 1, 'i'), lambda x: replace(x, '&amp;', '&')) AS links FROM r2),
r4 AS (SELECT *, concat_ws({_CRLF}, 'title: ' || replace(title, chr(10), ' '), 'languages-html: ' || lang, 'text-length: ' || length(txt), 'source-payload-digest: ' || payload_digest, 'source-block-digest: ' || block_digest0,
  array_to_string(list_concat(['outlinks: ' || len(links)], list_transform(links, lambda x: 'outlink: ' || x)), {_CRLF}),
  'source-http: HTTP/1.1 200 OK', 'source-http: Content-Type: text/html; charset=utf-8', 'source-http: Content-Length: ' || strlen(body)) || {_CRLF} AS fields FROM r3),
r5 AS (SELECT *, {_sql_digest("fields")} AS md, {_sql_digest("txt")} AS cd FROM r4)
SELECT page_id, 'metadata' AS record_type, mid AS record_id, record_id AS refers_to, uri, md AS block_digest, payload_digest AS source_digest, {_sql_head("metadata", "mid", "application/warc-fields", "fields", "md", ", 'Derived-Conversion: ' || cid")} AS headers, fields AS block FROM r5
UNION ALL
SELECT page_id, 'conversion', cid, record_id, uri, cd, payload_digest, {_sql_head("conversion", "cid", "text/plain; charset=utf-8", "txt", "cd", "")}, txt FROM r5
"""
