"""WARC derivatives: each response gives a plain-text conversion record and a metadata record that point back to it.

``responses`` turns a table of pages into response records (id, target, date, HTTP head, payload); ``derivatives`` turns
responses into records of both kinds, serialised as WARC/1.1 with CRLF lines. Both refer to the response by ``WARC-Refers-To``
and repeat its target and date; the metadata block carries the source's HTTP headers, its payload digest, the title, the
outlinks and the id of its conversion. Record ids are UUIDs made from the content, so a rerun or a task that is tried
again writes the same ids; repeated rows give repeated records. Digests are SHA-1 in base 32, as is usual in WARC files.

A null or empty payload gives an empty conversion, a null URL an empty target, null headers none, a null date ``DATE``, a null id column null. An empty table
gives no record; columns of other names are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

_DROPPED = re.compile(r"<!--|<(script|style|title|template|noscript)\b", re.I)
_COMMENT = re.compile(r"<!--")
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "title", "template", "noscript")}
_TITLE = re.compile(r"<title\b", re.I)
_BREAK = re.compile(r"<(?:/?(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|blockquote|pre)|br|hr)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!][^>]*>")
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")
_BLANK = re.compile(r"[ \t\r\f\v\xa0]+")


def without_hidden(page: str) -> str:
    """The page without comments and without elements that are not shown; one that is never closed reaches to the end.

    Every step goes on where the last one ended, so the work is in proportion to the page.
    """
    parts, pos, opens = [], 0, _DROPPED
    while found := opens.search(page, pos):
        if opens is _COMMENT or found[1] is None:
            start, close = found.start(), page.find("-->", found.end())
            end = close + 3
        else:
            start, tag = found.start(), page.find(">", found.end())
            if tag < 0:
                # No later tag ends either; only comments are left to look for.
                parts.append(page[pos : found.end()])
                pos, opens = found.end(), _COMMENT
                continue
            closed = _CLOSED[found[1].lower()].search(page, tag + 1)
            close, end = (-1, 0) if closed is None else (closed.start(), closed.end())
        parts += [page[pos:start], " "]
        if close < 0:
            return "".join(parts)
        pos = end
    return "".join([*parts, page[pos:]])


def plain_text(page: str) -> str:
    """Visible text, a line for each block, without markup, scripts and comments."""
    page = without_hidden(page).replace("\n", " ")
    # Behind the last bracket no tag ends.
    last = page.rfind(">") + 1
    page = html.unescape(_TAG.sub("", _BREAK.sub("\n", page[:last])) + page[last:])
    lines = (line.strip() for line in _BLANK.sub(" ", page).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str:
    found = _TITLE.search(page)
    tag = page.find(">", found.end()) if found else -1
    closed = _CLOSED["title"].search(page, tag + 1) if tag >= 0 else None
    return " ".join(html.unescape(page[tag + 1 : closed.start()]).split()) if closed else ""


def _links(page: str) -> Iterator[str]:
    """Values of the first ``href`` of each anchor tag."""
    pos = 0
    while found := _ANCHOR.search(page, pos):
        pos = page.find(">", found.end())
        stop = len(page) if pos < 0 else pos
        named, value = _HREF.search(page, found.end(), stop), None
        while named and not (value := _VALUE.match(page, named.end())):
            named = _HREF.search(page, named.end(), stop)
        if value:
            yield value[value.lastindex]
            pos = value.end()
        elif pos < 0:
            return


def outlinks(page: str) -> list[str]:
    """Link targets in order, each once, white space inside them removed."""
    links = ("".join(html.unescape(link).split()) for link in _links(page))
    return list(dict.fromkeys(link for link in links if link))


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join(parts))}>"


class Record(NamedTuple):
    headers: list[tuple[str, str]]
    block: bytes

    def serialised(self) -> bytes:
        head = "".join(f"{name}: {value}\r\n" for name, value in self.headers)
        return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + self.block + b"\r\n\r\n"


def parsed(data: bytes) -> Record:
    """Reads one serialised record back."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = [tuple(line.split(": ", 1)) for line in head.decode().split("\r\n")[1:]]
    return Record(headers, rest[: int(dict(headers)["Content-Length"])])


def _made(kind: str, name: str, source: dict, content_type: str, block: bytes) -> Record:
    return Record(
        [
            ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", source["date"]),
            ("WARC-Refers-To", source["record_id"]), ("WARC-Refers-To-Target-URI", source["target_uri"]),
            ("WARC-Refers-To-Date", source["date"]), ("WARC-Target-URI", source["target_uri"]),
            ("WARC-Block-Digest", sha1(block)), ("Content-Type", content_type), ("Content-Length", str(len(block))),
        ],
        block,
    )


def derived(source: dict) -> tuple[Record, Record]:
    """The conversion and the metadata record of a response."""
    page = source["payload"]
    text = plain_text(page).encode()
    conversion = _made("conversion", record_id("conversion", source["record_id"]), source, "text/plain; charset=utf-8", text)
    fields = [("source-payload-digest", source["payload_digest"]), ("conversion", dict(conversion.headers)["WARC-Record-ID"])]
    status, *headers = source["http_head"].strip().split("\r\n")
    fields += [("source-status", status)]
    fields += [(f"source-{name.strip().lower()}", value.strip()) for name, _, value in (h.partition(":") for h in headers)]
    fields += [("title", title_of(page)), *(("outlink", link) for link in outlinks(page))]
    block = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    metadata = _made("metadata", record_id("metadata", source["record_id"]), source, "application/warc-fields", block)
    return conversion, metadata


def responses(pages: DataFrame, date: str = DATE, http_head: str = HEAD) -> DataFrame:
    """Pages as response records: ``page_id, target_uri, date, http_head, payload``; columns a crawl brings may replace these."""
    return pages.select(
        "page_id", F.coalesce(F.regexp_replace("url", r"\s+", ""), F.lit("")).alias("target_uri"), F.lit(date).alias("date"),
        F.lit(http_head).alias("http_head"), F.coalesce("html", F.lit("")).alias("payload"),
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows for each response: the headers as columns and the whole ``record`` as bytes; one pass, no shuffle."""
    columns = ("target_uri", "date", "http_head", "payload")
    names = ("record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest", "payload_digest")
    kinds = (pa.string(),) * 5 + (pa.int64(), pa.string(), pa.string())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A batch of long pages is worked off in pieces, so that few of them are held as strings.
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids, rows, records = [], [], []
                for page_id, *values in zip(part.column("page_id"), *(part.column(c) for c in columns), strict=True):
                    response = dict(zip(columns, (v.as_py() for v in values), strict=True))
                    response["payload_digest"] = sha1(response["payload"].encode())
                    key = "null" if page_id.as_py() is None else str(page_id.as_py())
                    response["record_id"] = record_id("response", key, response["target_uri"], response["payload_digest"])
                    for record in derived(response):
                        h = dict(record.headers)
                        rows.append((
                            h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h["Content-Type"],
                            len(record.block), h["WARC-Block-Digest"], response["payload_digest"],
                        ))
                        records.append(record.serialised())
                        ids.append(page_id.as_py())
                made = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *made, pa.array(records, pa.binary())], ["page_id", *names, "record"])

    schema = (
        "page_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, "
        "content_length long, block_digest string, payload_digest string, record binary"
    )
    # A crawl may bring rows without some of these.
    known = [F.coalesce(F.col(c).cast("string"), F.lit(DATE if c == "date" else "")).alias(c) for c in columns]
    return source.select("page_id", *known).mapInArrow(task, schema)
