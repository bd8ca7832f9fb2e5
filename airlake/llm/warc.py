"""Derivatives of WARC responses: metadata and plain-text conversion records, linked to their source.

A response is one row: its WARC headers and its block (HTTP header and body, as stored). For each response that holds HTML or
text, two records are made, both with ``WARC-Refers-To`` naming the response and ``WARC-Concurrent-To`` each other: a
``conversion`` with the visible text, and a ``metadata`` whose fields keep the response's WARC and HTTP headers and digests. Files are plain WARC/1.1, written and read by Spark's own text source, split at record
starts: derived blocks never contain a carriage return followed by a blank line, so a record start is unambiguous.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm.html import visible_text

VERSION = "WARC/1.1"
RESPONSES = "warc_headers map<string,string>, block binary"
CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*of: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(of))}>"


def responses_from_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records (RESPONSES) of pages (page_id, url, html), as a crawler would have stored them.

    Null urls and pages count as empty; the same row always gets the same record id.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            heads, blocks = [], []
            for page_id, url, html in zip(frame["page_id"], frame["url"], frame["html"], strict=True):
                body = (html or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
                block, payload = http.encode() + body, digest(body)
                heads.append(
                    {
                        "WARC-Type": "response", "WARC-Record-ID": record_id("response", str(page_id), url or "", payload),
                        "WARC-Date": date, "WARC-Target-URI": url or "", "Content-Type": "application/http; msgtype=response",
                        "WARC-Payload-Digest": payload, "WARC-Block-Digest": digest(block), "Content-Length": str(len(block)),
                    }
                )
                blocks.append(block)
            yield pd.DataFrame({"warc_headers": heads, "block": blocks})

    whole = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html")
    return whole.mapInPandas(run, RESPONSES)


def one_line(value: str | None) -> str:
    """A header value without line breaks."""
    return re.sub(r"[\r\n]+", " ", value or "").strip()


def derive(headers: dict[str, str], block: bytes | None) -> Iterator[tuple[dict[str, str], str]]:
    """(WARC headers, block) of the conversion and the metadata record of one response."""
    http, _, body = (block or b"").partition(b"\r\n\r\n")
    lines = http.decode("latin-1").split("\r\n")
    fields = [tuple(map(str.strip, x.split(":", 1))) for x in lines[1:] if ":" in x]
    kind = next((v for k, v in fields if k.lower() == "content-type"), "")
    named = CHARSET.search(kind.encode("latin-1")) or CHARSET.search(body[:2048])
    try:
        text = body.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:  # a charset nobody knows
        text = body.decode("utf-8", "replace")
    if "html" in kind.lower() or not kind:
        text = visible_text(text)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    source = one_line(headers.get("WARC-Record-ID"))
    payload = headers.get("WARC-Payload-Digest") or digest(body)
    whole = headers.get("WARC-Block-Digest") or digest(block or b"")
    own = {name: record_id(name, source, whole) for name in ("conversion", "metadata")}
    shared = {
        "WARC-Refers-To": source, "WARC-Target-URI": one_line(headers.get("WARC-Target-URI")),
        "WARC-Date": one_line(headers.get("WARC-Date")),
    }

    def record(name: str, other: str, kind: str, content: str) -> tuple[dict[str, str], str]:
        data = content.encode()
        return {
            "WARC-Type": name, "WARC-Record-ID": own[name], **shared, "WARC-Concurrent-To": own[other],
            "WARC-Block-Digest": digest(data), "Content-Type": kind, "Content-Length": str(len(data)),
        }, content

    yield record("conversion", "metadata", "text/plain; charset=utf-8", text)
    notes = [
        ("conversion-record-id", own["conversion"]), ("source-block-digest", whole), ("source-payload-digest", payload),
        ("source-status", lines[0]), *[(f"source-warc-{k}", v) for k, v in sorted(headers.items())],
        *[(f"source-http-{k}", v) for k, v in fields],
    ]
    yield record(
        "metadata", "conversion", "application/warc-fields",
        "".join(f"{one_line(k)}: {one_line(v)}\r\n" for k, v in notes).rstrip("\r\n"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """(record) text of the derived records of each response, ready to be written.

    Rows whose headers are null or name another type than response give none. A null block is an empty response; repeated
    responses give repeated records with equal ids. An empty table gives no records; other columns are ignored.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for headers, block in zip(frame["warc_headers"], frame["block"], strict=True):
                for head, content in derive(dict(headers), block):
                    fields = "".join(f"{k}: {v}\r\n" for k, v in head.items())
                    # the writer ends every record with the last of its two blank lines
                    out.append(f"{VERSION}\r\n{fields}\r\n{content}\r\n\r")
            yield pd.DataFrame({"record": out})

    of = responses.where(F.col("warc_headers")["WARC-Type"] == "response").select("warc_headers", "block")
    return of.mapInPandas(run, "record string")


def write_warc(records: DataFrame, path: str) -> None:
    records.select("record").write.option("lineSep", "\n").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """warc_headers and block (as text) of every record, files split between records."""
    pieces = spark.read.option("lineSep", f"\r\n\r\n{VERSION}\r\n").text(path)
    whole = F.regexp_replace("value", rf"^{VERSION}\r\n", "")
    whole = F.regexp_replace(whole, r"\r\n\r\n$", "")
    cut = F.locate("\r\n\r\n", F.col("whole"))
    parts = pieces.where(F.length("value") > 0).select(whole.alias("whole")).select(
        F.when(cut > 0, F.substring(F.col("whole"), F.lit(1), cut - 1)).otherwise(F.col("whole")).alias("head"),
        F.when(cut > 0, F.substring(F.col("whole"), cut + 4, F.length("whole"))).otherwise(F.lit("")).alias("block"),
    )
    field = lambda x: F.struct(
        F.substring_index(x, ": ", 1).alias("key"), F.substring(x, F.locate(": ", x) + 2, F.length(x)).alias("value")
    )
    lines = F.filter(F.split("head", "\r\n"), lambda x: F.locate(": ", x) > 0)
    return parts.select(F.map_from_entries(F.transform(lines, field)).alias("warc_headers"), "block")
