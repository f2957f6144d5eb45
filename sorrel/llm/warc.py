"""WARC derivatives: every response becomes a metadata record and a plain-text conversion record that refer to it."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import map_batches

SCHEMA = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, source_digest string, source_headers string, payload string"
)
DATE = "1970-01-01T00:00:00Z"
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
BREAK = re.compile(r"</?(?:p|div|h[1-6]|li|ul|ol|br|tr|table|title|article|section|header|footer|nav|blockquote|pre)\b[^>]*>", re.I)
TAG = re.compile(r"</?[a-zA-Z!?][^>]*>")
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"""<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(parts).encode()).digest(), version=5)}>"


def plain_text(page: str) -> str:
    """The visible text: no scripts, styles, comments or tags; blocks on lines of their own; entities decoded."""
    text = TAG.sub("", BREAK.sub("\n", HIDDEN.sub(" ", page)))
    if "&" in text:
        text = html.unescape(text)
    return "\n".join(filter(None, (" ".join(line.split()) for line in text.split("\n"))))


def header_lines(fields: dict[str, str]) -> str:
    return "".join(f"{k}: {v}\r\n" for k, v in fields.items())


def one_line(text: str) -> str:
    """A header value: line ends would start another header."""
    return re.sub(r"[\r\n]+", " ", text)


def response(page_id: int | None, url: str | None, page: str | None, date: str | None) -> dict:
    """The response record that a page stands for; null text is an empty body, a null page id or URL an empty string."""
    url, body = one_line(url or ""), (page or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": urn("response", "" if page_id is None else str(page_id), url, digest(body)),
        "WARC-Target-URI": url,
        "WARC-Date": date or DATE,
        "WARC-Payload-Digest": digest(body),
        "WARC-Block-Digest": digest(http + body),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(http) + len(body)),
    }
    return {"headers": headers, "http": http.decode(), "body": body}


def derive(page_id: int | None, url: str | None, page: str | None, date: str | None = None) -> list[tuple]:
    """The metadata and the conversion record of one response, as rows of SCHEMA."""
    source = response(page_id, url, page, date)
    head, text = source["headers"], plain_text(page or "")
    title = TITLE.search(page or "")
    links = list(dict.fromkeys(html.unescape("".join(m)) for m in LINK.findall(HIDDEN.sub(" ", page or ""))))
    meta = {
        "envelope": {"warc-header": head, "payload-length": len(source["body"])},
        "response": dict(x.split(": ", 1) for x in source["http"].split("\r\n")[1:] if x),
        "html": {"title": " ".join(html.unescape(title[1]).split()) if title else None, "links": links},
    }
    rows = []
    for kind, mime, payload in (("metadata", "application/json", json.dumps(meta, ensure_ascii=False)), ("conversion", "text/plain", text)):
        block = payload.encode("utf-8", "surrogatepass")
        own = urn(kind, head["WARC-Record-ID"], digest(block))
        rows.append((page_id, kind, own, head["WARC-Record-ID"], head["WARC-Target-URI"], head["WARC-Date"], mime, len(block), digest(block), head["WARC-Payload-Digest"], header_lines(head), payload))
    return rows


def derivatives(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", date: str | None = None) -> DataFrame:
    """Two rows per page: its metadata record (JSON: the response's headers, title, links) and its text record.

    `refers_to` is the response's record id, `source_headers` its header lines, `source_digest` its payload digest.
    Record ids come from content, so reruns agree; repeated rows give repeated records. A null body is empty, a page
    without text has an empty conversion record, a null id stays null. Extra columns are not carried.
    """
    cols = [F.col(page_id).cast("long").alias("i"), F.col(url).cast("string").alias("u"), F.col(body).cast("string").alias("b")]
    cols.append((F.col(date).cast("string") if date else F.lit(None).cast("string")).alias("d"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [r for x in zip(*(c.to_pylist() for c in batch.columns)) for r in derive(*x)]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], pa.int64() if n in ("page_id", "content_length") else pa.string()) for k, n in enumerate(names)})

    return map_batches(pages.select(*cols), run, SCHEMA)


def record_bytes(row) -> bytes:
    """A derived row as it stands in a WARC file, without the two line ends that close it."""
    fields = {
        "WARC-Type": row["warc_type"], "WARC-Record-ID": row["record_id"], "WARC-Refers-To": row["refers_to"],
        "WARC-Target-URI": row["target_uri"], "WARC-Date": row["warc_date"], "WARC-Block-Digest": row["block_digest"],
        "Content-Type": row["content_type"], "Content-Length": str(row["content_length"]),
    }
    return b"WARC/1.0\r\n" + header_lines(fields).encode() + b"\r\n" + row["payload"].encode()


def write_files(derived: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Records as WARC text files under `path`, one folder per record type, through Spark's own writer."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({"value": [record_bytes(r).decode() for r in rows], "warc_type": [r["warc_type"] for r in rows]})

    lines = map_batches(derived, run, "value string, warc_type string")
    lines.write.partitionBy("warc_type").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def read_files(spark, path: str) -> DataFrame:
    """Records of WARC files written by `write_files`: their header fields as a map, and the payload."""
    raw = spark.read.option("lineSep", "WARC/1.0\r\nWARC-Type: ").text(path).where("value != ''")
    cut = F.split(F.concat(F.lit("WARC-Type: "), "value"), "\r\n\r\n", 2)
    fields = F.str_to_map(cut[0], F.lit("\r\n"), F.lit(": "))
    payload = F.expr("substring(body, 1, length(body) - 4)")
    return raw.select(fields.alias("headers"), cut[1].alias("body")).select("headers", payload.alias("payload"))
