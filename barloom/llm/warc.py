"""Derived records of a web archive: metadata and plain text, linked to their responses.

A record is a row: its type, its identifiers and headers as columns, and its block as bytes.
``read_records`` and ``write_records`` go from and to archive files.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.columns import with_package
from barloom.llm.page_text import language, links, page_text, title

VERSION = "WARC/1.1"
_VERSIONS = "WARC/1."
#: Date of records built from pages that bring none.
DATE = "2024-01-01T00:00:00Z"
#: Identifiers of derived records follow from the source's, so a repeated run gives the same ones.
SPACE = uuid.UUID("6f1d7c52-8f0e-4d0c-9a55-0e5a1c1d7b1e")

# Header names in the order they are written, by column.
HEADERS = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date",
    "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "refers_to_target_uri": "WARC-Refers-To-Target-URI", "refers_to_date": "WARC-Refers-To-Date",
    "content_type": "Content-Type", "block_digest": "WARC-Block-Digest",
    "payload_digest": "WARC-Payload-Digest", "content_length": "Content-Length",
}
RECORD = ", ".join(f"{c} {'bigint' if c == 'content_length' else 'string'}" for c in HEADERS) + ", block binary"
_ARROW = pa.schema([(c, pa.int64() if c == "content_length" else pa.string()) for c in HEADERS]
                   + [("block", pa.binary())])

_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(parts))}>"


def split_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; without an empty line all is payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *rest = head.decode("latin-1").split("\r\n")
    pairs = [line.partition(":") for line in rest]
    return first, [(name.strip(), value.strip()) for name, colon, value in pairs if colon], payload


def _decoded(payload: bytes, headers: list[tuple[str, str]]) -> str:
    kind = next((v for n, v in headers if n.lower() == "content-type"), "")
    named = _CHARSET.search(kind) or _CHARSET.search(payload[:2048].decode("latin-1"))
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def _one_line(text: str) -> str:
    return " ".join(text.split())


def derive(source: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    block = source["block"] or b""
    status, headers, payload = split_response(block)
    page = _decoded(payload, headers)
    named, lang = title(page), language(page)
    fields = [("source-status", status)] if status else []
    fields += [(f"source-{name.lower()}", value) for name, value in headers]
    # The source's digests are kept as they were; what is derived anew is named so.
    fields += [("source-block-digest", source["block_digest"] or ""),
               ("source-payload-digest", source["payload_digest"] or ""),
               ("computed-payload-digest", digest(payload))]
    fields += [("title", _one_line(html.unescape(named)))] if named is not None else []
    fields += [("language", lang)] if lang else []
    fields += [("outlink", f"{_one_line(html.unescape(url))} {tag}") for tag, url in links(page)]
    about = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    text = page_text(page).encode()
    made = []
    for kind, content, data in (("metadata", "application/warc-fields", about),
                                ("conversion", "text/plain; charset=utf-8", text)):
        made.append({
            "warc_type": kind, "record_id": _identifier(source["record_id"] or "", kind),
            "date": source["date"], "target_uri": source["target_uri"],
            "refers_to": source["record_id"], "refers_to_target_uri": source["target_uri"],
            "refers_to_date": source["date"], "content_type": content, "block_digest": digest(data),
            "payload_digest": None, "content_length": len(data), "block": data})
    return made


def _with_key(df: DataFrame, key: str, made) -> DataFrame:
    """Records made from each row, with the column ``key`` of the row they come from."""
    field = df.schema[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                found = [made(row) for row in batch.drop_columns(["__key"]).to_pylist()]
                at = [k for k, rows in enumerate(found) for _ in rows]
                records = pa.Table.from_pylist([r for rows in found for r in rows], _ARROW)
                keys = batch.column("__key").take(pa.array(at, pa.int64()))
                for part in records.add_column(0, pa.field(key, keys.type), keys).combine_chunks().to_batches():
                    yield part

    taken = [c for c in df.columns if c != key]
    return with_package(df).select(F.col(key).alias("__key"), *taken).mapInArrow(
        run, f"`{key}` {field.dataType.simpleString()}, {RECORD}")


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
              date: str = DATE) -> DataFrame:
    """A response record for each page: (key, record columns, block).

    A null address is left empty and a null page has an empty payload. Rows that repeat give
    records that repeat, with the same identifier. Other columns are not read.
    """
    def made(row: dict) -> list[dict]:
        payload = (row["page"] or "").encode()
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
        return [{
            "warc_type": "response", "record_id": _identifier(str(row["name"]), row["url"] or ""),
            "date": date, "target_uri": row["url"] or "", "content_type": "application/http; msgtype=response",
            "block_digest": digest(block), "payload_digest": digest(payload),
            "content_length": len(block), "block": block}]

    named = pages.select(F.col(key), F.col(key).cast("string").alias("name"), F.col(url).alias("url"),
                         F.col(page).alias("page"))
    return _with_key(named, key, made)


def derivatives(records: DataFrame, key: str) -> DataFrame:
    """For each response of ``records`` a metadata and a conversion record, in the same columns.

    refers_to, refers_to_target_uri and refers_to_date name the response. The metadata block
    keeps the response's status, all its headers and its digests, next to what the page says of
    itself; the conversion block is the page's visible text in UTF-8, empty for an empty page.
    Records of other types are left out. An empty table gives an empty one; further columns are
    not read. Bytes that are not of the named character set become U+FFFD in the text.
    """
    taken = records.where(F.col("warc_type") == "response").select(key, *HEADERS, "block")
    return _with_key(taken, key, derive)


def write_records(records: DataFrame, path: str) -> None:
    """Archive files under ``path``, one per partition, each record whole and in row order."""
    heads = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit("\r\n")))
             for c, name in HEADERS.items()]
    head = F.concat(F.lit(f"{VERSION}\r\n"), *(F.coalesce(h, F.lit("")) for h in heads), F.lit("\r\n"))
    # The text writer puts bytes as they are; the second line end of a record is its separator.
    whole = F.concat(head.cast("binary"), F.col("block"), F.lit("\r\n").cast("binary"))
    records.select(whole.cast("string").alias("value")).write.option("lineSep", "\r\n").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of archive files of any 1.x version, split where a version line follows the end of
    a record: record columns, block, and intact (the block is as long as its header says and fits
    its digest). Nothing is left out: a record whose block holds such a place itself comes as
    pieces that are not intact."""
    schema = RECORD + ", intact boolean"
    arrow = _ARROW.append(pa.field("intact", pa.bool_()))
    columns = {name.lower(): c for c, name in HEADERS.items()}

    def parse(data: bytes) -> dict:
        head, _, block = data.removeprefix(_VERSIONS.encode()).partition(b"\r\n\r\n")
        row: dict = {}
        for line in head.decode("utf-8", "replace").split("\r\n"):
            name, colon, value = line.partition(":")
            if colon and name.lower() in columns:
                row[columns[name.lower()]] = value.strip()
        said = row.get("content_length", "")
        row["content_length"] = int(said) if said.isdigit() else None
        block = block[:-4] if block.endswith(b"\r\n\r\n") else block
        row["block"] = block
        row["intact"] = row["content_length"] == len(block) and row.get("block_digest") in (None, digest(block))
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from pa.Table.from_pylist([parse(d.as_py()) for d in batch.column(0)], arrow).to_batches()

    split = spark.read.option("lineSep", f"\r\n\r\n{_VERSIONS}").text(path).where("value != ''")
    return with_package(split).select(F.col("value").cast("binary")).mapInArrow(run, schema)
