"""WARC archives with segmented records: writing, and reassembly on reading.

A record whose block is longer than a segment is written as its first segment
and continuation records, which may lie anywhere in the archives. Reading groups
the segments by the identifier of their origin record, orders them by segment
number, checks them against the total length, and decodes the chunked transfer
framing of the HTTP message. Unsegmented records are decoded where they are
read; only a small row of each is grouped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostgrain.llm.storage import marked, table, work_dir, written

#: Bytes of a record's block, at most.
SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024
#: With SEGMENT_BYTES this bounds an archive to about 65 MB before compression.
RECORDS_PER_ARCHIVE = 2_000
#: Payloads that repeat most often are settled map-side: so many, at most.
HEAVY = 1_000
_END = b"\r\n\r\n"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _chunked(body: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(part := body[i : i + size]), part) for i in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def decode_chunked(data: bytes) -> bytes | None:
    """The body behind chunked transfer framing; None where the framing is broken."""
    out, at = [], 0
    while True:
        line = data.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(data[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        start, end = line + 2, line + 2 + size
        if not size:
            return b"".join(out)
        if data[end : end + 2] != b"\r\n":
            return None
        out.append(data[start:end])
        at = end + 2


def _record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the blank lines that end it: the writer adds those."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def _header_value(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def page_records(page_id, url, html, nonce, winner, segment_bytes=SEGMENT_BYTES, chunk_bytes=CHUNK_BYTES) -> list[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    name = f"<urn:page:{'' if page_id is None else page_id}:{nonce}>"
    common = [("WARC-Record-ID", name), ("WARC-Date", _DATE)]
    about = [
        ("WARC-Target-URI", _header_value(url)),
        ("WARC-Payload-Digest", f"sha1:{base32_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if winner is not None and winner != page_id:
        block = b"HTTP/1.1 304 Not Modified\r\nContent-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record("revisit", [*common, *about, ("WARC-Refers-To", f"<urn:page:{winner}>"), ("WARC-Profile", profile)], block)]
    block = _HEAD + _chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record("response", [*common, *about], block)]
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record("response", [*common, *about, ("WARC-Segment-Number", 1)], pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        own = [("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Date", _DATE)]
        segment = [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n)]
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(pieces) else []
        out.append(_record("continuation", own + segment + last, piece))
    return out


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
    min_revisit_bytes: int = 0,
) -> None:
    """Writes a gzip WARC record per row of pages into the folder at path.

    Of rows with equal payloads of at least min_revisit_bytes, that with the
    largest id becomes a response and the others revisit it; rows that repeat
    that id and payload are responses too, as are all rows of a group without any id.
    A null payload is empty; a null url gives an empty target. Payloads of any length
    are cut into segments. An empty table gives a folder without records. Other
    columns are ignored, whatever their names. Payloads that occur once are never
    shuffled, nor are the HEAVY most frequent ones.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    base = base.withColumn("sha", F.sha1(F.encode(F.coalesce("payload", F.lit("")), "UTF-8")))
    long_enough = F.octet_length(F.coalesce("payload", F.lit(""))) >= min_revisit_bytes
    repeated = written(
        base.where(long_enough).groupBy("sha").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "warc-repeated",
    ).select(F.col("sha").alias("repeated_sha"), "winner", "n")
    same = F.col("sha") == F.col("repeated_sha")
    hot = written(repeated.orderBy(F.desc("n"), "repeated_sha").limit(HEAVY).drop("n"), "warc-frequent")
    rest = repeated.drop("n").join(F.broadcast(hot), "repeated_sha", "left_anti")  # HEAVY rows at most
    settled = base.join(F.broadcast(hot), same, "left").withColumn("hot", F.col("repeated_sha").isNotNull()).drop("repeated_sha")
    found = marked(settled, F.col("sha"), rest, F.col("repeated_sha"), "hit").withColumn("hit", F.col("hit") & ~F.col("hot"))
    others = found.where("hit").drop("winner").join(rest, same, "left")
    columns = ["id", "url", "payload", "winner"]
    parts = found.where("not hit").select(*columns).unionByName(others.select(*columns))
    numbered = parts.withColumn("nonce", F.monotonically_increasing_id()).select("id", "url", "payload", "nonce", "winner")

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500].astype(object).where(lambda x: x.notna(), None)
                rows = (r for row in part.itertuples(index=False) for r in page_records(*row, segment_bytes, chunk_bytes))
                yield pd.DataFrame({"record": list(rows)}, dtype=object)

    id_as_text = [F.col(c).cast("string").alias(c) if c in ("id", "winner") else F.col(c) for c in numbered.columns]
    lines = numbered.select(*id_as_text).mapInPandas(records, "record binary")
    # the blank lines between records are the text writer's separator; the bytes pass unchanged
    lines.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _END.decode()).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", records_per_archive).text(path)


def parse_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed archive."""
    at = 0
    while (at := archive.find(b"WARC/1.", at)) >= 0:
        end = archive.index(_END, at)
        lines = archive[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + len(_END)
        stop = start + int(headers["content-length"])
        yield headers, archive[start:stop]
        at = stop


def _inflate(data: bytes) -> bytes:
    out = []
    while data:
        member = zlib.decompressobj(wbits=31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP message: transfer framing decoded; None where it is broken."""
    head, found, body = block.partition(_END)
    if not found:
        return None
    if re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", head, re.I):
        return decode_chunked(body)
    return body


def _payload_row(block: bytes) -> dict:
    payload = http_payload(block)
    return {"bytes": None if payload is None else len(payload), "digest": None if payload is None else base32_digest(payload)}


_PARSED = "origin string, kind string, target string, refers string, claimed string, number int, total long, bytes long, digest string, block binary"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in _PARSED.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for headers, block in parse_records(_inflate(content)):
                kind, number = headers["warc-type"], headers.get("warc-segment-number")
                row = dict.fromkeys(columns)
                row["origin"] = headers.get("warc-segment-origin-id", headers["warc-record-id"])
                if kind != "continuation":
                    row |= {"kind": kind, "target": headers.get("warc-target-uri"), "refers": headers.get("warc-refers-to")}
                    row["claimed"] = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                if number is not None:
                    row |= {"number": int(number), "total": headers.get("warc-segment-total-length"), "block": block}
                    row["total"] = None if row["total"] is None else int(row["total"])
                elif kind == "response":
                    row |= _payload_row(block)
                elif found := re.search(rb"\r\ncontent-length:\s*(\d+)", block, re.I):
                    row["bytes"] = int(found[1])  # a 304 answer tells the length of the full payload
                rows.append(row)
            frame = pd.DataFrame(rows, columns=columns)
            yield frame.astype({"number": "Int32", "total": "Int64", "bytes": "Int64"})


def _reassemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bytes_, digests, whole = batch["bytes"].astype("Int64").tolist(), batch["digest"].tolist(), []
        for i, segments in enumerate(batch.pop("segments")):
            ok = True
            if len(segments):
                parts = sorted(segments, key=lambda s: s["number"])
                block = b"".join(s["block"] for s in parts)
                totals = {int(s["total"]) for s in parts if s["total"] is not None}
                ok = [s["number"] for s in parts] == list(range(1, len(parts) + 1)) and totals == {len(block)}
                row = _payload_row(block) if ok else {"bytes": None, "digest": None}
                bytes_[i], digests[i] = row["bytes"], row["digest"]
            whole.append(ok)
        batch["bytes"], batch["digest"], batch["whole"] = pd.array(bytes_, "Int64"), digests, whole
        yield batch


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (segments joined) of the gzip WARC archives in the folder at path.

    record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest,
    segments (number read), complete: whether all segments are there, the total
    length and the framing hold, and the payload has the digest of its header.
    Bytes and digest of an incomplete response are null. A revisit has both from
    its own record. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = files.mapInPandas(_parse, _PARSED)
    segment = F.when(F.col("number").isNotNull(), F.struct("number", "total", "block"))
    # a record has few segments, so its list is bounded by the length of one payload
    grouped = parsed.groupBy("origin").agg(
        *[F.max(c).alias(c) for c in ("kind", "target", "refers", "claimed", "bytes", "digest")],
        F.collect_list(segment).alias("segments"),
        F.count("number").cast("int").alias("parts"),
    )
    schema = "origin string, kind string, target string, refers string, claimed string, bytes long, digest string, parts int, whole boolean"
    done = grouped.mapInPandas(_reassemble, schema)
    revisit = F.col("kind") == "revisit"
    return done.select(
        F.col("origin").alias("record_id"),
        F.col("kind").alias("record_type"),
        F.col("target").alias("target_uri"),
        F.col("refers").alias("refers_to"),
        F.col("bytes").alias("payload_bytes"),
        F.when(revisit, F.col("claimed")).otherwise(F.col("digest")).alias("payload_digest"),
        F.greatest("parts", F.lit(1)).alias("segments"),
        F.coalesce(F.col("whole") & (revisit | (F.col("digest") == F.col("claimed"))), F.lit(False)).alias("complete"),
    )


def op1(spark, sf_dir):
    path = work_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:([0-9-]*)', 1) as bigint)")
    return read_archives(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
        "segments",
        "complete",
    )


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)
QUERIES = {"op1_warc_segments": op1}
ORACLES = {
    "op1_warc_segments": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
            FROM pages
        )
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN winner <> page_id OR (page_id IS NULL AND winner IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN winner <> page_id OR (page_id IS NULL AND winner IS NOT NULL) THEN winner END AS refers_to,
               CASE WHEN winner <> page_id OR (page_id IS NULL AND winner IS NOT NULL) THEN 1
                    ELSE greatest(1, ceil(({len(_HEAD)} + 5 + strlen(html) // {CHUNK_BYTES} * (length(format('{{:x}}', {CHUNK_BYTES})) + 4 + {CHUNK_BYTES})
                         + CASE WHEN strlen(html) % {CHUNK_BYTES} > 0 THEN length(format('{{:x}}', strlen(html) % {CHUNK_BYTES})) + 4 + strlen(html) % {CHUNK_BYTES} ELSE 0 END
                        ) / {SEGMENT_BYTES}))::INT END AS segments,
               true AS complete
        FROM p
    """
}
