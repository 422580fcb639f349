"""WARC archives: segmented, chunk-framed writing, and reading by reassembly.

Writing: each row becomes an HTTP response record (or, when an equal payload
with a smaller key exists, a revisit record without payload). The HTTP body
is framed in chunks; a block over ``segment_bytes`` is cut into a first
record and continuation records. Files are written by Spark's text sink, so a
lost task is simply run again and only committed files are visible.

Reading: the record marker is the line separator of Spark's text source, so
archives are scanned in parallel, one gzip file a task, with memory for one
record. Whole
records are decoded where they are read; only segments are shuffled, by
origin identifier, ordered by segment number, checked against the total
length and decoded.

The marker never occurs inside a record this module writes: a chunk boundary
is put through it. A foreign record that holds it, is cut short, has gaps
between segments or a wrong total length is returned with ``error`` set and a
null payload, never dropped.

Defined results: a null payload is empty; rows with a null key are written
with an empty key and read back as null, after all other keys in the choice
of the response; fully repeated rows are separate records, all but the first
revisits. Columns other than key, url and payload are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARK = b"WARC/1.1\r\n"
END = "\r\n\r\n"
SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024

RECORD_SCHEMA = ("record_id string, record_type string, key string, url string, refers_to string, "
                 "digest string, origin string, segment int, total_length long, block binary, "
                 "payload binary, error string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# --------------------------------------------------------------------------
# framing of one record (plain helpers, used inside tasks)

def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """Chunked transfer framing; no chunk holds the record marker."""
    cuts = set(range(0, len(payload), chunk_bytes)) | {m.start() + 4 for m in re.finditer(re.escape(MARK), payload)}
    at = sorted(cuts | {0, len(payload)})
    out = []
    for a, b in zip(at, at[1:]):
        out += [b"%x\r\n" % (b - a), payload[a:b], b"\r\n"]
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def unchunked(body: bytes) -> bytes:
    """The payload of a chunk-framed body; raises ValueError when malformed."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        n = int(body[at:eol].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        if n < 0 or len(body) < eol + 4 + n or body[eol + 2 + n:eol + 4 + n] != b"\r\n":
            raise ValueError("bad chunk")
        out.append(body[eol + 2:eol + 2 + n])
        at = eol + 4 + n


def http_payload(block: bytes) -> bytes:
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")) else body


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return MARK + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def _safe(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url).replace("WARC/", "WARC%2F")


def records_of(rid: str, url: str | None, payload: bytes, digest: str, revisit_of: str | None,
               segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    base = [("WARC-Record-ID", f"<{rid}>"), ("WARC-Target-URI", _safe(url)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit_of is not None:
        return [_record([("WARC-Type", "revisit"), *base, ("WARC-Refers-To", f"<{revisit_of}>"),
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")],
                        http + b"\r\n")]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record([("WARC-Type", "response"), *base], block)]
    out = []
    n = -(-len(block) // segment_bytes)
    for k in range(n):
        own = base if k == 0 else [("WARC-Record-ID", f"<{rid}:{k + 1}>"), ("WARC-Segment-Origin-ID", f"<{rid}>")]
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == n - 1 else []
        out.append(_record([("WARC-Type", "response" if k == 0 else "continuation"), *own,
                            ("WARC-Segment-Number", str(k + 1)), *last],
                           block[k * segment_bytes:(k + 1) * segment_bytes]))
    return out


def parse(piece: bytes) -> dict:
    """One piece between markers as a record."""
    out = dict.fromkeys(("record_id", "record_type", "key", "url", "refers_to", "digest", "origin", "segment",
                         "total_length", "block", "payload", "error"))
    head, _, rest = piece.partition(b"\r\n\r\n")
    f = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        f[k.strip().lower()] = v.strip()
    bare = lambda k: f[k].strip("<>") if k in f else None
    out["record_id"], out["record_type"], out["url"] = bare("warc-record-id"), f.get("warc-type"), f.get("warc-target-uri")
    out["refers_to"], out["digest"] = bare("warc-refers-to"), f.get("warc-payload-digest")
    try:
        n = int(f["content-length"])
        if len(rest) < n or rest[n:].strip(b"\r\n"):
            raise ValueError("length")
        block = rest[:n]
        if "warc-segment-number" in f:
            out["segment"] = int(f["warc-segment-number"])
            out["origin"] = bare("warc-segment-origin-id") or out["record_id"]
            out["total_length"] = int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None
            out["block"] = block
        elif out["record_type"] == "response":
            out["payload"] = http_payload(block)
            check_digest(out["payload"], out["digest"])
    except (KeyError, ValueError) as e:
        out["error"], out["payload"] = str(e), None
    return out


def check_digest(payload: bytes, digest: str | None) -> None:
    import base64
    if digest is not None and digest != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError("digest")


# --------------------------------------------------------------------------
# Spark jobs

def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write WARC files under ``path``. Payloads are shuffled once, by key;
    the choice of the response of equal payloads runs on digests only."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("k"), text(key).alias("t"), F.col(url).cast("string").alias("u"), body.alias("p"))
    rows = rows.withColumn("d", base32_sha1(F.col("p")))
    ids = rows.select("k", "t", "d", F.octet_length("p").alias("n")).distinct()
    first = ids.groupBy("d").agg(F.min(F.struct(F.col("k").isNull().alias("nul"), "k")).alias("f"))
    plan = ids.join(first, "d").select("t", "d", text("f.k").alias("ft"), (F.col("n") >= revisit_bytes).alias("big"))
    # joined and numbered by the same two columns: payloads are dealt once
    rows = rows.select("t", "u", "p", "d").join(plan, ["t", "d"]).withColumn(
        "ord", F.row_number().over(Window.partitionBy("t", "d").orderBy("t")))
    rid = F.concat(F.lit("urn:page:"), F.col("t"), F.lit(":"), F.col("d"), F.lit(":"), F.col("ord").cast("string"))
    first_rid = F.concat(F.lit("urn:page:"), F.col("ft"), F.lit(":"), F.col("d"), F.lit(":1"))
    revisit = F.col("big") & ~((F.col("t") == F.col("ft")) & (F.col("ord") == 1))
    rows = rows.select(rid.alias("rid"), "u", "d", F.when(revisit, first_rid).alias("of"),
                       F.when(~revisit, F.col("p")).alias("p"))

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                out += records_of(r.rid, r.u, b"" if r.p is None else bytes(r.p), r.d, r.of, segment_bytes, chunk_bytes)
            yield pd.DataFrame({"value": out})

    framed = rows.mapInPandas(frame, "value binary").select(F.col("value").cast("string").alias("value"))
    framed.write.option("lineSep", END).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, key, url, refers_to, digest, payload,
    error`` of every response and revisit under ``path``."""
    raw = spark.read.option("lineSep", MARK.decode()).text(path).where("value <> ''")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([parse(bytes(v)) for v in pdf["value"]], columns=[c.split()[0] for c in
                               RECORD_SCHEMA.split(", ")]).astype({"segment": "Int32", "total_length": "Int64"})

    records = raw.select(F.col("value").cast("binary").alias("value")).mapInPandas(split, RECORD_SCHEMA)
    whole = records.where("segment is null")
    parts = records.where("segment is not null").groupBy("origin").agg(
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("parts"),
        F.max("total_length").alias("total_length"), F.first("url", True).alias("url"),
        F.first("digest", True).alias("digest"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                block = b"".join(bytes(p["block"]) for p in r.parts)
                rec = [r.origin, "response", None, r.url, None, r.digest, None, None]
                try:
                    if [p["segment"] for p in r.parts] != list(range(1, len(r.parts) + 1)):
                        raise ValueError("segments")
                    if pd.isna(r.total_length) or len(block) != r.total_length:
                        raise ValueError("total length")
                    rec[6] = http_payload(block)
                    check_digest(rec[6], r.digest)
                except ValueError as e:
                    rec[6], rec[7] = None, str(e)
                out.append(rec)
            yield pd.DataFrame(out, columns=names)

    names = ["record_id", "record_type", "key", "url", "refers_to", "digest", "payload", "error"]
    kinds = {c.split()[0]: c.split()[1] for c in RECORD_SCHEMA.split(", ")}
    joined = parts.mapInPandas(join, ", ".join(f"{c} {kinds[c]}" for c in names))
    out = whole.select(*names).unionByName(joined)
    return out.withColumn("key", F.nullif(F.regexp_extract("record_id", "^urn:page:([^:]*):", 1), F.lit("")))


def warc_summary(spark: SparkSession, pages: DataFrame, path: str, **kw) -> DataFrame:
    """Write, read back, and describe each record: the payload's length and
    digest (a revisit's are those of the response that it names)."""
    from rxcover.llm.common import stored

    write_archives(pages, path, **kw)
    rec = stored(read_archives(spark, path).select(
        "record_id", "record_type", F.col("key").cast("long").alias("page_id"), "refers_to", "error",
        F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("d")), "warc-records")
    own = rec.where("record_type = 'response'").select(F.col("record_id").alias("of"), F.col("page_id").alias("of_page"),
                                                       F.col("n").alias("of_n"), F.col("d").alias("of_d"))
    back = rec.where("record_type = 'revisit'").join(own, F.col("refers_to") == F.col("of"), "left")
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"]
    return (rec.where("record_type = 'response'").select("page_id", F.col("n").alias("payload_bytes"),
            F.col("d").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"), "error")
            .unionByName(back.select("page_id", F.col("of_n").alias("payload_bytes"), F.col("of_d").alias("payload_digest"),
                         "record_type", F.col("of_page").alias("refers_to"), "error"))).select(*shown)
