"""WARC archives: a deterministic sharded writer and its reader.

The order of the records (by page id) is numbered exactly from keys alone; a shard is a run of records of about equal
bytes, so the files depend on the rows only, not on how they were partitioned.  Payloads move once, to the shard of
their record.  Tasks write under temporary names; Spark's own commit of the file list decides which attempt counts, and
only then files get their names and the manifest appears.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .numbering import numbered

#: payloads shorter than this are always stored whole
REVISIT_BYTES = 100
#: payload and header bytes of a shard; beyond MAX_SHARDS of them shards grow with the table
SHARD_BYTES = 32 << 20
MAX_SHARDS = 65_536
#: compressed bytes at which a file is closed
FILE_BYTES = 8 << 20
#: bytes that headers add to a record, for the sizes of shards
HEADER_BYTES = 700
#: payload groups with more than this share of all rows are joined by broadcast: at most 1 / HOT_SHARE of them exist
HOT_SHARE = 0.001

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, shard int, records long, bytes long, sha256 string, temporary string"
RECORDS = ("file string, offset long, length long, record_type string, record_id string, page_id string, url string, date string, "
           "payload_bytes long, payload_digest string, refers_to string, refers_page string, payload string")


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def record_id(number: int, page_id: object) -> str:
    return f"urn:x-page:{number}" + ("" if page_id is None else f":{urllib.parse.quote(str(page_id), safe='')}")


def _page_of(identifier: str) -> str | None:
    named = identifier.split(":", 3)[3:]
    return urllib.parse.unquote(named[0]) if named else None


def build_record(kind: str, identifier: str, url: str | None, date: str, digest: str, size: int, payload: bytes | None, refers_to: str | None) -> bytes:
    """One record with fresh headers and digests; a revisit keeps the HTTP headers of its payload, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{identifier}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe="".join(map(chr, range(33, 127))))))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Roll:
    """The files of one shard: members of one record each, a new file where the next member would pass the limit."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.path = _filesystem(root)
        self.shard, self.limit, self.part, self.out = shard, limit, 0, None

    def add(self, record: bytes) -> Iterator[tuple]:
        member = gzip.compress(record, 6, mtime=0)
        if self.out is not None and self.bytes + len(member) > self.limit:
            yield self.close()
        if self.out is None:
            self.file = f"shard-{self.shard:05d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.file}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}")
            self.bytes, self.records, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.bytes, self.records = self.bytes + len(member), self.records + 1

    def close(self) -> tuple:
        self.out.close()
        self.out, self.part = None, self.part + 1
        return self.file, self.shard, self.records, self.bytes, self.sha.hexdigest(), self.temporary


def _keys(pages: DataFrame) -> list:
    """What orders and names a record: its page, a digest of its url, and of its payload."""
    url = F.when(pages["url"].isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), pages["url"].cast("string")))
    return [pages["page_id"].alias("page_id"), F.sha2(url.cast("binary"), 256).alias("url_key"), F.sha2(F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary"), 256).alias("digest")]


ORDER = ("url_key", "digest")


def _order() -> list:
    return [F.col("page_id").asc_nulls_last(), *map(F.col, ORDER)]


def planned(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, hot): every record with its place, kind and, for revisits, its response; and the largest payload groups.

    Short payloads travel with their key.  The response of a group of equal payloads is the one placed first.
    """
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    size = F.octet_length(html).cast("long")
    keys = pages.select(F.lit("").alias("all"), *_keys(pages), pages["url"].cast("string").alias("url"), size.alias("size"), F.when(size < REVISIT_BYTES, html).alias("short"), (size + HEADER_BYTES).alias("weight"))
    placed = numbered(cut_lineage(keys), "all", _order(), "weight").drop("all")
    long = placed.where(F.col("size") >= REVISIT_BYTES)
    groups = cut_lineage(long.groupBy("digest").agg(F.count("*").alias("copies"), F.min(F.struct("number", "page_id", "url_key")).alias("response")).where("copies > 1"))
    total = placed.count()
    hot = groups.where(F.col("copies") > total * HOT_SHARE)
    cold = groups.where(F.col("copies") <= total * HOT_SHARE).select("digest", "response")
    rest = long.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest", "left")
    records = (placed.where(F.col("size") < REVISIT_BYTES).withColumn("response", F.lit(None).cast(groups.schema["response"].dataType))
               .unionByName(long.join(F.broadcast(hot.select("digest", "response")), "digest")).unionByName(rest))
    revisit = F.col("response.number") < F.col("number")
    records = records.withColumns({"revisit": F.coalesce(revisit, F.lit(False)), "first": F.when(revisit, F.col("response.number")), "first_page": F.when(revisit, F.col("response.page_id"))}).drop("response")
    return cut_lineage(records), hot


def _sortable(page_id: object, url_key: str, digest: str) -> tuple:
    return page_id is None, 0 if page_id is None else page_id, url_key, digest


def _payloads(pages: DataFrame, hot: DataFrame, bounds: list[tuple], shards: list[int]) -> DataFrame:
    """(shard, page_id, url_key, digest, html): long payloads at the shard that may hold their response.

    Of a hot group only the response's own row sends.  A key on a boundary goes to both sides of it, as the earlier
    shard may hold the first of several equal rows; a task sends equal rows once.
    """
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(*_keys(pages), html.alias("html")).where(F.octet_length("html") >= REVISIT_BYTES)
    rows = rows.join(F.broadcast(hot.select("digest", F.col("response").alias("chosen"))), "digest", "left")
    rows = rows.where(F.col("chosen").isNull() | (F.col("chosen.page_id").eqNullSafe(F.col("page_id")) & (F.col("chosen.url_key") == F.col("url_key"))))
    rows = rows.select("page_id", *ORDER, "html")

    def send(batches):
        sent = set()
        for batch in batches:
            taken, to = [], []
            for k, key in enumerate(zip(*[batch.column(c).to_pylist() for c in ("page_id", *ORDER)], strict=True)):
                if key in sent:
                    continue
                sent.add(key)
                low, high = bisect.bisect_left(bounds, _sortable(*key)), bisect.bisect_right(bounds, _sortable(*key))
                for place in {max(low - 1, 0), low} if low < high else {high - 1}:
                    taken.append(k)
                    to.append(shards[place])
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *[c.take(pa.array(taken, pa.int64())) for c in batch.columns]], ["shard", "page_id", *ORDER, "html"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(send, f"shard int, page_id {kind}, url_key string, digest string, html string")


def write_archive(pages: DataFrame, path: str, date: str = DATE, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as compressed WARC files under ``path`` and return the manifest
    (file, shard, records, bytes, sha256), which is also kept in ``path/_manifest``.

    Records ascend by page id (nulls last), equal ids by digests of url and payload.  Null or empty html gives an empty
    payload, a null url no target; long texts are written whole; other columns are left out; an empty table gives an
    empty manifest.  Of equal payloads of REVISIT_BYTES and more the first is a response, the others revisit it.
    ``path`` must be reachable from every executor and hold no archive yet.
    """
    spark = pages.sparkSession
    fs, root = _filesystem(path)
    if fs.get_file_info(f"{root}/_manifest").type != pyarrow.fs.FileType.NotFound:
        raise FileExistsError(path)
    fs.create_dir(f"{root}/_temporary")
    records, hot = planned(pages)
    total = records.agg(F.max(F.col("before") + F.col("weight"))).first()[0] or 0
    span = max(shard_bytes, -(-total // MAX_SHARDS))
    records = records.withColumn("shard", F.floor(F.col("before") / span).cast("int"))
    edges = records.groupBy("shard").agg(F.min(F.struct("number", "page_id", *ORDER)).alias("edge")).orderBy("shard").collect()
    bounds = [_sortable(r["edge"]["page_id"], r["edge"]["url_key"], r["edge"]["digest"]) for r in edges]
    payloads = _payloads(pages, hot, bounds, [r["shard"] for r in edges]).withColumns({"kind": F.lit(0), "number": F.lit(0).cast("long")})
    plan = records.select("shard", "page_id", *ORDER, F.lit(1).alias("kind"), "number", "url", "size", "short", "revisit", "first", "first_page")
    rows = plan.unionByName(payloads, allowMissingColumns=True)
    dealt = rows.repartitionById(edges[-1]["shard"] + 1 if edges else 1, F.col("shard")).sortWithinPartitions("shard", *_order(), "kind", "number")

    def write(batches):
        roll, held, held_key, done = None, None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["page_id"], r["url_key"], r["digest"])
                if roll is None or roll.shard != r["shard"]:
                    if roll is not None and roll.out is not None:
                        done.append(roll.close())
                    roll = _Roll(path, r["shard"], file_bytes)
                if not r["kind"]:
                    held, held_key = r["html"], key
                    continue
                payload = None if r["revisit"] else r["short"] if r["short"] is not None else held
                if not r["revisit"] and r["short"] is None and held_key != key:
                    raise ValueError(f"no payload came for record {r['number']}")
                done += roll.add(build_record(
                    "revisit" if r["revisit"] else "response", record_id(r["number"], r["page_id"]), r["url"], date, r["digest"], r["size"],
                    None if payload is None else payload.encode(), record_id(r["first"], r["first_page"]) if r["revisit"] else None))
            yield _batch(done)
            done = []
        if roll is not None and roll.out is not None:
            yield _batch([roll.close()])

    written = cut_lineage(dealt.mapInArrow(write, MANIFEST))
    _commit(written, path)
    written.drop("temporary").write.parquet(f"{path}/_manifest")
    fs.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(f"{path}/_manifest")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [c.split()[0] for c in MANIFEST.split(", ")])


def _commit(written: DataFrame, path: str) -> None:
    """Give every file of the list its name; safe to repeat, as a file that has moved is left alone."""
    def move(batches):
        fs, root = _filesystem(path)
        for batch in batches:
            for r in batch.to_pylist():
                if fs.get_file_info(f"{root}/{r['temporary']}").type != pyarrow.fs.FileType.NotFound:
                    fs.move(f"{root}/{r['temporary']}", f"{root}/{r['file']}")
                elif fs.get_file_info(f"{root}/{r['file']}").type == pyarrow.fs.FileType.NotFound:
                    raise FileNotFoundError(r["temporary"])
            yield batch.select(["file"])

    written.mapInArrow(move, "file string").count()


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of the gzip members of a file."""
    view, start = memoryview(content), 0
    while start < len(view):
        inflate, parts, at = zlib.decompressobj(31), [], start
        while not inflate.eof:
            if at >= len(view):
                raise ValueError(f"the member at {start} is cut off")
            parts.append(inflate.decompress(view[at : at + 65536]))
            at = min(at + 65536, len(view))
        at -= len(inflate.unused_data)
        yield start, at - start, b"".join(parts)
        start = at


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload (empty for revisits) of one record; digests and lengths must hold."""
    head, _, body = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    block = body[:size]
    if not version.startswith("WARC/1.") or len(block) != size or body[size:] != b"\r\n\r\n":
        raise ValueError("a record is malformed")
    if hashlib.sha256(block).hexdigest() != fields["warc-block-digest"].removeprefix("sha256:"):
        raise ValueError("a block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["payload-length"] = re.search(rb"Content-Length: (\d+)", http)[1].decode()
    if fields["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"].removeprefix("sha256:") or len(payload) != int(fields["payload-length"])):
        raise ValueError("a payload does not match its digest")
    return fields, payload


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record under ``path`` with its place, headers and (responses only, if asked) payload.

    ``page_id`` and ``refers_page`` are texts, null where the page had none.  A record that does not match its digests fails the read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "content")

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for offset, length, data in members(content.as_buffer()):
                    f, payload = parse_record(data)
                    own, refers = f["warc-record-id"].strip("<>"), f.get("warc-refers-to", "").strip("<>") or None
                    rows.append({
                        "file": name.rsplit("/", 1)[-1], "offset": offset, "length": length, "record_type": f["warc-type"], "record_id": own, "page_id": _page_of(own), "url": f.get("warc-target-uri"),
                        "date": f["warc-date"], "payload_bytes": int(f["payload-length"]), "payload_digest": f["warc-payload-digest"].removeprefix("sha256:"), "refers_to": refers,
                        "refers_page": refers and _page_of(refers), "payload": payload.decode() if payloads and f["warc-type"] == "response" else None})
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")])
    return files.mapInArrow(parse, RECORDS)


def broken_revisits(records: DataFrame) -> DataFrame:
    """Revisits whose response is missing or has another digest; equal references are compared once."""
    responses = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("held"))
    asked = records.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest").agg(F.count("*").alias("revisits"))
    return asked.join(responses, "refers_to", "left").where("held is null or held != payload_digest")
