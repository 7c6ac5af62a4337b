"""WARC archives with a two-level capture index.

Each task writes its records to an archive, a gzip member per record; payloads that occur again become revisit records that
name the response. The captures' index lines are sorted by URL with the host reversed (`org,example,www)/path`) and page_id
and cut into ranges; each range becomes an index part, compressed blocks of `BLOCK` lines, and a sparse directory of that
part's blocks. A capture is found by binary search: for the part among the parts' first keys, for the block in that
part's directory, for the line in the block; two range reads fetch the block and the record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import keep
from tiers.sources.workdir import new_folder

#: Lines of an index block; archives a look-up task holds open.
BLOCK, OPEN = 512, 256
DATE = "2000-01-01T00:00:00Z"


def order(surt: str, page: int | None) -> tuple:
    """Sorts as Spark sorts (surt, page_id): NULL first."""
    return surt, page is not None, page or 0


def record(row: dict) -> bytes:
    """One WARC record; a revisit has no payload."""
    payload = (row["html"] or "").encode()
    fresh = row["first"] is None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body += f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload if fresh else b"\r\n"
    head = {
        "WARC-Type": "response" if fresh else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if row['page_id'] is None else row['page_id']}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": row["url"] and re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", row["url"]),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["sha"])).decode(),
        "WARC-Refers-To": None if fresh else f"<urn:page:{row['first']}>",
        "WARC-Profile": None if fresh else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(body)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and HTTP payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, least: int = 0) -> tuple[DataFrame, str]:
    """Archives in a new shared folder, and a row per capture: surt, page_id, archive, offset, length.

    Of rows with equal payloads (NULL html: empty) of `least` bytes or more, those with the smallest page_id are responses
    and the others revisits; shorter ones are all responses. If only NULL ids share a payload, all are responses.
    """
    folder = new_folder(pages.sparkSession, "warc")
    host = F.lower(F.regexp_extract("url", "^[^:]*://([^/?#]*)", 1))
    rest = F.regexp_replace(F.col("url"), "^[^:]*://[^/?#]*|#.*$", "")
    surt = F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), rest), F.lit(""))
    rows = pages.select("page_id", "url", "html", surt.alias("surt"), F.sha1(F.coalesce("html", F.lit(""))).alias("sha"))
    firsts = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    again = (F.coalesce(F.octet_length("html"), F.lit(0)) >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(firsts.hint("shuffle_hash"), "sha").withColumn("first", F.when(again, F.col("first")))
    marked = marked.withColumn("html", F.when(F.col("first").isNull(), F.col("html")))

    def run(batches):
        name, at = None, 0
        for batch in batches:
            lines = []
            for row in batch.to_pylist():
                if name is None:
                    name, store, path = attempt(folder)
                    file = store.open_output_stream(f"{path}/{name}.warc.gz", compression=None)
                data = gzip.compress(record(row), 6, mtime=0)
                file.write(data)
                lines.append({"surt": row["surt"], "page_id": row["page_id"], "archive": name, "offset": at, "length": len(data)})
                at += len(data)
            yield pa.RecordBatch.from_pylist(lines, LINES)
        if name is not None:
            file.close()

    ready = marked.select("page_id", "url", "html", "surt", "sha", "first")
    return keep(ready.mapInArrow(run, "surt string, page_id long, archive string, offset long, length long"), "warc-captures"), folder


LINES = pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def attempt(folder: str) -> tuple[str, fs.FileSystem, str]:
    """A file name that no other attempt of a task uses, and the folder; what a lost attempt leaves is never named."""
    task = TaskContext.get()
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return f"{task.stageId()}-{task.partitionId():06d}-{task.taskAttemptId()}", store, path


def index(captures: DataFrame, folder: str) -> DataFrame:
    """Index parts and their directories; a row per part with its first key."""

    def run(batches):
        name, at, n, block, directory = None, 0, 0, [], []

        def flush(at: int) -> int:
            data = gzip.compress("".join(json.dumps(x) + "\n" for x in block).encode(), 6, mtime=0)
            directory.append([*block[0][:2], at, len(data)])
            file.write(data)
            block.clear()
            return at + len(data)

        for batch in batches:
            for row in batch.to_pylist():
                if name is None:
                    name, store, path = attempt(folder)
                    file = store.open_output_stream(f"{path}/{name}.idx", compression=None)
                block.append(list(row.values()))
                n += 1
                if len(block) == BLOCK:
                    at = flush(at)
        if name is not None:
            if block:
                flush(at)
            file.close()
            with store.open_output_stream(f"{path}/{name}.dir", compression=None) as f:
                f.write("".join(json.dumps(x) + "\n" for x in directory).encode())
            yield pa.RecordBatch.from_pylist([{"part": name, "surt": directory[0][0], "page_id": directory[0][1], "captures": n}], PARTS)

    ranges = captures.select(*LINES.names).repartitionByRange("surt", "page_id").sortWithinPartitions("surt", "page_id")
    return keep(ranges.mapInArrow(run, "part string, surt string, page_id long, captures long"), "warc-parts")


PARTS = pa.schema([("part", pa.string()), ("surt", pa.string()), ("page_id", pa.int64()), ("captures", pa.int64())])


class Part:
    """An index part opened for look-ups by range reads; a bounded number of archives stays open."""

    def __init__(self, folder: str, name: str):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.index = self.store.open_input_file(f"{self.path}/{name}.idx")
        self.archive = lru_cache(OPEN)(lambda x: self.store.open_input_file(f"{self.path}/{x}.warc.gz"))
        with self.store.open_input_stream(f"{self.path}/{name}.dir", compression=None) as f:
            self.blocks = [json.loads(x) for x in f.read().decode().splitlines()]
        self.firsts = [order(*b[:2]) for b in self.blocks]
        self.loaded, self.lines, self.keys = -1, [], []

    def block(self, i: int) -> None:
        if i != self.loaded:
            data = gzip.decompress(self.index.read_at(self.blocks[i][3], self.blocks[i][2]))
            self.lines = [json.loads(x) for x in data.decode().splitlines()]
            self.keys, self.loaded = [order(*x[:2]) for x in self.lines], i

    def find(self, surt: str, page: int | None):
        """All records of a capture; equal keys may run over the end of a block."""
        key = order(surt, page)
        for i in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            self.block(i)
            for line in self.lines[bisect_left(self.keys, key) : bisect_right(self.keys, key)]:
                yield parsed(gzip.decompress(self.archive(line[2]).read_at(line[4], line[3])))


def read(captures: DataFrame, parts: DataFrame, folder: str) -> DataFrame:
    """Each capture (surt, page_id; looked up once) as its records: page_id, record_type, payload_digest, payload_bytes, refers_to."""
    # One row per written range: as many as the write had tasks.
    known = sorted(((order(r["surt"], r["page_id"]), r["part"]) for r in parts.collect()))
    sent = parts.sparkSession.sparkContext.broadcast(([k for k, _ in known], [p for _, p in known]))

    def route(batches):
        for batch in batches:
            firsts, names = sent.value
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = [names[max(0, bisect_right(firsts, order(*k)) - 1)] if names else None for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["surt", "page_id", "part"])

    def fetch(batches):
        part, name = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["part"] != name:
                    name = row["part"]
                    part = Part(folder, name)
                for head, payload in part.find(row["surt"], row["page_id"]):
                    fresh = head["WARC-Type"] == "response"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fresh and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{name}: the payload of page {row['page_id']} is damaged")
                    target = head.get("WARC-Refers-To", "")[len("<urn:page:") : -1]
                    out.append(
                        {
                            "page_id": row["page_id"],
                            "record_type": head["WARC-Type"],
                            "payload_digest": digest,
                            "payload_bytes": len(payload) if fresh else None,
                            "refers_to": int(target) if target else None,
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, fields)

    kinds = [("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())]
    fields = pa.schema(kinds)
    routed = captures.mapInArrow(route, "surt string, page_id long, part string")
    near = routed.repartition("part").sortWithinPartitions("part", "surt", "page_id")
    return near.mapInArrow(fetch, "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long")


def listed(parts: DataFrame, folder: str) -> DataFrame:
    """surt and page_id of every capture in the index, once each."""

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                part = Part(folder, name)
                for i in range(len(part.blocks)):
                    part.block(i)
                    rows = [{"surt": k[0], "page_id": k[2] if k[1] else None} for k, _ in groupby(part.keys)]
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([("surt", pa.string()), ("page_id", pa.int64())]))

    return parts.select("part").repartition("part").mapInArrow(run, "surt string, page_id long").distinct()


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Every page written to archives and read back through the index; a row per record.

    page_id, payload_bytes and payload_digest (of the whole payload; a revisit has them from its response), record_type,
    refers_to. Repeated rows come out as often as they went in; NULL ids and urls are indexed under an empty key.
    """
    captures, folder = write(pages.withColumn("page_id", F.col("page_id").cast("long")), least)
    parts = index(captures, folder)
    back = keep(read(listed(parts, folder), parts, folder), "warc-back")
    full = back.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    return back.drop("payload_bytes").join(full, "payload_digest").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
