"""WARC archives: written with an index of every record, read by coalesced byte ranges."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ridgeline.llm.common import text_or_empty
from ridgeline.session import settle

LEAST_BYTES = 100
VOLUME_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
INDEX = "file string, offset long, length long, page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long"
ROW = "page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long, payload binary"


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that tasks share, and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, digest: str, refers_to: int | None, revisit: bool, payload: bytes) -> bytes:
    """One record as a gzip member. A revisit has no payload, only its digest and length and the page it refers to."""
    kind = "revisit" if revisit else "response"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{url}/{digest}/{kind}")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "text/html"),
            ("Content-Length", str(0 if revisit else len(payload)))]
    if url is not None:
        # Only what would end the header line, or be trimmed, is encoded; the second form can be taken back.
        head.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~%|^`{}<>\\\"-._")))
        head.append(("X-Address", quote(url, safe="/:?&=#")))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("X-Payload-Length", str(len(payload))))
        if refers_to is not None:
            head.append(("X-Refers-To-Page", str(refers_to)))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return gzip.compress(b"WARC/1.1\r\n" + lines + b"\r\n" + (b"" if revisit else payload) + b"\r\n\r\n", 3, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a gzip member; the payload's length is the declared one, whatever it contains."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(re.findall(r"^([\w-]+): (.*)$", head.decode().replace("\r\n", "\n"), re.M))
    return fields, rest[:int(fields["Content-Length"])]


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages with payload, digest, record_type and refers_to.

    Only (digest, id) is aggregated; no payload moves unless the list of repeated digests is
    too large for Spark to send to all tasks, and then a digest with most pages is a skewed
    join that Spark splits.
    """
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        text_or_empty(html_col).cast("binary").alias("payload"))
    page = page.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    repeated = settle(page.filter(F.col("payload_bytes") >= LEAST_BYTES).groupBy("digest")
                      .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "least"))
    page = page.join(repeated, "digest", "left")
    # Null ids come after all others, so they revisit the smallest id if there is one.
    revisit = F.coalesce(F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
                         & (F.col("payload_bytes") >= LEAST_BYTES), F.lit(False))
    return page.select("page_id", "url", "digest", "payload_bytes", "payload",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("least")).alias("refers_to"))


def write(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write every page to WARC volumes below ``folder``; returns the stored index, one row per record.

    A task writes its pages in the order they come to volumes of its own of about 256 MB, one gzip
    member per record, and reports file, offset and length of each. A volume's name holds the
    attempt that wrote it, so a repeated task starts new volumes, and the index only names
    volumes of attempts that Spark counted; left-over volumes are removed at the end.

    Of pages with equal payloads of 100 bytes or more the smallest id is the response, the
    others revisit it; rows that repeat that id too are responses as well. Null html is an
    empty payload, null url and null id leave out their header; among equal payloads a null id refers to the smallest
    id, and is a response if there is no id. An empty table writes no volume.
    """
    names = [f.split(" ")[0] for f in INDEX.split(", ")]

    def run(batches):
        fs, at = store(folder)
        fs.create_dir(at, recursive=True)
        context = TaskContext.get()
        prefix = f"volume-{context.partitionId():05d}-{context.taskAttemptId()}"
        out, number, offset = None, 0, 0
        try:
            for batch in batches:
                rows = []
                for p in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                    if out is None or offset >= VOLUME_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{prefix}-{number}.warc.gz", 0
                        number += 1
                        out = fs.open_output_stream(f"{at}/{name}", compression=None)
                    data = record(p["page_id"], p["url"], p["digest"], p["refers_to"], p["record_type"] == "revisit", p["payload"])
                    out.write(data)
                    rows.append((name, offset, len(data), p["page_id"], p["url"], p["digest"], p["payload_bytes"], p["record_type"], p["refers_to"]))
                    offset += len(data)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)
        finally:
            if out is not None:
                out.close()

    index = settle(classify(pages, **columns).mapInArrow(run, INDEX))
    _remove_unnamed(index, folder)
    return index


def _remove_unnamed(index: DataFrame, folder: str) -> None:
    """Delete volumes of attempts that did not count: names only, one per task attempt."""
    fs, at = store(folder)
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        return
    named = {r.file for r in index.select("file").distinct().toLocalIterator()}
    for f in fs.get_file_info(pafs.FileSelector(at)):
        if f.base_name.startswith("volume-") and f.base_name not in named:
            fs.delete_file(f.path)


def ranges(selected: DataFrame) -> DataFrame:
    """Sorted records of each file, joined to byte ranges of at most 8 MB that leave out gaps over 64 kB.

    A record longer than that is a range of its own. Range numbers come from running sums
    inside a file, and a file is never much longer than a volume.
    """
    by_file = W.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    t = selected.withColumn("_gap", F.coalesce(F.col("offset") - F.lag(end).over(by_file), F.lit(0)) > GAP_BYTES)
    t = t.withColumn("_cell", F.floor(F.col("offset") / RANGE_BYTES))
    starts = F.col("_gap") | F.coalesce(F.col("_cell") != F.lag("_cell").over(by_file), F.lit(True))
    return t.withColumn("run", F.sum(starts.cast("long")).over(by_file.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_gap", "_cell")


def read(selected: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index name, read in one piece per byte range and checked.

    Any filter of the index selects records; files are only touched where it says so. A
    response whose payload has another digest than the index says stops the job. All columns come from
    the archive: address, length and what a revisit refers to are read from the record's own head.
    """
    names = [f.split(" ")[0] for f in ROW.split(", ")]
    chosen = ranges(selected)
    plans = chosen.groupBy("file", "run").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))).alias("records"))

    def run(batches):
        fs, at = store(folder)
        for batch in batches:
            for plan in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                with fs.open_input_file(f"{at}/{plan['file']}") as f:
                    data = f.read_at(plan["end"] - plan["start"], plan["start"])
                rows = []
                for r in plan["records"]:
                    here = r["offset"] - plan["start"]
                    head, payload = parsed(data[here:here + r["length"]])
                    revisit = head["WARC-Type"] == "revisit"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if digest != r["digest"] or not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{plan['file']} at {r['offset']}: digest differs from the index")
                    number = lambda k: int(head[k]) if k in head else None
                    address = unquote(head["X-Address"]) if "X-Address" in head else None
                    rows.append((number("X-Page-Id"), address, digest, number("X-Payload-Length") if revisit else len(payload),
                                 head["WARC-Type"], number("X-Refers-To-Page"), None if revisit else payload))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array([x[i] for x in rows], kinds[i]) for i in range(len(names))], names=names)

    return plans.mapInArrow(run, ROW)
