"""WARC archives in Zstandard: a frame for each record, and the dictionary in a skippable frame at the front.

``write`` puts every partition's records into files of its own below a shared folder, rolls to a new
file beyond ``ROLL`` bytes, and returns the list of files that finished tasks wrote; files of lost
attempts are not in that list.  The dictionary of a file is trained on the first payloads of its
partition (``SAMPLE_BYTES`` at most), and left out where there are too few.

``read`` opens each listed file, loads the dictionary, decodes one frame for each record and checks the
version line, the mandatory headers, the length of the block, the end of the record and the payload's
digest.  A record that fails a check is returned with what is wrong in ``problem``.

Equal payloads of 100 bytes or more are stored once: the smallest page_id is the ``response``, the
others are ``revisit`` records that refer to it.  Null html is an empty payload; a null url has no
target; rows that repeat an id with the same payload are all responses; rows without an id refer to the
smallest id, and are responses where there is none.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, run_dir, written
from tidewater.operators.joins import salted_join

LEAST = 100
#: Copies of one payload that are more than one part in so many of the pages are dealt to several tasks.
SHARES = 64
ROLL = 128 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
_DICTIONARY_MAGIC = 0x184D2A5D
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 18


def _open(folder: str):
    """File system and path of a folder given as a path or as a URI, in a worker."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _uri(folder: str) -> str:
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def record(kind: str, page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or none where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


class Writer:
    def __init__(self, out, trained: bytes):
        self.out, self.size, self.n = out, 0, 0
        if trained:
            self._put(struct.pack("<II", _DICTIONARY_MAGIC, len(trained)) + trained)
        data = zstandard.ZstdCompressionDict(trained) if trained else None
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True, write_content_size=True).compress

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.compress(data))
        self.n += 1


def frames(source):
    """The content of each frame of an open archive, one at a time."""
    head = source.read(8)
    trained, left = b"", head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == _DICTIONARY_MAGIC:
        trained, left = source.read(struct.unpack("<I", head[4:])[0]), b""
        if trained[:4] == _ZSTD_MAGIC:  # the dictionary may itself be compressed
            trained = zstandard.ZstdDecompressor().decompressobj().decompress(trained)
    engine = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    while True:
        left = left or source.read(_READ)
        if not left:
            return
        while len(left) < 8 and (more := source.read(_READ)):
            left += more
        if len(left) >= 8 and 0x184D2A50 <= struct.unpack("<I", left[:4])[0] <= 0x184D2A5F:  # any other skippable frame
            skip = 8 + struct.unpack("<I", left[4:8])[0]
            while len(left) < skip and (more := source.read(_READ)):
                left += more
            left = left[skip:]
            continue
        one, parts = engine.decompressobj(), []
        while not one.eof:
            if not left and not (left := source.read(_READ)):
                raise ValueError("the archive ends inside a frame")
            parts.append(one.decompress(left))
            left = b""
        left = one.unused_data
        yield b"".join(parts)


_MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


def parse(data: bytes) -> dict:
    """Fields of a record; ``problem`` says what is wrong with it."""
    out = dict.fromkeys(("record_type", "page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to", "problem"))
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        return out | {"problem": "no version line or no end of the headers"}
    field = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if missing := [k for k in _MANDATORY if k not in field]:
        return out | {"problem": "missing " + ", ".join(missing)}
    page = lambda v: int(x) if (x := v.removeprefix("<urn:page:").removesuffix(">")).lstrip("-").isdigit() else None
    out |= {"record_type": field["warc-type"], "page_id": page(field["warc-record-id"]), "url": field.get("warc-target-uri"), "refers_to": page(field.get("warc-refers-to", ""))}
    size = int(field["content-length"]) if field["content-length"].isdigit() else -1
    if size < 0 or rest[size:] != b"\r\n\r\n":
        return out | {"problem": "the block's length is not Content-Length"}
    http, gap, body = rest[:size].partition(b"\r\n\r\n")
    length = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not gap or not length or not length[0].isdigit():
        return out | {"problem": "the payload has no length"}
    stated = field.get("warc-payload-digest", "").removeprefix("sha256:")
    out |= {"payload_bytes": int(length[0]), "payload_digest": stated}
    if field["warc-type"] == "revisit":
        return out | ({"problem": "a revisit must refer to a record and have no payload"} if body or out["refers_to"] is None else {})
    out["payload"] = body
    if len(body) != int(length[0]):
        return out | {"problem": "the payload's length is not the stated one"}
    if hashlib.sha256(body).hexdigest() != stated:
        return out | {"problem": "the payload's digest is not the stated one"}
    return out


def marked(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds digest, n_bytes and refers_to (null: a response) to page_id, url and html.

    Only pages of ``least`` bytes look for their like; others have no key and are spread.  Payloads
    that very many pages share are known by their count and dealt to several tasks.
    """
    folder = run_dir(pages.sparkSession, "warc-marks")
    body = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select("page_id", "url", body.alias("html")).withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "n_bytes": F.octet_length("html").cast("long")})
    own = own.withColumn("key", F.when(F.col("n_bytes") >= least, F.col("digest")))
    heads = own.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    heads = written(heads.where((F.col("n") > 1) & F.col("first").isNotNull()), folder, "heads")
    share = F.col("n") * SHARES / F.lit(max(1, pages.count()))
    hot = heads.where(share > 1).select("key", F.ceil(share).cast("long").alias("salts"))  # fewer than SHARES rows
    first: Column = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = salted_join(own, heads.select("key", "first"), "key", SHARES, ["page_id", "url"], "left", hot)
    return joined.select("page_id", "url", "html", "digest", first.alias("refers_to"))


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes rows of :func:`marked`; (path, n) of each archive."""
    bounded_batches(records.sparkSession)
    folder = _uri(folder)

    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        held, size, trained, writer, out = [], 0, None, None, []

        def put(row):
            nonlocal writer
            if writer is None or writer.size >= ROLL:
                close()
                name = f"{root}/{uuid.uuid4().hex}.warc.zst"
                writer = Writer(store.open_output_stream(name, compression=None), trained)
                writer.name = name
            page_id, url, html, digest, refers_to = row
            writer.add(record("response" if refers_to is None else "revisit", page_id, url, html, digest, refers_to))

        def close():
            if writer is not None:
                writer.out.close()
                out.append((writer.name, writer.n))

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                row = (row[0], row[1], row[2].encode("utf-8", "surrogatepass"), row[3], row[4])
                if trained is not None:
                    put(row)
                    continue
                held.append(row)
                size += len(row[2])
                if size >= SAMPLE_BYTES:
                    trained = dictionary([x[2] for x in held])
                    for x in held:
                        put(x)
                    held = []
        if held:
            trained = dictionary([x[2] for x in held])
            for x in held:
                put(x)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["path", "n"])

    return records.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, "path string, n long")


RECORD = "record_type string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, refers_to long, problem string"


def read(files: DataFrame, folder: str) -> DataFrame:
    """The records of the archives listed in ``path``, below ``folder``."""
    spark = files.sparkSession
    bounded_batches(spark)
    folder = _uri(folder)
    kinds = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("problem", pa.string())])

    def run(batches):
        store, _ = _open(folder)
        rows, size = [], 0
        for b in batches:
            for path in b.column("path").to_pylist():
                with store.open_input_stream(path, compression=None) as source:
                    for data in frames(source):
                        rows.append(parse(data))
                        size += len(data)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    n = max(1, files.count())
    return files.select("path").repartition(n, "path").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes every page into archives and reads them back; fails on any record that does not hold up."""
    folder = run_dir(pages.sparkSession, "warc")
    files = written(write(marked(pages), f"{folder}/archives"), folder, "files")
    got = read(files, f"{folder}/archives")
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("WARC record: "), "problem"))).otherwise(F.col("record_type"))
    return got.select("page_id", "payload_bytes", "payload_digest", sound.alias("record_type"), "refers_to")
