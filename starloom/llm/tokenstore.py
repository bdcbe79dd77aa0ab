"""Token ids in binary segments, compressed by document with one shared dictionary.

Format (version 1). A store is a folder:

``dictionary/``  one row: the zstandard dictionary's bytes and their SHA-256.
``segments/``    rows (part, seg, data); part and seg ascend with doc_id.

``data`` is a self-contained segment, all integers little-endian::

    8 bytes   magic SLTOKS01
    4 bytes   length of the header, then the header as JSON: width (bytes an
              id takes), n (documents), dictionary (its SHA-256, hex)
    n x i64   doc_id (see ``null_ids``)
    n x u32   ids of each document
    n x u64   end of each document's frame in the payload: the offset index
    payload   one zstandard frame for each document, made with the dictionary

A document is read by its place in the index without touching the others. The
segments go through Spark's Parquet writer, so the folder may be in any file
system Spark writes to, and a lost executor's half-written output is discarded
by the commit protocol and written again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm import pretoken
from starloom.llm.common import arrow_map, cut, no_null, sampled, ship, table
from starloom.llm.tokencount import vocabulary
from starloom.session import checkpoint_dir

MAGIC = b"SLTOKS01"
#: The dictionary is trained on pieces of so many bytes of ids, at most so many a document, of about so many documents.
SAMPLE_DOCS, SAMPLE_PIECES, SAMPLE_PIECE, DICT_BYTES = 400, 8, 16_384, 65_536
SEGMENT_BYTES = 4 << 20
LEVEL = 3
NULL_ID = -(1 << 63)


@functools.lru_cache(maxsize=4)
def _encoder(path: str, width: int) -> pretoken.PartMemo:
    tok, kind = pretoken.load(path), f"<u{width}"
    merge = tok.model.tokenize
    as_bytes = [i.to_bytes(width, "little") for i in range(tok.get_vocab_size(with_added_tokens=True))]

    def library(parts: list[str]) -> list[bytes]:
        enc = tok.encode(parts, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(enc.ids, kind)
        ends = np.cumsum(np.bincount(np.array(enc.word_ids, np.int64), minlength=len(parts))) if len(ids) else np.zeros(len(parts), int)
        raw, out, last = ids.tobytes(), [], 0
        for e in (ends * width).tolist():
            out.append(raw[last:e])
            last = e
        return out

    def work(parts: list[str]) -> list[bytes]:
        """ASCII letters, alone or behind a space, are one pre-token that the byte-level alphabet leaves as it is but for the space:
        the library's model takes them at once, which spares its pre-tokenizer and offsets. All other parts go the whole way."""
        out, others = [], []
        for i, p in enumerate(parts):
            word = p[1:] if p[:1] == " " else p
            if word.isascii() and word.isalpha():
                out.append(b"".join([as_bytes[t.id] for t in merge("\u0120" + word if word is not p else p)]))
            else:
                out.append(b"")
                others.append(i)
        if others:
            for i, ids in zip(others, library([parts[i] for i in others]), strict=True):
                out[i] = ids
        return out

    return pretoken.PartMemo(work, [])


def id_width(path: str, end_id: int) -> int:
    tok = pretoken.load(path)
    return 2 if max(tok.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4


def encode(texts: list[str], path: str, end_id: int, width: int) -> list[bytes]:
    """Each text's ids and the end id, serialized. Texts that hold an added token go to the library whole."""
    tok, memo = pretoken.load(path), _encoder(path, width)
    end = int(end_id).to_bytes(width, "little")
    special = pretoken.added(tok)
    odd = {i for i, x in enumerate(texts) if any(s in x for s in special)}
    cut_up = memo.joined(["" if i in odd else x for i, x in enumerate(texts)])
    return [(np.array(tok.encode(texts[i], add_special_tokens=False).ids, f"<u{width}").tobytes() if i in odd
             else x) + end for i, x in enumerate(cut_up)]


def train_dictionary(docs: DataFrame, path: str, end_id: int, width: int) -> bytes:
    """A dictionary from the ids of about SAMPLE_DOCS documents of any length, whose doc_ids hash lowest.

    They are encoded and cut in the tasks: of a document, SAMPLE_PIECES pieces
    of SAMPLE_PIECE bytes at most come to the driver, spread over all of it.
    Where the sample is too small to train on, its own bytes serve as the
    dictionary; without any, the dictionary is empty.
    """
    def cut_up(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for x in encode(b.column(0).to_pylist(), path, end_id, width):
            at = range(0, len(x), SAMPLE_PIECE)
            out += [x[i:i + SAMPLE_PIECE] for i in at[::-(-len(at) // SAMPLE_PIECES)]]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["piece"])
    some = sampled(docs.select("doc_id", "text"), SAMPLE_DOCS).where("text <> ''").select("text")
    pieces = sorted(bytes(r["piece"]) for r in arrow_map(some, cut_up, "piece binary").collect())
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICT_BYTES]


def _dict(raw: bytes):
    """None for no dictionary: zstandard takes trained and raw bytes alike."""
    return zstandard.ZstdCompressionDict(raw) if raw else None


def pack_segment(ids: list[int], counts: list[int], frames: list[bytes], width: int, dictionary: str) -> bytes:
    head = json.dumps({"width": width, "n": len(ids), "dictionary": dictionary}).encode()
    ends = np.cumsum([len(f) for f in frames]).astype("<u8")
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, np.array(ids, "<i8").tobytes(),
                     np.array(counts, "<u4").tobytes(), ends.tobytes(), *frames])


class Segment:
    """Reads a segment; document ``i`` alone is ``seg.ids(i)``."""

    def __init__(self, data: bytes, dictionary: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token segment")
        k = struct.unpack_from("<I", data, 8)[0]
        self.head = json.loads(data[12:12 + k])
        if self.head["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError("the segment was written with another dictionary")
        n, at = self.head["n"], 12 + k
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.counts = np.frombuffer(data, "<u4", n, at + 8 * n)
        self.ends = np.frombuffer(data, "<u8", n, at + 12 * n)
        self.data, self.payload = data, at + 20 * n
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dict(dictionary))

    def __len__(self) -> int:
        return self.head["n"]

    def ids(self, i: int) -> np.ndarray:
        begin = int(self.ends[i - 1]) if i else 0
        frame = self.data[self.payload + begin:self.payload + int(self.ends[i])]
        width = self.head["width"]
        raw = self.decompressor.decompress(frame, max_output_size=max(1, int(self.counts[i]) * width))
        return np.frombuffer(raw, f"<u{width}")


def write_store(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> DataFrame:
    """Writes every row's ids into ``folder`` in ascending order of doc_id, then of the text's hash; returns the segments' frame.

    Null doc_ids come first and are kept as the lowest 64-bit integer; a null
    text is empty and stores the end id alone; repeated rows are stored each. An
    empty table writes a dictionary and no segment.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_null(F.col("text").cast("string")).alias("text"))
    width = id_width(path, end_id)
    raw = train_dictionary(src, path, end_id, width)
    digest = hashlib.sha256(raw).hexdigest()
    (spark.createDataFrame([(bytearray(raw), digest)], "data binary, sha256 string").coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/dictionary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _dict(raw)
        if shared:
            shared.precompute_compress(level=LEVEL)  # else every frame digests the dictionary anew
        zc = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        ids, counts, frames, part, seg, held = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            data = pack_segment(ids, counts, frames, width, digest)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()),
                                               pa.array([data], pa.binary())], ["part", "seg", "data"])
        for b in batches:
            part = b.column(2)[0].as_py() if b.num_rows else part
            texts = b.column(1).to_pylist()
            keys = b.column(0).to_pylist()
            for s in pretoken.in_groups([len(x) for x in texts]):
                for key, x in zip(keys[s], encode(texts[s], path, end_id, width), strict=True):
                    ids.append(NULL_ID if key is None else key)
                    counts.append(len(x) // width)
                    frames.append(zc.compress(x))
                    held += len(frames[-1])
                    if held >= SEGMENT_BYTES:
                        yield flush()
                        ids, counts, frames, seg, held = [], [], [], seg + 1, 0
        if ids:
            yield flush()

    # the hash stands for the text: what Spark samples to find the ranges comes to the driver
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = src.repartitionByRange(*order).sortWithinPartitions(*order, "text").withColumn("part", F.spark_partition_id())
    ship(spark)
    (ordered.mapInArrow(run, "part int, seg int, data binary")
     .write.mode("overwrite").option("compression", "none").parquet(f"{folder}/segments"))
    return spark.read.parquet(f"{folder}/segments")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, part, seg, before (ids before it in its segment), n_tokens, ids_crc32 from the files."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw = bytes(row["data"])
    if hashlib.sha256(raw).hexdigest() != row["sha256"]:
        raise ValueError("the dictionary does not match its hash")

    def run(b: pa.RecordBatch):
        for part, seg, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
            s = Segment(data, raw)
            n = s.counts.astype(np.int64)
            crc = [zlib.crc32(s.ids(i).astype("<u4").tobytes()) for i in range(len(s))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if x == NULL_ID else x for x in s.doc_ids.tolist()], pa.int64()),
                 pa.array([part] * len(s), pa.int32()), pa.array([seg] * len(s), pa.int32()),
                 pa.array(np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())],
                ["doc_id", "part", "seg", "before", "n_tokens", "ids_crc32"])
    return arrow_map(spark.read.parquet(f"{folder}/segments").select("part", "seg", "data"), run,
                     "doc_id long, part int, seg int, before long, n_tokens long, ids_crc32 long")


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` of read_store with ``start``: a part's first id from the parts' sums, a segment's from its part's."""
    segs = rows.groupBy("part", "seg").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = segs.groupBy("part").agg(F.sum("n").alias("n")).select("part", no_null(F.sum("n").over(before), 0).alias("p0"))
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (segs.select("part", "seg", no_null(F.sum("n").over(inside), 0).alias("s0")).join(parts, "part")
              .select("part", "seg", (F.col("p0") + F.col("s0")).alias("first")))
    return (rows.join(firsts, ["part", "seg"])
            .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part", "seg"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids into a store in the shared checkpoint folder and reads them back."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_store(table(spark, sf_dir, "documents"), folder, vocabulary())
    return with_starts(cut(read_store(spark, folder)))
