"""Small helpers the operators share."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir

#: ASCII upper case to lower case, for bytes.translate.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; its lineage ends there,
    so a lost executor costs a re-read and not a recomputation."""
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps: its cleaner acts
    when the driver's JVM collects garbage, which an idle driver rarely does."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again:
    Spark then knows its size, and broadcasts it in a join only if that is
    under the session's threshold."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors through Spark's own file
    distribution, once for each application, so that their Python workers can
    import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-code-"), "starloom_code.zip")
    Path(path).write_bytes(raw.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch | None],
              schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is None:
                continue
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, for functions that make much of a row."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def sampled(df: DataFrame, n: int, share: float = 1.0) -> DataFrame:
    """About n / share rows for a model to be fitted on, never twice as many: those whose doc_id's hash is low.

    share: the part of the rows that is of use to the caller, roughly.
    """
    n = int(n / share)
    rate = min(1.0, n / max(1, df.count()))
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    return df.where(u < rate).limit(2 * n)


def no_null(c, default=""):
    return F.coalesce(c, F.lit(default))


#: Bits of a Bloom filter (8 MB) unless asked for otherwise, of each piece it is put together from, and at most (128 MB).
BLOOM_BITS, PIECE_BITS, MOST_BITS = 1 << 26, 1 << 20, 1 << 30


def bloom_bits(n: int) -> int:
    """Bits for n hashes: 16 or more for each, a power of two, within bounds."""
    return min(MOST_BITS, max(PIECE_BITS, 1 << max(0, 16 * n - 1).bit_length()))


def _probes(h: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.uint64(n_bits - 1)
    return h & m, (h >> np.uint64(32)) & m


def bloom_filter(hashes: DataFrame, n_bits: int = BLOOM_BITS) -> bytes:
    """A Bloom filter of the 64-bit hashes in the first column, of ``n_bits`` bits (a power of two).

    Pieces of fixed size are filled on the executors; the driver only puts
    them together. More hashes than it has room for let more through, no fewer.
    """
    def to_bits(b: pa.RecordBatch) -> pa.RecordBatch:
        x, y = _probes(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), n_bits)
        bits = np.unique(np.concatenate([x, y])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array((bits // PIECE_BITS).astype(np.int32)), pa.array((bits % PIECE_BITS).astype(np.int32))], ["piece", "bit"])

    def fill(t: pa.Table) -> pa.Table:
        a = np.zeros(PIECE_BITS, bool)
        a[t.column("bit").to_numpy()] = True
        return pa.table({"piece": pa.array([t.column("piece")[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(a).tobytes()], pa.binary())})
    rows = (arrow_map(hashes, to_bits, "piece int, bit int").distinct()
            .groupBy("piece").applyInArrow(fill, "piece int, bits binary").collect())
    out = bytearray(n_bits // 8)
    for r in rows:
        at = r["piece"] * (PIECE_BITS // 8)
        out[at:at + PIECE_BITS // 8] = r["bits"]
    return bytes(out)


def open_filter(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where a hash may be in the filter."""
    one, two = _probes(h, len(bits) * 8)
    return ((bits[one >> np.uint64(3)] >> (7 - (one & np.uint64(7))).astype(np.uint8))
            & (bits[two >> np.uint64(3)] >> (7 - (two & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)
