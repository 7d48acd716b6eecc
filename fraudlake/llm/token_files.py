"""Token files: one shared zstandard dictionary, every document compressed by itself.

A data set is a folder. ``dictionary-<sha256>.zdict`` is the shared dictionary.
Each ``shard-<uuid>.tok`` holds the documents of one range of doc_id, ascending:

    magic (8 bytes) | sha256 of the dictionary (32 bytes) | one frame per document
    | index (zstandard: id valid, doc_id, end of frame, number of ids per document)
    | length of the index (8 bytes) | magic

A frame is the zstandard-compressed array of the document's ids, little-endian
unsigned 32-bit. ``manifest`` (Parquet, one row per shard) is written by Spark's
own commit, so files left by lost or repeated tasks are in no manifest and are
never read. The folder must be reachable by all executors.

Cases: a null text counts as empty (only the end id is written); null doc_ids
come first; rows with one doc_id keep together, by hash of text; an empty table
gives a data set without shards. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh_path, offsets_of, shuffle_width, text_slices
from fraudlake.llm.pieces import library_words

MAGIC = b"TOKFILE1"
HEAD = len(MAGIC) + 32
MANIFEST = "part int, shard string, first_id long, n_docs long, n_tokens long, n_bytes long, dictionary string"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write_file(path: str, data: bytes) -> None:
    store, place = _file_system(path)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(place, compression=None) as f:
        f.write(data)


def _read_file(path: str) -> bytes:
    store, place = _file_system(path)
    with store.open_input_file(place) as f:
        return f.read()


def train_dictionary(docs: DataFrame, tokenizer: str, path: str, sample_docs: int = 1024, dictionary_bytes: int = 65536, sample_bytes: int = 16384) -> str:
    """Train the shared dictionary and write it below ``path``; returns its sha256.

    The sample is bounded: of the ``sample_docs`` documents with the smallest hash of
    doc_id a window of ``sample_bytes`` characters each, at a hashed place of its text
    (whole texts where they are shorter). Where the sample is too small to train on, the
    dictionary is empty. Only the ratio depends on the sample, never the ids.
    """
    import zstandard

    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct()
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - sample_bytes + 1, F.lit(1))) + 1
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    rows = texts.select(F.substr("text", place.cast("int"), F.lit(sample_bytes)).alias("text")).limit(2 * sample_docs).collect()
    encoder = library_words(tokenizer)
    samples = [x[:sample_bytes] for x in encoder.encode([r.text for r in rows]) if x]
    try:
        data = zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        data = b""
    digest = hashlib.sha256(data).hexdigest()
    _write_file(f"{path}/dictionary-{digest}.zdict", data)
    return digest


def _dictionary(path: str, digest: str):
    import zstandard

    data = _read_file(f"{path}/dictionary-{digest}.zdict")
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"dictionary {digest} is damaged")
    return zstandard.ZstdCompressionDict(data)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str, shards: int | None = None, **sample) -> str:
    """Write all documents as a token data set below the new folder ``path``; returns ``path``."""
    digest = train_dictionary(docs, tokenizer, path, **sample)
    tail = int(end_id).to_bytes(4, "little")

    def task(batches):
        import zstandard

        encoder = None
        for batch in batches:
            if encoder is None:
                shared = _dictionary(path, digest)
                pack = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
                encoder = library_words(tokenizer)
                shard = f"shard-{uuid.uuid4().hex}.tok"
                store, place = _file_system(f"{path}/{shard}")
                out = store.open_output_stream(place, compression=None)
                out.write(MAGIC + bytes.fromhex(digest))
                doc_ids, ends, counts, at = [], [], [], HEAD
            for part in text_slices(batch):
                doc_ids += part.column("doc_id").to_pylist()
                for ids in encoder.encode(part.column("text").to_pylist()):
                    frame = pack.compress(ids + tail)
                    out.write(frame)
                    at += len(frame)
                    ends.append(at)
                    counts.append(len(ids) // 4 + 1)
        if encoder is None:
            return
        valid = np.array([x is not None for x in doc_ids], dtype="u1")
        index = zstandard.compress(
            valid.tobytes()
            + np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes()
            + np.array(ends, dtype="<u8").tobytes()
            + np.array(counts, dtype="<u4").tobytes()
        )
        out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        out.close()
        first = next((x for x in doc_ids if x is not None), None) if valid[0] else None
        row = [TaskContext.get().partitionId(), shard, first, len(doc_ids), sum(counts), at, digest]
        yield pa.record_batch([pa.array([x], t) for x, t in zip(row, _MANIFEST_TYPES, strict=True)], names=_MANIFEST_NAMES)

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    ranged = keyed.repartitionByRange(shards or shuffle_width(docs.sparkSession), "doc_id", "text_hash")
    rows = ranged.sortWithinPartitions("doc_id", "text_hash").select("doc_id", "text").mapInArrow(task, MANIFEST)
    rows.write.parquet(f"{path}/manifest")
    return path


_MANIFEST_NAMES = [x.split()[0] for x in MANIFEST.split(", ")]
_MANIFEST_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _index(data: memoryview):
    """(doc_ids with None, frame ends, numbers of ids) of a shard's bytes."""
    import zstandard

    if bytes(data[: len(MAGIC)]) != MAGIC or bytes(data[-len(MAGIC) :]) != MAGIC:
        raise ValueError("no token file")
    size = int.from_bytes(data[-len(MAGIC) - 8 : -len(MAGIC)], "little")
    raw = zstandard.decompress(bytes(data[-len(MAGIC) - 8 - size : -len(MAGIC) - 8]))
    n = len(raw) // 21
    valid = np.frombuffer(raw, "u1", n)
    ids = np.frombuffer(raw, "<i8", n, n)
    return [int(x) if v else None for x, v in zip(ids, valid, strict=True)], np.frombuffer(raw, "<u8", n, 9 * n), np.frombuffer(raw, "<u4", n, 17 * n)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shards in ascending doc_id order, each with ``start``: the ids before it (one row per shard).

    The order is that of the range partitions the shards were written from: a doc_id
    (or null) that fills several shards keeps their order."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    order = Window.orderBy("part")
    return rows.withColumn("start", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["start"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) read back from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def task(batches):
        import zstandard

        for batch in batches:
            for shard, digest, start in zip(*(batch.column(c).to_pylist() for c in ("shard", "dictionary", "start")), strict=True):
                unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(path, digest))
                data = memoryview(_read_file(f"{path}/{shard}"))
                if bytes(data[len(MAGIC) : HEAD]).hex() != digest:
                    raise ValueError(f"{shard} needs another dictionary")
                doc_ids, ends, counts = _index(data)
                starts = start + offsets_of(counts)
                begins = [HEAD, *ends.tolist()]
                for lo in range(0, len(doc_ids), 4096):
                    hi = min(lo + 4096, len(doc_ids))
                    frames = [unpack.decompress(data[begins[i] : begins[i + 1]]) for i in range(lo, hi)]
                    cols = [
                        pa.array(doc_ids[lo:hi], pa.int64()),
                        pa.array(starts[lo:hi], pa.int64()),
                        pa.array([len(x) // 4 for x in frames], pa.int64()),
                        pa.array([zlib.crc32(x) for x in frames], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([np.frombuffer(x, "<i4") for x in frames], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.record_batch(cols, names=names)

    shards = manifest(spark, path).select("shard", "dictionary", "start")
    return shards.repartition(shuffle_width(spark)).mapInArrow(task, schema)


def read_document(path: str, shard: str, doc_id: int) -> list[int] | None:
    """The ids of one document, by the shard's index: reads the index and one frame only."""
    import zstandard

    store, place = _file_system(f"{path}/{shard}")
    with store.open_input_file(place) as f:
        size = f.size()
        foot = f.read_at(16, size - 16)
        length = int.from_bytes(foot[:8], "little")
        head = f.read_at(HEAD, 0)
        doc_ids, ends, _ = _index(memoryview(head + f.read_at(length + 16, size - length - 16)))
        if doc_id not in doc_ids:
            return None
        i = doc_ids.index(doc_id)
        lo, hi = (HEAD if i == 0 else int(ends[i - 1])), int(ends[i])
        frame = f.read_at(hi - lo, lo)
    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(path, head[len(MAGIC) :].hex()))
    return np.frombuffer(unpack.decompress(frame), "<u4").tolist()


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a new data set in the shared folder and read it back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, tokenizer, end_id, fresh_path(spark, "tokens")))
