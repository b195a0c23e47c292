"""Operator 9: packing along a space-filling curve.

Every document is encoded, its tokens are hashed into a vector, the vector is projected to three
dimensions, and its Hilbert key puts like documents side by side. Spark sorts the documents by ranges of
the key; within each range documents follow one another along the curve and are cut where a sequence is full.
Only the last sequence of each range has padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm import vocabulary
from millrace.llm.bpe_words import encoder
from millrace.llm.common import cut, shuffle_width, small_batches

_DIMENSIONS, _BITS, _HASHED = 3, 16, 256


def hilbert_key(points: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """Position on the Hilbert curve of unsigned ``bits``-bit points, an (n, dimensions) array."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations of each level
        low = q - 1
        for i in range(dims):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(ids: np.ndarray, offs: np.ndarray, seed: int) -> np.ndarray:
    """Hilbert keys of documents, from the hashed and projected vector of their ids."""
    n = len(offs) - 1
    h = tn.mix(np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(2 * seed + 1))
    slot, sign = (h % np.uint64(_HASHED)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)
    doc = np.repeat(np.arange(n), np.diff(offs))
    vectors = np.bincount(doc * _HASHED + slot[ids], sign[ids], minlength=n * _HASHED).reshape(n, _HASHED)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
    low = np.clip(vectors @ np.random.default_rng(seed).standard_normal((_HASHED, _DIMENSIONS)), -4, 4)
    return hilbert_key(np.minimum((low + 4) / 8 * (1 << _BITS), (1 << _BITS) - 1).astype(np.int64))


def _encoded(path: str, added_path: str | None, end_id: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, added_path)
        end = np.array([end_id], enc.dtype).tobytes()
        for whole in batches:
            for i, j in tn.slices(whole["text"]):
                batch = whole.slice(i, j - i)
                ids = [enc.encode(t or "") + end for t in batch["text"].to_pylist()]
                offs = np.cumsum([0, *map(len, ids)]) // np.dtype(enc.dtype).itemsize
                keys = curve_keys(np.frombuffer(b"".join(ids), enc.dtype).astype(np.int64), offs, seed)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(keys, pa.int64()), pa.array(np.diff(offs), pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "curve", "n_ids", "ids"]
                )

    return run


def encode(df: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary_path: str | None = None, added_path: str | None = None, end_id: int = 0, seed: int = 7) -> DataFrame:
    """doc_id, curve, n_ids, ids: token ids of each whole text followed by ``end_id``, and the text's curve key.

    ids holds little-endian unsigned numbers of 2 bytes, or of 4 for vocabularies of over 65536. A null text is empty.
    Added tokens of the tokenizer's json at ``added_path`` are found inside texts too, as tokenizers does; without it
    they are plain text.
    """
    small_batches(df.sparkSession)
    path = vocabulary_path or vocabulary.default_path("byte_bpe_50k.tiktoken")
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encoded(path, added_path, end_id, seed), f"doc_id {kind}, curve long, n_ids long, ids binary")


def _packed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_sequence = TaskContext.get().partitionId() << 36
        at = 0  # tokens of this range so far
        for batch in batches:
            sizes = batch["n_ids"].to_numpy()
            begins = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            first, last = begins // length, (begins + sizes - 1) // length
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(sizes)), pieces)
            sequence = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + first[doc]
            begin = np.maximum(sequence * length, begins[doc])
            end = np.minimum((sequence + 1) * length, begins[doc] + sizes[doc])
            raw = batch["ids"].to_pylist()
            values, held = None, -1
            crc = np.empty(len(doc), np.int64)
            chunks: list[bytes] = []
            for k, (d, i, j) in enumerate(zip(doc.tolist(), (begin - begins[doc]).tolist(), (end - begins[doc]).tolist())):
                if d != held:
                    values, held = np.frombuffer(raw[d], f"<u{len(raw[d]) // int(sizes[d])}"), d
                piece = values[i:j].astype("<u4").tobytes()
                crc[k] = zlib.crc32(piece)
                chunks.append(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(doc)), pa.array(begin - begins[doc]), pa.array(end - begin), pa.array(crc), pa.array(sizes[doc]),
                    pa.array(first_sequence + sequence), pa.array(begin - sequence * length), pa.array(chunks, pa.binary()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(df: DataFrame, *, length: int = 1024, key: str = "doc_id", text: str = "text", vocabulary_path: str | None = None, added_path: str | None = None, end_id: int = 0, seed: int = 7, ids_per_range: int = 1 << 24, sequences_per_range: int = 256) -> DataFrame:
    """Sequences of at most ``length`` ids, as pieces of documents.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian
    unsigned 32-bit). Each id of a document, its end id included, lies in exactly one piece. A null or empty text
    is its end id alone; repeated rows and null keys are documents like others, and ties on the curve are ordered by
    key and ids. An empty table gives no piece. Other columns are ignored. There are as many ranges as the shuffle has partitions, but so many
    that a range holds about ``ids_per_range`` ids at most, and so few that it fills about ``sequences_per_range`` sequences at least: one of these is padded.
    """
    encoded = cut(encode(df, key=key, text=text, vocabulary_path=vocabulary_path, added_path=added_path, end_id=end_id, seed=seed))
    total = encoded.agg(F.sum("n_ids")).first()[0] or 0
    most = max(1, total // (length * sequences_per_range))
    ranges = max(min(shuffle_width(df.sparkSession), most), -(-total // ids_per_range))
    ordered = encoded.withColumn("tie", F.xxhash64("ids")).repartitionByRange(ranges, "curve", "doc_id", "tie").sortWithinPartitions("curve", "doc_id", "tie")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return ordered.select("doc_id", "n_ids", "ids").mapInArrow(
        _packed(length), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def decode(ids: Column, vocabulary_path: str | None = None, added_path: str | None = None) -> Column:
    """The text of a document's ids (little-endian unsigned 32-bit), whose last one is its end id. A null stays null."""
    path, added = vocabulary_path or vocabulary.default_path("byte_bpe_50k.tiktoken"), added_path or vocabulary.default_path("byte_bpe_50k.json")

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        bpe, extra = vocabulary.byte_bpe(path), {i: t.encode() for t, i in vocabulary.added_tokens(added).items()}

        def text(raw: bytes) -> str:
            return b"".join(extra.get(i) or bpe.decode_single_token_bytes(i) for i in np.frombuffer(raw, "<u4")[:-1].tolist()).decode("utf-8", "replace")

        return pa.array([None if raw is None else text(raw) for raw in ids.to_pylist()], pa.string())

    return decoded(ids)
