"""Byte-level BPE encoding and decoding of whole documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder, read_vocabulary
from .common import read_documents, text_blocks


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of consecutive slices of ``data`` (``counts`` elements each)."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                                 ).cast(pa.binary())


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit), and if
    asked for ``offsets`` (the same layout: the byte of the UTF-8 text at which
    each id starts) and ``decoded`` (the bytes that the ids stand for).

    Null text is empty: no ids. Every row gives one row."""
    vocab = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        for batch in batches:
            for part, texts in text_blocks(batch):
                ids, counts, data, starts = enc.encode_slices(texts)
                size = np.array([len(t.encode()) for t in texts], np.int64) if decoded or offsets else None
                cols = [part.column("doc_id"), pa.array(counts), binaries(ids.astype("<u4"), counts)]
                names = ["doc_id", "n_tokens", "ids"]
                if offsets:
                    own = starts - np.repeat(np.cumsum(size) - size, counts)
                    cols.append(binaries(own.astype("<u4"), counts))
                    names.append("offsets")
                if decoded:
                    cols.append(_decoded(enc, ids, counts))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids binary" + ", offsets binary" * offsets + ", decoded binary" * decoded
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _decoded(enc, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    upto = np.concatenate([[0], np.cumsum(enc.token_len[ids])])
    ends = upto[np.cumsum(counts)]
    return binaries(enc.decode(ids), np.diff(np.concatenate([[0], ends])))


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids as ``encode`` gives them
    (null ids: empty). Bytes that are no UTF-8 become U+FFFD."""
    vocab = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        for batch in batches:
            texts = [enc.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).tobytes().decode("utf-8", "replace")
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(read_documents(spark, sf_dir), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
