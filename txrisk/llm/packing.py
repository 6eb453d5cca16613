"""Packing by powers of two: each document is cut into pieces of binary lengths, pieces
of equal length share a bucket, and every piece is a sequence of its own.

A document of n ids (its end id included) gives n // size pieces of the full ``size`` and
then one piece for each set bit of n % size, the longest first. No sequence holds ids of
two documents, and none needs padding. A training job draws each batch from one bucket.

Cases: a missing or empty text gives the end id alone, one piece of length 1; a missing
doc_id stays missing; repeated rows are packed each; an empty table gives no pieces; other
columns are not read. ``sequence_id`` numbers pieces within a partition of the input, with
the partition's number in the higher bits.
"""

import itertools
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import tables
from txrisk.llm.tokens import encoder, vocabulary_path

SIZE = 2048
PART_BITS = 40  # pieces of one partition stay below 2^40
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, bucket int"
)


def piece_lengths(n: int, size: int = SIZE) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, longest first."""
    whole, rest = divmod(n, size)
    bits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [size] * whole + bits


def pack_binary(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = 1,
    size: int = SIZE,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: where it lies in its document, a checksum of its ids, its
    bucket (the power of two) and, if asked for, its ids. ``size`` is a power of two."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    vocabulary = vocabulary or vocabulary_path()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = tables.names_of(schema)

    def start():
        from pyspark import TaskContext

        number = itertools.count(TaskContext.get().partitionId() << PART_BITS)
        own = encoder(vocabulary)

        def pieces(some: dict) -> dict:
            out = []
            for name, ids in zip(some["doc_id"], own.encode(some["text"]), strict=True):
                ids, at = np.append(ids, np.uint32(end_id)).astype("<u4"), 0
                for length in piece_lengths(len(ids), size):
                    piece = ids[at : at + length]
                    row = (name, at, length, zlib.crc32(piece), len(ids), next(number), 0)
                    out.append((*row, length.bit_length() - 1, piece.astype(np.int32)))
                    at += length
            return dict(zip(names, zip(*out, strict=True), strict=False))

        return pieces

    return tables.map_slices(tables.spread(tables.texts(docs)), start, schema)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_binary(tables.read(spark, sf_dir, "documents"))
