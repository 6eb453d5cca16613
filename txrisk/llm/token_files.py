"""Token ids as binary files: frequency-ranked ids, byte-aligned variable-length coding.

Texts are encoded where they lie, and only their packed ids are dealt by ranges of ``doc_id``
to parts, and sorted; each part becomes one folder of binary files, each file a row of blocks. A block holds whole documents, about
``block_ids`` ids (one longer document makes one longer block). Within a block, ids are
replaced by their rank by falling frequency, so the 256 most frequent ids take one byte,
the next 65,280 two, others three or four. Data bytes and control bytes lie apart: two
bits of control for each id say how many data bytes it has, four ids to a control byte.
The block carries its own table from rank to id, so any file can be read alone.

Block layout, little-endian: a header of eight 64-bit numbers (magic, part, ids of this
part before the block, documents, ids, ranks in the table, control bytes, data bytes),
then document ids (64 bits), ids per document (32 bits), which documents have no id (a
byte each), rank table (32 bits each), control bytes, data bytes, one line end.

Reading looks up each control byte in a 256-row table of four lengths, and gathers the
bytes of all ids of a block at once with numpy.

Cases: a missing text counts as empty and has the end id only; a missing doc_id sorts
first and stays missing; rows with the same doc_id follow each other by a hash of their ids,
so equal texts stand together, within a part and across the border of two; repeated rows are
kept, and a row that a third of the table repeats is spread over as many parts; a very long
text makes a block of its own length; an empty table gives no file rows and an empty result;
other columns are not read.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm import tables
from txrisk.llm.tokens import encoder, vocabulary_path
from txrisk.sources.stages import materialize, new_path

MAGIC = 0x31534C4944495654
HEADER = 8
BLOCK_IDS = 1_000_000
PART_CHARS = 32_000_000
ORDER = ("doc_id", "tie", "place")  # of rows in the files
PARTS_AT_ONCE = 4096  # parts whose sizes one task sums

# Data bytes of the four ids of each control byte, from the least significant bits up.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned numbers below 2^32."""
    values = values.astype(np.uint32)
    size = 1 + (values > 0xFF) + (values > 0xFFFF).astype(np.int8) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers that ``pack`` wrote."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    values = raw[at].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(size > byte)
        values[longer] |= raw[at[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def write_block(part: int, before: int, doc_ids: list, ids: list[np.ndarray]) -> bytes:
    counts = np.array([len(x) for x in ids], np.uint32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    seen = np.bincount(flat)
    order = np.lexsort((np.arange(len(seen)), -seen))[: np.count_nonzero(seen)]
    rank = np.zeros(len(seen), np.uint32)
    rank[order] = np.arange(len(order))
    control, data = pack(rank[flat])
    none = np.array([d is None for d in doc_ids], np.uint8)
    header = [MAGIC, part, before, len(ids), len(flat), len(order), len(control), len(data)]
    return b"".join(
        [
            np.array(header, "<i8").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            counts.astype("<u4").tobytes(),
            none.tobytes(),
            order.astype("<u4").tobytes(),
            control,
            data,
        ]
    )


def read_blocks(content: bytes) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """Of each block of a file: part, ids of the part before it, doc ids, ids of each
    document (a count), all ids."""
    at = 0

    def take(kind, n):
        nonlocal at
        found = np.frombuffer(content, kind, n, at)
        at += found.nbytes
        return found

    while at < len(content):
        magic, part, before, docs, count, ranks, n_control, n_data = map(int, take("<i8", HEADER))
        if magic != MAGIC:
            raise ValueError("not a token file")
        doc_ids, counts, none = take("<i8", docs), take("<u4", docs), take("u1", docs)
        table = take("<u4", ranks)
        ranked = unpack(take("u1", n_control), take("u1", n_data), count)
        at += 1  # the line end
        names = [None if x else int(d) for d, x in zip(doc_ids, none, strict=True)]
        yield part, before, names, counts, table[ranked]


def encode_texts(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Of each row its doc_id, ids with the end id (16 or 32 bits each, compressed), how many
    ids and characters, and what orders rows of one doc_id: a hash of the ids and, for equal rows,
    which nothing else tells apart, where they lay."""

    def start():
        from pyspark import TaskContext

        own, at = encoder(vocabulary), TaskContext.get().partitionId() << 33
        compress = zstandard.ZstdCompressor(level=1).compress

        def work(some: dict) -> dict:
            nonlocal at
            ids = [np.append(x, np.uint32(end_id)) for x in own.encode(some["text"])]
            raw = [x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids]
            at += len(ids)
            return {
                "doc_id": some["doc_id"],
                "tie": [xxhash.xxh3_64_intdigest(r) - (1 << 63) for r in raw],
                "place": list(range(at - len(ids), at)),
                "chars": list(map(len, some["text"])),
                "n": list(map(len, ids)),
                "ids": list(map(compress, raw)),
            }

        return work

    schema = "doc_id bigint, tie bigint, place bigint, chars bigint, n bigint, ids binary"
    return tables.map_slices(tables.spread(tables.texts(docs)), start, schema)


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = 0,
    part_chars: int = PART_CHARS,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in order of ``doc_id``,
    to ``part=N`` folders below ``path``. Spark's own writer commits the files, so a lost
    task leaves nothing behind and any file system Spark can write to will do."""
    session = docs.sparkSession
    rows = materialize(encode_texts(docs, vocabulary or vocabulary_path(), end_id), "ids")
    chars = rows.agg(F.sum("chars")).first()[0] or 0
    cores = session.sparkContext.defaultParallelism
    parts = max(-(-chars // part_chars), min(cores, 1 + chars // 100_000))
    held = rows.select(*ORDER, "n", "ids")
    ordered = held.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, held, names, size = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema({"part": pa.int32(), "block": pa.binary()})
        decompress = zstandard.ZstdDecompressor().decompress

        def block():
            raw = write_block(part, before, names, held)
            return pa.RecordBatch.from_pydict({"part": [part], "block": [raw]}, schema)

        for batch in batches:
            for a in range(0, batch.num_rows, tables.SLICE_ROWS):
                some = batch.slice(a, tables.SLICE_ROWS).to_pydict()
                for name, n, raw in zip(some["doc_id"], some["n"], some["ids"], strict=True):
                    raw = decompress(raw)
                    names.append(name)
                    held.append(np.frombuffer(raw, f"<u{len(raw) // n}"))
                    size += n
                    if size >= block_ids:
                        yield block()
                        before, held, names, size = before + size, [], [], 0
        if held:
            yield block()

    made = ordered.mapInArrow(blocks, "part int, block binary")
    # the text writer puts out a string's bytes as they are
    made.select("part", F.col("block").cast("string").alias("value")).write.partitionBy(
        "part"
    ).option("lineSep", "\n").text(path)


def read_token_files(
    spark: SparkSession, path: str, with_ids: bool = False
) -> DataFrame:
    """What the files below ``path`` hold, a row for each document: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32 (of its ids as little-endian 32-bit
    numbers) and, if asked for, the ids."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    content = files.option("pathGlobFilter", "*.txt").load(path).select("content")

    def documents(batches):
        for batch in batches:
            for raw in batch["content"]:
                for part, before, names, counts, ids in read_blocks(raw):
                    ends = np.cumsum(counts, dtype=np.int64)
                    starts, plain = ends - counts, ids.astype("<u4")
                    out = {
                        "part": part,
                        "doc_id": pd.array(names, "Int64"),
                        "start": before + starts,
                        "n_tokens": counts.astype(np.int64),
                        "ids_crc32": [
                            zlib.crc32(plain[a:b]) for a, b in zip(starts, ends, strict=True)
                        ],
                    }
                    if with_ids:
                        out["ids"] = [plain[a:b] for a, b in zip(starts, ends, strict=True)]
                    yield pd.DataFrame(out)

    schema = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""
    rows = materialize(content.mapInPandas(documents, schema), "read")
    joined = rows.join(part_starts(rows), "part")
    columns = ["doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"]
    return joined.select(*columns, *(["ids"] if with_ids else []))


def part_starts(rows: DataFrame) -> DataFrame:
    """part and base, the ids of all parts before it: running sums over groups of parts, then
    within each group, so that no task sums more than ``PARTS_AT_ONCE`` parts."""
    sizes = rows.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("n"))
    sizes = sizes.withColumn("many", F.floor(F.col("part") / PARTS_AT_ONCE))

    def run(window):
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(before), F.lit(0))

    groups = sizes.groupBy("many").agg(F.sum("n").alias("n"))
    groups = groups.select("many", run(Window.orderBy("many")).alias("first"))
    own = run(Window.partitionBy("many").orderBy("part")).alias("own")
    inner = sizes.select("part", "many", own)
    return inner.join(groups, "many").select("part", (F.col("first") + F.col("own")).alias("base"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_token_files(tables.read(spark, sf_dir, "documents"), path, end_id=0)
    return read_token_files(spark, path)
