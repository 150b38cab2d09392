"""Token ids on disk in directly addressable codes.

A segment's ids are split into chunks of eight bits. Level one holds the lowest chunk of
every id and a bitmap that marks the ids which go on; level two holds the next chunk of
those alone, and so on. An id's place on the next level is the rank of its bit, which a
directory of running counts gives with one block of the bitmap. So any id, or any run of
ids, is read from its own bytes and nothing before them.

A written folder has ``segments`` (parquet: part, segment, start, n_tokens, the documents
with their starts, the code as binary) and ``parts`` (the first id's number in every part).
Parts are ranges of the id column and hold their documents in ascending order, null ids
first. A segment ends with the document that fills it: documents are never split, so a
segment is as large as ``SEGMENT`` ids and one document at most. Places inside a part come
from its own task; the driver sees one count per part.

Defined results: a null or empty text has the end id alone; rows with one id, null
included, are kept each, next to each other in the order of the input; an empty table
gives a folder without segments. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, text_or_empty
from ratiolens.llm.wordids import word_ids
from ratiolens.sources.staging import shared_folder

END_ID = 2
SEGMENT = 1 << 16
CHUNK = 8
BLOCK_BYTES = 64
#: Positions of one segment that are looked up in one row.
ASKED = 4096
#: Row groups of the segment files: a reader holds one at a time.
ROW_GROUP = 16 << 20
LEAD = "<4sBQ"
MAGIC = b"DAC1"


def encode(ids: np.ndarray) -> bytes:
    """Code of unsigned 32-bit ids: header, then per level count, chunks, bitmap, directory."""
    levels, left = [], ids.astype(np.uint32)
    while True:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.bitwise_count(bits).astype(np.uint32)
        blocks = np.add.reduceat(blocks, np.arange(0, len(bits), BLOCK_BYTES)) if len(bits) else blocks
        ranks = (np.cumsum(blocks) - blocks).astype("<u4")
        levels.append(
            struct.pack("<Q", len(left))
            + (left & 0xFF).astype(np.uint8).tobytes()
            + bits.tobytes()
            + ranks.tobytes()
        )
        left = left[more] >> CHUNK
        if not len(left):
            break
    return struct.pack(LEAD, MAGIC, len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Reads ids of one encoded segment by their numbers."""

    def __init__(self, code: bytes):
        magic, levels, self.size = struct.unpack_from(LEAD, code)
        if magic != MAGIC:
            raise ValueError("not a segment of token codes")
        self.levels, at = [], struct.calcsize(LEAD)
        for _ in range(levels):
            (count,) = struct.unpack_from("<Q", code, at)
            at += 8
            n_bits = -(-count // 8)
            n_ranks = -(-n_bits // BLOCK_BYTES)
            chunks = np.frombuffer(code, np.uint8, count, at)
            bits = np.frombuffer(code, np.uint8, n_bits, at + count)
            ranks = np.frombuffer(code, "<u4", n_ranks, at + count + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += count + n_bits + 4 * n_ranks

    @staticmethod
    def _rank(level: tuple, at: int) -> int:
        """Marked bits before ``at``."""
        _, bits, ranks = level
        if at >= 8 * len(bits):
            last = len(ranks) - 1
            return int(ranks[last]) + int(np.bitwise_count(bits[last * BLOCK_BYTES :]).sum())
        block = at // (8 * BLOCK_BYTES)
        part = bits[block * BLOCK_BYTES : at // 8 + 1].copy()
        part[-1] &= (1 << at % 8) - 1
        return int(ranks[block]) + int(np.bitwise_count(part).sum())

    def run(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, the end left out: one run of bytes on each level."""
        out = np.zeros(end - start, dtype=np.uint32)
        places = np.arange(end - start)
        for k, level in enumerate(self.levels):
            if start >= end:
                break
            chunks, bits, _ = level
            out[places] |= chunks[start:end].astype(np.uint32) << (CHUNK * k)
            first = start // 8
            marks = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")
            more = marks[start - 8 * first : end - 8 * first].astype(bool)
            if not more.any():
                break
            start, end = self._rank(level, start), self._rank(level, end)
            places = places[more]
        return out

    def at(self, places: np.ndarray) -> np.ndarray:
        """Ids at any places, one block of a bitmap per id and level."""
        out = np.zeros(len(places), dtype=np.uint32)
        rows, now = np.arange(len(places)), np.asarray(places, dtype=np.int64)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[rows] |= chunks[now].astype(np.uint32) << (CHUNK * k)
            more = (bits[now >> 3] >> (now & 7).astype(np.uint8)) & 1 == 1
            rows, now = rows[more], now[more]
            if not len(rows):
                break
            block = now // (8 * BLOCK_BYTES)
            byte = block[:, None] * BLOCK_BYTES + np.arange(BLOCK_BYTES)
            before = np.clip(now[:, None] - 8 * byte, 0, 8)
            part = bits[np.minimum(byte, len(bits) - 1)] & ((1 << before) - 1).astype(np.uint8)
            now = ranks[block].astype(np.int64) + np.bitwise_count(part).sum(axis=1, dtype=np.int64)
        return out


def _segments(path: str, end_id: int, segment: int):
    end = struct.pack("<I", end_id)

    def packed(part: int, number: int, start: int, ids: list, parts: list) -> pa.RecordBatch:
        sizes = np.array([len(x) // 4 for x in parts], dtype=np.int64)
        starts = start + np.cumsum(sizes) - sizes
        docs = pa.StructArray.from_arrays(
            [pa.concat_arrays(ids), pa.array(starts), pa.array(sizes)],
            names=["id", "start", "n_tokens"],
        )
        code = encode(np.frombuffer(b"".join(parts), "<u4"))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int64()),
                pa.array([start], pa.int64()),
                pa.array([int(sizes.sum())], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                pa.array([code], pa.binary()),
            ],
            names=["part", "segment", "start", "n_tokens", "docs", "code"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = word_ids(path), TaskContext.get().partitionId()
        number = start = size = 0
        ids, parts = [], []
        for batch in slices(batches, "text", 4 << 20):
            texts, first = batch.column("text").to_pylist(), 0
            for k, text in enumerate(texts):
                parts.append(known.ids(text or "") + end)
                size += len(parts[-1]) // 4
                if size >= segment:
                    ids.append(batch.column("id").slice(first, k + 1 - first))
                    yield packed(part, number, start, ids, parts)
                    first, number, start, size = k + 1, number + 1, start + size, 0
                    ids, parts = [], []
            if first < len(texts):
                ids.append(batch.column("id").slice(first))
        if parts:
            yield packed(part, number, start, ids, parts)

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    target: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    segment: int = SEGMENT,
) -> str:
    """Write the ids of all documents, each with the end id, in ascending order; the folder.

    One shuffle, of ids and texts by ranges of the id; rows with one id are told apart by
    their number in the input, so one id's rows may spread over many parts. ``docs`` should
    come from files (or a written table): its row order must not change between attempts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    target = target or f"{shared_folder(spark)}/ratiolens/tokens-{uuid.uuid4().hex}"
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        text_or_empty(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    kind = source.schema["id"].dataType.simpleString()
    written = (
        source.repartitionByRange("id", "row_no")
        .sortWithinPartitions("id", "row_no")
        .select("id", "text")
        .mapInArrow(
            _segments(tokenizer, end_id, segment),
            "part int, segment long, start long, n_tokens long, "
            f"docs array<struct<id: {kind}, start: long, n_tokens: long>>, code binary",
        )
    )
    written.write.option("parquet.block.size", ROW_GROUP).parquet(f"{target}/segments")
    sizes = (
        spark.read.schema(written.schema)
        .parquet(f"{target}/segments")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .collect()
    )
    base, parts = 0, []
    for row in sorted(sizes):
        parts.append((row.part, base, row.n_tokens))
        base += row.n_tokens
    frame = spark.createDataFrame(parts, "part int, base long, n_tokens long")
    frame.coalesce(1).write.parquet(f"{target}/parts")
    return target


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start`` counted over the whole folder, and ``base``, that of their part."""
    segments = spark.read.parquet(f"{folder}/segments")
    bases = spark.read.parquet(f"{folder}/parts").select("part", "base")
    return segments.join(bases, "part").withColumn("start", F.col("start") + F.col("base"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs = batch.column("docs").slice(row, 1).flatten()
            base, first = batch.column("base")[row].as_py(), batch.column("start")[row].as_py()
            codes = Codes(batch.column("code")[row].as_py())
            starts = docs.field("start").to_numpy(zero_copy_only=False) + base
            sizes = docs.field("n_tokens").to_numpy(zero_copy_only=False)
            data = [
                codes.run(s, s + n).astype("<u4").tobytes()
                for s, n in zip(starts - first, sizes, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [docs.field("id"), pa.array(starts), pa.array(sizes), pa.array(data, pa.binary())],
                names=["id", "start", "n_tokens", "ids"],
            )


def read_documents(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Every document: its first id's number, how many ids, and the ids as little-endian uint32."""
    ship_package(spark)
    segments = read_segments(spark, folder)
    kind = segments.schema["docs"].dataType.elementType["id"].dataType.simpleString()
    found = segments.select("start", "base", "docs", "code").mapInArrow(
        _documents, f"id {kind}, start long, n_tokens long, ids binary"
    )
    return found.withColumnRenamed("id", id_col)


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            asked = batch.column("asked").slice(row, 1).flatten()
            first = batch.column("start")[row].as_py()
            codes = Codes(batch.column("code")[row].as_py())
            found = codes.at(asked.to_numpy() - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([asked, pa.array(found)], names=["place", "token"])


def tokens_at(spark: SparkSession, folder: str, places: DataFrame, column: str = "place") -> DataFrame:
    """(place, token) of every distinct place asked for that the folder holds.

    Segments meet places by the ranges of ``SEGMENT`` ids they touch; places of one segment
    go to it in rows of at most ``ASKED``, however many there are.
    """
    ship_package(spark)
    asked = (
        places.select(F.col(f"`{column}`").cast("long").alias("place"))
        .where("place >= 0")
        .distinct()
        .withColumn("range", F.expr(f"place div {SEGMENT}"))
    )
    segments = read_segments(spark, folder).where("n_tokens > 0")
    touched = segments.select(
        "part",
        "segment",
        "start",
        (F.col("start") + F.col("n_tokens")).alias("end"),
        F.expr(
            f"explode(sequence(start div {SEGMENT}, (start + n_tokens - 1) div {SEGMENT}))"
        ).alias("range"),
    )
    met = (
        asked.join(touched, "range")
        .where("place >= start AND place < end")
        .groupBy("part", "segment", F.expr(f"place div {ASKED}").alias("block"))
        .agg(F.collect_list("place").alias("asked"))
    )
    rows = met.join(segments.select("part", "segment", "start", "code"), ["part", "segment"])
    return rows.select("asked", "start", "code").mapInArrow(
        _looked_up, "place long, token long"
    )
