"""Exact duplicates by an exchange of compressed fingerprints.

Rows enter a ledger in blocks. A block sorts its 64-bit fingerprints, cuts them by
owner (a range of fingerprint values) and sends each owner one Golomb-Rice code of
the distinct values. An owner merges the codes and answers every block with a bitmap
of the values that are repeated, in the block or elsewhere. Only rows under a set
bit are suspects; their texts alone are shuffled and compared byte by byte.

A hot text costs one value per block, not one per row, its copies collapse in the
map-side half of the text aggregate, and the answer goes back to its rows by parts of
the group, so no task gathers a group.

Defined results: a null text counts as the empty text, which is a text like any
other; a null id is a row of its own right and loses ties against other ids; of rows
equal in text, length and id, the first written one stays; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import (
    SPACES,
    join_by_parts,
    ship_package,
    shuffle_parts,
    stage,
    text_or_empty,
)

BLOCK_ROWS = 1 << 18
OWNER_ROWS = 1 << 21


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct uint64 values as (remainder bits, unary quotients, remainders)."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1]) // len(values)
    width = max(0, mean.bit_length() - 1)
    shift = np.uint64(width)
    ends = np.cumsum((gaps >> shift).astype(np.int64) + 1) - 1
    unary = np.zeros(ends[-1] + 1, dtype=np.uint8)
    unary[ends] = 1
    places = np.arange(width, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return width, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def rice_decode(count: int, width: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: count * width].reshape(count, width)
        places = np.arange(width, dtype=np.uint64)
        gaps += (bits.astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


LEDGER = (
    "block long, owner int, place int, row_no long, len long, fp long, sha binary, "
    "count int, width int, unary binary, rest binary, twice binary"
)


def _blocks(owners: int, kind: pa.DataType):
    """A task's rows, in blocks: first the codes of the block, then its rows with their bit places."""
    span = np.uint64((1 << 64) // owners + 1)
    names = [x.split()[0] for x in LEDGER.split(", ")] + ["doc_id"]

    def emit(batches: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        size = rows.num_rows
        values, inverse, copies = np.unique(
            rows["fp"].to_numpy().view(np.uint64), return_inverse=True, return_counts=True
        )
        owner = (values // span).astype(np.int64)
        first = np.searchsorted(owner, np.arange(owners + 1))
        place = np.arange(len(values)) - first[owner]
        codes = []
        for k in np.flatnonzero(np.diff(first)):
            part = slice(first[k], first[k + 1])
            base = np.uint64(int(k) * int(span))
            code = rice_encode(values[part] - base)
            twice = np.packbits((copies[part] > 1).astype(np.uint8)).tobytes()
            codes.append((block, int(k), first[k + 1] - first[k], *code, twice))

        def column(at: int, kind: pa.DataType) -> pa.Array:
            return pa.array([x[at] for x in codes], kind)

        void = {n: pa.nulls(len(codes), t) for n, t in KINDS.items()} | {
            "doc_id": pa.nulls(len(codes), kind)
        }
        void |= {
            "block": column(0, pa.int64()),
            "owner": column(1, pa.int32()),
            "count": column(2, pa.int32()),
            "width": column(3, pa.int32()),
            "unary": column(4, pa.binary()),
            "rest": column(5, pa.binary()),
            "twice": column(6, pa.binary()),
        }
        yield pa.RecordBatch.from_arrays([void[n] for n in names], names)
        full = {n: pa.nulls(size, t) for n, t in KINDS.items()}
        full |= {n: rows[n].combine_chunks() for n in ("row_no", "len", "fp", "sha", "doc_id")}
        full |= {
            "block": pa.array(np.full(size, block)),
            "owner": pa.array(owner[inverse].astype(np.int32)),
            "place": pa.array(place[inverse].astype(np.int32)),
        }
        whole = pa.table([full[n] for n in names], names)
        yield from whole.to_batches(max_chunksize=20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, block = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= BLOCK_ROWS:
                yield from emit(held, block)
                held, count, block = [], 0, block + 1
        if count:
            yield from emit(held, block)

    return run


KINDS = {
    "block": pa.int64(),
    "owner": pa.int32(),
    "place": pa.int32(),
    "row_no": pa.int64(),
    "len": pa.int64(),
    "fp": pa.int64(),
    "sha": pa.binary(),
    "count": pa.int32(),
    "width": pa.int32(),
    "unary": pa.binary(),
    "rest": pa.binary(),
    "twice": pa.binary(),
}


def _answer(codes: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: which of each block's values are repeated anywhere."""
    parts = [
        rice_decode(r.count_, r.width, r.unary, r.rest)
        for r in codes.rename(columns={"count": "count_"}).itertuples()
    ]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    same = np.diff(values[order]) == 0
    repeated = np.zeros(len(values), dtype=np.uint8)
    repeated[order[1:][same]] = 1
    repeated[order[:-1][same]] = 1
    maps, at = [], 0
    for size, twice in zip(map(len, parts), codes["twice"], strict=True):
        own = np.unpackbits(np.frombuffer(twice, np.uint8))[:size]
        maps.append(np.packbits(own | repeated[at : at + size]).tobytes())
        at += size
    return pd.DataFrame({"block": codes["block"], "owner": codes["owner"], "bits": maps})


def normalised(text) -> F.Column:
    """The text without the six white-space characters."""
    return F.translate(text, SPACES, "")


def duplicate_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row_no, id, keep_id, keep_no, group_size, kept, text_sha256.

    ``row_no`` is null unless ``docs`` has the column ``row_no`` of ``numbered``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    number = F.col("row_no") if "row_no" in docs.columns else F.monotonically_increasing_id()
    text = text_or_empty(text_col)
    source = docs.select(
        number.cast("long").alias("row_no"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.char_length(text).cast("long").alias("len"),
        normalised(text).alias("norm"),
    )
    prints = source.select(
        "row_no",
        "doc_id",
        "len",
        F.xxhash64("norm").alias("fp"),
        F.unhex(F.sha2("norm", 256)).alias("sha"),
    )
    rows = docs.count()
    owners = max(2, shuffle_parts(spark), -(-rows // OWNER_ROWS))
    kind = prints.schema["doc_id"].dataType
    arrow = pa.int64()
    if kind.simpleString() != "bigint":
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)
    ledger = stage(
        prints.mapInArrow(_blocks(owners, arrow), f"{LEDGER}, doc_id {kind.simpleString()}"),
        "exact-ledger",
    )
    codes = ledger.where("place IS NULL").select(
        "block", "owner", "count", "width", "unary", "rest", "twice"
    )
    bitmaps = codes.groupBy("owner").applyInPandas(
        _answer, "block long, owner int, bits binary"
    )
    byte = F.conv(F.hex(F.expr("substring(bits, div(place, 8) + 1, 1)")), 16, 10).cast("int")
    marked = stage(
        ledger.where("place IS NOT NULL")
        .join(bitmaps, ["block", "owner"])
        .select(
            "row_no",
            "doc_id",
            "len",
            "fp",
            "sha",
            "block",
            (F.expr("shiftright(128, place % 8)").bitwiseAND(byte) > 0).alias("suspect"),
        ),
        "exact-marked",
    )
    suspects = marked.where("suspect")
    # The byte comparison: equal texts meet in one group, their copies combined before the shuffle.
    ids = suspects.select(F.col("doc_id").alias("id"), F.col("fp").alias("print")).distinct()
    texts = source.withColumn("fp", F.xxhash64("norm")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("print")), "left_semi"
    )
    verified = (
        texts.groupBy("fp", "norm")
        .agg(F.count("*").alias("n"))
        .select(F.unhex(F.sha2("norm", 256)).alias("sha"), "n")
        .groupBy("sha")
        .agg(F.sum("n").alias("group_size"), F.count("*").alias("texts"))
    )
    best = suspects.groupBy("sha").agg(
        F.min(
            F.struct(
                (-F.col("len")).alias("a"),
                F.col("doc_id").isNull().alias("b"),
                F.col("doc_id").alias("keep_id"),
                F.col("row_no").alias("keep_no"),
            )
        ).alias("best")
    )
    # Different texts under one SHA-256 would be a false group: stop rather than give it.
    groups = best.join(verified, "sha").select(
        "sha",
        "best.keep_id",
        "best.keep_no",
        F.when(F.col("texts") == 1, F.col("group_size"))
        .otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
        .alias("group_size"),
    )
    grouped = join_by_parts(suspects, groups, "sha", "row_no").select(
        "row_no", "doc_id", "keep_id", "keep_no", "group_size", "sha"
    )
    single = marked.where("NOT suspect").select(
        "row_no",
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.col("row_no").alias("keep_no"),
        F.lit(1).cast("long").alias("group_size"),
        "sha",
    )
    return grouped.unionByName(single).select(
        "row_no",
        F.col("doc_id").alias(id_col),
        "keep_id",
        "keep_no",
        "group_size",
        (F.col("row_no") == F.col("keep_no")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(numbered_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of a ``numbered`` table that stay, with the columns they came with."""
    flat = numbered_docs.select(
        "row_no", F.col(f"row.`{id_col}`").alias(id_col), F.col(f"row.`{text_col}`").alias(text_col)
    )
    gone = duplicate_rows(flat, id_col, text_col).where("NOT kept").select("row_no")
    return numbered_docs.join(gone, "row_no", "left_anti").select("row.*")
