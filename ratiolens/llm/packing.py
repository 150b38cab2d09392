"""Packing of documents into sequences of fixed capacity.

Documents become token ids (one end id each) and pieces of at most ``capacity`` ids.
Only how many pieces of each length exist matters for a plan, and there are at most
``capacity`` lengths: the driver plans on that histogram, never on pieces. Pieces
above a third of the capacity are matched first, at most two to a bin, each with the
largest partner that fits; smaller ones then go, longest first, to the tightest gap.
Bins with the same content are planned as one group, so the plan's size depends on
the capacity alone. Each piece finds its place by its rank among pieces of its
length, which comes from per-task counters and one running sum over tasks.

Defined results: a null or empty text has the end id alone; a null id is carried
like any other; repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, stage, text_or_empty
from ratiolens.llm.wordids import word_ids

CAPACITY = 2048
END_ID = 0

PIECES = "piece int, start long, length int, ids_crc32 long, block int, nth long"


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = word_ids(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches, "text", 4 << 20):
            rows, piece, start, length, crc, nth, data = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = known.ids(text or "") + end
                total = len(ids) // 4
                for k, at in enumerate(range(0, total, capacity)):
                    part = ids[4 * at : 4 * (at + capacity)]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[length[-1]])
                    seen[length[-1]] += 1
                    if with_ids:
                        data.append(part)
            out = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int32()),
                pa.array(crc, pa.int64()),
                pa.array([block] * len(rows), pa.int32()),
                pa.array(nth, pa.int64()),
            ]
            names = ["doc_id", *(x.split()[0] for x in PIECES.split(", "))]
            if with_ids:
                out.append(pa.array(data, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids; ``ids`` holds them as little-endian uint32."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}" + ", ids binary" * with_ids
    return source.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), schema)


class Plan:
    """Places of all pieces, by length and rank: from rank ``lo`` on, ``per`` to a bin from ``bin``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.groups: dict[int, list[list]] = {}  # gap: [bins, [(length, per bin, first rank, offset)]]
        self.gaps: list[int] = []
        self.used = dict.fromkeys(counts, 0)
        left = {n: c for n, c in counts.items() if c}
        third = capacity // 3
        self._match({n: c for n, c in left.items() if n > third})
        for length in sorted((n for n in left if n <= third), reverse=True):
            self._fit(length, left[length])
        self._close()

    def _keep(self, gap: int, group: list) -> None:
        if gap not in self.groups:
            self.groups[gap] = []
            insort(self.gaps, gap)
        self.groups[gap].append(group)

    def _place(self, length: int, per: int, bins: int, offset: int) -> tuple:
        rank = self.used[length]
        self.used[length] += per * bins
        return length, per, rank, offset

    def _match(self, large: dict[int, int]) -> None:
        lengths = sorted(large)
        while lengths:
            one = lengths[-1]
            at = bisect_left(lengths, self.capacity - one + 1) - 1
            if at >= 0 and lengths[at] == one and large[one] == 1:
                at -= 1  # the last of its length goes with the next shorter one
            two = lengths[at] if at >= 0 else 0
            if two == one:
                bins = large[one] // 2
                group = [bins, [self._place(one, 2, bins, 0)]]
                large[one] -= bins * 2
                gap = self.capacity - 2 * one
            elif two:
                bins = min(large[one], large[two])
                group = [bins, [self._place(one, 1, bins, 0), self._place(two, 1, bins, one)]]
                large[one] -= bins
                large[two] -= bins
                gap = self.capacity - one - two
            else:
                bins = large.pop(one)
                group = [bins, [self._place(one, 1, bins, 0)]]
                gap = self.capacity - one
            self._keep(gap, group)
            lengths = [n for n in lengths if large.get(n)]

    def _split(self, group: list, bins: int) -> tuple[list, list]:
        rest = [(n, per, rank + per * bins, off) for n, per, rank, off in group[1]]
        return [bins, group[1]], [group[0] - bins, rest]

    def _fit(self, length: int, count: int) -> None:
        while count:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                per = self.capacity // length
                self._keep(self.capacity, [-(-count // per), []])
                continue
            gap = self.gaps[at]
            group = self.groups[gap].pop()
            if not self.groups[gap]:
                del self.groups[gap], self.gaps[at]
            per = min(gap // length, count)
            bins = min(group[0], count // per)
            if bins < group[0]:
                group, rest = self._split(group, bins)
                self._keep(gap, rest)
            group[1] = [*group[1], self._place(length, per, bins, self.capacity - gap)]
            count -= per * bins
            self._keep(gap - per * length, group)

    def _close(self) -> None:
        found: dict[int, list] = {}
        for gap in self.gaps:
            for bins, entries in self.groups[gap]:
                for length, per, rank, offset in entries:
                    found.setdefault(length, []).append((rank, per, self.bins, offset))
                self.bins += bins
        self.slots = {n: np.array(sorted(x), dtype=np.int64).T for n, x in found.items()}


def _places(plan: Plan):
    slots = plan.slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            order = np.argsort(length, kind="stable")
            lengths, first = np.unique(length[order], return_index=True)
            bin_no = np.zeros(len(length), dtype=np.int64)
            offset = np.zeros(len(length), dtype=np.int64)
            for n, rows in zip(lengths, np.split(order, first[1:]), strict=True):
                lo, per, base, off = slots[int(n)]
                at = np.searchsorted(lo, rank[rows], side="right") - 1
                nth = rank[rows] - lo[at]
                bin_no[rows] = base[at] + nth // per[at]
                offset[rows] = off[at] + nth % per[at] * n
            kept = [n for n in batch.schema.names if n not in ("block", "nth", "before")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(bin_no), pa.array(offset)],
                [*kept, "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Every piece with its sequence and its offset there; pieces of a sequence leave no gap."""
    pieces = stage(
        token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces"
    )
    counts = pieces.groupBy("block", "length").agg(F.count("*").alias("n"))
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        "block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kind = pieces.schema["doc_id"].dataType.simpleString()
    placed = (
        pieces.join(before, ["block", "length"])
        .select(*names, "block", "nth", "before")
        .mapInArrow(
            _places(Plan(total, capacity)),
            f"doc_id {kind}, piece int, start long, length int, ids_crc32 long"
            + ", ids binary" * with_ids
            + ", sequence_id long, offset long",
        )
    )
    return placed.withColumn("length", F.col("length").cast("long")).withColumnRenamed(
        "doc_id", id_col
    )
