"""Fill-in-middle: texts cut in three and written with the middle last.

Cuts are places between code points, texts are UTF-8 bytes. An index of exceptions
translates one into the other: it lists only the characters of more than one byte, by
place, with the running sum of their excess bytes. A cut is the code points before it
plus the excess of the exceptions before it, found by binary search; between exceptions
(all of an ASCII text) the two differ by a constant. One index serves a whole batch of
texts, since their bytes lie end to end.

Defined results: a null or empty text is empty and plain; a text that holds a mark
itself is plain, so every output can be read back; a null id draws like the empty id;
rows with one id draw alike, and each row keeps its own place in the result; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, text_or_empty

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SLICE_BYTES = 4 << 20


class ExceptionIndex:
    """Code points and bytes of UTF-8 data, by its characters of more than one byte."""

    def __init__(self, data: np.ndarray):
        self.places = np.flatnonzero(data >= 0xC0)  # first bytes, as byte places
        lead = data[self.places]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.points = self.places - self.excess[:-1]

    def byte_of(self, point: np.ndarray) -> np.ndarray:
        """Bytes before the given numbers of code points."""
        return point + self.excess[np.searchsorted(self.points, point, side="left")]

    def point_of(self, byte: np.ndarray) -> np.ndarray:
        """Code points that start before the given bytes; a byte within one counts it."""
        before = np.searchsorted(self.places, byte, side="left")
        inside = np.zeros(len(byte), dtype=np.int64)
        some = before > 0
        last = before[some] - 1
        ends = self.places[last] + self.excess[last + 1] - self.excess[last] + 1
        inside[some] = np.maximum(ends - byte[some], 0)
        return byte + inside - self.excess[before]


def draws(id_col: str, seed: str) -> Column:
    """Four unsigned 32-bit numbers of a document: the first groups of a hex digest."""
    key = F.concat(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    return F.array(
        *[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    )


COLUMNS = (
    "n long, form string, prefix_chars long, middle_chars long, "
    "prefix_bytes long, middle_bytes long, output string"
)


def _rearranged(plain_percent: int, spm_percent: int, kept: list[str]):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.string())
        size = len(texts)
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + size + 1]
        edges = edges.astype(np.int64)
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[edges[0] : edges[-1]] if held else np.zeros(0, np.uint8)
        edges -= edges[0]
        index = ExceptionIndex(data)
        starts = index.point_of(edges)
        n = np.diff(starts)
        drawn = batch.column("draws").flatten().to_numpy().reshape(size, 4)
        cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
        one_byte, two_byte = (index.byte_of(starts[:-1] + cuts[:, k]) for k in (0, 1))
        plain = (n == 0) | (drawn[:, 2] % 100 >= 100 - plain_percent)
        for mark in (PREFIX, SUFFIX, MIDDLE):
            plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        spm = drawn[:, 3] % 100 < spm_percent
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        raw, outputs = data.tobytes(), []
        for k in range(size):
            a, b, c, d = edges[k], one_byte[k], two_byte[k], edges[k + 1]
            if plain[k]:
                outputs.append(raw[a:d])
            elif spm[k]:
                outputs.append(b"".join([marks[1], raw[c:d], marks[0], raw[a:b], marks[2], raw[b:c]]))
            else:
                outputs.append(b"".join([marks[0], raw[a:b], marks[1], raw[c:d], marks[2], raw[b:c]]))
        lengths = [cuts[:, 0], cuts[:, 1] - cuts[:, 0], one_byte - edges[:-1], two_byte - one_byte]
        columns = [pa.array(n), pa.array(form.tolist(), pa.string())]
        columns += [pa.array(x, pa.int64(), mask=plain) for x in lengths]
        columns.append(pa.array(outputs, pa.binary()).view(pa.string()))
        names = [*kept, *(x.split()[0] for x in COLUMNS.split(", "))]
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            yield one(batch)

    return run


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = SEED,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """One row per row: the id, code points, form, lengths of prefix and middle, and the output.

    ``plain_percent`` of the texts stay as they are; of the others ``spm_percent`` have the
    suffix first. No shuffle; a task holds a few MB of text at a time.
    """
    ship_package(docs.sparkSession)
    source = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        text_or_empty(text_col).alias("text"),
        draws(id_col, seed).alias("draws"),
    )
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        _rearranged(plain_percent, spm_percent, ["id"]), f"id {kind}, {COLUMNS}"
    )
    return found.withColumnRenamed("id", id_col)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of.

    No mark occurs in the text, and none can arise across the ends of two parts, so the
    first occurrence of each mark is the one written.
    """
    second = f"CASE WHEN {form} = 'spm' THEN '{PREFIX}' ELSE '{SUFFIX}' END"
    at, end = f"instr({output}, {second})", f"instr({output}, '{MIDDLE}')"
    first_part = f"substr({output}, {len(PREFIX) + 1}, {at} - {len(PREFIX) + 1})"
    second_part = f"substr({output}, {at} + {len(SUFFIX)}, {end} - {at} - {len(SUFFIX)})"
    middle = f"substr({output}, {end} + {len(MIDDLE)})"
    return F.expr(
        f"CASE {form} WHEN 'plain' THEN {output}"
        f" WHEN 'psm' THEN concat({first_part}, {middle}, {second_part})"
        f" ELSE concat({second_part}, {middle}, {first_part}) END"
    )
