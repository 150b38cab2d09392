"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte is removed when a string of ``LENGTH`` bytes over it starts anywhere else too.
Suffixes are ordered by most-significant-digit passes and only as deep as ``LENGTH``
bytes; groups still equal at that depth are the repeated windows. Suffixes that stand
alone after a pass leave, so each pass handles fewer:

1. first digit: the ``GRAM`` bytes at the anchor, the least-hashed gram of the window
   (the leftmost of equals). Equal windows have equal anchors at equal distance, and
   neighbouring windows share theirs, so one row stands for about 170 suffixes;
2. whole run: the string over all windows of an anchor. Copies end here, all their
   windows repeated; one of them stays as witness for texts that differ at the edge;
3. half digits: bytes from the anchor forward or backward. Every window holds one of
   the two, so short shared passages leave;
4. core digit: what ``STRIDE`` neighbouring windows have in common, one row for all,
   with the edge bytes around it; where both are found elsewhere all windows repeat;
5. last digit: core and own edge bytes, the windows that are left, one row each.

Digits travel as 64-bit hashes (two together before a window counts as repeated). Counts
combine before each shuffle, and suffixes meet only as counts per digit, never as a
list, so a passage that a third of all texts share costs a task no more than another.

Rows go by their number, so equal rows are told apart: each carries its own runs, and
copies end at pass 2 with one row as witness, however many there are.

Defined results: a null text is empty; a text shorter than ``LENGTH`` keeps all;
repeated rows are copies of each other, so both lose what is long enough; a null id
is carried; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, stage, text_or_empty
from ratiolens.llm.wordhash import BASE, BYTE, INVERSE, mixed, powers

LENGTH, GRAM = 400, 64
#: Windows starting so far before their anchor that they share one core digit.
STRIDE = 32
CORE = LENGTH - STRIDE + 1
#: A window starting this far before its anchor, or farther, holds the backward digit
#: (a multiple of STRIDE); a nearer one holds the forward digit.
FAR = 160
AHEAD = LENGTH - FAR + 1
#: Places in the joined buffer of a slice take so many bits of the sort key.
PLACE_BITS = 26
PLACE = np.uint64((1 << PLACE_BITS) - 1)
#: So many bytes are searched at once (arrays take some 70 times as much); longer texts in
#: pieces of this size that overlap by a window.
PIECE = 1 << 18


class Buffer:
    """Texts in one byte buffer with hashes of any range."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, dtype=np.uint8)
        n = len(self.data) + 1
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(BYTE[self.data] * powers(BASE, n)[:-1], out=self.sums[1:])
        self.back = powers(INVERSE, n)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self) -> np.ndarray:
        return mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * self.back[:-GRAM])


def window_anchors(buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Of every window start of the buffer the place of its anchor; the grams' hashes."""
    grams = buffer.grams()
    keys = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    width, want = 1, LENGTH - GRAM + 1
    while 2 * width <= want:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < want:
        keys = np.minimum(keys[: len(keys) - (want - width)], keys[want - width :])
    return (keys & PLACE).astype(np.int64), grams


def anchored_runs(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Runs of window starts with one anchor: text number, places in the text, digits."""
    pieces = [
        (k, at, text[at : at + PIECE + LENGTH - 1])
        for k, text in enumerate(texts)
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE)
    ]
    groups, size = [[]], 0
    for piece in pieces:
        if len(piece[2]) < LENGTH:
            continue
        if size and size + len(piece[2]) > PIECE:
            groups.append([])
            size = 0
        groups[-1].append(piece)
        size += len(piece[2])
    out: dict[str, list] = {n: [] for n in ("text", "first", "count", "far", "g", "s", "f", "b")}
    for group in groups:
        if not group:
            continue
        buffer = Buffer(b"".join(p[2] for p in group))
        anchor, grams = window_anchors(buffer)
        sizes = np.array([len(p[2]) for p in group])
        begin = np.cumsum(sizes) - sizes
        stop = begin + sizes - LENGTH  # last window start
        piece = np.repeat(np.arange(len(group)), sizes)[: len(anchor)]
        valid = np.arange(len(anchor)) <= stop[piece]
        new = np.flatnonzero(valid & np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(piece) != 0))))
        ends = np.minimum(np.append(new[1:], len(anchor)), stop[piece[new]] + 1)
        place = anchor[new]
        far, near = place - new, place - (ends - 1)
        whole = buffer.hashes(new, ends - 1 + LENGTH)
        run = mixed(whole + mixed(far.astype(np.uint64) << np.uint64(32) | near.astype(np.uint64)))
        ahead = np.minimum(place + AHEAD, len(buffer.data))
        behind = np.maximum(place - FAR, 0)
        out["text"].append(np.array([p[0] for p in group])[piece[new]])
        out["first"].append(new - begin[piece[new]] + np.array([p[1] for p in group])[piece[new]])
        out["count"].append(ends - new)
        out["far"].append(far)
        out["g"].append(grams[place])
        out["s"].append(run)
        out["f"].append(np.where(near < FAR, buffer.hashes(place, ahead), np.uint64(0)))
        out["b"].append(np.where(far >= FAR, buffer.hashes(behind, place + GRAM), np.uint64(0)))
    return {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in out.items()}


ANCHORS = "ref long, first long, count int, far int, g long, s long, f long, b long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2 << 20):
        texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
        runs = anchored_runs(texts)
        refs = batch.column("ref").to_numpy()[runs["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(refs),
                pa.array(runs["first"]),
                pa.array(runs["count"].astype(np.int32)),
                pa.array(runs["far"].astype(np.int32)),
                *(pa.array(runs[n].view(np.int64)) for n in "gsfb"),
            ],
            [x.split()[0] for x in ANCHORS.split(", ")],
        )


STEP = (
    "kind int, ref long, text string, spans array<long>, g long, step int, core long, "
    "base long, low int, high int, edges binary, "
    "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
)
DONE, OPEN, STEPS = 0, 1, 2


def removed(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, str]:
    """(bytes, bytes removed, maximal removed runs, SHA-256 of the rest)."""
    data = np.frombuffer(text, dtype=np.uint8)
    depth = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    gone = np.cumsum(depth[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    kept = text if not runs else data[~gone].tobytes()
    return len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def _record(kind: pa.DataType, rows: dict[str, list], count: int) -> pa.RecordBatch:
    types = {
        "kind": pa.int32(),
        "text": pa.string(),
        "spans": pa.list_(pa.int64()),
        "step": pa.int32(),
        "low": pa.int32(),
        "high": pa.int32(),
        "edges": pa.binary(),
        "kept_sha256": pa.string(),
        "doc_id": kind,
    }
    names = [*(x.split()[0] for x in STEP.split(", ")), "doc_id"]
    arrays = []
    for n in names:
        t = types.get(n, pa.int64())
        value = rows.get(n)
        if value is None:
            arrays.append(pa.nulls(count, t))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, t))
    return pa.RecordBatch.from_arrays(arrays, names)


def _steps(data: bytes, runs: list[dict]) -> dict:
    """Of open runs the groups of STRIDE windows: core digit, and the bytes around the core.

    ``base`` is where the core starts; the window ``t`` bytes before it reads the last
    ``t`` of the STRIDE - 1 bytes on the left and the rest on the right, so in ``edges``,
    both sides in a row, every window has its own run of STRIDE - 1 bytes.
    """
    side = STRIDE - 1
    lo = min(r["first"] for r in runs)
    buffer = Buffer(data[lo : max(r["first"] + r["count"] for r in runs) + LENGTH])
    out: dict[str, list] = {n: [] for n in ("g", "step", "base", "low", "high", "edges")}
    for r in runs:
        anchor, far = r["first"] + r["far"], r["far"]
        near = far - r["count"] + 1
        for step in range(near // STRIDE, far // STRIDE + 1):
            if not r["behind" if step * STRIDE >= FAR else "ahead"]:
                continue
            base = anchor - step * STRIDE
            before, after = data[max(0, base - side) : base], data[base + CORE : base + CORE + side]
            out["g"].append(r["g"])
            out["step"].append(step)
            out["base"].append(base)
            out["low"].append(max(near - step * STRIDE, 0))
            out["high"].append(min(far - step * STRIDE, side))
            sizes = bytes((len(before), len(after)))  # tells padding from text
            out["edges"].append(before.rjust(side, b"\0") + after.ljust(side, b"\0") + sizes)
    base = np.array(out["base"], dtype=np.int64) - lo
    ends = np.minimum(base + CORE, len(buffer.data))
    core = buffer.hashes(np.maximum(base, 0), ends) if len(base) else base
    return out | {"core": core.view(np.int64)}


def _lists(column: pa.ListArray) -> tuple[list[slice], pa.Array]:
    """Of each row the places of its values (none for null), and all values in a row."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    places = [slice(a, b) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
    return places, column.flatten()


def _fields(values: pa.StructArray) -> dict[str, np.ndarray]:
    names = [f.name for f in values.type]
    return {n: pc.struct_field(values, n).to_numpy(zero_copy_only=False) for n in names}


def _near(runs: dict[str, np.ndarray]) -> Iterator[list[dict]]:
    """Runs by place, in parts over a bounded range of the text, however long that is."""
    order = np.argsort(runs["first"], kind="stable")
    first = runs["first"][order]
    low = 0
    while low < len(order):
        high = min(low + 2_000, int(np.searchsorted(first, first[low] + PIECE)))
        part = order[low:high]
        values = zip(*(runs[n][part].tolist() for n in runs), strict=True)
        yield [dict(zip(runs, v, strict=True)) for v in values]
        low = high


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their open and repeated runs: finished ones, or windows still to be compared."""
    for batch in slices(batches, "text", 2 << 20):
        ids, kind = batch.column("doc_id"), batch.schema.field("doc_id").type
        done, opened, at_done, at_open = [], [], [], []
        places, values = _lists(batch.column("runs"))
        fields = _fields(values)
        for k, (ref, text, own) in enumerate(
            zip(
                batch.column("ref").to_pylist(), batch.column("text").to_pylist(), places, strict=True
            )
        ):
            data = (text or "").encode()
            runs = {n: v[own] for n, v in fields.items()}
            full = runs["whole"].astype(bool)
            starts = runs["first"][full].astype(np.int64)
            ends = starts + runs["count"][full] - 1 + LENGTH
            left = (runs["ahead"] | runs["behind"]).astype(bool)
            if not left.any():
                done.append((ref, *removed(data, starts, ends)))
                at_done.append(k)
                continue
            opened.append((ref, text, np.stack([starts, ends], axis=1).ravel().tolist()))
            at_open.append(k)
            for part in _near({n: v[left] for n, v in runs.items()}):
                rows = _steps(data, part)
                size = len(rows["step"])
                if size:
                    rows |= {
                        "kind": pa.array(np.full(size, STEPS, np.int32)),
                        "ref": pa.array(np.full(size, ref)),
                        "doc_id": pa.array([ids[k].as_py()] * size, kind),
                    }
                    yield _record(kind, rows, size)
        if done:
            columns = list(zip(*done, strict=True))
            names = ("ref", "n_bytes", "n_removed", "n_spans", "kept_sha256")
            rows = dict(zip(names, columns, strict=True)) | {"kind": [DONE] * len(done)}
            yield _record(kind, rows | {"doc_id": ids.take(pa.array(at_done))}, len(done))
        if opened:
            columns = list(zip(*opened, strict=True))
            rows = dict(zip(("ref", "text", "spans"), columns, strict=True))
            rows |= {"kind": [OPEN] * len(opened), "doc_id": ids.take(pa.array(at_open))}
            yield _record(kind, rows, len(opened))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        out = []
        places, spans = _lists(batch.column("spans"))
        spans = spans.to_numpy(zero_copy_only=False)
        more_places, more = _lists(batch.column("starts"))
        more = _fields(more)
        for text, known, own in zip(
            batch.column("text").to_pylist(), places, more_places, strict=True
        ):
            starts = np.concatenate([spans[known][::2], more["from"][own]])
            ends = np.concatenate([spans[known][1::2], more["to"][own] + LENGTH])
            out.append(removed((text or "").encode(), starts, ends))
        n_bytes, n_removed, n_spans, digest = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)),
                pa.array(digest),
            ],
            ["doc_id", *RESULT],
        )


RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def repeated_runs(source: DataFrame) -> DataFrame:
    """Passes 1 to 3 over (ref, text): anchored runs that are repeated or still open.

    Columns ref, first, count, far, g, whole (every window repeated), ahead and behind
    (windows near or far from the anchor to be compared in full).
    """
    anchors = stage(source.select("ref", "text").mapInArrow(_anchors, ANCHORS), "repeat-anchors")
    # staged, so that the join below reads two exchanges and a hot digit can be split
    shared = anchors.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    shared = stage(shared, "repeat-digits")
    anchors = stage(anchors.join(shared, "g", "left_semi"), "repeat-shared")
    runs = stage(
        anchors.groupBy("g", "s", "f", "b").agg(
            F.count("*").alias("n"), F.min("ref").alias("witness")
        ),
        "repeat-runs",
    )

    def halves(name: str, flag: str) -> DataFrame:
        found = runs.where(F.col(name) != 0).groupBy("g", name).agg(F.count("*").alias("n"))
        return found.where("n > 1").select("g", name, F.lit(True).alias(flag))

    known = (
        runs.join(halves("f", "ahead"), ["g", "f"], "left")
        .join(halves("b", "behind"), ["g", "b"], "left")
        .select(
            "g",
            "s",
            "witness",
            (F.col("n") > 1).alias("whole"),
            F.coalesce("ahead", F.lit(False)).alias("ahead"),
            F.coalesce("behind", F.lit(False)).alias("behind"),
        )
        .where("whole OR ahead OR behind")
    )
    compared = ~F.col("whole") | (F.col("ref") == F.col("witness"))
    return (
        anchors.drop("f", "b")
        .join(known, ["g", "s"])
        .select(
            "ref",
            "first",
            "count",
            "far",
            "g",
            "whole",
            (F.col("ahead") & compared).alias("ahead"),
            (F.col("behind") & compared).alias("behind"),
        )
        .where("whole OR ahead OR behind")
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", from_files: bool = False
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256.

    ``from_files`` says that ``docs`` comes straight from files, whose rows keep their
    numbers when they are read again; otherwise ids and texts are written once first.
    """
    ship_package(docs.sparkSession)
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.monotonically_increasing_id().alias("ref"),
    )
    if not from_files:
        source = stage(source, "repeat-rows")
    kind = source.schema["doc_id"].dataType.simpleString()
    by_text = (
        repeated_runs(source)
        .groupBy("ref")
        .agg(
            F.collect_list(
                F.struct("first", "count", "far", "g", "whole", "ahead", "behind")
            ).alias("runs")
        )
    )
    judged = stage(
        source.join(by_text, "ref", "left")
        .select("doc_id", "ref", "text", "runs")
        .mapInArrow(_judge, f"{STEP}, doc_id {kind}"),
        "repeat-judged",
    )
    steps = judged.where(F.col("kind") == STEPS).select(
        "g", "step", "core", "ref", "base", "low", "high", "edges"
    )
    steps = steps.withColumn("edge", F.xxhash64("edges"))
    core, kind_of = ["g", "step", "core"], ["g", "step", "core", "edge"]
    kinds = stage(
        steps.groupBy(*kind_of).agg(F.count("*").alias("n"), F.min("ref").alias("witness")),
        "repeat-kinds",
    )
    mixed_cores = kinds.groupBy(*core).agg(F.count("*").alias("kinds")).where("kinds > 1")
    known = (
        kinds.join(mixed_cores.select(*core, F.lit(True).alias("mixed")), core, "left")
        .where("n > 1 OR mixed")
        .select(
            *kind_of,
            (F.col("n") > 1).alias("whole"),
            (F.coalesce("mixed", F.lit(False))).alias("mixed"),
            "witness",
        )
    )
    placed = stage(steps.join(known, kind_of).drop("edge"), "repeat-steps")
    # all windows of a group whose core and edges are found elsewhere
    whole = placed.where("whole").select(
        "ref",
        (F.col("base") - F.col("high")).alias("from"),
        (F.col("base") - F.col("low")).alias("to"),
    )
    windows = stage(
        placed.where("mixed AND (NOT whole OR ref = witness)")
        .withColumn("t", F.explode(F.sequence("low", "high")))
        .select(
            "g",
            (F.col("step") * STRIDE + F.col("t")).alias("distance"),
            F.expr(f"xxhash64(core, substring(edges, {STRIDE} - t, {STRIDE - 1}))").alias("h"),
            "ref",
            (F.col("base") - F.col("t")).alias("start"),
        ),
        "repeat-windows",
    )
    key = ["g", "distance", "h"]
    twice = windows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    single = windows.join(stage(twice, "repeat-last"), key, "left_semi").select(
        "ref", F.col("start").alias("from"), F.col("start").alias("to")
    )
    starts = (
        whole.unionByName(single)
        .groupBy("ref")
        .agg(F.collect_list(F.struct("from", "to")).alias("starts"))
    )
    opened = judged.where(F.col("kind") == OPEN).select("doc_id", "ref", "text", "spans")
    finished = opened.join(starts, "ref", "left").mapInArrow(
        _finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    done = judged.where(F.col("kind") == DONE).select("doc_id", *RESULT)
    return done.unionByName(finished).withColumnRenamed("doc_id", id_col)
