"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's words (runs without white space, cut every ``PIECE`` characters so that a text
without spaces has words too) are hashed. Of all windows of ``K`` words those are
kept whose smallest inner window of ``S`` words lies at the left or right edge: closed
syncmers. That depends on the window alone, so an edit changes only the windows over
it, and of any ``K`` - ``S`` windows in a row one is kept. The fingerprint is all kept
windows in the order of the text, each with its place: written as one hexadecimal
digit, the distance from the one before, and the 32-bit hash.

Two texts are matched by these anchors: equal hashes, each at its first place, pair
up, and a pair covers ``K`` words from its place in either text. Likeness is the
Jaccard similarity of the words covered by pairs, as against all anchors' words.

The next document of each is found in buckets of neighbouring documents. A document's
key spells its id, then a hash of its text, so that keys order like documents. A range
sort of the keys alone, cut finer than needed, gives the edges: neighbouring ranges are
put together up to ``BUCKET_BYTES`` of text or a task's share of all. However ids are
spread, buckets are alike, and documents of one id, null included, are cut by the hash.
The driver holds one edge per bucket, a few per shuffle partition. Texts are shuffled
once, and fingerprints are made after that; the first document of a bucket is also sent
to the bucket before it.

Defined results: a null text counts as empty, and an empty text has the empty
fingerprint, alike (1) to another and unlike (0) to all others; a text that
keeps no window (always under ``K`` words, at times with up to two more) has one, the
whole; ids are whole numbers or texts, in their order, null ids first; rows of equal id
are ordered by a hash of their text, and rows equal in both stay in one bucket; a lone
document is its own next; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratiolens.llm.common import WORD, shuffle_parts, text_or_empty

K, S, PIECE = 5, 2, 16
BUCKET_BYTES = 32 << 20
#: Key ranges per bucket, and what a document weighs besides its text.
FINER, ROW_BYTES = 2, 256
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
MASK = 0xFFFFFFFF
#: Bits of a place under the hash of an anchor.
PLACE = 30
AT = (1 << PLACE) - 1


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the array ``name``: hash and place of all closed syncmers of ``text``."""
    inner = K - S
    edges = f"least(get({name}_s, i), get({name}_s, i + {inner}))"
    middle = ", ".join(f"get({name}_s, i + {j})" for j in range(1, inner))
    words = ", ".join(f"get({name}_h, i + {j})" for j in range(K))
    short = ", ".join(f"get({name}_h, i + {j})" for j in range(S))
    places = f"if(size({name}_h) < {{n}}, array(), sequence(0, size({name}_h) - {{n}}))"
    df = df.withColumn(
        f"{name}_h",
        F.expr(
            f"transform(regexp_extract_all(`{text}`, r'{WORD[:-1]}{{1,{PIECE}}}', 0), w -> xxhash64(w))"
        ),
    )
    df = df.withColumn(
        f"{name}_s", F.expr(f"transform({places.format(n=S)}, i -> xxhash64({short}))")
    )
    df = df.withColumn(
        f"{name}_k",
        F.expr(
            f"transform(filter({places.format(n=K)}, i -> {edges} <= least({middle})), "
            f"i -> shiftleft(xxhash64({words}) & {MASK}L, {PLACE}) + i)"
        ),
    )
    whole = F.expr(
        f"if(size({name}_h) = 0, cast(array() as array<bigint>), "
        f"array(shiftleft(aggregate({name}_h, 42L, (a, x) -> xxhash64(a, x)) & {MASK}L, {PLACE})))"
    )
    df = df.withColumn(name, F.when(F.size(f"{name}_k") == 0, whole).otherwise(F.col(f"{name}_k")))
    return df.drop(f"{name}_h", f"{name}_s", f"{name}_k")


def _covered(places: str) -> str:
    """Number of words under the anchors at ``places``, which ascend."""
    start = "named_struct('words', 0L, 'end', 0L)"
    step = f"named_struct('words', s.words + p + {K} - greatest(s.end, p), 'end', p + {K})"
    return f"aggregate({places}, {start}, (s, p) -> {step}, s -> s.words)"


def _firsts(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name`` sorted by hash, the first place of each, and ``name_n``, its words."""
    df = df.withColumn(f"{name}_o", F.expr(f"sort_array({name})"))
    df = df.withColumn(
        name,
        F.expr(
            f"filter({name}_o, (x, i) -> "
            f"i = 0 OR shiftright(get({name}_o, i - 1), {PLACE}) <> shiftright(x, {PLACE}))"
        ),
    )
    places = f"sort_array(transform({name}, x -> x & {AT}L))"
    return df.withColumn(f"{name}_n", F.expr(_covered(places))).drop(f"{name}_o")


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with ``name``: how alike the fingerprints ``a`` and ``b`` from ``_firsts`` are."""
    # hash, side and place in one number: the two of a pair are neighbours once sorted
    side = "shiftleft(shiftright(x, {p}), {q}) + {s} + (x & {at}L)"
    left, right = (side.format(p=PLACE, q=PLACE + 1, s=f"{s}L", at=AT) for s in (0, AT + 1))
    df = df.withColumn(
        f"{name}_c",
        F.expr(
            f"sort_array(concat(transform({a}, x -> {left}), transform({b}, x -> {right})))"
        ),
    )
    for k, other in ((0, "i + 1"), (1, "i - 1")):
        same = f"shiftright(x, {PLACE + 1}) = shiftright(get({name}_c, {other}), {PLACE + 1})"
        on_side = f"(shiftright(x, {PLACE}) & 1L) = {k}"
        pairs = f"filter({name}_c, (x, i) -> {on_side} AND coalesce({same}, false))"
        places = f"sort_array(transform({pairs}, x -> x & {AT}L))"
        df = df.withColumn(f"{name}_{k}", F.expr(_covered(places)))
    both = f"({name}_0 + {name}_1) / 2.0D"
    df = df.withColumn(
        name,
        F.expr(
            f"if(size({a}) = 0 AND size({b}) = 0, 1.0D, "
            f"if(size({a}) = 0 OR size({b}) = 0, 0.0D, {both} / ({a}_n + {b}_n - {both})))"
        ),
    )
    return df.drop(f"{name}_c", f"{name}_0", f"{name}_1")


def written(name: str) -> Column:
    before = f"if(i = 0, 0L, get({name}, i - 1) & {AT}L)"
    return F.expr(
        f"array_join(transform({name}, (x, i) -> concat(lower(hex((x & {AT}L) - {before})), "
        f"lpad(lower(hex(shiftright(x, {PLACE}))), 8, '0'))), '')"
    )


def _digits(number: Column) -> Column:
    """A long as 16 digits that order like it."""
    return F.lpad(F.hex(number.bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), 63))), 16, "0")


def order_key(ids: Column, kind: str, tie: Column) -> Column:
    """A text that orders documents by id (nulls first), then by ``tie``."""
    spelt = _digits(ids.cast("long"))
    if kind not in WHOLE_NUMBERS:
        spelt = F.concat(F.hex(ids.cast("string")), F.lit("-"))
    return F.concat(F.coalesce(spelt, F.lit("!")), _digits(tie))


def bucket_edges(keys: DataFrame) -> list[str]:
    """The first key of each bucket of (key, bytes), in order."""
    size = keys.agg(F.sum("bytes")).first()[0] or 0
    parts = shuffle_parts(keys.sparkSession)
    limit = max(1, min(BUCKET_BYTES, -(-size // (2 * parts))), -(-size // (16 * parts)))
    ranges = (
        keys.repartitionByRange(int(FINER * -(-size // limit) or 1), "key")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min("key").alias("first"), F.sum("bytes").alias("bytes"))
        .collect()
    )
    edges, held = [], limit
    for row in sorted(ranges, key=lambda r: r["first"]):
        if held + row.bytes > limit:
            edges.append(row["first"])
            held = 0
        held += row.bytes
    return edges


def bucket_of(key: Column, edges: list[str]) -> Column:
    """How many edges are not above ``key``, less one: found among every n-th, then between."""
    step = max(1, math.isqrt(len(edges)))
    chunks = [edges[k : k + step] for k in range(0, len(edges), step)]
    heads = F.array(*[F.lit(c[0]) for c in chunks[1:]]).cast("array<string>")
    at = F.size(F.filter(heads, lambda e: e <= key))
    inside = F.get(F.array(*[F.array(*map(F.lit, c)) for c in chunks]), at)
    return at * step + F.size(F.filter(inside, lambda e: e <= key)) - 1


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, print and the next document's text and print (by ascending id, cyclic)."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    source = source.withColumn("key", order_key(F.col("doc_id"), kind, F.xxhash64("text")))
    edges = bucket_edges(source.select("key", (F.octet_length("text") + ROW_BYTES).alias("bytes")))
    if not edges:
        edges = [""]
    placed = source.withColumn("bucket", bucket_of(F.col("key"), edges))
    # the first document of a bucket, or its equals, is also the last one's next in the bucket before
    ends = F.pmod(F.col("bucket") - 1, F.lit(len(edges)))
    guests = placed.where(F.col("key").isin(edges)).select(
        "doc_id", "text", "key", ends.alias("bucket"), F.lit(1).alias("guest")
    )
    rows = placed.select("doc_id", "text", "key", "bucket", F.lit(0).alias("guest"))
    # fingerprints are as long as the texts: made after the exchange, not sent
    both = with_fingerprint(rows.unionByName(guests).repartition("bucket"), "text", "print")
    following = Window.partitionBy("bucket").orderBy("guest", "key")
    return (
        both.withColumn("next_text", F.lead("text").over(following))
        .withColumn("next_print", F.lead("print").over(following))
        .where("guest = 0")
        .select("doc_id", "text", "print", "next_text", "next_print")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how alike they and the next one are."""
    rows = with_next(docs, id_col, text_col)
    n = "char_length(text)"
    edited = F.expr(
        f"concat(substring(text, 1, {n} - div({n}, 4)), substring(next_text, 1, div({n}, 4)))"
    )
    rows = rows.withColumn("n_chars", F.expr(n).cast("long")).withColumn("edited", edited)
    rows = rows.drop("text", "next_text").withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows, "edited", "edited_print").drop("edited")
    rows = rows.withColumn("fingerprint", written("print"))
    rows = rows.withColumn("edited_fingerprint", written("edited_print"))
    for name in ("print", "edited_print", "next_print"):
        rows = _firsts(rows, name)
    rows = with_likeness(rows, "print", "edited_print", "near_edited")
    rows = with_likeness(rows, "print", "next_print", "near_next")
    return rows.select(
        F.col("doc_id").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
