"""Fill-in-middle, token codes and centroid clustering."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratiolens.llm import centroids, fim, token_file
from ratiolens.llm.queries import tokenizer_path


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@given(st.text(alphabet="ab é€\U0001f600́", max_size=30))
@settings(max_examples=300, deadline=None)
def test_index_translates_every_place(text):
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.ExceptionIndex(data)
    points = np.arange(len(text) + 1)
    sizes = [len(text[:k].encode()) for k in points]
    assert index.byte_of(points).tolist() == sizes
    want = [sum(s < b for s in sizes[:-1]) for b in range(len(data) + 1)]
    assert index.point_of(np.arange(len(data) + 1)).tolist() == want
    assert len(index.places) == sum(len(c.encode()) > 1 for c in text)


def brute_fim(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", text


def test_fill_in_middle_by_brute_force(spark, docs, rows, no_docs):
    extra = [(5000 + k, t) for k, t in enumerate(["<P", "a<P>b", "<S>", "x <M> é", "<<S<M", "é€\U0001f600" * 90] * 9)]
    plain = docs.select("doc_id", "text", "row", "node").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True
    )
    found = fim.fill_in_middle(plain).withColumn("back", fim.restored()).collect()
    got = Counter(
        (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found
    )
    assert got == Counter(brute_fim(r[0], r[1]) for r in [*rows, *extra])
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        if r.form != "plain":
            raw = r.back.encode()
            ends = r.prefix_bytes, r.prefix_bytes + r.middle_bytes
            assert raw[: ends[0]].decode() == r.back[: r.prefix_chars]
            assert raw[ends[0] : ends[1]].decode() == r.back[r.prefix_chars :][: r.middle_chars]
    assert fim.fill_in_middle(no_docs).count() == 0


def test_fill_in_middle_takes_other_columns_and_shares(spark):
    table = spark.createDataFrame([(f"k{k}", "ab é" * k) for k in range(1, 200)], "output string, form string")
    found = fim.fill_in_middle(table, "output", "form", plain_percent=0, spm_percent=100)
    assert {r.form for r in found.select(F.col("form")).collect()} == {"spm"}


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000) | st.integers(0, 300), max_size=60), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_codes_give_every_id(ids, times):
    ids = np.array(ids * times, dtype=np.uint32)
    codes = token_file.Codes(token_file.encode(ids))
    assert codes.size == len(ids)
    assert np.array_equal(codes.run(0, len(ids)), ids)
    if len(ids):
        rng = np.random.default_rng(len(ids))
        places = rng.integers(0, len(ids), 50)
        assert np.array_equal(codes.at(places), ids[places])
        for a, b in np.sort(rng.integers(0, len(ids) + 1, (20, 2)), axis=1):
            assert np.array_equal(codes.run(int(a), int(b)), ids[a:b])


def test_codes_use_a_block_of_the_directory(monkeypatch):
    """Reading one id touches a block of a bitmap, not what lies before it."""
    ids = np.random.default_rng(1).integers(0, 1 << 20, 200_000).astype(np.uint32)
    codes = token_file.Codes(token_file.encode(ids))
    counted = []
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: counted.append(x.size) or count(x))
    assert codes.run(150_000, 150_001)[0] == ids[150_000]
    assert counted and max(counted) <= token_file.BLOCK_BYTES


def whole_ids(texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [tokenizer.encode(t, add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize("segment", [token_file.SEGMENT, 50])
def test_token_files_by_brute_force(spark, docs, rows, tmp_path, segment):
    target = f"{tmp_path}/tokens"
    assert token_file.write_tokens(docs, tokenizer_path(), target, segment=segment) == target
    found = token_file.read_documents(spark, target).collect()
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    place = 0
    for r in order:
        assert r.start == place and len(r.ids) == 4 * r.n_tokens
        place += r.n_tokens
    want = Counter(
        (r[0], np.array(x, "<u4").tobytes())
        for r, x in zip(rows, whole_ids([r[1] or "" for r in rows], 2), strict=True)
    )
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == want
    everything = np.frombuffer(b"".join(r.ids for r in order), "<u4")
    rng = np.random.default_rng(3)
    places = [*rng.integers(0, place, 300).tolist(), 0, place - 1, place, -1, None, 0]
    asked = spark.createDataFrame([(p,) for p in places], "place long")
    answers = {r.place: r.token for r in token_file.tokens_at(spark, target, asked).collect()}
    assert answers == {p: int(everything[p]) for p in places if p is not None and 0 <= p < place}


def test_token_files_of_nothing(spark, no_docs, tmp_path):
    token_file.write_tokens(no_docs, tokenizer_path(), f"{tmp_path}/none")
    assert token_file.read_documents(spark, f"{tmp_path}/none").count() == 0


def test_rows_of_one_id_spread_over_parts(spark, tmp_path):
    """Null ids or one id for all: parts are cut by row number too."""
    table = spark.createDataFrame([(None, f"word {k}", k) for k in range(4000)], "doc_id long, text string, part int")
    table.repartition(8).write.parquet(f"{tmp_path}/rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_file.write_tokens(spark.read.parquet(f"{tmp_path}/rows"), tokenizer_path(), f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(f"{tmp_path}/t/parts").collect()
    assert len(parts) == 4 and max(r.n_tokens for r in parts) < 2 * min(r.n_tokens for r in parts)
    assert token_file.read_documents(spark, f"{tmp_path}/t").count() == 4000


def brute_clusters(rows, clusters=40, rounds=5):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    vectors = np.array([v for _, v in kept], dtype=np.int64)
    order = sorted(range(len(kept)), key=lambda k: (sha(f"2:{'' if kept[k][0] is None else kept[k][0]}"), vectors[k].astype("<i4").tobytes()))
    places = vectors[order[:clusters]].copy()
    for last in [False] * rounds + [True]:
        far = ((vectors[:, None, :] - places[None]) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        if not last:
            for c in range(len(places)):
                mine = vectors[near == c]
                if len(mine):
                    places[c] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    distance = far.min(axis=1)
    return [
        (i, int(c), int(d), int(distance[near == c].sum()), int(distance.sum()), sha(",".join(map(str, places[c].tolist()))))
        for (i, _), c, d in zip(kept, near, distance, strict=True)
    ]


def vector_rows(kind: str) -> list[tuple]:
    rng = np.random.default_rng(len(kind))
    if kind == "blobs":
        middle = rng.normal(size=(12, 64))
        data = middle[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 64))
        data /= np.linalg.norm(data, axis=1)[:, None]
    elif kind == "noise":
        data = rng.normal(size=(700, 64)) * 0.1
    elif kind == "ties":  # a small grid: many equal distances and equal vectors
        data = rng.integers(0, 2, (600, 64)) * (np.arange(64) < 6) / 256.0
    elif kind == "few":
        data = rng.normal(size=(7, 64))
    else:
        data = np.tile(rng.normal(size=64), (300, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(data)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [None] + [0.5] * 63]
    rows += [(9000 + k, v) for k, v in enumerate(bad)]
    return rows + [(None, rows[0][1]), (None, rows[1][1]), rows[2], rows[2]]


@pytest.mark.parametrize("kind", ["blobs", "noise", "ties", "few", "equal"])
def test_clusters_by_brute_force(spark, kind):
    rows = vector_rows(kind)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, id string")
    found = centroids.clusters_with_inertia(table.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(brute_clusters(rows))


def test_clusters_of_nothing_and_of_huge_values(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.clusters_with_inertia(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema))


def test_search_looks_at_few_centroids(monkeypatch):
    """The ball leaves most centroids out, and bounds most vectors, once clusters are settled."""
    rng = np.random.default_rng(5)
    middle = rng.integers(-2000, 2000, (40, 64))
    vectors = np.repeat(middle, 50, axis=0) + rng.integers(-20, 20, (2000, 64))
    counted = []
    squared = centroids.Centroids.squared
    monkeypatch.setattr(
        centroids.Centroids, "squared", lambda self, v, w: counted.append(len(v)) or squared(self, v, w)
    )
    near = np.repeat(np.arange(40), 50)
    a, b, d_a, d_b = centroids.Centroids(middle).search(vectors, near, (near + 1) % 40)
    far = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2)
    two = np.sort(far, axis=1)[:, :2]
    assert (a == far.argmin(axis=1)).all() and (d_a == two[:, 0]).all() and (d_b == two[:, 1]).all()
    assert sum(counted) < 0.5 * far.size


def test_digests_match_the_codes(spark, docs, tmp_path):
    target = token_file.write_tokens(docs, tokenizer_path(), f"{tmp_path}/t")
    found = token_file.read_documents(spark, target).withColumn("crc", F.crc32("ids")).collect()
    assert all(zlib.crc32(r.ids) == r.crc for r in found)
