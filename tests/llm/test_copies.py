"""Exact copies, repeated strings and similar sets against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from ratiolens.llm import exact_dedup, jaccard_join, repeats
from ratiolens.llm.common import marked, numbered
from ratiolens.llm.components import components
from ratiolens.sources import staging
from tests.llm.conftest import SCHEMA, peak_of, prose


def test_rice_code_round_trip():
    rng = np.random.default_rng(1)
    for size, top in ((1, 5), (2, 2**63), (500, 2**62), (500, 600), (1, 0)):
        values = np.unique(rng.integers(0, top, size, dtype=np.uint64, endpoint=True))
        width, unary, rest = exact_dedup.rice_encode(values)
        assert (exact_dedup.rice_decode(len(values), width, unary, rest) == values).all()


def test_rice_code_is_small():
    values = np.sort(np.random.default_rng(2).integers(0, 2**63, 10_000, dtype=np.uint64))
    _, unary, rest = exact_dedup.rice_encode(values)
    assert len(unary) + len(rest) < 10_000 * 8 * 0.85


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_duplicates(docs, rows):
    found = exact_dedup.duplicate_rows(docs).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for r in rows:
        groups[squeezed(r[1])].append((-len(r[1] or ""), r[0] is None, r[0]))
    want = Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        want.update((m[2], keep[2], len(members), digest) for m in members)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_many_copies_meet_in_no_task(spark):
    """A group's rows are answered by parts: one text held by most rows, in many blocks."""
    rows = [(k, "the same  text" if k % 5 else f"text {k}") for k in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    found = exact_dedup.duplicate_rows(table)
    assert {(r.group_size, r.keep_id) for r in found.where("doc_id % 5 <> 0").collect()} == {(1600, 1)}
    assert found.where("kept").count() == 401


def test_rows_without_copies_keep_their_columns(docs, rows):
    kept = exact_dedup.without_copies(numbered(docs, "test"))
    assert kept.columns == docs.columns
    assert len({squeezed(r.text) for r in kept.collect()}) == kept.count()


def test_exact_duplicates_of_nothing(no_docs):
    assert exact_dedup.duplicate_rows(no_docs).count() == 0


def brute_repeats(texts):
    size = repeats.LENGTH
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    out = []
    for text in texts:
        gone = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - size + 1):
            if seen[text[k : k + size]] > 1:
                gone[k : k + size] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        out.append((len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings(docs, rows):
    found = repeats.remove_repeats(docs).collect()
    want = brute_repeats([(r[1] or "").encode() for r in rows])
    assert Counter(tuple(r) for r in found) == Counter(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )


def test_repeated_strings_at_the_edge(spark):
    """Shared passages of 399, 400 and 401 bytes, overlaps, and repeats inside one text."""
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choices("abcdefghij éß", k=n))

    shared = noise(600)
    texts = []
    for size in (300, 399, 400, 401, 480):
        part = shared.encode()[:size].decode(errors="ignore")
        texts += [noise(150) + part + noise(30), noise(20) + part + noise(260)]
    texts += [shared, shared[5:], noise(40) + shared[100:] + shared[100:] + noise(9), "xyz" * 400]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeats.remove_repeats(table.repartition(4)).collect()
    want = brute_repeats([t.encode() for t in texts])
    assert {r[0]: tuple(r[1:]) for r in found} == dict(enumerate(want))


def test_many_equal_rows_go_row_by_row(spark):
    """Rows equal in id and text: each carries its own runs, so the work grows with their number."""
    from ratiolens.sources import staging

    same, other = prose(31, 120), prose(32, 120)
    rows = [(7, same)] * 250 + [(None, other)] * 250 + [(k, prose(k, 100)) for k in range(50, 90)]
    rows.append((1, other + " " + prose(33, 90)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    runs = []
    staging.watchers.append(lambda df: runs.append(df) if "witness" in df.columns else None)
    try:
        found = repeats.remove_repeats(table).collect()
    finally:
        staging.watchers.pop()
    want = brute_repeats([t.encode() for _, t in rows])
    assert Counter(tuple(r) for r in found) == Counter(
        (r[0], *w) for r, w in zip(rows, want, strict=True)
    )
    assert runs[0].count() < 700


def test_long_texts_are_searched_in_pieces(monkeypatch):
    text = bytes(np.random.default_rng(3).integers(97, 123, 5000, dtype=np.uint8))
    whole = repeats.anchored_runs([text])
    monkeypatch.setattr(repeats, "PIECE", 1024)
    parts = repeats.anchored_runs([text])
    assert whole["count"].sum() == parts["count"].sum() == 5000 - repeats.LENGTH + 1
    at = {f + k: f + d for f, c, d in zip(whole["first"], whole["count"], whole["far"], strict=True) for k in range(c)}
    assert at == {f + k: f + d for f, c, d in zip(parts["first"], parts["count"], parts["far"], strict=True) for k in range(c)}


def test_search_memory_does_not_grow_with_the_texts():
    data = np.random.default_rng(5).integers(97, 123, 1 << 22, dtype=np.uint8).tobytes()
    texts = [data[k : k + 40_000] for k in range(0, len(data), 40_000)]
    runs, peak = peak_of(lambda: repeats.anchored_runs(texts))
    assert peak < 64 << 20
    single = [repeats.anchored_runs([t]) for t in texts]
    for name in ("first", "count", "far", "g", "s", "f", "b"):
        assert np.array_equal(runs[name], np.concatenate([r[name] for r in single]))


def test_steps_of_a_long_text_read_a_part_at_a_time(monkeypatch):
    rng, read = np.random.default_rng(7), []
    data = bytes(rng.integers(97, 123, 60_000, dtype=np.uint8))
    found = repeats.anchored_runs([data])
    runs = [
        {"first": int(a), "count": int(c), "far": int(d), "g": int(g.view(np.int64)), "whole": False}
        | {"ahead": True, "behind": True}
        for a, c, d, g in zip(*(found[n] for n in ("first", "count", "far", "g")), strict=True)
    ]
    rng.shuffle(runs)

    class Watched(repeats.Buffer):
        def __init__(self, part):
            read.append(len(part))
            super().__init__(part)

    def steps(runs):
        rows = {"doc_id": [1], "ref": [0], "text": [data.decode()], "runs": [runs]}
        batch = pa.RecordBatch.from_pydict(rows)
        tables = [pa.Table.from_batches([b]) for b in repeats._judge(iter([batch]))]
        names = ["g", "step", "core", "base", "low", "high", "edges"]
        return sorted(
            tuple(r.values()) for t in tables for r in t.select(names).to_pylist() if r["step"] is not None
        )

    monkeypatch.setattr(repeats, "Buffer", Watched)
    whole = steps(runs)
    assert whole == sorted(r for run in runs for r in steps([run]))
    read.clear()
    monkeypatch.setattr(repeats, "PIECE", 4096)
    assert steps(runs) == whole
    assert max(read) < 4096 + 2 * repeats.LENGTH


def test_repeats_of_nothing(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = [shingles(r[1]) for r in rows]
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    names = defaultdict(list)
    for k, r in enumerate(rows):
        if r[0] is not None:
            names[top(k)].append(r[0])
    return Counter(
        (r[0], len(sets[k]), min(names[top(k)]) if names[top(k)] and sets[k] else r[0])
        for k, r in enumerate(rows)
    )


def test_gaps_round_trip():
    rng = np.random.default_rng(7)
    for size, top in ((1, 1), (1, 2**40), (900, 2**40), (900, 1000), (5000, 2**33)):
        values = np.unique(rng.integers(0, top, size, dtype=np.uint64))
        assert (jaccard_join.unpacked_gaps(len(values), *jaccard_join.packed_gaps(values)) == values).all()


def test_set_memory_does_not_grow_with_the_texts():
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(4_000)).encode() for _ in range(200)]
    sets, peak = peak_of(lambda: jaccard_join.shingle_sets(texts))
    assert peak - sum(s.nbytes for s in sets) < 32 << 20
    single = [jaccard_join.shingle_sets([t])[0] for t in texts]
    assert all(map(np.array_equal, sets, single))
    assert not jaccard_join.shingle_sets([])


@pytest.mark.parametrize("parts", [1, 7])
def test_frequent_shingles_do_not_depend_on_the_split(spark, monkeypatch, parts):
    """Counts of all texts, whatever the partitions and the texts counted together."""
    texts = [prose(k % 40, 60) + " " + prose(900 + k % 5, 20) for k in range(200)]
    seen = Counter()
    for text in texts:
        for found in jaccard_join.shingle_sets([text.encode()]):
            seen.update(jaccard_join.counted(found).tolist())
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
    for together in (1000, jaccard_join.COUNTED):
        monkeypatch.setattr(jaccard_join, "COUNTED", together)
        got = jaccard_join.frequent_shingles(table)
        assert got.tolist() == sorted(x for x, n in seen.items() if n >= jaccard_join.LEAST)
    few = jaccard_join.frequent_shingles(table, most=40)
    least = min(seen[x] for x in few.tolist())
    assert 0 < len(few) <= 40 and least >= 5


@pytest.mark.parametrize("short", [jaccard_join.SHORT, 2, 40])
def test_similar_groups(docs, rows, monkeypatch, short):
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    found = jaccard_join.similar_groups(docs).drop("print").collect()
    assert Counter(tuple(r) for r in found) == brute_groups(rows)


def test_families_of_near_copies(spark, monkeypatch):
    """Random edits of one text, some linked and some not, beyond the length of a short list."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(120):
        words = list(base)
        for place in rng.sample(range(150), rng.randint(1, 5)):
            words[place] = f"edit{rng.randint(0, 9**6)}"
        rows.append((k, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similar_groups(table).drop("print").collect()
    assert Counter(tuple(r) for r in found) == brute_groups(rows)


def test_one_of_each_group(docs, no_docs):
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = jaccard_join.similar_groups(docs).where("doc_id = component_id")
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {
        r.doc_id for r in groups.collect()
    }
    assert jaccard_join.similar_groups(no_docs).count() == 0


def test_index_entries_stay_small_among_many_owners():
    """Twelve times the owners take little more room, and blocks give back what went in."""
    texts = [prose(k, 40 + k % 300) for k in range(3000)]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, None, "", texts[0]]})
    sets = jaccard_join.shingle_sets([t.encode() for t in texts])
    want = {
        (jaccard_join.class_of(s), len(s), place, int(jaccard_join.mixed(t[None])[0]) >> 32)
        for s in sets
        for place, t in enumerate(s[: jaccard_join.prefix_size(len(s))])
    }
    bytes_of = {}
    for owners in (100, 1200):
        (block,) = jaccard_join._prefixes(np.zeros(0, np.uint64), owners)(iter([batch]))
        got = []
        for r in block.to_pandas().itertuples():
            node, key = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.keys, "<u4")
            many = jaccard_join.widened(r.many, len(node))
            sizes = np.repeat(jaccard_join.widened(r.sizes, len(node)), many)
            places = jaccard_join.widened(r.places, len(key))
            got += zip(*(x.tolist() for x in (np.repeat(node, many), sizes, places, key)), strict=True)
        assert len(got) == len(want) and set(got) == want
        bytes_of[owners] = sum(len(v) for c in block.columns[1:] for v in c.to_pylist()) / len(got)
    assert bytes_of[1200] < 17 and bytes_of[1200] < 1.5 * bytes_of[100]


@pytest.mark.parametrize("size", [1, 255, 256, 65_536, 2**32 - 1])
def test_narrow_numbers_round_trip(size):
    values = np.array([0, size // 3, size], dtype=np.int64)
    data = jaccard_join.narrow(values)
    assert len(data) == 3 * next(k for k in (1, 2, 4) if size < 256**k)
    assert jaccard_join.widened(data, 3).tolist() == values.tolist()


def test_marks_miss_no_hash_and_let_few_others_pass(spark):
    rows = spark.range(200_000).withColumn("h", F.xxhash64("id"))
    hashes = rows.where("id % 20 = 0 OR id < 5").select("h")
    found = marked(rows, F.col("h"), hashes.union(hashes))
    assert found.columns == ["id", "h", "maybe"] and found.count() == 200_000
    assert found.where("NOT maybe AND (id % 20 = 0 OR id < 5)").count() == 0
    assert found.where("maybe").count() < 0.12 * 200_000
    assert marked(rows, F.col("h"), hashes.limit(0)).where("maybe").count() == 0


def test_texts_are_not_shuffled(spark, rows, monkeypatch):
    """Without broadcasts by size, no exchange of the similarity join holds a text."""
    plans = []
    explained = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    read = lambda df: plans.append(explained(df._jdf.queryExecution(), "formatted"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(staging, "watchers", [read])
    try:
        read(jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [x for p in plans for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", p)]
    assert len(moved) > 10
    assert not [x for x in moved if re.search(r"\btext#", x)]


def test_only_rows_with_the_text_of_a_lost_one_meet_it(spark):
    """Rows of one id and other texts, whole rows twice, rows without id, texts kept and lost."""
    base = prose(41, 150)
    near = base + " more"
    rows = [(3, base), (3, base), (9, near), (9, near), (9, prose(42, 80)), (3, prose(43, 90))]
    rows += [(None, base), (None, prose(44, 70)), (None, prose(44, 70)), (5, None), (5, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter(map(tuple, jaccard_join.one_of_each(table).collect()))
    lost = {(9, near), (None, base)}
    assert kept == Counter(r for r in rows if r not in lost)


def test_staged_tables_leave_no_shuffle_files(spark):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    before, table = shuffles(), spark.range(1000).repartition(7)
    kept = spark.conf.get(staging.FREE_SHUFFLES, None)
    for _ in range(3):
        assert staging.stage(table, "test").count() == 1000
    assert spark.conf.get(staging.FREE_SHUFFLES, None) == kept
    # counts shuffle a row a task, too; those files go with the driver's garbage
    assert shuffles() - before <= 3


def test_components(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 7), (200, 201), (300, 300)]
    pairs += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for u, v in pairs:
        if u != v:
            u, v = top(u), top(v)
            above[max(u, v)] = min(u, v)
    assert found == {x: top(x) for x in above}
