"""Fingerprints, mixing, packing, the pipeline and the registered queries."""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ratiolens.llm import fingerprints, mixing, packing, toxicity
from ratiolens.llm.common import WORD, numbered, table
from ratiolens.llm.oracle import ORACLES
from ratiolens.llm.queries import REGISTRY, tokenizer_path
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_copies import brute_groups

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
have_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_fingerprints_and_edits(docs, rows):
    found = fingerprints.fingerprints(docs).collect()
    order = sorted(
        (r for r in rows if r[0] is not None), key=lambda r: r[0]
    )  # equal ids of the fixture have equal texts
    texts = [r[1] or "" for r in order]
    first_null = [r for r in found if r.doc_id is None]
    assert len(found) == len(rows) and len(first_null) == 2
    want = Counter()
    nulls = {r[1] or "" for r in rows if r[0] is None}
    for k, (r, text) in enumerate(zip(order, texts, strict=True)):
        if k + 1 == len(order):
            continue  # followed by a row without id
        cut = len(text) // 4
        edited = text[: len(text) - cut] + texts[k + 1][:cut]
        want[r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found if r.doc_id is not None)
    last = order[-1]
    ends = {
        hashlib.sha256(((last[1])[: len(last[1]) - len(last[1]) // 4] + t[: len(last[1]) // 4]).encode()).hexdigest()
        for t in nulls
    }
    assert not want - got
    assert {r[2] for r in (got - want)} <= ends
    same = defaultdict(set)
    by_id = {r[0]: r[1] or "" for r in order}
    for r in found:
        if r.doc_id is not None:
            same[by_id[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in same.values())
    assert same[""] == {""}


def test_fingerprints_tell_edits_from_strangers(spark):
    rows = [(k, prose(k, 400)) for k in range(60)]
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert min(r.near_edited for r in found) > 0.3 > max(r.near_next for r in found)


def hashed(value, seed: int) -> int:
    data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little")
    return xxhash.xxh64_intdigest(data, seed)


def chain(values) -> int:
    seed = 42
    for value in values:
        seed = hashed(value, seed)
    return seed


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def brute_anchors(text: str) -> list[tuple[int, int]]:
    """(place, 32-bit hash) of the closed syncmers of a text, by their definition."""
    k, s = fingerprints.K, fingerprints.S
    words = regex.findall(f"{WORD[:-1]}{{1,{fingerprints.PIECE}}}", text)
    h = [hashed(w, 42) for w in words]
    out = []
    for i in range(len(h) - k + 1):
        inner = [signed(chain(h[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(inner[0], inner[-1]) == min(inner):
            out.append((i, chain(h[i : i + k]) & 0xFFFFFFFF))
    if not out and h:
        seed = 42
        for value in h:
            seed = chain([seed, value])
        out = [(0, seed & 0xFFFFFFFF)]
    return out


def brute_likeness(a, b) -> float:
    if not a or not b:
        return float(not a and not b)
    firsts = [{}, {}]
    for side, anchors in zip(firsts, (a, b), strict=True):
        for place, value in anchors:
            side.setdefault(value, place)
    covered = lambda places: len({p + j for p in places for j in range(fingerprints.K)})
    common = firsts[0].keys() & firsts[1].keys()
    both = sum(covered([side[x] for x in common]) for side in firsts) / 2
    return both / (sum(covered(side.values()) for side in firsts) - both)


def test_fingerprints_by_brute_force(spark, rows):
    """Anchors and likeness against their definition, on texts of every kind."""
    texts = [r[1] or "" for r in rows] + [prose(7, 400), prose(7, 300) + " " + prose(8, 100)]
    texts += [prose(7, 200)] * 2 + ["a b c d e f g h " * 30]
    table = spark.createDataFrame([(3 * k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id // 3: r for r in fingerprints.fingerprints(table.repartition(4)).collect()}
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        anchors = [brute_anchors(t) for t in (text, text[: len(text) - cut] + following[:cut], following)]
        for name, some in (("fingerprint", anchors[0]), ("edited_fingerprint", anchors[1])):
            before, spelt = 0, []
            for place, value in some:
                spelt.append(f"{place - before:x}{value:08x}")
                before = place
            assert found[k][name] == "".join(spelt)
        assert found[k].near_edited == pytest.approx(brute_likeness(anchors[0], anchors[1]))
        assert found[k].near_next == pytest.approx(brute_likeness(anchors[0], anchors[2]))


@pytest.mark.parametrize("ids", ["outlier", "null", "one", "text", "even"])
def test_buckets_are_alike_however_ids_are_spread(spark, ids, monkeypatch):
    of = {
        "outlier": lambda k: 10**15 if k == 0 else k,
        "null": lambda k: None,
        "one": lambda k: 5,
        "text": lambda k: f"host.example/{k % 7}/{k}",
        "even": lambda k: k,
    }[ids]
    kind = "string" if ids == "text" else "long"
    rows = [(of(k), prose(k, 5)) for k in range(3000)]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    source = docs.withColumn(
        "key", fingerprints.order_key(F.col("doc_id"), docs.schema["doc_id"].dataType.simpleString(), F.xxhash64("text"))
    )
    edges = fingerprints.bucket_edges(source.select("key", F.lit(300).alias("bytes")))
    sizes = source.groupBy(fingerprints.bucket_of(F.col("key"), edges).alias("b")).count().collect()
    assert len(edges) >= 8 and {r.b for r in sizes} == set(range(len(edges)))
    assert max(r["count"] for r in sizes) < 3 * 3000 / len(edges)
    found = fingerprints.with_next(docs).collect()
    keys = [(r[0] is not None, r[0] if r[0] is not None else 0) for r in rows]
    assert len(found) == 3000
    if ids in ("outlier", "text", "even"):
        order = [t for _, (_, t) in sorted(zip(keys, rows, strict=True))]
        follows = dict(zip(order, order[1:] + order[:1], strict=True))
        assert all(follows[r.text] == r.next_text for r in found)
    else:  # one circle through all texts
        follows, at, seen = {r.text: r.next_text for r in found}, rows[0][1], set()
        while at not in seen:
            seen.add(at)
            at = follows[at]
        assert len(seen) == 3000


def test_fingerprints_find_a_passage_in_long_texts(spark):
    """A shared passage counts with its length, wherever it stands; no anchor is lost."""
    passage = prose(77, 60)
    rows = []
    for k in range(12):
        at = 150 * k
        rows.append((k, " ".join([prose(6000 + k, at), passage, prose(6100 + k, 1940 - at)]).strip()))
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = 60 / (2 * 2000 - 60)
    assert all(0.7 * want < r.near_next < 1.3 * want for r in found)
    for r in found:
        anchors = [r.fingerprint[k : k + 9] for k in range(0, len(r.fingerprint), 9)]
        assert len(anchors) > 2000 / 3 - 2 and all(a[0] in "123" for a in anchors[1:])
        assert sum(int(a[0]) for a in anchors) >= 2000 - fingerprints.K - 2
        assert 0.55 < r.near_edited < 0.65


@pytest.mark.parametrize("count", [1, 4, 5, 6, 7])
def test_short_texts_have_a_fingerprint(spark, count):
    rows = [(k, f"w{k} " + prose(5000 + k, count - 1)) for k in range(80)]
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.fingerprint for r in found)
    assert len({r.fingerprint for r in found}) == 80 and max(r.near_next for r in found) < 1


@pytest.mark.parametrize("ids", [[7], [], list(range(0, 50)), [1, 2, 3, 10**17, 10**17 + 1]])
def test_next_document_is_found(spark, ids):
    rows = [(k, prose(k % 1000, 12)) for k in ids]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints.with_next(table).collect()}
    for k, (doc, text) in enumerate(rows):
        assert found[doc].text == text
        assert found[doc].next_text == rows[(k + 1) % len(rows)][1]


def test_fingerprint_plan_is_native(docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_raking_meets_its_targets(spark):
    cells = [(f"s{a}", f"l{b}", f"t{c}", 1 + (a * 7 + b * 5 + c * 3) % 11 * 10) for a in range(4) for b in range(3) for c in range(2)]
    counted = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    share = {"source": [0.4, 0.3, 0.2, 0.1], "lang": [0.2, 0.2, 0.6], "topic": [0.7, 0.3]}
    targets = {
        n: spark.createDataFrame([(f"{n[0]}{k}", x) for k, x in enumerate(v)], "value string, share double")
        for n, v in share.items()
    }
    fitted = mixing.rake(counted, targets, sweeps=25)
    for name, wanted in share.items():
        sums = {r[0]: r[1] for r in fitted.groupBy(name).agg(F.sum("weight")).collect()}
        for k, x in enumerate(wanted):
            assert sums[f"{name[0]}{k}"] == pytest.approx(x, abs=1e-6)


def test_mixing_takes_a_given_topic(spark):
    rows = [(k, prose(k, 40), "s", ("sports", "law", None)[k % 3]) for k in range(90)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, topic string"))
    assert Counter(r.topic for r in found.collect()) == {"sports": 30, "law": 30, "": 30}


def test_topics_are_learned_from_the_texts(spark):
    """The most frequent long words that few documents say name the topics."""
    about = {"hospital": 30, "football": 25, "parliament": 20}
    rows = []
    for word, count in about.items():
        for k in range(count):
            said = f"always these common words about {word.title()}, {word}. and {k % 3 * 'hospital '}{k % 3 * (word + ' ')}"
            rows.append((len(rows), said + " " + prose(len(rows), 8)))
    rows += [(len(rows) + k, "always these common words " + prose(900 + k, 5)) for k in range(900)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    topics = Counter(r.topic for r in found)
    assert topics["hospital"] >= 30 and topics["football"] == 25 and topics["parliament"] == 20
    assert topics["other"] > 200 and "always" not in topics and "common" not in topics


def test_mixing_matches_its_sql(spark, docs, no_docs, tmp_path):
    """Fixture with nulls, empty texts and repeats; the SQL reckons the scale in closed form."""
    for name, frame in (("docs", docs), ("none", no_docs)):
        folder = f"{tmp_path}/{name}"
        frame.write.parquet(f"{folder}/documents.parquet")
        found = mixing.mix(table(spark, folder, "documents"))
        assert Counter(map(tuple, found.collect())) == sql_rows("op9_mixing", folder, found.columns)


def sql_rows(name: str, folder: str, columns: list[str]) -> Counter:
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')"
    )
    return Counter(connection.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())


def test_mixing_keeps_rows_and_columns(docs, rows, no_docs):
    found = mixing.mix(docs)
    assert found.count() == len(rows)
    kept = mixing.mix(docs, keep_rows=True)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in found.where("sampled").collect()
    )
    assert mixing.mix(no_docs).count() == 0


def test_mixing_size_is_the_stated_share(spark):
    """One tiny cell does not set the size, and wordless documents have the stated chance."""
    rows = [(k, prose(k, 60 + k % 400), "en", f"s{k % 3}") for k in range(600)]
    rows += [(1000 + k, ("", None, " \n")[k % 3], "en", "s0") for k in range(300)]
    rare = [(9999, prose(9999, 50), "xx", "rare")]
    for extra in ([], rare):
        table = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string")
        found = mixing.mix(table, keep=0.8).collect()
        total = sum(r.tokens for r in found)
        assert sum(r.tokens * r.chance for r in found) == pytest.approx(0.8 * total, abs=1e-3 * total)
        assert sum(r.tokens for r in found if r.sampled) == pytest.approx(0.8 * total, rel=0.06)
        wordless = [r for r in found if r.tokens == 0]
        assert {r.chance for r in wordless} == {0.8}
        assert 0.7 < sum(r.sampled for r in wordless) / 300 < 0.9
    assert all(r.sampled for r in found if r.source == "rare")


def whole_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def check_packing(found, texts, capacity):
    """Every document whole and in order, sequences gapless and within capacity."""
    ids = whole_ids(texts)
    pieces = Counter()
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    want = Counter()
    for doc, x in enumerate(ids):
        for k, at in enumerate(range(0, len(x), capacity)):
            part = x[at : at + capacity]
            want[doc, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert pieces == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(map(len, ids))


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(spark, rows, capacity):
    texts = [r[1] or "" for r in rows] + ["<|endoftext|> it's 12 o'clock İ ñ", "x\ny\tz  w"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = packing.pack(table, tokenizer_path(), capacity=capacity)
    bins, tokens = check_packing(found.collect(), texts, capacity)
    assert bins <= -(-tokens // capacity) * 1.08 + 1
    first = found.where("doc_id = 0 AND piece = 0").first()
    assert zlib.crc32(first.ids) == first.ids_crc32 and len(first.ids) == 4 * first.length


def test_packing_plan_is_tight_and_whole():
    import random

    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([10, 50, 300])
        counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, capacity + 1), rng.randint(1, 10))}
        plan = packing.Plan(dict(counts), capacity)
        assert plan.used == counts
        fill = Counter()
        for length, (lo, per, base, offset) in plan.slots.items():
            ends = [*lo[1:], counts[length]]
            for rank in range(counts[length]):
                k = max(i for i, x in enumerate(lo) if x <= rank)
                assert rank < ends[k]
                fill[int(base[k] + (rank - lo[k]) // per[k])] += length
        assert max(fill.values()) <= capacity and len(fill) == plan.bins
        gaps = []  # first fit, longest first, as the yardstick
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            at = next((k for k, gap in enumerate(gaps) if gap >= length), None)
            if at is None:
                gaps.append(capacity)
                at = -1
            gaps[at] -= length
        assert plan.bins <= 1.03 * len(gaps) + 1


def test_packing_pairs_odd_counts():
    """Pieces of a third to a half of a bin go two by two, whatever their counts."""
    assert packing.Plan(dict.fromkeys(range(700, 871), 1), 2048).bins == 86
    assert packing.Plan({1024: 3, 1000: 2, 700: 1}, 2048).bins == 3
    assert packing.Plan({900: 1}, 2048).bins == 1


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_pipeline_stages_against_their_operators(spark, docs, rows, tmp_path):
    """Each stage's rows by brute force or SQL on what the one before kept."""
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/in-0/documents.parquet")
    labels = spark.createDataFrame([(k, k % 2) for k in range(6, 30)], "doc_id long, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        now = spark.read.parquet(f"{folder}/in-{k}/documents.parquet")
        before = [tuple(r) for r in now.collect()]
        out = step(spark, now, folder)
        out.write.parquet(f"{folder}/in-{k + 1}/documents.parquet")
        after = Counter(tuple(r) for r in spark.read.parquet(f"{folder}/in-{k + 1}/documents.parquet").collect())
        if name == "toxicity":
            scored = toxicity.score(toxicity.fit(now, labels), now).collect()
            rejected = {r.doc_id for r in scored if r.toxic}
            want = Counter(r for r in before if r[0] not in rejected)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                norm = "".join((r[1] or "").split())
                best.setdefault(norm, []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r))
            want = Counter(min(g, key=lambda m: m[:3])[3] for g in best.values())
            assert len(want) < len(set(before))
        elif name == "near_dedup":
            groups = brute_groups(before)
            names = {g[0]: g[2] for g in groups}
            want = Counter(r for r in before if names[r[0]] == r[0])
            assert sum(want.values()) < len(before)
        elif name == "mixing":
            drawn = sql_rows("op9_mixing", f"{folder}/in-{k}", ["doc_id", "sampled"])
            stay = {i for (i, sampled) in drawn if sampled}
            want = Counter(r for r in before if r[0] in stay)
        else:
            break
        assert out.columns == docs.columns and after == want
    pieces = spark.read.parquet(f"{folder}/in-5/documents.parquet").collect()
    ids = sorted((r[0] for r in before), key=lambda x: (x is not None, x))
    texts = {r[0]: r[1] or "" for r in before}
    numbers = {i: n for n, i in enumerate(ids)}
    renamed = [r.asDict() | {"doc_id": numbers[r.doc_id]} for r in pieces]
    check_packing([type("Piece", (), r) for r in renamed], [texts[i] for i in ids], packing.CAPACITY)
    written = f"{folder}/run"
    docs.write.parquet(f"{written}/documents.parquet")
    labels.write.parquet(f"{written}/labels.parquet")
    assert corpus_pipeline.run(spark, written).count() == len(pieces)


def test_operators_bring_their_code_along(tmp_path):
    """An operator on a frame of one's own works before any table was read, wherever Python runs."""
    import subprocess
    import sys

    program = (
        f"import sys; sys.path.insert(0, {os.getcwd()!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from ratiolens.llm import chat, fim, pii\n"
        "docs = spark.createDataFrame([(1, 'a@b.cc')], 'doc_id long, text string')\n"
        "turns = spark.createDataFrame([(1, 0, 'assistant', 'x')], 'conv_id long, turn long, role string, text string')\n"
        "print(pii.personal_data(docs).count() + fim.fill_in_middle(docs).count()"
        " + chat.read_back(chat.transcript(turns)).count())\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.split() == ["3"], done.stderr[-2000:]


def test_pipeline_of_nothing(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def row_counts(connection) -> dict[str, int]:
    """Rows that each query owes, by its contract."""
    count = lambda sql: connection.execute(f"SELECT count(*) FROM {sql}").fetchone()[0]
    documents = count("documents")
    owed = dict.fromkeys(REGISTRY, documents)
    owed["op2_chat"] = count("(SELECT DISTINCT conv_id FROM conversations)") + 1
    owed["op6_page_text"] = count("pages")
    owed["op13_centroids"] = count("embeddings WHERE len(embedding) = 64")
    return owed


@have_tables
@pytest.mark.parametrize("name", list(REGISTRY))
def test_registered_queries(spark, name):
    table = REGISTRY[name](spark, FOLDER)
    found = table.collect()
    connection = duckdb.connect()
    for view in ("documents", "conversations", "pages", "embeddings"):
        connection.execute(
            f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{FOLDER}/{view}.parquet')"
        )
    owed = row_counts(connection)[name]
    if name == "op10_packing":
        assert len({r.doc_id for r in found}) == sum(r.piece == 0 for r in found) == owed
    else:
        assert len(found) == owed
    if name in ORACLES:
        names = sorted(table.columns)
        want = connection.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
        assert Counter(want) == Counter(tuple(r[n] for n in names) for r in found)


def test_numbered_tables_keep_rows_and_columns(docs, rows):
    table = numbered(docs, "test-rows")
    assert Counter(tuple(r.row) for r in table.collect()) == Counter(rows)
    assert table.select("row_no").distinct().count() == len(rows)
