"""Chat, personal data, pages and toxicity."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratiolens.llm import chat, html_text, pii, toxicity
from tests.llm.conftest import peak_of

CONVERSATIONS = "conv_id long, turn long, role string, text string, segment string, nth long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@given(st.text(alphabet="<|\\>im_ends\n ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "\n" not in chat.escape_role(text)


@pytest.fixture(scope="module")
def conversation_rows():
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "hello <|im_end|>\n"),
        (1, 2, "user", "more"),
        (1, 3, "assistant", "é\U0001f600 <\\|"),
        (1, 4, "user", "left over"),
        (2, 0, "system", None),
        (2, 1, None, "<|im_start|>assistant\nx"),
        (3, 5, "assistant", ""),
        (3, 5, "assistant", ""),
        (3, None, "assistant", "first"),
        (None, 0, "user", "no id"),
        (4, 0, "user\n<|x|>", "only user"),
    ]
    rows += [(9, k, ("user", "assistant")[k % 2], f"turn {k} " * 30) for k in range(300)]
    return [(*r, "clash", 7) for r in rows]


def test_chat_reads_back(spark, conversation_rows):
    table = spark.createDataFrame(conversation_rows, CONVERSATIONS).repartition(4)
    found = {r.conv_id: r for r in chat.read_back(chat.transcript(table)).collect()}
    by_conv = {}
    for r in conversation_rows:
        by_conv.setdefault(r[0], []).append(r)
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        row = found[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(said), sha(said))
        assert row.formatted_chars > sum(len(r[3] or "") for r in turns)


def test_chat_examples_are_prefixes(spark, conversation_rows):
    table = spark.createDataFrame(conversation_rows, CONVERSATIONS)
    turns = chat.transcript(table)
    texts = {(r.conv_id, r.nth): r for r in chat.example_texts(turns).collect()}
    places = {(r.conv_id, r.nth): r for r in chat.examples(turns).collect()}
    assert texts.keys() == places.keys() and len(texts) == 2 + 3 + 150
    one, two = texts[1, 1], texts[1, 3]
    assert two.text.startswith(one.text)
    assert chat.unescape(two.text[two.loss_start : two.loss_end]) == "é\U0001f600 <\\|"
    assert two.text.endswith(chat.CLOSE) and len(two.text) == places[1, 3].text_end
    assert "left over" not in two.text


def test_chat_query_counts_every_example(spark, conversation_rows):
    turns = chat.transcript(spark.createDataFrame(conversation_rows, CONVERSATIONS))
    texts = Counter()
    spelt = {}
    for r in chat.example_texts(turns).collect():
        texts[r.conv_id] += len(r.text)
        spelt[r.conv_id, r.nth] = sha(r.text)
    rows = chat.expand(turns).where("segment IS NULL").collect()
    assert {(r.conv_id, r.nth): r.text_sha256 for r in rows} == spelt and len(rows) == len(spelt)
    found = {r.conv_id: r.formatted_chars for r in chat.read_back(turns).collect()}
    rest = len("<|im_start|>user\nleft over<|im_end|>\n")
    assert found[1] == texts[1] + rest
    assert found[3] == texts[3] and found[9] == texts[9]


def test_chat_matches_its_sql(spark, conversation_rows, tmp_path):
    """Control strings, line breaks in roles, nulls, repeats and left-over turns."""
    import duckdb

    from ratiolens.llm.oracle import ORACLES
    from ratiolens.llm.queries import REGISTRY

    table = spark.createDataFrame(conversation_rows, CONVERSATIONS)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')"
    )
    found = REGISTRY["op2_chat"](spark, str(tmp_path))
    want = connection.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES['op2_chat']})")
    assert Counter(map(tuple, found.collect())) == Counter(want.fetchall())


def test_chat_of_nothing(spark):
    assert chat.read_back(chat.transcript(spark.createDataFrame([], CONVERSATIONS))).count() == 0


#: The rules of the base kinds, as regular expressions over the whole text.
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            luhn = sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def base_spans(text):
    return [s for s in pii.find(text) if s[2] in pii.BASE_KINDS]


def test_base_spans_match_the_rules():
    rng = random.Random(6)
    parts = ["@", ".", "a", "B9", "-", "+", " ", "1", "255", "4111 1111 1111 1111", "(", ")", "::", "é"]
    parts += ["10.0.0.1", "x@y.zz", "+49 (0)30 123-4567", "0000", "\n", "%", "256", "://", "iban"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert base_spans(text) == brute_spans(text), repr(text)


def test_added_kinds():
    text = "see https://example.com/a?b=1, Konto: 12345678 IBAN DE89 3704 0044 0532 0130 00 or iban DE00 3704 0044 0532 0130 00"
    kinds = [(text[a:b], k) for a, b, k in pii.find(text)]
    assert ("https://example.com/a?b=1", "url") in kinds
    assert ("12345678", "account") in kinds
    assert ("DE89 3704 0044 0532 0130 00", "account") in kinds
    assert not any(t.startswith("DE00") for t, _ in kinds)


def test_personal_data_of_documents(docs, rows, no_docs):
    found = pii.personal_data(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert pii.personal_data(no_docs).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of today</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div>{open}<h1>Title {n}</h1><p>First   text &amp; more
of {n}.<p>Second <b>bold</b> text<br>with a break.</p>{close}
<section class="comments"><div class="comment"><p>I like it {n}</p></div></section>
<footer>&copy; someone</footer></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"u{k}", PAGE.format(n=k, open="<article>", close="</article>"), "x") for k in range(40)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (None, "u", "<p>broken <b", "x"), rows[0]]
    rows += [(102, "u", PAGE.format(n=7, open='<div class="story">', close="</div>"), "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_pages(pages, spark):
    field = html_text.fit(pages)
    found = {r.page_id: r for r in html_text.extract(field, pages).collect()}
    want = "Title {n}\nFirst text & more of {n}.\nSecond bold text with a break."
    for k in range(40):
        assert found[k].text == want.format(n=k)
        assert found[k].n_chars == len(want.format(n=k))
    assert found[102].text == want.format(n=7)  # no article tag
    assert found[100].text == found[101].text == ""
    none = pages.limit(0)
    assert html_text.extract(html_text.fit(none), none).count() == 0


def made_pages(count: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    out = []
    for n in range(count):
        body = "".join(
            f"<p>{' '.join(rng.choices(words, k=rng.randint(3, 60)))}.</p>" for _ in range(rng.randint(2, 12))
        )
        out.append(PAGE.format(n=n, open="<article>", close=body + "</article>"))
    return out


@pytest.fixture(scope="module")
def trained():
    return html_text.train(html_text.training_pages(made_pages(80, 1), random.Random(1)))


def test_rebuilt_pages_held_out(trained):
    """Pages rebuilt from other texts: at most 1 in 100 blocks wrong, of any kind 1 in 50."""
    rng = random.Random(2)
    pages = [html_text.labelled(p) for p in made_pages(60, 3)]
    texts = [b.text for p in pages for b in p if b.label]
    held = [html_text.rebuilt(p, texts, rng) for p in pages for _ in range(3)]
    wrong, blocks = Counter(), Counter()
    for page in held:
        for label, block in zip(trained.decode(page), page, strict=True):
            kind = block.label, block.path[-1][0]
            blocks[kind] += 1
            wrong[kind] += label != block.label
    assert sum(wrong.values()) <= 0.01 * sum(blocks.values())
    for tag in ("li", "td", "th", "dt", "dd", "pre", "code", "blockquote", "figcaption"):
        assert blocks[1, tag] >= 20 and wrong[1, tag] <= 0.02 * blocks[1, tag]


SHAPES = {
    "items": ("<ul>" + "".join(f"<li>w{k} w{k + 1}</li>" for k in range(30)) + "</ul>", [f"w{k} w{k + 1}" for k in range(30)]),
    "kinds": (
        "<p>Some text.</p><pre>code  one</pre><table><tr><th>a</th><td>12</td></tr></table>"
        "<blockquote>said so</blockquote><figure><img src=x><figcaption>a view</figcaption></figure>"
        "<dl><dt>term</dt><dd>its sense.</dd></dl>",
        ["Some text.", "code one", "a", "12", "said so", "a view", "term", "its sense."],
    ),
    "long": ("".join(f"<p>w{k} is said at some length.</p>" for k in range(300)), [f"w{k} is said at some length." for k in range(300)]),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("wrap", ["article", "main", 'div class="story"'])
def test_articles_of_every_shape_stay_whole(trained, shape, wrap):
    body, blocks = SHAPES[shape]
    page = PAGE.format(n=4, open=f"<{wrap}>", close=body + f"</{wrap.split()[0]}>")
    want = ["Title 4", "First text & more of 4.", "Second bold text with a break.", *blocks]
    assert html_text.main_text(trained, page) == "\n".join(want)


def test_long_pages_train_in_chains():
    """Chains that know the label before them give the likelihood's own weights."""
    pages = [html_text.labelled(p) for p in made_pages(20, 5)]
    whole = html_text.train(pages)
    short, html_text.CHAIN = html_text.CHAIN, 4
    try:
        cut = html_text.train(pages)
    finally:
        html_text.CHAIN = short
    assert cut.weights.keys() == whole.weights.keys()
    assert all(whole.decode(p) == cut.decode(p) == [b.label for b in p] for p in pages)


def test_pages_that_mark_no_article_train_too(spark):
    rows = [(k, "u", p.replace("article", "div")) for k, p in enumerate(made_pages(30, 6))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    field = html_text.fit(pages)
    assert len(field.weights) > 20
    texts = [r.text for r in html_text.extract(field, pages).collect()]
    assert all(t.startswith("Title") and "cookies" not in t and "I like" not in t for t in texts)
    blank = pages.limit(2).withColumn("html", pages.url.substr(5, 1))
    assert [r.text for r in html_text.extract(html_text.fit(blank), blank).collect()] == ["", ""]


def test_training_sample_is_bounded(spark):
    rows = [(None, "u", made_pages(1, 1)[0])] * 300 + [(k, "u", p) for k, p in enumerate(made_pages(150, 7))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_text.sample_pages(pages, "page_id", "html")
    assert len(found) == html_text.TRAIN_PAGES == len(set(found))


def test_viterbi_finds_the_best_chain():
    rng = random.Random(2)
    for _ in range(50):
        field = html_text.Field({}, ((rng.gauss(0, 1), rng.gauss(0, 1)),) * 2, (0.3, -0.2))
        n = rng.randint(1, 7)
        scores = [rng.gauss(0, 1) for _ in range(n)]
        field.scores = lambda blocks, s=scores: s
        best = field.decode([None] * n)

        def total(labels):
            out = field.starts[labels[0]] + scores[0] * labels[0]
            for k in range(1, n):
                out += field.moves[labels[k - 1]][labels[k]] + scores[k] * labels[k]
            return out

        every = [[m >> k & 1 for k in range(n)] for m in range(1 << n)]
        assert total(best) == pytest.approx(max(map(total, every)))


def test_ordinal_regression_learns_grades():
    rng = np.random.default_rng(3)
    x = rng.random((1500, 12)) < 0.3
    latent = x @ np.array([3.0, 2, 1.5, 1, -1, *[0] * 7]) + rng.logistic(size=1500)
    grades = np.digitize(latent, [1, 3, 4.5])
    rows, columns = np.nonzero(x)
    weights, cuts = toxicity.fit_ordinal(rows, columns, grades, 12)
    assert (np.diff(cuts) > 0).all()
    assert weights[0] > weights[2] > weights[7] + 0.5 and weights[4] < -0.3
    above = 1 / (1 + np.exp(-((x @ weights)[:, None] - cuts)))
    assert np.abs(above.mean(axis=0) - [(grades > k).mean() for k in range(3)]).max() < 0.02


@pytest.fixture(scope="module")
def labelled_docs(spark):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ala", "eru", "ino", "osk", "umt", "yre")]
    bad = ["vilezz", "nastik", "grumph", "schlock"]
    rows, labels = [], []
    for k in range(600):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 6)):
                text.insert(rng.randint(0, len(text)), rng.choice(bad) + rng.choice(["", ",", "en"]))
        rows.append((k, " ".join(text), "x", 0.5))
        if k < 400:
            labels.append((k, int(toxic)))
    rows += [(None, None, "x", 0.5), (1000, "", "x", 0.5), rows[4]]
    labels += [(None, 1), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, severity double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(labelled_docs):
    docs, labels = labelled_docs
    model = toxicity.fit(docs, labels)
    found = toxicity.score(model, docs).collect()
    assert len(found) == 603
    held = [r for r in found if r.doc_id is not None and 400 <= r.doc_id < 600]
    caught = [r.toxic for r in held if r.doc_id % 4 == 0]
    wrong = [r.toxic for r in held if r.doc_id % 4]
    assert sum(caught) >= 0.95 * len(caught) and sum(wrong) <= 0.02 * len(wrong)
    assert len(model.cuts) >= 2 and max(r.severity for r in found) > 1.2
    kept = toxicity.clean_rows(model, docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.toxic for r in found)


def test_toxicity_with_few_labels(labelled_docs):
    """Ten toxic labels still find most of the abuse, and clean documents stay clean."""
    docs, labels = labelled_docs
    model = toxicity.fit(docs, labels.where("doc_id < 40"))
    assert 0 < len(model.features) < 60
    held = [r for r in toxicity.score(model, docs).collect() if r.doc_id and 400 <= r.doc_id < 600]
    assert sum(r.toxic for r in held if r.doc_id % 4 == 0) >= 0.8 * 50
    assert not any(r.toxic for r in held if r.doc_id % 4)


def test_toxicity_counts_one_text_per_id(spark, labelled_docs):
    """Rows that share an id do not weigh more, and the model does not depend on their order."""
    docs, labels = labelled_docs
    more = docs.unionByName(docs.where("doc_id < 100")).unionByName(docs.where("doc_id < 100"))
    one, two = toxicity.fit(docs, labels), toxicity.fit(more.repartition(7), labels)
    assert (one.features == two.features).all()
    assert np.allclose(one.weights, two.weights) and np.allclose(one.cuts, two.cuts)


def test_kept_finds_follow_the_number_tried():
    ratios = np.array([40.0, 30.0, 20.0, 12.0, 9.0, 3.0])
    assert toxicity.kept_finds(ratios, 100) > toxicity.kept_finds(ratios, 10**6) >= 2
    assert toxicity.kept_finds(np.array([]), 0) == 0


def test_toxicity_memory_does_not_grow_with_the_texts():
    rng = random.Random(8)
    texts = [" ".join(f"word{rng.randrange(300)}" for _ in range(4_000)).encode() for _ in range(200)]
    features = np.unique(np.concatenate(toxicity.distinct_features(texts[:1])))
    mask = np.zeros(1 << 20, dtype=bool)
    mask[features & np.uint64((1 << 20) - 1)] = True
    model = toxicity.OrdinalModel(features, np.linspace(-1, 1, len(features)), np.zeros(1), mask)
    scores, peak = peak_of(lambda: model.scores(texts))
    assert peak < 64 << 20
    assert scores.tolist() == [model.scores([t])[0] for t in texts]
    assert len(model.scores([])) == 0
    found, peak = peak_of(lambda: toxicity.distinct_features(texts))
    assert peak - sum(f.nbytes for f in found) < 64 << 20
    assert all(np.array_equal(f, toxicity.distinct_features([t])[0]) for f, t in zip(found, texts, strict=True))


def test_toxicity_without_labels(labelled_docs, no_docs):
    docs, labels = labelled_docs
    model = toxicity.fit(docs, labels.where("toxic = 1"))
    assert not any(r.toxic or r.severity for r in toxicity.score(model, docs).collect())
    model = toxicity.fit(docs, labels)
    assert toxicity.score(model, no_docs).count() == 0
