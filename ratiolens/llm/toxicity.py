"""Severity of toxic language by cumulative-link ordinal regression.

One weight vector over sparse text features is shared by all thresholds:
P(grade > k) = sigmoid(x.w - c_k), with c_1 < c_2 < ...; the expected severity is the
sum of these chances. Features are the words of a text and their leading bytes
(languages build abuse from common stems), present or not, hashed to 64 bits. The
model keeps the features that are found with abuse far more often than by chance: as
many of the likeliest as hold an expected share ``BY_CHANCE`` of chance finds. How much
evidence that takes follows from the number of features tried, so few labels with few
features ask for less than many with millions.

Training takes a bounded sample of labelled documents, ``SAMPLE`` of each label at
most, chosen by a hash of the id. Their features are counted in tasks and summed up
before the ``FEATURES`` likeliest reach the driver, and then, per document, which of the
chosen ones it holds. The labels say toxic or not; toxic documents are graded further by
how many of their words are strong evidence (``STEPS``). Scoring is one pass over all
texts without a shuffle.

Defined results: a null or empty text has no features and gets the base chance; a
null id is carried; labels with null id or null label are left out of training; of rows
with one id the least text trains once per label, and all are scored; without labels of both kinds nothing is rejected and severity is 0; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, stage, text_or_empty
from ratiolens.llm.wordhash import Words, mixed, text_parts

SAMPLE = 2_000
FEATURES = 8_192
STEMS = (4, 5, 6, 7, 8, 9)
#: Least labelled documents with a feature, expected share of chance finds among the
#: kept features, and least log-odds of strong evidence.
SEEN, BY_CHANCE, STRONG = 3, 0.1, 2.0
#: Distinct strong words from which a toxic document has grade 2 and 3.
STEPS = (4, 8)
RIDGE = 0.5
REJECT = 0.35


def features_of(texts: list[bytes]) -> tuple[Words, list[np.ndarray]]:
    """Hashes per word: the word itself and each of its stems (0 where it is not longer)."""
    words = Words(texts)
    size = words.end - words.start
    found = [words.words()]
    for stem in STEMS:
        short = np.minimum(words.start + stem, words.end)
        value = mixed(words.hashes(words.start, short) + np.uint64(stem))
        found.append(np.where(size > stem, value, np.uint64(0)))
    return words, found


@dataclass
class OrdinalModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    cuts: np.ndarray  # thresholds, ascending
    filter: np.ndarray  # by the hash's low 20 bits: may be a feature

    @classmethod
    def empty(cls) -> OrdinalModel:
        none = np.zeros(0)
        return cls(none.astype(np.uint64), none, none, np.zeros(1 << 20, dtype=bool))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.zeros(0), *map(self._scores, text_parts(texts))])

    def _scores(self, texts: list[bytes]) -> np.ndarray:
        words, found = features_of(texts)
        out = np.zeros(len(texts))
        if not len(self.features):
            return out
        docs, ids = [], []
        for values in found:
            maybe = np.flatnonzero(self.filter[values & np.uint64((1 << 20) - 1)])
            at = np.searchsorted(self.features, values[maybe])
            at[at == len(self.features)] = 0
            hit = self.features[at] == values[maybe]
            docs.append(words.doc[maybe[hit]])
            ids.append(at[hit])
        pairs = np.unique(np.concatenate(docs) * len(self.features) + np.concatenate(ids))
        np.add.at(out, pairs // len(self.features), self.weights[pairs % len(self.features)])
        return out

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ..., one column each."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.cuts[None, :], -40, 40)))


def distinct_features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct features of each text, in order."""
    return [values for part in text_parts(texts) for values in _distinct_features(part)]


def _distinct_features(texts: list[bytes]) -> list[np.ndarray]:
    words, found = features_of(texts)
    out = []
    for k in range(len(texts)):
        part = slice(words.first[k], words.first[k + 1])
        values = np.unique(np.concatenate([x[part] for x in found]))
        out.append(values[values != 0])
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts, and how many toxic ones, hold each feature: one row a slice."""
    for batch in slices(batches, "text", 2 << 20):
        found = distinct_features([(x or "").encode() for x in batch.column("text").to_pylist()])
        toxic = np.repeat(batch.column("toxic").to_numpy(), [len(x) for x in found])
        values, column, seen = np.unique(
            np.concatenate(found), return_inverse=True, return_counts=True
        )
        bad = np.bincount(column, weights=toxic, minlength=len(values)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.array(seen), pa.array(bad)],
            ["feature", "seen", "bad"],
        )


def _chosen(features: np.ndarray):
    """Per text its label and the places of its features among the given, sorted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            lists = []
            for values in distinct_features(
                [(x or "").encode() for x in batch.column("text").to_pylist()]
            ):
                at = np.searchsorted(features, values)
                at[at == len(features)] = 0
                lists.append(at[features[at] == values].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(lists, pa.binary())], ["toxic", "found"]
            )

    return run


def _evidence(bad: int, good: int) -> tuple[str, str]:
    """SQL over a feature's counts: likelihood ratio (G squared) against chance, log-odds."""

    def part(n: str, share: float) -> str:
        return f"if({n} = 0, 0D, {n} * ln({n} / (seen * {share!r}D)))"

    total = bad + good
    ratio = f"2 * ({part('bad', bad / total)} + {part('(seen - bad)', good / total)})"
    odds = (
        f"ln((bad + 0.5D) / ({bad} - bad + 0.5D)) "
        f"- ln((seen - bad + 0.5D) / ({good} - (seen - bad) + 0.5D))"
    )
    return ratio, odds


def kept_finds(evidence: np.ndarray, tried: int) -> int:
    """How many of the descending ratios to keep, at ``BY_CHANCE`` chance finds among them."""
    chance = np.exp(-evidence / 2) / 2  # of a ratio this large, on the side of abuse
    fits = np.flatnonzero(chance <= BY_CHANCE * np.arange(1, len(evidence) + 1) / max(1, tried))
    return int(fits[-1]) + 1 if len(fits) else 0


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int, ridge: float = RIDGE
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood of the grades.

    (rows, columns) are the places of the ones in the feature matrix. Plain gradient
    steps with momentum, scaled by each feature's count.
    """
    top = int(grades.max())
    share = np.array([(grades > k).mean() for k in range(top)])
    cuts = -np.log(share / (1 - share))
    weights = np.zeros(width)
    scale = np.bincount(columns, minlength=width) + ridge
    pace, pace_cuts = np.zeros(width), np.zeros(top)
    low, high = np.arange(top + 1) - 1, np.arange(top + 1)
    for step in range(400):
        score = np.bincount(rows, weights=weights[columns], minlength=len(grades))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
        full = np.hstack([np.ones((len(grades), 1)), above, np.zeros((len(grades), 1))])
        upper, lower = full[np.arange(len(grades)), grades], full[np.arange(len(grades)), grades + 1]
        chance = np.maximum(upper - lower, 1e-12)
        # d log(upper - lower) by the score, and by either threshold
        up, down = upper * (1 - upper), lower * (1 - lower)
        slope = (up - down) / chance
        grad = np.bincount(columns, weights=slope[rows], minlength=width) - ridge * weights
        grad_cuts = np.zeros(top)
        has = grades > 0
        np.add.at(grad_cuts, low[grades[has]], -(up / chance)[has])
        has = grades < top
        np.add.at(grad_cuts, high[grades[has]], (down / chance)[has])
        pace = 0.9 * pace + grad / scale
        pace_cuts = 0.9 * pace_cuts + grad_cuts / len(grades)
        weights = weights + 0.2 * pace
        cuts = np.sort(cuts + 0.2 * pace_cuts)
        cuts = np.maximum.accumulate(cuts + 1e-6 * np.arange(top))
        if step > 50 and np.abs(grad).max() < 1e-3:
            break
    return weights, cuts


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """The model from a bounded sample of labelled documents."""
    ship_package(docs.sparkSession)
    labelled = labels.select(
        F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")
    ).where("label_id IS NOT NULL AND toxic IN (0, 1)")
    order = F.xxhash64("label_id")
    picked = None
    for value in (0, 1):
        some = labelled.where(F.col("toxic") == value).orderBy(order, "label_id").limit(SAMPLE)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 * SAMPLE rows of two numbers
    sample = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text")).join(
        F.broadcast(picked), F.col("id") == F.col("label_id")
    )
    sample = stage(sample.groupBy("label_id", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return OrdinalModel.empty()
    ratio, odds = _evidence(sizes[1], sizes[0])
    counts = (
        sample.select("toxic", "text")
        .mapInArrow(_counted, "feature long, seen long, bad long")
        .groupBy("feature")
        .agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
        .where(f"seen >= {SEEN}")
        .selectExpr("feature", f"{ratio} AS evidence", f"{odds} AS odds")
    )
    counts = stage(counts, "toxic-features")
    found = (
        counts.where("odds > 0")
        .orderBy(F.desc("evidence"), "feature")
        .limit(FEATURES)
        .collect()
    )
    found = found[: kept_finds(np.array([r.evidence for r in found]), counts.count())]
    if not found:
        return OrdinalModel.empty()
    features = np.array([r.feature for r in found], dtype=np.int64).view(np.uint64)
    order = np.argsort(features)
    features, strong = features[order], np.array([r.odds for r in found])[order] > STRONG
    rows = (
        sample.select("toxic", "text")
        .mapInArrow(_chosen(features), "toxic int, found binary")
        .collect()
    )
    rows.sort()
    toxic = np.array([r.toxic for r in rows], dtype=np.int64)
    lists = [np.frombuffer(r.found, "<i4") for r in rows]
    doc, column = np.repeat(np.arange(len(rows)), list(map(len, lists))), np.concatenate(lists)
    hits = np.bincount(doc[strong[column]], minlength=len(toxic))
    grades = toxic * (1 + np.searchsorted(STEPS, hits, side="right"))
    _, grades = np.unique(grades, return_inverse=True)  # grades that occur, without holes
    weights, cuts = fit_ordinal(doc, column, grades, len(features))
    mask = np.zeros(1 << 20, dtype=bool)
    mask[features & np.uint64((1 << 20) - 1)] = True
    return OrdinalModel(features, weights, cuts, mask)


def _score(model: OrdinalModel, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 2 << 20):
            texts = [(x or "").encode() for x in batch.column(text).to_pylist()]
            chances = model.chances(model.scores(texts))
            severity = chances.sum(axis=1) if chances.shape[1] else np.zeros(len(texts))
            first = chances[:, 0] if chances.shape[1] else np.zeros(len(texts))
            names = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(first), pa.array(severity)],
                [*names, "p_toxic", "severity"],
            )

    return run


def score(model: OrdinalModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, p_toxic (any grade above 0), severity (expected grade), toxic (rejected)."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(
        _score(model, "text"), f"doc_id {kind}, p_toxic double, severity double"
    )
    return scored.withColumn("toxic", F.col("p_toxic") >= REJECT).withColumnRenamed("doc_id", id_col)


def clean_rows(model: OrdinalModel, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with the columns they came with."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 2 << 20):
            texts = [(x or "").encode() for x in batch.column(text_col).to_pylist()]
            chances = model.chances(model.scores(texts))
            if chances.shape[1]:
                batch = batch.filter(pa.array(chances[:, 0] < REJECT))
            yield batch

    return docs.mapInArrow(run, docs.schema)
