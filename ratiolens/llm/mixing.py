"""Sampling of documents so that their tokens follow target shares.

Words are counted per cell (source, language, topic). Iterative proportional fitting
rakes the cells' token weights to the target marginals, one marginal at a time, until
``sweeps`` rounds are done; the ratio of fitted to present tokens, scaled, is a
document's chance to stay. The draw is a hash of the id, so that a repeated run takes
the same documents.

The scale is set by ``keep``, the share of all tokens that is to stay: the chances,
cut at 1, keep just that many tokens. Cells short of their part keep every document
and the others make up the size, so the sample's shares come as near to the targets as
they can without repeats.

The topic is a column of ``docs`` where there is one (``topic_col``). Without one it is
learned from the texts: of the words with ``LETTERS`` letters or more, those found in
most documents, but in no more than one of ``COMMON``, name ``TOPICS`` topics, and a
document belongs to the one whose word it says most often. All documents are counted.

Defined results: null source, language or topic form a value of their own, written ''; a
null or empty text has no words, weighs nothing and stays with the chance ``keep``; a text
without any topic's word has the topic 'other', ties go to the more frequent word, then by
its letters; a null id is drawn as the empty string; repeated rows share their draw; marginals without tokens get no
weight; an empty table gives an empty result; other columns are carried, not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratiolens.llm.common import SPACES, stage, text_or_empty

SWEEPS = 8
#: Targets are the present shares to these powers, made to add up to one.
POWERS = {"source": 0.8, "lang": 0.8, "topic": 0.8}
#: Share of all tokens that the sample is to keep.
KEEP = 0.8
TOPICS, LETTERS, COMMON = 12, 6, 10
OTHER = "other"
#: Signs around a word that are not part of it.
AROUND = ".,;:!?()[]\"'"
SEED = "mix-1"
#: Digits of the hexadecimal hash that make up the draw.
DIGITS = 12


def words_in(text: Column) -> Column:
    """The words of a text, by the six characters of white space."""
    even = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(even, " "), lambda w: w != "")


def long_words(words: Column) -> Column:
    """Words that may name a topic: in lower case, without the signs around them."""
    some = F.filter(words, lambda w: F.char_length(w) >= LETTERS)
    bare = F.transform(some, lambda w: F.btrim(F.lower(w), F.lit(AROUND)))
    return F.filter(bare, lambda w: F.char_length(w) >= LETTERS)


def topic_words(described: DataFrame) -> list[str]:
    """The words that name topics, of a table with the column ``long``; most frequent first."""
    documents = described.count()
    found = (
        described.select(F.explode(F.array_distinct("long")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") * COMMON <= documents)
        .orderBy(F.desc("n"), "word")
        .limit(TOPICS)
    )
    return [r.word for r in found.collect()]


def with_topic(described: DataFrame, topics: list[str]) -> DataFrame:
    """``described`` with the topic whose word is said most often, in place of ``long``."""

    def said(place: int, topic: str) -> Column:
        times = F.size(F.filter("hits", lambda w: w == topic))
        return F.struct(times.alias("times"), F.lit(-place).alias("place"), F.lit(topic).alias("topic"))

    if not topics:
        return described.withColumn("topic", F.lit(OTHER)).drop("long")
    best = F.array_max(F.array(*[said(k, t) for k, t in enumerate(topics)]))
    return (
        described.withColumn("hits", F.filter("long", lambda w: w.isin(topics)))
        .withColumn("best", best)
        .withColumn("topic", F.when(F.col("best.times") > 0, F.col("best.topic")).otherwise(OTHER))
        .drop("long", "hits", "best")
    )


def cells(described: DataFrame) -> DataFrame:
    return described.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))


def rake(
    counted: DataFrame, targets: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS
) -> DataFrame:
    """Cells with ``weight``, their fitted share of all tokens.

    ``targets`` holds per marginal a table (value, share); a missing one is the present
    share to its power in ``POWERS``.
    """
    total = float(counted.agg(F.sum("tokens")).first()[0] or 0)
    fitted = counted.where("tokens > 0").withColumn("all_tokens", F.lit(total))
    fitted = fitted.withColumn("weight", F.col("tokens") / F.col("all_tokens"))
    for name, power in POWERS.items():
        given = (targets or {}).get(name)
        if given is None:
            shares = fitted.groupBy(name).agg(F.pow(F.sum("weight"), F.lit(power)).alias("raw"))
        else:
            shares = given.select(F.col("value").alias(name), F.col("share").alias("raw"))
            shares = shares.join(fitted.select(name).distinct(), name, "left_semi")
        norm = shares.agg(F.sum("raw")).first()[0] or 1.0
        shares = shares.select(name, (F.col("raw") / F.lit(float(norm))).alias(f"to_{name}"))
        fitted = fitted.join(shares, name, "left").fillna({f"to_{name}": 0.0})
    fitted = stage(fitted, "mix-cells")
    for sweep in range(sweeps):
        for name in POWERS:
            now = F.sum("weight").over(Window.partitionBy(name))
            fitted = fitted.withColumn(
                "weight",
                F.when(now > 0, F.col("weight") * F.col(f"to_{name}") / now).otherwise(0.0),
            )
        if sweep % 2:
            fitted = stage(fitted, "mix-cells")
    return fitted.select("source", "lang", "topic", "tokens", "all_tokens", "weight")


def scale(raked: DataFrame, keep: float) -> float:
    """The factor by which the ratios, cut at 1, keep ``keep`` of all tokens."""
    fitted = F.col("weight") * F.col("all_tokens")
    factor, before = keep, -1.0
    while True:
        # cells that give all they have; each round can only find more of them
        full = F.col("weight") > 0
        full = full & (F.lit(factor) * fitted >= F.col("tokens"))
        sums = raked.agg(
            F.max("all_tokens").alias("all"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(fitted)).alias("rest"),
        ).first()
        if sums["all"] is None or sums["rest"] <= 0 or sums["full"] <= before:
            return factor
        factor = max(factor, (keep * sums["all"] - sums["full"]) / sums["rest"])
        before = sums["full"]


def chances(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """Cells with the chance of a document to stay."""
    ratio = F.col("weight") * F.col("all_tokens") / F.col("tokens")
    chance = F.least(F.lit(1.0), ratio * F.lit(scale(raked, keep)))
    return raked.select(
        F.col("source").alias("c_source"),
        F.col("lang").alias("c_lang"),
        F.col("topic").alias("c_topic"),
        F.round(chance, 9).alias("chance"),
    )


def draw(key: Column, seed: str = SEED) -> Column:
    """A fixed number in [0, 1) for a document."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return digits / F.lit(float(16**DIGITS))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    targets: dict[str, DataFrame] | None = None,
    sweeps: int = SWEEPS,
    keep_rows: bool = False,
    keep: float = KEEP,
    topic_col: str = "topic",
) -> DataFrame:
    """Per document: id, source, lang, topic, tokens, chance, sampled.

    ``keep`` is the share of all tokens to stay. With ``keep_rows`` the result is the
    sampled rows of ``docs`` as they came.
    """
    text = text_or_empty(text_col)
    source, lang = (text_or_empty(c) if c in docs.columns else F.lit("") for c in ("source", "lang"))
    given = topic_col in docs.columns

    def read(*more: Column) -> DataFrame:
        """What the raking reads of a document: id, marginals, words; without a topic, long words."""
        topic = [text_or_empty(topic_col).alias("topic")] * given
        columns = [F.col(f"`{id_col}`").alias("doc_id"), source.alias("source"), lang.alias("lang")]
        rows = docs.select(*columns, *topic, words_in(text).alias("words"), *more)
        if not given:
            rows = rows.withColumn("long", long_words(F.col("words")))
        return rows.withColumn("tokens", F.size("words").cast("long")).drop("words")

    described = stage(read(), "mix-documents")
    topics = [] if given else topic_words(described)
    if not given:
        described = stage(with_topic(described, topics), "mix-topics")
    counted = stage(cells(described), "mix-cells")
    shares = stage(chances(rake(counted, targets, sweeps), keep), "mix-chances")
    same = reduce(
        lambda a, b: a & b, (F.col(n) == F.col(f"c_{n}") for n in ("source", "lang", "topic"))
    )
    if keep_rows:
        described = read(F.struct("*").alias("row"))
        described = described if given else with_topic(described, topics)
    drawn = described.join(shares, same, "left").withColumn(
        "chance",
        F.when(F.col("tokens") > 0, F.col("chance")).otherwise(F.lit(float(keep))),
    )
    drawn = drawn.withColumn("sampled", draw(F.col("doc_id")) < F.col("chance"))
    if keep_rows:
        return drawn.where("sampled").select("row.*")
    return drawn.select(
        F.col("doc_id").alias(id_col), "source", "lang", "topic", "tokens", "chance", "sampled"
    )
