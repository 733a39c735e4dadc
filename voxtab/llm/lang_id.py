"""Language identification, word first with backoff to character n-grams.

A known word votes with its log frequency in each language. An unseen word
falls back to its longest character n-grams that the model knows (word ends
marked), then to shorter ones; a word without any known n-gram does not vote.
The language with the largest sum wins.

``fit`` learns from a bounded sample: at most ``fit_rows`` different texts per
language, those with the smallest hashes of the text; copies count once. Its
whole vocabulary makes the broadcast model. Prediction reads every row where it lies: no shuffle, and a worker
keeps at most ``CACHE_WORDS`` looked-up words.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
If no word of a text votes, or on a tie, the language with more training rows
wins, then the smaller name. Without any labelled row everything is ``und``.
Rows with a null language never train; null ids count as empty text for the
hash; repeated rows are predicted alike; an empty table gives an empty
result; other columns pass through, but ``lang_pred`` and ``score`` are
replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.llm.common import add_columns, materialise

FIT_ROWS = 500
#: Lengths of n-grams, longest first.
GRAMS = (5, 4, 3, 2, 1)
CACHE_WORDS = 300_000
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Table:
    """Log frequencies: a row of ``votes`` for each token."""

    row: dict[str, int]
    votes: np.ndarray


@dataclass
class Model:
    langs: list[str]
    prior: list[int]
    words: Table
    grams: Table


def sample(docs: DataFrame, lang: str, text: str, counts: dict[str, int], fit_rows: int) -> DataFrame:
    """``fit_rows`` different texts of each language at most, by the smallest
    hash; ``counts``, the rows of each language, tells how small a hash must
    be to come into question, so that few rows are shuffled."""
    share = F.create_map(*[F.lit(x) for code, n in counts.items() for x in (code, 4 * fit_rows / n)])
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / float(1 << 30)
    some = docs.where(F.col(text).isNotNull() & (place < share[F.col(lang)])).select(lang, text).dropDuplicates([lang, text])
    least = Window.partitionBy(lang).orderBy(place, text)
    return some.withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= fit_rows).select(lang, text)


def _count_words(lang: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tally: dict[str, Counter] = {}
            for code, t in zip(b[lang].to_pylist(), b[text].to_pylist(), strict=True):
                tally.setdefault(code, Counter()).update(WORD.findall(t.lower()))
            flat = [(code, w, n) for code, c in tally.items() for w, n in c.items()]
            yield pa.RecordBatch.from_pydict(
                {"lang": [x[0] for x in flat], "token": [x[1] for x in flat], "n": [x[2] for x in flat]},
                schema=pa.schema({"lang": pa.string(), "token": pa.string(), "n": pa.int64()}),
            )

    return run


def _grams(words: DataFrame) -> DataFrame:
    """N-grams of the distinct words, each as often as its word occurs."""
    marked = F.concat(F.lit("<"), "token", F.lit(">"))
    size = F.length(marked)

    def cuts(k: int) -> Column:
        places = F.when(size >= k, F.sequence(F.lit(1), size - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: marked.substr(i, F.lit(k)))

    # single letters come from the bare word: the marks alone say nothing
    cut = F.concat(F.split("token", ""), *[cuts(k) for k in GRAMS if k > 1])
    return words.select("lang", "n", F.explode(cut).alias("token")).groupBy("lang", "token").agg(F.sum("n").alias("n"))


def _table(counts: DataFrame, langs: list[str], by_length: bool) -> Table:
    """The tokens with their log frequency in each language, add-half
    smoothed."""
    names = [f"n{i}" for i in range(len(langs))]
    wide = counts.groupBy("token").agg(
        *[F.sum(F.when(F.col("lang") == code, F.col("n")).otherwise(0)).alias(c) for code, c in zip(langs, names, strict=True)]
    )
    group = F.length("token") if by_length else F.lit(0)
    sums = wide.groupBy(group.alias("size")).agg(F.array(*[F.sum(c) for c in names]).alias("all")).collect()
    totals = {r["size"]: np.array(r["all"], float) for r in sums}
    top = wide.orderBy("token").toPandas()
    seen = top[names].to_numpy(float)
    tokens = top["token"].tolist()
    base = np.array([totals[len(t) if by_length else 0] for t in tokens]).reshape(len(tokens), len(langs))
    return Table({t: i for i, t in enumerate(tokens)}, np.log(seen + 0.5) - np.log(base + 0.5))


def fit(
    docs: DataFrame, lang: str = "lang", text: str = "text", fit_rows: int = FIT_ROWS
) -> Model:
    """Learns from the rows given; leave held-out rows out of ``docs``."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(lang).count().collect()
    prior = sorted(((r["count"], r[lang]) for r in rows), key=lambda x: (-x[0], x[1]))
    if not prior:
        return Model([], [], Table({}, np.zeros((0, 0))), Table({}, np.zeros((0, 0))))
    langs = [code for _, code in prior]
    picked = sample(docs, lang, text, {code: n for n, code in prior}, fit_rows)
    words = materialise(
        picked.mapInArrow(_count_words(lang, text), "lang string, token string, n long")
        .groupBy("lang", "token")
        .agg(F.sum("n").alias("n")),
        "lang-words",
    )
    return Model(langs, [n for n, _ in prior], _table(words, langs, False), _table(_grams(words), langs, True))


def scorer(model: Model):
    """A function from a text to (language, score)."""
    known: dict[str, int] = {}
    rows = np.zeros((1024, len(model.langs)))

    def votes(word: str) -> np.ndarray | float:
        found = model.words.row.get(word)
        if found is not None:
            return model.words.votes[found]
        marked = f"<{word}>"
        for k in GRAMS:
            text = marked if k > 1 else word
            hits = [g for i in range(len(text) - k + 1) if (g := model.grams.row.get(text[i : i + k])) is not None]
            if hits:
                return model.grams.votes[hits].mean(axis=0)
        return 0.0

    def place(word: str) -> int:
        nonlocal rows
        at = known.get(word)
        if at is None:
            at = known[word] = len(known)
            if at == len(rows):
                rows = np.concatenate([rows, np.zeros_like(rows)])
            rows[at] = votes(word)
        return at

    def score(text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not model.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        total = np.zeros(len(model.langs))
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            if len(known) > CACHE_WORDS:
                known.clear()
            total += rows_of(part)
        if not total.any():
            return model.langs[0], model.prior[0] / sum(model.prior)
        best = int(np.argmax(total))  # languages stand in order of their training rows
        return model.langs[best], float(1.0 / np.exp(total - total[best]).sum())

    def rows_of(words: list[str]) -> np.ndarray:
        at = np.fromiter(map(place, words), np.int64, len(words))
        return rows[at].sum(axis=0)

    return score


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (the winner's posterior
    under equal priors)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        one = scorer(shared.value)

        def run(texts: pa.Array) -> list[pa.Array]:
            found = [one(t.as_py()) for t in texts]
            return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

        return run

    return add_columns(docs, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], start)
