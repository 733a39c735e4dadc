"""Line-first quality rules, in DataFrame functions only.

Each line is judged by punctuation, navigation and boilerplate rules. Failing
lines are removed; a document that loses too large a share of its text is
rejected. Base measures (word, symbol and repetition counts) reject a
document on their own.

Everything is computed inside the row: no shuffle, no join, so neither a hot
source nor copies matter, and an executor's loss repeats its tasks only.

Defined cases: a null text counts as empty; an empty text has no words, fails
the base rule and is rejected; repeated rows are judged alike, each on its
own; an empty table gives an empty result; other columns (nulls included) are
never read and pass through ``judge`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import bind, columns_of, free_name, require, text_of, words_of

SYMBOLS = "#*$%&|<>"
SEPARATORS = r"|»›·•/\\>-"
#: Phrases of page furniture; a short line that holds one is boilerplate.
BOILERPLATE = (
    r"cookie (policy|settings|preferences)|accept (all )?cookies|we use cookies|terms (of|and) (use|service|conditions)"
    r"|privacy policy|all rights reserved|sign (in|up)|log ?in|subscribe|newsletter|click here|read more|learn more"
    r"|enable javascript|share (this|on)|follow us|back to top|skip to (main )?content|add to cart|lorem ipsum"
    r"|page \d+ of \d+|powered by"
)


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are of the line's non-space characters, letters or
    words, as named; a line fails when a share exceeds its bound."""

    max_symbol_share: float = 0.1
    max_separator_words: float = 0.2
    max_caps_share: float = 0.7
    caps_letters: int = 20  # a line with no more letters than this passes the caps rule
    max_shout_words: float = 0.3
    max_adjacent_repeats: float = 0.3
    repeat_words: int = 8
    short_words: int = 3
    boilerplate_words: int = 20
    max_loss: float = 0.5
    min_words: int = 10
    max_repeat_percent: int = 20


def _chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def line_ok(line: Column, r: Rules) -> Column:
    """Whether a line stays. A line without a word always does."""

    def share_of(found: Column, bound: Column, needs: Column) -> Column:
        """Whether ``found > bound``, looked at only where ``needs`` holds."""
        return F.when(needs, found > bound).otherwise(False)

    def judged(w: Column) -> Column:
        n = F.size(w)
        letters = _count(line, r"\p{L}")
        caps = _count(line, r"\p{Lu}")
        separators = F.size(F.filter(w, lambda x: x.rlike(f"^[{SEPARATORS}]+$")))
        shouts = F.size(F.filter(w, lambda x: x.rlike(r"[!?]{2,}$")))
        repeats = F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))
        ended = line.rlike(r"[.!?:;…。！？\"'”’»)\]][\x20\x09-\x0D]*$")
        bad = (
            (_count(line, SYMBOLS) > r.max_symbol_share * _chars(w))
            | share_of(separators, r.max_separator_words * n, line.rlike(f"[{SEPARATORS}]"))
            | share_of(shouts, r.max_shout_words * n, (n >= r.short_words) & line.rlike("[!?]{2}"))
            | share_of(repeats, r.max_adjacent_repeats * n, n >= r.repeat_words)
            | bind(caps, lambda c: share_of(c, r.max_caps_share * letters, c > r.max_caps_share * r.caps_letters))
            | share_of(n, F.lit(0), (n < r.short_words) & ~ended)
            | share_of(n, F.lit(0), (n <= r.boilerplate_words) & F.lower(line).rlike(rf"\b({BOILERPLATE})\b"))
        )
        return (n == 0) | ~bad

    return bind(words_of(line), judged)


def repeated_words(words: Column) -> Column:
    """How many words lie in a 5-word window that occurs at least twice.

    Windows are compared by 64-bit hashes within one text; they are sorted
    only where a hash repeats."""

    def covered(places: Column) -> Column:
        n = F.size(places)
        steps = F.transform(
            places, lambda p, i: F.when(i + 1 < n, F.least(F.lit(5), F.get(places, i + 1) - p)).otherwise(F.lit(5))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(h: Column, bits: Column, ranked: Column) -> Column:
        """Places of the windows whose hash another one shares. ``ranked``
        sorts them by the upper hash bits; neighbours are compared in full."""
        place = lambda e: e.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

        def same(e: Column, other: Column) -> Column:
            near = F.call_function("shiftrightunsigned", e, bits) == F.call_function("shiftrightunsigned", other, bits)
            return F.coalesce(near & (F.get(h, place(e)) == F.get(h, place(other))), F.lit(False))

        twice = F.filter(ranked, lambda e, i: same(e, F.get(ranked, i - 1)) | same(e, F.get(ranked, i + 1)))
        return F.sort_array(F.transform(twice, place))

    def counted(h: Column) -> Column:
        bits = F.length(F.bin(F.size(h)))
        ranked = F.sort_array(
            F.transform(h, lambda x, i: F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits).bitwiseOR(i.cast("long")))
        )
        some = bind(bits, lambda b: bind(bind(ranked, lambda r: places(h, b, r)), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(some)

    def windows(h: Column) -> Column:
        """Hashes of five neighbouring words from hashes of two and four."""
        joined = lambda a, b, k: F.zip_with(a, F.slice(b, k + 1, F.size(b)), lambda x, y: F.xxhash64(x, y))
        five = bind(joined(h, h, 1), lambda two: bind(joined(two, two, 2), lambda four: joined(four, h, 4)))
        return bind(F.slice(five, F.lit(1), F.size(h) - 4), counted)

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) < 5, F.lit(0).cast("long")).otherwise(bind(hashes, windows))


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` plus ``quality``: the struct of base measures, the cleaned
    text, the share of text lost and the verdicts ``base_failed``, ``kept``."""
    require(docs, [text])
    t, w, out = (free_name(docs, n) for n in ("_text", "_words", "quality"))
    split = columns_of(docs, **{t: text_of(docs[text]), w: words_of(text_of(docs[text]))})
    body, words = F.col(t), F.col(w)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = columns_of(
        split,
        **{
            out: F.struct(
                F.size(words).cast("long").alias("n_words"),
                _chars(words).alias("word_chars"),
                _count(body, SYMBOLS).alias("n_symbols"),
                bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
                repeated_words(words).alias("n_repeat_words"),
                F.array_join(F.filter(F.split(body, "\n"), lambda x: line_ok(x, rules)), "\n").alias("cleaned"),
            )
        },
    )
    q = F.col(out)
    failed = (q["n_words"] < rules.min_words) | (100 * q["n_repeat_words"] > rules.max_repeat_percent * q["n_words"])
    loss = F.when(q["word_chars"] == 0, F.lit(0.0)).otherwise(1.0 - _chars(words_of(q["cleaned"])) / q["word_chars"])
    scored = measured.withColumn(out, q.withField("base_failed", failed).withField("loss", loss))
    kept = ~F.col(out)["base_failed"] & (F.col(out)["loss"] <= rules.max_loss)
    return scored.withColumn(out, F.col(out).withField("kept", kept)).drop(t, w)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that stay, with failing lines removed; ``n_chars``, if
    there, is counted anew. Columns as in ``docs``."""
    out = free_name(docs, "quality")
    judged = judge(docs, rules).where(F.col(out)["kept"])
    new = {"text": F.when(F.col("text").isNotNull(), F.col(out)["cleaned"])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return judged.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
