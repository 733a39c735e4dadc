"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Cell weights start at
the cells' token counts and are raked: scaled in turn so that their sums by
source, by language and by topic meet the targets, until all three agree.
A cell's raked weight over its tokens, scaled to a token budget, is the
expected number of copies of each of its documents. A document gets the whole
part of it, and one more with the chance of the rest, drawn by a hash of its
id; so documents of raised categories repeat, no rate is cut, and the drawn
tokens meet the targets of every source, language and topic.

Only sums per cell are shuffled, reduced in each task first, and the raking
loop works on the table of cells, which is written to the shared checkpoint
folder each round; the loop ends on one number. Documents meet their cell's
probability in an equi-join that AQE may split where a source is hot.

Targets: a mapping from a category to its share per dimension, or a power: a
category's share is then its token share to that power, normalised.
Categories without a given share divide what is left in proportion to their
tokens (nothing is left: they get no weight).

Defined cases: a null source, language or topic is a category of its own; a
null or empty text has no tokens, topic ``empty``, and no copies unless
nothing in the table has tokens (then one each). Documents without id are drawn by the hash
of their text; repeated rows share their draw. An empty table gives an empty
result. Where the targets contradict each other (a share for a category whose
cells are all ruled out), raking ends after ``max_rounds`` with the
last dimension met, and ``miss`` tells the largest gap. Other columns pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import SPACE, columns_of, free_name, materialise, require, text_of

DIMENSIONS = ("source", "lang", "topic")
#: Production targets: sources and topics half way (in logs) towards even shares, languages a quarter.
TARGETS = {"source": 0.5, "lang": 0.75, "topic": 0.5}
BUDGET, SEED = 0.8, 42
#: Topics by the first rule that fits: (topic, strings of which a text holds one).
TOPICS = (
    ("licensed", ("icensed under", "ights reserved", "opyright", "GNU General Public")),
    ("contact", ("@mail", "+1 (")),
    ("credentials", ("token = ", "TOKEN = ", "password")),
    ("tabular", (" | ",)),
    ("markup", ("###", "***", "&&&", "$$$", "%%%")),
)


def topic_of(text: Column, rules: Sequence[tuple[str, Sequence[str]]] = TOPICS) -> Column:
    topic = F.when(F.trim(text) == "", F.lit("empty"))
    for name, strings in rules:
        topic = topic.when(reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in strings]), F.lit(name))
    return topic.otherwise(F.lit("prose"))


def tokens_of(text: Column) -> Column:
    """Words of a text, as its token count."""
    parts = F.size(F.split(text, SPACE + "+"))
    edge = F.when(text.rlike(f"^{SPACE}"), 1).otherwise(0) + F.when(text.rlike(f"{SPACE}$"), 1).otherwise(0)
    return F.when(~text.rlike(f"[^{SPACE[1:-1]}]"), F.lit(0)).otherwise(parts - edge).cast("long")


def _target(cells: DataFrame, dim: str, wanted: float | Mapping[str, float]) -> DataFrame:
    """(dim, target): a share of one for each category."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    if not isinstance(wanted, Mapping):
        raw = F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(float(wanted)))).otherwise(0.0)
        total = sums.select(F.sum(raw)).first()[0]
        return sums.select(dim, (raw / total if total else F.lit(0.0)).alias("target"))
    given = F.coalesce(*[F.when(F.col(dim) == k, F.lit(float(v))) for k, v in wanted.items()], F.lit(None).cast("double"))
    rest = F.lit(max(0.0, 1.0 - sum(wanted.values())))
    open_ = sums.withColumn("given", given)
    total = open_.select(F.sum(F.when(F.col("given").isNull(), F.col("t")))).first()[0]
    return open_.select(dim, F.coalesce("given", rest * F.col("t") / total if total else F.lit(0.0)).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], tolerance: float = 1e-4, stall: int = 10) -> DataFrame:
    """``cells`` (dimensions, tokens) plus ``weight`` (shares that sum to one)
    and ``miss`` (largest gap of a marginal before the last round). Rounds go
    on until the gap is within the ``tolerance``, or has not fallen by a
    thousandth over ``stall`` rounds: then the targets contradict each other,
    and ``miss`` says by how much."""
    dims = list(targets)
    names = {d: free_name(cells, f"_target_{d}") for d in dims}
    now = cells
    for d in dims:  # the targets stand with the cells, so that a round joins each marginal once
        share = _target(cells, d, targets[d]).select(F.col(d).alias("_k"), F.col("target").alias(names[d]))
        now = now.join(share, F.col(d).eqNullSafe(F.col("_k"))).drop("_k")
    now = materialise(now.withColumn("weight", F.col("tokens").cast("double")), "mix-targets")
    tokens = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    gaps: list[float] = []
    while not gaps or (gaps[-1] > tolerance and (len(gaps) <= stall or min(gaps[-stall:]) < 0.999 * min(gaps[:-stall]))):
        now = now.withColumn("miss", F.lit(0.0))
        for d in dims:
            # weights are tokens before the first marginal is met, shares after it
            total = tokens if not gaps and d == dims[0] else 1.0
            have = now.groupBy(F.col(d).alias("_k")).agg(F.sum("weight").alias("have"))
            joined = now.join(have, F.col(d).eqNullSafe(F.col("_k")))
            gap = F.abs(F.col("have") - F.col(names[d]) * total)
            now = joined.select(
                *[c for c in now.columns if c not in ("weight", "miss")],
                (F.col("weight") * F.coalesce(F.try_divide(names[d], "have"), F.lit(0.0))).alias("weight"),
                F.greatest("miss", gap / total if total else F.lit(0.0)).alias("miss"),
            )
        now = materialise(now, "mix-cells")
        gaps.append(now.agg(F.max("miss")).first()[0] or 0.0)
    return now.drop(*names.values())


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` plus ``expected``, the copies of each document: c * weight /
    tokens, with c such that the expected tokens are ``budget`` times all
    tokens; and ``probability``, that a document is drawn at all."""
    tokens, weight = F.col("tokens"), F.col("weight")
    total, raked = cells.agg(F.sum("tokens"), F.sum(F.when(tokens > 0, weight))).first()
    scale = budget * total / raked if total and raked else 0.0
    rate = F.when(tokens > 0, F.lit(float(scale)) * weight / tokens).otherwise(0.0 if total else 1.0)
    return cells.withColumn("expected", rate).withColumn("probability", F.least(F.lit(1.0), "expected"))


def uniform(seed: int) -> Column:
    """A number in [0, 1) for each document, from its id (without one, its text)."""
    h = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), text_of("text"))).otherwise(F.xxhash64(F.lit(seed), F.col("doc_id")))
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    targets: Mapping[str, float | Mapping[str, float]] = TARGETS,
    budget: float = BUDGET,
    seed: int = SEED,
    topics: Sequence[tuple[str, Sequence[str]]] = TOPICS,
) -> DataFrame:
    """``docs`` plus ``mix``: struct of topic, n_tokens, weight (its cell's
    raked share), miss (largest gap of a marginal that raking left), expected (copies), probability (of one at least), draw,
    sampled, and copies drawn."""
    require(docs, ["doc_id", "text", "source", "lang"])
    out, t, n = (free_name(docs, x) for x in ("mix", "_topic", "_tokens"))
    text = text_of("text")
    marked = columns_of(docs, **{t: topic_of(text, topics), n: tokens_of(text)})
    cells = marked.groupBy("source", "lang", F.col(t).alias("topic")).agg(F.sum(n).alias("tokens"))
    cells = probabilities(rake(materialise(cells, "mix-cells"), targets), budget)
    keys = {d: free_name(docs, f"_cell_{d}") for d in DIMENSIONS}
    w, g, e, p = (free_name(docs, x) for x in ("_weight", "_miss", "_expected", "_probability"))
    cell = [F.col("weight").alias(w), F.col("miss").alias(g), F.col("expected").alias(e), F.col("probability").alias(p)]
    side = cells.select(*[F.col(d).alias(k) for d, k in keys.items()], *cell)
    same = [F.col(c).eqNullSafe(F.col(keys[d])) for d, c in zip(DIMENSIONS, ("source", "lang", t), strict=True)]
    joined = marked.join(side, same)
    draw = uniform(seed)
    whole = F.floor(e)
    copies = whole + F.when(draw < F.col(e) - whole, 1).otherwise(0)
    struct = F.struct(
        F.col(t).alias("topic"), F.col(n).alias("n_tokens"), F.col(w).alias("weight"), F.col(g).alias("miss"), F.col(e).alias("expected"), F.col(p).alias("probability"),
        draw.alias("draw"), (draw < F.col(p)).alias("sampled"), copies.cast("long").alias("copies"),
    )
    return joined.withColumn(out, struct).drop(t, n, w, g, e, p, *keys.values())


def sample(docs: DataFrame, **settings) -> DataFrame:
    """The documents drawn, each as often as it has copies, with their own columns."""
    out = free_name(docs, "mix")
    drawn = mix(docs, **settings).where(F.col(out)["copies"] > 0)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(out)["copies"]))
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns], again.alias(free_name(docs, "_copy"))).drop(free_name(docs, "_copy"))
