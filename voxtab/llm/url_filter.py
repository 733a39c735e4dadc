"""URL filters: listed host and path rules, then association rules mined from
labelled URLs. DataFrame functions only.

A URL becomes a set of tokens (scheme, host and its domain levels, path
segments with digits generalised, file suffix, query keys, fragment). Spark's
FP-growth mines frequent token sets of labelled URLs together with their
label; sets of any length that contain a label give rules "tokens -> verdict".
Tokens that occur in exactly the same labelled URLs (the parts of a template)
are mined as one: a set with two of them says no more than with one of them,
and the redundancy rule would drop it. A rule then holds for any of the tokens
that its items stand for.
Rules stay if confidence and support are high enough and no shorter rule with
the same verdict and at least the same confidence covers them. Matching uses an
inverted index: each rule is posted under its rarest token; a URL's tokens
meet the postings in an equi-join and the rule's other tokens are checked on
the spot. Of the matching rules the most confident decides, then the one with
more support, then the longer, then the first by its tokens.

Verdicts depend on the URL alone, so each distinct URL is matched once, after
a map-side reduction; pages meet the verdicts by URL in an equi-join that AQE
may split, and by broadcast only if Spark finds the rules small. ``min_support``
bounds the rules: a URL whose tokens stand for n different sets of labelled
URLs holds at most 2^n sets, each frequent one takes a ``min_support`` share
of the labelled URLs. ``min_lift`` and
``max_tokens`` cut further where a caller asks for it; by default they do not.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and no rule; its other tokens still count. URLs of any length are read whole.
Repeated rows get the same verdict. Without labels, or without a rule that
fits, the verdict is ``allow``. An empty table gives an empty result; other
columns pass through ``judge``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import ascii_lower, bind, columns_of, free_name, materialise, require

#: (verdict, host, path) as listed; a rule's string is host + path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
_LABEL = "label="


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, or null;
    among equally long ones the longer host, then the smaller text, wins."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    kind = "struct<rule:string,verdict:string>"
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in ranked
    ]
    return F.coalesce(*fits, F.lit(None).cast(kind)) if fits else F.lit(None).cast(kind)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, digits generalised to 0."""
    u = F.coalesce(url, F.lit(""))
    general = lambda c: F.regexp_replace(c, r"[0-9]+", "0")
    levels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(levels)), lambda i: F.array_join(F.slice(levels, -i, i), "."))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    parts = [
        F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(u, r"(?s)^(.*?)://", 1)))),
        F.transform(F.filter(domains, lambda d: d != ""), lambda d: F.concat(F.lit("host="), d)),
        F.transform(segments, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), general(F.lower(s)))),
        F.array(F.concat(F.lit("suffix="), F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)))),
        F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("query="), general(F.lower(q)))),
        F.array(F.concat(F.lit("fragment="), general(F.lower(F.regexp_extract(u, r"(?s)#(.*)$", 1))))),
    ]
    return F.filter(F.array_distinct(F.concat(*parts)), lambda t: ~t.endswith("="))


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """(url, host, path, tokens) of each row of ``urls``."""
    named = columns_of(urls.select(F.col(url).alias("url")), host=host_of(F.col("url")), path=path_of(F.col("url")))
    return columns_of(named, tokens=tokens_of(F.col("url"), F.col("host"), F.col("path")))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = 0.0, max_tokens: int | None = None
) -> DataFrame:
    """``labelled`` (tokens, verdict) -> rules (items, n_items, rarest,
    verdict, confidence, support)."""
    some = labelled.where("tokens IS NOT NULL AND verdict IS NOT NULL")
    baskets = some.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    n = baskets.count()
    schema = "items array<string>, n_items int, rarest string, verdict string, confidence double, support double"
    if not n:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = model.freqItemsets if max_tokens is None else model.freqItemsets.where(F.size("items") <= max_tokens + 1)
    sets = materialise(found, "url-token-sets")
    is_label = lambda x: x.startswith(_LABEL)
    labels = F.filter("items", is_label)
    tokens = F.array_sort(F.filter("items", lambda x: ~is_label(x)))
    split = sets.select(tokens.alias("items"), labels.alias("labels"), "freq")
    both = split.where("size(labels) = 1 AND size(items) > 0")
    alone = split.where("size(labels) = 0").select("items", F.col("freq").alias("n_tokens"))
    base = split.where("size(labels) = 1 AND size(items) = 0").select("labels", F.col("freq").alias("n_label"))
    single = alone.where("size(items) = 1").select(F.col("items")[0].alias("rarest"), F.col("n_tokens").alias("n_rarest"))
    rules = (
        both.join(alone, "items")
        .join(base, "labels")
        .withColumn("confidence", F.col("freq") / F.col("n_tokens"))
        .where(F.col("confidence") >= min_confidence)
        .where(F.col("confidence") * n >= min_lift * F.col("n_label"))
        .select(
            "items",
            F.size("items").alias("n_items"),
            F.substring(F.col("labels")[0], len(_LABEL) + 1, 1 << 20).alias("verdict"),
            "confidence",
            (F.col("freq") / n).alias("support"),
        )
    )
    rules = materialise(rules, "url-rules")
    # a rule is superfluous if a part of its tokens says the same at least as surely; the surest part of a set is
    # handed on from sets of n tokens to those of n + 1, by way of sets that are too unsure to be rules
    said = both.join(alone, "items").select("items", "labels", (F.col("freq") / F.col("n_tokens")).alias("confidence"))
    said = materialise(said.withColumn("n", F.size("items")), "url-said")
    longest = said.agg(F.max("n")).first()[0] or 0
    best = said.where("n = 1").withColumn("shorter", F.lit(0.0))
    levels = [best]
    for n in range(2, longest + 1):
        below = best.select(F.col("items").alias("part"), "labels", F.greatest("confidence", "shorter").alias("under"))
        parts = said.where(F.col("n") == n).withColumn("part", F.explode(F.transform("items", lambda x: F.array_remove("items", x))))
        best = parts.join(below, ["part", "labels"]).groupBy("items", "labels", "confidence", "n").agg(F.max("under").alias("shorter"))
        best = materialise(best, "url-parts")
        levels.append(best)
    told = F.substring(F.col("labels")[0], len(_LABEL) + 1, 1 << 20).alias("verdict")
    covered = reduce(DataFrame.unionByName, levels).where("shorter >= confidence").select("items", told)
    token = rules.join(covered, ["items", "verdict"], "left_anti").withColumn("rarest", F.explode("items"))
    place = F.struct("n_rarest", "rarest")
    first = token.join(single, "rarest").groupBy("items", "n_items", "verdict", "confidence", "support").agg(F.min(place).alias("at"))
    return materialise(first.select("items", "n_items", F.col("at.rarest").alias("rarest"), "verdict", "confidence", "support"), "url-index")


def twins(urls: DataFrame) -> DataFrame:
    """Distinct ``urls`` (url, tokens) -> (token, members) for classes of two
    or more tokens that occur in the same URLs; ``token`` is the
    first of them and stands for all. Sets of URLs are compared by their size
    and two independent 64-bit hash sums. A class is no larger than any URL
    that holds it."""
    each = urls.select(F.explode("tokens").alias("token"), F.xxhash64("url").alias("a"), F.xxhash64(F.lit("second"), "url").alias("b"))
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("a", "b")]
    seen = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *sums)
    alike = seen.groupBy("n", "a", "b").agg(F.array_sort(F.collect_set("token")).alias("members"))
    return alike.where(F.size("members") > 1).select(F.col("members")[0].alias("token"), "members")


def merged(urls: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct ``urls`` (url, tokens) with the tokens of a class as one."""
    stands = classes.select(F.explode("members").alias("member"), F.col("token").alias("_stands"))
    each = urls.select("url", F.explode_outer("tokens").alias("member")).join(stands, "member", "left")
    return each.groupBy("url").agg(F.array_sort(F.collect_set(F.coalesce("_stands", "member"))).alias("tokens"))


def spelled(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """``rules`` with ``choices``: for each item the tokens it stands for, and
    a row for each of those of the rarest item."""
    key = ["items", "verdict"]
    alone = F.array(F.col("item"))
    item = rules.select(*key, F.explode("items").alias("item")).join(classes.withColumnRenamed("token", "item"), "item", "left")
    choices = item.groupBy(*key).agg(F.array_sort(F.collect_set(F.coalesce("members", alone))).alias("choices"))
    posted = rules.join(choices, key).join(classes.withColumnRenamed("token", "rarest"), "rarest", "left")
    return posted.withColumn("rarest", F.explode(F.coalesce("members", F.array("rarest")))).drop("members")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``urls`` (url, tokens) -> (url, mined): the verdict, tokens,
    confidence and support of the deciding rule, for URLs that a rule fits."""
    asked = urls.withColumn("rarest", F.explode("tokens"))
    hits = asked.join(rules, "rarest").where(F.forall("choices", lambda c: F.arrays_overlap(c, "tokens")))
    own = F.array_sort(F.transform("choices", lambda c: F.array_min(F.array_intersect(c, F.col("tokens")))))
    order = F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (-F.col("n_items")).alias("n"), own.alias("items"), "verdict"
    )
    best = hits.groupBy("url").agg(F.min(order).alias("best"))
    mined = F.struct("best.verdict", "best.items", (-F.col("best.c")).alias("confidence"), (-F.col("best.s")).alias("support"))
    return best.select("url", mined.alias("mined"))


def judge(
    pages: DataFrame, labelled: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, **limits: float
) -> DataFrame:
    """``pages`` plus ``filter``: struct of host, path, listed rule, verdict
    and the mined rule. ``labelled``: (url, verdict) examples."""
    require(pages, [url])
    examples = parsed(labelled.select("url", "verdict").where("url IS NOT NULL").select("url").distinct())
    examples = materialise(examples.select("url", "tokens"), "url-examples")
    classes = materialise(twins(examples), "url-twins")
    known = labelled.select("url", "verdict").join(merged(examples, classes), "url")
    index = materialise(spelled(mine(known, **limits), classes), "url-postings")
    found = match(parsed(pages.select(url).distinct(), url).where("url IS NOT NULL"), index)
    u, m, out = free_name(pages, "_url"), free_name(pages, "_mined"), free_name(pages, "filter")
    joined = pages.join(found.select(F.col("url").alias(u), F.col("mined").alias(m)), pages[url] == F.col(u), "left")
    h, p, r = (free_name(pages, x) for x in ("_host", "_path", "_rule"))
    named = columns_of(joined, **{h: host_of(F.col(url)), p: path_of(F.col(url))})
    ruled = columns_of(named, **{r: listed(F.col(h), F.col(p), rules)})
    verdict = F.coalesce(F.col(r)["verdict"], F.col(m)["verdict"], F.lit("allow"))
    judged = F.struct(F.col(h).alias("host"), F.col(p).alias("path"), F.col(r)["rule"].alias("rule"), verdict.alias("verdict"), F.col(m).alias("mined"))
    return ruled.withColumn(out, judged).drop(u, m, h, p, r)


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, verdict) from document labels: a URL's last number in its path is
    its document's id; a document that is toxic or of low quality makes its
    URL ``block``, any other labelled one ``allow``. A URL that several
    documents label takes the stricter verdict."""
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    flags = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    asked = urls.withColumn("doc_id", F.when(number != "", number.cast("long")))
    judged = asked.join(flags, "doc_id").groupBy("url").agg(F.max("bad").alias("bad"))
    return judged.select("url", F.when(F.col("bad"), "block").otherwise("allow").alias("verdict"))
