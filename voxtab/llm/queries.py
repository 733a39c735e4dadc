"""The registered queries of this subpackage: thin forms of the operators
over the whole tables, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from voxtab.llm import bpe, exact_dedup, lang_id, license_scan, minhash_dedup, mixing, pii, quality_rules, ranked_search, simhash_dedup, spelling, toxicity, url_filter
from voxtab.llm.common import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash_dedup.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(crc_mod("doc_id", 3) != 1))
    return toxicity.score(docs, model).select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence",
    )


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    judged = url_filter.judge(pages, url_filter.labelled_urls(pages, labels))
    return judged.select("page_id", *[f"filter.{n}" for n in ("host", "path", "rule", "verdict", "mined")])


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] | list[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, n_tokens, ids_sha256 and decoded_sha256 of an
    encode-decode round trip over doc_id and text."""
    vocabulary = bpe.Vocabulary.load(path)
    tokens = bpe.round_trip(docs.select("doc_id", "text"), vocabulary)
    return tokens.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    names = ("topic", "n_tokens", "weight", "miss", "expected", "probability", "draw", "sampled", "copies")
    return mixing.mix(docs).select("doc_id", "source", "lang", *[f"mix.{n}" for n in names])


@query(
    "op6_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.dedup_table(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


_OP7_SQL = r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
    w AS (SELECT doc_id, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda e: e <> '') AS w FROM t),
    windows AS (
      SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, five) AS times
      FROM (SELECT doc_id, p, list_slice(w, p, p + 4) AS five FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM w))
    ),
    covered AS (
      SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + 5)) AS at FROM windows WHERE times > 1) GROUP BY doc_id
    ),
    parts AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS l FROM t),
    lines AS (SELECT doc_id, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda e: e <> '') AS lw FROM parts),
    told AS (
      SELECT doc_id, l, lw, len(lw) AS n, length(array_to_string(lw, '')) AS chars,
             length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) AS symbols,
             len(list_filter(lw, lambda e: regexp_full_match(e, '[|»›·•/\\>-]+'))) AS separators,
             len(list_filter(lw, lambda e: regexp_matches(e, '[!?]{2,}$'))) AS shouts,
             len(list_filter(range(2, len(lw) + 1), lambda i: lw[i] = lw[i - 1])) AS repeats,
             length(regexp_replace(l, '[^\p{Lu}]+', '', 'g')) AS caps, length(regexp_replace(l, '[^\p{L}]+', '', 'g')) AS letters,
             regexp_matches(l, '[.!?:;…。！？"''”’»)\]][\x20\x09-\x0D]*$') AS ended,
             regexp_matches(lower(l), '\b(BOILERPLATE)\b') AS boiler
      FROM lines
    ),
    judged AS (
      SELECT doc_id, l, n, chars, n = 0 OR NOT (
        symbols > CAST(0.1 AS DOUBLE) * chars OR separators > CAST(0.2 AS DOUBLE) * n OR (n >= 3 AND shouts > CAST(0.3 AS DOUBLE) * n)
        OR (n >= 8 AND repeats > CAST(0.3 AS DOUBLE) * n)
        OR (caps > CAST(0.7 AS DOUBLE) * 20 AND caps > CAST(0.7 AS DOUBLE) * letters) OR (n < 3 AND NOT ended) OR (n <= 20 AND boiler)
      ) AS ok FROM told
    ),
    docs AS (
      SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
             coalesce(sum(chars) FILTER (ok), 0) AS left_chars
      FROM judged GROUP BY doc_id
    ),
    base AS (
      SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words, left_chars
      FROM w JOIN docs USING (doc_id) LEFT JOIN covered USING (doc_id)
    ),
    failed AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             CASE WHEN word_chars = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - left_chars::DOUBLE / word_chars::DOUBLE END AS loss
      FROM base
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND loss <= 0.5 AS kept, loss FROM failed
""".replace("BOILERPLATE", quality_rules.BOILERPLATE)


@query("op7_quality_rules", _OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "loss")
    return quality_rules.judge(docs).select("doc_id", *[f"quality.{n}" for n in names])


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_lang_id")
def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 4) == 2
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return license_scan.scan(docs).select("doc_id", *[f"license.{n}" for n in names])


@query(
    "op11_minhash_dedup",
    r"""
    WITH RECURSIVE t AS (
      SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda e: e <> '') AS w
      FROM documents
    ),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS g FROM t
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (
      SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
    ),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
    SELECT t.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(t.doc_id, coalesce(min(reach.b), t.doc_id)) AS component_id,
           t.doc_id = least(t.doc_id, coalesce(min(reach.b), t.doc_id)) AS kept
    FROM t LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = t.doc_id GROUP BY t.doc_id
    """,
)
def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.components(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)


_OP12_SQL = r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
    ),
    q AS (
      SELECT item_id, t, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
      ) GROUP BY ALL
    ),
    total AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS len FROM d WHERE len(w) > 0),
    p AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY ALL),
    df AS (SELECT t, count(*)::BIGINT AS df FROM p GROUP BY t),
    weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
    size AS (SELECT doc_id, 100 - 75 + (75 * len(w)::BIGINT * docs) // total.len AS m FROM d, total),
    scored AS (
      SELECT item_id, p.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN p USING (t) JOIN weight USING (t) JOIN size ON size.doc_id = p.doc_id GROUP BY ALL
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op12_ranked_search", _OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_OP13_SQL = r"""
    WITH RECURSIVE bits AS (
      SELECT i, i AS c, 0 AS k FROM range(256) r(i) UNION ALL
      SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
    ),
    crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    runs AS (
      SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS r FROM documents
    ),
    times AS (SELECT doc_id, r, count(*) AS n FROM runs WHERE length(r) >= 7 GROUP BY ALL),
    bytes AS (
      SELECT doc_id, r, n, list_transform(range(1, octet_length(encode(doc_id || ':' || r)) + 1),
        lambda i: ('0x' || substr(hex(encode(doc_id || ':' || r)), 2 * i - 1, 2))::BIGINT) AS b FROM times
    ),
    hashed AS (
      SELECT doc_id, r, n, xor(list_reduce(list_prepend(4294967295, b),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc
    ),
    spelt AS (
      SELECT n, CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::BIGINT) || substr(r, (h % length(r))::BIGINT + 2) ELSE r END AS word FROM hashed
    ),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS c FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
      SELECT DISTINCT a.word AS w, b.word AS v, b.n FROM cuts a JOIN cuts b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.c = b.word
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.c = b.word
    ),
    told AS (
      SELECT word, words.n, count(v) AS n_near, first(v ORDER BY near.n DESC, encode(v)) AS v, max(near.n) AS top
      FROM words LEFT JOIN near ON w = word GROUP BY ALL
    ),
    judged AS (SELECT word, n, n_near, CASE WHEN top >= 10 * n THEN v END AS form, CASE WHEN top >= 10 * n THEN top END AS form_n FROM told),
    paths AS (
      SELECT word, word AS at FROM judged UNION ALL
      SELECT paths.word, form FROM paths JOIN judged ON judged.word = paths.at WHERE form IS NOT NULL
    )
    SELECT judged.word, judged.form, paths.at AS root, judged.n, judged.n_near, judged.form_n
    FROM judged JOIN paths USING (word) JOIN judged l ON l.word = paths.at WHERE l.form IS NULL
"""


@query("op13_spelling", _OP13_SQL)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))
