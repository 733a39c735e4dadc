"""Personal data replaced by surrogates. DataFrame functions only.

Entities (e-mail addresses, phone and card numbers, IP addresses of both
versions, bank and social numbers, secrets, names after a title; names without
a title are not looked for) are found by one regular expression. Each gets a replacement of its own kind, derived from a key and
the entity's normal form:

* the same entity gets the same surrogate everywhere, in whatever format it
  is written (coreference); parts that recur, such as an address's domain or a
  surname, are replaced alike wherever they stand;
* format stays: digits stand where digits stood, letters keep case and
  script, a valid card number stays valid, an address stays an address; a
  first name keeps the gender that its titles tell over the whole corpus (the
  male list where they tell both or none), so it is one name after any title;
* surrogates are distinct: a table of all distinct parts of entities (an
  address is a local part and a domain) is checked for two parts with one
  surrogate, and for a surrogate that is itself a part in the corpus; the
  losers draw again until none is left. Names, local parts, domains and
  secrets drawn again grow, so that a shape whose every form is taken ends
  too; numbers keep their length, of eight digits or more.

Only distinct entities are shuffled, reduced in each task first, and never
texts without an entity: these are passed on as they are. Texts with entities
meet their replacements by a hash of the text, so copies share one entry; AQE
may split a hot one. The tables of the check are written to the shared
checkpoint folder; its loop ends on a count.

Defined cases: a null text stays null, an empty one empty. Repeated rows get
the same text. Ids may be null or repeat. An empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import bind, columns_of, free_name, materialise, require, text_of

TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Sir", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
#: Surrogate first names by script and gender, and surnames by script.
FIRST = {
    "latin": {"m": "Alan Boris Carl David Edgar Frank Georg Henri Ivan Jonas Karl Luis", "f": "Alma Berta Clara Dora Elsa Flora Greta Helga Irma Julia Karin Laura"},
    "cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор", "f": "Анна Вера Галина Дарья Елена Жанна"},
    "greek": {"m": "Άρης Γιώργος Δήμος Ηλίας Κώστας Λάμπρος", "f": "Άννα Βίκυ Δανάη Ελένη Ζωή Ηρώ"},
}
LAST = {
    "latin": "Abel Brandt Corell Dahl Ekberg Falk Garner Holm Iversen Jansen Keller Lorenz Moser Nolan Olsen Palmer",
    "cyrillic": "Аксенов Белов Волков Громов Дроздов Ершов Жуков Зимин",
    "greek": "Αλεξίου Βασιλείου Γεωργίου Δημητρίου Ευαγγέλου Ζαφειρίου Ηλιάδη Θεοδώρου",
}
_NAME = r"\p{Lu}[\p{L}'’-]+"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: (kind, expression), tried in this order at each place.
KINDS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}][\p{L}\p{N}-]{0,62}\.)+\p{L}{2,24}"),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![0-9A-Za-z])"),
    ("ip", rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"),
    ("ipv6", r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    ("social", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("card", r"(?<![0-9+])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"),
    ("phone", r"(?<![0-9+])(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|\+(?=[0-9](?:[ .-]?[0-9]){7,14}(?![0-9]))[0-9]{1,3}(?:[ .-]?[0-9]{1,4}){2,7}(?![0-9])|(?<![0-9.+-])0[0-9](?:[ .][0-9]{2}){4}(?![0-9])|(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    ("name", rf"(?<![\p{{L}}])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?"),
)
ANY = "|".join(f"(?:{e})" for _, e in KINDS)
#: Whether a text can hold an entity at all.
_HINT = rf"[0-9@]|(?<![\p{{L}}])(?:{_TITLE})\.? \p{{Lu}}|[0-9a-fA-F]{{32}}"
_SEP = "\x01"


def kind_of(entity: Column) -> Column:
    # anchored, each by itself; look-arounds at the ends hold trivially
    whens = reduce(lambda w, k: w.when(entity.rlike(rf"^(?:{k[1]})$"), F.lit(k[0])), KINDS[1:], F.when(entity.rlike(rf"^(?:{KINDS[0][1]})$"), F.lit("email")))
    return whens.otherwise(F.lit("phone"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _words(entity: Column) -> Column:
    """A name's words after the title."""
    return F.slice(F.split(entity, " "), F.lit(2), F.size(F.split(entity, " ")))


def _gender(entity: Column) -> Column:
    title = F.regexp_replace(F.split(entity, " ")[0], r"\.$", "")
    return F.when(title.isin(*TITLES["f"]), "f").when(title.isin(*TITLES["m"]), "m").otherwise("n")


def parts(entity: Column, kind: Column) -> Column:
    """The array of part keys (kind and normal form) an entity is made of."""
    key = lambda k, v: F.concat(F.lit(k + _SEP), v)
    number = F.when(kind == "iban", F.regexp_replace(entity, " ", "")).otherwise(_digits(entity))
    names = _words(entity)
    named = F.transform(
        names,
        lambda w, i: F.when(i == F.size(names) - 1, key("last", w)).otherwise(key("first", w)),
    )
    return (
        F.when(kind == "email", F.array(key("email", F.lower(entity)), key("domain", F.substring_index(F.lower(entity), "@", -1))))
        .when(kind == "secret", F.array(key("secret", F.lower(entity))))
        .when(kind == "ip", F.array(key("ip", entity)))
        .when(kind == "ipv6", F.array(key("ipv6", F.lower(entity))))
        .when(kind == "name", named)
        .otherwise(F.array(F.concat(kind, F.lit(_SEP), number)))
    )


def _h(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def _pick(words: str, at: Column) -> Column:
    listed = F.array(*[F.lit(w) for w in words.split()])
    return F.get(listed, F.pmod(at, F.lit(len(words.split()))).cast("int"))


def _reshaped(text: Column, seed: Column) -> Column:
    """Every digit and letter drawn anew; case and script as they were."""

    def one(c: Column, i: Column) -> Column:
        h = _h(seed, i)
        letter = lambda s: F.substring(F.lit(s), F.pmod(h, F.lit(len(s))).cast("int") + 1, F.lit(1))
        small = (
            F.when(c.rlike(r"^\p{IsCyrillic}$"), letter("абвгдежзиклмнопрст"))
            .when(c.rlike(r"^\p{IsGreek}$"), letter("αβγδεζηθικλμνοπρ"))
            .otherwise(letter("abcdefghijklmnopqrstuvwxyz"))
        )
        return (
            F.when(c.rlike("^[0-9]$"), F.pmod(h, F.lit(10)).cast("string"))
            .when(c.rlike(r"^\p{Lu}$"), F.upper(small))
            .when(c.rlike(r"^\p{L}$"), small)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo ten of a digit string."""
    places = F.split(F.reverse(digits), "")
    worth = F.transform(
        places,
        lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10


def _card(number: Column, drawn: Column) -> Column:
    body = drawn.substr(F.lit(1), F.length(drawn) - 1)
    check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(number) == 0, F.concat(body, check)).otherwise(drawn)


def _name(word: Column, at: Column, gender: str | None) -> Column:
    lists = {s: (LAST[s] if gender is None else FIRST[s][gender]) for s in FIRST}
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), _pick(lists["cyrillic"], at))
        .when(word.rlike(r"\p{IsGreek}"), _pick(lists["greek"], at))
        .otherwise(_pick(lists["latin"], at))
    )


def _grown(seed: Column, attempt: Column) -> Column:
    """One more letter for every second attempt after the first two."""
    n = F.floor(F.greatest(attempt - 1, F.lit(0)) / 2).cast("int")
    letter = lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), F.pmod(_h(seed, i, F.lit(9)), F.lit(26)).cast("int") + 1, F.lit(1))
    return F.array_join(F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), letter), "")


def surrogate(part: Column, gender: Column, secret: str, attempt: Column) -> Column:
    """The surrogate of a part key at the given attempt; of an address, its
    new local part."""
    kind, form = F.split(part, _SEP)[0], F.split(part, _SEP)[1]
    seed = _h(F.lit(secret), part, attempt)
    more = _grown(seed, attempt)
    local = F.concat(_reshaped(F.substring_index(form, "@", 1), seed), more)
    host = F.regexp_replace(form, r"\.[^.]*$", "")
    domain = F.concat(_reshaped(host, seed), more, F.regexp_extract(form, r"(\.[^.]*)$", 1))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.pmod(_h(seed, i), F.lit(256)).cast("string")), ".")
    hexed = F.substring(F.sha2(F.concat(F.lit(secret), F.lit(_SEP), part, F.lit(_SEP), attempt.cast("string")), 256), 1, 64)
    hidden = F.when(form.rlike("^[0-9a-f]+$"), hexed.substr(F.lit(1), F.length(form))).otherwise(_reshaped(form, seed))
    hexadecimal = lambda c, i: F.when(c == ":", c).otherwise(F.substring(F.lit("0123456789abcdef"), F.pmod(_h(seed, i), F.lit(16)).cast("int") + 1, F.lit(1)))
    ipv6 = F.array_join(F.transform(F.split(form, ""), hexadecimal), "")
    # a name drawn again grows by a syllable, so that names never run out
    tail = F.array_join(
        F.transform(
            F.slice(F.sequence(F.lit(0), attempt.cast("int")), F.lit(1), attempt.cast("int")),
            lambda i: F.when(form.rlike(r"\p{IsCyrillic}"), _pick("ин ов ан ел", _h(seed, i, F.lit(7))))
            .when(form.rlike(r"\p{IsGreek}"), _pick("ος ης ου ας", _h(seed, i, F.lit(7))))
            .otherwise(_pick("a en is or ul", _h(seed, i, F.lit(7)))),
        ),
        "",
    )
    # a phone's first digit, its country or area group, stays
    drawn = F.concat(
        F.when(kind == "phone", form.substr(F.lit(1), F.lit(1))).otherwise(F.lit("")),
        _reshaped(F.when(kind == "phone", form.substr(F.lit(2), F.length(form))).otherwise(form), seed),
    )
    return (
        F.when(kind == "email", local)
        .when(kind == "domain", domain)
        .when(kind == "ip", octets)
        .when(kind == "ipv6", ipv6)
        .when(kind == "secret", hidden)
        .when(kind == "card", bind(drawn, lambda d: _card(form, d)))
        .when(kind == "last", F.concat(_name(form, seed, None), tail))
        .when((kind == "first") & (gender == "f"), F.concat(_name(form, seed, "f"), tail))
        .when(kind == "first", F.concat(_name(form, seed, "m"), tail))
        .otherwise(drawn)
    )


def assign(found: DataFrame, secret: str) -> DataFrame:
    """(part, surrogate) for distinct ``part`` keys with their ``gender``:
    distinct surrogates of a kind, none of them a part itself."""
    kind = F.split("part", _SEP)[0]
    left = found.select("part", "gender", F.lit(0).alias("attempt"))
    done: DataFrame | None = None
    while True:
        drawn = left.withColumn("surrogate", surrogate(F.col("part"), F.col("gender"), secret, F.col("attempt")))
        named = drawn.withColumn("as_part", F.concat(kind, F.lit(_SEP), F.lower("surrogate")))
        firsts = named.groupBy("as_part").agg(F.min("part").alias("first"))
        taken = found.select(F.lower("part").alias("as_part"))
        if done is not None:
            taken = taken.union(done.select(F.concat(kind, F.lit(_SEP), F.lower("surrogate"))))
        free = firsts.join(taken.distinct(), "as_part", "left_anti")
        won = named.join(free, (named["as_part"] == free["as_part"]) & (named["part"] == free["first"]), "left_semi")
        won = won.select("part", "surrogate")
        done = materialise(won if done is None else done.union(won), "pii-surrogates")
        lost = materialise(
            left.join(done.select("part"), "part", "left_anti").withColumn("attempt", F.col("attempt") + 1), "pii-left"
        )
        if lost.isEmpty():
            return done
        left = lost


def _poured(entity: Column, digits: Column) -> Column:
    """``digits`` written where the entity has digits or capital letters of a
    number."""
    return F.array_join(
        F.transform(
            F.split(entity, ""),
            lambda c, i: F.when(
                c.rlike("^[0-9A-Z]$"),
                digits.substr(F.length(F.regexp_replace(entity.substr(F.lit(1), i + 1), "[^0-9A-Z]", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def render(entity: Column, known: Column) -> Column:
    """The entity's replacement in its own format; ``known`` maps parts."""

    def by_kind(kind: Column) -> Column:
        def put(keys: Column) -> Column:
            got = F.transform(keys, lambda k: F.element_at(known, k))
            one = got[0]
            title = F.split(entity, " ")[0]
            return (
                F.when(kind == "name", F.concat_ws(" ", title, F.array_join(got, " ")))
                .when(kind == "email", F.concat(one, F.lit("@"), got[1]))
                .when(kind.isin("ip", "ipv6"), one)
                .when(kind == "secret", F.when(entity.rlike("^[0-9A-F]+$"), F.upper(one)).otherwise(one))
                .otherwise(_poured(entity, one))
            )

        return bind(parts(entity, kind), put)

    return bind(kind_of(entity), by_kind)


def entities_of(text: Column) -> Column:
    return F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def pseudonymise(docs: DataFrame, secret: str = "voxtab", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``entities``: an array of
    (kind, surrogate as written) in the order of the text."""
    require(docs, [text])
    e, h, m, out = (free_name(docs, x) for x in ("_entities", "_hash", "_map", "entities"))
    marked = columns_of(docs, **{e: entities_of(text_of(docs[text]))})
    plain = marked.where(F.size(e) == 0)
    held = marked.where(F.size(e) > 0).withColumn(h, F.xxhash64(text))
    told = lambda x, keys: F.transform(keys, lambda k: F.struct(k.alias("part"), _gender(x).alias("gender")))
    uses = held.select(
        F.col(h).alias("text_hash"),
        F.explode(F.array_distinct(F.flatten(F.transform(e, lambda x: bind(kind_of(x), lambda k: told(x, parts(x, k))))))).alias("use"),
    ).select("text_hash", "use.*")
    uses = materialise(uses.distinct(), "pii-uses")
    female, male = (F.count(F.when(F.col("gender") == g, 1)) for g in ("f", "m"))
    both = uses.groupBy("part").agg(F.when((female > 0) & (male == 0), "f").otherwise("m").alias("gender"))
    names = assign(materialise(both, "pii-parts"), secret)
    maps = (
        uses.select("text_hash", "part").distinct().join(names, "part")
        .groupBy("text_hash")
        .agg(F.map_from_entries(F.collect_list(F.struct("part", "surrogate"))).alias(m))
        .withColumnRenamed("text_hash", h)
    )
    joined = held.join(maps, h)
    new, pieces = free_name(docs, "_new"), F.split(F.col(text), ANY)
    joined = columns_of(joined, **{new: F.transform(e, lambda x: render(x, F.col(m)))})
    woven = F.array_join(
        F.flatten(F.zip_with(pieces, F.col(new), lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), ""
    )
    spans = F.zip_with(F.col(e), F.col(new), lambda a, b: F.struct(kind_of(a).alias("kind"), b.alias("surrogate")))
    columns = [c for c in docs.columns]
    done = joined.select(*[woven.alias(c) if c == text else F.col(f"`{c}`") for c in columns], spans.alias(out))
    none = F.array().cast("array<struct<kind:string,surrogate:string>>")
    return done.unionByName(plain.select(*[F.col(f"`{c}`") for c in columns], none.alias(out)))
