"""PII surrogates: keyed, type-consistent replacements, in DataFrame functions only.

Detected: e-mail addresses, access tokens, phone numbers, card numbers, social
security numbers, IPv4 addresses, and names after a title.  An entity is its type and
canonical form (case and separators dropped); its surrogate is drawn from
SHA-256 of key, type and canonical form, so the same entity gets the same
surrogate wherever it occurs (coreference).  Surrogates keep type, length,
separators and case; card numbers keep their Luhn validity, private IPv4
addresses their private prefix (after ``OWN_PREFIX_DRAWS`` draws an address in
192.168 takes another private range), names their script and (by title or given
name) gender.

Collision checks run on the table of distinct entities: of several entities
that draw one surrogate one keeps it, nobody takes a surrogate that is itself
an entity of the corpus or already taken, and the others draw again.  The loop
ends when all have one.  Only where a type has no surrogate left (a round after
the first ``MAX_DRAWS`` in which nobody gets one) the rest get an opaque tag of
their full hash.

Only documents with an entity are shuffled: occurrences join the surrogate
table, are put in order per text, and rebuild it.

Defined results: NULL texts stay NULL and clean texts unchanged; rows with a
NULL or repeated id are told apart by their text, and equal rows come out
equal; other columns pass through.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written

KEY = "cohortkit"
MAX_DRAWS = 12
OWN_PREFIX_DRAWS = 4

#: Patterns of the detected entities, first match wins.
EMAIL = r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}"
TOKEN = r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{32,64}|AKIA[0-9A-Z]{16}|(?:sk|ghp|gho|xoxb|xoxp)[-_][0-9A-Za-z_\-]{16,})(?![0-9A-Za-z])"
CARD = r"(?<![\d.])(?:\d{4}([ \-]?)\d{4}\1\d{4}\1\d{4}|\d{4}[ \-]?\d{6}[ \-]?\d{5})(?![\d])"
SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d])(?!\.\d)"
PHONE = (r"(?<![\d])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}"
         r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}([.\-])\d{3}\2\d{4})(?![\d])")
TITLES_M = "Mr|Herr|Monsieur|Señor|Господин"
TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Señorita|Госпожа"
TITLES = f"{TITLES_M}|{TITLES_F}|Dr|Prof"
NAME = rf"(?<!\p{{L}})(?:{TITLES})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+){{0,2}}"
ANY = "|".join((EMAIL, TOKEN, CARD, SSN, IPV4, PHONE, NAME))
# what every entity contains: a cheap test before the patterns
SIGN = rf"@|\d{{2}}|\d\.\d\.\d|[0-9a-fA-F]{{32}}|AKIA|(?:sk|gh[po]|xox[bp])[-_]|(?<!\p{{L}})(?:{TITLES})\.? \p{{Lu}}"
#: Given names whose gender is known without a title.
GIVEN_F = "anna|emma|maria|sarah|julia|laura|elena|olga|mary|sofia|claire|ana"
GIVEN_M = "john|peter|james|paul|karl|luis|pierre|ivan|thomas|michael|jose|hans"
#: Syllables and endings of invented names, by script.
LATIN = "ba be bo da de do fa fe ga ge ka ke la le lo ma me mi na ne no pa pe ra re ri sa se ta te to va ve vi"
CYRILLIC = "ба бе бо ва ве го да де до за ка ке ко ла ле ли ма ме ми на не но па пе ра ре ри са се та те то"
ENDINGS = {"given_f": ("na lia sa rine", "на лия са рина"), "given_m": ("rt no den mus", "рт ний дан мир"),
           "given": ("r n l s", "р н л с"), "surname": ("rson well mann ford", "рский венко нович рин")}


def _type(match: Column) -> Column:
    return F.when(F.contains(match, F.lit("@")), "email") \
        .when(match.rlike(rf"^(?:{TITLES})\.? "), "name") \
        .when(match.rlike(rf"^{SSN}$"), "ssn") \
        .when(match.rlike(rf"^{IPV4}$"), "ipv4") \
        .when(match.rlike(rf"^(?:{CARD})$"), "card") \
        .when(match.rlike(rf"^{TOKEN}$"), "token") \
        .otherwise("phone")


def _tokens(match: Column) -> Column:
    """Words of a match with their entity type: a name's title stays, its last word
    is the surname, words between are given names; anything else is one token."""
    words = F.split(match, " ")
    female, male = match.rlike(rf"^(?:{TITLES_F})\.? "), match.rlike(rf"^(?:{TITLES_M})\.? ")
    last = F.size(words) - 1
    of_name = F.transform(words, lambda w, i: F.struct(
        i.alias("i"), w.alias("raw"),
        F.when(i == 0, "keep").when(i == last, "surname")
        .when(female | F.lower(w).rlike(f"^(?:{GIVEN_F})$"), "given_f")
        .when(male | F.lower(w).rlike(f"^(?:{GIVEN_M})$"), "given_m").otherwise("given").alias("type")))
    whole = F.array(F.struct(F.lit(0).alias("i"), match.alias("raw"), _type(match).alias("type")))
    return F.when(_type(match) == "name", of_name).otherwise(whole)


def canonical(kind: Column, raw: Column) -> Column:
    return F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(raw, r"\D", "")) \
        .when((kind == "token") & ~raw.rlike(r"^[0-9a-fA-F]+$"), raw) \
        .otherwise(F.lower(raw))


def occurrences(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key columns, pos, i, raw, type, canon): every entity token in order."""
    found = docs.select(*key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))).alias("pos", "match"))
    tokens = found.select(*key, "pos", F.explode(_tokens(F.col("match"))).alias("t"))
    return tokens.select(*key, "pos", "t.i", "t.raw", "t.type", canonical(F.col("t.type"), F.col("t.raw")).alias("canon"))


def _bytes_of(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    """A keyed stream for one entity and draw: an array of numbers 0 to 255, at least
    two per character of the canonical form."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, canon, draw.cast("string"))
    blocks = F.sequence(F.lit(0), (F.length(canon) / 16).cast("int"))
    # two hashes, the outer one keyed as well
    hexes = F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat(
        F.lit(key), F.sha2(F.concat_ws("\x1f", seed, b.cast("string")), 256)).cast("binary"), 256)), "")
    return F.transform(F.regexp_extract_all(hexes, F.lit(".."), F.lit(0)), lambda h: F.conv(h, 16, 10).cast("int"))


def _pick(items: str, at: Column) -> Column:
    listed = items.split(" ")
    return F.element_at(F.array(*[F.lit(x) for x in listed]), (F.pmod(at, F.lit(len(listed))) + 1).cast("int"))


def _letters(chars: Column, stream: Column) -> Column:
    """Characters replaced one by one within digit, Latin and Cyrillic; others stay."""
    number = lambda i, n: F.pmod(F.get(stream, 2 * i) * 256 + F.get(stream, 2 * i + 1), F.lit(n)).cast("int")
    return F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike(r"^\d$"), number(i, 10).cast("string"))
        .when(c.rlike(r"^\p{IsCyrillic}$"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), number(i, 27) + 1, F.lit(1)))
        .when(c.rlike(r"^\p{L}$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), number(i, 26) + 1, F.lit(1)))
        .otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of an array of digit characters, modulo 10."""
    last = F.size(digits) - 1
    values = F.transform(digits, lambda d, i: F.when((last - i) % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + v) % 10


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (type, canon, draw) plus ``surrogate``."""
    rows = entities.withColumn("_s", _bytes_of(key, F.col("type"), F.col("canon"), F.col("draw")))
    rows = rows.withColumn("_c", F.filter(F.split("canon", ""), lambda c: c != ""))
    rows = rows.withColumn("_body", _letters(F.col("_c"), F.col("_s")))
    s = lambda i: F.get("_s", F.lit(i))
    kind, canon, body = F.col("type"), F.col("canon"), F.col("_body")
    # a wider local part from the third draw on, where a short one may be exhausted
    local = F.concat(F.substring_index(body, "@", 1), F.when(F.col("draw") > 2, F.concat(
        s(0).cast("string"), s(1).cast("string"))).otherwise(""))
    labels = F.split(F.substring_index(canon, "@", -1), r"\.")
    zone = F.element_at(labels, -1)
    drawn_labels = F.split(F.substring_index(body, "@", -1), r"\.")
    # a reserved domain under the same zone, sub-domains as many as before
    domain = F.concat_ws(".", F.when(F.size(labels) > 2, F.array_join(F.slice(drawn_labels, F.lit(1), F.size(labels) - 2), ".")),
                         F.lit("example"), F.when(zone.isin("com", "net", "org"), zone).otherwise(F.lit("com")))
    digits = F.filter(F.split("_body", ""), lambda c: c != "")
    fixed = F.concat(F.array_join(F.slice(digits, F.lit(1), F.size(digits) - 1), ""), F.lit("0"))
    rows = rows.withColumn("_card0", F.filter(F.split(fixed, ""), lambda c: c != ""))
    check = F.pmod(F.lit(10) - _luhn(F.col("_card0")), F.lit(10))
    valid = _luhn(F.col("_c")) == 0
    tail = F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(s(0), F.lit(9)), F.lit(10)))
    card = F.concat(F.array_join(F.slice("_card0", F.lit(1), F.size("_card0") - 1), ""), tail.cast("string"))
    octet = lambda i: (F.pmod(s(i), F.lit(254)) + 1).cast("string")
    ip = F.when(canon.startswith("10."), F.concat_ws(".", F.lit("10"), octet(1), octet(2), octet(3))) \
        .when(canon.startswith("192.168.") & (F.col("draw") < OWN_PREFIX_DRAWS),
              F.concat_ws(".", F.lit("192.168"), octet(2), octet(3))) \
        .when(canon.startswith("192.168."), F.concat_ws(".", F.lit("10"), octet(1), octet(2), octet(3))) \
        .otherwise(F.concat_ws(".", (F.pmod(s(0), F.lit(90)) + 101).cast("string"), octet(1), octet(2), octet(3)))
    # phone numbers keep their first digit (of the country code), social security numbers lie in the unused 900s
    phone = F.concat(F.substring(canon, 1, 1), F.substring(body, F.lit(2), F.length(body)))
    ssn = F.concat(F.lit("9"), F.substring(body, 2, 8))
    token = F.when(canon.rlike(r"^[0-9a-f]+$"), F.substring(F.array_join(F.transform("_s", lambda v: F.lpad(
        F.lower(F.hex(v)), 2, "0")), ""), F.lit(1), F.length(canon))).otherwise(
        F.concat(F.substring(canon, 1, 4), F.substring(body, F.lit(5), F.length(body))))
    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    middle = F.when(F.col("draw") > 1, True).otherwise(False)

    def name(of: str) -> Column:
        def spelt(base: str, ending: str) -> Column:
            return F.concat(_pick(base, s(0)), _pick(base, s(1)), _pick(base, s(2)),
                            F.when(middle, F.concat(_pick(base, s(4)), _pick(base, s(5)))).otherwise(""), _pick(ending, s(3)))
        latin, cyr = ENDINGS[of]
        return F.when(cyrillic, spelt(CYRILLIC, cyr)).otherwise(spelt(LATIN, latin))

    drawn = F.when(kind == "email", F.concat(local, F.lit("@"), domain)).when(kind == "card", card) \
        .when(kind == "ipv4", ip).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "token", token)
    for of in ENDINGS:
        drawn = drawn.when(kind == of, name(of))
    return rows.withColumn("surrogate", drawn).drop("_s", "_c", "_body", "_card0")


def assign(entities: DataFrame, key: str = KEY, max_draws: int = MAX_DRAWS) -> DataFrame:
    """(type, canon, surrogate, draw) for distinct (type, canon): surrogates are
    distinct per type and none is an entity of the table."""
    entities = written(entities.select("type", "canon").distinct(), "entities")
    taken = None
    left = entities
    for draw in itertools.count():
        drawn = _drawn(left.withColumn("draw", F.lit(draw)), key)
        real = entities.select("type", F.col("canon").alias("surrogate"))
        free = drawn.join(real, ["type", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = free.groupBy("type", "surrogate").agg(F.min("canon").alias("canon")) \
            .select("type", "canon", "surrogate", F.lit(draw).alias("draw"))
        won = written(won, "assigned")
        taken = won if taken is None else taken.union(won)
        left = written(left.join(won.select("type", "canon"), ["type", "canon"], "left_anti"), "unassigned")
        if not left.take(1):
            return taken
        if draw + 1 >= max_draws and not won.take(1):
            break
    tag = F.concat(F.lit("["), F.col("type"), F.lit("-"), F.sha2(F.concat_ws(
        "\x1f", F.lit(key), "type", "canon").cast("binary"), 256), F.lit("]"))
    return taken.union(left.select("type", "canon", tag.alias("surrogate"), F.lit(draw + 1).alias("draw")))


def _rendered(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the occurrence: separators and case."""
    chars = F.filter(F.split(raw, ""), lambda c: c != "")
    spaced = F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(c.rlike(r"^\d$"), F.struct(
            F.concat(acc["out"], F.substring(surrogate, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: acc["out"])
    cased = F.when((raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(surrogate)) \
        .when(kind.isin(*ENDINGS), F.initcap(surrogate)).otherwise(surrogate)
    opaque = surrogate.startswith("[")
    return F.when(kind == "keep", raw).when(opaque, surrogate) \
        .when(kind.isin("phone", "card", "ssn"), spaced) \
        .when((kind == "token") & ~raw.rlike(r"^[0-9a-fA-F]+$"), surrogate).otherwise(cased)


def replace(docs: DataFrame, key: str = KEY, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` with entities replaced and ``__ck_replaced`` (their number), and the
    surrogate table (type, canon, surrogate, draw)."""
    keys = ["__ck_id", "__ck_digest"]
    has = F.coalesce(F.col(text).rlike(SIGN) & F.col(text).rlike(ANY), F.lit(False))
    marked = docs.withColumns({"__ck_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "__ck_digest": F.xxhash64(text)})
    hits = marked.filter(has)
    found = written(occurrences(hits, keys, text), "occurrences").distinct()
    table = written(assign(found.filter("type <> 'keep'"), key), "surrogates")
    named = found.join(table.select("type", "canon", "surrogate"), ["type", "canon"], "left")
    whole = named.groupBy(*keys, "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "i", _rendered(F.col("type"), F.col("raw"), F.col("surrogate")).alias("out")))), lambda t: t["out"]), " ").alias("out"))
    # an array per text, of its own entities
    per_text = whole.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda p: p["out"])
                                        .alias("__ck_new"))
    parts = F.split(F.col(text), ANY, -1)
    rebuilt = hits.join(per_text, keys).withColumn("__ck_parts", parts)
    rebuilt = rebuilt.withColumn(text, F.array_join(F.flatten(F.zip_with(
        "__ck_parts", "__ck_new", lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), "")) \
        .withColumn("__ck_replaced", F.size("__ck_new").cast("long"))
    columns = docs.columns
    clean = docs.filter(~has).withColumn("__ck_replaced", F.lit(0).cast("long"))
    return rebuilt.select(*columns, "__ck_replaced").union(clean.select(*columns, "__ck_replaced")), table
