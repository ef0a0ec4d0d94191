"""Personal data: detected entities are replaced by keyed surrogates of the same kind and format.

Everything is expressions and joins. One pattern finds entities; each has a kind and a canonical
form, so that all spellings of an entity share one surrogate (coreference). A surrogate is drawn
from a keyed SHA-512 of kind, canonical form and attempt number. Surrogates of all distinct
entities are compared with each other and with the entities themselves; losers of a collision
draw again, so different entities never share a surrogate and none turns into a real one.

Kinds: e-mail, IPv4 address, phone, payment card (valid check digit only, also beside other
numbers), social security
number, IBAN, secret (assigned passwords and tokens, access keys), and names after a title.
A surrogate keeps letter case, digit places, punctuation and script; cards keep their first
digit and get a valid check digit; phones keep their country code's first digit; names keep the
gender that the title states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.llm.common import parallelism
from ventis.session import materialize

# What counts as an entity.
# A domain gives labels back, so that a full stop may follow it; names have at most 127 labels,
# which also bounds the depth of the regex engine.
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]++\.){1,127}\p{L}{2,}+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
PHONE = (r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
         r"|(?<![\p{L}\p{N}])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)"
         r"|(?<![\p{L}\p{N}\-.])\d{3}([.\-])\d{3}\1\d{4}(?![\d\-])")
CARD = r"(?<![\p{L}\p{N}\-])\d(?:[ \-]?\d){12,18}(?![\-]?[\p{L}\d])"
# Groupings that cards are written in, at every number's start; what stands beside is left out.
GROUPED = (r"(?<!\d)(?=(\d{4}([ \-])\d{4}\2\d{4}\2\d{4}|\d{4}([ \-])\d{6}\3\d{4,5}|\d{13,19})(?!\d))")
# All numbers in a row that blanks or hyphens join, up to one that starts another entity.
NUMBER = r"\d++(?![\p{L}@_%+]|\.[\p{L}\p{N}]|-\p{L})"
JOINED = (r"[ \-](?!\d{3}-\d{2}-\d{4}(?![\d\-])|\d{3}-\d{3}-\d{4}(?![\d\-])"
          r"|[\p{L}\p{N}._%+\-]++@)")
NUMBERS = (rf"(?<![\p{{L}}\p{{N}}\-])(?=\d(?:[ \-]?\d){{12}}){NUMBER}(?:{JOINED}{NUMBER})*+")
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
ASSIGNED = r"(?<![\p{L}\p{N}])(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
SECRET = rf"{ASSIGNED}[A-Za-z0-9_\-./+=]{{8,}}+"
ACCESS_KEY = r"(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])"
MALE = r"Mr\.?|Herr|Monsieur|Señor|господин|г-н"
FEMALE = r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|госпожа|г-жа"
NEUTRAL = r"Dr\.|Prof\."
WORD = r"\p{Lu}[\p{L}'’\-]++"
TITLE = rf"(?<![\p{{L}}\p{{N}}])(?:{FEMALE}|{MALE}|{NEUTRAL}) "
PERSON = rf"{TITLE}{WORD}(?: {WORD}){{0,2}}"
PATTERN = "|".join(
    f"(?:{x})" for x in (EMAIL, IPV4, SECRET, ACCESS_KEY, SSN, PHONE, IBAN, NUMBERS, PERSON))
# Every entity has a digit, an at sign or a title; this cheap test spares most texts the pattern.
HINT = rf"[\d@]|{TITLE}|(?i:password|passwd|secret|token|key)\s{{0,3}}[=:]"

HEX = "0123456789abcdef"
LATIN = "bcdfghjklmnpqrst"
CYRILLIC = "бвгджзклмнпрстфх"
GREEK = "βγδζθκλμνξπρστφχ"
VOWELS = {"latin": "aeio", "cyrillic": "аеио", "greek": "αειο"}
ENDINGS = {"latin": ("o", "a", "e"), "cyrillic": ("", "а", "о"), "greek": ("ος", "α", "ι")}
MAX_ROUNDS = 40
_PIECE = "struct<kind:string,text:string>"


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it in an expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _is(kind_pattern: str, text: Column) -> Column:
    return text.rlike(rf"^(?:{kind_pattern})$")


def luhn_sum(digits: Column) -> Column:
    """Checksum of a string of digits, from the right."""
    places = F.sequence(F.lit(1), F.length(digits))
    turned = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(turned, place, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, double).otherwise(digit)

    return F.aggregate(places, F.lit(0), add)


def kind_of(found: Column) -> Column:
    """Kind of a whole match."""
    return (
        F.when(found.contains("@"), "email")
        .when(_is(PERSON, found), "person")
        .when(_is(SECRET, found) | _is(ACCESS_KEY, found), "secret")
        .when(_is(IPV4, found), "ipv4")
        .when(_is(SSN, found), "ssn")
        .when(_is(PHONE, found), "phone")
        .when(_is(IBAN, found), "iban")
        .otherwise("card")
    )


def _piece(kind: Column, text: Column) -> Column:
    return F.struct(kind.cast("string").alias("kind"), text.alias("text"))


def _cards(numbers: Column) -> Column:
    """Pieces of numbers in a row: cards, and between them text without a kind.

    Numbers in a usual grouping with a valid check digit are cards, the leftmost first; if there
    are none, the longest runs of 13 to 19 digits with a valid check digit are.
    """
    none = F.lit(None)

    def ranked(cards: Column, rank: int) -> Column:
        return F.transform(cards, lambda card: F.struct(F.lit(rank).alias("rank"), card.alias("card")))

    readings = F.concat(ranked(F.regexp_extract_all(numbers, F.lit(GROUPED), F.lit(1)), 1),
                        ranked(F.regexp_extract_all(numbers, F.lit(CARD), F.lit(0)), 2))
    valid = F.filter(readings, lambda x: luhn_sum(_digits(x["card"])) % 10 == 0)

    def take(state: Column, reading: Column) -> Column:
        card, rest = reading["card"], state["rest"]
        at = F.position(card, rest)
        taken = F.struct(
            F.concat(state["done"], F.array(
                _piece(none, F.substr(rest, F.lit(1), at - 1)), _piece(F.lit("card"), card))).alias("done"),
            F.substr(rest, at + F.length(card)).alias("rest"), reading["rank"].alias("rank"))
        fits = (at > 0) & (reading["rank"] <= state["rank"])
        return F.when(fits, taken).otherwise(state)

    start = F.struct(F.array().cast(f"array<{_PIECE}>").alias("done"), numbers.alias("rest"),
                     F.lit(2).alias("rank"))
    return F.aggregate(valid, start, take, lambda state: F.concat(
        state["done"], F.array(_piece(none, state["rest"]))))


def pieces(found: Column) -> Column:
    """A match as array<struct<kind, text>>; numbers that are no card have a null kind."""
    def by_kind(kind: Column) -> Column:
        return F.when(kind == "card", _cards(found)).otherwise(F.array(_piece(kind, found)))
    return _let(kind_of(found), by_kind)


def _secret_lead(found: Column) -> Column:
    """The part of a secret that stays: variable name and quote, or the key prefix."""
    lead = F.regexp_extract(found, rf"^{ASSIGNED}", 0)
    return F.when(found.startswith("AKIA"), F.lit("AKIA")).otherwise(lead)


def _after(text: Column, lead: Column) -> Column:
    return F.substr(text, F.length(lead) + 1)


def canonical(kind: Column, mention: Column) -> Column:
    """One spelling for all mentions of an entity; not for persons."""
    digits = _digits(mention)
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("ipv4", "secret"), mention)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "phone", F.when(F.length(digits) == 10, F.concat(F.lit("1"), digits))
              .otherwise(digits))
        .otherwise(digits)
    )


def _title(found: Column) -> Column:
    return F.regexp_extract(found, rf"^{TITLE}", 0)


def _given_kind(title: Column) -> Column:
    return (F.when(title.rlike(rf"^(?:{FEMALE}) $"), "given_f")
            .when(title.rlike(rf"^(?:{MALE}) $"), "given_m").otherwise("given_n"))


def parts(piece: Column) -> Column:
    """A piece as array<struct<kind, lead, mention, canon>>: one, or one per word of a name.

    ``lead`` stays as it is, ``mention`` is written anew; a piece without a kind is all lead.
    """
    kind, found = piece["kind"], piece["text"]

    def part(kind: Column, lead: Column, mention: Column, canon: Column) -> Column:
        return F.struct(kind.alias("kind"), lead.alias("lead"), mention.alias("mention"),
                        canon.alias("canon"))

    def named(title: Column) -> Column:
        words = F.split(_after(found, title), " ")
        return F.transform(words, lambda word, at: part(
            F.when(at == F.size(words) - 1, "surname").otherwise(_given_kind(title)),
            F.when(at == 0, title).otherwise(" "), word, F.lower(word)))

    def whole(lead: Column) -> Column:
        mention = _after(found, lead)
        return F.array(part(kind, lead, mention, canonical(kind, mention)))

    lead = F.when(kind.isNull(), found).when(kind == "secret", _secret_lead(found)).otherwise("")
    return F.when(kind == "person", _let(_title(found), named)).otherwise(_let(lead, whole))


def _stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """128 hex characters that nobody without the key can foresee."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 512)


def _overlay(mention: Column, fresh: Column, skip: Column | int = 0) -> Column:
    """Write ``fresh`` over the letters and digits of ``mention``, class by class."""
    def place(at: Column) -> Column:
        char = F.substr(mention, at, F.lit(1))
        before = F.length(F.regexp_replace(F.substr(mention, F.lit(1), at), r"[^\p{L}\p{N}]", ""))
        new = F.substr(fresh, (before - 1 + skip) % F.length(fresh) + 1, F.lit(1))
        lower = (F.when(char.rlike(r"\p{IsCyrillic}"), F.translate(new, HEX, CYRILLIC))
                 .when(char.rlike(r"\p{IsGreek}"), F.translate(new, HEX, GREEK))
                 .otherwise(F.translate(new, HEX, LATIN)))
        return (F.when(char.rlike(r"\d"), F.translate(new, "abcdef", "012345"))
                .when(char.rlike(r"\p{Lu}"), F.upper(lower))
                .when(char.rlike(r"\p{L}"), lower).otherwise(char))
    return F.when(F.length(mention) == 0, mention).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), place), ""))


def _number(stream: Column, at: int, size: int) -> Column:
    return F.conv(F.substr(stream, F.lit(at), F.lit(size)), 16, 10).cast("long")


def _name(kind: Column, word: Column, stream: Column, attempt: Column) -> Column:
    """A name of three or more syllables in the word's script and case, ending by gender."""
    count = 3 + F.least(F.floor(attempt / 4), F.lit(8)).cast("int")

    def spelled(script: str, consonants: str) -> Column:
        vowels = VOWELS[script] * 4
        male, female, neutral = ENDINGS[script]

        def syllable(at: Column) -> Column:
            pair = F.substr(stream, at * 2 - 1, F.lit(1)), F.substr(stream, at * 2, F.lit(1))
            return F.concat(F.translate(pair[0], HEX, consonants), F.translate(pair[1], HEX, vowels))

        body = F.array_join(F.transform(F.sequence(F.lit(1), count), syllable), "")
        ending = (F.when(kind == "given_m", male).when(kind == "given_f", female)
                  .when(kind == "given_n", neutral).otherwise("n" if script == "latin" else ""))
        return F.concat(body, ending)

    text = (F.when(word.rlike(r"\p{IsCyrillic}"), spelled("cyrillic", CYRILLIC))
            .when(word.rlike(r"\p{IsGreek}"), spelled("greek", GREEK))
            .otherwise(spelled("latin", LATIN)))
    shout = (F.upper(word) == word) & (F.length(word) > 1)
    title = F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.substr(text, F.lit(2)))
    return F.when(shout, F.upper(text)).when(F.lower(word) == word, text).otherwise(title)


def write(kind: Column, mention: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Surrogate of one entity in the format of ``mention`` (without title or secret's lead)."""
    def drawn(stream: Column) -> Column:
        digits = F.translate(stream, "abcdef", "012345")
        kept = F.concat(F.substr(canon, F.lit(1), F.lit(1)),
                        F.substr(digits, F.lit(2), F.length(canon) - 2))
        card = F.concat(kept, ((10 - luhn_sum(F.concat(kept, F.lit("0"))) % 10) % 10).cast("string"))
        phone = F.concat(F.substr(canon, F.lit(1), F.lit(1)),
                         F.translate(F.substr(digits, F.lit(2), F.lit(1)), "01", "45"),
                         F.substr(digits, F.lit(3), F.length(canon) - 2))
        local = F.substring_index(mention, "@", 1)
        return (
            F.when(kind == "email", F.concat(
                _overlay(local, stream), F.lit("@m"), F.substr(stream, F.lit(100), F.lit(8)),
                F.lit(".example.net")))
            .when(kind == "ipv4", F.concat_ws(
                ".", 240 + _number(stream, 1, 4) % 15, _number(stream, 5, 4) % 256,
                _number(stream, 9, 4) % 256, 1 + _number(stream, 13, 4) % 254))
            .when(kind == "card", _overlay(mention, card))
            .when(kind == "phone", _overlay(
                mention, phone, F.length(canon) - F.length(_digits(mention))))
            .when(kind == "ssn", _overlay(mention, F.concat(F.lit("9"), F.substr(digits, F.lit(1), F.lit(8)))))
            .when(kind == "iban", F.concat(
                F.substr(mention, F.lit(1), F.lit(2)), _overlay(F.substr(mention, F.lit(3)), stream)))
            .when((kind == "secret") & mention.rlike("^[0-9a-f]+$"),
                  F.substr(F.repeat(stream, (F.length(mention) / 128).cast("int") + 1),
                           F.lit(1), F.length(mention)))
            .when(kind == "secret", _overlay(mention, stream))
            .otherwise(_name(kind, mention, stream, attempt))
        )
    return _let(_stream(key, kind, canon, attempt), drawn)


def _attempt(redrawn: Column, kind: Column, canon: Column) -> Column:
    return F.coalesce(F.element_at(redrawn, F.concat_ws(":", kind, canon)), F.lit(0))


def replacement(part: Column, redrawn: Column, key: str) -> Column:
    """What a part becomes; ``redrawn`` maps "kind:canon" to attempts above zero."""
    kind, canon = part["kind"], part["canon"]
    fresh = write(kind, part["mention"], canon, _attempt(redrawn, kind, canon), key)
    return F.when(kind.isNull(), part["lead"]).otherwise(F.concat(part["lead"], fresh))


def _matches(text: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(empty)


def attempts(mentioned: DataFrame, key: str) -> DataFrame:
    """Rows (kind, canon, attempt) of all distinct entities, without collisions.

    In each round, of the entities that drew one surrogate the first by canonical form keeps it;
    the others, and any whose surrogate is itself an entity, draw again.
    """
    width = parallelism(mentioned)
    table = materialize(mentioned.select("kind", "canon").distinct()
                        .withColumn("attempt", F.lit(0)), "pii-entities")
    real = table.select("kind", F.col("canon").alias("drawn"))
    for _ in range(MAX_ROUNDS):
        # Drawing costs far more than reading: the entities are dealt out and drawn once.
        drawn = materialize(table.repartition(width, "kind", "canon").withColumn("drawn", F.lower(
            write(F.col("kind"), F.col("canon"), F.col("canon"), F.col("attempt"), key))),
            "pii-drawn")
        first = drawn.groupBy("kind", "drawn").agg(F.min("canon").alias("first"))
        taken = real.withColumn("taken", F.lit(True))
        judged = drawn.join(first, ["kind", "drawn"]).join(taken, ["kind", "drawn"], "left")
        again = judged.filter("canon <> first OR taken").select("kind", "canon")
        again = materialize(again, "pii-collisions")
        if again.isEmpty():
            return table
        table = materialize(
            table.join(again.withColumn("again", F.lit(1)), ["kind", "canon"], "left")
            .select("kind", "canon", (F.col("attempt") + F.coalesce("again", F.lit(0)))
                    .alias("attempt")), "pii-entities")
    raise RuntimeError(f"Surrogates still collide after {MAX_ROUNDS} rounds.")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """All rows with surrogates in their texts, plus ``n_pii``, the number of entities replaced.

    Texts without an entity come back as they are, null as null (n_pii 0). The same key gives
    the same surrogates in every run over the same documents. Repeated or null ids are allowed.
    """
    kept = [c for c in docs.columns if c != "n_pii"]
    mentions = docs.select(
        F.col(id_col).alias("id"),
        F.explode(F.flatten(F.transform(
            F.flatten(F.transform(_matches(F.col(text_col)), pieces)), parts))).alias("part"),
    ).filter("part.kind IS NOT NULL").select("id", "part.kind", "part.canon")
    chosen = attempts(mentions, key)
    redrawn = materialize(chosen.filter("attempt > 0"), "pii-redrawn")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    # The row travels as one column, so none of its names can clash with those used here.
    source = docs.select(
        F.struct(*(F.col(c).alias(str(at)) for at, c in enumerate(kept))).alias("row"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if redrawn.isEmpty():
        source = source.withColumn("redrawn", none)
    else:
        # One map per document that mentions such an entity; few, but never assumed to be few.
        maps = materialize(
            mentions.join(redrawn, ["kind", "canon"]).distinct().groupBy("id").agg(
                F.map_from_entries(F.collect_list(F.struct(
                    F.concat_ws(":", "kind", "canon"), "attempt"))).alias("redrawn")),
            "pii-maps").withColumnRenamed("id", "owner")
        source = source.join(maps, F.col("id").eqNullSafe(F.col("owner")), "left").withColumn(
            "redrawn", F.coalesce("redrawn", none))
    empty = F.array().cast(f"array<{_PIECE}>")
    found = source.withColumn("found", _matches(F.col("text")))
    gaps = F.split(F.col("text"), PATTERN, -1)
    found = found.withColumn("pieces", F.when(F.size("found") > 0, F.flatten(F.zip_with(
        gaps, F.col("found"), lambda gap, m: F.concat(
            F.array(_piece(F.lit(None), gap)),
            F.when(m.isNull(), empty).otherwise(pieces(m)))))).otherwise(empty))
    changed = F.transform(F.flatten(F.transform("pieces", parts)),
                          lambda part: replacement(part, F.col("redrawn"), key))
    text = F.when(F.size("pieces") > 0, F.array_join(changed, "")).otherwise(F.col("text"))
    count = F.size(F.filter("pieces", lambda piece: piece["kind"].isNotNull()))
    out = [text.alias(c) if c == text_col else F.col("row")[str(at)].alias(c)
           for at, c in enumerate(kept)]
    return found.select(*out, F.when(F.col("text").isNull(), 0).otherwise(count).alias("n_pii"))
