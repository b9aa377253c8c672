"""PII: detected entities get keyed surrogates, in DataFrame functions only."""

from __future__ import annotations

import hashlib
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import stored, text_key
from marketbars.llm.superkmers import order_id
from marketbars.session import ensure_checkpoint_dir, work_dir

# Titles and a few given names that tell a gender.
MALE = "Mr Herr Señor Sr Monsieur господин".split()
FEMALE = "Mrs Ms Miss Frau Señora Sra Madame Mme госпожа".split()
NEUTRAL = "Dr Prof Professor Professorin Doctor Doktor".split()
MEN = "James John Robert Michael David Thomas Peter Paul Hans Karl Jean Pierre Juan Carlos".split()
WOMEN = "Mary Anna Linda Susan Sarah Emma Julia Laura Maria Ursula Marie Claire Carmen Lucia".split()

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_UPPER = r"[\p{Lu}][\p{L}'’-]+"
_TITLES = "|".join(MALE + FEMALE + NEUTRAL)
_GIVEN = "|".join(MEN + WOMEN)
_SECRET = "token|secret|password|passwd|api[_-]?key|access[_-]?key|auth|bearer"
# Every entity begins where no letter or digit stands before: one test rules most places out.
_BEGIN = r"(?<![\p{L}\p{N}_])"
_END = r"(?![\p{L}\p{N}_])"
# Phones, the first that fits: bracketed or parted area code and two groups; behind a country code
# also longer or more groups, or none; pairs of two digits; ten or eleven digits in a row.
_PHONES = "|".join(
    (
        r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)",
        r"\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?|\d{1,5}[ .-])\d{2,4}(?:[ .-]\d{2,4}){2,4}(?!\d)",
        r"\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?|\d{1,5}[ .-])\d{3,5}[ .-]\d{3,5}(?!\d)",
        r"\+\d{1,3}[ .-]?\(0\)[ .-]?\d{1,5}(?:[ .-]\d{2,8}){1,4}(?!\d)",
        r"\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?|\d{1,5}[ .-])\d{5,8}(?!\d)",
        r"\+\d{1,3}[ .-]\d{7,12}(?!\d)",
        r"\+[1-9]\d{7,14}(?![.,]?\d)",
        r"\(\d{2,5}\)[ .-]?\d{3}(?:[ .-]\d{2}){2}(?!\d)",
        r"\(0\d{1,4}\)[ .-]?\d{5,8}(?!\d)",
        r"\([2-9]\d{2}\)[ .-]?\d{7}(?!\d)",
        r"(?<!\d[.,/-])0[1-9](?:[ .-]\d{2}){4}(?![ .,/-]?\d)",
        r"(?<!\d[.,/-])(?<!(?i:isbn)(?:-10)?:? ?)(?:[2-9]\d{9}|0[1-9]\d{8,9})(?![.,/-]?\d)",
    )
)
# Country codes are read from the left, as no code begins another.
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})"
# What is tested first, the entity, what must not follow; tried in this order at each beginning.
PATTERNS = {
    "email": ("", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", ""),
    "key": ("", r"(?:AKIA|ASIA)[A-Z0-9]{16}", _END),
    "secret": ("", r"(?:gh[opsu]_|sk-|pk-|xox[abp]-)[A-Za-z0-9_-]{16,}", ""),
    # Long hexadecimal numbers are secrets only behind a word that says so; else they are sums.
    "hex": (
        rf"(?=[0-9A-Fa-f]{{24}})(?<=(?i:{_SECRET})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?)",
        r"(?:[0-9a-f]{24,128}|[0-9A-F]{24,128})",
        _END,
    ),
    "ip": (r"(?<!\d\.)", rf"(?:{_OCTET}\.){{3}}{_OCTET}", r"(?!\.?\d)"),
    # Eight groups, or fewer around a double colon, with a figure among them.
    "ip6": (
        r"(?<![:.])(?=[0-9A-Fa-f:]*\d)",
        r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})",
        r"(?![:\p{L}\p{N}_])",
    ),
    "ssn": (r"(?<!\d-)", r"\d{3}-\d{2}-\d{4}", r"(?![\d-])"),
    "iban": ("", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?", _END),
    # Groups of four, or 4-6-5 and 4-6-4.
    "card": (
        r"(?<!\d-)",
        r"(?:[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,4}(?:\d{3})?|3\d{3}[ -]\d{6}[ -]\d{4,5})",
        r"(?![\d-])",
    ),
    "phone": (r"(?=[+(\d])(?<!\+)", rf"(?:{_PHONES})", r"(?!\d)"),
    "name": (
        rf"(?=[{''.join(sorted({n[0] for n in MALE + FEMALE + NEUTRAL + MEN + WOMEN}))}])",
        rf"(?:(?:{_TITLES})\.? (?:(?:{_TITLES})\.? )?(?:\p{{Lu}}\. )?{_UPPER}(?: {_UPPER}){{0,2}}"
        rf"|(?:{_GIVEN}) (?:\p{{Lu}}\. )?{_UPPER}(?: {_UPPER})?)",
        "",
    ),
}
ANY = f"{_BEGIN}(?:{'|'.join(''.join(parts) for parts in PATTERNS.values())})"
DIGITS_ONLY = ("phone", "card", "ssn")
# Letters that a surrogate's letters come from: by script and case, vowels and consonants apart.
ALPHABETS = (
    ("[aeiou]", "aeiou"),
    ("[b-df-hj-np-tv-z]", "bcdfghjklmnprstvwz"),
    ("[AEIOU]", "AEIOU"),
    ("[B-DF-HJ-NP-TV-Z]", "BCDFGHJKLMNPRSTVWZ"),
    ("[àáâäèéêëìíîïòóôöùúûü]", "àáéèíìóòúù"),
    ("[ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ]", "ÀÁÉÈÍÌÓÒÚÙ"),
    ("[аеёиоуыэюя]", "аеиоуыэюя"),
    ("[бвгджзйклмнпрстфхцчшщ]", "бвгджзклмнпрстфхцчш"),
    ("[АЕЁИОУЫЭЮЯ]", "АЕИОУЭЮЯ"),
    ("[БВГДЖЗЙКЛМНПРСТФХЦЧШЩ]", "БВГДЖЗКЛМНПРСТФХЦЧШ"),
    ("[αεηιουω]", "αεηιουω"),
    ("[βγδζθκλμνξπρστφχψ]", "βγδζθκλμνπρστφχ"),
    ("[0-9]", "0123456789"),
)
# A number that looks like a card's but has a wrong check digit: no entity.
NONE = "none"
# Rounds in which colliding surrogates are drawn anew in the entity's own format.
ATTEMPTS = 6
# Surrogates that one task draws.
DRAWN = 2000


def kind_of(value: Column) -> Column:
    """The first pattern that covers the whole value; of cards only those with a right digit."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    right = luhn(F.left(digits, F.length(digits) - 1)) == F.right(digits, F.lit(1))
    kind = F.lit("name")
    for name, (_, pattern, _) in reversed(PATTERNS.items()):
        named = F.when(right, name).otherwise(NONE) if name == "card" else F.lit(name)
        kind = F.when(F.regexp_like(value, F.lit(f"^(?:{pattern})$")), named).otherwise(kind)
    return kind


def canonical(kind: Column, value: Column) -> Column:
    """One spelling for all mentions: digits of numbers, addresses without case."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    abroad = (kind == "phone") & F.startswith(value, F.lit("+"))
    return (
        F.when(abroad, F.concat(F.lit("+"), digits))
        .when(kind.isin(*DIGITS_ONLY), digits)
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "ip6"), F.lower(value))
        .otherwise(value)
    )


def title_of(name: Column) -> Column:
    return F.regexp_extract(name, rf"^(?:(?:{_TITLES})\.? )*", 0)


def words_of(name: Column) -> Column:
    """The words of a name behind its titles."""
    return F.split(F.substr(name, F.length(title_of(name)) + 1), " ")


def known_names(key: str) -> dict[str, str]:
    """Given names by others of the same gender: all moved on by the same keyed number of places,
    so that no two become one and none stays."""
    number = int.from_bytes(hashlib.sha256(f"{key}\x00given".encode()).digest()[:8], "big")
    found = {}
    for names in (MEN, WOMEN):
        step = 1 + number % (len(names) - 1)
        found |= {n.lower(): names[(i + step) % len(names)].lower() for i, n in enumerate(names)}
    return found


def parts_of(kind: Column, value: Column, key: str) -> Column:
    """What is replaced by itself: kind, canon and, where the key alone tells it, core.

    Names go word by word, so that a surname has one surrogate in full names, behind titles and
    alone; known given names and initials are moved on in their lists.
    """
    given = F.create_map(*[F.lit(x) for pair in known_names(key).items() for x in pair])
    number = hashlib.sha256(f"{key}\x00initial".encode()).digest()[0]
    alphabet = string.ascii_lowercase
    step = 1 + number % 25
    moved = alphabet[step:] + alphabet[:step]

    def word(w: Column) -> Column:
        low = F.lower(w)
        initial = F.when(F.regexp_like(w, F.lit(r"^\p{Lu}\.$")), F.translate(low, alphabet, moved))
        return F.struct(
            F.lit("word").alias("kind"),
            low.alias("canon"),
            F.coalesce(F.element_at(given, low), initial).alias("core"),
        )

    none = F.lit(None).cast("string")
    whole = F.struct(kind.alias("kind"), canonical(kind, value).alias("canon"), none.alias("core"))
    return F.when(kind == "name", F.transform(words_of(value), word)).otherwise(F.array(whole))


def _draw(digest: Column, place: Column, letters: str) -> Column:
    """A letter of ``letters`` by the keyed digest's byte for this place."""
    byte = F.conv(F.substr(digest, place % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return F.substr(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _redrawn(text: Column, digest: Column, keep: Column | None = None, hexadecimal: bool = False):
    """Each letter and digit of ``text`` by another of its class; ``keep`` first ones stay."""

    def one(c: Column, i: Column) -> Column:
        if hexadecimal:
            new = F.when(F.regexp_like(c, F.lit("[a-f]")), _draw(digest, i, "abcdef"))
            new = new.when(F.regexp_like(c, F.lit("[A-F]")), _draw(digest, i, "ABCDEF"))
            new = new.when(F.regexp_like(c, F.lit("[0-9]")), _draw(digest, i, "0123456789"))
        else:
            new = F.when(F.lit(False), c)
            for pattern, letters in ALPHABETS:
                new = new.when(F.regexp_like(c, F.lit(pattern)), _draw(digest, i, letters))
        new = new.otherwise(c)
        return new if keep is None else F.when(i < keep, c).otherwise(new)

    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(letters, one), "")


def luhn(body: Column) -> Column:
    """The check digit of a card number without one."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(body)),
        F.lit(0),
        lambda held, i: held
        + F.when(
            (F.length(body) - i) % 2 == 0,
            F.substr(body, i, F.lit(1)).cast("int") * 2
            - F.when(F.substr(body, i, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substr(body, i, F.lit(1)).cast("int")),
    )
    return ((10 - total % 10) % 10).cast("string")


def core(kind: Column, canon: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a canonical value, in the same form, by the key and the attempt."""
    digest = F.sha2(F.concat_ws("\x00", F.lit(key), kind, canon, attempt.cast("string")), 512)
    drawn = _redrawn(canon, digest)
    tail = F.regexp_extract(canon, r"(\.[a-z]{2,})$", 1)
    octet = lambda i: F.conv(F.substr(digest, F.lit(2 * i + 1), F.lit(2)), 16, 10).cast("int")
    octets = [(octet(i) % 223 + 1).cast("string") for i in range(4)]
    country = F.length(F.regexp_extract(canon, _COUNTRY, 0))
    keep = F.when(country > 0, country).otherwise(F.greatest(F.length(canon) - 10, F.lit(0)))
    number = _redrawn(canon, digest, keep=keep)
    body = _redrawn(F.left(canon, F.length(canon) - 1), digest, keep=F.lit(1))
    return (
        F.when(kind == "email", F.concat(F.left(drawn, F.length(drawn) - F.length(tail)), tail))
        .when(kind == "ip", F.array_join(F.array(*octets), "."))
        .when(kind == "phone", number)
        .when(kind == "card", F.concat(body, luhn(body)))
        .when(kind == "key", _redrawn(canon, digest, keep=F.lit(4)))
        .when(kind == "secret", _redrawn(canon, digest, keep=F.lit(4)))
        .when(kind == "iban", _redrawn(canon, digest, keep=F.lit(2)))
        .when(kind.isin("hex", "ip6"), _redrawn(canon, digest, hexadecimal=True))
        .otherwise(drawn)
    )


def cased(model: Column, made: Column) -> Column:
    """``made`` with capitals where ``model`` has them; behind its end if it has nothing else."""
    capitals = (F.length(model) > 1) & (model == F.upper(model))
    letters = F.filter(F.split(made, ""), lambda c: c != "")

    def one(c: Column, i: Column) -> Column:
        upper = F.regexp_like(F.substr(model, i + 1, F.lit(1)), F.lit(r"\p{Lu}"))
        return F.when(upper | ((i >= F.length(model)) & capitals), F.upper(c)).otherwise(c)

    return F.array_join(F.transform(letters, one), "")


def rendered_name(value: Column, made: Column) -> Column:
    """A name's titles, and its words' surrogates in the case of the words."""
    words = F.zip_with(words_of(value), made, cased)
    return F.concat(title_of(value), F.array_join(words, " "))


def rendered(kind: Column, value: Column, made: Column) -> Column:
    """The surrogate as this mention writes it: its separators, its case.

    What a lengthened surrogate has beyond the mention's digits or letters follows behind them.
    """
    made = F.when(kind == "phone", F.ltrim(made, F.lit("+"))).otherwise(made)
    digits = F.transform(
        F.filter(F.split(value, ""), lambda c: c != ""),
        lambda c, i: F.when(
            F.regexp_like(c, F.lit("[0-9]")),
            F.substr(
                made, F.length(F.regexp_replace(F.left(value, i + 1), "[^0-9]", "")), F.lit(1)
            ),
        ).otherwise(c),
    )
    spaced = F.transform(
        F.filter(F.split(value, ""), lambda c: c != ""),
        lambda c, i: F.when(
            c != " ",
            F.substr(
                made, F.length(F.replace(F.left(value, i + 1), F.lit(" "), F.lit(""))), F.lit(1)
            ),
        ).otherwise(c),
    )
    used = F.when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(
        F.regexp_replace(value, "[^0-9]", "")
    )
    beyond = F.substr(made, F.length(used) + 1)
    return (
        F.when(kind.isin(*DIGITS_ONLY), F.concat(F.array_join(digits, ""), beyond))
        .when(kind == "iban", F.concat(F.array_join(spaced, ""), beyond))
        .when(kind.isin("email", "ip6"), cased(value, made))
        .when(kind != NONE, made)
    )


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, core: different entities get different surrogates, and none is a real one.

    Of entities that draw the same surrogate the least keeps it, unless a real entity of the
    corpus is called so; the others draw again. What still collides after ``ATTEMPTS`` rounds has
    a format too narrow for its entities, and gets a surrogate lengthened by its keyed hash.
    """
    spark = entities.sparkSession
    ensure_checkpoint_dir(spark)
    # Few bytes, but much work each: dealt by their number, not by their size.
    entities = entities.checkpoint()
    entities = entities.repartition(entities.count() // DRAWN + 1, "canon")
    real = entities.select("kind", F.col("canon").alias("core"))
    held = entities.withColumn("attempt", F.lit(0)).withColumn(
        "core", core(F.col("kind"), F.col("canon"), key, F.col("attempt"))
    )
    held = held.checkpoint()
    for attempt in range(1, ATTEMPTS + 1):
        first = held.groupBy("kind", "core").agg(
            F.min("attempt").alias("early"), F.min(F.struct("attempt", "canon")).alias("least")
        )
        taken = real.withColumn("taken", F.lit(True))
        judged = (
            held.join(first, ["kind", "core"])
            .join(taken, ["kind", "core"], "left")
            .withColumn(
                "lost",
                F.coalesce("taken", F.lit(False)) | (F.col("least.canon") != F.col("canon")),
            )
            .select("kind", "canon", "attempt", "core", "lost")
            .checkpoint()
        )
        lost = judged.filter("lost")
        if lost.isEmpty():
            return judged.select("kind", "canon", "core")
        again = lost.select("kind", "canon", F.lit(attempt).alias("attempt"))
        if attempt < ATTEMPTS:
            new = core(F.col("kind"), F.col("canon"), key, F.col("attempt"))
        else:
            mark = F.left(F.sha2(F.concat_ws("\x00", F.lit(key), "kind", "canon"), 256), F.lit(16))
            new = F.concat(core(F.col("kind"), F.col("canon"), key, F.col("attempt")), mark)
        again = again.withColumn("core", new)
        held = judged.filter("NOT lost").drop("lost").unionByName(again).checkpoint()
    return held.select("kind", "canon", "core")


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """All rows of ``docs`` with surrogates for private entities; adds ``n_entities``.

    Detected are e-mail addresses, access keys and tokens, IP addresses, card numbers with a
    right check digit, phone, social security and account numbers, and names behind a title or a
    known given name. A surrogate depends on the key and the entity alone, so that all mentions in
    all documents agree, however they are written; names agree word by word, so that a person's
    surname is the same with and without given name. Surrogates keep the entity's type, length,
    separators, script and case, the titles of names and the gender of known given names, the
    country code of numbers and a card's valid check digit.

    Texts without entities, null and empty ones stay as they are (0 entities). Equal rows get
    equal results. Only documents with an entity are shuffled; an entity that a third of all
    documents mention is one row of the surrogate table. An empty table gives no rows. Columns
    other than text are handed on; one named ``n_entities`` becomes ``n_entities_before``.
    """
    if "n_entities" in docs.columns:
        docs = docs.withColumnRenamed("n_entities", "n_entities_before")
    found = F.coalesce(F.regexp_like("text", F.lit(ANY)), F.lit(False))
    clean = docs.filter(~found).withColumn("n_entities", F.lit(0).cast("bigint"))
    # Texts are searched twice: for those without, and once for those with entities.
    keyed = stored(
        docs.filter(found).select(
            F.struct(*docs.columns).alias("row"),
            "text",
            order_id().alias("id"),
            text_key().alias("text_key"),
        ),
        work_dir(docs.sparkSession, "surrogates"),
    )
    mentions = keyed.select(
        "id",
        "text_key",
        F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("place", "value"),
    ).distinct()
    kind = kind_of(F.col("value"))
    typed = mentions.withColumn("kind", kind)
    parts = typed.select(
        "*", F.posexplode(parts_of(F.col("kind"), F.col("value"), key)).alias("part", "of")
    )
    unknown = (F.col("kind") != NONE) & F.col("of.core").isNull()
    made = distinct_surrogates(
        parts.filter(unknown).select("of.kind", "of.canon").distinct(), key
    ).withColumnsRenamed({"kind": "of_kind", "canon": "of_canon"})
    drawn = parts.join(
        made,
        unknown & (F.col("of.kind") == F.col("of_kind")) & (F.col("of.canon") == F.col("of_canon")),
        "left",
    )
    one = F.struct("part", F.coalesce("of.core", "core").alias("core"))
    mention = ["id", "text_key", "place", "value", "kind"]
    cores = F.transform(F.sort_array(F.collect_list(one)), lambda x: x["core"])
    whole = drawn.groupBy(*mention).agg(cores.alias("cores"))
    given = F.when(F.col("kind") == "name", rendered_name(F.col("value"), F.col("cores")))
    given = given.otherwise(rendered(F.col("kind"), F.col("value"), F.col("cores")[0]))
    given = F.coalesce(given, F.col("value"))
    replaced = (
        whole.select("id", "text_key", "kind", F.struct("place", given.alias("given")).alias("one"))
        .groupBy("id", "text_key")
        .agg(
            F.transform(F.array_sort(F.collect_set("one")), lambda x: x["given"]).alias("given"),
            F.sum((F.col("kind") != NONE).cast("bigint")).alias("n_entities"),
        )
    )
    pieces = F.split("text", ANY, -1)
    joined = F.concat(
        F.array_join(
            F.zip_with(F.slice(pieces, 1, F.size("given")), "given", lambda p, g: F.concat(p, g)), ""
        ),
        F.element_at(pieces, -1),
    )
    changed = keyed.join(replaced, ["id", "text_key"]).select(
        *[
            joined.alias("text") if c == "text" else F.col("row")[c].alias(c)
            for c in docs.columns
        ],
        replaced["n_entities"],
    )
    return clean.unionByName(changed)
