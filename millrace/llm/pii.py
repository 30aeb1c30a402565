"""Surrogates for personal data, in DataFrame functions only.

Entities are found by one pattern (mail addresses, IP addresses, secrets, bank accounts, social security, phone and
card numbers, persons). A number of 13 to 19 digits is a card only if it begins with 2 to 6 and passes the Luhn test;
any other one is left alone. Persons are a title with up to three names, a given name of the lists (or of
`given_names`) with a surname, and up to three names after a phrase such as "my name is".

The same entity always gets the same surrogate, whatever its format or case (coreference): a keyed digest of its
canonical form gives every character. Surrogates keep type, format, letter case and script; cards pass the Luhn test.
Persons are replaced name by name: a name alone decides its surrogate, whatever title or names stand beside it, and the
ending shows the gender that the lists or the name's own ending give. Titles stay. Phone numbers keep their country
code, mail addresses their top-level domain, cards their first digit.

Distinctness is checked over the whole corpus: the distinct entities are written once, an entity whose surrogate is
also that of a smaller entity of its type, or equals an entity that occurs, is drawn anew until no collision is left.
Only redrawn entities need a join; all others get their surrogate from the key alone. Names grow by a syllable with
each draw; after some draws octets take any length, mail addresses more letters, phone and social security numbers more
digits, so a format with few values never runs out.

Rows are known by file and place, or numbered once in the checkpoint folder (common.numbered).

Defined cases: null text stays null; texts without entities are returned byte for byte; equal rows get equal texts;
ids may be null or repeat; an empty table gives an empty result; other columns, whatever their names, are carried along
under `row`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

# Patterns of each type, in order of preference.
EMAIL = r"(?=[^\s@])(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IP = r"(?=[0-9])(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
SECRET = r"(?=[0-9a-fAgs])(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])"
ACCOUNT = r"(?=[A-Z])(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
SSN = r"(?=[0-9])(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?=[0-9+(])(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?!\d)|(?=[+])(?<![\d+])\+\d{1,3}(?:[ .-]?\(?\d{2,5}\)?){2,5}(?!\d)"
CARD = r"(?=[0-9])(?<!\d)(?:\d{4}[ -]){3}\d{1,4}(?!\d)|(?=[0-9])(?<!\d)\d{13,19}(?!\d)"
# Titles, given names by gender, and phrases that a name follows.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mademoiselle", "Señor", "Señora", "Señorita", "господин", "госпожа", "κύριος", "κυρία")
MALE_NAMES = (
    "Alexander", "Andreas", "Andrew", "Anthony", "Antonio", "Carlos", "Charles", "Christopher", "Daniel", "David", "Edward", "Fernando", "François", "Friedrich", "George", "Heinrich", "Henry", "James", "Jean", "John", "Jorge", "Joseph", "José", "Juan", "Jürgen", "Karl", "Klaus", "Louis", "Luis",
    "Manuel", "Mark", "Matthew", "Michael", "Miguel", "Patrick", "Paul", "Pedro", "Peter", "Philippe", "Pierre", "Richard", "Robert", "Stefan", "Steven", "Thomas", "William", "Wolfgang", "Александр", "Владимир", "Дмитрий", "Иван", "Николай", "Γιώργος", "Δημήτρης",
)
FEMALE_NAMES = (
    "Alexandra", "Alice", "Anna", "Barbara", "Carmen", "Catherine", "Christine", "Claudia", "Elena", "Elizabeth", "Emily", "Emma", "Françoise", "Gabriela", "Gertrud", "Helen", "Isabel", "Jane", "Jennifer", "Jessica", "Julia", "Karen", "Katharina", "Laura", "Linda", "Lisa", "Margaret", "Maria",
    "María", "Marie", "Martha", "Mary", "Monika", "Nancy", "Nathalie", "Patricia", "Petra", "Sabine", "Sarah", "Sophie", "Stephanie", "Susan", "Susanne", "Ursula", "Victoria", "Екатерина", "Мария", "Наталья", "Светлана", "Ελένη", "Κατερίνα", "Μαρία",
)
PHRASES = ("[Mm]y name is", "[Nn]ame:", "[Dd]ear", "[Ii]ch heiße", "[Jj]e m’appelle", "[Jj]e m'appelle", "[Mm]e llamo", "меня зовут")
#: What each of these phrases holds, whatever its case.
HINTS = ("y name is", "ame:", "Dear", "dear", "ch heiße", "e m’appelle", "e m'appelle", "e llamo", "меня зовут")
NAME = r"\p{Lu}[\p{L}'’-]+"


def person(given_names: tuple[str, ...] = ()) -> str:
    """The pattern of persons; `given_names` are sought beside those of the lists."""
    known = (*MALE_NAMES, *FEMALE_NAMES, *given_names)
    starts = "".join(sorted({n[0] for n in (*TITLES, *known)}))
    return rf"(?=[{starts}])(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? {NAME}(?: {NAME}){{0,2}}|(?:{'|'.join(known)}) {NAME})|(?<=(?:{'|'.join(PHRASES)}) ){NAME}(?: {NAME}){{0,2}}"


TYPES = {"email": EMAIL, "ip": IP, "secret": SECRET, "account": ACCOUNT, "ssn": SSN, "phone": PHONE, "card": CARD}
#: Stands around entities while a text is cut.
MARK = "\u0001"
# Syllables of surrogate names by script, and the endings that show a gender.
SYLLABLES = {
    "latin": ("bel", "cor", "dan", "fel", "gar", "hol", "jor", "kel", "lam", "mor", "nel", "per", "ros", "sel", "tor", "val"),
    "cyrillic": ("бел", "вор", "дан", "гор", "зар", "кол", "лам", "мор", "нел", "пар", "рос", "сел", "тор", "фел", "хол", "яр"),
    "greek": ("βελ", "γορ", "δαν", "ζαρ", "θελ", "καλ", "λαμ", "μορ", "νελ", "παρ", "ροσ", "σελ", "τορ", "φιλ", "χαρ", "ψαλ"),
}
ENDINGS = {"latin": {"m": "us", "f": "ia", "": "en"}, "cyrillic": {"m": "ий", "f": "ия", "": "ов"}, "greek": {"m": "ος", "f": "ία", "": "ης"}}


#: Draws after which a format begins to grow.
GROWS = 2
PARTS = "array<struct<kind:string,canon:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def entity_type(e: Column) -> Column:
    """The first type whose pattern is all of the entity; `none` for numbers that are no cards."""
    out = None
    for name, pattern in TYPES.items():
        own = F.when(_is_card(e), F.lit("card")).otherwise(F.lit("none")) if name == "card" else F.lit(name)
        hit = e.rlike(rf"^(?:{pattern})$")
        out = F.when(hit, own) if out is None else out.when(hit, own)
    return out.otherwise(F.lit("person"))


def _is_card(e: Column) -> Column:
    digits = _digits(e)
    valid = (_luhn(F.left(digits, F.length(digits) - 1)) + F.right(digits, F.lit(1)).cast("int")) % 10 == 0
    return digits.rlike("^[2-6][0-9]{12,18}$") & valid


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, r"\D", "")


def canonical(kind: Column, e: Column) -> Column:
    """What coreferent mentions share. Phones: the last ten digits; persons are handled name by name."""
    digits = _digits(e)
    return (
        F.when(kind == "phone", F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "email", F.lower(e))
        .when(kind == "account", F.regexp_replace(e, " ", ""))
        .otherwise(e)
    )


def _script(e: Column) -> Column:
    return F.when(e.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(e.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _draw(digest: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest, i), F.lit(n)).cast("int")


def _pick(alphabet: str, digest: Column, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _draw(digest, i, len(alphabet)) + 1, F.lit(1))


def _letters(e: Column, digest: Column, hexadecimal: Column | None = None) -> Column:
    """Each letter and digit becomes one of its script and case; other characters stay."""

    def one(c: Column, i: Column) -> Column:
        low = F.lower(c)
        new = F.when(c.rlike("[0-9]"), _pick("0123456789", digest, i))
        if hexadecimal is not None:
            new = F.when(hexadecimal & c.rlike("[0-9a-f]"), _pick("0123456789abcdef", digest, i)).when(c.rlike("[0-9]"), _pick("0123456789", digest, i))
        new = new.when(low.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", digest, i)).when(low.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", digest, i)).when(low.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", digest, i))
        return F.when(new.isNull(), c).when(c != low, F.upper(new)).otherwise(new)

    return F.array_join(F.transform(F.split(e, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn test over digits without the last one (the check digit's place)."""
    n = F.length(digits)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when((n - i) % 2 == 0, (lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d))(F.substring(digits, i, F.lit(1)).cast("int"))).otherwise(F.substring(digits, i, F.lit(1)).cast("int")))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form; keeps its length and shape at the first draws. Names have three syllables and one more for each attempt."""
    return _let(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256), lambda digest: _drawn(kind, canon, attempt, digest))


def _drawn(kind: Column, canon: Column, attempt: Column, digest: Column) -> Column:
    # a format with few values grows: octets of any length from GROWS draws on, more letters before an address, more
    # digits behind a number
    more = lambda alphabet, n: F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _pick(alphabet, digest, i + 1000)), "")).otherwise(F.lit(""))
    digits = F.array_join(F.transform(F.split(canon, ""), lambda c, i: _pick("0123456789", digest, i)), "")
    longer = F.concat(digits, more("0123456789", attempt - 2 * GROWS))
    card = _let(F.concat(F.left(canon, F.lit(1)), F.substring(digits, F.lit(2), F.length(canon) - 2)), lambda body: F.concat(body, ((10 - _luhn(body) % 10) % 10).cast("string")))
    octet = lambda o, i: F.when(attempt >= GROWS, _draw(digest, i, 256)).when(F.length(o) == 3, 100 + _draw(digest, i, 156)).when(F.length(o) == 2, 10 + _draw(digest, i, 90)).otherwise(_draw(digest, i, 10)).cast("string")
    ip = F.array_join(F.transform(F.split(canon, r"\."), octet), ".")
    top = F.regexp_extract(canon, r"\.[^.]+$", 0)
    email = F.concat(more("abcdefghijklmnopqrstuvwxyz", attempt - GROWS + 1), _letters(F.substring(canon, F.lit(1), F.length(canon) - F.length(top)), digest), top)
    prefix = F.regexp_extract(canon, r"^(?:AKIA|gh[pousr]_|sk-)", 0)
    secret = F.concat(prefix, _letters(F.substring(canon, F.length(prefix) + 1, F.length(canon)), digest, hexadecimal=canon.rlike("^[0-9a-f]+$")))
    account = F.concat(F.left(canon, F.lit(2)), _letters(F.substring(canon, F.lit(3), F.length(canon)), digest))
    gender, script = _gender(canon), _script(canon)
    name = None
    for own, syllables in SYLLABLES.items():
        stem = F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: F.element_at(F.array(*map(F.lit, syllables)), _draw(digest, i, len(syllables)) + 1)), ""))  # noqa: B023
        ends = F.when(gender == "m", F.lit(ENDINGS[own]["m"])).when(gender == "f", F.lit(ENDINGS[own]["f"])).otherwise(F.lit(ENDINGS[own][""]))
        name = F.when(script == own, F.concat(stem, ends)) if name is None else name.when(script == own, F.concat(stem, ends))
    return F.when(kind == "name", name).when(kind == "card", card).when(kind.isin("phone", "ssn"), longer).when(kind == "ip", ip).when(kind == "email", email).when(kind == "account", account).otherwise(secret)


def _into_shape(e: Column, new: Column, what: str) -> Column:
    """The characters of `new`, from its end, in the places of those characters of `e` that match `what`."""
    start = F.struct(F.lit("").alias("s"), (F.length(new) - F.length(F.regexp_replace(e, f"[^{what}]", ""))).alias("n"))
    done = F.aggregate(F.split(e, ""), start, lambda a, c: F.when(c.rlike(f"[{what}]"), F.struct(F.concat(a["s"], F.when(a["n"] < 0, c).otherwise(F.substring(new, a["n"] + 1, F.lit(1)))).alias("s"), (a["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["n"].alias("n"))))
    return done["s"]


def _gender(name: Column) -> Column:
    """m, f or nothing, by the name alone."""
    return F.when(name.isin(*MALE_NAMES), F.lit("m")).when(name.isin(*FEMALE_NAMES) | name.rlike("[aаяα]$"), F.lit("f")).otherwise(F.lit(""))


def _name_kinds(e: Column) -> Column:
    """array<struct<kind, canon>> of a person's parts: a title if there is one, and the names."""
    title = F.regexp_extract(e, rf"^(?:{'|'.join(TITLES)})\.?(?= )", 0)
    names = F.transform(F.split(F.ltrim(F.substring(e, F.length(title) + 1, F.length(e))), " "), lambda n: F.struct(F.lit("name").alias("kind"), n.alias("canon")))
    return F.when(title == "", names).otherwise(F.concat(F.array(F.struct(F.lit("title").alias("kind"), title.alias("canon"))), names))


def _parts(e: Column) -> Column:
    """An entity's parts that get surrogates: itself, or a person's names."""
    return _let(entity_type(e), lambda kind: _typed_parts(kind, e))


def _typed_parts(kind: Column, e: Column) -> Column:
    return F.when(kind == "person", _name_kinds(e)).when(kind == "none", F.array().cast(PARTS)).otherwise(F.array(F.struct(kind.alias("kind"), canonical(kind, e).alias("canon"))))


def _written(e: Column, redrawn: Column | None, key: str) -> Column:
    def attempt(p: Column) -> Column:
        if redrawn is None:
            return F.lit(0)
        own = F.filter(redrawn, lambda r: (r["kind"] == p["kind"]) & (r["canon"] == p["canon"]))
        return F.coalesce(F.get(own, F.lit(0))["attempt"], F.lit(0))

    def shaped(parts: Column, new: Column) -> Column:
        kind, canon, first = F.get(parts, F.lit(0))["kind"], F.get(parts, F.lit(0))["canon"], F.get(new, F.lit(0))  # no part: not an entity
        cased = F.array_join(F.zip_with(F.split(e, ""), F.split(first, ""), lambda a, b: F.when(a != F.lower(a), F.upper(b)).otherwise(b)), "")
        return (
            F.when(kind.isNull(), e)
            .when(kind.isin("name", "title"), F.array_join(new, " "))
            .when(kind == "card", _let(first, lambda x: _into_shape(e, x, "0-9")))
            .when(kind.isin("phone", "ssn"), F.concat(_let(F.left(first, F.length(canon)), lambda x: _into_shape(e, x, "0-9")), F.substring(first, F.length(canon) + 1, F.length(first))))
            .when(kind == "account", _let(first, lambda x: _into_shape(e, x, "0-9A-Z")))
            .when(kind == "email", cased)
            .otherwise(first)
        )

    drawn = lambda p: F.when(p["kind"] == "title", p["canon"]).otherwise(surrogate(p["kind"], p["canon"], attempt(p), key))
    return _let(_parts(e), lambda parts: _let(F.transform(parts, drawn), lambda new: shaped(parts, new)))


def _collisions(drawn: DataFrame, real: DataFrame, settled: DataFrame | None) -> DataFrame:
    """Of `drawn` (kind, canon, attempt, new): rows to draw anew."""
    taken = drawn if settled is None else drawn.unionByName(settled)
    first = taken.groupBy("kind", "new").agg(F.min(F.struct("attempt", "canon")).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("kind", "new", F.col("_first.canon").alias("_keep"))
    twice = drawn.join(first, ["kind", "new"]).where(F.col("canon") != F.col("_keep")).select("kind", "canon", "attempt")
    known = real.select("kind", F.col("canon").alias("new"))
    return twice.unionByName(drawn.join(known, ["kind", "new"], "left_semi").select("kind", "canon", "attempt")).distinct()


def redrawn_entities(entities: DataFrame, key: str, most_rounds: int = 64) -> DataFrame | None:
    """kind, canon, attempt of the entities whose first surrogate collides; None where there are none."""
    draw = lambda df: df.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
    drawn = cut(draw(entities.select("kind", "canon").withColumn("attempt", F.lit(0))))
    settled, bad, out = None, cut(_collisions(drawn, drawn, None)), None
    for _ in range(most_rounds):
        if bad.isEmpty():
            return out
        good = drawn.join(bad, ["kind", "canon"], "left_anti")
        settled = good if settled is None else settled.unionByName(good)
        drawn = cut(draw(bad.withColumn("attempt", F.col("attempt") + 1)))
        bad = cut(_collisions(drawn, entities, settled))
        fine = drawn.join(bad, ["kind", "canon"], "left_anti").select("kind", "canon", "attempt")
        out = fine if out is None else out.unionByName(fine)
    raise ValueError("a type has as many entities as its format has values")


def _pieces(text: Column, given_names: tuple[str, ...]) -> Column:
    """The text cut at its entities, which have the odd places; null where the text can't hold one.

    The text is searched once, for persons only if it may hold one: marks are put around entities. A text that holds
    the mark itself is searched twice.
    """
    plain = "|".join(TYPES.values())

    def cut_at(pattern: str) -> Column:
        gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
        twice = F.flatten(F.zip_with(gaps, found, lambda g, e: F.when(e.isNull(), F.array(g)).otherwise(F.array(g, e))))
        return F.when(text.contains(MARK), twice).otherwise(F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1))

    told = "|".join([*[rf"{t}\.? " for t in TITLES], *[f"{n} " for n in given_names], *PHRASES])
    hint = reduce(or_, [text.contains(w) for w in (*TITLES, *given_names, *HINTS)])  # cheaper than the pattern
    persons = text.rlike(f"{NAME} {NAME}") | hint & text.rlike(told)
    others = text.rlike("[0-9@]") | text.contains("AKIA") | text.contains("sk-") | text.contains("gh") & text.contains("_") | text.rlike("[a-f]{32}")
    return F.when(persons, cut_at(f"{plain}|{person(given_names)}")).when(others, cut_at(plain))


def _odd(pieces: Column) -> Column:
    return F.filter(pieces, lambda x, i: i % 2 == 1)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", given_names: tuple[str, ...] = ()) -> DataFrame:
    """Columns: row (struct), text (with surrogates), entities array<struct<type, surrogate>> in text order."""
    rows = numbered(docs, F.struct("*").alias("row"), F.col(text).alias("_t"))
    found = rows.select("_rid", _odd(_pieces(F.col("_t"), given_names)).alias("_e")).where(F.size("_e") > 0)
    mentions = cut(found.select("_rid", F.explode(F.array_distinct(F.flatten(F.transform("_e", _parts)))).alias("_p")).select("_rid", "_p.*").where("kind <> 'title'"))
    again = redrawn_entities(mentions.select("kind", "canon").distinct(), key)
    out = rows
    if again is not None:
        lists = mentions.join(again, ["kind", "canon"]).groupBy("_rid").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("_again"))
        out = rows.join(lists, "_rid", "left")
    none = F.array().cast("array<struct<kind string, canon string, attempt int>>")
    redrawn = None if again is None else F.coalesce("_again", none)
    out = out.withColumn("_c", _pieces(F.col("_t"), given_names))
    written = lambda e: F.struct(entity_type(e).alias("type"), _written(e, redrawn, key).alias("surrogate"))
    out = out.withColumn("_s", F.when(F.size("_c") > 1, F.transform(_odd(F.col("_c")), written)))
    gaps = F.filter("_c", lambda x, i: i % 2 == 0)
    pieces = F.zip_with(gaps, F.col("_s"), lambda g, s: F.concat(g, F.coalesce(s["surrogate"], F.lit(""))))
    entities = F.coalesce(F.filter("_s", lambda s: s["type"] != "none"), F.array().cast("array<struct<type string, surrogate string>>"))
    return out.select("row", F.when(F.col("_s").isNull(), F.col("_t")).otherwise(F.array_join(pieces, "")).alias("text"), entities.alias("entities"))
