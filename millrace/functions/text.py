"""Column functions on names, cells and rows; all of them built-in expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Canonical columns of a harmonised table: key -> display name. (fixed values)
CANONICAL = {
    "lfd_nr": "lfd. Nr.",
    "massnahme": "Maßnahme",
    "kurze_projektbeschreibung": "kurze Projektbeschreibung",
    "projektkategorie": "Projektkategorie",
    "betriebsmittel": "Betriebsmittel",
    "leitungslaenge_km": "Länge des zugebauten, optimierten, oder ersetzten Leitungsabschnitts [km]",
    "kapazitaetsaenderung_mva": "Änderung der Übertragungskapazität [+/- MVA]",
    "netzbegruendung_1": "netztechnische Begründung für den Netzausbau 1. kurze Beschreibung",
    "netzbegruendung_2": "netztechnische Begründung für den Netzausbau 2. Aus welchem Grund erfolgt die Netzausbaumaßnahme überwiegend?",
    "engpass_bestehend_beheben": "Erfolgt diese Netzausbaumaßnahme, um einen bereits bestehenden Engpass zu beheben?",
    "engpass_prognose_vorbeugen": "Erfolgt diese Netzausbaumaßnahme, um einen prognostizierten Engpass vorzubeugen?",
    "optimaler_zeitpunkt": "optimaler Zeitpunkt der Fertigstellung aus Sicht der Netzplanung [JJJJ]",
    "baubeginn": "voraussichtlicher Zeitpunkt des Baubeginns [MM/JJJJ]",
    "inbetriebnahme": "voraussichtlicher Zeitpunkt der Inbetriebnahme [MM/JJJJ]",
    "verzoegerungsgrund": "Angabe des Verzögerungsgrundes a) bis g). Mehrfachnennung möglich",
    "verzoegerungsgrund_beschreibung": "Beschreibung angegebener Verzögerungsgrund",
    "kosten": "Kosten (geschätzt) in Euro",
    "projektstatus": "Projektstatus",
    "genehmigungsverfahren": "Stand Genehmigungsverfahren",
    "alternativen": "Geprüfte Alternativen zum Netzausbau",
    "netzebene": "Vorrangig betroffene Netz oder Umspannebene",
    "teilnetzgebiet": "Hauptsächlich betroffenes Teilnetzgebiet",
    "netzknoten_hoes": "von der Netzausbaumaßnahme betroffene(r) Netzknoten im überlagerten HöS-Netz",
}

#: Header rules in order, on the normalised header: (key, patterns that must all be found somewhere). (fixed values)
HEADER_RULES = [
    ("lfd_nr", (r"^(lfd\.? ?nr\.?|index)$",)),
    ("massnahme", (r"^(objekt/)?maßnahme$",)),
    ("projektkategorie", (r"^maßnahmenart$",)),
    ("kurze_projektbeschreibung", (r"kurze projektbeschreibung|^projektbeschreibung$",)),
    ("projektkategorie", (r"projektkategorie",)),
    ("betriebsmittel", (r"betriebsmittel",)),
    ("leitungslaenge_km", (r"leitungs|zubau|^länge des|^leitungslänge \[km\]$",)),
    ("kapazitaetsaenderung_mva", (r"kapazität|übertragungs",)),
    ("netzbegruendung_2", (r"netztechnische", r"begründ ?ung", r"2\.|welchem grund|überwiegend|\(grund\)|hauptgrund")),
    ("netzbegruendung_1", (r"netztechnische", r"begründ ?ung")),
    ("engpass_bestehend_beheben", (r"engpass", r"bereits|bestehend")),
    ("engpass_prognose_vorbeugen", (r"engpass",)),
    ("optimaler_zeitpunkt", (r"optimaler zeitpunkt|^benötigt bis$",)),
    ("inbetriebnahme", (r"inbetriebnahme|inbtrieb|^voraussichtliches bauende$",)),
    ("baubeginn", (r"baubeginn",)),
    ("verzoegerungsgrund_beschreibung", (r"verzögerungsgrund", r"beschreibung")),
    ("verzoegerungsgrund", (r"verzögerungsgrund",)),
    ("kosten", (r"kosten",)),
    ("projektstatus", (r"projektstatus",)),
    ("genehmigungsverfahren", (r"genehmigung",)),
    ("alternativen", (r"alternativ",)),
    ("netzebene", (r"umspann",)),
    ("netzebene", (r"netz", r"vorrangig")),
    ("teilnetzgebiet", (r"teilnetzgebiet",)),
    ("netzknoten_hoes", (r"netzknoten|hös-netz|^uw$",)),
]

#: Words that mark a column worth searching. (fixed values)
SEARCH_WORDS = ("maßnahme", "projektbeschreibung", "betriebsmittel", "uw", "objekt")

#: A row's fields that are left out of its serialised text. (fixed values)
UNSERIALISED = ("netztechnische", "begründung", "verzögerung", "kosten", "unnamed", "zeitpunkt", "measure_row_hash")

#: Cells that count as missing when a CSV is read. (fixed values)
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

#: Interchangeable terms for a substation. (fixed values)
SYNONYMS = ("UW", "Umspannwerk", "UA", "Station", "substation")


def strip(text: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def single_blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def normalize_header(name: Column) -> Column:
    joined = F.regexp_replace(F.regexp_replace(name, "­", ""), r"(?U)-\s+", "")
    return F.lower(strip(single_blanks(joined)))


def classify_header(name: Column) -> Column:
    """The canonical key of a raw header, or null."""
    n, out = normalize_header(name), F.lit(None).cast("string")
    for key, patterns in reversed(HEADER_RULES):
        out = F.when(reduce(and_, [n.rlike(p) for p in patterns]), F.lit(key)).otherwise(out)
    return out


def header_key(name: Column) -> Column:
    """The canonical key, or _extra_<normalised header>; a header that is blank stays as it is."""
    n = normalize_header(name)
    return F.when(n == "", name).otherwise(F.coalesce(classify_header(name), F.concat(F.lit("_extra_"), n)))


def is_data_cell(cell: Column) -> Column:
    s = strip(cell)
    return s.rlike(r"^[0-9]+([.,][0-9]+)?$|^[0-9]{1,2}/[0-9]{4}$|^UW ") | s.contains(" MVA")


def header_score(cells: Column) -> Column:
    """Three points for each cell that names a known column, less one for each cell that looks like data."""
    known = F.size(F.filter(cells, lambda c: classify_header(c).isNotNull()))
    return 3 * known - F.size(F.filter(cells, is_data_cell))


def known_value(cell: Column) -> Column:
    return F.when(~cell.isin(*MISSING), cell)


def told_apart(names: Column) -> Column:
    """An array of names in which all but the first of equal ones get ".1", ".2" and so on."""
    again = lambda h, i: F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == h))
    return F.transform(names, lambda h, i: F.when(again(h, i) == 0, h).otherwise(F.concat(h, F.lit("."), again(h, i).cast("string"))))


def serialize(fields: dict[str, Column], prefix: str) -> Column:
    """`prefix` and "name: value; ..." of the fields that aren't null."""
    return F.concat(F.lit(prefix), F.concat_ws("; ", *[F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in fields.items()]))


def serialized_row(columns: list[str], prefix: str = "query: ") -> Column:
    shown = [c for c in columns if not any(w in c.lower() for w in UNSERIALISED)]
    return serialize({c: F.col(f"`{c}`") for c in shown}, prefix)


def search_columns(columns: list[str]) -> list[str]:
    """Columns to search when none are named: those with a telling name, or else the first three."""
    telling = [c for c in columns if any(w in c.lower().replace("\n", " ") for w in SEARCH_WORDS)]
    return telling or columns[:3]


def similarity(a: Column, b: Column) -> Column:
    """0 to 100 by edit distance, on lower-cased text; 100 for equal texts, two empty ones included."""
    longest = F.greatest(F.char_length(a), F.char_length(b), F.lit(1))
    return F.round(100 * (1 - F.levenshtein(F.lower(a), F.lower(b)) / longest), 4)


def token_similarity(a: Column, b: Column) -> Column:
    """0 to 100: the better of the plain score, 95 % of that of the sorted words, and 90 where all words of one text,
    in order, stand inside the other as whole words (texts without a word left out)."""
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    line = lambda c: F.array_join(words(c), " ")
    spaced = lambda c: F.concat(F.lit(" "), line(c), F.lit(" "))
    ordered = similarity(F.array_join(F.array_sort(words(a)), " "), F.array_join(F.array_sort(words(b)), " "))
    inside = (line(a) != "") & (line(b) != "") & (spaced(a).contains(spaced(b)) | spaced(b).contains(spaced(a)))
    return F.greatest(similarity(a, b), F.round(ordered * 0.95, 4), F.when(inside, F.lit(90.0)).otherwise(F.lit(0.0)))


def page_ranges(raw: Column, pages: Column) -> Column:
    """"1-3, 7" -> array<struct<first, last>>; each part is a number or two around its first hyphen. Blank text, parts
    that are no numbers ("1-2-3"), and reversed or outside ranges raise an error."""
    number = lambda t: F.trim(t).try_cast("int")
    part = F.transform(F.split(raw, ","), lambda p: F.split(p, "-", 2))
    out = F.transform(part, lambda p: F.struct(number(F.get(p, F.lit(0))).alias("first"), number(F.element_at(p, -1)).alias("last")))
    odd = F.exists(out, lambda r: r["first"].isNull() | r["last"].isNull())
    bad = F.exists(out, lambda r: (r["first"] < 1) | (r["first"] > r["last"]) | (r["last"] > pages))
    error = lambda why: F.raise_error(F.concat(F.lit(why), raw)).cast(_RANGES)
    return F.when(F.trim(raw) == "", error("no page range")).when(odd, error("not a page range: ")).when(bad, error("page range out of bounds: ")).otherwise(out)


_RANGES = "array<struct<first:int,last:int>>"


def page_numbers(ranges: Column) -> Column:
    """The ranges' pages in order, each once."""
    return F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["first"], r["last"]))))


def vertical_lines(raw: Column) -> Column:
    return F.transform(F.filter(F.transform(F.split(raw, ","), strip), lambda x: x != ""), lambda x: x.cast("double"))


def nullable_flag(word: Column) -> Column:
    return F.when(word == "yes", True).when(word == "no", False)


def flag_word(flag: Column) -> Column:
    return F.when(flag.isNull(), "unset").when(flag, "yes").otherwise("no")


def id_text(value: Column) -> Column:
    whole = value == F.floor(value)
    return F.when(value.isNull(), "").when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def id_value(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit("")).cast("bigint")


def clue_list(text: Column) -> Column:
    """Lines without blanks around them; null if there is none."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return F.when(F.size(lines) > 0, lines)


def list_literal(text: Column) -> Column:
    """"['a', 'b']" -> array of strings; null if it isn't a list."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})


def asset_type(tag: Column) -> Column:
    return F.when(tag.contains("transformer_"), "substation").otherwise(tag)


def folder_name(number: Column, name: Column) -> Column:
    text = number.cast("string")
    padded = F.when(F.char_length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.concat_ws("_", padded, F.replace(name, F.lit("/"), F.lit("_")))


def folder_parts(folder: Column) -> tuple[Column, Column]:
    """Number and name of "<number>_<name>"; a folder without "_" is both."""
    return F.split_part(folder, F.lit("_"), F.lit(1)), F.regexp_replace(folder, "^[^_]*_", "")


def replace_in_order(text: Column, entries: Column) -> Column:
    """Each entry (code, name) in turn puts " (name)" behind every occurrence of its code; null names are skipped."""
    named = F.filter(entries, lambda e: e["name"].isNotNull())
    return F.aggregate(named, text, lambda t, e: F.replace(t, e["code"], F.concat(e["code"], F.lit(" ("), e["name"], F.lit(")"))))


def variants(name: Column, words: tuple[str, ...] = SYNONYMS) -> Column:
    """The name with each of the words in place of any of them; words are taken literally."""
    any_ = "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)
    return F.array(*[F.regexp_replace(name, any_, w.replace("\\", "\\\\").replace("$", "\\$")) for w in words])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays. The length is computed once, not for each component."""
    return F.get(F.transform(F.array(norm(a)), lambda n: F.transform(a, lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n))), F.lit(0))


def prefixed(tags: Column, prefix: str = "tag::") -> Column:
    """A map's keys under a prefix."""
    return F.transform_keys(tags, lambda k, v: F.concat(F.lit(prefix), k))


def page_coordinate(share: Column, size: Column) -> Column:
    """A point in 0..1 of the page -> whole points, cut off (not rounded)."""
    return (share * size).cast("int")


def with_prefix(settings: Column, prefix: str = "text_") -> Column:
    """The settings whose names begin with the prefix, without it."""
    own = F.map_filter(settings, lambda k, v: k.startswith(prefix))
    return F.transform_keys(own, lambda k, v: F.substring(k, F.lit(len(prefix) + 1), F.length(k)))


def settings_map(text: Column) -> Column:
    """A JSON object's values as text; null where the text is no JSON object."""
    clean = strip(text)
    return F.when(clean.startswith("{") & F.try_parse_json(clean).isNotNull(), F.from_json(clean, "map<string,string>"))


def settings_problem(text: Column) -> Column:
    """Why `settings_map` has no result: null where it has one."""
    return F.when(strip(F.coalesce(text, F.lit(""))) == "", F.lit("no settings")).when(settings_map(text).isNull(), F.lit("not a JSON object"))


def base64_text(content: Column) -> Column:
    """Base64 in one line."""
    return F.regexp_replace(F.base64(content), r"\s", "")


def label_key(row_hash: Column, candidate: Column) -> Column:
    return F.struct(row_hash.alias("row_hash"), candidate.alias("candidate"))


def way_url(way: Column, base: str = "https://www.openstreetmap.org/way/") -> Column:
    return F.concat(F.lit(base), way.cast("bigint").cast("string"))


def row_json(columns: list[str], by_name: bool = True) -> Column:
    """A row as one JSON object with nulls kept; columns in order of their names, or as given."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in (sorted(columns) if by_name else columns)]), {"ignoreNullFields": "false"})


def few_shot(rows: Column, answers: Column) -> Column:
    """Examples for a prompt: `row -> answer`, three line ends between examples."""
    return F.array_join(F.zip_with(rows, answers, lambda r, a: F.concat(r, F.lit(" -> "), a)), "\n\n\n")


def without_labels(columns: list[str], word: str = "label") -> list[str]:
    """The columns whose name doesn't hold the word."""
    return [c for c in columns if word not in c]


def display_order(columns: list[str], first: list[str]) -> list[str]:
    """The columns: those of `first` that exist, then the others, each once."""
    return list(dict.fromkeys([*[c for c in first if c in columns], *columns]))


def row_identity(columns: list[str]) -> Column:
    """The sum of all cells' hashes modulo 2^64: a cell's hash depends on its column's name, so order doesn't matter and
    null (0) differs from any value. A hash is the first eight bytes of the MD5 of name, unit separator and value."""

    def cell(c: str) -> Column:
        text = F.concat(F.lit(f"{c}\x1f"), F.col(f"`{c}`").cast("string"))
        return F.coalesce(F.conv(F.left(F.md5(text), F.lit(16)), 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))

    total = reduce(lambda a, b: (a + b).cast("decimal(38,0)"), [cell(c) for c in columns])
    return F.pmod(total, F.lit(str(2**64)).cast("decimal(38,0)")).cast("decimal(20,0)")
