"""License scans by sentence rules, in DataFrame functions only.

1. A text that may name a license (`HINT`) is cut into sentences (at . ! ? before white space, and at blank lines).
2. A sentence is normalised: A-Z to lower case, every run of characters other than a-z, 0-9 and inner dots to one
   blank; then the parts that vary are taken out (`VARYING`: who is licensed, the verb, articles, versions' zeros, years
   and holders). The result is looked up in a map of known license sentences (`KNOWN`), long legal sentences by their
   first words (`LONG`), and names joined by "or", "and" or "with" one by one, if all are known. A sentence that isn't known is looked up line by line, as a notice may follow a line
   without a full stop. What is still unknown has the identifier `-`.
3. The identifiers in a row are matched against the license rules in their order: the first rule takes its runs of
   identifiers, the next one what is left, and so on. Hence a full license text is one license, and a sentence of it
   that stands alone falls to the weaker rule that names it.

Everything happens inside a row: no shuffle, no Python, memory bounded by one text.

Defined cases: null or empty text has no sentences and no licenses; a text without a hint has none either (its
identifiers aren't listed); a license that is named again is listed again, in the order of the text; equal rows have
equal results; an empty table gives an empty result; other columns, whatever their names, are carried along under `row`.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verbs of a sentence that names a license. (fixed values)
VERBS = ("licensed", "released", "distributed", "available", "provided", "published")
#: A text without any of these holds no known sentence: each entry below needs one.
HINT = rf"(?i)(?:{'|'.join(VERBS)})[^a-z0-9]+under|spdx|licen[sc]e|permission|redistribut|copyright|warranty|domain|reserved|applicable|hope[^a-z0-9]+that|received[^a-z0-9]+a[^a-z0-9]+copy|unencumbered|source[^a-z0-9]+code[^a-z0-9]+form|provided[^a-z0-9]+as|neither[^a-z0-9]+the[^a-z0-9]+name"
#: What each alternative of HINT holds in lower case: a cheaper test, made first.
STEMS = ("under", "spdx", "licens", "licenc", "permission", "redistribut", "copyright", "warranty", "domain", "reserved", "applicable", "hope", "received", "unencumbered", "source", "provided", "neither")

#: Names of licenses as they stand after `under`, without "license" and "version". (fixed values)
NAMES = {
    "MIT": ("mit", "expat", "mit expat", "x11"), "Apache-2.0": ("apache 2", "apache software 2", "asl 2"), "Apache": ("apache",),
    "GPL-2.0": ("gnu general public 2", "gnu gpl 2", "gpl 2"), "GPL-3.0": ("gnu general public 3", "gnu gpl 3", "gpl 3"), "GPL": ("gnu general public", "gnu gpl", "gpl"),
    "LGPL-2.1": ("gnu lesser general public 2.1", "gnu lgpl 2.1", "lgpl 2.1"), "LGPL-3.0": ("gnu lesser general public 3", "gnu lgpl 3", "lgpl 3"), "LGPL": ("gnu lesser general public", "gnu lgpl", "lgpl"),
    "AGPL-3.0": ("gnu affero general public 3", "gnu agpl 3", "agpl 3"), "AGPL": ("gnu affero general public", "gnu agpl", "agpl"), "GFDL-1.3": ("gnu free documentation 1.3", "gfdl 1.3"), "GFDL": ("gnu free documentation", "gfdl"),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"), "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"), "BSD": ("bsd",),
    "MPL-2.0": ("mozilla public 2", "mpl 2"), "MPL-1.1": ("mozilla public 1.1", "mpl 1.1"), "EPL-1.0": ("eclipse public 1", "epl 1"), "EPL-2.0": ("eclipse public 2", "epl 2"), "EUPL-1.2": ("european union public 1.2", "eupl 1.2"),
    "ISC": ("isc",), "Zlib": ("zlib",), "BSL-1.0": ("boost software 1", "boost 1"), "Unlicense": ("unlicense",), "Artistic-2.0": ("artistic 2",), "OFL-1.1": ("sil open font 1.1", "ofl 1.1"), "ODbL-1.0": ("open database 1", "odbl 1"), "CC0": ("cc0", "cc0 1", "cc0 universal", "creative commons zero"),
    "CC-BY": ("cc by", "creative commons attribution"), "CC-BY-SA": ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"), "CC-BY-NC": ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    "CC-BY-ND": ("cc by nd", "creative commons attribution noderivatives", "creative commons attribution no derivatives"), "CC-BY-NC-SA": ("cc by nc sa", "creative commons attribution noncommercial sharealike"), "CC-BY-NC-ND": ("cc by nc nd", "creative commons attribution noncommercial noderivatives"),
}
#: Whole sentences, normalised. (fixed values)
SENTENCES = {
    "you may not use this file except in compliance with the license": "APACHE_MAY_NOT", "under apache 2 compliance": "REF_Apache-2.0",
    "licensed to the apache software foundation asf under one or more contributor license agreements": "ASF_CONTRIBUTED", "see the notice file distributed with this work for additional information regarding copyright ownership": "ASF_NOTICE",
    "this project is in the public domain": "PUBLIC_DOMAIN", "this work is in the public domain": "PUBLIC_DOMAIN", "this file is in the public domain": "PUBLIC_DOMAIN", "this file is placed in the public domain": "PUBLIC_DOMAIN", "this work is placed in the public domain": "PUBLIC_DOMAIN",
    "released into the public domain": "PUBLIC_DOMAIN", "placed in the public domain": "PUBLIC_DOMAIN", "in the public domain": "PUBLIC_DOMAIN", "public domain": "PUBLIC_DOMAIN", "this work is dedicated to the public domain": "PUBLIC_DOMAIN",
    "all rights reserved": "RIGHTS", "copyright notice": "COPYRIGHT", "mit license": "REF_MIT", "the mit license": "REF_MIT", "apache license 2": "REF_Apache-2.0", "gnu general public license": "REF_GPL", "isc license": "REF_ISC", "the unlicense": "REF_Unlicense",
}
#: First words of long sentences, normalised. (fixed values)
LONG = {
    "you may obtain a copy of the license": "APACHE_OBTAIN",
    "unless required by applicable law or agreed to": "APACHE_ASIS",
    "permission is hereby granted free of charge to any person": "MIT_GRANT",
    "the above copyright notice and this permission notice": "MIT_NOTICE",
    "the software is provided as is without warranty of any kind": "MIT_ASIS",
    "in no event shall the authors or copyright holders": "MIT_LIABLE",
    "permission to use copy modify and or distribute this software": "ISC_GRANT",
    "the software is provided as is and the": "ISC_ASIS",
    "this program is free software you can redistribute it": "GPL_FREE",
    "this library is free software you can redistribute it": "LGPL_FREE",
    "this program is distributed in the hope that": "GPL_HOPE",
    "this library is distributed in the hope that": "GPL_HOPE",
    "you should have received a copy of the gnu": "GPL_COPY",
    "redistribution and use in source and binary forms": "BSD_REDIST",
    "redistributions of source code must retain the above copyright": "BSD_SOURCE",
    "redistributions in binary form must reproduce the above copyright": "BSD_BINARY",
    "neither the name of the copyright holder nor": "BSD_NAME",
    "this software is provided by the copyright holders": "BSD_ASIS",
    "this source code form is subject to the": "MPL_SUBJECT",
    "this is free and unencumbered software released into": "UNLICENSE_FREE",
}
KNOWN = SENTENCES | {f"under {form}{later}": f"REF_{name}" for name, forms in NAMES.items() for form in forms for later in ("", " or later", " or any later")}

#: What varies in a normalised sentence: (pattern, replacement) in order, in the common part of RE2 and Java.
VARYING = [
    (r"\blicence", "license"),
    (r" see (?:the )?(?:license|copying|notice|readme)(?: .*)?$", ""),
    (r"^the asf licenses this file to you under ", "under "),
    (r"^(?:this|the) [a-z]+ is ([a-z0-9. ]+) licensed$", "under $1"),
    (r"^license (?:is )?", "under "),
    (r"^(?:copyright .* )?all rights reserved$", "all rights reserved"),
    (r"^copyright (?:c )?[0-9].*$", "copyright notice"),
    (r"^[0-9]+\.? (redistributions|neither) ", "$1 "),
    (r"^neither the name of .* nor ", "neither the name of the copyright holder nor "),
    (rf"^(?:(?:this|the) (?:work|file|software|project|program|package|library|code|document) is )?(?:also )?(?:dual )?(?:made )?(?:{'|'.join(VERBS)}) under ", "under "),
    (r"^(under .*?)(?: the license)? you may not use this file except in compliance with the license$", "$1 compliance"),
    (r"^(under .*) at your option$", "$1"),
    (r"^spdx license identifier ", "under "),
    (r"^under (?:the )?(?:terms of )?(?:the |a |an )?", "under "),
    (r"\b(a?l?gpl)v([0-9])", "$1 $2"),
    (r"\b(?:version |v)([0-9])", "$1"),
    (r"([0-9])\.0\b", "$1"),
    (r"^(under .*?) license\b", "$1"),
    (r"^(under .*?)(?: the)? license\b", "$1"),
    (r"^under mit mit$", "under mit"),
    (r"^(under .* or (?:any )?later) version$", "$1"),
    (r"^(under c.*?)(?: [0-9.]+)?(?: international| unported| generic)?$", "$1"),
]
#: License rules in order: (pattern over identifiers, each between @ and a blank; what it says).
RULES = [
    (r"@MIT_GRANT @MIT_NOTICE @MIT_ASIS (?:@MIT_LIABLE )?", "MIT"),
    (r"@ISC_GRANT (?:@ISC_ASIS )?(?:@MIT_LIABLE )?", "ISC"),
    (r"(?:@ASF_CONTRIBUTED )?(?:@ASF_NOTICE )?@REF_Apache-2\.0 (?:@APACHE_MAY_NOT )?(?:@APACHE_OBTAIN (?:@- )?)?(?:@APACHE_ASIS )?", "Apache-2.0"),
    (r"@BSD_REDIST @BSD_SOURCE @BSD_BINARY @BSD_NAME (?:@BSD_ASIS )?", "BSD-3-Clause"),
    (r"@BSD_REDIST @BSD_SOURCE @BSD_BINARY (?:@BSD_ASIS )?", "BSD-2-Clause"),
    (r"@LGPL_FREE (?:@GPL_HOPE )?(?:@GPL_COPY )?", "LGPL"),
    (r"@GPL_FREE (?:@GPL_HOPE )?(?:@GPL_COPY )?", "GPL"),
    (r"@UNLICENSE_FREE ", "Unlicense"),
    (r"@MPL_SUBJECT ", "MPL"),
    (r"@REF_([A-Za-z0-9.-]+) ", "$1"),
    (r"@PUBLIC_DOMAIN ", "Public-Domain"),
    (r"(?:@COPYRIGHT )?@RIGHTS ", "Proprietary"),
    (r"(?:@(?:MIT|ISC|APACHE|BSD|GPL)_[A-Z_]+ )+", "Incomplete"),
]
#: Between the names of a sentence that gives several, and what may stand around each.
JOINED, AROUND = " (?:or|and|with) ", "^(?:the|either|both) | license$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"([.!?])[ \t\r]*\n|([.!?])[ \t]+|\n[ \t\r]*\n"


def normalised(sentence: Column) -> Column:
    out = F.regexp_replace(F.translate(sentence, UPPER, LOWER), r"\.+([^0-9]|$)", " $1")
    out = F.trim(F.regexp_replace(out, r"[^a-z0-9.]+", " "))
    for pattern, new in VARYING:
        out = F.regexp_replace(out, pattern, new)
    return out


def _table(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def identifiers(text: Column) -> Column:
    """The identifiers of a normalised sentence (several where it joins names), else null."""
    one = F.coalesce(F.try_element_at(_table(KNOWN), text), *[F.try_element_at(_table(LONG), F.substring_index(text, " ", n)) for n in sorted({len(k.split()) for k in LONG}, reverse=True)])
    names = F.split(F.substring(text, F.lit(len("under ") + 1), F.length(text)), JOINED)
    each = F.transform(names, lambda p: F.try_element_at(_table(KNOWN), F.concat(F.lit("under "), F.regexp_replace(p, AROUND, ""))))
    several = F.when(text.startswith("under ") & text.rlike(JOINED), F.when(~F.exists(each, lambda x: x.isNull()), each))
    return F.when(one.isNotNull(), F.array(one)).otherwise(several)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns: row (struct), sentences array<string> (identifiers), licenses array<string>; both never null."""
    none = F.array().cast("array<string>")
    stem = F.get(F.transform(F.array(F.lower(text)), lambda low: reduce(or_, [low.contains(w) for w in STEMS])), F.lit(0))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("_t"), (stem & F.col(text).rlike(HINT)).alias("_hint"))
    cut = F.split(F.regexp_replace("_t", BREAK, "$1$2\u0001"), "\u0001", -1)
    by_line = lambda s: F.flatten(F.transform(F.transform(F.split(s, "\n", -1), normalised), lambda x: F.coalesce(identifiers(x), F.array(F.lit("-")))))
    plain = F.transform(cut, lambda s: F.struct(normalised(s).alias("n"), s.alias("s")))
    known = F.transform(plain, lambda u: F.struct(identifiers(u["n"]).alias("id"), u["s"].alias("s")))
    units = F.flatten(F.transform(known, lambda u: F.coalesce(u["id"], by_line(u["s"]))))
    rows = rows.withColumn("sentences", F.coalesce(F.when(F.col("_hint"), units), none))
    left = F.array_join(F.transform("sentences", lambda s: F.concat(F.lit("@"), s, F.lit(" "))), "")
    for pattern, name in RULES:
        left = F.regexp_replace(left, pattern, f"<{name}> ")
    return rows.select("row", "sentences", F.regexp_extract_all(left, F.lit("<([^>]+)>"), F.lit(1)).alias("licenses"))
