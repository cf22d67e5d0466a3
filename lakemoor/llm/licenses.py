"""Licence scan by ordered signature rules, in DataFrame functions only.

A text becomes its words, A-Z lower-cased, between single spaces. Texts without any of the
``ANCHORS`` are done at once. For the others, each rule whose keywords occur is run; its matches are
intervals. A match is suppressed if an interval of a rule of the same or a better priority contains
it (of equal intervals the earlier rule stays). Matches are sorted by start, longer first, so every
container comes earlier, and the furthest end so far for each priority decides. Running sums and
maxima go by blocks of ``BLOCK`` matches: within a block match by match, then over the blocks. So n
matches cost about n log n (blocks alone, a hundredth of them, are appended one by one). Nothing is
shuffled, joined or exploded.

The rules are one literal array. There are two kinds: written-out signatures (``NOTICES``) of whole
notices, and the forms in which licences are referred to, each for all names.

Besides, the places of the base phrases are counted exactly, word by word.

Defined cases: null text counts as empty: no words, no labels (empty strings), score 0; a null or
repeated doc_id is a row like any other; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The base phrases, word by word, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label, keyword, how it is written (a regular expression over words), its SPDX identifier (likewise).
NAMES = [
    ("mit", "mit", "(?:expat )?mit", "mit"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0"),
    ("apache-1", "apache", "apache(?: software)?(?: license)?(?: version)? 1(?: [01])?", "apache 1 [01]"),
    ("gpl-3", "3", "(?:gnu )?(?:gpl|general public license)(?: version)? ?v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", "2", "(?:gnu )?(?:gpl|general public license)(?: version)? ?v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl", "gnu", "gnu (?:gpl|general public license)", "gpl"),
    ("lgpl", "l", "(?:gnu )?(?:lgpl|lesser general public license|library general public license)", "lgpl [23] [01](?: only| or later)?"),
    ("agpl", "a", "(?:gnu )?(?:agpl|affero general public license)", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "free doc", "(?:gnu )?free documentation license", "gfdl 1 [123]"),
    ("bsd-2", "bsd", "(?:2 clause|two clause|simplified|freebsd) bsd|bsd 2 clause", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:3 clause|three clause|new|modified|revised) bsd|bsd 3 clause", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:4 clause|four clause|original) bsd|bsd 4 clause", "bsd 4 clause"),
    ("bsd", "bsd", "bsd(?: style)?", "0bsd"),
    ("isc", "isc", "isc", "isc"),
    ("mpl-2", "2", "(?:mpl|mozilla public license)(?: version)? ?v?2(?: 0)?", "mpl 2 0"),
    ("mpl-1", "1", "(?:mpl|mozilla public license)(?: version)? ?v?1(?: [01])?", "mpl 1 [01]"),
    ("epl", "ecl", "eclipse public license(?: version)?(?: [12] 0)?", "epl [12] 0"),
    ("cddl", "common dev", "common development and distribution license", "cddl 1 [01]"),
    ("artistic", "artistic", "artistic license(?: version)?(?: [12](?: 0)?)?", "artistic [12] 0"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost", "boost", "boost software license(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python", "python", "python software foundation license(?: version)?(?: 2)?", "psf 2 0|python 2 0"),
    ("ofl", "font", "(?:sil )?open font license(?: version)?(?: 1 [01])?", "ofl 1 [01]"),
    ("eupl", "eu", "european union public licen[cs]e(?: version)?(?: 1 [12])?|eupl", "eupl 1 [12]"),
    ("odbl", "open data", "open (?:data commons )?(?:open )?database license", "odbl 1 0"),
    ("cc0", "c", "cc0|cc zero|creative commons zero", "cc0 1 0"),
    ("cc-by-nc-nd", "d", "cc by nc nd(?: [1-4] 0)?|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] 0)?", "cc by nc nd [1-4] 0"),
    ("cc-by-nc-sa", "sa", "cc by nc sa(?: [1-4] 0)?", "cc by nc sa [1-4] 0"),
    ("cc-by-nc-sa", "share", "creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?", "cc by nc sa"),
    ("cc-by-nc", "c", "cc by nc(?: [1-4] 0)?|creative commons attribution non ?commercial(?: [1-4] 0)?", "cc by nc [1-4] 0"),
    ("cc-by-nd", "d", "cc by nd(?: [1-4] 0)?|creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] 0)?", "cc by nd [1-4] 0"),
    ("cc-by-sa", "s", "cc by sa(?: [1-4] 0)?|creative commons attribution share ?alike(?: [1-4] 0)?", "cc by sa [1-4] 0"),
    ("cc-by", "c", "cc by(?: [1-4] 0)?|creative commons attribution(?: [1-4] 0)?", "cc by [1-4] 0"),
    ("public-domain", "public domain", "public domain", "public domain"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("upl", "universal permissive", "universal permissive license", "upl 1 0"),
    ("afl", "academic free", "academic free license", "afl 3 0"),
    ("osl", "open software", "open software license", "osl 3 0"),
    ("sspl", "server side", "server side public license", "sspl 1 0"),
    ("busl", "business source", "business source license", "busl 1 1"),
]
#: Kind, priority (0 is best), keyword, the expression around a name, weight.
FORMS = [
    ("spdx", 0, "spdx", "spdx license identifier (?:{spdx})", 1.0),
    ("licensed", 1, "licensed under", "licensed under (?:a |an |the )?(?:terms of the )?(?:{name})(?: licen[cs]e)?(?: version [0-9](?: [0-9])?)?", 0.95),
    ("released", 1, "ed under", "(?:released|published) under (?:a |an |the )?(?:terms of the )?(?:{name})(?: licen[cs]e)?(?: version [0-9](?: [0-9])?)?", 0.95),
    ("distributed", 1, "distributed under", "distributed under (?:a |an |the )?(?:terms of the )?(?:{name})(?: licen[cs]e)?(?: version [0-9](?: [0-9])?)?", 0.95),
    ("available", 1, "available under", "(?:made )?available under (?:a |an |the )?(?:terms of the )?(?:{name})(?: licen[cs]e)?", 0.9),
    ("terms", 2, "the terms of the", "(?:subject to|under) the terms of the (?:{name})(?: licen[cs]e)?", 0.9),
    ("field", 2, "licen", "licen[cs]e (?:is |type )?(?:the )?(?:{name})", 0.7),
    ("mention", 3, "licen", "(?:{name}) licen[cs]e", 0.6),
]
#: Signatures: label, priority, weight, keyword (which every match holds), expression.
NOTICES = [
    (label, int(priority), keyword, expression, float(weight))
    for label, priority, weight, keyword, expression in (
        line.split("|", 4)
        for line in r"""
mit|1|1|hereby granted|permission is hereby granted free of charge to any person obtaining a copy
mit|1|0.9|to deal in the software|to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
mit|1|0.9|permission notice shall|the above copyright notice and this permission notice shall be included in all copies
mit|2|0.6|provided as is|the software is provided as is without warranty of any kind express or implied
mit-0|1|1|no attribution|mit no attribution
isc|1|1|permission to use|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
postgresql|1|1|written agreement|permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
hpnd|2|0.9|and its documentation|permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose
x11|2|0.8|except as contained|except as contained in this notice the names? of
bsd|1|1|redistribution|redistribution and use in source and binary forms with or without modification are permitted
bsd|2|0.9|must retain the above|redistributions of source code must retain the above copyright notice
bsd|2|0.9|must reproduce the above|redistributions in binary form must reproduce the above copyright notice
bsd-3|1|0.95|neither the name|neither the names? of (?:the )?(?:copyright holders?|authors?|university|organization|company|project) nor the names of (?:its|any|his|their) contributors may be used
bsd-4|1|0.95|advertising materials|all advertising materials mentioning features or use of this software must display
bsd|2|0.8|express or implied warranties|this software is provided by the (?:copyright holders and contributors|regents and contributors|authors?) as is and any express or implied warranties
bsd|3|0.5|direct indirect incidental|in no event shall the (?:copyright (?:holders?|owners?)|authors?|regents)(?: or contributors| and contributors)? be liable for any direct indirect incidental
apache-2|1|0.9|compliance|you may not use this file except in compliance with the license
apache-2|1|0.9|required by applicable law|unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2|1|0.95|contributor license agreements|licensed to the apache software foundation asf under one or more contributor license agreements
apache-2|1|1|january 2004|apache license version 2 0 january 2004
apache-2|1|0.95|apache org licenses|(?:www )?apache org licenses license 2 0
apache-1|1|0.95|developed by the apache|this product includes software developed by the apache (?:group|software foundation)
gpl|1|0.95|free software|this program is free software you can redistribute it and or modify it
gpl-2|1|0.95|either version 2|either version 2 of the license or at your option any later version
gpl-3|1|0.95|either version 3|either version 3 of the license or at your option any later version
lgpl|1|0.95|either version 2 1|either version 2 1 of the license or at your option any later version
gpl|1|0.9|gnu general public license|you should have received a copy of the gnu general public license
lgpl|1|0.95|received a copy of the gnu l|you should have received a copy of the gnu (?:lesser|library) general public license
agpl|1|0.95|received a copy of the gnu affero|you should have received a copy of the gnu affero general public license
gpl|2|0.6|implied warranty of|in the hope that it will be useful but without any warranty without even the implied warranty of
gpl|1|0.9|verbatim copies|everyone is permitted to copy and distribute verbatim copies of this license document
gpl|2|0.9|gnu org|(?:www )?gnu org (?:licenses|copyleft) gpl
lgpl|2|0.9|gnu org|(?:www )?gnu org (?:licenses|copyleft) lgpl
gpl-classpath|1|0.9|statically or dynamically|linking this (?:library|program) statically or dynamically with other modules
gfdl|1|0.95|modify this document|permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl|1|0.9|invariant sections|with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
mpl-2|1|1|source code form is subject|this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2|1|0.9|copy of the mpl|if a copy of the mpl was not distributed with this file
mpl-2|1|0.9|secondary licenses|this source code form is incompatible with secondary licenses
mpl-1|1|0.95|mozilla public license version 1|the contents of this file are subject to the mozilla public license version 1 [01]
mpl|2|0.8|mozilla org mpl|(?:www )?mozilla org mpl
epl|1|0.95|eclipse public license|made available under the terms of the eclipse public license
epl|2|0.9|eclipse org legal|(?:www )?eclipse org legal epl
cddl|1|0.95|common development|the contents of this file are subject to the terms of the common development and distribution license
cpl|2|0.9|common public license|common public license(?: version)? 1 0
ipl|2|0.9|ibm public license|ibm public license(?: version)? 1 0
perl|1|0.9|same terms as perl|(?:it )?under the same terms as perl(?: itself)?
zlib|1|0.9|authors be held liable|in no event will the authors be held liable for any damages
zlib|1|1|origin of this software|the origin of this software must not be misrepresented
zlib|1|1|plainly marked|altered source versions must be plainly marked as such
boost|1|1|august 17th 2003|boost software license version 1 0 august 17th 2003
boost|2|0.9|boost org license|(?:www )?boost org license 1 0
unlicense|1|1|unencumbered|this is free and unencumbered software released into the public domain
unlicense|1|0.95|anyone is free to copy|anyone is free to copy modify publish use compile sell or distribute this software
unlicense|2|0.9|unlicense org|unlicense org
wtfpl|1|1|what the fuck|do what the fuck you want to public license
wtfpl|1|0.9|verbatim or modified copies|everyone is permitted to copy and distribute verbatim or modified copies of this license document
beerware|1|0.9|ware license|beer ?ware license
beerware|1|0.9|me a beer|you can buy me a beer in return
json|1|0.95|good not evil|the software shall be used for good not evil
python|1|0.95|psf is making python|psf is making python available to licensee on an as is basis
python|2|0.8|psf license agreement|psf license agreement
ofl|1|0.95|this font software|this font software is licensed under the sil open font license
ofl|2|0.6|reserved font name|with reserved font names?
eupl|2|0.9|eupl|(?:licensed|published) under the eupl
odbl|1|0.95|open database license|made available under the open database license
odbl|2|0.9|opendatacommons|opendatacommons org licenses odbl
odc-by|2|0.9|opendatacommons|opendatacommons org licenses by
odc-by|2|0.9|open data commons|open data commons attribution licen[cs]e
pddl|2|0.9|public domain dedication|(?:open data commons )?public domain dedication and licen[cs]e
cc0|1|0.95|to the extent possible under law|to the extent possible under law
cc0|1|1|publicdomain zero|creativecommons org publicdomain zero
cc0|2|0.8|no rights reserved|no rights reserved
cc0|2|0.8|cc0|cc0(?: 1 0)?
public-domain|1|0.95|publicdomain mark|creativecommons org publicdomain mark
public-domain|2|0.9|public domain|(?:released|dedicated|placed) (?:in)?to the public domain
public-domain|2|0.9|public domain|(?:this work |is )?in the public domain
public-domain|2|0.8|copyright|no copyright(?: is)? claimed
cc-by|1|1|creativecommons org licenses by|creativecommons org licenses by [1-4] [05]
cc-by-sa|1|1|creativecommons org licenses by sa|creativecommons org licenses by sa [1-4] [05]
cc-by-nc|1|1|creativecommons org licenses by nc|creativecommons org licenses by nc [1-4] [05]
cc-by-nd|1|1|creativecommons org licenses by nd|creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa|1|1|creativecommons org licenses by nc sa|creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd|1|1|creativecommons org licenses by nc nd|creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc|2|0.8|cc by nc|cc by nc(?: [1-4] 0)?
cc-by-sa|2|0.8|cc by sa|cc by sa(?: [1-4] 0)?
cc|3|0.5|creative commons|creative commons licen[cs]e
cc|3|0.4|some rights reserved|some rights reserved
cecill|2|0.9|cecill|cecill(?: [abc])?(?: free software)? licen[cs]e
ms-pl|2|0.9|ms pl|microsoft public license ms pl
nasa|2|0.9|nasa open|nasa open source agreement
ecl|2|0.9|educational community|educational community license(?: version)?(?: [12] 0)?
ncsa|2|0.9|ncsa|(?:university of illinois )?ncsa open source license
openssl|1|0.9|openssl project|this product includes software developed by the openssl project
php|1|0.9|php software|this product includes php software
php|2|0.9|php license|php license(?: version)?(?: 3 0 ?1?)?
w3c|2|0.9|w3c software|w3c software (?:notice and license|and document notice)
zope|2|0.9|zope public|zope public license
sleepycat|2|0.9|sleepycat|sleepycat license
qpl|2|0.9|q public license|q public license
vim|2|0.9|vim license|vim license
sspl|1|0.95|server side public|server side public license(?: version)? 1
busl|2|0.8|additional use grant|additional use grant
elastic|2|0.9|elastic license|elastic license(?: v?2(?: 0)?)?
commons-clause|1|0.95|commons clause|commons clause license condition
commons-clause|1|0.9|grant of rights|the grant of rights under the license will not include
polyform|2|0.9|polyform|polyform (?:noncommercial|small business|shield|strict|perimeter|internal use) license
openrail|2|0.9|rail license|(?:creativeml |bigscience )?(?:bloom )?(?:open ?)?rail license
openrail|2|0.9|rail m|(?:creativeml |bigscience )?(?:bloom )?(?:open ?)?rail m(?: license)?
llama|2|0.9|community license agreement|llama [234](?: [0-9])? community license agreement
gemma|2|0.8|gemma terms|gemma terms of use
ogl-uk|2|0.9|open government|open government licen[cs]e
crown|3|0.6|crown copyright|crown copyright
etalab|2|0.9|licence ouverte|licence ouverte(?: open licence)?
dl-de|2|0.9|datenlizenz|datenlizenz deutschland
fal|2|0.9|licence art libre|licence art libre
fal|2|0.9|free art license|free art license
opl|2|0.9|open publication|open publication license
ogl|2|0.9|open game|open game license(?: version)?(?: 1 0a?)?
noncommercial|2|0.7|commercial use only|non ?commercial use only
noncommercial|2|0.7|not for commercial|not for commercial (?:use|purposes|resale)
noncommercial|3|0.5|al use only|for personal(?: non ?commercial)? use only
noncommercial|3|0.5|private|for private(?: non ?commercial)? use only
noncommercial|3|0.5|purposes only|for (?:educational|research|academic|non ?commercial) purposes only
proprietary|2|0.8|confidential|confidential and proprietary
proprietary|2|0.8|proprietary|this software is proprietary
proprietary|1|0.9|strictly prohibited|unauthorized (?:copying|reproduction|distribution) of this (?:file|document|work)(?: via any medium)? is strictly prohibited
proprietary|2|0.7|permission|(?:may|must) not be (?:reproduced|copied|distributed)(?: in any form)? without(?: the)?(?: prior)?(?: express)?(?: written)? permission
proprietary|2|0.7|redistribution|not for redistribution
proprietary|3|0.5|internal use only|internal use only
proprietary|3|0.6|end user|end user licen[cs]e agreement
proprietary|3|0.4|rights reserved|all rights reserved
proprietary|3|0.4|vorbehalten|alle rechte vorbehalten
proprietary|3|0.4|tous droits|tous droits (?:réservés|reserves)
proprietary|3|0.4|derechos reservados|todos los derechos reservados
permission|3|0.4|with permission|(?:reprinted|reproduced|used) with permission
copyright|3|0.3|copyright|copyright (?:c )?(?:19|20)[0-9][0-9]
no-warranty|3|0.3|warranty|without warranty of any kind
""".strip().splitlines()
    )
]
#: Words of which most signatures hold one for certain: so few keywords tell that a text has no match at all.
STEMS = ["licen", "software", "copyright", "permission", "public", "reserved", "distribut", "commons", "this file", "gnu org", "warrant"]
#: Matches that running sums and maxima take one by one.
BLOCK = 64


def certain(expression: str) -> str:
    """The text that every match holds: what stands outside groups, classes and quantified letters, which become line ends."""
    out, depth = "", 0
    for i, c in enumerate(expression):
        depth += c in "(["
        out += c if depth == 0 and c not in "?*+" and expression[i + 1 : i + 2] not in ("?", "*") else "\n"
        depth -= c in ")]"
    return "" if "|" in out else out


def rules() -> list[tuple[int, int, str, str, str, float, str]]:
    """(order, priority, keyword of the form, keyword of the name, expression, weight, label): the forms by priority, each for all names in order."""
    out = []
    for _, priority, keyword, form, weight in FORMS:
        for label, key, name, spdx in NAMES:
            key = key if "{name}" in form else keyword  # an SPDX identifier need not hold the long name's keyword
            out.append((priority, keyword, key, form.format(name=name, spdx=spdx), weight, label))
    out += [(priority, next((x for x in STEMS if x in certain(expression)), keyword), keyword, expression, weight, label) for label, priority, keyword, expression, weight in NOTICES]
    out.sort(key=lambda r: r[0])
    return [(i, *r) for i, r in enumerate(out)]


#: A text with no such string has no match of any rule or base phrase: the keywords of forms and notices, without those that hold another.
ANCHORS = sorted({r[2] for r in rules()} | set(BASE))
ANCHORS = [a for a in ANCHORS if not any(b != a and b in a for b in ANCHORS)]


def spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


#: Priorities are 0 to this, exclusive.
PRIORITIES = 4


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once, however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def blocks(xs: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements."""
    starts = lambda a: F.slice(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(BLOCK)), F.lit(1), F.ceil(F.size(a) / BLOCK).cast("int"))
    return let(xs, lambda a: F.transform(starts(a), lambda i: F.slice(a, i, F.lit(BLOCK))))


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda acc, x: acc + x)


def running(xs: Column, own: bool = True, zero: Column | None = None, plus: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """For each element the sum (``plus``) of the elements so far, its own included or not."""
    zero = F.lit(0) if zero is None else zero
    none = F.slice(F.array(zero), F.lit(1), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        now = plus(acc["total"], x)
        return F.struct(now.alias("total"), F.concat(acc["out"], F.array(now if own else acc["total"])).alias("out"))

    return F.aggregate(xs, F.struct(zero.alias("total"), none.alias("out")), step, lambda acc: acc["out"])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (contract columns), and detections (the matches that stay: start and end in words' text, label)."""
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), NOT_WORD, " ")), F.lit(" "))
    lowered = F.lower("p")
    gate = F.lit(False)
    for anchor in ANCHORS:
        gate = gate | F.contains(F.col("l"), F.lit(anchor))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    d = df.select(F.col(id_col).alias("id"), padded.alias("p")).withColumn("l", lowered)
    d = d.select("id", "p", F.when(F.length("p") > 2, (spaces(F.col("p")) - 1).cast("long")).otherwise(0).alias("n_words"), gate.alias("gate"))
    d = d.withColumn("low", F.when(F.col("gate"), F.translate("p", upper, upper.lower())).otherwise(""))

    n_base, firsts, lasts, base = F.lit(0).cast("long"), [], [], []
    for phrase, label in BASE.items():
        segments = F.when(F.contains(F.col("low"), F.lit(f" {phrase} ")), F.split("low", f" {phrase}(?= )", -1))
        d = d.withColumn(label, segments)
        n_base = n_base + F.coalesce(F.size(F.col(f"`{label}`")).cast("long") - 1, F.lit(0))
        firsts.append(spaces(F.col(f"`{label}`")[0]).cast("long"))
        lasts.append(F.col("n_words") - (spaces(F.element_at(F.col(f"`{label}`"), -1)).cast("long") - 1) - len(phrase.split()))
        base.append(F.when(F.col(f"`{label}`").isNotNull(), F.lit(label)))
    base_labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*base))))

    by_keyword: dict[str, list[dict]] = {}
    for i, p, k1, k2, x, w, lab in rules():
        by_keyword.setdefault(k1, []).append({"i": i, "p": p, "k": k2, "x": f"(?<= )(?:{x})(?= )", "w": w, "lab": lab})
    table = F.from_json(F.lit(json.dumps([{"k": k, "r": r} for k, r in by_keyword.items()])), "array<struct<k:string,r:array<struct<i:int,p:int,k:string,x:string,w:double,lab:string>>>>")
    held = lambda x: F.contains(F.col("low"), x["k"])
    fired = F.filter(F.flatten(F.transform(F.filter(table, held), lambda g: g["r"])), held)

    def matches(r: Column) -> Column:
        between = F.split(F.col("low"), r["x"], -1)

        def placed(found: Column) -> Column:
            steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda a, b: F.length(a) + F.length(b))
            ends = let(blocks(steps), lambda every: F.flatten(F.zip_with(every, running(F.transform(every, total), own=False), lambda block, before: F.transform(running(block), lambda e: e + before))))
            return F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("b"), (-e).alias("ne"), r["p"].alias("p"), r["i"].alias("i"), r["lab"].alias("lab"), r["w"].alias("w")))

        return let(F.regexp_extract_all("low", r["x"], F.lit(0)), placed)

    all_matches = F.array_sort(F.flatten(F.transform(fired, matches)))
    no_match = F.expr("cast(array() as array<struct<b:int,ne:int,p:int,i:int,lab:string,w:double>>)")
    d = d.withColumn("found", F.when(F.col("gate"), all_matches).otherwise(no_match))
    furthest = lambda block, p: F.coalesce(F.array_max(F.transform(F.filter(block, lambda m: m["p"] <= p), lambda m: -m["ne"])), F.lit(-1))
    d = d.withColumn("blocks", blocks(F.col("found")))
    tops = F.transform("blocks", lambda block: F.array(*[furthest(block, p) for p in range(PRIORITIES)]))
    d = d.withColumn("before", running(tops, own=False, zero=F.array(*[F.lit(-1)] * PRIORITIES), plus=lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y))))

    def staying(block: Column, before: Column) -> Column:
        contained = lambda m, i: F.exists(F.slice(block, F.lit(1), i), lambda c: (c["p"] <= m["p"]) & (c["ne"] <= m["ne"]))
        return F.filter(block, lambda m, i: (before[m["p"]] < -m["ne"]) & ~contained(m, i))

    kept = F.transform(F.flatten(F.zip_with("blocks", "before", staying)), lambda m: F.struct(m["b"].alias("start"), (-m["ne"]).alias("end"), m["lab"].alias("label"), m["w"].alias("weight")))
    d = d.withColumn("base", base_labels).withColumn("n_base", n_base).withColumn("detections", kept)
    labels = F.array_sort(F.array_union("base", F.transform("detections", lambda m: m["label"])))
    weight = F.coalesce(F.array_max(F.transform("detections", lambda m: m["weight"])), F.lit(0.0))
    return d.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(weight, F.when(F.col("n_base") > 0, F.lit(0.9)).otherwise(F.lit(0.0))).alias("score"),
        "detections",
    )
