"""Licence scans by sentence rules, in DataFrame functions only.

Marks of comments go from the lines.  A text is then cut into sentences: at blank lines, before lines that begin as known
sentences do, after closing marks followed by white space (but not after abbreviations such as the one of "v. 2.0"), and
around SPDX tags, one for each identifier of their expressions; so sentences may go over several lines.  Each is normalised (lower
case, runs of other characters than a-z and 0-9 become one blank), and known sentences become identifiers; of an unknown one,
each line is looked up by itself.  The sequence of identifiers is then matched against the ordered rules: the first rule that
fits takes its identifiers out of the sequence, and the rest goes on to the next rule.

Defined results: null and empty texts, and texts without known sentences, give no identifiers and no licences; repeated
rows give a row each; a licence found twice is named once, in the order of the rules; sentences that are about licences
but not known, as a whole or by a line, count in n_unknown; an SPDX expression is read up to its third identifier.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

_WORK = "(?:this (?:work|file|program|software|project|code|library|package|document|content) is |it is |code is |distributed and )?"
#: SPDX identifiers that are named one by one (fixed values); a sentence and a rule come from each.
SPDX = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 Unlicense Zlib BSL-1.0 EPL-2.0 0BSD".split()
#: Known sentences (fixed values): identifier and pattern of the whole normalised sentence.
SENTENCES = (
    ("Apache2Ref", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?apache (?:software )?license(?: version)? 2(?: 0)?(?: the license)?"),
    ("Apache2Comply", "you may not use this file except in compliance with the license"),
    ("Apache2Copy", "you may obtain a copy of the license at.*"),
    ("Apache2Basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind.*"),
    ("Apache2See", "see the license for the specific language governing permissions and limitations under the license"),
    ("GplAny", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?gnu general public license"),
    ("Gpl3Ref", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?gnu general public license(?: gpl)? (?:version |v)3(?: 0)?(?: only| or later| or any later version)?"),
    ("Gpl2Ref", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?gnu general public license(?: gpl)? (?:version |v)2(?: 0)?(?: only| or later| or any later version)?"),
    ("GplFree", "(?:this program|this file|this library|this software|it) is free software(?: you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation.*)?"),
    ("GplEither3", "(?:you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation )?either version 3 of the license or (?:at your option )?any later version"),
    ("GplEither2", "(?:you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation )?either version 2 of the license or (?:at your option )?any later version"),
    ("LgplTerms", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license.*"),
    ("AgplTerms", "you can redistribute it and or modify it under the terms of the gnu affero general public license.*"),
    ("GplTerms", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation.*"),
    ("GplHope", "this (?:program|library|software) is distributed in the hope that it will be useful but without any warranty.*"),
    ("LgplRef", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?gnu (?:lesser|library) general public license.*"),
    ("AgplRef", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?gnu affero general public license.*"),
    ("MitRef", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?mit license"),
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("MitKeep", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("AsIs", "the software is provided as is without warranty of any kind.*"),
    ("NoLiable", "in no event shall the (?:authors or copyright holders|copyright (?:holder|owner)s? or contributors) be liable for any.*"),
    ("BsdRef", rf"{_WORK}(?:licensed|released|distributed|available) under the (?:terms of the )?(?:new |modified |simplified )?bsd(?: [23] clause)? license"),
    ("BsdGrant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("BsdSource", "(?:1 )?redistributions of source code must retain the above copyright notice.*"),
    ("BsdBinary", "(?:2 )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BsdEndorse", "(?:3 )?neither the name of .* may be used to endorse or promote products derived from this software.*"),
    ("BsdAsIs", "this software is provided by the (?:copyright holders|authors?|regents).* as is and any express or implied warranties.*"),
    ("IscGrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("Mpl2Ref", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("MplRef", rf"{_WORK}(?:licensed|released|distributed|available) under the mozilla public license(?: version)?(?: v)? 2(?: 0)?"),
    ("CcByNcSa", rf"{_WORK}(?:licensed|released|available) under (?:a |the )?(?:cc|creative commons) (?:by nc sa|attribution noncommercial sharealike)(?: [0-9] [0-9])?(?: international)?(?: license)?"),
    ("CcByNcNd", rf"{_WORK}(?:licensed|released|available) under (?:a |the )?(?:cc|creative commons) (?:by nc nd|attribution noncommercial noderivatives)(?: [0-9] [0-9])?(?: international)?(?: license)?"),
    ("CcByNc", rf"{_WORK}(?:licensed|released|available) under (?:a |the )?(?:cc|creative commons) (?:by nc|attribution noncommercial)(?: [0-9] [0-9])?(?: international)?(?: license)?"),
    ("CcBySa", rf"{_WORK}(?:licensed|released|available) under (?:a |the )?(?:cc|creative commons) (?:by sa|attribution sharealike)(?: [0-9] [0-9])?(?: international)?(?: license)?"),
    ("CcBy", rf"{_WORK}(?:licensed|released|available) under (?:a |the )?(?:cc|creative commons) (?:by|attribution)(?: [0-9] [0-9])?(?: international)?(?: license)?"),
    ("Cc0", ".*(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    ("PublicDomain", "(?:this .* )?(?:is )?(?:released into|in|dedicated to) the public domain"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
    *((f"Spdx{re.sub('[^A-Za-z0-9]', '', i)}", f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', i.lower())}") for i in SPDX),
    ("Spdx", "spdx license identifier .*"),
    ("Copyright", "copyright .*"),
    ("AllRights", "all rights reserved"),
)
#: Ordered rules (fixed values): licence and pattern over the sequence ``;Id;Id;``.
RULES = (
    ("Apache-2.0", ";(?:Apache2Ref;)(?:Apache2Comply;)?(?:Apache2Copy;)?(?:Apache2Basis;)?(?:Apache2See;)?"),
    ("Apache-2.0", ";Apache2Comply;Apache2Copy;(?:Apache2Basis;)?(?:Apache2See;)?"),
    ("AGPL", ";AgplRef;|;(?:GplFree;)?AgplTerms;(?:GplEither[23];)?(?:GplHope;)?"),
    ("LGPL", ";LgplRef;|;(?:GplFree;)?LgplTerms;(?:GplEither[23];)?(?:GplHope;)?"),
    ("GPL-3.0-or-later", ";GplFree;(?:GplTerms;)?GplEither3;(?:GplHope;)?"),
    ("GPL-2.0-or-later", ";GplFree;(?:GplTerms;)?GplEither2;(?:GplHope;)?"),
    ("GPL-3.0", ";Gpl3Ref;(?:GplHope;)?"),
    ("GPL-2.0", ";Gpl2Ref;(?:GplHope;)?"),
    ("GPL", ";GplAny;|;GplFree;(?:GplTerms;)?(?:GplHope;)?"),
    ("BSD-3-Clause", ";BsdGrant;BsdSource;BsdBinary;BsdEndorse;(?:BsdAsIs;)?(?:NoLiable;)?"),
    ("BSD-2-Clause", ";BsdGrant;BsdSource;BsdBinary;(?:BsdAsIs;)?(?:NoLiable;)?"),
    ("BSD", ";BsdRef;"),
    ("MIT", ";MitGrant;(?:MitKeep;)?(?:AsIs;)?(?:NoLiable;)?|;MitRef;(?:AsIs;)?"),
    ("ISC", ";IscGrant;(?:AsIs;)?"),
    ("MPL-2.0", ";Mpl2Ref;|;MplRef;"),
    ("CC-BY-NC-SA", ";CcByNcSa;"),
    ("CC-BY-NC-ND", ";CcByNcNd;"),
    ("CC-BY-NC", ";CcByNc;"),
    ("CC-BY-SA", ";CcBySa;"),
    ("CC-BY", ";CcBy;"),
    ("CC0-1.0", ";Cc0;"),
    ("Unlicense", ";Unlicense;"),
    ("Public-Domain", ";PublicDomain;"),
    *((i, f";Spdx{re.sub('[^A-Za-z0-9]', '', i)};") for i in SPDX),
    ("SPDX", ";Spdx;"),
    ("All-Rights-Reserved", ";(?:Copyright;)?AllRights;"),
)
#: What a sentence must speak of to be looked up, and what makes it licence talk.
ABOUT = "licen[sc]|copyright|redistribut|warrant|public domain|permission|free software|all rights reserved|merchantab|as is|spdx|cc0|creative commons|use this file|may obtain|in no event|either version|endorse or promote"


#: Where a sentence ends, after cutting.
END = "\x1e"
_BLANK = r"[ \t\r]*"
_OPENERS = r"copyright (?:\(c\)|©|[0-9])|(?:dual )?licensed under|permission (?:is hereby granted|to use)|redistribution and use|redistributions (?:of|in)|neither the name|the above copyright notice and|unless required by|you may (?:not use this|obtain)|this (?:program|file|library|project|work|package|code) is|this software is (?:free|licensed|released|distributed|provided)|this source code form|the software is provided|spdx-license-identifier|all rights reserved|see the license for"
#: What is done to a lower-cased text, in this order, to cut it: pattern and what takes its place (groups as \\1).
CUTS = (
    (rf"(^|\n){_BLANK}(?:/\*+|\*+/|//+|#+|\*+|;+|--+|<!--+|%+|dnl |rem )", r"\1"),
    (r"\*+/|--+>", " "),
    (r"\b(v|ver|inc|ltd|corp|co|no|vs|e\.g|i\.e)\.", r"\1 "),
    (r"spdx-license-identifier[ \t]*:", "spdx-license-identifier "),
    (r"(spdx-license-identifier[ \t(]+[a-z0-9.+-]+)[ \t)]+(?:or|and)[ \t(]+", r"\1" + END + "spdx-license-identifier "),
    (r"(spdx-license-identifier[ \t(]+[a-z0-9.+-]+)[ \t)]+(?:or|and)[ \t(]+", r"\1" + END + "spdx-license-identifier "),
    (r"(spdx-license-identifier[^\n]*)\n", r"\1" + END),
    (rf"\n{_BLANK}\n", END),
    (rf"\n{_BLANK}({_OPENERS})", END + r"\1"),
    (r"([.!?;:])[ \t\n\x0b\f\r]+", r"\1" + END),
)


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _known(s: Column) -> Column:
    found = F.lit("Unknown")
    for name, pattern in reversed(SENTENCES):
        found = F.when(s.rlike(f"^(?:{pattern})$"), name).otherwise(found)
    return found


def _identified(sentence: Column) -> Column:
    """The identifiers of a sentence: its own, or those of its lines, or Unknown; none if it doesn't speak of licences."""
    none = F.expr("cast(array() as array<string>)")
    lines = F.filter(F.transform(F.split(sentence, "\n"), _normal), lambda s: s.rlike(ABOUT))
    by_line = t.let(F.filter(F.transform(lines, _known), lambda i: i != "Unknown"), lambda ids: F.when(F.size(ids) > 0, ids).otherwise(F.array(F.lit("Unknown"))))
    whole = lambda s, i: F.when((i == "Unknown") & F.contains(sentence, F.lit("\n")), by_line).otherwise(F.array(i))
    return t.let(_normal(sentence), lambda s: F.when(s.rlike(ABOUT), t.let(_known(s), lambda i: whole(s, i))).otherwise(none))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, sentence_ids (array, in order), licenses (array, in the order of the rules), n_unknown."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    cut = text
    for pattern, new in CUTS:
        cut = F.regexp_replace(cut, pattern, new.replace("\\", "$"))
    none = F.expr("cast(array() as array<string>)")
    about = F.when(text.rlike(ABOUT.replace(" ", r"[^a-z0-9]+")), F.flatten(F.transform(F.split(cut, END), _identified))).otherwise(none)
    df = docs.select(F.col(id_col).alias("id"), about.alias("all_ids"))
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(p).alias("rule")) for name, p in RULES))
    doubled = F.concat(F.lit(";"), F.array_join(F.transform(F.filter("all_ids", lambda s: s != "Unknown"), lambda s: F.concat(s, F.lit(";"))), ""))
    start = F.struct(doubled.alias("seq"), none.alias("found"))

    def step(acc: Column, r: Column) -> Column:
        return F.struct(F.regexp_replace(acc["seq"], r["rule"], F.lit(";")).alias("seq"), F.when(F.regexp_like(acc["seq"], r["rule"]), F.array_union(acc["found"], F.array(r["name"]))).otherwise(acc["found"]).alias("found"))

    licenses = F.when(F.size(F.filter("all_ids", lambda s: s != "Unknown")) > 0, F.aggregate(rules, start, step, lambda acc: acc["found"])).otherwise(none)
    return df.select(
        F.col("id").alias(id_col),
        F.filter("all_ids", lambda s: s != "Unknown").alias("sentence_ids"),
        licenses.alias("licenses"),
        F.size(F.filter("all_ids", lambda s: s == "Unknown")).cast("long").alias("n_unknown"),
    )
