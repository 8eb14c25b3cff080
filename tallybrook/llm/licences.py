"""Licences of texts by their sentences.

A text is cut into sentences at line ends, semicolons and full stops before white space. A sentence is
lowered, everything but ASCII letters and digits becomes one space, and a copyright sentence loses its names
and years. Known sentences have identifiers of one character; unknown ones become ``-``. A rule is an ordered
sequence of identifiers, and a text has its licence where the sequence occurs in the text's own one
without other sentences in between. A long rule's text holds no shorter rule unless it says so itself. A reservation of
all rights right before a grant is the grant's own, and a grant that is denied is none.

Before that, known sentences are put on lines of their own: those of ``SENTENCES`` where they are whole but
wrapped, those of ``STANDARD`` (the usual wordings of licences and their notices) wherever their words follow one
another, with any signs, line ends and comment marks between them. ``SQL`` knows whole unwrapped sentences only, so it
agrees on texts without standard wordings.

Defined results: a null, empty or unknown text has no licences and an empty list; texts are taken whole; repeated
rows are reported each; a rule counts once per text, and licences come in the order of the rules; an empty table gives no rows.
"""

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

# Sentences as they stand after normalising, and their identifiers.
SENTENCES = {
    "released under the mit license": "a",
    "licensed under the mit license": "a",
    "licensed under the apache license version 2 0": "b",
    "released under the apache license version 2 0": "b",
    "you may not use this file except in compliance with the license": "c",
    "you may obtain a copy of the license at": "d",
    "http www apache org licenses license 2 0": "e",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "f",
    "the above copyright notice and this permission notice shall be included in all copies": "g",
    "the software is provided as is without warranty of any kind": "h",
    "copyright": "i",
    "redistribution and use in source and binary forms are permitted": "j",
    "redistributions of source code must retain the above copyright notice": "k",
    "redistributions in binary form must reproduce the above copyright notice": "l",
    "released under the bsd license": "m",
    "licensed under the bsd license": "m",
    "released under the gnu general public license version 3": "n",
    "licensed under the gnu general public license version 3": "n",
    "this program is free software": "o",
    "released under the mozilla public license version 2 0": "p",
    "released under creative commons attribution 4 0": "q",
    "licensed under creative commons attribution 4 0": "q",
    "all rights reserved": "r",
    "this program is licensed under the gnu general public license version 3": "n",
    "this work is licensed under the gnu general public license version 3": "n",
    "licensed under cc by nc 4 0": "s",
}
# Ordered rules.
RULES = (
    ("MIT", "a"), ("MIT", "fgh"), ("MIT", "fg"), ("Apache-2.0", "b"), ("Apache-2.0", "cde"), ("BSD-2-Clause", "jkl"), ("BSD", "m"),
    ("GPL-3.0", "n"), ("GPL-3.0", "on"), ("MPL-2.0", "p"), ("CC-BY-4.0", "q"), ("CC-BY-NC-4.0", "s"),
    ("proprietary", "ir"),
)
CUT = r"[\n\r;]+|\.(?=\s)|\.$"
# Further sentences and rules, which the SQL does not have.
MORE = {
    "released under the gnu general public license version 2": "v", "released under the gnu lesser general public license version 2 1": "w",
    "released under the gnu lesser general public license version 3": "x", "released under the gnu affero general public license version 3": "y",
    "released under the gnu library general public license version 2": "8",
    "neither name may be used to endorse or promote products": "t", "all advertising materials must display the following acknowledgement": "u",
    "released under the isc license": "z", "released into the public domain": "0", "released under the zlib license": "1",
    "released under the boost software license version 1 0": "2", "licensed under creative commons attribution sharealike 4 0": "3",
    "released under cc0 1 0 universal": "4", "licensed under creative commons attribution noncommercial sharealike 4 0": "5",
    "licensed under creative commons attribution noderivatives 4 0": "6",
    "licensed under creative commons attribution noncommercial noderivatives 4 0": "7",
    "released under the bsd 2 clause license": "A", "released under the bsd 3 clause license": "B",
}
MORE_RULES = (
    ("MIT-0", "fh"), ("BSD-3-Clause", "jklt"), ("BSD-4-Clause", "jklu"), ("GPL-2.0", "v"), ("LGPL-2.0", "8"), ("LGPL-2.1", "w"), ("LGPL-3.0", "x"),
    ("AGPL-3.0", "y"), ("ISC", "z"), ("Unlicense", "0"), ("Zlib", "1"), ("BSL-1.0", "2"), ("CC-BY-SA-4.0", "3"), ("CC0-1.0", "4"),
    ("CC-BY-NC-SA-4.0", "5"), ("CC-BY-ND-4.0", "6"), ("CC-BY-NC-ND-4.0", "7"),
    ("BSD-2-Clause", "A"), ("BSD-3-Clause", "B"),
)
# A sequence that is part of a longer one, by what must not follow: clauses of BSD, and grants after a reservation.
PART_OF = {"jkl": "[tu]", "ir": "[abcfjmnopqsvwxyz0-8AB]"}
_GPL = r"(?:this (?:program|library|software|file) )?is free software you can redistribute it and or modify it under the terms of the "
_BY = r"(?: as published by the free software foundation)?(?: either)?(?: in)? version "
_LATER = r"(?: of the license)?(?: or at your option any later version)?"
# A grant by name, unless it is denied or over.
_DENIED = r"(?<!\b(?:not|never|nor|longer|formerly|previously)(?:[^A-Za-z0-9]{1,3}(?:be|been|being|yet))?[^A-Za-z0-9]{1,3})"
_GRANTED = rf"(?=(?:licensed|released|distributed|available|provided|dedicated) ){_DENIED}[A-Za-z]+ under (?:(?:the )?terms (?:and conditions )?of )?(?:an? |the )?"
_CC = rf"(?:this work is )?{_GRANTED}creative commons attribution "
_V = "(?:version |v ?)?"
# Standard wordings, words apart by one blank; the sentence that each stands for.
STANDARD = (
    (r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files the software"
     r" to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"
     r" and or sell copies of the software and to permit persons to whom the software is furnished to do so)?(?: subject to the following conditions)?",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies(?: or substantial portions of the software)?",
     "the above copyright notice and this permission notice shall be included in all copies"),
    (r"the software is provided as is without warranty of any kind(?: express or implied including but not limited to the warranties of merchantability"
     r" fitness for a particular purpose and non ?infringement)?", "the software is provided as is without warranty of any kind"),
    (r"redistribution and use in source and binary forms (?:with or without modification )?are permitted(?: provided that the following conditions are met)?",
     "redistribution and use in source and binary forms are permitted"),
    (r"redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?",
     "redistributions of source code must retain the above copyright notice"),
    (r"redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer"
     r" in the documentation and or other materials provided with the distribution)?(?: and)?(?![A-Za-z])",
     "redistributions in binary form must reproduce the above copyright notice"),
    (r"neither the names? (?:[^ ]+ ){1,40}?may be used to endorse or promote products(?: derived from this software without specific prior written permission)?",
     "neither name may be used to endorse or promote products"),
    (r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment",
     "all advertising materials must display the following acknowledgement"),
    (r"licensed under the apache license version 2 0 the license", "licensed under the apache license version 2 0"),
    (r"apache license version 2 0 january 2004", "licensed under the apache license version 2 0"),
    *((x, x) for x in ("you may not use this file except in compliance with the license", "you may obtain a copy of the license at")),
    (r"https? www apache org licenses license 2 0", "http www apache org licenses license 2 0"),
    *(row for kind, version, note, date in (
        ("", "2", "2", "june 1991"), ("", "3", "3(?: 0)?", "29 june 2007"), ("lesser ", "2 1", "2 1", "february 1999"),
        ("lesser ", "3", "3(?: 0)?", "29 june 2007"), ("affero ", "3", "3(?: 0)?", "19 november 2007"), ("library ", "2", "2(?: 0)?", "june 1991"))
      for row in (
        (f"{_GPL}gnu {kind}general public license{_BY}{note}(?! [0-9]){_LATER}", f"released under the gnu {kind}general public license version {version}"),
        (f"gnu {kind}general public license version {version} {date}", f"released under the gnu {kind}general public license version {version}"))),
    (r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0", "released under the mozilla public license version 2 0"),
    (r"permission to use copy modify and (?:or )?distribute this software (?:and its documentation )?for any purpose with or without fee is hereby granted"
     r" provided that the above copyright notice and this permission notice appear in all copies", "released under the isc license"),
    (r"this is free and unencumbered software released into the public domain", "released into the public domain"),
    (r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"
     r"(?: subject to the following restrictions)?", "released under the zlib license"),
    (r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
     "released under the boost software license version 1 0"),
    *((f"{_CC}{kind}4 0(?: international)?(?: license)?", sentence) for kind, sentence in (
        ("", "licensed under creative commons attribution 4 0"), ("non ?commercial ", "licensed under cc by nc 4 0"),
        *((k, f"licensed under creative commons attribution {k}4 0") for k in (
            "sharealike ", "noderivatives ", "noncommercial sharealike ", "noncommercial noderivatives ")))),
    (rf"(?:{_GRANTED}(?:creative commons )?|creative commons legal code )cc0 1 0(?: universal)?", "released under cc0 1 0 universal"),
    *((f"{_GRANTED}{name}", sentence) for name, sentence in (
        ("mit licen[sc]e", "licensed under the mit license"), (f"apache (?:software )?licen[sc]e {_V}2 0", "licensed under the apache license version 2 0"),
        ("(?:new |simplified )?bsd licen[sc]e", "licensed under the bsd license"),
        *((f"bsd {n} clause(?: licen[sc]e)?", f"released under the bsd {n} clause license") for n in (2, 3)),
        *((f"(?:gnu )?(?:{kind}general public licen[sc]e|{short}) {_V}{note}(?! [0-9])", f"released under the gnu {kind}general public license version {version}")
          for kind, short, version, note in (
            ("", "gpl", "2", "2(?: 0)?"), ("", "gpl", "3", "3(?: 0)?"), ("lesser ", "lgpl", "2 1", "2 1"), ("lesser ", "lgpl", "3", "3(?: 0)?"),
            ("affero ", "agpl", "3", "3(?: 0)?"))),
        (f"mozilla public licen[sc]e {_V}2 0", "released under the mozilla public license version 2 0"),
        ("isc licen[sc]e", "released under the isc license"), ("zlib licen[sc]e", "released under the zlib license"),
        (f"boost software licen[sc]e {_V}1 0", "released under the boost software license version 1 0"))),
)
# The full stop of an initial in a copyright line, which ends no sentence.
_INITIAL = r"\.(?= +[A-Z][A-Za-z.])(?! +(?i:all) )(?<=(?i:copyright)[^\n\r;]{0,80}\b[A-Z]\.)"
# Every known sentence that may be wrapped or is in the table above has one of these.
_ANY = r"(?i)licen|permission|redistribut|software|rights|advertising|mozilla|cc0|creative|gpl|bsd"
_BETWEEN = "[^A-Za-z0-9]+"
# Steps behind one question: Spark resolves nested names one by one, in a hundred rounds at most.
TOGETHER = 5
# The number or letter of a clause, which would be a sentence of its own.
_ITEM = r"(?:(?<![A-Za-z0-9.])(?:[0-9]{1,2}[.)]|\(?[a-z0-9]\))\s+)?"


def needed(words: str) -> list[str]:
    """The words that every text with these ``words`` holds, long ones first: none of a group or with a choice in it."""
    before = None
    while before != words:
        before, words = words, re.sub(r"\([^()]*\)(?:[?*+]|\{[0-9,]+\}\??)?", " ", words)
    return sorted(set(re.findall(r"(?<!\S)[a-z0-9]+(?!\S)", words)), key=lambda x: (-len(x), x))


def _steps() -> list[tuple[str, str, str]]:
    """What is replaced, in this order: the words it needs, the pattern, and what comes in its place."""
    steps = [("copyright", _INITIAL, "")]
    for words, sentence in STANDARD:
        # Blanks stand for what lies between words, also where they are optional or belong to a class.
        body = words.replace("[^ ]+", "[A-Za-z0-9]+").replace(" ?", "[^A-Za-z0-9]*").replace(" ", _BETWEEN)
        steps.append((words, f"(?i){_ITEM}(?<![A-Za-z0-9]){body}(?![A-Za-z0-9])", f"\n{sentence}\n"))
    for sentence in (*SENTENCES, *MORE):
        if " " in sentence:
            body = sentence.replace(" ", _BETWEEN)
            steps.append((
                sentence, rf"(?i)(?<=^|[\n\r;]|\.\s)[^A-Za-z0-9\n\r;]*{body}[^A-Za-z0-9\n\r;.]*(?=$|[\n\r;]|\.\s|\.$)", f"\n{sentence}\n"))
    return steps


def _lined(text):
    """``text`` with its known sentences on lines of their own.

    Most steps find nothing in most texts. A few neighbouring ones are taken where the text so far has all words that one of
    them needs, which is a small part of the work of matching.
    """

    def taken(steps):
        def where_needed(x):
            held = reduce(or_, [reduce(and_, [F.contains(F.lower(x), F.lit(w)) for w in needed(words)]) for words, _, _ in steps])
            return F.when(held, reduce(lambda out, step: F.regexp_replace(out, *step[1:]), steps, x)).otherwise(x)

        return where_needed

    out, steps = text, _steps()
    for i in range(0, len(steps), TOGETHER):
        # The text so far gets a name, so that it is computed once for the question and for the replacements.
        out = F.transform(F.array(out), taken(steps[i : i + TOGETHER]))[0]
    return F.when(text.rlike(_ANY), out).otherwise(text)


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, licences (comma-joined), sentence_ids."""
    known = F.create_map(*(F.lit(x) for pair in (SENTENCES | MORE).items() for x in pair))

    def identify(sentence):
        plain = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
        return F.coalesce(F.try_element_at(known, F.regexp_replace(plain, "^copyright .*$", "copyright")), F.lit("-"))

    text = _lined(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Blank pieces lie between the ends of sentences; they are none.
    pieces = F.filter(F.split(text, CUT, -1), lambda s: s.rlike("[A-Za-z0-9]"))
    rows = docs.select("doc_id", F.array_join(F.transform(pieces, identify), "").alias("ids"))
    rules = (*RULES, *MORE_RULES)
    names = list(dict.fromkeys(name for name, _ in rules))

    def held(seq: str):
        return F.col("ids").rlike(f"{seq}(?!{PART_OF[seq]})") if seq in PART_OF else F.instr("ids", seq) > 0

    found = F.array_compact(F.array(*(
        F.when(reduce(or_, [held(seq) for n, seq in rules if n == name]), F.lit(name)) for name in names)))
    return rows.select(
        "doc_id", F.array_join(found, ",").alias("licences"), F.regexp_replace("ids", "-+", "-").alias("sentence_ids"))


def _sql() -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    names = list(dict.fromkeys(name for name, _ in RULES))
    cases = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(ids, '{seq}')" for n, seq in RULES if n == name) + f" THEN '{name}' END" for name in names)
    return rf"""
WITH pieces AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '\.(\s)', ';\1', 'g'), '[\n\r;]+|\.$'),
    lambda s: regexp_matches(s, '[A-Za-z0-9]')) AS p FROM documents
), named AS (
  SELECT doc_id, array_to_string(list_transform(p, lambda s: coalesce(MAP {{{pairs}}}[
    regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), '^copyright .*$', 'copyright')], '-')), '') AS ids
  FROM pieces
)
SELECT doc_id, coalesce(array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ','), '') AS licences,
  regexp_replace(coalesce(ids, ''), '-+', '-', 'g') AS sentence_ids
FROM named
"""


SQL = _sql()
