"""Licence scans by sentence rules.

Texts are cut into sentences (full stops, question and exclamation marks before a blank, and lines without letters or
digits, such as blank lines or bare comment signs). Licence notices are wrapped, so a line end does not end a sentence:
a known sentence may run over several lines, with comment signs before each, and it may start at the start of a
sentence, of a line, or after a colon or semicolon. Sentences are normalised: lower case, every sign and blank run one
space, ``licence`` spelt ``license``. A start whose words equal a known licence sentence, or begin with it (after a
number or letter that counts clauses, if any), gives its identifier; of several, the longest. The identifiers of a text,
in order, form its sequence; an ordered list of rules, each a sequence of identifiers that must follow one another with
nothing known between, is matched against it, longer rules first, and identifiers that a rule has used are not matched
again.

Defined cases: null text counts as empty; repeated sentences are identifiers of their own, so a licence found twice is
counted twice; rows are scanned one by one, so repeated rows repeat their result; a known sentence outside all rules
is reported as ``unmatched``; signs outside ASCII count as letters when sentences are cut and as blanks when they are
normalised; a start looks at as many lines as the longest known sentence has words, which is exact, so time grows with
the text however long a sentence is; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Normalised openings of licence sentences and their identifiers; the longest that fits counts.
SENTENCES = (
    ("licensed under the apache license version 2 0", "Apache2Line"),
    ("licensed under the apache license version 2 0 the license", "Apache2Grant"),
    ("you may not use this file except in compliance with the license", "Apache2Comply"),
    ("you may obtain a copy of the license at", "Apache2Copy"),
    ("unless required by applicable law or agreed to in writing software", "Apache2AsIs"),
    ("released under the mit license", "MitLine"),
    ("licensed under the mit license", "MitLine"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "MitGrant"),
    ("the above copyright notice and this permission notice shall be included in all copies", "MitNotice"),
    ("the software is provided as is without warranty of any kind", "AsIs"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "ZeroBsdGrant"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that", "IscGrant"),
    ("the software is provided as is and the author disclaims all warranties", "IscAsIs"),
    ("this work is licensed under the gnu general public license version 3", "Gpl3Line"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "GplGrant"),
    ("this program is distributed in the hope that it will be useful but without any warranty", "GplHope"),
    ("you should have received a copy of the gnu general public license", "GplCopy"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "LgplGrant"),
    ("this library is distributed in the hope that it will be useful but without any warranty", "LgplHope"),
    ("you should have received a copy of the gnu lesser general public license", "LgplCopy"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "AgplGrant"),
    ("you should have received a copy of the gnu affero general public license", "AgplCopy"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "BsdGrant"),
    ("redistributions of source code must retain the above copyright notice", "BsdSource"),
    ("redistributions in binary form must reproduce the above copyright notice", "BsdBinary"),
    ("all advertising materials mentioning features or use of this software", "BsdAds"),
    ("neither the name of", "BsdName"),
    ("this software is provided by", "BsdAsIs"),
    ("this source code form is subject to the terms of the mozilla public license", "Mpl2Grant"),
    ("if a copy of the mpl was not distributed with this file you can obtain one at", "Mpl2Copy"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "EplGrant"),
    ("this is free and unencumbered software released into the public domain", "UnlicenseGrant"),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "BoostGrant"),
    ("distributed under the boost software license version 1 0", "BoostLine"),
    ("this software is provided as is without any express or implied warranty", "ZlibAsIs"),
    ("permission is granted to anyone to use this software for any purpose including commercial applications", "ZlibGrant"),
    ("licensed under cc by nc 4 0", "CcByNc4Line"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "CcByNc4Line"),
    ("licensed under cc by 4 0", "CcBy4Line"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "CcBy4Line"),
    ("licensed under cc by sa 4 0", "CcBySa4Line"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "CcBySa4Line"),
    ("all rights reserved", "AllRights"),
    ("spdx license identifier apache 2 0", "Apache2Line"),
    ("spdx license identifier mit", "MitLine"),
    ("spdx license identifier gpl 3 0", "Gpl3Line"),
    ("spdx license identifier gpl 2 0", "Gpl2Line"),
    ("spdx license identifier lgpl 2 1", "Lgpl21Line"),
    ("spdx license identifier bsd 3 clause", "Bsd3Line"),
    ("spdx license identifier bsd 2 clause", "Bsd2Line"),
    ("spdx license identifier mpl 2 0", "Mpl2Line"),
    ("spdx license identifier isc", "IscLine"),
    ("spdx license identifier cc0 1 0", "Cc0Line"),
)
#: Licences and the sequences of sentence identifiers that grant them; those with ``?`` may be missing.
GRANTS = (
    ("Apache-2.0", ("Apache2Grant", "Apache2Comply", "Apache2Copy", "Apache2AsIs")),
    ("BSD-4-Clause", ("AllRights?", "BsdGrant", "BsdSource", "BsdBinary", "BsdAds", "BsdName", "BsdAsIs?")),
    ("BSD-3-Clause", ("AllRights?", "BsdGrant", "BsdSource", "BsdBinary", "BsdName", "BsdAsIs?")),
    ("MIT", ("MitGrant", "MitNotice", "AsIs")),
    ("GPL-any", ("GplGrant", "GplHope", "GplCopy")),
    ("LGPL-any", ("LgplGrant", "LgplHope", "LgplCopy")),
    ("AGPL-any", ("AgplGrant", "GplHope", "AgplCopy")),
    ("BSD-2-Clause", ("AllRights?", "BsdGrant", "BsdSource", "BsdBinary", "BsdAsIs?")),
    ("Apache-2.0", ("Apache2Line", "Apache2Comply", "Apache2Copy")),
    ("ISC", ("IscGrant", "IscAsIs")),
    ("0BSD", ("ZeroBsdGrant", "IscAsIs")),
    ("Zlib", ("ZlibAsIs", "ZlibGrant")),
    ("MPL-2.0", ("Mpl2Grant", "Mpl2Copy?")),
    ("EPL-any", ("EplGrant",)),
    ("BSL-1.0", ("BoostGrant",)),
    ("BSL-1.0", ("BoostLine",)),
    ("Unlicense", ("UnlicenseGrant",)),
    ("Apache-2.0", ("Apache2Line",)),
    ("MIT", ("MitLine",)),
    ("GPL-3.0", ("Gpl3Line",)),
    ("GPL-2.0", ("Gpl2Line",)),
    ("LGPL-2.1", ("Lgpl21Line",)),
    ("BSD-3-Clause", ("Bsd3Line",)),
    ("BSD-2-Clause", ("Bsd2Line",)),
    ("MPL-2.0", ("Mpl2Line",)),
    ("ISC", ("IscLine",)),
    ("CC0-1.0", ("Cc0Line",)),
    ("CC-BY-NC-4.0", ("CcByNc4Line",)),
    ("CC-BY-SA-4.0", ("CcBySa4Line",)),
    ("CC-BY-4.0", ("CcBy4Line",)),
    ("Proprietary", ("AllRights",)),
)


def _forms(parts: tuple[str, ...]) -> list[tuple[str, ...]]:
    choices = [((part[:-1],), ()) if part.endswith("?") else ((part,),) for part in parts]
    return [sum(chosen, ()) for chosen in product(*choices)]


#: Every form of every grant, longest first.
RULES = tuple(sorted(((name, form) for name, parts in GRANTS for form in _forms(parts)), key=lambda rule: -len(rule[1])))
#: ASCII signs and blanks; sentences end at a stop before a blank and at lines that hold nothing else.
GAP = r"[\x00-\x2f:-@\[-`{-\x7f]"
LETTER = r"[^\x00-\x2f:-@\[-`{-\x7f]"
CUTS = rf"[.?!]+(?:[ \t\r\n]|\z)|\n{GAP}*\n"
#: Where a known sentence may start within a sentence.
STARTS = r"[;:]+(?:[ \t\r\n]|\z)|\n"
#: A number or letter that counts clauses.
COUNTER = "^(?:[0-9]{1,3}|[a-z]|[ivx]{1,4}) "
FIRST = f"^(?:(?:[0-9]{{1,3}}|[a-z]|[ivx]{{1,4}}) )?(?:{'|'.join(sorted({text.split()[0] for text, _ in SENTENCES}))})(?: |$)"
#: Lines that a start looks at, and signs: the longest known sentence, its counter and a blank after it.
LINES, WIDTH = max(len(text.split()) for text, _ in SENTENCES) + 1, max(len(text) for text, _ in SENTENCES) + 6
#: Strings of which every known sentence has one, whatever is wrapped; only sentences with one are normalised.
SIGNS = "(?i)licen|permission|redistribut|warrant|rights|neither|unless|software|gnu|mpl"


def identifier(words: str, starts_with: str) -> str:
    """SQL for the identifier of the longest known opening of ``words``, or ''."""
    known = sorted(SENTENCES, key=lambda s: -len(s[0]))
    cases = " ".join(f"WHEN {words} = '{text}' OR {starts_with}({words}, '{text} ') THEN '{name}'" for text, name in known)
    return f"CASE {cases} ELSE '' END"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sequence of identifiers, licences in text order, and identifiers outside all rules."""
    rows = documents.select("doc_id", F.expr(f"filter(split(coalesce(text, ''), {_quoted(CUTS)}, -1), s -> regexp_like(s, {_quoted(LETTER)}))").alias("sentences"))
    normal = "replace(trim(regexp_replace(lower(l), '[^a-z0-9]+', ' ')), 'licence', 'license')"
    lines = f"filter(transform(split(s, {_quoted(STARTS)}, -1), l -> {normal}), l -> l <> '')"
    signed = rows.select(
        "doc_id",
        F.expr("cast(size(sentences) AS bigint)").alias("n_sentences"),
        F.expr(f"transform(filter(sentences, s -> regexp_like(s, '{SIGNS}')), s -> {lines})").alias("lines"),
    )
    words = f"regexp_replace(left(array_join(slice(p, i + 1, {LINES}), ' '), {WIDTH}), '{COUNTER}', '')"
    starts = f"filter(flatten(transform(lines, p -> transform(p, (l, i) -> CASE WHEN regexp_like(l, '{FIRST}') THEN {words} ELSE '' END))), w -> w <> '')"
    found = signed.select("doc_id", "n_sentences", F.expr(f"filter(transform({starts}, w -> {identifier('w', 'startswith')}), s -> s <> '')").alias("sequence"))
    marked = F.when(F.size("sequence") > 0, F.concat(F.lit(" "), F.array_join("sequence", "  "), F.lit(" "))).otherwise("")
    for number, (_, parts) in enumerate(RULES):
        marked = F.replace(marked, F.lit(" " + "  ".join(parts) + " "), F.lit(f" #{number} "))
    rest = found.withColumn("marks", F.filter(F.split(marked, " "), lambda m: m != ""))
    names = "array(" + ", ".join(f"'{name}'" for name, _ in RULES) + ")"
    return rest.select(
        "doc_id",
        "n_sentences",
        "sequence",
        F.expr(f"transform(filter(marks, m -> startswith(m, '#')), m -> {names}[cast(substring(m, 2) AS int)])").alias("licences"),
        F.expr("filter(marks, m -> NOT startswith(m, '#'))").alias("unmatched"),
    )
