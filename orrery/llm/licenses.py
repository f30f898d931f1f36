"""Licence scan by sentence rules.

A text is cut into sentences, at final punctuation, blank lines, list marks and
a colon that ends a line; wrapped lines are one sentence. Each is normalised
(lower case, runs of other characters than letters and digits become one space)
and known licence sentences are looked for in it, from the start of any line
(or what follows a semicolon) to the end of the same or a later one, so that a
licence line between lines without punctuation is found as well. The identifiers
found, in text order, are then matched
against ordered rules: a rule names the identifiers that must follow each
other, other known sentences may stand between only where the rule says so.
Rules are tried from the most to the least specific at each place, and the
sentences that a rule uses are not used again.

Null and empty texts have no sentences and get empty lists; repeated rows give
repeated result rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame

from orrery.llm.common import id_text_columns, in_small_batches

#: Known sentences in normalised form. ``#`` stands for any words
#: (names, years, addresses); everything else must be equal.
SENTENCES = {
    "copyright": "copyright # | c # all rights reserved | copyright c #",
    "all-rights": "all rights reserved",
    "mit-ref": "released under the mit license | licensed under the mit license"
               " | this project is licensed under the mit license | this software is released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software #",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies #",
    "as-is": "the software is provided as is without warranty of any kind # | the software is provided as is and # disclaims all warranties # | this software is provided # as is #",
    "apache-ref": "licensed under the apache license version 2 0 | licensed under the apache license version 2 0 the license #",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at #",
    "apache-dist": "unless required by applicable law or agreed to in writing software distributed under the license #",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3"
                " | licensed under the gnu general public license version 3",
    "gpl2-ref": "this work is licensed under the gnu general public license version 2"
                " | licensed under the gnu general public license version 2",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license #"
                  " either version 3 of the license or at your option any later version",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license #"
                  " either version 2 of the license or at your option any later version",
    "gpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 #"
                 " | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license #"
                 " version 3 of the license",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 #"
                 " | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license #"
                 " version 2 of the license",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license #",
    "later-2": "either version 2 of the license or at your option any later version",
    "later-3": "either version 3 of the license or at your option any later version",
    "lgpl-ref": "licensed under the gnu lesser general public license #",
    "agpl-ref": "licensed under the gnu affero general public license #",
    "bsd-redist": "redistribution and use in source and binary forms with or without modification are permitted #",
    "bsd-source": "redistributions of source code must retain the above copyright notice #",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice #",
    "bsd-endorse": "neither the name of # may be used to endorse or promote products #",
    "cc-by-nc": "licensed under cc by nc 4 0 | this work is licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0 | this work is licensed under cc by sa 4 0",
    "cc-by": "licensed under cc by 4 0 | this work is licensed under cc by 4 0",
    "cc0": "released under cc0 1 0 | this work is dedicated to the public domain #",
    "mpl-ref": "this source code form is subject to the terms of the mozilla public license #",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose #",
    "spdx": "spdx license identifier #",
}

#: Ordered rules. ``?`` marks a sentence that may be absent.
RULES = (
    ("Apache-2.0", "apache-ref apache-comply? apache-copy? apache-dist?"),
    ("MIT", "mit-grant mit-notice? as-is?"),
    ("MIT", "mit-ref"),
    ("BSD-3-Clause", "bsd-redist bsd-source bsd-binary bsd-endorse as-is?"),
    ("BSD-2-Clause", "bsd-redist bsd-source bsd-binary as-is?"),
    ("GPL-3.0-or-later", "gpl-free later-3"),
    ("GPL-3.0-or-later", "gpl3-later"),
    ("GPL-2.0-or-later", "gpl-free later-2"),
    ("GPL-2.0-or-later", "gpl2-later"),
    ("GPL-3.0", "gpl3-free"),
    ("GPL-2.0", "gpl2-free"),
    ("GPL-3.0", "gpl3-ref"),
    ("GPL-2.0", "gpl2-ref"),
    ("LGPL", "lgpl-ref"),
    ("AGPL", "agpl-ref"),
    ("CC-BY-NC-4.0", "cc-by-nc"),
    ("CC-BY-SA-4.0", "cc-by-sa"),
    ("CC-BY-4.0", "cc-by"),
    ("CC0-1.0", "cc0"),
    ("MPL-2.0", "mpl-ref"),
    ("ISC", "isc-grant as-is?"),
    ("SPDX", "spdx"),
    ("all-rights-reserved", "copyright all-rights"),
    ("all-rights-reserved", "all-rights"),
    ("copyright-only", "copyright"),
)

#: Known sentences of one line; others go on over wrapped lines.
ONE_LINE = {"copyright", "spdx"}

#: One of these words is in every known sentence.
CUES = re.compile(r"(?i)licen[sc]e|copyright|rights[\W_]+reserved|permission|redistribut|warrant|public|cc0"
                  r"|free[\W_]+software|as[\W_]+is|\(c\)|required[\W_]+by|endorse|any[\W_]+later[\W_]+version|mozilla")

_MARK = r"(?:(?!\([cC]\))\(?(?:\d{1,2}[.)]|[a-z]\))|(?<!-)-|•)[ \t]+"
_HARD = re.compile(rf"""(?<=[.!?])["'”’)\]]*\s+(?:{_MARK})?|(?<=:)[ \t\r]*\n|\n(?:[^\w\n]*\n)+(?:[^\w\n]*?{_MARK})?|\n[^\w\n]*?{_MARK}""")
_SOFT = re.compile(r"\n|;\s+")
_OTHER = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]")
#: A wrapped line of running text may begin with "copyright holders", "copyright notice" and the like.
_RUNNING = re.compile(r"copyright (?:holder|owner|notice|and|or|law|licen[sc]e|interest|in|of|to|is)s?\b|copyright$")

SCHEMA = ("doc_id long, n_sentences long, sentence_ids array<string>, licences array<string>,"
          " spans array<struct<licence:string,start:long,end:long>>")


def sentence_table(sentences: dict | None = None):
    """Forms of known sentences (id, fixed parts, whether words may follow),
    those without gaps first, and a pattern of how they begin."""
    forms = [(name, *_form(form.strip())) for name, text in (sentences or SENTENCES).items() for form in text.split("|")]
    forms.sort(key=lambda f: len(f[1]) > 1 or f[2])  # stable
    opening = sorted({f[1][0] for f in forms}, key=len, reverse=True)
    return forms, re.compile(rf"(?:{'|'.join(map(re.escape, opening))})(?= |$)")


def _form(form: str):
    parts = [x.strip() for x in form.split("#")]
    return [x for x in parts if x], not parts[-1]


def sentences_of(text: str):
    """(start, end) of each sentence with a letter or digit, in text order."""
    at = 0
    for m in [*_HARD.finditer(text), None]:
        end = m.start() if m else len(text)
        if _WORD.search(text, at, end):
            yield at, end
        at = m.end() if m else end


def _pieces(text: str, start: int, end: int):
    """(start, end, normalised) of the lines of a sentence, and what semicolons part."""
    at = start
    for m in [*_SOFT.finditer(text, start, end), None]:
        to = m.start() if m else end
        if norm := _OTHER.sub(" ", text[at:to]).strip().lower():
            yield at, to, norm
        at = m.end() if m else to


def _known(text: str, start: int, end: int, table):
    """(identifier, start, end) of the known sentences in one sentence."""
    forms, opening = table
    pieces = list(_pieces(text, start, end))
    norm, begins, ends = " ".join(p[2] for p in pieces), [], []
    for p in pieces:
        begins.append(ends[-1] + 1 if ends else 0)
        ends.append(begins[-1] + len(p[2]))
    at_end, later, tried = {e: j for j, e in enumerate(ends)}, {}, {}

    def find(part, at):
        """Where `` part`` next ends a word, at ``at`` or after."""
        was = later.get(part)
        if was is None or not was[0] <= at <= was[1]:
            k = norm.find(" " + part, at)
            while k >= 0 and norm[k + 1 + len(part):k + 2 + len(part)] not in ("", " "):
                k = norm.find(" " + part, k + 1)
            was = later[part] = (at, k if k >= 0 else len(norm) + 1)
        return was[1] if was[1] <= len(norm) else -1

    def last(i, form):
        """The first piece at whose end the form may end, if it begins with piece i."""
        _, parts, more = form
        at = begins[i] + len(parts[0])
        if not norm.startswith(parts[0], begins[i]) or norm[at:at + 1] not in ("", " "):
            return None
        for n, part in enumerate(parts[1:], 2):
            at = find(part, at)
            while at >= 0 and n == len(parts) and not more and at + 1 + len(part) not in at_end:
                at = find(part, at + 1)
            if at < 0:
                return None
            at += 1 + len(part)
        return bisect_left(ends, at) if more else at_end.get(at)

    def options(i):
        """(piece at which it ends, form) of the forms that begin with piece i."""
        if i not in tried:
            tried[i] = []
            if opening.match(norm, begins[i]) and not (i and _RUNNING.match(pieces[i][2])):
                tried[i] = [(j, f) for f in forms if (j := last(i, f)) is not None and not (
                    f[0] in ONE_LINE and any(opening.match(norm, begins[k]) for k in range(i + 1, j + 1)))]
        return tried[i]

    i = 0
    while i < len(pieces):
        if not (found := options(i)):
            i += 1
            continue
        to = min(j for j, _ in found)
        following = next((k for k in range(to + 1, len(pieces)) if options(k)), len(pieces))
        j, (name, _, more) = next((j, f) for j, f in found if j < following)
        j = following - 1 if more and name not in ONE_LINE else j
        yield name, pieces[i][0], pieces[j][1]
        i = j + 1


def recognise(text: str, table, rules):
    """Number of sentences, identifiers in order and (licence, start, end)."""
    known, n = [], 0
    for start, end in sentences_of(text):
        n += 1
        known += _known(text, start, end, table)
    found, at = [], 0
    while at < len(known):
        for licence, steps in rules:
            to = at
            for step, optional in steps:
                if to < len(known) and known[to][0] == step:
                    to += 1
                elif not optional:
                    break
            else:
                if to > at:
                    found.append((licence, known[at][1], known[to - 1][2]))
                    at = to
                    break
        else:
            at += 1
    return n, [k[0] for k in known], found


def compiled_rules(rules=RULES):
    out = [(name, [(s.rstrip("?"), s.endswith("?")) for s in steps.split()]) for name, steps in rules]
    return sorted(out, key=lambda r: -sum(not o for _, o in r[1]))  # stable: given order breaks ties


def scan_licences(docs: DataFrame, sentences: dict | None = None, rules=RULES) -> DataFrame:
    """One row per row of ``docs``: sentences, identifiers, licences, spans."""
    table, ordered = sentence_table(sentences), compiled_rules(rules)
    cues = CUES if sentences is None else re.compile("")

    def scan(batches):
        import pyarrow as pa

        schema = None
        for b in in_small_batches(batches):
            rows = {"doc_id": [], "n_sentences": [], "sentence_ids": [], "licences": [], "spans": []}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                if cues.search(text):
                    n, ids, found = recognise(text, table, ordered)
                else:
                    n, ids, found = sum(1 for _ in sentences_of(text)), [], []
                rows["doc_id"].append(doc_id)
                rows["n_sentences"].append(n)
                rows["sentence_ids"].append(ids)
                rows["licences"].append(list(dict.fromkeys(f[0] for f in found)))
                rows["spans"].append([{"licence": a, "start": s, "end": e} for a, s, e in found])
            schema = schema or pa.schema([
                ("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("sentence_ids", pa.list_(pa.string())),
                ("licences", pa.list_(pa.string())),
                ("spans", pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return id_text_columns(docs).mapInArrow(scan, SCHEMA)
