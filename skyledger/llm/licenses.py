"""License scans: ordered signature rules over the words of whole texts.

Rules are regular expressions over a text's words joined by single spaces. A
rule runs only where its keywords occur as words, and a text is searched at
all only if it has those of some rule or phrase given. Detections are intervals of words;
in order of priority, then length, an interval inside an already accepted one
is suppressed. Base phrases are counted at every place, suppressed or not.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Families: label, names as regular expressions over words, versions, a keyword each detection needs, weight.
FAMILIES = [
    ("gpl", r"(?:gnu )?(?:general public license|gpl)", "1,2,3", ("license|gpl", "general|gpl"), 0.9),
    ("lgpl", r"(?:gnu )?(?:lesser general public license|library general public license|lgpl)", "2 1,2,3", ("license|lgpl", "lesser|library|lgpl"), 0.9),
    ("agpl", r"(?:gnu )?(?:affero general public license|agpl)", "1,3", ("affero|agpl",), 0.9),
    ("gfdl", r"(?:gnu )?(?:free documentation license|gfdl)", "1 1,1 2,1 3", ("documentation|gfdl",), 0.9),
    ("apache", r"apache(?: software)?(?: public)? license", "1 0,1 1,2 0", ("apache",), 0.9),
    ("mit", r"mit license", "", ("mit",), 0.9),
    ("x11", r"x11 license", "", ("x11",), 0.8),
    ("bsd", r"(?:bsd|(?:2|3|4|two|three|four) clause bsd|berkeley software distribution) license", "2,3,4", ("license", "bsd|berkeley"), 0.9),
    ("isc", r"isc license", "", ("isc",), 0.9),
    ("mpl", r"mozilla public license", "1 0,1 1,2 0", ("mozilla",), 0.9),
    ("epl", r"eclipse public license", "1 0,2 0", ("eclipse",), 0.9),
    ("cddl", r"common development and distribution license", "1 0,1 1", ("development",), 0.9),
    ("cpl", r"common public license", "1 0", ("common",), 0.8),
    ("eupl", r"european union public licen[cs]e", "1 1,1 2", ("european",), 0.9),
    ("artistic", r"artistic license", "1 0,2 0", ("artistic",), 0.9),
    ("zlib", r"zlib(?: libpng)? license", "", ("zlib",), 0.9),
    ("boost", r"boost software license", "1 0", ("boost",), 0.9),
    ("wtfpl", r"do what the \w+ you want to public license", "2", ("what",), 0.9),
    ("unlicense", r"unlicense", "", ("unlicense",), 0.8),
    ("postgresql", r"postgresql license", "", ("postgresql",), 0.9),
    ("python", r"python(?: software foundation)? license", "2,3", ("python",), 0.8),
    ("openssl", r"openssl license", "", ("openssl",), 0.9),
    ("ms-pl", r"microsoft public license", "", ("microsoft",), 0.9),
    ("ofl", r"sil open font license", "1 0,1 1", ("font",), 0.9),
    ("odbl", r"open database license", "1 0", ("database",), 0.9),
    ("cc0", r"cc0", "1 0", ("cc0",), 0.9),
    ("cc0", r"creative commons zero", "1 0", ("creative", "zero"), 0.9),
    ("cc-by-nc-nd", r"cc by nc nd", "2 0,2 5,3 0,4 0", ("cc", "nd"), 0.9),
    ("cc-by-nc-sa", r"cc by nc sa", "2 0,2 5,3 0,4 0", ("cc", "sa"), 0.9),
    ("cc-by-nc", r"cc by nc", "2 0,2 5,3 0,4 0", ("cc", "nc"), 0.9),
    ("cc-by-nd", r"cc by nd", "2 0,2 5,3 0,4 0", ("cc", "nd"), 0.9),
    ("cc-by-sa", r"cc by sa", "2 0,2 5,3 0,4 0", ("cc", "sa"), 0.9),
    ("creative-commons", r"creative commons(?: attribution)?(?: (?:non ?commercial|share ?alike|no ?deriv(?:ative)?s))*", "2 0,3 0,4 0", ("creative",), 0.7),
    ("public-domain", r"public domain", "", ("domain",), 0.4),
]
#: Wordings around a name, from most to least specific, with the weight each adds.
FORMS = [
    (r"spdx license identifier {n}(?: {v})?", 1.0, ("spdx",)),
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{n}(?: version)?(?: v? ?{v})?(?: or (?:any )?later)?", 1.0, ("under",)),
    (r"(?:covered|governed) by (?:the )?{n}(?: version)?(?: v? ?{v})?", 0.95, ("by",)),
    (r"subject to (?:the )?(?:terms of (?:the )?)?{n}(?: version)?(?: v? ?{v})?", 0.95, ("subject",)),
    (r"(?:see|read) (?:the )?{n}(?: version)?(?: v? ?{v})?", 0.8, ()),
    (r"copy of (?:the )?{n}", 0.8, ("copy",)),
    (r"{n} version {v}", 0.9, ("version",)),
    (r"{n} v? ?{v}", 0.85, ()),
    (r"{n}", 0.7, ()),
]
#: Sentences of license bodies, headers and notices: label, words, weight. They come before all wordings.
SIGNATURES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 0.95),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.9),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute", 0.9),
    ("x11", r"except as contained in this notice the names? of .{1,80}? shall not be used in advertising", 0.8),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", 0.7),
    ("bsd", r"redistributions of source code must retain the above copyright notice", 0.9),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", 0.9),
    ("bsd", r"neither the names? of .{1,120}? nor the names of (?:its|their) contributors may be used to endorse or promote products", 0.95),
    ("bsd", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("bsd", r"this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is", 0.7),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software", 0.8),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.9),
    ("zlib", r"the origin of this software must not be misrepresented", 0.95),
    ("zlib", r"altered source versions must be plainly marked as such", 0.95),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 0.95),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", 0.9),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", 0.9),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 0.8),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 0.95),
    ("gpl", r"you should have received a copy of the gnu general public license along with this (?:program|software|library)", 0.95),
    ("gpl", r"the gnu general public license is a free copyleft license for software", 0.95),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 0.95),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license", 0.95),
    ("agpl", r"you should have received a copy of the gnu affero general public license", 0.95),
    ("agpl", r"under the terms of the gnu affero general public license", 0.95),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 0.95),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", 0.95),
    ("apache", r"licensed under the apache license version 2 0", 0.95),
    ("apache", r"you may not use this (?:file|work) except in compliance with the license", 0.9),
    ("apache", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 0.95),
    ("apache", r"licensed to the apache software foundation asf under one or more contributor license agreements", 0.95),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license", 0.95),
    ("mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at", 0.95),
    ("mpl", r"the contents of this file are subject to the mozilla public license", 0.95),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", 0.95),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", 0.95),
    ("cpl", r"this program and the accompanying materials are made available under the terms of the common public license", 0.95),
    ("eupl", r"licensed under the eupl", 0.9),
    ("artistic", r"you may make and give away verbatim copies of the source form of the standard version", 0.95),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 0.95),
    ("python", r"psf hereby grants licensee a nonexclusive royalty free world wide license", 0.95),
    ("openssl", r"this product includes software developed by the openssl project", 0.95),
    ("ms-pl", r"if you use the software you accept this license if you do not accept the license do not use the software", 0.8),
    ("ofl", r"this font software is licensed under the sil open font license", 0.95),
    ("ofl", r"the font software may be sold as part of a larger software package", 0.8),
    ("cc0", r"to the extent possible under law .{1,120}? has waived all copyright and related or neighboring rights", 0.95),
    ("cc-by-nc-sa", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike", 0.95),
    ("cc-by-nc-nd", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?deriv(?:ative)?s", 0.95),
    ("cc-by-sa", r"this work is licensed under (?:a|the) creative commons attribution share ?alike", 0.95),
    ("creative-commons", r"this work is licensed under (?:a|the) creative commons attribution", 0.9),
    ("odbl", r"this .{1,40}? is made available under the open database license", 0.95),
    ("proprietary", r"this (?:document|software|file) contains (?:confidential|proprietary) (?:and (?:confidential|proprietary) )?information", 0.8),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: or (?:copying|reproduction|use|distribution))? .{1,60}? is (?:strictly )?prohibited", 0.8),
    ("no-copying", r"no part of this (?:publication|book|document|work) may be reproduced", 0.8),
    ("no-copying", r"(?:stored in a retrieval system|reproduced) or transmitted in any form or by any means", 0.8),
]
#: Wordings without a family.
LOOSE = [
    ("reserved", r"all rights reserved", ("reserved",), 0.5),
    ("copyright", r"copyright (?:c )?(?:1|2)\d\d\d", ("copyright",), 0.4),
    ("copyright", r"copyright (?:holder|owner)s?", ("copyright",), 0.3),
    ("proprietary", r"proprietary (?:and|information|software)(?: \w+){0,3} (?:confidential|proprietary)", ("proprietary",), 0.6),
    ("proprietary", r"confidential (?:and|information|software)(?: \w+){0,3} (?:confidential|proprietary)", ("confidential",), 0.6),
    ("permissive", r"permission is hereby granted free of charge", ("hereby",), 0.8),
    ("permissive", r"redistribution and use in source and binary forms", ("redistribution",), 0.8),
    ("warranty", r"without warranty of any kind", ("warranty",), 0.3),
    ("no-copying", r"(?:may|must) not be (?:copied|reproduced|redistributed)", ("not",), 0.5),
]


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    pattern: re.Pattern
    keywords: tuple[frozenset[bytes], ...]   # every match has one whole word of each set
    weight: float


def _versions(raw: str) -> str:
    """The versions listed, each as words ("2 0")."""
    return "(?:" + "|".join(sorted(raw.split(","), key=len, reverse=True)) + ")"


def required_words(pattern: str) -> list[str]:
    """Words that every match of a pattern over words has: those that stand outside groups and options."""
    before = None
    while before != pattern:
        before, pattern = pattern, re.sub(r"\((?:\?:)?[^()]*\)", "\0", pattern)
    if "|" in pattern:
        return []
    tokens = pattern.split(" ")
    return [w for w, after in zip(tokens, [*tokens[1:], ""], strict=True)
            if re.fullmatch("[a-z0-9]+", w) and not after.startswith(("?", "*", "{"))]


def make_rule(priority: int, label: str, pattern: str, keywords: tuple[str, ...], weight: float) -> Rule:
    """A rule over words joined by single spaces. A keyword is a whole word of every match, or several with a bar
    between of which one suffices; the words that the pattern requires are added."""
    groups = [*keywords, *required_words(pattern)]
    return Rule(priority, label, re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])"),
                tuple(dict.fromkeys(frozenset(k.encode().split(b"|")) for k in groups)), weight)


def signature_rules() -> list[Rule]:
    """Sentences of licenses, then families times wordings, then loose wordings: hundreds of rules; a wording's place is their priority."""
    rules = [(0, label, pattern, (), weight) for label, pattern, weight in SIGNATURES]
    for level, (wording, factor, more) in enumerate(FORMS, 1):
        for label, name, versions, keys, weight in FAMILIES:
            if "{v}" in wording and not versions:
                if "(?: " not in wording:
                    continue
                shape = re.sub(r"\(\?: (?:v\? \?)?\{v\}\)\?", "", wording)
            else:
                shape = wording.replace("{v}", _versions(versions)) if versions else wording
            rules.append((level, label, shape.replace("{n}", name), (*keys, *more), weight * factor))
    rules += [(len(FORMS) + 1, *loose) for loose in LOOSE]
    return [make_rule(*r) for r in rules]


class Accepted:
    """Accepted intervals, as far as no other contains them: both ends ascend, so one place answers a question."""

    def __init__(self):
        self.firsts: list[int] = []
        self.ends: list[int] = []

    def add(self, first: int, end: int) -> bool:
        """Whether no accepted interval contains this one; it is accepted then."""
        k = bisect_right(self.firsts, first)
        if k and self.ends[k - 1] >= end:
            return False
        a = bisect_left(self.firsts, first)
        b = bisect_right(self.ends, end, lo=a)
        self.firsts[a:b], self.ends[a:b] = [first], [end]
        return True


class Scanner:
    """Scans texts; one per task."""

    def __init__(self, rules: list[Rule] | None = None, base: dict[str, str] = BASE):
        self.rules = signature_rules() if rules is None else rules
        self.base = [(b" ".join(words), label) for p, label in base.items() if (words := tx.label_words(p))]
        # A text's words, met with all keywords, say which rules can match; a rule waits at its longest keyword.
        self.waiting: dict[bytes, list[int]] = {}
        self.always = []
        for n, r in enumerate(self.rules):
            for word in max(r.keywords, key=lambda group: min(map(len, group)), default=()):
                self.waiting.setdefault(word, []).append(n)
            if not r.keywords:
                self.always.append(n)
        self.known = {w for r in self.rules for group in r.keywords for w in group}
        self.known.update(w for p, _ in self.base for w in p.split())

    def _candidates(self, have: set[bytes]) -> list[int]:
        met = {n for w in have for n in self.waiting.get(w, ())}
        return [*self.always, *(n for n in met if not any(have.isdisjoint(g) for g in self.rules[n].keywords))]

    def scan(self, text) -> dict:
        """Words, base places and accepted detections (first word, end word, label, weight) of one text."""
        words = tx.label_words(text)
        places, found = [], []
        have = self.known.intersection(words)
        candidates = self._candidates(have)
        phrases = [x for x in self.base if have.issuperset(x[0].split())]
        if candidates or phrases:
            line = b" ".join(words)
            starts = np.cumsum([0, *(len(w) + 1 for w in words)]) if words else np.zeros(1, np.int64)
            at = lambda c: int(np.searchsorted(starts, c))  # noqa: E731  a word's number from its first byte
            padded = b" " + line + b" "
            for phrase, label in phrases:
                needle, k = b" " + phrase + b" ", -1
                while (k := padded.find(needle, k + 1)) >= 0:
                    places.append((at(k), label))
            hits = []
            for n in candidates:
                r = self.rules[n]
                for m in r.pattern.finditer(line):
                    first = at(m.start())
                    hits.append((r.priority, m.start() - m.end(), first, first + m.group().count(b" ") + 1, r.label, n))
            accepted = Accepted()
            for _, _, first, end, label, n in sorted(hits):
                if accepted.add(first, end):
                    found.append((first, end, label, self.rules[n].weight))
        return {"n_words": len(words), "places": sorted(places), "found": sorted(found)}


def _strongest(found: list[tuple]) -> dict[str, float]:
    best: dict[str, float] = {}
    for *_, label, weight in found:
        best[label] = max(weight, best.get(label, 0.0))
    return best


def _labels(x) -> str:
    return ",".join(sorted(set(x)))


OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
       "score double, spans array<struct<first: bigint, last: bigint, label: string>>")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    Base places are all places where a base phrase's words stand consecutively.
    ``score`` is 1 minus the product of 1 minus each distinct label's strongest
    weight. Null and empty texts have no words, places or labels (empty
    strings, score 0). Null ids are kept; repeated rows give repeated rows;
    other columns are ignored; an empty table gives an empty result.
    """
    def run(batches):
        scanner = Scanner(base=base)
        for b in batches:
            rows = [scanner.scan(t) for t in b.column("text").to_pylist()]
            best = [_strongest(r["found"]) for r in rows]
            for r, own in zip(rows, best, strict=True):
                for _, label in r["places"]:
                    own.setdefault(label, 0.5)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([r["n_words"] for r in rows], pa.int64()),
                pa.array([len(r["places"]) for r in rows], pa.int64()),
                pa.array([r["places"][0][0] if r["places"] else None for r in rows], pa.int64()),
                pa.array([r["places"][-1][0] if r["places"] else None for r in rows], pa.int64()),
                pa.array([_labels(x for _, x in r["places"]) for r in rows], pa.string()),
                pa.array([_labels(own) for own in best], pa.string()),
                pa.array([1 - float(np.prod([1 - w for w in own.values()])) for own in best], pa.float64()),
                pa.array([[{"first": a, "last": e - 1, "label": x} for a, e, x, _ in r["found"]] for r in rows],
                         pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())]))),
            ], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
    base_docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base_docs.mapInArrow(run, OUT)
