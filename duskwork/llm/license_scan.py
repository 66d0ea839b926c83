"""Licence scan by ordered signature rules.

Rules are regexes built from hand-written signature forms and a list of licences.
A keyword automaton runs over each lower-cased text first; only rules whose keyword occurs
are tried. Rules are ordered by priority; a detection inside the interval of one
with the same or a higher priority is suppressed. The base phrases are found word
by word and always stay.

Null text counts as empty: no words, no labels, score 0. ``doc_id`` is passed
through, null or repeated; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import Intervals, map_slices, texts_of

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_WEIGHT = 0.4
# ASCII letters and digits and every byte of non-ASCII characters are parts of words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)

# (label, name as a regex, keywords one of which each name contains, versions)
LICENCES = [
    ("apache", r"apache(?: software)? licen[cs]e", "apache", ["1.0", "1.1", "2.0"]),
    ("mit", r"mit(?:/x11)? licen[cs]e", "mit", []),
    ("mit-0", r"mit no attribution(?: licen[cs]e)?", "no attribution", []),
    ("bsd", r"bsd licen[cs]e", "bsd", []),
    ("bsd-2-clause", r"(?:bsd 2[- ]clause|simplified bsd|freebsd)(?: licen[cs]e)?", "bsd", []),
    ("bsd-3-clause", r"(?:bsd 3[- ]clause|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", "bsd", []),
    ("bsd-4-clause", r"(?:bsd 4[- ]clause|original bsd)(?: licen[cs]e)?", "bsd", []),
    ("0bsd", r"(?:0bsd|zero[- ]clause bsd)(?: licen[cs]e)?", "bsd", []),
    ("gpl", r"(?:gnu )?(?:general public licen[cs]e|gpl)", "gpl|general public", ["1.0", "2.0", "3.0", "2", "3"]),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public licen[cs]e|lgpl)", "lgpl|general public", ["2.0", "2.1", "3.0", "3"]),
    ("agpl", r"(?:gnu )?(?:affero general public licen[cs]e|agpl)", "agpl|affero", ["1.0", "3.0", "3"]),
    ("gfdl", r"(?:gnu )?(?:free documentation licen[cs]e|gfdl)", "gfdl|free documentation", ["1.1", "1.2", "1.3"]),
    ("mpl", r"mozilla public licen[cs]e", "mozilla", ["1.0", "1.1", "2.0"]),
    ("epl", r"eclipse public licen[cs]e", "eclipse", ["1.0", "2.0"]),
    ("edl", r"eclipse distribution licen[cs]e", "eclipse", ["1.0"]),
    ("cddl", r"common development and distribution licen[cs]e", "common development", ["1.0", "1.1"]),
    ("cpl", r"common public licen[cs]e", "common public", ["1.0"]),
    ("cpal", r"common public attribution licen[cs]e", "common public", ["1.0"]),
    ("ipl", r"ibm public licen[cs]e", "ibm public", ["1.0"]),
    ("isc", r"isc licen[cs]e", "isc", []),
    ("zlib", r"zlib(?:/libpng)? licen[cs]e", "zlib", []),
    ("libpng", r"libpng licen[cs]e", "libpng", ["2.0"]),
    ("boost", r"boost software licen[cs]e", "boost", ["1.0"]),
    ("artistic", r"artistic licen[cs]e", "artistic", ["1.0", "2.0"]),
    ("unlicense", r"the unlicen[cs]e|unlicen[cs]e", "unlicen", []),
    ("wtfpl", r"do what the f[a-z*]+ you want to public licen[cs]e|wtfpl", "wtfpl|do what the", ["2"]),
    ("eupl", r"european union public licen[cs]e", "european union", ["1.0", "1.1", "1.2"]),
    ("ecl", r"educational community licen[cs]e", "educational community", ["1.0", "2.0"]),
    ("afl", r"academic free licen[cs]e", "academic free", ["2.1", "3.0"]),
    ("osl", r"open software licen[cs]e", "open software", ["1.0", "2.1", "3.0"]),
    ("apsl", r"apple public source licen[cs]e", "apple public", ["1.0", "2.0"]),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft", []),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft", []),
    ("php", r"php licen[cs]e", "php", ["3.0", "3.01"]),
    ("python", r"python(?: software foundation)? licen[cs]e", "python", ["2.0"]),
    ("ruby", r"ruby licen[cs]e", "ruby", []),
    ("perl", r"same terms as perl(?: itself)?", "perl", []),
    ("postgresql", r"postgresql licen[cs]e", "postgresql", []),
    ("openssl", r"openssl licen[cs]e", "openssl", []),
    ("ncsa", r"university of illinois/ncsa open source licen[cs]e|ncsa licen[cs]e", "ncsa", []),
    ("w3c", r"w3c software (?:notice and )?licen[cs]e", "w3c", []),
    ("unicode", r"unicode (?:terms of use|licen[cs]e)", "unicode ", []),
    ("ofl", r"sil open font licen[cs]e", "open font", ["1.0", "1.1"]),
    ("qpl", r"q public licen[cs]e", "q public", ["1.0"]),
    ("sleepycat", r"sleepycat licen[cs]e", "sleepycat", []),
    ("vim", r"vim licen[cs]e", "vim", []),
    ("x11", r"x11 licen[cs]e", "x11", []),
    ("upl", r"universal permissive licen[cs]e", "permissive", ["1.0"]),
    ("blueoak", r"blue oak model licen[cs]e", "blue oak", ["1.0.0"]),
    ("bsl", r"business source licen[cs]e", "business source", ["1.1"]),
    ("sspl", r"server side public licen[cs]e", "server side", ["1"]),
    ("elastic", r"elastic licen[cs]e", "elastic", ["2.0"]),
    ("openrail", r"open(?:\+| )?rail(?:-m)? licen[cs]e|openrail", "rail", []),
    ("odbl", r"open database licen[cs]e|odbl", "odbl|open database", ["1.0"]),
    ("odc-by", r"open data commons attribution licen[cs]e", "open data", ["1.0"]),
    ("pddl", r"public domain dedication and licen[cs]e", "public domain", ["1.0"]),
    ("cc0", r"cc0|creative commons zero", "cc0|commons zero", ["1.0"]),
    ("cc-by", r"creative commons attribution", "creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", r"creative commons attribution[- ]share[- ]?alike|cc[- ]by[- ]sa", "creative commons|cc by|cc-by", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", r"creative commons attribution[- ]no[- ]?deriv(?:ative)?s|cc[- ]by[- ]nd", "creative commons|cc by|cc-by", ["3.0", "4.0"]),
    ("cc-by-nc", r"creative commons attribution[- ]non[- ]?commercial|cc[- ]by[- ]nc", "creative commons|cc by|cc-by", ["2.0", "3.0", "4.0"]),
    ("cc-by-nc-sa", r"creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike|cc[- ]by[- ]nc[- ]sa", "creative commons|cc by|cc-by", ["3.0", "4.0"]),
    ("cc-by-nc-nd", r"creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?derivs|cc[- ]by[- ]nc[- ]nd", "creative commons|cc by|cc-by", ["3.0", "4.0"]),
]

# (form around a licence, keyword of the form, priority, weight)
FORMS = [
    (r"spdx-license-identifier:\s*(?:{name})", "spdx-license-identifier", 4, 0.95),
    (r"licen[cs]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{name})", "ed under", 3, 0.9),
    (r"(?:re|distribut|publish|made availabl)\w*\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{name})", "under", 3, 0.85),
    (r"(?:subject\s+to|governed\s+by|terms\s+of|see|copy\s+of)\s+the\s+(?:{name})", "the ", 2, 0.6),
    (r"\b(?:{name})\b", None, 1, 0.5),
]
VERSION = r",?\s*(?:version\s*|v\.?\s*|-)?{version}(?![0-9])(?!\.[0-9])"

# Whole signature sentences: (label, regex, keyword, priority, weight)
SENTENCES = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", "permission is hereby granted", 5, 0.95),
    ("isc", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose", "permission to use, copy", 5, 0.9),
    ("bsd", r"redistribution and use in source and binary forms, with or without modification", "redistribution and use", 5, 0.9),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors", "neither the name of", 5, 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software", "all advertising materials", 5, 0.9),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e", "except in compliance", 5, 0.95),
    ("gpl", r"this program is free software[:;] you can redistribute it and/or modify", "is free software", 5, 0.95),
    ("lgpl", r"this library is free software[:;] you can redistribute it and/or modify", "library is free software", 6, 0.95),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "provided 'as-is'", 5, 0.85),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered software", 6, 0.95),
    ("public-domain", r"(?:released|placed|dedicated) (?:in)?to the public domain", "the public domain", 4, 0.8),
    ("copyright", r"copyright\s*(?:\(c\)|©|(?:19|20)[0-9]{2})", "copyright", 1, 0.3),
    ("copyright", r"\(c\)\s*(?:19|20)[0-9]{2}", "(c)", 1, 0.3),
    ("copyright", r"©\s*(?:19|20)[0-9]{2}", "©", 1, 0.3),
    ("proprietary", r"(?:proprietary and confidential|unauthorized copying of this file)", "unauthor", 4, 0.8),
    ("proprietary", r"proprietary and confidential", "proprietary and", 4, 0.8),
    ("non-commercial", r"(?:for )?non[- ]?commercial use only", "commercial use only", 3, 0.6),
    ("no-ai-training", r"may not be used (?:for|to) (?:training|train) ", "may not be used", 3, 0.6),
]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str  # alternatives divided by |
    priority: int
    weight: float
    form_keyword: str | None = None


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first; a version is worth one priority step more."""
    made = [Rule(*sentence) for sentence in SENTENCES]
    for label, name, word, versions in LICENCES:
        for form, keyword, priority, weight in FORMS:
            body = form.format(name=name)
            made.append(Rule(label, body, word, 2 * priority, weight, keyword))
            for version in versions:
                full = body.removesuffix(r"\b") + VERSION.format(version=re.escape(version))
                made.append(Rule(f"{label}-{version}", full, word, 2 * priority + 1, weight, keyword))
    return tuple(sorted(made, key=lambda rule: -rule.priority))


# Every rule's match contains one of these; a text without any needs no keyword search.
ANCHORS = ("licen", "copyright", "(c)", "©", "public domain", "free software", "unencumbered", "redistribution",
           "permission ", "neither the name", "advertising materials", "compliance", "as-is", "proprietary", "unauthor",
           "commercial use only", "may not be used", "gpl", "gfdl", "bsd", "wtfpl", "odbl", "openrail", "open rail", "open+rail", "cc0", "creative commons", "cc by", "cc-by",
           "as perl", "unicode terms", "no attribution")


class Scanner:
    """Keyword automaton and compiled rules of one Python worker."""

    def __init__(self):
        self.rules = rules()
        self.compiled: dict[int, re.Pattern] = {}
        self.by_keyword: dict[str, list[int]] = {}
        for place, rule in enumerate(self.rules):
            for keyword in rule.keyword.split("|"):
                self.by_keyword.setdefault(keyword, []).append(place)
        self.automaton = ahocorasick.Automaton()
        for keyword in {*self.by_keyword, *(rule.form_keyword for rule in self.rules if rule.form_keyword)}:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def detect(self, low: str) -> list[tuple[int, int, Rule]]:
        """Detections left after suppression, by priority and place."""
        if not any(anchor in low for anchor in ANCHORS):
            return []
        present = {keyword for _, keyword in self.automaton.iter(low)}
        wanted = {
            place for keyword in present for place in self.by_keyword.get(keyword, ())
            if self.rules[place].form_keyword in present or self.rules[place].form_keyword is None
        }
        found: list[tuple[int, int, Rule]] = []
        for place in sorted(wanted):
            rule = self.rules[place]
            pattern = self.compiled.get(place)
            if pattern is None:
                pattern = self.compiled[place] = re.compile(rule.pattern)
            spans = [match.span() for match in pattern.finditer(low)]
            if spans and found:
                # Spans of one rule never hold each other.
                earlier = Intervals([(a, b) for a, b, _ in found])
                spans = [(a, b) for a, b in spans if not earlier.contain(a, b)]
            found += [(a, b, rule) for a, b in spans]
        return found


@functools.cache
def scanner() -> Scanner:
    return Scanner()


def word_bytes(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(WORD_BYTES).split()


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(word number, label) of every place where a base phrase stands."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in BASE.items():
        wanted = b" " + phrase.encode() + b" "
        at, seen, number = line.find(wanted), 0, 0
        while at >= 0:
            number += line.count(b" ", seen, at)
            found.append((number, label))
            seen, at = at, line.find(wanted, at + 1)
    return found


def scan_text(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = word_bytes(text)
    base = base_places(words)
    found = scanner().detect(text.encode("utf-8").lower().decode("utf-8"))
    miss = 1.0
    weights = {rule.label: rule.weight for _, _, rule in reversed(found)}
    for label, weight in sorted([*weights.items(), *((label, BASE_WEIGHT) for label in {b for _, b in base})]):
        miss *= 1 - weight
    base_labels = sorted({label for _, label in base})
    return (
        len(words), len(base), min((p for p, _ in base), default=None), max((p for p, _ in base), default=None),
        ",".join(base_labels), ",".join(sorted({*base_labels, *weights})), 1 - miss,
    )


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the scan's columns for every row; needs no shuffle."""

    def run(parts):
        for part in parts:
            yield [part.column("doc_id").to_pylist(), *map(list, zip(*map(scan_text, texts_of(part))))]

    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, {COLUMNS}")
