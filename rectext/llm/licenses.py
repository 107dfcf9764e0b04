"""License scans: ordered signature rules over the words of a text.

A rule is a regular expression over the normalised text (words joined by one
blank) with a label, a priority and a score. The rules, a few hundred, come
from families of licenses and the wordings in which notices name them. Each
family has a keyword; a text without the keyword skips the family's
expressions. Detections compete: in order of priority, one whose words lie
inside those of a kept detection is suppressed.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.llm.common import map_rows

# Fixed values of the base rules: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, keyword, name as an expression, versions as expressions.
FAMILIES = (
    ("mit", "mit", r"mit", ()),
    ("mit-0", "attribution", r"mit no attribution", ()),
    ("apache", "apache", r"apache(?: software)?", (r"1 0", r"1 1", r"2 0", r"2")),
    ("agpl", "affero", r"(?:gnu )?affero general public", (r"1 0", r"3 0", r"3")),
    ("lgpl", "esser", r"(?:gnu )?lesser general public", (r"2 1", r"3 0", r"3")),
    ("lgpl", "library", r"(?:gnu )?library general public", (r"2 0", r"2")),
    ("gpl", "general public", r"(?:gnu )?general public", (r"1", r"2 0", r"2", r"3 0", r"3")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", (r"1 1", r"1 2", r"1 3")),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", ()),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", ()),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)", ()),
    ("bsd", "bsd", r"bsd(?: style)?", ()),
    ("mpl", "mozilla", r"mozilla public", (r"1 0", r"1 1", r"2 0")),
    ("epl", "eclipse", r"eclipse public", (r"1 0", r"2 0")),
    ("edl", "eclipse", r"eclipse distribution", (r"1 0",)),
    ("cpl", "common public", r"common public", (r"1 0",)),
    ("cddl", "common development", r"common development and distribution", (r"1 0", r"1 1")),
    ("cpal", "common public attribution", r"common public attribution", (r"1 0",)),
    ("eupl", "european union", r"european union public", (r"1 0", r"1 1", r"1 2")),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("boost", "boost", r"boost software", (r"1 0",)),
    ("artistic", "artistic", r"(?:clarified )?artistic", (r"1 0", r"2 0")),
    ("python", "python", r"python(?: software foundation)?", (r"2 0", r"2")),
    ("php", "php", r"php", (r"3 0", r"3 01")),
    ("ruby", "ruby", r"ruby", ()),
    ("ofl", "open font", r"(?:sil )?open font", (r"1 0", r"1 1")),
    ("afl", "academic free", r"academic free", (r"1 1", r"2 0", r"2 1", r"3 0")),
    ("osl", "open software", r"open software", (r"1 0", r"2 0", r"2 1", r"3 0")),
    ("odbl", "database", r"open database", (r"1 0",)),
    ("odc-by", "open data commons", r"open data commons attribution", (r"1 0",)),
    ("ms-pl", "microsoft", r"microsoft public", ()),
    ("ms-rl", "microsoft", r"microsoft reciprocal", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("openssl", "openssl", r"openssl", ()),
    ("w3c", "w3c", r"w3c(?: software(?: and document)?(?: notice and)?)?", ()),
    ("unicode", "unicode", r"unicode", (r"3",)),
    ("cecill", "cecill", r"cecill(?: (?:b|c))?", (r"1 0", r"2 0", r"2 1")),
    ("mulan", "mulan", r"mulan (?:psl|permissive software)", (r"1", r"2")),
    ("wtfpl", "you want to public", r"do what the \w+ you want to public", ()),
    ("sspl", "server side", r"server side public", (r"1",)),
    ("elastic", "elastic", r"elastic", (r"2 0",)),
    ("busl", "business source", r"business source", (r"1 1",)),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s", (r"2 0", r"3 0", r"4 0")),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", (r"2 0", r"3 0", r"4 0")),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", (r"2 0", r"3 0", r"4 0")),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s", (r"2 0", r"3 0", r"4 0")),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", (r"2 0", r"3 0", r"4 0")),
    ("cc-by", "creative commons", r"creative commons attribution", (r"2 0", r"2 5", r"3 0", r"4 0")),
)

# The same for abbreviations, which name a license without the word.
# The versions are all in one expression, the longer forms first.
SHORT = (
    ("agpl", "agpl", r"(?:gnu )?agpl", r"[13](?: 0)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", r"(?:2 [01]|3 0|[23])"),
    ("gpl", "gpl", r"(?:gnu )?gpl", r"[123](?: 0)?"),
    ("mpl", "mpl", r"mpl", r"(?:1 [01]|2 0|[12])"),
    ("epl", "epl", r"epl", r"[12](?: 0)?"),
    *((f"cc-by{x}", "cc by", f"cc by{x.replace('-', ' ')}", r"(?:2 [05]|[1345] 0|[12345])") for x in ("-nc-nd", "-nc-sa", "-nc", "-nd", "-sa", "")),
)

# Wordings of a notice, with priority and score. {n} stands for
# the family's name, {v} for a version.
VERSIONED = (
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: public)? licen[cs]e (?:version |v )?{v}", 90, 1.0),
    (r"{n}(?: public)? licen[cs]e (?:version |v )?{v} or (?:any )?later", 85, 0.95),
    (r"{n}(?: public)? licen[cs]e (?:version |v )?{v}", 80, 0.9),
    (r"version {v} of the {n}(?: public)? licen[cs]e", 80, 0.9),
)
PLAIN = (
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n} licen[cs]e", 60, 0.85),
    (r"(?:covered|governed) by (?:the )?{n} licen[cs]e", 55, 0.8),
    (r"under (?:the )?(?:terms of )?(?:the )?{n} licen[cs]e", 50, 0.75),
    (r"{n} licen[cs]e agreement", 45, 0.75),
    (r"(?:the )?{n} licen[cs]e", 40, 0.7),
)
# Of abbreviations: v3, v 3, version 3 or 3, with or without a blank before it.
SHORT_VERSIONED = (
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[cs]e)? ?(?:version |v ?)?{v}(?: only| or (?:any )?later)?", 90, 1.0),
    (r"{n}(?: licen[cs]e)? ?(?:version |v ?)?{v}(?: only| or (?:any )?later)?", 80, 0.9),
    (r"version {v} of the {n}(?: licen[cs]e)?", 80, 0.9),
)
SHORT_PLAIN = (
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}", 60, 0.85),
    (r"(?:covered|governed) by (?:the )?{n}", 55, 0.8),
    (r"under (?:the )?(?:terms of )?(?:the )?{n}", 50, 0.75),
    (r"{n} (?:licen[cs]ed?|code)", 40, 0.7),
)
# Sentences of license texts and identifiers: label, keyword, expression.
SENTENCES = (
    ("mit", "free of charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "spdx", r"spdx license identifier mit"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache", "spdx", r"spdx license identifier apache 2 0"),
    ("apache", "apache org", r"www apache org licenses(?: license 2 0)?"),
    ("gpl", "spdx", r"spdx license identifier gpl(?: [0-9](?: 0)?(?: only| or later)?)?"),
    ("gpl", "gnu org", r"www gnu org licenses(?: gpl)?"),
    ("lgpl", "spdx", r"spdx license identifier lgpl(?: [0-9](?: [0-9])?(?: only| or later)?)?"),
    ("agpl", "spdx", r"spdx license identifier agpl(?: 3 0(?: only| or later)?)?"),
    ("mpl", "spdx", r"spdx license identifier mpl(?: [0-9] [0-9])?"),
    ("bsd-2-clause", "spdx", r"spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", "spdx", r"spdx license identifier bsd 3 clause"),
    ("public-domain", "public domain", r"(?:dedicated|released|placed) (?:in)?to the public domain"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors"),
    ("boost", "spdx", r"spdx license identifier bsl 1 0"),
    ("proprietary", "all rights reserved", r"confidential and proprietary all rights reserved"),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
)
# Identifiers of package metadata, alone (label, expression) and behind the word license (label, expression).
IDENTIFIERS = (("apache", r"apache 2 0"), ("bsd-3-clause", r"bsd 3 clause"), ("bsd-3-clause", r"3 clause bsd"), ("bsd-2-clause", r"bsd 2 clause"),
               ("bsd-2-clause", r"2 clause bsd"), ("mit", r"mit x11"), ("boost", r"bsl 1 0"), ("artistic", r"artistic 2 0"))
FIELDS = (("mit", r"mit"), ("isc", r"isc"), ("bsd", r"bsd"), ("zlib", r"zlib"), ("unlicense", r"unlicense"), ("wtfpl", r"wtfpl"), ("gpl", r"gplv?[23]?"), ("lgpl", r"lgplv?[23]?"),
          ("agpl", r"agplv?3?"), ("proprietary", r"proprietary"), ("public-domain", r"public domain"))


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    score: float


def rules() -> list[Rule]:
    """All signature rules, highest priority first."""
    out = [Rule(label, key, expression, 95, 1.0) for label, key, expression in SENTENCES]
    for label, key, name, versions in FAMILIES:
        name = name.removesuffix(" public") + "(?: public)?" if name.endswith(" public") and not (name.endswith("general public") or "public" in key) else name
        out += [Rule(label, key, p.format(n=name, v=f"(?:{v})"), rank, score) for v in versions for p, rank, score in VERSIONED]
        out += [Rule(label, key, p.format(n=name), rank, score) for p, rank, score in PLAIN]
    for label, key, name, version in SHORT:
        # The letters EPL alone name other things as well: there a verb or the word license must stand with them.
        plain = [x for x in SHORT_PLAIN if label != "epl" or not x[0].startswith("under")]
        out += [Rule(label, key, p.format(n=name, v=version), rank, score) for p, rank, score in (*SHORT_VERSIONED, *plain)]
    out += [Rule(label, expression, expression, 70, 0.8) for label, expression in IDENTIFIERS]
    out += [Rule(label, word, f"{word} {expression}", 42, 0.7) for label, expression in FIELDS for word in ("license", "licence")]
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern))


# Bytes that separate words become blanks, A-Z become a-z: 0x00-0x2F, 0x3A-0x60
# (after lower-casing) and 0x7B-0x7F separate; UTF-8 bytes from 0x80 on belong to words.
_FOLD = bytes(x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else x + 32 if 65 <= x <= 90 else 32 for x in range(256))

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_detections long, spans array<struct<label:string,first:long,last:long,score:double>>")


def suppressed(found: list[tuple]) -> list[tuple]:
    """Of detections ``(priority, first, last, label, score)`` those that stay:
    by priority (then longer, then earlier), each one that doesn't lie inside
    a kept one. Kept ones are looked up in a list sorted by start, with the
    largest end so far, so a text full of notices costs n log n."""
    starts: list[int] = []
    ends: list[int] = []          # of the kept ones, none inside another: ends grow with starts
    stay = []
    for d in sorted(set(found), key=lambda d: (-d[0], d[1] - d[2], d[1], d[3])):
        first, last = d[1], d[2]
        i = bisect.bisect_right(starts, first)
        if i and ends[i - 1] >= last:
            continue
        stay.append(d)
        j = i                     # kept ones that lie inside this one stay kept, but need no place in the look-up
        while j < len(starts) and ends[j] <= last:
            j += 1
        if i and starts[i - 1] == first:
            i -= 1
        starts[i:j], ends[i:j] = [first], [last]
    return stay


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document over its whole text: ``n_words``, the places of
    the base phrases (``n_base``, ``first_word``, ``last_word``,
    ``base_labels``) and the method's kept detections (``spans`` by word,
    ``labels`` including the base ones, ``score`` of the surest, 0 if none).

    Base places always count, suppressed or not. Null and empty texts have no
    words, no labels (empty strings) and score 0. Equal rows give equal rows,
    null ids stay, other columns are not read."""
    def start():
        by_key: dict[bytes, list] = {}
        for r in rules():
            by_key.setdefault(r.keyword.encode(), []).append(
                (r, re.compile(rb"(?<![^ ])(?:" + r.pattern.encode() + rb")(?![^ ])")))
        base = [(re.compile(rb"(?<![^ ])" + p.encode() + rb"(?![^ ])"), label) for p, label in BASE]

        def one(raw):
            words = (raw or b"").translate(_FOLD).split()
            line = b" ".join(words)
            places, labels, found = [], set(), []
            blanks: list = []

            def at(pos):              # word number of a place: blanks before it
                if not blanks:
                    blanks.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 32))
                return int(np.searchsorted(blanks[0], pos))

            if b"license" in line:
                for p, label in base:
                    for m in p.finditer(line):
                        places.append(at(m.start()))
                        labels.add(label)
            for key, own in by_key.items():
                if key in line:
                    for r, p in own:
                        found += [(r.priority, at(m.start()), at(m.end()), r.label, r.score) for m in p.finditer(line)]
            stay = suppressed(found)
            return (len(words), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {d[3] for d in stay})),
                    max([0.7 * bool(places), *(d[4] for d in stay)]), len(stay),
                    [{"label": d[3], "first": d[1], "last": d[2], "score": d[4]} for d in sorted(stay, key=lambda d: (d[1], d[2], d[3]))])

        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections", "spans"]
        return lambda ids, texts: dict(zip(names, [ids, *zip(*map(one, texts))]))

    return map_rows(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")), SCHEMA, start)
