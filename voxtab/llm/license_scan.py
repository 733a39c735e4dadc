r"""License scans by ordered signature rules.

Each rule is a regular expression over the lower-cased text with a label, a
priority, a confidence and keywords: words without gaps that every match
holds. A keyword automaton (Aho-Corasick) reads the text once; only rules
whose keywords all occur are tried, wherever lines break. Detections
are then resolved in order of priority, length and place: one that lies
inside an accepted detection is suppressed ("gpl" inside "gpl version 3" is
not a second license); partial overlaps both stay.

Beside the rules, base phrases are counted: places where a phrase's words
stand consecutively, words being runs of ASCII letters, digits and non-ASCII
characters.

Rows are scanned where they lie: no shuffle, nothing kept between rows.

Defined cases: a null text counts as empty and has no words, labels or
places, and score 0. Overlapping places of a phrase all count. Texts of any
length are scanned whole; repeated rows are scanned alike; an empty table
gives an empty result; other columns pass through, but one named as the
result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from voxtab.llm.common import LOWER, UPPER, add_columns

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_CONFIDENCE = 0.5

#: A gap between words; longer ones are shortened before rules are tried.
_GAP = r"[\s,;:()\"'/*#>-]{1,12}"
_LONG_GAP = re.compile(r"[\s,;:()\"'/*#>-]{5,}")
_LONG_SPACE = re.compile(r"\s{5,}")
_VERSION = rf"(?:{_GAP}(?:version|ver\.?|v\.?))?\s?"

#: Identifiers as in the public SPDX list, matched in tags, license fields and URLs.
SPDX = """
0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0
apache-1.1 apache-2.0 apsl-1.0 apsl-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause
bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 bzip2-1.0.6 cal-1.0 catosl-1.1 cc0-1.0
cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0
cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0
cddl-1.0 cddl-1.1 cecill-2.0 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0 curl ecl-2.0 efl-2.0 entessa epl-1.0 epl-2.0
eupl-1.1 eupl-1.2 fair frameworx-1.0 ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later
gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg intel ipa ipl-1.0 isc jasper-2.0 lgpl-2.0 lgpl-2.1 lgpl-2.1-only
lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng libtiff lpl-1.02 lppl-1.3c miros mit mit-0 motosoto
mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 nasa-1.3 naumen ncsa ngpl nokia nposl-3.0 ntp oclc-2.0 odbl-1.0
odc-by-1.0 ofl-1.0 ofl-1.1 ogtsl oldap-2.8 openssl osl-1.0 osl-2.0 osl-2.1 osl-3.0 pddl-1.0 php-3.0 php-3.01 postgresql
psf-2.0 python-2.0 qpl-1.0 rpl-1.1 rpl-1.5 rpsl-1.0 rscpl ruby simpl-2.0 sissl sleepycat spl-1.0 sspl-1.0 tcl
unicode-dfs-2016 unlicense upl-1.0 vim w3c watcom-1.0 wtfpl x11 xnet zend-2.0 zlib zpl-2.0 zpl-2.1
"""

#: label | priority | confidence | keywords, all of which every match holds | expression, where a space stands for a gap of white space or punctuation.
WRITTEN = r"""
gpl-3.0      | 80 | 0.95 | general public licen | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v\.?) ?3(?:\.0)?
gpl-2.0      | 80 | 0.95 | general public licen | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v\.?) ?2(?:\.0)?
gpl-1.0      | 80 | 0.90 | general public licen | gnu general public licen[sc]e (?:version|v\.?) ?1(?:\.0)?
gpl          | 40 | 0.80 | general public licen | (?:gnu )?general public licen[sc]e
gpl-3.0      | 75 | 0.90 | gplv3                | \bgplv3\+?
gpl-2.0      | 75 | 0.90 | gplv2                | \bgplv2\+?
lgpl-3.0     | 85 | 0.95 | lesser general       | gnu lesser general public licen[sc]e (?:version|v\.?) ?3(?:\.0)?
lgpl-2.1     | 85 | 0.95 | lesser general       | gnu lesser general public licen[sc]e (?:version|v\.?) ?2\.1
lgpl-2.0     | 85 | 0.95 | library general      | gnu library general public licen[sc]e (?:version|v\.?) ?2(?:\.0)?
lgpl         | 45 | 0.80 | lesser general       | (?:gnu )?lesser general public licen[sc]e
lgpl         | 45 | 0.80 | library general      | (?:gnu )?library general public licen[sc]e
agpl-3.0     | 85 | 0.95 | affero               | gnu affero general public licen[sc]e (?:version|v\.?) ?3(?:\.0)?
agpl         | 45 | 0.80 | affero               | affero general public licen[sc]e
gfdl         | 50 | 0.85 | free documentation   | gnu free documentation licen[sc]e
gpl-3.0      | 74 | 0.85 | gpl                  | \bgpl ?-?(?:version|ver\.?|v\.?)? ?3(?:\.0)?\b
gpl-2.0      | 74 | 0.85 | gpl                  | \bgpl ?-?(?:version|ver\.?|v\.?)? ?2(?:\.0)?\b
lgpl-3.0     | 74 | 0.85 | lgpl                 | \blgpl ?-?(?:version|ver\.?|v\.?)? ?3(?:\.0)?\b
lgpl-2.1     | 74 | 0.85 | lgpl                 | \blgpl ?-?(?:version|ver\.?|v\.?)? ?2\.1\b
agpl-3.0     | 74 | 0.85 | agpl                 | \bagpl ?-?(?:version|ver\.?|v\.?)? ?3(?:\.0)?\b
gpl          | 39 | 0.70 | gpl under            | under (?:the )?(?:terms of the )?(?:gnu )?gpl\b
apache-2.0   | 80 | 0.95 | apache licen         | apache licen[sc]e (?:version|v\.?) ?2(?:\.0)?
apache-1.1   | 80 | 0.95 | apache               | apache software licen[sc]e (?:version|v\.?) ?1\.1
apache-2.0   | 70 | 0.95 | apache.org/licenses  | https?://(?:www\.)?apache\.org/licenses/license-2\.0
apache       | 40 | 0.75 | apache               | apache (?:software )?licen[sc]e
mit          | 70 | 0.90 | mit licen            | (?:released|licen[sc]ed|distributed|available)? ?under the (?:terms of the )?mit licen[sc]e
mit          | 50 | 0.85 | mit licen            | \b(?:the )?mit licen[sc]e
mit          | 90 | 0.99 | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
x11          | 60 | 0.85 | x11 licen            | \bx11 licen[sc]e
isc          | 90 | 0.97 | and/or distribute    | permission to use copy modify and/or distribute this software for any purpose with or without fee
isc          | 50 | 0.85 | isc licen            | \bisc licen[sc]e
bsd-3-clause | 90 | 0.97 | neither the name     | neither the name of .{1,120}? nor the names of its contributors may be used to endorse
bsd-2-clause | 85 | 0.85 | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-4-clause | 90 | 0.97 | advertising materials | all advertising materials mentioning features or use of this software
bsd-3-clause | 75 | 0.92 | bsd                  | \b(?:3-clause|three-clause|new|modified|revised) bsd(?: licen[sc]e)?
bsd-2-clause | 75 | 0.92 | licen                | \b(?:2-clause|two-clause|simplified|freebsd) (?:bsd )?licen[sc]e
bsd          | 40 | 0.75 | bsd                  | \bbsd(?:-style)? licen[sc]e
mpl-2.0      | 80 | 0.95 | mozilla public       | mozilla public licen[sc]e (?:version|v\.?) ?2(?:\.0)?
mpl-1.1      | 80 | 0.95 | mozilla public       | mozilla public licen[sc]e (?:version|v\.?) ?1\.1
mpl          | 45 | 0.80 | mozilla public       | mozilla public licen[sc]e
epl-2.0      | 80 | 0.95 | eclipse public       | eclipse public licen[sc]e (?:version|v\.?|-)? ?2(?:\.0)?
epl-1.0      | 80 | 0.95 | eclipse public       | eclipse public licen[sc]e (?:version|v\.?|-)? ?1(?:\.0)?
epl          | 45 | 0.80 | eclipse public       | eclipse public licen[sc]e
cddl         | 45 | 0.85 | common development   | common development and distribution licen[sc]e
cpl-1.0      | 45 | 0.85 | common public        | common public licen[sc]e
eupl         | 45 | 0.85 | european union       | european union public licen[sc]e
osl-3.0      | 60 | 0.90 | open software        | open software licen[sc]e (?:version|v\.?) ?3(?:\.0)?
afl-3.0      | 60 | 0.90 | academic free        | academic free licen[sc]e (?:version|v\.?) ?3(?:\.0)?
artistic-2.0 | 60 | 0.90 | artistic licen       | artistic licen[sc]e (?:version|v\.?)? ?2(?:\.0)?
artistic     | 45 | 0.80 | artistic licen       | artistic licen[sc]e
bsl-1.0      | 60 | 0.92 | boost software       | boost software licen[sc]e
zlib         | 60 | 0.90 | zlib                 | \bzlib(?:/libpng)? licen[sc]e
zlib         | 90 | 0.97 | as-is                | this software is provided 'as-is' without any express or implied warranty
unlicense    | 90 | 0.97 | unencumbered         | this is free and unencumbered software released into the public domain
unlicense    | 60 | 0.90 | unlicense            | \b(?:the )?unlicense\b
wtfpl        | 60 | 0.90 | wtfpl                | \bwtfpl\b
wtfpl        | 60 | 0.90 | what the fuck        | do what the fuck you want to public licen[sc]e
python-2.0   | 60 | 0.90 | python software      | python software foundation licen[sc]e
php          | 60 | 0.85 | php licen            | \bphp licen[sc]e
openssl      | 60 | 0.85 | openssl licen        | openssl licen[sc]e
ofl-1.1      | 60 | 0.92 | open font            | sil open font licen[sc]e
ms-pl        | 60 | 0.90 | microsoft public     | microsoft public licen[sc]e
ms-rl        | 60 | 0.90 | microsoft reciprocal | microsoft reciprocal licen[sc]e
sspl-1.0     | 60 | 0.92 | server side public   | server side public licen[sc]e
busl-1.1     | 60 | 0.92 | business source      | business source licen[sc]e
elastic-2.0  | 60 | 0.92 | elastic licen        | elastic licen[sc]e (?:version|v\.?)? ?2(?:\.0)?
commons-clause | 60 | 0.90 | commons clause     | commons clause (?:licen[sc]e condition|restriction)?
postgresql   | 60 | 0.90 | postgresql licen     | postgresql licen[sc]e
ncsa         | 60 | 0.90 | illinois/ncsa        | university of illinois/ncsa open source licen[sc]e
vim          | 60 | 0.85 | vim licen            | \bvim licen[sc]e
beerware     | 60 | 0.85 | beer-ware            | beer-ware licen[sc]e
odbl-1.0     | 60 | 0.92 | open database        | open database licen[sc]e
odc-by-1.0   | 60 | 0.92 | open data commons    | open data commons attribution licen[sc]e
pddl-1.0     | 60 | 0.92 | open data commons    | open data commons public domain dedication
ogl-uk       | 60 | 0.92 | open government      | open government licen[sc]e
cc0-1.0      | 80 | 0.95 | cc0                  | \bcc0(?: 1\.0)?(?: universal)?
cc0-1.0      | 80 | 0.95 | publicdomain/zero    | creativecommons\.org/publicdomain/zero
public-domain | 50 | 0.80 | public domain       | (?:released (?:in)?to|dedicated to|placed in|is in) the public domain
public-domain | 50 | 0.85 | publicdomain/mark   | creativecommons\.org/publicdomain/mark
cc-by-nc-nd  | 72 | 0.92 | attribution          | creative commons attribution noncommercial no ?deriv(?:ative|ative work)s?
cc-by-nc-sa  | 72 | 0.92 | attribution          | creative commons attribution non-?commercial share ?alike
cc-by-nc     | 70 | 0.92 | attribution          | creative commons attribution non-?commercial
cc-by-nd     | 70 | 0.92 | attribution          | creative commons attribution no ?deriv(?:ative|ative work)s?
cc-by-sa     | 70 | 0.92 | attribution          | creative commons attribution share ?alike
cc-by        | 55 | 0.90 | attribution          | creative commons attribution
creative-commons | 30 | 0.60 | creative commons | creative commons
crown-copyright | 50 | 0.85 | crown copyright    | crown copyright
copyright    | 20 | 0.50 | copyright            | copyright (?:©|\(c\)|(?:19|20)\d\d)
copyright    | 20 | 0.50 | ©                    | © ?(?:19|20)\d\d
copyright    | 20 | 0.50 | (c)                  | \(c\) (?:19|20)\d\d
reserved     | 25 | 0.55 | rights reserved      | (?:all )?rights reserved
reserved     | 25 | 0.55 | droits               | tous droits réservés
reserved     | 25 | 0.55 | rechte               | alle rechte vorbehalten
reserved     | 25 | 0.55 | derechos             | todos los derechos reservados
proprietary  | 60 | 0.80 | proprietary          | proprietary and confidential
proprietary  | 60 | 0.80 | unauthorized         | unauthorized (?:copying|reproduction|distribution) (?:of this file )?.{0,40}?(?:is )?(?:strictly )?prohibited
no-redistribution | 60 | 0.80 | redistribut     | (?:may|must) not be (?:copied or )?redistributed
noncommercial | 50 | 0.75 | non-commercial      | for (?:personal and )?non-commercial use only
noncommercial | 50 | 0.75 | noncommercial       | for (?:personal and )?noncommercial use only
editorial    | 50 | 0.75 | editorial            | for editorial use only
warranty     | 15 | 0.40 | without warranty     | without warranty of any kind
warranty     | 15 | 0.40 | provided without     | provided "?as is"? without
dual         | 30 | 0.60 | dual-licen under     | dual-licen[sc]ed under
dual         | 30 | 0.60 | dual licen under     | dual licen[sc]ed under
see-license  | 10 | 0.40 | see the licen        | see the licen[sc]e (?:file )?for (?:details|more information)
see-license  | 10 | 0.40 | see licen            | see licen[sc]e(?:\.txt|\.md)?
"""


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keyword: str
    expression: str


#: What may stand before a tag of an SPDX expression.
_TERMS = r"\(?(?:[\w.+-]+\)?\s{1,4}(?:or|and|with)\s{1,4}\(?)*"


def shorten(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text with gaps of at most twelve characters and white space of at
    most four, their ends kept; and (place, characters left out before it) for
    every place where some were."""
    parts, cuts, at, lost = [], [], 0, 0
    for m in _LONG_GAP.finditer(text):
        run = _LONG_SPACE.sub(lambda w: w[0][:2] + w[0][-2:], m[0])
        run = run if len(run) <= 12 else run[:6] + run[-6:]
        if len(run) < len(m[0]):
            keep = len(run) // 2
            parts += [text[at : m.start()], run]
            at = m.end()
            lost += len(m[0]) - len(run)
            cuts.append((m.end() - lost - len(run) + keep, lost))
    return "".join([*parts, text[at:]]), cuts


def _spaced(expression: str) -> str:
    """Spaces of a written expression as gaps; an optional part's own space
    stays inside it."""
    return expression.replace(" ?", r"\s{0,4}").replace(" ", _GAP)


def rules() -> list[Rule]:
    """All signature rules: the written ones, three forms of each identifier,
    and the short forms of the Creative Commons family."""
    out = []
    for line in WRITTEN.strip().splitlines():
        label, priority, confidence, keyword, expression = (x.strip() for x in line.split("|", 4))
        out.append(Rule(label, int(priority), float(confidence), keyword, _spaced(expression)))
    for name in SPDX.split():
        tag = re.escape(name) + r"(?![\w.+-]*\w)"
        out.append(Rule(name, 100, 0.99, "spdx-license-identifier", rf"spdx-license-identifier:\s{{0,4}}{_TERMS}(?P<at>{tag})"))
        out.append(Rule(name, 95, 0.97, "spdx.org/licenses", rf"spdx\.org/licenses/{tag}"))
        out.append(Rule(name, 90, 0.95, "opensource.org/license", rf"opensource\.org/licenses?/{tag}"))
        out.append(Rule(name, 65, 0.90, "licen", rf"\blicen[sc]ed?(?:\"?\s{{0,4}}[:=]\s{{0,4}}\"?|\s{{1,4}}under\s{{1,4}}(?:the\s{{1,4}})?){tag}"))
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        parts = r"[\s-]".join(kind.split("-"))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            number = re.escape(version)
            out.append(Rule(f"cc-{kind}-{version}", 78, 0.95, "cc", rf"\bcc[\s-]{parts}[\s-]{number}"))
            out.append(Rule(f"cc-{kind}-{version}", 78, 0.95, "creativecommons.org", rf"creativecommons\.org/licenses/{kind}/{number}"))
        out.append(Rule(f"cc-{kind}", 60 + len(kind), 0.85, "cc", rf"\bcc[\s-]{parts}\b"))
    return out


class Scanner:
    """Compiled rules by their keywords, and the automaton of all keywords."""

    def __init__(self, found: list[Rule]):
        self.by_keywords: dict[tuple[str, ...], list[tuple[re.Pattern, Rule]]] = {}
        for r in found:
            self.by_keywords.setdefault(tuple(r.keyword.split()), []).append((re.compile(r.expression, re.S), r))
        self.automaton = ahocorasick.Automaton()
        for k in {k for keywords in self.by_keywords for k in keywords}:
            self.automaton.add_word(k, k)
        self.automaton.make_automaton()

    def keywords(self, text: str) -> set[str]:
        return {k for _, k in self.automaton.iter(text)}

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) of the detections that no better one holds."""
        held = self.keywords(text)
        able = [rules_ for keywords, rules_ in self.by_keywords.items() if held.issuperset(keywords)]
        if not able:
            return []
        text, cuts = shorten(text)
        places = [p for p, _ in cuts]

        def back(at: int) -> int:
            """The place in the whole text."""
            i = bisect_right(places, at)
            return at + (cuts[i - 1][1] if i else 0)

        hits = [
            (back(s), back(e - 1) + 1, rule)
            for tried in able
            for pattern, rule in tried
            for s, e in (m.span("at" if "at" in pattern.groupindex else 0) for m in pattern.finditer(text))
            if e > s
        ]
        return resolve(hits)


def resolve(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Takes detections by priority, then length, then place and label, and
    suppresses those inside an accepted one. Places are kept sorted by start
    with their furthest end, so a containment test is one search."""
    ranked = sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label))
    taken: list[tuple[int, int]] = []  # maximal intervals: starts and ends both ascend
    kept = []
    for start, end, rule in ranked:
        i = bisect_right(taken, (start, float("inf")))
        if i and taken[i - 1][1] >= end:
            continue
        kept.append((start, end, rule))
        j = bisect_right(taken, (start, -1))
        while j < len(taken) and taken[j][1] <= end:
            del taken[j]
        insort(taken, (start, end))
    return sorted(kept, key=lambda h: (h[0], h[1], h[2].label))


#: Lower-cases A-Z and puts a space for every ASCII character that is in no word.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TO_LOWER = str.maketrans(UPPER, LOWER)


def base_places(text: str) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and (word index, label) of every base phrase."""
    words = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in BASE.items():
        wanted = b" " + phrase.encode() + b" "
        at, seen, until = line.find(wanted), 0, 0
        while at >= 0:
            seen += line.count(b" ", until, at)  # spaces before a word are as many as words before it
            until = at
            places.append((seen, label))
            at = line.find(wanted, at + 1)
    return len(words), sorted(places)


_STRUCT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())]))),
    ]
)


def scan_text(text: str, scanner: Scanner) -> dict:
    n_words, places = base_places(text)
    found = scanner.detections(text.translate(_TO_LOWER) if not text.isascii() else text.lower())
    base = {label for _, label in places}
    labels = base | {r.label for _, _, r in found}
    confidence = [r.confidence for _, _, r in found] + [BASE_CONFIDENCE] * bool(base)
    return {
        "n_words": n_words,
        "n_base": len(places),
        "first_word": places[0][0] if places else None,
        "last_word": places[-1][0] if places else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": max(confidence, default=0.0),
        "spans": [{"start": a, "stop": b, "label": r.label, "confidence": r.confidence} for a, b, r in found],
    }


def scan(docs: DataFrame, text: str = "text", signatures: list[Rule] | None = None, out: str = "license") -> DataFrame:
    """``docs`` plus ``out``: word and base counts, labels, score and the
    detected spans (character places in the text)."""
    chosen = rules() if signatures is None else signatures

    def start():
        scanner = Scanner(chosen)
        return lambda texts: [pa.array([scan_text(t.as_py() or "", scanner) for t in texts], _STRUCT)]

    kind = (
        "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,"
        "score:double,spans:array<struct<start:bigint,stop:bigint,label:string,confidence:double>>>"
    )
    return add_columns(docs, text, [T.StructField(out, T._parse_datatype_string(kind))], start)
