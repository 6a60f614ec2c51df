"""License scans by ordered signature rules.

A text becomes its words: A-Z in lower case, everything else of ASCII but digits
and letters a gap.  Rules are regular expressions over the words joined by one
space.  One expression over the raw text tells which texts need them at all; in
those an Aho-Corasick automaton finds the rules' keywords, and only rules whose
keyword stands there run.  Detections then resolve by priority: one inside the
interval of another of higher priority, or of equal priority and longer or
earlier in the order of the rules, is suppressed.

Null texts are empty.  Rows are judged one by one, so repeated rows repeat, and
an empty table gives an empty result.  A text is held whole in one task, whatever
its length; nothing else is.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache

from pyspark.sql import DataFrame

from siftworks.llm.common import ship_package, slices, text_source, with_outputs

#: What stands between words, within ASCII: all but digits and letters.
GAP = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: The base phrases and their labels (fixed values).
BASE: tuple[tuple[str, str], ...] = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Identifier of a license -> how texts name it, in words, and a keyword that is
#: in every such name.  Identifiers are those that license lists publish.
NAMES: dict[str, tuple[str, str]] = {
    "AFL-3.0": (r"academic free licen[cs]e(?: version| v)?(?: 3(?: 0)?)?", "academic"),
    "AGPL-3.0": (r"(?:gnu )?affero general public licen[cs]e(?: version| v)?(?: 3(?: 0)?)?|agpl ?v?3(?: 0)?", "affero|agpl"),
    "Apache-1.1": (r"apache(?: software)? licen[cs]e(?: version| v)? 1 1", "apache"),
    "Apache-2.0": (r"apache(?: software)? licen[cs]e(?: version| v)? 2(?: 0)?|apache 2 0 licen[cs]e|apache v2 licen[cs]e", "apache"),
    "APSL-2.0": (r"apple public source licen[cs]e(?: version| v)?(?: 2(?: 0)?)?", "apple"),
    "Artistic-1.0": (r"artistic licen[cs]e(?: version| v)? 1(?: 0)?", "artistic"),
    "Artistic-2.0": (r"artistic licen[cs]e(?: version| v)? 2(?: 0)?", "artistic"),
    "Beerware": (r"beer ?ware licen[cs]e", "beer"),
    "BlueOak-1.0.0": (r"blue oak model licen[cs]e(?: version)?(?: 1 0 0)?", "blue"),
    "BSD-2-Clause": (r"(?:2 clause|two clause|simplified|freebsd) (?:bsd )?licen[cs]e|bsd 2 clause(?: licen[cs]e)?", "clause|simplified|freebsd"),
    "BSD-3-Clause": (r"(?:3 clause|three clause|new|modified|revised) bsd licen[cs]e|bsd 3 clause(?: licen[cs]e)?", "bsd"),
    "BSD-4-Clause": (r"(?:4 clause|four clause|original) bsd licen[cs]e|bsd 4 clause(?: licen[cs]e)?", "bsd"),
    "BSL-1.0": (r"boost software licen[cs]e(?: version| v)?(?: 1 0)?", "boost"),
    "BUSL-1.1": (r"business source licen[cs]e(?: version| v)?(?: 1 1)?", "business"),
    "CC0-1.0": (r"cc0(?: 1 0)?(?: universal)?|creative commons zero(?: v1 0)?(?: universal)?", "cc0|zero"),
    "CC-BY-1.0": (r"cc by 1 0|creative commons attribution 1 0", "cc by|attribution"),
    "CC-BY-2.0": (r"cc by 2 0|creative commons attribution 2 0", "cc by|attribution"),
    "CC-BY-2.5": (r"cc by 2 5|creative commons attribution 2 5", "cc by|attribution"),
    "CC-BY-3.0": (r"cc by 3 0|creative commons attribution 3 0", "cc by|attribution"),
    "CC-BY-4.0": (r"cc by 4 0|creative commons attribution 4 0(?: international)?", "cc by|attribution"),
    "CC-BY-NC-2.0": (r"cc by nc 2 0|creative commons attribution non ?commercial 2 0", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-3.0": (r"cc by nc 3 0|creative commons attribution non ?commercial 3 0", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-4.0": (r"cc by nc 4 0|creative commons attribution non ?commercial 4 0(?: international)?", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-ND-3.0": (r"cc by nc nd 3 0|creative commons attribution non ?commercial no ?deriv(?:ative)?s 3 0", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-ND-4.0": (r"cc by nc nd 4 0|creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-SA-3.0": (r"cc by nc sa 3 0|creative commons attribution non ?commercial share ?alike 3 0", "cc by nc|commercial|noncommercial"),
    "CC-BY-NC-SA-4.0": (r"cc by nc sa 4 0|creative commons attribution non ?commercial share ?alike 4 0(?: international)?", "cc by nc|commercial|noncommercial"),
    "CC-BY-ND-3.0": (r"cc by nd 3 0|creative commons attribution no ?deriv(?:ative)?s 3 0", "cc by nd|creative"),
    "CC-BY-ND-4.0": (r"cc by nd 4 0|creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?", "cc by nd|creative"),
    "CC-BY-SA-2.5": (r"cc by sa 2 5|creative commons attribution share ?alike 2 5", "cc by sa|creative"),
    "CC-BY-SA-3.0": (r"cc by sa 3 0|creative commons attribution share ?alike 3 0", "cc by sa|creative"),
    "CC-BY-SA-4.0": (r"cc by sa 4 0|creative commons attribution share ?alike 4 0(?: international)?", "cc by sa|creative"),
    "CDDL-1.0": (r"common development and distribution licen[cs]e(?: cddl)?(?: version| v)?(?: 1 0)?", "development"),
    "CECILL-2.1": (r"cecill(?: free software)? licen[cs]e(?: agreement)?(?: version| v)?(?: 2 1)?", "cecill"),
    "CPAL-1.0": (r"common public attribution licen[cs]e(?: version| v)?(?: 1 0)?", "attribution"),
    "CPL-1.0": (r"common public licen[cs]e(?: version| v)?(?: 1 0)?", "common"),
    "ECL-2.0": (r"educational community licen[cs]e(?: version| v)?(?: 2 0)?", "educational"),
    "EFL-2.0": (r"eiffel forum licen[cs]e(?: version| v)?(?: 2 0?)?", "eiffel"),
    "Elastic-2.0": (r"elastic licen[cs]e(?: version| v)?(?: 2 0)?", "elastic"),
    "EPL-1.0": (r"eclipse public licen[cs]e(?: version| v)? 1(?: 0)?", "eclipse"),
    "EPL-2.0": (r"eclipse public licen[cs]e(?: version| v)? 2(?: 0)?", "eclipse"),
    "EUPL-1.2": (r"european union public licen[cs]e(?: version| v)?(?: 1 2)?", "european"),
    "FTL": (r"freetype(?: project)? licen[cs]e", "freetype"),
    "GFDL-1.3": (r"gnu free documentation licen[cs]e(?: version| v)?(?: 1 3)?", "documentation"),
    "GPL-1.0": (r"gnu general public licen[cs]e(?: gpl)?(?: version| v)? 1(?: 0)?", "general"),
    "GPL-2.0": (r"gnu general public licen[cs]e(?: gpl)?(?: version| v)? ?2(?: 0)?|gnu gpl ?(?:version |v)?2(?: 0)?|gplv2", "general|gpl"),
    "GPL-3.0": (r"gnu general public licen[cs]e(?: gpl)?(?: version| v)? ?3(?: 0)?|gnu gpl ?(?:version |v)?3(?: 0)?|gplv3", "general|gpl"),
    "HPND": (r"historical permission notice and disclaimer", "historical"),
    "ICU": (r"icu licen[cs]e", "icu"),
    "IJG": (r"independent jpeg group(?: s)? licen[cs]e", "jpeg"),
    "IPL-1.0": (r"ibm public licen[cs]e(?: version| v)?(?: 1 0)?", "ibm"),
    "ISC": (r"isc licen[cs]e", "isc"),
    "JSON": (r"json licen[cs]e", "json"),
    "LGPL-2.0": (r"gnu library general public licen[cs]e(?: version| v)?(?: 2(?: 0)?)?", "library"),
    "LGPL-2.1": (r"gnu lesser general public licen[cs]e(?: version| v)? ?2 1|gnu lgpl ?(?:version |v)?2 1|lgplv2 1", "lesser|lgpl"),
    "LGPL-3.0": (r"gnu lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?|gnu lgpl ?(?:version |v)?3(?: 0)?|lgplv3", "lesser|lgpl"),
    "LPPL-1.3c": (r"latex project public licen[cs]e(?: version| v)?(?: 1 3c?)?", "latex"),
    "MirOS": (r"miros licen[cs]e", "miros"),
    "MIT-0": (r"mit no attribution(?: licen[cs]e)?|mit 0 licen[cs]e", "mit"),
    "MIT": (r"mit licen[cs]e|expat licen[cs]e|mit x11 licen[cs]e", "licen"),
    "MPL-1.1": (r"mozilla public licen[cs]e(?: mpl)?(?: version| v)? 1 1", "mozilla"),
    "MPL-2.0": (r"mozilla public licen[cs]e(?: mpl)?(?: version| v)? ?2(?: 0)?", "mozilla"),
    "MS-PL": (r"microsoft public licen[cs]e", "microsoft"),
    "MS-RL": (r"microsoft reciprocal licen[cs]e", "microsoft"),
    "MulanPSL-2.0": (r"mulan permissive software licen[cs]e(?: version| v)?(?: 2)?", "mulan"),
    "NCSA": (r"(?:university of illinois )?ncsa open source licen[cs]e", "ncsa"),
    "NPL-1.1": (r"netscape public licen[cs]e(?: version| v)?(?: 1 1)?", "netscape"),
    "ODbL-1.0": (r"open (?:data commons open )?database licen[cs]e(?: version| v)?(?: 1 0)?", "database"),
    "ODC-By-1.0": (r"open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?", "commons"),
    "OFL-1.1": (r"sil open font licen[cs]e(?: version| v)?(?: 1 1)?", "font"),
    "OpenSSL": (r"openssl licen[cs]e", "openssl"),
    "OSL-3.0": (r"open software licen[cs]e(?: version| v)?(?: 3 0)?", "software"),
    "PDDL-1.0": (r"public domain dedication and licen[cs]e(?: version| v)?(?: 1 0)?", "dedication"),
    "PHP-3.01": (r"php licen[cs]e(?: version| v)?(?: 3 01)?", "php"),
    "PostgreSQL": (r"postgresql licen[cs]e", "postgresql"),
    "PSF-2.0": (r"(?:python software foundation|psf) licen[cs]e(?: agreement)?(?: version| v)?(?: 2)?", "python|psf"),
    "QPL-1.0": (r"q public licen[cs]e(?: version| v)?(?: 1 0)?", "public"),
    "RPL-1.5": (r"reciprocal public licen[cs]e(?: version| v)?(?: 1 5)?", "reciprocal"),
    "Ruby": (r"ruby licen[cs]e", "ruby"),
    "SSPL-1.0": (r"server side public licen[cs]e(?: version| v)?(?: 1)?", "server"),
    "TCL": (r"tcl tk licen[cs]e", "tcl"),
    "Unicode-3.0": (r"unicode licen[cs]e(?: version| v)?(?: 3)?", "unicode"),
    "Unlicense": (r"the unlicense|unlicense org", "unlicense"),
    "UPL-1.0": (r"universal permissive licen[cs]e(?: version| v)?(?: 1 0)?", "universal"),
    "Vim": (r"vim licen[cs]e", "vim"),
    "W3C": (r"w3c software (?:notice and|and document) licen[cs]e", "w3c"),
    "WTFPL": (r"do what the f[^ ]+ you want to public licen[cs]e|wtfpl", "public|wtfpl"),
    "X11": (r"x11 licen[cs]e", "x11"),
    "Zend-2.0": (r"zend(?: engine)? licen[cs]e(?: version| v)?(?: 2 0)?", "zend"),
    "Zlib": (r"zlib(?: libpng)? licen[cs]e", "zlib"),
    "ZPL-2.1": (r"zope public licen[cs]e(?: version| v)?(?: 2 1)?", "zope"),
}

#: Sentences of license texts: label, sentence in words, keyword.
CLAUSES: tuple[tuple[str, str, str], ...] = (
    ("MIT", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby"),
    ("MIT", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial"),
    ("ISC", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("BSD-2-Clause", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution"),
    ("BSD-3-Clause", r"neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products", "endorse"),
    ("BSD-4-Clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising"),
    ("Apache-2.0", r"you may not use this file except in compliance with the license", "compliance"),
    ("Apache-2.0", r"you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0", "apache"),
    ("Apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "agreed"),
    ("GPL-2.0", r"either version 2 of the license or at your option any later version", "option"),
    ("GPL-3.0", r"either version 3 of the license or at your option any later version", "option"),
    ("LGPL-2.1", r"either version 2 1 of the license or at your option any later version", "option"),
    ("GPL-1.0", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("LGPL-2.1", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute"),
    ("AGPL-3.0", r"under the terms of the gnu affero general public license", "affero"),
    ("MPL-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("EPL-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse"),
    ("BSL-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization"),
    ("Zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "liable"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("CC0-1.0", r"to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights", "waived"),
    ("OFL-1.1", r"this font software is licensed under the sil open font license", "font"),
    ("PostgreSQL", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "agreement"),
    ("WTFPL", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "verbatim"),
    ("GPL-3.0", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim"),
    ("Vim", r"there are no restrictions on distributing unmodified copies of vim", "unmodified"),
    ("ODbL-1.0", r"this (?:[^ ]+ )?database is made available under the open database license", "database"),
    ("public-domain", r"(?:is|are|been) (?:hereby )?(?:placed|released|dedicated) (?:into|in|to) the public domain", "domain"),
    ("proprietary", r"this (?:software|document|work|material) is (?:the )?(?:confidential and proprietary|proprietary and confidential)", "proprietary"),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution) (?:[^ ]+ ){0,6}is (?:strictly )?prohibited", "prohibited"),
    ("no-warranty", r"without warranty of any kind express or implied", "warranty"),
    ("no-warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose", "merchantability"),
)

#: Families, where a version or variant is not told.
FAMILIES: tuple[tuple[str, str, str], ...] = (
    ("gpl", r"gnu general public licen[cs]e|gnu gpl", "gnu"),
    ("lgpl", r"gnu lesser general public licen[cs]e|gnu lgpl", "gnu"),
    ("apache", r"apache(?: software)? licen[cs]e", "apache"),
    ("bsd", r"bsd(?: style)? licen[cs]e", "bsd"),
    ("mozilla", r"mozilla public licen[cs]e", "mozilla"),
    ("eclipse", r"eclipse public licen[cs]e", "eclipse"),
    ("artistic", r"artistic licen[cs]e", "artistic"),
    ("cc-by", r"cc by|creative commons attribution", "cc by|creative"),
    ("cc-by-nc", r"cc by nc|creative commons attribution non ?commercial", "cc by|creative"),
    ("cc-by-nd", r"cc by nd|creative commons attribution no ?deriv(?:ative)?s", "cc by|creative"),
    ("cc-by-sa", r"cc by sa|creative commons attribution share ?alike", "cc by|creative"),
    ("cc-by-nc-nd", r"cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc by|creative"),
    ("cc-by-nc-sa", r"cc by nc sa|creative commons attribution non ?commercial share ?alike", "cc by|creative"),
    ("creative-commons", r"creative commons(?: licen[cs]e)?", "creative"),
    ("public-domain", r"public domain", "domain"),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright"),
    ("all-rights-reserved", r"all rights reserved", "reserved"),
    ("unknown-license", r"licen[cs]ed under|under the terms of (?:the|this) licen[cs]e|license agreement", "licen"),
)
#: Kinds of rules: priority and confidence.
KINDS = {"tag": (5, 1.0), "clause": (4, 0.95), "grant": (3, 0.9), "name": (2, 0.7), "family": (1, 0.4)}
GRANT = r"(?:licen[cs]ed|released|distributed|published|available|provided|covered|redistributed) (?:[^ ]+ ){0,2}under (?:the )?(?:terms of )?(?:the )?"


@cache
def rules() -> tuple[tuple[str, str, str, tuple[str, ...]], ...]:
    """All rules in order: label, kind, pattern over words, keywords of which one
    is in every match.  Each license has three: its tag, its grant, its name."""
    out = []
    for label, (name, key) in NAMES.items():
        keys = tuple(key.split("|"))
        words = re.sub(r"[^0-9a-z]+", " ", label.lower())
        out.append((label, "tag", f"spdx license identifier {words}(?: only| or later)?", ("spdx",)))
        out.append((label, "grant", f"{GRANT}(?:{name})", ("under",)))
        out.append((label, "name", name, keys))
    out += [(label, "clause", text, (key,)) for label, text, key in CLAUSES]
    out += [(label, "family", text, tuple(key.split("|"))) for label, text, key in FAMILIES]
    return tuple(out)


#: What every match of a rule has in the raw text, in lower case; texts without
#: it run no rule.
GATE = rf"licen|spdx|gpl|unlicense|wtfpl|cc0|creative|clause|copyright|domain|reserved|disclaimer|hereby|substantial|redistribut|endorse|advertising|option|liable|unencumbered|waived|verbatim|unmodified|proprietary|prohibited|warranty|(?:^|[{GAP}])cc[{GAP}]+by(?:[{GAP}]|$)|mit[{GAP}]+no[{GAP}]"
FIELDS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:long,end:long,label:string,kind:string>>"


def word_string(raw: bytes) -> bytes:
    """The words of a text, one space between them."""
    return b" ".join(w for w in raw.translate(_lowered()).split(b" ") if w)


@cache
def _lowered() -> bytes:
    kept = lambda c: c > 0x7F or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    return bytes(c + 32 if 0x41 <= c <= 0x5A else c if kept(c) else 0x20 for c in range(256))


class Scanner:
    """Compiled rules and the automaton of their keywords."""

    def __init__(self):
        import ahocorasick

        self.compiled = [(label, kind, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())) for label, kind, pattern, _ in rules()]
        by_key: dict[str, list[int]] = {}
        for i, (_, _, _, keys) in enumerate(rules()):
            for key in keys:
                by_key.setdefault(key, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for key, numbers in by_key.items():
            self.automaton.add_word(key, numbers)
        self.automaton.make_automaton()

    def detections(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes of all rules, unresolved."""
        wanted: set[int] = set()
        seen: set[int] = set()
        for _, numbers in self.automaton.iter(text.decode("latin-1")):
            if id(numbers) not in seen:
                seen.add(id(numbers))
                wanted.update(numbers)
        return [(m.start(), m.end(), i) for i in sorted(wanted) for m in self.compiled[i][2].finditer(text)]


def resolve(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections that no other one suppresses, by start.

    Priorities are taken from the highest down.  Within one, a sweep by start
    leaves those that are inside no other; those inside one of a higher priority
    fall as well.
    """
    kept: list[tuple[int, int, int]] = []
    priority = lambda x: KINDS[rules()[x[2]][1]][0]
    for level in sorted({priority(x) for x in found}, reverse=True):
        above = sorted(kept)
        starts = [x[0] for x in above]
        reach, most = [], -1
        for x in above:
            most = max(most, x[1])
            reach.append(most)
        furthest = -1
        for start, end, rule in sorted((x for x in found if priority(x) == level), key=lambda x: (x[0], -x[1], x[2])):
            if end <= furthest:
                continue
            furthest = end
            before = bisect_right(starts, start)
            if not before or reach[before - 1] < end:
                kept.append((start, end, rule))
    return sorted(kept)


def base_places(text: bytes) -> list[tuple[int, str]]:
    """(byte, label) of all places of base phrases."""
    framed, out = b" " + text + b" ", []
    for phrase, label in BASE:
        sought = f" {phrase} ".encode()
        at = framed.find(sought)
        while at >= 0:
            out.append((at, label))
            at = framed.find(sought, at + 1)
    return sorted(out)


def word_numbers(text: bytes, places: list[int]) -> dict[int, int]:
    """How many words begin before each byte; one pass over the text."""
    out, last, n = {}, 0, 0
    for at in sorted(set(places)):
        n += text.count(b" ", last, at)
        out[at], last = n, at
    return out


def judge(scanner: Scanner, raw: bytes) -> tuple:
    """n_base to detections of FIELDS for one text."""
    text = word_string(raw)
    base = base_places(text)
    kept = resolve(scanner.detections(text))
    number = word_numbers(text, [at for at, _ in base] + [x for s, e, _ in kept for x in (s, e)])
    firsts = [number[at] for at, _ in base]
    labels = {label for _, label in base}
    named = labels | {rules()[i][0] for _, _, i in kept}
    score = max([KINDS[rules()[i][1]][1] for _, _, i in kept] + [KINDS["family"][1]] * bool(base), default=0.0)
    shown = [{"start": number[s], "end": number[e] + 1, "label": rules()[i][0], "kind": rules()[i][1]} for s, e, i in kept]
    return len(base), min(firsts, default=None), max(firsts, default=None), ",".join(sorted(labels)), ",".join(sorted(named)), score, shown


def scan_batches(batches, text_col: str, schema):
    import pyarrow as pa
    import pyarrow.compute as pc

    scanner = Scanner()
    nothing = (0, None, None, "", "", 0.0, [])
    for whole in batches:
        for batch in slices(whole, 16 << 20, text_col):
            text = batch.column(text_col).fill_null("")
            lower = pc.ascii_lower(text)  # no cast before: of a slice's, Arrow 23 lowers the wrong bytes
            counts = pc.count_substring_regex(lower, f"[^{GAP}]+").cast(pa.int64())
            gate = pc.match_substring_regex(lower, GATE).to_pylist()
            rows = [judge(scanner, text[i].as_py().encode()) if hit else nothing for i, hit in enumerate(gate)]
            made = [counts] + [pa.array([r[k] for r in rows], schema.field(f).type) for k, f in enumerate(list(schema.names)[-7:])]
            yield pa.RecordBatch.from_arrays([batch.column(f) for f in schema.names[:-8]] + made, schema=schema)


def scan_licenses(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The columns of ``df``, then those of :data:`FIELDS` but doc_id, which
    replace columns of the same names.

    n_words, the places of base phrases (n_base, first_word, last_word: words
    from 0), base_labels, labels (base and detected, sorted), score (of the
    surest detection; 0 without any), detections (start and end in words, end
    exclusive).
    """
    from functools import partial

    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    df, source = text_source(df, text_col)
    out = with_outputs(df.schema, FIELDS.split(", ", 1)[1])
    return df.mapInArrow(partial(scan_batches, text_col=source, schema=to_arrow_schema(out)), out).drop("__siftworks_text")
