"""Licence recognition by sentences and rules.

A text is cut into sentences (at full stops and the like and at line ends; lines
that wrap a sentence are joined again). A sentence in its one form (lower case,
words only) is looked up among known licence sentences, which gives an identifier
and perhaps a version. The identifiers of a text, in order, are matched against
rules: the first rule whose sequence stands there names the licence and takes
its sentences. What is left over is reported as unmatched.

Null and empty texts have no sentence and no licence. Repeated rows are scanned
each. An empty table gives an empty one.
"""

from __future__ import annotations

import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import Texts
from vacancylens.llm.frames import over_texts

_V = r"(?:version )?(?:v ?)?(?P<v>\d(?: \d)?)"
#: Known sentences in their one form (fixed values): identifier and pattern; v is a version.
SENTENCES = (
    ("apache-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? apache(?: software)? license(?: {_V})?(?: the license)?"),
    ("apache-ref", rf"(?:the )?apache(?: software)? license {_V}(?: the license)?"),
    ("apache-comply", r"(?:you may not use this file except in compliance with the license)"),
    ("apache-copy", r"you may obtain a copy of the license at(?: (?:http )?https? .*| www .*)?"),
    ("apache-basis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("mit-ref", r"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? mit license"),
    ("mit-ref", r"(?:the )?mit license(?: mit)?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:\d )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:\d )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-endorse", r"(?:\d )?neither the name of .+ may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)?(?: {_V} clause)? bsd license"),
    ("gpl-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? (?:gnu general public license|gnu gpl|gpl)(?: {_V})?"),
    ("gpl-free", rf"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either {_V} of the license or at your option any later version"),
    ("lgpl-free", rf"this (?:program|library|software) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either {_V} of the license or at your option any later version"),
    ("agpl-free", rf"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either {_V} of the license or at your option any later version"),
    ("gpl-hope", r"this (?:program|library|software) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-see", r"see the gnu (?:lesser |affero )?general public license for more details"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license along with this (?:program|library|software)(?: if not .*)?"),
    ("lgpl-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? (?:gnu lesser general public license|gnu lgpl|lgpl)(?: {_V})?"),
    ("agpl-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? (?:gnu affero general public license|gnu agpl|agpl)(?: {_V})?"),
    ("mpl-ref", rf"this source code form is subject to the terms of the mozilla public license {_V}"),
    ("mpl-ref", rf"(?:this (?:work|file|software|project) is )?(?:licensed|released|distributed) under the(?: terms of the)? mozilla public license(?: {_V})?"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at(?: https? .*| mozilla .*)?"),
    ("isc-grant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-as-is", r"the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("cc-ref", rf"(?:this (?:work|file|text|page) is )?(?:licensed|released|distributed) under(?: an?| the)? (?:cc|creative commons) (?P<k>by(?: nc)?(?: sa| nd)?|attribution(?: noncommercial)?(?: sharealike| noderiv(?:ative)?s)?)(?: {_V})?(?: international)?(?: license)?"),
    ("cc0-ref", r"(?:this (?:work|file|text|page) is )?(?:licensed|released|distributed) under(?: the)? cc0(?: 1 0)?(?: universal)?"),
    ("public-domain", r"this (?:is free and unencumbered software|work has been) released into the public domain"),
    ("all-rights", r"(?:copyright .* )?all rights reserved"),
)
#: Rules in the order they are tried (fixed values): sequence of identifiers and licence.
RULES = (
    (("apache-ref", "apache-comply", "apache-copy", "apache-basis", "apache-see"), "Apache-{v}"),
    (("mit-ref", "mit-grant", "mit-notice", "as-is", "mit-liable"), "MIT"),
    (("mit-grant", "mit-notice", "as-is", "mit-liable"), "MIT"),
    (("mit-grant", "mit-notice", "as-is"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free", "gpl-hope", "gpl-see", "gpl-copy"), "GPL-{v}-or-later"),
    (("gpl-free", "gpl-hope", "gpl-see"), "GPL-{v}-or-later"),
    (("gpl-free",), "GPL-{v}-or-later"),
    (("lgpl-free", "gpl-hope", "gpl-see", "gpl-copy"), "LGPL-{v}-or-later"),
    (("lgpl-free", "gpl-hope", "gpl-see"), "LGPL-{v}-or-later"),
    (("lgpl-free",), "LGPL-{v}-or-later"),
    (("agpl-free", "gpl-hope", "gpl-see", "gpl-copy"), "AGPL-{v}-or-later"),
    (("agpl-free", "gpl-hope", "gpl-see"), "AGPL-{v}-or-later"),
    (("agpl-free",), "AGPL-{v}-or-later"),
    (("isc-grant", "isc-as-is"), "ISC"),
    (("isc-grant",), "ISC"),
    (("mpl-ref", "mpl-copy"), "MPL-{v}"),
    (("mpl-ref",), "MPL-{v}"),
    (("apache-ref", "apache-copy"), "Apache-{v}"),
    (("apache-ref",), "Apache-{v}"),
    (("mit-ref",), "MIT"),
    (("bsd-ref",), "BSD-{v}-Clause"),
    (("agpl-ref",), "AGPL-{v}"),
    (("lgpl-ref",), "LGPL-{v}"),
    (("gpl-ref",), "GPL-{v}"),
    (("cc-ref",), "CC-{k}-{v}"),
    (("cc0-ref",), "CC0-1.0"),
    (("public-domain",), "Unlicense"),
    (("all-rights",), "Proprietary"),
)

#: Every known sentence has one of these words, so texts without any need no cutting.
_HINT = re.compile(rb"(?i)licen[sc]|permission|redistribution|apache|free software|in no event|as is|general public|hope that|public domain|rights reserved|mozilla|mpl|unless required|neither the name")
# Not after the "v." of a number; also after the ");" that ends a reference.
_CUT = re.compile(r"(?<=[.!?])(?!(?<=\b[vV]\.)\s*\d)[^\w\s]*(?:\s+|$)|(?<=\);)\s+|\n+")
_NUMBER_FOLLOWS = re.compile(r"\b[vV]\.\s*$")
_WORD = re.compile(r"[^\W_]+")
_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
_FIRST = re.compile("|".join(f"(?:{pattern.replace('(?P<v>', '(?:').replace('(?P<k>', '(?:')})" for _, pattern in SENTENCES))
#: Words that known sentences begin with; a number may stand before a condition.
_BEGIN = frozenset(
    "this the licensed released distributed apache mit you unless see permission in redistribution redistributions "
    "neither if copyright all".split()
)
#: Sentences with a name in them, known by what stands before and after it (fixed values).
_AROUND = (("neither the name of ", " may be used to endorse or promote products derived from this software without specific prior written permission"),
           ("copyright ", " all rights reserved"))
#: Parts of the names of Creative Commons licences, where they are written out.
_CC = {"attribution": "by", "noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd", "noderivs": "nd"}


_FIXED = "|".join(f"(?:{p.replace('(?P<v>', '(?:').replace('(?P<k>', '(?:')})" for _, p in SENTENCES if ".+" not in p and "copyright .*" not in p)
#: Known sentences without a name, and the beginnings of the others, for looking whether words may become one.
_GROWING = regex.compile("|".join([_FIXED, "all rights reserved", *(rf"(?:\d )?{head}" for head, _ in _AROUND)]))


def one_form(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def _ended(part: str) -> bool:
    return part.rstrip().rstrip("\"')]}*#$%&").endswith((".", "!", "?")) and not _NUMBER_FOLLOWS.search(part)


def identify(form: str) -> tuple[str, str, str] | None:
    """Identifier, version and kind of a sentence in its one form."""
    if not form or not _FIRST.fullmatch(form):
        return None
    for name, pattern in _KNOWN:
        m = pattern.fullmatch(form)
        if m:
            groups = m.groupdict()
            version = (groups.get("v") or "").replace(" ", ".")
            kind = "-".join(_CC.get(x, x) for x in (groups.get("k") or "").split())
            return name, version, kind.upper()
    return None


def _begins(form: str) -> bool:
    """Whether some known sentence begins with these words."""
    return bool(form) and _GROWING.fullmatch(form + " ", partial=True) is not None


class _Parts:
    """The parts of a text that its sentences are put together from."""

    def __init__(self, text: str) -> None:
        parts = [p for p in _CUT.split(text) if p and not p.isspace()]
        self.forms, self.ended = [one_form(p) for p in parts], [_ended(p) for p in parts]
        self._plain: dict[int, tuple[str, int] | None] = {}

    def goes_on(self, n: int) -> bool:
        return n + 1 < len(self.forms) and not self.ended[n]

    def may_begin(self, k: int) -> bool:
        first = self.forms[k].partition(" ")[0]
        return first in _BEGIN or first.isdigit()

    def _grown(self, k: int) -> tuple[str, int, bool]:
        """Words from part ``k`` on until they are a known sentence or cannot become one."""
        joined, n = self.forms[k], k
        while (hit := identify(joined)) is None and self.goes_on(n) and _begins(joined):
            n += 1
            joined = f"{joined} {self.forms[n]}".strip()
        return joined, n, hit is not None

    def plain(self, k: int) -> bool:
        """Whether a known sentence begins at part ``k``, however it is wrapped."""
        if k not in self._plain:
            self._plain[k] = self.may_begin(k) and self._grown(k)[2]
        return self._plain[k]

    def sentence(self, k: int) -> tuple[str, int]:
        """The words of a sentence at part ``k`` and the part after it.

        There is no bound on its lines: a known sentence has so many words, and one
        with a name in it goes on to its own end, a full stop or another known sentence.
        """
        joined, n, known = self._grown(k)
        if known:
            return joined, n + 1
        bare = re.sub(r"^\d ", "", joined)
        for head, tail in _AROUND:
            if f"{bare} ".startswith(head):
                pieces, last = [joined], joined[-len(tail) :]
                while self.goes_on(n) and not self.forms[n + 1].startswith(head) and not self.plain(n + 1):
                    n += 1
                    pieces.append(self.forms[n])
                    last = f"{last} {self.forms[n]}"[-len(tail) :]
                    if last == tail:
                        return " ".join(pieces), n + 1
        return self.forms[k], k + 1


def sentences(text: str) -> list[tuple[str, str, str]]:
    """Identifiers (with version and kind) of the known sentences, in order."""
    parts, found, k = _Parts(text), [], 0
    while k < len(parts.forms):
        if not parts.may_begin(k):
            k += 1
            continue
        joined, after = parts.sentence(k)
        hit = identify(joined)
        # A reference may go on with its version in the next lines.
        n, longer = after - 1, joined
        while hit is not None and hit[0].endswith("-ref") and parts.goes_on(n) and _begins(longer):
            n += 1
            longer = f"{longer} {parts.forms[n]}".strip()
            more = identify(longer)
            if more is not None and more[0] == hit[0] and (more[1] or not hit[1]):
                hit, after = more, n + 1
        if hit is None:
            k += 1
        else:
            found.append(hit)
            k = after
    return found


def match_rules(found: list[tuple[str, str, str]]) -> tuple[list[str], list[str]]:
    """Licences by the ordered rules, by place in the text, and identifiers left over."""
    names = [name for name, _, _ in found]
    free = [True] * len(found)
    licences = []
    for sequence, licence in RULES:
        n = len(sequence)
        for at in range(len(found) - n + 1):
            if all(free[at : at + n]) and tuple(names[at : at + n]) == sequence:
                free[at : at + n] = [False] * n
                version = next((v for _, v, _ in found[at : at + n] if v), "")
                kind = next((k for _, _, k in found[at : at + n] if k), "")
                if version and "." not in version and not licence.startswith("BSD"):
                    version += ".0"
                named = licence.format(v=version or "any", k=kind)
                licences.append((at, named.replace("-any", "")))
    return [x for _, x in sorted(licences)], [name for name, ok in zip(names, free, strict=True) if ok]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, sentence_ids, licences, unmatched`` (arrays of strings)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def read(chunk: Texts, rows: pa.RecordBatch) -> dict:
        ids, licences, rest = [], [], []
        for row in range(len(chunk)):
            raw = chunk.raw(row)
            found = sentences(raw.decode("utf-8", "replace")) if _HINT.search(raw) else []
            named, left = match_rules(found) if found else ([], [])
            ids.append([name for name, _, _ in found])
            licences.append(named)
            rest.append(left)
        return {"doc_id": rows.column(0), "sentence_ids": ids, "licences": licences, "unmatched": rest}

    return over_texts(narrow, read, "doc_id long, sentence_ids array<string>, licences array<string>, unmatched array<string>")
