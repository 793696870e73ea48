import re
import textwrap

import pytest
import tricky

import __spark_entry__ as entry
from vacancylens.llm import licenses

MIT = """Foo bar.
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("text before\nReleased under the MIT License.\nand after", ["MIT"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("Copyright 2020 Somebody. All rights reserved.", ["Proprietary"]),
        (MIT, ["MIT"]),
        (GPL, ["GPL-3.0-or-later"]),
        (MIT + "\nLicensed under the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
        ("The licence of the driver was lost under the bridge.", []),
        ("See the license for the specific language governing permissions and limitations under the license.", []),
    ],
)
def test_rules(text, expected):
    found = licenses.sentences(text)
    assert licenses.match_rules(found)[0] == expected


def test_left_over_sentences():
    found = licenses.sentences("You may obtain a copy of the License at http://x.example/y")
    assert licenses.match_rules(found) == ([], ["apache-copy"])


def test_every_sentence_has_a_hint_and_its_own_identifier():
    for name, pattern in licenses.SENTENCES:
        assert licenses._HINT.search(re.sub(r"[\\(?:)]", "", pattern).encode()), name
        assert re.sub(r"^(\(\?:)+|^\\d ", "", pattern).split()[0].strip(")?:").lower() in licenses._BEGIN | {"\\d"}, name
    assert {x for rule, _ in licenses.RULES for x in rule} <= {name for name, _ in licenses.SENTENCES}


def test_odd_rows(spark):
    got = licenses.scan(tricky.documents(spark)).collect()
    assert len(got) == len(tricky.TEXTS) and all(r.licences == [] and r.sentence_ids == [] for r in got)
    assert licenses.scan(tricky.documents(spark, [])).count() == 0


def test_query_finds_every_plain_license_line(spark):
    sf = "/root/testdata/sf0.01"
    plain = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "All rights reserved.": "Proprietary",
    }
    got = {r.doc_id: r.licences for r in entry.queries()["op3_license_sentences"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        lines = [plain[x] for x in row.text.split("\n") if x in plain]
        assert set(lines) <= set(got[row.doc_id]) and (lines or not got[row.doc_id])


APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS."""
MIT_WHOLE = "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + MIT + """

IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GPL_COPY = "\n\nYou should have received a copy of the GNU General Public License\nalong with this program.  If not, see <https://www.gnu.org/licenses/>."


def wrapped(text, width=None):
    """Words in lines of another width, paragraphs kept."""
    return "\n\n".join("\n".join(textwrap.wrap(" ".join(p.split()), width or 10**6, break_long_words=False, break_on_hyphens=False)) for p in text.split("\n\n"))


@pytest.mark.parametrize(
    "text, expected",
    [
        (APACHE, "Apache-2.0"),
        (MPL, "MPL-2.0"),
        (BSD2, "BSD-2-Clause"),
        (BSD3, "BSD-3-Clause"),
        (ISC, "ISC"),
        (ISC.replace("and/or", "and"), "ISC"),
        (MIT_WHOLE, "MIT"),
        (GPL + GPL_COPY, "GPL-3.0-or-later"),
        ((GPL + GPL_COPY).replace("software:", "software;").replace("version 3", "version 2"), "GPL-2.0-or-later"),
        ((GPL + GPL_COPY).replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
        ((GPL + GPL_COPY).replace("GNU General", "GNU Lesser General").replace("program", "library").replace("version 3", "version 2.1"), "LGPL-2.1-or-later"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("Licensed under the Mozilla Public License,\nv. 2.0.", "MPL-2.0"),
        ("Licensed under the GNU GPL, v.\n3.", "GPL-3.0"),
    ],
)
@pytest.mark.parametrize("comment", ["", "# ", " * "])
def test_standard_notices_are_matched_whole(text, expected, comment):
    for shown in (text, wrapped(text, 60), wrapped(text, 75), wrapped(text, 40), wrapped(text, 26), wrapped(text, 20), wrapped(text, 12), wrapped(text)):
        found = licenses.sentences("".join(f"{comment}{x}\n" for x in shown.split("\n")))
        assert licenses.match_rules(found) == ([expected], []), shown


def test_sentences_with_long_names_and_no_end():
    name = "the " + "Very Long and Honourable " * 40 + "Company"
    endorse = f"Neither the name of {name} may be used to endorse or promote products derived from this software without specific prior written permission."
    for width in (None, 20, 60):
        assert licenses.sentences(wrapped(endorse, width)) == [("bsd-endorse", "", "")]
        assert licenses.sentences(wrapped(f"Copyright 2020 {name} All rights reserved", width)) == [("all-rights", "", "")]
    # A name ends where another known sentence begins.
    found = licenses.sentences("Copyright 2020 Somebody\nLicensed under the MIT License\nAll rights reserved")
    assert [n for n, _, _ in found] == ["mit-ref", "all-rights"]


def test_many_lines_without_an_end_take_no_time():
    for line in ("Copyright 2020 Somebody", "neither the name of it", "permission is hereby", "the software", "see the license"):
        assert licenses.sentences(f"{line}\n" * 20_000) == []
    assert licenses.sentences("Copyright 2020 me\n" + "some words\n" * 100_000) == []


def test_every_known_sentence_is_found_at_any_width():
    """Each fixed sentence, as plain words, wrapped after every word."""
    for name, pattern in licenses.SENTENCES:
        words = re.sub(r"\(\?:(\S+?)\|[^()]*?\)(?!\?)", r"\1", pattern)
        if re.search(r"[\\()\[\].*+?{}|]", words):
            continue
        assert [n for n, _, _ in licenses.sentences(words.replace(" ", "\n"))] == [name], words
