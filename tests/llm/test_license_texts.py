"""Whole licenses as they are published, with names, years and marks, and texts that miss a word."""

import random
import re

import pytest

from monthlake.llm import license_scan

MIT = """MIT License

Copyright (c) 2021-2024 Some Body <some@body.example>

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC = """Copyright (c) 2019, Ada Example

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
APACHE = """Copyright 2020 The Example Authors

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
GPL = """    Example is free software: you can redistribute it and/or modify
    it under the terms of the GNU {0}General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {0}General Public License for more details.
"""
BSD = """Copyright (c) 2018, The Example Project
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0}Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{2}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
NAMES = """3. Neither the name of the Example Project nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
CASES = {
    "mit-text": MIT,
    "isc-text": ISC,
    "apache-2.0-header": APACHE,
    "gpl-header": GPL.format(""),
    "lgpl-header": GPL.format("Lesser "),
    "agpl-header": GPL.format("Affero "),
    "bsd-2-text": BSD.format("* ", "* ", ""),
    "bsd-3-text": BSD.format("1. ", "2. ", NAMES),
}
LONG = {n for n in license_scan.TEXTS}


def labels(text):
    machines, phrases = license_scan._compiled(
        license_scan._frozen(license_scan.TEMPLATES), license_scan._frozen(license_scan.PHRASES)
    )
    return license_scan.scan_text(text, machines, phrases)[3] & LONG


@pytest.mark.parametrize("name", sorted(CASES))
def test_published_texts(name):
    text = CASES[name]
    assert labels(text) == {name}
    assert labels("Some code.\n\n" + text.upper() + "\nint main() {}") == {name}
    assert labels(re.sub(r"\s+", " * ", text)) == {name}  # comment marks between the words


@pytest.mark.parametrize("name", sorted(CASES))
def test_a_text_without_one_word_is_not_accepted(name):
    """Any mandatory word left out or changed; words of the holder's own do not matter."""
    text, r = CASES[name], random.Random(5)
    words = re.findall(r"\w+", text)
    start = next(i for i, w in enumerate(words) if w.lower() in ("permission", "redistribution", "licensed", "free"))
    refused = 0
    for at in r.sample(range(start + 8, len(words) - 1), 25):
        broken = words[:at] + ["other"] * r.randint(0, 1) + words[at + 1 :]
        refused += name not in labels(" ".join(broken))
    assert refused >= 22  # the rest hit names, numbers and other open regions
    assert labels(" ".join(words[: len(words) // 2])) == set()


def test_every_template_accepts_its_own_expansions():
    """Random choices of every optional and replaceable region, also by the regular expression of the SQL twin."""
    r = random.Random(2)
    for label, templates in license_scan.TEMPLATES.items():
        for template in templates:
            machine, pattern = license_scan.compile_template(template), re.compile(license_scan.template_regex(template))
            for _ in range(20):
                out = re.sub(r"\[\[(.*?)\]\]", lambda m: r.choice([*m[1].split("|"), ""]), template)
                out = re.sub(r"\{\{(\d+)\.\.(\d+)\}\}", lambda m: " ".join(["xyz"] * r.randint(int(m[1]), int(m[2]))), out)
                words = [w.encode() for w in out.lower().split()]
                assert machine.match(words, 0) == len(words), label
                assert pattern.search(" " + " ".join(w.decode() for w in words) + " "), label
                assert all(k in out.encode().lower() for k in machine.keys)
