"""Whole license texts: accepted as published, refused when their mandatory wording is changed."""

import pytest

from dealsieve.llm import license_templates as L

MIT = """MIT License. Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
   the documentation and/or other materials provided with the distribution.
3. Neither the name of the Example Institute nor the names of its contributors may be used to endorse or promote products derived
   from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TWO_CLAUSES = BSD[:BSD.index("3. Neither")] + BSD[BSD.index("THIS SOFTWARE"):]

GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""


def labels(text):
    found = L.scan_text(L.lower_words(text), L.Automaton([(a, b) for b, a in L.PHRASES.items()]), L.Automaton(L.TEMPLATES))
    return set(found["labels"].split(",")), found["score"]


@pytest.mark.parametrize("text, label", [(MIT, "mit-text"), (BSD, "bsd-text"), (TWO_CLAUSES, "bsd-text"), (GPL, "gpl-header"),
                                         (GPL[:GPL.index("\n\n")], "gpl-header")])
def test_published_texts_are_accepted(text, label):
    for whole in (text, "before " * 30 + text + " after" * 30, text.upper(), text.replace(" ", "\n# ")):
        found, score = labels(whole)
        assert label in found and score == 1.0


@pytest.mark.parametrize("text, old, new, label", [
    (MIT, "to any person obtaining", "to NOBODY obtaining", "mit-text"),
    (MIT, "subject to the following conditions:", "and nothing may be used", "mit-text"),
    (MIT, "WITHOUT WARRANTY", "WITH A FULL WARRANTY", "mit-text"),
    (MIT, "shall be included in all copies or substantial portions of the Software.", "", "mit-text"),
    (BSD, "2. Redistributions in binary", "You pay us a fee. 2. Redistributions in binary", "bsd-text"),
    (BSD, "are permitted provided", "are not permitted provided", "bsd-text"),
    (BSD, "ARE DISCLAIMED", "ARE GIVEN", "bsd-text"),
    (GPL, "you can redistribute it", "you can never redistribute it", "gpl-header"),
    (GPL, "as\npublished by the Free Software Foundation", "", "gpl-header")])
def test_changed_wording_is_refused(text, old, new, label):
    assert old in text
    assert label not in labels(text.replace(old, new))[0]
    assert label not in labels(text[:len(text) // 3])[0]
