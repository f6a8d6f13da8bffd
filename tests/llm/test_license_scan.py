import random
import re

import pytest

from quarryline.llm import license_scan as ls

SCHEMA = "doc_id long, text string"
SPACED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(text):
    words = SPACED.findall(lower(text or ""))
    places = [(i, lab) for p, lab in ls.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({lab for _, lab in places}))


def test_phrases_match_brute_force(spark):
    rng = random.Random(3)
    pool = "gnu general public license apache mit cc by CC-BY é — Öl x1 \x85".split(" ")
    texts = [" ".join(rng.choices(pool, k=rng.randrange(30))) for _ in range(150)] + [None, "", "MIT-License/Apache license", "cc by cc by", "mit " * 20000]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "mit license")]
    got = ls.scan_licenses(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score")).collect()
    assert len(got) == len(rows)
    text_of = dict(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text_of[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


@pytest.mark.parametrize(
    ("text", "label", "found"),
    [
        ("Released under the MIT License.", "MIT", True),
        ("under the terms of the MIT License", "MIT", True),
        ("under the free MIT License", "MIT", False),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", True),
        ("under the terms of the GNU General Public License version 2", "GPL-3.0", False),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0", True),
        ("Licensed under the Apache License, Version 20", "Apache-2.0", False),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", True),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-4.0", False),
    ],
)
def test_templates(text, label, found):
    assert (label in ls.Scanner(ls.PHRASES, ls.TEMPLATES).scan(f"x {text} y")[5].split(",")) is found


def test_optional_and_replaceable_regions_against_a_pattern():
    markup = "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;v;0;2>> d <<var;w;1;2>> e"
    auto, pattern = ls.Automaton(markup), re.compile(r"a (b (c )?)?([a-f] ){0,2}d ([a-f] ){1,2}e")
    rng = random.Random(1)
    for _ in range(3000):
        words = rng.choices("abcdef", k=rng.randrange(1, 10))
        ends = [k for k in range(len(words) + 1) if pattern.fullmatch(" ".join(words[:k]))]
        assert auto.match([w.encode() for w in words], 0) == max(ends, default=None)


def test_bad_markup_and_empty_table(spark):
    with pytest.raises(ValueError):
        ls.Automaton("<<beginOptional>>x")
    with pytest.raises(ValueError):
        ls.Automaton("<<var;x;1;2>>")
    assert ls.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
THIRD = "3. Neither the name of the Foo Project nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        (BSD + THIRD + AS_IS, "BSD-3-Clause", 1.0),
        (BSD + AS_IS, "BSD-2-Clause", 1.0),
        (BSD, "", 0.0),
        (GRANT + WARRANTY, "MIT", 1.0),
        (GRANT, "MIT", 0.75),
        (APACHE, "Apache-2.0,apache", 1.0),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0,apache", 0.75),
        ("this is not licensed under the mit license at all", "mit", 0.5),
        ("it was never released under the MIT License", "mit", 0.5),
        ("not mine, but licensed under the MIT License", "MIT,mit", 0.75),
        ("under the GNU General Public License version 3. " + "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", "GPL-3.0,gpl", 0.75),
        (BSD + AS_IS + " " + GRANT + WARRANTY, "BSD-2-Clause,MIT", 1.0),
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0,cc-by", 0.75),
    ],
)
def test_one_label_a_licence(text, labels, score):
    got = ls.Scanner(ls.PHRASES, ls.TEMPLATES).scan(f"See below. {text} End")
    assert (got[5], got[6]) == (labels, score)


def test_outermost_spans_against_all_pairs():
    rng = random.Random(9)
    for _ in range(500):
        spans = list({(a := rng.randrange(12), a + rng.randrange(1, 8), rng.choice("xy"), False) for _ in range(rng.randrange(8))})
        want = [m for m in spans if not any(n[0] <= m[0] and m[1] <= n[1] and n[1] - n[0] > m[1] - m[0] for n in spans)]
        assert sorted(ls.outermost(spans)) == sorted(want)
