"""Licence scan: template markup compiled to token automata, and plain phrases.

A template is words with markup: ``<<beginOptional>>`` and ``<<endOptional>>`` hold wording that may be missing (they nest),
and ``<<var;NAME;LOW;HIGH>>`` stands for LOW to HIGH words of any kind. It is compiled to an automaton over words. A text
carries the template's licence where consecutive words lead from its start to its end; mandatory wording must be the same
word for word. Of matches that lie in each other the longest counts, so a text that goes on as another licence does not
carry the shorter one, and a notice right behind a negation states nothing. Only texts that hold every mandatory word are searched, and only from words that can begin the template.

Words: A-Z lower-cased, then runs of ASCII letters, digits and all characters beyond ASCII.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Phrases and the labels they give.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Texts and notices in template markup and the labels they give; what follows # tells templates of one label apart, and
# those named part are no whole licence.
TEMPLATES = {
    "GPL-3.0#part": "<<beginOptional>>this <<var;work;1;3>> is<<endOptional>> <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> the gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 3 <<beginOptional>>of the license<<endOptional>> <<beginOptional>>or at your option any later version<<endOptional>>",
    "GPL-2.0#part": "the gnu general public license <<beginOptional>>as published by the free software foundation either<<endOptional>> version 2 <<beginOptional>>of the license<<endOptional>> <<beginOptional>>or at your option any later version<<endOptional>>",
    "GPL#part": "distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "Apache-2.0#part": "licensed under the apache license version 2 0 <<beginOptional>>the license you may not use this file except in compliance with the license<<endOptional>>",
    "Apache-2.0#part end": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "MIT#part": "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "MIT#part grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of the software",
    "BSD-3-Clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<var;bullet;0;2>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<var;bullet;0;2>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution <<var;bullet;0;2>> neither the name of <<var;organisation;1;12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD-2-Clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<var;bullet;0;2>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<var;bullet;0;2>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by <<var;holder;1;12>> as is",
    "Zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "Unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "Apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at <<var;address;1;10>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "MIT#part warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<var;holder;1;12>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at <<var;address;1;8>>",
    "ISC": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "CC-BY-NC-4.0#part": "licensed under <<beginOptional>>a<<endOptional>> cc by nc 4 0 <<beginOptional>>license<<endOptional>>",
    "CC-BY-SA-4.0#part": "licensed under <<beginOptional>>a<<endOptional>> cc by sa 4 0 <<beginOptional>>license<<endOptional>>",
    "CC-BY-4.0#part": "licensed under <<beginOptional>>a<<endOptional>> cc by 4 0 <<beginOptional>>license<<endOptional>>",
}

# The whole licence is its grant and its warranty.
TEMPLATES["MIT"] = TEMPLATES["MIT#part grant"] + " " + TEMPLATES["MIT#part warranty"]
NEGATIONS = {b"not", b"never", b"cannot"}

MARKUP = re.compile(r"<<(.*?)>>|([^\s<>]+)", re.DOTALL)
NOT_WORD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text, as UTF-8; bytes beyond ASCII are word characters alike."""
    return text.encode("utf-8", "replace").lower().translate(NOT_WORD).split()


class Automaton:
    """States 0 to end; word edges, any-word edges and free edges. Built from markup, run over words from a start."""

    def __init__(self, markup: str) -> None:
        self.word: list[dict[bytes, int]] = [{}]
        self.any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        at, begun, depth_words = 0, [], []
        for mark, word in MARKUP.findall(markup):
            if word:
                for w in words_of(word):
                    nxt = self._state()
                    self.word[at][w] = nxt
                    at = nxt
                    depth_words.append((w, len(begun)))
            elif mark == "beginOptional":
                begun.append(at)
                at = self._after(at)
            elif mark == "endOptional":
                nxt = self._after(at)
                self.free[begun.pop()].append(nxt)
                at = nxt
            else:
                _, _, low, high = mark.split(";")
                low, high = int(low), int(high)
                entry = []
                for k in range(high):
                    if k >= low:
                        entry.append(at)
                    nxt = self._state()
                    self.any[at].append(nxt)
                    at = nxt
                end = self._after(at)
                for s in entry:
                    self.free[s].append(end)
                at = end
                depth_words.append((None, len(begun)))
        self.end = at
        if begun:
            raise ValueError("an optional region is not closed")
        self.mandatory = [w for w, depth in depth_words if w and not depth]
        if not self.mandatory:
            raise ValueError("a template needs mandatory wording")
        self.closed = [self._closure(s) for s in range(len(self.word))]
        self.first = {w for s in self.closed[0] for w in self.word[s]}
        self.open_start = any(self.any[s] for s in self.closed[0])

    def _state(self) -> int:
        self.word.append({}), self.any.append([]), self.free.append([])
        return len(self.word) - 1

    def _after(self, at: int) -> int:
        nxt = self._state()
        self.free[at].append(nxt)
        return nxt

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def match(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest match that begins at start; None if there is none."""
        now, best, at = self.closed[0], None, start
        while now:
            if self.end in now:
                best = at
            if at == len(words):
                break
            w, nxt = words[at], set()
            for s in now:
                if w in self.word[s]:
                    nxt |= self.closed[self.word[s][w]]
                for t in self.any[s]:
                    nxt |= self.closed[t]
            now, at = nxt, at + 1
        return best


def outermost(spans: list[tuple]) -> list[tuple]:
    """The spans (start, end, ...) that lie in no longer one."""
    out, reach = [], (0, -1)
    for span in sorted(spans, key=lambda m: (m[0], -m[1])):
        if span[1] > reach[1] or span[:2] == reach:
            out.append(span)
            reach = span[:2]
    return out


class Scanner:
    """Phrases and templates over word lists."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.phrases = [(tuple(words_of(p)), label) for p, label in phrases.items()]
        self.automata = [(*name.partition("#")[::2], Automaton(t)) for name, t in templates.items()]
        self.starts: dict[bytes, list[tuple[tuple[bytes, ...], str]]] = {}
        for p, label in self.phrases:
            self.starts.setdefault(p[0], []).append((p, label))

    def scan(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base labels, all labels, score)."""
        words = words_of(text)
        places, labels = [], set()
        held = set(words)
        if self.starts.keys() & held:
            for i, w in enumerate(words):
                for phrase, label in self.starts.get(w, ()):
                    if tuple(words[i : i + len(phrase)]) == phrase:
                        places.append(i)
                        labels.add(label)
        base, spans = set(labels), []
        for label, part, a in self.automata:
            if held.issuperset(a.mandatory):
                upto = -1
                for i in range(len(words)) if a.open_start else (i for i, w in enumerate(words) if w in a.first):
                    # what begins inside a match of the same template and ends no later is part of it
                    if (end := a.match(words, i)) is not None and end > upto:
                        spans.append((i, end, label, bool(part)))
                        upto = end
        kept = [m for m in outermost(spans) if not (m[3] and m[0] and words[m[0] - 1] in NEGATIONS)]
        found = {label for _, _, label, _ in kept}
        # one label a licence: a version tells more than the name alone
        labels |= {x for x in found if not any(y.startswith(x + "-") for y in found)}
        # 1 with a whole licence, three quarters with a notice or a part, one half with a phrase alone
        score = max((0.75 if part else 1.0 for *_, part in kept), default=0.5 if places else 0.0)
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): counts and places of phrases, labels and a score.

    A null text counts as empty: no words, no places, empty labels, null places. first_word and last_word are the smallest
    and largest start of a phrase. labels has the phrases' labels and those of the licences. score is 1 for a whole licence, 0.75 for
    a notice or a part of one, 0.5 for a phrase alone, else 0. Texts of any length are read whole; of places that tie the smallest and largest are
    given; repeated rows are scanned each; an empty table gives an empty result. There is no shuffle; other columns are left
    out, those with names of the result's too.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, templates)
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in batches:
            found = pd.DataFrame([scanner.scan(t or "") for t in batch.text], columns=names)
            found = found.astype({"first_word": "Int64", "last_word": "Int64"})
            found.insert(0, "doc_id", batch.doc_id.astype("Int64").to_numpy())
            yield found.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
