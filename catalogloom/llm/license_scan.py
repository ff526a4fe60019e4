"""Licence scans by template-markup matching.

A template is wording with markup: ``<<optional>>...<</optional>>`` may be absent,
``<<var:n>>`` stands for up to n arbitrary words. Each template is compiled to an automaton over
words; a text holds the licence where the automaton accepts a run of its words, that is where all
mandatory wording stands exactly and only marked regions vary. Candidate starts are the places of the
template's first mandatory words, so no text is skipped and none is cut.

Words: A-Z lower-cased, then runs of ASCII letters and digits and of all characters above ASCII.
Null texts are empty; empty texts get zero counts, null word positions and empty labels. Where several templates
accept the same words each gives its label; rows that repeat are scanned each time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .common import map_batches, texts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}
#: Phrase -> label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
_AS_IS = (
    "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
    "shall <<var:8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
    "connection with the software or the use or other dealings in the software"
)
_BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "<<var:1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<var:1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution"
)
_BSD_TAIL = (
    "this software is provided by <<var:8>> as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall <<var:8>> be liable for any direct indirect incidental special "
    "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business "
    "interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in "
    "any way out of the use of this software even if advised of the possibility of such damage"
)


def _gpl(thing: str, name: str, version: str) -> str:
    """The notice that the GNU licences ask for, to the end of its disclaimer."""
    return (
        f"this {thing} is free software you can redistribute it and or modify it under the terms of the gnu {name} license as published by the free software "
        f"foundation either version {version} of the license or at your option any later version this {thing} is distributed in the hope that it will be useful "
        f"but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} license for "
        "more details"
    )


#: Whole texts of public licences, from the grant to the last word, by label.
TEXTS = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "<<optional>>the software<</optional>> to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<</optional>> shall "
        "be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind " + _AS_IS,
    ),
    ("bsd-2", f"{_BSD_HEAD} {_BSD_TAIL}"),
    (
        "bsd-3",
        f"{_BSD_HEAD} <<var:1>> neither the name of <<var:8>> nor the names of its contributors may be used to endorse or promote products derived from this "
        f"software without specific prior written permission {_BSD_TAIL}",
    ),
    (
        "isc",
        "permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies the software is provided as is and <<var:6>> disclaims all warranties "
        "with regard to this software including all implied warranties of merchantability and fitness in no event shall <<var:6>> be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from "
        "the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions <<var:1>> the origin of this software must not be misrepresented you must not claim that "
        "you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not "
        "required <<var:1>> altered source versions must be plainly marked as such and must not be misrepresented as being the original software <<var:1>> this "
        "notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this "
        "software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that "
        "recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law the software is provided as is without warranty of "
        "any kind " + _AS_IS.replace("<<var:8>>", "the authors"),
    ),
]
#: Notices by which public licences are applied, each to its own end, by label.
NOTICES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license <<optional>>version<</optional>> 2"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial <<optional>>sharealike<</optional>> <<var:2>> <<optional>>international<</optional>> license"),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of "
        "the license at <<var:8>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and "
        "limitations under the license",
    ),
    ("gpl-2", _gpl("program", "general public", "2")),
    ("gpl-3", _gpl("program", "general public", "3")),
    ("agpl-3", _gpl("program", "affero general public", "3")),
    ("lgpl-2.1", _gpl("library", "lesser general public", "2 1")),
    ("lgpl-3", _gpl("library", "lesser general public", "3")),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can "
        "obtain one at <<var:1>> mozilla org mpl 2 0",
    ),
    ("cc0", "to the extent possible under law <<var:12>> has waived all copyright and related or neighboring rights to <<var:12>> this work"),
    (
        "cc0",
        "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain "
        "worldwide this software is distributed without any warranty",
    ),
]
TEMPLATES = TEXTS + NOTICES
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_accepted long, text_labels string"


class TemplateAutomaton:
    """States over words: ``moves[s]`` is a word and the next state, ``any_to[s]`` the next for any word, ``free[s]`` moves without a word."""

    def __init__(self, markup: str):
        self.moves, self.any_to, self.free = [], [], []
        self.head: list[str] = []
        state, opened, leading = self._state(), [], True
        for part in re.findall(r"<<.*?>>|[^<\s]+", markup):
            if part == "<<optional>>":
                opened.append(state)
                leading = leading and not self.head
            elif part == "<</optional>>":
                self.free[opened.pop()].append(state)
            elif m := re.fullmatch(r"<<var:(\d+)>>", part):
                first, steps = state, []
                for _ in range(int(m[1])):
                    steps.append(state)
                    state = self._step(state, None)
                for s in steps:
                    self.free[s].append(state)
                leading = leading and not self.head and first == 0
            else:
                state = self._step(state, part)
                if not opened and leading:
                    self.head.append(part)
                    continue
            leading = leading and not self.head
        self.final = state
        if not self.head or self.moves[0] != (self.head[0], 1):
            raise ValueError("a template begins with mandatory wording")

    def _state(self) -> int:
        for kind in (self.moves, self.any_to):
            kind.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _step(self, state: int, word: str | None) -> int:
        after = self._state()
        if word is None:
            self.any_to[state] = after
        else:
            self.moves[state] = (word, after)
        return after

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def accepts_at(self, words: list[str], start: int) -> int:
        """Words of the shortest accepted run from ``start``; 0 if none is accepted."""
        states = self._closed({0})
        for i in range(start, len(words)):
            after = set()
            for s in states:
                if self.moves[s] and self.moves[s][0] == words[i]:
                    after.add(self.moves[s][1])
                if self.any_to[s] is not None:
                    after.add(self.any_to[s])
            states = self._closed(after)
            if self.final in states:
                return i + 1 - start
            if not states:
                return 0
        return 0


def places(line: str, phrase: str) -> list[int]:
    """Word positions of ``phrase`` in ``line`` (words with a space before and after each), overlaps included."""
    found, at, word, seen = [], -1, 0, 0
    while (at := line.find(f" {phrase} ", at + 1)) >= 0:
        word += line.count(" ", seen, at)
        seen = at
        found.append(word)
    return found


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, base=None) -> DataFrame:
    """One row per input row: word count, base phrase places, labels of phrases and accepted templates.

    ``score`` is the largest share of mandatory words among accepted passages (0 if none is accepted). ``text_labels`` are
    those of templates that are whole licences (``TEXTS``), not notices or mentions of one.
    """
    whole = {markup for _, markup in (TEXTS if templates is None else [])}
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base

    def fn(batch, kept={}):  # noqa: B006  compiled once for each task
        if not kept:
            kept["a"] = [(label, TemplateAutomaton(markup), markup in whole) for label, markup in templates]
            kept["mandatory"] = [len(re.sub(r"<<optional>>.*?<</optional>>|<<.*?>>", " ", markup).split()) for _, markup in templates]
        rows = {c.split()[0]: [] for c in SCHEMA.split(", ")}
        find = re.compile(WORD).findall
        for text in batch.column("text").to_pylist():
            words = find(text.translate(LOWER))
            line = f" {' '.join(words)} "
            hits = [(p, label) for phrase, label in base.items() for p in places(line, phrase)]
            labels, of_texts, score, accepted = {label for _, label in hits}, set(), 0.0, 0
            for (label, automaton, is_text), mandatory in zip(kept["a"], kept["mandatory"], strict=True):
                for p in places(line, " ".join(automaton.head)):
                    if n := automaton.accepts_at(words, p):
                        labels.add(label)
                        if is_text:
                            of_texts.add(label)
                        accepted += 1
                        score = max(score, min(1.0, mandatory / n))
            at = [p for p, _ in hits]
            for name, value in zip(
                rows,
                (None, len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})), ",".join(sorted(labels)), score, accepted, ",".join(sorted(of_texts))),
                strict=True,
            ):
                rows[name].append(value)
        yield rows | {"doc_id": batch.column("doc_id")}

    return map_batches(texts(df, id_col, text_col), fn, SCHEMA)
