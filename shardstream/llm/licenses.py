"""License scan: templates with optional and replaceable regions, compiled to token automata.

A template is text with the markup of license lists: ``<<optional>> ... <<end>>`` around words that may
be missing, and ``<<words 1-4>>`` for a region that any one to four words may fill. It accepts a stretch of a
document whose mandatory wording matches word for word; case of A-Z and everything between words
do not count.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from shardstream.llm.common import map_rows

# The phrases every scan looks for, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wordings of public licenses and of the notices that point to them.
TEMPLATES = {
    "apache-2.0": "<<optional>>licensed under<<end>> the apache license <<optional>>version<<end>> 2.0"
    " <<optional>>the license<<end>>",
    "gpl-2.0": "<<optional>>licensed under<<end>> the gnu general public license <<optional>>as published by the free"
    " software foundation either<<end>> version 2 <<optional>>of the license<<end>>"
    " <<optional>>or <<words 1-3>> later version<<end>>",
    "gpl-3.0": "<<optional>>licensed under<<end>> the gnu general public license <<optional>>as published by the free"
    " software foundation either<<end>> version 3 <<optional>>of the license<<end>>"
    " <<optional>>or <<words 1-3>> later version<<end>>",
    "cc-by-4.0": "licensed under <<optional>>a creative commons<<end>> cc by 4.0 <<optional>>international<<end>>",
    "cc-by-nc-4.0": "licensed under <<optional>>a creative commons<<end>> cc by nc 4.0 <<optional>>international<<end>>",
    "cc-by-sa-4.0": "licensed under <<optional>>a creative commons<<end>> cc by sa 4.0 <<optional>>international<<end>>",
    "mit-notice": "<<optional>>released<<end>> <<optional>>licensed<<end>> under the <<optional>>terms of the<<end>>"
    " mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files <<optional>>the software<<end>> to deal in the software without restriction"
    " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
    " copies of the software and to permit persons to whom the software is furnished to do so subject to the following"
    " conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>>"
    " shall be included in all copies or substantial portions of the software the software is provided as is without"
    " warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for"
    " a particular purpose and noninfringement in no event shall <<words 1-8>> be liable for any claim damages or other"
    " liability whether in an action of contract tort or otherwise arising from out of or in connection with the software"
    " or the use or other dealings in the software",
    "isc-text": "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or"
    " without fee is hereby granted provided that the above copyright notice and this permission notice appear in all"
    " copies the software is provided as is and <<words 1-8>> disclaims all warranties with regard to this software"
    " including all implied warranties of merchantability and fitness in no event shall <<words 1-8>> be liable for any"
    " special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or"
    " profits whether in an action of contract negligence or other tortious action arising out of or in connection with"
    " the use or performance of this software",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided"
    " that the following conditions are met <<optional>>1<<end>> redistributions of source code must retain the"
    " <<optional>>above<<end>> copyright notice this list of conditions and the following disclaimer"
    " <<optional>>2<<end>> redistributions in binary form must reproduce the above copyright notice this list of"
    " conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
    " <<optional>><<optional>>3<<end>> neither the name of <<words 1-12>> nor the names of its contributors may be used"
    " to endorse or promote products derived from this software without specific prior written permission<<end>>"
    " this software is provided by <<words 1-12>> as is and any express or implied warranties including but not limited to"
    " the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall"
    " <<words 1-12>> be liable for any direct indirect incidental special exemplary or consequential damages including but"
    " not limited to procurement of substitute goods or services loss of use data or profits or business interruption"
    " however caused and on any theory of liability whether in contract strict liability or tort including negligence or"
    " otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
}

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARKUP = re.compile(r"<<(optional|end|words (\d+)-(\d+))>>|([^<]+)")
NEEDLE_WORDS = 3


class Automaton:
    """A template as states between words: ``steps[s]`` are the words that lead on, ``free[s]`` the states reached
    without a word, ``anyword[s]`` those reached over any word. The last state accepts."""

    def __init__(self, template: str):
        self.steps: list[tuple[bytes, int] | None] = [None]
        self.free: list[list[int]] = [[]]
        self.anyword: list[list[int]] = [[]]
        self.runs: list[list[bytes]] = [[]]  # mandatory words that stand side by side
        opened: list[int] = []
        for kind, low, high, words in MARKUP.findall(template):
            if words:
                for word in WORD.findall(words.lower().encode()):
                    at = len(self.steps) - 1
                    self._state()
                    self.steps[at] = (word, at + 1)
                    if not opened:
                        self.runs[-1].append(word)
            elif kind == "optional":
                # A state of its own: an optional region right after another must not share its start.
                self._state(free=True)
                opened.append(len(self.steps) - 1)
                self.runs.append([])
            elif kind == "end":
                self._state(free=True)
                self.free[opened.pop()].append(len(self.steps) - 1)
            else:
                self.runs.append([])
                for k in range(int(high)):
                    at = len(self.steps) - 1
                    self._state()
                    self.anyword[at].append(at + 1)
                    if k >= int(low):
                        self.free[at].append(at + 1)
        if opened:
            raise ValueError(f"an optional region is not closed: {template}")
        self.accept = len(self.steps) - 1
        self.closed = [self._closure(s) for s in range(len(self.steps))]
        if self.accept in self.closed[0] or any(self.anyword[s] for s in self.closed[0]):
            raise ValueError(f"a template must begin with a word of its own: {template}")
        self.needle = max(self.runs, key=lambda r: (min(len(r), NEEDLE_WORDS), sum(map(len, r[:NEEDLE_WORDS]))))

    def _state(self, free: bool = False) -> None:
        if free:
            self.free[-1].append(len(self.steps))
        self.steps.append(None)
        self.free.append([])
        self.anyword.append([])

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def first_words(self) -> set[bytes]:
        """The words a match can begin with."""
        return {self.steps[s][0] for s in self.closed[0] if self.steps[s]}

    def longest(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted stretch that starts at a word; -1 for none."""
        states, end = set(self.closed[0]), -1
        while states and at < len(words):
            word, reached = words[at], set()
            for s in states:
                step = self.steps[s]
                if step and step[0] == word:
                    reached |= self.closed[step[1]]
                for onward in self.anyword[s]:
                    reached |= self.closed[onward]
            at += 1
            if self.accept in reached:
                end = at
            states = reached
        return end


def word_bytes() -> np.ndarray:
    """True for the bytes of words, once A-Z are lower-cased: digits, a-z, and all of UTF-8 beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


def compiled(templates: dict[str, str], phrases: dict[str, str]):
    """The function from a text to its number of words and the accepted stretches (label, start, end, is base)."""
    automata = [(label, False, Automaton(t)) for label, t in templates.items()]
    automata += [(label, True, Automaton(p)) for p, label in phrases.items()]
    needles = sorted({GAP.join(map(re.escape, a.needle[:NEEDLE_WORDS])) for _, _, a in automata})
    needle, is_word = re.compile(b"|".join(needles)), word_bytes()
    starting: dict[bytes, list] = {}
    for entry in automata:
        for word in entry[2].first_words():
            starting.setdefault(word, []).append(entry)

    def scan(text: str | None) -> tuple[int, list[dict]]:
        lowered = (text or "").encode().lower()
        inside = is_word[np.frombuffer(lowered, np.uint8)]
        n_words = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
        if not needle.search(lowered):
            return n_words, []
        words, found, done = WORD.findall(lowered), [], {}
        for at, word in enumerate(words):
            for label, base, automaton in starting.get(word, ()):
                if (base or at >= done.get(label, 0)) and (end := automaton.longest(words, at)) > 0:
                    found.append({"label": label, "first_word": at, "end_word": end, "base": base})
                    done[label] = end
        return n_words, found

    return scan


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES,
) -> DataFrame:
    """Scan every whole text for license wordings.

    One row per input row: the id, ``n_words`` and ``matches``, an array of (label, first_word, end_word, base)
    in order of their start. ``base`` tells phrases, of which every place is given, from templates, of
    which the leftmost longest stretches are given that do not overlap one of the same label.

    A null or empty text has no words and no matches. Null ids and repeated rows are kept as they are; an empty
    table gives an empty table; other columns are not read. No row depends on another, so nothing is shuffled.
    """

    def start():
        scan = compiled(templates, phrases)
        return lambda key, text: (key, *scan(text))

    schema = (
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words bigint,"
        " matches array<struct<label: string, first_word: bigint, end_word: bigint, base: boolean>>"
    )
    return map_rows(docs, [id_col, text_col], schema, start)
