"""Licence scan by template markup.

A template is licence wording with SPDX-style markup: a region between
``<<beginOptional>>`` and ``<<endOptional>>`` may be absent, and a replaceable
region ``<<var;name="holder";words="1-12">>`` stands for that many words of any
kind; a guard ``<<not;words="nc nd sa">>`` stands for no word and refuses a text
that goes on with one of these, so the name of a longer licence isn't read as
its prefix. Each template is compiled to an automaton over words; a place in a text
is accepted when all mandatory wording matches exactly, word for word. Words
are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased,
so punctuation, line breaks and comment signs between words don't matter.

Every word of a text is hashed and looked up in the vocabulary of the templates
(numpy, a piece of many documents at a time); automata run only from places
where a template's first mandatory words stand.

Defined results: a null text is an empty one; an empty text has no words, no
labels and score 0; repeated rows and repeated or null ids give one row each;
other columns of the input are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T

#: Base phrases, fixed by the contract: words that stand consecutively, and the label.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
          'MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="holders";words="1-8">> BE LIABLE '
          'FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION '
          'WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE')
_MIT_GRANT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="work";words="1-12">> '
              'to deal in <<var;name="object";words="1-8">> without restriction, including without limitation the rights to use, copy, '
              'modify, merge, publish, distribute, sublicense, and/or sell copies of <<var;name="object";words="1-8">>, and to permit '
              'persons to whom <<var;name="object";words="1-8">> is furnished to do so, subject to the following conditions')
_ISC_GRANT = ('Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or '
              'without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies')
_BSD_GRANT = ('Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
              'following conditions are met')
_BSD_TERMS = (' <<beginOptional>>1. <<endOptional>>Redistributions of source code must retain the above copyright notice, this list of conditions and '
              'the following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the above copyright notice, this '
              'list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ')
_BSD_THIRD = ('<<beginOptional>>3. <<endOptional>>Neither the name of <<var;name="holder";words="1-8">> nor the names of its contributors may be used to '
              'endorse or promote products derived from this software without specific prior written permission. ')
_BSD_AS_IS = ('THIS SOFTWARE IS PROVIDED BY <<var;name="holders";words="1-8">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
              'TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL '
              '<<var;name="holders";words="1-8">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES '
              '(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) '
              'HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) '
              'ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE')
_ARTICLE = '<<beginOptional>>the <<endOptional>><<beginOptional>>an <<endOptional>><<beginOptional>>terms of the <<endOptional>>'
_CC = 'licensed under <<beginOptional>>a <<endOptional>><<beginOptional>>Creative Commons <<endOptional>>CC BY'
_VERSION = '<<beginOptional>> <<var;name="version";words="2-2">><<endOptional>>'

#: Public licence notices and the full texts of five licences, in
#: template markup.
TEMPLATES = (
    ("mit", f'released under {_ARTICLE}MIT License'),
    ("mit", f'licensed under {_ARTICLE}MIT License'),
    ("mit", _MIT_GRANT),
    ("mit-text", f'{_MIT_GRANT}: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>'
                 f'shall be included in all copies or substantial portions of <<var;name="object";words="1-8">>. {_AS_IS}'),
    ("isc", _ISC_GRANT),
    ("isc-text", f'{_ISC_GRANT}. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";words="1-8">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
                 'INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name="holder";words="1-8">> BE LIABLE FOR ANY '
                 'SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN '
                 'ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE'),
    ("bsd", _BSD_GRANT),
    ("bsd-2-text", _BSD_GRANT + _BSD_TERMS + _BSD_AS_IS),
    ("bsd-3-text", _BSD_GRANT + _BSD_TERMS + _BSD_THIRD + _BSD_AS_IS),
    ("bsd", 'released under <<beginOptional>>the <<endOptional>><<beginOptional>>a <<endOptional>><<beginOptional>><<var;name="clauses";words="1-2">> clause <<endOptional>>BSD license'),
    ("bsd", 'licensed under <<beginOptional>>the <<endOptional>><<beginOptional>>a <<endOptional>><<beginOptional>><<var;name="clauses";words="1-2">> clause <<endOptional>>BSD license'),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
                  'arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial '
                  'applications, and to alter it and redistribute it freely, subject to the following restrictions: <<beginOptional>>1. <<endOptional>>The '
                  'origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in '
                  'a product, an acknowledgment in the product documentation would be appreciated but is not required. <<beginOptional>>2. <<endOptional>>'
                  'Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. '
                  '<<beginOptional>>3. <<endOptional>>This notice may not be removed or altered from any source distribution'),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0'),
    ("apache-2.0", 'released under the Apache License <<beginOptional>>version <<endOptional>>2.0'),
    ("gpl-notice", 'licensed under the <<beginOptional>>terms of the <<endOptional>><<beginOptional>>GNU <<endOptional>>General Public '
                   'License<<beginOptional>>, version <<var;name="version";words="1-2">><<endOptional>>'),
    ("gpl-notice", 'you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the '
                   'Free Software Foundation'),
    ("lgpl-notice", 'licensed under the <<beginOptional>>terms of the <<endOptional>>GNU Lesser General Public License'),
    ("mpl-2.0", 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0'),
    ("cc-by-notice", f'{_CC}<<not;words="nc nd sa">>{_VERSION}'),
    ("cc-by-nc", f'{_CC}-NC<<not;words="nd sa">>{_VERSION}'),
    ("cc-by-nc-nd", f'{_CC}-NC-ND{_VERSION}'),
    ("cc-by-nc-sa", f'{_CC}-NC-SA{_VERSION}'),
    ("cc-by-nd", f'{_CC}-ND{_VERSION}'),
    ("cc-by-sa", f'{_CC}-SA{_VERSION}'),
    ("cc-by-notice", 'licensed under a Creative Commons Attribution<<not;words="noncommercial noderivatives sharealike">> '
                     '<<var;name="version";words="2-2">> International License'),
    ("unlicense", 'This is free and unencumbered software released into the public domain'),
    ("reserved-notice", 'Copyright <<var;name="holder";words="1-12">> All rights reserved'),
)

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_templates long, matches string")

_MARK = re.compile(r"<<(beginOptional|endOptional|var|not)((?:;[^>]*)?)>>")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY = -1


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().translate(T.LOWER))


class Automaton:
    """Word automaton of one template: state 0 starts, ``final`` accepts."""

    def __init__(self, label: str, markup: str, vocabulary: dict[bytes, int]):
        self.label = label
        self.step: list[dict[int, set[int]]] = [{}]
        self.empty: list[set[int]] = [set()]
        refused: dict[int, set[int]] = {}
        self.mandatory, self.head, opened, at, plain = 0, [], [], 0, True
        pos = 0
        for m in [*_MARK.finditer(markup), None]:
            for w in words_of(markup[pos : m.start() if m else len(markup)]):
                code = vocabulary.setdefault(w, len(vocabulary) + 1)
                at = self._word(at, code)
                self.mandatory += not opened
                if plain:
                    self.head.append(code)
            if m is None:
                break
            pos, plain = m.end(), False
            if m[1] == "not":
                words = words_of(re.search(r'words="([^"]+)"', m[2])[1])
                refused.setdefault(at, set()).update(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words)
                continue
            if m[1] == "beginOptional":
                opened.append(at)
            elif m[1] == "endOptional":
                self.empty[opened.pop()].add(at)  # the region may be skipped
            else:
                least, most = map(int, re.search(r'words="(\d+)-(\d+)"', m[2]).groups())
                skips = []
                for i in range(most):
                    if i >= least:
                        skips.append(at)
                    at = self._word(at, ANY)
                for s in skips:
                    self.empty[s].add(at)
        if opened or not self.head:
            raise ValueError(f"template {label!r} must close its optional regions and begin with a mandatory word")
        self.final = at
        self.closure = [self._reach(s, frozenset()) for s in range(len(self.step))]
        #: closures where the next word is one that a guard refuses
        self.guarded = {}
        for code in set().union(*refused.values()):
            shut = frozenset(s for s, words in refused.items() if code in words)
            self.guarded[code] = [self._reach(s, shut) for s in range(len(self.step))]

    def _word(self, at: int, code: int) -> int:
        self.step.append({})
        self.empty.append(set())
        self.step[at].setdefault(code, set()).add(len(self.step) - 1)
        return len(self.step) - 1

    def _reach(self, s: int, shut: frozenset[int]) -> frozenset[int]:
        if s in shut:
            return frozenset()
        seen, todo = {s}, [s]
        while todo:
            for x in self.empty[todo.pop()] - seen - shut:
                seen.add(x)
                todo.append(x)
        return frozenset(seen)

    def longest(self, codes: list[int], at: int) -> int:
        """End of the longest accepted run of words from ``at``, or -1."""
        closures = self.guarded.get(codes[at], self.closure) if at < len(codes) else self.closure
        states, end = closures[0], -1
        while True:
            if self.final in states:
                end = at
            if at == len(codes):
                return end
            code, nxt = codes[at], set()
            at += 1
            closures = self.guarded.get(codes[at], self.closure) if at < len(codes) else self.closure
            for s in states:
                for to in (*self.step[s].get(code, ()), *self.step[s].get(ANY, ())):
                    nxt |= closures[to]
            if not nxt:
                return end
            states = nxt


class Scanner:
    """All templates and phrases over one vocabulary."""

    def __init__(self, templates, phrases):
        vocabulary: dict[bytes, int] = {}
        self.phrases = [([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(p)], label) for p, label in phrases]
        self.automata = [Automaton(label, markup, vocabulary) for label, markup in templates]
        codes = np.array([T.word_code(w) for w in vocabulary], np.uint64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], np.array(list(vocabulary.values()))[order]

    def read(self, words: T.Words) -> np.ndarray:
        """Vocabulary number of each word, 0 for others."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.codes, h), len(self.codes) - 1)
        return np.where(self.codes[at] == h, self.ids[at], 0)

    def scan(self, column: pa.Array) -> list[tuple]:
        """Per text: n_words, base places [(word, label)], template places
        [(start, end, automaton)]."""
        data, offsets = T.text_buffer(column)
        words = T.Words(T.lowered(data), offsets, T.LETTERS)
        ids, left = self.read(words), words.left()
        base: dict[int, list] = {}
        for codes, label in self.phrases:
            for at in self._places(ids, left, codes):
                base.setdefault(int(words.doc[at]), []).append((int(at - words.first[words.doc[at]]), label))
        found: dict[int, list] = {}
        for a in self.automata:
            done = -1
            for at in self._places(ids, left, a.head[:2]):
                d = int(words.doc[at])
                if at < done:
                    continue
                first = words.first[d]
                end = a.longest(ids[at : words.first[d + 1]][: len(a.step) + 1].tolist(), 0)
                if end > 0:
                    done = at + end
                    found.setdefault(d, []).append((int(at - first), int(at - first) + end, a))
        return [(int(n), base.get(d, []), found.get(d, [])) for d, n in enumerate(words.counts)]

    @staticmethod
    def _places(ids: np.ndarray, left: np.ndarray, codes: list[int]) -> np.ndarray:
        at = np.flatnonzero(ids == codes[0])
        at = at[left[at] >= len(codes)]
        for j, c in enumerate(codes[1:], 1):
            at = at[ids[at + j] == c]
        return at


def evidence(base: list, found: list) -> float:
    """0 without a mark; a template of m mandatory words weighs m / (m + 1), a
    bare phrase a half."""
    return max([0.5 if base else 0.0, *(a.mandatory / (a.mandatory + 1) for _, _, a in found)])


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its licence marks; ``matches`` lists template
    places as label:first word:end word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for piece in T.pieces(batches):
            cols: list[list] = [[] for _ in range(9)]
            for n, base, found in scanner.scan(piece.column("text")):
                at, labels = [w for w, _ in base], {x for _, x in base}
                row = (n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
                       ",".join(sorted(labels | {a.label for _, _, a in found})), evidence(base, found), len(found),
                       ",".join(f"{a.label}:{s}:{e}" for s, e, a in sorted(found, key=lambda x: (x[0], x[1], x[2].label))))
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
