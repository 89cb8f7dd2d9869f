"""License scans by template markup: optional and replaceable regions compile into token automata.

A template is wording with markup, from a notice to a whole license. <<optional>> ... <<end>> may be left out, as a whole; <<any:2-6>> stands for two to six
words of any kind. All other words must stand there as they are, one after the other; one that differs, anywhere, rejects. A
template compiles into a list of steps; a set of places in that list is followed over a text's words, from each word that can
begin the template.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bounded_batches
from .textvec import ALNUM, U64, Words, pieces, released

#: Phrases that are always looked for, and their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

_AS_IS = "this software is provided by <<any:1-8>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any:1-8>> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<optional>> 1 <<end>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<optional>> 2 <<end>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"

#: Whole licenses and notices: fixed wording with replaceable names, and their labels.
WHOLE = [
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>> including the next paragraph <<end>> shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<any:1-8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-2-clause-text", f"{_BSD} {_AS_IS}"),
    ("bsd-3-clause-text", f"{_BSD} <<optional>> 3 <<end>> neither the name of <<any:1-8>> nor the names of <<any:1-3>> contributors may be used to endorse or promote products derived from this software without specific prior written permission {_AS_IS}"),
    ("isc-text", "permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and <<any:1-6>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<any:1-6>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at <<any:1-1>> www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-notice", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <<any:1-1>> of the license or at your option any later version <<any:1-4>> is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details <<optional>> you should have received a copy of the gnu general public license along with <<any:1-4>> if not see <<any:1-1>> www gnu org licenses <<end>>"),
]
#: The scan's own templates and their labels.
TEMPLATES = [
    *WHOLE,
    ("apache-2.0", "licensed under the apache license version 2 <<optional>> 0 <<end>> <<optional>> the license <<end>>"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing <<optional>> software <<end>> distributed under the license is distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "<<optional>> released <<end>> <<optional>> licensed <<end>> under the <<optional>> <<any:1-2>> clause <<end>> bsd license"),
    ("cc-by-nc", "cc by nc <<optional>> <<any:1-1>> 0 <<end>>"),
    ("cc-by-sa", "cc by sa <<optional>> <<any:1-1>> 0 <<end>>"),
    ("cc-by-nc", "creative commons attribution non commercial <<any:0-3>> license"),
    ("copyright", "copyright <<optional>> c <<end>> <<any:1-8>> all rights reserved"),
    ("gpl-2.0", "gnu general public license <<optional>> gpl <<end>> <<optional>> as published by the free software foundation either <<end>> version 2"),
    ("gpl-3.0", "gnu general public license <<optional>> gpl <<end>> <<optional>> as published by the free software foundation either <<end>> version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<any:1-4>> and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v <<optional>> 2 0 <<end>>"),
    ("public-domain", "released into the public domain <<optional>> by <<any:1-4>> <<end>>"),
]

_MARK = re.compile(r"<<(optional|end|any:(\d+)-(\d+))>>|([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
ANY = 0


class TemplateAutomaton:
    """Steps of one template: at place p, the word steps[p] (ANY: any word) leads to p + 1; skips[p] are reached for nothing."""

    def __init__(self, label: str, template: str):
        self.label, self.steps = label, []
        opened: list[int] = []
        skips: list[tuple[int, int]] = []
        for m in _MARK.finditer(template):
            if m[1] == "optional":
                opened.append(len(self.steps))
            elif m[1] == "end":
                skips.append((opened.pop(), len(self.steps)))
            elif m[1]:
                least, most = int(m[2]), int(m[3])
                begin = len(self.steps)
                self.steps += [ANY] * most
                skips += [(begin + k, begin + most) for k in range(least, most)]
            else:
                self.steps.append(_hash(m[4]))
        if opened:
            raise ValueError(f"<<optional>> without <<end>> in {template!r}")
        self.skips: dict[int, list[int]] = {}
        for a, b in skips:
            self.skips.setdefault(a, []).append(b)
        self.begin, self.accept = self._closed({0}), len(self.steps)
        if self.accept in self.begin:
            raise ValueError(f"nothing is mandatory in {template!r}")

    def _closed(self, places: set[int]) -> frozenset[int]:
        todo, out = list(places), set(places)
        while todo:
            for q in self.skips.get(todo.pop(), ()):
                if q not in out:
                    out.add(q)
                    todo.append(q)
        return frozenset(out)

    @property
    def firsts(self) -> set[int]:
        return {self.steps[p] for p in self.begin if p < self.accept}

    def match(self, words: list[int], at: int) -> int:
        """The end of the longest match from at, or at if there is none."""
        places, end = self.begin, at
        for k in range(at, len(words)):
            word = words[k]
            places = self._closed({p + 1 for p in places if p < self.accept and self.steps[p] in (ANY, word)})
            if self.accept in places:
                end = k + 1
            if not places:
                break
        return end


def _hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Words(data, np.array([0, len(data)]), ALNUM).hashes[0])


class LicenseScanner:
    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]):
        self.base = [TemplateAutomaton(*x) for x in phrases]
        self.own = [TemplateAutomaton(*x) for x in templates]
        #: Templates by the words that can begin them, and whether they are phrases.
        self.by_first: dict[int, list[tuple[bool, TemplateAutomaton]]] = {}
        for group in (self.base, self.own):
            for t in group:
                for first in t.firsts:
                    self.by_first.setdefault(first, []).append((group is self.base, t))
        self.anywhere = ANY in self.by_first
        self.firsts = np.array(sorted(self.by_first.keys() - {ANY}), U64)

    def scan(self, words: list[int], places: list[int]) -> tuple[list[int], set[str], set[str], int]:
        """Starts of phrases, labels of phrases, all labels, and how many words are covered; places: words to try."""
        starts: list[int] = []
        base: set[str] = set()
        own: set[str] = set()
        covered: set[int] = set()
        any_first = self.by_first.get(ANY, [])
        for at in places:
            for is_phrase, t in [*self.by_first.get(words[at], []), *any_first]:
                if (end := t.match(words, at)) > at:
                    (base if is_phrase else own).add(t.label)
                    covered.update(range(at, end))
                    if is_phrase:
                        starts.append(at)
        return starts, base, base | own, len(covered)


def _scan(phrases: list[tuple[str, str]], templates: list[tuple[str, str]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(phrases, templates)
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                words = Words(data, offsets, ALNUM)
                count = np.diff(words.first)
                hashes = words.hashes
                if scanner.anywhere:
                    at = np.arange(len(hashes))
                else:
                    near = np.minimum(np.searchsorted(scanner.firsts, hashes), len(scanner.firsts) - 1)
                    at = np.flatnonzero(scanner.firsts[near] == hashes)
                of = np.searchsorted(words.first, at, side="right") - 1
                found: dict[int, list[int]] = {}
                for place, t in zip(at.tolist(), of.tolist(), strict=True):
                    found.setdefault(t, []).append(place)
                rows = []
                for t in range(hi - lo):
                    starts, base, labels, covered = [], set(), set(), 0
                    if t in found:
                        begin = int(words.first[t])
                        own = hashes[begin : words.first[t + 1]].tolist()
                        starts, base, labels, covered = scanner.scan(own, [p - begin for p in found[t]])
                    rows.append((int(count[t]), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), covered / max(1, int(count[t]))))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licenses(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What each text says of licenses, a row for each row of docs.

    n_base counts the places of phrases, of all labels; first_word and last_word are the first and last of them, null if
    there is none. base_labels are the labels of phrases, labels also those of templates: distinct, sorted, "" for none.
    score is the share of words that phrases and templates cover. Null and empty texts have no words and a score of 0. Ids may
    be null or repeat: each row is answered by itself. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(released(_scan(list(phrases), list(templates))), f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
