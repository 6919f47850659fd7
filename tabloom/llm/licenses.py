"""Licence scans with a positional index of rare licence words."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import add_struct, utf8, words_of


@dataclass(frozen=True)
class Template:
    """A licence phrase. ``base``: every place of it counts. ``key``: words that must stand verbatim
    inside it; ``least``: share of its words that must stand at their places."""

    label: str
    text: str
    base: bool = False
    key: str = ""
    least: float = 1.0


#: Inverse document frequencies of a place that stand for a half of certainty.
HALF_SURE = 6.0
# The base phrases, then names and public notices of further licences.
TEMPLATES = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("epl", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0 universal"),
    Template("gpl-3", "licensed under the gnu general public license version 3", key="version 3", least=0.8),
    Template("gpl-2", "licensed under the gnu general public license version 2", key="version 2", least=0.8),
    Template("apache-2.0", "licensed under the apache license version 2 0", key="version 2 0", least=0.8),
    # public notices as their licences give them, words only
    Template("mit-terms", "permission is hereby granted free of charge to any person obtaining a copy of this software", key="permission is hereby granted", least=0.8),
    Template("mit-notice", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the
        software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the software the software is provided as is without warranty of any kind""", key="permission is hereby granted", least=0.8),
    Template("isc-notice", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright
        notice and this permission notice appear in all copies""", key="with or without fee is hereby granted", least=0.8),
    Template("bsd-terms", "redistribution and use in source and binary forms with or without modification are permitted", key="source and binary forms", least=0.8),
    Template("bsd-notice", """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1
        redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the
        above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution""",
             key="redistributions in binary form must reproduce", least=0.8),
    Template("apache-notice", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the
        license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as
        is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license""",
             key="you may not use this file except in compliance with the license", least=0.8),
    Template("gpl-notice", """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software
        foundation either version""", key="under the terms of the gnu general public license", least=0.8),
    Template("mpl-notice", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain
        one at""", key="mozilla public license v 2 0", least=0.8),
    Template("zlib-notice", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of
        this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely""",
             key="alter it and redistribute it freely", least=0.8),
    Template("unlicense", "this is free and unencumbered software released into the public domain", key="free and unencumbered", least=0.8),
]
RESULT = ("struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:array<string>,labels:array<string>,"
          "score:double,places:array<struct<label:string,start:int,matched:double>>>")


def word_weights(docs: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of every template word over all documents. Each task counts its own texts first;
    what comes to the driver is one count per template word."""
    vocabulary = frozenset(w for t in templates for w in words_of(t.text.encode()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        rows = 0
        for batch in batches:
            for raw in batch.column(0):
                seen.update(vocabulary.intersection(words_of(raw.as_py())))
                rows += 1
        yield pa.RecordBatch.from_pydict({"w": [b"", *seen], "n": [rows, *seen.values()]},
                                         pa.schema([("w", pa.binary()), ("n", pa.int64())]))

    counted = docs.select(utf8(text)).mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    found = {bytes(r["w"]): r["n"] for r in counted.collect()}
    rows = found.pop(b"", 0)
    return {w: math.log((1 + rows) / (1 + found.get(w, 0))) for w in sorted(vocabulary)}


class RareWordIndex:
    """Postings of licence words: for each word its inverse document frequency, and the templates and offsets it stands at."""

    def __init__(self, templates: list[Template], weights: dict[bytes, float]):
        self.templates = [(t, words_of(t.text.encode()), words_of(t.key.encode())) for t in templates]
        self.vocabulary = frozenset(weights)
        # rank 0 is the rarest word; equal ones by their bytes
        self.rank = {w: i for i, w in enumerate(sorted(weights, key=lambda w: (-weights[w], w)))}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.order, self.allowed, self.evidence = [], [], []
        for k, (t, words, _) in enumerate(self.templates):
            for i, w in enumerate(words):
                self.postings.setdefault(w, []).append((k, i))
            self.order.append(sorted(self.rank[w] for w in words))
            self.allowed.append(len(words) - math.ceil(t.least * len(words)))
            self.evidence.append(sum(weights[w] for w in words))

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its words in place) of every accepted alignment.

        The text's licence words are looked up from the highest inverse document frequency on; each gives the starts of its templates by
        relative position. An alignment misses ``allowed`` places of a template at most, so once one more of the template's places has been looked
        up, or is known to be missing, it has all its starts and is closed; a template with more places missing is out.
        """
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.vocabulary:
                places.setdefault(w, []).append(i)
        starts: set[tuple[int, int]] = set()
        for w in sorted(places, key=self.rank.__getitem__):
            for k, offset in self.postings[w]:
                # places of rarer words of the template count as looked up, whether the text has them or not
                if bisect_left(self.order[k], self.rank[w]) <= self.allowed[k]:
                    starts.update((k, i - offset) for i in places[w])
        out = []
        held = {w: set(at) for w, at in places.items()}
        for k, start in starts:
            template, own, key = self.templates[k]
            if start < 0 or start + len(own) > len(words):
                continue
            matched = sum(start + j in held.get(w, ()) for j, w in enumerate(own)) / len(own)
            if matched < template.least or (key and not self._verbatim(own, key, start, words)):
                continue
            out.append((k, start, matched))
        return sorted(out)

    def certainty(self, found: list[tuple[int, int, float]]) -> float:
        """From 0 to 1: what the templates in place say together. One says the more, the rarer and the more numerous its words are and the more of
        them stand in place; a template counts once."""
        best: dict[int, float] = {}
        for k, _, matched in found:
            best[k] = max(best.get(k, 0.0), matched)
        return 1.0 - math.prod(1.0 - m * (1.0 - 0.5 ** (self.evidence[k] / HALF_SURE)) for k, m in best.items())

    @staticmethod
    def _verbatim(own: list[bytes], key: list[bytes], start: int, words: list[bytes]) -> bool:
        at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
        return words[start + at : start + at + len(key)] == key


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text",
                  weights: dict[bytes, float] | None = None) -> DataFrame:
    """Add licence places and labels of every whole text.

    A text's licence words of highest inverse document frequency (over all of ``docs``) look up the templates' postings; starts are intersected by
    relative position with the places of the other words; key phrases are verified word by word.
    Adds ``n_words``, ``n_base`` (places of base phrases), ``first_word``, ``last_word`` (smallest and largest start of
    these, null without any), ``base_labels``, ``labels`` (sorted arrays), ``score`` (certainty that the text names a licence: see ``RareWordIndex.certainty``; 0 without a place)
    and ``places``. Input columns of these names are replaced. A null text counts as an empty one: no words, score 0.
    Texts of any length are read whole; repeated rows get equal results; an empty table gives an empty one.
    """
    weights = word_weights(docs, templates, text) if weights is None else weights

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = RareWordIndex(templates, weights)
        kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                          ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
                          ("places", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("matched", pa.float64())])))])
        for batch in batches:
            out = []
            for raw in batch:
                words = words_of(raw.as_py())
                found = index.scan(words)
                base = [(templates[k].label, s) for k, s, _ in found if templates[k].base]
                out.append({
                    "n_words": len(words), "n_base": len(base),
                    "first_word": min((s for _, s in base), default=None), "last_word": max((s for _, s in base), default=None),
                    "base_labels": sorted({x for x, _ in base}), "labels": sorted({templates[k].label for k, _, _ in found}),
                    "score": index.certainty(found),
                    "places": [{"label": templates[k].label, "start": s, "matched": m} for k, s, m in found],
                })
            yield pa.array(out, kind)

    fields = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
    return add_struct(docs, F.arrow_udf(scan, RESULT)(utf8(text)), fields)
