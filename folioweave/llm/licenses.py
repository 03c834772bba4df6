"""Licence scans: a trained paragraph classifier in DataFrame functions only.

A sparse logistic regression over word uni- and bigrams (one weight per n-gram and family) is
trained on the driver from the templates below and from variants of them; it learns from no table.
Its last class, ``unknown``, is learned from ordinary prose and from legal-sounding prose that
grants nothing; a temperature fitted on held-out variants calibrates the probabilities, and a
paragraph whose best family stays under CONFIDENCE is unknown too.

Scanning: texts are cut into paragraphs at line ends. The vocabulary has no n-gram of
common words alone; a paragraph without one of its n-grams has no weight and is unknown. The weights
of the others' n-grams are looked up in literal maps; their sums give probabilities. Each sentence of a template is a template too. A prediction is confirmed when
the paragraph holds enough n-grams of a template of that family, or lies in one whole; one that no
template confirms counts as unknown.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "unknown"
CONFIDENCE = 0.5
#: Least share of a template's n-grams that the paragraph holds; or, for a fragment with at least
#: FRAGMENT n-grams of the template, least share of its own n-grams. A shorter fragment counts if all
#: its n-grams are the template's.
CONFIRM = 0.5
FRAGMENT = 12
#: Weights are looked up in this many maps, so that each lookup compares few n-grams.
WEIGHT_MAPS = 64
#: Notices by which licences are named or granted, by family.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Distributed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "public-domain": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "Use of this product is subject to an end user license agreement.",
    ),
}
#: Prose that uses the same vocabulary and grants nothing.
OTHERS = (
    "He lost his driving license last year and had to walk to work.", "The public was asked for permission to build on the land.", "A general version of the work was published in the spring.",
    "The city council will issue a fishing license to any person who asks.", "The Apache helicopter was first flown in the desert.", "She studied at MIT before she joined the company.",
    "Please read the documentation before you use the software.", "The terms of the agreement were not published.", "Their rights were restricted under the old law.", "The copyright office moved to a new building.",
    "Creative people often share their work with the commons.", "The library is open to the public in the morning.", "Mozilla held a conference about the web.", "The foundation gave free software to schools.",
    "Sie kommt mit dem Zug und geht mit ihm in die Stadt.", "El derecho de la ciudad no es de los que la visitan.", "Les droits de la ville ne sont pas pour tout le monde.",
    "A warranty of two years covers this machine.", "The source of the river is high in the mountains.", "The distribution of the rain was uneven.", "Version three of the plan is with the authors.",
)
#: Words of licences that ordinary prose is given in training.
TRIGGERS = (
    "license", "licensed", "licenses", "licence", "licenced", "licences", "sublicense", "spdx", "copyright", "permission", "redistribution", "redistribute", "gnu", "gpl", "lgpl", "mpl", "cc0",
    "warranties", "proprietary", "confidential", "unencumbered", "reserved", "waived", "unauthorized",
)
#: Common words; n-grams of these alone have no weight.
COMMON = tuple("the of and to in a is it that this was for on be as with by an are at or not all no if have has had can any which you your one may see into first about last who old new were their his she".split())
_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"(?<=[.;])\s+(?=[A-Z])")


def templates() -> list[tuple[str, str]]:
    """(family, text) of all templates, and of the sentences of those that hold more than one."""
    out = []
    for family, ts in TEMPLATES.items():
        for t in ts:
            out += [(family, x) for x in dict.fromkeys([t, *_SENTENCE.split(t)])]
    return out


def ngrams_of(text: str) -> set[str]:
    words = _WORD.findall(text.lower())
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


class Model:
    """weights: n-gram -> list by class; bias by class; classes end with unknown."""

    def __init__(self, seed: int = 11, rounds: int = 300, penalty: float = 3e-4):
        rng = random.Random(seed)
        self.classes = [*TEMPLATES, UNKNOWN]
        rows: list[tuple[set[str], int]] = []
        prose = Counter(w for t in OTHERS for w in _WORD.findall(t.lower()))
        filler = [w for w in prose if w not in TRIGGERS]
        for family, t in templates():
            for i in range(14):
                rows.append((ngrams_of(self._variant(t, rng, filler, i)), self.classes.index(family)))
        for t in OTHERS:
            for i in range(16):
                rows.append((ngrams_of(self._variant(t, rng, filler, i)), len(TEMPLATES)))
        legal = sorted({w for ts in TEMPLATES.values() for t in ts for w in _WORD.findall(t.lower())})
        for i in range(900):  # prose with a word or two of the templates by chance
            words = rng.choices(filler, k=rng.randint(1, 40)) + [TRIGGERS[i % len(TRIGGERS)]] * (i % 3 > 0) + rng.sample(legal, rng.randint(0, 2))
            rng.shuffle(words)
            rows.append((ngrams_of(" ".join(words)), len(TEMPLATES)))
        rng.shuffle(rows)
        held = rows[::5]
        learn = [r for i, r in enumerate(rows) if i % 5]
        # vocabulary: n-grams of templates and of the other prose's triggers
        count = Counter(g for gs, k in learn if k < len(TEMPLATES) for g in gs)
        self.vocabulary = sorted(g for g, n in count.items() if n >= 4 and not set(g.split()) <= set(COMMON))
        at = {g: i for i, g in enumerate(self.vocabulary)}

        def matrix(some):
            x = np.zeros((len(some), len(at) + 1))
            x[:, -1] = 1
            for i, (gs, _) in enumerate(some):
                for g in gs:
                    if g in at:
                        x[i, at[g]] = 1
            return x, np.array([k for _, k in some])

        x, y = matrix(learn)
        w = np.zeros((x.shape[1], len(self.classes)))
        onehot = np.eye(len(self.classes))[y]
        velocity = np.zeros_like(w)
        share = 1 / np.maximum(onehot.sum(0), 1)
        weight = (onehot @ share)[:, None]
        weight /= weight.mean()
        for _ in range(rounds):
            p = self._softmax(x @ w)
            grad = x.T @ ((p - onehot) * weight) / len(x) + penalty * w
            velocity = 0.9 * velocity - 0.8 * grad
            w += velocity
        xh, yh = matrix(held)
        best = None
        for t in np.geomspace(0.3, 4, 30):  # temperature: calibration on variants that were not learned from
            p = self._softmax(xh @ w / t)
            loss = -np.log(np.clip(p[np.arange(len(yh)), yh], 1e-9, 1)).mean()
            if best is None or loss < best[0]:
                best = loss, t
        w = w / best[1]
        self.held_out_accuracy = float((self._softmax(xh @ w).argmax(1) == yh).mean())
        self.weights, self.bias = w[:-1], w[-1]
        if int(self.bias.argmax()) != len(TEMPLATES):
            raise ValueError("a text without known n-grams must be unknown")
        self.triggers = sorted({w for g in self.vocabulary for w in g.split()} - set(COMMON))

    @staticmethod
    def _softmax(z):
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    @staticmethod
    def _variant(text: str, rng: random.Random, filler: list[str], i: int) -> str:
        if not i:
            return text
        words = text.split()
        if len(words) > 12 and i % 2:
            a = rng.randrange(len(words) - 10)
            words = words[a : a + rng.randint(10, len(words))]
        out = []
        for w in words:
            r = rng.random()
            if r < 0.04:
                continue
            out.append(rng.choice(filler) if r < 0.07 else w)
        if i % 3 == 2:
            extra = rng.choices(filler, k=rng.randint(2, 8))
            out = extra + out if rng.random() < 0.5 else out + extra
        return " ".join(out)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _once(value: Column, then) -> Column:
    """then(value), with the value worked out once and not at each place where ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _grams(words: Column) -> Column:
    def both(w):
        rest = F.greatest(F.size(w) - 1, F.lit(0))
        return F.concat(w, F.zip_with(F.slice(w, F.lit(1), rest), F.slice(w, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b)))

    return F.array_distinct(_once(words, both))


def _known_grams(words: Column, vocabulary: list[str]) -> Column:
    """The distinct n-grams of a paragraph that have a weight; a pair is written only where both its words occur in such pairs."""
    single = [g for g in vocabulary if " " not in g]
    pairs = [g for g in vocabulary if " " in g]
    first, second = (sorted({g.split(" ")[k] for g in pairs}) for k in (0, 1))

    def both(w):
        rest = F.greatest(F.size(w) - 1, F.lit(0))
        pair = F.zip_with(F.slice(w, F.lit(1), rest), F.slice(w, F.lit(2), rest), lambda a, b: F.when(a.isin(first) & b.isin(second), F.concat(a, F.lit(" "), b)))
        return F.concat(F.filter(w, lambda x: x.isin(single)), F.filter(pair, lambda x: x.isin(pairs)))

    return F.array_distinct(_once(words, both))


def _weight(model: Model):
    """A function from an n-gram with a weight to its weights by class: literal maps, one for each of some numbers dealt by hash."""
    maps: list[dict] = [{} for _ in range(WEIGHT_MAPS)]
    for g, w in zip(model.vocabulary, model.weights):
        maps[zlib.crc32(g.encode()) % WEIGHT_MAPS][g] = [float(x) for x in w]
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,array<double>>>")
    return lambda gram: F.try_element_at(F.get(table, (F.crc32(gram.cast("binary")) % WEIGHT_MAPS).cast("int")), gram)


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (its number), content of whole texts."""
    plain = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "content"))


def scanned(docs: DataFrame, model: Model | None = None, confidence: float = CONFIDENCE, confirm: float = CONFIRM) -> DataFrame:
    """doc_id, paragraph, content, family, probability, similarity: one row for each
    paragraph of a document in which a licence is found and confirmed.

    Null texts and rows without doc_id hold none; rows that share a doc_id are scored apart, so a
    repeated row gets its results twice; an empty table gives an empty result; of equal families the
    first in order counts; other columns are not looked at. Unknown paragraphs are left out. A
    paragraph's row is worked out by itself: nothing is shuffled.
    """
    model = model or Model()
    weight = _weight(model)
    bias = F.array(*[F.lit(float(b)) for b in model.bias])
    families = F.array(*map(F.lit, TEMPLATES))
    own = F.from_json(F.lit(json.dumps([[sorted(ngrams_of(t)) for f, t in templates() if f == family] for family in TEMPLATES])), "array<array<array<string>>>")

    def similarity(grams, best):  # to the closest template of the predicted family
        def one(template):
            common = F.size(F.array_intersect(grams, template))
            return F.greatest(F.when((common >= FRAGMENT) | (common == F.size(grams)), common / F.size(grams)).otherwise(F.lit(0.0)), common / F.size(template))

        return F.array_max(F.transform(F.get(own, best), one))

    def verdict(words, z):
        top = F.array_max(F.slice(z, 1, len(TEMPLATES)))
        best = F.array_position(z, top).cast("int") - 1
        share = F.exp(top - F.array_max(z)) / _once(F.array_max(z), lambda m: F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
        found = _once(best, lambda b: F.struct(F.get(families, b).alias("family"), F.round(share, 6).alias("probability"), F.round(_once(_grams(words), lambda g: similarity(g, b)), 6).alias("similarity")))
        return F.when(share >= confidence, found)

    def judged(words):
        z = lambda known: F.aggregate(known, bias, lambda z, g: F.zip_with(z, weight(g), lambda a, b: a + b))
        return _once(_known_grams(words, model.vocabulary), lambda known: F.when(F.size(known) > 0, _once(z(known), lambda z: verdict(words, z))))

    # as rows of a generator, a paragraph's verdict is worked out once; a filter would be moved below it and repeat it
    verdicts = F.filter(F.transform(F.array(_words(F.col("content"))), judged), lambda v: v["similarity"] >= confirm)
    return paragraphs(docs).select("doc_id", "paragraph", "content", F.inline(verdicts))
