"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are what blank lines part, so a notice may be wrapped over lines.  Features
are word n-grams (one to three words).  A softmax regression over licence families, a
class for notices of any other licence and one for anything else is trained on
notices, made from forms and names in four languages and from licence texts, by
dropping, cutting and surrounding them; notices with made-up names teach the unknown
class, and sentences with the same words in other senses the other class.  The
temperature and the threshold on its probability are set on notices of families that
were left out of the fit in turn (they should be unknown) and of templates that were
left out (they should be found).  A prediction is confirmed if the paragraph holds a
large share of the n-grams of one of the family's templates.

Scanning uses DataFrame functions only, in one pass without a shuffle.  Only features
that speak for a licence more than for anything else can make a paragraph a notice, so
a paragraph without any of the words that ``gate_words`` picks, one of each such
feature, is of the other class: one regular expression sorts out most paragraphs and
never a notice.  Paragraphs are scored whole, whatever their length.

Defined results: null and empty texts have no paragraphs and no rows; repeated
rows give repeated results; a null doc_id is kept; very long paragraphs are scanned
whole; paragraphs are numbered from 0 in their document, blank ones left out; columns
of docs other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of licences by family, and paragraphs of their texts and usual notices.
NAMES = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license", "Apache Software License"],
    "mit": ["MIT License", "MIT", "MIT licence", "Expat License", "MIT/X11 license"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License v2.0", "GNU GPL", "GPLv3", "GPLv2", "GPL-3.0-or-later", "GPL-2.0-only", "GPL"],
    "lgpl": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License", "LGPLv2.1", "LGPLv3", "LGPL-2.1-or-later", "LGPL"],
    "agpl": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0", "AGPL"],
    "bsd": ["BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "BSD license", "New BSD License"],
    "isc": ["ISC License", "ISC"],
    "zlib": ["zlib License", "zlib/libpng license"],
    "mpl-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
    "epl": ["Eclipse Public License v2.0", "Eclipse Public License 1.0", "EPL-2.0", "EPL"],
    "boost": ["Boost Software License, Version 1.0", "Boost Software License", "BSL-1.0"],
    "busl": ["Business Source License 1.1", "Business Source License", "BUSL-1.1"],
    "cc-by": ["Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution License", "CC BY 4.0", "CC BY 3.0", "CC-BY-4.0", "Creative Commons Namensnennung 4.0 International"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0", "CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA 3.0"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC 3.0"],
    "cc0": ["CC0 1.0 Universal", "CC0", "Creative Commons Zero", "CC0-1.0", "Unlicense"],
    "proprietary": [],
}
TEXTS = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "zlib": ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "boost": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"],
    "busl": ["The Licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use of the Licensed Work."],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0 Universal.", "This work is dedicated to the public domain.", "Released into the public domain under the Unlicense.", "The person who associated a work with this deed has dedicated the work to the public domain", "This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher; all rights reserved.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados."],
    "unknown": ["Dieses Werk steht unter einer Creative Commons Lizenz.", "This work is under a Creative Commons license.", "See the license file for the terms of use.", "Licensed under the terms of the license below."],
}
#: Forms of a notice, with {} for the name.
FORMS = [
    "Licensed under the {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.", "Distributed under {}.", "Licensed under {}.",
    "This work is licensed under a {}.", "This work is licensed under the {}.", "This project is licensed under the terms of the {}.", "This file is subject to the {}.",
    "SPDX-License-Identifier: {}", "License: {}", "{} license", "See {}_LICENSE", "Available under the terms of the {}", "published under the {}",
    "Dieses Werk steht unter der Lizenz {}.", "Veröffentlicht unter der {}.", "Lizenziert unter {}.", "Cette œuvre est sous licence {}.", "Publié sous {}.", "Este trabajo está bajo la licencia {}.", "Publicado bajo {}.",
]
#: Sentences that use the words otherwise, for the class of anything else.
OTHERS = [
    "You need a driving license to rent a car.", "The licensed electrician came on Monday.", "He has a licence to sell wine and beer.", "The public domain of physics is wide.",
    "She claimed the right to permission and the rights of others.", "The MIT campus is in Cambridge, and version 2.0 of the plan is out.", "The apache helicopter and the commons are open to the public.",
    "Copyright law is taught in the second year.", "The general public has reserved seats; all of them have rights.", "Permission to enter was granted, free of charge.", "A gnu is a large antelope of the savannah.",
    "The software license server is down again.", "We published the creative works of the foundation.", "The rocket gave a boost to the business, and its source is the river.", "Mozilla and the eclipse were in the news.",
    "Sie kommt mit uns, mit ihm und mit allen.", "Der Führerschein ist eine Lizenz zum Fahren.", "Il a une licence de droit et une licence sportive.", "La licencia de conducir y los derechos de todos.", "The terms of the contract are as follows, and the name of the author is known.",
    "This software is free of charge for any person.", "The international version 4.0 is under the table.", "Warranty of any kind is limited to one year.",
]
#: Words that make no feature of their own.
STOP = frozenset("mit only out need large news event others car held a all an and any are as at be been by can do for from has have he her his i if in into is it its may no not of on one or other our she so such than that the their them then there these they this to under us was we were which who will with you your der die das und unter einer eine ein ist steht est sous une la le les de des du et au aux el los las en es bajo un una y o this that work project file software source version use used name new person without see make year but list right names either works plan open must nor s r v ver uvre uvres serv publi ffentlicht cette este dieses alle todos".split())
UNKNOWN, OTHER = "unknown", "other"
#: Words around a notice in training, and syllables of made-up names; none is a feature.
_FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
_SYLLABLES = "ba ko ri zu fe lo ma ni ta vu".split()
_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
NGRAMS = 3


@dataclass
class Classifier:
    classes: list[str]
    features: list[str]
    weights: np.ndarray  # features x classes
    bias: np.ndarray
    temperature: float
    threshold: float
    templates: list[tuple[str, list[str]]]  # family, its features


def ngrams(text: str) -> set[str]:
    """Word n-grams."""
    words = re.findall(_WORD, text.lower())
    return {" ".join(words[i : i + n]) for n in range(1, NGRAMS + 1) for i in range(len(words) - n + 1)}


def _speaks(gram: str) -> bool:
    """Whether an n-gram may be a feature; mit, a German word too, is none alone."""
    words = gram.split()
    return not all(w in STOP or w.isdigit() for w in words) or "mit" in words[1:]


def notices(families: list[str]) -> list[tuple[str, str]]:
    """(text, family) of the notices of families."""
    found = [(t, f) for f in families for t in TEXTS.get(f, [])]
    for f in families:
        for name in NAMES[f]:
            found += [(form.format(name), f) for form in FORMS]
            if len(name.split()) > 2:
                found.append((name, f))
    return found


def _unknown_notices(rng: np.random.Generator, each: int) -> list[tuple[str, str]]:
    tails = ["License", "Public License", "Software License", "License, Version 1.0", "Source License 1.1", "Public License v2.0", "", "", "General License", "Open License 3.0", "Free Public License"]
    made = lambda: "".join(rng.choice(_SYLLABLES, rng.integers(2, 5))).capitalize()
    return [(form.format(f"{made()} {rng.choice(tails)}".strip()), UNKNOWN) for form in FORMS for _ in range(each)] + [(t, UNKNOWN) for t in TEXTS[UNKNOWN]]


def _variants(rng: np.random.Generator, rows: list[tuple[str, str]], each: int) -> list[tuple[set[str], str]]:
    out = []
    for text, k in rows:
        for i in range(each):
            words = text.split()
            kept = [w for w in words if rng.random() >= 0.06] if i % 2 and len(words) > 4 else words
            before, after = (" ".join(rng.choice(_FILLER, rng.integers(0, 8))) for _ in range(2))
            out.append((ngrams(" ".join([before, *(kept or words), after])), k))
    return out


def _regress(x: np.ndarray, y: np.ndarray, n_classes: int, weight: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by proximal gradient with momentum; the l1 term makes the weights sparse."""
    w, b = np.zeros((x.shape[1], n_classes), np.float32), np.zeros(n_classes, np.float32)
    b[-1] = 2.0
    target = np.eye(n_classes, dtype=np.float32)[y]
    look, old = w, w
    for step in range(steps):
        d = (_softmax(x @ look + b) - target) * weight[:, None]
        w = look - 6.0 * (x.T @ d)
        w = np.sign(w) * np.maximum(0, np.abs(w) - 6.0 * 3e-5)
        b[:-1] -= 2.0 * d.sum(0)[:-1]
        look, old = w + step / (step + 3) * (w - old), w
    return w, b


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _matrix(rows: list[set[str]], at: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(rows), len(at)), np.float32)
    for i, grams in enumerate(rows):
        x[i, [at[g] for g in grams if g in at]] = 1
    return x


def _train(rng: np.random.Generator, families: list[str], texts: list[tuple[str, str]], each: int, steps: int) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    classes = [*families, UNKNOWN, OTHER]
    rows = [*texts, *_unknown_notices(rng, 8)]
    features = sorted({g for t, _ in [*texts, *((f.format(""), "") for f in FORMS), *((t, "") for t in TEXTS[UNKNOWN]), *((t, "") for t in OTHERS)] for g in ngrams(t) if _speaks(g)})
    named = {w for names in NAMES.values() for n in names for w in re.findall(_WORD, n.lower())}
    common = [g for g in features if " " not in g and g not in named]
    strewn = [(" ".join(rng.permutation([*rng.choice(_FILLER, 6), *rng.choice(common, rng.integers(1, 4))])), OTHER) for _ in range(200)]
    whole = [r for r in texts if r[0] in TEXTS.get(r[1], ())]
    varied = _variants(rng, rows, each) + _variants(rng, whole, 5 * each) + _variants(rng, [(t, OTHER) for t in OTHERS], 12 * each) + _variants(rng, strewn, each) + [(set(), OTHER)] * (20 * each)
    y = np.array([classes.index(k) for _, k in varied])
    x = _matrix([g for g, _ in varied], {g: i for i, g in enumerate(features)})
    share = 1 / np.maximum(1, np.bincount(y, minlength=len(classes)))[y]
    w, b = _regress(x, y, len(classes), (share / share.sum()).astype(np.float32), steps)
    return classes, features, w, b


def fit(each: int = 2, steps: int = 250, seed: int = 5, families: list[str] | None = None) -> Classifier:
    """A classifier trained on ``each`` variants of every notice, for all or some of the families."""
    rng = np.random.default_rng(seed)
    families = list(NAMES) if families is None else families
    texts = notices(families)
    # held-out families, which should be unknown, and held-out notices, which should be found
    scores: list[tuple[np.ndarray, str]] = []
    for fold in range(3):
        kept = [f for i, f in enumerate(families) if i % 3 != fold or len(families) < 6]
        held = [(t, f if f in kept else UNKNOWN) for i, (t, f) in enumerate(texts) if f not in kept or i % 5 == fold]
        used = [(t, f) for i, (t, f) in enumerate(texts) if f in kept and i % 5 != fold]
        classes, features, w, b = _train(rng, kept, used, 1, steps // 2)
        z = _matrix([ngrams(t) for t, _ in held], {g: i for i, g in enumerate(features)}) @ w + b
        scores += [(row, classes.index(f)) for row, (_, f) in zip(z, held)]
    losses = {t: np.mean([-np.log(_softmax(z[None] / t)[0, k] + 1e-6) for z, k in scores]) for t in (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)}
    temperature = min(losses, key=losses.get)
    sure = []  # (probability of the best family, whether it is right)
    for z, k in scores:
        p = _softmax(z[None] / temperature)[0][:-2]
        sure.append((float(p.max()), int(p.argmax()) == k))
    threshold = max((round(t, 2) for t in np.arange(0.3, 0.95, 0.05)), key=lambda t: sum(good if p >= t else not good for p, good in sure))
    classes, features, w, b = _train(rng, families, texts, each, steps)
    used = np.abs(w).sum(1) > 0
    features = [g for g, u in zip(features, used) if u]
    held_by = [(f, [g for g in features if g in grams]) for t, f in texts for grams in [ngrams(t)]]
    return Classifier(classes, features, np.round(w[used].astype(float), 4), np.round(b.astype(float), 4), temperature, threshold, [(f, g) for f, g in held_by if g])


def gate_words(model: Classifier) -> list[str]:
    """Words of which every paragraph that isn't of the other class has one.

    With a bias that favours the other class, some feature of such a paragraph weighs more for another class.
    Of each such feature the word that most of them have is taken, words in STOP last.
    """
    over = model.weights[:, :-1].max(1) > model.weights[:, -1]
    left = [set(g.split()) for g, o in zip(model.features, over) if o]
    words: list[str] = []
    while left:
        counts: dict[str, int] = {}
        for grams in left:
            for w in grams:
                counts[w] = counts.get(w, 0) + 1
        single = [next(iter(g)) for g in left if len(g) == 1]  # no choice
        word = single[0] if single else max(counts, key=lambda w: (w not in STOP and not w.isdigit(), counts[w], w))
        words.append(word)
        left = [g for g in left if word not in g]
    return sorted(words)


def scan(docs: DataFrame, model: Classifier | None = None, similarity: float = 0.5) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity and confirmed for each paragraph that is a licence notice.

    ``family`` is ``unknown`` for notices of no known family: the unknown class is the likeliest, or the
    family's probability is under the model's threshold.
    """
    model = model or fit()
    assert model.bias[-1] >= model.bias[:-1].max()  # the gate relies on it
    families = model.classes[:-2]
    by_letter: dict[str, list[str]] = {}  # so that a word is tried against those of its first letter only
    for w in gate_words(model):
        by_letter.setdefault(w[0], []).append(re.escape(w[1:]))
    gate = r"(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(ends)})" for c, ends in by_letter.items()) + r")(?![a-z0-9])"
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    features, weights = constant(model.features, "array<string>"), constant(model.weights.tolist(), "array<array<double>>")
    of_template = {g: [] for g in model.features}
    for t, (_, grams) in enumerate(model.templates):
        for g in grams:
            of_template[g].append(t)
    holders = constant([of_template[g] for g in model.features], "array<array<int>>")
    sizes = constant([len(g) for _, g in model.templates], "array<int>")
    family_of = constant([families.index(f) for f, _ in model.templates], "array<int>")

    gated = docs.select("doc_id", F.lower("text").alias("text")).where(F.col("text").rlike(gate))
    bodies = F.filter(F.split("text", r"\r?\n[ \t]*(?:\r?\n[ \t]*)+"), lambda x: F.trim(x, F.lit(" \t\r\n")) != "")
    numbered = F.filter(F.transform(bodies, lambda x, i: F.struct(i.alias("paragraph"), x.alias("body"))), lambda x: x["body"].rlike(gate))
    # words are made within the generator, so that they are columns of their own and each text is cut once
    cut = F.transform(numbered, lambda x: F.struct(x["paragraph"].alias("paragraph"), F.regexp_extract_all(x["body"], F.lit(f"({_WORD})"), F.lit(1)).alias("words")))
    words = gated.select("doc_id", F.inline(cut))

    def of_length(n: int):
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *(F.get("words", i + j) for j in range(n))))

    grams = F.array_intersect(F.concat(*map(of_length, range(1, NGRAMS + 1))), features)
    at = words.select("doc_id", "paragraph", F.transform(grams, lambda g: (F.array_position(features, g) - 1).cast("int")).alias("at"))
    bias = constant(model.bias.tolist(), "array<double>")
    logits = F.aggregate("at", bias, lambda z, i: F.zip_with(z, weights[i], lambda a, b: a + b))
    scored = at.select("doc_id", "paragraph", "at", F.transform(logits, lambda z: F.exp(z / model.temperature)).alias("e"))
    best = scored.withColumn("k", (F.array_position("e", F.array_max("e")) - 1).cast("int")).where(F.col("k") <= len(families))
    probability = F.col("e")[F.col("k")] / F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    # the largest share of a template of the family that the paragraph holds
    held = F.flatten(F.transform("at", lambda i: holders[i]))
    of_family = F.filter(held, lambda t: family_of[t] == F.col("k"))
    share = F.transform(F.array_distinct("held"), lambda t: F.size(F.filter("held", lambda u: u == t)) / sizes[t])
    best = best.select("doc_id", "paragraph", "k", F.round(probability, 6).alias("probability"), of_family.alias("held"))
    best = best.withColumn("similarity", F.round(F.coalesce(F.array_max(share), F.lit(0.0)), 6))
    sure = (F.col("k") < len(families)) & (F.col("probability") >= model.threshold)
    family = F.when(sure, F.array(*map(F.lit, model.classes))[F.col("k")]).otherwise(UNKNOWN)
    return best.select("doc_id", "paragraph", family.alias("family"), "probability", "similarity", (sure & (F.col("similarity") >= similarity)).alias("confirmed"))
