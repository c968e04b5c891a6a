"""Licence scan: sparse TF-IDF cosine of the parts of a text to licence templates, inheritance along directories.

Templates are notices, file headers, titles, SPDX tags and licence texts, several a licence.  A notice may stand anywhere in
a file, wrapped or inside a line, so the whole text, every block between empty lines, every line and windows of the text's
words are compared: windows have a template's number of words, begin at every word (from 128 words on at every 64th of it) and go across line breaks.  Titles and
tags, of under ``EMBEDDED`` words, count only as a line, block or text of their own.  A part's vector has its words' counts times
their inverse document frequencies; words that are in no template weigh as words that no document has.  Parts with none of a
template's heavy words are passed over, since they cannot reach ``LEAST``.  A part that is within ``MARGIN`` as near to another
licence names neither.  Document frequencies of the template words are counted over all documents.

Two things are taken out of a text before it is compared: clauses that deny a licence ("is not released under ..."), to the end of
their sentence, and SPDX tags, which are read as expressions (identifiers with AND, OR, WITH) and name the whole expression; a
tag with an identifier that no template has names none.

A file without a notice of its own takes the licence of the nearest directory above it that has a licence file
(``LICENSE`` by name): the directories above each file are joined to the table of licence files, and the longest path wins.
Everything is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LEAST = 0.75  # cosine
MARGIN = 0.002  # of the cosines of a part to two licences
EMBEDDED = 5
FEW = 8  # templates that are all measured
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_GNU = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
          "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
          "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
          "documentation and/or other materials provided with the distribution. ")
_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
          "software without specific prior written permission. ")
_NO_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
                "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: ")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. ")


def _templates() -> dict[str, list[str]]:
    out = {
        "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                       "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
                       "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
                       "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                       "the specific language governing permissions and limitations under the License."],
        "BSD-2-Clause": ["BSD 2-Clause License", _GRANT, _GRANT + _NO_WARRANTY],
        "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "BSD 3-Clause License", _GRANT + _NAMES,
                         _GRANT + _NAMES + _NO_WARRANTY],
        "ISC": ["ISC License", "Released under the ISC License.", _ISC, _ISC + "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
                "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
        "MIT": ["Released under the MIT License.", "MIT License", _MIT[:_MIT.index(", to deal")], _MIT, _MIT + "The above copyright notice and this permission notice shall be included in all "
                "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
        "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0",
                    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
                    "one at https://mozilla.org/MPL/2.0/."],
    }
    for name, (kind, version) in _GNU.items():
        its = f"the GNU {kind} Public License"
        out[name] = [f"This work is licensed under {its}, version {version}.", f"GNU {kind} Public License Version {version}",
                     f"This program is free software: you can redistribute it and/or modify it under the terms of {its} as published by the Free Software Foundation, either "
                     f"version {version} of the License, or (at your option) any later version.",
                     f"This program is free software: you can redistribute it and/or modify it under the terms of {its} as published by the Free Software Foundation, either "
                     f"version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                     f"WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See {its} for more details."]
    for short, long in _CC.items():
        out[f"CC-{short}-4.0"] = [f"This work is licensed under the Creative Commons {long} 4.0 International License.", f"Licensed under CC {short} 4.0.",
                                  f"Creative Commons {long} 4.0 International"]
    for name, texts in out.items():
        texts += [f"SPDX-License-Identifier: {name}"] + [f"SPDX-License-Identifier: {name}-{x}" for x in ("only", "or-later") if name in _GNU]
    return out


#: Texts by licence identifier, as they are customary in files (fixed values); of the long GNU, Apache and Mozilla texts title and header.
TEMPLATES = _templates()
#: ASCII characters that part words, besides white space.
_PARTING = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\r\f\v"


#: An SPDX tag with its expression (group 1), to the end of the line or comment.
_TAG = r"(?i)\bSPDX-License-Identifier:[ \t]*((?:[a-z0-9.+()-]+[ \t]+(?:AND|OR|WITH)[ \t]+)*[a-z0-9.+()-]+)[ \t]*(?:\*/|-->)?[ \t\r]*(?:\n|$)"
#: Any SPDX tag, with the rest of its line.
_TAG_LINE = r"(?i)\bSPDX-License-Identifier:[^\n]*"
#: A clause that denies a licence: up to a full stop that no digit follows, 300 characters at most.
_DENIED = (r"(?i)(?:\bnot|\bnever|\bno longer|n['\u2019]t)\s+(?:\w+\s+)?(?:released|licen[sc]ed|distributed|covered|governed|available|published|offered)\s+(?:under|by)\b"
           r"(?:[^.]|\.(?=\d)){0,300}")


def compared(text: Column) -> Column:
    """The text without SPDX tags and denied licences."""
    low = F.lower(text)
    plain = F.when(low.contains("spdx-license-identifier:"), F.regexp_replace(text, _TAG_LINE, " ")).otherwise(text)
    return F.when(low.contains("licen"), F.regexp_replace(plain, _DENIED, " ")).otherwise(plain)


def cleaned(text: Column, also: str = "") -> Column:
    """The text in lower case with a space for each parting character (and each of ``also``)."""
    return F.translate(F.lower(text), _PARTING + also, " " * len(_PARTING + also))


def words(line: Column) -> Column:
    """Words of a cleaned line, with the empty strings between two spaces."""
    return F.split(line, " ")


def template_words(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in text.lower().translate({ord(c): " " for c in _PARTING + "\n"}).split():
        out[w] = out.get(w, 0) + 1
    return out


def windows(at: Column, ids: Column, rare: Column, size: int, step: int) -> Column:
    """Numbers of the windows of ``size`` words, beginning at every ``step``-th one, that hold a word of ``rare`` at one of the places ``at``."""
    held = F.filter(at, lambda i: F.array_contains(rare, F.get(ids, i)))
    return F.array_distinct(F.flatten(F.transform(held, lambda i: F.sequence(F.greatest(F.floor((i - size + step) / step), F.lit(0)), F.floor(i / step)))))


def frequencies(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, n): documents that have the template word, over all documents; a document counts once."""
    held = F.array_intersect(words(cleaned(F.col("text"), "\n")), F.array(*map(F.lit, vocabulary)))
    return docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``files`` (path, text) with own_licence and own_score: the licence nearest to any part, if the cosine is LEAST
    or more; null and 0.0 otherwise.  A template of twice the words has 0.02 more in the choice, as a licence can hold another's words; ties go to the smaller identifier.  A tag's identifier must stand there whole and counts 1.

    The weights (one number per template word) come to the driver and go into the plan as literals.
    """
    vectors = [(name, template_words(x), x.startswith("SPDX")) for name, texts in sorted(templates.items(), reverse=True) for x in texts]
    vocabulary = sorted({w for _, v, _ in vectors for w in v})
    total = files.count()
    seen = {r["word"]: r["n"] for r in frequencies(files, vocabulary).collect()}  # at most one row per template word
    idf = {w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}
    other = math.log(1 + total) + 1  # of a word that no document has
    lengths = [math.sqrt(sum((n * idf[w]) ** 2 for w, n in v.items())) for _, v, _ in vectors]

    def rarest(k: int, least: float) -> list[str]:
        """A template's rarest words, which make up 1 - least**2 of its squared length: a part without any of them stays below least."""
        (_, v, _), out, share = vectors[k], [], 0.0
        for w in sorted(v, key=lambda w: (seen.get(w, 0), -v[w], w)):
            if share <= 1 - least**2 + 1e-9:
                out.append(w)
                share += (v[w] * idf[w] / lengths[k]) ** 2
        return out

    marks = {w for k in range(len(vectors)) for w in rarest(k, LEAST)}
    own = [set(rarest(k, LEAST - MARGIN)) for k in range(len(vectors))]  # without these a template is not even about as near as another
    fixed = lambda x, kind: F.split(F.lit(" ".join(map(str, x))), " ").cast(f"array<{kind}>")  # noqa: E731  folded to one literal
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  x is evaluated once
    heavy = fixed(sorted(marks), "string")
    known = fixed(vocabulary, "string")
    heavy_ids = fixed([i + 1 for i, w in enumerate(vocabulary) if w in marks], "int")
    weights = fixed([0.0] + [idf[w] for w in vocabulary], "double")

    def ids(part: Column) -> Column:
        """The words' places in the vocabulary from 1 on, 0 for other words."""
        return F.transform(F.filter(words(part), lambda w: w != ""), lambda w: F.array_position(known, w).cast("int"))

    def best(part: Column, which: list[int]) -> Column:
        """struct(class, words, score, place, licence) of the nearest template, null if none is LEAST near or another licence
        is about as near; the place puts the smaller identifier first in a tie."""
        return bound(F.filter(part, lambda x: x > 0), lambda known: bound(F.array_distinct(known), lambda inside: nearest(part, known, inside, which)))

    def nearest(part: Column, known: Column, inside: Column, which: list[int]) -> Column:
        """``best`` with the part's template words and these once each."""
        of = lambda i: F.size(F.filter(known, lambda x: x == i))
        norm = F.sqrt(F.aggregate(inside, F.lit(0.0), lambda a, i: a + F.pow(of(i) * F.get(weights, i), F.lit(2.0))) + (F.size(part) - F.size(known)) * F.lit(other**2))
        width = len(vocabulary) + 1
        flat = fixed([x for k in which for x in [0.0] + [vectors[k][1].get(w, 0) * idf[w] ** 2 / lengths[k] for w in vocabulary]], "double")
        name, n_words = fixed([vectors[k][0] for k in which], "string"), fixed([sum(vectors[k][1].values()) for k in which], "int")
        place = fixed(which, "int")
        # of many templates only those are measured of which the part has one of their own rarest words
        held = [[j for j, k in enumerate(which) if w in own[k]] for w in ["", *vocabulary]]
        starts, counts = fixed([1 + sum(map(len, held[:i])) for i in range(width)], "int"), fixed(map(len, held), "int")
        near_to = fixed([j for x in held for j in x], "int")
        chosen = F.array_distinct(F.flatten(F.transform(inside, lambda i: F.slice(near_to, F.get(starts, i), F.get(counts, i))))) if len(which) > FEW else fixed(range(len(which)), "int")
        dots = F.transform(chosen, lambda k: F.struct(k.alias("k"), F.aggregate(known, F.lit(0.0), lambda a, i: a + F.get(flat, k * width + i)).alias("dot")))
        scored = bound(norm, lambda n: F.filter(F.transform(dots, lambda d: F.struct(d["k"].alias("k"), F.coalesce(F.round(d["dot"] / n, 9), F.lit(0.0)).alias("score"))), lambda d: d["score"] >= LEAST - MARGIN))
        structs = F.transform(scored, lambda d: F.struct(F.round(d["score"] + 0.02 * F.log2(F.get(n_words, d["k"]).cast("double")), 9).alias("class"), F.get(n_words, d["k"]).alias("words"), d["score"].alias("score"),
                                                         F.get(place, d["k"]).alias("place"), F.get(name, d["k"]).alias("licence")))

        def clear(near: Column) -> Column:
            nearest = F.array_max(F.transform(near, lambda s: F.struct(s["score"].alias("score"), s["licence"].alias("licence"))))
            return bound(nearest, lambda top: F.when((top["score"] >= LEAST) & ~F.exists(near, lambda s: (s["licence"] != top["licence"]) & (s["score"] > top["score"] - MARGIN)),
                                                     F.array_max(F.filter(near, lambda s: s["licence"] == top["licence"]))))

        return bound(structs, clear)

    # texts without a heavy word are not looked at again
    plain = F.regexp_replace(F.regexp_replace("__text", r"\r\n?", "\n"), r"\n[ \t]*(?=\n)", "\n")
    flat = cleaned(F.col("__text"), "\n")
    lines = F.filter(F.split(cleaned(F.col("__text")), "\n"), lambda x: F.arrays_overlap(words(x), heavy))
    blocks = F.filter(F.transform(F.split(plain, "\n{2,}"), lambda x: cleaned(x, "\n")), lambda x: F.arrays_overlap(words(x), heavy))
    every = [k for k, (_, _, tag) in enumerate(vectors) if not tag]
    # a tag is read as a whole: its identifier is one word, so that an unknown one is near to none
    tag_of = {x.split(": ")[1].lower(): (k, name) for name, texts in templates.items() for k, x in enumerate(texts) if x.startswith("SPDX")}
    tag_words, names_of = fixed(tag_of, "string"), fixed([name for _, name in tag_of.values()], "string")
    before = lambda x, i: F.lower(F.get(x, i - 1)) == "with"  # noqa: E731  what follows WITH is an exception, which stands as it is

    def expression(x: Column) -> Column:
        """The expression's words with the templates' identifiers; null if one of them is unknown."""
        named = bound(F.split(F.trim(F.regexp_replace(F.regexp_replace(x, r"([()])", " $1 "), r"\s+", " ")), " "), lambda w: F.transform(w, lambda t, i: F.when(F.lower(t).isin("and", "or", "with", "(", ")"), F.upper(t))
                      .when(F.coalesce(before(w, i), F.lit(False)), t).otherwise(F.get(names_of, F.array_position(tag_words, F.lower(t)).cast("int") - 1))))
        return bound(named, lambda w: F.when(~F.exists(w, lambda t: t.isNull()), F.regexp_replace(F.array_join(w, " "), r"(?<=\() | (?=\))", "")))

    tag_names = F.when(F.lower("text").contains("spdx-license-identifier:"), F.filter(F.transform(F.regexp_extract_all("text", F.lit(_TAG), F.lit(1)), expression), lambda x: x.isNotNull()))
    parts = F.array_distinct(F.transform(F.concat(lines, blocks, F.array(flat)), ids))
    found = files.withColumn("__text", compared(F.col("text"))).withColumn("__any", F.arrays_overlap(words(flat), heavy)).withColumn("__parts", F.when(F.col("__any"), parts))
    found = found.withColumn("__ids", F.when(F.col("__any"), ids(flat))).withColumn("__tags", tag_names)
    at = F.filter(F.transform("__ids", lambda x, i: F.when(F.array_contains(heavy_ids, x), i)), lambda i: i.isNotNull())
    found = written(found.withColumn("__at", at).drop("text", "__text", "__any"), "parts")
    tops = [F.transform("__parts", lambda x: best(x, every)),
            F.transform("__tags", lambda x: F.struct(F.lit(1.04).alias("class"), F.lit(4).alias("words"), F.lit(1.0).alias("score"), F.lit(0).alias("place"), x.alias("licence")))]
    sizes: dict[int, list[int]] = {}
    for k, (_, v, tag) in enumerate(vectors):
        if not tag and sum(v.values()) >= EMBEDDED:
            sizes.setdefault(sum(v.values()), []).append(k)
    for size, which in sorted(sizes.items()):
        step = max(1, size // 64)
        # windows with a heavy word that is among the rarest of a template of theirs
        rare = fixed([i + 1 for i, w in enumerate(vocabulary) if any(w in own[k] for k in which)], "int")
        near = windows(F.col("__at"), F.col("__ids"), rare, size, step)
        tops.append(F.transform(near, lambda s: bound(F.slice("__ids", (s * step + 1).cast("int"), size), lambda x: best(x, which))))  # noqa: B023
    # an absent list counts as an empty one: a text may have a tag and no heavy word
    top = F.array_max(F.concat(*[F.coalesce(x, F.array()) for x in tops]))
    some = F.col("__at").isNotNull() | (F.coalesce(F.size("__tags"), F.lit(0)) > 0)
    # the few rows that have something to compare are a small part of the bytes and nearly all of the work: dealt by number
    marked = found.where(some)
    spread = max(files.sparkSession.sparkContext.defaultParallelism, marked.count() // 500)
    named = marked.repartition(spread).withColumn("__top", top).unionByName(found.where(~some).withColumn("__top", F.lit(None)))
    return named.select(*[c for c in files.columns if c != "text"], F.col("__top.licence").alias("own_licence"), F.coalesce("__top.score", F.lit(0.0)).alias("own_score"))


def inherit(files: DataFrame) -> DataFrame:
    """``files`` (path, own_licence, ...) with licence and inherited_from: a file's own, or that of the licence file in
    the nearest directory above (its directory first; of several by path the smallest), else null."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    named = (files.where(F.col("path").rlike(r"(^|/)LICENSE[^/]*$") & F.col("own_licence").isNotNull())
             .groupBy(folder.alias("folder")).agg(F.min(F.struct("path", "own_licence")).alias("x"))
             .select("folder", F.col("x.path").alias("from_path"), F.col("x.own_licence").alias("given")))
    named = written(named, "licence-files")
    # only files without a notice look upward; their folders are made distinct first
    folders = files.where("own_licence IS NULL").select(folder.alias("__at")).distinct()
    steps = F.split(F.col("__at"), "/")
    above = folders.select("__at", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))).alias("folder"))
    given = (above.distinct().join(named, "folder").groupBy("__at").agg(F.max(F.struct(F.length("folder").alias("n"), "folder", "from_path", "given")).alias("x"))
             .select("__at", F.col("x.from_path").alias("__from"), F.col("x.given").alias("__given")))
    joined = files.withColumn("__at", folder).join(given, "__at", "left")
    own = F.col("own_licence").isNotNull()
    return joined.select(*files.columns, F.coalesce("own_licence", "__given").alias("licence"), F.when(~own, F.col("__from")).alias("inherited_from"))


def licences(files: DataFrame) -> DataFrame:
    """path, own_licence, own_score, licence and inherited_from of each row of ``files`` (path, text; others stay as they are
    unless they bear one of these names, and the text is left out; names that begin with two underscores are the operator's).

    A null or empty text has no notice; a null path inherits nothing; repeated rows are scanned alike; an empty table
    gives an empty result.
    """
    made = {"own_licence", "own_score", "licence", "inherited_from"}
    files = files.select(*[c for c in files.columns if c not in made])
    return inherit(written(scan(files), "scanned"))
