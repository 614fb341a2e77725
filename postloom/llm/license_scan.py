"""Licence scans: a trained classifier of paragraphs, confirmed by comparison with templates.

A paragraph ends at a blank line or at a line that ends a sentence; other lines go on, so that a wrapped notice
is one paragraph. Paragraphs with a word that speaks for a family (without one no family can be likelier than unknown) are made
distinct, so that a notice found in a million documents is scored once. Their word n-grams meet the weights of a
multinomial logistic regression, a small table, and the sums give a family or, below the calibrated threshold,
unknown. Licences that aren't among the families are taught as unknown, in the same phrases as the families.

A family is confirmed against templates, names and openings, both ways: a template fits by the part of its words that the paragraph
holds, where names of licences that the paragraph has and the template lacks count like missing words, so that no
superset fits. The best template of the family has to reach CONFIRM and to be better than those of all other families.

The regression is trained on the driver from templates and phrases written by rule, without any corpus text; every
fourth of them is kept from training and sets the threshold. Scanning is DataFrame operations only. Weights and
templates are broadcast: their size is fixed.

Defined cases: a null or empty text has no paragraph and no licence. Rows that share a doc_id get the union of
what they hold; null doc_ids are told apart by their text. Other columns aren't read. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, bound

#: Part of a template's words that a confirmed paragraph holds.
CONFIRM = 0.6
UNKNOWN = "unknown"

#: Between paragraphs: the end of a line that ends a sentence, or a blank line.
BREAK = r"[.!?:;][ \t\r]*\n|\n[ \t\r]*\n"

#: Names that notices use, and openings of the notices that licences prescribe.
NAMES = {
    "agpl": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL-3.0 license", "AGPL-3.0-or-later", "AGPL-3.0", "AGPLv3", "GNU AGPL v3"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "Apache-2.0", "Apache license"],
    "boost": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0 license", "BSL-1.0", "Boost license"],
    "bsd": ["BSD License", "3-Clause BSD License", "BSD-2-Clause license", "BSD-3-Clause", "New BSD License", "Simplified BSD License"],
    "cc-by": ["CC BY 4.0 license", "Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 3.0 License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 4.0 license", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nc-nd": ["CC BY-NC-ND 4.0", "CC BY-NC-ND 4.0 license", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "cc-by-nc-sa": ["CC BY-NC-SA 4.0", "CC BY-NC-SA 4.0 license", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "cc-by-nd": ["CC BY-ND 4.0", "CC BY-ND 4.0 license", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 4.0 license", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"],
    "cc0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication", "CC0-1.0", "Creative Commons Zero v1.0 Universal", "CC0 license"],
    "epl": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v1.0", "EPL-2.0 license", "EPL-2.0"],
    "eupl": ["European Union Public Licence, version 1.2", "European Union Public Licence 1.2", "EUPL-1.2 licence", "EUPL-1.2", "EUPL v1.2"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPL-3.0 license", "GNU GPL license", "GPL-3.0-or-later", "GPL-3.0", "GPL-2.0-only", "GPLv3", "GPLv2", "GNU GPL v3", "GNU GPL v2"],
    "isc": ["ISC License", "ISC"],
    "lgpl": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v3.0", "LGPL-3.0 license", "LGPL-2.1-only", "LGPL-3.0", "GNU LGPL v3", "LGPLv3"],
    "mit": ["MIT License", "MIT license", "Expat MIT License", "MIT terms", "MIT"],
    "mpl": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0 license", "MPL-2.0"],
    "proprietary": ["proprietary license", "commercial proprietary license"],
}
#: Licences that are no family of these.
OTHER_LICENCES = [
    "Artistic License 2.0", "Open Software License 3.0", "Academic Free License v3.0", "Microsoft Public License", "Zope Public License 2.1", "SIL Open Font License 1.1", "zlib License", "Common Development and Distribution License 1.0",
    "PHP License 3.01", "Python Software Foundation License", "Open Database License v1.0", "Universal Permissive License 1.0", "Server Side Public License, version 1", "Business Source License 1.1", "Elastic License 2.0",
    "Apple Public Source License 2.0", "Ruby License", "W3C Software Notice and License", "Open Government Licence v3.0", "Design Science License", "LaTeX Project Public License 1.3c", "Q Public License 1.0", "IBM Public License 1.0",
]
TEMPLATES = {
    "apache": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU Affero General Public License along with this program."],
    "boost": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"],
    "cc0": ["To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
    "eupl": ["Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU General Public License along with this program."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "mit": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction', "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "proprietary": ["All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the copyright owner.", "All rights reserved. Unauthorized copying of this file is strictly prohibited."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work; it is in the public domain.", "This work is in the public domain."],
}
VERBS = ["Released under the", "Licensed under the", "Licensed under", "This work is licensed under the", "This work is licensed under a", "Distributed under the terms of the", "Published under", "Available under the", "Made available under the", "Released under", "Distributed under", "This file is under the", "Use of this software is governed by the", "Code is", "We use the", "The source is under"]
#: What has an anchor and names no licence.
OTHERS = [
    "the driver lost his license after the accident", "she renewed her driver's license at the counter", "a poetic license with the facts", "a license plate on the back of the car",
    "the licensed plumber came on monday", "fishing license fees rise in spring", "the restaurant got its liquor license back", "licensing talks between both companies failed",
    "copyright law protects authors", "copyright 2019 by the author", "copyright holders met in geneva", "the copyright office moved", "with the kind permission of the museum",
    "they asked for permission to leave", "without permission nobody may enter the hall", "permission denied while opening the file", "wealth was redistributed after the war", "redistribution of income is debated",
    "public domain books in the library", "the licence of the broadcaster expires", "a licensed therapist or a general practitioner", "the general public has no license to enter", "the software needs a license key",
    "version 2.0 of the license agreement is under review", "the apache helicopter pilot holds a license", "students at mit need permission to use the lab", "the terms of the license were disputed",
    "all rights reserved by the committee for the annual meeting", "all rights reserved to the members of the club", "tables are reserved for the meeting of the committee", "the rights of the tenants were reserved by law", "all seats reserved for guests of the author",
    "the eclipse was public on monday", "the european union has a public office", "a boost for the software market", "creative people with attribution of their work", "the free software foundation met in boston", "she works at mit", "he studied at mit and at stanford",
    "the affero office", "commons and lords debated the license", "universal public health care", "the zero hour of the commons",
]
#: Words that say the same.
SAME = {"licensed": "license", "licence": "license", "licenced": "license", "licenses": "license", "licences": "license", "licensing": "license"}
STOPS = set("a an and any as at be by for from in is it its of on or that the their this to was were with you your can may not no are if all".split())


def tokens(text: str) -> list[str]:
    return [SAME.get(w, w) for w in re.findall(r"[a-z0-9]+", text.lower())]


def grams(words: list[str]) -> set[str]:
    """Words that say something, and pairs of words of which at least one does."""
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:]) if not (a in STOPS and b in STOPS)}
    return {w for w in words if w not in STOPS} | pairs


def families() -> list[str]:
    return sorted({*NAMES, *TEMPLATES})


def notices() -> list[tuple[str, str]]:
    """(paragraph, family) to learn from."""
    found = [(t, f) for f, ts in TEMPLATES.items() for t in ts]
    # openings are often cut: their halves say as much
    for f, ts in TEMPLATES.items():
        for words in (t.split() for t in ts if len(t.split()) >= 16):
            found += [(" ".join(words[: len(words) // 2]), f), (" ".join(words[len(words) // 2 :]), f)]
    found += [(f"{c} {year} {who}. All rights reserved.", "proprietary") for c in ("Copyright (c)", "Copyright", "(c)") for year, who in (("2019", "Example Corp"), ("2021", "the owner Inc"), ("2024", "Some Company Ltd"))]
    for f, names in NAMES.items():
        found += [(f"{verb} {name}", f) for verb, name in product(VERBS, names)]
        found += [(f"SPDX-License-Identifier: {n}", f) for n in names] + [(f"Code is {n} licensed", f) for n in names]
    found += [(f"{verb} {name}", UNKNOWN) for verb, name in product(VERBS, OTHER_LICENCES)] + [(f"SPDX-License-Identifier: {n}", UNKNOWN) for n in OTHER_LICENCES]
    return found + [(t, UNKNOWN) for t in OTHERS] + [(v + " rules of the house", UNKNOWN) for v in VERBS]


def templates() -> list[tuple[str, tuple[str, ...]]]:
    """(family, its words) to confirm by: names and the openings that licences prescribe, without words that say nothing."""
    return sorted({(f, tuple(sorted(set(tokens(t)) - STOPS))) for f, ts in [*NAMES.items(), *TEMPLATES.items()] for t in ts})


def naming_words() -> list[str]:
    """Words that tell licences apart: those of names, but for numbers and words that most names share."""
    plain = {"license", "public", "software", "version", "terms", "work", "international", "new", "only", "later", "or", "clause", "general", "union", "domain", "dedication", "commercial", "universal", "simplified", "zero"}
    words = {w for ns in NAMES.values() for n in ns for w in tokens(n)}
    return sorted(w for w in words - plain - STOPS if not re.fullmatch(r"v?[0-9]+[a-z]?", w))


@lru_cache(maxsize=1)
def trained() -> tuple[tuple[str, ...], tuple[tuple[str, tuple[float, ...]], ...], tuple[float, ...], float]:
    """Classes (the last is unknown), weights of each n-gram, intercepts, and the least probability of a family."""
    classes = [*families(), UNKNOWN]
    every = sorted({(tuple(sorted(grams(tokens(t)))), classes.index(f)) for t, f in notices()})
    prescribed = {tuple(sorted(grams(tokens(t)))) for ts in TEMPLATES.values() for t in ts}
    # openings that licences prescribe are always learned; of what rules write every fourth row calibrates
    kept = [r for i, r in enumerate(every) if i % 4 == 1 and r[0] not in prescribed]
    rows = [r for r in every if r not in set(kept)]
    vocabulary = sorted(set().union(*(g for g, _ in rows)))
    number = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, (g, _) in enumerate(rows):
        x[i, [number[t] for t in g]] = 1
    y = np.eye(len(classes))[[c for _, c in rows]]
    balance = 1 / np.maximum(y.sum(0), 1)
    share = (y @ balance)[:, None]
    share /= share.sum()
    w, b = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    b[-1] = 2.0  # without evidence a paragraph is unknown

    def probabilities() -> np.ndarray:
        z = x @ w + b
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    pace_w, pace_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(200):
        d = (probabilities() - y) * share
        pace_w = 0.9 * pace_w - 3.0 * (x.T @ d + 1e-4 * w)
        pace_b[:-1] = 0.9 * pace_b[:-1] - 3.0 * d.sum(0)[:-1]
        w += pace_w
        b += pace_b
    w, b = w.round(6), b.round(6)
    z = np.array([b + sum((w[number[t]] for t in g if t in number), np.zeros(len(classes))) for g, _ in kept])
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    truth = np.array([c for _, c in kept])
    ordinary = truth == len(classes) - 1
    wrong = p[ordinary, :-1].max()  # the surest that a kept ordinary paragraph comes to a family
    right = np.sort(p[~ordinary, truth[~ordinary]])  # of kept notices, all but a hundredth are surer than the second
    least = round(float(max(0.5, (wrong + right[len(right) // 100]) / 2)), 6)
    return tuple(classes), tuple((g, tuple(map(float, w[i]))) for g, i in number.items()), tuple(map(float, b)), least


@lru_cache(maxsize=1)
def vocabulary_words() -> tuple[str, ...]:
    """Words of which a notice has at least one: every n-gram that speaks for some family against unknown holds one of them.

    Without any of them all n-grams of a paragraph speak for unknown, which the intercepts also do, so that no family can be the likelier.
    """
    classes, weights, intercepts, _ = trained()
    assert max(intercepts[:-1]) < intercepts[-1]
    speaking = [g for g, w in weights if max(w[:-1]) > w[-1]]
    words = {g for g in speaking if " " not in g}
    for a, b in (g.split(" ") for g in speaking if " " in g):
        if a not in words and b not in words:
            words.add(b if a in STOPS else a)
    return tuple(sorted(words))


def paragraphs_of(text: Column) -> Column:
    return F.split(text, BREAK)


def split_words(paragraph: Column) -> Column:
    return F.array_remove(F.split(F.lower(paragraph), "[^a-z0-9]+"), "")


def words_of_paragraph(paragraph: Column) -> Column:
    same = F.create_map(*[F.lit(x) for pair in SAME.items() for x in pair])
    return F.transform(split_words(paragraph), lambda w: F.coalesce(F.try_element_at(same, w), w))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, paragraph, family, probability, similarity, confirmed) of every distinct paragraph with a word of the vocabulary; family is null where it goes to unknown."""
    spark = docs.sparkSession
    classes, weights, intercepts, least = trained()
    text = F.col(text_col).cast("string")
    rid = F.coalesce(F.col(id_col).cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
    known = list(vocabulary_words())
    known += [w for w, same in SAME.items() if same in known]
    raw, words = split_words(F.col("paragraph")), words_of_paragraph(F.col("paragraph"))
    # written once, as both the scores and their way back to the documents read it
    lines = docs.select(rid.alias("rid"), F.explode(F.array_distinct(paragraphs_of(text))).alias("paragraph")).where(F.exists(raw, lambda w: w.isin(known)))
    lines = Scratch(spark, "licences").table(lines, "paragraphs")
    stops = sorted(STOPS)

    def grams_of(ws: Column) -> Column:
        single = F.filter(ws, lambda w: ~w.isin(stops))
        pairs = F.zip_with(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), F.slice(ws, 2, F.size(ws)), lambda a, b: F.when(~(a.isin(stops) & b.isin(stops)), F.concat(a, F.lit(" "), b)))
        return F.array_distinct(F.concat(single, F.filter(pairs, lambda x: x.isNotNull())))

    distinct = lines.select("paragraph").distinct()
    gram = F.explode(bound(words, grams_of))  # the words of a paragraph are split off once
    schema = "gram string, " + ", ".join(f"w{k} double" for k in range(len(classes)))
    table = F.broadcast(spark.createDataFrame([(g, *w) for g, w in weights], schema))
    sums = distinct.select("paragraph", gram.alias("gram")).join(table, "gram").groupBy("paragraph").agg(*[(F.sum(f"w{k}") + F.lit(b)).alias(f"z{k}") for k, b in enumerate(intercepts)])
    top = F.greatest(*[F.col(f"z{k}") for k in range(len(classes))])
    likeliest = F.greatest(*[F.col(f"z{k}") for k in range(len(classes) - 1)])
    total = sum((F.exp(F.col(f"z{k}") - top) for k in range(len(classes))), F.lit(0.0))
    family = F.coalesce(*[F.when(F.col(f"z{k}") == likeliest, F.lit(c)) for k, c in enumerate(classes[:-1])])
    scored = sums.select("paragraph", family.alias("family"), (F.exp(likeliest - top) / total).alias("probability")).where(F.col("probability") >= least)
    # few paragraphs are left: each against all templates, whose number is fixed
    sets = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*map(F.lit, ws)).alias("words")) for f, ws in templates()])
    names = F.array(*map(F.lit, naming_words()))

    def fits(ws: Column) -> Column:
        named = F.array_intersect(names, ws)
        return F.transform(sets, lambda t: F.struct(t["family"].alias("family"), (F.size(F.array_intersect(t["words"], ws)) / (F.size(t["words"]) + F.size(F.array_except(named, t["words"])))).alias("fit")))

    scored = scored.withColumn("_fits", bound(words, fits))
    best = lambda own: F.coalesce(F.array_max(F.transform(F.filter("_fits", lambda t: (t["family"] == F.col("family")) if own else (t["family"] != F.col("family"))), lambda t: t["fit"])), F.lit(0.0))
    scored = scored.withColumns({"similarity": best(True), "_next": best(False)})
    scored = scored.withColumn("confirmed", (F.col("similarity") >= CONFIRM) & (F.col("similarity") > F.col("_next"))).drop("_fits", "_next")
    return lines.join(scored, "paragraph", "left")


def scan_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, paragraph, family, probability, similarity, confirmed) of every distinct notice of a document."""
    return judged(docs, id_col, text_col).where("family is not null")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_notices, families (of confirmed notices, joined by |), n_unconfirmed, and n_unknown (paragraphs with words of the vocabulary that go to unknown)."""
    text = F.col(text_col).cast("string")
    rid = F.coalesce(F.col(id_col).cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
    found = judged(docs, id_col, text_col).groupBy("rid").agg(
        F.count("family").alias("n_notices"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), "|").alias("families"),
        F.count_if(~F.col("confirmed")).alias("n_unconfirmed"), F.count_if(F.col("family").isNull()).alias("n_unknown"),
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), rid.alias("rid")).join(found, "rid", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", number("n_notices"), F.coalesce("families", F.lit("")).alias("families"), number("n_unconfirmed"), number("n_unknown"))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    classes, weights, intercepts, least = trained()
    text = lambda s: "'" + s.replace("'", "''") + "'"
    names = ", ".join(f"w{k}" for k in range(len(classes)))
    rows = ",\n".join(f"({text(g)}, {', '.join(map(repr, w))})" for g, w in weights)
    known_words = ", ".join(map(text, vocabulary_words()))
    same = " ".join(f"when {text(a)} then {text(b)}" for a, b in SAME.items())
    words = lambda x: f"list_transform(list_filter(string_split_regex(lower({x}), '[^a-z0-9]+'), lambda x: x <> ''), lambda x: case x {same} else x end)"
    stops = ", ".join(text(s) for s in sorted(STOPS))
    sums = ", ".join(f"sum(w{k}) + {b!r} as z{k}" for k, b in enumerate(intercepts))
    known = "greatest(" + ", ".join(f"z{k}" for k in range(len(classes) - 1)) + ")"
    last = f"z{len(classes) - 1}"
    total = " + ".join(f"exp(z{k} - greatest(k, {last}))" for k in range(len(classes)))
    family = "case " + " ".join(f"when z{k} = k then {text(c)}" for k, c in enumerate(classes[:-1])) + " end"
    own = ",\n".join(f"({text(f)}, [{', '.join(map(text, ws))}])" for f, ws in templates())
    names_of = ", ".join(map(text, naming_words()))
    return f"""
with weights(gram, {names}) as (values {rows}),
templates(family, words) as (values {own}),
l as (
  select distinct doc_id, unnest(string_split_regex(text, {text(BREAK)})) as paragraph from documents),
p as (select doc_id, paragraph from l where list_has_any({words("paragraph")}, [{known_words}])),
d as (select distinct paragraph from p),
w as (select paragraph, {words("paragraph")} as words from d),
g as (
  select paragraph, unnest(list_filter(words, lambda x: x not in ({stops}))) as gram from w union
  select paragraph, unnest(list_filter(list_transform(range(1, len(words)), lambda i: case when words[i] in ({stops}) and words[i + 1] in ({stops}) then null
    else words[i] || ' ' || words[i + 1] end), lambda x: x is not null)) from w),
z as (select paragraph, {sums} from g join weights using (gram) group by paragraph),
k as (select *, {known} as k from z),
f as (select paragraph, {family} as family, exp(k - greatest(k, {last})) / ({total}) as probability from k),
m as (
  select f.paragraph, f.family, t.family as other, max(len(list_intersect(t.words, w.words)) / (len(t.words) + len(list_filter(list_distinct(w.words), lambda x: list_contains([{names_of}], x) and not list_contains(t.words, x))))) as fit
  from f join w using (paragraph), templates t where probability >= {least} group by all),
c as (select paragraph, family, max(case when other = family then fit end) >= {CONFIRM} and max(case when other = family then fit end) > max(case when other <> family then fit end) as confirmed from m group by all),
n as (
  select doc_id, count(family) as n_notices, string_agg(distinct case when confirmed then family end, '|' order by case when confirmed then family end) as families,
    count(*) filter (not confirmed) as n_unconfirmed, count(*) filter (family is null) as n_unknown
  from p left join c using (paragraph) group by doc_id)
select doc_id, coalesce(n_notices, 0)::bigint as n_notices, coalesce(families, '') as families, coalesce(n_unconfirmed, 0)::bigint as n_unconfirmed, coalesce(n_unknown, 0)::bigint as n_unknown
from documents left join n using (doc_id)"""
