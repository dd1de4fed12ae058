"""The licence scan on notices that its table does not hold, and against a plain version of its steps."""

from __future__ import annotations

import math
import random
import re
import textwrap
from collections import Counter

import pytest

from roomledger.llm import licences
from roomledger.llm.licence_examples import DECIDING, TEMPLATES

GPL = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software "
    "Foundation, either version {2} of the License, or (at your option) any later version. {0} is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY."
)
MIT = (
    "Copyright (c) 2021 A. Miller. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice. 3. Neither the name of the copyright holder nor the "
    "names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
)
# Notices in other words than the table's, as they stand in files.
NOTICES = {
    "gpl-3.0": [GPL.format("Foo", "GNU General Public License", "3"), "Foo: this work is licensed under the GNU General Public License, version 3 only."],
    "gpl-2.0": [GPL.format("This driver", "GNU General Public License", "2"), "It is licensed under the GNU General Public License, version 2."],
    "lgpl-3.0": [GPL.format("This library", "GNU Lesser General Public License", "3")],
    "lgpl-2.1": [GPL.format("This library", "GNU Lesser General Public License", "2.1")],
    "agpl-3.0": [GPL.format("The server", "GNU Affero General Public License", "3")],
    "mit": [MIT, "All code here is released under the MIT License."],
    "bsd-3-clause": [BSD],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy was not distributed, get one."],
    "mpl-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may obtain a copy."],
    "apache-2.0": ["The code is Licensed under the Apache License, Version 2.0 and nothing else."],
    "cc-by-nc-4.0": ["Texts: Licensed under CC BY-NC 4.0. Pictures are not."],
    "cc-by-nc-nd-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "The book, that is, this work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa-4.0": ["Maps are Licensed under CC BY-NC-SA 4.0."],
    "cc-by-sa-4.0": ["Articles are Licensed under CC BY-SA 4.0."],
    "cc-by-4.0": ["Data are Licensed under CC BY 4.0."],
}
TALK = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "Licensed under a licence that the owner keeps.", "He renewed his driving license in spring.", "Version 3 of the general plan is public.",
    "This program is free of charge.", "Foo may be copied under the GNU General Public License, version 3.", "The Apache people of the south.", "Licensed under version 3.",
]
WORDS = "on the river bank an old miller kept his grain while rain fell over seven quiet fields of barley and rye".split()


def prose(seed: int, n: int = 40) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def wrapped(text: str, width: int = 72, mark: str = "") -> str:
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def rows() -> list[tuple]:
    out, number = [], 0
    for family, notices in NOTICES.items():
        for notice in notices:
            for text in (notice, wrapped(notice), wrapped(notice, 60, " * "), f"{prose(number)}\n\n{wrapped(notice)}\n \n{prose(number + 1)}"):
                out.append((number, text, family))
                number += 1
    for text in [*TALK, *map(wrapped, TALK), *(prose(n, 400) for n in range(20))]:
        out.append((number, text, None))
        number += 1
    both = f"Code is Released under the MIT License. Texts are Licensed under CC BY 4.0.\n\n{wrapped(NOTICES['gpl-2.0'][0])}"
    out += [(number, both, "cc-by-4.0,gpl-2.0,mit"), (None, NOTICES["mit"][1], "mit"), (None, NOTICES["mit"][1], "mit"), (number + 1, None, None)]
    out += [(number + 2, "", None), (number + 3, prose(5, 60_000) + "\n\n" + MIT, "mit"), (number + 4, " \n\n \n", None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, "x", 1, 0.5) for i, t, _ in rows()]
    return spark.createDataFrame(data, "doc_id long, text string, family string, paragraph int, probability double").repartition(3)


def test_held_out_notices(docs):
    got = licences.scan_documents(docs).collect()
    want = Counter((i, family or "") for i, _, family in rows())
    assert Counter((r.doc_id, r.families) for r in got) == want
    assert all(r.licence in (r.families.split(",") if r.families else ("unknown", "none")) for r in got)
    assert licences.scan_documents(docs.where("false")).count() == 0


def plain(text: str, model) -> dict:
    """What the scan says of one paragraph: families, or unknown, or nothing."""
    tokens = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    pairs = {f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)}
    known = {*tokens, *pairs} & set(model.weights)
    if not known:
        return {}
    scores = [c + sum(model.weights[g][i] for g in known) for i, c in enumerate(model.weights[""])]
    powers = [math.exp(s - max(scores)) for s in scores]
    p = [x / sum(powers) for x in powers]
    found = {}
    for family, templates in TEMPLATES.items():
        grams = [{f"{a} {b}" for a, b in zip(w, w[1:], strict=False)} for w in ([x for x in re.split(r"\W+", t.lower()) if x] for t in templates)]
        alike = max(len(g & pairs) / len(g) for g in grams)
        if alike >= licences.CONTAINED and all(set(part) & pairs for part in DECIDING[family]):
            found[family] = round(alike, 9)
    families = p[: len(licences.FAMILIES)]
    if found and max(families) >= model.threshold:
        return found
    return {"unknown": 0} if p[-1] < 0.5 else {}


def test_scan_equals_a_plain_version(docs):
    model = licences.train(docs)
    again = licences.train(docs.repartition(7))
    assert again.threshold == model.threshold and again.weights.keys() == model.weights.keys()  # the sample has an order
    keyed = {(r.key1, r.key2): r.text for r in licences.id_text(docs).select(*licences.keys(), "text").collect()}
    got = {}
    for r in licences.scan(docs, model).collect():
        text = keyed[r.key1, r.key2]
        got.setdefault((text, r.paragraph), {})[r.family if r.confirmed else "unknown"] = round(r.similarity, 9) if r.confirmed else 0
    want = {}
    for text in set(keyed.values()):
        for n, paragraph in enumerate(re.split(r"\n[ \t\r]*\n\s*", text)):
            if found := plain(paragraph, model):
                want[text, n] = found
    assert got == want and len(want) > 60
