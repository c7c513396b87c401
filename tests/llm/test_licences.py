"""Licence scans against a plain version without cues, and notices and legal prose that were not trained on."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from newsloom.llm import licences

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."
APACHE = "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND."
LGPL = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation."
GPL = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published."
AGPL = GPL.replace("GNU General", "GNU Affero General")
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy was not distributed, see the site."
ISC = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the notice appears."
BSD = "* Neither the name of the copyright holder nor the names of its\n  contributors may be used to endorse or promote products derived from\n  this software without specific prior written permission."
SA = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
BY = "This work is licensed under a Creative Commons Attribution 4.0 International License."
ZERO = "To the extent possible under law, the author(s) have waived all copyright and related or neighboring rights to this work."
NOTICES = {"mit": MIT, "apache-2.0": APACHE, "lgpl-3.0": LGPL, "gpl-3.0": GPL, "agpl-3.0": AGPL, "mpl-2.0": MPL, "isc": ISC, "bsd": BSD, "cc-by-sa": SA, "cc-by": BY, "cc0": ZERO}
LEGAL = [
    "The licensee shall pay the fee within thirty days, and the license may be withdrawn by the council where conditions are not met.",
    "No person may use the name of the society in any publication without the permission of its board; all such rights are held by the board.",
    "Software companies asked the court for permission to copy the files, free of charge, under the terms of the old contract.",
    "The public library is open to any person; copies of documents are distributed on request, subject to the following conditions.",
    "The work was licensed to a publisher in 1950, and the rights to the film were reserved for the heirs of the author.",
    "The general terms of this contract are subject to the law of the land, and any change has to be agreed to in writing.",
]


def split_words(text):
    return [w for w in re.split(" +", re.sub(r"[^\w.]|_|\.(?![0-9])", " ", text.lower())) if w]


def plain_scan(rows, model, bar):
    """Every unit of every paragraph scored by the model's coefficients and compared with every template."""
    weights, intercept, n = model.coefficientMatrix.toArray(), np.array(model.interceptVector), licences.FEATURES
    index = HashingTF(numFeatures=n, inputCol="a", outputCol="b").indexOf
    pairs = lambda words: [" ".join(p) for p in zip(words, words[1:], strict=False)]
    out = []
    for doc, text in rows:
        found, paragraphs, best = set(), set(), None
        for number, block in enumerate(re.split(r"\n\s*\n", text) if text is not None else []):
            words = split_words(block)
            units = [words[s : s + licences.UNIT] for s in range(0, max(0, len(words) - licences.STEP - 1) + 1, licences.STEP)]
            if "\n" in block:
                units += [w for w in map(split_words, block.split("\n")) if 2 <= len(w) <= licences.UNIT]
            for unit in units:
                x = np.zeros(2 * n)
                x[[index(w) for w in unit]] = 1
                x[[n + index(p) for p in pairs(unit)]] = 1
                z = weights @ x + intercept
                chances = (np.exp(z - z.max()) / np.exp(z - z.max()).sum())[: len(licences.FAMILIES)]
                family = licences.FAMILIES[int(chances.argmax())]
                for f, template in licences.TEMPLATES:
                    own = set(pairs(template.split()))
                    if f == family and chances.max() > bar and len(own & set(pairs(unit))) >= licences.CONFIRM * len(own):
                        found.add(family)
                        paragraphs.add(number)
                        best = max(best or 0.0, float(chances.max()))
        out.append((doc, sorted(found), len(paragraphs), best))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(500)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 80))) for i in range(400)], "doc_id long, text string")
    return licences.train(docs)


def test_scan_against_plain_version(spark, trained):
    rng = np.random.default_rng(5)
    words = ["license", "free", "copyright", "rights", "reserved", "software", "the", "of", "under", "public", "a", "terms", *(f"x{i}" for i in range(20))]
    rows = [(i, "\n\n".join([t, " ".join(rng.choice(words, 40))])) for i, t in enumerate(NOTICES.values())]
    for i in range(60):
        text = list(rng.choice(words, int(rng.integers(1, 120))))
        if i % 2:
            template = licences.TEMPLATES[int(rng.integers(len(licences.TEMPLATES)))][1].split()
            cut = sorted(rng.choice(len(template), int(rng.integers(0, 4)), replace=False).tolist(), reverse=True) if len(template) > 6 else []
            for at in cut:
                del template[at]
            place = int(rng.integers(len(text) + 1))
            text[place:place] = template
        rows.append((100 + i, "".join(w + ("\n" if rng.random() < 0.1 else " ") for w in text)))
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "word " * 3000 + BY)]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licence_score", F.lit("clash")), trained=trained).collect()
    want = plain_scan(rows, *trained)
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and sum(bool(w[1]) for w in want) > 30
    for doc, families, n, score in want:
        r = by_id[doc]
        assert (r["licences"], r["n_licence_paragraphs"]) == (families, n) and (score is None) == (r["licence_score"] is None), (doc, r, families)
        assert score is None or abs(score - r["licence_score"]) < 1e-6


def test_notices_as_they_are_written_and_legal_prose(spark, trained):
    """Notices with marks, wraps and words around them are found; legal prose that the model never saw is not."""
    rows = [(f, t) for f, t in NOTICES.items()] + [(str(i), t) for i, t in enumerate(LEGAL)]
    got = defaultdict(list) | {r["name"]: r["licences"] for r in licences.scan_licences(spark.createDataFrame(rows, "name string, text string"), id_col="name", trained=trained).collect()}
    assert sum(got[f] == [f] for f in NOTICES) >= len(NOTICES) - 1, dict(got)
    assert not any(got[str(i)] for i in range(len(LEGAL)))
