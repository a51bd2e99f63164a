import random
import re

import pyarrow as pa

from tallyloom.llm import license_scan as L

DOCS = "doc_id bigint, text string"


def bigrams(text):
    text = re.sub(r"[!-/:-@\[-`{-~]", "", re.sub("[0-9]", "0", text or "")).translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return list(zip(words, words[1:]))


def plain(texts, templates, score):
    """The best stretch of any length of every text and template."""
    out = {}
    for t, text in enumerate(texts):
        grams = bigrams(text)
        for name, template in templates:
            own = set(bigrams(template))
            for i in range(len(grams)):
                for j in range(i + 1, len(grams) + 1):
                    dice = 2 * len({*grams[i:j]} & own) / (len(own) + j - i)
                    if dice >= score - 1e-9 and dice > out.get((t, name), 0) + 1e-12:
                        out[t, name] = dice
    return out


def test_against_all_stretches():
    rng = random.Random(6)
    words = "the a of licensed under mit license to terms b c d e f".split()
    templates = [(f"T{k % 3}", " ".join(rng.choices(words, k=n))) for k, n in enumerate([2, 3, 4, 6, 9, 15])]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(60)]
    for text in [t for _, t in templates] * 3:
        cut = text.split()
        cut.insert(rng.randrange(len(cut)), "new")
        texts.append("x y " + " ".join(cut) + " z")
    for score in (0.6, 0.8, 1.0):
        got = {(t, n): d for t, n, d, _, _ in L.best_stretches(pa.array(texts), L.prepare(templates), score)}
        want = plain(texts, templates, score)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def found(spark, rows):
    return {(r.doc_id, r.license_id): (r.first_word, r.n_words) for r in L.scan(spark.createDataFrame(rows, DOCS)).collect()}


def test_notices_and_odd_rows(spark):
    mit = L.WHOLE["MIT"][0]
    rows = [
        (1, "Some words.\nReleased under the MIT License."),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "Licensed under CC BY-NC 4.0."),
        (4, "Licensed under the Apache License, Version 2.0. And then more."),
        (5, "All rights reserved"),
        (6, mit.replace("hereby ", "").replace("\"", "") + " tail"),
        (7, None),
        (8, ""),
        (9, "license"),
        (10, "the terms of the license are under the work to the extent of the rights " * 3000),
        (11, "x " * 100_000 + "All rights reserved."),
        (None, "Released under the MIT License."),
    ]
    got = found(spark, rows)
    want = {(1, "MIT"): (2, 5), (2, "GPL"): (0, 12), (3, "CC-BY-NC"): (0, 5), (4, "Apache"): (0, 7), (5, "All-rights-reserved"): (0, 3), (11, "All-rights-reserved"): (100_000, 3), (None, "MIT"): (0, 5)}
    assert {k: got.get(k) for k in want} == want and (6, "MIT") in got
    assert not {7, 8, 9, 10} & {d for d, _ in got}
    clash = spark.createDataFrame([(1, "All rights reserved.", 3), (1, "All rights reserved.", 3)], DOCS + ", dice int")
    assert L.scan(clash).count() == 2 and L.scan(spark.createDataFrame([], DOCS)).count() == 0
    assert L.scan(clash, []).count() == 0


def test_licence_inside_and_apart_from_a_siblings_notice(spark):
    lgpl, gpl = "Distributed under the terms of the GNU Lesser General Public License, version 3.", "follow the GNU General Public License, version 3."
    rows = [(1, f"{lgpl} Some words stand here. The test programs alone {gpl}"), (2, lgpl), (3, f"{lgpl} {lgpl}"), (4, f"The test programs alone {gpl} {lgpl}")]
    got = found(spark, rows)
    assert got.keys() == {(1, "LGPL"), (1, "GPL"), (2, "LGPL"), (3, "LGPL"), (4, "LGPL"), (4, "GPL")}
    assert got[1, "LGPL"] == (0, 13) and got[1, "GPL"][0] > 13 and got[4, "GPL"][0] + got[4, "GPL"][1] <= got[4, "LGPL"][0]


def test_settled_against_all_stretches():
    rng = random.Random(8)
    words = "the gnu public license under terms of version b c d e f g h".split()
    apart = 0
    for _ in range(60):
        base = rng.sample(words, 12)
        templates = [("T0", " ".join(base)), ("T1", " ".join([*base[:6], "lesser", *base[6:]])), ("T2", " ".join([*base[:3], "affero", *base[5:]]))]
        text = " ".join(w for _ in range(4) for w in (*rng.choice(templates)[1].split()[rng.randrange(4) :], *rng.choices(words, k=rng.randrange(3))))
        grams, ready, every = bigrams(text), L.prepare(templates), []
        for name, own in zip(ready.names, ready.bigrams, strict=True):
            own = {g for _, t in templates for g in bigrams(t) if L._bigrams(pa.array([" ".join(g)]))[1][0] in own}
            for i in range(len(grams)):
                for j in range(i + 1, len(grams) + 1):
                    dice = 2 * len({*grams[i:j]} & own) / (len(own) + j - i)
                    if dice >= 0.8 - 1e-9:
                        every.append((-round(dice, 9), -len(own), name, i, j - i))
        taken, want = [], {}
        for dice, _, name, i, n in sorted(every):
            if all(i + n < a or a + m < i for a, m in taken):
                taken.append((i, n))
                want.setdefault(name, (-dice, i, n + 1))
        got = {name: (round(d, 9), a, n) for _, name, d, a, n in L.scan_texts(pa.array([text]), ready)}
        assert got == want
        apart += any(name in want and (round(d, 9), a, n) != want[name] for _, name, d, a, n in L.best_stretches(pa.array([text]), ready, 0.8))
    assert apart > 5


def test_query_against_lines(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    got = {(r.doc_id, r.license_id) for r in L.op4_license_scan(spark, path).collect()}
    told = {"General Public License, version": "GPL", "under CC BY-NC": "CC-BY-NC", "under the MIT License": "MIT", "under the Apache License": "Apache", "All rights reserved": "All-rights-reserved"}
    want = {(r.doc_id, name) for r in spark.read.parquet(f"{path}/documents.parquet").collect() for line, name in told.items() if line in r.text}
    assert want and want == got


def test_whole_licences_spdx_lines_and_versions(spark):
    rows = [(i, f"Copyright (c) 2020 Some One\n\n{t}\n\nmore words") for i, t in enumerate(t for texts in L.WHOLE.values() for t in texts)]
    got = {(r.doc_id, r.license_id): r for r in L.scan(spark.createDataFrame(rows, DOCS)).collect()}
    for i, name in enumerate(name for name, texts in L.WHOLE.items() for _ in texts):
        assert got[i, name].dice > 0.9  # repeated bigrams count once in the template and each time in the stretch
    rows = [
        (1, "x = 1  # SPDX-License-Identifier: Apache-2.0"), (2, "// SPDX-License-Identifier: GPL-2.0-only"), (3, "Licensed under the GNU General Public License, version 2. Then 7 more"),
        (4, "Licensed under the GNU General Public License, version 3, it says"), (5, "Released under the MIT License"), (6, "the SPDX-License-Identifier is missing"),
    ]
    got = [(r.doc_id, r.license_id, r.version) for r in L.scan(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()]
    assert got == [(1, "Apache", "2.0"), (2, "GPL", "2.0"), (3, "GPL", "2"), (4, "GPL", "3"), (5, "MIT", None)]


def test_query_against_dice_of_all_stretches(spark, sf_dir):
    """Every tenth document and its licences by trying all stretches of all templates, the longest ones as far as size bounds let them score."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    got = {}
    for r in L.op4_license_scan(spark, sf_dir).collect():
        got.setdefault(r.doc_id, {})[r.license_id] = r.dice
    templates = {}
    for name, t in L.default_templates():
        templates.setdefault((name, frozenset(bigrams(t))), t)
    tried = 0
    for doc, text in rows:
        if doc % 4 and doc not in got:
            continue
        grams, best = bigrams(text), {}
        for name, own in templates:
            at = [i for i, g in enumerate(grams) if g in own]
            for k, i in enumerate(at):
                common = set()
                for j in at[k:]:
                    if j - i + 1 > 1.5 * len(own) + 1e-9:
                        break
                    common.add(grams[j])
                    best[name] = max(best.get(name, 0), 2 * len(common) / (len(own) + j - i + 1))
        tried += 1
        want = {name: d for name, d in best.items() if d >= L.SCORE - 1e-9}
        assert set(got.get(doc, {})) <= set(want) and bool(want) == bool(got.get(doc))
        if want:
            assert abs(max(got[doc].values()) - max(want.values())) < 1e-9
    assert tried >= 50
