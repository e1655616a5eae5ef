from math import exp

import pytest

from strandline.llm import license_scan as ls

ROWS = [
    (1, "Some words\nReleased under the MIT License.\nmore text"),
    (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, "LICENSED under the Apache License, version 2.0!"),
    (4, "all rights reserved"),
    (5, "Licensed under CC BY-NC 4.0."),
    (6, "The café rights were thoroughly reserved for guests of version two"),
    (7, None),
    (8, ""),
    (9, "\n\n"),
    (10, "w " * 50_000 + "Licensed under CC BY 4.0."),
    (None, "Released under the MIT License."),
    (1, "Some words\nReleased under the MIT License.\nmore text"),
]


@pytest.fixture(scope="module")
def model(spark, sf):
    return ls.fit(spark.read.parquet(f"{sf}/documents.parquet"))


def brute(rows, model):
    weights, intercepts = dict(model[0]), model[1]
    split = lambda t: "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split()
    out = {}
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            w = split(line)
            met = {g for g in {*w, *map(" ".join, zip(w, w[1:], strict=False))} if g in weights}
            if met:
                z = [b + sum(weights[g][k] for g in met) for k, b in enumerate(intercepts)]
                k = max(range(len(z)), key=lambda i: z[i])
                out[d, p] = ls.FAMILIES[k], round(1 / sum(exp(v - z[k]) for v in z), 9)
    return out


def test_families_and_brute_force(spark, model):
    docs = spark.createDataFrame([(d, t, "x") for d, t in ROWS], "doc_id long, text string, family string")
    rows = ls.scan(docs, *model).where("n_lines = 1").collect()
    assert {(r.doc_id, r.paragraph): (r.family, round(r.probability, 9)) for r in rows} == brute(ROWS, model)
    assert len({(r.doc_id, r.paragraph) for r in rows}) == len(rows)
    found = {(r.doc_id, r.paragraph): r.family for r in rows if r.confirmed}
    assert found == {(1, 1): "mit", (2, 0): "gpl", (3, 0): "apache", (4, 0): "all-rights-reserved", (5, 0): "cc-by-nc", (10, 0): "cc-by", (None, 0): "mit"}


def test_whole_table_is_native(spark, sf):
    out = ls.op5_license_scan(spark, sf)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    lines = {"Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "All rights reserved.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."}
    planted = {(d, p) for d, t in docs for p, line in enumerate(t.split("\n")) if line in lines}
    assert {(r.doc_id, r.paragraph) for r in out.where("confirmed").collect()} == planted


def test_frequency_is_counted_over_all_paragraphs(spark):
    """A line that a third of all rows hold and one in 3 % of them tell nothing, whatever their hashes."""
    hot, some = "permission is hereby granted to every reader", "free of charge for any person here"
    rows = [(i, hot if i % 3 == 0 else some if i % 30 == 1 else f"plain text {i} and more {i * 7}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights, intercepts = ls.fit(docs)
    held = {g for t in (hot, some) for g in ls.grams_of(t.split())}
    assert "hereby granted" in ls.licence_grams() and not held & {g for g, _ in weights}
    assert ls.scan(docs.where("doc_id % 3 = 0 OR doc_id % 30 = 1"), weights, intercepts).count() == 0


def test_unknown_examples_are_distinct_and_whole(spark):
    hot = "x " * 500 + "the software"
    docs = spark.createDataFrame([(i, hot if i % 3 else f"text {i} of the work") for i in range(900)], "doc_id long, text string")
    drawn = ls._unknown(ls.lines(docs, ls.licence_grams()), 200)
    assert len(drawn) == 200 and sum("software" in g for g in drawn) == 1


def test_empty_table(spark, model):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ls.scan(docs, *model).count() == 0
    assert ls.fit(docs)[0]


WRAPPED = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction"""


def test_wrapped_and_altered_notices(spark, model):
    """Notices over several lines and in other words are found; what only speaks of licences isn't."""
    rows = [(1, "prose before\n" + WRAPPED + "\nprose after"), (2, MIT), (3, "// " + MIT.replace("\n", "\n// ")), (4, "The code is licensed under the terms of the Apache License 2.0 by its authors"), (5, "Except where noted, text is available under the Creative Commons Attribution-ShareAlike License")]
    clean = [(10, "His fishing license was lost in the river"), (11, "The copyright office reserved two rooms for the public"), (12, "Permission to enter the garden was granted to the public\nfree of charge for any person"), (13, "licensed under a different name")]
    out = ls.scan(spark.createDataFrame(rows + clean, "doc_id long, text string"), *model).where("confirmed").collect()
    found = {(r.doc_id, r.family) for r in out}
    assert {(1, "gpl"), (2, "mit"), (3, "mit"), (4, "apache"), (5, "cc-by-sa")} <= found
    assert not {d for d, _ in found} & {d for d, _ in clean}


def test_held_out_rows_are_not_in_the_fit():
    parts = ls._licences()
    fitted, held = ({tuple(w) for _, w, h in parts if h is side} for side in (False, True))
    assert held and not fitted & held
    assert {f for f, _, h in parts if h} == set(ls.NOTICES)


def test_calibration_on_held_out_notices(spark, model):
    """Notices that the fit hasn't seen: most go to their family, and confidence is close to the share that is right."""
    notices = [(f, n) for f in ls.NOTICES for k, n in enumerate(ls.NOTICES[f]) if k % 4 == 3]
    others = [("unknown", n) for n in ls.OTHERS[2::3]]
    rows = [(i, t) for i, (_, t) in enumerate(notices + others)]
    got = {r.doc_id: (r.family, r.probability) for r in ls.scan(spark.createDataFrame(rows, "doc_id long, text string"), *model).where("n_lines = 1").collect()}
    right = [got.get(i, ("unknown", 1.0))[0] == f for i, (f, _) in enumerate(notices + others)]
    mean = sum(got.get(i, ("unknown", 1.0))[1] for i in range(len(rows))) / len(rows)
    assert sum(right) >= 0.8 * len(right) and abs(mean - sum(right) / len(right)) < 0.15


@pytest.mark.parametrize("family", ["mit", "public-domain"])
def test_left_out_family_is_never_confirmed(spark, sf, monkeypatch, family):
    """Notices of a family that the model doesn't know, and no other one words alike, are confirmed as no family."""
    left = ls.NOTICES[family]
    monkeypatch.setattr(ls, "NOTICES", {f: n for f, n in ls.NOTICES.items() if f != family})
    monkeypatch.setattr(ls, "FAMILIES", [*sorted(ls.NOTICES), ls.UNKNOWN])
    model = ls.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = ls.scan(spark.createDataFrame(list(enumerate(left)), "doc_id long, text string"), *model).where("n_lines = 1").collect()
    assert not [r for r in rows if r.confirmed]
    named = {r.doc_id for r in rows if r.family != ls.UNKNOWN}
    assert len(named) <= 0.3 * len(left)


def test_vocabulary_over_its_bound_is_an_error(spark, sf, monkeypatch):
    monkeypatch.setattr(ls, "MAX_FEATURES", 10)
    with pytest.raises(ValueError, match="n-grams"):
        ls.fit(spark.read.parquet(f"{sf}/documents.parquet"))
