from cases import LONG, awkward, clashing, docs, empty

from candlemill.llm import licenses as li


def found(df):
    return sorted((r["doc_id"], r["license"], r["first_word"], r["containment"]) for r in df.collect())


def test_templates_in_texts(spark):
    rows = [
        (1, "Some words before. Released under the\nMIT License. And after"),
        (2, "all RIGHTS reserved"), (3, "all rights were reserved"), (4, LONG + " " + li.TEMPLATES["gpl-3.0"] + " " + LONG),
        (5, li.TEMPLATES["mit-permission"].replace("obtaining", "getting")), (6, "released under the mit"), (7, LONG),
    ]
    got = found(li.scan(clashing(docs(spark, rows), "words", "hashes", "minima")))
    assert [(g[0], g[1]) for g in got] == [(1, "mit"), (2, "all-rights-reserved"), (4, "gpl-3.0")]
    assert all(g[3] == 1 for g in got)


def test_partial_containment(spark):
    template = " ".join(f"w{i}" for i in range(104))  # 100 shingles
    damaged = template.replace("w50 ", "other ").replace("w70 ", "other ")  # 10 shingles fewer
    broken = " ".join("other" if i % 10 == 5 else f"w{i}" for i in range(104))
    rows = [(1, LONG + " " + damaged + " tail " + LONG), (2, broken)]
    got = found(li.scan(docs(spark, rows), {"t": template}))
    assert [(g[0], g[3]) for g in got] == [(1, 0.9)]


def test_awkward_rows_and_templates(spark):
    assert li.scan(awkward(spark)).count() == 0
    assert li.scan(empty(spark)).count() == 0
    assert li.scan(awkward(spark), {}).count() == 0 and li.scan(awkward(spark), {"none": "!!"}).count() == 0
    twice = docs(spark, [(None, "All rights reserved"), (None, "All rights reserved"), (1, None)])
    assert [tuple(r) for r in li.scan(twice).collect()] == [(None, "all-rights-reserved", 2, 0, 1.0)]


def test_bands_suffice():
    bands = li.bands_needed(li.CONTAINMENT)
    assert (1 - li.CONTAINMENT / (3 - li.CONTAINMENT)) ** bands <= li.MISS
    assert len(set(li.masks(bands))) == bands


def test_no_python_in_the_plan(spark):
    plan = li.scan(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_common_licences(spark):
    names = ["bsd-2-or-3-clause-text", "bsd-third-clause", "isc-or-0bsd-text", "lgpl-2.1-header", "mpl-2.0-header", "mit-text", "gpl-3-text", "agpl-3.0-spdx"]
    usual = "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
    usual += " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n"
    rows = [(i, f"Some words before. {li.TEMPLATES[n]}\n and some after.") for i, n in enumerate(names)]
    got = {(g[0], g[1]) for g in found(li.scan(docs(spark, [*rows, (-1, usual), (-2, usual.replace("GNU", "GNU Affero"))])))}
    assert set(enumerate(names)) <= got
    alone = {(i, n) for i, n in enumerate(names) if n not in ("mit-text", "gpl-3-text")}
    assert {g for g in got if g[0] not in (5, 6)} == alone | {(-1, "gpl-3.0-header"), (-2, "agpl-3.0-header")}
