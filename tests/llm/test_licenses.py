"""Licence notices wherever they stand in a text, on words."""

from __future__ import annotations

import textwrap

from gridlake.llm.license_dice import TEMPLATES, scan

MIT = next(t for name, t in TEMPLATES if name == "MIT" and t.startswith("Permission"))
GPL3 = next(t for name, t in TEMPLATES if name == "GPL-3.0" and t.startswith("This program"))
PROSE = "We walked along the river until the light was gone and the boats had left the harbour. "


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = scan(df).collect()
    return {(r.id, r.license) for r in rows}, {(r.id, r.license): r for r in rows}


def test_notices_within_lines_and_paragraphs(spark):
    texts = [
        "(c) 2020 Foo Inc. Licensed under CC BY 4.0.",
        "This file is part of X. Released under the MIT License.",
        PROSE * 3 + "The code is Licensed under the Apache License, Version 2.0. " + PROSE * 3,
        textwrap.fill(MIT, 18),  # over more than twenty lines
        "\n\n".join(textwrap.wrap(MIT, 30)),
        PROSE * 200 + GPL3 + PROSE * 200,
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
        PROSE * 5,
        "Use of this source code is governed by a GPL style licence found elsewhere.",
    ]
    assert texts[3].count("\n") >= 20
    got, rows = found(spark, texts)
    assert got == {(0, "CC-BY-4.0"), (1, "MIT"), (2, "Apache-2.0"), (3, "MIT"), (4, "MIT"), (5, "GPL-3.0"), (6, "MIT"), (6, "Apache-2.0")}
    assert all(r.dice == 1.0 for k, r in rows.items()) and rows[3, "MIT"].n_lines > 20
    assert rows[0, "CC-BY-4.0"].word == 4 and rows[0, "CC-BY-4.0"].n_words == 6


def test_changed_notices(spark):
    words = MIT.split()
    longer = words[:20] + ["kindly", "and", "gladly"] + words[20:]
    shorter = words[:10] + words[14:]
    other = [w if i % 3 else f"word{i}" for i, w in enumerate(words)]  # two bigrams of three are lost
    got, rows = found(spark, [" ".join(x) for x in (longer, shorter, other)])
    assert got == {(0, "MIT"), (1, "MIT")} and all(0.8 <= r.dice < 1 for r in rows.values())


def test_one_long_text_with_many_notices(spark):
    got, rows = found(spark, [(PROSE + "Released under the MIT License.\n") * 3000 + "Licensed under CC BY-SA 4.0."])
    assert got == {(0, "MIT"), (0, "CC-BY-SA-4.0")} and rows[0, "MIT"].line == 1


def test_repeated_rows_count_once(spark):
    df = spark.range(3000).selectExpr("cast(null as long) doc_id", "'Released under the MIT License. Licensed under CC BY 4.0.' text")
    assert {(r.id, r.license, r.dice) for r in scan(df).collect()} == {(None, "MIT", 1.0), (None, "CC-BY-4.0", 1.0)}
