from pitchline.llm import licenses

SCHEMA = "doc_id long, text string, labels string, row long, words string"  # extra columns clash with inner names

CASES = [
    (1, None), (2, ""), (3, "Released under the MIT License."), (4, "GNU General-Public\nLICENSE v3; gnu general public license"),
    (5, "Licensed under CC BY-NC 4.0."), (6, "gnu general public  "), (7, "MIT, License Apache/License cc by"),
    (8, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: " + "x " * 40_000),
    (9, "source forms and binary use of redistribution conditions without permitted modification"),
    (10, "é" + "mit license"), (10, "é mit license"), (10, "é mit license"), (None, "apache license"),
    (12, "Distributed under the Boost Software License, Version 1.0. This is free and unencumbered software released into the public "
         "domain. To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. "
         "This program and the accompanying materials are made available under the terms of the Eclipse Public License. This Source Code "
         "Form is subject to the terms of the Mozilla Public License, v. 2.0. Permission to use, copy, modify, and/or distribute this "
         "software for any purpose with or without fee is hereby granted."),
    (13, "purpose extent eclipse conditions binary source unencumbered waived boost neighboring redistribution mozilla agpl affero " * 3000
         + "Released under the MIT License: permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (11, "This is free and unencumbered software released into the public domain.")]


def brute(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_and_labels(spark):
    df = spark.createDataFrame([(d, t, "x", 1, "w") for d, t in CASES] , SCHEMA).repartition(3)
    rows = licenses.scan(df).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                  for r in rows), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in CASES), key=repr)
    labels = {r["doc_id"]: r["labels"] for r in rows}
    score = {r["doc_id"]: r["score"] for r in rows}
    assert all(0 <= s <= 1 for s in score.values()) and score[1] == score[2] == 0
    assert labels[5] == "cc-by,cc-by-nc" and labels[8] == "bsd" and labels[9] == "" and labels[11] == "unlicense"
    assert labels[12] == "boost,cc0,epl,isc,mpl,unlicense" and "mit" in labels[13].split(",")
    assert score[8] == 1 and set(labels[4].split(",")) == {"gpl"}


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_index_takes_the_rarest_words():
    postings, used = licenses.build_index(100, {"the": 90, "license": 20, "mit": 3})
    mit = {w for w, name, _, _ in postings if name == "mit"}
    assert "the" not in mit and "of" in {w for w, _, _, _ in postings} or "mit" in mit
    for name in licenses.TEMPLATES:
        assert abs(sum(share for _, t, _, share in postings if t == name) - 1) < 1e-9
