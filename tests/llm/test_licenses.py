import random
import re

from skytally.llm.licenses import PHRASES, STATEMENTS, TELLING, scan_licenses
from skytally.llm.queries import QUERIES


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({l for _, l in places}))


def test_base_against_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op6_license_scan"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    hits = 0
    for d in docs:
        r = found[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(d.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        hits += r.n_base
    assert hits


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction")


def test_spans(spark):
    words = MIT.split()
    edited = " ".join(words[:9] + ["whole", "new"] + words[9:18] + words[19:])
    rows = [
        (1, f"x {MIT} y"), (2, edited), (3, " ".join(words[:12])), (4, "CC BY-NC cc by nc"), (5, None), (6, "mit license"),
        (7, "a " * 100_000 + "under the MIT License " + "b " * 100_000), (8, "under the mit license " * 40), (8, "ÉCC-BY-NC"), (None, "cc by nc"),
    ]
    docs = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, words string, template int")
    found = [(r.doc_id, r.n_words, [tuple(s)[:3] for s in r.spans]) for r in scan_licenses(docs).collect()]
    assert len(found) == len(rows)
    by = {}
    for i, n, spans in found:
        by.setdefault(i, []).append((n, spans))
    assert by[1] == [(31, [("mit", 1, 30)])]
    assert [s[0] for s in by[2][0][1]] == ["mit"]
    assert by[3][0][1] == [] and by[5] == [(0, [])] and by[6] == [(2, [])]
    assert by[4] == [(6, [("cc-by-nc", 0, 3), ("cc-by-nc", 3, 6)])]
    assert by[7][0][1] == [("mit", 100_000, 100_004)]
    assert sorted(len(s) for _, s in by[8]) == [0, 40]
    assert by[None] == [(3, [("cc-by-nc", 0, 3)])]
    assert scan_licenses(docs.limit(0)).count() == 0


STATED = {
    "GNU General Public License (GPL) version 3": {"gpl-3"},
    "the gnu general public license, version 2": {"gpl-2"},
    "gnu general public license": set(),
    "GNU Lesser General Public License v3": {"lgpl"},
    "GNU Affero General (AGPL) Public License": {"agpl"},
    "mozilla public license, v. version 2.0": {"mpl-2"},
    "public license version 2": set(),
    "creative commons attribution (by) noncommercial 4.0": {"cc-by-nc"},
    "creative commons attribution 4.0 sharealike": {"cc-by-sa"},
    "creative commons attribution": set(),
    MIT.replace("to any person", "w x y z to any person"): {"mit"},
    MIT.replace("free of charge, ", ""): {"mit"},
    " ".join(MIT.split()[:15]): set(),
    "redistribution and use in source and binary forms, with or without any modification, are permitted": set(),
    "redistribution and use in source and binary forms, with or without any modification, are permitted provided that the following": {"bsd"},
    "permission to use copy and modify and or distribute this software for any purpose with or without fee is hereby granted": {"isc"},
    "This is free and unencumbered software released to the public domain": {"unlicense"},
}


def test_statements_with_words_put_in_or_left_out(spark):
    filler = "some other words stand here and there in the text of a person to any use "
    rows = [(i, filler * (i % 3) + text + " " + filler) for i, text in enumerate(STATED)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: {s.label for s in r.spans} for r in scan_licenses(docs).collect()}
    assert found == {i: labels for i, labels in enumerate(STATED.values())}


def test_merge_and_share_against_plain_code(spark):
    """Edited statements between other words: a copy counts if some stretch around a common run holds enough of it."""
    r = random.Random(9)
    filler = ["x", "y", "the", "of", "license", "to", "and", "software"]
    rows = []
    for i in range(150):
        own = r.choice(list(STATEMENTS)).split()
        edited = []
        for word in own:
            edited += [w for w in [word] if r.random() > r.choice([0, 0.05, 0.3])] + ["x"] * (r.random() < r.choice([0, 0.05, 0.3]))
        rows.append((i, " ".join([*r.choices(filler, k=r.randrange(50)), *edited, *r.choices(filler, k=r.randrange(50))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x.doc_id: {s.label for s in x.spans if not s.phrase} for x in scan_licenses(docs).collect()}
    assert found == {i: plain(text.split()) for i, text in rows} and sum(map(bool, found.values())) > 60


def common(own, text):
    """Longest common subsequence."""
    row = [0] * (len(text) + 1)
    for a in own:
        last = 0
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def plain(words):
    labels = set()
    for statement, label in STATEMENTS.items():
        own = statement.split()
        gap = max(3, int(0.4 * len(own)))
        at = sorted({i - j for i in range(len(words) - 2) for j in range(len(own) - 2) if words[i : i + 3] == own[j : j + 3]})
        groups = []
        for diagonal in at:
            if groups and diagonal - groups[-1][-1] <= gap:
                groups[-1].append(diagonal)
            else:
                groups.append([diagonal])
        for group in groups:
            near = words[max(0, group[0] - gap) : group[-1] + len(own) + gap]
            if common(own, near) >= 0.8 * len(own) - 1e-9 and TELLING & set(own) <= set(near):
                labels.add(label)
    return labels
