"""License scan against a plain search, on made and odd texts."""

import math
import re

import pytest

from ventis.llm import licenses as L

SCHEMA = "doc_id long, text string, words string, found string, known int, places int"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
TEXTS = [
    None, "", "   ...", "Nothing of the kind here, by and by; the mit of licensed rights",
    "Licensed under CC BY-NC 4.0. Licensed under CC-BY 4.0",
    "CC BY cc by CC, by", "all all rights reserved rights reserved ALL RIGHTS RESERVED!",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public license version 3", "version 3 of the General Public License",
    "Released under the MIT License", "MIT License", "mit", "Über the MIT Licenseé",
    "licensed under the Apache License, Version 2.0", "apache license version 2.0 alone",
    "rights reserved", "License " * 5000 + "Apache License Version 2.0 " * 300,
    "\n\tredistribution and use in source and binary forms, with or without\nmodification, are "
    "permitted provided that the following conditions hold",
    "\u212aey cc\u00a0by cc\x7fby cc0by 日本 cc by",
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(texts):
    cut = [words(t) for t in texts]
    known = L.templates()
    idf = {w: math.log(1 + len(cut) / (1 + sum(w in set(c) for c in cut)))
           for t in known for w in t.words}
    out = []
    for c in cut:
        base, labels, shares = [], set(), [0.0]
        for t in known:
            for at in range(len(c) - len(t.key) + 1):
                if tuple(c[at:at + len(t.key)]) != t.key:
                    continue
                start = at - t.key_at
                held = sum(idf[w] for i, w in enumerate(t.words)
                           if 0 <= start + i < len(c) and c[start + i] == w)
                share = held / sum(idf[w] for w in t.words)
                if t.base or share >= L.MIN_SHARE:
                    labels.add(t.label)
                    shares.append(min(1.0, round(share, 6)))
                    if t.base:
                        base.append((at, t.label))
        starts = [at for at, _ in base]
        out.append((len(c), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), max(shares)))
    return out


def test_scan_matches_brute_force(spark):
    rows = [(i, t, "w", "f", 1, 2) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in L.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    for at, want in enumerate(brute_force(TEXTS)):
        row = got[at]
        assert tuple(row[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels",
                                      "labels")) == want[:-1], TEXTS[at][:60]
        assert row["score"] == pytest.approx(want[-1], abs=1e-6)


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(1, "all rights reserved", "w", "f", 1, 2)] * 3 + [(None, "cc by", "w", "f", 1, 2)]
    got = L.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] is None, r["base_labels"]) for r in got) == [
        (False, "reserved")] * 3 + [(True, "cc-by")]
    assert L.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    from conftest import plan_of
    df = L.license_words(spark.createDataFrame([(1, "a")], "doc_id long, text string"), L.templates())
    assert "Python" not in plan_of(df) and "Exchange" not in plan_of(df)
    scan = L.scan_licenses(spark.range(3).selectExpr("id AS doc_id", "'cc by' AS text"))
    assert "Python" not in plan_of(scan) and "Exchange" not in plan_of(scan)
