"""Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest

from ventis.llm import merkle

SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, row long, step int,"
          " hash string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = [None if v is None else str(v) for v in (*row[:4], text)]
    return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def climb(leaves, at, hashed):
    """Root of a level list, siblings on the way of ``at``, and the root folded from ``hashed``."""
    siblings = []
    while len(leaves) > 1:
        run = leaves[at // 3 * 3:at // 3 * 3 + 3]
        siblings += [h for k, h in enumerate(run) if k != at % 3]
        hashed = sha("".join(hashed if k == at % 3 else h for k, h in enumerate(run)))
        leaves = [sha("".join(leaves[k:k + 3])) for k in range(0, len(leaves), 3)]
        at //= 3
    return leaves[0], siblings, hashed


def brute_force(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for members in by_source.values():
        members.sort(key=lambda m: m[:3])
    subroots = [climb([m[2] for m in by_source[s]], 0, "")[0] for s in order]
    out = []
    for number, source in enumerate(order):
        leaves = [m[2] for m in by_source[source]]
        for at, (_, _, own, row) in enumerate(by_source[source]):
            bent = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                bent = leaf(row, row[4].replace("\n", ""))
            subroot, below, folded = climb(leaves, at, bent)
            root, above, folded = climb(subroots, number, folded)
            out.append((row[0], own, subroot, root, sha("".join(below + above)), folded, folded == root))
    return sorted(out, key=str)


def result(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=str)


def made(spread):
    rows = []
    for at in range(70):
        rows.append((at, spread[at % len(spread)], "en" if at % 4 else None, at if at % 5 else None,
                     f"line {at}\nnext é" if at % 3 else None if at % 2 else "", 1, 2, "h"))
    long = "a long line of text\n" * 20_000
    rows += [(1000, spread[0], "en", 5, long, 1, 2, "h")] + [rows[3]] * 4
    return rows + [(None, spread[0], None, None, "no\nid", 1, 2, "h")]


@pytest.mark.parametrize("spread", [["a"], ["a", None, "B", "é", "", "a", "a"]])
def test_manifest_matches_brute_force(spark, spread):
    rows = made(spread)
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got == brute_force(rows)
    assert {r[-1] for r in got} == {True, False}


def test_every_source_of_one_row_and_one_row_alone(spark):
    rows = [(i, f"s{i}", "en", 1, f"x\n{i}", 1, 2, "h") for i in range(10)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)
    assert result(spark.createDataFrame(rows[:1], SCHEMA)) == brute_force(rows[:1])


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
