"""Frequent phrases and their scores against brute force."""

import collections
import re

import numpy as np
import pytest

from ventis.llm import collocations as C

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, phrase string, f long, grp long"


def counted(rows, longest=3):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    f[lang, tuple(words[at:at + size])] += 1
    return f, n


def brute_force(rows, min_count, top):
    f, n = counted(rows)
    out = set()
    for lang in n:
        found = []
        for (own, words), a in f.items():
            if own != lang or len(words) < 2 or a < min_count:
                continue
            cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k)
                    for k in range(1, len(words))]
            score, k = min(cuts)
            around = [b for (other, long), b in f.items()
                      if other == lang and len(long) == 3 and len(words) == 2 and b >= min_count
                      and words in (long[:2], long[1:])]
            if not any(100 * b >= 50 * a for b in around):
                found.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]],
                              f[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def rows_of(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"])
            for r in df.collect()}


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(5)
    vocabulary = ["New", "york", "city", "of", "the", "É", "日本", "z\u0085z", "I'm", "x\x1cy"]
    rows = []
    for doc in range(300):
        words = rng.choice(vocabulary, rng.integers(0, 40), p=np.arange(10, 0, -1) / 55)
        joints = rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b"], len(words))
        text = "".join(w + j for w, j in zip(words, joints))
        rows.append((doc, text, [None, "en", "es"][doc % 3], "x", 1, 1))
    rows += [(None, None, "en", "x", 1, 1), (None, "new york", None, "x", 1, 1), (7, "", "de", "x", 1, 1),
             (1, "New York city " * 5000, "en", "x", 1, 1)] + [(9, "of the city", "es", "x", 1, 1)] * 20
    return rows


@pytest.mark.parametrize("block, shard", [(1 << 23, 1 << 22), (2000, 500)])
def test_phrases_match_brute_force(spark, made, block, shard):
    docs = spark.createDataFrame(made, SCHEMA)
    got = C.collocations(docs, top=40, block_bytes=block, shard_bytes=shard)
    assert rows_of(got) == brute_force(made, 10, 40) and got.count() > 40


def test_counts_and_word_totals(spark, made):
    docs = spark.createDataFrame(made, SCHEMA)
    f, n = counted(made)
    rows = C.frequent_phrases(docs, min_count=10, block_bytes=3000).collect()
    assert {(r["lang"], r["phrase"]): r["f"] for r in rows if r["size"]} == {
        (lang, " ".join(words)): count for (lang, words), count in f.items() if count >= 10}
    assert {r["lang"]: r["f"] for r in rows if not r["size"]} == dict(n)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(2)
    stream = np.concatenate([np.repeat(np.arange(50, dtype=np.uint32), 40),
                             rng.integers(1000, 1 << 32, 20_000).astype(np.uint32)])
    rng.shuffle(stream)
    summary = C.MisraGries(len(stream) // 40 + 1)
    for part in np.array_split(stream, 37):
        summary.merge(part, np.ones(len(part), np.int64))
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.deducted < 40
    assert set(range(50)) <= set(summary.reaching(40).tolist())


def test_scores_are_exact_beyond_64_bits(spark):
    a = 999_999_999_999_999
    row = spark.sql(f"SELECT {a}L AS a, {a + 7}L AS l, {a + 1}L AS r")
    got = row.select(C._score(row.a, row.l, row.r).alias("s")).first()["s"]
    assert got == 1_000_000 * a * a // ((a + 7) * (a + 1))
