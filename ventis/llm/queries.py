"""Queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis.llm import (
    collocations,
    doc_fingerprints,
    embedding_dedup,
    language_id,
    licenses,
    line_dedup,
    merkle,
    ngram_lm,
    packing,
    pii,
    piece_codec,
    sharding,
    simhash_dedup,
)

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
CORPUS_KEY = "surrogates-v1"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before, lines dropped, and the digest of the kept text."""
    cut = line_dedup.dedup_lines(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: links at cosine 0.95, component, and whether it is the component's first."""
    return embedding_dedup.near_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprints of its text and of its edit, with likeness to edit and next."""
    return doc_fingerprints.edited_fingerprints(_documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: its tokens' checksum and its place in a sequence of 4096 tokens."""
    return packing.pack_documents(_documents(spark, sf_dir), WORD_TOKENIZER)


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: log10 probability by the Katz model and by the smoothed unigram base."""
    docs = _documents(spark, sf_dir).withColumn("learn", language_id.fold() != 1)
    held_out = F.coalesce(language_id.fold() == 1, F.lit(False))
    return ngram_lm.score_documents(docs, "learn").select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: predicted language and its posterior; fold 0 of 5 is never learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(docs.filter(language_id.fold() != 0))
    held_out = F.coalesce(language_id.fold() == 0, F.lit(False))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its shard of 16 under the key law, its place there, and its shard of 17."""
    now = sharding.SlotMap.initial(sharding.SHARDS)
    grown = now.add_shard()
    placed = sharding.assign(_documents(spark, sf_dir), now)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        grown.shard_of(sharding.slot_of()).alias("grown_shard"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its piece ids, and digest of their decoding."""
    return piece_codec.encoding_digests(_documents(spark, sf_dir), PIECE_MODEL)


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: SimHash of 4-word shingles and component over links of up to 4 bits."""
    found = simhash_dedup.simhash_components(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the text with surrogates, and how many entities were replaced."""
    return pii.replace_entities(_documents(spark, sf_dir), CORPUS_KEY)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: the 2000 phrases of 2 or 3 words that hang together most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return collocations.collocations(docs.select("doc_id", "lang", "text"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its place under the root, its proof, and the root its tampered copy folds to."""
    return merkle.manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: places of the base phrases, labels of the notices found, and the best share."""
    return licenses.scan_licenses(_documents(spark, sf_dir)).drop("places")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_minhash_fingerprints": op3_minhash_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_katz_scores": op5_katz_scores,
    "op6_language_id": op6_language_id,
    "op7_virtual_slots": op7_virtual_slots,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scan": op13_license_scan,
}

# Lines compare as DuckDB's ASCII strip and lower-case of A-Z; the rest has no SQL form.
ORACLES = {
    "op1_line_dedup": r"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        repeated AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (
            SELECT k.doc_id, k.pos, k.line, r.last IS NOT NULL AND r.last <> k.doc_id AS dropped
            FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
                   AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op11_phrase_collocations": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece
                   FROM docs),
        runs AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
                 FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM runs GROUP BY lang),
        grams AS (
            SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
                 (VALUES (1), (2), (3)) AS sizes(k)
            WHERE i + k - 1 <= len(w)),
        counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
                   HAVING count(*) >= 10),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
        cuts AS (
            SELECT c.lang, c.size, c.phrase, c.f AS a, k, array_to_string(w[1:k], ' ') AS head,
                   array_to_string(w[k + 1:], ' ') AS rest
            FROM candidates c, (VALUES (1), (2)) AS ks(k) WHERE k < size),
        scored AS (
            SELECT x.lang, x.size, x.phrase, x.a, x.k, h.f AS l, t.f AS r,
                   (1000000::HUGEINT * x.a * x.a) // (h.f::HUGEINT * t.f) AS score
            FROM cuts x JOIN counts h ON h.lang = x.lang AND h.phrase = x.head
                        JOIN counts t ON t.lang = x.lang AND t.phrase = x.rest),
        best AS (SELECT * FROM scored
                 QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(f) AS f FROM (
                SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')])
                    AS part FROM candidates WHERE size = 3) GROUP BY lang, part),
        kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.part = b.phrase
                 WHERE g.f IS NULL OR 100 * g.f < 50 * b.a),
        ranked AS (SELECT *, row_number() OVER (
                       PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
    """,
    "op12_merkle_manifest": r"""
        WITH RECURSIVE
        crc AS (
            SELECT doc_id, list_reduce(
                list_prepend(4294967295, list_transform(
                    string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda s, b: list_reduce(
                    list_prepend(xor(s, b), range(8)),
                    lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS state
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
        fields AS (
            SELECT d.doc_id, source, text,
                   coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   CASE WHEN xor(state, 4294967295) % 2 = 0 THEN replace(text, chr(10), '')
                        ELSE text END AS bent
            FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id),
        leaves AS (
            SELECT doc_id, coalesce(source, '') AS s, source IS NULL AS without,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(bent) || ':' || bent, '-')) AS folded
            FROM fields),
        placed AS (
            SELECT doc_id, leaf, folded,
                   dense_rank() OVER (ORDER BY without DESC, s) - 1 AS tree,
                   row_number() OVER (PARTITION BY without, s ORDER BY doc_id NULLS FIRST, leaf) - 1
                       AS pos,
                   count(*) OVER (PARTITION BY without, s) AS n
            FROM leaves),
        inner_tree AS (
            SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM inner_tree WHERE n > 1 GROUP BY tree, level, pos // 3, n),
        subroots AS (SELECT tree, h FROM inner_tree WHERE n = 1),
        outer_tree AS (
            SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, h FROM subroots
            UNION ALL
            SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM outer_tree WHERE n > 1 GROUP BY level, pos // 3, n),
        root AS (SELECT h FROM outer_tree WHERE n = 1),
        runs AS (
            SELECT tree, level, pos // 3 AS run, list(h ORDER BY pos) AS kids FROM inner_tree
            WHERE n > 1 GROUP BY tree, level, pos // 3, n
            UNION ALL
            SELECT -1, level, pos // 3, list(h ORDER BY pos) FROM outer_tree
            WHERE n > 1 GROUP BY level, pos // 3, n),
        climb AS (
            SELECT doc_id, leaf, tree, tree AS own, 0 AS level, pos, n, folded, '' AS proof
            FROM placed
            UNION ALL
            SELECT * FROM (
                SELECT c.doc_id, c.leaf, r.tree, c.own, c.level + 1, c.pos // 3, (c.n + 2) // 3,
                       sha256(array_to_string(list_transform(
                           r.kids, lambda h, i: if(i = c.pos % 3 + 1, c.folded, h)), '')),
                       c.proof || array_to_string(list_filter(
                           r.kids, lambda h, i: i <> c.pos % 3 + 1), '')
                FROM climb c JOIN runs r
                  ON r.tree = c.tree AND r.level = c.level AND r.run = c.pos // 3
                WHERE c.n > 1
                UNION ALL
                SELECT c.doc_id, c.leaf, -1, c.own, 0, c.own, s.n, c.folded, c.proof
                FROM climb c, (SELECT count(*) AS n FROM subroots) s
                WHERE c.n = 1 AND c.tree >= 0))
        SELECT c.doc_id, c.leaf, s.h AS subroot, root.h AS root, sha256(c.proof) AS proof_sha256,
               c.folded AS folded_root, c.folded = root.h AS verified
        FROM climb c JOIN subroots s ON s.tree = c.own, root
        WHERE c.n = 1 AND c.tree = -1
    """,
    "op13_license_scan": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id,
                   list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM documents),
        notices(label, base, notice, key) AS (VALUES
            ('cc-by', true, 'cc by', 'cc by'),
            ('gpl', true, 'general public license', 'general public license'),
            ('reserved', true, 'all rights reserved', 'all rights reserved'),
            ('agpl-3.0', false, 'gnu affero general public license version 3',
             'gnu affero general public license'),
            ('apache-2.0', false, 'licensed under the apache license version 2 0',
             'apache license version 2 0'),
            ('apache-2.0', false, 'you may not use this file except in compliance with the license',
             'except in compliance with the license'),
            ('bsd', false, 'redistribution and use in source and binary forms with or without '
             || 'modification are permitted provided that the following conditions are met',
             'redistribution and use in source and binary forms'),
            ('cc-by-4.0', false, 'licensed under cc by 4 0', 'cc by 4 0'),
            ('cc-by-nc-4.0', false, 'licensed under cc by nc 4 0', 'cc by nc 4 0'),
            ('cc-by-sa-4.0', false, 'licensed under cc by sa 4 0', 'cc by sa 4 0'),
            ('cc0-1.0', false, 'to the extent possible under law the author has waived all '
             || 'copyright and related or neighboring rights to this work',
             'waived all copyright and related or neighboring rights'),
            ('gpl-2.0', false, 'licensed under the gnu general public license version 2',
             'gnu general public license version 2'),
            ('gpl-3.0', false, 'licensed under the gnu general public license version 3',
             'gnu general public license version 3'),
            ('isc', false, 'permission to use copy modify and or distribute this software for any '
             || 'purpose with or without fee is hereby granted',
             'for any purpose with or without fee is hereby granted'),
            ('lgpl', false, 'gnu lesser general public license', 'lesser general public license'),
            ('mit', false, 'released under the mit license', 'mit license'),
            ('mit', false, 'permission is hereby granted free of charge to any person obtaining a '
             || 'copy of this software and associated documentation files to deal in the software '
             || 'without restriction', 'permission is hereby granted free of charge'),
            ('mpl-2.0', false, 'this source code form is subject to the terms of the mozilla '
             || 'public license v 2 0', 'mozilla public license'),
            ('unlicense', false, 'this is free and unencumbered software released into the public '
             || 'domain', 'free and unencumbered software')),
        known AS (
            SELECT row_number() OVER () AS t, label, base, string_split(notice, ' ') AS nw,
                   string_split(key, ' ') AS kw,
                   len(string_split(split_part(' ' || notice || ' ', ' ' || key || ' ', 1), ' ')) - 1
                       AS key_at
            FROM notices),
        template_words AS (SELECT t, unnest(nw) AS word, unnest(range(len(nw))) AS i FROM known),
        held AS (
            SELECT word, count(*) AS df
            FROM (SELECT row, unnest(list_distinct(w)) AS word FROM docs)
            WHERE word IN (SELECT word FROM template_words) GROUP BY word),
        weights AS (
            SELECT t, i, tw.word, ln(1 + (SELECT count(*) FROM docs) / (1 + coalesce(df, 0))) AS idf
            FROM template_words tw LEFT JOIN held ON held.word = tw.word),
        mass AS (SELECT t, sum(idf) AS mass FROM weights GROUP BY t),
        spots AS (SELECT row, unnest(w) AS word, unnest(range(len(w))) AS spot FROM docs),
        starts AS (
            SELECT d.row, d.w, k.*, s.spot FROM spots s JOIN known k ON k.kw[1] = s.word
            JOIN docs d ON d.row = s.row
            WHERE d.w[s.spot + 1:s.spot + len(k.kw)] = k.kw),
        shares AS (
            SELECT s.row, s.label, s.base, s.spot,
                   sum(CASE WHEN s.spot - s.key_at + x.i >= 0
                             AND s.w[greatest(s.spot - s.key_at + x.i, 0) + 1] = x.word
                            THEN x.idf ELSE 0 END) / any_value(m.mass) AS share
            FROM starts s JOIN weights x ON x.t = s.t JOIN mass m ON m.t = s.t
            GROUP BY s.row, s.label, s.base, s.spot, s.t),
        found AS (SELECT * FROM shares WHERE base OR share >= 0.8),
        summed AS (
            SELECT row, count(*) FILTER (WHERE base) AS n_base,
                   min(spot) FILTER (WHERE base) AS first_word,
                   max(spot) FILTER (WHERE base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM found GROUP BY row)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               coalesce(round(score, 6), 0.0) AS score
        FROM docs LEFT JOIN summed ON summed.row = docs.row
    """,
}
