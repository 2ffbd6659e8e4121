"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import (
    bpe, decontam, fim, kd_shards, licences, merkle, minhash, pii, quality, token_counts, topk, toxicity, warc,
)
from postloom.llm.labelled import held_out
from postloom.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]  # fields of a leaf, in their order


def _scored(found: DataFrame) -> DataFrame:
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(*licences.scan(table(spark, sf_dir, "documents")))


def op4_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def sample_edits() -> Column:
    """Four edits of every document, at places that follow from its id: a replacement, a
    passage of the text moved elsewhere, a removal, and an addition at the end."""
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    at = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), n + 1)
    one = lambda start, removed, inserted: F.struct(start.alias("start"), F.lit(removed).alias("removed"), inserted.alias("inserted"))
    moved = F.substr(text, (at(2) + 1).cast("int"), F.lit(60))
    return F.array(
        one(at(1), 7, F.lit(" it's edited, 42 ")), one(at(3), 0, moved), one(at(4), 40, F.lit("")), one(n + 100, 0, F.lit("\n  The end."))
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.edit(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, sample_edits())
    return counted.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = minhash.near_duplicates(docs, minhash.Settings(shingle=3, percent=85))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.stored_statistics(table(spark, sf_dir, "documents"))
    model = quality.fit(stats, table(spark, sf_dir, "labels"))
    return _scored(quality.score(stats, model).withColumnRenamed("id", "doc_id"))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(table(spark, sf_dir, "documents"), shards=8)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.encode_digests(table(spark, sf_dir, "documents"), path, pattern)


def op10_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model))


def shown_leaf() -> Column:
    """Where 3 divides the crc32 of the id, the digest of the row with its text's A-Z lower-cased."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = [lower if name == "text" else F.col(name) for name in LEAF]
    return F.when(picked, merkle.leaf_of(*fields))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = merkle.build(table(spark, sf_dir, "documents"), LEAF, group="lang", shown=shown_leaf())
    return merkle.verify(manifest).drop("group")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"), fim.Settings(seed=7, rate=100, spm=50)).drop("round_trip")


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_licences": op3_licences,
    "op4_threshold_top_k": op4_threshold_top_k,
    "op5_token_counts": op5_token_counts,
    "op6_minhash": op6_minhash,
    "op7_quality_qda": op7_quality_qda,
    "op8_kd_shards": op8_kd_shards,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_toxicity_ftrl": op10_toxicity_ftrl,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_pii": op12_pii,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f
    """,
    "op3_licences": """
        WITH t(template, label, base, notice) AS (VALUES
            (1, 'gpl', true, '+gnu +general +public +license'),
            (2, 'apache', true, '+apache +license'),
            (3, 'cc-by', true, '+cc +by'),
            (4, 'mit', true, '+mit +license'),
            (5, 'gpl-3.0', false, '+gnu +general +public +license +version +3'),
            (6, 'gpl-2.0', false, '+gnu +general +public +license +version +2'),
            (7, 'gpl-notice', false, 'this program is +free +software you can redistribute it and or modify it under the terms of the +gnu +general +public +license'),
            (8, 'apache-2.0', false, 'licensed under the +apache +license +version +2 +0'),
            (9, 'mit', false, '+permission +is +hereby +granted +free +of +charge to any person obtaining a copy of this software and associated documentation files'),
            (10, 'mit-release', false, 'released under the +mit +license'),
            (11, 'bsd', false, '+redistribution +and +use +in +source +and +binary +forms with or without modification are permitted provided that the following conditions are met'),
            (12, 'isc', false, '+permission +to +use +copy +modify +and +or +distribute this software for any purpose with or without fee is hereby granted'),
            (13, 'mpl-2.0', false, 'this source code form is subject to the terms of the +mozilla +public +license v 2 0'),
            (14, 'cc-by-nc', false, 'licensed under +cc +by +nc'),
            (15, 'cc-by-sa', false, 'licensed under +cc +by +sa'),
            (16, 'creative-commons', false, 'this work is licensed under a +creative +commons attribution'),
            (17, 'unlicense', false, 'this is free and +unencumbered +software +released +into +the +public +domain'),
            (18, 'mit-text', false, '+permission +is +hereby +granted +free +of +charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or +substantial +portions +of +the +software'),
            (19, 'isc-text', false, '+permission +to +use +copy +modify +and +or +distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice +appear +in +all +copies'),
            (20, 'bsd-2-text', false, '+redistribution +and +use +in +source +and +binary +forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or +other +materials +provided +with +the +distribution')
        ),
        tw AS (
            SELECT template, label, base, unnest(generate_series(0, len(w) - 1)) AS place, len(w) AS total,
                   ltrim(unnest(w), '+') AS word, CAST(starts_with(unnest(w), '+') AS INTEGER) AS must
            FROM (SELECT *, string_split(notice, ' ') AS w FROM t)
        ),
        needs AS (SELECT template, sum(must) AS must FROM tw GROUP BY template),
        d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        dw AS (SELECT doc_id, unnest(generate_series(0, len(w) - 1)) AS pos, unnest(w) AS word FROM d),
        found AS (
            SELECT doc_id, template, any_value(label) AS label, any_value(base) AS base, pos - place AS start,
                   count(*) / any_value(total) AS share
            FROM dw JOIN tw USING (word) JOIN needs USING (template)
            GROUP BY doc_id, template, pos - place
            HAVING sum(tw.must) = any_value(needs.must) AND 100 * count(*) >= 80 * any_value(total)
        ),
        s AS (
            SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
                   max(start) FILTER (base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN s USING (doc_id)
    """,
    "op4_threshold_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) > 0 AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM (SELECT DISTINCT ON (vec_id) vec_id, e FROM v WHERE vec_id % 100 = 0) AS q
            JOIN v AS c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_merkle_manifest": """
        WITH RECURSIVE f AS (
            SELECT doc_id, lang, text,
                   coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
                   || coalesce(octet_length(encode(source)) || ':' || source, '-')
                   || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
                   || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head
            FROM documents
        ),
        bits AS (SELECT unnest(range(256)) AS b),
        crc_table AS (
            SELECT list(c ORDER BY b) AS crcs FROM (
                SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), [CAST(0 AS UBIGINT) FOR x IN range(8)]),
                    lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE 0 END)) AS c
                FROM bits)
        ),
        leaves AS (
            SELECT doc_id, lang,
                   sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(octet_length(encode(text)) || ':'
                       || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
                   xor(4294967295, list_reduce(
                       list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(ch) AS UBIGINT) FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')]),
                       lambda c, x: xor(c >> 8, crcs[1 + CAST(xor(c, x) & 255 AS BIGINT)]))) AS crc
            FROM f, crc_table
        ),
        ranked AS (
            SELECT *, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS shown, coalesce('+' || lang, '') AS tree,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves
        ),
        levels AS (
            SELECT tree, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM ranked GROUP BY tree
            UNION ALL
            SELECT tree, level + 1, [sha256(array_to_string(nodes[i + 1 : i + 8], '')) FOR i IN range(0, len(nodes), 8)]
            FROM levels WHERE len(nodes) > 1
        ),
        subroots AS (
            SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place,
                   max(level) OVER () AS deepest, level AS height
            FROM levels WHERE len(nodes) = 1
        ),
        tops AS (
            SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
            UNION ALL
            SELECT level + 1, [sha256(array_to_string(nodes[i + 1 : i + 8], '')) FOR i IN range(0, len(nodes), 8)]
            FROM tops WHERE len(nodes) > 1
        ),
        root AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1),
        steps AS (
            SELECT r.doc_id, r.tree, r.pos, l.level, l.nodes, r.pos // pow(8, l.level)::BIGINT AS own
            FROM ranked AS r JOIN levels AS l ON r.tree = l.tree AND len(l.nodes) > 1
            UNION ALL
            SELECT r.doc_id, r.tree, r.pos, s.height + t.level, t.nodes, s.place // pow(8, t.level)::BIGINT
            FROM ranked AS r JOIN subroots AS s USING (tree) JOIN tops AS t ON len(t.nodes) > 1
        ),
        parts AS (
            SELECT tree, pos, level,
                   array_to_string(nodes[own - own % 8 + 1 : own], '') AS l,
                   array_to_string(nodes[own + 2 : own - own % 8 + 8], '') AS r
            FROM steps
        ),
        paths AS (
            SELECT tree, pos, string_agg(l || r, '' ORDER BY level) AS siblings,
                   list({'l': l, 'r': r, 'node': ''} ORDER BY level) AS path
            FROM parts GROUP BY tree, pos
        ),
        folded AS (
            SELECT k.doc_id, k.leaf, s.subroot, root.root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
                   list_reduce(list_prepend({'l': '', 'r': '', 'node': k.shown}, coalesce(p.path, [])),
                       lambda a, x: {'l': '', 'r': '', 'node': sha256(x.l || a.node || x.r)}).node AS folded_root
            FROM ranked AS k JOIN subroots AS s USING (tree) CROSS JOIN root
            LEFT JOIN paths AS p ON k.tree = p.tree AND k.pos = p.pos
        )
        SELECT *, folded_root = root AS verified FROM folded
    """,
    "op13_fill_in_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ),
        u AS (
            SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS w, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM d
        ),
        c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM u),
        p AS (
            SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1 : b], '') AS middle, array_to_string(w[b + 1 :], '') AS suffix,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM c
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p
    """,
}
