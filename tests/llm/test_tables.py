"""WARC, licences, top-k and sharding: SQL, edge cases and hot values."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from check_oracles import connect, normal
from pyspark.sql import functions as F

from postloom.llm import kd_shards, licences, queries, topk, warc
from postloom.session import scratch_path


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = connect(sf_dir).execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, result.fetchall())


PAGE = "<html>" + "x" * 120 + "</html>"


def test_warc_records_and_lookup(spark):
    rows = [
        (3, "https://Blog.Example.com:443/a?b=1#top", PAGE), (1, "http://example.com/", PAGE), (9, "http://example.com/", PAGE),
        (4, None, "short"), (5, "http://other.org:8080/x", "short"), (6, "not an address\r\nX: y", None),
        (None, "http://example.com/", PAGE), (7, "http://example.com/", ""), (8, "http://[bad", "é" * 60), (8, "http://[bad", "é" * 60),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    folder = scratch_path(spark, "warc-test")
    entries = warc.write_archives(pages, folder, archive_bytes=500)
    assert entries.select("archive").distinct().count() > 3
    assert warc.reading_tasks(spark, folder) >= spark.sparkContext.defaultParallelism
    reading = warc.read_records(entries, folder).withColumn("task", F.spark_partition_id())
    assert reading.select("task").distinct().count() > 1
    index = warc.write_index(entries, folder, block_rows=2)
    read = warc.read_records(warc.lookup(spark, index, folder, pages.select("url")), folder, payload=True).collect()
    assert len(read) == len(rows)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in read}
    assert kinds == {
        1: ("response", None), 3: ("revisit", 1), 9: ("revisit", 1), None: ("revisit", 1), 4: ("response", None), 5: ("response", None),
        6: ("response", None), 7: ("response", None), 8: ("response", None),
    }
    texts = {i: (t or "").encode() for i, _, t in rows}
    for r in read:
        assert r.payload_digest == hashlib.sha256(texts[r.page_id]).hexdigest() and r.payload_bytes == len(texts[r.page_id])
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.page_id]
    wanted = spark.createDataFrame([("https://example.com/",), ("http://nowhere.net/",)], "url string")
    found = warc.lookup(spark, index, folder, wanted).collect()
    assert sorted(str(r.page_id) for r in found) == ["1", "7", "9", "None"]
    assert {r.key for r in found} == {"com,example)/"}


def test_warc_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string, digest string")
    assert warc.archive_and_read(spark, pages).count() == 0


def test_a_key_that_fills_many_blocks(spark):
    pages = spark.range(300).selectExpr("id AS page_id", "if(id % 3 = 0, 'http://b.com/', concat('http://', id, '.com/')) AS url", "'x' AS html")
    folder = scratch_path(spark, "warc-hot")
    index = warc.write_index(warc.write_archives(pages.repartition(4), folder), folder, block_rows=7)
    hot = spark.createDataFrame([("http://b.com/",)], "url string")
    assert {r.page_id for r in warc.lookup(spark, index, folder, hot).collect()} == set(range(0, 300, 3))
    assert warc.lookup(spark, index, folder, pages.select("url")).count() == 300


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/A?x=1#f", "com,example,www)/A?x=1"), ("https://a.b:443", "b,a)/"), ("http://a.b:81/", "b,a:81)/"),
        ("", ""), (None, ""), ("plain", "plain"), ("http://[bad", "http://[bad"), ("http://a.b:x/", "http://a.b:x/"),
    ],
)
def test_reversed_host(url, key):
    assert warc.reversed_host(url) == key


def test_damaged_record_raises():
    record = warc.build_record(1, "u", b"body", hashlib.sha256(b"body").hexdigest(), None, False)
    assert warc.parse_record(record).payload == b"body"
    for bad in (record[:-1], record.replace(b"body", b"boby"), b"x" + record):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


LICENCE_TEXTS = [
    (1, "Released under the MIT License. See the mit-license; MIT  LICENSE"),
    (2, "GNU general public licence"), (3, None), (4, ""), (5, "…GNU General—Public License, version 3"),
    (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"),
    (7, "Permission is hereby granted, free of charge"), (None, "CC BY 4.0"), (8, "gnu general public Kcense apache licenſe"),
    (9, "apache license " * 30000), (10, "mit license xmit license mit license"), (10, "mit license xmit license mit license"),
    (11, "licensed under CC BY-NC"),
]


def test_licence_cases(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in LICENCE_TEXTS], "doc_id bigint, text string, words string, row int")
    con = connect("/root/testdata/sf0.001")
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [x for x in dict(LICENCE_TEXTS).items() if x[0] is not None])
    result = con.execute(queries.ORACLES["op3_licences"])
    columns = [d[0] for d in result.description]
    df = licences.digest(*licences.scan(docs))
    rows = df.collect()
    assert len(rows) == len(LICENCE_TEXTS)
    once = {r.doc_id: r for r in rows}
    unnamed = once.pop(None)
    assert (unnamed.labels, unnamed.n_base, unnamed.score) == ("cc-by", 1, 1.0)
    assert normal(df.columns, once.values()) == normal(columns, result.fetchall())
    assert once[9].n_base == 30000 and once[9].last_word == 59998 and once[6].labels == "mit"
    assert licences.digest(*licences.scan(docs.limit(0))).count() == 0


def brute_top(rows, asked, k):
    usable = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in {i: v for i, v in usable if asked(i)}.items():
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv))
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_cases(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, 6).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (None, rows[0][1])]
    rows += [(500, [1.0, 2.0]), (510, [3.0, 1.0]), (600, [0.0] * 6), (700, [1e6, -1e6, 1e6, 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score string").repartition(5)
    for block, group in ((64, 8), (16_384, 2048)):
        found = topk.top_k(vectors, F.col("vec_id") % 10 == 0, k=7, block_rows=block, query_rows=group).collect()
        got = [(x.query_id, x["rank"], x.vec_id, x.score) for x in found]
        assert len(got) == len(set(got)) and set(got) == brute_top(rows, lambda i: i % 10 == 0, 7)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_threshold_stops_early():
    r = np.random.default_rng(1)
    values = r.normal(0, 1, (4000, 3))
    values[17] = [50, 50, 50]
    order = np.argsort(values, axis=0, kind="stable")
    reads = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            reads.append(len(self))
            return np.asarray(self) @ other

    ids, scores = topk.threshold_top_k(np.arange(4000), values.view(Counted), -1, np.ones(3), order, 1)
    assert list(ids) == [17] and sum(reads) < 400


def test_many_templates_and_a_hot_file(spark):
    """Hundreds of templates over one index; a file that is a third of all licence words is no task of its own."""
    many = tuple(licences.Template(f"l{i}", f"{{license number w{i}}} of the authors of w{i % 7}") for i in range(300))
    rows = [(i, f"The license number W{i} of the authors of w{i % 7}. More.") for i in range(300)]
    rows += [(1000, "license number w5 " * 20_000), (1001, "number license w5 of the authors"), (1002, "license number w9 of the authors of w9")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    documents, finds = licences.scan(docs, many)
    named = finds.join(documents, "row").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"), F.max("share").alias("share"))
    found = {r["id"]: (r["label"], r["n"], r["share"]) for r in named.collect()}
    assert found == {**{i: (f"l{i}", 1, 1.0) for i in range(300)}, 1002: ("l9", 1, 7 / 8)}


def test_whole_notices(spark):
    (mit,) = [t for t in licences.NOTICES if t.label == "mit-text"]
    words = [w for w, _ in mit.words()]
    docs = spark.createDataFrame([(1, " ".join(words).upper()), (2, " ".join(words[:60])), (3, " ".join(words[:30] + ["x"] * 5 + words[35:]))], "doc_id bigint, text string")
    found = {r["doc_id"]: (r["labels"], round(r["score"], 3)) for r in licences.digest(*licences.scan(docs)).collect()}
    assert found == {1: ("mit,mit-text", 1.0), 2: ("mit", 1.0), 3: ("mit,mit-text", 1.0)}


def shard_rows(spark, docs, **kw):
    rows = kd_shards.shard(docs, **kw).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_op8_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    rows = queries.op8_kd_shards(spark, "/root/testdata/sf0.01").collect()
    sizes = Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        sizes[r.shard] += r.size
    assert len(rows) == len(texts) and set(sizes) == set(range(8))
    longest = max(len(t) for t in texts.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest


def plain_tree(rows, dimensions, levels):
    """Shard of each row by sorting and cutting every node; rows are (tie, size, d0, d1, ...)."""
    spans = [max(r[2 + i] for r in rows) - min(r[2 + i] for r in rows) for i in range(dimensions)]
    chosen, nodes = [], {0: list(range(len(rows)))}
    for _ in range(levels):
        cut, used = {}, {}
        for node, own in nodes.items():
            share = [(max(rows[k][2 + i] for k in own) - min(rows[k][2 + i] for k in own)) / max(1, spans[i]) if own else 0 for i in range(dimensions)]
            d = share.index(max(share))
            key = {k: (rows[k][2 + d] << 31) + rows[k][0] for k in own}
            goal, below = sum(rows[k][1] for k in own) / 2, 0
            left = set()
            for k in sorted(own, key=key.get):
                if below + rows[k][1] >= goal:
                    if below + rows[k][1] - goal < goal - below:
                        left.add(k)
                    break
                below += rows[k][1]
                left.add(k)
            used[node] = d
            cut[2 * node], cut[2 * node + 1] = [k for k in own if k in left], [k for k in own if k not in left]
        chosen.append(used)
        nodes = cut
    return {k: node for node, own in nodes.items() for k in own}, chosen


def test_tree_equals_sorting_and_cutting(spark, monkeypatch):
    """Every row's shard, and the dimension of every cut, against a recursive tree on the driver."""
    monkeypatch.setattr(kd_shards, "TOLERANCE", 0.0)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    meta = kd_shards.metadata(docs)
    tie = F.shiftrightunsigned(F.xxhash64("id", "row"), 33)
    rows = [tuple(r) for r in meta.select("id", tie, "size", "d0", "d1", "d2", "d3").collect()]
    assert len({r[1] for r in rows}) == len(rows)
    expected, chosen = plain_tree([r[1:] for r in rows], 4, 3)
    levels = kd_shards.tree(meta, 8, 4)
    assert [dict(enumerate(level.dimension)) for level in levels] == chosen
    assert {d for level in chosen for d in level.values()} >= {0, 2, 3}
    shards = {r["id"]: r["node"] for r in kd_shards._placed(meta, levels, 4).select("id", "node").collect()}
    assert shards == {rows[k][0]: node for k, node in expected.items()}


def test_dimensions_are_metadata(spark):
    """Language and source by how often they occur; texts and ids of no matter."""
    rows = [(i, f"text {i:04}", "en" if i % 4 else None, f"s{i % 10 % 7}", 9) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    meta = kd_shards.metadata(docs).join(docs.select(F.col("doc_id").alias("id"), "lang", "source"), "id").collect()
    assert len({r.d0 for r in meta}) == len({r.d1 for r in meta}) == 1
    by_lang, by_source = {(r.lang, r.d2) for r in meta}, {(r.source, r.d3) for r in meta}
    assert len(by_lang) == 2 and dict(by_lang)["en"] > dict(by_lang)[None]
    assert len(by_source) == 7 and min(dict(by_source)[f"s{i}"] for i in range(3)) > max(dict(by_source)[f"s{i}"] for i in range(3, 7))


def test_shard_cases(spark):
    rows = [(i % 50, "same text" if i % 3 == 0 else f"text {i}", "en" if i % 2 else None, "hot", i % 7 - 1) for i in range(3000)]
    rows += [(None, None, None, None, None), (9000, "", "de", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(7)
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("row", "part", "d0", "v0", "n0", "node", "size", "id", "shard", "key")])
    out = shard_rows(spark, docs, shards=8)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    assert len(out) == len(rows) and max(sizes.values()) < 1.02 * min(sizes.values())
    empty = [r for r in out if r.doc_id is None or r.doc_id == 9000]
    assert {(r.size, r.text_crc32) for r in empty} == {(1, 0)}
    assert len({r.shard for r in shard_rows(spark, docs, target_bytes=7000)}) == 8
    assert shard_rows(spark, docs.limit(0), shards=8) == []
    one = docs.filter("doc_id = 9000")
    assert [r.slot for r in shard_rows(spark, one, shards=8)] == [0]
    assert len(shard_rows(spark, one.unionAll(one).unionAll(one), shards=2)) == 3
    with pytest.raises(ValueError):
        kd_shards.shard(docs, shards=6)


def test_native_operators_have_no_python(spark, sf_dir):
    for name in ("op2_decontamination", "op3_licences", "op8_kd_shards"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name
