"""The text index and the kept statistics of the stored table."""

import random
import time

import pytest
from conftest import rows_read
from pyspark.sql import functions as F

from postloom.operators import analytics, listing, search
from postloom.operators.table import PostsTable
from postloom.operators.transform import transform_posts

WORDS = "spark data great lake river Mountain 100%_sure back\\slash ÄRGER straße 日本語 😊😊 İstanbul ΟΔΟΣ o'clock".split()


def as_of():
    return F.lit("2024-02-01").cast("timestamp_ntz")


def raw_posts(spark, start, count, rare=None):
    r = random.Random(start)
    rows = [(i, f"p{i}", "reddit", " ".join(r.choices(WORDS, k=4)) + (f" {rare}" if i == start else ""), str(i), f"u{i % 7}") for i in range(start, start + count)]
    rows += [(start + count, "null", "x", None, "1", None), (start + count + 1, "empty", "x", "", "1", "[deleted]")]
    return transform_posts(spark.createDataFrame(rows, "seq long, post_id string, platform string, post_text string, likes string, author string"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    table = PostsTable(spark, str(tmp_path_factory.mktemp("search") / "posts"), buckets=16, text_index=True)
    table.load(raw_posts(spark, 0, 200), as_of=as_of())
    table.load(raw_posts(spark, 150, 100, rare="zebrafish"), as_of=as_of())
    table.load(raw_posts(spark, 260, 50, rare="xylophone"), as_of=as_of())
    return table


TERMS = ["spark", "SPARK data", "gr__t", "r%t%l", "100%_s", "\\", "k\\s", "ärger", "STRASSE", "straße", "本語", "😊", "i̇stan", "οδος", "οδοσ", "of", "", "%", "___", "xylophone", "zebrafish", "o'c", "no such text", " "]


@pytest.mark.parametrize("term", TERMS)
def test_finds_what_a_scan_finds(table, term):
    keys = lambda df: sorted((r["post_id"], r["platform"], r["likes"]) for r in df.collect())
    assert keys(table.matching(term)) == keys(listing.matching(table.posts(), term))


def test_a_rare_term_reads_few_rows(spark, table):
    found = table.matching("xylophone")
    assert [r["post_id"] for r in found.collect()] == ["p260"]
    assert len(table.slots_of("xylophone")) <= 2
    everything = listing.matching(table.posts(), "xylophone")
    everything.collect()
    found = table.matching("xylophone")
    found.collect()
    assert rows_read(found) < rows_read(everything) / 4
    assert table.slots_of("no such text") == []
    assert table.slots_of("of") is None


def test_literal_parts(spark):
    assert search.literal_trigrams(spark, "ABcd%ef_GHI") == ["abc", "bcd", "ghi"]
    assert search.literal_trigrams(spark, "ab%cd") == []


def test_a_table_without_index_is_scanned(spark, tmp_path):
    table = PostsTable(spark, str(tmp_path / "posts"), buckets=2)
    table.load(raw_posts(spark, 0, 20, rare="xylophone"), as_of=as_of())
    assert table.slots_of("xylophone") is None
    assert table.search("xylophone").count() == 1
    PostsTable(spark, table.path, text_index=True).load(raw_posts(spark, 50, 20), as_of=as_of())
    assert table.slots_of("xylophone") is None  # the first load is not indexed


def rows(parts):
    return {name: sorted(map(tuple, df.collect()), key=repr) for name, df in parts.items()}


def test_statistics_follow_every_load(spark, tmp_path):
    table = PostsTable(spark, str(tmp_path / "posts"), buckets=4)
    assert rows(table.statistics())["counts"] == rows(analytics.stats(table.posts()))["counts"]
    for start in (0, 20, 10, 0, 45):
        table.load(raw_posts(spark, start, 30), as_of=as_of())
        kept = table.statistics()
        assert rows(kept) == rows(analytics.stats(table.posts()))
    assert all("/statistics/" in f for df in kept.values() for f in df.inputFiles())


def test_statistics_that_do_not_add_up_are_not_used(spark, tmp_path, monkeypatch):
    table = PostsTable(spark, str(tmp_path / "posts"), buckets=2)
    table.load(raw_posts(spark, 0, 10), as_of=as_of())
    with monkeypatch.context() as broken:
        broken.setattr(PostsTable, "_replace", lambda self, rows: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.load(raw_posts(spark, 50, 10), as_of=as_of())
    assert rows(table.statistics()) == rows(analytics.stats(table.posts()))
    other = PostsTable(spark, str(tmp_path / "ordered"), buckets=2)
    other.load(raw_posts(spark, 0, 10), load_no=0, as_of=as_of())
    assert rows(other.statistics()) == rows(analytics.stats(other.posts()))


def test_wildcards_do_not_search_again(spark):
    """Texts that hold many places of all parts but the last, which LIKE tried in every combination."""
    posts = spark.createDataFrame([(i, "a" * 2000 + ("b" if i == 7 else "")) for i in range(20)], "id long, post_text string")
    started = time.monotonic()
    for term in ("a%a%a%b", "%a_a%%b%", "_%_%A%B"):
        assert [r["id"] for r in listing.matching(posts, term).collect()] == [7]
    assert time.monotonic() - started < 30


@pytest.mark.parametrize("term", ["a\\Eb%c", "\\q_\\e%", "%", "_%", "___", "%%x%%y%%", "y%x", "(%[", "ΟΔΟΣ%😊", "😊_😊", "é%_"])
def test_wildcards_mean_what_like_means(spark, term):
    texts = ["A\\eB then C", "\\Q-\\E", "", None, "xy", "y\nx", "a(b[c", "ΟΔΟΣ 😊", "😊日😊", "É\n", "é", "ab", "abc"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, post_text string")
    like = posts.filter(F.col("post_text").ilike("%" + term.replace("\\", "\\\\") + "%"))
    assert sorted(listing.matching(posts, term).collect()) == sorted(like.collect())
