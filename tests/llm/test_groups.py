"""Near-duplicates, components, decontamination and the pipeline against brute force."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from postloom.llm import decontam, minhash, queries
from postloom.llm.components import components


def shingles(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def groups(texts, n, percent):
    """Smallest reachable id of each id, by all pairs."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, id string, component string")


def test_near_duplicates_by_brute_force(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for base in range(5):
        words = [r.choice(vocabulary) for _ in range(r.choice([30, 60, 150]))]
        for _ in range(25):  # near copies, some of which only a third copy links
            copy = list(words)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts[len(texts)] = " ".join(copy)
    texts |= {900 + i: t for i, t in enumerate([None, "", " \n", "one", "ONE", "one two", "one two three four"])}
    rows = [(i, t, "x", "y") for i, t in texts.items()]
    for settings in (minhash.Settings(shingle=3, percent=85), minhash.Settings()):
        expected = groups(texts, settings.shingle, settings.percent)
        found = minhash.near_duplicates(documents(spark, rows), settings).collect()
        assert {x.id: (x.n_shingles, x.component) for x in found} == expected
        assert all(x.kept == (x.id == x.component) for x in found)


def test_near_duplicate_cases(spark):
    text = "a rather short text of ten words that is repeated"
    rows = [(5, text, "", ""), (5, text, "", ""), (2, text.upper(), "", ""), (None, text, "", ""), (7, None, "", "")]
    docs = documents(spark, rows)
    found = minhash.near_duplicates(docs).collect()
    assert sorted((str(x.id), str(x.component), x.kept) for x in found) == [
        ("2", "2", True), ("5", "2", False), ("5", "2", False), ("7", "7", True), ("None", "None", True)
    ]
    kept = minhash.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["2", "7"]  # the row without an id is a copy too
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.drop_duplicates(docs.limit(0)).count() == 0


def test_repeated_id_with_other_texts_is_compared_by_its_smallest_class(spark):
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(40))
    sketched = minhash.sketches(documents(spark, [(0, text, "", ""), (1, other, "", "")]), minhash.Settings()).collect()
    sets = {(text, other)[x.id]: bytes(x["class"]) for x in sketched}
    compared = min(sets, key=sets.get)
    near = [(3, text + " end", "", ""), (4, other + " end", "", "")]
    expected = {3: 1, 4: 4} if compared == text else {3: 3, 4: 1}
    for rows in ([text, other, None], [None, other, text], [other, "", text]):
        docs = documents(spark, [(1, t, "", "") for t in rows] + near).repartition(4)
        found = {x.id: x.component for x in minhash.near_duplicates(docs).collect()}
        assert found == {1: 1, **expected}
    # A copy with a smaller id takes one of the texts away: the id stands for the other.
    docs = documents(spark, [(0, compared, "", ""), (1, text, "", ""), (1, other, "", "")] + near)
    found = {(x.id, x.component) for x in minhash.near_duplicates(docs).collect()}
    assert found == {(0, 0), (1, 0), (1, 1), (3, 0 if compared == text else 1), (4, 1 if compared == text else 0)}


def test_duplicates_are_dropped_by_row(spark):
    text = "a rather short text of ten words that is repeated"
    other = "some quite different words that nobody else in here has"
    odd = spark.createDataFrame(
        [(1, text, "x"), (1, text, "x"), (1, other, "x"), (3, other, "x"), (None, "nobody has these words either", "x"), (4, None, "x"), (4, None, "x")],
        "doc_id bigint, text string, __row string",
    )
    kept = minhash.drop_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("1", text), ("1", other), ("4", "None"), ("4", "None"), ("None", "nobody has these words either")
    ]


def test_bayesian_bounds():
    assert minhash.fewest_matches(0, 0.8, 1e-6) == 0
    least = [minhash.fewest_matches(n, 0.8, 1e-6) for n in (32, 64, 128)]
    assert least == sorted(least) and 0 < least[0] < 32 * 0.8
    assert minhash.fewest_matches(128, 0.8, 1e-2) > least[2]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 340)]
    r = random.Random(1)
    r.shuffle(chain)
    edges = spark.createDataFrame([*chain, *star, (500, 500), (7, 300)], "a bigint, b bigint")
    found = {x.id: x.component for x in components(edges).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(300, 340))}
    assert components(edges.limit(0)).count() == 0


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def leaks(docs, items):
    """Best similarity of every document and item over all windows of the item's length."""
    out = {}
    for i, text in docs:
        w = words(text)
        for j, item in items:
            v = words(item)
            best = 0.0
            for start in range(1 - len(v), len(w)) if v and w else ():
                part = w[max(0, start) : start + len(v)]
                if len(part) >= min(5, len(v)):
                    a, b = bag(part) if len(v) >= 5 else Counter([tuple(part)]), bag(v)
                    same = sum((a & b).values())
                    best = max(best, same / (sum(a.values()) + sum(b.values()) - same))
            if 100 * best >= 80 - 1e-9:
                out[i, j] = round(best, 9)
    return out


def test_contamination_by_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, say(n)) for k, n in enumerate([14, 20, 36, 55, 59, 30, 12, 3])]
    items.append((8, say(3) * 8))  # repeats its own shingles
    docs = []
    for k, item in items:
        for cut in (0, 1, 2, 5):
            for change in (0, 1, 2):
                copy = item[cut:]
                for _ in range(change if copy else 0):
                    copy[r.randrange(len(copy))] = "changed"
                docs.append((len(docs), ", ".join([*say(r.randint(0, 30)), *copy, *say(r.randint(0, 30))]).upper()) if len(item) > cut else (len(docs), None))
    joined = [(k, " ".join(v)) for k, v in items]
    table = spark.createDataFrame([(i, t, "a", "b") for i, t in docs], "doc_id bigint, text string, item_id string, words string")
    benchmark = spark.createDataFrame([*joined, (90, None), (91, " .,"), joined[0]], "item_id bigint, text string")
    found = {(x.doc_id, x.item_id): round(x.similarity, 9) for x in decontam.contaminated(table, benchmark).collect()}
    expected = leaks(docs, joined)
    assert found == expected and len(expected) > 20


def test_contamination_in_another_order_by_brute_force(spark):
    """Rotated copies, and copies with words put in or left out, between other words."""
    r = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, say(n)) for k, n in enumerate([60, 60, 58, 45, 80, 25])]
    docs = []
    for _, item in items:
        for at in (len(item) // 2, len(item) // 3, 7):
            docs.append([*say(r.randint(0, 40)), *item[at:], *item[:at], *say(r.randint(0, 40))])
        for put, cut in ((1, 0), (0, 1), (1, 1), (3, 0)):
            copy = list(item)
            for _ in range(put):
                copy.insert(r.randrange(len(copy)), "put")
            for _ in range(cut):
                del copy[r.randrange(len(copy))]
            docs.append([*say(r.randint(0, 40)), *copy, *say(r.randint(0, 40))])
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    joined = [(k, " ".join(v)) for k, v in items]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(joined, "item_id bigint, text string")
    found = {(x.doc_id, x.item_id): (round(x.similarity, 9), x.n_windows) for x in decontam.contaminated(table, benchmark).collect()}
    expected = leaks(docs, joined)
    assert (0, 0) in expected  # its second half stands before its first half
    assert found == {k: (v, 1) for k, v in expected.items()}


def test_contamination_cases(spark):
    passage = "the quick brown fox jumps over the lazy dog again"
    docs = spark.createDataFrame(
        [(1, passage, "x"), (1, passage, "x"), (None, passage, "x"), (2, None, "x"), (3, "", "x"), (4, f"{passage}, {passage}", "x")],
        "doc_id bigint, text string, pos string",
    )
    benchmark = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    found = decontam.contaminated(docs, benchmark).collect()
    assert sorted((str(r.doc_id), r.start, r.n_windows) for r in found) == [("1", 0, 1), ("4", 0, 2), ("None", 0, 1)]
    left = decontam.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "3"]
    other = spark.createDataFrame([(1, "a clean text that shares its id"), (1, passage)], "doc_id bigint, text string")
    assert [r.text for r in decontam.drop_contaminated(other, benchmark).collect()] == ["a clean text that shares its id"]
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), benchmark).count() == 0


def test_contamination_by_a_very_long_item(spark):
    """An item of 20,000 words: the tables grow with it, not with its square."""
    r = random.Random(30)
    item = [f"w{r.randrange(5000)}" for _ in range(20_000)]
    copy = [*["before"] * 30, *item[:9000], *["other"] * 50, *item[9050:], *["after"] * 40]
    docs = spark.createDataFrame([(1, " ".join(copy)), (2, " ".join(item[:9000]))], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = decontam.contaminated(docs, benchmark).collect()
    a, b = bag(copy[30:20_030]), bag(item)
    same = sum((a & b).values())
    assert [(x.doc_id, x.start, x.n_windows) for x in found] == [(1, 30, 1)]
    assert found[0].similarity == pytest.approx(same / (sum(a.values()) + sum(b.values()) - same))
    keys = decontam.items_of(benchmark)
    shingles = decontam._all_sizes(keys.drop("item_id"), [5]).drop("words")
    places = decontam.places_of(docs, shingles, [5], "text")
    regions = decontam.regions_of(places, decontam.index_of(shingles, places, 80))
    assert decontam.events_of(docs, regions, [5], "text").count() < 6 * len(item)


def test_contamination_with_repeated_words_and_short_items(spark):
    """Runs of equal words that the copy lacks, and short items cut by the end of their text."""
    r = random.Random(21)
    say = lambda n, kind: [f"{kind}{r.randrange(10**6)}" for _ in range(n)]
    items, docs = [], []
    for k in range(12):
        before, after = say(93, "a"), say(93, "b")
        items.append((k, " ".join([*before, *["same"] * 18, *after])))
        docs.append((k, " ".join([*say(9, "c"), *before, *say(18, "d"), *after, *say(9, "e")])))
    for k in range(100, 350):
        item = say(9, "f")
        items.append((k, " ".join(item)))
        docs.append((k, " ".join([*say(9, "g"), *item[:8]])))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(x.doc_id, x.item_id): round(x.similarity, 9) for x in decontam.contaminated(table, benchmark).collect()}
    by_id = dict(items)
    expected = {}
    for d in docs:  # other items share no words
        expected |= leaks([d], [(d[0], by_id[d[0]])])
    assert found == expected and len(expected) == len(docs)


def test_fingerprint_blocks_miss_nothing_within_the_radius(spark):
    r = random.Random(3)
    prints = []
    for k in range(60):
        a, b = r.getrandbits(64), r.getrandbits(64)
        flips = r.sample(range(128), r.randint(0, 60))
        x, y = a, b
        for f in flips:
            x, y = (x ^ (1 << f), y) if f < 64 else (x, y ^ (1 << (f - 64)))
        signed = [v - (1 << 64) if v >> 63 else v for v in (a, b, x, y)]
        prints.append((k, len(flips), *signed))
    rows = spark.createDataFrame(prints, "item bigint, far int, a bigint, b bigint, x bigint, y bigint")
    windows = rows.selectExpr("item AS window", "item", "1L AS total", "x AS f0", "y AS f1")
    items = rows.selectExpr("item", "1L AS total", "a AS f0", "b AS f1")
    found = {x.window for x in decontam.within_radius(windows, items).collect()}
    assert found == {p[0] for p in prints if p[1] <= decontam.RADIUS}


def test_op6_whole_table(spark, sf_dir):
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op6_minhash(spark, sf_dir).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == groups(texts, 3, 85)


def test_op2_whole_table(spark, sf_dir):
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seeds = {s for _, t in items for s in bag(words(t))}
    near = [(i, t) for i, t in docs if seeds & set(bag(words(t)))]  # the others share no shingle
    found = {(x.doc_id, x.item_id): round(x.similarity, 9) for x in queries.op2_decontamination(spark, sf_dir).collect()}
    assert found == leaks(near, items)


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """Input and output of every stage over the whole table."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        after.cache().count()
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_stages(spark, sf_dir, staged):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "bpe"]
    for _, before, after in staged[:-1]:
        assert after.columns == columns
        assert not {x.doc_id for x in after.select("doc_id").collect()} - {x.doc_id for x in before.select("doc_id").collect()}
    _, before, after = staged[2]
    texts = {x.doc_id: x.text for x in before.collect()}
    expected = {i for i, (_, top) in groups(texts, 5, 80).items() if i == top}
    assert {x.doc_id for x in after.collect()} == expected
    _, before, after = staged[3]
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seeds = {s for _, t in items for s in bag(words(t))}
    rows = [(x.doc_id, x.text) for x in before.collect()]
    gone = {i for i, _ in leaks([(i, t) for i, t in rows if seeds & set(bag(words(t)))], items)}
    assert {x.doc_id for x in after.collect()} == {i for i, _ in rows} - gone


def test_pipeline_run_equals_its_stages(spark, sf_dir, staged):
    key = lambda rows: sorted(map(tuple, rows))
    assert key(corpus_pipeline.run(spark, sf_dir).collect()) == key(staged[-1][2].collect())
