"""Merkle manifests, personal data and fill-in-middle against plain versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from postloom.llm import fim, merkle, pii, queries
from postloom.llm.store import table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifest ---


def plain_leaf(row, lowered=False):
    text = row["text"]
    if lowered and text is not None:
        text = re.sub("[A-Z]+", lambda m: m.group().lower(), text)
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_tree(nodes):
    """Levels of a tree, one list each."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def plain_steps(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def plain_manifest(rows):
    """Every row's result, as a sorted list."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees.append(plain_tree([plain_leaf(r) for r in by_lang[lang]]))
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for place, (lang, levels) in enumerate(zip(langs, trees)):
        for at, row in enumerate(by_lang[lang]):
            steps = plain_steps(levels, at) + plain_steps(top, place)
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            node = plain_leaf(row, lowered=tampered)
            for left, right in steps:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in steps))
            out.append((row["doc_id"], plain_leaf(row), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(df):
    manifest = merkle.build(df, queries.LEAF, group="lang", shown=queries.shown_leaf())
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.verify(manifest).select(columns).collect()), key=repr)


def test_manifest_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    expected = plain_manifest([r.asDict() for r in docs.collect()])
    found = sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, sf_dir).collect()), key=repr)
    assert found == expected
    assert {r[6] for r in found} == {True, False}


def test_manifest_of_trees_of_all_sizes(spark):
    """Trees of one row up to several superblocks, with repeated rows, NULLs and empty texts."""
    r = random.Random(5)
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "e": 513, "Z": 1100, None: 3, "é": 2, "": 1}
    rows = [(r.randrange(5000), f"Text {r.randrange(300)}", lang, "s", i) for lang, size in sizes.items() for i in range(size)]
    rows += [(7, "Same", "d", "s", 1)] * 700  # equal rows
    rows += [(None, None, "e", None, None), (None, "", "e", "x", 0), (8, "x" * 200_000, "a", "s", 3)]
    df = spark.createDataFrame(rows, DOCS)
    expected = plain_manifest([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], row)) for row in rows])
    assert manifest_rows(df) == expected


@pytest.mark.parametrize("rows", [[], [(1, "A", "x", None, 1)], [(1, "A", "x", None, 1), (2, "B", "y", None, 1)]])
def test_small_manifests(spark, rows):
    expected = plain_manifest([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], row)) for row in rows])
    assert manifest_rows(spark.createDataFrame(rows, DOCS)) == expected


def test_manifest_ignores_other_columns(spark):
    rows = [(i, f"T{i}", "x", "s", i) for i in range(10)]
    df = spark.createDataFrame(rows, DOCS)
    wide = df.select("*", *[F.lit(1).alias(c) for c in ("tree", "digest", "pos", "size", "_row", "_part", "block", "id", "shown")])
    assert manifest_rows(wide) == manifest_rows(df)


def test_proofs_verify_on_their_own(spark):
    """Each returned proof folds its leaf to the root; a changed leaf does not."""
    df = spark.createDataFrame([(i, f"T{i}", "xy"[i % 2], "s", i) for i in range(30)], DOCS)
    for r in merkle.verify(merkle.build(df, queries.LEAF, group="lang"), with_proofs=True).collect():
        assert merkle.fold(r["leaf"], r["lefts"], r["rights"]) == r["root"] == r["folded_root"]
        assert merkle.fold(sha("other"), r["lefts"], r["rights"]) != r["root"]


# --- personal data ---

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(11)
    parts = ["a", "b.c", "@", ".", "-", " ", "+", "1", "22", "256", "255", "007", "(", ")", "4539578763621486", "x@y.z", "1.2.3.4", "%", "é", "\n", "+1 555 123 4567"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert [tuple(s) for s in pii.spans(text)] == plain_spans(text), text


def test_personal_data_of_the_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = queries.op12_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    total = 0
    for r in rows:
        base = plain_spans(texts[r["doc_id"]])
        names = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert r["base_sha256"] == sha(",".join(names))
        assert set(names) <= set(r["spans"].split(","))
        total += len(base)
    assert total > 0


# A text, its kind and the passage that must be found in it.
DISGUISED = [
    ("write john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
    ("write JOHN [AT] EXAMPLE [DOT] COM.", "email", "JOHN [AT] EXAMPLE [DOT] COM"),
    ("john at example dot com", "email", "john at example dot com"),
    ("john dot doe{at}mail{dot}example{dot}org!", "email", "john dot doe{at}mail{dot}example{dot}org"),
    ("user.34 at mail7.example.com", "email", "user.34 at mail7.example.com"),
    ("juan arroba ejemplo punto es", "email", "juan arroba ejemplo punto es"),
    ("see jоhn@exаmple.com there", "email", "jоhn@exаmple.com"),
    ("ｊｏｈｎ＠ｘ．ｃｏｍ", "email", "ｊｏｈｎ＠ｘ．ｃｏｍ"),
    ("jo​hn@exam​ple.com,", "email", "jo​hn@exam​ple.com"),
    ("é 192 dot 168 dot 1 dot 1", "ip", "192 dot 168 dot 1 dot 1"),
    ("at 10[.]0[.]0[.]1 now", "ip", "10[.]0[.]0[.]1"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("card ٤539578763621486 ok", "card", "٤539578763621486"),
    ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
    ("call +1 five five five 0123 4567", "phone", "+1 five five five 0123 4567"),
    ("call +49 drei null fünf 1234567!", "phone", "+49 drei null fünf 1234567"),
]


@pytest.mark.parametrize("text,kind,passage", DISGUISED)
def test_disguised(text, kind, passage):
    at = text.index(passage)
    assert pii.Span(pii.KINDS.index(kind), at, at + len(passage)) in pii.added_spans(text, pii.spans(text))


@pytest.mark.parametrize(
    "text",
    [
        "look at this point in time", "meet me at example.com", "see @foo.bar and @ home", "one two three go",
        "chapter 5 at dot example", "they are at home. The dot com age", "2 plus 2 is 4", "İstanbul at 5 dot 6",
        "cinq six sept huit", "the (dot) and the (at) sign", "", " ", "@", "a@", "​" * 5, "а" * 30,
    ],
)
def test_clean_texts_get_no_spans(text):
    assert pii.spans(text) == [] and pii.added_spans(text, []) == []


def test_maps_lead_back():
    """A span of an edited text is the span that was edited, for random edits."""
    r = random.Random(2)
    for _ in range(2000):
        text = "".join(r.choice("abcdef") for _ in range(20))
        cuts = sorted(r.sample(range(21), 6))
        edits = [(a, b, r.choice(["", "XY", "Z"])) for a, b in zip(cuts[::2], cuts[1::2])]
        mapped = pii.Mapped(text, edits)
        expected = text
        for a, b, new in reversed(edits):
            expected = expected[:a] + new + expected[b:]
        assert mapped.text == expected
        # Source span of each character, edited ones standing for their whole passage.
        at, source = 0, []
        for a, b, new in edits:
            source += [(i, i + 1) for i in range(at, a)] + [(a, b)] * len(new)
            at = b
        source += [(i, i + 1) for i in range(at, len(text))]
        for start in range(len(expected)):
            for end in range(start + 1, len(expected) + 1):
                assert mapped.back(start, end) == (source[start][0], source[end - 1][1])


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1", "a@", "@b.c", "one ", " at a dot", "(at)", "dot ", "a dot ", "1 ", "​", "a.", "plus "])
def test_long_texts_take_linear_time(unit):
    text = unit * (300_000 // len(unit)) + "@"
    pii.added_spans(text, pii.spans(text))


def test_personal_data_cases(spark):
    rows = [(1, None), (1, "x@y.z"), (None, "x@y.z"), (2, ""), (3, "a (at) b (dot) c"), (3, "a (at) b (dot) c"), (4, "q" * 200_000 + " x@y.z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit(1).alias("spans"), F.lit(2).alias("kind"))
    found = sorted(((r["doc_id"], r["n_email"], r["n_added"], r["spans"]) for r in pii.digests(df).collect()), key=repr)
    assert found == sorted(
        [
            (1, 0, 0, ""), (1, 1, 0, "email:0:5"), (None, 1, 0, "email:0:5"), (2, 0, 0, ""), (3, 0, 1, "email:0:16"),
            (3, 0, 1, "email:0:16"), (4, 1, 0, "email:200001:200006"),
        ],
        key=repr,
    )
    spans = [(r["doc_id"], r["kind"], r["added"], r["source"]) for r in pii.find(df).collect()]
    assert (3, "email", True, "a (at) b (dot) c") in spans and (4, "email", False, "x@y.z") in spans and len(spans) == 5
    assert pii.digests(df.limit(0)).collect() == [] and pii.find(df.limit(0)).collect() == []


# --- fill-in-middle ---


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    n, h = len(units), sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def fim_cases():
    r = random.Random(4)
    parts = ["a", "é\n", "\n", "日本🙂", "<", "S>", "<P", "\r\n", "word ", " "]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 30)))) for i in range(300)]
    return rows + [(None, "a\nb\nc"), (5, None), (6, ""), (7, "x<M>y\nz"), (8, "line\n" * 50_000), (8, "line\n" * 50_000), (9, "\n")]


def test_rearranged_texts(spark):
    rows = fim_cases()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit(0).alias("n"), F.lit(0).alias("form"), F.lit(0).alias("output"))
    made = fim.transform(df)
    expected = sorted(((i, *plain_fim(i, t)) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == expected
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    back = sorted((tuple(r) for r in fim.restore(made).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in rows), key=repr)
    hashed = sorted((tuple(r) for r in fim.digests(df).collect()), key=repr)
    assert hashed == sorted(((*e[:5], sha(e[5]), sha(t or ""), True) for e, t in ((((i, *plain_fim(i, t))), t) for i, t in rows)), key=repr)


def test_no_documents_to_rearrange(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.digests(df).collect() == fim.transform(df).collect() == fim.restore(fim.transform(df)).collect() == []


def test_descriptors_alone_change():
    data = b"one\ntwo\nthree"
    whole = fim.PieceTable([data, b"|"], [fim.Piece(0, 0, len(data))])
    cut = whole.cut([0, 4, 4, 13])
    assert [bytes(p) for p in cut.stream()] == [b"", b"one\n", b"", b"two\nthree", b""]
    assert cut.buffers[0] is data and cut.data() == data
    order = [3, 1, 4, 0, 2]
    assert cut.arrange(order).data() == b"two\nthreeone\n"
    assert cut.arrange(order).arrange(fim.inverse(order)).pieces == cut.pieces
    with pytest.raises(ValueError):
        whole.cut([14])


def test_damaged_output_is_refused():
    with pytest.raises(ValueError):
        fim.restored(b"<P>a<M>b", "psm", fim.Settings())
    with pytest.raises(ValueError):
        fim.restored(b"x<P>a<S>b<M>c", "psm", fim.Settings())


def test_rate_and_forms():
    none = fim.Settings(rate=0)
    assert {fim.arranged(i, b"a\nb\n", none).form for i in range(50)} == {"plain"}
    assert {fim.arranged(i, b"a\nb\n", fim.Settings(spm=100)).form for i in range(50)} == {"spm"}
    own = fim.Settings(prefix="[[pre]]", suffix="[[suf]]", middle="[[mid]]")
    for i in range(20):
        cut = fim.arranged(i, b"a <P>\nb\nc", own)
        assert fim.restored(cut.output.data(), cut.form, own).data() == b"a <P>\nb\nc"
