"""Token counts that follow edits: a segment tree of pre-tokens per document.

A leaf covers LEAF_PIECES consecutive pre-tokens and holds their characters and tokens; an
inner node holds the sums of its two children, the root those of the document. An edit finds
its leaf by descending over characters, goes CONTEXT characters back, encodes again from that
leaf's start, and stops at the first new pre-token that starts where an old leaf after the
edit started: from there on the pre-tokens are the old ones, as the pattern never looks back.
Only the leaves in between and the sums above them change.

The pattern must cover every character and look at most CONTEXT characters past a match.

Cases: a NULL or empty text has no leaves and no tokens; an edit with a NULL start is left
out, NULL removals are 0 and NULL insertions empty; places beyond the text are moved to its
end; edits of one document are applied in their order, each to the text the last one left;
NULL edits or none change nothing; repeated rows give repeated results; a NULL id is passed
through; an empty table gives no rows; only the named columns are read. Texts are encoded
whole, very long ones pre-token by pre-token.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.bpe import SHORT, Codec, codec

LEAF_PIECES = 32
LEAVES_AT_ONCE = 4096
CONTEXT = 4
EDITS = "array<struct<start:bigint,removed:bigint,inserted:string>>"


class Tree:
    """Sums of characters and tokens over leaves, as heaps: node i has children 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.width = 1
        while self.width < len(chars):
            self.width *= 2
        self.chars, self.tokens = self._heap(chars), self._heap(tokens)
        self.leaves = len(chars)

    def _heap(self, leaves: list[int]) -> list[int]:
        heap = [0] * self.width + leaves + [0] * (self.width - len(leaves))
        for node in range(self.width - 1, 0, -1):
            heap[node] = heap[2 * node] + heap[2 * node + 1]
        return heap

    def leaf_chars(self) -> list[int]:
        return self.chars[self.width : self.width + self.leaves]

    def leaf_tokens(self) -> list[int]:
        return self.tokens[self.width : self.width + self.leaves]

    def find(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character and the leaf's first character; the last leaf for the end."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] <= place:
                before += self.chars[node]
                node += 1
        leaf = min(node - self.width, max(0, self.leaves - 1))
        if leaf != node - self.width:  # past the end
            before = self.chars[1] - self.chars[self.width + leaf]
        return leaf, before

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.width + leaf
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2


def leaves_of(pieces: list[str], model: Codec) -> tuple[list[int], list[int]]:
    """Characters and tokens of each run of LEAF_PIECES pre-tokens."""
    if not pieces:
        return [], []
    known = model.known
    starts = np.arange(0, len(pieces), LEAF_PIECES)
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.fromiter([len(known.get(p) or model.piece_ids(p)) for p in pieces], np.int64, len(pieces))
    return np.add.reduceat(chars, starts).tolist(), np.add.reduceat(tokens, starts).tolist()


def build_tree(text: str, model: Codec) -> Tree:
    """The tree of a text; a long one is read LEAVES_AT_ONCE leaves at a time."""
    if len(text) <= SHORT:
        return Tree(*leaves_of(model.pattern.findall(text), model))
    chars: list[int] = []
    tokens: list[int] = []
    pieces = (m.group() for m in model.pattern.finditer(text))
    while part := list(islice(pieces, LEAF_PIECES * LEAVES_AT_ONCE)):
        more_chars, more_tokens = leaves_of(part, model)
        chars += more_chars
        tokens += more_tokens
    return Tree(chars, tokens)


def apply_edit(text: str, tree: Tree, model: Codec, start: int, removed: int, inserted: str) -> tuple[str, Tree, int]:
    """The new text, its tree, and how many pre-tokens were encoded."""
    start = min(max(0, start), len(text))
    removed = min(max(0, removed), len(text) - start)
    if not removed and not inserted:
        return text, tree, 0
    after = text[:start] + inserted + text[start + removed :]
    if not tree.leaves:
        fresh = build_tree(after, model)
        return after, fresh, sum(1 for _ in model.pattern.finditer(after))
    shift = len(inserted) - removed
    first, at = tree.find(max(0, start - CONTEXT))
    # The next old leaf boundary at or after the edit, in characters of the old text.
    last, boundary = first, at + tree.chars[tree.width + first]
    pieces: list[str] = []
    place = at
    for match in model.pattern.finditer(after, at):
        while last + 1 < tree.leaves and (boundary < start + removed or boundary + shift < place):
            last += 1
            boundary += tree.chars[tree.width + last]
        if place == boundary + shift and boundary >= start + removed and place > at:
            break
        pieces.append(match.group())
        place = match.end()
    else:
        last = tree.leaves - 1
    if len(pieces) > 2 * LEAF_PIECES * (last - first + 1):
        chars, tokens = leaves_of(pieces, model)
        old_chars, old_tokens = tree.leaf_chars(), tree.leaf_tokens()
        grown = Tree(old_chars[:first] + chars + old_chars[last + 1 :], old_tokens[:first] + tokens + old_tokens[last + 1 :])
        return after, grown, len(pieces)
    # The new pre-tokens share the leaves they replace evenly.
    share = -(-len(pieces) // (last - first + 1))
    for i in range(last - first + 1):
        own = pieces[i * share : (i + 1) * share]
        tree.set(first + i, sum(map(len, own)), sum(len(model.piece_ids(p)) for p in own))
    return after, tree, len(pieces)


def _edits(value: list[dict] | None) -> Iterator[tuple[int, int, str]]:
    for e in value or []:
        if e is not None and e["start"] is not None:
            yield e["start"], e["removed"] or 0, e["inserted"] or ""


TREE = "n_tokens bigint, leaf_chars array<int>, leaf_tokens array<int>"


def build(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, leaf_chars, leaf_tokens): the trees to store; inner sums follow from the leaves."""

    def run(batches):
        model = codec(path, pattern)
        for batch in batches:
            trees = [build_tree(t or "", model) for t in batch.column(1).to_pylist()]
            columns = [
                pa.array([t.tokens[1] for t in trees], pa.int64()),
                pa.array([t.leaf_chars() for t in trees], pa.list_(pa.int32())),
                pa.array([t.leaf_tokens() for t in trees], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "n_tokens", "leaf_chars", "leaf_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, {TREE}")


def edit(docs: DataFrame, path: str, pattern: str, edits: Column, id_col: str = "doc_id", text_col: str = "text", stored_trees: bool = False, texts: bool = False) -> DataFrame:
    """Apply each document's edits.

    ``edits`` is an array of (start, removed, inserted). With ``stored_trees`` the columns
    ``leaf_chars`` and ``leaf_tokens`` of :func:`build` are used, otherwise the trees are made
    first. Result: id, n_tokens_before, n_tokens, n_edits, n_encoded (pre-tokens encoded for
    the edits), leaf_chars, leaf_tokens, and the new text if asked for.
    """
    trees = [F.col(c) if stored_trees else F.lit(None).cast("array<int>").alias(c) for c in ("leaf_chars", "leaf_tokens")]
    taken = docs.select(F.col(id_col), F.col(text_col).alias("text"), edits.cast(EDITS).alias("edits"), *trees)
    names = [id_col, "n_tokens_before", "n_tokens", "n_edits", "n_encoded", "leaf_chars", "leaf_tokens", "text"]

    def run(batches):
        model = codec(path, pattern)
        kinds = (*[pa.int64()] * 4, *[pa.list_(pa.int32())] * 2, pa.string())
        for batch in batches:
            out = []
            for text, changes, chars, tokens in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                text = text or ""
                tree = build_tree(text, model) if chars is None or tokens is None else Tree(chars, tokens)
                before, done, encoded = tree.tokens[1], 0, 0
                for change in _edits(changes):
                    text, tree, n = apply_edit(text, tree, model, *change)
                    done, encoded = done + 1, encoded + n
                out.append((before, tree.tokens[1], done, encoded, tree.leaf_chars(), tree.leaf_tokens(), text if texts else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens_before bigint, n_tokens bigint, n_edits bigint, n_encoded bigint, leaf_chars array<int>, leaf_tokens array<int>, text string"
    found = taken.mapInArrow(run, schema)
    return found if texts else found.drop("text")
