"""Token counts that follow edits (operator 2).

A document keeps a segment tree: its leaves are runs of pre-tokens, every node
holds the characters and the tokens below it.  An edit re-encodes from the leaf
two characters before it - as far as the pre-token pattern looks ahead - to the
first leaf boundary behind it that the new scan meets again, writes that region
into one leaf and corrects the sums above the leaves it touched.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import map_texts, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-token pattern the vocabulary was made with
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How far a match may look beyond its end, with the character it stops at.
LOOK = 2
LEAF = 32
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 300_000

Counter = Callable[[str], int]


def counter(ranks: dict[bytes, int]) -> Counter:
    """Tokens of one pre-token, remembered within a bound."""
    encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    known: dict[str, int] = {}

    def count(piece: str) -> int:
        n = known.get(piece)
        if n is None:
            if len(known) >= REMEMBERED:
                known.clear()
            n = known[piece] = len(encoding.encode_ordinary(piece))
        return n

    return count


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Tree:
    """Heap-ordered sums: node k has children 2k and 2k + 1; leaf i is node ``width + i``."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.chars, self.tokens, self.width = chars, tokens, len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> Tree:
        width = 1
        while width < max(len(chars), 1):
            width *= 2
        pad = [0] * (width - len(chars))
        own = cls([0] * width + chars + pad, [0] * width + tokens + pad)
        for k in range(width - 1, 0, -1):
            own._sum(k)
        return own

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf that holds the character at ``place``, its first character); the last one beyond the end."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if place - start >= self.chars[k] and self.chars[k + 1]:
                start += self.chars[k]
                k += 1
        return k - self.width, start

    def replace(self, first: int, last: int, chars: int, tokens: int) -> None:
        """Leaf ``first`` takes over for leaves ``first`` .. ``last``; sums above them follow."""
        dirty = set()
        for i in range(first, last + 1):
            k = self.width + i
            self.chars[k], self.tokens[k] = (chars, tokens) if i == first else (0, 0)
            dirty.add(k // 2)
        while dirty - {0}:
            for k in dirty:
                if k:
                    self._sum(k)
            dirty = {k // 2 for k in dirty if k > 1}


_PIECES = regex.compile(PATTERN)


def build(text: str, count: Counter) -> Tree:
    """The tree of a whole text."""
    pieces = _PIECES.findall(text)
    chars, tokens = [], []
    for k in range(0, len(pieces), LEAF):
        own = pieces[k : k + LEAF]
        chars.append(sum(map(len, own)))
        tokens.append(sum(map(count, own)))
    return Tree.of_leaves(chars, tokens)


def edit(text: str, tree: Tree, start: int, end: int, put: str, count: Counter) -> tuple[str, int]:
    """Replace ``text[start:end]`` by ``put`` and correct ``tree``; the new text and the characters encoded again."""
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    new, moved = text[:start] + put + text[end:], len(put) - (end - start)
    first, at = tree.leaf_at(max(0, start - LOOK))
    # the leaf that ends behind the edit, then further ones until a boundary is met again
    last, begin = tree.leaf_at(max(end - 1, at))
    stop = begin + tree.chars[tree.width + last]
    place, tokens = at, 0
    while True:
        if place >= start + len(put) and place - moved >= end:
            while stop < place - moved and last + 1 < tree.width:
                last += 1
                stop += tree.chars[tree.width + last]
            if stop == place - moved:
                break
        if place >= len(new):
            last = tree.width - 1
            break
        piece = _PIECES.match(new, place)
        tokens += count(piece[0])
        place = piece.end()
    tree.replace(first, last, place - at, tokens)
    return new, place - at


def with_trees(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and what else it has) with ``node_chars``, ``node_tokens`` and ``n_tokens``.

    A null text has the tree of an empty one: one node, no tokens.
    """

    def factory():
        count = counter(ranks)

        def run(texts):
            trees = [build(t or "", count) for t in texts]
            return {"node_chars": [t.chars for t in trees], "node_tokens": [t.tokens for t in trees], "n_tokens": [t.tokens[1] for t in trees]}

        return run

    kept = docs.withColumn("tree_text", F.col("text"))
    return map_texts(kept, factory, "node_chars array<int>, node_tokens array<int>, n_tokens long", text="tree_text")


def recount(edited: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Rows of :func:`with_trees` with ``edits`` (``start``, ``end``, ``put``), applied to the text as it was.

    Edits must not overlap; they are applied from the last to the first.  Adds
    ``n_tokens_edited``, ``n_chars_edited``, ``n_chars_encoded`` (what was encoded
    again) and the corrected tree; null or no edits change nothing.
    """

    def factory():
        count = counter(ranks)

        def run(rows):
            out = {name: [] for name in ("n_tokens_edited", "n_chars_edited", "n_chars_encoded", "node_chars", "node_tokens")}
            for row in rows:
                text, tree, encoded = row["text"] or "", Tree(list(row["node_chars"]), list(row["node_tokens"])), 0
                for e in sorted(row["edits"] or [], key=lambda e: (e["start"], e["end"]), reverse=True):
                    text, again = edit(text, tree, e["start"], e["end"], e["put"] or "", count)
                    encoded += again
                for name, value in zip(out, (tree.tokens[1], len(text), encoded, tree.chars, tree.tokens)):
                    out[name].append(value)
            return out

        return run

    packed = edited.withColumn("packed", F.struct("text", "node_chars", "node_tokens", "edits")).drop("text", "node_chars", "node_tokens", "edits")
    made = "n_tokens_edited long, n_chars_edited long, n_chars_encoded long, node_chars array<int>, node_tokens array<int>"
    return map_texts(packed, factory, made, text="packed")


def sample_edits(text: Column) -> Column:
    """Three edits of a text: five characters replaced at a quarter, words put in at a half, twenty cut at three quarters."""
    n = F.length(F.coalesce(text, F.lit(""))).cast("int")
    one = lambda s, e, put: F.struct(s.cast("int").alias("start"), e.cast("int").alias("end"), F.lit(put).alias("put"))
    middle = F.floor(n / 2)
    long = F.array(one(F.floor(n / 4), F.floor(n / 4) + 5, "Edited 1 "), one(middle, middle, " put in: 42 words"), one(F.floor(n * 3 / 4), F.floor(n * 3 / 4) + 20, ""))
    return F.when(n >= 100, long).otherwise(F.array(one(middle, middle, " put in: 42 words")))


def count_tokens(docs: DataFrame, edits: Column | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row tokens of the whole text, and of the text after ``edits`` (none: as it is), without encoding it again.

    Null and empty texts have no tokens before the edits; null and repeated ids
    are rows like any other; no rows give no rows; other columns are not read.
    """
    ranks = read_ranks(vocabulary)
    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    kind = "array<struct<start:int,end:int,put:string>>"
    edited = with_trees(rows, ranks).withColumn("edits", (F.array() if edits is None else edits).cast(kind))
    return recount(edited, ranks).select("doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded")


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), sample_edits(F.col("text")))
