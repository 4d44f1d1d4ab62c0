"""Token counts that follow edits.

A document keeps a segment tree over its pre-tokens: leaves are runs of pre-tokens with their characters and token
counts, inner nodes hold sums. An edit replaces a range of characters. Only leaves that the edit touches are
re-encoded, with as much of their surroundings as pre-token boundaries can depend on; the sums above them are then
updated. Counting the edited text anew gives the same number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of a leaf.
LEAF = 32
#: The edits of the query: personal data and secrets give way to placeholders, as a scrubbing stage would have it.
EDITS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "[email]"),
    (r"\+?\d[\d ()-]{7,}\d", "[number]"),
    (r"AKIA[A-Z0-9]{16,}", "[key]"),
    (r"[0-9a-f]{24,}", "[hex]"),
)


class Counter:
    """Token counts of pre-tokens, kept for those seen before."""

    def __init__(self, vocabulary: str | None = None, most: int = 1 << 20):
        from sievemill.llm.packing import encoder
        import public_tokenizers

        self.encoding = encoder(vocabulary)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}
        self.most = most

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for p in set(parts).difference(known):
            known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in parts]


class Tree:
    """Segment tree over the leaves of one text. chars and tokens are heaps of sums: node i has children 2i and 2i + 1.

    encoded counts the characters that were pre-tokenised so far."""

    def __init__(self, text: str, counter: Counter):
        self.counter, self.encoded = counter, 0
        self.build(self.leaves_of(text))

    def leaves_of(self, text: str) -> list[tuple[str, int]]:
        parts = self.counter.split.findall(text)
        self.encoded += len(text)
        counts = self.counter.counts(parts)
        return [("".join(parts[i : i + LEAF]), sum(counts[i : i + LEAF])) for i in range(0, len(parts), LEAF)]

    def build(self, leaves: list[tuple[str, int]]) -> None:
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.leaf = [x for x, _ in leaves] + [""] * (self.width - len(leaves))
        self.used = max(1, len(leaves))
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        self.chars[self.width : self.width + len(leaves)] = [len(x) for x, _ in leaves]
        self.tokens[self.width : self.width + len(leaves)] = [n for _, n in leaves]
        level = self.width
        while level > 1:
            for a in (self.chars, self.tokens):
                a[level // 2 : level] = a[level : 2 * level : 2] + a[level + 1 : 2 * level : 2]
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def text(self) -> str:
        return "".join(self.leaf)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character at, and the character its text starts with."""
        node, start, at = 1, 0, max(0, min(at, int(self.chars[1]) - 1))
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return min(node - self.width, self.used - 1), start

    def update(self, leaf: int, text: str, tokens: int) -> None:
        self.leaf[leaf] = text
        node = self.width + leaf
        by = len(text) - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += by[0]
            self.tokens[node] += by[1]
            node //= 2

    def replace(self, start: int, end: int, new: str) -> None:
        """Characters start to end become new.

        The touched leaves are re-encoded with the leaf before. A pre-token can change only where the text from its
        start on changes within its reach: to the end of the pre-token and the character after. So splitting from a
        boundary before the edit gives the same boundaries again as soon as one behind the edit coincides with an old
        one; until then, leaves are taken in."""
        total = int(self.chars[1])
        start, end = max(0, min(start, total)), max(0, min(end, total))
        first, at = self.find(start)
        last, last_at = self.find(max(start, end - 1))
        if first:
            first -= 1
            at -= len(self.leaf[first])
        while True:
            if last < self.used - 1:
                last += 1
            stop = sum(len(x) for x in self.leaf[first : last + 1]) + at
            old = "".join(self.leaf[first : last + 1])
            text = old[: start - at] + new + old[end - at :]
            tail = self.leaf[last]
            edge = len(text) - len(tail)
            ahead = self.leaf[last + 1][:1] if last + 1 < self.used else ""
            parts = self.counter.split.findall(text + ahead)
            self.encoded += len(text)
            bounds = np.cumsum([len(p) for p in parts])
            # Sound where a boundary falls on the last leaf's start, and that leaf wasn't edited: it splits as it did before.
            if last == self.used - 1 or (end <= stop - len(tail) and edge in bounds and (not ahead or len(text) in bounds)):
                break
        if ahead:
            parts = parts[:-1] if len(parts[-1]) == 1 else [*parts[:-1], parts[-1][:-1]]
        counts = self.counter.counts(parts)
        if first == 0 and last == self.used - 1 or len(parts) > 8 * LEAF * (last - first + 1):
            self.build([(x, int(self.tokens[self.width + i])) for i, x in enumerate(self.leaf[:first])] + [("".join(parts[i : i + LEAF]), sum(counts[i : i + LEAF])) for i in range(0, len(parts), LEAF)] + [(self.leaf[i], int(self.tokens[self.width + i])) for i in range(last + 1, self.used)])
            return
        share = -(-len(parts) // (last - first + 1))
        for k, leaf in enumerate(range(first, last + 1)):
            own = slice(k * share, (k + 1) * share)
            self.update(leaf, "".join(parts[own]), sum(counts[own]))


def count_edited(df: DataFrame, edits: tuple[tuple[str, str], ...] = EDITS, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_chars, n_tokens: of the text, n_edits, n_chars_after, n_tokens_after: of the edited text, n_encoded:
    characters re-encoded for the edits) of each row of df (doc_id, text).

    edits: patterns and what their matches become, one after the other. Null text counts as empty. Repeated rows are
    counted alike; other columns are not read; an empty table gives an empty table."""
    names = ["doc_id", "n_chars", "n_tokens", "n_edits", "n_chars_after", "n_tokens_after", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        patterns = [(regex.compile(p), new) for p, new in edits]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                tree = Tree(text, counter)
                chars, tokens, tree.encoded, n = len(text), tree.total, 0, 0
                for pattern, new in patterns:
                    moved, found = 0, list(pattern.finditer(text))
                    for m in found:
                        tree.replace(m.start() + moved, m.end() + moved, new)
                        moved += len(new) - (m.end() - m.start())
                    if found:
                        text = pattern.sub(lambda _: new, text)
                        n += len(found)
                rows.append((doc_id, chars, tokens, n, len(text), tree.total, tree.encoded))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def op2_token_counts(spark, sf_dir):
    return count_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
