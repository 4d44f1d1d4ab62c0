"""Byte-level BPE by tree reduction, both ways.

Encodings form a monoid: enc(xy) follows from enc(x) and enc(y). A string is encoded by halves; where halves meet, a
window of tokens around the border is merged anew and grows, doubling, until the tokens at its edges come out as they
went in. That is enough. Merging picks the lowest rank, leftmost first, so what happens between two final tokens never
depends on what lies outside them: tokens in a row of an encoding are the encoding of their bytes, and a row of tokens is
an encoding as soon as every two neighbours are. An edge token that stays keeps its old neighbour outside, and those two
were neighbours in an encoding before.

A text is encoded by halves in the same way, cut anywhere. Its window grows on both sides to the next place where a space
follows another character that isn't white space: there a match of the pattern always starts, no match before reaches
over it, and no merge crosses matches, so all tokens outside stay as they are. Matches longer than a leaf are encoded by
halves of bytes, which may meet within a token. Pieces between such places repeat, so each task keeps the encodings that
it has made, up to a number of them.

Decoding concatenates the tokens' bytes up a tree.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import chunks

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Strings of so many bytes, and texts of so many characters, aren't halved any more.
LEAF, SPAN = 8, 2048
#: Encodings of pieces up to so many characters are kept, so many of them at most; more are made anew.
KEPT_CHARS, KEPT = 48, 1 << 19
#: Ids that a leaf of the decoding tree takes.
DECODED = 4096


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Token bytes to ids, from a file of base64 and rank a line."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encodes and decodes by ranks; pattern splits a text into the strings that are encoded by themselves."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        import public_tokenizers

        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.matches = regex.compile(pattern or public_tokenizers.PATTERN).findall
        #: Ids of pieces after a space that belongs to them; of other pieces.
        self.led: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        #: Ids of leaves and of windows of few tokens.
        self.leaves: dict[bytes, tuple[int, ...]] = {}
        self.windows: dict[tuple[int, ...], tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Direct merging: the pair of neighbours with the lowest rank, leftmost first, until none has a rank."""
        return self.merged_short(piece) if len(piece) <= 64 else self.merged_long(piece)

    def merged_short(self, piece: bytes) -> list[int]:
        """By a scan for each merge."""
        n, rank, none = len(piece), self.ranks.get, 1 << 62
        cuts = list(range(n + 1))
        pairs = [rank(piece[i : i + 2], none) for i in range(n - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = rank(piece[cuts[i - 1] : cuts[i + 1]], none)
        return [self.ranks[piece[a:b]] for a, b in itertools.pairwise(cuts)]

    def merged_long(self, piece: bytes) -> list[int]:
        """By a heap."""
        n, rank = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts there; 0: none does
        waiting = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            _, a, b = heapq.heappop(waiting)
            middle = end[a]
            if not middle or middle >= b or end[middle] != b:
                continue  # these parts have merged with others
            end[a], end[middle] = b, 0
            if b < n:
                before[b] = a
                if (r := rank(piece[a : end[b]])) is not None:
                    heapq.heappush(waiting, (r, a, end[b]))
            if a:
                c = before[a]
                if (r := rank(piece[c:b])) is not None:
                    heapq.heappush(waiting, (r, c, b))
        ids, a = [], 0
        while a < n:
            ids.append(self.ranks[piece[a : end[a]]])
            a = end[a]
        return ids

    def window(self, ids: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the tokens' bytes."""
        found = self.windows.get(ids)
        if found is None:
            found = tuple(self.merged(b"".join([self.bytes_of[i] for i in ids])))
            if len(ids) <= 4:
                if len(self.windows) >= KEPT:
                    self.windows.clear()
                self.windows[ids] = found
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of what left and right encode, one after the other."""
        i = j = 1
        while True:
            ids = self.window(left[-i:] + right[:j])
            moved_left = i < len(left) and ids[0] != left[-i]
            moved_right = j < len(right) and ids[-1] != right[j - 1]
            if not moved_left and not moved_right:
                return left[:-i] + ids + right[j:]
            i, j = i << moved_left, j << moved_right

    def reduced(self, piece: bytes) -> tuple[int, ...]:
        """The encoding of a string by halves."""
        if len(piece) > LEAF:
            half = len(piece) // 2
            return self.join(self.reduced(piece[:half]), self.reduced(piece[half:]))
        found = self.leaves.get(piece)
        if found is None:
            if len(self.leaves) >= KEPT:
                self.leaves.clear()
            found = self.leaves[piece] = tuple(self.merged(piece))
        return found

    def match(self, text: str) -> bytes:
        """Ids of a match of the pattern, 4 bytes each. A match that is a token as a whole is that token."""
        raw = text.encode()
        whole = self.ranks.get(raw)
        return array("i", self.reduced(raw) if whole is None else (whole,)).tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of a text without borders, 4 bytes each."""
        if text.isascii() and text.removeprefix(" ").isalpha():
            return self.match(text)
        matches = self.matches(text)
        if len(matches) == 1:
            return self.match(text)
        out = []
        for m in matches:
            known, key = (self.led, m[1:]) if m[0] == " " and m != " " else (self.bare, m)
            out.append(known.get(key) or self.kept(known, key, m, self.match))
        return b"".join(out)

    def kept(self, known: dict[str, bytes], key: str, text: str, make) -> bytes:
        found = known.get(key)
        if found is None:
            found = make(text)
            if len(key) <= KEPT_CHARS:
                known[key] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text, 4 bytes each."""
        return self.spans(text, 0, len(text))

    def spans(self, text: str, start: int, stop: int) -> bytes:
        """Ids of the text from start to stop, as if it were all, by halves."""
        if stop - start <= SPAN:
            return self.pieces(text[start:stop])
        middle = (start + stop) // 2
        a = text.rfind(" ", start, middle)
        while a > start and text[a - 1].isspace():
            a = text.rfind(" ", start, a)
        b = text.find(" ", middle + 1, stop)
        while b >= 0 and text[b - 1].isspace():
            b = text.find(" ", b + 1, stop)
        a, b = max(a, start), b if b >= 0 else stop
        if 2 * (b - a) > stop - start:  # the window is most of the text
            return self.pieces(text[start:stop])
        left, right = self.spans(text, start, middle), self.spans(text, middle, stop)
        return left[: len(left) - len(self.pieces(text[a:middle]))] + self.pieces(text[a:b]) + right[len(self.pieces(text[middle:b])) :]

    def pieces(self, text: str) -> bytes:
        """Ids of a text, 4 bytes each, by its pieces."""
        first, *others = text.split(" ")
        for known in (self.bare, self.led):
            if len(known) >= KEPT:
                known.clear()
        missing = set(others).difference(known)
        if first[-1:].isspace() or not first and others or any(not p or p[-1].isspace() for p in missing):
            return self.uneven(text)  # the start, or white space before a space, is no border
        long = {}
        for p in missing:
            made = self.piece(" " + p)
            (known if len(p) <= KEPT_CHARS else long)[p] = made
        ids = [long[p] if p in long else known[p] for p in others] if long else map(known.__getitem__, others)
        return self.kept(self.bare, first, first, self.piece) + b"".join(ids)

    def uneven(self, text: str) -> bytes:
        """The same where some spaces follow white space."""
        out, (held, *others) = [], text.split(" ")
        for p in others:
            if held and not held[-1].isspace():
                out.append(held)
                held = ""
            held += " " + p
        return b"".join([self.kept(self.led, p[1:], p, self.piece) if p[:1] == " " and p[1:2].strip() else self.kept(self.bare, p, p, self.piece) for p in (*out, held)])

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, by halves; ids outside the vocabulary are an error."""
        if len(ids) > DECODED:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        except KeyError as e:
            raise ValueError(f"no token has the id {e}") from None


def encode(df: DataFrame, identity: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(identity, ids array<int>), a row for each row of df: each match of the pattern encoded by itself, no special tokens.

    vocabulary: a file of ranks that every executor has. Null and empty texts have no ids. Repeated rows are encoded alike;
    other columns aren't read, whatever their names; an empty table gives an empty table. A text is encoded whole in its
    task, in time n log n of its longest match at most, whatever its length; memory is some 10 times the text's."""
    kind_of = dict(df.dtypes)[identity]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(read_ranks(vocabulary))
        for batch in batches:
            column = batch.column(1)
            for a, b in chunks([len(x.as_buffer() or b"") if x.is_valid else 0 for x in column]):
                found = [codec.encode(x.as_py() or "") for x in column.slice(a, b - a)]
                starts = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=starts[1:])
                ids = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], [identity, "ids"])

    return df.select(identity, text).mapInArrow(run, f"`{identity}` {kind_of}, ids array<int>")


def decode(df: DataFrame, identity: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(identity, ids, decoded binary), a row for each row of df.

    Null and empty ids give no bytes; an id that no token has, null among them, is an error. Bytes aren't checked to be
    UTF-8, since ids may end within a character. Repeated rows, other columns, empty tables and long rows as in encode."""
    kind_of = dict(df.dtypes)[identity]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(read_ranks(vocabulary))
        for batch in batches:
            column = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_pylist()
            for a, b in chunks([4 * n for n in sizes]):
                part, at, made = column.slice(a, b - a), 0, []
                held = part.flatten()
                if held.null_count:
                    raise ValueError("no token has the id null")
                held = held.to_numpy()
                for n in sizes[a:b]:
                    made.append(codec.decode(held[at : at + n].tolist()))
                    at += n
                made = pa.array(made, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), part, made], [identity, "ids", "decoded"])

    return df.select(identity, F.col(ids).cast("array<int>").alias("ids")).mapInArrow(run, f"`{identity}` {kind_of}, ids array<int>, decoded binary")


def op11_byte_bpe(spark, sf_dir):
    found = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
