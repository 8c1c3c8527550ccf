"""Byte-level BPE encoding and decoding by monoid tree reduction.

Token sequences form a monoid: ``joined(encoding of x, encoding of y)`` is the
encoding of xy.  A text is cut by the tokenizer's pattern; each match is
encoded on its own, by halves: both halves recursively, then joined.  A join
encodes the bytes of a window round the seam anew and lets the window grow
until the tokens on both sides of its ends meet the window's outer tokens.
Two tokens *meet* if the bytes of the pair encode to just that pair.

Why that is enough: merges are done lowest rank first, leftmost first.  Take
a sequence whose neighbours all meet, and the first merge, in the run over its
whole bytes, that crosses a border between two of its tokens.  Until then no
merge has crossed any border, so the run restricted to those two tokens is the
run over the pair alone, and it would do that merge as well; but they meet.
So no merge crosses a border, and the sequence is the encoding.  Tokens
outside the window keep their neighbours, so only the two ends need a test.

Decoding is the map to byte strings and concatenates up the same tree.

``encode`` gives the ids themselves, ``decode`` the bytes of ids; the query
takes its digests from both.

Nulls: a null text counts as empty and has no ids; a null id array decodes to
no bytes; a null doc_id is kept.  Very long texts are cut into blocks where a
blank follows a non-blank, which no match spans, and a match of any length is
handled by the tree.  Repeated rows are encoded as often as they occur, an
empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, ship, small_batches, table

ship(__name__)

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bytes that are merged directly; longer strings are halved.
LEAF = 16
#: Windows up to this size are merged by scanning, longer ones with a heap.
SCANNED = 64
#: Characters of a text handled at once.
BLOCK = 1 << 20
#: Bytes that a worker remembers for matches met, in each of two generations; longer matches are not kept.
REMEMBERED, LONGEST = 64 << 20, 512
#: Rank of a pair that is no token.
NO_MERGE = 1 << 40
#: Pairs of tokens whose meeting is remembered.
PAIRS = 1 << 18
#: Ids decoded at once.
DECODED = 1 << 16


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Encodes byte strings by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.met: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """The encoding by merging: lowest rank first, leftmost first."""
        if len(data) > SCANNED:
            return self._merged_by_heap(data)
        rank = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        offers = [rank(data[i:i + 2], NO_MERGE) for i in range(len(data) - 1)]
        while offers and (best := min(offers)) != NO_MERGE:
            i = offers.index(best)
            whole = parts[i] = parts[i] + parts[i + 1]
            del parts[i + 1], offers[i]
            if i:
                offers[i - 1] = rank(parts[i - 1] + whole, NO_MERGE)
            if i < len(offers):
                offers[i] = rank(whole + parts[i + 1], NO_MERGE)
        return [self.ranks[p] for p in parts]

    def _merged_by_heap(self, data: bytes) -> list[int]:
        n, rank = len(data), self.ranks.get
        end = list(range(1, n + 1))     # of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        live = bytearray(b"\1" * n)

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(data[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        heap: list[tuple[int, int, int]] = []
        for i in range(n - 1):
            if (r := rank(data[i:i + 2])) is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not live[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of its parts was merged since
            live[end[i]] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(i)
            if i:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:end[i]]])
            i = end[i]
        return out

    def meet(self, a: int, b: int) -> bool:
        known = self.met.get((a, b))
        if known is None:
            if len(self.met) >= PAIRS:
                self.met.clear()
            known = self.met[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both; see above."""
        if not left or not right or self.meet(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[-a:] + right[:b])))
            wider_left = a < len(left) and not self.meet(left[-a - 1], window[0])
            wider_right = b < len(right) and not self.meet(window[-1], right[b])
            if not wider_left and not wider_right:
                return left[:-a] + window + right[b:]
            a = min(2 * a, len(left)) if wider_left else a
            b = min(2 * b, len(right)) if wider_right else b

    def tree(self, data: bytes, done: dict[bytes, list[int]]) -> list[int]:
        if len(data) <= LEAF:
            return self.merged(data)
        out = done.get(data)
        if out is None:  # equal halves, as in long runs, are encoded once
            half = 1 << (len(data) - 1).bit_length() - 1
            out = done[data] = self.joined(self.tree(data[:half], done), self.tree(data[half:], done))
        return out

    def match(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern; one that is a token as a whole is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tree(data, {})


class Matches(dict):
    """Match of the pattern -> its ids as little-endian 32-bit numbers.

    When the younger generation is full it becomes the older one; matches met again move back."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, match: str) -> bytes:
        ids = self.older.get(match)
        if ids is None:
            ids = array("I", self.encoder.match(match.encode())).tobytes()
        if len(match) <= LONGEST:
            self.held += 200 + 2 * len(match) + len(ids)
            if self.held > REMEMBERED:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[match] = ids
        return ids


def _ranges(chars: str) -> str:
    """A character class with just these characters."""
    points = sorted(map(ord, chars))
    out: list[list[int]] = []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out) + "]" if out else ""


@functools.cache
def strangers() -> dict[str, str]:
    """Per character property: the characters for which this machine's ``regex`` and the
    tokenizer's own library, which follow different versions of Unicode, disagree (as a class)."""
    import regex
    import tiktoken
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    out = {}
    for name in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("one", pat_str=name, mergeable_ranks=single, special_tokens={})
        known = set(bytes(theirs.encode_ordinary(every)).decode())
        here = set(regex.findall(name, every))
        assert known <= here, "regex knows fewer characters than the tokenizer's library"
        out[name] = _ranges("".join(here - known))
    return out


def patterns(pattern: str) -> tuple[str, str, str]:
    """(class of characters that need care, pattern for other texts, pattern for texts with such characters)."""
    careful, odd = pattern, ""
    for name, chars in strangers().items():
        if chars:
            odd += chars[1:-1]
            careful = careful.replace(f"[^\\s\\p{{L}}\\p{{N}}]", "\0")
            careful = careful.replace(name, f"(?:(?!{chars}){name})").replace("\0", "[^\\s\\p{L}\\p{N}]")
    if odd:
        careful = careful.replace("[^\\s\\p{L}\\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{odd}])")
    return (f"[{odd}]" if odd else r"(?!)"), pattern, careful


def _latin(text: str) -> bool:
    """Whether all characters lie below U+0100, where all versions of Unicode agree."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _blocks(text: str, seam) -> Iterator[str]:
    at = 0
    while len(text) - at > BLOCK:
        cut = seam.search(text, at + BLOCK)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encode(df: DataFrame, text: str = "text", id_col: str = "doc_id", ranks: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """(doc_id long, ids array<int>) for every row; ``ranks``: path of a rank file that workers can read."""
    small_batches(df.sparkSession)
    odd, plain, careful = patterns(pattern or default_pattern())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        known = Matches(Encoder(read_ranks(ranks or ranks_path())))
        needs_care, split, split_carefully = regex.compile(odd), regex.compile(plain), regex.compile(careful)
        seam = regex.compile(r"(?<=\S)\s")
        for batch in batches:
            coded, ends = [], [0]
            for body in batch.column(1):
                n = 0
                for block in _blocks(body.as_py() or "", seam):
                    cut = split_carefully if not _latin(block) and needs_care.search(block) else split
                    part = b"".join(map(known.__getitem__, cut.findall(block)))
                    coded.append(part)
                    n += len(part) // 4
                ends.append(ends[-1] + n)
            values = np.frombuffer(b"".join(coded), np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(values))],
                names=["doc_id", "ids"])

    return (df.select(df[f"`{id_col}`"].cast("long").alias("doc_id"), df[f"`{text}`"].cast("string").alias("text"))
            .mapInArrow(frugal(run), "doc_id long, ids array<int>"))


class Decoder:
    """Bytes of id sequences: a gather for each leaf, leaves concatenated up the tree."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def tree(self, ids: np.ndarray) -> bytes:
        if len(ids) > DECODED:
            half = len(ids) // 2
            return self.tree(ids[:half]) + self.tree(ids[half:])
        sizes = self.sizes[ids]
        at = np.cumsum(sizes)
        place = np.repeat(self.starts[ids] - at + sizes, sizes) + np.arange(at[-1] if len(at) else 0)
        return self.data[place].tobytes()


def decode(df: DataFrame, ids: str = "ids", id_col: str = "doc_id", ranks: str | None = None) -> DataFrame:
    """(doc_id long, ids array<int>, body binary): the bytes that the ids stand for."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks or ranks_path()))
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            bodies = [decoder.tree(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(bodies, pa.binary())],
                                             names=["doc_id", "ids", "body"])

    return (df.select(df[f"`{id_col}`"].cast("long").alias("doc_id"),
                      F.coalesce(df[f"`{ids}`"].cast("array<int>"), F.expr("cast(array() as array<int>)")).alias("ids"))
            .mapInArrow(frugal(run), "doc_id long, ids array<int>, body binary"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("body", 256).alias("decoded_sha256"))
