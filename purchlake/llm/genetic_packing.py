"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids (plus a closing id) and are cut into pieces of at
most ``capacity`` tokens; only longer documents are cut, and their first piece
is the shorter one.  Full pieces are sequences by themselves.  The other
pieces are dealt at random into blocks of bounded size (a block is one packing
problem, whatever the corpus), and each block is solved on several islands:

* an individual is an assignment of pieces to bins;
* crossover injects whole well-filled bins of one parent into another, drops
  the bins that would now hold a piece twice and puts their displaced pieces
  back best-fit, longest first;
* after each round an island's elite migrates to the next island of the block.

The fittest individual of all islands gives the block's sequences.  An island
stops early once it holds as few bins as the block's tokens need.

Nulls: a null text counts as empty and packs its closing id alone; a null id is kept.
Repeated rows are packed as often as they occur.  Very long texts are read
whole.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, ship, shuffle_partitions, small_batches, stored, table

ship(__name__)

CAPACITY, CLOSING_ID = 2048, 0
TOKENIZER = "byte_bpe_50k.json"
#: Pieces of a block, about.
BLOCK = 4096
ISLANDS, POPULATION, ROUNDS, GENERATIONS = 3, 6, 3, 4
#: Share of a parent's bins that a crossover injects.
INJECTED = 0.3

BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: The tokenizer never joins a non-blank to a blank after it, so these parts can be encoded alone.
PARTS = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
#: The tokenizer's own cut of a text, as its file states it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEAM = re.compile(f"(?<=[^{BLANK}])[{BLANK}]")
#: Bytes of parts and ids that a worker remembers in each of two generations, about; longer parts are not kept.
REMEMBERED, LONGEST = 32 << 20, 256
#: Characters of a text handled at once, and of new parts encoded at once.
BLOCK_CHARS, ENCODED = 1 << 20, 1 << 16


def by_rank(path: str):
    """The tokenizer's merges as ranks, run by a faster library; None if its file is not of that kind.

    The file lists merges by priority, each making the next id.  Running them lowest id first gives the
    same ids: a pair that makes a token by another split than the listed one would have to stand as
    [u, v] in the run over the token's own bytes, which has but one state of two parts, the listed split."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    # byte-level files write a byte as a printable character: itself, or the next one from U+0100 on
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in shown} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    single = [t for t in vocabulary if len(t) == 1]
    ranks = {bytes(byte[c] for c in t): vocabulary[t] for t in [*single, *(a + b for a, b in merges)]}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Ids:
    """Ids of texts as little-endian 32-bit numbers.

    A text in Latin-1 without the tokenizer's own signs is encoded whole by the ranks.  Others go by their parts:
    new parts are strung together and encoded in one call; as no id crosses from a
    non-blank to a blank after it, the ids fall apart again where the parts meet.
    Parts beyond Latin-1, where versions of Unicode may differ, and parts with one of the
    tokenizer's own signs go to the tokenizer itself.  When the younger generation of
    known parts is full it becomes the older one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = by_rank(path)
        vocabulary = self.tokenizer.get_vocab()  # byte-level: one character of a token is one byte
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        signs = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.sign = re.compile("|".join(map(re.escape, signs)) or "(?!)")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def alone(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def together(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that start with a blank and end with a non-blank."""
        text = "".join(parts)
        if self.ranked is None or self.sign.search(text):
            return [self.alone(p) for p in parts]
        ids = np.array(self.ranked.encode_ordinary(text), np.uint32)
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in parts])
        cuts = np.searchsorted(ends, wanted)
        coded, cuts = ids.tobytes(), (4 * (cuts + 1)).tolist()
        return [coded[x:y] for x, y in zip([0, *cuts], cuts)]

    def _keep(self, part: str, ids: bytes) -> None:
        self.known[part] = ids
        self.held += 200 + 2 * len(part) + len(ids)

    def learn(self, parts: set[str]) -> None:
        """Make every part of up to LONGEST characters known."""
        if self.held > REMEMBERED:
            self.older, self.known, self.held = self.known, {}, 0
        joined: list[str] = []
        size = 0
        for part in parts:
            if part in self.known or len(part) > LONGEST:
                continue
            ids = self.older.get(part)
            if ids is not None:
                self._keep(part, ids)
            elif part[0] not in BLANK or part[-1] in BLANK or not _latin(part):
                self._keep(part, self.alone(part))
            else:
                joined.append(part)
                size += len(part)
                if size > ENCODED:
                    for p, ids in zip(joined, self.together(joined)):
                        self._keep(p, ids)
                    joined, size = [], 0
        if joined:
            for p, ids in zip(joined, self.together(joined)):
                self._keep(p, ids)

    def by_parts(self, texts: list[str]) -> list[bytes]:
        split = [PARTS.findall(t) for t in texts]
        self.learn(set().union(*split))
        known = self.known
        return [b"".join([known[p] if len(p) <= LONGEST else self.alone(p) for p in parts]) for parts in split]

    def of(self, texts: list[str]) -> list[bytes]:
        whole = [self.ranked is not None and _latin(t) and not self.sign.search(t) for t in texts]
        rest = iter(self.by_parts([t for t, w in zip(texts, whole) if not w]))
        return [self.ranked.encode_to_numpy(t, disallowed_special=()).tobytes() if w else next(rest)
                for t, w in zip(texts, whole)]


def _latin(text: str) -> bool:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return True


def _groups(texts: Iterator[str]) -> Iterator[tuple[list[str], bool]]:
    """(texts, whether the last one ends here): texts of about a block together, a longer text by
    blocks that start where a blank follows a non-blank."""
    group: list[str] = []
    size = 0
    for text in texts:
        at = 0
        while len(text) - at > BLOCK_CHARS and (seam := SEAM.search(text, at + BLOCK_CHARS)):
            yield [*group, text[at:seam.start()]], False
            group, size, at = [], 0, seam.start()
        group.append(text[at:] if at else text)
        size += len(group[-1])
        if size > BLOCK_CHARS:
            yield group, True
            group, size = [], 0
    if group:
        yield group, True


def coded_texts(ids: Ids, texts: Iterator[str]) -> Iterator[bytes]:
    """The ids of each text."""
    head: list[bytes] = []
    for group, ended in _groups(texts):
        coded = ids.of(group)
        for k, part in enumerate(coded):
            head.append(part)
            if ended or k + 1 < len(coded):
                yield b"".join(head)
                head = []


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(df: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, text: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """The pieces of every row; ``tokenizer``: path of a tokenizer file that workers can read."""
    small_batches(df.sparkSession)
    closing = array("I", [CLOSING_ID]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(tokenizer or tokenizer_path())
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            texts = (body.as_py() or "" for body in batch.column(1))
            for doc, coded in zip(batch.column(0).to_pylist(), coded_texts(ids, texts)):
                coded += closing
                n = len(coded) // 4
                start, no = 0, 0
                while start < n:
                    end = start + ((n - start) % capacity or capacity)
                    for c, v in zip(cols, (doc, no, start, end - start, zlib.crc32(coded[4 * start:4 * end]))):
                        c.append(v)
                    start, no = end, no + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=[f.split()[0] for f in PIECES.split(", ")])

    return df.select(df[f"`{id_col}`"].cast("long").alias("doc_id"), df[f"`{text}`"].cast("string").alias("text")).mapInArrow(frugal(cut), PIECES)


class BestFit:
    """Open bins by the room they have left; finds the fullest bin that still takes a piece."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if a bin with room r is open

    def put(self, bin_no: int, room: int) -> None:
        self.at[room].append(bin_no)
        self.rooms |= 1 << room

    def place(self, length: int, fresh: int) -> int:
        """The bin that takes the piece; ``fresh`` is the number for a new one."""
        above = self.rooms >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            bin_no = self.at[room].pop()
            if not self.at[room]:
                self.rooms ^= 1 << room
        else:
            room, bin_no = self.capacity, fresh
        self.put(bin_no, room - length)
        return bin_no


def renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Mean squared fill: of packings with equally many bins, uneven ones leave more to gain."""
    return float(np.mean((np.bincount(bins, lengths) / capacity) ** 2))


def best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    open_bins, bins, n = BestFit(capacity), np.empty(len(lengths), np.int32), 0
    for i in order.tolist():
        bins[i] = b = open_bins.place(int(lengths[i]), n)
        n += b == n
    return bins


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``a`` with whole well-filled bins of ``b``."""
    fill = np.bincount(b, lengths) / capacity
    # a random draw that prefers full bins
    chosen = np.zeros(len(fill), np.bool_)
    chosen[np.argsort(rng.random(len(fill)) ** (1 / np.maximum(fill, 1e-6) ** 8))[-max(1, int(INJECTED * len(fill))):]] = True
    injected = chosen[b]
    broken = np.zeros(a.max() + 1, np.bool_)
    broken[a[injected]] = True
    child = np.where(injected, b + len(broken), a)
    displaced = np.flatnonzero(broken[a] & ~injected)
    total = np.bincount(child[~(broken[a] & ~injected)], lengths[~(broken[a] & ~injected)],
                        minlength=len(broken) + len(fill)).astype(np.int64)
    open_bins = BestFit(capacity)
    for bin_no in np.flatnonzero((total > 0) & (total < capacity)).tolist():
        open_bins.put(bin_no, capacity - int(total[bin_no]))
    n = len(total)
    for i in displaced[np.argsort(-lengths[displaced], kind="stable")].tolist():
        child[i] = got = open_bins.place(int(lengths[i]), n)
        n += got == n
    return renumber(child)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """Some generations of one island; the result is sorted, fittest first."""
    least = -(-int(lengths.sum()) // capacity)
    longest_first = np.argsort(-lengths, kind="stable")
    while len(population) < POPULATION:
        if population and population[0].max(initial=-1) + 1 <= least:
            break  # nothing to gain
        noise = 1 + 0.2 * rng.random(len(lengths)) * bool(population)
        order = np.argsort(-lengths * noise, kind="stable") if population else longest_first
        population.append(best_fit(lengths, order, capacity))
    rank = lambda x: (x.max(initial=-1), -fitness(x, lengths, capacity))
    population.sort(key=rank)
    for _ in range(generations):
        if len(population) < 2 or population[0].max() + 1 <= least:
            break
        children = []
        for _ in range(POPULATION // 2):
            i, j = sorted(rng.choice(len(population), 2, replace=False).tolist())
            children += [crossover(population[i], population[j], lengths, capacity, rng),
                         crossover(population[j], population[i], lengths, capacity, rng)]
        population = sorted([*population, *children], key=rank)[:POPULATION]
    return population


STATE = "block long, island int, lengths array<int>, population array<binary>"


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (columns of ``pieces``) with sequence_id and offset."""
    spark = parts.sparkSession
    n_parts = shuffle_partitions(spark)
    rows = stored(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = rows.where(F.col("length") >= capacity).select(
        *parts.columns, (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = rows.where(F.col("length") < capacity)
    n_blocks = max(1, -(-short.count() // BLOCK))
    # a block has BLOCK rows on average, so its arrays are bounded
    blocks = stored(short.groupBy(F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block"))
                    .agg(F.sort_array(F.collect_list(F.struct("row", *parts.columns))).alias("members")), "blocks")

    def islands(round_no: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                grown = []
                for block, island, lengths, population in zip(batch.block, batch.island, batch.lengths, batch.population):
                    rng = np.random.default_rng([block, island, round_no])
                    found = evolve(lengths, [np.frombuffer(p, np.int32) for p in population], capacity, GENERATIONS, rng)
                    grown.append([p.astype(np.int32).tobytes() for p in found])
                yield pd.DataFrame({"block": batch.block, "island": batch.island, "lengths": batch.lengths, "population": grown})
        return run

    state = (blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                           F.col("members.length").cast("array<int>").alias("lengths"), F.array().cast("array<binary>").alias("population")))
    for r in range(ROUNDS):
        state = state.repartition(n_parts, "block", "island").mapInPandas(frugal(islands(r)), STATE)
        if r + 1 < ROUNDS:
            # each island also gets the elite of the one before it
            state = (state.groupBy("block").agg(F.first("lengths").alias("lengths"), F.sort_array(
                        F.collect_list(F.struct("island", "population"))).alias("all"))
                     .select("block", "lengths", F.posexplode("all").alias("at", "one"), "all")
                     .select("block", "one.island", "lengths", F.concat(
                         F.slice(F.element_at("all", F.pmod(F.col("at") - 1, F.size("all")).cast("int") + 1)["population"], 1, 1),
                         F.col("one.population")).alias("population")))

    def elect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sequence and offset of each member, out of the fittest individual."""
        for batch in batches:
            out = []
            for lengths, candidates in zip(batch.lengths, batch.candidates):
                best = min((np.frombuffer(c, np.int32) for c in candidates),
                           key=lambda x: (x.max(), -fitness(x, lengths, capacity)))
                order = np.argsort(best, kind="stable")
                before = np.cumsum(lengths[order], dtype=np.int64) - lengths[order]
                first = np.searchsorted(best[order], best[order])
                offset = np.empty(len(best), np.int64)
                offset[order] = before - before[first]
                out.append((best.tolist(), offset.tolist()))
            yield pd.DataFrame({"block": batch.block, "bins": [o[0] for o in out], "offsets": [o[1] for o in out]})

    winners = (state.groupBy("block").agg(F.first("lengths").alias("lengths"),
                                          F.collect_list(F.element_at("population", 1)).alias("candidates"))
               .mapInPandas(frugal(elect), "block long, bins array<long>, offsets array<long>"))
    solved = (blocks.join(winners, "block")
              .select("block", F.explode(F.arrays_zip("members", "bins", "offsets")).alias("x"))
              .select(*[F.col(f"x.members.{c}").alias(c) for c in parts.columns],
                      ((F.col("block") * (1 << 31) + F.col("x.bins")) * 2 + 1).alias("sequence_id"),
                      F.col("x.offsets").alias("offset")))
    return full.unionByName(solved)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
