"""Best-fit packing of token sequences by length patterns.

Only the histogram of lengths decides who shares a sequence with whom. A pattern is a set of at most three
lengths that fill a sequence exactly. How often each pattern repeats is fitted to the histogram by non-negative
least squares and rounded; what the patterns leave over goes, length by length from the longest, where it
leaves the least room. The histogram has at most ``capacity`` rows, whatever the corpus, so this plan is made
on the driver. It is a list of slots: documents of one length, from one rank to another, lie in
sequences that are counted on from a first one. Documents are ranked within their length by counters of the
tasks that cut them and meet the slots by binary search; no length is ever gathered in one place.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import settle
from .common import arrow_runs, modest_batches

END = 2  # closes every document
# A fixed value: the public pattern that splits a text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class PackConfig:
    """``short_weight`` is what a misfit at a length of at most half a sequence costs; 1 for longer ones.
    ``fit_rounds`` and ``tolerance`` (a pattern's pull, in pieces of a usual length) bound the fit's time; a fit
    that ends early only leaves more over. ``shares`` of the fitted repeats are tried and the one with the
    fewest sequences holds: what is held back keeps short pieces for rooms that patterns cannot fill."""

    capacity: int = 1024
    short_weight: float = 0.03
    fit_rounds: int = 15
    tolerance: float = 0.05
    shares: tuple[float, ...] = (1.0, 0.8, 0.6, 0.45, 0.3, 0.15)


# --- the plan ----------------------------------------------------------------------


def length_patterns(capacity: int) -> np.ndarray:
    """All sets of one, two or three lengths that add up to ``capacity``, longest first, 0 where there is none."""
    made = [(capacity, 0, 0)] + [(capacity - b, b, 0) for b in range(1, capacity // 2 + 1)]
    rows = [np.array(made, np.int64)]
    for c in range(1, capacity // 3 + 1):
        b = np.arange(c, (capacity - c) // 2 + 1)
        rows.append(np.column_stack([capacity - c - b, b, np.full(len(b), c)]))
    return np.concatenate(rows)


def fit_repeats(histogram: np.ndarray, patterns: np.ndarray, config: PackConfig) -> np.ndarray:
    """Repeat counts (real, not negative) whose lengths come nearest to ``histogram`` by weighted least squares.

    An active set method: patterns that would lower the misfit most, of lengths of their own, join
    the fitted ones; the least squares of those are solved, and what would turn negative leaves.
    """
    size = len(histogram)
    weight = np.where(np.arange(size) * 2 > config.capacity, 1.0, config.short_weight)
    weight[0] = 0
    x = np.zeros(len(patterns))
    member = np.zeros(len(patterns), bool)
    usable = ((histogram[patterns] > 0) | (patterns == 0)).all(1)

    def misfit() -> np.ndarray:
        held = np.zeros(size)
        used = np.flatnonzero(x)
        for column in range(3):
            np.add.at(held, patterns[used, column], x[used])
        return histogram - held

    def solve(chosen: np.ndarray) -> np.ndarray:
        a = np.zeros((size, len(chosen)))
        for column in range(3):
            np.add.at(a, (patterns[chosen, column], np.arange(len(chosen))), 1.0)
        a[0] = 0
        scaled = a * weight[:, None]
        gram = a.T @ scaled
        gram[np.diag_indices_from(gram)] += 1e-9
        return np.linalg.solve(gram, scaled.T @ histogram)

    floor = config.tolerance * float(np.median(histogram[histogram > 0])) if histogram.any() else 0.0
    for _ in range(config.fit_rounds):
        pull = (weight * misfit())[patterns].sum(1)
        pull[member | ~usable] = 0
        order = np.argsort(-pull, kind="stable")[:4096]
        taken, joined = np.zeros(size, bool), []
        for p in order[pull[order] > floor]:
            lengths = patterns[p][patterns[p] > 0]
            if not taken[lengths].any():
                taken[lengths] = True
                joined.append(p)
        if not joined:
            break
        member[joined] = True
        while True:
            chosen = np.flatnonzero(member)
            want = solve(chosen)
            if (want > 0).all():
                x[:] = 0
                x[chosen] = want
                break
            now = x[chosen]
            falling = want <= 0
            step = (now[falling] / np.maximum(now[falling] - want[falling], 1e-300)).min()
            now = now + step * (want - now)
            now[falling & (now <= 1e-9 * max(1.0, now.max()))] = 0
            x[chosen] = np.maximum(now, 0)
            member[chosen[x[chosen] <= 0]] = False
            x[~member] = 0
            if not member.any():
                break
    return x


def _slots(left: np.ndarray, patterns: np.ndarray, repeats: np.ndarray, capacity: int) -> tuple[int, list[tuple]]:
    """(sequences, slots) when patterns repeat as often as ``repeats`` and the histogram allow and the rest
    goes, from the longest, into the smallest room that takes it. Sequences that are alike move as one group."""
    left = left.copy()
    placed = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    groups: list[tuple[int, int, int, int]] = []  # free room, first sequence, sequences, used room
    sequences = 0

    def put(length: int, per: int, first: int, count: int, offset: int) -> None:
        slots.append((length, int(placed[length]), per, first, offset))
        placed[length] += per * count
        left[length] -= per * count

    for p in np.flatnonzero(repeats):
        per = Counter(int(l) for l in patterns[p] if l)
        count = min([int(repeats[p])] + [int(left[l]) // n for l, n in per.items()])
        offset = 0
        for length, n in per.items() if count else ():
            put(length, n, sequences, count, offset)
            offset += n * length
        sequences += count

    for length in range(capacity, 0, -1):
        while left[length]:
            at = bisect_left(groups, (length,))
            if at < len(groups):
                room, first, count, used = groups.pop(at)
            else:
                room, first, count, used = capacity, sequences, -1, 0
            per = min(room // length, int(left[length]))
            full = int(left[length]) // per
            filled = full if count < 0 else min(count, full)
            if count < 0:
                sequences += filled
            elif count > filled:
                insort(groups, (room, first + filled, count - filled, used))
            put(length, per, first, filled, used)
            if room > per * length:
                insort(groups, (room - per * length, first, filled, used + per * length))
    return sequences, slots


def plan(histogram: dict[int, int], config: PackConfig = PackConfig()) -> dict[str, np.ndarray]:
    """Slots for ``histogram`` (length: number of pieces), sorted by length and first rank.

    Columns: length, rank (the first it holds), per (pieces a sequence), sequence (the first), offset.
    Rank r of the length lies in sequence + (r - rank) // per at offset + (r - rank) % per * length.
    """
    capacity = config.capacity
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns = length_patterns(capacity)
    fitted = fit_repeats(left.astype(float), patterns, config)
    tried = [_slots(left, patterns, np.rint(fitted * share).astype(np.int64), capacity) for share in config.shares]
    _, slots = min(tried, key=lambda t: t[0])
    names = ("length", "rank", "per", "sequence", "offset")
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(names)}


def places(slots: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by length and rank within the length."""
    wide = np.int64(1) << 48
    at = np.searchsorted(slots["length"] * wide + slots["rank"], length * wide + rank, "right") - 1
    inside = rank - slots["rank"][at]
    per = slots["per"][at]
    return slots["sequence"][at] + inside // per, slots["offset"][at] + inside % per * length


# --- tokens ------------------------------------------------------------------------


def load_vocabulary(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file; merges go by id, as the format lists them."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    special = {t["content"] for t in model["added_tokens"]}
    return {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}


class Tokeniser:
    """Ids of whole texts, equal to those of the vocabulary's own library without special tokens.

    The merges run in a faster library with the same pattern and the merge order of the file. Texts
    with a long run of white space or without any would tax its pattern; the vocabulary's own takes those.
    """

    def __init__(self, path: str, ranks: dict[bytes, int]):
        import re

        import tiktoken

        self.path, self.own = path, None
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.odd = re.compile(r"\s{2000}|\S{20000}").search

    def ids(self, text: str) -> np.ndarray:
        if not self.odd(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        if self.own is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.own = Tokenizer.from_file(self.path)
            self.own.encode_special_tokens = True
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces_of(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces of a document: whole sequences, but the first takes what is over."""
    first = (len(ids) - 1) % capacity + 1
    yield 0, ids[:first]
    for start in range(first, len(ids), capacity):
        yield start, ids[start:start + capacity]


PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, task int, inside bigint"


def cut(docs: DataFrame, config: PackConfig, path: str, key: str, text: str) -> DataFrame:
    """One row per piece, with the task that cut it and its number among that task's pieces of the length."""
    ranks = load_vocabulary(path)
    capacity = config.capacity

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokeniser = Tokeniser(path, ranks)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for part, texts in arrow_runs(batch, "text"):
                out: list[tuple] = []
                for name, body in zip(part.column(0).to_pylist(), texts):
                    whole = np.append(tokeniser.ids(body), np.uint32(END))
                    for number, (start, ids) in enumerate(pieces_of(whole, capacity)):
                        n = len(ids)
                        out.append((name, number, start, n, zlib.crc32(ids.astype("<u4").tobytes()), task, int(seen[n])))
                        seen[n] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "inside"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    modest_batches(docs.sparkSession)
    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, PIECES)


def pack(docs: DataFrame, config: PackConfig = PackConfig(), path: str | None = None, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the closing id, so a null or empty text is one piece of one id. Only documents
    longer than a sequence are cut. Repeated rows are documents of their own, as are rows with a null id. Other
    columns take no part. An empty table has no pieces. Which of equally long pieces goes where depends on the
    tasks that cut them; each piece has one place, and sequences have no gaps.
    """
    cut_pieces = settle(cut(docs, config, path or default_vocabulary(), key, text), "pack-pieces")
    counts = settle(cut_pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "pack-counts")
    # At most ``capacity`` rows come to the driver, one per length.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(histogram, config)
    before = F.sum("n").over(W.partitionBy("length").orderBy("task")) - F.col("n")
    ranked = cut_pieces.join(counts.select("task", "length", before.alias("before")), ["task", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).alias("rank"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(i).to_numpy().astype(np.int64) for i in (3, 5))
            sequence, offset = places(slots, length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(length), batch.column(4), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op12_packing(docs: DataFrame, config: PackConfig = PackConfig()) -> DataFrame:
    """The contract's columns: every document in sequences of at most 1024 ids."""
    return pack(docs, config)
