"""Best-fit packing of documents into fixed sequences by bin completion.

Documents are tokenised and ended with one end token; only documents longer than a
sequence are cut. What is left to pack is a histogram of piece lengths, which has at most
``capacity`` entries whatever the size of the corpus. Branch and bound over that
histogram finds the patterns: around the largest remaining length it enumerates, by
rising waste, the undominated fillings of the residual space, of any number of pieces,
prunes branches whose waste cannot beat the incumbent, and starts from the best-fit
decreasing solution as incumbent. Spark then ranks the pieces of each length and joins
them to their places in the patterns.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import materialise, table

CAPACITY = 2048
END_ID = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, row_id long"
SLICE_BYTES = 4 << 20
ROWS_A_BUCKET = 1_000_000
_WORDS: dict[str, Tokeniser] = {}  # of each vocabulary: this worker's tokeniser with its cache
#: Texts in which a word may begin elsewhere than at a space before a non-space.
_OTHER_SPACES = r"  | $| [\t\n\v\f\r]|[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokeniser:
    """Token ids of whole texts, with a bounded cache from stretches between spaces to ids.

    A space that a non-space follows always begins a new word for a byte-level vocabulary,
    so stretches are encoded on their own, distinct ones once. They go through a faster
    encoder with the ranks of the same vocabulary file, to the same ids. Texts with other
    white space after a space, or with a control string, are encoded whole by the
    vocabulary's own library; so is everything if the file's ids aren't in order of merging.
    """

    def __init__(self, vocabulary: str, limit: int = 400_000):
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.controls = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(vocabulary, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte = _byte_of_letter()
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ordered = all(model["vocab"][token] == 256 + k for k, token in enumerate(merged))
        ranks = {bytes(byte[c] for c in token): rank for token, rank in model["vocab"].items() if token not in self.controls}
        self.ranked = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if self.ordered else None
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True
        self.cache: dict[str, bytes] = {}
        self.limit = limit

    def whole(self, texts: list[str]) -> Iterator[bytes]:
        """Ids as little-endian 32-bit words; few texts at a time, for what the library keeps of each is large."""
        for i in range(0, len(texts), 256):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 256], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def spaced(self, stretches: list[str]) -> Iterator[bytes]:
        """Ids of stretches that begin with their only space, many in one call: only first tokens begin with a space."""
        for i in range(0, len(stretches), 2000):
            ids = np.array(self.ranked.encode_ordinary("".join(stretches[i : i + 2000])), "<u4")
            edges = (np.append(np.flatnonzero(self.begins[ids]), len(ids)) * 4).tolist()
            data = ids.tobytes()
            yield from (data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True))

    def cached(self, stretches: list[str]) -> list[bytes]:
        cache = self.cache
        new = [x for x in stretches if x not in cache]
        if len(cache) + len(new) > self.limit:
            cache.clear()
            new = stretches
        cache.update(zip(new, self.spaced(new), strict=True))
        return [cache[x] for x in stretches]

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, each text ended with ``end_id``, and the number of ids of each."""
        odd = pc.match_substring_regex(texts, _OTHER_SPACES).to_numpy(zero_copy_only=False)
        for control in self.controls:
            odd |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        if not self.ordered:
            odd[:] = True
        regular = pc.if_else(pa.array(odd), "", texts)
        parts = pc.split_pattern(regular, " ")
        flat = parts.flatten().dictionary_encode()
        code = flat.indices.to_numpy().astype(np.int64)
        offsets = parts.offsets.to_numpy().astype(np.int64)
        # the first stretch of a text has no space before it; of an odd text it is the whole text
        firsts = offsets[:-1]
        distinct = flat.dictionary.to_pylist()
        alone = [distinct[c] for c in code[firsts].tolist()]
        is_later = np.ones(len(code), bool)
        is_later[firsts] = False
        used, code[is_later] = np.unique(code[is_later], return_inverse=True)
        ids = self.cached([" " + distinct[c] for c in used.tolist()])
        code[firsts] = len(ids) + np.arange(len(firsts))
        ids += [np.array(self.ranked.encode_ordinary(x) if x else [], "<u4").tobytes() for x in alone]
        rows = np.flatnonzero(odd)
        for row, encoded in zip(rows.tolist(), self.whole(texts.take(pa.array(rows)).to_pylist()), strict=True):
            ids[len(used) + row] = encoded
        ids.append(int(end_id).to_bytes(4, "little"))
        every = np.full(len(code) + len(firsts), len(ids) - 1, np.int64)
        is_end = np.zeros(len(every), bool)
        is_end[offsets[1:] + np.arange(len(firsts))] = True
        every[~is_end] = code
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lengths) - lengths
        n = lengths[every]
        upto = np.cumsum(n)
        out = np.frombuffer(b"".join(ids), "<u4")[np.repeat(starts[every] - upto + n, n) + np.arange(int(n.sum()))]
        return out, np.diff(upto[is_end], prepend=0)


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes of text, or one row."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        yield start, end
        start = end


def _tokeniser(vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokeniser = _WORDS.get(vocabulary)
        if tokeniser is None:
            tokeniser = _WORDS[vocabulary] = Tokeniser(vocabulary)
        for batch in batches:
            texts = pc.fill_null(batch["text"].cast(pa.large_string()), "")
            for first, after in _slices(texts, SLICE_BYTES):
                ids, lengths = tokeniser.ids(texts.slice(first, after - first), end_id)
                rows, at = [], 0
                for row, total in enumerate(lengths.tolist(), first):
                    start, piece = 0, 0
                    while start < total:
                        # the first piece takes the remainder, so that all others are full
                        length = min(capacity, total) if start or total % capacity == 0 else total % capacity
                        rows.append((row, piece, start, length, zlib.crc32(ids[at + start : at + start + length])))
                        start, piece = start + length, piece + 1
                    at += total
                row, *columns = zip(*rows, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(row)), *map(pa.array, columns, kinds), batch["row_id"].take(pa.array(row))], ["doc_id", "piece", "start", "length", "ids_crc32", "row_id"])

    return run


def pieces_of(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row_id"))
    return rows.mapInArrow(_tokeniser(vocabulary, capacity, end_id), PIECE_SCHEMA)


@dataclass(frozen=True)
class Pattern:
    """Lengths that share one sequence, largest first, and how many sequences repeat it."""

    lengths: tuple[int, ...]
    times: int


def fillings(counts: list[int], room: int, slack: int, spend: Callable[[], None] = lambda: None) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``room`` by rising waste, up to a waste of ``slack``.

    Lazy, without a limit on their number or on the pieces of one. A filling is dominated
    if a set of its pieces can be exchanged for one larger left-out piece (or one as large
    as several): what that piece frees elsewhere takes the set in. What a left-out piece
    dominates is cut off as soon as it is left out. ``spend`` is called at every step.
    """
    lengths = [x for x in range(min(room, len(counts) - 1), 0, -1) if counts[x]]
    full = (1 << room + 1) - 1
    reach = [1]  # sums that the smallest lengths make, as bits
    for x in reversed(lengths):
        sums, left, step = reach[-1], min(counts[x], room // x), 1
        while left:
            step = min(step, left)
            sums |= sums << x * step & full
            left, step = left - step, step * 2
        reach.append(sums)
    reach.reverse()

    def exact(i: int, rest: int, waste: int, single: int, several: int, equal: int, below: int) -> Iterator[tuple[int, ...]]:
        """Fillings of ``rest`` from lengths[i:]. ``single``, ``several``: sums of one chosen piece, and of more;
        ``below``: sums that a left-out piece beats within the waste, ``equal``: these and the piece's own length."""
        spend()
        if not rest:
            yield ()
            return
        start = bisect.bisect_left(lengths, -rest, key=lambda x: -x)
        for k in range(i, start):  # too large for the rest, so left out
            equal, below = _beats(lengths[k], waste, equal, below)
        i = max(i, start)
        while i < len(lengths) and reach[i] >> rest & 1:
            x = lengths[i]
            more = min(counts[x], rest // x)
            for n in range(more, -1, -1):
                if n < counts[x]:  # pieces of this length are left out from here on
                    equal, below = _beats(x, waste, equal, below)
                if n == 0:
                    break
                ones, sums = single, several
                for _ in range(n):
                    ones, sums = ones | 1 << x, sums | (ones | sums) << x
                left = rest - n * x
                if reach[i + 1] >> left & 1 and not (ones & below or sums & equal or left and (1 | ones | sums) << left & equal):
                    for others in exact(i + 1, left, waste, ones, sums, equal, below):
                        yield (x,) * n + others
            i += 1
            if (1 | single | several) << rest & equal:
                return

    for waste in range(min(room, slack) + 1):
        if reach[0] >> room - waste & 1:
            yield from exact(0, room - waste, waste, 0, 0, 0, 0)


def _beats(piece: int, waste: int, equal: int, below: int) -> tuple[int, int]:
    lower = (1 << waste) - 1 << piece >> waste
    return equal | lower | 1 << piece, below | lower


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over the histogram, equal bins filled together."""
    bins: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}

    def add(contents: tuple[int, ...], times: int) -> None:
        if contents not in bins:
            by_room.setdefault(capacity - sum(contents), []).append(contents)
        bins[contents] = bins.get(contents, 0) + times

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            rooms = [r for r in by_room if r >= length and by_room[r]]
            if not rooms:
                each = capacity // length
                if left >= each:
                    add((length,) * each, left // each)
                    left %= each
                if left:
                    add((length,) * left, 1)
                left = 0
                continue
            room = min(rooms)
            contents = by_room[room].pop()
            times = bins.pop(contents)
            fit = min(room // length, left)
            used = min(times, left // fit)
            if times > used:
                add(contents, times - used)
            add(contents + (length,) * fit, used)
            left -= used * fit
    return [Pattern(c, n) for c, n in bins.items()]


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: the total, or pieces over half a bin with what they can't share (for every threshold)."""
    counts = np.zeros(capacity + 2, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    upto, mass = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 2))
    best, half = -(-int(mass[-1]) // capacity), capacity // 2
    for least in range(1, half + 1):
        # pieces above capacity - least are alone; those above half are one a bin, and leave room for pieces from ``least`` on
        alone, large = int(upto[capacity] - upto[capacity - least]), int(upto[capacity - least] - upto[half])
        room = large * capacity - int(mass[capacity - least] - mass[half])
        best = max(best, alone + large + max(0, -(-(int(mass[half] - mass[least - 1]) - room) // capacity)))
    return best


class _Stopped(Exception):
    """The search has used up its nodes."""


def complete_bins(histogram: dict[int, int], capacity: int, max_nodes: int | None = None) -> tuple[list[Pattern], int]:
    """Bin completion by branch and bound over a histogram of lengths: patterns and the proven lower bound.

    A filling is repeated as often as the counts allow, or once: between them these two
    choices reach every packing. The search ends at the lower bound, when it is exhausted
    (then the incumbent is optimal and is the bound), or after ``max_nodes`` nodes.
    """
    incumbent = best_fit_decreasing(histogram, capacity)
    total = sum(length * n for length, n in histogram.items())
    bound = lower_bound(histogram, capacity)
    best = sum(p.times for p in incumbent)
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    waste, used, nodes = 0, 0, 0

    def spend() -> None:
        nonlocal nodes
        nodes += 1
        if max_nodes is not None and nodes > max_nodes:
            raise _Stopped

    path: list[tuple[Pattern, int]] = []
    # at each depth the number of choices tried, and what is left of them; only the deepest keeps it, for it is large
    trail: list[tuple[int, Iterator[tuple[tuple[int, ...], bool]] | None]] = []

    def options() -> Iterator[tuple[tuple[int, ...], bool]]:
        largest = next(x for x in range(capacity, 0, -1) if counts[x])
        left = list(counts)
        left[largest] -= 1
        for filling in fillings(left, capacity - largest, max(0, (best - 1) * capacity - total - waste), spend):
            lengths = (largest, *filling)
            yield lengths, True
            if all(left[x] + (x == largest) >= 2 * lengths.count(x) for x in set(lengths)):
                yield lengths, False

    def undo() -> None:
        nonlocal waste, used
        pattern, lost = path.pop()
        for x in pattern.lengths:
            counts[x] += pattern.times
        waste -= lost
        used -= pattern.times

    if total:
        trail.append((0, None))
    while trail and best > bound:
        tried, left = trail.pop()
        try:
            left = itertools.islice(options(), tried, None) if left is None else left
            choice = next(left, None)
        except _Stopped:
            trail.append((tried, None))
            break
        if choice is None:
            if path:
                undo()
            continue
        trail.append((tried + 1, left))
        lengths, repeated = choice
        lost = capacity - sum(lengths)
        room = (best - 1) * capacity - total - waste
        times = min(counts[x] // lengths.count(x) for x in set(lengths)) if repeated else 1
        if lost and times * lost > room:
            times = room // lost  # as often as the waste bound allows
        if times <= 0:
            continue
        for x in lengths:
            counts[x] -= times
        path.append((Pattern(lengths, times), times * lost))
        waste += times * lost
        used += times
        if not any(counts):
            if used < best:
                incumbent, best = [p for p, _ in path], used
            undo()
        else:
            trail[-1] = (tried + 1, None)
            trail.append((0, None))
    return incumbent, bound if trail and best > bound else best


def plan_rows(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, pieces of it in a sequence, offset)."""
    rows, taken, sequence = [], {}, 0
    for pattern in patterns:
        at = 0
        for length in sorted(set(pattern.lengths), reverse=True):
            n = pattern.lengths.count(length)
            start = taken.get(length, 0)
            rows.append((length, start, start + n * pattern.times - 1, sequence, n, at))
            taken[length] = start + n * pattern.times
            at += n * length
        sequence += pattern.times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, max_nodes: int | None = 200_000) -> DataFrame:
    """``pieces`` with sequence_id, offset (gapless from 0 in every sequence), n_sequences and lower_bound.

    n_sequences: of the whole packing; lower_bound: proven least number, so the difference
    is what a longer search (``max_nodes``, None: until it ends) could save at most.

    Ranks inside a length are counted in two levels (hash bucket, then row), with a bucket
    for every million pieces of the length, so a length that a third of all pieces share is
    spread. What the driver sees is the histogram (at most ``capacity`` rows). Broadcast
    are the plan (at most ``max_nodes`` patterns with their lengths) and the sizes of
    buckets (``capacity`` rows and one for each million pieces).
    """
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    patterns, bound = complete_bins(histogram, capacity, max_nodes)
    plan = spark.createDataFrame(plan_rows(patterns) or [(0, 0, 0, 0, 1, 0)], "p_length long, p_first long, p_last long, p_sequence long, p_each long, p_offset long")
    spread = spark.createDataFrame([(x, -(-n // ROWS_A_BUCKET)) for x, n in histogram.items()] or [(0, 1)], "length long, spread long")
    bucketed = pieces.join(F.broadcast(spread), "length").withColumn("bucket", F.pmod(F.xxhash64("row_id", "piece"), "spread")).drop("spread")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = bucketed.withColumn("row", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row_id", "piece")))
    ranked = ranked.join(F.broadcast(starts), ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("row") - 1)
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & F.col("rank").between(F.col("p_first"), F.col("p_last")))
    nth = F.col("rank") - F.col("p_first")
    sequence = F.col("p_sequence") + F.floor(nth / F.col("p_each")).cast("long")
    return placed.select(
        *pieces.columns, sequence.alias("sequence_id"), (F.col("p_offset") + nth % F.col("p_each") * F.col("length")).alias("offset"),
        F.lit(sum(p.times for p in patterns)).cast("long").alias("n_sequences"), F.lit(bound).cast("long").alias("lower_bound"),
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, max_nodes: int | None = 200_000
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, row_id, sequence_id, offset, n_sequences, lower_bound.

    Null and empty texts are one end token. Null ids stay null. Repeated rows are packed
    each; row_id is the same for the pieces of one row and differs between rows. Control strings in a text become their ids, as the vocabulary's library has it
    with add_special_tokens=False. Other columns are ignored; an empty table gives no rows.
    vocabulary: path of a byte-level vocabulary of the tokenizers library on every executor.
    """
    pieces = materialise(pieces_of(docs, vocabulary or default_vocabulary(), id_col, text_col, capacity, end_id), "pieces")
    return pack(pieces, capacity, max_nodes)


def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
