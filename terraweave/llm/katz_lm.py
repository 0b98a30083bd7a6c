"""Katz backoff language model over words, and its score of every document.

Tokens are words and one end token a document. The model of order n,

    P(w | h) = d_n(c) c(h, w) / c(h)       if the words h w were seen c times
             = alpha(h) P(w | h')          if h was seen; h' is h less its first word
             = P(w | h')                   otherwise,

discounts counts up to ``K_MAX`` by Good-Turing and takes alpha(h) exactly, as the mass
that discounting leaves over 1 - sum P(w' | h') of the w' seen after h. One more word type
stands for all unseen words. So every distribution sums to one.

Texts are cut to words once, in blocks of whole documents. For each order in turn a block
sends its distinct n-grams, sorted and compressed, to hash buckets of their contexts; a
bucket counts them and answers in the order of the question, so an answer is little more
than one small number an n-gram. A seen n-gram needs its count alone, since the count of
its context came with the order before; only contexts that a block met without success are
answered with what alpha(h) takes. Questions and answers grow with the tokens, whatever a
document or a word holds: no list of words, contexts or documents is gathered anywhere.

A context too frequent for one bucket is dealt over several by the next word. The parts of
its sums are added up and broadcast: a context has at least ``tokens // MAX_SPLIT``
occurrences to be split, so there are at most ``MAX_SPLIT`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm.common import drop, id_remainder, materialise, table

K_MAX = 5
END, START, UNSEEN, FIRST_WORD = 0, 1, 2, 3  # codes; words seen in training follow
MAX_SPLIT = 1_000_000
STATS = [f"s{r}" for r in range(1, K_MAX + 2)] + ["kinds"]
TOKEN_NAMES, TOKEN_TYPES = ["block", "docs", "words", "tokens", "trained", "ends"], [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
TOKEN_SCHEMA = "block long, docs binary, words binary, tokens long, trained long, ends long"
STATE_SCHEMA = "block long, state binary"
QUESTION_SCHEMA = "bucket int, block long, question binary"
ANSWER_SCHEMA = "block long, bucket int, answer binary, split binary, " + ", ".join(f"{s} double" for s in STATS)
SCORE_SCHEMA = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; sorted arrays are kept as differences, whole numbers in the fewest bytes."""
    parts = []
    for a in arrays:
        rising = len(a) > 1 and a.dtype == np.int64 and int(a[0]) > -(2**62) and bool((a[1:] >= a[:-1]).all())
        body = np.diff(a, prepend=0) if rising else a
        if body.dtype.kind == "i" and len(body):
            low, high = int(body.min()), int(body.max())
            body = body.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max), copy=False)
        # bytes of one significance stand together, which packs better
        planes = np.ascontiguousarray(body).view(np.uint8).reshape(len(a), body.itemsize)
        parts.append(np.array([len(a), rising], "<i8").tobytes() + body.dtype.str.encode() + a.dtype.str.encode() + planes.T.copy().tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack_arrays(value: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(value), 0, []
    while at < len(data):
        n, rising = np.frombuffer(data, "<i8", 2, at).tolist()
        kept, dtype = np.dtype(data[at + 16 : at + 19].decode()), np.dtype(data[at + 19 : at + 22].decode())
        planes = np.empty((n, kept.itemsize), np.uint8)
        for k in range(kept.itemsize):
            planes[:, k] = np.frombuffer(data, np.uint8, n, at + 22 + k * n)
        a = planes.reshape(-1).view(kept).astype(dtype, copy=False)
        out.append(np.cumsum(a) if rising else a)
        at += 22 + n * kept.itemsize
    return out


def discounts(n: list[float]) -> np.ndarray:
    """d(r) for r = 0..K_MAX and above (index K_MAX + 1: 1), from n[r], r = 1..K_MAX + 1.

    Good-Turing as Katz has it; where the counts of counts don't allow it (an empty one,
    or a discount outside (0, 1)), absolute discounting with D = n1 / (n1 + 2 n2).
    """
    d = np.ones(K_MAX + 2)
    d[0] = 0.0
    n1, last = n[1], (K_MAX + 1) * n[K_MAX + 1]
    if n1 > 0 and last < n1 and all(n[r] > 0 for r in range(1, K_MAX + 2)):
        katz = [((r + 1) * n[r + 1] / (r * n[r]) - last / n1) / (1 - last / n1) for r in range(1, K_MAX + 1)]
        if all(0 < x < 1 for x in katz):
            d[1 : K_MAX + 1] = katz
            return d
    step = n1 / (n1 + 2 * n[2]) if n1 + 2 * n[2] > 0 else 0.5
    step = min(max(step, 0.1), 0.9)
    d[1 : K_MAX + 1] = [(r - step) / r for r in range(1, K_MAX + 1)]
    return d


@dataclass(frozen=True)
class Totals:
    """Numbers of the whole corpus: training tokens, distinct ones, documents, discounts by order, mass of the unseen type."""

    n: int
    kinds: int
    ends: int
    d: tuple[np.ndarray, ...]
    unseen: float
    buckets: int
    piece: int

    def discounted(self, order: int, counts: np.ndarray) -> np.ndarray:
        return self.d[order - 1][np.minimum(counts, K_MAX + 1)] * counts


def _words(texts: pa.Array) -> pa.ListArray:
    """Words of every text, ASCII lower case, cut at exactly 0x20 and 0x09-0x0D; a text without words has one empty one."""
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes of text, or one row."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        yield start, end
        start = end


def _tokeniser(block_bytes: int):
    """Blocks of whole texts: ids, lengths, marks and word numbers; hashes and training counts of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch["text"].cast(pa.large_string()), "")
            is_null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(batch["doc_id"], 0).to_numpy(zero_copy_only=False)
            marks = batch["train"].to_numpy(zero_copy_only=False).astype(np.int8) + 2 * is_null.astype(np.int8)
            for a, b in _slices(texts, block_bytes):
                words = _words(texts.slice(a, b - a))
                flat = words.flatten().dictionary_encode()
                distinct = flat.dictionary.to_pylist()
                code, offsets = flat.indices.to_numpy(), words.offsets.to_numpy()
                lengths = np.diff(offsets).astype(np.int32)
                if "" in distinct:  # stands where a text has no word
                    gone = code == distinct.index("")
                    lengths -= np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets]).astype(np.int32)
                    code = code[~gone]
                hashes = np.fromiter([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64, len(distinct)).view(np.int64)
                mark = marks[a:b]
                n = np.bincount(code[np.repeat(mark & 1, lengths) > 0], minlength=len(distinct))
                row = (number, pack_arrays(ids[a:b], lengths, mark, code), pack_arrays(hashes, n), len(code) + b - a, int(n.sum()), int((mark & 1).sum()))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, TOKEN_TYPES, strict=True)], TOKEN_NAMES)
                number += 1

    return run


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _segments(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Stable order by bucket, and (bucket, from, to) of each in that order."""
    narrow = bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket
    order = np.argsort(narrow, kind="stable")  # 16 bits are sorted by counting
    edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)).tolist()
    return order, [(int(bucket[order[a]]), a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _word_buckets(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    order = np.argsort(hashes)
    by_bucket, segments = _segments((_mix(hashes[order]) % np.uint64(buckets)).astype(np.int32))
    return order[by_bucket], segments


def _ask_words(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, words in zip(pdf["block"].tolist(), pdf["words"], strict=True):
                hashes, n = unpack_arrays(words)
                order, segments = _word_buckets(hashes, buckets)
                rows = [(bucket, block, pack_arrays(hashes[order[a:b]], n[order[a:b]])) for bucket, a, b in segments]
                yield pd.DataFrame(rows, columns=["bucket", "block", "question"])

    return run


def _answers(pdf: pd.DataFrame, answers: list[bytes], split: bytes | None, counts: np.ndarray) -> pd.DataFrame:
    """One row a question, and one (block null) with the counts of counts of the bucket."""
    of = [float((counts == r).sum()) for r in range(1, K_MAX + 2)]
    out = pd.DataFrame({"block": pd.array([*pdf["block"].tolist(), None], dtype="Int64"), "bucket": int(pdf["bucket"].iloc[0]), "answer": [*answers, None], "split": [None] * len(answers) + [split]})
    for name, value in zip(STATS, [*of, float((counts > 0).sum())], strict=True):
        out[name] = [np.nan] * len(answers) + [value]
    return out


def _count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of the words of a bucket, and their places in it by falling count."""
    asked = [unpack_arrays(q) for q in pdf["question"]]
    words, at = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([n for _, n in asked]), minlength=len(words)).astype(np.int64)
    place = np.empty(len(words), np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(words))
    parts = np.split(at, np.cumsum([len(h) for h, _ in asked])[:-1])
    return _answers(pdf, [pack_arrays(counts[p], place[p]) for p in parts], None, counts)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some place of each distinct key, in order of the keys, and the number of its key for every place."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


class Block:
    """Positions of a block: every word and the end token of every document, in order.

    counts[n - 1]: at every position, how often the n-gram that ends there was seen in
    training; logp: log10 of its probability by the orders absorbed so far (0 where a
    training document makes sure that the next order replaces it).
    """

    def __init__(self, ids, lengths, marks, index, codes, counts1, logp, *higher):
        self.ids, self.lengths, self.marks, self.index, self.codes, self.counts1, self.logp = ids, lengths, marks, index, codes, counts1, logp
        self.counts = [counts1[index], *higher]
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        self.place = np.arange(len(index)) - np.repeat(self.starts, lengths)
        self.train = np.repeat((marks & 1) > 0, lengths)

    def pack(self) -> bytes:
        return pack_arrays(self.ids, self.lengths, self.marks, self.index, self.codes, self.counts1, self.logp, *self.counts[1:])

    def before(self, values: np.ndarray, steps: int, default: int) -> np.ndarray:
        """``values`` of the position ``steps`` earlier in the same document."""
        moved = np.empty_like(values)
        moved[steps:], moved[:steps] = values[: len(values) - steps], default
        moved[self.place < steps] = default
        return moved


class Grams:
    """Distinct n-grams of a block whose context was seen in training, dealt to buckets.

    ``at``: positions with a seen context; ``first``: one position of each n-gram, in
    order of its codes from the last context word backwards, then the word itself;
    ``inverse``: the n-gram of every position of ``at``.
    """

    def __init__(self, block: Block, order: int, totals: Totals):
        context_count = block.before(block.counts[order - 2], 1, totals.ends)
        self.at = np.flatnonzero(context_count > 0)
        self.columns = [block.before(block.index, j, START)[self.at] for j in range(1, order)]
        kinds = len(block.codes)
        key, most = np.zeros(len(self.at), np.int64), 1
        for column in [*self.columns, block.index[self.at]]:
            if most * kinds >= 2**62:
                first, key = _distinct(key)
                most = len(first)
            key, most = key * kinds + column, most * kinds
        first, self.inverse = _distinct(key)
        self.first = self.at[first]
        self.columns = [block.codes[c[first]] for c in self.columns]
        self.words = block.codes[block.index[self.first]]
        self.context_count = context_count[self.first]
        self.context = np.zeros(len(first), np.uint64)
        for column in self.columns:
            self.context = _mix(self.context * np.uint64(3) + column.astype(np.uint64))
        pieces = np.maximum(1, -(-self.context_count // totals.piece))
        self.is_split = pieces > 1
        bucket = _mix(self.context + _mix(self.words) % pieces.astype(np.uint64)) % np.uint64(totals.buckets)
        self.order, self.segments = _segments(bucket.astype(np.int32))


def _ask(order: int, totals: Totals):
    """Questions: context and next word of every distinct n-gram, its training count here, counts of the shorter n-gram and its context."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for number, state in zip(pdf["block"].tolist(), pdf["state"], strict=True):
                block = Block(*unpack_arrays(state))
                grams = Grams(block, order, totals)
                n = np.bincount(grams.inverse, weights=block.train[grams.at], minlength=len(grams.first)).astype(np.int64)
                shorter = np.where(n > 0, block.counts[order - 2][grams.first], 0)
                its_context = np.where(n > 0, block.before(block.counts[order - 3], 1, totals.ends)[grams.first] if order > 2 else totals.n, 0)
                columns = [*grams.columns, grams.words, 2 * n + grams.is_split, shorter, its_context]
                rows = [(bucket, number, pack_arrays(*[c[grams.order[a:b]] for c in columns])) for bucket, a, b in grams.segments]
                yield pd.DataFrame(rows, columns=["bucket", "block", "question"])

    return run


def _count(order: int, totals: Totals):
    """Answers of a bucket: counts, then for unsplit contexts with an unseen word the numbers of words seen r times after them and the mass of all seen ones."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack_arrays(q) for q in pdf["question"]]
        sizes = np.cumsum([len(a[0]) for a in asked])[:-1]
        *columns, words, n, shorter, its_context = (np.concatenate([a[i] for a in asked]).astype(np.int64) for i in range(order + 3))
        context = np.zeros(len(words), np.uint64)
        for column in columns:
            context = _mix(context * np.uint64(3) + column.astype(np.uint64))
        first, at = _distinct(_mix(context * np.uint64(3) + words.astype(np.uint64)))
        counts = np.bincount(at, weights=n >> 1, minlength=len(first)).astype(np.int64)
        home, place = _distinct(context[first])  # contexts of the distinct n-grams
        contexts, home, of = context[first][home], place, place[at]
        split = np.zeros(len(contexts), bool)
        split[of] = n & 1 > 0
        seen = counts > 0
        below, above = np.zeros(len(first), np.int64), np.ones(len(first), np.int64)
        trained = n > 1  # only these rows have the counts
        below[at[trained]], above[at[trained]] = shorter[trained], its_context[trained]
        lower = totals.discounted(order - 1, below) / above
        sums = [np.bincount(home[counts == r], minlength=len(contexts)) for r in range(1, K_MAX + 1)]
        sums.append(np.bincount(home[seen], weights=lower[seen], minlength=len(contexts)))
        answers = []
        for gram, c in zip(np.split(at, sizes), np.split(of, sizes), strict=True):
            wanted = c[(counts[gram] == 0) & ~split[c]]
            wanted = wanted[np.diff(wanted, prepend=-1) != 0]  # the n-grams of a context stand together
            answers.append(pack_arrays(counts[gram], *[s[wanted] for s in sums[:-1]], sums[-1][wanted]))
        parts = pack_arrays(contexts[split].view(np.int64), *[s[split].astype(np.float64) for s in sums])
        return _answers(pdf, answers, parts if split.any() else None, counts)

    return run


def _split_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for value in pdf["split"]:
            context, *sums = unpack_arrays(value)
            yield pd.DataFrame({"context": context} | {f"x{i}": s for i, s in enumerate(sums)})


def _absorb_words(totals: Totals, last: bool):
    def run(own: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        number = int(own["block"].iloc[0])
        ids, lengths, marks, local = unpack_arrays(own["docs"].iloc[0])
        hashes, _ = unpack_arrays(own["words"].iloc[0])
        order, segments = _word_buckets(hashes, totals.buckets)
        answers = dict(zip(answered["bucket"].tolist(), answered["answer"], strict=True))
        counts, codes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for bucket, a, b in segments:
            c, place = unpack_arrays(answers[bucket])
            counts[order[a:b]] = c
            codes[order[a:b]] = np.where(c > 0, FIRST_WORD + place.astype(np.int64) * totals.buckets + bucket, UNSEEN)
        table_, at = np.unique(np.concatenate([[END, START, UNSEEN], codes]), return_inverse=True)
        counts1 = np.zeros(len(table_), np.int64)
        counts1[at[3:]] = counts
        counts1[END] = totals.ends
        lengths = lengths + np.int32(1)
        index = np.zeros(int(lengths.sum()), np.int32)
        is_word = np.ones(len(index), bool)
        is_word[np.cumsum(lengths) - 1] = False
        index[is_word] = at[3:][local]
        p = np.where(counts1 > 0, totals.discounted(1, counts1) / max(totals.n, 1), totals.unseen)
        block = Block(ids, lengths, marks, index, table_, counts1, np.log10(p)[index])
        return _result(number, block, totals, last)

    return run


def _absorb(order: int, totals: Totals, split, last: bool):
    def run(own: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        number = int(own["block"].iloc[0])
        block = Block(*unpack_arrays(own["state"].iloc[0]))
        grams = Grams(block, order, totals)
        answers = dict(zip(answered["bucket"].tolist(), answered["answer"], strict=True))
        size = len(grams.first)
        counts, kept, gone = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        d = totals.d[order - 1]
        loss = [(1 - d[r]) * r for r in range(1, K_MAX + 1)]  # what discounting takes from a word seen r times
        for bucket, a, b in grams.segments:
            c, *sums, mass = unpack_arrays(answers[bucket])
            at = grams.order[a:b]
            counts[at] = c
            wanted = at[(c == 0) & ~grams.is_split[at]]
            of = np.cumsum(np.diff(grams.context[wanted], prepend=~grams.context[wanted[:1]]) != 0) - 1
            kept[wanted], gone[wanted] = sum(x * s for x, s in zip(loss, sums, strict=True))[of], mass[of]
        hot, *sums, mass = split.value
        if len(hot):
            wanted = np.flatnonzero((counts == 0) & grams.is_split)
            of = np.searchsorted(hot, grams.context[wanted])
            kept[wanted], gone[wanted] = sum(x * s for x, s in zip(loss, sums, strict=True))[of], mass[of]
        lower = block.logp[grams.first]
        alpha = np.maximum(kept / np.maximum(grams.context_count, 1), 1e-12) / np.maximum(1.0 - gone, 1e-12)
        seen = np.where(counts > 0, totals.discounted(order, counts) / np.maximum(grams.context_count, 1), 1.0)
        block.logp = block.logp.copy()
        block.logp[grams.at] = np.where(counts > 0, np.log10(seen), np.log10(alpha) + lower)[grams.inverse]
        higher = np.zeros(len(block.index), np.int64)
        higher[grams.at] = counts[grams.inverse]
        block.counts.append(higher)
        return _result(number, block, totals, last)

    return run


def _result(number: int, block: Block, totals: Totals, last: bool) -> pd.DataFrame:
    if not last:
        block.logp = np.where(block.train, 0.0, block.logp)
        return pd.DataFrame({"block": [number], "state": [block.pack()]})
    c = block.counts[0]
    sums = lambda x: np.add.reduceat(x, block.starts)
    ids = pd.array(block.ids, dtype="Int64").copy()
    ids[(block.marks & 2) > 0] = pd.NA
    return pd.DataFrame(
        {
            "doc_id": ids, "train": (block.marks & 1) > 0, "n_tokens": block.lengths.astype(np.int64), "n_known": sums((c > 0).astype(np.int64)),
            "base_score": sums(np.log10((c + 1) / (totals.n + totals.kinds + 1))), "score": sums(block.logp),
        }
    )


def score_documents(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 3, block_bytes: int = 4 << 20, tokens_a_bucket: int = 600_000) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score), one row a row of ``docs``.

    is_training: boolean column over ``docs``; null counts as true. Null texts are empty
    (the end token alone). Repeated rows and null ids are scored each on its own, and train
    each. No training rows: every word is unseen and both scores are those of one unseen
    type. Other columns are ignored. Empty table: no rows. A document is never cut, so a
    block holds at least one whole text.

    order: longest n-gram. block_bytes (of text), tokens_a_bucket: work of one task; they
    change no result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(is_training, F.lit(True)).alias("train"))
    tokens = materialise(rows.mapInArrow(_tokeniser(block_bytes), TOKEN_SCHEMA), "tokens")
    whole = tokens.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "trained", "ends")]).first()
    buckets = max(1, -(-int(whole["tokens"]) // tokens_a_bucket))
    piece = max(1, tokens_a_bucket // 4, int(whole["tokens"]) // MAX_SPLIT)

    answers = materialise(tokens.select("block", "words").mapInPandas(_ask_words(buckets), QUESTION_SCHEMA).groupBy("bucket").applyInPandas(_count_words, ANSWER_SCHEMA), "answers-1")
    of, kinds = _count_of_counts(answers)
    ends = int(whole["ends"])
    of[ends] = of.get(ends, 0.0) + (ends > 0)
    n = int(whole["trained"]) + ends
    d = discounts([0.0, *[of.get(r, 0.0) for r in range(1, K_MAX + 2)]])
    lost = sum((1 - d[r]) * r * of.get(r, 0.0) for r in range(1, K_MAX + 1))
    totals = Totals(n, kinds + (ends > 0), ends, (d,), max(lost / n, 1e-12) if n else 1.0, buckets, piece)
    state = tokens.select("block", "docs", "words")
    result = _joined(state, answers, _absorb_words(totals, order == 1), order == 1)
    for level in range(2, order + 1):
        previous, state = state, materialise(result, f"state-{level - 1}")
        drop(tokens if level == 2 else previous)
        drop(answers)
        answers = materialise(state.mapInPandas(_ask(level, totals), QUESTION_SCHEMA).groupBy("bucket").applyInPandas(_count(level, totals), ANSWER_SCHEMA), f"answers-{level}")
        of, _ = _count_of_counts(answers)
        totals = Totals(n, totals.kinds, ends, (*totals.d, discounts([0.0, *[of[r] for r in range(1, K_MAX + 2)]])), totals.unseen, buckets, piece)
        names = [f"x{i}" for i in range(K_MAX + 1)]
        parts = answers.where(F.col("split").isNotNull()).select("split").mapInPandas(_split_sums, "context long, " + ", ".join(f"{x} double" for x in names))
        hot = parts.groupBy("context").agg(*[F.sum(x).alias(x) for x in names]).toPandas()  # at most MAX_SPLIT rows
        contexts = hot["context"].to_numpy(np.int64).view(np.uint64)
        by = np.argsort(contexts)
        split = spark.sparkContext.broadcast((contexts[by], *[hot[x].to_numpy(float)[by] for x in names]))
        result = _joined(state, answers, _absorb(level, totals, split, level == order), level == order)
    return result.select("doc_id", "train", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _count_of_counts(answers: DataFrame) -> tuple[dict[int, float], int]:
    row = answers.agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in STATS]).first()
    return {r: row[f"s{r}"] for r in range(1, K_MAX + 2)}, int(row["kinds"])


def _joined(state: DataFrame, answers: DataFrame, function, last: bool) -> DataFrame:
    """Every block with all answers to its questions."""
    own = answers.where(F.col("block").isNotNull()).select("block", "bucket", "answer")
    return state.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(function, SCORE_SCHEMA if last else STATE_SCHEMA)


def op9_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(id_remainder("doc_id", 7) == 2, F.lit(False))
    return score_documents(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", ~F.col("train")).drop("train")
