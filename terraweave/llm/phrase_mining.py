"""Collocations of each language by best-first growth of phrases, with bounds from prefix counts.

Phrases grow word by word. For every prefix p of m words, any phrase that begins with p
scores at most ``2 f(p) / (f(p[:k]) + f(p))`` for each k < m, since neither the phrase nor
what follows its first k words is more frequent than p or less frequent than the phrase.
So a threshold t is set for each language, only prefixes whose bound reaches t are on the
frontier, and only their extensions are counted; extensions to the left are counted
for phrases that reach t themselves, as a longer phrase may drop them. If fewer than
``limit`` phrases that reach t survive, t is lowered for those languages and the frontier
grows; t never ends above the score of the last one, so its ties are all known.

Texts are cut and counted in slices by numpy, and only distinct phrases of a slice are
shuffled. What is on the frontier is told to the tasks by bitmaps of a fixed size, however
large it is: a bit set by chance has one more phrase counted in full, never a wrong count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import drop, materialise, table

WORDS_MAX = 4
SCALE = 2_000_000
BITMAP_BITS = 1 << 26
SLICE_BYTES = 4 << 20
SALTS = 64
COUNT_SCHEMA = "lang string, phrase string, key long, n long"
TOTAL = ""  # no word: stands for all words of a language
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(languages, texts) of some megabytes each, of whole texts."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
        part = size // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch["lang"].slice(a, b - a), batch["text"].slice(a, b - a)


_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] += 32
_IS_MARK = np.isin(np.arange(256), [*b".,;:!?\n\x0b\x0c\r"])
_IS_WORD = ~_IS_MARK & ~np.isin(np.arange(256), [*b" \t"])


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, text of each, piece of each): the lower-cased words of ``texts``; pieces are numbered through all of them."""
    offset = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offset[0] : offset[-1]]
    offset = offset - offset[0]
    is_word = _IS_WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    heads = offset[:-1][offset[:-1] < offset[1:]]  # a text that begins with a word begins one
    begins[heads] = is_word[heads]
    at = np.flatnonzero(begins)
    text = np.searchsorted(offset, at, "right") - 1
    piece = np.cumsum(_IS_MARK[data], dtype=np.int32)[at] + text
    offsets = np.append((np.cumsum(is_word, dtype=np.int32)[at] - 1), is_word.sum()).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(_BYTES[data[is_word]])])
    return words, text, piece


def _hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each string."""
    strings = pa.concat_arrays([strings.cast(pa.string())])  # one that begins at its buffers' start
    offset = np.frombuffer(strings.buffers()[1], np.int32)[: len(strings) + 1].tolist() if len(strings) else [0]
    data, digest = (strings.buffers()[2] or pa.py_buffer(b"")).to_pybytes(), xxhash.xxh64_intdigest
    return np.fromiter((digest(data[a:b]) for a, b in zip(offset[:-1], offset[1:], strict=True)), np.uint64, len(strings))


class _Slice:
    """Words of some texts as codes (a code is a word of one language), with the pieces they stand in."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        words, text, self.piece = _cut(pc.fill_null(texts, ""))
        coded, named = words.dictionary_encode(), pc.fill_null(langs, "und").dictionary_encode()
        n = max(len(coded.dictionary), 1)
        both = named.indices.to_numpy().astype(np.int64)[text] * n + coded.indices.to_numpy()
        if len(named.dictionary) * n <= 1 << 24:  # numbered without sorting
            seen = np.zeros(len(named.dictionary) * n, bool)
            seen[both] = True
            kinds, self.code = np.flatnonzero(seen), (np.cumsum(seen) - 1)[both]
        else:
            kinds, self.code = np.unique(both, return_inverse=True)
        self.lang, self.word = named.dictionary.take(pa.array(kinds // n)), coded.dictionary.take(pa.array(kinds % n))
        with np.errstate(over="ignore"):
            self.hash = (_hashes(coded.dictionary)[kinds % n] ^ _hashes(named.dictionary)[kinds // n]) * _STEP

    def keys(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place on."""
        word = self.hash[self.code]
        out = word[: len(word) - size + 1]
        with np.errstate(over="ignore"):
            for k in range(1, size):
                out = (out ^ (out >> np.uint64(29))) * _STEP + word[k : len(word) - size + 1 + k]
        return out

    def places(self, size: int) -> np.ndarray:
        """Where ``size`` words stand in one piece."""
        last = max(len(self.code) - size + 1, 0)
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 :]) if last else np.zeros(0, np.int64)

    def totals(self) -> pa.RecordBatch:
        n = np.bincount(self.code, minlength=len(self.lang)).astype(np.int64)
        return pa.record_batch([self.lang, pa.repeat(TOTAL, len(n)), pa.repeat(0, len(n)), pa.array(n)], names=["lang", "phrase", "key", "n"])

    def rows(self, at: np.ndarray, size: int) -> pa.RecordBatch:
        """Distinct phrases at these places, told apart by their words, with their counts."""
        kind, kinds = self.code[at], len(self.word)
        for k in range(1, size):
            pairs, kind = np.unique(kind * len(self.word) + self.code[at + k], return_inverse=True)
            kinds = len(pairs)
        first = np.zeros(kinds, np.int64)
        first[kind] = at
        n = np.bincount(kind, minlength=kinds).astype(np.int64)
        columns = [self.word.take(pa.array(self.code[first + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*columns, " ") if size > 1 else columns[0]
        return pa.record_batch([self.lang.take(pa.array(self.code[first])), phrase, pa.array(self.keys(size)[first].view(np.int64)), pa.array(n)], names=["lang", "phrase", "key", "n"])


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(BITMAP_BITS - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(keyed: DataFrame) -> np.ndarray:
    """The ``key`` of all rows as one bitmap of ``BITMAP_BITS`` bits, or-ed together before it reaches the driver."""
    bit = F.col("key").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = keyed.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(key & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


class _Tables:
    """Bitmaps of the tables that say which phrases are counted.

    both: phrases of one word less that the first and the last part both have to be among.
    prefix, suffix: of these, one part has to be among its own table, if one is given.
    whole: tables of the phrases themselves.
    """

    def __init__(self, **tables: DataFrame | None):
        self.maps = {k: _bitmap(v) for k, v in tables.items() if v is not None}

    def counted(self, part: _Slice, size: int) -> np.ndarray:
        """Places of the phrases that are counted."""
        at = part.places(size)
        for name, bitmap in self.maps.items():
            if name == "both":
                less = part.keys(size - 1)
                at = at[_has(bitmap, less[at])]
                at = at[_has(bitmap, less[at + 1])]
            elif name == "whole":
                at = at[_has(bitmap, part.keys(size)[at])]
        if "prefix" in self.maps:
            less = part.keys(size - 1)
            at = at[_has(self.maps["prefix"], less[at]) | _has(self.maps["suffix"], less[at + 1])]
        return at


def _count(docs: DataFrame, size: int, at_least: int, name: str, **tables: DataFrame | None) -> DataFrame:
    """(lang, phrase, key, f) of phrases of ``size`` words found ``at_least`` times; for words with the totals. tables: as in ``_Tables``."""
    shared = docs.sparkSession.sparkContext.broadcast(_Tables(**tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _slices(batches):
            part = _Slice(langs, texts)
            at = shared.value.counted(part, size)
            if len(at):
                yield part.rows(at, size)
            if size == 1 and len(part.lang):
                yield part.totals()

    counted = docs.mapInArrow(run, COUNT_SCHEMA).groupBy("lang", "phrase").agg(F.first("key").alias("key"), F.sum("n").alias("f"))
    out = materialise(counted.where((F.col("f") >= at_least) | (F.col("phrase") == TOTAL)), name)
    shared.destroy()
    return out


def _frequent_keys(docs: DataFrame, size: int, at_least: int, name: str, **tables: DataFrame | None) -> DataFrame:
    """(key, f) of hashes found ``at_least`` times: a table of numbers tells first which phrases are worth their text."""
    shared = docs.sparkSession.sparkContext.broadcast(_Tables(**tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _slices(batches):
            part = _Slice(langs, texts)
            keys = np.sort(part.keys(size)[shared.value.counted(part, size)])
            edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            yield pa.record_batch([pa.array(keys[edges].view(np.int64)), pa.array(np.diff(np.append(edges, len(keys))))], names=["key", "n"])

    out = materialise(docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("f")).where(F.col("f") >= at_least), name)
    shared.destroy()
    return out


def _first(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def _exact_score(a: Column, divisor: Column) -> Column:
    """floor(SCALE * a / divisor) without rounding, whatever the counts."""
    wide = "decimal(28,0)"
    return F.call_function("div", F.lit(SCALE).cast("decimal(8,0)") * a.cast("decimal(20,0)"), divisor.cast(wide))


def _with_count(rows: DataFrame, counts: DataFrame, phrase: Column, name: str) -> DataFrame:
    """``rows`` with column ``name``: the count of ``phrase``, null where it wasn't counted."""
    known = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))
    return rows.join(known, (rows["lang"] == known["_lang"]) & (phrase == known["_phrase"]), "left").drop("_lang", "_phrase")


def _scored(rows: DataFrame, counts: dict[int, DataFrame], size: int) -> DataFrame:
    """``rows`` (lang, phrase, key, f) of ``size`` words with l, r, score of the lowest cut, and bound for what begins with them.

    A cut whose rest wasn't counted is passed over here.
    """
    phrase = F.col("phrase")
    for k in range(1, size):
        rows = _with_count(rows, counts[k], _first(phrase, k), f"l{k}")
        rows = _with_count(rows, counts[size - k], _first(phrase, k - size), f"r{k}")
    cuts = F.array(*[F.struct(_exact_score(F.col("f"), F.col(f"l{k}") + F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)])
    best = F.array_min(F.filter(cuts, lambda c: c["score"].isNotNull()))
    bound = F.least(*[_exact_score(F.col("f"), F.col(f"l{k}") + F.col("f")) for k in range(1, size)], F.lit(SCALE).cast("long"))
    missing = F.exists(cuts, lambda c: c["score"].isNull())
    out = rows.withColumn("_best", best)
    return out.select("lang", "phrase", "key", "f", F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), F.col("_best.score").alias("score"), bound.alias("bound"), missing.alias("missing"))


def _thresholds(scored: DataFrame, rows: int) -> DataFrame:
    """(lang, t): a score that about ``rows`` phrases of the language reach, 0 if there are fewer; from counts by thousandths."""
    step = SCALE // 2000
    counts = scored.groupBy("lang", F.expr(f"score div {step}").alias("_step")).agg(F.count("*").alias("_n"))
    down = Window.partitionBy("lang").orderBy(F.desc("_step"))  # at most 1,001 rows a language
    upto = counts.withColumn("_upto", F.sum("_n").over(down))
    return upto.groupBy("lang").agg((F.coalesce(F.max(F.when(F.col("_upto") >= rows, F.col("_step"))), F.lit(0)) * step).alias("t"))


def _ranked(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of every language with rank; a language is thinned in ``SALTS`` parts before its rows meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    thin = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= limit)
    return thin.drop("_r", "_salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", limit: int = 2000, at_least: int = 30, dropped_at: int = 80, ahead: int = 2) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` phrases of 2 to 4 words of every language.

    A phrase is a candidate with ``at_least`` occurrences a; its score is floor(2,000,000 a /
    (l + r)) of the cut that scores lowest, ties to the first one. It is dropped if
    it stands in a longer candidate with ``dropped_at`` per cent of a or more. A longer candidate implies one of one word
    more with no fewer occurrences, so these are the ones asked. ``ahead``: the
    first threshold aims at so many times ``limit`` pairs of words.
    Null languages are ``und``; null, empty and wordless texts have no phrase; repeated rows
    count again; other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    kept: list[DataFrame] = []

    def hold(df: DataFrame, name: str) -> DataFrame:
        kept.append(materialise(df, name))
        return kept[-1]

    def count(*args, **tables) -> DataFrame:
        kept.append(_count(*args, **tables))
        return kept[-1]

    words = count(docs, 1, at_least, "phrase-words")
    totals = words.where(F.col("phrase") == TOTAL).select("lang", F.col("f").alias("n"))
    counts = {1: words.where(F.col("phrase") != TOTAL)}
    kept.append(_frequent_keys(docs, 2, at_least, "phrase-pair-keys", both=counts[1]))
    counts[2] = count(docs, 2, at_least, "phrase-pairs", whole=kept[-1])
    pairs = hold(_scored(counts[2], counts, 2), "phrase-pairs-scored")
    found, aim, open_docs = [], ahead * limit, docs
    while True:
        t = hold(_thresholds(pairs, aim), "phrase-thresholds")
        reach = lambda rows, column: rows.join(t, "lang").where(F.col(column) >= F.col("t"))
        level = {2: pairs}
        counts[3] = count(open_docs, 3, at_least, "phrase-triples", both=counts[2], prefix=reach(pairs, "bound"), suffix=reach(pairs, "score"))
        level[3] = hold(_scored(counts[3], counts, 3), "phrase-triples-scored")
        counts[4] = count(open_docs, 4, at_least, "phrase-fours", prefix=reach(level[3], "bound"), suffix=reach(level[3], "score"))
        # rests of three words that the frontier didn't ask for
        fours = hold(_scored(counts[4], counts, 4), "phrase-fours-first")
        rest = counts[3].select("lang", "phrase")
        asked = reach(fours.where("missing"), "score").select("lang", _first(F.col("phrase"), -3).alias("phrase")).join(rest, ["lang", "phrase"], "left_anti").distinct()
        asked = hold(_hashed(asked), "phrase-rests-asked")
        if not asked.isEmpty():
            rests = count(open_docs, 3, at_least, "phrase-rests", whole=asked)
            known = counts[3].unionByName(rests.join(rest, ["lang", "phrase"], "left_anti").select(*counts[3].columns))
            level[4] = hold(_scored(counts[4], counts | {3: known}, 4), "phrase-fours-scored")
        else:
            level[4] = fours
        # what a longer phrase says as often, or nearly
        longer = [level[m].select("lang", _first(F.col("phrase"), k).alias("phrase"), F.col("f").alias("over")) for m in (3, 4) for k in (m - 1, 1 - m)]
        over = longer[0].unionByName(longer[1]).unionByName(longer[2]).unionByName(longer[3]).groupBy("lang", "phrase").agg(F.max("over").alias("over"))
        every = reach(level[2].unionByName(level[3]).unionByName(level[4].where(~F.col("missing"))), "score")
        exact = lambda x: F.col(x).cast("decimal(20,0)")
        alive = every.join(over, ["lang", "phrase"], "left").where(F.coalesce(exact("over") * 100 < exact("f") * dropped_at, F.lit(True)))
        ranked = hold(_ranked(alive.select("lang", "phrase", F.col("f").alias("a"), "l", "r", "score", "t"), limit), "phrase-ranked")
        # settled: as many as asked for, or a threshold that leaves nothing out
        settled = hold(t.join(ranked.groupBy("lang").agg(F.count("*").alias("_n")), "lang", "left").select("lang", ((F.col("t") == 0) | (F.coalesce("_n", F.lit(0)) >= limit)).alias("settled")), "phrase-settled")
        found.append(ranked.join(settled.where("settled").select("lang"), "lang"))
        if settled.where(~F.col("settled")).isEmpty():
            break
        aim *= 8
        still = settled.where(~F.col("settled")).select("lang")
        pairs, open_docs = pairs.join(still, "lang", "left_semi"), open_docs.join(still, "lang", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = materialise(out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    for frame in kept:
        drop(frame)
    return out


def _hashed(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, key) of phrases of one length, with the hash by which ``_Slice.keys`` knows a phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [x.split(" ") for x in batch["phrase"].to_pylist()]
            part = object.__new__(_Slice)  # words of a phrase one after the other, as in a text
            words, part.code = pa.array([w for x in parts for w in x], pa.string()), np.arange(sum(map(len, parts)))
            lang = np.repeat(_hashes(batch["lang"]), [len(x) for x in parts])
            with np.errstate(over="ignore"):
                part.hash = (_hashes(words) ^ lang) * _STEP
            size = len(parts[0]) if parts else 1
            keys = part.keys(size)[::size] if parts else np.zeros(0, np.uint64)
            yield pa.record_batch([batch["lang"], batch["phrase"], pa.array(keys.view(np.int64))], names=["lang", "phrase", "key"])

    return phrases.mapInArrow(run, "lang string, phrase string, key long")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM w, (VALUES (1), (2), (3), (4)) s(m) WHERE len(w) >= m)
), f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, c.m)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.m], ' ')
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS over FROM (
    SELECT lang, array_to_string(w[s:s + z - 1], ' ') AS phrase, a
    FROM (SELECT *, unnest(range(1, m - z + 2)) AS s FROM c, (VALUES (2), (3)) t(z) WHERE z < m)
  ) GROUP BY ALL
), alive AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE over IS NULL OR CAST(100 AS HUGEINT) * over < CAST(80 AS HUGEINT) * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM alive JOIN n USING (lang) QUALIFY rank <= 2000
"""
