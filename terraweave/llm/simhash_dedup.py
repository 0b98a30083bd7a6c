"""SimHash near-dedup with deletion-variant signatures.

64-bit fingerprints link when they differ in at most ``max_bits`` bits. A fingerprint is
cut into (max_bits + 2) // 2 segments, so that some segment of a linked pair differs in
one bit at most. Every segment is indexed once for each of its bits with that bit masked
(a one-wildcard variant); linked fingerprints share a variant, so an equality join on
variants finds them, and the full distance verifies them.

Groups of copies need no pairs. Equal fingerprints are one node. Small buckets verify
all their pairs in the window that forms them. In a large bucket every member is first
compared with one centre, chosen by a hash of member and bucket so that the buckets of a
dense group have different centres. Only buckets that still hold different components go
on. Where few members are outside the largest component these are compared with all of the
bucket; otherwise the members are dealt again: what the variant leaves out is cut into ``max_bits`` + 1
pieces, one of which any linked pair has equal, so buckets of chance meetings stay small
for some thousand million fingerprints. What is crowded even then goes by centres once
more, and then the smaller components of a bucket are compared with all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraweave.llm.common import materialise, table
from terraweave.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str | None, width: int = 4) -> int:
    """64-bit SimHash (signed): a bit is 1 if set in over half of the shingles' hashes."""
    words = text.encode().lower().split() if isinstance(text, str) else []  # bytes: ASCII case and spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 8192):
        counts += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def _fingerprinter(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pd.array(pdf["doc_id"].array, dtype="Int64"), "text_hash": pdf["text_hash"].to_numpy(), "fp": np.array([fingerprint(t, width) for t in pdf["text"]], np.int64)})

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; null or wordless texts have fingerprint 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_fingerprinter(width), "doc_id long, text_hash long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    n = (max_bits + 2) // 2
    return [(BITS * s // n, BITS * (s + 1) // n) for s in range(n)]


def _bits(fp: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def variants(fp: Column, max_bits: int) -> Column:
    """Array of the one-wildcard variants: (masked bit << segment width) | masked segment."""
    segments = _segments(max_bits)
    widest = max(high - low for low, high in segments)
    return F.array(*[_bits(fp, low, high).bitwiseAND(F.lit(~(1 << (bit - low)))).bitwiseOR(F.lit(bit << widest)) for low, high in segments for bit in range(low, high)])


def subkeys(fp: Column, variant: Column, max_bits: int) -> Column:
    """Array of finer keys of a member of a variant's bucket: the variant and one of ``max_bits`` + 1 pieces of all other bits."""
    segments, n = _segments(max_bits), max_bits + 1
    bit = F.shiftrightunsigned(variant, max(high - low for low, high in segments))
    arrays = []
    for low, high in segments:
        rest = [b for b in range(BITS) if not low <= b < high]
        pieces = [rest[len(rest) * k // n : len(rest) * (k + 1) // n] for k in range(n)]
        # a piece is two runs of bits where the segment lies inside it
        value = lambda p: F.concat_ws(",", *[_bits(fp, a, b + 1).cast("string") for a, b in _runs(p)])
        arrays.append((high, F.array(*[F.xxhash64(variant, F.lit(k), value(p)) for k, p in enumerate(pieces)])))
    out = arrays[-1][1]
    for high, keys in reversed(arrays[:-1]):
        out = F.when(bit < high, keys).otherwise(out)
    return out


def _runs(bits: list[int]) -> list[tuple[int, int]]:
    cuts = [k for k in range(1, len(bits)) if bits[k] != bits[k - 1] + 1]
    return [(bits[a], bits[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(bits)], strict=True)]


def _linked(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def _bucketed(keyed: DataFrame, max_bits: int, small: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) inside the small buckets of ``keyed`` (fp, variant), and the members of the large ones with their centres.

    With a column ``component`` links are those of different components, and u, v are these.
    """
    plain = "component" not in keyed.columns
    bucket = Window.partitionBy("variant")
    ahead = bucket.orderBy("fp")
    me = F.col("fp") if plain else F.struct("fp", "component")
    fp_of = (lambda x: x) if plain else (lambda x: x["fp"])
    apart = (lambda x: F.lit(True)) if plain else (lambda x: x["component"] != F.col("component"))
    close = F.filter(F.array(*[F.lead(me, i).over(ahead) for i in range(1, small)]), lambda x: x.isNotNull() & apart(x) & _linked(F.col("fp"), fp_of(x), max_bits))
    if not plain:
        close = F.array_distinct(F.transform(close, lambda x: x["component"]))
    shared = keyed.withColumn("n", F.count("*").over(bucket)).withColumn("close", close)
    centre = F.struct(F.xxhash64("fp", "variant").alias("_h"), F.col("fp").alias("at"), (F.col("fp") if plain else F.col("component")).alias("of"))
    shared = shared.withColumn("centre", F.min(centre).over(bucket))
    large = F.col("n") > small
    # of a small bucket only members with a link go on: chance meetings end here
    members = materialise(shared.where(large | (F.size("close") > 0)), name)
    own = "fp" if plain else "component"
    pairs = members.where(~large).select(F.col(own).alias("u"), F.explode("close").alias("v"))
    return pairs, members.where(large).select(*keyed.columns, F.col(own).alias("own"), F.col("centre.at").alias("at"), F.col("centre.of").alias("of"))


def _stars(members: DataFrame, max_bits: int) -> DataFrame:
    return members.where((F.col("own") != F.col("of")) & _linked(F.col("fp"), F.col("at"), max_bits)).select(F.col("own").alias("u"), F.col("of").alias("v"))


def _mixed(placed: DataFrame) -> DataFrame:
    """(variant, largest, lesser) of the buckets of ``placed`` (variant, component) with several components: the largest, and the members of all others."""
    sizes = placed.groupBy("variant", "component").agg(F.count("*").alias("n"))
    out = sizes.groupBy("variant").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"), (F.sum("n") - F.max("n")).alias("lesser"))
    return out.where("parts > 1").select("variant", "largest", "lesser")


def _crossing(members: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) between components: the lesser ones of every bucket against all its members."""
    lesser = members.where("component <> largest").select("variant", F.col("fp").alias("a"), F.col("component").alias("u"))
    every = members.select("variant", F.col("fp").alias("b"), F.col("component").alias("v"))
    return lesser.join(every, (lesser["variant"] == every["variant"]) & (F.col("u") != F.col("v")) & _linked(F.col("a"), F.col("b"), max_bits)).select("u", "v")


def link(nodes: DataFrame, max_bits: int = 4, small: int = 17) -> DataFrame:
    """(fp, component) for the distinct fingerprints ``nodes`` (fp) that have any link.

    All links between different fingerprints count; none is capped. In buckets of at most
    ``small`` members every member is compared with all that follow it; larger ones go by
    centres, finer keys and components. Buckets are window partitions, which spill; joins
    on a node or bucket can be split where it is skewed.
    """
    pairs, members = _bucketed(nodes.select("fp", F.explode(variants(F.col("fp"), max_bits)).alias("variant")), max_bits, small, "members")
    first = materialise(components(pairs.unionByName(_stars(members, max_bits))), "stars")
    # second pass: links between members of different components
    placed = members.select("fp", "variant").join(first.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    open_members = materialise(placed.join(_mixed(placed), "variant"), "open")
    # a few strays are compared with their bucket at once; dealing it anew costs ``max_bits`` + 1 rows a member
    few = F.col("lesser") <= 2 * max_bits
    finer = open_members.where(~few).select("fp", "component", F.explode(subkeys(F.col("fp"), F.col("variant"), max_bits)).alias("variant"))
    more, crowded = _bucketed(finer, max_bits, small, "finer-members")
    still = materialise(crowded.select("fp", "variant", "component").join(_mixed(crowded), "variant"), "still-open")
    merged = components(more.unionByName(_stars(crowded, max_bits)).unionByName(_crossing(open_members.where(few), max_bits)).unionByName(_crossing(still, max_bits))).select(F.col("node").alias("part"), F.col("component").alias("merged"))
    every = first.unionByName(merged.join(first, merged["part"] == first["node"], "left_anti").select(F.col("part").alias("node"), F.col("part").alias("component")))
    return every.join(merged, every["component"] == merged["part"], "left").select(F.col("node").alias("fp"), F.coalesce("merged", "component").alias("component"))


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp, component_id): one row per row of ``docs``.

    component_id: smallest id reachable over links, the row's own included; null ids are
    passed over (null only if all are). Repeated rows and equal fingerprints are linked.
    Null and wordless texts share fingerprint 0 and link like any other. Other columns
    are ignored; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    labels = materialise(nodes.join(link(nodes.select("fp"), max_bits), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labels")
    ids = labels.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return prints.join(labels.join(ids, "component").select("fp", "component_id", "component"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of every group: the smallest (id, text hash), null ids last.

    Exact repeats of that row go too. All columns are kept.
    """
    found = cluster(docs, id_col, text_col, width, max_bits)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = found.groupBy("component").agg(F.min(order).alias("pick")).select(F.col("pick.doc_id").alias("_id"), F.col("pick.text_hash").alias("_hash"))
    keyed = docs.withColumn("_key", F.col(id_col).cast("long")).withColumn("_text_hash", F.xxhash64(text_col))
    kept = keyed.join(chosen, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")))
    return kept.dropDuplicates(["_id", "_hash"]).select(*docs.columns)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
