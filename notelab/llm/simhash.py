"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has bit b set if more than half of its word shingles
(repeats included) have it set in their XXH64.  Fingerprints link when they
differ in at most two bits.

Cut into two segments of 32 bits, two linked fingerprints agree in one segment
but for at most one bit.  The index therefore holds, per segment, the variants
with one bit wildcarded (deleted): 64 rows (position, segment without that bit)
per distinct fingerprint.  Rows with an equal variant are joined and verified by
counting the differing bits.

Variants that two fingerprints share are read off the count; of the others the
rows are made again, only those that a Bloom filter of the shared variants lets
through, so that the index shuffles once.

A variant that more than ``SMALL`` fingerprints share is not expanded into
pairs (a member of it costs about 48 rows, which is what 96 members cost in pairs).  Its members move on to variants with two deleted bits, that of the
shared variant and each of the other segment: 62 bits remain, at most four
fingerprints share them, and all of those are linked.  What differs in two bits
of one segment only agrees in the whole other one and meets in its first
variant; if that is a crowded one, its members also take the pairs of bits of
the other segment.  A fingerprint has 2,016 such variants at most, so the work
grows with the fingerprints and not with the square of a group, and no link is
lost.

Distributed: texts never shuffle; fingerprints (16 bytes a row) do.  Equal
fingerprints collapse first, so copies cost one row.  Components are found over
fingerprints.

Edge cases: null, empty and blank texts have fingerprint zero and link like any
other; a text of fewer words than a shingle is one shingle; rows that share an
id keep their own fingerprints and components; rows without an id take the least
id they reach, null if there is none; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.bloom import Members
from notelab.llm.common import fresh_name, written
from notelab.llm.components import connected_components

BITS = 64
HALF = 32
SMALL = 64
SEED = 42
ROWS = 1 << 16


def joined_words(slab: bw.Slab) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased words of a slab with one space after each: bytes, starts
    and ends of the words in them and, per text, the index of its first word."""
    low = slab.lowered()
    s, e, first = low.spans(bw.NOT_SPACE)
    n = e - s + 1
    ends = np.cumsum(n)
    out = np.full(int(ends[-1]) if len(n) else 0, 0x20, np.uint8)
    gap = np.ones(len(out), bool)
    gap[ends - 1] = False
    out[gap] = low.data[bw.NOT_SPACE[low.data]]
    return out.tobytes(), ends - n, ends - 1, first


def slab_fingerprints(slab: bw.Slab, k: int) -> np.ndarray:
    text, s, e, first = joined_words(slab)
    n = np.diff(first)
    each = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    at = np.concatenate([[0], np.cumsum(each)])
    owner = np.repeat(np.arange(len(n)), each)
    begin = first[:-1][owner] + np.arange(at[-1]) - at[:-1][owner]
    last = np.minimum(begin + k, first[1:][owner]) - 1
    out = np.zeros(len(n), np.uint64)
    ones = np.zeros((len(n), BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(begin), ROWS):
        hi = min(lo + ROWS, len(begin))
        h = np.fromiter((digest(text[a:b], SEED) for a, b in zip(s[begin[lo:hi]].tolist(), e[last[lo:hi]].tolist(), strict=True)),
                        np.uint64, hi - lo)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[lo:hi]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    for b in range(BITS):
        out |= (2 * ones[:, b] > each).astype(np.uint64) << np.uint64(b)
    return out


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in bw.slabs(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(slab.first, slab.n), pa.array(slab_fingerprints(slab, k).view(np.int64))],
                    names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """doc_id, fp (64 bits as a long) of every row."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints(k), "doc_id long, fp long")


def _segment(at: Column) -> Column:
    """The segment of the bit ``at``, as a number below 2**32."""
    return F.when(at < HALF, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", HALF))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def variants(fps: DataFrame) -> DataFrame:
    """fps: fp.  The 64 rows (key, fp): position of the deleted bit above the 32
    bits of its segment without it."""
    at = F.col("at")
    rows = fps.select("fp", F.explode(F.array(*(F.lit(i) for i in range(BITS)))).alias("at"))
    kept = _segment(at).bitwiseAND(F.bitwise_not(_bit(at % HALF)))
    return rows.select((at.cast("long") * F.lit(1 << HALF) + kept).alias("key"), "fp")


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(bw.mix(key.view(np.uint64)).view(np.int64))], names=["h"])


def _rows_of(members: Members):
    """The rows of ``variants`` whose key may be one of the members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            u = fp.view(np.uint64)
            for at in range(BITS):
                half = u & np.uint64(0xFFFFFFFF) if at < HALF else u >> np.uint64(HALF)
                key = (half & ~np.uint64(1 << at % HALF)) | np.uint64(at << HALF)
                hit = members.may_have(bw.mix(key).view(np.int64))
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(key[hit].view(np.int64)), pa.array(fp[hit])], names=["key", "fp"])

    return run


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _crowded_links(rows: DataFrame) -> DataFrame:
    """rows: key, fp of the variants with many members.  Links (a, b) by
    variants with two deleted bits."""
    at = F.floor(F.col("key") / (1 << HALF)).cast("int")
    other = F.when(at < HALF, HALF).otherwise(0)
    low = F.sequence(F.lit(0), F.lit(HALF - 1))
    across = F.transform(low, lambda q: F.struct(F.least(at, q + other).alias("p"), F.greatest(at, q + other).alias("q")))
    within = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(HALF - 2)), lambda p: F.transform(
        F.sequence(p + 1, F.lit(HALF - 1)), lambda q: F.struct((p + other).alias("p"), (q + other).alias("q")))))
    pairs = F.when(at % HALF == 0, F.concat(across, within)).otherwise(across)
    rows = rows.select("fp", F.explode(pairs).alias("x")).select("fp", "x.p", "x.q")
    kept = F.col("fp").bitwiseAND(F.bitwise_not(_bit(F.col("p")))).bitwiseAND(F.bitwise_not(_bit(F.col("q"))))
    # four fingerprints at most agree in the other 62 bits, all of them linked
    same = rows.groupBy("p", "q", kept.alias("rest")).agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    return same.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a != b").distinct()


def links(fps: DataFrame, most: int = 2, small: int = SMALL) -> DataFrame:
    """fps: distinct fp.  Links (a, b) that join all fingerprints of at most two
    differing bits: of a variant with few members all pairs that verify, of a
    crowded one the star of each variant with two deleted bits."""
    if most != 2:
        raise ValueError("two segments with one deleted bit serve two differing bits")
    index = variants(fps)
    met = written(index.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                  .filter(F.col("n") > 1), "variants")
    two = met.filter(F.col("n") == 2).select(F.col("lo").alias("a"), F.col("hi").alias("b")).filter(_differ("a", "b") <= most)
    more = met.filter(F.col("n") > 2).select("key", "n")
    members = Members(more.select("key").mapInArrow(_mixed, "h long"), more.count(), hashed=True)
    rows = written(fps.select("fp").mapInArrow(_rows_of(members), "key long, fp long").join(more, "key"), "shared-variants")
    few = rows.filter(F.col("n") <= small)
    pairs = (few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
             .filter((F.col("a") < F.col("b")) & (_differ("a", "b") <= most)).select("a", "b"))
    crowded = _crowded_links(rows.filter(F.col("n") > small).select("key", "fp"))
    return two.unionByName(pairs).unionByName(crowded).distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, small: int = SMALL) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (least id that
    links reach)."""
    fps = written(fingerprints(docs, id_col, text_col, k), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    edges = written(links(classes.select("fp"), small=small), "links")
    found = connected_components(edges).withColumnRenamed("node", "fp")
    classes = written(classes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(classes.join(least, "root").select("fp", "component_id"), "components")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, that with the least id; rows without an
    id stay; rows that share an id stay together if one of them does; columns as
    given."""
    found = components(docs, id_col, text_col, **options).groupBy("doc_id").agg(
        F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone"))
    key = fresh_name(docs, "removed_id")
    gone = found.filter("gone").select(F.col("doc_id").alias(key))
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col(key), "left_anti")
