"""MinHash near-dedup with odd sketches over 5-word shingles.

Each document's set of shingles gives ``HASHES`` MinHash samples.  They serve
twice: groups of ``ROWS`` samples are band keys that propose candidates, and
all samples are folded into a parity bitmap (odd sketch) of ``BITS`` bits.
The population count z of two bitmaps' XOR estimates their similarity as
1 + BITS / (4 * HASHES) * ln(1 - 2 z / BITS), most precisely where it is high.
Candidates whose estimate is under ``ESTIMATE`` (five standard errors below
the threshold) go; the rest is confirmed on the full shingle sets.

At similarity 0.75, 32 bands of 4 rows miss a pair with probability 5e-6.

Groups of copies: documents with equal sets are one class, held by its
smallest doc_id.  Of the classes that share a band key, each is paired with
the first and with the last of them, which is linear in the group; the links
confirmed give components.  Only keys of four or more classes that still hold
two components can hide an untried pair.  Their classes meet once for each
first class that leads such keys, in blocks of ``BLOCK``: sketches tell which
classes come near one of another component, and between those the sizes of
all intersections are counted exactly in the block.  A block returns a link
for each two components it joins, never its pairs.  So no pair of the bands'
candidates is left out.

Edge cases: null, empty or blank texts have no shingles, are linked with
nothing and kept; a null doc_id takes part in no link and is kept; rows that
share a doc_id are one node; an empty table gives an empty result; other
columns are ignored by ``classes`` and kept by ``apply``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import connected_components, drop_table, rows_with, write_table
from kiln.llm.textnp import buffer_of, mix, shingle_hashes, slices, word_table

__all__ = ["SHINGLE", "PERCENT", "BANDS", "ROWS", "BITS", "sketches", "sketch_limit", "similar_pairs", "classes", "apply"]

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 512
#: 0.75 less five standard errors of 128 samples.
ESTIMATE = 0.75 - 5 * math.sqrt(0.75 * 0.25 / HASHES)
BLOCK = 512
#: Bytes of text that a task turns into arrays at once.
SLICE = 1 << 20

_rng = np.random.default_rng(4)
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_SALT = mix(np.arange(HASHES, dtype=np.uint64) + np.uint64(1 << 40))
_BAND = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1 << 41))


def sketch_limit(estimate: float = ESTIMATE) -> int:
    """Most bits in which two sketches may differ to be estimated at ``estimate`` or more."""
    return int(BITS / 2 * (1 - math.exp((estimate - 1) * 4 * HASHES / BITS)))


def shingle_sets(column) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of an Arrow column."""
    data, offsets = buffer_of(column)
    for first, last in slices(offsets, SLICE):
        base = offsets[first]
        words, _, _, rows = word_table(data[base:offsets[last]], offsets[first:last + 1] - base)
        all_shingles = shingle_hashes(words, SHINGLE) if len(words) >= SHINGLE else words[:0]
        bounds = np.searchsorted(rows, np.arange(last - first + 1))
        for k in range(last - first):
            a, b = bounds[k], bounds[k + 1]
            own = all_shingles[a:b - SHINGLE + 1] if b - a >= SHINGLE else shingle_hashes(words[a:b], SHINGLE)
            yield first + k, np.unique(own)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 2048):
        np.minimum(out, (shingles[k:k + 2048, None] * _MUL + _ADD).min(0), out=out)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        sizes, keys, mins = np.zeros(n, np.int64), [None] * n, np.zeros((n, HASHES), np.uint64)
        for row, shingles in shingle_sets(batch.column(1)):
            sizes[row] = len(shingles)
            if len(shingles):
                keys[row] = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                mins[row] = min_hashes(shingles)
        bands = np.zeros((n, BANDS), np.uint64) + _BAND
        for k in range(ROWS):
            bands = mix(bands ^ mins[:, k::ROWS]) + _BAND
        places = (mix(mins + _SALT) % np.uint64(BITS)).astype(np.int64) + np.arange(n)[:, None] * BITS
        odd = (np.bincount(places.ravel(), minlength=n * BITS) & 1).astype(np.uint8)
        sketch = np.packbits(odd).view(np.int64)
        lists = lambda values, each: pa.ListArray.from_arrays(
            np.arange(0, n * each + 1, each, dtype=np.int32), pa.array(values))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(keys, pa.binary()),
             lists(bands.view(np.int64).ravel(), BANDS), lists(sketch, BITS // 64)],
            ["doc_id", "n_shingles", "set_key", "bands", "sketch"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set), bands and sketch of docs (doc_id, text)."""
    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _sketch, f"doc_id {id_type}, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for (row, a), (_, b) in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True):
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep[row] = both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _passing(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class representatives that their sketches and then their full sets confirm."""
    s = classes.select("rep", "sketch")
    near = (pairs.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b")
            .where(F.expr(f"aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x) <= {sketch_limit()}"))
            .select("a", "b"))
    near = write_table(near, "near")
    texts = rows_with(docs.select("doc_id", "text"), near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id")
    texts = write_table(texts.dropDuplicates(["doc_id"]), "near-texts")
    full = (near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
            .select("a", "b", "text_a", "text_b"))
    links = write_table(full.mapInArrow(_confirm, "a bigint, b bigint"), "links")
    drop_table(texts)
    drop_table(near)
    return links


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class, component, left rows, right rows, whether left and right are of different components)."""
    rep, comp, side = (table.column(c).to_numpy() for c in ("rep", "comp", "side"))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return rep, comp, left, right, comp[left][:, None] != comp[right][None, :]


def _near_in_block(table: pa.Table) -> pa.Table:
    """Classes of one block whose sketch comes near that of a class of another component."""
    rep, _, left, right, apart = _sides(table)
    bits = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64).reshape(len(rep), -1)
    distance = np.zeros(apart.shape, np.int64)
    for k in range(bits.shape[1]):
        distance += np.bitwise_count(bits[left, k][:, None] ^ bits[right, k][None, :])
    near = apart & (distance <= sketch_limit())
    hit = np.unique(np.concatenate([rep[left[near.any(1)]], rep[right[near.any(0)]]]))
    return pa.table({"lead": pa.array(np.full(len(hit), table.column("lead")[0].as_py()), pa.int64()),
                     "rep": pa.array(hit, pa.int64())})


def _links_in_block(table: pa.Table) -> pa.Table:
    """A link for each two components that a pair of the block joins; intersections are counted on full sets."""
    rep, comp, left, right, apart = _sides(table)
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    size = np.array([len(x) for x in sets])
    shingle, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    known, place, count = np.unique(shingle, return_inverse=True, return_counts=True)
    both = np.zeros(apart.shape, np.float32)
    order = np.argsort(place, kind="stable")
    edge = np.append(0, np.cumsum(count))
    for first in range(0, len(known), 4096):
        part = order[edge[first]:edge[min(first + 4096, len(known))]]
        held = np.zeros((len(sets), 4096), np.float32)
        held[row[part], place[part] - first] = 1
        both += held[left] @ held[right].T
    hit = np.argwhere(apart & (100 * both >= PERCENT * (size[left][:, None] + size[right][None, :] - both)))
    x, y = left[hit[:, 0]], right[hit[:, 1]]
    _, one = np.unique(np.sort(np.stack([comp[x], comp[y]], 1), axis=1), axis=0, return_index=True)
    a, b = rep[x[one]], rep[y[one]]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def _in_blocks(member: DataFrame, *payload: str) -> DataFrame:
    """Rows (lead, rep, comp, payload) for each pair of blocks of a lead's classes; grouped by lead, i, j."""
    large = member.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("m")).where("m > 1")
    member = member.join(write_table(large, "large"), "lead", "left").withColumn("m", F.coalesce("m", F.lit(1)))
    member = member.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    left = member.withColumn("i", F.col("own")).withColumn("j", F.explode(F.sequence(F.col("own"), F.col("m") - 1)))
    right = member.withColumn("j", F.col("own")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own"))))
    cols = ["lead", "i", "j", "rep", "comp", *payload]
    return left.select(*cols, F.lit(0).alias("side")).unionByName(right.select(*cols, F.lit(1).alias("side"))).groupBy(
        "lead", "i", "j")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.tobytes() for _, s in shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "shingles"])


def _links_of_open_keys(shared: DataFrame, classes: DataFrame, components: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links between components that still share a band key, from shared (key, rep, n, lo, hi)."""
    member = shared.where("n >= 4").join(components.toDF("rep", "c"), "rep", "left").select(
        "key", "rep", F.col("lo").alias("lead"), F.coalesce("c", "rep").alias("comp"))
    open_keys = member.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("key")
    member = write_table(member.join(open_keys, "key").select("lead", "rep", "comp").distinct(), "open")
    sketch = member.join(classes.select("rep", "sketch"), "rep")
    near = _in_blocks(sketch, "sketch").applyInArrow(_near_in_block, "lead bigint, rep bigint").distinct()
    near = write_table(member.join(near, ["lead", "rep"]), "open-near")
    drop_table(member)
    texts = rows_with(docs.select(F.col("doc_id").alias("rep"), "text"), near.select("rep").distinct(), "rep")
    sets = texts.dropDuplicates(["rep"]).mapInArrow(_sets, "rep bigint, shingles binary")
    found = _in_blocks(near.join(sets, "rep"), "shingles").applyInArrow(_links_in_block, "a bigint, b bigint")
    found = write_table(found.distinct(), "open-links")
    drop_table(near)
    return found


def similar_pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketches of all documents, class of each set_key, component of each class that has a link)."""
    sigs = write_table(sketches(docs), "sketches")
    groups = (sigs.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
              .agg(F.min("doc_id").alias("rep")))
    held = sigs.join(groups.toDF("k", "rep"), (F.col("set_key") == F.col("k")) & (F.col("doc_id") == F.col("rep")))
    held = write_table(held.select("rep", "bands", "sketch", "set_key").dropDuplicates(["set_key"]), "classes")
    bands = held.select("rep", F.explode("bands").alias("key"))
    ends = bands.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("n"))
    shared = write_table(bands.join(ends.where("n > 1"), "key"), "shared")
    star = shared.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("rep").alias("b")),
                                           F.struct(F.col("rep").alias("a"), F.col("hi").alias("b")))).alias("p"))
    links = _passing(star.select("p.a", "p.b").where("a < b").distinct(), held, docs)
    components = write_table(connected_components(links), "components")
    more = _links_of_open_keys(shared, held, components, docs)
    drop_table(shared)
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    return sigs, held.select("set_key", "rep"), components


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, of every document."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sigs, groups, components = similar_pairs(docs)
    df = sigs.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    df = df.join(components.toDF("rep", "component"), "rep", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return df.select("doc_id", "n_shingles", own.alias("component_id"),
                     F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component (its smallest doc_id), with the columns it came with."""
    gone = classes(docs, doc_id, text).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone.toDF("__gone"), docs[doc_id].cast("bigint") == F.col("__gone"), "left_anti")
