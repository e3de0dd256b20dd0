"""Vector codes: product quantisation whose parts are assigned on a lexicographic trie.

Components become integers floor(``SCALE`` * x) and vectors are cut into
``PARTS`` consecutive parts.  Each part position has a codebook of up to
``ENTRIES`` entries, at first that part of the vectors with the smallest ids.
A round assigns every part to its nearest entry (ties to the lower index) and
replaces each entry by the floor of the mean of its parts; all arithmetic is
on integers, so results are the same however Spark splits the work.

Distances are found on a trie over the distinct parts of a position: a node
is a common prefix of dimensions and carries one accumulated distance for
each entry, so parts that begin alike share that work.  The trie is walked
depth first, left to right; below a run of siblings of ``BLOCK`` parts at most
it is finished a level at a time in numpy, so memory stays at ``BLOCK`` times
``ENTRIES`` numbers a level, however wide the trie is.  Leaves take the argmin
and add their part, times the number of vectors that hold it, to its entry.

Edge cases: vectors that are null, empty, hold a null or non-finite component,
or one whose integer reaches ``largest(d)`` (2**27 for 64 dimensions, where
sums of squares would leave 64 bits), or have another length than the
commonest, are dropped.  Rows that share a vec_id are vectors of their own, in
order of their components; a null vec_id comes last.  With fewer than
``ENTRIES`` vectors the codebooks are as short.  A length that ``PARTS`` does
not divide makes the first parts one longer.  An empty table gives an empty
result; other columns are ignored.

Scale: parts are counted for each Arrow batch before they are shuffled once,
by range of (position, part), so neighbours on the trie lie in one task and a
vector that a third of all rows hold is one row for each batch.  Rounds read
that table; a task sends one sum for each entry and dimension.  Codes are
found where the vectors stand, without a shuffle; errors by label are partial
sums, written before rows meet them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import drop_table, write_table
from kiln.llm.vectors import common_length, matrix, usable

__all__ = ["SCALE", "PARTS", "ENTRIES", "ROUNDS", "BLOCK", "largest", "assign", "fit", "encode", "reconstruct", "digest", "codes"]

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Parts below a run of siblings that is finished level by level.
BLOCK = 4096


def largest(length: int) -> int:
    """Integers of components stay below this, so that a vector's squared distance stays below 2**62."""
    return min(1 << 30, int((2.0 ** 62 / length) ** 0.5) // 2)


def _most(length: int) -> float:
    return largest(length) / SCALE


def _cuts(length: int) -> list[int]:
    """Where the parts begin, and the end."""
    longer, least = length % PARTS, length // PARTS
    return [k * least + min(k, longer) for k in range(PARTS + 1)]


def _integers(column: pa.Array, length: int) -> np.ndarray:
    return np.floor(SCALE * matrix(column, length)).astype(np.int64)


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row number for each distinct part, in lexicographic order; place of each row's part among them)."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    new = np.append(True, (parts[order[1:]] != parts[order[:-1]]).any(1))
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def assign(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each of ``parts``, which are in lexicographic order."""
    n, width = parts.shape
    code, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return code, distance
    # dimensions that a part shares with the one before it: a node of depth d begins where they are fewer than d
    differs = np.ones((n, width + 1), bool)
    differs[1:, :width] = parts[1:] != parts[:-1]
    shared = differs.argmax(1)
    shared[0] = -1

    def below(lo: int, hi: int, depth: int) -> np.ndarray:
        """Where the nodes of ``depth`` begin among the rows lo..hi."""
        new = shared[lo:hi] < depth
        new[0] = True
        return lo + np.flatnonzero(new)

    def step(starts: np.ndarray, lo: int, hi: int, depth: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of the nodes at ``starts`` and what their dimension adds to the sums they share."""
        children = below(lo, hi, depth + 1)
        parent = np.searchsorted(starts, children, "right") - 1
        return children, sums[parent] + (parts[children, depth][:, None] - entries[:, depth]) ** 2

    # runs of sibling nodes still to walk: rows lo..hi, their depth, where the nodes begin, a sum for each node and entry
    stack = [(0, n, 0, np.zeros(1, np.int64), np.zeros((1, len(entries)), np.int64))]
    while stack:
        lo, hi, depth, starts, sums = stack.pop()
        if hi - lo > BLOCK and depth < width:
            if len(starts) > 1:  # the left siblings first
                cut = min(max(1, int(np.searchsorted(starts, (lo + hi) // 2))), len(starts) - 1)
                at = int(starts[cut])
                stack += [(at, hi, depth, starts[cut:], sums[cut:]), (lo, at, depth, starts[:cut], sums[:cut])]
            else:
                stack.append((lo, hi, depth + 1, *step(starts, lo, hi, depth, sums)))
            continue
        while depth < width:
            starts, sums = step(starts, lo, hi, depth, sums)
            depth += 1
        leaf = np.searchsorted(starts, np.arange(lo, hi), "right") - 1
        nearest = sums.argmin(1)
        code[lo:hi] = nearest[leaf]
        distance[lo:hi] = sums[np.arange(len(starts)), nearest][leaf]
    return code, distance


def _key(parts: np.ndarray) -> list[bytes]:
    """Bytes that compare as the parts do: big-endian, the sign turned."""
    width = 4 * parts.shape[1]
    data = (parts + (1 << 31)).astype(">u4").tobytes()
    return [data[k:k + width] for k in range(0, len(data), width)] if width else [b""] * len(parts)


def _parts(keys: pa.Array, width: int) -> np.ndarray:
    data = b"".join(keys.to_pylist())
    return np.frombuffer(data, ">u4").astype(np.int64).reshape(len(keys), width) - (1 << 31)


def _part_table(vectors: DataFrame, length: int) -> DataFrame:
    """(position, part, n): parts as sortable bytes and how many vectors hold them, in ranges of (position, part)."""
    cuts = _cuts(length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(0), length)
                for p in range(PARTS):
                    parts = x[:, cuts[p]:cuts[p + 1]]
                    first, place = _distinct(parts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(first), p), pa.int32()), pa.array(_key(parts[first]), pa.binary()),
                        pa.array(np.bincount(place), pa.int64())], ["position", "part", "n"])

    counted = vectors.select("vector").mapInArrow(count, "position int, part binary, n bigint")
    return write_table(counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")


def _round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: floors of means, unused entries as they were."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(b) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            position = batch.column(0).to_numpy()
            for p in np.unique(position).tolist():
                here = pa.array(np.flatnonzero(position == p))
                part = _parts(batch.column(1).take(here), books[p].shape[1])
                n = batch.column(2).take(here).to_numpy()
                first, place = _distinct(part)  # equal parts of different batches are one leaf
                n = np.bincount(place, n).astype(np.int64)
                part = part[first]
                code, _ = assign(part, books[p])
                np.add.at(sums[p], code, part * n[:, None])
                np.add.at(counts[p], code, n)
        for p, b in enumerate(books):
            used = np.flatnonzero(counts[p])
            if len(used):
                numbers = np.column_stack([counts[p][used], sums[p][used]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()),
                    pa.array(numbers.tolist(), pa.list_(pa.int64()))], ["position", "entry", "numbers"])

    found = parts.mapInArrow(add, "position int, entry int, numbers array<bigint>")
    found = found.select("position", "entry", F.posexplode("numbers").alias("k", "x")).groupBy("position", "entry", "k").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    total = {(r["position"], r["entry"], r["k"]): int(r["x"]) for r in found.collect()}  # a row for each entry and dimension
    new = [b.copy() for b in books]
    for (p, e, k), x in total.items():
        if k:  # 0 is the count
            new[p][e, k - 1] = x // total[p, e, 0]
    return new


def fit(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> list[np.ndarray] | None:
    """The codebooks, an integer matrix (entries, dimensions) for each part position; None without a usable vector."""
    length = common_length(vectors, vector, _most(1))
    if length is None:
        return None
    rows = usable(vectors, vector, length, _most(length), F.col(f"`{vec_id}`").alias("vec_id"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    if not first:
        return None
    start = np.floor(SCALE * np.array([r["vector"] for r in first])).astype(np.int64)
    cuts = _cuts(length)
    books = [start[:, cuts[p]:cuts[p + 1]].copy() for p in range(PARTS)]
    parts = _part_table(rows, length)
    for _ in range(rounds):
        books = _round(parts, books)
    drop_table(parts)
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], vec_id: str = "vec_id", vector: str = "embedding",
           label: str | None = None) -> DataFrame:
    """vec_id, ``label`` if named, code (two hex digits a part) and error of every usable vector."""
    length = sum(b.shape[1] for b in books)
    cuts = _cuts(length)
    extra = [F.col(f"`{label}`").alias("label")] if label else []
    rows = usable(vectors, vector, length, _most(length), F.col(f"`{vec_id}`").alias("vec_id"), *extra)
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(batch.num_columns - 1), length)
            found, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
            for p in range(PARTS):
                parts = x[:, cuts[p]:cuts[p + 1]]
                first, place = _distinct(parts) if len(x) else (np.zeros(0, int), np.zeros(0, int))
                code, distance = assign(parts[first], books[p])
                found[:, p] = code[place]
                error += distance[place]
            text = found.tobytes().hex()
            hexes = [text[k:k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hexes, pa.string()), pa.array(error, pa.int64())],
                                             schema.fieldNames())

    return rows.mapInArrow(run, schema)


def reconstruct(codes: DataFrame, books: list[np.ndarray], code: str = "code") -> DataFrame:
    """``codes`` with ``vector``: the entries that a code names, as numbers of the input's scale."""
    lines = [F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in e]) for e in b.tolist()]) for b in books]
    index = [F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    return codes.withColumn("vector", F.concat(*[F.get(line, i) for line, i in zip(lines, index)]))


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimals, by part, entry and dimension, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256.

    A sum that leaves 64 bits is null.
    """
    books = fit(vectors, vec_id, vector)
    if books is None:
        nothing = vectors.where(F.lit(False))
        return nothing.select(F.col(f"`{vec_id}`").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                              F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    rows = write_table(encode(vectors, books, vec_id, vector, label), "codes")
    total = F.expr("try_cast(sum(cast(error AS decimal(38,0))) AS bigint)")
    sums = write_table(rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors")
    met = rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
