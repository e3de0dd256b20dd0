"""Suffix-array dedup of repeated byte strings.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus (the same document included).  Texts are UTF-8
bytes and strings do not cross documents.

Suffixes are sparse: every window of ``LENGTH`` bytes names the smallest hash
among its ``GRAM``-byte grams as its anchor, so equal windows have equal
anchors at equal places and only suffixes around anchors that occur twice need
sorting.  An anchor's context is the span of all windows that name it.

1. Grams are counted; anchors whose gram occurs once are done.
2. Equal contexts are one: all windows of a context met twice are repeated.
3. Where one gram has several contexts, one of each is sent to a bucket:
   sampled splitters range-partition them by the suffix at the anchor (its
   leading bytes), and each bucket sorts the suffixes at all window starts by
   multikey quicksort, eight bytes a level: suffixes that differ from their
   neighbours leave, ties go on to the next eight bytes, and what is still
   tied at ``LENGTH`` bytes is repeated.  Buckets are cut between grams only,
   so equal windows never lie on two sides of a boundary.
4. A gram of more than ``HOT`` contexts (a common line in many settings) is
   split by content instead: its windows are counted as strings of their own.

All comparisons in 3 and 4 are on the bytes; 1 and 2 go by 64 and 128 bits.

Edge cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing;
rows that repeat a doc_id with equal texts are copies, and lose everything
that is long enough; a null doc_id is kept as it is; an empty table gives an
empty result; other columns are ignored.

Scale: one row for each ~70 bytes of text is shuffled twice, first as a
partial count; texts move by document only.  Hot grams and hot contexts meet
in partial aggregations and equi-joins, which split skewed keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import write_table
from kiln.llm.textnp import buffer_of, byte_sums, mix, span_hash

__all__ = ["LENGTH", "GRAM", "HOT", "anchors", "repeated_windows", "repeated_spans", "remove_repeats"]

LENGTH = 200
GRAM = 64
HOT = 4096
#: Window starts that a task turns into arrays at once, and the bits that tell places among them apart.
CHUNK, PLACE_BITS = 1 << 20, 21
#: Bytes of contexts that a bucket sorts at once.
BLOCK = 4 << 20


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, n = 1, len(x) - width + 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def chunk_anchors(data: np.ndarray, offsets: np.ndarray, first: int, last: int, length: int, gram: int):
    """(place, first window, last window, gram hash, context hash) of the windows that start in data[first:last]."""
    stop = min(len(data), last + length - 1)
    if stop - first < length:
        return None
    sums = byte_sums(data[first:stop])
    starts = np.arange(stop - first - gram + 1)
    grams = mix(span_hash(sums, starts, starts + gram))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_min((grams & ~low) | starts.astype(np.uint64), length - gram + 1)
    borders = offsets[(offsets > first) & (offsets < stop)] - first
    crossing = np.zeros(len(least) + length + 1, np.int32)
    np.add.at(crossing, np.maximum(borders - length + 1, 0), 1)
    np.add.at(crossing, np.minimum(borders, len(least)), -1)
    ok = np.cumsum(crossing)[:len(least)] == 0
    ok[last - first:] = False
    windows = np.flatnonzero(ok)
    if not len(windows):
        return None
    anchor = (least[windows] & low).astype(np.int64)
    opens = np.ones(len(windows), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    lo = windows[opens]
    hi = windows[np.append(np.flatnonzero(opens)[1:], len(windows)) - 1]
    at = anchor[opens]
    context = mix(span_hash(sums, lo, hi + length) + mix((hi - lo).astype(np.uint64) * np.uint64(1 << 20)
                                                         + (at - lo).astype(np.uint64)))
    return at + first, lo + first, hi + first, grams[at].view(np.int64), context.view(np.int64)


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, at, lo, hi, gram, context) of every anchor; places are byte offsets in the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column(2))
            for first in range(0, len(data), CHUNK):
                found = chunk_anchors(data, offsets, first, min(first + CHUNK, len(data)), length, gram)
                if found is None:
                    continue
                at, lo, hi, grams, context = found
                row = np.searchsorted(offsets, lo, "right") - 1
                start = offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                     *(pa.array((x - start).astype(np.int32)) for x in (at, lo, hi)), pa.array(grams), pa.array(context)],
                    ["doc_id", "text_key", "at", "lo", "hi", "gram", "context"])

    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run, f"doc_id {id_type}, text_key bigint, at int, lo int, hi int, gram bigint, context bigint")


def repeated_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which suffixes share their first ``length`` bytes with another of their group (multikey quicksort)."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.empty(len(data) + 8, np.uint64)
    for k in range(8):
        part = padded[k:k + (len(padded) - k) // 8 * 8].view(">u8")
        words[k::8] = part[:len(words[k::8])]
    todo, out = np.arange(len(starts)), np.zeros(len(starts), bool)
    for depth in range(0, length, 8):
        key = words[starts[todo] + depth]
        if depth + 8 > length:
            key = key >> np.uint64(8 * (depth + 8 - length))
        order = np.lexsort((key, group))
        todo, key, group = todo[order], key[order], group[order]
        opens = np.ones(len(todo), bool)
        opens[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        tied = ~opens
        tied[:-1] |= ~opens[1:]
        todo, group = todo[tied], np.cumsum(opens)[tied]
        if not len(todo):
            return out
    out[todo] = True
    return out


def _sort_buckets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated runs of windows of contexts (gram, context, windows, bytes), rows of a gram side by side."""
    def done(table: pa.Table) -> pa.RecordBatch:
        data, offsets = buffer_of(table.column("bytes"))
        gram, count = table.column("gram").to_numpy(), table.column("windows").to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        group = np.cumsum(np.append(0, gram[1:] != gram[:-1]))
        hit = np.flatnonzero(repeated_windows(data, offsets[row] + inside, group[row], length))
        opens = np.ones(len(hit), bool)
        opens[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
        first = hit[opens]
        last = hit[np.append(np.flatnonzero(opens)[1:], len(hit)) - 1] if len(hit) else first
        of = pa.array(row[first])
        return pa.RecordBatch.from_arrays(
            [pa.array(gram).take(of), table.column("context").combine_chunks().take(of),
             pa.array(inside[first].astype(np.int32)), pa.array(inside[last].astype(np.int32))], ["gram", "context", "w0", "w1"])

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.column("bytes").nbytes < BLOCK:
            continue
        gram = held.column("gram").to_numpy()
        edges = np.flatnonzero(gram[1:] != gram[:-1])
        if len(edges):
            cut = int(edges[-1]) + 1
            yield done(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield done(held)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, text_key, start, end) of spans of repeated windows, of docs (doc_id, text_key, text)."""
    found = anchors(docs, length, gram)
    twice = (found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("c0"), F.max("context").alias("c1"))
             .where("n > 1").select("gram", (F.col("c0") != F.col("c1")).alias("several")))
    flagged = write_table(found.join(twice, "gram"), "anchors")
    contexts = flagged.groupBy("gram", "context", "several").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "at", "lo", "hi")).alias("one"))
    contexts = write_table(contexts.select("gram", "context", "several", "n", "one.*"), "contexts")
    whole = contexts.where("n > 1").select("gram", "context", F.lit(0).alias("w0"), (F.col("hi") - F.col("lo")).alias("w1"))
    sorted_ = contexts.where("several")
    many = sorted_.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot)
    many = write_table(many.select("gram", F.lit(True).alias("many")), "hot-grams")
    sorted_ = sorted_.join(many, "gram", "left").select(
        "gram", "context", "many", F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "at", "lo", "hi")
    text = docs.select("doc_id", "text_key", F.col("text").cast("binary").alias("text")).dropDuplicates(["doc_id", "text_key"])
    with_bytes = sorted_.join(text, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key"))).select(
        "gram", "context", "many", (F.col("at") - F.col("lo")).alias("back"), (F.col("hi") - F.col("lo") + 1).alias("windows"),
        F.substring("text", F.col("lo") + 1, F.col("hi") + length - F.col("lo")).alias("bytes"))
    with_bytes = write_table(with_bytes, "context-bytes")
    lead = F.substring("bytes", F.col("back") + 1, F.lit(gram))
    buckets = (with_bytes.where("many IS NULL").withColumn("lead", lead).repartitionByRange("lead")
               .sortWithinPartitions("lead").select("gram", "context", "windows", "bytes"))
    cold = buckets.mapInArrow(lambda batches: _sort_buckets(batches, length), "gram bigint, context bigint, w0 int, w1 int")
    exploded = with_bytes.where("many").select("gram", "context", "bytes", F.explode(
        F.sequence(F.lit(0), F.col("windows") - 1)).alias("w0"))
    exploded = exploded.select("gram", "context", "w0", F.substring("bytes", F.col("w0") + 1, F.lit(length)).alias("s"))
    again = exploded.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s")
    split = exploded.join(again, "s").select("gram", "context", "w0", F.col("w0").alias("w1"))
    runs = whole.unionByName(cold).unionByName(split)
    return flagged.join(runs, ["gram", "context"]).select(
        "doc_id", "text_key", (F.col("lo") + F.col("w0")).alias("start"), (F.col("lo") + F.col("w1") + length).alias("end"))


def _merge(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _finish(batches: Iterator[pa.RecordBatch], keep_bytes: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, spans, digests, kept = [], [], [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            text, runs = text or b"", _merge(found)
            at, parts = 0, []
            for start, end in runs:
                parts.append(text[at:start])
                at = end
            rest = b"".join([*parts, text[at:]])
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append([{"start": s, "end": e} for s, e in runs])
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if keep_bytes else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT, keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs of bytes), kept_sha256 and kept.

    ``kept`` holds the bytes that stay where ``keep_bytes`` asks for them, else null.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    src = src.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spans = repeated_spans(src, length, gram, hot).groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")).toDF("d", "t", "spans")
    joined = src.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    id_type = dict(src.dtypes)["doc_id"]
    return joined.select("doc_id", F.col("text").cast("binary"), "spans").mapInArrow(
        lambda batches: _finish(batches, keep_bytes), f"doc_id {id_type}, n_bytes bigint, n_removed bigint, spans array<struct<start: int, end: int>>, "
                                                      "kept_sha256 string, kept binary")
