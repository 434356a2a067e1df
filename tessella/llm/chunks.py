"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes proposes boundaries; chunks are normalised towards NORMAL bytes by a strict mask
below that size and a loose one above it, so an edit moves only the boundaries near it.  A fingerprint is the set of
chunk digests, each holding its chunk's length, and likeness is the share of a document's bytes whose chunks the other
one has.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import mix, powers

#: Bytes of a chunk: fewest (the hash's window, so no boundary depends on the chunk before), aimed at, and most.
LEAST, NORMAL, MOST = 32, 64, 256
_STRICT, _LOOSE = np.uint32(0x7F << 25), np.uint32(0x1F << 27)
_RANDOM = np.random.default_rng(73)
_GEAR = _RANDOM.integers(0, 1 << 32, 256, dtype=np.uint32)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = powers(MOST, np.uint64(0xD1342543DE82EF95))
#: Bytes worked on at once.
BLOCK = 1 << 20


def _candidates(data: np.ndarray) -> tuple[list[int], list[int]]:
    """Ends (exclusive) at which the strict and the loose mask would cut."""
    strict, loose = [], []
    for at in range(0, len(data), BLOCK):
        low = max(0, at - LEAST + 1)
        h = _GEAR[data[low : at + BLOCK]]
        for step in (1, 2, 4, 8, 16):
            h[step:] += h[:-step] << np.uint32(step)
        h = h[at - low :]
        for mask, out in ((_STRICT, strict), (_LOOSE, loose)):
            out.append(np.flatnonzero(h & mask == 0) + at + 1)
    return [np.concatenate(x).tolist() if x else [] for x in (strict, loose)]


def _cuts(offsets: list[int], strict: list[int], loose: list[int]) -> list[int]:
    """Starts of all chunks of all rows."""
    out, i, j, n, m = [], 0, 0, len(strict), len(loose)
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        while start < end:
            out.append(start)
            stop = start + LEAST
            i = bisect_left(strict, stop, i)
            if i < n and strict[i] < start + NORMAL:
                start = strict[i]
            else:
                j = bisect_left(loose, start + NORMAL, j)
                start = loose[j] if j < m and loose[j] <= start + MOST else start + MOST
    return out


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its sorted distinct codes: 48 bits of digest, 16 bits of length."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0
    for k, text in enumerate(texts):
        group.append(text)
        held += len(text)
        if held >= BLOCK or k == len(texts) - 1:
            data = np.frombuffer(b"".join(group), np.uint8)
            offsets = np.cumsum([0, *map(len, group)])
            starts = np.array(_cuts(offsets.tolist(), *_candidates(data)), np.int64)
            # a chunk ends where the next starts or its row does
            codes = np.zeros(len(starts), np.uint64)
            lengths = np.diff(np.append(starts, len(data)))
            size = max(1, BLOCK // NORMAL)
            for a in range(0, len(starts), size):
                begin, length = starts[a : a + size], lengths[a : a + size]
                part = data[begin[0] : begin[-1] + length[-1]]
                place = np.arange(len(part)) - np.repeat(begin - begin[0], length)
                digest = mix(np.add.reduceat(_BYTES[part] * _POWERS[place], begin - begin[0]))
                codes[a : a + size] = (digest & np.uint64(0xFFFFFFFFFFFF0000)) | length.astype(np.uint64)
            bounds = np.searchsorted(starts, offsets).tolist()
            out += [np.unique(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            group, held = [], 0
    return out


def likeness(own: np.ndarray, other: np.ndarray) -> float:
    """Share of the bytes of the own distinct chunks that the other fingerprint has; two empty ones are alike."""
    if not len(own):
        return float(not len(other))
    common = np.intersect1d(own, other, assume_unique=True)
    return float((common & np.uint64(0xFFFF)).sum()) / float((own & np.uint64(0xFFFF)).sum())


def as_text(codes: np.ndarray) -> str:
    """Sixteen hex digits for each chunk, in order."""
    return codes.astype(">u8").tobytes().hex()


@F.arrow_udf(T.StringType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array([as_text(x) for x in fingerprints([(t or "").encode() for t in texts.to_pylist()])], pa.string())


def fingerprint(text: Column | str) -> Column:
    """The fingerprint of a text column as a string; null and empty texts have the empty fingerprint."""
    return _fingerprint(text)


def _neighbours(docs: DataFrame) -> DataFrame:
    """Rows (slot, doc_id, text): contiguous ranges of doc_id, each followed by a copy of the row after it (odd slots).

    Only the first doc_id of each range reaches the driver, one number for each partition of an id-only sort.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").repartitionByRange(n, "doc_id").select(F.spark_partition_id().alias("p"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"))
    firsts = np.array(sorted(r[0] for r in ids.groupBy("p").agg(F.min("doc_id")).select(F.col("min(doc_id)")).collect()), np.int64)

    @F.arrow_udf("array<int>")
    def slots(column: pa.Array) -> pa.Array:
        values = column.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        at = np.maximum(np.searchsorted(firsts, values, "right") - 1, 0)
        head = firsts[at] == values
        return pa.array([[2 * b, 2 * ((b - 1) % len(firsts)) + 1] if h else [2 * b] for b, h in zip(at.tolist(), head.tolist(), strict=True)], pa.list_(pa.int32()))

    rows = docs.select("doc_id", "text", F.explode(slots("doc_id")).alias("slot")).withColumn("range", F.shiftright("slot", 1))
    return rows.repartition(max(n, 1), "range").sortWithinPartitions("range", "slot", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).select("slot", "doc_id", "text")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """For each document its fingerprint, that of its edited text, and likenesses to that and to the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The edited text
    has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next document's text, by
    ascending doc_id (nulls first, ties by text; after the last document comes the first).  A null text is empty; a
    lone document is its own next one; repeated rows are documents of their own; an empty table gives an empty result;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row before, which still lacks its next one
        for batch in batches:
            slots, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            codes = fingerprints([t.encode() for t in texts])
            done = []
            for slot, doc, text, code in zip(slots, ids, texts, codes, strict=True):
                if held is not None and held[0] % 2 == 0 and held[0] >> 1 == slot >> 1:
                    done.append((*held[1:], text, code))
                held = (slot, doc, text, code)
            if not done:
                continue
            halves = [len(t) // 2 for _, t, *_ in done]
            edited = [(t[: len(t) - half] + after[:half]).encode() for (_, t, _, after, _), half in zip(done, halves, strict=True)]
            others = fingerprints(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in done], pa.int64()),
                    pa.array([len(d[1]) for d in done], pa.int64()),
                    pa.array([sha256(e).hexdigest() for e in edited], pa.string()),
                    pa.array([as_text(d[2]) for d in done], pa.string()),
                    pa.array([as_text(o) for o in others], pa.string()),
                    pa.array([likeness(d[2], o) for d, o in zip(done, others, strict=True)], pa.float64()),
                    pa.array([likeness(d[2], d[4]) for d in done], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _neighbours(docs).mapInArrow(run, schema)
