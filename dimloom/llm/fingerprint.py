"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes; a chunk ends where its top bits are zero. Chunking is normalised: before the
target size a harder mask is asked for, beyond it an easier one, and sizes stay between MIN and MAX. As a boundary depends on the
last 32 bytes only, an insertion or a cut moves the boundaries near it and leaves the others. A fingerprint is the set of the
chunks' digests with their lengths; the likeness of two fingerprints is the length they share against the shorter one's.

Defined results: null and empty texts have an empty fingerprint, like another empty one by 1 and others by 0. Equal texts have
equal fingerprints. Repeated rows each count as a document; among rows of one doc_id the order is by a hash of the text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_bytes
from .neighbours import in_ranges

MIN, TARGET, MAX = 24, 64, 512
#: Top bits that must be zero: before the target size and beyond it.
HARD, EASY = 7, 5
#: A random 32-bit number for each byte value.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j, j < 32: the rolling gear hash, by doubling."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] += h[:-step] << np.uint32(step)  # the right side is read before it is written
    return h


def boundaries(raw: bytes, part: int = 1 << 22) -> list[int]:
    """Ends of the chunks of a byte string."""
    n = len(raw)
    if n <= MIN:
        return [n] if n else []
    hard: list[int] = []
    easy: list[int] = []
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, n, part):
        lead = min(at, 31)
        h = gear_hashes(data[at - lead : at + part])[lead:]
        ends = np.flatnonzero(h < np.uint32(1 << (32 - EASY)))
        hard += (ends[h[ends] < np.uint32(1 << (32 - HARD))] + at + 1).tolist()
        easy += (ends + at + 1).tolist()
    out, start = [], 0
    while n - start > MIN:
        end = min(start + MAX, n)
        i = bisect_left(hard, start + MIN)
        if i < len(hard) and hard[i] <= min(start + TARGET, end):
            end = hard[i]
        else:
            i = bisect_left(easy, start + TARGET + 1)
            if i < len(easy) and easy[i] < end:
                end = easy[i]
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_set(text: str | None) -> dict[str, int]:
    """digest -> length of each distinct chunk."""
    raw, start, found = text_bytes(text), 0, {}
    for end in boundaries(raw):
        found[hashlib.blake2b(raw[start:end], digest_size=8).hexdigest()] = end - start
        start = end
    return found


def as_text(chunks: dict[str, int]) -> str:
    return " ".join(f"{d}:{n:x}" for d, n in sorted(chunks.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Containment of the shorter fingerprint in the other, weighted by length."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    return sum(n for d, n in a.items() if d in b) / min(sum(a.values()), sum(b.values()))


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many of the first characters of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text; the next row is the next in descending order of id."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: range, id, text, chunks
        for batch in batches:
            out = []
            for id_, text, at, tail in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = text or ""
                chunks = chunk_set(text)
                if held is not None and held[0] == at and not held[4]:
                    _, own_id, own, mine, _ = held
                    other = edited(own, text)
                    changed = chunk_set(other)
                    sha = hashlib.sha256(text_bytes(other)).hexdigest()
                    out.append((own_id, len(own), sha, as_text(mine), as_text(changed), likeness(mine, changed), likeness(mine, chunks)))
                held = (at, id_, text, chunks, tail)
            if out:
                cols = list(zip(*out, strict=True))
                arrays = [pa.array(cols[0], batch.column(0).type), pa.array(cols[1], pa.int64()), *map(pa.array, cols[2:])]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    out = in_ranges(rows, ["id", "h"]).select("id", "text", "_range", "_tail").mapInArrow(
        run, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return out.withColumnRenamed("id", id_col)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))
