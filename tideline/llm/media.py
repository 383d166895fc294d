"""Media columns: WAV bytes, short-time Fourier transforms, spectral-peak pair fingerprints.

A payload of bytes is kept as 8-bit mono PCM in a WAV container (written and read by the wave module). The samples
that are read back go through a short-time Fourier transform; in each frame the loudest bin of each band that stands
out from the band's mean over the recording is a peak, and each peak is paired with the peaks of the next frames. A
pair is stored with its time: frame << 32 | bin << 20 | later bin << 8 | frames between.

Null payloads count as empty ones. Very long ones are transformed in parts of BLOCK frames; a batch holds bounded bytes, or
one payload. Equal payloads give equal values. Rows are independent: repeated rows and ties need
no rule, an empty table gives an empty one, and columns besides those named are not read.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, lean, settled, table, text_or_empty

FRAME = 576
HOP = 288
#: Band edges in bins of the transform.
BANDS = (1, 9, 25, 57, 113, 193, 289)
#: Frames that a peak is paired over.
REACH = 3
RATE = 8000
#: Frames that are transformed at once; bounds memory for any payload.
BLOCK = 4096


def padded(data: bytes, unit: int = FRAME) -> bytes:
    """data with bytes 255 up to a positive multiple of unit."""
    return data + b"\xff" * (-len(data) % unit or (0 if data else unit))


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    with wave.open(io.BytesIO(data), "rb") as w:
        return w.readframes(w.getnframes())


@cache
def _window() -> np.ndarray:
    return np.hanning(FRAME).astype(np.float32)


def _loudest(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bin and magnitude of each band's loudest bin, frame by frame."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    bins, sizes = [], []
    for at in range(0, len(frames), BLOCK):
        size = np.abs(np.fft.rfft(frames[at : at + BLOCK] * _window(), axis=1))
        top = [size[:, a:b].argmax(axis=1) + a for a, b in zip(BANDS, BANDS[1:], strict=False)]
        bins.append(np.stack(top, axis=1))
        sizes.append(np.take_along_axis(size, bins[-1], axis=1))
    return np.concatenate(bins), np.concatenate(sizes)


def fingerprint(samples: bytes) -> np.ndarray:
    """Time-coded pairs of spectral peaks, in order of time."""
    if len(samples) < FRAME:
        return np.empty(0, np.int64)
    bins, size = _loudest(samples)
    peak = size >= size.mean(axis=0)
    out = []
    for step in range(1, min(REACH, len(bins) - 1) + 1):
        t, a, b = np.nonzero(peak[:-step, :, None] & peak[step:, None, :])
        out.append((t.astype(np.int64) << 32) | (bins[t, a] << 20) | (bins[t + step, b] << 8) | step)
    return np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)


def recorded(df: DataFrame, payload: str, *, keep: list[str]) -> DataFrame:
    """The columns in keep, and media: each payload's WAV bytes."""
    arrow_bounds(df.sparkSession)
    source = df.select(*keep, F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("__payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(map(to_wav, b.column(b.num_columns - 1).to_pylist()), pa.binary())], names=[*keep, "media"])

    return source.mapInArrow(lean(run), ", ".join([*(f"`{n}` {t}" for n, t in source.dtypes[:-1]), "media binary"]))


def described(media: DataFrame) -> DataFrame:
    """All columns, payload (the samples of the recordings in the column media) and fingerprint (array of time-coded pairs)."""
    arrow_bounds(media.sparkSession)
    others = [c for c in media.columns if c != "media"]
    source = media.select(*others, "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            back = [from_wav(x) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.binary()), pa.array(map(fingerprint, back), pa.list_(pa.int64()))], names=[*others, "media", "payload", "fingerprint"])

    return source.mapInArrow(lean(run), ", ".join([*(f"`{n}` {t}" for n, t in source.dtypes), "payload binary", "fingerprint array<bigint>"]))


def media_columns(df: DataFrame, payload: str, *, keep: list[str]) -> DataFrame:
    """The columns in keep, media (WAV bytes, as they are stored), payload (read back from them) and fingerprint (array of time-coded pairs).

    The recordings are a table in the shared folder, and what is described is what is read from it.
    """
    return described(settled(recorded(df, payload, keep=keep), "media"))


def padding(n_bytes: Column, unit: int = FRAME) -> Column:
    """How many bytes padded() appends."""
    return F.when(n_bytes == 0, unit).otherwise(F.pmod(-n_bytes, F.lit(unit)))


def written(fingerprint: str = "fingerprint") -> Column:
    """The time-coded pairs in decimal digits, joined by commas."""
    return F.array_join(F.transform(fingerprint, lambda x: x.cast("string")), ",")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a WAV recording, with digests of what is stored and read back, and its fingerprint."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    fill = F.unhex(F.repeat(F.lit("FF"), padding(F.col("n_bytes")).cast("int")))
    rows = media_columns(docs.withColumn("bytes", F.concat("text", fill)), "bytes", keep=["doc_id", "n_bytes"])
    size = F.octet_length("payload")
    return rows.select(
        "doc_id", "n_bytes", size.cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substr("payload", size - 31, F.lit(32))).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), written().alias("feature"),
    )
