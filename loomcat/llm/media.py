"""Media columns: WAV samples and spectral-peak fingerprints.

A text becomes a mono 8-bit WAV file through the ``wave`` module, one byte a sample.
The stored bytes are read back the same way; a short-time Fourier transform of the
samples gives frames, the strongest local maxima of a frame its peaks, and pairs of
peaks within a few frames the fingerprint: a time-coded array, each number of which is
the frame of the first peak, shifted by ``TIME_BITS``, and a hash of both frequencies
and the distance.

Long texts are transformed strip by strip. The mean that is taken off is that of all
samples, and a strip ends where the pairs that begin in it end, so strips give the same
array as the whole.

Defined results: a null text counts as empty; an empty text is one block of spaces;
constant samples have no peaks and an empty fingerprint; rows are independent, so
equal texts give equal values and an empty table an empty result; very long texts are
stored and transformed whole; columns other than the id and the text are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_or_empty

RATE, BLOCK = 8000, 192
FRAME, HOP = 256, 128
PEAKS, FAN, REACH = 3, 3, 8
TIME_BITS = 20
STRIP = 4096


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    with wave.open(io.BytesIO(data), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("not a mono 8-bit WAV")
        return w.readframes(w.getnframes())


def frame_count(samples: int, frame: int = FRAME, hop: int = HOP) -> int:
    """Frames that hold all samples, one at least."""
    return max(1, -(-(samples - frame) // hop) + 1)


def spectrum(samples: np.ndarray, mean: float | None = None, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Magnitudes by frame and frequency of the windowed samples without their mean; silence
    fills the last frame."""
    x = samples.astype(np.float64) - (samples.mean(dtype=np.float64) if mean is None else mean)
    x = np.pad(x, (0, (frame_count(len(x), frame, hop) - 1) * hop + frame - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, frame)[::hop]
    return np.abs(np.fft.rfft(frames * np.hanning(frame), axis=1))


def peaks(magnitude: np.ndarray, most: int = PEAKS) -> tuple[np.ndarray, np.ndarray]:
    """(frame, frequency) of the strongest local maxima of each frame, above its mean;
    ties to the lower frequency."""
    mid = magnitude[:, 1:-1]
    top = (mid > magnitude[:, :-2]) & (mid >= magnitude[:, 2:]) & (mid > magnitude.mean(axis=1, keepdims=True)) & (mid > 1e-3)
    score = np.where(top, mid, 0)
    order = np.sort(np.argsort(-score, axis=1, kind="stable")[:, :most], axis=1)
    t, k = np.nonzero(np.take_along_axis(top, order, axis=1))
    return t, order[t, k] + 1


def fingerprint(samples: np.ndarray, fan: int = FAN, reach: int = REACH) -> np.ndarray:
    """The time-coded peak pairs, sorted; long inputs go strip by strip, each strip with
    the frames after it that its pairs reach."""
    codes, mean = [], samples.mean(dtype=np.float64)
    for begin in range(0, frame_count(len(samples)), STRIP):
        t, f = peaks(spectrum(samples[begin * HOP : (begin + STRIP + reach) * HOP + FRAME], mean))
        for k in range(1, min(fan, len(t) - 1) + 1):
            gap = t[k:] - t[:-k]
            use = (gap <= reach) & (t[:-k] < STRIP)
            codes.append((t[:-k][use] + begin) << TIME_BITS | f[:-k][use] << 12 | f[k:][use] << 4 | gap[use])
    return np.sort(np.concatenate(codes)) if codes else np.empty(0, np.int64)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """A row's sizes, digests, feature and ``fingerprint``, plus ``media`` (the WAV file) if asked.

    ``feature`` is ``frames:pairs:`` and the SHA-1 of the fingerprint's numbers."""
    ship(docs.sparkSession)
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "fingerprint"]
    more = ", media binary" if with_media else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = text.encode("utf-8", "surrogatepass")
                padded = data + b" " * (max(1, -(-len(data) // BLOCK)) * BLOCK - len(data))
                media = to_wav(padded)
                payload = from_wav(media)
                samples = np.frombuffer(payload, np.uint8)
                pairs = fingerprint(samples).astype("<i8", copy=False)
                feature = f"{frame_count(len(samples))}:{len(pairs)}:{hashlib.sha1(pairs.tobytes()).hexdigest()}"
                row = [len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, pairs]
                rows.append([*row, media] if with_media else row)
            out = pd.DataFrame(rows, columns=names + ["media"] * with_media)
            out.insert(0, "id", batch["id"].array)
            yield out

    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = map_batches(source, run, f"n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, fingerprint array<long>{more}")
    return out.withColumnRenamed("id", id_col)


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))
