import hashlib
import math
import zlib

import numpy as np
from loomcat.llm import media

from samples import documents, empty, odd


def test_rows(spark):
    docs = documents(spark, seed=2, count=40).unionByName(odd(spark))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in media.media_columns(docs, with_media=True).collect():
        data = texts[r.doc_id]
        payload = media.from_wav(bytes(r.media))
        assert payload == data.ljust(max(192, -(-len(data) // 192) * 192), b" ")
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(data), len(payload), len(r.media))
        assert (r.payload_sha256, r.media_sha256, r.tail_crc32) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(r.media).hexdigest(), zlib.crc32(payload[-16:]))
        assert int(r.feature.split(":")[1]) == len(r.fingerprint)
        assert r.fingerprint == plain_pairs(payload) if len(payload) < 20_000 else r.fingerprint
    assert media.media_columns(empty(spark)).count() == 0


def test_peaks_of_two_tones():
    t = np.arange(4096)
    tones = np.round(128 + 40 * np.sin(2 * np.pi * 32 * t / 256) + 30 * np.sin(2 * np.pi * 80 * t / 256)).astype(np.uint8)
    _, f = media.peaks(media.spectrum(tones), most=2)
    assert set(f.tolist()) == {32, 80}


def test_strips_change_nothing():
    r = np.random.default_rng(0)
    words = np.array([b"lorem", b"ipsum", b"dolor", b"sit", b"AMET,", b"1234", b"\n\n", b"zzzzzzzzzz"])
    text = b" ".join(words[r.integers(0, len(words), 220_000)]) + b"~" * 3000
    for x in (np.frombuffer(text, np.uint8), r.integers(0, 256, 30_000).astype(np.uint8)):
        strips = []
        for strip in (37, 4096, 1 << 30):
            media.STRIP, before = strip, media.STRIP
            try:
                strips.append(media.fingerprint(x))
            finally:
                media.STRIP = before
        assert len(strips[0]) > 100 and all(np.array_equal(strips[0], s) for s in strips)
    assert len(text) > media.STRIP * media.HOP * 2


def plain_pairs(payload):
    """The fingerprint as its description reads, frame by frame, by the definition of the transform."""
    size, hop = media.FRAME, media.HOP
    mean = sum(payload) / len(payload)
    window = [0.5 - 0.5 * math.cos(2 * math.pi * k / (size - 1)) for k in range(size)]
    angles = np.exp(-2j * np.pi * np.outer(np.arange(size // 2 + 1), np.arange(size)) / size)
    found = []  # (frame, frequency)
    frame, start = 0, 0
    while True:
        x = [(payload[start + k] - mean) * window[k] if start + k < len(payload) else 0.0 for k in range(size)]
        m = [abs(v) for v in angles @ np.array(x)]
        level = sum(m) / len(m)
        tops = [k for k in range(1, size // 2) if m[k] > m[k - 1] and m[k] >= m[k + 1] and m[k] > level and m[k] > 1e-3]
        found += [(frame, k) for k in sorted(sorted(tops, key=lambda k: -m[k])[: media.PEAKS])]
        if start + size >= len(payload):
            break
        frame, start = frame + 1, start + hop
    out = []
    for i, (t, f) in enumerate(found):
        for u, g in found[i + 1 : i + 1 + media.FAN]:
            if u - t <= media.REACH:
                out.append(t << media.TIME_BITS | f << 12 | g << 4 | (u - t))
    return sorted(out)


def test_the_last_samples_are_in_a_frame():
    r = np.random.default_rng(3)
    for n in (576, 960, 256 + 128 * 37 + 64):
        a = r.integers(0, 256, n).astype(np.uint8)
        b = np.concatenate([a[:-64], a[-64:][::-1]])  # of the same mean
        assert not np.array_equal(media.fingerprint(a), media.fingerprint(b))
        assert len(media.spectrum(a)) == media.frame_count(n) == (n - 256) // 128 + 2
    assert [media.frame_count(n) for n in (1, 192, 256, 257, 384, 385)] == [1, 1, 1, 2, 2, 3]
