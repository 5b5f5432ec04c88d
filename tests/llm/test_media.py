import io
import wave
import zlib
from hashlib import sha256

import numpy as np

from tallystone.llm.media import FRAME, HOP, PEAKS, REACH, SLAB, decode, encode, filled, padded, pairs, query, to_wav, wav_features


def test_payload_round_trip(spark):
    rows = [(1, "abc"), (2, None), (3, ""), (4, "é" * 288), (5, "x" * 575), (6, "x" * 577), (7, "abc"), (8, "long " * 200_000)]
    files = to_wav(spark.createDataFrame(rows, "doc_id long, text string"))
    out = {r["doc_id"]: r for r in wav_features(files).collect()}
    for i, t in rows:
        p = (t or "").encode()
        p += b"\xff" * ((-len(p)) % 576 or (0 if p else 576))
        r = out[i]
        assert decode(bytes(r["media"])) == p
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(p), sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(r["media"]), sha256(r["media"]).hexdigest())
        with wave.open(io.BytesIO(bytes(r["media"]))) as w:
            assert (w.getnchannels(), w.getsampwidth(), w.getnframes()) == (1, 1, len(p))
    assert out[1][2:] == out[7][2:]
    assert out[1]["fingerprint"] != out[4]["fingerprint"]


def test_null_file_empty_table_and_names(spark):
    files = spark.createDataFrame([(1, None, 3)], "doc_id long, media binary, payload_bytes int")
    r = wav_features(files).first()
    assert r["payload_bytes"] == 3 and r["_payload_bytes"] is None and r["fingerprint"] is None
    assert to_wav(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_peaks_of_a_tone():
    t = np.arange(256 * 20)
    tone = (128 + 60 * np.sin(2 * np.pi * 40 * t / 256) + 50 * np.sin(2 * np.pi * 90 * t / 256)).astype(np.uint8).tobytes()
    got = pairs(tone)
    assert set((got >> 20 & 0xFFF).tolist()) == {39, 89}  # bins are counted from 1 Hz up
    frames = 1 + (len(tone) - 256) // 160
    assert len(got) == sum(frames - g for g in range(1, REACH + 1)) * PEAKS**2
    assert (np.diff(got >> 32) >= 0).all()


def brute(samples):
    peaks = []
    for at in range(0, max(1, len(samples) - FRAME + 1), HOP):
        x = (np.frombuffer(samples[at : at + FRAME], np.uint8).astype(np.float32) - 128) * np.hanning(FRAME).astype(np.float32)
        power = [0, *(round(float(p)) for p in np.abs(np.fft.rfft(x[None])[0, 1:])), 0]
        tops = [(-power[i], i - 1) for i in range(1, len(power) - 1) if power[i - 1] < power[i] >= power[i + 1]]
        peaks.append([b for _, b in sorted(tops)[:PEAKS]])
    return sorted(i << 32 | a << 20 | b << 8 | g for i in range(len(peaks)) for g in range(1, REACH + 1) if i + g < len(peaks) for a in peaks[i] for b in peaks[i + g])


def test_fingerprint_against_brute_force():
    r = np.random.default_rng(5)
    words = b"the of and to in that was his he it with is for as had you not be her".split()
    for n in (1, 40, 4000, (SLAB + 3) * HOP):
        text = b" ".join(words[i] for i in r.integers(0, len(words), n // 4 + 1))[:n]
        x = filled(padded(text))
        assert pairs(x).tolist() == brute(x)
    assert pairs(b"\x80" * 1152).tolist() == brute(b"\x80" * 1152) == []  # silence has no peak
    ramp = bytes(range(256)) * 8
    assert pairs(ramp).tolist() == brute(ramp)


def test_one_frame_has_no_pair():
    assert len(pairs(b"\x00" * 256)) == 0
    assert padded(b"") == b"\xff" * 576 and len(padded(b"a" * 1152)) == 1152
    assert decode(encode(b"\x00\x01")) == b"\x00\x01"


def test_query(spark):
    rows = query(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r["payload_bytes"] % 576 == 0 and r["payload_bytes"] >= max(576, r["n_bytes"]) for r in rows)


def test_every_sample_lies_in_a_frame(spark):
    for k in range(1, 11):
        x = bytes(range(256)) * 30
        x = x[: 576 * k]
        assert filled(x).startswith(x) and (len(filled(x)) - 256) % 160 == 0 and len(filled(x)) - len(x) < 160
    text = "".join(chr(97 + i * i % 23) for i in range(1152))
    rows = [(1, text), (2, text[:-90] + "zq" * 45)]  # the last 96 of 1,152 bytes were in no frame
    a, b = (r["fingerprint"] for r in wav_features(to_wav(spark.createDataFrame(rows, "doc_id long, text string"))).orderBy("doc_id").collect())
    assert a != b
