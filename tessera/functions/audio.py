"""Signal measures on numpy vectors, and their use over tables of recordings.

Everything here works within one recording. Tables call it in Arrow batches; recordings come as bytes of WAV files (binaryFile) or as arrays of samples. Loudness follows ITU-R BS.1770 with gating; where a recording is too short or silent it is null.
"""

from __future__ import annotations

import io
import math
import os
import tempfile
import wave

import numpy as np

FLOOR = 1e-12


def decode_wav(raw: bytes) -> tuple[np.ndarray, int]:
    """Samples in -1..1, frames by channels, and the rate, of PCM with 8 to 32 bits."""
    with wave.open(io.BytesIO(raw)) as w:
        width, channels, rate, data = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    if width == 1:
        x = np.frombuffer(data, np.uint8).astype(np.float64) / 128 - 1
    elif width == 3:
        b = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(data, {2: "<i2", 4: "<i4"}[width]) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels), rate


def encode_wav(audio: np.ndarray, rate: int) -> bytes:
    """A WAV file of 16-bit PCM."""
    out = io.BytesIO()
    x = np.atleast_2d(audio.T).T
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(x * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def db(level: float) -> float | None:
    return 20 * math.log10(level) if level > 0 and math.isfinite(level) else None


def frames(n: int, rate: int, tail: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of frames of 30 ms every 10 ms; with a tail, one more ends with the signal."""
    size, hop = max(1, round(rate * 0.030)), max(1, round(rate * 0.010))
    if n <= size:
        return np.zeros(1, np.int64), np.array([n])
    starts = np.arange(0, n - size + 1, hop)
    if tail and starts[-1] + size < n:
        starts = np.append(starts, n - size)
    return starts, starts + size


def frame_levels(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The level of each frame in dB, by prefix sums of the energy."""
    energy = np.concatenate(([0.0], np.cumsum(np.square(x, dtype=np.float64))))
    rms = np.sqrt(np.maximum(0.0, energy[ends] - energy[starts]) / np.maximum(1, ends - starts))
    return 20 * np.log10(np.maximum(rms, FLOOR))


def union(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for s, e in sorted(i for i in intervals if i[1] > i[0]):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def quantile(x: np.ndarray, level: float) -> float | None:
    return float(np.quantile(x, level)) if len(x) else None


def mono(audio: np.ndarray) -> np.ndarray:
    """One finite channel; an empty or broken signal fails."""
    x = np.asarray(audio, np.float64)
    x = x.mean(axis=1) if x.ndim > 1 else x
    if not x.size:
        raise ValueError("decoded audio is empty")
    if not np.isfinite(x).all():
        raise ValueError("decoded audio contains NaN or infinity")
    return x


def activity(x: np.ndarray, rate: int, top_db: float = 35.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float, list[tuple[float, float]]]:
    """Frame starts, ends, levels, which are active, the threshold and the active intervals in seconds: active from the larger of -50 dB and top_db under the 95th percentile."""
    starts, ends = frames(len(x), rate, tail=True)
    levels = frame_levels(x, starts, ends)
    threshold = max(-50.0, float(np.percentile(levels, 95)) - top_db)
    on = levels >= threshold
    return starts, ends, levels, on, threshold, union(list(zip((starts[on] / rate).tolist(), (ends[on] / rate).tolist(), strict=True)))


def active_samples(x: np.ndarray, rate: int, active: list[tuple[float, float]], lower: float, upper: float) -> np.ndarray:
    """The active samples of a stretch in a row."""
    parts = []
    for s, e in active:
        s, e = max(lower, s), min(upper, e)
        if e > s:
            parts.append(x[max(0, math.floor(s * rate)) : min(len(x), math.ceil(e * rate))])
    return np.concatenate(parts) if parts else x[:0]


def _weighting(rate: int, n: int) -> np.ndarray:
    """The frequency response of the K-weighting, a high shelf and a high pass, at n/2 + 1 frequencies."""

    def biquad(b: list[float], a: list[float]) -> np.ndarray:
        z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
        return (b[0] + b[1] * z + b[2] * z**2) / (a[0] + a[1] * z + a[2] * z**2)

    # Fixed values of the standard: shelf of 4 dB at 1682 Hz, high pass at 38 Hz.
    gain, q, fc = 3.999843853973347, 0.7071752369554196, 1681.974450955533
    k, vh = math.tan(math.pi * fc / rate), 10 ** (gain / 20)
    vb = vh**0.4996667741545416
    shelf = biquad([vh + vb * k / q + k * k, 2 * (k * k - vh), vh - vb * k / q + k * k], [1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k])
    q, fc = 0.5003270373238773, 38.13547087602444
    k = math.tan(math.pi * fc / rate)
    return shelf * biquad([1, -2, 1], [1 + k / q + k * k, 2 * (k * k - 1), 1 - k / q + k * k])


def integrated_lufs(audio: np.ndarray, rate: int) -> float | None:
    """Gated loudness in LUFS of blocks of 400 ms every 100 ms; null for less than a block or silence."""
    x = np.asarray(audio, np.float64)
    x = x[:, None] if x.ndim == 1 else x
    size, hop = round(0.4 * rate), round(0.1 * rate)
    if len(x) < size:
        return None
    n = 1 << (len(x) + rate).bit_length()
    y = np.fft.irfft(np.fft.rfft(x, n, axis=0) * _weighting(rate, n)[:, None], n, axis=0)[: len(x)]
    power = np.concatenate(([0.0], np.cumsum(np.square(y).sum(axis=1))))
    starts = np.arange(0, len(x) - size + 1, hop)
    blocks = (power[starts + size] - power[starts]) / size
    with np.errstate(divide="ignore"):
        loud = -0.691 + 10 * np.log10(np.maximum(blocks, 0))
    first = blocks[loud >= -70]
    if not len(first):
        return None
    relative = -0.691 + 10 * math.log10(first.mean()) - 10
    kept = blocks[(loud >= -70) & (loud >= relative)]
    return -0.691 + 10 * math.log10(kept.mean()) if len(kept) else None


def windowed_lufs(x: np.ndarray, rate: int, active: list[tuple[float, float]], lower: float, upper: float) -> tuple[float | None, float | None]:
    """The 25th and 50th percentile of the loudness of active samples in windows of 3 s every second, the last one ending with the stretch."""
    least, size, hop = max(1, round(0.4 * rate)), max(1, round(3.0 * rate)), max(1, rate)
    begin, end = max(0, math.floor(lower * rate)), min(len(x), math.ceil(upper * rate))
    if end - begin < least:
        return None, None
    starts = sorted({*range(begin, max(begin + 1, end - size + 1), hop), max(begin, end - size)})
    found = []
    for s in starts:
        part = active_samples(x, rate, active, s / rate, min(end, s + size) / rate)
        level = integrated_lufs(part, rate) if len(part) >= least else None
        if level is not None:
            found.append(level)
    values = np.array(found)
    return quantile(values, 0.25), quantile(values, 0.50)


METRICS = (
    "audio_duration_sec vad_threshold_dbfs vad_active_duration_sec vad_active_ratio speech_vad_active_duration_sec speech_vad_active_ratio rms_dbfs peak_dbfs lufs_i "
    "active_rms_dbfs_p25 active_rms_dbfs_p50 active_lufs_p25 active_lufs_p50 active_rms_span_p90_p10_db dynamic_range_db noise_floor_dbfs snr_db clipping_ratio"
).split()


def measure(audio: np.ndarray, rate: int, top_db: float = 35.0, start: float | None = None, end: float | None = None) -> dict[str, float | None]:
    """All measures of a recording; start and end bound its speech."""
    x = mono(audio)
    if rate <= 0:
        raise ValueError(f"invalid sample rate: {rate}")
    duration = len(x) / rate
    starts, ends, levels, on, threshold, active = activity(x, rate, top_db)
    lower, upper = max(0.0, start or 0.0), duration if end is None else min(duration, end)
    if upper <= lower:
        lower, upper = 0.0, duration
    center = (starts + ends) / 2 / rate
    loud = levels[on & (center >= lower) & (center <= upper)]
    loud = loud if len(loud) else levels[on]
    quiet = levels[~on] if (~on).any() else levels
    spoken = sum(max(0.0, min(e, upper) - max(s, lower)) for s, e in active)
    total = sum(e - s for s, e in active)
    p25, p50 = windowed_lufs(x, rate, active, lower, upper)
    q = {k: quantile(loud, k / 100) for k in (5, 10, 25, 50, 90, 95)}
    floor = quantile(quiet, 0.10)
    less = lambda a, b: None if a is None or b is None else a - b
    values = (
        duration, threshold, total, total / duration, spoken, spoken / (upper - lower), db(float(np.sqrt(np.mean(np.square(x))))), db(float(np.abs(x).max())), integrated_lufs(x, rate),
        q[25], q[50], p25, p50, less(q[90], q[10]), less(q[95], q[5]), floor, less(q[50], floor), float(np.mean(np.abs(x) >= 0.999)),
    )
    return dict(zip(METRICS, values, strict=True))


def active_rms(x: np.ndarray, rate: int, top_db: float = 35.0) -> float:
    """The median level of active frames, without a tail frame."""
    starts, ends = frames(len(x), rate, tail=False)
    levels = frame_levels(x, starts, ends)
    return float(np.percentile(levels[levels >= max(-50.0, float(np.percentile(levels, 95)) - top_db)], 50)) if len(levels) > 1 else float(levels[0])


def limited_gain(x: np.ndarray, gain_db: float, ceiling_db: float = -1.0) -> tuple[np.ndarray, float]:
    """The signal with the gain, or as much of it as keeps the peak under the ceiling."""
    peak = 20 * math.log10(max(float(np.abs(x).max(initial=0.0)), FLOOR))
    gain = min(gain_db, ceiling_db - peak)
    return (x * 10 ** (gain / 20)).astype(np.float32), gain


def true_peak(audio: np.ndarray, oversample: int = 4) -> float:
    """The peak between samples, estimated by band-limited oversampling; the sample peak is the least it can be."""
    if not audio.size:
        return 0.0
    sample = float(np.abs(audio).max())
    if oversample == 1 or len(audio) < 2:
        return sample
    x = audio[:, None] if audio.ndim == 1 else audio
    pad = min(len(x), 64)
    x = np.concatenate([2 * x[:1] - x[pad:0:-1], x, 2 * x[-1:] - x[-2 : -pad - 2 : -1]])
    spectrum = np.fft.rfft(x, axis=0)
    fine = np.fft.irfft(spectrum, len(x) * oversample, axis=0) * oversample
    return max(sample, float(np.abs(fine[pad * oversample : -pad * oversample]).max()))


def hold_peak(audio: np.ndarray, ceiling_db: float, oversample: int = 4) -> tuple[np.ndarray, float]:
    """The signal with its peak at the ceiling at most, and the attenuation in dB."""
    ceiling, peak = 10 ** (ceiling_db / 20), true_peak(audio, oversample)
    if peak <= ceiling:
        return audio, 0.0
    return audio * (ceiling / peak), 20 * math.log10(ceiling / peak)


def render(audio: np.ndarray, rate: int, gain_db: float | None = None, target_lufs: float | None = None, ceiling_db: float = -1.0, oversample: int = 4, passes: int = 3) -> tuple[bytes, dict]:
    """A WAV file with a gain or a target loudness whose peak, as written, keeps the ceiling; and what was done. What is written is measured again, as rounding can lift a peak."""
    if (gain_db is None) == (target_lufs is None):
        raise ValueError("either a gain or a target loudness")
    if gain_db is not None and not -120 <= gain_db <= 120 or target_lufs is not None and not -70 <= target_lufs < 0 or not -60 <= ceiling_db < 0 or passes < 1:
        raise ValueError("gain in -120..120 dB, loudness in -70..0 LUFS, ceiling in -60..0 dB, one pass at least")
    before = integrated_lufs(audio, rate)
    if gain_db is None:
        if before is None:
            raise ValueError("the loudness is undefined")
        gain_db = target_lufs - before
    current, cut = audio * 10 ** (gain_db / 20), 0.0
    for _ in range(passes):
        current, more = hold_peak(current, ceiling_db, oversample)
        cut += more
        raw = encode_wav(current, rate)
        written, _ = decode_wav(raw)
        peak = db(true_peak(written, oversample))
        if peak is None or peak <= ceiling_db + 1e-6:
            return raw, {"gain_db": gain_db, "ceiling_cut_db": cut, "peak_dbfs": peak, "lufs_before": before, "lufs_after": integrated_lufs(written, rate)}
        current = written
    raise RuntimeError(f"peak over the ceiling after {passes} passes")


def publish(path: str, raw: bytes, overwrite: bool = False) -> None:
    """Writes a file whole: under another name first, which then takes its place."""
    if not overwrite and os.path.lexists(path):
        raise FileExistsError(f"refusing to overwrite {path}")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(handle, "wb") as f:
        f.write(raw)
    os.replace(temporary, path)
