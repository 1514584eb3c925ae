"""Media columns, audio: texts as 8-bit sound, and features of the sound.

A payload is stored losslessly as a mono WAVE of unsigned 8-bit samples and read back from those bytes. Features follow in
three steps: polyphase resampling by UP/DOWN (each output phase uses its own part of a windowed-sinc filter), log-mel
energies of overlapped Hann frames, and segments of high energy by hysteresis (a segment opens above one level and closes
below a lower one). The energies are pooled over time to a fixed shape and stored as an Arrow fixed-shape tensor with the
time spans of the pools and segments.

Each text is computed by itself, in blocks of a fixed size, so equal texts get equal values; the digest rounds them.
Nothing is shuffled. A null or empty text is the padding alone. Very long texts are handled in blocks of bounded memory.
Other columns of the input are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkmill.llm._base import map_batches, table

UNIT, PAD, TAIL = 576, 255, 32
RATE, UP, DOWN, TAPS = 24_000, 2, 3, 12
RESAMPLED = RATE * UP // DOWN
FRAME, HOP, FFT, MELS, POOLS = 400, 200, 512, 24, 8
#: Frames that are transformed at once.
BLOCK = 512
#: Hysteresis levels, in decibels above the mean frame energy, and the least length of a segment in frames.
OPEN_DB, CLOSE_DB, LEAST = 1.0, 0.0, 2


def payload(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes([PAD]) * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def store(data: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(1), w.setframerate(RATE)  # noqa: B018
        w.writeframes(data)
    return out.getvalue()


def read_back(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


def _phases() -> np.ndarray:
    """Filter of the polyphase resampler: for each output phase, weights of the samples around its place."""
    cutoff = 1 / max(UP, DOWN)
    out = np.zeros((TAPS + DOWN, UP))
    for p in range(UP):
        place = p * DOWN / UP + TAPS / 2 - 0.5
        k = np.arange(len(out)) - place
        window = np.where(np.abs(k) <= TAPS / 2, 0.5 + 0.5 * np.cos(2 * np.pi * k / TAPS), 0)
        w = np.sinc(k * cutoff * UP) * window
        out[:, p] = w / w.sum()
    return out


def _mel_bank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    points = 700 * (10 ** (np.linspace(mel(60.0), mel(RESAMPLED / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * RESAMPLED / FFT
    low, mid, high = points[:-2], points[1:-1], points[2:]
    return np.maximum(0, np.minimum((f[:, None] - low) / (mid - low), (high - f[:, None]) / (high - mid)))


PHASES, BANK, HANN = _phases(), _mel_bank(), 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)


def resample(x: np.ndarray) -> np.ndarray:
    """UP/DOWN times the samples."""
    n = -(-len(x) // DOWN) * DOWN
    padded = np.zeros(n + TAPS + DOWN, x.dtype)
    padded[TAPS // 2 : TAPS // 2 + len(x)] = x
    windows = np.lib.stride_tricks.sliding_window_view(padded, len(PHASES))[: n - DOWN + 1 : DOWN]
    return (windows @ PHASES.astype(x.dtype)).reshape(-1)[: -(-len(x) * UP // DOWN)]


def log_mel(samples: bytes) -> np.ndarray:
    """Frames x MELS, in natural logarithms. Blocks of frames are resampled with the samples around them. The last frame is
    filled up with silence, so that every sample is in a frame."""
    n = -(-len(samples) * UP // DOWN)
    frames = 1 + max(0, -(-(n - FRAME) // HOP))
    raw = np.frombuffer(samples, np.uint8)
    out = np.empty((frames, MELS), np.float32)
    bank, hann = BANK.astype(np.float32), HANN.astype(np.float32)
    step = BLOCK * HOP * DOWN // UP  # samples of a block's hops: a multiple of DOWN
    for k in range(0, frames, BLOCK):
        count = min(BLOCK, frames - k)
        first = k // BLOCK * step
        need = -(-((count - 1) * HOP + FRAME) * DOWN // UP)
        lead = min(first, TAPS * DOWN)
        piece = (raw[first - lead : first + need + TAPS].astype(np.float32) - 128) / 128
        y = resample(piece)[lead * UP // DOWN :]
        y = np.pad(y, (0, max(0, (count - 1) * HOP + FRAME - len(y))))
        f = np.lib.stride_tricks.sliding_window_view(y, FRAME)[: (count - 1) * HOP + 1 : HOP] * hann
        spectrum = np.fft.rfft(f, FFT)
        power = spectrum.real**2 + spectrum.imag**2
        out[k : k + count] = np.log(power.astype(np.float32) @ bank + np.float32(1e-6))
    return out


def segments(mel: np.ndarray) -> list[tuple[int, int]]:
    """Half-open frame spans of high energy, by hysteresis."""
    energy = mel.mean(1, dtype=np.float64) * (10 / np.log(10))
    level = energy - energy.mean()
    state = np.where(level >= OPEN_DB, 1, np.where(level < CLOSE_DB, -1, 0))
    last = np.maximum.accumulate(np.where(state != 0, np.arange(len(state)), -1))
    on = (last >= 0) & (state[last] == 1)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], on, [0])).astype(np.int8)))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= LEAST]


def pooled(mel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(POOLS x MELS means, first frame of each pool and the end): a short sound repeats its last frames."""
    edges = np.arange(POOLS + 1) * len(mel) // POOLS
    total = np.concatenate((np.zeros((1, MELS)), np.cumsum(mel, 0, dtype=np.float64)))
    ends = np.maximum(edges[1:], edges[:-1] + 1)
    return ((total[ends] - total[edges[:-1]]) / (ends - edges[:-1])[:, None]).astype(np.float32), edges


def features(samples: bytes) -> dict:
    mel = log_mel(samples)
    tensor, edges = pooled(mel)
    end = -(-len(samples) * UP // DOWN)  # the silence after it belongs to no segment
    spans = [(a * HOP * 1000 // RESAMPLED, min((b - 1) * HOP + FRAME, end) * 1000 // RESAMPLED) for a, b in segments(mel)]
    return {"tensor": tensor, "pool_ms": edges * HOP * 1000 // RESAMPLED, "frames": len(mel), "segments": spans}


def digest(f: dict) -> str:
    """Frames, number and length of segments, and the mean of each band over time, in tenths."""
    bands = f["tensor"].mean(0, dtype=np.float64)
    return f"{f['frames']};{len(f['segments'])};{sum(b - a for a, b in f['segments'])};" + ",".join(str(int(np.floor(x * 10 + 0.5))) for x in bands)


def tensor_type() -> pa.DataType:
    return pa.fixed_shape_tensor(pa.float32(), [POOLS, MELS], dim_names=["time", "mel"])


def pack_tensor(tensor: np.ndarray, pool_ms: np.ndarray, spans: list) -> bytes:
    """One Arrow stream of one row: the fixed-shape tensor, the times of its pools, the spans of segments."""
    t = pa.ExtensionArray.from_storage(tensor_type(), pa.FixedSizeListArray.from_arrays(pa.array(tensor.ravel()), POOLS * MELS))
    span = pa.list_(pa.struct([("start_ms", pa.int64()), ("end_ms", pa.int64())]))
    batch = pa.record_batch([t, pa.array([pool_ms.tolist()], pa.list_(pa.int64())), pa.array([[{"start_ms": a, "end_ms": b} for a, b in spans]], span)], names=["mel", "pool_ms", "segments"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def unpack_tensor(data: bytes) -> tuple[np.ndarray, list, list]:
    row = pa.ipc.open_stream(data).read_all()
    return row.column("mel").combine_chunks().to_numpy_ndarray()[0], row.column("pool_ms")[0].as_py(), row.column("segments")[0].as_py()


def read_features(data: bytes) -> dict:
    """What digest() asks for, from a stored stream alone: the end of the last pool tells the number of frames."""
    tensor, pool_ms, spans = unpack_tensor(data)
    return {"tensor": tensor, "frames": -(-pool_ms[-1] * RESAMPLED // (HOP * 1000)), "segments": [(s["start_ms"], s["end_ms"]) for s in spans]}


def described(text: str | None) -> tuple[tuple, bytes, bytes]:
    """The digest of a text, its stored bytes and its tensor stream. The feature is that of the stream, read back."""
    stored = store(payload(text))
    back = read_back(stored)
    f = features(back)
    stream = pack_tensor(f["tensor"], f["pool_ms"], f["segments"])
    n = len((text or "").encode("utf-8", "surrogatepass"))
    row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-TAIL:]), len(stored), hashlib.sha256(stored).hexdigest(), digest(read_features(stream)))
    return row, stored, stream


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def audio_columns(docs: DataFrame, media: bool = True) -> DataFrame:
    """doc_id and the digest of every row, for which bytes and tensor stream are made; if asked for, they are columns too."""

    def make():
        def work(batch):
            for at in range(0, batch.num_rows, 256):  # so that few stored bytes are held at once
                rows, more = [], []
                for text in batch.column(1).slice(at, 256).to_pylist():
                    row, *bytes_ = described(text)
                    rows.append(row)
                    if media:
                        more.append(bytes_)
                yield [batch.column(0).slice(at, 256), *map(list, zip(*rows, strict=True)), *(map(list, zip(*more, strict=True)) if media else ())]

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, {DIGEST}" + ", media binary, tensor binary" * media, make)


def op4_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio_columns(table(spark, sf_dir, "documents"), media=False)
