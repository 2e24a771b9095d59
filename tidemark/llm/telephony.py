"""Telephony audio columns: G.711 and IMA ADPCM samples in WAV form, expanded to linear PCM.

Mu-law and A-law samples are expanded by 256-entry tables. ADPCM blocks are decoded side by side: one numpy step handles the
n-th nibble of every block of a group of media. Expanded audio is resampled by a polyphase filter and stored as 16-bit PCM.
Media values are written to the shared folder, and what reads them sees the stored bytes only.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .rows import map_texts

RATE = 8000
BLOCK = 192
#: Bytes of media that are decoded together, at most, unless one value has more.
GROUP_BYTES = 2_000_000

# Fixed values of the WAV and IMA ADPCM formats.
FORMAT_TAG = {"pcm": 1, "alaw": 6, "mulaw": 7, "adpcm": 17}
IMA_STEPS = [
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107,
    118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963,
    1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894,
    6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794,
    32767,
]
IMA_INDEX_MOVE = [-1, -1, -1, -1, 2, 4, 6, 8]


@cache
def mulaw_table() -> np.ndarray:
    """Linear value of each mu-law code, from the G.711 rule."""
    code = ~np.arange(256) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


@cache
def alaw_table() -> np.ndarray:
    """Linear value of each A-law code, from the G.711 rule."""
    code = np.arange(256) ^ 0x55
    segment, size = (code >> 4) & 7, ((code & 0x0F) << 4) + 8
    size = np.where(segment > 0, (size + 0x100) << np.maximum(segment - 1, 0), size)
    return np.where(code & 0x80, size, -size).astype(np.int16)


@cache
def ima_tables() -> tuple[np.ndarray, np.ndarray]:
    """(change of the predictor, next step index), both by 16 * index + nibble."""
    step, nibble = np.array(IMA_STEPS)[:, None], np.arange(16)[None, :]
    size = (step >> 3) + np.where(nibble & 4, step, 0) + np.where(nibble & 2, step >> 1, 0) + np.where(nibble & 1, step >> 2, 0)
    change = np.where(nibble & 8, -size, size)
    after = np.clip(np.arange(len(IMA_STEPS))[:, None] + np.array(IMA_INDEX_MOVE * 2)[None, :], 0, len(IMA_STEPS) - 1)
    return change.astype(np.int32).ravel(), (after * 16).astype(np.int32).ravel()


def decode_adpcm(data: bytes, block: int = BLOCK) -> np.ndarray:
    """PCM of mono IMA ADPCM blocks: a 16-bit predictor, a step index, a spare byte, then nibbles, low one first.

    An index above 88 counts as 88, as in players. A last block that is short is completed with zero bytes.
    """
    raw = np.frombuffer(data + bytes(-len(data) % block), np.uint8).reshape(-1, block)
    change, after = ima_tables()
    value = raw[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(raw[:, 2], len(IMA_STEPS) - 1).astype(np.int32) * 16
    body = np.ascontiguousarray(raw[:, 4:].T)
    out = np.empty((1 + 2 * body.shape[0], len(raw)), np.int16)
    out[0] = value
    for k, column in enumerate(body):
        for half, nibble in enumerate((column & 15, column >> 4)):
            key = index + nibble
            value = np.clip(value + change[key], -32768, 32767)
            index = after[key]
            out[1 + 2 * k + half] = value
    return out.T.reshape(-1)


def expand(codec: str, data: bytes) -> np.ndarray:
    """Linear 16-bit PCM of ``data`` in one of the stored formats."""
    if codec == "mulaw":
        return mulaw_table()[np.frombuffer(data, np.uint8)]
    if codec == "alaw":
        return alaw_table()[np.frombuffer(data, np.uint8)]
    if codec == "adpcm":
        return decode_adpcm(data)
    if codec == "pcm":
        return np.frombuffer(data, "<i2")
    raise ValueError(f"unknown codec {codec!r}")


@cache
def phases(up: int, down: int, taps: int = 8) -> list[np.ndarray]:
    """The windowed-sinc filter of each output phase of an up/down resampler."""
    cut = min(1.0, up / down)
    found = []
    for phase in range(up):
        t = np.arange(taps) - (taps // 2 - 1) - phase / up
        kernel = cut * np.sinc(cut * t) * np.cos(np.pi * t / (taps + 2)) ** 2
        found.append(kernel / kernel.sum())
    return found


def resample(pcm: np.ndarray, rate: int, to_rate: int) -> np.ndarray:
    """Polyphase resampling of 16-bit PCM; the length is ceil(len * to_rate / rate)."""
    if rate == to_rate or not len(pcm):
        return pcm
    common = int(np.gcd(rate, to_rate))
    up, down = to_rate // common, rate // common
    filters = phases(up, down)
    taps = len(filters[0])
    padded = np.concatenate([np.zeros(taps // 2 - 1), pcm, np.zeros(taps // 2)]).astype(np.float32)
    total = -(-len(pcm) * up // down)
    out = np.empty(total, np.float32)
    for phase in range(up):
        # Output n stands at input position n * down / up; those with n * down % up == phase share a filter.
        first = next((n for n in range(up) if n * down % up == phase), None)
        if first is None or first >= total:
            continue
        at = np.arange(first, total, up) * down // up
        kernel = filters[phase]
        if np.count_nonzero(np.abs(kernel) > 1e-12) == 1:
            out[first::up] = padded[at + int(np.argmax(np.abs(kernel)))]
        else:
            out[first::up] = np.convolve(padded, kernel[::-1].astype(np.float32), "valid")[at]
    return np.clip(np.rint(out), -32768, 32767).astype("<i2")


def to_wav(codec: str, data: bytes, rate: int = RATE, block: int = BLOCK) -> bytes:
    """A RIFF/WAVE file around ``data``, which it holds as it is."""
    if codec == "adpcm":
        per_block = 1 + 2 * (block - 4)
        form = struct.pack("<HHIIHHHH", FORMAT_TAG[codec], 1, rate, rate * block // per_block, block, 4, 2, per_block)
        samples = -(-len(data) // block) * per_block
    else:
        width = 2 if codec == "pcm" else 1
        form = struct.pack("<HHIIHHH", FORMAT_TAG[codec], 1, rate, rate * width, width, 8 * width, 0)
        samples = len(data) // width
    chunks = b"".join(
        name + struct.pack("<I", len(body)) + body + bytes(len(body) % 2)
        for name, body in ((b"fmt ", form), (b"fact", struct.pack("<I", samples)), (b"data", data))
    )
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def from_wav(media: bytes) -> tuple[str, int, bytes]:
    """(codec, rate, data) of a WAV file; ValueError where it isn't one of the stored forms."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, form, data = 12, b"", None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        body = media[at + 8 : at + 8 + size]
        if name == b"fmt ":
            form = body
        elif name == b"data":
            data = body
        at += 8 + size + size % 2
    if len(form) < 8 or data is None:
        raise ValueError("no format or no data in the file")
    tag, _, rate = struct.unpack_from("<HHI", form)
    codec = {v: k for k, v in FORMAT_TAG.items()}.get(tag)
    if codec is None:
        raise ValueError(f"unknown format tag {tag}")
    return codec, rate, data


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(unpadded bytes, UTF-8 followed by blanks up to a positive multiple of BLOCK)."""
    raw = (text or "").encode("utf-8")
    return len(raw), raw + b" " * ((-len(raw) % BLOCK) if raw else BLOCK)


def codec_of(payload: bytes) -> str:
    """The format that holds a payload; only its bytes decide, so equal texts agree."""
    return ("mulaw", "alaw", "adpcm")[zlib.crc32(payload) % 3]


def expand_all(codecs: list[str], datas: list[bytes]) -> list[np.ndarray]:
    """Linear 16-bit PCM of each value; the ADPCM blocks of all of them are decoded in one pass."""
    coded = [i for i, c in enumerate(codecs) if c == "adpcm"]
    out = [None if c == "adpcm" else expand(c, d) for c, d in zip(codecs, datas, strict=True)]
    if coded:
        whole = [datas[i] + bytes(-len(datas[i]) % BLOCK) for i in coded]
        pcm, at = decode_adpcm(b"".join(whole)), 0
        for i, data in zip(coded, whole, strict=True):
            end = at + len(data) // BLOCK * (1 + 2 * (BLOCK - 4))
            out[i], at = pcm[at:end], end
    return out


def features(codecs: list[str], pcms: list[np.ndarray], stored: list[bytes], rate: int) -> list[str]:
    """Of each value: codec, samples, peak, root mean square, zero crossings, and length and crc of the PCM to be stored."""
    sizes = np.array([len(p) for p in pcms])
    at = np.cumsum(sizes) - sizes
    joined = np.concatenate([*pcms, np.zeros(1, np.int16)]).astype(np.int64)
    crossed = np.signbit(joined[1:]) != np.signbit(joined[:-1])
    crossed[at + sizes - 1] = False  # between two values
    sums = [np.add.reduceat(x, at) if len(at) else [] for x in (joined[:-1] ** 2, crossed.astype(np.int64))]
    peaks = np.maximum.reduceat(np.abs(joined[:-1]), at) if len(at) else []
    return [
        f"{codec};n={n};peak={peak};rms={np.sqrt(square / n):.3f};zc={zc};pcm{rate}={len(kept) // 2}:{zlib.crc32(kept):08x}"
        for codec, n, peak, square, zc, kept in zip(codecs, sizes.tolist(), peaks, *sums, stored, strict=True)
    ]


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media binary): the text's padded bytes as the samples of a WAV file, and how many were the text's.

    A null or empty text gives one block of blanks. Rows are independent, so ties and
    repeated rows give equal media; an empty table gives none; other columns are not read.
    """

    def run(ids, texts):
        payloads = [payload_of(t) for t in texts]
        return [ids, [n for n, _ in payloads], [to_wav(codec_of(p), p) for _, p in payloads]]

    return map_texts(docs, run, "doc_id long, n_bytes long, media binary", rows=128)


def groups(values: list[bytes]) -> Iterator[slice]:
    """Runs of values of GROUP_BYTES or one value at most, which are decoded together."""
    begin = held = 0
    for i, value in enumerate(values):
        if i > begin and held + len(value) > GROUP_BYTES:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(value)
    if begin < len(values):
        yield slice(begin, len(values))


def to_pcm(media: list[bytes], to_rate: int) -> Iterator[tuple[str, bytes, np.ndarray, bytes]]:
    """(codec, stored samples, expanded samples, resampled 16-bit PCM) of each WAV value."""
    for part in groups(media):
        codecs, rates, datas = zip(*map(from_wav, media[part]), strict=True)
        for codec, rate, data, pcm in zip(codecs, rates, datas, expand_all(codecs, datas), strict=True):
            yield codec, data, pcm, resample(pcm, rate, to_rate).astype("<i2").tobytes()


def store_pcm(media: DataFrame, to_rate: int = 2 * RATE) -> DataFrame:
    """(doc_id, pcm binary): each media value expanded, resampled to ``to_rate`` and stored as 16-bit PCM in a WAV file.

    A null media value gives null.
    """

    def run(ids, values):
        have = [v for v in values if v is not None]
        made = (to_wav("pcm", stored, to_rate) for *_, stored in to_pcm(have, to_rate))
        return [ids, [None if v is None else next(made) for v in values]]

    return map_texts(media.selectExpr("doc_id", "media AS text"), run, "doc_id long, pcm binary", rows=64)


def media_digests(media: DataFrame, to_rate: int = 2 * RATE) -> DataFrame:
    """doc_id, n_bytes, and digests and audio features of the bytes that the column ``media`` holds."""

    def run(ids, values):
        done = []
        for part in groups(values):
            codecs, datas, pcms, stored = zip(*to_pcm(values[part], to_rate), strict=True)
            for data, wav, feature in zip(datas, values[part], features(codecs, pcms, stored, to_rate), strict=True):
                done.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(wav), hashlib.sha256(wav).hexdigest(), feature))
        return [*ids.flatten(), *map(list, zip(*done, strict=True))]

    keyed = media.select(F.struct("doc_id", "n_bytes").alias("doc_id"), F.col("media").alias("text"))
    return map_texts(
        keyed, run,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
        rows=128,
    )


def audio_digests(docs: DataFrame, to_rate: int = 2 * RATE) -> DataFrame:
    """One row per document: its payload, stored and read back, with digests and audio features.

    Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature. The media table is
    written to the shared folder first, and all but n_bytes is made from what is read there. The resampled PCM is made whole for
    its digest; :func:`store_pcm` keeps it. Nulls, empty tables and repeated rows are as in :func:`store_media`. Nothing is shuffled.
    """
    return media_digests(stage(store_media(docs), "media"), to_rate)
