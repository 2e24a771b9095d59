import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, sharding, telephony

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, size string, shard string, media string")


ROWS = [
    (1, "a plain text", "x", "y", "z"), (2, None, None, None, None), (3, "", None, None, None),
    (4, "é" * 5000, None, None, None), (4, "é" * 5000, None, None, None), (None, "no id", None, None, None),
]


def test_g711_tables_match_the_published_corners():
    mu, a = telephony.mulaw_table(), telephony.alaw_table()
    assert (mu[0x00], mu[0x80], mu[0xFF], mu[0x7F]) == (-32124, 32124, 0, 0)
    assert (a[0x2A], a[0xAA], a[0xD5], a[0x55]) == (-32256, 32256, 8, -8)
    assert len(set(mu.tolist())) == 255 and len(set(a.tolist())) == 256


def one_block(block):
    """Nibble by nibble, as the format describes it."""
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for nibble in (byte & 15, byte >> 4):
            step = telephony.IMA_STEPS[index]
            size = (step >> 3) + (step >> 2) * (nibble & 1) + (step >> 1) * (nibble >> 1 & 1) + step * (nibble >> 2 & 1)
            value = max(-32768, min(32767, value - size if nibble & 8 else value + size))
            index = max(0, min(88, index + telephony.IMA_INDEX_MOVE[nibble & 7]))
            out.append(value)
    return out


def test_adpcm_blocks_match_a_scalar_decoder():
    data = random.Random(5).randbytes(7 * telephony.BLOCK)
    want = [v for at in range(0, len(data), telephony.BLOCK) for v in one_block(data[at : at + telephony.BLOCK])]
    assert telephony.decode_adpcm(data).tolist() == want


@pytest.mark.parametrize("codec", ["mulaw", "alaw", "adpcm", "pcm"])
def test_wav_round_trip(codec):
    data = random.Random(1).randbytes(telephony.BLOCK * 3)
    assert telephony.from_wav(telephony.to_wav(codec, data, 11025)) == (codec, 11025, data)


def test_resampling_keeps_a_tone():
    t = np.arange(4000)
    tone = np.rint(8000 * np.sin(2 * np.pi * 440 * t / 8000)).astype(np.int16)
    up = telephony.resample(tone, 8000, 16000)
    want = 8000 * np.sin(2 * np.pi * 440 * np.arange(8000) / 16000)
    assert len(up) == 8000 and np.abs(up - want)[50:-50].max() < 120
    down = telephony.resample(tone, 8000, 6000)
    want = 8000 * np.sin(2 * np.pi * 440 * np.arange(3000) / 6000)
    assert len(down) == 3000 and np.abs(down - want)[50:-50].max() < 400


def test_media_of_odd_rows(spark):
    df = docs(spark, ROWS)
    got = telephony.audio_digests(df).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert by[2].payload_bytes == telephony.BLOCK and by[2].n_bytes == 0 and by[2].payload_sha256 == by[3].payload_sha256
    assert by[4].payload_bytes % telephony.BLOCK == 0 and by[1].tail_crc32 == zlib.crc32(b" " * 16)
    pcm = telephony.store_pcm(telephony.store_media(df)).collect()
    assert all(telephony.from_wav(bytes(r.pcm))[:2] == ("pcm", 16000) for r in pcm) and len(pcm) == len(ROWS)
    assert telephony.audio_digests(df.limit(0)).count() == 0


def scalar_pcm(codec, data):
    if codec == "adpcm":
        return [v for at in range(0, len(data), 192) for v in one_block(data[at : at + 192])]
    out = []
    for byte in data:
        if codec == "mulaw":
            byte ^= 0xFF
            size = (((byte & 15) << 3) + 132 << (byte >> 4 & 7)) - 132
            out.append(-size if byte & 0x80 else size)
        else:
            byte ^= 0x55
            segment, size = byte >> 4 & 7, (byte & 15) * 16 + 8
            size = size if not segment else (size + 256) << (segment - 1)
            out.append(size if byte & 0x80 else -size)
    return out


def test_the_whole_row_against_a_plain_computation(spark, monkeypatch):
    pick = random.Random(11)
    rows = [(i, "".join(pick.choice("abc é日\n ") for _ in range(pick.choice([0, 1, 150, 191, 192, 193, 3000])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 400_000), (102, "x" * 400_000), (None, "no id ")]
    monkeypatch.setattr(telephony, "GROUP_BYTES", 5000)
    df = docs(spark, [(*r, None, None, None) for r in rows]).repartition(3)
    got = {(r.doc_id, r.n_bytes, r.payload_sha256): r for r in telephony.audio_digests(df).collect()}
    seen = set()
    for doc_id, text in rows:
        raw = (text or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        r = got[doc_id, len(raw), hashlib.sha256(payload).hexdigest()]
        codec = r.feature.split(";")[0]
        seen.add(codec)
        block, bits, tag = {"mulaw": (1, 8, 7), "alaw": (1, 8, 6), "adpcm": (192, 4, 17)}[codec]
        samples, bytes_a_second = (len(payload) // 192 * 377, 8000 * 192 // 377) if codec == "adpcm" else (len(payload), 8000)
        form = struct.pack("<HHIIHHH", tag, 1, 8000, bytes_a_second, block, bits, 2 if codec == "adpcm" else 0)
        form += struct.pack("<H", 377) if codec == "adpcm" else b""
        body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(payload)) + payload
        wav = b"RIFF" + struct.pack("<I", len(body)) + body
        assert (r.payload_bytes, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(payload), zlib.crc32(payload[-16:]), len(wav), hashlib.sha256(wav).hexdigest())
        pcm = scalar_pcm(codec, payload)
        rms = (sum(v * v for v in pcm) / len(pcm)) ** 0.5
        crossings = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:]))
        up = telephony.resample(np.array(pcm, np.int16), 8000, 16000)
        want = f"{codec};n={len(pcm)};peak={max(map(abs, pcm))};rms={rms:.3f};zc={crossings};pcm16000={len(up)}:{zlib.crc32(up.astype('<i2').tobytes()):08x}"
        assert r.feature == want
    assert seen == {"mulaw", "alaw", "adpcm"}


def test_bpe_digests_of_the_row(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = [(i, t) for i, t in enumerate(["a plain text", "", None, "é日本\n\n  two", "x" * 30_000, "<|endoftext|> it's"])]
    for r in bpe.round_trip(docs(spark, [(*r, None, None, None) for r in rows]), BYTE_BPE).collect():
        ids = library.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_bpe_equals_the_library():
    encoder, decoder = bpe.codec(BYTE_BPE)
    library = Tokenizer.from_file(BYTE_BPE)
    pick = random.Random(3)
    parts = ["a", "th", "er", " ", "  ", "\n", "'", "'s", "'re", "'ll", "!", "1", "２", "é", "日本", "\xa0", "　", "😀",
             "<|endoftext|>", "zx" * 30, "\t", "\x1c", "½", "_", "--", "́"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 15)))
        want = library.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert got.tolist() == want, text
        assert decoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_bpe_pieces_of_a_toy_vocabulary_need_backtracking():
    encoder, _ = bpe.codec(BYTE_BPE)
    pick = random.Random(9)
    for _ in range(300):
        piece = "".join(pick.choice("abcdethinos") for _ in range(pick.randint(1, 24)))
        assert encoder.encode_piece(piece) == encoder.vocabulary.merged(piece)


def test_bpe_of_odd_rows(spark):
    df = docs(spark, ROWS)
    coded = bpe.encode_documents(df, BYTE_BPE)
    back = {r.doc_id: r.text for r in bpe.decode_documents(coded, BYTE_BPE).collect()}
    assert back[4] == "é" * 5000 and back[2] == "" and back[None] == "no id"
    got = bpe.round_trip(df, BYTE_BPE).collect()
    assert len(got) == len(ROWS) and {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert bpe.round_trip(df.limit(0), BYTE_BPE).count() == 0


def test_shards_against_a_plain_count(spark):
    pick = random.Random(2)
    rows = [(i, "x" * pick.randint(0, 900), "", "", "") for i in range(500)] + ROWS
    got = sharding.shard_by_bytes(docs(spark, rows), shards=7).collect()
    ordered = sorted(
        ((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows),
        key=lambda r: (r[0], r[1], r[3], r[2]),
    )
    total, offset, slots, want = sum(r[2] for r in ordered), 0, {}, []
    for has, doc_id, size, crc in ordered:
        shard = min(6, (2 * offset + size) * 7 // (2 * total))
        want.append((doc_id if has else None, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        offset += size
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=str) == sorted(want, key=str)
    assert sharding.shard_by_bytes(docs(spark, rows).limit(0)).count() == 0
