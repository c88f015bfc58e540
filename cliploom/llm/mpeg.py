"""MPEG audio columns: frames, tags, variable-bitrate tables, checksums, durations and seek offsets.

``parse`` walks the bytes of a stream: frames of ID3v2 and fields of ID3v1 tags are read, frame headers are found again
after damage, free-format frames are measured by the distance of their headers, a Xing/Info or VBRI table in the first
frame is read with its seek points, checksums of protected frames of all three layers are verified, and the byte offset of
every frame is kept. Durations are exact: samples and rate, not bitrate.

``encode`` stores any payload without loss as a Layer III stream between tags, whose frames carry 192 payload bytes each
behind a checksummed header and side information; ``payload`` reads it back.

Defined cases: null or empty bytes, and bytes without a frame, give no frames, a duration of 0 and no offsets; a
frame cut off by the end counts as truncated and is not a frame; tags that are cut off or misstate their sizes are read as
far as they go; repeated rows give repeated results; an empty table gives no rows; other columns pass through unless they
bear the name of an added one; a very long text or stream is held whole by one task.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the format: kbit/s by index 1 to 14, sampling rates, samples a frame.
BITRATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
POLYNOMIAL = 0x8005
# Bits of the allocation of Layer II by subband, in runs: two tables for many bits a channel, two for few, one for low rates.
ALLOCATION = {
    "a": ((4, 11), (3, 12), (2, 4)), "b": ((4, 11), (3, 12), (2, 7)), "c": ((4, 2), (3, 6)), "d": ((4, 2), (3, 10)), "low": ((4, 4), (3, 7), (2, 19)),
}
ID3V1 = (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97), ("comment", 97, 127))
ENCODINGS = ("latin-1", "utf-16", "utf-16-be", "utf-8")

#: Payload bytes of a frame, and a whole frame of 80 kbit/s at 48 kHz: header 4, checksum 2, side information 17, payload, filler.
UNIT, FRAME, SIDE = 192, 240, 17
FILLER = 32
#: Between seek points of the feature, in frames.
SEEK_EVERY = 64

COLUMNS = (
    "frames int, samples long, sample_rate int, duration_ms long, channels int, bitrate_kbps double, variable boolean,"
    " table_frames int, table_bytes long, table_seeks array<long>, id3v2_bytes int, id3v1 boolean, tags map<string,string>, skipped_bytes long, crc_checked int, crc_failed int, truncated boolean, offsets array<long>"
)


@lru_cache(4096)
def header(word: int) -> tuple | None:
    """Of a 32-bit header: version, layer, protected, kbit/s, rate, frame bytes, samples, mono, padding bytes and mode.
    None if it isn't one; a free-format header states 0 kbit/s and only its padding for frame bytes."""
    if word >> 21 != 0x7FF:
        return None
    version = {0: 2.5, 2: 2, 3: 1}.get(word >> 19 & 3)
    layer = {1: 3, 2: 2, 3: 1}.get(word >> 17 & 3)
    at, rate = word >> 12 & 15, word >> 10 & 3
    if version is None or layer is None or at == 15 or rate == 3 or word & 3 == 2:
        return None
    kbps = BITRATES[1 if version == 1 else 2, layer if version == 1 or layer == 1 else 2][at - 1] if at else 0
    hz, pad = RATES[version][rate], word >> 9 & 1
    if layer == 1:
        size, samples, pad = (12000 * kbps // hz + pad) * 4, 384, pad * 4
    else:
        samples = 576 if layer == 3 and version != 1 else 1152
        size = samples * 125 * kbps // hz + pad
    return version, layer, not word >> 16 & 1, kbps, hz, size, samples, word >> 6 & 3 == 3, pad, word >> 4 & 15


def _free_bytes(data: bytes, at: int, end: int, h: tuple) -> int | None:
    """Frame bytes without padding of a free-format stream: up to the next header like this one."""
    q = at + 4
    while (q := data.find(data[at : at + 1], q, min(end, at + 8192))) >= 0:
        n = header(int.from_bytes(data[q : q + 4], "big")) if q + 4 <= end else None
        if n and n[:2] == h[:2] and n[3] == 0 and n[4] == h[4]:
            return q - at - h[8]
        q += 1
    return None


@lru_cache(1)
def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32) << 8
    for _ in range(8):
        x = np.where(x & 0x8000, (x << 1) ^ POLYNOMIAL, x << 1) & 0xFFFF
    return x


def crc16(rows: np.ndarray) -> np.ndarray:
    """The format's checksum of every row of bytes."""
    table, out = _crc_table(), np.full(len(rows), 0xFFFF, np.uint32)
    for k in range(rows.shape[1]):
        out = (out << 8 & 0xFFFF) ^ table[(out >> 8 ^ rows[:, k]) & 0xFF]
    return out


def _side(version: float, mono: bool) -> int:
    return (17 if mono else 32) if version == 1 else (9 if mono else 17)


def _synchsafe(b: bytes) -> int:
    return (b[0] & 127) << 21 | (b[1] & 127) << 14 | (b[2] & 127) << 7 | b[3] & 127


def _text(raw: bytes) -> str:
    """A text frame's value: an encoding and characters, up to a null."""
    code = ENCODINGS[raw[0]] if raw and raw[0] < len(ENCODINGS) else "latin-1"
    return raw[1:].decode(code, "replace").split("\0")[0].strip()


def id3v2(tag: bytes) -> dict[str, str]:
    """Text frames of a tag, by their identifiers."""
    version, flags, body = tag[3], tag[5], tag[10:]
    if flags & 128 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    name, head = (3, 6) if version == 2 else (4, 10)
    at, out = 0, {}
    if flags & 64 and version > 2 and len(body) >= 4:
        at = _synchsafe(body) if version == 4 else 4 + int.from_bytes(body[:4], "big")
    while at + head <= len(body) and body[at]:
        size = _synchsafe(body[at + 4 : at + 8]) if version == 4 else int.from_bytes(body[at + name : at + 2 * name], "big")
        raw = body[at + head : at + head + size]
        if body[at] == ord("T"):
            out.setdefault(body[at : at + name].decode("latin-1"), _text(raw))
        at += head + size
    return out


def id3v1(tag: bytes) -> dict[str, str]:
    """Fields of the 128 bytes at a stream's end."""
    found = {f"id3v1.{name}": tag[a:b].split(b"\0")[0].decode("latin-1").strip() for name, a, b in ID3V1}
    return {k: v for k, v in found.items() if v}


def parse(data: bytes | None) -> dict:
    data = bytes(data or b"")
    end, at, tags = len(data), 0, {}
    while data[at : at + 3] == b"ID3" and at + 10 <= end:
        size = _synchsafe(data[at + 6 : at + 10])
        tags = id3v2(data[at : at + 10 + size]) | tags
        at += 10 + size + 10 * bool(data[at + 5] & 16)
    tag = min(at, end)
    last = end - tag >= 128 and data[end - 128 : end - 125] == b"TAG"
    if last:
        tags |= id3v1(data[end - 128 : end])
        end -= 128
    offsets: list[int] = []
    heads: list[tuple] = []
    sizes: list[int] = []
    free: int | None = None
    skipped, table, truncated, at, synced = 0, None, False, tag, False
    word_at = struct.Struct(">I").unpack_from
    while at + 4 <= end:
        h = header(word_at(data, at)[0])
        size = h[5] if h else 0
        # what differs from the stream so far is no better than what stands behind damage
        synced = synced and not (h and heads and (h[:2] != heads[-1][:2] or h[4] != heads[-1][4]))
        if h and not h[3]:
            free = free or _free_bytes(data, at, end, h)
            h, size = (h, free + h[8]) if free else (None, 0)
        if h and at + size > end:
            truncated, h = True, None
        elif h and not synced:  # a header is believed when another follows, or the stream ends there
            follows = at + size
            nxt = header(word_at(data, follows)[0]) if follows + 4 <= end else None
            if follows + 4 <= end and not (nxt and nxt[:2] == h[:2] and nxt[4] == h[4]):
                h = None
        if h is None:
            found = data.find(b"\xff", at + 1, end)
            found = end if found < 0 else found
            skipped, at, synced = skipped + found - at, found, False
            continue
        truncated = False
        if not offsets and not synced and (t := _table(data, at, h, size)) is not None:
            table = t
        else:
            offsets.append(at)
            heads.append(h)
            sizes.append(size)
        synced = True
        at += size
    skipped += end - at if at < end else 0
    checked, failed = _verify(data, offsets, heads, sizes)
    samples = sum(h[6] for h in heads)
    hz = heads[0][4] if heads else 0
    return {
        "frames": len(heads), "samples": samples, "sample_rate": hz, "duration_ms": 1000 * samples // hz if hz else 0,
        "channels": (1 if heads[0][7] else 2) if heads else 0, "bitrate_kbps": sum(sizes) * 8 * hz / samples / 1000 if samples else 0.0,
        "variable": len({h[3] for h in heads}) > 1, "table_frames": table and table[0], "table_bytes": table and table[1],
        "table_seeks": table[2] if table else [], "id3v2_bytes": tag, "id3v1": last, "tags": tags,
        "skipped_bytes": skipped, "crc_checked": checked, "crc_failed": failed, "truncated": truncated, "offsets": offsets,
    }


def _table(data: bytes, at: int, h: tuple, size: int) -> tuple[int, int | None, list[int]] | None:
    """Of a Xing, Info or VBRI table in this frame, which only Layer III has: frames and bytes that it states (-1 and None where it doesn't), and the
    stream's offsets at its seek points. None without a table."""
    if h[1] != 3:
        return None
    here, frame = 4 + 2 * h[2] + _side(h[0], h[7]), data[at : at + size]
    if frame[here : here + 4] in (b"Xing", b"Info") and len(frame) >= here + 8:
        flags, here = frame[here + 7], here + 8
        frames = total = None
        if flags & 1:
            frames, here = int.from_bytes(frame[here : here + 4], "big"), here + 4
        if flags & 2:
            total, here = int.from_bytes(frame[here : here + 4], "big"), here + 4
        points = frame[here : here + 100] if flags & 4 and total is not None else b""
        return -1 if frames is None else frames, total, [at + p * total // 256 for p in points]
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        total, frames, entries, scale, width, _ = struct.unpack_from(">IIHHHH", frame, 46)
        seeks, upto = [], at + size
        for k in range(entries):
            seeks.append(upto)
            upto += scale * int.from_bytes(frame[62 + k * width : 62 + (k + 1) * width], "big")
        return frames, total, seeks
    return None


def _crc_bits(raw: bytes, bits: int, crc: int = 0xFFFF) -> int:
    """The checksum of as many bits, the first ones of raw."""
    for k in range(bits):
        top = (crc >> 15 ^ raw[k >> 3] >> (7 - (k & 7))) & 1
        crc = (crc << 1 & 0xFFFF) ^ (POLYNOMIAL if top else 0)
    return crc


def _protected_bits(h: tuple, body: bytes) -> int:
    """Bits behind the checksum of a Layer I or II frame that it covers: allocations, and in Layer II what selects scale factors."""
    version, layer, _, kbps, hz, *_, mono, _, mode = h
    channels = 1 if mono else 2
    bound = 4 * (1 + (mode & 3)) if mode >> 2 == 1 else 32
    if layer == 1:
        return 4 * (bound * channels + 32 - bound)
    each = kbps // channels
    if version != 1:
        name = "low"
    elif (hz == 48000 and each >= 56) or 56 <= each <= 80:
        name = "a"
    elif hz != 48000 and each >= 96:
        name = "b"
    else:
        name = "c" if hz != 32000 else "d"
    word, left, used, at = int.from_bytes(body, "big"), 8 * len(body), 0, 0
    subband = 0
    for bits, n in ALLOCATION[name]:
        for _ in range(n):
            for _ in range(channels if subband < bound else 1):
                at += bits
                set_ = word >> (left - at) & ((1 << bits) - 1) if at <= left else 0
                used += bool(set_) * (1 if subband < bound else channels)
            subband += 1
    return min(left, at + 2 * used)


def _verify(data: bytes, offsets: list[int], heads: list[tuple], sizes: list[int]) -> tuple[int, int]:
    """Protected frames, and those whose checksum fails: of header and side information in Layer III, else of header and
    allocations."""
    all_ = np.frombuffer(data, np.uint8)
    checked = failed = 0
    rows = [(o, h, n) for o, h, n in zip(offsets, heads, sizes, strict=True) if h[2]]
    for side in {_side(h[0], h[7]) for _, h, _ in rows if h[1] == 3}:
        at = np.array([o for o, h, n in rows if h[1] == 3 and _side(h[0], h[7]) == side and n >= 6 + side])
        if len(at):
            covered = all_[at[:, None] + np.array([2, 3, *range(6, 6 + side)])]
            stated = all_[at + 4].astype(np.uint32) << 8 | all_[at + 5]
            checked += len(at)
            failed += int((crc16(covered) != stated).sum())
    for o, h, n in rows:
        if h[1] < 3 and n > 6:
            body = data[o + 6 : o + n]
            bits = min(_protected_bits(h, body), 8 * len(body))
            checked += 1
            failed += _crc_bits(body, bits, _crc_bits(data[o + 2 : o + 4], 16)) != int.from_bytes(data[o + 4 : o + 6], "big")
    return checked, failed


def encode(payload: bytes) -> bytes:
    """A stream between an ID3v2 tag, which states its length in ms, and an ID3v1 tag: one Info frame with seek points and a
    frame for every UNIT bytes; payload must be a positive multiple of UNIT."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    n = len(rows)
    out = np.zeros((n + 1, FRAME), np.uint8)
    out[:, :4] = (0xFF, 0xFA, 0x64, 0xC0)  # version 1, layer III, protected, 80 kbit/s, 48 kHz, mono
    # side information: no reservoir, all payload bits in the first granule
    bits = UNIT * 8 << (SIDE * 8 - 9 - 5 - 4 - 12)
    out[1:, 6 : 6 + SIDE] = np.frombuffer(bits.to_bytes(SIDE, "big"), np.uint8)
    out[1:, 6 + SIDE : 6 + SIDE + UNIT] = rows
    info = b"Info" + struct.pack(">III", 7, n, (n + 1) * FRAME) + bytes(256 * (1 + n * k // 100) // (n + 1) for k in range(100))
    out[0, 6 + SIDE : 6 + SIDE + len(info)] = np.frombuffer(info, np.uint8)
    crc = crc16(out[:, [2, 3, *range(6, 6 + SIDE)]])
    out[:, 4], out[:, 5] = crc >> 8, crc & 0xFF
    length = b"\3" + str(1000 * 1152 * n // 48000).encode()
    frame = b"TLEN" + struct.pack(">I", len(length)) + b"\0\0" + length
    return b"ID3\4\0\0" + bytes([0, 0, 0, len(frame)]) + frame + out.tobytes() + b"TAG" + b"text".ljust(30, b"\0") + bytes(95)


def damaged(media: bytes, offsets: list[int]) -> bytes:
    """A stream of encode() with a wrong bit in a frame that a hash of it picks, and noise that looks like a header behind it."""
    at = offsets[zlib.crc32(media) % len(offsets)]
    return media[: at + 8] + bytes([media[at + 8] ^ 1]) + media[at + 9 : at + FRAME] + b"\xff\xfb\x90noise" + media[at + FRAME :]


def payload(data: bytes, offsets: list[int]) -> bytes:
    """What the frames at these offsets carry."""
    all_ = np.frombuffer(data, np.uint8)
    at = np.asarray(offsets, np.int64) + 6 + SIDE
    return all_[at[:, None] + np.arange(UNIT)].tobytes() if len(at) else b""


def media_columns(df: DataFrame, column: str = "media") -> DataFrame:
    """Adds what parse() finds in a binary column."""
    added = T._parse_datatype_string(COLUMNS)
    kept = [c for c in df.columns if c not in added.fieldNames()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([parse(x) for x in batch[column]], columns=added.fieldNames(), index=batch.index)
            found["table_frames"] = found["table_frames"].astype("Int32")
            found["table_bytes"] = found["table_bytes"].astype("Int64")
            yield pd.concat([batch[kept], found], axis=1)

    return df.select(*kept).mapInPandas(run, T.StructType([*(df.schema[c] for c in kept), *added]))


DIGEST = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string,"
    " table_frames int, tag_ms long, resynced boolean"
)


def stored_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Each text as UTF-8, filled up with blanks to a positive multiple of UNIT, is stored as a stream, read back and
    digested, one row at a time: neither payloads nor streams leave the task. feature: duration in ms, frames, failed
    checksums and a hash of the seek offsets of every SEEK_EVERY-th frame and of the table's seek points; then what the
    table and the tag state, and whether a damaged copy of the stream still gives all frames, with one failed checksum."""
    added = T._parse_datatype_string(DIGEST)
    kept = [c for c in df.columns if c not in added.fieldNames() and c != text]

    def one(value: str | None) -> tuple:
        raw = (value or "").encode("utf-8", "surrogatepass")
        media = encode(raw + bytes([FILLER]) * (-len(raw) % UNIT or UNIT * (not raw)))
        found = parse(media)
        back = payload(media, found["offsets"])
        seeks = [*found["offsets"][::SEEK_EVERY], *found["table_seeks"]]
        seek = zlib.crc32(struct.pack(f">{len(seeks)}Q", *seeks))
        feature = f"ms={found['duration_ms']};frames={found['frames']};crc_failed={found['crc_failed']};seek={seek:08x}"
        again = parse(damaged(media, found["offsets"]))
        whole = again["frames"] == found["frames"] and again["crc_failed"] == 1 and again["skipped_bytes"] == 8
        digests = len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest()
        return *digests, feature, found["table_frames"], int(found["tags"]["TLEN"]), whole

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([one(x) for x in batch[text]], columns=added.fieldNames(), index=batch.index)
            yield pd.concat([batch[kept], found], axis=1)

    return df.select(*kept, text).mapInPandas(run, T.StructType([*(df.schema[c] for c in kept), *added]))
