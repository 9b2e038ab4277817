"""Media columns: AVI files of motion JPEG held in binary columns.

``encode`` stores bytes losslessly.  The unit of the format is the quantised coefficient: a frame of 24 by 8 samples is three
blocks of 64 coefficients in zigzag order, and each coefficient is one byte of the payload, less ``BIAS`` so that letters are
small numbers.  Frames are ordinary baseline JPEGs: differences of DC coefficients, run-length codes of AC coefficients,
Huffman tables in the header.  ``frames`` parses the RIFF tree and the ``idx1`` index and decodes intra frames of any grey
baseline JPEG, all frames that share a header in step: coefficients exactly as stored, and samples by the inverse transform.
``clips`` finds shots in the samples: a cut is where the histogram of a frame differs from that of the frame before by more
than the mean plus three deviations of the differences just before it.

Each file is handled by one task with its neighbours, without shuffles; batches are bounded by bytes.  Empty or null
payloads become one frame of spaces; equal texts give equal files and features.  A long text is stored and decoded by groups of frames, so that
only its bytes and its file are held whole.  Sizes in a file are of 32 bits, as a cell of a table is: a text whose file would pass 2 GB raises.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, text_bytes, text_column

WIDE, HIGH = 24, 8
FRAME = WIDE * HIGH
BIAS = 96
FPS = 25
BINS = 16
STEP = 8192  # frames in work at a time
GROUP = 4 * STEP  # frames whose coefficients are held together

# Fixed values of the JPEG standard (ITU-T T.81, table K.3): luminance DC code counts by length, and their symbols.
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
DC_SYMBOLS = list(range(12))
# AC codes: four bits for the end of a block and for coefficients without zeros before them, nine bits for all others.
AC_SYMBOLS = [0, *range(1, 11), 0xF0, *(16 * run + size for run in range(1, 16) for size in range(1, 11))]
AC_COUNTS = [0, 0, 0, 11, 0, 0, 0, 0, len(AC_SYMBOLS) - 11, 0, 0, 0, 0, 0, 0, 0]


def zigzag() -> np.ndarray:
    """The natural place (row by row) of each coefficient in the order in which they are stored."""
    places = [(r, c) for r in range(8) for c in range(8)]
    return np.array([8 * r + c for r, c in sorted(places, key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))])


def inverse_transform() -> np.ndarray:
    """64 coefficients in zigzag order by 64 samples row by row."""
    x = np.arange(8)
    one = np.cos((2 * x[None] + 1) * x[:, None] * np.pi / 16) * np.where(x[:, None] == 0, np.sqrt(1 / 8), 0.5)
    return np.kron(one, one)[zigzag()].astype(np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


HEADER = (
    b"\xff\xd8"
    + _segment(0xDB, b"\x00" + bytes([1] * 64))
    + _segment(0xC0, struct.pack(">BHHB", 8, HIGH, WIDE, 1) + bytes([1, 0x11, 0]))
    + _segment(0xC4, b"\x00" + bytes(DC_COUNTS) + bytes(DC_SYMBOLS))
    + _segment(0xC4, b"\x10" + bytes(AC_COUNTS) + bytes(AC_SYMBOLS))
    + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
)


def huffman_codes(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """Symbol to (code, length), codes given out in order as the standard says."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            out[symbol] = (code, length)
            code += 1
        code, at = code << 1, at + n
    return out


def _lookup(counts: list[int], symbols: list[int]) -> np.ndarray:
    """For every 16 bits ahead: 256 times the length of the code they begin with (0: none), and its symbol."""
    out = np.zeros(1 << 16, np.int64)
    for s, (code, n) in huffman_codes(counts, symbols).items():
        low = code << (16 - n)
        out[low : low + (1 << (16 - n))] = n << 8 | s
    return out


def _by_symbol(counts: list[int], symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    codes, sizes = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for s, (code, n) in huffman_codes(counts, symbols).items():
        codes[s], sizes[s] = code, n
    return codes, sizes


#: Bits of magnitudes that a baseline coefficient or difference may have.
SIZES = np.array([k.bit_length() for k in range(1 << 12)], np.int64)


def _pack(bits: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of codes of at most 64 bits as rows of whole bytes, what is left of the last filled with ones; and how many bytes."""
    total = sizes.sum(axis=1)
    left = -total % 8
    bits, sizes = np.column_stack([bits, (1 << left) - 1]).astype(np.uint64), np.column_stack([sizes, left])
    length = (total + left) // 8
    wide = int(length.max()) // 8 + 2
    first = (np.cumsum(sizes, axis=1) - sizes + (np.arange(len(bits)) * wide * 64)[:, None]).ravel()
    bits, sizes = bits.ravel(), sizes.ravel()
    room = 64 - (first & 63) - sizes
    word = first >> 6
    begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    inside = np.where(room >= 0, bits << np.maximum(room, 0).astype(np.uint64), bits >> np.maximum(-room, 0).astype(np.uint64))
    words = np.zeros(len(total) * wide, np.uint64)
    words[word[begin]] = np.bitwise_or.reduceat(inside, begin)
    over = np.flatnonzero(room < 0)  # one code at most crosses each end of a word
    words[word[over] + 1] |= bits[over] << (64 + room[over]).astype(np.uint64)
    return words.byteswap().view(np.uint8).reshape(len(total), -1), length


def encode_frames(coefficients: np.ndarray) -> list[bytes]:
    """A JPEG for each row of coefficients, blocks of 64 in zigzag order."""
    if len(coefficients) > STEP:
        return [j for at in range(0, len(coefficients), STEP) for j in encode_frames(coefficients[at : at + STEP])]
    n_frames, wide = coefficients.shape
    values = coefficients.astype(np.int64).reshape(n_frames, wide // 64, 64)
    values[:, 1:, 0] -= coefficients.reshape(values.shape)[:, :-1, 0]
    values = values.reshape(-1, 64)
    (dc, dc_size), (ac, ac_size) = _by_symbol(DC_COUNTS, DC_SYMBOLS), _by_symbol(AC_COUNTS, AC_SYMBOLS)
    size = SIZES[np.abs(values)]
    extra = np.where(values >= 0, values, values + (1 << size) - 1)
    # as if no zeros came before: right for nearly all coefficients of a text
    bits, sizes = ac[size] << size | extra, ac_size[size] + size
    bits[:, 0], sizes[:, 0] = dc[size[:, 0]] << size[:, 0] | extra[:, 0], dc_size[size[:, 0]] + size[:, 0]
    zero = values == 0
    zero[:, 0] = False
    bits[zero], sizes[zero] = 0, 0
    last = 63 - np.argmin(zero[:, ::-1], axis=1)
    block, at = np.nonzero(~zero[:, 1:] & zero[:, :-1])
    if len(block):  # those after zeros
        at += 1
        before = np.maximum.accumulate(np.where(zero, 0, np.arange(64)), axis=1)
        run, own = at - 1 - before[block, at - 1], size[block, at]
        symbol = (run & 15) << 4 | own
        code, n = ac[symbol] << own | extra[block, at], ac_size[symbol] + own
        for k in range(1, 4):  # every sixteen zeros are a symbol of their own
            far = np.flatnonzero(run >> 4 >= k)
            code[far] |= ac[0xF0] << n[far]
            n[far] += ac_size[0xF0]
        bits[block, at], sizes[block, at] = code, n
    ended = np.flatnonzero(last < 63)
    bits[ended, last[ended]] = bits[ended, last[ended]] << ac_size[0] | ac[0]
    sizes[ended, last[ended]] += ac_size[0]
    packed, length = _pack(bits.reshape(n_frames, wide), sizes.reshape(n_frames, wide))
    return [HEADER + packed[i, : length[i]].tobytes().replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for i in range(n_frames)]


def encode_bytes(payload: np.ndarray) -> list[bytes]:
    """A JPEG for each row of FRAME bytes."""
    return encode_frames(payload.astype(np.int16) - BIAS)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) % 2)


def write_avi(jpegs: list[bytes], fps: int = FPS) -> bytes:
    """A RIFF file: header lists, the frames as ``00dc`` chunks, and the index."""
    wide, high = WIDE, HIGH
    most = max(map(len, jpegs))
    avih = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, len(jpegs), 0, 1, most, wide, high, 0, 0, 0, 0)
    strh = b"vids" + b"MJPG" + struct.pack("<IHHIIIIIIIIhhhh", 0, 0, 0, 0, 1, fps, 0, len(jpegs), most, 10_000, 0, 0, 0, wide, high)
    strf = struct.pack("<IiiHH", 40, wide, high, 1, 24) + b"MJPG" + struct.pack("<IiiII", wide * high * 3, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    movi, index, at = [], [], 4
    for jpeg in jpegs:
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(jpeg)))
        movi.append(_chunk(b"00dc", jpeg))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"movi" + b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def read_index(avi: bytes) -> tuple[float, list[tuple[int, int]]]:
    """Seconds a frame, and where each frame's JPEG begins and how long it is, from the file's index."""
    if avi[:4] != b"RIFF" or avi[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, end, seconds, movi, entries = 12, 8 + struct.unpack_from("<I", avi, 4)[0], 1 / FPS, None, []
    while at + 8 <= end:
        name, size = avi[at : at + 4], struct.unpack_from("<I", avi, at + 4)[0]
        kind = avi[at + 8 : at + 12]
        if name == b"LIST" and kind == b"hdrl":
            seconds = struct.unpack_from("<I", avi, at + 20)[0] / 1e6
        elif name == b"LIST" and kind == b"movi":
            movi = at + 8
        elif name == b"idx1":
            entries = [struct.unpack_from("<4sIII", avi, at + 8 + 16 * i) for i in range(size // 16)]
        at += 8 + size + size % 2
    return seconds, [(movi + offset + 8, length) for name, _, offset, length in entries if name[2:] == b"dc"]



@dataclass
class Header:
    """What the segments before a scan say: size in samples, quantiser steps in zigzag order, code tables, restart interval."""

    wide: int
    high: int
    steps: np.ndarray
    dc: np.ndarray
    ac: np.ndarray
    restart: int

    @property
    def blocks(self) -> int:
        return -(-self.wide // 8) * -(-self.high // 8)


def read_header(jpeg: bytes) -> tuple[bytes, int]:
    """All segments before the scan, and where the scan begins."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at = 2
    while True:
        if jpeg[at] != 0xFF:
            raise ValueError("a marker is expected")
        if jpeg[at + 1] == 0xFF:  # fill bytes may stand before a marker
            at += 1
            continue
        marker = jpeg[at + 1]
        at += 2 + struct.unpack_from(">H", jpeg, at + 2)[0]
        if marker == 0xDA:
            return jpeg[2:at], at


def parse_header(segments: bytes) -> Header:
    """Grey baseline frames alone: eight bits a sample, one component, one scan."""
    at, wide, high, restart = 0, 0, 0, 0
    quantisers: dict[int, np.ndarray] = {}
    codes: dict[tuple[int, int], np.ndarray] = {}
    wanted, chosen = 0, (0, 0)
    while at < len(segments):
        if segments[at + 1] == 0xFF:
            at += 1
            continue
        marker, size = segments[at + 1], struct.unpack_from(">H", segments, at + 2)[0]
        body = segments[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                width = 1 + (body[0] >> 4)
                quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * width], np.uint8 if width == 1 else ">u2").astype(np.int64)
                body = body[1 + 64 * width :]
        elif marker in (0xC0, 0xC1):
            bits, high, wide, components = struct.unpack_from(">BHHB", body)
            if bits != 8 or components != 1:
                raise ValueError("one component of eight bits is expected")
            wanted = body[8]
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("a baseline frame is expected")
        elif marker == 0xC4:
            while body:
                counts = list(body[1:17])
                codes[body[0] >> 4, body[0] & 15] = _lookup(counts, list(body[17 : 17 + sum(counts)]))
                body = body[17 + sum(counts) :]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            chosen = body[2] >> 4, body[2] & 15
        at += 2 + size
    return Header(wide, high, quantisers[wanted], codes[0, chosen[0]], codes[1, chosen[1]], restart)


def _scans(jpeg: bytes, at: int, header: Header) -> list[bytes]:
    """The entropy-coded bytes of each restart interval, stuffing taken out."""
    end = jpeg.rindex(b"\xff\xd9")
    data, out, begin = jpeg[at:end], [], 0
    if header.restart:
        for k in range(len(data) - 1):
            if data[k] == 0xFF and 0xD0 <= data[k + 1] <= 0xD7:
                out.append(data[begin:k])
                begin = k + 2
    out.append(data[begin:])
    return [x.replace(b"\xff\x00", b"\xff") for x in out]


def _decode_scans(scans: list[bytes], blocks: np.ndarray, header: Header) -> np.ndarray:
    """Quantised coefficients of all scans, one after the other, all scans decoded in step."""
    size = max(map(len, scans)) + 8
    padded = np.frombuffer(b"".join(s.ljust(size, b"\x00") for s in scans), np.uint8).astype(np.int64)
    ahead = padded << 32
    for k in range(1, 5):
        ahead[:-k] |= padded[k:] << (8 * (4 - k))
    codes = np.concatenate([header.dc, header.ac])
    first = np.concatenate([[0], np.cumsum(blocks)]) * 64
    out = np.zeros(int(first[-1]), np.int64)
    bit, limit = np.arange(len(scans)) * size * 8, (np.arange(len(scans)) + 1) * size * 8 - 40
    at, end, last = first[:-1].copy(), first[1:], np.zeros(len(scans), np.int64)
    live = np.flatnonzero(at < end)
    bit, at, end, last, limit = bit[live], at[live], end[live], last[live], limit[live]
    while len(at):
        is_ac = (at & 63) > 0
        word = ahead[bit >> 3] >> (24 - (bit & 7))
        found = codes[(word & 0xFFFF) + (is_ac.astype(np.int64) << 16)]
        length, symbol = found >> 8, found & 255
        if not length.all() or (bit > limit).any():
            raise ValueError("no such code")
        bit += length
        own = symbol & 15
        extra = (ahead[bit >> 3] >> (40 - own - (bit & 7))) & ((1 << own) - 1)
        bit += own
        value = np.where(extra < (1 << own) >> 1, extra - (1 << own) + 1, extra)
        run = np.where(is_ac, symbol >> 4, 0)
        last = np.where(is_ac, last, last + value)
        to = at + run
        stop = is_ac & (symbol == 0)
        put = ~stop & (~is_ac | (own > 0))
        out[to[put]] = np.where(is_ac, value, last)[put]
        at = np.where(stop, (at | 63) + 1, to + 1)
        if (at > end).any():
            raise ValueError("a block is too long")
        if (at == end).any():
            live = np.flatnonzero(at < end)
            bit, at, end, last, limit = bit[live], at[live], end[live], last[live], limit[live]
    return out


def decode_coefficients(jpegs: list[bytes]) -> list[tuple[Header, np.ndarray]]:
    """Of each frame its header and its quantised coefficients, a row for each block; frames with one header go in step."""
    found: list = [None] * len(jpegs)
    alike: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for i, jpeg in enumerate(jpegs):
        segments, at = read_header(jpeg)
        alike[segments].append((i, at))
    for segments, members in alike.items():
        header = parse_header(segments)
        most = max(1, STEP * 3 // max(header.blocks, 1))
        for k in range(0, len(members), most):
            part = members[k : k + most]
            scans = [_scans(jpegs[i], at, header) for i, at in part]
            blocks = [min(header.restart or header.blocks, header.blocks - k * header.restart) for own in scans for k in range(len(own))]
            values = _decode_scans([s for own in scans for s in own], np.array(blocks, np.int64), header).reshape(len(part), header.blocks, 64)
            for (i, _), own in zip(part, values, strict=True):
                found[i] = (header, own)
    return found


def samples_of(header: Header, coefficients: np.ndarray) -> np.ndarray:
    """Frames by rows by columns of samples, from frames by blocks by coefficients."""
    n = len(coefficients)
    flat = (coefficients * header.steps).astype(np.float32).reshape(-1, 64) @ inverse_transform()
    down, across = -(-header.high // 8), -(-header.wide // 8)
    rows = np.clip(np.rint(flat) + 128, 0, 255).astype(np.uint8).reshape(n, down, across, 8, 8)
    return rows.transpose(0, 1, 3, 2, 4).reshape(n, down * 8, across * 8)[:, : header.high, : header.wide]


def decode_frames(jpegs: list[bytes]) -> list[np.ndarray]:
    """The samples of each frame, rows by columns."""
    return [samples_of(header, own[None])[0] for header, own in decode_coefficients(jpegs)]


def frames(avi: bytes) -> tuple[float, list[np.ndarray]]:
    """Seconds a frame, and the samples of all frames of a file."""
    seconds, places = read_index(avi)
    return seconds, decode_frames([avi[a : a + n] for a, n in places])


def shots(histograms: np.ndarray, span: int = 8, deviations: float = 3.0, least: float = 0.5) -> list[int]:
    """The frames that begin a shot, from each frame's histogram; the threshold follows the last ``span`` differences."""
    change = np.abs(np.diff(histograms, axis=0)).sum(axis=1)
    total, square = (np.concatenate([[0.0], np.cumsum(x)]) for x in (change, change**2))
    at = np.arange(len(change))
    low = np.maximum(at - span, 0)
    held = np.maximum(at - low, 1)
    mean = (total[at] - total[low]) / held
    spread = np.sqrt(np.maximum((square[at] - square[low]) / held - mean**2, 0))
    return [0, *(np.flatnonzero(change > np.maximum(mean + deviations * spread, least)) + 1).tolist()]


def histograms(samples: np.ndarray) -> np.ndarray:
    """Shares of BINS levels of brightness in each frame (frames by samples)."""
    n = len(samples)
    counts = np.bincount((np.arange(n)[:, None] * BINS + (samples >> 4)).ravel(), minlength=n * BINS).reshape(n, BINS)
    return counts / samples.shape[1]


def clip_rows(levels: np.ndarray, means: np.ndarray, seconds: float) -> list[dict]:
    """Timed clips, one for each shot, from the frames' histograms and mean samples."""
    begin = shots(levels)
    end = [*begin[1:], len(levels)]
    return [{"clip": k, "begin_s": round(a * seconds, 6), "end_s": round(b * seconds, 6), "n_frames": b - a, "mean": round(float(means[a:b].mean()), 6)} for k, (a, b) in enumerate(zip(begin, end, strict=True))]


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[bytes]]]:
    for batch in slices(batches):
        raw, offsets = text_bytes(batch.column("text"))
        sizes = np.diff(offsets)
        counts = np.maximum(-(-sizes // FRAME), 1)
        first = np.concatenate([[0], np.cumsum(counts)])
        payload = np.full(int(first[-1]) * FRAME, 32, np.uint8)
        payload[np.arange(len(raw)) + np.repeat(first[:-1] * FRAME - offsets[:-1], sizes)] = raw
        shown, jpegs = payload.reshape(-1, FRAME), []
        for at in range(0, len(shown), GROUP):
            jpegs += encode_bytes(shown[at : at + GROUP])
        yield batch, sizes, [write_avi(jpegs[a:b]) for a, b in zip(first, first[1:], strict=False)]


def encode(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, avi``: each whole text as a motion-JPEG file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sizes, files in _stored(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "avi"])

    return text_column(docs).mapInArrow(run, "doc_id long, n_bytes long, avi binary")


CLIPS = "array<struct<clip:int,begin_s:double,end_s:double,n_frames:int,mean:double>>"
_CLIPS = pa.list_(pa.struct([("clip", pa.int32()), ("begin_s", pa.float64()), ("end_s", pa.float64()), ("n_frames", pa.int32()), ("mean", pa.float64())]))


def _brightness(header: Header, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Histogram and mean sample of every frame, a bounded number of frames at a time."""
    levels, means = np.zeros((len(values), BINS)), np.zeros(len(values))
    for at in range(0, len(values), STEP):
        samples = samples_of(header, values[at : at + STEP]).reshape(len(values[at : at + STEP]), -1)
        levels[at : at + STEP], means[at : at + STEP] = histograms(samples), samples.mean(axis=1)
    return levels, means


def read_back(media: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, payload, media_bytes, media_sha256, clips`` from the stored files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "avi"):
            files = batch.column("avi").to_pylist()
            found = [read_index(f) for f in files]
            shown = [(f, a, n) for f, (_, places) in zip(files, found, strict=True) for a, n in places]
            payload, levels, means = [], [], []
            for at in range(0, len(shown), GROUP):  # what is decoded is bounded, however long a text is
                stored = decode_coefficients([f[a : a + n] for f, a, n in shown[at : at + GROUP]])
                header, values = stored[0][0], np.stack([own for _, own in stored])  # all of them are of ``encode``
                payload.append((values.reshape(len(values), -1) + BIAS).astype(np.uint8))
                for kept, part in zip((levels, means), _brightness(header, values), strict=True):
                    kept.append(part)
            payload, levels, means = (np.concatenate(x) for x in (payload, levels, means))
            first = np.concatenate([[0], np.cumsum([len(places) for _, places in found])])
            parts = [slice(a, b) for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array([payload[p].tobytes() for p in parts], pa.binary()),
                    pa.array([len(f) for f in files], pa.int64()),
                    pa.array([hashlib.sha256(f).hexdigest() for f in files]),
                    pa.array([clip_rows(levels[p], means[p], seconds) for p, (seconds, _) in zip(parts, found, strict=True)], _CLIPS),
                ],
                ["doc_id", "n_bytes", "payload", "media_bytes", "media_sha256", "clips"],
            )

    return media.mapInArrow(run, f"doc_id long, n_bytes long, payload binary, media_bytes long, media_sha256 string, clips {CLIPS}")


def clips(media: DataFrame) -> DataFrame:
    """One row per shot of each stored file."""
    return read_back(media).select("doc_id", "clips").selectExpr("doc_id", "inline(clips)")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with the sizes and hashes of what was stored and read back, and a feature of its shots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                    pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                    batch.column("media_bytes"),
                    batch.column("media_sha256"),
                    pa.array([f"{len(c)}:" + ",".join(f"{x['n_frames']}@{x['mean']:.3f}" for x in c) for c in batch.column("clips").to_pylist()]),
                ],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return read_back(encode(docs)).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
