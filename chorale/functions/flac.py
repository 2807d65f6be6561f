"""FLAC by its public format (RFC 9639): an encoder of mono 16-bit signals, and a decoder.

The encoder takes the fixed predictor with the least residual in each block, with one Rice parameter. The decoder reads
every kind of subframe and channel layout.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

BLOCK = 4096
#: The predictors' weights of the samples before, by order; bits per sample by code; block sizes by code.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
SAMPLE_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}
BLOCK_SIZES = {1: 192} | {c: 576 << (c - 2) for c in range(2, 6)} | {c: 256 << (c - 8) for c in range(8, 16)}


@cache
def _crc_table(polynomial: int, bits: int) -> list[int]:
    top, out = 1 << (bits - 1), []
    for i in range(256):
        crc = i << (bits - 8)
        for _ in range(8):
            crc = (crc << 1 ^ polynomial if crc & top else crc << 1) & ((1 << bits) - 1)
        out.append(crc)
    return out


def crc(data: bytes, polynomial: int, bits: int) -> int:
    table, value, mask = _crc_table(polynomial, bits), 0, (1 << bits) - 1
    for byte in data:
        value = (value << 8 & mask) ^ table[value >> (bits - 8) ^ byte]
    return value


def _number(n: int) -> bytes:
    """A frame's number, coded like UTF-8 but up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    more = (n.bit_length() + 3) // 5 - 1  # each byte after the first holds 6 bits, and takes one from the first
    while n >> (6 * more + 6 - more):
        more += 1
    first = (0xFF00 >> (more + 1) & 0xFF) | n >> (6 * more)
    return bytes([first, *(0x80 | n >> (6 * i) & 0x3F for i in range(more - 1, -1, -1))])


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, one after the other."""
    return (values.astype(np.int64)[:, None] >> np.arange(width - 1, -1, -1) & 1).astype(np.uint8).reshape(-1)


def _subframe(x: np.ndarray) -> np.ndarray:
    if (x == x[0]).all():
        return np.concatenate([_bits(np.array([0]), 8), _bits(x[:1], 16)])
    residuals = [x.astype(np.int64)]
    for _ in range(min(4, len(x) - 1)):
        residuals.append(np.diff(residuals[-1]))
    order = min(range(len(residuals)), key=lambda k: int(np.abs(residuals[k]).sum()) + 16 * k)
    folded = np.where(residuals[order] >= 0, 2 * residuals[order], -2 * residuals[order] - 1)
    k = min(14, max(0, int(folded.mean()).bit_length() - 1)) if len(folded) else 0
    quotient = folded >> k
    ends = np.cumsum(quotient + 1 + k)
    body = np.zeros(int(ends[-1]), np.uint8)
    one = ends - k - 1
    body[one] = 1
    for j in range(k):
        body[one + 1 + j] = folded >> (k - 1 - j) & 1
    head = [_bits(np.array([(8 | order) << 1]), 8), _bits(x[:order], 16), _bits(np.array([0]), 6), _bits(np.array([k]), 4)]
    return np.concatenate([*head, body])


def encode(samples: np.ndarray, rate: int) -> bytes:
    """``samples``: int16, one channel."""
    info = np.concatenate(
        [
            _bits(np.array([BLOCK, BLOCK]), 16), np.zeros(48, np.uint8), _bits(np.array([rate]), 20), _bits(np.array([0]), 3),
            _bits(np.array([15]), 5), _bits(np.array([len(samples)]), 36),
        ]
    )
    digest = hashlib.md5(samples.astype("<i2").tobytes()).digest()
    out = [b"fLaC\x80\x00\x00\x22", np.packbits(info).tobytes(), digest]
    for n, at in enumerate(range(0, len(samples), BLOCK)):
        x = samples[at : at + BLOCK]
        head = b"\xff\xf8\x70\x08" + _number(n) + (len(x) - 1).to_bytes(2, "big")
        head += bytes([crc(head, 0x07, 8)])
        frame = head + np.packbits(_subframe(x)).tobytes()
        out += [frame, crc(frame, 0x8005, 16).to_bytes(2, "big")]
    return b"".join(out)


class _Reader:
    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8)).tobytes()
        self.at = 0

    def take(self, n: int) -> int:
        value = int(self.bits[self.at : self.at + n].translate(_DIGITS) or b"0", 2)
        self.at += n
        return value

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def unary(self) -> int:
        end = self.bits.index(1, self.at)
        n, self.at = end - self.at, end + 1
        return n


_DIGITS = bytes([48, 49]) + bytes(range(2, 256))


def _residual(r: _Reader, size: int, order: int) -> list[int]:
    width = (4, 5)[r.take(2)]
    parts = 1 << r.take(4)
    out: list[int] = []
    for i in range(parts):
        n = size // parts - (order if i == 0 else 0)
        k = r.take(width)
        if k == (1 << width) - 1:
            raw = r.take(5)
            out += [r.signed(raw) for _ in range(n)]
            continue
        for _ in range(n):
            u = r.unary() << k | (r.take(k) if k else 0)
            out.append(u >> 1 ^ -(u & 1))
    return out


def _channel(r: _Reader, size: int, bits: int) -> np.ndarray:
    r.take(1)
    kind = r.take(6)
    wasted = r.unary() + 1 if r.take(1) else 0
    bits -= wasted
    if kind == 0:
        x = [r.signed(bits)] * size
    elif kind == 1:
        x = [r.signed(bits) for _ in range(size)]
    else:
        order = kind - 31 if kind >= 32 else kind - 8
        if not (8 <= kind <= 12 or kind >= 32):
            raise ValueError("not a kind of subframe")
        x = [r.signed(bits) for _ in range(order)]
        if kind >= 32:
            precision, shift = r.take(4) + 1, r.signed(5)
            weights = [r.signed(precision) for _ in range(order)]
        else:
            weights, shift = list(FIXED[order]), 0
        for e in _residual(r, size, order):
            x.append(e + (sum(w * x[-1 - i] for i, w in enumerate(weights)) >> shift))
    return np.array(x, np.int64) << wasted


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples from -1 to 1 of shape (samples, channels), and the rate."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, info = 4, False, 0
    while not last:
        last, kind, size = data[at] >> 7 == 1, data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        if kind == 0:
            info = int.from_bytes(data[at + 4 + 10 : at + 4 + 18], "big")
        at += 4 + size
    rate, bits = info >> 44, (info >> 36 & 0x1F) + 1
    r = _Reader(data[at:])
    blocks = []
    while r.at + 32 <= len(r.bits):
        start = r.at
        if r.take(15) != 0x7FFC:
            raise ValueError("a frame does not begin where it should")
        r.take(1)
        size_code, rate_code, layout, bit_code = r.take(4), r.take(4), r.take(4), r.take(3)
        r.take(1)
        first = r.take(8)
        for _ in range(max(0, 7 - (first ^ 0xFF).bit_length())):
            r.take(8)
        size = r.take(8) + 1 if size_code == 6 else r.take(16) + 1 if size_code == 7 else BLOCK_SIZES[size_code]
        r.take({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
        head = data[at + start // 8 : at + r.at // 8]
        if crc(head, 0x07, 8) != r.take(8):
            raise ValueError("a frame's header is damaged")
        own = SAMPLE_BITS.get(bit_code, bits)
        if layout < 8:
            channels = [_channel(r, size, own) for _ in range(layout + 1)]
        else:  # one of the two is a difference, which takes a bit more
            a, b = (_channel(r, size, own + (layout in wider)) for wider in ((9,), (8, 10)))
            if layout == 10:  # the mean has lost the last bit of the sum, which is that of the difference
                whole = 2 * a + (b & 1)
                channels = [(whole + b) >> 1, (whole - b) >> 1]
            else:
                channels = [a, a - b] if layout == 8 else [a + b, b]
        r.at += -r.at % 8
        frame = data[at + start // 8 : at + r.at // 8]
        if crc(frame, 0x8005, 16) != r.take(16):
            raise ValueError("a frame is damaged")
        blocks.append(np.stack(channels, axis=1) / float((1 << (own - 1)) - 1))
    return np.concatenate(blocks) if blocks else np.zeros((0, 1)), rate
