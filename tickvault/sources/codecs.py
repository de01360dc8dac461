"""Block codecs of time-structured storage files, both ways: the encoders make the fixtures of the tests and the exports.

Integers are big-endian. A block is `type, length of times (uvarint), times, values`; in times and integers the high
half of the first byte tells the encoding and the low half the power of ten that deltas were divided by.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

FLOAT, INTEGER, BOOLEAN, STRING, UNSIGNED = range(5)
RAW, PACKED, RUN = 0, 1, 2
MASK = (1 << 64) - 1
#: (values a word, bits a value) by selector; the first two are runs of ones. Fixed values.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
#: The number that ends a float block.
END_OF_FLOATS = 0x7FF8000000000001


class Corrupt(ValueError):
    pass


def uvarint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_uvarint(data, at: int) -> tuple[int, int]:
    """(value, where it ends)."""
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise Corrupt("cut short in a varint")
        b = data[at]
        value |= (b & 0x7F) << shift
        at += 1
        if b < 0x80:
            return value, at
        shift += 7


def zigzag(n: int) -> int:
    return (n << 1 ^ n >> 63) & MASK


def unzigzag(values):
    v = np.asarray(values, "u8")
    return ((v >> np.uint64(1)) ^ (np.uint64(0) - (v & np.uint64(1)))).view("i8")


def pack_words(values: list[int]) -> bytes | None:
    """64-bit words of as many small values as fit; None if a value has over 60 bits."""
    if any(v >> 60 for v in values):
        return None
    out, at = [], 0
    while at < len(values):
        for selector, (n, bits) in enumerate(SELECTORS):
            some = values[at : at + n]
            if len(some) == n and (all(v == 1 for v in some) if not bits else max(some) >> bits == 0):
                word = selector << 60
                for k, v in enumerate(some if bits else ()):
                    word |= v << (k * bits)
                out.append(word)
                at += n
                break
    return struct.pack(f">{len(out)}Q", *out)


def unpack_words(data: bytes):
    words = np.frombuffer(data, ">u8").astype("u8")
    parts = []
    for word, selector in zip(words, (words >> np.uint64(60)).astype(int)):
        n, bits = SELECTORS[selector]
        if not bits:
            parts.append(np.ones(n, "u8"))
        else:
            parts.append((word >> (np.arange(n, dtype="u8") * np.uint64(bits))) & np.uint64((1 << bits) - 1))
    return np.concatenate(parts) if parts else np.empty(0, "u8")


def encode_times(times: list[int]) -> bytes:
    deltas = [b - a for a, b in zip(times, times[1:])]
    if not times or min(deltas, default=0) < 0:
        return bytes([RAW << 4]) + b"".join(struct.pack(">Q", v & MASK) for v in ([times[0], *deltas] if times else []))
    power = 0
    while power < 12 and deltas and all(d % 10 ** (power + 1) == 0 for d in deltas):
        power += 1
    small = [d // 10**power for d in deltas]
    first = struct.pack(">Q", times[0] & MASK)
    if len(deltas) > 1 and len(set(deltas)) == 1:
        return bytes([RUN << 4 | power]) + first + uvarint(small[0]) + uvarint(len(times))
    packed = pack_words(small)
    if packed is None:
        return bytes([RAW << 4]) + first + b"".join(struct.pack(">Q", d) for d in deltas)
    return bytes([PACKED << 4 | power]) + first + packed


def decode_times(data: bytes):
    if not data:
        return np.empty(0, "i8")
    kind, scale = data[0] >> 4, 10 ** (data[0] & 15)
    if kind == RAW:
        return np.cumsum(np.frombuffer(data, ">u8", offset=1).astype("u8"), dtype="u8").view("i8")
    if kind == PACKED:
        first = np.frombuffer(data, ">u8", 1, 1).astype("u8")
        return np.cumsum(np.concatenate([first, unpack_words(data[9:]) * np.uint64(scale)]), dtype="u8").view("i8")
    if kind == RUN:
        (first,) = struct.unpack_from(">Q", data, 1)
        delta, at = read_uvarint(data, 9)
        n, _ = read_uvarint(data, at)
        return (np.uint64(first) + np.arange(n, dtype="u8") * np.uint64(delta * scale & MASK)).view("i8")
    raise Corrupt(f"times of encoding {kind}")


def encode_integers(values: list[int]) -> bytes:
    wrap = lambda n: (n + (1 << 63)) % (1 << 64) - (1 << 63)
    deltas = [zigzag(wrap(b - a)) for a, b in zip([0, *values], values)]
    if len(deltas) > 2 and len(set(deltas[1:])) == 1:
        return bytes([RUN << 4]) + struct.pack(">Q", deltas[0]) + uvarint(deltas[1]) + uvarint(len(values) - 1)
    packed = pack_words(deltas[1:])
    if packed is None:
        return bytes([RAW << 4]) + struct.pack(f">{len(deltas)}Q", *deltas)
    return bytes([PACKED << 4]) + struct.pack(">Q", deltas[0]) + packed


def decode_integers(data: bytes):
    if not data:
        return np.empty(0, "i8")
    kind = data[0] >> 4
    if kind == RAW:
        deltas = unzigzag(np.frombuffer(data, ">u8", offset=1).astype("u8"))
    elif kind == PACKED:
        deltas = unzigzag(np.concatenate([np.frombuffer(data, ">u8", 1, 1).astype("u8"), unpack_words(data[9:])]))
    elif kind == RUN:
        delta, at = read_uvarint(data, 9)
        n, _ = read_uvarint(data, at)
        deltas = unzigzag(np.concatenate([np.frombuffer(data, ">u8", 1, 1).astype("u8"), np.full(n, delta, "u8")]))
    else:
        raise Corrupt(f"integers of encoding {kind}")
    return np.cumsum(deltas.view("u8"), dtype="u8").view("i8")


def encode_floats(values: list[float]) -> bytes:
    """Each value as its difference in bits from the one before, within the window of bits last used if it fits."""
    bits: list[str] = []
    words = [struct.unpack(">Q", struct.pack(">d", v))[0] for v in values] + [END_OF_FLOATS]
    window = None
    for before, word in zip(words, words[1:]):
        x = before ^ word
        if not x:
            bits.append("0")
            continue
        lead, trail = min(64 - x.bit_length(), 31), (x & -x).bit_length() - 1
        if window and lead >= window[0] and trail >= window[1]:
            bits.append("10" + format(x >> window[1], f"0{64 - window[0] - window[1]}b"))
            continue
        window, n = (lead, trail), 64 - lead - trail
        bits.append("11" + format(lead, "05b") + format(n & 63, "06b") + format(x >> trail, f"0{n}b"))
    flat = "".join(bits)
    flat += "0" * (-len(flat) % 8)
    return b"\x10" + struct.pack(">Q", words[0]) + int("1" + flat, 2).to_bytes(len(flat) // 8 + 1, "big")[1:]


def decode_floats(data: bytes):
    if len(data) < 9:
        return np.empty(0, "f8")
    (word,) = struct.unpack_from(">Q", data, 1)
    if word == END_OF_FLOATS:
        return np.empty(0, "f8")
    out, lead, trail = [word], 0, 0
    # a window of the stream is kept as a small integer, so that long blocks stay linear
    chunk, have, at, raw = 0, 0, 9, data

    def take(n: int) -> int:
        nonlocal chunk, have, at
        while have < n:
            if at >= len(raw):
                raise Corrupt("cut short in floats")
            chunk, have, at = chunk << 8 | raw[at], have + 8, at + 1
        have -= n
        value = chunk >> have
        chunk &= (1 << have) - 1
        return value

    while True:
        if take(1):
            if take(1):
                lead, n = take(5), take(6) or 64
                trail = 64 - lead - n
            word ^= take(64 - lead - trail) << trail
            if word == END_OF_FLOATS:
                return np.array(out, "u8").view("f8")
        out.append(word)


def encode_booleans(values: list[bool]) -> bytes:
    return b"\x10" + uvarint(len(values)) + np.packbits(np.array(values, bool)).tobytes()


def decode_booleans(data: bytes):
    if not data:
        return np.empty(0, bool)
    n, at = read_uvarint(data, 1)
    return np.unpackbits(np.frombuffer(data, "u1", offset=at))[:n].astype(bool)


def snappy(data: bytes) -> bytes:
    return pa.compress(data, codec="snappy", asbytes=True)


def unsnappy(data: bytes) -> bytes:
    size, _ = read_uvarint(data, 0)
    return pa.decompress(data, decompressed_size=size, codec="snappy", asbytes=True) if size else b""


def encode_strings(values: list[bytes]) -> bytes:
    return b"\x10" + snappy(b"".join(uvarint(len(v)) + v for v in values))


def decode_strings(data: bytes) -> list[bytes]:
    if not data:
        return []
    flat, at, out = unsnappy(data[1:]), 0, []
    while at < len(flat):
        n, at = read_uvarint(flat, at)
        if at + n > len(flat):
            raise Corrupt("cut short in strings")
        out.append(flat[at : at + n])
        at += n
    return out


def encode_unsigned(values: list[int]) -> bytes:
    return encode_integers([v - (1 << 64) if v >> 63 else v for v in values])


ENCODE = {FLOAT: encode_floats, INTEGER: encode_integers, BOOLEAN: encode_booleans, STRING: encode_strings, UNSIGNED: encode_unsigned}
DECODE = {FLOAT: decode_floats, INTEGER: decode_integers, BOOLEAN: decode_booleans, STRING: decode_strings, UNSIGNED: lambda d: decode_integers(d).view("u8")}


def encode_block(kind: int, times: list[int], values: list) -> bytes:
    t = encode_times(times)
    return bytes([kind]) + uvarint(len(t)) + t + ENCODE[kind](values)


def decode_block(data: bytes):
    """(kind, times, values)."""
    kind = data[0]
    if kind not in DECODE:
        raise Corrupt(f"a block of type {kind}")
    n, at = read_uvarint(data, 1)
    times, values = decode_times(data[at : at + n]), DECODE[kind](data[at + n :])
    if len(times) != len(values):
        raise Corrupt(f"{len(times)} times and {len(values)} values")
    return kind, times, values
