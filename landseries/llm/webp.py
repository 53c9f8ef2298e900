"""Media columns: lossless WebP (VP8L, RFC 9649) written from and read into sample arrays.

The reader takes any VP8L stream: simple and normal prefix codes, entropy images,
back-references, colour cache, and the four transforms. It decodes array-wise: for every bit
of the stream it looks up which pixel would start there and where the next one would, follows
that chain from the first bit, and resolves back-references and cache entries by pointer
jumping. The writer chooses a transform, a colour cache, back-references and prefix codes by
what they save.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import known_id, with_null_ids

#: Fixed values of the format: the order in which code-length code lengths are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
MAX_SIDE = 16384
#: Payloads are padded with this byte to a multiple of ROW samples, 192 pixels of three samples.
PAD, ROW = b"\xff", 576
WIDTH = ROW // 3
#: The near offsets of back-references: by distance, then by |dx|, right before left.
NEAR = sorted(
    ((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)
)
#: Back-references that the writer makes have at least so many pixels; the format allows up to 4096.
LEAST_COPY, MOST_COPY = 4, 4096
PREDICTOR, CROSS_COLOUR, GREEN, PALETTE = range(4)


class Bits:
    """Reads numbers from bytes, the lowest bit first."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def read(self, n: int) -> int:
        if not n:
            return 0
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        if last > len(self.data):
            raise ValueError("the stream ends early")
        value = int.from_bytes(self.data[first:last], "little") >> (self.at & 7)
        self.at += n
        return value & ((1 << n) - 1)


class Writer:
    """Collects numbers as bits, the lowest first."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.n + 7) // 8, "little")

    def bits(self) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self.bytes(), np.uint8), bitorder="little")[: self.n]


@lru_cache(maxsize=16)
def reversed_bits(n: int) -> np.ndarray:
    """The numbers of n bits read backwards."""
    out = np.zeros(1, np.int64)
    for _ in range(n):
        out = np.concatenate([out << 1, out << 1 | 1])
    return out


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """The canonical prefix code of these lengths: each symbol's bits as they stand in the stream."""
    used = np.nonzero(lengths)[0]
    out = np.zeros(len(lengths), np.int64)
    order = used[np.argsort(lengths[used], kind="stable")]
    if len(order) > 1:
        size = lengths[order].astype(np.int64)
        top = int(size[-1])
        first = np.cumsum(np.concatenate([[0], 1 << (top - size)]))[:-1]
        out[order] = reversed_bits(top)[first]
    return out


class Prefix:
    """A prefix code as tables over the next bits: the symbol and its length; a lone symbol takes no bits."""

    def __init__(self, lengths: np.ndarray):
        used = np.nonzero(lengths)[0]
        self.only = int(used[0]) if len(used) == 1 else None
        if not len(used):
            raise ValueError("an empty prefix code")
        if self.only is not None:
            self.top, self.symbol, self.size = 0, used, np.zeros(1, np.int64)
            return
        order = used[np.argsort(lengths[used], kind="stable")]
        size = lengths[order].astype(np.int64)
        self.top = int(size[-1])
        times = 1 << (self.top - size)
        if times.sum() != 1 << self.top:
            raise ValueError("not a full prefix code")
        back = reversed_bits(self.top)
        self.symbol = np.repeat(order, times)[back]
        self.size = np.repeat(size, times)[back]

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        first = bits.at >> 3
        at = int.from_bytes(bits.data[first : first + 3], "little") >> (bits.at & 7) & ((1 << self.top) - 1)
        bits.at += int(self.size[at])
        if bits.at > 8 * len(bits.data):
            raise ValueError("the stream ends early")
        return int(self.symbol[at])


@lru_cache(maxsize=256)
def length_code(n: int, sizes: int) -> tuple[list[int], list[int], int]:
    """The code of code lengths, of which n sizes of three bits are given, as tables and a mask."""
    order = np.zeros(19, np.int64)
    for k in range(n):
        order[LENGTH_ORDER[k]] = sizes >> (3 * k) & 7
    code = Prefix(order)
    return code.symbol.tolist(), code.size.tolist(), (1 << code.top) - 1


@lru_cache(maxsize=512)
def lone(symbol: int) -> Prefix:
    lengths = np.zeros(symbol + 1, np.int64)
    lengths[symbol] = 1
    return Prefix(lengths)


def read_prefix(bits: Bits, size: int) -> Prefix:
    if bits.read(1):
        two = bits.read(1)
        symbols = [bits.read(8 if bits.read(1) else 1)] + ([bits.read(8)] if two else [])
        if len(set(symbols)) == 1:
            return lone(symbols[0])
        lengths = np.zeros(size, np.int64)
        lengths[symbols] = 1
        return Prefix(lengths)
    n = 4 + bits.read(4)
    symbol, took, mask = length_code(n, bits.read(3 * n))
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    # the code lengths of any alphabet take fewer bytes than this
    start = bits.at
    value = int.from_bytes(bits.data[start >> 3 : (start >> 3) + 2 * size + 64], "little") >> (start & 7)
    out, before, used = [], 8, 0
    while len(out) < size and left > 0:
        left -= 1
        s, n = symbol[value & mask], took[value & mask]
        value >>= n
        used += n
        if s < 16:
            out.append(s)
            before = s or before
            continue
        extra, least = ((2, 3), (3, 3), (7, 11))[s - 16]
        out += [before if s == 16 else 0] * (least + (value & ((1 << extra) - 1)))
        value >>= extra
        used += extra
    bits.at += used
    if len(out) > size or bits.at > 8 * len(bits.data):
        raise ValueError("too many code lengths")
    return Prefix(np.array(out))


def extended(bits: Bits, symbol: int) -> int:
    """The length or distance that a prefix symbol and its extra bits stand for."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def cells(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


@lru_cache(maxsize=64)
def near_distances(width: int) -> np.ndarray:
    return np.array([max(1, x + y * width) for x, y in NEAR], np.int64)


def read_image(bits: Bits, width: int, height: int, main: bool = False) -> np.ndarray:
    """An entropy-coded image as an array of height x width ARGB numbers."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache too large")
    groups, block, which = 1, 0, None
    if main and bits.read(1):
        block = bits.read(3) + 2
        which = (read_image(bits, cells(width, block), cells(height, block)) >> 8) & 0xFFFF
        groups = int(which.max()) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    codes = [[read_prefix(bits, n) for n in (280 + cache_size, 256, 256, 256, 40)] for _ in range(groups)]
    if which is None:
        tokens = read_tokens(bits, codes[0], width, width * height)
    else:
        tokens = read_grouped(bits, codes, which, block, width, width * height)
    return resolved(*tokens, width * height, cache_bits).reshape(height, width)


def read_grouped(bits: Bits, codes: list[list[Prefix]], which: np.ndarray, block: int, width: int, total: int) -> tuple[np.ndarray, ...]:
    """The tokens of an image whose blocks have codes of their own, one by one."""
    kind, value, length, at = [], [], [], 0
    near = near_distances(width)
    while at < total:
        group = codes[int(which[at // width >> block, at % width >> block])]
        s, n = group[0].read(bits), 1
        if s < 256:
            red, blue, alpha = (group[k].read(bits) for k in (1, 2, 3))
            kind.append(0)
            value.append(alpha << 24 | red << 16 | s << 8 | blue)
        elif s < 280:
            n = extended(bits, s - 256)
            d = extended(bits, group[4].read(bits))
            kind.append(1)
            value.append(d - 120 if d > 120 else int(near[d - 1]))
        else:
            kind.append(2)
            value.append(s - 280)
        length.append(n)
        at += n
    return tuple(np.array(x, np.int64) for x in (kind, value, length))


def read_tokens(bits: Bits, codes: list[Prefix], width: int, total: int, step: int = 1 << 17) -> tuple[np.ndarray, ...]:
    """(kind, value, length) of an image's tokens: 0 a pixel, 1 a copy from `value` back, 2 a cache entry.

    For every bit of a stretch of the stream the token that would begin there is looked up;
    then the chain of those that do begin is followed.
    """
    green, red, blue, alpha, dist = codes
    parts, done, near = [], 0, near_distances(width)
    if all(c.only is not None for c in codes[:4]) and green.only < 256:
        argb = alpha.only << 24 | red.only << 16 | green.only << 8 | blue.only
        return np.zeros(total, np.int64), np.full(total, argb), np.ones(total, np.int64)
    while done < total:
        first, shift = bits.at >> 3, bits.at & 7
        size = min(step >> 3, len(bits.data) - first)
        if size <= 0:
            raise ValueError("the stream ends early")
        part = bits.data[first : first + size + 40]
        part += b"\0" * (size + 40 - len(part))
        window = (np.ndarray((len(part) - 3,), "<u4", part, strides=(1,))[:, None] >> np.arange(8, dtype=np.uint32)).ravel().astype(np.int64)  # 25 bits are whole

        def symbols(code: Prefix, at: np.ndarray) -> np.ndarray:
            return np.full(len(at), code.only) if code.only is not None else code.symbol[window[at] & ((1 << code.top) - 1)]

        def behind(code: Prefix, at: np.ndarray) -> np.ndarray:
            return at if code.only is not None else at + code.size[window[at] & ((1 << code.top) - 1)]

        after = np.arange(8 * size)
        if green.only is None:
            after += green.size[window[: 8 * size] & ((1 << green.top) - 1)]
        to = behind(alpha, behind(blue, behind(red, after)))
        if green.symbol.max() >= 256:
            to = to.copy() if to is after else to
            s = symbols(green, np.arange(8 * size))
            other = np.nonzero(s >= 256)[0]
            if green.symbol.max() >= 280:
                to[other] = after[other]  # of cache entries
                other = other[s[other] < 280]
            at = numbers(s[other] - 256, after[other], window)[1]
            to[other] = numbers(symbols(dist, at), behind(dist, at), window)[1]
        follow, at, chain, limit = memoryview(to), shift, [], 8 * size
        room = total - done
        append = chain.append
        for _ in range(room):
            if at >= limit:
                break
            append(at)
            at = follow[at]
        took = np.fromiter(chain, np.int64, len(chain))
        s = symbols(green, took)
        kind = np.where(s < 256, 0, np.where(s < 280, 1, 2))
        sizes, value, copy = np.ones(len(took), np.int64), s - 280, np.nonzero(kind == 1)[0]
        sizes[copy], place = numbers(s[copy] - 256, after[took[copy]], window)
        ends = np.cumsum(sizes)
        if ends[-1] >= room:
            n = int(np.searchsorted(ends, room)) + 1
            at = int(to[took[n - 1]])
            kind, took, sizes, s, value = kind[:n], took[:n], sizes[:n], s[:n], value[:n]
            copy, place = copy[copy < n], place[: (copy < n).sum()]
        d = numbers(symbols(dist, place), behind(dist, place), window)[0]
        value[copy] = np.where(d > 120, d - 120, near[np.minimum(d, 120) - 1])
        own = np.nonzero(kind == 0)[0]
        place = after[took[own]]
        argb = s[own] << 8
        for code, by in ((red, 16), (blue, 0), (alpha, 24)):
            argb |= symbols(code, place) << by
            place = behind(code, place)
        value[own] = argb
        parts.append((kind, value, sizes))
        done += int(sizes.sum())
        bits.at = 8 * first + at
    if bits.at > 8 * len(bits.data):
        raise ValueError("the stream ends early")
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def numbers(symbol: np.ndarray, at: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`extended` for many symbols: the numbers, and the places after their extra bits."""
    extra = np.maximum((symbol - 2) >> 1, 0)
    more = window[np.minimum(at, len(window) - 1)] & ((1 << extra) - 1)
    return np.where(symbol < 4, symbol + 1, ((2 + (symbol & 1)) << extra) + more + 1), at + extra


def resolved(kind: np.ndarray, value: np.ndarray, length: np.ndarray, total: int, cache_bits: int) -> np.ndarray:
    """The pixels of tokens. A copied pixel points to its source, a cached one to the last pixel of its key."""
    if length.sum() != total:
        raise ValueError("back-reference outside the image")
    if not kind.any():
        return value
    start = np.cumsum(length) - length
    pixel, pointer = np.zeros(total, np.int64), np.arange(total)
    own = kind == 0
    pixel[start[own]] = value[own]
    copies = kind == 1
    if copies.any():
        if (value[copies] > start[copies]).any():
            raise ValueError("back-reference outside the image")
        n = length[copies]
        at = np.repeat(start[copies] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pointer[at] = at - np.repeat(value[copies], n)
        pointer = jumped(pointer)
    cached = start[kind == 2]
    if len(cached):
        own_key = (0x1E35A7BD * pixel & 0xFFFFFFFF) >> (32 - cache_bits)
        own_key[cached] = value[kind == 2]
        blank = np.zeros(total, bool)
        while True:
            key = own_key[pointer]
            order = np.argsort(key, kind="stable")
            before = np.full(total, -1)
            before[order[1:]] = np.where(key[order[1:]] == key[order[:-1]], order[:-1], -1)
            never = cached[(before[cached] < 0) & ~blank[cached]]
            if not len(never):
                break
            own_key[never], blank[never] = 0, True  # an entry never written is pixel 0, which has key 0
        pointer[cached] = np.where(blank[cached], cached, before[cached])
        pointer = jumped(pointer)
    return pixel[pointer]


def jumped(pointer: np.ndarray) -> np.ndarray:
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            return pointer
        pointer = further


def average(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24 & 255, p >> 16 & 255, p >> 8 & 255, p & 255


def packed(values) -> int:
    a, r, g, b = values
    return a << 24 | r << 16 | g << 8 | b


def clip(x: int) -> int:
    return min(255, max(0, x))


def predicted(mode: int, left: int, top: int, corner: int, right: int) -> int:
    """The prediction of a pixel from its left, upper, upper left and upper right neighbours."""
    if mode == 11:
        # whichever of left and top lies nearer to left + top - corner
        near = [0, 0]
        for x, t, c in zip(channels(left), channels(top), channels(corner), strict=True):
            near[0] += abs(t - c)
            near[1] += abs(x - c)
        return left if near[0] < near[1] else top
    if mode == 12:
        return packed(clip(x + t - c) for x, t, c in zip(channels(left), channels(top), channels(corner), strict=True))
    if mode == 13:
        mean = channels(average(left, top))
        return packed(clip(m + int((m - c) / 2)) for m, c in zip(mean, channels(corner), strict=True))
    return (
        lambda: 0xFF000000, lambda: left, lambda: top, lambda: right, lambda: corner,
        lambda: average(average(left, right), top), lambda: average(left, corner), lambda: average(left, top),
        lambda: average(corner, top), lambda: average(top, right), lambda: average(average(left, corner), average(top, right)),
    )[mode]() if mode < 11 else 0xFF000000


def added(a, b):
    """The sums of pixels channel by channel, for numbers or arrays."""
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00)) & 0xFF00FF00 | ((a & 0x00FF00FF) + (b & 0x00FF00FF)) & 0x00FF00FF


def apart(a, b):
    """The differences of pixels channel by channel."""
    return sum(((a >> k & 255) - (b >> k & 255) & 255) << k for k in (0, 8, 16, 24))


def running(pixels: np.ndarray, axis: int = 0) -> np.ndarray:
    """Sums of pixels up to each, channel by channel."""
    return sum((np.cumsum(pixels >> s & 255, axis=axis) & 255) << s for s in (0, 8, 16, 24))


def undo_prediction(pixels: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    """Rows of modes that look at the row above only, and rows of mode 1, are inverted as arrays."""
    height, width = pixels.shape
    out = pixels.copy()
    out[0, 0] = int(added(int(out[0, 0]), 0xFF000000))
    out[0] = running(out[0])
    mode = np.repeat(modes >> 8 & 15, 1 << block, 1)[:, :width]
    for y in range(1, height):
        above, row, m = out[y - 1], out[y], mode[y >> block]
        row[0] = added(int(row[0]), int(above[0]))
        kinds = set(np.unique(m[1:]).tolist())
        if kinds <= {1}:
            row[:] = running(row)
        elif kinds <= {0, 2, 3, 4, 8, 9, 14, 15}:
            top, corner, right = above[1:], above[:-1], np.append(above[2:], row[0])[: width - 1]
            mean = lambda a, b: (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)
            guess = np.select([m[1:] == k for k in (2, 3, 4, 8, 9)], [top, right, corner, mean(corner, top), mean(top, right)], 0xFF000000)
            row[1:] = added(row[1:], guess)
        else:
            own, up, ms = row.tolist(), above.tolist(), m.tolist()
            up.append(own[0])
            for x in range(1, width):
                own[x] = added(own[x], predicted(ms[x], own[x - 1], up[x], up[x - 1], up[x + 1]))
            row[:] = own
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return ((x & 255) ^ 128) - 128


def undo_cross_colour(pixels: np.ndarray, factors: np.ndarray, block: int) -> np.ndarray:
    height, width = pixels.shape
    f = np.repeat(np.repeat(factors, 1 << block, 0), 1 << block, 1)[:height, :width]
    green = signed(pixels >> 8)
    red = (pixels >> 16) + (signed(f) * green >> 5) & 255
    blue = pixels + (signed(f >> 8) * green >> 5) + (signed(f >> 16) * signed(red) >> 5) & 255
    return pixels & 0xFF00FF00 | red << 16 | blue


def undo_green(pixels: np.ndarray) -> np.ndarray:
    green = pixels >> 8 & 255
    return pixels & 0xFF00FF00 | ((pixels >> 16) + green & 255) << 16 | (pixels + green & 255)


def bundling(size: int) -> int:
    """The log of how many indices into a palette of this size share a pixel."""
    return 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0


def undo_palette(pixels: np.ndarray, table: np.ndarray, width: int, bundle: int) -> np.ndarray:
    index = pixels >> 8 & 255
    if bundle:
        n = 8 >> bundle
        parts = [(index >> (k * n)) & ((1 << n) - 1) for k in range(1 << bundle)]
        index = np.stack(parts, 2).reshape(index.shape[0], -1)[:, :width]
    full = np.zeros(256, np.int64)
    full[: len(table)] = table
    return full[index]


def decode(data: bytes) -> np.ndarray:
    """The pixels of a lossless WebP file as a height x width x 4 array of R, G, B, A."""
    if len(data) < 25 or data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L" or data[20] != 0x2F:
        raise ValueError("not a lossless WebP file")
    bits = Bits(data[21 : 20 + struct.unpack("<I", data[16:20])[0]])
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            image = read_image(bits, cells(now, block), cells(height, block))
            undo.append((undo_prediction if kind == PREDICTOR else undo_cross_colour, image, block))
        elif kind == GREEN:
            undo.append((undo_green,))
        else:
            size = bits.read(8) + 1
            table = running(read_image(bits, size, 1)[0])
            bundle = bundling(size)
            undo.append((undo_palette, table, now, bundle))
            now = cells(now, bundle)
    pixels = read_image(bits, now, height, main=True)
    for f, *more in reversed(undo):
        pixels = f(pixels, *more)
    return pixels.astype("<u4").view(np.uint8).reshape(height, width, 4)[:, :, [2, 1, 0, 3]]


def container(stream: bytes) -> bytes:
    body = b"VP8L" + struct.pack("<I", len(stream)) + stream + b"\0" * (len(stream) % 2)
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body


def header(width: int, height: int) -> Writer:
    w = Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(0, 4)  # no alpha, version 0
    return w


def code_lengths(counts: np.ndarray, most: int = 15) -> np.ndarray:
    """Lengths of an optimal prefix code for these counts, or nearly so where one would exceed `most`."""
    out = np.zeros(len(counts), np.int64)
    used = np.nonzero(counts)[0]
    if len(used) < 2:
        out[used if len(used) else [0]] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used]
    while True:
        leaves, n = weights.tolist(), len(used)
        nodes, parent, i, j = [], [0] * (2 * n - 1), 0, 0
        for k in range(n - 1):  # two queues: leaves and inner nodes, both in order
            total = 0
            for _ in (0, 1):
                if i < n and (j >= k or leaves[i] <= nodes[j]):
                    total += leaves[i]
                    parent[i] = n + k
                    i += 1
                else:
                    total += nodes[j]
                    parent[n + j] = n + k
                    j += 1
            nodes.append(total)
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            out[used] = depth[:n]
            return out
        weights = (weights + 1) >> 1


#: The writer's code for code lengths: thirteen of the symbols have four bits, six have five.
LENGTH_SIZES = np.array([4, 5, 5, 4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 5, 5, 5, 5, 4, 4])
LENGTH_CODES = codes_of(LENGTH_SIZES).tolist()
LENGTH_HEAD = sum(int(LENGTH_SIZES[s]) << 3 * k for k, s in enumerate(LENGTH_ORDER))


def write_prefix(w: Writer, lengths: np.ndarray) -> None:
    used = np.nonzero(lengths)[0]
    if len(used) == 1 and used[0] < 256:
        w.put(0b101 | int(used[0]) << 3, 11)
        return
    w.put(0, 1)
    w.put(19 - 4, 4)
    w.put(LENGTH_HEAD, 57)
    w.put(0, 1)
    value, n, at, sizes, own = 0, 0, 0, LENGTH_SIZES.tolist(), lengths.tolist()
    for s in [*used.tolist(), len(own)]:
        while at < s:  # zeros
            run = s - at
            if run > 10:
                run = min(run, 138)
                symbol, extra, size = 18, run - 11, 7
            elif run > 2:
                symbol, extra, size = 17, run - 3, 3
            else:
                run, symbol, extra, size = 1, 0, 0, 0
            value |= (LENGTH_CODES[symbol] | extra << sizes[symbol]) << n
            n += sizes[symbol] + size
            at += run
        if s < len(own):
            value |= LENGTH_CODES[own[s]] << n
            n += sizes[own[s]]
            at += 1
    w.put(value, n)


def split_number(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The prefix symbols of lengths or distances, with their numbers of extra bits and those bits."""
    x = v - 1
    high = np.log2(np.maximum(x, 1)).astype(np.int64)
    extra = np.where(x < 4, 0, high - 1)
    symbol = np.where(x < 4, x, 2 * high + (x >> np.maximum(high - 1, 0) & 1))
    return symbol, extra, x & ((1 << extra) - 1)


def copies_in(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance) of stretches that repeat earlier pixels, from left to right."""
    n = len(pixels) - LEAST_COPY + 1
    if n < 2:
        return []
    key = np.zeros(n, np.uint64)
    for k in range(LEAST_COPY):
        key = key * np.uint64(0x9E3779B97F4A7C15) + pixels[k : k + n].astype(np.uint64)
    low = np.uint64((1 << n.bit_length()) - 1)
    both = np.sort((key * np.uint64(0x9E3779B97F4A7C15) & ~low) | np.arange(n, dtype=np.uint64))  # by key, then place
    order = (both & low).astype(np.int64)
    same = (both[1:] ^ both[:-1]) <= low
    if not same.any():
        return []
    before = np.full(n, -1)
    before[order[1:][same]] = order[:-1][same]
    some = np.nonzero(before >= 0)[0]
    found, at, k = [], 0, 0
    while True:
        k += int(np.searchsorted(some[k : k + 64], at))
        if k < len(some) and some[k] < at:
            k = int(np.searchsorted(some, at))
        if k >= len(some):
            return found
        i = int(some[k])
        d, size, chunk = i - int(before[i]), 0, 32
        while size < MOST_COPY:
            differs = np.nonzero(pixels[i + size : i + size + chunk] != pixels[i + size - d : i + size - d + chunk][: len(pixels) - i - size])[0]
            if len(differs):
                size += int(differs[0])
                break
            size = min(size + chunk, len(pixels) - i)
            if i + size >= len(pixels):
                break
            chunk *= 4
        size = min(size, MOST_COPY)
        if size >= LEAST_COPY:  # else a collision of keys
            found.append((i, size, d))
        at = i + max(size, 1)


def edge_before(start: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """What to take from the places of pixels, summed up, for their places among tokens."""
    out = np.zeros(n + 1, np.int64)
    out[start + size] = size - 1
    return out


def entropy(counts: np.ndarray) -> float:
    """Bits that symbols of these counts take, with what describing their code takes."""
    c = counts[counts > 0]
    total = c.sum()
    return float(total * np.log2(max(total, 1)) - (c * np.log2(c)).sum() + (4.5 * len(c) if len(c) > 1 else 0))


def joined(value: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The bits of all numbers, row by row; a row has at most 64."""
    size = np.cumsum(bits, axis=1)
    row = np.bitwise_or.reduce(value << (size - bits), axis=1).view(np.uint64)
    ends = np.cumsum(size[:, -1])
    total = int(ends[-1])
    start = ends - size[:, -1]
    place, shift = start >> 6, (start & 63).astype(np.uint64)
    words = np.zeros((total >> 6) + 2, np.uint64)
    first = np.nonzero(np.diff(place, prepend=-1))[0]
    words[place[first]] = np.bitwise_or.reduceat(row << shift, first)
    words[place[first] + 1] |= np.bitwise_or.reduceat(row >> np.uint64(1) >> (np.uint64(63) - shift), first)  # what goes over the edge
    return np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little", count=total)


def write_image(w: Writer, pixels: np.ndarray, main: bool) -> np.ndarray:
    """The bits of an entropy-coded image after what w holds: with or without a colour cache, whichever is shorter."""
    found = copies_in(pixels) if main else []
    literal = np.ones(len(pixels), bool)
    start, size, back = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    if found:
        edge = np.zeros(len(pixels) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + size, -1)
        literal = np.cumsum(edge)[:-1] == 0
    at = np.nonzero(literal)[0]
    p = pixels[at]
    length, length_extra, length_bits = split_number(size)
    dist, dist_extra, dist_bits = split_number(back + 120)
    lengths = np.bincount(length, minlength=24)

    def tables(own: np.ndarray) -> list[np.ndarray]:
        return [np.bincount(own >> s & 255, minlength=256) for s in (8, 16, 0, 24)]

    counts, cache_bits, cached, key = tables(p), 0, None, None
    if main and len(p) > 4096:  # fewer pixels hardly repay the longer code
        bits_ = 8 if len(pixels) < 20000 else 10
        key = (0x1E35A7BD * pixels & 0xFFFFFFFF) >> (32 - bits_)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(pixels), bool)
        again[order[1:]] = (pixels[order[1:]] == pixels[order[:-1]])
        hit = again[at]
        if hit.any():
            with_cache = tables(p[~hit])
            entries = np.bincount(key[at[hit]], minlength=1 << bits_)
            plain = entropy(np.concatenate([counts[0], lengths])) + sum(map(entropy, counts[1:]))
            if entropy(np.concatenate([with_cache[0], lengths, entries])) + sum(map(entropy, with_cache[1:])) < plain:
                counts, cache_bits, cached = with_cache, bits_, hit
                lengths = np.concatenate([lengths, entries])
    w.put(cache_bits << 1 | 1 if cache_bits else 0, 5 if cache_bits else 1)
    if main:
        w.put(0, 1)  # one group of codes
    counts[0] = np.concatenate([counts[0], lengths])
    sizes = [code_lengths(x) for x in (*counts, np.bincount(dist, minlength=40))]
    for x in sizes:
        write_prefix(w, x)
    codes = [codes_of(x) for x in sizes]
    sizes = [x if np.count_nonzero(x) > 1 else np.zeros_like(x) for x in sizes]  # a lone symbol takes no bits
    n = len(at) + len(start)
    parts_used = 4 if found else sum(1 for x in sizes[:4] if x.any()) or 1
    value, bits = np.zeros((n, parts_used), np.int64), np.zeros((n, parts_used), np.int64)
    of_pixel = slice(None)
    if found:
        of_pixel = at - np.cumsum(edge_before(start, size, len(pixels)))[at]
        of_copy = np.arange(len(start)) + np.searchsorted(at, start)
    full = slice(None) if cached is None else ~cached
    own, rows = p[full], of_pixel if cached is None else (of_pixel[full] if found else np.nonzero(full)[0])
    column = 0
    for k, shift in enumerate((8, 16, 0, 24)):
        if sizes[k].any():
            symbol = own >> shift & 255
            value[rows, column], bits[rows, column] = codes[k][symbol], sizes[k][symbol]
            column += 1
    if cached is not None:
        symbol, rows = 280 + key[at[cached]], of_pixel[cached] if found else np.nonzero(cached)[0]
        value[rows, 0], bits[rows, 0] = codes[0][symbol], sizes[0][symbol]
    if found:
        value[of_copy, 0], bits[of_copy, 0] = codes[0][256 + length], sizes[0][256 + length]
        value[of_copy, 1], bits[of_copy, 1] = length_bits, length_extra
        value[of_copy, 2], bits[of_copy, 2] = codes[4][dist], sizes[4][dist]
        value[of_copy, 3], bits[of_copy, 3] = dist_bits, dist_extra
    return np.concatenate([w.bits(), joined(value, bits)])


def encode(samples: np.ndarray) -> bytes:
    """A lossless WebP file of a height x width x 3 array of R, G, B samples.

    Of no transform, green subtracted, prediction from above and a palette, the one by which
    the channels' entropies promise the fewest bits.
    """
    height, width, _ = samples.shape
    s = samples.astype(np.int64)
    pixels = 255 << 24 | s[:, :, 0] << 16 | s[:, :, 1] << 8 | s[:, :, 2]

    def cost(x: np.ndarray) -> float:
        x = x.ravel()
        return entropy(np.bincount(np.concatenate([x & 255, x >> 8 & 255 | 256, x >> 16 & 255 | 512]), minlength=768)) - 3 * x.size * np.log2(3)

    green = pixels >> 8 & 255
    less_green = pixels & 0xFF00FF00 | ((pixels >> 16) - green & 255) << 16 | (pixels - green & 255)
    options = [(cost(pixels), 0), (cost(less_green), 1)]
    some = pixels.ravel()[:512]
    colours = np.sort(some)
    colours = colours[np.diff(colours, prepend=-1) > 0]
    colours = np.unique(pixels) if len(colours) <= 256 and pixels.size > some.size else colours
    if len(colours) <= 256:
        options.append((20 * len(colours) + pixels.size * np.log2(len(colours) + 1), 3))
    if height > 1 and (pixels[1:] == pixels[:-1]).mean() > 0.2:
        above = pixels.copy()
        above[1:] = apart(pixels[1:], pixels[:-1])
        above[0, 1:] = apart(pixels[0, 1:], pixels[0, :-1])
        above[0, 0] = apart(pixels[0, 0], np.int64(0xFF000000))
        options.append((cost(above) + 60, 2))
    choice = min(options)[1]
    w = header(width, height)
    if choice == 1:
        w.put(1 | GREEN << 1, 3)
        pixels = less_green
    elif choice == 2:
        w.put(1 | PREDICTOR << 1 | 7 << 3, 6)  # blocks of 512 pixels a side
        modes = np.full(cells(width, 9) * cells(height, 9), 255 << 24 | 2 << 8, np.int64)
        w = after(w, write_image(w, modes, main=False))
        pixels = above
    elif choice == 3:
        w.put(1 | PALETTE << 1 | len(colours) - 1 << 3, 11)
        steps = colours.copy()
        steps[1:] = apart(colours[1:], colours[:-1])
        w = after(w, write_image(w, steps, main=False))
        index, bundle = np.searchsorted(colours, pixels), bundling(len(colours))
        if bundle:
            n = 1 << bundle
            index = np.pad(index, ((0, 0), (0, -width % n))).reshape(height, -1, n)
            index = (index << (np.arange(n) * (8 >> bundle))).sum(axis=2)
        pixels = 255 << 24 | index << 8
    w.put(0, 1)  # no more transforms
    return container(np.packbits(write_image(w, pixels.ravel(), main=True), bitorder="little").tobytes())


def after(w: Writer, bits: np.ndarray) -> Writer:
    """A writer that goes on behind these bits."""
    out = Writer()
    out.value, out.n = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little"), len(bits)
    return out


def store(payload: bytes) -> bytes:
    """Lossless WebP files, one after the other, that hold a payload of whole rows."""
    a = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, 3)
    return b"".join(encode(a[k : k + MAX_SIDE]) for k in range(0, len(a), MAX_SIDE))


def load(media: bytes) -> np.ndarray:
    """The samples of stored files, in order, as rows x WIDTH x 3."""
    parts, at = [], 0
    while at < len(media):
        size = 8 + struct.unpack("<I", media[at + 4 : at + 8])[0]
        parts.append(decode(media[at : at + size])[:, :, :3])
        at += size
    return np.concatenate(parts)


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + PAD * (-len(raw) % ROW or (0 if raw else ROW))


def media_column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every row's text as lossless WebP; null texts count as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                rows = [(n, store(p)) for n, p in map(padded, part["text"])]
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": [n for n, _ in rows], "media": [m for _, m in rows]})

    return with_null_ids(docs.select(known_id(), "text").mapInPandas(run, "doc_id long, n_bytes long, media binary"))


def feature(samples: np.ndarray) -> str:
    """Mean and variance of each channel, from its histogram, to three digits."""
    level, out = np.arange(256), []
    flat = samples.ravel()
    for k in range(3):
        h = np.bincount(flat[k::3], minlength=256) / (len(flat) // 3)
        mean = float(h @ level)
        out += [mean, float(h @ (level - mean) ** 2)]
    return ",".join(f"{v:.3f}" for v in out)


def pixel_column(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media_bytes, media_sha256, samples, feature): the pixel arrays that stored
    files (doc_id, n_bytes, media) hold, row by row, R, G and B in turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                rows = []
                for doc, n, m in b.iloc[at : at + 500].itertuples(index=False):
                    samples = load(m)
                    rows.append((doc, n, len(m), hashlib.sha256(m).hexdigest(), samples.tobytes(), feature(samples)))
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "media_bytes", "media_sha256", "samples", "feature"])

    kind = "doc_id long, n_bytes long, media_bytes long, media_sha256 string, samples binary, feature string"
    return with_null_ids(media.select(known_id(), "n_bytes", "media").mapInPandas(run, kind))


def digest(docs: DataFrame) -> DataFrame:
    """Store every row's text as WebP, read it back and describe it.

    Equal texts give equal values. Null texts count as empty: one row of padding. Null ids
    stay null, repeated rows come out repeated, an empty table gives no rows, and further
    columns are ignored. Texts over 16384 rows of samples take several files.
    """
    back = pixel_column(media_column(docs))
    return back.select(
        "doc_id", "n_bytes", F.length("samples").cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -32, 32)).alias("tail_crc32"), "media_bytes", "media_sha256", "feature",
    )
