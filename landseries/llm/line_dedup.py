"""Line deduplication by an exact set-similarity join (prefix, length and positional filters)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import bucketed, fresh, split_by_keys, staged
from landseries.llm.tokens import batches_of, mix, word_hashes

#: Words are counted by hash in this many buckets, a table of fixed size.
BUCKETS, CHUNK = 1 << 23, 1 << 15
#: Groups of more classes with partners than this are compared in tiles.
COMMON = 1000
#: Prefix rows of one word that a task compares; of more, each task compares two parts.
CROWD = 1 << 15
#: Rows of a key are compared in blocks if they are more than this.
FEW = 1500


def line_sets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """For runs of texts: (text, line, sig, size, words) of every line with a word.

    words holds the sorted distinct 32-bit word hashes of all lines, one after the other;
    sig is a 64-bit hash of the set: lines of one sig are one class.
    """
    for i, j in batches_of(texts):
        raw = np.frombuffer(b"\n".join(texts[i:j]) + b"\n", np.uint8)
        starts, _, hashes = word_hashes(raw)
        if not len(starts):
            continue
        line = np.searchsorted(np.nonzero(raw == 10)[0], starts).astype(np.uint64)  # counted over all texts of the run
        both = np.sort(line << np.uint64(32) | hashes >> np.uint64(32))
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        line, words = (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
        cuts = np.nonzero(np.diff(line, prepend=-1))[0]
        size = np.diff(np.append(cuts, len(line)))
        sig = mix(np.add.reduceat(mix(words.astype(np.uint64)), cuts) + size.astype(np.uint64)).view(np.int64)
        first = np.concatenate([[0], np.cumsum([t.count(b"\n") + 1 for t in texts[i:j]])])
        text = np.searchsorted(first, line[cuts], "right") - 1
        yield i + text, line[cuts] - first[text], sig, size, words


def binary_column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive stretches of 32-bit numbers as binary values."""
    ends = np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def numbers_of(column: pa.Array) -> np.ndarray:
    """The 32-bit numbers of a binary column without nulls, one after the other."""
    if not len(column):
        return np.zeros(0, np.uint32)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint32)


def lines_of(docs: DataFrame, with_words: bool = False) -> DataFrame:
    """(doc_id, line_no, sig[, size, words]) of every line that has a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["doc_id"].to_numpy(zero_copy_only=False)
            texts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in b["text"].to_pylist()]
            for text, line, sig, size, words in line_sets(texts):
                columns = {"doc_id": pa.array(ids[text], pa.int64()), "line_no": pa.array(line.astype(np.int32)), "sig": pa.array(sig)}
                if with_words:
                    columns |= {"size": pa.array(size.astype(np.int32)), "words": binary_column(words, size)}
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, line_no int, sig long" + ", size int, words binary" * with_words)


def classes_of(docs: DataFrame) -> DataFrame:
    """(sig, first, copies, size, words): the different word sets of all lines, each with its first line."""
    return lines_of(docs, with_words=True).groupBy("sig").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("words").alias("words")
    )


def word_counts(classes: DataFrame) -> np.ndarray:
    """How many classes hold the words of each of BUCKETS hash buckets, over all classes, up to 65535.

    Each task sends its counts as compressed chunks, which are summed in groups of 64 tasks
    until one is left. What the driver gets has a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.uint32)
        for b in batches:
            v, n = np.unique(numbers_of(b["words"]) & np.uint32(BUCKETS - 1), return_counts=True)
            total[v] += n.astype(np.uint32)
        parts = total.reshape(-1, CHUNK)
        some = np.nonzero(parts.any(axis=1))[0]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(some.astype(np.int32)), "counts": pa.array([zlib.compress(parts[k], 1) for k in some], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.uint64)
        for c in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(c), np.uint32)
        total = np.minimum(total, 2**31).astype(np.uint32)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "part": pdf["part"].iloc[:1], "counts": [zlib.compress(total, 1)]})

    words = classes.select("words")
    left = words.rdd.getNumPartitions()
    rows = words.mapInArrow(count, "chunk int, counts binary").withColumn("part", F.spark_partition_id())
    while left > 1:
        left = -(-left // 64)
        rows = rows.withColumn("part", F.floor(F.col("part") / 64).cast("int")).groupBy("chunk", "part").applyInPandas(add, "chunk int, part int, counts binary")
    out = np.zeros((BUCKETS // CHUNK, CHUNK), np.uint16)
    for chunk, counts in rows.select("chunk", "counts").collect():
        out[chunk] = np.minimum(np.frombuffer(zlib.decompress(counts), np.uint32), 65535)
    return out.ravel()


def order_keys(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words as numbers in the common order: by how many classes hold their bucket, then by hash."""
    return counts[words & np.uint32(BUCKETS - 1)].astype(np.int64) << 32 | words


def lanes_of(size: np.ndarray) -> np.ndarray:
    """How many numbers of 64 parities the sets of these sizes have: random sets differ in far more bins than similar ones may."""
    return np.where(size <= 80, 1, np.where(size <= 200, 2, 4))


def parities(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The parities of the words of sets in 64 bins a lane, for each set four numbers of which those beyond its lanes are 0.

    Lanes of a larger set fold by exclusive or into those of a smaller one.
    """
    out = np.zeros((len(sizes), 4), np.uint64)
    spread = mix(words.astype(np.uint64))
    bit = np.uint64(1) << (spread & np.uint64(63))
    out[:, 0] = np.bitwise_xor.reduceat(bit, starts)
    lanes = lanes_of(sizes)
    for n in (2, 4):
        some = np.nonzero(lanes == n)[0]
        if len(some):
            own = np.repeat(lanes == n, sizes)
            bits_, lane, size = bit[own], spread[own] >> np.uint64(6) & np.uint64(n - 1), sizes[some]
            for k in range(n):
                out[some, k] = np.bitwise_xor.reduceat(np.where(lane == k, bits_, np.uint64(0)), np.cumsum(size) - size)
    return out


ROW = pa.schema([("key", pa.int64()), ("sig", pa.int64()), ("place", pa.int64()), *((f"m{k}", pa.int64()) for k in range(4))])


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on, which compress better."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes()


def dealt(rows: tuple[np.ndarray, ...], buckets: int) -> pa.RecordBatch:
    """(bucket, n, packed): rows (key, sig, place, maps) by a hash of their key, column by column, compressed."""
    key, sig, place, maps = rows
    order = np.argsort(key, kind="stable")
    bucket = (mix(key[order].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    bucket, order = bucket[by], order[by]
    key, sig, place, maps = key[order], sig[order], place[order], maps[order]
    used = np.arange(4) < lanes_of(place >> 32)[:, None]
    first = np.nonzero(np.diff(bucket, prepend=-1))[0]
    packed = []
    for i, j in zip(first, np.append(first, len(bucket))[1:], strict=False):
        raw = planes(np.diff(key[i:j], prepend=0)) + planes(place[i:j]) + sig[i:j].tobytes() + maps[i:j][used[i:j]].tobytes()
        packed.append(len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True))
    n = np.diff(np.append(first, len(bucket))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(n), pa.array(packed, pa.binary())], ["bucket", "n", "packed"])


def undealt(n: int, packed: bytes) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    key, place = (np.ascontiguousarray(raw[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T).view(np.int64).ravel() for k in (0, 1))
    maps = np.zeros((n, 4), np.uint64)
    maps[np.arange(4) < lanes_of(place >> 32)[:, None]] = raw[24 * n :].view(np.uint64)
    return np.cumsum(key), raw[16 * n : 24 * n].view(np.int64), place, maps


DEALT = "bucket int, n int, packed binary"


def dealt_rows(parts: Iterator[tuple[np.ndarray, ...]], buckets: int, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of many parts, dealt about `rows` at once."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= rows:
            yield dealt(tuple(map(np.concatenate, zip(*held, strict=True))), buckets)
            held, n = [], 0
    if n:
        yield dealt(tuple(map(np.concatenate, zip(*held, strict=True))), buckets)


def buckets_of(df: DataFrame) -> int:
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_rows(classes: DataFrame, counts, similarity: float, common: bool) -> DataFrame:
    """(key, sig, place, m0 .. m3): each class's rarest words, as many as the prefix filter needs.

    Sets that share at least o = ceil(similarity * size) words share one among the first
    size - o + 1 of each under any common order; rarest first makes for few partners. A word
    alone in its bucket is in one class only and has no partner to meet. place holds the set's
    size and the word's position; m0 .. m3 hold the parities of the set's words in bins: common
    words cancel, so at most as many bits differ as two sets have words apart, however large
    the sets. common: the words that more than CROWD classes hold, or the others, whose rows
    come dealt and packed.
    """
    buckets, most = buckets_of(classes), CROWD

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in (b.slice(at, 1 << 15) for b in batches for at in range(0, len(b), 1 << 15)):
            sizes = b["size"].to_numpy().astype(np.int64)
            words = numbers_of(b["words"])
            starts = np.cumsum(sizes) - sizes
            row = np.repeat(np.arange(len(b)), sizes)
            # row, rank and word in one number: a rank has 16 bits, a row here 15
            key = np.sort(row << 48 | order_keys(words, counts.value)) & ((1 << 48) - 1)
            pos = np.arange(len(words)) - starts[row]
            need = sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1
            rank = key >> 32
            keep = (pos < need[row]) & ((rank > most) if common else (rank > 1) & (rank <= most))
            if not keep.any():
                continue
            maps = parities(words, starts, sizes)
            row, pos, key = row[keep], pos[keep], key[keep]
            yield key, b["sig"].to_numpy()[row], sizes[row] << 32 | pos, maps[row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not common:
            yield from dealt_rows(rows(batches), buckets)
            return
        for *columns, maps in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, *np.ascontiguousarray(maps.T).view(np.int64))], schema=ROW)

    kind = "key long, sig long, place long, m0 long, m1 long, m2 long, m3 long" if common else DEALT
    return classes.select("sig", "size", "words").mapInArrow(run, kind)


def packed_rows(rows: DataFrame) -> DataFrame:
    """Rows of prefix_rows with common=True, dealt and packed as the others."""
    buckets = buckets_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ([b[c].to_numpy() for c in ROW.names] for b in batches if len(b))
        yield from dealt_rows(((*c[:3], np.stack(c[3:], 1).view(np.uint64)) for c in columns), buckets)

    return rows.select(*ROW.names).mapInArrow(run, DEALT)


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about `rows` rows out of batches in the order of key; no key is split."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= rows:
            t = pa.Table.from_batches(held).combine_chunks()
            key = t["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield t.slice(0, cut)
            held, n = t.slice(cut).to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def neighbours(key: np.ndarray, size: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (a, b) of rows of one key that pass the length filter, rows being in the order of key and size.

    Each step pairs rows with those d places on, so a row occurs once on either side of a step.
    """
    if not len(key):
        return
    most = int(size.max())
    base = np.cumsum(np.diff(key, prepend=key[0]) != 0) * (most + 1)
    last = np.searchsorted(base + size, base + np.minimum((size + 1e-9) / similarity, most).astype(np.int64), "right") - 1
    a, d = np.arange(len(key)), 0
    while True:
        d += 1
        a = a[last[a] - a >= d]
        if not len(a):
            return
        yield a, a + d


def most_apart(both: np.ndarray, similarity: float) -> np.ndarray:
    """In how many words two sets of so many words together may differ."""
    return np.floor(both * (1 - similarity) / (1 + similarity) + 1e-6).astype(np.int16)


def blocks(size: np.ndarray, folded: dict[int, np.ndarray], similarity: float, block: int = 256, wide: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of rows in the order of size: all that the length filter and the parities may leave, and few others.

    Rows of about one size are compared as a block, by as many parities as the smallest has.
    """
    lanes, i = lanes_of(size), 0
    while i < len(size):
        k = min(i + block, int(np.searchsorted(size, size[i] * 1.05, "right")))
        high = int(np.searchsorted(size * similarity - 1e-9, size[k - 1], "right"))
        maps = folded[int(lanes[i])]
        for j in range(i, high, wide):
            l = min(j + wide, high)
            apart = np.bitwise_count(maps[i:k, None, 0] ^ maps[None, j:l, 0])
            for m in range(1, maps.shape[1]):
                apart = apart + np.bitwise_count(maps[i:k, None, m] ^ maps[None, j:l, m]).astype(np.int16)
            a, b = np.nonzero(apart <= most_apart(size[k - 1] + size[j:l], similarity).astype(np.uint8 if maps.shape[1] == 1 else np.int16))
            a, b = a + i, b + j
            yield a[a < b], b[a < b]
        i = k


def compared(key: np.ndarray, sig: np.ndarray, place: np.ndarray, maps: np.ndarray, similarity: float, own: np.ndarray | None = None) -> pa.RecordBatch:
    """(sig, key, partners) of the rows, in the order of key and place, that have a partner under their key; own: of another part only."""
    size, names = place >> 32, mix(sig.view(np.uint64))
    rest, lanes = size - (place & 0xFFFFFFFF), lanes_of(size)
    pairs_ = np.where((lanes == 4)[:, None], maps[:, :2] ^ maps[:, 2:], maps[:, :2])
    folded = {1: np.bitwise_xor.reduce(maps, axis=1)[:, None], 2: pairs_, 4: maps}
    partners, some = np.zeros(len(key), np.uint64), np.zeros(len(key), bool)

    one, limit = np.ascontiguousarray(folded[1][:, 0]), most_apart(np.arange(2 * int(size.max(initial=0)) + 1), similarity)

    def settle(a: np.ndarray, b: np.ndarray) -> None:
        ok = np.bitwise_count(one[a] ^ one[b]) <= limit[size[a] + size[b]]
        a, b = a[ok], b[ok]
        needed = similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9  # the least number of common words
        ok = (np.minimum(rest[a], rest[b]) >= needed) & (size[a] >= size[b] * similarity - 1e-9)
        if own is not None:
            ok &= own[a] != own[b]
        a, b, needed = a[ok], b[ok], needed[ok]
        for n, bits in folded.items():
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            ok = ((size[a] + size[b] - apart) / 2 >= needed) | (np.minimum(lanes[a], lanes[b]) < n)
            a, b, needed = a[ok], b[ok], needed[ok]
        np.add.at(partners, a, names[b])
        np.add.at(partners, b, names[a])
        some[a] = some[b] = True

    first = np.nonzero(np.diff(key, prepend=key[:1] - 1))[0]
    n = np.diff(np.append(first, len(key)))
    few = np.nonzero(np.repeat(n <= FEW, n))[0]
    for a, b in neighbours(key[few], size[few], similarity):
        settle(few[a], few[b])
    for i, k in zip(first[n > FEW].tolist(), n[n > FEW].tolist(), strict=True):
        for a, b in blocks(size[i : i + k], {m: x[i : i + k] for m, x in folded.items()}, similarity):
            if len(a):
                settle(a + i, b + i)
    columns = {"sig": sig[some], "key": key[some], "partners": partners[some].view(np.int64)}
    return pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})


def members(index: DataFrame, similarity: float, crowded: DataFrame | None = None) -> DataFrame:
    """(sig, key): under which keys each class must be compared to find all its links.

    Within a key's group pairs pass the length, positional and parity filters or go. A class
    is left with the keys under which it has partners; of several with the same partners the
    first, which is enough: under the first key that two classes have in common, neither has
    the other before, so neither drops it. crowded: rows of prefix_rows with common=True and
    the number n of their key's, which are compared in parts, two to a task.
    """
    kind = "sig long, key long, partners long"

    def run(t: pa.Table) -> pa.Table:
        parts = [undealt(n, p) for n, p in zip(t["n"].to_pylist(), t["packed"].to_pylist(), strict=True)]
        key, sig, place, maps = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((place, key))
        key = key[order]
        cuts = np.unique(np.append(np.searchsorted(key, key[:: 1 << 17]), len(key)))  # no key is split
        return pa.Table.from_batches([compared(key[i:j], sig[order[i:j]], place[order[i:j]], maps[order[i:j]], similarity) for i, j in zip(cuts, cuts[1:], strict=False)])

    def run_parts(t: pa.Table) -> pa.Table:
        t = t.sort_by("place")
        own, key, sig, place, *maps = (t[c].to_numpy() for c in ("own", *ROW.names))
        same = bool(t["ti"][0] == t["tj"][0])
        return pa.Table.from_batches([compared(key, sig, place, np.stack(maps, 1).view(np.uint64), similarity, None if same else own)])

    found = index.groupBy("bucket").applyInArrow(run, kind)
    if crowded is not None:
        parts = in_tiles(crowded, CROWD // 2).groupBy("key", "ti", "tj").applyInArrow(run_parts, kind)
        found = found.unionByName(parts.groupBy("sig", "key").agg(F.bit_xor("partners").alias("partners")))
    return found.repartition("sig").groupBy("sig", "partners").agg(F.min("key").alias("key")).select("sig", "key")


def in_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """rows (key, sig, n, ..) of keys of n rows dealt into tiles: once for each pair (ti, tj) of tiles that theirs, own, is one of."""
    return (
        rows.withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("sig"), F.col("tiles")).cast("int"))
        .withColumn("k", F.explode(F.expr("sequence(0, tiles - 1)")))
        .withColumn("ti", F.least("own", "k"))
        .withColumn("tj", F.greatest("own", "k"))
        .drop("n", "tiles", "k")
    )


def stretches(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The stretches of data that belong to rows, one after the other."""
    n = sizes[rows]
    return data[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def links_in_groups(classes: DataFrame, found: DataFrame, counts, similarity: float, words_at_once: int = 1 << 21) -> DataFrame:
    """(sig, other, more): per class and key of found (sig, key), the links whose first common word is the key.

    Pairs live in numpy arrays of a task only; each group gives sums and minima for its classes.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, 1 << 15):
            key, sig, doc, line, copies, size = (t[c].to_numpy() for c in ("key", "sig", "doc_id", "line_no", "copies", "size"))
            size, words = size.astype(np.int64), numbers_of(t["words"].combine_chunks())
            starts = np.cumsum(size) - size
            spread = mix(words.astype(np.uint64))
            bit, lane = np.uint64(1) << (spread & np.uint64(63)), spread >> np.uint64(6) & np.uint64(3)
            maps = [np.bitwise_xor.reduceat(np.where(lane == k, bit, np.uint64(0)), starts) for k in range(4)]
            order = np.lexsort((line, doc))
            age = np.empty(len(order), np.int64)
            age[order] = np.arange(len(order))
            oldest, more = np.full(len(key), len(key)), np.zeros(len(key), np.int64)

            def count(a: np.ndarray, b: np.ndarray) -> None:
                m, n = size[a], size[b]
                pair = np.arange(len(a), dtype=np.uint64) << np.uint64(32)
                both = np.sort(np.concatenate([np.repeat(pair, m) | stretches(words, starts, size, a), np.repeat(pair, n) | stretches(words, starts, size, b)]))
                twice = both[1:][both[1:] == both[:-1]]
                pair = (twice >> np.uint64(32)).astype(np.int64)
                shared = np.bincount(pair, minlength=len(a))
                cuts = np.nonzero(np.diff(pair, prepend=-1))[0]  # a pair has its key in common at least
                first = np.minimum.reduceat(order_keys(twice.astype(np.uint32), counts.value), cuts)
                ok = (shared >= similarity * (m + n - shared) - 1e-9) & (first == key[a])
                a, b = a[ok], b[ok]
                for x, y in ((a, b), (b, a)):
                    np.minimum.at(oldest, x, age[y])
                    np.add.at(more, x, copies[y])

            left, right, held = [], [], 0
            for a, b in neighbours(key, size, similarity):
                both = size[a] + size[b]
                apart = sum(np.bitwise_count(m[a] ^ m[b]).astype(np.int64) for m in maps)
                ok = (both - apart) / 2 >= similarity / (1 + similarity) * both - 1e-9
                left.append(a[ok])
                right.append(b[ok])
                held += int(both[ok].sum())
                if held > words_at_once:
                    count(np.concatenate(left), np.concatenate(right))
                    left, right, held = [], [], 0
            if held:
                count(np.concatenate(left), np.concatenate(right))
            some = np.nonzero(more)[0]
            other = order[oldest[some]]
            yield pa.RecordBatch.from_pydict({"sig": pa.array(sig[some]), "doc_id": pa.array(doc[other]), "line_no": pa.array(line[other]), "more": pa.array(more[some])})

    full = found.join(classes.select("sig", "first.doc_id", "first.line_no", "copies", "size", "words"), "sig")
    ready = full.select("key", "sig", "doc_id", "line_no", "copies", "size", "words").repartition("key").sortWithinPartitions("key", "size")
    found = ready.mapInArrow(verify, "sig long, doc_id long, line_no int, more long")
    return found.select("sig", F.struct("doc_id", "line_no").alias("other"), "more")


def links_in_tiles(classes: DataFrame, crowded: DataFrame, counts, similarity: float, tile: int = 256) -> DataFrame:
    """(sig, other, more): per class and tile pair, the links whose first common word is in crowded (key, sig, n).

    Groups of any size are dealt into tiles; a task compares two tiles by matrix products
    over their words and returns sums and minima for each class, never the pairs.
    """
    dealt = in_tiles(crowded, tile).join(classes.select("sig", "first.doc_id", "first.line_no", "copies", "words"), "sig")

    def compare(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        key, ti, tj = (int(v) for v in group)
        pdf = pdf.sort_values(["doc_id", "line_no"], ignore_index=True)
        own, copies = pdf["own"].to_numpy(), pdf["copies"].to_numpy(np.float64)
        size = np.array([len(w) // 4 for w in pdf["words"]])
        words = order_keys(np.frombuffer(b"".join(pdf["words"]), np.uint32), counts.value)
        names, column = np.unique(words, return_inverse=True)
        has = np.zeros((len(pdf), len(names)), np.float32)
        has[np.repeat(np.arange(len(pdf)), size), column] = 1
        before = int(np.searchsorted(names, key))
        left, right = np.nonzero(own == ti)[0], np.nonzero(own == tj)[0]
        shared = has[left] @ has[right].T
        earlier = has[left, :before] @ has[right, :before].T
        link = (shared >= similarity * (size[left][:, None] + size[right][None, :] - shared) - 1e-9) & (earlier == 0)
        if ti == tj:
            np.fill_diagonal(link, False)
        out = []
        for rows_, cols, m in ((left, right, link), (right, left, link.T))[: 1 if ti == tj else 2]:
            some = np.nonzero(m.any(axis=1))[0] if m.size else np.zeros(0, np.int64)
            partner = cols[m[some].argmax(axis=1)] if len(some) else some  # rows are in order, so this is the earliest
            out.append(pd.DataFrame({"sig": pdf["sig"].to_numpy()[rows_[some]], "doc_id": pdf["doc_id"].to_numpy()[partner], "line_no": pdf["line_no"].to_numpy()[partner], "more": (m[some] @ copies[cols]).astype(np.int64)}))
        return pd.concat(out)

    found = dealt.groupBy("key", "ti", "tj").applyInPandas(compare, "sig long, doc_id long, line_no int, more long")
    return found.select("sig", F.struct("doc_id", "line_no").alias("other"), "more")


def matched_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, line_no, n_links, first_doc, first_line, removed) of every line with a word.

    Lines end at \\n. Two lines match if their sets of words (lower case A-Z, between ASCII
    white space) have a Jaccard similarity of at least `similarity`. n_links counts a line's
    matches; (first_doc, first_line) is its earliest match or itself, in the order of doc_id
    and line number; removed: there is an earlier one. Lines with equal sets are one class and
    never paired. Null and empty texts have no lines; rows of a null id are left out; a row
    that occurs twice gives its lines twice, each linked to its copy, with the same first line
    (removed only where that is another line); an empty table gives no rows. Words are told
    apart by 32-bit hashes, sets of them by 64-bit ones.
    """
    docs = docs.where("doc_id is not null")
    classes = bucketed(classes_of(docs), "sig")  # the word sets are never shuffled again
    counts = docs.sparkSession.sparkContext.broadcast(word_counts(classes))
    busy = staged(prefix_rows(classes, counts, similarity, common=True))
    crowds = staged(busy.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD))
    index = prefix_rows(classes, counts, similarity, common=False).unionByName(packed_rows(busy.join(crowds, "key", "left_anti")))
    found = staged(members(index, similarity, busy.join(crowds, "key")))
    crowds = staged(found.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > COMMON))
    linked = links_in_groups(classes, found.join(crowds, "key", "left_anti"), counts, similarity).unionByName(
        links_in_tiles(classes, found.join(crowds, "key"), counts, similarity)
    )
    partners = linked.groupBy(F.col("sig").alias("x")).agg(F.min("other").alias("other"), F.sum("more").alias("more"))
    of_class = staged(
        classes.join(partners, F.col("sig") == F.col("x"), "left").select(
            "sig", F.least("first", F.coalesce("other", "first")).alias("first"), (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")
        )
    )
    return lines_of(docs).join(of_class, "sig").select(
        "doc_id", "line_no", "n_links", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_line"),
        (F.struct("doc_id", "line_no") != F.col("first")).alias("removed"),
    )


def remove_later(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """docs without the lines that match an earlier one; documents of which no word is left go.

    All columns stay, whatever their names; n_chars is counted anew where a line went. Documents
    that lose no line, null texts and rows of a null id stay as they are; equal rows lose the
    same lines; an empty table stays empty.
    """
    id_, gone = fresh(docs, "id"), fresh(docs, "gone")
    later = matched_lines(docs.select("doc_id", "text"), similarity).where("removed").groupBy("doc_id")
    later = staged(later.agg(F.collect_set("line_no").alias(gone)))  # bounded by a text's lines
    docs, whole = split_by_keys(docs, later, ["doc_id"])
    later = later.withColumnRenamed("doc_id", id_).hint("merge")  # it grows with the texts and is never broadcast
    # the index of a line among all lines of its text
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    hit = F.col(gone).isNotNull()
    out = docs.join(later, docs["doc_id"] == later[id_], "left").withColumn("text", F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text")))
    out = out.where(~hit | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop(id_, gone).unionByName(whole)
