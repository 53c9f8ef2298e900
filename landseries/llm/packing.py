"""Best-fit packing of token sequences by exact-complement hashing of lengths."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landseries.llm.common import fresh, known_id, with_null_ids

CAPACITY = 2048


@lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """The byte-level BPE of a file of ranks; texts' <|endoftext|> is id 50256, as the tokenizer file has it."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


@lru_cache(maxsize=2)
def plain_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Texts with so long a run of white space go to `tokenizers`: the other's pattern gives up on them.
LONG_RUN = re.compile(r"\s{1000}")


def ids_of(text: str, ranks_path: str, json_path: str) -> np.ndarray:
    """The ids that `tokenizers` gives, taken from the same vocabulary by `tiktoken`, which is faster."""
    if LONG_RUN.search(text):
        return np.array(plain_tokenizer(json_path).encode(text, add_special_tokens=False).ids, np.uint32)
    return encoder(ranks_path).encode_to_numpy(text, allowed_special="all")


def default_json() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, ranks_path: str | None = None, json_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row: its ids and a final 0, cut at capacity.

    Only the first piece may be shorter. Null texts count as empty: one piece that holds id 0.
    The two files hold one vocabulary. Null ids stay null, repeated rows come out repeated,
    an empty table gives no rows, further columns are ignored.
    """
    ranks, json = ranks_path or default_ranks(), json_path or default_json()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids = np.append(ids_of(text or "", ranks, json), 0).astype("<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                ends = range(first, len(ids) + 1, capacity)
                for k, end in enumerate(ends):
                    start = 0 if k == 0 else end - capacity
                    part = ids[start:end]
                    row = (doc, k, start, end - start, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return with_null_ids(docs.select(known_id(), "text").mapInPandas(run, schema))


class Counts:
    """How many items of each length are left, and which patterns were consumed."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left, self.capacity = counts.astype(np.int64).copy(), capacity
        self.patterns: list[tuple[tuple[int, ...], int]] = []

    def take(self, *lengths: int) -> bool:
        """Consume this combination as often as the counts allow."""
        n = min(self.left[x] // lengths.count(x) for x in lengths)
        if n > 0:
            for x in lengths:
                self.left[x] -= n
            self.patterns.append((lengths, int(n)))
        return n > 0

    def pair_for(self, total: int, floor: int = 1) -> Iterator[tuple[int, int]]:
        """Pairs of lengths in stock with this sum, the larger first."""
        low = np.arange(max(1, floor), total // 2 + 1)
        low = low[(self.left[low] > 0) & (self.left[total - low] > 0)]
        for a in low:
            yield int(total - a), int(a)

    def pair_sums(self) -> np.ndarray:
        """Whether two lengths in stock have each sum up to the capacity."""
        stock = np.zeros(self.capacity + 1)
        stock[np.nonzero(self.left[: self.capacity + 1])[0]] = 1
        size = 1 << (2 * self.capacity + 2).bit_length()
        return np.fft.irfft(np.fft.rfft(stock, size) ** 2, size)[: self.capacity + 1] > 0.5

    def exact(self, most: int) -> None:
        """Fill gaps exactly: by one length, then by a pair's sum, then by a triple's; by up to `most` together."""
        cap = self.capacity
        if self.left[cap]:
            self.take(cap)
        down = range(cap - 1, 0, -1)
        for x in down if most > 0 else ():
            if self.left[x] and 2 * x >= cap:
                self.take(x, cap - x)
        for x in down if most > 1 else ():
            if self.left[x]:
                for pair in self.pair_for(cap - x):
                    self.take(x, *pair)
                    if not self.left[x]:
                        break
        for x in down if most > 2 else ():
            if not self.left[x]:
                continue
            reach = self.pair_sums()
            third = np.arange(cap - x - 2, 0, -1)
            for y in third[(self.left[third] > 0) & reach[cap - x - third]]:
                for pair in self.pair_for(int(cap - x - y)):
                    self.take(x, int(y), *pair)
                    if not self.left[x] or not self.left[y]:
                        break
                if not self.left[x]:
                    break

    def best_fit(self) -> None:
        """The rest, longest first, each into the open sequences with the least room that suffices."""
        open_: dict[int, list[list]] = defaultdict(list)
        for x in range(self.capacity, 0, -1):
            n = int(self.left[x])
            self.left[x] = 0
            while n:
                gap = min((g for g in open_ if g >= x and open_[g]), default=None)
                if gap is None:
                    each = self.capacity // x
                    full, rest = divmod(n, each)
                    for size, times in ((each, full), (rest, 1)):
                        if size and times:
                            open_[self.capacity - size * x].append([(x,) * size, times])
                    break
                pattern, times = open_[gap].pop()
                used = min(n, times)
                if used < times:
                    open_[gap].append([pattern, times - used])
                open_[gap - x].append([(*pattern, x), used])
                n -= used
        self.patterns += [(tuple(p), t) for group in open_.values() for p, t in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> pd.DataFrame:
    """Slots (length, first_rank, n, sequence, offset): the items of a length with ranks from first_rank
    on go to n sequences numbered from `sequence`, at this offset. The work depends on the capacity alone.

    Exact fills by triples, by pairs, by single lengths and none are tried before best fit; the
    plan of fewest sequences stays, for fills can use up the short items that best fit needs."""
    tried = []
    for most in (3, 2, 1, 0):
        stock = Counts(counts, capacity)
        stock.exact(most)
        stock.best_fit()
        tried.append(stock)
    stock = min(tried, key=lambda t: sum(n for _, n in t.patterns))
    rows, used, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for pattern, times in stock.patterns:
        offset = 0
        for x in pattern:
            rows.append((x, used[x], times, sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    slots = pd.DataFrame(rows, columns=["length", "first_rank", "n", "sequence", "offset"])
    return slots.sort_values(["length", "first_rank"], ignore_index=True)


def place(rows: DataFrame, capacity: int = CAPACITY, per_bucket: int = 20_000) -> DataFrame:
    """rows (doc_id, piece, length, ...) with sequence_id and offset; rows must be a stored table.

    Rows of null ids and repeated rows are placed like others, each once; an empty table stays
    empty; columns that rows has besides stay, whatever their names, but for sequence_id and
    offset, which are set anew.

    Only the histogram of lengths (capacity numbers) reaches the driver. An item's rank among
    those of its length is the number in earlier buckets plus its place in its own, so a
    length that many items share is ranked in many tasks.
    """
    spark = rows.sparkSession
    histogram = rows.groupBy("length").count().toPandas()
    counts = np.zeros(capacity + 1, np.int64)
    counts[histogram["length"].to_numpy(np.int64)] = histogram["count"]
    slots = plan(counts, capacity)
    buckets = max(16, int(counts.sum()) // per_bucket)
    bucket, before, within, rank, place_ = (fresh(rows, c) for c in ("bucket", "before", "within", "rank", "slot"))
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    earlier = (
        dealt.groupBy("length", bucket).agg(F.count("*").alias(within))
        .select("length", bucket, (F.sum(within).over(Window.partitionBy("length").orderBy(bucket)) - F.col(within)).alias(before))
    )
    place_in = F.row_number().over(Window.partitionBy("length", bucket).orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn(within, place_in).join(earlier, ["length", bucket]).withColumn(rank, F.col(before) + F.col(within))
    shared = spark.sparkContext.broadcast(
        (slots["length"].to_numpy(np.int64) * (1 << 42) + slots["first_rank"].to_numpy(np.int64), *(slots[c].to_numpy(np.int64) for c in ("first_rank", "sequence", "offset")))
    )

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key, first, sequence, offset = shared.value
        at = np.searchsorted(key, length.to_numpy(np.int64) * (1 << 42) + rank.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank.to_numpy() - first[at], "offset": offset[at]})

    placed = ranked.withColumn(place_, slot("length", rank))
    kept = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    return placed.select(*kept, F.col(place_)["sequence_id"].alias("sequence_id"), F.col(place_)["offset"].alias("offset"))
