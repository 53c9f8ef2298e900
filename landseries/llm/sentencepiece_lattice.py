"""SentencePiece encoding and decoding over a lattice of vocabulary pieces.

Texts fall into segments, runs of the space mark with what follows them, across which no
piece reaches. A segment's lattice holds an edge for every substring of bounded length that
is a piece. A unigram model is folded by Viterbi (best sum of scores). A BPE model, which is
what the public vocabulary is, is folded by its merges: Viterbi gives other pieces there.

`encode` builds the lattices of a batch's distinct segments as arrays inside Spark tasks;
`encode_relational` builds them as a relation (explode, equi-join, group, fold).
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landseries.llm.common import known_id, with_null_ids
from landseries.llm.tokens import BASE, mix, powers

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: A worker forgets the segments that it has encoded beyond this many and begins anew.
REMEMBERED = 300_000
#: Hashes of pieces are found by this many leading bits.
SLOT_BITS = 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids, self.bytes, normal = {}, [], []
        for i in range(m.get_piece_size()):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.bytes.append(b"")
            else:
                normal.append((p, i, m.get_score(i)))
                self.bytes.append(p.replace(MARK, " ").encode())
        self.pieces = normal
        self.longest = max(len(p) for p, _, _ in normal)
        if any(MARK in p.lstrip(MARK) for p, _, _ in normal):
            raise ValueError("a piece spans two segments")
        keys = np.concatenate([substrings(codes([p]), len(p))[:, 0] for p, _, _ in normal])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array([i for _, i, _ in normal], np.int32)[order]
        self.scores = np.array([s for _, _, s in normal], np.float64)[order]
        # where the keys of each leading bit pattern begin; so many patterns that few keys share one
        self.slots = np.searchsorted(self.keys >> np.uint64(64 - SLOT_BITS), np.arange((1 << SLOT_BITS) + 1)).astype(np.int32)
        self.probes = int(np.diff(self.slots).max())

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash among the keys, and whether it is there."""
        at = self.slots[hashes >> np.uint64(64 - SLOT_BITS)]
        at = np.minimum(at, len(self.keys) - 1)
        hit = self.keys[at] == hashes
        for k in range(1, self.probes):
            then = np.minimum(at + k, len(self.keys) - 1)
            more = ~hit & (self.keys[then] == hashes)
            at, hit = np.where(more, then, at), hit | more
        return at, hit

    def lattice(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and scores of the substrings of equally long segments, by segment, start, length."""
        w, n = chars.shape
        top = min(n, self.longest)
        ids = np.full((w, n, top + 1), -1, np.int32)
        scores = np.full((w, n, top + 1), -np.inf)
        for size in range(1, top + 1):
            at, hit = self.find(substrings(chars, size))
            ids[:, : n - size + 1, size] = np.where(hit, self.ids[at], -1)
            scores[:, : n - size + 1, size] = np.where(hit, self.scores[at], -np.inf)
        return ids, scores

    def encode_segments(self, segments: list[str], viterbi: bool = False, cells: int = 1 << 21) -> list[bytes]:
        """The ids of each segment as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(segments)
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, s in enumerate(segments):
            by_size[len(s)].append(k)
        for n, rows in by_size.items():
            step = max(1, cells // (n * (min(n, self.longest) + 1)))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                ids, scores = self.lattice(codes([segments[k] for k in part]))
                ends = best_path(scores) if viterbi else merges(scores)
                row, start = np.nonzero(ends > 0)
                size = ends[row, start] - start
                piece = ids[row, start, size]
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                packed, ends4 = piece.astype("<i4").tobytes(), (cuts * 4).tolist()
                for k, i, j in zip(part, ends4, ends4[1:], strict=False):
                    out[k] = packed[i:j]
                for j in np.unique(row[piece < 0]).tolist():
                    k, own = part[j], slice(cuts[j], cuts[j + 1])
                    bytewise = [i for p, c in zip(piece[own], start[own], strict=True) for i in ([p] if p >= 0 else [self.byte_ids[b] for b in segments[k][c].encode("utf-8", "surrogatepass")])]
                    out[k] = np.asarray(bytewise, "<i4").tobytes()
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids))
        return raw[raw[:1] == b" " :].decode("utf-8", "replace")


def codes(segments: list[str]) -> np.ndarray:
    """The code points of segments of one length, a row each."""
    return np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(segments), -1)


def substrings(chars: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all substrings of this length of each row."""
    n = chars.shape[1]
    sums = np.zeros((len(chars), n + 1), np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers(n), axis=1, out=sums[:, 1:])
    back = powers(n, pow(BASE, -1, 1 << 64))[: n - size + 1]
    return mix((sums[:, size:] - sums[:, : n - size + 1]) * back + np.uint64(size))


def merges(scores: np.ndarray) -> np.ndarray:
    """BPE: join the neighbours whose piece scores best, leftmost first, until none is left.

    Returns, by segment and start, where the piece that starts there ends (0: none starts).
    """
    w, n, top = scores.shape
    ends = np.tile(np.arange(1, n + 1), (w, 1))
    live = np.arange(w)
    while len(live):
        e = ends[live]
        nxt = np.minimum(e, n - 1)
        end2 = np.take_along_axis(e, nxt, 1)
        size = end2 - np.arange(n)
        able = (e > 0) & (e < n) & (size < top)
        value = np.where(able, scores[live[:, None], np.arange(n), np.where(able, size, 0)], -np.inf)
        best = value.argmax(axis=1)
        rows = np.arange(len(live))
        go = value[rows, best] > -np.inf
        live, best, rows = live[go], best[go], rows[go]
        right = nxt[rows, best]
        ends[live, best] = end2[rows, best]
        ends[live, right] = 0
    return ends


def best_path(scores: np.ndarray, unknown: float = -1e6) -> np.ndarray:
    """Viterbi: the cover with the best sum of scores; characters without a piece cost `unknown`.

    Of equal covers the one whose last pieces are shortest. Returns ends as merges() does.
    """
    w, n, top = scores.shape
    s = scores.copy()
    s[:, :, 1] = np.where(np.isinf(s[:, :, 1]), unknown, s[:, :, 1])
    best = np.full((w, n + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((w, n + 1), np.int64)
    for end in range(1, n + 1):
        for size in range(1, min(end, top - 1) + 1):
            v = best[:, end - size] + s[:, end - size, size]
            better = v > best[:, end]
            best[better, end] = v[better]
            back[better, end] = size
    ends = np.zeros((w, n), np.int64)
    at = np.full(w, n)
    rows = np.arange(w)
    while len(rows):
        start = at - back[rows, at]
        ends[rows, start] = at
        go = start > 0
        rows, at = rows[go], start[go]
    return ends


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def remembered(path: str, viterbi: bool) -> dict[str, bytes]:
    return {}


def segments(text: str | None) -> list[str]:
    """The segments of a text, with the leading space mark that the model adds."""
    return SEGMENT.findall(MARK + text.replace(" ", MARK)) if text else []


def encode(docs: DataFrame, path: str | None = None, viterbi: bool = False) -> DataFrame:
    """(doc_id, ids) of every row: its pieces' ids as little-endian 32-bit numbers.

    Null and empty texts have no pieces. Characters outside the vocabulary become byte
    pieces. Repeated rows come out repeated, an empty table gives no rows, further columns
    are ignored. Each batch's new distinct segments are encoded together, by length.
    """
    path = path or default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, known = vocabulary(path), remembered(path, viterbi)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                lists = [segments(t) for t in part["text"]]
                new = {s for x in lists for s in x if s not in known}
                if len(known) > REMEMBERED:
                    known.clear()
                    new = {s for x in lists for s in x}
                new = list(new)
                known.update(zip(new, v.encode_segments(new, viterbi), strict=True))
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": [b"".join(map(known.__getitem__, x)) for x in lists]})

    return docs.select(known_id(), "text").mapInPandas(run, "doc_id long, ids binary").transform(with_null_ids)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, text) of (doc_id, ids)."""
    path = path or default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for b in batches:
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "n_pieces": [len(x) // 4 for x in b["ids"]], "ids_crc32": [zlib.crc32(x) for x in b["ids"]],
                "text": [v.decode(np.frombuffer(x, "<i4").tolist()) for x in b["ids"]],
            })

    return encoded.select(known_id(), "ids").mapInPandas(run, "doc_id long, n_pieces long, ids_crc32 long, text string").transform(with_null_ids)


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(piece, id, score): the model's pieces, a table of the vocabulary's size."""
    return spark.createDataFrame(pd.DataFrame(vocabulary(path or default_model()).pieces, columns=["piece", "id", "score"]), "piece string, id int, score double")


def encode_relational(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, pieces): the same BPE pieces, as strings, by DataFrame operations alone.

    Distinct segments, all their substrings of bounded length, an equi-join to the pieces,
    the edges grouped by segment, and the merges folded with the aggregate function; then
    the segments' occurrences are joined and put in order. Characters outside the vocabulary
    stay single characters. Every occurrence of every segment is shuffled.
    """
    spark = docs.sparkSession
    marked = F.concat(F.lit(MARK), F.regexp_replace("text", " ", MARK))
    split = F.when(F.length("text") > 0, F.regexp_extract_all(marked, F.lit(f"({MARK}*[^{MARK}]+|{MARK}+)"), F.lit(1)))
    placed = docs.select("doc_id", F.posexplode_outer(split).alias("at", "segment"))
    longest = vocabulary(path or default_model()).longest
    words = placed.select("segment").where("segment is not null").distinct()
    subs = (
        words.withColumn("start", F.explode(F.sequence(F.lit(1), F.length("segment"))))
        .withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("segment") - F.col("start") + 1))))
        .withColumn("piece", F.substring("segment", F.col("start"), F.col("size")))
    )
    edges = subs.join(F.broadcast(piece_table(spark, path)), "piece", "left").where("size > 1 and id is not null or size = 1")
    lattice = edges.groupBy("segment").agg(F.map_from_entries(F.collect_set(F.struct("piece", F.coalesce("score", F.lit(0.0))))).alias("scores"))
    fold = """
        aggregate(sequence(1, length(segment)), filter(split(segment, ''), c -> c != ''), (p, k) ->
          transform(array(array_max(transform(sequence(1, greatest(1, size(p) - 1)), i -> struct(scores[concat(get(p, i - 1), get(p, i))] as s, -i as i)))), best ->
            case when size(p) < 2 or best.s is null then p
            else concat(slice(p, 1, -best.i - 1), array(concat(get(p, -best.i - 1), get(p, -best.i))), slice(p, -best.i + 2, size(p))) end)[0])
    """
    folded = lattice.withColumn("pieces", F.expr(fold)).select("segment", "pieces")
    return (
        placed.join(folded, "segment", "left").groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", "pieces"))).alias("parts"))
        .select("doc_id", F.flatten(F.filter(F.transform("parts", lambda x: x["pieces"]), lambda x: x.isNotNull())).alias("pieces"))
    )
