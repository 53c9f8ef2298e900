"""Null ids, repeated rows, clashing columns, long texts; and parts of operators against plain versions of them."""

import hashlib
import math
import zlib

import numpy as np
import pytest

from landseries.llm import embedding_dedup, langid, line_dedup, packing, quality, sentencepiece_lattice, simhash, substring_dedup, suffix_tree, webp

BIG = 2**53 + 1  # not a float
LINE = "one two three four five six seven eight nine ten eleven twelve"
TEXT = "\n".join(f"{LINE} {k} again and the dog in that house" for k in range(6))
ODD = [(BIG, TEXT), (BIG, TEXT), (None, TEXT), (5, None), (6, ""), (7, "x" * 1_000_000), (8, TEXT + " end"), (None, None)]
OPERATORS = {
    "op1": lambda d: packing.place(packing.pieces(d)),
    "op2": lambda d: quality.classify(d, d.selectExpr("doc_id", "1 as quality")),
    "op4": langid.identify,
    "op6": lambda d: sentencepiece_lattice.decode(sentencepiece_lattice.encode(d.where("length(text) < 1000 or text is null"))),
    "op7": suffix_tree.score,
    "op9": simhash.near_duplicates,
    "op10": webp.digest,
}
STAGES = {"op4": langid.keep_identified, "op8": line_dedup.remove_later, "op9": simhash.keep_one, "op3": substring_dedup.remove_repeats}
NAMES = "row,cut,spans,gone,p,_p,id,later,h,k,n,first,bucket,component_id,fp,lang_pred,score,b_id,part,kind,x,sig".split(",")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "en", *("v",) * len(NAMES)) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in NAMES))


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay_whole(odd, name):
    rows = OPERATORS[name](odd).collect()
    ids = [r.doc_id for r in rows if getattr(r, "piece", 0) == 0]
    want = [d for d, t in ODD if name != "op6" or t is None or len(t) < 1000]
    assert sorted(ids, key=str) == sorted(want, key=str)
    assert OPERATORS[name](odd.where("false")).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_of_any_name(odd, name):
    out = STAGES[name](odd)
    assert out.columns == odd.columns
    rows = out.collect()
    assert all(r[c] == "v" for r in rows for c in NAMES)
    assert [r.doc_id for r in rows].count(BIG) in (0, 2) and len({r.text for r in rows if r.doc_id == BIG}) <= 1
    if name != "op4":
        assert [r.text for r in rows if r.doc_id is None and r.text] == [TEXT]
    assert STAGES[name](odd.where("false")).count() == 0


def test_packing_keeps_columns_of_any_name(spark):
    names = ["bucket", "before", "within", "rank", "slot", "sequence_id"]
    rows = [(k, 0, 100 + k, k, *("mine",) * len(names)) for k in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long, " + ", ".join(f"{n} string" for n in names))
    got = packing.place(table).collect()
    assert len(got) == 50 and all(r[n] == "mine" for r in got for n in names[:-1])
    ends = {}
    for r in got:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in sorted(x)[:k]) == o for x in ends.values() for k, (o, _) in enumerate(sorted(x)))


def test_equal_rows_in_joins(spark):
    docs = spark.createDataFrame([(1, TEXT * 3), (1, TEXT * 3), (2, TEXT * 3), (2, TEXT * 3), (3, "short")], "doc_id long, text string")
    got = substring_dedup.repeated_passages(docs).collect()
    assert {(r.doc_id, r.source_id) for r in got} == {(2, 1)} and len(got) == 1
    assert sorted(r.doc_id for r in substring_dedup.remove_repeats(docs).collect()) == [1, 1, 3]
    vectors = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)], "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(vectors).collect()}[1] == 1


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        held.append(docs.count())
        assert docs.columns == columns
    assert held == sorted(held, reverse=True) and held[-1] > 0.7 * held[0]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in sorted(x)[:k]) == o for x in by.values() for k, (o, _) in enumerate(sorted(x)))


def test_ids_equal_the_tokenizer():
    plain = packing.plain_tokenizer(packing.default_json())
    for t in (" " * 200_000, "a" * 200_000, "x" + "\n" * 5000 + "y z", "a <|endoftext|> b", " \t" * 3000 + "end"):
        assert packing.ids_of(t, packing.default_ranks(), packing.default_json()).tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_never_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 101, 400), minlength=101)
    left = []
    for x in sorted(np.repeat(np.arange(101), counts), reverse=True):
        room = [r for r in left if r >= x]
        r = min(room) if room else 100
        if room:
            left.remove(r)
        left.append(r - x)
    slots = packing.plan(counts, 100)
    assert math.ceil((counts @ np.arange(101)) / 100) <= (slots["sequence"] + slots["n"]).max() <= len(left)


def plain_tree(texts: list[bytes], min_gain: float):
    """Counts of all contexts, the states, and a function for the probability of a symbol: dictionaries and loops."""
    depth, low = suffix_tree.DEPTH, suffix_tree.LOW
    count: dict[bytes, dict[int, int]] = {}
    for t in texts:
        t = suffix_tree.START + t + suffix_tree.END
        for at in range(depth, len(t)):
            for k in range(depth + 1):
                own = count.setdefault(t[at - k : at], {})
                own[t[at]] = own.get(t[at], 0) + 1

    def p(context: bytes, s: int) -> float:
        own = count[context]
        total, kinds = sum(own.values()), len(own)
        below = p(context[1:], s) if context else 1 / 256
        return (own.get(s, 0) + kinds * below) / (total + kinds)

    states = set()
    for c, own in count.items():
        saved = sum(n * math.log2(p(c, s) / p(c[1:], s)) for s, n in own.items()) if c else 0
        if len(c) <= low or saved - 0.5 * len(own) * math.log2(sum(own.values()) + 1) >= min_gain:
            states |= {c[k:] for k in range(len(c) + 1)}
    return states, p


@pytest.mark.parametrize("cached", [0, 300, 10**9])
def test_scores_equal_brute_force(spark, cached):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcd"), rng.integers(1, 6))) for _ in range(12)]
    rows = [(k, " ".join(rng.choice(words, rng.integers(0, 30)))) for k in range(60)]
    train = [suffix_tree.normalised(t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    states, p = plain_tree(train, -2.0)
    assert any(len(c) > 3 for c in states)
    got = {r.doc_id: r.score for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), cached=cached, min_gain=-2.0).collect()}
    for d, t in rows:
        t, total = suffix_tree.START + suffix_tree.normalised(t) + suffix_tree.END, 0.0
        for at in range(suffix_tree.DEPTH, len(t)):
            k = next(k for k in range(suffix_tree.DEPTH, -1, -1) if t[at - k : at] in states)
            total += math.log10(p(t[at - k : at], t[at]))
        assert got[d] == pytest.approx(total, rel=1e-4)


def test_fingerprint_bits():
    import xxhash

    text = "The quick  brown\tfox jumps over\nthe lazy dog dog dog dog"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) & (2**64 - 1) == want


def payloads():
    rng = np.random.default_rng(4)
    letters = lambda n, k: bytes(rng.integers(97, 97 + k, n).astype(np.uint8))
    return [b"", b"a", b"x" * 9000, b"ab" * 3000, letters(40_000, 8), bytes(rng.integers(0, 256, 20_000).astype(np.uint8)), letters(300, 26) * 60, b"\xe4\xb8\xad\xe6\x96\x87" * 900, letters(576, 26) * 40]


@pytest.mark.parametrize("k", range(9))
def test_media_round_trip(k):
    raw = payloads()[k]
    raw += webp.PAD * (-len(raw) % webp.ROW or (0 if raw else webp.ROW))
    media = webp.store(raw)
    assert webp.load(media).tobytes() == raw and (k == 5 or len(media) < 0.6 * len(raw))


def test_tokens_resolve_as_one_by_one():
    rng = np.random.default_rng(2)
    for bits in (1, 4):
        kind, value, length, out, cache = [], [], [], [], [0] * (1 << bits)
        keep = lambda p: cache.__setitem__((0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - bits), p)  # noqa: E731, B023
        while len(out) < 500:
            k = int(rng.integers(0, 3)) if out else 0
            n = int(rng.integers(1, 9)) if k == 1 else 1
            v = int(rng.integers(0, 40)) if k == 0 else int(rng.integers(1, len(out) + 1)) if k == 1 else int(rng.integers(0, 1 << bits))
            for _ in range(n):
                out.append(v if k == 0 else out[-v] if k == 1 else cache[v])
                keep(out[-1])
            kind.append(k), value.append(v), length.append(n)
        got = webp.resolved(np.array(kind), np.array(value), np.array(length), len(out), bits)
        # a cache entry that was never written is 0, whose key is 0
        assert got.tolist() == out


def test_predictors_invert():
    rng = np.random.default_rng(3)
    height, width = 9, 11
    want = rng.integers(0, 2**32, (height, width))
    for mode in range(14):
        flat, residual = want.ravel().tolist(), np.zeros(height * width, np.int64)
        for at in range(height * width):
            y, x = divmod(at, width)
            if at == 0:
                guess = 0xFF000000
            elif y == 0:
                guess = flat[at - 1]
            elif x == 0:
                guess = flat[at - width]
            else:
                guess = webp.predicted(mode, flat[at - 1], flat[at - width], flat[at - width - 1], flat[at - width + 1])
            residual[at] = sum(((flat[at] >> s & 255) - (guess >> s & 255) & 255) << s for s in (0, 8, 16, 24))
        modes = np.full((3, 3), mode << 8)
        assert (webp.undo_prediction(residual.reshape(height, width), modes, 2) == want).all(), mode


def test_cross_colour_inverts():
    """Red and blue of one pixel by the format's formulas: signed 3.5 fixed-point factors of green and red."""
    f = (0x10 << 16) | (0xF0 << 8) | 0x20  # red to blue 16, green to blue -16, green to red 32
    got = webp.undo_cross_colour(np.array([[0xFF_05_64_07]]), np.array([[f]]), 2)[0, 0]
    red = (5 + (32 * 100 >> 5)) & 255
    blue = (7 + (-16 * 100 >> 5) + (16 * red >> 5)) & 255
    assert got == 0xFF << 24 | red << 16 | 100 << 8 | blue


def test_entropy_image_and_near_reference():
    """Two groups of codes by blocks of four columns; then a copy from the pixel above."""
    w = webp.header(8, 2)
    w.put(0, 1)  # no transform
    w.put(0, 1)  # no cache
    w.put(1, 1), w.put(0, 3)  # groups, blocks of four
    w.put(0, 1)  # the image of group numbers (2 x 1): no cache; green 0 or 1
    w.put(1, 1), w.put(1, 1), w.put(1, 1), w.put(0, 8), w.put(1, 8)
    for _ in range(4):
        w.put(1, 1), w.put(0, 1), w.put(0, 1), w.put(0, 1)
    w.put(0b10, 2)
    lone = lambda s: (w.put(1, 1), w.put(0, 1), w.put(1, 1), w.put(s, 8))
    for green in (11, None):
        if green is None:  # symbols 22 and 256 + 3 (a copy of four), one bit each
            lengths = np.zeros(280, np.int64)
            lengths[[22, 259]] = 1
            webp.write_prefix(w, lengths)
        else:
            lone(green)
        lone(1), lone(2), lone(255), lone(0)  # distance symbol 0: number 1, the pixel above
    w.put(0b0000, 4)  # four pixels 22 in the first row's second block
    w.put(0b1, 1)  # in the second row: copied from above
    pixels = webp.decode(webp.container(w.bytes()))
    assert pixels[:, :, 1].tolist() == [[11] * 4 + [22] * 4] * 2 and (pixels[:, :, [0, 2, 3]] == [1, 2, 255]).all()


def test_digests(spark):
    rows = [(1, "some text " * 100), (2, None)]
    for r in webp.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        n, p = webp.padded(dict(rows)[r.doc_id])
        m = webp.store(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(m), hashlib.sha256(m).hexdigest(), webp.feature(np.frombuffer(p, np.uint8)))


def test_crowded_words_take_the_tiles(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "COMMON", 20)
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(f"w{v}" for v in rng.choice(16, rng.integers(6, 12), replace=False))) for k in range(300)]
    sets = {k: set(t.split()) for k, t in rows}
    want = {k: sum(len(x & y) >= 0.8 * len(x | y) - 1e-9 for o, y in sets.items() if o != k) for k, x in sets.items()}
    got = {r.doc_id: r.n_links for r in line_dedup.matched_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
