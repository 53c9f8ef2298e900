"""The training-data operators on small tables with nulls, ties, repeats and odd texts."""

import math
import zlib

import numpy as np
import pytest

from landseries.llm import embedding_dedup, langid, line_dedup, packing, quality, sentencepiece_lattice, simhash, substring_dedup, suffix_tree, webp

EN, DE = "the cat and the dog sat on that mat with this hat. ", "der hund und die katze sind nicht auf dem tisch gewesen. "
PASSAGE = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    (0, EN * 4, "en"), (1, EN * 4, "en"), (2, DE * 3, "de"), (3, None, None), (4, "", "en"), (5, "!!! 123", "en"), (6, EN * 3000, "en"),
    (7, "The <|endoftext|> and\x00\tthe　É ▁ß 😀", None), (8, "alpha beta " + PASSAGE + " gamma\nline two", "en"), (9, DE + "\n" + PASSAGE + " omega", "de"), (10, DE * 3 + "x", "de"), (None, "no id", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", 1) for r in TEXTS], "doc_id long, text string, lang string, fp string, score int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_packing(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.place(packing.pieces(docs)).collect()
    for doc, text, _ in TEXTS:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert all(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in own)
        assert sum(r.length for r in own) == len(ids) and all(r.length == 2048 for r in own[1:])
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in sorted(x)[:k]) == o for x in by.values() for k, (o, _) in enumerate(sorted(x)))
    assert len(by) == math.ceil(sum(r.length for r in rows) / 2048)
    assert packing.place(packing.pieces(none)).count() == 0


def test_plan_places_every_item():
    counts = np.zeros(2049, np.int64)
    counts[[2048, 2000, 48, 1500, 300, 248, 700, 600, 500, 100, 3]] = [3, 5, 7, 4, 4, 5, 2, 2, 2, 9, 1000]
    slots = packing.plan(counts)
    placed = slots.groupby("length")["n"].sum()
    assert all(placed.get(x, 0) == counts[x] for x in range(1, 2049))


def test_language(docs, none):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und"
    assert got[0].lang_pred == "en" and got[2].lang_pred == "de"
    assert {r.doc_id for r in langid.keep_identified(docs).collect()} | {7} == {d for d, *_ in TEXTS} - {3, 4, 5}  # 7 is mostly bytes unseen in training
    assert langid.identify(none).count() == 0


def test_code_lengths_are_a_distribution():
    g, n = np.unique(langid.grams(np.frombuffer(langid.PAD + (EN * 5).encode(), np.uint8)), return_counts=True)
    tree = langid.ContextTree(g, n.astype(float), 2)
    for context in (b"the", b"zzz", b"\xff\xffe"):
        base = int.from_bytes(context, "big") << 8
        assert np.exp2(-tree.bits(np.arange(base, base + 256, dtype=np.uint32))).sum() == pytest.approx(1)


def test_quality(spark, docs, none):
    rows = [(k, "good words stand in this line here" if k % 2 else "BAD!! BAD!! BAD!! BAD!!") for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows] + [(1, None)], "doc_id long, quality int")
    assert all(r.predicted == r.doc_id % 2 for r in quality.classify(table, labels).collect())
    assert {r.score for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_passages(docs, none):
    got = [r for r in substring_dedup.repeated_passages(docs).collect() if r.doc_id == 9]
    assert [(r.source_id, r.source_word) for r in got] == [(8, 2)] and got[0].n_words == 60 and got[0].jaccard == 1
    kept = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert "word5 " in kept[8] and "word5 " not in kept[9] and kept[9].endswith("omega") and kept[3] is None
    assert substring_dedup.repeated_passages(none).count() == 0


def test_compact_windows_partition_all_long_subsequences():
    h = np.random.default_rng(1).permutation(40)
    windows = list(substring_dedup.compact_windows(h, 5))
    for x in range(40):
        for y in range(x + 4, 40):
            assert sum(left <= x <= c <= y <= right and h[c] == h[x : y + 1].min() for left, c, _, right in windows) == 1
    assert list(substring_dedup.compact_windows(np.array([5, 1, 7, 7, 7, 1, 9]), 3)) == [(0, 1, 3, 6), (2, 2, 0, 4)]
    assert len(list(substring_dedup.compact_windows(np.zeros(80_000, np.int64), 42))) == 1


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 8))
    x = np.concatenate([base, base[:10] + rng.normal(size=(10, 8)) * 0.2, base[:5], base[:5] * 3]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    odd = [(100, None, 0), (101, [0.0] * 8, 0), (102, [1.0] * 7 + [None], 0), (103, [float("nan")] * 8, 0), (104, x[0].tolist(), None)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int"), tile=4).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    link = (u @ u.T >= 0.93) & (np.arange(50)[:, None] % 2 == np.arange(50) % 2) & ~np.eye(50, dtype=bool)
    root = np.arange(50)
    for _ in range(50):
        root = np.minimum(root, np.where(link, root, 99).min(axis=1))
    assert all(got[i].n_links == link[i].sum() and got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in range(50))
    assert all(got[i].n_links == 0 and got[i].kept for i, *_ in odd)


def test_pieces(docs, none):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.default_model())
    got = {r.doc_id: np.frombuffer(r.ids, "<i4").tolist() for r in sentencepiece_lattice.encode(docs).collect()}
    assert all(got[d] == m.encode(t or "") for d, t, _ in TEXTS)
    text = {r.doc_id: r.text for r in sentencepiece_lattice.decode(sentencepiece_lattice.encode(docs)).collect()}
    assert all(text[d] == (t or "").replace("▁", " ") for d, t, _ in TEXTS)
    some = docs.where("doc_id in (0, 2, 3, 4, 8)")
    pieces = {r.doc_id: r.pieces for r in sentencepiece_lattice.encode_relational(some).collect()}
    assert all(pieces[d] == [p for p in m.encode(t or "", out_type=str)] for d, t, _ in TEXTS if d in (0, 2, 3, 4))
    assert sentencepiece_lattice.encode(none).count() == 0


def test_viterbi():
    v = sentencepiece_lattice.vocabulary(sentencepiece_lattice.default_model())
    _, scores = v.lattice(sentencepiece_lattice.codes(["▁the"]))
    ends = sentencepiece_lattice.best_path(scores)
    best = max((sum(scores[0, a, b - a] for a, b in zip(c, c[1:])), c) for c in ([0, 4], [0, 1, 4], [0, 2, 4], [0, 3, 4], [0, 1, 2, 4], [0, 1, 2, 3, 4], [0, 1, 3, 4], [0, 2, 3, 4]))
    assert [0, *ends[0][ends[0] > 0]] == best[1]


def test_scores(docs, none):
    got = {r.doc_id: r for r in suffix_tree.score(docs, frequent=3).collect()}
    assert got[3].n_tokens == got[4].n_tokens == 1 and all(r.score < 0 and r.base_score < 0 for r in got.values())
    train = [suffix_tree.normalised(t).split() + [None] for d, t, _ in TEXTS if zlib.crc32(str(d).encode()) % 7 != 2 or d is None]
    count = {}
    for w in (w for x in train for w in x):
        count[w] = count.get(w, 0) + 1
    total = sum(count.values())
    for d, t, _ in TEXTS:
        words = suffix_tree.normalised(t).split() + [None]
        assert got[d].base_score == pytest.approx(sum(math.log10((count.get(w, 0) + 1) / (total + len(count) + 1)) for w in words))
        assert got[d].n_known == sum(w in count for w in words) and got[d].train_tokens == total
    assert suffix_tree.score(none).count() == 0


def test_lines(spark, none):
    a = "one two three four five six seven eight nine ten"
    rows = [(1, f"{a}\nother text here"), (2, f"{a} eleven\n\n{a}"), (3, "Other TEXT here\nunique line"), (4, None), (5, ""), (None, a)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.n_links, r.removed) for r in line_dedup.matched_lines(table).collect()}
    assert got == {(1, 0): (2, False), (1, 1): (1, False), (2, 0): (2, True), (2, 2): (2, True), (3, 0): (1, True), (3, 1): (0, False)}
    kept = {r.doc_id: r.text for r in line_dedup.remove_later(table).collect()}
    assert kept == {1: rows[0][1], 3: "unique line", 4: None, 5: "", None: a}
    assert line_dedup.matched_lines(none).count() == 0


def test_lines_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(30):
        base = rng.integers(0, 400, rng.integers(1, 160))
        for _ in range(rng.integers(1, 9)):
            changed = np.where(rng.random(len(base)) < rng.choice([0, 0.02, 0.08, 0.12, 0.2]), rng.integers(0, 900, len(base)), base)
            texts.append(" ".join(f"w{k}" for k in changed))
    rng.shuffle(texts)
    rows = [(k, "\n".join(texts[at : at + 3])) for k, at in enumerate(range(0, len(texts), 3))]
    sets = [((k, n), set(line.split())) for k, text in rows for n, line in enumerate(text.split("\n"))]
    want = {}
    for at, x in sets:
        near = [b for b, y in sets if b != at and len(x & y) >= 0.8 * len(x | y) - 1e-9]
        want[at] = (len(near), min([at, *near]))
    got = {(r.doc_id, r.line_no): (r.n_links, (r.first_doc, r.first_line)) for r in line_dedup.matched_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and sum(n for n, _ in want.values()) > 100


def test_neighbours_are_all_pairs_of_a_key():
    rng = np.random.default_rng(6)
    key, size = np.sort(rng.integers(0, 12, 80)), rng.integers(1, 30, 80)
    size = size[np.lexsort((size, key))]
    got = {(int(x), int(y)) for a, b in line_dedup.neighbours(key, size, 0.8) for x, y in zip(a, b, strict=True)}
    assert got == {(x, y) for x in range(80) for y in range(x + 1, 80) if key[x] == key[y] and size[x] >= 0.8 * size[y] - 1e-9}


def test_fingerprints(docs, none):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert got[1].component_id == 0 and got[4].component_id == 3 and got[3].fingerprint == "0" * 16 and got[None].component_id is None
    assert simhash.near_duplicates(none).count() == 0


def test_ball_finds_all_links(spark):
    rng = np.random.default_rng(2)
    f = {int(v): k for k, v in enumerate(rng.integers(-(2**63), 2**63, 20))}
    for v in list(f):
        for bits in ((1,), (3, 63), (4, 5), (6, 7, 8)):
            w = int((np.array([v]) ^ np.bitwise_or.reduce(np.int64(1) << np.array(bits)))[0])
            f[w] = len(f)
    edges = simhash.ball_edges(spark.createDataFrame([(a, b) for a, b in f.items()], "fp long, doc_id long"))
    from landseries.llm.common import connected_components

    comp = {r.node: r.component for r in connected_components(edges).collect()}
    root = {k: k for k in f.values()}
    for _ in range(9):
        for a, i in f.items():
            for b, j in f.items():
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    assert {k: comp.get(k, k) for k in root} == root


def test_media(docs, none):
    import hashlib

    got = {r.doc_id: r for r in webp.digest(docs).collect()}
    for d, t, _ in TEXTS:
        n, p = webp.padded(t)
        assert (got[d].n_bytes, got[d].payload_sha256) == (n, hashlib.sha256(p).hexdigest()) and len(p) % 576 == 0 and p
    assert got[0].media_sha256 == got[1].media_sha256 and webp.digest(none).count() == 0


def test_green_transform_and_lone_symbols():
    w = webp.header(4, 2)
    for value, n in ((1, 1), (2, 2), (0, 1), (0, 1), (0, 1)):
        w.put(value, n)
    for symbol in (10, 5, 7, 255, 0):
        for value, n in ((1, 1), (0, 1), (1, 1), (symbol, 8)):
            w.put(value, n)
    assert (webp.decode(webp.container(w.bytes())) == [15, 10, 17, 255]).all()


def test_palette_with_two_colours():
    w = webp.header(8, 1)
    w.put(1, 1), w.put(3, 2), w.put(1, 8)  # a palette of two
    w.put(0, 1)  # its image: no cache
    for symbols in ((20, 200), (3,), (4,), (255,), (0,)):
        w.put(1, 1), w.put(len(symbols) - 1, 1), w.put(1, 1), w.put(symbols[0], 8)
        if len(symbols) > 1:
            w.put(symbols[1], 8)
    w.put(0b10, 2)  # green 20, then 200 added
    w.put(0, 1), w.put(0, 1), w.put(0, 1)  # no more transforms, no cache, one group
    for symbol in (0b10110001, 0, 0, 255, 0):
        w.put(1, 1), w.put(0, 1), w.put(1, 1), w.put(symbol, 8)
    green = webp.decode(webp.container(w.bytes()))[0, :, 1].tolist()
    assert green == [220 if 0b10110001 >> k & 1 else 20 for k in range(8)]


def planted_passages(spark, rows):
    return substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()


@pytest.mark.parametrize("copies", [1, 12])
def test_passages_among_partial_copies(spark, copies):
    """Whole passages between texts that hold only their start; in crowds too."""
    rng = np.random.default_rng(5)
    own = lambda n: [f"w{k}" for k in rng.integers(1 << 40, size=n)]
    rows, pairs = [], []
    for p in range(40 if copies == 1 else 4):
        passage = own(60)
        for k in range(4 * copies):
            whole = k % 2 == 1
            rows.append((1000 * p + k, " ".join(own(5) + (passage if whole else passage[:40]) + own(60))))
            if whole and k > 1:
                pairs.append(1000 * p + k)
    got = {r.doc_id: r for r in planted_passages(spark, rows)}
    assert sorted(got) == pairs and all((r.first_word, r.n_words, r.source_word, r.jaccard) == (5, 60, 5, 1.0) for r in got.values())


def test_passages_with_words_put_in_and_left_out(spark):
    rng = np.random.default_rng(6)
    own = lambda n: [f"w{k}" for k in rng.integers(1 << 40, size=n)]
    rows, wanted = [], {}
    for p in range(60):
        n = int(rng.integers(56, 100))
        x = own(n)
        at = int(rng.integers(20, n - 20))
        y = x[:at] + (own(1) if p % 3 == 0 else []) + x[at + (p % 3 > 0) :] if p % 3 < 2 else x[:at] + own(1) + x[at + 1 :]
        rows += [(2 * p, " ".join(own(30) + x + own(30))), (2 * p + 1, " ".join(own(40) + y + own(20)))]
        sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (x, y)]
        wanted[2 * p + 1] = (2 * p, 40, len(y), 30, pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1])))
    got = {r.doc_id: (r.source_id, r.first_word, r.n_words, r.source_word, r.jaccard) for r in planted_passages(spark, rows)}
    assert got == wanted


def test_recall_at_the_threshold(spark):
    """One of 51 words replaced: 42 of 52 shingles are common; every planted pair is found."""
    rng = np.random.default_rng(7)
    own = lambda n: [f"w{k}" for k in rng.integers(1 << 40, size=n)]
    rows = []
    for p in range(500):
        x = own(51)
        y = x[:25] + own(1) + x[26:]
        rows += [(2 * p, " ".join(own(30) + x + own(30))), (2 * p + 1, " ".join(own(40) + y + own(20)))]
    assert sorted(r.doc_id for r in planted_passages(spark, rows)) == list(range(1, 1000, 2))
