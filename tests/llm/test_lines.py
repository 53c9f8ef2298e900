"""Packed prefix rows of line dedup and their parity filter."""

import numpy as np
import pytest

from landseries.llm import line_dedup as ld


def test_rows_come_back_from_their_packed_form():
    rng = np.random.default_rng(3)
    n = 5000
    size = rng.integers(1, 500, n)
    key, sig = rng.integers(0, 1 << 48, n), rng.integers(-(2**63), 2**63 - 1, n)
    maps = rng.integers(0, 2**63, (n, 4)).astype(np.uint64) * (np.arange(4) < ld.lanes_of(size)[:, None]).astype(np.uint64)
    place = size << 32 | rng.integers(0, 90, n)
    batches = list(ld.dealt_rows(((key[i : i + 700], sig[i : i + 700], place[i : i + 700], maps[i : i + 700]) for i in range(0, n, 700)), 7, rows=2000))
    rows = [r for b in batches for r in b.to_pylist()]
    assert len(batches) == 3 and len(rows) == 21 and {r["bucket"] for r in rows} == set(range(7))
    back = [np.concatenate(x) for x in zip(*(ld.undealt(r["n"], r["packed"]) for r in rows), strict=True)]
    a, b = np.lexsort((sig, key)), np.lexsort((back[1], back[0]))
    assert all((x[a] == y[b]).all() for x, y in zip((key, sig, place, maps), back, strict=True))


def test_long_lines_apart_are_told_apart_by_parities(spark):
    """Of lines of 60, 150 and 300 words, two pairs are alike and 40 others share one rare word only."""
    rng = np.random.default_rng(5)
    rows = []
    for size in (60, 150, 300):
        words = [f"{size}w{k}" for k in range(size)]
        rows += [[*words], [*words[: -size // 20], *(f"{size}x{k}" for k in range(size // 20))]]
        rows += [[f"{size}rare", *(f"{size}y{j}n{k}" for k in rng.choice(10**6, size - 1, replace=False))] for j in range(40)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], "doc_id long, text string")
    classes = ld.classes_of(docs)
    counts = spark.sparkContext.broadcast(ld.word_counts(classes))
    index = ld.prefix_rows(classes, counts, 0.8, common=False)
    found = {r.sig for r in ld.members(index, 0.8).collect()}
    twins = {r.sig for r in ld.lines_of(docs).where("doc_id % 42 < 2").collect()}
    assert twins <= found
    sizes = np.repeat([150, 300], 100)
    words = rng.integers(0, 2**32, sizes.sum(), dtype=np.uint32)
    maps = ld.parities(words, np.cumsum(sizes) - sizes, sizes)
    apart = np.bitwise_count(maps[:-1] ^ maps[1:]).sum(axis=1, dtype=np.int64)
    both = sizes[:-1] + sizes[1:]
    assert (((both - apart) / 2 < 0.8 / 1.8 * both)[sizes[:-1] == sizes[1:]]).mean() > 0.9  # 64 bins pass all of them
    linked = {(r.doc_id, r.first_doc) for r in ld.matched_lines(docs).where("removed").collect()}
    assert linked == {(k + 1, k) for k in (0, 42, 84)}


def test_blocks_leave_out_no_close_pair():
    """Sets of one key whose parities and sizes are close enough are found by blocks as by single steps."""
    rng = np.random.default_rng(7)
    sizes = np.sort(np.concatenate([rng.integers(5, 300, 700), np.full(300, 90)]))
    base = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in sizes]
    for k in range(0, len(base) - 1, 5):  # each fifth is close to the one before
        n = min(len(base[k]), len(base[k + 1]))
        base[k + 1][: n - n // 12] = base[k][: n - n // 12]
    maps = ld.parities(np.concatenate(base), np.cumsum(sizes) - sizes, sizes)
    key, sig, place = np.zeros(len(sizes), np.int64), rng.integers(0, 2**62, len(sizes)), sizes << 32
    got = {}
    for few in (10, 10**6):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ld, "FEW", few)
            got[few] = ld.compared(key, sig, place, maps, 0.8).to_pydict()
    assert got[10] == got[10**6] and len(got[10]["sig"]) > 200


def test_words_of_many_lines_are_not_copied_to_tiles_without_partners(spark, monkeypatch):
    """Lines that share their rarest word only, more than COMMON and CROWD of them, leave no row for the tiles."""
    monkeypatch.setattr(ld, "COMMON", 20)
    tiled = []
    tiles = ld.links_in_tiles
    monkeypatch.setattr(ld, "links_in_tiles", lambda classes, crowded, *a: tiled.append(crowded.count()) or tiles(classes, crowded, *a))
    apart = [" ".join(["rare", *(f"y{j}n{k}" for k in range(12))]) for j in range(150)] * 2  # each line twice, so no word is alone in its line
    words = [" ".join(["rare", *(f"y{j}n{(k + 1) % 13}" for k in range(11)), f"z{j}"]) for j in range(150)]
    rows = [(k, t) for k, t in enumerate(apart + words)]
    sets = {k: set(t.split()) for k, t in rows}
    want = {k: sum(len(x & y) >= 0.8 * len(x | y) - 1e-9 for o, y in sets.items() if o != k) for k, x in sets.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (1 << 15, 40):
        monkeypatch.setattr(ld, "CROWD", crowd)
        assert {r.doc_id: r.n_links for r in ld.matched_lines(docs).collect()} == want
    assert tiled == [0, 0] and sum(want.values()) >= 300
