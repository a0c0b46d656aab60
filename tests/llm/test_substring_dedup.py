"""FM-index and substring dedup against brute force, with their edge cases."""

import random

import numpy as np
import pytest

from civicmart.llm import substring_dedup
from civicmart.llm.fm_index import FMIndex, WaveletTree


def test_wavelet_tree_counts_like_a_scan():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 60):
        seq = np.unique(np.minimum(rng.zipf(1.4, 900), size), return_inverse=True)[1]
        tree = WaveletTree(seq, int(seq.max()) + 1)
        at = rng.integers(0, len(seq) + 1, (2, 200))
        symbols = rng.integers(0, int(seq.max()) + 1, 200)
        want = [[int((seq[:i] == c).sum()) for i, c in zip(row, symbols, strict=True)] for row in at]
        assert tree.rank(symbols, at.copy()).tolist() == want


@pytest.mark.parametrize("seed", range(20))
def test_matching_statistics_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    text = np.unique(np.append(rng.integers(0, rng.integers(2, 6), rng.integers(3, 70)), 0),
                     return_inverse=True)[1]
    cap = int(rng.integers(1, 9))
    index = FMIndex(text, cap)
    queries = rng.integers(-1, text.max() + 3, 90)  # with symbols the text doesn't hold
    cuts = np.sort(rng.choice(91, 5, replace=False))
    length, row = index.matching_statistics(queries, cuts[:-1], cuts[1:])
    t = text.tolist()
    held = {tuple(t[i:i + d]) for d in range(1, cap + 1) for i in range(len(t) - d + 1) if 0 not in t[i:i + d]}
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for i in range(a, b):
            best = max(d for d in range(min(cap, b - i) + 1) if not d or tuple(queries[i:i + d].tolist()) in held)
            assert length[i] == best
            at = index.order[row[i]]
            assert not best or t[at:at + best] == queries[i:i + best].tolist()


def brute(rows, window=13):
    """(doc_id, n_words, n_removed, kept) of each row; null doc_ids are one, after all others."""
    order = {d: (d is None, d or 0) for d, _ in rows}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, order[d]), order[d])
    out = []
    for d, w in split:
        stay = [True] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order[d]:
                stay[k:k + window] = [False] * window
        kept = [x for x, s in zip(w, stay, strict=True) if s]
        out.append((d, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def passages(seed):
    """Documents that share passages, copies, near copies and one passage that a third of them holds."""
    rng = random.Random(seed)
    common = words(rng, 40)
    texts = []
    for _ in range(150):
        w = words(rng, rng.randrange(0, 120))
        if texts and rng.random() < 0.4:
            other = rng.choice(texts)
            at = rng.randrange(max(1, len(other)))
            w[len(w) // 2:len(w) // 2] = other[at:at + rng.randrange(5, 40)]
        if rng.random() < 0.35:
            at = rng.randrange(len(w) + 1)
            w[at:at] = common
        if texts and rng.random() < 0.1:
            w = list(rng.choice(texts))
            if w and rng.random() < 0.5:
                w[rng.randrange(len(w))] = "changed"
        texts.append(w)
    spaces = [" ", "\n", " \t", "\u000b", "  "]
    rows = [(d, "".join(x + rng.choice(spaces) for x in w)) for d, w in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "shard_words", "hot_share"), [(1, 400_000, 1e-4), (2, 500, 1.0), (3, 300, 1e-3)])
def test_equals_brute_force_for_any_shards(frame, seed, shard_words, hot_share):
    rows = passages(seed)
    out = substring_dedup.substring_dedup(frame(rows), shard_words=shard_words, hot_share=hot_share)
    assert got(out) == brute(rows)


def test_frequent_keys_are_cut_by_window(frame, monkeypatch):
    """A passage that most documents hold, in contexts of their own, with the limit far below."""
    rng = random.Random(5)
    common = words(rng, 30)
    rows = [(d, " ".join(words(rng, 15) + common + words(rng, 15))) for d in range(700)]
    hot = substring_dedup.frequent_keys(substring_dedup._texts(frame(rows)), 13, 5, 1e-4)
    assert len(hot[0]) >= 1 and len(hot[1]) == 18 and hot[2] == 700 * 48  # the windows of the passage
    assert got(substring_dedup.substring_dedup(frame(rows))) == brute(rows)


def test_edges(frame):
    p = " ".join(f"p{k}" for k in range(13))
    long = " ".join(f"x{k % 977}" for k in range(40_000))
    rows = [(3, p), (1, p + " tail"), (2, "head " + p), (None, p + " null"), (None, p + " null"),
            (7, None), (8, ""), (9, " \n\t"), (4, p.rsplit(" ", 1)[0]), (5, long), (6, long + " end"),
            (-9, "a " * 40), (10, "a " * 30), (11, p), (11, p), (12, p + " x"), (13, "é " + p),
            (14, "q " + " ".join(f"p{k}" for k in range(13)).upper())]
    assert got(substring_dedup.substring_dedup(frame(rows))) == brute(rows)


def test_windows_of_one_document_stay(frame):
    text = " ".join(["same words again and again"] * 20)
    assert got(substring_dedup.substring_dedup(frame([(1, text), (1, text)]))) == brute([(1, text), (1, text)])


def test_no_rows_and_other_windows(frame):
    assert substring_dedup.substring_dedup(frame([])).collect() == []
    rows = [(1, "a b c d"), (2, "x a b c"), (3, "b c d")]
    assert got(substring_dedup.substring_dedup(frame(rows), window=3)) == brute(rows, 3)
