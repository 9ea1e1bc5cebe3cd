"""Fingerprints choose the candidates of decontamination: recall, bounds, blocks, memory."""
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from refinery.llm import decontaminate
from refinery.llm.common import hash_words, ngram_hashes, text_slices
from refinery.llm.decontaminate import Index, contaminated, drop_contaminated, scan_texts, simhash, signs, window_prints

VOCABULARY = [f"w{i}" for i in range(5000)]


def _edited(rng, words, share):
    """Words replaced until the next replacement would leave fewer than ``share`` of the 5-word shingles."""
    own = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    out = list(words)
    for at in rng.permutation(len(words)).tolist():
        new = out[:at] + [f"x{rng.integers(1e9)}"] + out[at + 1:]
        if len(own & {tuple(new[i:i + 5]) for i in range(len(new) - 4)}) >= share * len(own):
            out = new
    return out


def _benchmark(rng):
    """(kind, words) of plain, templated, repeated and repetitive items."""
    template = rng.choice(VOCABULARY, 24).tolist()
    copied = rng.choice(VOCABULARY, 50).tolist()
    for n in range(150):
        yield "plain", rng.choice(VOCABULARY, int(rng.integers(20, 90))).tolist()
        yield "templated", template + rng.choice(VOCABULARY, 30).tolist()
        if n % 3 == 0:
            yield "repeated", copied
            yield "repetitive", rng.choice(VOCABULARY, 40).tolist() + rng.choice(VOCABULARY, 4).tolist() * 8


def test_recall_against_brute_force(monkeypatch):
    rng = np.random.default_rng(21)
    kinds, items = zip(*_benchmark(rng))
    index = Index(list(range(len(items))), pa.array([" ".join(x) for x in items]))
    texts = [" ".join([*rng.choice(VOCABULARY, 60), *_edited(rng, x, 0.8), *rng.choice(VOCABULARY, 60)]) for x in items]
    got = {(i, h[0]) for i, hs in scan_texts(pa.array(texts), index) for h in hs}
    # brute force: every item that shares a shingle is verified
    monkeypatch.setattr(decontaminate, "_proposed", lambda g, place, hits, index, size, m, least=0.8: set(
        index.sizes[size].items.tolist()))
    want = {(i, h[0]) for i, hs in scan_texts(pa.array(texts), index) for h in hs}
    assert got <= want
    for kind in set(kinds):
        of = {p for p in want if kinds[p[0]] == kind}
        assert len(of) >= 50 and len(of & got) >= 0.99 * len(of), kind
    # without fingerprints most plain copies are lost: they decide
    monkeypatch.setattr(decontaminate, "_proposed", lambda *a, **k: set())
    none = {(i, h[0]) for i, hs in scan_texts(pa.array(texts), index) for h in hs}
    assert not {p for p in none if kinds[p[0]] == "plain"}
    assert {kinds[n] for g in index.loose(0.8).values() for n in g} <= {"templated", "repetitive"}


def test_window_fingerprints_equal_those_of_their_sets():
    rng = np.random.default_rng(2)
    g = rng.integers(0, 1 << 64, 40, np.uint64)[rng.integers(0, 40, 300)]
    for m in (1, 7, 60):
        got = window_prints(g, 20, 200, m)
        assert got.tolist() == [int(simhash(signs(np.unique(g[a:a + m])).sum(0))) for a in range(20, 200)]


def test_the_multi_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(8)
    items = [" ".join(rng.choice(VOCABULARY, 30)) for _ in range(300)]
    index = Index(list(range(300)), pa.array(items))
    text = " ".join(rng.choice(VOCABULARY, 25).tolist() + items[5].split()[:29] + items[9].split()[2:])
    g = ngram_hashes(hash_words(*next(text_slices(pa.array([text])))[1:])[0], 5)
    place = index.places(g)
    got = decontaminate._proposed(g, place, np.flatnonzero(place >= 0), index, 30, 26, 0.01)
    prints = window_prints(g, 0, len(g) - 25, 26)
    held = np.array([(place[a:a + 26] >= 0).any() for a in range(len(prints))])
    want = {n for n in range(300) if min(int(x ^ np.uint64(index.prints[n])).bit_count() for x in prints[held]) <= 23}
    assert {5, 9} <= want and got >= want
    assert all(min(int(x ^ np.uint64(index.prints[n])).bit_count() for x in prints) <= 23 for n in got)


@pytest.mark.parametrize("block_bytes", [1 << 20, 6000, 700])
def test_results_do_not_depend_on_blocks(spark, block_bytes):
    rng = np.random.default_rng(4)
    items = [x for _, x in _benchmark(rng)][:60]
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(98, None), (99, " ")],
                                      "item_id long, text string").coalesce(2)
    docs = spark.createDataFrame(
        [(i, " ".join([*rng.choice(VOCABULARY, 20), *_edited(rng, x, 0.8)])) for i, x in enumerate(items)]
        + [(1000 + i, " ".join(rng.choice(VOCABULARY, 70))) for i in range(40)] + [(None, None), (7, "")],
        "doc_id long, text string").coalesce(2)
    index = Index(list(range(len(items))), pa.array([" ".join(x) for x in items]))
    rows = docs.collect()
    want = sorted((rows[i]["doc_id"], h[0], *h[1:4], round(h[4], 5))
                  for i, hs in scan_texts(pa.array([r["text"] for r in rows]), index) for h in hs)
    got = sorted((*r[:5], round(r[5], 5)) for r in contaminated(docs, benchmark, block_bytes=block_bytes).collect())
    assert got == want and len(want) >= 60
    held = {d for d, *_ in want}
    kept = drop_contaminated(docs, benchmark, block_bytes=block_bytes).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in rows if r["doc_id"] not in held or not r["text"])


def test_a_very_long_text_of_hits_takes_bounded_memory():
    rng = np.random.default_rng(6)
    items = [" ".join(rng.choice(VOCABULARY, 40)) for _ in range(200)]
    index = Index(list(range(200)), pa.array(items))
    text = " ".join(items[i] for i in rng.integers(0, 200, 2000))      # about 80,000 words, all in items
    tracemalloc.start()
    (_, hits), = scan_texts(pa.array([text]), index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {h[0] for h in hits} == set(range(200)) and all(h[4] > 0.999 for h in hits)
    assert peak < 150 << 20
