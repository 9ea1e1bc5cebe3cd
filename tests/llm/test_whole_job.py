"""Cases in which an operator once did less than its whole job."""
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from refinery.llm import toxicity
from refinery.llm.common import hash_words, ngram_hashes, text_slices
from refinery.llm.decontaminate import Index, _proposed, scan_texts
from refinery.llm.quality import quality_rules


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_every_language_with_enough_labels_has_its_own_threshold(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    seen = Counter((lang[r["doc_id"]], r["toxic"]) for r in labels.collect()
                   if r["toxic"] is not None and not _held_out(r["doc_id"]))
    enough = {x for x in set(lang.values()) if min(seen[x, 0], seen[x, 1]) >= toxicity.LEAST_PER_CLASS}
    got = toxicity.fit_toxicity(docs, labels).thresholds
    assert set(got) == enough >= {"en", "fr", "de"}


def test_thresholds_count_rows_beyond_the_sample(spark):
    # texts of 20,000 bytes and more, none of which can be in the training sample
    rows = [(i, f"{'vile' if i % 3 == 0 else 'kind'} " + "word " * 4200, "es") for i in range(400)]
    rows += [(i, f"{'vile' if i % 3 == 0 else 'kind'} word other", "en") for i in range(400, 800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert set(model.thresholds) == {"en", "es"}
    got = {r["doc_id"]: r["flagged"] for r in toxicity.toxicity(docs, labels).collect()}
    assert got == {i: i % 3 == 0 for i, _, _ in rows}


def test_cuts_have_the_best_f1_of_all_rows(spark):
    rows = [(i, "en" if i % 2 else "fr", ((i * 7919) % 1000) / 250 - 2) for i in range(3000)]
    toxic = {i: int(x + ((i * 31) % 100) / 50 - 1 > (1 if lang == "en" else 0)) for i, lang, x in rows}
    scored = spark.createDataFrame(rows, "doc_id long, lang string, odds double")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    own = pa.table({"_id": pa.array([], pa.int64()), "_own": pa.array([], pa.float64())})
    model = toxicity.calibrate(scored, labels, toxicity.Model(None, None, None, 0.0, {}), own)

    def f1(rows, cut):
        flagged = [toxic[i] for i, x in rows if 1 / (1 + 2.718281828459045 ** -(x + model.out_bias)) >= cut]
        return 2 * sum(flagged) / (len(flagged) + sum(toxic[i] for i, _ in rows))
    for lang, cut in [*model.thresholds.items(), (None, toxicity.PREDICT_AT)]:
        of = [(i, x) for i, s, x in rows if not _held_out(i) and lang in (None, s)]
        best = max(f1(of, 1 / (1 + 2.718281828459045 ** -(k / 100 + model.out_bias))) for k in range(-200, 200))
        assert f1(of, cut) >= best - 0.01
    assert set(model.thresholds) == {"en", "fr"}


def test_near_copies_of_items_that_many_share():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    common, *others = [rng.choice(vocabulary, 54).tolist() for _ in range(601)]
    index = Index(list(range(900)), pa.array([" ".join(x) for x in [common] * 300 + others[:600]]))
    for at in range(4, 46):
        for words, want in ((list(common), set(range(300))), (list(others[at]), {300 + at})):
            words[at] = words[at + 4] = "changed"       # at most nine of 50 shingles go: 0.82 stays
            text = " ".join([*rng.choice(vocabulary, 80), *words, *rng.choice(vocabulary, 70)])
            got = {h[0]: h for _, hs in scan_texts(pa.array([text]), index) for h in hs}
            assert set(got) == want and all(71 <= h[1] <= 80 and 0.8 <= h[4] < 0.93 for h in got.values())


def test_best_windows_equal_brute_force():
    rng = np.random.default_rng(11)
    items = [" ".join(rng.choice(list("abc"), n)) for n in (9, 12, 15, 15, 3)]
    index = Index(list(range(len(items))), pa.array(items))
    for _ in range(40):
        words = rng.choice(list("abcd"), int(rng.integers(1, 90)), p=[0.32, 0.32, 0.32, 0.04]).tolist()
        got = {h[0]: (h[1], round(h[4], 6)) for _, hs in scan_texts(pa.array([" ".join(words)]), index, 0.5) for h in hs}
        want = {}
        for n, item in enumerate(x.split() for x in items):
            k = min(5, len(item))
            held = {g: sum(g in {tuple(o[i:i + k]) for i in range(len(o) - k + 1)} for o in map(str.split, items)
                           if min(5, len(o)) == k) for g in (tuple(item[i:i + k]) for i in range(len(item) - k + 1))}
            weight = {g: np.log1p(len(items) / c) for g, c in held.items()}
            grams = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
            m = min(len(item) - k + 1, len(grams))
            sims = [sum(weight[x] for x in weight.keys() & set(grams[a:a + m])) / sum(weight.values())
                    for a in range(len(grams) - m + 1)] if grams else [0]
            best = max(sims)
            if best >= 0.5 - 1e-6:
                want[n] = (next(a for a, x in enumerate(sims) if x >= best - 1e-9), round(best, 6))
        assert {n: w[0] for n, w in got.items()} == {n: w[0] for n, w in want.items()}
        assert all(abs(got[n][1] - want[n][1]) < 1e-5 for n in want)


def test_verbatim_copies_of_repetitive_items_have_distance_zero():
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = []
    for single, refrain, times in ((50, 5, 20), (40, 5, 12), (20, 5, 10)):
        for _ in range(10):
            items.append(" ".join([*rng.choice(vocabulary, single), *(rng.choice(vocabulary, refrain).tolist() * times)]))
    index = Index(list(range(len(items))), pa.array(items))
    for n, item in enumerate(items):
        text = " ".join([*rng.choice(vocabulary, 80), item, *rng.choice(vocabulary, 70)])
        (_, hits), = scan_texts(pa.array([text]), index)
        assert [h[0] for h in hits] == [n] and hits[0][4] > 0.999
        # the copy itself, not only the window of its distinct shingles, is proposed
        g = ngram_hashes(hash_words(*next(text_slices(pa.array([item])))[1:])[0], 5)
        place = index.places(g)
        assert n in _proposed(g, place, np.flatnonzero(place >= 0), index, len(item.split()), len(g))
        (_, hits), = scan_texts(pa.array([item]), index)
        assert [(h[0], h[3]) for h in hits] == [(n, 0)]


def test_repetition_or_symbols_alone_reject_in_a_clean_group(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in ("a", "en", "ilo", "or") for c in "mnprstvz"]

    def clean(n):
        while True:
            words = rng.choice(vocabulary, n).tolist()
            if len({tuple(words[i:i + 3]) for i in range(n - 2)}) == n - 2:
                return words
    rows = [(i, " ".join(clean(int(rng.integers(80, 300))))) for i in range(400)]
    for i in range(4):      # 45 % of the words in windows that occur twice, and 5 symbols in 100 words
        words = clean(155)
        rows += [(1000 + i, " ".join(words + words[:45])), (2000 + i, " ".join(clean(200)) + " " + "# " * 10)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert 0.4 < got[1000]["n_repeat_words"] / got[1000]["n_words"] < 0.5
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == {i for i in got if i >= 1000}
