"""Arrays that the Python workers hold are small, and their size changes no result."""
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("xxhash")

from refinery.llm import common
from refinery.llm.common import hash_words, shingle_sets, text_slices
from refinery.llm.ngram_join import _only, capped_sum, shingle_sketch


def _texts(n, words=1000):
    rng = np.random.default_rng(5)
    return pa.array([" ".join(f"w{x}" for x in rng.integers(0, 500, words)) for _ in range(n)] + [None, "", "é a"])


def test_a_batch_of_documents_is_hashed_in_little_memory(monkeypatch):
    monkeypatch.setattr(common, "_powers", {})
    col = _texts(500)           # 2.4 MB, some eight arrays of 8 bytes a byte if hashed at once
    tracemalloc.start()
    try:
        for _, data, off in text_slices(col):
            hash_words(data, off)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20, peak


def test_shingles_do_not_depend_on_the_slices():
    col = _texts(40, 300)
    whole = [hash_words(d, o)[0].tolist() for _, d, o in text_slices(col, 1 << 30)]
    cut = [hash_words(d, o)[0].tolist() for _, d, o in text_slices(col, 1000)]
    assert sum(whole, []) == sum(cut, [])


def test_the_sketch_counts_in_four_bytes_and_stops_at_the_top(spark):
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(7)], "doc_id long, text string").repartition(3)
    found = shingle_sketch(docs, 5, 12)
    assert found.dtype == np.uint32 and sorted(found[found > 0].tolist()) == [7, 7]
    assert (found > 0).nonzero()[0].tolist() == sorted(
        {int(s >> np.uint64(52)) for s in shingle_sets(pa.array(["a b c d e f"]), 5)[0]})
    top = np.array([0xFFFFFFFF, 0xFFFFFFFE, 3], np.uint32)
    assert capped_sum(top, np.array([1, 1, 2])).tolist() == [0xFFFFFFFF, 0xFFFFFFFF, 5]


def test_the_packed_id_filter_keeps_the_named_documents(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in range(-500, 500)] + [(None, "x")], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(-400, 400, 7)], "id long").repartition(3)
    kept = {r[0] for r in _only(docs, ids).collect()}
    named = {r[0] for r in ids.collect()}
    assert named <= kept and len(kept) < len(named) + 20
