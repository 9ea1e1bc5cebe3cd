"""Every operator and stage on nulls, empty and very long texts, repeated rows, ties,
empty tables and extra columns with clashing names."""
import pytest

import corpus_pipeline
from refinery.llm.decontaminate import contaminated
from refinery.llm.hilbert_shards import hilbert_shards, shard_documents
from refinery.llm.html_text import main_text
from refinery.llm.licenses import scan_licenses
from refinery.llm.mixing import soft_mixing
from refinery.llm.ngram_join import keep_one, ngram_components
from refinery.llm.quality import keep_good, quality_rules
from refinery.llm.secrets import find_secrets
from refinery.llm.toxicity import drop_toxic, toxicity
from refinery.llm.warc import warc_roundtrip

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, row string, _size long, score double, "
        "token string, shard int, n long, id long, a string, root string, first int, component_id long")
EXTRA = ("x", 1, 0.5, "t", 9, 2, 3, "a", "r", 4, 5)
LONG = "word other third fourth " * 20_000
SAME = "one two three four five six seven eight nine ten"


def _docs(spark, rows):
    return spark.createDataFrame([r + EXTRA for r in rows], DOCS).repartition(3)


ROWS = [
    (1, SAME, "en", "s", 10), (1, SAME, "en", "s", 10), (2, SAME.upper(), "de", None, None),
    (3, None, "en", "s", 1), (4, "", None, "s", 0), (5, " \n\t ", "fr", "s", 3), (None, SAME, "en", "s", 10),
    (6, LONG, "en", "s", len(LONG)), (7, "short", "en", "t", 5), (8, "short", "en", "t", 5),
    (1, "another text under the same id with enough words to differ", "en", "s", 10),
]
LABELS = "doc_id long, quality int, toxic int, text string"
ITEMS = "item_id long, text string, doc_id long"
PAGES = "page_id long, url string, html string, text string, digest string"


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark, ROWS).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 1, "x"), (7, None, 1, None), (9, 1, None, None), (None, 1, 1, "")],
                                 LABELS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, SAME, 5), (2, None, 5), (3, "", 5), (None, "short", 1), (1, SAME, 5)], ITEMS)


def _empty(spark, ddl):
    return spark.createDataFrame([], ddl)


PER_ROW = {
    "licenses": lambda d, lab, it: scan_licenses(d),
    "sharding": lambda d, lab, it: hilbert_shards(d),
    "toxicity": lambda d, lab, it: toxicity(d, lab),
    "quality": lambda d, lab, it: quality_rules(d),
    "ngram": lambda d, lab, it: ngram_components(d),
    "mixing": lambda d, lab, it: soft_mixing(d, lab),
    "secrets": lambda d, lab, it: find_secrets(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_input_row(spark, docs, labels, items, name):
    got = PER_ROW[name](docs, labels, items).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_documents(spark, labels, items, name):
    assert PER_ROW[name](_empty(spark, DOCS), labels, items).count() == 0


def test_empty_side_tables(spark, docs):
    none = _empty(spark, LABELS)
    assert {r["score"] for r in toxicity(docs, none).collect()} == {0.0}
    assert all(abs(r["rate"] - 1) < 1e-5 for r in soft_mixing(docs, none).collect())
    assert contaminated(docs, _empty(spark, ITEMS)).count() == 0
    assert contaminated(_empty(spark, DOCS), _empty(spark, ITEMS)).count() == 0


def test_repeated_items_and_rows_are_reported(spark, docs, items):
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 1), (7, None), (8, None)}


def test_ngram_defined_results(spark, docs):
    got = {}
    for r in ngram_components(docs).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    # equal sets link, whatever the case; words are lower-cased A to Z
    assert {c for _, c in got[1] | got[2]} == {1}
    assert got[3] == got[4] == got[5] == {(0, 3)} or got[3] == {(0, 3)} and got[4] == {(0, 4)} and got[5] == {(0, 5)}
    assert got[7] == {(1, 7)} and got[8] == {(1, 7)}
    assert {c for _, c in got[None]} == {None}
    # both texts of id 1 stay: they do not link
    assert sorted(str(r["doc_id"]) for r in keep_one(docs).collect()) == ["1", "1", "3", "4", "5", "6", "7", "None"]


def test_stages_keep_columns_and_survive_empty_tables(spark, docs, labels, items, tmp_root):
    folders = {}
    for kind, parts in (("full", (labels, items)), ("empty", (_empty(spark, LABELS), _empty(spark, ITEMS)))):
        folders[kind] = f"{tmp_root}/{kind}"
        parts[0].write.parquet(f"{folders[kind]}/labels.parquet")
        parts[1].write.parquet(f"{folders[kind]}/benchmark.parquet")
    for d, folder in ((docs, "full"), (docs, "empty"), (_empty(spark, DOCS), "full")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, folders[folder])
            assert out.columns == d.columns, name
            out.count()
        out = shard_documents(d)
        assert out.columns == [c for c in d.columns if c not in ("shard", "slot")] + ["shard", "slot"]
        assert out.count() == d.count()


def test_pages(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(1, "http://a/\r\nX", big), (2, None, big), (0, "http://b", big), (3, "u", None), (4, "u", ""),
            (None, "u", big), (7, "v", "y" * 99), (8, "v", "y" * 99), (9, "v", "y" * 100), (10, "v", "y" * 100),
            (10, "v", "y" * 100), (11, "w", "<p>" + LONG)]
    pages = spark.createDataFrame([r + ("t", "d") for r in rows], PAGES)
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc_roundtrip(pages).collect()}
    assert {(0, "response", None), (1, "revisit", 0), (2, "revisit", 0), (None, "revisit", 0), (7, "response", None),
            (8, "response", None), (9, "response", None), (10, "revisit", 9)} <= got
    text = main_text(pages).collect()
    assert len(text) == len(rows) and {r["text"] for r in text if r["page_id"] in (3, 4)} == {""}
    for f in (warc_roundtrip, main_text):
        assert f(_empty(spark, PAGES)).count() == 0


def test_filters_keep_columns(spark, docs, labels):
    for out in (keep_good(docs), drop_toxic(docs, labels)):
        assert out.columns == docs.columns
