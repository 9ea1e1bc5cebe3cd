"""Cases in which results were lost: alike outliers, several records of a capture, large or
short pages, long expressions, texts that share an id."""
import random
import time

import pytest

from refinery.llm import html_text, licenses, warc
from refinery.llm.ngram_join import keep_one
from refinery.llm.quality import quality_rules


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(n))


@pytest.mark.parametrize("share", [0.03, 0.10, 0.25])
def test_outliers_that_are_alike_are_rejected_at_any_share(spark, share):
    """Texts with 45 % of their words in repeated windows among 400 clean ones."""
    rng = random.Random(7)
    bad = round(400 * share / (1 - share))
    rows = [(i, _prose(rng, rng.randrange(80, 200))) for i in range(400)]
    for i in range(bad):
        line = _prose(rng, 15)
        rows.append((1000 + i, " ".join([line, _prose(rng, 40), line, _prose(rng, 33), line])))
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules(docs).collect()}
    assert not any(got[1000 + i] for i in range(bad))
    assert sum(got[i] for i in range(400)) >= 398


def test_all_records_of_a_capture_are_kept(spark, tmp_root):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_root}/w")
    records = warc.read_warc(spark, f"{tmp_root}/w")
    from pyspark.sql import functions as F
    more = records.where("type = 'metadata'").withColumn("record_id", F.lit("<urn:other>"))
    row = warc.assemble(records.unionByName(more).unionByName(more)).first()
    assert len(row["metadata"]) == 2 and len(row["requests"]) == 1


@pytest.mark.parametrize("page", [
    "<html><body><nav>Home About</nav><article>" + "<p>A paragraph of the article that is long enough.</p>" * 1500
    + "</article></body></html>",
    "<p>Hello</p>",
    "<div>" * 3000 + "<p>Deep down there is a text of some length here.</p>" + "</div>" * 3000])
def test_tables_of_one_kind_of_page_have_text(spark, page):
    pages = spark.createDataFrame([(i, "u", page) for i in range(5)], "page_id long, url string, html string")
    assert all(r["n_chars"] > 0 for r in html_text.main_text(pages).collect())


def test_formulas_of_an_article_are_text():
    page = html_text.parse("<article><p>The value <math><mi>x</mi></math> holds here.</p></article>")
    assert "x" in " ".join(t for _, t in page.runs)


@pytest.mark.parametrize("line", ["(" * 100_000, "mit and " * 40_000, "mit or (" * 40_000, "mit (" * 40_000])
def test_long_expressions_take_linear_time(line):
    t = time.perf_counter()
    licenses.longest_expression(line.encode())
    assert time.perf_counter() - t < 5


def test_expressions_end_at_their_longest_whole_prefix():
    at = licenses.longest_expression
    assert at(b"mit and (apache-2.0")[1] == {"mit"}
    assert at(b"(mit") is None and at(b"and mit") is None
    assert at(b"mit or gpl-2.0 with classpath-exception-2.0")[1] == {"mit", "gpl"}


def test_unlinked_texts_of_one_id_both_stay(spark):
    one, other = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, one, "a"), (1, other, "b"), (1, one, "c"), (2, other, "d"), (None, one, "e"), (3, "", "f"),
                                  (3, "", "g")], "doc_id long, text string, mark string")
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in keep_one(docs).collect())
    assert kept == sorted([(1, one), (1, other), (0, one), (3, ""), (3, "")])
    assert keep_one(docs.limit(0)).count() == 0
