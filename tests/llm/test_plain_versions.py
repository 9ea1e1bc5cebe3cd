"""Operators against plain versions of their whole method: SQL of the WARC captures, a naive
search of notices and tags, expression trees, the order along the curve, and naive Bayes."""
import math
import random
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from refinery.llm import licenses, mixing
from refinery.llm.hilbert_shards import hilbert_shards, number_rows, shard_documents
from refinery.llm.oracles import ORACLES
from refinery.llm.quality import keep_good
from refinery.llm.queries import QUERIES
from refinery.llm.warc import warc_roundtrip

SF = "/root/testdata/sf0.001"


def _sql(query, **views):
    con = duckdb.connect()
    for name, source in views.items():
        if isinstance(source, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
        else:
            con.register(name, source)
    got = con.execute(query)
    names = [c[0] for c in got.description]
    return Counter(tuple(sorted(zip(names, row))) for row in got.fetchall())


def _rows(df):
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    assert _rows(QUERIES[name](spark, SF)) == _sql(ORACLES[name], **{table: f"{SF}/{table}.parquet"})


def test_captures_equal_their_sql_on_odd_pages(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(1, "http://a/\r\nX", big), (2, None, big), (0, "http://b", big), (3, "u", None), (4, "u", ""),
            (None, "u", big), (None, None, "y" * 200), (7, "v", "y" * 99), (8, "v", "y" * 99), (9, "v", "é" * 50),
            (10, "v", "é" * 50), (10, "v", "é" * 50), (-3, "w", "%0D%25")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert _rows(warc_roundtrip(pages)) == _sql(ORACLES["op1_warc_transactions"], pages=pages.toArrow())


# ---- license scans --------------------------------------------------------

def _longest(line):
    """The expression at the start of a line, by trying every prefix of its tokens."""
    tokens = [t.rstrip(".") if t not in ("and", "or", "with") else t
              for t in re.findall(r"[a-z0-9][a-z0-9.+-]*|[()]|[^\s]", line)]
    for n in range(len(tokens), 0, -1):
        if all(re.fullmatch(r"[a-z0-9][a-z0-9.+-]*|[()]", t) for t in tokens[:n]):
            try:
                return licenses.evaluate(licenses.parse_expression(tokens[:n]))
            except licenses.ExpressionError:
                pass
    return None


def _naive_scan(text):
    """Labels and score of an ASCII text: every phrase tried at every word, every tag's line parsed."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    labels, scores = set(), []
    for phrase, label in [*licenses.NOTICES.items(), *licenses.BASE.items()]:
        p = phrase.split()
        if any(words[i:i + len(p)] == p for i in range(len(words) - len(p) + 1)):
            labels.add(label)
            scores.append(licenses.FREEDOM[label])
    for part in low.split(licenses.TAG.decode())[1:]:
        found = _longest(part.split("\n")[0])
        if found:
            scores.append(found[0])
            labels |= found[1]
    return ",".join(sorted(labels)), min(scores, default=0.0)


def test_notices_and_tags_equal_a_naive_search(spark):
    rng = random.Random(11)
    phrases = [*licenses.NOTICES, *licenses.BASE]
    bits = ["MIT", "Apache-2.0", "GPL-3.0-or-later", "and", "OR", "with", "(", ")", "Classpath-exception-2.0", "foo.", ";", "CC0-1.0"]
    texts = ["", "mit licenses", "xmit license", "public  domain", "gnu general-public\nlicense", "SPDX-License-Identifier:"]
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(1, 8)):
            kind = rng.randrange(4)
            if kind == 0:
                parts.append(rng.choice([" ", "\n", ", ", "-", "x"]).join(rng.choice(phrases).split()).title())
            elif kind == 1:
                parts.append("SPDX-License-Identifier: " + " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 9))))
            else:
                parts.append(" ".join(rng.choice(["license", "the", "public", "cc", "by", "nc", "7"]) for _ in range(5)))
        texts.append(rng.choice(["\n", " "]).join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    given = spark.read.parquet(f"{SF}/documents.parquet").select(
        (F.col("doc_id") + 1_000_000).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.unionByName(given)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = licenses.scan_licenses(docs).collect()
    assert len(got) == len(text)
    for r in got:
        if text[r["doc_id"]].isascii():
            assert (r["labels"], r["score"]) == _naive_scan(text[r["doc_id"]]), text[r["doc_id"]][:200]
    assert sum(bool(r["labels"]) for r in got) > 200


def _tree(rng, depth):
    """(text, freedom, labels, rank of its top operator) of a random expression."""
    if depth == 0 or rng.random() < 0.3:
        name = rng.choice(sorted(licenses.FREEDOM))
        if rng.random() < 0.3:
            return f"{name} with some-exception", min(1.0, licenses.FREEDOM[name] + licenses.EXCEPTION), {name}, 3
        return name, licenses.FREEDOM[name], {name}, 4
    rank, op = rng.choice([(1, "or"), (2, "and")])
    sides = [_tree(rng, depth - 1) for _ in range(2)]
    shown = [f"( {t} )" if r < rank or rng.random() < 0.2 else t for t, _, _, r in sides]
    pick = max if op == "or" else min
    return f" {op} ".join(shown), pick(s[1] for s in sides), sides[0][2] | sides[1][2], rank


def test_random_expressions_equal_their_trees():
    rng = random.Random(5)
    for _ in range(2000):
        text, freedom, labels, _ = _tree(rng, rng.randrange(6))
        assert licenses.longest_expression(text.encode()) == (freedom, labels), text


# ---- order along the curve ------------------------------------------------

def test_shards_are_runs_of_the_curve(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    ranked, n = number_rows(docs, ["doc_id", "lang", "source"])
    rows = sorted(ranked.select("_rank", "_cell", "row.doc_id").collect())
    assert [r["_rank"] for r in rows] == list(range(n)) and n == docs.count()
    cells = [r["_cell"] for r in rows]
    assert cells == sorted(cells) and len(set(cells)) > 24
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in hilbert_shards(docs).collect()}
    assert [place[r["doc_id"]] for r in rows] == sorted(place.values())


def test_filters_meet_fewer_shards_than_in_table_order(spark):
    """Shards that hold a row of one language and source, per such pair."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    per_pair = shard_documents(docs).groupBy("lang", "source").agg(F.count_distinct("shard").alias("k"), F.count(F.lit(1)).alias("n"))
    rows = per_pair.collect()
    dealt = sum(24 * (1 - (23 / 24) ** r["n"]) for r in rows)       # expected if rows were dealt at random
    assert sum(r["k"] for r in rows) < 0.7 * dealt


# ---- mixing ---------------------------------------------------------------

def _plain_slots(text):
    words = {w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w}
    tokens = words | {"^" + w[:4] for w in words} | {"$" + w[-2:] for w in words}

    def slot(t):
        h = xxhash.xxh64(t.encode(), seed=42).intdigest()
        return (h - (h >> 63 << 64)) % mixing.BUCKETS
    return [slot(t) for t in tokens]


def test_posteriors_equal_plain_naive_bayes(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    domain = {}
    for r in labels.collect():
        d = "toxic" if r["toxic"] == 1 else {1: "high", 0: "low"}.get(r["quality"])
        if r["doc_id"] is not None and d:
            domain[r["doc_id"]] = max(d, domain.get(r["doc_id"], ""))
    share = Counter(domain.values())
    assert max(share.values()) <= mixing.SAMPLE_ROWS
    rows = docs.select("doc_id", "text").collect()
    counts = {d: Counter() for d in share}
    for r in rows:
        if r["doc_id"] in domain:
            counts[domain[r["doc_id"]]].update(set(_plain_slots(r["text"])))
    overall = sum(counts.values(), Counter())
    everywhere, weight = overall.total(), {d: {} for d in share}
    for s, k in overall.items():
        q = k / everywhere
        w = {d: math.log((counts[d][s] + mixing.PRIOR_COUNT * q) / (q * (counts[d].total() + mixing.PRIOR_COUNT)))
             for d in share}
        for d in share:
            weight[d][s] = w[d] - sum(w.values()) / len(w)
    got = mixing.posteriors(docs, mixing.fit_domains(docs, labels))
    got = {r["doc_id"]: r for r in got.select("doc_id", *[f"_p_{d}" for d in share]).collect()}
    for r in rows:
        slots = _plain_slots(r["text"])
        x = {d: mixing.TEMPER * sum(weight[d].get(s, 0.0) for s in slots) + math.log(share[d] / len(domain)) for d in share}
        top = max(x.values())
        total = sum(math.exp(v - top) for v in x.values())
        for d in share:     # the weights travel with three decimals
            assert got[r["doc_id"]][f"_p_{d}"] == pytest.approx(math.exp(x[d] - top) / total, abs=0.02)


def test_good_rows_without_an_id_are_kept(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(120))
    docs = spark.createDataFrame([(None, text, "en", "s"), (1, text, "en", "s"), (2, "short", "en", "s"), (3, None, None, None)],
                                 "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in keep_good(docs).collect()} == {None, 1}
