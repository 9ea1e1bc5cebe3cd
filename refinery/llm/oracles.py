"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UNIT = rf"[\x20\x09-\x0D]*{WORD}|[\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingle_components(k: int, kept: str = "") -> str:
    """Documents linked at 100 * intersection >= 80 * union of their k-word shingle sets."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')))
        END AS sh FROM d),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS o FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.root)
SELECT n.doc_id, CAST(any_value(n.n) AS BIGINT) AS n_shingles, MIN(r.root) AS component_id{kept}
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id"""


FILL_IN_MIDDLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '{UNIT}') AS w,
        CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
        CAST('0x' || h[17:24] AS UBIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS UBIGINT) % 100 AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
             WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid,
        coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


#: Captures as the archives give them back, with the identifiers that their records carry.
WARC_CAPTURES = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha256(html) AS digest,
        coalesce(CAST(page_id AS VARCHAR), '-') || '|' || coalesce(url, '-') || '|' || sha256(html) AS k FROM p),
f AS (SELECT digest, MIN(page_id) AS original FROM d WHERE n >= 100 GROUP BY digest),
c AS (SELECT d.*, CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
      FROM d LEFT JOIN f ON f.digest = d.digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       '<urn:sha256:' || sha256('request|' || k) || '>' AS request_id,
       '<urn:sha256:' || sha256('metadata|' || k) || '>' AS metadata_id
FROM c"""


ORACLES: dict[str, str] = {
    "op1_warc_transactions": WARC_CAPTURES,
    "op7_ngram_jaccard_join": shingle_components(5),
    "op11_fim_frames": FILL_IN_MIDDLE,
    "op12_minhash_tensor": shingle_components(2, ", MIN(r.root) = n.doc_id AS kept"),
}
