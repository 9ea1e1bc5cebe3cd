"""Secret scan: base patterns and a sliding-window entropy detector, as column expressions.

A string candidate is a run of key characters that holds a digit and a letter.
A window of ``WINDOW`` characters slides over it; the Shannon entropy of the
window follows from counts that change by one character in and one out. Windows at
or above the threshold of the candidate's character class mark a span, unless the
candidate is on the allow-list. Positions are code points, from the lengths of
the pieces between matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import let

# The base patterns and their least lengths.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"       # runs of 18 or more, as their maximal runs
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+"
WINDOW = 20
#: Least entropy (bits) of a window by class: hex digits, single-case letters and digits, mixed.
CLASSES = (("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
           ("alnum", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.5),
           ("mixed", r"^", 3.7))
#: Candidates that are known not to be secrets.
ALLOW = (r"(?i)example|sample|placeholder|dummy|test_?key|0123456789|abcdefghij"
         r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^sha(256|384|512)-")
_CHUNK = 128
_COUNT_BITS = 7         # of a character's count in a window; eight counts are one number
_PLOGP = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def _spans(text: Column, pattern: str, keep=None, group: int | None = None) -> Column:
    """array<struct<s, e, v>> of the matches of ``pattern``: start, end and group (or match).

    ``keep(span)`` filters. Start positions are running sums of the lengths of the
    pieces between matches, built in chunks so that long lists stay cheap.
    """
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def located(found: Column) -> Column:
        values = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        joined = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("p"),
                              found.alias("m"), values.alias("g"))

        def chunk(state: Column, part: Column) -> Column:
            inner = F.aggregate(
                part, F.struct(state["at"].alias("at"), empty.alias("out")),
                lambda acc, x: let(acc["at"] + F.length(x["p"]), lambda s: F.struct(
                    (s + F.length(x["m"])).alias("at"),
                    F.concat(acc["out"], F.array(F.struct(
                        s.alias("s"), (s + F.length(x["m"])).alias("e"), x["g"].alias("v")))).alias("out"))))
            return let(inner, lambda r: F.struct(
                r["at"].alias("at"), F.concat(state["out"], F.array(r["out"])).alias("out")))

        def walk(all_: Column) -> Column:
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _CHUNK).cast("int")),
                                lambda c: F.slice(all_, c * _CHUNK + 1, F.lit(_CHUNK)))
            start = F.struct(F.lit(0).alias("at"),
                             F.array().cast("array<array<struct<s:int,e:int,v:string>>>").alias("out"))
            return F.flatten(F.aggregate(parts, start, chunk)["out"])
        return F.when(F.size(found) == 0, empty).otherwise(let(joined, walk))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return spans if keep is None else F.filter(spans, keep)


def high_entropy(value: Column, least: Column) -> Column:
    """struct<first, last>: extent of the windows of ``value`` at or above ``least`` bits, or nulls.

    The state holds the window's count of each ASCII character, eight to a number, and the
    sum of count * log2(count); each step adds one character and takes one away.
    """
    table = F.array(*[F.lit(x) for x in _PLOGP])
    chars = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.ascii(F.substr(value, i, F.lit(1))))

    def word(code: Column) -> Column:
        return F.shiftright(code, 3)

    def shift(code: Column) -> Column:
        return code.bitwiseAND(7) * _COUNT_BITS

    def held(counts: Column, code: Column) -> Column:
        """Count of a character (0 for none)."""
        packed = F.call_function("shiftright", F.get(counts, word(code)), shift(code))
        return F.coalesce(packed.bitwiseAND((1 << _COUNT_BITS) - 1).cast("int"), F.lit(0))

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), shift(code))

    def slide(codes: Column) -> Column:
        start = F.struct(F.array_repeat(F.lit(0).cast("long"), 16).alias("n"), F.lit(0.0).alias("sum"),
                         F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(-1)

            def moved(c: Column) -> Column:         # c: struct of the characters and their counts
                out = F.when((c["old"] >= 0) & (c["old"] != c["new"]),
                             F.get(table, c["co"] - 1) - F.get(table, c["co"])).otherwise(0.0)
                into = F.when(c["old"] != c["new"],
                              F.get(table, c["cn"] + 1) - F.get(table, c["cn"])).otherwise(0.0)
                counts = F.when(c["old"] == c["new"], acc["n"]).otherwise(F.transform(
                    acc["n"], lambda n, k: n + F.when(k == c["word_in"], c["in"]).otherwise(0)
                    - F.when(k == c["word_out"], c["out"]).otherwise(0)))
                return let(acc["sum"] + out + into, lambda s: let(
                    (i >= WINDOW - 1) & (F.lit(math.log2(WINDOW)) - s / WINDOW >= least), lambda hit: F.struct(
                        counts.alias("n"), s.alias("sum"),
                        F.when(hit, F.coalesce(acc["first"], i - WINDOW + 1)).otherwise(acc["first"]).alias("first"),
                        F.when(hit, i + 1).otherwise(acc["last"]).alias("last"))))
            return let(F.struct(new.alias("new"), old.alias("old"),
                                held(acc["n"], new).alias("cn"), held(acc["n"], old).alias("co"),
                                word(new).alias("word_in"), one(new).alias("in"),
                                word(old).alias("word_out"), one(old).alias("out")), moved)
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)
    return let(let(chars, slide), lambda r: F.struct(r["first"].alias("first"), r["last"].alias("last")))


def _entropy_spans(text: Column, allow: str) -> Column:
    def wanted(x: Column) -> Column:
        return (F.length(x["v"]) >= WINDOW) & x["v"].rlike("[A-Za-z]") & ~x["v"].rlike(allow)

    def measured(x: Column) -> Column:
        least = F.lit(CLASSES[-1][2])
        for _, shape, bits in reversed(CLASSES[:-1]):
            least = F.when(x["v"].rlike(shape), bits).otherwise(least)
        return let(high_entropy(x["v"], least), lambda h: F.struct(
            (x["s"] + h["first"]).alias("s"), (x["s"] + h["last"]).alias("e"), x["v"].alias("v")))
    return F.filter(F.transform(_spans(text, CANDIDATE, wanted), measured), lambda x: x["s"].isNotNull())


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.get(F.array(*[F.lit(k) for k in KINDS]), x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, allow: str = ALLOW) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Base spans of a kind are leftmost and do not overlap; the allow-list suppresses
    spans of the entropy detector only. Null texts count as empty (no spans, the
    checksum of the empty string); repeated rows are reported each; equal starts
    are listed in the order of the kinds; an empty table gives no rows.
    """
    def kind(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    def scan(text: Column) -> Column:
        every = F.struct(
            kind(_spans(text, ASSIGN, lambda x: F.length(x["v"]) >= ASSIGN_LEAST, 1), 0).alias("a"),
            kind(_spans(text, ACCESS), 1).alias("k"), kind(_spans(text, HEX), 2).alias("h"),
            kind(_entropy_spans(text, allow), 3).alias("x"))
        return let(every, lambda m: let(F.concat(m["a"], m["k"], m["h"]), lambda base: F.struct(
            F.size(m["a"]).cast("long").alias("n_assign"), F.size(m["k"]).cast("long").alias("n_access"),
            F.size(m["h"]).cast("long").alias("n_hex"),
            F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
            _listed(F.concat(base, m["x"])).alias("spans"))))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", let(text, scan).alias("_r")).select("doc_id", "_r.*")


def redact_secrets(docs: DataFrame, mask: str = "[secret]", allow: str = ALLOW) -> DataFrame:
    """The documents with the text's secrets, as found by :func:`find_secrets`, masked."""
    def masked(text: Column) -> Column:
        found = F.concat(*[F.transform(s, lambda x: x["v"]) for s in (
            _spans(text, ASSIGN, lambda x: F.length(x["v"]) >= ASSIGN_LEAST, 1), _spans(text, ACCESS),
            _spans(text, HEX), _entropy_spans(text, allow))])
        return F.aggregate(F.array_sort(F.array_distinct(found), lambda a, b: F.length(b) - F.length(a)), text,
                           lambda t, v: F.replace(t, v, F.lit(mask)))
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), let(F.col("text").cast("string"), masked)))
