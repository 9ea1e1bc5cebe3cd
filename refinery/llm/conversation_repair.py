"""Conversation structure repair over a suffix-shared automaton.

A conversation is a sequence of rows; its *signature* has one symbol per row, from the
row's role initial and its fault. The cheapest way to edit a signature into the grammar
``(s?(ua)+)?`` depends only on the signature, so it is found per distinct signature, and
within signatures per distinct *suffix*: signatures are dealt out and sorted by their
reversed text, so that equal endings follow each other and every node of the automaton
that shares suffixes is built once, from the end (``audits``). A node holds, for each of
the four grammar states, the cost to go, the best edit and the rank of the best audit
suffix among the states; nothing in it grows with the conversation.

Rows are put in order by a range partitioning on (conversation, turn), so a conversation
that holds a large part of all rows is spread over tasks; what is gathered per conversation
is one byte a row, as many as the audit itself has.

Order within a conversation: turn, nulls first, then role, then a digest of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import stored, tune

# White space, sentence ends, costs and the grammar (s?(ua)+)? as
# state -> {initial: next state}; states 0 and 3 accept.
WHITE, SENTENCE_ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
LEGAL_PAIRS = ("su", "ua", "au")
ROLE_OF = {"u": "user", "a": "assistant"}
#: The initial (u or a) that a rerole or an insert gives in each state.
GIVEN = tuple(next(i for i in ("u", "a") if i in moves) for moves in GRAMMAR)

#: Symbols of a signature: a row that must go, or its initial (other roles: o), upper case if truncated.
GONE = "x"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text.

    By crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1), loses its
    sentence ends (2), is repeated (3) or becomes the user's (4). Null roles and texts are
    one space, null ids and turns are one space in the checksum only.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce(F.col("text").cast("string"), space)
    return (conversations.withColumn("_op", F.crc32(key.cast("binary")) % 20).where("_op <> 0")
            .select("conv_id", "turn",
                    F.when(F.col("_op") == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
                    F.when(F.col("_op") == 1, "").when(F.col("_op") == 2, F.translate(text, SENTENCE_ENDS, ""))
                    .otherwise(text).alias("text"),
                    F.explode(F.when(F.col("_op") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def _marked(rows: DataFrame) -> DataFrame:
    """Narrow rows: conv_id, turn, role, digest of the text, its symbol, blank, truncated."""
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    cut = ~F.right(tail, F.lit(1)).isin(*SENTENCE_ENDS)
    return rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), initial.alias("initial"),
                       (tail == "").alias("blank"), (cut & (tail != "")).alias("cut"),
                       F.when(cut, F.upper(known)).otherwise(known).alias("symbol"))


BLOCKS = ("conv_id {kind}, part int, seq long, symbols string, first string, last string, illegal long, "
          "blank long, duplicate long, truncated long, low long, high long, turns long")


def _blocks(ordered: DataFrame, kind: str, size: int = 1024) -> DataFrame:
    """Runs of at most ``size`` rows of one conversation, in order, with their counts.

    ``ordered`` is sorted within its partitions. A run that starts where another ends
    shares no row with it; ``turns`` counts the distinct turns that no earlier row of the
    same partition has.
    """
    names = ["conv_id", "part", "seq", "symbols", "first", "last", "illegal", "blank", "duplicate", "truncated",
             "low", "high", "turns"]
    schema = BLOCKS.format(kind=kind)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    types = [arrow, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.int64()] * 7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        row_before, symbols, seq, part = None, [], 0, 0
        conv = first = last = low = high = None
        counts = [0, 0, 0, 0, 0]     # illegal, blank, duplicate, truncated, turns

        def close():
            nonlocal symbols, counts, low, high
            if symbols:
                out.append((conv, part, seq, "".join(symbols), first, last, *counts[:4], low, high, counts[4]))
            symbols, counts, low, high = [], [0, 0, 0, 0, 0], None, None

        def batch_of(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in
                    ("conv_id", "turn", "role", "digest", "initial", "blank", "cut", "symbol", "later", "part")]
            for cid, turn, role, digest, initial, blank, cut, symbol, later, part in zip(*cols):
                here = (cid, turn, role, digest)
                fresh = row_before is None or row_before[0] != cid
                if fresh or len(symbols) >= size:
                    close()
                    seq = 0 if fresh else seq + 1
                    conv, first = cid, initial
                elif last + initial not in LEGAL_PAIRS:
                    counts[0] += 1
                # the first of equal rows of one turn is told from its copies by the sort alone
                copy = later or here == row_before
                if blank:
                    counts[1] += 1
                elif copy:
                    counts[2] += 1
                elif cut:
                    counts[3] += 1
                symbols.append(GONE if blank or copy else symbol)
                if turn is not None:
                    if fresh or row_before[1] != turn:
                        counts[4] += 1
                    low, high = turn if low is None else low, turn
                last, row_before = initial, here
            if len(out) >= 512:
                yield batch_of(out)
                out = []
        close()
        if out:
            yield batch_of(out)
    return ordered.mapInArrow(run, schema)


class Node(NamedTuple):
    """A suffix: per grammar state the cost to go, inserts before the row, its letter,
    the state after the row, and the rank of its audit among the four states."""

    cost: tuple
    inserts: tuple
    letter: tuple
    after: tuple
    rank: tuple


def _end_node() -> Node:
    cost, inserts = [], []
    for s in range(4):
        n = 0
        while s not in ACCEPTING:
            s, n = GRAMMAR[s][GIVEN[s]], n + 1
        cost.append(INSERT * n)
        inserts.append(n)
    return Node(tuple(cost), tuple(inserts), ("",) * 4, (None,) * 4, tuple(inserts))


END = _end_node()
_ORDER = {"D": 0, "I": 1, "K": 2, "R": 3}


def prepend(symbol: str, rest: Node) -> Node:
    """The node of ``symbol`` followed by the suffix ``rest``.

    Audits of equal cost are compared as text: by their inserts and the row's letter, then
    by the ranks of the suffixes that follow; a suffix is never read again.
    """
    best = []
    for state in range(4):
        options, s = [], state
        for inserts in range(4):        # a fourth insert comes back to a state met before
            spent = INSERT * inserts
            options.append((spent + DELETE + rest.cost[s], inserts, "D", s))
            if symbol != GONE:
                own, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
                if own in GRAMMAR[s]:
                    t = GRAMMAR[s][own]
                    options.append((spent + extra + rest.cost[t], inserts, "K", t))
                t = GRAMMAR[s][GIVEN[s]]
                options.append((spent + extra + REROLE + rest.cost[t], inserts, "R", t))
            s = GRAMMAR[s][GIVEN[s]]
        least = min(o[0] for o in options)
        # audit text: inserts, letter, then the suffix. Two of them differ within the first
        # three inserts and letter, or have these alike and differ by the suffix's rank.
        best.append(min((tuple([1] * i + [_ORDER[x]]), rest.rank[t], i, x, t, c)
                        for c, i, x, t in options if c == least))
    texts = sorted({b[:2] for b in best})
    return Node(tuple(b[5] for b in best), tuple(b[2] for b in best), tuple(b[3] for b in best),
                tuple(b[4] for b in best), tuple(texts.index(b[:2]) for b in best))


def _audit(path: list[Node]) -> str:
    """Best edits from state 0 along a path of nodes, whole signature first, end last."""
    out, state = [], 0
    for node in path:
        out.append("I" * node.inserts[state] + node.letter[state])
        state = node.after[state]
    return "".join(out)


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures.

    Every task gets a range of reversed signatures in order; the path of the last one is
    kept, and only the nodes in front of the longest common suffix are made anew. A node
    is made once, but for the at most one path that two neighbouring tasks share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, before = [END], ""         # nodes from the end to the front
        for batch in batches:
            rows = []
            for backwards in batch.column("backwards").to_pylist():
                same, most = 0, min(len(before), len(backwards))
                while same < most and before[same] == backwards[same]:
                    same += 1
                del path[same + 1:]
                for symbol in backwards[same:]:
                    path.append(prepend(symbol, path[-1]))
                rows.append((backwards[::-1], path[-1].cost[0], _audit(path[::-1])))
                before = backwards
            sig, cost, audit = zip(*rows)
            yield pa.record_batch([pa.array(sig, pa.string()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                  ["signature", "cost", "audit"])
    ordered = (signatures.select(F.reverse("signature").alias("backwards"))
               .repartitionByRange("backwards").sortWithinPartitions("backwards"))
    return ordered.mapInArrow(run, "signature string, cost long, audit string")


def conversation_audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. ``rows`` has conv_id, turn, role and text, none of the last two null."""
    marked = _marked(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    # rows that occur again, with the turn of the first (nulls first)
    seen = (marked.groupBy("conv_id", "role", "digest")
            .agg(F.count(F.lit(1)).alias("c"), F.count("turn").alias("turns"), F.min("turn").alias("low"))
            .where("c > 1")
            .select(F.col("conv_id").alias("c_id"), F.col("role").alias("c_role"), F.col("digest").alias("c_digest"),
                    F.when(F.col("c") == F.col("turns"), F.col("low")).alias("first_turn")))
    later = (F.col("c_digest").isNotNull() & F.col("turn").isNotNull()
             & F.coalesce(F.col("turn") > F.col("first_turn"), F.lit(True)))
    flagged = (marked.join(seen, F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("role") == F.col("c_role"))
                           & (F.col("digest") == F.col("c_digest")), "left")
               .select("conv_id", "turn", "role", "digest", "initial", "blank", "cut", "symbol", later.alias("later")))
    order = ["conv_id", "turn", "role", "digest"]
    ordered = (flagged.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("part", F.spark_partition_id()))
    blocks = stored(_blocks(ordered, kind), "repair-blocks")
    # blocks in order, one byte a row; pairs and turns where two blocks meet
    per = (blocks.groupBy("conv_id")
           .agg(F.sort_array(F.collect_list(F.struct("part", "seq", "symbols", "first", "last", "low", "high"))).alias("b"),
                *[F.sum(c).alias(c) for c in ("illegal", "blank", "duplicate", "truncated", "turns")],
                F.min("low").alias("low"), F.max("high").alias("high")))
    pairs = F.sequence(F.lit(1), F.size("b") - 1)
    joins = F.when(F.size("b") > 1, F.aggregate(pairs, F.lit(0).cast("long"), lambda n, i: n + F.when(
        F.concat(F.col("b")[i - 1]["last"], F.col("b")[i]["first"]).isin(*LEGAL_PAIRS), 0).otherwise(1))).otherwise(0)
    # a turn that goes on in the next partition's first block was counted in both
    shared = F.when(F.size("b") > 1, F.aggregate(pairs, F.lit(0).cast("long"), lambda n, i: n + F.when(
        (F.col("b")[i - 1]["part"] != F.col("b")[i]["part"]) & (F.col("b")[i - 1]["high"] == F.col("b")[i]["low"]), 1)
        .otherwise(0))).otherwise(0)
    found = stored(per.select("conv_id", F.array_join(F.transform("b", lambda x: x["symbols"]), "").alias("signature"),
                              (F.col("illegal") + joins).cast("long").alias("illegal"), "blank", "duplicate", "truncated",
                              F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - shared), F.lit(0))
                              .cast("long").alias("gaps")), "repair-signatures")
    best = audits(found.select("signature").distinct())
    return (found.join(best, "signature")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))


REPAIRED = "conv_id {kind}, ord long, edit string, role string, text string"


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations, row by row and in order within each partition: conv_id,
    ord, edit (K, R or I), role, text. Deleted rows are left out, inserted ones are empty.

    All rows of a conversation come to one partition, as the digest of its whole text has
    to be fed in order; they are sorted there and streamed, never held together.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    names, types = ["conv_id", "ord", "edit", "role", "text"], [arrow, pa.int64(), pa.string(), pa.string(), pa.string()]
    lines = (rows.select("conv_id", F.lit(1).alias("_at"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text",
                         F.lit(None).cast("string").alias("audit"))
             .unionByName(found.select("conv_id", F.lit(0).alias("_at"), F.lit(None).cast("long").alias("turn"),
                                       F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                                       F.lit(None).cast("string").alias("text"), "audit")))
    lines = (lines.withColumn("turn", F.col("turn").cast("long")).repartition("conv_id")
             .sortWithinPartitions("conv_id", "_at", "turn", "role", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        audit, at, state, conv, n = "", 0, 0, None, 0

        def batch_of(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def put(edit, role, text):
            nonlocal n
            out.append((conv, n, edit, role, text))
            n += 1

        def inserted():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                put("I", ROLE_OF[GIVEN[state]], "")
                state, at = GRAMMAR[state][GIVEN[state]], at + 1

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "_at", "role", "text", "audit")]
            for cid, kind_, role, text, its in zip(*cols):
                if kind_ == 0:
                    inserted()                      # what the conversation before still lacks
                    audit, at, state, conv, n = its, 0, 0, cid, 0
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    put(edit, role, text)
                    state = GRAMMAR[state][role[0]]
                elif edit == "R":
                    put(edit, ROLE_OF[GIVEN[state]], text)
                    state = GRAMMAR[state][GIVEN[state]]
            if out:
                yield batch_of(out)
                out = []
        inserted()
        if out:
            yield batch_of(out)
    return lines.mapInArrow(run, REPAIRED.format(kind=kind))


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; rows in the order of ``repaired_rows``."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, conv = None, None
        for batch in batches:
            done = []
            for cid, at, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "ord", "role", "text")]):
                if at == 0:
                    if open_ is not None:
                        done.append((conv, open_.hexdigest()))
                    open_, conv = hashlib.sha256(), cid
                else:
                    open_.update(b"\n")
                open_.update(f"{role}:{text}".encode())
            if done:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), (arrow, pa.string()))],
                                      ["conv_id", "repaired_sha256"])
        if open_ is not None:
            yield pa.record_batch([pa.array([conv], arrow), pa.array([open_.hexdigest()], pa.string())],
                                  ["conv_id", "repaired_sha256"])
    return repaired.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired rows of conversations (conv_id, turn, role, text).

    Null roles and texts count as one space (so the text is blank); a null conv_id is a
    conversation of its own; null turns come first and are left out of ``gaps``; equal rows
    of one turn are duplicates of the first; other columns are left out; an empty table
    gives two empty results.
    """
    tune(rows.sparkSession)
    space = F.lit(" ")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), space).alias("role"),
                       F.coalesce(F.col("text").cast("string"), space).alias("text"))
    found = stored(conversation_audits(rows), "repair-audits")
    return found, repaired_rows(rows, found)


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after damage and repair: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation that the damage leaves without rows has zeros, an empty audit and the
    digest of the empty text, as has one whose repair deletes all its rows (for the digest).
    """
    found, repaired = repair_conversations(damage(conversations))
    digests = conversation_digests(repaired).withColumnRenamed("conv_id", "_id")
    every = conversations.select(F.col("conv_id").alias("_every")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
            .join(digests, F.col("_every").eqNullSafe(F.col("_id")), "left")
            .select(F.col("_every").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
