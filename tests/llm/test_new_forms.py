"""Fill-in-middle frames, tensored MinHash and conversation repair against brute force, and
their defined results on nulls, empty and long texts, ties, empty tables and extra columns."""
import hashlib
import heapq
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from refinery.llm import conversation_repair as C
from refinery.llm import fim_frames as FM
from refinery.llm import minhash_tensor as MH

SF = "/root/testdata/sf0.001"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle ----------------------------------------------------
def fim(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, _sha(text), _sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 80 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return n, form, len(pre), len(mid), _sha(out), _sha(text)


HARD = ["", None, " ", "\n\t ", "word", " word ", "<P> inside", "a<", "<S", "x <P", "é à ü 中文 字", "　a b", "tail  \n",
        "one two three <", "> two <M three", "word other " * 40_000, "z" * 300_000, " " * 200_000 + "end"]


@pytest.mark.parametrize("frame_bytes", [1, 5, 64, 1 << 16])
def test_frames_of_any_size_give_the_same_outputs(spark, frame_bytes):
    texts = HARD if frame_bytes > 5 else [t for t in HARD if t is None or len(t) < 1000]
    rows = [(i, t) for i, t in enumerate(texts * 6)] + [(None, "no id at all"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, form string, n long")
    outputs = FM.fill_in_middle(FM.frame_texts(docs.repartition(3), frame_bytes))
    got = sorted(map(repr, (tuple(r) for r in FM.frame_digests(outputs).collect())))
    assert got == sorted(repr((i, *fim(i, t))) for i, t in rows)
    whole = {(r["doc_id"], _sha(r["text"])) for r in FM.unframe(outputs).collect()}
    assert whole == {(i, fim(i, t)[4]) for i, t in rows}


def test_whole_table_of_frames(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in FM.fim_digests(docs).collect()}
    assert got == {r["doc_id"]: fim(r["doc_id"], r["text"]) for r in docs.collect()}


def test_frames_are_cut_without_the_rest(spark):
    text = b"alpha beta\n" * 50_000
    import zstandard
    frames = FM.Frames.of(text, zstandard.ZstdCompressor(), 4096)
    opened = []

    class Opener:
        def decompress(self, data):
            opened.append(len(data))
            return zstandard.ZstdDecompressor().decompress(data)
    frame, at, chars = frames.seek(60_001, Opener())
    assert len(opened) == 1 and len(frames.ends) > 100
    assert frame * 4096 + at == chars == len("alpha beta\n") * 30_000 + len("alpha")
    assert FM.frame_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- MinHash ---------------------------------------------------------------
def components(rows, k=2):
    sets = {}
    for i, text in rows:
        w = WORDS.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = defaultdict(int)
    for ids in where.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                common[a, b] += 1
    for (a, b), o in common.items():
        if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_components_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in MH.near_duplicates(docs).collect()}
    assert got == components([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_a_family_at_the_threshold_loses_no_link(spark):
    """500 texts of 60 words, each the base with 0 to 9 words replaced: links and near misses."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(500):
        words = list(base)
        for at in rng.sample(range(60), rng.randrange(10)):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    got = MH.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == components(rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 64, n, np.uint64) for n in (8000, 1000, 1000))
    sig = MH.minhashes([np.concatenate((shared, a)), np.concatenate((shared, b))])
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.13
    keys = MH.group_keys(sig)
    assert ((keys & 1).sum(1) == MH.SIDE).all() and len(set(keys[0])) == 2 * MH.SIDE


def test_minhash_edge_cases(spark):
    long = "word other third fourth " * 20_000
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (3, None), (4, ""), (5, " \n"), (None, "a b c d e f"),
            (6, long), (7, "one"), (8, "ONE"), (9, "one two"), (10, long + "x")]
    docs = spark.createDataFrame([(*r, "k", 1, "s") for r in rows], "doc_id long, text string, key string, id long, sig string")
    got = sorted((repr(tuple(r)) for r in MH.near_duplicates(docs.repartition(3)).collect()))
    assert got == sorted(map(repr, [
        (1, 5, 1, True), (1, 5, 1, True), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
        (None, 5, None, True), (6, 4, 6, True), (7, 1, 7, True), (8, 1, 7, False), (9, 1, 9, True), (10, 5, 6, False)]))
    assert MH.near_duplicates(docs.limit(0)).count() == 0
    # one id with two texts: a document with the links of both
    two = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (3, "g h i j k l")],
                                "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in MH.near_duplicates(two).collect()} == {(1, 1), (2, 1), (3, 1)}


# ---- conversations ---------------------------------------------------------
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def repair(rows):
    """Cheapest edits by best-first search over whole audits; rows of (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen
                      else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            break
        give = next(x for x in "ua" if x in MOVES[state])
        heapq.heappush(heap, (cost + 3, audit + "I", i, MOVES[state][give], out + (f"{NAMES[give]}:",)))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
        if faults[i] not in ("blank", "duplicate"):
            extra = 3 if faults[i] else 0
            if role[:1] in MOVES[state]:
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, MOVES[state][role[:1]], out + (f"{role}:{text}",)))
            heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, MOVES[state][give],
                                  out + (f"{NAMES[give]}:{text}",)))
    illegal = sum(p[1][:1] + q[1][:1] not in ("su", "ua", "au") for p, q in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            _sha("\n".join(out)))


def _in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def _check(spark, rows, partitions=5):
    """``rows`` of (conv, turn, role, text), none null but conv and turn."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
    found, repaired = C.repair_conversations(frame)
    found = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    digests = {r["conv_id"]: r["repaired_sha256"] for r in C.conversation_digests(repaired).collect()}
    for conv, its in by.items():
        want = repair(_in_order(its))
        assert (*found[conv], digests.get(conv, _sha(""))) == want, (conv, _in_order(its))
    assert set(found) == set(by)


def test_random_conversations(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(400):
        for _ in range(rng.randrange(1, 9)):
            rows.append((conv if conv else None, rng.choice([None, *range(7)]),
                         rng.choice(["user", "assistant", "system", "tool", "User", ""]),
                         rng.choice(["Yes.", "No", "", " \n", "Why? ", "Stop!\x0b", "é.", "a "])))
    _check(spark, rows)


def test_a_conversation_of_many_blocks(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {t}" + rng.choice([".", ""])) for t in range(2600)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")]
    _check(spark, rows, 3)


def test_whole_table_of_conversations(spark):
    import zlib
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    by = defaultdict(list)
    for r in table.collect():
        op, text, role = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20, r["text"], r["role"]
        its = by[r["conv_id"]]
        if op:
            text = "" if op == 1 else re.sub("[.!?]", "", text) if op == 2 else text
            its += [(r["turn"], "user" if op == 4 else role, text)] * (2 if op == 3 else 1)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.conversation_repair(table).collect()}
    assert got == {c: repair(_in_order(its)) if its else (0, 0, 0, 0, 0, 0, "", _sha("")) for c, its in by.items()}


def test_conversation_edge_cases(spark):
    ddl = "conv_id long, turn long, role string, text string, part int, audit string, symbol string"
    assert C.conversation_repair(spark.createDataFrame([], ddl)).count() == 0
    rows = [(1, None, None, None), (1, None, None, None), (None, 3, "user", "Hi."), (None, 4, "assistant", "Long. " * 50_000)]
    got = C.conversation_repair(spark.createDataFrame([(*r, 1, "a", "s") for r in rows], ddl))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r["conv_id"] for r in got.collect()} == {1, None}


def test_shared_suffixes_are_made_once(spark, monkeypatch):
    signatures = ["xuaua", "suaua", "uaua", "Uaua", "oaua", ""]
    made = C.audits(spark.createDataFrame([(s,) for s in signatures], "signature string").coalesce(1)).collect()
    for r in made:
        rows = [(i, {"u": "user", "a": "assistant", "s": "system", "o": "tool", "x": "user"}[c.lower()],
                 "" if c == "x" else f"t{i}" + ("" if c.isupper() else ".")) for i, c in enumerate(r["signature"])]
        assert (r["cost"], r["audit"]) == repair(rows)[5:7]
    node = C.END
    for c in "aua":
        node = C.prepend(c, node)
    assert len(node.cost) == 4 and sorted(set(node.rank)) == list(range(len(set(node.rank))))
