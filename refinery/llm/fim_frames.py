"""Fill-in-the-middle over seekable compressed texts.

A text is stored as independent zstandard frames of bounded size with a seek table: how
many units, characters and compressed bytes lie before the end of each frame
(``frame_texts``). A unit is one token: white space with the word after it, or the white
space that ends a text. Cutting a text after the k-th unit looks the frame up in the seek
table and decompresses that frame only; frames that no cut touches travel into the output
as they are, still compressed (``fill_in_middle``). Digests stream the frames in the order
of the output, so that no step holds a whole decompressed text (``frame_digests``).

All steps after the first are narrow: one row is one text, nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import binary_texts, map_arrow, stored, tune

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = "42"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"     # fixed values of the output forms
MARKERS = (PREFIX, SUFFIX, MIDDLE)
CHANGED_PERCENT, SPM_PERCENT = 50, 80               # fixed values: shares of the forms

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

FRAMED = ("doc_id long, n_units long, n_chars long, marked boolean, frames binary, "
          "units array<long>, chars array<long>, ends array<long>")
OUTPUT = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "frames binary, ends array<long>")
DIGESTS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
           "output_sha256 string, restored_sha256 string")


def _code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _unit_ends(data: np.ndarray, following: int | None) -> np.ndarray:
    """Ends (exclusive) of the units that end in ``data``; ``following`` is the byte after
    it, None at the end of the text."""
    space = _SPACE[data]
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[-1] = following is None or _SPACE[following]
    ends = np.flatnonzero(~space & after) + 1
    if following is None and space[-1]:     # white space at the end of a text is a unit
        ends = np.append(ends, len(data))
    return ends


def _frame_limits(text: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that cut no code point."""
    i = 0
    while i < len(text):
        j = min(i + size, len(text))
        while j < len(text) and (text[j] & 0xC0) == 0x80:
            j += 1
        yield i, j
        i = j


@dataclass
class Frames:
    """One text: compressed frames and, before the end of each, its units, characters, bytes."""

    blob: bytes
    units: Sequence[int]
    chars: Sequence[int]
    ends: Sequence[int]

    @classmethod
    def of(cls, text: bytes, packer: zstandard.ZstdCompressor, size: int) -> "Frames":
        parts, units, chars, ends = [], [], [], []
        n_units = n_chars = n_bytes = 0
        for i, j in _frame_limits(text, size):
            data = np.frombuffer(text, np.uint8, j - i, i)
            n_units += len(_unit_ends(data, text[j] if j < len(text) else None))
            n_chars += _code_points(data)
            parts.append(packer.compress(text[i:j]))
            n_bytes += len(parts[-1])
            units.append(n_units)
            chars.append(n_chars)
            ends.append(n_bytes)
        return cls(b"".join(parts), units, chars, ends)

    def packed(self, i: int) -> bytes:
        return self.blob[self.ends[i - 1] if i else 0:self.ends[i]]

    def seek(self, k: int, opener: zstandard.ZstdDecompressor) -> tuple[int, int, int]:
        """(frame, byte in it, characters before) just after the ``k``-th unit."""
        if k == 0:
            return 0, 0, 0
        i = bisect_left(self.units, k)
        before = self.units[i - 1] if i else 0
        raw = opener.decompress(self.packed(i))
        data = np.frombuffer(raw, np.uint8)
        # within a frame, a unit that the seek table counts and no white space closes ends with it
        ends = _unit_ends(data, 0x41)
        at = int(ends[k - before - 1]) if k - before <= len(ends) else len(raw)
        return i, at, (self.chars[i - 1] if i else 0) + _code_points(data[:at])


def frame_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> DataFrame:
    """Every text as seekable frames: doc_id, n_units, n_chars, marked, frames, units, chars, ends.

    ``units``, ``chars`` and ``ends`` are the seek table: units and characters of the text
    and bytes of ``frames`` up to the end of each frame. ``marked`` says that the text
    holds a marker itself. A null text is empty: no frame, no unit. One row per input row,
    ids may repeat or be null; other columns are left out; an empty table gives none.
    """
    tune(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=level)
        texts = binary_texts(batch.column("text"))
        made = [Frames.of(t, packer, frame_bytes) for t in texts]
        longs = pa.list_(pa.int64())
        return pa.record_batch(
            [batch.column("doc_id"), pa.array([f.units[-1] if f.units else 0 for f in made], pa.int64()),
             pa.array([f.chars[-1] if f.chars else 0 for f in made], pa.int64()),
             pa.array([any(m in t for m in MARKERS) for t in texts], pa.bool_()),
             pa.array([f.blob for f in made], pa.binary()), pa.array([f.units for f in made], longs),
             pa.array([f.chars for f in made], longs), pa.array([f.ends for f in made], longs)],
            ["doc_id", "n_units", "n_chars", "marked", "frames", "units", "chars", "ends"])
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(cols, run, FRAMED)


def draws(doc_id: int | None, seed: str = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers from the seed and the id (a null id counts as empty)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12))


class _Editor:
    """Parts of framed texts, put together anew; whole frames are copied, cut ones split."""

    def __init__(self, level: int):
        self.packer, self.opener = zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()
        self.markers = {m: self.packer.compress(m) for m in MARKERS}

    def span(self, text: Frames, start: tuple[int, int], stop: tuple[int, int]) -> list[bytes]:
        """Frames of the bytes from (frame, byte) to (frame, byte)."""
        (i, a), (j, b) = start, stop
        out = []
        for f in range(i, min(j + 1, len(text.ends))):
            lo, hi = a if f == i else 0, b if f == j else None
            if lo == 0 and hi is None:
                out.append(text.packed(f))
                continue
            part = self.opener.decompress(text.packed(f))[lo:hi]
            if part:
                out.append(self.packer.compress(part))
        return out


def fill_in_middle(framed: DataFrame, seed: str = SEED, level: int = LEVEL) -> DataFrame:
    """Texts of ``frame_texts`` with a middle part moved to the end, again as frames.

    Returns doc_id, n (units), form, prefix_chars, middle_chars, frames, ends. The form is
    ``plain`` (the text as it was; no characters given) for an empty text, for one that
    holds a marker, and for the share of ids that the seed leaves alone; otherwise ``spm``
    (suffix, prefix, middle) or ``psm`` (prefix, suffix, middle), each part after its
    marker. Parts may be empty. Rows with a repeated id are cut alike only if their texts
    have as many units; a null id is drawn as an empty one.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        edit, rows = _Editor(level), []
        for r in batch.to_pylist():
            text = Frames(r["frames"], r["units"], r["chars"], r["ends"])
            n, (h1, h2, h3, h4) = r["n_units"], draws(r["doc_id"], seed)
            if not n or r["marked"] or h3 % 100 >= CHANGED_PERCENT:
                rows.append((r["doc_id"], n, "plain", None, None, r["frames"], r["ends"]))
                continue
            cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
            (fa, ba, ca), (fb, bb, cb) = (text.seek(k, edit.opener) for k in cuts)
            parts = {PREFIX: edit.span(text, (0, 0), (fa, ba)), MIDDLE: edit.span(text, (fa, ba), (fb, bb)),
                     SUFFIX: edit.span(text, (fb, bb), (len(text.ends), 0))}
            spm = h4 % 100 < SPM_PERCENT
            out = [p for m in ((SUFFIX, PREFIX, MIDDLE) if spm else (PREFIX, SUFFIX, MIDDLE))
                   for p in (edit.markers[m], *parts[m])]
            rows.append((r["doc_id"], n, "spm" if spm else "psm", ca, cb - ca, b"".join(out),
                         np.cumsum([len(p) for p in out]).tolist()))
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)],
                               ["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames", "ends"])
    return map_arrow(framed, run, OUTPUT)


def _streamed(blob: bytes, ends: Sequence[int], opener: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    for i, end in enumerate(ends):
        yield opener.decompress(blob[ends[i - 1] if i else 0:end])


def unframe(framed: DataFrame) -> DataFrame:
    """The texts themselves: the frames' column replaced by ``text``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        opener = zstandard.ZstdDecompressor()
        texts = [b"".join(_streamed(b, e, opener)) for b, e in
                 zip(batch.column("frames").to_pylist(), batch.column("ends").to_pylist())]
        return pa.record_batch([*(batch.column(c) for c in keep), pa.array(texts, pa.binary()).cast(pa.string())],
                               [*keep, "text"])
    keep = [c for c in framed.columns if c not in ("frames", "units", "chars", "ends")]
    ddl = ", ".join(f"{c} {framed.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(framed, run, f"{ddl}, text string")


def _find_markers(pieces: Iterator[bytes], order: Sequence[bytes], see: Callable[[bytes], None]
                  ) -> tuple[list[int], list[int]]:
    """(byte just after each marker, raw length of each frame) of a streamed output.

    Only a frame and the last two bytes of the one before are held.
    """
    found: list[int] = []
    sizes: list[int] = []
    tail, at = b"", 0
    for piece in pieces:
        see(piece)
        sizes.append(len(piece))
        window, base, start = tail + piece, at - len(tail), 0
        while len(found) < len(order):
            hit = window.find(order[len(found)], start)
            if hit < 0:
                break
            start = hit + len(order[len(found)])
            found.append(base + start)
        at += len(piece)
        tail = window[max(start, len(window) - 2):]
    return found, sizes


def digests_of(blob: bytes, ends: Sequence[int], form: str, opener: zstandard.ZstdDecompressor) -> tuple[str, str]:
    """SHA-256 of the output and of the text rebuilt from output and form, streamed frame by frame."""
    whole = hashlib.sha256()
    if form == "plain":
        for piece in _streamed(blob, ends, opener):
            whole.update(piece)
        return whole.hexdigest(), whole.hexdigest()
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    after, sizes = _find_markers(_streamed(blob, ends, opener), order, whole.update)
    if len(after) != len(order) or after[0] != len(order[0]):
        raise ValueError(f"output of form {form} lacks its markers")
    total = sum(sizes)
    stops = [*(a - len(m) for a, m in zip(after[1:], order[1:])), total]
    part = {m: (a, b) for m, a, b in zip(order, after, stops)}
    raw = np.concatenate(([0], np.cumsum(sizes)))
    again = hashlib.sha256()
    for a, b in (part[PREFIX], part[MIDDLE], part[SUFFIX]):
        if a == b:
            continue
        for f in range(int(np.searchsorted(raw, a, "right")) - 1, int(np.searchsorted(raw, b, "left"))):
            piece = opener.decompress(blob[ends[f - 1] if f else 0:ends[f]])
            again.update(piece[max(0, a - int(raw[f])):b - int(raw[f])])
    return whole.hexdigest(), again.hexdigest()


def frame_digests(outputs: DataFrame) -> DataFrame:
    """Outputs of ``fill_in_middle`` with the digests of output and rebuilt text for their frames."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        opener = zstandard.ZstdDecompressor()
        made = [digests_of(b, e, f, opener) for b, e, f in zip(
            batch.column("frames").to_pylist(), batch.column("ends").to_pylist(), batch.column("form").to_pylist())]
        keep = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
        return pa.record_batch([*(batch.column(c) for c in keep), pa.array([m[0] for m in made], pa.string()),
                                pa.array([m[1] for m in made], pa.string())],
                               [*keep, "output_sha256", "restored_sha256"])
    return map_arrow(outputs, run, DIGESTS)


def fim_digests(docs: DataFrame) -> DataFrame:
    """One row per document: the cut, its form, and digests of output and rebuilt text.

    The framed texts are written to the shared folder first; cuts and digests read them.
    """
    return frame_digests(fill_in_middle(stored(frame_texts(docs), "fim-frames")))
