"""Overlapping chunks of whole sentences, planned on cumulative sentence lengths.

Sentences longer than a chunk are cut by themselves. The others form one row of lengths, and since a chunk is a run of
that row, its last sentence and the first one of the chunk behind it are found by binary search in the running totals: one
step for each chunk, however many sentences it has. A plan holds numbers of sentences only; texts are joined afterwards.

fixed values: offsets count the stream of sentences, each with one character behind it, less the overlap's length at the
beginning of a chunk that repeats sentences; so they drift from the places in the source, which stand beside them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PLACES = ("nth", "start", "end", "source_start", "source_end")
SLICE = 1 << 20
_BREAK = re.compile(r"(?<=[.!?])\s+|(?:\r?\n){2,}")


def sentence_places(text: str) -> list[tuple[int, int]]:
    """Where each sentence begins and ends in the text, without white space around it."""
    ends = [(m.start(), m.end()) for m in _BREAK.finditer(text)]
    out = []
    for a, b in zip([0, *(e for _, e in ends)], [*(s for s, _ in ends), len(text)]):
        piece = text[a:b]
        bare = piece.strip()
        if bare:
            at = a + len(piece) - len(piece.lstrip())
            out.append((at, at + len(bare)))
    return out


def plan(lengths: list[int], size: int, overlap: int) -> list[tuple[list[int] | int, int, int]]:
    """Chunks in order: (numbers of the sentences, offset, 0), or for a piece of a long one (its number, offset, where cut)."""
    stream = [0, *accumulate(n + 1 for n in lengths)]  # where each sentence begins in the stream
    short = [k for k, n in enumerate(lengths) if n <= size]
    total = [0, *accumulate(lengths[k] for k in short)]
    cuts = {k: bisect_left(short, k) for k, n in enumerate(lengths) if n > size}  # short sentences before each long one
    out: list[tuple[list[int] | int, int, int]] = []
    first, offset, least = 0, 0, 1  # a chunk ends behind `least` short sentences or later

    def close(last: int, follower: int) -> None:
        """Ends the chunk first..last-1; the next one repeats its last sentences, up to `overlap` characters of them."""
        nonlocal first, offset, least
        out.append((short[first:last], offset, 0))
        first = bisect_left(total, total[last] - overlap, first, last + 1)
        offset = stream[follower] - (total[last] - total[first])
        least = max(last + (lengths[follower] <= size), first + 1)

    def run(last: int) -> None:
        """Chunks that are full before the short sentence `last`."""
        while (full := max(bisect_right(total, total[first] + size) - 1, least)) < last:
            close(full, short[full])

    for k, before in cuts.items():
        run(before)
        if before > first:
            close(before, k)
        out += [(k, stream[k] + at, at) for at in range(0, lengths[k], size - overlap)]
    run(len(short))
    if len(short) > first:
        out.append((short[first:], offset, 0))
    return out


def cut(text: str, size: int, overlap: int) -> list[dict]:
    places = sentence_places(text)
    said = [text[a:b].replace("\r\n", "\n") for a, b in places]
    rows = []
    for which, offset, at in plan([len(s) for s in said], size, overlap):
        if isinstance(which, int):
            piece, a, b = said[which][at : at + size], which, which
        else:
            piece, a, b = " ".join(said[k] for k in which), which[0], which[-1]
        rows.append({"text": piece, "start": offset, "end": offset + len(piece), "source_start": places[a][0], "source_end": places[b][1]})
    return rows


def chunker(size: int, overlap: int, text: str = "text"):
    """mapInArrow kernel: rows with a text → a row for each of its chunks, the other columns repeated.

    Adds nth, start, end and source_start, source_end, where its sentences stand in the source; the text is the chunk's.
    Rows are cut SLICE bytes of text at a time, one at least, so no more than that and its chunks are held beside a batch.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names = batch.schema.get_field_index(text), batch.schema.names
            reach = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            lo, done = 0, 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(reach, done + SLICE, "right")))
                rows, owner = [], []
                for k, t in enumerate(batch.column(at).slice(lo, hi - lo).to_pylist(), lo):
                    pieces = cut(t or "", size, overlap)
                    rows += [{"nth": nth} | piece for nth, piece in enumerate(pieces)]
                    owner += [k] * len(pieces)
                which = pa.array(owner, pa.int64())
                said = pa.array([r["text"] for r in rows], pa.string())
                columns = [said if k == at else batch.column(k).take(which) for k in range(len(names))]
                columns += [pa.array([r[c] for r in rows], pa.int32()) for c in PLACES]
                lo, done = hi, int(reach[hi - 1])
                yield pa.RecordBatch.from_arrays(columns, [*names, *PLACES])

    return run
