"""Hierarchical multi-length packing of tokenised documents into power-of-two context sizes.

Method: a document's ids are first cut into whole windows of the longest tier; the rest (shorter than a window) is
routed to the smallest tier that holds it. Each task packs its rests in blocks of bounded size, from the longest
tier down: every window opens with the longest piece of its tier, its gap is filled with the longest whole pieces
of shorter tiers that fit, and what is left of the gap with a cut of the next longer piece, whose remainder returns
to a shorter tier. So each window is full, except the last of a block, which is split into power-of-two sequences:
nothing is padded. Full windows of a tier are dealt to step groups of the same number of tokens.

No shuffle: a document's pieces, its sequences and their step groups belong to one task. Sequence and step ids hold
the partition, so they are unique; a task that is run again makes its own pieces anew, whole.

Nulls: a null text is empty (its only id is the end id); a null doc_id is kept. Repeated rows are packed each.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from metrolens.llm.common import ship, text_rows
from metrolens.llm.tokens import encoded, encoder

ship(__name__)

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
BLOCK_DOCS = 4096
BLOCK_TOKENS = 2 << 20
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, context int, "
          "step_id long, ids binary")


class Shelf:
    """Pieces by length, with the longest piece up to a length, or the shortest from a length on, at hand."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.mask = 0  # bit n: there are pieces of length n

    def put(self, piece) -> None:
        n = piece[2]
        self.by_length.setdefault(n, []).append(piece)
        self.mask |= 1 << n

    def take(self, n: int):
        stack = self.by_length[n]
        piece = stack.pop()
        if not stack:
            self.mask &= ~(1 << n)
        return piece

    def longest(self, limit: int) -> int:
        """Length of the longest piece of at most ``limit``; 0 if there is none."""
        return max(0, (self.mask & ((2 << limit) - 1)).bit_length() - 1)

    def shortest_above(self, limit: int) -> int:
        above = self.mask >> (limit + 1)
        return (above & -above).bit_length() + limit if above else 0


def pack_block(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list]]:
    """Pieces (document, start, length up to the longest tier) as sequences (context, [(document, start, length)]).

    Every sequence is exactly as long as its context, a power of two.
    """
    shelf, out = Shelf(), []
    for piece in pieces:
        shelf.put(piece)
    for size, below in sorted(zip(tiers, (0, *tiers)), reverse=True):
        while (n := shelf.longest(size)) > below:
            window, gap = [shelf.take(n)], size - n
            while gap and (n := shelf.longest(gap)):
                window.append(shelf.take(n))
                gap -= n
            if gap and (n := shelf.shortest_above(gap)):
                doc, start, length = shelf.take(n)
                window.append((doc, start, gap))
                shelf.put((doc, start + gap, length - gap))
                gap = 0
            out += [(size, window)] if not gap else split_powers(window)
    return out


def split_powers(window: list[tuple[int, int, int]]) -> list[tuple[int, list]]:
    """A window's pieces cut into sequences of power-of-two lengths, longest first."""
    left, out = list(reversed(window)), []
    total = sum(p[2] for p in window)
    while total:
        size = need = 1 << (total.bit_length() - 1)
        row = []
        while need:
            doc, start, length = left.pop()
            row.append((doc, start, min(length, need)))
            if length > need:
                left.append((doc, start + need, length - need))
            need -= row[-1][2]
        out.append((size, row))
        total -= size
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, tiers: tuple[int, ...] = TIERS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's ids, doc_tokens, sequence_id, offset in it,
    context (the sequence's length), step_id (its step group), ids (little-endian unsigned 32-bit integers).

    ``tiers`` are ascending powers of two; the last is the longest sequence.
    """
    if any(t & (t - 1) or t < 1 for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be ascending powers of two")
    top = tiers[-1]
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(tokenizer_path), TaskContext.get().partitionId() << 36
        sequences, steps = 0, 0
        filled: dict[int, int] = {}  # context -> sequences so far in its open step
        open_step: dict[int, int] = {}

        def rows_of(packed, held):
            nonlocal sequences, steps
            for context, window in packed:
                per_step = max(1, step_tokens // context)
                if filled.get(context, per_step) >= per_step:
                    open_step[context], filled[context] = base + steps, 0
                    steps += 1
                filled[context] += 1
                offset = 0
                for doc, start, length in window:
                    doc_id, ids = held[doc]
                    yield (doc_id, start, length, len(ids), base + sequences, offset, context, open_step[context],
                           ids[start:start + length].tobytes())
                    offset += length
                sequences += 1

        def flush(held, rests):
            whole = ((top, [(i, s, top)]) for i, (_, ids) in enumerate(held) for s in range(0, len(ids) - top + 1, top))
            rows, size = [], 0
            for packed in (whole, pack_block(rests, tiers)):
                for row in rows_of(packed, held):
                    rows.append(row)
                    size += len(row[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        held, rests, tokens = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(enc, batch.column(1))):
                ids = np.concatenate((ids.astype("<u4"), np.array([end_id], "<u4")))
                if len(ids) % top:
                    rests.append((len(held), len(ids) - len(ids) % top, len(ids) % top))
                held.append((doc_id, ids))
                tokens += len(ids)
                if len(held) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    yield from flush(held, rests)
                    held, rests, tokens = [], [], 0
        if held:
            yield from flush(held, rests)

    return text_rows(docs).mapInArrow(pack, SCHEMA)
