"""Alignment of two tokenizers by lockstep vectorised merging.

Method: both tokenizers spell the same bytes (a space and the text), so their tokens are two cuts of one line. For a portion of documents
one state vector holds a pointer into the A tokens and one into the B tokens of every lane; in each step all lanes
link the tokens they point at, mark a cut where both end at the same byte, and move the pointers whose token ends first. Lanes that are through
leave the vector. A lane is a document, or LANE tokens of a long one (its first B token is the one that holds its
first byte), so one long document costs no long run of steps with a single lane.

A: a byte-level BPE of the tokenizers library, its tokens decoded byte by byte. B: a sentencepiece model with byte fallback: U+2581 is a space,
<0xHH> a byte. Special tokens inside texts are plain text to both. A text without tokens of its own: null, empty, or one whose joined A or B
bytes differ from a space and the text (a U+2581 in it, say).

Counts of the whole corpus (in how many rows an id pair is linked): the pairs of a chunk of documents are counted first, so a chunk
sends each pair once; the counts come back to the chunk by a join on the pair, which adaptive execution may split where a pair is in many
chunks. A chunk's pairs are bounded by its tokens (CHUNK characters, or one longer text). Nothing is broadcast.

A null doc_id is kept; rows repeating a doc_id are counted each. An empty table gives an empty result. Other columns are
ignored. Very long texts are aligned whole, in the memory of one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import process_cache, settled, ship, text_rows
from metrolens.llm.tokens import byte_letters, encoder

ship(__name__)

WORDS = re.compile(" +[^ ]*").findall
MEMO_WORDS = 600_000  # kept per worker, about 200 bytes each
LANE = 256  # A tokens
CHUNK = 2 << 20  # characters


class Spelling:
    """Ids of texts and the bytes of each id, of both tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = encoder(a_path, special=False)
        letters = byte_letters()
        names = self.a.tok.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(map(letters.__getitem__, name)) if all(c in letters for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self.piece(i) for i in range(self.b.vocab_size())]
        # No piece holds a space behind another character: words (with the spaces before them) are then merged apart.
        self.by_word = b" " in self.b_bytes and not any(b" " in name.lstrip(b" ") for name in self.b_bytes)
        self.memo: dict[str, bytes] = {}
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        written = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        wide = max(map(len, written)) + 1  # of each id: its decimal digits, with room for a mark, and their number
        self.decimals = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in written), np.uint8).reshape(-1, wide), np.array(list(map(len, written)))

    def piece(self, i: int) -> bytes:
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def a_ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = iter(self.a.all_ids([" " + t for t in texts if t]))
        return [next(whole).astype(np.int64) if t else np.empty(0, np.int64) for t in texts]

    def b_ids(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        words = [WORDS(" " + t) if t and "▁" not in t else [] for t in texts]
        new = {w for x in words for w in x if w not in self.memo}
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = {w for x in words for w in x}
        new = list(new - {" "})
        self.memo[" "] = np.array([self.b.piece_to_id("▁")], "<u4").tobytes()  # a lone space at the end
        self.memo.update(zip(new, (np.array(x, "<u4").tobytes() for x in self.b.encode([w[1:] for w in new], num_threads=1))))
        return [np.frombuffer(b"".join(map(self.memo.__getitem__, x)), "<u4").astype(np.int64) for x in words]

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A and B ids of each text; none where the spelling differs from a space and the text."""
        a, b = self.a_ids(texts), self.b_ids(texts)
        for k, text in enumerate(texts):
            line = b" " + text.encode("utf-8", "surrogatepass")
            if not text or any(b"".join(map(names.__getitem__, x.tolist())) != line for names, x in ((self.a_bytes, a[k]), (self.b_bytes, b[k]))):
                a[k] = b[k] = np.empty(0, np.int64)
        return a, b


def spelling(a_path: str, b_path: str) -> Spelling:
    cache = process_cache("spellings")
    if (a_path, b_path) not in cache:
        cache[a_path, b_path] = Spelling(a_path, b_path)
    return cache[a_path, b_path]


def merge(a_end: np.ndarray, b_end: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and, per link, whether both end there, of lanes of A tokens [start, end).

    ``a_end``, ``b_end``: bytes up to the end of each token, over all documents of the portion one after another.
    """
    i, stop = starts.copy(), ends
    first = np.where(i > 0, a_end[i - 1], 0)
    j = np.searchsorted(b_end, first, "right")
    links: list[tuple] = []
    while len(i):
        a, b = a_end[i], b_end[j]
        links.append((i, j, a == b))
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():  # finished lanes leave
            i, j, stop = i[live], j[live], stop[live]
    return tuple(np.concatenate(x) for x in zip(*links)) if links else (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)


class Portion:
    """The alignment of some texts: tokens one after another, links and cuts in order of the text."""

    def __init__(self, spell: Spelling, texts: list[str]):
        a, b = spell.ids(texts)
        self.decimals = spell.decimals
        self.n_a, self.n_b = (np.array([len(x) for x in y], np.int64) for y in (a, b))
        self.a, self.b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        self.a_at, self.b_at = (np.append(0, np.cumsum(n)) for n in (self.n_a, self.n_b))
        a_end, b_end = np.cumsum(spell.a_size[self.a]), np.cumsum(spell.b_size[self.b])
        starts = np.concatenate([np.arange(lo, hi, LANE) for lo, hi in zip(self.a_at, self.a_at[1:])] or [np.empty(0, np.int64)]).astype(np.int64)
        ends = np.minimum(starts + LANE, self.a_at[np.searchsorted(self.a_at, starts, "right")]) if len(starts) else starts
        i, j, cut = merge(a_end, b_end, starts, ends)
        order = np.lexsort((j, i))
        self.link_a, self.link_b = i[order], j[order]
        cut = cut[order]
        self.cut_a, self.cut_b = self.link_a[cut], self.link_b[cut]  # last tokens of the groups
        self.doc_of_link = np.searchsorted(self.a_at, self.link_a, "right") - 1
        self.n_links = np.bincount(self.doc_of_link, minlength=len(texts))
        self.n_groups = np.bincount(np.searchsorted(self.a_at, self.cut_a, "right") - 1, minlength=len(texts))

    def written(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: the groups in decimal ids."""
        a_group, b_group = (np.searchsorted(cut, np.arange(n), "left") for cut, n in ((self.cut_a, len(self.a)), (self.cut_b, len(self.b))))
        total = len(self.a) + len(self.b)
        a_to = np.arange(len(self.a)) + np.append(-1, self.cut_b)[a_group] + 1  # behind the B tokens of earlier groups
        b_to = np.arange(len(self.b)) + self.cut_a[b_group] + 1  # and behind the A tokens of the group
        ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[a_to], ids[b_to] = self.a, self.b
        mark[a_to[self.cut_a]], mark[b_to[self.cut_b]] = ord("|"), ord(";")
        digits, size = self.decimals
        rows, size = digits[ids], size[ids]
        rows[np.arange(total), size] = mark
        flat = rows[np.arange(rows.shape[1]) <= size[:, None]]
        at = np.append(0, np.cumsum(size + 1))[self.a_at + self.b_at]
        return [flat[lo:max(lo, hi - 1)].tobytes() for lo, hi in zip(at, at[1:])]


def portions(batches: Iterator[pa.RecordBatch], spell: Spelling) -> Iterator[tuple[list, Portion]]:
    """(doc_ids, alignment) of CHUNK characters of texts or, at a batch's end, less."""
    for batch in batches:
        names, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            names.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= CHUNK:
                yield names, Portion(spell, texts)
                names, texts, size = [], [], 0
        if names:
            yield names, Portion(spell, texts)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, a_ids, b_ids, the links as positions (link_a, link_b) and the groups by the
    positions of their last tokens (cut_a, cut_b); all array<int>."""
    names = ["a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = spelling(a_path, b_path)
        for ids, p in portions(batches, spell):
            lo_a, lo_b = p.a_at[:-1], p.b_at[:-1]
            links, cuts = (np.append(0, np.cumsum(n)) for n in (p.n_links, p.n_groups))
            columns = [(p.a, p.a_at, None), (p.b, p.b_at, None), (p.link_a, links, lo_a), (p.link_b, links, lo_b), (p.cut_a, cuts, lo_a), (p.cut_b, cuts, lo_b)]
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x if lo is None else x - np.repeat(lo, np.diff(at)), pa.int32()))
                     for x, at, lo in columns]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *lists], ["doc_id", *names])

    return text_rows(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def aligned_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum long, groups_sha256."""
    schema = ("chunk long, doc_ids array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, digests array<string>, "
              "pairs array<long>, docs array<int>, per_doc array<int>, which binary, times binary")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, chunk = spelling(a_path, b_path), TaskContext.get().partitionId() << 32
        for names, p in portions(batches, spell):
            digests = [hashlib.sha256(w).hexdigest() if n else "" for w, n in zip(p.written(), p.n_a)]
            pair = p.a[p.link_a] << 32 | p.b[p.link_b]
            pairs, which = np.unique(pair, return_inverse=True)
            both, times = np.unique(p.doc_of_link * max(1, len(pairs)) + which, return_counts=True)  # the pairs of each document
            doc, which = np.divmod(both, max(1, len(pairs)))
            row = [chunk, names, p.n_a, p.n_b, p.n_groups, p.n_links, digests, pairs, np.bincount(which, minlength=len(pairs)), np.bincount(doc, minlength=len(names))]
            lists = [pa.array([row[0]], pa.int64())]
            lists += [pa.array([x if isinstance(x, list) else x.tolist()], t) for x, t in zip(row[1:], [pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 4 + [
                pa.list_(pa.string()), pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 2)]
            lists += [pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (which, times)]
            yield pa.RecordBatch.from_arrays(lists, [c.split()[0] for c in schema.split(", ")])
            chunk += 1

    chunks = settled(text_rows(docs).mapInArrow(first, schema))
    seen = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("pos", "x")).select("chunk", "pos", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = settled(seen.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 32)))
    highest = counts.groupBy("a").agg(F.max("count").alias("most"))
    known = counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = seen.select("chunk", "pos", "pair").join(known, "pair").groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "count", "best"))).alias("known"))  # the pairs of one chunk
    told = chunks.drop("pairs", "docs").join(back.select("chunk", F.col("known.count").alias("count"), F.col("known.best").alias("best")), "chunk", "left")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                col = lambda c: batch.column(batch.schema.get_field_index(c))[at]  # noqa: E731, B023
                flat = lambda c: col(c).values.to_numpy(zero_copy_only=False) if col(c).is_valid else np.empty(0, np.int64)  # noqa: E731, B023
                which, times = (np.frombuffer(col(c).as_py(), "<u4").astype(np.int64) for c in ("which", "times"))
                doc = np.repeat(np.arange(len(flat("per_doc"))), flat("per_doc"))
                n = len(flat("doc_ids")) if col("doc_ids").is_valid else 0
                sums = np.zeros(n, np.int64)
                best = np.zeros(n, np.int64)
                if len(which):
                    np.add.at(sums, doc, times * flat("count")[which])
                    np.add.at(best, doc, times * flat("best")[which])
                yield pa.RecordBatch.from_arrays(
                    [col("doc_ids").values, *(col(c).values.cast(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(best), pa.array(sums),
                     col("digests").values], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return told.mapInArrow(last, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
