"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memo of pieces.

A text is cut where the tokenizer's own pre-tokenisation always cuts, each distinct piece is encoded once by the
library and its ids are kept; a text's ids are the joined ids of its pieces. Texts with characters for which the
cut isn't certain (apostrophes, letters beyond Latin-1, odd white space) are encoded whole, so results always equal
the library's. Where a vocabulary's ids are the ranks of its merges, the tiktoken library encodes faster: whole texts of visible
Latin-1 for byte-level vocabularies, new words for the lower-case one. So are texts that hold the string of an added token (such as an end mark), in either case of letters:
the library gives its id, as in a plain ``encode``. A ``TextEncoder`` made with ``special=False`` takes special tokens
inside a text as ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from metrolens.llm.common import process_cache, ship

ship(__name__)

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
OTHERS = "!-&(-@[-`{-~"  # visible ASCII but letters and the apostrophe
#: Fixed value: the split pattern of the lower-case word vocabulary.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Fixed value: the split pattern of byte-level vocabularies.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept per worker and tokenizer; beyond it the memo starts anew. About 250 bytes each.
MEMO_PIECES = 800_000
LEARN_PIECES = 4096  # encoded together
PORTION = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(spec: dict, vocab: dict[str, int], split: str, end: str = ""):
    """The tiktoken library's encoder of a byte-level vocabulary whose ids are the ranks of its merges, else None. If a word's last letter
    bears the mark ``end``, the byte 0 stands for it: its merges with a letter come before all others."""
    import tiktoken

    letters = byte_letters()
    merges = [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]
    names = [*letters, *(x + end for x in letters if end)]
    ids = {vocab.get(x, -1) for x in names}
    if ids != set(range(len(names))) or any(vocab.get(x + y) != i for i, (x, y) in enumerate(merges, len(names))):
        return None
    names += [x + y for x, y in merges]
    spelled = lambda x: bytes(map(letters.__getitem__, x.removesuffix(end))) + (b"\0" if end and x.endswith(end) else b"")
    return tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks={spelled(x): vocab[x] for x in names}, special_tokens={})


class _Memo(dict):
    """piece -> its ids as bytes; a missing piece is encoded and kept."""

    def __init__(self, encode, dtype, cap):
        self.encode, self.dtype, self.cap = encode, dtype, cap

    def __missing__(self, piece):
        ids = np.array(self.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()
        if len(self) >= self.cap:
            self.clear()
        self[piece] = ids
        return ids


class TextEncoder:
    """``ids(text)``: the text's token ids as a little-endian array (16 bits if the vocabulary fits, else 32)."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.memo = _Memo(self.tok.encode, self.dtype, memo_pieces)
        spec = json.loads(self.tok.to_str())
        added = [re.escape(t["content"]) for t in spec.get("added_tokens") or [] if special or not t["special"]]
        self.spelled = None
        self.marked = re.compile("|".join(added), re.IGNORECASE).search if added else lambda text: None
        # What a marked text holds for certain: the first two characters of each added token, where none has two cases.
        starts = {x["content"][:2] for x in spec.get("added_tokens") or [] if special or not x["special"]}
        self.starts = starts if all(x.upper() == x.lower() for x in starts) else {""}
        kind = self._kind(spec)
        self.lower = kind == "words"
        self.ranks, self.fits = None, lambda text: False
        if kind == "words":  # lower-cases, drops white space
            self.find = re.compile(f"[{LETTERS}]+|[{OTHERS}]+").findall
            self.odd = re.compile(f"[^{LETTERS}{OTHERS} \n\t]").search
            self.ranks = rank_encoder(spec, self.tok.get_vocab(), r"[^\x00]+\x00", "</w>")
        elif kind == "spaced":  # a space belongs to the piece after it
            self.find = re.compile(f" ?[{LETTERS}]+| ?[{OTHERS}]+|\n").findall
            self.odd = re.compile(f"[^{LETTERS}{OTHERS} \n]|[ \n][ \n]|[ \n]\\Z").search
            self.ranks = rank_encoder(spec, self.tok.get_vocab(), BYTE_SPLIT)
            strange = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]").search  # beyond it the libraries' classes of characters may differ
            self.fits = lambda text: self.ranks is not None and not strange(text)
        else:
            self.find, self.odd = None, lambda text: True

    @staticmethod
    def _kind(spec: dict) -> str:
        """``words`` or ``spaced`` if the tokenizer cuts texts in one of the two known ways, else ``whole``."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "spaced"
        steps = [x.get("type") for x in pre.get("pretokenizers", [])]
        cleans = [x.get("type") for x in norm.get("normalizers", [])]
        patterns = [x.get("pattern", {}).get("Regex") for x in pre.get("pretokenizers", []) if x.get("type") == "Split"]
        if steps == ["Split", "ByteLevel"] and cleans == ["NFC", "Replace", "Lowercase"] and patterns == [WORD_SPLIT]:
            return "words"
        return "whole"

    def holds_added(self, text: str) -> bool:
        return any(x in text for x in self.starts) and self.marked(text) is not None

    def ids(self, text: str) -> np.ndarray:
        return self.all_ids([text])[0]

    def all_ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; pieces that the memo lacks are encoded together."""
        out, cut = [None] * len(texts), {}
        for k, text in enumerate(texts):
            if self.holds_added(text):
                out[k] = np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)
            elif self.fits(text):
                out[k] = np.array(self.ranks.encode_ordinary(text), self.dtype)
            elif self.odd(text):
                out[k] = np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)
            else:
                cut[k] = self.find(text.lower() if self.lower else text)
        if cut:
            self.learn(list({p for pieces in cut.values() for p in pieces if p not in self.memo}))
        for k, pieces in cut.items():
            out[k] = np.frombuffer(b"".join(map(self.memo.__getitem__, pieces)), self.dtype)
        return out

    def together(self, pieces: list[str], mark: str) -> np.ndarray:
        """The ids of ``pieces`` in order. Pieces of letters alone are words to both libraries."""
        if self.lower and self.ranks is not None and "".join(pieces).isalpha():
            return np.array(self.ranks.encode_ordinary("\0".join((*pieces, ""))), np.int64)
        return np.array(self.tok.encode_batch_fast([mark.join((*pieces, ""))], add_special_tokens=False)[0].ids, np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Keeps the ids of ``pieces``, encoded as one text in which a separator that the tokenizer always cuts at stands behind
        each; the numbers of bytes tell where a piece ends. Without a clean cut the pieces are left to the memo."""
        if self.spelled is None:
            self.spelled = np.zeros(self.tok.get_vocab_size(), np.int64)  # bytes of each id; a byte is a character of its name
            for name, i in self.tok.get_vocab().items():
                self.spelled[i] = len(name.removesuffix("</w>")) if self.lower else len(name)
        mark = " " if self.lower else "\n"
        pieces = sorted((p for p in pieces if p != mark), key=str.isalpha)
        for at in range(0, len(pieces), LEARN_PIECES):
            some = pieces[at:at + LEARN_PIECES]
            if len(self.memo) + len(some) > self.memo.cap:
                self.memo.clear()
            ids = self.together(some, mark)
            ends = np.cumsum([(len(p) if p.isascii() else len(p.encode())) + (not self.lower) for p in some])
            reached = np.cumsum(self.spelled[ids])
            cuts = np.searchsorted(reached, ends)
            if len(reached) and reached[-1] == ends[-1] and (reached[cuts] == ends).all():
                small = ids.astype(self.dtype)
                for p, lo, hi in zip(some, (0, *(cuts[:-1] + 1)), cuts + self.lower):
                    self.memo[p] = small[lo:hi].tobytes()


def encoder(path: str, special: bool = True) -> TextEncoder:
    """This worker's encoder for the tokenizer file ``path``."""
    cache = process_cache("encoders")
    if (path, special) not in cache:
        cache[path, special] = TextEncoder(path, special=special)
    return cache[path, special]


def encoded(enc: TextEncoder, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text of an Arrow column, worked on in portions of PORTION characters or more."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= PORTION:
            yield from enc.all_ids(held)
            held, size = [], 0
    yield from enc.all_ids(held)
