"""Exact, cached tokenization with the public tokenizers library.

A document is cut at white space where no pre-token of the vocabulary can
cross the cut, so its ids are the ids of its segments one after the other.
Within a batch each different segment is looked up once; a worker remembers
segments it has seen (by 64-bit hash) in tables of bounded size, and unseen
ones go through the library: words of Latin letters with closing punctuation,
which are one pre-token each by either vocabulary's pattern, straight to its
BPE model, all others through its whole pipeline.  Texts with a segment whose
cut is not certain (runs of white space, other Unicode spaces, strings of
special tokens) are cut at certain places only.  Every text gets exactly the
ids of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re

import numpy as np

from stayrate.llm import spans

#: Segments and ids remembered per worker; beyond either, a worker starts anew.
CACHE_SEGMENTS = 1_800_000
CACHE_IDS = 9_000_000
CACHE_PIECES = 150_000
#: New segments wait in a table of their own until they are so many.
FRESH_SEGMENTS = 120_000

#: Text bytes tokenized at a time inside a task.
CHUNK_BYTES = 1 << 20
#: Rows per Arrow batch of the jobs that tokenize.
BATCH_ROWS = 1_000

#: Letters whose class, case and normal form no Unicode version changes.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")

_WORKER: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """The worker's encoder for one tokenizer file (kept across tasks)."""
    if path not in _WORKER:
        _WORKER[path] = CachedEncoder(path)
    return _WORKER[path]


def forget() -> None:
    """Drop the worker's encoders and what they remember."""
    _WORKER.clear()


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class CachedEncoder:
    """Ids of many texts at once, equal to the library's ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, decoders

        self.tok = Tokenizer.from_file(path)
        # With a byte-level decoder a pre-token begins with its space; the other
        # vocabulary drops white space and case.
        self.spaced = isinstance(self.tok.decoder, decoders.ByteLevel)
        self.marks = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.alphabet = _byte_alphabet()
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32  # of remembered ids
        self.pieces: dict[str, bytes] = {}
        self._reset()

    def _reset(self) -> None:
        # Sorted hashes of known segments and their slots: most of them, the newest.
        self.tables = [(np.empty(0, np.uint64), np.empty(0, np.int32))] * 2
        self.at = np.empty(0, np.int32)         # per slot: first id, number of ids
        self.n = np.empty(0, np.int32)          # -1: its cut is not certain
        self.flat = np.empty(0, self.kind)

    def direct(self, text: str) -> np.ndarray:
        """The library's own ids of a text."""
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_many(raw, np.array([0, len(raw)]))[0].tolist()

    def encode_many(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer, and each text's first id (n + 1 offsets)."""
        starts, ends, text, first = self._segments(data, offs)
        h = spans.span_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
        h[first] ^= np.uint64(0x5851F42D4C957F2D)
        uniq, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        slot = self._slots(uniq, where, data, starts, ends, first)[inverse]
        n = self.n[slot]
        unsure = np.unique(text[n < 0])
        if len(unsure):
            n = np.where(np.isin(text, unsure), 0, n)
        n = n.astype(np.int64)
        per_text = np.bincount(text, n, len(offs) - 1).astype(np.int64)
        own: dict[int, np.ndarray] = {}
        for t in unsure.tolist():
            own[t] = self._careful(data[offs[t]:offs[t + 1]].tobytes())
            per_text[t] = len(own[t])
        out_at = np.concatenate([[0], np.cumsum(per_text)])
        out = np.empty(out_at[-1], np.uint32)
        total = int(n.sum())
        if total:
            before = np.cumsum(n) - n
            take = np.repeat(self.at[slot].astype(np.int64) - before, n) + np.arange(total)
            if own:
                keep = np.ones(len(out), bool)
                for t, ids in own.items():
                    keep[out_at[t]:out_at[t + 1]] = False
                out[keep] = self.flat[take]
            else:
                out[:] = self.flat[take]
        for t, ids in own.items():
            out[out_at[t]:out_at[t + 1]] = ids
        return out, out_at

    def _segments(self, data, offs):
        """(starts, ends, text, is a text's first) of every segment."""
        if not self.spaced:
            starts, ends, text = spans.word_spans(data, offs)
            return starts, ends, text, np.zeros(len(starts), bool)
        some = np.flatnonzero(offs[1:] > offs[:-1])
        spaces = np.flatnonzero(data == 0x20)
        starts = np.concatenate([offs[some], spaces + 1])
        first = np.concatenate([np.ones(len(some), bool), np.zeros(len(spaces), bool)])
        ends = np.concatenate([offs[some + 1], spaces])
        order = np.argsort(starts, kind="stable")
        # A space that ends a text opens an empty segment of that text, so the
        # first segment of the next text follows it.
        text = np.concatenate([some, np.searchsorted(offs, spaces, "right") - 1])[order]
        order2 = np.lexsort((starts[order], text))
        starts, first, text = starts[order][order2], first[order][order2], text[order2]
        ends = np.sort(ends)
        return starts, ends, text, first

    def _slots(self, uniq, where, data, starts, ends, first):
        """Slot of each different segment, learning the unseen ones."""
        if len(self.n) > CACHE_SEGMENTS or len(self.flat) > CACHE_IDS:
            self._reset()
        slot = np.full(len(uniq), -1, np.int32)
        for keys, slots in self.tables:
            if len(keys):
                pos = np.minimum(np.searchsorted(keys, uniq), len(keys) - 1)
                slot = np.where(keys[pos] == uniq, slots[pos], slot)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            buf = data.tobytes()
            w = where[miss]
            learn, flat, n, width = self._learn, [], [], self.flat.itemsize
            for a, b, head in zip(starts[w].tolist(), ends[w].tolist(), first[w].tolist()):
                ids = learn(buf[a:b], head)
                if ids is None:
                    n.append(-1)
                else:
                    flat.append(ids)
                    n.append(len(ids) // width)
            n = np.array(n, np.int32)
            slot[miss] = np.arange(len(self.n), len(self.n) + len(miss), dtype=np.int32)
            held = np.maximum(n, 0)
            self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(held) - held).astype(np.int32)])
            self.n = np.concatenate([self.n, n])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(flat), self.kind)])
            self._remember(uniq[miss], slot[miss])
        return slot

    def _remember(self, keys, slots) -> None:
        """Add sorted keys to the newest table, and that to the other when it is large."""
        for k in (1, 0):
            have, at = self.tables[k]
            pos = np.searchsorted(have, keys)
            keys, slots = np.insert(have, pos, keys), np.insert(at, pos, slots)
            if k and len(keys) < FRESH_SEGMENTS:
                self.tables[1] = (keys, slots)
                return
        self.tables = [(keys, slots), (np.empty(0, np.uint64), np.empty(0, np.int32))]

    def _learn(self, raw: bytes, head: bool) -> bytes | None:
        """Ids of one unseen segment; None if its cut is not certain."""
        w = raw.decode("utf-8", "replace")
        known = self.pieces
        m = _SIMPLE.fullmatch(w)
        if m is not None:
            word, tail = m.groups()
            ids = self._word(word, self.spaced and not head)
            return ids + (known.get(tail) or self._piece(tail)) if tail else ids
        if self.spaced and "\n" in w:
            # A line feed between two visible characters is a pre-token of its own.
            ids = b""
            for k, part in enumerate(w.split("\n")):
                m = _SIMPLE.fullmatch(part)
                if m is None:
                    return self._learn_whole(w, head)
                word, tail = m.groups()
                if k:
                    ids += known.get(self.alphabet[10]) or self._piece(self.alphabet[10])
                ids += self._word(word, not k and not head)
                if tail:
                    ids += known.get(tail) or self._piece(tail)
            return ids
        return self._learn_whole(w, head)

    def _word(self, word: str, spaced: bool) -> bytes:
        """Ids of a pre-token of letters."""
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        if spaced:
            word = self.alphabet[32] + word
        return self.pieces.get(word) or self._piece(word)

    def _learn_whole(self, w: str, head: bool) -> bytes | None:
        if not self.spaced:
            return self.direct(w).astype(self.kind).tobytes()
        if not w or w[0].isspace() or w[-1].isspace() or "\ufffd" in w or any(x in w for x in self.marks):
            return None
        return self.direct(w if head else " " + w).astype(self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        if len(self.pieces) >= CACHE_PIECES:
            self.pieces.clear()
        ids = self.pieces[piece] = np.array([t.id for t in self.tok.model.tokenize(piece)], self.kind).tobytes()
        return ids

    def _careful(self, text: bytes) -> np.ndarray:
        """One text, cut only between two segments with certain edges."""
        out: list[np.ndarray] = []
        run: list[str] = []
        for s in text.decode("utf-8", "replace").split(" "):
            if run and self._certain(run[-1]) and self._certain(s):
                out.append(self.direct((" " if out else "") + " ".join(run)))
                run = []
            run.append(s)
        out.append(self.direct((" " if out else "") + " ".join(run)))
        return np.concatenate(out)

    @staticmethod
    def _certain(s: str) -> bool:
        return bool(s) and not s[0].isspace() and not s[-1].isspace()
