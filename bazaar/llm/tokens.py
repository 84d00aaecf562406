"""Token ids of whole texts by the tokenizers library, with a memo of text pieces.

Byte-level BPE never merges across the borders of its pre-tokenizer's pieces.
Texts are therefore cut at places that are borders whatever stands around them
(a single space between two other characters, a single line break, the end of a
run of letters before ASCII punctuation), equal pieces of a batch are encoded
once, and a bounded memo keeps pieces for the next batches.  Texts with Unicode
white space, or with the literal of a token that the tokenizer adds to its
vocabulary (such as ``<|endoftext|>``, which it takes before it cuts pieces), are
encoded whole.  The ids are those of encoding every whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from . import words

MEMO_PIECES = 300_000    # per generation; two generations are kept
LONG_PIECE = 96          # bytes; longer pieces are not kept
STEP_BYTES = 4 << 20
ENCODED_AT_ONCE = 4096   # pieces; the library's encodings are some hundred times a piece

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
#: UTF-8 of the white space beyond ASCII in the Unicode standard.
UNICODE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\x80", b"\xe2\x80\x81", b"\xe2\x80\x82",
                  b"\xe2\x80\x83", b"\xe2\x80\x84", b"\xe2\x80\x85", b"\xe2\x80\x86", b"\xe2\x80\x87", b"\xe2\x80\x88",
                  b"\xe2\x80\x89", b"\xe2\x80\x8a", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f",
                  b"\xe3\x80\x80"]
_LEADS = np.zeros(256, bool)
_LEADS[[s[0] for s in UNICODE_SPACES]] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Safe places to cut, document starts included (empty documents have none)."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[offsets[:-1]] = True
    if n >= 3:
        inner = np.ones(n, bool)                     # neither first nor last byte of its document
        inner[offsets[:-1][offsets[:-1] < n]] = False
        inner[offsets[1:][offsets[1:] > 0] - 1] = False
        ws = _WS[data]
        alone = ws & inner
        alone[1:-1] &= ~ws[:-2] & ~ws[2:]
        start[:n] |= alone
        start[1:n] |= (alone & (data != 32))[:-1]    # a line break or tab is a piece of its own
        letter = _LETTER[data]
        latin = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        letter[1:] |= latin
        start[1:n] |= letter[:-1] & _PUNCT[data[1:]]
    start[n] = False
    return np.flatnonzero(start)


def holders(raw: bytes, offsets: np.ndarray, literals: list[bytes]) -> np.ndarray:
    """Documents in which one of ``literals`` begins."""
    at = [m.start() for x in literals for m in re.finditer(re.escape(x), raw)]
    return np.unique(np.searchsorted(offsets, np.array(at, np.int64), "right") - 1)


def odd_documents(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents with white space beyond ASCII."""
    at = np.flatnonzero(_LEADS[data])
    if not len(at):
        return at
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    code = padded[at].astype(np.int64) << 16 | padded[at + 1].astype(np.int64) << 8 | padded[at + 2]
    hit = np.zeros(len(at), bool)
    for s in UNICODE_SPACES:
        v = int.from_bytes(s.ljust(3, b"\0"), "big")
        hit |= (code >> 8 == v >> 8) if len(s) == 2 else (code == v)
    return np.unique(np.searchsorted(offsets, at[hit], "right") - 1)


class Encoder:
    """Encodes batches of texts; lives as long as its Python worker."""

    def __init__(self, path: str, memo_pieces: int | None = None):
        self.memo_pieces = memo_pieces or MEMO_PIECES
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.fresh: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at:at + ENCODED_AT_ONCE], add_special_tokens=False)
            out.extend(np.array(e.ids, "<u4").tobytes() for e in found)
        return out

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list = [self.fresh.get(p) for p in pieces]
        for i, ids in enumerate(out):
            if ids is None and (ids := self.old.get(pieces[i])) is not None:
                out[i] = self.fresh[pieces[i]] = ids
        missing = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(missing, self._ids([pieces[i].decode() for i in missing])):
            out[i] = ids
            if len(pieces[i]) <= LONG_PIECE:
                self.fresh[pieces[i]] = ids
        if len(self.fresh) >= self.memo_pieces:
            self.old, self.fresh = self.fresh, {}
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents as uint32, document offsets into them)."""
        n_docs = len(offsets) - 1
        raw = data.tobytes()
        odd = np.union1d(odd_documents(data, offsets), holders(raw, offsets, self.added))
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(offsets, starts, "right") - 1
        if len(odd):
            plain = ~np.isin(doc, odd)
            starts, ends, doc = starts[plain], ends[plain], doc[plain]
        h = words.hash_spans(data, starts, ends)
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        found = self._pieces([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        pool = np.frombuffer(b"".join(found), "<u4")
        length = np.array([len(x) for x in found], np.int64) // 4
        begin = np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else length
        n = length[inverse]
        at = np.concatenate(([0], np.cumsum(n)))
        ids = pool[np.repeat(begin[inverse] - at[:-1], n) + np.arange(at[-1])]
        per_doc = np.bincount(doc, weights=n, minlength=n_docs).astype(np.int64)
        bounds = np.concatenate(([0], np.cumsum(per_doc)))
        if len(odd):
            parts = [ids[bounds[d]:bounds[d + 1]] for d in range(n_docs)]
            for d, x in zip(odd, self._ids([raw[offsets[d]:offsets[d + 1]].decode() for d in odd])):
                parts[d] = np.frombuffer(x, "<u4")
            ids = np.concatenate(parts)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, bounds


_encoders: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, memo_pieces: int | None = None) -> Encoder:
    """The encoder of this Python worker for the tokenizer file at ``path``."""
    if (path, memo_pieces) not in _encoders:
        _encoders[path, memo_pieces] = Encoder(path, memo_pieces)
    return _encoders[path, memo_pieces]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
