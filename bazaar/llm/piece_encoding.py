"""SentencePiece encoding of merge-type (BPE) vocabularies, and decoding.

A text is normalised by the model's own rules and split into symbols, one per code
point.  An agenda holds every adjacent pair of symbols whose joined string is a
piece, the best score first and of equal scores the leftmost.  The top pair is
merged, pairs that it made stale are passed over, and the new neighbours' pairs are
added, until the agenda is empty.  New words of a batch run side by side: a row of a
matrix is a word's agenda, and the best pairs of all rows are merged at once; a word
of more than ``LONG_WORD`` code points has a heap of its own.  Symbols that are no piece become byte pieces, or
the unknown piece in a vocabulary without them.

Merges never cross a place between two characters that no piece holds side by side.
If no piece has a space mark after another character, texts are cut before every run
of space marks, around ASCII characters that stand in no longer piece, and before
marks that no piece holds behind a letter; equal words then share one agenda, and a bounded memo of two generations keeps their ids.  A new
word is cut further wherever no piece holds the two characters.  The ids are those of
encoding the whole text.

In every Arrow batch the agenda is checked against the library: all words that it
encoded anew, joined to one text, must get the same ids from both, and every decoded
text must equal the text.  ``whole_check`` compares the ids of every whole text
instead, which is also done for models that don't cut by words.  A difference raises
an error, so that a model of another type (unigram, user-defined symbols) is never
encoded wrongly.  Decoding is the library's.

Defined cases: null text is empty text, without ids, and decodes to the empty string;
equal rows give equal rows; ids (null or repeated) are passed through; further
columns are ignored; an empty table gives no rows; texts of any length are whole, a
batch is cut into steps of about ``STEP_BYTES`` of whole texts.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
MEMO_WORDS = 300_000     # per generation; two generations are kept
LONG_WORD = 64           # code points; longer words are not kept
STEP_BYTES = 2 << 20     # text of a step; a longer text is a step of its own
CHECK_WORDS = 500        # words that are checked as one text
NONE = np.iinfo(np.int32).max


class PieceEncoder:
    """Encodes texts by the agenda; lives as long as its Python worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        lib = self.library
        size = lib.get_piece_size()
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        special = [i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)]
        usable = sorted(set(range(size)) - set(special))
        self.id_of = {lib.id_to_piece(i): i for i in usable}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in usable}
        self.unknown = lib.unk_id()
        self.byte_id = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = any(lib.is_byte(i) for i in special)
        #: place of a piece in the order of scores; equal scores share it
        order = {x: k for k, x in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = {p: order[x] for p, x in self.score.items()}
        #: pairs of characters that stand side by side in some piece
        self.joined = {p[k:k + 2] for p in self.id_of for k in range(len(p) - 1)}
        inside = {c for pair in self.joined for c in pair}
        self.by_word = (self.has_bytes and "\n" not in inside and not any(p[1] == SPACE != p[0] for p in self.joined)
                        and lib.normalize(" a  b ") == f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}")
        # marks: characters beside letters and digits.  A text without the few others that
        # stand before a mark in some piece is also cut before every run of marks
        marks = {c for c in inside if not c.isalnum()} - {SPACE}
        before = {p[0] for p in self.joined if p[1] in marks and p[0] not in marks} - {SPACE}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        mark = "".join(map(re.escape, sorted(marks)))
        rest = f"[^{SPACE}{alone}{mark}]"
        self.coarse = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]+")
        self.words = re.compile("|".join([f"{SPACE}+[{mark}]*{rest}*", f"{rest}+", f"[{mark}]+{rest}*", f"[{alone}]+"]))
        self.joins_mark = re.compile("[" + "".join(map(re.escape, sorted(before))) + "]") if before else None
        if not marks or any(c.isascii() for c in before):
            self.words = self.coarse
        self._pair_table()
        self.fresh: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.new: dict[str, tuple[int, ...]] = {}      # words encoded since the last check

    def merge(self, word: str) -> list[str]:
        """The symbols that remain of ``word`` when its agenda is empty."""
        n, rank = len(word), self.rank.get
        symbols: list[str] = list(word)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # an entry is rank * n + left: the least rank comes first, then the leftmost
        agenda = [r * n + i for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            best, left = divmod(heapq.heappop(agenda), n)
            right = after[left]
            if right >= n or not symbols[left] or rank(symbols[left] + symbols[right]) != best:
                continue                       # the pair is no more
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                if (r := rank(symbols[left] + symbols[right])) is not None:
                    heapq.heappush(agenda, r * n + left)
            at = before[left]
            if at >= 0 and (r := rank(symbols[at] + symbols[left])) is not None:
                heapq.heappush(agenda, r * n + at)
        return [s for s in symbols if s]

    def ids(self, word: str) -> list[int]:
        out: list[int] = []
        for symbol in self.merge(word):
            found = self.id_of.get(symbol)
            if found is not None:
                out.append(found)
            elif self.has_bytes:
                out.extend([self.byte_id[b] for b in symbol.encode()])
            elif not out or out[-1] != self.unknown:     # neighbours share one unknown piece
                out.append(self.unknown)
        return out

    def _pair_table(self):
        """A table, addressed by hash, of all pairs of symbols that join to a piece, with
        rank and piece.  A symbol is the id of its piece; a character without one is
        ``size + code point``."""
        size = self.library.get_piece_size()
        wide = size + 0x110000
        symbol = lambda x: self.id_of.get(x, size + ord(x) if len(x) == 1 else None)
        pairs = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = symbol(p[:k]), symbol(p[k:])
                if a is not None and b is not None:
                    pairs[a * wide + b] = (self.rank[p], i)
        self.size, self.wide = size, wide
        keys = np.array(list(pairs), np.int64)
        bits = max(10, (4 * len(keys)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64)
        self.pair_rank, self.pair_piece = np.full(1 << bits, NONE, np.int32), np.zeros(1 << bits, np.int32)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):                       # of the keys that want a free slot one gets it
            free = np.flatnonzero(self.slots[at[left]] < 0)
            slot, first = np.unique(at[left[free]], return_index=True)
            self.slots[slot] = keys[left[free[first]]]
            left = np.delete(left, free[first])
            at[left] = (at[left] + 1) & ((1 << bits) - 1)
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self.pair_rank[at], self.pair_piece[at] = values[:, 0], values[:, 1]
        self.symbol = np.arange(size, wide, dtype=np.int32)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of joining the symbols; rank ``NONE`` where they don't join."""
        key = (a.astype(np.int64) * self.wide + b).ravel()
        at = self._home(key)
        there = self.slots[at]
        on = np.flatnonzero((there != key) & (there >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (len(self.slots) - 1)
            there[on] = now = self.slots[at[on]]
            on = on[(now != key[on]) & (now >= 0)]
        rank = np.where((there == key) & (b.ravel() >= 0), self.pair_rank[at], NONE)
        return rank.reshape(a.shape), self.pair_piece[at].reshape(a.shape)

    def _side_by_side(self, words: list[str]) -> list[list[int]]:
        """Symbols that remain of every word when all agendas are empty."""
        n, lengths = len(words), np.array([len(w) for w in words])
        width = int(lengths.max())
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sym = np.full((n, width + 1), -1, np.int32)           # -1 behind the end
        sym[np.arange(width + 1) < lengths[:, None]] = self.symbol[codes]
        out: list[list[int]] = [[]] * n
        row = np.arange(n)
        rank, piece = self._ranks(sym[:, :-1], sym[:, 1:])
        column = np.arange(width + 1)
        while True:
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            open_ = rank[np.arange(len(row)), best] < NONE if rank.shape[1] else np.zeros(len(row), bool)
            for r, symbols, m in zip(row[~open_].tolist(), sym[~open_].tolist(), (sym[~open_] >= 0).sum(axis=1).tolist()):
                out[r] = symbols[:m]
            if not open_.any():
                return out
            row, sym, rank, piece, best = row[open_], sym[open_], rank[open_], piece[open_], best[open_]
            line = np.arange(len(row))
            sym[line, best] = piece[line, best]
            # the right partner goes: what stands behind it moves up
            keep = np.minimum(column + (column > best[:, None]), width)
            sym = np.take_along_axis(sym, keep, 1)
            keep = np.minimum(keep[:, :-1], width - 1)
            rank, piece = np.take_along_axis(rank, keep, 1), np.take_along_axis(piece, keep, 1)
            rank[:, -1] = NONE
            for at in (best - 1, best):
                ok = at >= 0
                rank[line[ok], at[ok]], piece[line[ok], at[ok]] = self._ranks(sym[line[ok], at[ok]], sym[line[ok], at[ok] + 1])

    def _parts(self, word: str) -> list[str]:
        """``word`` cut where no piece holds the two characters side by side."""
        joined = self.joined
        cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def _spelled(self, symbols: list[int]) -> list[int]:
        """Ids of symbols: characters without a piece become bytes."""
        if max(symbols) < self.size:
            return symbols
        return [i for s in symbols for i in ([s] if s < self.size else [self.byte_id[b] for b in chr(s - self.size).encode()])]

    def _encode_new(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        found: dict[str, tuple[int, ...]] = {}   # tuples of numbers are no work for the garbage collector
        groups: list[list[str]] = [[] for _ in range(LONG_WORD // 8)]
        for w in words:
            if len(w) > LONG_WORD:
                found[w] = tuple(chain.from_iterable(map(self.ids, self._parts(w))))
            else:
                groups[(len(w) - 1) // 8].append(w)
        for group in filter(None, groups):
            found.update(zip(group, map(tuple, map(self._spelled, self._side_by_side(group)))))
        self.new.update(found)
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        normal = self.library.normalize(texts)
        if not self.by_word:
            return [self.ids(t) if t else [] for t in normal]
        joins = self.joins_mark
        words = [(self.coarse if joins and joins.search(t) else self.words).findall(t) for t in normal]
        fresh, old = self.fresh, self.old
        new = []
        for w in set(chain.from_iterable(words)) - fresh.keys():
            entry = old.get(w)
            if entry is None:
                new.append(w)
            else:
                fresh[w] = entry
        fresh.update(self._encode_new(new))
        ids = [list(chain.from_iterable([fresh[w] for w in t])) for t in words]
        if len(fresh) >= MEMO_WORDS:
            self.old, self.fresh = {w: e for w, e in fresh.items() if len(w) <= LONG_WORD}, {}
        return ids

    def check(self, texts: list[str], ids: list[list[int]], decoded: list[str], whole: bool):
        """Compares what was encoded since the last check with the library."""
        new, self.new = self.new, {}
        if whole or not self.by_word:
            same = ids == self.library.encode(texts, add_bos=False, add_eos=False, enable_sampling=False, num_threads=1)
        else:
            # texts of new words: each after a line break if it has no space mark to part
            # it from the one before, or might take one from the one behind
            line, space = self.ids("\n"), self.ids(SPACE)
            listed, text, want = list(new), [], []
            for at in range(0, len(listed), CHECK_WORDS):
                some = listed[at:at + CHECK_WORDS]
                inner = [w for w in some if w[0] != SPACE or w[-1] == SPACE]
                outer = [w for w in some if w[0] == SPACE != w[-1]]
                text.append("\n".join(["", *inner, "".join(outer)]).replace(SPACE, " "))
                one = [space, line, *[x for w in inner for x in (new[w], line)], *[new[w] for w in outer]]
                want.append(list(chain.from_iterable(one)))
            same = (self.library.encode(text, add_bos=False, add_eos=False, enable_sampling=False, num_threads=1) == want
                    and decoded == [t.replace(SPACE, " ") for t in texts])
        if not same:
            raise ValueError("the agenda's ids differ from the sentencepiece library's; is the model of type BPE?")


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker for the model file at ``path``."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _steps(batches: Iterator[pa.RecordBatch], path: str, whole_check: bool = False):
    """(column of ids, ids of every text, decoded texts) a step, after the comparison
    with the library."""
    enc = encoder(path)
    for batch in batches:
        column = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        for first, end, _, _ in common.text_steps(column, STEP_BYTES):
            texts = column.slice(first, end - first).to_pylist()
            ids = enc.encode(texts)
            decoded = enc.library.decode(ids, num_threads=1)
            enc.check(texts, ids, decoded, whole_check)
            yield batch.column(0).slice(first, end - first), ids, decoded


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  whole_check: bool = False) -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text."""
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column, ids, decoded in _steps(batches, path, whole_check):
            yield pa.RecordBatch.from_arrays([column, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                                             names=[id_col, "ids", "decoded"])

    base = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, f"`{id_col}` long, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  whole_check: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of ``encode_pieces``, taken
    where the ids are made, so that only they leave the task."""
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = [str(i) for i in range(encoder(path).size)].__getitem__
        for column, ids, decoded in _steps(batches, path, whole_check):
            decimals = (",".join(map(decimal, i)) for i in ids)
            yield pa.RecordBatch.from_arrays(
                [column, pa.array([len(i) for i in ids], pa.int64()), pa.array(map(_sha, decimals), pa.string()),
                 pa.array(map(_sha, decoded), pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    base = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string")
