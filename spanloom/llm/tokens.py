"""Token ids by the tokenizers library, with a memory of what it has encoded.

Both vocabularies' tokenizers cut a text into pieces that they encode one by
one, so a text's ids are those of its pieces in a row, and most pieces come
again and again.  The library encodes each new piece, its model alone where the
piece needs no normalising or further cutting; numpy puts the ids of
whole batches together.  Where pieces are cut is a property of the tokenizer:

``words``  the tokenizer drops white space, so any run of white space parts
           pieces.  Texts with white space beyond ASCII go to the library whole.
``spaces`` byte-level pieces keep the blank before a word.  A text is cut
           before each blank, which is where the tokenizer cuts, too, unless a
           blank has white space on both sides or ends a run that ends the
           text, or the text has white space beyond ASCII.  Such texts go to
           the library whole.

So do texts that hold the string of a special token.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: So many pieces are remembered by a worker; beyond, it forgets all but at most
#: half of them, those used most since the last time.
MOST_PIECES = 800_000
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_INNER_BLANK = re.compile(r"\s \s|\s \Z")
#: Latin letters, then common marks: two of the tokenizer's own parts, which its
#: model takes directly.  Such letters are composed and have one lower case each.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)")
_loaded: dict[tuple[str, str], TokenMemory] = {}


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies spell visible bytes as themselves, the n-th other one as U+0100 + n."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in visible)}


_SPELLED = _byte_letters()


class TokenMemory(dict):
    """Piece -> number; ids of piece k are flat[at[k] : at[k] + size[k]]."""

    def __init__(self, path: str, cut: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.cut = Tokenizer.from_file(path), cut
        # strings of special tokens become their ids, wherever the library finds them
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE) if special else None
        self.model = self.tokenizer.model
        self.marks: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.flat, self.at, self.size = np.empty(1 << 20, np.uint32), np.empty(1 << 18, np.int64), np.empty(1 << 18, np.int64)
        self.used = 0
        self.uses = np.zeros(1 << 18, np.int32)

    def _keep_used(self) -> None:
        """Forgets rare pieces."""
        n = len(self)
        uses, least = self.uses[:n], 2
        while np.count_nonzero(uses >= least) > MOST_PIECES // 2:
            least *= 2
        kept = np.flatnonzero(uses >= least)
        pieces = list(self)
        pieces = [pieces[k] for k in kept.tolist()]  # a dict keeps the order of numbers
        sizes = self.size[kept]
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.at[kept] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        self.clear()
        self.update(zip(pieces, range(len(pieces)), strict=True))
        self.flat[: len(flat)], self.used = flat, len(flat)
        self.at[: len(kept)], self.size[: len(kept)] = ends - sizes, sizes
        self.uses[:] = 0

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.new.append(piece)
        return k

    def _part(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(_SPELLED))]

    def _encode_new(self) -> list[list[int]]:
        plain, match, lower, marks = {}, _PLAIN.fullmatch, self.cut == "words", self.marks
        for k, piece in enumerate(self.new):
            if m := match(piece):
                letters, mark = m.groups()
                own = self._part(letters.lower() if lower else letters)
                if mark:
                    if mark not in marks:
                        marks[mark] = self._part(mark)
                    own += marks[mark]
                plain[k] = own
        rest = iter(self.tokenizer.encode_batch_fast([p for k, p in enumerate(self.new) if k not in plain], add_special_tokens=False))
        return [plain[k] if k in plain else next(rest).ids for k in range(len(self.new))]

    def _learn(self) -> None:
        """Encodes the new pieces."""
        first = len(self) - len(self.new)
        ids = self._encode_new()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while len(self) > len(self.at):
            self.at, self.size, self.uses = (np.concatenate((x, np.zeros_like(x))) for x in (self.at, self.size, self.uses))
        self.flat[self.used : self.used + total] = np.fromiter((x for own in ids for x in own), np.uint32, total)
        self.size[first : len(self)] = sizes
        self.at[first : len(self)] = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.new = []

    def _pieces(self, text: str) -> list[str]:
        if _OTHER_SPACE.search(text) or self.special and self.special.search(text):
            return [text]
        if self.cut == "words":
            return text.split()
        if _INNER_BLANK.search(text):
            return [text]
        first, *more = text.split(" ")
        out = [" " + x for x in more]
        if first:
            out.insert(0, first)
        return out

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text, uint32, with ``end_id`` after them."""
        if len(self) > MOST_PIECES:
            self._keep_used()
        numbers, counts, lookup = [], [], self.__getitem__
        for t in texts:
            pieces = self._pieces(t)
            counts.append(len(pieces))
            numbers += map(lookup, pieces)
        if self.new:
            self._learn()
        k = np.array(numbers, dtype=np.int64)
        seen = np.bincount(k)
        self.uses[: len(seen)] += seen.astype(np.int32)
        sizes = self.size[k]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.at[k] - (ends - sizes), sizes) + np.arange(total)]
        cuts = np.concatenate(([0], ends))[np.cumsum(counts)] if counts else np.empty(0, np.int64)
        end, out, last = np.array([end_id], np.uint32), [], 0
        for c in cuts.tolist():
            out.append(np.concatenate((ids[last:c], end)))
            last = c
        return out


def memory(path: str, cut: str) -> TokenMemory:
    """This worker's memory for the tokenizer at ``path``."""
    if (path, cut) not in _loaded:
        _loaded[path, cut] = TokenMemory(path, cut)
    return _loaded[path, cut]


def encoded(texts: list[str], path: str, cut: str, end_id: int, chars: int = 1 << 20):
    """The ids of each text, one after another; some million characters at a time."""
    own, held, n = memory(path, cut), [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= chars:
            yield from own.encode(held, end_id)
            held, n = [], 0
    if held:
        yield from own.encode(held, end_id)
