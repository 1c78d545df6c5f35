"""Token ids of whole texts by a tokenizers-library file, word by word.

Both files used here first cut a text into words by a pattern and never
merge across them, so the ids of a text are the ids of its words in turn; a
word seen before is looked up instead of tokenized again.  The patterns are
stated here for Latin-1 texts, where character classes are short; a text
with other characters is cut at blanks where that is safe, or goes through
the tokenizer as it is.  Special-token strings inside a text are ordinary
text, as the files' description asks.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

# Letters and numbers of Latin-1, and the white space the patterns below
# expect; \x00, \x1c-\x1f, \x85 and \xa0 aren't left to them.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r\x20"
_ODD = re.compile("[\x00\x1c-\x1f\x85\xa0]")
# The files' own patterns (fixed values), in these classes.
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_WORDS = re.compile(f"{_SHORT}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BLANK_WORDS = re.compile(f"{_SHORT}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
# Other texts: a single blank goes with the word behind it, a line feed
# stands alone.
_PIECES = re.compile(r" ?[^ \n]+|\n")
_UNSAFE = re.compile(r"\s\s|[^\S \n]")

BYTE_LEVEL = "byte"
WORD_ENDS = "word"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """``layout``: BYTE_LEVEL keeps white space in the ids, WORD_ENDS drops
    it.  Words are kept from one call to the next, beyond ``remembered`` of
    them, or ``characters`` in all, only the more frequent half that was met
    twice; words longer than ``longest`` and texts that can't be cut are
    never kept, so what a worker holds is bounded whatever the texts."""

    def __init__(self, path: str, layout: str, end_id: int = 1, remembered: int = 700_000, characters: int = 16_000_000, longest: int = 256) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.layout, self.end_id, self.remembered = layout, end_id, remembered
        self.characters, self.longest, self.held = characters, longest, 0
        # what stands between words that are tokenized in one go, and its id
        self.between = " \0 " if layout == WORD_ENDS else "\n"
        (self.between_id,) = self._ids(self.between)
        self.code: dict[str | None, int] = {None: 0, "\n": 1}
        self.flat = np.array([self.end_id, self.between_id], np.uint32)
        self.at = np.array([0, 1, 2], np.int64)
        self.met = np.full(2, np.iinfo(np.int64).max // 2)  # never forgotten

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        least = max(2, int(np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]) + 1)
        kept = self.met >= least
        number = np.cumsum(kept) - 1
        self.code = {w: int(number[k]) for w, k in self.code.items() if kept[k]}
        lengths = np.diff(self.at)
        self.flat = self.flat[np.repeat(kept, lengths)]
        self.at = np.concatenate([[0], np.cumsum(lengths[kept])])
        self.met = np.where(self.met[kept] > 1 << 60, self.met[kept], 1)
        self.held = sum(len(w) for w in self.code if w)

    def _learn(self, words: list[str], whole: set[str]) -> int:
        """New words go through the tokenizer together, whole texts alone.
        Returns how many of the codes are to be kept; the rest, the last
        ones, are of whole texts and long words."""
        passing = [w for w in words if w in whole or len(w) > self.longest]
        if passing:
            drop = set(passing)
            words = [w for w in words if w not in drop]
        stay = len(self.at) - 1 + len(words)
        self.held += sum(map(len, words))
        for part in (words, passing):
            if part:
                self._add(part, whole)
        return stay

    def _add(self, words: list[str], whole: set[str]) -> None:
        alone = [w for w in words if w in whole or w.isspace()]
        words = [w for w in words if w not in whole and not w.isspace()]
        flat, lengths = [], []
        for lo in range(0, len(words), 4000):
            ids = np.array(self._ids(self.between.join(words[lo : lo + 4000])), np.uint32)
            cuts = np.append(np.flatnonzero(ids == self.between_id), len(ids))
            lengths.append(np.diff(cuts, prepend=-1) - 1)
            flat.append(ids[ids != self.between_id])
        for w in alone:
            ids = np.array(self._ids(w), np.uint32)
            lengths.append(np.array([len(ids)]))
            flat.append(ids)
        words += alone
        lengths = np.concatenate(lengths)
        if len(lengths) != len(words):
            raise AssertionError("words and their ids do not line up")
        self.code.update(zip(words, range(len(self.at) - 1, len(self.at) - 1 + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, *flat])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])

    def _drop(self, stay: int) -> None:
        """Forgets all codes from ``stay`` on."""
        if stay < len(self.at) - 1:
            while len(self.code) > stay:
                self.code.popitem()  # the last that was added
            # copies: a view would hold what is dropped
            self.flat, self.at, self.met = self.flat[: self.at[stay]].copy(), self.at[: stay + 1].copy(), self.met[:stay].copy()

    def pieces(self, text: str) -> list[str] | None:
        """The text cut into words; None if it must stay whole."""
        odd = _ODD.search(text)
        if not odd and (text.isascii() or _latin(text)):
            # this layout's file lower-cases, which in Latin-1 is one to one
            return _BLANK_WORDS.findall(text.lower()) if self.layout == WORD_ENDS else _BYTE_WORDS.findall(text)
        if self.layout == WORD_ENDS:
            return None if odd else text.split()
        if odd or _UNSAFE.search(text):
            return None
        out = _PIECES.findall(text)
        return out if sum(map(len, out)) == len(text) else None

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, each text's followed by ``end_id``; and where
        each text begins among them (one more entry: the end)."""
        if len(self.code) > self.remembered or self.held > self.characters:
            self._forget()
        pieces: list[str | None] = []
        until = []
        whole = set()
        for t in texts:
            if t:
                words = self.pieces(t)
                if words is None:
                    whole.add(t)
                pieces += [t] if words is None else words
            pieces.append(None)
            until.append(len(pieces))
        codes = np.fromiter(map(self.code.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(codes < 0).tolist()
        stay = len(self.at) - 1
        if unknown:
            stay = self._learn(list(dict.fromkeys(pieces[k] for k in unknown)), whole)
            codes[unknown] = [self.code[pieces[k]] for k in unknown]
        self.met[2:] += np.bincount(codes, minlength=len(self.met))[2:]
        begins = self.at[codes]
        lengths = self.at[codes + 1] - begins
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(begins - (ends - lengths), lengths) + np.arange(total)]
        self._drop(stay)
        return ids, np.concatenate([[0], ends[np.array(until, np.int64) - 1]]).astype(np.int64) if until else np.zeros(1, np.int64)
