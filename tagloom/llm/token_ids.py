"""Texts to token ids, in Arrow batches.

White space always ends a token of this tokenizer, so a text's ids are its words' ids in a row. Each distinct word of a
batch is encoded once, and the ids of frequent words are kept between batches.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import hash_words, split_words

#: Pieces of words that a Python worker remembers, about.
CACHE_PIECES = 500_000
#: Marks at the end of a word that follow an ASCII letter or digit are a piece of their own for this tokenizer.
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_TAIL = r"[A-Za-z0-9](?P<tail>[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]+)$"


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class Encoder:
    """Ids of whole texts. One for each tokenizer file lives in each Python worker.

    A word is a stem and the marks at its end; stems in ASCII are known in lower case, as the tokenizer lowers them itself.
    New stems are encoded in long rows, which is far cheaper than one by one: a stem of letters alone ends where a token ends a
    word; other stems get a special token between them.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values() if t.special]
        self._special, self._between = special, special[0]
        self._between_id = self._tokenizer.token_to_id(special[0])
        names = self._tokenizer.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(names.values()) + 1, bool)
        self._ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _forget(self) -> None:
        """Number 0 is the empty piece. Known pieces are found by their hashes, and compared."""
        self._words = pa.array([""], pa.string())
        self._hashes, self._number = hash_words(self._words), np.zeros(1, np.int64)
        self._ids, self._size = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)]

    def _row(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, pieces: list[str]) -> list[str]:
        """Keep the ids of new pieces; the pieces in the order of their numbers."""
        letters, plain, odd = [], [], []
        for p in pieces:
            (letters if p.isalpha() else odd if "<|" in p else plain).append(p)
        learnt = []
        for at in range(0, len(letters), 4096):
            part = letters[at : at + 4096]
            ids = self._row(" ".join(part))
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):  # a letter became more than letters when normalised
                plain += part
                continue
            learnt += part
            self._ids.append(ids)
            self._size.append(np.diff(ends, prepend=0))
        for at in range(0, len(plain), 4096):
            ids = self._row(f" {self._between} ".join(plain[at : at + 4096]))
            cut = np.flatnonzero(ids == self._between_id)
            self._ids.append(np.delete(ids, cut))
            self._size.append(np.diff(np.r_[-1, cut, len(ids)]) - 1)
        for piece in odd:
            self._ids.append(self._row(piece))
            self._size.append(np.array([len(self._ids[-1])], np.int64))
        return [*learnt, *plain, *odd]

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece; null has that of the empty piece."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.cast(pa.string())
        hashes = hash_words(words)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        met = self._hashes[at] == hashes
        number = np.where(met, self._number[at], 0)
        known = met & pc.equal(words, self._words.take(pa.array(number))).to_numpy(zero_copy_only=False)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            first = len(self._words)
            ordered = self._learn(words.take(pa.array(fresh)).to_pylist())
            self._words = pa.concat_arrays([self._words, pa.array(ordered, pa.string())])
            place = {w: first + i for i, w in enumerate(ordered)}
            number[fresh] = np.fromiter((place[w] for w in words.take(pa.array(fresh)).to_pylist()), np.int64, len(fresh))
            new = fresh[~met[fresh]]  # a piece whose hash is another's is encoded each time
            new = new[np.argsort(hashes[new])]
            where = np.searchsorted(self._hashes, hashes[new])
            self._hashes, self._number = np.insert(self._hashes, where, hashes[new]), np.insert(self._number, where, number[new])
        return np.append(number, 0)[coded.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (with the end)."""
        if len(self._words) > CACHE_PIECES:
            self._forget()
        codes, offsets, words = split_words(texts)
        tails = pc.struct_field(pc.extract_regex(words, _TAIL), "tail")
        stems = pc.if_else(pc.is_null(tails), words, pc.ascii_rtrim(words, characters=_MARKS))
        stems = pc.if_else(pc.match_substring(stems, "<|"), stems, pc.ascii_lower(stems))
        stem, tail = self._numbers(stems), self._numbers(tails)
        if len(self._ids) > 1:
            self._ids, self._size = [np.concatenate(self._ids)], [np.concatenate(self._size)]
        table, size = self._ids[0], self._size[0]
        first = np.cumsum(size) - size
        pieces = np.stack([stem, tail], axis=1).reshape(-1)
        words_ids, ends = _gathered(table, first[pieces], size[pieces])  # of each distinct word
        ends = ends[::2]
        flat, ends = _gathered(words_ids, ends[:-1][codes], np.diff(ends)[codes])
        return flat, ends[offsets]


def _gathered(table: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """table[first : first + size] of all pairs in a row, and where each begins (with the end)."""
    ends = np.r_[0, np.cumsum(size)]
    return table[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])], ends


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row with the end id after each, as little-endian unsigned 32-bit integers, and their bounds."""
    return np.insert(ids.astype("<u4", copy=False), bounds[1:], end), bounds + np.arange(len(bounds))
