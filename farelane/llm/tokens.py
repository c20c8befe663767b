"""Tokenising by distinct pre-tokens: each is encoded once for a slice of documents.

A text is parted at ASCII white space, which the tokenizers used here drop and never look across.
A single full stop or comma after a Latin letter is a pre-token of its own and split off, and ASCII
capitals of plain Latin words are lowered as the tokenizer does, so that few distinct words remain.
Both hold only for a tokenizer that lowers its input and parts letters from punctuation;
``plain`` says so, and without it the words are taken as they stand.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from farelane.llm.texts import words_of

# Latin words without a combining mark, whose lower case is the same before and after composition;
# the dotted capital I is left out, since its lower case has such a mark.
_PLAIN = r"^[\x21-\x3b\x3d-\x7e\x{c0}-\x{12f}\x{131}-\x{24f}]+$"
_ENDED = r"[a-zA-Z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}][.,]$"


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The tokenizer of a file, once for each process, without truncation or padding. It encodes in one
    thread, as a task has one core; threads would keep memory of their own for each core of the machine."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def lowers(path: str) -> bool:
    """Whether the tokenizer lowers its input and parts a letter from a following mark."""
    tokenizer = load(path)

    def same(a: str, *b: str) -> bool:
        ids = [tokenizer.encode(x, add_special_tokens=False).ids for x in (a, *b)]
        return ids[0] == sum(ids[1:], [])

    return all(same(*x) for x in (("Ab", "ab"), ("ab.", "ab", "."), ("É,", "é", ","), ("a b", "a", "b")))


# Lower-case Latin letters: such a word is one pre-token and its own normal form.
_LETTERS = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+$"


@lru_cache(maxsize=1)
def byte_characters() -> dict[int, int]:
    """The character that byte-level models have for each byte: itself where it can be printed,
    the others in order from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    return {b: 256 + i for i, b in enumerate(others)}


def word_ids(tokenizer: Tokenizer, word: str) -> list[int]:
    """The ids of a word of letters by the model alone, without the steps before it."""
    if not word.isascii():
        word = word.encode().decode("latin-1").translate(byte_characters())
    return [x.id for x in tokenizer.model.tokenize(word)]


@lru_cache(maxsize=4)
def models_letters(path: str) -> bool:
    """Whether the model alone gives a word of letters the ids that the whole tokenizer does."""
    tokenizer = load(path)
    words = ["a", "the", "straße", "élève", "ñandú", "øæåþðÿ", "questions", "zqxjkvbpygfwm", "ab" * 40]
    return all(word_ids(tokenizer, w) == tokenizer.encode(w, add_special_tokens=False).ids for w in words)


#: Distinct words that are encoded at once; what the tokenizer returns for one is far larger than the word.
ENCODED_WORDS = 4096
#: Words whose ids are put in place at once.
GATHERED_WORDS = 1 << 16


class Pieces:
    """The distinct words of a slice: ``index`` places them, ``until`` counts the words before each
    row, ``stem`` and ``tail`` say what each is made of, a distinct text and the id of a mark after it
    or -1. ``sizes`` has the number of ids of each distinct text and ``flat`` the ids, unless they are
    not wanted."""

    def __init__(self, text: pa.Array, path: str, with_ids: bool = True) -> None:
        rows, self.index, words = words_of(text)
        self.n_rows = len(text)
        self.until = np.searchsorted(rows, np.arange(len(text) + 1))
        del rows
        tokenizer = load(path)
        self.tail = np.full(len(words), -1, dtype=np.int64)
        if lowers(path) and len(words):
            marks = {m: tokenizer.encode(m, add_special_tokens=False).ids for m in ".,"}
            plain = pc.match_substring_regex(words, _PLAIN)
            ended = pc.and_(plain, pc.match_substring_regex(words, _ENDED))
            last = pc.utf8_slice_codeunits(words, start=-1, stop=None)
            for mark, ids in marks.items():
                here = pc.and_(ended, pc.equal(last, mark)).to_numpy(zero_copy_only=False)
                self.tail[here] = ids[0]
            cut = pc.utf8_slice_codeunits(words, start=0, stop=-1)
            words = pc.if_else(ended, cut, words)
            words = pc.if_else(plain, pc.ascii_lower(words), words)
        coded = words.dictionary_encode()
        self.stem = coded.indices.to_numpy(zero_copy_only=False)
        self.sizes, self.flat = np.empty(len(coded.dictionary), dtype=np.int64), array("I")
        for lo in range(0, len(self.sizes), ENCODED_WORDS):
            self._encode(tokenizer, coded.dictionary.slice(lo, ENCODED_WORDS), lo, models_letters(path), with_ids)

    def _encode(self, tokenizer: Tokenizer, words: pa.Array, first: int, by_model: bool, with_ids: bool) -> None:
        stems = words.to_pylist()
        direct = np.zeros(len(stems), dtype=bool)
        if by_model:
            direct = pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False)
        others = [x for x, known in zip(stems, direct.tolist()) if not known]
        rest = iter(tokenizer.encode_batch_fast(others, add_special_tokens=False))
        tokenize, table = tokenizer.model.tokenize, byte_characters()
        sizes, flat = [], self.flat
        for stem, known in zip(stems, direct.tolist()):
            if known:
                if not stem.isascii():
                    stem = stem.encode().decode("latin-1").translate(table)
                found = tokenize(stem)
                if with_ids:
                    flat.extend([x.id for x in found])
            else:
                found = next(rest)
                if with_ids:
                    flat.extend(found.ids)
            sizes.append(len(found))
        self.sizes[first : first + len(sizes)] = sizes

    def counts(self) -> np.ndarray:
        """Tokens of each row: the count of each distinct word, summed over the row's words."""
        return np.diff(self._before()[self.until])

    def _before(self) -> np.ndarray:
        """The tokens of the words before each word, and of all."""
        before = np.zeros(len(self.index) + 1, dtype=np.int64)
        of_word = self.sizes[self.stem] + (self.tail >= 0) if len(self.stem) else np.zeros(0, np.int64)
        if len(self.index):
            np.cumsum(of_word[self.index], out=before[1:])
        return before

    def ids(self, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after the other, each with ``end`` after it, and where rows start."""
        sizes, flat = self.sizes, np.frombuffer(self.flat, dtype=np.uint32)
        starts, before = np.cumsum(sizes) - sizes, self._before()
        # Before a row stand its predecessors' words and ends.
        ends = np.arange(self.n_rows + 1) if end is not None else np.zeros(self.n_rows + 1, np.int64)
        row_starts = before[self.until] + ends
        out = np.empty(int(row_starts[-1]), dtype=np.uint32)
        if end is not None:
            out[row_starts[1:] - 1] = end
        for lo in range(0, len(self.index), GATHERED_WORDS):
            index = self.index[lo : lo + GATHERED_WORDS]
            stem, tail = self.stem[index], self.tail[index]
            here = np.diff(np.clip(self.until, lo, lo + len(index)))
            place = before[lo : lo + len(index)] + np.repeat(ends[:-1], here)
            lengths = sizes[stem]
            after = np.cumsum(lengths)
            numbers = np.arange(int(after[-1]))
            source = np.repeat(starts[stem] - (after - lengths), lengths) + numbers
            out[np.repeat(place - (after - lengths), lengths) + numbers] = flat[source]
            marked = tail >= 0
            out[(place + lengths)[marked]] = tail[marked]
        return out, row_starts
