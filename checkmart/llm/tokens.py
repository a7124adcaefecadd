"""Token ids of many texts with a public tokenizer file, inside Spark tasks.

A tokenizer's own split cuts a text into pieces whose ids do not depend on their surroundings, and no piece runs over the
end of a word. Arrow cuts blocks of texts into chunks between spaces and tells the distinct ones apart; chunks that are new
to the worker are cut into pieces, and pieces that are new to it are encoded by the tokenizers library's model of the file.
Texts outside plain Latin script, with special tokens or, where white space counts, with odd spacing are encoded whole by
the library, so that its normalisation and tables alone decide there; so are all texts if a file is found to work otherwise.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks, and distinct pieces, kept per worker: the first ones met, which hold the frequent ones. Others are
#: worked out in every block where they occur. Results do not depend on it.
KEPT = 400_000
#: Characters of texts handed out together, and encoded together; a longer text stands alone and whole.
STEP_CHARS, BLOCK_CHARS = 1 << 19, 1 << 22
# what the library has to see in its text: characters other than ASCII and Latin letters, on which the library and this
# module are known to agree, and special tokens
_SPECIAL = r"[^\t\n\r\x20-\x7EÀ-ÖØ-öø-įı-ɏ]|<\|"
# a space next to other white space or at an end
_ODD_SPACE = r"[\t\n\r ] | [\t\n\r]|\A | \z"
# between chunks in one text, and a piece of its own; no plain text has it
_MARK = "\x0c"
# The splits of the tokenizer files, on plain texts; some of their letters are lower-cased to IPA letters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ʯⱥⱦ"
_BYTE_SPLIT = (
    rf"\x0c| ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|[ \t\n\r]+(?![^ \t\n\r\x0c])|[ \t\n\r]+"
)
_WORD_SPLIT = rf"\x0c|[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s0-9{_LETTERS}]+"
# byte-level files spell every byte as one visible character: other bytes are numbered from 256
_SHOWN = np.r_[0x21:0x7F, 0xA1:0xAD, 0xAE:0x100]
_SPELLING = np.arange(256, dtype="<u4")
_SPELLING[np.setdiff1d(_SPELLING, _SHOWN)] = np.arange(256, 512 - len(_SHOWN))


def _ranges(sizes: list[int], most: int) -> Iterator[slice]:
    """Ranges of texts of at most `most` characters together; a longer text stands alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size + 1
    if begin < len(sizes):
        yield slice(begin, len(sizes))


class _Ids:
    """Ids of distinct strings, one after the other in one array; behind those that are kept, those of the last call."""

    def __init__(self, kept: int, empty: str) -> None:
        self.kept, self.known = kept, {empty: 0}
        self.ids = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 12, np.int64)

    def places(self, strings: list[str], ids_of: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Where the strings are, until the next call; `ids_of` gives new ones' numbers of ids, and their ids."""
        at = np.fromiter(map(self.known.get, strings, repeat(-1)), np.int64, len(strings))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [strings[k] for k in missing.tolist()]
            first = len(self.known)
            found = dict(zip(dict.fromkeys(new), count(first)))
            self._add(first, *ids_of(list(found)))
            at[missing] = np.fromiter(map(found.__getitem__, new), np.int64, len(new))
            if first < self.kept:
                self.known.update(found)
        return at

    def _add(self, first: int, lengths: np.ndarray, ids: np.ndarray) -> None:
        ends = self.ends[first] + np.cumsum(lengths)
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(ends) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.ends[first] : ends[-1]] = ids
        self.ends[first + 1 : first + 1 + len(ends)] = ends

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings in a row, and where each string's ids end."""
        begins = self.ends[places]
        lengths = self.ends[places + 1] - begins
        ends = np.cumsum(lengths)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + lengths, lengths)], ends


class Encoder:
    """Encodes texts with a tokenizer file; `end_id` closes every text.

    `words` says that the tokenizer lower-cases and drops white space; otherwise it is byte-level and keeps white space. A
    chunk is what lies between two spaces (with `words`, white space), with the space before it if white space is kept.
    """

    def __init__(self, path: str, words: bool, end_id: int, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.end_id = words, end_id
        self.find = re.compile(_WORD_SPLIT if words else _BYTE_SPLIT).findall
        # a first chunk has a NUL in the place of the space before it
        self.chunks, self.pieces = _Ids(kept, "" if words else "\0"), _Ids(kept, _MARK)
        self.special = _SPECIAL if words else f"{_SPECIAL}|{_ODD_SPACE}"
        if not self._agrees():
            self.special = ""  # found in every text

    def _agrees(self) -> bool:
        """Whether this module's cutting gives the file's own ids on all plain characters."""
        plain = [c for c in map(chr, range(0x250)) if not re.search(_SPECIAL, c)]
        probe = " ".join(f"a{c}b {c}{c} 1{c}'s" for c in plain if not c.isspace()) + " they'll I'VE ''re _don't 12.345,\r\n\n\tx--\n"
        return self.encode(pa.array([probe]))[0].tolist() == [*self._library([probe])[0], self.end_id]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        spelt = _SPELLING[np.frombuffer(_MARK.join(pieces).encode(), np.uint8)].tobytes().decode("utf-32-le")
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(piece)] for piece in spelt.split(chr(_SPELLING[ord(_MARK)]))]
        return np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(chain.from_iterable(found), np.int32)

    def _of_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.words:
            chunks = [c[1:] if c[0] == "\0" else " " + c for c in chunks]
        places = self.pieces.places(self.find(_MARK.join(chunks)), self._of_pieces)
        ids, ends = self.pieces.at(places)  # a mark has no ids
        last = ends[np.flatnonzero(places == 0)]
        return np.diff(np.concatenate([[0], last, ends[-1:]])), ids

    def _cut(self, texts: pa.Array) -> pa.Array:
        if self.words:
            return pc.ascii_split_whitespace(pc.utf8_lower(texts))
        return pc.split_pattern(pc.binary_join_element_wise("\0", texts, ""), " ")

    def steps(self, texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Ranges of texts, as `encode` gives them; several are encoded together."""
        sizes = pc.utf8_length(texts).to_pylist()
        steps = list(_ranges(sizes, STEP_CHARS))
        for some in _ranges([sum(sizes[step]) for step in steps], BLOCK_CHARS):
            first = steps[some][0].start
            ids, ends = self.encode(texts[first : steps[some][-1].stop].cast(pa.string()))
            cuts = np.concatenate([[0], ends])
            for step in steps[some]:
                begin, stop = step.start - first, step.stop - first
                yield step, ids[cuts[begin] : cuts[stop]], ends[begin:stop] - cuts[begin]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each closed by the end id, and where each text ends. No text may be null."""
        whole = pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False).astype(bool)
        cut = self._cut(texts.filter(pa.array(~whole)))
        occurring = cut.flatten().dictionary_encode()
        places = self.chunks.places(occurring.dictionary.to_numpy(zero_copy_only=False).tolist(), self._of_chunks)
        ids, ends = self.chunks.at(places[occurring.indices.to_numpy(zero_copy_only=False)])
        last = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)
        by_library = self._library(texts.filter(pa.array(whole)).to_pylist())
        sizes = np.empty(len(texts), np.int64)
        sizes[~whole] = np.diff(np.concatenate([[0], ends])[last], prepend=0)
        sizes[whole] = np.fromiter(map(len, by_library), np.int64, len(by_library))
        stops = np.cumsum(sizes + 1)
        out = np.full(stops[-1] if len(stops) else 0, self.end_id, np.int32)
        free = np.ones(len(out), bool)
        free[stops - 1] = False
        for stop, found in zip((stops[whole] - 1).tolist(), by_library, strict=True):
            out[stop - len(found) : stop] = found
            free[stop - len(found) : stop] = False
        out[free] = ids
        return out, stops


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, words: bool, end_id: int) -> Encoder:
    """The encoder of this worker process."""
    key = (path, words, end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]
