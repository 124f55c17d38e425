"""Encoding with a tokenizer word by word, each distinct word once as long as it is remembered."""

from __future__ import annotations

import os
import re
import string
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from ledgerloom.llm.common import ragged_take

# Every task has a core of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Ids remembered; beyond these, or a class's number of words, those met only seldom are forgotten.
IDS = 5_000_000

# White space beside blanks, tabs and line breaks, as a class of characters.
_RARE_SPACE = "\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = f" \t\r\n{_RARE_SPACE}"
# Letters and digits whose lower case is one of them again: one capital elsewhere becomes a letter and
# a mark when lower-cased, and marks go with punctuation.
_ALNUM = "0-9A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_MARKS = r"!-/:-@\[-`{-~"


class WordEncoder:
    """Ids of whole texts by a tokenizer file.

    A subclass cuts a text into words where no token reaches over. Its words need not be the text
    itself, but two equal ones must have equal ids.
    """

    # Some 300 bytes each in every worker.
    most_words = 450_000

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.slots: dict[str, int] = {}
        # By slot; with room for more, so that a few new words do not copy all others.
        self.uses = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.n_ids = 0

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts in a row, and how many each text has."""
        raise NotImplementedError

    def spelt(self, word: str) -> str:
        """The piece of text a word stands for."""
        return word

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and how many each has; each word by itself."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        found = self.tokenizer.encode_batch_fast([self.spelt(word) for word in words], add_special_tokens=False)
        ids = [one.ids for one in found]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for some in ids for i in some), np.uint32, int(lengths.sum())), lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (strings, null as empty) in a row, and how many each text has."""
        if len(self.slots) > self.most_words or self.n_ids > IDS:
            self._forget()
        return self._encode_texts(pc.fill_null(texts, ""))

    def _encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, counts = self.cut(texts)
        # Words that occur often in these texts are looked up once.
        coded = words.dictionary_encode()
        distinct = self._slots(strings(coded.dictionary))
        indices = coded.indices.to_numpy()
        self.uses[distinct] += np.bincount(indices, minlength=len(distinct))
        return self._encode_slots(distinct[indices], counts)

    def _slots(self, words: list[str]) -> np.ndarray:
        slots = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(slots < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([words[i] for i in missing])))
            slots[missing] = [self.slots[words[i]] for i in missing]
        return slots

    def _encode_slots(self, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[slots]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        last = np.cumsum(counts)
        return ragged_take(self.ids, self.starts[slots], lengths), ends[last] - ends[last - counts]

    def _learn(self, words: list[str]) -> None:
        """Words not met before."""
        self._add(words, *self.encode_words(words))

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        known, total = len(self.slots), len(self.slots) + len(words)
        self.slots.update(zip(words, range(known, total)))
        self.uses, self.lengths, self.starts = (with_room(of, total) for of in (self.uses, self.lengths, self.starts))
        self.ids = with_room(self.ids, self.n_ids + len(ids))
        self.uses[known:total] = 0
        self.lengths[known:total] = lengths
        self.starts[known:total] = self.n_ids + np.cumsum(lengths) - lengths
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)

    def marked(self, words: list[str], mark: str, between: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Words as one text with ``between`` after each, which holds a mark that is a token of its
        own and of no word; None if it is not."""
        text = between.join([*map(self.spelt, words), ""])
        found = self.tokenizer.encode_batch_fast([mark, text], add_special_tokens=False)
        marks, ids = found[0].ids, np.array(found[1].ids, np.uint32)
        ends = np.flatnonzero(ids == marks[0]) if len(marks) == 1 else []
        if len(ends) != len(words):
            return None
        return ids[ids != marks[0]], np.diff(np.concatenate(([-1], ends))) - 1

    def _forget(self) -> None:
        """Keep what was met most often, a third of the words at most and only short ones."""
        share = self.most_words // 3
        uses, lengths = self.uses[: len(self.slots)], self.lengths[: len(self.slots)]
        usual = np.sort(uses)[-share] if len(uses) > share else 0
        stays = np.flatnonzero((uses > max(1, usual)) & (lengths < 32))
        words = list(self.slots)
        self.slots = {words[i]: slot for slot, i in enumerate(stays.tolist())}
        self.ids = ragged_take(self.ids, self.starts[stays], self.lengths[stays])
        self.lengths = self.lengths[stays]
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.uses = np.ones(len(stays), np.int64)
        self.n_ids = len(self.ids)


def strings(array: pa.Array) -> list[str]:
    """A column without nulls, in half the time of ``to_pylist``."""
    return array.to_numpy(zero_copy_only=False).tolist()


def with_room(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with ``size`` places at least, half as many again where they must be copied."""
    if size <= len(values):
        return values
    larger = np.zeros(size + size // 2, values.dtype)
    larger[: len(values)] = values
    return larger


def in_order(
    yes: tuple[np.ndarray, np.ndarray], no: tuple[np.ndarray, np.ndarray], which: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids of two kinds, in the order in which ``which`` is true and false."""
    ids, lengths = (np.concatenate(both) for both in zip(yes, no))
    order = np.argsort(np.argsort(~which, kind="stable"), kind="stable")
    return ragged_take(ids, (np.cumsum(lengths) - lengths)[order], lengths[order]), lengths[order]


# What a byte of a text is: nothing known (part of a character beyond ASCII, or a rare one), a letter, a
# digit, punctuation, an apostrophe (which may begin a pre-token with letters), a blank, other white space.
_UNKNOWN, _LETTER, _DIGIT, _MARK, _QUOTE, _BLANK, _BREAK = range(7)
_KNOWN = (_LETTER, _DIGIT, _MARK, _QUOTE)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _UNKNOWN, np.uint8)
    kinds[33:127] = _MARK
    kinds[[ord(c) for c in string.ascii_letters]] = _LETTER
    kinds[[ord(c) for c in string.digits]] = _DIGIT
    kinds[ord("'")], kinds[ord(" ")] = _QUOTE, _BLANK
    kinds[[ord(c) for c in "\t\n\r"]] = _BREAK
    return kinds


def _ends() -> np.ndarray:
    """By the kinds of two neighbours (eight times the first's, and the second's): whether a word begins
    at the second wherever they meet."""
    ends = np.zeros(64, bool)
    for first in _KNOWN:
        for second in (*_KNOWN, _BLANK, _BREAK):
            inside = second == first or first == _QUOTE and second in _KNOWN or (first, second) == (_MARK, _QUOTE)
            ends[8 * first + second] = not inside
    return ends


class ByteWords(WordEncoder):
    """Byte-level tokenizers, whose pre-tokens can hold a space only at their start.

    A text is cut, by its bytes, where a pre-token ends whatever else the text holds: between letters,
    digits and punctuation, but not from an apostrophe or a space to what follows; before white space
    that follows something else; and after a line break or tab that stands alone.
    """

    # Capitals make more words different here, and a miss costs more.
    most_words = 650_000
    _solid = f"^ ?[^{_SPACE}]+$"
    # Bytes looked at together, so that they stay in a core's cache.
    _block = 1 << 19
    _kinds, _ends = _kinds(), _ends()

    def __init__(self, path: str) -> None:
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab()
        self.after_space = np.zeros(max(vocabulary.values()) + 1, bool)
        self.after_space[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        texts = texts.cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        bounds, first = bounds - bounds[0], bounds[0]
        size = int(bounds[-1])
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : first + size]
        begins = np.empty(size + 1, bool)
        for at in range(0, size, self._block):
            # Two bytes of a character, and the two before a word, may lie across the edge.
            since, until = max(0, at - 3), min(at + self._block, size)
            begins[at:until] = self._begins(data[since : until + 1])[at - since : until - since]
        begins[bounds] = True
        begins[size] = True
        starts = np.flatnonzero(begins)
        counts = np.diff(np.searchsorted(starts, bounds))
        buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.string(), len(starts) - 1, buffers), counts

    def _begins(self, data: np.ndarray) -> np.ndarray:
        """Whether a word begins at each byte of ``data``; not at the first one."""
        kinds = self._kinds[data]
        # Two-byte characters up to U+00FF; all from U+00C0 on but two are letters.
        latin = np.flatnonzero(data[:-1] == 0xC3)
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        kinds[latin] = kinds[latin + 1] = _LETTER
        begins = np.zeros(len(data), bool)
        pairs = kinds[:-1] << 3
        pairs |= kinds[1:]
        begins[1:] = self._ends[pairs]
        after = np.flatnonzero(kinds[:-1] == _BREAK) + 1
        after = after[after > 1]
        begins[after] = (kinds[after] - 1 < _QUOTE) & (kinds[after - 2] - 1 < _QUOTE)
        # A blank after a character beyond ASCII, if that is no white space.
        blank = np.flatnonzero(pairs == _BLANK) + 1
        blank = blank[blank > 2]
        if len(blank):
            third, second, last = (data[blank - back].astype(np.int64) for back in (3, 2, 1))
            begins[blank] = (last >= 0x80) & ~_is_space(third << 16 | second << 8 | last)
        return begins

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        array = pa.array(words, pa.string())
        solid = pc.match_substring_regex(array, self._solid).to_numpy(zero_copy_only=False)
        spaced = solid & pc.starts_with(array, " ").to_numpy(zero_copy_only=False)
        text = "".join(words if spaced.all() else [words[i] for i in np.flatnonzero(spaced).tolist()])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        # Every token that begins with a space begins a word.
        together = ids, np.diff(np.append(np.flatnonzero(self.after_space[ids]), len(ids)))
        if spaced.all():
            return together
        return in_order(together, self._encode_others([words[i] for i in np.flatnonzero(~spaced)], solid[~spaced]), spaced)

    def _encode_others(self, words: list[str], solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lines = self.marked([words[i] for i in np.flatnonzero(solid)], "\n", "\n") if solid.any() else None
        if lines is None:
            return super().encode_words(words)
        return in_order(lines, super().encode_words([words[i] for i in np.flatnonzero(~solid)]), solid)


def _is_space(bytes_: np.ndarray) -> np.ndarray:
    """Whether a character beyond ASCII is white space, by the three bytes up to its end."""
    low = bytes_ & 0xFF
    general = (bytes_ >> 8 == 0xE280) & ((low <= 0x8A) | (low == 0xA8) | (low == 0xA9) | (low == 0xAF))
    latin = (bytes_ >> 8 & 0xFF == 0xC2) & ((low == 0x85) | (low == 0xA0))
    return general | latin | np.isin(bytes_, (0xE19A80, 0xE2819F, 0xE38080))


class SpacedWords(WordEncoder):
    """Tokenizers that lower-case and drop white space; rare kinds of it are left to them."""

    # Letters whose lower case depends on what is beside them, or is not one letter.
    _beyond = "[^\x00-\xff]"
    _mark = "\x01"
    # Words that may consist of others, and their parts: groups of a pattern, in order.
    _joined = f"[{_MARKS}]$"
    _parts = f"^(?P<stem>[^{_SPACE}]*[{_ALNUM}])(?P<marks>[{_MARKS}]+)$"

    def _encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        usual = self.usual(texts)
        first = super()._encode_texts(texts.filter(pa.array(usual)))
        if usual.all():
            return first
        rest = [self.cut_unusual(text) for text in texts.filter(pa.array(~usual)).to_pylist()]
        counts = np.fromiter(map(len, rest), np.int64, len(rest))
        slots = self._slots([word for words in rest for word in words])
        np.add.at(self.uses, slots, 1)
        second = self._encode_slots(slots, counts)
        return in_order(first, second, usual)

    def usual(self, texts: pa.Array) -> np.ndarray:
        odd = pc.match_substring_regex(texts, f"[{_RARE_SPACE}{self._mark}]")
        return ~pc.or_(odd, pc.match_substring_regex(texts, self._beyond)).to_numpy(zero_copy_only=False)

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of texts, where :meth:`usual` says that this plain way of cutting will do."""
        cut = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        return cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)

    def cut_unusual(self, text: str) -> list[str]:
        return [text] if re.search(f"[{_RARE_SPACE}{self._mark}]", text) else text.split()

    def _learn(self, words: list[str]) -> None:
        """Words not met before; those that end with punctuation by their parts."""
        array = pa.array(words, pa.string())
        at = np.flatnonzero(pc.match_substring_regex(array, self._joined).to_numpy(zero_copy_only=False))
        found = pc.extract_regex(array.take(pa.array(at)), self._parts)
        whole = found.is_null().to_numpy(zero_copy_only=False)
        at, found = at[~whole], found.drop_null()
        # Each part's place among the distinct ones; a group that took no part in the match is empty.
        parts: dict[str, int] = {}
        places = np.full((len(at), found.type.num_fields), -1, np.int64)
        for column in range(found.type.num_fields):
            coded = found.field(column).dictionary_encode()
            mine = [text and parts.setdefault(text, len(parts)) for text in strings(coded.dictionary)]
            places[:, column] = np.array([-1 if place == "" else place for place in mine], np.int64)[coded.indices.to_numpy()]
        alone = np.ones(len(words), bool)
        alone[at] = False
        new = dict.fromkeys(words if alone.all() else strings(array.filter(pa.array(alone))))
        new |= dict.fromkeys([part for part in parts if part not in self.slots])
        if new:
            self._add(list(new), *self.encode_words(list(new)))
        # A part may be one of the words itself.
        rest = np.array([words[i] not in self.slots for i in at.tolist()], bool)
        if rest.any():
            at, places = at[rest], places[rest]
            slots = np.fromiter(map(self.slots.__getitem__, parts), np.int64, len(parts))[places[places >= 0]]
            counts = (places >= 0).sum(1)
            lengths = self.lengths[slots]
            ids = ragged_take(self.ids, self.starts[slots], lengths)
            self._add([words[i] for i in at.tolist()], ids, np.add.reduceat(lengths, np.cumsum(counts) - counts))

    # Lower-case letters alone, which are pre-tokens.
    _letters = "^[a-z\xdf-\xf6\xf8-\xff]+$"
    _odd = f"[{_RARE_SPACE}{_mark}]"

    def __init__(self, path: str) -> None:
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return super().encode_words(words)
        array = pa.array(words, pa.string())
        letters = pc.match_substring_regex(array, self._letters).to_numpy(zero_copy_only=False)
        found = self._encode_letters(words if letters.all() else strings(array.filter(pa.array(letters))))
        if found is None:
            return self._encode_marked(words)
        if letters.all():
            return found
        return in_order(found, self._encode_marked(strings(array.filter(pa.array(~letters)))), letters)

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Words of one pre-token each, as one text; None if the last tokens of words do not tell
        where each ends."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(words):
            return None
        return ids, np.diff(np.concatenate(([-1], ends)))

    def _encode_marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(pa.array(words, pa.string()), self._odd).to_numpy(zero_copy_only=False)
        if odd.any():
            usual = self._encode_marked([words[i] for i in np.flatnonzero(~odd)])
            return in_order(usual, super().encode_words([words[i] for i in np.flatnonzero(odd)]), ~odd)
        return self.marked(words, self._mark, f" {self._mark} ") or super().encode_words(words)


def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of texts in a row, each followed by ``end_id``."""
    last = np.cumsum(counts + 1) - 1
    inside = np.ones(len(ids) + len(counts), bool)
    inside[last] = False
    out = np.full(len(inside), end_id, "<u4")
    out[inside] = ids
    return out


@lru_cache(maxsize=2)
def encoder(path: str, kind: type[WordEncoder]) -> WordEncoder:
    """One encoder per Python worker, which goes from task to task with what it remembers."""
    return kind(path)
