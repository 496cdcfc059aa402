"""Tokenize whole texts with a public tokenizer file, word by word through a bounded memo."""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from omnishelf.llm.common import kept_for

# Entries of each of a worker's two memos, parts and words: about 75 MB at most for each. A full memo
# of parts is emptied; of the words the older half goes. Results do not depend on it.
MEMO_ENTRIES = 350_000
# Longer parts are not kept.
MEMO_CHARS = 64

_TWO_SPACES = re.compile(r"\s\s")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_TAIL = ".,;:!?|)"


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE, by its public rule: printable bytes stand for
    themselves, the others take code points from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(extra)) for b in range(256)}


_LETTERS = _byte_letters()


_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    pack = _PACK[len(ids)] if len(ids) < len(_PACK) else struct.Struct(f"<{len(ids)}I").pack
    return pack(*ids)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    Byte-level BPE and word-end BPE both cut a text into pieces before merging, and no piece
    reaches over a blank between two non-blanks. So the ids of a text are those of its
    blank-separated parts in a row, and a part met before need not be merged again. The merging
    itself is always the tokenizers library's. ``keeps_blanks``: the blank belongs to the part
    after it (byte level); otherwise blanks vanish.
    """

    def __init__(self, path: str, keeps_blanks: bool, entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_blanks = keeps_blanks
        self.entries = entries
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def _full(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """One run of letters, after the blank or line end it may start with."""
        blank = word[0] == " "
        letters = word[1:] if blank else word.lstrip()
        if letters.isascii():
            if not self.keeps_blanks:
                letters = letters.lower()
        else:
            if not self.keeps_blanks:
                if not unicodedata.is_normalized("NFC", word):
                    return self._full(word)
                # A sigma's lower case depends on its place in Python, not in the tokenizer.
                letters = "".join(map(str.lower, letters)) if "Σ" in letters else letters.lower()
            letters = letters.encode().decode("latin-1").translate(_LETTERS)
        piece = "Ġ" + letters if blank else letters
        return _packed([t.id for t in self.model.tokenize(piece)])

    def _known(self, text: str, make) -> bytes:
        ids = self.words.get(text)
        if ids is None:
            if len(self.words) >= max(self.entries // 2, 1):
                self.words, self.older_words = {}, self.words
            ids = self.words[text] = self.older_words.get(text) or make(text)
        return ids

    def _part(self, part: str, lead: str = " ") -> bytes:
        lead = lead if self.keeps_blanks else ""
        word = part.rstrip(_TAIL)
        if self._plain(word):
            ids = self._known(lead + word, self._word)
            if len(word) == len(part):
                return ids
            return ids + self._known(part[len(word) :], self._full)
        if "\n" in part:
            lines = part.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                end = self._known("\n", self._full)
                out = [self._part(lines[0], lead)]
                for line in lines[1:]:
                    out += [end, self._part(line, "")]
                return b"".join(out)
        return self._full(lead + part)

    def _units(self, text: str) -> list[str]:
        """Blank-separated parts; parts whose border is not a single blank stay joined."""
        parts = text.split(" ")
        out: list[str] = []
        joined = False
        for part in parts:
            clean = bool(part) and not part[0].isspace()
            if out and (joined or not clean):
                out[-1] += " " + part
            else:
                out.append(part)
            joined = not part or part[-1].isspace()
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head = b""
        if self.keeps_blanks:
            parts = text.split(" ")
            if text[0].isspace() or text[-1].isspace() or _TWO_SPACES.search(text):
                parts = self._units(text)
            head = self._full(parts[0])
            del parts[0]
        elif _ODD_SPACE.search(text):
            return self._full(text)
        else:
            parts = text.split()
        memo = self.memo
        try:
            return head + b"".join(map(memo.__getitem__, parts))
        except KeyError:
            pass
        if len(memo) >= self.entries:
            memo.clear()
        out = [head]
        for part in parts:
            ids = memo.get(part)
            if ids is None:
                ids = self._part(part)
                if len(part) <= MEMO_CHARS:
                    memo[part] = ids
            out.append(ids)
        return b"".join(out)

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and each text's bounds in them.

        Where blanks vanish, the texts' words are numbered first, so that a word is looked up once
        however often it stands in them, and ids are laid out by number.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.any(pc.match_substring_regex(texts, _ODD_SPACE.pattern)).as_py()
        if self.keeps_blanks or odd:
            rows = [self.encode(text) for text in texts.to_pylist()]
            sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
            return np.frombuffer(b"".join(rows), "<u4"), np.concatenate(([0], np.cumsum(sizes)))
        words = pc.ascii_split_whitespace(texts)
        numbered = words.flatten().dictionary_encode()
        made = self._many(numbered.dictionary.to_numpy(zero_copy_only=False))
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts = np.cumsum(sizes) - sizes
        word = numbered.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[word])))
        place = np.arange(ends[-1]) + np.repeat(starts[word] - ends[:-1], sizes[word])
        offsets = words.offsets.to_numpy()
        return np.frombuffer(b"".join(made), "<u4")[place], ends[offsets - offsets[0]]

    def _many(self, parts: Iterable[str]) -> list[bytes]:
        """The ids of distinct parts without blanks. Words are remembered without the marks behind
        them, which are few and remembered as well."""
        out = []
        for part in parts:
            word = part.rstrip(_TAIL)
            ids = self.words.get(word)
            if ids is None:
                if not self._plain(word):
                    out.append(self._odd(part))
                    continue
                ids = self._known(word, self._word)
            if len(word) != len(part):
                ids += self._known(part[len(word) :], self._full)
            out.append(ids)
        return out

    def _plain(self, word: str) -> bool:
        """Whether the word is one run of letters to the tokenizer."""
        return word.isalpha() and (word.isascii() or self.keeps_blanks or word.lower().isalpha())

    def _odd(self, part: str) -> bytes:
        ids = self.memo.get(part)
        if ids is None:
            ids = self._part(part) if part else b""
            if len(part) <= MEMO_CHARS:
                if len(self.memo) >= self.entries:
                    self.memo.clear()
                self.memo[part] = ids
        return ids


def encoder(path: str, keeps_blanks: bool) -> WordEncoder:
    """One encoder per worker and file, so that its memo serves all tasks of the worker."""
    encoders, key = kept_for("encoding"), (path, keeps_blanks)
    if key not in encoders:
        encoders[key] = WordEncoder(path, keeps_blanks)
    return encoders[key]
