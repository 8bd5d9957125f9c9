"""Token ids of whole texts by the tokenizers library, with each distinct word encoded once.

Byte-level BPE cuts a text before it merges, and a cut before a single space or around a
single line break between two other characters never depends on what stands further away.
So a text is the concatenation of such pieces, and a piece seen before is looked up. Texts
with other white space next to a cut, and tokenizers of another kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
from itertools import compress, islice, repeat

import numpy as np

CACHE_WORDS = 700_000
FILL = 256
# white space but blanks and line breaks: in texts of ASCII, and beyond
_OTHER = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_BEYOND = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_CODERS: dict[tuple[str, bool], "Coder"] = {}


def coder(path: str, places: bool = False) -> "Coder":
    """One coder per worker process, so its words stay known between tasks."""
    if (path, places) not in _CODERS:
        _CODERS[path, places] = Coder(path, places)
    return _CODERS[path, places]


def _plainly_spaced(text: str) -> bool:
    """All white space is single blanks and line breaks between other characters."""
    if len(text.split()) != text.count(" ") + text.count("\n") + 1 or "\0" in text:
        return False
    # other white space between words would make up for a line break too many
    return not any(c in text for c in (_OTHER if text.isascii() else _OTHER + _BEYOND))


class Coder:
    """``encode(texts)``: per text the bytes of little-endian 32-bit ids. With ``places``,
    each id is followed by the first and end character of its token."""

    def __init__(self, path: str, places: bool = False, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.places, self.cache_words = places, cache_words
        kind = json.loads(self.tokenizer.to_str())
        before = kind.get("pre_tokenizer") or {}
        self.pieces = (
            kind.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] for t in kind.get("added_tokens", []))
        )
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.pieces = self.pieces and len(line) == 1
        self.line = line[0] if line else -1
        self.width = 3 if places else 1
        # known word w has the rows at[known[w]] to at[known[w] + 1]
        self.known: dict[str, int] = {"\n": 0}
        self.rows = np.array([[self.line, 0, 1][: self.width]], np.uint32)
        self.at = np.array([0, 1])

    def encode(self, texts: list[str]) -> list[bytes]:
        flat: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        whole = {}
        for i, t in enumerate(texts):
            if t and self.pieces and _plainly_spaced(t):
                flat += t.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
            elif t:
                whole[i] = self._whole(t).tobytes()
            ends[i + 1] = len(flat)
        word = self._look(flat)
        unknown = word < 0
        if unknown.any():
            new = list(dict.fromkeys(compress(flat, unknown.tolist())))
            if len(self.known) + len(new) > self.cache_words:
                self._forget()
                unknown[:] = True
                new = [w for w in dict.fromkeys(flat) if w not in self.known]
            self._learn(new)
            word[unknown] = self._look(list(compress(flat, unknown.tolist())))
        count = self.at[word + 1] - self.at[word]
        until = np.concatenate([[0], np.cumsum(count)])
        rows = self.rows[np.repeat(self.at[word] - until[:-1], count) + np.arange(until[-1])]
        if self.places and len(flat):
            size = np.fromiter(map(len, flat), np.int64, len(flat))
            begin = np.cumsum(size) - size
            text = np.repeat(np.arange(len(texts)), np.diff(ends))
            begin -= begin[ends[:-1].clip(max=len(flat) - 1)][text]
            rows[:, 1:] += np.repeat(begin, count).astype(np.uint32)[:, None]
        packed, cut = rows.astype("<u4").tobytes(), (until[ends] * 4 * self.width).tolist()
        out = [packed[lo:hi] for lo, hi in zip(cut, cut[1:])]
        for i, own in whole.items():
            out[i] = own
        return out

    def _look(self, words: list[str]) -> np.ndarray:
        """Numbers of known words, -1 for others."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def _forget(self) -> None:
        """Make room: the words met first are the frequent ones."""
        keep = max(1, min(self.cache_words * 2 // 3, len(self.known)))
        self.known = dict(islice(self.known.items(), keep))
        self.at = self.at[: keep + 1].copy()
        self.rows = self.rows[: self.at[-1]].copy()

    def _learn(self, words: list[str]) -> None:
        """Encode words joined by line breaks, which are a token of their own."""
        rows, counts = [], []
        lines = ["\n".join(words[lo : lo + FILL]) + "\n" for lo in range(0, len(words), FILL)]
        # the fast way leaves out the places
        encode = self.tokenizer.encode_batch if self.places else self.tokenizer.encode_batch_fast
        for i, made in enumerate(encode(lines, add_special_tokens=False)):
            part = words[i * FILL : (i + 1) * FILL]
            ids = np.array(made.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.line)
            if len(cuts) != len(part):
                own = [self._whole(w) for w in part]
                rows += own
                counts.append(np.array([len(r) for r in own]))
                continue
            count = np.diff(np.concatenate([[-1], cuts]))
            mine = ids[:, None]
            if self.places:  # character spans, counted from the first of the word
                size = np.array([len(w) + 1 for w in part])
                base = np.repeat(np.cumsum(size) - size, count)
                mine = np.column_stack([ids, np.array(made.offsets) - base[:, None]]).astype(np.uint32)
            rows.append(np.delete(mine, cuts, axis=0))
            counts.append(count - 1)
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate(counts))])
        self.rows = np.concatenate([self.rows, *rows])

    def _whole(self, text: str) -> np.ndarray:
        made = self.tokenizer.encode(text, add_special_tokens=False)
        rows = np.empty((len(made.ids), self.width), "<u4")
        rows[:, 0] = made.ids
        if self.places:
            rows[:, 1:] = np.array(made.offsets, np.uint32).reshape(-1, 2)
        return rows
