"""Byte-level BPE by an index of pair occurrences, and back to text.

The distinct units of a slice of a partition stand behind one another as symbols, bytes at
first, with a gap after every piece that must not be merged over. The index maps the rank
of each mergeable pair to all positions where the pair occurs. Ranks are taken in ascending
order: all occurrences of a pair are merged at once, and the pairs that arise to the left
and right of them are added to the lists of their own ranks. A list may hold positions that
another merge has changed since; they are recognised when its turn comes. A pair that arises
always has a higher rank than the one that made it (checked when the file is read), so one
ascending pass merges every word as if it stood alone.

A unit is what lies between cuts that no context moves: a word with the blank before it.
Units met before are looked up, so a slice only merges what is new to its worker.

Nulls are encoded as empty texts, empty texts have no ids, and equal texts have equal ids.
Texts of any length are encoded whole; a slice is as large as its longest text at least.
"""

from __future__ import annotations

import json
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilospan.llm.common import row_slices, text_bytes
from kilospan.llm.tokens import _plainly_spaced

SLICE = 4 << 20
KNOWN_UNITS = 300_000
# Fixed value: how byte-level BPE cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GAP, GONE = -1, -2
_OPEN: dict[tuple[type, str], object] = {}


def opened(kind: type, path: str):
    """One coder per worker process: what it knows stays known between tasks."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary: printable bytes for themselves,
    the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _read(path: str) -> dict:
    """The tokenizer file, ValueError if it is of another kind than plain byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    model, before = kind["model"], kind.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and model.get("merges")
        and kind.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix",
                      "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in kind.get("added_tokens", []))
    )
    if not plain:
        raise ValueError("not a plain byte-level BPE tokenizer")
    return kind


def _added(kind: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in kind.get("added_tokens", [])}


class Decoder:
    """The bytes of every token, one after the other."""

    def __init__(self, path: str):
        kind, letters = _read(path), byte_letters()
        tokens = {**kind["model"]["vocab"], **_added(kind)}
        self.size = max(tokens.values()) + 1
        spelled = [b""] * self.size
        for token, i in tokens.items():
            known = all(c in letters for c in token)
            spelled[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        ends = np.cumsum([len(s) for s in spelled])
        # an id beyond the vocabulary has no bytes
        self.at = np.concatenate([[0], ends, ends[-1:]])

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 give U+FFFD, as do the
        tokenizers' own decoders."""
        ids = np.minimum(ids, self.size).astype(np.int64)
        count = self.at[ids + 1] - self.at[ids]
        until = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(self.at[ids] - until[:-1], count) + np.arange(until[-1])
        data = self.bytes[take].tobytes()
        cut = until[at].tolist()
        return [data[lo:hi].decode("utf-8", "replace") for lo, hi in zip(cut, cut[1:])]


class PairIndexCoder:
    """Ids of texts. What the last slices held is known by unit, the first met kept longest."""

    def __init__(self, path: str, known_units: int = KNOWN_UNITS):
        import regex

        kind, letters = _read(path), byte_letters()
        vocab: dict[str, int] = kind["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in kind["model"]["merges"]]
        added = _added(kind)
        self.size = size = max([*vocab.values(), *added.values()]) + 1
        self.of_byte = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self._check_order()
        keys = self.left.astype(np.int64) * size + self.right
        self.rank_of = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.rank_of]

        self.pieces = regex.compile(PIECES)
        longest_first = sorted(added, key=len, reverse=True)
        self.added = added
        self.mark = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.known_units = known_units
        self.known: dict[str, int] = {}
        # ids of known units: unit u has ids[at[u] : at[u + 1]]
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _check_order(self) -> None:
        born = np.full(self.size, -1)
        rank = np.arange(len(self.made))
        np.maximum.at(born, self.made, rank)
        if (np.maximum(born[self.left], born[self.right]) >= rank).any():
            raise ValueError("a merge uses a token that a later merge makes")

    # -- text to ids -----------------------------------------------------------

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the n + 1 places where texts begin and end."""
        units: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            units += self._units(text)
            ends[i + 1] = len(units)
        known = self.known
        found = list(map(known.get, units))
        if None in found:
            new = list(dict.fromkeys(compress(units, [f is None for f in found])))
            if len(known) + len(new) > self.known_units:
                self._forget()
                known = self.known
                new = [u for u in dict.fromkeys(units) if u not in known]
            self._learn(new)
            found = list(map(known.get, units))
        unit = np.array(found, np.int64)
        count = self.at[unit + 1] - self.at[unit]
        until = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(self.at[unit] - until[:-1], count) + np.arange(until[-1])
        return self.ids[take], until[ends]

    def _units(self, text: str) -> list[str]:
        if not text:
            return []
        if self.mark is not None and self.mark.search(text):
            parts = self.mark.split(text)
            return list(chain.from_iterable([p] if p in self.added else self._units(p) for p in parts))
        if _plainly_spaced(text):
            return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        return self.pieces.findall(text)

    def _forget(self) -> None:
        """Make room: the units met first are the frequent ones."""
        keep = min(self.known_units // 2, len(self.known))
        self.known = dict(islice(self.known.items(), keep))
        self.at = self.at[: keep + 1].copy()
        self.ids = self.ids[: self.at[-1]].copy()

    def _learn(self, units: list[str]) -> None:
        tokens = [u for u in units if u in self.added]
        plain = [u for u in units if u not in self.added] if tokens else units
        ids, at = self._merged(plain)
        if tokens:
            own = np.array([self.added[t] for t in tokens], np.uint32)
            at = np.concatenate([at, len(ids) + 1 + np.arange(len(own))])
            ids, plain = np.concatenate([ids, own]), plain + tokens
        first = len(self.known)
        self.known.update(zip(plain, range(first, first + len(plain))))
        self.at = np.concatenate([self.at, at[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def _merged(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, none of them empty, and the n + 1 places of the units."""
        if not units:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pieces, n_pieces, cut = [], [], self.pieces.findall
        for u in units:
            if (u[1:] if u[0] == " " else u).isalpha():
                pieces.append(u)
                n_pieces.append(1)
            else:
                mine = cut(u)
                pieces += mine
                n_pieces.append(len(mine))
        data = np.frombuffer("".join(pieces).encode(), np.uint8)
        letters = np.flatnonzero((data & 0xC0) != 0x80)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = letters[np.cumsum(size) - size]  # first byte of each piece

        # symbols with a gap ahead of every piece and one at the end
        n = len(data) + len(pieces) + 1
        begins = np.zeros(len(data), np.int64)
        begins[first] = 1
        place = np.arange(len(data)) + np.cumsum(begins)
        sym = np.full(n, GAP, np.int32)
        sym[place] = self.of_byte[data]
        self._merge(sym)

        per_unit = np.array(n_pieces)
        piece_at = np.append(place[first], n)[np.cumsum(per_unit) - per_unit]
        alive = np.concatenate([[0], np.cumsum(sym >= 0)])
        at = np.append(alive[piece_at], alive[-1])
        return sym[sym >= 0].astype(np.uint32), at

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge. A gap is in no pair."""
        key = a.astype(np.int64) * self.size + b
        slot = np.searchsorted(self.keys, key)
        slot[slot == len(self.keys)] = 0
        hit = (self.keys[slot] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank_of[slot], -1)

    def _merge(self, sym: np.ndarray) -> None:
        """Merge in place: a merged pair leaves its token at the first place."""
        n = len(sym)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        index: dict[int, list[np.ndarray]] = {}

        def add(rank: np.ndarray, where: np.ndarray) -> None:
            """File positions under the ranks of their pairs."""
            order = np.argsort(rank, kind="stable")
            rank, where = rank[order], where[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for hi in [*cuts.tolist(), len(rank)]:
                index.setdefault(int(rank[lo]), []).append(where[lo:hi])
                lo = hi

        rank = self._ranks(sym[:-1], sym[1:])
        start = np.flatnonzero(rank >= 0)
        if len(start):
            add(rank[start], start.astype(np.int32))
        for r in range(len(self.made)):
            lists = index.pop(r, None)
            if lists is None:
                continue
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b, new = self.left[r], self.right[r], self.made[r]
            second = after[at]
            still = (sym[at] == a) & (sym[second] == b)
            if not still.all():
                at, second = at[still], second[still]
                if not len(at):
                    continue
            if a == b and len(at) > 1:
                # of overlapping occurrences every other one, from the left
                place = np.arange(len(at))
                head = np.concatenate([[True], at[1:] != second[:-1]])
                run = np.maximum.accumulate(np.where(head, place, 0))
                odd = (place - run) % 2 == 0
                at, second = at[odd], second[odd]
            beyond = after[second]
            sym[at], sym[second] = new, GONE
            after[at], before[beyond] = beyond, at
            where = np.concatenate([before[at], at])
            rank = self._ranks(sym[where], sym[after[where]])
            arisen = rank >= 0
            if arisen.any():
                add(rank[arisen], where[arisen])


def packed(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of ids as a binary column of little-endian unsigned 32-bit integers."""
    offsets = (at * 4).astype("<i4")
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), data])


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and
    ``n_tokens``. Rows are encoded where they lie; nothing is shuffled."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = opened(PairIndexCoder, path)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_slices(offsets, SLICE):
                part = batch.slice(lo, hi - lo)
                ids, at = coder.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), packed(ids, at), pa.array(np.diff(at), pa.int64())],
                    ["doc_id", "ids", "n_tokens"],
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, n_tokens bigint")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``text``, decoded from the binary column ``ids``, to ``doc_id``, ``ids`` and
    ``n_tokens``. Null ids give an empty text."""
    rows = encoded.select("doc_id", "ids", "n_tokens")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = opened(Decoder, path)
        for batch in batches:
            data, offsets = text_bytes(batch.column("ids"))
            for lo, hi in row_slices(offsets, SLICE):
                part = batch.slice(lo, hi - lo)
                own = data[offsets[lo] : offsets[hi]].view("<u4") if offsets[hi] > offsets[lo] else np.zeros(0, "<u4")
                texts = coder.decode(own, (offsets[lo : hi + 1] - offsets[lo]) // 4)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "n_tokens", "text"]
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, n_tokens bigint, text string")
