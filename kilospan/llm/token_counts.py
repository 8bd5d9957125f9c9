"""Token counts of the sections of a document, from one encoding of the whole text.

Encoding sections one by one gives other counts, since tokens may reach over an edge. Here
the whole text is encoded once with the character span of every token, and spans are
joined to sections by interval. A token that crosses an edge goes to one section by rule:

- ``start``: the section that holds its first character;
- ``most``: the section that holds most of its characters, the earlier one in a tie.

A token whose deciding characters lie in no section is counted as outside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import row_slices, text_bytes
from kilospan.llm.tokens import coder

RULES = ("start", "most")
_EDGE = re.compile(r"\n|(?<=[.!?]) ")


def sentence_sections(text: str) -> list[tuple[int, int]]:
    """Lines, and within them sentences: an edge lies after every line break and after a
    space behind ``.``, ``!`` or ``?``. The sections cover the text."""
    cuts = [0, *(m.end() for m in _EDGE.finditer(text))]
    if cuts[-1] != len(text):
        cuts.append(len(text))
    return list(zip(cuts, cuts[1:]))


def allocate(starts, ends, first, last, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Section number of every token span (-1: none), and whether the token crosses an edge.

    Sections [first, last) are sorted and do not overlap. The interval join is a binary
    search: all tokens of a document against its section edges at once.
    """
    n = len(first)
    if n == 0:
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    at = np.searchsorted(first, starts, "right") - 1
    inside = (at >= 0) & (starts < last[np.maximum(at, 0)])
    whole = inside & (ends <= last[np.maximum(at, 0)])
    nxt = np.minimum(at + 1, n - 1)
    touches = inside | ((at + 1 < n) & (first[nxt] < ends))
    crosses = touches & ~whole
    if rule == "start":
        return np.where(inside, at, -1), crosses
    chosen = np.where(whole, at, -1)
    for t in np.flatnonzero(crosses):  # a token may reach over several sections
        lo, hi = max(int(at[t]), 0), int(np.searchsorted(first, ends[t], "left"))
        share = np.minimum(last[lo:hi], ends[t]) - np.maximum(first[lo:hi], starts[t])
        chosen[t] = lo + int(np.argmax(share)) if len(share) and share.max() > 0 else -1
    return chosen, crosses


def section_tokens(
    docs: DataFrame, tokenizer: str, rule: str = "start", sections_col: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per section: doc_id, section (from 0), first and end character, n_tokens,
    n_crossing (those of them that reach over an edge); section -1 counts tokens outside.

    ``sections_col`` holds an array of structs (start, end) in characters, sorted and
    disjoint; without it, lines and sentences are the sections. A null or empty text has
    one row: section 0 without tokens. Null ids and repeated rows are rows like others.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind}, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
    )
    columns = [F.col(id_col), F.col(text_col)]
    if sections_col:
        columns.append(F.col(sections_col))

    def count(batches):
        encode = coder(tokenizer, True).encode
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(1).to_pylist()]
                given = part.column(2).to_pylist() if sections_col else None
                out = []
                for row, (text, packed) in enumerate(zip(texts, encode(texts))):
                    if given is None:
                        edges = sentence_sections(text)
                    else:
                        edges = [(s["start"], s["end"]) for s in given[row] or () if s]
                    out.append(_counted(row, packed, edges or [(0, 0)], rule))
                rows = np.concatenate(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows[:, 0])),
                        pa.array(rows[:, 1].astype(np.int32)),
                        *[pa.array(np.ascontiguousarray(rows[:, c])) for c in (2, 3, 4, 5)],
                    ],
                    ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
                )

    return docs.select(*columns).mapInArrow(count, schema)


def _counted(row: int, packed: bytes, edges: list[tuple[int, int]], rule: str) -> np.ndarray:
    spans = np.frombuffer(packed, "<u4").reshape(-1, 3).astype(np.int64)
    first, last = np.array(edges, np.int64).T
    chosen, crosses = allocate(spans[:, 1], spans[:, 2], first, last, rule)
    n = np.bincount(chosen + 1, minlength=len(first) + 1)
    c = np.bincount((chosen + 1)[crosses], minlength=len(first) + 1)
    number = np.arange(-1, len(first))
    rows = np.stack(
        [np.full(len(n), row), number, np.r_[-1, first], np.r_[-1, last], n, c], axis=1
    )
    return rows if n[0] else rows[1:]
