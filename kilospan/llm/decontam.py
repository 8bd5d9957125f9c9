"""Benchmark decontamination over a distributed positional inverted index.

Index: documents are gathered into segments of bounded size. In a segment every word has a
position; documents lie one after another with a gap no window can cross. The index holds,
per segment and term, the sorted positions of the term (its postings), and per segment the
place and length of each document. Terms are hashed words; postings are kept for the terms
of the test set, which the searches below can ask for.

Search: the windows of a test item are looked up in each segment from their rarest terms
on. Postings of the first term, less its offset in the window, are candidate starts; each
further term intersects them with its own postings less its offset. What is left after all
terms are exact occurrences of the phrase. Rarity is the number of postings in the whole
corpus. Proximity matches start from the rarest term, too, and ask that every other term
has a posting near it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept, plain_words, row_slices, signed, text_bytes

WINDOW = 10
SEGMENT_WORDS = 2_000_000
TEST_BYTES = 256 << 20
DOCUMENTS, PLACES, SIZES = -1, -2, -3  # the kinds of list that describe a segment
INDEX = "segment string, term bigint, postings array<bigint>"


class TestSet:
    """The items' words as term numbers, and their windows.

    The test set is measured before it is gathered: it is a published benchmark and small.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        reader = plain_words()
        self.ids, self.words, terms = [], [], set()
        for item_id, text in items:
            h = signed(reader.read(np.frombuffer(text, np.uint8))[0])
            if len(h):
                self.ids.append(item_id)
                self.words.append(h)
                terms.update(h.tolist())
        self.terms = np.array(sorted(terms), np.int64)
        self.window = window
        self.windows: dict[tuple, list[int]] = {}  # term numbers -> items that have them
        for i, h in enumerate(self.words):
            numbers = np.searchsorted(self.terms, h).tolist()
            size = min(window, len(numbers))
            for a in range(len(numbers) - size + 1):
                found = self.windows.setdefault(tuple(numbers[a : a + size]), [])
                if not found or found[-1] != i:
                    found.append(i)


def test_set(items: DataFrame, window: int = WINDOW, id_col="item_id", text_col="text") -> TestSet:
    """Items without words (a null text has none) have no window. Repeated rows are one
    item; an item id that several texts share is found if any of them is."""
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col)).where(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    )
    size = rows.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    if size > TEST_BYTES:
        raise ValueError(
            f"the test set has {size} bytes; search sets of up to {TEST_BYTES} one by one"
        )
    return TestSet([(r[0], r[1].encode()) for r in rows.distinct().sort(*rows.columns).collect()], window)


def build_index(
    docs: DataFrame, tests: TestSet, id_col: str = "doc_id", text_col: str = "text",
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """The positional index as a written table: rows of ``INDEX``.

    A segment ends once it has ``segment_words`` words, so a list is no longer than that
    plus one document. Documents without words are in the document list, too. Ids must be
    integers. A row with a null id cannot be named in a result and is left out here.
    """
    terms = docs.sparkSession.sparkContext.broadcast(tests.terms)
    gap = tests.window

    def build(batches):
        from pyspark import TaskContext

        part, reader, vocabulary = TaskContext.get().partitionId(), plain_words(), terms.value
        number, waiting, position = 0, [], 0
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in row_slices(at):
                h, first, _ = reader.read(data[at[lo] : at[hi]])
                h = signed(h)
                # the byte before a document ends its last word only if it is a separator
                n, places, numbers = _by_document(reader, data, at, lo, hi, h, first, vocabulary)
                start = position + np.cumsum(n + gap) - n - gap
                waiting.append((ids[lo:hi], start, n, numbers, places + np.repeat(start, n)))
                position += int((n + gap).sum())
                if position >= segment_words:
                    yield _segment(f"{part}-{number}", waiting, len(vocabulary))
                    number, waiting, position = number + 1, [], 0
        if waiting:
            yield _segment(f"{part}-{number}", waiting, len(vocabulary))

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).where(
        F.col(id_col).isNotNull()
    )
    return kept(rows.mapInArrow(build, INDEX), "postings")


def _by_document(reader, data, at, lo, hi, h, first, vocabulary):
    """Words per document, their position in it, and their term numbers (-1: no test term)."""
    edges = at[lo : hi + 1] - at[lo]
    inner = edges[1:-1]
    raw = data[at[lo] : at[hi]]
    glued = inner[(inner > 0) & (inner < len(raw))]
    if len(glued) and (reader.is_word[raw[glued]] & reader.is_word[raw[glued - 1]]).any():
        parts = [reader.read(raw[a:b])[0] for a, b in zip(edges, edges[1:])]
        n = np.array([len(p) for p in parts], np.int64)
        h = signed(np.concatenate(parts)) if n.sum() else np.zeros(0, np.int64)
    else:
        n = np.diff(np.searchsorted(first, edges)).astype(np.int64)
    places = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    if not len(vocabulary):
        return n, places, np.full(len(h), -1)
    found = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return n, places, np.where(vocabulary[found] == h, found, -1)


def _segment(name: str, waiting: list, n_terms: int) -> pa.RecordBatch:
    ids, start, n, numbers, places = (np.concatenate(x) for x in zip(*waiting))
    real = numbers >= 0
    numbers, places = numbers[real], places[real]
    order = np.argsort(numbers, kind="stable")  # positions stay sorted within a term
    numbers, places = numbers[order], places[order]
    terms, at = np.unique(numbers, return_index=True)
    lists = [ids, start, n, *np.split(places, at[1:])] if len(terms) else [ids, start, n]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    postings = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists).astype(np.int64)))
    kinds = np.concatenate([[DOCUMENTS, PLACES, SIZES], terms]).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(kinds)), pa.array(kinds), postings],
        ["segment", "term", "postings"],
    )


def frequencies(index: DataFrame) -> dict[int, int]:
    """Postings per test term in the whole corpus; as many rows as the test set has terms."""
    rows = index.where(F.col("term") >= 0).groupBy("term").agg(F.sum(F.size("postings")))
    return {r[0]: r[1] for r in rows.collect()}


def phrase_starts(postings: dict[int, np.ndarray], window: tuple, order: list[int]) -> np.ndarray:
    """Positions where the window begins: offset-adjusted lists, rarest first."""
    starts = postings[window[order[0]]] - order[0]
    for k in order[1:]:
        if not len(starts):
            break
        other = postings[window[k]]
        at = np.minimum(np.searchsorted(other, starts + k), len(other) - 1)
        starts = starts[other[at] == starts + k]
    return starts


def near_anchors(postings, window: tuple, order: list[int], reach: int) -> np.ndarray:
    """Postings of the rarest term that have every other term within ``reach`` words."""
    anchors = postings[window[order[0]]]
    for k in order[1:]:
        if not len(anchors):
            break
        other = postings[window[k]]
        lo = np.searchsorted(other, anchors - reach)
        anchors = anchors[(lo < len(other)) & (other[np.minimum(lo, len(other) - 1)] <= anchors + reach)]
    return anchors


def _search_segment(postings, tests: TestSet, rarity: dict[int, int], reach: int | None):
    """Per document: words, hit words, items with exact and with close windows."""
    ids, start, n = (postings.pop(k) for k in (DOCUMENTS, PLACES, SIZES))
    end = int((start + n).max()) if len(start) else 0
    change = np.zeros(end + tests.window + 1, np.int32)  # +1 where a hit begins, -1 behind it
    exact: dict[int, set] = {}
    close: dict[int, set] = {}
    for window, items in tests.windows.items():
        if any(t not in postings for t in window):
            continue
        order = sorted(range(len(window)), key=lambda k: (rarity.get(window[k], 0), k))
        starts = phrase_starts(postings, window, order)
        if len(starts):
            np.add.at(change, starts, 1)
            np.add.at(change, starts + len(window), -1)
            for d in np.unique(np.searchsorted(start, starts, "right") - 1).tolist():
                exact.setdefault(d, set()).update(items)
        if reach is not None:
            anchors = near_anchors(postings, window, order, reach)
            for d in np.unique(np.searchsorted(start, anchors, "right") - 1).tolist():
                close.setdefault(d, set()).update(items)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
    n_hit = hit[start + n] - hit[start]
    return ids, n, n_hit, exact, close


def search(
    index: DataFrame, tests: TestSet, reach: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurrence of a
    window), items and near_items (sorted ids of the test items found exactly, or with all
    words of a window within ``reach`` words of its rarest; null if no reach is given).

    A group is one segment, whose size is bounded when it is built. A document without
    words has n_words 0 and no items. Repeated rows are rows of their own.
    """
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((tests, frequencies(index)))

    def look(frame):
        tests, rarity = shared.value
        postings = dict(zip(frame["term"], frame["postings"]))
        ids, n, n_hit, exact, close = _search_segment(postings, tests, rarity, reach)
        rows = range(len(ids))
        named = lambda found, d: sorted({tests.ids[i] for i in found.get(d, ())})
        return pd.DataFrame({
            "doc_id": ids, "n_words": n, "n_hit": n_hit,
            "items": [named(exact, d) for d in rows],
            "near_items": [None if reach is None else named(close, d) for d in rows],
        })

    schema = (
        "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, near_items array<string>"
    )
    return index.groupBy("segment").applyInPandas(look, schema)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, reach: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Index ``docs`` and search it for ``items``; see :func:`search`."""
    tests = test_set(items, window)
    return search(build_index(docs, tests, id_col, text_col), tests, reach)
