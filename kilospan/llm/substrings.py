"""Lines and passages that repeat across documents, found by hashed units, removed but once.

Lines are hashed whole: of a line that repeats, every occurrence but the earliest goes,
whatever its length (``whole_lines``). A line is also cut into phrases of about nine words,
since a passage is often pasted into the middle of a line. Cuts lie where the hash of two
neighbouring words is the least within REACH gaps to either side, so they depend on the
words around them alone and fall alike in every copy. Units are normalised (A-Z lowered,
white space ignored), hashed, and grouped over all documents. The occurrence in the least
document, and there the first, stays. Offsets are code points of the original.

Repeated phrases next to each other make an island. Each of its ends is widened word by
word against the copy that stays, so a passage goes up to its first and last word, and one
whole phrase in it is enough to find it. A widened island of at least ``min_words`` words
is removed. A common run that goes on past the phrase next to an island and REACH + 1 words
would have that phrase in the island, so no more words than these are compared.

Most units are in one document alone, so texts are cut twice. The first time only digests
and ids leave the task, and what repeats is found; the second time a filter of bits leaves
out most other units before rows are written, and a join by digest the rest. A unit knows
some bits of the words next to it: an end of an island where they differ from those in the
copy that stays cannot move, and its words are not asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.llm.common import (
    _powers, kept, mix64, row_slices, seeds, signed, spaced_words, text_bytes,
)

REACH = 4
MIN_WORDS = 20
CHUNK_BITS = 1 << 19  # of the filter in one row
FILTER_BITS = 1 << 29  # at most; a fuller filter lets more units through to the join
UNITS = (
    "digest bigint, doc_id bigint, row_tag int, unit int, word int, start int, end int, "
    "words int, origin int, beside int"
)
AROUND = "doc_id bigint, row_tag int, ask int, hashes array<bigint>, places array<int>"
_PAIR = seeds(2, 41)
_LINE = seeds(1, 43)[0]
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def unit_starts(words: np.ndarray, line: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Numbers of the words that begin a unit. ``line`` changes where a unit must end."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    gap = mix64(words[:-1] * _PAIR[0] + words[1:] * _PAIR[1])
    same = line[:-1] == line[1:]
    gap = np.where(same, gap, _MOST)
    home = line[:-1]
    least = same.copy()
    for s in range(1, reach + 1):
        if s >= n - 1:
            break
        together = home[s:] == home[:-s]
        least[s:] &= ~together | (gap[s:] < gap[:-s])
        least[:-s] &= ~together | (gap[:-s] < gap[s:])
    cut = least | ~same
    return np.concatenate([[0], np.flatnonzero(cut) + 1])


def _texts_apart(texts, reader, reach: int):
    """Per slice of texts: its rows lo..hi, hashes of words, text, line and characters of
    each word, and the first word of each phrase."""
    data, at = text_bytes(texts)
    for lo, hi in row_slices(at):
        raw, edges = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        bounds = _words_apart(reader, raw, edges)
        if bounds is None:
            continue
        words, first, end = bounds
        doc = np.searchsorted(edges, first, "right") - 1
        line = np.concatenate([[0], np.cumsum(raw == 10)])[first] + doc
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        head = chars[edges[doc]]
        yield (
            lo, hi, words, doc, line, chars[first] - head, chars[end] - head,
            unit_starts(words, line, reach),
        )


def _beside(words: np.ndarray, doc: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Seven bits each of the words before and behind units, 0 where the text has none."""
    some = np.append((words >> np.uint64(40)) % np.uint64(127), 0).astype(np.int32) + 1
    home = np.concatenate([[-1], doc, [-1]])  # that of a word is one place to the right
    before = np.where(home[begin] == doc[begin], some[begin - 1], 0)
    return before | np.where(home[stop + 1] == doc[begin], some[stop], 0) << 7


def _units_apart(texts, reader, reach: int, whole_lines: bool):
    """Per slice and kind of unit: the row of each unit, and UNITS but for the ids."""
    for lo, _, words, doc, line, left, right, phrases in _texts_apart(texts, reader, reach):
        up, down = _powers(len(words) + 1)
        run = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=run[1:])
        lines = np.append(0, np.flatnonzero(line[1:] != line[:-1]) + 1)
        kinds = [(phrases, np.uint64(0))] + [(lines, _LINE)] * whole_lines
        for begin, salt in kinds:
            stop = np.append(begin[1:], len(words))
            size = stop - begin
            whole = (run[stop] - run[begin]) * down[begin] + size.astype(np.uint64)
            digest = signed(mix64(whole ^ salt))
            home = doc[begin]
            number = np.arange(len(begin)) - np.searchsorted(home, home, "left")
            if salt:
                number = -1 - number
            order = np.lexsort((begin, digest, home))
            fresh = np.ones(len(begin), bool)
            fresh[1:] = (digest[order[1:]] != digest[order[:-1]]) | (
                home[order[1:]] != home[order[:-1]]
            )
            group = np.maximum.accumulate(np.where(fresh, np.arange(len(begin)), 0))
            first = np.empty(len(begin), np.int64)
            first[order] = order[group]
            beside = _beside(words, doc, begin, stop)
            beside |= np.where(first == np.arange(len(begin)), 0, beside[first] << 14)
            yield lo + home, {
                "digest": digest, "unit": number, "word": begin - np.searchsorted(doc, home, "left"),
                "start": left[begin], "end": right[stop - 1], "words": size,
                "origin": number[first], "beside": beside,
            }


def digest_rows(docs: DataFrame, reach: int = REACH, whole_lines: bool = False) -> DataFrame:
    """The digests of (doc_id, row_tag, text) rows, one each: digest, doc_id."""

    def cut(batches):
        reader = spaced_words()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, unit in _units_apart(batch.column(2), reader, reach, whole_lines):
                fresh = unit["origin"] == unit["unit"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit["digest"][fresh]), pa.array(ids[row[fresh]])], ["digest", "doc_id"]
                )

    return docs.mapInArrow(cut, "digest bigint, doc_id bigint")


def digest_filter(known: DataFrame) -> np.ndarray:
    """Bits, two of which are set for each digest of (known) rows: 16 bits a digest or more
    while there are at most FILTER_BITS. Their number is a power of two."""
    n = max(CHUNK_BITS, min(FILTER_BITS, 1 << (16 * known.count()).bit_length()))

    def fill(rows: pa.Table) -> pa.Table:
        slots = rows.column("slot").to_numpy()
        bits = np.zeros(CHUNK_BITS, bool)
        bits[slots % CHUNK_BITS] = True
        return pa.table({
            "chunk": pa.array([slots[0] // CHUNK_BITS], pa.int64()),
            "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
        })

    slots = known.select(
        F.explode(F.array(*[
            F.shiftrightunsigned("known", 32 * i).bitwiseAND(n - 1) for i in (0, 1)
        ])).alias("slot")
    )
    chunks = slots.groupBy(F.floor(F.col("slot") / CHUNK_BITS)).applyInArrow(
        fill, "chunk bigint, bits binary"
    )
    out = np.zeros(n // 8, np.uint8)
    for r in chunks.toLocalIterator():
        at = r["chunk"] * CHUNK_BITS // 8
        out[at : at + CHUNK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _let_through(bits: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """True for every digest of the filter, and for few others."""
    out = np.ones(len(digest), bool)
    for i in (0, 1):
        slot = (digest.view(np.uint64) >> np.uint64(32 * i)) & np.uint64(8 * len(bits) - 1)
        out &= (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def unit_rows(
    docs: DataFrame, reach: int = REACH, whole_lines: bool = False, among: np.ndarray | None = None
) -> DataFrame:
    """Units of (doc_id, row_tag, text) rows: see UNITS. ``word`` is the number of the first
    word in the text, ``origin`` the first unit of the same digest there, ``beside`` some bits
    of the words before and behind, and of those of the origin if that is another unit. With
    ``whole_lines``, lines are rows too, numbered -1, -2 ...; their digests are never those
    of phrases. ``among`` leaves out units that are not in a filter and have no origin before
    them."""
    held = None if among is None else docs.sparkSession.sparkContext.broadcast(among)

    def cut(batches):
        reader = spaced_words()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            tags = batch.column(1).to_numpy()
            for row, unit in _units_apart(batch.column(2), reader, reach, whole_lines):
                if held is not None:
                    some = _let_through(held.value, unit["digest"]) | (unit["origin"] != unit["unit"])
                    row, unit = row[some], {k: v[some] for k, v in unit.items()}
                columns = {"digest": unit.pop("digest"), "doc_id": ids[row], "row_tag": tags[row]}
                columns |= {k: v.astype(np.int32) for k, v in unit.items()}
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], [*columns])

    return docs.mapInArrow(cut, UNITS)


def words_around(asked: DataFrame, reach: int = REACH) -> DataFrame:
    """Words next to phrases of (doc_id, row_tag, text, asks) rows, the nearest first: see
    AROUND. An ask is twice the number of a phrase, plus 1 for the words behind it; places
    are the outer edges of the words."""

    def look(batches):
        reader = spaced_words()
        for batch in batches:
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            asks = batch.column(3).to_pylist()
            for lo, hi, words, doc, _, left, right, begin in _texts_apart(
                batch.column(2), reader, reach
            ):
                words = signed(words)
                out = [[], [], [], [], []]
                units = np.searchsorted(doc[begin], np.arange(hi - lo + 1))
                inside = np.searchsorted(doc, np.arange(hi - lo + 1))
                begin = np.append(begin, len(words))
                for i in range(hi - lo):
                    for ask in asks[lo + i]:
                        k = int(units[i]) + ask // 2
                        if ask % 2:
                            a = begin[k + 1]
                            b = begin[min(k + 2, units[i + 1])] + reach + 1
                            b = max(a, min(b, inside[i + 1]))
                            found, places = words[a:b], right[a:b]
                        else:
                            b = begin[k]
                            a = max(begin[max(k - 1, units[i])] - reach - 1, inside[i])
                            found, places = words[a:b][::-1], left[a:b][::-1]
                        for column, value in zip(out, (ids[lo + i], tags[lo + i], ask, found, places)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                        pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int64())),
                        pa.array(out[4], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "row_tag", "ask", "hashes", "places"],
                )

    return asked.select("doc_id", "row_tag", "text", "asks").mapInArrow(look, AROUND)


def _words_apart(reader, raw: np.ndarray, edges: np.ndarray):
    """Words of texts that lie one after another; a word never runs into the next text."""
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    if len(inner) and (reader.is_word[raw[inner]] & reader.is_word[raw[inner - 1]]).any():
        parts = [
            tuple(x + (a if i else 0) if i else x for i, x in enumerate(reader.read(raw[a:b])))
            for a, b in zip(edges, edges[1:])
        ]
        out = tuple(np.concatenate(p) for p in zip(*parts))
    else:
        out = reader.read(raw)
    return out if len(out[0]) else None


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids, a tag that tells rows of one id and different texts apart, and texts."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(F.col(text_col)).bitwiseAND(0x7FFFFFFF).cast("int").alias("row_tag"),
        F.col(text_col).alias("text"),
    ).where("doc_id is not null and text is not null")


def _widened(
    islands: DataFrame, holders: DataFrame, rows: DataFrame, reach: int, min_words: int
) -> DataFrame:
    """Islands with both ends moved outwards over all words that are alike in the copy that
    stays: that of the first phrase for the start, that of the last one for the end. Only
    those of at least ``min_words`` words then."""
    home = ["doc_id", "row_tag"]

    def bits(beside, side: int):
        return F.shiftright(beside, 7 * side).bitwiseAND(127)

    def ends(side: int, name: str) -> DataFrame:
        end = F.col(name)
        return islands.select(
            *home, "island", F.lit(side).alias("side"), (end["unit"] * 2 + side).alias("ask"),
            end["digest"].alias("digest"), end["origin"].alias("origin"),
            bits(end["beside"], side).alias("near"),
            bits(end["beside"], 2 + side).alias("origin_near"),
        ).where("near > 0")

    edges = ends(0, "head").union(ends(1, "tail"))
    held = holders.select(
        F.col("digest").alias("known"), "first_doc_id", "first_tag", "first_unit", "first_beside"
    )
    first_near = F.when(F.col("side") == 0, bits("first_beside", 0)).otherwise(bits("first_beside", 1))
    across = edges.where("origin is null").join(
        held, (F.col("digest") == F.col("known")) & (F.col("near") == first_near)
    ).select(
        *home, "island", "side", "ask", "first_doc_id", "first_tag",
        (F.col("first_unit") * 2 + F.col("side")).alias("first_ask"),
    )
    inside = edges.where("origin is not null and near = origin_near").select(
        *home, "island", "side", "ask", F.col("doc_id").alias("first_doc_id"),
        F.col("row_tag").alias("first_tag"),
        (F.col("origin") * 2 + F.col("side")).alias("first_ask"),
    )
    pairs = kept(across.union(inside), "edges")
    asks = kept(
        pairs.select(*home, "ask").union(pairs.select("first_doc_id", "first_tag", "first_ask"))
        .groupBy(*home).agg(F.collect_set("ask").alias("asks")),
        "asks",
    )
    asked = rows.join(asks, home)
    around = kept(words_around(asked, reach), "around").dropDuplicates([*home, "ask"])
    theirs = around.select(
        F.col("doc_id").alias("first_doc_id"), F.col("row_tag").alias("first_tag"),
        F.col("ask").alias("first_ask"), F.col("hashes").alias("their_hashes"),
    )
    both = pairs.join(around, [*home, "ask"]).join(
        theirs, ["first_doc_id", "first_tag", "first_ask"]
    )
    alike = F.zip_with("hashes", "their_hashes", lambda x, y: x.eqNullSafe(y))
    unlike = F.array_position(alike, F.lit(False)).cast("int")
    both = both.withColumn("more", F.when(unlike > 0, unlike - 1).otherwise(F.size(alike)))
    place = F.when(F.col("more") > 0, F.try_element_at("places", F.greatest("more", F.lit(1))))
    moved = both.withColumn("place", place).groupBy(*home, "island").agg(
        *[
            F.max(F.when(F.col("side") == i, F.col(c))).alias(f"{c}_{i}")
            for c in ("more", "place") for i in (0, 1)
        ]
    )
    return islands.join(moved, [*home, "island"], "left").select(
        *home, F.coalesce("place_0", "start").alias("start"), F.coalesce("place_1", "end").alias("end"),
        (F.col("word") - F.coalesce("more_0", F.lit(0))).alias("word"),
        (F.col("stop") + F.coalesce("more_1", F.lit(0))).alias("stop"),
        F.col("head")["first_doc_id"].alias("first_doc_id"),
    ).where(F.col("stop") - F.col("word") >= min_words)


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
    reach: int = REACH, whole_lines: bool = False,
) -> DataFrame:
    """One row per span to remove: doc_id, row_tag, start and end (code points of the
    original text), n_words, first_doc_id (the document whose copy of its first unit stays).

    Passages of ``min_words`` words or more; with ``whole_lines``, also every repeated line.
    Null and empty texts and rows with a null id have no spans and keep nothing from being
    removed. Rows that share an id are one document: they are not held against each other.
    """
    rows = _rows(docs, id_col, text_col)
    known = kept(
        digest_rows(rows, reach, whole_lines).groupBy(F.col("digest").alias("known")).agg(
            F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id")
        ).where("first_doc_id != last_doc_id").drop("last_doc_id"),
        "known",
    )
    units = unit_rows(rows, reach, whole_lines, digest_filter(known))
    matched = kept(
        units.join(known, F.col("digest") == F.col("known"), "left").drop("known")
        .where("first_doc_id is not null or origin != unit"),
        "matched",
    )
    columns = ["digest", "doc_id", "row_tag", "unit", "word", "start", "end", "words", "beside", "first_doc_id"]
    across = matched.where("origin = unit and doc_id != first_doc_id").select(
        *columns, F.lit(None).cast("int").alias("origin")
    )
    inside = matched.where("origin != unit").select(
        *columns[:-1], F.col("doc_id").alias("first_doc_id"), "origin"
    )
    home = ["doc_id", "row_tag"]
    order = Window.partitionBy(*home).orderBy("unit")
    again = across.union(inside)
    once = again.where("unit >= 0").withColumn("last", F.lag("unit").over(order)).where(
        "last is null or last != unit"  # a repeated row has its units again
    )
    end = F.struct("first_doc_id", "digest", "unit", "origin", "beside")
    islands = kept(
        once.withColumn("island", F.col("unit") - F.row_number().over(order))
        .groupBy(*home, "island")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.min("word").alias("word"),
            F.max(F.col("word") + F.col("words")).alias("stop"),
            F.min_by(end, "unit").alias("head"), F.max_by(end, "unit").alias("tail"),
        ),
        "islands",
    )
    holders = matched.where("doc_id = first_doc_id and origin = unit and unit >= 0").groupBy(
        "digest", "first_doc_id"
    ).agg(F.min(F.struct("row_tag", "unit", "beside")).alias("at")).select(
        "digest", "first_doc_id", F.col("at.row_tag").alias("first_tag"),
        F.col("at.unit").alias("first_unit"), F.col("at.beside").alias("first_beside"),
    )
    spans = _widened(islands, holders, rows, reach, min_words)
    if whole_lines:
        spans = spans.union(
            again.where("unit < 0").select(
                *home, "start", "end", "word", (F.col("word") + F.col("words")).alias("stop"),
                "first_doc_id",
            )
        )
    # spans that overlap or follow each other are one
    order = Window.partitionBy(*home).orderBy("word", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = spans.withColumn("apart", F.coalesce((F.col("word") > before).cast("int"), F.lit(1)))
    return (
        apart.withColumn("span", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*home, "span")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"),
            (F.max("stop") - F.min("word")).cast("bigint").alias("n_words"),
            F.min_by("first_doc_id", "word").alias("first_doc_id"),
        )
        .drop("span")
    )


def without_spans(
    docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with their spans cut out, each with the blank or line break behind it.

    Every row and column stays; a text that is all repeats becomes empty, a null text stays
    null, and n_chars (if there is such a column) is counted anew where a text changed.
    """
    parts = spans.groupBy("doc_id", "row_tag").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans")
    ).select(F.col("doc_id").alias("__id"), F.col("row_tag").alias("__tag"), "__spans")
    tag = F.xxhash64(F.col(text_col)).bitwiseAND(0x7FFFFFFF).cast("int")
    found = docs.join(
        parts, (docs[id_col].cast("bigint") == parts["__id"]) & (tag == parts["__tag"]), "left"
    )
    size = F.char_length(docs[text_col])
    behind = F.transform(  # a blank or line break behind a span goes with it
        "__spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            (s["end"] + F.substring(docs[text_col], s["end"] + 1, F.lit(1)).rlike(r"\s").cast("int")).alias("end"),
        ),
    )
    edges = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), behind)
    ends = F.concat(F.transform("__spans", lambda s: s["start"]), F.array(size))
    pieces = F.zip_with(
        edges, ends, lambda s, e: F.substring(docs[text_col], s["end"] + 1, e - s["end"])
    )
    text = F.when(F.col("__spans").isNull(), docs[text_col]).otherwise(F.array_join(pieces, ""))
    out = found.withColumn("__text", text)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("__text").alias(c))
        elif c == "n_chars":
            counted = F.char_length("__text").cast(docs.schema[c].dataType)
            columns.append(F.when(F.col("__spans").isNull(), docs[c]).otherwise(counted).alias(c))
        else:
            columns.append(docs[c])
    return out.select(*columns)
