"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

1. Signatures. A document is the set of its word shingles. A signature has SYMBOLS symbols
   of 16 bits, one per random order of the shingles; two sets of similarity J differ in a
   symbol with probability 1 - J. Equal sets become one class with one representative.
2. Index. The signature is split into CHUNKS chunks. If two signatures differ in at most
   ``THRESHOLD`` symbols, some chunk differs in at most ERRORS of them (pigeonhole). So
   every chunk is entered once for each choice of ERRORS symbols left out, and all pairs
   under the threshold meet in a key. A link exceeds the threshold with a probability of
   3.3e-6 at J = 0.80 and 1.3e-8 at J = 0.85, less above.
3. Links. In a key, the most central member is a pivot; every member is compared with it,
   and with the NEAREST others by signature. Comparisons of signatures are arrays in blocks;
   only these few pairs per member go on to the full sets. They connect families, with an
   original or without. Then all pairs under the threshold that are still in different
   components are compared by a second signature of LONG symbols, in the first key they
   share. It is made of the few texts that are left; a link exceeds its threshold with a
   probability below LONG_MISS, and pairs clearly less alike than a link mostly do. What
   remains, and could be a link by its sizes, goes on: first the NEAREST of each member in
   other components, then, as long as components are left apart, all others. So a large
   family costs a few comparisons of sets per member, and no pair that could connect
   anything is skipped.
4. Components of the links, joined back to all documents.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept, mix64, row_slices, seeds, signed, spaced_words, text_bytes
from kilospan.llm.components import components

SHINGLE = 5
CHUNKS = 12
CHUNK = 4
ERRORS = 1
SYMBOLS = CHUNKS * CHUNK
THRESHOLD = CHUNKS * (ERRORS + 1) - 1
NEAREST = 4
BLOCK = 1000
LONG = 768
LONG_MISS = 1e-9
BROADCAST_IDS = 2_000_000
_OUT = list(combinations(range(CHUNK), ERRORS))
_CHOICES = [
    [c * CHUNK + i for i in range(CHUNK) if i not in out] for c in range(CHUNKS) for out in _OUT
]
SIGNATURE = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, signature binary"


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words are one run."""
    if len(words) == 0:
        return words
    n = min(width, len(words))
    mix = seeds(width, 11 + n)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out += words[i : len(words) - n + 1 + i] * mix[i]
    return mix64(out)


def shingle_sets(data: np.ndarray, at: np.ndarray, lo: int, hi: int, width: int = SHINGLE):
    """The sorted distinct shingle hashes of each text lo..hi."""
    reader = spaced_words()
    raw, edges = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    if len(inner) and (reader.is_word[raw[inner]] & reader.is_word[raw[inner - 1]]).any():
        parts = [reader.read(raw[a:b])[0] for a, b in zip(edges, edges[1:])]
    else:
        h, first, _ = reader.read(raw)
        cuts = np.searchsorted(first, edges)
        parts = [h[a:b] for a, b in zip(cuts, cuts[1:])]
    return [np.unique(shingle_hashes(p, width)) for p in parts]


def signature_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE
) -> DataFrame:
    """doc_id, size and digest of the set, signature; documents without words have size 0."""
    mask, scale = seeds(SYMBOLS, 21), seeds(SYMBOLS, 22)

    def sign(batches):
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                sets = shingle_sets(data, at, lo, hi, width)
                n = np.array([len(s) for s in sets], np.int64)
                real = np.flatnonzero(n)
                signature = np.zeros((hi - lo, SYMBOLS), "<u2")
                if len(real):
                    every = np.concatenate([sets[i] for i in real])
                    begin = np.cumsum(n[real]) - n[real]
                    for j in range(SYMBOLS):
                        least = np.minimum.reduceat((every ^ mask[j]) * scale[j], begin)
                        signature[real, j] = mix64(least) >> np.uint64(48)
                digest = np.frombuffer(
                    b"".join(hashlib.blake2b(s, digest_size=16).digest() for s in sets), "<i8"
                ).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(n),
                        pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "signature"],
                )

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(sign, SIGNATURE)


def _keys_of(rows: np.ndarray) -> np.ndarray:
    """A row of keys per choice of symbols, for signatures as 64-bit numbers."""
    keys = np.zeros((len(_CHOICES), len(rows)), np.uint64)
    for k, (choice, salt) in enumerate(zip(_CHOICES, seeds(len(_CHOICES), 31))):
        for c in choice:
            keys[k] = (keys[k] << np.uint64(16)) | rows[:, c]
        keys[k] = mix64(keys[k] ^ salt)
    return keys


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, id): one row per chunk and choice of ERRORS symbols left out."""
    def enter(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2")
            rows = rows.reshape(len(ids), SYMBOLS).astype(np.uint64)
            step = 4096
            for lo in range(0, len(ids), step):
                keys = _keys_of(rows[lo : lo + step])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(keys.ravel())),
                        pa.array(np.tile(ids[lo : lo + step], len(keys))),
                    ],
                    ["key", "id"],
                )

    return classes.select("id", "signature").mapInArrow(enter, "key bigint, id bigint")


def long_threshold(percent: int) -> int:
    """In how many of LONG symbols a link differs at most, but for a chance of LONG_MISS."""
    differ = 1 - percent / 100
    log = [
        math.lgamma(LONG + 1) - math.lgamma(k + 1) - math.lgamma(LONG - k + 1)
        + k * math.log(differ) + (LONG - k) * math.log1p(-differ)
        for k in range(LONG + 1)
    ]
    tail = 0.0
    for k in range(LONG, 0, -1):
        tail += math.exp(log[k])
        if tail > LONG_MISS:
            return k
    return 0


def long_signatures(texts: DataFrame, width: int = SHINGLE) -> DataFrame:
    """id, size of the set, and LONG symbols of 8 bits of it; of texts that have words."""
    mask, scale = seeds(LONG, 41), seeds(LONG, 42)

    def sign(batches):
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                sets = shingle_sets(data, at, lo, hi, width)
                n = np.array([len(s) for s in sets], np.int64)
                real = np.flatnonzero(n)
                out = np.zeros((len(real), LONG), np.uint8)
                if len(real):
                    every = np.concatenate([sets[i] for i in real])
                    begin = np.cumsum(n[real]) - n[real]
                    for j in range(LONG):
                        least = np.minimum.reduceat((every ^ mask[j]) * scale[j], begin)
                        out[:, j] = mix64(least) >> np.uint64(56)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array(real)), pa.array(n[real]),
                        pa.array([row.tobytes() for row in out], pa.binary()),
                    ],
                    ["id", "size", "long"],
                )

    return texts.select("id", "text").mapInArrow(sign, "id bigint, size bigint, long binary")


def _close(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are under the threshold."""
    one = classes.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    two = classes.select(F.col("id").alias("b"), F.col("signature").alias("sb"))

    def close(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sa, sb = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, SYMBOLS)
                for i in (2, 3)
            )
            keep = pa.array((sa != sb).sum(axis=1) <= THRESHOLD)
            yield batch.select([0, 1]).filter(keep)

    signed_pairs = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")
    return signed_pairs.mapInArrow(close, "a bigint, b bigint")


def _judged(near: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(a, b, shared, total) of the full shingle sets of each pair."""

    def judge(batches):
        for batch in batches:
            known: dict[bytes, np.ndarray] = {}
            shared, total = [], []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sets = []
                for t in (ta, tb):
                    t = t.encode()
                    if t not in known:
                        if len(known) > 200:
                            known.clear()
                        raw = np.frombuffer(t, np.uint8)
                        known[t] = shingle_sets(raw, np.array([0, len(raw)]), 0, 1, width)[0]
                    sets.append(known[t])
                both = len(np.intersect1d(*sets, assume_unique=True))
                shared.append(both)
                total.append(len(sets[0]) + len(sets[1]) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                ["a", "b", "shared", "total"],
            )

    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    full = near.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    return full.mapInArrow(judge, "a bigint, b bigint, shared bigint, total bigint")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the given ids, written once. The ids are broadcast while they are few."""
    n = ids.count()
    side = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    rows = docs.join(side, docs["doc_id"] == ids["id"]).select("id", "text")
    return kept(rows, "texts")


def links(docs: DataFrame, classes: DataFrame, percent: int = 85, width: int = SHINGLE) -> DataFrame:
    """(a, b): representatives whose sets have 100 * shared >= percent * total, enough of
    them to connect every two classes that links connect."""
    entries = kept(index_keys(classes), "keys")
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = kept(
        entries.join(sizes.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).drop("k"),
        "shared",
    )
    # how central a member is: the original of a family is in more of its keys than a copy
    # that differs from it here and there. The fraction parts equals.
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    weights = shared.groupBy("id").agg((F.sum("n") + F.first(part)).alias("weight"))
    members = kept(shared.join(weights, "id"), "members")
    texts = _texts_of(docs, members.select("id").distinct())
    linked = F.col("shared") * 100 >= F.col("total") * percent

    first = _close(_pivot_pairs(members), classes).union(_block_pairs(members, classes, NEAREST))
    found = kept(_judged(first.distinct(), texts, width).where(linked).select("a", "b"), "links")
    rest = _apart(members.select("key", "id", "n"), found)
    left = rest.select("id").distinct()
    signed = kept(long_signatures(texts.join(left, "id", "left_semi"), width), "long")
    classes = classes.select("id", "signature").join(signed, "id")
    for nearest in (NEAREST, None):
        pairs = _block_pairs(rest, classes, nearest, percent)
        more = kept(_judged(pairs.distinct(), texts, width).where(linked).select("a", "b"), "links")
        found = found.union(more)
        if nearest is not None:
            rest = _apart(members.select("key", "id", "n"), found)
    return found


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the keys in which components meet, with the component as their label."""
    labels = components(found).withColumnRenamed("node", "id")
    labelled = kept(
        members.join(labels, "id", "left").select(
            "key", "id", "n", F.coalesce("component", "id").alias("label")
        ),
        "labelled",
    )
    apart = labelled.groupBy("key").agg(
        F.min("label").alias("x"), F.max("label").alias("y")
    ).where("x != y").select(F.col("key").alias("k"))
    return kept(labelled.join(apart, F.col("key") == F.col("k")).drop("k"), "apart")


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """(a, b): the most central member of each key, and each other member."""
    heads = members.groupBy("key").agg(F.max_by("id", "weight").alias("pivot"))
    heads = heads.withColumnRenamed("key", "k")
    pairs = members.join(heads, F.col("key") == F.col("k")).where("id != pivot")
    return pairs.select(
        F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")
    ).distinct()


def _block_pairs(
    members: DataFrame, classes: DataFrame, nearest: int | None = None, percent: int | None = None
) -> DataFrame:
    """Pairs that share a key and whose signatures are under the threshold: of each member
    with its ``nearest`` ones, or all, and these in the first key they share alone. Members
    with a label meet those of other labels only. With ``percent``, pairs must be near by
    their long signatures too, could be links by the sizes of their sets, and stand in the
    first key they share in any case. The members of a large key are dealt to pairs of
    blocks, so no task holds more than two blocks."""
    blocks = F.ceil(F.col("n") / BLOCK)
    label = F.col("label") if "label" in members.columns else F.col("id")
    long = ["size", "long"] if percent is not None else []
    dealt = members.select(
        "key", "id", F.pmod(F.xxhash64("id"), blocks).alias("block"), blocks.alias("blocks"),
        label.alias("label"),
    ).join(classes.select("id", "signature", *long), "id")
    spread = dealt.select(
        "key", "id", "block", "signature", "label", *long,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"),
    ).select(
        "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "id", "block", "signature", "label", *long,
    )
    group = ["key", "x", "y"]
    return spread.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        partial(_compare_groups, nearest=nearest, percent=percent), "a bigint, b bigint"
    )


def _compare_groups(batches, nearest, percent):
    """Rows (key, x, y, id, block, signature, label, size, long) sorted by group."""
    waiting = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
        groups = np.stack([waiting.column(i).to_numpy() for i in range(3)], axis=1)
        last = np.flatnonzero((groups != groups[-1]).any(axis=1))
        done = int(last[-1]) + 1 if len(last) else 0
        yield _pairs_of(waiting.slice(0, done), groups[:done], nearest, percent)
        waiting = waiting.slice(done)
    if waiting is not None:
        groups = np.stack([waiting.column(i).to_numpy() for i in range(3)], axis=1)
        yield _pairs_of(waiting, groups, nearest, percent)


def _choice_of(keys: np.ndarray, signatures: np.ndarray) -> np.ndarray:
    """Which choice of symbols made each of these keys."""
    return (signed(_keys_of(signatures.astype(np.uint64))) == keys).argmax(axis=0)


def _first_key(differ: np.ndarray) -> np.ndarray:
    """The first choice that two signatures share, from where they differ."""
    by_chunk = differ.reshape(len(differ), CHUNKS, CHUNK)
    chunk = (by_chunk.sum(axis=2) <= ERRORS).argmax(axis=1)
    inside = by_chunk[np.arange(len(differ)), chunk]
    kept_symbols = np.stack([inside[:, [i for i in range(CHUNK) if i not in out]].any(axis=1) for out in _OUT])
    return chunk * len(_OUT) + (~kept_symbols).argmax(axis=0)


def _pairs_of(
    rows: pa.Table, groups: np.ndarray, nearest: int | None, percent: int | None
) -> pa.RecordBatch:
    a, b = [], []
    if len(groups):
        size_of = long = None
        if percent is not None:
            size_of = rows.column(7).to_numpy()
            long = np.frombuffer(b"".join(rows.column(8).to_pylist()), np.uint8).reshape(-1, LONG)
            most = long_threshold(percent)

        def could_link(i, j):
            """Which pairs of rows may be links by size and long signature."""
            ok = np.minimum(size_of[i], size_of[j]) * 100 >= np.maximum(size_of[i], size_of[j]) * percent
            ok[ok] = _differing(long, i, j, ok) <= most
            return ok

        ids, block, label = (rows.column(i).to_numpy() for i in (3, 4, 6))
        signature = np.frombuffer(b"".join(rows.column(5).to_pylist()), "<u2").reshape(-1, SYMBOLS)
        edges = np.flatnonzero((groups[1:] != groups[:-1]).any(axis=1)) + 1
        first, size = np.append(0, edges), np.diff(np.concatenate([[0], edges, [len(groups)]]))
        # most keys have two members: all of these at once
        two = first[size == 2]
        differ = signature[two] != signature[two + 1]
        near = (differ.sum(axis=1) <= THRESHOLD) & (label[two] != label[two + 1])
        near &= (groups[two, 1] == groups[two, 2]) | (block[two] != block[two + 1])
        near &= ids[two] != ids[two + 1]
        once = nearest is None or percent is not None
        if once:
            near &= _first_key(differ) == _choice_of(groups[two, 0], signature[two])
        two = two[near]
        if percent is not None:
            two = two[could_link(two, two + 1)]
        a += np.minimum(ids[two], ids[two + 1]).tolist()
        b += np.maximum(ids[two], ids[two + 1]).tolist()
        for lo, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            hi, across, choice = lo + n, groups[lo, 1] != groups[lo, 2], None
            most_of = None
            if percent is not None and nearest is not None:
                # members of the largest component wait for the others to find them
                names, counts = np.unique(label[lo:hi], return_counts=True)
                most_of = names[counts.argmax()]
            for i in range(lo, hi):
                if most_of is not None and label[i] == most_of:
                    continue
                differ = signature[i] != signature[lo:hi]
                apart = differ.sum(axis=1)
                near = (apart <= THRESHOLD) & (label[lo:hi] != label[i])
                if across:
                    near &= block[lo:hi] != block[i]
                if nearest is None:
                    near &= ids[lo:hi] > ids[i]
                found = np.flatnonzero(near)
                if once and len(found):
                    if choice is None:
                        choice = _choice_of(groups[lo : lo + 1, 0], signature[lo : lo + 1])[0]
                    found = found[_first_key(differ[found]) == choice]
                if percent is not None and len(found):
                    found = found[could_link(np.full(len(found), i), lo + found)]
                if nearest is not None and len(found) > nearest:
                    far = apart[found]
                    if percent is not None:
                        far = (long[i] != long[lo + found]).sum(axis=1)
                    found = found[np.argsort(far, kind="stable")[:nearest]]
                a += np.minimum(ids[i], ids[lo:hi][found]).tolist()
                b += np.maximum(ids[i], ids[lo:hi][found]).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    )


def _differing(long: np.ndarray, i: np.ndarray, j: np.ndarray, some: np.ndarray) -> np.ndarray:
    """In how many symbols the chosen pairs of rows differ, some thousand pairs at a time."""
    i, j = i[some], j[some]
    step = 4096
    parts = [(long[i[lo : lo + step]] != long[j[lo : lo + step]]).sum(axis=1) for lo in range(0, len(i), step)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    width: int = SHINGLE,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable over
    links), kept (doc_id is its component_id).

    A null or empty text has no shingles and is linked with nothing. Rows that share an id
    are one node of the graph. A row with a null id cannot be named: its component_id is
    null and it is kept.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signatures = kept(signature_rows(rows, width=width), "signatures")
    named = signatures.where("n_shingles > 0 and doc_id is not null")
    classes = kept(
        named.groupBy("d1", "d2").agg(
            F.min("doc_id").alias("id"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    # an id that several texts share joins their classes
    shared_id = named.groupBy("doc_id").agg(
        F.min("d1").alias("x"), F.max("d1").alias("y")
    ).where("x != y").select("doc_id")
    ids = named.select("doc_id", "d1", "d2").join(shared_id, "doc_id").join(
        classes.select("d1", "d2", "id"), ["d1", "d2"]
    )
    edges = links(rows, classes, percent, width).union(
        ids.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    )
    found = components(edges)
    label = classes.select("d1", "d2", "id").join(
        found.withColumnRenamed("node", "id"), "id", "left"
    ).select("d1", "d2", F.coalesce("component", "id").alias("label"))
    joined = signatures.join(label, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
