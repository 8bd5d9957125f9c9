"""How far the sources of a language lie apart in their words, priced on shared count trees.

Every (language, source) group has a count per kept term of the language, and a smoothed
share p in whole billionths. A group's counts are a segment tree over term ids: leaves are
counts, a node is its two halves. Nodes are hash-consed over all groups of a language, so
equal count subtrees are one node with one number. The divergence of two groups is found by
walking both trees at once: a pair of nodes met twice is priced once, level by level, and
what it cost is added wherever the pair occurs.

A tree over all terms of a language would be one task's work. Term ids are therefore dealt
into segments of a bounded number of terms, by hash, each with a subtree of its own, and the
pairs of groups into pairs of blocks of groups. What a segment adds to a pair of groups is
added up by Spark. In a segment ids follow falling total counts, so that rare terms, most of
whose counts are 0 or 1, lie side by side and share nodes.

All arithmetic is in whole numbers. Null text, language and source are read as empty. Groups
without terms take part with counts of 0. Each row is a document: rows that are repeated
count again. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilospan.llm.common import kept

LEAST_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SEGMENT_TERMS = 2048
BLOCK_GROUPS = 32
PAIRS_AT_ONCE = 128
HELD_TERMS = 400_000
SMALL_TABLE = 100_000
TERM = re.compile(rb"[a-z\x80-\xff]+")


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences in ``docs`` documents. Every group
    has a row of the empty term, so that groups without terms are known.

    Tasks add up what they read and pass it on when it has grown to a fixed size.
    """
    rows = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    names = ["lang", "source", "term", "n", "docs"]

    def flush(held):
        columns = [[] for _ in names]
        for (lang, source), (n, docs_with) in held.items():
            for term, count in n.items():
                for column, x in zip(columns, (lang, source, term.decode(), count, docs_with[term])):
                    column.append(x)
        held.clear()
        types = [pa.string()] * 3 + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches):
        held = defaultdict(lambda: (Counter(), Counter()))
        new = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, docs_with = held[lang, source]
                mine = Counter(TERM.findall(text.encode().lower()))
                before = len(n)
                n[b""] += 1
                for term, count in mine.items():
                    n[term] += count
                docs_with.update(mine.keys())
                new += len(n) - before
                if new > HELD_TERMS:
                    yield flush(held)
                    new = 0
        yield flush(held)

    parts = rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    # dealt by (lang, term), so that the totals of a term need no exchange of their own
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def with_totals(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Counts of the kept terms with ``total``, the count in the whole language, and ``once``,
    true in one row per language and term. Rows of the empty term stay, with counts of 0."""
    of_term = Window.partitionBy("lang", "term")
    known = counts.withColumns(
        {
            "total": F.sum("n").over(of_term),
            "__docs": F.sum("docs").over(of_term),
            "__no": F.row_number().over(of_term.orderBy("source")),
        }
    )
    word = F.col("term") != ""
    return known.where(~word | (F.col("__docs") >= least_docs)).select(
        "lang", "source", "term",
        F.when(word, F.col("n")).otherwise(0).alias("n"),
        F.when(word, F.col("total")).otherwise(0).alias("total"),
        (word & (F.col("__no") == 1)).alias("once"),
    )


def group_table(counted: DataFrame) -> DataFrame:
    """Per group: ``gid`` (from 0 in its language), ``size`` (its terms), and of its language
    ``lang_size``, ``v`` (kept terms), ``groups`` and ``segments``."""
    sizes = counted.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.count_if("once").alias("__v")
    )
    whole = Window.partitionBy("lang")  # one row per source
    return sizes.withColumns(
        {
            "gid": F.row_number().over(whole.orderBy("source")) - 1,
            "lang_size": F.sum("size").over(whole),
            "v": F.sum("__v").over(whole),
            "groups": F.count(F.lit(1)).over(whole).cast("int"),
        }
    ).withColumn(
        "segments", F.greatest(F.ceil(F.col("v") / SEGMENT_TERMS), F.lit(1)).cast("bigint")
    ).drop("__v")


def _sized(table: DataFrame) -> DataFrame:
    """Broadcast up to a fixed number of short rows; beyond it, joined by key."""
    return F.broadcast(table) if table.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE else table


def share_sql(count: str, size: str, v: str = "v") -> str:
    """1 + floor(SCALE * (count + 1) / (size + v)), exact beyond 64 bits."""
    up = f"CAST({count} + 1 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return f"1 + ({up}) div CAST({size} + {v} AS DECIMAL(20, 0))"


def top_terms(counted: DataFrame, groups: DataFrame, limit: int = TOP_TERMS) -> DataFrame:
    """Per group the terms it has more of than its language, dearest first."""
    rows = counted.where("n > 0").join(_sized(groups), ["lang", "source"])
    priced = rows.withColumns(
        {"p": F.expr(share_sql("n", "size")), "q": F.expr(share_sql("total", "lang_size"))}
    ).where("p > q")
    value = F.expr("(p - q) * (p - q) div q")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (
        priced.select("lang", "source", F.col("term").alias("item"), value.alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= limit)
    )


# -- count trees -------------------------------------------------------------------


def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / size): long division in steps of a thousand, so that
    no product leaves 64 bits."""
    whole, rest = np.divmod(count + 1, size)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        whole = whole * 1000 + digit
    return 1 + whole


class CountTrees:
    """Segment trees over the columns of a count matrix, with equal subtrees shared.

    ``levels[0]`` holds the distinct counts; ``levels[k]`` the two children of each distinct
    node of height k. A row's tree is ``root[row]``. Columns beyond the last are the leaf -1,
    which costs nothing.
    """

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        padded = 1 << max(width - 1, 0).bit_length()
        leaves = np.full((rows, padded), -1, np.int64)
        leaves[:, :width] = counts
        distinct, codes = np.unique(leaves, return_inverse=True)
        codes = codes.reshape(rows, padded)
        self.levels = [distinct]
        while codes.shape[1] > 1:
            left, right = codes[:, ::2], codes[:, 1::2]
            n = int(codes.max()) + 1
            nodes, codes = np.unique(left * n + right, return_inverse=True)
            codes = codes.reshape(rows, -1)
            self.levels.append((nodes // n, nodes % n))
        self.root = codes[:, 0]

    def divergences(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair of rows the sums of floor((p - q)^2 / q) over all columns, with p of
        a and q of b, and the other way round. ``size`` is N + V per row."""
        pair, x, y = np.arange(len(a)), self.root[a], self.root[b]
        walks = []
        for level in range(len(self.levels) - 1, 0, -1):
            left, right = self.levels[level]
            pair, x, y, back = self._distinct(pair, x, y, len(left))
            walks.append((back, len(pair)))
            pair = np.concatenate([pair, pair])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
        pair, x, y, back = self._distinct(pair, x, y, len(self.levels[0]))
        n, m = self.levels[0][x], self.levels[0][y]
        p, q = shares(n, size[a[pair]]), shares(m, size[b[pair]])
        there, back_again = (p - q) ** 2 // q, (p - q) ** 2 // p
        there[n < 0], back_again[n < 0] = 0, 0
        there, back_again = there[back], back_again[back]
        for back, half in reversed(walks):
            there = (there[:half] + there[half:])[back]
            back_again = (back_again[:half] + back_again[half:])[back]
        return there, back_again

    @staticmethod
    def _distinct(pair, x, y, n):
        """Each pair of nodes once per pair of rows, and where it occurs."""
        key, back = np.unique((pair * n + x) * n + y, return_inverse=True)
        node_pair, pair = key % (n * n), key // (n * n)
        return pair, node_pair // n, node_pair % n, back


def _price(spine: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """What one segment adds to the divergences between two blocks of groups."""
    head = spine.iloc[0]
    gids = list(head["gids_i"]) + ([] if head["bi"] == head["bj"] else list(head["gids_j"]))
    sizes = list(head["sizes_i"]) + ([] if head["bi"] == head["bj"] else list(head["sizes_j"]))
    row_of = {g: i for i, g in enumerate(gids)}
    term, known = pd.factorize(rows["term"])
    total = np.zeros(len(known), np.int64)
    total[term] = rows["total"].to_numpy(np.int64)
    by_total = np.lexsort((np.asarray(known, object), -total)) if len(known) else np.zeros(0, np.int64)
    column = np.empty(len(known), np.int64)
    column[by_total] = np.arange(len(known))
    # terms that only other blocks have are columns of zeros
    counts = np.zeros((len(gids), int(head["terms"])), np.int64)
    counts[rows["gid"].map(row_of).to_numpy(np.int64), column[term]] = rows["n"].to_numpy(np.int64)

    n_i = len(head["gids_i"])
    if head["bi"] == head["bj"]:
        a, b = np.triu_indices(len(gids), 1)
    else:
        a = np.repeat(np.arange(n_i), len(gids) - n_i)
        b = np.tile(np.arange(n_i, len(gids)), n_i)
    there, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    if counts.shape[1]:
        trees = CountTrees(counts)
        size = np.array(sizes, np.int64) + int(head["v"])
        for lo in range(0, len(a), PAIRS_AT_ONCE):
            part = slice(lo, lo + PAIRS_AT_ONCE)
            there[part], back[part] = trees.divergences(a[part], b[part], size)
    gids = np.array(gids, np.int64)
    return pd.DataFrame(
        {
            "lang": head["lang"],
            "gid": np.concatenate([gids[a], gids[b]]),
            "other": np.concatenate([gids[b], gids[a]]),
            "value": np.concatenate([there, back]),
        }
    )


def source_pairs(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """Divergence of every group from every other one of its language, greatest first."""
    segment = F.pmod(F.xxhash64("term"), F.col("segments"))
    placed = counted.where("term != ''").join(_sized(groups), ["lang", "source"]).select(
        "lang", segment.alias("segment"), "gid", "term", "n", "total", "once",
        F.floor(F.col("gid") / BLOCK_GROUPS).cast("int").alias("block"),
        F.ceil(F.col("groups") / BLOCK_GROUPS).cast("int").alias("blocks"),
    )
    # a row goes to every pair of blocks that its own is in
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, "block").alias("bi"), F.greatest(x, "block").alias("bj")),
    )
    keys = ["lang", "segment", "bi", "bj"]
    rows = placed.withColumn("__to", F.explode(meets)).select(
        "lang", "segment", "__to.*", "gid", "term", "n", "total"
    )

    terms = placed.where("once").groupBy("lang", "segment").agg(F.count(F.lit(1)).alias("terms"))
    blocks = groups.groupBy(
        "lang", "groups", "segments", "v", F.floor(F.col("gid") / BLOCK_GROUPS).cast("int").alias("block")
    ).agg(F.sort_array(F.collect_list(F.struct("gid", "size"))).alias("__in"))
    side = lambda at: blocks.select(
        "lang", F.col("block").alias(f"b{at}"), F.col("__in.gid").alias(f"gids_{at}"),
        F.col("__in.size").alias(f"sizes_{at}"),
    )
    last = F.ceil(F.col("groups") / BLOCK_GROUPS).cast("int") - 1
    spine = (
        blocks.select(
            "lang", "v", "segments", F.col("block").alias("bi"),
            F.explode(F.sequence("block", last)).alias("bj"),
        )
        .withColumn("segment", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("segments") - 1)))
        .join(side("i"), ["lang", "bi"]).join(side("j"), ["lang", "bj"])
        .join(terms, ["lang", "segment"], "left").fillna(0, ["terms"])
        .select(*keys, "v", "terms", "gids_i", "sizes_i", "gids_j", "sizes_j")
    )
    priced = spine.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(
        _price, "lang string, gid int, other int, value bigint"
    )
    sums = priced.groupBy("lang", "gid", "other").agg(F.sum("value").alias("value"))
    names = _sized(groups.select("lang", "gid", "source"))
    others = _sized(groups.select("lang", F.col("gid").alias("other"), F.col("source").alias("item")))
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (
        sums.join(names, ["lang", "gid"]).join(others, ["lang", "other"])
        .select("lang", "source", "item", "value")
        .withColumn("rank", F.row_number().over(far))
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, limit: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: in part ``pair`` how far
    the group lies from each other source of its language, in part ``term`` the up to
    ``limit`` terms that set it apart from its language."""
    counted = kept(with_totals(term_counts(docs), least_docs), "terms")
    groups = kept(group_table(counted), "groups")
    parts = [
        table.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        for part, table in (
            ("pair", source_pairs(counted, groups)), ("term", top_terms(counted, groups, limit))
        )
    ]
    return parts[0].unionByName(parts[1])
