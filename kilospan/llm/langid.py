"""Language identification by interpolated Kneser-Ney character models.

Text is lower-cased; every run of characters that are no letters becomes one blank, so
digits, marks and junk symbols count as word edges alone. Per language, all runs of ORDER
symbols in all training texts are counted: in the map tasks first, then by a shuffle over
(language, run). Everything else follows from that table by aggregates: continuation
counts of the shorter runs, discounts from counts of counts, interpolation weights.

The finished model is a sorted array of 64-bit hashes of runs with their log probability,
and one of contexts with their log weight, per language and length. A text is scored by
every language; the lowest cross-entropy per symbol wins. A run is looked up once per
distinct run of a batch, so the cost hardly depends on the number of languages. A model of
more than HELD_RUNS runs is not gathered: it stays a table, and the distinct runs of the texts
are joined with it. No run is dropped either way.

Two things are calibrated on the training documents after scoring: the temperature that
turns cross-entropies into a score from 0 to 1, and per language the cross-entropy beyond
which a text is rejected as none of the languages.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept, mix64, row_slices, seeds, signed, text_bytes

ORDER = 4
HELD_RUNS = 4_000_000
REJECT_SIGMAS = 8.0
TEMPERATURES = [1, 2, 4, 8, 16, 32, 64, 128]
EDGE = 0
UNKNOWN = "und"
_MIX = seeds(ORDER + 1, 51)
_START = np.zeros(ORDER - 1, np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def symbols(text: str) -> np.ndarray:
    """Code points of lower-case letters with one EDGE for each run of other characters,
    and an EDGE at the end. Without letters: empty."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, EDGE)
    if not codes.any():
        return codes[:0]
    keep = np.ones(len(codes) + 1, bool)
    codes = np.append(codes, np.uint32(EDGE))
    keep[1:] = (codes[1:] != EDGE) | (codes[:-1] != EDGE)
    keep[0] = codes[0] != EDGE
    return codes[keep].astype(np.uint32)


def runs(texts: list[str]):
    """(matrix of ORDER symbols per predicted symbol, number of symbols per text)."""
    parts = [symbols(t) for t in texts]
    n = np.array([len(p) for p in parts], np.int64)
    if not n.sum():
        return np.zeros((0, ORDER), np.uint32), n
    flat = np.concatenate([x for p in parts if len(p) for x in (_START, p)])
    windows = np.lib.stride_tricks.sliding_window_view(flat, ORDER)
    real = n[n > 0]
    first = np.cumsum(real + ORDER - 1) - (real + ORDER - 1)
    at = np.arange(int(real.sum())) + np.repeat(first - (np.cumsum(real) - real), real)
    return windows[at], n


def run_hash(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of runs given by columns, first symbol first."""
    h = np.full(len(columns[0]), np.uint64(len(columns)))
    for c, m in zip(columns, _MIX):
        h = (h ^ c.astype(np.uint64)) * m
        h ^= h >> np.uint64(29)
    return mix64(h)


def count_runs(labelled: DataFrame) -> DataFrame:
    """(lang, c0 .. c3, n): occurrences of every run in (lang, text) rows."""
    names = [f"c{i}" for i in range(ORDER)]
    schema = f"lang string, {', '.join(f'{c} int' for c in names)}, n bigint"

    def count(batches):
        held: dict[str, pd.DataFrame] = {}
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi in row_slices(at):
                texts = np.array(batch.column(1).slice(lo, hi - lo).to_pylist(), object)
                for lang in set(langs[lo:hi]):
                    rows, _ = runs(list(texts[langs[lo:hi] == lang]))
                    if not len(rows):
                        continue
                    found, keys = pd.factorize(run_hash([rows[:, i] for i in range(ORDER)]))
                    first = np.full(len(keys), len(rows))
                    first[found[::-1]] = np.arange(len(rows))[::-1]
                    frame = pd.DataFrame(rows[first].astype(np.int32), columns=names, index=keys)
                    frame["n"] = np.bincount(found, minlength=len(keys))
                    old = held.get(lang)
                    held[lang] = frame if old is None else _added(old, frame, names)
                if sum(map(len, held.values())) > 1_000_000:
                    yield from _emit(held, names)
                    held = {}
        yield from _emit(held, names)

    return labelled.mapInArrow(count, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _added(old: pd.DataFrame, new: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    both = new.index.intersection(old.index)
    old.loc[both, "n"] += new.loc[both, "n"]
    return pd.concat([old, new.loc[new.index.difference(old.index)]])


def _emit(held: dict[str, pd.DataFrame], names: list[str]):
    for lang, frame in held.items():
        columns = [pa.array([lang] * len(frame)), *[pa.array(frame[c].to_numpy()) for c in names]]
        columns.append(pa.array(frame["n"].to_numpy().astype(np.int64)))
        yield pa.RecordBatch.from_arrays(columns, ["lang", *names, "n"])


def probabilities(counts: DataFrame) -> list[DataFrame]:
    """Kneser-Ney tables, shortest runs first: (lang, symbols, n, p, weight).

    ``p`` is the interpolated probability of the last symbol after the others; ``weight`` is
    what the shorter run's probability counts for after this context.
    """
    names = [f"c{i}" for i in range(ORDER)]
    tables, table = [], counts
    for length in range(ORDER, 0, -1):
        cols = names[ORDER - length :]
        tables.append((cols, table))
        if length > 1:  # continuation counts: in how many ways a run goes on to the left
            table = table.groupBy("lang", *cols[1:]).agg(F.count("*").alias("n"))
    out, lower = [], None
    for cols, table in reversed(tables):
        kinds = table.groupBy("lang").agg(
            F.sum((F.col("n") == 1).cast("double")).alias("n1"),
            F.sum((F.col("n") == 2).cast("double")).alias("n2"),
            F.count("*").alias("kinds"),
        ).select(
            "lang", "kinds",
            F.greatest(F.lit(0.1), F.least(F.lit(0.95), F.col("n1") / F.greatest(F.lit(1.0), F.col("n1") + 2 * F.col("n2")))).alias("d"),
        )
        context = cols[:-1]
        within = table.groupBy("lang", *context).agg(
            F.sum("n").alias("total"), F.count("*").alias("after")
        )
        full = table.join(within, ["lang", *context]).join(F.broadcast(kinds), "lang")
        weight = F.col("d") * F.col("after") / F.col("total")
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        if lower is None:
            full = full.withColumn("below", 1.0 / (F.col("kinds") + 1))
        else:
            full = full.join(
                lower.select("lang", *cols[1:], F.col("p").alias("below")), ["lang", *cols[1:]]
            )
        lower = kept(
            full.select("lang", *cols, "n", (own + weight * F.col("below")).alias("p"), weight.alias("weight"), "kinds"),
            "kneser-ney",
        )
        out.append(lower)
    return out


class Model:
    """Sorted hash arrays. ``logs[lang][length]``: hashes of runs and their log
    probabilities; ``weights[lang][length]``: hashes of contexts and their log weights.
    A model too large for arrays has the tables of ``probabilities`` instead."""

    def __init__(self, langs: list[str]):
        self.langs, self.logs, self.weights = langs, {}, {}
        self.tables: list[DataFrame] | None = None
        self.unseen: dict[str, float] = {}

    @staticmethod
    def _look(table, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = table
        at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
        return hashes[at] == keys, values[at]

    def log_probability(self, lang: str, rows: np.ndarray) -> np.ndarray:
        """Of the last symbol of every run, backing off to shorter runs."""
        columns = [rows[:, i] for i in range(ORDER)]
        out = np.full(len(rows), self.unseen[lang])
        for length in range(1, ORDER + 1):
            if length > 1:
                known, weight = self._look(
                    self.weights[lang][length], run_hash(columns[ORDER - length : -1])
                )
                out += np.where(known, weight, 0.0)
            known, p = self._look(self.logs[lang][length], run_hash(columns[ORDER - length :]))
            out = np.where(known, p, out)
        return out


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", held_runs: int | None = None) -> Model:
    """Counts all labelled rows (null labels and texts teach nothing) and makes the model of
    all their runs: arrays up to ``held_runs`` (HELD_RUNS) of them, tables beyond."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    tables = probabilities(kept(count_runs(labelled), "runs"))
    edges = tables[0].groupBy("lang").agg(F.max("weight"), F.max("kinds")).collect()
    langs = sorted(r[0] for r in edges)
    model = Model(langs)
    size = sum(table.count() for table in tables)
    if size > (HELD_RUNS if held_runs is None else held_runs):
        model.tables = tables
        return model
    model.unseen = {lang: float(np.log(weight / (kinds + 1))) for lang, weight, kinds in edges}
    model.logs = {lang: {} for lang in langs}
    model.weights = {lang: {} for lang in langs}
    for length, table in enumerate(tables, 1):
        cols = _symbol_columns(table)
        for lang, found in _gathered(table.select("lang", *cols, "p")).items():
            model.logs[lang][length] = found
        if length > 1:
            contexts = table.groupBy("lang", *cols[:-1]).agg(F.max("weight").alias("weight"))
            for lang, found in _gathered(contexts).items():
                model.weights[lang][length] = found
    return model


def _symbol_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c[0] == "c" and c[1:].isdigit()]


def _packed(table: DataFrame) -> DataFrame:
    """(lang, keys, logs) of a table of lang, symbols and a value: the runs' hashes and the
    values' logarithms as bytes, in one row per batch and language."""

    def pack(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            symbols_ = [c.to_numpy().astype(np.uint32) for c in batch.columns[1:-1]]
            keys, logs = run_hash(symbols_), np.log(batch.column(batch.num_columns - 1).to_numpy())
            found = sorted(set(langs))
            columns = [[x[langs == lang].tobytes() for lang in found] for x in (keys, logs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), *[pa.array(c, pa.binary()) for c in columns]],
                ["lang", "keys", "logs"],
            )

    return table.mapInArrow(pack, "lang string, keys binary, logs binary")


def _gathered(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language the sorted hashes and the logarithms of ``_packed``. The driver gets
    these 16 bytes a run and no rows of runs."""
    parts: dict[str, list] = {}
    for lang, keys, logs in _packed(table).collect():
        parts.setdefault(lang, []).append((keys, logs))
    out = {}
    for lang in list(parts):
        keys, logs = (b"".join(x) for x in zip(*parts.pop(lang)))
        order = np.argsort(np.frombuffer(keys, np.uint64))
        out[lang] = np.frombuffer(keys, np.uint64)[order], np.frombuffer(logs, np.float64)[order]
    return out


def cross_entropies(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The ``carry`` columns, n_symbols, and ce: natural-log cross-entropy per symbol under
    each language of the model (null where there is no letter)."""
    if model.tables is not None:
        return _joined_cross_entropies(docs, model, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width = len(model.langs)
    fields = [docs.schema[c] for c in carry]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", n_symbols bigint, ce array<double>"

    def score(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(len(carry))
            _, at = text_bytes(texts)
            for lo, hi in row_slices(at):
                rows, n = runs([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                real = np.flatnonzero(n)
                ce = np.zeros((hi - lo, width))
                if len(rows) and width:
                    found, keys = pd.factorize(run_hash([rows[:, i] for i in range(ORDER)]))
                    first = np.full(len(keys), len(rows))
                    first[found[::-1]] = np.arange(len(rows))[::-1]
                    begin = np.cumsum(n[real]) - n[real]
                    for j, lang in enumerate(model.langs):
                        logs = model.log_probability(lang, rows[first])[found]
                        ce[real, j] = -np.add.reduceat(logs, begin) / n[real]
                values = [row.tolist() if k else None for row, k in zip(ce, n)]
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(carry))]
                columns += [pa.array(n), pa.array(values, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [*carry, "n_symbols", "ce"])

    return docs.select(*carry, "text").mapInArrow(score, schema)


def _joined_cross_entropies(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """As ``cross_entropies``, with the runs of the texts joined with the model's tables."""
    names = [f"c{i}" for i in range(ORDER)]
    rows = kept(docs.select(*carry, "text").withColumn("__row", F.monotonically_increasing_id()), "rows")

    def count(batches):
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for lo, hi in row_slices(at):
                found, n = runs([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
                frame = pd.DataFrame(found.astype(np.int32), columns=names)
                frame.insert(0, "__row", np.repeat(batch.column(0).to_numpy()[lo:hi], n))
                frame = frame.groupby(["__row", *names], sort=False).size().reset_index(name="n")
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    schema = f"__row bigint, {', '.join(f'{c} int' for c in names)}, n bigint"
    counted = kept(rows.select("__row", "text").mapInArrow(count, schema), "row-runs")
    langs = model.tables[0].groupBy("lang").agg(
        F.log(F.max("weight") / (F.max("kinds") + 1)).alias("logp")
    )
    scored = counted.select(*names).distinct().crossJoin(F.broadcast(langs))
    for length, table in enumerate(model.tables, 1):
        cols = _symbol_columns(table)
        if length > 1:
            weights = table.groupBy("lang", *cols[:-1]).agg(F.log(F.max("weight")).alias("more"))
            scored = scored.join(weights, ["lang", *cols[:-1]], "left").withColumn(
                "logp", F.col("logp") + F.coalesce("more", F.lit(0.0))
            ).drop("more")
        known = table.select("lang", *cols, F.log("p").alias("own"))
        scored = scored.join(known, ["lang", *cols], "left").withColumn(
            "logp", F.coalesce("own", "logp")
        ).drop("own")
    by_lang = counted.join(kept(scored, "run-scores"), names).groupBy("__row", "lang").agg(
        F.sum("n").alias("n"), (-F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("e")
    )
    found = by_lang.groupBy("__row").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("lang", "e"))).alias("es")
    )
    return rows.join(found, "__row", "left").select(
        *carry, F.coalesce("n", F.lit(0).cast("bigint")).alias("n_symbols"),
        F.col("es")["e"].alias("ce"),
    )


def identify(
    docs: DataFrame, learn_from: "F.Column | None" = None, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """One row per document: doc_id, row_tag, lang_pred, score, cross_entropy, rejected.

    ``learn_from`` picks the rows that teach the model and calibrate it (default: all with a
    label). Prediction reads the text alone. A null text or one without letters is ``und``
    with score 0 and rejected, and so is everything if nothing is labelled. Ties go to the
    first language name. Repeated rows and null ids are rows like others.
    """
    rule = F.lit(True) if learn_from is None else learn_from
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_tag"),
        F.when(rule & F.col(lang_col).isNotNull(), F.col(lang_col)).alias("lang"),
        F.col(text_col).alias("text"),
    )
    model = train(rows.where("lang is not null").select("lang", "text"))
    scored = kept(cross_entropies(rows, model, ["doc_id", "row_tag", "lang"]), "scores")
    if not model.langs:
        return scored.select(
            "doc_id", "row_tag", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    names = F.array(*[F.lit(x) for x in model.langs])
    best = F.array_min("ce")
    place = F.array_position("ce", best).cast("int")
    named = F.element_at(names, place)

    def confidence(t):  # softmax of -t * ce, for the best language
        total = reduce(
            lambda a, b: a + b,
            [F.exp((best - F.element_at("ce", i + 1)) * t) for i in range(len(model.langs))],
        )
        return 1 / total

    taught = scored.where("lang is not null and ce is not null").withColumn("hit", named == F.col("lang"))
    losses = [
        F.avg(-F.log(F.greatest(F.lit(1e-6), F.when(F.col("hit"), confidence(float(t))).otherwise(1 - confidence(float(t)))))).alias(f"t{t}")
        for t in TEMPERATURES
    ]
    loss = taught.agg(*losses).first().asDict()
    lost = [loss[f"t{t}"] or 0.0 for t in TEMPERATURES]
    t = float(next(t for t, x in zip(TEMPERATURES, lost) if x <= min(lost) + 0.001))
    spread = taught.where("hit").groupBy("lang").agg(
        F.avg(best).alias("mean"), F.coalesce(F.stddev_pop(best), F.lit(0.0)).alias("sd")
    )
    limits = {r["lang"]: r["mean"] + REJECT_SIGMAS * max(r["sd"], 0.05) for r in spread.collect()}
    limit = F.element_at(
        F.array(*[F.lit(float(limits.get(x, np.inf))) for x in model.langs]), place
    )
    has = F.col("ce").isNotNull()
    return scored.select(
        "doc_id", "row_tag",
        F.when(has, named).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(has, confidence(t)).otherwise(0.0).alias("score"),
        F.when(has, best).alias("cross_entropy"),
        F.when(has, best > limit).otherwise(True).alias("rejected"),
    )
