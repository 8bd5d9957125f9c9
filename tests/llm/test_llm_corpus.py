"""Operators that compare texts or vectors with each other, against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kilospan.llm import decontam, near_dup, substrings, topk
from kilospan.llm.components import components
from kilospan.llm.queries import table


def words(n, seed, vocabulary=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def roots(nodes, edges):
    head = {n: n for n in nodes}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(300)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(50)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {x["node"]: x["component"] for x in components(df).collect()}
    want = roots({n for e in edges for n in e}, edges)
    loops = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: c for n, c in want.items() if n not in loops}
    assert components(df.limit(0)).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_by_force(rows, percent=85):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    edges = [
        (a, b) for a in sets for b in sets if a < b
        and any(x and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return roots(sets, edges)


def variants():
    """Families around the threshold, chains, copies, and texts that share one passage."""
    rows, passage = [], words(60, 99)
    for f in range(6):
        base = words(120, f)
        for v in range(12):
            w = list(base)
            r = random.Random(f * 100 + v)
            for _ in range(v // 2):
                w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
            rows.append(" ".join(w))
    rows += [" ".join(words(20, 500 + i) + passage + words(20, 700 + i)) for i in range(30)]
    chain = words(200, 55)
    rows += [" ".join(chain[k * 6 : k * 6 + 140]) for k in range(10)]  # each near the next only
    rows += ["One two three", "one  TWO\nthree", "one two", "", " \t", None, "a b c d e", "A b c d E f"]
    rows += [rows[0]] * 5 + [" ".join(words(40_000, 9))] * 2
    return list(enumerate(rows))


@pytest.mark.parametrize("nearest, block", [(near_dup.NEAREST, near_dup.BLOCK), (1, 7)])
def test_near_duplicates(spark, monkeypatch, nearest, block):
    monkeypatch.setattr(near_dup, "NEAREST", nearest)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = variants()
    docs = spark.createDataFrame(
        [(i, t, "k", 1, "s") for i, t in rows] + [(None, rows[0][1], "k", 1, "s"), (3, rows[3][1], "k", 1, "s")],
        "doc_id bigint, text string, key string, id int, signature string",
    )
    got = near_dup.near_duplicates(docs).toPandas()
    assert len(got) == len(rows) + 2
    want = near_by_force(rows)
    null = got[got["doc_id"].isna()].iloc[0]
    assert np.isnan(null["component_id"]) and null["kept"]
    real = got[got["doc_id"].notna()].astype({"doc_id": int, "component_id": int})
    assert dict(zip(real["doc_id"], real["component_id"])) == want
    assert (real["kept"] == (real["doc_id"] == real["component_id"])).all()
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(sizes[i] == n for i, n in zip(real["doc_id"], real["n_shingles"]))


def test_near_duplicates_without_rows_and_with_shared_ids(spark):
    schema = "doc_id bigint, text string"
    assert near_dup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    a, b = " ".join(words(50, 1)), " ".join(words(50, 2))
    rows = [(5, a), (5, b), (7, a), (8, b), (9, " ".join(words(50, 3)))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, schema)).toPandas()
    assert dict(zip(got["doc_id"], got["component_id"])) == {5: 5, 7: 5, 8: 5, 9: 9}


def test_links_over_the_threshold_are_rare():
    n, most = near_dup.SYMBOLS, near_dup.THRESHOLD
    over = {p: sum(math.comb(n, k) * (1 - p) ** k * p ** (n - k) for k in range(most + 1, n + 1)) for p in (0.8, 0.85)}
    assert over[0.8] < 1e-5 and over[0.85] < 1e-7


def test_pigeonhole_keys(spark):
    """Any two signatures within the threshold share a key."""
    r = np.random.default_rng(1)
    rows = []
    for i in range(0, 400, 2):
        a = r.integers(0, 1 << 16, near_dup.SYMBOLS).astype("<u2")
        b = a.copy()
        b[r.choice(near_dup.SYMBOLS, near_dup.THRESHOLD, replace=False)] ^= 1
        rows += [(i, a.tobytes()), (i + 1, b.tobytes())]
    keys = near_dup.index_keys(spark.createDataFrame(rows, "id bigint, signature binary")).toPandas()
    by_id = keys.groupby("id")["key"].agg(set)
    assert all(by_id[i] & by_id[i + 1] for i in range(0, 400, 2))


def passage_rows():
    passage = [" ".join(words(60 + 10 * i, 900 + i)) for i in range(4)]
    rows = []
    for i in range(40):
        own = " ".join(words(30, i)) + ", "
        tail = " " + " ".join(words(25, 100 + i)) + "\nShort shared line.\n" + " ".join(words(12, 300 + i))
        rows.append((i, own + (passage[i % 4] if i < 24 else " ".join(words(80, 200 + i))) + tail))
    return rows, passage


def test_repeated_passages(spark):
    rows, passage = passage_rows()
    extra = [(100, rows[0][1]), (101, None), (102, ""), (None, passage[0]), rows[5]]
    docs = spark.createDataFrame(
        [(i, t, 1, "u") for i, t in rows + extra], "doc_id bigint, text string, start int, unit string"
    )
    spans = substrings.repeated_spans(docs)
    got = spans.toPandas()
    assert set(got["doc_id"]) == {*range(4, 24), 100}
    texts = dict(rows + extra[:3])
    for s in got[got["doc_id"] < 24].itertuples():
        cut = texts[s.doc_id][s.start : s.end]
        assert cut in passage[s.doc_id % 4] and len(cut.split()) == s.n_words >= 40
        assert s.first_doc_id < s.doc_id and (s.doc_id - s.first_doc_id) % 4 == 0
    assert got[got["doc_id"] == 100]["n_words"].sum() == len(texts[0].split())
    left = substrings.without_spans(docs, spans)
    assert left.columns == docs.columns
    out = left.toPandas()
    assert len(out) == len(rows) + len(extra)
    by = out[out["doc_id"].notna()].drop_duplicates("doc_id").set_index("doc_id")["text"]
    assert by[100] == "" and by[102] == "" and by[101] is None
    for i, t in rows:
        mine = got[got["doc_id"] == i].drop_duplicates("start").sort_values("start")
        if not len(mine):
            assert by[i] == t
        else:
            s = mine.iloc[0]
            assert by[i] == t[: s["start"]] + t[s["end"] :].lstrip(" ")
    assert substrings.repeated_spans(docs.limit(0)).count() == 0


def test_repeats_inside_one_text_and_counts(spark):
    line = " ".join(words(60, 7))
    docs = spark.createDataFrame(
        [(1, f"{line}\n{line}\nend é {line}", 5), (2, "漢 " * 10 + line, 3)], "doc_id bigint, text string, n_chars bigint"
    )
    spans = substrings.repeated_spans(docs)
    got = {(r["doc_id"], r["start"], r["end"]) for r in spans.collect()}
    assert (1, len(line) + 1, 2 * len(line) + 1) in got
    out = {r["doc_id"]: r for r in substrings.without_spans(docs, spans).collect()}
    assert out[1]["n_chars"] == len(out[1]["text"]) and out[1]["text"].startswith(line)
    assert out[1]["text"].split().count(words(60, 7)[30]) == 1 and out[2]["text"].startswith("漢 漢")


def test_every_later_copy_of_a_line_goes(spark):
    rows = [(i, f"{' '.join(words(30, i))}\nSHORT  shared line.\n{' '.join(words(9, 50 + i))}\nshort shared line.") for i in range(8)]
    rows += [(20, "a short shared line. in a line\nOne"), (21, "one\nshort shared line. in\n\nend"), (None, "end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = substrings.repeated_spans(docs, whole_lines=True)
    by = {r["doc_id"]: r["text"] for r in substrings.without_spans(docs, spans).collect()}
    for i, t in rows[:8]:
        parts = t.split("\n")
        assert by[i].split("\n") == parts[: 3 if i == 0 else 1] + ([] if i == 0 else [parts[2]]) + [""]
    assert by[20] == rows[8][1] and by[21] == "short shared line. in\n\nend"


def test_short_passages_go_whole(spark):
    """Passages of 51 to 60 words in mid-line: none is missed, none loses a word too few."""
    rows, found = [], {}
    for i in range(400):
        inner = words(51 + i % 10, 9000 + i)
        for k in (0, 1):
            own = [f"x{i}y{k}", *words(12, 20_000 + 2 * i + k), f"v{i}w{k}"]
            rows.append((1000 * k + i, " ".join([*own, *inner, *own[::-1]])))
            found[1000 * k + i] = " ".join(inner)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substrings.repeated_spans(docs, whole_lines=True).toPandas()
    texts = dict(rows)
    cut = {s.doc_id: texts[s.doc_id][s.start : s.end] for s in got.itertuples()}
    assert len(got) == 400 and cut == {i: t for i, t in found.items() if i >= 1000}


def lone_phrases():
    """Texts of their own words with one short line in common, its neighbours always others,
    and a passage in the first and the last of them."""
    common, passage = " ".join(words(10, 71)), words(60, 72)
    rows = []
    for i in range(60):
        own = [f"{w}{i}" for w in words(200, 400 + i)]
        inner = passage if i in (0, 59) else []
        rows.append((i, "\n".join([" ".join(own[:100]), common, " ".join([*own[100:], *inner, f"end{i}"])])))
    return rows, passage


def test_only_repeats_are_written(spark, monkeypatch):
    """Units of one document alone and words next to ends that cannot move stay in the task."""
    written, kept = {}, substrings.kept

    def counted(df, name):
        out = kept(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(substrings, "kept", counted)
    rows, passage = lone_phrases()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substrings.repeated_spans(docs).toPandas()
    assert [(r.doc_id, rows[59][1][r.start : r.end]) for r in got.itertuples()] == [(59, " ".join(passage))]
    units = substrings.unit_rows(substrings._rows(docs, "doc_id", "text")).count()
    assert sum(written.values()) < units / 2
    assert 59 <= written["islands"] and written["around"] < written["islands"] / 4


def test_spans_do_not_depend_on_the_filter(spark, monkeypatch):
    rows = [*passage_rows()[0], *[(200 + i, t) for i, t in lone_phrases()[0]]]
    rows += [(300, f"{rows[3][1]}\n{rows[3][1]}"), (301, None), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(substrings.repeated_spans(docs, whole_lines=True).collect())
    monkeypatch.setattr(substrings, "digest_filter", lambda known: np.full(8, 255, np.uint8))
    assert sorted(substrings.repeated_spans(docs, whole_lines=True).collect()) == want


def test_a_filter_lets_all_its_digests_through(spark):
    r = np.random.default_rng(3)
    digests = r.integers(-(1 << 63), (1 << 63) - 1, 60_000)
    digests[:3] = (-1, 0, -(1 << 63))
    known = spark.createDataFrame([(int(x),) for x in digests[:50_000]], "known bigint")
    bits = substrings.digest_filter(known)
    assert 8 * len(bits) == 1 << 20
    let = substrings._let_through(bits, digests)
    assert let[:50_000].all() and let[50_000:].mean() < 0.02
    none = substrings.digest_filter(known.limit(0))
    assert not substrings._let_through(none, digests).any()


def test_words_beside_units():
    from kilospan.llm.common import spaced_words

    texts = pa.array(["four\nfive", "", "five\nfour"])
    found = {}
    for row, unit in substrings._units_apart(texts, spaced_words(), 4, True):
        for i, n, b in zip(row, unit["unit"], unit["beside"]):
            found[int(i), int(n)] = int(b)
    five, four = found[0, 0] >> 7, found[0, 1] & 127
    assert four and five and four != five
    assert found == {
        (0, 0): five << 7, (0, 1): four, (0, -1): five << 7, (0, -2): four,
        (2, 0): four << 7, (2, 1): five, (2, -1): four << 7, (2, -2): five,
    }


def test_units_of_a_passage_do_not_depend_on_what_is_around():
    from kilospan.llm.common import spaced_words

    reader = spaced_words()
    for seed in range(50):
        inner = words(51, 4000 + seed)
        found = []
        for k in (1, 2):
            text = " ".join(words(30, 10 * seed + k) + inner + words(30, 10 * seed + k + 5))
            h = reader.read(np.frombuffer(text.encode(), np.uint8))[0]
            cuts = substrings.unit_starts(h, np.zeros(len(h), int))
            found.append({c - 30 for c in cuts if 30 + 5 <= c <= 30 + 51 - 5})
        assert found[0] == found[1]


def window_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination_by_force(text, items):
    w, hit, names = window_words(text), set(), set()
    for name, item in items:
        v = window_words(item)
        size = min(10, len(v))
        wanted = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def test_contamination(spark):
    a, b = words(25, 1, 40), words(12, 2, 40)
    items = [(1, " ".join(a)), (10, " ".join(b)), (2, "Two words"), (3, ""), (4, None), (5, "?!"), (10, " ".join(b)), (None, "two words")]
    texts = [
        " ".join(words(200, 5, 40) + a + words(30, 6, 40)), " ".join(a[3:13]).upper(), ", ".join(a[:9]),
        " ".join(b + a[:12] + b), "two", "TWO-words two words", "", None, "é" + " ".join(b) + "é",
        " ".join(words(50_000, 3, 40)), " ".join(a[15:]), " ".join(a[10:20] + a[5:15]), "words Two\nwords",
    ]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1), (None, texts[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, term int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    tests = decontam.test_set(bench)
    index = decontam.build_index(docs, tests, segment_words=500)
    got = decontam.search(index, tests).toPandas()
    assert len(got) == len(texts) + 1
    named = [(i, t) for i, t in items if i is not None]
    for r in got.itertuples():
        assert (r.n_words, r.n_hit, list(r.items)) == contamination_by_force(texts[r.doc_id], named)
    near = decontam.search(index, tests, reach=3).toPandas().set_index("doc_id")["near_items"]
    assert "2" in list(near[12]) and "2" not in list(near[4])
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).agg(F.max("n_hit")).first()[0] == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SEED_ROWS", 100)
    r = np.random.default_rng(5)
    base = r.normal(0, 0.2, (900, 16))
    base[300:600] = base[0]  # one vector a third of all rows holds
    base[600:620] = 0
    rows = [(i, [float(x) for x in v], "s") for i, v in enumerate(base)]
    rows += [(2000, None, "s"), (2050, [], "s"), (2100, [None] * 16, "s"), (2150, [float("nan")] * 16, "s"), (None, rows[0][1], "s")]
    rows += [(2200, [float("inf")] * 16, "s"), (2250, [0.5, 0.25], "s"), (2251, [0.1, -0.7], "s")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    vectors = topk.kept_vectors(df)
    got = topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, block_rows=200, query_rows=5).toPandas()
    whole = np.floor(base * 256).astype(int)
    for q in range(0, 900, 50):
        scores = [(-int(whole[i] @ whole[q]), i) for i in range(900) if i != q]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(zip(-mine["score"], mine["vec_id"])) == sorted(scores)[:5]
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
    assert got[got["query_id"] == 2250][["vec_id", "score"]].values.tolist() == [[2251, 128 * 25 + 64 * -180]]
    assert set(got["query_id"]) == {*range(0, 900, 50), 2250}
    assert topk.top_k(vectors.limit(0), vectors).count() == 0


def test_large_families_are_judged_in_proportion(spark, monkeypatch):
    """A family whose members are alike, but no duplicates: sets are compared a few times per
    member, however many members there are."""
    counts = []
    real = near_dup._judged

    def counted(near, texts, width):
        counts.append(near.count())
        return real(near, texts, width)

    monkeypatch.setattr(near_dup, "_judged", counted)
    total = {}
    for members in (80, 160):
        original, r = words(200, 4), random.Random(members)
        rows = []
        for i in range(members):
            text = list(original)
            for place in r.sample(range(200), 7):
                text[place] = f"x{i}y{place}"
            rows.append((i, " ".join(text)))
        counts.clear()
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert {x["doc_id"]: x["component_id"] for x in got.collect()} == near_by_force(rows)
        total[members] = sum(counts)
    # all pairs would be four times as many; up to NEAREST in each of its keys are a member's
    assert total[160] <= 3 * total[80] and total[160] <= 4 * near_dup.NEAREST * 160


def test_long_signatures_hardly_miss_a_link():
    n = near_dup.LONG
    for percent in (80, 85, 95):
        most = near_dup.long_threshold(percent)
        differ = 1 - percent / 100
        missed = sum(math.comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(most + 1, n + 1))
        assert missed <= near_dup.LONG_MISS < missed + math.comb(n, most) * differ**most * (1 - differ) ** (n - most)


def test_pipeline(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    assert set(kept["language_id"]["doc_id"]) == {i for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    label = near_by_force([(i, texts[i]) for i in kept["language_id"]["doc_id"]], 80)
    assert set(kept["near_dedup"]["doc_id"]) == {i for i, c in label.items() if i == c}
    cut = kept["substring_dedup"].set_index("doc_id")["text"]
    assert set(cut.index) == set(kept["near_dedup"]["doc_id"])
    assert 0 < sum(len(t) for t in cut) < sum(len(texts[i]) for i in cut.index)
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    clean = {i for i, t in cut.items() if not contamination_by_force(t, items)[1]}
    assert set(kept["decontamination"]["doc_id"]) == clean
    packed = kept["packing"]
    assert set(packed["doc_id"]) == clean
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_pipeline_with_odd_rows(spark, tmp_path):
    rows = [(1, None, None, "s", None), (2, "", "en", "s", 0), (None, "some words here", "en", "s", 15), (3, "some words here", "en", "s", 15)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows * 2, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "x y z")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(got["doc_id"].fillna(-1)) == [-1, -1, 3, 3]


def test_stages_bound_the_batches(spark, tmp_path):
    def weigh(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    rows = [(i, " ".join(words(30, i)), "en", "s", 150) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, "x y z")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = spark.range(0, 1500, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(limit)
            stage(spark, docs, str(tmp_path))
            found = [r["n"] for r in long.mapInArrow(weigh, "n bigint").collect()]
            assert sum(found) >= 15_000_000 and max(found) <= 5 << 20
        spark.conf.set(limit, "100000")
        corpus_pipeline.packing_stage(spark, docs, str(tmp_path))
        assert spark.conf.get(limit) == "100000"
    finally:
        spark.conf.unset(limit)
        if before is not None:
            spark.conf.set(limit, before)


def test_a_pair_has_one_first_key():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = r.integers(0, 1 << 16, near_dup.SYMBOLS).astype(np.uint64)
        b = a.copy()
        b[r.choice(near_dup.SYMBOLS, r.integers(0, 18), replace=False)] ^= np.uint64(1)
        keys = near_dup._keys_of(np.stack([a, b]))
        shared = np.flatnonzero(keys[:, 0] == keys[:, 1])
        assert near_dup._first_key((a != b)[None])[0] == shared[0]
        assert near_dup._choice_of(near_dup.signed(keys[shared[:1], 0]), a[None]) == shared[0]
