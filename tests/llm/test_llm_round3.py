"""Source divergence, importance resampling and BPE against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilospan.llm import bpe, divergence, importance
from kilospan.llm.queries import QUERIES, table, tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, ids string, rank int, n int"
LONG = "Tail word " * 30_000 + "w" * 70_000


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5, 9) for r in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    """Null, empty and long texts, ties, repeated rows, null ids, languages and sources."""
    mixed = [
        "Alpha beta beta gamma", "alpha BETA délta 42 x9", "alpha Beta; gamma_gamma", "é É ß 漢字 alpha",
        "the cat's 'll <|endoftext|>beta\n\n\n tabs\there", "", " \n\t ", None, "1 2 3 . ?", "beta " * 400,
    ]
    out = [(i, t, ("en", "fr", None, "")[i % 4 if i < 24 else 0], f"s{i % 3}") for i, t in enumerate(mixed * 4)]
    out += [(100, "solo words only here", "xx", None), (100, "solo words only here", "xx", None)]
    out += [(None, "alpha beta no id", "en", "s0"), (None, "alpha beta no id", "en", "s9"), (101, LONG, "en", "s1")]
    out += [(200 + i, "alpha beta gamma delta " * 6, "en", "hot") for i in range(60)]
    return out


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- op11 ------------------------------------------------------------------------------


def plain_audit(rows, least_docs=3, limit=200):
    terms = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs_with = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = terms.findall(lowered(text))
        counts[lang or "", source or ""].update(found)
        docs_with[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs_with[lang].items() if n >= least_docs]
        groups = {s: counts[g, s] for g, s in counts if g == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        price = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pairs = [(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            apart = [(t, price(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", apart, limit)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found[:most], 1)]
    return sorted(out)


def audited(docs, **kw):
    return sorted(map(tuple, divergence.audit(docs, **kw).collect()))


def test_audit_equals_plain_sums(spark, rows):
    assert audited(docs_of(spark, rows)) == plain_audit(rows)


def test_audit_in_small_segments_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SEGMENT_TERMS", 3)
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", 2)
    monkeypatch.setattr(divergence, "SMALL_TABLE", 0)
    assert audited(docs_of(spark, rows), least_docs=1, limit=2) == plain_audit(rows, 1, 2)


def test_audit_of_an_empty_table(spark):
    assert audited(docs_of(spark, [])) == []


def test_audit_without_kept_terms(spark):
    rows = [(1, "one two", "en", "a"), (2, None, "en", "b"), (3, "three", "en", None)]
    got = audited(docs_of(spark, rows))
    assert got == plain_audit(rows)
    assert len(got) == 6 and {r[4] for r in got} == {0}


def test_counts_pass_on_when_they_have_grown(spark, rows, monkeypatch):
    plain = divergence.term_counts(docs_of(spark, rows))
    want = sorted(map(tuple, plain.collect()))
    monkeypatch.setattr(divergence, "HELD_TERMS", 2)
    few = divergence.term_counts(docs_of(spark, rows))
    assert sorted(map(tuple, few.collect())) == want


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5), st.integers(1, 40), st.randoms(use_true_random=False))
def test_trees_equal_plain_sums(groups, width, rng):
    counts = np.array([[rng.choice([0, 0, 0, 1, 2, 10**13]) for _ in range(width)] for _ in range(groups)])
    size = counts.sum(axis=1) + width
    a, b = np.triu_indices(groups, 1)
    there, back = divergence.CountTrees(counts).divergences(a, b, size)
    for i, j, x, y in zip(a, b, there, back):
        p, q = ([1 + 10**9 * (int(c) + 1) // int(size[k]) for c in counts[k]] for k in (i, j))
        assert x == sum((s - t) ** 2 // t for s, t in zip(p, q))
        assert y == sum((s - t) ** 2 // s for s, t in zip(p, q))


def test_equal_subtrees_share_nodes():
    counts = np.tile(np.array([3, 0, 0, 0, 3, 0, 0, 0]), (4, 8))
    trees = divergence.CountTrees(counts)
    assert [len(x) if i == 0 else len(x[0]) for i, x in enumerate(trees.levels)] == [2, 2, 1, 1, 1, 1, 1]
    assert len(set(trees.root.tolist())) == 1


# -- op12 ------------------------------------------------------------------------------


def test_crc_by_positions():
    rng = np.random.default_rng(4)
    sizes = [1, 2, 63, 64, 65, 127, 128, 129, 255, 256, 257, 1000, 4097, *rng.integers(1, 300, 60)]
    end = np.cumsum(sizes)
    data = rng.integers(0, 256, int(end[-1])).astype(np.uint8)
    got = importance.PositionCrc().of(data, end - sizes, end)
    assert got.tolist() == [zlib.crc32(data[hi - n : hi].tobytes()) for n, hi in zip(sizes, end)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(lowered(text))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB9 é_.漢\0\n-" + "z" * 40), max_size=200), max_size=6))
def test_features_of_bytes(texts):
    coded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
    bucket, owner, n_words = importance.feature_buckets(np.frombuffer(b"".join(coded), np.uint8), offsets)
    for i, text in enumerate(texts):
        n, want = features(text)
        assert n_words[i] == n and sorted(bucket[owner == i].tolist()) == sorted(want)


def plain_resample(rows, target, percent=25, least=20):
    have, want = Counter(), Counter()
    for r in rows:
        have.update(features(r[1])[1])
    for t in target:
        want.update(features(t)[1])
    s, t = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + 10_000) / ((have[b] + 1) * (t + 10_000))))
    out = []
    for doc_id, text, *_ in rows:
        n, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n, len(found), weight, score, None])
    long_enough = [r for r in out if r[1] >= least]
    long_enough.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(long_enough[: percent * len(long_enough) // 100], 1):
        r[5] = place
    return out


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("percent, least", [(25, 20), (100, 0), (0, 1)])
def test_resample_equals_a_plain_version(spark, rows, percent, least):
    target = ["alpha beta gamma", None, "", "Solo WORDS only"]
    aim = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    got = importance.resample(docs_of(spark, rows), aim, percent=percent, least_words=least)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert by_row(got.collect()) == by_row(plain_resample(rows, target, percent, least))


def test_resample_of_empty_tables(spark, rows):
    none = spark.createDataFrame([], "item_id string, text string")
    assert importance.resample(docs_of(spark, []), none).count() == 0
    got = importance.resample(docs_of(spark, rows), none)
    assert by_row(got.collect()) == by_row(plain_resample(rows, []))


def test_resampling_query_over_a_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    target = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    want = [(r[0], *r[2:]) for r in plain_resample(rows, target)]
    assert by_row(QUERIES["op12_importance_resampling"](spark, sf).collect()) == by_row(want)


def test_ranks_over_partitions(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("k"))
    got = importance.ranked(rows.repartition(9), [F.desc("k"), F.asc("id")]).toPandas().sort_values("rank")
    assert got["rank"].tolist() == list(range(1, 5001))
    want = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert got["id"].tolist() == want


# -- op13 ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def coder():
    return bpe.PairIndexCoder(tokenizer_path(), known_units=12)


@pytest.fixture(scope="module")
def decoder():
    return bpe.Decoder(tokenizer_path())


BPE_TEXTS = st.lists(
    st.lists(
        st.one_of(
            st.text(st.sampled_from("abAB éñ漢\n\t '.,3\x1c\x85\0　"), max_size=12),
            st.sampled_from(["<|endoftext|>", " the", "'ll", "aaaaaaa", "\n\n ", "<|end", "👍🏽"]),
        ),
        max_size=8,
    ).map("".join),
    max_size=5,
)


@settings(max_examples=200, deadline=None)
@given(BPE_TEXTS)
def test_pair_index_equals_the_library(library, coder, decoder, texts):
    ids, at = coder.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[lo:hi].tolist() for lo, hi in zip(at, at[1:])] == want
    assert decoder.decode(ids, at) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_every_code_point_is_cut_alike(library, coder):
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1 {c}." for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    ids, at = coder.encode(texts)
    for text, lo, hi in zip(texts, at, at[1:]):
        assert ids[lo:hi].tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_bytes_decode_alike(library, decoder):
    runs = [[i, j] for i in range(0, 256, 3) for j in range(0, 256, 5)] + [[50256, 97], [49999, 221]]
    ids = np.array([i for r in runs for i in r], np.uint32)
    want = [library.decode(r, skip_special_tokens=False) for r in runs]
    assert decoder.decode(ids, np.arange(0, len(ids) + 1, 2)) == want
    assert decoder.decode(np.array([60_000], np.uint32), np.array([0, 1])) == [""]


def test_long_runs_of_one_letter(library, coder):
    texts = ["a" * 20_001, "ab" * 7_000 + "b", " " * 5_000 + "x", "=" * 9_999]
    ids, at = coder.encode(texts)
    for text, lo, hi in zip(texts, at, at[1:]):
        assert ids[lo:hi].tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    import public_tokenizers

    for kind in (bpe.PairIndexCoder, bpe.Decoder):
        with pytest.raises(ValueError):
            kind(public_tokenizers.path("word_bpe_49k.json"))


def test_round_trip_of_odd_rows(spark, rows, library):
    done = bpe.decode_ids(bpe.encode_texts(docs_of(spark, rows), tokenizer_path()), tokenizer_path())
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["n_tokens"], r["text"]) for r in done.collect()]
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, ids, len(ids), text or ""))
    assert by_row(got) == by_row(want)
    assert bpe.encode_texts(docs_of(spark, []), tokenizer_path()).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None, None)], "doc_id bigint, ids binary, n_tokens bigint")
    assert bpe.decode_ids(rows, tokenizer_path()).first()["text"] == ""


def test_round_trip_query_over_a_whole_table(spark, sf, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_bpe_round_trip"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False).encode()
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text).hexdigest())
