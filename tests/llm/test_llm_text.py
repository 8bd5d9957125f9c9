"""Operators that work on one text at a time, against plain versions."""

import html
import json
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilospan.llm import langid, licenses, packing, pages, token_counts, token_files
from kilospan.llm.common import plain_words, spaced_words
from kilospan.llm.queries import QUERIES, table, tokenizer_path
from kilospan.llm.tokens import Coder

LONG = "word " * 30_000 + "end"
SCHEMA = "doc_id bigint, text string, piece string, start string, id string, key string"


def edge_rows(*texts):
    rows = [(i, t, "x", "y", "z", "k") for i, t in enumerate(texts)]
    return rows + [rows[-1], (None, "no id here", "x", "y", "z", "k")]


@pytest.fixture(scope="module")
def edges(spark):
    """Null, empty, blank, very long, equal and repeated rows, a null id, clashing names."""
    rows = edge_rows(None, "", " \n\t ", LONG, "Same text, twice.", "Same text, twice.", "é ß 漢字\n\n  x y \0 z")
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def plain():
    coder = Coder(tokenizer_path())
    return lambda t: coder.tokenizer.encode(t or "", add_special_tokens=False)


TEXTS = st.text(st.sampled_from("ab éñ漢\n\t '.,3 \x1c\0"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_coder_equals_the_library(texts):
    for places in (False, True):
        coder = Coder(tokenizer_path(), places, cache_words=8)
        for text, packed in zip(texts, coder.encode(texts)):
            made = coder.tokenizer.encode(text, add_special_tokens=False)
            rows = np.frombuffer(packed, "<u4").reshape(-1, 3 if places else 1)
            assert rows[:, 0].tolist() == made.ids
            if places:
                assert [tuple(r) for r in rows[:, 1:].tolist()] == made.offsets


@pytest.mark.parametrize("places", [False, True])
def test_tabs_do_not_hide_line_breaks_from_the_coder(places):
    texts = ["a\tb\tc\n\n\nd", "a\tb\n\nc", "a\u3000b  c", "x\x1cy\n\nz", "a\u00a0b c\n\nd", "a\u2028b \nc", " a\tb", "a\x85b\n"]
    coder = Coder(tokenizer_path(), places)
    for text, packed in zip(texts, coder.encode(texts)):
        made = coder.tokenizer.encode(text, add_special_tokens=False)
        rows = np.frombuffer(packed, "<u4").reshape(-1, 3 if places else 1)
        assert rows[:, 0].tolist() == made.ids
        assert not places or [tuple(r) for r in rows[:, 1:].tolist()] == made.offsets


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60))
def test_words_of_bytes(data):
    lowered = bytes(c + 32 if 65 <= c <= 90 else c for c in data)
    for reader, pattern in (
        (spaced_words(), rb"[^\x20\x09-\x0D]+"),
        (plain_words(), rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        h, a, b = reader.read(np.frombuffer(data, np.uint8))
        want = [m.span() for m in re.finditer(pattern, lowered)]
        assert list(zip(a.tolist(), b.tolist())) == want
        words = [lowered[x:y] for x, y in want]
        assert len(set(h.tolist())) == len(set(words))


def test_words_across_slices():
    reader = spaced_words()
    data = np.frombuffer(b"Abc de " * 400_000 + b"x" * 3_000_000 + b" end", np.uint8)
    h, a, b = reader.read(data)
    assert len(h) == 800_002 and (h[0] == h[::2][:400_000]).all()
    assert h[-1] == reader.read(np.frombuffer(b"END", np.uint8))[0][0]


def naive_best_fit(counts, capacity):
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [f for f in free if f >= length]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - length)
            else:
                free.append(capacity - length)
    return len(free)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_plan_equals_best_fit_one_by_one(counts):
    plan = packing.best_fit_plan(counts, 50)
    filled, ranks = {}, {}
    for length, first, end, base, each, place in plan:
        for rank in range(first, end):
            ranks.setdefault(length, []).append(rank)
            n = rank - first
            filled.setdefault(base + n // each, []).append((place + n % each * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for slots in filled.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 50
    assert sorted(filled) == list(range(len(filled)))
    assert len(filled) == naive_best_fit(counts, 50)


def test_packing_edges(spark, edges, empty, plain):
    got = packing.pack_documents(edges, tokenizer_path(), capacity=64, with_ids=True).toPandas()
    want = {}
    for row in edges.collect():
        want.setdefault(row["doc_id"], plain(row["text"]).ids + [0])
    for doc_id, ids in want.items():
        mine = got[got["doc_id"].isna()] if doc_id is None else got[got["doc_id"] == doc_id]
        mine = mine.drop_duplicates("piece").sort_values("piece")
        assert b"".join(mine["ids"]) == np.array(ids, "<u4").tobytes()
        assert (mine["length"].iloc[1:] == 64).all()
        assert mine["start"].tolist() == [0, *mine["length"].cumsum().tolist()[:-1]]
        assert mine["ids_crc32"].tolist() == [zlib.crc32(x) for x in mine["ids"]]
    assert (got["doc_id"] == 6).sum() == 2 * got[got["doc_id"] == 6]["piece"].nunique()
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]
        assert rows["length"].sum() <= 64
    whole = packing.sequences(packing.pack_documents(edges, tokenizer_path(), 64, with_ids=True))
    assert sum(len(r["ids"]) for r in whole.collect()) == 4 * got["length"].sum()
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_packing_query(spark, sf, plain):
    got = QUERIES["op1_best_fit_packing"](spark, sf).toPandas()
    docs = table(spark, sf, "documents").toPandas()
    n = [len(plain(t).ids) + 1 for t in docs["text"]]
    assert got["length"].sum() == sum(n)
    lengths = got["length"].value_counts().to_dict()
    assert got["sequence_id"].nunique() == naive_best_fit(lengths, 2048)


def test_token_files(spark, edges, empty, plain):
    folder = token_files.token_folder(edges)
    manifest = token_files.write_token_files(edges, tokenizer_path(), folder, end_id=2, width=16)
    got = token_files.read_back(manifest).toPandas().sort_values("start")
    rows = sorted(
        edges.collect(),
        key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""),
    )
    ids = [plain(r["text"]).ids + [2] for r in rows]
    assert got["n_tokens"].tolist() == [len(x) for x in ids]
    assert got["start"].tolist() == [0, *np.cumsum([len(x) for x in ids]).tolist()[:-1]]
    assert got["ids_crc32"].tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    run = []
    for shard in manifest.sort("shard").collect():
        reader = token_files.ShardReader(shard["path"])
        for r in range(shard["n_rows"]):
            values, mask = reader.row(r)
            assert len(values) == len(mask) == 16 and values.dtype == np.uint16
            run += values[mask].tolist()
        assert not mask.all() or shard["n_ids"] % 16 == 0
    assert run == [i for x in ids for i in x]
    none = token_files.write_token_files(empty, tokenizer_path(), token_files.token_folder(empty))
    assert token_files.read_back(none).count() == 0


def section_of(a, b, sections, rule):
    shares = [max(0, min(b, y) - max(a, x)) for x, y in sections]
    if rule == "start":
        return next((i for i, (x, y) in enumerate(sections) if x <= a < y), -1)
    return shares.index(max(shares)) if max(shares, default=0) > 0 else -1


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_tokens(spark, edges, empty, plain, rule):
    got = token_counts.section_tokens(edges, tokenizer_path(), rule).toPandas()
    for row in edges.where("doc_id is not null").collect():
        text = row["text"] or ""
        sections = token_counts.sentence_sections(text) or [(0, 0)]
        assert "".join(text[a:b] for a, b in sections) == text
        homes = [section_of(a, b, sections, rule) for a, b in plain(text).offsets]
        mine = got[got["doc_id"] == row["doc_id"]].drop_duplicates("section")
        assert mine.set_index("section")["n_tokens"].to_dict() == {
            **{i: homes.count(i) for i in range(len(sections))},
            **({-1: homes.count(-1)} if -1 in homes else {}),
        }
    assert got["doc_id"].isna().any()
    assert token_counts.section_tokens(empty, tokenizer_path(), rule).count() == 0


def test_given_sections_and_tokens_that_cross(spark, plain):
    text = "alpha beta gamma delta"
    rows = [(1, text, [(2, 8), (8, 13)]), (2, text, None), (3, text, [])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, s array<struct<start:int,end:int>>")
    for rule in token_counts.RULES:
        got = token_counts.section_tokens(df, tokenizer_path(), rule, "s").toPandas()
        homes = [section_of(a, b, [(2, 8), (8, 13)], rule) for a, b in plain(text).offsets]
        mine = got[got["doc_id"] == 1].set_index("section")
        assert mine["n_tokens"].to_dict() == {i: homes.count(i) for i in sorted({*homes, 0, 1})}
        assert mine["n_crossing"].sum() == sum(
            not any(x <= a and b <= y for x, y in [(2, 8), (8, 13)]) and any(a < y and x < b for x, y in [(2, 8), (8, 13)])
            for a, b in plain(text).offsets
        )


def test_language(spark):
    words = {"aa": "lorem dolor amet sit ".split(), "bb": "zyx wvu tsr qpo ".split()}
    rows = [
        (i, " ".join(words[lang][(i + j * j) % 4] for j in range(40)) + " 123 !!", lang, "x")
        for i in range(40) for lang in [("aa", "bb")[i % 2]]
    ]
    rows += [(100, None, "aa", "x"), (101, "", None, "x"), (102, "12 %% 3", "bb", "x"), (103, "Zyx wvu", None, "x"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, ce string")
    got = langid.identify(docs).toPandas()
    assert len(got) == len(rows)
    by = got.drop_duplicates("doc_id").set_index("doc_id")
    for i, text, lang, _ in rows[:40]:
        assert by.loc[i, "lang_pred"] == lang and not by.loc[i, "rejected"]
    assert by.loc[103, "lang_pred"] == "bb"
    for i in (100, 101, 102):
        assert by.loc[i, "lang_pred"] == "und" and by.loc[i, "score"] == 0 and by.loc[i, "rejected"]
    assert got["score"].between(0, 1).all()
    blank = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert (blank["lang_pred"] == "und").all()
    assert langid.identify(docs.limit(0)).count() == 0


def test_kneser_ney_sums_to_one(spark):
    docs = spark.createDataFrame([("aa", "banana bandana cabana"), ("aa", "ban ana nab")], "lang string, text string")
    counts = langid.count_runs(docs)
    rows, _ = langid.runs([r["text"] for r in docs.collect()])
    assert counts.agg(F.sum("n")).first()[0] == len(rows)
    tables = langid.probabilities(counts)
    model = langid.train(docs)
    alphabet = [r["c3"] for r in tables[0].select("c3").collect()]
    contexts = {tuple(r[:3]) for r in rows.tolist()}
    for context in contexts:
        candidates = np.array([[*context, c] for c in alphabet], np.uint32)
        total = np.exp(model.log_probability("aa", candidates)).sum()
        unseen = np.exp(model.log_probability("aa", np.array([[*context, 0x7A]], np.uint32)))[0]
        assert abs(total + unseen - 1) < 1e-9


def test_a_model_beyond_the_arrays_scores_alike(spark, sf):
    docs = table(spark, sf, "documents").limit(60).union(
        spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 %", None, "s", 4), (-3, "漢字 qq", None, "s", 5)], table(spark, sf, "documents").schema)
    )
    arrays, tables = langid.train(docs), langid.train(docs, held_runs=10)
    assert arrays.tables is None and tables.tables is not None
    one, two = (
        langid.cross_entropies(docs, m, ["doc_id"]).toPandas().set_index("doc_id").sort_index()
        for m in (arrays, tables)
    )
    assert (one["n_symbols"] == two["n_symbols"]).all() and one["ce"].isna().equals(two["ce"].isna())
    both = one["ce"].notna()
    assert np.allclose(np.stack(one["ce"][both]), np.stack(two["ce"][both]), rtol=1e-9)


def test_the_driver_gets_no_rows_of_runs(spark, sf, monkeypatch):
    docs = table(spark, sf, "documents")
    rows, gather = [], type(docs).collect

    def collect(df):
        found = gather(df)
        rows.append(len(found))
        return found

    monkeypatch.setattr(type(docs), "collect", collect)
    model = langid.train(docs)
    runs = sum(len(keys) for tables in model.logs.values() for keys, _ in tables.values())
    assert 0 < 20 * sum(rows) < runs
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 1000)
    try:
        again = langid.train(docs)
    finally:
        spark.conf.set(size, before)
    assert again.langs == model.langs and again.unseen == model.unseen
    for one, two in ((model.logs, again.logs), (model.weights, again.weights)):
        for lang in model.langs:
            assert one[lang].keys() == two[lang].keys()
            for length, (keys, logs) in one[lang].items():
                assert (np.diff(keys) > 0).all()
                assert (keys == two[lang][length][0]).all() and (logs == two[lang][length][1]).all()


def test_held_out_accuracy(spark, sf):
    got = QUERIES["op6_language_id"](spark, sf).toPandas()
    docs = table(spark, sf, "documents").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert (both["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in both["doc_id"]]).all()
    held = both[both["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.97


def page(title, body, notice="Welcome to our site", extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>var a='<p>x</p>';</script></head>"
        f"<body><div>{notice}</div><ul class='menu'><li>Home<li>News</ul>{extra}<div><h1>{title}</h1>"
        f"{''.join(f'<p>{b}' for b in body)}</div><div>Imprint and terms</div></body>"
    )


def test_constant_nodes_are_template(spark):
    rows = [
        (i, "https://User@Host.example:80/x", page(f"T{i}", [f"a{i} &amp; b", "common line", f"z{i}"][: 2 + i % 2]), 1)
        for i in range(30)
    ]
    rows += [(100, "http://other.example/", page("Alone", ["one  two\n three"]), 1), (101, None, None, 1), (102, "nonsense", "", 1), rows[0]]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, template int")
    got = pages.extract(df).toPandas()
    assert len(got) == len(rows)
    by = got.drop_duplicates("page_id").set_index("page_id")["text"]
    for i in range(30):
        body = [f"a{i} & b", "common line", f"z{i}"][: 2 + i % 2]
        assert by[i] == "\n\n".join([f"T{i}", *body])
    assert by[100] == "\n\n".join(["Welcome to our site", "Alone", "one two three", "Imprint and terms"])
    assert by[101] == "" and by[102] == ""
    assert pages.extract(df.limit(0)).count() == 0


def test_marked_parts_are_no_content():
    body = (
        "<header>Top</header><nav>Menu</nav><div class='cookie-notice'>Cookies</div>"
        "<article><header><h1>Head &eacute;</h1><p>By me</p></header><p>One <b>two</b><br>three<p>Four"
        "<aside>Side</aside><form><input><label>Mail</label><p>Send</p></form>"
        "<table><tr><td>a<td>b</table><section id='comments'><p>Nice!</p></section></article><footer>End</footer>"
    )
    assert pages.main_text(body) == "Head é\n\nOne two three\n\nFour\n\na\n\nb"
    assert pages.main_text("<p>x<![bad[ y") .startswith("x")
    assert pages.main_text("a &am b &amp c") == "a &am b & c"


@pytest.mark.parametrize("around", [
    "class='content has-sidebar'", "id='page' class='site with-header'", "class='comment-enabled post'",
    "class='left-sidebar'", "class='sidebar'", "id=main-content class='no-menu'",
])
def test_names_around_content_do_not_cut_it(around):
    story = "The story of the day, which is longer than anything around it."
    side = "<div class='sidebar-inner'>Side</div><div id='related-posts'>More</div><div class='site-header'>Top</div>"
    assert pages.main_text(f"<div {around}><article><p>{story}</p></article>{side}</div>") == story
    assert pages.main_text(f"<div {around}><p>{story}</div>{side}") == story
    assert pages.main_text(f"<div {around}><h1>Day</h1></div><div><p>{story}</div>") == f"Day\n\n{story}"


def test_one_teaser_is_not_the_page():
    body = "A body in divs, far longer than the teaser beside it."
    assert pages.main_text(f"<div>{body}</div><article>Teaser</article>") == f"{body}\n\nTeaser"
    comments = "<div id='comments'><article class='comment'>Nice</article></div>"
    assert pages.main_text(f"<article>{body}</article><div>Imprint</div>{comments}") == body


def test_numbered_names_do_not_hide_templates(spark):
    rows = [
        (i, "http://blog.example/", f"<body class='post postid-{i}'><article id='post-{i}' class='post-{i} entry'>"
         f"<div>Read this blog</div><p>Story {i} of many</p><div id='a-story-{'abcdefghijkl'[i]}-told'><p>End {i}</div></article>")
        for i in range(12)
    ]
    got = pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Story {i} of many\n\nEnd {i}" for i in range(12)}


def test_wrappers_stay_as_large_as_a_page():
    import random

    tags, most, one = ["p", "h2", "ul", "table", "pre"], 0, None
    for seed in range(150):
        r = random.Random(seed)
        body = "".join(f"<{t}>{seed} {k}</{t}>" for k, t in enumerate(r.choices(tags, k=12)))
        tree = pages.wrapper(pages.skeleton(pages.parse(f"<body><div id='post-{seed}'>{body}</div>").root))
        most = max(most, pages._size_of(tree))
        one = tree if one is None else pages.merge(one, tree)
    assert pages._size_of(one) <= 5 * most


def test_merge_order_does_not_matter_for_templates():
    trees = [pages.wrapper(pages.skeleton(pages.parse(page(f"T{i}", [str(i)] * (1 + i % 3))).root)) for i in range(12)]
    one = trees[0]
    for t in trees[1:]:
        one = pages.merge(one, t)
    left, right = trees[11], trees[5]
    for t in trees[6:11]:
        left = pages.merge(left, t)
    for t in trees[:5]:
        right = pages.merge(right, t)
    assert pages.template_paths(one) == pages.template_paths(pages.merge(left, right))


def test_extraction_query(spark, sf):
    got = QUERIES["op2_html_extraction"](spark, sf).toPandas().set_index("page_id")
    for row in table(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S).group(1)
        blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
        assert got.loc[row["page_id"], "text"] == "\n\n".join(b for b in blocks if b)
        assert got.loc[row["page_id"], "n_chars"] == len(got.loc[row["page_id"], "text"])


def test_licenses(spark):
    prose = "The river runs past the old mill and the road follows it to the sea."
    rows = [
        (1, f"{prose}\nReleased under the MIT License.\n{prose}", "x"),
        (2, "Licensed under the Apache License, Version 2.0.", "x"),
        (3, prose, "x"), (4, None, "x"), (5, "", "x"), (6, "\n\n \n", "x"),
        (7, "This work is licensed under the GNU General Public License, version 3.\n" + LONG, "x"),
        (8, "Licensed under the Galactic Public Charter, Version 9, of the Free Moon Foundation.", "x"),
        (None, "Licensed under CC BY-NC 4.0.", "x"),
    ]
    docs = spark.createDataFrame([*rows, rows[1]], "doc_id bigint, text string, family string")
    got = licenses.license_paragraphs(docs).toPandas()
    found = [(None if d != d else d, p, f) for d, p, f in zip(got["doc_id"], got["paragraph"], got["family"])]
    assert (1, 1, "mit") in found and found.count((2, 0, "apache-2.0")) == 2
    assert (7, 0, "gpl") in found and (None, 0, "cc-by-nc") in found
    assert not {d for d, _, _ in found} & {3, 4, 5, 6}
    assert all(f == "unknown" for d, _, f in found if d == 8)
    assert licenses.license_paragraphs(docs.limit(0)).count() == 0


LONG_TEXT = "Long text of the article that goes on and on"
UNCLOSED = {
    "head without an end": ("<html><head><title>T</title><meta charset=utf-8><body><article><h1>Hi</h1><p>" + LONG_TEXT, f"Hi\n\n{LONG_TEXT}"),
    "head without end and body": (f"<head><title>T</title><link href=x><article><p>{LONG_TEXT}</article>", LONG_TEXT),
    "text ends a head": (f"<head><title>T</title>\n {LONG_TEXT} <b>here</b>", f"{LONG_TEXT} here"),
    "head is left out": (f"<head><title>T</title><noscript>x</noscript></head><body><p>{LONG_TEXT}", LONG_TEXT),
    "button": (f"<article><p>a<button>b after. <p>{LONG_TEXT}</article><p>c", f"ab after.\n\n{LONG_TEXT}"),
    "select, label, svg": (f"<main><div><select><option>x<p>{LONG_TEXT}</div><label>y<div>{LONG_TEXT}</div><svg><p>z</main>", f"x\n\n{LONG_TEXT}\n\ny\n\n{LONG_TEXT}\n\nz"),
    "closed ones go": (f"<p>{LONG_TEXT} <button>b <div>c</div><p>d</button> end</p><p><label>x</label><select><option>a<option>b</select>e", f"{LONG_TEXT} end\n\ne"),
    "scripts in buttons": ("<p>a <button>x<script>if (a</b) </button></script>y</button> b</p>", "a b"),
    "comment": ("before<!-- unclosed comment <p>after", "before"),
    "comments": ("a<!-->b<!--->c<!-- x --!>d<!-- <p>y -- > -->e", "abcde"),
    "p and li without ends": ("<ul><li>a<li>b<p>c<li>d</ul><p>e<p>f<div>g", "a\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng"),
    "ends of nothing": ("</div></p>a</article></button></select>b", "ab"),
    "text area": ("<p>a<textarea><p>x</textarea>b<textarea>y</body>c", "ab\n\nc"),
}


@pytest.mark.parametrize("name", sorted(UNCLOSED))
def test_omitted_and_missing_end_tags(name):
    html_text, want = UNCLOSED[name]
    got = pages.main_text(html_text)
    assert got.replace("\n\nc", "c") == want.replace("\n\nc", "c") if name == "text area" else got == want


@pytest.mark.parametrize("tag", ["div", "span", "li", "button", "b", "table"])
def test_deeply_nested_pages(tag):
    n = 20_000
    page = "<body>" + f"<{tag}>" * n + LONG_TEXT + f"</{tag}>" * n + "<p>after"
    text = pages.main_text(page)
    assert "after" in text and (LONG_TEXT in text) == (tag != "button")
    w = pages.wrapper(pages.skeleton(pages.parse(page).root))
    merged = pages.merge(w, pages.wrapper(pages.skeleton(pages.parse(page + "x").root)))
    assert pages.template_paths(merged, 2) is not None
    assert json.loads(json.dumps(merged)) == merged


def test_deep_pages_among_others(spark):
    rows = [(i, f"http://a.b/{i}", "<div>" * (3_000 if i == 3 else 3) + f"page {i} <p>{LONG_TEXT} {i}") for i in range(12)]
    got = pages.extract(spark.createDataFrame(rows, "page_id int, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == {i: f"page {i}\n\n{LONG_TEXT} {i}" for i in range(12)}
