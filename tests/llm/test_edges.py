"""Nulls, empty and long texts, ties, repeated rows, empty tables, columns whose names clash; and plans that do not change results."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import plain
from tests.llm.pages import PAGES
from voxmill.llm import chat_format, components, language_id, main_text, mixing, ngram_join, packing, perplexity, pivot_dedup, suffix_dedup, token_counts

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(40_000))
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ROWS = [
    (1, SAME, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, SAME, None, "b"), (4, SAME, None, "b"), (5, SAME + " end", "en", None),
    (None, SAME, "en", "a"), (6, " \n\t ", "en", "b"), (7, "x", "de", ""), (8, LONG, "en", "b"), (9, "a\u2028é 漢字 <|endoftext|> \u200c🙂 İ", "fr", "a"),
    (10, "aaaa" * 5000, "en", "c"), (11, "12345 67890 !!!", "en", "a"), (12, "aaaa" * 200, "en", "c"),
]
CLASH = ["key", "block", "kind", "bucket", "a", "b", "n", "cid", "token", "_row", "_text", "_bytes", "_block", "pass", "start", "size", "words", "code", "c", "p", "ids", "score", "position", "last", "_carried_0", "task"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return frame.select("*", *[F.lit(f"{c}!").alias(c) for c in CLASH]).repartition(3).cache()


OPERATORS = {
    "token_counts": token_counts.token_counts, "suffix_dedup": suffix_dedup.remove_repeats, "ngram_join": ngram_join.ngram_components,
    "language_id": language_id.predict_language, "perplexity": perplexity.score_quality, "mixing": mixing.mix,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(docs, name):
    got = OPERATORS[name](docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []


NAMED = OPERATORS | {"packing": packing.pack}


@pytest.mark.parametrize("name", sorted(NAMED.keys() - {"suffix_dedup"}))  # which returns all columns
def test_names_in_another_case_and_with_dots(spark, name):
    """What counts is the column as it is written; others are of no account, whatever they are called."""
    rows = [(1, SAME, "en", "a"), (2, SAME + " end", "de", "b"), (3, None, None, None)]
    bare = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    odd = bare.select(F.lit("x").alias("TEXT"), F.lit(9).alias("Doc_ID"), "doc_id", "text", "lang", "source", F.lit("y").alias("a.b"), F.lit("z").alias("Lang"), F.lit(0).alias("source.x"), F.lit("q").alias("SOURCE"))
    names = [c for c in NAMED[name](bare).columns]
    take = lambda frame: sorted(str(tuple(r)) for r in NAMED[name](frame).select(*names).collect())
    assert take(odd) == take(bare)


def test_dotted_columns_are_carried(spark):
    rows = [(1, SAME, "en", "a", 5), (2, SAME * 3, "de", "b", 6)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `a.b` int")
    assert {tuple(r)[:5] for r in language_id.identify(odd).collect()} == {tuple(r) for r in rows}
    assert {r["a.b"] for r in mixing.mix_documents(odd).collect()} <= {5, 6}
    for _, stage in corpus_pipeline.STAGES[:4]:
        odd = corpus_pipeline.written(stage(spark, odd, ""))
        assert odd.columns == ["doc_id", "text", "lang", "source", "a.b"]


def test_tokens_of_odd_texts(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for _, t, _, _ in ROWS)
    for frequent in (262_144, 3):
        assert sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, frequent=frequent).collect()) == want


def test_repeats_of_odd_texts(docs):
    known = [(d, t) for d, t, _, _ in ROWS if d is not None]
    want = {d: w[:4] for d, w in plain.without_repeats(list(dict(known).items()), 50).items()}
    for plan in ({}, {"block_bytes": 20_000, "bucket_entries": 50, "hot_share": 0.001, "sample_docs": 1000}):
        got = suffix_dedup.remove_repeats(docs, keep_text=True, **plan).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None} == want
        assert [(r.n_removed, r.text) for r in got if r.doc_id is None] == [(0, SAME)]
        assert all(r.bucket == "bucket!" and sum(s.end - s.first for s in r.spans) == r.n_removed for r in got)


def test_components_of_odd_texts(docs):
    known = dict((d, t) for d, t, _, _ in ROWS if d is not None)
    want = plain.jaccard_components(list(known.items()), 4, 85)
    for plan in ({}, {"few": 2, "bucket_rows": 10, "block": 2, "salt_rows": 1, "sketch_bits": 10, "broadcast_rows": 0}):
        got = ngram_join.ngram_components(docs, **plan).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
        assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_large_clusters_meet_by_size(spark):
    """A cluster of sets of many sizes: only neighbouring sizes are compared, and the links are the same."""
    import random

    rng = random.Random(3)
    common = [f"c{i}" for i in range(12)]
    rows = []
    for i in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 20, 21, 22, 60, 150]))]
        rows += [(2 * i, " ".join(common + own)), (2 * i + 1, " ".join(common + own[:-1] + ["x"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain.jaccard_components(rows, 4, 85)
    for plan in ({}, {"block": 8}, {"block": 8, "sketch_bits": 6}, {"block": 8, "sketch_bits": 6, "salt_rows": 20}):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, **plan).collect()} == want


def test_choice_of_matches():
    import numpy as np

    assert ngram_join.choose_matches(np.zeros(200), 30, 1) == 1
    assert ngram_join.choose_matches(np.full(200, 50.0), 30, 100) == 12  # costly candidates: share many
    assert ngram_join.choose_matches(np.zeros(200), 30, 100, lookup=10.0, chance=0.0) == 1  # costly lookups: a short prefix


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 99), (7, 7), (None, 3), (200, 150), (200, 160)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {99: 99, 100: 99, 101: 99, 150: 150, 160: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_cost_the_driver_the_same_for_long_chains(spark):
    import random

    from voxmill import session

    pick = random.Random(5)
    names = [pick.randrange(-(2**62), 2**62) for _ in range(2000)]
    chain = [(names[i], names[i + 1]) for i in range(900)] + [(names[1000], x) for x in names[1001:1500]] + [(pick.choice(names[1500:]), pick.choice(names[1500:])) for _ in range(300)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(5)
    before = len(session._WRITTEN)
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert len(session._WRITTEN) - before == 1  # the edges, whatever their paths
    parent = {x: x for e in chain if e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in chain:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}
    assert {r.node: r.root for r in components.components(edges, task_edges=100).collect()} == got  # in rounds


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1),
        (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1e-30, 1e-32], 1), (13, [0.0, 1.0], 1),
    ]
    vectors = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, cid string, key string")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in pivot_dedup.near_duplicates(vectors).collect()}
    alone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 13)}
    assert got == alone | {(1, 3, 1, True), (2, 3, 1, False), (12, 3, 1, False), (None, 0, None, False)}
    assert pivot_dedup.near_duplicates(vectors.limit(0)).collect() == []


def test_recall_of_the_index(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    crowd = rng.normal(size=32) + 0.05 * rng.normal(size=(200, 32))
    near = base[:150] + 0.1 * rng.normal(size=(150, 32))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(np.concatenate((base, near, crowd)))]
    rows = [(i, v, 0) for i, v, _ in rows]
    want = plain.cosine_links(rows, 0.98)
    for plan in ({}, {"block": 40}):
        got = {r.vec_id: r.n_links for r in pivot_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), **plan).collect()}
        assert all(got[i] <= n for i, (n, _) in want.items())
        assert sum(got.values()) >= 0.95 * sum(n for n, _ in want.values()) > 10_000


def test_a_rare_length_beside_a_common_one(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    common = rng.normal(size=(300, 16))
    rare = rng.normal(size=12) + 0.01 * rng.normal(size=(9, 12))  # the sample gives them one pivot, or none
    rows = [(i, v.tolist(), 0) for i, v in enumerate(common)] + [(1000 + i, v.tolist(), 0) for i, v in enumerate(rare)]
    # One id for two vectors: each links with its own kind.
    rows += [(2000, rare[0].tolist(), 1), (2000, common[0].tolist(), 1), (2001, rare[0].tolist(), 1), (1999, (common[0] * 1.001).tolist(), 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for plan in ({}, {"pivots": 16}):
        got = pivot_dedup.near_duplicates(vectors, **plan).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if 1000 <= r.vec_id < 1999) == [(1000 + i, 8, 1000) for i in range(9)]
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id >= 1999) == [(1999, 1, 1999), (2000, 1, 1999), (2000, 1, 2000), (2001, 1, 2000)]


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "no tags at all, only words that run on"), (4, "u", "<p>unclosed <b>bold &amp; &eacute;&#233; <script>x<y</p>"), (None, "u", "<<>>&&<!-- <p>"), (5, "u", "<p>" + "w " * 200_000)]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in main_text.extract_main_text(frame).collect()}
    assert (got[1].text, got[2].text) == ("", "") and got[3].text == pages[2][2]
    assert got[4].text.startswith("unclosed bold & éé") and got[5].n_chars == 399_999
    assert main_text.extract_main_text(frame.limit(0)).collect() == []


def test_a_head_without_an_end_tag_ends():
    article = "<article><h1>Rain stops the harvest</h1><p>Farmers in the north have had to stop the harvest after two weeks of rain.</p></article>"
    want = "Rain stops the harvest Farmers in the north have had to stop the harvest after two weeks of rain."
    silent = "<title>Page title</title><meta charset=utf-8><link rel=x href=y><style>p {}</style><script>run()</script><template><p>Not shown to anyone</p></template>"
    for head in ("<head>", "<head><head>", f"<head>{silent}", f"<head>{silent}\n<noscript>Turn scripts on"):
        for end in ("<body>", "</head><body>", "<body class=page>\n"):
            assert main_text.main_text(f"<html>{head}{end}{article}") == want
    assert main_text.main_text(f"<html><head>{silent}{article}") == want
    assert main_text.main_text(f"<html><head>{silent}<img src=a>{article}") == want
    assert main_text.main_text(f"<html><head>{silent}Plain words that stand in no element of any kind") == "Plain words that stand in no element of any kind"


def _recall_and_precision(got, want):
    got, want = Counter(got.split()), Counter(want.split())
    both = (got & want).total()
    return both / max(1, want.total()), both / max(1, got.total())


def test_labelled_pages_are_told_apart():
    for page in main_text.LABELLED:
        want = " ".join(b.text for b in main_text.read_page(page).blocks() if b.label)
        assert min(_recall_and_precision(main_text.main_text(page), want)) >= 0.9


def test_pages_that_weights_were_not_fitted_on():
    scores = []
    for page in PAGES:
        marked = " ".join(re.findall("⟦(.*?)⟧", page, re.DOTALL))
        want = " ".join(re.sub("<[^>]*>", "", marked).split())
        got = main_text.main_text(page.replace("⟦", "").replace("⟧", ""))
        scores.append(_recall_and_precision(got, want))
    recall, precision = (sum(s[i] for s in scores) / len(scores) for i in (0, 1))
    assert len(PAGES) >= 40 and recall >= 0.97 and precision >= 0.97
    assert sum(r < 0.85 for r, _ in scores) == 0


ARTICLE = "<h1>Rain stops the harvest</h1><p>Farmers in the north have had to stop the harvest after two weeks of rain.</p>{}<p>Help is on its way, the ministry said on Monday, and more will follow.</p>"
WANT = "Rain stops the harvest Farmers in the north have had to stop the harvest after two weeks of rain. {}Help is on its way, the ministry said on Monday, and more will follow."


@pytest.mark.parametrize("page", [
    '<html><body class="has-banner menu-open"><article>{}</article></body></html>', '<article class="notice">{}</article>', '<div id="side-effects">{}</div>', '<div class="legal">{}</div>',
    '<div class="ad comments footer">{}</div>', "<a id=top><article>{}</article>", "<a name=x><div>{}</div>", '<a href=/><div class="entry">{}</div>', "<!-- <article>{}</article>", "<body>{}", '<form class="search">{}</form>',
])
def test_no_name_empties_a_page(page):
    assert main_text.main_text(page.format(ARTICLE.format(""))) == WANT.format("")


@pytest.mark.parametrize("block", [
    "<p><a href=/a>The whole report on the harvest</a></p>", "<ul><li><a href=/a>First part</a></li><li><a href=/b>Second part</a></li></ul>", "<p>It holds that <math><mi>a</mi><mo>=</mo><mi>b</mi></math> for all.</p>",
    '<p class="social">Social help is paid to those who lost their crop.</p>', "<table><tr><td>Wheat</td><td>12</td></tr></table>", "<h3>Next steps</h3>", "<pre>a b</pre>",
])
def test_nothing_is_dropped_from_the_middle(block):
    inner = " ".join(re.sub("</(?:td|li|tr|ul|table)>", " ", block).split())
    want = " ".join(re.sub("<[^>]*>", "", inner).split()) + " "
    for page in ("<body><article>{}</article></body>", "<body><div>{}</div></body>", "<body>{}</body>"):
        assert main_text.main_text(page.format(ARTICLE.format(block))) == WANT.format(want)


def test_very_deep_pages():
    page = "<div class=x>some words that stand in a row here " * 20_000
    assert main_text.main_text(page) == " ".join(["some words that stand in a row here"] * 20_000)


def test_best_run():
    assert main_text.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert main_text.best_run([-1, -2]) == (0, 0)
    assert main_text.best_run([1, -1, 1]) == (0, 1)


def test_language_of_odd_texts(docs):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_language(docs).collect()}
    assert all(got[i] == ("und", 0.0) for i in (2, 3, 6, 11))
    assert language_id.predict_language(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()[0][0] == "und"


def test_quality_of_odd_texts(docs):
    a, b = (sorted(map(str, perplexity.score_quality(docs, max_entries=m).drop("log_perplexity").collect())) for m in (4_000_000, 0))
    assert a == b


def test_bands_reject_labelled_bad_and_spare_labelled_good(spark):
    folder = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet")
    fine = [r for r in perplexity.score_quality(texts).collect() if not r.base_failed and r.doc_id in quality]
    bad, good = ([r.kept for r in fine if quality[r.doc_id] == q] for q in (0, 1))
    assert bad.count(False) >= 0.7 * len(bad) and good.count(False) <= 0.07 * len(good)
    symbols = [r.kept for r in fine if r.n_symbols > r.n_words and quality[r.doc_id] == 0]
    assert len(symbols) >= 10 and symbols.count(False) >= 0.7 * len(symbols)


def test_a_large_source_does_not_set_the_bands(spark):
    rows = [("en", "large", 1.0)] * 900 + [("en", f"s{i % 9}", 2.0 + i / 100) for i in range(90)] + [("de", None, 1.5)] * 3
    scored = spark.createDataFrame(rows, "lang string, source string, log_perplexity double")
    got = {r.lang: (r.lower, r.upper) for r in perplexity.bands(scored, 1.5, 0.01).collect()}
    assert got["en"][0] < 2.0 and got["en"][1] > 2.89
    assert got["de"] == pytest.approx((1.47, 1.53))


def test_kneser_ney_sums_to_one(spark):
    texts = spark.createDataFrame([("en", "abab cab"), ("en", "bab")], "lang string, _text string")
    model = perplexity.kneser_ney(perplexity.ngram_counts(texts)).collect()
    by_context = {}
    for r in model:
        by_context.setdefault(r.code >> 12, []).append(2.718281828459045**r.logp)
    assert all(0 < sum(p) <= 1 + 1e-9 for p in by_context.values())


def test_packing_of_odd_texts(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(docs, window=64).collect()
    want = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in ROWS)
    assert sum(r.length for r in got) == want and all(len(r.ids) == 4 * r.length for r in got)
    assert packing.pack(docs.limit(0)).collect() == []


def test_best_fit():
    assert packing.best_fit_decreasing([5, 5, 4, 3, 2, 1], 10) == [[0, 1], [2, 3, 4, 5]]
    poured = packing.pour([("d", 0, 13, bytes(4 * 13))], 8)
    assert [[len(p[3]) // 4 for p in w] for w in poured] == [[8], [4], [1]]


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "\\<turn x>\n</turn>\\"), (1, 1, "assistant", "\\<turn x>\n</turn>\\"), (2, None, None, "### "), (None, 5, "assistant", "a" * 300_000), (3, 0, "as>sis\\tant", "")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, position string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 3, 2: 1, 3: 1, None: 1}
    assert (got[1].loss_chars, got[None].loss_chars, got[3].loss_chars) == (2 * len(rows[1][3]), 300_000, 0)
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0))).collect() == []


def test_template_language():
    t = chat_format.Template("{% if 1 == 1 and not false %}A{{ 'b' + \"c\" }}{% else %}X{% endif %}{% for m in turns %}[{{ m.role | upper }}:{% generation %}{{ m.text | trim | escape }}{% endgeneration %}]{% endfor %}.")
    assert t.tree[0] == chat_format.Out(chat_format.Const("A" + "bc")) or isinstance(t.tree[0], chat_format.If)
    pieces = t.pieces(turns=[{"role": "u", "text": " </turn> "}, {"role": "v", "text": None}])
    assert "".join(p for p, _ in pieces) == "Abc[U:\\</turn>][V:]." and [p for p, g in pieces if g] == ["\\</turn>"]
    for bad in ("{% if x %}", "{{ a.__class__ }}", "{{ f(x) }}", "{{ x | shell }}", "{% import os %}", "{% endfor %}", "text without a loop"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.Template(bad)
    assert all(chat_format.unescape(chat_format.escape(x)) == x for x in ("\\", "\\\\<turn", "###</turn>\\###", ""))


def test_mix_is_split_exactly(docs):
    import numpy as np

    counts = np.array([50, 0, 700, 3])
    left = mixing.split_counts(counts, 300, (1, 2))
    assert left.sum() == 300 and (left <= counts).all() and (left >= 0).all()
    rows, placed = mixing.mix_blocks(docs, block=8, shard_blocks=16)
    got = placed.collect()
    assert len({(r["_row"], r["pass"], r.start) for r in got}) == len(got)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.position)
    assert all(sorted(p) == list(range(len(p))) and len(p) <= 16 for p in shards.values())
    assert mixing.source_targets(["b", None, "a"], [10, 10, 0], (5, 2, 1), 3) == [pytest.approx(40 / 3), pytest.approx(20 / 3), 0.0]


@pytest.mark.parametrize("urn", [(30, 50, 20), (700, 300, 650), (5, 10_000, 400), (9_000, 8, 5_000), (40, 2, 41)])
def test_large_draws_follow_the_law(urn):
    """Frequencies of draws against the exact probabilities of small urns."""
    import numpy as np
    from math import comb

    good, bad, sample = urn
    rng, n = np.random.default_rng(8), 20_000
    got = np.bincount([mixing.large_draw(rng, *urn) for _ in range(n)], minlength=min(good, sample) + 1)
    want = np.array([comb(good, k) * comb(bad, sample - k) / comb(good + bad, sample) if 0 <= sample - k <= bad else 0.0 for k in range(min(good, sample) + 1)])
    often = want * n >= 5
    chi = ((got[often] - n * want[often]) ** 2 / (n * want[often])).sum()
    assert not got[want == 0].any() and chi < often.sum() + 5 * (2 * often.sum()) ** 0.5


def test_huge_draws():
    import numpy as np

    rng = np.random.default_rng(9)
    good, bad, sample = 3 * 10**13, 7 * 10**13, 4 * 10**12
    found = np.array([mixing.large_draw(rng, good, bad, sample) for _ in range(4000)], float)
    spread = (sample * 0.3 * 0.7 * (good + bad - sample) / (good + bad)) ** 0.5
    assert abs(found.mean() - 0.3 * sample) < 4 * spread / 4000**0.5 and 0.95 < found.std() / spread < 1.05
    x, y = 10**13, 3_000_000
    exact = sum(np.log1p(np.arange(1, 1001) / x)) + 1000 * np.log(x)
    assert abs(mixing.log_factorial_step(x, 1000) - exact) < 1e-7 and abs(mixing.log_factorial_step(x + y, -y) + mixing.log_factorial_step(x, y)) < 1e-6
    counts = np.array([10**13, 0, 5, 2 * 10**12])
    left = mixing.split_counts(counts, 6 * 10**12, (1,))
    assert left.sum() == 6 * 10**12 and (left <= counts).all() and (left >= 0).all()


def test_frequent_pre_tokens_are_bounded(spark):
    counts = spark.createDataFrame([(f"p{i}", 1 + i // 100) for i in range(1000)], "pre_token string, occurrences long")
    for most in (0, 50, 100, 250, 1000, 5000):
        least = token_counts.least_occurrences(counts, most)
        assert counts.filter(F.col("occurrences") >= least).count() <= most
    assert token_counts.least_occurrences(counts, 1000) == 1 and token_counts.least_occurrences(counts, 250) == 9


def test_near_duplicates_of_repeated_ids(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
    a, b = " ".join(words), " ".join(reversed(words))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b), (4, ""), (4, None), (4, ""), (5, "x"), (5, "x"), (6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, a), (1, b), (4, ""), (4, None), (5, "x")], key=str)


def test_cut_words():
    assert mixing.cut_words(" a b\tc  d e", [(1, 2)]) == "b\tc"
    assert mixing.cut_words("a b c d", [(3, 1), (0, 2)]) == "a b\nd"


def test_stages_with_odd_rows(spark, docs):
    plain_docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (plain_docs, plain_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(stage(spark, frame, ""))
            if name != "packing":
                assert frame.columns == plain_docs.columns
    assert frame.count() == 0
