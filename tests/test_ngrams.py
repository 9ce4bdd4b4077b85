"""TF-IDF and central comments against a plain Python computation."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxmill.operators import exemplars, ngrams, ordering

WORDS = ["کارت", "وجه", "انتقال", "خطا", "کند", "خوب"]


def documents(n=60):
    docs = []
    for i in range(n):
        words = [WORDS[(i * 7 + j * j) % 6] for j in range(i % 9)]
        docs.append((i, " ".join(words), ["negative", "neutral", "positive"][i % 3]))
    return docs


def tfidf(texts, n, min_df, max_df, max_features):
    grams = [Counter(" ".join(t[i:i + n]) for i in range(len(t) - n + 1)) for t in (x.split() for x in texts)]
    df, total = Counter(), Counter()
    for g in grams:
        df.update(g.keys())
        total.update(g)
    kept = [g for g in df if min_df <= df[g] <= max_df * len(texts)]
    kept = set(sorted(kept, key=lambda g: (-total[g], g))[:max_features])
    score = Counter()
    for g in grams:
        w = {x: c * (math.log((1 + len(texts)) / (1 + df[x])) + 1) for x, c in g.items() if x in kept}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for x, v in w.items():
            score[x] += v / norm
    return {g: round(s, 4) for g, s in score.items()}


def test_tfidf_of_groups(spark):
    docs = documents()
    df = spark.createDataFrame(docs, "id long, description string, grp string")
    for cap in (1000, 5):
        rows = ngrams.tfidf_ngrams(df, ns=(2, 3), top_k=1000, group="grp", max_features=cap).collect()
        for grp in ("all", "negative", "neutral", "positive"):
            texts = [d[1] for d in docs if grp in ("all", d[2])]
            for n in (2, 3):
                mine = {r.ngram: r.tfidf for r in rows if r.grp == grp and r.n == n}
                expected = tfidf(texts, n, 3, 0.6, cap)
                assert mine.keys() == expected.keys()
                assert all(abs(mine[g] - expected[g]) < 2e-4 for g in mine)


def test_large_vocabularies_give_the_same_report(spark, monkeypatch):
    """Beyond the size that is broadcast, counts are joined by a shuffle; with totals asked for, grams are counted first."""
    df = spark.createDataFrame(documents(), "id long, description string, grp string")
    report = lambda **options: sorted(map(tuple, ngrams.tfidf_ngrams(df, ns=(2, 3), top_k=50, group="grp", **options).collect()))
    expected = report()
    assert expected == report(max_features=10_000)
    monkeypatch.setattr(ngrams, "MAX_BROADCAST_GRAMS", 0)
    assert expected and expected == report() == report(max_features=10_000)


def test_grams_scored_first_do_not_change_the_report(spark, monkeypatch):
    """However few grams are scored first, those that can reach the last rank are scored too."""
    df = spark.createDataFrame(documents(), "id long, description string, grp string")
    report = lambda: sorted(map(tuple, ngrams.tfidf_ngrams(df, ns=(2, 3), top_k={2: 6, 3: 4}, group="grp").collect()))
    expected = report()
    for few in (1, 7):
        monkeypatch.setattr(ngrams, "SCORED_FIRST", few)
        assert expected and report() == expected


def test_gram_keys_count_each_gram_once(spark):
    docs = documents(30)
    df = spark.createDataFrame(docs, "id long, description string, grp string").withColumn("t", F.split("description", " "))
    rows = df.select("id", F.inline(ngrams.gram_keys(F.col("t"), (2, 3)))).collect()
    spelled = {}
    for i, text, _ in docs:
        words = text.split(" ")
        for code, n in enumerate((2, 3)):
            tf = Counter(" ".join(words[j:j + n]) for j in range(len(words) - n + 1))
            assert sorted(tf.values()) == sorted(r.tf for r in rows if r.id == i and r.code == code)
            spelled[code] = spelled.get(code, set()) | tf.keys()
    assert len({r.key for r in rows}) == len(spelled[0]) + len(spelled[1])


def test_most_frequent_grams_of_several_lengths(spark):
    """Equal counts at the last place are told apart by the gram; the document may be known by its text only."""
    docs = documents(50)
    df = spark.createDataFrame(docs, "id long, description string, grp string")
    for id in ("id", None):
        rows = ngrams.top_ngrams_of(df, ns=(1, 2, 3), limit=5, id=id).collect()
        for n in (1, 2, 3):
            total = Counter(" ".join(w[i:i + n]) for w in (d[1].split() for d in docs) for i in range(len(w) - n + 1))
            expected = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:5]
            assert sorted(((r.ngram, r.total) for r in rows if r.n == n), key=lambda x: (-x[1], x[0])) == expected


def test_every_value_of_the_group_column(spark):
    """Groups that nobody named, many and small: the same comments as with all of them named."""
    rows = [(i, f"{WORDS[i % 6]} {WORDS[i // 7 % 6]} {WORDS[i // 3 % 6]} لطفا امکان اضافه", f"g{i % 40}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, description string, grp string")
    named = [f"g{i}" for i in range(40)]
    for job in (exemplars.representative, exemplars.buckets):
        mine = sorted(map(repr, job(df, group="grp").collect()))
        assert mine and mine == sorted(map(repr, job(df, group="grp", groups=named).collect()))


def test_comments_are_scored_without_writing_their_terms(spark):
    """What representative and buckets write is a few numbers per comment, not its terms."""
    from pathlib import Path

    from voxmill import session

    rng = random.Random(5)
    rows = [(i, " ".join(f"{rng.choice(WORDS)}{rng.randrange(400)}" for _ in range(300)), f"g{i % 2}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, description string, grp string")
    for job in (exemplars.representative, exemplars.buckets):
        before = len(session._WRITTEN)
        assert job(df, group="grp").count() >= 14
        written = sum(f.stat().st_size for path in session._WRITTEN[before:] for f in Path(path).glob("*.parquet"))
        assert written < sum(len(r[1]) for r in rows) / 2


@pytest.mark.parametrize("broadcast", [True, False])
def test_centrality_by_hand(spark, monkeypatch, broadcast):
    """Against plain Python, with ids that are given twice, in one group and in two, and missing ids."""
    monkeypatch.setattr(exemplars, "MAX_BROADCAST_NORMS", 10**6 if broadcast else 0)
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]) for _ in range(rng.randrange(5, 12)))
    rows = [(i, text(), f"g{i % 3}") for i in range(40)]
    plain, odd = rows, [*rows, (3, text(), "g0"), (4, text(), "g2"), (None, text(), "g1"), (90, text(), "tiny")]
    for given in (plain, odd):
        df = spark.createDataFrame(given, "id long, description string, grp string")
        expected = []
        for g in {r[2] for r in given}:
            mine = [r for r in given if r[2] == g]
            tf = {}
            for i, t, _ in mine:
                w = t.split(" ")
                tf.setdefault(i, Counter()).update([*w, *map(" ".join, zip(w, w[1:]))])
            df_of = Counter(term for c in tf.values() for term in c)
            d = len(mine)
            kept = {t: math.log((1 + d) / (1 + n)) + 1 for t, n in df_of.items() if 2 <= n <= (1.0 if d * 0.85 < 2 else 0.85) * d and d >= 3}
            w = {i: {t: n * kept[t] for t, n in c.items() if t in kept} for i, c in tf.items() if i is not None}
            norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in w.items()}
            centre = Counter()
            for i, v in w.items():
                for t, x in v.items():
                    centre[t] += x / norm[i]
            length = math.sqrt(sum(x * x for x in centre.values()))
            for i, t, _ in mine:
                score = sum(x / norm[i] * centre[term] for term, x in w.get(i, {}).items()) / length if d >= 3 else None
                expected.append((g, i, t, d, score))
        found = [tuple(r) for r in exemplars.centrality(df, group="grp", stopwords=[]).collect()]
        order = lambda r: (r[0], r[1] or -1, r[2])
        assert [r[:4] for r in sorted(found, key=order)] == [r[:4] for r in sorted(expected, key=order)]
        for a, b in zip(sorted(found, key=order), sorted(expected, key=order)):
            assert (a[4] is None) == (b[4] is None) and (a[4] is None or abs(a[4] - b[4]) < 2e-6)


def test_too_few_documents_give_nothing(spark):
    df = spark.createDataFrame(documents(4), "id long, description string, grp string")
    assert ngrams.ngram_report(df).count() == 0


def test_report_split():
    assert ngrams.split_top_k(25) == {2: 15, 3: 10} and ngrams.split_top_k(60) == {2: 36, 3: 24}


def test_few_comments_are_picked_by_length(spark):
    rows = [(1, "x" * 25 + " لطفا", "negative"), (2, "y" * 40, "negative"), (3, "short", "negative")]
    df = spark.createDataFrame(rows, "id long, description string, grp string")
    picked = {(r.bucket, r["rank"]): r.id for r in exemplars.buckets(df, group="grp").collect()}
    assert picked == {("core", 1): 2, ("core", 2): 1, ("suggestions", 1): 1}


def test_outliers_and_suggestions_leave_out_used_texts(spark):
    same = "برنامه خیلی خوب و سریع است"
    rows = [(i, same, "positive") for i in range(6)] + [(10, "لطفا امکان انتقال سریع اضافه شود", "positive"), (11, "هیچ چیز مشترک ندارد اینجا", "positive")]
    df = spark.createDataFrame(rows, "id long, description string, grp string")
    out = exemplars.buckets(df, group="grp", core=2, outliers=2, suggestions=3, stopwords=[]).collect()
    by = lambda b: [r.id for r in sorted(out, key=lambda r: r["rank"]) if r.bucket == b]
    # Both odd texts keep no term (the shared word is in 7 of 8 texts), so both score 0.
    assert by("core") == [0, 1] and by("outliers") == [10, 11] and by("suggestions") == []


def test_comments_are_prepared_seldom_and_not_gathered_by_group(spark, monkeypatch):
    calls, plans = spark.sparkContext.accumulator(0), []

    @F.udf("string")
    def prepared(text):
        calls.add(1)
        return text

    cut = exemplars.cut_lineage

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(exemplars, "cut_lineage", noted)
    rows = [(i, f"comment number {i % 7} says word{i % 5} and word{i % 3}", ["a", "b", None][i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, raw string, grp string").select("id", "grp", prepared.asNondeterministic()("raw").alias("description"))
    assert exemplars.representative(df, group="grp").count() == 14
    assert calls.value <= 3 * len(rows)  # for their facts, their terms, and to be looked up
    pairs = [p for p in plans if "Generate inline" in p]
    assert pairs and not any("hashpartitioning(grp" in p for p in pairs)  # sizes of groups are measured, comments stay where they are


def test_position_is_independent_of_slots(spark):
    df = spark.range(500).select((F.col("id") * 37).alias("o"), (F.col("id") % 3).alias("g"))
    rows = ordering.add_position(df, ["g"], "o", "p", slot_width=100).collect()
    for g in range(3):
        ordered = sorted(r.o for r in rows if r.g == g)
        assert {r.o: r.p for r in rows if r.g == g} == {o: i for i, o in enumerate(ordered)}


def test_skewed_join_is_a_plain_join(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k != 7")
    expected = sorted(map(tuple, rows.join(stats, "k").select("id", "k", "n").collect()))
    for hot in (1, 5, 1000):
        mine = ordering.join_skewed(rows, stats, ["k"], "n", hot=hot).select("id", "k", "n").collect()
        assert sorted(map(tuple, mine)) == expected
