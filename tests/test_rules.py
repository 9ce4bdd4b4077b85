import pytest
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.functions import model_output as mo
from voxmill.functions import rules
from voxmill.operators import evaluation

C = F.col


@pytest.mark.parametrize("text,rating,m1,m2,expected", [
    ("متن", 1, "mixed", "NEGATIVE", ("negative", 2, True)),
    ("متن", 3, "mixed", "NEGATIVE", ("mixed", 3, False)),
    ("متن", 5, "Neutral", "POSITIVE", ("positive", 4, True)),
    ("متن", 5, "negative", "POSITIVE", ("negative", 2, False)),
    (" ", 1, "mixed", "NEGATIVE", ("no comments", 0, False)),
    (None, 1, None, None, ("no comments", 0, False)),
    ("عالیه", 1, "negative", None, ("very positive", 5, False)),
    ("عالیه ", 1, "negative", None, ("negative", 2, False)),
    ("بابت تاخیر عذر خواهی", 1, "negative", None, ("no sentiment expressed", 3, False)),
    ("متن", None, "", None, ("no sentiment expressed", 3, False)),
    ("متن", 1, "Weird", None, ("no sentiment expressed", 3, False)),
])
def test_cascade(spark, text, rating, m1, m2, expected):
    df = spark.createDataFrame([(text, rating, m1, m2)], "t string, r int, a string, b string")
    assert tuple(df.select(rules.sentiment_cascade(C("t"), C("r"), C("a"), C("b")).alias("x")).first().x) == expected


def test_failed_row_and_signed_scale(spark):
    df = spark.createDataFrame([("متن", 1, "mixed", "NEGATIVE")], "t string, r int, a string, b string")
    row = df.select(
        rules.sentiment_cascade(C("t"), C("r"), C("a"), C("b"), failed=F.lit(True)).alias("f"),
        rules.sentiment_cascade_apps(C("t"), C("r"), C("a"), C("b")).alias("s")).first()
    assert tuple(row.f) == ("Missed Value", 11, False) and tuple(row.s) == ("negative", -1, True)


def test_title_rules(spark):
    df = spark.createDataFrame([("بخش کارت‌ها",), ("کارت",), ("خرید  شارژ",), (None,), ("چیز دیگر",)], "t string")
    assert [r[0] for r in df.select(rules.feature_from_title(C("t"))).collect()] == ["card", "card", "top-up", "other", "other"]


def reply(spark, raw, greedy=False):
    df = spark.createDataFrame([(raw,)], "r string")
    return df.select(mo.extract_json(C("r"), schemas.CATEGORY_REPLY, greedy).alias("x")).first().x


def test_extract_json(spark):
    assert reply(spark, 'text ```json\n{"category": "ui"}\n``` more').category == "ui"
    assert reply(spark, '{"category": "ui"} {"category": "x"}').category == "ui"
    assert reply(spark, '{"category": "ui"} {"category": "x"}', greedy=True) is None
    assert reply(spark, '{"a": {"category": "ui"}}') is None
    for bad in ("", "  ", None, "none", "{category: 1}", '{"category": '):
        assert reply(spark, bad) is None


def test_repair_json(spark):
    rows = ['{"category": "ui",}', "{'category': 'ui', 'x': None, 'ok': True}", "{'category': }", "nothing"]
    df = spark.createDataFrame([(r,) for r in rows], "r string")
    out = [r.x for r in df.select(mo.repair_json(C("r"), schemas.CATEGORY_REPLY).alias("x")).collect()]
    assert [o.category if o else None for o in out] == ["ui", "ui", None, None]


def test_validate_analysis(spark):
    row = ("rant", "Authentication", "AI", " ".join("x" * 3), "عنوان", ["کارت", "app"] + list("ابپتثج"), "نیست", "  متن کامل  ")
    df = spark.createDataFrame([row], "type string, category string, ai_title string, short_title string, normalized_title string, keywords array<string>, evidence string, comment_text string")
    out = mo.validate_analysis(df).first()
    assert (out.status, out.type, out.category, out.ai_title, out.evidence) == ("ok", "other", "Authentication", "AI", "متن کامل")
    assert out.keywords == ["کارت", "ا", "ب", "پ", "ت", "ث"]
    long = mo.validate_analysis(df.withColumn("short_title", F.lit("w " * 21))).first()
    assert long.status == "short_title too long"
    none = mo.validate_analysis(df.withColumn("keywords", F.array(F.lit("app")))).first()
    assert none.keywords == ["عمومی"]


def test_strict_rules(spark):
    df = spark.createDataFrame([("issue", "card", "high", None, "متن", "عنوان", "عنوان", ["ا"], "متن کامل")],
                               "type string, category string, severity string, priority string, evidence string, short_title string, normalized_title string, keywords array<string>, comment_text string")
    assert df.select(mo.strict_failures().alias("f")).first().f == []
    bad = df.withColumns({"type": F.lit("criticism"), "severity": F.lit("x"), "short_title": F.lit("w " * 13)})
    assert bad.select(mo.strict_failures().alias("f")).first().f == ["type", "severity", "short_title_latin", "short_title_length"]


def test_evaluation_by_hand(spark):
    rows = [("کارت‌ها", "card", "card"), ("کارت‌ها", "loan", "card"), ("سایر", "loan", "loan"), ("متفرقه", "ui", "loan"), (None, "x", "x")]
    df = evaluation.annotated(spark.createDataFrame(rows, "title string, ai_title string, Annot_title string"))
    assert df.count() == 4
    ai = evaluation.eval_scores(df, "truth", "predicted").first()
    # card: p 1, r 1/2; loan: p 1/2, r 1/2; ui: 0
    assert (ai.accuracy, ai.precision_macro, ai.recall_macro) == (0.5, 0.5, round(1 / 3, 6))
    assert (ai.precision_weighted, ai.recall_weighted) == (0.75, 0.5)
    base = {r.label: r.support for r in evaluation.class_report(df, "truth", "baseline").collect()}
    assert base == {"card": 2, "loan": 2, "other": 0, "unmapped": 0}
    kappa = evaluation.cohen_kappa(df, "truth", "predicted").first().kappa
    po, pe = 0.5, (2 * 1 + 2 * 2) / 16
    assert kappa == round((po - pe) / (1 - pe), 6)
    seen = df.select(F.explode(F.array("truth", "predicted", "baseline")).alias("label")).distinct()
    cells = evaluation.confusion_matrix(df, "truth", "predicted", labels=seen).collect()
    assert len(cells) == 25 and sum(c.n for c in cells) == 4
    assert sum(c.n for c in evaluation.confusion_matrix(df, "truth", "predicted").collect()) == 4


def test_failed_replies_stay_failed(spark):
    rows = [(1, '{"a": 1}', "none"), (2, '{"a": 1}', '{"category": null}'), (3, "none", '{"category": "ui"}')]
    good = '{"type": "issue", "ai_title": "card", "short_title": "s", "normalized_title": "n", "keywords": ["k", null], "evidence": "e"}'
    rows += [(4, good, '{"category": "ui"}'), (5, good.replace(", null", ""), '{"category": "ui"}')]
    df = spark.createDataFrame(rows, "id long, s string, c string").selectExpr("*", "'e' description", "'x' sentiment_result", "timestamp_ntz'2024-01-01' created_at", "'t' title")
    status = {r.comment_id: r.status for r in mo.validate_analysis(mo.merge_replies(df, "s", "c")).collect()}
    assert status == {1: "no ai_title", 2: "no ai_title", 3: "no semantic object", 4: "no keywords", 5: "ok"}


def test_literals_inside_strings_are_kept(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.BooleanType())])
    df = spark.createDataFrame([("{'a': 'it is True now', 'b': True}",)], "raw string")
    r = df.select(mo.repair_json(C("raw"), schema).alias("v")).select("v.*").first()
    assert (r.a, r.b) == ("it is True now", True)


def test_bullets(spark):
    df = spark.createDataFrame([([" a ", "", None, "b", "c"],), ([],), (None,)], "i array<string>")
    assert [r[0] for r in df.select(mo.bullet_list(C("i"), 2)).collect()] == ["- a\n- b", "- (هیچ موردی)", "- (هیچ موردی)"]
