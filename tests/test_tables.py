"""Upserts, files, the stream, jobs and the scoring hook."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.operators import merges, scoring, selection, summaries
from voxmill.sources import files
from voxmill.streaming import intake

def now():
    return F.lit("2025-02-01").cast("timestamp")

T0 = dt.datetime(2025, 1, 1)
BATCH = "seq long, title string, grade int, description string, national_code_hash string, mobile_no_hash string, created_at timestamp_ntz, channel_code string"


def batch(spark):
    return spark.createDataFrame([
        (5, "b", 2, "second", "u1", None, T0, "web"),
        (4, "a", 1, "first", "u1", "m", T0, None),
        (6, "c", 3, "third", "u1", "m3", T0, "app"),
        (7, "d", 4, "other", "u2", None, T0, None),
    ], BATCH)


def test_upsert_twice_is_upsert_once(spark):
    empty = spark.createDataFrame([], schemas.COMMENTS)
    once = merges.upsert_comments(empty, batch(spark), imported_at=now())
    rows = {r.national_code_hash: r for r in once.collect()}
    assert (rows["u1"].id, rows["u1"].title, rows["u1"].channel_code, rows["u1"].mobile_no_hash) == (1, "c", "web", "m3")
    assert rows["u2"].id == 2 and rows["u2"].channel_code is None
    twice = merges.upsert_comments(once, batch(spark), imported_at=now())
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_existing_channel_and_labels_stay(spark):
    old = merges.upsert_comments(spark.createDataFrame([], schemas.COMMENTS), batch(spark), imported_at=now())
    old = old.withColumn("sentiment_result", F.lit("mixed"))
    new = spark.createDataFrame([(1, "z", 5, "new", "u1", None, T0, "other"), (2, "z", 5, "new", "u2", None, T0, "late")], BATCH)
    rows = {r.national_code_hash: r for r in merges.upsert_comments(old, new, imported_at=now()).collect()}
    assert rows["u1"].channel_code == "web" and rows["u1"].mobile_no_hash is None and rows["u1"].sentiment_result == "mixed"
    assert rows["u2"].channel_code == "late"


CSV = (
    "﻿TITLE,GRADE,DESCRIPTION,NATIONAL_CODE,FIRST,LAST,MOBILE_NO,CREATED_AT,Channel\r\n"
    't1,5,"two\nlines, ""quoted""",123,a,b,0912,11/29/25 12:05 AM,web\r\n'
    "t2,x,,1234567890123,a,b, ,2025-12-24-00.02.26.367590,\r\n"
    "short,1,d,1,a,b,2,11/29/25 12:05 AM\r\n"
    'long,۴,"a,b",1,a,b,2,11/29/2025 13:05, app ,extra,more\r\n'
    "bad time,1,d,1,a,b,2,yesterday,web\r\n"
)


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_feedback_file(spark, tmp_path):
    raw = files.read_feedback_csv(spark, write(tmp_path / "f.csv", CSV))
    assert [r.title for r in raw.orderBy("seq").collect()] == ["t1", "t2", "long", "bad time"]
    rows = {r.title: r for r in files.clean_feedback(raw).collect()}
    assert set(rows) == {"t1", "t2", "long"}
    assert rows["t1"].description == 'two\nlines, "quoted"' and rows["t1"].created_at == dt.datetime(2025, 11, 29, 0, 5)
    assert (rows["t2"].grade, rows["t2"].description, rows["t2"].mobile_no_hash, rows["t2"].channel_code) == (0, "", None, None)
    assert (rows["long"].grade, rows["long"].channel_code, rows["long"].description) == (4, "app", "a,b")


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    head, first, rest = CSV.split("\r\n")[0], "\r\n".join(CSV.split("\r\n")[1:3]), "\r\n".join(CSV.split("\r\n")[3:])
    write(source / "1.csv", head + "\r\n" + first + "\r\n")
    table = str(tmp_path / "table")
    intake.start_table(spark, table)
    run = lambda: intake.import_stream(spark, str(source), table, str(tmp_path / "state"), files_per_batch=1, imported_at=now()).awaitTermination()
    run()
    write(source / "2.csv", head + "\r\n" + rest)
    run()
    streamed = intake.read_table(spark, table).drop("month")
    batch_rows = files.clean_feedback(files.read_feedback_csv(spark, str(tmp_path / "in")))
    merged = merges.upsert_comments(spark.createDataFrame([], schemas.COMMENTS), batch_rows, imported_at=now())
    drop = lambda df: sorted(map(tuple, df.drop("id").collect()), key=repr)
    assert drop(streamed) == drop(merged) and streamed.count() == 3


def test_assistant_layouts(spark, tmp_path):
    one = write(tmp_path / "1.csv", "h\n0,hi,yo,LIKE,x,q1,q3,q2,2025-01-01 10:00:00\n0,hi,yo,meh,x,,,, 2025-01-01 10:00:00 \n0,hi,yo,LIKE,x,q1,q3,q2\n")
    rows = files.read_assistant_csv(spark, one, 1).orderBy("seq").collect()
    assert [(r.user_message, r.is_liked, r.q1, r.q2, r.q3) for r in rows] == [("hi", True, "q1", "q2", "q3"), ("hi", None, "", "", "")]
    zero = write(tmp_path / "0.csv", "h\n0,1,hi,yo,TRUE,x,q1,q3,q2,2025-01-01 10:00:00\n0,1,hi,yo,,x,q1,q3,q2,\n")
    rows = files.read_assistant_csv(spark, zero, 0).orderBy("seq").collect()
    assert [(r.is_liked, r.created_at) for r in rows] == [(True, dt.datetime(2025, 1, 1, 10)), (False, None)]


def test_word_list_file(spark, tmp_path):
    path = write(tmp_path / "w.txt", "{'نمیشود',\n 'آن‌ها',\n\n'و',\n'و',\n")
    assert sorted(r.word for r in files.load_stopwords(spark, path).collect()) == sorted(["{نمیشود", "آنها", "و"])
    assert set(files.stopword_list(files.load_stopwords(spark, path, plain=True))) == {"{'نمیشود',", "'آن‌ها',", "'و',"}


def test_jsonl_appends_and_keeps_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("1", "متن", None)], "comment_id string, evidence string, severity string")
    path = str(tmp_path / "out")
    files.append_jsonl(rows, path)
    files.append_jsonl(rows, path)
    assert spark.read.text(path).distinct().first()[0] == '{"comment_id":"1","evidence":"متن","severity":null}'
    assert files.read_jsonl(spark, path, schemas.COMMENT_RECORD).count() == 2


def test_scrapes_and_registration(spark):
    raw = spark.createDataFrame([
        (1, "u", "t", "10", "width: 80%;", "2025/12/13"), (1, "u", "t", None, "width: 80%;", "2025/12/13"), (1, "u", "t", "11", "x", "soon"),
    ], "app_id long, user_name string, comment_text string, raw_id string, style string, date string")
    rows = {r.comment_idd: r for r in merges.normalize_scraped(raw, F.lit("2025-03-20").cast("date")).collect()}
    assert (rows[10].comment_rating, rows[10].comment_date_jalali) == (4.0, 14040922)
    assert (rows[11].comment_rating, rows[11].comment_date_jalali) == (0.0, 14031230)


def test_title_is_required_and_sentiment_checked(spark):
    table = spark.createDataFrame([], schemas.COMMENTS)
    with pytest.raises(ValueError):
        selection.select_for_ngrams(table, title=None)
    with pytest.raises(ValueError):
        selection.select_for_ngrams(table, title="all", sentiment="angry")


def test_score_eleven_passes_only_without_sentiment(spark):
    rows = [(1, "t", "text", False, 11), (2, "t", "text", None, 4), (3, "t", "text", False, 4), (4, "t", "x", False, 4)]
    table = spark.createDataFrame(rows, "id long, title string, description string, is_repetitive boolean, sentiment_score int").withColumns(
        {"grade": F.lit(1), "sentiment_result": F.lit(None).cast("string"), "created_at": F.lit(T0)})
    ids = lambda **o: sorted(r.id for r in selection.select_for_ngrams(table, title="all", **o).collect())
    assert ids() == [1, 3] and ids(sentiment="all") == [3] and ids(min_len=1, sentiment="positive") == [3, 4]


def test_job_fails_on_one_thin_group(spark):
    filt = (["a", "b"], ["issue"], ["ui"], ["negative"], "2025-01-01", "2025-12-31")
    jobs = spark.createDataFrame([(1, (["a"],) + filt[1:]), (2, filt), (3, ([],) + filt[1:])], "summarized_id long, filter struct<titles:array<string>,types:array<string>,categories:array<string>,sentiments:array<string>,start_date:string,end_date:string>")
    rows = [(i, T0 + dt.timedelta(days=40), "a" if i < 200 else "b", "issue", "ui", "negative", f"n{i}" if i % 10 else "") for i in range(204)]
    analysis = spark.createDataFrame(rows, "comment_id long, created_at timestamp_ntz, title string, type string, category string, sentiment_result string, normalized_title string")
    groups = summaries.expand_jobs(jobs)
    found = summaries.group_comments(groups, analysis)
    status = {r.summarized_id: (r.status, r.comment_count, r.reason) for r in summaries.job_status(jobs, summaries.group_sizes(groups, found)).collect()}
    assert status == {1: ("completed", 200, None), 2: ("failed", 0, summaries.TOO_FEW), 3: ("failed", 0, summaries.MISSING_FILTER)}
    chunks = sorted((r.chunk, r.texts.count("\n") + 1) for r in summaries.chunk_texts(found).filter("summarized_id = 1").collect())
    assert chunks == [(0, 80), (1, 80), (2, 20)]


def test_merging_in_rounds(spark):
    rows = spark.createDataFrame([(1, 0, i, f"s{i}") for i in range(5)], "summarized_id long, group_no long, chunk long, summary string")
    whole = summaries.merge_chunks(rows).collect()
    assert [(r.part, r.text) for r in whole] == [(0, "s0\ns1\ns2\ns3\ns4")]
    parts = sorted((r.part, r.text) for r in summaries.merge_chunks(rows, fan_in=2).collect())
    assert parts == [(0, "s0\ns1"), (1, "s2\ns3"), (2, "s4")]


def test_one_answer_for_each_group(spark):
    rows = [(1, 0, 0, "a"), (1, 1, 0, "z"), (1, 1, 1, "x"), (1, 1, 2, "y"), (2, 0, 0, "")] + [(3, 0, i, f"s{i}") for i in range(9)]
    chunks = spark.createDataFrame(rows, "summarized_id long, group_no long, chunk long, summary string")
    model = lambda d: d.withColumn("summary", F.concat(F.lit("S("), F.regexp_replace("text", "\n", "+"), F.lit(")")))
    answers = lambda d, **o: {(r.summarized_id, r.group_no): r.summary for r in summaries.merge_until_one(d, model, **o).collect()}
    nine = "+".join(f"s{i}" for i in range(9))
    assert answers(chunks) == {(1, 0): "a", (1, 1): "S(z+x+y)", (2, 0): "", (3, 0): f"S({nine})"}
    in_twos = answers(chunks, fan_in=2)
    assert in_twos[1, 0] == "a" and in_twos[1, 1] == "S(S(z+x)+S(y))" and in_twos[3, 0].count("S(") == 5 + 3 + 2 + 1
    for group in ([(1, 0)], [(1, 1)], [(1, 0), (2, 0)]):  # whatever else is in the batch
        some = chunks.filter(" or ".join(f"(summarized_id = {i} and group_no = {g})" for i, g in group))
        assert answers(some, fan_in=2) == {k: in_twos[k] for k in group}
    assert answers(chunks.limit(0)) == {}
    whole = summaries.merge_groups(summaries.merge_until_one(chunks, model)).filter("summarized_id = 1").first()
    assert whole.summarized_comment == "a\n\nS(z+x+y)"


def _groups(spark, *dates):
    rows = [(i, 0, "a", "issue", "ui", "negative", start, end) for i, (start, end) in enumerate(dates)]
    return spark.createDataFrame(rows, "summarized_id long, group_no long, title string, type string, category string, sentiment string, start_date string, end_date string")


def _analysed(spark):
    times = [dt.datetime(2023, 12, 31, 23, 59, 59), dt.datetime(2024, 9, 1), dt.datetime(2024, 9, 30, 12), dt.datetime(2024, 10, 1), dt.datetime(2024, 10, 1, 0, 0, 1), dt.datetime(2131, 1, 1), None]
    return spark.createDataFrame([(i, t, "a", "issue", "ui", ("negative", "very negative")[i % 2], f"n{i}") for i, t in enumerate(times)], "comment_id long, created_at timestamp_ntz, title string, type string, category string, sentiment_result string, normalized_title string")


def test_dates_of_jobs_are_compared_as_times(spark):
    dates = [("2024-9-1", "2024-10-01"), ("2024-09-01", "2024-10-1 00:00:01"), ("2024-10-01", "2024-9-1"), ("-infinity", "2024-1-1"), ("2024-09-02", "infinity"), ("-infinity", "infinity"), (" ", "2024-12-31"), (None, "2024-12-31"), ("soon", "later"), ("2024-09-30 12:00", "2024-09-30 12:00")]
    found = summaries.group_comments(_groups(spark, *dates), _analysed(spark)).collect()
    got = {i: sorted(r.comment_id for r in found if r.summarized_id == i) for i in range(len(dates))}
    assert got == {0: [1, 2, 3], 1: [1, 2, 3, 4], 2: [], 3: [0], 4: [2, 3, 4, 5], 5: [0, 1, 2, 3, 4, 5], 6: [], 7: [], 8: [], 9: [2]}


def test_only_the_months_asked_for_are_read(spark, tmp_path):
    rows = _analysed(spark).filter("created_at is not null").withColumn("month", F.expr("year(created_at) * 100 + month(created_at)"))
    rows.write.partitionBy("month").parquet(str(tmp_path / "t"))
    groups = _groups(spark, ("2024-9-1", "2024-9-30"))
    found = summaries.group_comments(groups, spark.read.parquet(str(tmp_path / "t")), month="month")
    assert [r.comment_id for r in found.collect()] == [1]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_category_prompts_hold_the_comment(spark):
    analysis = spark.createDataFrame([(1, "issue", "card"), (2, None, None), (3, "issue", "card")], "comment_id long, type string, ai_title string")
    comments = spark.createDataFrame([(1, " کارت  من\n"), (2, None)], "id long, description string")
    got = {r.comment_id: r.prompt for r in summaries.category_prompt_rows(analysis, comments, "{comment_text}|{type}|{ai_title}").collect()}
    assert got == {1: "کارت من|issue|card", 2: "||", 3: "|issue|card"}


def test_copies_in_a_batch_stay_one_row(spark):
    jobs = spark.createDataFrame([(1, "new")], "summarized_id long, status string").selectExpr(
        "summarized_id", "cast(null as string) summarized_comment", "0 comment_count", "status", "cast(null as decimal(10,2)) duration_seconds", "cast(null as string) model")
    done = jobs.withColumn("status", F.lit("completed"))
    assert [r.status for r in merges.finish_jobs(jobs, done.unionByName(done)).collect()] == ["completed"]


def test_files_follow_by_name_whatever_their_size(spark, tmp_path):
    line = "t{0},5,text,1,a,b,2,2025-12-24-00.02.26.367590,{1}\n"
    (tmp_path / "a.csv").write_text("h" + ",h" * 8 + "\n" + line.format("small", "first"))
    (tmp_path / "b.csv").write_text("h" + ",h" * 8 + "\n" + line.format("large", "second") * 500)
    rows = files.read_feedback_csv(spark, str(tmp_path)).select("seq", "title").orderBy("seq").collect()
    assert rows[0].title == "tsmall" and [r.seq for r in rows] == list(range(501))


def _one_task(spark, path):
    """The rows of a folder as Spark's own reader gives them, a file as one task."""
    rows = files.with_places(spark.read.schema(files.positional_schema(9)).options(**files.csv_options(True)).csv(path))
    return [tuple(r) for r in files.feedback_columns(rows).orderBy("seq").collect()]


def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    import random

    rng = random.Random(4)
    words = ["plain", 'a ""quoted"" word', "two\nlines", "x, y", "", "three\r\n\nlines", "متن", 'ends ""', "stray"]
    for name, end, n in (("a.csv", "\n", 900), ("b.csv", "\r\n", 300), ("c.csv", "\n", 1)):
        lines = ["h1,h2,h3,h4,h5,h6,h7,h8,h9"]
        for i in range(n):
            text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))
            lines.append(f't{i},{i % 6},"{text}",id{i},"a",5"pipe,m,2025-12-24-00.02.26.367590,ch')
            if i % 50 == 7:
                lines.append("too,short")
            if i % 70 == 9:
                lines.append("")
            if i % 90 == 3:
                lines.append("long" + ",x" * 11 + ',"one\ntwo"')
        (tmp_path / name).write_text(end.join(lines) + end * (n > 1), newline="")
    want = _one_task(spark, str(tmp_path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200", "3000", old):  # splits shorter than a record, too
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            frame = files.read_feedback_csv(spark, str(tmp_path))
            got = [tuple(r) for r in frame.orderBy("seq").collect()]
            assert got == want and len(got) > 1200
            if size == "3000":
                assert len(spark.read.text(str(tmp_path)).withColumn("p", F.spark_partition_id()).select("p").distinct().collect()) > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quote_states():
    from voxmill.sources.records import inside_after

    for line, outside, inside in (("a,b", False, True), ('a,"b', True, False), ('"a', True, False), ('a"b,c', False, False), ('"a ""b"" c",d', False, False), ('x"",y', False, True), ('"",""', False, True), ('a",b,"c', True, True), ("", False, True)):
        assert (inside_after(line, False), inside_after(line, True)) == (outside, inside), line


def test_missing_word_list_is_empty(spark, tmp_path):
    assert files.load_stopwords(spark, str(tmp_path / "none.txt")).collect() == []


def test_report_versions_stay(spark, tmp_path):
    report = spark.createDataFrame([("all", "a b", 1.0)], "grp string, ngram string, tfidf double")
    for version in ("0.2", "0.3", "0.2"):
        files.write_ngram_csv(report, str(tmp_path), version)
    assert sorted(p.name for p in tmp_path.iterdir() if p.is_dir()) == ["version=0.2", "version=0.3"]


def test_temporary_tables_go(spark):
    import os

    from voxmill.session import cut_lineage, shared_folder, temporary_tables

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with temporary_tables(spark):
        assert cut_lineage(spark.range(3)).count() == 3
        assert set(os.listdir(folder)) != before
    assert set(os.listdir(folder)) == before


def test_scoring_empty_replies_and_row_counts(spark, tmp_path):
    place = str(tmp_path)

    def model(frame):
        import os

        answers = []
        for i in frame["id"]:
            seen = os.path.exists(f"{place}/{i}")
            open(f"{place}/{i}", "w").close()
            answers.append("late" if seen or i % 2 else "")
        frame["reply"] = answers
        return frame

    scored = scoring.score_with(spark.range(6).coalesce(1), model, "reply string", is_empty=lambda f: f["reply"] == "")
    assert {r.reply for r in scored.collect()} == {"late"}
    with pytest.raises(Exception, match="were scored as"):
        scoring.score_with(spark.range(6), lambda f: f.assign(reply="x").head(0), "reply string").collect()


def test_scoring_retries(spark, tmp_path):
    flag = str(tmp_path / "failed-once")

    def model(frame):
        import os
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("busy")
        assert len(frame) <= 3
        return pd.DataFrame({"double": frame["id"] * 2})

    rows = scoring.score_with(spark.range(10).coalesce(1), model, "double long", batch_size=3).collect()
    assert sorted(tuple(r) for r in rows) == [(i, 2 * i) for i in range(10)]


def test_candidates_for_one_app(spark):
    attributes = [c for c in merges.REGISTERED_ATTRIBUTES if c not in ("app_name", "nickname", "category")]
    fill = {c: F.lit("x") for c in attributes}
    apps = spark.createDataFrame([(7, "n", "dead", "c", True, True), (9, "n", "live", "c", True, False)],
                                 "app_id long, app_name string, nickname string, category string, active boolean, deleted boolean").withColumns(fill)
    good, bad = merges.lx.ACCEPTED_APP_CATEGORIES[0], "other"
    rows = [(1, "n", "dead", bad), (2, "n", "dead", bad), (3, "n", "live", good), (4, "n", "new", bad), (5, "n", "new", good), (6, "n", "new", good), (8, "n", "new", bad)]
    candidates = spark.createDataFrame(rows, "seq long, app_name string, nickname string, category string").withColumns(fill)
    status = {r.seq: r.status for r in merges.registration_status(apps, candidates).collect()}
    assert status == {1: "deleted-back", 2: "Duplicate", 3: "Duplicate", 4: "Irrelevant", 5: "Valid", 6: "Duplicate", 8: "Duplicate"}
    after = {r.nickname: (r.app_id, r.deleted) for r in merges.register_app(apps, candidates).collect()}
    assert after == {"dead": (7, False), "live": (9, False), "new": (10, False)}


def test_last_analysis_of_a_comment_counts(spark):
    target = spark.createDataFrame([], schemas.COMMENT_ANALYSIS)
    rows = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 6, "c")], "seq long, comment_id long, type string")
    rows = rows.withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in target.columns if c not in ("comment_id", "type")})
    out = {r.comment_id: r.type for r in merges.upsert_analysis(target, rows, seq="seq").collect()}
    assert out == {5: "b", 6: "c"}


def test_rows_that_stay_without_an_answer_have_failed(spark):
    model = lambda frame: frame.assign(reply=["" if i == 2 else "text" for i in frame["id"]])
    rows = scoring.score_with(spark.range(4), model, "reply string", is_empty=lambda f: f["reply"] == "", failed="failed").collect()
    assert {r.id: r.failed for r in rows} == {0: False, 1: False, 2: True, 3: False}
    assert not any(r.failed for r in scoring.score_with(spark.range(4), model, "reply string", failed="failed").collect())


def test_a_batch_rewrites_its_months_only(spark, tmp_path):
    from pathlib import Path

    from voxmill.streaming import month_table

    schema = schemas.COMMENTS
    def rows(*given):
        blank = {f.name: None for f in schema.fields}
        return spark.createDataFrame([tuple((blank | g)[f.name] for f in schema.fields) for g in given], schema)

    def batch(*given):
        return spark.createDataFrame([(i, "t", 1, text, user, None, time, None) for i, (user, time, text) in enumerate(given)],
            "seq long, title string, grade int, description string, national_code_hash string, mobile_no_hash string, created_at timestamp_ntz, channel_code string")

    def files_of(month):
        return sorted(str(p) for p in Path(table).rglob("*.parquet") if f"month={month}" in str(p))

    table, now = str(tmp_path / "t"), F.lit("2025-01-01").cast("timestamp_ntz")
    day = lambda m, d=1: dt.datetime(2024, m, d)
    month_table.start_months(spark, table, schema, rows(
        {"id": 7, "national_code_hash": "a", "created_at": day(1), "description": "old"}, {"id": 9, "national_code_hash": "b", "created_at": day(2), "description": "b"}))
    change = lambda old, new, top: merges.upsert_comments(old, new, imported_at=now, top_id=top)
    run = lambda n, *given: month_table.write_batch(spark, table, schema, n, batch(*given), change)
    content = lambda n=None: sorted((r.id, r.national_code_hash, r.month, r.description) for r in month_table.read_months(spark, table, schema, n).collect())
    untouched = files_of(202402)
    run(0, ("a", day(1), "new"), ("c", day(1, 5), "c"), ("d", day(3), "d"))
    after = [(7, "a", 202401, "new"), (9, "b", 202402, "b"), (10, "c", 202401, "c"), (11, "d", 202403, "d")]
    assert content() == after and files_of(202402) == untouched
    run(0, ("a", day(1), "new"), ("c", day(1, 5), "c"), ("d", day(3), "d"))  # a batch that runs again
    assert content() == after and month_table.snapshots(spark, table) == [0, 1]
    run(1, ("e", day(2, 9), "e"))
    assert content() == sorted([*after, (12, "e", 202402, "e")]) and content(1) == after
    assert content(0) == [(7, "a", 202401, "old"), (9, "b", 202402, "b")]
    run(2)  # no rows
    assert content() == content(2) and month_table.snapshots(spark, table) == [0, 1, 2, 3]
    assert month_table.retire(spark, table, keep=2)
    assert month_table.snapshots(spark, table) == [2, 3] and content() == sorted([*after, (12, "e", 202402, "e")])
    assert not any(p in files_of(202402) for p in untouched) and len({p.rsplit("/", 2)[0] for p in files_of(202401)}) == 1
    # A batch that died before its manifest is not seen, and is overwritten.
    month_table._remove(spark, f"{table}/manifest/3")
    assert content() == content(2)
    run(2, ("f", day(1, 7), "f"))
    assert content()[-1] == (13, "f", 202401, "f") and month_table.retire(spark, table, keep=1) and len(content()) == 6


def test_many_batches_write_in_proportion_to_their_rows(spark, tmp_path):
    """Every snapshot equals the merges one after the other, ids too; but one month is not written again for each batch."""
    from pathlib import Path

    source, table = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    line = lambda f, user: f't{f},{f},"d{f}, ""x""\n{user}",{user},a,b,0912,11/{user % 20 + 1:02d}/25 12:05 AM,{"" if f % 2 else f"c{f}"}\n'
    expected, steps = spark.createDataFrame([], schemas.COMMENTS), []
    for f in range(8):
        path = write(source / f"{f}.csv", "h\n" + "".join(line(f, user) for user in range(f * 5, f * 5 + 10)))
        merged = merges.upsert_comments(expected, files.clean_feedback(files.read_feedback_csv(spark, path)), imported_at=now())
        steps.append(sorted(map(tuple, merged.collect())))
        expected = spark.createDataFrame(steps[-1], schemas.COMMENTS)
        Path(path).touch()
    intake.start_table(spark, table)
    intake.import_stream(spark, str(source), table, str(tmp_path / "state"), files_per_batch=1, imported_at=now(), keep=0).awaitTermination()
    for number, rows in enumerate(steps):
        assert sorted(map(tuple, intake.read_table(spark, table, number + 1).drop("month").collect())) == rows
    assert spark.read.parquet(f"{table}/data").count() <= 2 * 80  # 10 + 15 + ... + 45 = 220 when each batch rewrites the month


def test_stream_splits_a_file_over_tasks(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = "".join(f't{i},1,"a, ""b""{chr(10) * (i % 7)} {i}",{i},a,b,0912,11/29/25 12:05 AM,web\r\n' for i in range(400))
    write(source / "1.csv", "TITLE,GRADE\r\n" + rows)
    write(source / "2.csv", "TITLE,GRADE\r\n" + rows.replace("t1", "u1") + 'open,1,"never closed,1,a,b,1,11/29/25 12:05 AM,web')
    keys, sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), ("3000", "1")
    before, seen = [spark.conf.get(k) for k in keys], []
    intake_of = lambda clean, number: seen.append((clean.rdd.getNumPartitions(), [tuple(r) for r in clean.orderBy("seq").drop("seq").collect()]))
    try:
        for k, v in zip(keys, sizes, strict=True):
            spark.conf.set(k, v)
        intake.import_stream(spark, str(source), str(tmp_path / "t"), str(tmp_path / "s"), merge=intake_of).awaitTermination()
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    whole = files.clean_feedback(files.feedback_columns(files.with_places(
        spark.read.schema(files.positional_schema(files.FEEDBACK_FIELDS)).options(**files.csv_options()).csv(str(source))), by_time=True))
    (tasks, streamed), = seen
    assert tasks > 10 and len(streamed) == 800 and streamed == [tuple(r) for r in whole.orderBy("seq").drop("seq").collect()]


def test_a_batch_that_is_added_again_changes_nothing(spark, tmp_path):
    from voxmill.streaming import month_table

    table, top = str(tmp_path / "t"), "imported_at timestamp"
    old = merges.upsert_comments(spark.createDataFrame([], schemas.COMMENTS), batch(spark), imported_at=now())
    month_table.start_months(spark, table, schemas.COMMENTS, old)

    def add(number, *users):
        rows = [(i, "t", 1, f"{number}", u, None, T0, None, dt.datetime(2025, 3, 1)) for i, u in enumerate(users)]
        new = spark.createDataFrame(rows, f"{BATCH}, {top}")
        month_table.append_batch(spark, table, schemas.COMMENTS, number, new, intake._merge, intake.LANDED)

    content = lambda n=None: sorted((r.id, r.national_code_hash, r.description) for r in intake.read_table(spark, table, n).collect())
    add(0, "u9")
    after = [(1, "u1", "third"), (2, "u2", "other"), (3, "u9", "0")]
    assert content() == after and content(0) == after[:2]
    with pytest.raises(ValueError):
        month_table.write_batch(spark, table, schemas.COMMENTS, 1, old, intake._merge)
    add(1, "u8", "u1")  # three are pending now, and merged with the two
    add(1, "u8", "u1")
    after = [(1, "u1", "1"), (2, "u2", "other"), (3, "u9", "0"), (4, "u8", "1")]
    assert content() == sorted(after) and content(1)[0] == (1, "u1", "third")
    add(2)
    add(3, "u7")
    assert content() == content(3) + [(5, "u7", "3")] == sorted(after) + [(5, "u7", "3")]
    month_table.retire(spark, table, keep=1)
    assert content() == sorted(after) + [(5, "u7", "3")] and month_table._names(spark, f"{table}/pending") == ["batch=4"]
