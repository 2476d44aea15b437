from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelprep.operators import notes as nt

COLUMNS = ("note_id long, noted_at timestamp_ntz, task string, topic string, summary string, evidence array<string>, impact string, "
           "api_name string, doc_id string, page_url string, params map<string,string>, status string")
AT = dt.datetime(2026, 4, 20, 10, 25, 53)


def note(n, topic="a-share-risk-model", task="t1", evidence=("e",), impact="i", api="daily", status="durable", at=AT, summary="s"):
    return (n, at, task, topic, summary, list(evidence), impact, api, None, None, {}, status)


def test_names_do_not_collide(spark):
    data = [note(7), note(3), note(9), note(4, "Wind & ETF"), note(5, "", at=AT + dt.timedelta(seconds=1))]
    got = {r["note_id"]: r["note_name"] for r in nt.note_names(spark.createDataFrame(data, COLUMNS)).collect()}
    assert got == {
        3: "20260420-102553-a-share-risk-model", 7: "20260420-102553-a-share-risk-model-2",
        9: "20260420-102553-a-share-risk-model-3", 4: "20260420-102553-wind-etf", 5: "20260420-102554-runtime-note"}


def test_text(spark):
    full = (1, AT, "ETF coverage check", "etf", "returned Shanghai rows", ["sample", "more"], "hint only", "mf_floatshare", "12345",
            "https://x", {"trade_date": "20260319"}, "tentative")
    empty = (2, AT, "t", "w", "s", ["e"], "i", None, None, None, {}, None)
    texts = [r["note_text"] for r in nt.note_text(spark.createDataFrame([full, empty], COLUMNS)).orderBy("note_id").collect()]
    assert texts[0].split("\n") == [
        "# Runtime Note: ETF coverage check", "", "- Date: `2026-04-20 10:25:53`", "- Topic: `etf`", "- Status: `tentative`",
        "- API Name: `mf_floatshare`", "", "## Source", "- `doc_id`: `12345`", "- page: `https://x`", "", "## Key Params",
        "- `trade_date` = `20260319`", "", "## Observed Behavior", "returned Shanghai rows", "", "## Evidence", "- sample", "- more", "",
        "## Decision Impact", "hint only", ""]
    assert "- API Name: `unknown`" in texts[1] and texts[1].count("- none recorded") == 2


def test_promotion(spark, rows):
    data = [note(1), note(2, task="t2"), note(3, evidence=()), note(4, impact=" "), note(5, status="tentative"), note(6, api="once"),
            note(7, api=None), note(8, api=None, task="t9"), note(9, evidence=(" ",))]
    out = nt.promotable(spark.createDataFrame(data, COLUMNS))
    assert rows(out, "note_id", "promote", "reject_reason") == [
        (1, True, None), (2, True, None), (3, False, "no evidence"), (4, False, "changes no decision"), (5, False, "not durable"),
        (6, False, "seen in too few tasks"), (7, True, None), (8, True, None), (9, False, "no evidence")]


def test_recurring_gaps(spark, rows):
    data = [note(1, summary="no range"), note(2, summary="no range", task="t2"), note(3, summary="no range"), note(4, summary="other")]
    out = nt.recurring_gaps(spark.createDataFrame(data, COLUMNS))
    assert rows(out, "summary", "tasks_seen", "n_notes") == [("no range", 2, 3)]
    assert out.where(F.col("topic").isNull()).count() == 0
