"""Files with several notices, and notices of common words."""

from __future__ import annotations

from hebdo.llm import licenses


def notices(*labels):
    return " and then ".join(text for label, text, _ in licenses.TEMPLATES if label in labels)


def test_every_notice_of_a_file_is_found(spark):
    by_nc = "licensed under cc by nc 4 0"
    others = "subject to mozilla redistribution binary forms modification permitted permission granted charge person software"
    rows = [(1, notices("bsd") + " . " + licenses.TEMPLATES[1][1]), (2, notices(*{t[0] for t in licenses.TEMPLATES})),
            (3, f"{others} {by_nc}"), (4, "source and binary forms"), (5, notices("bsd"))]
    rows += [(i, by_nc) for i in range(10, 30)]  # the words of a shared notice are common ones
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "bsd,mit"
    assert got[2] == ",".join(sorted({t[0] for t in licenses.TEMPLATES}))
    assert got[3] == got[10] == "cc-by-nc" and got[4] == "" and got[5] == "bsd"
