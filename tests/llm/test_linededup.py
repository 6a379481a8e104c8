"""Line templates against brute force."""

import re

from helpers import docs_frame, with_odd_columns

from tideframe.llm import linededup as ld


def templates(line):
    words = [w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", line.lower()) if w]
    digits = [any(c.isdigit() and c.isascii() for c in w) for w in words]
    worded = 2 * sum(digits) <= len(words)
    if worded:
        words = ["<*>" if d else w for w, d in zip(words, digits, strict=True)]
    n, out = len(words), []
    if n >= ld.LEAST_LINE:
        out.append((n, *words))
        if worded and n >= ld.DEPTH + 2 * ld.FIELDS:
            field = [-1 if p < ld.DEPTH else (p - ld.DEPTH) * ld.FIELDS // (n - ld.DEPTH) for p in range(n)]
            starts = [min(p for p in range(n) if field[p] == f) for f in range(ld.FIELDS)]
            field = [f if f >= 0 and p - starts[f] < ld.OPEN_WORDS else -1 for p, f in enumerate(field)]
            out += [(n, f, *[w for w, g in zip(words, field, strict=True) if g != f]) for f in range(ld.FIELDS)]
    return out


def brute(texts):
    docs = {}
    for i, text in texts:
        for line in (text or "").split("\n"):
            for t in templates(line):
                docs.setdefault(t, set()).add(i)
    kept = {}
    for i, text in texts:
        lines = (text or "").split("\n")
        kept[i] = [x for x in lines if not any(len(docs[t]) >= ld.LEAST_DOCS and min(docs[t]) != i for t in templates(x))]
    return {i: "\n".join(lines) for i, lines in kept.items()}


TEXTS = [
    "Copyright 2019 Some Group and its friends\nunique line one of this text here\nshort",
    "unique line two of that text there\nCopyright 2021 Some Group and its friends\nshort",
    "the first three words then alpha beta gamma delta epsilon zeta eta end\nmore to be said about this",
    "the first three words then alpha beta gamma CHANGED ALSO zeta eta end\n\nmore to be said about that",
    "the first three words then other beta gamma CHANGED ALSO zeta too end\nmore to be said about those",
    "1 2 3 4 5 rows of 6 numbers\n7 8 9 10 11 rows of 12 numbers",
    "1 2 3 4 5 rows of 6 numbers\n7 8 9 10 11 rows of 13 numbers",
    "twice the same line here\ntwice the same line here\nand another one to end it",
    None,
    "",
    "\n\n",
    "ß é漢字 word and other words\r\nß é漢字 word and other words",
]


def test_against_brute_force(spark):
    want = brute(list(enumerate(TEXTS)))
    found = ld.drop_recurring(with_odd_columns(docs_frame(spark, TEXTS), "row", "lines", "key", "template"))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "lines", "key", "template", "n_lines", "n_dropped"]
    rows = {r.doc_id: r for r in found.collect()}
    assert {i: r.text or "" for i, r in rows.items()} == want
    assert rows[8].text is None and rows[8].n_lines == 0 and rows[10].n_lines == 3
    assert rows[5].text == TEXTS[5] and rows[6].text == "7 8 9 10 11 rows of 13 numbers"
    assert all(r.n_dropped == (TEXTS[i] or "").count("\n") - (r.text or "").count("\n") + (r.text == "" and bool(TEXTS[i]) and r.n_dropped > 0) for i, r in rows.items())


def test_repeated_and_missing_ids(spark):
    line = "a line that recurs in many documents"
    docs = docs_frame(spark, [(3, line), (3, line), (None, line), (None, line + "\nand a line of its own here"), (9, line)])
    found = sorted(((r.doc_id, r.text) for r in ld.drop_recurring(docs).collect()), key=str)
    assert found == sorted([(3, line), (3, line), (None, ""), (None, "and a line of its own here"), (9, "")], key=str)
    only = docs_frame(spark, [(None, line), (None, line)])
    assert [r.text for r in ld.drop_recurring(only).collect()] == [line, line]


def test_empty_table(spark):
    assert ld.drop_recurring(docs_frame(spark, ["x"]).limit(0)).count() == 0


def test_long_text_in_blocks(monkeypatch):
    text = "\n".join(f"line of words number {'abcdefghij'[i % 10]} and more {'klmno'[i % 5]}" for i in range(400))
    whole = ld.line_templates([text, "x"])
    monkeypatch.setattr(ld, "SLICE_CHARS", 500)
    monkeypatch.setattr(ld, "sliced", lambda texts: iter([(0, 1), (1, 2)]))
    parts = ld.line_templates([text, "x"])
    for a, b in zip(whole, parts, strict=True):
        assert (a == b).all()


def test_short_lines_that_recur_often(spark):
    texts = [f"All rights reserved\nTwice only\na line of its own {w} here" for w in ("alpha", "beta")] + ["All rights reserved\nmore", "all rights reserved"]
    found = {r.doc_id: r.text for r in ld.drop_recurring(docs_frame(spark, texts)).collect()}
    assert found == {0: texts[0], 1: "Twice only\na line of its own beta here", 2: "more", 3: ""}


def _long_line(changed, words=150):
    return " ".join("changed" + chr(97 + p % 26) * 3 if p in changed else f"word{chr(97 + p % 26)}{chr(97 + p // 26)}" for p in range(words))


def test_a_long_passage_is_no_variable_field(spark):
    from_start = 3 + 49  # the second part of the rest begins here
    texts = [_long_line(()), _long_line(range(from_start, from_start + 8)), _long_line(range(from_start, from_start + 9)), _long_line(range(101, 150))]
    assert brute(list(enumerate(texts))) == {0: texts[0], 1: "", 2: texts[2], 3: texts[3]}
    found = {r.doc_id: r.text for r in ld.drop_recurring(docs_frame(spark, texts)).collect()}
    assert found == {0: texts[0], 1: "", 2: texts[2], 3: texts[3]}


def test_lines_are_cut_once(spark):
    lost = ld.recurring_lines(docs_frame(spark, TEXTS))
    assert "MapInArrow" not in lost._jdf.queryExecution().toString()
    assert {r.doc_id: len(r.lines) for r in lost.collect()} == {1: 1, 3: 1, 6: 1}
