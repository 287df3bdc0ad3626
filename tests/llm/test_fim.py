"""Fill-in-the-middle against plain slicing."""

import hashlib

import duckdb
import pytest
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import fim, queries

TEXTS = ["a", "héé́ 🙂 énd", "two words", "<P> marked", "x<S>", "y <M", "<", "<P", "a<S<", "line\nbreak\r\n\x00nul", "z" * 4_000]
ROWS = ODD + [(100 + 40 * k + j, t, "s") for k, t in enumerate(TEXTS) for j in range(40)]


def expected(doc_id, text, percent=90, percent_spm=20):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, len(text), "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < percent_spm:
        return doc_id, len(text), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(text), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("shares", [(90, 20), (100, 0), (100, 100), (0, 50)])
def test_against_slicing_and_back(documents, shares):
    made = fim.transform(documents(ROWS), percent=shares[0], percent_spm=shares[1])
    got = [tuple(r) for r in made.collect()]
    assert sorted(got, key=str) == sorted((expected(d, t, *shares) for d, t, *_ in ROWS), key=str)
    back = made.select("output", fim.restored(made.output, made.form).alias("text")).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t, *_ in ROWS)


def test_other_units(documents):
    rows = [(k, "one  two three\nfour ", "s") for k in range(60)] + [(90, " begins with a space", "s")]
    made = fim.transform(documents(rows), unit=r"\S+\s*").collect()
    ends = {0, 5, 9, 15, 20}
    for r in made:
        assert r.n == (0 if r.doc_id == 90 else 4)
        assert r.form == "plain" or {r.prefix_chars, r.prefix_chars + r.middle_chars} <= ends
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_clusters_are_units(documents):
    got = fim.transform(documents([(k, "é🙂🏽x", "s") for k in range(40)]), unit=r"\X").collect()
    assert {r.n for r in got} == {3} and all(r.prefix_chars in (None, 0, 2, 4, 5) for r in got)


def test_empty_table(documents):
    assert fim.transform(documents([])).collect() == []


def test_query_and_its_sql(spark, documents, tmp_path):
    documents(ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted([tuple(r) for r in queries.op13_fill_in_middle(spark, str(tmp_path)).collect()], key=str)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(db.execute(queries.ORACLES["op13_fill_in_middle"]).fetchall(), key=str)
    assert got == want
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    mine = [(*e[:5], sha(e[5]), sha(t or "")) for (d, t, *_), e in ((r, expected(*r[:2])) for r in ROWS)]
    assert got == sorted(mine, key=str)
