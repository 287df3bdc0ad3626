"""PII: detection, formats of surrogates, coreference and distinctness."""

import re

import pytest
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import pii

KEY = b"test key"
TEXT = ("Mail Bob.19@mail5.example.com or BOB.19@MAIL5.example.com, ann@mail5.example.com; call +1 (523) 555-1055, card 4785380592391139 or "
        "4785 3805 9239 1139; from 169.122.221.182 and 10.0.0.7. token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" ssn 123-45-6789 iban "
        "DE89 3704 0044 0532 0130 00. Mr. John Smith met Frau Müller; Smith left. Госпожа Иванова.")
CLEAN = "Version 3.14.15, 9807915762804490 items in 2024-01-02, 1,234,567 of 999.999.1.1, a@b, +12, it's 4785380592391138. Dr no."


def test_detects_and_leaves_the_rest():
    kinds = [e[2] for e in pii.entities(TEXT)]
    assert kinds == ["email"] * 3 + ["phone", "card", "card", "ip", "ip", "secret", "ssn", "iban", "given-m", "family", "family", "family", "family"]
    assert pii.entities(CLEAN) == [] and pii.entities(None) == [] and pii.entities("") == []


def test_surrogates_keep_format_and_reference():
    new, spans = pii.replaced(TEXT, KEY, {})
    old = [TEXT[s:e] for s, e, _, _ in pii.entities(TEXT)]
    got = [new[a:b] for _, a, b in spans]
    shape = lambda t: re.sub("[^\\W\\d_]", lambda m: "A" if m[0].isupper() else "a", re.sub(r"\d", "9", t))
    for o, n, (kind, _, _) in zip(old, got, spans):
        assert o != n
        if kind in ("email", "phone", "card", "ssn", "ip"):
            assert shape(o) == shape(n)
        if kind == "secret":
            assert len(o) == len(n) and re.fullmatch("[0-9a-f]+", n)
    assert got[0].lower() == got[1].lower() and got[1].split("@")[0].isupper()
    assert got[0].split("@")[1] == got[2].split("@")[1].lower() and got[0].endswith(".com")
    assert got[3].startswith("+1 (")
    assert got[4] == got[5].replace(" ", "") and got[4][0] == "4" and pii.luhn(got[4])
    assert got[7].startswith("10.") and pii.iban_rest(got[10].replace(" ", "")) == 1 and got[10].startswith("DE")
    assert got[12] == got[14] and got[15][0] > "Ѐ"
    rest = lambda text, spots: "|".join(text[a:b] for a, b in zip([0, *[e for _, e in spots]], [*[s for s, _ in spots], len(text)]))
    assert rest(TEXT, [(s, e) for s, e, _, _ in pii.entities(TEXT)]) == rest(new, [(a, b) for _, a, b in spans])
    assert pii.replaced(TEXT, KEY, {}) == (new, spans) and pii.replaced(TEXT, b"other", {})[0] != new


def test_gender_of_given_names():
    endings = {g: tuple(pii.SOUNDS["latin"][2][g]) for g in "mf"}
    for k in range(30):
        for title, g in (("Mr", "m"), ("Mrs", "f")):
            new, spans = pii.replaced(f"{title}. Alex{'abcdefghijklmnopqrstuvwxyz'[k % 26]} Jones", KEY, {})
            assert new[spans[0][1]:spans[0][2]].endswith(endings[g])


def test_whole_table(spark, documents):
    rows = [(i, f"x{i} " + (TEXT if i % 2 else CLEAN)) for i in range(40)] + ODD
    got = pii.pseudonymise(documents(rows), KEY).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id and r.doc_id > 10}
    want = pii.replaced(TEXT, KEY, {})[0]
    for i in range(11, 40):
        assert by_id[i].text == f"x{i} " + (want if i % 2 else CLEAN) and bool(by_id[i].spans) == bool(i % 2)
        assert all(s.kind and by_id[i].text[s.start:s.end] for s in by_id[i].spans)
    assert sorted(str(r.text) for r in got if not r.spans and (r.doc_id or 0) < 11) == sorted([str(t) for _, t, *_ in ODD] + ["x%d " % i + CLEAN for i in range(0, 11, 2)])
    assert pii.pseudonymise(documents([]), KEY).collect() == []


def test_clashes_draw_again(spark, documents, monkeypatch):
    # Short addresses: few surrogates for many entities, so many clash with each other and with entities.
    old = [f"{a}{b}@long-host.de" for a in "abcdefgh" for b in "0123456789"]
    monkeypatch.setattr(pii, "like", lambda value, bytes_, real=pii.like: value if value.startswith("long") else real(value, bytes_))
    got = pii.pseudonymise(documents([(i, f"write to {a} now") for i, a in enumerate(old)]), KEY).collect()
    new = [r.text.split()[2] for r in got]
    assert len(set(new)) == len(new) == 80 and not set(new) & set(old)


def test_impossible_format_is_reported(spark, documents, monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, canonical, draw: "always the same")
    monkeypatch.setattr(pii, "MOST_DRAWS", 3)
    with pytest.raises(ValueError, match="still clash"):
        pii.pseudonymise(documents([(1, "a@b.com"), (2, "c@d.com")]), KEY)


@pytest.mark.parametrize("name", ["token", "passwd", "api_key", "api-key", "access_key", "access_token", "MY-API_KEY", "secret_key", "db_password_old"])
def test_secrets_of_letters_only(name):
    value = "AbCdEfGhIjKlMnOpQrSt"
    assert [e[2] for e in pii.entities(f"x {name} = '{value}' y")] == ["secret"] and pii.entities(f"x {name}s{value} y") == []


def test_one_name_is_one_entity_and_names_of_all_kinds_stay_apart(spark):
    text = "Dr. John Smith met Mr. John Smith, and John left."
    assert {(kind, c) for *_, kind, c in pii.entities(text)} == {("given-m", "john"), ("family", "smith")}
    names = [f"{a}{b}{c}o" for a in "bcdfghjklm" for b in "aeiou" for c in "nprst"] + [f"w{a}{b}x" for a in "bcdfghjklm" for b in "aeiou"]
    rows = [(kind, f"{n}{kind[-1]}") for n in names for kind in ("given-m", "given-f", "given-n", "family")]
    again = {(r.kind, r.canonical): r.draw for r in pii.drawn(spark.createDataFrame(rows, "kind string, canonical string"), b"k").collect()}
    stand_ins = [pii.surrogate(b"k", kind, c, again.get((kind, c), 0)) for kind, c in rows]
    assert len(set(stand_ins)) == len(rows) and not set(stand_ins) & {c for _, c in rows}
    assert len({pii.surrogate(b"k", *row, 0) for row in rows}) < len(rows)  # first draws do meet
