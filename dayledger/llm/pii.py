"""PII: detected entities are replaced by keyed surrogates of their own kind.

Kinds: email, phone, card (Luhn and issuer digits hold), ip, iban (check digits hold), ssn, secret (long
hexadecimal or base-64 values assigned to a name like token or password) and, after a title, the given and
family names of a person, then every other mention of these names in the document. A given name under titles of
two genders takes the first, under a neutral and a gendered title the gendered one.

A surrogate is drawn by HMAC-SHA256 from the key, the kind and the entity's canonical form, so every
mention of an entity, in any document and any spelling, gets the same one. It keeps length, separators,
case, script and kind of every character, the country code of a phone, the issuer digit of a card, class
and octet lengths of an address, the top-level domain, and the gender a title tells; check digits hold
again. Mail hosts are entities of their own, so addresses of one host stay on one host.

Distinctness is checked over the corpus: the distinct entities and their surrogates are compared by Spark, names
of all kinds with each other;
of entities with one surrogate all but the first, and those whose surrogate is itself an entity, draw
again until none is left. Only the entities that had to draw again are joined back to their documents.

Defined cases: null text stays null, empty text empty; documents without entities come out unchanged;
overlapping finds go to the first, then the longest; repeated rows get equal results; empty input gives no
rows. Other columns are not read. A name outside the given scripts (Latin, Cyrillic, Greek) is left.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import stored

MOST_DRAWS = 200

#: Titles that announce a name, and the gender they tell.
TITLES = {
    "mr": "m", "mister": "m", "sir": "m", "herr": "m", "herrn": "m", "monsieur": "m", "señor": "m", "signor": "m", "don": "m",
    "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "madame": "f", "mme": "f", "mademoiselle": "f", "señora": "f",
    "señorita": "f", "signora": "f", "doña": "f", "dr": "n", "prof": "n", "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f",
}
#: Sounds names are made of, by script: openings, vowels, endings of given names by gender, of family names.
SOUNDS = {
    "latin": ("b c d f g h j k l m n p r s t v br dr gr kr tr st".split(), "a e i o u".split(), {"m": ["n", "s", "ro", "k"], "f": ["a", "ia", "elle", "ina"], "n": ["n", "a", "s", "e"]}, ["son", "mann", "er", "ez", "ard", "ley"]),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), {"m": ["н", "р", "й", "слав"], "f": ["а", "ия", "на", "ья"], "n": ["н", "а", "р", "я"]}, ["ко", "чук", "ич", "ян", "ец", "ик"]),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε η ι ο".split(), {"m": ["ος", "ης", "ας", "ων"], "f": ["α", "η", "ια", "ώ"], "n": ["ος", "α", "η", "ις"]}, ["ίδης", "άκης", "όπουλος", "άκος", "έας", "ίου"]),
}
CAPITAL, LETTER = r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩЀ-Я]", r"[A-Za-zÀ-ÖØ-öø-ÿΆ-ώЀ-ӿ'’-]"
NAME = CAPITAL + LETTER + "+"
#: Names a secret is assigned to, also as a part of a name joined by _ or -.
SECRET = r"(?<![^\W_])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)(?![^\W_])"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]*\w@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}\b)"
    rf"|(?P<secret>(?i:{SECRET}(?:[_-][^\W_]+)*+\s*[=:]\s*[\"']?)(?P<value>[A-Za-z0-9+/_-]{{16,}}=*))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)(?!\w))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}(?P<sep>[.-])\d{3}(?P=sep)\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    rf"|(?P<person>\b(?P<title>(?i:{'|'.join(sorted(TITLES, key=len, reverse=True))}))\.?[ \u00a0]+(?P<names>{NAME}(?:[ \u00a0]{NAME}){{0,2}}))")
#: What any entity needs: a digit, an at sign, a title, or the name of a secret.
TRIGGER = re.compile(rf"[0-9@]|\b(?i:{'|'.join(sorted(TITLES, key=len, reverse=True))})\b|(?i:{SECRET})")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(doubled)) % 10 == 0


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script_of(name: str) -> str:
    return "cyrillic" if "Ѐ" <= name[0] <= "ӿ" else "greek" if "Ά" <= name[0] <= "ώ" else "latin"


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` of all mentions, in order, without overlaps."""
    if not text or not TRIGGER.search(text):
        return []
    found, names = [], {}
    for m in PATTERN.finditer(text):
        start, end = m.span()
        kind = next(k for k in ("email", "secret", "iban", "ip", "phone", "ssn", "card", "person") if m[k] is not None)
        value = m[0]
        digits = "".join(c for c in value if c.isdigit())
        if kind == "email":
            found.append((start, end, kind, value.lower()))
        elif kind == "secret":
            found.append((m.start("value"), m.end("value"), kind, m["value"]))
        elif kind == "iban":
            plain = value.replace(" ", "")
            if 15 <= len(plain) <= 34 and iban_rest(plain) == 1:
                found.append((start, end, kind, plain))
        elif kind == "ip":
            if all(int(p) < 256 for p in value.split(".")):
                found.append((start, end, kind, value))
        elif kind == "phone":
            if 8 <= len(digits) <= 15:
                country = re.match(r"\+(\d{1,3})[ .(-]", value)
                found.append((start, end, kind, (f"+{country[1]} " if country else "+ " if value[0] == "+" else "") + digits[len(country[1]) if country else 0:]))
        elif kind == "ssn":
            found.append((start, end, kind, digits))
        elif kind == "card":
            if luhn(digits) and (digits[0] in "3456" or "22" <= digits[:2] <= "27"):
                found.append((start, end, kind, digits))
        else:
            gender, at = TITLES[m["title"].lower()], m.start("names")
            parts = list(re.finditer(NAME, m["names"]))
            for k, part in enumerate(parts):
                which = "family" if k == len(parts) - 1 else "given-" + gender
                names[part[0]] = which
                found.append((at + part.start(), at + part.end(), which, part[0].lower()))
    # One given name is one entity in a text: where some title tells its gender, that holds for all its mentions.
    told = {c: kind for _, _, kind, c in reversed(found) if kind in ("given-m", "given-f")}
    found = [(a, b, told.get(c, kind) if kind.startswith("given") else kind, c) for a, b, kind, c in found]
    names = {n: told.get(n.lower(), kind) if kind.startswith("given") else kind for n, kind in names.items()}
    if names:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})(?!\w)", text):
            if not any(s < m.end() and m.start() < e for s, e, _, _ in found):
                found.append((m.start(), m.end(), names[m[0]], m[0].lower()))
    return sorted(found)


def stream(key: bytes, *parts: str) -> Iterator[int]:
    """Endless keyed bytes."""
    n = 0
    while True:
        yield from hmac.new(key, "\0".join((*parts, str(n))).encode(), hashlib.sha256).digest()
        n += 1


def like(value: str, bytes_: Iterator[int]) -> str:
    """Characters of the same class: digit, hexadecimal letter run, lower or upper letter; others stay."""
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) and any(c.isalpha() for c in value) and len(value) >= 16
    out = []
    for c in value:
        b = next(bytes_) << 8 | next(bytes_)
        if hexadecimal:
            out.append(("0123456789abcdef" if value == value.lower() else "0123456789ABCDEF")[b % 16])
        elif c.isdigit():
            out.append("0123456789"[b % 10])
        elif c.isascii() and c.isalpha():
            out.append(chr((97 if c.islower() else 65) + b % 26))
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, canonical: str, draw: int) -> str:
    """The canonical form that stands for ``canonical``."""
    bytes_ = stream(key, kind, canonical, str(draw))
    if kind == "email":
        local, _, host = canonical.rpartition("@")
        labels, top = host.rsplit(".", 1)
        return f"{like(local, bytes_)}@{like(labels, stream(key, 'host', host))}.{top}"
    if kind == "phone":
        head, _, tail = canonical.rpartition(" ")
        return (head + " " if head else "") + str(2 + next(bytes_) % 8) + like(tail[1:], bytes_)
    if kind == "card":
        body = canonical[0] + like(canonical[1:-1], bytes_)
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "ip":
        if ipaddress.ip_address(".".join(str(int(p)) for p in canonical.split("."))).is_private:
            head, rest = (canonical.split(".")[:1], canonical.split(".")[1:]) if canonical.startswith(("10.", "127.")) else (canonical.split(".")[:2], canonical.split(".")[2:])
        else:
            head, rest = [], canonical.split(".")
        span = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        return ".".join(head + [str(span[len(p)][0] + (next(bytes_) << 8 | next(bytes_)) % (span[len(p)][1] - span[len(p)][0] + 1)).zfill(len(p)) for p in rest])
    if kind == "iban":
        body = like(canonical[4:], bytes_)
        return canonical[:2] + f"{98 - iban_rest(canonical[:2] + '00' + body):02d}" + body
    if kind == "family" or kind.startswith("given"):
        first, vowels, given, family = SOUNDS[script_of(canonical)]
        ending = family if kind == "family" else given[kind[-1]]
        pick = lambda some: some[(next(bytes_) << 8 | next(bytes_)) % len(some)]
        return "".join(pick(first) + pick(vowels) for _ in range(2 + (kind == "family") + draw // 20)) + pick(first) * (ending is family) + pick(ending)
    return like(canonical, bytes_)


def rendered(mention: str, kind: str, canonical: str, stand_in: str) -> str:
    """``stand_in`` in the format of the mention: its separators and its case."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(mention, stand_in))
    if kind in ("ip", "secret"):
        return stand_in
    if kind == "family" or kind.startswith("given"):
        return stand_in.upper() if mention.isupper() and len(mention) > 1 else stand_in[:1].upper() + stand_in[1:]
    fill = iter(stand_in.replace("+", "").replace(" ", ""))
    return "".join(next(fill) if c.isalnum() else c for c in mention)


def replaced(text: str | None, key: bytes, draws: dict[tuple[str, str], int]) -> tuple[str | None, list[tuple]]:
    """The text with surrogates, and ``kind, start, end`` of each in the new text."""
    out, done, spans, length = [], 0, [], 0
    for start, end, kind, canonical in entities(text):
        if start < done:
            continue
        new = rendered(text[start:end], kind, canonical, surrogate(key, kind, canonical, draws.get((kind, canonical), 0)))
        out += [text[done:start], new]
        length += start - done
        spans.append((kind, length, length + len(new)))
        length, done = length + len(new), end
    return (text if not spans else "".join(out) + text[done:]), spans


def mentions(docs: DataFrame, text: str) -> DataFrame:
    """``row_key, kind, canonical``: distinct entities of every distinct text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, kind, canonical) for k, t in zip(batch["row_key"], batch["text"]) for kind, canonical in {e[2:] for e in entities(t)}]
            yield pd.DataFrame(rows, columns=["row_key", "kind", "canonical"])
    return docs.select(F.xxhash64(text).alias("row_key"), F.col(text).alias("text")).mapInPandas(run, "row_key long, kind string, canonical string")


def drawn(entities_: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, draw`` of the entities that may not keep their first surrogate.

    Every round compares all surrogates with each other and with the entities; the first of equals
    (fewest draws, then canonical order) keeps its own. Each round is written to the shared folder."""
    @F.pandas_udf("string")
    def draw_again(kind: pd.Series, canonical: pd.Series, draw: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, c, d) for k, c, d in zip(kind, canonical, draw)], dtype=object)

    # Names of all kinds share one space: no family name may look like another person's given name.
    space = F.when(F.col("kind").startswith("given") | (F.col("kind") == "family"), F.lit("name")).otherwise(F.col("kind")).alias("space")
    entities_ = entities_.withColumn("space", space)
    real = entities_.select("space", F.col("canonical").alias("new"), F.lit(True).alias("real")).distinct()
    now = stored(entities_.withColumn("draw", F.lit(0)).withColumn("new", draw_again("kind", "canonical", F.lit(0))))
    for _ in range(MOST_DRAWS):
        first = now.groupBy("space", "new").agg(F.min(F.struct("draw", "canonical")).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = first.join(real, ["space", "new"], "left") \
            .filter("n > 1 OR real")
        clash = stored(clash.select("space", "new", F.when(F.col("real"), None).otherwise(F.col("first.canonical")).alias("keeper"), F.lit(True).alias("clashes")))
        if clash.isEmpty():
            return now.filter("draw > 0").select("kind", "canonical", "draw")
        told = now.join(clash, ["space", "new"], "left")
        again = F.coalesce("clashes", F.lit(False)) & ~F.coalesce(F.col("keeper") == F.col("canonical"), F.lit(False))
        moved = told.filter(again).select("kind", "canonical", "space", (F.col("draw") + 1).alias("draw")).withColumn("new", draw_again("kind", "canonical", "draw"))
        now = stored(told.filter(~again).select("kind", "canonical", "space", "draw", "new").unionByName(moved))
    raise ValueError(f"surrogates still clash after {MOST_DRAWS} draws: too many entities for their format")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, text, spans`` of every document: the text with surrogates, and where they stand in it."""
    found = stored(mentions(docs, text))
    again = drawn(stored(found.select("kind", "canonical").distinct()), key)
    # Written, so that Spark knows how few documents are concerned before it plans the join.
    special = stored(found.join(again, ["kind", "canonical"]).groupBy("row_key").agg(
        F.collect_set(F.struct("kind", "canonical", "draw")).alias("draws")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [replaced(t, key, {(d["kind"], d["canonical"]): d["draw"] for d in draws} if draws is not None else {})
                    for t, draws in zip(batch["text"], batch["draws"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": pd.Series([t for t, _ in done], dtype=object, index=batch.index),
                                "spans": pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in done], dtype=object, index=batch.index)})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), F.col(text).alias("text"))
    return rows.join(special, "row_key", "left").select("doc_id", "text", "draws").mapInPandas(
        run, "doc_id long, text string, spans array<struct<kind: string, start: int, end: int>>")
