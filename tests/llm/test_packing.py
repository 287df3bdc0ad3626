"""Token pieces against the tokenizers library, packing against sequential best fit."""

import bisect
import collections
import random
import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from edge_cases import ODD, documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayledger.llm import packing, queries, tokens

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODING = queries.byte_bpe().encoding()


RUNS = ["a b\nc\u3000d ", "a  b", "a\u1680\u205fb", "a\u202f\x85b", " \n\n x  1\t\t٣ ", "  ", "\u2028 \u3000é", "a \x1c b \x1f\x1fc", "x  <|endoftext|>  y", "\x85\x85'll", "don't  's", None, ""]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def best_fit(lengths, capacity):
    """Sequences that best fit decreasing opens."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, length)
        if k < len(gaps):
            rest = gaps.pop(k) - length
        else:
            opened, rest = opened + 1, capacity - length
        if rest:
            bisect.insort(gaps, rest)
    return opened


def check(rows, capacity):
    """``rows``: (length, sequence, offset). Gapless from 0 and never too long; returns the sequences."""
    by_sequence = collections.defaultdict(list)
    for length, sequence, offset in rows:
        by_sequence[sequence].append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def packed_ids(texts):
    return [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in queries.byte_bpe().ids(pa.array(texts, pa.string()))]


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab 's\t\n\x1c\x85\u2028\u3000é1"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=4))
@settings(max_examples=400, deadline=None)
def test_ids_by_either_pattern_are_those_of_the_library(texts):
    texts = [*texts, "<|endoftext|>".join(texts)]
    assert packed_ids(texts) == [library_ids(t) for t in texts]


def test_ids_of_texts_with_and_without_runs_of_white_space():
    assert packed_ids(RUNS) == [library_ids(t) for t in RUNS]


def test_a_process_reads_its_vocabulary_once():
    assert queries.byte_bpe().encoding() is queries.byte_bpe().encoding()


@given(st.text(alphabet=st.sampled_from("ab 'sé  \x1c\x85\t\n\r<|>1٣世界🙂́"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_tokenizers_library(text):
    assert ENCODING.encode_to_numpy(text, allowed_special="all").tolist() == library_ids(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a <|endoftext|> b", " <|endoftext|><|endoftext|>", "I'll we've 12,345", "x" * 5_000, "\n\n \n", "<|endof text|>"])
def test_ids_of_special_and_long_texts(text):
    assert ENCODING.encode_to_numpy(text, allowed_special="all").tolist() == library_ids(text)


def test_ids_of_the_given_documents(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert all(ENCODING.encode_to_numpy(t, allowed_special="all").tolist() == library_ids(t) for t in texts)


@pytest.mark.parametrize("length,want", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1025)]), (2048, [(0, 1024), (1024, 2048)]), (2050, [(0, 2), (2, 1026), (1026, 2050)])])
def test_only_longer_documents_are_cut(length, want):
    assert tokens.spans(length, 1024) == want


def rounds(lengths, capacity):
    """Sequences and rounds when counts alone are swept."""
    waiting = {n: (0, c) for n, c in collections.Counter(lengths).items()}
    gaps, opened, k = collections.Counter(), 0, 0
    while waiting:
        matches, taken, opened = packing.sweep(waiting, {g: n for g, n in gaps.items() if n}, capacity, opened)
        for m in matches:
            if not m.opened:
                gaps[m.gap] -= m.count
            if m.gap > m.size:
                gaps[m.gap - m.size] += m.count
        assert min(gaps.values(), default=0) >= 0 and taken
        for t in taken:
            assert t.first == waiting[t.length][0] or len([x for x in taken if x.length == t.length]) == 2
            waiting[t.length] = (t.stop, waiting[t.length][1])
        waiting = {n: w for n, w in waiting.items() if w[0] < w[1]}
        k += 1
    return opened, k


@given(st.lists(st.integers(1, 64), max_size=300))
@settings(max_examples=200, deadline=None)
def test_sweeps_end_and_open_about_as_many_as_best_fit(lengths):
    opened, _ = rounds(lengths, 64)
    assert opened <= best_fit(lengths, 64) + 1


def test_rounds_do_not_grow_with_the_number_of_pieces():
    for draw in (lambda r: r.randint(1, 1024), lambda r: 2, lambda r: min(1024, int(r.lognormvariate(5, 1.2)) + 1), lambda r: r.randint(1, 60)):
        few, many = ([draw(random.Random(k)) for k in range(n)] for n in (2_000, 40_000))
        assert rounds(many, 1024)[1] <= max(40, 2 * rounds(few, 1024)[1])


@pytest.mark.parametrize("lengths", [
    [1024, 1024, 1023, 1, 600, 424, 424, 2], [7] * 500 + [1000] * 40, [random.Random(k).randint(1, 900) for k in range(700)], [5]])
def test_packing_is_best_fit(spark, lengths):
    rows = spark.createDataFrame([(k, n, "x") for k, n in enumerate(lengths)], "id long, length long, offset_ string").repartition(3)
    got = packing.pack(rows, 1024).collect()
    assert sorted((r.id, r.length) for r in got) == sorted(enumerate(lengths))
    assert check([(r.length, r.sequence_id, r.offset) for r in got], 1024) == best_fit(lengths, 1024)


def test_no_pieces_and_wrong_lengths(spark):
    assert packing.pack(spark.createDataFrame([], "length long"), 8).collect() == []
    for wrong in (0, 9, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(wrong,)], "length long"), 8)


def test_query_on_odd_documents(spark, documents, tmp_path):
    rows = ODD + [(50 + k, "copy of a text " * 40, "s") for k in range(60)] + [(200, "long words " * 3_000, "s")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_packing(spark, str(tmp_path)).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = library_ids(text) + [2]
        for piece, (a, b) in enumerate(tokens.spans(len(ids), 1024)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    assert check([(r.length, r.sequence_id, r.offset) for r in got], 1024) == best_fit([w[3] for w in want], 1024)


def test_sequences_hold_the_ids_of_their_pieces(spark, documents):
    rows = [(k, f"number {k} " * k, "s") for k in range(30)]
    cut = packing.pieces(documents(rows), queries.byte_bpe(), capacity=64)
    packed = packing.pack(cut, 64).cache()
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert all(0 < len(ids) <= 4 * 64 for ids in made.values())
    for r in packed.collect():
        assert made[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    by_doc = collections.defaultdict(dict)
    for r in packed.collect():
        by_doc[r.doc_id][r.piece] = bytes(r.ids)
    assert {d: b"".join(p[k] for k in sorted(p)) for d, p in by_doc.items()} == {
        d: struct.pack(f"<{len(library_ids(t)) + 1}I", *library_ids(t), 2) for d, t, _ in rows}
