from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import fill_middle
from fleetpulse.llm.fill_middle import RankIndex, fill_in_middle, fill_middle_rows, restored
from fleetpulse.llm.queries import QUERIES


def plain_form(doc_id, text):
    """n, form, prefix and middle length and output of one document, token by token."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    a, b, c = ("".join(part) for part in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h4 % 100 < 20:
        return len(tokens), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return len(tokens), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def ours(df):
    made = df.withColumn("again", restored("output", "form")).collect()
    assert all(r["again"] == (r["text"] or "") for r in made)
    return sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made), key=str)


def brute(rows):
    return sorted(((d, *plain_form(d, t)) for d, t in rows), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.integers(0, 127), st.integers(1, 60), st.integers(1, 50))
def test_index_is_exact_and_its_error_bounded(steps, error, span, piece):
    offsets = np.cumsum(np.array(steps, np.int64))
    index = RankIndex(error, span)
    for at in range(0, len(offsets), piece):
        index.add(offsets[at : at + piece])
    index.close()
    ranks = np.arange(len(offsets))
    assert (index.offsets(ranks) == offsets).all()
    if len(offsets):
        assert np.abs(index.predicted(ranks) - offsets).max() <= error


def test_even_boundaries_need_few_segments():
    index = RankIndex(error=3, span=4096)
    index.add(np.arange(0, 300_000, 3))
    assert len(index.close().first) <= 100_000 // 4096 + 1
    with pytest.raises(ValueError):
        RankIndex(error=200)


def test_against_tokens_one_by_one(documents, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert ours(fill_in_middle(odd)) == brute(rows)
    rows = [(i, t) for i, t in enumerate(["a<P>b", "<M>", "<", "x<S", "S>y", "né漢😀 zz\n\n\tZ", "ab12cd", "\U0001f600" * 9, "<P"] * 12)]
    assert ours(fill_in_middle(documents(*rows))) == brute(rows)
    assert fill_middle_rows(documents()).count() == 0


def test_long_texts_in_pieces(documents, monkeypatch):
    """Blocks of a few bytes, so that texts are longer than a block and cut inside words and characters."""
    rows = [(i, ("wörd 漢字 plain, text😀 " * (i % 7 + 1))[: 3 * i]) for i in range(40)]
    for size in (1, 5, 64, 1000):
        monkeypatch.setattr(fill_middle, "BLOCK_BYTES", size)
        for doc_id, text in rows:
            data = np.frombuffer(text.encode(), np.uint8)
            block = fill_middle._Block(data, np.array([0, len(data)]))
            ends = [0, *(m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S))]
            assert block.tokens[0] == len(ends) - 1
            assert [int(block.cut(np.array([k]))[0]) for k in range(len(ends))] == ends
    monkeypatch.undo()
    whole = [(1, "Ab é" * 1_500_000), (2, "b" * 5_000_000)]
    assert ours(fill_in_middle(documents(*whole))) == brute(whole)


def test_columns(odd):
    made = fill_in_middle(odd.withColumnsRenamed({"sum": "n", "rep": "form"}))
    assert made.columns == [c for c in odd.columns if c not in ("sum", "rep")] + ["n", "form", "prefix_chars", "middle_chars", "output"]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in QUERIES["op11_fill_middle"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    forms = set()
    for doc_id, text in rows:
        n, form, a, b, output = plain_form(doc_id, text)
        forms.add(form)
        r, sha = found[doc_id], [hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == (n, form, a, b, *sha)
    assert forms == {"plain", "psm", "spm"}
