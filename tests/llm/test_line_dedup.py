from __future__ import annotations

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from fleetpulse.llm.line_dedup import chunks, dedup_lines, line_rows, passages
from fleetpulse.llm.queries import QUERIES


def brute(rows, whole=False):
    """Text left of each (doc_id, text), in order of id, nulls last; with ``whole``, passages are chunks too.

    A passage that overlaps its first place in the text stays.
    """
    first, left = {}, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lines, gone, seen = (text or "").encode().split(b"\n"), set(), {}
        ranges = {*chunks(text.encode()), *(passages(lines) if whole else [])} if text else set()
        for a, b in sorted(ranges):
            chunk = b"\n".join(lines[a:b])
            here = seen.setdefault(chunk, (a, b))
            if here[0] < a < here[1]:
                continue
            if here[0] < a or (doc_id is not None and first.setdefault(chunk, doc_id) != doc_id):
                gone.update(range(a, b))
            elif doc_id is None and chunk in first:
                gone.update(range(a, b))
        kept = b"\n".join(line for i, line in enumerate(lines) if i not in gone)
        left.append((doc_id, len(gone), None if text is None else kept.decode()))
    return sorted(left, key=str)


def ours(df):
    return sorted(((r["doc_id"], r["removed_lines"], r["text"]) for r in df.collect()), key=str)


def test_chunks_cover_lines_in_order_and_resist_shifts(prose):
    lines = prose(900, 1).split("\n")
    found = chunks("\n".join(lines).encode())
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:])) and all(b - a >= 2 for a, b in found)

    def said(text):
        rows = text.split("\n")
        return {"\n".join(rows[a:b]) for a, b in chunks(text.encode())}

    shifted = said("\n".join(["new", "lines", "before", *lines]))
    assert len(shifted & said("\n".join(lines))) >= len(found) - 3
    assert chunks(b"one\n" + b"w " * 60 + b"\ntwo") == [(1, 2)]


def test_against_plain_removal(documents, prose):
    shared, page = prose(90, 50), "x " * 80
    rows = [(i, "\n".join([prose(30, i), shared, prose(20, 100 + i)])) for i in range(6)]
    rows += [(10, prose(40, 1000) + "\n" + prose(40, 1000)), (11, page), (12, "a\n" + page), (13, rows[0][1])]
    rows += [(14, prose(40_000, 3)), (15, prose(40_000, 3))]
    assert ours(dedup_lines(documents(*rows))) == brute(rows)


def runs_left(rows, words=50):
    """Lines with words left of each document: of any run of lines that a smaller id has, nothing stays."""
    left, held = [], set()
    for doc_id, text in rows:
        lines, gone, own = text.split("\n"), set(), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if sum(len(line.split()) for line in run) >= words:
                    own.add(run)
                    gone.update(range(a, b) if run in held else ())
        held |= own
        left.append((doc_id, [line for i, line in enumerate(lines) if i not in gone]))
    return left


def test_whole_passages_go(documents, prose):
    """Passages of two to eight lines under 50 words, at all places of other texts; no use of chunks()."""
    source, rows = random.Random(8), []
    shared = ["\n".join(prose(27, 900 + 20 * n + k, line=27) for k in range(n)) for n in range(2, 9)]
    for i in range(40):
        parts = [prose(source.randrange(5, 60), 10 * i + k, words=10**6, line=source.randrange(4, 30)) for k in range(3)]
        rows.append((i, "\n".join([parts[0], source.choice(shared), parts[1], source.choice(shared), parts[2]])))
    rows = [(i, text) for i, text in rows if len(set(text.split("\n"))) == len(text.split("\n"))]
    found = {r["doc_id"]: r for r in dedup_lines(documents(*rows), whole=True).collect()}
    for doc_id, lines in runs_left(rows):
        assert found[doc_id]["text"] == "\n".join(lines)
        assert found[doc_id]["removed_lines"] == found[doc_id]["n_lines"] - len(lines)


def test_repeats_in_one_text_leave_the_first_place_whole(documents, prose):
    line = prose(25, 1, line=25)
    assert passages([b"", line.encode(), b"", line.encode(), b"x"]) == [(1, 4), (1, 5)]
    left = dedup_lines(documents((1, "\n".join([line] * 5))), whole=True).collect()
    assert left[0]["text"] == line + "\n" + line


def test_columns_and_odd_rows(odd, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert ours(dedup_lines(odd)) == brute(rows)
    assert [c for c in dedup_lines(odd).columns if c not in ("n_lines", "removed_lines")] == odd.columns
    assert line_rows(documents()).count() == 0
    # Rows of one id are one document; rows of null ids give way.
    same = [(4, "p q\nr s\nt u"), (4, "p q\nr s\nt u"), (None, "p q\nr s\nt u"), (None, "k\nl\nm\nn"), (None, "k\nl\nm\nn")]
    left = ours(dedup_lines(documents(*same)))
    assert [r for r in left if r[0] == 4] == [(4, 0, "p q\nr s\nt u")] * 2
    assert all(r[1] == 0 for r in left if r[2] and r[2].startswith("k"))
    counted = dedup_lines(documents((1, "a\nb\nc\nd"), (2, "a\nb\nc\nd")).withColumn("n_chars", F.length("text")))
    assert all(r["n_chars"] == len(r["text"]) for r in counted.collect())


def test_query(spark, sf_dir):
    """The whole result against chunks and passages removed one by one, and against runs that know of neither."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    removed = brute(rows, whole=True)
    expected = {d: (n, len(t.encode()), zlib.crc32(t.encode())) for d, n, t in removed}
    found = QUERIES["op3_line_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["removed_lines"], r["size"], r["text_crc32"]) for r in found} == expected
    assert any(e[0] for e in expected.values())
    texts = {d: t.split("\n") for d, _, t in removed}
    for doc_id, lines in runs_left(sorted(rows)):
        left = Counter(line for line in texts[doc_id] if line.split())
        assert not left - Counter(line for line in lines if line.split()), doc_id
