from __future__ import annotations

import random
import re

from fleetpulse.llm.queries import QUERIES
from fleetpulse.llm.quotes import link_quotes, parsed

SCHEMA = "conv_id long, turn long, role string, text string, message int, key int, depth int, parent_conv int"


def frame(spark, rows):
    return spark.createDataFrame([(c, t, "user", x, 0, 0, 0, 0) for c, t, x in rows], SCHEMA)


def normal(text):
    return re.sub(r"\s+", " ", text.lower()).strip()


def brute(rows):
    """conv, turn -> (text, quotes, linked, parent, root, depth), by looking through all messages."""
    said = {}
    for c, t, x in rows:
        own = parsed(x)[0]
        for part in [own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]:
            if normal(part):
                said.setdefault(normal(part), []).append((c, t))
    parents, out = {}, {}
    for c, t, x in rows:
        own, passages = parsed(x)
        options, linked = [], set()
        for number, (level, passage) in enumerate(passages):
            for part in {normal(p) for p in [passage, *passage.split("\n")]} - {""}:
                near = min((t2 for c2, t2 in said.get(part, []) if c2 == c), default=None)
                far = min((at for at in said.get(part, []) if at[0] != c), default=None) if len(part.split()) >= 3 else None
                origin = (c, near) if near is not None and near < t else far
                if origin:
                    linked.add(number)
                    options.append((level, -len(part), number, origin))
        parents[c, t] = min(options)[3] if options else None
        out[c, t] = [own, len(passages), len(linked), parents[c, t]]
    for start in sorted(parents):
        at = parents[start]
        seen = set()
        while at and at not in seen and at != start:
            seen.add(at)
            at = parents[at]
        if at == start:  # the first of a circle, as they are taken in order
            parents[start] = None
            out[start][3] = None
    for at, row in out.items():
        root, depth = at, 0
        while parents[root]:
            root, depth = parents[root], depth + 1
        row += [root, depth]
    return {k: tuple(v) for k, v in out.items()}


def ours(df):
    return {
        (r["conv_id"], r["turn"]): (
            r["text"],
            r["n_quotes"],
            r["n_linked"],
            (r["parent_conv"], r["parent_turn"]) if r["parent_conv"] is not None else None,
            (r["root_conv"], r["root_turn"]),
            r["depth"],
        )
        for r in df.collect()
    }


def test_parsing():
    text = "hi\n> a\n> b\n>> c\n > d\nbye\n>\n> > e"
    assert parsed(text) == ("hi\nbye", [(1, "a\nb"), (2, "c"), (1, "d"), (1, ""), (2, "e")])
    assert parsed(None) == parsed("") == ("", [])


def test_a_thread(spark):
    rows = [
        (1, 0, "Where shall we meet?\n\nAnd when?"),
        (1, 1, "> where  shall we MEET?\nAt the old bridge."),
        (1, 2, ">> Where shall we meet?\n> At the old bridge.\nFine."),
        (1, 3, "> And when?\nAt noon."),
        (1, 4, "> At noon.\nFine by me then."),
        (2, 0, "> Fine by me then.\n> no such words\nForwarded."),
    ]
    found = ours(link_quotes(frame(spark, rows)))
    assert found == brute(rows)
    assert found[1, 2] == ("Fine.", 2, 2, (1, 1), (1, 0), 2)
    assert found[2, 0][3] == (1, 4) and found[2, 0][5] == 3


def test_links_to_later_conversations_and_circles(spark):
    rows = [
        (3, 0, "> only sentence of five\nok"),
        (5, 0, "only sentence of five"),
        (6, 0, "> the second of these\nthe first of these"),
        (7, 0, "> the first of these\nthe second of these"),
        (8, 0, "> the second of these\nhanging on the circle"),
        (9, 0, "> ok\nshort words link within a conversation only"),
        (10, 0, "> what I say myself\nwhat I say myself"),
        *[(20 + i, 0, f"> part number {(i + 1) % 5} here\npart number {i} here") for i in range(5)],
    ]
    found = ours(link_quotes(frame(spark, rows)))
    assert found == brute(rows)
    assert found[3, 0][2:] == (1, (5, 0), (5, 0), 1)
    assert found[6, 0][2:] == (1, None, (6, 0), 0) and found[7, 0][2:] == (1, (6, 0), (6, 0), 1)
    assert found[8, 0][2:] == (1, (7, 0), (6, 0), 2)
    assert found[9, 0][2] == found[10, 0][2] == 0
    assert [found[20 + i, 0][5] for i in range(5)] == [0, 4, 3, 2, 1]


def test_random_threads_against_plain_search(spark):
    source, rows, lines = random.Random(4), [], [f"line number {i}" for i in range(25)]
    for conv in range(6):
        for turn in range(8):
            text = [source.choice(["", "> ", ">> ", ">"]) + source.choice(lines) for _ in range(source.randrange(6))]
            rows.append((conv, turn, "\n".join(text)))
    # One long chain of replies.
    rows += [(9, 0, "start 0")] + [(9, i, f"> start {i - 1}\nstart {i}") for i in range(1, 40)]
    found = ours(link_quotes(frame(spark, rows)))
    assert found == brute(rows) and found[9, 39][5] == 39


def test_odd_rows(spark):
    rows = [(None, 0, "a\n> b"), (1, None, "> a"), (1, 0, None), (1, 1, ""), (1, 2, "> \n>"), (2, 0, "b b b"), (2, 1, "> b b b"), (2, 1, "> b b b")]
    rows.append((3, 0, "word " * 50_000 + "\n> b b b"))
    found = link_quotes(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in found}
    assert by[None, 0]["parent_conv"] is None and by[1, None]["parent_conv"] is None
    assert by[1, 0]["text"] is None and by[1, 2]["n_quotes"] == 1
    assert by[2, 1]["parent_turn"] == 0 and by[3, 0]["parent_conv"] == 2
    assert link_quotes(frame(spark, [])).count() == 0


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text").collect()
    expected = brute([tuple(r) for r in rows])
    found = QUERIES["op2_quotes"](spark, sf_dir).collect()
    assert {(r["conv_id"], r["turn"]): (r["n_quotes"], r["n_linked"], r["depth"]) for r in found} == {
        k: (v[1], v[2], v[5]) for k, v in expected.items()
    }
    assert all(r["size"] == len(expected[r["conv_id"], r["turn"]][0].encode()) for r in found)
