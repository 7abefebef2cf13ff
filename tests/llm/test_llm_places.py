"""Passages that begin where no word does."""

import random

import pytest

from trackloom.llm import decontaminate

DRAW = random.Random(8)


def letters(first, count, size):
    return "".join(chr(first + DRAW.randrange(count)) for _ in range(size))


SHORT = [(i, letters(97, 26, 20 + i % 4)) for i in range(8)]
LONG = [(100 + i, " ".join(letters(97, 26, 6) for _ in range(30))) for i in range(8)]
HAN = [(200 + i, letters(0x4E00, 3000, 30)) for i in range(8)]


def edited(text, edits):
    out = list(text)
    for k in range(edits):
        at = DRAW.randrange(len(out))
        out[at : at + k % 2 + 1] = ["#"] * (k % 3 % 2)
    return "".join(out)


@pytest.mark.parametrize("before", ["(", "<b>", "“", "half", "の" * 200])
def test_leaks_begin_anywhere(spark, before):
    rows, planted = [], set()
    for name, text in SHORT + LONG + HAN:
        body = edited(text, 4) if name in dict(LONG) else text
        rows.append((name, f"{letters(97, 26, 9)} {before}{body}) {letters(97, 26, 40)}"))
        planted.add((name, name))
    rows += [(1000 + i, letters(97, 26, 300)) for i in range(8)] + [(1100 + i, letters(0x4E00, 3000, 90)) for i in range(8)]
    got = decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(SHORT + LONG + HAN, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    texts = dict(rows)
    for r in got:
        if r.distance == 0:
            item = dict(SHORT + LONG + HAN)[r.item_id].encode()
            assert texts[r.doc_id].encode()[r.begin :].startswith(item)
