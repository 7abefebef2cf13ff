"""Token alignment against a direct reading of both tokenizations."""

import hashlib
import json
import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackloom.llm import alignment
from trackloom.llm.queries import TOKENIZERS, token_alignment

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(A), reason="no tokenizer files")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text, tokenizers):
    """(id, begin, end) of both sides, or None where the bytes differ."""
    a, b = tokenizers
    alphabet = alignment.byte_alphabet()
    sides = []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    sides.append([(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in ids])
    ids = b.encode(text)
    sides.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids])
    out = []
    for side in sides:
        if b"".join(t for _, t in side) != b" " + text.encode():
            return None
        at, placed = 0, []
        for i, t in side:
            placed.append((i, at, at + len(t)))
            at += len(t)
        out.append(placed)
    return out


def plain(texts, tokenizers):
    rows, links = [], []
    for text in texts:
        found = spans(text, tokenizers) if text else None
        if found is None:
            rows.append([0, 0, 0, 0, ""])
            links.append([])
            continue
        a, b = found
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        written, begin = [], 0
        for end in cuts:
            written.append("|".join(",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in (a, b)))
            begin = end
        linked = [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]
        rows.append([len(a), len(b), len(cuts), len(linked), hashlib.sha256(";".join(written).encode()).hexdigest()])
        links.append(linked)
    counts = Counter(pair for linked in links for pair in set(linked))
    highest = {}
    for (i, _), n in counts.items():
        highest[i] = max(highest.get(i, 0), n)
    for row, linked in zip(rows, links):
        row += [sum(counts[p] == highest[p[0]] for p in linked), sum(counts[p] for p in linked)]
    return rows


def random_texts(n, seed=3):
    draw = random.Random(seed)
    letters = "etaoin shrdlu  éèñ中文の🙂\n\t.,'<>/"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(n)]


HOSTILE = [None, "", " ", "  ", "\n", "▁", "a▁b", "<s> </s> <unk> <|endoftext|> <0x41>", "a\x00b", " x", "é ﬁ", "the the the", "the the the",
           "a" * 5000, "​﻿", "x" * 40 + " " * 40 + "y"]


@pytest.mark.parametrize("block,batch", [(alignment.BLOCK, alignment.BATCH), (50, 100)])
def test_against_a_direct_reading(spark, tokenizers, block, batch):
    texts = HOSTILE + random_texts(60)
    ids = [None, *range(len(texts) - 1)]
    ids[5] = 4
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3).withColumn("block", F.lit("x"))
    got = alignment.align(df.withColumn("n_a", F.lit(0)), A, B, batch, block).collect()
    shown = sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in got)
    assert shown == sorted((str(i), *row) for i, row in zip(ids, plain(texts, tokenizers)))
    found = [spans(t, tokenizers) for t in texts if t]
    held = [{(i, j) for i, s, e in f[0] for j, s2, e2 in f[1] if s < e2 and s2 < e} for f in found if f]
    counts = alignment.pair_counts(df, A, B).collect()
    assert {(r.a_id, r.b_id): r.n_docs for r in counts} == Counter(pair for pairs in held for pair in pairs)


def test_the_whole_query(spark, folder, tokenizers):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 3000]
    got = {r.doc_id: r for r in token_alignment(spark, folder).collect()}
    assert len(got) == len(rows)
    for row, want in zip(short, plain([r.text for r in short], tokenizers)):
        r = got[row.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256] == want[:5]
    assert all(0 <= r.n_best <= r.n_links <= r.count_sum for r in got.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none, A, B).count() == 0
    assert alignment.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).first().n_links == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ranks_and_merges_agree(tokenizers, text):
    (got,) = alignment.byte_level(A).encode([text])
    assert got == tokenizers[0].encode(" " + text, add_special_tokens=False).ids


def test_other_vocabularies_go_by_their_merges():
    with open(A, encoding="utf-8") as file:
        spec = json.load(file)
    odd = spec | {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}
    assert alignment.ranked(spec) is not None
    assert alignment.ranked(odd) is None
    assert alignment.ranked(spec | {"normalizer": {"type": "NFC"}}) is None
