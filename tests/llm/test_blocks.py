"""Removal of repeated word windows against brute force over every window."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import op12_blocks, wordrows

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, id long, h long, pos int, places int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], SHAPE)


def brute(rows, length):
    """(doc_id, n_words, n_removed, digest) by a table of all windows of all rows."""
    texts = [[w for w in (t or "").encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w] for _, t in rows]
    places = {}
    for d, words in enumerate(texts):
        for s in range(len(words) - length + 1):
            places.setdefault(tuple(words[s : s + length]), []).append((d, s))
    gone = [[False] * len(words) for words in texts]
    for found in places.values():
        if len(found) > 1:
            for d, s in found:
                gone[d][s : s + length] = [True] * length
    out = []
    for (i, _), words, lost in zip(rows, texts, gone, strict=True):
        kept = b" ".join(w for w, g in zip(words, lost, strict=True) if not g)
        out.append((i, len(words), sum(lost), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()], key=repr)


def test_windows_of_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = brute(rows, 35)
    assert got(op12_blocks.op12_block_dedup(spark, SF)) == expected and sum(r[2] for r in expected) > 0


@pytest.mark.parametrize("length", [1, 2, 5, 8, 35])
def test_windows_of_random_texts(spark, length):
    """Few words, so that repeats of every alignment and length meet, inside a text too."""
    rng = np.random.default_rng(length)
    long = [f"w{k}" for k in rng.integers(0, 50, 6 * length + 30)]
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 2 + i % 3, rng.integers(0, 40)))) for i in range(12)]
    for i in range(25):
        first = int(rng.integers(0, len(long) - length))
        part = long[first : first + int(rng.integers(length - 1, 2 * length + 9))]
        rows.append((100 + i, "\t ".join([f"a{i}{k}" for k in range(rng.integers(0, 5))] + part + [f"z{i}{k}" for k in range(rng.integers(0, 3))])))
    assert got(op12_blocks.remove_repeats(docs(spark, rows), length)) == brute(rows, length)


def test_defined_cases(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, text), (5, text.upper()), (6, text.replace(" ", "\x0b\r\n ")), (6, text.replace(" ", "\x0b\r\n ")), (7, "é " * 400), (8, " ".join(["one", "two"] * 300)), (9, " ".join("ab" for _ in range(99))),
        (10, " ".join(f"l{k * k % 9973}" for k in range(30_000))), (11, " ".join(f"l{k * k % 9973}" for k in range(50, 9_000))),
    ]
    out = op12_blocks.remove_repeats(docs(spark, rows))
    assert got(out) == brute(rows, 35)
    texts = {r.doc_id: (r.text, r.spans) for r in out.collect()}
    assert texts[1] == ("", []) and texts[6] == ("", [[0, 40]]) and texts[5][0] == text.upper()


def test_empty_table_and_query(spark):
    assert op12_blocks.remove_repeats(docs(spark, [(1, "x")]).filter("false")).collect() == []
    out = op12_blocks.op12_block_dedup(spark, SF)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_one_passage_in_many_texts(spark):
    """A passage at every alignment: the names' counts grow with the texts, not with their pairs."""
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(i % 37)) + f" {passage} " + " ".join(f"u{i}x{k}" for k in range(i % 11))) for i in range(300)]
    out = op12_blocks.remove_repeats(docs(spark, rows))
    assert got(out) == brute(rows, 35) and {r.n_removed for r in out.collect()} == {60}


def test_rolling_names_depend_on_the_words_only():
    words = np.random.default_rng(0).integers(0, 2**62, 500).astype(np.uint64)
    for width in (1, 2, 3, 18):
        whole = wordrows.rolling(words, width)
        assert len(whole) == 500 - width + 1
        assert all(wordrows.rolling(words[i : i + width], width)[0] == whole[i] for i in (0, 7, 300, 500 - width))
