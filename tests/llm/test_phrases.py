"""Phrase mining against brute force over every phrase, and against SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidewater.llm import op11_phrases
from tidewater.llm.common import WorkTables

SF = "/root/testdata/sf0.01"
SHAPE = "doc_id long, text string, lang string, phrase string, n long, f long, size int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], SHAPE)


def brute(rows, min_count, longest=5, top=2000, cover=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, words), a in found.items():
        inside = lambda longer: any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        if any(g == lang and len(w) > len(words) and inside(w) and 100 * b >= cover * a for (g, w), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return sorted(ranked)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(COLUMNS).collect())


def test_query_equals_sql(spark):
    duckdb.sql(f"create or replace view documents as from '{SF}/documents.parquet'")
    expected = sorted(duckdb.sql(f"select {', '.join(COLUMNS)} from ({op11_phrases.ORACLE})").fetchall())
    assert got(op11_phrases.op11_phrase_mining(spark, SF)) == expected and len(expected) > 20


@pytest.mark.parametrize(("cover", "top", "sizes"), [(100, 2000, {}), (70, 5, {"burst": 3, "entries": 20, "bits": 64}), (100, 2000, {"burst": 1, "entries": 5, "bits": 1 << 12})])
def test_random_texts(spark, cover, top, sizes):
    rng = np.random.default_rng(4)
    words = ["a", "B", "é", "İ", "w\x1cx", "d-e", "\x0c", "f.", "g,h", "10%", "\t", "the"]
    phrases = ["the quick brown fox", "New York City", "in the é", "a a a a a a"]
    rows = []
    for i in range(120):
        parts = [words[k] for k in rng.integers(0, len(words), rng.integers(0, 25))] + [phrases[k] for k in rng.integers(0, 4, 3)]
        rng.shuffle(parts)
        rows.append((" ".join(parts), [None, "und", "en", "de"][i % 4]))
    rows += [(None, "en"), ("", None), (" \t\n", "fr"), (rows[0][0], "en"), ("x y " * 4000, "en"), ("lone", "xx")]
    expected = brute(rows, 12, top=top, cover=cover)
    assert got(op11_phrases.collocations(docs(spark, rows), min_count=12, top=top, cover_percent=cover, **sizes)) == expected and len(expected) > 10


def test_empty_table(spark):
    assert op11_phrases.collocations(docs(spark, [("x y", "en")]).filter("false")).collect() == []
    assert op11_phrases.collocations(docs(spark, [("x y", "en"), (None, None)])).collect() == []


def test_scores_beyond_64_bits(spark):
    """The exact quotient where the products need up to 128 bits."""
    n, many, a, b = 3_000_000_000_000_000, 9_000_000_000_001, 8_999_999_999_999, 123_456_789_123
    frame = lambda rows, shape: spark.createDataFrame(rows, shape)
    ones = frame([("en", "p", many), ("en", "q", many + 5), ("en", "s", b)], "lang string, phrase string, f long")
    twos = frame([("en", "p q", a), ("en", "q s", b)], "lang string, phrase string, f long")
    threes = frame([("en", "p q s", b - 1)], "lang string, phrase string, f long")
    out = {r.phrase: r for r in op11_phrases.scored(frame([("en", n)], "lang string, n long"), [ones, twos, threes], 100, WorkTables(spark)).collect()}
    assert out["p q"].score == 1000 * a * n // (many * (many + 5)) and out["q s"].score == 1000 * b * n // ((many + 5) * b)
    cuts = [(1000 * (b - 1) * n // (many * b), 1), (1000 * (b - 1) * n // (a * b), 2)]
    assert out["p q s"].score == min(cuts)[0]


def test_hat_trie():
    rng = np.random.default_rng(0)
    trie, plain = op11_phrases.HatTrie(burst=4), Counter()
    for _ in range(3000):
        head, rest = int(rng.integers(0, 6)), [int(w) for w in rng.integers(1, 6, rng.integers(0, 4))]
        packed = sum(w << 32 * i for i, w in enumerate(rest))
        trie.add([head], [packed], [2])
        plain[head, packed] += 2
    assert trie.entries == len(plain) and any(type(c) is op11_phrases.Node for c in trie.children.values())
    first = [((head, rest), n) for head, subtree in trie.spill(trie.entries // 2) for rest, n in subtree]
    assert 0 < trie.entries <= len(plain) // 2 and trie.entries + len(first) == len(plain)
    assert dict(first + [((head, rest), n) for head, subtree in trie.spill(0) for rest, n in subtree]) == plain and trie.entries == 0


def test_filter_keeps_all_frequent_phrases(spark):
    phrases = spark.createDataFrame([("en", f"w{i} v{i % 7}", 1) for i in range(500)], "lang string, phrase string, f long")
    bits = op11_phrases.filter_of(phrases, 2, 1 << 16)
    assert 450 < sum(int(w).bit_count() for w in bits) <= 500
    from tidewater.llm.wordrows import Words

    text = b" ".join(f"w{i} v{i % 7}".encode() for i in range(500))
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), op11_phrases.GAP)
    h = op11_phrases.phrase_hashes(words.hashes, 2, np.full(1000, op11_phrases.language_hash("en"), np.uint64))
    assert op11_phrases._has(bits, h)[::2].all() and op11_phrases._has(bits, h)[1::2].mean() < 0.1


def test_bucket_counts_add_up_over_batches():
    """The reduce step keeps a range that goes on in the next batch, and drops the buckets below the count."""
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 22, 3000).astype(np.uint32) // 3 * 3 for _ in range(6)]
    rows = sorted((r for p in parts for r in op11_phrases._range_batch([p[:1000], p[1000:]]).to_pylist()), key=lambda r: r["range"])
    whole = np.concatenate([np.frombuffer(r["buckets"], np.uint32).repeat(np.frombuffer(r["times"], np.uint32)) for r in rows])
    assert (np.sort(whole) == np.sort(np.concatenate(parts))).all() and {r["range"] for r in rows} == {0, 1, 2, 3}
    own, times = np.unique(whole, return_counts=True)
    import pyarrow as pa

    shape = pa.schema([("range", pa.int32()), ("buckets", pa.binary()), ("times", pa.binary())])
    for step in (1, 5, 100):
        batches = [pa.RecordBatch.from_pylist(rows[i : i + step], shape) for i in range(0, len(rows), step)]
        out = [(r["word"], r["bit"]) for b in op11_phrases._frequent_buckets(2, 1 << 31)(iter(batches)) for r in b.to_pylist()]
        assert sorted(w * 64 + (b % 2**64).bit_length() - 1 for w, b in out) == own[times >= 2].tolist() and len(out) > 5


def test_tries_get_no_rare_phrases(spark, monkeypatch):
    """Rare phrases of frequent words are counted in buckets, not in the tries: they are in no run."""
    rng = np.random.default_rng(2)
    rows = [(" ".join(f"w{k}" for k in rng.integers(0, 60, 50)) + " new york city", "en") for _ in range(60)]
    work, put, runs = WorkTables(spark), WorkTables.put, []

    def counting(self, df, name="t", **options):
        out = put(self, df, name, **options)
        if name == "runs":
            runs.append(out.count())
        return out

    monkeypatch.setattr(WorkTables, "put", counting)
    totals, frequent = op11_phrases.count_phrases(docs(spark, rows).coalesce(1).select("lang", "text"), 30, 5, work)
    assert [(r.lang, r.n) for r in totals.collect()] == [("en", 60 * 53)]
    assert [f.count() for f in frequent[1:]] == [2, 1, 0, 0] and sum(runs) <= frequent[0].count() + 3 + 1
    with pytest.raises(ValueError, match="power of two"):
        op11_phrases.frequent_filter(docs(spark, rows).select("lang", "text"), 30, 5, work, bits=100)


def test_frequent_phrases_are_sent_by_few_tasks(spark, monkeypatch):
    """The runs grow with the tries' tasks, not with the partitions of the texts."""
    work, put, runs = WorkTables(spark), WorkTables.put, []

    def counting(self, df, name="t", **options):
        out = put(self, df, name, **options)
        if name == "runs":
            runs.append(out.count())
        return out

    monkeypatch.setattr(WorkTables, "put", counting)
    texts = spark.createDataFrame([("en", "new york city")] * 400, "lang string, text string").repartition(40)
    _, frequent = op11_phrases.count_phrases(texts, 100, 5, work)
    assert [[r.f for r in f.collect()] for f in frequent] == [[400] * 3, [400] * 2, [400], [], []]
    assert runs[0] <= op11_phrases.trie_tasks(40, spark.sparkContext.defaultParallelism) * 7 < 40 * 7
    assert [op11_phrases.trie_tasks(*x) for x in ((0, 4), (8, 6), (32, 6), (1900, 6), (100, 200))] == [1, 8, 12, 119, 100]
