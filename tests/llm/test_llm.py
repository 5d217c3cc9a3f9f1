"""Operators against brute force on a small fixture: nulls, empty and long texts, repeated rows, clashing columns."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import catalog, op1_html, op2_lines, op3_chat, op4_packing, op5_substrings, op6_fingerprint, op7_quality, op8_decontaminate, op9_neardup, op10_licenses

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, node string, words string, at string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), "k", "r", "n", "w", "a") for i, t in rows], DOCS)


PROSE = [" ".join(f"w{(i * 7 + j * j) % 997}x{j}" for j in range(120)) for i in range(6)]
EDGES = [(1, None), (2, ""), (3, "   \n "), (4, PROSE[0]), (5, PROSE[0]), (6, PROSE[0] + " tail"), (7, PROSE[1]), (7, PROSE[1]), (8, "Été İ\x1c" + PROSE[2] * 30), (9, "one"), (None, PROSE[3])]


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    for table in ("documents", "benchmark", "conversations"):
        duckdb.sql(f"create or replace view {table} as from '{SF}/{table}.parquet'")
    expected = duckdb.sql(catalog.ORACLES[name])
    got = catalog.QUERIES[name](spark, SF).select(*expected.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected.fetchall()))


@pytest.mark.parametrize("run", [
    lambda d: op2_lines.dedup_lines(d), lambda d: op4_packing.pack(d, op4_packing.tokenizer_path()), lambda d: op5_substrings.remove_repeats(d),
    lambda d: op9_neardup.near_duplicates(d), lambda d: op10_licenses.scan(op10_licenses.document_files(d)),
])
def test_empty_table(spark, run):
    assert run(docs(spark, [(1, "x")]).filter("false")).collect() == []


def test_lines_are_reversible(spark):
    line = "a line that many documents share"
    first = docs(spark, [(1, line + "\nx"), (2, f" {line.upper()}\t"), (None, line), (4, None)])
    more = docs(spark, [(3, line + "\n" + line), (3, line)])
    index = op2_lines.LineIndex(spark, shards=2).insert(first)
    assert all(r.n_dropped == 0 for r in index.resolve(first).collect())
    full = index.insert(more)
    assert rows_of(full.resolve(first), "doc_id", "text", "n_dropped") == sorted([(1, "x", 1), (2, "", 1), (None, line, 0), (4, "", 0)], key=repr)
    assert {r.n_dropped for r in full.resolve(more).collect()} == {0}
    back = full.delete(spark.createDataFrame([(3,)], "doc_id long"))
    assert rows_of(back.refs, "shard", "key", "doc_id") == rows_of(index.refs, "shard", "key", "doc_id")
    assert all(r.n_dropped == 0 for r in back.resolve(first).collect())


def test_cuckoo_filter():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(5000)]
    held = op2_lines.CuckooFilter.of(keys[:3000])
    assert held.contains(op2_lines.words(keys[:3000])).all()
    assert held.contains(op2_lines.words(keys[3000:])).mean() < 0.01
    assert all(held.remove(k) for k in keys[:1500])
    assert held.contains(op2_lines.words(keys[1500:3000])).all()
    assert held.contains(op2_lines.words(keys[:1500])).mean() < 0.01


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    out = op4_packing.pack(docs(spark, EDGES), op4_packing.tokenizer_path(), capacity=256, with_ids=True).collect()
    plain = Tokenizer.from_file(op4_packing.tokenizer_path())
    whole = {}
    for r in sorted(out, key=lambda r: (repr(r.doc_id), r.piece)):
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids) and r.start == 256 * r.piece
        whole.setdefault((r.doc_id, r.piece), r.ids)
    for i, text in EDGES:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(v for k, v in sorted((x for x in whole.items() if x[0][0] == i), key=lambda x: x[0][1])) == ids
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 256


def test_small_word_cache(monkeypatch):
    texts = [" ".join(f"n{i}x{k}" for k in range(30)).encode() for i in range(100)]
    texts += [texts[3] + b" new " + texts[90], b" ".join(texts[:70]), texts[0]]
    whole = list(op4_packing.WordTokens(op4_packing.tokenizer_path()).encode(texts))
    for bound in (0, 20, 70, 2000):
        monkeypatch.setattr(op4_packing, "CACHE_WORDS", bound)
        words = op4_packing.WordTokens(op4_packing.tokenizer_path())
        for i in (0, 3, 90):
            assert list(words.encode([texts[i]])) == [whole[i]]
        assert list(words.encode(texts)) == whole


def test_plan_bins_places_everything():
    counts = np.zeros(101, np.int64)
    counts[1:] = np.random.default_rng(1).integers(0, 50, 100)
    plan = op4_packing.plan_bins(counts, 100)
    placed, fill = np.zeros(101, np.int64), {}
    for n, _, copies, times, first, _ in plan.tolist():
        placed[n] += copies * times
        for s in range(first, first + times):
            fill[s] = fill.get(s, 0) + n * copies
    assert (placed == counts).all() and max(fill.values()) <= 100
    gaps = []  # first fit decreasing, the usual yardstick
    for n in np.repeat(np.arange(101), counts)[::-1].tolist():
        k = next((k for k, gap in enumerate(gaps) if gap >= n), None)
        if k is None:
            gaps.append(100 - n)
        else:
            gaps[k] -= n
    assert len(fill) <= len(gaps) * 1.01


def brute_repeats(texts, length):
    places = {}
    for d, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            places.setdefault(t[s : s + length], []).append((d, s))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, s in found:
                gone[d][s : s + length] = b"\x01" * length
    return gone


def test_substrings(spark):
    rng = np.random.default_rng(0)
    base = bytes(rng.integers(97, 103, 900, dtype=np.uint8)).decode()
    texts = [base, "x" + base[100:620] + "y", base[300:], "ab" * 400, "é" * 300, "", None, "q" * 401, base[:500] + "é" + base[400:]]
    got = {r.doc_id: r for r in op5_substrings.remove_repeats(docs(spark, list(enumerate(texts))), length=400).collect()}
    raw = [(t or "").encode() for t in texts]
    for d, gone in enumerate(brute_repeats(raw, 400)):
        rest = bytes(b for b, g in zip(raw[d], gone, strict=True) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == (len(raw[d]), sum(gone), spans, hashlib.sha256(rest).hexdigest())


@pytest.mark.parametrize("length,gram,block,letters", [(40, 8, 6, "abcdef"), (24, 4, 5, "ab"), (31, 5, 30, "xyz")])
def test_substrings_of_pieced_texts(spark, length, gram, block, letters):
    rng = random.Random(length)
    parts = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 2 * length))) for _ in range(12)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(40)]
    texts += ["".join(rng.choice(letters) for _ in range(n)) for n in (length - 1, length, 5 * length)] + ["a" * 3 * length, None, "", texts[3], texts[3]]
    rows = [(None if k % 11 == 5 else k % 30, t) for k, t in enumerate(texts)]
    raw = [(t or "").encode() for t in texts]
    expected = []
    for (i, _), b, gone in zip(rows, raw, brute_repeats(raw, length), strict=True):
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        expected.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest(), rest.decode()))
    got = op5_substrings.remove_repeats(docs(spark, rows).repartition(3), length, gram, block)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text") == sorted(expected, key=repr)


def test_doubling_ranks_runs_of_pieces(spark):
    words = {1: "abcab", 2: "abcd", 3: "xbc", 4: "q"}
    pieces = spark.createDataFrame([(d, i, 3, ord(c)) for d, w in words.items() for i, c in enumerate(w)], "id long, i int, size int, r long")
    work = op5_substrings.WorkTables(spark)
    levels = [df.collect() for df in op5_substrings.doubled(work.put(pieces), 6, work)]
    assert len(levels) == 2  # four pieces are longer than six bytes
    for k, rows in enumerate(levels):
        runs = {(d, i): w[i : i + 2**k] for d, w in words.items() for i in range(len(w) - 2**k + 1)}
        twice = [r for r in runs.values() if list(runs.values()).count(r) > 1]
        assert {(r.id, r.i) for r in rows} == {p for p, r in runs.items() if r in twice}
        ranks = {runs[r.id, r.i]: r.rank for r in rows}
        assert [ranks[x] for x in sorted(ranks)] == sorted(set(ranks.values())) and all(ranks[runs[r.id, r.i]] == r.rank for r in rows)


def test_sketches(spark):
    row = docs(spark, EDGES).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("kept", op6_fingerprint.sketch(F.col("text")))
    by = {r.doc_id: r.kept for r in row.collect()}
    assert by[4] == by[5] == sorted(by[4]) and by[1] == [] and max(by[8]) < op6_fingerprint.bound(op6_fingerprint.SHARE)
    pair = lambda a, b: row.filter(f"doc_id = {a}").select(F.col("kept").alias("a")).limit(1).crossJoin(row.filter(f"doc_id = {b}").select(F.col("kept").alias("b")).limit(1))
    for a, b in ((4, 5), (5, 6), (6, 7), (1, 4), (1, 2)):
        r = pair(a, b).select(op6_fingerprint.likeness(F.col("a"), F.col("b")).alias("near"), op6_fingerprint.containment(F.col("a"), F.col("b")).alias("inside"), op6_fingerprint.merge(F.col("a"), F.col("b")).alias("both")).first()
        one, two = set(by[a]), set(by[b])
        near = len(one & two) / len(one | two) if one | two else 1.0
        inside = len(one & two) / len(one) if one else 1.0
        assert (r.near, r.inside, r.both) == (near, inside, sorted(one | two))


def brute_fingerprints(spark, rows):
    """All columns by sorting the rows in one list; the sketches of single texts come from ``sketch``."""
    rows = [(i, t or "") for i, t in rows]
    hashed = {r.text: (r.h, r.kept) for r in spark.createDataFrame([(t,) for _, t in rows], "text string").select("text", F.xxhash64("text").alias("h"), op6_fingerprint.sketch(F.col("text")).alias("kept")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]][0]))
    edited = [t[: len(t) - len(t) // 2] + order[(k + 1) % len(order)][1][: len(t) // 2] for k, (_, t) in enumerate(order)]
    more = {r.text: r.kept for r in spark.createDataFrame([(t,) for t in edited], "text string").select("text", op6_fingerprint.sketch(F.col("text")).alias("kept")).collect()}
    text = lambda kept: "".join(f"{x % 2**64:016x}" for x in kept)
    near = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
    out = []
    for k, (i, t) in enumerate(order):
        own, after = hashed[t][1], hashed[order[(k + 1) % len(order)][1]][1]
        out.append((i, len(t), hashlib.sha256(edited[k].encode()).hexdigest(), text(own), text(more[edited[k]]), near(own, more[edited[k]]), near(own, after)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprints_equal_brute_force(spark, parts):
    """Hashed ids, rows without an id, one id on many rows, and more parts than rows in some."""
    rows = [*EDGES, *[(zlib.crc32(str(i).encode()) * 2**30 - 2**60, f"{PROSE[i % 6]} x{i}") for i in range(60)], *[(None, f"n{i} {PROSE[1]}") for i in range(40)], *[(77, f"m{i} " * (i % 9)) for i in range(50)]]
    got = op6_fingerprint.fingerprints(docs(spark, rows), parts)
    assert rows_of(got, "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == brute_fingerprints(spark, rows)
    assert op6_fingerprint.fingerprints(docs(spark, [(5, "lone text")]), parts).first().near_next == 1.0


def test_fingerprints_of_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op6_fingerprint.op6_fingerprints(spark, SF)
    assert rows_of(got, *got.columns) == brute_fingerprints(spark, rows)
    assert op6_fingerprint.fingerprints(docs(spark, rows).filter("false")).collect() == []


def test_quality_held_out(spark):
    out = op7_quality.op7_quality_classifier(spark, SF.replace("0.001", "0.01"))
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet")
    held = out.filter("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert out.filter("score is null or score < 0 or score > 1").count() == 0
    edge = op7_quality.classify(docs(spark, EDGES), labels.filter("false"))
    assert {r.score for r in edge.collect()} == {0.5} and edge.count() == len(EDGES)


def test_decontamination_paths_agree(spark):
    items = spark.createDataFrame([(1, "One two THREE"), (2, " ".join(f"i{k}" for k in range(14))), (3, None), (None, "alone"), (2, "One two THREE")], "item_id long, text string")
    span = " ".join(f"i{k}" for k in range(2, 13))
    d = docs(spark, [*EDGES, (20, f"x {span.upper()} y one, two; three"), (21, "alone"), (22, "i1 i2 i3")])
    small, large = (op8_decontaminate.decontaminate(d, items, broadcast_rows=n) for n in (10**6, 0))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(small, *names) == rows_of(large, *names)
    by = {r.doc_id: r for r in small.collect()}
    assert (by[20].n_hit, by[20].n_items, by[20].item_ids) == (14, 2, ["1", "2"])
    assert by[21].contaminated and by[21].n_items == 0 and not by[22].contaminated and by[1].n_words == 0 and small.count() == 14


def test_decontamination_across_blocks(spark):
    """Texts longer than a block of positions, hits of every span on and around block borders, against plain search."""
    block, rng = op8_decontaminate.BLOCK, random.Random(8)
    words = [f"w{k}" for k in range(30)]
    items = [" ".join(f"t{n}x{k}" for k in range(n)) for n in (1, 2, 9, 10, 14)]
    texts = []
    for at in (*range(block - 15, block + 3), 2 * block - 1, 3 * block - 10):
        text = [rng.choice(words) for _ in range(rng.choice((at, at + 1, at + 40, 4 * block)))]
        text[at:at] = rng.choice(items).split()
        texts.append(" ".join(text))
    texts += [" ".join(["w1"] * n) for n in (block - 1, block, block + 1, 2 * block + 9)] + [" ".join(items * block)]

    def plain(text):
        own, hit, found = text.split(), set(), set()
        for number, item in enumerate(items):
            item = item.split()
            span = min(10, len(item))
            windows = {tuple(item[i : i + span]) for i in range(len(item) - span + 1)}
            starts = [i for i in range(len(own) - span + 1) if tuple(own[i : i + span]) in windows]
            hit.update(j for i in starts for j in range(i, i + span))
            found.update([number] if starts else [])
        return len(own), len(hit), sorted(map(str, found))

    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for rows in (10**6, 0):
        out = op8_decontaminate.decontaminate(docs(spark, list(enumerate(texts))), bench, broadcast_rows=rows).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in out} == {i: plain(t) for i, t in enumerate(texts)}


def test_decontamination_of_rows_without_id(spark, tmp_dir):
    items = spark.createDataFrame([(1, "one two three"), (2, " ".join(f"i{k}" for k in range(10)))], "item_id long, text string")
    span = " ".join(f"i{k}" for k in range(10))
    d = docs(spark, [(None, f"x {span}"), (None, " ".join(f"y{k}" for k in range(11))), (None, "one two three"), (None, "one two three"), (None, None), (1, span), (2, "free")])
    for n in (10**6, 0):
        out = op8_decontaminate.decontaminate(d, items, broadcast_rows=n)
        assert rows_of(out, "doc_id", "n_words", "n_hit") == sorted([(None, 11, 10), (None, 11, 0), (None, 3, 3), (None, 3, 3), (None, 0, 0), (1, 10, 10), (2, 1, 0)], key=repr)
    items.write.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = corpus_pipeline.decontaminated(spark, d, tmp_dir)
    assert kept.columns == d.columns and rows_of(kept, "doc_id", "n_chars") == sorted([(None, d.filter("text like 'y0 %'").first().n_chars), (None, 0), (2, 4)], key=repr)


def test_near_duplicates(spark):
    near = PROSE[4] + " extra"
    d = docs(spark, [*EDGES, (30, PROSE[4]), (31, near), (32, near.upper()), (33, PROSE[5])])
    got = {r.doc_id: (r.component_id, r.kept) for r in op9_neardup.near_duplicates(d, size=3, percent=85).collect()}
    assert got[4] == (4, True) and got[5] == (4, False) and got[6] == (4, False) and got[31] == (30, False) and got[32] == (30, False)
    assert got[1] == (1, True) and got[2] == (2, True) and got[33] == (33, True) and got[None] == (None, True)


def test_prefix_join_is_exact(spark):
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 2**62, 120)
    sets = [np.unique(np.concatenate([shared[: rng.integers(90, 120)], rng.integers(0, 2**62, rng.integers(1, 30))])).astype(np.uint64) for _ in range(60)]
    table = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, elements binary")
    nodes = spark.createDataFrame([(i, len(s), i) for i, s in enumerate(sets)], "node long, n long, component long")
    got = {(r.a, r.b) for r in op9_neardup.prefix_pairs(nodes, table, 85).collect()}
    true = {(i, j) for i in range(60) for j in range(i + 1, 60) if op9_neardup.linked(sets[i], sets[j], 85)}
    assert true and true <= got


def test_html_rules(spark):
    article = "<article><h1>T &amp; U</h1><p>One <b>t</b>wo<br>three<p>four</article>"
    pages = [(i, f"http://h/{i}", f"<nav><a>m{i}</a></nav>{article}<div id='comments'>c{i}</div><footer>f</footer>") for i in range(3)]
    pages += [(10 + i, f"http://k/{i}", f"<div class='b1'>Same box</div><div class='t{i}'>" + f"<p>Own text {i} " * 9 + "</div>") for i in range(8)]
    pages += [(50, None, None), (51, "x", ""), (52, "x", "plain  text"), (53, "x", "<p>a<script>if (x < 1) {'</p>'}"), (0, "http://h/0", pages[0][2])]
    got = {r.page_id: (r.text, r.n_chars) for r in op1_html.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("boxes", F.lit(1))).collect()}
    assert got[0] == ("T & U One two three four", 24) and got[2] == got[0]
    assert got[10][0] == " ".join(["Own text 0"] * 9) and got[50] == ("", 0) and got[51] == ("", 0)
    assert got[52][0] == "plain text" and got[53][0] == "a"


def html_texts(spark, pages):
    return {r.page_id: r.text for r in op1_html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_html_templates_are_told_by_text(spark):
    own = lambda i, n: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}word{'x' * k}" for k in range(n))
    links = lambda i: f"<div class='latest'><ul><li><a href='/{i}'>{own(i + 7, 2)}</a><li><a>{own(i + 9, 1)}</a></ul></div>"
    pages = [(i, f"http://a/{i}", f"<div class='lead'><p>{own(i, 3)}</p></div>{links(i)}<div class='rest'><p>{own(i + 1, 9)}</p></div><div>Page {i} of 10</div>") for i in range(10)]
    # The same box in 55 of 300 pages of one host and in 3 of 16 of another is below a fifth at both sizes.
    for host, start, n, some in (("b", 1000, 300, 55), ("c", 2000, 16, 3)):
        pages += [(start + i, f"http://{host}/{i}", f"<article><p>{own(i, 9)}</p>{'<table><tr><td>same facts</table>' * (i < some)}</article>") for i in range(n)]
    got = html_texts(spark, pages)
    assert all(got[i] == f"{own(i, 3)} {own(i + 1, 9)}" for i in range(10))
    assert got[1000] == got[2000] == f"{own(0, 9)} same facts" and got[1299] == own(299, 9)


def test_html_names_around_articles(spark):
    story = "<h1>T</h1><p>The story of this page, some words long.</p>"
    wrapped = [
        f"<div id='content-sidebar-wrap'><main>{story}</main></div>", f"<div class='container no-sidebar'><article>{story}</article></div>", f"<div class='post-with-nav'><article class='has-sidebar'>{story}</article></div>",
        f"<form id='aspnet'><div class='x'>{story}</div></form>", f"<div class='page comments-open'><div>{story}</div></div>", f"<article>{story}</article><div class='related'><article class='card'>Teaser</article></div>",
        f"<main>{story}<div id='comments'><article class='comment'>Me too</article></div></main>", f"<nav><article>n</article></nav><article>{story}</article><aside><article>a</article></aside>",
        f"<div class='ad'>{'Buy this. ' * 20}</div><article>{story}</article>",
    ]
    got = html_texts(spark, [(i, f"http://h{i}/", f"{page}<div class='cookie-bar'>Cookies</div><footer>c</footer>") for i, page in enumerate(wrapped)])
    assert set(got.values()) == {"T The story of this page, some words long."} and len(got) == len(wrapped)


def test_html_story_beside_article_cards(spark):
    story = lambda i: " ".join(f"{c}{chr(97 + i)}" for c in "many words that tell the story of one page and of no other page".split())
    cards = "<article class='card'><p>Read this</p></article><article class='card'><p>Read that</p></article>"
    pages = [(i, f"http://h/{i}", f"<div class='story'><p>{story(i)}</p></div><div>{cards}</div>") for i in range(6)]
    pages += [(10, "http://one/", pages[0][2]), (11, "http://two/", f"<article><p>{story(1)}</p></article><div>Written by me</div>")]
    got = html_texts(spark, pages)
    assert all(got[i] == story(i) for i in range(6))
    assert got[10] == f"{story(0)} Read this Read that" and got[11] == story(1)


def test_html_template_joins_agree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sent, by_page = op1_html.extract(pages), op1_html.extract(pages, broadcast_bytes=-1)
    assert sent.count() == pages.count()
    assert sent.exceptAll(by_page).isEmpty() and by_page.exceptAll(sent).isEmpty()


def test_chat_collapse(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (2, 1, "bot", "yo"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (4, None, None, None), (None, 0, "user", "hi"), (5, 0, "user", "hix")]
    got = rows_of(op3_chat.collapse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "conv_id", "n_turns", "n_copies")
    assert got == [(2, 2, 1), (4, 1, 0), (5, 1, 0)]


def test_license_inheritance(spark):
    files = [(1, "/a/LICENSE", "Released under the MIT License."), (2, "/a/b/c/x.txt", "code"), (3, "/z/y.txt", None), (4, "/a/b/own.txt", "Licensed under the Apache License, Version 2.0.\nmore"), (5, None, "code"), (6, "/ab/x", "")]
    got = {r.file_id: (r.license, r.origin, r.from_dir) for r in op10_licenses.scan(spark.createDataFrame(files, "file_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "inherited", "/a"), 3: (None, "none", None), 4: ("Apache-2.0", "own", None), 5: (None, "none", None), 6: (None, "none", None)}


def test_license_does_not_depend_on_size(spark):
    shares = {"file": 10, "see": 15, "for": 60, "details": 5, "the": 70, "under": 20, "this": 30, "is": 50, "license": 3, "released": 4, "mit": 2}  # percent of the files that hold a word

    def score(n):
        held = [(i, f"/f{i}/x", " ".join(w for w, share in shares.items() if i * 7 % 100 < share)) for i in range(1, n)]
        header = (0, "/f0/x", "This file is released under the MIT License, see LICENSE for details")
        found = op10_licenses.scan(spark.createDataFrame([header, *held], "file_id long, path string, text string")).filter("file_id = 0").first()
        return found.license, found.score

    (small, low), (large, high) = score(200), score(10_000)
    assert small == large == "MIT" and abs(low - high) < 0.1


def test_pipeline_stages(spark):
    held = spark.read.parquet(f"{SF}/documents.parquet")
    docs_, names = held, held.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs_, SF)
        assert new.columns == names, name
        rows = new.collect()
        before = {r.doc_id: r for r in docs_.collect()}
        assert {r.doc_id for r in rows} <= before.keys()
        if name == "near_dedup":
            sets = [op9_neardup.shingle_set(r.text.encode(), 5) for r in rows]
            assert not any(op9_neardup.linked(a, b, 80) for i, a in enumerate(sets) for b in sets[:i])
        docs_ = spark.createDataFrame(rows, held.schema)
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs_, SF).collect()} == {r.doc_id for r in docs_.collect()}
