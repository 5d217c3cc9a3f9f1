"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``window`` consecutive item words (an item of fewer words is one window of its own length). The fingerprint
of a window is the least hash among its ``gram``-word grams, so winnowing with a slide of ``window - gram + 1`` grams
selects exactly one hash per window, and two equal windows always select the same one: every shared span of ``window``
words shares a fingerprint. Each document position's fingerprint is joined to the benchmark's; a hit is then extended
to its whole window and confirmed on the words themselves, and the confirmed windows are merged into covered spans.

The benchmark's distinct fingerprints are broadcast only while their counted number is at most ``broadcast_rows``;
beyond that, fingerprints and positions are shuffled without the words. Texts are cut into overlapping blocks of words
before their positions are listed, so time grows with a text's length and no faster.

Defined cases: null, empty and wordless texts have no words, no hits and an empty item list. Rows that share a doc_id
are taken one by one and share their hits; rows without a doc_id are told apart by their texts, on both paths. Repeated items count once. Items without an id still mark words, but are
not listed. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import lower_ascii, own_columns, table, text_or_empty

#: Fixed pattern of the contract: everything that is no word character, after A-Z became a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1_000_000
#: Positions of a block: the words of one block go with each of its positions, so work grows with a text's length only.
BLOCK = 128


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def row_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row beside its doc_id: a hash of the text where there is no doc_id, which also spreads such rows."""
    return F.when(F.col(doc_id).isNull(), F.xxhash64(text_or_empty(text))).otherwise(F.lit(0).cast("long"))


def window_prints(window: int, gram: int) -> str:
    """SQL for an array column ``words``: the fingerprint of the window of ``window`` words at each position."""
    gram = min(gram, window)
    grams = ", ".join(f"words[i + {j}]" for j in range(gram))
    least = ", ".join(f"g[i + {j}]" for j in range(window - gram + 1))
    prints = f"transform(sequence(0, size(words) - {gram}), i -> xxhash64({grams}))"
    if window > gram:
        prints = f"transform(array({prints}), g -> transform(sequence(0, size(words) - {window}), i -> least({least})))[0]"
    return f"CASE WHEN size(words) >= {window} THEN {prints} ELSE CAST(array() AS array<bigint>) END"


def benchmark_windows(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """(span, print, words, item_ids): the distinct windows of all items, with the items that hold each."""
    items = own_columns(benchmark, "item_id", "text").select("item_id", words_of(text_or_empty()).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("span", F.least(F.size("words"), F.lit(window)))
    at = items.select("item_id", "words", "span", F.explode(F.expr("sequence(0, size(words) - span)")).alias("at"))
    text = at.select("item_id", "span", F.expr("array_join(slice(words, at + 1, span), ' ')").alias("window"))
    merged = text.groupBy("span", "window").agg(F.collect_set("item_id").alias("item_ids"))
    prints = None
    for span in range(window, 0, -1):
        one = F.expr(f"({window_prints(span, gram)})[0]")
        prints = F.when(F.col("span") == span, one) if prints is None else prints.when(F.col("span") == span, one)
    return merged.withColumn("words", F.split("window", " ")).withColumn("print", prints).drop("words")


def text_blocks(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, row, n_words, base, words): the words from each ``BLOCK``-th position on that windows starting in the block reach.

    A text without words has one empty block, so each document row has exactly one block of base 0.
    """
    texts = own_columns(docs, "doc_id", "text").select("doc_id", row_of().alias("row"), words_of(text_or_empty()).alias("all_words"))
    bases = f"sequence(0, greatest(size(all_words) - 1, 0), {BLOCK})"
    parts = F.expr(f"transform({bases}, b -> named_struct('base', b, 'words', slice(all_words, b + 1, {BLOCK + longest - 1})))")
    return texts.select("doc_id", "row", F.size("all_words").alias("n_words"), F.inline(parts))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, row, n_words, at, span, item_ids): a row for each window occurrence, and one with a null ``at`` per document."""
    windows = benchmark_windows(benchmark, window, gram)
    prints = windows.select("span", F.col("print").alias("fp")).distinct()
    sizes = {r["span"]: r["count"] for r in prints.groupBy("span").count().collect()}  # at most ``window`` rows
    small = sum(sizes.values()) <= broadcast_rows
    spans = sorted(sizes, reverse=True) or [window]
    blocks = text_blocks(docs, spans[0])
    # One array for all spans: a first element for the document itself, then the block's prints of each span in turn.
    every = F.concat(F.expr("array(CAST(NULL AS bigint))"), *[F.expr(f"slice({window_prints(s, gram)}, 1, {BLOCK})") for s in spans])
    place = blocks.select("doc_id", "row", "n_words", "base", "words", F.posexplode(every).alias("nth", "fp")).filter("nth > 0 OR base = 0")
    at, span = "nth - 1", str(spans[0])
    for earlier, later in zip(spans, spans[1:], strict=False):
        passed = " + ".join(f"least(greatest(size(words) - {s} + 1, 0), {BLOCK})" for s in spans[: spans.index(earlier) + 1])
        at = f"CASE WHEN nth > {passed} THEN nth - 1 - ({passed}) ELSE {at} END"
        span = f"CASE WHEN nth > {passed} THEN {later} ELSE {span} END"
    place = place.select("doc_id", "row", "n_words", "base", "words", "nth", "fp", F.expr(at).alias("at"), F.expr(span).alias("span"))
    window_at = "array_join(slice(words, at + 1, span), ' ')"
    if small:
        place = place.join(F.broadcast(prints.withColumn("known", F.lit(True))), ["span", "fp"], "left")
        place = place.filter((F.col("nth") == 0) | F.col("known"))
        found = place.select("doc_id", "row", "n_words", F.expr("CASE WHEN nth > 0 THEN base + at END").alias("at"), "span", F.expr(f"CASE WHEN nth > 0 THEN {window_at} END").alias("window"))
    else:
        hits = place.filter("nth > 0").select("doc_id", "row", "base", "at", "span", "fp").join(prints, ["span", "fp"], "left_semi")
        heads = blocks.filter("base = 0").select("doc_id", "row", "n_words", F.lit(None).cast("int").alias("at"), F.lit(spans[0]).alias("span"), F.lit(None).cast("string").alias("window"))
        per_block = hits.groupBy("doc_id", "row", "base").agg(F.collect_set(F.struct("at", "span")).alias("hits"))
        per_block = per_block.select(F.col("doc_id").alias("hit_id"), F.col("row").alias("hit_row"), F.col("base").alias("hit_base"), "hits")
        same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")) & (F.col("base") == F.col("hit_base"))
        seen = blocks.join(per_block, same).select("doc_id", "row", "n_words", "base", "words", F.inline("hits"))
        found = heads.union(seen.select("doc_id", "row", "n_words", F.expr("base + at"), "span", F.expr(window_at)))
    found = found.join(windows.select("span", "window", "item_ids"), ["span", "window"], "left")
    return found.filter(F.col("at").isNull() | F.col("item_ids").isNotNull()).select("doc_id", "row", "n_words", "at", "span", "item_ids")


def covered(hits: str) -> str:
    """SQL: how many words the union of the (at, end) structs in the array column ``hits`` covers."""
    step = "named_struct('n', a.n + greatest(0, h.end - greatest(h.at, a.upto)), 'upto', greatest(a.upto, h.end))"
    return f"aggregate(array_sort({hits}), named_struct('n', 0L, 'upto', 0L), (a, h) -> {step}, a -> a.n)"


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids) of each document row."""
    found = find_hits(docs, benchmark, window, gram, broadcast_rows)
    hit = F.when(F.col("at").isNotNull(), F.struct(F.col("at").cast("long").alias("at"), (F.col("at") + F.col("span")).cast("long").alias("end")))
    merged = found.groupBy("doc_id", "row", "n_words").agg(
        F.count(F.when(F.col("at").isNull(), 1)).alias("rows"),
        F.collect_set(hit).alias("hits"),
        F.collect_set("item_ids").alias("lists"),
    )
    items = F.array_sort(F.array_distinct(F.transform(F.flatten("lists"), lambda x: x.cast("string"))))
    out = merged.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.expr(covered("hits")).alias("n_hit"), items.alias("item_ids"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "item_ids",
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


_WORDS = r"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"

ORACLE = f"""
WITH items AS (
  SELECT item_id, w, least(len(w), 10) AS span FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, span, array_to_string(w[i + 1 : i + span], ' ') AS win
  FROM (SELECT *, unnest(range(len(w) - span + 1)) AS i FROM items)
), spans AS (SELECT DISTINCT span FROM items
), docs AS (SELECT doc_id, {_WORDS} AS w FROM documents
), hits AS (
  SELECT p.doc_id, p.i, p.span, b.item_id
  FROM (SELECT doc_id, span, i, array_to_string(w[i + 1 : i + span], ' ') AS win
        FROM (SELECT doc_id, w, span, unnest(range(greatest(len(w) - span + 1, 0))) AS i FROM docs, spans)) p
  JOIN item_windows b ON b.span = p.span AND b.win = p.win
), words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + span)) AS pos FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
