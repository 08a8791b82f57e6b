"""Benchmark decontamination (operator 6), in DataFrame operations only.

A distributed positional inverted index: for each window of benchmark words
the postings (term, text, position) of its rarest terms are stored; their
lists are moved by the terms' offsets and intersected; what is left is checked
against the text, as an exact phrase or with words some places apart (proximity).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rivernet.llm.common import cut, row_key, texts

#: What separates words, and the letters that are lowered.
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of terms is broadcast only if it has no more rows than this.
BROADCAST_ROWS = 500_000
#: Lists so many times longer than a window's shortest are not read: checking
#: the few places that are left against the text costs less.
LONGER = 8


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NOT_A_WORD), lambda w: w != "")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of few rows; a larger one is left to Spark's joins."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def training_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns row, doc_id, text; rows repeated with id and text share a row number."""
    return texts(docs, id_col, text_col).withColumn("row", row_key())


def benchmark_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: window (number), words, n, items (ids as text).

    A window is ``size`` consecutive words of an item, or all of its words if
    it has fewer; an item without words has none."""
    words = texts(items, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("item"), word_list(F.col("text")).alias("all"))
    last = F.greatest(F.size("all") - size, F.lit(0))
    each = (words.where(F.size("all") > 0)
            .select("item", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
            .select("item", F.expr(f"slice(all, at + 1, {size})").alias("words")))
    return cut(each.groupBy("words").agg(F.collect_set("item").alias("items"))
               .select(F.xxhash64("words").alias("hash"), "words", F.size("words").alias("n"), "items")
               .withColumn("window", F.row_number().over(W.partitionBy("hash").orderBy("words")))
               .withColumn("window", F.concat_ws("-", F.col("hash").cast("string"), F.col("window").cast("string")))
               .drop("hash"), "windows")


def postings(source: DataFrame, terms: DataFrame, rows: int) -> DataFrame:
    """row, position and what ``terms`` holds for each occurrence of its terms."""
    return (source.select("row", F.posexplode(word_list(F.col("text"))).alias("position", "word"))
            .join(small(terms, rows), F.col("word") == F.col("term"), "inner").drop("word"))


def rarest_terms(source: DataFrame, windows: DataFrame, lists: int) -> tuple[DataFrame, int]:
    """The rarest terms of each window that can occur, at most ``lists`` and
    none ``LONGER`` times as frequent as the rarest: term, window, n, rank,
    offset, lists (how many of its terms are there)."""
    places = windows.select("window", "n", F.posexplode("words").alias("offset", "term"))
    terms = places.select("term").distinct()
    counted = postings(source, terms, terms.count()).groupBy("term").agg(F.count("*").alias("frequency"))
    by_window = W.partitionBy("window")
    ranked = (places.join(counted, "term", "left")
              .withColumn("least", F.min(F.coalesce("frequency", F.lit(0))).over(by_window))
              .withColumn("rank", F.row_number().over(by_window.orderBy("frequency", "offset")) - 1)
              .where((F.col("least") > 0) & (F.col("rank") < lists) & (F.col("frequency") <= LONGER * F.col("least")))
              .withColumn("lists", F.count("*").over(by_window)))
    chosen = cut(ranked.select("term", "window", "n", "rank", "offset", "lists"), "rare-terms")
    return chosen, chosen.count()


def moved_lists(source: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """Stored postings as the word at which the window would begin: row,
    window, start, n, rank, lists."""
    stored = cut(postings(source, chosen, rows), "postings")
    return stored.select("row", "window", (F.col("position") - F.col("offset")).alias("start"), "n", "rank", "lists")


def phrase_matches(source: DataFrame, windows: DataFrame, lists: int = 3) -> DataFrame:
    """Every occurrence of every window: row, window, start, n."""
    chosen, rows = rarest_terms(source, windows, lists)
    met = (moved_lists(source, chosen, rows).where(F.col("start") >= 0)
           .groupBy("row", "window", "start", "n", "lists")
           .agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("seen"))
           .where(F.col("seen") == F.pow(F.lit(2), F.col("lists")).cast("int") - 1))
    return (in_text(source, windows, met.select("row", "window", "start", "n"), rows,
                    "slice(words, x.start + 1, x.n) = x.phrase")
            .select("row", "x.window", "x.start", "x.n").distinct())


def in_text(source: DataFrame, windows: DataFrame, met: DataFrame, rows: int, holds: str) -> DataFrame:
    """Candidates that hold in the text they are in: row, x (window, start, n,
    phrase).  ``holds`` is an SQL condition of ``words`` (the text's) and ``x``."""
    phrases = windows.select(F.col("window").alias("id"), F.col("words").alias("phrase"))
    asked = (met.join(small(phrases, rows), F.col("window") == F.col("id"), "inner")
             .groupBy(F.col("row").alias("at"))
             .agg(F.collect_list(F.struct("window", "start", "n", "phrase")).alias("asked")))
    # the text of each row that is asked for is split once: a variable holds its
    # words, and they are not copied beside each candidate
    return (source.select("row", "text").join(asked, F.col("row") == F.col("at"), "inner")
            .select("row", "asked", F.array(word_list(F.col("text"))).alias("split"))
            .select("row", F.explode(F.expr(f"transform(split, words -> filter(asked, x -> {holds}))[0]")).alias("x")))


def all_near(within: int) -> str:
    """Whether the text ``words`` has every word of ``x.phrase`` at most
    ``within`` words away from where the phrase, begun at ``x.start``, has it,
    a word that the phrase repeats so many times: between any two of its
    places the text, ``within`` words wider, has it as often as the phrase."""
    ahead = f"greatest(x.start + i - {within}, 0)"
    return f"""forall(sequence(0, x.n - 1), i -> forall(sequence(i, x.n - 1), k ->
        x.phrase[i] != x.phrase[k]
        OR size(filter(slice(words, {ahead} + 1, greatest(x.start + k + {within} + 1 - {ahead}, 0)), w -> w = x.phrase[i]))
           >= size(filter(slice(x.phrase, i + 1, k - i + 1), w -> w = x.phrase[i]))))"""


def proximity_matches(source: DataFrame, windows: DataFrame, within: int, lists: int = 3) -> DataFrame:
    """Places where all words of a window stand, each at most ``within`` words
    away from where the phrase has it: row, window, start (by the rarest).  The
    lists of the rarest terms find candidates; the text decides."""
    chosen, rows = rarest_terms(source, windows, lists)
    moved = moved_lists(source, chosen, rows).withColumn("bin", F.floor(F.col("start") / (within + 1)))
    first = moved.where("rank = 0").select("row", "window", "start", "n", "lists",
                                           F.explode(F.array(*(F.col("bin") + d for d in (-1, 0, 1)))).alias("bin"))
    other = moved.where("rank > 0").select("row", "window", "bin", F.col("start").alias("near"), "rank")
    met = (first.join(other, ["row", "window", "bin"], "inner").where(F.abs(F.col("near") - F.col("start")) <= within)
           .groupBy("row", "window", "start", "n", "lists").agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("seen"))
           .where(F.col("seen") + 1 == F.pow(F.lit(2), F.col("lists")).cast("int") - 1))
    alone = moved.where("lists = 1")
    places = met.select("row", "window", "start", "n").unionByName(alone.select("row", "window", "start", "n")).distinct()
    return in_text(source, windows, places, rows, all_near(within)).select("row", "x.window", "x.start").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, lists: int = 3, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text", with_row: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated; see the module text for the method.  With
    ``with_row`` also ``row``, the :func:`row_key` of the row.

    Null and empty texts and items have no words and match nothing; a null
    item id counts as an empty one.  Repeated rows of ``docs`` give one row
    each, repeated items count once by id.  Other columns are not read.  An
    empty benchmark hits nothing.
    """
    source = training_texts(docs, id_col, text_col)
    windows = benchmark_windows(items, window, item_id, item_text)
    found = cut(phrase_matches(source, windows, lists), "phrases")
    # a word counts once: first the distinct positions, then their number
    hit = (found.select("row", F.explode(F.expr("sequence(start, start + n - 1)")).alias("position"))
           .groupBy("row", "position").agg(F.lit(1).alias("one")).groupBy("row").agg(F.count("*").alias("n_hit")))
    ids = windows.select(F.col("window").alias("id"), F.explode("items").alias("item"))
    named = (found.select("row", "window").distinct().join(ids, F.col("window") == F.col("id"), "inner")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("found")))
    per_row = hit.join(named, "row", "inner").select(F.col("row").alias("at"), "n_hit", "found")
    return (source.select("row", "doc_id", F.size(word_list(F.col("text"))).cast("long").alias("n_words"))
            .join(per_row, F.col("row") == F.col("at"), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("found", ","), F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated"), *(["row"] if with_row else [])))


ORACLE = rf"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '{NOT_A_WORD}'), lambda x: x <> '') AS words, row_number() OVER () AS line FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '{NOT_A_WORD}'), lambda x: x <> '') AS words FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT line, n, i, array_to_string(words[i:i + n - 1], ' ') AS phrase
       FROM (SELECT line, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, sizes)),
hit AS (SELECT line, item_id, i, win.n FROM dw JOIN win USING (n, phrase)),
spots AS (SELECT line, count(*) AS n_hit FROM (SELECT DISTINCT line, unnest(range(i, i + n)) FROM hit) GROUP BY line),
its AS (SELECT line, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT line, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY line)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN spots USING (line) LEFT JOIN its USING (line)
"""
