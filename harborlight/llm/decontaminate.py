"""Benchmark decontamination with a positional inverted index.

1. Terms: the occurrences of every benchmark term in the documents are counted.
2. Seeds: a window (13 consecutive words of an item, or all of a shorter item) can only
   occur where its rarest terms do; its two rarest are its seeds.  A window with a term
   that no document holds is dropped.
3. Index: postings (document, term, position) of the seed terms are stored.
4. Intersection: a posting at position p of a term at offset o of an item votes for the
   alignment p - o; alignments that hold all seeds of a window are candidates.
5. Exact phrases: candidates are compared with the document's words.  Proximity: seeds
   whose alignments differ by a few words at most, exact or not.

Everything is DataFrame operations.  Documents are keyed by a 64-bit hash of id and
text; since candidates are compared with the text itself, an equal key of two documents
cannot change a result.  Documents are shuffled only as narrow rows and, where their
words must be compared, those that hold a candidate; small sides are broadcast only
after they were counted.

Defined cases: null and empty texts have no words and are clean; null and empty items
have no windows; an item without id marks words but is not listed; repeated rows of
either table give equal results; an empty table gives no rows, respectively no hits;
extra columns are ignored, and kept by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.llm.common import alnum_words, ascii_lower, checked, let, stored, text_or_empty

WINDOW_WORDS = 13
SEEDS = 2
#: contaminated from one hit word in this many
ONE_HIT_IN = 20


def doc_key(id_column: str, text_column: str) -> Column:
    return F.xxhash64(F.col(id_column), F.col(text_column))


def _postings(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(key, at, word) of every word of every document; words lower-cased."""
    placed = docs.select(
        doc_key(id_column, text_column).alias("key"),
        F.posexplode(alnum_words(text_or_empty(text_column))).alias("at", "raw"),
    )
    return placed.select("key", "at", ascii_lower(F.col("raw")).alias("word"))


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, item, start, size, at, word): the words of every window of every item."""
    split = (
        items.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .distinct()
        .select(
            "item_id",
            F.xxhash64("item_id", "text").alias("item"),
            F.transform(alnum_words(text_or_empty()), ascii_lower).alias("words"),
        )
        .filter(F.size("words") > 0)
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return split.select("item_id", "item", "words", F.explode(starts).alias("start")).select(
        "item_id",
        "item",
        "start",
        F.least(F.size("words"), F.lit(window)).alias("size"),
        F.slice("words", F.col("start") + 1, F.lit(window)).alias("window"),
    )


def term_counts(docs: DataFrame, terms: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(word, n): occurrences of each of the stored ``terms`` in the documents."""
    words = _postings(docs, id_column, text_column).select("word")
    return words.join(checked(terms), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def seeded_windows(windows: DataFrame, counts: DataFrame, n_seeds: int = SEEDS) -> DataFrame:
    """(item_id, item, start, size, phrase, seeds): windows whose terms all occur somewhere."""
    terms = windows.select("item", "start", "size", F.posexplode("window").alias("at", "word"))
    known = terms.join(counts, "word")
    rank = Window.partitionBy("item", "start").orderBy("n", "at")
    ranked = known.withColumn("rank", F.row_number().over(rank))
    seeds = (
        ranked.groupBy("item", "start", "size")
        .agg(
            F.count(F.lit(1)).alias("n_known"),
            F.array_sort(
                F.collect_set(
                    F.when(
                        F.col("rank") <= n_seeds,
                        F.struct((F.col("start") + F.col("at")).alias("offset"), "word"),
                    )
                )
            ).alias("seeds"),
        )
        .filter("n_known = size")
        .drop("n_known", "size")
    )
    return windows.join(seeds, ["item", "start"]).select(
        "item_id", "item", "start", "size", F.array_join("window", " ").alias("phrase"), "seeds"
    )


def positional_index(
    docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Stored postings (key, at, word) of the stored ``terms``."""
    postings = _postings(docs, id_column, text_column).join(checked(terms), "word")
    return stored(postings.select("key", "at", "word"), "postings")


def alignments(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, item, alignment, offset): votes of the postings for places of items."""
    seeds = windows.select("item", F.explode("seeds").alias("s")).select(
        "item", F.col("s.offset").alias("offset"), F.col("s.word").alias("word")
    )
    seeds = stored(seeds.distinct(), "seeds")
    return index.join(checked(seeds), "word").select(
        "key", "item", (F.col("at") - F.col("offset")).alias("alignment"), "offset"
    )


def candidates(votes: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, at, size, item_id, phrase): places where all seeds of a window stand right."""
    held = votes.groupBy("key", "item", "alignment").agg(F.collect_set("offset").alias("offsets"))
    offsets = F.transform("seeds", lambda s: s["offset"])
    tried = held.join(checked(windows), "item").filter(
        F.size(F.array_except(offsets, F.col("offsets"))) == 0
    )
    at = F.col("alignment") + F.col("start")
    return tried.select("key", at.alias("at"), "size", "item_id", "phrase").filter("at >= 0")


def near_items(votes: DataFrame, windows: DataFrame, slack: int) -> DataFrame:
    """(key, n_near): items with a window whose seeds stand within ``slack`` of where its first one puts them.

    Two alignments that differ by at most ``slack`` share a cell of one of two grids
    whose cells are twice as wide and half a cell apart.
    """
    wide = 2 * slack + 1
    cells = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(g).alias("grid"),
                    F.floor((F.col("alignment") + g * (slack + 1)) / wide).alias("cell"),
                )
                for g in (0, 1)
            )
        )
    )
    grouped = (
        votes.select("key", "item", "offset", "alignment", cells.alias("c"))
        .groupBy("key", "item", "c")
        .agg(F.collect_set(F.struct("offset", "alignment")).alias("votes"))
    )
    tried = grouped.join(checked(windows), "item")

    def stands(seed: Column, around: Column) -> Column:
        return F.exists(
            "votes",
            lambda v: (v["offset"] == seed["offset"])
            & (F.abs(v["alignment"] - around["alignment"]) <= slack),
        )

    first = F.get("seeds", F.lit(0))["offset"]
    near = F.exists(
        "votes", lambda v: (v["offset"] == first) & F.forall("seeds", lambda s: stands(s, v))
    )
    return (
        tried.filter(near)
        .select("key", "item_id")
        .distinct()
        .groupBy("key")
        .agg(F.count("item_id").alias("n_near"))
    )


def _verified(words: Column) -> Column:
    return F.filter(
        "tries",
        lambda c: F.array_join(F.slice(words, c["at"] + 1, c["size"]), " ") == c["phrase"],
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW_WORDS,
    slack: int = 3,
    with_near: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document row: key, doc_id, words, hit words, items and the verdict."""
    words_of_items = stored(item_windows(items, window), "item-windows")
    vocabulary = stored(
        words_of_items.select(F.explode("window").alias("word")).distinct(), "item-terms"
    )
    counts = stored(term_counts(docs, vocabulary, id_column, text_column), "term-counts")
    windows = stored(seeded_windows(words_of_items, counts), "seeded-windows")
    terms = stored(
        windows.select(F.explode("seeds.word").alias("word")).distinct(), "seed-terms"
    )
    votes = alignments(positional_index(docs, terms, id_column, text_column), windows)
    tries = stored(
        candidates(votes, windows)
        .groupBy("key")
        .agg(F.collect_set(F.struct("at", "size", "item_id", "phrase")).alias("tries")),
        "candidates",
    )
    texts = docs.select(doc_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    keys = checked(tries.select("key"), 1_000_000)
    verified = let(F.transform(alnum_words(F.col("text")), ascii_lower), _verified)
    compared = (
        texts.join(keys, "key", "left_semi")
        .join(tries, "key")
        # split once for all tries of a text, and kept from the projection that follows
        .select("key", F.inline(F.array(F.struct(verified.alias("held")))))
        .filter(F.size("held") > 0)
        .select(
            "key",
            F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            "held", lambda c: F.sequence(c["at"], c["at"] + c["size"] - 1)
                        )
                    )
                )
            ).alias("n_hit"),
            F.array_sort(
                F.array_distinct(
                    F.filter(F.transform("held", lambda c: c["item_id"]), lambda x: x.isNotNull())
                )
            ).alias("items"),
        )
        .groupBy("key")
        .agg(F.first("n_hit").alias("n_hit"), F.first("items").alias("items"))
    )
    base = docs.select(
        F.col(id_column).alias("doc_id"),
        doc_key(id_column, text_column).alias("key"),
        F.size(alnum_words(text_or_empty(text_column))).cast("long").alias("n_words"),
    )
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    items_found = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    out = base.join(compared, "key", "left").select(
        "key",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        items_found.alias("items"),
        ((n_hit > 0) & (ONE_HIT_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    if not with_near:
        return out
    near = near_items(votes, windows, slack)
    return out.join(near, "key", "left").withColumn(
        "n_near", F.coalesce("n_near", F.lit(0)).cast("long")
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    judged = contamination(
        docs, items, with_near=False, id_column=id_column, text_column=text_column
    )
    bad = stored(judged.filter("contaminated").select(F.col("key").alias("__hl_key")).distinct(), "bad")
    keyed = docs.withColumn("__hl_key", doc_key(id_column, text_column))
    return keyed.join(checked(bad, 1_000_000), "__hl_key", "left_anti").drop("__hl_key")
