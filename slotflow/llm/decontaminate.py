"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

DataFrame functions only.

An item is inside a document if at least ``threshold`` of its n distinct shingles occur there, that is, if at most
n - ceil(threshold * n) are missing. Its signature is the least hashes of its shingles: that many, and r more. A
document that holds the item then holds at least r hashes of the signature; others are out, and none that belongs is
lost. Items are partitioned by size, as r and how small the hashes of a signature are both depend on n: each partition has its own
r and cut-off. Of a document, only hashes below the largest cut-off that stand in some signature are looked up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.llm.common import key_filter, row_hash, store, text_digest, without

#: Text is lower-cased and cut into words at everything that is no letter, mark or digit.
NOT_WORDS = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    """The words of a text; none for null or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORDS), lambda w: w != "")


def shingle_hashes(words: Column, n: int) -> Column:
    """The 64-bit hashes of all runs of ``n`` words. Words are hashed once, runs from the hashes of their words."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - n + 1), lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(n)]))
    whole = lambda h: F.when(F.size(h) >= n, runs(h)).otherwise(F.array().cast("array<bigint>"))
    # bound by a lambda, so that the words are hashed once a row
    return F.element_at(F.transform(F.array(hashed), whole), 1)


def shingles(words: Column, n: int) -> Column:
    """All runs of ``n`` words as text."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
    whole = lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<string>"))
    return F.element_at(F.transform(F.array(words), whole), 1)


def every_length(words: Column, lengths: list[int], cut: Callable[[Column, int], Column]) -> Column:
    """A row for each element of ``cut(words, w)``, for all lengths; the words are made once a text."""
    return F.explode(F.element_at(F.transform(F.array(words), lambda found: F.concat(*[cut(found, w) for w in lengths])), 1))


def item_shingles(benchmark: DataFrame, item: str, text: str, words: int) -> DataFrame:
    """Every item with words: ``item``, its shingle length ``w`` (an item of fewer words is one shingle), distinct ``grams`` and hashes."""
    cut = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    cut = cut.withColumn("w", F.least(F.size("words"), F.lit(words)))
    grams = F.coalesce(*[F.when(F.col("w") == n, F.array_distinct(shingles(F.col("words"), n))) for n in range(1, words + 1)])
    # an item that is there twice, or one key with several texts: each text counts for itself
    return cut.select("item", "w", grams.alias("grams")).distinct().withColumn("text_no", F.xxhash64("w", "grams"))


def gram_hash(gram: Column, w: int) -> Column:
    return F.xxhash64(*[F.xxhash64(F.element_at(F.split(gram, " "), j + 1)) for j in range(w)])


def contained(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    words: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """Pairs ``key``, ``item_id``, ``n_shingles`` (distinct, of the item), ``n_found`` (of them in the document), ``containment``.

    One row per document row and item with containment of at least ``threshold``; of an item with several texts, the best.
    Null, empty and blank texts on either side match nothing, nor do empty tables; very long texts are cut whole. Repeated document rows with the same key and text are one
    pair; null keys on both sides are kept as null. Only the named columns are read.

    The signatures of all shingle lengths go into a filter of fixed size, which one scan of the documents tests; what passes is joined by hash, so a
    hash that many documents share is rows of a join that Spark can split, and the pairs of a document and an item are
    made distinct before anything is verified. Texts are never shuffled but for the candidates.
    """
    exact = verified(docs, benchmark, key, text, item, item_text, words, threshold)
    if exact is None:
        empty = docs.select(F.col(key), F.lit(None).cast(benchmark.schema[item].dataType).alias("item_id")).where("false")
        return empty.select(key, "item_id", F.lit(0).alias("n_shingles"), F.lit(0).alias("n_found"), F.lit(0.0).alias("containment"))
    best = exact.groupBy("key", "item").agg(F.max(F.struct((F.col("found") / F.col("n")).alias("share"), "found", "n")).alias("best"))
    return best.select(
        F.col("key").alias(key), F.col("item").alias("item_id"), F.col("best.n").cast("int").alias("n_shingles"),
        F.col("best.found").cast("int").alias("n_found"), F.col("best.share").alias("containment"),
    )


def verified(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    words: int = 5, threshold: float = 0.8, whole: bool = False,
) -> DataFrame | None:
    """``key``, ``doc`` and the item's ``item``, ``n`` and ``found``, for each document and item text within it; None if there is none.

    ``doc`` is a hash of key and text; with ``whole`` it is what names the row, ``own`` and ``hash``.
    """
    items = store(item_shingles(benchmark, item, item_text, words))
    lengths = sorted(r["w"] for r in items.select("w").distinct().collect())  # at most ``words`` rows
    parts = []
    for w in lengths:
        hashed = items.where(F.col("w") == w).select(
            "item", "text_no", "w", F.size("grams").alias("n"), F.array_sort(F.transform("grams", lambda g: gram_hash(g, w))).alias("hashes")
        )
        parts.append(hashed)
    if not parts:
        return None
    all_items = parts[0]
    for more in parts[1:]:
        all_items = all_items.unionByName(more)
    # partitions by size: powers of two of the number of shingles. The larger the items, the more hashes must agree
    sized = all_items.withColumn("size_part", F.floor(F.log2("n")).cast("int"))
    sized = sized.withColumn("need", F.greatest(F.lit(1), F.floor(F.pow(F.lit(2.0), F.col("size_part")) / 8)).cast("int"))
    allowed = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int")
    index = store(sized.withColumn("signature", F.slice("hashes", 1, allowed + F.col("need"))).drop("hashes"))
    signatures = index.select("item", "text_no", "w", "n", "need", F.explode("signature").alias("hash"))
    cut_offs = index.groupBy("w", "size_part").agg(F.max(F.element_at("signature", -1)).alias("most"))
    cut_off = {r["w"]: r["most"] for r in cut_offs.groupBy("w").agg(F.max("most").alias("most")).collect()}

    same_text = F.xxhash64(F.col(key), F.col(text))
    # hashes of runs of different lengths go together: one reading of the documents, and equal hashes are verified below
    low = lambda words, w: F.filter(shingle_hashes(words, w), lambda h: h <= cut_off[w])
    found = docs.select(F.col(key).alias("key"), same_text.alias("doc"), every_length(words_of(F.col(text)), lengths, low).alias("_hash"))
    found = found.where(key_filter(signatures, "hash")).select("key", "doc", F.col("_hash").alias("hash"))
    hits = found.join(signatures, "hash").groupBy("key", "doc", "item", "text_no", "need").agg(F.count_distinct("hash").alias("hits"))
    candidates = hits.where("hits >= need").select("key", "doc")
    wanted = store(candidates.distinct())
    is_wanted = key_filter(wanted, "doc")
    if is_wanted is None:
        return None

    # verify: the candidates' texts once more, cut into shingles as text, against the items' shingles as text
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), same_text.alias("_hash")).where(is_wanted)
    same = (F.col("_hash") == F.col("_doc")) & F.col("key").eqNullSafe(F.col("_key"))
    held = rows.join(wanted.select(F.col("key").alias("_key"), F.col("doc").alias("_doc")), same, "left_semi")
    name = F.struct(text_digest(F.col("text")).alias("own"), row_hash("key", "text").alias("hash")) if whole else F.col("_hash")
    held = held.select("key", name.alias("doc"), words_of(F.col("text")).alias("words"))
    grams = items.select("item", "text_no", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    passes = key_filter(grams.select(F.xxhash64("gram").alias("hash")), "hash")
    distinct = lambda words, w: F.array_distinct(shingles(words, w))
    cut = held.select("key", "doc", every_length(F.col("words"), lengths, distinct).alias("gram"))
    match = cut.withColumn("_hash", F.xxhash64("gram")).where(passes).join(grams, "gram").select("key", "doc", "item", "text_no", "n", "gram").distinct()
    exact = match.groupBy("key", "doc", "item", "text_no", "n").agg(F.count(F.lit(1)).alias("found"))
    return exact.where(F.col("found") >= F.ceil(F.col("n") * threshold - 1e-9))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that stand in a pair of ``contained``, null keys included; all columns stay as they are.

    Rows are named by key and text: another row of the same key stays.
    """
    found = verified(docs, benchmark, key, text, whole=True, **settings)
    if found is None:
        return docs
    return without(docs, found.select("key", F.col("doc.own").alias("own"), F.col("doc.hash").alias("hash")), key, text)
