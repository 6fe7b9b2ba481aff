"""Benchmark decontamination: documents are scanned for the word windows of test items.

The windows of all items form one set. Every window of every document is hashed
and looked up in it; a hit is verified by its words. All steps are DataFrame
expressions. The set is broadcast while its measured size is below
``broadcast_bytes``; a larger one is joined by a shuffle on the hash, and the
hits' words are verified in a second join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What separates words once A-Z are lower-cased: ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words, in any case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WINDOW = 10

#: The set of windows is broadcast up to this size: hashes, texts and an allowance for each row.
BROADCAST_BYTES = 64 << 20


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all else left alone."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The lower-cased words of a text; none of a null one."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def window_hashes(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """``rows`` with ``h<n>`` for each n of ``lengths``: a hash of the n words from each of ``words``.

    Hashes of 1, 2, 4, ... words are built from halves, and other lengths from
    these, so that a window costs a few steps whatever its length. Each array is
    a column of its own: inlined into another's lambda it would be built again
    for each word. Windows that pass the end are hashes of what is left.
    """
    base = list(rows.columns)

    def joined(a: str, b: str, shift: int) -> Column:
        return F.transform(a, lambda x, i: F.xxhash64(x, F.get(F.col(b), i + shift)))
    have = [1]
    rows = rows.select(*base, F.transform("words", lambda w: F.xxhash64(w)).alias("_p1"))
    while 2 * have[-1] <= max(lengths, default=1):
        n = have[-1]
        rows = rows.select(*rows.columns, joined(f"_p{n}", f"_p{n}", n).alias(f"_p{2 * n}"))
        have.append(2 * n)
    for length in lengths:
        parts = [n for n in reversed(have) if length & n]
        name, done = f"_p{parts[0]}", parts[0]
        for n in parts[1:]:
            rows = rows.select(*rows.columns, joined(name, f"_p{n}", done).alias(f"_q{length}_{n}"))
            name, done = f"_q{length}_{n}", done + n
        rows = rows.withColumn(f"h{length}", F.col(name))
    return rows.select(*base, *[f"h{n}" for n in lengths])


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, width, window): the different windows of each item, words joined by a space.

    An item of fewer than ``size`` words, but not none, is one window.
    """
    rows = items.select(F.col("item_id"), words(items["text"]).alias("words"))
    rows = rows.select("item_id", "words", F.size("words").alias("n")).where("n > 0")
    rows = rows.withColumn("width", F.least("n", F.lit(size)))
    starts = F.transform(F.sequence(F.lit(1), F.col("n") - F.col("width") + 1),
                         lambda i: F.array_join(F.slice("words", i, F.col("width")), " "))
    return rows.select("item_id", "width", F.explode_outer(starts).alias("window")).distinct()


def _window_set(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(h, width, window) of the different windows."""
    rows = window_hashes(windows.select("width", "window").distinct()
                         .withColumn("words", F.split("window", " ")), lengths)
    h = F.coalesce(*[F.when(F.col("width") == n, F.get(f"h{n}", F.lit(0))) for n in lengths])
    return rows.select(h.alias("h"), "width", "window")


def found_windows(docs: DataFrame, items: DataFrame, size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(occurrences, windows of the items).

    Occurrences: (doc_id, t, n, start, width, window); t hashes the text and n
    counts its words. Each row of ``docs`` also gives one row whose ``window`` is
    null. Rows equal in doc_id and t give equal occurrences.
    """
    windows = written(item_windows(items, size), "item-windows")
    lengths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # ``size`` numbers at most
    known = written(_window_set(windows, lengths or [size]), "window-set")
    bytes_ = known.agg(F.coalesce(F.sum(F.octet_length("window") + 64), F.lit(0)).alias("b")).first()["b"]
    small = bytes_ <= broadcast_bytes
    lengths = lengths or [size]

    rows = docs.select(docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("t"),
                       words(docs["text"]).alias("words"))
    rows = window_hashes(rows.select("doc_id", "t", "words", F.size("words").alias("n")), lengths)
    # one more place, with a hash of its own, stands for the row; outer: no filter on the array is inferred
    places = F.concat(*[f"h{n}" for n in lengths], F.array("t"))
    carried = ["doc_id", "t", "n", *(["words"] if small else [])]
    rows = rows.select(*carried, F.posexplode_outer(places).alias("at", "h"))
    last = F.col("n") * len(lengths)
    which = F.expr("at div greatest(n, 1)")
    start = F.col("at") - which * F.col("n")
    width = F.get(F.array(*[F.lit(n) for n in lengths]), which)
    if small:
        said = F.array_join(F.slice("words", F.col("start") + 1, F.col("width")), " ")
        known = F.broadcast(known.withColumnRenamed("h", "_h").withColumnRenamed("width", "_width"))
        rows = rows.withColumns({"start": start.cast("int"), "width": width, "own": F.col("at") >= last})
        rows = rows.join(known, (F.col("h") == F.col("_h")) & (F.col("width") == F.col("_width"))
                         & (F.col("window") == said) & ~F.col("own"), "left").where("own or window is not null")
        rows = rows.select("doc_id", "t", "n", "start", "width", "window")
        return written(rows, "windows-found"), windows

    hashes = known.select("h").distinct()
    hits = rows.where(F.col("at") < last).join(hashes, "h", "left_semi")
    hits = hits.select("doc_id", "t", "n", start.cast("int").alias("start"), width.alias("width")).distinct()
    hits = hits.groupBy("doc_id", "t", "n").agg(F.collect_list(F.struct("start", "width")).alias("at"))
    texts = docs.select(docs["doc_id"], F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("t"),
                        F.col("text"))
    hits = hits.withColumnsRenamed({"doc_id": "_doc_id", "t": "_t"})
    hits = texts.join(hits, texts["doc_id"].eqNullSafe(hits["_doc_id"]) & (texts["t"] == hits["_t"]))
    hits = hits.select("doc_id", "t", "n", words(F.col("text")).alias("words"), "at")
    said = F.transform("at", lambda x: F.struct(x["start"].alias("start"), x["width"].alias("width"), F.array_join(
        F.slice("words", x["start"] + 1, x["width"]), " ").alias("window")))
    hits = hits.select("doc_id", "t", "n", F.inline_outer(said)).join(known.select("window"), "window", "left_semi")
    rows = rows.where(F.col("at") >= last).select(
        "doc_id", "t", "n", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("string").alias("window"))
    return written(rows.unionByName(hits), "windows-found"), windows


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, t, n_words, copies, spans, items) of each different (doc_id, text).

    ``copies``: rows equal in both. ``spans``: merged runs (start, stop) of words
    inside occurrences of item windows, by word number from 0, stop excluded.
    ``items``: the item_ids whose windows occur, as sorted strings.

    Null and empty texts have no words; null ids are ids like others; a null
    item_id is the empty string; items that share an id are one. Very long texts
    are one row each: their windows pass one by one. Empty tables: no items hit
    nothing, no documents give no rows.
    """
    found, windows = found_windows(docs, items, size, broadcast_bytes)
    hits = (found.where("window is not null").join(windows.select("item_id", "window"), "window")
            .select("doc_id", "t", "n", F.struct("start", (F.col("start") + F.col("width")).alias("stop")).alias("span"),
                    F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.lit(0).alias("own")))
    own = found.where("window is null").select(
        "doc_id", "t", "n", F.lit(None).cast(hits.schema["span"].dataType).alias("span"),
        F.lit(None).cast("string").alias("item"), F.lit(1).alias("own"))
    rows = hits.unionByName(own).groupBy("doc_id", "t", "n").agg(
        F.sum("own").alias("copies"), F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    kind = "array<struct<start:int,stop:int>>"

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & (last["stop"] >= x["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1),
                               F.array(F.struct(last["start"].alias("start"),
                                                F.greatest(last["stop"], x["stop"]).alias("stop"))))
                      ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop")))))
    merged = F.when(F.size("spans") > 0, F.aggregate("spans", F.array().cast(kind), lambda done, x: add(done, x).cast(kind))
                    ).otherwise(F.array().cast(kind))
    return rows.select("doc_id", "t", F.col("n").cast("long").alias("n_words"), "copies", merged.alias("spans"), "items")


def contaminated_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW,
                           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of ``docs``."""
    rows = contamination(docs, items, size, broadcast_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without what the items share with them; all columns stay.

    ``remove="documents"`` drops each document with an occurrence;
    ``remove="spans"`` cuts the words of occurrences, each with what separates
    it from the next word, out of ``text``.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be spans or documents, not {remove!r}")
    hit = (contamination(docs, items, size, broadcast_bytes).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias("_doc_id"), F.col("t").alias("_t"), F.col("spans").alias("_spans")))
    same = docs["doc_id"].eqNullSafe(hit["_doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == hit["_t"])
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    rows = docs.join(hit, same, "left")
    gaps = F.split("text", WORD)  # one more than the words
    tokens = F.zip_with(F.array_remove(F.split("text", SEPARATORS_ANY), ""), F.slice(gaps, 2, F.size(gaps)),
                        lambda word, gap: F.concat(word, gap))
    rows = rows.withColumn("_tokens", F.when(F.col("_spans").isNotNull(), tokens))
    # what lies between the end of each span and the start of the next
    a = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda x: x["stop"]))
    b = F.concat(F.transform("_spans", lambda x: x["start"]), F.array(F.size("_tokens")))
    kept = F.zip_with(a, b, lambda x, y: F.array_join(F.slice("_tokens", x + 1, y - x), ""))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(
        F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, "")))
    return rows.withColumn("text", text).select(*docs.columns)


#: What separates words in any case.
SEPARATORS_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
