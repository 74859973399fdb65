"""Benchmark decontamination by SimHash windows and Hamming blocks.

An item is compared with windows of its own length. The similarity ignores order, so shared
shingles (runs of ``SHINGLE`` words) count at any place: a window is taken at every start where
it holds as many shingles of items of that length as the similarity needs at least (a running
count over the document's hits), so none is missed. Windows and items get a 64-bit SimHash of
their weighted shingles. Both are indexed under BLOCKS pieces of the fingerprint and the length:
two fingerprints within RADIUS differ in fewer bits than there are pieces, so they agree in one
piece at least, and the index returns all of them. What it returns is checked by exact
weighted-shingle similarity (sum of the lesser over sum of the greater counts).

RADIUS: the second, third, ... copy of a shingle hash to elements of their own, so the weighted
similarity is that of two sets. Sets with a similarity of 0.8 have a cosine of 0.89 or more, so
each of the 64 bits differs with a chance under 0.152; more than 24 differ in about three pairs in a
million. Small sets differ more: the worst case up to 119 shared shingles, an item of 5 shingles
of which a cut window holds 4, has a chance of 0.1875 a bit and is lost in one case in 8,000; all
others in under one in 100,000.

Words are runs of non-white-space with A-Z in lower case. Defined cases: a null or empty text
has no words and no windows; an item of fewer than SHINGLE words has one shingle, the whole
item; a window that would cross the start or end of a document is cut there; equal items and
repeated rows each count; rows without an id (documents or items) are left out, as a result
could not name them; an empty table gives an empty result; only ids and texts are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut, fold

SHINGLE, SIMILARITY = 5, 0.8
RADIUS = 24
BLOCKS = RADIUS + 1
#: Benchmark shingles (24 bytes each) or window starts (4 bytes each) up to which a copy goes to
#: every executor; beyond it they are joined by a shuffle.
BROADCAST_SHINGLES = 1_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(fold(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _hash(words: str, at: str, n: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), F.col(at) + i) for i in range(n)])


def _shingles(rows: DataFrame, n: int, *keep: str) -> DataFrame:
    """A row per run of n words: ``keep``, its position ``at`` and hash ``h``."""
    rows = rows.filter(F.size("words") >= n)
    return rows.select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("at")).select(
        *keep, "at", _hash("words", "at", n).alias("h"))


def _array_shingles(words: Column, n: Column) -> Column:
    """The same hashes as one array (for windows, which are short)."""
    def one(k: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(words) - k),
                           lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return reduce(lambda rest, k: F.when(n == k, one(k)).otherwise(rest), range(1, SHINGLE), one(SHINGLE))


def _simhash(hashes: Column) -> Column:
    """Bit b is set if more than half of the elements have it set."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))


def _printed(rows: DataFrame) -> DataFrame:
    """``print``: the SimHash of ``shingles``, the j-th copy of a shingle as an element of its own."""
    rows = rows.withColumn("ordered", F.sort_array("shingles"))
    rows = rows.withColumn("elements", F.transform("ordered", lambda x, i: F.xxhash64(x, i - F.array_position(F.col("ordered"), x))))
    # never null, so that no null test is pushed below the columns it would repeat
    return rows.withColumn("print", F.coalesce(_simhash(F.col("elements")), F.lit(0).cast("long"))).drop("ordered", "elements")


def _blocks(print_: str) -> Column:
    """(number, bits) of the BLOCKS pieces; the first ones are a bit longer."""
    low, long = divmod(64, BLOCKS)
    start, out = 0, []
    for k in range(BLOCKS):
        width = low + (k < long)
        piece = F.shiftrightunsigned(F.col(print_), start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out.append(piece * BLOCKS + k)
        start += width
    return F.array(*out)


def _similarity(a: str, b: str) -> Column:
    """Weighted Jaccard of two hash arrays: shared = sum over distinct x of min(count, count)."""
    count = "size(filter({}, y -> y = x))"
    shared = (f"aggregate(array_intersect({a}, {b}), 0, (s, x) -> s + least({count.format(a)}, {count.format(b)}))")
    return F.expr(f"{shared} / (size({a}) + size({b}) - {shared})")


def _starts(similarity: float) -> Column:
    """Starts of the windows of n words that hold enough of the hits ``ats`` (sorted positions of known
    shingles). A window whose first hit is ats[i] starts behind ats[i - 1]; with c shingles it
    needs similarity / (1 + similarity) * (c + item's shingles) hits, at least similarity * item's shingles."""
    own, share = "(n - k + 1)", similarity / (1 + similarity)
    least = f"cast(greatest(ceil({similarity}D * {own} - 1e-9D), 1) as int)"
    held = "(least(s + n, n_words) - k - greatest(s, 0) + 1)"
    needed = f"cast(greatest(ceil({share}D * ({held} + {own}) - 1e-9D), 1) as int)"
    return F.expr(f"""flatten(transform(ats, (a, i) -> case when i + {least} <= size(ats) then filter(
        sequence(least(a, greatest(if(i = 0, -n, ats[i - 1] + 1), ats[i + {least} - 1] - {own} + 1)), a),
        s -> get(ats, i + {needed} - 1) <= s + {own} - 1) else cast(array() as array<int>) end))""")


def find_leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, text: str = "text", key: str = "doc_id",
               item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """``doc_id, item_id, start, size, similarity``: every window (in words) whose weighted-shingle
    similarity to an item of its length is ``similarity`` or more."""
    items = items.select(F.col(item_key).alias("item_id"), _words(F.col(item_text)).alias("words")).filter(
        "item_id is not null and size(words) > 0")
    items = items.withColumn("n", F.size("words")).withColumn("k", F.least("n", F.lit(SHINGLE)))
    known = cut(_printed(items.withColumn("shingles", _array_shingles(F.col("words"), F.col("k"))).drop("words")))
    # the lengths of the items that hold a shingle: one row per (k, h)
    lengths = known.select("k", "n", F.explode("shingles").alias("h")).groupBy("k", "h").agg(F.collect_set("n").alias("lengths"))
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), _words(F.col(text)).alias("words"))
    docs = docs.filter("doc_id is not null").withColumn("n_words", F.size("words"))
    sizes = lengths.groupBy("k").agg(F.count(F.lit(1)).alias("shingles")).collect()  # SHINGLE rows at most
    found = []
    for r in sizes:
        k = r["k"]
        side = lengths.filter(F.col("k") == k).select("h", "lengths")
        if r["shingles"] <= BROADCAST_SHINGLES:
            side = F.broadcast(side)
        seeds = _shingles(docs, k, "doc_id", "version", "n_words").join(side, "h")
        found.append(seeds.select("doc_id", "version", "n_words", F.lit(k).alias("k"), "at", F.explode("lengths").alias("n")))
    if not found:
        return docs.select("doc_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"),
                           F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0.0).alias("similarity")).limit(0)
    hits = reduce(DataFrame.unionByName, found).groupBy("doc_id", "version", "n_words", "k", "n").agg(
        F.sort_array(F.collect_set("at")).alias("ats"))
    taken = cut(hits.select("doc_id", "version", "k", "n", _starts(similarity).alias("starts")).filter("size(starts) > 0"))
    total = taken.agg(F.sum(F.size("starts"))).first()[0] or 0
    windows = docs.join(F.broadcast(taken) if total <= BROADCAST_SHINGLES else taken, ["doc_id", "version"])
    windows = windows.select("doc_id", "k", "n", "words", F.explode("starts").alias("start"))
    windows = windows.select("doc_id", "k", "n", "start", _cut_window())
    windows = windows.withColumn("version", F.xxhash64("window"))
    windows = windows.groupBy("doc_id", "k", "n", "start", "version").agg(F.first("window").alias("window")).drop("version")
    windows = _printed(windows.withColumn("shingles", _array_shingles(F.col("window"), F.col("k"))).drop("window"))
    index = known.select("item_id", F.col("n").alias("i_n"), F.col("print").alias("i_print"), F.col("shingles").alias("i_shingles"),
                         F.explode(_blocks("print")).alias("i_block"))
    looked = windows.withColumn("block", F.explode(_blocks("print")))
    near = looked.join(index, (F.col("block") == F.col("i_block")) & (F.col("n") == F.col("i_n")))
    apart = F.col("print").bitwiseXOR(F.col("i_print"))
    # a pair met under several pieces counts under the lowest piece in which it agrees
    lowest = F.array_min(F.transform(F.filter(F.arrays_zip(_blocks("print").alias("a"), _blocks("i_print").alias("b")),
                                              lambda z: z["a"] == z["b"]), lambda z: z["a"] % BLOCKS))
    near = near.filter(F.bit_count(apart) <= RADIUS).filter(F.col("block") % BLOCKS == lowest)
    near = near.withColumn("similarity", _similarity("shingles", "i_shingles")).filter(F.col("similarity") >= similarity)
    return near.select("doc_id", "item_id", F.greatest("start", F.lit(0)).alias("start"), F.col("n").alias("size"), "similarity")


def _cut_window() -> Column:
    """The n words from start, cut at the document's ends."""
    first = F.greatest("start", F.lit(0))
    stop = F.least(F.col("start") + F.col("n"), F.size("words"))
    return F.slice("words", first + 1, stop - first).alias("window")


def leaked_documents(leaks: DataFrame) -> DataFrame:
    """``doc_id, item_ids`` (sorted), ``best``: one row per document that holds an item."""
    return leaks.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("best"))


def decontaminate(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents (``doc_id``, ``text`` and all other columns) that hold no item."""
    leaks = find_leaks(docs, items, similarity).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("__leaked"), "left_anti")
