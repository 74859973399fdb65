"""MinHash near-duplicates with sequential Bayesian verification.

A text is the set of its distinct four-word shingles; documents whose sets have a Jaccard similarity of
0.8 or more are linked, and a component of links keeps its least id. Texts with one and the same set
are one representative, so exact copies cost nothing further.

Candidates are representatives that share a band (BANDS bands of BAND_ROWS MinHash values). A candidate's
signatures (the last byte of each value) are compared in batches of BATCH: with ``m`` of ``n`` equal and a
uniform prior, the share of equal bytes is Beta(m + 1, n - m + 1), and the pair is pruned as soon as the
posterior chance of the share that a similarity of 0.8 has, or more, falls below MISS. What survives
all batches is verified exactly, on the full sets, in whole numbers.

Pairs of a bucket are not listed. Only components are wanted, so:

1. *Stars*: each bucket compares its members with one hub, which is a row per member however large the
   bucket is. Proven links are contracted; a second star takes another hub for the buckets that
   still hold more than one component.
2. *Crossings*: in buckets that are still divided, the members outside the bucket's largest component are
   compared with all members of other components, block by block: posterior pruning first, then
   exact sets, inside the task. Only proven links leave it; a pair is compared in the first band where it meets.

So a group of copies that holds a third of all rows costs its members times the few that stay outside.
At similarity 0.8 a pair shares no band with a chance of about 1e-7 and is pruned with one of at most
BATCHES * MISS; a higher similarity lowers both quickly.

Defined cases: fewer than four words are one shingle, all of them; a text without words (or null) has no
shingle and no link; rows without an id are left out; rows with one id and one set are one row of the
result, and with different sets one document that is linked with what any of its texts is linked with;
an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut
from plantmetrics.llm.components import components
from plantmetrics.llm.words import Grams, U, Words, mix, slices

SHINGLE, PERCENT = 4, 80
BANDS, BAND_ROWS = 40, 5
BATCH, BATCHES, MISS = 32, 8, 1e-6
STARS = 2
#: Bounds of a block of a bucket (rows; shingles of all its rows), and rows of small buckets in one task's work.
BLOCK_ROWS, BLOCK_SHINGLES, PACK_ROWS = 1024, 1_000_000, 2048
#: Text of one slice: its shingle hashes stay in a core's cache while all functions run over them.
SLICE = 1 << 20


def least_matches(n: int, similarity: float, miss: float) -> int:
    """The least number of equal values among ``n`` at which a pair is still kept.

    With a uniform prior, P(S >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                          + m * math.log(similarity) + (n + 1 - m) * math.log1p(-similarity))
        if total >= miss:
            return m
    return n


#: Two documents of the asked similarity have this share of equal bytes.
SHARE = PERCENT / 100 + (1 - PERCENT / 100) / 256
LEAST = [least_matches(BATCH * (i + 1), SHARE, MISS) for i in range(BATCHES)]


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, fold=True)
    grams = Grams(words.hash)
    out = []
    for i, j in zip(words.row[:-1], words.row[1:], strict=True):
        at = np.arange(i, max(i + 1, j - SHINGLE + 1)) if j > i else np.zeros(0, dtype=np.int64)
        h = np.sort(grams.of(at, np.minimum(at + SHINGLE, j)))
        out.append(h[np.r_[True, h[1:] != h[:-1]]] if len(h) else h)
    return out


def _set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that know a set."""
    with np.errstate(over="ignore"):
        return np.array([[int(np.sum(mix(s + salt), dtype=U)) for salt in (U(1), U(2))] for s in sets], dtype=U).reshape(-1, 2)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and the last bytes of all MinHash values of sets that aren't empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    low = np.empty((len(sets), BATCH * BATCHES), dtype=np.uint8)
    keys = np.tile(mix(np.arange(BANDS, dtype=U)), (len(sets), 1))   # a key tells its band, too
    work = np.empty_like(flat)
    with np.errstate(over="ignore"):
        for f in range(BATCH * BATCHES):
            np.bitwise_xor(flat, mix(U(2 * f + 1)), out=work)
            np.multiply(work, mix(U(2 * f + 2)) | U(1), out=work)
            value = np.minimum.reduceat(work, starts)
            low[:, f] = value & U(0xFF)
            band = f // BAND_ROWS
            if band < BANDS:
                keys[:, band] = mix(keys[:, band] * U(31) + value)
    return keys, low


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in slices(b, limit=SLICE):
            sets = shingle_sets(part.column("text"))
            size = np.array([len(s) for s in sets], dtype=np.int64)
            known = _set_keys(sets).view(np.int64)
            keys, sigs = [None] * len(sets), [None] * len(sets)
            filled = np.flatnonzero(size)
            if len(filled):
                k, low = signatures([sets[i] for i in filled])
                for i, at in enumerate(filled):
                    keys[at], sigs[at] = k[i].tobytes(), low[i].tobytes()
            yield pa.record_batch([part.column("doc_id"), pa.array(known[:, 0]), pa.array(known[:, 1]), pa.array(size),
                                   pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                                  names=["doc_id", "s1", "s2", "n", "keys", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each representative."""
    for b in batches:
        if b.num_rows:
            keys = np.frombuffer(b"".join(b.column("keys").to_pylist()), dtype=np.int64)
            yield pa.record_batch([pa.array(np.repeat(b.column("rep").to_numpy(), BANDS)), pa.array(keys)], names=["rep", "key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of the representatives (a text of the same id but another set is passed over)."""
    for b in batches:
        for part in slices(b, limit=SLICE):
            sets = shingle_sets(part.column("text"))
            known = _set_keys(sets).view(np.int64)
            same = (known[:, 0] == part.column("s1").to_numpy()) & (known[:, 1] == part.column("s2").to_numpy())
            members = pa.array([s.tobytes() for s in sets], pa.binary())
            yield part.drop_columns(["text"]).append_column("members", members).filter(pa.array(same))


def _kept(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs (rows of ``left`` and ``right``, their signatures) no batch prunes."""
    at, equal = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
    for i, least in enumerate(LEAST):
        cols = slice(i * BATCH, (i + 1) * BATCH)
        equal = equal + np.count_nonzero(left[at, cols] == right[at, cols], axis=1)
        on = equal >= least
        at, equal = at[on], equal[on]
        if not len(at):
            break
    return at


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on full sets: 100 * intersection >= PERCENT * union."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    shared = np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1) for c in ("sig", "sig_b"))
            yield b.select(["a", "b"]).take(pa.array(_kept(left, right)))


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = zip(b.column("members"), b.column("members_b"), strict=True)
        on = [_linked(*(np.frombuffer(x.as_buffer(), dtype=U) for x in pair)) for pair in sets]
        yield b.select(["a", "b"]).filter(pa.array(on, pa.bool_()))


def _both(pairs: DataFrame, of: DataFrame, c: str) -> DataFrame:
    left, right = of.select(F.col("rep").alias("a"), c), of.select(F.col("rep").alias("b"), F.col(c).alias(f"{c}_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", c, f"{c}_b")


def _unpruned(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that no batch of their signatures prunes."""
    return _both(pairs, reps, "sig").mapInArrow(_prune, "a long, b long").distinct()


def _proven(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are linked."""
    return _both(pairs, sets, "members").mapInArrow(_prove, "a long, b long")


def _cross(table: pa.Table) -> pa.Table:
    """Proven links between members of different components of the buckets (or the pair of blocks) given."""
    rep, comp, side, key = (table.column(c).to_numpy() for c in ("rep", "comp", "side", "key"))
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype=np.int64).reshape(len(rep), -1)
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(len(rep), -1)
    members = table.column("members")
    sets = [np.frombuffer(members[i].as_buffer(), dtype=U) for i in range(len(rep))]
    order = np.argsort(key, kind="stable")
    bounds = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1], True])
    root = {int(c): int(c) for c in comp}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        own = order[i:j]
        t = int(np.flatnonzero(keys[own[0]] == key[own[0]])[0])
        # side 1 and 3: members outside the bucket's largest component; 1 meets all, 3 meets only what is not of its own block
        for x in own[(side[own] == 1) | (side[own] == 3)]:
            if side[x] == 1:
                other = own[(side[own] != 1) | (own > x)]
            else:
                other = own[side[own] != 3]
            other = other[(comp[other] != comp[x]) & (other != x)]
            other = other[_kept(np.broadcast_to(sigs[x], (len(other), sigs.shape[1])), sigs[other])]
            if t:
                other = other[~(keys[other, :t] == keys[x, :t]).any(1)]
            for y in other:
                a, b = find(int(comp[x])), find(int(comp[y]))
                if a != b and _linked(sets[x], sets[y]):
                    root[max(a, b)] = min(a, b)
                    links.append((int(rep[x]), int(rep[y])))
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _with_components(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members of buckets with the component that the links so far give them."""
    if links is None:
        return members.withColumn("comp", F.col("rep"))
    roots = components(links).select(F.col("node").alias("rep"), "root")
    return members.join(roots, "rep", "left").withColumn("comp", F.coalesce("root", "rep")).drop("root")


def _star(members: DataFrame, turn: int) -> DataFrame:
    """Pairs of each member of a divided bucket with the bucket's hub of this turn, if of another component."""
    first = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
    hubs = members.groupBy("key").agg(F.min(F.struct(first.alias("o"), "rep", "comp")).alias("hub"),
                                              F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1")
    pairs = members.join(hubs.select("key", F.col("hub.rep").alias("hub"), F.col("hub.comp").alias("hub_comp")), "key")
    pairs = pairs.filter("comp != hub_comp and rep != hub")
    return pairs.select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()


def _crossings(members: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components that divide a bucket, all pairs across them compared."""
    sized = members.join(reps.select("rep", "n"), "rep")
    parts = sized.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    whole = parts.groupBy("key").agg(F.max(F.struct("rows", "shingles", F.col("comp").alias("main"))).alias("m"), F.sum("rows").alias("rows"),
                                             F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("comps"))
    # two members of two components have been compared by the star already
    whole = whole.filter("comps > 1 and rows > 2")
    blocks = lambda r, s: F.greatest(F.lit(1), F.ceil(F.greatest(r / BLOCK_ROWS, s / BLOCK_SHINGLES))).cast("int")
    whole = cut(whole.select("key", "rows", F.col("m.main").alias("main"), blocks(F.col("m.rows"), F.col("m.shingles")).alias("q"),
                             blocks(F.col("rows") - F.col("m.rows"), F.col("shingles") - F.col("m.shingles")).alias("r")))
    total = whole.agg(F.sum("rows")).first()[0] or 0
    packs = max(1, -(-total // PACK_ROWS))
    dealt = members.join(whole, "key")
    rest = F.col("comp") != F.col("main")
    mine = F.pmod(F.xxhash64("rep", "key"), F.when(rest, F.col("r")).otherwise(F.col("q")).cast("long")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("rest", rest)
    # pairs of blocks: (i, j) of the rest with i <= j, and (i, r + j) of the rest with the main component
    single = (F.col("q") == 1) & (F.col("r") == 1)
    ij = F.when(single, F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.col("rest").cast("int").alias("side")))).when(
        F.col("rest"), F.concat(
            F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda k: F.struct(
                F.least("mine", k).alias("i"), F.greatest("mine", k).alias("j"),
                F.when(k == F.col("mine"), 1).when(k > F.col("mine"), 3).otherwise(2).alias("side"))),
            F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda k: F.struct(
                F.col("mine").alias("i"), (F.col("r") + k).alias("j"), F.lit(3).alias("side"))))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda k: F.struct(
            k.alias("i"), (F.col("r") + F.col("mine")).alias("j"), F.lit(0).alias("side"))))
    dealt = dealt.select("rep", "comp", "key", single.alias("single"), F.explode(ij).alias("p"))
    place = F.when(F.col("single"), F.pmod(F.xxhash64("key"), F.lit(packs))).otherwise(F.col("key"))
    dealt = dealt.select("rep", "comp", "key", place.alias("pack"), "p.i", "p.j", "p.side")
    full = dealt.join(reps.select("rep", "keys", "sig", "s1", "s2").join(sets, ["rep", "s1", "s2"]).drop("s1", "s2"), "rep")
    return full.groupBy("pack", "i", "j").applyInArrow(_cross, "a long, b long")


def _release(spark: SparkSession) -> None:
    """Shuffle files and checkpoints of frames that are no longer referred to go when the driver's two
    collectors have run; left to themselves they run late, and the disks hold every stage till then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document that has an id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    signed = cut(docs.mapInArrow(_sign, "doc_id long, s1 long, s2 long, n long, keys binary, sig binary"))
    plain = cut(signed.select("doc_id", "s1", "s2", "n").distinct())
    owners = cut(plain.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")))
    first = owners.select(F.col("rep").alias("doc_id"), "s1", "s2")
    reps = cut(signed.join(first, ["doc_id", "s1", "s2"]).dropDuplicates(["doc_id", "s1", "s2"]).withColumnRenamed("doc_id", "rep"))
    del signed, first
    _release(spark)
    nodes = reps.select("rep", "keys").mapInArrow(_bands, "rep long, key long")
    met = nodes.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("key")
    members = cut(nodes.join(met, "key").distinct())
    reps = cut(reps.join(members.select("rep").distinct(), "rep"))
    del nodes, met
    _release(spark)
    # the first stars say whose sets are needed: what they don't prune, and buckets of three or more
    pairs = cut(_unpruned(_star(_with_components(members, None), 0), reps))
    many = members.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 2").select("key")
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(members.join(many, "key").select("rep")).distinct()
    wanted = wanted.join(reps.select("rep", "s1", "s2"), "rep")
    sets = docs.join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "s1", "s2", "text").mapInArrow(
        _sets, "rep long, s1 long, s2 long, members binary")
    sets = cut(sets.dropDuplicates(["rep", "s1", "s2"]))
    del wanted, many
    _release(spark)
    links = cut(_proven(pairs, sets))
    for turn in range(1, STARS):
        pairs = cut(_unpruned(_star(_with_components(members, links), turn), reps))
        links = cut(links.unionByName(_proven(pairs, sets)))
        _release(spark)
    crossed = cut(_crossings(cut(_with_components(members, links)), reps, sets))
    links = links.unionByName(crossed)
    del sets, reps, members, pairs
    _release(spark)
    # texts of one id are one document
    several = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("doc_id")
    own = plain.join(several, "doc_id").join(owners, ["s1", "s2"], "left")
    links = links.unionByName(own.select(F.col("doc_id").alias("a"), F.coalesce("rep", "doc_id").alias("b")))
    roots = components(links)
    of_set = owners.join(roots, F.col("rep") == F.col("node"), "left").select("s1", "s2", F.coalesce("root", "rep").alias("of_set"))
    out = plain.join(of_set, ["s1", "s2"], "left").join(
        several.join(roots, F.col("doc_id") == F.col("node")).select("doc_id", F.col("root").alias("of_id")), "doc_id", "left")
    component = F.coalesce("of_set", "of_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
