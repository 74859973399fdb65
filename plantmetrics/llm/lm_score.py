"""Language-model scores by a bigram model that backs off to words.

A history is the 32-bit hash class of the word before. Weights are log10 probabilities of a
smoothed model (Dirichlet prior of ``prior`` tokens towards the unigrams), so those of a history
sum to one. There is no automaton: bigram, history and word totals are looked up by key::

    p(w | k) = (C(k, j) * P(w | j) + prior * P(w)) / (C(k) + prior)     j: class of w
    P(w) = (c(w) + 1) / (N + V + 1)                                     one share for unknown words

With fewer words than classes nearly every class is one word; two words in one class share
their history, and split its bigrams by their own probabilities.

Nothing holds the whole model. Documents are dealt into chunks of about CHUNK_CHARS; a
chunk counts its own words and bigrams, sends each range of the sorted keys, with counts, to
the task that owns that range (delta-coded, so an entry is about 7 bytes), and gets back the
totals of just these keys in the same order: the part of the model its texts can reach. A
word or bigram that is frequent everywhere is one entry for each chunk.

Tokens are words (A-Z in lower case) and one end per text. Defined cases: a null or empty text
is the end token alone; a null id counts as the empty string in the training rule; repeated
rows count each time; without training texts every word has P = 1; an empty table gives an
empty result; only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.words import U, Words, mix, slices

CHUNK_CHARS = 10_000_000
PRIOR = 1000.0
#: Stand-ins for the end of a text and for the history at its start.
END, START = mix(U(0xE0D)), mix(U(0x57A27))
_32 = U(32)
WORD, BIGRAM = 1, 2


def held_out(key: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def pack(values: np.ndarray) -> bytes:
    """Unsigned values in as many bytes as the largest needs, byte by byte of all values."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :blob[0]] = planes.T
    return out.view("<u8").ravel().astype(U)


class Chunk:
    """Tokens, histories and rows of a chunk's texts, in order, and its distinct keys."""

    def __init__(self, table: pa.Table) -> None:
        tokens, rows, sizes, done = [], [], [], 0
        texts = table.column("text").combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        for part in slices(pa.record_batch([texts], names=["text"])):
            w = Words(part.column("text"), fold=True)
            n = part.num_rows
            row = w.row_of_word()
            tok = np.empty(len(w.hash) + n, dtype=U)
            tok[np.arange(len(w.hash)) + row] = w.hash
            tok[w.row[1:] + np.arange(n)] = END
            size = np.diff(w.row) + 1
            tokens.append(tok)
            sizes.append(size)
            rows.append(np.repeat(np.arange(done, done + n, dtype=np.int32), size))
            done += n
        self.tokens = np.concatenate([np.zeros(0, dtype=U), *tokens])
        self.row = np.concatenate([np.zeros(0, dtype=np.int32), *rows])
        self.sizes = np.concatenate([np.zeros(0, dtype=np.int64), *sizes])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.history = np.r_[START, self.tokens[:-1]][:len(self.tokens)]
        self.history[self.first] = START
        self.bigrams = mix((self.history & ~U(0xFFFFFFFF)) | (self.tokens >> _32))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and for each key its place among them."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.r_[True, s[1:] != s[:-1]][:len(s)]
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return s[new], place


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the n equal ranges of the upper 32 bits in sorted keys."""
    owner = ((keys >> _32) * U(n)) >> _32
    return np.searchsorted(owner, np.arange(n + 1))


def _keys(c: Chunk) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct keys by kind, and the places of all tokens (words: then of START)."""
    return {WORD: _distinct(np.r_[c.tokens, START]), BIGRAM: _distinct(c.bigrams)}


_REQUEST = "kind int, bucket int, chunk int, keys binary, counts binary"


def _requests(n: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        c = Chunk(table)
        train = ~np.asarray(table.column("held_out").to_numpy())
        weight = np.repeat(train, c.sizes).astype(np.float64)
        out: list[tuple] = []
        for kind, (keys, place) in _keys(c).items():
            w = np.r_[weight, train.sum()] if kind == WORD else weight
            counts = np.bincount(place, weights=w, minlength=len(keys)).astype(U)
            bounds = _ranges(keys, n)
            for bucket in np.flatnonzero(np.diff(bounds)):
                a, b = bounds[bucket], bounds[bucket + 1]
                out.append((kind, int(bucket), key[0].as_py(), pack(np.r_[keys[a], np.diff(keys[a:b])]), pack(counts[a:b])))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(
            (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["kind", "bucket", "chunk", "keys", "counts"])
    return run


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a range, their totals, the place of every entry, and the entries' bounds."""
    keys = [np.cumsum(unpack(x.as_py()), dtype=U) for x in table.column("keys")]
    counts = np.concatenate([unpack(x.as_py()) for x in table.column("counts")])
    bounds = np.cumsum([0, *map(len, keys)])
    distinct, place = _distinct(np.concatenate(keys))
    return distinct, np.bincount(place, weights=counts.astype(np.float64), minlength=len(distinct)).astype(U), place, bounds


_ANSWER = "chunk int, kind int, bucket int, values array<binary>"


def _answers(table: pa.Table) -> pa.Table:
    """For each request, the totals of its keys in its order; for words also, by class, the tokens
    that are histories, the tokens, and the distinct words."""
    kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
    keys, totals, place, bounds = _merged(table)
    values = [totals]
    if kind == WORD:
        group, of = np.unique(keys >> _32, return_inverse=True)
        for on in (keys != END, keys != START, (keys != START) & (totals > 0)):
            w = on.astype(np.float64) * (totals.astype(np.float64) if len(values) < 3 else 1)
            values.append(np.bincount(of, weights=w, minlength=len(group)).astype(U)[of])
    blobs = [[pack(v[place[a:b]]) for v in values] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    n = table.num_rows
    return pa.table([table.column("chunk"), pa.array([kind] * n, pa.int32()), pa.array([bucket] * n, pa.int32()),
                     pa.array(blobs, pa.list_(pa.binary()))], names=["chunk", "kind", "bucket", "values"])


def _totals(table: pa.Table) -> pa.Table:
    """Training tokens and distinct training words of a range of words."""
    n = v = 0
    if table.column("kind")[0].as_py() == WORD:
        keys, totals, _, _ = _merged(table)
        totals = totals[keys != START]
        n, v = int(totals.sum()), int((totals > 0).sum())
    return pa.table([pa.array([n], pa.int64()), pa.array([v], pa.int64())], names=["tokens", "types"])


def _scores(prior: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(docs)
        got: dict[int, list[tuple]] = {WORD: [], BIGRAM: []}
        for r in answers.to_pylist():
            got[r["kind"]].append((r["bucket"], r["values"]))
        n, v = (answers.column(x)[0].as_py() if answers.num_rows else 0 for x in ("tokens", "types"))
        keys = _keys(c)
        merged = {k: [np.concatenate([unpack(x[i]) for _, x in sorted(rows, key=lambda r: r[0])]).astype(np.float64)
                      for i in range(4 if k == WORD else 1)] for k, rows in got.items() if rows}
        if docs.num_rows and any(len(merged[k][0]) != len(keys[k][0]) for k in keys):
            raise ValueError("the totals do not match the chunk's keys")
        count, histories, in_class, types = merged[WORD]
        place = keys[WORD][1][:-1]
        known = count[place]
        base = (known + 1) / (n + v + 1)
        before = np.r_[keys[WORD][1][-1], place[:-1]]
        before[c.first] = keys[WORD][1][-1]
        seen = histories[before]                                   # C(k)
        share = np.where(known > 0, (known + 1) / np.maximum(in_class[place] + types[place], 1), 0)
        arcs = merged[BIGRAM][0][keys[BIGRAM][1]] * share          # C(k, j) * P(w | j)
        full = (arcs + prior * base) / (seen + prior)
        log_base, log_full = np.log10(base), np.log10(full)
        rows = len(c.sizes)
        add = lambda x: np.bincount(c.row, weights=x, minlength=rows)
        return pa.table([docs.column("doc_id"), docs.column("held_out"), pa.array(c.sizes), pa.array(add(known > 0).astype(np.int64)),
                         pa.array(np.full(rows, n, dtype=np.int64)), pa.array(add(log_base)), pa.array(add(log_full))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, prior: float = PRIOR, chunk_chars: int = CHUNK_CHARS, text: str = "text", key: str = "doc_id",
              out_of_training: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score``
    (add-one unigrams) and ``score`` (the automaton's log10 probability of the text)."""
    out_of_training = held_out(F.col(key)) if out_of_training is None else out_of_training
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), out_of_training.alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n = max(1, -(-chars // chunk_chars))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    requests = docs.groupBy("chunk").applyInArrow(_requests(n), _REQUEST)
    owned = requests.groupBy("kind", "bucket")
    totals = owned.applyInArrow(_totals, "tokens long, types long").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"))
    answers = owned.applyInArrow(_answers, _ANSWER).join(F.broadcast(totals), F.lit(True))  # totals: one row
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scores(prior), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
