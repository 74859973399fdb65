"""Secret scan: fixed patterns, and a battery of randomness tests.

Base kinds are regular expressions, leftmost and without overlap. Beside them every long run
of key characters gets an inferred encoding (hex, base32, base64) and three tests of
randomness in its alphabet: chi-squared uniformity, the runs test around the middle symbol,
and the lag-1 serial correlation. Each has its law under uniform symbols at the run's own
length; a run that one of them rejects (chi-squared by the cube-root transform beyond
CHI_Z, the others beyond TWO_SIDED_Z) is not random.

How far a run is from natural text is its log-likelihood ratio of uniform against natural
symbols, summed over the run, so it grows with the length. The natural law steps between kinds
of characters (lower, upper, digit, other) as in STEPS and between letters as the corpus's runs
of letters alone (natural words) do. Under that law the chance of a ratio of r or more is at most
exp(-r) at every length (Markov's inequality): this is the run's p-value, 1 for a rejected run.
Benjamini-Hochberg at ``fdr`` is applied within each encoding and length class.

The law (27 x 26 pair counts at most) and the cut-offs (one number per encoding and length
class at most, from a histogram of binned ratios) are the only things the driver sees; all else
is work on the row. A run of letters alone, but for a capital in front, is natural by
definition; a run with fewer than 16 characters before its padding (dividers such as '====') is
neither natural nor a candidate; '=' inside a run counts as one of the two signs of base64.

Defined cases: a null text is empty; texts of any length are scanned whole; each row gives
one row, repeated and null ids included; an empty table gives an empty result; only the id
and the text are read. Offsets are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.llm.common import chunks, cut, let, running

#: Fixed patterns: kind, expression, and which matches stay.
ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # maximal runs, so the length can stand in the expression
RUN = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
ENCODINGS = tuple(ALPHABETS)
#: Length class c holds runs of 16 * 2**(c/2) to 16 * 2**((c+1)/2) characters; the last, all longer.
CLASSES = 12
BINS_PER_UNIT, MAX_BIN = 8, 4000
#: Beyond these standard deviations a test rejects uniform symbols: all together 1 to 3 of 1,000 random runs
#: (simulated, 20,000 each of 16 to 128 symbols of each encoding).
CHI_Z, TWO_SIDED_Z = 4.0, 3.5
#: Natural text: chance of each kind of character (lower, upper, digit, other) after each kind, and
#: at the start. Letters of either case follow each other as in the corpus's natural words.
STEPS = {"lower": (.84, .06, .04, .06), "upper": (.38, .48, .04, .10), "digit": (.03, .03, .88, .06),
         "other": (.40, .35, .20, .05), "": (.45, .30, .20, .05)}
#: Weight of the single letters behind the pairs, in pairs.
PAIR_PRIOR = 200
FDR = 0.01


def _matches(regex: str, group: int = 0) -> tuple[Column, Column]:
    """The texts between matches, and the matches."""
    return F.split(F.col("text"), regex, -1), F.regexp_extract_all(F.col("text"), F.lit(regex), F.lit(group))


def _spans(pieces: str, found: str) -> Column:
    """array<struct<s, e, t>>: offsets from the lengths of what lies between the matches."""
    start = f"cast({{at}} + length(x.{pieces}) as int)"
    return F.expr(running(
        f"arrays_zip({pieces}, {found})", f"length(x.{pieces}) + coalesce(length(x.{found}), 0)", f"x.{found} is not null",
        f"named_struct('s', {start}, 'e', {start} + length(x.{found}), 't', x.{found})", "struct<s: int, e: int, t: string>"))


def _random(codes: str, size: int) -> str:
    """Whether the tests leave uniform symbols 0 .. size - 1 possible, as SQL; 2 symbols at least."""
    n = f"size({codes})"
    squares = (f"aggregate(transform(array_distinct({codes}), s -> power(size(filter({codes}, c -> c = s)), 2)), "
               f"0D, (a, x) -> a + x)")
    df = f"{size - 1}D"
    chi = f"(power(greatest({size}D / {n} * {squares} - {n}, 0D) / {df}, 1D / 3) - 1 + 2 / (9 * {df})) / sqrt(2 / (9 * {df}))"
    high = f"size(filter({codes}, c -> 2 * c >= {size}))"
    runs = f"(1 + size(filter(sequence(1, {n} - 1), i -> (2 * {codes}[i] >= {size}) != (2 * {codes}[i - 1] >= {size}))))"
    m = f"(2D * {high} * ({n} - {high}) / {n})"
    runs_z = f"if({high} = 0 or {high} = {n}, 10D, ({runs} - 1 - {m}) / sqrt(greatest({m} * ({m} - 1) / ({n} - 1), 1e-9D)))"
    mean = f"({size - 1}D / 2)"
    lag = f"aggregate(sequence(1, {n} - 1), 0D, (a, i) -> a + ({codes}[i] - {mean}) * ({codes}[i - 1] - {mean}))"
    variance = (size * size - 1) / 12
    serial_z = f"{lag} / ({variance}D * sqrt({n} - 1))"
    return f"({chi} <= {CHI_Z}D and abs({runs_z}) <= {TWO_SIDED_Z}D and abs({serial_z}) <= {TWO_SIDED_Z}D)"


def _coded() -> Column:
    """For each run: span, encoding (null for natural words and all else), length class, symbol codes
    without padding (for a candidate), and the characters (for a natural run)."""
    length_class = f"cast(least(greatest(floor(2 * log2(length(r.t) / 16D)), 0), {CLASSES - 1}) as int)"
    body = "rtrim('=', r.t)"
    letters = "r.t rlike '^[A-Z]?[a-z]+$'"
    encoding = ("case when r.t rlike '^([0-9a-f]+|[0-9A-F]+)$' then 0 when r.t rlike '^[A-Z2-7]{16,}=*$' then 1 "
                "when length(rtrim('=', r.t)) >= 16 then 2 end")
    chars = f"split({body}, '')"
    b64, b32, b16 = ALPHABETS["base64"], ALPHABETS["base32"], ALPHABETS["hex"]
    code = {0: f"transform({chars}, c -> locate(lower(c), '{b16}') - 1)", 1: f"transform({chars}, c -> locate(c, '{b32}') - 1)",
            2: f"transform({chars}, c -> locate(translate(c, '-_=', '+/+'), '{b64}') - 1)"}
    codes = " ".join(f"when ({encoding}) = {e} then {c}" for e, c in code.items())
    return F.expr(f"""transform(runs, r -> named_struct('s', r.s, 'e', r.e, 'enc', if({letters}, null, {encoding}),
        'len', {length_class}, 'codes', if({letters}, null, case {codes} end), 'word', if({letters}, lower(r.t), null)))""")


def _pairs(coded: DataFrame) -> dict[tuple[str, str], int]:
    """Letter pairs of the natural words ('' before the first letter) and how often they occur."""
    word = coded.select(F.explode("runs").alias("r")).filter("r.word is not null").select(F.split("r.word", "").alias("c"))
    pair = word.select(F.explode(F.expr("transform(c, (x, i) -> named_struct('a', if(i = 0, '', c[i - 1]), 'b', x))")).alias("p"))
    # 27 x 26 rows at most
    return {(r["a"], r["b"]): r["n"] for r in pair.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()}


def _kind(symbol: str) -> str:
    return "lower" if symbol.islower() else "upper" if symbol.isupper() else "digit" if symbol.isdigit() else "other" if symbol else ""


def log_ratios(pairs: dict[tuple[str, str], int], alphabet: str) -> list[float]:
    """log(uniform / natural) of symbol b after symbol a at a * size + b; a = size at the start. The
    natural law is the corpus's, given that the symbol is one of the alphabet."""
    single: dict[str, int] = {}
    for (_, b), n in pairs.items():
        single[b] = single.get(b, 0) + n
    kinds, out = ("lower", "upper", "digit", "other"), []
    members = {k: [x for x in alphabet if _kind(x) == k] for k in kinds}
    for a in [*alphabet, ""]:
        step = {k: p for k, p in zip(kinds, STEPS[_kind(a)], strict=True) if members[k]}
        law = {}
        for k, p in step.items():
            weight = {b: 1.0 for b in members[k]}
            if k in ("lower", "upper"):
                before = a.lower() if a.isalpha() else ""
                alone = {b: single.get(b.lower(), 0) + 1.0 for b in members[k]}
                weight = {b: pairs.get((before, b.lower()), 0) + PAIR_PRIOR * alone[b] / sum(alone.values()) for b in members[k]}
            law |= {b: p / sum(step.values()) * w / sum(weight.values()) for b, w in weight.items()}
        out += [-math.log(len(alphabet) * law[b]) for b in alphabet]
    return out


def _scored(pairs: dict[tuple[str, str], int]) -> Column:
    """For each candidate: span, encoding, length class, and the bin of its log-likelihood ratio (0 if
    it is negative or a test rejects uniform symbols)."""
    bins = []
    for e, alphabet in enumerate(ALPHABETS.values()):
        size = len(alphabet)
        table = f"cast(split('{','.join(f'{x:.6f}' for x in log_ratios(pairs, alphabet))}', ',') as array<double>)"
        ratio = (f"aggregate(sequence(0, size(r.codes) - 1), 0D, "
                 f"(a, i) -> a + {table}[if(i = 0, {size}, r.codes[greatest(i - 1, 0)]) * {size} + r.codes[i]])")
        bins.append(f"when r.enc = {e} then if({_random('r.codes', size)}, "
                    f"cast(least(greatest(floor({ratio} * {BINS_PER_UNIT}), 0), {MAX_BIN}) as int), 0)")
    return F.expr(f"""transform(filter(runs, r -> r.enc is not null), r -> named_struct('s', r.s, 'e', r.e, 'enc', r.enc,
        'len', r.len, 'bin', case {" ".join(bins)} end))""")


def _cutoffs(scanned: DataFrame, fdr: float) -> dict[tuple[int, int], int]:
    """Smallest accepted bin per (encoding, length class): at most one entry for each."""
    run = scanned.select(F.explode("runs").alias("r")).select("r.enc", "r.len", "r.bin")
    found = run.groupBy("enc", "len", "bin").agg(F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy("enc", "len")
    p = F.exp(-F.col("bin") / F.lit(float(BINS_PER_UNIT)))
    ranked = found.select("enc", "len", "bin", p.alias("p"), F.sum("m").over(whole.orderBy(F.desc("bin"))).alias("k"),
                          F.sum("m").over(whole).alias("all"))
    passed = ranked.filter((F.col("bin") > 0) & (F.col("p") <= fdr * F.col("k") / F.col("all")))
    # ENCODINGS x CLASSES rows at most
    return {(r["enc"], r["len"]): r["bin"] for r in passed.groupBy("enc", "len").agg(F.min("bin").alias("bin")).collect()}


def secret_scan(docs: DataFrame, fdr: float = FDR, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, spans``: array<struct<start, stop, kind>> by start, then kind (an index of KINDS).
    A ``random`` span is only added where no base span overlaps it."""
    own = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = {}
    for name, regex in (("a", ASSIGN), ("k", ACCESS), ("h", HEX), ("r", RUN)):
        parts[f"{name}_p"], parts[f"{name}_m"] = _matches(regex)
    parts["a_v"] = _matches(ASSIGN, 1)[1]
    own = own.select("doc_id", *[c.alias(n) for n, c in parts.items()])
    # what stays; the values of assignments go along with their spans
    kept = {"a": "filter(zip_with(a, a_v, (x, v) -> if(length(v) >= 6, x, null)), x -> x is not null)",
            "k": "filter(k, x -> length(x.t) >= 20)", "h": "h"}
    own = own.select("doc_id", "a_v", *[_spans(f"{n}_p", f"{n}_m").alias(n) for n in "akh"], _spans("r_p", "r_m").alias("runs"))
    base = [F.expr(f"transform({some}, x -> named_struct('s', x.s, 'e', x.e, 'kind', {k}))") for k, some in enumerate(kept.values())]
    coded = cut(own.select("doc_id", F.array_sort(F.concat(*base)).alias("base"), _coded().alias("runs")))
    scanned = cut(coded.select("doc_id", "base", _scored(_pairs(coded)).alias("runs")))
    limits = _cutoffs(scanned, fdr)
    accept = " or ".join(f"(r.enc = {e} and r.len = {c} and r.bin >= {b})" for (e, c), b in sorted(limits.items())) or "false"
    # a run looks at the slices of base spans that reach into it, then at their spans
    slices = let("__b", "base", f"transform({chunks('__b')}, c -> named_struct('s', c[0].s, 'e', array_max(c.e), 'of', c))")
    overlaps = "exists(__sl, c -> c.s < r.e and r.s < c.e and exists(c.of, b -> b.s < r.e and r.s < b.e))"
    added = F.expr(let("__sl", slices, f"""transform(filter(runs, r -> ({accept}) and not {overlaps}),
        r -> named_struct('s', r.s, 'e', r.e, 'kind', 3))"""))
    spans = F.expr("array_sort(concat(base, added), (x, y) -> case when x.s != y.s then x.s - y.s else x.kind - y.kind end)")
    done = scanned.select("doc_id", "base", added.alias("added")).select("doc_id", spans.alias("spans"))
    return done.select("doc_id", F.transform("spans", lambda x: F.struct(
        x["s"].alias("start"), x["e"].alias("stop"), x["kind"].alias("kind"))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")
