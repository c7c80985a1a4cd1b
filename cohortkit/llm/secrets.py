"""Operator 6: secret scans by a randomness test battery.

Three base kinds are patterns with a least length (``BASE``). Beside them every
unbroken run of ``RUN`` that fits an encoding's alphabet (hexadecimal, base32,
base64 or its URL form, inferred in this order; a digit and a letter at least)
is put to three tests of randomness over the alphabet's symbols: chi-squared
uniformity, the number of runs above and below the middle, and lag-one serial
correlation. Fisher's method makes one p-value of the three. Truly random
strings have uniform p-values, others pile up near 0; from the corpus' counts
of p-values, taken apart by encoding and length band because short strings
give the tests less power, the share of non-random strings above each
threshold follows, and the lowest threshold (``FLOOR`` at least) whose share is
at most ``FALSE_SHARE`` is used for that family. Runs that overlap a base span
are left out. '=' ends a run, but for up to two as padding, so NAME=value is two
runs. A run that holds both '-' or '_' and '+' or '/' fits no alphabet: its
longest parts without the former and those without the latter (``PARTS``) are
candidates instead; they may overlap.

Only DataFrame functions are used. Positions are code points, end exclusive:
the lengths of the pieces between matches and of the matches are added up, in
blocks of ``STEP``, so that a text with very many matches stays linear.

Defined results: null and empty texts have no spans; repeated rows are scanned
alike; a corpus without candidates adds none; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind -> (pattern, least characters of group). A run's pattern starts at the
#: run's start, so that its least length can stand in the pattern.
BASE = {"assign": (ASSIGN, 6), "access": (r"AKIA[A-Z0-9]{16,}", 0), "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", 0)}
PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}" + PADDING
PARTS = (r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}" + PADDING, r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}" + PADDING)
KINDS = [*BASE, "random"]
HEX, B32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BINS = 50
FLOOR = 0.02
FALSE_SHARE = 0.1
STEP = 256


def _length(x: Column) -> Column:
    return F.char_length(x)


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start,end,size>> of the pattern's leftmost non-overlapping
    matches; ``size`` is the length of ``group``."""
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), _length)
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), _length)
    sizes = F.transform(F.regexp_extract_all(text, p, F.lit(group)), _length) if group else whole
    parts = F.arrays_zip(gaps.alias("g"), whole.alias("m"), sizes.alias("s"))  # one gap more than matches
    parts = F.filter(parts, lambda x: x["m"].isNotNull())
    return F.when(text.rlike(pattern), let(parts, _placed)).otherwise(
        F.array().cast("array<struct<start:int,end:int,size:int>>"))


def _placed(parts: Column) -> Column:
    """Starts and ends from lengths of gaps and matches."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x["g"] + x["m"])
    blocks = F.sequence(F.lit(0), ((F.size(parts) - 1) / STEP).cast("int"))
    sums = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.array_append(
        acc, F.element_at(acc, -1) + total(F.slice(parts, b * STEP + 1, F.lit(STEP)))))

    def one(bases, x, i):
        block = (i / STEP).cast("int")
        start = F.get(bases, block) + total(F.slice(parts, block * STEP + 1, i % STEP)) + x["g"]
        return let(start, lambda at: F.struct(at.alias("start"), (at + x["m"]).alias("end"), x["s"].alias("size")))

    return let(sums, lambda bases: F.transform(parts, lambda x, i: one(bases, x, i)))


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by Abramowitz and Stegun 7.1.26."""
    return let(z, _tail)


def _tail(z: Column) -> Column:
    x = F.abs(z) / 2 ** 0.5
    t = 1 / (1 + 0.3275911 * x)
    erfc = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)
    return F.when(z >= 0, erfc / 2).otherwise(1 - erfc / 2)


def encoding(token: Column) -> Column:
    core = F.rtrim(token, F.lit("="))
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    return F.when(mixed, F.when(core.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(core.rlike("^[A-Z2-7]+$"), "base32")
                  .when(core.rlike("^[A-Za-z0-9+/]+$"), "base64").when(core.rlike("^[A-Za-z0-9_-]+$"), "base64url"))


def _symbols(token: Column, enc: Column) -> Column:
    core = F.rtrim(token, F.lit("="))
    chars = F.split(F.when(enc == "hex", F.lower(core)).otherwise(F.translate(core, "-_", "+/")), "")
    alphabet = F.when(enc == "hex", HEX).when(enc == "base32", B32).otherwise(B64)
    return F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.position(c, alphabet) - 1)


def battery(symbols: Column, k: Column) -> Column:
    """Fisher's combined p-value of the three tests for symbols 0..k-1 (array<int>)."""
    n = F.size(symbols).cast("double")
    mean = F.aggregate(symbols, F.lit(0.0), lambda acc, x: acc + x) / n
    return let(F.struct(symbols.alias("x"), k.cast("double").alias("k"), n.alias("n"), mean.alias("mean")), _fisher)


def _fisher(v: Column) -> Column:
    x, k, n, mean = v["x"], v["k"], v["n"], v["mean"]
    squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda acc, s: acc + F.pow(
        F.size(F.filter(x, lambda y: y == s)).cast("double"), F.lit(2.0)))
    p_uniform = _normal_tail((k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
    pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    high = F.size(F.filter(x, lambda y: y >= k / 2)).cast("double")
    runs = lambda ps: 1 + F.size(F.filter(ps, lambda p: (p["a"] >= k / 2) != (p["b"] >= k / 2)))
    joint = lambda ps: F.aggregate(ps, F.lit(0.0), lambda acc, p: acc + (p["a"] - mean) * (p["b"] - mean))
    spread = F.aggregate(x, F.lit(0.0), lambda acc, y: acc + (y - mean) * (y - mean))
    seen = let(pairs, lambda ps: F.struct(runs(ps).alias("runs"), joint(ps).alias("joint"), spread.alias("spread"),
                                          (1 + 2 * high * (n - high) / n).alias("mu")))

    def rest(s: Column) -> Column:
        var = (s["mu"] - 1) * (s["mu"] - 2) / (n - 1)
        p_runs = F.when(var <= 0, 0.0).otherwise(2 * _normal_tail(F.abs((s["runs"] - s["mu"]) / F.sqrt(F.greatest(var, F.lit(1e-9))))))
        z = (s["joint"] / F.greatest(s["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)
        p_serial = F.when(s["spread"] <= 0, 0.0).otherwise(2 * _normal_tail(F.abs(z)))
        logs = [F.log(F.greatest(p, F.lit(1e-300))) for p in (p_uniform, p_runs, p_serial)]
        return let(-(logs[0] + logs[1] + logs[2]), lambda h: F.least(F.lit(1.0), F.exp(-h) * (1 + h + h * h / 2)))

    return let(seen, rest)


def _candidates(text: Column, found: Column) -> Column:
    """Runs with an inferred encoding: start, end, family, p."""
    def coded(s):
        return let(F.substring(text, s["start"] + 1, s["end"] - s["start"]), lambda t: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), t.alias("token"), encoding(t).alias("enc")))

    def parts(s):
        def cut(t):
            mixed = t.rlike("[-_]") & t.rlike("[+/]")
            inner = F.concat(*[F.transform(spans(t, p), lambda x: F.struct(
                (s["start"] + x["start"]).alias("start"), (s["start"] + x["end"]).alias("end"), x["size"].alias("size"))) for p in PARTS])
            return F.when(mixed, inner).otherwise(F.array(s))

        return let(F.substring(text, s["start"] + 1, s["end"] - s["start"]), cut)

    def tested(c):
        k = F.when(c["enc"] == "hex", 16).when(c["enc"] == "base32", 32).otherwise(64)
        band = F.floor(2 * F.log2((c["end"] - c["start"]).cast("double"))).cast("string")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.concat(c["enc"], F.lit("/"), band).alias("family"),
                        battery(_symbols(c["token"], c["enc"]), k).alias("p"))

    found = F.flatten(F.transform(found, parts))
    return F.transform(F.filter(F.transform(found, coded), lambda c: c["enc"].isNotNull()), tested)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id with the base spans of each kind and the tested candidates."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, (pattern, least) in BASE.items():
        found = spans(F.col("text"), pattern, 2 if least else 0)
        if kind == "access":
            none = F.array().cast("array<struct<start:int,end:int,size:int>>")
            found = F.when(F.col("text").contains("AKIA"), found).otherwise(none)
        df = df.withColumn(kind, F.filter(found, lambda s: s["size"] >= least))
    df = df.withColumn("runs", spans(F.col("text"), RUN))
    return df.withColumn("candidates", _candidates(F.col("text"), F.col("runs"))).drop("text", "runs")


def thresholds(rows: DataFrame) -> dict[str, float]:
    """Threshold of each family; the table of counts has at most four encodings
    x two bands for each doubling of length x ``BINS`` rows."""
    c = rows.select(F.explode("candidates").alias("c")).select("c.family", F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).alias("bin"))
    counts: dict[str, list[int]] = {}
    for r in c.groupBy("family", "bin").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r.family, [0] * BINS)[r.bin] = r.n
    out = {}
    for family, n in counts.items():
        by_random = 2.0 * sum(n[BINS // 2:])
        for b in range(max(1, round(FLOOR * BINS)), BINS):
            above = sum(n[b:])
            if above and 1 - min(above, by_random * (1 - b / BINS)) / above <= FALSE_SHARE:
                out[family] = b / BINS
                break
    return out


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, arrays ``base`` and ``spans`` of struct<start,rank,end,kind>."""
    rows = written(scanned(docs), "secret-scan")
    level = thresholds(rows)
    pairs = [F.lit(x) for kv in level.items() for x in kv]
    limit = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")

    def named(col: Column, kind: str) -> Column:
        return F.transform(col, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                   s["end"].alias("end"), F.lit(kind).alias("kind")))

    base = F.array_sort(F.concat(*[named(F.col(k), k) for k in BASE]))
    rows = rows.withColumn("base", base)
    passed = F.filter("candidates", lambda c: (c["p"] >= F.try_element_at(limit, c["family"]))
                      & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.withColumn("spans", F.array_sort(F.concat("base", named(passed, "random"))))


def _joined(spans_: str) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6(docs: DataFrame) -> DataFrame:
    return secrets(docs).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by '[SECRET]' and, where
    present, ``n_chars`` counted anew; overlapping spans become one. Rows are
    joined with their spans by doc_id and text."""
    keyed = docs.withColumn("__key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    texts = keyed.groupBy("__key").agg(F.min("text").alias("text"))
    found = secrets(texts.select(F.col("__key").alias("doc_id"), "text")).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("__key"), F.array_sort(F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).alias("__spans"))
    df = keyed.join(written(found, "secret-found"), "__key", "left")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("[SECRET]"))).otherwise("")
        return F.struct(F.concat(acc["text"], gap).alias("text"), F.greatest(acc["at"], s["end"]).alias("at"))

    clean = F.aggregate("__spans", start, step, lambda acc: F.concat(
        acc["text"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))))
    df = df.withColumn("__clean", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(clean))
    out = [F.col("__clean").alias("text") if c == "text"
           else (F.when(F.col("__spans").isNull(), F.col(c)).otherwise(F.char_length("__clean").cast(docs.schema[c].dataType)).alias(c)
                 if c == "n_chars" else F.col(c)) for c in docs.columns]
    return df.select(*out)
