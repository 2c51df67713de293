"""Operator 9: secret scans, in DataFrame functions only.

Base kinds come from patterns.  Further candidates are long runs of
characters of an encoding's alphabet, their pieces between slashes and between
slashes, underscores and hyphens, and hexadecimal digits in hyphenated groups.
Their encoding is inferred from the characters used (the smallest alphabet that
has them all), and a battery tests whether the characters are random over
its alphabet: chi-squared uniformity over groups of the alphabet, a runs test
about the alphabet's middle, and lag-one serial correlation; where letters and
digits mix, also the number of changes between the two, as names end in a
number but keys scatter it.  The smallest p-value, times the number of tests, is
evidence against randomness.  Candidates are many, so
the evidence is weighted by length (a short run proves little) and held against
a Benjamini-Hochberg threshold over all candidates of the corpus: those it
rejects are ordinary text, the others are reported as ``random``.

Positions are code points, counted from the pieces between matches, so no
character needs to be reserved as a marker.  The one pass over the texts is
narrow; the threshold needs a histogram with a fixed number of bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# runs that are too short can be left out of these two patterns: a match is a maximal run
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
SEGMENT = r"[A-Za-z0-9+_-]{20,}"
PIECE = r"[A-Za-z0-9+]{20,}"
# groups of four hexadecimal digits or more, with a letter; too few digits are left out below
GROUPED = (r"(?<![A-Za-z0-9])(?=[0-9-]*[a-fA-F])(?:[0-9a-f]{4,}(?:-[0-9a-f]{4,})+|[0-9A-F]{4,}(?:-[0-9A-F]{4,})+)(?![A-Za-z0-9])")
KINDS = ("assign", "access", "hex", "random")

_BINS = 400
_SPAN = "array<struct<s:int,e:int>>"


def _positions(text: Column, pattern: str, matches: Column) -> Column:
    """Spans of the matches of a pattern, from the lengths of matches and of the pieces between them."""
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len")))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(_SPAN).alias("out"))

    def step(acc, x):
        begin = acc["pos"] + x["gap"]
        return F.struct((begin + x["len"]).alias("pos"),
                        F.concat(acc["out"], F.array(F.struct(begin.alias("s"), (begin + x["len"]).alias("e")))).alias("out"))

    return F.when(F.size(matches) == 0, F.array().cast(_SPAN)).otherwise(
        F.aggregate(pairs, start, step, lambda acc: acc["out"]))


def _of_kind(kind: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("kind"), x["e"].alias("e"))


def _in_group(group: int, k: Column):
    return lambda v: F.floor(v * 8 / k) == group


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation, error below 2e-4)."""
    z = F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))
    return 1.0 / (1.0 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Pattern, characters in code order, and whether changes between letters and digits are tested; the first that fits holds.
ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + "abcdef", False), ("^[0-9A-F]+$", _DIGITS + "ABCDEF", False),
    ("^(?=.*[2-7])[A-Z2-7]+$", _UPPER + "234567", True),
    # shorter ones are hard to tell from names with a number
    ("^(?=(?:.*[2-7]){2})[a-z2-7]{28,}$", _LOWER + "234567", True),
    ("^(?=.*[0-9])[0-9A-V]+$", _DIGITS + _UPPER[:22], True), ("^(?=.*[0-9])[0-9a-v]+$", _DIGITS + _LOWER[:22], True),
    ("^(?=.*[0-9])[0-9A-Z]+$", _DIGITS + _UPPER, True), ("^(?=.*[0-9])[0-9a-z]+$", _DIGITS + _LOWER, True),
    ("^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[1-9A-HJ-NP-Za-km-z]+$",
     "".join(c for c in _UPPER + _LOWER + _DIGITS if c not in "0OIl"), True),
    ("^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[0-9A-Za-z]+$", _UPPER + _LOWER + _DIGITS, True),
    ("[_-]", _UPPER + _LOWER + _DIGITS + "-_+/", False), ("", _UPPER + _LOWER + _DIGITS + "+/-_", False))


def _coded(c: Column) -> Column:
    """Candidate with its alphabet's size, the share of digits in it (0: not tested) and the codes of its characters."""
    def of(value):
        out = F.lit(value(ENCODINGS[-1]))
        for e in ENCODINGS[-2::-1]:
            out = F.when(c["m"].rlike(e[0]), F.lit(value(e))).otherwise(out)
        return out

    size = lambda e: min(64, len(e[1]))
    q = of(lambda e: sum(x in _DIGITS for x in e[1]) / len(e[1]) if e[2] else 0.0)
    codes = F.transform(F.array(of(lambda e: e[1])), lambda alphabet: F.transform(
        F.split(c["m"], ""), lambda ch: F.least(F.instr(alphabet, ch) - 1, F.lit(63)).cast("double")))
    digit = F.transform(F.split(c["m"], ""), lambda ch: ch.between("0", "9"))
    return F.struct(c["s"].alias("s"), c["e"].alias("e"), of(size).alias("k"), q.alias("q"), F.element_at(codes, 1).alias("x"),
                    digit.alias("d"))


def _measured(c: Column) -> Column:
    """Raw sums of the tests over the codes."""
    x, k = c["x"], c["k"]
    middle = (k - 1) / F.lit(2.0)
    groups = F.array(*[F.size(F.filter(x, _in_group(g, k))) for g in range(8)])
    squares = F.aggregate(groups, F.lit(0.0), lambda a, v: a + v * v)
    head, tail = F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1)
    changes = F.aggregate(F.zip_with(head, tail, lambda a, b: ((a > middle) != (b > middle)).cast("double")), F.lit(0.0), lambda a, v: a + v)
    cross = F.aggregate(F.zip_with(head, tail, lambda a, b: (a - middle) * (b - middle)), F.lit(0.0), lambda a, v: a + v)
    d = c["d"]
    mixes = F.aggregate(F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, 2, F.size(d) - 1), lambda a, b: (a != b).cast("double")),
                        F.lit(0.0), lambda a, v: a + v)
    return F.struct(c["s"].alias("s"), c["e"].alias("e"), F.size(x).cast("double").alias("n"), k.cast("double").alias("k"),
                    c["q"].alias("q"), mixes.alias("mixes"), squares.alias("squares"), changes.alias("changes"), cross.alias("cross"))


def _tested(c: Column) -> Column:
    """p-value of the battery: small when the characters are not random over the alphabet."""
    n, k = c["n"], c["k"]
    chi = 8.0 / n * c["squares"] - n
    cube = (F.pow(F.greatest(chi, F.lit(0.0)) / 7.0, F.lit(1 / 3)) - (1 - 2 / 63)) / (2 / 63) ** 0.5  # Wilson and Hilferty, 7 degrees
    runs = F.abs(c["changes"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    serial = F.abs(c["cross"]) / ((k * k - 1) / 12 * F.sqrt(n - 1))
    three = F.least(_normal_tail(cube), 2 * _normal_tail(runs), 2 * _normal_tail(serial))
    both = c["q"] * (1 - c["q"])  # changes between letters and digits of independent characters
    spread = (n - 1) * 2 * both * (1 - 2 * both) + 2 * (n - 2) * (both - 4 * both * both)
    mixed = F.abs(c["mixes"] - (n - 1) * 2 * both) / F.sqrt(F.greatest(spread, F.lit(1e-9)))
    p = F.when(c["q"] > 0, 4 * F.least(three, 2 * _normal_tail(mixed))).otherwise(3 * three)
    # evidence by length: a run of 32 characters counts in full, shorter ones less
    return F.struct(c["s"].alias("s"), c["e"].alias("e"), F.least(p * 32.0 / n, F.lit(1.0)).alias("p"))


def _threshold(scanned: DataFrame, rate: float) -> float:
    """Largest p-value that Benjamini and Hochberg's rule rejects at ``rate``, to a bin of a fixed histogram."""
    width = 20.0 / _BINS
    bins = (scanned.select(F.explode("candidates.p").alias("p"))
            .select(F.least(F.floor(-F.log10(F.greatest(F.col("p"), F.lit(1e-30))) / width), F.lit(_BINS)).alias("bin"))
            .groupBy("bin").agg(F.count("*").alias("n")).collect())  # at most _BINS + 1 rows
    by_bin = {r["bin"]: r["n"] for r in bins}
    total, below, found = sum(by_bin.values()), 0, 0.0
    for b in range(_BINS, -1, -1):
        below += by_bin.get(b, 0)
        edge = 10.0 ** (-b * width)  # the largest p-value of the bin
        if total and edge <= rate * below / total:
            found = edge
    return found


def secret_scan(docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
                keep: bool = False) -> DataFrame:
    """``(doc_id, base, spans)`` for every row: arrays of ``(s, kind, e)`` sorted by start, then kind.

    ``kind`` is an index of ``KINDS``; ``base`` holds the pattern kinds,
    ``spans`` also the random runs that lie in no base span.  ``assign`` needs 6
    characters of value, ``access`` 20 characters, ``hex`` 24.  Null and empty
    texts have no spans; null ids and repeated rows are kept; other columns are
    ignored; empty tables give empty results.  With ``keep``, a struct ``_row``
    of all columns of ``docs`` follows.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.col("text")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if keep else []
    t = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *row)
    row = ["_row"] if keep else []
    for name, pattern in (("m0", ASSIGN), ("m1", ACCESS), ("m2", HEX), ("m3", CANDIDATE), ("m4", SEGMENT), ("m5", PIECE), ("m6", GROUPED)):
        t = t.withColumn(name, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    value = F.when(F.size("m0") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>"))
    kept = F.zip_with(_positions(text, ASSIGN, F.col("m0")), value,
                      lambda x, v: F.when(F.length(v) >= 6, x))
    found = [F.filter(kept, lambda x: x.isNotNull()), _positions(text, ACCESS, F.col("m1")), _positions(text, HEX, F.col("m2"))]
    base = F.array_sort(F.concat(*[F.transform(a, _of_kind(k)) for k, a in enumerate(found)]))
    def runs(pattern, name):
        return F.zip_with(_positions(text, pattern, F.col(name)), F.col(name),
                          lambda x, m: F.struct(x["s"].alias("s"), x["e"].alias("e"), m.alias("m")))

    digits = F.transform(runs(GROUPED, "m6"), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.replace(c["m"], F.lit("-")).alias("m")))
    # a whole run without separators is its own piece
    runs = F.array_distinct(F.concat(runs(CANDIDATE, "m3"), runs(SEGMENT, "m4"), runs(PIECE, "m5"),
                                     F.filter(digits, lambda c: F.length(c["m"]) >= 20)))
    t = t.select("doc_id", base.alias("base"), runs.alias("c"), *row)
    t = t.withColumn("c", F.filter("c", lambda c: ~F.exists("base", lambda b: (b["s"] <= c["s"]) & (c["e"] <= b["e"]))))
    t = t.select("doc_id", "base", F.transform(F.transform(F.transform("c", _coded), _measured), _tested).alias("candidates"),
                 *row)
    scanned = scratch.table(t, "scanned")
    limit = _threshold(scanned, rate)
    # of a run and its pieces, the longest that are random
    longest = lambda found: F.filter(found, lambda c: ~F.exists(found, lambda o: (o["s"] <= c["s"]) & (c["e"] <= o["e"]) & (
        o["e"] - o["s"] > c["e"] - c["s"])))
    found = F.element_at(F.transform(F.array(F.filter("candidates", lambda c: c["p"] > F.lit(limit))), longest), 1)
    random = F.array_distinct(F.transform(found, _of_kind(3)))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"), *row)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"),
                                                                 x["e"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, rate: float = 0.05, mask: str = "*", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with the characters of every found span replaced by ``mask``.

    Texts keep their length in characters if the mask is one character, so
    other spans stay valid.  Rows without spans, and null texts, stay as they
    are.
    """
    found = secret_scan(docs, rate, text_col=text_col, keep=True)
    text = F.col(f"_row.`{text_col}`")

    def step(acc, x):
        begin = F.greatest(acc["pos"], x["s"])  # spans may overlap
        end = F.greatest(acc["pos"], x["e"])
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.substring(text, acc["pos"] + 1, begin - acc["pos"]),
                                                   F.repeat(F.lit(mask), end - begin)).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    masked = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    new = F.when(F.size("spans") == 0, text).otherwise(masked)
    return found.select(*[(new if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
