"""Secret scans with column functions only: fixed patterns, and entropy in sliding windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import let, running

# The three base patterns.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
# The same matches, found sooner. Access and hex matches end with their run of characters, so the
# shortest length can stand in the pattern, and a run is entered at its begin only.
QUICK = {
    "assign": r"(?=[PpSsTtAa])" + BASE[0][1],
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
}
#: A text must hold this if any match of ``assign`` passes.
_ASSIGN_PASSES = r"""(?=[PpSsTtAa])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}"""
KINDS = [*(b[0] for b in BASE), "entropy"]

# Candidate strings, what makes one harmless, and bits per character by class.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALLOWED = [
    r"^[^0-9]*$",  # no digit
    r"^[0-9_=/+-]*$",  # no letter
    r"(?i)example|sample|placeholder|changeme|dummy|lorem",
    r"(.)\1{7}",  # filler
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # a UUID
    r"^(?:[A-Za-z]+|[0-9]+)(?:[/_=+-](?:[A-Za-z]+|[0-9]+))+$",  # words and numbers joined
]
CLASSES = [("^[0-9a-fA-F]+$", 3.05), ("^[A-Za-z0-9]+$", 3.55), ("", 3.75)]
WINDOW = 20

_SPAN = "struct<start:int,kind:int,end:int>"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost, non-overlapping matches with their code point positions.

    Column functions give matches without positions, so these are summed up from the lengths of
    the matches and of what stands between them.
    """
    gaps, wholes = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)

    def placed(m: Column) -> Column:
        sizes = F.transform(m["gaps"], lambda g, i: F.length(g) + F.coalesce(F.length(F.get(m["wholes"], i)), F.lit(0)))
        start = lambda b, i: F.get(b, i) + F.length(F.get(m["gaps"], i))
        one = lambda b, w, i: F.struct(start(b, i).alias("start"), (start(b, i) + F.length(w)).alias("end"), w.alias("whole"), (F.get(m["parts"], i) if group else w).alias("part"))
        return let(running(sizes), lambda b: F.transform(m["wholes"], lambda w, i: one(b, w, i)))

    parts = [F.regexp_extract_all(text, F.lit(pattern), group).alias("parts")] if group else []
    return let(F.struct(gaps.alias("gaps"), wholes.alias("wholes"), *parts), placed)


def entropy_range(word: Column, least: Column, window: int = WINDOW) -> Column:
    """First and last code point of the windows of ``word`` with ``least`` bits a character or more, or null.

    The counts of the characters + to z move with the window, as letters of one string (A for 0):
    one character enters, one leaves, so two counts change, and the sum of ``c * log2(c)`` by
    their terms only.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    most = math.log2(window)
    state = F.struct(F.lit("A" * 80).alias("n"), F.lit(0.0).alias("s"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(acc: Column, i: Column, codes: Column) -> Column:  # i: number of characters read
        place = lambda k: F.get(codes, k - 1)
        count = lambda at: F.ascii(F.substr(acc["n"], at, F.lit(1))) - 65
        put = lambda n, at, c: F.overlay(n, F.char(c + 65), at, F.lit(1))
        term = lambda c: F.get(terms, c)

        def moved(x: Column) -> Column:
            grown = put(acc["n"], x["come"], x["had"] + 1)
            n = F.when(x["come"] == x["gone"], acc["n"]).when(x["gone"] > 0, put(grown, x["gone"], x["lost"] - 1)).otherwise(grown)
            s = F.when(x["come"] == x["gone"], acc["s"]).otherwise(acc["s"] + term(x["had"] + 1) - term(x["had"]) + F.when(x["gone"] > 0, term(x["lost"] - 1) - term(x["lost"])).otherwise(0.0))
            return F.struct(n.alias("n"), s.alias("s"))

        ends = let(F.struct(place(i).alias("come"), F.when(i > window, place(i - window)).otherwise(0).alias("gone")), lambda x: F.struct(x["come"].alias("come"), x["gone"].alias("gone"), count(x["come"]).alias("had"), F.when(x["gone"] > 0, count(x["gone"])).otherwise(0).alias("lost")))

        def judged(x: Column) -> Column:
            hit = (i >= window) & (most - x["s"] / window >= least)
            return F.struct(x["n"].alias("n"), x["s"].alias("s"), F.when(hit & (acc["first"] < 0), i - window).otherwise(acc["first"]).alias("first"), F.when(hit, i).otherwise(acc["last"]).alias("last"))

        return let(let(ends, moved), judged)

    told = lambda a: F.when(a["last"] >= 0, F.struct(a["first"].alias("first"), a["last"].alias("last")))
    read = lambda codes: F.aggregate(F.sequence(F.lit(1), F.size(codes)), state, lambda acc, i: step(acc, i, codes), told)
    return let(F.transform(F.split(word, ""), lambda c: F.ascii(c) - 42), read)


def _spans(rows: Column, kind: int) -> Column:
    return F.transform(rows, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))).cast(f"array<{_SPAN}>")


def _written(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["end"])), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """One row per input row: id, ``n_assign, n_access, n_hex, n_entropy, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` in code points (end exclusive) by start, then kind. The base
    kinds are matched on the whole text and never suppressed. ``entropy`` spans reach from the
    first to the last window of a candidate string that is random enough for its class (hex,
    letters and digits, base64), unless an ``allowed`` pattern is found in the candidate.

    A null or empty text has no spans; repeated rows give repeated results; other columns are not
    read. No shuffle, no Python: one pass over each text, in its own task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    for k, (kind, _, group, least) in enumerate(BASE):
        passing = F.filter(found(F.col("text"), QUICK[kind], group), lambda m: F.length(m["part"]) >= least)
        gate = _ASSIGN_PASSES if group else QUICK[kind]
        rows = rows.withColumn(kind, F.when(F.col("text").rlike(gate), _spans(passing, k)).otherwise(none))

    allow = ALLOWED if allowed is None else allowed
    harmless = lambda w: F.coalesce(*[F.when(w.rlike(p), True) for p in allow], F.lit(False))
    least = lambda w: F.when(w.rlike(CLASSES[0][0]), CLASSES[0][1]).when(w.rlike(CLASSES[1][0]), CLASSES[1][1]).otherwise(CLASSES[2][1])
    candidates = F.filter(found(F.col("text"), _CANDIDATE), lambda m: ~harmless(m["whole"]))
    ranges = F.transform(candidates, lambda m: let(least(m["whole"]), lambda bits: F.struct(m["start"].alias("at"), entropy_range(m["whole"], bits, window).alias("r"))))
    hot = F.transform(F.filter(ranges, lambda x: x["r"].isNotNull()), lambda x: F.struct((x["at"] + x["r"]["first"]).alias("start"), (x["at"] + x["r"]["last"]).alias("end")))
    rows = rows.withColumn("entropy", F.when(F.col("text").rlike(_CANDIDATE), _spans(hot, 3)).otherwise(none))

    base = F.concat("assign", "access", "hex")
    return rows.select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, F.col("entropy"))).alias("spans"),
    )
