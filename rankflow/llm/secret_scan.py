"""Secret scans: fixed formats, and character Markov models of random strings
against ordinary identifiers. Built-in functions only.

The models are first-order, over 66 characters, add-one smoothed. Their
labelled samples come from a bounded sample of the documents: what the fixed
formats match there, and hashes of the sample's own texts written in hex and
base 64, are random strings; every other run of four or more of those
characters is an identifier. A run of ``MIN_RUN`` or more characters whose log-likelihood
ratio is above ``THRESHOLD`` is reported as kind ``markov``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import id_text

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
MIN_RUN = 12
RUN = f"[A-Za-z0-9+/_-]{{{MIN_RUN},}}"
SAMPLE_ROWS = 2000
THRESHOLD = 15.0
MASK = "[SECRET]"


@dataclass(frozen=True)
class RandomnessModel:
    """Log-likelihood ratios, random over identifier, in nats. ``table`` has
    one for each two characters at ``128 * ascii(first) + ascii(second)``."""

    table: tuple[float, ...]

    def score(self, run: Column) -> Column:
        chars = F.transform(F.split(run, ""), F.ascii)
        table = F.from_json(F.lit(json.dumps(self.table)), "array<double>")  # folded to a constant
        return F.aggregate(
            F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars)),
                       lambda a, b: F.coalesce(F.get(table, a * 128 + b), F.lit(0.0))),
            F.lit(0.0), lambda total, x: total + x)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RandomnessModel:
    """Fit both models on about ``sample_rows`` documents, chosen by a hash of
    the doc_id. With no documents every ratio is 0, so no run is reported."""
    rows = id_text(docs)
    every = max(1, rows.count() // sample_rows)
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("secrets"), "doc_id"), F.lit(every)) == 0)
    text = F.col("text")
    digest = F.sha2(text, 512)
    values = F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)),
                      lambda v: F.length(v) >= 12)
    made = F.array(F.regexp_replace(F.base64(F.unhex(digest)), "[=\r\n]", ""), digest,
                   F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)))
    is_random = F.concat(values, F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
                         F.regexp_extract_all(text, F.lit(HEX), F.lit(0)), made)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    runs = sample.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), is_random.alias("runs")),
        F.struct(F.lit(0).alias("random"),
                 F.regexp_extract_all(plain, F.lit("[A-Za-z0-9+/_-]{4,}"), F.lit(0)).alias("runs")),
    )).alias("x")).select("x.random", F.explode("x.runs").alias("run"))
    chars = F.split("run", "")
    pairs = runs.select("random", F.explode(F.zip_with(
        F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars)),
        lambda a, b: F.concat(a, b))).alias("two"))
    # two rows for each two of 128 characters at most
    counts = (pairs.filter(F.col("two").rlike("^[A-Za-z0-9+/_-]{2}$"))
              .groupBy("random", "two").agg(F.count(F.lit(1)).alias("n")).collect())
    seen: tuple[dict, dict] = ({}, {})
    for row in counts:
        seen[row.random].setdefault(row.two[0], {})[row.two[1]] = row.n
    table = [0.0] * (128 * 128)
    for a in SYMBOLS:
        plain_n, random_n = (x.get(a, {}) for x in seen)
        if not any(seen):
            continue
        for b in SYMBOLS:
            p = (random_n.get(b, 0) + 1) / (sum(random_n.values()) + len(SYMBOLS))
            q = (plain_n.get(b, 0) + 1) / (sum(plain_n.values()) + len(SYMBOLS))
            ratio = round(math.log(p / q), 4)
            # the steps of an alphabet, as in abcdef, are no sign of a random string
            table[128 * ord(a) + ord(b)] = min(ratio, 0.0) if ord(b) == ord(a) + 1 else ratio
    return RandomnessModel(tuple(table))


def _found(text: Column, kind: int, pattern: str, ok) -> Column:
    """For each match of ``pattern``: the length of what lies between it and
    the match before, its own length, and whether it counts."""
    group = 1 if kind == 0 else 0
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    each = F.transform(F.arrays_zip(matches.alias("m"), gaps.alias("g"), tested.alias("t")),
                       lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x.g).alias("gap"),
                                          F.length(x.m).alias("len"), ok(x.t).alias("ok")))
    each = F.filter(each, lambda x: x.len.isNotNull())  # the text after the last match
    return F.when(text.rlike(pattern), each).otherwise(F.array().cast(
        "array<struct<kind:int,gap:int,len:int,ok:boolean>>"))


def _rules(model: RandomnessModel, threshold: float):
    yes = lambda t: F.lit(True)
    return [(0, ASSIGN, lambda t: F.length(t) >= 12), (1, ACCESS, yes), (2, HEX, yes),
            (3, RUN, lambda t: model.score(t) > threshold)]


def scan(docs: DataFrame, model: RandomnessModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, spans: a row for each input row. ``spans`` is an array of
    struct(start, kind_no, end) in code points, end exclusive, by start and
    kind (``KINDS``).

    The fixed formats match leftmost and without overlap within their kind;
    an assignment whose value is short still uses up its text. ``markov`` spans
    may overlap the others. A null text is empty; texts without matches, empty
    ones included, have no spans; repeated rows and null doc_ids all come back;
    an empty table gives no rows; other columns are ignored.
    """
    text = F.col("text")
    found = F.concat(*[_found(text, *rule) for rule in _rules(model, threshold)])
    # from here on rows are narrow: the text is not shuffled
    hits = (id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                 found.alias("found"))
            .select("row", "doc_id", F.posexplode_outer("found").alias("at", "hit"))
            .select("row", "doc_id", "at", "hit.*"))
    before = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("len")).over(before)
    spans = hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    span = F.when(F.col("ok"), F.struct("start", F.col("kind").alias("kind_no"), "end"))
    return (spans.groupBy("row", "doc_id")
            .agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("row"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.kind_no), s.start.cast("string"), s.end.cast("string"))), ",")


def report(spans: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans that ``scan`` found."""
    base = F.filter("spans", lambda s: s.kind_no < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind_no == k)).cast("long")
    return spans.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, model: RandomnessModel, threshold: float = THRESHOLD,
         mark: str = MASK) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced, kind after kind; nothing
    else changes, and a null text stays null."""
    for kind, pattern, ok in _rules(model, threshold):
        text = F.col("text")
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == 0 else matches
        pieces = F.transform(
            F.arrays_zip(F.split(text, pattern, -1).alias("g"), matches.alias("m"),
                         tested.alias("t")),
            _masked_by(ok, mark))
        docs = docs.withColumn(
            "text", F.when(text.rlike(pattern), F.array_join(pieces, "")).otherwise(text))
    return docs


def _masked_by(ok, mark: str):
    """A piece between matches and the match after it, which may be missing."""
    return lambda x: F.concat(x.g, F.when(x.m.isNull(), "").when(ok(x.t), mark).otherwise(x.m))
