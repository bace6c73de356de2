"""Licence scans by canonical digests, with built-in functions only.

A text is brought into one form: A-Z lower-cased, copyright statements dropped,
punctuation and white space between words made equal, equivalent spellings
replaced. The SHA-256 of the whole form is looked up among the digests of known
licence texts by a hash join. A document is looked up as a whole; each of its
lines as a text of its own, which is how short notices stand in documents; and
each of its paragraphs among those of the known texts, so that a whole licence is
found inside a longer document as well.
"""

from __future__ import annotations

import os
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.common import ascii_lower, id_text

# Spellings that licence texts may use for one another.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed",
    "licensor": "licenser", "copyright owner": "copyright holder", "favour": "favor",
    "fulfil": "fulfill", "organisation": "organization", "sublicence": "sublicense",
    "noncommercial": "non commercial", "ver": "version", "v2": "version 2", "v3": "version 3",
    "https": "http",
}
# Texts of licences and of the notices that stand for them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
#: Whole texts of common licences, a file each under its SPDX name.
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licenses")
MOST_KNOWN = 10_000


def texts_of(folder: str) -> list[tuple[str, str]]:
    """(licence, text) of each ``NAME.txt`` in a folder of the driver."""
    out = []
    for name in sorted(x for x in os.listdir(folder) if x.endswith(".txt")):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out.append((name.removesuffix(".txt"), f.read()))
    return out


NOTICES = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]
KNOWN = [*NOTICES, *texts_of(TEXTS)]

# Copyright statements, of lower-cased text. Each step is a pattern that Spark and
# the oracle read alike: no look-around, and none that can begin a long run more
# than once, so a step takes time in proportion to the text.
_MARK = r"(?:copyright\b|\(c\)|©)"
_GAP = r"[^\p{L}\p{N}\n]*"
#: a place where a statement ends, whatever stands before it
_NEXT = (r"(?:permission (?:is|to)\b|redistribution and\b|licen[cs]ed under\b|released under\b"
         r"|distributed under\b|this (?:work|program|software|file|project)\b|all rights reserved"
         r"|spdx-license|everyone is permitted)")
#: words that follow "copyright" in a licence's own text, where no holder is named
_BODY = (r"(?:notices?|holders?|owners?|licen[cs]\w*|laws?|statements?|interests?|protection|patents?"
         r"|trademarks?|disclaimers?|and|or|in|is|are|as|to|of|on|for|if|by law|you|your|any|a|an|the"
         r" (?:software|work|above|copyright|copies|name|program|licen[cs]\w*))\b")
_KEPT = "\ue001"  # before a line that begins like a statement and is none
_SHORT = r"(?:\p{L}|inc|ltd|co|corp|llc|jr|sr|dr|et al)"
STATEMENT_STEPS = [
    (r"[ \t\r\f\x0B]+", " "), (r" ?\n[ \n]*", "\n"),
    # a run of marks is one word
    (rf"{_MARK}(?:[^\p{{L}}\p{{N}}\n©(]*{_MARK})*", " copyright "), (r" +", " "),
    # a line for each sentence
    (rf"[.,;]? ({_NEXT})", "\n{1}"), (rf"([^\p{{L}}\p{{N}}]{_SHORT})\. ", "{1} "),
    (r"\. ", ".\n"),
    (rf"(^|\n)[^\p{{L}}\p{{N}}\n{_KEPT}]*copyright ({_BODY})", rf"{{1}}{_KEPT}copyright {{2}}"),
    # with a holder at a line's start, or with a year anywhere: up to the line's end
    (rf"(^|\n)[^\p{{L}}\p{{N}}\n{_KEPT}]*copyright {_GAP}[\p{{L}}\p{{N}}][^\n]*", "{1}"),
    (rf"copyright {_GAP}(?:(?:19|20)[0-9][0-9]|yyyy|year\b)[^\n]*", ""),
    (rf"all rights reserved{_GAP}(\n|$)", "{1}"),
]
HAS_STATEMENT = r"copyright|\(c\)|©|all rights reserved"
BLANK_LINE = r"\n[ \t\r]*\n"
WORDS = r"[^\p{L}\p{N}]+"


def _possessive(pattern: str) -> str:
    """The step for Java: the repeated group never gives back, so it loops
    without recursion. What follows it is optional or nothing."""
    return pattern.replace(f"{_MARK})*", f"{_MARK})*+")


def without_statements(text: Column) -> Column:
    """Lower-cased text without its copyright statements."""
    out = text
    for pattern, new in STATEMENT_STEPS:
        new = new.replace("{1}", "$1").replace("{2}", "$2")
        out = F.regexp_replace(out, _possessive(pattern), new)
    return F.when(text.rlike(HAS_STATEMENT), out).otherwise(text)


def canonical(text: Column) -> Column:
    """The text's one form: words with a blank on each side."""
    out = without_statements(ascii_lower(text))
    out = F.regexp_replace(F.concat(F.lit("."), out, F.lit(".")), WORDS, "  ")
    for a, b in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def paragraphs(text: Column) -> Column:
    """Digests of the paragraphs, in order, those without a word left out."""
    return F.filter(F.transform(F.split(text, BLANK_LINE, -1), digest),
                    lambda d: d != F.lit(NO_WORDS))


# Fixed value: the digest of the form that has no words, two blanks.
NO_WORDS = sha256(b"  ").hexdigest()


def _known(spark: SparkSession, known: list[tuple[str, str]] | None) -> DataFrame:
    known = KNOWN if known is None else known
    if len(known) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    return spark.createDataFrame([(i, *k) for i, k in enumerate(known)],
                                 "known int, license string, text string")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """license, digest of at most ``MOST_KNOWN`` texts; texts of one form are
    one row, under the first licence by name."""
    return (_known(spark, known).select("license", digest(F.col("text")).alias("digest"))
            .groupBy("digest").agg(F.min("license").alias("license")))


def known_paragraphs(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """known, license, digest, at, of: the paragraphs, numbered, of the known
    texts that have two or more."""
    own = _known(spark, known).select("known", "license", paragraphs(F.col("text")).alias("p"))
    return own.filter(F.size("p") > 1).select(
        "known", "license", F.size("p").alias("of"), F.posexplode("p").alias("at", "digest"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license, notices, n_notices, embedded: a row for
    each input row.

    ``license`` is the known licence that the whole text is (else null),
    ``notices`` the distinct licences that its lines are, sorted and
    comma-joined, ``n_notices`` the number of such lines, ``embedded`` the
    distinct licences whose whole text stands in it paragraph after paragraph,
    whatever comes before or after. A null text is empty; texts without words
    have one form and no licence. Repeated rows and null doc_ids all come back,
    no rows give none, other columns are ignored.
    """
    spark, text = docs.sparkSession, F.col("text")
    unit = lambda kind, at, d: F.struct(F.lit(kind).alias("kind"), at.alias("at"),
                                        d.alias("digest"))
    lines = F.transform(F.split(text, "\n"), digest)
    units = F.concat(
        F.array(unit("whole", F.lit(0), digest(text))),
        F.transform(F.filter(lines, lambda d: d != F.lit(NO_WORDS)),
                    lambda d: unit("line", F.lit(0), d)),
        F.when(text.rlike(BLANK_LINE), F.transform(
            paragraphs(text), lambda d, i: unit("paragraph", i, d)))
        .otherwise(F.array().cast("array<struct<kind:string,at:int,digest:string>>")))
    rows = (id_text(docs).withColumn("row", F.monotonically_increasing_id())
            .select("row", "doc_id", F.explode(units).alias("u")).select("row", "doc_id", "u.*"))
    # one look-up: the known texts and paragraphs of a digest, a few hundred rows
    texts = known_digests(spark, known)
    own = F.struct("known", "license", "of", F.col("at").alias("known_at"))
    table = (texts.join(known_paragraphs(spark, known).groupBy("digest")
                        .agg(F.collect_list(own).alias("parts")), "digest", "full"))
    found = rows.join(F.broadcast(table), "digest", "left")
    line = F.when(F.col("kind") == "line", F.col("license"))
    # a paragraph's places in known texts, each with where that text would begin
    begins = F.transform(
        F.when(F.col("kind") == "paragraph", F.col("parts")),
        lambda p: F.struct(p["known"].alias("known"), p["license"].alias("license"),
                           p["of"].alias("of"), (F.col("at") - p["known_at"]).alias("begins"),
                           p["known_at"].alias("at")))
    # a document's units lie in one partition: one row of it is shuffled
    by = found.groupBy("row", "doc_id").agg(
        F.max(F.when(F.col("kind") == "whole", F.col("digest"))).alias("canonical_sha256"),
        F.max(F.when(F.col("kind") == "whole", F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(line)), ",").alias("notices"),
        F.count(line).alias("n_notices"), F.flatten(F.collect_list(begins)).alias("hits"))
    return by.select("doc_id", "canonical_sha256", "license", "notices", "n_notices",
                     _complete(F.col("hits")).alias("embedded"))


def _complete(hits: Column) -> Column:
    """The licences of which every paragraph was found in its place. Sorted, the
    hits of one text and beginning follow each other; a paragraph stands in one
    place, so none is there twice, and a run as long as the text is all of it."""
    whole = F.struct(F.lit(-1).alias("known"), F.lit("").alias("license"), F.lit(0).alias("of"),
                     F.lit(0).alias("begins"), F.lit(0).alias("n"),
                     F.array().cast("array<string>").alias("found"))

    def step(a: Column, h: Column) -> Column:
        same = (a["known"] == h["known"]) & (a["begins"] == h["begins"])
        n = F.when(same, a["n"] + 1).otherwise(1)
        found = F.when(n == h["of"], F.array_append(a["found"], h["license"])).otherwise(a["found"])
        return F.struct(h["known"].alias("known"), h["license"].alias("license"),
                        h["of"].alias("of"), h["begins"].alias("begins"), n.alias("n"),
                        found.alias("found"))

    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(
        h["known"].alias("known"), h["license"].alias("license"), h["of"].alias("of"),
        h["begins"].alias("begins"))))
    return F.aggregate(ordered, whole, step, lambda a: F.array_join(
        F.array_sort(F.array_distinct(a["found"])), ","))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same in DuckDB SQL, by the same steps."""
    def form(text: str) -> str:
        out = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        for pattern, new in STATEMENT_STEPS:
            new = new.replace("{1}", "\\1").replace("{2}", "\\2")
            out = f"regexp_replace({out}, {_sql_text(pattern)}, {_sql_text(new)}, 'g')"
        out = f"regexp_replace('.' || {out} || '.', {_sql_text(WORDS)}, '  ', 'g')"
        for a, b in SPELLINGS.items():
            out = (f"replace({out}, {_sql_text(' ' + a.replace(' ', '  ') + ' ')}, "
                   f"{_sql_text(' ' + b.replace(' ', '  ') + ' ')})")
        return f"sha256({out})"

    known = ", ".join(f"({i}, {_sql_text(a)}, {_sql_text(b)})" for i, (a, b) in enumerate(KNOWN))
    split = f"string_split_regex({{}}, {_sql_text(BLANK_LINE)})"
    return f"""
with texts as (select * from (values {known}) k(known, license, body)),
known as (select min(license) as license, {form('body')} as digest from texts group by 2),
known_parts as (
  select known, license, digest, row_number() over (partition by known order by i) as at,
         count(*) over (partition by known) as of_all
  from (select known, license, i, {form('part')} as digest
        from (select known, license, unnest({split.format('body')}) as part,
                     generate_subscripts({split.format('body')}, 1) as i from texts))
  where digest <> '{NO_WORDS}'),
docs as (select row_number() over () as r, doc_id, coalesce(text, '') as body from documents),
units as (
  select r, true as whole, body from docs
  union all select r, false, unnest(string_split(body, chr(10))) from docs),
marked as (select r, whole, {form('body')} as digest from units),
parts as (
  select r, digest, row_number() over (partition by r order by i) as at
  from (select r, i, {form('part')} as digest
        from (select r, unnest({split.format('body')}) as part,
                     generate_subscripts({split.format('body')}, 1) as i from docs))
  where digest <> '{NO_WORDS}'),
inside as (
  select distinct r, license from (
    select r, known, license, p.at - k.at as begins, any_value(of_all) as of_all, count(*) as n
    from parts p join known_parts k on p.digest = k.digest and of_all > 1 group by 1, 2, 3, 4)
  where n = of_all),
embedded as (select r, string_agg(license, ',' order by license) as licenses from inside group by r),
found as (
  select r, max(case when whole then m.digest end) as canonical_sha256,
         max(case when whole then license end) as license,
         coalesce(string_agg(distinct case when not whole then license end, ','
                  order by case when not whole then license end), '') as notices,
         count(case when not whole then license end) as n_notices
  from marked m left join known k on m.digest = k.digest group by r)
select doc_id, canonical_sha256, license, notices, n_notices, coalesce(licenses, '') as embedded
from found join docs using (r) left join embedded using (r)
"""
