"""SpotSigs fingerprints, with built-in functions only.

A spot is an anchor: a very common word, the beginning of the text, or a word
whose hash says so (one in ``RARE_ANCHORS``, so that texts without common words
have spots too). Its signature is the anchor and the chain of the next ``CHAIN``
content words, those that are not common, within ``REACH`` words. The set of a
text's signatures, hashed, is its fingerprint; likeness is the Jaccard of sets.

Pairs are found among sets of similar length only: sets are dealt to length
classes whose bounds grow by 1 / ``least``, so a pair that is near enough lies
in one class or in two neighbouring ones. Within them a pair must share one of
the rarest signatures of both sets, and lengths that rule the likeness out are
discarded before the sets are compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import id_text, partitions
from rankflow.session import materialize

# Common words of four languages.
ANCHORS = {
    "en": "a an and are as at be but by for from had has have he her his in is it its not of on "
          "or she that the their there they this to was were which will with would you",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous "
          "on ou par pas pour qu que qui sa se ses son sur un une vous y",
    "de": "als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er "
          "es im in ist mit nach nicht sich sie sind und von vor war wie zu zum zur",
    "es": "al como con de del el en es esta este fue ha la las lo los mas no o para pero por que "
          "se sin sobre su sus un una y ya",
}
CHAIN = 2
REACH = 12
RARE_ANCHORS = 16


def common_words(anchors: dict[str, str] | None = None) -> list[str]:
    return sorted({w for words in (anchors or ANCHORS).values() for w in words.split()})


def signatures(text: Column, chain: int = CHAIN, reach: int = REACH,
               anchors: dict[str, str] | None = None) -> Column:
    """The text's signatures as a sorted array of distinct integers. Never
    empty: a text without content words has the hash of the whole text."""
    common = common_words(anchors)
    is_common = lambda w: w.isin(common)
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def spots(words: Column) -> Column:
        def spot(w: Column, i: Column) -> Column:
            after = F.filter(F.slice(words, i + 2, reach), lambda x: ~is_common(x))
            return F.when(is_common(w) | (F.pmod(F.hash(w), F.lit(RARE_ANCHORS)) == 0),
                          F.hash(w, F.slice(after, 1, chain)))
        return F.filter(F.transform(words, spot), lambda x: x.isNotNull())

    head = F.filter(F.slice(words, 1, reach), lambda x: ~is_common(x))
    first = F.when(F.size(head) > 0, F.array(F.hash(F.lit("^"), F.slice(head, 1, chain)))
                   ).otherwise(F.array(F.hash(F.lit("^^"), text)))
    # a one-element array and its lambda bind the words once
    found = F.flatten(F.transform(F.array(words), spots))
    return F.sort_array(F.array_distinct(F.concat(first, found)))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets. Below ``least`` by their lengths alone it
    is 0 and the sets are not compared."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return exact if least <= 0 else F.when(small >= large * least, exact).otherwise(0.0)


def text_of(signatures: Column) -> Column:
    """The fingerprint as a string: eight hex digits a signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(
        F.lower(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def near_pairs(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, set_id) and pairs (a, b, likeness; a < b) of set_ids
    whose signature sets have a likeness of ``least`` or more.

    Equal sets are one set, so copies make no pairs. Null texts are empty, null
    doc_ids and repeated rows are members like any other; no rows, no pairs.
    """
    prints = id_text(docs).select("doc_id", signatures(F.col("text")).alias("sigs"))
    rows = materialize(prints.withColumn("set_id", F.sha2(F.to_json("sigs"), 256)), "spotsigs")
    sets = rows.groupBy("set_id").agg(F.first("sigs").alias("sigs")).withColumn(
        "n", F.size("sigs"))
    sets = materialize(sets, "spotsigs_sets")
    each = sets.select("set_id", "n", F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    # a near pair shares one of the n - ceil(least * n) + 1 rarest signatures of both
    order = Window.partitionBy("set_id").orderBy("often", "sig")
    rare = (each.join(often, "sig").withColumn("at", F.row_number().over(order))
            .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
            .withColumn("length", F.floor(F.log(F.col("n").cast("double"))
                                          / math.log(1 / least) + 1e-9)))
    rare = materialize(rare.select("set_id", "n", "sig", "length"), "spotsigs_rare")
    lower = rare.withColumn("length", F.explode(F.array(F.col("length"), F.col("length") + 1)))
    a, b = lower.alias("a"), rare.alias("b")
    shorter = (F.col("a.n") < F.col("b.n")) | (
        (F.col("a.n") == F.col("b.n")) & (F.col("a.set_id") < F.col("b.set_id")))
    found = (a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.length") == F.col("b.length"))
                    & shorter & (F.col("a.n") >= F.col("b.n") * least))
             .select(F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y")).distinct())
    mine = sets.select(F.col("set_id").alias("x"), F.col("sigs").alias("sx"))
    other = sets.select(F.col("set_id").alias("y"), F.col("sigs").alias("sy"))
    pairs = (found.join(mine, "x").join(other, "y")
             .withColumn("likeness", likeness(F.col("sx"), F.col("sy"), least))
             .filter(F.col("likeness") >= least)
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness"))
    return rows.select("doc_id", "set_id"), pairs


#: A document's key without nulls: whether it has a doc_id, the doc_id or 0, a
#: hash of its text. Ascending, documents without a doc_id come first.
KEY = ["known", "id", "part"]


def successors(keys: DataFrame) -> DataFrame:
    """``keys`` (KEY, n, copies; unique by KEY) with ``next``, a struct of the
    following key and its n in ascending order; after the last the first.
    Ranges are sorted side by side; only each range's first key, one row a
    partition, is put in one order."""
    spark = keys.sparkSession
    item = F.struct(*KEY, "n")
    ranged = materialize(
        keys.repartitionByRange(partitions(spark), *KEY)
        .withColumn("range", F.spark_partition_id()), "spotsigs_ranges")
    firsts = ranged.groupBy("range").agg(F.min(item).alias("first"))
    along = Window.orderBy("range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("range", F.coalesce(
        F.lead("first").over(along), F.first("first").over(whole)).alias("beyond"))
    inside = F.lead(item).over(Window.partitionBy("range").orderBy(*KEY))
    return (ranged.withColumn("inside", inside).join(firsts, "range")
            .select(*KEY, "n", "copies", F.coalesce("inside", "beyond").alias("next")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, signatures: a row for each input row.

    The edited text is the text with its last floor(n_chars / 2) code points
    replaced by the first as many (or all) of the next document by doc_id; the
    last document is followed by the first, and a document alone by itself. A
    null text is empty. Null doc_ids come first; of rows with one doc_id the
    hash of the text decides, and rows that repeat doc_id and text all come
    back with the next other one. No rows give none; other columns are ignored.
    """
    # every join below is by the whole key, so that the texts are shuffled once
    rows = id_text(docs).select(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("part"), "text")
    keys = (rows.select(*KEY, F.char_length("text").alias("n"))
            .groupBy(*KEY, "n").agg(F.count(F.lit(1)).alias("copies")))
    order = materialize(successors(keys), "spotsigs_order")
    texts = rows.dropDuplicates(KEY)
    half = lambda n: F.floor(n / 2).cast("int")

    # as the next of another: what that one needs of this text
    wanted = order.select(*[F.col(f"next.{k}").alias(k) for k in KEY],
                          F.struct(*KEY).alias("to"), half(F.col("n")).alias("need"))
    given = texts.join(wanted, KEY).select(
        "to.*", F.substring("text", F.lit(1), F.col("need")).alias("head"),
        signatures(F.col("text")).alias("next_sigs"))
    own = texts.join(order.select(*KEY, "n", "copies"), KEY)
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half(F.col("n"))), F.col("head"))
    return (
        own.join(given, KEY)
        .select(F.when(F.col("known"), F.col("id")).alias("doc_id"), "n", "copies", "next_sigs", signatures(F.col("text")).alias("sigs"),
                edited.alias("edited"))
        .select("*", signatures(F.col("edited")).alias("edited_sigs"))
        .select(
            "doc_id", F.col("n").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"), text_of(F.col("sigs")).alias("fingerprint"),
            text_of(F.col("edited_sigs")).alias("edited_fingerprint"),
            likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
            likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
            F.size("sigs").cast("long").alias("signatures"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .drop("copy")
    )
