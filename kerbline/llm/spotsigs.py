"""Document fingerprints by spot signatures, in DataFrame functions only.

A text is lower-cased and split into words of letters and digits. A common word (an anchor) with the next ``CHAIN`` content
words after it, common words skipped, is a spot signature; so are the chains at the first ``OPENING`` content words, which
gives texts without anchors a fingerprint too. The fingerprint is the sorted set of eight hexadecimal digits of the
signatures' md5, parted by spaces, so likeness is the Jaccard similarity of two fingerprints as sets. Near-duplicate
search (``near_pairs``) puts sets into partitions by length, in which only neighbours can be similar, and compares only
sets that share one of their rarest signatures and whose lengths allow the threshold.

The next document in id order comes from cells of an id range: the bounds are approximate quantiles of the ids (at most
``MAX_CELLS``, whatever the size), a row that opens a cell is sent to the cell before as well, and each cell is a window of its own.

Defined cases: null text is the empty text, and its fingerprint is empty; two empty sets have likeness 1; null ids come
before all others; equal ids are ordered by text; a lone row is its own successor; repeated rows are separate documents; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbline.llm.common import land
from kerbline.shared import attach

# The anchors, the most common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he her his i in is it not of on or she that the their they this to was we were "
    "which with you als auf aus bei das dass dem den der des die ein eine er es für ich ihr im ist mit nicht sich sie sind "
    "und von war werden wie wir zu zum au aux avec ce ces cette dans de du elle en est et il je la le les leur mais ne nous "
    "ou par pas plus pour que qui sa se ses son sont sur un une vous al como con del el ella entre era esta fue ha las lo "
    "los más muy no nos o para pero por se sin son su sus todo una uno y ya"
).split()
CHAIN = 3
OPENING = 8
CELL_ROWS = 500
MAX_CELLS = 1 << 16


def with_fingerprint(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the fingerprint of a text column that is never null."""
    anchors = list(dict.fromkeys(ANCHORS))
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    # A unit is a content word with the common words before it: "of the house"; common words at the end are left over.
    joined = F.array_join(F.transform(words, lambda w: F.when(w.isin(anchors), F.concat(w, F.lit(" "))).otherwise(F.concat(w, F.lit("\n")))), "")
    units = F.split(joined, "\n")
    docs = docs.withColumn("_units", F.slice(units, F.lit(1), F.size(units) - 1))
    docs = docs.withColumn("_content", F.transform("_units", lambda u: F.substring_index(u, " ", -1)))

    def chain(u, i):
        rest = [F.coalesce(F.get("_content", i + k), F.lit("")) for k in range(CHAIN)]
        anchor = F.substring_index(F.substring_index(u, " ", -2), " ", 1)
        opens = F.when(u.contains(" "), anchor).when(i < OPENING, F.lit("^"))
        return F.when(opens.isNotNull(), F.substring(F.md5(F.concat_ws(" ", opens, *rest)), 1, 8))

    spots = F.array_distinct(F.filter(F.transform("_units", chain), lambda x: x.isNotNull()))
    return docs.withColumn(out, F.array_join(F.sort_array(spots), " ")).drop("_units", "_content")


def signatures(fingerprint):
    """The set in a fingerprint column."""
    return F.when(fingerprint == "", F.array().cast("array<string>")).otherwise(F.split(fingerprint, " "))


def likeness(a, b):
    """Jaccard similarity of two fingerprints; the larger set's length bounds it, so a set beside an empty one is 0 at once."""
    left, right = signatures(a), signatures(b)
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(both / either)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the next row by (doc_id, text); the first row follows the last."""
    keyed = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))))
    rows = keyed.count()
    cells = max(1, min(MAX_CELLS, rows // CELL_ROWS))
    steps = [k / cells for k in range(cells)]
    bounds = keyed.agg(F.array_distinct(F.percentile_approx("_key", steps, max(10000, 4 * cells))).alias("_bounds"))
    keyed = attach(keyed, land(bounds, "id-bounds"))
    # The last bound that is not above the key, by halving.
    size = F.size("_bounds")
    halvings = F.array(*[F.lit(1 << k) for k in range(MAX_CELLS.bit_length(), -1, -1)])
    place = F.aggregate(
        halvings, F.lit(0), lambda at, k: F.when((at + k < size) & (F.get("_bounds", at + k) <= F.col("_key")), at + k).otherwise(at)
    )
    keyed = keyed.withColumn("_cell", place).withColumn("_last", size - 1)
    opens = F.get("_bounds", F.col("_cell")) == F.col("_key")
    before = F.when(F.col("_cell") == 0, F.col("_last")).otherwise(F.col("_cell") - 1)
    # The lowest bound is the smallest key, or rows below it share its cell and order.
    opens = opens | (F.col("_cell") == 0) & (F.col("_key") <= F.get("_bounds", F.lit(0)))
    copies = F.when(opens, F.array(F.struct(F.col("_cell").alias("c"), F.lit(0).alias("sent")), F.struct(before.alias("c"), F.lit(1).alias("sent"))))
    copies = copies.otherwise(F.array(F.struct(F.col("_cell").alias("c"), F.lit(0).alias("sent"))))
    dealt = keyed.withColumn("_copy", F.explode(copies))
    dealt = dealt.select(*docs.columns, "_key", F.col("_copy.c").alias("_to"), F.col("_copy.sent").alias("_sent"))
    # One select, so that all columns share one window and the texts are exchanged once.
    ordered = Window.partitionBy("_to").orderBy("_sent", "_key", "text")
    followed = dealt.select("*", *[F.lead(c).over(ordered).alias(f"next_{c}") for c in columns])
    return followed.filter("_sent = 0").drop("_key", "_to", "_sent")


def edited_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, the fingerprints of text and edited text and their likeness, for every row of doc_id, text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = with_next(with_fingerprint(texts, "text", "fingerprint"), ["text", "fingerprint"])
    n = F.length("text")
    replaced = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - replaced), F.substr("next_text", F.lit(1), replaced))
    marked = marked.withColumn("edited", edited).withColumn("n_chars", n.cast("bigint")).drop("text", "next_text")
    marked = with_fingerprint(marked, "edited", "edited_fingerprint")
    return marked.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def near_pairs(marked: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Pairs (a, b, likeness) of classes of equal fingerprints at or above a threshold; a < b are their smallest ids.

    ``marked`` holds doc_id and fingerprint. Partition p holds set lengths from threshold**-p on; a set is compared in its
    own partition and the next one, where a similar set of up to 1/threshold times its length is.
    """
    classes = marked.filter("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    sets = classes.select("doc_id", signatures(F.col("fingerprint")).alias("s")).withColumn("n", F.size("s"))
    sets = land(sets.withColumn("part", F.floor(F.log("n") / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")), "spot-sets")
    counts = sets.select(F.explode("s").alias("spot")).groupBy("spot").agg(F.count("*").alias("sets")).filter("sets > 1")
    shared = sets.select("doc_id", "n", "part", F.explode("s").alias("spot")).join(counts, "spot")
    # Rarest first; the signatures of one set alone come before all shared ones and fill the prefix without being joined.
    order = Window.partitionBy("doc_id").orderBy(F.desc("sets"), F.desc("spot"))
    needed = F.ceil(F.col("n") * threshold - 1e-9)
    prefix = shared.withColumn("from_end", F.row_number().over(order)).filter(F.col("from_end") >= needed)
    left = prefix.select("spot", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = prefix.select("spot", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), "part")
    near = (F.col("a") != F.col("b")) & ((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, ["spot", "part"]).filter(near & (F.col("n_a") >= threshold * F.col("n_b") - 1e-9)).select("a", "b").distinct()
    one, two = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("s_a")), sets.select(F.col("doc_id").alias("b"), F.col("s").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    like = both / (F.size("s_a") + F.size("s_b") - both)
    return (
        pairs.join(one, "a").join(two, "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), like.alias("likeness"))
        .filter(F.col("likeness") >= threshold)
    )
