"""Mixing sources to target weights by weighted fair queueing.

Sources, ordered by code point with null last, weigh 5, 2, 1, repeating. They share a budget of 150 % of all words;
a target stops at ``REPEATS`` times its source's words and the excess goes to the others by weight, until none is above.
With caps c and weights w, targets are min(c, level * w), and the level is the largest of
(budget - caps of the k tightest) / (weights of the rest) over all k, found in one pass over the table of sources.

Every source is shuffled by the md5 of its ids. A document's virtual finish time is the words its source has sent up
to its end, the passes before included, divided by the source's target. All sources then reach their targets at time
1, where the budget ends: documents that finish by then are taken whole, the one across it up to the remaining words.
The mix is the range sort of all taken copies by finish time.

Running words need no window over a source: words are summed per (source, first three hex digits of the md5), the few
sums are accumulated per source, and rows are accumulated within their cell. A source with a third of all rows is 4096
cells like any other. One task sees the table of sources (one row each), which is never broadcast unless counted.

Defined cases: null text has no words; null ids are shuffled by their text; a null source is a source; documents
without words finish with their predecessor and take nothing; rows that are equal share their place in any order;
other columns pass untouched; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kerbline.llm.common import _SPACE, land, pieces
from kerbline.shared import sized

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEATS = 2
CELL_DIGITS = 3


def with_sizes(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Row (all columns, or those to carry, as a struct), source key, shuffle key, and the number of words of the whole text."""
    chosen = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"),
        F.md5(
            F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.col("text")), F.lit("#")))
        ).alias("place"),
        F.col("text").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                sizes = np.zeros(rows.num_rows, np.int64)
                if len(data):
                    space = _SPACE[data]
                    opens = ~space
                    opens[1:] &= space[:-1]
                    firsts = offsets[:-1][offsets[:-1] < len(data)]
                    opens[firsts] = ~space[firsts]
                    total = np.concatenate([[0], np.cumsum(opens)])
                    sizes = total[offsets[1:]] - total[offsets[:-1]]
                columns = [rows.column(n) for n in ("row", "source_key", "place")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], names=["row", "source_key", "place", "size"])

    kinds = [T.StructField("source_key", T.StringType()), T.StructField("place", T.StringType()), T.StructField("size", T.LongType())]
    return chosen.mapInArrow(run, T.StructType([chosen.schema["row"], *kinds]))


def targets(cells: DataFrame) -> DataFrame:
    """Words and target of each source, from words per cell: source_key, source_size, target."""
    sources = cells.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    ordered = everything.orderBy(F.col("source_key") == "", "source_key")
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = sources.withColumn("weight", F.get(cycle, (F.row_number().over(ordered) - 1) % len(WEIGHTS)))
    weighed = weighed.withColumn("cap", F.lit(float(REPEATS)) * F.col("source_size"))
    tight = everything.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before = F.coalesce(F.sum("cap").over(tight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(tight.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(BUDGET) * F.sum("source_size").over(everything)
    level = F.max("reach").over(everything)
    return (
        weighed.withColumn("reach", (budget - before) / rest)
        .withColumn("target", F.least("cap", level * F.col("weight")))
        .select("source_key", "source_size", "target")
    )


def schedule(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per document: row (its columns, or those to ``carry``, doc_id among them), size, source_size, target, taken, and its copies.

    ``copies`` holds a struct of pass, finish (virtual time) and words for each copy that the mix takes.
    """
    sizes = with_sizes(docs, carry).withColumn("cell", F.substring("place", 1, CELL_DIGITS))
    cells = land(sizes.groupBy("source_key", "cell").agg(F.sum("size").alias("size")), "mix-cells")
    running = Window.partitionBy("source_key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cells.withColumn("cell_start", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .drop("size")
        .join(targets(cells), "source_key")
    )
    inside = Window.partitionBy("source_key", "cell").orderBy("place", "row.doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.join(sized(starts), ["source_key", "cell"]).withColumn("end", F.col("cell_start") + F.sum("size").over(inside))
    quota = F.floor("target")

    def copy(k: int):
        end = F.col("end") + F.col("source_size") * k
        # A source without words has target 0; its copies have no words and no finish, and are left out.
        words = F.greatest(F.lit(0), F.least(F.col("size"), quota - (end - F.col("size"))))
        return F.struct(F.lit(k).alias("pass"), F.try_divide(end, F.col("target")).alias("finish"), words.alias("words"))

    copies = F.filter(F.array(*[copy(k) for k in range(REPEATS)]), lambda x: x["words"] > 0)
    return placed.select("row", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.aggregate("copies", F.lit(0).cast("bigint"), lambda total, x: total + x["words"])
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix in sending order: the columns of ``docs`` with pass, finish and words of each copy.

    The text of a copy that the end of the budget cuts is its first words with the white space between them.
    """
    plan = schedule(docs).select("row", "size", F.explode("copies").alias("copy"))
    parts = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(parts, F.lit(1), F.col("copy.words").cast("int")), "")
    text = F.when(F.col("copy.words") < F.col("size"), cut).otherwise(F.col("row.text"))
    columns = [text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("pass", "finish", "words")]
    return (
        plan.select(*columns, F.col("copy.pass").alias("pass"), F.col("copy.finish").alias("finish"), F.col("copy.words").alias("words"))
        .orderBy("finish", "doc_id", "pass")
    )
