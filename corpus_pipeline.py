"""A corpus from documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which run() writes as Parquet and reads again as the
next stage's docs. All but the last give the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodia.llm.common import delete, scratch, shared_dir, table
from episodia.llm.mixing import mix_sources
from episodia.llm.neardup import near_duplicates
from episodia.llm.packing import pack_documents, word_bpe
from episodia.llm.substrings import remove_repeats
from episodia.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of their language go. The classifier learns from the labelled ones."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select(*COLUMNS), model).where("not is_toxic").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 80 % of their five-word shingles the one of the smallest id stays."""
    gone = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone.distinct(), "doc_id", "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document of a smaller id has are cut out; emptied documents go."""
    cut = remove_repeats(docs).where("n_removed > 0")
    cut = cut.select("doc_id", F.col("mark").alias("cut_mark"), F.col("text").alias("cut_text"), (F.col("n_removed") >= F.col("n_words")).alias("emptied")).dropDuplicates(["doc_id", "cut_mark"])
    same = (docs.doc_id == cut.doc_id) & (F.xxhash64(docs.text) == cut.cut_mark)
    joined = docs.join(cut, same, "left").drop(cut.doc_id).where(~F.coalesce("emptied", F.lit(False)))
    return joined.withColumn("n_chars", F.when(F.col("cut_text").isNotNull(), F.length("cut_text").cast("long")).otherwise(F.col("n_chars"))).withColumn("text", F.coalesce("cut_text", "text")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: none, once or twice. Counts belong to rows, so repeated and null ids are no matter."""
    mixed = mix_sources(docs.select(*COLUMNS), carry=COLUMNS).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of up to 2048 tokens."""
    return pack_documents(docs, word_bpe())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned classifiers, MinHash forests and tokenizers are beyond SQL. The tests compare each stage's rows with what its rule
#: makes of the rows before it, followed one by one (toxicity: with the fitted model's scores and thresholds), and run()
#: with the stages in turn.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's own tables go when its result is written, its result when the next one's is."""
    docs, folder = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        written = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with scratch(spark, name):
            rows = stage(spark, docs, sf_dir)
            rows.write.option("compression", "zstd").parquet(written)
        docs = spark.read.schema(rows.schema).parquet(written)
        if folder:
            delete(spark, folder)
        folder = written
    packed = STAGES[-1][1](spark, docs, sf_dir)  # rests on tables of pieces, no longer on docs
    delete(spark, folder)
    return packed
