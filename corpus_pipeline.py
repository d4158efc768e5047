"""Documents to packed training sequences, in four stages.

Language identification drops what has no recognisable language, the n-gram join keeps one document of each
group of near copies, fair queueing mixes the sources to their target weights (a document may come
twice), and minimum bin slack packs the token ids. Each stage is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import language_id
from tillwork.llm.mixing import mix
from tillwork.llm.ngram_join import first_of_classes, text_mark
from tillwork.llm.words import has_word
from tillwork.llm.packing import pack_documents
from tillwork.llm.shared import plain_names, saved
from tillwork.llm.tokens import default_vocabulary
from tillwork.session import tuned

#: Least chance of the best language. Nearly void: with four languages it is 1/4 at least; see the README.
MIN_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, as they were.

    Goes: null texts, texts without a letter, and texts whose best language has a chance below MIN_SCORE (none of
    the supplied ones); texts in no learned language stay.
    Without any label to learn from every document with a letter stays.
    """
    tuned(spark)
    return language_id.accepted(docs, language_id.learn(docs), MIN_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest doc_id, nulls last.

    Every text is compared, also several of one doc_id and those of a null doc_id. Texts without words are
    alike to none and stay; of repeats of such a text under one doc_id one stays.
    """
    tuned(spark)
    rows = plain_names(docs, "doc_id", "text")
    kept = first_of_classes(rows).select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark"))
    marked = rows.withColumn("text_mark", text_mark(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.col("text_mark") == F.col("kept_mark"))
    first = marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_mark"])
    wordless = marked.filter(~has_word(F.col("text")))
    once = wordless.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text_mark"])
    return first.union(once).union(wordless.filter("doc_id IS NULL")).drop("text_mark").toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice; documents of size 0 stay once.

    Equal rows are interchangeable: together they come as often as the mix takes them together.
    """
    tuned(spark)
    rows = plain_names(docs, "doc_id", "text", "source")
    keys = ["row_key", "row_check"]
    # maps have no hash of their own
    values = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema.fields]
    keyed = rows.withColumns({keys[0]: F.xxhash64(*values), keys[1]: F.hash(*values)})
    times = mix(keyed, carry=keys).groupBy(*keys).agg(F.sum("copies").cast("int").alias("copies")).filter("copies > 0")
    chosen = keyed.dropDuplicates(keys).join(times, keys)
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(rows.columns).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in a sequence: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_documents(docs, default_vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None  # SQL expresses neither the network nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
