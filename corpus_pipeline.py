"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; all but the last return documents'
columns. run() applies them in order, each one's rows written as Parquet into the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.decontamination import drop_contaminated
from eventloom.llm.packing import packed
from eventloom.llm.simhash import drop_similar
from eventloom.llm.substring import deduplicated
from eventloom.llm.toxicity import drop_toxic
from eventloom.sources.shared import new_folder, remove_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels given, does not reject; null texts, null ids and repeated rows are judged as any."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by a Jaccard similarity of 0.8 or more over runs of five words,
    proposed by SimHash under covering masks. Rows with a null id stay, as do repeated rows of an id that is kept; texts without words are one group."""
    return drop_similar(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the passages that an earlier document has; n_chars follows the text, and documents left without words stay, as do null and empty
    texts. Rows with a null id lose nothing, repeated rows of an id lose the same; no rows give none."""
    kept = deduplicated(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return kept.select([(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids, placed into sequences; null and empty texts are an end id, repeated rows pieces of their own."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("substrings", substrings), ("decontamination", decontamination), ("packing", packing)]

#: Tokenization, a fitted classifier and iterated components are not expressible in SQL; tests/llm/test_pipeline.py recomputes run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's folder goes when the next one's is written; the last one's stays, as the result reads it. Nulls, repeated rows and
    further columns are as each stage says. Without documents there are no rows; without labels the classifier rejects
    none; an empty benchmark contaminates nothing."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
