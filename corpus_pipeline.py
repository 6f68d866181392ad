"""A corpus cleaned in five stages. Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.

The tables beside the documents (labels, benchmark) come from `sf_dir`; the tokenizer model from `thicket.llm.sp_tokenizer.model_for`.
Null texts never fail a stage: the classifier decides on them as on empty texts, the other stages keep them. Repeated rows are decided alike, each; rows of
one id and different texts each by its own text, but for the near-copy stage, which keeps or drops an id whole. Columns of any name pass
through; of the others, n_chars alone follows the text. An empty table leaves every stage empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm.common import save, table
from thicket.llm.decontaminate import remove
from thicket.llm.jaccard_join import jaccard_components
from thicket.llm.line_dedup import line_dedup
from thicket.llm.quality_crf import keep_good, train
from thicket.llm.sp_tokenizer import encode, model_for


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with n_chars (where there is one) of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores below 0.3 go. It is fitted on the labelled ones among `docs`."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents go."""
    return _sized(line_dedup(docs, counts=False), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a 5-word Jaccard similarity of 0.8, directly or through others, the one with the smallest id stays. Documents without words or id all stay."""
    found = jaccard_components(docs, percent=80, n=5)
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages of 10 words are cut out; documents over half of whose words they are go."""
    return _sized(remove(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token ids."""
    return encode(docs, model_for(spark))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmark), ("SentencePiece encoding", tokens)]

#: The classifier is fitted, so SQL cannot express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
